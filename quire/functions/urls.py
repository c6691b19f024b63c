"""Addresses: parts, slugs, kinds of links, and which pages may be fetched."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Extensions of links that lead to a file to keep.
DOWNLOADS = r"(?i)\.(?:pdf|zip|docx?|pptx?|xlsx?|csv|mp3|mp4|wav|epub)$"


def host(url: Column) -> Column:
    """The host in lower case, null for what is no address."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def path(url: Column) -> Column:
    """The path, '/' if the address has none; null for what is no address."""
    return F.when(F.try_parse_url(url, F.lit("HOST")).isNotNull(), F.coalesce(F.nullif(F.try_parse_url(url, F.lit("PATH")), F.lit("")), F.lit("/")))


def slug(url_path: Column) -> Column:
    """A path as a slug: lower case, other characters as one hyphen, segments joined by two; ``index`` for the root."""
    bare = F.regexp_replace(F.regexp_replace(url_path, "/+$", ""), "^/+", "")
    s = F.lower(F.when(bare == "", F.lit("index")).otherwise(bare))
    s = F.regexp_replace(F.regexp_replace(s, r"[^a-z0-9/]+", "-"), "-+", "-")
    return F.regexp_replace(F.replace(s, F.lit("/"), F.lit("--")), "^-+|-+$", "")


def under(url_path: Column, prefixes: Sequence[str]) -> Column:
    """Whether the path is one of the prefixes or below it; false without prefixes."""
    p = F.lower(url_path)
    out = F.lit(False)
    for x in prefixes:
        out = out | (p == x) | p.startswith(f"{x}/")
    return F.coalesce(out, F.lit(False))


def may_crawl(url_path: Column, allow: Sequence[str], deny: Sequence[str]) -> Column:
    """Denied prefixes are looked at first."""
    return ~under(url_path, deny) & under(url_path, allow)


def robots_allows(url_path: Column, rules: Sequence[tuple[str, bool]]) -> Column:
    """By the longest rule (prefix, allowed) that fits; allowed if none does, and an empty prefix says nothing."""
    out = F.lit(True)
    for prefix, allowed in sorted((r for r in rules if r[0]), key=lambda r: (len(r[0]), r[1])):
        out = F.when(url_path.startswith(prefix), F.lit(allowed)).otherwise(out)
    return out


def sitemap_urls(xml: Column) -> Column:
    """The addresses of a sitemap, trimmed."""
    return F.transform(F.regexp_extract_all(xml, F.lit(r"<loc>([^<]+)</loc>"), F.lit(1)), lambda u: F.trim(u))


def resolve(link: Column, base: Column) -> Column:
    """A link made absolute by its page's address; what can't be resolved stays. Absolute links stay in the JVM."""

    def one(a: str | None, b: str | None) -> str | None:
        try:
            return urljoin(b or "", a) if a is not None else None
        except ValueError:
            return a

    @F.pandas_udf("string")
    def joined(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for links, bases in batches:
            yield pd.Series([one(a, b) for a, b in zip(links, bases)])

    done = link.rlike(r"^https?://[^/]+/[^.#?]*$")
    return F.when(done, link).otherwise(joined(F.when(~F.coalesce(done, F.lit(False)), link), base))


def link_kind(href: Column, absolute: Column, page_url: Column) -> Column:
    """anchor, mailto, download, internal (the very same host) or external."""
    same = host(absolute) == host(page_url)
    return (
        F.when(href.startswith("#"), "anchor")
        .when(href.startswith("mailto:"), "mailto")
        .when(F.coalesce(path(absolute).rlike(DOWNLOADS), F.lit(False)), "download")
        .when(F.coalesce(same, F.lit(False)), "internal")
        .otherwise("external")
    )


def classify(url_path: Column, exams: Mapping[str, str], sections: Mapping[str, str]) -> Column:
    """exam (by the first segment), level (of any segment), section (of the first that names one) and content type."""
    parts = F.filter(F.split(F.lower(url_path), "/"), lambda p: p != "")
    first = F.get(parts, F.lit(0))
    exam = F.lit("unknown")
    for key, name in exams.items():
        exam = F.when(first == key, F.lit(name)).otherwise(exam)
    level = F.coalesce(F.upper(F.get(F.filter(parts, lambda p: p.rlike(r"^[abc][12]$")), F.lit(0))), F.lit("unknown"))
    named = F.get(F.filter(parts, lambda p: p.isin(*sections) if sections else F.lit(False)), F.lit(0))
    section = F.lit(None).cast("string")
    for key, name in sections.items():
        section = F.when(named == key, F.lit(name)).otherwise(section)
    content = (
        F.when(first == "blog", F.when(F.size(parts) > 1, "blog-article").otherwise("landing"))
        .when(F.array_contains(parts, "mock-test"), "mock-test-info")
        .when(section.isNotNull(), "exam-section")
        .when(exam != "unknown", "exam-overview")
        .otherwise("landing")
    )
    return F.struct(exam.alias("exam"), level.alias("level"), section.alias("section"), F.array(content).alias("content_type"))
