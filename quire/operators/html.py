"""Web pages as rows: content blocks and assets, by a Python UDTF over the standard library's parser.

Recovery of unclosed tags: an open paragraph is closed by the next block element, a list item by the next
one, a table cell or row by the next; script and style bodies are raw text; the end of the page closes
everything. A recognised block is taken whole, what lies within it is its text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from quire.functions import text as X
from quire.operators.merge import without_repeats

# Elements without content, chrome around the content, and what ends an open paragraph.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CHROME = frozenset("nav header footer aside script style noscript svg template".split())
CHROME_ROLES = frozenset("banner navigation contentinfo search complementary".split())
ENDS_PARAGRAPH = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
CLOSES = {"li": ("li",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th")}
#: Open elements that a closing rule doesn't look beyond.
SCOPES = frozenset("ul ol table body html main article section div".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MEDIA = frozenset("audio video iframe".split())
_SPACES = re.compile(r"\s+")


class Element:
    __slots__ = ("tag", "attrs", "parts", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None):
        self.tag, self.attrs, self.parts, self.parent = tag, attrs, [], parent

    def children(self) -> Iterator[Element]:
        return (p for p in self.parts if isinstance(p, Element))

    def within(self) -> Iterator[Element]:
        """All elements below this one, in document order, without recursion."""
        stack = list(self.children())[::-1]
        while stack:
            e = stack.pop()
            yield e
            stack.extend(list(e.children())[::-1])

    def text(self) -> str:
        out, stack = [], list(self.parts)[::-1]
        while stack:
            p = stack.pop()
            if isinstance(p, str):
                out.append(p)
            else:
                stack.extend(p.parts[::-1])
        return "".join(out)


class Tree(HTMLParser):
    """Builds elements; never fails on a page, however broken."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("#root", {}, None)

    def _close(self, names: tuple[str, ...] | frozenset[str]) -> None:
        e = self.at
        while e.parent is not None and e.tag not in names:
            if e.tag in SCOPES:
                return
            e = e.parent
        if e.parent is not None:
            self.at = e.parent

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ENDS_PARAGRAPH:
            self._close(("p",))
        if tag in CLOSES:
            self._close(CLOSES[tag])
            if tag in ("tr", "thead", "tbody"):
                self._close(CLOSES[tag])
        e = Element(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.parts.append(e)
        if tag not in VOID:
            self.at = e

    def handle_endtag(self, tag: str) -> None:
        e = self.at
        while e.parent is not None and e.tag != tag:
            e = e.parent
        if e.parent is not None:
            self.at = e.parent

    def handle_data(self, data: str) -> None:
        self.at.parts.append(data)


def parse(html: str | None) -> Element:
    tree = Tree()
    tree.feed(html or "")
    tree.close()
    return tree.root


def content_root(root: Element) -> Element:
    """The first main, else the first article, else the first element with that role, else the body or all."""
    for test in (lambda e: e.tag == "main", lambda e: e.tag == "article", lambda e: e.attrs.get("role") == "main", lambda e: e.tag == "body"):
        found = next(filter(test, root.within()), None)
        if found is not None:
            return found
    return root


def norm(text: str) -> str:
    return _SPACES.sub(" ", text).strip()


def ignored(e: Element) -> bool:
    return e.tag in CHROME or e.attrs.get("role") in CHROME_ROLES or e.attrs.get("aria-hidden") == "true"


def list_items(e: Element) -> list[dict]:
    out = []
    for li in e.children():
        if li.tag == "li":
            inner = next((c for c in li.children() if c.tag in ("ul", "ol")), None)
            item = {"text": norm(li.text())}
            if inner is not None:
                item["children"] = list_items(inner)
            out.append(item)
    return out


def source(e: Element) -> str:
    return e.attrs.get("src") or e.attrs.get("data-src") or ""


def block(e: Element) -> dict | None | bool:
    """The block that an element is; None for a block without content, False for an element that is none."""
    tag = e.tag
    if tag in HEADINGS:
        t = norm(e.text())
        return {"type": "heading", "level": int(tag[1]), "text": t} if t else None
    if tag == "p":
        t = norm(e.text())
        return {"type": "paragraph", "text": t} if t else None
    if tag == "figure":
        img = next((x for x in e.within() if x.tag == "img"), None)
        if img is None or not source(img):
            return None
        cap = next((x for x in e.within() if x.tag == "figcaption"), None)
        return {"type": "figure", "src": source(img), "alt": img.attrs.get("alt", ""), "caption": norm(cap.text()) if cap is not None else None}
    if tag == "table":
        return table(e)
    if tag in ("ul", "ol"):
        items = [i for i in list_items(e) if i["text"]]
        return {"type": "list", "ordered": tag == "ol", "items_json": json.dumps(items, ensure_ascii=False)} if items else None
    if tag in MEDIA:
        inner = next((x for x in e.within() if x.tag == "source" and x.attrs.get("src")), None)
        src = e.attrs.get("src") or (inner.attrs["src"] if inner is not None else "")
        return {"type": "media", "kind": tag, "src": src} if src else None
    if tag == "blockquote":
        t = norm(e.text())
        return {"type": "quote", "text": t, "cite": e.attrs.get("cite")} if t else None
    if tag == "pre":
        t = re.sub(r"[ \t]+$", "", e.text().replace("\r\n", "\n"), flags=re.M)
        return {"type": "code", "text": t} if t.strip() else None
    if tag == "img":
        return {"type": "image", "src": source(e), "alt": e.attrs.get("alt", "")} if source(e) else None
    return False


def table(e: Element) -> dict | None:
    def cells(tr: Element, tags: tuple[str, ...]) -> list[str]:
        return [norm(c.text()) for c in tr.within() if c.tag in tags]

    heads, bodies, rows = [], [], []
    for x in e.within():
        if x.tag == "tr":
            up = x.parent
            while up is not e and up is not None and up.tag not in ("thead", "tbody"):
                up = up.parent
            (heads if up is not None and up.tag == "thead" else bodies if up is not None and up.tag == "tbody" else rows).append(x)
    headers = [h for tr in heads if (h := cells(tr, ("th",)))]
    lines = [r for tr in (bodies or heads + rows) if any(r := cells(tr, ("td", "th")))]
    if not headers and not lines:
        return None
    cap = next((x for x in e.within() if x.tag == "caption"), None)
    return {"type": "table", "headers": headers, "rows": lines, "caption": norm(cap.text()) if cap is not None else None}


NODE = "ord int, type string, level int, text string, ordered boolean, items_json string, headers array<array<string>>, rows array<array<string>>, caption string, src string, alt string, kind string, cite string"
_FIELDS = [f.split(" ")[0] for f in NODE.split(", ")][1:]


@udtf(returnType=NODE)
class html_nodes:  # noqa: N801 - named as it is called in SQL
    """The content blocks of a page, in document order. A null or empty page gives none."""

    def eval(self, html: str):
        stack, n = list(content_root(parse(html)).children())[::-1], 0
        while stack:
            e = stack.pop()
            if ignored(e):
                continue
            b = block(e)
            if b is False:
                stack.extend(list(e.children())[::-1])
            elif b is not None:
                yield (n, *[b.get(k) for k in _FIELDS])
                n += 1


@udtf(returnType="ord int, type string, src string, href string, text string, kind string")
class html_assets:  # noqa: N801
    """Images, then media, then links below a page's content root, those in chrome too."""

    def eval(self, html: str):
        below = list(content_root(parse(html)).within())
        for k, e in enumerate(x for x in below if x.tag == "img"):
            if source(e):
                yield k, "image", source(e), None, e.attrs.get("alt", ""), None
        for k, e in enumerate(x for x in below if x.tag in MEDIA):
            b = block(e)
            if b:
                yield k, "media", b["src"], None, None, b["kind"]
        for k, e in enumerate(x for x in below if x.tag == "a" and "href" in x.attrs):
            if e.attrs["href"]:
                yield k, "link", None, e.attrs["href"], norm(e.text()), None


@udtf(returnType="title string, canonical string, lang string, description string, meta map<string,string>")
class html_metadata:  # noqa: N801
    """A page's title (its own, else the one for sharing), canonical address, language, description and meta tags; the last of equal names counts."""

    def eval(self, html: str):
        below = list(parse(html).within())
        meta = {}
        for e in below:
            if e.tag == "meta":
                key = e.attrs.get("property") or e.attrs.get("name")
                if key and e.attrs.get("content"):
                    meta[key.lower()] = e.attrs["content"]
        title = next((e.text() for e in below if e.tag == "title"), None)
        canonical = next((e.attrs.get("href") for e in below if e.tag == "link" and e.attrs.get("rel") == "canonical"), None)
        lang = next((e.attrs.get("lang") for e in below if e.tag == "html"), None)
        yield norm(title if title is not None else meta.get("og:title", "")), canonical, lang, meta.get("description", meta.get("og:description")), meta


def nodes(pages: DataFrame, html: str = "html", keys: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """keys and a row for each content block of each page; narrow, without a shuffle."""
    return pages.select(*keys, html).lateralJoin(html_nodes(F.col(html).outer())).drop(html)


def assets(pages: DataFrame, html: str = "html", keys: tuple[str, ...] = ("page_id",)) -> DataFrame:
    return pages.select(*keys, html).lateralJoin(html_assets(F.col(html).outer())).drop(html)


def metadata(pages: DataFrame, html: str = "html", keys: tuple[str, ...] = ("page_id",)) -> DataFrame:
    return pages.select(*keys, html).lateralJoin(html_metadata(F.col(html).outer())).drop(html)


def clean(blocks: DataFrame, page: str = "page_id") -> DataFrame:
    """Blocks in composed form, without repeated headings, paragraphs and quotes, numbered anew."""
    return without_repeats(blocks.withColumn("text", X.nfc(F.col("text"))), page)


def counts(blocks: DataFrame, page: str = "page_id") -> DataFrame:
    """Blocks of each type on each page, and whether the page is incomplete: without heading, paragraph, list and table."""
    kinds = ["heading", "paragraph", "list", "table", "figure", "image", "media", "quote", "code"]
    each = blocks.groupBy(page).agg(*[F.count_if(F.col("type") == k).alias(k) for k in kinds])
    return each.withColumn("incomplete", F.greatest("heading", "paragraph", "list", "table") == 0)


def block_words(type_: Column, text: Column, items_json: Column, rows: Column) -> Column:
    """Words of headings, paragraphs and quotes, of a list's own items, and of a table's body."""
    items = F.from_json(items_json, "array<struct<text:string>>")
    add = lambda parts: F.aggregate(parts, F.lit(0), lambda a, x: a + X.token_count(x))
    return (
        F.when(type_.isin("heading", "paragraph", "quote"), X.token_count(text))
        .when(type_ == "list", add(F.transform(items, lambda i: i["text"])))
        .when(type_ == "table", add(F.flatten(rows)))
        .otherwise(0)
    )


def _list_markdown(items_json: Column, ordered: Column) -> Column:
    def lines(items: list[dict], numbered: bool, depth: int) -> Iterator[str]:
        for k, i in enumerate(items):
            yield f"{'  ' * depth}{f'{k + 1}.' if numbered else '-'} {i['text']}"
            yield from lines(i.get("children", []), numbered, depth + 1)

    @F.pandas_udf("string")
    def rendered(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for items, numbered in batches:
            yield pd.Series([None if i is None else "\n".join(lines(json.loads(i), bool(n), 0)) for i, n in zip(items, numbered)])

    return rendered(items_json, ordered)


def markdown(blocks: DataFrame) -> Column:
    """A block as Markdown. Only lists, which may be nested, need Python."""
    row = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))
    head = F.coalesce(F.get("headers", F.lit(0)), F.get("rows", F.lit(0)))
    body = F.when(F.size("headers") > 0, F.col("rows")).otherwise(F.slice("rows", 2, F.greatest(F.size("rows"), F.lit(1))))
    rule = row(F.transform(head, lambda _: F.lit("---")))
    grid = F.array_join(F.concat(F.array(row(head), rule), F.transform(body, row)), "\n")
    caption = F.when(F.col("caption").isNotNull(), F.concat(F.lit("*"), "caption", F.lit("*\n\n"))).otherwise("")
    shown = F.coalesce("caption", "alt", F.lit(""))
    return (
        F.when(F.col("type") == "heading", F.concat(F.repeat(F.lit("#"), F.col("level")), F.lit(" "), "text"))
        .when(F.col("type") == "paragraph", F.col("text"))
        .when(F.col("type") == "quote", F.concat(F.lit("> "), F.replace("text", F.lit("\n"), F.lit("\n> "))))
        .when(F.col("type") == "code", F.concat(F.lit("```\n"), "text", F.lit("\n```")))
        .when(F.col("type") == "list", _list_markdown(F.col("items_json"), F.col("ordered")))
        .when(F.col("type") == "table", F.concat(caption, grid))
        .when(F.col("type") == "image", F.concat(F.lit("!["), F.coalesce("alt", F.lit("")), F.lit("]("), "src", F.lit(")")))
        .when(F.col("type") == "figure", F.concat(F.lit("!["), shown, F.lit("]("), "src", F.lit(")"), F.coalesce(F.concat(F.lit("\n*"), "caption", F.lit("*")), F.lit(""))))
        .when(F.col("type") == "media", F.concat(F.lit("["), "kind", F.lit("]("), "src", F.lit(")")))
        .otherwise("")
    )


def documents(blocks: DataFrame, page: str = "page_id") -> DataFrame:
    """page, markdown, words, status: each page put together again; failed if it is incomplete."""
    lines = blocks.select(page, F.struct("ord", markdown(blocks).alias("md")).alias("_b"), block_words(F.col("type"), F.col("text"), F.col("items_json"), F.col("rows")).alias("_w"), F.col("type").isin("heading", "paragraph", "list", "table").alias("_full"))
    held = lines.groupBy(page).agg(F.array_sort(F.collect_list("_b")).alias("_bs"), F.sum("_w").cast("bigint").alias("words"), F.bool_or("_full").alias("_ok"))
    text = F.array_join(F.filter(F.transform("_bs", lambda b: b["md"]), lambda m: m != ""), "\n\n")
    return held.select(page, F.concat(text, F.lit("\n")).alias("markdown"), "words", F.when(F.col("_ok"), "verified").otherwise("failed").alias("status"))
