"""Column functions over cells, pages and list-valued tags. All of them stay in the JVM.

Each function names what it does with nulls. "Blank" means empty after trimming.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: scripts that write without spaces (kana, Han, Hangul).
CJK = "[\\u3040-\\u30ff\\u3400-\\u4dbf\\u4e00-\\u9fff\\uf900-\\ufaff\\uac00-\\ud7af]"
#: White space as Unicode has it, no-break spaces included.
SPACE = r"[\s\p{Z}\x1c-\x1f\x85]"
FILLED = r"[^\s\p{Z}\x1c-\x1f\x85]"


def flat(c: Column) -> Column:
    """One clean cell: runs of white space, no-break spaces too, become one space; ends trimmed; null gives ''."""
    return F.coalesce(F.trim(F.regexp_replace(c.cast("string"), f"{SPACE}+", " ")), F.lit(""))


def filled(c: Column) -> Column:
    """Whether anything but white space is there; null gives false."""
    return F.coalesce(c.rlike(FILLED), F.lit(False))


def strip(c: Column) -> Column:
    """Without the white space at its ends, no-break spaces too; null stays null."""
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def none_label(c: Column) -> Column:
    """A value for counting: blank or null becomes ``(none)``, which differs from the literal ``none``."""
    return F.when(c.isNull() | (c == ""), F.lit("(none)")).otherwise(c)


def word_count(c: Column) -> Column:
    """Words between spaces, plus characters of scripts that write without them; null gives 0."""
    return F.coalesce(F.regexp_count(c, F.lit(CJK)) + F.regexp_count(F.regexp_replace(c, CJK, " "), F.lit(r"[^\s\p{Z}]+")), F.lit(0))


def token_count(c: Column) -> Column:
    """Tokens between white space; null gives 0."""
    return F.coalesce(F.regexp_count(c, F.lit(r"[^\s\p{Z}]+")), F.lit(0))


def gender_of(word: Column) -> Column:
    """The gender that a headword shows in brackets at its end; '' if it shows none, null for null."""
    return F.regexp_extract(word, r"\((m|f|mf|m/f|m pl|f pl)\)\s*$", 1)


def strip_brackets(c: Column) -> Column:
    """A list-valued tag without the brackets around it, trimmed."""
    t = strip(c)
    return F.when(t.startswith("[") & t.endswith("]"), strip(F.regexp_replace(t, r"^\[|\]$", ""))).otherwise(t)


def list_items(c: Column) -> Column:
    """The items of a list-valued tag such as ``[cover, toc]``; null gives null."""
    return F.filter(F.transform(F.split(F.regexp_replace(strip(c), r"^[\[\]]+|[\[\]]+$", ""), ","), lambda x: strip(x)), lambda x: x != "")


def tag_tokens(c: Column) -> Column:
    """The tokens of a list-valued tag: letters, digits, underscores and hyphens of any script."""
    return F.regexp_extract_all(c, F.lit(r"[\p{L}\p{N}\p{M}_-]+"), F.lit(0))


def unquote(c: Column) -> Column:
    """Without the double quotes at its ends."""
    return F.regexp_replace(c, r'^"+|"+$', "")


def page_key(c: Column) -> Column:
    """A page as a key: without ``page-``, white space and leading zeros; '' for a blank, null for null."""
    return F.regexp_replace(F.regexp_replace(strip(c), "page-", ""), r"^0+", "")


def unit_label(number: Column) -> Column:
    """``page-`` and the number with three digits."""
    return F.format_string("page-%03d", number)


def page_heading(unit: Column) -> Column:
    return F.replace(unit, F.lit("page-"), F.lit("Page "))


def bare_letter(c: Column) -> Column:
    """Whether an answer is one of the letters a to d, perhaps with a full stop."""
    return F.coalesce(c.rlike(r"^[a-dA-D]\.?$"), F.lit(False))


def slug_like(c: Column) -> Column:
    """At least four lower-case parts joined by hyphens: prose made into a slug."""
    return F.coalesce(c.rlike(r"^[a-z0-9]+(-[a-z0-9]+){3,}$"), F.lit(False))


def non_ascii(c: Column) -> Column:
    return F.coalesce(c.rlike(r"[^\x00-\x7f]"), F.lit(False))


def control_character(c: Column) -> Column:
    return F.coalesce(c.rlike(r"\p{Cc}"), F.lit(False))


def cell_for_table(c: Column) -> Column:
    """A cell for a table whose columns are set off by pipes."""
    return F.translate(c, "|", "/")


def cell_for_tsv(c: Column) -> Column:
    """Runs of tabs and line ends become one space."""
    return F.regexp_replace(c, r"[\t\r\n]+", " ")


def yaml_string(c: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))


def trimmed_code(c: Column) -> Column:
    """Code text with line feeds only and without blanks at the ends of its lines."""
    return F.regexp_replace(F.replace(c, F.lit("\r\n"), F.lit("\n")), r"(?m)[ \t]+$", "")


def capitalised(c: Column) -> Column:
    """First letter in upper case, the rest in lower case."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def title_cased(c: Column) -> Column:
    """Each run of letters with an initial capital, also after an apostrophe or a digit."""
    parts = F.regexp_extract_all(c, F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substring(p, 2, 1 << 30)))), "")


def path_stem(c: Column) -> Column:
    """A file's name without folders and its last extension."""
    return F.regexp_replace(F.regexp_extract(c, r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")


def masked_date(c: Column) -> Column:
    """The date in a ``> Generated`` line replaced, so that two builds can be compared."""
    return F.regexp_replace(c, r"(?m)^(> Generated )\d{4}-\d{2}-\d{2}\.", "$1<date>.")


def clock(seconds: Column) -> Column:
    """Seconds as mm:ss."""
    whole = F.floor(seconds)
    return F.format_string("%02d:%02d", F.floor(whole / 60).cast("int"), (whole % 60).cast("int"))


def half_even(c: Column, digits: int = 0) -> Column:
    """Rounded to the nearest, halves to the even digit."""
    return F.bround(c, digits)


def half_up(c: Column) -> Column:
    """Rounded to the nearest, halves up."""
    return F.floor(c + F.lit(0.5))


def percent(part: Column, whole: Column) -> Column:
    """Whole per cent, halves to even; 0 of nothing."""
    return F.when(whole > 0, F.bround(100.0 * part / whole, 0)).otherwise(F.lit(0.0)).cast("int")


def short_hash(c: Column) -> Column:
    """The first 16 hex digits of a text's SHA-256."""
    return F.substring(F.sha2(c, 256), 1, 16)


def backoff(base: float, factor: float, attempt: Column) -> Column:
    """The wait before an attempt, growing by a factor."""
    return F.round(F.lit(base) * F.pow(F.lit(factor), attempt - 1), 0)


def frontmatter(page: Column) -> Column:
    """The ``key: value`` lines between the fences at a page's start, trimmed, as a map; the last of equal keys wins.

    A page without fences gives an empty map. Needs spark.sql.mapKeyDedupPolicy=LAST_WIN.
    """
    lines = F.split(F.regexp_extract(page, r"(?s)^---\n(.*?)\n---\n?", 1), "\n")
    pairs = F.filter(lines, lambda x: x.contains(":"))
    return F.map_from_entries(F.transform(pairs, lambda x: F.struct(strip(F.substring_index(x, ":", 1)), strip(F.regexp_replace(x, r"^[^:]*:", "")))))


def body(page: Column) -> Column:
    """A page without the fences at its start, trimmed."""
    return F.regexp_replace(F.regexp_replace(page, r"(?s)\A---\n.*?\n---\n?", ""), rf"\A{SPACE}+|{SPACE}+\z", "")


def loose_frontmatter(page: Column) -> Column:
    """As ``frontmatter``, but the second fence may be followed by anything, and a page must start with the first."""
    inner = F.regexp_extract(page, r"(?s)\A---(.*?)\n---", 1)
    pairs = F.filter(F.split(inner, "\n"), lambda x: x.contains(":"))
    return F.map_from_entries(F.transform(pairs, lambda x: F.struct(strip(F.substring_index(x, ":", 1)), strip(F.regexp_replace(x, r"^[^:]*:", "")))))


# Marks that a title loses, entities that stand for a space in it, and lines that only number a page.
TITLE_MARKS = r"^\s*#+|[*_`>|\[\]]"
TITLE_SPACES = r"<!--.*?-->|&(?:nbsp|#160|thinsp|ensp|emsp);"
TITLE_NUMBERS = r"(?i)^(?:(?:page|seite|p)\s*\.?\s*)?\d+$"


def page_title(c: Column) -> Column:
    """The first line that says something, of at most 90 characters; '' if there is none, or for null.

    A comment that opens a line is taken out with all lines it reaches, up to the end of the line that closes
    it, or of the page. Of the other lines, without markup, the first counts that isn't empty or a number.
    """
    shown = F.regexp_replace(c, rf"(?ms)^{SPACE}*<!--.*?(?:-->[^\r\n]*|\z)", "")
    lines = F.transform(F.split(shown, r"[\r\n]+"), lambda x: flat(F.regexp_replace(F.regexp_replace(x, TITLE_SPACES, " "), TITLE_MARKS, "")))
    title = F.get(F.filter(lines, lambda x: (x != "") & ~x.rlike(TITLE_NUMBERS)), F.lit(0))
    return F.coalesce(F.trim(F.substring(title, 1, 90)), F.lit(""))


def humanised(c: Column) -> Column:
    """A column's name as a label: spaces for underscores, a capital first; ``qa`` is QA."""
    return F.when(c == "qa", "QA").otherwise(capitalised(F.replace(c, F.lit("_"), F.lit(" "))))


def visible_text(html: Column) -> Column:
    """What a page shows: bodies of scripts and styles dropped, tags as spaces, white space collapsed."""
    s = F.regexp_replace(html, r"(?is)<script\b.*?</script>|<style\b.*?</style>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(s, r"<[^>]+>", " "), f"{SPACE}+", " "))


def nfc(c: Column) -> Column:
    """Composed normal form; Spark has no built-in for it, so only texts beyond ASCII go through an Arrow UDF."""
    @F.pandas_udf("string")
    def composed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")

    odd = F.octet_length(c) > F.char_length(c)
    return F.when(odd, composed(F.when(odd, c))).otherwise(c)


def needs_render(html: Column, least: int = 200) -> Column:
    """Whether a page shows so little text that it has to be loaded in a browser."""
    return F.length(visible_text(F.coalesce(html, F.lit("")))) < least


def chunk_label(first: Column, last: Column) -> Column:
    """The name of a chunk of pages."""
    return F.format_string("chunk-%03d-%03d", first, last)
