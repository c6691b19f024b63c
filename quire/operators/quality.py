"""Data quality as rules: each compiles to an aggregate, and all rules of a sheet are one pass over it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as X

# Columns of the sheets, in canonical order, and those a language may omit.
CANONICAL = {
    "questions": ["collection", "section", "part", "item", "item_type", "instruction", "question", "option_a", "option_b", "option_c", "option_d", "option_e", "correct_answer", "level", "topic", "source_page"],
    "vocabulary": ["collection", "word", "translation", "article", "gender", "plural", "word_class", "example", "topic", "source_page"],
    "catalog": ["collection", "unit", "section", "chapter", "content_type", "activity_type", "topic", "level", "status", "qa", "word_count", "summary", "title"],
}
OPTIONAL = {"catalog": ["chapter"], "vocabulary": ["translation", "gender"], "questions": []}
# Cells that people read.
TEXT_COLUMNS = ["instruction", "question", "option_a", "option_b", "option_c", "option_d", "option_e", "correct_answer", "word", "translation", "example", "summary", "title", "part", "chapter"]
# Closed vocabularies; blanks are allowed in each.
CLOSED = {
    "section": ["listening", "reading", "writing", "speaking", "grammar", "vocabulary", "none"],
    "item_type": ["multiple-choice", "matching", "true-false", "fill-in", "ordering", "short-answer", "writing-task", "speaking-task", "open-ended"],
    "word_class": ["noun", "verb", "adjective", "adverb", "preposition", "pronoun", "conjunction", "phrase", "number", "other"],
    "status": ["transcribed", "verified"],
    "qa": ["pass", "fail"],
    "level": ["A1", "A2", "B1", "B2", "C1", "C2", "mixed"],
}
# Open vocabularies. Where values are known, others are reported as drift; an empty list means any.
OPEN = {
    "content_type": ["cover", "toc", "intro", "instructions", "reading-text", "exercise", "listening-sheet", "writing-prompt", "speaking-prompt", "vocabulary", "answer-key", "lesson", "grammar-box", "dialogue", "audio-script", "wordlist", "chapter-opener", "review", "picture-story", "song", "explanation", "comprehension-questions", "strategy-box", "reference", "phonetics", "conjugation-table", "table", "illustration"],
    "activity_type": [],
    "topic": [],
}
# What a cell must not hold, as patterns.
HYGIENE = {
    "control character": r"\p{Cc}",
    "markup": r"<!--|-->|</?[a-zA-Z][^>]*>",
    "mojibake": r"Ã[\x{80}-\x{bf}]|â€|Â[\x{a0}-\x{bf}]",
    "replacement character": r"\x{fffd}",
    "entity": r"&(?:nbsp|amp|lt|gt|quot|#[0-9]+);",
    "newline or tab": r"[\n\r\t]",
    "untrimmed": r"^[\s\p{Z}]|[\s\p{Z}]$",
    "double space": r"  +",
    "markdown": r"(?m)\*\*.+?\*\*|^#{1,6}\s|\[[^\]]*\]\([^)]*\)",
}
OPTIONS = ["option_a", "option_b", "option_c", "option_d", "option_e"]


@dataclass(frozen=True)
class Rule:
    """A test of single rows of a sheet: what it is called, which column it is about, and when a row breaks it."""

    name: str
    column: str
    breaks: Column
    severity: str = "fail"


def hygiene_rules(columns: Sequence[str]) -> list[Rule]:
    """The cell checks for those of the columns that people read.

    One pattern of all checks comes first, so a clean cell is looked at once, and its result is shared.
    """
    any_of = "|".join(f"(?:{p})" for p in HYGIENE.values())
    return [Rule(name, c, F.coalesce(F.col(c).rlike(any_of) & F.col(c).rlike(p), F.lit(False))) for c in columns if c in TEXT_COLUMNS for name, p in HYGIENE.items()]


def violations(rows: DataFrame, rules: Sequence[Rule], line: Column, group: Sequence[str] = ()) -> DataFrame:
    """rule, column, severity, n and first line of each broken rule: one aggregate over the sheet, however many rules."""
    aggs = []
    for k, r in enumerate(rules):
        aggs += [F.count_if(r.breaks).alias(f"_n{k}"), F.min(F.when(r.breaks, line)).alias(f"_l{k}")]
    held = rows.groupBy(*group).agg(*aggs)
    each = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.column).alias("column"), F.lit(r.severity).alias("severity"), F.col(f"_n{k}").alias("n"), F.col(f"_l{k}").alias("first_line")) for k, r in enumerate(rules)])
    return held.select(*group, F.explode(each).alias("_e")).select(*group, "_e.*").where("n > 0")


def taxonomy(rows: DataFrame, line: Column, closed: Mapping[str, Sequence[str]] = CLOSED, open_: Mapping[str, Sequence[str]] = OPEN) -> DataFrame:
    """column, value, n, first_line, finding of each value that is no good: beyond ASCII, not in a closed vocabulary,
    prose made into a slug, or drift from the known values of an open one."""
    named = [c for c in (*closed, *open_) if c in rows.columns]
    cells = [_cells(c) for c in named]
    each = rows.select(line.alias("_line"), F.explode(F.concat(*cells)).alias("_e")).select("_line", "_e.column", "_e.value").where(F.coalesce(F.col("value"), F.lit("")) != "")
    seen = each.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"), F.min("_line").alias("first_line"))
    finding = F.when(X.non_ascii(F.col("value")), "non-ascii")
    for c, values in closed.items():
        finding = finding.when((F.col("column") == c) & ~F.col("value").isin(*values), "not in the closed vocabulary")
    for c, values in open_.items():
        if values:
            other = (F.col("column") == c) & ~F.col("value").isin(*values)
            finding = finding.when(other & X.slug_like(F.col("value")), "slugified prose").when(other, "drift")
    return seen.withColumn("finding", finding).where("finding is not null")


def _cells(column: str) -> Column:
    items = X.list_items(F.col(column)) if column == "content_type" else F.array(X.strip(F.col(column)))
    return F.coalesce(F.transform(items, lambda v: F.struct(F.lit(column).alias("column"), v.alias("value"))), F.array().cast("array<struct<column:string,value:string>>"))


def choice_without_options(items: DataFrame) -> DataFrame:
    """Multiple-choice items without a single option."""
    return items.where((F.col("item_type") == "multiple-choice") & ~F.greatest(*[X.filled(F.col(c)) for c in OPTIONS]))


def waived(items: DataFrame, accepted: DataFrame, book: str = "collection") -> DataFrame:
    """Items that weren't accepted one by one. ``accepted``: book, keys (an array of page/item)."""
    known = accepted.select(F.col(book).alias("_book"), F.explode("keys").alias("_key")).distinct()
    key = F.concat_ws("/", F.col("source_page").cast("string"), F.col("item").cast("string"))
    return items.withColumn("_own", key).join(known, (items[book] == known["_book"]) & (F.col("_own") == F.col("_key")), "left_anti").drop("_own")


def metadata_gaps(books: DataFrame) -> DataFrame:
    """slug and missing: what a book doesn't say of itself. A missing list is a gap, an empty one an answer."""
    known = ["printed", "separate-guide", "partial", "none"]
    status = F.col("answer_key_status")
    gaps = F.array_compact(F.array(
        F.when(~X.filled(status), "answer_key.status").when(~status.isin(*known), F.concat(F.lit("answer_key.status="), status)),
        F.when(F.col("caveats").isNull(), "caveats"),
    ))
    return books.select("slug", gaps.alias("missing")).where(F.size("missing") > 0)


def ragged_rows(lines: DataFrame, width: int, fields: Column, line: Column) -> DataFrame:
    """How many lines of a file have another number of fields than its header, and the first of them."""
    off = F.size(fields) != width
    return lines.agg(F.count_if(off).alias("n"), F.min(F.when(off, line)).alias("first_line"))


def document_issues(documents: DataFrame, schema: str, rules: Mapping[str, Column], json: str = "json") -> DataFrame:
    """A row for each rule that a JSON document breaks, and one for each that is no JSON of the schema; nothing stops at the first."""
    # A permissive parse gives a struct of nulls for broken JSON, so that is told apart first.
    parsed = documents.withColumn("_doc", F.when(F.try_parse_json(json).isNotNull(), F.from_json(json, schema)))
    issues = [F.when(F.col("_doc").isNull(), F.struct(F.lit("").alias("path"), F.lit("unreadable").alias("message")))]
    issues += [F.when(F.col("_doc").isNotNull() & ~F.coalesce(ok, F.lit(False)), F.struct(F.lit(path).alias("path"), F.lit("invalid").alias("message"))) for path, ok in rules.items()]
    return parsed.select(*[c for c in documents.columns if c != json], F.explode(F.array_compact(F.array(*issues))).alias("_e")).select(*[c for c in documents.columns if c != json], "_e.*")


def passes(found: DataFrame, strict: bool = False) -> bool:
    """Whether nothing failed; with ``strict``, whether nothing was found at all. Looks for one row only."""
    bad = found if strict else found.where("severity = 'fail'")
    return not bad.limit(1).collect()
