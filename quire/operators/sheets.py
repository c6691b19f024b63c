"""The three sheets built from pages and extracted records, and the roll-ups over books."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators.merge import resequence
from quire.operators.quality import CANONICAL
from quire.operators.relations import enrich


def columns(kind: str, omit: Mapping[str, Sequence[str]] | None = None) -> list[str]:
    """A sheet's columns in canonical order, without those a language declares it can't fill."""
    left_out = set((omit or {}).get(kind, ()))
    return [c for c in CANONICAL[kind] if c not in left_out]


def engine_books(books: DataFrame) -> DataFrame:
    """Books of this pipeline: the default one, or none named."""
    return books.where(F.coalesce(F.nullif("pipeline", F.lit("")), F.lit("engine")) == "engine")


def targets(books: DataFrame, slugs: Sequence[str] | None = None) -> DataFrame:
    """All books, or those asked for."""
    return books if slugs is None else books.where(F.col("slug").isin(*slugs))


def writable(rows: DataFrame, books: DataFrame, include_frozen: bool = False) -> DataFrame:
    """Rows of books whose files may be written; frozen books still count in every aggregate."""
    frozen = books.where("frozen").select(F.col("slug").alias("collection"))
    return rows if include_frozen else rows.join(frozen, "collection", "left_anti")


def catalog(pages: DataFrame, classes: DataFrame, books: DataFrame, bare_lists: bool = False) -> DataFrame:
    """The catalog sheet: pages (collection, unit, page), their class records (collection, page number), book levels.

    ``level`` falls back to the book's only where a page doesn't name it; a page that leaves it blank keeps that.
    """
    fm, text = X.frontmatter(F.col("page")), X.body(F.col("page"))
    rows = pages.withColumn("_fm", fm).withColumn("_body", text).withColumn("_no", F.regexp_extract("unit", r"(\d+)$", 1).cast("int"))
    rows = rows.join(books.select(F.col("slug").alias("collection"), F.col("level").alias("_level")), "collection", "left")
    named = classes.select("collection", F.col("page").cast("int").alias("_no"), "activity_type", "topic", "summary")
    rows = enrich(rows, named, ["collection", "_no"], {"activity_type": "", "topic": "", "summary": ""})
    of = lambda k: F.coalesce(F.col("_fm")[k], F.lit(""))
    listed = X.strip_brackets(of("content_type")) if bare_lists else F.trim(of("content_type"))
    return rows.select(
        "collection", "unit", X.unquote(of("section")).alias("section"), X.unquote(of("chapter")).alias("chapter"), listed.alias("content_type"), "activity_type", "topic",
        F.coalesce(F.col("_fm")["level"], F.col("_level"), F.lit("")).alias("level"), of("status").alias("status"), of("qa").alias("qa"),
        X.word_count(F.col("_body")).alias("word_count"), "summary", X.page_title(F.col("_body")).alias("title"),
    )


def questions(items: DataFrame, books: DataFrame) -> DataFrame:
    """The questions sheet: each field as one clean cell; a missing level is the book's, a blank one stays blank."""
    joined = items.join(books.select(F.col("slug").alias("collection"), F.col("level").alias("_level")), "collection", "left")
    cells = [X.flat(F.coalesce(F.col("level"), F.col("_level"))).alias("level") if c == "level" else X.flat(F.col(c)).alias(c) for c in CANONICAL["questions"] if c in joined.columns]
    return joined.select(*cells)


def vocabulary(entries: DataFrame) -> DataFrame:
    """The vocabulary sheet: each field as one clean cell; the gender is its own or what the headword shows."""
    gender = F.coalesce(F.nullif(F.col("gender"), F.lit("")), X.gender_of(F.col("word")))
    return entries.select(*[X.flat(gender if c == "gender" else F.col(c)).alias(c) for c in CANONICAL["vocabulary"] if c in entries.columns])


def tag_line(*parts: Column) -> Column:
    """The parts that aren't empty, joined by hyphens."""
    return F.array_join(F.filter(F.array(*[F.coalesce(p, F.lit("")) for p in parts]), lambda x: x != ""), " - ")


def display_title(books: DataFrame) -> Column:
    """A book's title, or its level, variant and file name made into one; parts that are missing leave their place empty."""
    named = lambda c: X.title_cased(F.replace(c, F.lit("-"), F.lit(" ")))
    variant = named(F.coalesce("variant", F.lit(""))) if "variant" in books.columns else F.lit("")
    stem = named(X.path_stem(F.coalesce(F.nullif("pdf", F.lit("")), F.col("slug"))))
    return F.coalesce(F.nullif("title", F.lit("")), F.concat_ws(" - ", F.coalesce("level", F.lit("")), variant, stem))


def book_counts(books: DataFrame, pages: DataFrame, items: DataFrame, words: DataFrame) -> DataFrame:
    """Each book with its pages, questions and words, 0 where it has none."""
    out = books.select(F.col("slug").alias("collection"), "family", "lang")
    for name, df in (("pages", pages), ("questions", items), ("words", words)):
        out = enrich(out, df.groupBy("collection").agg(F.count(F.lit(1)).alias(name)), ["collection"], {name: 0})
    return out


def build_counters(pages: DataFrame, items: DataFrame) -> DataFrame:
    """collection, classified, answered: pages with an activity, and items with an answer that says something."""
    told = pages.groupBy("collection").agg(F.count_if(X.filled(F.col("activity_type"))).alias("classified"))
    answer = X.strip(F.coalesce("correct_answer", F.lit("")))
    done = items.groupBy("collection").agg(F.count_if((answer != "") & (answer != "(open-ended)")).alias("answered"))
    return told.join(done, "collection", "full_outer").select("collection", F.coalesce("classified", F.lit(0)).alias("classified"), F.coalesce("answered", F.lit(0)).alias("answered"))


def in_order(items: DataFrame, tie: str, name: str = "place") -> DataFrame:
    """Items numbered from 0 within their book, by page and item as texts, so that 10 stands before 2."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return resequence(items, ["collection"], [text("source_page"), text("item"), tie], name)


def combined_families(counts: DataFrame, least: int = 2) -> DataFrame:
    """family, books: families with so many live books that a combined sheet is worth it."""
    return live(counts).groupBy("family").agg(F.count(F.lit(1)).alias("books")).where(F.col("books") >= least)


def item_count(json: Column) -> Column:
    """The items or entries of a merged file, or of a bare list; -1 for what can't be read."""
    held = F.when(F.try_parse_json(json).isNotNull(), json)
    of = [F.json_array_length(F.get_json_object(held, "$.items")), F.json_array_length(F.get_json_object(held, "$.entries")), F.json_array_length(held)]
    return F.coalesce(*of, F.lit(-1))


def live(counts: DataFrame) -> DataFrame:
    """Books with anything in them."""
    return counts.where(F.greatest("pages", "questions", "words") > 0)


def state_label(status: Column, transcribed: Column) -> Column:
    return F.when(F.coalesce(status, F.lit("")).rlike("(?i)complete"), "complete").when(transcribed > 0, "in progress").otherwise("planned")


def document(catalog_rows: DataFrame) -> DataFrame:
    """collection, text: the page index of each book as one Markdown table, pages in order.

    A document is one file, so its pages come together in one row; a book has a bounded number of pages.
    """
    line = F.concat(F.lit("| "), F.concat_ws(" | ", F.replace("unit", F.lit("page-"), F.lit("")), "section", "activity_type", "topic", X.cell_for_table(F.coalesce(F.nullif("summary", F.lit("")), F.col("title")))), F.lit(" |"))
    rows = catalog_rows.select("collection", F.struct("unit", line.alias("line")).alias("_r"))
    return rows.groupBy("collection").agg(F.array_join(F.transform(F.array_sort(F.collect_list("_r")), lambda r: r["line"]), "\n").alias("text"))


def start_page(counts: DataFrame, language: str, most: int = 10_000) -> str:
    """A page of orientation with the totals of all live books and a line for each; refuses more books than ``most``."""
    rows = live(counts).orderBy("family", "collection").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} books")
    total = [sum(r[c] for r in rows) for c in ("pages", "questions", "words")]
    lines = [f"# {language}", "", f"{len(rows):,} books, {total[0]:,} pages, {total[1]:,} questions, {total[2]:,} words.", "", "| Book | Pages | Questions | Words |", "|---|---|---|---|"]
    return "\n".join([*lines, *[f"| {r.collection} | {r.pages:,} | {r.questions:,} | {r.words:,} |" for r in rows], ""])
