"""Files as DataFrames: pages with frontmatter, chunk files, verdicts, sheets, manifests, sitemaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators.merge import last_write_wins, vocabulary_entries

CLASS_ITEM = "struct<page:string,activity_type:string,topic:string,summary:string>"
QUESTION_ITEM = "struct<section:string,part:string,item:string,item_type:string,instruction:string,question:string,option_a:string,option_b:string,option_c:string,option_d:string,option_e:string,correct_answer:string,level:string,topic:string,source_page:string>"
VOCABULARY_ITEM = "struct<word:string,translation:string,article:string,gender:string,plural:string,word_class:string,example:string,topic:string,source_page:string>"
BOOK = "slug string, family string, title string, lang string, level string, level_mode string, level_options array<string>, pdf string, pipeline string, frozen boolean, caveats array<string>, accepted_qa_gaps array<int>, accepted_answer_flags array<string>, accepted_option_gaps array<string>, answer_key struct<status:string>, expect_coverage map<string,double>"
MANIFEST = ["collection", "unit", "source_type", "status", "orientation", "content_type", "level", "section", "qa", "notes"]


def _book(file_path: Column, below: str) -> Column:
    """The folder that holds ``below``: the book's slug."""
    return F.regexp_extract(file_path, rf"([^/]+)/{below}", 1)


def pages(spark: SparkSession, root: str) -> DataFrame:
    """collection, unit, page, modified: each ``<book>/pages/page-NNN.md`` whole."""
    df = spark.read.text(f"{root}/*/pages/page-*.md", wholetext=True)
    name = F.col("_metadata.file_name")
    return df.select(
        _book(F.col("_metadata.file_path"), "pages/").alias("collection"),
        F.concat(F.lit("page-"), F.substring(name, 6, 3)).alias("unit"),
        F.col("value").alias("page"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def chunks(spark: SparkSession, root: str, kind: str, item: str, field: str = "items") -> DataFrame:
    """collection, chunk, modified, pos and the fields of each record of ``<book>/pages/<kind>/chunk-*.json``.

    A record list may stand alone or under ``items`` or ``entries``; a file that can't be read gives nothing.
    """
    raw = spark.read.text(f"{root}/*/pages/{kind}/chunk-*.json", wholetext=True)
    text = F.col("value")
    records = F.coalesce(F.from_json(text, f"struct<{field}:array<{item}>>")[field], F.from_json(text, f"struct<items:array<{item}>>")["items"], F.from_json(text, f"array<{item}>"))
    held = raw.select(_book(F.col("_metadata.file_path"), "pages/").alias("collection"), F.col("_metadata.file_name").alias("chunk"), F.col("_metadata.file_modification_time").alias("modified"), F.posexplode(records).alias("pos", "_r"))
    return held.select("collection", "chunk", "modified", "pos", "_r.*")


def classes(spark: SparkSession, root: str, by_name: bool = False) -> DataFrame:
    """The class record of each page: the one written last, or, with ``by_name``, the first by file name."""
    rows = chunks(spark, root, "_class", CLASS_ITEM).withColumn("page", F.col("page").cast("int"))
    if by_name:
        from quire.operators.merge import keep_first

        return keep_first(rows, ["collection", "page"], ["chunk", "pos"])
    return last_write_wins(rows, ["collection", "page"], ["modified", "chunk", "pos"])


def questions(spark: SparkSession, root: str) -> DataFrame:
    """All question records, each with its chunk; they have no natural key, so none is dropped."""
    return chunks(spark, root, "_questions", QUESTION_ITEM)


def vocabulary(spark: SparkSession, root: str) -> DataFrame:
    """Entries with a headword, the first of equals by file name and place, ordered by page and headword."""
    rows = chunks(spark, root, "_vocab", VOCABULARY_ITEM, "entries")
    return vocabulary_entries(rows, ["chunk", "pos"]).orderBy("collection", F.coalesce("source_page", F.lit("")), F.lower("word"), "chunk", "pos")


def verdicts(spark: SparkSession, root: str) -> DataFrame:
    """collection, unit, ok, missing_count, issues of each ``<book>/pages/_qa/page-NNN.json``; what can't be read is not ok."""
    df = spark.read.text(f"{root}/*/pages/_qa/page-*.json", wholetext=True)
    v = F.from_json("value", "ok boolean, missing_count int, issues array<string>")
    return df.select(
        _book(F.col("_metadata.file_path"), "pages/_qa/").alias("collection"),
        F.concat(F.lit("page-"), F.substring("_metadata.file_name", 6, 3)).alias("unit"),
        F.coalesce(v["ok"] & (F.coalesce(v["missing_count"], F.lit(0)) == 0), F.lit(False)).alias("ok"),
        v["missing_count"].alias("missing_count"),
        v["issues"].alias("issues"),
    )


def books(spark: SparkSession, path: str) -> DataFrame:
    """The collections of a configuration file. A missing list stays null, an empty one empty."""
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.explode(F.from_json("value", f"struct<collections:array<struct<{_ddl(BOOK)}>>>")["collections"]).alias("_c")).select("_c.*")


def _ddl(columns: str) -> str:
    import re

    return re.sub(r"(\w+) (?=[a-z])", r"\1:", columns)


def tsv(spark: SparkSession, path: str, columns: list[str] = MANIFEST) -> DataFrame:
    """A table of tab-separated lines: header and blank lines skipped, short lines filled up with ''."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    cells = F.split("value", "\t")
    rows = lines.select(*[F.coalesce(F.get(cells, F.lit(k)), F.lit("")).alias(c) for k, c in enumerate(columns)])
    return rows.where(F.col(columns[0]) != columns[0])


def sheet(spark: SparkSession, path: str) -> DataFrame:
    """A comma-separated sheet with quoted cells over several lines, blanks as '', a byte order mark dropped."""
    df = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', nullValue="\u0000", emptyValue="")
    return df.toDF(*[c.lstrip("\ufeff") for c in df.columns]).na.fill("")


def sheet_size(spark: SparkSession, path: str) -> tuple[list[str], int]:
    """A sheet's columns and its number of records."""
    df = sheet(spark, path)
    return df.columns, df.count()


def header_window(spark: SparkSession, root: str, signs: int = 600) -> DataFrame:
    """collection, unit, status, qa of each page, from its first signs only."""
    head = F.substring("page", 1, signs)
    return pages(spark, root).select("collection", "unit", F.regexp_extract(head, r"(?m)^status:[ \t]*(\S+)", 1).alias("status"), F.regexp_extract(head, r"(?m)^qa:[ \t]*(\S+)", 1).alias("qa"))


def expected_units(counts: DataFrame, number: str = "pages") -> DataFrame:
    """collection, unit: pages 1 to the number of each book."""
    return counts.where(F.col(number) > 0).select("collection", F.explode(F.sequence(F.lit(1), F.col(number).cast("int"))).alias("_n")).select("collection", X.unit_label(F.col("_n")).alias("unit"))


def revisions(spark: SparkSession, old: str, new: str, kind: str, item: str) -> tuple[DataFrame, DataFrame]:
    """The same chunk files of two snapshots."""
    return chunks(spark, old, kind, item), chunks(spark, new, kind, item)


def images(spark: SparkSession, path: str) -> DataFrame:
    """path and content of image files, for a histogram UDF."""
    return spark.read.format("binaryFile").load(path).select("path", "content")
