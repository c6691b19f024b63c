"""Queries of the training-text operators, for the driver."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import canon, copies, encoding, leaks, lookalike, pairs, textstats, truncation
from quire.session import table


def _p1_rows(spark: SparkSession, folder: str) -> DataFrame:
    pages, questions = table(spark, folder, "catalog_pages"), table(spark, folder, "questions")
    summary = pages.select(F.lit("summary").alias("kind"), F.col("catalog_id").cast("bigint").alias("row_id"), F.col("collection").alias("source"), F.col("summary").alias("text"))
    return summary.unionByName(questions.select(F.lit("question").alias("kind"), F.col("question_id").cast("bigint").alias("row_id"), F.col("collection").alias("source"), F.col("question").alias("text")))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return truncation.inspect(_p1_rows(spark, folder)).where("cut").select(F.col("kind").alias("field_name"), "row_id")


def p1_sources(spark: SparkSession, folder: str) -> DataFrame:
    """For each field and book the share of its rows that lost their end."""
    return truncation.by_source(_p1_rows(spark, folder)).select(F.col("kind").alias("field_name"), F.col("source").alias("collection"), "n", "n_cut", "share")


def p1_limits(spark: SparkSession, folder: str) -> DataFrame:
    """The storage limits of fields and books, and the encoding in which each was counted."""
    return truncation.limits(_p1_rows(spark, folder)).select(F.col("kind").alias("field_name"), F.col("source").alias("collection"), "encoding", "limit", "at", "beyond")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return pairs.found(table(spark, folder, "questions"))


def p2_defects(spark: SparkSession, folder: str) -> DataFrame:
    """All defects that an item keeps, with their posteriors."""
    return pairs.defects(table(spark, folder, "questions"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    pages, questions = table(spark, folder, "catalog_pages"), table(spark, folder, "questions")
    tables = {"section": (pages, "catalog_id"), "topic": (pages, "catalog_id"), "level": (questions, "question_id")}
    return canon.found(tables, table(spark, folder, "canon_entries"))


def p3_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    """Field and value of each unmatched entry, and the number of its rows."""
    pages, questions = table(spark, folder, "catalog_pages"), table(spark, folder, "questions")
    values = (
        pages.select(F.lit("section").alias("field_name"), F.col("section").alias("value"))
        .unionByName(pages.select(F.lit("topic").alias("field_name"), F.col("topic").alias("value")))
        .unionByName(questions.select(F.lit("level").alias("field_name"), F.col("level").alias("value")))
    )
    counts = values.groupBy("field_name", "value").agg(F.count(F.lit(1)).alias("n"))
    none = canon.match(values, table(spark, folder, "canon_entries")).where("canon_id = -1")
    return counts.join(none, ["field_name", "value"]).select("field_name", "value", "n")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return copies.copies(table(spark, folder, "vocabulary"))


def p4_entries(spark: SparkSession, folder: str) -> DataFrame:
    return copies.entries(table(spark, folder, "vocabulary"))


def _p5_texts(spark: SparkSession, folder: str) -> DataFrame:
    questions, words = table(spark, folder, "questions"), table(spark, folder, "vocabulary")
    fields = ((questions, "question_id", "question"), (words, "vocab_id", "word"), (words, "vocab_id", "translation"))
    parts = [df.select(F.lit(name).alias("field_name"), F.col(key).cast("bigint").alias("row_id"), F.col(name).alias("text")) for df, key, name in fields]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return lookalike.cases(_p5_texts(spark, folder)).select("field_name", "row_id")


def p5_clean(spark: SparkSession, folder: str) -> DataFrame:
    """All texts in one consistent form."""
    return lookalike.normalise(_p5_texts(spark, folder)).select("field_name", "row_id", "clean")


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encoding.encode(table(spark, folder, "documents"))


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    return leaks.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark")).select("doc_id", "item_id")


def p8_items(spark: SparkSession, folder: str) -> DataFrame:
    """Each leaked item: the number of documents that hold a passage of it."""
    return p8_found(spark, folder).groupBy("item_id").agg(F.count(F.lit(1)).alias("documents"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return textstats.found(table(spark, folder, "documents"))


def p9_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return textstats.statistics(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (p1_found, p1_sources, p1_limits, p2_found, p2_defects, p3_found, p3_unmatched, p4_found, p4_entries, p5_found, p5_clean, p7_ids, p8_found, p8_items, p9_found, p9_statistics)
}
