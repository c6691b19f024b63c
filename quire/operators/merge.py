"""Overlapping extracts brought together with explicit precedence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import text as X


def last_write_wins(rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row for each key, the last by ``order``; add a file name and a place to break ties.

    A partial aggregate keeps one row per key and map task, so a key that holds a third of all rows
    costs its reducer no more than any other.
    """
    rest = [c for c in rows.columns if c not in keys]
    by = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias("_row")).select(*keys, "_row.*").select(*rows.columns)


def keep_first(rows: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column]) -> DataFrame:
    """One row for each key, the first by ``order``; keys may be expressions, and null is a key of its own."""
    named = [(k if isinstance(k, Column) else F.col(k)).alias(f"_k{i}") for i, k in enumerate(keys)]
    by = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    return rows.groupBy(*named).agg(F.min_by(F.struct(*rows.columns), by).alias("_row")).select("_row.*")


def overwrites(rows: DataFrame, group: Sequence[str], key: str) -> DataFrame:
    """For each group the rows that a later one with the same key replaces."""
    per_key = rows.groupBy(*group, key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.groupBy(*group).agg(F.sum(F.col("_n") - 1).cast("bigint").alias("overwrites"))


def collisions(rows: DataFrame, keys: Sequence[str], origin: str) -> DataFrame:
    """Keys that come from more than one origin, and from how many; repeats within one origin are no collision."""
    spread = rows.select(*[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in keys], origin).distinct()
    return spread.groupBy(*keys).agg(F.count(origin).alias("origins")).where("origins > 1")


def vocabulary_entries(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Entries with a headword, the first of each (headword in lower case, article, page) of a collection."""
    kept = rows.where(X.filled(F.col("word")))
    keys = ["collection", F.lower(X.strip(F.col("word"))), F.coalesce("article", F.lit("")), F.coalesce("source_page", F.lit(""))]
    return keep_first(kept, keys, order)


def resequence(rows: DataFrame, group: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Numbers from 0 within each group, in order."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)) - 1)


def repeated_blocks(nodes: DataFrame, group: str = "page_id", order: str = "ord", kinds: Sequence[str] = ("heading", "paragraph", "quote")) -> DataFrame:
    """``nodes`` with ``repeat``: whether a block of these kinds stood on its page before; other kinds never repeat."""
    place = F.row_number().over(Window.partitionBy(group, "type", "text").orderBy(order))
    return nodes.withColumn("repeat", F.col("type").isin(*kinds) & (place > 1))


def without_repeats(nodes: DataFrame, group: str = "page_id", order: str = "ord") -> DataFrame:
    """Blocks without repeats, numbered anew."""
    return resequence(repeated_blocks(nodes, group, order).where("not repeat").drop("repeat"), [group], [order], order)


def running_ids(assets: DataFrame, group: str, order: Sequence[str], prefix: Column, name: str = "asset_id") -> DataFrame:
    """A prefix and a number in one sequence over all assets of a page."""
    n = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return assets.withColumn(name, F.concat(prefix, n.cast("string")))
