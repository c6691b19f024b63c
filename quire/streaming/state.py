"""Keyed state kept up to date: upserts in batches and from streams, staleness, status."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.operators.merge import last_write_wins


def upsert(state: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The state with each changed key's last change in place of its row; other rows stay, new keys are added."""
    last = last_write_wins(changes, keys, order).select(*state.columns)
    return state.join(last.select(*keys), list(keys), "left_anti").unionByName(last)


def stale(pages: DataFrame, state: DataFrame, key: str = "slug", digest: str = "content_hash") -> DataFrame:
    """Pages to fetch again: not known, changed, or not verified."""
    known = state.select(key, F.col(digest).alias("_known"), F.col("status").alias("_status"))
    joined = pages.join(known, key, "left")
    return joined.where(F.col("_known").isNull() | (F.col("_known") != F.col(digest)) | (F.coalesce("_status", F.lit("")) != "verified")).select(*pages.columns)


def next_status(status: Column, has_text: Column, verdict: Column) -> Column:
    """pending until there is text, then transcribed, then verified or failed by the verdict."""
    return F.when(~has_text, "pending").when(verdict.isNull(), F.when(status == "verified", status).otherwise("transcribed")).when(verdict, "verified").otherwise("failed")


def outcomes(results: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """Results without an error, and those in quarantine; one bad row doesn't stop the others."""
    bad = F.coalesce(F.trim(error) != "", F.lit(False))
    return results.where(~bad), results.where(bad)


def to_retry(results: DataFrame, most: int, error: str = "error", attempt: str = "attempt") -> DataFrame:
    """Failed results that may be tried again."""
    return outcomes(results, error)[1].where(F.col(attempt) <= most)


class StateTable:
    """A Parquet table of keyed state, replaced as a whole by versions, so that readers see the old or the new one.

    A stream's batch that is delivered again gives the same version: its number is the batch's.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str], order: Sequence[str]):
        self.spark, self.path, self.schema, self.keys, self.order = spark, path, schema, list(keys), list(order)

    def _versions(self) -> list[int]:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        at = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = at.getFileSystem(conf)
        if not fs.exists(at):
            return []
        done = [s.getPath() for s in fs.listStatus(at) if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
        return sorted(int(p.getName()[1:]) for p in done)

    def read(self, before: int | None = None) -> DataFrame:
        """The last whole version, or the last before a number; empty if there is none."""
        held = [v for v in self._versions() if before is None or v < before]
        if not held:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(os.path.join(self.path, f"v{held[-1]:012d}"))

    def apply(self, changes: DataFrame, number: int) -> None:
        """Writes version ``number`` from the one before it and the changes."""
        new = upsert(self.read(number), changes.select(*self.read(number).columns), self.keys, self.order)
        new.write.mode("overwrite").parquet(os.path.join(self.path, f"v{number:012d}"))

    def follow(self, changes: DataFrame, checkpoint: str) -> StreamingQuery:
        """Applies a stream of changes, all that is there now, and ends."""
        return changes.writeStream.foreachBatch(lambda df, k: self.apply(df, k + 1)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
