"""Segments of transcribed speech: which are unsure, and how they read as a text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as X


def low_confidence(avg_logprob: Column, no_speech_prob: Column) -> Column:
    return F.coalesce((avg_logprob < -1.0) | (no_speech_prob > 0.6), F.lit(False))


def flagged(segments: DataFrame) -> DataFrame:
    return segments.withColumn("low_confidence", low_confidence(F.col("avg_logprob"), F.col("no_speech_prob")))


def transcript(segments: DataFrame, key: str = "track") -> DataFrame:
    """key, text, segments, unsure: a track's segments in order, each with its time; unsure ones are marked."""
    line = F.concat(F.lit("["), X.clock(F.col("start")), F.lit("] "), F.trim("text"), F.when(F.col("low_confidence"), " (?)").otherwise(""))
    rows = flagged(segments).select(key, "low_confidence", F.struct("start", "end", line.alias("line")).alias("_s"))
    held = rows.groupBy(key).agg(F.array_sort(F.collect_list("_s")).alias("_all"), F.count(F.lit(1)).alias("segments"), F.count_if("low_confidence").alias("unsure"))
    return held.select(key, F.array_join(F.transform("_all", lambda s: s["line"]), "\n").alias("text"), "segments", "unsure")
