"""Problem 1: texts cut off by a field limit or in transfer, and each source's share of them.

The lengths of a source's values are recomputed under several encodings; a storage limit shows as a
length, in one of them, at which values pile up and beyond which there are hardly any. Then the endings
are inspected: a value at its source's limit is cut unless it ends as a whole one does, and any other
value is cut if it stops where no value of its field ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm import lookalike
from quire.llm.endings import judge, marked, shown
from quire.session import cut

#: A limit needs so many values at it, so many times as many as at the lengths before it, and beyond it at most this share of them.
LEAST, TIMES, BEYOND = 5, 1.5, 0.1
#: By the lengths of all sources so many values would be beyond it, and at least this share of these is at it.
MISSED, MOVED = 4.0, 0.4
#: Where fewer than MISSED would be beyond it, the pile-up alone decides: so many values at it, and so many times as many as at the lengths before it.
ALONE, TIMES_ALONE = 20, 8.0
#: So many lengths before the limit tell how many values would be expected at it.
BEFORE = 8


def lengths(text: Column) -> dict[str, Column]:
    """The text's length as it may have been counted: signs, bytes, and signs after escaping."""

    def count(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern))

    signs, size = F.char_length(text), F.octet_length(text)
    wide = count(r"[^\x00-\x7f]")
    entities = 4 * count("&") + 3 * count("[<>]") + 5 * count('"') + 4 * count("'")
    escapes = count(r'["\\\n\r\t]')
    return {
        "characters": signs,
        "shown": F.char_length(shown(text)),
        "utf-8": size,
        "utf-16": signs + count(r"[\x{10000}-\x{10ffff}]"),
        "html": signs + entities,
        "html-ascii": signs + entities + 5 * wide,
        "json": size + escapes,
        "json-ascii": signs + escapes + 5 * wide,
        "crlf": signs + count(r"\n"),
    }


def limits(rows: DataFrame) -> DataFrame:
    """kind, source, encoding, limit, at, beyond: the storage limit of each field of a source, if it has one.

    ``rows`` has kind, source and text; null and blank texts don't count, a null source is a source. Of the
    encodings the one with the sharpest limit is given. Counts are taken over all rows.
    """
    cols = lengths(F.col("text"))
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("order"), F.lit(name).alias("encoding"), c.cast("int").alias("length")) for k, (name, c) in enumerate(cols.items())]))
    counts = rows.where(F.col("text").rlike(r"\S")).select("kind", "source", each.alias("e")).groupBy("kind", "source", "e.order", "e.encoding", "e.length").count()
    by = Window.partitionBy("kind", "source", "encoding")
    near = by.orderBy("length").rangeBetween(-BEFORE, -1)
    counted = counts.withColumns({
        "before": F.coalesce(F.sum("count").over(near), F.lit(0)) / BEFORE,
        "beyond": F.coalesce(F.sum("count").over(by.orderBy("length").rangeBetween(1, Window.unboundedFollowing)), F.lit(0)),
    })
    # What all sources together have beyond each length, as a share of their values.
    whole = counts.groupBy("kind", "encoding", "length").agg(F.sum("count").alias("all"))
    every = Window.partitionBy("kind", "encoding")
    whole = whole.withColumn("tail", F.coalesce(F.sum("all").over(every.orderBy("length").rangeBetween(1, Window.unboundedFollowing)), F.lit(0)) / F.sum("all").over(every)).drop("all")
    counted = counted.withColumn("n", F.sum("count").over(by)).join(whole, ["kind", "encoding", "length"]).withColumn("expected", F.col("n") * F.col("tail"))
    told = (F.col("expected") >= MISSED) & (F.col("count") >= MOVED * F.col("expected"))
    # With one source, or one limit in all of them, nothing is longer anywhere.
    alone = (F.col("expected") < MISSED) & (F.col("count") >= ALONE) & (F.col("count") >= TIMES_ALONE * (F.col("before") + 0.5))
    counted = counted.where(told | alone)
    sharp = counted.where((F.col("count") >= LEAST) & (F.col("count") >= TIMES * (F.col("before") + 0.5)) & (F.col("beyond") <= BEYOND * F.col("count")))
    score = F.struct((F.col("count") - 2 * F.col("beyond")).alias("score"), (-F.col("order")).alias("order"), "encoding", F.col("length").alias("limit"), F.col("count").alias("at"), "beyond")
    best = sharp.groupBy("kind", "source").agg(F.max(score).alias("b"))
    return best.select("kind", "source", "b.encoding", "b.limit", "b.at", "b.beyond")


def at_limit(text: Column, encoding: Column, limit: Column) -> Column:
    """Whether the text's length in the encoding is the limit; in bytes or escapes a last sign may not have fitted."""
    out = F.lit(False)
    for name, c in lengths(text).items():
        slack = {"utf-8": 3, "json": 3, "html": 5, "html-ascii": 6, "json-ascii": 5}.get(name, 0)
        out = F.when(encoding == name, (c <= limit) & (c >= limit - slack)).otherwise(out)
    return F.coalesce(out, F.lit(False))


def inspect(rows: DataFrame) -> DataFrame:
    """kind, row_id, source, cut: whether each value lost its end.

    ``rows`` has kind, row_id, source and text. Null and blank values are not cut; repeated rows count each.
    Values are brought to one form first, so that odd characters don't hide how they end. Each distinct
    value is judged once, over the counts of all; rows meet their source's limit and their
    value's judgement in two joins, whose hot keys are left to AQE's skew join.
    """
    rows = cut(lookalike.normalise(rows.select("kind", "row_id", "source", "text")).select("kind", "row_id", "source", "text", "clean"))
    found = cut(limits(rows))
    met = rows.join(found.select("kind", F.col("source").alias("_source"), "encoding", "limit"), (rows["kind"] == found["kind"]) & rows["source"].eqNullSafe(F.col("_source")), "left").select(
        rows["kind"], "row_id", "source", "text", "clean", "encoding", "limit"
    )
    met = met.withColumn("full", F.when(F.col("limit").isNotNull(), at_limit(F.col("text"), F.col("encoding"), F.col("limit")) | at_limit(F.col("clean"), F.col("encoding"), F.col("limit"))).otherwise(F.lit(False)))
    met = cut(met.select("kind", "row_id", "source", "full", F.col("clean").alias("text")))
    values = met.where("text is not null").groupBy("kind", "text").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("full")).alias("whole"))
    early = judge(values).where("early").select("kind", "text", "early")
    judged = met.join(early, ["kind", "text"], "left")
    lost = F.coalesce("early", F.lit(False)) | (F.col("full") & ~marked(F.col("text")))
    return judged.select("kind", "row_id", "source", (F.coalesce(lost, F.lit(False)) & F.coalesce(F.col("text").rlike(r"\S"), F.lit(False))).alias("cut"))


def by_source(rows: DataFrame) -> DataFrame:
    """kind, source, n, n_cut, share: how often each source truncates each field."""
    return (
        inspect(rows)
        .groupBy("kind", "source")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("cut").alias("n_cut"))
        .withColumn("share", F.round(F.col("n_cut") / F.col("n"), 6))
    )
