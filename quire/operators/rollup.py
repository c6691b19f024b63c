"""Counts, shares, tiers and top lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import text as X


def value_counts(rows: DataFrame, column: str, group: Sequence[str] = (), name: str = "n") -> DataFrame:
    """Rows of each value, blanks as ``(none)``."""
    return rows.groupBy(*group, X.none_label(F.col(column)).alias("value")).agg(F.count(F.lit(1)).alias(name))


def token_counts(rows: DataFrame, column: str, group: Sequence[str] = (), name: str = "n") -> DataFrame:
    """Rows of each token of a list-valued tag; a row counts once for each of its tokens."""
    return rows.select(*group, F.explode(X.tag_tokens(F.col(column))).alias("value")).groupBy(*group, "value").agg(F.count(F.lit(1)).alias(name))


def count_table(counts: DataFrame, name: str = "n") -> DataFrame:
    """Most frequent first, then by value."""
    return counts.orderBy(F.desc(name), "value")


def fill_rates(rows: DataFrame, columns: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """For each column the rows, those that are filled, and their share in per cent: one pass over the rows."""
    held = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), *[F.count_if(X.filled(F.col(c))).alias(f"_f_{c}") for c in columns])
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_f_{c}").alias("filled")) for c in columns]))
    return held.select(*group, "n", each.alias("_e")).select(*group, "_e.column", "n", "_e.filled", F.when(F.col("n") > 0, 100.0 * F.col("_e.filled") / F.col("n")).alias("pct"))


def sparse_columns(rows: DataFrame, columns: Sequence[str], threshold: float = 10.0, group: Sequence[str] = ()) -> DataFrame:
    """Columns that are empty throughout or filled in fewer than ``threshold`` per cent of the rows; absent ones are skipped."""
    rates = fill_rates(rows, [c for c in columns if c in rows.columns], group)
    return rates.where((F.col("n") > 0) & ((F.col("filled") == 0) | (F.col("pct") < threshold))).withColumn("finding", F.when(F.col("filled") == 0, "empty throughout").otherwise("rarely filled"))


def coverage(rows: DataFrame, floors: DataFrame, columns: Sequence[str], book: str = "collection") -> DataFrame:
    """Declared floors that a book's column misses by half a per cent or more. ``floors``: book, column, floor."""
    return fill_rates(rows, columns, [book]).join(floors, [book, "column"]).where(F.col("pct") + 0.5 < F.col("floor"))


def type_fill(rows: DataFrame, kind: str, parts: Mapping[str, Column]) -> DataFrame:
    """For each type its rows, and for each part the share of rows that have it."""
    return rows.groupBy(kind).agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.when(c, 1.0).otherwise(0.0)).alias(name) for name, c in parts.items()])


def tiers(rows: DataFrame, levels: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Measures for each level from the finest to the whole, and ``tier``, the number of levels that are given: a null
    value of a level that is given is a group of its own, of one that isn't it stands for all."""
    tier = (F.lit(len(levels)) - F.bit_count(F.grouping_id())).cast("int")
    return rows.rollup(*levels).agg(tier.alias("tier"), *[c.alias(name) for name, c in measures.items()])


def top_with_rest(counts: DataFrame, top: int, value: str = "value", name: str = "n", rest: str = "Other") -> DataFrame:
    """The ``top`` most frequent values, the others as one row, and the share of each in all.

    The counts are ranked by a sort and a limit, not by one task over all of them.
    """
    total = counts.agg(F.sum(name).alias("_total"))
    best = counts.orderBy(F.desc(name), value).limit(top)
    others = counts.join(best.select(value), value, "left_anti").agg(F.sum(name).alias(name), F.count(F.lit(1)).alias("_values")).where("_values > 0").select(F.lit(rest).alias(value), name)
    return best.select(value, name).unionByName(others).join(F.broadcast(total)).select(value, name, (F.col(name) / F.col("_total")).alias("share"))  # total is one row


def running_share(parts: DataFrame, group: Sequence[str], order: Sequence[str | Column], measure: str) -> DataFrame:
    """Each part's share of its group and where it starts, in order."""
    by = Window.partitionBy(*group)
    before = F.coalesce(F.sum(measure).over(by.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum(measure).over(by)
    return parts.withColumns({"share": F.col(measure) / total, "start": before / total})


def kpis(rows: DataFrame, book: str, answered: Column, category: str) -> DataFrame:
    """Rows, books, per cent answered (halves up, null for no rows) and categories; a blank category counts as one."""
    n = F.count(F.lit(1))
    return rows.agg(
        n.alias("rows"),
        F.count_distinct(book).alias("books"),
        F.when(n > 0, X.half_up(100.0 * F.count_if(answered) / n)).cast("bigint").alias("pct_answered"),
        F.count_distinct(F.coalesce(F.col(category), F.lit(""))).alias("categories"),
    )


def manifest_totals(rows: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Units, transcribed and verified ones, and their whole per cents, halves to even."""
    n = F.count(F.lit(1))
    done, sure = F.count_if(F.col("status").isin("transcribed", "verified")), F.count_if(F.col("status") == "verified")
    return rows.groupBy(*group).agg(n.alias("units"), done.alias("transcribed"), sure.alias("verified")).withColumns({
        "pct_transcribed": X.percent(F.col("transcribed"), F.col("units")),
        "pct_verified": X.percent(F.col("verified"), F.col("units")),
    })


def pending_range(rows: DataFrame, group: Sequence[str], unit: str = "unit") -> DataFrame:
    """For each group how many units are pending, the first and the last."""
    return rows.where("status = 'pending'").groupBy(*group).agg(F.count(F.lit(1)).alias("pending"), F.min(unit).alias("first"), F.max(unit).alias("last"))


def page_stats(pages: DataFrame, group: Sequence[str]) -> DataFrame:
    return pages.groupBy(*group).agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if(F.col("status") == "verified").alias("verified"),
        F.count_if(F.col("status").isin("transcribed", "verified")).alias("transcribed"),
        F.count_if(F.col("qa") == "pass").alias("qa_pass"),
        F.count_if(F.col("qa") == "fail").alias("qa_fail"),
    )


def header_shapes(headers: DataFrame) -> DataFrame:
    """Kinds of sheets that come with more than one header. ``headers``: kind, header (an array)."""
    return headers.groupBy("kind").agg(F.count_distinct("header").alias("shapes")).where("shapes > 1")


def histogram_stats(histogram: Column) -> Column:
    """Levels in use, mean, share of the 16 darkest levels and share of ink (below 200) of a 256-bin histogram."""
    at = F.transform(histogram, lambda n, i: F.struct(n.cast("double").alias("n"), i.alias("i")))
    total = F.aggregate(histogram, F.lit(0.0), lambda a, n: a + n)

    def part(test) -> Column:
        return F.aggregate(F.filter(at, test), F.lit(0.0), lambda a, x: a + x["n"]) / total

    mean = F.aggregate(at, F.lit(0.0), lambda a, x: a + x["n"] * x["i"]) / total
    levels = F.size(F.filter(histogram, lambda n: n > 0))
    return F.struct(levels.alias("levels"), mean.alias("mean"), part(lambda x: x["i"] < 16).alias("dark"), part(lambda x: x["i"] < 200).alias("ink"))


def image_health(stats: Column) -> Column:
    """degenerate (over 35 % in the darkest levels), blank, or ok; in this order."""
    blank = ((stats["levels"] <= 2) & (stats["mean"] > 240)) | (stats["ink"] < 0.0005)
    return F.when(stats["dark"] > 0.35, "degenerate").when(blank, "blank").otherwise("ok")


def unpivot(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """keys, column, value: a row for each cell."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]))
    return rows.select(*keys, each.alias("_e")).select(*keys, "_e.column", "_e.value")


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def batch_summary(outcomes: DataFrame, group: Sequence[str] = (), sample: int = 20) -> DataFrame:
    """Pages processed, passed, still failing and repaired, and the first of those that fail."""
    ok, repaired = F.coalesce(F.col("ok"), F.lit(False)), F.coalesce(F.col("repaired"), F.lit(False))
    counts = outcomes.groupBy(*group).agg(F.count(F.lit(1)).alias("processed"), F.count_if(ok).alias("passed"), F.count_if(~ok).alias("failing"), F.count_if(repaired).alias("repaired"))
    if not group:
        first = outcomes.where(~ok).orderBy("page").limit(sample).agg(F.array_sort(F.collect_list("page")).alias("first_failing"))
        return counts.join(F.broadcast(first))  # one row
    place = F.row_number().over(Window.partitionBy(*group).orderBy("page"))
    first = outcomes.where(~ok).withColumn("_n", place).where(F.col("_n") <= sample).groupBy(*group).agg(F.array_sort(F.collect_list("page")).alias("first_failing"))
    return counts.join(first, list(group), "left").withColumn("first_failing", F.coalesce("first_failing", F.array().cast("array<int>")))


def share_rounded(part: Column, whole: Column) -> Column:
    """Whole per cent, halves up; null of nothing."""
    return F.when(whole > 0, X.half_up(100.0 * part / whole)).cast("int")
