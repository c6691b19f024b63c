"""The table explorer: search, filters, order, pages, figures over what is shown, and lists of options."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def search(rows: DataFrame, text: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows one of whose columns contains the text, in any case; a blank text keeps all."""
    if not text.strip():
        return rows
    cells = F.array(*[F.lower(F.col(c).cast("string")) for c in columns or rows.columns])
    return rows.where(F.exists(cells, lambda c: F.coalesce(F.contains(c, F.lit(text.lower())), F.lit(False))))


def equal_filters(rows: DataFrame, filters: Mapping[str, str]) -> DataFrame:
    """Rows that equal all of these values, in any case: the whole value, not a part of it."""
    for c, v in filters.items():
        rows = rows.where(F.lower(F.col(c).cast("string")) == v.lower())
    return rows


def page(rows: DataFrame, order: Sequence[Column | str], number: int = 0, size: int = 50) -> DataFrame:
    """One page of the rows in order; the order should end in a unique key."""
    return rows.orderBy(*order).offset(number * size).limit(size)


def options(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, value: the different values of each column that aren't blank, of all rows."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]))
    return rows.select(each.alias("_e")).select("_e.*").where(F.coalesce(F.col("value"), F.lit("")) != "").distinct()


def explore(rows: DataFrame, text: str = "", filters: Mapping[str, str] | None = None, order: Sequence[Column | str] = (), number: int = 0, size: int = 50) -> DataFrame:
    """Search, then filters, then order, then one page."""
    kept = equal_filters(search(rows, text), filters or {})
    return page(kept, order, number, size) if order else kept.offset(number * size).limit(size)


def console(books: DataFrame, lang: str | None = None, text: str = "", state: str | None = None, columns: Sequence[str] = ("title", "slug", "family")) -> DataFrame:
    """Books of a language and a state whose title and other names contain the text."""
    if lang:
        books = books.where(F.col("lang") == lang)
    if state:
        books = books.where(F.col("state") == state)
    names = F.lower(F.concat_ws(" ", *columns))
    return books.where(F.instr(names, text.lower()) > 0) if text.strip() else books


def detail(rows: DataFrame, key: str, featured: Sequence[str] = ()) -> DataFrame:
    """A row's cells as key and value, featured ones first, empty ones left out unless featured."""
    rest = [c for c in rows.columns if c not in featured and c != key]
    cells = [F.struct(F.lit(k).alias("place"), F.lit(c).alias("column"), F.col(c).cast("string").alias("value"), F.lit(c in featured).alias("featured")) for k, c in enumerate([*featured, *rest])]
    return rows.select(key, F.explode(F.array(*cells)).alias("_e")).select(key, "_e.*").where("featured or coalesce(value, '') <> ''").drop("featured")


def by_title(books: DataFrame, column: str = "title") -> DataFrame:
    """In the order of a dictionary, whatever the language."""
    return books.orderBy(F.collate(F.col(column), "UNICODE"), column)


def accent(qa: Column, answer: Column, status: Column) -> Column:
    """How a row is marked: by its verdict, else by whether it is answered, else by its status."""
    s = F.lower(F.coalesce(status, F.lit("")))
    return (
        F.when(qa == "pass", "good")
        .when(qa == "fail", "bad")
        .when(F.trim(F.coalesce(answer, F.lit(""))) != "", "good")
        .when(s.contains("verified") | s.contains("complete"), "good")
        .when(s.contains("pending"), "muted")
        .otherwise("plain")
    )


def grouped(entries: DataFrame, order: str, kind: str = "kind", most: int = 1000) -> DataFrame:
    """Search entries that aren't disabled by kind, kinds and entries in their order; a kind shows its first ``most``."""
    kept = entries.where(~F.coalesce("disabled", F.lit(False)))
    ranked = kept.withColumn("_n", F.row_number().over(Window.partitionBy(kind).orderBy(order))).where(F.col("_n") <= most)
    held = ranked.groupBy(kind).agg(F.min(order).alias("_o"), F.array_sort(F.collect_list(F.struct(order, "label"))).alias("_e"))
    return held.orderBy("_o").select(kind, F.transform("_e", lambda e: e["label"]).alias("labels"))
