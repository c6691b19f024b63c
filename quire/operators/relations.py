"""Joins, cascades and set operations between sheets, pages, verdicts and states."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as X


def enrich(left: DataFrame, right: DataFrame, keys: Sequence[str], defaults: Mapping[str, object]) -> DataFrame:
    """Left outer join, each default where the right side has no row or a null."""
    joined = left.join(right, list(keys), "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def update(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``left`` with these columns overwritten where the right side has a value that isn't empty; right rows without a partner play no part."""
    new = right.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = left.join(new, list(keys), "left")
    return joined.withColumns({c: F.coalesce(F.nullif(F.col(f"_new_{c}"), F.lit("")), F.col(c)) for c in columns}).select(*left.columns)


def seed(existing: DataFrame, expected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``existing`` and those expected rows whose keys it lacks; running it again adds nothing."""
    return existing.unionByName(expected.join(existing.select(*keys).distinct(), list(keys), "left_anti"), allowMissingColumns=True)


def with_page(verdicts: DataFrame, pages: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Verdicts whose page exists."""
    return verdicts.join(pages.select(*keys).distinct(), list(keys), "left_semi")


def verdict_ok(json: Column) -> Column:
    """Whether a verdict passes: ``ok`` is the boolean true and nothing is missing; unreadable or a string is no."""
    v = F.from_json(json, "ok boolean, missing_count int")
    return F.coalesce(v["ok"] & (F.coalesce(v["missing_count"], F.lit(0)) == 0), F.lit(False))


def cascade(expected: DataFrame, pages: DataFrame, verdicts: DataFrame, keys: Sequence[str], ok: str = "ok") -> DataFrame:
    """Each expected page with the first thing that is wrong with it: missing_md, missing_qa, qa_fail, else ok."""
    k = list(keys)
    have = pages.select(*k).distinct().withColumn("_page", F.lit(True))
    told = verdicts.groupBy(*k).agg(F.bool_and(ok).alias("_ok"))
    joined = expected.join(have, k, "left").join(told, k, "left")
    state = F.when(F.col("_page").isNull(), "missing_md").when(F.col("_ok").isNull(), "missing_qa").when(~F.col("_ok"), "qa_fail").otherwise("ok")
    return joined.select(*expected.columns, state.alias("state"))


def dangling(rows: DataFrame, catalog: DataFrame, book: str, page: str, unit: str) -> DataFrame:
    """Rows whose page, without leading zeros, isn't in their book's catalog; blank pages refer to nothing."""
    known = catalog.select(F.col(book).alias("_book"), X.page_key(F.col(unit)).alias("_key")).distinct()
    refs = rows.withColumn("_ref", X.page_key(F.col(page))).where(F.coalesce(F.col("_ref"), F.lit("")) != "")
    return refs.join(known, (refs[book] == known["_book"]) & (refs["_ref"] == known["_key"]), "left_anti").drop("_ref")


def accepted_split(failures: DataFrame, accepted: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Failures that are new, and those that were accepted; accepted keys without a failure play no part."""
    known = accepted.select(*keys).distinct()
    return failures.join(known, list(keys), "left_anti"), failures.join(known, list(keys), "left_semi")


def write_back(items: DataFrame, fixed: DataFrame, order: str, column: str = "correct_answer") -> DataFrame:
    """Items with the corrected answer of the same page, item and beginning of the question; the last correction counts.

    Missing parts of a key are equal to each other.
    """

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumns({
            "_p": F.coalesce(F.col("source_page").cast("string"), F.lit("None")),
            "_i": F.coalesce(F.col("item").cast("string"), F.lit("None")),
            "_q": F.substring(F.coalesce("question", F.lit("")), 1, 80),
        })

    last = keyed(fixed).groupBy("_p", "_i", "_q").agg(F.max_by(F.struct(F.col(column).alias("v")), F.col(order)).alias("_fix"))
    return keyed(items).join(last, ["_p", "_i", "_q"], "left").withColumn(column, F.when(F.col("_fix").isNotNull(), F.col("_fix.v")).otherwise(F.col(column))).select(*items.columns)


def zip_compare(old: DataFrame, new: DataFrame, keys: Sequence[str], record: str = "record", ignore: Sequence[str] = ()) -> DataFrame:
    """Records at the same place of two versions: the fields that differ, but for those to be ignored.

    A place that one version lacks has all fields of the other as changed. ``record`` is a map of strings.
    """
    k = list(keys)
    both = old.select(*k, F.col(record).alias("_old")).join(new.select(*k, F.col(record).alias("_new")), k, "full_outer")
    empty = F.create_map().cast("map<string,string>")
    pairs = F.map_zip_with(F.coalesce("_old", empty), F.coalesce("_new", empty), lambda key, a, b: ~a.eqNullSafe(b))
    names = F.map_keys(F.map_filter(pairs, lambda key, differs: differs & ~key.isin(*ignore) if ignore else differs))
    return both.select(*k, F.array_sort(names).alias("changed"), F.col("_old").isNull().alias("added"), F.col("_new").isNull().alias("gone"))


def compare_builds(built: DataFrame, committed: DataFrame, key: str = "path", content: str = "content") -> DataFrame:
    """Each built file against the committed one, dates masked: same, STALE or NEW; files that are no longer built are GONE."""
    a = built.select(key, X.masked_date(F.col(content)).alias("_a"))
    b = committed.select(key, X.masked_date(F.col(content)).alias("_b"))
    state = F.when(F.col("_b").isNull(), "NEW").when(F.col("_a").isNull(), "GONE").when(F.col("_a") == F.col("_b"), "same").otherwise("STALE")
    return a.join(b, key, "full_outer").select(key, state.alias("state"))


def first_match(rows: DataFrame, dimension: DataFrame, key: str, value: str, fallback: str) -> DataFrame:
    """The value that the dimension has for the key, the fallback where it has none; keys in it are unique."""
    return rows.join(dimension.select(key, value), key, "left").withColumn(value, F.coalesce(F.col(value), F.lit(fallback)))


def counts_onto(books: DataFrame, rows: DataFrame, key: str, name: str) -> DataFrame:
    """Books with the number of their rows, 0 where there are none."""
    return enrich(books, rows.groupBy(key).agg(F.count(F.lit(1)).alias(name)), [key], {name: 0})


def answer_option(letter: Column, options: Mapping[str, str]) -> Column:
    """The text of the option that a letter names; null where there is none."""
    pairs = [x for k, c in options.items() for x in (F.lit(k), F.col(c))]
    return F.create_map(*pairs)[F.lower(F.regexp_replace(letter, r"\.$", ""))]


def column_differences(columns: Sequence[str], canonical: Sequence[str], optional: Sequence[str] = ()) -> dict[str, list[str] | bool]:
    """Columns beyond the canonical ones, missing ones, and whether the rest is in canonical order."""
    kept = [c for c in columns if c in canonical]
    return {
        "extra": [c for c in columns if c not in canonical],
        "missing": [c for c in canonical if c not in columns and c not in optional],
        "ordered": kept == [c for c in canonical if c in columns],
    }


def raster_gap(books: DataFrame, images: DataFrame, files: DataFrame, key: str = "slug") -> DataFrame:
    """Books whose number of page images isn't that of their file: key, images, pages. Books whose number of pages
    isn't known, or whose images came with them, aren't compared."""
    asked = books.where(~F.coalesce("images_preexisting", F.lit(False))).select(key)
    counts = asked.join(files.select(key, "pages"), key).join(images.select(key, "images"), key, "left")
    return counts.select(key, F.coalesce("images", F.lit(0)).alias("images"), "pages").where("images <> pages and pages is not null")


def routes(languages: DataFrame, kinds: Sequence[str], key: str = "lang") -> DataFrame:
    """Each language with each kind of sheet."""
    return languages.select(key, F.explode(F.array(*map(F.lit, kinds))).alias("kind"))
