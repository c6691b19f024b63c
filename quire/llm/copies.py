"""Problem 4: one record per entry, although its copies are formatted differently.

Byte-identical raw rows are collapsed first, with their counts; only the distinct survivors are
canonicalised; these are grouped again on the whole canonical text, and their counts summed. All of
it is JVM-side, and both groupings pre-aggregate before their shuffle, so an entry that holds a third
of all rows reaches its reducer as one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.fold import fold_case

# Articles of the languages of the word lists (German, French, English).
ARTICLES = [
    "der", "die", "das", "den", "dem", "des", "ein", "eine", "einen", "einem", "einer", "eines",
    "le", "la", "les", "l", "un", "une", "des", "du",
    "the", "a", "an",
]

#: Runs of punctuation and white space: what the copies of an entry may differ in.
LOOSE = r"[\p{P}\p{Z}\s]+"


def tokens(c: Column) -> Column:
    """The pieces of a text between punctuation and white space, caseless; accents and all else stay."""
    return F.filter(F.split(fold_case(F.coalesce(c, F.lit(""))), LOOSE), lambda t: t != "")


def canonical(collection: Column, article: Column, word: Column) -> Column:
    """Canonical text of an entry, the same for each way of writing it.

    The article may stand in its own column, in that of the word (before or after it), or the two may
    have changed places, so both are put in one order; without spaces, as a hyphen or a space inside a
    word is only formatting. A null and a blank article are the same.
    """
    a, w = tokens(article), tokens(word)
    own = [F.lit(x) for x in dict.fromkeys(ARTICLES)]
    single = F.when(F.size(a) == 0, w).when(F.size(w) == 0, a)
    front = (F.size(single) > 1) & F.element_at(single, 1).isin(*own)
    back = (F.size(single) > 1) & F.element_at(single, -1).isin(*own)
    rest = F.when(front, F.slice(single, 2, F.greatest(F.size(single) - 1, F.lit(1)))).when(back, F.slice(single, 1, F.greatest(F.size(single) - 1, F.lit(1)))).otherwise(single)
    head = F.when(front, F.element_at(single, 1)).when(back, F.element_at(single, -1)).otherwise(F.lit(""))
    one = F.when(F.size(single) > 0, F.array_join(rest, "")).otherwise(F.lit(""))
    x = F.when(single.isNotNull(), head).otherwise(F.array_join(a, ""))
    y = F.when(single.isNotNull(), one).otherwise(F.array_join(w, ""))
    return F.concat_ws("\u0001", F.array_join(tokens(collection), ""), F.least(x, y), F.greatest(x, y))


def distinct_rows(rows: DataFrame, id_column: str = "vocab_id", collection: str = "collection", article: str = "article", word: str = "word") -> DataFrame:
    """Byte-identical raw rows collapsed: collection, article, word, first_id, copies."""
    return (
        rows.select(F.col(id_column).alias("_id"), F.col(collection).alias("_collection"), F.col(article).alias("_article"), F.col(word).alias("_word"))
        .groupBy("_collection", "_article", "_word")
        .agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_copies"))
    )


def entries(rows: DataFrame, **columns: str) -> DataFrame:
    """One row per entry: first_id, copies (rows of it, exact copies too), spellings (distinct raw rows).

    Nulls count as blanks; rows that hold neither word nor article are one entry per collection; an
    empty table gives an empty result; other columns of ``rows`` play no part, whatever their names.
    """
    return (
        distinct_rows(rows, **columns)
        .groupBy(canonical(F.col("_collection"), F.col("_article"), F.col("_word")).alias("_key"))
        .agg(F.min("_first").alias("first_id"), F.sum("_copies").alias("copies"), F.count(F.lit(1)).alias("spellings"))
        .drop("_key")
    )


def copies(rows: DataFrame, id_column: str = "vocab_id", collection: str = "collection", article: str = "article", word: str = "word") -> DataFrame:
    """first_id, copy_id: each row that is not the first of its entry, with the first.

    The rows meet their entry over the raw columns, and only raw rows of entries with copies are on the
    other side. A raw row that holds a third of the table is spread over tasks: its side is given PARTS
    times, and the rows choose a part by their id.
    """
    names = {"id_column": id_column, "collection": collection, "article": article, "word": word}
    raw = distinct_rows(rows, **names).withColumn("_key", canonical(F.col("_collection"), F.col("_article"), F.col("_word")))
    first = raw.groupBy("_key").agg(F.min("_first").alias("first_id"), F.sum("_copies").alias("_all")).where("_all > 1").drop("_all")
    # Single raw rows need no way back to their table: their id is known already.
    known = raw.join(first, "_key")
    single = known.where("_copies = 1").select("first_id", F.col("_first").alias("copy_id"))
    several = known.where("_copies > 1").select("_collection", "_article", "_word", "first_id", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("_part"))
    back = (
        rows.select(F.col(id_column).alias("copy_id"), F.col(collection).alias("_c"), F.col(article).alias("_a"), F.col(word).alias("_w"))
        .withColumn("_p", F.pmod(F.xxhash64("copy_id"), F.lit(PARTS)).cast("int"))
        .join(
            several,
            F.col("_c").eqNullSafe(F.col("_collection")) & F.col("_a").eqNullSafe(F.col("_article")) & F.col("_w").eqNullSafe(F.col("_word")) & (F.col("_p") == F.col("_part")),
        )
        .select("first_id", "copy_id")
    )
    return single.unionByName(back).where("copy_id <> first_id")


#: Into so many parts the rows of one raw spelling are spread on their way back to the table.
PARTS = 8
