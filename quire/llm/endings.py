"""Which texts stop before their end, judged by how all the texts of their kind end.

For every word, and for every word together with the one before it, the first and the second word of its
text, the corpus tells how often a text ends there and how often it goes on. A text that stops where
texts of its kind always go on has lost its end; so has one that stops within a word, with an open
bracket or quotation mark, with a broken character, or before a word that always follows a word it has.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.session import cut

#: A text stops too early where fewer than this share of the texts with the same last words end,
#: or of those with the same last word and the same first or second word.
ENDS, ENDS_OF_KIND = 0.02, 0.008
#: Such contexts say nothing with fewer texts than this.
SUPPORT, SUPPORT_OF_KIND = 12, 40
#: Words for which companions are sought stand in at least this share of the texts, and in so many.
FREQUENT, LEAST = 0.002, 40
#: A companion follows in at least this share of the texts that have the word.
ALWAYS = 0.975
#: A word that ends a text is a piece of another one if that is so many times as frequent.
PIECE = 8
#: Slots of 64 bits of the filter that contexts of going on pass before they are shuffled; so many rows at most.
SLOTS = 1 << 17

#: Marks that may close a text, after which nothing is missing by itself.
FINAL = r"[.!?…:;。！？][\"'»“”’)\]\s]*$"


def shown(text: Column) -> Column:
    """The text without invisible characters and loose accents: what a limit counted before they came in."""
    return F.regexp_replace(text, r"[\p{Cf}\p{M}]+", "")


def words(text: Column) -> Column:
    """The text's words between spaces, in lower case, without the marks around them."""
    bare = F.transform(F.split(F.lower(shown(text)), r"[\s\p{Z}]+"), lambda w: F.regexp_replace(w, r"^[\"'„“«»(\[]+|[.!?…,;:\"'»“”’)\]。！？，]+$", ""))
    return F.filter(bare, lambda w: w != "")


def marked(text: Column) -> Column:
    return text.rlike(FINAL)


def open_ended(text: Column) -> Column:
    """An opened bracket or quotation mark that isn't closed, or a broken character at the end."""

    def more(left: str, right: str) -> Column:
        return F.regexp_count(text, F.lit(left)) > F.regexp_count(text, F.lit(right))

    return text.rlike(r"�[\s\p{P}]*$") | more(r"\(", r"\)") | more(r"\[", r"\]") | more("„", "[“”]") | more("«", "»") | ((F.regexp_count(text, F.lit('"')) % 2) == 1)


def _context(kind: Column, w: Column, i: Column) -> Column:
    """The contexts of the i-th word (from 1), each as a number: itself, with the word before it, with the
    first word, with the second."""
    word, none = F.get(w, i - 1), F.lit(None).cast("bigint")
    return F.array(
        F.xxhash64(kind, F.lit("word"), word),
        F.when(i > 1, F.xxhash64(kind, F.lit("pair"), F.get(w, i - 2), word)).otherwise(none),
        F.when(i > 1, F.xxhash64(kind, F.lit("first"), F.get(w, F.lit(0)), word)).otherwise(none),
        F.when(i > 2, F.xxhash64(kind, F.lit("second"), F.get(w, F.lit(1)), word)).otherwise(none),
    )


def judge(texts: DataFrame) -> DataFrame:
    """``kind, text, n, mark, early``: whether each text stops before its end; each pair of kind and text once.

    Contexts and texts are known by 64-bit hashes: two contexts with one hash would add their counts.

    ``texts`` has kind, text, n (rows with this text) and whole (rows of it that no length limit can have
    cut). Texts of one kind are judged by each other. Null and blank texts aren't judged. All counts cover
    all texts; words for which companions are sought are bounded by their least share.
    """
    kind, w = F.col("kind"), F.col("w")
    base = texts.where(F.col("text").rlike(r"\S")).select("kind", "text", "n", "whole", words(F.col("text")).alias("w"), marked(F.col("text")).alias("mark")).where(F.size("w") > 0)
    base = cut(base.withColumn("id", F.xxhash64("kind", "text")).withColumn("final", _context(kind, w, F.size("w"))))
    inner = F.flatten(F.transform(F.sequence(F.lit(1), F.size("w")), lambda i: F.when(i < F.size("w"), _context(kind, w, i)).otherwise(F.array().cast("array<bigint>"))))
    # Each text counts once in a context, and one that ends there counts as that.
    ends = base.select(F.explode(F.array_distinct(F.array_compact("final"))).alias("key"), F.col("whole").alias("ends"), F.lit(0).cast("bigint").alias("goes_on"))
    # Only contexts in which some text ends are asked for: most others stop at a filter of bounded size, before the shuffle.
    goes = base.select("n", F.explode(F.array_except(F.array_compact(inner), "final")).alias("key")).withColumn("slot", _slot(F.col("key")))
    goes = goes.join(F.broadcast(_filter(ends)), "slot").where(F.getbit("bits", _bit(F.col("key"))) == 1).select("key", F.lit(0).cast("bigint").alias("ends"), F.col("n").alias("goes_on"))
    context = ends.unionByName(goes).groupBy("key").agg(F.sum("ends").alias("ends"), F.sum("goes_on").alias("goes_on"))
    asked = base.select("id", F.posexplode("final").alias("sort", "key")).where("key is not null")
    all_ = F.col("ends") + F.col("goes_on")
    share = F.col("ends") / all_
    of = lambda sort, least: F.max(F.when((F.col("sort") == sort) & (all_ >= least), share))
    told = asked.join(context, "key").groupBy("id").agg(of(0, SUPPORT).alias("word_share"), of(1, SUPPORT).alias("pair_share"), of(2, SUPPORT_OF_KIND).alias("first_share"), of(3, SUPPORT_OF_KIND).alias("second_share"))
    known = base.select("kind", "n", "mark", F.posexplode("w").alias("at", "word"), F.size("w").alias("last"))
    known = cut(known.groupBy("kind", "word").agg(F.sum(F.when((F.col("at") + 1 < F.col("last")) | F.col("mark"), F.col("n")).otherwise(0)).alias("sure"), F.sum("n").alias("all")))
    told = base.drop("final").join(told, "id", "left").withColumn("word", F.element_at("w", -1)).join(_pieces(known), ["kind", "word"], "left")
    # A mark at the end is outweighed only by the words right before it, as with an abbreviation.
    low = (F.coalesce("pair_share", "word_share") < ENDS) | (~F.col("mark") & (F.least("first_share", "second_share") < ENDS_OF_KIND))
    told = told.withColumn("broken", F.coalesce(low, F.lit(False)) | F.coalesce("piece", F.lit(False)) | open_ended(F.col("text")))
    told = cut(told.select("kind", "text", "n", "whole", "w", "mark", "broken"))
    lacks = _lacks(_companions(told.where("not broken and whole > 0"), known), told.sparkSession)
    return told.withColumn("lacks", ~F.col("mark") & lacks(kind, w)).select("kind", "text", "n", "mark", (F.col("broken") | F.col("lacks")).alias("early"), "broken", "lacks")


def _slot(key: Column) -> Column:
    return F.pmod(key, F.lit(SLOTS)).cast("int")


def _bit(key: Column) -> Column:
    return F.pmod(F.shiftright(key, 24), F.lit(64)).cast("int")


def _filter(keys: DataFrame) -> DataFrame:
    """slot, bits: a filter that lets every one of the keys through and few others; SLOTS rows at most."""
    return keys.groupBy(_slot(F.col("key")).alias("slot")).agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(shiftright(key, 24), 64) as int))")).alias("bits"))


def _pieces(known: DataFrame) -> DataFrame:
    """kind, word, piece: words that end texts only and are the beginning of a far more frequent word.

    A longer word is cut at the lengths that such endings have, so it may be of any length itself.
    """
    odd = known.where("sure * 4 < all").select("kind", "word", F.col("all").alias("own"))
    lengths = odd.agg(F.array_sort(F.collect_set(F.length("word"))).alias("_lengths"))  # one row
    cuts = F.transform(F.filter("_lengths", lambda n: n < F.length("longer")), lambda n: F.substring("longer", F.lit(1), n))
    # A word that isn't PIECE times as frequent as anything is no longer word of a piece.
    of = known.where(F.col("sure") >= PIECE).select("kind", "sure", F.col("word").alias("longer")).join(F.broadcast(lengths)).select("kind", "sure", F.explode(cuts).alias("word"))
    of = of.groupBy("kind", "word").agg(F.max("sure").alias("most"))
    return odd.join(of, ["kind", "word"]).where(F.col("most") >= F.greatest(F.lit(PIECE), F.col("own") * PIECE)).select("kind", "word", F.lit(True).alias("piece"))


def _companions(whole: DataFrame, known: DataFrame) -> dict[str, dict[str, list[str]]]:
    """For each kind and frequent word, the words that always follow it in ``whole``.

    There can be no more frequent words than the mean number of words divided by FREQUENT, and no more
    companions of one than the mean number of words divided by ALWAYS. Pairs are counted as numbers, the
    places of the words in the list of frequent ones; a pair of words that can't pass by their single counts
    (a companion is nearly as frequent as its word) isn't counted.
    """
    totals = whole.groupBy("kind").agg(F.sum("whole").alias("texts"))
    least = F.greatest(F.lit(LEAST), F.col("texts") * FREQUENT)
    often = {(r.kind, r.word): r.all for r in known.join(totals, "kind").where(F.col("sure") >= least).select("kind", "word", F.col("all")).collect()}
    if not often:
        return {}
    spark = whole.sparkSession
    frequent = sorted({w for _, w in often})
    kinds = sorted({k for k, _ in often})
    held = spark.sparkContext.broadcast({w: k for k, w in enumerate(frequent)})
    many, number = len(frequent), F.array_position(F.array(*map(F.lit, kinds)), F.col("kind")).cast("int").alias("k")

    @F.pandas_udf("array<int>")
    def places(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        at = held.value
        for texts in batches:
            yield texts.map(lambda w: [at[x] for x in w if x in at])

    numbered = cut(whole.where(F.col("kind").isin(*kinds)).select(number, F.col("whole").alias("n"), places("w").alias("w")))
    alone = numbered.select("k", "n", F.explode(F.array_distinct("w")).alias("a")).groupBy("k", "a").agg(F.sum("n").alias("n_a"))
    counted = alone.join(totals.select(number, least.alias("least")), "k").where(F.col("n_a") >= ALWAYS * F.col("least"))
    singles = {(r.k, r.a): (r.n_a, r.n_a >= r.least) for r in counted.collect()}
    counts = spark.sparkContext.broadcast(singles)

    @F.pandas_udf("array<bigint>")
    def pairs(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        known_counts = counts.value
        for ks, texts in batches:
            out = []
            for k, w in zip(ks, texts):
                first, last = {}, {}
                for i, x in enumerate(w):
                    first.setdefault(x, i)
                    last[x] = i
                n = {x: known_counts.get((k, x), (0, False)) for x in first}
                out.append([x * many + y for x, i in first.items() if n[x][1] for y, j in last.items() if j > i and n[y][0] >= ALWAYS * n[x][0]])
            yield pd.Series(out)

    both = numbered.select("k", "n", F.explode(pairs("k", "w")).alias("pair")).groupBy("k", "pair").agg(F.sum("n").alias("both"))
    of_word = pd.DataFrame([(k, a, n) for (k, a), (n, enough) in singles.items() if enough], columns=["k", "a", "n_a"])
    of_word = spark.createDataFrame(of_word, "k int, a int, n_a bigint")
    kept = both.withColumn("a", F.floor(F.col("pair") / many).cast("int")).join(of_word, ["k", "a"]).where(F.col("both") >= ALWAYS * F.col("n_a"))
    rules: dict[str, dict[str, list[str]]] = {}
    for r in kept.select("k", "pair").collect():
        rules.setdefault(kinds[r.k - 1], {}).setdefault(frequent[r.pair // many], []).append(frequent[r.pair % many])
    return rules


def _lacks(rules: dict[str, dict[str, list[str]]], spark):
    held = spark.sparkContext.broadcast(rules)

    @F.pandas_udf("boolean")
    def lacks(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        by_kind = held.value
        for kinds, texts in parts:
            out = []
            for kind, w in zip(kinds, texts):
                rule, ws, missing = by_kind.get(kind, {}), list(w), False
                place = {}
                for k, x in enumerate(ws):
                    place[x] = k
                seen = set()
                for k, x in enumerate(ws):
                    if x in rule and x not in seen:
                        seen.add(x)
                        if any(place.get(b, -1) <= k for b in rule[x]):
                            missing = True
                            break
                out.append(missing)
            yield pd.Series(out)

    return lacks
