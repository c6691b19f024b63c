"""Problem 3: freely typed values mapped to the entries of a reference list.

Values are deduplicated, normalised, and meet the names and aliases of the list in an inverted index of
their character n-grams; each candidate is scored by the cosine of weighted n-grams, and accepted where
the best entry's score is high enough and far enough above that of the next entry. Level codes are no
words: a value that spells a code belongs to the entry with exactly that code, or to none.

The index holds only the rarest n-grams of each name, and a key looks only for its own rarest ones: so many
that what is left over on either side is too little to reach the threshold by itself. Two vectors with a
cosine of t or more share an n-gram among the rarest of both, so no candidate is lost, and a name that
shares nothing but frequent n-grams with a key never meets it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.fold import fold_case, narrow, strip_accents
from quire.session import cut

#: Least cosine of an accepted entry, and its least lead over the second. One slip changes a smaller part of a
#: longer key, so the least cosine rises with each letter beyond SHORT, up to MOST.
THRESHOLD, MARGIN = 0.25, 0.04
SHORT, RISE, MOST = 6, 0.02, 0.45
#: Least likeness by edits (1 less edits over length) of an entry whose cosine is below SURE.
EDITS, SURE = 0.6, 0.5
#: Lengths of the n-grams; a longer one weighs more, as it says more.
GRAMS = (1, 2, 3)

# Words that introduce a level in free entries (German, French, English), without being part of it.
LEVEL_WORDS = ["niveau", "stufe", "level", "cefr", "ger", "gers", "cecr", "cecrl", "gemr"]
# Additions that point to a part or page (German, French, English).
ADDITIONS = r"(?:teil|partie|part|abschnitt|kapitel|chapitre|chapter|seite|page|pages|s|p|pp)"


def core(c: Column) -> Column:
    """A value's letters and digits, caseless, without accents and width, and without the usual additions.

    Removed are a bracketed part after the first word, a reference to a part or page at the end, and all
    marks around. What stands in brackets as a whole stays.
    """
    flat = F.trim(F.regexp_replace(strip_accents(fold_case(narrow(c))), r"[\s\p{Z}\p{C}]+", " "))
    flat = F.regexp_replace(flat, r"(?<=[\p{L}\p{N}].{0,80})\s*\((?:[^()]*)\)\W*$", "")
    flat = F.regexp_replace(flat, r"[\s\-–—,:;]+" + ADDITIONS + r"\.?\s*\d+\W*$", "")
    return F.regexp_replace(flat, r"[^\p{L}\p{N}]+", "")


def level_code(key: Column) -> Column:
    """The code that a value spells, a letter and a digit or a number, perhaps after a word such as "Niveau"; else null."""
    words = "|".join(sorted(LEVEL_WORDS, key=len, reverse=True))
    return F.nullif(F.regexp_extract(key, rf"^(?:{words})?(\p{{L}}?\p{{N}}+)$", 1), F.lit(""))


def grams(key: Column) -> Column:
    """The n-grams of a key, with its ends marked."""
    marked = F.concat(F.lit("^"), key, F.lit("$"))

    def of_length(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.length(marked) - n + 1, F.lit(1)))
        return F.filter(F.transform(starts, lambda i: F.substring(marked, i, F.lit(n))), lambda g: (F.length(g) == n) & ~g.isin("^", "$"))

    return F.concat(*map(of_length, GRAMS))


def least_cosine(key: Column, threshold: float = THRESHOLD) -> Column:
    """The least cosine with which an entry of a key is accepted."""
    return F.least(F.lit(max(MOST, threshold)), F.lit(threshold) + RISE * F.greatest(F.length(key) - SHORT, F.lit(0)))


def _vectors(bags: DataFrame, owner: list[str]) -> DataFrame:
    """owner, grams (gram, df, w, tail) with the rarest first: unit vectors, and the part of the squared length from each gram on.

    ``bags`` has owner, gram, raw and df. Ties of df are broken by the gram, so that all vectors have one order.
    """
    each = bags.groupBy(*owner).agg(F.array_sort(F.collect_list(F.struct("df", "gram", "raw"))).alias("g"))  # a name's or key's own n-grams
    each = each.withColumn("norm", F.sqrt(F.aggregate("g", F.lit(0.0), lambda a, x: a + x["raw"] * x["raw"])))
    each = each.withColumn("g", F.transform("g", lambda x: F.struct(x["df"].alias("df"), x["gram"].alias("gram"), (x["raw"] / F.col("norm")).alias("w"))))
    # From the end: what is left from each n-gram on.
    step = lambda acc, x: F.struct((acc["sum"] + x["w"] * x["w"]).alias("sum"), F.concat(F.array(acc["sum"] + x["w"] * x["w"]), acc["tails"]).alias("tails"))
    tails = F.aggregate(F.reverse("g"), F.struct(F.lit(0.0).alias("sum"), F.array().cast("array<double>").alias("tails")), step)["tails"]
    return each.select(*owner, F.zip_with("g", tails, lambda x, t: F.struct(x["gram"].alias("gram"), x["w"].alias("w"), t.alias("tail"))).alias("grams"))


def index(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Names with their vectors (field_name, canon_id, name, grams), and all n-grams of each field with df and idf."""
    named = entries.select("field_name", "canon_id", F.explode(F.concat(F.array("entry"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("_name"))
    named = named.select("field_name", "canon_id", core(F.col("_name")).alias("name")).where("name <> ''").distinct()
    counts = named.select("field_name", "canon_id", "name", F.explode(grams(F.col("name"))).alias("gram")).groupBy("field_name", "canon_id", "name", "gram").count()
    total = named.groupBy("field_name").agg(F.count_distinct("name").alias("names"))
    known = counts.groupBy("field_name", "gram").agg(F.count_distinct("name").alias("df")).join(total, "field_name").select("field_name", "gram", "df", F.log1p(F.col("names") / F.col("df")).alias("idf"))
    known = cut(known)
    bags = counts.join(known, ["field_name", "gram"]).withColumn("raw", F.col("count") * F.col("idf") * F.length("gram"))
    return cut(_vectors(bags, ["field_name", "canon_id", "name"])), known


def match(values: DataFrame, entries: DataFrame, threshold: float = THRESHOLD, margin: float = MARGIN) -> DataFrame:
    """field_name, value, canon_id, score: the entry of each distinct value, -1 where none is meant.

    ``values`` has field_name and value, repeated as often as one likes; ``entries`` has canon_id,
    field_name, entry and aliases (null or empty where an entry has one name only). Null and blank values
    give nothing. A value that is an entry as it stands is that entry, with score 1.
    """
    names = entries.select("field_name", F.col("entry").alias("value"), F.col("canon_id").alias("exact"))
    own = values.where("value is not null").where(F.regexp_replace("value", r"[\s\p{Z}\p{C}]+", "") != "").groupBy("field_name", "value").agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    keyed = cut(own.join(names.groupBy("field_name", "value").agg(F.min("exact").alias("exact")), ["field_name", "value"], "left").withColumn("key", core(F.col("value"))))
    # The n-gram search sees each key once, however many values share it.
    keys = keyed.where("exact is null").select("field_name", "key").distinct()
    codes = entries.select("field_name", "canon_id", level_code(core(F.col("entry"))).alias("code")).where("code is not null")
    coded_fields = codes.select("field_name").distinct()
    with_code = keys.join(coded_fields, "field_name", "left_semi").withColumn("code", level_code(F.col("key"))).where("code is not null")
    by_code = with_code.join(codes, ["field_name", "code"], "left").select("field_name", "key", F.coalesce("canon_id", F.lit(-1)).alias("canon_id"), F.lit(1.0).alias("score"))
    by_word = search(keys.join(with_code, ["field_name", "key"], "left_anti"), entries, threshold, margin)
    found = by_code.unionByName(by_word)
    return keyed.join(found, ["field_name", "key"], "left").select(
        "field_name", "value", F.coalesce("exact", "canon_id", F.lit(-1)).cast("bigint").alias("canon_id"), F.when(F.col("exact").isNotNull(), 1.0).otherwise(F.coalesce("score", F.lit(0.0))).alias("score")
    )


def candidates(vectors: DataFrame, names: DataFrame, threshold: float = THRESHOLD, margin: float = MARGIN) -> DataFrame:
    """field_name, key, canon_id, name: all pairs that may come within the margin of the key's least cosine, each once.

    Both sides come with their n-grams from the rarest on. If the n-grams that two vectors share begin with
    one from which on either vector has less than t of its length left, their cosine is below t.
    """
    low = max(threshold - margin, 0.0)
    ours = vectors.select("field_name", "key", (least_cosine(F.col("key"), threshold) - margin).alias("t"), F.explode("grams").alias("x"))
    ours = ours.where(F.col("x.tail") >= F.col("t") * F.col("t")).select("field_name", "key", "t", "x.gram")
    theirs = names.select("field_name", "canon_id", "name", F.explode("grams").alias("y")).where(F.col("y.tail") >= low * low)
    theirs = theirs.select("field_name", "canon_id", "name", "y.gram", "y.tail")
    met = ours.join(theirs, ["field_name", "gram"]).where(F.col("tail") >= F.col("t") * F.col("t"))
    return met.select("field_name", "key", "canon_id", "name").distinct()


def search(keys: DataFrame, entries: DataFrame, threshold: float = THRESHOLD, margin: float = MARGIN) -> DataFrame:
    """field_name, key, canon_id, score: accepted entries of normalised keys; keys with none are left out."""
    names, known = index(entries)
    unseen = known.groupBy("field_name").agg(F.max("idf").alias("most"))
    bag = keys.where("key <> ''").select("field_name", "key", F.explode(grams(F.col("key"))).alias("gram")).groupBy("field_name", "key", "gram").count()
    bag = bag.join(known, ["field_name", "gram"], "left").join(unseen, "field_name").select("field_name", "key", "gram", F.coalesce("df", F.lit(0)).alias("df"), (F.col("count") * F.coalesce("idf", "most") * F.length("gram")).alias("raw"))
    vectors = cut(_vectors(bag, ["field_name", "key"]))
    pairs = candidates(vectors, names, threshold, margin).join(vectors.select("field_name", "key", F.col("grams").alias("x")), ["field_name", "key"]).join(names.withColumnRenamed("grams", "y"), ["field_name", "canon_id", "name"])
    weight = F.map_from_entries(F.transform("y", lambda g: F.struct(g["gram"], g["w"])))
    score = F.aggregate("x", F.lit(0.0), lambda a, g: a + g["w"] * F.coalesce(F.col("of")[g["gram"]], F.lit(0.0)))
    best = cut(pairs.withColumn("of", weight).select("field_name", "key", "canon_id", "name", score.alias("score")).groupBy("field_name", "key", "canon_id").agg(F.max(F.struct("score", "name")).alias("b")))
    top = best.groupBy("field_name", "key").agg(F.max(F.struct(F.col("b.score").alias("score"), F.col("canon_id"), F.col("b.name").alias("name"))).alias("t"))
    lead = best.join(top, ["field_name", "key"]).where("canon_id <> t.canon_id").groupBy("field_name", "key").agg(F.max("b.score").alias("second"))
    near = 1 - F.levenshtein("key", F.col("t.name")) / F.greatest(F.length("key"), F.length("t.name"))
    return (
        top.join(lead, ["field_name", "key"], "left")
        .where((F.col("t.score") >= least_cosine(F.col("key"), threshold)) & (F.col("t.score") - F.coalesce("second", F.lit(0.0)) >= margin) & ((F.col("t.score") >= SURE) | (near >= EDITS)))
        .select("field_name", "key", F.col("t.canon_id").alias("canon_id"), F.col("t.score").alias("score"))
    )


def found(tables: dict[str, tuple[DataFrame, str]], entries: DataFrame) -> DataFrame:
    """field_name, row_id, canon_id: every non-blank value that isn't an entry as it stands.

    ``tables`` gives for each field its table and the table's id column. Values are matched once each and
    brought back to their rows by a join on the value; frequent values are cases for AQE's skew join.
    """
    rows = None
    for name, (df, id_column) in tables.items():
        part = df.select(F.lit(name).alias("field_name"), F.col(id_column).cast("bigint").alias("row_id"), F.col(name).alias("value"))
        rows = part if rows is None else rows.unionByName(part)
    assert rows is not None
    entry = entries.select("field_name", F.col("entry").alias("value"))
    odd = rows.join(entry, ["field_name", "value"], "left_anti")
    return odd.join(match(odd, entries), ["field_name", "value"]).select("field_name", "row_id", "canon_id")
