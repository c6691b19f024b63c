import html
import json
import random

import pytest

from quire.llm import truncation as T
from tests.conftest import rows

NAMES = ["Anna", "Paul", "Mia", "Jonas", "Lena", "Emil", "Ida", "Karl", "Frieda", "Otto"]
TOPICS = ["travel plans", "family members", "the weather report", "daily routines", "shopping trips", "school subjects"]
TASKS = ["a role play", "two advertisements", "a crossword puzzle", "modal verbs", "four photos", "a short letter", "„Café & Co“", "Übungen über Äpfel"]
PLACES = ["am Bahnhof", "in der Küche", "auf dem Markt", "hinter dem Rathaus", "im Garten", "über der Bäckerei"]


def value(r):
    n, t, a, b = r.choice(NAMES), r.choice(TOPICS), r.choice(TASKS), r.choice(TASKS)
    dot = r.choice([".", ".", ""])
    return r.choice([
        f"Learners discuss {t} using {a}{dot}",
        f"Grammar box on {t}, incl. {a} and {b}{dot}",
        f"Students rewrite {t} and then practise {a} in pairs{dot}",
        f"Word list in which {n} writes about {t} and adds {a}{dot}",
        f"Speaking cards on {t}",
        f"Wann holt {n} {r.choice(PLACES)} den Schlüssel ab{r.choice(['?', '?', ''])}",
        f"{n} wartet {r.choice(PLACES)} auf {r.choice(NAMES)}{dot}",
    ])


COUNTED = {
    "characters": len,
    "utf-8": lambda s: len(s.encode()),
    "html": lambda s: len(html.escape(s, quote=True).replace("&#x27;", "&#39;")),
    "json-ascii": lambda s: len(json.dumps(s)) - 2,
}


def shortened(s, count, limit):
    while count(s) > limit:
        s = s[:-1]
    return s


def corpus(seed, encoding="characters", limit=44, n=5000):
    r = random.Random(seed)
    out, cut = [], set()
    for k in range(n):
        source = f"s{k % 10}"
        v = value(r)
        if source in ("s0", "s1"):
            w = shortened(v, COUNTED[encoding], limit)
            if w != v:
                cut.add(k)
            v = w
        elif r.random() < 0.03:
            v = v[: r.randint(9, len(v) - 4)]
            cut.add(k)
        out.append((k, source, v))
    return out, cut


@pytest.mark.parametrize("encoding", COUNTED)
def test_limits_show_in_their_encoding(spark, encoding):
    data, _ = corpus(1, encoding)
    df = spark.createDataFrame([("f", k, s, v) for k, s, v in data], "kind string, row_id long, source string, text string")
    got = rows(T.limits(df).select("source", "limit"))
    assert [g[0] for g in got] == ["s0", "s1"]
    # Different ways of counting agree on plain text; the limit is found, and never above what was stored.
    assert all(abs(g[1] - 44) <= (0 if encoding == "characters" else 3) for g in got)


def test_seeded_truncations(spark):
    data, cut = corpus(2)
    df = spark.createDataFrame([("f", k, s, v, True) for k, s, v in data], "kind string, row_id long, source string, text string, cut boolean")
    got = {r.row_id for r in T.inspect(df).where("cut").collect()}
    assert len(got & cut) >= 0.9 * len(cut)
    assert len(got - cut) <= 0.06 * len(got)
    by = {r.source: r for r in T.by_source(df).collect()}
    assert by["s0"].n == 500 and by["s0"].share > 0.2 > by["s5"].share


def test_edges(spark):
    data = [("f", 1, "s", None), ("f", 2, "s", ""), ("f", 3, "s", "  "), ("f", 4, None, "Das Haus"), ("f", 5, None, "Das Haus"), ("g", 6, "s", "wort " * 50_000), ("f", 7, "s", "(offen"), ("f", 8, "s", "kaputt �")]
    df = spark.createDataFrame(data, "kind string, row_id long, source string, text string")
    assert [(r[0], r[1]) for r in rows(T.inspect(df).select("row_id", "cut"))] == [(1, False), (2, False), (3, False), (4, False), (5, False), (6, False), (7, True), (8, True)]
    assert T.inspect(df.limit(0)).count() == 0 and T.limits(df.limit(0)).count() == 0
    assert rows(T.by_source(df).where("source is null").select("n", "n_cut")) == [(2, 0)]


def test_a_limit_of_the_only_source(spark):
    r = random.Random(5)
    values = [shortened(value(r), len, 44) for _ in range(2000)]
    whole = [value(r) for _ in range(2000)]
    df = spark.createDataFrame([("x", "s", v) for v in values] + [("y", "s", v) for v in whole], "kind string, source string, text string")
    assert rows(T.limits(df).select("kind", "encoding", "limit")) == [("x", "characters", 44)]


def test_pieces_of_words_of_any_length(spark):
    from quire.llm import endings as E

    long = "donau" * 40 + "gesellschaft"
    df = spark.createDataFrame([("k", long, 50, 50), ("k", long[:-3], 0, 2), ("k", "haus", 50, 50), ("k", "hau", 0, 1), ("k", "rest", 0, 9)], "kind string, word string, sure long, all long")
    assert rows(E._pieces(df).select("word")) == [(long[:-3],), ("hau",)]


def test_companions_are_those_of_a_count_of_all_pairs(spark):
    import random

    from quire.llm import endings as E

    r = random.Random(2)
    texts = []
    for _ in range(600):
        w = [r.choice("abcdefgh") for _ in range(r.randint(2, 6))]
        if r.random() < 0.5:
            w = ["if", *w, "then", r.choice("xyz")]
        texts.append(w)
    whole = spark.createDataFrame([("k", 1, w) for w in texts], "kind string, whole long, w array<string>")
    known = spark.createDataFrame([("k", x, n, n) for x in {x for w in texts for x in w} for n in [sum(w.count(x) for w in texts)]], "kind string, word string, sure long, all long")
    got = E._companions(whole, known)
    least = max(E.LEAST, E.FREQUENT * len(texts))
    words = {x for w in texts for x in w}
    n = {x: sum(x in w for w in texts) for x in words}
    want = {}
    for a in words:
        for b in words:
            after = sum(b in w[w.index(a) + 1 :] for w in texts if a in w)
            if n[a] >= least and after >= E.ALWAYS * n[a]:
                want.setdefault(a, set()).add(b)
    assert {k: set(v) for k, v in got.get("k", {}).items()} == want and "then" in want["if"]


def test_contexts_pass_a_filter_that_loses_none(spark):
    from pyspark.sql import functions as F

    from quire.llm import endings as E

    keys = spark.range(5000).select(F.xxhash64("id").alias("key"))
    held = E._filter(keys.where("key % 3 = 0"))
    kept = keys.withColumn("slot", E._slot(F.col("key"))).join(held, "slot").where(F.getbit("bits", E._bit(F.col("key"))) == 1)
    assert keys.where("key % 3 = 0").join(kept, "key", "left_anti").count() == 0
    assert kept.count() < 1.1 * keys.where("key % 3 = 0").count()
