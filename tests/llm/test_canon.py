import random

from quire.llm import canon as C
from tests.conftest import rows

ENTRIES = [
    (1, "section", "listening", ["Hören", "Hörverstehen", "compréhension orale"]), (2, "section", "reading", ["Lesen", "Leseverstehen", "lecture"]), (3, "section", "writing", ["Schreiben", "production écrite"]),
    (4, "section", "speaking", ["Sprechen", "production orale"]), (5, "section", "none", None), (8, "level", "A1", ["Anfänger"]), (9, "level", "A2", []), (10, "level", "B1", ["Mittelstufe"]), (11, "level", "B2", ["obere Mittelstufe", "niveau avancé"]),
]


def entries(spark):
    return spark.createDataFrame([(*e, "clash") for e in ENTRIES], "canon_id long, field_name string, entry string, aliases array<string>, value string")


def matched(spark, field, values):
    df = spark.createDataFrame([(field, v, 1) for v in values], "field_name string, value string, score int")
    return {r.value: r.canon_id for r in C.match(df, entries(spark)).collect()}


def test_sections(spark):
    want = {
        "listening": 1, "LISTENING": 1, " Hören": 1, "Hoerverstehen": 1, "*lecture* (Teil 3)": 2, "Leseverstehen - S. 64": 2, "leecture": 2, "lceture ?": 2, "production orrale": 4, "produuction écrite": 3, "\tnone\xa0": 5,
        "projet final": -1, "Landeskunde": -1, "???": -1, "7": -1, "p. 48": -1, "pronunciation": -1, "xx": -1,
    }
    assert matched(spark, "section", [*want, None, "", "  ", "\xa0"]) == want


def test_levels(spark):
    want = {"A1": 8, "a.1": 8, "Ａ２": 9, "Niveau B1": 10, "[B1]": 10, "B-2": 11, "CEFR: B2": 11, "A1 (inferred)": 8, "obere Mitelstufe": 11, "Mittelstufe": 10, "niveau avance": 11, "A7": -1, "B3": -1, "Stufe 9": -1, "48": -1, "C1": -1}
    assert matched(spark, "level", want) == want


def test_rows_repeats_and_empty_tables(spark):
    t = spark.createDataFrame([(1, "Lesen", 0), (2, "Lesen", 0), (3, "reading", 0), (4, None, 0), (5, " ", 0), (6, "zzz", 0), (7, "x" * 50_000, 0)], "id long, section string, canon_id int")
    assert rows(C.found({"section": (t, "id")}, entries(spark))) == [("section", 1, 2), ("section", 2, 2), ("section", 6, -1), ("section", 7, -1)]
    assert rows(C.found({"section": (t.limit(0), "id")}, entries(spark))) == []
    assert rows(C.found({"section": (t, "id")}, entries(spark).limit(0)))[0] == ("section", 1, -1)


def test_recall_on_seeded_typing_errors(spark):
    r = random.Random(7)
    want = {}
    for cid, field, entry, aliases in ENTRIES:
        for name in [entry, *(aliases or [])]:
            if field == "section" and len(name) > 5:
                for _ in range(12):
                    k = r.randrange(1, len(name) - 2)
                    typo = r.choice([name[:k] + name[k + 1 :], name[:k] + name[k] * 2 + name[k + 1 :], name[:k] + name[k + 1] + name[k] + name[k + 2 :], name[:k] + r.choice("aeinrst") + name[k + 1 :]])
                    want.setdefault(typo, cid)
    got = matched(spark, "section", want)
    assert sum(got[v] == c for v, c in want.items()) >= 0.97 * len(want)
    assert sum(got[v] not in (c, -1) for v, c in want.items()) <= 0.01 * len(want)


def town(r):
    return "".join(r.choice(["b", "br", "d", "f", "g", "h", "kl", "l", "m", "n", "p", "r", "s", "sch", "st", "t", "w"]) + r.choice(["a", "e", "i", "o", "u", "au", "ie"]) + r.choice(["", "n", "r", "ck", "ng", "st"]) for _ in range(r.choice((2, 3, 4))))


def test_no_pair_above_the_least_cosine_is_missed_and_few_others_meet(spark):
    r = random.Random(11)
    names = sorted({town(r) for _ in range(1500)})
    listed = spark.createDataFrame([(k, "town", n, None) for k, n in enumerate(names)], "canon_id long, field_name string, entry string, aliases array<string>")
    slips = []
    for n in r.sample(names, 40):
        k = r.randrange(1, len(n) - 1)
        slips += [n[:k] + n[k + 1 :], n[:k] + r.choice("aeinrst") + n[k:], n[: k - 1] + n[k] + n[k - 1] + n[k + 1 :]]
    index, known = C.index(listed)
    held = {x.name: {g.gram: g.w for g in x.grams} for x in index.collect()}
    # The vectors of the keys, as search makes them.
    idf, df = {x.gram: x.idf for x in known.collect()}, {x.gram: x.df for x in known.collect()}
    bags = []
    for key in set(slips):
        marked = f"^{key}$"
        for n in C.GRAMS:
            for g in {marked[i : i + n] for i in range(len(marked) - n + 1)} - {"^", "$"}:
                bags.append(("town", key, g, df.get(g, 0), sum(marked[i : i + n] == g for i in range(len(marked) - n + 1)) * idf.get(g, max(idf.values())) * n))
    vectors = C._vectors(spark.createDataFrame(bags, "field_name string, key string, gram string, df long, raw double"), ["field_name", "key"])
    own = {x.key: {g.gram: g.w for g in x.grams} for x in vectors.collect()}
    got = {(x.key, x.name) for x in C.candidates(vectors, index).collect()}
    least = lambda key: min(C.MOST, C.THRESHOLD + C.RISE * max(0, len(key) - C.SHORT)) - C.MARGIN
    want = {(k, n) for k, x in own.items() for n, y in held.items() if sum(w * y.get(g, 0.0) for g, w in x.items()) >= least(k) + 1e-9}
    assert want <= got and len(want) > len(own)
    assert len(got) < 0.35 * len(own) * len(held)
    found = {x.key: names[x.canon_id] for x in C.search(spark.createDataFrame([("town", k) for k in set(slips)], "field_name string, key string"), listed).collect()}
    best = {k: max(held, key=lambda n: (sum(w * held[n].get(g, 0.0) for g, w in x.items()))) for k, x in own.items()}
    assert all(best[k] == n for k, n in found.items()) and len(found) > 0.7 * len(own)


def test_a_long_addition_does_not_hide_an_entry(spark):
    assert matched(spark, "section", {"Hörverstehen im Zug": 1, "production orale libre": 4}) == {"Hörverstehen im Zug": 1, "production orale libre": 4}
