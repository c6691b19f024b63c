import random

from hypothesis import given, settings
from hypothesis import strategies as st

from quire.llm import leaks as L
from tests.conftest import rows

VOCABULARY = [f"w{k}" for k in range(400)]


def make(seed, n):
    r = random.Random(seed)
    return [r.choice(VOCABULARY) for _ in range(n)]


def tables(spark, docs, items):
    d = spark.createDataFrame([(k, t, "clash", 1) for k, t in docs], "doc_id long, text string, item_id string, words int")
    i = spark.createDataFrame([(k, t, "clash") for k, t in items], "item_id long, text string, doc_id string")
    return d, i


def brute(docs, items, least=12):
    out = []
    for d, a in docs:
        x = L.words(a)
        grams = {tuple(x[k : k + least]) for k in range(len(x) - least + 1)}
        for i, b in items:
            y = L.words(b)
            if any(tuple(y[k : k + least]) in grams for k in range(len(y) - least + 1)):
                out.append((d, i))
    return sorted(out, key=repr)


def test_both_ways_equal_brute_force(spark):
    items = [(k, " ".join(make(k, 30))) for k in range(20)] + [(90, None), (91, ""), (92, "short text"), (93, " ".join(make(3, 30)))]
    docs = []
    for k in range(80):
        own = make(1000 + k, 120)
        i = make(k % 20, 30)
        n = 8 + k % 12
        at = k % (30 - n)
        docs.append((k, " ".join(own[:40] + i[at : at + n] + own[40:])))
    docs += [(200, None), (201, ""), (202, " \n"), (203, docs[7][1]), (204, docs[7][1]), (205, " ".join(make(5, 30) * 2))]
    d, i = tables(spark, docs, items)
    want = brute(docs, items)
    assert any(a >= 200 for a, _ in want) and len(want) > 40
    assert rows(L.leaks(d, i).select("doc_id", "item_id")) == want
    assert rows(L.leaks(d, i, most_sent=0)) == rows(L.leaks(d, i))
    assert rows(L.leaks(d.limit(0), i)) == rows(L.leaks(d, i.limit(0))) == rows(L.leaks(d.limit(0), i, most_sent=0)) == []


def test_disguises(spark):
    text = "Die älteste Bäckerei liegt hinter dem Rathaus und öffnet jeden Morgen um halb sieben Uhr"
    docs = [(1, "x " + text.upper() + " y"), (2, text.replace(" ", "\n> **") + "**"), (3, "<p>" + text.replace("liegt", "<b class='x'>liegt</b>&nbsp;") + "</p>"), (4, text.replace("ä", "ä").replace("Rathaus", "Rat­haus")), (5, " ".join(text.split()[:11])), (6, " ".join(text.split()[:12])), (7, text.replace("hinter", "vor"))]
    d, i = tables(spark, docs, [(1, text)])
    assert sorted(r[0] for r in rows(L.leaks(d, i))) == [1, 2, 3, 4, 6]


def test_long_document(spark):
    hidden = make(1, 30)
    d, i = tables(spark, [(1, " ".join(make(5, 200_000) + hidden + make(6, 1000)))], [(1, " ".join(hidden))])
    assert rows(L.leaks(d, i)) == [(1, 1, 30)]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(12, 20), st.integers(0, 40))
def test_every_long_enough_passage_shares_a_print(seed, n, at):
    own, item = make(seed, 90), make(seed + 1, 60)
    text = own[:at] + item[20 : 20 + n] + own[at:]
    a, b = L.word_hashes(" ".join(text)), L.word_hashes(" ".join(item))
    x, y = L.fingerprints(a, L.K, 12 - L.K + 1)[0], L.fingerprints(b, L.K, 12 - L.K + 1)[0]
    assert set(x.tolist()) & set(y.tolist())
    assert L.longest_run(a, b) >= n
