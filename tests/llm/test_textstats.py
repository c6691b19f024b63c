import random

import numpy as np

from quire.llm import textstats as X
from tests.conftest import rows

NAMES = ["Anna", "Paul", "Mia", "Jonas", "Lena", "Emil"]
PLACES = ["am Bahnhof", "in der Küche", "auf dem Markt", "hinter dem Rathaus", "im Garten"]
THINGS = ["das Brot", "die Lampe", "der Apfel", "die Jacke", "das Messer", "rot", "aufstehen", "die Gabel"]


def corpus(seed, n):
    r = random.Random(seed)
    sentence = lambda: f"{r.choice(NAMES)} kauft {r.choice(PLACES)} {r.choice(THINGS)}, weil {r.choice(NAMES)} heute nicht kommen kann."
    nonsense = lambda: " ".join("".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 4))) for _ in range(7)).capitalize() + "."

    def wrapped(t, width=45):
        out, line = [], ""
        for w in t.split():
            if len(line) + len(w) > width:
                out.append(line)
                line = w
            else:
                line = f"{line} {w}".strip()
        return "\n".join([*out, line])

    kinds = {
        "prose": [
            lambda: " ".join(sentence() for _ in range(8)),
            lambda: "# Titel\n\n" + wrapped(" ".join(sentence() for _ in range(9))),
            lambda: "\n".join(f"{r.choice(NAMES)}: {sentence()}" for _ in range(8)),
            lambda: "Liebe Anna,\n\n" + " ".join(sentence() for _ in range(7)) + "\n\nViele Grüße\nPaul",
        ],
        "list": [
            lambda: "\n".join(f"{k}. {r.choice(THINGS)}" for k in range(1, 15)),
            lambda: "\n".join(f"- {r.choice(THINGS)}" for _ in range(15)),
            lambda: ", ".join(r.choice(THINGS) for _ in range(40)),
            lambda: "\n".join(f"Kapitel {k}: Im Garten {'.' * 12} {k * 7}" for k in range(1, 10)),
        ],
        "table": [
            lambda: "| Name | Ort | Zeit |\n| --- | --- | --- |\n" + "\n".join(f"| {r.choice(NAMES)} | {r.choice(THINGS)} | 1{r.randint(0, 9)}:30 |" for _ in range(12)),
            lambda: "\n".join(f"{r.choice(NAMES)}\t{r.choice(THINGS)}\t{r.randint(10, 99)}\t{r.choice(THINGS)}" for _ in range(14)),
            lambda: "\n".join(f"{r.choice(NAMES):12}{r.choice(THINGS):18}{r.randint(10, 99)}   x" for _ in range(14)),
        ],
        "junk": [
            lambda: "".join(r.choice("#%&*+<=>[]^_{}|~;.0123456789lIO ") for _ in range(400)),
            lambda: " ".join(nonsense() for _ in range(10)),
            lambda: " ".join(str(r.randint(1, 10**8)) for _ in range(60)),
            lambda: "\n".join(r.choice("-=_~") * r.randint(15, 50) for _ in range(8)),
            lambda: "".join(r.choice("abcdefXYZ0123456789+/") for _ in range(500)),
        ],
    }
    weights = {"prose": 12, "list": 3, "table": 3, "junk": 1}
    out = []
    for k in range(n):
        kind = r.choices(list(weights), list(weights.values()))[0]
        out.append((k, r.choice(kinds[kind])(), kind))
    return out


def test_kinds_on_seeded_documents(spark):
    docs = corpus(3, 900)
    df = spark.createDataFrame([(k, t, "clash", 1.0) for k, t, _ in docs], "doc_id long, text string, kind string, prose double")
    got = dict(rows(X.found(df)))
    want = {k: kind for k, _, kind in docs if kind != "prose"}
    right = sum(got.get(k) == v for k, v in want.items())
    assert right >= 0.97 * len(want)
    assert sum(k not in want for k in got) <= 0.01 * len(docs)


def test_the_larger_part_decides(spark):
    docs = corpus(4, 400)
    prose = [t for _, t, k in docs if k == "prose"]
    table = [t for _, t, k in docs if k == "table"]
    extra = [(1000, prose[0] + "\n\n" + prose[1] + "\n\n" + table[0][:120]), (1001, table[0] + "\n" + table[1] + "\n" + table[2] + "\n\n" + prose[0][:90])]
    df = spark.createDataFrame([(k, t) for k, t, _ in docs] + extra, "doc_id long, text string")
    got = {r.doc_id: r.kind for r in X.statistics(df).where("doc_id >= 1000").collect()}
    assert got == {1000: "prose", 1001: "table"}


def test_statistics_and_edges(spark):
    base = [(100 + k, t) for k, t, _ in corpus(5, 60)]
    df = spark.createDataFrame([(1, None), (2, ""), (3, " \n\t "), (4, "Anna kauft Brot.\nPaul #!"), (5, "wort " * 100_000), (6, "Anna kauft Brot.\nPaul #!"), *base], "doc_id long, text string")
    out = {r.doc_id: r for r in X.statistics(df).collect()}
    assert len(out) == 66
    for k in (1, 2, 3):
        assert (out[k].words, out[k].lines, out[k].kind, out[k].mean_word_length, out[k].prose) == (0, 0, None, None, None)
    r = out[4]
    assert (r.words, r.lines, r.mean_word_length, r.punctuated_lines) == (4, 2, 4.25, 1.0) and abs(r.symbol_ratio - 3 / 20) < 1e-9
    assert abs(sum((r.prose, r.list, r.table, r.junk)) - 1) < 1e-6 and tuple(out[6])[1:] == tuple(r)[1:]
    assert out[5].words == 100_000
    assert X.statistics(df.limit(0)).count() == 0


def test_batched_passes_equal_one_document_at_a_time():
    rng = np.random.default_rng(1)
    top = int(np.prod(X.SIZES))
    codes = [rng.integers(0, top, n) for n in (1, 7, 3, 1, 12)]
    m = X.Model()
    together, steps, likelihood = m.posterior(codes)
    alone = [m.posterior([c]) for c in codes]
    assert all(np.allclose(a, b[0][0]) for a, b in zip(together, alone))
    assert np.allclose(steps, sum(b[1] for b in alone)) and np.isclose(steps.sum(), sum(len(c) - 1 for c in codes))
    assert np.isclose(likelihood, sum(b[2] for b in alone))
    for c, p, one in zip(codes, together, alone):
        brute, whole = np.zeros((len(c), len(X.HIDDEN))), 0.0
        if len(c) <= 3:
            from itertools import product

            e = np.exp(sum(np.log(x)[:, X.unpack(c)[:, k]] for k, x in enumerate(m.emit)).T)
            for path in product(range(len(X.HIDDEN)), repeat=len(c)):
                w = m.start[path[0]] * np.prod([m.step[a, b] for a, b in zip(path, path[1:])]) * np.prod([e[t, s] for t, s in enumerate(path)])
                whole += w
                for t, s in enumerate(path):
                    brute[t, s] += w
            assert np.allclose(p, brute / brute.sum(axis=1, keepdims=True)) and np.isclose(one[2], np.log(whole))
    # A document that counts three times is three documents.
    thrice, plain = m.expected(codes, np.array([3, 1, 1, 1, 1])), m.expected([codes[0], codes[0], *codes])
    assert np.allclose(thrice, plain)


def test_training_raises_the_likelihood_and_moves_the_chances(spark):
    df = spark.createDataFrame([(k, t) for k, t, _ in corpus(6, 500)], "doc_id long, text string")
    known = spark.sparkContext.broadcast(X.common_words(df))
    lines = df.mapInArrow(X._lines(known), X.LINES)
    model, told = X.train(lines)
    assert len(told) >= 2 and all(b >= a - 1e-6 for a, b in zip(told[1:], told[2:])) and told[-1] > told[0] + 0.1
    assert max(float(np.abs(a - np.array(b)).max()) for a, b in zip(model.emit, X.FEATURES.values())) > 0.05
    assert all(np.allclose(e.sum(axis=1), 1) for e in model.emit)


def test_common_words_are_all_that_reach_the_share(spark):
    many = [f"w{chr(97 + k // 676)}{chr(97 + k // 26 % 26)}{chr(97 + k % 26)}" for k in range(6000)]
    df = spark.createDataFrame([(k, " ".join(many)) for k in range(3)], "doc_id long, text string")
    assert X.common_words(df) == sorted(many)  # more than any round number of them


def test_observations_of_lines():
    import pyarrow as pa

    names = list(X.FEATURES)
    common = pa.array(["das", "ist", "ein", "haus"])
    seen, weights = X.observe(pa.array(["Das ist ein Haus.", "- Haus", "| a | b | c |", "=====", "Kapitel 3 ........ 12", "xq" * 30, "Das. Ist es? Ja"]), common)
    of = [dict(zip(names, row.tolist())) for row in X.unpack(seen)]
    assert (of[0]["sentence"], of[0]["common"], of[0]["words"], of[0]["mark"], of[0]["columns"]) == (1, 3, 2, 0, 0)
    assert of[1]["mark"] == 1 and of[2]["columns"] == 3 and of[3]["tokens"] == 3 and of[4]["leader"] == 1 and of[5]["tokens"] == 2 and of[6]["sentence"] == 2
    assert weights.tolist() == [14, 4, 7, 5, 18, 60, 12]
    assert X.observe(pa.array([], pa.string()), common)[0].size == 0
