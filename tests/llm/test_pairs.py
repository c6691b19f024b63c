import random

import pytest
from pyspark.sql import functions as F

from quire.llm import pairs as P
from tests.conftest import rows

NAMES = ["Anna", "Paul", "Mia", "Jonas", "Lena", "Emil", "Ida", "Karl"]
PLACES = ["am Bahnhof", "in der Küche", "auf dem Markt", "hinter dem Rathaus", "im Garten"]
WHEN = ["am Montag", "im Sommer", "nach der Schule", "um halb neun"]
THINGS = ["den Schlüssel", "die Lampe", "das alte Fahrrad", "eine Postkarte", "frische Tomaten"]
SCHEMA = "question_id long, collection string, section string, item_type string, instruction string, question string, option_a string, option_b string, option_c string, option_d string, option_e string, correct_answer string, answer string, spread int"
DEFECTS = {
    "empty": ["", None, " ", "n/a", "TODO", "...", "k. A.", "___", "null"],
    "refusal": ["Als KI-Modell kann ich diese Frage nicht beantworten.", "I cannot provide an answer to this question.", "Je ne suis pas en mesure de fournir la solution de cet exercice.", "Es tut mir leid, diese Aufgabe kann ich nicht lösen. Bitte den Lösungsschlüssel angeben."],
}
#: Templates of a second set, of which neither the patterns nor the first set know the wording.
HELD_OUT = {
    "empty": ["", None, "  ", "N.A.", "tbd", "--", "(leer)", "....", "unbekannt"],
    "refusal": ["Diese Aufgabe übersteigt leider, was ich leisten darf.", "The exercise is outside of what I am permitted to answer.", "Il m'est impossible de traiter cette question.", "Dazu fehlt mir der Text der Aufgabe, bitte nachreichen."],
}
OTHER = {
    "PLACES": ["neben der Post", "vor dem Kino", "im dritten Stock", "an der Haltestelle", "bei den Großeltern"],
    "WHEN": ["gegen Mittag", "nach dem Essen", "vor der Prüfung", "im Winter"],
    "THINGS": ["einen Regenschirm", "das Wörterbuch", "die Fahrkarte", "zwei Bücher", "den Koffer"],
}


def items(seed, n=3500, held_out=False):
    r = random.Random(seed)
    PLACES, WHEN, THINGS = (OTHER[k] if held_out else globals()[k] for k in ("PLACES", "WHEN", "THINGS"))
    verb = "trägt" if held_out else "holt"
    DEFECTS = HELD_OUT if held_out else globals()["DEFECTS"]
    out, want = [], {}
    for k in range(n):
        name, other, place, when, thing = r.choice(NAMES), r.choice(NAMES), r.choice(PLACES), r.choice(WHEN), r.choice(THINGS)
        kind = r.choice(["short-answer", "short-answer", "multiple-choice", "true-false", "ordering", "fill-in", "open-ended"])
        opts = [None] * 5
        sentence = f"{name} {verb} {when} {thing} {place}."
        if kind == "short-answer":
            q, a = r.choice([(f"Wann {verb} {other} {thing}?", sentence), (f"Wo kann man {thing} finden?", f"Man kann {place} {thing} finden."), (f"Wie lehnt {name} höflich ab?", f"Leider kann ich {when} nicht kommen, weil {other} krank ist.")])
        elif kind == "multiple-choice":
            opts = [*r.sample(PLACES, 3), None, ""]
            q, a = f"Wo wartet {name} {when}?", r.choice(["a", "b)", "C.", opts[1]])
        elif kind == "true-false":
            q, a = sentence, r.choice(["richtig", "Falsch", f"Falsch: {other} wartet {place}."])
        elif kind == "ordering":
            parts = [name, verb, when, thing, place]
            a = " ".join(parts) + "."
            r.shuffle(parts)
            q = " / ".join(parts)
        elif kind == "fill-in":
            q, a = f"{name} ___ {thing} {place}.", r.choice([verb, "nicht", f"{name} {verb} {thing} {place}."])
        else:
            q, a = f"Erzähle, was du {when} {place} gemacht hast.", r.choice(["", None, "(open-ended)"])
        if kind != "open-ended" and r.random() < 0.10:
            defect = r.choice(P.DEFECTS)
            if defect in DEFECTS:
                a = r.choice(DEFECTS[defect])
            elif defect == "copy":
                a = r.choice([q, q.upper(), f"Antwort: {q}", f'"{q}"', q.replace(" ", "  ")])
            elif defect == "language":
                a = r.choice([f"{other} talked to {name} on the phone in the morning.", f"On peut trouver la lampe dans la cuisine avec {name}.", f"{name} necesita la bicicleta en la estación después de clase."])
            else:
                if kind in ("true-false", "fill-in") or len(a) < 12:
                    kind, opts, q, a = "short-answer", [None] * 5, f"Wann {verb} {other} {thing}?", sentence
                a = a[: r.randint(7, len(a) - 5)].rstrip()
            want[k] = defect
        out.append((k, f"buch-{k % 7}", "reading", kind, r.choice(["", None, "Lies den Text."]), q, *opts, a, "clash", 3))
    return out, want


@pytest.fixture(scope="module")
def judged(spark):
    """Items with seeded defects: one set to look at cutoffs, one held out, made from other templates."""
    out = {}
    for seed in (1, 2):
        data, want = items(seed, held_out=seed == 2)
        df = spark.createDataFrame(data, SCHEMA)
        out[seed] = (want, [(r.question_id, r.defect, r.posterior) for r in P.defects(df, {d: 0.05 for d in P.DEFECTS}).collect()], dict(rows(P.found(df))))
    return out


@pytest.mark.parametrize("seed", (1, 2))
@pytest.mark.parametrize("defect", P.DEFECTS)
def test_accuracy(judged, defect, seed):
    """The second set is worded as no function knows it: of its refusals those count that no pattern matches, and of
    these hardly any is found, as the functions that vote against it outweigh the one that all types share it."""
    want, _, got = judged[seed]
    true, found = {k for k, d in want.items() if d == defect}, {k for k, d in got.items() if d == defect}
    assert len(true & found) >= (0.35 if (defect, seed) == ("refusal", 2) else 0.88) * len(true)
    # A refusal in another language that isn't known as one is in another language all the same.
    wrong = {k for k in found - true if not (defect == "language" and want.get(k) == "refusal")}
    assert len(wrong) <= 0.06 * len(found) + 1


@pytest.mark.parametrize("defect", P.DEFECTS)
def test_cutoffs_are_near_the_best(judged, defect):
    """The stated cutoff loses hardly anything against the best one for the seeded defects."""

    def f1(seed, cutoff):
        want, all_, _ = judged[seed]
        true = {k for k, d in want.items() if d == defect}
        found = {k for k, d, p in all_ if d == defect and p > cutoff and want.get(k, defect) == defect}
        return 2 * len(true & found) / max(1, len(true) + len(found))

    best = max(f1(1, c / 20) for c in range(1, 20))
    assert f1(1, P.CUTOFFS[defect]) >= best - 0.03
    # On the second set too no other cutoff would do much better.
    assert f1(2, P.CUTOFFS[defect]) >= max(f1(2, c / 20) for c in range(1, 20)) - 0.03


def test_no_item_twice_and_several_labels_kept(spark):
    """Planted: refusals in another language than the question, and copies of a question in another language than the book's."""
    data, _ = items(3)
    double = [(10_000 + k, f"buch-{k % 7}", "reading", "short-answer", "", f"Wann holt {n} den Schlüssel?", *[None] * 5, "I cannot provide an answer to this question because the audio is missing.", "x", 1) for k, n in enumerate(NAMES)]
    df = spark.createDataFrame(data + double, SCHEMA)
    kept = {}
    for q, d, p in [tuple(r) for r in P.defects(df).collect()]:
        assert P.CUTOFFS[d] < p <= 1 and d not in kept.setdefault(q, [])
        kept[q].append(d)
    assert all(set(kept[r[0]]) >= {"refusal", "language"} for r in double)
    got = rows(P.found(df))
    assert len(got) == len({q for q, _ in got}) == len(kept) and {d for q, d in got if q >= 10_000} == {"refusal"}


def test_edges(spark):
    data = [(k, None, None, None, None, None, None, None, None, None, None, None, "x", 1) for k in range(3)] + [(9, "b", None, "short-answer", "", "Wo?", None, None, None, None, None, "x " * 30_000, "x", 1)]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(P.found(df)) == [(0, "empty"), (1, "empty"), (2, "empty")]
    assert P.found(df.limit(0)).count() == 0 and P.defects(df.limit(0)).count() == 0


def test_label_model_learns_trust():
    r = random.Random(5)
    counts, truth = {}, {}
    for _ in range(20_000):
        y = r.random() < 0.05
        votes = tuple(0 if r.random() < 0.2 else (1 if r.random() < (h if y else f) else -1) for h, f in ((0.9, 0.01), (0.6, 0.05), (0.5, 0.5)))
        counts[votes] = counts.get(votes, 0) + 1
        truth[votes] = truth.get(votes, 0) + y
    post = P.fit(counts)
    assert post[(1, 1, 0)] > 0.95 and post[(-1, -1, 0)] < 0.05
    assert abs(post[(1, 0, 1)] - post[(1, 0, -1)]) < 0.1  # the third says nothing
    assert P.fit({}) == {}
    # A single step from the common belief, as without training, takes the third at its word: its posteriors are off.
    off = lambda p: sum(abs(n * p[v] - truth[v]) for v, n in counts.items())
    assert off(post) < 0.6 * off(P.fit(counts, rounds=1))


def test_plans_repeat_no_text_work(spark):
    """The joins don't carry the patterns that each item is read by, votes are read once, and so is a text for its language."""
    df = spark.createDataFrame(items(4, n=300)[0], SCHEMA)
    plan = lambda d: d._jdf.queryExecution().optimizedPlan().toString()
    of_votes = plan(P.votes(df))
    assert of_votes.count("RLIKE") < 10 and len(of_votes) < 40_000
    assert plan(P.defects(df)).count("Relation [") == 1
    assert plan(df.select(P.language(F.col("question")).alias("l"))).count("split(") == 1


def test_language_by_most_function_words(one):
    assert [one(P.language, t) for t in ("der Hund und die Katze", "the dog is here", "der the", "Hund", "", None)] == ["de", "en", None, None, None, None]
    assert one(lambda c: P.language(c, 1), "les chiens") == "fr"
