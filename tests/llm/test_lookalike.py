import pytest

from quire.llm import lookalike as L
from tests.conftest import rows

PLAIN = [
    "Die Haltestelle am Markt", "où est-ce qu'on achète du café", "Übung macht den Meister", "the quick brown fox reads on Monday", "einen Regenschirm bringen", "„Wie geht’s?“ – gut …", "2 m² und ½ kg", "книга", "мышь / mouse", "друг", "дом погода яблоко", "φίλος σπίτι", "りんご",
    "une part de gâteau", "x" * 10, "Weihnachten im Schwimmbad", "le week-end dernier à la gare", "Kaffee trinken und Kuchen essen",
]
ODD = {
    "Die Halte​stelle": "Die Haltestelle", "am\xa0Markt": "am Markt", "am　Markt": "am Markt", "Ｋaffee": "Kaffee", "ﬁnden": "finden", "café"[:3] + "é": "café", "Ha­ltestelle": "Haltestelle", "Μοnday": "Monday", "Кuchen": "Kuchen",
    "trіnkеn": "trinken", "Schwimmbаd": "Schwimmbad", "мышь / mоuse": "мышь / mouse", "﻿gut": "gut", "й"[0:0] + "й": "й",
}


def test_cases_and_their_form(spark):
    texts = PLAIN + list(ODD) + [None, "", " ", "\t"]
    df = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "row_id int, text string, script int")
    out = {r.text: r.clean for r in L.normalise(df).collect()}
    assert {t: c for t, c in out.items() if t in ODD} == ODD
    assert all(out[t] == t for t in PLAIN) and out[None] is None and out[""] == "" and out["\t"] == "\t"
    assert {r.text for r in L.cases(df).collect()} == set(ODD)
    clean = L.normalise(df).selectExpr("row_id", "clean as text", "script")
    assert L.cases(clean).count() == 0
    assert L.cases(df.limit(0)).count() == 0


def test_repeated_and_long(spark):
    df = spark.createDataFrame([(1, "Кuchen " + "essen " * 20_000), (2, "Кuchen"), (3, "Кuchen")] + [(9, "Kuchen und Kaffee")] * 5, "row_id int, text string")
    got = rows(L.cases(df).select("row_id", "clean"))
    assert [r[0] for r in got] == [1, 2, 3] and got[0][1].startswith("Kuchen essen") and got[1][1] == "Kuchen"


@pytest.mark.parametrize("text", ["می‌خواهم", "👩‍👩‍👧", "❤️"])
def test_joiners_that_matter_stay(text):
    assert L.normalised(text) == text


def test_lattice_prefers_the_script_of_known_words():
    counts = [("Latin", g, 50) for w in ("^^kaffee$", "^^tee$") for g in (w[k : k + 3] for k in range(len(w) - 2))] + [("Cyrillic", g, 50) for w in ("^^кофе$",) for g in (w[k : k + 3] for k in range(len(w) - 2))]
    t = L.Trigrams(counts)
    assert t.clean("Tее") == "Tee" and t.clean("кофе") == "кофе" and t.clean("Tee кофе") == "Tee кофе"


def test_no_trigram_is_left_out(spark, monkeypatch):
    monkeypatch.setattr(L, "MOST_TRIGRAMS", 5)
    L.cleaner(spark.createDataFrame([("abc",)], "text string"))
    with pytest.raises(ValueError):
        L.cleaner(spark.createDataFrame([("abcdefgh",)], "text string"))
