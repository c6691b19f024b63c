import pytest
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import answers, explore, quality, relations, rollup, sheets
from quire.sources import sinks

from .conftest import rows


def test_raster_gap_and_routes(spark):
    books = spark.createDataFrame([("a", False), ("b", None), ("c", True), ("d", False)], "slug string, images_preexisting boolean")
    images = spark.createDataFrame([("a", 3), ("c", 1)], "slug string, images int")
    files = spark.createDataFrame([("a", 3), ("b", 4), ("c", 9), ("d", None)], "slug string, pages int")
    assert rows(relations.raster_gap(books, images, files)) == [("b", 0, 4)]
    assert rows(relations.routes(spark.createDataFrame([("de",), ("fr",)], "lang string"), ["catalog", "questions"])) == [("de", "catalog"), ("de", "questions"), ("fr", "catalog"), ("fr", "questions")]


def test_texts(one):
    assert one(X.needs_render, "<script>" + "x" * 500 + "</script><p>a") and one(X.needs_render, None)
    assert not one(X.needs_render, "<p>" + "wort " * 60)
    assert one(X.chunk_label, 1, 25, types="int") == "chunk-001-025"


def test_explorer_extras(spark):
    df = spark.createDataFrame([("Zebra",), ("äpfel",), ("Apfel",), ("bär",)], "title string")
    assert [r.title for r in explore.by_title(df).collect()] == ["Apfel", "äpfel", "bär", "Zebra"]
    a = spark.createDataFrame([("pass", "", ""), ("fail", "x", ""), (None, "x", None), (None, " ", "Verified"), (None, None, "pending"), (None, None, None)], "qa string, a string, s string")
    assert [r[0] for r in a.select(explore.accent(F.col("qa"), F.col("a"), F.col("s"))).collect()] == ["good", "bad", "good", "good", "muted", "plain"]
    e = spark.createDataFrame([(3, "b", "x", None), (1, "a", "p", False), (2, "b", "y", False), (4, "a", "q", True)], "ord int, kind string, label string, disabled boolean")
    assert [tuple(r) for r in explore.grouped(e, "ord").collect()] == [("a", ["p"]), ("b", ["y", "x"])]
    c = spark.createDataFrame([("Der Weg", "w", "f", "de", "complete"), ("La Route", "r", "f", "fr", "planned")], "title string, slug string, family string, lang string, state string")
    assert explore.console(c, "de").count() == 1 and explore.console(c, text="ROUTE").count() == 1 and explore.console(c, state="planned", text="weg").count() == 0


def test_summaries(spark):
    o = spark.createDataFrame([("b", 2, False, None), ("b", 1, True, True), ("c", 3, True, False), ("b", 9, None, False)], "book string, page int, ok boolean, repaired boolean")
    assert rows(rollup.batch_summary(o, ["book"])) == [("b", 3, 1, 2, 1, [2, 9]), ("c", 1, 1, 0, 0, [])]
    assert tuple(rollup.batch_summary(o).first()) == (4, 2, 2, 1, [2, 9])
    assert o.select(rollup.share_rounded(F.lit(1), F.lit(8))).first()[0] == 13


def test_gate(spark):
    f = spark.createDataFrame([("drift",)], "severity string")
    assert quality.passes(f) and not quality.passes(f, strict=True) and not quality.passes(spark.createDataFrame([("fail",)], "severity string"))


def test_start_page_and_exports(spark, tmp_path):
    c = spark.createDataFrame([("a", "f", 1200, 0, 0), ("b", "f", 0, 0, 0), ("c", "e", 1, 2, 3)], "collection string, family string, pages long, questions long, words long")
    text = sheets.start_page(c, "Deutsch")
    assert "2 books, 1,201 pages, 2 questions, 3 words." in text and text.index("| c |") < text.index("| a |") and "| b |" not in text
    with pytest.raises(ValueError):
        sheets.start_page(c, "x", most=1)
    assert sinks.view_export(c, str(tmp_path / "v.csv"), ["collection"], most=2) == 2
    assert rows(c.select(sheets.state_label(F.lit("Complete!"), F.lit(0))).distinct()) == [("complete",)]


def test_own_words_for_true_and_false(spark):
    df = spark.createDataFrame([(1, "true-false", "sí", *[None] * 5)], "question_id int, item_type string, correct_answer string, option_a string, option_b string, option_c string, option_d string, option_e string")
    out = answers.check(df, F.lit("es"), {"es": ["sí", "no"]}).first()
    assert (out.fixed, out.issue) == ("Sí", None)


def test_titles_variants_counters_and_order(spark, one):
    from quire.functions import text as X
    from quire.operators import sheets

    assert one(X.page_title, "<!-- a\nb --> rest\n  <!-- c -->\n\n12\nSeite 4\n## **Ti*t*el** &nbsp; x <!-- d -->\nmore") == "Titel x"
    assert one(X.page_title, "<!-- never closed\n# Title") == "" and one(X.page_title, None) == "" and one(X.page_title, "a <!-- open\nb") == "a <!-- open"
    assert [one(X.humanised, c) for c in ("qa", "source_page", None)] == ["QA", "Source page", None]
    books = spark.createDataFrame([("s-a", None, "kurs-buch", "A1", None)], "slug string, title string, variant string, level string, pdf string")
    assert rows(books.select(sheets.display_title(books))) == [("A1 - Kurs Buch - S A",)]
    items = spark.createDataFrame([(1, "b", "10", "2"), (2, "b", "2", None), (3, "b", "10", "1"), (4, "b", None, "x")], "question_id long, collection string, source_page string, item string")
    assert [r[0] for r in sorted(rows(sheets.in_order(items, "question_id").select("question_id", "place")), key=lambda r: r[1])] == [4, 3, 1, 2]
    assert [one(sheets.item_count, j) for j in ('{"items": [1, 2]}', '{"entries": []}', "[1]", "[1", None, '{"x": 1}')] == [2, 0, 1, -1, -1, -1]
