import json
import os

import pytest
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import quality, sheets
from quire.sources import files, sinks

from .conftest import rows


@pytest.fixture
def corpus(tmp_path):
    pages = tmp_path / "book" / "pages"
    for d in ("_class", "_questions", "_vocab", "_qa"):
        (pages / d).mkdir(parents=True)
    (pages / "page-001.md").write_text('---\npage: 1\ncontent_type: [cover, toc]\nlevel:\nsection: "reading"\nstatus: verified\nqa: pass\n---\n<!-- note -->\n\n# Titel eins\n')
    (pages / "page-002.md").write_text("---\npage: 2\ncontent_type: [exercise]\nstatus: transcribed\n---\nzwei Wörter\n")
    late, early = pages / "_class" / "chunk-1-50.json", pages / "_class" / "chunk-25-50.json"
    early.write_text(json.dumps({"items": [{"page": 1, "activity_type": "old", "topic": "t", "summary": "s|s"}]}))
    late.write_text(json.dumps({"items": [{"page": "1", "activity_type": "new", "topic": None, "summary": "s|s"}]}))
    os.utime(early, (1_000_000, 1_000_000))
    os.utime(late, (2_000_000, 2_000_000))
    (pages / "_class" / "chunk-99.json").write_text("{broken")
    (pages / "_questions" / "chunk-1.json").write_text(json.dumps([{"item": "1", "question": "a\nb", "level": None, "source_page": 1}, {"item": "2", "level": ""}]))
    (pages / "_vocab" / "chunk-1.json").write_text(json.dumps({"entries": [{"word": "maison (f)", "article": "la", "source_page": "002"}, {"word": "Maison (f)", "article": "la", "source_page": "002"}, {"word": " "}, {"word": "eau", "gender": "f", "source_page": "001"}]}))
    (pages / "_qa" / "page-001.json").write_text('{"ok": true, "missing_count": 0}')
    (pages / "_qa" / "page-002.json").write_text('{"ok": "false"}')
    (tmp_path / "collections.json").write_text(json.dumps({"collections": [{"slug": "book", "level": "A1", "frozen": False, "caveats": []}, {"slug": "other", "level": "B1", "frozen": True}]}))
    return str(tmp_path)


def test_catalog_from_files(spark, corpus):
    books = files.books(spark, f"{corpus}/collections.json")
    assert rows(books.select("slug", "caveats")) == [("book", []), ("other", None)]
    cat = sheets.catalog(files.pages(spark, corpus), files.classes(spark, corpus), books)
    got = {r.unit: r for r in cat.collect()}
    a, b = got["page-001"], got["page-002"]
    assert (a.section, a.content_type, a.activity_type, a.topic, a.level, a.title, a.word_count) == ("reading", "[cover, toc]", "new", "", "", "Titel eins", 6)
    assert (b.level, b.activity_type, b.title, b.qa) == ("A1", "", "zwei Wörter", "")
    assert sheets.document(cat).first().text == "| 001 | reading | new |  | s/s |\n| 002 |  |  |  | zwei Wörter |"
    assert rows(files.classes(spark, corpus, by_name=True).select("activity_type")) == [("new",)]
    assert rows(files.verdicts(spark, corpus).select("unit", "ok")) == [("page-001", True), ("page-002", False)]
    assert rows(files.header_window(spark, corpus)) == [("book", "page-001", "verified", "pass"), ("book", "page-002", "transcribed", "")]


def test_questions_and_vocabulary(spark, corpus):
    books = files.books(spark, f"{corpus}/collections.json")
    q = sheets.questions(files.questions(spark, corpus), books)
    assert rows(q.select("item", "question", "level", "option_a", "source_page")) == [("1", "a b", "A1", "", "1"), ("2", "", "", "", "")]
    v = files.vocabulary(spark, corpus)
    assert [r.word for r in v.collect()] == ["eau", "maison (f)"]
    assert rows(sheets.vocabulary(v).select("word", "gender")) == [("eau", "f"), ("maison (f)", "f")]
    assert sheets.columns("catalog", {"catalog": ["chapter"]}) == [c for c in quality.CANONICAL["catalog"] if c != "chapter"]


def test_sheet_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 'x "y", z', "1\n2"), ("b", "", None)], "k string, v string, w string")
    path = str(tmp_path / "out.csv")
    assert sinks.write_single_sheet(df, path, ["k", "v", "w"]) == 2
    assert open(path, "rb").read().startswith(b"\xef\xbb\xbfk,v,w")
    assert files.sheet_size(spark, path) == (["k", "v", "w"], 2)
    assert rows(files.sheet(spark, path)) == [("a", 'x "y", z', "1\n2"), ("b", "", "")]
    with pytest.raises(ValueError):
        sinks.write_single_sheet(df, path, ["k"], most_rows=1)
    assert files.sheet_size(spark, path)[1] == 2


def test_failed_write_leaves_the_old_file(tmp_path):
    path = str(tmp_path / "x.txt")
    sinks.write_text(path, "old")
    with pytest.raises(UnicodeEncodeError):
        sinks.write_text(path, "nü", encoding="ascii")
    assert open(path).read() == "old" and os.listdir(tmp_path) == ["x.txt"]


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "collection string, n int")
    path = str(tmp_path / "t")
    assert sinks.reconciled(df, path) == 2
    sinks.write_table(spark.createDataFrame([("a", 9)], "collection string, n int"), path, replace_touched_only=True)
    assert rows(spark.read.parquet(path).select("collection", "n")) == [("a", 9), ("b", 2)]
    sinks.write_sheets(df.withColumn("extra", F.lit(1)), str(tmp_path / "s"), ["n"], ["collection"])
    assert sorted(os.listdir(tmp_path / "s"))[-2:] == ["collection=a", "collection=b"]


def test_tsv_and_pages(spark, tmp_path, one):
    p = tmp_path / "m.tsv"
    p.write_text("collection\tunit\tstatus\nb\tpage-001\n\n  \nb\tpage-002\tdone\textra\n")
    assert rows(files.tsv(spark, str(p), ["collection", "unit", "status"])) == [("b", "page-001", ""), ("b", "page-002", "done")]
    assert rows(sinks.tsv_lines(spark.createDataFrame([("a\tb", None)], "x string, y string"), ["x", "y"])) == [("a b\t",)]
    page = "---\na: 1\nqa: pending\n---\nbody"
    f = lambda c: sinks.with_fields(c, {"qa": F.lit("pass"), "new": F.lit("n")})
    assert one(f, page) == "---\na: 1\nqa: pass\nnew: n\n---\nbody"
    assert one(f, "plain") == "plain"
    g = lambda ok: lambda c: sinks.with_issues(c, F.lit(ok), F.array(F.lit("x"), F.lit("y")))
    bad = one(g(False), "t\n")
    assert bad == "t\n\n<!-- QA ISSUES:\n- x\n- y\n-->\n"
    assert one(g(False), bad) == bad and one(g(True), bad) == "t\n"
    merged = sinks.merged_json(spark.createDataFrame([("b", "10", "y", "c1"), ("b", "2", "x", "c1")], "collection string, page string, q string, _chunk string"), ["page"], ["page", "q"])
    assert json.loads(merged.first().json) == {"collection": "b", "items": [{"page": "10", "q": "y"}, {"page": "2", "q": "x"}]}
    assert rows(sinks.pruned(spark.createDataFrame([("a",), ("b",)], "path string"), spark.createDataFrame([("a",)], "path string"))) == [("b",)]


def test_books(spark):
    books = spark.createDataFrame([("a", "f", "", "x/l-eau.pdf", "A1", "", False), ("b", "f", "T", None, None, "other", True)], "slug string, family string, title string, pdf string, level string, pipeline string, frozen boolean")
    assert rows(books.select(sheets.display_title(books).alias("t"))) == [("A1 -  - L Eau",), ("T",)]
    assert rows(sheets.engine_books(books).select("slug")) == [("a",)]
    assert sheets.targets(books, ["b"]).count() == 1 and sheets.targets(books).count() == 2
    r = spark.createDataFrame([("a",), ("b",)], "collection string")
    assert rows(sheets.writable(r, books)) == [("a",)] and sheets.writable(r, books, include_frozen=True).count() == 2
    assert rows(books.select(sheets.tag_line(F.col("slug"), F.lit(""), F.lit(None)).alias("t"))) == [("a",), ("b",)]
    assert X.FILLED
