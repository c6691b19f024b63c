import pytest
from pyspark.sql import functions as F

from quire.operators import quality as Q

from .conftest import rows


@pytest.mark.parametrize(
    ("cell", "broken"),
    [
        ("<!-- x -->", {"markup"}),
        ("a <b>c", {"markup"}),
        ("a &nbsp;b", {"entity"}),
        ("a  b ", {"double space", "untrimmed"}),
        ("Élève à l'école", set()),
        ("Ã¼ber", {"mojibake"}),
        ("a�", {"replacement character"}),
        ("a\tb", {"newline or tab", "control character"}),
        ("**b**", {"markdown"}),
        ("[a](b)", {"markdown"}),
        ("", set()),
        (None, set()),
    ],
)
def test_hygiene(spark, cell, broken):
    df = spark.createDataFrame([(7, cell), (8, "fine")], "line int, title string")
    found = Q.violations(df, Q.hygiene_rules(["title"]), F.col("line"))
    assert {r.rule for r in found.collect()} == broken
    assert all(r.first_line == 7 and r.n == 1 for r in found.collect())


def test_violations_by_group_and_empty(spark):
    df = spark.createDataFrame([("a", 1, " x"), ("a", 2, "x "), ("b", 3, "y")], "book string, line int, title string")
    found = Q.violations(df, Q.hygiene_rules(["title"]), F.col("line"), ["book"])
    assert rows(found.select("book", "rule", "n", "first_line")) == [("a", "untrimmed", 2, 1)]
    assert Q.violations(df.limit(0), Q.hygiene_rules(["title"]), F.col("line")).count() == 0


def test_taxonomy(spark):
    df = spark.createDataFrame(
        [(2, "hören", "A1", "[cover, defective-image]"), (3, "reading", "A2 (inferred)", "[module-3-de-jour-en-jour]"), (4, "reading", "", None), (5, "Reading", None, "[cover]")],
        "line int, section string, level string, content_type string",
    )
    assert rows(Q.taxonomy(df, F.col("line")).select("column", "value", "first_line", "finding")) == [
        ("content_type", "defective-image", 2, "drift"),
        ("content_type", "module-3-de-jour-en-jour", 3, "slugified prose"),
        ("level", "A2 (inferred)", 3, "not in the closed vocabulary"),
        ("section", "Reading", 5, "not in the closed vocabulary"),
        ("section", "hören", 2, "non-ascii"),
    ]


def test_shape_and_waivers(spark):
    df = spark.createDataFrame(
        [("b", "1", "a", "multiple-choice", "", None), ("b", "1", "b", "multiple-choice", "x", None), ("b", "2", "c", "multiple-choice", " ", ""), ("b", "3", "d", "matching", "", "")],
        "collection string, source_page string, item string, item_type string, option_a string, option_b string",
    ).withColumns({c: F.lit(None).cast("string") for c in ("option_c", "option_d", "option_e")})
    bad = Q.choice_without_options(df)
    assert rows(bad.select("item")) == [("a",), ("c",)]
    ok = spark.createDataFrame([("b", ["1/a", "9/z"]), ("c", ["2/c"])], "collection string, keys array<string>")
    assert rows(Q.waived(bad, ok).select("item")) == [("c",)]


def test_metadata(spark):
    df = spark.createDataFrame([("a", "printed", []), ("b", "", None), ("c", "maybe", ["x"])], "slug string, answer_key_status string, caveats array<string>")
    assert rows(Q.metadata_gaps(df)) == [("b", ["answer_key.status", "caveats"]), ("c", ["answer_key.status=maybe"])]


def test_documents(spark):
    df = spark.createDataFrame([(1, '{"title":"t","n":1}'), (2, '{"title":"","n":0}'), (3, "broken")], "id int, json string")
    found = Q.document_issues(df, "title string, n int", {"title": F.length("_doc.title") > 0, "n": F.col("_doc.n") > 0})
    assert rows(found) == [(2, "n", "invalid"), (2, "title", "invalid"), (3, "", "unreadable")]


def test_ragged(spark):
    df = spark.createDataFrame([(2, ["a", "b"]), (3, ["a"]), (4, ["a", "b", "c"])], "line int, cells array<string>")
    assert tuple(Q.ragged_rows(df, 2, F.col("cells"), F.col("line")).first()) == (2, 3)
