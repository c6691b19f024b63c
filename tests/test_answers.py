import pytest
from pyspark.sql import functions as F

from quire.operators import answers as A

from .conftest import rows

SCHEMA = "question_id int, collection string, item_type string, correct_answer string, option_a string, option_b string, option_c string, option_d string, option_e string, level string, source_page string"


def item(kind, answer, *options):
    return (1, "b", kind, answer, *(list(options) + [None] * 5)[:5], "A1", "001")


@pytest.mark.parametrize(
    ("row", "lang", "fixed", "issue"),
    [
        (item("true-false", " vrai"), "fr", "Vrai", None),
        (item("true-false", "Faux"), "fr", "Faux", None),
        (item("true-false", "  faux -- Il EST là"), "fr", "  Faux -- Il EST là", None),
        (item("true-false", "fauxx"), "fr", "fauxx", "starts with no expected term"),
        (item("true-false", "pas mentionné."), "fr", "Pas mentionné.", None),
        (item("true-false", "richtig"), "de", "Richtig", None),
        (item("true-false", "true"), "xx", "True", None),
        (item("multiple-choice", "B.", "one", "two"), "fr", "two", None),
        (item("multiple-choice", "c", "one", "two"), "fr", "c", "names a missing option"),
        (item("multiple-choice", "one et two", "one", "two", "three"), "fr", "one et two", None),
        (item("multiple-choice", "four", "one", "two"), "fr", "four", "not among its options"),
        (item("multiple-choice", "tw", "one", "two"), "fr", "tw", None),
        (item("multiple-choice", "four"), "fr", "four", None),
        (item("open-ended", "[open-ended]"), "fr", "[open-ended]", "open-ended in another format"),
        (item("open-ended", "(open-ended: x)"), "fr", "(open-ended: x)", None),
        (item("lesson", "x"), "fr", "x", "unknown item type"),
        (item("short-answer", ""), "fr", "", None),
        (item("short-answer", None), "fr", None, None),
        (item(None, None), "fr", None, "unknown item type"),
    ],
)
def test_check(spark, row, lang, fixed, issue):
    out = A.check(spark.createDataFrame([row], SCHEMA), F.lit(lang)).first()
    assert (out.fixed, out.issue) == (fixed, issue)


def test_key_status_and_levels(spark):
    items = spark.createDataFrame([(k, "p", "short-answer", "" if k < 3 else "x", *[None] * 5, "A1" if k % 2 else "", f"{k:03d}") for k in range(10)] + [(k, "s", "short-answer", "x", *[None] * 5, "B9", "001") for k in range(4)] + [(9, "s", "open-ended", None, *[None] * 5, "A1", "001")], SCHEMA)
    books = spark.createDataFrame([("p", "printed", "inferred", ["A1"]), ("s", "none", "inferred", ["A1"]), ("f", "none", "fixed", None)], "slug string, answer_key_status string, level_mode string, level_options array<string>")
    assert rows(A.key_status(items, books).select("collection", "finding")) == [("p", "printed, but many blanks"), ("s", "hardly any blanks")]
    assert rows(A.level_gaps(items, books)) == [("p", "missing", 5, 5, "000"), ("s", "invalid", 4, 1, "001")]


def test_accepted(spark):
    flags = spark.createDataFrame([("b", "1/a: odd"), ("b", "2/b: odd"), ("c", "1/a: odd")], "collection string, flag string")
    ok = spark.createDataFrame([("b", ["1/a"])], "collection string, keys array<string>")
    assert rows(A.without_accepted(flags, ok)) == [("b", "2/b: odd"), ("c", "1/a: odd")]
