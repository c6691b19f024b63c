from pyspark.sql import functions as F

from quire.operators import relations as R

from .conftest import rows


def test_enrich_and_update(spark):
    a = spark.createDataFrame([(1, "old", ""), (2, "old", "x")], "k int, v string, w string")
    b = spark.createDataFrame([(1, "new", ""), (3, "z", "z")], "k int, v string, w string")
    assert rows(R.enrich(a.select("k"), b.selectExpr("k", "v as t"), ["k"], {"t": ""})) == [(1, "new"), (2, "")]
    assert rows(R.update(a, b, ["k"], ["v", "w"])) == [(1, "new", ""), (2, "old", "x")]


def test_seed_is_idempotent(spark):
    have = spark.createDataFrame([("b", "page-001", "done")], "collection string, unit string, status string")
    want = spark.createDataFrame([("b", "page-001", "pending"), ("b", "page-002", "pending")], "collection string, unit string, status string")
    out = R.seed(have, want, ["collection", "unit"])
    assert rows(out) == [("b", "page-001", "done"), ("b", "page-002", "pending")]
    assert rows(R.seed(out, want, ["collection", "unit"])) == rows(out)


def test_verdicts(one):
    got = [one(R.verdict_ok, v) for v in ['{"ok":true,"missing_count":0}', '{"ok":true}', '{"ok":false}', '{"ok":"true"}', "{}", '{"ok":true,"missing_count":3}', "broken", None]]
    assert got == [True, True, False, False, False, False, False, False]


def test_cascade(spark):
    want = spark.createDataFrame([(k,) for k in range(1, 5)], "p int")
    pages = spark.createDataFrame([(1,), (2,), (3,)], "p int")
    told = spark.createDataFrame([(1, True), (2, False), (4, True)], "p int, ok boolean")
    assert rows(R.cascade(want, pages, told, ["p"])) == [(1, "ok"), (2, "qa_fail"), (3, "missing_qa"), (4, "missing_md")]


def test_dangling(spark):
    q = spark.createDataFrame([(1, "b", "001"), (2, "b", "999"), (3, "b", ""), (4, "b", None), (5, "c", "1")], "id int, book string, source_page string")
    cat = spark.createDataFrame([("b", "page-001")], "book string, unit string")
    assert rows(R.dangling(q, cat, "book", "source_page", "unit").select("id")) == [(2,), (5,)]


def test_split_partitions_failures(spark):
    f = spark.createDataFrame([("a",), ("b",)], "k string")
    new, acc = R.accepted_split(f, spark.createDataFrame([("b",), ("z",), ("b",)], "k string"), ["k"])
    assert rows(new) == [("a",)] and rows(acc) == [("b",)]
    assert rows(new.unionByName(acc)) == rows(f)


def test_write_back_null_safe(spark):
    items = spark.createDataFrame([("1", "a", "Q", "vrai"), (None, None, "Q", "x"), ("2", "b", None, "y")], "source_page string, item string, question string, correct_answer string")
    fixed = spark.createDataFrame([("1", "a", "Q", "Vrai", 1), (None, None, "Q", "X", 1), (None, None, "Q", "XX", 2)], "source_page string, item string, question string, correct_answer string, pos int")
    assert rows(R.write_back(items, fixed, "pos").select("correct_answer")) == [("Vrai",), ("XX",), ("y",)]


def test_compare(spark):
    old = spark.createDataFrame([(0, {"a": "1", "b": "2"}), (1, {"a": "1"})], "pos int, record map<string,string>")
    new = spark.createDataFrame([(0, {"a": "1", "b": "3", "c": None}), (2, {"a": "9"})], "pos int, record map<string,string>")
    assert rows(R.zip_compare(old, new, ["pos"])) == [(0, ["b"], False, False), (1, ["a"], False, True), (2, ["a"], True, False)]
    a = spark.createDataFrame([("p", "x\n> Generated 2026-01-01. y"), ("q", "a\r\n"), ("n", "1")], "path string, content string")
    b = spark.createDataFrame([("p", "x\n> Generated 2025-01-01. y"), ("q", "a\n"), ("g", "1")], "path string, content string")
    assert rows(R.compare_builds(a, b)) == [("g", "GONE"), ("n", "NEW"), ("p", "same"), ("q", "STALE")]


def test_columns_and_options(spark):
    assert R.column_differences(["b", "a", "x"], ["a", "b", "c", "d"], ["d"]) == {"extra": ["x"], "missing": ["c"], "ordered": False}
    df = spark.createDataFrame([("B.", "one", "two")], "l string, option_a string, option_b string")
    assert df.select(R.answer_option(F.col("l"), {"a": "option_a", "b": "option_b"})).first()[0] == "two"
    dim = spark.createDataFrame([("h", "adapter")], "host string, adapter string")
    assert rows(R.first_match(spark.createDataFrame([("h",), ("x",)], "host string"), dim, "host", "adapter", "generic")) == [("h", "adapter"), ("x", "generic")]
