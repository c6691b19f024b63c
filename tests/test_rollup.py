from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators import audio, explore, rollup

from .conftest import rows


def test_counts(spark):
    df = spark.createDataFrame([("", "[a, b]"), (None, "[a]"), ("none", "")], "s string, t string")
    assert rows(rollup.value_counts(df, "s")) == [("(none)", 2), ("none", 1)]
    assert [tuple(r) for r in rollup.count_table(rollup.token_counts(df, "t")).collect()] == [("a", 2), ("b", 1)]


def test_sparse_and_coverage(spark):
    df = spark.createDataFrame([("b", "", "x" if k == 0 else " ", "y") for k in range(20)], "collection string, e string, r string, f string")
    assert rows(rollup.sparse_columns(df, ["e", "r", "f", "absent"]).select("column", "finding")) == [("e", "empty throughout"), ("r", "rarely filled")]
    floors = spark.createDataFrame([("b", "e", 0.0), ("b", "r", 95.0), ("b", "f", 95.0)], "collection string, column string, floor double")
    assert rows(rollup.coverage(df, floors, ["e", "r", "f"]).select("column")) == [("r",)]
    assert rollup.sparse_columns(df.limit(0), ["e"]).count() == 0


def test_tiers_sum_up(spark):
    df = spark.createDataFrame([("f", "a"), ("f", "b"), ("g", "c"), (None, "c")], "family string, collection string")
    out = rows(rollup.tiers(df, ["family", "collection"], {"n": F.count(F.lit(1))}))
    assert (None, None, 0, 4) in out and sum(r[3] for r in out if r[2] == 2) == 4
    assert (None, None, 1, 1) in out  # the family that is null isn't all families


def test_top_with_rest(spark):
    df = spark.createDataFrame([("a", 5), ("b", 3), ("c", 1), ("d", 1)], "value string, n long")
    assert rows(rollup.top_with_rest(df, 2)) == [("Other", 2, 0.2), ("a", 5, 0.5), ("b", 3, 0.3)]
    assert rows(rollup.top_with_rest(df, 9).select("value")) == [("a",), ("b",), ("c",), ("d",)]


def test_running_share(spark):
    df = spark.createDataFrame([("g", "a", 1), ("g", "b", 3)], "g string, k string, n long")
    assert rows(rollup.running_share(df, ["g"], ["k"], "n").select("k", "share", "start")) == [("a", 0.25, 0.0), ("b", 0.75, 0.25)]


def test_kpis_and_explorer(spark):
    df = spark.createDataFrame([("b1", "x", "t"), ("b1", "", ""), ("b2", None, None), ("b2", "ab", "AB")], "collection string, correct_answer string, topic string")
    assert tuple(rollup.kpis(df, "collection", X.filled(F.col("correct_answer")), "topic").first()) == (4, 2, 50, 3)
    assert rollup.kpis(df.limit(0), "collection", X.filled(F.col("correct_answer")), "topic").first().pct_answered is None
    assert explore.equal_filters(df, {"topic": "ab"}).count() == 1
    assert explore.equal_filters(df, {"topic": "a"}).count() == 0
    assert explore.search(df, "B").count() == 4 and explore.search(df, "ab").count() == 1 and explore.search(df, " ").count() == 4
    assert rows(explore.options(df, ["topic"])) == [("topic", "AB"), ("topic", "t")]
    assert [r.collection for r in explore.explore(df, order=[F.desc("collection"), "correct_answer"], size=1, number=1).collect()] == ["b2"]
    assert rows(explore.detail(df.limit(1).withColumn("id", F.lit(7)), "id", ["topic"]).select("column")) == [("collection",), ("correct_answer",), ("topic",)]


def test_manifest(spark):
    df = spark.createDataFrame([("b", "page-001", "verified", "pass"), ("b", "page-002", "pending", ""), ("b", "page-003", "pending", "fail")], "collection string, unit string, status string, qa string")
    assert rows(rollup.manifest_totals(df, ["collection"])) == [("b", 3, 1, 1, 33, 33)]
    assert rows(rollup.pending_range(df, ["collection"])) == [("b", 2, "page-002", "page-003")]
    assert rows(rollup.page_stats(df, ["collection"])) == [("b", 3, 1, 1, 1, 1)]


def test_image_health(spark):
    def hist(**at):
        h = [0] * 256
        for k, v in at.items():
            h[int(k[1:])] = v
        return (h,)

    df = spark.createDataFrame([hist(_255=10000), hist(_255=9999, _254=1), hist(_0=6000, _255=4000), hist(_60=5000, _90=5000), hist(_0=500, _100=500, _255=9000)], "h array<int>")
    got = [r[0] for r in df.select(rollup.image_health(rollup.histogram_stats(F.col("h")))).collect()]
    assert got == ["blank", "blank", "degenerate", "ok", "ok"]


def test_audio(spark):
    df = spark.createDataFrame([("t", 61.0, 62.0, " b ", -1.5, 0.1), ("t", 0.5, 1.0, "a", -0.2, 0.1), ("t", 70.0, 71.0, "c", None, 0.7)], "track string, start double, end double, text string, avg_logprob double, no_speech_prob double")
    assert rows(audio.transcript(df)) == [("t", "[00:00] a\n[01:01] b (?)\n[01:10] c (?)", 3, 2)]


def test_header_shapes(spark):
    df = spark.createDataFrame([("q", ["a", "b"]), ("q", ["a", "b"]), ("v", ["a"]), ("v", ["b"])], "kind string, header array<string>")
    assert rows(rollup.header_shapes(df)) == [("v", 2)]
