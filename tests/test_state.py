from pyspark.sql import functions as F

from quire.streaming import state as S

from .conftest import rows

SCHEMA = "slug string, status string, content_hash string, n int"


def test_upsert_and_staleness(spark):
    old = spark.createDataFrame([("a", "verified", "h1", 1), ("b", "failed", "h2", 1)], SCHEMA)
    new = spark.createDataFrame([("b", "pending", "h3", 2), ("b", "verified", "h3", 3), ("c", "verified", "h4", 1)], SCHEMA)
    out = S.upsert(old, new, ["slug"], ["n"])
    assert rows(out.select("slug", "status", "n")) == [("a", "verified", 1), ("b", "verified", 3), ("c", "verified", 1)]
    assert rows(S.upsert(out, new, ["slug"], ["n"])) == rows(out)
    pages = spark.createDataFrame([("a", "h1"), ("b", "h9"), ("d", "h")], "slug string, content_hash string")
    assert rows(S.stale(pages, out).select("slug")) == [("b",), ("d",)]
    good, bad = S.outcomes(spark.createDataFrame([(1, None), (2, ""), (3, "timeout")], "id int, error string"))
    assert rows(good.select("id")) == [(1,), (2,)] and rows(bad.select("id")) == [(3,)]
    assert S.to_retry(bad.withColumn("attempt", F.lit(4)), 3).count() == 0


def test_status(spark):
    df = spark.createDataFrame([("pending", False, None), ("pending", True, None), ("verified", True, None), ("transcribed", True, True), ("transcribed", True, False)], "s string, t boolean, v boolean")
    assert [r[0] for r in df.select(S.next_status(F.col("s"), F.col("t"), F.col("v"))).collect()] == ["pending", "transcribed", "verified", "verified", "failed"]


def test_stream_equals_batch_and_repeats_safely(spark, tmp_path):
    src = str(tmp_path / "in")
    parts = [[("a", "pending", "1", 1), ("b", "pending", "1", 1)], [("a", "verified", "2", 2)], [("c", "failed", "3", 1), ("a", "failed", "3", 3)]]
    table = S.StateTable(spark, str(tmp_path / "state"), SCHEMA, ["slug"], ["n"])
    for p in parts:
        spark.createDataFrame(p, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(SCHEMA).parquet(src)
        table.follow(stream, str(tmp_path / "check")).awaitTermination()
    whole = spark.createDataFrame([r for p in parts for r in p], SCHEMA)
    batch = S.upsert(spark.createDataFrame([], SCHEMA), whole, ["slug"], ["n"])
    assert rows(table.read()) == rows(batch)
    table.apply(spark.createDataFrame(parts[-1], SCHEMA), 3)
    assert rows(table.read()) == rows(batch)
