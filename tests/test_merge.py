from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quire.operators import merge

from .conftest import rows


def test_last_write_wins_by_time_not_name(spark):
    df = spark.createDataFrame([(1, "b-late-name", 1, "old"), (1, "a-early-name", 2, "new"), (2, "x", 1, "only"), (1, "a-early-name", 2, "new")], "page int, chunk string, t int, v string")
    out = merge.last_write_wins(df, ["page"], ["t", "chunk"])
    assert rows(out.select("page", "v")) == [(1, "new"), (2, "only")]
    assert rows(merge.last_write_wins(out, ["page"], ["t", "chunk"])) == rows(out)
    assert rows(merge.overwrites(df.selectExpr("'b' as book", "page"), ["book"], "page")) == [("b", 2)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.sampled_from(["a", "b", None])), max_size=20))
def test_merge_does_not_depend_on_partitions(spark, data):
    df = spark.createDataFrame([(k, t, v, i) for i, (k, t, v) in enumerate(data)], "k int, t int, v string, i int")
    a = rows(merge.last_write_wins(df.repartition(3), ["k"], ["t", "i"]))
    assert a == rows(merge.last_write_wins(df.coalesce(1), ["k"], ["t", "i"]))
    assert len(a) == len({k for k, _, _ in data})


def test_vocabulary_keeps_first_and_drops_empty(spark):
    df = spark.createDataFrame([("b", "Haus ", "das", "1", 2), ("b", "haus", "das", "1", 1), ("b", " ", "x", "1", 1), ("b", None, "x", "1", 1), ("b", "haus", None, "1", 3), ("b", "haus", "", "1", 4)], "collection string, word string, article string, source_page string, pos int")
    assert rows(merge.vocabulary_entries(df, ["pos"]).select("pos")) == [(1,), (3,)]


def test_collisions_only_across_chunks(spark):
    df = spark.createDataFrame([("1", "A", "a", "c1"), ("1", "A", "a", "c2"), ("1", "B", "a", "c1"), ("1", "B", "a", "c1"), (None, "A", "a", "c1"), ("", "A", "a", "c3")], "source_page string, part string, item string, chunk string")
    assert rows(merge.collisions(df, ["source_page", "part", "item"], "chunk")) == [("", "A", "a", 2), ("1", "A", "a", 2)]


def test_blocks(spark):
    df = spark.createDataFrame([(1, 0, "heading", "x"), (1, 1, "paragraph", "x"), (1, 2, "heading", "x"), (1, 3, "list", None), (1, 4, "list", None), (2, 0, "heading", "x")], "page_id int, ord int, type string, text string")
    out = merge.without_repeats(df)
    assert rows(out.where("page_id = 1").select("ord", "type")) == [(0, "heading"), (1, "paragraph"), (2, "list"), (3, "list")]
    assert rows(merge.without_repeats(out)) == rows(out)
