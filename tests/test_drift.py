import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from quire.operators import drift as D
from quire.plans import queries as Q

from .conftest import rows

T0 = datetime(2026, 1, 1)
SCHEMA = "raw_id long, feed_id long, file_name string, written_at timestamp, payload string, field string, kind string, before string"


def records(spark, files):
    """files: (feed, name, hours, [payloads]); the extra columns clash with names used inside."""
    out = []
    for feed, name, hours, payloads in files:
        for p in payloads:
            out.append((len(out), feed, name, T0 + timedelta(hours=hours), p if isinstance(p, str) or p is None else json.dumps(p), "x", "y", "z"))
    return spark.createDataFrame(out, SCHEMA)


def changed(df):
    return rows(df.select("feed_id", "file_name", "change", "field_before", "field_after"))


def test_all_kinds_of_changes(spark):
    files = [
        (1, "z.json", 0, [{"level": "A1", "part": 1, "topic": "food"}, {"level": "B1", "part": 2, "topic": "home"}]),
        (1, "a.json", 1, [{"niveau": "B1", "part": 3, "topic": "home"}, {"niveau": "A2", "part": 1, "topic": None}]),
        (1, "m.json", 2, [{"niveau": "A1", "part": "3", "reviewer": "rv-1"}, {"niveau": "A2", "part": "4", "reviewer": "rv-2"}]),
        (1, "n.json", 3, [{"niveau": {"code": "A1"}, "part": ["4"], "reviewer": "rv-3"}]),
        (2, "a.json", 5, [{"only": True}]),
    ]
    df = records(spark, files)
    want = [
        (1, "a.json", "renamed", "level", "niveau"),
        (1, "m.json", "added", "", "reviewer"),
        (1, "m.json", "removed", "topic", ""),
        (1, "m.json", "retyped", "part", "part"),
        (1, "n.json", "retyped", "niveau", "niveau"),
        (1, "n.json", "retyped", "part", "part"),
    ]
    assert changed(D.changes(df)) == want
    assert changed(D.changes(df.repartition(7))) == want
    assert changed(D.changes(df.unionByName(df))) == want  # repeated records


def test_a_rename_needs_the_same_type_and_kind(spark):
    files = [
        (1, "a", 0, [{"level": "A1", "n": 1}] * 3),
        (1, "b", 1, [{"code": ["A1"], "n": 1}] * 3),
        (1, "c", 2, [{"summary": f"A long text about item {k} of the list", "n": 1} for k in range(3)]),
        (1, "d", 3, [{"reviewer": f"rv-{k}", "n": 1} for k in range(3)]),
    ]
    assert [r[2:] for r in changed(D.changes(records(spark, files)))] == [
        ("added", "", "code"), ("removed", "level", ""), ("added", "", "summary"), ("removed", "code", ""), ("added", "", "reviewer"), ("removed", "summary", ""),
    ]


def test_edges(spark):
    files = [
        (1, "a", 0, [{"x": 1}, None, "broken", "[1]", "{}", ""]),
        (1, "b", 1, [None, "broken"]),
        (1, "c", 2, [{"x": None}]),
        (1, "d", 3, [{"x": "t" * 200_000, "y": 1.5}]),
        (1, "e", 3, [{"x": "t", "y": "1"}, {"x": "t", "y": 2}, {"x": "t", "y": 3}]),
    ]
    assert changed(D.changes(records(spark, files))) == [(1, "b", "removed", "x", ""), (1, "d", "added", "", "x"), (1, "d", "added", "", "y")]
    assert D.changes(records(spark, files).limit(0)).count() == 0


def test_order_within_many_files(spark):
    files = [(k % 2, f"f{997 * k % 1000:03d}", k, [{("a" if (k // 2) % 3 else "b"): k}]) for k in range(200)]
    got = {(r[0], r[1]) for r in changed(D.changes(records(spark, files).repartition(16)))}
    want = set()
    for feed in (0, 1):
        ordered = [f for f in files if f[0] == feed]
        want |= {(feed, f[1]) for p, f in zip(ordered, ordered[1:]) if set(p[3][0]) != set(f[3][0])}
    assert got == want


def test_ingest_rescues_and_promotes(spark):
    target = {"level": "string", "n": "bigint", "x": "double", "ok": "boolean", "tags": "array<string>"}
    payloads = [
        {"level": "A1", "n": 2, "x": 1.5, "ok": True, "tags": ["a", "b"]},
        {"level": {"code": "B1"}, "n": "x", "ok": "true", "tags": "a", "other": {"k": [1]}},
        {"niveau": "C1", "n": 2.5, "x": "7"},
        {"level": None, "niveau": None},
        "broken",
        None,
        {"level": 7, "Level": "A2"},
    ]
    got = D.ingest(records(spark, [(1, "f", 0, payloads)]), target)
    out = {r.raw_id: r for r in got.collect()}
    assert (out[0].level, out[0].n, out[0].x, out[0].ok, out[0].tags, out[0]._rescued) == ("A1", 2, 1.5, True, ["a", "b"], None)
    assert out[1].level is None and json.loads(out[1]._rescued) == {"level": {"code": "B1"}, "n": "x", "ok": "true", "tags": "a", "other": {"k": [1]}}
    assert (out[2].n, out[2].x) == (None, 7.0) and json.loads(out[2]._rescued) == {"niveau": "C1", "n": 2.5}
    assert out[3]._rescued is None and out[5]._rescued is None
    assert json.loads(out[4]._rescued) == {"_corrupt": "broken"}
    assert out[6].level == "7" and json.loads(out[6]._rescued) == {"Level": "A2"}
    again = {r.raw_id: r for r in D.promote(got, {"level.code": "level", "niveau": "level", "Level": "level"}, target).collect()}
    assert [again[k].level for k in range(7)] == ["A1", "B1", "C1", None, None, None, "7"]
    assert json.loads(again[1]._rescued) == {"n": "x", "ok": "true", "tags": "a", "other": {"k": [1]}}
    assert json.loads(again[6]._rescued) == {"Level": "A2"}
    # Nothing is lost on the way: typed and rescued fields together are the fields of the record.
    for k, p in enumerate(payloads):
        if isinstance(p, dict):
            typed = {c for c in target if again[k][c] is not None}
            held = set(json.loads(again[k]._rescued or "{}"))
            assert {f for f, v in p.items() if v is not None} == {*typed, *held} - ({"level"} if k in (1, 2) else set()) | ({"level"} if k == 1 else set()) | ({"niveau"} if k == 2 else set())
    assert D.ingest(records(spark, [(1, "f", 0, payloads)]).limit(0), target).count() == 0
    assert got.where(F.col("n").isNotNull()).count() == 1


def test_promote_takes_a_path_only(spark):
    target = {"level": "string", "part": "string", "topic": "string", "tags": "array<string>"}
    payloads = [
        {"level": {"code": "B1", "inferred": True}},
        {"level": ["A1", "A2"]},
        {"level": {"code": {"name": "C1", "by": None}, "inferred": None}},
        {"part": ["x", "y", "z"]},
        {"level": {"inferred": True}, "part": []},
        {"words": ["a", "b"]},
        {"level": [{"code": "B2", "n": 1.5}, None]},
        {"level": "B1", "cefr": {"code": "A1"}},
    ]
    approved = {
        "level.code": "level", "level.code.name": "level", "level[0]": "level", "level[0].code": "level", "cefr.code": "level",
        "part[0]": "part", "part[1]": "topic", "words[0]": "topic", "words": "tags",
    }
    got = D.promote(D.ingest(records(spark, [(1, "f", 0, payloads)]), target), approved, target)
    out = [(r.level, r.part, r.topic, r.tags, r._rescued and json.loads(r._rescued)) for r in got.orderBy("raw_id").collect()]
    assert out == [
        ("B1", None, None, None, {"level": {"inferred": True}}),
        ("A1", None, None, None, {"level": ["A2"]}),
        ("C1", None, None, None, {"level": {"code": {"by": None}, "inferred": None}}),
        (None, "x", "y", None, {"part": ["z"]}),
        (None, None, None, None, {"level": {"inferred": True}, "part": []}),
        (None, None, "a", None, {"words": ["b"]}),
        ("B2", None, None, None, {"level": [{"n": 1.5}, None]}),
        ("B1", None, None, None, {"cefr": {"code": "A1"}}),
    ]


NAMES = {"Level": "level", "niveau": "level", "cefr": "level", "groupLabel": "part", "exercise_group": "part", "partie": "part", "kapitel": "chapter", "lesson": "chapter", "grade": "level"}
FORMS = {"level": [(".code",), ("[0]",)], "part": [(".label", ".no"), (".label",), (".no",), ("[0]",)], "chapter": [(".no",), (".title",), ("[0]",)]}


def test_table_replays_all_forms_and_renames(spark):
    payloads = [
        {"part": {"label": "Teil", "no": 9}, "chapter": {"no": 2, "title": "Beim Arzt"}, "Level": {"code": "B1", "inferred": True}},
        {"groupLabel": ["Aufgabe 6"], "kapitel": ["3", "Ferien"], "niveau": ["A2"]},
        {"exercise_group": {"no": 4}, "lesson": {"title": "Ferien"}, "cefr": {"code": "C1"}},
        {"partie": {"label": "Partie"}, "chapter": 3, "level": ["B2"]},
    ]
    files = [(1, "f", 0, payloads), (2, "a", 0, [{"level": f"A{k % 2 + 1}", "reviewer": "x"} for k in range(4)]), (2, "b", 1, [{"grade": f"A{k % 2 + 1}", "reviewer": "x"} for k in range(4)])]
    got = D.consistent(records(spark, files), names=NAMES, of=FORMS).orderBy("raw_id").collect()
    assert [(r.part, r.chapter, r.level, r._rescued and json.loads(r._rescued)) for r in got[:4]] == [
        ("Teil 9", "2", "B1", {"chapter": {"title": "Beim Arzt"}, "Level": {"inferred": True}}),
        ("Aufgabe 6", "3", "A2", {"kapitel": ["Ferien"]}),
        ("4", "Ferien", "C1", None),
        ("Partie", "3", "B2", None),
    ]
    assert [r.level for r in got[8:12]] == ["A1", "A2", "A1", "A2"]  # grade


def test_names_and_forms_never_seen_before_are_promoted(spark, tmp_path):
    """Nothing tells the operator of these names but how their files follow one another and what their values are like."""
    code, levels = lambda k: f"A{k % 2 + 1}", range(6)
    files = [
        (1, "a", 0, [{"level": code(k), "part": f"Teil {k}", "n": k} for k in levels]),
        (1, "b", 1, [{"zorbl": code(k), "part": f"Teil {k}", "n": k} for k in levels]),
        (1, "c", 2, [{"zorbl": {"qx": code(k), "sure": True}, "part": {"w": "Teil", "v": k}, "n": k} for k in levels]),
        (2, "a", 0, [{"zorbl": code(k)} for k in levels]),
        (2, "b", 1, [{"gnarf": [code(k), "rest"]} for k in levels]),
        (2, "c", 2, [{"zorbl": [code(k), "rest"]} for k in levels]),
    ]
    raw = records(spark, files).withColumns({"sheet": F.lit("s"), "collection": F.lit("c")})
    raw.write.parquet(str(tmp_path / "raw_records.parquet"))
    got = Q.p6_table(spark, str(tmp_path)).orderBy("raw_id").collect()
    want = [code(k) for k in levels]
    assert [r.level for r in got] == want * 6
    assert [r.part for r in got[12:18]] == [f"Teil {k}" for k in levels]
    assert json.loads(got[12]._rescued) == {"zorbl": {"sure": True}, "n": 0} and json.loads(got[24]._rescued) == {"gnarf": ["rest"]}


def test_ingested_rows_hold_every_field_once(spark):
    payloads = [{"level": 7, "part": "x", "difficulty": "3", "tags": ["a"], "new": {"k": 1}, "none": None, "_corrupt": "y"}, "broken", None, {}]
    rows_ = D.ingest(records(spark, [(1, "f", 0, payloads)]), kinds=True)
    got = {(r.field, r.kind, r.text, r.known) for r in D.observed(rows_, keys=("raw_id",)).collect()}
    assert got == {("level", "number", "7", True), ("part", "string", "x", True), ("difficulty", "string", "3", True), ("tags", "array", '["a"]', True), ("new", "object", '{"k":1}', False), ("_corrupt", "string", "y", False)}


def test_aliases_are_of_one_column(spark):
    renamed = [("level", "grade"), ("grade", "rank"), ("both", "rank2"), ("part", "both"), ("topic", "both"), ("summary", "topic"), ("niveau", "stufe")]
    found = spark.createDataFrame([(1, "f", "renamed", a, b) for a, b in renamed] + [(1, "f", "added", "", "x")], "feed_id long, file_name string, change string, field_before string, field_after string")
    assert D.aliases(found, {"niveau": "level"}) == {"niveau": "level", "grade": "level", "rank": "level", "stufe": "level"}


def test_long_shapes_count_whole(spark):
    files = [(1, "a", 0, [{"x": "ab " * 110 + "!", "n": 1}] * 2), (1, "b", 1, [{"y": "cd " * 110 + "?", "n": 1}] * 2)]
    assert [r[2:] for r in changed(D.changes(records(spark, files)))] == [("added", "", "y"), ("removed", "x", "")]
