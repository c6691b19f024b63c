"""Problem 6: records whose fields are added, renamed, removed or retyped from file to file.

Ingestion with a rescue column: a record's fields go into the columns of a target schema where their
name is known and their value fits; all else, unknown names and values that don't fit, is kept as JSON in
``_rescued``. ``changes`` reports, from the ingested rows, how the fields of each file differ from those of
the file before it. The renames it finds become the approved names, and the members of rescued objects and
arrays whose values are like a column's become the approved paths; ``promote`` replays the values of both
into the typed columns. ``consistent`` does all of this.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.session import cut

#: Field of the target schema: its type, one of string, bigint, double, boolean, array<string>.
TARGET = {
    "part": "string", "level": "string", "chapter": "string", "item": "string", "item_type": "string",
    "instruction": "string", "question": "string", "correct_answer": "string", "topic": "string",
    "source_page": "string", "unit": "string", "activity_type": "string", "summary": "string",
    "status": "string", "difficulty": "bigint", "confidence": "double", "needs_audio": "boolean", "tags": "array<string>",
}

#: A removed and an added field are one renamed field from this likeness of their values on.
LIKENESS = 0.3

#: More pairs of names than this aren't taken to the driver.
MOST_RENAMES = 10_000


def kind(value: Column) -> Column:
    """The JSON type of a variant: string, number, boolean, array, object; null of a null."""
    name = F.schema_of_variant(value)
    return (
        F.when(name.isNull() | (name == "VOID"), F.lit(None))
        .when(name == "STRING", "string")
        .when(name == "BOOLEAN", "boolean")
        .when(name.startswith("ARRAY"), "array")
        .when(name.startswith("OBJECT"), "object")
        .otherwise("number")
    )


def _fits(value: Column, type_name: str, k: Column | None = None) -> Column:
    """A variant of the JSON type ``k`` in a column's type, or null where that would lose something."""
    k = kind(value) if k is None else k
    if type_name == "string":
        return F.when(k.isin("string", "number"), F.try_variant_get(value, "$", "string"))
    if type_name in ("bigint", "double"):
        # Text counts where it spells a number; a fraction isn't cut to a whole number.
        number = F.try_variant_get(value, "$", "double")
        whole = (number == F.floor(number)) | F.lit(type_name == "double")
        return F.when(k.isin("number", "string") & whole, number.cast(type_name))
    if type_name == "boolean":
        return F.when(k == "boolean", F.try_variant_get(value, "$", "boolean"))
    if type_name == "array<string>":
        return F.when(k == "array", F.try_variant_get(value, "$", "array<string>"))
    raise ValueError(f"no such target type: {type_name}")


def fields(payload: Column) -> Column:
    """The top-level fields of a JSON object that aren't null, as map<string, variant>; null if it is no object."""
    return F.map_filter(F.from_json(payload, "map<string,variant>"), lambda _, v: ~F.is_variant_null(v))


def ingest(records: DataFrame, target: Mapping[str, str] = TARGET, keys: tuple[str, ...] = ("raw_id",), payload: str = "payload", kinds: bool = False) -> DataFrame:
    """keys, a column for each field of ``target``, and ``_rescued``: JSON of all fields that found no column.

    A JSON null is as if the field weren't there. A value that doesn't fit its column leaves it null and
    is rescued under its name. A payload that is no JSON object is rescued whole under ``_corrupt``; a null
    one gives nulls. Of a name given twice the first value is used. With ``kinds`` there is ``_kinds`` too,
    the JSON type of each field as it was written, typed or rescued; it is null for a payload that is no
    object. The scan is one narrow pass that parses each payload once.
    """
    rows = records.select(*keys, F.col(payload).alias("_payload"), fields(F.col(payload)).alias("_fields"))
    rows = rows.withColumn("_kinds", F.transform_values("_fields", lambda _, v: kind(v)))
    typed = [_fits(F.col("_fields")[name], t, F.col("_kinds")[name]).alias(name) for name, t in target.items()]
    got = rows.select(*keys, "_payload", "_fields", "_kinds", *typed)
    lost = [F.when(F.col(name).isNotNull(), F.lit(name)) for name in target]
    rest = F.map_filter("_fields", lambda k, _: ~F.coalesce(F.array_contains(F.array_compact(F.array(*lost)), k), F.lit(False)))
    whole = F.when(F.col("_payload").isNotNull(), F.to_json(F.create_map(F.lit("_corrupt"), F.col("_payload"))))
    rescued = F.when(F.col("_fields").isNull(), whole).when(F.size(rest) > 0, F.to_json(rest))
    return got.select(*keys, *target, rescued.alias("_rescued"), *(["_kinds"] if kinds else []))


def promote(ingested: DataFrame, approved: Mapping[str | tuple[str, ...], str], target: Mapping[str, str] = TARGET, keys: tuple[str, ...] = ("raw_id",)) -> DataFrame:
    """Replay rescued values: each approved name's value goes into its column where that is empty and it fits.

    ``approved`` maps a name found in ``_rescued`` to a column of the target schema, or to a dotted path's
    column as in ``{"level.code": "level"}`` for a field of a rescued object, or ``{"level[0]": "level"}``
    for an element of a rescued array, or ``{("part.label", "part.no"): "part"}`` for several that make one
    text, with a space between, where all are there; the first that fits is taken. What was replayed leaves ``_rescued``;
    all else stays: the other members of an object and the other elements of an array under their name, which
    goes when nothing of it is left. Paths count in the values as rescued, so a path that overlaps one
    replayed before it isn't replayed.
    """
    paths = {source: [source] if isinstance(source, str) else list(source) for source in approved}
    steps = {path: _steps(path) for of in paths.values() for path in of}
    rows = ingested.withColumn("_fields", F.from_json("_rescued", "map<string,variant>")).withColumn("_took", F.array().cast("array<string>"))
    before: list[str] = []
    for part in _apart(approved, paths, steps):
        values = {}
        for k, source in enumerate(part):
            got = [F.try_variant_get(F.col("_fields")[steps[p][0]], "$" + p[len(steps[p][0]) :], "variant") for p in paths[source]]
            if len(got) == 1:
                value = _fits(got[0], target[approved[source]])
            else:
                texts = [_fits(v, "string") for v in got]
                joined = F.when(F.array_size(F.array_compact(F.array(*texts))) == len(texts), F.concat_ws(" ", *texts))
                value = joined.cast(target[approved[source]])
            over = [p for p in before if any(_overlap(steps[p], steps[q]) for q in paths[source])]
            values[f"_v{k}"] = F.when(~F.arrays_overlap("_took", F.array(*map(F.lit, over))), value) if over else value
        rows = rows.withColumns(values)
        ways: dict[str, list[tuple[str, list[str]]]] = {}
        for v, source in zip(values, part):
            ways.setdefault(approved[source], []).append((v, paths[source]))
        none = F.array().cast("array<string>")
        which = [F.when(F.col(c).isNull(), F.coalesce(*[F.when(F.col(v).isNotNull(), F.array(*map(F.lit, of))) for v, of in found], none)).otherwise(none) for c, found in ways.items()]
        filled = {c: F.coalesce(c, *[v for v, _ in found]) for c, found in ways.items()}
        rows = rows.withColumns({"_took": F.concat("_took", *which), **filled}).drop(*values)
        before += [p for source in part for p in paths[source]]
    tree: dict = {}
    for source, path in steps.items():
        at = tree
        for step in path:
            at = at.setdefault(step, {})
        at[None] = source
    left = _pruned(F.col("_fields"), tree)
    rest = F.when(F.size("_took") == 0, F.col("_rescued")).when(F.size(left) > 0, F.to_json(left))
    return rows.withColumn("_rescued", rest).select(*keys, *target, "_rescued")


def _steps(source: str) -> tuple[str | int, ...]:
    """A path's top-level name, and the members and elements it goes through."""
    name = source.split(".")[0].split("[")[0]
    rest = source[len(name) :]
    if not re.fullmatch(r"(\.[^.\[\]]+|\[\d+\])*", rest):
        raise ValueError(f"no such path: {source}")
    return (name, *[int(i) if i else member for member, i in re.findall(r"\.([^.\[\]]+)|\[(\d+)\]", rest)])


def _overlap(a: tuple[str | int, ...], b: tuple[str | int, ...]) -> bool:
    return a[: len(b)] == b[: len(a)]


def _apart(approved: Mapping, paths: Mapping, steps: Mapping) -> list[list]:
    """The approved names in their order, in parts within which no two of different columns overlap."""
    parts: list[list] = [[]]
    for source in approved:
        others = [o for o in parts[-1] if approved[o] != approved[source]]
        if any(_overlap(steps[p], steps[q]) for o in others for p in paths[o] for q in paths[source]):
            parts.append([])
        parts[-1].append(source)
    return parts


def _pruned(held: Column, tree: Mapping) -> Column:
    """A map or an array of variants without the paths of ``tree`` that ``_took`` names."""

    def one(step: Column, value: Column) -> Column:
        out = value
        for k, below in tree.items():
            if k is not None:
                out = F.when(step == k, _cleared(value, below)).otherwise(out)
        return out

    if any(isinstance(k, int) for k in tree):
        return F.filter(F.transform(held, lambda v, i: one(i, v)), lambda v: v.isNotNull())
    return F.map_filter(F.transform_values(held, one), lambda _, v: v.isNotNull())


def _cleared(value: Column, tree: Mapping) -> Column:
    """What is left of a variant without the paths of ``tree`` that ``_took`` names, or null if that is nothing."""
    out = value
    for sort, type_name, held in (("object", "map<string,variant>", str), ("array", "array<variant>", int)):
        below = {k: t for k, t in tree.items() if isinstance(k, held)}
        if below:
            left = _pruned(F.try_variant_get(value, "$", type_name), below)
            touched = F.arrays_overlap("_took", F.array(*map(F.lit, _sources(below))))
            out = F.when(touched & (kind(value) == sort), F.when(F.size(left) > 0, F.to_variant_object(left))).otherwise(out)
    return F.when(F.array_contains("_took", tree[None]), F.lit(None)).otherwise(out) if None in tree else out


def _sources(tree: Mapping) -> list[str]:
    return [s for k, t in tree.items() for s in ([t] if k is None else _sources(t))]


def aliases(found: DataFrame, approved: Mapping[str, str] = {}, target: Mapping[str, str] = TARGET) -> dict[str, str]:
    """``approved`` and each further name that renames among ``changes`` tie to one column of the target schema.

    Renames count in both directions and over several steps, but not through a column of the target schema.
    A name that is tied to two columns isn't approved. Of pairs of names there are few, whatever the number
    of files; more than MOST_RENAMES of them raise an error.
    """
    pairs = found.where("change = 'renamed'").select("field_before", "field_after").distinct().limit(MOST_RENAMES + 1).collect()
    if len(pairs) > MOST_RENAMES:
        raise ValueError(f"more than {MOST_RENAMES} pairs of renamed fields")
    near: dict[str, set[str]] = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    tied: dict[str, set[str]] = {}
    for column in sorted({*target, *approved.values()}):
        seen, ahead = {column}, [column, *[name for name, c in approved.items() if c == column]]
        while ahead:
            new = {n for n in near.get(ahead.pop(), ()) if n not in seen and n not in target and n not in approved}
            seen |= new
            ahead += new
        for name in seen - {column}:
            tied.setdefault(name, set()).add(column)
    return {**approved, **{name: min(columns) for name, columns in sorted(tied.items()) if len(columns) == 1 and not re.search(r"[.\[\]]", name)}}


def _files(records: DataFrame) -> DataFrame:
    """feed_id, file_name, before, after: each file with its neighbours in its feed, by time and name.

    Files are put in order by a range partitioning and looked at within each part; only the last file of
    each part goes to the next, so a feed that holds a third of all files isn't sorted by one task.
    """
    files = records.groupBy("feed_id", "file_name").agg(F.min("written_at").alias("_at"))
    key = ("feed_id", "_at", "file_name")
    parts = cut(files.repartitionByRange(*key).withColumn("_part", F.spark_partition_id()))
    ends = parts.groupBy("_part").agg(F.min(F.struct(*key)).alias("_low"), F.max(F.struct(*key)).alias("_high"))
    order = Window.orderBy("_part")  # one row for each part
    ends = ends.select("_part", F.lag("_high").over(order).alias("_last"), F.lead("_low").over(order).alias("_next"))
    within = Window.partitionBy("_part", "feed_id").orderBy("_at", "file_name")
    near = parts.join(ends, "_part").select(
        "feed_id",
        "file_name",
        F.coalesce(F.lag("file_name").over(within), F.when(F.col("_last.feed_id") == F.col("feed_id"), F.col("_last.file_name"))).alias("before"),
        F.coalesce(F.lead("file_name").over(within), F.when(F.col("_next.feed_id") == F.col("feed_id"), F.col("_next.file_name"))).alias("after"),
    )
    return near


def observed(ingested: DataFrame, target: Mapping[str, str] = TARGET, keys: tuple[str, ...] = ("feed_id", "file_name")) -> DataFrame:
    """keys, field, kind, text, known: each non-null field of each ingested record, with the JSON type it was written in.

    ``ingested`` comes from ``ingest`` with ``kinds``. ``known`` fields were found in their typed column,
    the others in ``_rescued``; together they are all fields of the record.
    """
    none = F.lit(None).cast("string")

    def cell(name: str, type_name: str) -> Column:
        text = F.to_json(name) if type_name.startswith("array") else F.col(name).cast("string")
        return F.struct(F.lit(name).alias("field"), F.when(F.col(name).isNotNull(), F.col("_kinds")[name]).otherwise(none).alias("kind"), text.alias("text"), F.lit(True).alias("known"))

    def saved(e: Column) -> Column:
        k = F.col("_kinds")[e["key"]]
        text = F.when(k == "string", F.try_variant_get(e["value"], "$", "string")).otherwise(F.to_json(e["value"]))
        return F.struct(e["key"].alias("field"), k.alias("kind"), text.alias("text"), F.lit(False).alias("known"))

    typed = F.array(*[cell(n, t) for n, t in target.items()])
    rest = F.transform(F.map_entries(F.from_json(F.when(F.col("_kinds").isNotNull(), F.col("_rescued")), "map<string,variant>")), saved)
    both = F.concat(typed, F.coalesce(rest, F.array().cast("array<struct<field:string,kind:string,text:string,known:boolean>>")))
    return ingested.select(*keys, F.explode(both).alias("_e")).select(*keys, "_e.*").where("kind is not null")


def _features(kind_: Column, text: Column) -> Column:
    """What tells one sort of values from another: its shape, and its words with digits made alike."""
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"\p{Lu}+", "A"), r"\p{Ll}+", "a"), r"\p{N}+", "9"), r"\s+", " ")
    names = F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit(r'"([^"]+)":'), F.lit(1)))), ",")
    shape = F.when(kind_ == "object", names).otherwise(shape)
    words = F.array_distinct(F.filter(F.split(F.lower(F.regexp_replace(text, r"\p{N}", "9")), r"[^\p{L}\p{N}]+"), lambda w: w != ""))
    return F.concat(F.array(F.concat(F.lit("s"), F.xxhash64(shape).cast("string"))), F.transform(words, lambda w: F.concat(F.lit("w"), w)))


def changes(records: DataFrame, target: Mapping[str, str] = TARGET, likeness: float = LIKENESS) -> DataFrame:
    """feed_id, file_name, change, field_before, field_after: every change of a file against the one before it in its feed.

    ``records`` has feed_id, file_name, written_at and payload; other columns aren't read. The records are
    ingested first, and the report is made of their typed columns and ``_rescued``. A file has a field
    if one of its records holds it with a non-null value, and its type is that of most of these values. The
    first file of a feed has no changes, and a payload that is no JSON object has no fields. A removed and
    an added field of one type whose values are alike in shape and words, each the best match of the other,
    are one ``renamed`` field. Repeated records weigh as often as they stand; nothing is dropped or sampled.
    """
    return changes_in(cut(ingest(records, target, ("feed_id", "file_name", "written_at"), kinds=True)), target, likeness)


def changes_in(ingested: DataFrame, target: Mapping[str, str] = TARGET, likeness: float = LIKENESS) -> DataFrame:
    """``changes`` of records that are ingested already, with ``kinds``; feed_id, file_name and written_at are among their keys."""
    near = _files(ingested)
    seen = observed(ingested, target)
    of_file = (
        ingested.select("feed_id", "file_name", F.explode("_kinds").alias("field", "kind"))
        .groupBy("feed_id", "file_name", "field", "kind")
        .count()
        .groupBy("feed_id", "file_name", "field")
        .agg(F.max_by("kind", F.struct("count", "kind")).alias("kind"))
    )
    known = cut(of_file.join(near, ["feed_id", "file_name"]))
    now = known.where("before is not null").select("feed_id", "file_name", "field", F.col("before").alias("past"), F.col("kind").alias("new"), F.lit(None).cast("string").alias("old"))
    was = known.where("after is not null").select("feed_id", F.col("after").alias("file_name"), "field", F.col("file_name").alias("past"), F.lit(None).cast("string").alias("new"), F.col("kind").alias("old"))
    both = now.unionByName(was).groupBy("feed_id", "file_name", "field").agg(F.max("past").alias("past"), F.max("new").alias("new"), F.max("old").alias("old"))
    moved = cut(both.where("not (new <=> old)"))
    retyped = moved.where("new is not null and old is not null").select("feed_id", "file_name", F.lit("retyped").alias("change"), F.col("field").alias("field_before"), F.col("field").alias("field_after"))
    added = moved.where("old is null").select("feed_id", "file_name", "past", F.col("field").alias("added"), F.col("new").alias("kind"))
    removed = moved.where("new is null").select("feed_id", "file_name", "past", F.col("field").alias("removed"), F.col("old").alias("kind"))
    renamed = _renames(seen, added, removed, likeness)
    names = ["feed_id", "file_name"]
    gone = removed.join(renamed.select(*names, "removed"), [*names, "removed"], "left_anti")
    come = added.join(renamed.select(*names, "added"), [*names, "added"], "left_anti")
    return (
        retyped.unionByName(renamed.select(*names, F.lit("renamed").alias("change"), F.col("removed").alias("field_before"), F.col("added").alias("field_after")))
        .unionByName(gone.select(*names, F.lit("removed").alias("change"), F.col("removed").alias("field_before"), F.lit("").alias("field_after")))
        .unionByName(come.select(*names, F.lit("added").alias("change"), F.lit("").alias("field_before"), F.col("added").alias("field_after")))
    )


def _renames(seen: DataFrame, added: DataFrame, removed: DataFrame, likeness: float) -> DataFrame:
    """feed_id, file_name, removed, added: the pairs whose values go on, each field in one pair at most."""
    names = ["feed_id", "file_name"]
    both = added.select(*names, "kind").intersect(removed.select(*names, "kind"))
    new = added.join(both, [*names, "kind"], "left_semi").select("feed_id", F.col("file_name").alias("at"), "file_name", F.col("added").alias("field"), F.lit("new").alias("side"))
    old = removed.join(both, [*names, "kind"], "left_semi").select("feed_id", F.col("file_name").alias("at"), F.col("past").alias("file_name"), F.col("removed").alias("field"), F.lit("old").alias("side"))
    wanted = new.unionByName(old)
    counts = (
        seen.join(wanted, ["feed_id", "file_name", "field"])
        .select("feed_id", "at", "side", "field", "kind", F.explode(_features(F.col("kind"), F.col("text"))).alias("feature"))
        .groupBy("feed_id", "at", "side", "field", "kind", "feature")
        .count()
        .withColumn("sort", F.substring("feature", 1, 1))
    )
    whole = counts.groupBy("feed_id", "at", "side", "field", "kind", "sort").agg(F.sum("count").alias("all"))
    share = cut(counts.join(whole, ["feed_id", "at", "side", "field", "kind", "sort"]).withColumn("p", F.col("count") / F.col("all")))
    key = ["feed_id", "at", "kind", "feature"]
    a = share.where("side = 'old'").select(*key, F.col("field").alias("removed"), F.col("p").alias("p"))
    b = share.where("side = 'new'").select(*key, F.col("field").alias("added"), F.col("p").alias("q"))
    both = F.least("p", "q")
    words = F.sum(F.when(F.col("feature").startswith("w"), both).otherwise(0.0))
    # Long texts hardly share a shape, short codes hardly a word; either is enough.
    score = a.join(b, key).groupBy("feed_id", F.col("at").alias("file_name"), "removed", "added").agg(F.greatest(F.sum(both) / 2, words).alias("score"))
    score = score.where(F.col("score") >= likeness)
    first = score.groupBy(*names, "removed").agg(F.max_by("added", F.struct("score", "added")).alias("added"))
    back = score.groupBy(*names, "added").agg(F.max_by("removed", F.struct("score", "removed")).alias("removed"))
    return first.join(back, [*names, "removed", "added"])


def forms(ingested: DataFrame, names: Mapping[str, str], target: Mapping[str, str] = TARGET, likeness: float = LIKENESS) -> dict[str, list[tuple[str, ...]]]:
    """For each column the paths into rescued objects and arrays whose values are like those it holds, the likest first.

    ``names`` are other names of columns; a rescued value under one of these or the column's own name is
    looked at. A path is a member (``(".code",)``), the first element (``("[0]",)``), or two members that make
    one text (``(".label", ".no")``); likeness is that of ``changes``, over all values. Columns and the members
    of their objects are few; more than MOST_RENAMES paths raise an error.
    """
    spark = ingested.sparkSession
    column_of = {**{n: n for n in target}, **names}
    known = spark.createDataFrame(sorted(column_of.items()), "field string, column string")
    held = observed(ingested, target, ()).join(F.broadcast(known), "field")  # one row for each known name
    rescued = held.where("not known and kind in ('object', 'array')").withColumn("_v", F.try_parse_json("text"))
    scalar = lambda v: F.when(kind(v).isin("string", "number"), F.try_variant_get(v, "$", "string"))
    members = F.filter(F.transform(F.map_entries(F.try_variant_get("_v", "$", "map<string,variant>")), lambda e: F.struct(e["key"].alias("m"), scalar(e["value"]).alias("t"))), lambda e: e["t"].isNotNull() & ~e["m"].rlike(r"[.\[\]]"))
    one = F.transform(members, lambda e: F.struct(F.array(F.concat(F.lit("."), e["m"])).alias("path"), e["t"].alias("t")))
    two = F.flatten(F.transform(members, lambda e: F.transform(F.filter(members, lambda o: o["m"] != e["m"]), lambda o: F.struct(F.array(F.concat(F.lit("."), e["m"]), F.concat(F.lit("."), o["m"])).alias("path"), F.concat_ws(" ", e["t"], o["t"]).alias("t")))))
    first = F.filter(F.array(F.struct(F.array(F.lit("[0]")).alias("path"), scalar(F.try_variant_get("_v", "$[0]", "variant")).alias("t"))), lambda e: e["t"].isNotNull())
    none = F.array().cast("array<struct<path:array<string>,t:string>>")
    ways = F.when(F.col("kind") == "object", F.concat(F.coalesce(one, none), F.coalesce(two, none))).otherwise(first)
    tried = rescued.select("column", F.explode(ways).alias("_w")).select("column", F.col("_w.path").alias("path"), F.col("_w.t").alias("text"))
    asked = cut(_shares(tried, ["column", "path"]))
    typed = held.where("known and kind in ('string', 'number')").join(F.broadcast(asked.select("column").distinct()), "column", "left_semi")
    own = _shares(typed.select("column", "text"), ["column"]).select("column", "feature", F.col("p").alias("q"))
    like = F.least("p", "q")
    score = asked.join(own, ["column", "feature"]).groupBy("column", "path").agg(F.greatest(F.sum(like) / 2, F.sum(F.when(F.col("feature").startswith("w"), like).otherwise(0.0))).alias("score"), F.sum(like).alias("all"))
    rows = score.where(F.col("score") >= likeness).limit(MOST_RENAMES + 1).collect()
    if len(rows) > MOST_RENAMES:
        raise ValueError(f"more than {MOST_RENAMES} paths")
    out: dict[str, list[tuple[str, ...]]] = {}
    for r in sorted(rows, key=lambda r: (r.column, -round(r.score, 6), -round(r.all, 6), r.path)):  # equal words in another order differ in shape
        out.setdefault(r.column, []).append(tuple(r.path))
    return out


def _shares(texts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, feature, p: the features of all texts of a key, with their share among its shapes or its words."""
    counts = texts.select(*keys, F.explode(_features(F.lit("string"), F.col("text"))).alias("feature")).groupBy(*keys, "feature").count().withColumn("_sort", F.substring("feature", 1, 1))
    whole = counts.groupBy(*keys, "_sort").agg(F.sum("count").alias("_all"))
    return counts.join(whole, [*keys, "_sort"]).select(*keys, "feature", (F.col("count") / F.col("_all")).alias("p"))


def paths(names: Mapping[str, str], of: Mapping[str, list[tuple[str, ...]]]) -> dict[str | tuple[str, ...], str]:
    """The approved names, and the paths of all forms of each of them and of the columns themselves, as ``promote`` takes them."""
    out: dict[str | tuple[str, ...], str] = dict(names)
    for name, column in {**{c: c for c in of}, **names}.items():
        for form in of.get(column, ()):
            way = tuple(name + path for path in form)
            out[way if len(way) > 1 else way[0]] = column
    return out


def consistent(records: DataFrame, target: Mapping[str, str] = TARGET, keys: tuple[str, ...] = ("raw_id",), names: Mapping[str, str] | None = None, of: Mapping[str, list[tuple[str, ...]]] | None = None) -> DataFrame:
    """keys, the columns of ``target`` and ``_rescued`` of all records: ingested, then replayed under what was approved.

    ``names`` (other names of columns) and ``of`` (paths, as ``forms`` gives them) are taken as given; where
    they are None, they come from the records: names that the renames between files tie to one column, and
    paths whose values are like the column's. ``records`` has feed_id, file_name and written_at, as for
    ``changes``. Each payload is parsed once.
    """
    rows = cut(ingest(records, target, tuple(dict.fromkeys((*keys, "feed_id", "file_name", "written_at"))), kinds=True))
    names = aliases(changes_in(rows, target), {}, target) if names is None else names
    of = forms(rows, names, target) if of is None else of
    return promote(rows, paths(names, of), target, keys)
