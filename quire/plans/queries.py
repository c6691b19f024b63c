"""Named queries of the core over the test tables, each with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.functions import urls as U
from quire.operators import answers, drift, explore, html, merge, quality, relations, rollup, sheets
from quire.session import table
from quire.streaming import state

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


# Fixed value: white space in SQL patterns, no-break spaces included.
_S = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"


def _flat(c: str) -> str:
    return rf"coalesce(trim(regexp_replace({c}, '{_S}+', ' ', 'g')), '')"


def _filled(c: str) -> str:
    return rf"coalesce(regexp_matches({c}, '[^\s\x0b\x1c-\x1f\x85\p{{Z}}]'), false)"


def _strip(c: str) -> str:
    return rf"regexp_replace({c}, '^{_S}+|{_S}+$', '', 'g')"


# --- sheets -------------------------------------------------------------------------------------


@query("select " + ", ".join(f"{_flat(c)} as {c}" for c in quality.CANONICAL["questions"] if c != "level") + f", {_flat('coalesce(q.level, c.level)')} as level from questions q left join (select slug, level from collections) c on c.slug = q.collection".replace("select collection", "select q.collection"))
def question_sheet(spark: SparkSession, folder: str) -> DataFrame:
    return sheets.questions(table(spark, folder, "questions"), table(spark, folder, "collections"))


@query("select " + ", ".join(_flat(r"coalesce(nullif(gender, ''), regexp_extract(word, '\((m|f|mf|m/f|m pl|f pl)\)\s*$', 1))") + " as gender" if c == "gender" else f"{_flat(c)} as {c}" for c in quality.CANONICAL["vocabulary"]) + " from vocabulary")
def vocabulary_sheet(spark: SparkSession, folder: str) -> DataFrame:
    return sheets.vocabulary(table(spark, folder, "vocabulary"))


@query("""
select c.slug as collection, c.family, c.lang, coalesce(p.n, 0) as pages, coalesce(q.n, 0) as questions, coalesce(v.n, 0) as words
from collections c
left join (select collection, count(*) as n from catalog_pages group by 1) p on p.collection = c.slug
left join (select collection, count(*) as n from questions group by 1) q on q.collection = c.slug
left join (select collection, count(*) as n from vocabulary group by 1) v on v.collection = c.slug
where greatest(coalesce(p.n, 0), coalesce(q.n, 0), coalesce(v.n, 0)) > 0""")
def book_counts(spark: SparkSession, folder: str) -> DataFrame:
    parts = [table(spark, folder, t) for t in ("collections", "catalog_pages", "questions", "vocabulary")]
    return sheets.live(sheets.book_counts(*parts))


@query(r"""
select slug, coalesce(nullif(title, ''), coalesce(level, '') || ' -  - ' || array_to_string(list_transform(
  regexp_extract_all(replace(regexp_replace(regexp_extract(coalesce(nullif(pdf, ''), slug), '([^/]*)$', 1), '(.)\.[^.]*$', '\1'), '-', ' '), '\p{L}+|[^\p{L}]+'),
  lambda p: upper(p[1]) || lower(p[2:])), '')) as title
from collections""")
def display_titles(spark: SparkSession, folder: str) -> DataFrame:
    books = table(spark, folder, "collections")
    return books.select("slug", sheets.display_title(books).alias("title"))


@query("select collection, count(*) as pages from catalog_pages where collection not in (select slug from collections where frozen) group by 1")
def writable_pages(spark: SparkSession, folder: str) -> DataFrame:
    rows = sheets.writable(table(spark, folder, "catalog_pages"), table(spark, folder, "collections"))
    return rows.groupBy("collection").agg(F.count(F.lit(1)).alias("pages"))


# --- counts and roll-ups ------------------------------------------------------------------------


@query("select collection, case when section is null or section = '' then '(none)' else section end as value, count(*) as n from catalog_pages group by 1, 2")
def section_counts(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.value_counts(table(spark, folder, "catalog_pages"), "section", ["collection"])


@query(r"select t as value, count(*) as n from (select unnest(regexp_extract_all(content_type, '[\p{L}\p{N}\p{M}_-]+')) as t from catalog_pages) group by 1")
def content_type_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.count_table(rollup.token_counts(table(spark, folder, "catalog_pages"), "content_type"))


_SPARSE = ["translation", "gender", "plural", "example", "article"]


@query("select * from (" + " union all ".join(f"""
select collection, '{c}' as "column", count(*) as n, count(*) filter (where {_filled(c)}) as filled, round(100.0 * count(*) filter (where {_filled(c)}) / count(*), 6) as pct,
  case when count(*) filter (where {_filled(c)}) = 0 then 'empty throughout' else 'rarely filled' end as finding
from vocabulary group by 1""" for c in _SPARSE) + ") where pct < 10")
def sparse_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    found = rollup.sparse_columns(table(spark, folder, "vocabulary"), _SPARSE, 10.0, ["collection"])
    return found.withColumn("pct", F.round("pct", 6))


@query("select * from (" + " union all ".join(f"""
select collection, '{c}' as "column", count(*) as n, count(*) filter (where {_filled(c)}) as filled, round(100.0 * count(*) filter (where {_filled(c)}) / count(*), 6) as pct, cast({f} as double) as floor
from questions where collection in (select slug from collections) group by 1""" for c, f in (("instruction", 75.0), ("correct_answer", 97.0))) + ") where pct + 0.5 < floor")
def coverage_floors(spark: SparkSession, folder: str) -> DataFrame:
    books = table(spark, folder, "collections").select(F.col("slug").alias("collection"))
    floors = books.select("collection", F.explode(F.create_map(F.lit("instruction"), F.lit(75.0), F.lit("correct_answer"), F.lit(97.0))).alias("column", "floor"))
    return rollup.coverage(table(spark, folder, "questions"), floors, ["instruction", "correct_answer"]).withColumn("pct", F.round("pct", 6))


_ANY_OPTION = "(" + " or ".join(_filled(c) for c in quality.OPTIONS) + ")"


@query(f"select item_type, count(*) as n, round(avg(case when {_filled('question')} then 1.0 else 0.0 end), 6) as question, round(avg(case when {_ANY_OPTION} then 1.0 else 0.0 end), 6) as options, round(avg(case when {_filled('correct_answer')} then 1.0 else 0.0 end), 6) as answer from questions group by 1")
def item_type_fill(spark: SparkSession, folder: str) -> DataFrame:
    any_option = F.greatest(*[X.filled(F.col(c)) for c in quality.OPTIONS])
    rates = rollup.type_fill(table(spark, folder, "questions"), "item_type", {"question": X.filled(F.col("question")), "options": any_option, "answer": X.filled(F.col("correct_answer"))})
    return rates.withColumns({c: F.round(c, 6) for c in ("question", "options", "answer")})


@query("""
select family, collection, (2 - grouping(family) - grouping(collection))::int as tier, count(*) as n, count(distinct source_page) as pages
from questions join collections on slug = collection group by rollup (family, collection)""")
def question_tiers(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "questions").join(table(spark, folder, "collections").select(F.col("slug").alias("collection"), "family"), "collection")
    return rollup.tiers(rows, ["family", "collection"], {"n": F.count(F.lit(1)), "pages": F.count_distinct("source_page")})


@query("""
select r_name, n_name, (2 - grouping(r_name) - grouping(n_name))::int as tier, count(*) as customers, round(sum(c_acctbal), 2) as balance
from customer join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey group by rollup (r_name, n_name)""")
def customer_tiers(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "customer").join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rollup.tiers(rows, ["r_name", "n_name"], {"customers": F.count(F.lit(1)), "balance": F.round(F.sum("c_acctbal"), 2)})


@query("""
with c as (select case when topic is null or topic = '' then '(none)' else topic end as value, count(*) as n from vocabulary group by 1),
r as (select *, row_number() over (order by n desc, value) as k, sum(n) over () as total from c)
select value, n, round(n / total, 6) as share from r where k <= 5
union all select 'Other', sum(n)::bigint, round(sum(n) / min(total), 6) from r where k > 5 having count(*) > 0""")
def top_topics(spark: SparkSession, folder: str) -> DataFrame:
    top = rollup.top_with_rest(rollup.value_counts(table(spark, folder, "vocabulary"), "topic"), 5)
    return top.withColumn("share", F.round("share", 6))


@query("""
with c as (select collection, item_type, count(*) as n from questions group by 1, 2)
select collection, item_type, n, round(n / sum(n) over (partition by collection), 6) as share,
  round(coalesce(sum(n) over (partition by collection order by item_type rows between unbounded preceding and 1 preceding), 0) / sum(n) over (partition by collection), 6) as start
from c""")
def item_type_shares(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "questions").groupBy("collection", "item_type").agg(F.count(F.lit(1)).alias("n"))
    return rollup.running_share(parts, ["collection"], ["item_type"], "n").withColumns({"share": F.round("share", 6), "start": F.round("start", 6)})


@query("""
with c as (select collection, count(*) as units, count(*) filter (where status in ('transcribed', 'verified')) as transcribed, count(*) filter (where status = 'verified') as verified from catalog_pages group by 1)
select *, round_even(100.0 * transcribed / units, 0)::int as pct_transcribed, round_even(100.0 * verified / units, 0)::int as pct_verified from c""")
def manifest_totals(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.manifest_totals(table(spark, folder, "catalog_pages"), ["collection"])


@query("""
select collection, count(*) as pages, count(*) filter (where status = 'verified') as verified, count(*) filter (where status in ('transcribed', 'verified')) as transcribed,
  count(*) filter (where qa = 'pass') as qa_pass, count(*) filter (where qa = 'fail') as qa_fail from catalog_pages group by 1""")
def page_stats(spark: SparkSession, folder: str) -> DataFrame:
    return rollup.page_stats(table(spark, folder, "catalog_pages"), ["collection"])


# --- merging ------------------------------------------------------------------------------------


@query("""
select collection, unit, catalog_id from catalog_pages
qualify row_number() over (partition by collection, unit order by loaded_at desc, catalog_id desc) = 1""")
def last_page_wins(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "catalog_pages").select("collection", "unit", "loaded_at", "catalog_id")
    return merge.last_write_wins(rows, ["collection", "unit"], ["loaded_at", "catalog_id"]).select("collection", "unit", "catalog_id")


@query(f"""
select vocab_id, collection, word from vocabulary where {_filled('word')}
qualify row_number() over (partition by collection, lower({_strip('word')}), coalesce(article, ''), coalesce(source_page, '') order by chunk, vocab_id) = 1""")
def first_entry_kept(spark: SparkSession, folder: str) -> DataFrame:
    return merge.vocabulary_entries(table(spark, folder, "vocabulary"), ["chunk", "vocab_id"]).select("vocab_id", "collection", "word")


@query("""
select collection, coalesce(source_page, '') as source_page, coalesce(part, '') as part, coalesce(item, '') as item, count(distinct extracted_at) as origins
from questions group by 1, 2, 3, 4 having count(distinct extracted_at) > 1""")
def chunk_collisions(spark: SparkSession, folder: str) -> DataFrame:
    """Items that come from several extractions; none of the tables comes from several chunks."""
    return merge.collisions(table(spark, folder, "questions"), ["collection", "source_page", "part", "item"], "extracted_at")


@query("select collection, cast(sum(n - 1) as bigint) as overwrites from (select collection, unit, count(*) as n from catalog_pages group by 1, 2) group by 1")
def page_overwrites(spark: SparkSession, folder: str) -> DataFrame:
    return merge.overwrites(table(spark, folder, "catalog_pages"), ["collection"], "unit")


@query(r"""
with l as (select doc_id, unnest(string_split(text, chr(10))) as text, generate_subscripts(string_split(text, chr(10)), 1) as ord from documents),
r as (select *, row_number() over (partition by doc_id, text order by ord) as k from l where """ + _filled('text') + r""")
select doc_id, count(*) filter (where k = 1) as kept, count(*) filter (where k > 1) as removed from r group by 1""")
def block_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("ord", "text")).where(X.filled(F.col("text"))).withColumn("type", F.lit("paragraph"))
    marked = merge.repeated_blocks(lines, "doc_id")
    return marked.groupBy("doc_id").agg(F.count_if(~F.col("repeat")).alias("kept"), F.count_if("repeat").alias("removed"))


# --- joins --------------------------------------------------------------------------------------


def _page_key(c: str) -> str:
    return rf"regexp_replace(regexp_replace({_strip(c)}, 'page-', '', 'g'), '^0+', '')"


@query(f"""
select question_id, collection, source_page from questions q
where coalesce({_page_key('source_page')}, '') <> ''
  and not exists (select 1 from catalog_pages p where p.collection = q.collection and {_page_key('p.unit')} = {_page_key('q.source_page')})""")
def dangling_pages(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "questions").select("question_id", "collection", "source_page")
    return relations.dangling(rows, table(spark, folder, "catalog_pages"), "collection", "source_page", "unit")


@query(f"""
with p as (select collection, {_page_key('unit')} as k, max(coalesce(topic, '')) as page_topic, max(coalesce(section, '')) as page_section from catalog_pages group by 1, 2)
select q.question_id, coalesce(p.page_topic, '') as page_topic, coalesce(p.page_section, '') as page_section
from questions q left join p on p.collection = q.collection and p.k = {_page_key('q.source_page')}""")
def left_outer_enrich(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "catalog_pages").groupBy("collection", X.page_key(F.col("unit")).alias("k")).agg(F.max(F.coalesce("topic", F.lit(""))).alias("page_topic"), F.max(F.coalesce("section", F.lit(""))).alias("page_section"))
    rows = table(spark, folder, "questions").select("question_id", "collection", X.page_key(F.col("source_page")).alias("k"))
    return relations.enrich(rows, pages, ["collection", "k"], {"page_topic": "", "page_section": ""}).select("question_id", "page_topic", "page_section")


@query("""
with e as (select collection, unnest(range(1, n + 1)) as k from (select collection, max(regexp_extract(unit, '(\\d+)$', 1)::int) as n from catalog_pages group by 1)),
x as (select collection, 'page-' || lpad(k::varchar, 3, '0') as unit from e),
p as (select collection, unit, count(*) filter (where qa is not null and qa <> '') as told, bool_and(qa = 'pass') filter (where qa is not null and qa <> '') as ok from catalog_pages group by 1, 2)
select x.collection, x.unit, case when p.unit is null then 'missing_md' when told = 0 then 'missing_qa' when not ok then 'qa_fail' else 'ok' end as state
from x left join p on p.collection = x.collection and p.unit = x.unit""".replace("\\\\", "\\"))
def completeness_cascade(spark: SparkSession, folder: str) -> DataFrame:
    from quire.sources.files import expected_units

    pages = table(spark, folder, "catalog_pages")
    sizes = pages.groupBy("collection").agg(F.max(F.regexp_extract("unit", r"(\d+)$", 1).cast("int")).alias("pages"))
    told = pages.where(F.coalesce("qa", F.lit("")) != "").select("collection", "unit", (F.col("qa") == "pass").alias("ok"))
    return relations.cascade(expected_units(sizes), pages, told, ["collection", "unit"])


@query("""
with f as (select catalog_id, collection, unit from catalog_pages where qa = 'fail'),
a as (select distinct collection, unit from catalog_pages where status = 'verified')
select f.catalog_id, case when a.unit is null then 'new' else 'accepted' end as side from f left join a on a.collection = f.collection and a.unit = f.unit""")
def accepted_split(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "catalog_pages")
    failures = pages.where("qa = 'fail'").select("catalog_id", "collection", "unit")
    new, accepted = relations.accepted_split(failures, pages.where("status = 'verified'"), ["collection", "unit"])
    return new.select("catalog_id", F.lit("new").alias("side")).unionByName(accepted.select("catalog_id", F.lit("accepted").alias("side")))


@query(r"""
with c as (select question_id, unnest(['instruction', 'question', 'option_a', 'correct_answer', 'level', 'topic']) as field,
  unnest([instruction, question, option_a, correct_answer, level, topic]) as old from questions)
select field, count(*) filter (where old is distinct from """ + _flat("old") + r""") as changed, count(*) filter (where old is not null) as present from c group by 1""")
def backfill_fidelity(spark: SparkSession, folder: str) -> DataFrame:
    names = ["instruction", "question", "option_a", "correct_answer", "level", "topic"]
    rows = table(spark, folder, "questions")
    record = lambda f: F.create_map(*[x for c in names for x in (F.lit(c), f(F.col(c)))]).alias("record")
    compared = relations.zip_compare(rows.select("question_id", record(lambda c: c)), rows.select("question_id", record(X.flat)), ["question_id"])
    changed = compared.select(F.explode("changed").alias("field")).groupBy("field").agg(F.count(F.lit(1)).alias("changed"))
    present = rollup.unpivot(rows, [], names).groupBy(F.col("column").alias("field")).agg(F.count("value").alias("present"))
    return relations.enrich(present, changed, ["field"], {"changed": 0}).select("field", "changed", "present")


@query("""
with b as (select source || '/' || unit as path, max(text) as content from documents where unit is not null and text is not null group by 1),
c as (select source || '/' || unit as path, min(case when doc_form = 'transcript' then upper(text) else text end) as content from documents where unit is not null and text is not null and doc_form <> 'web' group by 1)
select coalesce(b.path, c.path) as path, case when c.content is null then 'NEW' when b.content is null then 'GONE'
  when regexp_replace(b.content, '(?m)^(> Generated )\\d{4}-\\d{2}-\\d{2}\\.', '\\1<date>.', 'g') = regexp_replace(c.content, '(?m)^(> Generated )\\d{4}-\\d{2}-\\d{2}\\.', '\\1<date>.', 'g') then 'same' else 'STALE' end as state
from b full outer join c on b.path = c.path""")
def build_staleness(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").where("unit is not null and text is not null").withColumn("path", F.concat("source", F.lit("/"), "unit"))
    built = docs.groupBy("path").agg(F.max("text").alias("content"))
    kept = docs.where("doc_form <> 'web'").groupBy("path").agg(F.min(F.when(F.col("doc_form") == "transcript", F.upper("text")).otherwise(F.col("text"))).alias("content"))
    return relations.compare_builds(built, kept)


@query("select o_orderkey, o_custkey from orders o where not exists (select 1 from lineitem where l_orderkey = o.o_orderkey and l_returnflag = 'R')")
def orders_without_returns(spark: SparkSession, folder: str) -> DataFrame:
    returned = table(spark, folder, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, folder, "orders").join(returned, "o_orderkey", "left_anti").select("o_orderkey", "o_custkey")


# --- quality ------------------------------------------------------------------------------------


def _hygiene_sql(name: str, key: str) -> str:
    cols = [c for c in quality.CANONICAL[name] if c in quality.TEXT_COLUMNS]
    source = {"catalog": "catalog_pages"}.get(name, name)
    parts = [f"select '{name}' as sheet, '{rule}' as rule, '{c}' as \"column\", count(*) as n, min({key}) as first_line from {source} where regexp_matches({c}, '{p}')" for c in cols for rule, p in quality.HYGIENE.items()]
    return " union all ".join(parts)


@query("select * from (" + " union all ".join(_hygiene_sql(n, k) for n, k in (("catalog", "catalog_id"), ("questions", "question_id"), ("vocabulary", "vocab_id"))) + ") where n > 0")
def cell_hygiene(spark: SparkSession, folder: str) -> DataFrame:
    out = []
    for name, source, key in (("catalog", "catalog_pages", "catalog_id"), ("questions", "questions", "question_id"), ("vocabulary", "vocabulary", "vocab_id")):
        rules = quality.hygiene_rules(quality.CANONICAL[name])
        found = quality.violations(table(spark, folder, source), rules, F.col(key))
        out.append(found.select(F.lit(name).alias("sheet"), "rule", "column", "n", "first_line"))
    return rollup.union_all(out)


def _listed(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


_TAXONOMY = [c for c in ("section", "item_type", "level", "topic") if c]


@query("with v as (" + " union all ".join([
    *[f"select question_id as line, '{c}' as \"column\", {_strip(c)} as value from questions" for c in _TAXONOMY],
]) + ") select \"column\", value, count(*) as n, min(line) as first_line, case when regexp_matches(value, '[^\\x00-\\x7f]') then 'non-ascii' else 'not in the closed vocabulary' end as finding from v where coalesce(value, '') <> '' and (regexp_matches(value, '[^\\x00-\\x7f]') or "
    + " or ".join(f"(\"column\" = '{c}' and value not in ({_listed(quality.CLOSED[c])}))" for c in _TAXONOMY if c in quality.CLOSED) + ") group by 1, 2")
def question_taxonomy(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "questions").select("question_id", *_TAXONOMY)
    return quality.taxonomy(rows, F.col("question_id"))


@query("""
with p as (select catalog_id, content_type || ', ' || regexp_replace(lower(summary), '[^a-z0-9]+', '-', 'g') as content_type from catalog_pages),
v as (select catalog_id as line, unnest(list_filter(list_transform(string_split(regexp_replace(content_type, '^[\\[\\]]+|[\\[\\]]+$', '', 'g'), ','), lambda x: trim(x)), lambda x: x <> '')) as value from p)
select 'content_type' as "column", value, count(*) as n, min(line) as first_line, case when regexp_matches(value, '[^\\x00-\\x7f]') then 'non-ascii' when regexp_matches(value, '^[a-z0-9]+(-[a-z0-9]+){3,}$') then 'slugified prose' else 'drift' end as finding
from v where regexp_matches(value, '[^\\x00-\\x7f]') or value not in (""" + _listed(quality.OPEN["content_type"]) + ") group by 1, 2")
def content_type_drift(spark: SparkSession, folder: str) -> DataFrame:
    """Tags to which each page's summary was added as one more, made into a slug."""
    slug = F.regexp_replace(F.lower("summary"), "[^a-z0-9]+", "-")
    pages = table(spark, folder, "catalog_pages").select("catalog_id", F.concat("content_type", F.lit(", "), slug).alias("content_type"))
    return quality.taxonomy(pages, F.col("catalog_id"))


@query(f"select question_id, collection from questions where item_type = 'multiple-choice' and (not {_ANY_OPTION} or level is null)")
def choice_without_options(spark: SparkSession, folder: str) -> DataFrame:
    """Items that lost their options where they have no level."""
    items = table(spark, folder, "questions")
    items = items.withColumns({c: F.when(F.col("level").isNotNull(), F.col(c)) for c in quality.OPTIONS})
    return quality.choice_without_options(items).select("question_id", "collection")


@query("""
select slug, case when trim(coalesce(answer_key_status, '')) = '' then 'answer_key.status' when answer_key_status not in ('printed', 'separate-guide', 'partial', 'none') then 'answer_key.status=' || answer_key_status end as answer_key,
  case when caveats is null then 'caveats' end as caveats
from collections where caveats is null or trim(coalesce(answer_key_status, '')) = '' or answer_key_status not in ('printed', 'separate-guide', 'partial', 'none')""")
def metadata_gaps(spark: SparkSession, folder: str) -> DataFrame:
    gaps = quality.metadata_gaps(table(spark, folder, "collections"))
    of = lambda test: F.get(F.filter("missing", test), F.lit(0))
    return gaps.select("slug", of(lambda m: m.startswith("answer_key")).alias("answer_key"), of(lambda m: m == "caveats").alias("caveats"))


@query(f"""
with r as (select collection, 100.0 * avg(case when {_filled('correct_answer')} then 0.0 else 1.0 end) as pct_blank from questions where coalesce(item_type, '') not in ('writing-task', 'speaking-task', 'open-ended') group by 1)
select r.collection, round(pct_blank, 6) as pct_blank, answer_key_status, case when answer_key_status = 'printed' then 'printed, but many blanks' else 'hardly any blanks' end as finding
from r join collections on slug = r.collection where (answer_key_status = 'printed' and pct_blank > 20) or (answer_key_status in ('separate-guide', 'none') and pct_blank < 5)""")
def answer_key_status(spark: SparkSession, folder: str) -> DataFrame:
    found = answers.key_status(table(spark, folder, "questions"), table(spark, folder, "collections"))
    return found.withColumn("pct_blank", F.round("pct_blank", 6))


@query("""
with r as (select q.collection, """ + _strip("coalesce(q.level, '')") + """ as lv, source_page, level_options from questions q join collections c on c.slug = q.collection and c.level_mode = 'inferred'),
s as (select collection, case when lv = '' then 'missing' when len(coalesce(level_options, [])) > 0 and not list_contains(level_options, lv) then 'invalid' end as state, source_page from r)
select collection, state, count(*) as items, count(distinct source_page) as pages, min(source_page) as first_page from s where state is not null group by 1, 2""")
def level_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return answers.level_gaps(table(spark, folder, "questions"), table(spark, folder, "collections"))


def _near(x: str) -> str:
    return f"len(list_filter(options, lambda o: contains({x}, o) or contains(o, {x}))) > 0"


def _repair_sql() -> str:
    first = lambda lang: "case " + " ".join(f"when regexp_matches(bare, '(?i)^\\s*{t}($|[^\\p{{L}}\\p{{N}}_])') then '{t}'" for t in answers.TRUE_FALSE[lang]) + " end"
    free = _listed(answers.OPEN_ENDED)
    return f"""
with q as (select question_id, correct_answer, coalesce(correct_answer, '') as a, {_strip("coalesce(correct_answer, '')")} as bare, coalesce(item_type, '') as kind, lang,
    list_filter([coalesce(option_a, ''), coalesce(option_b, ''), coalesce(option_c, ''), coalesce(option_d, ''), coalesce(option_e, '')], lambda o: o <> '') as options, option_a, option_b, option_c, option_d, option_e
  from questions left join collections on slug = collection),
t as (select *, case lang when 'de' then {first('de')} when 'fr' then {first('fr')} else {first('en')} end as term, regexp_matches(bare, '^[a-dA-D]\\.?$') as letter,
    nullif(case lower(left(bare, 1)) when 'a' then option_a when 'b' then option_b when 'c' then option_c when 'd' then option_d end, '') as named, regexp_extract(a, '^(\\s*)', 1) as lead,
    list_filter(list_transform(regexp_split_to_array(bare, '\\s+(?:et|and|und|y)\\s+|[;,]'), lambda p: regexp_replace(p, '^[ .;,]+|[ .;,]+$', '', 'g')), lambda p: p <> '') as parts from q),
h as (select *, substr(a, len(lead) + 1, len(term)) as head, substr(a, len(lead) + len(term) + 1) as rest from t),
r as (select question_id, correct_answer,
    case when bare <> '' and kind = 'true-false' and term is not null then
        case when lower(bare) = term then upper(bare[1]) || lower(bare[2:]) when head[1] <> upper(head[1]) then lead || upper(head[1]) || lower(head[2:]) || rest else a end
      when bare <> '' and kind = 'multiple-choice' and letter and named is not null then named else correct_answer end as fixed,
    case when kind not in ({_listed(quality.CLOSED['item_type'])}) then 'unknown item type'
      when bare <> '' and kind = 'true-false' and term is null then 'starts with no expected term'
      when bare <> '' and kind = 'multiple-choice' and letter and named is null then 'names a missing option'
      when bare <> '' and kind = 'multiple-choice' and not letter and bare <> '(open-ended)' and len(options) > 0
        and not ({_near('bare')} or (len(parts) > 1 and len(list_filter(parts, lambda p: not ({_near('p')}))) = 0)) then 'not among its options'
      when bare <> '' and kind in ({free}) and bare <> '(open-ended)' and contains(lower(bare), 'open-ended') and not starts_with(bare, '(open-ended:') then 'open-ended in another format' end as issue
  from h)
select question_id, fixed, issue from r where fixed is distinct from correct_answer or issue is not null"""


@query(_repair_sql())
def answer_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Answers that are repaired or need a look."""
    items = table(spark, folder, "questions").join(table(spark, folder, "collections").select(F.col("slug").alias("collection"), "lang"), "collection", "left")
    checked = answers.check(items, F.col("lang"))
    return checked.where(~F.col("fixed").eqNullSafe(F.col("correct_answer")) | F.col("issue").isNotNull()).select("question_id", "fixed", "issue")


# --- explorer -----------------------------------------------------------------------------------


@query("""
with c as (select unnest(['section', 'item_type', 'topic']) as "column", unnest([section, item_type, topic]) as value from questions)
select distinct "column", value from c where coalesce(value, '') <> ''""")
def option_lists(spark: SparkSession, folder: str) -> DataFrame:
    return explore.options(table(spark, folder, "questions"), ["section", "item_type", "topic"])


@query(f"""
with f as (select * from questions where (contains(lower(question), 'bahnhof') or contains(lower(correct_answer), 'bahnhof')) and lower(item_type) = 'short-answer')
select count(*) as rows, count(distinct collection) as books, floor(100.0 * count(*) filter (where {_filled('correct_answer')}) / count(*) + 0.5)::bigint as pct_answered, count(distinct coalesce(topic, '')) as categories from f""")
def kpi_filtered(spark: SparkSession, folder: str) -> DataFrame:
    kept = explore.equal_filters(explore.search(table(spark, folder, "questions"), "Bahnhof", ["question", "correct_answer"]), {"item_type": "Short-Answer"})
    return rollup.kpis(kept, "collection", X.filled(F.col("correct_answer")), "topic")


@query("select question_id, collection, question from questions where lower(section) = 'reading' and contains(lower(question), 'ist') order by collection desc, question_id limit 50 offset 50")
def explore_page(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "questions").select("question_id", "collection", "section", "question")
    found = explore.equal_filters(explore.search(rows, "ist", ["question"]), {"section": "reading"})
    return explore.page(found, [F.desc("collection"), "question_id"], number=1).select("question_id", "collection", "question")


# --- pages, counters, order ----------------------------------------------------------------------


_ONE_LINE = _strip(r"regexp_replace(coalesce({0}, ''), '[\r\n]+', ' ', 'g')").replace("{Z}", "{{Z}}")


@query(rf"""
with k as (select collection, regexp_extract(unit, '(\d+)$', 1)::int as no, max(coalesce(activity_type, '')) as activity_type, max(coalesce(topic, '')) as topic, max(coalesce(summary, '')) as summary
  from catalog_pages where regexp_matches(unit, '\d$') group by 1, 2)
select p.collection, p.unit, regexp_replace({_ONE_LINE.format('p.section')}, '^"+|"+$', '', 'g') as section, regexp_replace({_ONE_LINE.format('p.chapter')}, '^"+|"+$', '', 'g') as chapter,
  {_ONE_LINE.format('p.content_type')} as content_type, coalesce(k.activity_type, '') as activity_type, coalesce(k.topic, '') as topic, coalesce(p.level, c.level, '') as level, coalesce(p.status, '') as status, coalesce(p.qa, '') as qa,
  (3 + coalesce(len(regexp_extract_all(p.summary, '[^\s\x0b\p{{Z}}]+')), 0))::int as word_count, coalesce(k.summary, '') as summary, 'Kapitel ' || p.catalog_id as title
from catalog_pages p left join collections c on c.slug = p.collection left join k on k.collection = p.collection and k.no = try_cast(regexp_extract(p.unit, '(\d+)$', 1) as int)""")
def page_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """The catalog built from whole pages: frontmatter and body are written out of the sheet and read again."""
    rows = table(spark, folder, "catalog_pages")
    line = lambda name, c: F.concat(F.lit(f"{name}: "), F.regexp_replace(F.coalesce(c, F.lit("")), r"[\r\n]+", " "), F.lit("\n"))
    level = F.when(F.col("level").isNotNull(), line("level", F.col("level"))).otherwise("")
    front = F.concat(F.lit("---\n"), *[line(c, F.col(c)) for c in ("section", "chapter", "content_type", "status", "qa")], level, F.lit("---\n\n"))
    pages = rows.select("collection", "unit", F.concat(front, F.lit("# **Kapitel** "), F.col("catalog_id").cast("string"), F.lit("\n\n"), F.coalesce("summary", F.lit(""))).alias("page"))
    named = rows.where(F.col("unit").rlike(r"\d$")).groupBy("collection", F.regexp_extract("unit", r"(\d+)$", 1).cast("int").alias("page"))
    classes = named.agg(*[F.max(F.coalesce(c, F.lit(""))).alias(c) for c in ("activity_type", "topic", "summary")])
    return sheets.catalog(pages, classes, table(spark, folder, "collections"))


@query(f"""
select coalesce(p.collection, q.collection) as collection, coalesce(classified, 0) as classified, coalesce(answered, 0) as answered
from (select collection, count(*) filter (where {_filled('activity_type')}) as classified from catalog_pages group by 1) p
full outer join (select collection, count(*) filter (where {_strip("coalesce(correct_answer, '')")} not in ('', '(open-ended)')) as answered from questions group by 1) q on p.collection = q.collection""")
def build_counters(spark: SparkSession, folder: str) -> DataFrame:
    return sheets.build_counters(table(spark, folder, "catalog_pages"), table(spark, folder, "questions"))


@query("select question_id, (row_number() over (partition by collection order by coalesce(source_page, ''), coalesce(item, ''), question_id) - 1)::int as place from questions")
def question_order(spark: SparkSession, folder: str) -> DataFrame:
    return sheets.in_order(table(spark, folder, "questions"), "question_id").select("question_id", F.col("place").cast("int").alias("place"))


@query("""
select family, count(*) as books from collections
where slug in (select collection from catalog_pages union select collection from questions union select collection from vocabulary) group by 1 having count(*) >= 2""")
def combined_families(spark: SparkSession, folder: str) -> DataFrame:
    parts = [table(spark, folder, t) for t in ("collections", "catalog_pages", "questions", "vocabulary")]
    return sheets.combined_families(sheets.book_counts(*parts))


@query("select slug, case when frozen then -1 else len(coalesce(level_options, [])) end::int as items from collections")
def item_counts(spark: SparkSession, folder: str) -> DataFrame:
    """A merged file for each book, that of a frozen one cut off."""
    books = table(spark, folder, "collections")
    name = F.when(F.col("lang") == "de", "items").otherwise("entries")
    merged = F.concat(F.lit('{"'), name, F.lit('": '), F.to_json(F.coalesce("level_options", F.array().cast("array<string>"))), F.when(F.col("frozen"), "").otherwise("}"))
    return books.select("slug", sheets.item_count(merged).cast("int").alias("items"))


@query("select slug, upper(left(replace(f, '_', ' '), 1)) || lower(substr(replace(f, '_', ' '), 2)) as label from collections, (values ('level_mode'), ('answer_key_status')) v(f) union all select slug, 'QA' from collections")
def column_labels(spark: SparkSession, folder: str) -> DataFrame:
    names = F.explode(F.array(*map(F.lit, ("level_mode", "answer_key_status", "qa")))).alias("name")
    return table(spark, folder, "collections").select("slug", names).select("slug", X.humanised(F.col("name")).alias("label"))


# --- web pages ------------------------------------------------------------------------------------


@query("""
with p as (select slug, '/' || lower(coalesce(level, '')) || '/' || slug as path from collections)
select slug, path = '/a1' or starts_with(path, '/a1/') as crawl,
  case when starts_with(path, '/b1') then true when starts_with(path, '/b') then false else true end as robots from p""")
def url_filter(spark: SparkSession, folder: str) -> DataFrame:
    path = F.concat(F.lit("/"), F.lower(F.coalesce("level", F.lit(""))), F.lit("/"), "slug")
    return table(spark, folder, "collections").select("slug", U.may_crawl(path, ["/a1", "/b1"], ["/b1"]).alias("crawl"), U.robots_allows(path, [("/b", False), ("/b1", True), ("", False)]).alias("robots"))


_HREFS = ["#top", "mailto:desk@books.example", "../files/audio.mp3", "/about", "https://other.example/x", "page-2"]


@query("""
select slug, 'https://books.example/' || family || '/' || slug || '.html' as page, h.href,
  case h.href when '#top' then 'https://books.example/' || family || '/' || slug || '.html#top' when 'mailto:desk@books.example' then h.href when '../files/audio.mp3' then 'https://books.example/files/audio.mp3'
    when '/about' then 'https://books.example/about' when 'page-2' then 'https://books.example/' || family || '/page-2' else h.href end as absolute,
  case h.href when '#top' then 'anchor' when 'mailto:desk@books.example' then 'mailto' when '../files/audio.mp3' then 'download' when 'https://other.example/x' then 'external' else 'internal' end as kind
from collections, (values """ + ", ".join(f"('{h}')" for h in _HREFS) + ") h(href)")
def page_links(spark: SparkSession, folder: str) -> DataFrame:
    books = table(spark, folder, "collections").select("slug", F.concat(F.lit("https://books.example/"), "family", F.lit("/"), "slug", F.lit(".html")).alias("page"), F.explode(F.array(*map(F.lit, _HREFS))).alias("href"))
    links = books.withColumn("absolute", U.resolve(F.col("href"), F.col("page")))
    return links.withColumn("kind", U.link_kind(F.col("href"), F.col("absolute"), F.col("page")))


@query("select 'internal' as kind, 2 * count(*) as n from collections union all " + " union all ".join(f"select '{k}', count(*) from collections" for k in ("anchor", "mailto", "download", "external")))
def link_kind_counts(spark: SparkSession, folder: str) -> DataFrame:
    return page_links(spark, folder).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("""
select slug, case lang when 'de' then 'German' when 'fr' then 'French' else 'unknown' end as exam, case when regexp_matches(lower(level), '^[abc][12]$') then upper(level) else 'unknown' end as level, 'Reading' as section from collections""")
def url_classes(spark: SparkSession, folder: str) -> DataFrame:
    path = F.concat(F.lit("/"), "lang", F.lit("/"), F.lower("level"), F.lit("/reading/"), "slug")
    got = U.classify(path, {"de": "German", "fr": "French"}, {"reading": "Reading", "writing": "Writing"})
    return table(spark, folder, "collections").select("slug", got.alias("_c")).select("slug", "_c.exam", "_c.level", "_c.section")


@query(f"""
select question_id as page_id, 1 as headings, case when {_filled('question')} then 1 else 0 end as paragraphs, case when {_ANY_OPTION} then 1 else 0 end as lists from questions""")
def node_counts_pivot(spark: SparkSession, folder: str) -> DataFrame:
    """Items as web pages: how many blocks of each type a page has."""
    safe = lambda c: F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    items = F.array_join(F.transform(F.array(*quality.OPTIONS), lambda o: F.concat(F.lit("<li>"), safe(o), F.lit("</li>"))), "")
    page = F.concat(F.lit("<nav><p>menu</p></nav><main><h2>Item</h2><p>"), safe(F.col("question")), F.lit("</p><ul>"), items, F.lit("</ul></main>"))
    pages = table(spark, folder, "questions").select(F.col("question_id").alias("page_id"), page.alias("html"))
    of = lambda t: F.count_if(F.col("type") == t).cast("int")
    return html.nodes(pages).groupBy("page_id").agg(of("heading").alias("headings"), of("paragraph").alias("paragraphs"), of("list").alias("lists"))


# --- texts, addresses, states -------------------------------------------------------------------

_CJK = r"[\x{3040}-\x{30ff}\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{f900}-\x{faff}\x{ac00}-\x{d7af}]"


@query(rf"""
select doc_id, cast(coalesce(len(regexp_extract_all(text, '{_CJK}')) + len(regexp_extract_all(regexp_replace(text, '{_CJK}', ' ', 'g'), '[^\s\x0b\p{{Z}}]+')), 0) as int) as words,
  coalesce(len(text), 0)::int as signs, coalesce(n_chars <> len(text), false) as wrong_length
from documents""")
def word_stats(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    size = F.char_length("text")
    return docs.select("doc_id", X.word_count(F.col("text")).alias("words"), F.coalesce(size, F.lit(0)).alias("signs"), F.coalesce(F.col("n_chars") != size, F.lit(False)).alias("wrong_length"))


@query()
def document_titles(spark: SparkSession, folder: str) -> DataFrame:
    """The first line of each document that says something: a fold over lines, tested in tests/test_text.py."""
    return table(spark, folder, "documents").select("doc_id", X.page_title(F.col("text")).alias("title"))


@query()
def document_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as web pages, parsed into blocks, cleaned and put together again."""
    text = F.replace(F.replace(F.replace(F.coalesce("text", F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit("\n\n"), F.lit("<p>"))
    pages = table(spark, folder, "documents").select(F.col("doc_id").alias("page_id"), F.concat(F.lit("<body><nav>chrome</nav><main><h1>"), F.coalesce("unit", F.lit("page")), F.lit("</h1><p>"), text, F.lit("</main>")).alias("html"))
    return html.documents(html.clean(html.nodes(pages)))


@query(r"""
select slug as book, '/' || family || '/' || lower(level) || '/' || slug || '/' as path,
  regexp_replace(replace(regexp_replace(regexp_replace(lower(family || '/' || level || '/' || slug), '[^a-z0-9/]+', '-', 'g'), '-+', '-', 'g'), '/', '--'), '^-+|-+$', '', 'g') as slug,
  lower(level) = 'a1' as allowed from collections""")
def book_addresses(spark: SparkSession, folder: str) -> DataFrame:
    books = table(spark, folder, "collections")
    path = F.concat(F.lit("/"), "family", F.lit("/"), F.lower("level"), F.lit("/"), "slug", F.lit("/"))
    # Each book's path begins with its own family, so no list of families is needed.
    allowed = F.coalesce(F.startswith(F.lower(path), F.lower(F.concat(F.lit("/"), "family", F.lit("/a1/")))), F.lit(False))
    return books.select(F.col("slug").alias("book"), path.alias("path"), U.slug(path).alias("slug"), allowed.alias("allowed"))


@query("""
select user_id, event_type, value, event_id from events
qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""")
def state_upsert(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select("user_id", "event_type", "value", "event_id", "ts")
    first = merge.keep_first(rows, ["user_id"], ["ts", "event_id"])
    return state.upsert(first, rows, ["user_id"], ["ts", "event_id"]).drop("ts")


@query("select event_type, count(*) as n, sum(cast(json_extract_string(props, '$.k') as bigint))::bigint as total from events group by 1")
def json_props(spark: SparkSession, folder: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("bigint")
    return table(spark, folder, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(k).alias("total"))


@query("select doc_id, substr(sha256(text), 1, 16) as hash, text = '' or text is null as nothing from documents")
def document_hashes(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", X.short_hash(F.col("text")).alias("hash"), (F.coalesce("text", F.lit("")) == "").alias("nothing"))


# --- schema drift -------------------------------------------------------------------------------


@query()
def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return drift.changes(table(spark, folder, "raw_records"))


@query()
def p6_table(spark: SparkSession, folder: str) -> DataFrame:
    """All records in one consistent table: renames found and forms of values replayed, the rest kept as JSON."""
    return drift.consistent(table(spark, folder, "raw_records"), keys=("raw_id", "feed_id", "sheet", "collection", "file_name"))


#: A fixed map of names for the comparison with SQL.
RENAMED = {"niveau": "level", "stufe": "level", "partie": "part", "teil": "part", "kapitel": "chapter", "chapitre": "chapter", "theme": "topic"}


def _typed_sql() -> str:
    """The rules of the target schema in SQL: what fits its column, and the names of what doesn't."""
    of = lambda name: f"(payload::json -> '$.\"{name}\"')"
    fit = {
        "string": lambda n: f"case when json_type({of(n)}) in ('VARCHAR', 'UBIGINT', 'BIGINT', 'DOUBLE') then {of(n)} ->> '$' end",
        "bigint": lambda n: f"case when json_type({of(n)}) in ('VARCHAR', 'UBIGINT', 'BIGINT', 'DOUBLE') and try_cast({of(n)} ->> '$' as double) = floor(try_cast({of(n)} ->> '$' as double)) then cast(try_cast({of(n)} ->> '$' as double) as bigint) end",
        "double": lambda n: f"case when json_type({of(n)}) in ('VARCHAR', 'UBIGINT', 'BIGINT', 'DOUBLE') then try_cast({of(n)} ->> '$' as double) end",
        "boolean": lambda n: f"case when json_type({of(n)}) = 'BOOLEAN' then cast({of(n)} ->> '$' as boolean) end",
        "array<string>": lambda n: f"case when json_type({of(n)}) = 'ARRAY' then array_to_string(cast({of(n)} as varchar[]), '|') end",
    }
    own = ", ".join(f"{fit[t](n)} as {n}" for n, t in drift.TARGET.items())
    other = ", ".join(f"{fit[drift.TARGET[c]](n)} as \"_{n}\"" for n, c in RENAMED.items())
    full = {c: "coalesce(" + ", ".join([c, *[f'"_{n}"' for n, o in RENAMED.items() if o == c]]) + ")" for c in dict.fromkeys(RENAMED.values())}
    columns = ", ".join(f"{full.get(c, c)} as {c}" for c in drift.TARGET)
    # Fields that found their column, and other names whose value was the first to fill one.
    took = [f"case when {c} is not null then '{c}' end" for c in drift.TARGET]
    for c in full:
        names = [n for n, o in RENAMED.items() if o == c]
        took.append(f"case when {c} is null then case " + " ".join(f"when \"_{n}\" is not null then '{n}'" for n in names) + " end end")
    return f"""
with typed as (select raw_id, payload, {own}, {other} from raw_records),
names as (select *, list_filter(json_keys(payload::json), lambda k: json_type(payload::json -> ('$."' || k || '"')) <> 'NULL' and not list_contains([{", ".join(took)}], k)) as rest from typed)
select raw_id, {columns}, array_to_string(list_sort(list_distinct(rest)), ',') as rescued from names"""


@query(_typed_sql())
def p6_typed(spark: SparkSession, folder: str) -> DataFrame:
    """Records ingested and replayed under a fixed map of names, and the names of the fields that stay rescued."""
    got = drift.promote(drift.ingest(table(spark, folder, "raw_records")), RENAMED)
    left = F.array_join(F.array_sort(F.map_keys(F.from_json("_rescued", "map<string,string>"))), ",")
    return got.select("raw_id", *[F.array_join(c, "|").alias(c) if t.startswith("array") else c for c, t in drift.TARGET.items()], F.coalesce(left, F.lit("")).alias("rescued"))


FLAGSHIP: Query = book_counts
