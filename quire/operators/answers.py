"""Answers against the shape their item type asks for: what can be repaired in place, and what needs a look."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as X
from quire.operators.quality import CLOSED, OPTIONS
from quire.operators.relations import answer_option

OPEN_ENDED = ["writing-task", "speaking-task", "open-ended"]
# What true-false answers start with (English, German, French).
TRUE_FALSE = {"en": ["true", "false", "not mentioned"], "de": ["richtig", "falsch", "nicht genannt", "nicht im text"], "fr": ["vrai", "faux", "pas mentionne", "pas mentionné", "non mentionne", "non mentionné"]}


def _quoted(term: str) -> str:
    return "".join(c if c.isalnum() or c == " " else "\\" + c for c in term)


def starts_with(text: Column, terms: Sequence[str]) -> Column:
    """The first listed term that the text starts with as a whole word, in any case; null if none."""
    out = F.lit(None).cast("string")
    for t in reversed(terms):
        out = F.when(text.rlike(rf"(?iu)^\s*{_quoted(t)}(?![\p{{L}}\p{{N}}_])"), F.lit(t)).otherwise(out)
    return out


def raised(answer: Column, term: Column) -> Column:
    """The answer with the term it starts with capitalised; all else, white space too, stays as it is.

    An answer that is nothing but the term loses the white space around it.
    """
    bare = X.strip(answer)
    lead = F.regexp_extract(answer, r"^(\s*)", 1)
    rest = F.substring(answer, F.length(lead) + F.length(term) + 1, F.length(answer))
    head = F.substring(answer, F.length(lead) + 1, F.length(term))
    small = F.substring(head, 1, 1) != F.upper(F.substring(head, 1, 1))
    return F.when(F.lower(bare) == term, X.capitalised(bare)).when(small, F.concat(lead, X.capitalised(head), rest)).otherwise(answer)


def answer_parts(answer: Column) -> Column:
    """The parts of an answer that names several options."""
    parts = F.split(answer, r"\s+(?:et|and|und|y)\s+|[;,]")
    return F.filter(F.transform(parts, lambda p: F.regexp_replace(p, r"^[ .;,]+|[ .;,]+$", "")), lambda p: p != "")


def among(answer: Column, options: Column) -> Column:
    """Whether an answer is one of the options, contains one or is contained in one, or is made of several."""
    parts = answer_parts(answer)
    near = lambda x: F.exists(options, lambda o: x.contains(o) | o.contains(x))
    return near(answer) | ((F.size(parts) > 1) & F.forall(parts, near))


def check(items: DataFrame, language: Column, true_false: Mapping[str, Sequence[str]] = TRUE_FALSE) -> DataFrame:
    """``items`` with ``fixed``, the answer after repair, and ``issue``, what needs a look; null where there is none.

    True-false answers get their capital, letters become the text of their option. Blank answers are left
    alone. ``language`` chooses the words that true-false answers start with, English if it has none.
    """
    answer = F.coalesce("correct_answer", F.lit(""))
    bare = X.strip(answer)
    options = F.filter(F.array(*[F.coalesce(F.col(c), F.lit("")) for c in OPTIONS]), lambda o: o != "")
    kind = F.coalesce("item_type", F.lit(""))
    term = starts_with(bare, true_false.get("en", ()))
    for lang, terms in true_false.items():
        term = F.when(language == lang, starts_with(bare, terms)).otherwise(term)
    letter = X.bare_letter(bare)
    option = F.nullif(answer_option(bare, {c[-1]: c for c in OPTIONS}), F.lit(""))
    due = bare != ""
    fixed = (
        F.when(due & (kind == "true-false") & term.isNotNull(), raised(answer, term))
        .when(due & (kind == "multiple-choice") & letter & option.isNotNull(), option)
        .otherwise(F.col("correct_answer"))
    )
    issue = (
        F.when(~kind.isin(*CLOSED["item_type"]), "unknown item type")
        .when(due & (kind == "true-false") & term.isNull(), "starts with no expected term")
        .when(due & (kind == "multiple-choice") & letter & option.isNull(), "names a missing option")
        .when(due & (kind == "multiple-choice") & ~letter & (bare != "(open-ended)") & (F.size(options) > 0) & ~among(bare, options), "not among its options")
        .when(due & kind.isin(*OPEN_ENDED) & (bare != "(open-ended)") & F.lower(bare).contains("open-ended") & ~bare.startswith("(open-ended:"), "open-ended in another format")
    )
    return items.withColumns({"fixed": fixed, "issue": issue})


def key_status(items: DataFrame, books: DataFrame) -> DataFrame:
    """Books whose share of blank answers contradicts what they say of their answer key."""
    asked = items.where(~F.coalesce("item_type", F.lit("")).isin(*OPEN_ENDED))
    rate = asked.groupBy("collection").agg((100.0 * F.avg(F.when(X.filled(F.col("correct_answer")), 0.0).otherwise(1.0))).alias("pct_blank"))
    told = rate.join(books.select(F.col("slug").alias("collection"), "answer_key_status"), "collection")
    finding = F.when((F.col("answer_key_status") == "printed") & (F.col("pct_blank") > 20), "printed, but many blanks").when(F.col("answer_key_status").isin("separate-guide", "none") & (F.col("pct_blank") < 5), "hardly any blanks")
    return told.withColumn("finding", finding).where("finding is not null")


def level_gaps(items: DataFrame, books: DataFrame) -> DataFrame:
    """Of books whose levels are inferred: how many items have no level or one that isn't an option, on how many pages, and the first page."""
    b = books.where("level_mode = 'inferred'").select(F.col("slug").alias("collection"), "level_options")
    rows = items.select("collection", X.strip(F.coalesce("level", F.lit(""))).alias("level"), "source_page").join(b, "collection")
    wrong = (F.size(F.coalesce("level_options", F.array().cast("array<string>"))) > 0) & ~F.array_contains("level_options", F.col("level"))
    state = F.when(F.col("level") == "", "missing").when(wrong, "invalid")
    pages = rows.withColumn("state", state).where("state is not null").groupBy("collection", "state", "source_page").agg(F.count(F.lit(1)).alias("n"))
    return pages.groupBy("collection", "state").agg(F.sum("n").alias("items"), F.count("source_page").alias("pages"), F.min("source_page").alias("first_page"))


def without_accepted(flags: DataFrame, accepted: DataFrame, book: str = "collection", text: str = "flag") -> DataFrame:
    """Flags whose key, the text before the first colon, wasn't accepted for their book. ``accepted``: book, keys."""
    known = accepted.select(F.col(book).alias("_book"), F.explode("keys").alias("_key")).distinct()
    own = flags.withColumn("_own", F.trim(F.substring_index(F.col(text), ":", 1)))
    return own.join(known, (own[book] == known["_book"]) & (own["_own"] == known["_key"]), "left_anti").drop("_own")
