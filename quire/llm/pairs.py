"""Problem 2: items whose answer does not serve their question, with the kind of defect.

For each defect several noisy labelling functions vote for, against or not at all. How far each vote can
be trusted is learned without labels, from one belief about all of them: expectation maximisation over the
counts of all patterns of a defect's votes. The functions of one defect don't look at the others, so an item
keeps every defect whose posterior exceeds the cutoff; where one is asked for, the order of DEFECTS decides.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.fold import loose
from quire.llm import endings, lookalike
from quire.session import cut

#: From the defect that excludes the others most surely on: an empty answer is in no language, a refusal may be in any.
DEFECTS = ("empty", "copy", "refusal", "language", "truncated")
#: The labelling functions of each defect.
FUNCTIONS = {d: [f"{d}_{k + 1}" for k in range(n)] for d, n in zip(DEFECTS, (4, 3, 4, 2, 5))}
#: Posterior from which a defect is kept; tests/llm/test_pairs.py validates it on seeded defects of two sets of templates.
CUTOFFS = dict.fromkeys(DEFECTS, 0.5)
#: What is believed before any vote is seen, the same of every function: the share of items with its defect, and
#: how often it votes for the defect, where it votes at all, in items with the defect and in others.
SHARE, HIT, FALSE = 0.02, 0.6, 0.01
#: These beliefs weigh as much as this share of the items, one item at least. Rounds end when no posterior moves by GAIN.
WEIGHT, ROUNDS, GAIN = 3e-4, 100, 1e-5
#: An answer at home in so many types of items that need different ones doesn't depend on its question.
SPREAD = 4
#: The same for a sentence: one at home in so many types is no answer to any question.
SENTENCE_SPREAD, SENTENCE_LEAST = 5, 14
#: An answer is at home in a type that has at least this part of what it would have if types played no part.
AT_HOME = 0.2
#: A word is known in a language from so many texts on, and from this share of them.
KNOWN, KNOWN_SHARE = 5, 3e-5

# Item types that need no answer, and the mark that stands in for one there.
FREE = ["writing-task", "speaking-task", "open-ended"]
# Placeholders, letters and digits only (English, German, French, Spanish).
PLACEHOLDERS = [
    "na", "none", "null", "nil", "nan", "undefined", "todo", "tbd", "tba", "missing", "unknown", "empty", "blank", "noanswer", "openended", "placeholder", "xx", "xxx", "xxxx",
    "ka", "keineangabe", "keineantwort", "fehlt", "leer", "unbekannt", "offen", "nochoffen", "sansreponse", "aucunereponse", "pasdereponse", "nr", "neant", "vide", "acompleter", "manquant", "sinrespuesta", "pendiente",
]
# Frequent short words that tell languages apart.
FUNCTION_WORDS = {
    "de": "der die das den dem des ein eine einen einem einer ist sind war hat haben wird nicht kein keine und oder aber weil dass denn wenn obwohl damit mit von zu zum zur nach bei auf im am um für ich du er wir ihr kann man sehr dort dahin hinter neben vor seit kurz gegen es mir mich dir dich sich ihn ihm",
    "fr": "le la les l un une des du de et ou mais est sont était c été dans pour avec sans sur sous chez par ne pas que qui quand parce car même si je j tu il elle on nous vous ils y ce cette ça au aux à a sa son ses avant après depuis pendant vers en y d qu j m t s n leur même très",
    "en": "the a an is are was were has have had not and or but because that when although so to of in on at for with from by it he she we you they can could will would her his this these there before after during around since every",
    "es": "el la los las un una unos y o pero porque aunque cuando es son está están fue ha no de del al a en con sin por para que se su sus le lo muy después antes desde hasta mucho",
    "it": "il lo la i gli le un una e o ma perché quando è sono era ha non di del della al alla a in con senza per che si suo sua molto dopo prima da dal",
}

_ASKS_TRANSLATION = (
    r"(?i)übersetz|traduc|tradui|translat|auf (?:englisch|deutsch|französisch|spanisch|italienisch)|ins (?:englische|deutsche|französische|spanische|italienische)"
    r"|en (?:anglais|allemand|français|espagnol|italien)|(?:in|into|to) (?:english|german|french|spanish|italian)"
    r"|comment dit-on|wie (?:heißt|sagt man) das (?:auf|in)|wie sagt man|how do you say|schreib(?:e|t)? den satz auf|écris (?:la|cette) phrase en|cómo se dice"
)
_LEAD_IN = r"^[\s\p{P}\p{S}]*(?:\p{L}{1,12}\s*(?::|=>|->|→|=)\s*)?[\s\p{P}\p{S}]*"
_SELF = r"(?i)\b(?:(?:as|i am|i'm) an? (?:ai|language|large)\b|ai (?:model|assistant|language)|language model|ki[- ](?:modell|assistent|sprachmodell)|sprachmodell|als ki\b|modèle de langue|modèle linguistique|assistant (?:ia|virtuel)|intelligence artificielle|en tant qu[e'’]? ?(?:ia|modèle|assistant)|modelo de lenguaje|como (?:ia|modelo))"
_CANNOT = (
    r"(?i)\b(?:i (?:can ?not|can'?t|could not|couldn'?t|won'?t|will not|must decline|have to decline|am (?:unable|not able|not allowed)|do not have|don'?t have|do not know|don'?t know|refuse)|i'?m (?:unable|not able|not allowed|afraid i)|(?:unable|not able|not possible|impossible) (?:for me )?to|could not be|cannot be|can'?t be|beyond my)"
    r"|\bich (?:kann|darf|bin nicht|möchte|will|werde|weiß)[^.!?]*\b(?:nicht|keine?n?)\b|\b(?:kann|darf|möchte) ich[^.!?]*\b(?:nicht|keine?n?)\b|\bnicht (?:in der lage|möglich|zu bestimmen|zu lösen|beantwort|lösbar)|lässt sich[^.!?]*\bnicht\b|\bmir fehlt|\bfehlt mir"
    r"|je ne (?:peux|suis|sais|puis)[^.!?]*\bpas\b|je n'ai pas|(?:il )?m'est impossible|je (?:dois|préfère) (?:refuser|décliner)|ne peut (?:pas )?être|je refuse|impossible de|je n'ai (?:aucun|ni)|ne me permet"
    r"|no (?:puedo|me es posible|tengo acceso|es posible)|lo siento, (?:pero )?no"
)
_TASK = (
    r"(?i)\b(?:question|request|prompt|item|exercise|task|answer(?: key)?|option is correct|page provided|full page|source text|picture this|the (?:audio|picture|image))\b|\bthis (?:item|question|exercise|task|request)"
    r"|\b(?:aufgabe|frage|lösung(?:sschlüssel)?|antwort|hörtext|vorliegenden? seite|ganze seite|das bild|item|übung|anfrage)\b"
    r"|\b(?:cette (?:question|tâche)|cet (?:exercice|item)|exercice|corrigé|bonne réponse|la (?:réponse|solution)|l'image|page complète|tâche|demande)\b|\b(?:pregunta|ejercicio|tarea|respuesta|solución)\b"
)
_REQUEST = r"(?i)(?:could you|please|can you) (?:share|supply|provide|send|upload|give)|können sie[^.!?]*\b(?:schicken|senden|geben)|bitte (?:den|die|das)[^.!?]*\b(?:angeben|schicken|senden)|(?:pouvez|pourriez)-vous|merci de (?:fournir|envoyer|préciser)|por favor (?:envíe|comparta)"


def _of(value: Column, f) -> Column:
    """``f`` of a value that it uses several times: the value's expression stands in the plan, and runs, only once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def language_votes(text: Column) -> Column:
    """An array: for each language, in the order of FUNCTION_WORDS, the number of the text's words that are function words of it."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: w != "")
    return _of(words, lambda ws: F.array(*[_count(ws, listed) for listed in FUNCTION_WORDS.values()]))


def _count(words: Column, listed: str) -> Column:
    names = list(dict.fromkeys(listed.split()))
    return F.size(F.filter(words, lambda w: w.isin(*names)))


def language(text: Column, least: int = 2) -> Column:
    """The language with the most function words, null if there are fewer than ``least`` or two lead."""
    names = F.array(*map(F.lit, FUNCTION_WORDS))

    def leading(votes: Column) -> Column:
        best = F.array_max(votes)
        return F.when((best >= least) & (F.size(F.filter(votes, lambda v: v == best)) == 1), F.get(names, (F.array_position(votes, best) - 1).cast("int")))

    return _of(language_votes(text), leading)


def _prepared(items: DataFrame) -> DataFrame:
    """question_id, book, type, question, answer, options, instruction, asked and book language, in one consistent form."""
    plain = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("option_a", "option_b", "option_c", "option_d", "option_e")]
    held = items.select("question_id", F.col("collection").alias("book"), F.coalesce("item_type", F.lit("")).alias("type"), "question", "correct_answer", F.coalesce("instruction", F.lit("")).alias("instruction"), *plain)
    both = held.select(F.col("question").alias("text")).unionByName(held.select(F.col("correct_answer").alias("text")))
    fixed = lookalike.cleaner(both)
    ask = lambda c: F.when(lookalike.suspect(F.col(c)), F.col(c))
    held = held.withColumn("_q", ask("question")).withColumn("_a", ask("correct_answer"))
    held = held.withColumn("question", F.coalesce(fixed("_q"), "question", F.lit(""))).withColumn("answer", F.coalesce(fixed("_a"), "correct_answer", F.lit(""))).drop("_q", "_a", "correct_answer")
    return held.withColumn("options", F.filter(F.array(*[F.col(c) for c in ("option_a", "option_b", "option_c", "option_d", "option_e")]), lambda o: F.trim(o) != "")).drop("option_a", "option_b", "option_c", "option_d", "option_e")


def _book_languages(items: DataFrame) -> DataFrame:
    """book, spoken: the language that most questions of a book are in."""
    votes = items.select(F.col("collection").alias("book"), language(F.col("question"), 1).alias("l")).where("l is not null").groupBy("book", "l").count()
    return votes.groupBy("book").agg(F.max_by("l", F.struct("count", "l")).alias("spoken"))


def _known_words(items: DataFrame) -> DataFrame:
    """spoken, answer, known: the share of an answer's words in lower case that questions and options of its language have.

    Names and other capitalised words say nothing and aren't counted, nor is a last word that may be cut;
    answers with fewer than three words aren't judged. Answers that by their function words are in the
    language add to what it has.
    """
    words = lambda c: F.array_distinct(F.regexp_extract_all(c, F.lit(r"(?<![\p{L}])\p{Ll}{2,}"), F.lit(0)))
    own = F.when(F.col("said") == F.col("spoken"), F.array("answer")).otherwise(F.array().cast("array<string>"))
    texts = items.select("spoken", F.explode(F.concat(F.array("question"), "options", own)).alias("t")).groupBy("spoken", "t").count()
    vocabulary = texts.select("spoken", F.explode(words(F.col("t"))).alias("word"), "count").groupBy("spoken", "word").agg(F.sum("count").alias("n"))
    size = items.groupBy("spoken").agg(F.count(F.lit(1)).alias("items"))
    vocabulary = vocabulary.join(size, "spoken").where(F.col("n") >= F.greatest(F.lit(KNOWN), F.col("items") * KNOWN_SHARE)).select("spoken", "word", F.lit(1).alias("is"))
    answers = items.where(F.length("answer") > 6).select("spoken", "answer").distinct().withColumn("ws", words(F.when(endings.marked(F.col("answer")), F.col("answer")).otherwise(F.regexp_replace("answer", r"\S+\s*$", "")))).where(F.size("ws") >= 3)
    return answers.select("spoken", "answer", F.explode("ws").alias("word")).join(vocabulary, ["spoken", "word"], "left").groupBy("spoken", "answer").agg(F.avg(F.coalesce("is", F.lit(0))).alias("known"))


def _spread(rows: DataFrame, name: str, shares: DataFrame, least: int) -> DataFrame:
    """name, types: in how many types of items each value is at home; values too rare to have met so many are left out.

    Measured against the share that a type has of all items, so it doesn't grow with their number.
    """
    counts = rows.groupBy(name, "type").agg(F.count(F.lit(1)).alias("n"))
    by = counts.groupBy(name).agg(F.sum("n").alias("all"), F.collect_list(F.struct("type", "n")).alias("by")).where((F.size("by") >= least) | (F.col("all") >= 2 * least))  # one element for each type
    at_home = F.filter("by", lambda x: x["n"] >= AT_HOME * F.col("all") * F.col("shares")[x["type"]])
    return by.join(F.broadcast(shares)).select(name, F.size(at_home).alias("types"))


def _sentences(answer: Column) -> Column:
    """The sentences of an answer, letters and digits only; short ones say nothing."""
    parts = F.transform(F.split(answer, r"[.!?\[\]()]+"), lambda p: loose(p))
    return F.array_distinct(F.filter(parts, lambda p: F.length(p) >= SENTENCE_LEAST))


def votes(items: DataFrame) -> DataFrame:
    """question_id and a column for each labelling function: 1 for its defect, -1 against, 0 for no vote.

    The names are those of the defects with a number, as in ``copy_1``.
    """
    books = _book_languages(items)
    items = cut(_read(_prepared(items).join(books, "book", "left")))
    due = items.where(~F.col("free") & (F.col("key") != ""))
    of_type = due.groupBy("type").agg(F.count(F.lit(1)).alias("n"))
    every = of_type.agg(F.sum("n").alias("all"), F.collect_list(F.struct("type", "n")).alias("by"))
    shares = every.select(F.map_from_entries(F.transform("by", lambda x: F.struct(x["type"], x["n"] / F.col("all")))).alias("shares"))  # one row
    wide = _spread(due, "key", shares, SPREAD).where(F.col("types") >= SPREAD).withColumnRenamed("types", "spread")
    said = due.select("answer", "type", F.explode(_sentences(F.col("answer"))).alias("sentence"))
    # An answer all of whose sentences are rare isn't judged.
    common = _spread(said, "sentence", shares, SENTENCE_SPREAD).select("sentence", (F.col("types") >= SENTENCE_SPREAD).alias("is"))
    shared = said.select("answer", "sentence").distinct().join(common, "sentence").groupBy("answer").agg(F.bool_or("is").alias("shared"))
    known = _known_words(items)
    kinds = F.concat_ws("|", "type", F.coalesce("said", "spoken", F.lit("")))
    answers = items.where(F.char_length("answer") > 3).select(kinds.alias("kind"), F.col("answer").alias("text")).groupBy("kind", "text").agg(F.count(F.lit(1)).alias("n"))
    early = endings.judge(answers.withColumn("whole", F.col("n"))).where("early").select(F.col("kind").alias("_kind"), F.col("text").alias("_text"), F.lit(True).alias("early"))
    rows = items.drop("question", "options").withColumn("_kind", kinds).withColumn("_text", F.col("answer")).join(early, ["_kind", "_text"], "left").join(wide, "key", "left").join(known, ["spoken", "answer"], "left").join(shared, "answer", "left")
    return _vote(rows)


def _cast(c: Column, asked_of: Column) -> Column:
    """A vote: for where the first holds, against where only the second does, else none."""
    yes = lambda x: F.coalesce(x, F.lit(False))
    return F.when(~yes(asked_of), 0).when(yes(c), 1).otherwise(-1)


def _read(rows: DataFrame) -> DataFrame:
    """What an item says by itself: the votes of all functions that need no other item, and what the others ask of it.

    In steps, each of columns of the step before, so that no expression is repeated, and before the joins: there
    these patterns and folds made nine tenths of a plan that the driver optimises and describes anew after each stage.
    """
    a, q, key, asked = F.col("answer"), F.col("question"), F.col("key"), F.col("asked")
    free, kind, option_keys = F.col("free"), F.col("type"), F.col("option_keys")
    # What is left of an answer without quotation marks and a lead-in.
    bare = loose(F.regexp_replace(a, _LEAD_IN, ""))
    word = lambda c: F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    gaps = F.split(q, r"_{2,}")
    rows = rows.withColumns({
        "key": loose(a), "asked": loose(q), "bare": bare, "free": kind.isin(*FREE), "said": language(a), "option_keys": F.transform("options", lambda o: loose(o)),
        "given": word(q), "put": word(a), "gaps": F.size(gaps), "before": loose(F.element_at(gaps, 1)), "after": loose(F.element_at(gaps, -1)),
        "letter": a.rlike(r"^\W*[a-eA-E]\W*$"),
        "translation": q.rlike(_ASKS_TRANSLATION) | F.col("instruction").rlike(_ASKS_TRANSLATION),
    })
    before, after = F.col("before"), F.col("after")
    filled = (F.col("gaps") == 2) & (kind == "fill-in")
    begun = filled & (F.length(before) >= 3) & key.startswith(before) & (F.length(key) > F.length(before) + 2)
    reached = key.endswith(after)
    # The last part of the gap sentence that the answer got to, where it stops within it.
    stopped = begun & ~reached & (F.length(after) > 4) & F.exists(F.sequence(F.lit(3), F.greatest(F.length(after) - 1, F.lit(3))), lambda i: key.endswith(F.substring(after, F.lit(1), i)) & (i < F.length(after)))
    given, put = F.col("given"), F.col("put")
    ordering = kind == "ordering"
    rows = rows.withColumns({
        "is_option": F.exists(option_keys, lambda o: (o == key) & (o != "")), "begun": begun, "stopped": stopped,
        "missing": F.size(F.array_except(given, put)), "foreign": F.size(F.array_except(F.slice(put, 1, F.greatest(F.size(put) - 1, F.lit(1))), given)),
        "same": (key == asked) | (F.col("bare") == asked), "in_order": ordering & ~a.contains("/") & q.contains("/"),
    })
    is_option, in_order, letter = F.col("is_option"), F.col("in_order"), F.col("letter")
    due = ~free
    filled_in = due & (F.length(key) > 0)
    # Functions of one defect don't look at another: an item may get votes for several.
    rows = rows.withColumns({"text": filled_in & ~letter & ~is_option, "filled_in": filled_in, "brief": due & ~is_option & ~letter})
    text, filled_in, spoken, said = F.col("text"), F.col("filled_in"), F.col("spoken"), F.col("said")
    out = {
        # nothing is there; no letter or digit is there; a known placeholder
        "empty_1": _cast(~a.rlike(r"[^\s\p{Z}\p{C}]"), due),
        "empty_2": _cast(F.length(key) == 0, due),
        "empty_3": _cast(F.length(key).between(1, 16) & key.isin(*PLACEHOLDERS), due & ~is_option),
        # the same letters and digits, perhaps after a lead-in; the same words in the same places; the gap still open
        "copy_1": _cast(F.col("same") & ~in_order, (asked != "") & (key != "") & ~is_option),
        "copy_2": _cast(
            (F.size(put) - F.size(given)).between(0, 1) & ~in_order
            & (F.slice(put, F.greatest(F.size(put) - F.size(given) + 1, F.lit(1)), F.greatest(F.size(given), F.lit(1))) == given)
            & (F.regexp_count(a, F.lit(r"_{2,}")) == F.regexp_count(q, F.lit(r"_{2,}")))
            & ((F.size(put) == F.size(given)) | a.rlike(r"^[^:→=]{0,14}[:→=]")),
            (F.size(given) > 1) & (F.size(put) > 1) & ~is_option,
        ),
        "copy_3": _cast(a.rlike(r"_{2,}\s*\p{L}|\p{L}\s*_{2,}"), filled_in & q.rlike("_{2,}") & (F.length(key) > 12)),
        # a model speaks of itself; it cannot, and speaks of the task; it asks for material
        "refusal_1": _cast(a.rlike(_SELF), text),
        "refusal_2": _cast(a.rlike(_CANNOT) & a.rlike(_TASK), text),
        "refusal_3": _cast(a.rlike(_REQUEST), text & (F.size(put) > 4)),
        # function words of another language
        "language_1": _cast((said != spoken) & ~F.col("translation"), text & said.isNotNull()),
        # it is the beginning of an option; words to be ordered are missing; the sentence around the gap stops; a broken character
        "truncated_2": _cast(text & (F.length(key) >= 2) & F.exists(option_keys, lambda o: o.startswith(key) & (F.length(o) > F.length(key))), filled_in & (F.size("options") > 1)),
        "truncated_3": _cast(text & (F.col("missing") > 0) & (F.col("foreign") == 0), filled_in & ordering),
        "truncated_4": _cast(F.col("stopped"), text & F.col("begun")),
        "truncated_5": _cast(a.rlike(r"�[\s\p{P}]*$"), text),
    }
    ends = text & (F.char_length(a) > 3) & (F.size("options") < 2)
    return rows.select("question_id", "type", "question", "answer", "options", "spoken", "said", "free", "key", "text", "brief", "translation", ends.alias("ends"), *[c.cast("int").alias(n) for n, c in out.items()])


def _vote(rows: DataFrame) -> DataFrame:
    """The votes of an item by itself, and those of the functions that ask what other items have."""
    key, text, known = F.col("key"), F.col("text"), F.col("known")
    out = {
        # a short answer that all types share
        "empty_4": _cast((F.length(key) < 10) & ((F.coalesce("spread", F.lit(0)) >= SPREAD) | (F.length(key) == 0)), F.col("brief")),
        # all types share a sentence of it
        "refusal_4": _cast(F.col("shared"), text & F.col("shared").isNotNull()),
        # hardly any word that its language's questions have
        "language_2": _cast((known < 0.34) & ~F.col("translation"), text & known.isNotNull()),
        # it stops where no answer of its type does
        "truncated_1": _cast(F.col("early"), F.col("ends")),
    }
    return rows.select("question_id", *[out[n].cast("int").alias(n) if n in out else n for names in FUNCTIONS.values() for n in names])


def fit(counts: dict[tuple[int, ...], int], weight: float = WEIGHT, rounds: int = ROUNDS) -> dict[tuple[int, ...], float]:
    """Posterior of a defect for each pattern of its votes, by expectation maximisation over their counts.

    All functions start alike; how far each can be trusted is learned from how they agree. A function that
    doesn't vote on an item says nothing about it.
    """
    # Items that no function could judge say nothing of how rare the defect is among the others.
    patterns = [p for p in counts if any(p)]
    if not patterns:
        return dict.fromkeys(counts, 0.0)
    total = sum(counts[p] for p in patterns)
    weight = max(1.0, weight * sum(counts.values()))
    prior, trust = SHARE, [[HIT, FALSE] for _ in patterns[0]]
    post: dict[tuple[int, ...], float] = {}

    def log(k: int, side: int, vote: int) -> float:
        p = min(max(trust[k][side], 1e-9), 1 - 1e-9)
        return 0.0 if vote == 0 else math.log(p if vote == 1 else 1 - p)

    for _ in range(rounds):
        before = dict(post)
        for p in patterns:
            odds = math.log(prior) - math.log(1 - prior) + sum(log(k, 0, v) - log(k, 1, v) for k, v in enumerate(p))
            post[p] = 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))
        if before and max(abs(post[p] - before[p]) for p in patterns) < GAIN:
            break
        mass = sum(counts[p] * post[p] for p in patterns)
        prior = min(0.5, (mass + weight * SHARE) / (total + weight))
        for k in range(len(trust)):
            for side, belief in ((0, HIT), (1, FALSE)):
                of = {p: counts[p] * (post[p] if side == 0 else 1 - post[p]) for p in patterns if p[k] != 0}
                trust[k][side] = (sum(n for p, n in of.items() if p[k] == 1) + weight * belief) / (sum(of.values()) + weight)
            # A function never speaks for a defect by voting against it.
            trust[k][0] = max(trust[k][0], trust[k][1])
    return {p: post.get(p, 0.0) for p in counts}


def defects(items: DataFrame, cutoffs: dict[str, float] | None = None, rounds: int = ROUNDS) -> DataFrame:
    """question_id, defect, posterior: each defect of each item whose posterior exceeds the defect's cutoff.

    ``items`` has question_id, collection, item_type, instruction, question, option_a to option_e and
    correct_answer; nulls count as blanks; repeated rows count each; an item may keep several defects. The
    label model sees every item, as counts of vote patterns, of which there are at most 3 to the number of
    functions.
    """
    cutoffs = CUTOFFS | (cutoffs or {})
    # The votes of one defect as one number, a digit to the base of three for each function.
    number = lambda names: reduce(lambda x, y: x + y, [(F.col(n) + 1) * 3**k for k, n in enumerate(names)])
    by = F.inline(F.array(*[F.struct(F.lit(d).alias("defect"), number(names).alias("pattern")) for d, names in FUNCTIONS.items()]))
    voted = cut(votes(items)).select("question_id", by)
    seen: dict[str, dict[tuple[int, ...], int]] = {d: {} for d in DEFECTS}
    for r in voted.groupBy("defect", "pattern").count().collect():
        seen[r["defect"]][tuple(r["pattern"] // 3**k % 3 - 1 for k in range(len(FUNCTIONS[r["defect"]])))] = r["count"]
    sure = []
    for defect, counts in seen.items():
        for p, x in fit(counts, rounds=rounds).items():
            # A defect needs a vote for it, however rare the votes against it are.
            if x > cutoffs[defect] and 1 in p:
                sure.append((defect, sum((v + 1) * 3**k for k, v in enumerate(p)), float(x)))
    table = F.broadcast(items.sparkSession.createDataFrame(sure, "defect string, pattern int, posterior double"))  # at most one row for each pattern of votes
    return voted.join(table, ["defect", "pattern"]).select("question_id", "defect", "posterior")


def found(items: DataFrame) -> DataFrame:
    """question_id, defect: each defective item with the one defect that is surest to exclude the others."""
    place = F.array_position(F.array(*map(F.lit, DEFECTS)), F.col("defect"))
    return defects(items).groupBy("question_id").agg(F.min_by("defect", place).alias("defect"))
