"""Problem 5: text that looks the same but is made of other characters.

A cheap JVM-side pattern finds the few values that could hold such characters; all others pass untouched.
The rest are normalised: ignorable characters are deleted, spaces, width, ligature and font forms become
the characters they stand for, parts are composed. A word whose letters are of several scripts, or that
could be a disguised word of the text's own script, becomes a lattice: at each place the letter itself and
its look-alikes. A Viterbi search finds the best path of each script under that script's character
trigrams, counted over all texts, and the best script wins.
"""

from __future__ import annotations

import math
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Letters that look like Latin letters, by script, in the order of the Latin letters.
CYRILLIC = {
    "а": "a", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "У": "Y", "Ѵ": "V", "Ԝ": "W", "Х": "X",
}
GREEK = {
    "α": "a", "ι": "i", "κ": "k", "ο": "o", "ρ": "p", "υ": "u", "ν": "v", "γ": "y", "χ": "x", "η": "n", "ω": "w", "ϲ": "c", "ϳ": "j",
    "Α": "A", "Β": "B", "Ε": "E", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Χ": "X", "Υ": "Y", "Ζ": "Z", "Ϲ": "C",
}
ARMENIAN = {"ց": "g", "հ": "h", "ո": "n", "օ": "o", "ս": "u", "զ": "q"}
LATIN = {"ı": "i", "ɑ": "a", "ɡ": "g", "ꞓ": "c"}

SCRIPTS = ("Latin", "Greek", "Cyrillic")
#: What each changed letter costs a reading, in nats: a disguise is rarer than plain text.
CHANGE = 1.0
#: Trigrams go to the workers up to this count; three alphabets of lower-case letters have fewer.
MOST_TRIGRAMS = 2_000_000

# Characters without a glyph that aren't format characters: joiner, fillers, variation selectors.
_FILLERS = "\u034f\u115f\u1160\u17b4\u17b5\u3164\uffa0"
_INVISIBLE = _FILLERS + "\u180b-\u180f\ufe00-\ufe0f"
#: Java pattern of values that could be cases: anything but ordinary composed text of one script.
SUSPECT = (
    rf"[\p{{Cf}}\p{{M}}\p{{Zl}}\p{{Zp}}{_INVISIBLE}]|[\p{{Zs}}&&[^ ]]"
    r"|[\uff01-\uffef\ufb00-\ufb06\ufb13-\ufb17\u0132\u0133\u01c4-\u01cc\u01f1-\u01f3\u2100-\u214f]|[\x{1d400}-\x{1d7ff}]"
    r"|[\u1100-\u11ffıɑɡ]"
)
#: Anything but ASCII, ordinary Latin letters and signs, and usual punctuation.
UNUSUAL = r"[^\x00-\x7f\u00a1-\u00ac\u00ae-\u0130\u0134-\u01c3\u2010-\u2027\u2030-\u205e]"

_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_JOINING = regex.compile(r"[\u0600-\u0dff\u0f00-\u109f\u1780-\u17ff᠀-᯿\p{Extended_Pictographic}]")
_RTL = regex.compile(r"[\u0590-\u08ff]")
_VISIBLE_BASE = regex.compile(r"[\p{Extended_Pictographic}\p{Han}\p{Mongolian}#*0-9]")
_LIGATURES = frozenset(chr(c) for c in (*range(0xFB00, 0xFB07), *range(0xFB13, 0xFB18), 0x132, 0x133, *range(0x1C4, 0x1CD), *range(0x1F1, 0x1F4)))
_IS = {s: regex.compile(rf"\p{{{s}}}") for s in (*SCRIPTS, "Armenian")}


def suspect(c: Column) -> Column:
    """Values that could be cases. ASCII is told by its length in bytes; then ordinary Latin text by plain
    ranges; only what is left meets the finer patterns, each of which looks at a sign once."""
    return (F.octet_length(c) > F.char_length(c)) & c.rlike(UNUSUAL) & (c.rlike(SUSPECT) | (c.rlike(r"\p{IsLatin}") & c.rlike(r"[\p{IsGreek}\p{IsCyrillic}\p{IsArmenian}]")))


@lru_cache(maxsize=100_000)
def script(ch: str) -> str:
    return next((s for s, p in _IS.items() if p.match(ch)), "")


@lru_cache(maxsize=1)
def _readings() -> dict[str, dict[str, tuple[str, ...]]]:
    """For each script and letter, the letters of that script that it may stand for."""
    of: dict[str, dict[str, set[str]]] = {s: defaultdict(set) for s in SCRIPTS}
    for pairs in (CYRILLIC, GREEK, ARMENIAN, LATIN):
        for odd, plain in pairs.items():
            of["Latin"][odd].add(plain)
            if script(odd) in SCRIPTS and script(odd) != "Latin":
                of[script(odd)][plain].add(odd)
    # An upright stroke may be either of two Latin letters.
    for odd in "ІΙӏ":
        of["Latin"][odd] |= {"I", "l"}
    for a, x in GREEK.items():
        for b, y in CYRILLIC.items():
            if x == y:
                of["Greek"][b].add(a)
                of["Cyrillic"][a].add(b)
    return {s: {k: tuple(sorted(v)) for k, v in d.items()} for s, d in of.items()}


def plain_form(ch: str) -> str:
    """What a space, width, ligature or font form stands for; other characters as they are."""
    if ch.isascii():
        return ch
    if unicodedata.category(ch) == "Zs":
        return " "
    tag = unicodedata.decomposition(ch).partition(" ")[0]
    if tag in ("<wide>", "<narrow>", "<font>") or ch in _LIGATURES:
        return unicodedata.normalize("NFKC", ch)
    return ch


def _ignorable(text: str, at: int) -> bool:
    """Whether the character shows nothing and says nothing where it stands."""
    ch = text[at]
    if unicodedata.category(ch) not in ("Cf", "Mn", "Lo"):
        return False
    before, after = text[at - 1] if at else "", text[at + 1] if at + 1 < len(text) else ""
    if ch in "\u200c\u200d":
        return not (_JOINING.match(before) and _JOINING.match(after)) if before and after else True
    if ch in "\u200e\u200f\u061c" or "\u202a" <= ch <= "\u202e" or "\u2066" <= ch <= "\u2069":
        return not _RTL.search(text)
    if "\ufe00" <= ch <= "\ufe0f" or "\u180b" <= ch <= "\u180f":
        return not (before and _VISIBLE_BASE.match(before))
    if "\U000e0000" <= ch <= "\U000e007f":
        return not (before and (_VISIBLE_BASE.match(before) or before >= "\U000e0000"))
    if unicodedata.category(ch) == "Cf":
        return not "\u0600" <= ch <= "\u06dd"  # signs that stand before Arabic numbers are visible
    return ch in _FILLERS


def normalised(text: str) -> str:
    """Without ignorable characters, in plain and composed forms; letters of other scripts stay."""
    text = "".join(ch for k, ch in enumerate(text) if ch.isascii() or not _ignorable(text, k))
    return unicodedata.normalize("NFC", "".join(map(plain_form, text)))


class Trigrams:
    """Smoothed log probabilities of letters after two others, for each script."""

    def __init__(self, counts: list[tuple[str, str, int]]):
        self.of: dict[str, dict[str, int]] = {s: {} for s in SCRIPTS}
        self.pair: dict[str, dict[str, int]] = {s: defaultdict(int) for s in SCRIPTS}
        letters: dict[str, set[str]] = {s: set() for s in SCRIPTS}
        for s, gram, n in counts:
            self.of[s][gram] = self.of[s].get(gram, 0) + n
            self.pair[s][gram[:2]] += n
            letters[s].add(gram[2])
        self.size = {s: max(len(x), 30) for s, x in letters.items()}
        total = sum(sum(d.values()) for d in self.of.values()) or 1
        #: How often a word is of the script at all.
        self.prior = {s: math.log((sum(d.values()) + 1) / (total + len(SCRIPTS))) for s, d in self.of.items()}

    def log(self, s: str, gram: str) -> float:
        gram = gram.lower()
        return math.log((self.of[s].get(gram, 0) + 0.01) / (self.pair[s].get(gram[:2], 0) + 0.01 * self.size[s]))

    def best(self, word: str, s: str) -> tuple[float, str] | None:
        """Viterbi: the best reading of the word in one script, and its score; none if a letter has no reading."""
        readings = _readings()[s]
        states: dict[str, tuple[float, str]] = {"^^": (self.prior[s], "")}
        for ch in word:
            own = script(ch)
            ways = ([ch] if own in (s, "") else []) + [x for x in readings.get(ch, ()) if x != ch]
            if not ways:
                return None
            step: dict[str, tuple[float, str]] = {}
            for last, (score, path) in states.items():
                for x in ways:
                    value = score + self.log(s, last + x) - CHANGE * (x != ch)
                    key = (last + x)[-2:]
                    if key not in step or value > step[key][0]:
                        step[key] = (value, path + x)
            states = step
        return max((score + self.log(s, last + "$"), path) for last, (score, path) in states.items())

    def read(self, word: str, around: str) -> str:
        """The word in one script. A word that is of one script already changes only if another reading in
        the script of the text around it is likelier."""
        scripts = {script(c) for c in word} - {""}
        if not scripts or (len(scripts) == 1 and (scripts <= {around} or not around) and not any(c in LATIN for c in word)):
            return word
        options = [b for s in SCRIPTS if (b := self.best(word, s))]
        if not options:
            return word
        return max(options)[1]

    def clean(self, text: str) -> str:
        flat = normalised(text)
        if flat.isascii():
            return flat
        counts: dict[str, int] = defaultdict(int)
        for ch in flat:
            if s := script(ch):
                counts[s] += 1
        if not counts:
            return flat
        around = max(counts, key=lambda s: counts[s])
        if len(counts) == 1 and not any(c in LATIN for c in flat):
            return flat
        return _WORD.sub(lambda m: self.read(m.group(), around), flat)


def trigram_counts(texts: DataFrame) -> DataFrame:
    """script, gram, n: trigrams of all words that are of one script, over the column ``text`` of all rows.

    Words are counted first, so each distinct word is cut into trigrams once.
    """
    word = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{M}]+"), F.lit(0)))
    words = texts.where("text is not null").select(word.alias("word")).groupBy("word").count()
    of = F.when(F.col("word").rlike(r"^\p{IsLatin}+$"), "Latin").when(F.col("word").rlike(r"^\p{IsGreek}+$"), "Greek").when(F.col("word").rlike(r"^\p{IsCyrillic}+$"), "Cyrillic")
    marked = F.concat(F.lit("^^"), F.col("word"), F.lit("$"))
    grams = F.transform(F.sequence(F.lit(1), F.length(marked) - 2), lambda i: F.substring(marked, i, F.lit(3)))
    # A word of another script within Latin letters is what is searched for: single letters don't count there.
    kept = words.withColumn("script", of).where("script is not null and (script = 'Latin' or length(word) > 1)")
    return kept.select("script", "count", F.explode(grams).alias("gram")).groupBy("script", "gram").agg(F.sum("count").alias("n"))


def cleaner(texts: DataFrame, text: str = "text"):
    """A function of a text column that gives its consistent form, with the trigrams of all ``texts``."""
    counts = trigram_counts(texts.select(F.col(text).alias("text")))
    # Alphabets are bounded, and so are their trigrams; none is left out.
    model = [tuple(r) for r in counts.limit(MOST_TRIGRAMS + 1).collect()]
    if len(model) > MOST_TRIGRAMS:
        raise ValueError(f"more than {MOST_TRIGRAMS} different trigrams")
    held = texts.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def fixed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        trigrams = Trigrams(held.value)
        for texts in batches:
            yield texts.map(trigrams.clean, na_action="ignore")

    return fixed


def normalise(rows: DataFrame, text: str = "text", clean: str = "clean") -> DataFrame:
    """``rows`` with a column ``clean``: the text in one consistent form. It differs from the text in cases only.

    Null stays null and blank stays blank. ``rows`` may hold any other columns. Only values that the
    JVM-side pattern finds go through Python.
    """
    fixed = cleaner(rows, text)
    asked = rows.withColumn("_ask", F.when(suspect(F.col(text)), F.col(text)))
    return asked.withColumn(clean, F.coalesce(fixed(F.col("_ask")), F.col(text))).drop("_ask")


def cases(rows: DataFrame, text: str = "text", clean: str = "clean") -> DataFrame:
    """The rows of ``normalise`` whose text isn't in its consistent form: the rest is dropped before Python."""
    fixed = cleaner(rows, text)
    return rows.where(suspect(F.col(text))).withColumn(clean, fixed(F.col(text))).where(F.col(text) != F.col(clean))
