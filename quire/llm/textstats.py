"""Problem 9: per-document statistics, and whether a document is prose, a list, a table or junk.

Each line becomes a few coarse observations (which signs, how many words between separators, how many
common words), counted for all lines of a batch at once by Arrow. A hidden Markov model with the states
prose, list, table and junk labels the lines. Its chances are estimated by expectation maximisation over the
lines of all documents until their likelihood stands still; stated beliefs about what lines of each kind
look like are its start and weigh as much as a stated share of the lines, which keeps the states' meaning.
The posterior shares of a document's characters decide.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import cut

STATES = ("prose", "list", "table", "junk")
#: A common word stands in at least this share of all texts.
COMMON_SHARE = 0.02
#: The beliefs weigh as much as this share of all lines.
BELIEF = 0.25
#: Training ends when the mean log likelihood of a line gains less than this, after so many rounds at the latest.
GAIN, ROUNDS = 0.002, 12

# Patterns of RE2, which Arrow uses: letters are what Python counts as such, white space is that of Unicode.
_S = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_N = r"[^\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_L = r"[\p{L}\p{Nl}\p{No}]"
_OTHER = r"[^\p{L}\p{Nl}\p{No}]+"
_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
_MARK = rf"^{_S}*(?:[-*+•·‣◦–—○●▪■□☐☑✓>]+{_S}+|\(?\p{{Nd}}{{1,4}}[.)]{_S}+|\(?[A-Za-z][.)]{_S}+)"
_PART = rf"[,;|\t•·]| {{2,}}|{_S}[–—-]{_S}"
_LEADER = rf"(?:\.{{3,}}|…{{2,}}|(?:\. ){{3,}}|_{{3,}}){_S}*\p{{Nd}}+{_S}*$"
_CLOSING = "[\"'»“”’)\\]]*"
_ENDED = rf"[.!?:;…]{_CLOSING}{_S}*$"
_SENTENCE = rf"[.!?…]{_CLOSING}({_S}|$)"
#: Signs that are neither letters nor digits nor the marks that texts, lists and tables are full of.
_ODD = r"_|[^\p{L}\p{N}\s\x0b\x1c-\x1f\x{85}\p{Z}.,;:!?'\"()|–—/…„“”«»’•‚‘-]"
#: Lines that may have column separators, and these as Python finds them, with what stands around them.
_MAYBE_COLUMNS = r"[\p{L}\p{N}_][,;][\p{L}\p{N}_]|[|\t]|  "
_COLUMN = re.compile(r"(?:(?<=\s)|^|(?<=\w))\|(?=\s|\w|-|:|$)|\t| {2,}|(?<=\w);(?=\w)|(?<=\w),(?=[^\W\d])")

# Observations of a line, and the beliefs to start from: for each hidden state the chance of each value.
# Junk has two hidden states, noise of signs and words that aren't any; they are added up as junk.
HIDDEN = ("prose", "list", "table", "noise", "gibberish")
FEATURES: dict[str, list[list[float]]] = {
    # letters among all signs: under .3, under .55, under .72, more
    "letters": [[0.005, 0.02, 0.10, 0.875], [0.01, 0.09, 0.20, 0.70], [0.14, 0.24, 0.27, 0.35], [0.60, 0.25, 0.05, 0.10], [0.01, 0.02, 0.07, 0.90]],
    # signs that are neither letters, digits nor usual marks: under .04, under .15, more
    "odd": [[0.985, 0.013, 0.002], [0.90, 0.08, 0.02], [0.945, 0.05, 0.005], [0.32, 0.10, 0.58], [0.97, 0.02, 0.01]],
    # column separators: none, one, two, more
    "columns": [[0.90, 0.08, 0.015, 0.005], [0.86, 0.10, 0.02, 0.02], [0.03, 0.06, 0.11, 0.80], [0.74, 0.08, 0.06, 0.12], [0.95, 0.03, 0.01, 0.01]],
    # a bullet or number in front: no, yes
    "mark": [[0.95, 0.05], [0.50, 0.50], [0.98, 0.02], [0.97, 0.03], [0.98, 0.02]],
    # words between separators: up to 2.5, up to 4, up to 7, more
    "part": [[0.04, 0.10, 0.28, 0.58], [0.62, 0.27, 0.08, 0.03], [0.80, 0.15, 0.03, 0.02], [0.75, 0.07, 0.06, 0.12], [0.05, 0.07, 0.18, 0.70]],
    # ends of sentences: none, at the end only, within
    "sentence": [[0.30, 0.22, 0.48], [0.84, 0.14, 0.02], [0.96, 0.03, 0.01], [0.82, 0.10, 0.08], [0.20, 0.20, 0.60]],
    # common words among words of two letters and more: under .15, under .4, under .65, more
    "common": [[0.003, 0.027, 0.12, 0.85], [0.06, 0.12, 0.22, 0.60], [0.15, 0.15, 0.25, 0.45], [0.96, 0.02, 0.01, 0.01], [0.95, 0.044, 0.003, 0.003]],
    # words: none, up to 3, up to 8, up to 20, more
    "words": [[0.005, 0.055, 0.24, 0.30, 0.40], [0.01, 0.60, 0.23, 0.04, 0.12], [0.10, 0.30, 0.50, 0.08, 0.02], [0.52, 0.10, 0.06, 0.10, 0.22], [0.01, 0.04, 0.15, 0.20, 0.60]],
    # shape of the tokens: ordinary, mostly one or two signs, one of over 40 signs, one sign repeated
    "tokens": [[0.993, 0.003, 0.002, 0.002], [0.96, 0.03, 0.002, 0.008], [0.85, 0.13, 0.01, 0.01], [0.25, 0.30, 0.22, 0.23], [0.95, 0.02, 0.02, 0.01]],
    # dots that lead to a number at the end: no, yes
    "leader": [[0.999, 0.001], [0.85, 0.15], [0.99, 0.01], [0.995, 0.005], [0.998, 0.002]],
    # words without an end of a sentence: under 25, under 45, more
    "stretch": [[0.95, 0.036, 0.014], [0.84, 0.06, 0.10], [0.97, 0.02, 0.01], [0.80, 0.07, 0.13], [0.80, 0.08, 0.12]],
    # digits among all signs: under .1, under .4, more
    "digits": [[0.97, 0.025, 0.005], [0.80, 0.19, 0.01], [0.55, 0.38, 0.07], [0.50, 0.20, 0.30], [0.96, 0.03, 0.01]],
}
SIZES = [len(f[0]) for f in FEATURES.values()]
START = np.array([0.60, 0.15, 0.13, 0.07, 0.05])
STEP = np.array([
    [0.955, 0.02, 0.015, 0.005, 0.005],
    [0.05, 0.925, 0.015, 0.005, 0.005],
    [0.05, 0.02, 0.92, 0.005, 0.005],
    [0.03, 0.01, 0.01, 0.94, 0.01],
    [0.03, 0.01, 0.005, 0.015, 0.94],
])


def _bins(values: np.ndarray, *limits: float) -> np.ndarray:
    return np.searchsorted(np.array(limits), values, side="right")


def _count(texts: pa.Array, pattern: str) -> np.ndarray:
    return pc.count_substring_regex(texts, pattern).to_numpy(zero_copy_only=False).astype(np.int64)


def _signs(texts: pa.Array, others: str) -> np.ndarray:
    """How many characters each text has besides runs of others."""
    return pc.utf8_length(pc.replace_substring_regex(texts, others, "")).to_numpy(zero_copy_only=False).astype(np.int64)


def _split(texts: pa.Array, pattern: str) -> tuple[pa.Array, np.ndarray]:
    """The pieces of all texts in one array, and where those of each text begin; each text has one at least."""
    parts = pc.split_pattern_regex(texts, pattern)
    return parts.flatten(), parts.offsets.to_numpy()


def _trim(texts: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(texts, f"^{_S}+|{_S}+$", "")


def observe(lines: pa.Array, common: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The observations of lines that aren't blank, each line's as one number, and its weight: the signs it has."""
    if not len(lines):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    line = _trim(lines)
    rest = _trim(pc.replace_substring_regex(lines, _MARK, "", max_replacements=1))
    marked = pc.and_(pc.match_substring_regex(lines, _MARK), pc.not_equal(rest, ""))
    body = pc.if_else(marked, rest, line)
    signs = _signs(body, f"{_S}+")
    n = np.maximum(signs, 1)
    letters, digits = _signs(body, _OTHER), _count(body, r"\p{Nd}")
    word_list, at = _split(pc.utf8_lower(body), _OTHER)
    of_word = pc.utf8_length(word_list).to_numpy(zero_copy_only=False)
    usual = pc.is_in(word_list, value_set=common).to_numpy(zero_copy_only=False)
    words, long, known = (np.add.reduceat(x.astype(np.int64), at[:-1]) for x in (of_word > 0, of_word > 1, usual & (of_word > 1)))
    parts = _count(pc.replace_substring_regex(pc.replace_substring_regex(body, "^[ |]+|[ |]+$", ""), _PART, "\x01"), rf"[^\x01]*[^\x01\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}][^\x01]*")
    tokens, at = _split(body, f"{_S}+")
    sizes = pc.utf8_length(tokens).to_numpy(zero_copy_only=False).astype(np.int64)
    longest = np.maximum.reduceat(sizes, at[:-1])
    held, short = np.add.reduceat((sizes > 0).astype(np.int64), at[:-1]), np.add.reduceat(((sizes > 0) & (sizes <= 2)).astype(np.int64), at[:-1])
    ended = pc.replace_substring_regex(body, _SENTENCE, "\x02\\1")
    ends = _count(ended, "\x02")
    inner = ends - pc.ends_with(ended, "\x02").to_numpy(zero_copy_only=False).astype(np.int64)
    pieces, at = _split(ended, "\x02")
    stretch = np.where(inner > 0, np.maximum.reduceat(_count(pieces, _L + "+"), at[:-1]), words)
    shape = ((held >= 4) & (short > 0.6 * held)).astype(np.int64)
    shape[(longest > 40) & (letters + digits > 0.8 * n)] = 2
    for k in np.flatnonzero((signs >= 5) & (letters == 0)):  # lines without a letter are few
        text = body[int(k)].as_py()
        if "|" not in text and len(set("".join(text.split()))) <= 2:
            shape[k] = 3
    odd = _bins(_count(body, _ODD) / n, 0.04, 0.15)
    columns = np.zeros(len(lines), dtype=np.int64)
    # What separates cells of noise separates nothing.
    maybe = pc.match_substring_regex(line, _MAYBE_COLUMNS).to_numpy(zero_copy_only=False)
    for k in np.flatnonzero(maybe & (odd < 2)):
        columns[k] = min(3, len(_COLUMN.findall(line[int(k)].as_py())))
    values = (
        _bins(letters / n, 0.3, 0.55, 0.72),
        odd,
        columns,
        marked.to_numpy(zero_copy_only=False).astype(np.int64),
        _bins(words / np.maximum(1, parts), 2.51, 4.01, 7.01),
        np.where(inner > 0, 2, np.where(ends > 0, 1, 0)),
        np.where(long > 0, _bins(known / np.maximum(1, long), 0.15, 0.4, 0.65), 0),
        _bins(words, 1, 4, 9, 21),
        shape,
        pc.match_substring_regex(body, _LEADER).to_numpy(zero_copy_only=False).astype(np.int64),
        _bins(stretch, 25, 45),
        _bins(digits / n, 0.1, 0.4),
    )
    code = np.zeros(len(lines), dtype=np.int64)
    for value, size in zip(values, SIZES):
        code = code * size + value
    return code, signs


def unpack(codes: np.ndarray) -> np.ndarray:
    """The observations of coded lines, a row for each."""
    out = np.empty((len(codes), len(SIZES)), dtype=np.int64)
    rest = codes.astype(np.int64)
    for k in range(len(SIZES) - 1, -1, -1):
        rest, out[:, k] = np.divmod(rest, SIZES[k])
    return out


class Model:
    """Chances of the first state, of the next state, and of each observation in each state."""

    def __init__(self, start: np.ndarray = START, step: np.ndarray = STEP, emit: list[np.ndarray] | None = None):
        self.start, self.step = start, step
        self.emit = emit if emit is not None else [np.array(f) for f in FEATURES.values()]

    def chances(self, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each line in each state, scaled so that the largest is 1, and the logarithm of the scale."""
        logs = sum(np.log(e)[:, seen[:, k]] for k, e in enumerate(self.emit)).T
        top = logs.max(axis=1, keepdims=True)
        return np.exp(logs - top), top[:, 0]

    def posterior(self, codes: list[np.ndarray], weights: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray, float]:
        """Of each document the posterior of each line; the expected number of each step over all of them; their log likelihood.

        Forward and backward passes run over all documents of the batch at once, the longest first. A document
        counts as often as its weight says.
        """
        s = len(HIDDEN)
        if not len(codes):
            return [], np.zeros((s, s)), 0.0
        times = np.ones(len(codes)) if weights is None else np.asarray(weights, dtype=float)
        sizes = np.array([len(c) for c in codes])
        order = np.argsort(-sizes, kind="stable")
        ahead = np.concatenate([[0], np.cumsum(sizes)])
        # There are few different codes, however many lines.
        different, which = np.unique(np.concatenate(codes), return_inverse=True)
        chance, scale = self.chances(unpack(different))
        flat = chance[which]
        first, ranked, sizes = ahead[order], times[order], sizes[order]
        forward, backward = np.empty_like(flat), np.ones_like(flat)
        longest = int(sizes[0])
        likelihood = float((scale[which] * np.repeat(times, [len(c) for c in codes])).sum())
        for t in range(longest):
            m = int(np.searchsorted(-sizes, -t, side="left"))
            at = first[:m] + t
            last = self.start if t == 0 else forward[at - 1] @ self.step
            now = last * flat[at]
            total = now.sum(axis=1, keepdims=True)
            likelihood += float((np.log(total[:, 0]) * ranked[:m]).sum())
            forward[at] = now / total
        steps = np.zeros((s, s))
        for t in range(longest - 2, -1, -1):
            m = int(np.searchsorted(-sizes, -(t + 1), side="left"))
            at = first[:m] + t
            after = flat[at + 1] * backward[at + 1]
            back = after @ self.step.T
            # The sum over documents of forward x step x after, each divided by its own total.
            each = ranked[:m] / (forward[at] * back).sum(axis=1)
            steps += self.step * (forward[at].T @ (after * each[:, None]))
            backward[at] = back / back.sum(axis=1, keepdims=True)
        both = forward * backward
        both /= both.sum(axis=1, keepdims=True)
        return [both[ahead[k] : ahead[k + 1]] for k in range(len(codes))], steps, likelihood

    def expected(self, codes: list[np.ndarray], weights: np.ndarray | None = None) -> np.ndarray:
        """Expected counts of first states, steps and observations, the log likelihood and the number of lines, in one row."""
        both, steps, likelihood = self.posterior(codes, weights)
        times = np.ones(len(codes)) if weights is None else np.asarray(weights, dtype=float)
        start = sum((b[0] * n for b, n in zip(both, times)), np.zeros(len(HIDDEN)))
        lines = np.repeat(times, [len(c) for c in codes])
        different, which = np.unique(np.concatenate(codes), return_inverse=True)
        held = np.stack([np.bincount(which, weights=w, minlength=len(different)) for w in (np.concatenate(both) * lines[:, None]).T])
        seen = unpack(different)
        emit = [np.stack([np.bincount(seen[:, k], weights=h, minlength=n) for h in held]) for k, n in enumerate(SIZES)]
        return np.concatenate([start, steps.ravel(), *(e.ravel() for e in emit), [likelihood, lines.sum()]])

    def learned(self, counts: np.ndarray, prior: Model, weight: float) -> Model:
        """The likeliest model by the expected counts and a prior that weighs as many observations of each state."""
        s = len(HIDDEN)
        at = [0, s, s + s * s]
        for n in SIZES:
            at.append(at[-1] + s * n)

        def mixed(belief: np.ndarray, new: np.ndarray) -> np.ndarray:
            return (new + weight * belief) / (new.sum(axis=-1, keepdims=True) + weight)

        start = mixed(prior.start, counts[: at[1]])
        step = mixed(prior.step, counts[at[1] : at[2]].reshape(s, s))
        emit = [mixed(e, counts[at[k + 2] : at[k + 3]].reshape(s, n)) for k, (e, n) in enumerate(zip(prior.emit, SIZES))]
        return Model(start, step, emit)


def common_words(documents: DataFrame, text: str = "text", share: float = COMMON_SHARE) -> list[str]:
    """All words that at least ``share`` of all texts have.

    There can be no more of them than the texts' mean number of different words divided by the share.
    """
    word = F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{Nl}\p{No}]+"), F.lit(0))))
    filled = documents.where(F.col(text).rlike(r"\S"))
    least = max(2.0, share * filled.count())
    return sorted(r.word for r in filled.select(word.alias("word")).groupBy("word").count().where(F.col("count") >= least).collect())


LINES = "doc_id bigint, words bigint, mean_word_length double, symbol_ratio double, punctuated_lines double, common_words double, codes array<int>, weights array<int>"


def _lines(known):
    def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(values)])[starts])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = pa.array(known.value, pa.string())
        for batch in batches:
            texts = pc.fill_null(batch.column(1).cast(pa.string()), "")
            every, starts = _split(texts, _BREAK)
            filled = pc.match_substring_regex(every, _N).to_numpy(zero_copy_only=False)
            lines = every.filter(pa.array(filled))
            starts = np.concatenate([[0], np.cumsum(filled)])[starts]
            codes, weights = observe(lines, common)
            word_list, at = _split(pc.utf8_lower(lines), _OTHER)
            held = pc.utf8_length(word_list).to_numpy(zero_copy_only=False)
            in_doc = at[starts]
            words, letters = sums(held > 0, in_doc), sums(held, in_doc)
            usual = sums(pc.is_in(word_list, value_set=common).to_numpy(zero_copy_only=False), in_doc)
            signs, alnum = sums(_signs(lines, f"{_S}+"), starts), sums(_signs(lines, r"[^\p{L}\p{N}]+"), starts)
            ended = sums(pc.match_substring_regex(lines, _ENDED).to_numpy(zero_copy_only=False).astype(np.int64), starts)
            count = np.diff(starts)

            def ratio(part: np.ndarray, whole: np.ndarray) -> pa.Array:
                return pa.array(part / np.maximum(1, whole), pa.float64(), mask=whole == 0)

            lists = [pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(x, pa.int32())) for x in (codes, weights)]
            held = [batch.column(0), pa.array(words), ratio(letters, words), ratio(signs - alnum, signs), ratio(ended, count), ratio(usual, words), *lists]
            yield pa.RecordBatch.from_arrays(held, names=["doc_id", "words", "mean_word_length", "symbol_ratio", "punctuated_lines", "common_words", "codes", "weights"])

    return run


def train(lines: DataFrame, rounds: int = ROUNDS) -> tuple[Model, list[float]]:
    """Expectation maximisation over the lines of all documents, and the mean log likelihood of a line in each round.

    Documents with the same observations are counted first. Each round sends one row of sums from each task.
    """
    groups = cut(lines.where(F.size("codes") > 0).groupBy("codes").agg(F.count(F.lit(1)).alias("n")))
    prior = model = Model()
    told: list[float] = []
    for _ in range(rounds):
        now = model

        def sums(batches: Iterator[pd.DataFrame], now: Model = now) -> Iterator[pd.DataFrame]:
            total = None
            for batch in batches:
                if len(batch):
                    counts = now.expected([np.asarray(c) for c in batch["codes"]], batch["n"].to_numpy())
                    total = counts if total is None else total + counts
            if total is not None:
                yield pd.DataFrame({"k": np.arange(len(total)), "v": total})

        rows = groups.mapInPandas(sums, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
        if not rows:
            break
        counts = np.zeros(len(rows))
        for r in rows:
            counts[r.k] = r.v
        model = now.learned(counts, prior, BELIEF * counts[-1])
        told.append(counts[-2] / counts[-1])
        if len(told) > 1 and told[-1] - told[-2] < GAIN:
            break
    return model, told


SHARES = "doc_id bigint, words bigint, mean_word_length double, symbol_ratio double, punctuated_lines double, common_words double, lines bigint, prose double, list double, table double, junk double"


def statistics(documents: DataFrame, rounds: int = ROUNDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each document: words, mean_word_length, symbol_ratio (signs that are neither letters nor
    digits among all but spaces), punctuated_lines and common_words (shares), lines (that aren't blank), the
    shares of prose, list, table and junk of its signs, and kind, the state of the larger part.

    Null, empty and white-space texts have 0 words and lines, nulls for all ratios and shares, and no kind.
    Where no state has more than half and prose isn't the largest, kind is the largest of the others if
    they hold more than half together. Repeated documents count each. Texts are read whole, in two passes:
    one for the common words, one for the lines, whose codes are kept for the training rounds.
    """
    docs = documents.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).alias("text"))
    known = documents.sparkSession.sparkContext.broadcast(common_words(docs))
    lines = cut(docs.mapInArrow(_lines(known), LINES))
    model, _ = train(lines, rounds)

    def shares(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            codes = [np.asarray(c, dtype=np.int64) for c in batch["codes"]]
            full = [k for k, c in enumerate(codes) if len(c)]
            out = np.full((len(batch), len(STATES)), np.nan)
            if full:
                both, _, _ = model.posterior([codes[k] for k in full])
                for k, b in zip(full, both):
                    w = np.asarray(batch["weights"].iloc[k], dtype=float)
                    share = (b * w[:, None]).sum(axis=0) / w.sum()
                    out[k] = [*share[:3], share[3:].sum()]
            done = batch.drop(columns=["codes", "weights"]).assign(lines=[len(c) for c in codes])
            for k, s in enumerate(STATES):
                done[s] = out[:, k]
            yield done

    measured = lines.mapInPandas(shares, SHARES)
    real = {s: F.when(F.col("lines") > 0, F.col(s)) for s in STATES}
    measured = measured.withColumns(real)
    best = F.when(F.col("prose") >= 0.5, "prose").when((F.col("list") >= F.col("table")) & (F.col("list") >= F.col("junk")), "list").when(F.col("table") >= F.col("junk"), "table").otherwise("junk")
    return measured.withColumn("kind", F.when(F.col("lines") > 0, best))


def found(documents: DataFrame) -> DataFrame:
    """doc_id, kind: the documents whose larger part is a list, a table or junk."""
    return statistics(documents).where("kind <> 'prose'").select("doc_id", "kind")
