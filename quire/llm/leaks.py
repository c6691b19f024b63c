"""Problem 8: passages of held-out items inside a corpus, by winnowing.

Each text becomes its words; every K consecutive words get a hash, and of every window of W such hashes
the least is kept. Two texts that share K + W - 1 words in a row share at least one kept hash, so no such
passage is missed. A shared hash is only a hint: it is extended word by word to both sides, and counts
if the shared run has at least ``least`` words.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Held-out fingerprints and words up to this count are sent to the workers; more of them are joined by a shuffle.
MOST_SENT = 4_000_000
#: A window never spans more than this many words, so that hashes of K words stay selective.
K = 6

_TAG = re.compile(r"</?[A-Za-z][^<>]*>")
_WORD = re.compile(r"[^\W_]+")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=500_000)
def _hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))


def words(text: str | None) -> list[str]:
    """Runs of letters and digits, caseless and without accents; tags, entities and invisible characters play no part."""
    if not text:
        return []
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
    text = text.casefold()
    if not text.isascii():
        text = "".join(c for c in unicodedata.normalize("NFKD", text) if (k := unicodedata.category(c)) != "Mn" and k != "Cf")
    return _WORD.findall(text)


def word_hashes(text: str | None) -> np.ndarray:
    return np.fromiter(map(_hash, words(text)), dtype=np.uint64)


def fingerprints(hashes: np.ndarray, k: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The kept hashes of a text and the places of their first words.

    A text with fewer than ``k`` words has none; one with fewer than ``window`` hashes keeps its least.
    """
    n = len(hashes) - k + 1
    if n < 1:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    grams = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            grams = (grams ^ hashes[j : j + n]) * _MULTIPLIER
            grams ^= grams >> np.uint64(29)
    if n <= window:
        at = np.array([int(np.argmin(grams))])
    else:
        views = np.lib.stride_tricks.sliding_window_view(grams, window)
        at = np.unique(views.argmin(axis=1) + np.arange(len(views)))
    return grams[at], at


def run_length(a: np.ndarray, i: int, b: np.ndarray, j: int) -> int:
    """Words that two texts share in a row around the places ``i`` and ``j``; 0 if those differ."""
    n = min(len(a) - i, len(b) - j)
    differ = np.flatnonzero(a[i : i + n] != b[j : j + n])
    ahead = int(differ[0]) if len(differ) else n
    if not ahead:
        return 0
    m = min(i, j)
    differ = np.flatnonzero(a[i - m : i][::-1] != b[j - m : j][::-1])
    return ahead + (int(differ[0]) if len(differ) else m)


def _prints_of(id_name: str, k: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, prints = [], []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                kept = np.unique(fingerprints(word_hashes(text), k, window)[0])
                ids.append(np.full(len(kept), row, dtype=np.int64))
                prints.append(kept.view(np.int64))
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(prints))], names=[id_name, "print"])

    return run


def _pairs_of(held, k: int, window: int, least: int):
    """Documents against the held-out items that were sent to the worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item_ids, offsets, flat, prints, owner, place = held.value
        for batch in batches:
            docs, items, longest = [], [], []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = word_hashes(text)
                if len(own) < least or not len(prints):
                    continue
                kept, at = fingerprints(own, k, window)
                lo, hi = np.searchsorted(prints, kept, "left"), np.searchsorted(prints, kept, "right")
                best: dict[int, int] = {}
                for h in np.flatnonzero(hi > lo):
                    for x in range(lo[h], hi[h]):
                        o = owner[x]
                        n = run_length(own, int(at[h]), flat[offsets[o] : offsets[o + 1]], int(place[x]))
                        if n >= least and n > best.get(o, 0):
                            best[o] = n
                docs += [row] * len(best)
                items += [int(item_ids[o]) for o in best]
                longest += best.values()
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(items, pa.int64()), pa.array(longest, pa.int32())], names=["doc_id", "item_id", "words"])

    return run


def _checked(least: int):
    """Pairs that share a fingerprint, with both texts: the longest shared run of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns)))
            out = [(d, i, n) for d, i, a, b in rows if (n := longest_run(word_hashes(a), word_hashes(b))) >= least]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], kind) for c, kind in enumerate((pa.int64(), pa.int64(), pa.int32()))], names=["doc_id", "item_id", "words"])

    return run


def longest_run(a: np.ndarray, b: np.ndarray) -> int:
    """The longest run of words that two texts share, over all places."""
    places: dict[int, list[int]] = {}
    for j, h in enumerate(b.tolist()):
        places.setdefault(h, []).append(j)
    best, last = 0, {}
    for h in a.tolist():
        now = {}
        for j in places.get(h, ()):
            now[j] = n = last.get(j - 1, 0) + 1
            best = max(best, n)
        last = now
    return best


PAIRS = "doc_id bigint, item_id bigint, words int"


def leaks(documents: DataFrame, items: DataFrame, least: int = 12, most_sent: int = MOST_SENT) -> DataFrame:
    """doc_id, item_id, words: each document with each item of which it holds ``least`` words in a row, and how many.

    Null and empty texts give nothing; repeated documents count each, and one that holds a passage twice
    is one row. Other columns are not read. The held-out side is measured first: up to ``most_sent``
    words it goes to the workers and documents are scanned without any shuffle; a larger one meets the
    documents' fingerprints in a shuffled join, and only pairs that share one are looked at. Both give
    the same rows.
    """
    k = min(K, least)
    window = least - k + 1
    items = items.select(F.col("item_id").cast("bigint"), "text")
    docs = documents.select(F.col("doc_id").cast("bigint"), "text").where("text is not null")
    spark = documents.sparkSession
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    # A word has at least one character besides the space after it.
    if size // 2 <= most_sent:
        rows = items.orderBy("item_id").collect()
        hashes = [word_hashes(r.text) for r in rows]
        offsets = np.cumsum([0, *map(len, hashes)])
        # All places of the items: with the documents winnowed, each kept hash of theirs finds its place.
        every = [fingerprints(h, k, 1) for h in hashes]
        prints = np.concatenate([e[0] for e in every]) if every else np.empty(0, dtype=np.uint64)
        owner = np.repeat(np.arange(len(rows)), [len(e[0]) for e in every])
        place = np.concatenate([e[1] for e in every]) if every else np.empty(0, dtype=np.int64)
        by = np.argsort(prints, kind="stable")
        flat = np.concatenate(hashes) if hashes else np.empty(0, dtype=np.uint64)
        held = spark.sparkContext.broadcast((np.array([r.item_id for r in rows], dtype=np.int64), offsets, flat, prints[by], owner[by], place[by]))
        return docs.mapInArrow(_pairs_of(held, k, window, least), PAIRS)
    ours = docs.mapInArrow(_prints_of("doc_id", k, window), "doc_id bigint, print bigint")
    theirs = items.where("text is not null").mapInArrow(_prints_of("item_id", k, window), "item_id bigint, print bigint")
    hints = ours.join(theirs, "print").select("doc_id", "item_id").distinct()
    return (
        hints.join(docs, "doc_id")
        .join(items.withColumnRenamed("text", "item_text"), "item_id")
        .select("doc_id", "item_id", "text", "item_text")
        .mapInArrow(_checked(least), PAIRS)
    )
