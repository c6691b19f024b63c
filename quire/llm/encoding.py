"""Problem 7: token ids of a whole corpus by a public byte-level BPE vocabulary.

Speculate and verify. A word's bytes are cut greedily into the longest tokens of the vocabulary; that
guess is the exact result if and only if every two adjacent tokens would also stay apart when merged on
their own. All adjacent pairs of a batch are tested at once with NumPy, by undoing merges on both sides
of the border and asking whether an earlier merge would have crossed it. Only the words with a failing
pair are merged exactly. Nothing is learned or changed in the vocabulary.
"""

from __future__ import annotations

import heapq
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_FOLDER = "/opt/tokenizers"
#: Vocabulary files above this size aren't sent to the executors.
MOST_BYTES = 64 << 20
#: Distinct words whose ids a worker remembers; beyond it the memory starts anew.
MOST_WORDS = 500_000

# Fixed value: the public pattern by which this family of vocabularies splits a text into words.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The printable stand-ins for bytes in such vocabulary files, by their published rule."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def load_tables(path: str) -> dict[str, np.ndarray | list[bytes]]:
    """What encoding needs of a vocabulary file: each id's bytes, and its merges in order."""
    if os.path.getsize(path) > MOST_BYTES:
        raise ValueError(f"{path} is larger than {MOST_BYTES} bytes")
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    of = byte_letters()
    ids = {token: i for token, i in model["vocab"].items() if all(c in of for c in token)}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    rows = [(ids[a], ids[b], ids[a + b]) for a, b in merges]
    pieces: list[bytes] = [b""] * (max(ids.values()) + 1)
    for token, i in ids.items():
        pieces[i] = bytes(of[c] for c in token)
    return {"pieces": pieces, "merges": np.asarray(rows, dtype=np.int64).reshape(-1, 3)}


@dataclass
class Encoder:
    """Encodes words with the tables of ``load_tables``; one lives in each worker."""

    pieces: list[bytes]
    merges: np.ndarray
    known: dict[str, list[int]] = field(default_factory=dict)
    guessed: int = 0
    repaired: int = 0

    def __post_init__(self) -> None:
        size = len(self.pieces)
        order = np.arange(len(self.merges), dtype=np.int64)
        made = self.merges[:, 2]
        #: When a token is made: bytes before all merges.
        self.rank = np.full(size, -1, dtype=np.int64)
        self.rank[made] = order
        self.left = np.arange(size, dtype=np.int64)
        self.right = np.arange(size, dtype=np.int64)
        self.left[made], self.right[made] = self.merges[:, 0], self.merges[:, 1]
        keys = (self.merges[:, 0] << 32) | self.merges[:, 1]
        by = np.argsort(keys, kind="stable")
        self.pair_keys, self.pair_ranks, self.pair_made = keys[by], order[by], made[by]
        # A token that merging its own bytes doesn't give can't be guessed.
        real = np.zeros(size, dtype=bool)
        for i, piece in enumerate(self.pieces):
            real[i] = len(piece) == 1
        whole = self.apart(self.merges[:, 0], self.merges[:, 1], before=order)
        for k, (a, b, c) in enumerate(self.merges.tolist()):
            real[c] = real[a] and real[b] and bool(whole[k])
        self.ids = {p: i for i, p in enumerate(self.pieces) if p and real[i]}
        self.longest = max(map(len, self.ids), default=1)
        self.byte_ids = {p[0]: i for i, p in enumerate(self.pieces) if len(p) == 1}
        self.split = regex.compile(WORDS).findall

    def merge_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of the merge of each pair, or a number above all ranks."""
        none = np.int64(len(self.pair_keys))
        if not len(self.pair_keys):
            return np.full(len(a), none)
        key = (a << 32) | b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], none)

    def apart(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether each pair of adjacent tokens stays two tokens when all its bytes are merged.

        With ``before``, only merges of a lower rank count. The later of the two tokens is taken apart
        again and again; at each step the pieces that touch at the border must not have a merge that
        would have come before the one just undone.
        """
        a, b = a.astype(np.int64).copy(), b.astype(np.int64).copy()
        limit = np.full(len(a), len(self.pair_keys), dtype=np.int64) if before is None else before.astype(np.int64).copy()
        ok = np.ones(len(a), dtype=bool)
        todo = np.arange(len(a))
        while len(todo):
            x, y = a[todo], b[todo]
            bad = self.merge_rank(x, y) < limit[todo]
            ok[todo[bad]] = False
            todo, x, y = todo[~bad], x[~bad], y[~bad]
            rx, ry = self.rank[x], self.rank[y]
            over = np.maximum(rx, ry) < 0  # two single bytes
            todo, x, y, rx, ry = (v[~over] for v in (todo, x, y, rx, ry))
            # Of two equal tokens the left one was made first, so the right one is undone first, and at
            # that time a merge of the same rank could no longer cross the border from the right.
            first = rx > ry
            limit[todo] = np.where(first, rx, ry + 1)
            a[todo] = np.where(first, self.right[x], x)
            b[todo] = np.where(first, y, self.left[y])
        return ok

    def guess(self, data: bytes) -> list[int]:
        """The longest token of the vocabulary, again and again."""
        found = self.ids.get(data)
        if found is not None:
            return [found]
        out, at, end, get, longest = [], 0, len(data), self.ids.get, self.longest
        while at < end:
            stop = min(end, at + longest)
            while (i := get(data[at:stop])) is None:
                stop -= 1
            out.append(i)
            at = stop
        return out

    def exact(self, data: bytes) -> list[int]:
        """Merging by rank, leftmost first, with a heap: also for words of many thousand bytes."""
        ids = [self.byte_ids[x] for x in data]
        n = len(ids)
        after, back, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        table = self.table()
        heap = [(*table[p], k, *p) for k in range(n - 1) if (p := (ids[k], ids[k + 1])) in table]
        heapq.heapify(heap)
        while heap:
            _, made, k, x, y = heapq.heappop(heap)
            nxt = after[k]
            if not alive[k] or nxt >= n or ids[k] != x or ids[nxt] != y:
                continue
            ids[k], alive[nxt] = made, False
            after[k] = after[nxt]
            if after[k] < n:
                back[after[k]] = k
            for left in (back[k], k):
                if left >= 0 and after[left] < n and (p := (ids[left], ids[after[left]])) in table:
                    heapq.heappush(heap, (*table[p], left, *p))
        return [i for i, on in zip(ids, alive) if on]

    def table(self) -> dict[tuple[int, int], tuple[int, int]]:
        """Pair of ids: its rank and the id it makes."""
        if not hasattr(self, "_table"):
            self._table = {(a, b): (r, c) for r, (a, b, c) in enumerate(self.merges.tolist())}
        return self._table

    def learn(self, words: list[str]) -> None:
        """Encode words that aren't known yet: guess all, test all borders at once, repair the few."""
        guesses = [self.guess(w.encode("utf-8", "surrogatepass")) for w in words]
        sizes = np.fromiter(map(len, guesses), dtype=np.int64, count=len(guesses))
        flat = np.fromiter((i for g in guesses for i in g), dtype=np.int64, count=int(sizes.sum()))
        owner = np.repeat(np.arange(len(words)), sizes)
        inner = np.flatnonzero(owner[:-1] == owner[1:]) if len(flat) else np.empty(0, dtype=np.int64)
        wrong = np.unique(owner[inner[~self.apart(flat[inner], flat[inner + 1])]]) if len(inner) else []
        for k in wrong:
            guesses[k] = self.exact(words[k].encode("utf-8", "surrogatepass"))
        self.guessed += len(words)
        self.repaired += len(wrong)
        if len(self.known) + len(words) > MOST_WORDS:
            self.known.clear()
        self.known.update(zip(words, guesses))

    def encode_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        split = [self.split(t) if t else [] for t in texts]
        new = {w for words in split for w in words if w not in self.known}
        if new:
            fresh = list(new)
            if len(self.known) + len(fresh) > MOST_WORDS:
                fresh = list({w for words in split for w in words})
            self.learn(fresh)
        get = self.known.__getitem__
        return [np.fromiter((i for w in words for i in get(w)), dtype=np.int32) for words in split]


_encoders: dict[str, Encoder] = {}


def encode(documents: DataFrame, tokenizer: str = "byte_bpe_50k", folder: str = DEFAULT_FOLDER, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id_column, ids array<int>: the token ids of each text, without special tokens.

    A null and an empty text give an empty list; strings that spell a special token are ordinary text;
    repeated rows count each; no other column of ``documents`` is read. There is no shuffle: each text
    is encoded where it is read, and the vocabulary (at most MOST_BYTES) goes to the workers once.
    """
    spark: SparkSession = documents.sparkSession
    path = os.path.join(folder, f"{tokenizer}.json")
    tables = spark.sparkContext.broadcast(load_tables(path))

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = _encoders.get(path)
        if encoder is None:
            encoder = _encoders[path] = Encoder(**tables.value)
        for texts in batches:
            yield pd.Series(encoder.encode_batch(texts.tolist()), index=texts.index, dtype=object)

    return documents.select(F.col(id_column), ids(F.col(text_column)).alias("ids"))
