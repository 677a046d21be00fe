"""Sequence packing by cutting-stock column generation.

1. Tokens: one pass over the texts. A document is cut into pieces of the full
   sequence length and one remainder, so no shorter piece is cut twice. A
   piece carries its size class: its length rounded up to ``grain`` tokens.
2. Plan: the histogram of pieces by class (at most capacity / grain rows,
   whatever the corpus) goes to the driver. A linear program over patterns
   (how many pieces of each class share a sequence) is solved there by column
   generation: the simplex basis prices the classes, a knapsack dynamic
   program finds the pattern worth most, until none is worth more than a
   sequence. Patterns are used their rounded-down number of times; what is
   left (fewer than one use of each pattern) is packed first-fit.
3. Assignment: pieces are ranked within their class on the executors (rank in
   the task plus a running count over tasks, so a class that holds a third of
   all pieces is still ranked by many tasks), and the plan maps ranges of ranks to
   sequences. Offsets are running sums within a sequence.

The plan has a bounded number of ranges (classes x patterns), so it travels
with the task closure. Defined results: null and empty texts are the end id
alone; rows with repeated or null doc_id are documents of their own; ties in
rank follow the input order of the written piece table; an empty table packs into no sequence;
extra columns pass by unread.
"""

from __future__ import annotations

import json
import os
import re
import sys
import unicodedata
import zlib
from array import array
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import read_table, text_slices, texts_of

CAPACITY = 2048
GRAIN = 8
END_ID = 1
# Distinct pre-tokens remembered by a task before its memo starts anew.
MEMO = 1_000_000
# Column generation ends within this share of the program's optimum.
GAP = 2e-3
# Rounds of column generation; the plan is whole after any number of them.
MAX_ROUNDS = 6000


class WordEncoder:
    """Ids of texts by a BPE tokenizer whose pre-tokens are encoded alone.

    Pre-tokens never merge with each other, so the ids of a text are those of its
    pre-tokens in order, and each distinct one is encoded once while it stays in the
    bounded memo. Texts with characters outside the plain Latin range (where
    Unicode tables may differ) or with special strings go to the library whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        spec = json.loads(self.tok.to_str())
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or spec["model"]["type"] != "BPE":
            raise ValueError("the pre-token memo does not hold for this tokenizer")
        # Unicode classes of the pattern, spelt out over the plain range.
        for name, first in (("L", "L"), ("N", "N")):
            members = [chr(c) for c in range(0x250) if unicodedata.category(chr(c))[0] == first]
            pattern = pattern.replace(f"\\p{{{name}}}", "".join(members))
        self.split = re.compile(pattern).findall
        special = [t["content"] for t in spec["added_tokens"]]
        self.whole = re.compile("|".join(["[^\t-\r -~\xa0-ɏ–-…€]", *map(re.escape, special)]))
        self.memo: dict[str, bytes] = {}
        # The byte-level alphabet: printable Latin-1 stands for itself, other bytes for 256 and up in order.
        self.model, self.bytes = self.tok.model, {}
        for c in range(256):
            if not (33 <= c <= 126 or 161 <= c <= 172 or c >= 174):
                self.bytes[c] = 256 + len(self.bytes)

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        words, plain = [], []
        for t in texts:
            if self.whole.search(t):
                words.append(None)
            else:
                words.append(self.split(unicodedata.normalize("NFC", t).lower()))
                plain.append(words[-1])
        new = set().union(*plain).difference(self.memo)
        if len(self.memo) + len(new) > MEMO:
            self.memo = {}
            new = set().union(*plain)
        if new:
            self._learn(list(new))
        get = self.memo.__getitem__
        return [b"".join(map(get, w)) if w is not None else _pack(self.tok.encode(t, add_special_tokens=False).ids)
                for w, t in zip(words, texts)]


    def _learn(self, new: list[str]) -> None:
        """Merge pre-tokens by the tokenizer's own model."""
        merge, memo, table = self.model.tokenize, self.memo, self.bytes
        for w in new:
            letters = w if w.isascii() else w.encode().decode("latin-1").translate(table)
            memo[w] = _pack([t.id for t in merge(letters)])


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    """One encoder per Python worker, so that its memo outlives a task."""
    return WordEncoder(path)


def _pack(ids: list[int]) -> bytes:
    a = array("I", ids)
    if sys.byteorder == "big":
        a.byteswap()
    return a.tobytes()


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, grain: int = GRAIN,
               end_id: int = END_ID) -> DataFrame:
    """Pieces of every row: doc_id, row (of the task), start, length, ids_crc32,
    doc_tokens, class, task, nth (of its class in its task, from 0)."""
    end = _pack([end_id])

    def run(batches):
        encoder, seen, row = _encoder(tokenizer), Counter(), 0
        task = TaskContext.get().partitionId()
        for part, data, offs in text_slices(batches, "text"):
            out = []
            for doc, ids in zip(part.column(0).to_pylist(), encoder.ids(texts_of(data, offs))):
                ids += end
                n = len(ids) // 4
                for start in range(0, n, capacity):
                    size = min(capacity, n - start)
                    cls = -(-size // grain)
                    out.append((doc, row, start, size, zlib.crc32(ids[4 * start:4 * (start + size)]), n,
                                cls, task, seen[cls]))
                    seen[cls] += 1
                row += 1
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    names = ["doc_id", "row", "start", "length", "ids_crc32", "doc_tokens", "class", "task", "nth"]
    types = [pa.int64()] * 6 + [pa.int32()] * 2 + [pa.int64()]
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, row long, start long, length long, ids_crc32 long, doc_tokens long, "
                             "class int, task int, nth long"))


def price_pattern(worth: np.ndarray, sizes: np.ndarray, most: np.ndarray, capacity: int) -> tuple[float, dict[int, int]]:
    """The pattern of greatest worth within ``capacity`` (unbounded knapsack):
    its worth and {index: pieces}."""
    best = np.zeros(capacity + 1)
    pick = np.full(capacity + 1, -1)
    live = np.flatnonzero(worth > 1e-9)
    order = live[np.argsort(sizes[live], kind="stable")]
    size, value = sizes[order], worth[order]
    upto = np.searchsorted(size, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        k = upto[c]
        best[c] = best[c - 1]
        if k:
            v = best[c - size[:k]] + value[:k]
            i = int(v.argmax())
            if v[i] > best[c] + 1e-12:
                best[c], pick[c] = v[i], order[i]
    out: dict[int, int] = {}
    c = capacity
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            out[int(pick[c])] = out.get(int(pick[c]), 0) + 1
            c -= int(sizes[pick[c]])
    return float(best[capacity]), out


def solve_patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int,
                   max_rounds: int = MAX_ROUNDS) -> list[tuple[dict[int, int], float]]:
    """Column generation for the cutting-stock program: minimise the number of sequences
    so that pattern uses cover ``demand``. Returns the basic patterns and their uses.

    Revised simplex with an explicit inverse basis; the first basis repeats one class per
    pattern. The optimum is at least the present number of sequences divided by the
    worth of the best pattern at the basis' prices, so a worth of at most 1 + GAP ends it."""
    m = len(sizes)
    fit = capacity // sizes
    patterns = [{i: int(fit[i])} for i in range(m)]
    inverse = np.diag(1.0 / fit)
    uses = demand / fit
    for _ in range(max_rounds):
        worth = inverse.sum(axis=0)
        value, column = price_pattern(worth, sizes, demand, capacity)
        if value <= 1 + GAP:
            break
        step = (inverse[:, list(column)] * list(column.values())).sum(axis=1)
        up = step > 1e-9
        if not up.any():
            break
        ratio = np.full(m, np.inf)
        ratio[up] = uses[up] / step[up]
        out = int(ratio.argmin())
        by = ratio[out]
        uses = np.maximum(uses - by * step, 0)
        uses[out] = by
        inverse[out] /= step[out]
        rest = step.copy()
        rest[out] = 0
        touched = np.flatnonzero(np.abs(rest) > 1e-13)
        inverse[touched] -= np.outer(rest[touched], inverse[out])
        patterns[out] = column
    return list(zip(patterns, uses.tolist()))


class Plan:
    """Ranges of class ranks mapped to sequences, as sorted arrays.

    A range holds pieces ``lo``.. of a class; ``each`` of them share a sequence, in
    sequences ``base``, ``base + 1``, ...; ``slot`` orders classes in a sequence."""

    SPAN = 1 << 44

    def __init__(self, histogram: dict[int, int], capacity: int):
        classes = sorted(histogram)
        sizes = np.array(classes, np.int64)
        demand = np.array([histogram[c] for c in classes], np.int64)
        left = demand.copy()
        used: list[tuple[dict[int, int], int]] = []
        if classes:
            found = solve_patterns(sizes, demand.astype(float), capacity)
            for pattern, uses in sorted(found, key=lambda p: -p[1]):
                n = int(uses + 1e-7)
                n = min([n, *(int(left[i]) // k for i, k in pattern.items())])
                if n:
                    used.append((pattern, n))
                    for i, k in pattern.items():
                        left[i] -= n * k
        used += self._rest(sizes, left, capacity)
        keys, bases, each, slots, at, base = [], [], [], [], Counter(), 0
        for pattern, n in used:
            for slot, i in enumerate(sorted(pattern, reverse=True)):
                keys.append(int(sizes[i]) * self.SPAN + at[i])
                bases.append(base)
                each.append(pattern[i])
                slots.append(slot)
                at[i] += n * pattern[i]
            base += n
        order = np.argsort(np.array(keys, np.int64))
        self.keys, self.bases, self.each, self.slots = (np.array(x, np.int64)[order] for x in (keys, bases, each, slots))
        self.sequences = base

    @staticmethod
    def _rest(sizes, left, capacity):
        """First-fit of the pieces that rounding left, largest first, by the
        multiplicity of each class: equal sequences are made together."""
        out = []
        left = left.copy()
        while left.any():
            room, pattern = capacity, {}
            for i in range(len(sizes) - 1, -1, -1):
                if left[i] and (k := min(int(left[i]), int(room // sizes[i]))):
                    pattern[i] = k
                    room -= k * int(sizes[i])
            n = min(int(left[i]) // k for i, k in pattern.items())
            out.append((pattern, n))
            for i, k in pattern.items():
                left[i] -= n * k
        return out

    def place(self, cls: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sequence, slot and place in the slot of pieces given by class and rank."""
        key = cls.astype(np.int64) * self.SPAN + rank
        r = np.searchsorted(self.keys, key, side="right") - 1
        n = key - self.keys[r]
        return self.bases[r] + n // self.each[r], self.slots[r], n % self.each[r]


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, grain: int = GRAIN,
         end_id: int = END_ID) -> DataFrame:
    """Pieces with their place: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset."""
    if capacity % grain:
        raise ValueError("the capacity must be a multiple of the grain")
    pieces = materialize(cut_pieces(docs, tokenizer, capacity, grain, end_id), "pieces")
    by_task = pieces.groupBy("class", "task").agg(F.count("*").alias("n"))
    histogram = {r["class"]: r["n"] for r in by_task.groupBy("class").agg(F.sum("n").alias("n")).collect()}
    plan = Plan(histogram, capacity // grain)
    before = Window.partitionBy("class").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = by_task.select("class", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = (pieces.join(base, ["class", "task"])
              .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "class",
                      (F.col("base") + F.col("nth")).alias("rank")))

    def run(batches):
        for b in batches:
            cls, rank = (b.column(i).to_numpy(zero_copy_only=False) for i in (5, 6))
            placed = plan.place(cls, rank)
            yield pa.RecordBatch.from_arrays([*b.columns[:5], *(pa.array(x, pa.int64()) for x in placed)], names=names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "slot", "nth"]
    placed = ranked.mapInArrow(run, ", ".join(f"{n} long" for n in names))
    earlier = Window.partitionBy("sequence_id").orderBy("slot", "nth").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                         F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("offset"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
