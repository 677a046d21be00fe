"""Shared helpers: table reading, bounded slices of Arrow text batches,
vectorised word splitting and hashing."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Text bytes handled at once inside a task (one longer text is a slice alone).
SLICE_BYTES = 2 << 20

# ASCII A-Z to a-z, every other byte unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_name(name: str, columns: list[str]) -> str:
    """``name``, with underscores before it until no column has that name."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_slices(batches, column: str = "text",
                max_bytes: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut record batches into slices of about ``max_bytes`` text bytes.

    Yields (slice, bytes as uint8, offsets int64 with one entry more than
    rows); null texts are empty."""
    for batch in batches:
        i = batch.schema.get_field_index(column)
        col = batch.column(i).cast(pa.large_string()).fill_null("")
        n = batch.num_rows
        if n == 0:
            continue
        offs = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + n + 1]
        data = col.buffers()[2]
        raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
        lo = 0
        while lo < n:
            hi = int(np.searchsorted(offs, offs[lo] + max_bytes, side="right")) - 1
            hi = min(max(hi, lo + 1), n)
            yield batch.slice(lo, hi - lo), raw[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
            lo = hi


def texts_of(data: np.ndarray, offsets: np.ndarray) -> list[str]:
    b = data.tobytes()
    return [b[s:e].decode("utf-8", "replace") for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


class Words:
    """Words of a slice: maximal runs of bytes in ``table``, never across texts.

    ``starts``/``ends``: byte positions; ``first``: index of each text's first
    word, one entry more than texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        isw = table[data]
        st, en = isw.copy(), isw.copy()
        if len(data):
            st[1:] &= ~isw[:-1]
            en[:-1] &= ~isw[1:]
            at = offsets[:-1][offsets[:-1] < len(data)]
            st[at] |= isw[at]
            till = offsets[1:][offsets[1:] > 0] - 1
            en[till] |= isw[till]
        self.starts = np.flatnonzero(st)
        self.ends = np.flatnonzero(en) + 1
        self.lens = self.ends - self.starts
        self.bytes = data[isw]
        self.first = np.searchsorted(self.starts, offsets)

    @property
    def n(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes (polynomial, then mixed)."""
        if not self.n:
            return np.zeros(0, np.uint64)
        head = np.cumsum(self.lens) - self.lens
        powers = np.full(int(self.lens.max()), _BASE)
        powers[0] = 1
        powers = np.cumprod(powers)
        inside = np.arange(len(self.bytes)) - np.repeat(head, self.lens)
        h = np.add.reduceat((self.bytes.astype(np.uint64) + np.uint64(1)) * powers[inside], head)
        return mix(h + self.lens.astype(np.uint64) * _M1)


def mix(h: np.ndarray) -> np.ndarray:
    """Bit mixer for uint64 arrays (public splitmix64 finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def group_slots(first: np.ndarray, k: int) -> np.ndarray:
    """Starts of all runs of ``k`` consecutive words within one text."""
    n = int(first[-1])
    if n < k:
        return np.zeros(0, np.int64)
    ok = np.ones(n - k + 1, bool)
    for cut in first[1:-1]:
        ok[max(0, cut - k + 1):cut] = False
    return np.flatnonzero(ok)
