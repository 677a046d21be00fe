"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing.

The largest inner product becomes the smallest distance by one more dimension: rows are divided
by the largest norm of their range and filled up to norm 1, queries are normed. A range holds the rows
of a chunk whose norms lie within a factor of ``RANGE``, so long vectors do not move the short ones
away from the queries; a row's range is part of its bucket's key. Each of ``TABLES`` tables
hashes a vector to ``HASHES`` numbers floor((a.x + b) / WIDTH) with Gaussian a. For a query,
a table's perturbed buckets (each number kept or moved by one) are ordered by their
estimated success, the sum of the squared distances to the borders crossed, and
visited in steps (``STEPS``). After a step the k-th best score so far gives the distance at which a row of a range
would still count; as its differences in the hashes are normal with that deviation, the chance that all
tables have missed such a row is known, and a range is done once it is below ``MISS``, or no row of it can
be near enough. A query that has met fewer than k other ids in the end is compared with
all rows of the chunk. The candidates of all tables are merged and
reranked by the exact inner product of the original vectors in double precision.

Spark deals the index rows into chunks of about ``CHUNK`` rows by a hash of the row, so equal or
frequent vectors spread evenly; a chunk's task hashes its rows into the tables (all rows are
indexed, the functions are drawn from a seed, nothing is fitted to a sample). Queries
are sent to every chunk, in blocks of at most ``QUERY_BLOCK`` to a task. A chunk
gives its nearest ``k`` for a query; a last aggregation keeps the nearest of all.

Vectors that spread evenly over the sphere have neighbours hardly nearer than other rows;
there a query visits most of a chunk. Among clustered vectors it stops after a few buckets.

Defined results: null or zero vectors and vectors with null or non-finite components take no
part; vectors are compared with those of their own length only; a repeated vec_id is one
candidate with its best score and one query (its smallest vector); rows with the
query's id are never its candidates; null vec_ids take no part; ties go to the smaller
vec_id; extra columns pass by unread.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import read_table

TABLES, HASHES, WIDTH = 12, 6, 1.5
STEPS = (4, 12, 36, 108, 324, 729)  # buckets visited in each table; 729 are all
MISS = 0.1
RANGE = 1.2
CHUNK = 16_384
QUERY_BLOCK = 16_384
K = 20
SEED = 17
# The normal distribution function on a grid.
_GRID = np.linspace(-6, 6, 2401)
_NORMAL = np.array([0.5 * math.erfc(-z / math.sqrt(2)) for z in _GRID])


class ProbeTables:
    """Hash tables over unit vectors."""

    def __init__(self, dimension: int, tables: int = TABLES, hashes: int = HASHES, width: float = WIDTH,
                 miss: float = MISS, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.a = rng.normal(size=(tables, hashes, dimension))
        self.b = rng.uniform(0, width, (tables, hashes))
        self.width, self.allowed = width, miss
        # All ways to keep or move each number by one.
        self.moves = np.array(list(itertools.product((0, -1, 1), repeat=hashes)))
        self.radix = 64 ** np.arange(hashes, dtype=np.int64)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Rows x tables x hashes, in bucket widths."""
        return (np.einsum("nd,thd->nth", x, self.a, optimize=False) + self.b) / self.width

    def codes(self, whole: np.ndarray) -> np.ndarray:
        return ((whole.astype(np.int64) & 63) * self.radix).sum(axis=-1)

    def fill(self, x: np.ndarray, part: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Index of the rows of ``x`` in ranges ``part``: per table its buckets and each row's bucket."""
        codes = self.codes(np.floor(self.project(x))) + self.shift(part)[:, None]
        return [np.unique(codes[:, t], return_inverse=True) for t in range(codes.shape[1])]

    def shift(self, part: np.ndarray) -> np.ndarray:
        """What the buckets of a range have added to their codes."""
        return part.astype(np.int64) * 64 * self.radix[-1]

    def probes(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each query and table: the codes of all moves in order of estimated success, that order, and the
        places in the home bucket."""
        f = self.project(q)
        home = np.floor(f)
        down = f - home
        cost = np.stack([np.zeros_like(down), down * down, (1 - down) ** 2], axis=-1)  # keep, -1, +1
        which = np.where(self.moves == 0, 0, np.where(self.moves < 0, 1, 2))
        total = np.zeros((*down.shape[:2], len(self.moves)))
        for h in range(which.shape[1]):
            total += cost[:, :, h, :][:, :, which[:, h]]
        order = np.argsort(total, axis=-1, kind="stable")
        return self.codes(home[:, :, None, :] + self.moves[order]), order, down

    def missed(self, down: np.ndarray, order: np.ndarray, visited: int, distance: float) -> float:
        """The chance that a row at a distance from the query is in none of the first ``visited`` buckets of any table."""
        edges = (np.arange(-1, 3) - down[..., None]) * (self.width / max(distance, 1e-9))
        mass = np.diff(np.interp(edges, _GRID, _NORMAL), axis=-1)  # of the moves -1, 0, 1 in each hash
        seen = np.ones((len(down), visited))
        for h in range(down.shape[1]):
            seen *= np.take_along_axis(mass[:, h], self.moves[order[:, :visited], h] + 1, axis=1)
        return float(np.prod(np.maximum(0, 1 - seen.sum(axis=1))))

    def candidates(self, filled: list[tuple[np.ndarray, np.ndarray]], parts: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Which rows of an index are in a probed bucket (tables x probes) of any table, in any of the ranges."""
        met = np.zeros(len(filled[0][1]), bool)
        for t, (known, place) in enumerate(filled):
            asked = (self.shift(parts)[:, None] + codes[t]).ravel()
            at = np.searchsorted(known, asked)
            at[at == len(known)] = 0
            hit = np.zeros(len(known), bool)
            hit[at[known[at] == asked]] = True
            met |= hit[place]
        return met


def _norms(x: np.ndarray) -> np.ndarray:
    """Also of vectors whose squares are out of range."""
    most = np.abs(x).max(axis=1)
    y = x / most[:, None]
    return most * np.sqrt((y * y).sum(axis=1))


def _to_index(x: np.ndarray, norm: np.ndarray) -> np.ndarray:
    y = x / norm[:, None]
    return np.concatenate([y, np.sqrt(np.maximum(0, 1 - (y * y).sum(axis=1)))[:, None]], axis=1)


def _to_query(x: np.ndarray) -> np.ndarray:
    y = x / _norms(x)[:, None]
    return np.concatenate([y, np.zeros((len(x), 1))], axis=1)


class Chunk:
    """The index of one chunk."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, **tables):
        self.ids, self.x = ids, x
        self.unique = len(np.unique(ids)) == len(ids)
        self.tables = ProbeTables(x.shape[1] + 1, **tables)
        norms = _norms(x)
        logs = np.log(norms)
        part = np.floor((logs.max() - logs) / np.log(RANGE) + 1e-9).astype(np.int64)
        self.parts, place = np.unique(part, return_inverse=True)
        longest = np.zeros(len(self.parts))
        np.maximum.at(longest, place, norms)
        self.filled = self.tables.fill(_to_index(x, longest[place]), part)
        # In single precision, with the longest row at norm 1.
        self.near, self.longest = (x / norms.max()).astype(np.float32), longest / norms.max()

    def _rough(self, rows: np.ndarray, unit: np.ndarray) -> np.ndarray:
        return np.einsum("nd,d->n", self.near[rows], unit, optimize=False)

    def _kth(self, rows: np.ndarray, rough: np.ndarray, k: int) -> float | None:
        """The k-th best score of different ids."""
        if not self.unique:
            ids, at = np.unique(self.ids[rows], return_inverse=True)
            best = np.full(len(ids), -np.inf, rough.dtype)
            np.maximum.at(best, at, rough)
            rough = best
        return None if len(rough) < k else float(np.partition(rough, len(rough) - k)[len(rough) - k])

    def _candidates(self, probes: tuple, qi: int, unit: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows met by a query of direction ``unit``, of k other ids at least where the chunk has as many, and their
        scores in single precision."""
        codes, order, down = probes
        left, met, before = np.arange(len(self.parts)), np.zeros(len(self.ids), bool), 0
        rows, rough = np.zeros(0, np.int64), np.zeros(0, np.float32)
        for visited in [n for n in STEPS if n < codes.shape[1]] + [codes.shape[1]]:
            found = self.tables.candidates(self.filled, self.parts[left], codes[:, before:visited])
            new = np.flatnonzero(found & ~met & (self.ids != qi))
            met |= found
            before = visited
            rows, rough = np.concatenate([rows, new]), np.concatenate([rough, self._rough(new, unit)])
            kth = self._kth(rows, rough, k)
            if kth is not None:
                square = 2 - 2 * kth / self.longest[left]
                left = np.array([p for p, d in zip(left.tolist(), square.tolist()) if d > 0 and
                                 self.tables.missed(down, order, visited, math.sqrt(d)) > self.tables.allowed], np.int64)
                if not len(left):
                    return rows, rough
        if kth is None:
            rows = np.flatnonzero(self.ids != qi)
            rough = self._rough(rows, unit)
        return rows, rough

    def search(self, q_ids: np.ndarray, q: np.ndarray, k: int) -> list[tuple]:
        """(query_id, vec_id, score) of each query's k nearest candidates here."""
        out = []
        for lo in range(0, len(q), 128):
            units = _to_query(q[lo:lo + 128])
            probes = self.tables.probes(units)
            for i in range(len(units)):
                qi, v = q_ids[lo + i], q[lo + i]
                rows, rough = self._candidates(tuple(p[i] for p in probes), qi, units[i, :-1].astype(np.float32), k)
                kth = self._kth(rows, rough, k)
                if kth is not None:  # single precision first, with a margin above its error; exact scores decide
                    rows = rows[rough >= kth - 1e-6 * len(v)]
                score = (self.x[rows] * v).sum(axis=1)
                best = np.lexsort((self.ids[rows], -score))
                if not self.unique:  # the best row of an id
                    best = best[np.sort(np.unique(self.ids[rows][best], return_index=True)[1])]
                best = best[:k]
                out.append((np.full(len(best), qi), self.ids[rows][best], score[best]))
        return out


def valid_vectors(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, v, dim): rows that take part, with doubles."""
    v = F.col(vector).cast("array<double>")
    ok = v.isNotNull() & (F.size(v) > 0) & F.forall(
        v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(v, lambda c: c != 0)
    return (df.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), ok.alias("ok"))
            .where("ok AND vec_id IS NOT NULL").select("vec_id", "v", F.size("v").alias("dim")))


def nearest(index: DataFrame, queries: DataFrame, k: int = K, chunk: int = CHUNK, query_block: int = QUERY_BLOCK,
            **tables) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found of each row of ``queries`` among ``index``.

    Both are (vec_id, v, dim) as ``valid_vectors`` gives them."""
    rows = materialize(index, "vectors")
    asked = queries.groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))
    n_rows = rows.count()
    n_queries = asked.count()
    empty = rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not n_rows or not n_queries:
        return empty
    chunks, blocks = -(-n_rows // chunk), -(-n_queries // query_block)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    stored = (rows.withColumn("chunk", F.pmod(F.xxhash64("vec_id", "v"), F.lit(chunks)).cast("int"))
              .withColumn("block", every(blocks)).withColumn("asks", F.lit(False)))
    asking = (asked.withColumn("chunk", every(chunks))
              .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
              .withColumn("asks", F.lit(True)))
    columns = ["dim", "chunk", "block", "asks", "vec_id", "v"]
    # One task for each pair of chunk and block; the index rows of a pair come before its queries.
    dealt = (stored.select(*columns).unionByName(asking.select(*columns))
             .repartition(chunks * blocks, "dim", "chunk", "block")
             .sortWithinPartitions("dim", "chunk", "block", "asks"))

    def run(batches):
        key, held, index = None, [], None
        for b in batches:
            keys = np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)], axis=1)
            cuts = np.r_[0, np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, len(keys)]
            found = []
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if lo == hi:
                    continue
                dim, *where, asks = keys[lo].tolist()
                if (dim, *where) != key:
                    key, held, index = (dim, *where), [], None
                part = b.slice(lo, hi - lo)
                ids = part.column(4).to_numpy(zero_copy_only=False)
                x = part.column(5).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                if not asks:
                    held.append((ids, x.copy()))
                    continue
                if held:
                    index = Chunk(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]),
                                  **tables)
                    held = []
                if index is not None:
                    found += index.search(ids, x, k)
            q, v, s = (np.concatenate([f[j] for f in found]) if found else np.zeros(0) for j in range(3))
            yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int64)), pa.array(v.astype(np.int64)),
                                              pa.array(s.astype(float))], names=["query_id", "vec_id", "score"])

    found = dealt.mapInArrow(run, "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = valid_vectors(read_table(spark, sf_dir, "embeddings"))
    return nearest(vectors, vectors.where("vec_id % 20 = 0"))
