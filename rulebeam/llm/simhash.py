"""SimHash near-duplicates: 64-bit fingerprints over word shingles, linked by
BK-trees within a bit distance.

1. Fingerprints: one pass over the texts. Exact copies share a fingerprint,
   so all later work is on distinct fingerprints.
2. Shards: two fingerprints that differ in at most r bits agree in at least
   (blocks - r) of ``blocks`` bit blocks. Each fingerprint goes to one shard per choice of
   that many blocks, keyed by their bits; linked fingerprints meet in a shard.
3. Trees: a shard's BK-tree (children keyed by their distance to the parent)
   answers each member; only edges whose key is within r of the distance are
   followed. Shards of more than ``tree_size`` members are dealt into several trees and
   every member is sent to each of them, so no task holds more than one
   tree at a time and no pair is skipped. Trees reach the queries through the shuffle
   and not by broadcast, because their total size grows with the corpus.
4. A tree reports a spanning forest of the links that it finds, not all pairs.
   Components join these by star rounds on the executors.

Defined results: null and empty texts have no words, fingerprint zero, and are linked
like any other; a text of fewer words than a shingle is one shingle; repeated rows and
repeated doc_ids keep their rows; rows with a null doc_id keep their row and
never name a component (a component of such rows alone has a null id). Extra
columns pass by unread.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import LOWER, Words, read_table, text_slices
from .components import connected_components

SHINGLE = 4
RADIUS = 4
BLOCKS = 6
TREE_SIZE = 2048
SEED = 42

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def fingerprints_of(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """uint64 fingerprint of each text of a slice."""
    import xxhash
    low = LOWER[data]
    words = Words(low, offsets, ~_SPACE)
    out = np.zeros(len(offsets) - 1, np.uint64)
    if not words.n:
        return out
    # The words again with one space between, so that a shingle is a byte range.
    number = np.repeat(np.arange(words.n), words.lens)
    joined = np.full(len(words.bytes) + words.n, 0x20, np.uint8)
    joined[np.arange(len(words.bytes)) + number] = words.bytes
    ends = np.cumsum(words.lens + 1) - 1
    starts = ends - words.lens
    n_words = words.counts()
    n_sh = np.where(n_words >= shingle, n_words - shingle + 1, np.minimum(n_words, 1))
    owner = np.repeat(np.arange(len(n_words)), n_sh)
    begin = np.cumsum(n_sh) - n_sh
    i = np.arange(len(owner)) - begin[owner] + words.first[:-1][owner]
    last = i + np.minimum(n_words[owner], shingle) - 1
    text, digest = joined.tobytes(), xxhash.xxh64_intdigest
    h = np.fromiter((digest(text[s:e], SEED) for s, e in zip(starts[i].tolist(), ends[last].tolist())),
                    np.uint64, len(owner))
    full = np.flatnonzero(n_sh)
    # Votes of a bounded number of shingles at a time.
    votes = np.zeros((len(n_sh), 64), np.int64)
    step = 1 << 17
    for lo in range(0, len(h), step):
        bits = np.unpackbits(h[lo:lo + step].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = owner[lo:lo + step]
        cuts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        votes[own[cuts]] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int32)
    on = votes[full] * 2 > n_sh[full][:, None]
    out[full] = np.packbits(on, axis=1, bitorder="little").view("<u8").ravel()
    return out


def add_fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp) of every row; fp is the fingerprint's 64 bits as a signed long."""

    def run(batches):
        for part, data, offs in text_slices(batches):
            fp = fingerprints_of(data, offs, shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(fp)],
                                             names=["doc_id", "text_hash", "fp"])

    text = F.col("text").cast("string")
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                        text.alias("text"))
            .mapInArrow(run, "doc_id long, text_hash long, fp long"))


class BKTree:
    """Burkhard-Keller tree over distinct integers under the Hamming distance."""

    __slots__ = ("values", "edges")

    def __init__(self):
        self.values: list[int] = []
        self.edges: list[dict[int, int]] = []

    def add(self, x: int) -> int:
        values, edges = self.values, self.edges
        me = len(values)
        values.append(x)
        edges.append({})
        at = 0
        while me:
            d = (values[at] ^ x).bit_count()
            child = edges[at].get(d)
            if child is None:
                edges[at][d] = me
                break
            at = child
        return me

    def within(self, x: int, radius: int) -> list[int]:
        """Positions of the values within ``radius`` of ``x``."""
        if not self.values:
            return []
        values, edges, found, todo = self.values, self.edges, [], [0]
        while todo:
            at = todo.pop()
            d = (values[at] ^ x).bit_count()
            if d <= radius:
                found.append(at)
            e = edges[at]
            if len(e) > 2 * radius + 1:
                todo += [e[k] for k in range(d - radius, d + radius + 1) if k in e]
            else:
                todo += [c for k, c in e.items() if d - radius <= k <= d + radius]
        return found


class _Task:
    """Links of one tree: nodes of its own chunk are added (and, in the chunk's
    own task, asked about first); nodes of another chunk only ask."""

    def __init__(self, radius: int):
        self.tree, self.radius, self.parent, self.links = BKTree(), radius, {}, []

    def root(self, x: int) -> int:
        parent = self.parent
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(p, p)
        return x

    def ask(self, x: int) -> None:
        for at in self.tree.within(x, self.radius):
            y = self.tree.values[at]
            rx, ry = self.root(x), self.root(y)
            if rx != ry:
                self.parent[max(rx, ry)] = min(rx, ry)
                self.links.append((x, y))


def _block_keys(blocks: int, radius: int) -> list[int]:
    """Bit masks, one per choice of blocks that may agree."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    mask = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]
    out = []
    for chosen in combinations(mask, blocks - radius):
        m = 0
        for x in chosen:
            m |= x
        out.append(m if m < 1 << 63 else m - (1 << 64))
    return out


def hamming_links(distinct: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS,
                  tree_size: int = TREE_SIZE) -> DataFrame:
    """(a, b): links that join exactly the components of all pairs of ``distinct``
    values (column fp) at ``radius`` or fewer differing bits."""
    if not 0 <= radius < blocks:
        raise ValueError("more blocks than the radius are needed")
    masks = F.array(*[F.lit(m).cast("long") for m in _block_keys(blocks, radius)])
    keyed = (distinct.select("fp", F.posexplode(masks).alias("choice", "mask"))
             .select("fp", F.col("choice").cast("int").alias("choice"),
                     F.col("fp").bitwiseAND(F.col("mask")).alias("bits")))
    # Shards with one member have no link and go no further.
    sizes = keyed.groupBy("choice", "bits").agg(F.count("*").alias("n")).where("n > 1")
    members = keyed.join(sizes, ["choice", "bits"])
    trees = F.ceil(F.col("n") / F.lit(tree_size)).cast("int")
    # One row for each tree of the shard: the pair of its own chunk and that tree's.
    rows = (members.withColumn("trees", trees)
            .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("trees")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("trees") - 1)))
            .select("choice", "bits", F.least("own", "other").alias("c1"), F.greatest("own", "other").alias("c2"),
                    "own", "fp"))
    key = ["choice", "bits", "c1", "c2"]
    dealt = rows.repartition(*key).sortWithinPartitions(*key, "own", "fp")

    def run(batches):
        now, task = None, None
        for b in batches:
            cols = [b.column(i).to_pylist() for i in range(6)]
            a, z = [], []
            for choice, bits, c1, c2, own, fp in zip(*cols):
                k = (choice, bits, c1, c2)
                if k != now:
                    if task:
                        _flush(task, a, z)
                    now, task = k, _Task(radius)
                x = fp & 0xFFFFFFFFFFFFFFFF
                if own == c1:
                    if c1 == c2:
                        task.ask(x)
                    task.tree.add(x)
                else:
                    task.ask(x)
            if task:
                _flush(task, a, z)
            yield _link_batch(a, z)

    def _flush(task, a, z):
        for x, y in task.links:
            a.append(x)
            z.append(y)
        task.links.clear()

    def _link_batch(a, z):
        to = lambda v: pa.array(np.array(v, np.uint64).view(np.int64))
        return pa.RecordBatch.from_arrays([to(a), to(z)], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, blocks: int = BLOCKS,
                    keep_hash: bool = False) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs``; with ``keep_hash`` also text_hash and
    root, a value per component that is never null."""
    prints = materialize(add_fingerprints(docs, shingle), "fingerprints")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    roots = connected_components(hamming_links(distinct.select("fp"), radius, blocks))
    rooted = (distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
              .withColumn("root", F.coalesce("root", "fp")))
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id", "root")
    more = ["text_hash", "root"] if keep_hash else []
    return prints.join(named, "fp").select("doc_id", "fp", "component_id", *more)


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = near_duplicates(read_table(spark, sf_dir, "documents"))
    return r.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
