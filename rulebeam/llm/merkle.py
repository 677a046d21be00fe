"""Merkle manifest of a dataset, with a proof for every row.

Each row is a leaf. The leaves of a group, in order of their keys, are the leaves of one binary tree; the roots
of the groups, in order of the groups, are the leaves of the top tree. Two neighbours become
the hash of their digests as hex text; a last node without a neighbour becomes the hash of its own.

Proofs grow while the leaves are appended (``Frontier``): every open subtree carries the partial witnesses of its
leaves, and a sibling that is completed later extends all of them at once.
Leaves are cut into aligned blocks of ``2^BLOCK_BITS``; a task appends its blocks one after the other and holds the
open subtrees of one block only. The roots of the blocks are appended in
the same way, block by block, until each group has one node, so a group of any size is
spread over the cluster: ``log(rows) / BLOCK_BITS`` steps. A leaf's proof is its witness in its block, followed
by that of its block among the blocks, and so on, ending with that of its group.

Hashes of leaves and the folding of proofs are DataFrame functions; only the appending of digests is Python.

Defined results: null fields have a code of their own (``-``); rows of a group are ordered by key
(nulls first) and, where keys are equal, by digest; equal rows are leaves of their own; null groups are one
group, the first; extra columns pass by unread; an empty table gives an empty
table and has no root.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import read_table
from .numbering import number_rows

BLOCK_BITS = 12


def _digest(*parts: bytes) -> bytes:
    return hashlib.sha256(b"".join(p.hex().encode() for p in parts)).digest()


class Frontier:
    """Append-only subtrees with the witnesses of their leaves.

    ``open``: complete subtrees, largest first, as (height, digest, first leaf, end); ``witnesses``: per leaf the
    siblings met so far, empty bytes where there was none."""

    def __init__(self):
        self.open: list[tuple[int, bytes, int, int]] = []
        self.witnesses: list[list[bytes]] = []

    def append(self, digest: bytes) -> None:
        i = len(self.witnesses)
        self.witnesses.append([])
        self._push((0, digest, i, i + 1))

    def _push(self, node) -> None:
        while self.open and self.open[-1][0] == node[0]:
            left = self.open.pop()
            for w in self.witnesses[left[2]:left[3]]:
                w.append(node[1])
            for w in self.witnesses[node[2]:node[3]]:
                w.append(left[1])
            node = (node[0] + 1, _digest(left[1], node[1]), left[2], node[3])
        self.open.append(node)

    def close(self, height: int | None = None) -> bytes:
        """The root: of one node, or of ``height`` where nodes of other blocks follow or precede."""
        while len(self.open) > 1 or (height is not None and self.open[0][0] < height):
            last = self.open.pop()  # no sibling comes any more
            for w in self.witnesses[last[2]:last[3]]:
                w.append(b"")
            self._push((last[0] + 1, _digest(last[1]), last[2], last[3]))
        return self.open[0][1]


def _append_blocks(bits: int):
    """Arrow batches (tree, pos, n, digest, more), sorted by tree and pos, each block whole:
    the same with the path in the block and, at the first leaf of a block, its root."""
    def run(batches):
        frontier, pending, current = Frontier(), [], None

        def finish(n):
            root = frontier.close(bits if n > 1 << bits else None)
            table = pa.Table.from_batches(pending).combine_chunks()
            paths = pa.array(frontier.witnesses, pa.list_(pa.binary()))
            roots = pa.array([root] + [None] * (len(table) - 1), pa.binary())
            yield from table.append_column("path", paths).append_column("root", roots).to_batches()

        for batch in batches:
            trees, places = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            sizes, digests = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            lo = 0
            for i, block in enumerate(zip(trees, (p >> bits for p in places))):
                if current is not None and block != current[0]:
                    if i > lo:
                        pending.append(batch.slice(lo, i - lo))
                    yield from finish(current[1])
                    frontier, pending, lo = Frontier(), [], i
                current = block, sizes[i]
                frontier.append(digests[i])
            if batch.num_rows > lo:
                pending.append(batch.slice(lo))
        if current is not None:
            yield from finish(current[1])

    return run


def _climb(nodes: DataFrame, bits: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """``nodes`` (tree, pos, n, digest, more) as steps with paths, and (tree, digest) of the roots."""
    steps = []
    while True:
        keyed = (nodes.withColumn("block", F.shiftright("pos", bits)).repartition("tree", "block")
                 .sortWithinPartitions("tree", "pos").drop("block"))
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema.fields)
        built = materialize(keyed.mapInArrow(_append_blocks(bits), f"{fields}, path array<binary>, root binary"), name)
        steps.append(built)
        size = 1 << bits
        nodes = (built.where("root IS NOT NULL")
                 .select("tree", F.shiftright("pos", bits).alias("pos"),
                         F.shiftright(F.col("n") + (size - 1), bits).alias("n"), F.col("root").alias("digest")))
        if (nodes.agg(F.max("n")).first()[0] or 0) <= 1:
            return steps, nodes.select("tree", "digest")


def _full_paths(steps: list[DataFrame], last: DataFrame, bits: int) -> DataFrame:
    """The first step's rows with whole paths and the columns of ``last`` (one row per tree)."""
    more = [c for c in last.columns if c != "tree"]
    # From the top: the paths of blocks, each after the one below it.
    above = last.withColumn("pos", F.lit(0).cast("long")).withColumn("above", F.array().cast("array<binary>"))
    for i, built in enumerate(reversed(steps)):
        upper = above.select("tree", F.col("pos").alias("block"), "above", *more)
        joined = (built.drop("root").withColumn("block", F.shiftright("pos", bits))
                  .join(upper, ["tree", "block"]).drop("block"))
        path = F.concat("path", "above")
        if i == len(steps) - 1:
            return joined.withColumn("path", path).drop("above")
        above = joined.select("tree", "pos", path.alias("above"), *more)
    raise ValueError("no steps")


def sided(path: str, pos: str) -> Column:
    """A path as array of (side, digest): the sibling stands left or right, or there is none ('')."""
    return F.expr(f"""transform({path}, (d, l) -> named_struct(
        'side', CASE WHEN length(d) = 0 THEN '' WHEN shiftright({pos}, l) & 1 = 1 THEN 'L' ELSE 'R' END,
        'digest', lower(hex(d))))""")


def fold(leaf: str, path: str) -> Column:
    """The root that a leaf's digest and its path lead to."""
    return F.expr(f"""aggregate({path}, {leaf}, (acc, s) -> sha2(
        CASE s.side WHEN 'L' THEN concat(s.digest, acc) WHEN 'R' THEN concat(acc, s.digest) ELSE acc END, 256))""")


def leaf_digest(columns: list[Column]) -> Column:
    """Hash of a row: per field ``-`` if null, else its length in UTF-8 bytes, ``:`` and the value."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t))
                             for t in texts]), 256)


def manifest(rows: DataFrame, leaf: Column, key: Column, group: Column, carry: dict[str, Column] | None = None,
             block_bits: int = BLOCK_BITS, scratch: str = "manifest") -> DataFrame:
    """Per row: leaf, subroot (of its group), root, path (array of (side, digest) from the
    leaf to the root), and the columns of ``carry``."""
    carry = carry or {}
    names = {f"c{i}": name for i, name in enumerate(carry)}
    text = group.cast("string")
    leaves = rows.select(F.unhex(leaf).alias("digest"), key.alias("key"),
                         F.coalesce(F.concat(F.lit("="), text), F.lit("")).alias("tree"),
                         *[c.alias(f"c{i}") for i, c in enumerate(carry.values())])
    placed = number_rows(leaves, "tree", ["key", "digest"], scratch).select("tree", "pos", "n", "digest", *names)
    steps, roots = _climb(placed, block_bits, f"{scratch}-steps")
    # The top tree has one tree of its own: the groups in order of their names.
    tops = number_rows(roots.select(F.lit("").alias("top"), F.col("tree").alias("name"), "digest"), "top", ["name"],
                       f"{scratch}-top").select(F.col("top").alias("tree"), "pos", "n", "digest", "name")
    top_steps, top_root = _climb(tops, block_bits, f"{scratch}-top-steps")
    top = _full_paths(top_steps, top_root.withColumnRenamed("digest", "root"), block_bits)
    last = top.select(F.col("name").alias("tree"), F.lower(F.hex("digest")).alias("subroot"),
                      F.lower(F.hex("root")).alias("root"), sided("path", "pos").alias("top_path"))
    full = _full_paths(steps, last, block_bits)
    return full.select(F.lower(F.hex("digest")).alias("leaf"), "subroot", "root",
                       F.concat(sided("path", "pos"), "top_path").alias("path"),
                       *[F.col(c).alias(name) for c, name in names.items()])


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every row of ``documents``, and the check of a copy tampered with."""
    docs = read_table(spark, sf_dir, "documents")
    doc_id = F.col("doc_id").cast("long")
    leaf = leaf_digest([F.col(c) for c in FIELDS])
    longer = F.col("n_chars").cast("decimal(20,0)") + 1
    tampered = F.crc32(doc_id.cast("string").cast("binary")) % 7 == 0
    changed = F.when(tampered, F.unhex(leaf_digest([longer if c == "n_chars" else F.col(c) for c in FIELDS])))
    made = manifest(docs, leaf, doc_id, F.col("lang"), {"doc_id": doc_id, "changed": changed}, scratch="merkle")
    made = made.withColumn("from", F.coalesce(F.lower(F.hex("changed")), "leaf"))
    siblings = F.array_join(F.transform("path", lambda s: F.when(s["side"] != "", s["digest"]).otherwise("")), "")
    return made.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"),
                       fold("`from`", "path").alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


# crc32 of a text of ASCII signs, bit by bit.
CRC32 = """(xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda c: unicode(c)::BIGINT)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                               lambda x, i: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT))"""


def op12_sql() -> str:
    """The trees level by level, the proofs by joins with the levels."""
    def leaf(n_chars: str) -> str:
        fields = [n_chars if f == "n_chars" else f for f in FIELDS]
        return "sha256(" + " || ".join(f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')"
                                       for f in fields) + ")"
    return f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '') AS tree, {leaf('n_chars')} AS leaf,
         CASE WHEN {CRC32.format('CAST(doc_id AS VARCHAR)')} % 7 = 0 THEN {leaf('(n_chars + 1)')} END AS changed
  FROM documents),
p AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY tree) AS n FROM d),
lv AS (
  SELECT tree, 0 AS h, pos, n, leaf AS digest FROM p
  UNION ALL
  SELECT tree, any_value(h) + 1, pos // 2, any_value((n + 1) // 2), sha256(string_agg(digest, '' ORDER BY pos))
  FROM lv WHERE n > 1 GROUP BY tree, pos // 2),
subs AS (SELECT tree, digest AS subroot, h AS height, row_number() OVER (ORDER BY tree) - 1 AS tpos, count(*) OVER () AS tn
         FROM lv WHERE n = 1),
tops AS (
  SELECT 0 AS h, tpos AS pos, tn AS n, subroot AS digest FROM subs
  UNION ALL
  SELECT any_value(h) + 1, pos // 2, any_value((n + 1) // 2), sha256(string_agg(digest, '' ORDER BY pos))
  FROM tops WHERE n > 1 GROUP BY pos // 2),
walk AS (
  SELECT r, p.tree, p.pos AS at, s.tpos AS top_at, 0 AS h, s.height, coalesce(changed, leaf) AS cur, '' AS proof
  FROM p JOIN subs s USING (tree)
  UNION ALL
  SELECT w.r, w.tree, CASE WHEN w.h < w.height THEN w.at // 2 ELSE w.at END,
         CASE WHEN w.h < w.height THEN w.top_at ELSE w.top_at // 2 END, w.h + 1, w.height,
         sha256(CASE WHEN (CASE WHEN w.h < w.height THEN w.at ELSE w.top_at END) % 2 = 1
                     THEN coalesce(l.digest, t.digest, '') || w.cur ELSE w.cur || coalesce(l.digest, t.digest, '') END),
         w.proof || coalesce(l.digest, t.digest, '')
  FROM walk w
  LEFT JOIN lv l ON w.h < w.height AND l.tree = w.tree AND l.h = w.h AND l.pos = xor(w.at, 1)
  LEFT JOIN tops t ON w.h >= w.height AND t.h = w.h - w.height AND t.pos = xor(w.top_at, 1)
  WHERE w.h < w.height + (SELECT max(h) FROM tops)),
done AS (SELECT r, cur, proof FROM walk WHERE h = height + (SELECT max(h) FROM tops))
SELECT p.doc_id, p.leaf, s.subroot, (SELECT digest FROM tops WHERE n = 1) AS root, sha256(proof) AS proof_sha256,
       cur AS folded_root, cur = (SELECT digest FROM tops WHERE n = 1) AS verified
FROM p JOIN subs s USING (tree) JOIN done USING (r)
"""
