"""Merkle manifest against trees built level by level."""
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from rulebeam.llm.merkle import FIELDS, Frontier, fold, leaf_digest, manifest, op12_merkle_manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(leaves):
    out = [list(leaves)]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def steps(tree, at):
    """(side, digest) of each level's sibling."""
    out = []
    for level in tree[:-1]:
        other = at ^ 1
        out.append(("", "") if other >= len(level) else ("L" if at & 1 else "R", level[other]))
        at >>= 1
    return out


def folded(leaf, path):
    for side, digest in path:
        leaf = h(digest, leaf) if side == "L" else h(leaf, digest) if side == "R" else h(leaf)
    return leaf


def code(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def brute(rows):
    """rows of FIELDS to (doc_id, leaf, subroot, root, path), as a sorted list."""
    groups = {}
    for row in rows:
        groups.setdefault("" if row[2] is None else "=" + row[2], []).append(row)
    names = sorted(groups, key=lambda n: n.encode())
    trees, members = {}, {}
    for n in names:
        members[n] = sorted(groups[n], key=lambda r: (r[0] is not None, r[0] or 0, code(r)))
        trees[n] = levels([code(r) for r in members[n]])
    top = levels([trees[n][-1][0] for n in names]) if names else []
    return sorted((str(r[0]), code(r), trees[n][-1][0], top[-1][0], steps(trees[n], i) + steps(top, g))
                  for g, n in enumerate(names) for i, r in enumerate(members[n]))


@pytest.mark.parametrize("count", [1, 2, 3, 5, 8, 13, 64, 100])
def test_frontier_witnesses(count):
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(count)]
    frontier = Frontier()
    for leaf in leaves:
        frontier.append(leaf)
        assert len({node[0] for node in frontier.open}) == len(frontier.open)  # one open subtree a height
    tree = levels([x.hex() for x in leaves])
    assert frontier.close().hex() == tree[-1][0]
    for i, witness in enumerate(frontier.witnesses):
        assert [w.hex() for w in witness] == [d for _, d in steps(tree, i)]


def rows_of(df):
    return [tuple(r[c] for c in FIELDS) for r in df.collect()]


def made(df, bits):
    out = manifest(df, leaf_digest([F.col(c) for c in FIELDS]), F.col("doc_id"), F.col("lang"), {"doc_id": F.col("doc_id")}, bits)
    checked = out.withColumn("again", fold("leaf", "path")).collect()
    assert all(r.again == r.root for r in checked)
    return sorted((str(r.doc_id), r.leaf, r.subroot, r.root, [tuple(s) for s in r.path]) for r in checked)


EDGE = [(1, "a", "en", 3, "abc"), (2, "a", "en", None, None), (None, None, None, None, None), (None, None, None, None, None),
        (3, "", "é", 0, ""), (4, "b", "en", 1, "ü\U0001F511"), (4, "b", "en", 1, "x"), (4, "b", "en", 1, "x"),
        (5, "b", "", 9, "long " * 40_000), (6, "b", "zz", 2, "-"), (7, "c", "en", 2, "3:abc")]


@pytest.mark.parametrize("bits", [1, 2, 12])
def test_edge_rows(spark, bits):
    df = (spark.createDataFrame(EDGE, "doc_id long, source string, lang string, n_chars long, text string")
          .withColumns({"path": F.lit(1), "tree": F.lit("t"), "pos": F.lit(7)}))  # clashing names pass by
    assert made(df, bits) == brute(EDGE)
    assert made(df.limit(0), bits) == []


def test_hot_group_over_many_blocks(spark):
    rows = [(i // 2, "s", "en" if i % 3 else None, i, f"t{i % 50}") for i in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(7)
    assert made(df, 3) == brute(rows)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    source = rows_of(spark.read.parquet(f"{sf}/documents.parquet"))
    by_leaf = {code(r): r for r in source}
    want = {x[1]: x for x in brute(source)}
    got = op12_merkle_manifest(spark, sf).collect()
    assert len(got) == len(source)
    tampered = 0
    for r in got:
        _, leaf, subroot, root, path = want[r.leaf]
        row = by_leaf[leaf]
        assert (r.subroot, r.root, r.proof_sha256) == (subroot, root, h(*[d for _, d in path]))
        changed = row
        if zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None:
            changed = (*row[:3], row[3] + 1, row[4])
            tampered += 1
        assert r.folded_root == folded(code(changed), path)
        assert r.verified == (changed == row)
    assert tampered > 0
