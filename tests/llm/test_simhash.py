import random
import re

import numpy as np
import xxhash
from pyspark.sql import Row

from rulebeam.llm import simhash
from rulebeam.llm.components import connected_components
from rulebeam.llm.simhash import BKTree, hamming_links, near_duplicates, op9_simhash_near_dedup

from .brute import components

SF001 = "/root/testdata/sf0.001"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fp(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    sh = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(docs, radius=4):
    """docs: (doc_id, text) -> (doc_id, fingerprint, component) of each row."""
    fps = [brute_fp(t) for _, t in docs]
    u = sorted(set(fps))
    root = components(u, [(a, b) for i, a in enumerate(u) for b in u[:i] if (a ^ b).bit_count() <= radius])
    first = {}
    for (d, _), f in zip(docs, fps):
        if d is not None:
            first[root[f]] = min(d, first.get(root[f], d))
    return sorted(((d, f"{f:016x}", first.get(root[f])) for (d, _), f in zip(docs, fps)), key=str)


def rows(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


def test_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    assert rows(op9_simhash_near_dedup(spark, SF001)) == brute_components(docs)


def test_edge_cases(spark):
    long = "Alpha beta gamma delta " * 60_000
    data = [(5, None), (3, ""), (4, " \n\t"), (9, "one two"), (8, "ONE two"), (8, "ONE two"), (None, "one  two"),
            (7, long), (6, long + "end"), (None, "only nulls here to be seen")]
    df = spark.createDataFrame([Row(doc_id=d, text=t, fp="x", component_id=1.0, n="y") for d, t in data],
                               "doc_id long, text string, fp string, component_id double, n string")
    got = near_duplicates(df).selectExpr("doc_id", "lower(lpad(hex(fp), 16, '0')) AS fingerprint", "component_id")
    assert rows(got) == brute_components(data)
    assert near_duplicates(df.limit(0)).count() == 0


def close_prints(n, seed):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(max(2, n // 20))]
    out = set()
    while len(out) < n:
        x = rng.choice(base)
        for _ in range(rng.randint(0, 9)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return sorted(out)


def test_links_join_the_same_components_as_all_pairs(spark):
    prints = close_prints(600, 1)
    want = components(prints, [(a, b) for i, a in enumerate(prints) for b in prints[:i] if (a ^ b).bit_count() <= 4])
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    for size in (2048, 7):  # one tree a shard; shards dealt into many trees
        links = [(a & (1 << 64) - 1, b & (1 << 64) - 1) for a, b in hamming_links(df, tree_size=size).collect()]
        assert all((a ^ b).bit_count() <= 4 for a, b in links)
        assert components(prints, links) == want


def test_tree_finds_exactly_the_ball():
    prints = close_prints(400, 2)
    tree = BKTree()
    for x in prints:
        tree.add(x)
    for x in prints[::17]:
        assert sorted(tree.values[i] for i in tree.within(x, 4)) == [y for y in prints if (x ^ y).bit_count() <= 4]


def test_prints_of_a_slice():
    texts = ["a b c d e f g h", "", "x", "a b c d e f g i"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offs = np.cumsum([0] + [len(t) for t in texts])
    assert simhash.fingerprints_of(data, offs).tolist() == [brute_fp(t) for t in texts]


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(7, 7), (5, 4), (4, 5)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(300)}}
