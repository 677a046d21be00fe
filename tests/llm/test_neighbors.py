import math

import numpy as np
from pyspark.sql import Row

from rulebeam.llm.neighbors import K, Chunk, ProbeTables, nearest, op2_nearest_neighbours, valid_vectors

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.1"


def usable(v):
    return v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v) and any(v)


def brute(rows, queries, k=K):
    """{query: [(score, id)...]} over rows (id, vector)."""
    out = {}
    for q, v in queries:
        best = {}
        for i, x in rows:
            if i != q and len(x) == len(v):
                s = sum(a * b for a, b in zip(v, x))
                best[i] = max(best.get(i, -math.inf), s)
        out[q] = sorted(((-s, i) for i, s in best.items()))[:k]
    return out


def results(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def test_recall_and_exact_scores(spark):
    for sf in (SF001, SF01):
        t = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
        ids, x = np.array([i for i, _ in t]), np.array([v for _, v in t], dtype=np.float64)
        got = results(op2_nearest_neighbours(spark, sf))
        assert set(got) == {i for i in ids.tolist() if i % 20 == 0}
        at = {i: n for n, i in enumerate(ids.tolist())}
        hits = 0
        for q, found in got.items():
            s = (x * x[at[q]]).sum(axis=1)
            order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:K]
            hits += len({int(ids[i]) for i in order} & {i for _, i, _ in found})
            assert [r for r, _, _ in found] == list(range(1, K + 1))
            assert [(-a, i) for _, i, a in found] == sorted((-a, i) for _, i, a in found)
            for _, i, a in found:
                assert i != q and abs(a - s[at[i]]) < 1e-12
        assert hits >= 0.9 * K * len(got)


def test_all_probes_give_the_exact_result_in_many_chunks_and_blocks(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=8) * rng.uniform(0.1, 5)).round(1).tolist()) for i in range(300)]
    rows += [(7, rows[50][1]), (20, [1.0] * 8), (500, rows[3][1]), (501, [1.0, 2.0]), (520, [2.0, 1.0])]
    odd = [(600, None), (620, [0.0] * 8), (640, [1.0] * 7 + [None]), (660, [float("nan")] * 8), (680, []),
           (700, [float("inf")] + [0.0] * 7), (None, [1.0] * 8)]
    df = spark.createDataFrame([Row(vec_id=i, embedding=v, chunk=1, v="x") for i, v in rows + odd],
                               "vec_id long, embedding array<double>, chunk int, v string")
    vectors = valid_vectors(df)
    assert vectors.count() == len(rows)
    queries = {}
    for i, v in rows:
        if i % 20 == 0:
            queries[i] = min(v, queries.get(i, v))
    got = results(nearest(vectors, vectors.where("vec_id % 20 = 0"), chunk=70, query_block=4, hashes=2, width=50.0,
                          miss=0.0))
    want = brute([r for r in rows if usable(r[1])], queries.items())
    assert {q: [i for _, i, _ in f] for q, f in got.items()} == {q: [i for _, i in w] for q, w in want.items() if w}
    for q, f in got.items():
        assert all(abs(s + w[0]) < 1e-9 for (_, _, s), w in zip(f, want[q]))


def test_few_rows_equal_rows_and_none(spark):
    df = spark.createDataFrame([(i, [1.0, 0.5]) for i in range(0, 60, 2)], "vec_id long, embedding array<float>")
    v = valid_vectors(df)
    got = results(nearest(v, v.where("vec_id % 20 = 0")))
    assert [i for _, i, _ in got[0]] == list(range(2, 42, 2))  # ties by id
    assert nearest(v.where("vec_id < 4"), v.where("vec_id = 0")).count() == 1
    assert nearest(v.limit(0), v).count() == 0 and nearest(v, v.limit(0)).count() == 0


def test_recall_on_vectors_of_uneven_norms(spark):
    t = spark.read.parquet(f"{SF01}/embeddings.parquet").orderBy("vec_id").limit(2000).collect()
    x = np.array([r.embedding for r in t], dtype=np.float64)
    ids = np.arange(len(x))
    rng = np.random.default_rng(9)
    one = np.ones(len(x))
    one[11] = 100.0
    steps = np.where(ids % 3 == 0, 2.0, 1.0)  # two ranges that are large enough for tables
    for scale in (one, rng.lognormal(size=len(x)), steps, 1 + 0.19 * rng.random(len(x))):
        y = x * scale[:, None]
        asked = ids[::20]
        hits = 0
        for i, (q, found, _) in zip(asked, Chunk(ids, y).search(asked, y[asked], K)):
            s = y @ y[i]
            s[i] = -np.inf
            assert (q == i).all() and len(set(found.tolist())) == K
            hits += len(set(np.argsort(-s)[:K].tolist()) & set(found.tolist()))
        print(f"recall: {hits / (K * len(asked)):.3f}")
        assert hits >= 0.9 * K * len(asked)


def test_every_query_gets_k_rows_where_there_are_as_many(spark):
    """Also from few rows, of a rare length, and where no probed bucket holds one."""
    rng = np.random.default_rng(4)
    for n in (2, 15, 21, 60):
        x = rng.normal(size=(n, 64))
        for _, found, _ in Chunk(np.arange(n), x).search(np.arange(n), -x, K):
            assert len(set(found.tolist())) == min(K, n - 1)
    rows = [(i, rng.normal(size=64).tolist()) for i in range(15)] + [(100 + i, rng.normal(size=5).tolist()) for i in range(21)]
    v = valid_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = results(nearest(v, v))
    assert {q: [i for _, i, _ in f] for q, f in got.items()} == {q: [i for _, i in f] for q, f in brute(rows, rows).items()}


def test_probes_come_in_order_of_estimated_success():
    rng = np.random.default_rng(2)
    tables = ProbeTables(5, tables=2, hashes=3, width=1.0)
    q = rng.normal(size=(1, 5))
    f = tables.project(q)[0, 1]
    home = np.floor(f)
    cost = {}
    for move in tables.moves.tolist():
        step = [(x - h) ** 2 if m < 0 else (1 - (x - h)) ** 2 if m > 0 else 0 for x, h, m in zip(f, home, move)]
        cost[int(tables.codes(home + move))] = sum(step)
    order = tables.probes(q)[0][0, 1].tolist()
    assert len(set(order)) == 27 and order[0] == int(tables.codes(home))
    assert [cost[c] for c in order] == sorted(cost.values())


def recall_and_visited(ids, x, k=K):
    """By the tables of one chunk, for rows whose id is divisible by 20."""
    chunk = Chunk(ids, x)
    asked = np.flatnonzero(ids % 20 == 0)
    hits = visited = wanted = 0
    units = x[asked] / np.linalg.norm(x[asked], axis=1)[:, None]
    probes = chunk.tables.probes(np.c_[units, np.zeros(len(asked))])
    for i, (row, (_, found, _)) in enumerate(zip(asked, chunk.search(ids[asked], x[asked], k))):
        s = x @ x[row]
        s[row] = -np.inf
        best = ids[np.argsort(-s)[:k]].tolist()
        hits += len(set(best) & set(found.tolist()))
        wanted += len(best)
        visited += len(chunk._candidates(tuple(p[i] for p in probes), ids[row], units[i].astype(np.float32), k)[0])
    return hits / wanted, visited / len(asked) / len(x)


def test_chance_of_a_miss_is_the_share_that_is_missed():
    """Rows at a distance from a query, hashed by drawn functions."""
    rng = np.random.default_rng(8)
    for distance, visited in ((0.5, 4), (0.9, 36), (1.1, 108)):
        chance, missed = [], []
        for seed in range(400):
            tables = ProbeTables(8, tables=2, hashes=4, seed=seed)
            q, step = rng.normal(size=(1, 8)), rng.normal(size=(1, 8))
            row = q + distance * step / np.linalg.norm(step)
            codes, order, down = tables.probes(q)
            visited = min(visited, codes.shape[2])
            chance.append(tables.missed(down[0], order[0], visited, distance))
            filled = tables.fill(row, np.zeros(1, np.int64))
            missed.append(not tables.candidates(filled, np.zeros(1, np.int64), codes[0, :, :visited])[0])
        print(distance, np.mean(chance), np.mean(missed))
        assert abs(np.mean(chance) - np.mean(missed)) < 0.06


def test_few_rows_come_through_the_tables_too(spark):
    for sf in (SF001, SF01):
        t = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect() if usable(r.embedding)]
        x = np.array([v for _, v in t], dtype=np.float64)
        for scale in (1.0, np.random.default_rng(5).lognormal(size=len(x))[:, None]):
            recall, visited = recall_and_visited(np.array([i for i, _ in t]), x * scale)
            print(len(x), f"recall {recall:.3f} visited {visited:.3f}")
            assert recall >= 0.9 and visited < 0.95


def test_clustered_vectors_need_few_buckets():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 64))[rng.integers(0, 300, 16_384)] + 0.3 * rng.normal(size=(16_384, 64))
    recall, visited = recall_and_visited(np.arange(16_384), x)
    print(f"recall {recall:.3f} visited {visited:.3f}")
    assert recall >= 0.9 and visited < 0.3


def test_several_chunks_of_the_default_size(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1000, 16))[rng.integers(0, 1000, 60_000)] + 0.3 * rng.normal(size=(60_000, 16))
    v = valid_vectors(spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>"))
    got = results(nearest(v, v.where("vec_id % 600 = 0")))
    hits = 0
    for q, found in got.items():
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(set(np.argsort(-s)[:K].tolist()) & {i for _, i, _ in found})
    assert len(got) == 100 and hits >= 0.9 * K * 100
