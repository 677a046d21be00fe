"""The one-scan profile, and top values from summaries."""
import random
import shutil
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF001
from rulebeam.operators import profile as P
from rulebeam.operators.domain import top_values
from rulebeam.operators.heavy import Summary, heavy_top_values, summaries
from rulebeam.plans.eda import profile, profile_run
from rulebeam.plans.mining import MiningRun
from rulebeam.plans.registry import run, txn
from rulebeam.spec import event_spec


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_whole_profile_from_one_scan(spark, tmp_path):
    path = str(tmp_path / "rows")
    rows = txn(spark, SF001)
    odd = rows.withColumn("is_fraud", F.when(F.col("event_id") % 11 == 0, None).otherwise(F.col("is_fraud")))
    odd = odd.withColumn("amt", F.when(F.col("event_id") % 7 == 0, float("nan")).otherwise(F.col("amt")))
    odd.write.parquet(path)
    r = MiningRun(spark.read.parquet(path), event_spec(), observe=True)
    want = profile(r.rows)
    columns = {"shape": ("split",), "nulls": ("split", "column_index"), "class_balance": ("split", "is_fraud"),
               "composition": ("split",), "rates": ("split", "feature", "value"), "comparison": ("dataset",),
               "rate_by_time_period": ("time_period",), "rate_by_amount": ("order_idx",)}
    want = {name: rows_of(getattr(want, name), *by) for name, by in columns.items()}
    assert r.cells.count() > 0
    shutil.rmtree(path)  # nothing can read the rows again
    got = profile_run(r)
    for name, by in columns.items():
        assert rows_of(getattr(got, name), *by) == want[name], name
    assert rows_of(r.observed.null_profile(), "split", "column_index")[0][3:] == (0, 0)
    assert any(x[4] for x in rows_of(r.observed.null_profile(), "split", "column_index"))  # the NaN amounts


def test_observed_needs_observation(spark):
    with pytest.raises(ValueError):
        profile_run(run(spark, SF001))


def test_other_labels_are_counted_by_a_scan(spark):
    rows = txn(spark, SF001).withColumn("is_fraud", F.when(F.col("event_id") % 5 == 0, 7).otherwise(F.col("is_fraud")))
    r = MiningRun(rows, event_spec(), observe=True)
    assert r.cells.count() > 0 and r.observed.label_distribution(r.cells) is None
    got = profile_run(r).class_balance
    assert {x.is_fraud for x in got.collect()} == {0, 1, 7}


def test_disagreement_is_noticed(spark):
    r = MiningRun(txn(spark, SF001), event_spec(), observe=True)
    assert r.observed.agrees_with(r.cells)
    assert not r.observed.agrees_with(r.cells.unionByName(r.cells))
    assert not r.observed.agrees_with(r.cells.where("split = 'test'"))


def test_observed_empty_rows(spark):
    r = MiningRun(txn(spark, SF001).limit(0), event_spec(), observe=True)
    got = profile_run(r)
    assert got.shape.count() == 0 and got.nulls.count() == 0 and got.class_balance.count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from("abcdefghij"), st.integers(1, 50)), max_size=30), max_size=5), st.integers(1, 6))
def test_summary_bounds(batches, counters):
    s, truth = Summary(counters), Counter()
    for batch in batches:
        if batch:
            s.add(pd.Series([v for v, _ in batch]), np.array([n for _, n in batch]))
        for v, n in batch:
            truth[v] += n
    assert len(s.counts) <= counters
    for v, n in truth.items():
        kept = int(s.counts.get(v, 0))
        assert kept <= n <= kept + s.error
    assert s.error <= sum(truth.values()) / (counters + 1)


def brute(values, k):
    ranked = sorted(Counter(values).items(), key=lambda x: (-x[1], x[0] is None, x[0] or ""))[:k]
    return [(v, n, i) for i, (v, n) in enumerate(ranked, 1) if v is not None]


@pytest.mark.parametrize("k, counters", [(1, 8), (3, 8), (5, 5), (10, 64)])
def test_heavy_top_values_are_exact(spark, k, counters):
    rng = random.Random(k)
    rows = [(str(int(rng.paretovariate(.7))), str(i), rng.choice(["x", "y", None, None]), str(rng.randrange(300)), "one", None)
            for i in range(4000)]
    df = spark.createDataFrame(rows, "zipf string, id string, few string, flat string, same string, nothing string").repartition(7)
    names = df.columns
    got = {}
    for r in heavy_top_values(df, names, k, counters).collect():
        got.setdefault(r.feature, []).append((r.value, r["count"], r.value_rank))
    for i, name in enumerate(names):
        assert sorted(got.get(name, []), key=lambda x: x[2]) == brute([r[i] for r in rows], k), name


def test_heavy_equals_top_values_of_cells(spark, run01):
    cells, spec = run01.train_cells, run01.spec
    key = ("feature", "value_rank")
    assert rows_of(heavy_top_values(cells, spec.features, 3, 4), *key) == rows_of(top_values(cells, spec.features, 3).select(
        "feature", "value", "count", "value_rank"), *key)


def test_summaries_are_bounded_by_tasks_and_counters(spark):
    """A column of as many values as rows: what is shuffled depends on tasks and counters alone."""
    df = spark.range(0, 200_000, 1, 4).select(F.col("id").alias("a"), (F.col("id") % 3).alias("b"))
    assert summaries(df, ["a", "b"], 50).count() <= 4 * (50 + 1 + 3 + 1)
    plan = summaries(df, ["a", "b"], 50).groupBy("feature", "value").agg(F.sum("count"))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") > plan.index("Exchange")  # the summary is made before the exchange


def test_heavy_edge_cases(spark):
    empty = spark.createDataFrame([], "f string")
    assert heavy_top_values(empty, ["f"], 3).count() == 0
    assert [tuple(r) for r in heavy_top_values(spark.createDataFrame([(None,), ("",)], "f string"), ["f"], 3).collect()] == [("f", "", 1, 1)]
    with pytest.raises(ValueError):
        heavy_top_values(empty, ["f"], 9, 8)
    assert P.is_cells(spark.createDataFrame([], "n long, p long, q long"))
