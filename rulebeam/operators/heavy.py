"""G15/O7/W3 for near-unique columns: exact top-k values from mergeable summaries.

Every map task keeps, per feature, a Misra-Gries summary of at most ``counters`` values: a value it does not hold occurs
at most ``error`` times in the task's rows, and one it holds at most ``error`` times more often than its counter says.
So only tasks x counters rows are shuffled, however many values there are. Over all tasks the
errors add up: values whose upper bound lies below the k-th largest lower bound are dropped, and the few that are left
are counted exactly in a second pass. If the k-th exact count is above the total error, no other value can be among the k
largest, and the answer is exact; a feature for which that does not hold (no value is frequent) is
counted in full, with one row per value and task shuffled as in ``domain.top_values``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.items import quoted
from ..session import materialize
from .profile import is_cells

COUNTERS = 1024
_SCHEMA = "feature string, value string, count long, error long"


class Summary:
    """Weighted Misra-Gries counters of one feature; ``error`` bounds what any value lacks."""

    def __init__(self, counters: int):
        self.counters, self.counts, self.error = counters, pd.Series(dtype="int64"), 0

    def add(self, values: pd.Series, weights: np.ndarray) -> None:
        batch = pd.Series(weights, dtype="int64").groupby(values.to_numpy(dtype=object), dropna=False, sort=False).sum()
        merged = self.counts.add(batch, fill_value=0).astype("int64") if len(self.counts) else batch.astype("int64")
        if len(merged) > self.counters:
            # The largest counter that has no room is taken off all: what is left is a summary again.
            cut = int(np.partition(merged.to_numpy(), len(merged) - self.counters - 1)[len(merged) - self.counters - 1])
            merged, self.error = merged - cut, self.error + cut
            merged = merged[merged > 0]
        self.counts = merged


def summaries(rows: DataFrame, features, counters: int = COUNTERS) -> DataFrame:
    """(feature, value, count, error): each task's summaries; a row without a counter (value '', count 0) carries
    the error of a feature, so that it is known where no counter is left. Weights: column n of a cell table, else 1."""
    names = list(features)
    weight = F.col("n") if is_cells(rows) else F.lit(1)
    cols = rows.select(*[F.col(quoted(f)).cast("string").alias(f"f{i}") for i, f in enumerate(names)],
                       weight.cast("long").alias("n"))

    def run(batches):
        kept = [Summary(counters) for _ in names]
        for batch in batches:
            table = batch.to_pandas()
            for i, s in enumerate(kept):
                s.add(table[f"f{i}"], table["n"].to_numpy())
        for name, s in zip(names, kept):
            values = [None if pd.isna(v) else v for v in s.counts.index]
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * (len(values) + 1), pa.string()), pa.array([*values, ""], pa.string()),
                 pa.array([*s.counts.to_numpy().tolist(), 0], pa.int64()),
                 pa.array([0] * len(values) + [s.error], pa.int64())], names=["feature", "value", "count", "error"])

    return cols.mapInArrow(run, _SCHEMA)


def heavy_top_values(rows: DataFrame, features, k: int, counters: int = COUNTERS) -> DataFrame:
    """``domain.top_values`` (the k most frequent values per feature, count desc, value asc, null last; a null takes a
    slot and is dropped) of rows or cells."""
    if k > counters:
        raise ValueError("k is at most the number of counters")
    features = list(features)
    parts = materialize(summaries(rows, features, counters), "summaries")
    total = parts.groupBy("feature").agg(F.sum("error").alias("error"))
    lower = parts.where("count > 0").groupBy("feature", "value").agg(F.sum("count").alias("least")).join(total, "feature")
    order = Window.partitionBy("feature").orderBy(F.desc("least"))
    # One row per feature: the k-th largest lower bound (0 where there are fewer values).
    kth = (lower.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).groupBy("feature")
           .agg(F.when(F.count("*") == k, F.min("least")).otherwise(0).alias("bar")))
    survivors = materialize(lower.join(kth, "feature").where("least + error >= bar").select("feature", "value", "error"), "survivors")
    weight = F.col("n") if is_cells(rows) else F.lit(1)
    long = rows.select(F.inline(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(quoted(f)).cast("string").alias("value"), weight.cast("long").alias("n"))
        for f in features])))
    same = (long["feature"] == survivors["feature"]) & long["value"].eqNullSafe(survivors["value"])
    exact = materialize(long.join(survivors, same).select(long["feature"], long["value"], "n", "error")
                        .groupBy("feature", "value").agg(F.sum("n").alias("count"), F.max("error").alias("error")), "exact")
    rank = Window.partitionBy("feature").orderBy(F.desc("count"), F.asc_nulls_last("value"))
    ranked = exact.withColumn("value_rank", F.row_number().over(rank)).where(F.col("value_rank") <= k)
    # One row per feature: whether a value that has no counter could be as frequent as the k-th.
    doubt = (total.join(ranked.groupBy("feature").agg(F.min(F.when(F.col("value_rank") == k, F.col("count"))).alias("last")),
                        "feature", "left")
             .where((F.col("error") > 0) & (F.coalesce("last", F.lit(0)) <= F.col("error"))))
    open_features = sorted(r[0] for r in doubt.select("feature").collect())
    out = ranked.select("feature", "value", "count", "value_rank").where(~F.col("feature").isin(open_features))
    if open_features:
        counted = long.where(F.col("feature").isin(open_features)).groupBy("feature", "value").agg(F.sum("n").alias("count"))
        out = out.unionByName(counted.withColumn("value_rank", F.row_number().over(rank)).where(F.col("value_rank") <= k))
    return out.where("value IS NOT NULL")
