"""Data profiling (shape, nulls, class balance, label rate per value).

Each operator is one pass with map-side partial aggregation; everything
after the first group-by runs on a handful of rows. Every operator accepts
either raw rows (with the label column) or a cell table (``n``, ``p``,
``q`` columns), so a caller holding cells profiles without another scan.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.items import order_by_list


def is_cells(df: DataFrame) -> bool:
    return {"n", "p", "q"} <= set(df.columns)


def label_counts(df: DataFrame, keys: Sequence[str | Column], label: str = "is_fraud",
                 positive: int = 1, negative: int = 0) -> DataFrame:
    """(keys..., n, p, q): rows, positives, negatives per key."""
    if is_cells(df):
        return df.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("p").alias("p"), F.sum("q").alias("q"))
    lab = F.col(label)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if(lab == positive).alias("p"),
                                 F.count_if(lab == negative).alias("q"))


def dataset_shape(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """G1: row count (per ``by`` group) and column count (``by`` excluded)."""
    n_cols = len([c for c in df.columns if c not in by])
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(n_cols))


def null_profile(df: DataFrame, by: Sequence[str] = (), only_nonzero: bool = False) -> DataFrame:
    """SQL NULL count per column in one pass; ``nan_count`` for float
    columns (NaN is not null). ``only_nonzero`` keeps columns with nulls."""
    float_types = (T.DoubleType, T.FloatType)
    cols = [f for f in df.schema.fields if f.name not in by]
    aggs = []
    for f in cols:
        aggs.append(F.count_if(F.col(f.name).isNull()).alias(f"null__{f.name}"))
        nan = F.count_if(F.isnan(F.col(f.name))) if isinstance(f.dataType, float_types) else F.lit(0).cast("bigint")
        aggs.append(nan.alias(f"nan__{f.name}"))
    wide = df.groupBy(*by).agg(*aggs)
    stacked = F.inline(F.array(*[
        F.struct(F.lit(i).alias("column_index"), F.lit(f.name).alias("column"),
                 F.col(f"null__{f.name}").alias("null_count"), F.col(f"nan__{f.name}").alias("nan_count"))
        for i, f in enumerate(cols)]))
    out = wide.select(*by, stacked)
    return out.filter(F.col("null_count") > 0) if only_nonzero else out


def label_distribution(df: DataFrame, label: str = "is_fraud", by: Sequence[str] = ()) -> DataFrame:
    """Rows per label value and their percent of the total
    (per ``by`` group), sorted by label."""
    g = df.groupBy(*by, label).agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy(*by) if by else Window.partitionBy()
    return (g.withColumn("percentage", F.col("count") / F.sum("count").over(w) * 100)
            .orderBy(*by, F.asc_nulls_first(label)))


def composition(df: DataFrame, label: str = "is_fraud", by: Sequence[str] = ()) -> DataFrame:
    """n_rows (all rows), n_fraud, n_non_fraud, n_labelled
    (= fraud + non-fraud) and rates in percent of n_labelled."""
    c = label_counts(df, by, label)
    labelled = F.col("p") + F.col("q")
    rate = F.try_divide(F.col("p"), labelled) * 100
    return c.select(*by, F.col("n").alias("n_rows"), F.col("p").alias("n_fraud"), F.col("q").alias("n_non_fraud"),
                    labelled.alias("n_labelled"), rate.alias("fraud_rate_pct"), (100 - rate).alias("non_fraud_rate_pct"))


def rate_by_feature(df: DataFrame, features: Sequence[str], label: str = "is_fraud",
                    round_to: int | None = 2, by: Sequence[str] = ()) -> DataFrame:
    """Label rate per value of every feature, long form
    (feature, value, total, "0", "1", fraud_rate).

    One group-by over all features jointly, then an unpivot of that small
    result: the rows are read once for any number of features. ``total`` =
    negatives + positives (null labels excluded), ``fraud_rate`` =
    positives / total * 100 (null when total is 0), rounded half-up to
    ``round_to`` places unless None.
    """
    keys = [F.col(f).cast("string").alias(f) for f in features]
    c = label_counts(df, [*by, *keys], label)
    long = c.unpivot(ids=[*by, "p", "q"], values=list(features), variableColumnName="feature",
                     valueColumnName="value")
    g = long.groupBy(*by, "feature", "value").agg(F.sum("q").alias("0"), F.sum("p").alias("1"))
    g = g.withColumn("total", F.col("0") + F.col("1"))
    rate = F.try_divide(F.col("1"), F.col("total")) * 100
    if round_to is not None:
        rate = F.round(rate, round_to)
    return g.withColumn("fraud_rate", rate)


def rate_for_feature(df: DataFrame, feature: str, label: str = "is_fraud", round_to: int | None = 2,
                     order: Sequence[str] | None = None, top: int | None = None) -> DataFrame:
    """G6 in the per-feature shape: (<feature>, total, "1", fraud_rate),
    sorted by rate desc (O2), or by a fixed label ``order`` (P23)."""
    r = rate_by_feature(df, [feature], label, round_to).select(
        F.col("value").alias(feature), "total", "1", "fraud_rate")
    if order is not None:
        r = r.withColumn("order_idx", order_by_list(F.col(feature), order)).orderBy("order_idx")
    else:
        r = r.orderBy(F.desc_nulls_last("fraud_rate"), F.asc_nulls_last(feature))
    return r.limit(top) if top is not None else r


def compare_datasets(df: DataFrame, label: str = "is_fraud", dataset_col: str = "split",
                     first: str = "train", second: str = "test") -> DataFrame:
    """Rows and positive rate (percent of all rows) per dataset,
    with the absolute rate difference between ``first`` and ``second``."""
    c = label_counts(df, [dataset_col], label)
    c = c.select(F.col(dataset_col).alias("dataset"), F.col("n").alias("n_rows"), F.col("p").alias("n_fraud"),
                 (F.try_divide(F.col("p"), F.col("n")) * 100).alias("fraud_rate_pct"))
    all_rows = Window.partitionBy()
    a = F.max(F.when(F.col("dataset") == first, F.col("fraud_rate_pct"))).over(all_rows)
    b = F.max(F.when(F.col("dataset") == second, F.col("fraud_rate_pct"))).over(all_rows)
    return c.withColumn("rate_diff_abs", F.abs(a - b))
