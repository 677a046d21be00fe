"""The cell table: one pre-aggregation that every pattern count reads.

``cells`` groups the rows by all mining features (plus optional keys such
as the train/test split) and keeps the row count ``n``, positives ``p`` and
negatives ``q``. It is the only operator that shuffles raw rows; partial
aggregation collapses each input split to at most one row per distinct
feature combination before the shuffle, so a hot combination holding a
third of the data costs one row per task, not a third of the rows. The
result size is bounded by the product of the feature cardinalities, not by
the row count.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..spec import PatternSpec


def build_cells(df: DataFrame, spec: PatternSpec, by: Sequence[str] = ()) -> DataFrame:
    """Rows -> (by..., features as strings..., n, p, q).

    Feature values are cast to string once (one item space for int and
    string features). ``n`` counts every row (also a null label), ``p`` rows
    with the positive label and ``q`` rows with the negative label.
    """
    label = F.col(spec.label)
    pruned = df.select(*by, *[F.col(f).cast("string").alias(f) for f in spec.features], label)
    return pruned.groupBy(*by, *spec.features).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(label == spec.positive).alias("p"),
        F.count_if(label == spec.negative).alias("q"),
    )


def totals(cells: DataFrame) -> DataFrame:
    """One row: n_total, p_total, q_total (null label rows are in n only)."""
    return cells.agg(F.sum("n").alias("n_total"), F.sum("p").alias("p_total"), F.sum("q").alias("q_total"))


def total_columns(cells: DataFrame) -> tuple[Column, Column]:
    """(N, P) from one scalar subquery: run once per query, inlined as values."""
    t = totals(cells).select(F.struct("n_total", "p_total")).scalar()
    return t.getField("n_total"), t.getField("p_total")


def split_cells(cells: DataFrame, split: str, split_col: str = "split") -> DataFrame:
    return cells.filter(F.col(split_col) == split).drop(split_col)
