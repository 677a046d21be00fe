"""Entry point 1: profiling of the train and test transactions.

``profile_run`` takes everything from one raw scan: shape, nulls and class counts are observed while the cell
table is built, and the rates are read from the cells. ``profile`` takes rows and scans
them for what no cell table has.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from .. import spec as S
from ..operators import charts as C
from ..operators import profile as P


@dataclass
class Profile:
    shape: DataFrame
    nulls: DataFrame
    class_balance: DataFrame
    composition: DataFrame
    rates: DataFrame
    comparison: DataFrame
    rate_by_time_period: DataFrame
    rate_by_amount: DataFrame


def profile(rows: DataFrame, label: str = "is_fraud", split_col: str = "split",
            features=S.PROFILE_FEATURES, cells: DataFrame | None = None) -> Profile:
    """``rows``: enhanced transactions of both datasets with a split column."""
    counts = cells if cells is not None else rows
    train_rows = rows.filter(rows[split_col] == "train")
    return Profile(
        shape=P.dataset_shape(rows, by=[split_col]),
        nulls=P.null_profile(rows, by=[split_col], only_nonzero=True),
        class_balance=C.chart_class_shares(rows, label, split_col),
        composition=P.composition(counts, label, by=[split_col]),
        rates=P.rate_by_feature(counts, features, label, round_to=2, by=[split_col]),
        comparison=P.compare_datasets(counts, label, split_col),
        rate_by_time_period=C.chart_rate_by_time_period(train_rows, label),
        rate_by_amount=C.chart_rate_by_amount(train_rows, label),
    )


def profile_run(run, features=S.PROFILE_FEATURES) -> Profile:
    """``profile`` of a ``MiningRun(..., observe=True)`` with no scan beside the one that builds its cells."""
    if not run.observe:
        raise ValueError("the run does not observe its scan")
    cells, split, label = run.cells, run.split_col, run.spec.label
    if not run.observed.agrees_with(cells):  # a stage ran twice
        return profile(run.rows, label, split, features, cells)
    balance = run.observed.label_distribution(cells, run.spec.positive, run.spec.negative)
    return Profile(
        shape=run.observed.dataset_shape(),
        nulls=run.observed.null_profile(only_nonzero=True),
        class_balance=C.chart_class_shares(run.rows, label, split) if balance is None else balance,
        composition=P.composition(cells, label, by=[split]),
        rates=P.rate_by_feature(cells, features, label, round_to=2, by=[split]),
        comparison=P.compare_datasets(cells, label, split, run.train, run.test),
        rate_by_time_period=C.chart_rate_by_time_period(run.train_cells, label),
        rate_by_amount=C.chart_rate_by_amount(run.train_cells, label),
    )
