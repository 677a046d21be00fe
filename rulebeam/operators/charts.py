"""The tables behind each chart (rendering is left to the caller)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import spec as S
from ..functions.items import confidence_column
from . import profile as P
from . import report as R


def chart_class_shares(rows: DataFrame, label: str = "is_fraud", dataset_col: str = "split") -> DataFrame:
    """Class counts and shares per dataset (pie charts)."""
    return P.label_distribution(rows, label, by=[dataset_col])


def chart_rate_by_time_period(rows: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Unrounded rate per time period."""
    return P.rate_for_feature(rows, "time_period", label, round_to=None)


def chart_rate_by_amount(rows: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Unrounded rate per amount bucket, in bucket order."""
    return P.rate_for_feature(rows, "amt_category", label, round_to=None, order=S.AMOUNT_ORDER)


def chart_dataset_comparison(rows: DataFrame, label: str = "is_fraud", dataset_col: str = "split") -> DataFrame:
    """C4: rows and rate per dataset with their difference."""
    return P.compare_datasets(rows, label, dataset_col)


def chart_top_patterns(patterns: DataFrame, n: int = S.VALIDATE_N) -> DataFrame:
    """Top-n bars with readable and ``#k`` labels."""
    return R.pattern_labels(patterns, n)


def chart_pattern_types(patterns: DataFrame) -> DataFrame:
    """Pattern count per type."""
    return R.pattern_type_counts(patterns)


def chart_summary(patterns: DataFrame) -> DataFrame:
    """C8 (or C9 when the table has no confidence column): total, average and
    best confidence in percent, or the total alone."""
    col = "confidence" if "confidence" in patterns.columns else confidence_column(patterns)
    if col is None:
        return patterns.agg(F.count(F.lit(1)).alias("n_patterns"))
    return R.pattern_summary(patterns, col)
