"""Reload written pattern results."""

from __future__ import annotations

import re
from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import spec as S
from ..session import list_paths
from ..sinks.publish import committed

# Types of the published pattern columns, by name; other columns stay text.
PATTERN_TYPES = {"Rank": "int", "Support": "double", "Confidence": "double", "Lift": "double", "Score": "double",
                 "Pattern_Total_Transactions": "bigint", "Pattern_Fraud_Transactions": "bigint",
                 "Fraud_Rate_Percent": "double"}

EXPECTED_PATTERN_COLUMNS = S.PATTERN_TABLE_MARKERS


def check_columns(df: DataFrame, any_of: Iterable[str] = EXPECTED_PATTERN_COLUMNS) -> bool:
    """Does the table look like pattern data (metadata only, no job)."""
    return bool(set(df.columns) & set(any_of))


def _load(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """One result folder; CSV columns are matched by header name and cast."""
    if fmt != "csv":
        return spark.read.format(fmt).load(path)
    df = spark.read.options(**S.CSV_TEXT, multiLine=True).csv(path)
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in PATTERN_TYPES.items() if c in df.columns})


def read_latest_patterns(spark: SparkSession, base: str, prefer: str = "top", fallback: str = "all",
                         fmt: str = "csv") -> DataFrame:
    """The pattern table of the newest run, preferring the ``prefer``
    kind (top-N) over ``fallback`` (all). Summary tables never qualify.

    "Newest" is the largest run id with a manifest (``sinks.publish``); runs without one are not read. A folder of results
    written before there were manifests is read by its ``run_id`` folders. The choice is made from names
    alone; a table that does not look like pattern data is passed over for the next one.
    """
    base = base.rstrip("/")
    runs = committed(spark, base)
    for kind in (prefer, fallback):
        if runs is None:
            found = sorted((re.search(r"run_id=([^/]+)$", p).group(1) for p in list_paths(spark, f"{base}/kind={kind}/run_id=*")),
                           reverse=True)
        else:
            found = [run_id for run_id, kinds in runs if kind in kinds]
        for run_id in found:
            df = _load(spark, f"{base}/kind={kind}/run_id={run_id}", fmt)
            if check_columns(df):
                return df.withColumns({"kind": F.lit(kind), "run_id": F.lit(run_id)})
    raise FileNotFoundError(f"no pattern tables under {base}")
