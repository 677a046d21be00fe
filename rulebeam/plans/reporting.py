"""Entry point 3: chart data and the text summary from written results."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import charts as C
from ..functions.items import confidence_column
from ..operators.report import summary_lines
from ..sources.results import read_latest_patterns


@dataclass
class Report:
    """Chart tables and text of one written result. Without a confidence column (C9) only
    the pattern types and the count are left; the other tables are None."""

    patterns: DataFrame
    top_patterns: DataFrame | None
    pattern_types: DataFrame | None
    summary: DataFrame
    text: DataFrame | None


def report(spark: SparkSession, results_dir: str, generated: str, fmt: str = "csv") -> Report:
    """Reload the newest pattern table (top-N preferred) and derive the
    chart tables (C5-C9) and the text summary lines (K6)."""
    exported = read_latest_patterns(spark, results_dir, fmt=fmt)
    column = confidence_column(exported)
    sources = {"rank": "Rank", "pattern_name": "Pattern_Name", "pattern_type": "Pattern_Type", "confidence": column,
               "lift": "Lift"}
    patterns = exported.select(*[F.col(c).alias(n) for n, c in sources.items() if c in exported.columns])
    bad = [c for c in ("rank", "pattern_name") if c not in patterns.columns or not patterns.where(F.col(c).isNull()).isEmpty()]
    if column is not None and bad:
        raise ValueError(f"the pattern table under {results_dir} has rows without {' and '.join(bad)}")
    charted = column is not None
    return Report(
        patterns=patterns,
        top_patterns=C.chart_top_patterns(patterns) if charted else None,
        pattern_types=C.chart_pattern_types(patterns) if "pattern_type" in patterns.columns else None,
        summary=C.chart_summary(patterns),
        text=summary_lines(patterns, source=results_dir, generated=generated) if charted else None,
    )
