"""K1-K6: result tables in the published file shapes.

Results go to ``<base>/kind=<kind>/run_id=<run_id>/`` by the commit protocol of ``publish``, so that "the newest
run" is the newest manifest, not a file-system timestamp. Pattern tables are
bounded by beam x domain, so each is written as one file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import spec as S
from .publish import Publication, new_run_id  # noqa: F401 (new_run_id: part of this module's interface)

EXPORT_COLUMNS = S.PATTERN_EXPORT_COLUMNS
VALIDATION_COLUMNS = S.VALIDATION_EXPORT_COLUMNS


def to_export_shape(patterns: DataFrame) -> DataFrame:
    """The 10 published pattern columns, by rank."""
    sources = [F.col("rank"), F.col("pattern_type"), F.col("pattern_name"), F.col("support"),
               F.col("confidence"), F.col("lift"), F.col("score"), F.col("pattern_total"),
               F.col("pattern_fraud"), F.col("confidence") * 100]
    return patterns.select(*[c.alias(n) for c, n in zip(sources, EXPORT_COLUMNS)])


def to_validation_shape(stable: DataFrame, key: str = "rank", text: bool = False) -> DataFrame:
    """K3: published validation columns. With ``text`` the metric columns of
    failed patterns read ``N/A`` (CSV form); otherwise they are null."""
    valid = F.col("valid")

    def metric(c):
        v = F.when(valid, F.col(c))
        return F.coalesce(v.cast("string"), F.lit(S.NOT_AVAILABLE)) if text else v

    sources = [F.col(key), F.col("pattern_name"), metric("train_confidence"), metric("test_confidence"),
               metric("train_lift"), metric("test_lift"), metric("confidence_diff"), metric("lift_diff"),
               F.col("status"), F.when(valid, S.VALID_YES).otherwise(S.VALID_NO)]
    return stable.select(*[c.alias(n) for c, n in zip(sources, VALIDATION_COLUMNS)])


def to_summary_shape(summary: DataFrame) -> DataFrame:
    """K4: Metric, Value (text)."""
    return summary.orderBy("metric_no").select(
        F.col("metric").alias("Metric"), F.coalesce(F.col("text"), F.col("value").cast("string")).alias("Value"))


def write_result(df: DataFrame, base: str, kind: str, run_id: str, fmt: str = "csv") -> str:
    """Publish one small result table as a single file with a header row."""
    with Publication(df.sparkSession, base, run_id) as out:
        return out.write(df, kind, fmt)


def stage_patterns(out: Publication, patterns: DataFrame, top: int, fmt: str = "csv") -> dict[str, str]:
    """K1 + K2: all patterns and the top ``top``."""
    rank = EXPORT_COLUMNS[0]
    shaped = to_export_shape(patterns).orderBy(rank)
    return {"all": out.write(shaped, "all", fmt), "top": out.write(shaped.filter(F.col(rank) <= top), "top", fmt)}


def stage_validation(out: Publication, stable: DataFrame, fmt: str = "csv") -> str:
    """K3."""
    return out.write(to_validation_shape(stable, text=(fmt == "csv")).orderBy(VALIDATION_COLUMNS[0]), "validation", fmt)


def write_patterns(patterns: DataFrame, base: str, run_id: str, top: int, fmt: str = "csv") -> dict[str, str]:
    """K1 + K2, published together."""
    with Publication(patterns.sparkSession, base, run_id) as out:
        return stage_patterns(out, patterns, top, fmt)


def write_validation(stable: DataFrame, base: str, run_id: str, fmt: str = "csv") -> str:
    """K3."""
    with Publication(stable.sparkSession, base, run_id) as out:
        return stage_validation(out, stable, fmt)


def write_summary(summary: DataFrame, base: str, run_id: str, fmt: str = "csv") -> str:
    """K4."""
    return write_result(to_summary_shape(summary), base, "summary", run_id, fmt)


def write_summary_text(lines: DataFrame, base: str, run_id: str) -> str:
    """K6: the text summary, one line per row."""
    return write_result(lines.orderBy("line_no").select("line"), base, "summary_text", run_id, "text")
