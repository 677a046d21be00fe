"""Places of rows inside their group, without a task that holds a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def number_rows(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``pos`` (place in its group from 0, by ``order``) and ``n`` (rows of the group).

    Rows are sorted by ranges over group, order and a row number of their own, so that a group of any
    size and any number of ties spreads over the tasks; places are counts
    inside a range plus the counts of the ranges before it. Only these counts, at most
    one per group and range, meet in a window."""
    rows = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), f"{name}-rows")
    keys = [F.asc_nulls_first(c) for c in (group, *order, "_row")]
    ranged = materialize(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                         .withColumn("_at", F.monotonically_increasing_id()).drop("_row"), f"{name}-sorted")
    part = F.shiftright("_at", 33)
    counts = ranged.groupBy(group, part.alias("_part")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    counts = counts.withColumn("n", F.sum("_n").over(Window.partitionBy(group))).drop("_n")
    joined = ranged.withColumn("_part", part).join(counts, [group, "_part"])
    return (joined.withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before"))
            .drop("_at", "_first", "_before", "_part"))
