"""Ranks of any number of rows, sorted by ranges in many tasks.

Rows are dealt to range partitions of the wanted order, sorted there and written with their
place; a rank is the place inside the range plus the counts of the ranges before it. Only these
counts, one per range (and group), meet in a window.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

PART, AT = "_part", "_at"


def rank_by_ranges(rows: DataFrame, order: Sequence[Column], rank: str = "rank", within: str | None = None,
                   rank_within: str = "level_rank", base: str | None = None, keep_part: bool = False) -> DataFrame:
    """``rows`` with ``rank``, the place from 1 in ``order``, and, with ``within``, ``rank_within``, the place in
    that order among the rows of the same ``within``. Ties are broken by chance, so ``order`` ends in a key.

    ``rows`` are read twice (range bounds, sort) and should be a written table. ``keep_part`` leaves the
    range's number in a column ``_part``."""
    sorted_rows = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                              .withColumn(AT, F.monotonically_increasing_id()), "ranked", base=base)
    ranged = sorted_rows.withColumn(PART, F.shiftright(AT, 33))
    groups = [PART] if within is None else [PART, within]
    counts = ranged.groupBy(*groups).agg(F.count("*").alias("_n"))
    earlier = (Window.unboundedPreceding, -1)
    before = {"_before": F.sum("_n").over(Window.orderBy(PART).rangeBetween(*earlier))}
    if within is not None:
        before["_before_within"] = F.sum("_n").over(Window.partitionBy(within).orderBy(PART).rangeBetween(*earlier))
    counts = counts.withColumns(before).drop("_n").fillna(0, list(before))
    out = ranged
    if within is not None:
        out = out.withColumn("_in_part", F.row_number().over(Window.partitionBy(*groups).orderBy(AT)))
    out = out.join(counts, groups)
    out = out.withColumn(rank, (F.col(AT).bitwiseAND(F.lit((1 << 33) - 1)) + 1 + F.col("_before")).cast("int"))
    if within is not None:
        out = out.withColumn(rank_within, (F.col("_in_part") + F.col("_before_within")).cast("int"))
    out = out.drop(AT, "_before", "_before_within", "_in_part", *([] if keep_part else [PART]))
    return out.select(*[c for c in out.columns if c not in (rank, rank_within)],
                      *([rank_within] if within is not None else []), rank)


def least_from_here(ranked: DataFrame, value: str, out: str, rank: str = "rank") -> DataFrame:
    """``ranked`` (with ``_part``, see ``rank_by_ranges``) with the least ``value`` of a row and all rows after it."""
    after = (ranked.groupBy(PART).agg(F.min(value).alias("_least"))
             .withColumn("_later", F.min("_least").over(Window.orderBy(PART).rangeBetween(1, Window.unboundedFollowing)))
             .drop("_least"))
    here = F.min(value).over(Window.partitionBy(PART).orderBy(F.desc(rank)))
    return (ranked.withColumn("_here", here).join(after, PART)
            .withColumn(out, F.least("_here", "_later")).drop("_here", "_later", PART))
