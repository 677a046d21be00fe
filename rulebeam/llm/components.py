"""Connected components of an edge table by alternating star rounds
(large-star / small-star, Kiveris et al. 2014): DataFrame operations only.

Every round writes its edges to the shared checkpoint folder, so lineage stays
short and a lost executor only re-reads files; the edges of the round before are
deleted then. Links and components never leave the executors; the driver sees two numbers a round.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import delete_path, materialize, scratch_path, shuffles_removed


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60,
                         base: str | None = None) -> DataFrame:
    """(node, root) for each node of ``edges``: root is the smallest node of
    its component. Self links and nulls are ignored, repeated links count once. An
    empty table gives an empty table. Tables are written under ``base``."""
    spark = edges.sparkSession
    folder = f"{base.rstrip('/')}/stars-{os.urandom(6).hex()}" if base else scratch_path(spark, "stars")
    e = materialize(_tidy(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))), "links", base=f"{folder}/0")
    seen = _mark(e)
    for k in range(max_rounds):
        if not seen[0]:
            break
        e = materialize(_small_star(_large_star(e)), "links", base=f"{folder}/{k + 1}")
        delete_path(spark, f"{folder}/{k}")
        now = _mark(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    # Settled: every node is linked to its root alone.
    child = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return child.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _tidy(e: DataFrame) -> DataFrame:
    """Distinct links with u > v."""
    return (e.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())


def _mark(e: DataFrame) -> tuple:
    with shuffles_removed(e.sparkSession):
        r = e.agg(F.count("*"), F.sum((F.xxhash64("u", "v") % 1_000_003).cast("decimal(38,0)"))).first()
    return r[0], r[1]


def _large_star(e: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest of its neighbourhood."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(e: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours and itself to the smallest of them."""
    e = _tidy(e)
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    linked = e.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _tidy(linked.unionByName(low.select("u", F.col("m").alias("v"))))
