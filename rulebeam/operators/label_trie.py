"""M5/F9 for label tables of any size: a prefix trie that each cell walks once.

Labels are lists of conditions (feature = value). Labels with equal first conditions share the nodes of these
conditions, so a node stands for one distinct prefix and is counted once, however many labels pass it. A
cell starts at the root; at a node it goes on to the children whose condition it holds, found by an equi-join on
(node, feature, value). A cell has one value per feature, so it meets at most one child
per feature at a node: nothing of the size cells x labels arises, also where thousands of labels begin with
one frequent condition. The counts of the nodes are the funnel of every label at once, the last
one its total.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.items import cell_items, pattern_label
from ..session import delete_path, materialize, scratch_path
from ..spec import PatternSpec

ROOT = ""


def prefixes(items: Column) -> Column:
    """The label text of every prefix of ``items``: the names of its trie nodes."""
    return F.transform(items, lambda _, i: pattern_label(F.slice(items, 1, i + 1)))


def label_steps(labels: DataFrame, key: str, items_col: str = "items") -> DataFrame:
    """(key, step, node, parent, feature, value): one row per label and condition."""
    names = prefixes(F.col(items_col))
    each = F.arrays_zip(names.alias("node"), F.col(items_col).alias("item"))
    s = labels.select(key, names.alias("names"), F.posexplode(each).alias("i", "at"))
    return s.select(key, (F.col("i") + 1).alias("step"), "at.node",
                    F.coalesce(F.get("names", F.col("i") - 1), F.lit(ROOT)).alias("parent"),
                    F.col("at.item.feature").alias("feature"), F.col("at.item.value").alias("value"))


def trie_counts(cells: DataFrame, spec: PatternSpec, steps: DataFrame) -> DataFrame:
    """(node, n, p): rows and positives of the cells that reach each node; nodes no cell
    reaches are absent. One join per step of the longest label."""
    base = scratch_path(cells.sparkSession, "trie")
    nodes = materialize(steps.select("step", "node", "parent", "feature", "value").distinct(), "nodes", base=base)
    # At most one entry per step and column of the cells.
    asked: dict[int, list[str]] = {}
    for r in nodes.where(F.col("feature").isin(list(spec.features))).select("step", "feature").distinct().collect():
        asked.setdefault(r["step"], []).append(r["feature"])
    front = cells.select("n", "p", cell_items(spec.features).alias("cell"), F.lit(ROOT).alias("parent"))
    counts = None
    for step in range(1, max(asked, default=0) + 1):
        children = nodes.where(F.col("step") == step).select("parent", "feature", "value", "node")
        conditions = F.filter("cell", lambda c: c["feature"].isin(asked.get(step, [])) & c["value"].isNotNull())
        met = (front.select("n", "p", "cell", "parent", F.explode(conditions).alias("it"))
               .select("n", "p", "cell", "parent", "it.feature", "it.value").join(children, ["parent", "feature", "value"]))
        front = materialize(met.select("n", "p", "cell", F.col("node").alias("parent")), f"step{step}", base=base)
        here = front.groupBy(F.col("parent").alias("node")).agg(F.sum("n").alias("n"), F.sum("p").alias("p"))
        counts = here if counts is None else counts.unionByName(here)
    if counts is None:
        counts = front.where("false").select(F.col("parent").alias("node"), "n", "p")
    out = materialize(counts, "trie-counts")
    delete_path(cells.sparkSession, base)
    return out


def funnel_counts(cells: DataFrame, spec: PatternSpec, labels: DataFrame, key: str,
                  items_col: str = "items") -> DataFrame:
    """Per label of at least one condition: key, after (rows left after each condition), n, p (of the whole label)."""
    steps = label_steps(labels, key, items_col)
    counts = trie_counts(cells, spec, steps)
    found = F.struct("step", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("p", F.lit(0)).alias("p"))
    each = steps.select(key, "step", "node").join(counts, "node", "left").groupBy(key).agg(
        F.array_sort(F.collect_list(found)).alias("found"))
    last = F.element_at("found", -1)
    return each.select(key, F.transform("found", lambda f: f["n"]).alias("after"), last["n"].alias("n"), last["p"].alias("p"))
