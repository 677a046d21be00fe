"""G1/G2/G5 without a pass of their own: shape, nulls and class counts observed by a scan that is made anyway.

``observed`` attaches one ``Observation`` to the rows. Whatever job reads them next (the cell table) also
counts rows, nulls and NaNs per column and split in its map tasks; the numbers, one per column and split, come back with
the job. A stage that is run again after the loss of an executor can count rows twice, so the
row counts are held against the table that the job wrote, and the profile is scanned again where they differ.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.items import quoted
from . import profile as P
from .domain import literal_table


@dataclass
class Observed:
    """Rows under observation, and their numbers once a job has read them whole."""

    rows: DataFrame
    observation: Observation
    split_col: str
    splits: tuple[str, ...]
    label: str

    @property
    def columns(self) -> list[str]:
        return [c for c in self.rows.columns if c != self.split_col]

    def counts(self) -> dict[str, dict]:
        """Per split: n, nulls and nans by column position. Waits for the job that reads the rows."""
        found = self.observation.get
        width = range(len(self.columns))
        return {s: {"n": found[f"n_{i}"], "nulls": [found[f"null_{i}_{j}"] for j in width],
                    "nans": [found[f"nan_{i}_{j}"] for j in width]} for i, s in enumerate(self.splits)}

    def agrees_with(self, cells: DataFrame) -> bool:
        """Whether the observed rows are those that the cell table counted. Not so without any row: the
        optimizer may then have left the observation out."""
        n = {r[0]: r[1] for r in cells.groupBy(self.split_col).agg(F.sum("n")).collect()}  # one row per split
        return bool(n) and set(n) <= set(self.splits) and all(c["n"] == n.get(s, 0) for s, c in self.counts().items())

    def dataset_shape(self) -> DataFrame:
        """As ``profile.dataset_shape``."""
        rows = [(s, c["n"], len(self.columns)) for s, c in self.counts().items() if c["n"]]
        return literal_table(self.rows.sparkSession, rows, f"{self.split_col} string, n_rows bigint, n_columns int")

    def null_profile(self, only_nonzero: bool = False) -> DataFrame:
        """As ``profile.null_profile``."""
        rows = [(s, j, name, c["nulls"][j], c["nans"][j]) for s, c in self.counts().items() if c["n"]
                for j, name in enumerate(self.columns) if c["nulls"][j] or not only_nonzero]
        return literal_table(self.rows.sparkSession, rows,
                             f"{self.split_col} string, column_index int, column string, null_count bigint, nan_count bigint")

    def label_distribution(self, cells: DataFrame, positive: int = 1, negative: int = 0) -> DataFrame | None:
        """As ``profile.label_distribution`` per split, from the class counts of the cells and the observed null
        labels; None where there are other labels, whose values nothing has kept."""
        kind = dict(self.rows.dtypes)[self.label]
        at, counts, out = self.columns.index(self.label), self.counts(), []
        for r in P.label_counts(cells, [self.split_col]).collect():  # one row per split
            none = counts[r[self.split_col]]["nulls"][at]
            if r["n"] != r["p"] + r["q"] + none:
                return None
            out += [(r[self.split_col], value, n, n / r["n"] * 100)
                    for value, n in ((None, none), (negative, r["q"]), (positive, r["p"])) if n]
        return literal_table(self.rows.sparkSession, out, f"{self.split_col} string, {self.label} {kind}, count bigint, percentage double")


def observed(rows: DataFrame, split_col: str = "split", splits: Sequence[str] = ("train", "test"),
             label: str = "is_fraud") -> Observed:
    """``rows`` with an observation; use ``Observed.rows`` in the one job that reads them whole."""
    fields = [f for f in rows.schema.fields if f.name != split_col]
    floats = (T.DoubleType, T.FloatType)
    metrics = []
    for i, split in enumerate(splits):
        mine = F.col(quoted(split_col)) == split
        metrics.append(F.count_if(mine).alias(f"n_{i}"))
        for j, f in enumerate(fields):
            c = F.col(quoted(f.name))
            nan = F.count_if(mine & F.isnan(c)) if isinstance(f.dataType, floats) else F.count_if(F.lit(False))
            metrics += [F.count_if(mine & c.isNull()).alias(f"null_{i}_{j}"), nan.alias(f"nan_{i}_{j}")]
    observation = Observation()
    return Observed(rows.observe(observation, *metrics), observation, split_col, tuple(splits), label)
