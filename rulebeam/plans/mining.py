"""Entry point 2: mine on train, validate on test, shape the outputs.

One scan builds the cells of both splits; the cells are written once to the
shared checkpoint folder and every later step reads that small table.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.cells import build_cells, split_cells
from ..operators.mine import mine, top_n
from ..operators.observed import Observed, observed
from ..operators.profile import composition, dataset_shape
from ..operators.report import run_summary
from ..operators.validate import stability, validate
from ..session import delete_path, materialize, scratch_path
from ..spec import PatternSpec


@dataclass
class MiningRun:
    """Lazily computed stages of one mining run over rows with a split column."""

    rows: DataFrame
    spec: PatternSpec
    split_col: str = "split"
    train: str = "train"
    test: str = "test"
    observe: bool = False  # count shape and nulls in the scan that builds the cells

    @cached_property
    def workdir(self) -> str:
        """This run's folder under the shared checkpoint folder."""
        return scratch_path(self.rows.sparkSession, "run")

    @cached_property
    def observed(self) -> Observed:
        """The observation of the scan that builds the cells (``observe``)."""
        return observed(self.rows, self.split_col, (self.train, self.test), self.spec.label)

    @cached_property
    def cells(self) -> DataFrame:
        # One folder per split: the train and test reads each scan only their half.
        rows = self.observed.rows if self.observe else self.rows
        return materialize(build_cells(rows, self.spec, by=[self.split_col]), "cells",
                           partition_by=(self.split_col,), base=self.workdir)

    @cached_property
    def train_cells(self) -> DataFrame:
        return split_cells(self.cells, self.train, self.split_col)

    @cached_property
    def test_cells(self) -> DataFrame:
        return split_cells(self.cells, self.test, self.split_col)

    @cached_property
    def patterns(self) -> DataFrame:
        return materialize(mine(self.train_cells, self.spec, self.workdir), "patterns", base=self.workdir)

    @property
    def top(self) -> DataFrame:
        return top_n(self.patterns, self.spec.top_n)

    @cached_property
    def validated(self) -> DataFrame:
        top = top_n(self.patterns, self.spec.validate_n)  # at most validate_n rows: broadcast
        done = stability(validate(top, self.test_cells, self.spec, bounded=True), self.spec)
        return materialize(done, "validated", base=self.workdir)

    def summary(self, run_id: str | None = None) -> DataFrame:
        comp = composition(self.train_cells)
        test_rows = self.test_cells.agg(F.sum("n").alias("n_rows"))
        return run_summary(comp, test_rows, self.patterns, self.validated, run_id)

    def shape(self) -> DataFrame:
        return dataset_shape(self.rows, by=[self.split_col])

    def release(self) -> bool:
        """Delete this run's intermediate tables. DataFrames of the run are
        unusable afterwards; export results first."""
        deleted = delete_path(self.rows.sparkSession, self.workdir)
        for name in ("cells", "train_cells", "test_cells", "patterns", "validated", "observed", "workdir"):
            self.__dict__.pop(name, None)
        return deleted


def run_from_files(spark, train_path: str, test_path: str, spec: PatternSpec | None = None,
                   fmt: str = "csv", schema=None, max_rejected: float | None = None) -> MiningRun:
    """Entry point 2 from two transaction files: read (S1/S2), stack with a
    split column (S5), derive features, and return the lazy run.

    With ``max_rejected`` (CSV) bad records are left out as long as they are at most this share of either file
    (``read_checked`` lists them); without it the first one fails the job."""
    from ..functions.features import add_features
    from ..sources.transactions import TRANSACTION_SCHEMA, Holdout, read_checked, read_transactions

    schema = schema if schema is not None else (TRANSACTION_SCHEMA if fmt == "csv" else None)

    def read(path):
        if max_rejected is None or fmt != "csv":
            return read_transactions(spark, path, fmt, schema)
        return read_checked(spark, path, schema).within(max_rejected).rows

    rows = add_features(Holdout(read(train_path), read(test_path)).stacked())
    return MiningRun(rows, spec if spec is not None else PatternSpec())


def export(run: MiningRun, results_dir: str, run_id: str | None = None, fmt: str = "csv") -> str:
    """K1-K5: publish the all, top-N, validation and summary tables of a run together."""
    from ..sinks import writers as K
    from ..sinks.publish import Publication

    with Publication(run.rows.sparkSession, results_dir, run_id) as out:
        K.stage_patterns(out, run.patterns, run.spec.top_n, fmt)
        K.stage_validation(out, run.validated, fmt)
        out.write(K.to_summary_shape(run.summary(out.run_id)), "summary", fmt)
    return out.run_id
