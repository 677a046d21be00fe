"""Physical-plan checks: one raw shuffle, pruned scans, no cross joins, no
Python evaluation in any registered query."""

import pytest

from conftest import SF001
from __spark_entry__ import queries
from rulebeam.operators.cells import build_cells
from rulebeam.plans.registry import txn
from rulebeam.spec import event_spec

FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")
# Driver-side plan text of a finished query (AQE final plan, subqueries included).
SKIP = {"export_roundtrip", "streaming_cells"}  # their returned frames only read written files


def plan_text(df) -> str:
    """Physical plan text after execution: AQE final and initial plans of the
    query and of every subquery."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_cells_single_shuffle_and_pruned_scan(spark):
    plan = plan_text(build_cells(txn(spark, SF001), event_spec(), by=["split"])).split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1
    # the whole map side (scan, features, partial aggregate) is one codegen stage
    assert plan.count("*(1)") >= 4
    assert "partial_count" in plan
    # the scan reads only what the features need (props is never read)
    assert "props" not in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in plan


@pytest.mark.parametrize("name", sorted(set(queries()) - SKIP))
def test_no_cross_join_or_python(spark, name):
    text = plan_text(queries()[name](spark, SF001))
    for op in FORBIDDEN:
        assert op not in text, f"{name}: {op} in plan"


def test_extension_and_validation_are_equi_joins(spark, run01):
    """Level-3 extension and test re-measurement: broadcast hash joins on the
    first item (bases / top-N are bounded), no nested-loop join."""
    from pyspark.sql import functions as F
    from rulebeam.operators.cells import total_columns
    from rulebeam.operators.mine import extend_patterns, top_n
    from rulebeam.operators.validate import validate

    cells, spec = run01.train_cells, run01.spec
    n_total, p_total = total_columns(cells)
    bases = run01.patterns.filter(F.col("level") == 2).filter(F.col("level_rank") <= spec.beam)
    ext = plan_text(extend_patterns(cells, bases, spec, 3, n_total, p_total))
    val = plan_text(validate(top_n(run01.patterns, 10), run01.test_cells, spec, bounded=True))
    for text in (ext, val):
        assert "BroadcastHashJoin" in text
        for op in FORBIDDEN:
            assert op not in text
