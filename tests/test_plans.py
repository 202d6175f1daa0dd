"""Plan checks: the physical plans are the ones the design claims."""
import pytest

from quaybook.operators import clean, curves, metrics, split
from quaybook.operators import quality as Q
from quaybook.plans import stages
from quaybook.plans.queries import QUERIES, raw
from conftest import SF001

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "FlatMapGroupsInArrow",
                "FlatMapCoGroupsInPandas", "MapInPandas", "MapInArrow")
#: Operators that pool or walk a bounded part in Python, by their own choice.
WITH_PYTHON = {"k2_isotonic", "k2_isotonic_doc_length"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WITH_PYTHON))
def test_no_python_in_plans(spark, name, monkeypatch):
    """Neither in the query's plan nor in that of any stage it writes."""
    plans = []
    written = stages.write_stage

    def write(df, stage):
        plans.append(_plan(df))
        return written(df, stage)

    for module in (stages, split, metrics, clean, curves):
        monkeypatch.setattr(module, "write_stage", write)
    plans.append(_plan(QUERIES[name](spark, SF001)))
    assert not [node for plan in plans for node in PYTHON_NODES if node in plan], name


def test_one_run_is_read_from_its_partition(spark):
    df = QUERIES["r2_cv_of_run"](spark, SF001)
    assert "PartitionFilters: [isnotnull(run_id" in df._jdf.queryExecution().toString()
    assert "param_model__learning_rate" in df.columns


def test_ranking_windows_are_cut_by_range(spark):
    plan = QUERIES["s3_folds_all_rows"](spark, SF001)._jdf.queryExecution().toString()
    assert "windowspecdefinition(__label" in plan and "__range" in plan


def test_row_checks_compile_to_one_aggregate(spark):
    df = raw(spark, SF001)
    row_checks = [k for k in Q.build_suite() if k.kind in Q.ROW_KINDS]
    plan = _plan(Q.run_suite(df, row_checks, with_examples=False))
    assert plan.count("HashAggregate(") == 2  # one partial + one final, one pass


def test_c1_is_one_shuffle_with_partial_aggregation(spark):
    from quaybook.operators.clean import drop_duplicate_rows
    df = raw(spark, SF001)
    d = drop_duplicate_rows(df)
    d.collect()
    plan = d._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("HashAggregate(") == 2


def test_examples_are_group_limited_on_both_sides_of_the_shuffle(spark):
    df = raw(spark, SF001)
    types = {f.name: f.dataType for f in df.schema.fields}
    ex = Q._examples(df, Q.build_suite(), types)
    ex.collect()
    plan = ex._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # a partial limit before the exchange and a final one after it
    assert plan.count("WindowGroupLimit") >= 2


def test_c3_shuffles_whole_rows_once(spark, monkeypatch):
    """In writing its input; the result is a scan with C3's filters."""
    plans, written = [], clean.write_stage

    def write(df, stage):
        out = written(df, stage)
        plans.append(_plan(df))
        return out

    monkeypatch.setattr(clean, "write_stage", write)
    out = clean.drop_rows_with_low_missingness(clean.drop_missing_target(clean.drop_duplicate_rows(raw(spark, SF001))))
    assert len(plans) == 1 and plans[0].count("Exchange hashpartitioning") == 1
    assert "Exchange" not in _plan(out) and "PushedFilters: [IsNotNull" in out._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", ["r10_roc", "r10_roc_line_share"])
def test_roc_neighbours_come_without_a_self_join(spark, name):
    plan = _plan(QUERIES[name](spark, SF001))
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert plan.count("BroadcastHashJoin") == 1  # one row a bucket


def test_calibration_reads_the_scores_for_counts_only(spark, monkeypatch):
    written = []
    monkeypatch.setattr(curves, "write_stage", lambda df, name: written.append(name) or stages.write_stage(df, name))
    out = QUERIES["r14_calibration_line_share"](spark, SF001)
    assert written == ["calibration"] and _plan(out).count("ReadSchema: ") == 1
