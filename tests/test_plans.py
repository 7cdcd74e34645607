"""Plan assertions: the job is one lazy plan with a single shuffle (the
dedupe), no Python UDF, and the state filter below that shuffle."""

from segflow.plans import queries
from tests.conftest import SF001


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_job_has_no_python_and_one_exchange(spark):
    df = queries.adt_state_filter(spark, SF001)
    plan = _plan(df)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "PythonUDF" not in plan
    # dedupe shuffle only (the broadcast of the small customer table is the
    # fixture's join, not part of the job)
    assert plan.count("Exchange hashpartitioning") == 1


def test_state_is_read_once_below_the_dedupe_shuffle(spark):
    text = _optimized(queries.adt_state_filter(spark, SF001))
    above, below = text.split("Aggregate", 1)
    # one filter, on the generated state column, and none above the dedupe
    assert "Filter" not in above
    assert below.count("Filter __state") == 1
    assert below.index("Filter __state") < below.index("Generate inline(array(named_struct(__state") \
        or below.index("Filter __state") < below.index("Generate")


def test_flatten_is_projection_only(spark):
    plan = _plan(queries.adt_flatten(spark, SF001))
    assert plan.count("Exchange hashpartitioning") == 1   # the dedupe
    assert "SortMergeJoin" not in plan and "Window" not in plan


def test_long_form_uses_generators_not_shuffles(spark):
    plan = _plan(queries.adt_segment_long(spark, SF001))
    assert "Generate" in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_latest_patient_is_partial_aggregate(spark):
    plan = _plan(queries.adt_latest_patient(spark, SF001))
    assert "partial_max_by" in plan
    assert "Window" not in plan
    assert plan.count("Exchange hashpartitioning") == 1      # per patient only


def test_new_referrals_pre_aggregates_both_sides(spark):
    plan = _plan(queries.adt_new_referrals(spark, SF001))
    assert "LeftAnti" in plan
    assert plan.count("partial_count") >= 1


def test_ignore_lists_are_hash_set_filters(spark):
    opt = _optimized(queries.adt_ignore_lists(spark, SF001))
    assert "INSET" in opt.upper()
    assert "Join" not in opt.split("Generate")[0]
