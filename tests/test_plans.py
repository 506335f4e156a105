"""Plan checks: what Catalyst must do with the library's plans."""

from casestar.operators import dimensions as D
from casestar.operators import facts as FA
from casestar.plans import testviews as TV


FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct",
             "BroadcastNestedLoopJoin")


def plan_text(df):
    qe = df._jdf.queryExecution()
    return qe.optimizedPlan().toString() + qe.executedPlan().toString()


def test_sparse_export_has_no_outer_join(spark, small_dir):
    facts = FA.case_facts(TV.case_reports(spark, small_dir))
    bridge = D.geo_time_keys(D.geo_dim(facts), D.date_dim(facts))
    sparse = FA.densify(D.dense_span(bridge, facts), facts).filter("Anzahl <> 0")
    opt = sparse._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" not in opt and "Inner" in opt


def test_outer_joins_become_left_joins(spark, small_dir):
    facts = FA.case_facts(TV.case_reports(spark, small_dir))
    geo = D.geo_dim(facts, TV.districts(spark, small_dir), TV.district_category(spark, small_dir))
    opt = geo._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in opt and "LeftOuter" in opt


def test_fact_sum_combines_map_side(spark, small_dir):
    """Both fact sums aggregate partially before their shuffle (hot keys)."""
    wide = FA.normalise_and_sum(TV.case_reports(spark, small_dir))
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_sum") >= 2


def test_star_does_not_shuffle_the_facts(spark, small_dir):
    """Whatever the facts' size, the written ranks are broadcast to them."""
    from casestar.plans.queries import _shared_facts
    facts = _shared_facts(spark, small_dir)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        plan = FA.star_facts(facts)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan.split(
        "Subquery")[0]


def test_sparse_sink_builds_no_span(spark, small_dir):
    from casestar.plans.queries import _shared_facts
    facts = _shared_facts(spark, small_dir)
    assert "Generate" not in FA.star_facts(facts)._jdf.queryExecution().optimizedPlan().toString()
