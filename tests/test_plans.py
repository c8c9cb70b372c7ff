"""Plan assertions: pruning, pushdown, join strategy and partial aggregation."""

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_broadcasts_checked_aggregates_and_prunes(spark):
    p = _plan(E.queries()["enrich_profile"](spark, SF))
    assert p.count("BroadcastHashJoin") == 3
    assert "SortMergeJoin" not in p


def test_projection_reaches_scan(spark):
    p = _plan(E.queries()["kpi_cost_by_condition"](spark, SF))
    assert "ReadSchema: struct<o_totalprice:double,o_orderpriority:string>" in p or \
           "struct<o_totalprice:double,o_orderpriority:string>" in p


def test_filter_pushed_to_scan(spark):
    df = E.queries()["predicate_filters"](spark, SF)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in p and "o_orderpriority" in p


def test_partition_filter_on_snapshot(spark):
    p = _plan(E.queries()["partition_pruned_read"](spark, SF))
    assert "PartitionFilters: [isnotnull(o_orderstatus" in p


def test_aggregates_are_two_phase(spark):
    for name in ("channel_agg_rate", "kpi_two_key_count", "cohort_retention", "mart_customer_summary"):
        p = _plan(E.queries()[name](spark, SF))
        assert "partial_" in p, name


import pytest  # noqa: E402

from strata.plans import catalog  # noqa: E402
from strata.plans.tables import TABLES  # noqa: E402

FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython")


# how often a query may read a table, where that is not once
READS = {
    ("enrich_hot_key_shuffle", "supplier"): 2,  # the forced shuffle path aggregates its channel again for the hot keys' few rows
    ("freshness_next_publish", "events"): 4, ("batch_success_rate", "events"): 4,  # arrivals and publishes, rows and days of each
    ("flow_channel_rules", "part"): 3, ("mart_patient_mix", "customer"): 3, ("mart_diabetes_cohort", "part"): 3,  # separate reports in one result
}


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_every_query_plan_is_scan_once_and_jvm_only(spark, name):
    """No nested-loop/cartesian joins, no Python evaluation, and each input
    table read at most once per query (no self-joins re-scanning a base
    table; channel aggregates are materialised once)."""
    p = _plan(E.queries()[name](spark, SF))
    assert not [k for k in FORBIDDEN if k in p], name
    for t in TABLES:
        assert p.count(f"/{t}.parquet]") <= READS.get((name, t), 1), (name, t)


def test_bucketed_tables_join_without_shuffle(spark):
    from strata.session import scratch_path
    from strata.sources.tables import write_bucketed
    from strata.plans.tables import table
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        li = write_bucketed(table(spark, SF, "lineitem"), "strata_test_li", ["l_orderkey"], 8,
                            scratch_path(spark, "li_b"))
        o = write_bucketed(table(spark, SF, "orders"), "strata_test_o", ["o_orderkey"], 8,
                           scratch_path(spark, "o_b"))
        j = li.join(o, li.l_orderkey == o.o_orderkey)
        p = _plan(j)
        assert "SortMergeJoin" in p and "Exchange" not in p
        assert j.count() == table(spark, SF, "lineitem").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
