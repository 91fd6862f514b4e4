"""Plan shape of every registered query: no Cartesian products, no nested-loop
joins, no Python evaluation; feed scans push filters and prune columns."""

import datetime as dt

import pytest

import __spark_entry__ as entry
from voltlake.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    df = entry.queries()[name](spark, SF)
    qe = df._jdf.queryExecution()
    text = qe.optimizedPlan().toString() + "\n" + qe.executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in text, f"{name}: {op}"


def test_feed_scan_pushdown_and_pruning(spark):
    from voltlake.sources import fixtures as fx
    w = fx.feeds(spark, SF)["weather"]
    plan = w._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)]" in plan
    assert "props" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_sql_reports_bind_parameters(spark):
    from voltlake.plans import reports, sql_reports
    from voltlake.plans.catalogue import measurements_fact
    fact = measurements_fact(spark, SF).cache()
    z = "EE"
    hours = [r.hourly_datetime for r in reports.available_hours(fact).collect()]
    assert [r.hourly_datetime for r in sql_reports.available_hours(fact).collect()] == hours
    assert [r.bzn for r in sql_reports.zone_list(fact).collect()] == [r.bzn for r in reports.zone_list(fact).collect()]
    a = sql_reports.zone_series(fact, z, hours[0], hours[-1] + dt.timedelta(hours=1)).collect()
    b = reports.zone_series(fact, z, hours[0], hours[-1] + dt.timedelta(hours=1)).collect()
    assert a == b
    h = hours[5]
    assert sorted(map(tuple, sql_reports.green_share(fact, h).collect())) == \
        sorted(map(tuple, reports.green_share(fact, h, decimals=4).collect()))
    # an injected value is just a non-matching literal
    assert sql_reports.zone_series(fact, "EE' OR '1'='1", hours[0], hours[-1]).count() == 0
    fact.unpersist()


@pytest.mark.parametrize("name", ["consumption_keep_first", "production_wide", "green_share_zone_hour",
                                  "unit_dim", "condition_dim"])
def test_aggregations_combine_before_shuffle(spark, name):
    """Hot keys are collapsed map-side: every grouping runs a partial
    aggregate below its exchange."""
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_" in plan, plan[:2000]


def test_fact_rows_equal_weather_grid(spark):
    from voltlake.plans import fact as fact_plan
    from voltlake.sources import fixtures as fx
    f = fx.feeds(spark, SF)
    grid = fact_plan.weather_grid(f["weather"])
    fact = fact_plan.build_fact(f["consumption"], f["production"], f["price"], f["weather"])
    assert fact.count() == grid.count()
    assert fact.filter("price IS NULL OR consumption_quantity IS NULL").count() == 0
