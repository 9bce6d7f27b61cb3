"""Physical-plan shape: pruning, pushdown, no cartesian or nested-loop joins."""

import pytest

import __spark_entry__ as E


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["tech_production", "inspection_conversion", "chemical_usage",
                                  "ar_aging", "upsert_summary", "import_dedupe", "replace_window"])
def test_no_cartesian_or_nested_loop(spark, sf, name):
    p = _plan(E.queries()[name](spark, sf))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_scan_prunes_columns(spark, sf):
    df = E.queries()["monthly_revenue"](spark, sf)
    p = _plan(df)
    assert "o_orderpriority" not in p  # unused column never read


def _final(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _scans(plan, path):
    """The scans of one table in a final plan (the initial plan comes after it)."""
    import re
    final = plan.split("Initial Plan")[0]
    return [x for x in re.findall(r"FileScan parquet.*", final) if path in x]


@pytest.fixture(scope="module")
def stored(spark, sf):
    from fieldlake.plans import nightly
    from fieldlake.session import scratch_path
    from fieldlake.sources import sinks
    from fieldlake.sources.testdata import star
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")  # whole locations and schemas in the plans
    root = scratch_path(spark, "plans")
    tables = star(spark, sf)
    nightly.create_tables(tables, root)
    yield root, {n: sinks.read(spark, f"{root}/{n}") for n in tables}
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_stored_tables_prune_columns_and_push_filters(spark, stored):
    from fieldlake.plans import views as V
    root, t = stored
    (scan,) = _scans(_final(V.monthly_revenue(t["fact_tickets"])), "fact_tickets")
    assert "GreaterThan(total,0.0)" in scan and "IsNotNull(invoice_date)" in scan
    assert "ReadSchema: struct<invoice_date:date,total:double,balance:double,active:boolean>" in scan
    plan = _final(V.route_analysis(t["fact_appointments"], t["fact_tickets"], t["dim_employees"], t["dim_customers"],
                                   t["dim_service_types"], "1999-12-15"))
    (scan,) = _scans(plan, "fact_appointments")
    assert "PartitionFilters: [isnotnull(office_id" in scan and "EqualTo(status,0)" in scan
    assert "GreaterThanOrEqual(scheduled_date,2000-01-01)" in scan and "duration_actual_min" not in scan


def test_inspections_scan_appointments_once(spark, stored):
    from fieldlake.plans import views as V
    root, t = stored
    plan = _final(V.inspection_conversion(t["fact_appointments"], t["dim_service_types"]))
    assert len(_scans(plan, "fact_appointments")) == 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_loads_by_month_list_only_their_folders(spark, stored):
    import datetime as dt

    from fieldlake.sources import sinks
    root, _ = stored
    some = sinks.read_months(spark, f"{root}/fact_appointments", [(1, dt.date(1998, 1, 1)), (2, dt.date(1998, 1, 1))])
    files = some.inputFiles()
    assert files and all("/month=1998-01-01/" in f and "office_id=3" not in f for f in files)


def _fact_groupings(df):
    import re
    return [k for k in re.findall(r"Aggregate\(keys=\[(.*?)\], functions", _plan(df)) if "_name" not in k or "month" in k]


def test_usage_groups_lines_once_and_by_ids(spark, sf):
    facts = _fact_groupings(E.queries()["chemical_usage"](spark, sf))
    assert facts and not any("name" in k or "ticket_id" in k for k in facts)


def test_counted_usage_view_groups_by_ids(spark, sf):
    from fieldlake.plans.catalog import register_views
    from fieldlake.sources.testdata import AS_OF_AGING, star
    register_views(spark, star(spark, sf), AS_OF_AGING)
    facts = _fact_groupings(spark.table("v_chemical_usage").groupBy().count())
    assert any("month" in k for k in facts) and not any("name" in k or "ticket_id" in k for k in facts)
