"""Load operators: idempotence, office isolation, backfill scoping, calendar."""

from pyspark.sql import functions as F

from fieldlake.operators import load as L
from fieldlake.registry_ops import WINDOW, window_incoming
from fieldlake.sources.testdata import load


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_replace_window_idempotent_and_isolated(spark, sf):
    office, start, end = WINDOW
    existing, incoming = load(spark, sf, "fact_appointments"), window_incoming(spark, sf)
    once = L.replace_window(existing, incoming, office, start, end, keys=["office_id", "appointment_id"])
    twice = L.replace_window(once, incoming, office, start, end, keys=["office_id", "appointment_id"])
    assert once.count() == 1499
    assert _rows(once) == _rows(twice)
    other = "office_id <> 1 OR scheduled_date NOT BETWEEN '1999-12-01' AND '1999-12-31'"
    assert _rows(existing.filter(other)) == _rows(once.filter(other))


def test_replace_window_empty_incoming_is_noop(spark, sf):
    existing = load(spark, sf, "fact_appointments")
    out = L.replace_window(existing, existing.limit(0), *WINDOW)
    assert out.count() == existing.count()


def test_vanished_are_the_dropped_tenth(spark, sf):
    office, start, end = WINDOW
    ids = L.vanished_ids(load(spark, sf, "fact_appointments"), window_incoming(spark, sf), office, start, end)
    assert ids.count() > 0 and ids.filter(F.col("appointment_id") % 10 != 0).count() == 0


def test_backfill_is_office_scoped(spark, sf):
    existing = load(spark, sf, "fact_appointments")
    incoming = existing.withColumn("status", F.lit(9).cast("long"))
    parts = spark.createDataFrame([(1, "1998-01-01")], "office_id long, month string") \
        .withColumn("month", F.col("month").cast("date"))
    out = L.backfill(existing, incoming, parts)
    assert out.count() == existing.count()
    changed = out.filter("status = 9")
    assert changed.filter("office_id <> 1").count() == 0
    assert changed.count() == existing.filter("office_id = 1 AND trunc(scheduled_date, 'month') = DATE'1998-01-01'").count()


def test_calendar_and_refresh_day(spark):
    cal = L.backfill_calendar(spark, "1999-12-15")
    assert cal.count() == 61 * 2
    assert cal.agg(F.min("month_start")).first()[0].isoformat() == "1994-12-01"
    assert L.is_refresh_day("2024-06-03") and not L.is_refresh_day("2024-06-04")
    assert L.is_refresh_day("2024-06-04", forced=True)


def test_sync_summary_marks_failed_office(spark, sf):
    a = load(spark, sf, "fact_appointments")
    offices = spark.createDataFrame([(1,), (2,)], "office_id long")
    errors = spark.createDataFrame([(2, "boom")], "office_id long, error_message string")
    s = {r["office_id"]: r for r in L.sync_summary({"appointments": a}, "2000-01-03 06:00:00", 2, offices,
                                                  errors).collect()}
    assert s[2]["status"] == "error"
    assert s[2]["appointments_synced"] == a.filter("office_id = 2").count()  # loaded before the error
    assert s[1]["status"] == "success" and s[1]["appointments_synced"] == a.filter("office_id = 1").count()


def test_loads_keep_the_other_office(spark):
    child = "item_id long, office_id long, ticket_id long"
    items = spark.createDataFrame([(1, 1, 7), (2, 2, 7), (3, 1, 8)], child)
    parents = spark.createDataFrame([(1, 7)], "office_id long, ticket_id long")
    assert _rows(L.replace_children(items, spark.createDataFrame([(9, 1, 7)], child), parents)) == [
        (2, 2, 7), (3, 1, 8), (9, 1, 7)]
    d = "appointment_id long, office_id long, scheduled_date string"
    stored = spark.createDataFrame([(1, 1, "2024-01-05"), (2, 1, "2024-01-05"), (2, 2, "2024-01-05")], d) \
        .withColumn("scheduled_date", F.col("scheduled_date").cast("date"))
    active = spark.createDataFrame([(1, 1), (2, 2)], "appointment_id long, office_id long")
    gone = L.vanished_ids(stored, active, 1, "2024-01-01", "2024-01-31")
    assert _rows(gone.select("office_id", "appointment_id")) == [(1, 2)]
    raw = spark.createDataFrame([("2", "1"), ("2", "2"), ("1", "1")], "appointmentID string, officeID string")
    assert _rows(L.refetch(raw, gone)) == [("2", "1")]
    routes = spark.createDataFrame([("5", "1", "2024-01-05", "11"), ("5", "2", "2024-01-05", "22")],
                                   "routeID string, officeID string, date string, assignedTech string")
    got = L.route_tech(routes, "2024-01-01", "2024-01-31")
    assert _rows(got.select("office_id", "route_id", "route_tech_id")) == [(1, 5, 11), (2, 5, 22)]


def test_pending_follows_the_ledger_not_the_rows(spark):
    cal = L.backfill_calendar(spark, "1999-12-15", years=0)
    ledger = spark.createDataFrame([(1, "1999-12-01")], "office_id long, month_start string") \
        .withColumn("month_start", F.col("month_start").cast("date"))
    assert _rows(L.backfill_pending(cal, ledger).select("office_id", "month_key")) == [(2, "1999-12-office2")]
