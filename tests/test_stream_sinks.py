"""Streaming upsert and sinks."""

import datetime as dt

import pytest

from fieldlake.registry_ops import RUN_AT, stream_landing
from fieldlake.session import scratch_path
from fieldlake.sources import sinks
from fieldlake.sources.testdata import load
from fieldlake.streaming.upsert import start_upsert_stream


def _rows(df):
    return sorted(tuple(r) for r in df.drop("loaded_at").collect())


def test_stream_restart_emits_nothing_new(spark, sf):
    landing, table, ckpt = (scratch_path(spark, n) for n in ("l", "t", "c"))
    stream_landing(spark, sf, landing)
    q = start_upsert_stream(spark, landing, table, "customer", ckpt, RUN_AT)
    q.awaitTermination()
    first = _rows(sinks.read(spark, table))
    q2 = start_upsert_stream(spark, landing, table, "customer", ckpt, RUN_AT)
    q2.awaitTermination()
    assert q2.lastProgress is None or q2.lastProgress["numInputRows"] == 0
    assert _rows(sinks.read(spark, table)) == first
    changed = sinks.read(spark, table).filter("(customer_id - 1) % 10 = 0")
    assert changed.filter("email NOT LIKE 'changed%'").count() == 0


def test_stream_equals_one_batch(spark, sf):
    landing, t1, t2, c1 = (scratch_path(spark, n) for n in ("l", "t1", "t2", "c1"))
    stream_landing(spark, sf, landing)
    start_upsert_stream(spark, landing, t1, "customer", c1, RUN_AT).awaitTermination()
    from fieldlake.sources.raw import read_raw
    from fieldlake.streaming.upsert import upsert_batch
    upsert_batch(spark, read_raw(spark, "customer", landing), t2, "customer", RUN_AT)
    assert _rows(sinks.read(spark, t1)) == _rows(sinks.read(spark, t2))


def test_overwrite_guard_and_self_overwrite(spark, sf):
    path = scratch_path(spark, "dim")
    df = load(spark, sf, "dim_products")
    assert sinks.overwrite(df, path)
    assert not sinks.overwrite(df.limit(0), path)
    assert sinks.read(spark, path).count() == df.count()
    again = sinks.read(spark, path).filter("product_id % 2 = 0")
    assert sinks.overwrite(again, path)  # reads and rewrites the same folder
    assert sinks.read(spark, path).count() == df.filter("product_id % 2 = 0").count()


def test_ensure_tables(spark):
    root = scratch_path(spark, "tables")
    first = {r[0]: r[1] for r in sinks.ensure_tables(spark, root).collect()}
    second = {r[0]: r[1] for r in sinks.ensure_tables(spark, root).collect()}
    assert set(first.values()) == {"created"} and set(second.values()) == {"existing"}
    assert len(first) == 9


def test_partitioned_window_load(spark, sf):
    from pyspark.sql import functions as F

    from fieldlake.operators.load import replace_window
    from fieldlake.registry_ops import WINDOW, window_incoming
    office, start, end = WINDOW
    path = scratch_path(spark, "facts")
    facts = load(spark, sf, "fact_appointments")
    assert sinks.write_fact(facts, path)
    incoming = window_incoming(spark, sf)
    assert sinks.load_window(spark, path, incoming, office, start, end)
    got = sinks.read_fact(spark, path).drop("month")
    want = replace_window(facts, incoming, office, start, end)
    assert _rows(got.select(*facts.columns)) == _rows(want)
    # a window whose rows all vanish leaves no stale partition behind
    nov = facts.filter((F.col("office_id") == 2) & F.col("scheduled_date").between("1998-11-01", "1998-11-30"))
    keep_one = nov.limit(1).withColumn("scheduled_date", F.lit("1998-12-05").cast("date"))
    assert sinks.load_window(spark, path, keep_one, 2, "1998-11-01", "1998-12-31")
    left = sinks.read_fact(spark, path).filter("office_id = 2 AND month = DATE'1998-11-01'")
    assert left.count() == 0


def test_run_log_sinks(spark, sf):
    from fieldlake.operators import contacts as G
    from fieldlake.operators import load as L
    from fieldlake.registry_ops import crm_existing
    raw = load(spark, sf, "raw_customers")
    deduped = G.import_dedupe(G.contactable(G.contacts_import(raw)), crm_existing(spark, sf))
    review = G.duplicate_review(deduped)
    p = scratch_path(spark, "review")
    sinks.write_review(review, p)
    back = spark.read.option("header", True).csv(p)
    assert back.columns == ["fr_id", "name", "email", "phone", "matched_on", "office"]
    assert back.count() == review.count()
    logp = scratch_path(spark, "importlog")
    plan = G.import_plan(raw, None, crm_existing(spark, sf), raw.limit(0).selectExpr("customerID AS fr_id"),
                         dry_run=False)
    sinks.write_import_log(plan, logp, RUN_AT)
    assert spark.read.json(f"{logp}/entries").count() == plan.count()
    stats = {r["action"]: r["customers"] for r in spark.read.json(f"{logp}/stats").collect()}
    assert stats["created"] == 49
    hp = scratch_path(spark, "health")
    offices = spark.createDataFrame([(1,), (2,)], "office_id long")
    health = L.sync_summary({"appointments": load(spark, sf, "fact_appointments")}, RUN_AT, 2, offices)
    sinks.write_health(health, hp)
    sinks.write_health(health, hp)
    assert sinks.read(spark, hp).count() == 4


def _fact(spark, rows):
    return spark.createDataFrame(rows, "appointment_id long, office_id long, scheduled_date date")


def test_failed_write_keeps_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.overwrite(spark.range(10), path)
    bad = spark.range(100).selectExpr("if(id = 99, raise_error('stop'), id) AS id")
    with pytest.raises(Exception):
        sinks.overwrite(bad, path, allow_empty=True)
    assert sinks.read(spark, path).count() == 10


def test_window_load_of_moved_undated_and_officeless_rows(spark, tmp_path):
    d, path = dt.date, str(tmp_path / "f")
    old = [(1, 1, d(2024, 1, 5)), (2, 1, d(2024, 5, 5)), (2, 2, d(2024, 5, 5)), (3, 1, None), (4, None, d(2024, 1, 9)),
           (5, 1, d(2024, 1, 20))]
    sinks.write_fact(_fact(spark, old), path)
    new = [(2, 1, d(2024, 1, 7)), (6, 1, None), (7, None, None)]
    assert sinks.load_window(spark, path, _fact(spark, new), 1, "2024-01-01", "2024-01-31")
    got = sorted(map(str, (tuple(r) for r in sinks.read_fact(spark, path).select(
        "appointment_id", "office_id", "scheduled_date").collect())))
    assert got == sorted(map(str, [(2, 1, d(2024, 1, 7)), (2, 2, d(2024, 5, 5)), (3, 1, None), (4, None, d(2024, 1, 9)),
                                   (6, 1, None), (7, None, None)]))


def test_late_file_keeps_the_newer_row(spark, sf):
    from pyspark.sql import functions as F

    from fieldlake.streaming.upsert import upsert_batch
    path = scratch_path(spark, "late")
    raw = load(spark, sf, "raw_customers")
    stamped = lambda when, mail: raw.withColumn("dateUpdated", F.lit(when)).withColumn("email", F.lit(mail))
    upsert_batch(spark, stamped("2024-01-01 00:00:00", "new@x.com"), path, "customer", RUN_AT)
    n = sinks.read(spark, path).count()
    upsert_batch(spark, stamped("2020-01-01 00:00:00", "old@x.com"), path, "customer", RUN_AT)
    upsert_batch(spark, stamped(None, "none@x.com"), path, "customer", RUN_AT)
    got = sinks.read(spark, path)
    assert got.count() == n and got.filter("email <> 'new@x.com'").count() == 0
    upsert_batch(spark, stamped("2024-01-01 00:00:00", "again@x.com"), path, "customer", RUN_AT)
    assert sinks.read(spark, path).filter("email <> 'again@x.com'").count() == 0
