"""Steps that must not be done, read or written several times over."""

import pathlib

from pyspark.sql import functions as F

from fieldlake import registry_ops as R
from fieldlake.sources import raw, sinks, tables
from fieldlake.sources.schemas import raw_schema
from fieldlake.streaming import upsert


def _files(path):
    return [f for f in pathlib.Path(path).rglob("part-*") if not f.name.startswith(".")]


def test_a_batch_is_read_once(spark, tmp_path):
    schema, seen = raw_schema("ticket"), spark.sparkContext.accumulator(0)
    new = {"officeID": "1", "dateUpdated": "2024-01-01 00:00:00"}
    rows = [tuple((new | {"ticketID": str(k)}).get(c) for c in schema.names) for k in range(1, 21)]

    def noted(row):
        seen.add(1)
        return row

    batch = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(noted), schema)
    upsert.upsert_batch(spark, batch, str(tmp_path / "t"), "ticket", "2024-01-09 00:00:00")
    assert seen.value == len(rows) == sinks.read(spark, str(tmp_path / "t")).count()


def test_no_batch_stays_staged(spark, tmp_path, monkeypatch):
    batch = spark.createDataFrame([("1", "7")], "officeID string, ticketID string").select(
        *[c if c in ("officeID", "ticketID") else F.lit(None).cast(raw_schema("ticket")[c].dataType).alias(c)
          for c in raw_schema("ticket").names])
    staged = str(tmp_path / "staged")
    monkeypatch.setattr(upsert, "scratch_path", lambda spark, name: staged)
    upsert.upsert_batch(spark, batch, str(tmp_path / "t"), "ticket", "2024-01-09 00:00:00")
    assert not pathlib.Path(staged).exists()


def test_landings_are_compressed(spark, tmp_path):
    R._land_json(spark.createDataFrame([("1", "a"), ("2", None)], "customerID string, fname string"), str(tmp_path / "l"))
    assert _files(tmp_path / "l") and all(f.name.endswith(".json.gz") for f in _files(tmp_path / "l"))
    got = raw.read_raw(spark, "customer", str(tmp_path / "l")).select("customerID", "fname").collect()
    assert sorted(map(tuple, got)) == [("1", "a"), ("2", None)]


def test_join_with_no_stored_rows_shuffles_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_by_id(spark.createDataFrame([(1, 5)], "office_id long, ticket_id long"), path, "ticket_id")
    none = tables.read(spark, path, only=lambda name: False)
    rows = spark.range(10).select(F.lit(1).cast("long").alias("office_id"), F.col("id").alias("ticket_id"))
    kept = rows.join(none, ["office_id", "ticket_id"], "left_anti")
    assert "Join" not in kept._jdf.queryExecution().optimizedPlan().toString() and kept.count() == 10


def test_landed_lines_are_staged_once(spark, tmp_path, monkeypatch):
    src, staged = tmp_path / "lines", str(tmp_path / "staged")
    src.mkdir()
    (src / "a.json").write_text('{"customerID":"1","fname":"A"}\n{"customerID":"2","fn\n{"customerID":"3","odd":1}\n')
    monkeypatch.setattr("fieldlake.session.scratch_path", lambda spark, name: staged)
    report = {(r.what, r.field): r.lines for r in raw.land(spark, "customer", str(src), str(tmp_path / "out")).collect()}
    assert report == {("records", None): 2, ("quarantined", None): 1, ("unknown field", "odd"): 1}
    assert spark.read.parquet(staged).filter("value IS NOT NULL AND r IS NOT NULL").isEmpty()
    assert [r.value for r in sinks.read(spark, str(tmp_path / "out/quarantine")).collect()] == ['{"customerID":"2","fn']
    assert sorted(r.customerID for r in sinks.read(spark, str(tmp_path / "out/records")).collect()) == ["1", "3"]


def test_a_month_is_not_written_by_every_task(spark, tmp_path):
    path, months = str(tmp_path / "t"), 6
    rows = spark.range(0, 240, 1, 8).select(
        F.col("id").alias("appointment_id"), (F.col("id") % 2).alias("office_id"),
        F.add_months(F.lit("2024-01-01").cast("date"), (F.col("id") % months).cast("int")).alias("scheduled_date"))
    sinks.write_fact(rows, path)
    assert len(_files(f"{path}/rows")) == months  # ids of a month are of one office
    sinks.replace_months(spark, path, rows.repartition(8), [], None, "appointment_id")
    last = [f"{path}/rows/{f}" for f in tables.latest(spark, path).parts["rows"].folders]
    assert sum(len(_files(f)) for f in last) == months and sinks.read(spark, path).count() == 240


def test_tickets_are_nested_once_for_all_searches(spark, sf, monkeypatch):
    asked, load = [], R.load
    monkeypatch.setattr(R, "load", lambda s, d, name: asked.append(name) or load(s, d, name))
    fetch = R._fetch(spark, sf)
    for office in (1, 2, 3):
        want = load(spark, sf, "raw_tickets_nested").filter(F.col("officeID") == str(office))
        got = fetch("ticket", office)
        assert got.schema == want.schema or got.columns == want.columns
        plain = lambda df: sorted(str(r.asDict(True) | {"items": sorted(map(str, r["items"] or []))}) for r in df.collect())
        assert plain(got) == plain(want) and got.count()
    assert asked.count("raw_tickets_nested") == 1
