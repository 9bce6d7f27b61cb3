"""Committed tables: failures at every step of a write, what loads open, the
index of moved rows, and the replay of stream batches."""

import datetime as dt
import os
import pathlib

import pytest
from pyspark.sql import functions as F

from fieldlake.operators.quality import REJECT_RULES
from fieldlake.sources import sinks, tables


class Stop(Exception):
    pass


def _ids(spark, path):
    return sorted(r[0] for r in sinks.read(spark, path).select("id").collect())


STEPS = ("_stage", "_put", "_clean", "create", "rename", "delete")


@pytest.mark.parametrize("keys", [(), ("part",)])
@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("after", [False, True])
def test_a_failure_at_any_step_leaves_old_or_new_rows(spark, tmp_path, monkeypatch, step, keys, after):
    """The step fails before or after what it does; the table is whole either
    way, and the next write goes on and cleans up."""
    path = str(tmp_path / "t")
    old = spark.range(10).withColumn("part", F.col("id") % 3)
    new = spark.range(100, 104).withColumn("part", F.lit(1).cast("long"))
    for _ in range(3):  # so that there is something to clean
        sinks.overwrite(old, path, keys, allow_empty=True)
    before = _ids(spark, path)
    want = sorted([x for x in before if keys and x % 3 != 1] + [100, 101, 102, 103])

    def failing(real):
        def run(*a, **k):
            if after:
                real(*a, **k)
            raise Stop(step)
        return run

    with monkeypatch.context() as m:
        if step.startswith("_"):
            m.setattr(tables, step, failing(getattr(tables, step)))
        else:  # a call of the file system
            real = tables._fs

            class Fs:
                def __init__(self, fs):
                    self.fs = fs

                def __getattr__(self, name):
                    return failing(getattr(self.fs, name)) if name == step else getattr(self.fs, name)

            m.setattr(tables, "_fs", lambda s, p: Fs(real(s, p)))
        with pytest.raises(Stop):
            sinks.overwrite(new, path, keys)
    assert _ids(spark, path) in (before, want)
    committed = (step in ("_clean", "delete")) or (step in ("_put", "rename") and after)
    assert _ids(spark, path) == (want if committed else before)
    assert sinks.overwrite(new, path, keys)
    assert _ids(spark, path) == want
    sinks.overwrite(new, path, keys)
    sinks.overwrite(new, path, keys)
    held = {f for n in tables._commits(spark, path) for f in tables._load(spark, path, n).parts["rows"].folders}
    on_disk = {str(p.parent.relative_to(f"{path}/rows")) for p in pathlib.Path(path).rglob("*.parquet")}
    assert on_disk <= held and len(tables._commits(spark, path)) == tables.KEPT


def test_a_reader_that_began_before_a_commit_ends(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite(spark.range(10), path)
    begun = sinks.read(spark, path)
    sinks.overwrite(spark.range(5), path)
    assert begun.count() == 10 and sinks.read(spark, path).count() == 5


def test_a_second_writer_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite(spark.range(10), path)
    late = tables.Commit(1, tables.latest(spark, path).parts)
    with pytest.raises(OSError):
        tables._put(spark, path, late)
    assert sinks.read(spark, path).count() == 10


def test_append_counts_and_skips_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.append(spark.range(4), path) == 4
    n = tables.latest(spark, path).number
    assert sinks.append(spark.range(0), path) == 0 and tables.latest(spark, path).number == n
    assert sinks.append(spark.range(3), path) == 3 and sinks.read(spark, path).count() == 7
    with pytest.raises(FileNotFoundError):
        sinks.read(spark, str(tmp_path / "none"))


# loads open only what they touch --------------------------------------------

def _facts(spark, rows):
    return spark.createDataFrame(rows, "appointment_id long, office_id long, scheduled_date date")


def _spoil(path, keep):
    """Make every data file unreadable but those of the kept partitions."""
    for f in pathlib.Path(path).rglob("*.parquet"):
        if not any(k in str(f) for k in keep):
            f.write_bytes(b"spoilt")
            crc = f.with_name(f".{f.name}.crc")
            if crc.exists():
                os.remove(crc)


def test_window_load_opens_only_touched_folders(spark, tmp_path):
    d, path = dt.date, str(tmp_path / "f")
    rows = [(k, k % 2 + 1, d(2024, k % 12 + 1, 5)) for k in range(240)]
    rows += [(5_000_000 + k, 1, d(2023, 1, 1)) for k in range(5)]
    sinks.write_fact(_facts(spark, rows), path)
    # 7 (office 2, August) moves into office 2's March; 5 is new to the window
    new = _facts(spark, [(7, 2, d(2024, 3, 9)), (1000, 2, d(2024, 3, 10))])
    _spoil(path, ["office_id=2/month=2024-03-01", "office_id=2/month=2024-08-01", "office_id=2/id_range=0"])
    assert sinks.load_window(spark, path, new, 2, "2024-03-01", "2024-03-31") == 2
    got = sinks.read_months(spark, path, [(2, d(2024, 3, 1)), (2, d(2024, 8, 1))]).select("appointment_id", "scheduled_date")
    want = {(7, d(2024, 3, 9)), (1000, d(2024, 3, 10))} | {
        (k, x) for k, o, x in rows if o == 2 and x == d(2024, 8, 5) and k != 7}
    assert {tuple(r) for r in got.collect()} == want
    places = tables.read(spark, path, sinks.PLACES, only="office_id=2/id_range=0".__eq__)
    assert {(r.id, r.month) for r in places.collect()} == {
        (k, x.replace(day=1)) for k, x in [(k, x) for k, o, x in rows if o == 2 and x.month != 3 and k != 7]
        + [(7, d(2024, 3, 9)), (1000, d(2024, 3, 10))]}
    kept = tables.latest(spark, path).parts["rows"].folders
    assert sum("office_id=1/" in f for f in kept) == len({x for _, o, x in rows if o == 1})


def test_index_equals_the_rows_after_many_loads(spark, tmp_path):
    import random

    r, path = random.Random(5), str(tmp_path / "f")
    d0, held = dt.date(2024, 1, 1), {}
    for k in range(60):
        held[k, 1 + k % 2] = d0 + dt.timedelta(days=r.randint(0, 180))
    sinks.write_fact(_facts(spark, [(k, o, x) for (k, o), x in held.items()]), path)
    for _ in range(5):
        office, start = r.randint(1, 2), d0 + dt.timedelta(days=r.randint(0, 150))
        end = start + dt.timedelta(days=20)
        new = {(r.randint(0, 80), office): start + dt.timedelta(days=r.randint(0, 20)) for _ in range(12)}
        held = {k: x for k, x in held.items() if not (k[1] == office and start <= x <= end) and k not in new} | new
        sinks.load_window(spark, path, _facts(spark, [(k, o, x) for (k, o), x in new.items()]), office, start, end)
        rows = sinks.read_fact(spark, path).collect()
        assert {(x.appointment_id, x.office_id): x.scheduled_date for x in rows} == held and len(rows) == len(held)
        places = tables.read(spark, path, sinks.PLACES).collect()
        assert {(x.id, x.office_id, x.month) for x in places} == {(k, o, x.replace(day=1)) for (k, o), x in held.items()}


# streams ------------------------------------------------------------------------

def _tickets(spark, rows):
    """(id, office, stamp, total, item ids) as raw records."""
    from fieldlake.sources.schemas import raw_schema
    schema = raw_schema("ticket")
    names = schema["items"].dataType.elementType.names
    out = [{"ticketID": str(k), "officeID": str(o), "dateUpdated": stamp, "total": str(t), "items": [
        {n: (str(i) if n == "itemID" else None) for n in names} for i in items]} for k, o, stamp, t, items in rows]
    return spark.createDataFrame([tuple(x.get(n) if n != "items" else [tuple(i[m] for m in names) for i in x["items"]]
                                        for n in schema.names) for x in out], schema)


@pytest.mark.parametrize("stop_at", ["items", "tickets", None])
def test_replayed_ticket_batch(spark, tmp_path, monkeypatch, stop_at):
    """A batch that stops before or between its two commits, and runs again."""
    from fieldlake.streaming import upsert
    path, at = str(tmp_path / "t"), "2024-01-0{} 00:00:00".format
    first = _tickets(spark, [(k, 1, at(2), k, [10 * k, 10 * k + 1]) for k in range(1, 6)])
    second = _tickets(spark, [(1, 1, at(3), 100, [15]), (2, 1, at(1), 200, [25]), (3, 1, at(3), 300, []), (9, 2, at(3), 9, [90])])
    upsert.upsert_batch(spark, first, path, "ticket", "2024-01-09 00:00:00", ("s", 0))
    real, calls = sinks.load_by_id, []

    def load(*a, **k):
        calls.append(a[1])
        if stop_at and len(calls) == (1 if stop_at == "items" else 2):
            raise Stop
        return real(*a, **k)

    monkeypatch.setattr(sinks, "load_by_id", load)
    if stop_at:
        with pytest.raises(Stop):
            upsert.upsert_batch(spark, second, path, "ticket", "2024-01-09 00:00:00", ("s", 1))
    monkeypatch.setattr(sinks, "load_by_id", real)
    for _ in range(2):  # the second time nothing is left to do
        upsert.upsert_batch(spark, second, path, "ticket", "2024-01-09 00:00:00", ("s", 1))
        commits = [tables.latest(spark, p).number for p in (path, upsert.items_path(path))]
    upsert.upsert_batch(spark, second, path, "ticket", "2024-01-09 00:00:00", ("s", 1))
    assert commits == [tables.latest(spark, p).number for p in (path, upsert.items_path(path))]
    got = {(r.office_id, r.ticket_id): r.total for r in sinks.read(spark, path).collect()}
    assert got == {(1, 1): 100, (1, 2): 2, (1, 3): 300, (1, 4): 4, (1, 5): 5, (2, 9): 9}
    items = sorted((r.ticket_id, r.item_id) for r in sinks.read(spark, upsert.items_path(path)).collect())
    assert items == [(1, 15), (2, 20), (2, 21), (4, 40), (4, 41), (5, 50), (5, 51), (9, 90)]


def test_stream_batches_rewrite_only_their_folders(spark, tmp_path, monkeypatch):
    from fieldlake.streaming import upsert
    monkeypatch.setattr(sinks, "ID_RANGE", 10)
    path = str(tmp_path / "t")
    rows = lambda ids, total: _tickets(spark, [(k, 1, "2024-01-02 00:00:00", total, []) for k in ids])
    for f in (sinks.with_id_range, sinks.load_by_id, sinks.read_ids, sinks.write_by_id):
        monkeypatch.setattr(f, "__defaults__", tuple(10 if x == 1_000_000 else x for x in f.__defaults__))
    upsert.upsert_batch(spark, rows(range(100), 1), path, "ticket", "2024-01-09 00:00:00", ("s", 0))
    _spoil(path, ["id_range=3"])
    upsert.upsert_batch(spark, rows([33, 34], 2), path, "ticket", "2024-01-09 00:00:00", ("s", 1))
    got = tables.read(spark, path, only="office_id=1/id_range=3".__eq__)
    assert {r.ticket_id: r.total for r in got.collect()} == {k: 2 if k in (33, 34) else 1 for k in range(30, 40)}


# history ------------------------------------------------------------------------

def test_backfill_stopped_anywhere_equals_one_run(spark, sf, tmp_path, monkeypatch):
    from fieldlake.plans import backfill
    from fieldlake.registry_ops import RUN_AT, _fetch
    fetch, as_of = _fetch(spark, sf), "1998-06-15"
    asked = {"years": 0, "offices": (1, 2), "slots_per_job": 1}  # one month, two slots
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    backfill.backfill_run(spark, fetch, one, as_of, RUN_AT, **{**asked, "slots_per_job": 9})
    real, stops = sinks.load_by_id, iter([None, Stop, None, Stop, Stop, None, None, None, None, None, None, None])

    def load(*a, **k):
        stop = next(stops, None)
        if stop:
            raise Stop("killed")
        return real(*a, **k)

    monkeypatch.setattr(sinks, "load_by_id", load)
    for _ in range(6):
        progress = backfill.backfill_run(spark, fetch, two, as_of, RUN_AT, **asked).first()
    assert progress["remaining_slots"] == 0
    for name in ("fact_appointments", "fact_tickets", "fact_ticket_items", "dim_customers", "dim_subscriptions",
                 "dim_products"):
        a, b = (sinks.read(spark, f"{root}/{name}") for root in (one, two))
        assert sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect())) and a.count()
    done = backfill.ledger(spark, two).filter("kind = 'slot'").collect()
    assert len(done) == 2 and all(r.appointments and r.tickets and r.ticket_items for r in done)


def test_backfill_leaves_a_failing_office_pending(spark, sf, tmp_path):
    from fieldlake.plans import backfill
    from fieldlake.registry_ops import CALENDAR_AS_OF, RUN_AT, _fetch
    found, root = _fetch(spark, sf), str(tmp_path / "b")

    def fetch(entity, office):
        if entity == "ticket" and office == 2:
            raise RuntimeError("no tickets today")
        return found(entity, office)

    progress = backfill.backfill_run(spark, fetch, root, CALENDAR_AS_OF, RUN_AT, years=0).first()
    assert progress["done_slots"] == 1 and progress["remaining_slots"] == 1
    assert [r.office_id for r in backfill.ledger(spark, root).filter("kind = 'slot'").collect()] == [1]


# nightly ------------------------------------------------------------------------

def test_night_that_starts_from_empty_tables(spark, sf, tmp_path):
    from fieldlake.plans import nightly
    from fieldlake.registry_ops import NIGHTLY, RUN_AT, _fetch
    root = str(tmp_path / "n")
    sinks.ensure_tables(spark, root)
    as_of, days = NIGHTLY
    health = nightly.nightly_sync(spark, _fetch(spark, sf), root, (1, 2), as_of, days, RUN_AT, full_dims=True).collect()
    assert [r.status for r in health] == ["success", "success"] and any(r.appointments_synced for r in health)
    stored = sinks.read_fact(spark, f"{root}/fact_appointments").groupBy("office_id").count().collect()
    assert {r.office_id: r["count"] for r in stored} == {
        r.office_id: r.appointments_synced for r in health if r.appointments_synced}
    again = nightly.nightly_sync(spark, _fetch(spark, sf), root, (1, 2), as_of, days, RUN_AT).collect()
    assert [r[6:] for r in again] == [r[6:] for r in health]
    assert sinks.read(spark, f"{root}/sync_health").count() == 4
    seen = sinks.read(spark, f"{root}/load_rejects").filter("office_id = 1").groupBy("entity").agg(
        F.max("records").alias("n"), F.count(F.lit(1)).alias("fields")).collect()
    assert {r.entity: r.fields for r in seen} == {e: 2 * len(REJECT_RULES[e]) for e in (
        "appointment", "customer", "route", "subscription", "ticket", "ticketItem")}
    assert {r.entity: r.n for r in seen}["appointment"] == health[0].appointments_synced


def test_rejected_fields_count_like_the_profile(spark):
    from fieldlake.operators import quality
    item = "array<struct<itemID:string,quantity:string,amount:string,productID:string,serviceID:string>>"
    raw = spark.createDataFrame(
        [("1", "x", [("9", "a", "1", None, "7"), None, ("q", "b", " ", "2", "")]), ("2", "3", []), ("y", " ", None),
         (None, "0000-00-00", [("", "", "", "", "")])],
        f"ticketID string, invoiceDate string, items {item}")
    for c in [f for f, _ in quality.REJECT_RULES["ticket"] if f not in raw.columns]:
        raw = raw.withColumn(c, F.lit("n/a"))
    for entity in ("ticket", "ticketItem"):
        noted = raw.select(quality.rejected_fields(entity).alias("names"))
        got = noted.agg(*quality.reject_counts(entity, F.col("names"))).first()
        want = {r.field: r.rejects for r in quality.conform_rejects(raw, entity).collect()}
        assert dict(zip([f for f, _ in quality.REJECT_RULES[entity]], got, strict=True)) == want
    assert want == {"itemID": 1, "quantity": 2, "amount": 0, "productID": 0, "serviceID": 0}


def test_failed_refresh_leaves_health_rows(spark, sf, tmp_path):
    from fieldlake.plans import nightly
    from fieldlake.registry_ops import NIGHTLY, RUN_AT, _fetch
    found, root = _fetch(spark, sf), str(tmp_path / "n")
    sinks.ensure_tables(spark, root)

    def fetch(entity, office):
        if entity == "product":
            raise RuntimeError("products are down")
        return found(entity, office)

    health = nightly.nightly_sync(spark, fetch, root, (1, 2), *NIGHTLY, RUN_AT, full_dims=True).collect()
    assert [(r.status, r.error_message, r.appointments_synced) for r in health] == [("error", "products are down", 0)] * 2
    assert sinks.read(spark, f"{root}/sync_health").count() == 2
