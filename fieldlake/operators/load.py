"""Incremental-load operators: (existing, incoming, …) → new table.

All are set operations on keys — anti-joins and unions — so they shuffle
on the key once and never bring ids to the driver. Loads key on
(office_id, id) where the two offices are separate source tenants; the
views keep the original bare-id joins.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlake.functions.codes import office_name
from fieldlake.functions.parse import to_date, to_int, to_timestamp


def _date(x) -> Column:
    return x.cast("date") if isinstance(x, Column) else F.lit(str(x)).cast("date")


def _in_window(date_col: str, office: int, start, end) -> Column:
    """TRUE only where the row is the office's and dated in [start, end];
    rows with a NULL office or date are never in the window."""
    return F.coalesce((F.col("office_id") == office)
                      & F.col(date_col).between(_date(start), _date(end)), F.lit(False))


# ---------------------------------------------------------------------------
# I1–I5
# ---------------------------------------------------------------------------

def replace_window(existing: DataFrame, incoming: DataFrame, office: int, start, end,
                   keys: Iterable[str] | None = None, date_col: str = "scheduled_date") -> DataFrame:
    """Drop the office's rows dated in [start, end] and add ``incoming``.

    With ``keys``, rows of ``existing`` outside the window whose key comes in
    again are dropped too, so a row that moved into the window is not kept
    twice. An empty ``incoming`` leaves ``existing`` as it is (the original
    skips the delete when nothing was fetched).
    """
    if incoming.isEmpty():
        return existing
    inside = F.coalesce(_in_window(date_col, office, start, end), F.lit(False))  # undated rows stay
    kept = existing.filter(~inside)
    if keys:
        kept = kept.join(incoming.select(*keys), list(keys), "left_anti").select(*existing.columns)
    return kept.unionByName(incoming)


def replace_by_id(existing: DataFrame, incoming: DataFrame, keys: Iterable[str],
                  delete_ids: DataFrame | None = None) -> DataFrame:
    """Delete rows whose key is in ``delete_ids`` (default: the keys of
    ``incoming``), then append ``incoming``."""
    keys = list(keys)
    ids = (delete_ids if delete_ids is not None else incoming).select(*keys)
    return existing.join(ids, keys, "left_anti").select(*existing.columns).unionByName(incoming)


def replace_children(existing_children: DataFrame, new_children: DataFrame,
                     parent_ids: DataFrame, parent_keys: Iterable[str] = ("office_id", "ticket_id")) -> DataFrame:
    """Children of every requested parent are replaced — also when the batch
    brings no children at all, and for parents that were not returned. Another
    office's parent of the same id keeps its children."""
    keys = list(parent_keys)
    return (existing_children.join(parent_ids.select(*keys), keys, "left_anti")
            .select(*existing_children.columns).unionByName(new_children))


def vanished_ids(existing: DataFrame, active_ids: DataFrame, office: int, start, end,
                 key: str = "appointment_id", date_col: str = "scheduled_date") -> DataFrame:
    """(office_id, id) stored for the office's window that its active search
    no longer returns (cancelled or rescheduled); they must be fetched again."""
    keys = ["office_id", key]
    stored = existing.filter(_in_window(date_col, office, start, end)).select(*keys).distinct()
    return stored.join(active_ids.select(*keys), keys, "left_anti")


def refetch(raw_snapshot: DataFrame, ids: DataFrame, raw_key: str = "appointmentID",
            key: str = "appointment_id") -> DataFrame:
    """Raw records whose office and id are in ``ids`` (the re-fetch of
    vanished rows)."""
    r = raw_snapshot.withColumn("_o", to_int(F.col("officeID"))).withColumn("_k", to_int(F.col(raw_key)))
    wanted = ids.select(F.col("office_id").alias("_o"), F.col(key).alias("_k"))
    return r.join(wanted, ["_o", "_k"], "left_semi").drop("_o", "_k")


def window_ticket_ids(appointments: DataFrame, office: int, start, end) -> DataFrame:
    """Distinct (office_id, ticket_id), id > 0, of the office's appointments
    in the window."""
    return (appointments.filter(_in_window("scheduled_date", office, start, end)
                                & (F.col("ticket_id") > 0))
            .select("office_id", "ticket_id").distinct())


# ---------------------------------------------------------------------------
# I6–I8
# ---------------------------------------------------------------------------

def route_tech(raw_routes: DataFrame, start, end, office: int | None = None) -> DataFrame:
    """(office_id, route_id, route_tech_id) for routes dated in [start, end]
    with a non-zero tech. Several techs for one route: the highest id wins (the
    source's pick depends on API order; ours is deterministic)."""
    r = raw_routes.select(to_int(F.col("routeID")).alias("route_id"),
                          to_int(F.col("assignedTech")).alias("tech"),
                          to_int(F.col("officeID")).alias("office_id"),
                          to_date(F.col("date")).alias("route_date"))
    r = r.filter(F.col("route_id").isNotNull() & F.coalesce(F.col("tech") != 0, F.lit(False))
                 & F.col("route_date").between(_date(start), _date(end)))
    if office is not None:
        r = r.filter(F.col("office_id") == office)
    return r.groupBy("office_id", "route_id").agg(F.max("tech").alias("route_tech_id"))


def best_tech(appointments: DataFrame) -> DataFrame:
    """Adds best_tech_id: the assigned tech unless 0/NULL, else the route's tech."""
    return appointments.withColumn(
        "best_tech_id", F.coalesce(F.nullif(F.col("assigned_tech_id"), F.lit(0)), F.col("route_tech_id")))


def changed_since(raw: DataFrame, as_of, days: int = 2, column: str = "dateUpdated") -> DataFrame:
    """Raw records updated at or after ``as_of`` minus ``days`` days."""
    since = F.lit(str(as_of)).cast("timestamp") - F.make_dt_interval(F.lit(days))
    return raw.filter(to_timestamp(F.col(column)) >= since)


# ---------------------------------------------------------------------------
# I9, I10 — full refresh and monthly backfill
# ---------------------------------------------------------------------------

def refresh_dimension(raw_by_office: Iterable[DataFrame], conform, run_at) -> DataFrame:
    """All offices' raw records of one dimension, conformed: the full
    replacement of the table (write it with ``sinks.overwrite``)."""
    frames = list(raw_by_office)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return conform(out, run_at)


def is_refresh_day(run_date, forced: bool = False) -> bool:
    """Dimensions are fully refreshed on Mondays, or when forced."""
    d = run_date if isinstance(run_date, dt.date) else dt.date.fromisoformat(str(run_date)[:10])
    return forced or d.weekday() == 0


def backfill(existing: DataFrame, incoming: DataFrame, partitions: DataFrame,
             date_col: str = "scheduled_date") -> DataFrame:
    """Replace whole (office_id, month) partitions: every existing row of a
    listed partition is dropped — only that office's — and the incoming rows
    of the listed partitions are added. ``partitions`` has office_id and
    month (first day of the month)."""
    keyed = lambda df: df.withColumn("month", F.trunc(F.col(date_col), "month"))
    p = partitions.select("office_id", "month")
    kept = keyed(existing).join(p, ["office_id", "month"], "left_anti")
    new = keyed(incoming).join(p, ["office_id", "month"], "left_semi")
    return kept.unionByName(new).select(*existing.columns)


# ---------------------------------------------------------------------------
# I11 — sync summary; I12 — backfill calendar and progress
# ---------------------------------------------------------------------------

SYNC_ENTITIES = ("appointments", "tickets", "ticket_items", "customers", "subscriptions")


def sync_summary(loaded: Mapping[str, DataFrame], run_at, lookback_days: int,
                 offices: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """One sync_health row per office: rows loaded per entity, status and
    error. A failed office keeps the counts of what it had loaded before the
    error. ``loaded`` maps entity → conformed rows (with office_id);
    ``offices`` lists the office ids that were synced; ``errors`` has
    (office_id, error_message) for failed offices."""
    parts = [df.select("office_id", F.lit(name).alias("entity")) for name, df in loaded.items()]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    counts = rows.groupBy("office_id").pivot("entity", list(SYNC_ENTITIES)).count()
    out = offices.select("office_id").distinct().join(counts, ["office_id"], "left")
    if errors is not None:
        out = out.join(errors.select("office_id", "error_message"), ["office_id"], "left")
    else:
        out = out.withColumn("error_message", F.lit(None).cast("string"))
    failed = F.col("error_message").isNotNull()
    name = F.when(F.col("office_id") == 1, F.lit("Residential")).otherwise(F.lit("Commercial"))
    return out.select(
        F.lit(str(run_at)).cast("timestamp").alias("run_at"),
        F.col("office_id").cast("long").alias("office_id"), name.alias("office_name"),
        F.when(failed, F.lit("error")).otherwise(F.lit("success")).alias("status"),
        "error_message", F.lit(lookback_days).cast("long").alias("lookback_days"),
        *[F.coalesce(F.col(e), F.lit(0)).cast("long").alias(f"{e}_synced") for e in SYNC_ENTITIES])


def sync_totals(summary: DataFrame) -> DataFrame:
    """Overall totals of one run's sync_health rows: rows per entity across
    offices, and how many offices failed (the run fails if any did)."""
    return summary.agg(
        *[F.sum(f"{e}_synced").cast("long").alias(f"{e}_synced") for e in SYNC_ENTITIES],
        F.count_if(F.col("status") == "error").alias("failed_offices"),
        F.count(F.lit(1)).alias("offices"))


def backfill_calendar(spark: SparkSession, as_of, years: int = 5,
                      offices: Iterable[int] = (1, 2)) -> DataFrame:
    """Every (month, office) from the first of as_of's month ``years`` years
    back up to as_of's month, with its date range and progress key."""
    d = _date(as_of)
    start = F.make_date(F.year(d) - years, F.month(d), F.lit(1))
    base = spark.range(1).select(
        F.explode(F.sequence(start, F.trunc(d, "month"), F.expr("INTERVAL 1 MONTH"))).alias("month_start"))
    base = base.withColumn("office_id", F.explode(F.array(*[F.lit(int(o)).cast("long") for o in offices])))
    return base.select(
        F.year("month_start").cast("long").alias("year"), F.month("month_start").cast("long").alias("month"),
        "office_id", "month_start", F.last_day("month_start").alias("month_end"),
        F.format_string("%04d-%02d-office%d", F.year("month_start"), F.month("month_start"),
                        F.col("office_id")).alias("month_key"))


def loaded_months(facts: DataFrame, date_col: str = "scheduled_date") -> DataFrame:
    """(office_id, month_start) partitions present in a fact table."""
    return (facts.filter(F.col(date_col).isNotNull())
            .select("office_id", F.trunc(F.col(date_col), "month").alias("month_start")).distinct())


def backfill_pending(calendar: DataFrame, ledger: DataFrame) -> DataFrame:
    """Office-months of the calendar that are not in the progress ledger
    (office_id, month_start). The ledger lists finished slots, so a month
    without rows is done once it was fetched, and one whose load stopped
    half-way is still pending whatever rows it left."""
    return calendar.join(ledger.select("office_id", "month_start"), ["office_id", "month_start"], "left_anti") \
        .select(*calendar.columns)


def backfill_progress(calendar: DataFrame, done: DataFrame, minutes_per_slot: int = 2) -> DataFrame:
    """Done / total office-months, percent, remaining slots and an estimate.
    ``done`` has (office_id, month_start) of completed partitions."""
    j = calendar.join(done.select("office_id", "month_start").distinct()
                      .withColumn("_done", F.lit(1)), ["office_id", "month_start"], "left")
    g = j.agg(F.count(F.lit(1)).alias("total_slots"),
              F.count("_done").alias("done_slots"),
              F.min("month_start").alias("first_month"), F.max("month_start").alias("last_month"))
    rem = F.col("total_slots") - F.col("done_slots")
    from fieldlake.functions.exact import div_half_up
    return g.select("first_month", "last_month", "done_slots", "total_slots",
                    div_half_up(F.col("done_slots") * 100, F.col("total_slots")).alias("pct_done"),
                    rem.alias("remaining_slots"), (rem * minutes_per_slot).alias("est_minutes"))
