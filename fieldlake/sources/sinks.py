"""Sinks: table writes (S2–S4) and the run logs (S6–S8).

Tables are committed folders (``tables``); facts are partitioned by
(office_id, month), so a window load rewrites only the partitions it touches, and
hold an index from ids to months, so that it finds a row that moved without
looking through the others.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlake.sources import tables
from fieldlake.sources.schemas import STAR_SCHEMAS
from fieldlake.sources.tables import ROWS, Change, partition_name, partition_of

PLACES = "places"  # the part of a fact table that says in which months an id has rows
FACT_PARTITIONS = ("office_id", "month")
ID_RANGE = 1_000_000  # ids of one folder
ID_PARTITIONS = ("office_id", "id_range")

# table -> its id column, for the tables partitioned by ranges of ids
BY_ID = {"fact_tickets": "ticket_id", "fact_ticket_items": "ticket_id", "dim_customers": "customer_id",
         "dim_subscriptions": "subscription_id"}
BY_MONTH = ("fact_appointments",)


def exists(spark: SparkSession, path: str) -> bool:
    return tables.latest(spark, path) is not None


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table as of its last commit."""
    return tables.read(spark, path)


def append(df: DataFrame, path: str, partition_by: Iterable[str] | None = None) -> int:
    """Append rows; returns their number. Without any the table stays as it is."""
    return tables.write(df.sparkSession, path, {ROWS: Change(df, tuple(partition_by or ()), add=True)},
                        allow_empty=False)


def overwrite(df: DataFrame, path: str, partition_by: Iterable[str] | None = None,
              cleared: Iterable[dict] | None = None, allow_empty: bool = False) -> bool:
    """Replace the table (or, with ``partition_by``, only the partitions the
    rows fall in). Returns False and leaves the table untouched when ``df``
    is empty — as the source does, so a failed fetch never empties a table —
    unless ``allow_empty``.

    A write that fails at any step leaves the table as it was, and ``df`` may
    read the table.

    ``cleared`` lists partitions (e.g. ``{"office_id": 1, "month": "2024-03-01"}``)
    that must end up empty.
    """
    keys = tuple(partition_by or ())
    change = Change(df, keys, whole=not keys, cleared=[partition_name(p) for p in cleared or ()])
    return bool(tables.write(df.sparkSession, path, {ROWS: change}, allow_empty=allow_empty) or allow_empty)


# ---------------------------------------------------------------------------
# Facts by (office, month), with an index of ids
# ---------------------------------------------------------------------------

def with_month(df: DataFrame, date_col: str = "scheduled_date") -> DataFrame:
    """Adds the ``month`` partition column (first day of ``date_col``'s month)."""
    return df.withColumn("month", F.trunc(F.col(date_col), "month"))


def with_id_range(df: DataFrame, id_col: str, width: int = ID_RANGE) -> DataFrame:
    """Adds the ``id_range`` partition column."""
    return df.withColumn("id_range", F.expr(f"`{id_col}` div {int(width)}"))


def _by_month(rows: DataFrame) -> DataFrame:
    """Rows dealt out by office and month before they are written: else every
    task writes a file into every folder, and the next load, which reads all of
    them, has more tasks and writes still more. Large months are split."""
    return rows.hint("rebalance", *FACT_PARTITIONS)


def _places(rows: DataFrame, id_col: str) -> DataFrame:
    """(office_id, id, month, id_range) of rows that have a month column."""
    ids = rows.select("office_id", F.col(id_col).cast("long").alias("id"), "month").distinct()
    return with_id_range(ids, "id")


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """A fact table with its month column."""
    return tables.read(spark, path)


def read_months(spark: SparkSession, path: str, slots: Iterable[tuple]) -> DataFrame:
    """The rows of some (office, month) partitions; no other folder is opened."""
    wanted = {_slot(o, m) for o, m in slots}
    return tables.read(spark, path, only=wanted.__contains__)


def _slot(office, month) -> str:
    return partition_name({"office_id": office, "month": month})


def write_fact(df: DataFrame, path: str, date_col: str = "scheduled_date", id_col: str | None = None,
               allow_empty: bool = False) -> bool:
    """Write a whole fact table partitioned by (office_id, month), and its index."""
    rows = with_month(df, date_col)
    places = _places(rows, id_col or df.columns[0])
    changes = {ROWS: Change(_by_month(rows), FACT_PARTITIONS, whole=True), PLACES: Change(places, ID_PARTITIONS, whole=True)}
    return bool(tables.write(df.sparkSession, path, changes, allow_empty=allow_empty) or allow_empty)


def _months(start, end) -> list[dt.date]:
    s, e = dt.date.fromisoformat(str(start)[:10]), dt.date.fromisoformat(str(end)[:10])
    months, m = [], s.replace(day=1)
    while m <= e:
        months.append(m)
        m = (m.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
    return months


def _range_folders(places: DataFrame) -> set[str]:
    """Names of the index folders that these ids fall in, which come to the driver."""
    return {partition_name(r.asDict()) for r in places.select(*ID_PARTITIONS).distinct().collect()}


def replace_months(spark: SparkSession, path: str, incoming: DataFrame, slots: Iterable[tuple], dropped,
                   id_col: str, date_col: str = "scheduled_date", batch: tuple[str, int] | None = None,
                   staged: bool = False) -> int:
    """Add ``incoming`` to a fact table and take out the rows of the partitions
    ``slots`` (office, month) for which the condition ``dropped`` holds, and all
    rows whose (office, id) comes in again, wherever they lie. Rows and index
    change in one commit; returns the number of incoming rows.

    Folders opened: the slots, the partitions that incoming rows fall in, those
    in which the index has an incoming id (its row has moved), and the index's
    folders of the ids concerned. Names of folders are all that comes to the
    driver. ``staged``: the incoming rows are a checkpoint already.
    """
    from fieldlake.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    inc = with_month(incoming if staged else incoming.checkpoint(eager=True), date_col)  # fetched once
    new_places = _places(inc, id_col).checkpoint(eager=True)
    held = tables.read(spark, path, PLACES, only=_range_folders(new_places).__contains__)
    moved = held.join(new_places.select("office_id", "id"), ["office_id", "id"], "left_semi")
    touched = inc.select(*FACT_PARTITIONS).union(moved.select(*FACT_PARTITIONS)).distinct().collect()
    parts = {*((o, m) for o, m in slots), *(tuple(r) for r in touched)}
    existing = read_months(spark, path, parts)
    keys = ["office_id", id_col]
    gone = F.coalesce(dropped, F.lit(False)) if dropped is not None else F.lit(False)
    kept = existing.filter(~gone).join(inc.select(*keys), keys, "left_anti")
    columns = existing.columns
    rows = kept.select(*columns).unionByName(inc.select(*columns))

    left = existing.filter(gone).select("office_id", F.col(id_col).cast("long").alias("id"))
    changed = with_id_range(left.union(new_places.select("office_id", "id")).distinct(), "id").checkpoint(eager=True)
    folders = _range_folders(changed)
    before = tables.read(spark, path, PLACES, only=folders.__contains__)
    ids = ["office_id", "id"]
    inside = spark.createDataFrame(sorted(parts, key=str), "o long, m date")
    outside = before.join(inside, before["office_id"].eqNullSafe(inside["o"]) & before["month"].eqNullSafe(inside["m"]), "left_anti")
    others = before.join(changed.select(*ids), ids, "left_anti")
    elsewhere = outside.join(changed.select(*ids), ids, "left_semi")
    places = others.unionByName(elsewhere).unionByName(new_places.select(*others.columns)).distinct()
    tables.write(spark, path, {
        ROWS: Change(_by_month(rows), FACT_PARTITIONS, cleared=[_slot(o, m) for o, m in parts]),
        PLACES: Change(places, ID_PARTITIONS, cleared=folders)}, batch=batch)
    return inc.count()


def read_rows_of(spark: SparkSession, path: str, ids: DataFrame, id_col: str) -> DataFrame:
    """The rows of a fact table's partitions that hold one of these
    (office_id, ``id_col``), found through the index."""
    wanted = with_id_range(ids.select("office_id", F.col(id_col).cast("long").alias("id")).distinct(), "id")
    held = tables.read(spark, path, PLACES, only=_range_folders(wanted).__contains__)
    slots = held.join(wanted.select("office_id", "id"), ["office_id", "id"], "left_semi").select(*FACT_PARTITIONS)
    return read_months(spark, path, [tuple(r) for r in slots.distinct().collect()])


def load_window(spark: SparkSession, path: str, incoming: DataFrame, office: int, start, end,
                date_col: str = "scheduled_date", keys: Iterable[str] | None = None) -> int:
    """The window load: replace the office's rows dated in [start, end], and
    rows with an incoming row's id wherever they lie, on a fact table. Without
    incoming rows nothing changes. Returns their number."""
    if incoming.isEmpty():
        return 0
    id_col = next(k for k in (keys or (incoming.columns[0], "office_id")) if k != "office_id")
    day = F.col(date_col)
    dropped = (F.col("office_id") == office) & day.between(F.lit(str(start)[:10]).cast("date"),
                                                           F.lit(str(end)[:10]).cast("date"))
    return replace_months(spark, path, incoming, [(int(office), m) for m in _months(start, end)], dropped, id_col,
                          date_col)


# ---------------------------------------------------------------------------
# Tables by (office, range of ids)
# ---------------------------------------------------------------------------

def read_by_id(spark: SparkSession, path: str) -> DataFrame:
    """A table partitioned by office and range of ids."""
    return tables.read(spark, path)


def write_by_id(df: DataFrame, path: str, id_col: str, width: int = ID_RANGE, allow_empty: bool = False) -> bool:
    """Write a whole table partitioned by (office_id, id_range)."""
    change = Change(with_id_range(df, id_col, width), ID_PARTITIONS, whole=True)
    return bool(tables.write(df.sparkSession, path, {ROWS: change}, allow_empty=allow_empty) or allow_empty)


def load_by_id(spark: SparkSession, path: str, incoming: DataFrame, ids: DataFrame, id_col: str,
               width: int = ID_RANGE, allow_empty: bool = False, batch: tuple[str, int] | None = None,
               staged: bool = False) -> int:
    """Replace the rows whose (office_id, ``id_col``) is in ``ids`` by
    ``incoming``, on a table partitioned by (office_id, id_range). Only the
    folders that ids or incoming rows fall in are read and rewritten; their
    names are the only thing brought to the driver. Recent ids are close to
    each other, so a night touches few folders. Returns the number of incoming
    rows; without any the table stays as it is, unless ``allow_empty``."""
    from fieldlake.operators.load import replace_by_id
    from fieldlake.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    keys = ["office_id", id_col]
    inc = with_id_range(incoming if staged else incoming.checkpoint(eager=True), id_col, width)
    n = inc.count()
    if not n and not allow_empty:
        return 0
    gone = with_id_range(ids.select(*keys).distinct(), id_col, width).checkpoint(eager=True)
    parts = _range_folders(gone.select(*ID_PARTITIONS).union(inc.select(*ID_PARTITIONS)))
    existing = tables.read(spark, path, only=parts.__contains__)
    new = replace_by_id(existing, inc.select(*existing.columns), keys, delete_ids=gone)
    tables.write(spark, path, {ROWS: Change(new, ID_PARTITIONS, cleared=parts)}, batch=batch)
    return n


def read_ids(spark: SparkSession, path: str, ids: DataFrame, id_col: str, width: int = ID_RANGE) -> DataFrame:
    """The rows of the folders in which (office_id, ``id_col``) of ``ids`` fall."""
    folders = _range_folders(with_id_range(ids, id_col, width))
    return tables.read(spark, path, only=folders.__contains__)


# ---------------------------------------------------------------------------
# First creation
# ---------------------------------------------------------------------------

def create(rows: DataFrame, path: str, name: str, allow_empty: bool = True) -> None:
    """Write the star table ``name`` in the layout that the loads expect."""
    if name in BY_MONTH:
        write_fact(rows, path, allow_empty=allow_empty)
    elif name in BY_ID:
        write_by_id(rows, path, BY_ID[name], allow_empty=allow_empty)
    else:
        overwrite(rows, path, allow_empty=allow_empty)


def ensure_tables(spark: SparkSession, root: str, names: Iterable[str] | None = None) -> DataFrame:
    """Create every declared table that does not exist yet (empty, with its
    schema and partitions); report (table, status) with status 'created' or
    'existing'."""
    report = []
    for name in names or STAR_SCHEMAS:
        path = f"{root.rstrip('/')}/{name}"
        if exists(spark, path):
            report.append((name, "existing"))
        else:
            create(spark.createDataFrame([], STAR_SCHEMAS[name]), path, name)
            report.append((name, "created"))
    return spark.createDataFrame(report, "table string, status string")


# ---------------------------------------------------------------------------
# Run logs
# ---------------------------------------------------------------------------

def write_health(health: DataFrame, path: str) -> int:
    """Append sync_health rows (written on success and on failure)."""
    return append(health, path)


def write_review(review: DataFrame, path: str) -> None:
    """Duplicate-review CSV: fr_id, name, email, phone, matched_on, office."""
    (review.select("fr_id", "name", "email", "phone", "matched_on", "office")
     .write.mode("append").option("header", True).csv(path))


def write_import_log(plan: DataFrame, path: str, run_at) -> None:
    """Import log as JSON: one entry per customer, and the stats per action
    counted from the entries as they were written (the plan runs once)."""
    stamp, at = F.lit(str(run_at)).cast("timestamp"), f"{path.rstrip('/')}/entries"
    plan.withColumn("run_at", stamp).write.mode("append").json(at)
    entries = plan.sparkSession.read.schema(plan.withColumn("run_at", stamp).schema).json(at)
    (entries.filter(F.col("run_at") == stamp).groupBy("action").agg(F.count(F.lit(1)).alias("customers"))
     .withColumn("run_at", stamp).write.mode("append").json(f"{path.rstrip('/')}/stats"))
