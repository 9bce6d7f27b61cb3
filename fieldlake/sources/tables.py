"""Tables as Parquet folders with an atomic commit.

A table is a folder of versions and commits::

    <table>/rows/table_version=v1f.../office_id=1/month=2024-03-01/part-*.parquet
    <table>/commits/00000007.json

A write adds a version folder and touches nothing else. Then one small file, put
in place by a rename, names the folders that make up the table from now on; so
a write that fails at any step leaves the rows of the last commit, and a reader
sees all of a commit or nothing of it. A commit may cover several parts (the
rows and an index of them), which therefore never disagree. It also notes the
last batch of each stream that it holds, so that a batch applied twice is known.

The two last commits keep their folders, so a reader that began before a
commit can end. Folders of older ones, and those a failed write left, are deleted
by the next write. One table has one writer at a time; a second one is refused
when it finds its commit taken.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

ROWS = "rows"
KEPT = 2  # commits whose folders stay
VERSION = "table_version"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # the folder of a null partition value


@dataclass
class Part:
    schema: StructType
    keys: tuple[str, ...] = ()
    folders: tuple[str, ...] = ()


@dataclass
class Commit:
    number: int = 0
    parts: dict[str, Part] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)

    def text(self) -> str:
        parts = {n: {"schema": p.schema.json(), "keys": p.keys, "folders": p.folders} for n, p in self.parts.items()}
        return json.dumps({"number": self.number, "parts": parts, "batches": self.batches})

    @staticmethod
    def of(text: str) -> Commit:
        d = json.loads(text)
        parts = {n: Part(StructType.fromJson(json.loads(p["schema"])), tuple(p["keys"]), tuple(p["folders"]))
                 for n, p in d["parts"].items()}
        return Commit(d["number"], parts, d["batches"])


@dataclass
class Change:
    """What a write does to one part. ``keys`` are its partition columns; with
    ``whole`` all rows are replaced, else the partitions the new rows fall in
    and the ``cleared`` ones (names as ``partition_name`` makes them); with
    ``add`` none are."""

    rows: DataFrame
    keys: tuple[str, ...] = ()
    whole: bool = False
    add: bool = False
    cleared: Iterable[str] = ()


def partition_name(values: Mapping[str, object]) -> str:
    return "/".join(f"{k}={NO_VALUE if v is None else v}" for k, v in values.items())


def partition_of(folder: str) -> str:
    """A folder's name without its version."""
    return folder.partition("/")[2]


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a staging folder."""
    _fs(spark, path).delete(_path(spark, path), True)


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, at = _fs(spark, path), _path(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(at)) if fs.exists(at) else []


def _commits(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n[:-5]) for n in _names(spark, f"{path}/commits") if n.endswith(".json") and n[:-5].isdigit())


def _commit_path(path: str, number: int) -> str:
    return f"{path}/commits/{number:08d}.json"


def _load(spark: SparkSession, path: str, number: int) -> Commit:
    stream = _fs(spark, path).open(_path(spark, _commit_path(path, number)))
    try:
        return Commit.of(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def latest(spark: SparkSession, path: str) -> Commit | None:
    path = path.rstrip("/")
    numbers = _commits(spark, path)
    return _load(spark, path, numbers[-1]) if numbers else None


def read(spark: SparkSession, path: str, part: str = ROWS, only: Callable[[str], bool] | None = None) -> DataFrame:
    """The rows of the last commit; with ``only`` those of the partitions (by
    name) it holds for, and no other folder is listed or opened."""
    path = path.rstrip("/")
    commit = latest(spark, path)
    if commit is None:
        raise FileNotFoundError(f"no table at {path}")
    p = commit.parts[part]
    folders = [f for f in p.folders if only is None or only(partition_of(f))]
    if not folders:
        return spark.createDataFrame([], p.schema).limit(0)  # known to be empty: joins with it need no shuffle
    base = f"{path}/{part}"
    return (spark.read.schema(p.schema).option("basePath", base).parquet(*[f"{base}/{f}" for f in folders])
            .select(*p.schema.names))


def _leaves(spark: SparkSession, path: str, depth: int) -> list[str]:
    if not depth:
        return [""]
    return ["/".join(x for x in (n, rest) if x) for n in _names(spark, path) if "=" in n
            for rest in _leaves(spark, f"{path}/{n}", depth - 1)]


def _stage(change: Change, base: str) -> tuple[list[str], int]:
    """Write a change's rows to a version folder of its own; the folders and
    the number of rows (from the files' footers)."""
    spark, version = change.rows.sparkSession, f"{VERSION}=v{uuid.uuid4().hex[:16]}"
    w = change.rows.write.mode("errorifexists")
    (w.partitionBy(*change.keys) if change.keys else w).parquet(f"{base}/{version}")
    leaves = _leaves(spark, f"{base}/{version}", len(change.keys))
    if not leaves:
        return [], 0
    n = spark.read.schema(change.rows.schema).option("basePath", base).parquet(f"{base}/{version}").count()
    return ["/".join(x for x in (version, leaf) if x) for leaf in leaves], n


def _put(spark: SparkSession, path: str, commit: Commit) -> None:
    """Write the commit file beside its place and rename it there."""
    fs = _fs(spark, path)
    place, beside = _commit_path(path, commit.number), f"{path}/commits/.{uuid.uuid4().hex}.tmp"
    fs.mkdirs(_path(spark, f"{path}/commits"))
    out = fs.create(_path(spark, beside), False)
    try:
        out.write(bytearray(commit.text().encode()))
    finally:
        out.close()
    if fs.exists(_path(spark, place)) or not fs.rename(_path(spark, beside), _path(spark, place)):
        fs.delete(_path(spark, beside), False)
        raise OSError(f"{path}: commit {commit.number} was made by another writer")


def _clean(spark: SparkSession, path: str) -> None:
    """Delete what no kept commit holds: folders first, then old commits, so
    that a clean-up cut short is done again by the next one."""
    fs, numbers = _fs(spark, path), _commits(spark, path)
    kept = [_load(spark, path, n) for n in numbers[-KEPT:]]
    old = [_load(spark, path, n) for n in numbers[:-KEPT]]
    for part in {p for c in (*kept, *old) for p in c.parts}:
        held = {f for c in kept if part in c.parts for f in c.parts[part].folders}
        dead = {f for c in old if part in c.parts for f in c.parts[part].folders} - held
        versions = {f.partition("/")[0] for f in held}
        left = {n for n in _names(spark, f"{path}/{part}") if n.startswith(f"{VERSION}=") and n not in versions}
        for name in sorted({f for f in dead if f.partition("/")[0] not in left} | left):
            fs.delete(_path(spark, f"{path}/{part}/{name}"), True)
    for n in numbers[:-KEPT]:
        fs.delete(_path(spark, _commit_path(path, n)), False)


def write(spark: SparkSession, path: str, changes: Mapping[str, Change], allow_empty: bool = True,
          batch: tuple[str, int] | None = None) -> int:
    """Apply the changes in one commit; returns the number of rows written to
    the first part. Without ``allow_empty`` nothing changes when there are none.
    ``batch`` (stream, number) is noted in the commit."""
    path = path.rstrip("/")
    before = latest(spark, path) or Commit()
    after = Commit(before.number + 1, dict(before.parts), dict(before.batches))
    if batch:
        after.batches[batch[0]] = batch[1]
    counts = []
    for part, change in changes.items():
        new, n = _stage(change, f"{path}/{part}")
        counts.append(n)
        if not n and len(counts) == 1 and not allow_empty:
            return 0
        old = before.parts.get(part)
        kept = () if change.whole or old is None else old.folders
        if not change.add:
            gone = {*change.cleared, *map(partition_of, new)}
            kept = tuple(f for f in kept if partition_of(f) not in gone)
        schema = change.rows.schema if old is None or change.whole else old.schema
        after.parts[part] = Part(_nullable(schema), tuple(change.keys), (*kept, *new))
    _put(spark, path, after)
    _clean(spark, path)
    return counts[0]


def _nullable(schema: StructType) -> StructType:
    return StructType([type(f)(f.name, f.dataType, True) for f in schema.fields])
