"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from fieldlake.session import ensure_checkpoint_dir

# A word, for every operator that counts or compares words.
WORD = r"[^\x20\x09-\x0D]+"


def col(name: str) -> Column:
    """A top-level column by its exact name (dots and blanks included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """For each name, one that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def columns_of(df: DataFrame) -> list[Column]:
    return [col(c) for c in df.columns]


def pinned(df: DataFrame) -> DataFrame:
    """Cut the lineage: a copy in the checkpoint folder all executors share."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def let(value: Column, body) -> Column:
    """``body(x)`` with ``value`` evaluated once per row, however often ``x``
    occurs in nested lambdas."""
    return F.transform(F.array(value), body)[0]


BATCH_ROWS = 256  # of an Arrow batch: whole texts, however long, stay few at a time


def prepared(spark) -> None:
    """Set the session for these operators: small Arrow batches, and a path
    on which Python workers find this package when only the driver's has it
    (a session started from another folder)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def slices(batch: pa.RecordBatch, at: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """``batch`` in parts of about ``most`` bytes of text, a row at least."""
    n = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(n, dtype="i8") // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(n)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
