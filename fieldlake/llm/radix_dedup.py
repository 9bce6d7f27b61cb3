"""Exact dedup by distributed MSD radix partitioning.

Every document is one string of bytes led by its length. Level by level the
groups are split by the next bytes of the string: each group that goes on has a
number, and the next level groups by that number and the bytes after those
already read, so equality never rests on a digest. A document alone in its
group is done; so is a group whose bytes have ended, and its members are equal.
Only the others go on to the next level, which has read ``GROW`` times as many
bytes; what is read is left behind.

Sizes: the first level moves no text, only lengths, first bytes and ids.
The rest of the texts of groups of two or more is shuffled to meet the group's
number; later levels work on these alone and move only bytes not yet read. A level counts its groups with
map-side partial sums, so a group of copies, however large, is one row per
map task. Rows meet their group's count in a sort-merge join, whose skewed
partitions Spark splits. The number of levels is the logarithm of the longest
text.

Defined cases: a null text is an empty one; empty texts are equal to each
other; a null id never outranks another id and is kept only when no text of
the group has an id; rows that repeat both id and text are one document,
kept together; an empty table gives an empty table; further columns are not
read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from fieldlake.llm.common import col, pinned

FIRST = 16
GROW = 16


def _lower(texts: pa.Array) -> pa.Array:
    """The bytes, with A-Z and nothing else in lower case."""
    return pc.cast(pc.ascii_lower(pc.fill_null(pc.cast(texts, pa.string()), "")), pa.binary())


def _heads(batches):
    for batch in batches:
        body = _lower(batch.column(1))
        sha = [hashlib.sha256(x.as_buffer()).hexdigest() for x in body]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pc.cast(pc.binary_length(body), pa.int32()), pc.binary_slice(body, 0, FIRST),
             pa.array(sha, pa.string())], ["id", "n", "read", "sha"])


def _bodies(batches):
    for batch in batches:
        body = _lower(batch.column(1))
        sha = [hashlib.sha256(x.as_buffer()).hexdigest() for x in body]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pc.cast(pc.binary_length(body), pa.int32()), pc.binary_slice(body, 0, FIRST),
             pc.binary_slice(body, FIRST, (1 << 31) - 1), pa.array(sha, pa.string())], ["id", "n", "read", "rest", "sha"])


def _groups(rows: DataFrame, *key: str) -> DataFrame:
    """The groups of two or more with a number each, written out: as a table of
    its own its join with the rows is one whose skewed partitions Spark can split."""
    found = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("size"), F.max("id").alias("keep")).where("size > 1")
    return pinned(found.withColumn("number", F.monotonically_increasing_id()))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, ``keep_id`` (the largest id of the equal
    texts), ``group_size``, ``kept`` and ``text_sha256`` of the lower-cased
    text (an output only)."""
    longest = docs.agg(F.max(F.octet_length(col(text_col)))).first()[0] or 0
    rows = docs.select(col(id_col), col(text_col))
    kind = docs.schema[id_col].dataType.simpleString()
    alone = [F.when(F.col("size").isNull(), F.col("id")).otherwise(F.col("keep")).alias("keep"),
             F.coalesce("size", F.lit(1).cast("long")).alias("size")]

    heads = rows.mapInArrow(_heads, f"id {kind}, n int, read binary, sha string")
    key, width = ["n", "read"], FIRST
    groups = _groups(heads.select("id", *key), *key)
    ended = F.col("size").isNull() | (F.col("n") <= width)
    done = [heads.join(groups, key, "left").where(ended).select("id", *alone, "sha")]
    live = rows.mapInArrow(_bodies, f"id {kind}, n int, read binary, rest binary, sha string")
    while width < longest:
        live = pinned(live.where(F.col("n") > width).join(groups.select(*key, "number"), key)
                      .select("id", "n", F.col("number").alias("group"), "rest", "sha"))
        key, step = ["group", "read"], width * (GROW - 1)
        live = live.select("id", "n", "group", F.expr(f"substring(rest, 1, {step})").alias("read"),
                           F.expr(f"substring(rest, {step + 1})").alias("rest"), "sha")
        width += step
        groups = _groups(live.select("id", *key), *key)
        ended = F.col("size").isNull() | (F.col("n") <= width)
        done.append(live.join(groups, key, "left").where(ended).select("id", *alone, "sha"))

    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select(
        F.col("id").alias(id_col), F.col("keep").alias("keep_id"), F.col("size").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep")).alias("kept"), F.col("sha").alias("text_sha256"))


ORACLE = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM d
"""
