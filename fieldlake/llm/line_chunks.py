"""Line dedup by content-defined chunks of lines.

Every line has a 128-bit hash. A rolling hash, that is the hashes of two lines
with a word that follow each other and the blank lines between them, moves over
each text line by line. Boundaries depend on content alone: a chunk ends where
the rolling value stands nowhere else in the corpus, so a passage that stands
twice is cut alike wherever it stands, and a chunk grows line by line over all of
it. A chunk has two or more lines with a word, and each two of its lines stand
elsewhere too. It is removed, except where one of its rolling values has its
first place (smallest id, then place in the text); of lines that overlap their
own first place (A A A) only those beyond it go. So of every run of two or more
lines that repeats, each line goes but in its first place, whatever stands around
the run, and every line is kept somewhere.

Hashes are compared by bytes: all lines are grouped by their hash and their
bytes, and if one hash names two lines, all are hashed again with another seed.
Rolling values hold the hashes themselves and the blank lines as they are, so
equal values are equal bytes.

Sizes: the bytes of different lines are shuffled once, combined before, so a
line common to a third of all rows is one row per map task. Rolling values are
numbers; they meet the repeated ones in a join whose skewed partitions Spark
splits. Texts are shuffled once, to meet their removed chunks; a row gets at
most the numbers of its own text.

Defined cases: a null text has no lines and stays null; a text without a
removed chunk stays as it is, byte by byte; one that loses every line with a
word is empty; blank lines before and after a chunk stay; rows that repeat both
id and text are one document and change alike; a null id comes before all
others; a very long text is one row; an empty table gives an empty table;
further columns pass through unchanged, whatever their names.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from fieldlake.llm.common import col, columns_of, fresh, pinned

SEED = 0
_MASK = (1 << 64) - 1
_WORD = re.compile(rb"[^\x20\x09-\x0D]").search
ROLLED = ("a1", "b1", "a2", "b2", "gap")  # a rolling value: two hashes of two halves, and what is between the lines


def line_hash(line: bytes, seed: int) -> tuple[int, int]:
    """The two halves of a line's hash, as signed numbers."""
    from xxhash import xxh3_128_intdigest

    d = xxh3_128_intdigest(line, seed)
    return (d >> 64) - (1 << 63), (d & _MASK) - (1 << 63)


def _worded(lines: list[bytes]) -> list[int]:
    return [i for i, line in enumerate(lines) if _WORD(line)]


def rolled(text: bytes, seed: int):
    """The rolling value of each line with a word and the next one."""
    lines = text.split(b"\n")
    at = _worded(lines)
    hashes = [line_hash(lines[i], seed) for i in at]
    for i, j, x, y in zip(at, at[1:], hashes, hashes[1:], strict=False):
        yield *x, *y, b"".join(line + b"\n" for line in lines[i + 1:j])


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.where(F.instr(col(text_col), "\n") > 0).select(
        col(id_col).alias("id"), F.xxhash64(col(text_col)).alias("row"), col(text_col).alias("text"))


def _values(rows: DataFrame, seed: int) -> DataFrame:
    """(id, row, k) and the rolling value at the k-th line with a word."""
    schema = T.StructType([rows.schema["id"], rows.schema["row"], T.StructField("k", T.IntegerType()),
                           *(T.StructField(c, T.LongType()) for c in ROLLED[:-1]), T.StructField("gap", T.BinaryType())])
    kinds = [pa.int64()] * 4 + [pa.binary()]

    def run(batches):
        for batch in batches:
            at, number, values = [], [], []
            for i, text in enumerate(batch.column(2)):
                own = list(rolled((text.as_py() or "").encode(), seed))
                at += [i] * len(own)
                number += range(len(own))
                values += own
            at = pa.array(at, pa.int64())
            columns = zip(*values, strict=True) if values else [()] * len(ROLLED)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(number, pa.int32()),
                 *(pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True))], schema.names)

    return rows.mapInArrow(run, schema)


def _one_line_each(rows: DataFrame, seed: int) -> bool:
    """Whether no hash names two different lines."""
    def run(batches):
        for batch in batches:
            lines = {x for text in batch.column(2) for x in (text.as_py() or "").encode().split(b"\n") if _WORD(x)}
            hashes = [line_hash(x, seed) for x in lines]
            yield pa.RecordBatch.from_arrays(
                [pa.array([h[0] for h in hashes], pa.int64()), pa.array([h[1] for h in hashes], pa.int64()),
                 pa.array(list(lines), pa.binary())], ["a", "b", "line"])

    lines = rows.select("id", "row", "text").mapInArrow(run, "a long, b long, line binary").distinct()
    return lines.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, row, k, tail): the lines with a word, by number, that go with the
    next one; with ``tail`` only the next one goes, as this one ends the value's
    first place. ``row`` is the hash of the text, which tells rows of one id apart."""
    rows, seed = _rows(docs, id_col, text_col), SEED
    while not _one_line_each(rows, seed):
        seed += 1
    values = _values(rows, seed)
    place = F.struct("id", "row", "k")
    named = pinned(values.groupBy(*ROLLED).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
                   .where("n > 1").drop("n"))
    tail = (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("row") == F.col("first.row"))
            & (F.col("k") == F.col("first.k") + 1))
    return (values.join(named, list(ROLLED)).where(~place.eqNullSafe(F.col("first")))
            .select("id", "row", "k", tail.alias("tail")))


def _cut(text: str, whole: list[int], tails: list[int]) -> str:
    """``text`` without the lines ``whole`` and their next ones, and without the
    next ones of ``tails``, with the blank lines in between."""
    lines = text.encode().split(b"\n")
    stays, at = bytearray(b"\1" * len(lines)), _worded(lines)
    for numbers, skip in ((whole, 0), (tails, 1)):
        for k in numbers:
            a, b = at[k] + skip, at[k + 1] + 1
            stays[a:b] = bytes(b - a)
    if not any(stays[i] for i in at):
        return ""
    return b"\n".join(line for line, s in zip(lines, stays, strict=True) if s).decode()


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` without the repeated chunks, and the name of a new column: how
    many of them the row lost."""
    i, r, w, t, n = fresh(docs, "id", "row", "whole", "tails", "n_removed")
    gone = removed(docs, id_col, text_col)
    gone = (gone.groupBy(F.col("id").alias(i), F.col("row").alias(r))
            .agg(F.collect_set(F.when(~F.col("tail"), F.col("k"))).alias(w),
                 F.collect_set(F.when(F.col("tail"), F.col("k"))).alias(t)))
    met = (docs.join(gone, col(id_col).eqNullSafe(F.col(i)) & (F.xxhash64(col(text_col)) == F.col(r)), "left")
           .select(*columns_of(docs), col(w), col(t)))
    at, last = docs.columns.index(text_col), len(docs.columns)
    schema = T.StructType([*docs.schema.fields, T.StructField(n, T.IntegerType())])

    def run(batches):
        for batch in batches:
            lists = [[x or [] for x in own] for own in zip(*(batch.column(last + k).to_pylist() for k in (0, 1)), strict=True)]
            texts = [_cut(x, *own) if any(own) else x for x, own in zip(batch.column(at).to_pylist(), lists, strict=True)]
            out = list(batch.columns[:last])
            out[at] = pa.array(texts, pa.string())
            runs = [sum(k - 1 not in both for k in both) for both in ({*a, *b} for a, b in lists)]
            yield pa.RecordBatch.from_arrays([*out, pa.array(runs, pa.int32())], [*batch.schema.names[:last], n])

    return met.mapInArrow(run, schema), n
