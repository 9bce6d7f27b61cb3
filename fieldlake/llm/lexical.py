"""Ranked lexical search by presence masks.

The documents become an inverted index in slices of some megabytes of text:
a slice's distinct terms, and for each the documents that hold it with the
number of times. Statistics of the corpus (documents with a term, all terms,
documents of a queried term) are sums over the slices.

For an item, the bits of its terms in a slice's documents are joined to one
mask per document, and documents of one mask form a group. A group's score is
at most the sum of the highest contributions of its mask's terms in the slice.
Groups are evaluated by descending bound, and the search of a slice ends when
the next bound is below the score of the worst kept document; a task carries
what it keeps from slice to slice, so later slices evaluate little. Bounds are
never below a score, so the result is exact. What a task keeps is ranked in
two steps, first by hash of the document, so no task ranks all of it.

Sizes: the text is read once and not shuffled; the index lies in the shared
folder, each slice packed by Arrow in a row group of its own, and goes to
Python slice by slice, so a task holds one slice however many its partition
has. A task sends at most ``top`` rows per item; they lie in the shared folder
too. The items' terms are brought to the driver in blocks of about
``ITEM_TERMS`` rows by hash of the item, and each block is searched in one pass
over the index.

Defined cases: a null text and one without terms are not counted and never
found; rows with one item id are one item with the terms of all of them, null
among them; an item without terms or hits has no rows; repeated documents are
ranked each; null document ids come last among equal scores; very long texts
are slices of their own; empty tables give an empty table; further columns
are not read, whatever their names. Document ids are integers.
"""

from __future__ import annotations

import contextlib
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from fieldlake.llm import subwords
from fieldlake.llm.common import col
from fieldlake.session import scratch_path

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 50
ITEM_TERMS = 200_000  # (item, term) rows searched at once, about
ROUND = 64  # documents evaluated between two looks at the bounds

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Bytes as they stand in a term: A-Z lower-cased; 0 where no term holds them.
_BYTES = np.zeros(256, "u1")
_BYTES[0x80:] = np.arange(0x80, 0x100)
for _c in "0123456789" + LOWER:
    _BYTES[ord(_c)] = ord(_c)
for _c in UPPER:
    _BYTES[ord(_c)] = ord(_c) + 32

INDEX = "lexicon binary, postings binary, n_docs long, n_terms long"
LEXICON, POSTINGS = ["terms", "ends"], ["ids", "sizes", "docs", "times"]  # packed in the columns of these names


def packed(lists: list[pa.Array], names: list[str]) -> pa.Array:
    """Lists as one compressed value: the JVM only passes it on."""
    rows = pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists], names)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd", use_threads=False)) as out:
        out.write_batch(rows)
    data = sink.getvalue()
    return pa.BinaryArray.from_buffers(pa.binary(), 1, [None, pa.py_buffer(np.array([0, data.size], "<i4")), data])


def unpacked(value: pa.Scalar) -> dict[str, pa.Array]:
    """The lists by their names."""
    with pa.ipc.open_stream(value.as_buffer(), options=pa.ipc.IpcReadOptions(use_threads=False)) as stream:
        rows = stream.read_next_batch()
    return {name: rows.column(name)[0].values for name in rows.schema.names}


def postings(table: pa.Table) -> list[pa.Array]:
    """The columns of one slice of the index; see ``INDEX``."""
    data, ends = subwords.text_bytes(table.column(1))
    own = _BYTES[data]
    inside = own != 0
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    text_starts = ends[:-1][np.diff(ends) > 0]
    first[text_starts] = inside[text_starts]  # a term ends with its text
    at = np.flatnonzero(first)
    bounds = np.append(np.cumsum(inside)[at] - 1, inside.sum()).astype("<i8")
    terms = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(at), [None, pa.py_buffer(bounds), pa.py_buffer(own[inside])]).dictionary_encode()
    n, n_terms = table.num_rows, len(terms.dictionary)
    doc = np.searchsorted(ends, at, side="right") - 1
    keys, times = np.unique(terms.indices.to_numpy().astype("<i8") * n + doc, return_counts=True)
    sizes = np.bincount(doc, minlength=n)
    stops = np.searchsorted(keys, np.arange(n_terms + 1, dtype="<i8") * n)
    return [packed([terms.dictionary.cast(pa.binary()), pa.array(stops, pa.int32())], LEXICON),
            packed([table.column(0).combine_chunks().cast(pa.int64()), pa.array(sizes, pa.int32()),
                    pa.array(keys % n, pa.int32()), pa.array(times, pa.int32())], POSTINGS),
            pa.array([int((sizes > 0).sum())], pa.int64()), pa.array([int(sizes.sum())], pa.int64())]


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The inverted index, one row per slice."""
    names = T._parse_datatype_string(INDEX).names

    def run(batches):
        for table in subwords.gathered(batches, 1):
            yield pa.RecordBatch.from_arrays(postings(table), names)

    return docs.select(col(id_col).cast("long"), col(text_col)).mapInArrow(run, INDEX)


def stored_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index in the shared folder, each slice a row group of its own:
    readers and writers hold whole row groups."""
    path = scratch_path(docs.sparkSession, "index")
    index(docs, id_col, text_col).write.option("parquet.block.row.count.limit", 1).parquet(path)
    return docs.sparkSession.read.parquet(path)


@contextlib.contextmanager
def slice_by_slice(spark: SparkSession) -> Iterator[None]:
    """What runs meanwhile hands rows to Python one by one: a slice has the
    size of many texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, term) without repeats."""
    lower = F.translate(col(text_col), UPPER, LOWER)
    return items.select(col(id_col).alias("item"), F.explode(F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))).alias("term")).distinct()


def _find(wanted: pa.Array, terms: pa.Array) -> np.ndarray:
    """The place of each wanted term in ``terms``, -1 where it is not."""
    return pc.fill_null(pc.index_in(wanted, value_set=terms), -1).to_numpy()


def statistics(stored: DataFrame, wanted: list[bytes]) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all terms, and documents of each wanted term."""
    sought = pa.array(wanted, pa.binary())

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                lexicon = unpacked(batch.column(0)[row])
                at, ends = _find(sought, lexicon["terms"]), lexicon["ends"].to_numpy()
                here = np.flatnonzero(at >= 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(here, pa.int64()), pa.array(ends[at[here] + 1] - ends[at[here]], pa.int64())], ["term", "n"])

    sums = stored.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    df = np.zeros(len(wanted), "<i8")
    for r in (stored.select("lexicon").mapInArrow(run, "term long, n long")
              .groupBy("term").agg(F.sum("n").alias("n")).collect()):  # at most a row per wanted term
        df[r["term"]] = r["n"]
    return sums[0] or 0, sums[1] or 0, df


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


class Slice:
    """One slice's postings of the queried terms, with their contributions."""

    def __init__(self, row: dict[str, pa.Array], sought: pa.Array, weights: np.ndarray, n: int, total: int):
        ids = row["ids"]
        self.no_id = ids.is_null().to_numpy(zero_copy_only=False)
        self.ids = pc.fill_null(ids, 0).to_numpy()
        self.n = len(ids)
        place = _find(sought, row["terms"])
        ends = row["ends"].to_numpy()
        m = 50 + 50 * row["sizes"].to_numpy().astype("<i8") * n // max(total, 1)
        docs, times = row["docs"].to_numpy(), row["times"].to_numpy()
        self.held = {}  # queried term -> its documents, contributions and the highest one
        for t in np.flatnonzero(place >= 0).tolist():
            span = slice(ends[place[t]], ends[place[t] + 1])
            tf = times[span].astype("<i8")
            value = weights[t] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[docs[span]]))
            self.held[t] = docs[span], value, value.max()

    def groups(self, terms: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents by mask of ``terms``: the documents with any, group by
        group in descending order of the highest possible score, where the
        groups start, and these scores."""
        masks = np.zeros((-(-len(terms) // 8), self.n), "u1")
        for k, t in enumerate(terms):
            masks[k >> 3, self.held[t][0]] |= np.uint8(1 << (k & 7))
        found = np.flatnonzero(masks.any(axis=0))
        rows = np.ascontiguousarray(masks[:, found].T)
        kinds, group = np.unique(rows.view(f"V{rows.shape[1]}").ravel(), return_inverse=True)
        bits = kinds.view("u1").reshape(len(kinds), -1)
        bounds = np.zeros(len(kinds), "<i8")
        for k, t in enumerate(terms):
            bounds += self.held[t][2] * (bits[:, k >> 3] >> (k & 7) & 1)
        order = np.argsort(-bounds, kind="stable")
        rank = np.empty(len(kinds), "<i8")
        rank[order] = np.arange(len(kinds))
        by = np.argsort(rank[group], kind="stable")
        starts = np.searchsorted(rank[group][by], np.arange(len(kinds) + 1))
        return found[by], starts, bounds[order]

    def scores(self, terms: list[int], docs: np.ndarray) -> np.ndarray:
        out = np.zeros(len(docs), "<i8")
        for t in terms:
            held, value, _ = self.held[t]
            at = np.minimum(np.searchsorted(held, docs), len(held) - 1)
            out += np.where(held[at] == docs, value[at], 0)
        return out


class Best:
    """The ``top`` documents of one item so far."""

    def __init__(self, top: int):
        self.top = top
        self.score, self.id, self.no_id = np.zeros(0, "<i8"), np.zeros(0, "<i8"), np.zeros(0, bool)

    def least(self) -> int:
        """A score below which no document comes in."""
        return max(1, int(self.score[-1])) if len(self.score) == self.top else 1

    def search(self, held: Slice, terms: list[int]) -> None:
        terms = [t for t in terms if t in held.held]
        if not terms or sum(int(held.held[t][2]) for t in terms) < self.least():
            return
        docs, starts, bounds = held.groups(terms)
        at = 0
        while at < len(bounds) and bounds[at] >= self.least():
            # whole groups of the next documents, as far as their bounds still count
            to = max(at + 1, int(np.searchsorted(starts, starts[at] + ROUND, side="right")) - 1)
            to = min(to, at + int(np.searchsorted(-bounds[at:], -self.least(), side="right")))
            some = docs[starts[at]:starts[to]]
            self.add(held.scores(terms, some), held.ids[some], held.no_id[some])
            at = to

    def add(self, score: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        keep = score >= self.least()
        score, ids, no_id = (np.append(a, b[keep]) for a, b in (
            (self.score, score), (self.id, ids), (self.no_id, no_id)))
        order = np.lexsort((ids, no_id, -score))[:self.top]
        self.score, self.id, self.no_id = score[order], ids[order], no_id[order]


def _searched(stored: DataFrame, block: dict, top: int) -> DataFrame:
    """(item number, doc, score): what each task keeps of its slices."""
    names = list(block)  # items in the order of their numbers
    wanted = sorted({t for terms in block.values() for t in terms})
    number = {t: k for k, t in enumerate(wanted)}
    sought_by = [[number[t] for t in sorted(block[i])] for i in names]
    n, total, df = statistics(stored, wanted)
    weights = np.array([weight(n, x) for x in df.tolist()], "<i8")

    def run(batches):
        sought = pa.array(wanted, pa.binary())
        best = [Best(top) for _ in sought_by]
        for batch in batches:
            for row in range(batch.num_rows):
                held = Slice(unpacked(batch.column(0)[row]) | unpacked(batch.column(1)[row]), sought, weights, n, total)
                for one, terms in zip(best, sought_by, strict=True):
                    one.search(held, terms)
        item = np.repeat(np.arange(len(best)), [len(b.score) for b in best])
        join = lambda part, kind: np.concatenate([getattr(b, part) for b in best] or [np.zeros(0, kind)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int32()), pa.array(join("id", "<i8"), mask=join("no_id", bool)),
             pa.array(join("score", "<i8"))], ["number", "doc", "score"])

    return stored.select("lexicon", "postings").mapInArrow(run, "number int, doc long, score long")


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The ``top`` documents of each item: item, rank, document and score."""
    spark = docs.sparkSession
    asked_path = scratch_path(spark, "items")
    stored = stored_index(docs, id_col, text_col)
    item_terms(items, item_col, item_text_col).write.parquet(asked_path)
    asked = spark.read.parquet(asked_path)
    blocks = asked.count() // ITEM_TERMS + 1
    kind, doc_kind = items.schema[item_col].dataType, docs.schema[id_col].dataType
    out = None
    for b in range(blocks):
        block = defaultdict(set)
        for r in asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect():  # about ITEM_TERMS
            block[r["item"]].add(r["term"].encode())
        names = spark.createDataFrame(list(enumerate(block)), T.StructType(
            [T.StructField("number", T.IntegerType()), T.StructField("item", kind)]))
        found_path = scratch_path(spark, "found")
        with slice_by_slice(spark):
            _searched(stored, block, top).write.parquet(found_path)
        found = spark.read.parquet(found_path).join(names, "number")
        out = found if out is None else out.unionByName(found)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("score").desc(), F.col("doc").asc_nulls_last()]
    some = Window.partitionBy("item", F.pmod(F.xxhash64("doc"), F.lit(parts))).orderBy(*order)
    whole = Window.partitionBy("item").orderBy(*order)
    return (out.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top)
            .withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= top)
            .select(F.col("item").alias(item_col), "rank", F.col("doc").cast(doc_kind).alias(id_col), "score"))


ORACLE = """
WITH t AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM t GROUP BY ALL),
size AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
corpus AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS total FROM size),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
      FROM tf, corpus WHERE term IN (SELECT term FROM q) GROUP BY term, n_docs),
s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // total))))::BIGINT AS score
      FROM q JOIN tf USING (term) JOIN w USING (term) JOIN size USING (doc_id), corpus GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
       doc_id, score
FROM s WHERE score > 0
QUALIFY rank <= 50
"""
