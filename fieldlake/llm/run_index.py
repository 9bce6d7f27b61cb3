"""Long repeats by a run-length index.

Every byte covered by a string of ``LENGTH`` bytes that also starts earlier
(smaller id, or earlier in the same text) is removed. The work has two parts.

Anchors make it local. In each window of LENGTH bytes the K-gram of least
hash (the last of equals) is its anchor, so equal windows have equal anchors
at equal places. Windows that follow each other and share an anchor make one
context. A context whose anchor occurs once holds no repeat. Of equal
contexts all but the first are repeats whole, which takes no index: a fixed
bitmap of the repeated anchors tells them, and the first contexts are listed.

The rest, first contexts whose anchor has several, go to shards by anchor.
A shard sorts its windows, builds the run-compressed Burrows-Wheeler
transform with a sample (the earliest start) for each match class, and
streams its contexts through it backwards: a step is a rank query on runs,
and the sample of the class it lands in says whether the window starts
earlier elsewhere.

Sizes: shards hold about ``SHARD`` bytes. An anchor with more than ``MANY``
different contexts is not sharded; its windows are grouped by their bytes,
pre-aggregated, so no group has to fit a task. The bitmap has a fixed number
of bits; as it fills, more contexts are listed than need be, and the result
stays the same. Texts are shuffled twice, for contexts and for marks.

Defined cases: a null text is an empty one; rows that repeat both id and
text are one document and change alike; different texts of one id are
ordered by their hash; a null id comes before all others; an empty table
gives an empty table; further columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from fieldlake.llm.common import col, pinned

LENGTH, K = 100, 32
SHARD, MANY = 1_500_000, 10_000
BITS = 1 << 28  # of the bitmap of repeated anchors: 32 MB
_PIECE, _PLACE = 1 << 19, (1 << 20) - 1
_GOLD, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xD6E8FEB86659FD93)
_TABLE = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k-gram, put together from grams of powers of two."""
    part, size, out, have = _TABLE[data], 1, None, 0
    n = len(data)
    while True:
        if k & 1:
            if out is None:
                out, have = part, size
            else:
                m = n - have - size + 1
                out = out[:m] * np.uint64(pow(_GOLD, size, 1 << 64)) + part[have:have + m]
                have += size
        k >>= 1
        if not k:
            break
        m = n - 2 * size + 1
        part = part[:m] * np.uint64(pow(_GOLD, size, 1 << 64)) + part[size:size + m]
        size *= 2
    out = out * _MIX
    return out ^ (out >> np.uint64(32))


def contexts(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first window, windows) of each context of a text."""
    parts = []
    for at in range(0, max(0, len(text) - LENGTH + 1), _PIECE):
        data = np.frombuffer(text, dtype=np.uint8, count=min(len(text) - at, _PIECE + LENGTH - 1), offset=at)
        h = _gram_hashes(data, K)
        mask = np.uint64(_PLACE)
        low = (h & ~mask) | (mask - np.arange(len(h), dtype=np.uint64))
        width, size = LENGTH - K + 1, 1
        while size * 2 <= width:
            low = np.minimum(low[:len(low) - size], low[size:])
            size *= 2
        if width > size:
            low = np.minimum(low[:len(low) - (width - size)], low[width - size:])
        anchor = (mask - (low & mask)).astype(np.int64)
        start = np.concatenate([[0], np.flatnonzero(np.diff(anchor)) + 1])
        parts.append((h[anchor[start]], start + at, np.diff(np.append(start, len(anchor)))))
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _bytes(x) -> bytes:
    return (x.as_py() or "").encode()


def numbered(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, bool]:
    """(ord, id, text): ``ord`` orders the documents and is one for rows that
    repeat both id and text. It is the id itself where ids are whole numbers,
    none is missing and none comes twice; whether this is so comes second."""
    rows = docs.select(col(id_col).alias("id"), F.coalesce(col(text_col), F.lit("")).alias("text"))
    if isinstance(docs.schema[id_col].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        odd = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or id is null")
        if odd.isEmpty():
            return rows.select(F.col("id").cast("long").alias("ord"), "id", "text"), True
    rows = rows.withColumn("row", F.xxhash64("text"))
    parts = max(1, min(200, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    ranges = pinned(rows.select("id", "row").distinct().repartitionByRange(parts, "id", "row")
                    .withColumn("part", F.spark_partition_id()))
    starts = (ranges.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # a row per range
              .select("part", F.coalesce(F.sum("n").over(
                  Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start")))
    ranked = ranges.join(starts, "part").select(
        F.col("id").alias("i"), F.col("row").alias("r"),
        (F.col("start") + F.row_number().over(Window.partitionBy("part").orderBy("id", "row"))).alias("ord"))
    return rows.join(ranked, F.col("id").eqNullSafe(F.col("i")) & (F.col("row") == F.col("r"))).select(
        "ord", "id", "text"), False


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _anchors(batches):
    for batch in batches:
        found = [contexts(_bytes(t))[0] for t in batch.column(0)]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(_signed(np.concatenate(found)))], ["anchor"])


def repeated_anchors(rows: DataFrame) -> np.ndarray:
    """A bitmap, of fixed size, with the bit of each anchor that occurs twice."""
    twice = (rows.select("text").mapInArrow(_anchors, "anchor long").groupBy("anchor")
             .agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    bit = F.pmod("anchor", F.lit(BITS)) + 1  # Spark's bitmaps count from 1
    parts = (twice.groupBy(F.bitmap_bucket_number(bit).alias("part"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).toLocalIterator())
    out = np.zeros(BITS // 8, dtype=np.uint8)
    for part, bits in parts:  # at most BITS // 32768 rows of 4 KB
        at = (part - 1) * 4096
        out[at:at + len(bits)] |= np.frombuffer(bytes(bits), dtype=np.uint8)
    return out


def _seen(bitmap: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    bit = (anchor % np.uint64(BITS)).astype(np.int64)
    return (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def first_contexts(rows: DataFrame, bitmap) -> DataFrame:
    """(anchor, digest, first, n): different contexts of repeated anchors,
    where the first of each stands and how many windows it has."""

    def run(batches):
        from xxhash import xxh64_intdigest as xxh

        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for ord_, text in zip(batch.column(0).to_numpy(zero_copy_only=False), batch.column(1), strict=True):
                data = _bytes(text)
                anchor, at, n = contexts(data)
                keep = _seen(bitmap.value, anchor)
                anchor, at, n = anchor[keep], at[keep], n[keep]
                digest = [xxh(data[a:b]) for a, b in zip(at.tolist(), (at + n + LENGTH - 1).tolist(), strict=True)]
                for x, y in zip(out, (_signed(anchor), np.array(digest, np.uint64).view(np.int64),
                                      np.full(len(at), ord_, np.int64), at, n), strict=True):
                    x.append(y)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out],
                                                 ["anchor", "digest", "ord", "at", "n"])

    found = rows.select("ord", "text").mapInArrow(run, "anchor long, digest long, ord long, at long, n long")
    return found.groupBy("anchor", "digest", "n").agg(F.min(F.struct("ord", "at")).alias("first"))


class RunIndex:
    """The run-length index of a text of contexts, sorted to LENGTH bytes."""

    def __init__(self, text: np.ndarray, start: np.ndarray):
        """start: the start of the window at each place, as one number."""
        n = len(text)
        order, rank = self._by_eight(text)
        size = 8
        while size < LENGTH:
            steps = (size, 2 * size) if 3 * size <= LENGTH and n < 1 << 21 else (min(size, LENGTH - size),)
            order, rank = self._join(rank, steps)
            size += steps[-1]
        head = np.flatnonzero(np.diff(rank[order], prepend=-1))
        self.head_of = head[rank[order]]  # the first row of each row's class
        self.earliest = np.minimum.reduceat(start[order], head)[rank[order]]  # the sample of each class
        bwt = text[order - 1]
        first = np.flatnonzero(np.diff(bwt.astype(np.int16), prepend=-1))
        size = np.diff(np.append(first, n))
        by = np.argsort(bwt[first], kind="stable")
        char = bwt[first][by].astype(np.int64)
        self.n, self.size, self.first = n, size[by], first[by]
        self.key = char * (n + 1) + self.first
        total = np.concatenate([[0], np.cumsum(self.size)])
        # counting in order of character, the runs before one are those of
        # smaller characters and its own earlier ones: the rank with C added
        self.before = total[:-1]
        self.smaller = total[np.searchsorted(char, np.arange(257))]

    @staticmethod
    def _by_eight(text: np.ndarray) -> np.ndarray:
        padded = np.concatenate([text, np.full(8, 0xFF, np.uint8)]).astype(np.uint64)
        key = np.zeros(len(text), np.uint64)
        for i in range(8):
            key = (key << np.uint64(8)) | padded[i:i + len(text)]
        return RunIndex._ranks(key)

    @staticmethod
    def _ranks(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The order of the keys, and each one's rank; equal keys rank alike."""
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(len(key), np.int64)
        rank[order] = np.cumsum(np.diff(ordered, prepend=ordered[:1]) != 0)
        return order, rank

    @staticmethod
    def _join(rank: np.ndarray, steps: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
        """Ranks by this rank and those so many bytes further on."""
        key, bits = rank.astype(np.uint64), np.uint64(32 if len(steps) == 1 else 21)
        for step in steps:
            after = np.zeros(len(rank), np.uint64)
            after[:len(rank) - step] = rank[step:] + 1
            key = (key << bits) | after
        return RunIndex._ranks(key)

    def back(self, row: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The first row whose suffix is ``char`` and one from ``row`` on."""
        c = char.astype(np.int64)
        run = np.searchsorted(self.key, c * (self.n + 1) + row, side="right") - 1
        own = (run >= 0) & (self.key[run] >= c * (self.n + 1))
        inside = np.minimum(row - self.first[run], self.size[run])
        return np.where(own, self.before[run] + inside, self.smaller[c])

    def starts(self, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The class of each row: its first row and its sample."""
        return self.head_of[row], self.earliest[row]


def repeats_in(pieces: list[bytes], order: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """For each context, which of its windows start earlier in another."""
    size = np.array([len(p) for p in pieces], np.int64)
    end = np.cumsum(size + 1) - 1  # where the separators are
    begin = end - size
    text = np.frombuffer(b"\xff".join(pieces) + b"\xff", dtype=np.uint8)
    of = np.repeat(np.arange(len(pieces)), size + 1)
    start = (order[of] << 40) + at[of] + np.arange(len(text)) - begin[of]
    index = RunIndex(text, start)
    found = [np.zeros(n - LENGTH + 1, bool) for n in size]
    flat = np.zeros(len(text), bool)
    by = np.argsort(-size, kind="stable")
    place, row = end[by].copy(), np.zeros(len(by), np.int64)
    for step in range(1, int(size.max()) + 1):
        live = int(np.searchsorted(-size[by], -step, side="right"))  # those with a byte left
        place[:live] -= 1
        row[:live] = index.back(row[:live], text[place[:live]])
        if step >= LENGTH:
            row[:live], earliest = index.starts(row[:live])
            flat[place[:live]] = earliest < start[place[:live]]
    for i, (a, n) in enumerate(zip(begin.tolist(), size.tolist(), strict=True)):
        found[i] = flat[a:a + n - LENGTH + 1]
    return found


def _shard(part: pd.DataFrame) -> pd.DataFrame:
    order = part["ord"].rank(method="dense").to_numpy().astype(np.int64)
    marks = repeats_in(part["body"].tolist(), order, part["at"].to_numpy())
    return pd.DataFrame({"ord": part["ord"].to_numpy(), "at": part["at"].to_numpy(),
                         "mark": [np.packbits(m).tobytes() for m in marks]})


def _bodies(batches):
    for batch in batches:
        rows = {"anchor": [], "ord": [], "at": [], "body": []}
        for ord_, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(),
                                      strict=True):
            data = _bytes(text)
            for w in wanted:
                rows["anchor"].append(w["anchor"])
                rows["ord"].append(ord_)
                rows["at"].append(w["at"])
                rows["body"].append(data[w["at"]:w["at"] + w["n"] + LENGTH - 1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows["anchor"], pa.int64()), pa.array(rows["ord"], pa.int64()), pa.array(rows["at"], pa.int64()),
             pa.array(rows["body"], pa.binary())], list(rows))


def _fetch(rows: DataFrame, single: bool, wanted: DataFrame) -> DataFrame:
    """The wanted contexts' bytes, each once. ``single``: no document comes
    twice, so its bytes need no shuffle of their own."""
    by_row = wanted.groupBy("ord").agg(F.collect_list(F.struct("anchor", "at", "n")).alias("wanted"))
    one = rows.select("ord", "text").join(by_row, "ord").select("ord", "text", "wanted")
    bodies = one.mapInArrow(_bodies, "anchor long, ord long, at long, body binary")
    return bodies if single else bodies.dropDuplicates(["ord", "at"])


def _single_windows(bodies: DataFrame) -> DataFrame:
    """Marks for anchors with many contexts: each window's earliest start
    from a grouping by its bytes."""
    windows = (bodies.select("ord", "at", "body",
                             F.posexplode(F.sequence(F.lit(1), F.octet_length("body") - (LENGTH - 1))).alias("i", "j"))
               .select("ord", "at", "i", F.expr(f"substring(body, j, {LENGTH})").alias("window")))
    start = F.struct("ord", (F.col("at") + F.col("i")).alias("start"))
    first = windows.groupBy("window").agg(F.min(start).alias("first"))
    marked = windows.join(first, "window").select("ord", "at", "i", (F.col("first") < start).alias("hit"))
    return (marked.groupBy("ord", "at").agg(F.sort_array(F.collect_list(F.struct("i", "hit"))).alias("w"))
            .select("ord", "at", F.col("w.hit").alias("hits")).mapInArrow(_packed, "ord long, at long, mark binary"))


def _packed(batches):
    for batch in batches:
        marks = [np.packbits(np.array(x.as_py(), bool)).tobytes() for x in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(marks, pa.binary())],
                                         ["ord", "at", "mark"])


def _cover(text: bytes, bitmap: np.ndarray, listed: np.ndarray, marks: list) -> tuple[np.ndarray, np.ndarray]:
    """Start and stop of each run of removed bytes; listed: where the listed
    contexts start, marks: their marks, none where no window is a repeat."""
    anchor, at, n = contexts(text)
    if not len(at):
        return at, at
    seen, own = _seen(bitmap, anchor), np.searchsorted(at, listed)
    seen[own] = False
    hit = np.repeat(seen, n)
    for a, m, mark in zip(listed.tolist(), n[own].tolist(), marks, strict=True):
        if mark is not None:
            hit[a:a + m] = np.unpackbits(np.frombuffer(mark, np.uint8), count=m)
    edge = np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + LENGTH - 1
    if len(start):  # runs whose bytes overlap or touch are one
        new = np.concatenate([[True], start[1:] > stop[:-1]])
        start, stop = start[new], stop[np.concatenate([new[1:], [True]])]
    return start, stop


def long_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard: int = SHARD,
                 many: int = MANY) -> DataFrame:
    """Per row its id, n_bytes, n_removed, n_spans, the SHA-256 of what stays,
    and the removed ``spans``."""
    spark = docs.sparkSession
    rows, single = numbered(docs, id_col, text_col)
    bitmap = spark.sparkContext.broadcast(repeated_anchors(rows))
    firsts = pinned(first_contexts(rows, bitmap))
    kinds = pinned(firsts.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1"))
    several = firsts.join(kinds, "anchor").select(
        "anchor", "kinds", "n", F.col("first.ord").alias("ord"), F.col("first.at").alias("at"))
    total = several.where(F.col("kinds") <= many).agg(F.sum(F.col("n") + LENGTH)).first()[0] or 0
    few = _fetch(rows, single, several.where(F.col("kinds") <= many))
    shards = F.pmod(F.xxhash64("anchor"), F.lit(max(1, -(-total // shard))))
    marks = (few.groupBy(shards.alias("shard")).applyInPandas(_shard, "ord long, at long, mark binary"))
    if not several.where(F.col("kinds") > many).isEmpty():
        marks = marks.unionByName(_single_windows(_fetch(rows, single, several.where(F.col("kinds") > many))))
    listed = (firsts.select(F.col("first.ord").alias("ord"), F.col("first.at").alias("at"))
              .withColumn("mark", F.lit(None).cast("binary")).unionByName(marks)
              .groupBy("ord", "at").agg(F.max("mark").alias("mark"))
              .groupBy("ord").agg(F.collect_list(F.struct("at", "mark")).alias("listed")))
    met = rows.join(listed, "ord", "left").select("id", "text", "listed")

    def run(batches):
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            lists = batch.column(2)
            inside = lists.flatten()
            places, marks = inside.field("at").to_numpy(zero_copy_only=False), inside.field("mark").to_pylist()
            ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
            for text, first, last in zip(batch.column(1), [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                data = _bytes(text)
                start, stop = _cover(data, bitmap.value, places[first:last], marks[first:last])
                digest, at = hashlib.sha256(), 0
                for a, b in zip(start.tolist(), stop.tolist(), strict=True):
                    digest.update(data[at:a])
                    at = b
                digest.update(data[at:])
                for x, y in zip(out, (len(data), int((stop - start).sum()), len(start), digest.hexdigest(), [
                        {"start": a, "stop": b} for a, b in zip(start.tolist(), stop.tolist(), strict=True)]),
                        strict=True):
                    x.append(y)
            span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            kinds_ = (pa.int64(), pa.int64(), pa.int64(), pa.string(), span)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, out, kinds_)], names)

    names = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
    kind = docs.schema[id_col].dataType.simpleString()
    return met.mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                               "spans array<struct<start:long,stop:long>>")
