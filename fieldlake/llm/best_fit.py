"""Best-fit packing after Martello and Toth's dominance reduction.

Texts become token ids that end with an end id; longer ones are cut into
pieces of the capacity, of which the first may be shorter. Pieces of one
length are alike, so the instance to pack is a histogram of at most
``capacity`` lengths, however many documents there are:

1. Reduction: for a length, the sets it can share a sequence with are compared.
   Where one set of at most three pieces provably dominates all others (nothing
   else fits; a partner fills the sequence; only one more fits; the best partner
   is at least the best pair; or the best pair is at least every single piece
   and every pair, member by member), it is fixed, as often as its lengths
   are there. Fixed sets leave the instance, and the rest is looked at again.
2. Best fit, longest first, on what remains: every length goes to the fullest
   sequences it fits in, whole groups of like sequences at a time.

The result is a table of placements (length, first rank, number, first
sequence, offset): its size depends on the capacity, not on the data, so the
driver makes it and each task holds it. Pieces are ranked within their length
by hash buckets, whose number grows with the table, so that a length held by a
third of all pieces is still split; a bucket's first rank is a running sum
over the buckets of its length.

Sizes: the text is read once and nothing of it is shuffled; one row of six
numbers per piece is written to the shared folder and shuffled once. The
ranks are a pure function of that table, so lost executors change nothing.

Defined cases: a null or empty text is one piece that holds the end id alone;
a very long text is tokenised whole, in units; repeated rows are packed as
documents of their own; an empty table gives an empty table; further columns
are not read, whatever their names. The text of an added token becomes its id,
as the tokenizer has it.
"""

from __future__ import annotations

import zlib
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from fieldlake.llm import subwords
from fieldlake.llm.common import col
from fieldlake.session import scratch_path

CAPACITY = 1024
END_ID = 2
PER_BUCKET = 100_000  # pieces ranked by one task, about


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: all full but the first."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, path: str, pattern: str, end_id: int = END_ID, capacity: int = CAPACITY,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every piece of every text."""
    kind = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind)] + [
        T.StructField(c, t) for c, t in (("piece", T.IntegerType()), ("start", T.LongType()),
                                         ("length", T.LongType()), ("ids_crc32", T.LongType()))])

    def run(batches):
        coder = subwords.byte_level(path, pattern, True)
        for table in subwords.gathered(batches, 1):
            data, ends = subwords.text_bytes(table.column(1))
            units = subwords.Units(data, ends)
            ids, counts = subwords.spread(*coder.words(units.words), units.codes)
            stops = np.append(0, np.cumsum(counts))[units.bounds]
            rows = []
            for row, (a, b) in enumerate(zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True)):
                own = np.append(ids[a:b], end_id).astype("<u4")
                rows += [(row, k, s, n, zlib.crc32(own[s:s + n]))
                         for k, (s, n) in enumerate(cut(b - a + 1, capacity))]
            row, piece, start, length, crc = map(list, zip(*rows, strict=True))
            keys = table.column(0).combine_chunks().take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                schema.names)

    return docs.select(col(id_col), col(text_col)).mapInArrow(run, schema)


class Plan:
    """Placements of pieces by length and rank in sequences."""

    def __init__(self, counts: Mapping[int, int], capacity: int):
        self.left = {n: c for n, c in counts.items() if c}
        self.rank = dict.fromkeys(self.left, 0)
        self.capacity, self.sequences, self.rows = capacity, 0, []

    def place(self, length: int, n: int, base: int, used: int) -> None:
        """The next ``n`` pieces of a length, one in each sequence from ``base`` on."""
        self.rows.append((length, self.rank[length], n, base, used))
        self.rank[length] += n
        self.left[length] -= n
        if not self.left[length]:
            del self.left[length]

    def fix(self, lengths: tuple[int, ...]) -> None:
        """New sequences of these pieces, as many as there can be."""
        n = min(self.left[x] // lengths.count(x) for x in lengths)
        used = 0
        for x in lengths:
            self.place(x, n, self.sequences, used)
            used += x
        self.sequences += n


def _pair(left: Mapping[int, int], lengths: list[int], room: int) -> tuple[int, int] | None:
    """The two pieces (the longer first) that fill ``room`` best; of equal
    sums the one with the longest piece."""
    best, low, ups = None, 0, lengths[::-1]
    for a in lengths:  # longest first
        if a >= room:
            continue
        while low < len(ups) and ups[low] <= room - a:
            low += 1
        at = low - 1
        if at >= 0 and ups[at] == a and left[a] < 2:
            at -= 1  # only one of them is there
        if at >= 0 and ups[at] <= a and (best is None or a + ups[at] > sum(best)):
            best = a, ups[at]
    return best


def dominant(left: Mapping[int, int], j: int, capacity: int) -> tuple[int, ...] | None:
    """The set with a piece of length ``j`` that dominates all other sets with
    one, if it is shown to: every other feasible set can be split so that its
    parts are no longer than the members of this one, each part to a member."""
    others = dict(left)
    others[j] -= 1
    room = capacity - j
    fits = sorted((x for x, n in others.items() if n and x <= room), reverse=True)
    if not fits:
        return (j,)
    best, smallest, small = fits[0], [], 0
    for x in reversed(fits):  # how many of the smallest fit
        n = min(others[x], 4)
        smallest += [x] * n
        if len(smallest) >= 4:
            break
    most = 0
    for x in smallest:
        small += x
        if small > room:
            break
        most += 1
    if best == room or most == 1:
        return (j, best)
    if most > 2:
        return None
    pair = _pair(others, fits, room)
    if pair is None or best >= sum(pair):
        return (j, best)
    a, b = pair
    if best > a:
        return None
    # a is the longest that fits: no single piece is longer; of the other
    # pairs none may have a second piece longer than b, unless a holds both
    for p in fits:
        second = next((q for q in fits if q <= min(p, room - p) and (q != p or others[q] > 1)), 0)
        if second > b and p + second > a:
            return None
    return (j, a, b)


def reduce(plan: Plan) -> None:
    """Fix dominating sets until there are no more."""
    found = True
    while found:
        found = False
        for j in sorted(plan.left, reverse=True):
            while j in plan.left and (fixed := dominant(plan.left, j, plan.capacity)):
                plan.fix(fixed)
                found = True


def best_fit(plan: Plan) -> None:
    """Longest first, each piece into the fullest sequence that takes it. Like
    sequences lie in groups (first sequence, number) by the room they have."""
    open_at: dict[int, list[tuple[int, int]]] = {}
    for length in sorted(plan.left, reverse=True):
        while n := plan.left.get(length, 0):
            room = min((r for r in open_at if r >= length), default=None)
            if room is None:
                room, each = plan.capacity, plan.capacity // length
                groups = [(plan.sequences, -(-n // each))]
                plan.sequences += groups[0][1]
            else:
                groups = open_at.pop(room)
            base, size = groups.pop()
            take = min(size, n)
            if take < size:
                groups.append((base + take, size - take))
            if groups:
                open_at.setdefault(room, []).extend(groups)
            plan.place(length, take, base, plan.capacity - room)
            if room > length:
                open_at.setdefault(room - length, []).append((base, take))


def placements(counts: Mapping[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Rows (length, first rank, number, first sequence, offset), sorted, and
    the number of sequences."""
    plan = Plan(counts, capacity)
    reduce(plan)
    best_fit(plan)
    return np.array(sorted(plan.rows), "<i8").reshape(-1, 5), plan.sequences


def ranked(rows: DataFrame, id_col: str) -> DataFrame:
    """``rows`` of pieces with ``_rank``, the place among those of its length."""
    spark = rows.sparkSession
    buckets = rows.count() // PER_BUCKET + int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(col(id_col), "piece"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (rows.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
              .select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")))
    own = Window.partitionBy("length", "_bucket").orderBy(col(id_col), "piece", "start", "ids_crc32")
    return (rows.withColumn("_place", F.row_number().over(own)).join(starts, ["length", "_bucket"])
            .withColumn("_rank", (F.col("_first") + F.col("_place") - 1).cast("long")))


def packed(docs: DataFrame, path: str, pattern: str, end_id: int = END_ID, capacity: int = CAPACITY,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece with its sequence and the offset there."""
    spark = docs.sparkSession
    stored = scratch_path(spark, "pieces")
    pieces(docs, path, pattern, end_id, capacity, id_col, text_col).write.parquet(stored)
    rows = spark.read.parquet(stored)
    counts = {r["length"]: r["n"] for r in  # a row per length, at most ``capacity``
              rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan, _ = placements(counts, capacity)
    out = [id_col, "piece", "start", "length", "ids_crc32"]
    schema = T.StructType([*(rows.schema[c] for c in out), T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])
    most = max(counts.values(), default=0) + 1
    starts = plan[:, 0] * most + plan[:, 1]

    def run(batches):
        for batch in batches:
            length, rank = (batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 5))
            at = plan[np.searchsorted(starts, length * most + rank, side="right") - 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(at[:, 3] + rank - at[:, 1]), pa.array(at[:, 4])], schema.names)

    return ranked(rows, id_col).select(*map(col, out), "_rank").mapInArrow(run, schema)
