"""Align the tokens of two tokenizers over the bytes of the same texts.

Every whole text is tokenised by both, with a space before it. Places where a
token of A and one of B both end, and the next tokens of both begin with a
space, are anchors: they split the document into windows, each known by the
ids of its tokens. A window is aligned once per slice: its shared ends cut it
into groups, and tokens whose byte ranges overlap are linked. Documents whose
token bytes are not their text have no tokens.

A slice is some megabytes of whole texts. It is stored as one row: its
documents with their windows (numbers of the slice's distinct ones, and how
often), and the id pairs linked in it with their counts. Counts over the
corpus are a grouped sum of those pairs, combined before the shuffle; the
best count of each B id is a maximum over them. They come back to the slices
that hold the pair, so what is shuffled are the distinct pairs of each slice,
not the links of each document, and no key has more rows than there are
slices.

Defined cases: null and empty texts have no tokens: zeros, and an empty
digest; a very long text is a slice of its own; repeated rows each count;
an empty table gives an empty table; further columns are not read, whatever
their names.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from fieldlake.llm import subwords
from fieldlake.llm.common import col
from fieldlake.session import scratch_path

SLICE_BYTES = 1 << 20  # of text: less than the others take, as many arrays are held at once
COUNTS = ("n_a", "n_b", "n_groups", "n_links")
SCORES = ("n_best", "count_sum")


def _same_bytes(coder, ids: np.ndarray, counts: np.ndarray, words: list[bytes]) -> np.ndarray:
    """Whether the bytes of each word's tokens are the word."""
    data, n = subwords.table_of(words)
    token_ends = np.append(0, np.cumsum(coder.sizes[ids]))
    stops = np.cumsum(counts)
    got = token_ends[stops] - token_ends[stops - counts]
    same = got == n
    mine, _ = subwords.spread(coder.flat, coder.sizes, subwords.spread(ids, counts, np.flatnonzero(same))[0])
    theirs, _ = subwords.spread(data, n, np.flatnonzero(same))
    owner = np.repeat(np.flatnonzero(same), n[same])
    same[owner[mine != theirs]] = False
    return same


class Side:
    """The tokens of a slice's documents by one tokenizer."""

    def __init__(self, coder, units: subwords.Units):
        ids, counts = coder.words(units.words)
        same = _same_bytes(coder, ids, counts, units.words)
        self.ids, per_unit = subwords.spread(ids, counts, units.codes)
        self.bounds = np.append(0, np.cumsum(per_unit))[units.bounds]  # of documents
        wrong = np.append(0, np.cumsum(~same[units.codes]))[units.bounds]
        self.whole = np.diff(wrong) == 0  # documents whose token bytes are their text
        self.sizes = coder.sizes[self.ids]
        first = coder.flat[np.minimum(np.cumsum(coder.sizes) - coder.sizes, len(coder.flat) - 1)]
        self.spaced = ((first == 0x20) & (coder.sizes > 0))[self.ids]

    def keep(self, docs: np.ndarray) -> None:
        """Only the tokens of these documents (a mask); their places follow."""
        n = np.diff(self.bounds)
        tokens = np.repeat(docs, n)
        self.ids, self.sizes, self.spaced = (x[tokens] for x in (self.ids, self.sizes, self.spaced))
        self.bounds = np.append(0, np.cumsum(np.where(docs, n, 0)))
        self.ends = np.cumsum(self.sizes)


def anchors(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """First tokens (of A, of B) of the windows of all documents, by places
    in the slice where both tokenizers end a token and go on with a space.
    The bytes before a document are the same on both sides, so documents are
    told apart by their places, and each begins with a space."""
    starts_a, starts_b = a.ends - a.sizes, b.ends - b.sizes
    at_a, at_b = np.flatnonzero(a.spaced), np.flatnonzero(b.spaced)
    _, i, j = np.intersect1d(starts_a[at_a], starts_b[at_b], assume_unique=True, return_indices=True)
    return at_a[i], at_b[j]


def _keys(a: np.ndarray, b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray) -> pa.Array:
    """The windows by number, with equal ids of A and of B as equal numbers."""
    n_a, n_b = np.diff(np.append(first_a, len(a))), np.diff(np.append(first_b, len(b)))
    n = n_a + n_b + 1  # the number of A ids parts the two lists
    stops = np.cumsum(n)
    out = np.empty(int(n.sum()), "<i4")
    lead = stops - n
    out[lead] = n_a
    out[np.arange(len(a)) + np.repeat(lead + 1 - first_a, n_a)] = a
    out[np.arange(len(b)) + np.repeat(lead + 1 + n_a - first_b, n_b)] = b
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(n), [None, pa.py_buffer(np.append(0, stops * 4).astype("<i8")), pa.py_buffer(out)]
    ).dictionary_encode()


class Windows:
    """The distinct windows of a slice, aligned."""

    def __init__(self, a: Side, b: Side, first_a: np.ndarray, first_b: np.ndarray):
        keys = _keys(a.ids, b.ids, first_a, first_b)
        self.codes = keys.indices.to_numpy()
        n = len(keys.dictionary)
        ends = np.frombuffer(keys.dictionary.buffers()[1], "<i8")[:n + 1] // 4 if n else np.zeros(1, "<i8")
        ids = np.frombuffer(keys.dictionary.buffers()[2], "<i4")[:ends[-1]] if n else np.zeros(0, "<i4")
        self.n_a = ids[ends[:-1]].astype("<i8")
        size = np.diff(ends)
        self.n_b = size - 1 - self.n_a
        place = np.arange(len(ids)) - np.repeat(ends[:-1], size)
        of_a = place <= np.repeat(self.n_a, size)
        self.a, self.b = ids[of_a & (place > 0)], ids[~of_a]

    def align(self, sizes_a: np.ndarray, sizes_b: np.ndarray) -> None:
        """Groups and links, of all windows at once: the bytes of the windows
        are laid end to end, so a window's last end is shared too."""
        ends_a, ends_b = np.cumsum(sizes_a[self.a]), np.cumsum(sizes_b[self.b])
        starts_a, starts_b = ends_a - sizes_a[self.a], ends_b - sizes_b[self.b]
        self.shared_a = np.isin(ends_a, ends_b)
        self.shared_b = np.isin(ends_b, ends_a)
        low, high = np.searchsorted(ends_b, starts_a, "right"), np.searchsorted(starts_b, ends_a, "left")
        n = high - low
        total = int(n.sum())
        other = np.arange(total) + np.repeat(low - (np.cumsum(n) - n), n)
        self.link_a, self.link_b = np.repeat(self.a, n), self.b[other]
        self.token_window = np.repeat(np.arange(len(self.n_a)), self.n_a)
        self.link_window = np.repeat(self.token_window, n)
        self.n_links = np.bincount(self.link_window, minlength=len(self.n_a))
        self.n_groups = np.bincount(self.token_window, weights=self.shared_a, minlength=len(self.n_a)).astype("<i8")

    def texts(self) -> list[bytes]:
        """Each window's groups as ``a1,a2|b1;a3|b2;``, from the decimal texts
        of all ids laid in order, each followed by its sign."""
        group_a = np.cumsum(self.shared_a) - self.shared_a  # of each token
        group_b = np.cumsum(self.shared_b) - self.shared_b
        until_a = np.flatnonzero(self.shared_a) + 1  # A tokens up to the end of each group
        from_b = np.append(0, np.flatnonzero(self.shared_b) + 1)
        n_a, n_b = len(self.a), len(self.b)
        at_a, at_b = np.arange(n_a) + from_b[group_a], np.arange(n_b) + until_a[group_b]
        ids, sign = np.empty(n_a + n_b, "<i4"), np.empty(n_a + n_b, "u1")
        ids[at_a], ids[at_b] = self.a, self.b
        sign[at_a] = np.where(self.shared_a, ord("|"), ord(","))
        sign[at_b] = np.where(self.shared_b, ord(";"), ord(","))
        flat, n = _decimals(1 << int(ids.max(initial=0)).bit_length())
        text, sizes = subwords.spread(flat, n, ids)
        ends = np.cumsum(sizes)
        text[ends - 1] = sign
        last = np.cumsum(self.n_a + self.n_b)  # tokens up to the end of each window
        stops, whole = ends[last - 1].tolist() if len(last) else [], text.tobytes()
        return [whole[s:e] for s, e in zip([0, *stops], stops, strict=False)]


@functools.lru_cache(maxsize=2)
def _decimals(n: int) -> tuple[np.ndarray, np.ndarray]:
    return subwords.table_of([b"%d," % i for i in range(n)])


def _counted(values: np.ndarray, rows: np.ndarray, n_rows: int, width: int):
    """For each row its distinct values, ascending, and their counts, end to
    end; and the number of each row's."""
    keys, counts = np.unique(rows * width + values, return_counts=True)
    return keys % width, counts, np.bincount(keys // width, minlength=n_rows)


def _packed(*numbers: np.ndarray) -> list[bytes]:
    """Whole numbers as bytes: their count, then their differences, compressed."""
    return [len(x).to_bytes(8, "little") + pa.compress(np.diff(x, prepend=0).astype("<i4"), "zstd", asbytes=True)
            for x in numbers]


def _unpacked(body: bytes) -> np.ndarray:
    n = int.from_bytes(body[:8], "little")
    return np.cumsum(np.frombuffer(pa.decompress(body[8:], 4 * n, "zstd"), "<i4"), dtype="<i8")


def aligned_slice(table: pa.Table, coder_a, coder_b) -> dict[str, pa.Array]:
    """The columns of one slice's row; see ``_slice_schema``."""
    data, ends = subwords.text_bytes(table.column(1), " ")
    units = subwords.Units(data, ends)
    a, b = Side(coder_a, units), Side(coder_b, units)
    docs = a.whole & b.whole & (np.diff(ends) > 0)
    for side in (a, b):
        side.keep(docs)
    first_a, first_b = anchors(a, b)
    windows = Windows(a, b, first_a, first_b)
    windows.align(coder_a.sizes, coder_b.sizes)
    bounds = np.searchsorted(first_a, a.bounds)  # windows of documents
    texts, codes = windows.texts(), windows.codes.tolist()
    shas = [hashlib.sha256(memoryview(b"".join(map(texts.__getitem__, codes[s:e])))[:-1]).hexdigest() if e > s else ""
            for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    owner = np.repeat(np.arange(len(docs)), np.diff(bounds))
    per_doc = [np.diff(a.bounds), np.diff(b.bounds)] + [
        np.bincount(owner, weights=x[windows.codes], minlength=len(docs)).astype("<i8")
        for x in (windows.n_groups, windows.n_links)]
    width = len(coder_b.sizes)
    pairs, pair_of = np.unique(windows.link_a.astype("<i8") * width + windows.link_b, return_inverse=True)
    uses = np.bincount(windows.codes, minlength=len(windows.n_a))
    pair_n = np.bincount(pair_of, weights=uses[windows.link_window], minlength=len(pairs)).astype("<i8")
    kinds, times, n_kinds = _counted(windows.codes.astype("<i8"), owner, len(docs), max(len(windows.n_a), 1))
    body = _packed(kinds, times, np.cumsum(n_kinds), pair_of, np.cumsum(windows.n_links))
    return {"ids": table.column(0).combine_chunks(), "shas": pa.array(shas, pa.string()),
            **{c: pa.array(x, pa.int64()) for c, x in zip(COUNTS, per_doc, strict=True)},
            "body": pa.array(body, pa.binary()), "a": pa.array(pairs // width, pa.int32()),
            "b": pa.array(pairs % width, pa.int32()), "n": pa.array(pair_n, pa.int64())}


def _slice_schema(kind: T.DataType) -> T.StructType:
    """``body``: the documents' distinct windows, how often each has them, where
    the documents end; the windows' links by pair, and where the windows end."""
    lists = [("ids", kind), ("shas", T.StringType()), *((c, T.LongType()) for c in COUNTS), ("body", T.BinaryType()),
             ("a", T.IntegerType()), ("b", T.IntegerType()), ("n", T.LongType())]
    return T.StructType([T.StructField("slice", T.StringType()),
                         *(T.StructField(c, T.ArrayType(t)) for c, t in lists)])


def slices_of(docs: DataFrame, path_a: str, pattern: str, path_b: str, id_col: str, text_col: str) -> DataFrame:
    """One row per slice of the documents, aligned."""
    schema = _slice_schema(docs.schema[id_col].dataType)

    def run(batches):
        import uuid

        coder_a, coder_b = subwords.byte_level(path_a, pattern, False), subwords.pieces(path_b)
        for table in subwords.gathered(batches, 1, SLICE_BYTES):
            columns = aligned_slice(table, coder_a, coder_b)
            one = [pa.array([uuid.uuid4().hex])]
            one += [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in columns.values()]
            yield pa.RecordBatch.from_arrays(one, ["slice", *columns])

    return docs.select(col(id_col), col(text_col)).mapInArrow(run, schema)


def pair_counts(stored: DataFrame) -> DataFrame:
    """(a, b, count, best): links of each id pair in the corpus, and whether no
    other A id has more with this B id."""
    pairs = (stored.select(F.explode(F.arrays_zip("a", "b", "n")).alias("p"))
             .groupBy("p.a", "p.b").agg(F.sum("p.n").alias("count")))
    top = pairs.groupBy(F.col("b").alias("_b")).agg(F.max("count").alias("top"))
    return pairs.join(top, F.col("b") == F.col("_b")).select("a", "b", "count", (F.col("count") == F.col("top")).alias("best"))


def _scored(batches, id_col: str):
    for batch in batches:
        for row in range(batch.num_rows):
            own = {c: batch.column(c)[row].values for c in batch.schema.names if c not in ("slice", "pairs")}
            size = batch.column("pairs")[row].as_py()
            count, best = np.zeros(size, "<i8"), np.zeros(size, "<i8")
            if own["at"] is not None:
                at = own["at"].to_numpy()
                count[at], best[at] = own["count"].to_numpy(), own["best"].to_numpy()
            kinds, times, ends, links, link_ends = map(_unpacked, own["body"].to_pylist())
            sums = []
            for value in (best, count):
                per_window = np.diff(np.append(0, np.cumsum(value[links]))[np.append(0, link_ends)])
                sums.append(np.diff(np.append(0, np.cumsum(per_window[kinds] * times))[np.append(0, ends)]))
            yield pa.RecordBatch.from_arrays(
                [own["ids"], *(own[c] for c in COUNTS), *(pa.array(x, pa.int64()) for x in sums), own["shas"]],
                [id_col, *COUNTS, *SCORES, "groups_sha256"])


def aligned(docs: DataFrame, path_a: str, pattern: str, path_b: str, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """Per document: tokens, groups and links, links that are the best of
    their B id, the sum of the links' counts, and the digest of its groups."""
    spark = docs.sparkSession
    path = scratch_path(spark, "aligned")
    slices_of(docs, path_a, pattern, path_b, id_col, text_col).write.parquet(path)
    stored = spark.read.parquet(path)
    held = stored.select("slice", F.posexplode(F.arrays_zip("a", "b")).alias("at", "p")).select(
        "slice", "at", F.col("p.a").alias("a"), F.col("p.b").alias("b"))
    scores = held.join(pair_counts(stored), ["a", "b"]).groupBy("slice").agg(
        F.collect_list(F.struct("at", "count", F.col("best").cast("int").alias("best"))).alias("s"))
    rows = (stored.withColumn("pairs", F.size("a")).drop("a", "b", "n").join(scores, "slice", "left")
            .select("slice", "ids", "shas", *COUNTS, "body", "pairs", *[F.col(f"s.{c}").alias(c) for c in ("at", "count", "best")]))
    longs = [T.StructField(c, T.LongType()) for c in (*COUNTS, *SCORES)]
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *longs,
                           T.StructField("groups_sha256", T.StringType())])
    return rows.mapInArrow(lambda batches: _scored(batches, id_col), schema)
