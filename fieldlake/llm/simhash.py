"""SimHash near-dedup by tiled exact comparison.

Fingerprints are cut into tiles: those whose four 16-bit quarters have the
same population counts, in parts of at most ``TILE``. Two fingerprints within
the radius cannot differ in these four counts by more than the radius in sum,
so only tiles that near each other are compared, each pair of tiles whole,
with numpy exclusive-or and bit counts. No pair within the radius is lost.

Sizes: equal fingerprints are one entry, so copies cost nothing. A tile meets
its at most 129 neighbours by an equi-join on the counts. A tile pair sends
on a spanning forest of its links, never all of them, so a dense group of n
fingerprints gives at most 2n links a tile pair. Components are found by
alternating star contractions over tables, with the lineage cut each round;
rows meet their component in a join whose skewed partitions Spark splits.

Defined cases: a null text is an empty one; a text without words has
fingerprint zero; fewer words than a shingle are one shingle; repeated rows
are equal documents; a null id is never a component's name unless no other
row of it has an id; an empty table gives an empty table; further columns
pass through ``deduplicated`` unchanged, whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from fieldlake.llm.common import col, columns_of, fresh, pinned, slices

SHINGLE, RADIUS, SEED = 3, 3, 42
TILE = 4096
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+").findall
_MOST = 1 << 15  # hashes whose bits are counted at a time


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes."""
    from xxhash import xxh64_intdigest as xxh

    words = _WORDS(text)
    if not words:
        return 0
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxh(line, SEED)]
    else:
        starts = [0, *ends[:-shingle]]
        hashes = [xxh(line[a:b - 1], SEED) for a, b in zip(starts, ends[shingle - 1:], strict=True)]
    h = np.array(hashes, dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), _MOST):
        bits = np.unpackbits(h[i:i + _MOST].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    on = np.flatnonzero(2 * counts > len(h))
    return int(sum(1 << int(b) for b in on))


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(id, row, own): each row's id, the hash of its text (null: empty),
    which tells rows of one id apart, and its fingerprint."""
    text = F.coalesce(col(text_col), F.lit(""))
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("row", T.LongType()),
                           T.StructField("own", T.LongType())])

    def run(batches):
        for batch in batches:
            for part in slices(batch, 2):
                low = pc.ascii_lower(pc.cast(part.column(2), pa.string()))
                fps = [signed(fingerprint(x.as_py().encode(), shingle)) for x in low]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(fps, pa.int64())],
                                                 ["id", "row", "own"])

    return docs.select(col(id_col), F.xxhash64(text), text).mapInArrow(run, schema)


def _quarters(fp):
    return [F.bit_count(F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF))).cast("int") for i in range(4)]


def _offsets(radius: int) -> list[tuple[int, ...]]:
    """Count differences within the radius, one of each opposite two."""
    r = range(-radius, radius + 1)
    all_of = [(a, b, c, d) for a in r for b in r for c in r for d in r if abs(a) + abs(b) + abs(c) + abs(d) <= radius]
    return [o for o in all_of if o >= (0, 0, 0, 0)]


def forest(a: np.ndarray, b: np.ndarray, same: bool, radius: int) -> list[tuple[int, int]]:
    """Links that join what the links within the radius between a and b join.
    Each fingerprint has a label; one with near others links to one of every
    label among them that is not its own, and these labels become one."""
    both = a if same else np.concatenate([a, b])
    shift = 0 if same else len(a)
    label = np.arange(len(both))
    out: list[tuple[int, int]] = []
    for i in range(0, len(a), 256):
        part = a[i:i + 256]
        near = np.bitwise_count(part[:, None] ^ b[None, :]) <= radius
        if same:
            near &= np.arange(len(b))[None, :] > (np.arange(i, i + len(part)))[:, None]
        for k in np.flatnonzero(near.any(axis=1)).tolist():
            others = shift + np.flatnonzero(near[k])
            kinds, first = np.unique(label[others], return_index=True)
            new = kinds != label[i + k]
            if new.any():
                out += [(int(both[i + k]), int(both[y])) for y in others[first[new]]]
                joined = np.append(kinds[new], label[i + k])
                label[np.isin(label, joined)] = joined.min()
    return out


def links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(u, v): links between different fingerprints of column ``fp`` that
    join exactly what all links within the radius join."""
    cell = F.array(*_quarters(F.col("fp")))
    cells = fps.select("fp", cell.alias("cell"))
    counts = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    part = F.pmod(F.xxhash64("fp"), F.ceil(F.col("n") * 2 / tile))
    tiles = pinned(cells.join(counts, "cell").groupBy("cell", part.alias("part"))
                   .agg(F.collect_list("fp").alias("fps")))
    offset = F.explode(F.array(*[F.array(*[F.lit(x) for x in o]) for o in _offsets(radius)]))
    left = tiles.select(F.col("cell").alias("c"), F.col("part").alias("p"), F.col("fps").alias("a"), offset.alias("o"))
    left = left.select("c", "p", "a", "o", F.zip_with("c", "o", lambda x, y: x + y).alias("cell"))
    own = F.forall("o", lambda x: x == 0)
    met = left.join(tiles, "cell").where(~own | (F.col("p") <= F.col("part")))
    pairs = met.select("a", F.col("fps").alias("b"), (own & (F.col("p") == F.col("part"))).alias("same"))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                a, b = (np.asarray(batch.column(k)[i].values.to_numpy(zero_copy_only=False), dtype="<i8").view("<u8")
                        for k in (0, 1))
                found = forest(a, b, batch.column(2)[i].as_py(), radius)
                if found:
                    ends = np.array(found, dtype="<u8").view("<i8")
                    yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["u", "v"])

    return pairs.mapInArrow(run, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of (u, v), by large-star and small-star
    contractions: a round halves the depth of what is left at least."""
    edges = pinned(edges.where("u <> v").distinct())
    while True:
        both = edges.union(edges.select("v", "u"))
        # written out, so that Spark can split the join of a node with many neighbours
        low = pinned(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
                     .select(F.col("u").alias("x"), "m"))
        large = (both.join(low, F.col("u") == F.col("x")).where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        # small-star: each node and its smaller neighbours go to the smallest of them
        down = pinned(large).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = pinned(down.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), "m"))
        small = (down.join(least, F.col("u") == F.col("x")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select(F.col("x"), F.col("m"))).where("u <> v").distinct())
        after = pinned(small)
        changed = after.exceptAll(edges).limit(1).count() + edges.exceptAll(after).limit(1).count()
        edges = after
        if not changed:
            break
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(edges.select("v", "v").distinct())


def classes(rows: DataFrame, id_col: str, fp_col: str, radius: int = RADIUS) -> DataFrame:
    """(fp, root, component_id): the class of each different fingerprint."""
    each = pinned(rows.groupBy(col(fp_col).alias("fp")).agg(F.min(col(id_col)).alias("least")))
    found = components(links(each.select("fp"), radius))
    named = each.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    roots = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return named.join(roots, "root").select("fp", "root", "component_id")


def simhash(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
            radius: int = RADIUS) -> DataFrame:
    """Per document its fingerprint and the smallest id it is linked to."""
    rows = pinned(fingerprints(docs, id_col, text_col, shingle))
    of = classes(rows, "id", "own", radius)
    return rows.join(of, F.col("own") == F.col("fp")).select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("own")), 16, "0").alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                 radius: int = RADIUS) -> DataFrame:
    """``docs`` with the document of the smallest id of each group; where
    several rows have that id, one of them."""
    slim = pinned(fingerprints(docs, id_col, text_col, shingle))
    of = classes(slim, "id", "own", radius)
    best = (slim.join(of, F.col("own") == F.col("fp")).where(F.col("id").eqNullSafe(F.col("component_id")))
            .groupBy("root", "component_id").agg(F.min("row").alias("row")))
    a, b, c = fresh(docs, "keep_id", "keep_row", "keep_root")
    keep = best.select(F.col("component_id").alias(a), F.col("row").alias(b), F.col("root").alias(c))
    own = F.xxhash64(F.coalesce(col(text_col), F.lit("")))
    kept = docs.join(keep, col(id_col).eqNullSafe(F.col(a)) & (own == F.col(b)))
    return _one_each(kept, [a, b, c], columns_of(docs), text_col)


def _one_each(rows: DataFrame, key: list[str], columns: list, text_col: str) -> DataFrame:
    """One row per key; rows that repeat id and text are aggregated to the
    smallest."""
    (packed,) = fresh(rows, "packed")
    names = [c for c in rows.columns if c not in key]
    order = [text_col, *[c for c in names if c != text_col]]
    fields = [F.col(f"`{packed}`.`{c.replace('`', '``')}`").alias(c) for c in names]
    one = rows.groupBy(*key).agg(F.min(F.struct(*[col(c) for c in order])).alias(packed)).select(*fields)
    return one.select(*columns)
