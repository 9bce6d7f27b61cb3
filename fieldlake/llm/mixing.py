"""Mix sources to target weights with hash-threshold histograms.

Each document has a hash. Tokens are summed by source and hash bucket; the
bucket in which a source's budget is reached is found by a running sum over
its at most 4,096 buckets, and only that bucket is summed again by the next
bits, until it is one hash value. A document is taken when its hash is below
its source's threshold: a filter, nothing is sorted. Budgets nest: a source
whose target exceeds its size is taken whole once, and again as far as the
rest of the target goes, so the second pass is a subset of the first.

Sizes: the text is read once for its word count and once by the consumer;
the histograms see rows of (source, hash, size). A hot source is 4,096 sums
per map task. Targets need two sums over the table of sources per round of
resharing; sources are ranked in ranges, so no task holds all of them.

Defined cases: a null text has no words; null is a source of its own, the
last one; documents without words are taken with their hash but count
nothing; rows with one id share one hash and are taken together; a null id
has a hash like any other; an empty table gives an empty table; further
columns pass through ``mixed`` unchanged, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldlake.llm.common import WORD, col, columns_of, fresh, pinned

STEP, LEVELS = 12, 5  # bits by level: a 60-bit hash
WEIGHTS = (5, 2, 1)


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def id_hash(key: Column) -> Column:
    """The first 60 bits of the id's MD5."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def ranked_sources(sized: DataFrame) -> DataFrame:
    """(src, total, rank): rank from 0 in code point order, null last."""
    spark = sized.sparkSession
    parts = max(1, min(200, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    totals = sized.groupBy("src").agg(F.sum("size").alias("total"))
    ranges = pinned(totals.repartitionByRange(parts, F.col("src").asc_nulls_last())
                    .withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (ranges.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # a row per range
              .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    within = Window.partitionBy("part").orderBy(F.col("src").asc_nulls_last())
    return ranges.join(starts, "part").select(
        "src", "total", (F.col("start") + F.row_number().over(within) - 1).alias("rank"))


def targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = (3, 2),
            cap: int = 2) -> DataFrame:
    """(src, total, target): the sources share ``share`` (a fraction) of all
    sizes by weight; a target stops at ``cap`` times its source's size and the
    excess is reshared until none is above."""
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          (F.col("rank") % len(weights) + 1).cast("int")).cast("long")
    sources = pinned(ranked_sources(sized).select("src", "total", weight.alias("w")))
    top, bottom = share
    sums = sources.agg(F.sum("total"), F.sum("w")).first()
    num, den, full = (sums[0] or 0) * top, (sums[1] or 0) * bottom, None
    all_num, all_den = num, den
    while den > 0:
        share_of = F.col("w") * F.lit(float(num)) / F.lit(float(den))
        full = F.col("total") * cap < share_of
        kept = sources.where(full).agg(F.sum("total"), F.sum("w")).first()
        nxt = all_num - bottom * cap * (kept[0] or 0), all_den - bottom * (kept[1] or 0)
        if nxt == (num, den):
            break
        num, den = nxt
    limit = (F.col("total") * cap).cast("double")
    if den <= 0:  # no sources, or all of them are full
        return sources.select("src", "total", limit.alias("target"))
    return sources.select("src", "total", F.when(full, limit).otherwise(share_of).alias("target"))


def thresholds(sized: DataFrame, goals: DataFrame) -> DataFrame:
    """(src, total, target, whole, cut): a document is taken ``whole`` times,
    and once more when its hash is below ``cut``."""
    whole = (F.when(F.col("total") <= 0, 0).when(F.col("target") >= 2 * F.col("total"), 2)
             .when(F.col("target") >= F.col("total"), 1).otherwise(0))
    goals = goals.withColumn("whole", whole)
    state = goals.select("src", F.lit(0).cast("long").alias("prefix"),
                         (F.col("target") - F.col("whole") * F.col("total")).alias("need"))
    for level in range(LEVELS):
        shift = STEP * (LEVELS - 1 - level)
        s = state.select(F.col("src").alias("s"), F.col("prefix").alias("p"), "need")
        inside = F.shiftright("hash", shift + STEP) == F.col("p")
        hist = (sized.join(s, F.col("src").eqNullSafe(F.col("s")) & inside)
                .groupBy("src", "need", F.shiftright("hash", shift).alias("bucket"))
                .agg(F.sum("size").alias("size")))
        order = Window.partitionBy("src").orderBy("bucket")
        hist = hist.withColumn("sum", F.sum("size").over(order))
        reached = hist.where(F.col("sum") >= F.col("need"))
        state = (reached.groupBy("src").agg(F.min(F.struct("bucket", "sum", "size", "need")).alias("b"))
                 .select("src", F.col("b.bucket").alias("prefix"), F.col("b.size").alias("size"),
                         (F.col("b.need") - F.col("b.sum") + F.col("b.size")).alias("need")))
    nearer = (F.col("need") > 0) & (F.col("size") - F.col("need") <= F.col("need"))
    cuts = state.select(F.col("src").alias("s"),
                        (F.col("prefix") + F.when(nearer, 1).otherwise(0)).alias("cut"))
    return (goals.join(cuts, F.col("src").eqNullSafe(F.col("s")), "left")
            .select("src", "total", "target", "whole", F.coalesce("cut", F.lit(0).cast("long")).alias("cut")))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: Sequence[int] = WEIGHTS) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with what the mix does to each row, and the names of the new
    columns: size, source_size, target, copies, taken."""
    facts = [F.coalesce(col(source_col).cast("string"), F.lit(None)).alias("src"),
             id_hash(col(id_col)).alias("hash"), words_in(col(text_col)).alias("size")]
    sized = pinned(docs.select(*facts))
    cuts = pinned(thresholds(sized, targets(sized, weights)))
    size, source_size, target, copies, taken, h, s, whole, cut = fresh(
        docs, "size", "source_size", "target", "copies", "taken", "hash", "src", "whole", "cut")
    cuts = cuts.select(F.col("src").alias(s), F.col("total").alias(source_size),
                       F.col("target").alias(target), F.col("whole").alias(whole), F.col("cut").alias(cut))
    rows = docs.withColumns({h: id_hash(col(id_col)), size: words_in(col(text_col))})
    rows = rows.join(cuts, col(source_col).cast("string").eqNullSafe(F.col(s)))
    n = F.col(whole) + F.when(F.col(h) < F.col(cut), 1).otherwise(0)
    rows = rows.withColumn(copies, n).withColumn(taken, (F.col(copies) * F.col(size)).cast("long"))
    names = {"size": size, "source_size": source_size, "target": target, "copies": copies, "taken": taken}
    return rows.select(*columns_of(docs), *names.values()), names


def apply_mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed table itself: each row as often as the mix takes it, with the
    columns of ``docs``."""
    rows, names = mixed(docs, **options)
    times = F.col(names["copies"]).cast("int")
    (one,) = fresh(rows, "one")
    return (rows.where(times > 0).withColumn(one, F.explode(F.array_repeat(F.lit(1), times)))
            .select(*columns_of(docs)))


ORACLE = """
WITH d AS (
  SELECT doc_id, source, ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS h,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS total,
             CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS BIGINT) AS w
      FROM d GROUP BY source),
o AS (SELECT *, row_number() OVER (ORDER BY 2.0 * total / w, source) AS k FROM s),
f AS (SELECT k,
        CAST(3 * sum(total) OVER () - 4 * (sum(total) OVER (ORDER BY k) - total) AS DOUBLE) AS num,
        CAST(2 * (sum(w) OVER () - sum(w) OVER (ORDER BY k) + w) AS DOUBLE) AS den,
        total, w FROM o),
l AS (SELECT num, den FROM f WHERE 2 * total >= w * num / den ORDER BY k LIMIT 1),
t AS (SELECT s.source, s.total, CASE WHEN 2 * s.total < s.w * l.num / l.den THEN CAST(2 * s.total AS DOUBLE)
             ELSE s.w * l.num / l.den END AS target FROM s, l),
g AS (SELECT *, CASE WHEN total <= 0 THEN 0 WHEN target >= 2 * total THEN 2 WHEN target >= total THEN 1
             ELSE 0 END AS whole FROM t),
c AS (SELECT d.*, g.total, g.target, g.whole, g.target - g.whole * g.total AS need,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h RANGE UNBOUNDED PRECEDING) AS upto,
             sum(d.size) OVER (PARTITION BY d.source, d.h) AS here
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, total AS source_size, target,
       CAST(size * (whole + CASE WHEN upto < need THEN 1
         WHEN upto - here >= need THEN 0
         WHEN upto - need <= need - (upto - here) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM c
"""
