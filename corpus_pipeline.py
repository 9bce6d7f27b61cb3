"""From documents to token ids: toxic documents go, repeated line chunks are
removed, one document of each near-duplicate group stays, sources are mixed to
their target weights, and the texts are encoded.

Each stage takes (spark, docs, sf_dir) and returns a table that is written
and read again as the next stage's ``docs``; all but the last keep the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldlake.llm import bpe, line_chunks, mixing, registry, simhash, toxic_gru
from fieldlake.llm.common import col, documents, prepared
from fieldlake.session import scratch_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more go; a text without words is clean."""
    prepared(spark)
    return toxic_gru.clean(docs, registry.toxic_network(spark, sf_dir))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the runs of lines that stand elsewhere already; n_chars is
    counted anew where there is one."""
    prepared(spark)
    rows, _ = line_chunks.deduplicated(docs)
    kinds = dict(docs.dtypes)
    n = F.char_length("text").cast(kinds["n_chars"]) if "n_chars" in kinds else None
    return rows.select(*[n.alias(c) if c == "n_chars" else col(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return simhash.deduplicated(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    return mixing.apply_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepared(spark)
    path, pattern = registry.bpe_files()
    return bpe.encoded(docs, path, pattern)


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mix", mix), ("encode", encode)]

#: The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
