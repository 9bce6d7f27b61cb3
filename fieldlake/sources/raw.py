"""Raw landing reader (S1): every field as a string, nothing inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fieldlake.sources import sinks
from fieldlake.sources.schemas import raw_schema

CORRUPT = "_corrupt_record"
REPORT = "entity string, what string, field string, lines bigint"


def _with_corrupt(schema: StructType) -> StructType:
    return StructType(schema.fields + [StructField(CORRUPT, StringType())])


def read_raw(spark: SparkSession, entity: str, path: str, fmt: str = "json",
             keep_corrupt: bool = False) -> DataFrame:
    """Read one entity's landed records with its all-string schema.

    JSON is read PERMISSIVE: a malformed line becomes a row with only
    ``_corrupt_record`` set (kept when ``keep_corrupt``), never a failed job;
    ``land`` sets such lines aside. A JSON array or number in a string field
    arrives as its text (``[3,4]``).
    """
    schema = raw_schema(entity)
    if fmt == "json":
        df = (spark.read.schema(_with_corrupt(schema)).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT).json(path))
        return df if keep_corrupt else df.drop(CORRUPT)
    return spark.read.schema(schema).format(fmt).load(path)


def parsed_lines(spark: SparkSession, entity: str, path: str) -> DataFrame:
    """Each line that is not blank: ``value``, its record ``r``, whether it is
    ``broken`` (no JSON object), and its undeclared fields ``unknown``."""
    schema = raw_schema(entity)
    parse = F.from_json("value", _with_corrupt(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rows = spark.read.text(path).filter(F.btrim("value") != "").withColumn("r", parse)
    broken = F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull() | ~F.ltrim("value").startswith("{")
    declared = F.array(*[F.lit(n) for n in schema.names])
    rows = rows.withColumn("broken", broken)
    unknown = F.when(~F.col("broken"), F.array_except(F.json_object_keys("value"), declared))
    return rows.withColumn("unknown", unknown)


def land(spark: SparkSession, entity: str, path: str, root: str) -> DataFrame:
    """Take one entity's JSON lines into the tables ``root/records`` and
    ``root/quarantine`` (the lines that are no records, as they came).

    The lines are parsed once, into a staging folder that holds a line's text
    or its record, not both; the counts are observed on the way. Returns (entity, what, field, lines): the records, the
    quarantined lines, and the records with each undeclared field.
    """
    from fieldlake.session import scratch_path
    seen = Observation("landing")
    staged = scratch_path(spark, f"landing-{entity}")
    counts = [F.count_if(~F.col("broken")).alias("records"), F.count_if(F.col("broken")).alias("quarantined")]
    either = [F.when(F.col("broken"), F.col("value")).alias("value"), F.when(~F.col("broken"), F.col("r")).alias("r")]
    lines = parsed_lines(spark, entity, path).observe(seen, *counts).select(*either, "broken", "unknown")
    lines.write.option("compression", "zstd").parquet(staged)
    rows = spark.read.parquet(staged)
    sinks.append(rows.filter("NOT broken").select(*[F.col(f"r.{n}").alias(n) for n in raw_schema(entity).names]),
                 f"{root}/records")
    sinks.append(rows.filter("broken").select("value"), f"{root}/quarantine")
    total = spark.createDataFrame([(entity, w, None, seen.get[w]) for w in ("records", "quarantined")], REPORT)
    unknown = (rows.select(F.explode("unknown").alias("field")).groupBy("field").agg(F.count(F.lit(1)).alias("lines"))
               .select(F.lit(entity).alias("entity"), F.lit("unknown field").alias("what"), "field", "lines"))
    return total.unionByName(unknown)
