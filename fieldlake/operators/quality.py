"""Data-quality operators over raw landings: orphan share, expected counts,
a sample record, and a profile of values the safe parsers rejected."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlake.functions.exact import div_half_up, from_units
from fieldlake.functions.parse import not_blank, strip, to_date, to_float, to_int, to_timestamp


def _orphan(raw: DataFrame) -> Column:
    return ~((F.coalesce(F.col("officeID"), F.lit("-1")) != "-1")
             & (F.coalesce(F.col("customerID"), F.lit("-1")) != "-1"))


def orphan_rate(raw: DataFrame, id_col: str = "subscriptionID", sample_modulus: int | None = None) -> DataFrame:
    """Share of orphan records (office or customer missing / -1) and the real
    count. Exact by default; with ``sample_modulus`` k only ids whose hash (the
    first 32 bits of the md5) is 0 mod k are inspected and the real count is
    estimated from that share."""
    head = F.conv(F.substring(F.md5(F.col(id_col)), 1, 8), 16, 10).cast("long")
    picked = (F.pmod(head, F.lit(sample_modulus)) == 0
              if sample_modulus and sample_modulus > 1 else F.lit(True))
    g = raw.agg(F.count(F.lit(1)).alias("total"), F.count_if(picked).alias("inspected"),
                F.count_if(picked & _orphan(raw)).alias("orphans"))
    pct = F.when(F.col("inspected") > 0, from_units(div_half_up(F.col("orphans") * 10000, F.col("inspected"))))
    est = F.when(F.col("inspected") > 0,
                 div_half_up(F.col("total") * (F.col("inspected") - F.col("orphans")), F.col("inspected")))
    return g.select("total", "inspected", "orphans", pct.alias("orphan_pct"), est.alias("est_real"))


def count_check(raw: DataFrame, expected: DataFrame, ratio: float = 0.9,
                office_col: str = "officeID") -> DataFrame:
    """Records per office against an expected count: 'ok' at or above
    ``ratio`` of it, else 'warning'. ``expected`` has (office_id, expected)."""
    counts = (raw.select(to_int(F.col(office_col)).alias("office_id"))
              .groupBy("office_id").agg(F.count(F.lit(1)).alias("count")))
    j = expected.join(counts, ["office_id"], "left").withColumn("count", F.coalesce("count", F.lit(0)))
    # count >= ratio * expected, compared in integers (ratio in hundredths)
    r = int(round(ratio * 100))
    ok = F.col("count") * 100 >= F.col("expected") * r
    return j.select("office_id", "expected", "count",
                    F.when(ok, F.lit("ok")).otherwise(F.lit("warning")).alias("status"))


def expectations(spark: SparkSession, expected: Mapping[int, int]) -> DataFrame:
    """Parameter table (office_id, expected) from a mapping."""
    return spark.createDataFrame([(int(k), int(v)) for k, v in expected.items()],
                                 "office_id long, expected long")


def sample_subscription(raw: DataFrame) -> DataFrame:
    """One real subscription with a positive recurring charge — the lowest
    id — for a human spot check. (A top-1, computed per partition first.)"""
    real = raw.filter(~_orphan(raw))
    charge = to_float(F.col("recurringCharge"), 0)
    s = real.filter(charge > 0).select(
        to_int(F.col("subscriptionID")).alias("subscription_id"),
        strip(F.col("serviceType")).alias("service_type"),
        F.format_string("%.2f", charge).alias("recurring_charge"),
        F.col("nextService").alias("next_service"))
    return s.orderBy(F.col("subscription_id").asc_nulls_last()).limit(1)


# Raw fields checked by the reject profile, with the parser that reads them.
REJECT_RULES: dict[str, tuple[tuple[str, str], ...]] = {
    "serviceType": (("typeID", "int"), ("officeID", "int"), ("frequency", "int"), ("billingFrequency", "int"),
                    ("defaultCharge", "float")),
    "employee": (("employeeID", "int"), ("officeID", "int"), ("type", "int")),
    "product": (("productID", "int"), ("officeID", "int"), ("amount", "float")),
    "customer": (("customerID", "int"), ("officeID", "int"), ("billToAccountID", "int"),
                 ("dateAdded", "date"), ("dateCancelled", "date")),
    "subscription": (("subscriptionID", "int"), ("customerID", "int"), ("officeID", "int"),
                     ("serviceID", "int"), ("recurringCharge", "float"), ("initialCharge", "float"),
                     ("frequency", "frequency"), ("nextService", "date"), ("lastService", "date"),
                     ("dateAdded", "date"), ("dateCancelled", "date")),
    "appointment": (*[(x, "int") for x in (
                        "appointmentID", "customerID", "subscriptionID", "ticketID", "officeID", "routeID", "sequence",
                        "assignedTech", "servicedBy", "type", "duration", "status", "reserviceReasonID")],
                    ("date", "date"),
                    *[(x, "ts") for x in ("dateCompleted", "timeIn", "timeOut", "dateAdded", "dateUpdated")],
                    *[(x, "float") for x in ("productionValue", "amountCollected", "latIn", "longIn", "temperature",
                                             "windSpeed")]),
    "ticket": (*[(x, "int") for x in ("ticketID", "appointmentID", "customerID", "subscriptionID", "officeID",
                                      "serviceID")],
               ("invoiceDate", "date"), ("dateCreated", "ts"), ("dateUpdated", "ts"),
               *[(x, "float") for x in ("subTotal", "taxAmount", "total", "balance", "productionValue")]),
    "route": (("routeID", "int"), ("officeID", "int"), ("date", "date"), ("assignedTech", "int")),
    "ticketItem": (("itemID", "int"), ("quantity", "float"), ("amount", "float"), ("productID", "int"),
                   ("serviceID", "int")),
}


def _rejected(x: Column, kind: str) -> Column:
    placeholder = strip(x).startswith("0000")
    if kind == "int":
        bad = to_int(x).isNull()
    elif kind == "float":
        bad = to_float(x).isNull()
    elif kind == "frequency":
        bad = to_int(x).isNull() & (F.upper(strip(x)) != "CUSTOM")
    elif kind == "date":
        bad = to_date(x).isNull() & ~placeholder
    else:
        bad = to_timestamp(x).isNull() & ~placeholder
    return not_blank(x) & bad


def conform_rejects(raw: DataFrame, entity: str) -> DataFrame:
    """Per raw field: how many non-blank values the safe parser replaced by a
    default or NULL (the source load is silent about them). ``ticketItem``
    profiles the items inside raw tickets."""
    if entity == "ticketItem":
        raw = raw.select(F.explode("items").alias("it")).select("it.*")
    rules = REJECT_RULES[entity]
    g = raw.agg(*[F.count_if(_rejected(F.col(f), k)).alias(f) for f, k in rules])
    return g.unpivot([], [f for f, _ in rules], "field", "rejects")


def rejected_fields(entity: str) -> Column:
    """The names of the fields of one raw record that ``conform_rejects`` would
    count, for a job that writes the conformed record and counts later. Of a
    raw ticket, ``ticketItem`` gives a name for each item that has it."""
    def names(value) -> Column:
        found = [F.when(_rejected(value(f), k), F.lit(f)) for f, k in REJECT_RULES[entity]]
        return F.filter(F.array(*found), lambda n: n.isNotNull())

    if entity != "ticketItem":
        return names(F.col)
    items = F.filter("items", lambda it: it.isNotNull())
    return F.coalesce(F.flatten(F.transform(items, lambda it: names(lambda f: it[f]))), F.array().cast("array<string>"))


def reject_counts(entity: str, names: Column) -> list[Column]:
    """An aggregate per field, in the order of REJECT_RULES, over ``names``."""
    def of(field: str) -> Column:
        return F.coalesce(F.sum(F.size(F.filter(names, lambda n: n == field))), F.lit(0)).cast("long")

    return [of(f) for f, _ in REJECT_RULES[entity]]
