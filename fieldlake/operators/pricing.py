"""Price-increase campaign: eligibility, new prices, notices, notes, plan.

The source declares this campaign only as configuration (no code), so the
semantics here are our reading of it: money is computed in integer cents
and rounded half-up; templates use Python-style ``{name}`` and
``{name:.2f}`` placeholders.
"""

from __future__ import annotations

import copy
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlake.functions.codes import customer_display_name
from fieldlake.functions.exact import div_half_up, from_units, units

# Fixed value: the CRM tag that starts the notice there.
PENDING_TAG = "FR_price_increase_pending"

# Default campaign settings. Thresholds, keys and switches are the source
# configuration's; the method's name and the texts are ours.
DEFAULT_CONFIG: dict = {
    "increase": {"type": "percentage", "value": 5},
    "eligibility": {
        "minimum_days_since_last_increase": 365,
        "minimum_recurring_charge": 50.00,
        "service_types_to_include": [],
    },
    "notification": {
        "notify_customer": True,
        "days_before_increase": 30,
        "notification_method": "field_service_messaging",
        "email_subject": "Your new service price",
        "email_body": ("{customer_name}: your price per service changes from ${old_price:.2f} to "
                       "${new_price:.2f} on {effective_date}. {company_name}"),
    },
    "account_notation": {
        "add_note_to_account": True,
        "note_template": "Price ${old_price:.2f} to ${new_price:.2f} on {date}, told {days_before} days before.",
        "add_note_to_next_service": True,
        "service_note_template": "From this service: ${new_price:.2f} (was ${old_price:.2f})",
    },
    "safety": {"dry_run": True, "max_customers_per_run": 50},
}


def config(overrides: Mapping | None = None) -> dict:
    """DEFAULT_CONFIG with section-wise overrides."""
    cfg = copy.deepcopy(DEFAULT_CONFIG)
    for section, values in (overrides or {}).items():
        cfg.setdefault(section, {}).update(values)
    return cfg


def _date(x) -> Column:
    return x.cast("date") if isinstance(x, Column) else F.lit(str(x)).cast("date")


def increase_eligible(subscriptions: DataFrame, history: DataFrame, cfg: Mapping, as_of) -> DataFrame:
    """Active subscriptions with charge >= the minimum, of an included
    service type (empty list = all), whose customer had no increase in the
    last N days. ``history`` has (customer_id, increase_date)."""
    el = cfg["eligibility"]
    s = subscriptions.filter((F.col("active") == F.lit(True))
                             & (units(F.col("recurring_charge"))
                                >= int(round(float(el["minimum_recurring_charge"]) * 100))))
    if el["service_types_to_include"]:
        s = s.filter(F.col("service_type").isin(*el["service_types_to_include"]))
    recent = history.filter(F.col("increase_date") > F.date_sub(_date(as_of),
                                                                el["minimum_days_since_last_increase"]))
    return s.join(recent.select("customer_id"), ["customer_id"], "left_anti")


def new_price_cents(old: Column, cfg: Mapping) -> Column:
    """New price in cents: a percentage (in basis points) rounded half-up, or
    a flat amount added — integer arithmetic, exact in any engine."""
    inc = cfg["increase"]
    c = units(old)
    if inc["type"] == "percentage":
        bp = int(round(float(inc["value"]) * 100))
        return div_half_up(c * (10000 + bp), F.lit(10000))
    return c + int(round(float(inc["value"]) * 100))


def increase_prices(eligible: DataFrame, cfg: Mapping) -> DataFrame:
    return eligible.select("*", from_units(units(F.col("recurring_charge"))).alias("old_price"),
                           from_units(new_price_cents(F.col("recurring_charge"), cfg)).alias("new_price"))


def _fill(template: str, values: Mapping[str, Column]) -> Column:
    """Substitute ``{name}`` / ``{name:.2f}`` placeholders with columns."""
    out = F.lit(template)
    for name, col in values.items():
        if "{" + name + ":.2f}" in template:
            out = F.replace(out, F.lit("{" + name + ":.2f}"), F.format_string("%.2f", col))
        if "{" + name + "}" in template:
            out = F.replace(out, F.lit("{" + name + "}"), col.cast("string"))
    return out


def increase_notices(priced: DataFrame, customers: DataFrame, cfg: Mapping, as_of,
                     company_name: str = "Your service team") -> DataFrame:
    """One notice per priced subscription, with the effective date
    ``days_before_increase`` days after ``as_of``: a message with subject and body
    filled in, or, by the method ``crm_tag``, the tag by which the CRM sends its
    own. None when the customer is not to be notified."""
    n = cfg["notification"]
    by_tag = n["notification_method"] == "crm_tag"
    priced = priced if n["notify_customer"] else priced.limit(0)
    c = customers.select(F.col("customer_id").alias("_cid"), "company_name", "first_name", "last_name",
                         "email")
    j = priced.join(c, priced["customer_id"] == c["_cid"], "left")
    eff = F.date_add(_date(as_of), n["days_before_increase"])
    vals = {"customer_name": F.coalesce(customer_display_name(F.col("company_name"), F.col("first_name"),
                                                              F.col("last_name")), F.lit("")),
            "effective_date": eff.cast("string"), "old_price": F.col("old_price"),
            "new_price": F.col("new_price"), "company_name": F.lit(company_name)}
    text = lambda x: F.lit(None).cast("string") if by_tag else x
    return j.select("subscription_id", "customer_id", "email", eff.alias("effective_date"),
                    F.lit(n["notification_method"]).alias("method"), text(F.lit(n["email_subject"])).alias("subject"),
                    text(_fill(n["email_body"], vals)).alias("body"),
                    F.lit(PENDING_TAG if by_tag else None).cast("string").alias("tag"))


def increase_notes(priced: DataFrame, cfg: Mapping, as_of) -> DataFrame:
    """Account note and next-service note per priced subscription."""
    a = cfg["account_notation"]
    vals = {"old_price": F.col("old_price"), "new_price": F.col("new_price"),
            "date": _date(as_of).cast("string"),
            "days_before": F.lit(str(cfg["notification"]["days_before_increase"]))}
    return priced.select(
        "subscription_id", "customer_id",
        (_fill(a["note_template"], vals) if a["add_note_to_account"] else F.lit(None).cast("string"))
        .alias("account_note"),
        (_fill(a["service_note_template"], vals) if a["add_note_to_next_service"]
         else F.lit(None).cast("string")).alias("service_note"))


def increase_plan(priced: DataFrame, cfg: Mapping) -> DataFrame:
    """Every priced row, with the dry-run flag and ``in_this_run``: whether
    its customer is among the first ``max_customers_per_run`` by id, the
    safety limit of one run. The others wait for a later run."""
    sf = cfg["safety"]
    batch = (priced.select("customer_id").distinct().orderBy("customer_id")
             .limit(int(sf["max_customers_per_run"])).withColumn("in_this_run", F.lit(True)))
    return (priced.join(batch, ["customer_id"], "left")
            .withColumn("in_this_run", F.coalesce("in_this_run", F.lit(False)))
            .withColumn("dry_run", F.lit(bool(sf["dry_run"]))))


CAMPAIGN_SCHEMA = "run bigint, customer_id bigint, subscription_id bigint, old_price double, new_price double, run_at timestamp"


def campaign_run(priced: DataFrame, cfg: Mapping, ledger_path: str, run_at) -> DataFrame:
    """One run of the campaign: of the priced customers that no earlier run has
    taken, the first ``max_customers_per_run`` by id, with all of their
    subscriptions. A live run is noted in the ledger before its rows are
    returned, so the next one goes on behind it; a dry run is not."""
    from fieldlake.sources import sinks
    spark = priced.sparkSession
    past = sinks.read(spark, ledger_path) if sinks.exists(spark, ledger_path) else spark.createDataFrame([], CAMPAIGN_SCHEMA)
    number = (past.agg(F.max("run")).first()[0] or 0) + 1
    left = increase_plan(priced.join(past.select("customer_id").distinct(), ["customer_id"], "left_anti"), cfg)
    rows = left.filter("in_this_run").select(
        F.lit(number).cast("long").alias("run"), "customer_id", "subscription_id", "old_price", "new_price",
        F.lit(str(run_at)).cast("timestamp").alias("run_at"))
    if cfg["safety"]["dry_run"]:
        return rows
    sinks.append(rows, ledger_path)
    return sinks.read(spark, ledger_path).filter(F.col("run") == number)
