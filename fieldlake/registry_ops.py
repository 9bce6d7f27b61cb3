"""Spark side of the conform, load, contact, quality and pricing queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlake.operators import conform as C
from fieldlake.operators import load as L
from fieldlake.session import scratch_path
from fieldlake.sources import sinks
from fieldlake.sources.testdata import load

RUN_AT = "2000-01-03 06:00:00"
WINDOW = (1, "1999-12-01", "1999-12-31")        # office, start, end of the sync window
ALL_DATES = ("1990-01-01", "2010-12-31")
CHANGED_AS_OF, CHANGED_DAYS = "1999-12-31 00:00:00", 7
BACKFILL_MONTHS = ("1998-01-01", "1998-03-01")
CALENDAR_AS_OF = "1999-12-15"
LEDGER_BEFORE = "1997-05-01"                    # the first backfill run got this far
NIGHTLY = ("1999-12-31 00:00:00", 20)           # as of, days to look back
NIGHTLY_OFFICES = (1, 2, 3)                     # the third one's subscription search fails


def _no_stamp(df: DataFrame) -> DataFrame:
    return df.drop("loaded_at")


def conformed_appointments(s: SparkSession, sf: str) -> DataFrame:
    rt = L.route_tech(load(s, sf, "raw_routes"), *ALL_DATES)
    return C.conform_appointments(C.real_office(load(s, sf, "raw_appointments")), RUN_AT, route_tech=rt)


def window_incoming(s: SparkSession, sf: str) -> DataFrame:
    """The window's re-fetched appointments: a tenth vanished from the
    search, a seventh now cancelled."""
    office, start, end = WINDOW
    a = load(s, sf, "fact_appointments")
    w = a.filter((F.col("office_id") == office) & F.col("scheduled_date").between(start, end)
                 & (F.col("appointment_id") % 10 != 0))
    return w.withColumn("status", F.when(F.col("appointment_id") % 7 == 0, F.lit(-1).cast("long"))
                        .otherwise(F.col("status")))


def _conform_queries() -> dict:
    q = {}
    q["conform_service_types"] = lambda s, sf: _no_stamp(C.conform_service_types(
        load(s, sf, "raw_service_types"), RUN_AT))
    q["conform_employees"] = lambda s, sf: _no_stamp(C.conform_employees(load(s, sf, "raw_employees"), RUN_AT))
    q["conform_products"] = lambda s, sf: _no_stamp(C.conform_products(load(s, sf, "raw_products"), RUN_AT))
    q["conform_customers"] = lambda s, sf: _no_stamp(C.conform_customers(
        C.real_records(load(s, sf, "raw_customers")), RUN_AT))
    q["conform_subscriptions"] = lambda s, sf: _no_stamp(C.conform_subscriptions(
        C.real_records(load(s, sf, "raw_subscriptions")), RUN_AT))
    q["conform_appointments"] = lambda s, sf: _no_stamp(conformed_appointments(s, sf))
    q["conform_tickets"] = lambda s, sf: _no_stamp(C.conform_tickets(
        C.real_office(load(s, sf, "raw_tickets")), RUN_AT))
    q["ticket_items"] = lambda s, sf: _no_stamp(C.explode_ticket_items(
        C.real_office(load(s, sf, "raw_tickets_nested")), RUN_AT))
    q["real_records"] = lambda s, sf: C.real_records(load(s, sf, "raw_subscriptions"))
    q["real_appointments"] = lambda s, sf: C.real_office(load(s, sf, "raw_appointments")).select(
        "appointmentID", "officeID", "customerID")
    return q


def _health(s: SparkSession, summary: DataFrame) -> DataFrame:
    path = scratch_path(s, "health")
    sinks.write_health(summary, path)
    return sinks.read(s, path)


def _fetch(s: SparkSession, sf: str):
    """What a search of the source returns: an office's records of an entity.
    Tickets are nested once and landed by office, not once for each search."""
    from fieldlake.sources.testdata import RAW_ENTITY
    tables = {e: n for n, e in RAW_ENTITY.items()}
    landed, tickets = scratch_path(s, "tickets"), load(s, sf, "raw_tickets_nested")
    tickets.write.partitionBy("officeID").option("compression", "zstd").parquet(landed)

    def found(entity):
        if entity == "ticket":
            return s.read.schema(tickets.schema).parquet(landed).select(*tickets.columns)
        return load(s, sf, tables[entity])
    return lambda entity, office: found(entity).filter(F.col("officeID") == str(office))


BACKFILL_SLOTS = 64  # office-months of one job


def _backfilled(s: SparkSession, sf: str) -> str:
    """The tables after a history load that was stopped after its first job
    and run again."""
    from fieldlake.plans.backfill import backfill_run
    root, fetch = scratch_path(s, "backfill"), _fetch(s, sf)
    for jobs in (1, None):
        backfill_run(s, fetch, root, CALENDAR_AS_OF, RUN_AT, slots_per_job=BACKFILL_SLOTS, most_jobs=jobs)
    return root


def _nightly(s: SparkSession, sf: str) -> str:
    """The tables after one night, started from the star schema."""
    from fieldlake.plans import nightly
    root = scratch_path(s, "nightly")
    found = _fetch(s, sf)

    def fetch(entity, office):
        if entity == "subscription" and office == 3:
            raise RuntimeError("subscription search failed")
        return found(entity, office)

    nightly.create_tables({n: load(s, sf, n) for n in ("fact_appointments", *sinks.BY_ID)}, root)
    as_of, days = NIGHTLY
    nightly.nightly_sync(s, fetch, root, NIGHTLY_OFFICES, as_of, days, RUN_AT, full_dims=True)
    return root


def _nightly_tables(s: SparkSession, root: str) -> DataFrame:
    """All tables in one shape: table, office, id, another id, a number, an
    amount and a date of each row."""
    shapes = {
        "fact_appointments": ("appointment_id", "ticket_id", "status", "CAST(route_tech_id AS DOUBLE)", "scheduled_date"),
        "fact_tickets": ("ticket_id", "appointment_id", "customer_id", "total", "invoice_date"),
        "fact_ticket_items": ("ticket_id", "item_id", "product_id", "amount", "NULL"),
        "dim_customers": ("customer_id", "NULL", "CAST(active AS BIGINT)", "NULL", "date_added"),
        "dim_subscriptions": ("subscription_id", "customer_id", "service_type_id", "recurring_charge", "date_added"),
        "dim_service_types": ("type_id", "NULL", "frequency", "default_charge", "NULL"),
        "dim_employees": ("employee_id", "NULL", "emp_type", "NULL", "NULL"),
        "dim_products": ("product_id", "NULL", "CAST(taxable AS BIGINT)", "unit_cost", "NULL")}
    out = None
    for name, (i, other, n, amount, date) in shapes.items():
        part = sinks.read(s, f"{root}/{name}").selectExpr(
            f"'{name}' AS table_name", "CAST(office_id AS BIGINT) AS office_id", f"{i} AS id",
            f"CAST({other} AS BIGINT) AS other_id", f"CAST({n} AS BIGINT) AS number",
            f"CAST({amount} AS DOUBLE) AS amount", f"CAST({date} AS DATE) AS day")
        out = part if out is None else out.unionByName(part)
    return out


def _load_queries() -> dict:
    q = {}
    office, start, end = WINDOW
    q["replace_window"] = lambda s, sf: L.replace_window(
        load(s, sf, "fact_appointments"), window_incoming(s, sf), office, start, end,
        keys=["office_id", "appointment_id"])
    q["vanished_ids"] = lambda s, sf: L.vanished_ids(
        load(s, sf, "fact_appointments"), window_incoming(s, sf), office, start, end)
    q["window_ticket_ids"] = lambda s, sf: L.window_ticket_ids(load(s, sf, "fact_appointments"), office, start, end)

    def _refetch(s, sf):
        gone = L.vanished_ids(load(s, sf, "fact_appointments"), window_incoming(s, sf), office, start, end)
        raw = L.refetch(load(s, sf, "raw_appointments"), gone)
        return C.conform_appointments(C.real_office(raw), RUN_AT).select(
            "appointment_id", "office_id", "scheduled_date", "status", "ticket_id")
    q["vanished_refetch"] = _refetch

    def _replace_children(s, sf):
        items = load(s, sf, "fact_ticket_items")
        parents = L.window_ticket_ids(load(s, sf, "fact_appointments"), office, start, end)
        new = (items.join(parents, ["office_id", "ticket_id"], "left_semi").filter(F.col("item_id") % 10 != 1)
               .withColumn("quantity", F.col("quantity") + 1))
        return L.replace_children(items, new, parents)
    q["replace_children"] = _replace_children

    def _replace_by_id(s, sf):
        existing = load(s, sf, "dim_customers")
        raw = L.changed_since(load(s, sf, "raw_customers"), CHANGED_AS_OF, CHANGED_DAYS)
        incoming = C.conform_customers(C.real_records(raw), RUN_AT).select(*existing.columns)
        return L.replace_by_id(existing, incoming, ["office_id", "customer_id"])
    q["replace_by_id"] = _replace_by_id

    q["route_tech"] = lambda s, sf: L.route_tech(load(s, sf, "raw_routes"), start, end, office=office)
    q["best_tech"] = lambda s, sf: L.best_tech(load(s, sf, "fact_appointments")).select(
        "appointment_id", "assigned_tech_id", "route_tech_id", "best_tech_id")
    q["changed_since"] = lambda s, sf: L.changed_since(
        load(s, sf, "raw_customers"), CHANGED_AS_OF, CHANGED_DAYS).select("customerID", "dateUpdated")

    def _backfill(s, sf):
        existing = load(s, sf, "fact_appointments")
        incoming = conformed_appointments(s, sf).select(*existing.columns)
        parts = (L.loaded_months(incoming).withColumnRenamed("month_start", "month")
                 .filter(F.col("month").between(*BACKFILL_MONTHS)))
        return L.backfill(existing, incoming, parts)
    q["backfill_month"] = _backfill

    def _sync_summary(s, sf):
        a = load(s, sf, "fact_appointments").filter(F.col("scheduled_date").between(start, end))
        t = load(s, sf, "fact_tickets").filter(F.col("invoice_date").between(start, end))
        items = load(s, sf, "fact_ticket_items").join(t.select("ticket_id"), ["ticket_id"], "left_semi")
        c = load(s, sf, "dim_customers").filter(F.col("date_added").between(start, end))
        sub = load(s, sf, "dim_subscriptions").filter(F.col("date_added").between(start, end))
        offices = load(s, sf, "dim_customers").select("office_id").distinct()
        errors = offices.filter(F.col("office_id") == 2).select(
            "office_id", F.lit("route search failed").alias("error_message"))
        loaded = {"appointments": a, "tickets": t, "ticket_items": items, "customers": c,
                  "subscriptions": sub}
        return L.sync_summary(loaded, RUN_AT, 2, offices, errors)
    q["sync_summary"] = _sync_summary
    q["sync_totals"] = lambda s, sf: L.sync_totals(_sync_summary(s, sf))

    q["sync_health"] = lambda s, sf: _health(s, _sync_summary(s, sf))

    def _load_window(s, sf):
        path = scratch_path(s, "fact")
        sinks.write_fact(load(s, sf, "fact_appointments"), path)
        sinks.load_window(s, path, window_incoming(s, sf), office, start, end)
        return sinks.read_fact(s, path).drop("month")
    q["load_window"] = _load_window

    q["nightly_sync"] = lambda s, sf: _nightly_tables(s, _nightly(s, sf))
    q["nightly_health"] = lambda s, sf: sinks.read(s, f"{_nightly(s, sf)}/sync_health")
    q["nightly_rejects"] = lambda s, sf: sinks.read(s, f"{_nightly(s, sf)}/load_rejects")

    def _backfill_ledger(s, sf):
        from fieldlake.plans.backfill import ledger
        return ledger(s, _backfilled(s, sf))
    q["backfill_run"] = lambda s, sf: _nightly_tables(s, _backfilled(s, sf))
    q["backfill_ledger"] = _backfill_ledger

    def _pending(s, sf):
        fetched = load(s, sf, "fact_appointments").filter(F.col("scheduled_date") < LEDGER_BEFORE)
        ledger = scratch_path(s, "ledger")
        sinks.append(L.loaded_months(fetched), ledger)
        return L.backfill_pending(L.backfill_calendar(s, CALENDAR_AS_OF), sinks.read(s, ledger))
    q["backfill_pending"] = _pending

    q["backfill_progress"] = lambda s, sf: L.backfill_progress(
        L.backfill_calendar(s, CALENDAR_AS_OF), L.loaded_months(load(s, sf, "fact_appointments")))
    return q


def crm_existing(s: SparkSession, sf: str) -> DataFrame:
    return load(s, sf, "crm_contacts").withColumn("tags", F.split("tags", ","))


def done_imports(s: SparkSession, sf: str) -> DataFrame:
    """Customers a previous import run already created (derived from data)."""
    return (load(s, sf, "raw_customers").filter(F.col("customerID").cast("long") % 11 == 0)
            .select(F.col("customerID").alias("fr_id")))


def malformed_emails(raw: DataFrame) -> DataFrame:
    """The customers with every thirteenth email written badly."""
    odd = F.col("customerID").cast("long") % 13 == 0
    return raw.withColumn("email", F.when(odd, F.lit("not an address")).otherwise(F.col("email")))


def _txt(c: str) -> F.Column:
    return F.array_join(F.col(c), ",").alias(c)


def _contact_queries() -> dict:
    from fieldlake.functions.contact import best_phone, clean_email
    from fieldlake.operators import contacts as G
    q = {}
    q["contact_phones"] = lambda s, sf: load(s, sf, "raw_customers").select(
        "customerID", best_phone(F.col("phone1"), F.col("phone2")).alias("phone"))
    q["contact_emails"] = lambda s, sf: load(s, sf, "raw_customers").select(
        "customerID", clean_email(F.col("email")).alias("email_daily"),
        clean_email(F.col("email"), first_of_list=True).alias("email_import"))
    def _daily(office):
        return lambda s, sf: G.contacts_daily(load(s, sf, "raw_customers"), office).select(
            "fr_id", "first_name", "last_name", "email", "phone", "company_name", "address1", "city",
            "state", "postal_code", _txt("tags"), "real")
    q["contacts_daily"], q["contacts_daily_office2"] = _daily(1), _daily(2)
    q["contacts_import"] = lambda s, sf: G.contacts_import(load(s, sf, "raw_customers")).select(
        "office", "fr_id", "email", "phone", "company_name", _txt("tags"),
        F.col("custom_fields")[0]["value"].alias("custom_value"))
    q["contactable"] = lambda s, sf: G.contactable(
        G.contacts_daily(load(s, sf, "raw_customers")).filter("real")).select("fr_id", "email", "phone")
    q["tag_subscriptions"] = lambda s, sf: G.tag_subscriptions(load(s, sf, "raw_subscriptions")).select(
        "subscriptionID", "customerID", "serviceID", "active")

    def _tags(s, sf):
        return G.service_tags(G.tag_subscriptions(load(s, sf, "raw_subscriptions")))
    q["service_tags"] = lambda s, sf: _tags(s, sf).select("customerID", _txt("svc_tags"))

    def _daily_sendable(s, sf):
        return G.contactable(G.contacts_daily(load(s, sf, "raw_customers")).filter("real"))
    q["tag_counts"] = lambda s, sf: G.tag_counts(
        G.service_tags(G.tag_subscriptions(load(s, sf, "raw_subscriptions"), office=1)), _daily_sendable(s, sf))
    q["contact_match"] = lambda s, sf: G.match_contacts(_daily_sendable(s, sf), crm_existing(s, sf)).select(
        "fr_id", "contact_id")

    def _plan(s, sf, office=1):
        return G.upsert_plan(load(s, sf, "raw_customers"), load(s, sf, "raw_subscriptions"),
                             crm_existing(s, sf), office)
    for suffix, office in (("", 1), ("_office2", 2)):
        q[f"upsert_plan{suffix}"] = lambda s, sf, office=office: _plan(s, sf, office).select(
            "fr_id", "action", "contact_id", "same_as", "created_by", _txt("tags"))
        q[f"tag_merge{suffix}"] = lambda s, sf, office=office: _plan(s, sf, office).filter(
            F.col("action") == "updated").select("fr_id", "contact_id", "same_as", _txt("tags"))
        q[f"upsert_summary{suffix}"] = lambda s, sf, office=office: G.upsert_summary(
            G.upsert_actions(load(s, sf, "raw_customers"), crm_existing(s, sf), office))

    def _sendable_import(s, sf):
        return G.contactable(G.import_pending(G.contacts_import(load(s, sf, "raw_customers")),
                                              done_imports(s, sf)))
    q["import_dedupe"] = lambda s, sf: G.import_dedupe(_sendable_import(s, sf), crm_existing(s, sf)).select(
        "fr_id", "email", "phone", _txt("tags"), "action", "matched_on")
    q["duplicate_review"] = lambda s, sf: G.duplicate_review(
        G.import_dedupe(_sendable_import(s, sf), crm_existing(s, sf)))

    def _review_csv(s, sf):
        path = scratch_path(s, "review")
        sinks.write_review(q["duplicate_review"](s, sf), path)
        return s.read.option("header", True).schema(
            "fr_id string, name string, email string, phone string, matched_on string, office long").csv(path).na.fill("")
    q["duplicate_review_csv"] = _review_csv

    def _import_log(s, sf):
        path = scratch_path(s, "import-log")
        plan = G.import_plan(load(s, sf, "raw_customers"), None, crm_existing(s, sf), done_imports(s, sf),
                             dry_run=False)
        sinks.write_import_log(plan, path, RUN_AT)
        stats = s.read.schema("action string, customers long, run_at timestamp").json(f"{path}/stats")
        entries = s.read.schema("office long, fr_id string, action string, run_at timestamp").json(f"{path}/entries")
        logged = entries.groupBy("action").agg(F.count(F.lit(1)).alias("entries"))
        return stats.join(logged, ["action"], "full")
    q["import_log"] = _import_log
    q["import_pending"] = lambda s, sf: G.import_pending(
        G.contacts_import(load(s, sf, "raw_customers")), done_imports(s, sf)).select("fr_id")
    q["import_summary"] = lambda s, sf: G.import_summary(G.import_plan(
        load(s, sf, "raw_customers"), None, crm_existing(s, sf), done_imports(s, sf), dry_run=False))
    q["import_summary_dry_run"] = lambda s, sf: G.import_summary(G.import_plan(
        load(s, sf, "raw_customers"), None, crm_existing(s, sf), done_imports(s, sf), dry_run=True))

    def _outcomes(s, sf):
        contacts = G.import_pending(G.contacts_import(malformed_emails(load(s, sf, "raw_customers"))), done_imports(s, sf))
        return G.import_outcomes(G.contactable(contacts), crm_existing(s, sf), accepts_bare=False)
    q["import_outcomes"] = lambda s, sf: _outcomes(s, sf).select(
        "office", "fr_id", "email", "phone", _txt("tags"), "action", "matched_on")
    q["import_outcome_summary"] = lambda s, sf: G.import_summary(G.import_plan(
        malformed_emails(load(s, sf, "raw_customers")), None, crm_existing(s, sf), done_imports(s, sf), dry_run=False,
        accepts_bare=False))

    def _outcome_review(s, sf):
        path = scratch_path(s, "review")
        sinks.write_review(G.duplicate_review(_outcomes(s, sf)), path)
        return s.read.option("header", True).schema(
            "fr_id string, name string, email string, phone string, matched_on string, office long").csv(path).na.fill("")
    q["outcome_review_csv"] = _outcome_review
    q["invalid_emails"] = lambda s, sf: G.flag_invalid_emails(
        G.contacts_daily(load(s, sf, "raw_customers")).filter("real")).select(
        "fr_id", "email", "phone", _txt("tags"), "invalid_action")
    return q


EXPECTED_CUSTOMERS = {1: 1000, 2: 250, 3: 20}
PRICE_AS_OF = "2001-06-01"
CAMPAIGN_DAYS = ("2001-06-01 08:00:00", "2001-06-02 08:00:00", "2001-06-03 08:00:00")


def increase_history(s: SparkSession, sf: str) -> DataFrame:
    """Past increases derived from the subscriptions: every fifth one had an
    increase 400 days after it was added."""
    subs = load(s, sf, "dim_subscriptions")
    return subs.filter(F.col("subscription_id") % 5 == 1).select(
        "customer_id", F.date_add("date_added", 400).alias("increase_date"))


def _quality_pricing_queries() -> dict:
    from fieldlake.operators import pricing as P
    from fieldlake.operators import quality as Q
    q = {}
    active_subs = lambda s, sf: load(s, sf, "raw_subscriptions").filter(F.col("active") == "1")
    q["orphan_rate"] = lambda s, sf: Q.orphan_rate(active_subs(s, sf))
    q["orphan_rate_sampled"] = lambda s, sf: Q.orphan_rate(active_subs(s, sf), sample_modulus=7)
    q["count_check"] = lambda s, sf: Q.count_check(load(s, sf, "raw_customers"),
                                                   Q.expectations(s, EXPECTED_CUSTOMERS))
    q["sample_subscription"] = lambda s, sf: Q.sample_subscription(load(s, sf, "raw_subscriptions"))
    q["conform_rejects"] = lambda s, sf: Q.conform_rejects(load(s, sf, "raw_subscriptions"), "subscription")
    q["conform_rejects_appointments"] = lambda s, sf: Q.conform_rejects(
        load(s, sf, "raw_appointments"), "appointment")

    for name, table, entity in (
            ("service_types", "raw_service_types", "serviceType"), ("employees", "raw_employees", "employee"),
            ("products", "raw_products", "product"), ("customers", "raw_customers", "customer"),
            ("tickets", "raw_tickets", "ticket"), ("routes", "raw_routes", "route"),
            ("ticket_items", "raw_tickets_nested", "ticketItem")):
        q[f"conform_rejects_{name}"] = lambda s, sf, t=table, e=entity: Q.conform_rejects(load(s, sf, t), e)

    cfg = P.config()

    def _eligible(s, sf):
        return P.increase_eligible(load(s, sf, "dim_subscriptions"), increase_history(s, sf), cfg, PRICE_AS_OF)
    q["increase_eligible"] = lambda s, sf: _eligible(s, sf).select("subscription_id", "customer_id",
                                                                   "recurring_charge")
    q["increase_prices"] = lambda s, sf: P.increase_prices(_eligible(s, sf), cfg).select(
        "subscription_id", "customer_id", "old_price", "new_price")
    flat = P.config({"increase": {"type": "flat", "value": 5}})
    q["increase_prices_flat"] = lambda s, sf: P.increase_prices(_eligible(s, sf), flat).select(
        "subscription_id", "old_price", "new_price")
    q["increase_notices"] = lambda s, sf: P.increase_notices(
        P.increase_prices(_eligible(s, sf), cfg), load(s, sf, "dim_customers"), cfg, PRICE_AS_OF)
    tagged = P.config({"notification": {"notification_method": "crm_tag"}})
    q["increase_notices_office2"] = lambda s, sf: P.increase_notices(
        P.increase_prices(_eligible(s, sf).filter("office_id = 2"), tagged), load(s, sf, "dim_customers"), tagged, PRICE_AS_OF)

    def _campaign(s, sf):
        path = scratch_path(s, "campaign")
        live = P.config({"safety": {"dry_run": False}})
        for day in CAMPAIGN_DAYS:
            P.campaign_run(P.increase_prices(_eligible(s, sf), live), live, path, day)
        return sinks.read(s, path)
    q["campaign_runs"] = _campaign
    q["increase_notes"] = lambda s, sf: P.increase_notes(P.increase_prices(_eligible(s, sf), cfg), cfg,
                                                         PRICE_AS_OF)
    q["increase_plan"] = lambda s, sf: P.increase_plan(P.increase_prices(_eligible(s, sf), cfg), cfg).select(
        "subscription_id", "customer_id", "old_price", "new_price", "in_this_run", "dry_run")
    return q


def _land_json(rows: DataFrame, landing: str) -> None:
    """Land records as gzipped JSON lines: all-string records are a tenth of
    their plain size."""
    rows.write.mode("append").option("compression", "gzip").json(landing)


def stream_landing(s: SparkSession, sf: str, landing: str) -> None:
    """Land raw customers as change files: three files of originals, then a
    later file re-sending every tenth customer with a new email — and that
    key twice within the file, the newer one winning."""
    raw = load(s, sf, "raw_customers")
    k = F.col("customerID").cast("long") - 1
    for part in range(3):
        _land_json(raw.filter(k % 3 == part), landing)
    changed = raw.filter(k % 10 == 0)
    older = changed.withColumn("email", F.concat(F.lit("old"), F.col("customerID"), F.lit("@x.com"))) \
        .withColumn("dateUpdated", F.lit("2000-01-01 09:00:00"))
    newer = changed.withColumn("email", F.concat(F.lit("changed"), F.col("customerID"), F.lit("@x.com"))) \
        .withColumn("dateUpdated", F.lit("2000-01-02 09:00:00"))
    _land_json(older.unionByName(newer), landing)


def messy_lines(raw: DataFrame, key: str) -> DataFrame:
    """Records as JSON lines, of which some are cut short (ids that 50 divides)
    and some hold a field that is not declared (3 mod 20)."""
    n = F.coalesce(F.col(key).try_cast("long"), F.lit(1))
    line = F.to_json(F.struct(*raw.columns))
    more = F.concat(F.lit('{"fromApp":"x",'), F.substr(line, F.lit(2)))
    return raw.select(F.when(n % 50 == 0, F.substr(line, F.lit(1), F.length(line) - 4))
                      .when(n % 20 == 3, more).otherwise(line).alias("value"))


STREAMED = {  # entity -> (fixture, id field, what a later change file says, what a late one does)
    "subscription": ("raw_subscriptions", "subscriptionID", {"recurringCharge": "'99.25'"}, "serviceType"),
    "appointment": ("raw_appointments", "appointmentID", {"date": "CAST(date_add(date, 40) AS STRING)"}, "customerID"),
    "ticket": ("raw_tickets_nested", "appointmentID", {
        "total": "'77.25'", "items": "filter(items, x -> NOT endswith(x.itemID, '1'))"}, "customerID"),
}
CHANGED_STAMPS = ("2030-01-01 09:00:00", "2030-01-02 09:00:00")  # of the two changes to every tenth record
LATE_STAMP = "1990-01-01 09:00:00"


def change_files(s: SparkSession, sf: str, entity: str) -> list[DataFrame]:
    """Three landings: all records; two later changes to every tenth one, of
    which the second wins; and a late file of every seventh one, which loses."""
    name, key, changes, lost = STREAMED[entity]
    raw = load(s, sf, name)
    number = F.col(key).cast("long")
    changed = raw.filter(number % 10 == 0)
    newer = changed.withColumns({c: F.expr(e) for c, e in changes.items()}).withColumn("dateUpdated", F.lit(CHANGED_STAMPS[1]))
    older = changed.withColumn("dateUpdated", F.lit(CHANGED_STAMPS[0]))
    late = raw.filter(number % 7 == 0).withColumn(lost, F.lit("1")).withColumn("dateUpdated", F.lit(LATE_STAMP))
    return [raw, older.unionByName(newer), late]


def streamed(s: SparkSession, sf: str, entity: str) -> str:
    """The table after the stream has read the landings one by one, stopped
    and started again between them."""
    from fieldlake.streaming.upsert import start_upsert_stream
    landing, table, ckpt = (scratch_path(s, f"{n}-{entity}") for n in ("landing", "table", "ckpt"))
    for rows in change_files(s, sf, entity):
        _land_json(rows, landing)
        start_upsert_stream(s, landing, table, entity, ckpt, RUN_AT).awaitTermination()
    return table


def _source_stream_queries() -> dict:
    from fieldlake.operators.load import refresh_dimension
    from fieldlake.plans.catalog import register_views, view_rows
    from fieldlake.sources.raw import land, read_raw
    from fieldlake.sources.schemas import RAW_FIELDS
    from fieldlake.sources.testdata import AS_OF_AGING, AS_OF_ROUTES, RAW_ENTITY, star
    from fieldlake.streaming.upsert import items_path, start_upsert_stream
    q = {}

    def _raw(s, sf):
        path = scratch_path(s, "landing")
        _land_json(load(s, sf, "raw_subscriptions"), path)
        return read_raw(s, "subscription", path)
    q["raw_subscriptions"] = _raw

    def _landed(entity, name):
        def run(s, sf):
            path = scratch_path(s, f"landing-{entity}")
            _land_json(load(s, sf, name), path)
            rows = read_raw(s, entity, path)
            return rows if entity != "ticket" else rows.withColumn(
                "items", F.when(F.col("items").isNotNull(), F.size("items")).cast("long"))
        return run
    for name, entity in RAW_ENTITY.items():
        q.setdefault(name, _landed(entity, "raw_tickets_nested" if entity == "ticket" else name))

    def _quarantine(s, sf):
        report = None
        for name, entity in RAW_ENTITY.items():
            path, root = (scratch_path(s, f"{n}-{entity}") for n in ("messy", "landed"))
            messy_lines(load(s, sf, name), RAW_FIELDS[entity][0]).write.option("compression", "gzip").text(path)
            part = land(s, entity, path, root)
            report = part if report is None else report.unionByName(part)
        return report
    q["raw_quarantine"] = _quarantine

    def _dim(name, conform):
        def run(s, sf):
            path = scratch_path(s, "dim")
            raw = load(s, sf, name)
            first = F.coalesce(F.col("officeID") == "1", F.lit(False))
            per_office = [raw.filter(first), raw.filter(~first)]  # as fetched: one office, then the rest
            sinks.overwrite(refresh_dimension(per_office, conform, RUN_AT), path)
            sinks.overwrite(raw.limit(0), path)  # an empty refresh keeps the table
            return sinks.read(s, path).drop("loaded_at")
        return run
    q["dim_overwrite"] = _dim("raw_service_types", C.conform_service_types)
    q["dim_overwrite_employees"] = _dim("raw_employees", C.conform_employees)
    q["dim_overwrite_products"] = _dim("raw_products", C.conform_products)

    def _appended(s, sf):
        path = scratch_path(s, "appended")
        products = C.conform_products(load(s, sf, "raw_products"), RUN_AT)
        sinks.append(products.filter("product_id % 2 = 0"), path)
        sinks.append(products.filter("product_id % 2 <> 0"), path)
        sinks.append(products.filter("taxable"), path)
        return sinks.read(s, path)
    q["appended_table"] = _appended

    def _created(s, sf):
        root = scratch_path(s, "tables")
        for name in ("dim_products", "dim_customers"):
            sinks.create(load(s, sf, name), f"{root}/{name}", name)
        report = sinks.ensure_tables(s, root)
        counts = None
        for name, _ in report.collect():
            n = sinks.read(s, f"{root}/{name}").agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("table"), "rows")
            counts = n if counts is None else counts.unionByName(n)
        return report.join(counts, ["table"])
    q["created_tables"] = _created

    q["view_catalog"] = lambda s, sf: view_rows(s, register_views(s, star(s, sf), AS_OF_AGING, AS_OF_ROUTES))

    def _stream(s, sf):
        landing, table, ckpt = (scratch_path(s, n) for n in ("stream-landing", "stream-table", "stream-ckpt"))
        stream_landing(s, sf, landing)
        start_upsert_stream(s, landing, table, "customer", ckpt, RUN_AT).awaitTermination()
        return sinks.read(s, table).drop("loaded_at", "changed_at", "id_range")
    q["stream_upsert"] = _stream
    q["stream_subscriptions"] = lambda s, sf: sinks.read(s, streamed(s, sf, "subscription")).drop(
        "loaded_at", "changed_at", "id_range")
    q["stream_appointments"] = lambda s, sf: sinks.read(s, streamed(s, sf, "appointment")).drop(
        "loaded_at", "changed_at", "month")
    q["stream_tickets"] = lambda s, sf: sinks.read(s, streamed(s, sf, "ticket")).drop(
        "loaded_at", "changed_at", "id_range")
    q["stream_ticket_items"] = lambda s, sf: sinks.read(s, items_path(streamed(s, sf, "ticket"))).drop(
        "loaded_at", "id_range")
    return q


def queries() -> dict:
    out = {}
    out.update(_source_stream_queries())
    out.update(_quality_pricing_queries())
    out.update(_conform_queries())
    out.update(_load_queries())
    out.update(_contact_queries())
    return out
