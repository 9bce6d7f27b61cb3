"""The KPI views over the star schema, as DataFrame functions.

Each view takes the conformed tables it reads and returns a DataFrame; no
view reads the clock — dates are parameters. Behaviours of the original
views are kept on purpose (they are noted per view): only service types are
de-duplicated before joining, ``customer_growth`` is an un-re-aggregated
UNION ALL, and ``inspection_conversion`` counts an inspection once per
follow-up date (``inspection_conversion_distinct`` counts it once).

Join strategy: dimension joins are left to the planner. Spark broadcasts a
side only when its size (static estimate, then the actual size under AQE)
is under ``spark.sql.autoBroadcastJoinThreshold``; above it the join stays
a sort-merge join, and AQE splits skewed partitions. Fact-to-fact joins are
shuffled on their key with rows that cannot match dropped first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlake.functions.codes import (
    STATUS_COMPLETE, STATUS_PENDING, OFFICE_COMMERCIAL,
    customer_display_name, office_name, person_name, production_value,
)
from fieldlake.functions.exact import (
    PLACES, from_units, money_avg, money_sum, parts, ratio, ratio_pct, rounded_units, sum_exact,
)


def _month(d: Column) -> Column:
    return F.trunc(d, "month")


def _date(x) -> Column:
    return F.lit(x).cast("date") if not isinstance(x, Column) else x.cast("date")


# ---------------------------------------------------------------------------
# V11 — service-type dedupe
# ---------------------------------------------------------------------------

def dedup_service_types(service_types: DataFrame) -> DataFrame:
    """One row per type_id (duplicates in the source are true copies)."""
    return (service_types.groupBy("type_id").agg(
        F.any_value("description").alias("description"),
        F.any_value("is_inspection").alias("is_inspection"),
        F.any_value("reservice").alias("reservice"),
        F.any_value("regular_service").alias("regular_service"),
    ))


# ---------------------------------------------------------------------------
# V1, V2, V3 — single-table views
# ---------------------------------------------------------------------------

def mrr_by_service_type(subscriptions: DataFrame) -> DataFrame:
    """Active subscriptions with a positive charge, per service type and office.
    Frequency is ignored: MRR is the plain sum of recurring charges."""
    s = subscriptions.filter((F.col("active") == F.lit(True)) & (F.col("recurring_charge") > 0))
    return (s.groupBy("service_type", "office_id")
            .agg(F.count(F.lit(1)).alias("subscription_count"),
                 money_sum(F.col("recurring_charge")).alias("mrr"))
            .select("service_type", "office_id", office_name(F.col("office_id")).alias("office_name"),
                    "subscription_count", "mrr"))


def monthly_revenue(tickets: DataFrame) -> DataFrame:
    """Invoice count, revenue, outstanding balance and average per month and office."""
    t = tickets.filter((F.col("active") == F.lit(True)) & F.col("invoice_date").isNotNull()
                       & (F.col("total") > 0))
    return (t.groupBy(_month(F.col("invoice_date")).alias("month"), "office_id")
            .agg(F.count(F.lit(1)).alias("invoice_count"),
                 money_sum(F.col("total")).alias("revenue"),
                 money_sum(F.col("balance")).alias("outstanding"),
                 money_avg(F.col("total")).alias("avg_invoice"))
            .select("month", "office_id", office_name(F.col("office_id")).alias("office_name"),
                    "invoice_count", "revenue", "outstanding", "avg_invoice"))


def customer_growth(customers: DataFrame) -> DataFrame:
    """New customers per signup month plus cancellations in later months.

    Kept as in the original: the two branches are a UNION ALL that is not
    re-aggregated (a key can appear twice), later-month cancellations land in
    ``same_month_cancel``, and a NULL date_added drops a row from branch 2.
    """
    added, cancelled = F.col("date_added"), F.col("date_cancelled")
    keys = ["office_id", "commercial_account"]
    new = (customers.filter(added.isNotNull())
           .groupBy(_month(added).alias("month"), *keys)
           .agg(F.count(F.lit(1)).alias("new_customers"),
                F.count_if(cancelled.isNotNull() & (_month(cancelled) == _month(added)))
                .alias("same_month_cancel")))
    later = (customers.filter(cancelled.isNotNull() & (_month(cancelled) != _month(added)))
             .groupBy(_month(cancelled).alias("month"), *keys)
             .agg(F.lit(0).cast("long").alias("new_customers"),
                  F.count(F.lit(1)).alias("same_month_cancel")))
    cols = ["month", "office_id", office_name(F.col("office_id")).alias("office_name"),
            "commercial_account", "new_customers", "same_month_cancel"]
    return new.select(cols).unionByName(later.select(cols))


# ---------------------------------------------------------------------------
# V4, V5, V6 — technician views
# ---------------------------------------------------------------------------

def _completed(appointments: DataFrame) -> DataFrame:
    return appointments.filter((F.col("status") == STATUS_COMPLETE)
                               & F.col("serviced_by_id").isNotNull()
                               & F.col("scheduled_date").isNotNull())


def _with_tickets(appts: DataFrame, tickets: DataFrame) -> DataFrame:
    """Inner fact-to-fact join on ticket_id. Ids <= 0 are unset (the conform
    jobs give 0 to a ticket without an id), so they are removed before the
    shuffle: joined, all of them would pair with each other."""
    a = appts.filter(F.col("ticket_id") > 0)
    tk = (tickets.filter(F.col("ticket_id") > 0)
          .select(F.col("ticket_id").alias("tk_ticket_id"),
                  F.col("total").alias("tk_total"),
                  F.col("production_value").alias("tk_production")))
    return a.join(tk, a["ticket_id"] == tk["tk_ticket_id"], "inner")


def _with_tech(df: DataFrame, employees: DataFrame, tech_col: str) -> DataFrame:
    e = employees.select(F.col("employee_id").alias("e_id"), F.col("first_name").alias("e_first"),
                         F.col("last_name").alias("e_last"), F.col("initials").alias("e_initials"))
    j = df.join(e, df[tech_col] == e["e_id"], "left")
    return (j.withColumn("tech_name", person_name(F.col("e_first"), F.col("e_last"), F.col(tech_col)))
            .withColumn("initials", F.coalesce(F.col("e_initials"), F.lit(""))))


def _with_reservice(df: DataFrame, service_types: DataFrame) -> DataFrame:
    st = dedup_service_types(service_types).select(
        F.col("type_id").alias("st_id"), F.col("reservice").alias("st_reservice"))
    j = df.join(st, df["service_type_id"] == st["st_id"], "left")
    return j.withColumn("is_reservice",
                        (F.col("st_reservice") == F.lit(True)) | F.col("reservice_reason_id").isNotNull())


_TECH_KEYS = ["month", "office_id", "office_name", "employee_id", "tech_name", "initials"]


def _tech_frame(df: DataFrame) -> DataFrame:
    return (df.withColumn("month", _month(F.col("scheduled_date")))
            .withColumn("office_name", office_name(F.col("office_id")))
            .withColumn("employee_id", F.col("serviced_by_id")))


def tech_production(appointments: DataFrame, tickets: DataFrame, employees: DataFrame,
                    service_types: DataFrame) -> DataFrame:
    """Completed jobs, production and revenue per technician and month.
    No ``total > 0`` filter: $0 contract visits still carry production."""
    df = _with_reservice(_with_tech(_with_tickets(_completed(appointments), tickets), employees,
                                    "serviced_by_id"), service_types)
    prod = production_value(F.col("tk_production"), F.col("tk_total"))
    return (_tech_frame(df).groupBy(*_TECH_KEYS)
            .agg(F.count(F.lit(1)).alias("completed_jobs"),
                 money_sum(prod).alias("production_value"),
                 money_sum(F.col("tk_total")).alias("revenue_value"),
                 money_avg(prod).alias("avg_job_production"),
                 money_avg(F.col("tk_total")).alias("avg_job_revenue"),
                 F.count_if(F.col("is_reservice")).alias("reservice_count")))


def tech_hourly_rate(appointments: DataFrame, tickets: DataFrame, employees: DataFrame) -> DataFrame:
    """Hours on site and production/revenue per hour, for jobs timed 0–600 min."""
    a = _completed(appointments).filter((F.col("duration_actual_min") > 0)
                                        & (F.col("duration_actual_min") < 600))
    df = _with_tech(_with_tickets(a, tickets), employees, "serviced_by_id")
    prod = production_value(F.col("tk_production"), F.col("tk_total"))
    g = (_tech_frame(df).groupBy(*_TECH_KEYS)
         .agg(F.count(F.lit(1)).alias("jobs_with_time"),
              sum_exact(F.col("duration_actual_min")).alias("_dur"),
              money_avg(F.col("duration_actual_min"), 1).alias("avg_minutes_per_job"),
              sum_exact(prod).alias("_prod"), money_sum(prod).alias("total_production"),
              sum_exact(F.col("tk_total")).alias("_rev"), money_sum(F.col("tk_total")).alias("total_revenue")))
    minutes = parts(F.col("_dur"))
    per_hour = lambda total: ratio(parts(total) * 60, minutes)
    return g.select(
        *_TECH_KEYS, "jobs_with_time", ratio(minutes, F.lit(60 * 10 ** PLACES)).alias("total_hours_on_site"),
        "total_production", "total_revenue", "avg_minutes_per_job",
        per_hour(F.col("_prod")).alias("production_per_hour"), per_hour(F.col("_rev")).alias("revenue_per_hour"))


def reservice_rates(appointments: DataFrame, employees: DataFrame,
                    service_types: DataFrame) -> DataFrame:
    """Share of completed jobs that were re-services, per tech, route and month."""
    df = _with_reservice(_with_tech(_completed(appointments), employees, "serviced_by_id"),
                         service_types)
    return (_tech_frame(df).groupBy(*_TECH_KEYS, "route_id")
            .agg(F.count(F.lit(1)).alias("total_completed"),
                 F.count_if(F.col("is_reservice")).alias("reservice_count"))
            .withColumn("reservice_pct", ratio_pct(F.col("reservice_count"), F.col("total_completed"))))


# ---------------------------------------------------------------------------
# V7 — receivables ageing
# ---------------------------------------------------------------------------

def ar_aging(tickets: DataFrame, customers: DataFrame, as_of) -> DataFrame:
    """Open invoices (balance > 0.01) with age buckets relative to ``as_of``.
    A future invoice has negative age and falls in '0-30 days'."""
    t = tickets.filter((F.col("balance") > 0.01) & (F.col("active") == F.lit(True))
                       & F.col("invoice_date").isNotNull())
    c = customers.select(F.col("customer_id").alias("c_id"), "company_name", "first_name",
                         "last_name", "phone1", "email")
    j = t.join(c, t["customer_id"] == c["c_id"], "left")
    days = F.datediff(_date(as_of), F.col("invoice_date")).cast("long")
    bucket = (F.when(days <= 30, F.lit(1)).when(days <= 60, F.lit(2))
              .when(days <= 90, F.lit(3)).otherwise(F.lit(4)))
    label = F.element_at(F.array(F.lit("0-30 days"), F.lit("31-60 days"), F.lit("61-90 days"),
                                 F.lit("90+ days")), bucket)
    bucket = bucket.cast("long")
    return j.select(
        "office_id", office_name(F.col("office_id")).alias("office_name"), "customer_id",
        customer_display_name(F.col("company_name"), F.col("first_name"), F.col("last_name"))
        .alias("customer_name"),
        "phone1", "email", "ticket_id", "invoice_date", days.alias("days_outstanding"),
        "total", "balance", label.alias("aging_bucket"), bucket.alias("aging_sort"))


# ---------------------------------------------------------------------------
# V8 — inspection conversion (range join)
# ---------------------------------------------------------------------------

_BUCKET_DAYS = 30


def _day_number(d: Column) -> Column:
    return F.datediff(d, F.lit("1970-01-01").cast("date"))


def _marks(appointments: DataFrame, service_types: DataFrame, days: int) -> DataFrame:
    """One scan: completed inspections, once for each 30-day bucket that their
    window (the ``days`` days after them) touches, and regular services as one
    bit a day in their own bucket, combined map-side."""
    st = dedup_service_types(service_types).select(
        F.col("type_id").alias("st_id"), F.col("description").alias("st_description"),
        F.col("is_inspection").alias("st_insp"), F.col("reservice").alias("st_res"),
        F.col("regular_service").alias("st_reg"))
    a = appointments.filter(F.col("status") == STATUS_COMPLETE)
    a = a.join(st, a["service_type_id"] == st["st_id"], "inner")
    day, date = _day_number(F.col("scheduled_date")), F.col("scheduled_date")
    inspection = F.coalesce(F.col("st_insp"), F.lit(False))
    followup = ((F.col("st_insp") == F.lit(False)) & (F.col("st_res") == F.lit(False)) & (F.col("st_reg") == F.lit(True))
                & F.col("customer_id").isNotNull() & date.isNotNull())
    touched = F.sequence(F.floor((day + 1) / _BUCKET_DAYS), F.floor((day + days) / _BUCKET_DAYS))
    no_bucket = F.array(F.lit(None).cast("long"))  # of an undated inspection
    buckets = F.when(inspection, F.coalesce(touched, no_bucket)).when(followup, F.array(F.floor(day / _BUCKET_DAYS)))
    bit = F.when(followup, F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(day, F.lit(_BUCKET_DAYS))))
    own = lambda c: F.when(inspection, c)
    return (a.select("customer_id", F.explode(buckets).alias("bucket"), inspection.alias("inspection"),
                     own(F.col("office_id")).alias("office_id"), own(F.col("st_description")).alias("inspection_type"),
                     own(date).alias("inspection_date"), bit.alias("bit"))
            .groupBy("customer_id", "bucket", "inspection", "office_id", "inspection_type", "inspection_date")
            .agg(F.count(F.lit(1)).alias("n"), F.bit_or("bit").alias("bits")))


def _inspections(appointments: DataFrame, service_types: DataFrame, days: int) -> DataFrame:
    """Inspections per customer, office, date and type (``n``) with the number of
    distinct days of a regular service in the ``days`` days after them.

    A join of inspections and services on the customer would compare every pair
    of them. Here both meet by (customer, 30-day bucket), where the services are
    one word of bits, so a bucket of a hot customer holds a row per date, office
    and type, and no pairs are made.
    """
    day, at = _day_number(F.col("inspection_date")), F.col("bucket") * _BUCKET_DAYS
    first = F.greatest(day + 1, at) - at
    last = F.least(day + days, at + _BUCKET_DAYS - 1) - at
    one = F.lit(1).cast("long")
    shift = lambda x, by: F.call_function("shiftleft", x, by.cast("int"))
    window = shift(shift(one, last - first + 1) - 1, first)
    seen = F.bit_or("bits").over(Window.partitionBy("customer_id", "bucket"))
    marks = _marks(appointments, service_types, days).withColumn("bits", seen).filter("inspection")
    hits = F.coalesce(F.bit_count(F.col("bits").bitwiseAND(window)), F.lit(0))
    return (marks.groupBy("customer_id", "office_id", "inspection_type", "inspection_date")
            .agg(F.max("n").alias("n"), F.sum(hits).alias("followups")))


def inspection_conversion(appointments: DataFrame, service_types: DataFrame, days: int = 90,
                          distinct: bool = False) -> DataFrame:
    """Inspections per month/office/type and how many converted to a regular
    service within ``days``.

    ``distinct=False`` keeps the original's fan-out: an inspection with k
    follow-up dates counts k times in both totals. ``distinct=True`` counts
    each inspection once.
    """
    j = _inspections(appointments, service_types, days)
    n, k = F.col("n"), F.col("followups")
    if distinct:
        total, conv = n, F.when(k > 0, n).otherwise(0)
    else:
        total, conv = n * F.greatest(k, F.lit(1)), n * k
    g = (j.groupBy(_month(F.col("inspection_date")).alias("month"), "office_id", "inspection_type")
         .agg(F.sum(total).alias("total_inspections"), F.sum(conv).alias("converted")))
    return g.select("month", "office_id", office_name(F.col("office_id")).alias("office_name"),
                    "inspection_type", "total_inspections", "converted",
                    ratio_pct(F.col("converted"), F.col("total_inspections")).alias("conversion_pct"))


# ---------------------------------------------------------------------------
# V9 — product usage
# ---------------------------------------------------------------------------

def _copies(df: DataFrame, n: str) -> DataFrame:
    """The different rows of ``df`` and how often each stands in it."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(n))


def chemical_usage(items: DataFrame, tickets: DataFrame, appointments: DataFrame,
                   employees: DataFrame, products: DataFrame) -> DataFrame:
    """Quantity and cost of products used, per month, office, tech and product.

    The invoice-date filter makes the ticket join inner, as in the original.
    Tickets meet their appointments first, so the items, the largest table,
    are shuffled once for the joins, as plain numbers. They are summed by ids,
    and only these sums meet the names: nearly every line may be a group of its
    own, and a task's memory is its groups times the width of their keys.
    Repeated rows of an employee or a product are joined once and multiply the
    sum instead, so a row with a product is a result as it is; the products
    without a row are one group, and are summed again. Unset ids (<= 0) match
    nothing: their items have no ticket, and a ticket without an appointment no
    tech.
    """
    ti = (items.filter((F.col("product_id") > 0) & (F.col("quantity") > 0) & (F.col("ticket_id") > 0))
          .select("ticket_id", "office_id", F.col("product_id").alias("ti_product_id"), "quantity", "amount"))
    t = (tickets.filter(F.col("invoice_date").isNotNull())
         .select(F.col("ticket_id").alias("t_ticket_id"), F.col("appointment_id").alias("t_appt_id"),
                 _month(F.col("invoice_date")).alias("month")))
    a = appointments.filter(F.col("appointment_id") > 0).select(F.col("appointment_id").alias("a_id"), "serviced_by_id")
    t = t.join(a, t["t_appt_id"] == a["a_id"], "left").select("t_ticket_id", "month", "serviced_by_id")
    used = (ti.join(t, ti["ticket_id"] == t["t_ticket_id"], "inner")
            .groupBy("month", "office_id", "serviced_by_id", "ti_product_id")
            .agg(sum_exact(F.col("quantity")).alias("_qty"), sum_exact(F.col("amount")).alias("_amt")))
    p = _copies(products.select(F.col("product_id"), F.col("description").alias("product_name"),
                                F.col("code").alias("product_code"), F.col("category").alias("product_category")), "p_n")
    known = used.join(p, used["ti_product_id"] == p["product_id"], "inner").drop("ti_product_id")
    ids = products.select(F.col("product_id").alias("p_id"))
    unknown = (used.join(ids, used["ti_product_id"] == ids["p_id"], "left_anti")
               .groupBy("month", "office_id", "serviced_by_id").agg(F.sum("_qty").alias("_qty"), F.sum("_amt").alias("_amt")))
    e = _copies(employees.select(F.col("employee_id").alias("e_id"),
                                 person_name(F.col("first_name"), F.col("last_name"), F.col("employee_id")).alias("e_name"),
                                 F.coalesce(F.col("initials"), F.lit("")).alias("e_initials")), "e_n")
    j = known.unionByName(unknown, allowMissingColumns=True).join(e, F.col("serviced_by_id") == F.col("e_id"), "left")
    n = F.coalesce(F.col("p_n"), F.lit(1)) * F.coalesce(F.col("e_n"), F.lit(1))
    times = lambda x: F.when(n == 1, x).otherwise(x.cast("decimal(26,8)") * n.cast("decimal(11,0)"))
    return j.select(
        "month", "office_id", office_name(F.col("office_id")).alias("office_name"),
        F.col("serviced_by_id").alias("employee_id"),
        F.coalesce(F.col("e_name"), F.col("serviced_by_id").cast("string")).alias("tech_name"),
        F.coalesce(F.col("e_initials"), F.lit("")).alias("initials"), "product_id", "product_name", "product_code",
        "product_category", from_units(rounded_units(times(F.col("_qty")), 3), 3).alias("total_quantity"),
        from_units(rounded_units(times(F.col("_amt")))).alias("total_cost"))


# ---------------------------------------------------------------------------
# V10 — route planning for the coming month
# ---------------------------------------------------------------------------

def route_analysis(appointments: DataFrame, tickets: DataFrame, employees: DataFrame,
                   customers: DataFrame, service_types: DataFrame, as_of,
                   office: int = OFFICE_COMMERCIAL, use_best_tech: bool = False) -> DataFrame:
    """Pending appointments of ``office`` in the calendar month after ``as_of``,
    ordered by route, date and sequence. ``use_best_tech`` attributes the job
    to the first non-zero of assigned and route tech instead of the raw
    assigned tech. A ticket without an id (<= 0) belongs to no appointment."""
    start = F.add_months(F.trunc(_date(as_of), "month"), 1)
    end = F.add_months(F.trunc(_date(as_of), "month"), 2)
    a = appointments.filter((F.col("office_id") == office) & (F.col("status") == STATUS_PENDING)
                            & (F.col("scheduled_date") >= start) & (F.col("scheduled_date") < end))
    tech = (F.coalesce(F.nullif(F.col("assigned_tech_id"), F.lit(0)), F.col("route_tech_id"))
            if use_best_tech else F.col("assigned_tech_id"))
    a = a.withColumn("_tech", tech)
    tk = tickets.filter(F.col("ticket_id") > 0).select(
        F.col("ticket_id").alias("tk_ticket_id"), F.col("total").alias("tk_total"),
        F.col("production_value").alias("tk_production"))
    j = a.join(tk, a["ticket_id"] == tk["tk_ticket_id"], "left")
    j = _with_tech(j, employees, "_tech")
    c = customers.select(F.col("customer_id").alias("c_id"), "company_name", "first_name",
                         "last_name", "address", "city", "zip")
    j = j.join(c, j["customer_id"] == c["c_id"], "left")
    st = dedup_service_types(service_types).select(F.col("type_id").alias("st_id"),
                                                   F.col("description").alias("service_type"))
    j = j.join(st, j["service_type_id"] == st["st_id"], "left")
    return (j.select(
        "scheduled_date", "route_id", "sequence", F.col("_tech").alias("employee_id"), "tech_name",
        "initials", "customer_id",
        customer_display_name(F.col("company_name"), F.col("first_name"), F.col("last_name"))
        .alias("customer_name"),
        "address", "city", "zip", "service_type", "duration_scheduled_min",
        production_value(F.col("tk_production"), F.col("tk_total")).alias("production_value"),
        F.col("tk_total").alias("revenue_value"), "appointment_id")
        .orderBy("route_id", "scheduled_date", "sequence"))
