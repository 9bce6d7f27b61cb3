"""Conform jobs: raw all-string records → typed star-schema rows.

One ``select`` per entity; every rule is a native column expression from
``fieldlake.functions.parse``, so a job is a single map-only stage (no
shuffle) except appointments, which join the small route→tech table.

Flags: the landing is all-string, so a JSON ``1`` and ``"1"`` look alike;
every flag is true exactly when the text is ``1`` (the looser of the two
source rules). ``loaded_at`` is the ``run_at`` parameter, never the clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlake.functions.codes import FREQUENCY_CUSTOM, INSPECTION_NAMES
from fieldlake.functions.parse import (
    flag, strict_timestamp, strip, to_date, to_float, to_int, to_timestamp, yes,
)


def _c(name: str) -> Column:
    return F.col(name)


def _stamp(run_at) -> Column:
    return F.lit(run_at).cast("timestamp").alias("loaded_at")


# ---------------------------------------------------------------------------
# C9, C10 — orphan filters
# ---------------------------------------------------------------------------

def _is_not_orphan(x: Column) -> Column:
    # A missing value counts as the orphan marker -1.
    return F.coalesce(x, F.lit("-1")) != F.lit("-1")


def real_records(raw: DataFrame) -> DataFrame:
    """Keep records whose officeID and customerID are both set and not -1."""
    return raw.filter(_is_not_orphan(_c("officeID")) & _is_not_orphan(_c("customerID")))


def real_office(raw: DataFrame) -> DataFrame:
    """Keep records whose officeID is set and not -1 (appointments, tickets)."""
    return raw.filter(_is_not_orphan(_c("officeID")))


# ---------------------------------------------------------------------------
# C1–C5 — dimensions
# ---------------------------------------------------------------------------

def conform_service_types(raw: DataFrame, run_at) -> DataFrame:
    """Description is kept as is (not stripped); is_inspection is an exact
    match against the five inspection names."""
    desc = F.coalesce(_c("description"), F.lit(""))
    return raw.select(
        to_int(_c("typeID"), 0).alias("type_id"),
        desc.alias("description"),
        to_int(_c("officeID"), -1).alias("office_id"),
        flag(_c("reservice")).alias("reservice"),
        flag(_c("initial")).alias("initial"),
        flag(_c("regularService")).alias("regular_service"),
        to_int(_c("frequency"), -1).alias("frequency"),
        to_int(_c("billingFrequency"), -1).alias("billing_frequency"),
        to_float(_c("defaultCharge"), 0).alias("default_charge"),
        F.coalesce(_c("category"), F.lit("")).alias("category"),
        desc.isin(*INSPECTION_NAMES).alias("is_inspection"),
        _stamp(run_at))


def conform_employees(raw: DataFrame, run_at) -> DataFrame:
    return raw.select(
        to_int(_c("employeeID"), 0).alias("employee_id"),
        strip(_c("fname")).alias("first_name"),
        strip(_c("lname")).alias("last_name"),
        strip(_c("nickname")).alias("nickname"),
        strip(_c("initials")).alias("initials"),
        to_int(_c("officeID"), -1).alias("office_id"),
        to_int(_c("type"), 0).alias("emp_type"),
        flag(_c("active")).alias("active"),
        strip(_c("email")).alias("email"),
        _stamp(run_at))


def conform_products(raw: DataFrame, run_at) -> DataFrame:
    return raw.select(
        to_int(_c("productID"), 0).alias("product_id"),
        strip(_c("description")).alias("description"),
        strip(_c("code")).alias("code"),
        strip(_c("category")).alias("category"),
        to_float(_c("amount"), 0).alias("unit_cost"),
        to_int(_c("officeID"), -1).alias("office_id"),
        flag(_c("taxable")).alias("taxable"),
        _stamp(run_at))


def conform_customers(raw: DataFrame, run_at, *extra: Column) -> DataFrame:
    """Email lower-cased; auto_pay is 'yes' in any case. ``extra`` columns of
    the raw record are kept at the end."""
    return raw.select(
        to_int(_c("customerID"), 0).alias("customer_id"),
        strip(_c("fname")).alias("first_name"),
        strip(_c("lname")).alias("last_name"),
        strip(_c("companyName")).alias("company_name"),
        F.lower(strip(_c("email"))).alias("email"),
        strip(_c("phone1")).alias("phone1"),
        strip(_c("address")).alias("address"),
        strip(_c("city")).alias("city"),
        strip(_c("state")).alias("state"),
        strip(_c("zip")).alias("zip"),
        to_int(_c("officeID"), -1).alias("office_id"),
        flag(_c("active")).alias("active"),
        flag(_c("commercialAccount")).alias("commercial_account"),
        to_date(_c("dateAdded")).alias("date_added"),
        to_date(_c("dateCancelled")).alias("date_cancelled"),
        strip(_c("source")).alias("source"),
        to_int(_c("billToAccountID"), 0).alias("bill_to_account_id"),
        yes(_c("aPay")).alias("auto_pay"),
        _stamp(run_at), *extra)


def subscription_frequency(raw_frequency: Column) -> Column:
    """'CUSTOM' in any case/spacing → -2 (flat monthly), else integer or 0."""
    return F.when(F.upper(strip(raw_frequency)) == F.lit("CUSTOM"), F.lit(FREQUENCY_CUSTOM).cast("long")) \
        .otherwise(to_int(raw_frequency, 0))


def conform_subscriptions(raw: DataFrame, run_at, *extra: Column) -> DataFrame:
    return raw.select(
        to_int(_c("subscriptionID"), 0).alias("subscription_id"),
        to_int(_c("customerID"), 0).alias("customer_id"),
        to_int(_c("officeID"), -1).alias("office_id"),
        to_int(_c("serviceID"), 0).alias("service_type_id"),
        strip(_c("serviceType")).alias("service_type"),
        to_float(_c("recurringCharge"), 0).alias("recurring_charge"),
        to_float(_c("initialCharge"), 0).alias("initial_charge"),
        subscription_frequency(_c("frequency")).alias("frequency"),
        to_date(_c("nextService")).alias("next_service"),
        to_date(_c("lastService")).alias("last_service"),
        to_date(_c("dateAdded")).alias("date_added"),
        to_date(_c("dateCancelled")).alias("date_cancelled"),
        flag(_c("active")).alias("active"),
        _stamp(run_at), *extra)


# ---------------------------------------------------------------------------
# C6 — appointments
# ---------------------------------------------------------------------------

def elapsed_minutes(time_in: Column, time_out: Column) -> Column:
    """Minutes between two strict 'YYYY-MM-DD HH:MM:SS' stamps (NULL if
    either does not parse)."""
    tin, tout = strict_timestamp(time_in), strict_timestamp(time_out)
    return (F.unix_timestamp(tout) - F.unix_timestamp(tin)) / 60.0


def plausible_duration(minutes: Column) -> Column:
    """Rounded to 2 places when 0 < minutes < 600 (a sanity bound), else NULL."""
    return F.when((minutes > 0) & (minutes < 600), F.round(minutes, 2))


def actual_duration(time_in: Column, time_out: Column) -> Column:
    """Minutes between two 'YYYY-MM-DD HH:MM:SS' stamps, rounded to 2 places,
    when both parse and 0 < minutes < 600; else NULL."""
    return plausible_duration(elapsed_minutes(time_in, time_out))


def additional_techs(x: Column) -> Column:
    """A JSON list lands as text such as '[3,4]': keep '3,4'; '[]' → NULL."""
    return F.nullif(F.regexp_replace(x, r'[\[\]" ]', ""), F.lit(""))


def conform_appointments(raw: DataFrame, run_at, *extra: Column, route_tech: DataFrame | None = None) -> DataFrame:
    """``extra`` columns of the raw record are kept at the end. Ids default to NULL (only the key defaults to 0). ``route_tech``
    (office_id, route_id, route_tech_id), one row per office and route, fills route_tech_id; it is a
    per-day route table, small next to the facts, and the planner broadcasts
    it only when its measured size allows."""
    df = raw.select(
        to_int(_c("appointmentID"), 0).alias("appointment_id"),
        to_int(_c("customerID")).alias("customer_id"),
        to_int(_c("subscriptionID")).alias("subscription_id"),
        to_int(_c("ticketID")).alias("ticket_id"),
        to_int(_c("officeID")).alias("office_id"),
        to_int(_c("routeID")).alias("route_id"),
        to_int(_c("sequence")).alias("sequence"),
        to_int(_c("assignedTech")).alias("assigned_tech_id"),
        to_int(_c("servicedBy")).alias("serviced_by_id"),
        additional_techs(_c("additionalTechs")).alias("additional_tech_ids"),
        to_int(_c("type")).alias("service_type_id"),
        to_date(_c("date")).alias("scheduled_date"),
        to_timestamp(_c("dateCompleted")).alias("date_completed"),
        to_timestamp(_c("timeIn")).alias("time_in"),
        to_timestamp(_c("timeOut")).alias("time_out"),
        to_int(_c("duration")).alias("duration_scheduled_min"),
        elapsed_minutes(_c("timeIn"), _c("timeOut")).alias("_minutes"),
        to_int(_c("status")).alias("status"),
        strip(_c("statusText")).alias("status_text"),
        flag(_c("isInitial")).alias("is_initial"),
        to_float(_c("productionValue")).alias("production_value"),
        to_float(_c("amountCollected")).alias("amount_collected"),
        to_int(_c("reserviceReasonID")).alias("reservice_reason_id"),
        to_float(_c("latIn")).alias("lat_in"),
        to_float(_c("longIn")).alias("lng_in"),
        to_float(_c("temperature")).alias("temperature"),
        to_float(_c("windSpeed")).alias("wind_speed"),
        strip(_c("windDirection")).alias("wind_direction"),
        to_timestamp(_c("dateAdded")).alias("date_added"),
        to_timestamp(_c("dateUpdated")).alias("date_updated"),
        _stamp(run_at), *extra)
    # minutes are computed once in the projection above; the bound check
    # reads the column instead of re-parsing both stamps three times
    df = df.withColumn("duration_actual_min", plausible_duration(F.col("_minutes"))).drop("_minutes")
    if route_tech is None:
        df = df.withColumn("route_tech_id", F.lit(None).cast("long"))
    else:
        df = df.join(route_tech.select("office_id", "route_id", "route_tech_id"), ["office_id", "route_id"], "left")
    from fieldlake.sources.schemas import STAR_SCHEMAS
    fixed = STAR_SCHEMAS["fact_appointments"].fieldNames()
    return df.select(*fixed, *[c for c in df.columns if c not in fixed])


# ---------------------------------------------------------------------------
# C7, C8 — tickets and their line items
# ---------------------------------------------------------------------------

def conform_tickets(raw: DataFrame, run_at, *extra: Column) -> DataFrame:
    """Money defaults to 0 — an empty production value becomes an explicit 0.
    ``extra`` columns of the raw record are kept at the end."""
    return raw.select(
        to_int(_c("ticketID"), 0).alias("ticket_id"),
        to_int(_c("appointmentID"), 0).alias("appointment_id"),
        to_int(_c("customerID"), 0).alias("customer_id"),
        to_int(_c("subscriptionID"), 0).alias("subscription_id"),
        to_int(_c("officeID"), -1).alias("office_id"),
        to_int(_c("serviceID"), 0).alias("service_id"),
        to_date(_c("invoiceDate")).alias("invoice_date"),
        to_timestamp(_c("dateCreated")).alias("date_created"),
        to_timestamp(_c("dateUpdated")).alias("date_updated"),
        to_float(_c("subTotal"), 0).alias("subtotal"),
        to_float(_c("taxAmount"), 0).alias("tax_amount"),
        to_float(_c("total"), 0).alias("total"),
        to_float(_c("balance"), 0).alias("balance"),
        to_float(_c("productionValue"), 0).alias("production_value"),
        flag(_c("active")).alias("active"),
        _stamp(run_at), *extra)


def explode_ticket_items(raw_tickets: DataFrame, run_at) -> DataFrame:
    """One row per line item; items inherit the ticket's id and office. A
    ticket without an ``items`` field, or a null in it, yields no rows."""
    t = raw_tickets.select(to_int(_c("ticketID"), 0).alias("ticket_id"),
                           to_int(_c("officeID"), -1).alias("office_id"),
                           F.explode(F.filter(_c("items"), lambda x: x.isNotNull())).alias("it"))
    return t.select(
        to_int(_c("it.itemID"), 0).alias("item_id"),
        "ticket_id", "office_id",
        strip(_c("it.description")).alias("description"),
        to_float(_c("it.quantity"), 0).alias("quantity"),
        to_float(_c("it.amount"), 0).alias("amount"),
        to_int(_c("it.productID"), 0).alias("product_id"),
        to_int(_c("it.serviceID"), 0).alias("service_id"),
        flag(_c("it.taxable")).alias("taxable"),
        _stamp(run_at))
