"""Deterministic mapping from the driver's TPC-H-like tables to our schemas.

Each fixture is declared once as SQL column expressions that are valid in
both Spark SQL and DuckDB. ``load(spark, sf_dir, name)`` renders it as a
DataFrame (``spark.read.parquet`` → filter → select of ``F.expr``), and
``cte(name)`` renders the same text as a CTE for the DuckDB oracle, so a
query and its oracle always see identical inputs.

Portability rules: ``||`` instead of concat, explicit CASTs, ``DATE + int``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

def _finer(amount: str, key: str, steps: int, places: int = 4) -> str:
    """An amount with more decimal places than cents, so that rounding a value
    before the sum, or a sum before the average, shows."""
    return f"{amount} + CAST({key} % {steps} AS DOUBLE) / {10 ** places}"


OFFICE_OF = "CASE WHEN {k} % 89 = 5 THEN 3 WHEN {k} % 6 = 0 THEN 2 ELSE 1 END"


def _office(k: str) -> str:
    return OFFICE_OF.format(k=k)


def _s(x: str) -> str:
    return f"CAST({x} AS STRING)"


@dataclass(frozen=True)
class Fixture:
    name: str
    source: str
    columns: tuple[tuple[str, str, str], ...]  # (name, expression, type)
    where: str | None = None
    join: tuple[str, str] | None = None  # (driver table, join condition)
    copies: tuple[str | None, ...] = (None,)  # UNION ALL of filtered copies


# ---------------------------------------------------------------------------
# Conformed star-schema fixtures (feed the views)
# ---------------------------------------------------------------------------

_SEGMENT_COMMERCIAL = "c_mktsegment IN ('BUILDING', 'MACHINERY')"

DIM_CUSTOMERS = Fixture("dim_customers", "customer", (
    ("customer_id", "c_custkey + 1", "BIGINT"),
    ("first_name", "'First' || " + _s("c_custkey"), "STRING"),
    ("last_name", "c_name", "STRING"),
    ("company_name", f"CASE WHEN {_SEGMENT_COMMERCIAL} THEN 'Co ' || {_s('c_custkey')} ELSE '' END", "STRING"),
    ("email", "'c' || " + _s("c_custkey") + " || '@x.com'", "STRING"),
    ("phone1", _s("7020000000 + c_custkey"), "STRING"),
    ("address", _s("c_custkey") + " || ' Main'", "STRING"),
    ("city", "'Las Vegas'", "STRING"),
    ("state", "'NV'", "STRING"),
    ("zip", "'89' || " + _s("100 + c_custkey % 100"), "STRING"),
    ("office_id", _office("c_custkey"), "BIGINT"),
    ("active", "c_custkey % 5 <> 0", "BOOLEAN"),
    ("commercial_account", _SEGMENT_COMMERCIAL, "BOOLEAN"),
    ("date_added", "CASE WHEN c_custkey % 41 = 7 THEN NULL "
                   "ELSE DATE '1995-01-01' + CAST((c_custkey * 37) % 2200 AS INT) END", "DATE"),
    ("date_cancelled", "CASE WHEN c_custkey % 5 = 0 THEN DATE '1995-01-01' + "
                       "CAST((c_custkey * 37) % 2200 + (c_custkey * 13) % 400 AS INT) END", "DATE"),
))

DIM_EMPLOYEES = Fixture("dim_employees", "supplier", (
    ("employee_id", "CASE WHEN s_suppkey % 10 = 3 THEN s_suppkey + 1000000001 ELSE s_suppkey + 1 END", "BIGINT"),
    ("first_name", "'Tech'", "STRING"),
    ("last_name", "s_name", "STRING"),
    ("initials", "CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE 'T' || " + _s("s_suppkey") + " END", "STRING"),
    ("office_id", _office("s_suppkey"), "BIGINT"),
    ("active", "TRUE", "BOOLEAN"),
))  # a tenth of the ids are moved away: their techs have no employee row

DIM_SERVICE_TYPES = Fixture("dim_service_types", "nation", (
    ("type_id", "n_nationkey + 1", "BIGINT"),
    ("description", "CASE n_nationkey WHEN 0 THEN 'Rodent Inspection' "
                    "WHEN 1 THEN 'Pigeon Inspection' WHEN 2 THEN 'Bed Bug Inspection' "
                    "WHEN 3 THEN 'Bed Bug Room Inspection' WHEN 4 THEN 'Pest Control Inspection' "
                    "ELSE 'Service ' || n_name END", "STRING"),
    ("office_id", "1", "BIGINT"),
    ("reservice", "n_nationkey % 7 = 6", "BOOLEAN"),
    ("regular_service", "n_nationkey % 3 <> 0", "BOOLEAN"),
    ("is_inspection", "n_nationkey < 5", "BOOLEAN"),
), copies=(None, "n_nationkey % 2 = 0"))

DIM_PRODUCTS = Fixture("dim_products", "part", (
    ("product_id", "CASE WHEN p_partkey % 50 = 0 THEN p_partkey + 1000000001 ELSE p_partkey + 1 END", "BIGINT"),
    ("description", "p_name", "STRING"),
    ("code", "p_brand", "STRING"),
    ("category", "p_type", "STRING"),
    ("unit_cost", "p_retailprice", "DOUBLE"),
))  # ids moved away: their items have no product row

DIM_SUBSCRIPTIONS = Fixture("dim_subscriptions", "orders", (
    ("subscription_id", "o_orderkey + 1", "BIGINT"),
    ("customer_id", "o_custkey + 1", "BIGINT"),
    ("office_id", _office("o_custkey"), "BIGINT"),
    ("service_type_id", "o_orderkey % 25 + 1", "BIGINT"),
    ("service_type", "'Service ' || n_name", "STRING"),
    ("recurring_charge", "CASE WHEN o_orderkey % 11 = 0 THEN 0 "
                         "ELSE " + _finer("25 + o_orderkey % 200 + CAST(0.5 AS DOUBLE)", "o_orderkey", 7, 3) + " END", "DOUBLE"),
    ("date_added", "CAST(o_orderdate AS DATE)", "DATE"),
    ("active", "o_orderkey % 4 <> 0 AND o_orderkey % 3 = 0", "BOOLEAN"),
), join=("nation", "n_nationkey = o_orderkey % 25"))

FACT_APPOINTMENTS = Fixture("fact_appointments", "orders", (
    ("appointment_id", "o_orderkey + 1", "BIGINT"),
    ("customer_id", "o_custkey + 1", "BIGINT"),
    ("ticket_id", "CASE WHEN o_orderkey % 31 = 0 THEN 0 ELSE o_orderkey + 1 END", "BIGINT"),
    ("office_id", _office("o_custkey"), "BIGINT"),
    ("route_id", "o_orderkey % 60 + 1", "BIGINT"),
    ("sequence", "o_orderkey % 12 + 1", "BIGINT"),
    ("assigned_tech_id", "CASE WHEN o_orderkey % 2 = 0 THEN 0 ELSE o_orderkey % 40 + 1 END", "BIGINT"),
    ("route_tech_id", "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE (o_orderkey % 60) % 40 + 1 END", "BIGINT"),
    ("serviced_by_id", "CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE o_orderkey % 40 + 1 END", "BIGINT"),
    ("service_type_id", "o_orderkey % 25 + 1", "BIGINT"),
    ("scheduled_date", "CAST(o_orderdate AS DATE)", "DATE"),
    ("duration_scheduled_min", "30 + (o_orderkey % 4) * 15", "BIGINT"),
    ("duration_actual_min", "CASE WHEN o_orderkey % 3 = 0 THEN NULL "
                            "ELSE " + _finer("o_orderkey % 640", "o_orderkey", 997, 3) + " END", "DOUBLE"),
    ("status", "CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 ELSE "
               "CASE WHEN o_orderkey % 4 = 0 THEN -1 WHEN o_orderkey % 4 = 1 THEN -2 ELSE 1 END END",
     "BIGINT"),
    ("reservice_reason_id", "CASE WHEN o_orderkey % 20 = 0 THEN 5 END", "BIGINT"),
))

FACT_TICKETS = Fixture("fact_tickets", "orders", (
    ("ticket_id", "o_orderkey + 1", "BIGINT"),
    ("appointment_id", "o_orderkey + 1", "BIGINT"),
    ("customer_id", "o_custkey + 1", "BIGINT"),
    ("office_id", _office("o_custkey"), "BIGINT"),
    ("invoice_date", "CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END", "DATE"),
    ("total", "CASE WHEN o_orderkey % 17 = 0 THEN 0 ELSE " + _finer("o_totalprice", "o_orderkey", 89) + " END", "DOUBLE"),
    ("balance", "CASE WHEN o_orderstatus = 'O' THEN " + _finer("o_totalprice", "o_orderkey", 83) +
                " WHEN o_orderkey % 19 = 0 THEN CAST(0.01 AS DOUBLE) ELSE 0 END", "DOUBLE"),
    ("production_value", "CASE WHEN o_orderkey % 13 = 0 THEN -1 WHEN o_orderkey % 29 = 0 THEN NULL "
                         "ELSE " + _finer("o_totalprice", "o_orderkey", 97) + " END", "DOUBLE"),
    ("active", "o_orderkey % 23 <> 0", "BOOLEAN"),
))

FACT_TICKET_ITEMS = Fixture("fact_ticket_items", "lineitem", (
    ("item_id", "l_orderkey * 10 + l_linenumber", "BIGINT"),
    ("ticket_id", "l_orderkey + 1", "BIGINT"),
    ("office_id", _office("o_custkey"), "BIGINT"),
    ("quantity", _finer("l_quantity", "l_orderkey", 13), "DOUBLE"),
    ("amount", _finer("l_extendedprice", "l_orderkey", 79), "DOUBLE"),
    ("product_id", "CASE WHEN l_linenumber = 7 THEN 0 ELSE l_partkey + 1 END", "BIGINT"),
), join=("orders", "o_orderkey = l_orderkey"))

# ---------------------------------------------------------------------------
# Raw (all-string) fixtures (feed the conform and contact jobs)
# ---------------------------------------------------------------------------

# Service names cycled by raw_subscriptions (k % 18); the blank one is ''.
RAW_SERVICE_NAMES = (
    "Rodent Inspection", "Rodent Baiting Program", "Termite Treatment",
    "Termite Treatment Wood", "Mosquito Plan", "Rodent Exclusion", "Rodent Cleanup",
    "Weed Control", "Pigeon Netting", "Bed Bug Heater Rental", "Bed Bug Treatment",
    "Deep Root Feeding", "Bee Removal", "General Pest Control", "Roach Special",
    "Free Estimate", "", "Actisol",
)


def _service_name_case(k: str) -> str:
    arms = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(RAW_SERVICE_NAMES))
    return f"CASE {k} % 18 {arms} END"


_PN = "lpad(" + _s("c_custkey % 10000") + ", 4, '0')"

RAW_SUBSCRIPTIONS = Fixture("raw_subscriptions", "orders", (
    ("subscriptionID", _s("o_orderkey + 1"), "STRING"),
    ("customerID", "CASE WHEN o_orderkey % 47 = 0 THEN '-1' WHEN o_orderkey % 101 = 0 THEN NULL "
                   "ELSE " + _s("o_custkey + 1") + " END", "STRING"),
    ("officeID", _s(_office("o_custkey")), "STRING"),
    ("serviceID", "CASE WHEN o_orderkey % 18 = 1 THEN '225' ELSE " + _s("o_orderkey % 25 + 1") + " END",
     "STRING"),
    ("serviceType", "' ' || " + _service_name_case("o_orderkey") + " || ' '", "STRING"),
    ("recurringCharge", "CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 13 = 0 THEN 'n/a' "
                        "ELSE " + _s("25 + o_orderkey % 200") + " || '.50' END", "STRING"),
    ("frequency", "CASE o_orderkey % 7 WHEN 0 THEN 'CUSTOM' WHEN 1 THEN ' custom ' WHEN 2 THEN '' "
                  "WHEN 3 THEN '1.0' WHEN 4 THEN NULL ELSE " + _s("o_orderkey % 90") + " END", "STRING"),
    ("nextService", "CASE o_orderkey % 5 WHEN 0 THEN '0000-00-00' WHEN 1 THEN '' WHEN 2 THEN NULL "
                    "ELSE " + _s("CAST(o_orderdate AS DATE)") + " || ' 08:00:00' END", "STRING"),
    ("active", "CASE WHEN o_orderkey % 5 = 0 THEN '0' ELSE '1' END", "STRING"),
    ("dateUpdated", _s("DATE '1999-12-01' + CAST(o_orderkey % 40 AS INT)") + " || ' 09:00:00'", "STRING"),
))

RAW_CUSTOMERS = Fixture("raw_customers", "customer", (
    ("customerID", _s("c_custkey + 1"), "STRING"),
    ("officeID", _s(_office("c_custkey")), "STRING"),
    ("fname", "'First' || " + _s("c_custkey"), "STRING"),
    ("lname", "' ' || c_name || ' '", "STRING"),
    ("companyName", f"CASE WHEN {_SEGMENT_COMMERCIAL} THEN ' Co ' || {_s('c_custkey')} ELSE '' END",
     "STRING"),
    ("address", "CASE WHEN c_custkey % 7 = 0 THEN ' ' ELSE " + _s("c_custkey") + " || ' Main' END",
     "STRING"),
    ("city", "CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE 'Las Vegas' END", "STRING"),
    ("state", "'NV'", "STRING"),
    ("zip", "'89' || " + _s("100 + c_custkey % 100"), "STRING"),
    ("phone1", f"CASE c_custkey % 6 WHEN 0 THEN '(702) 555-' || {_PN} "
               f"WHEN 1 THEN '1-702-555-' || {_PN} WHEN 2 THEN '555-' || {_PN} "
               f"WHEN 3 THEN '' WHEN 4 THEN NULL ELSE '+1 702 555 ' || {_PN} END", "STRING"),
    ("phone2", "CASE c_custkey % 6 WHEN 3 THEN '7025560000' WHEN 4 THEN 'none' ELSE '' END", "STRING"),
    ("email", "CASE c_custkey % 5 WHEN 0 THEN ' C' || " + _s("c_custkey") + " || '@X.com ' "
              "WHEN 1 THEN 'a' || " + _s("c_custkey") + " || '@x.com; b@x.com' WHEN 2 THEN '' "
              "WHEN 3 THEN NULL ELSE 'Fam' || " + _s("c_custkey % 50") + " || '@x.com' END", "STRING"),
    ("active", "CASE WHEN c_custkey % 5 = 0 THEN '0' ELSE '1' END", "STRING"),
    ("commercialAccount", f"CASE WHEN {_SEGMENT_COMMERCIAL} THEN '1' ELSE '0' END", "STRING"),
    ("dateUpdated", _s("DATE '1999-12-01' + CAST(c_custkey % 40 AS INT)") + " || ' 10:00:00'", "STRING"),
))

CRM_CONTACTS = Fixture("crm_contacts", "customer", (
    ("contact_id", "c_custkey + 100000", "BIGINT"),
    ("email", "CASE WHEN c_custkey % 3 <> 0 THEN 'z' || " + _s("c_custkey") + " || '@other.com' "
              "WHEN c_custkey % 2 = 0 THEN 'c' || " + _s("c_custkey") + " || '@x.com' END", "STRING"),
    ("phone", "CASE WHEN c_custkey % 3 = 0 THEN '+1702555' ELSE '+1888555' END || " + _PN, "STRING"),
    ("tags", "'vip,fr_inactive,svc_pest,fr_office1'", "STRING"),
))  # two thirds of the contacts match no customer

def _dec2(x: str) -> str:
    return _s(f"CAST({x} AS DECIMAL(12,2))")


_ODATE = _s("CAST(o_orderdate AS DATE)")

RAW_SERVICE_TYPES = Fixture("raw_service_types", "nation", (
    ("typeID", _s("n_nationkey + 1"), "STRING"),
    ("description", "CASE n_nationkey WHEN 0 THEN 'Rodent Inspection' "
                    "WHEN 1 THEN 'Pigeon Inspection' WHEN 2 THEN 'Bed Bug Inspection' "
                    "WHEN 3 THEN 'Bed Bug Room Inspection' WHEN 4 THEN 'Pest Control Inspection' "
                    "WHEN 22 THEN 'Rodent Inspection ' ELSE 'Service ' || n_name END", "STRING"),
    ("officeID", "CASE WHEN n_nationkey % 2 = 0 THEN '1' ELSE '2' END", "STRING"),
    ("reservice", "CASE WHEN n_nationkey % 7 = 6 THEN '1' ELSE '0' END", "STRING"),
    ("initial", "CASE WHEN n_nationkey % 4 = 0 THEN '1' WHEN n_nationkey % 4 = 1 THEN 'true' ELSE '0' END",
     "STRING"),
    ("regularService", "CASE WHEN n_nationkey % 3 <> 0 THEN '1' ELSE '0' END", "STRING"),
    ("frequency", "CASE n_nationkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'x' ELSE " + _s("n_nationkey * 10")
     + " END", "STRING"),
    ("billingFrequency", "CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE ' 30 ' END", "STRING"),
    ("defaultCharge", "CASE n_nationkey % 4 WHEN 1 THEN '' WHEN 2 THEN '1d' ELSE "
     + _s("n_nationkey") + " || '.5' END", "STRING"),
    ("category", "CASE WHEN n_nationkey % 2 = 0 THEN ' GENERAL ' END", "STRING"),
), copies=(None, "n_nationkey % 2 = 0"))

RAW_EMPLOYEES = Fixture("raw_employees", "supplier", (
    ("employeeID", "CASE WHEN s_suppkey % 17 = 16 THEN 'x' ELSE " + _s("s_suppkey + 1") + " END", "STRING"),
    ("fname", "CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE ' Tech ' END", "STRING"),
    ("lname", "s_name || '\t'", "STRING"),
    ("nickname", "''", "STRING"),
    ("initials", "CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE 'T' || " + _s("s_suppkey") + " END", "STRING"),
    ("officeID", _s(_office("s_suppkey")), "STRING"),
    ("type", "CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE '2' END", "STRING"),
    ("active", "CASE WHEN s_suppkey % 6 = 0 THEN '0' ELSE '1' END", "STRING"),
    ("email", "' T' || " + _s("s_suppkey") + " || '@Firm.com'", "STRING"),
))

RAW_PRODUCTS = Fixture("raw_products", "part", (
    ("productID", _s("p_partkey + 1"), "STRING"),
    ("description", "' ' || p_name", "STRING"),
    ("code", "p_brand", "STRING"),
    ("category", "CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_type END", "STRING"),
    ("amount", "CASE WHEN p_partkey % 10 = 0 THEN 'n/a' ELSE " + _dec2("p_retailprice") + " END", "STRING"),
    ("officeID", "CASE WHEN p_partkey % 8 = 0 THEN '' ELSE '1' END", "STRING"),
    ("taxable", "CASE WHEN p_partkey % 2 = 0 THEN '1' ELSE '0' END", "STRING"),
))

_STATUS = ("CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 ELSE "
           "CASE WHEN o_orderkey % 4 = 0 THEN -1 WHEN o_orderkey % 4 = 1 THEN -2 ELSE 1 END END")

RAW_APPOINTMENTS = Fixture("raw_appointments", "orders", (
    ("appointmentID", _s("o_orderkey + 1"), "STRING"),
    ("customerID", _s("o_custkey + 1"), "STRING"),
    ("subscriptionID", "CASE WHEN o_orderkey % 3 = 0 THEN " + _s("o_orderkey + 1") + " ELSE '' END", "STRING"),
    ("ticketID", "CASE WHEN o_orderkey % 31 = 0 THEN '0' ELSE " + _s("o_orderkey + 1") + " END", "STRING"),
    ("officeID", "CASE WHEN o_orderkey % 97 = 0 THEN '-1' ELSE " + _s(_office("o_custkey")) + " END", "STRING"),
    ("routeID", _s("o_orderkey % 60 + 1"), "STRING"),
    ("sequence", _s("o_orderkey % 12 + 1"), "STRING"),
    ("assignedTech", "CASE WHEN o_orderkey % 2 = 0 THEN '0' ELSE " + _s("o_orderkey % 40 + 1") + " END",
     "STRING"),
    ("servicedBy", "CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE " + _s("o_orderkey % 40 + 1") + " END",
     "STRING"),
    ("additionalTechs", "CASE o_orderkey % 4 WHEN 0 THEN '[3,4]' WHEN 1 THEN '[]' WHEN 2 THEN '7' END",
     "STRING"),
    ("type", _s("o_orderkey % 25 + 1"), "STRING"),
    ("date", _ODATE, "STRING"),
    ("dateCompleted", f"CASE WHEN o_orderstatus = 'F' THEN {_ODATE} || ' 17:00:00' "
                      "ELSE '0000-00-00 00:00:00' END", "STRING"),
    ("timeIn", f"CASE o_orderkey % 6 WHEN 0 THEN '0000-00-00 00:00:00' WHEN 5 THEN 'garbage' "
               f"ELSE {_ODATE} || ' 08:00:00' END", "STRING"),
    ("timeOut", f"CASE o_orderkey % 6 WHEN 1 THEN {_ODATE} || ' 07:30:00' "
                f"WHEN 2 THEN {_ODATE} || ' 19:00:00' WHEN 3 THEN {_ODATE} || ' 08:45:30' "
                f"WHEN 4 THEN {_ODATE} || ' 09:' || lpad({_s('o_orderkey % 60')}, 2, '0') || ':15' "
                f"ELSE {_ODATE} || ' 09:00:00' END", "STRING"),
    ("duration", _s("30 + (o_orderkey % 4) * 15"), "STRING"),
    ("status", _s(_STATUS), "STRING"),
    ("statusText", "CASE o_orderstatus WHEN 'F' THEN ' Completed ' ELSE 'Pending' END", "STRING"),
    ("isInitial", "CASE WHEN o_orderkey % 9 = 0 THEN '1' ELSE '0' END", "STRING"),
    ("productionValue", "CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE " + _dec2("o_totalprice") + " END",
     "STRING"),
    ("amountCollected", "CASE WHEN o_orderstatus = 'F' THEN " + _dec2("o_totalprice") + " ELSE '0' END",
     "STRING"),
    ("reserviceReasonID", "CASE WHEN o_orderkey % 20 = 0 THEN '5' ELSE '' END", "STRING"),
    ("latIn", "'36.17'", "STRING"),
    ("longIn", "'-115.14'", "STRING"),
    ("temperature", "CASE WHEN o_orderkey % 10 = 0 THEN 'n/a' ELSE '75.5' END", "STRING"),
    ("windSpeed", "''", "STRING"),
    ("windDirection", "' NW '", "STRING"),
    ("dateAdded", _ODATE + " || ' 07:00:00'", "STRING"),
    ("dateUpdated", _ODATE + " || ' 12:00:00'", "STRING"),
))

RAW_TICKETS = Fixture("raw_tickets", "orders", (
    ("ticketID", "CASE WHEN o_orderkey % 211 = 0 THEN '' ELSE " + _s("o_orderkey + 1") + " END", "STRING"),
    ("appointmentID", _s("o_orderkey + 1"), "STRING"),
    ("customerID", _s("o_custkey + 1"), "STRING"),
    ("subscriptionID", "''", "STRING"),
    ("officeID", "CASE WHEN o_orderkey % 97 = 0 THEN '-1' ELSE " + _s(_office("o_custkey")) + " END", "STRING"),
    ("serviceID", _s("o_orderkey % 25 + 1"), "STRING"),
    ("invoiceDate", "CASE WHEN o_orderkey % 53 = 0 THEN '0000-00-00' ELSE " + _ODATE + " END", "STRING"),
    ("dateCreated", _ODATE + " || ' 06:00:00'", "STRING"),
    ("dateUpdated", _ODATE + " || ' 18:00:00'", "STRING"),
    ("subTotal", _dec2("o_totalprice"), "STRING"),
    ("taxAmount", "'0.00'", "STRING"),
    ("total", "CASE WHEN o_orderkey % 17 = 0 THEN '' ELSE " + _dec2("o_totalprice") + " END", "STRING"),
    ("balance", "CASE WHEN o_orderstatus = 'O' THEN " + _dec2("o_totalprice") +
     " WHEN o_orderkey % 19 = 0 THEN '0.01' ELSE '0' END", "STRING"),
    ("productionValue", "CASE WHEN o_orderkey % 13 = 0 THEN '-1' WHEN o_orderkey % 29 = 0 THEN '' ELSE "
     + _dec2("o_totalprice") + " END", "STRING"),
    ("active", "CASE WHEN o_orderkey % 23 = 0 THEN '0' ELSE '1' END", "STRING"),
))

# Line items of a raw ticket (one row per lineitem; nested into the ticket's
# ``items`` array by ``load``). Tickets with o_orderkey % 10 = 9 carry no
# ``items`` field at all.
RAW_ITEMS = Fixture("raw_items", "lineitem", (
    ("l_orderkey", "l_orderkey", "BIGINT"),
    ("itemID", _s("l_orderkey * 10 + l_linenumber"), "STRING"),
    ("description", "' ' || l_returnflag || ' item '", "STRING"),
    ("quantity", _s("CAST(l_quantity AS BIGINT)"), "STRING"),
    ("amount", _dec2("l_extendedprice"), "STRING"),
    ("productID", "CASE WHEN l_linenumber = 7 THEN '' ELSE " + _s("l_partkey + 1") + " END", "STRING"),
    ("serviceID", "''", "STRING"),
    ("taxable", "CASE WHEN l_linenumber % 2 = 0 THEN '1' ELSE '0' END", "STRING"),
))
TICKETS_WITHOUT_ITEMS = "o_orderkey % 10 = 9"

RAW_ROUTES = Fixture("raw_routes", "orders", (
    ("routeID", _s("o_orderkey % 60 + 1"), "STRING"),
    ("officeID", _s(_office("o_custkey")), "STRING"),
    ("date", _ODATE, "STRING"),
    ("assignedTech", "CASE WHEN (o_orderkey % 60 + 1) % 5 = 0 THEN '0' "
                     "ELSE " + _s("(o_orderkey % 60 + 1) % 40 + 1") + " END", "STRING"),
))

FIXTURES: dict[str, Fixture] = {f.name: f for f in (
    DIM_CUSTOMERS, DIM_EMPLOYEES, DIM_SERVICE_TYPES, DIM_PRODUCTS, DIM_SUBSCRIPTIONS,
    FACT_APPOINTMENTS, FACT_TICKETS, FACT_TICKET_ITEMS,
    RAW_SUBSCRIPTIONS, RAW_CUSTOMERS, CRM_CONTACTS, RAW_SERVICE_TYPES, RAW_EMPLOYEES,
    RAW_PRODUCTS, RAW_APPOINTMENTS, RAW_TICKETS, RAW_ITEMS, RAW_ROUTES,
)}

# Dates used by the parameterised views (fixed values for the fixtures).
AS_OF_AGING = "2001-08-02"
AS_OF_ROUTES = "1999-12-15"


# Raw fixtures are padded to the entity's full landing schema: fields the
# fixture does not set arrive as NULL, as from the JSON reader.
RAW_ENTITY = {"raw_service_types": "serviceType", "raw_employees": "employee",
              "raw_products": "product", "raw_customers": "customer",
              "raw_subscriptions": "subscription", "raw_appointments": "appointment",
              "raw_tickets": "ticket", "raw_routes": "route"}


def _padded(fx: Fixture) -> tuple[tuple[str, str, str], ...]:
    entity = RAW_ENTITY.get(fx.name)
    if entity is None:
        return fx.columns
    from fieldlake.sources.schemas import RAW_FIELDS
    have = {c for c, _, _ in fx.columns}
    return fx.columns + tuple((f, "NULL", "STRING") for f in RAW_FIELDS[entity] if f not in have)


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Render fixture ``name`` from the driver tables under ``sf_dir``."""
    if name == "raw_tickets_nested":
        return _nested_tickets(spark, sf_dir)
    fx = FIXTURES[name]
    src = read_table(spark, sf_dir, fx.source)
    columns = _padded(fx)
    if name in RAW_ENTITY:
        # The driver's tables are single Parquet row groups, i.e. one scan
        # task. A real landing is many files; spreading the synthetic one
        # over the cores lets the per-row string parsing run in parallel.
        src = src.repartition(spark.sparkContext.defaultParallelism, src.columns[0])
    if fx.join:
        src = src.join(read_table(spark, sf_dir, fx.join[0]), F.expr(fx.join[1]), "inner")
    if fx.where:
        src = src.filter(F.expr(fx.where))
    cols = [F.expr(f"CAST({e} AS {t})").alias(c) for c, e, t in columns]
    parts = [(src if c is None else src.filter(F.expr(c))).select(cols) for c in fx.copies]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _nested_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_tickets with an ``items`` array of all-string structs, the shape the
    source API returns. Items are grouped per order (at most 7 lines each)."""
    from fieldlake.sources.schemas import RAW_ITEM_FIELDS
    # Lines and orders are shuffled as the numbers they are; the wide records
    # of strings are made after it.
    lines = read_table(spark, sf_dir, "lineitem").repartition("l_orderkey")
    items = (lines.select([F.expr(f"CAST({e} AS {t})").alias(c) for c, e, t in RAW_ITEMS.columns])
             .groupBy("l_orderkey").agg(F.collect_list(F.struct(*RAW_ITEM_FIELDS)).alias("items")))
    t = read_table(spark, sf_dir, "orders").join(items, F.expr("o_orderkey = l_orderkey"), "left")
    empty = F.array().cast(items.schema["items"].dataType)
    return t.select(*[F.expr(f"CAST({e} AS {k})").alias(c) for c, e, k in _padded(FIXTURES["raw_tickets"])],
                    F.when(~F.expr(TICKETS_WITHOUT_ITEMS), F.coalesce(F.col("items"), empty)).alias("items"))


def select_sql(name: str) -> str:
    """The fixture as one SELECT statement (DuckDB / Spark SQL)."""
    fx = FIXTURES[name]
    cols = ", ".join(f"CAST({e} AS {t}) AS {c}" for c, e, t in _padded(fx))
    src = fx.source + (f" JOIN {fx.join[0]} ON {fx.join[1]}" if fx.join else "")
    parts = []
    for copy in fx.copies:
        conds = [c for c in (fx.where, copy) if c]
        where = (" WHERE " + " AND ".join(f"({c})" for c in conds)) if conds else ""
        parts.append(f"SELECT {cols} FROM {src}{where}")
    return " UNION ALL ".join(parts)


def cte(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` prefix for an oracle query."""
    return "WITH " + ",\n".join(f"{n} AS ({select_sql(n)})" for n in names) + "\n"


def star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All eight conformed star-schema fixtures."""
    return {n: load(spark, sf_dir, n) for n in (
        "dim_customers", "dim_employees", "dim_service_types", "dim_products",
        "dim_subscriptions", "fact_appointments", "fact_tickets", "fact_ticket_items")}
