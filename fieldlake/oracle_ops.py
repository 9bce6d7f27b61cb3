"""DuckDB oracle SQL for the conform, load, contact, quality and pricing ops."""

from __future__ import annotations

from fieldlake.registry_ops import (
    ALL_DATES, BACKFILL_MONTHS, CALENDAR_AS_OF, CHANGED_AS_OF, CHANGED_DAYS, LEDGER_BEFORE, NIGHTLY, RUN_AT, WINDOW,
)
from fieldlake.sources.testdata import FIXTURES, TICKETS_WITHOUT_ITEMS, _office, cte, select_sql

# -- parse rules in SQL ------------------------------------------------------

# Rules and settings are stated here once more, not taken from the library.
WHITESPACE = "".join(map(chr, (*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)))
WHOLE = "[ \t]*[-+]?\\d+[ \t]*"
DECIMAL = "[ \t]*[-+]?(\\d+\\.?\\d*|\\.\\d+)([eE][-+]?\\d+)?[ \t]*"
TS_PATTERN = "^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"


def strip(x: str) -> str:
    return f"trim(COALESCE({x}, ''), '{WHITESPACE}')"


def to_int(x: str, default: str | None = None) -> str:
    v = f"CASE WHEN regexp_full_match({x}, '{WHOLE}') THEN TRY_CAST(trim({x}, ' \t') AS BIGINT) END"
    return v if default is None else f"COALESCE({v}, {default})"


def to_float(x: str, default: str | None = None) -> str:
    v = f"CASE WHEN regexp_full_match({x}, '{DECIMAL}') THEN TRY_CAST(trim({x}, ' \t') AS DOUBLE) END"
    return v if default is None else f"COALESCE({v}, CAST({default} AS DOUBLE))"


def to_date(x: str) -> str:
    return f"CASE WHEN NOT starts_with({x}, '0000') THEN TRY_CAST(substr({x}, 1, 10) AS DATE) END"


def to_ts(x: str) -> str:
    return f"CASE WHEN NOT starts_with({x}, '0000') THEN TRY_CAST(replace({x}, ' ', 'T') AS TIMESTAMP) END"


def strict_ts(x: str) -> str:
    s = f"substr({x}, 1, 19)"
    return (f"CASE WHEN regexp_matches({s}, '{TS_PATTERN}') AND NOT starts_with({x}, '0000') "
            f"THEN TRY_CAST(replace({s}, ' ', 'T') AS TIMESTAMP) END")


def flag(x: str) -> str:
    return f"COALESCE({x} = '1', FALSE)"


def not_orphan(x: str) -> str:
    return f"COALESCE({x}, '-1') <> '-1'"


# -- conform SELECT lists ------------------------------------------------------

INSPECTIONS = ("'Rodent Inspection', 'Pigeon Inspection', 'Bed Bug Inspection', "
               "'Bed Bug Room Inspection', 'Pest Control Inspection'")

SERVICE_TYPES_SQL = f"""SELECT {to_int('typeID', '0')} AS type_id, COALESCE(description, '') AS description,
 {to_int('officeID', '-1')} AS office_id, {flag('reservice')} AS reservice, {flag('initial')} AS initial,
 {flag('regularService')} AS regular_service, {to_int('frequency', '-1')} AS frequency,
 {to_int('billingFrequency', '-1')} AS billing_frequency, {to_float('defaultCharge', '0')} AS default_charge,
 COALESCE(category, '') AS category, COALESCE(description, '') IN ({INSPECTIONS}) AS is_inspection
FROM raw_service_types"""

EMPLOYEES_SQL = f"""SELECT {to_int('employeeID', '0')} AS employee_id, {strip('fname')} AS first_name,
 {strip('lname')} AS last_name, {strip('nickname')} AS nickname, {strip('initials')} AS initials,
 {to_int('officeID', '-1')} AS office_id, {to_int('type', '0')} AS emp_type, {flag('active')} AS active,
 {strip('email')} AS email FROM raw_employees"""

PRODUCTS_SQL = f"""SELECT {to_int('productID', '0')} AS product_id, {strip('description')} AS description,
 {strip('code')} AS code, {strip('category')} AS category, {to_float('amount', '0')} AS unit_cost,
 {to_int('officeID', '-1')} AS office_id, {flag('taxable')} AS taxable FROM raw_products"""

CUSTOMER_COLS = f"""{to_int('customerID', '0')} AS customer_id, {strip('fname')} AS first_name,
 {strip('lname')} AS last_name, {strip('companyName')} AS company_name, lower({strip('email')}) AS email,
 {strip('phone1')} AS phone1, {strip('address')} AS address, {strip('city')} AS city, {strip('state')} AS state,
 {strip('zip')} AS zip, {to_int('officeID', '-1')} AS office_id, {flag('active')} AS active,
 {flag('commercialAccount')} AS commercial_account, {to_date('dateAdded')} AS date_added,
 {to_date('dateCancelled')} AS date_cancelled, {strip('source')} AS source,
 {to_int('billToAccountID', '0')} AS bill_to_account_id,
 lower({strip("COALESCE(aPay, 'No')")}) = 'yes' AS auto_pay"""

SUBSCRIPTION_COLS = f"""{to_int('subscriptionID', '0')} AS subscription_id, {to_int('customerID', '0')} AS customer_id,
 {to_int('officeID', '-1')} AS office_id, {to_int('serviceID', '0')} AS service_type_id,
 {strip('serviceType')} AS service_type, {to_float('recurringCharge', '0')} AS recurring_charge,
 {to_float('initialCharge', '0')} AS initial_charge,
 CASE WHEN upper({strip('frequency')}) = 'CUSTOM' THEN -2 ELSE {to_int('frequency', '0')} END AS frequency,
 {to_date('nextService')} AS next_service, {to_date('lastService')} AS last_service,
 {to_date('dateAdded')} AS date_added, {to_date('dateCancelled')} AS date_cancelled,
 {flag('active')} AS active"""

_MIN = f"((epoch({strict_ts('timeOut')}) - epoch({strict_ts('timeIn')})) / 60.0)"

APPOINTMENT_COLS = f"""{to_int('appointmentID', '0')} AS appointment_id, {to_int('customerID')} AS customer_id,
 {to_int('subscriptionID')} AS subscription_id, {to_int('ticketID')} AS ticket_id,
 {to_int('officeID')} AS office_id, {to_int('routeID')} AS route_id, {to_int('sequence')} AS sequence,
 {to_int('assignedTech')} AS assigned_tech_id, rt.route_tech_id, {to_int('servicedBy')} AS serviced_by_id,
 NULLIF(regexp_replace(additionalTechs, '[\\[\\]" ]', '', 'g'), '') AS additional_tech_ids,
 {to_int('type')} AS service_type_id, {to_date('date')} AS scheduled_date,
 {to_ts('dateCompleted')} AS date_completed, {to_ts('timeIn')} AS time_in, {to_ts('timeOut')} AS time_out,
 {to_int('duration')} AS duration_scheduled_min,
 CASE WHEN {_MIN} > 0 AND {_MIN} < 600 THEN round({_MIN}, 2) END AS duration_actual_min,
 {to_int('status')} AS status, {strip('statusText')} AS status_text, {flag('isInitial')} AS is_initial,
 {to_float('productionValue')} AS production_value, {to_float('amountCollected')} AS amount_collected,
 {to_int('reserviceReasonID')} AS reservice_reason_id, {to_float('latIn')} AS lat_in,
 {to_float('longIn')} AS lng_in, {to_float('temperature')} AS temperature, {to_float('windSpeed')} AS wind_speed,
 {strip('windDirection')} AS wind_direction, {to_ts('dateAdded')} AS date_added,
 {to_ts('dateUpdated')} AS date_updated"""

TICKET_COLS = f"""{to_int('ticketID', '0')} AS ticket_id, {to_int('appointmentID', '0')} AS appointment_id,
 {to_int('customerID', '0')} AS customer_id, {to_int('subscriptionID', '0')} AS subscription_id,
 {to_int('officeID', '-1')} AS office_id, {to_int('serviceID', '0')} AS service_id,
 {to_date('invoiceDate')} AS invoice_date, {to_ts('dateCreated')} AS date_created,
 {to_ts('dateUpdated')} AS date_updated, {to_float('subTotal', '0')} AS subtotal,
 {to_float('taxAmount', '0')} AS tax_amount, {to_float('total', '0')} AS total,
 {to_float('balance', '0')} AS balance, {to_float('productionValue', '0')} AS production_value,
 {flag('active')} AS active"""


def route_tech_sql(start: str, end: str, office: int | None) -> str:
    of = f" AND {to_int('officeID')} = {office}" if office is not None else ""
    return f"""SELECT {to_int('officeID')} AS office_id, {to_int('routeID')} AS route_id, max({to_int('assignedTech')}) AS route_tech_id
FROM raw_routes WHERE {to_int('routeID')} IS NOT NULL AND COALESCE({to_int('assignedTech')} <> 0, FALSE)
 AND {to_date('date')} BETWEEN DATE '{start}' AND DATE '{end}'{of}
GROUP BY 1, 2"""


def conformed_appointments_ctes() -> str:
    return (cte("raw_appointments", "raw_routes")
            + f", rt AS ({route_tech_sql(ALL_DATES[0], ALL_DATES[1], None)}),\n"
            + f"conf_appts AS (SELECT {APPOINTMENT_COLS} FROM raw_appointments "
            + f"LEFT JOIN rt ON {to_int('routeID')} = rt.route_id AND {to_int('officeID')} = rt.office_id WHERE {not_orphan('officeID')})\n")


def _raw_item() -> tuple[dict[str, str], str, str]:
    """The raw item's columns, and its ticket's id and office."""
    cols = {c: f"CAST({e} AS {t})" for c, e, t in FIXTURES["raw_items"].columns}
    ticket = f"CAST(CASE WHEN o_orderkey % 211 = 0 THEN '' ELSE CAST(o_orderkey + 1 AS STRING) END AS STRING)"
    office = f"CAST(CASE WHEN o_orderkey % 97 = 0 THEN '-1' ELSE CAST({_office('o_custkey')} AS STRING) END AS STRING)"
    return cols, ticket, office


def _items_sql() -> str:
    cols, ticket, office = _raw_item()
    return f"""SELECT {to_int(cols['itemID'], '0')} AS item_id, {to_int(ticket, '0')} AS ticket_id,
 {to_int(office, '-1')} AS office_id, {strip(cols['description'])} AS description,
 {to_float(cols['quantity'], '0')} AS quantity, {to_float(cols['amount'], '0')} AS amount,
 {to_int(cols['productID'], '0')} AS product_id, {to_int(cols['serviceID'], '0')} AS service_id,
 {flag(cols['taxable'])} AS taxable
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
WHERE NOT ({TICKETS_WITHOUT_ITEMS}) AND {not_orphan(office)}"""


def _conform() -> dict[str, str]:
    q: dict[str, str] = {}
    q["conform_service_types"] = cte("raw_service_types") + SERVICE_TYPES_SQL
    q["conform_employees"] = cte("raw_employees") + EMPLOYEES_SQL
    q["conform_products"] = cte("raw_products") + PRODUCTS_SQL
    q["conform_customers"] = cte("raw_customers") + (
        f"SELECT {CUSTOMER_COLS} FROM raw_customers WHERE {not_orphan('officeID')} AND {not_orphan('customerID')}")
    q["conform_subscriptions"] = cte("raw_subscriptions") + (
        f"SELECT {SUBSCRIPTION_COLS} FROM raw_subscriptions "
        f"WHERE {not_orphan('officeID')} AND {not_orphan('customerID')}")
    q["conform_appointments"] = conformed_appointments_ctes() + "SELECT * FROM conf_appts"
    q["conform_tickets"] = cte("raw_tickets") + (
        f"SELECT {TICKET_COLS} FROM raw_tickets WHERE {not_orphan('officeID')}")
    q["ticket_items"] = _items_sql()
    q["real_records"] = cte("raw_subscriptions") + (
        f"SELECT * FROM raw_subscriptions WHERE {not_orphan('officeID')} AND {not_orphan('customerID')}")
    q["real_appointments"] = cte("raw_appointments") + (
        f"SELECT appointmentID, officeID, customerID FROM raw_appointments WHERE {not_orphan('officeID')}")
    return q


def _nightly() -> dict[str, str]:
    """One night from the star schema on: what each office brings, then each
    table without what it replaces."""
    as_of, days = NIGHTLY
    inside = f"scheduled_date BETWEEN DATE '{as_of[:10]}' - {days} AND DATE '{as_of[:10]}'"
    changed = f"{to_ts('dateUpdated')} >= TIMESTAMP '{as_of}' - INTERVAL {days} DAY"
    real = f"{not_orphan('officeID')} AND {not_orphan('customerID')}"

    def kept(table: str, new: str, key: str) -> str:
        return (f"FROM {table} x WHERE NOT EXISTS (SELECT 1 FROM {new} n "
                f"WHERE n.office_id = x.office_id AND n.{key} = x.{key})")

    night = cte("fact_appointments", "fact_tickets", "dim_customers", "dim_subscriptions", "fact_ticket_items",
                "raw_appointments", "raw_routes", "raw_tickets", "raw_customers", "raw_subscriptions",
                "raw_service_types", "raw_employees", "raw_products") + f""",
rt AS ({route_tech_sql('1999-12-11', '1999-12-31', None)}),
conf AS (SELECT {APPOINTMENT_COLS} FROM raw_appointments
  LEFT JOIN rt ON {to_int('routeID')} = rt.route_id AND {to_int('officeID')} = rt.office_id
  WHERE {to_int('officeID')} IN (1, 2, 3)),
held AS (SELECT office_id, appointment_id FROM fact_appointments WHERE {inside}),
new_a AS (SELECT * FROM conf c WHERE ({inside} AND COALESCE(status, 0) NOT IN (-1, -2))
  OR EXISTS (SELECT 1 FROM held h WHERE h.office_id = c.office_id AND h.appointment_id = c.appointment_id)),
a AS (SELECT office_id, appointment_id, ticket_id, status, route_tech_id, scheduled_date
  FROM (SELECT x.* {kept('fact_appointments', 'new_a', 'appointment_id')})
  WHERE NOT COALESCE({inside} AND office_id IN (SELECT office_id FROM new_a), FALSE)
  UNION ALL SELECT office_id, appointment_id, ticket_id, status, route_tech_id, scheduled_date FROM new_a),
asked AS (SELECT DISTINCT office_id, ticket_id FROM a WHERE {inside} AND ticket_id > 0 AND office_id IN (1, 2, 3)),
new_t AS (SELECT t.* FROM (SELECT {TICKET_COLS} FROM raw_tickets) t
  JOIN asked ON asked.office_id = t.office_id AND asked.ticket_id = t.ticket_id),
replaced AS (SELECT * FROM asked WHERE office_id IN (SELECT office_id FROM new_t)),
new_i AS (SELECT i.* FROM ({_items_sql()}) i
  JOIN replaced r ON r.office_id = i.office_id AND r.ticket_id = i.ticket_id),
new_c AS (SELECT {CUSTOMER_COLS} FROM raw_customers WHERE {changed} AND {real}),
new_s AS (SELECT {SUBSCRIPTION_COLS} FROM raw_subscriptions WHERE {changed} AND {real} AND officeID IN ('1', '2'))
"""
    q = {}
    items = "office_id, ticket_id, item_id, product_id, amount"
    q["nightly_sync"] = night + f"""
SELECT 'fact_appointments' AS table_name, office_id, appointment_id AS id, ticket_id AS other_id, status AS number,
  CAST(route_tech_id AS DOUBLE) AS amount, scheduled_date AS day FROM a
UNION ALL SELECT 'fact_tickets', office_id, ticket_id, appointment_id, customer_id, total, invoice_date FROM (
  SELECT office_id, ticket_id, appointment_id, customer_id, total, invoice_date {kept('fact_tickets', 'replaced', 'ticket_id')}
  UNION ALL SELECT office_id, ticket_id, appointment_id, customer_id, total, invoice_date FROM new_t)
UNION ALL SELECT 'fact_ticket_items', {items}, NULL FROM (
  SELECT {items} {kept('fact_ticket_items', 'replaced', 'ticket_id')} UNION ALL SELECT {items} FROM new_i)
UNION ALL SELECT 'dim_customers', office_id, customer_id, NULL, CAST(active AS BIGINT), NULL, date_added FROM (
  SELECT office_id, customer_id, active, date_added {kept('dim_customers', 'new_c', 'customer_id')}
  UNION ALL SELECT office_id, customer_id, active, date_added FROM new_c)
UNION ALL SELECT 'dim_subscriptions', * FROM (
  SELECT office_id, subscription_id, customer_id, service_type_id, recurring_charge, date_added
  {kept('dim_subscriptions', 'new_s', 'subscription_id')}
  UNION ALL SELECT office_id, subscription_id, customer_id, service_type_id, recurring_charge, date_added FROM new_s)
UNION ALL SELECT 'dim_service_types', office_id, type_id, NULL, frequency, default_charge, NULL
  FROM ({SERVICE_TYPES_SQL}) WHERE office_id IN (1, 2, 3)
UNION ALL SELECT 'dim_employees', office_id, employee_id, NULL, emp_type, NULL, NULL
  FROM ({EMPLOYEES_SQL}) WHERE office_id IN (1, 2, 3)
UNION ALL SELECT 'dim_products', office_id, product_id, NULL, CAST(taxable AS BIGINT), unit_cost, NULL
  FROM ({PRODUCTS_SQL}) WHERE office_id IN (1, 2, 3)"""
    count = lambda t: f"(SELECT COUNT(*) FROM {t} WHERE {t}.office_id = o)"
    q["nightly_health"] = night + f"""
SELECT TIMESTAMP '{RUN_AT}' AS run_at, CAST(o AS BIGINT) AS office_id,
  CASE WHEN o = 1 THEN 'Residential' ELSE 'Commercial' END AS office_name,
  CASE WHEN o = 3 THEN 'error' ELSE 'success' END AS status,
  CASE WHEN o = 3 THEN 'subscription search failed' END AS error_message, CAST({days} AS BIGINT) AS lookback_days,
  {count('new_a')} AS appointments_synced, {count('new_t')} AS tickets_synced,
  {count('new_i')} AS ticket_items_synced, {count('new_c')} AS customers_synced,
  {count('new_s')} AS subscriptions_synced FROM (VALUES (1), (2), (3)) AS v(o)"""
    item = {"int": "itemID productID serviceID", "float": "quantity amount"}
    cols, ticket, office = _raw_item()
    fetched = {
        "route": "SELECT * FROM raw_routes",
        "appointment": f"""SELECT * FROM raw_appointments r WHERE ({to_date('date')} BETWEEN DATE '{as_of[:10]}' - {days}
  AND DATE '{as_of[:10]}' AND COALESCE({to_int('status')}, 0) NOT IN (-1, -2)) OR EXISTS (SELECT 1 FROM held h
  WHERE h.office_id = {to_int('r.officeID')} AND h.appointment_id = {to_int('r.appointmentID')})""",
        "ticket": f"""SELECT * FROM raw_tickets r WHERE EXISTS (SELECT 1 FROM asked
  WHERE asked.office_id = {to_int('r.officeID')} AND asked.ticket_id = {to_int('r.ticketID')})""",
        "ticketItem": f"""SELECT {office} AS officeID, {', '.join(f"{cols[c]} AS {c}" for c in ' '.join(item.values()).split())}
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN replaced r
  ON r.office_id = {to_int(office)} AND r.ticket_id = {to_int(ticket, '0')} WHERE NOT ({TICKETS_WITHOUT_ITEMS})""",
        "customer": f"SELECT * FROM raw_customers WHERE {changed} AND {real}",
        "subscription": f"SELECT * FROM raw_subscriptions WHERE {changed} AND {real}"}
    parts = []
    for entity, rows in fetched.items():
        rules = [(f, k) for k, fields in TYPED.get(entity, item).items() for f in fields.split()]
        night += f""", {entity}_rows AS ({rows}),
{entity}_counts AS (SELECT o AS office_id, COUNT(x.officeID) AS records, {', '.join(f"{_reject(f, k)}" for f, k in rules)}
  FROM (VALUES (1), (2), (3)) v(o) LEFT JOIN {entity}_rows x ON {to_int('x.officeID')} = o GROUP BY 1)"""
        parts.append(f"""SELECT office_id, '{entity}' AS entity, field, records, rejects FROM (
  UNPIVOT {entity}_counts ON {', '.join(f for f, _ in rules)} INTO NAME field VALUE rejects)"""
                     + {"subscription": " WHERE office_id <> 3",
                        "ticketItem": " WHERE office_id IN (SELECT office_id FROM replaced)"}.get(entity, ""))
    q["nightly_rejects"] = night + f"""
SELECT TIMESTAMP '{RUN_AT}' AS run_at, CAST(office_id AS BIGINT) AS office_id, entity, field,
  CAST(records AS BIGINT) AS records, CAST(rejects AS BIGINT) AS rejects FROM ({' UNION ALL '.join(parts)})"""
    return q


def _backfilled() -> dict[str, str]:
    """The history of offices 1 and 2 loaded at once."""
    own = "office_id IN (1, 2)"
    month = "CAST(date_trunc('month', scheduled_date) AS DATE)"
    base = cte("raw_appointments", "raw_tickets", "raw_customers", "raw_subscriptions", "raw_service_types",
               "raw_employees", "raw_products") + f""",
rt AS (SELECT CAST(NULL AS BIGINT) AS route_tech_id),
a AS (SELECT *, {month} AS month_start FROM (SELECT {APPOINTMENT_COLS} FROM raw_appointments, rt)
  WHERE {own} AND {month} BETWEEN DATE '1994-12-01' AND DATE '1999-12-01'),
asked AS (SELECT DISTINCT office_id, month_start, ticket_id FROM a WHERE ticket_id > 0),
t AS (SELECT * FROM (SELECT {TICKET_COLS} FROM raw_tickets) x
  WHERE EXISTS (SELECT 1 FROM asked WHERE asked.office_id = x.office_id AND asked.ticket_id = x.ticket_id)),
i AS (SELECT * FROM ({_items_sql()}) x
  WHERE EXISTS (SELECT 1 FROM asked WHERE asked.office_id = x.office_id AND asked.ticket_id = x.ticket_id))
"""
    real = f"{not_orphan('officeID')} AND {not_orphan('customerID')}"
    q = {"backfill_run": base + f"""
SELECT 'fact_appointments' AS table_name, office_id, appointment_id AS id, ticket_id AS other_id, status AS number,
  CAST(route_tech_id AS DOUBLE) AS amount, scheduled_date AS day FROM a
UNION ALL SELECT 'fact_tickets', office_id, ticket_id, appointment_id, customer_id, total, invoice_date FROM t
UNION ALL SELECT 'fact_ticket_items', office_id, ticket_id, item_id, product_id, amount, NULL FROM i
UNION ALL SELECT 'dim_customers', office_id, customer_id, NULL, CAST(active AS BIGINT), NULL, date_added
  FROM (SELECT {CUSTOMER_COLS} FROM raw_customers WHERE {real}) WHERE {own}
UNION ALL SELECT 'dim_subscriptions', office_id, subscription_id, customer_id, service_type_id, recurring_charge, date_added
  FROM (SELECT {SUBSCRIPTION_COLS} FROM raw_subscriptions WHERE {real}) WHERE {own}
UNION ALL SELECT 'dim_service_types', office_id, type_id, NULL, frequency, default_charge, NULL
  FROM ({SERVICE_TYPES_SQL}) WHERE {own}
UNION ALL SELECT 'dim_employees', office_id, employee_id, NULL, emp_type, NULL, NULL FROM ({EMPLOYEES_SQL}) WHERE {own}
UNION ALL SELECT 'dim_products', office_id, product_id, NULL, CAST(taxable AS BIGINT), unit_cost, NULL
  FROM ({PRODUCTS_SQL}) WHERE {own}"""}
    slot = "x.office_id = o AND x.month_start = m"
    per_slot = lambda rows: (f"(SELECT COUNT(*) FROM asked x JOIN {rows} r ON r.office_id = x.office_id "  # noqa: E731
                             f"AND r.ticket_id = x.ticket_id WHERE {slot})")
    q["backfill_ledger"] = base + f"""
SELECT 'slot' AS kind, o AS office_id, m AS month_start, (SELECT COUNT(*) FROM a x WHERE {slot}) AS appointments,
  {per_slot('t')} AS tickets, {per_slot('i')} AS ticket_items, TIMESTAMP '{RUN_AT}' AS run_at
FROM (SELECT CAST(g AS DATE) AS m FROM generate_series(TIMESTAMP '1994-12-01', TIMESTAMP '1999-12-01', INTERVAL 1 MONTH) AS s(g)),
  (VALUES (CAST(1 AS BIGINT)), (CAST(2 AS BIGINT))) AS offs(o)
UNION ALL SELECT 'dims', NULL, NULL, NULL, NULL, NULL, TIMESTAMP '{RUN_AT}'"""
    return q


def _load() -> dict[str, str]:
    q: dict[str, str] = {}
    office, start, end = WINDOW
    in_win = (f"COALESCE(office_id = {office} AND scheduled_date BETWEEN DATE '{start}' AND DATE '{end}', FALSE)")
    fa_cols = ", ".join(c for c, _, _ in FIXTURES["fact_appointments"].columns)
    incoming = (f"incoming AS (SELECT * REPLACE (CASE WHEN appointment_id % 7 = 0 THEN CAST(-1 AS BIGINT) "
                f"ELSE status END AS status) FROM fact_appointments WHERE office_id = {office} "
                f"AND scheduled_date BETWEEN DATE '{start}' AND DATE '{end}' AND appointment_id % 10 <> 0)")
    q["replace_window"] = cte("fact_appointments") + f""", {incoming}
SELECT {fa_cols} FROM fact_appointments a WHERE NOT {in_win}
  AND NOT EXISTS (SELECT 1 FROM incoming i WHERE i.office_id = a.office_id AND i.appointment_id = a.appointment_id)
UNION ALL SELECT {fa_cols} FROM incoming"""
    q["vanished_ids"] = cte("fact_appointments") + f""", {incoming}
SELECT DISTINCT office_id, appointment_id FROM fact_appointments WHERE {in_win}
  AND (office_id, appointment_id) NOT IN (SELECT (office_id, appointment_id) FROM incoming)"""
    q["vanished_refetch"] = conformed_appointments_ctes() + f""", {select_sql('fact_appointments')
        .join(['fa AS (', ')'])}, {incoming.replace('FROM fact_appointments', 'FROM fa')},
gone AS (SELECT DISTINCT office_id, appointment_id FROM fa WHERE {in_win}
  AND (office_id, appointment_id) NOT IN (SELECT (office_id, appointment_id) FROM incoming))
SELECT appointment_id, office_id, scheduled_date, status, ticket_id FROM conf_appts c
WHERE EXISTS (SELECT 1 FROM gone g WHERE g.office_id = c.office_id AND g.appointment_id = c.appointment_id)"""
    tickets_in_win = (f"SELECT DISTINCT office_id, ticket_id FROM fact_appointments WHERE {in_win} AND ticket_id > 0")
    q["window_ticket_ids"] = cte("fact_appointments") + tickets_in_win
    fi_cols = ", ".join(c for c, _, _ in FIXTURES["fact_ticket_items"].columns)
    q["replace_children"] = cte("fact_appointments", "fact_ticket_items") + f""", parents AS ({tickets_in_win})
SELECT {fi_cols} FROM fact_ticket_items i WHERE NOT EXISTS (
  SELECT 1 FROM parents p WHERE p.office_id = i.office_id AND p.ticket_id = i.ticket_id)
UNION ALL
SELECT * REPLACE (quantity + 1 AS quantity) FROM fact_ticket_items i
WHERE EXISTS (SELECT 1 FROM parents p WHERE p.office_id = i.office_id AND p.ticket_id = i.ticket_id)
  AND item_id % 10 <> 1"""
    dc_cols = ", ".join(c for c, _, _ in FIXTURES["dim_customers"].columns)
    changed = (f"{to_ts('dateUpdated')} >= TIMESTAMP '{CHANGED_AS_OF}' - INTERVAL {CHANGED_DAYS} DAY")
    q["replace_by_id"] = cte("dim_customers", "raw_customers") + f""", incoming AS (
  SELECT {dc_cols} FROM (SELECT {CUSTOMER_COLS} FROM raw_customers
  WHERE {changed} AND {not_orphan('officeID')} AND {not_orphan('customerID')}))
SELECT {dc_cols} FROM dim_customers c WHERE NOT EXISTS (
  SELECT 1 FROM incoming i WHERE i.office_id = c.office_id AND i.customer_id = c.customer_id)
UNION ALL SELECT * FROM incoming"""
    q["route_tech"] = cte("raw_routes") + route_tech_sql(start, end, office)
    q["best_tech"] = cte("fact_appointments") + (
        "SELECT appointment_id, assigned_tech_id, route_tech_id, "
        "COALESCE(NULLIF(assigned_tech_id, 0), route_tech_id) AS best_tech_id FROM fact_appointments")
    q["changed_since"] = cte("raw_customers") + f"SELECT customerID, dateUpdated FROM raw_customers WHERE {changed}"
    m = "CAST(date_trunc('month', scheduled_date) AS DATE)"
    q["backfill_month"] = conformed_appointments_ctes().replace("WITH ", "WITH ", 1) + f""", fa AS (
  {select_sql('fact_appointments')}),
inc AS (SELECT {fa_cols} FROM conf_appts),
parts AS (SELECT DISTINCT office_id, {m} AS month FROM inc
  WHERE scheduled_date IS NOT NULL AND {m} BETWEEN DATE '{BACKFILL_MONTHS[0]}' AND DATE '{BACKFILL_MONTHS[1]}')
SELECT {fa_cols} FROM fa WHERE NOT EXISTS (SELECT 1 FROM parts p WHERE p.office_id = fa.office_id AND p.month = {m})
UNION ALL
SELECT {fa_cols} FROM inc WHERE EXISTS (SELECT 1 FROM parts p WHERE p.office_id = inc.office_id AND p.month = {m})"""
    win = f"BETWEEN DATE '{start}' AND DATE '{end}'"
    q["sync_summary"] = cte("fact_appointments", "fact_tickets", "fact_ticket_items", "dim_customers",
                            "dim_subscriptions") + f""",
a AS (SELECT office_id FROM fact_appointments WHERE scheduled_date {win}),
t AS (SELECT office_id, ticket_id FROM fact_tickets WHERE invoice_date {win}),
i AS (SELECT office_id FROM fact_ticket_items WHERE ticket_id IN (SELECT ticket_id FROM t)),
c AS (SELECT office_id FROM dim_customers WHERE date_added {win}),
s AS (SELECT office_id FROM dim_subscriptions WHERE date_added {win}),
o AS (SELECT DISTINCT office_id FROM dim_customers),
n AS (SELECT o.office_id,
  (SELECT COUNT(*) FROM a WHERE a.office_id = o.office_id) AS na,
  (SELECT COUNT(*) FROM t WHERE t.office_id = o.office_id) AS nt,
  (SELECT COUNT(*) FROM i WHERE i.office_id = o.office_id) AS ni,
  (SELECT COUNT(*) FROM c WHERE c.office_id = o.office_id) AS nc,
  (SELECT COUNT(*) FROM s WHERE s.office_id = o.office_id) AS ns FROM o)
SELECT TIMESTAMP '{RUN_AT}' AS run_at, office_id,
  CASE WHEN office_id = 1 THEN 'Residential' ELSE 'Commercial' END AS office_name,
  CASE WHEN office_id = 2 THEN 'error' ELSE 'success' END AS status,
  CASE WHEN office_id = 2 THEN 'route search failed' END AS error_message,
  CAST(2 AS BIGINT) AS lookback_days,
  na AS appointments_synced, nt AS tickets_synced, ni AS ticket_items_synced,
  nc AS customers_synced, ns AS subscriptions_synced
FROM n"""
    q["sync_health"] = body = q["sync_summary"]
    q["load_window"] = q["replace_window"]
    cut = body.rindex("SELECT TIMESTAMP")
    q["sync_totals"] = body[:cut] + ", health AS (" + body[cut:] + """)
SELECT CAST(SUM(appointments_synced) AS BIGINT) AS appointments_synced,
  CAST(SUM(tickets_synced) AS BIGINT) AS tickets_synced,
  CAST(SUM(ticket_items_synced) AS BIGINT) AS ticket_items_synced,
  CAST(SUM(customers_synced) AS BIGINT) AS customers_synced,
  CAST(SUM(subscriptions_synced) AS BIGINT) AS subscriptions_synced,
  CAST(COUNT_IF(status = 'error') AS BIGINT) AS failed_offices, COUNT(*) AS offices FROM health"""
    q["backfill_pending"] = cte("fact_appointments") + f"""
SELECT CAST(year(m) AS BIGINT) AS year, CAST(month(m) AS BIGINT) AS month, o AS office_id, CAST(m AS DATE) AS month_start,
  last_day(CAST(m AS DATE)) AS month_end, strftime(m, '%Y-%m') || '-office' || o AS month_key
FROM generate_series(TIMESTAMP '1994-12-01', TIMESTAMP '1999-12-01', INTERVAL 1 MONTH) AS g(m),
  (VALUES (CAST(1 AS BIGINT)), (CAST(2 AS BIGINT))) AS offs(o)
WHERE NOT EXISTS (SELECT 1 FROM fact_appointments a WHERE a.office_id = o AND a.scheduled_date < DATE '{LEDGER_BEFORE}'
  AND date_trunc('month', a.scheduled_date) = m)"""
    y5 = f"make_date(year(DATE '{CALENDAR_AS_OF}') - 5, month(DATE '{CALENDAR_AS_OF}'), 1)"
    q["backfill_progress"] = cte("fact_appointments") + f""",
cal AS (SELECT CAST(m AS DATE) AS month_start, o AS office_id
  FROM unnest(generate_series(CAST({y5} AS TIMESTAMP),
       CAST(date_trunc('month', DATE '{CALENDAR_AS_OF}') AS TIMESTAMP), INTERVAL 1 MONTH)) AS g(m),
       (VALUES (1), (2)) AS offs(o)),
done AS (SELECT DISTINCT office_id, {m} AS month_start FROM fact_appointments WHERE scheduled_date IS NOT NULL),
j AS (SELECT cal.*, d.office_id IS NOT NULL AS is_done FROM cal LEFT JOIN done d
  ON d.office_id = cal.office_id AND d.month_start = cal.month_start),
g AS (SELECT COUNT(*) AS total_slots, CAST(COUNT_IF(is_done) AS BIGINT) AS done_slots,
  min(month_start) AS first_month, max(month_start) AS last_month FROM j)
SELECT first_month, last_month, done_slots, total_slots,
  CAST((2 * done_slots * 100 + total_slots) // (2 * total_slots) AS BIGINT) AS pct_done,
  total_slots - done_slots AS remaining_slots, (total_slots - done_slots) * 2 AS est_minutes FROM g"""
    return q


# -- contacts ----------------------------------------------------------------------

def e164(x: str) -> str:
    d = f"regexp_replace(COALESCE({x}, ''), '[^0-9]', '', 'g')"
    return (f"CASE WHEN length({d}) = 10 THEN '+1' || {d} "
            f"WHEN length({d}) = 11 AND starts_with({d}, '1') THEN '+' || {d} END")


PHONE = f"COALESCE({e164('phone1')}, {e164('phone2')})"
EMAIL_DAILY = f"NULLIF(lower({strip('email')}), '')"
PENDING = ",\npending"
_FIRST_EMAIL = f"regexp_split_to_array({strip('email')}, '[;,]')[1]"
EMAIL_IMPORT = f"NULLIF(lower({strip(_FIRST_EMAIL)}), '')"
REAL = f"{not_orphan('officeID')} AND {not_orphan('customerID')}"
SEGMENT = "CASE WHEN COALESCE(commercialAccount, '0') = '1' THEN 'fr_commercial' ELSE 'fr_residential' END"


def daily_tags(office: int) -> str:
    return (f"['fr_office{office}', CASE WHEN COALESCE(active, '0') = '1' THEN 'fr_active' "
            f"ELSE 'fr_inactive' END, {SEGMENT}]")


def of_office(office: int) -> str:
    return f"(NOT ({not_orphan('officeID')}) OR officeID = '{office}')"


def blank_null(x: str) -> str:
    return f"NULLIF({strip(x)}, '')"


def _sub_active(x: str) -> str:
    text = strip(f"COALESCE({x}, '0')")
    return f"lower({text}) IN ('1', 'true')"


def _tag_case() -> str:
    n = f"lower({strip('serviceType')})"

    def has(*ws):
        return "(" + " OR ".join(f"contains({n}, '{w}')" for w in ws) + ")"
    return f"""CASE WHEN {n} = '' THEN NULL WHEN {has('inspection', 'estimate')} THEN NULL
 WHEN {has('rodent baiting')} THEN 'svc_rodent_baiting' WHEN NOT ({_sub_active('active')}) THEN NULL
 WHEN {n} = 'termite treatment' THEN 'svc_termite' WHEN {has('mosquito')} THEN 'svc_mosquito'
 WHEN {has('rodent')} AND {has('exclusion', 'trapping', 'control program')} THEN 'svc_rodent_service'
 WHEN {has('weed')} THEN 'svc_weed' WHEN {has('pigeon', 'flock')} THEN 'svc_bird'
 WHEN {has('heater rental')} THEN 'svc_heater_rental' WHEN {has('bed bug', 'actisol')} THEN 'svc_bedbug'
 WHEN {has('deep root')} THEN 'svc_deep_root' WHEN {has('bee')} THEN 'svc_bee'
 WHEN {has('pest control', 'roach', 'attic', 'blacklight', 'drain')} THEN 'svc_pest' END"""


TAG_SUBS = (f"SELECT * FROM raw_subscriptions WHERE {_sub_active('active')} "
            f"OR {strip('serviceID')} IN ('1595', '225', '1363', '1384')")
SVC = f"""svc AS (SELECT customerID, list_sort(list_distinct(list(tag))) AS svc_tags
  FROM (SELECT customerID, {_tag_case()} AS tag FROM ({TAG_SUBS})) WHERE tag IS NOT NULL GROUP BY 1)"""

CRM = """crm AS (SELECT contact_id, email, phone, string_split(tags, ',') AS tags FROM crm_contacts),
by_email AS (SELECT lower(email) AS k, min(contact_id) AS cid FROM crm WHERE email IS NOT NULL GROUP BY 1),
by_phone AS (SELECT phone AS k, min(contact_id) AS cid FROM crm WHERE phone IS NOT NULL GROUP BY 1)"""



def daily(office: int) -> str:
    return f"""daily AS (SELECT customerID AS fr_id, {EMAIL_DAILY} AS email, {PHONE} AS phone,
  {daily_tags(office)} AS tags, {REAL} AS real FROM raw_customers WHERE {of_office(office)})"""


IMPORT = f"""imp AS (SELECT {to_int('officeID')} AS office, customerID AS fr_id, {strip('fname')} AS first_name,
  {strip('lname')} AS last_name, {EMAIL_IMPORT} AS email, {PHONE} AS phone,
  ['fr_office' || CAST({to_int('officeID')} AS VARCHAR), 'fr_active', {SEGMENT}] AS tags FROM raw_customers
  WHERE COALESCE(active, '0') = '1' AND {REAL}),
pending AS (SELECT * FROM imp WHERE fr_id NOT IN (SELECT customerID FROM raw_customers
  WHERE TRY_CAST(customerID AS BIGINT) % 11 = 0 AND customerID IS NOT NULL)),
send AS (SELECT * FROM pending WHERE email IS NOT NULL OR phone IS NOT NULL),
dd AS (SELECT s.*,
  s.email IS NOT NULL AND (s.email IN (SELECT lower(email) FROM crm WHERE email IS NOT NULL)
    OR EXISTS (SELECT 1 FROM send s2 WHERE s2.email = s.email AND (s2.office < s.office OR
      (s2.office = s.office AND CAST(s2.fr_id AS BIGINT) < CAST(s.fr_id AS BIGINT))))) AS de,
  s.phone IS NOT NULL AND (s.phone IN (SELECT phone FROM crm WHERE phone IS NOT NULL)
    OR EXISTS (SELECT 1 FROM send s2 WHERE s2.phone = s.phone AND (s2.office < s.office OR
      (s2.office = s.office AND CAST(s2.fr_id AS BIGINT) < CAST(s.fr_id AS BIGINT))))) AS dp
  FROM send s),
deduped AS (SELECT office, fr_id, first_name, last_name, email AS original_email, phone AS original_phone,
  CASE WHEN NOT de THEN email END AS email, CASE WHEN NOT dp THEN phone END AS phone,
  tags || list_filter([CASE WHEN de THEN 'fr_duplicate_email' END, CASE WHEN dp THEN 'fr_duplicate_phone' END],
                      lambda t: t IS NOT NULL) AS tags,
  CASE WHEN de AND dp THEN 'created_no_email_no_phone' WHEN de THEN 'created_no_email'
       WHEN dp THEN 'created_no_phone' ELSE 'created' END AS action,
  CASE WHEN de AND dp THEN 'email+phone' WHEN de THEN 'email' WHEN dp THEN 'phone' END AS matched_on
  FROM dd)"""

OFFICE_SVC = SVC.replace("raw_subscriptions", "(SELECT * FROM raw_subscriptions WHERE officeID = '1')")
KEPT = "list_filter(old, lambda t: t NOT IN ('fr_active', 'fr_inactive') AND NOT starts_with(t, 'svc_'))"


def plan(office: int) -> str:
    """The contacts sent one after the other: each looks for its email in the
    CRM and among the earlier contacts, then for its phone; a recursive walk
    leads from contact to contact to the one that the CRM holds."""
    svc = OFFICE_SVC if office == 1 else "svc AS (SELECT '' AS customerID, CAST([] AS VARCHAR[]) AS svc_tags)"
    earlier = "SELECT arg_min(x.fr_id, CAST(x.fr_id AS BIGINT)) FROM sendable x WHERE CAST(x.fr_id AS BIGINT) < CAST(s.fr_id AS BIGINT)"
    return f""", {svc}, {CRM}, {daily(office)},
sendable AS (SELECT d.fr_id, d.email, d.phone, d.tags || COALESCE(svc.svc_tags, []) AS tags
  FROM daily d LEFT JOIN svc ON d.fr_id = svc.customerID
  WHERE d.real AND (d.email IS NOT NULL OR d.phone IS NOT NULL)),
m AS (SELECT s.*, COALESCE(e.cid, p.cid) AS contact_id, e.cid AS crm_email, p.cid AS crm_phone,
  ({earlier} AND x.email = s.email) AS before_email, ({earlier} AND x.phone = s.phone) AS before_phone
  FROM sendable s LEFT JOIN by_email e ON s.email = e.k LEFT JOIN by_phone p ON s.phone = p.k),
n AS (SELECT fr_id, tags, CASE WHEN crm_email IS NULL AND before_email IS NULL THEN crm_phone ELSE crm_email END AS hit,
  CASE WHEN crm_email IS NOT NULL THEN NULL WHEN before_email IS NOT NULL THEN before_email
       WHEN crm_phone IS NULL THEN before_phone END AS same_as FROM m),
reached AS (WITH RECURSIVE w AS (SELECT fr_id, fr_id AS stop, hit, same_as FROM n
    UNION ALL SELECT w.fr_id, n.fr_id, n.hit, n.same_as FROM w JOIN n ON n.fr_id = w.same_as)
  SELECT fr_id, hit AS contact_id, CASE WHEN hit IS NULL THEN stop END AS created_by FROM w WHERE same_as IS NULL),
o AS (SELECT n.*, r.contact_id, r.created_by, COALESCE(c.tags, []) || COALESCE(flatten(list(n.tags) OVER (
    PARTITION BY r.contact_id, r.created_by ORDER BY CAST(n.fr_id AS BIGINT)
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), []) AS old
  FROM n JOIN reached r ON r.fr_id = n.fr_id LEFT JOIN crm c ON c.contact_id = r.contact_id),
planned AS (SELECT fr_id, 'created' AS action, contact_id, same_as, created_by, tags FROM o
  WHERE hit IS NULL AND same_as IS NULL
  UNION ALL SELECT fr_id, 'updated', contact_id, same_as, created_by,
  list_filter({KEPT} || tags, lambda x, i: i = list_position({KEPT} || tags, x))
  FROM o WHERE hit IS NOT NULL OR same_as IS NOT NULL
  UNION ALL SELECT fr_id, CASE WHEN NOT real THEN 'skipped_orphaned' ELSE 'skipped_no_contact' END, NULL, NULL, NULL,
  tags FROM daily WHERE NOT (real AND (email IS NOT NULL OR phone IS NOT NULL))),
merged AS (SELECT * FROM planned WHERE action = 'updated'),
actions AS (SELECT CASE WHEN hit IS NOT NULL OR same_as IS NOT NULL THEN 'updated' ELSE 'created' END AS action FROM n
  UNION ALL SELECT CASE WHEN NOT real THEN 'skipped_orphaned' ELSE 'skipped_no_contact' END FROM daily
  WHERE NOT (real AND (email IS NOT NULL OR phone IS NOT NULL)))
"""


def _contacts() -> dict[str, str]:
    q: dict[str, str] = {}
    rc = cte("raw_customers")
    q["contact_phones"] = rc + f"SELECT customerID, {PHONE} AS phone FROM raw_customers"
    q["contact_emails"] = rc + (f"SELECT customerID, {EMAIL_DAILY} AS email_daily, {EMAIL_IMPORT} AS email_import "
                                "FROM raw_customers")
    for name, n in (("contacts_daily", 1), ("contacts_daily_office2", 2)):
        q[name] = rc + f"""SELECT customerID AS fr_id, {strip('fname')} AS first_name,
 {strip('lname')} AS last_name, {EMAIL_DAILY} AS email, {PHONE} AS phone, {blank_null('companyName')} AS company_name,
 {blank_null('address')} AS address1, {blank_null('city')} AS city, {blank_null('state')} AS state,
 {blank_null('zip')} AS postal_code, array_to_string({daily_tags(n)}, ',') AS tags, {REAL} AS real FROM raw_customers
WHERE {of_office(n)}"""
    q["contacts_import"] = rc + f""", {IMPORT.split(PENDING)[0]}
SELECT CAST(office AS BIGINT) AS office, fr_id, email, phone,
 (SELECT {blank_null('companyName')} FROM raw_customers r WHERE r.customerID = imp.fr_id) AS company_name,
 array_to_string(tags, ',') AS tags, COALESCE(fr_id, '') AS custom_value FROM imp"""
    q["contactable"] = rc + f", {daily(1)} SELECT fr_id, email, phone FROM daily WHERE real AND (email IS NOT NULL OR phone IS NOT NULL)"
    rs = cte("raw_subscriptions")
    q["tag_subscriptions"] = rs + f"SELECT subscriptionID, customerID, serviceID, active FROM ({TAG_SUBS})"
    q["service_tags"] = rs + f", {SVC} SELECT customerID, array_to_string(svc_tags, ',') AS svc_tags FROM svc"
    both = cte("raw_customers", "raw_subscriptions", "crm_contacts")
    q["tag_counts"] = both + f"""{plan(1)}, mine AS (SELECT list_filter(tags, lambda t: starts_with(t, 'svc_')) AS t FROM sendable)
SELECT tag, COUNT(*) AS customers FROM (SELECT unnest(t) AS tag FROM mine) GROUP BY 1
UNION ALL SELECT 'svc_pest_not_svc_mosquito', CAST(COUNT_IF(list_contains(t, 'svc_pest')
  AND NOT list_contains(t, 'svc_mosquito')) AS BIGINT) FROM mine"""
    q["contact_match"] = both + plan(1) + "SELECT fr_id, contact_id FROM m"
    for suffix, n in (("", 1), ("_office2", 2)):
        q[f"tag_merge{suffix}"] = both + plan(n) + (
            "SELECT fr_id, contact_id, same_as, array_to_string(tags, ',') AS tags FROM merged")
        q[f"upsert_plan{suffix}"] = both + plan(n) + (
            "SELECT fr_id, action, contact_id, same_as, created_by, array_to_string(tags, ',') AS tags FROM planned")
        q[f"upsert_summary{suffix}"] = both + plan(n) + "SELECT action, COUNT(*) AS customers FROM actions GROUP BY 1"
    ic = cte("raw_customers", "crm_contacts") + f", {CRM}, {IMPORT}\n"
    q["import_dedupe"] = ic + ("SELECT fr_id, email, phone, array_to_string(tags, ',') AS tags, action, matched_on "
                               "FROM deduped")
    q["duplicate_review"] = ic + """SELECT fr_id, trim(COALESCE(first_name, '') || ' ' || COALESCE(last_name, '')) AS name,
 COALESCE(original_email, '') AS email, COALESCE(original_phone, '') AS phone, matched_on, CAST(office AS BIGINT) AS office
FROM deduped WHERE matched_on IS NOT NULL"""
    q["import_pending"] = ic + "SELECT fr_id FROM pending"
    skipped = "SELECT 'skipped' AS action FROM pending WHERE email IS NULL AND phone IS NULL"
    q["import_summary"] = ic + f"""SELECT action, COUNT(*) AS customers FROM
 (SELECT action FROM deduped UNION ALL {skipped}) GROUP BY 1"""
    q["import_log"] = ic + f"""SELECT action, COUNT(*) AS customers, TIMESTAMP '{RUN_AT}' AS run_at, COUNT(*) AS entries FROM
 (SELECT action FROM deduped UNION ALL {skipped}) GROUP BY 1"""
    q["duplicate_review_csv"] = q["duplicate_review"]
    q["import_summary_dry_run"] = ic + f"""SELECT action, COUNT(*) AS customers FROM
 (SELECT 'would_create' AS action FROM send UNION ALL {skipped}) GROUP BY 1"""
    # The import as the CRM sees it: a row per attempt, each from the one before.
    bad_raw = ("raw_customers AS (SELECT * REPLACE (CASE WHEN CAST(customerID AS BIGINT) % 13 = 0 THEN 'not an address' "
               "ELSE email END AS email) FROM all_customers)")
    attempts = cte("raw_customers", "crm_contacts").replace("raw_customers AS (", "all_customers AS (", 1).replace(
        "crm_contacts AS (", bad_raw + ",\ncrm_contacts AS (", 1) + f""", {CRM}, {IMPORT},
numbered AS (SELECT *, row_number() OVER (ORDER BY CAST(office AS BIGINT), TRY_CAST(fr_id AS BIGINT), fr_id) AS turn FROM send),
held AS (SELECT 'email' AS field, lower(email) AS value, 0 AS turn FROM crm WHERE email IS NOT NULL
  UNION ALL SELECT 'phone', phone, 0 FROM crm WHERE phone IS NOT NULL
  UNION ALL SELECT 'email', email, turn FROM numbered WHERE regexp_full_match(email, '[^@\\s]+@[^@\\s]+\\.[^@\\s]+')
  UNION ALL SELECT 'phone', phone, turn FROM numbered WHERE phone IS NOT NULL),
since AS (SELECT field, value, min(turn) AS turn FROM held GROUP BY ALL),
one AS (SELECT n.*, CASE WHEN NOT regexp_full_match(n.email, '[^@\\s]+@[^@\\s]+\\.[^@\\s]+') THEN 'invalid'
    WHEN e.turn < n.turn THEN 'email' WHEN p.turn < n.turn THEN 'phone' ELSE 'ok' END AS answer1,
  COALESCE(p.turn < n.turn, FALSE) AS phone_taken
  FROM numbered n LEFT JOIN since e ON e.field = 'email' AND e.value = n.email
  LEFT JOIN since p ON p.field = 'phone' AND p.value = n.phone),
two AS (SELECT *, CASE answer1 WHEN 'ok' THEN NULL
    WHEN 'invalid' THEN CASE WHEN phone IS NULL OR phone_taken THEN 'refused' ELSE 'ok' END
    WHEN 'email' THEN CASE WHEN phone IS NULL THEN 'refused' WHEN phone_taken THEN 'phone' ELSE 'ok' END
    ELSE CASE WHEN email IS NULL THEN 'refused' ELSE 'ok' END END AS answer2 FROM one),
outcomes AS (SELECT *, CASE WHEN answer1 = 'ok' THEN 'created' WHEN answer2 <> 'ok' THEN 'error'
    WHEN answer1 = 'phone' THEN 'created_no_phone' ELSE 'created_no_email' END AS action,
  CASE WHEN answer1 = 'ok' THEN NULL WHEN answer1 = 'invalid' THEN 'invalid_email' WHEN answer2 = 'ok' THEN answer1
    ELSE 'unresolved' END AS reason FROM two)
"""
    q["import_outcomes"] = attempts + """
SELECT CAST(office AS BIGINT) AS office, fr_id, CASE WHEN answer1 NOT IN ('invalid', 'email') THEN email END AS email,
  CASE WHEN answer1 <> 'phone' AND NOT (answer1 = 'email' AND phone_taken) THEN phone END AS phone,
  array_to_string(tags || CASE answer1 WHEN 'invalid' THEN ['fr_invalid_email'] WHEN 'email' THEN
    CASE WHEN phone_taken THEN ['fr_duplicate_email', 'fr_duplicate_phone'] ELSE ['fr_duplicate_email'] END
    WHEN 'phone' THEN ['fr_duplicate_phone'] ELSE [] END, ',') AS tags, action, reason AS matched_on FROM outcomes"""
    q["import_outcome_summary"] = attempts + f"""
SELECT action, COUNT(*) AS customers FROM (SELECT action FROM outcomes UNION ALL {skipped}) GROUP BY 1"""
    q["outcome_review_csv"] = attempts + """
SELECT fr_id, trim(COALESCE(first_name, '') || ' ' || COALESCE(last_name, '')) AS name, COALESCE(email, '') AS email,
  COALESCE(phone, '') AS phone, reason AS matched_on, CAST(office AS BIGINT) AS office FROM outcomes WHERE reason IS NOT NULL"""
    bad = "(d.email IS NOT NULL AND NOT regexp_matches(d.email, '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$'))"
    q["invalid_emails"] = rc + f""", {daily(1)}
SELECT fr_id, CASE WHEN NOT {bad} THEN email END AS email, phone,
 array_to_string(CASE WHEN {bad} THEN tags || ['fr_invalid_email'] ELSE tags END, ',') AS tags,
 CASE WHEN {bad} AND phone IS NOT NULL THEN 'created_no_email' WHEN {bad} THEN 'error' END AS invalid_action
FROM daily d WHERE real"""
    return q


# -- quality and pricing -------------------------------------------------------------

def _half_up(num: str, den: str) -> str:
    return (f"(CASE WHEN ({num}) < 0 THEN -1 ELSE 1 END) * "
            f"((2 * abs({num}) + ({den})) // (2 * ({den})))")


#: The first 32 bits of the id's md5, 0 mod 7.
HASH7 = "CAST('0x' || substr(md5(subscriptionID), 1, 8) AS BIGINT) % 7 = 0"


def _reject(field: str, kind: str) -> str:
    nb = f"({field} IS NOT NULL AND {strip(field)} <> '')"
    ph = f"starts_with({strip(field)}, '0000')"
    bad = {"int": f"{to_int(field)} IS NULL", "float": f"{to_float(field)} IS NULL",
           "frequency": f"{to_int(field)} IS NULL AND upper({strip(field)}) <> 'CUSTOM'",
           "date": f"{to_date(field)} IS NULL AND NOT {ph}",
           "ts": f"{to_ts(field)} IS NULL AND NOT {ph}"}[kind]
    return f"CAST(COUNT_IF({nb} AND {bad}) AS BIGINT) AS {field}"


def _fill_sql(template: str, values: dict[str, str]) -> str:
    out = "'" + template.replace("'", "''") + "'"
    for name, v in values.items():
        if "{" + name + ":.2f}" in template:
            out = f"replace({out}, '{{{name}:.2f}}', printf('%.2f', {v}))"
        if "{" + name + "}" in template:
            out = f"replace({out}, '{{{name}}}', CAST({v} AS VARCHAR))"
    return out


# The typed fields of each raw entity.
TYPED = {
    "serviceType": {"int": "typeID officeID frequency billingFrequency", "float": "defaultCharge"},
    "employee": {"int": "employeeID officeID type"},
    "product": {"int": "productID officeID", "float": "amount"},
    "customer": {"int": "customerID officeID billToAccountID", "date": "dateAdded dateCancelled"},
    "subscription": {"int": "subscriptionID customerID officeID serviceID", "float": "recurringCharge initialCharge",
                     "frequency": "frequency", "date": "nextService lastService dateAdded dateCancelled"},
    "appointment": {"int": "appointmentID customerID subscriptionID ticketID officeID routeID sequence assignedTech "
                           "servicedBy type duration status reserviceReasonID",
                    "float": "productionValue amountCollected latIn longIn temperature windSpeed", "date": "date",
                    "ts": "dateCompleted timeIn timeOut dateAdded dateUpdated"},
    "ticket": {"int": "ticketID appointmentID customerID subscriptionID officeID serviceID", "date": "invoiceDate",
               "float": "subTotal taxAmount total balance productionValue", "ts": "dateCreated dateUpdated"},
    "route": {"int": "routeID officeID assignedTech", "date": "date"},
}

# The campaign's settings: thresholds as configured, texts as the library words them.
CFG = {
    "eligibility": {"minimum_days_since_last_increase": 365, "minimum_recurring_charge": 50},
    "notification": {
        "days_before_increase": 30, "notification_method": "field_service_messaging",
        "email_subject": "Your new service price",
        "email_body": "{customer_name}: your price per service changes from ${old_price:.2f} to ${new_price:.2f} on "
                      "{effective_date}. {company_name}"},
    "account_notation": {
        "note_template": "Price ${old_price:.2f} to ${new_price:.2f} on {date}, told {days_before} days before.",
        "service_note_template": "From this service: ${new_price:.2f} (was ${old_price:.2f})"},
    "increase": {"type": "percentage", "value": 5},
    "safety": {"dry_run": True, "max_customers_per_run": 50},
}


def _quality_pricing() -> dict[str, str]:
    from fieldlake.registry_ops import EXPECTED_CUSTOMERS, PRICE_AS_OF
    q: dict[str, str] = {}
    rs = cte("raw_subscriptions")
    real = f"{not_orphan('officeID')} AND {not_orphan('customerID')}"
    q["orphan_rate"] = rs + f""", r AS (SELECT * FROM raw_subscriptions WHERE active = '1'),
g AS (SELECT COUNT(*) AS total, COUNT(*) AS inspected, CAST(COUNT_IF(NOT ({real})) AS BIGINT) AS orphans FROM r)
SELECT total, inspected, orphans,
 CASE WHEN inspected > 0 THEN CAST({_half_up('orphans * 10000', 'inspected')} AS DOUBLE) / 100 END AS orphan_pct,
 CASE WHEN inspected > 0 THEN CAST({_half_up('total * (inspected - orphans)', 'inspected')} AS BIGINT) END AS est_real
FROM g"""
    q["orphan_rate_sampled"] = q["orphan_rate"].replace("COUNT(*) AS inspected", f"CAST(COUNT_IF({HASH7}) AS BIGINT) AS inspected") \
        .replace(f"NOT ({real})", f"{HASH7} AND NOT ({real})")
    vals = ", ".join(f"({k}, {v})" for k, v in EXPECTED_CUSTOMERS.items())
    q["count_check"] = cte("raw_customers") + f""",
e AS (SELECT CAST(o AS BIGINT) AS office_id, CAST(x AS BIGINT) AS expected FROM (VALUES {vals}) t(o, x)),
c AS (SELECT {to_int('officeID')} AS office_id, COUNT(*) AS count FROM raw_customers GROUP BY 1)
SELECT e.office_id, e.expected, COALESCE(c.count, 0) AS count,
 CASE WHEN COALESCE(c.count, 0) * 100 >= e.expected * 90 THEN 'ok' ELSE 'warning' END AS status
FROM e LEFT JOIN c ON e.office_id = c.office_id"""
    charge = to_float('recurringCharge', '0')
    q["sample_subscription"] = rs + f"""SELECT {to_int('subscriptionID')} AS subscription_id,
 {strip('serviceType')} AS service_type, printf('%.2f', {charge}) AS recurring_charge, nextService AS next_service
FROM raw_subscriptions WHERE {real} AND {charge} > 0
ORDER BY subscription_id NULLS LAST LIMIT 1"""
    for name, table, entity in (("conform_rejects", "raw_subscriptions", "subscription"),
                                ("conform_rejects_appointments", "raw_appointments", "appointment"),
                                ("conform_rejects_service_types", "raw_service_types", "serviceType"),
                                ("conform_rejects_employees", "raw_employees", "employee"),
                                ("conform_rejects_products", "raw_products", "product"),
                                ("conform_rejects_customers", "raw_customers", "customer"),
                                ("conform_rejects_tickets", "raw_tickets", "ticket"),
                                ("conform_rejects_routes", "raw_routes", "route")):
        rules = [(field, kind) for kind, fields in TYPED[entity].items() for field in fields.split()]
        q[name] = cte(table) + f""", g AS (SELECT {', '.join(_reject(f, k) for f, k in rules)} FROM {table})
SELECT field, rejects FROM (UNPIVOT g ON {', '.join(f for f, _ in rules)} INTO NAME field VALUE rejects)"""

    el = CFG["eligibility"]
    cents = "CAST(ROUND(recurring_charge * 100) AS BIGINT)"
    eligible = f"""history AS (SELECT customer_id, date_added + 400 AS increase_date FROM dim_subscriptions
  WHERE subscription_id % 5 = 1),
eligible AS (SELECT * FROM dim_subscriptions WHERE active = TRUE
  AND {cents} >= {int(round(el['minimum_recurring_charge'] * 100))}
  AND customer_id NOT IN (SELECT customer_id FROM history
      WHERE increase_date > DATE '{PRICE_AS_OF}' - {el['minimum_days_since_last_increase']})),
priced AS (SELECT *, CAST({cents} AS DOUBLE) / 100 AS old_price,
  CAST({_half_up(f'{cents} * 10500', '10000')} AS DOUBLE) / 100 AS new_price,
  CAST({cents} + 500 AS DOUBLE) / 100 AS new_price_flat FROM eligible)"""
    base = cte("dim_subscriptions") + ", " + eligible + "\n"
    q["increase_eligible"] = base + "SELECT subscription_id, customer_id, recurring_charge FROM eligible"
    q["increase_prices"] = base + "SELECT subscription_id, customer_id, old_price, new_price FROM priced"
    q["increase_prices_flat"] = base + "SELECT subscription_id, old_price, new_price_flat AS new_price FROM priced"
    n = CFG["notification"]
    eff = f"(DATE '{PRICE_AS_OF}' + {n['days_before_increase']})"
    body = _fill_sql(n["email_body"], {
        "customer_name": "COALESCE(COALESCE(NULLIF(c.company_name, ''), c.first_name || ' ' || c.last_name), '')",
        "effective_date": f"CAST({eff} AS VARCHAR)", "old_price": "p.old_price", "new_price": "p.new_price",
        "company_name": "'Your service team'"})
    q["increase_notices"] = cte("dim_subscriptions", "dim_customers") + ", " + eligible + f"""
SELECT p.subscription_id, p.customer_id, c.email, {eff} AS effective_date, '{n['notification_method']}' AS method,
 '{n['email_subject']}' AS subject, {body} AS body, CAST(NULL AS VARCHAR) AS tag
FROM priced p LEFT JOIN dim_customers c ON p.customer_id = c.customer_id"""
    q["increase_notices_office2"] = cte("dim_subscriptions", "dim_customers") + ", " + eligible + f"""
SELECT p.subscription_id, p.customer_id, c.email, {eff} AS effective_date, 'crm_tag' AS method,
 CAST(NULL AS VARCHAR) AS subject, CAST(NULL AS VARCHAR) AS body, 'FR_price_increase_pending' AS tag
FROM priced p LEFT JOIN dim_customers c ON p.customer_id = c.customer_id WHERE p.office_id = 2"""
    from fieldlake.registry_ops import CAMPAIGN_DAYS
    days = ", ".join(f"TIMESTAMP '{d}'" for d in CAMPAIGN_DAYS)
    q["campaign_runs"] = cte("dim_subscriptions", "dim_customers") + ", " + eligible + f""",
turn AS (SELECT customer_id, (row_number() OVER (ORDER BY customer_id) - 1) // 50 + 1 AS run
  FROM (SELECT DISTINCT customer_id FROM priced))
SELECT CAST(run AS BIGINT) AS run, customer_id, p.subscription_id, p.old_price, p.new_price, [{days}][run] AS run_at
FROM turn JOIN priced p USING (customer_id) WHERE run <= {len(CAMPAIGN_DAYS)}"""
    a = CFG["account_notation"]
    nv = {"old_price": "old_price", "new_price": "new_price", "date": f"CAST(DATE '{PRICE_AS_OF}' AS VARCHAR)",
          "days_before": f"'{n['days_before_increase']}'"}
    q["increase_notes"] = base + f"""SELECT subscription_id, customer_id,
 {_fill_sql(a['note_template'], nv)} AS account_note, {_fill_sql(a['service_note_template'], nv)} AS service_note
FROM priced"""
    q["increase_plan"] = base + f"""SELECT subscription_id, customer_id, old_price, new_price,
 dense_rank() OVER (ORDER BY customer_id) <= {CFG['safety']['max_customers_per_run']} AS in_this_run,
 TRUE AS dry_run FROM priced"""
    return q


def _sources() -> dict[str, str]:
    q: dict[str, str] = {}
    q["raw_subscriptions"] = cte("raw_subscriptions") + "SELECT * FROM raw_subscriptions"
    q["dim_overwrite"] = cte("raw_service_types") + SERVICE_TYPES_SQL
    q["dim_overwrite_employees"] = cte("raw_employees") + EMPLOYEES_SQL
    q["dim_overwrite_products"] = cte("raw_products") + PRODUCTS_SQL
    q["appended_table"] = cte("raw_products") + f""", p AS (
 SELECT *, TIMESTAMP '{RUN_AT}' AS loaded_at FROM ({PRODUCTS_SQL}))
SELECT * FROM p UNION ALL SELECT * FROM p WHERE taxable"""
    q["created_tables"] = """SELECT 'dim_products' AS "table", 'existing' AS status, (SELECT COUNT(*) FROM part) AS "rows"
UNION ALL SELECT 'dim_customers', 'existing', (SELECT COUNT(*) FROM customer)
UNION ALL SELECT t, 'created', 0 FROM (VALUES ('dim_employees'), ('dim_service_types'), ('dim_subscriptions'),
 ('fact_appointments'), ('fact_tickets'), ('fact_ticket_items'), ('sync_health')) AS v(t)"""
    k = "(CAST(customerID AS BIGINT) - 1)"
    q["stream_upsert"] = cte("raw_customers") + f""", landed AS (
  SELECT * REPLACE (CASE WHEN {k} % 10 = 0 THEN 'changed' || customerID || '@x.com' ELSE email END AS email)
  FROM raw_customers)
SELECT {CUSTOMER_COLS} FROM landed WHERE {not_orphan('officeID')} AND {not_orphan('customerID')}"""
    changed = lambda key: f"CAST({key} AS BIGINT) % 10 = 0"
    from fieldlake.sources.schemas import RAW_FIELDS
    from fieldlake.sources.testdata import RAW_ENTITY
    item = {c: f"CAST({e} AS {t})" for c, e, t in FIXTURES["raw_items"].columns}
    item_kinds = {"itemID": "int", "quantity": "float", "amount": "float", "productID": "int", "serviceID": "int"}
    q["conform_rejects_ticket_items"] = f"""WITH i AS (SELECT {', '.join(f'{item[c]} AS {c}' for c in item_kinds)}
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE NOT ({TICKETS_WITHOUT_ITEMS})),
g AS (SELECT {', '.join(_reject(c, k) for c, k in item_kinds.items())} FROM i)
SELECT field, rejects FROM (UNPIVOT g ON {', '.join(item_kinds)} INTO NAME field VALUE rejects)"""
    landed = []
    for name, entity in RAW_ENTITY.items():
        q.setdefault(name, cte(name) + f"SELECT * FROM {name}")
        n = f"COALESCE(TRY_CAST({RAW_FIELDS[entity][0]} AS BIGINT), 1)"
        landed += [f"""SELECT '{entity}' AS entity, '{what}' AS what, {field} AS field,
  (SELECT COUNT(*) FROM {name} WHERE {where}) AS "lines\"""" for what, field, where in (
            ("records", "NULL", f"{n} % 50 <> 0"), ("quarantined", "NULL", f"{n} % 50 = 0"),
            ("unknown field", "'fromApp'", f"{n} % 20 = 3 AND {n} % 50 <> 0"))]
    q["raw_quarantine"] = cte(*RAW_ENTITY) + 'SELECT * FROM (' + " UNION ALL ".join(landed) + """)
WHERE "lines" > 0 OR what <> 'unknown field'"""
    q["raw_tickets"] = cte("raw_tickets") + f"""SELECT t.*, CASE WHEN NOT ({TICKETS_WITHOUT_ITEMS.replace('o_orderkey', '(CAST(t.appointmentID AS BIGINT) - 1)')})
  THEN (SELECT COUNT(*) FROM lineitem WHERE l_orderkey = CAST(t.appointmentID AS BIGINT) - 1) END AS items FROM raw_tickets t"""
    q["stream_subscriptions"] = cte("raw_subscriptions") + f""", landed AS (
  SELECT * REPLACE (CASE WHEN {changed('subscriptionID')} THEN '99.25' ELSE recurringCharge END AS recurringCharge)
  FROM raw_subscriptions)
SELECT {SUBSCRIPTION_COLS} FROM landed WHERE {not_orphan('officeID')} AND {not_orphan('customerID')}"""
    q["stream_appointments"] = cte("raw_appointments") + f""", landed AS (
  SELECT * REPLACE (
    CASE WHEN {changed('appointmentID')} THEN CAST(CAST(date AS DATE) + 40 AS VARCHAR) ELSE date END AS date,
    CASE WHEN {changed('appointmentID')} THEN '2030-01-02 09:00:00' ELSE dateUpdated END AS dateUpdated)
  FROM raw_appointments),
rt AS (SELECT CAST(NULL AS BIGINT) AS route_tech_id)
SELECT {APPOINTMENT_COLS} FROM landed, rt WHERE {not_orphan('officeID')}"""
    winners = cte("raw_tickets") + f""", landed AS (
  SELECT * REPLACE (CASE WHEN {changed('appointmentID')} THEN '77.25' ELSE total END AS total,
    CASE WHEN {changed('appointmentID')} THEN '2030-01-02 09:00:00' ELSE dateUpdated END AS dateUpdated)
  FROM raw_tickets),
won AS (SELECT * FROM landed WHERE {not_orphan('officeID')}
  QUALIFY row_number() OVER (PARTITION BY officeID, ticketID ORDER BY dateUpdated DESC, appointmentID DESC) = 1)
"""
    q["stream_tickets"] = winners + f"SELECT {TICKET_COLS} FROM won"
    q["stream_ticket_items"] = winners + f""", items AS ({_items_sql()})
SELECT items.* FROM items JOIN won ON CAST(won.appointmentID AS BIGINT) - 1 = items.item_id // 10
WHERE NOT ({changed('won.appointmentID')} AND items.item_id % 10 = 1)"""
    return q


def oracles() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(_sources())
    out.update(_conform())
    out.update(_load())
    out.update(_nightly())
    out.update(_backfilled())
    out.update(_contacts())
    out.update(_quality_pricing())
    return out
