"""View row counts seen in both engines on sf0.001, and view invariants."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from fieldlake.plans import views as V
from fieldlake.sources.testdata import load

EXPECTED_ROWS = {
    "mrr_by_service_type": 50, "monthly_revenue": 167, "customer_growth": 133,
    "tech_production": 645, "tech_hourly_rate": 411, "reservice_rates": 709, "ar_aging": 475,
    "inspection_conversion": 128, "chemical_usage": 4937, "route_analysis": 1,
}


@pytest.mark.parametrize("name", sorted(EXPECTED_ROWS))
def test_row_counts(spark, sf, name):
    assert E.queries()[name](spark, sf).count() == EXPECTED_ROWS[name]


def _half_up(x, places=2):
    from decimal import ROUND_HALF_UP, Decimal
    return float(Decimal(x.numerator * 10 ** 30 // x.denominator).scaleb(-30).quantize(
        Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP))


def _fraction(x):
    from fractions import Fraction
    return Fraction(repr(round(x, 8)))


def test_revenue_rounds_once(spark, sf):
    """Sums and averages of every group against fractions."""
    from collections import defaultdict
    t = load(spark, sf, "fact_tickets").filter("active AND invoice_date IS NOT NULL AND total > 0")
    groups = defaultdict(list)
    for r in t.select(F.trunc("invoice_date", "month").alias("m"), "office_id", "total").collect():
        groups[r.m, r.office_id].append(_fraction(r.total))
    got = {(r.month, r.office_id): (r.revenue, r.avg_invoice) for r in V.monthly_revenue(t).collect()}
    assert got == {k: (_half_up(sum(v)), _half_up(sum(v) / len(v))) for k, v in groups.items()}


def test_hourly_rate_divides_exact_sums(spark):
    a = spark.createDataFrame(
        [(k, 1, 7, k, 1, d) for k, d in ((1, 20.0 + 1 / 60), (2, 33.0 + 7 / 60), (3, 59.99))],
        "appointment_id long, office_id long, serviced_by_id long, ticket_id long, status long, duration_actual_min double")
    a = a.withColumn("scheduled_date", F.lit("2024-01-02").cast("date"))
    t = spark.createDataFrame([(1, 10.004, -1.0), (2, 20.004, None), (3, 99.994, 50.555)],
                              "ticket_id long, total double, production_value double")
    e = spark.createDataFrame([], "employee_id long, first_name string, last_name string, initials string")
    r = V.tech_hourly_rate(a, t, e).first()
    minutes = sum(map(_fraction, (20.0 + 1 / 60, 33.0 + 7 / 60, 59.99)))
    production, revenue = (sum(map(_fraction, x)) for x in ((10.004, 20.004, 50.555), (10.004, 20.004, 99.994)))
    assert r.production_per_hour == _half_up(production * 60 / minutes)
    assert r.revenue_per_hour == _half_up(revenue * 60 / minutes)
    assert (r.total_hours_on_site, r.avg_minutes_per_job) == (_half_up(minutes / 60), _half_up(minutes / 3, 1))
    assert (r.total_production, r.total_revenue) == (80.56, 130.0)


def test_inspections_against_plain_pairs(spark):
    """Random visits, also without customer or date, against comparing all pairs."""
    import datetime as dt
    import random
    r = random.Random(6)
    types = [(1, "Inspect A", True, False, False), (2, "Inspect B", True, False, True), (3, "Regular", False, False, True),
             (4, "Again", False, True, True), (5, "Other", False, False, False)]
    d0 = dt.date(1969, 6, 1)  # also before the epoch
    rows = [(r.choice([1, 1, 1, 2, 3, None]), r.choice([1, 2]), r.choice([1, 2, 3, 3, 3, 4, 5]),
             r.choice([1, 1, 1, 0]), None if r.random() < .05 else d0 + dt.timedelta(days=r.randint(0, 500)))
            for _ in range(700)]
    a = spark.createDataFrame(rows, "customer_id long, office_id long, service_type_id long, status long, scheduled_date date")
    st = spark.createDataFrame(types * 2, "type_id long, description string, is_inspection boolean, reservice boolean, "
                                          "regular_service boolean")
    served = {(c, d) for c, _, k, s, d in rows if s == 1 and k == 3 and c and d}
    for days in (1, 29, 90):
        for distinct in (False, True):
            want = {}
            for c, o, k, s, d in rows:
                if s == 1 and k in (1, 2):
                    n = sum(1 for x, f in served if x == c and d and d < f <= d + dt.timedelta(days=days))
                    key = (d and d.replace(day=1), o, types[k - 1][1])
                    x, y = want.get(key, (0, 0))
                    want[key] = (x + 1, y + (n > 0)) if distinct else (x + max(n, 1), y + n)
            got = V.inspection_conversion(a, st, days, distinct).collect()
            assert {(x.month, x.office_id, x.inspection_type): (x.total_inspections, x.converted) for x in got} == want


def test_inspection_fanout_vs_distinct(spark, sf):
    a, st = load(spark, sf, "fact_appointments"), load(spark, sf, "dim_service_types")
    fan = V.inspection_conversion(a, st).agg(F.sum("total_inspections"), F.sum("converted")).first()
    one = V.inspection_conversion(a, st, distinct=True).agg(F.sum("total_inspections"), F.sum("converted")).first()
    n = (a.filter("status = 1").join(st.filter("is_inspection").select(F.col("type_id").alias("service_type_id"))
                                     .distinct(), "service_type_id").count())
    assert one[0] == n and fan[0] >= one[0] and fan[1] >= one[1]


def test_service_type_dedupe(spark, sf):
    st = load(spark, sf, "dim_service_types")
    assert st.count() > st.select("type_id").distinct().count()
    assert V.dedup_service_types(st).count() == st.select("type_id").distinct().count()


def test_best_tech_option(spark, sf):
    t = {n: load(spark, sf, n) for n in ("fact_appointments", "fact_tickets", "dim_employees",
                                         "dim_customers", "dim_service_types")}
    args = (t["fact_appointments"], t["fact_tickets"], t["dim_employees"], t["dim_customers"],
            t["dim_service_types"], "1999-12-15")
    raw, best = V.route_analysis(*args), V.route_analysis(*args, use_best_tech=True)
    assert raw.count() == best.count()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["month", "office_id", "office_name", "employee_id", "tech_name", "initials",
                          "completed_jobs", "production_value", "revenue_value", "avg_job_production",
                          "avg_job_revenue", "reservice_count"]


def test_unset_ids_pair_with_nothing(spark, sf):
    t = {n: load(spark, sf, n) for n in ("fact_ticket_items", "fact_tickets", "fact_appointments", "dim_employees",
                                         "dim_products")}
    base = V.chemical_usage(*t.values())
    unset = {"fact_ticket_items": "ticket_id", "fact_tickets": "ticket_id", "fact_appointments": "appointment_id"}
    more = [df.unionByName(df.withColumn(unset[n], F.lit(0).cast("long"))) if n in unset else df for n, df in t.items()]
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(V.chemical_usage(*more)) == rows(base)


def test_usage_counts_repeated_names_and_sums_unknown_products(spark):
    import datetime as dt
    day = dt.date(2000, 5, 17)
    items = spark.createDataFrame([(1, 1, 1.25, 2.5, 7), (1, 1, 1.25, 2.5, 7), (1, 1, 2.0, 1.0, 8), (2, 1, 4.0, 3.0, 9),
                                   (2, 1, 5.0, None, 9), (3, 1, 1.0, 1.0, 7)],
                                  "ticket_id long, office_id long, quantity double, amount double, product_id long")
    tickets = spark.createDataFrame([(1, 11, day), (2, 12, day), (2, 12, day), (3, 13, None)],
                                    "ticket_id long, appointment_id long, invoice_date date")
    appointments = spark.createDataFrame([(11, 5), (12, 6)], "appointment_id long, serviced_by_id long")
    employees = spark.createDataFrame([(5, "A", "B", None), (5, "A", "B", ""), (5, "C", None, "c")],
                                      "employee_id long, first_name string, last_name string, initials string")
    products = spark.createDataFrame([(7, "x", None, "k"), (7, "x", None, "k"), (7, "y", "c", "k"), (None, "n", "n", "n")],
                                     "product_id long, description string, code string, category string")
    out = V.chemical_usage(items, tickets, appointments, employees, products)
    may, office = dt.date(2000, 5, 1), out.first()["office_name"]
    assert sorted(map(str, (tuple(r) for r in out.collect()))) == sorted(map(str, [
        (may, 1, office, 5, "A B", "", 7, "x", None, "k", 10.0, 20.0),
        (may, 1, office, 5, "A B", "", 7, "y", "c", "k", 5.0, 10.0),
        (may, 1, office, 5, "A B", "", None, None, None, None, 4.0, 2.0),
        (may, 1, office, 5, "5", "c", 7, "x", None, "k", 5.0, 10.0),
        (may, 1, office, 5, "5", "c", 7, "y", "c", "k", 2.5, 5.0),
        (may, 1, office, 5, "5", "c", None, None, None, None, 2.0, 1.0),
        (may, 1, office, 6, "6", "", None, None, None, None, 18.0, 6.0)]))
