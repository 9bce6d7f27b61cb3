"""View catalog (S5): register every KPI view as a temp view."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlake.plans import views as V


def view_builders(t: Mapping[str, DataFrame], as_of, routes_as_of=None) -> dict:
    """View name → zero-argument builder over the star tables ``t``. The
    route view's date is ``as_of`` unless ``routes_as_of`` is given."""
    return {
        "v_mrr_by_service_type": lambda: V.mrr_by_service_type(t["dim_subscriptions"]),
        "v_monthly_revenue": lambda: V.monthly_revenue(t["fact_tickets"]),
        "v_customer_growth": lambda: V.customer_growth(t["dim_customers"]),
        "v_tech_production": lambda: V.tech_production(t["fact_appointments"], t["fact_tickets"],
                                                       t["dim_employees"], t["dim_service_types"]),
        "v_tech_hourly_rate": lambda: V.tech_hourly_rate(t["fact_appointments"], t["fact_tickets"],
                                                         t["dim_employees"]),
        "v_reservice_rates": lambda: V.reservice_rates(t["fact_appointments"], t["dim_employees"],
                                                       t["dim_service_types"]),
        "v_ar_aging": lambda: V.ar_aging(t["fact_tickets"], t["dim_customers"], as_of),
        "v_inspection_conversion": lambda: V.inspection_conversion(t["fact_appointments"],
                                                                   t["dim_service_types"]),
        "v_chemical_usage": lambda: V.chemical_usage(t["fact_ticket_items"], t["fact_tickets"],
                                                     t["fact_appointments"], t["dim_employees"],
                                                     t["dim_products"]),
        "v_route_analysis_office2": lambda: V.route_analysis(
            t["fact_appointments"], t["fact_tickets"], t["dim_employees"], t["dim_customers"],
            t["dim_service_types"], routes_as_of or as_of),
    }


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame], as_of, routes_as_of=None) -> DataFrame:
    """Create or replace each view; one failure does not stop the others.
    Returns (view, ok, error) — planning errors surface here, as analysis
    runs when a view is defined."""
    report = []
    for name, build in view_builders(tables, as_of, routes_as_of).items():
        try:
            build().createOrReplaceTempView(name)
            report.append((name, True, None))
        except Exception as e:  # noqa: BLE001 - isolate each view, report the error
            report.append((name, False, str(e)))
    return spark.createDataFrame(report, "view string, ok boolean, error string")


def view_rows(spark: SparkSession, report: DataFrame) -> DataFrame:
    """(view, ok, error, rows): each registered view run and counted; the
    report of ``register_views`` has one row per view."""
    counts = None
    for view, ok, _ in report.collect():
        if ok:
            n = spark.table(view).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(view).alias("view"), "rows")
            counts = n if counts is None else counts.unionByName(n)
    if counts is None:
        return report.withColumn("rows", F.lit(None).cast("long"))
    return report.join(counts, ["view"], "left")
