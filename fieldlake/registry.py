"""Spark side of every registered query: (spark, sf_dir) -> DataFrame.

Each callable renders the fixtures it needs from the driver tables under
``sf_dir`` and calls the library function; the DuckDB oracle of the same
name lives in ``fieldlake.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fieldlake.plans import views as V
from fieldlake.sources.testdata import AS_OF_AGING, AS_OF_ROUTES, load

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, sf: str, *names: str) -> list[DataFrame]:
    return [load(spark, sf, n) for n in names]


def _views() -> dict[str, Query]:
    q: dict[str, Query] = {}
    q["mrr_by_service_type"] = lambda s, sf: V.mrr_by_service_type(*_t(s, sf, "dim_subscriptions"))
    q["monthly_revenue"] = lambda s, sf: V.monthly_revenue(*_t(s, sf, "fact_tickets"))
    q["customer_growth"] = lambda s, sf: V.customer_growth(*_t(s, sf, "dim_customers"))
    q["tech_production"] = lambda s, sf: V.tech_production(*_t(
        s, sf, "fact_appointments", "fact_tickets", "dim_employees", "dim_service_types"))
    q["tech_hourly_rate"] = lambda s, sf: V.tech_hourly_rate(*_t(
        s, sf, "fact_appointments", "fact_tickets", "dim_employees"))
    q["reservice_rates"] = lambda s, sf: V.reservice_rates(*_t(
        s, sf, "fact_appointments", "dim_employees", "dim_service_types"))
    q["ar_aging"] = lambda s, sf: V.ar_aging(*_t(s, sf, "fact_tickets", "dim_customers"), AS_OF_AGING)
    q["inspection_conversion"] = lambda s, sf: V.inspection_conversion(*_t(
        s, sf, "fact_appointments", "dim_service_types"))
    q["inspection_conversion_distinct"] = lambda s, sf: V.inspection_conversion(*_t(
        s, sf, "fact_appointments", "dim_service_types"), distinct=True)
    q["chemical_usage"] = lambda s, sf: V.chemical_usage(*_t(
        s, sf, "fact_ticket_items", "fact_tickets", "fact_appointments", "dim_employees",
        "dim_products"))
    q["route_analysis"] = lambda s, sf: V.route_analysis(*_t(
        s, sf, "fact_appointments", "fact_tickets", "dim_employees", "dim_customers",
        "dim_service_types"), AS_OF_ROUTES)
    q["service_types_dedup"] = lambda s, sf: V.dedup_service_types(*_t(s, sf, "dim_service_types"))
    return q


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    out.update(_views())
    from fieldlake import registry_ops
    out.update(registry_ops.queries())
    return out
