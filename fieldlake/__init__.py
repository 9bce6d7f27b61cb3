"""fieldlake — field-service analytics on Spark.

Raw field-service records (customers, subscriptions, appointments, routes,
tickets with line items, service types, employees, products) are conformed
to a typed star schema, loaded incrementally (batch or stream), and the
business views are computed on top. Every public function takes and returns
DataFrames; nothing is collected to the driver.

Sub-packages:
    functions  column expressions (safe casts, exact money rounding, contacts)
    sources    schemas, raw readers, sinks, test-data fixtures
    operators  conform jobs, incremental loads, CRM contacts, quality, pricing
    plans      KPI views and the view catalog
    streaming  incremental upsert as a Structured Streaming job
"""

__version__ = "0.1.0"
