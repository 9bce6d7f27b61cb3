"""Typed star schema (8 tables + run log) and the all-string raw schemas."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, DateType, DoubleType, LongType, StringType, StructField,
    StructType, TimestampType,
)

_T: dict[str, DataType] = {
    "L": LongType(), "D": DoubleType(), "S": StringType(), "B": BooleanType(),
    "d": DateType(), "t": TimestampType(),
}


def _schema(spec: str, key: str | None) -> StructType:
    fields = []
    for item in spec.split():
        name, code = item.rsplit(":", 1)
        fields.append(StructField(name, _T[code], nullable=(name != key)))
    return StructType(fields)


STAR_SCHEMAS: dict[str, StructType] = {
    "dim_service_types": _schema(
        "type_id:L description:S office_id:L reservice:B initial:B regular_service:B frequency:L "
        "billing_frequency:L default_charge:D category:S is_inspection:B loaded_at:t", "type_id"),
    "dim_employees": _schema(
        "employee_id:L first_name:S last_name:S nickname:S initials:S office_id:L emp_type:L "
        "active:B email:S loaded_at:t", "employee_id"),
    "dim_products": _schema(
        "product_id:L description:S code:S category:S unit_cost:D office_id:L taxable:B loaded_at:t",
        "product_id"),
    "dim_customers": _schema(
        "customer_id:L first_name:S last_name:S company_name:S email:S phone1:S address:S city:S "
        "state:S zip:S office_id:L active:B commercial_account:B date_added:d date_cancelled:d "
        "source:S bill_to_account_id:L auto_pay:B loaded_at:t", "customer_id"),
    "dim_subscriptions": _schema(
        "subscription_id:L customer_id:L office_id:L service_type_id:L service_type:S "
        "recurring_charge:D initial_charge:D frequency:L next_service:d last_service:d date_added:d "
        "date_cancelled:d active:B loaded_at:t", "subscription_id"),
    "fact_appointments": _schema(
        "appointment_id:L customer_id:L subscription_id:L ticket_id:L office_id:L route_id:L "
        "sequence:L assigned_tech_id:L route_tech_id:L serviced_by_id:L additional_tech_ids:S "
        "service_type_id:L scheduled_date:d date_completed:t time_in:t time_out:t "
        "duration_scheduled_min:L duration_actual_min:D status:L status_text:S is_initial:B "
        "production_value:D amount_collected:D reservice_reason_id:L lat_in:D lng_in:D "
        "temperature:D wind_speed:D wind_direction:S date_added:t date_updated:t loaded_at:t",
        "appointment_id"),
    "fact_tickets": _schema(
        "ticket_id:L appointment_id:L customer_id:L subscription_id:L office_id:L service_id:L "
        "invoice_date:d date_created:t date_updated:t subtotal:D tax_amount:D total:D balance:D "
        "production_value:D active:B loaded_at:t", "ticket_id"),
    "fact_ticket_items": _schema(
        "item_id:L ticket_id:L office_id:L description:S quantity:D amount:D product_id:L "
        "service_id:L taxable:B loaded_at:t", "item_id"),
    "sync_health": _schema(
        "run_at:t office_id:L office_name:S status:S error_message:S lookback_days:L "
        "appointments_synced:L tickets_synced:L ticket_items_synced:L customers_synced:L "
        "subscriptions_synced:L", None),
}

# Raw field names per entity, as the source API names them. Every value is
# landed as a string; nothing is inferred.
RAW_FIELDS: dict[str, tuple[str, ...]] = {
    "serviceType": ("typeID", "description", "officeID", "reservice", "initial", "regularService",
                    "frequency", "billingFrequency", "defaultCharge", "category"),
    "employee": ("employeeID", "fname", "lname", "nickname", "initials", "officeID", "type",
                 "active", "email"),
    "product": ("productID", "description", "code", "category", "amount", "officeID", "taxable"),
    "customer": ("customerID", "fname", "lname", "companyName", "email", "phone1", "phone2",
                 "address", "city", "state", "zip", "officeID", "active", "commercialAccount",
                 "dateAdded", "dateCancelled", "source", "billToAccountID", "aPay", "dateUpdated"),
    "subscription": ("subscriptionID", "customerID", "officeID", "serviceID", "serviceType",
                     "recurringCharge", "initialCharge", "frequency", "nextService", "lastService",
                     "dateAdded", "dateCancelled", "active", "dateUpdated"),
    "appointment": ("appointmentID", "customerID", "subscriptionID", "ticketID", "officeID",
                    "routeID", "sequence", "assignedTech", "servicedBy", "additionalTechs", "type",
                    "date", "dateCompleted", "timeIn", "timeOut", "duration", "status",
                    "statusText", "isInitial", "productionValue", "amountCollected",
                    "reserviceReasonID", "latIn", "longIn", "temperature", "windSpeed",
                    "windDirection", "dateAdded", "dateUpdated"),
    "route": ("routeID", "officeID", "date", "assignedTech"),
    "ticket": ("ticketID", "appointmentID", "customerID", "subscriptionID", "officeID",
               "serviceID", "invoiceDate", "dateCreated", "dateUpdated", "subTotal", "taxAmount",
               "total", "balance", "productionValue", "active"),
}

RAW_ITEM_FIELDS = ("itemID", "description", "quantity", "amount", "productID", "serviceID",
                   "taxable")


def raw_schema(entity: str) -> StructType:
    """All-string landing schema; tickets carry their items as an array."""
    fields = [StructField(f, StringType()) for f in RAW_FIELDS[entity]]
    if entity == "ticket":
        item = StructType([StructField(f, StringType()) for f in RAW_ITEM_FIELDS])
        fields.append(StructField("items", ArrayType(item)))
    return StructType(fields)
