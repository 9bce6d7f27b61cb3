"""Business codes shared by the views and operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the source system's codes.
OFFICE_RESIDENTIAL = 1
OFFICE_COMMERCIAL = 2
ORPHAN_ID = -1

STATUS_PENDING = 0
STATUS_COMPLETE = 1
STATUS_CANCELLED = -1
STATUS_RESCHEDULED = -2

FREQUENCY_CUSTOM = -2

# The five service-type names flagged as inspections (fixed values).
INSPECTION_NAMES = (
    "Rodent Inspection",
    "Pigeon Inspection",
    "Bed Bug Inspection",
    "Bed Bug Room Inspection",
    "Pest Control Inspection",
)


def office_name(office_id: Column) -> Column:
    """1 Residential, 2 Commercial, anything else (NULL too) Unknown."""
    return (F.when(office_id == OFFICE_RESIDENTIAL, F.lit("Residential"))
            .when(office_id == OFFICE_COMMERCIAL, F.lit("Commercial"))
            .otherwise(F.lit("Unknown")))


def person_name(first: Column, last: Column, fallback_id: Column) -> Column:
    """CONCAT(first, ' ', last) — NULL if either is NULL — else the id as text."""
    return F.coalesce(F.concat(first, F.lit(" "), last), fallback_id.cast("string"))


def customer_display_name(company: Column, first: Column, last: Column) -> Column:
    """Company name when non-empty, else 'first last' (NULL-propagating)."""
    return F.coalesce(F.nullif(company, F.lit("")), F.concat(first, F.lit(" "), last))


def production_value(ticket_production: Column, ticket_total: Column) -> Column:
    """Explicit production value when >= 0, else the ticket total (NULL too)."""
    return F.when(ticket_production >= 0, ticket_production).otherwise(ticket_total)
