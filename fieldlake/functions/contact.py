"""Contact-field normalisation as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldlake.functions.parse import strip

# A deliverable-looking address: one '@', no whitespace, a dot in the domain.
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"


def e164(raw: Column) -> Column:
    """US phone → '+1XXXXXXXXXX': 10 digits get '+1', 11 digits starting
    with 1 get '+'; anything else (or empty) → NULL."""
    digits = F.regexp_replace(F.coalesce(raw, F.lit("")), r"[^0-9]", "")
    n = F.length(digits)
    return (F.when(n == 10, F.concat(F.lit("+1"), digits))
            .when((n == 11) & digits.startswith("1"), F.concat(F.lit("+"), digits)))


def best_phone(phone1: Column, phone2: Column) -> Column:
    """First of phone1, phone2 that formats."""
    return F.coalesce(e164(phone1), e164(phone2))


def clean_email(raw: Column, first_of_list: bool = False) -> Column:
    """Trimmed, lower-cased; blank → NULL. With ``first_of_list`` only the
    first address of a ';' or ',' separated list is kept."""
    e = strip(raw)
    if first_of_list:
        e = strip(F.split(e, "[;,]").getItem(0))
    return F.nullif(F.lower(e), F.lit(""))


def valid_email(email: Column) -> Column:
    return email.rlike(EMAIL_PATTERN)


def blank_to_null(x: Column) -> Column:
    return F.nullif(strip(x), F.lit(""))
