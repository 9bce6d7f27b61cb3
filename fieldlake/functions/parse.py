"""Safe parsing of raw string fields (the C0 rules) as column expressions.

The source API returns strings, empty strings for missing numbers and
``0000-…`` for missing dates. One bad value must never fail a load: it
becomes the field's default. Every rule is a plain Spark expression, so the
conform jobs stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace removed by a text strip: the characters Python's str.strip()
# removes (str.isspace() holds for them; none lies above U+3000).
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

INT_PATTERN = r"^[ \t]*[+-]?[0-9]+[ \t]*$"
DATE_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIMESTAMP_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T].*)?$"
FLOAT_PATTERN = r"^[ \t]*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?[ \t]*$"


def _lit(v):
    return v if isinstance(v, Column) else F.lit(v)


def strip(x: Column) -> Column:
    """NULL → '' then strip surrounding whitespace."""
    return F.btrim(F.coalesce(x, F.lit("")), F.lit(WHITESPACE))


def to_int(x: Column, default=None) -> Column:
    """Integer text → BIGINT; NULL, '', '1.0' or any non-integer → default.
    The pattern check runs first: a failing ANSI try_cast costs a caught
    exception per value, which is far slower than the regex on raw data
    full of blanks."""
    v = F.when(x.rlike(INT_PATTERN), F.btrim(x, F.lit(" \t")).try_cast("long"))
    return v if default is None else F.coalesce(v, _lit(default).cast("long"))


def to_float(x: Column, default=None) -> Column:
    """Decimal text → DOUBLE; anything else (including '1d', 'n/a') → default."""
    v = F.when(x.rlike(FLOAT_PATTERN), F.btrim(x, F.lit(" \t")).try_cast("double"))
    return v if default is None else F.coalesce(v, _lit(default).cast("double"))


def to_date(x: Column) -> Column:
    """First 10 characters as a DATE; empty, '0000…', a part of a date or an
    invalid one → NULL."""
    day = F.substring(x, 1, 10)
    return F.when(day.rlike(DATE_PATTERN) & ~x.startswith("0000"), day.try_cast("date"))


def to_timestamp(x: Column) -> Column:
    """'YYYY-MM-DD HH:MM:SS' (or with 'T') → TIMESTAMP (UTC); '0000…' or a
    text that does not begin with a whole date → NULL."""
    whole = x.rlike(TIMESTAMP_PATTERN) & ~x.startswith("0000")
    return F.when(whole, F.translate(x, " ", "T").try_cast("timestamp"))


def strict_timestamp(x: Column) -> Column:
    """Exactly 'YYYY-MM-DD HH:MM:SS' in the first 19 characters, else NULL."""
    s = F.substring(x, 1, 19)
    return F.when(s.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$")
                  & ~x.startswith("0000"),
                  F.translate(s, " ", "T").try_cast("timestamp"))


def flag(x: Column) -> Column:
    """Boolean flag: the text is exactly '1'."""
    return F.coalesce(x == F.lit("1"), F.lit(False))


def yes(x: Column, default: str = "No") -> Column:
    return F.lower(strip(F.coalesce(x, F.lit(default)))) == F.lit("yes")


def not_blank(x: Column) -> Column:
    """Raw value is present and not only whitespace."""
    return x.isNotNull() & (strip(x) != F.lit(""))
