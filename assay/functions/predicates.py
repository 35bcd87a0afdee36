"""Column predicates: validators, patterns and the null policies of the checks."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that decide which rows are valid.
EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}\z"
NINO = r"^[A-CEGHJ-PR-TW-Z][A-CEGHJ-NPR-TW-Z][0-9]{6}[A-D]\z"
PLAIN_TEXT = r"^[a-zA-Z0-9\s]*\z"
DATE_LENIENT = r"^\d{4}-\d{1,2}-\d{1,2}\z"


def is_date(c: Column) -> Column:
    """A real ``YYYY-M-D`` date, leading zeros optional; null stays null."""
    real = c.rlike(DATE_LENIENT) & F.try_to_timestamp(c, F.lit("yyyy-M-d")).isNotNull()
    return F.when(c.isNotNull(), real)


def is_email(c: Column) -> Column:
    return c.rlike(EMAIL)


def is_nino(c: Column) -> Column:
    """UK National Insurance number shape."""
    return c.rlike(NINO)


def in_range(c: Column, low, high) -> Column:
    """Inclusive on both ends; null is not in range."""
    return F.coalesce(c.between(low, high), F.lit(False))


def null_fails(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def null_passes(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(True))


def not_blank(c: Column) -> Column:
    """Something is left after stripping white space of any kind; null is blank."""
    return null_fails(F.length(F.regexp_replace(c, r"^\s+|\s+\z", "")) > 0)


def plain_text(c: Column) -> Column:
    """Only letters, digits and white space; null passes."""
    return null_passes(c.rlike(PLAIN_TEXT))
