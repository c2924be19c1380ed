"""Free text -> typed columns.

Two parser profiles exist because two generations of published tables disagree
on purpose: the *canonical* one reads every separator in a price as a thousands
mark, the *full refresh* one strips commas only. Both are kept bit-compatible.

All casts go through ``try_cast``: under ANSI mode a malformed value must
become NULL and be judged by the quality rules, never fail the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns define the published numbers.
PRICE_DIGITS = r"([0-9][0-9.,]*)"
LEADING_DECIMAL = r"^\s*(\d+(?:[.,]\d+)?)"
RANGE_END_DECIMAL = r"(?i)(?:a|-)\s*(\d+(?:[.,]\d+)?)"
LEADING_INTEGER = r"^\s*(\d+)"
RANGE_END_INTEGER = r"(?i)(?:a|-)\s*(\d+)"
GROUPED_NUMBER = r"(\d+(?:[.,]\d+)*)"
VALUE_OR_RANGE = r"(\d+(?:\s*a\s*\d+)?)\s*"
FEATURE_UNITS = {
    "area_raw": "m²",
    "bedrooms_raw": "dorm",
    "bathrooms_raw": "baño",
    "units_raw": r"un\.",
}
DOLLAR_TEXT = r"(?i)US\$|USD"
SOL_TEXT = r"(?i)S/|PEN"
KNOWN_CURRENCIES = ("PEN", "USD")


def matched(text: Column, pattern: str) -> Column:
    """First capture group of ``pattern``, '' without a match.

    Integer parsers use this form: ``try_cast`` turns '' into NULL cheaply. For
    doubles it would raise and catch an exception per row, so those parsers take
    ``first_match``.
    """
    return F.regexp_extract(text, pattern, 1)


def first_match(text: Column, pattern: str) -> Column:
    """First capture group of ``pattern`` or NULL (also for NULL text)."""
    return F.nullif(matched(text, pattern), F.lit(""))


# --- canonical profile ------------------------------------------------------


def price_amount(price_min: Column, price_raw: Column) -> Column:
    """SI4: exposed numeric minimum, else all digits of the first number."""
    digits = F.translate(first_match(price_raw, PRICE_DIGITS), ",.", "")
    return F.coalesce(price_min.cast("double"), digits.try_cast("double"))


def price_currency(price_raw: Column, currency: Column) -> Column:
    """SI5: the price text decides, then the exposed currency code."""
    code = F.upper(F.trim(currency))
    return (
        F.when(price_raw.rlike(DOLLAR_TEXT), "USD")
        .when(price_raw.rlike(SOL_TEXT), "PEN")
        .when(code.isin(*KNOWN_CURRENCIES), code)
    )


def _decimal(text: Column) -> Column:
    return F.translate(text, ",", ".").try_cast("double")


def area_min(area_raw: Column) -> Column:
    """SI6: leading number, comma or dot as decimal mark."""
    return _decimal(first_match(area_raw, LEADING_DECIMAL))


def area_max(area_raw: Column, lower_end: Column) -> Column:
    """SI6: number after ``a`` or ``-``, else the minimum."""
    return F.coalesce(_decimal(first_match(area_raw, RANGE_END_DECIMAL)), lower_end)


def bedrooms_min(bedrooms_raw: Column, searched: Column, path_segment: Column) -> Column:
    """SI8: text, then the search parameter, then the landing path."""
    return F.coalesce(leading_integer(bedrooms_raw), searched, path_segment)


def bedrooms_max(bedrooms_raw: Column, lower_end: Column) -> Column:
    """SI8: end of the range text, else the minimum."""
    return F.coalesce(matched(bedrooms_raw, RANGE_END_INTEGER).try_cast("int"), lower_end)


def leading_integer(text: Column) -> Column:
    """SI8/SI9: integer at the start of the text."""
    return matched(text, LEADING_INTEGER).try_cast("int")


def place_name(text: Column, default: str) -> Column:
    """SI10: title case; only NULL takes the default, '' stays ''."""
    return F.coalesce(F.initcap(F.lower(F.trim(text))), F.lit(default))


def unit_price(price: Column, area_avg: Column) -> Column:
    """SI14: price per square metre when both are positive."""
    return F.when((price > 0) & (area_avg > 0), price / area_avg)


# --- full-refresh profile ---------------------------------------------------


def grouped_number(text: Column, pattern: str = GROUPED_NUMBER) -> Column:
    """SR1: first match with commas removed, as double."""
    return F.replace(first_match(text, pattern), F.lit(","), F.lit("")).try_cast("double")


def grouped_range_end(text: Column, fallback: Column) -> Column:
    """SR4: number after a lower-case ``a``, else ``fallback``."""
    return F.coalesce(grouped_number(text, r"a\s*" + GROUPED_NUMBER), fallback)


def refresh_currency(price_raw: Column, currency: Column) -> Column:
    """SR2: case-sensitive text test, default PEN."""
    return (
        F.when(price_raw.rlike(r"US\$"), "USD")
        .when(price_raw.rlike(r"S/\.?"), "PEN")
        .otherwise(F.coalesce(currency, F.lit("PEN")))
    )


# --- card text --------------------------------------------------------------


def feature_part(features_text: Column, field: str) -> Column:
    """BR1: value (or ``x a y`` range) standing before the field's unit token."""
    return first_match(features_text, VALUE_OR_RANGE + FEATURE_UNITS[field])
