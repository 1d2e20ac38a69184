"""Cleaning of raw string columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# Text read as missing.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Age unit -> (multiplier, divisor) to years; other units count as years.
AGE_UNITS = {"DEC": (10, 1), "MON": (1, 12), "WK": (1, 52), "DY": (1, 365), "HR": (1, 8760)}
MAX_AGE_YEARS = 120

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def null_tokens(value: Column, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    return F.when(~value.isin(*tokens), value)


def to_number(value: Column) -> Column:
    """Double of a plain decimal number, else null.

    The pattern comes first because a SQL cast also accepts type suffixes such as ``1d``.
    """
    return F.when(value.rlike(_NUMBER), F.trim(value).try_cast("double"))


def age_in_years(age: Column, unit: Column) -> Column:
    """Age converted to years; outside 0..120 it is null."""
    years = age
    for code, (times, parts) in AGE_UNITS.items():
        years = F.when(unit == code, age * F.lit(float(times)) / F.lit(float(parts))).otherwise(years)
    return F.when(years.between(0, MAX_AGE_YEARS), years)


def report_date(value: Column) -> Column:
    """Date of an eight-digit yyyymmdd text, else null."""
    return F.when(value.rlike(r"^\d{8}$"), F.try_to_date(value, "yyyyMMdd"))


def tidy_code(value: Column) -> Column:
    """Upper case without white space of any kind at either end."""
    return F.regexp_replace(F.upper(value), r"(?U)^\s+|\s+$", "")
