"""Clinical codings used by features, severity and scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or null."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def lookup(key: Column, mapping: Mapping[str, object], default: object) -> Column:
    """Small dictionary as a ``when`` chain: keys with the same value share a branch."""
    by_value: dict[object, list[str]] = {}
    for k, v in mapping.items():
        by_value.setdefault(v, []).append(k)
    otherwise = default if isinstance(default, Column) else F.lit(default)
    chain = F
    for value, keys in by_value.items():
        chain = chain.when(key.isin(*keys), F.lit(value))
    return chain.otherwise(otherwise)


def severity_grade(code: Column, grades: Mapping[str, int]) -> Column:
    """Grade 1..5 of an outcome code; unknown or missing codes are grade 1."""
    return lookup(code, grades, 1)


def outcome_name(code: Column, names: Mapping[str, str]) -> Column:
    """Name of an outcome code; an unknown code stands for itself."""
    return lookup(code, names, code)


def age_category(years: Column) -> Column:
    return (F.when(years.isNull(), "Unknown").when(years < 18, "<18").when(years < 41, "18-40")
            .when(years < 66, "41-65").otherwise(">65"))


def region_of(country: Column, regions: Mapping[str, Sequence[str]]) -> Column:
    return lookup(country, {c: region for region, cs in regions.items() for c in cs}, "Other")


def polypharmacy_category(count: Column) -> Column:
    return (F.when(count <= 2, "1-2_drugs").when(count <= 5, "3-5_drugs")
            .when(count > 5, "6+_drugs"))


def risk_band(percent: Column) -> Column:
    return F.when(percent > 50, "High").when(percent > 30, "Medium").otherwise("Low")


def in_terms(text: Column, terms: Sequence[str]) -> Column:
    """Exact, case-insensitive membership."""
    return F.upper(text).isin(*[t.upper() for t in terms])


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda x, y: x | y, conditions)
