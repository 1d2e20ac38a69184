"""Outcome severity per case and severity profile per cohort."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from adrlens.functions.clinical import severity_grade
from adrlens.study import MAIN_COHORTS, Study

GRADES = (1, 2, 3, 4, 5)


def case_severity(outc: DataFrame, study: Study) -> DataFrame:
    """(primaryid, severity): the highest outcome grade of each case."""
    grade = severity_grade(F.col("outc_cod"), study.severity_grades)
    return (outc.where(F.col("primaryid").isNotNull()).groupBy("primaryid")
            .agg(F.max(grade).alias("severity")))


def _median_of_counts(counts: dict[int, Column]) -> Column:
    """Exact median of a value whose row counts are columns, values ascending."""
    total = reduce(lambda x, y: x + y, counts.values())

    def value_at(position: Column) -> Column:
        chain, seen = F, F.lit(0)
        for value, n in counts.items():
            seen = seen + n
            chain = chain.when(position <= seen, F.lit(float(value)))
        return chain

    low, high = F.floor((total + 1) / 2), F.ceil((total + 1) / 2)
    return (value_at(low) + value_at(high)) / 2


def severity_profile(case_records: DataFrame) -> DataFrame:
    """Cases, records, mean and median grade and grade counts per cohort.

    ``case_records`` has one row per case: cohort, severity, n_records.  Everything is a
    sum, so the aggregate is combined before the shuffle and holds one row per cohort.
    """
    def records(grade: int) -> Column:
        return F.sum(F.when(F.col("severity") == grade, F.col("n_records")).otherwise(0))

    counts = {g: F.col(f"severity_{g}_count") for g in GRADES}
    return (
        case_records.groupBy("cohort").agg(
            F.count("*").alias("n_cases"),
            F.sum("n_records").alias("n_adr_records"),
            F.sum(F.col("severity") * F.col("n_records")).alias("_total"),
            *[records(g).alias(f"severity_{g}_count") for g in GRADES])
        .select("cohort", "n_cases", "n_adr_records",
                (F.col("_total") / F.col("n_adr_records")).alias("mean_severity"),
                _median_of_counts(counts).alias("median_severity"),
                *[f"severity_{g}_count" for g in GRADES])
    )


def main_cohorts_only(profile: DataFrame, cohorts: Sequence[str] = MAIN_COHORTS) -> DataFrame:
    return profile.where(F.col("cohort").isin(*cohorts))
