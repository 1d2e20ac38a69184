"""Drug exposure per case and treatment cohorts.

Exposure is one small integer per case: a bit for each antiviral class, then one for HIV
drugs and one for immunosuppressants.  All id sets, their intersections and differences
are bit tests on that integer, so the drug table is scanned and shuffled once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from adrlens.functions.matching import first_bits, group_bits, has_bit, names_of_bits
from adrlens.operators.cases import DRUG_TEXT
from adrlens.study import (AUTOIMMUNE, COHORT_ORDER, COINFECTION, MONO, OTHER, UNKNOWN_COHORT,
                           Study)

HIV, IMMUNO = "HIV", "IMMUNOSUPPRESSANT"
ANY_ANTIVIRAL = "ANY_ANTIVIRAL"


def drug_groups(study: Study) -> dict[str, Sequence[str]]:
    return {**study.drug_classes, HIV: study.hiv_drugs, IMMUNO: study.immunosuppressants}


def row_bits(study: Study) -> Column:
    return group_bits(DRUG_TEXT, drug_groups(study), study.match)


def antiviral(bits: Column, study: Study) -> Column:
    return first_bits(bits, len(study.drug_classes)) != 0


def exposures(drug: DataFrame, study: Study) -> DataFrame:
    """(primaryid, bits): the drug groups of every case that has any."""
    return (drug.select("primaryid", row_bits(study).alias("bits"))
            .where("bits != 0 AND primaryid IS NOT NULL")
            .groupBy("primaryid").agg(F.bit_or("bits").alias("bits")))


def cohort_tests(bits: Column, study: Study) -> dict[str, Column]:
    """Condition of each cohort on the exposure bits (0 or null bits: no exposure)."""
    bits = F.coalesce(bits, F.lit(0))
    exposed = antiviral(bits, study)
    hiv = has_bit(bits, len(study.drug_classes))
    immuno = has_bit(bits, len(study.drug_classes) + 1)
    return {
        MONO: exposed & ~hiv,
        COINFECTION: exposed & hiv,
        AUTOIMMUNE: exposed & immuno & ~hiv,
        OTHER: ~exposed,
    }


def first_cohort(bits: Column, study: Study, precedence: Sequence[str] = COHORT_ORDER) -> Column:
    """The first cohort in ``precedence`` that holds the case."""
    tests = cohort_tests(bits, study)
    chain = F
    for name in precedence:
        chain = chain.when(tests[name], F.lit(name))
    return chain.otherwise(F.lit(UNKNOWN_COHORT))


def all_cohorts(bits: Column, study: Study) -> Column:
    """Array of every cohort that holds the case (an autoimmune case has two)."""
    return F.array_compact(F.array(
        *[F.when(test, F.lit(name)) for name, test in cohort_tests(bits, study).items()]))


def assign_cohorts(demo: DataFrame, exposed: DataFrame, study: Study) -> DataFrame:
    """(primaryid, cohort), one row per cohort of a case.

    Antiviral cohorts come from the drug table, the rest from demographics without
    antivirals; both sides are one row per case, so one full join serves all cohorts.
    """
    ids = demo.select("primaryid").where(F.col("primaryid").isNotNull()).distinct()
    return (
        ids.withColumn("in_demo", F.lit(True))
        .join(exposed, "primaryid", "full_outer")
        .where(F.col("in_demo") | antiviral(F.col("bits"), study))
        .select("primaryid", F.explode(all_cohorts(F.col("bits"), study)).alias("cohort"))
    )


def cohort_sizes(assignments: DataFrame) -> DataFrame:
    return assignments.groupBy("cohort").agg(F.count("*").alias("n_cases"))


def exposure_counts(exposed: DataFrame, study: Study) -> DataFrame:
    """Exposed cases per drug group, with one row for any antiviral class."""
    bits = F.col("bits")
    groups = F.concat(
        names_of_bits(bits, drug_groups(study)),
        F.when(antiviral(bits, study), F.array(F.lit(ANY_ANTIVIRAL)))
        .otherwise(F.array().cast("array<string>")))
    return (exposed.select(F.explode(groups).alias("drug_group"))
            .groupBy("drug_group").agg(F.count("*").alias("n_cases")))
