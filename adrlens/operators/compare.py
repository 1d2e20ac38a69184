"""Event frequencies of the two main cohorts side by side."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from adrlens.functions import association as assoc
from adrlens.functions.matching import count_bits
from adrlens.operators.margins import attach_totals
from adrlens.study import COINFECTION, MAIN_COHORTS, MONO, Study


def compare_cohorts(facts: DataFrame, study: Study) -> DataFrame:
    """Record counts, proportions, risk ratio and test per event of either main cohort.

    Counts are pair rows: a reaction row counts once per drug class of its case.  The
    case row of a fact table carries all rows of its case, with or without an event, so
    the case rows add up to the cohort totals.
    """
    records = F.col("n_rows") * count_bits(F.col("bits"), len(study.drug_classes))

    def of(cohort: str):
        return F.sum(F.when(F.col("cohort") == cohort, records).otherwise(0))

    counts = (facts.where(F.col("cohort").isin(*MAIN_COHORTS))
              .groupBy("adr", "is_case")
              .agg(of(MONO).alias("k1"), of(COINFECTION).alias("k2")))
    is_case = F.col("is_case")
    totals = {"n1": ([], F.when(is_case, F.col("k1"))), "n2": ([], F.when(is_case, F.col("k2")))}
    p1, p2 = F.col("hbv_mono_prop"), F.col("hiv_hbv_prop")
    return (
        attach_totals(counts, totals, is_case, "adr")
        .where(~is_case & (F.col("n1") > 0) & (F.col("n2") > 0))
        .select("adr", F.col("k1").alias("hbv_mono_count"),
                assoc.proportion(F.col("k1"), F.col("n1")).alias("hbv_mono_prop"),
                F.col("k2").alias("hiv_hbv_count"),
                assoc.proportion(F.col("k2"), F.col("n2")).alias("hiv_hbv_prop"),
                assoc.yates_chi2(F.col("k1"), F.col("n1"), F.col("k2"), F.col("n2")).alias("chi2"))
        .select("adr", "hbv_mono_count", "hbv_mono_prop", "hiv_hbv_count", "hiv_hbv_prop",
                assoc.risk_ratio(p1, p2).alias("risk_ratio"), "chi2",
                assoc.chi2_p_value(F.col("chi2")).alias("p_value"))
    )


def by_risk_ratio(comparison: DataFrame) -> DataFrame:
    return comparison.orderBy(F.desc_nulls_last("risk_ratio"), "adr")


def risk_ratio_extremes(comparison: DataFrame, n: int = 10) -> DataFrame:
    """The n events most over-represented in either cohort."""
    known = comparison.where("risk_ratio IS NOT NULL").select("adr", "risk_ratio", "p_value")
    high = known.orderBy(F.desc("risk_ratio"), "adr").limit(n)
    low = known.orderBy("risk_ratio", "adr").limit(n)
    return high.withColumn("side", F.lit(MONO)).unionByName(
        low.withColumn("side", F.lit(COINFECTION)))


def largest_differences(comparison: DataFrame, n: int = 30) -> DataFrame:
    """The n events with the largest absolute log2 risk ratio, proportions in percent.

    A risk ratio of zero is infinitely far from one and ranks first.
    """
    return (
        comparison.where("risk_ratio IS NOT NULL")
        .withColumn("abs_diff", F.abs(assoc.log2_or_infinity(F.col("risk_ratio"))))
        .orderBy(F.desc("abs_diff"), "adr").limit(n)
        .select("adr", (F.col("hbv_mono_prop") * 100).alias("hbv_mono_pct"),
                (F.col("hiv_hbv_prop") * 100).alias("hiv_hbv_pct"), "abs_diff")
    )


def volcano(comparison: DataFrame) -> DataFrame:
    """Effect size against significance; events with an infinite or missing value left out."""
    x, y = F.col("log2_rr"), F.col("neg_log10_p")
    return (
        comparison
        .withColumn("log2_rr", assoc.log2_or_infinity(F.col("risk_ratio")))
        .withColumn("neg_log10_p", assoc.negative_log10(F.col("p_value")))
        .where(assoc.is_finite(x) & assoc.is_finite(y))
        .select("adr", "log2_rr", "neg_log10_p", "p_value",
                assoc.volcano_class(x, F.col("p_value")).alias("volcano_class"))
    )


def volcano_labels(points: DataFrame, n: int = 5) -> DataFrame:
    """The n most significant events among those enriched on each side."""
    side = Window.partitionBy("volcano_class").orderBy(F.desc("neg_log10_p"), "adr")
    return (
        points.where(F.col("volcano_class").startswith("enriched"))
        .withColumn("rank", F.row_number().over(side)).where(F.col("rank") <= n)
        .select("volcano_class", "rank", "adr", F.substring("adr", 1, 20).alias("adr_label"),
                "log2_rr", "neg_log10_p")
    )
