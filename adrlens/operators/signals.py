"""Disproportionality signals over drug-event pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from adrlens.functions import disproportionality as dp
from adrlens.functions.matching import first_bits, names_of_bits
from adrlens.operators.margins import attach_totals
from adrlens.study import SIGNAL_COHORTS, SignalThresholds, Study

ALL_COHORTS = "ALL"


def contingency(facts: DataFrame, study: Study, min_cases: int = 1) -> DataFrame:
    """Cells a, b, c, d per cohort, drug class and event, with the mean severity of rows.

    Facts are first added up per combination of classes, of which there are few, and only
    those sums are unfolded: each counts for its drug classes and for "any class" (null
    drug).  Facts without an event are the case rows, so cells and margins come from one
    aggregate.  Only observed pairs form a cell.
    """
    combinations = (
        facts.groupBy("cohort", "adr", "is_case",
                      first_bits(F.col("bits"), len(study.drug_classes)).alias("bits"))
        .agg(F.count("*").alias("n"), F.sum("n_rows").alias("n_rows"),
             F.sum(F.col("n_rows") * F.col("severity")).alias("severity_sum"))
    )
    drugs = F.concat(names_of_bits(F.col("bits"), study.drug_classes),
                     F.array(F.lit(None).cast("string")))
    sums = ("n", "n_rows", "severity_sum")
    counts = (
        combinations.select("cohort", "adr", "is_case", *sums, F.explode(drugs).alias("drug"))
        .groupBy("cohort", "drug", "adr", "is_case").agg(*[F.sum(c).alias(c) for c in sums])
    )
    n, is_case, any_drug = F.col("n"), F.col("is_case"), F.col("drug").isNull()
    margins = {
        "n_adr": (["cohort", "adr"], F.when(~is_case & any_drug, n)),
        "n_drug": (["cohort", "drug"], F.when(is_case & ~any_drug, n)),
        "n_total": (["cohort"], F.when(is_case & any_drug, n)),
    }
    return (
        attach_totals(counts, margins, is_case, "adr")
        .where(~is_case & ~any_drug & (n >= min_cases))
        .select("cohort", "drug", "adr", n.alias("a"), (F.col("n_drug") - n).alias("b"),
                (F.col("n_adr") - n).alias("c"),
                (F.col("n_total") - F.col("n_drug") - F.col("n_adr") + n).alias("d"),
                (F.col("severity_sum") / F.col("n_rows")).alias("avg_severity"))
    )


def is_signal(ror_lower: Column, prr: Column, ic_lower: Column, limits: SignalThresholds) -> Column:
    return ((ror_lower >= limits.ror_lower_ci) & (prr >= limits.prr)
            & (ic_lower >= limits.ic_lower_ci))


def score_cells(cells: DataFrame, limits: SignalThresholds) -> DataFrame:
    """Gate 2x2 tables and compute ROR, PRR and IC with their bounds."""
    abcd = [F.col(x) for x in "abcd"]
    ror, ror_lo, ror_hi = dp.reporting_odds_ratio(*abcd)
    prr, prr_lo, prr_hi = dp.proportional_reporting_ratio(*abcd)
    ic, ic_lo, ic_hi = dp.information_component(*abcd)
    return (
        cells.where((F.col("a") >= limits.min_cases) & (F.least("b", "c", "d") > 0))
        .select("drug", "adr", "cohort", F.col("a").alias("n_cases"),
                ror.alias("ror"), ror_lo.alias("ror_lower_ci"), ror_hi.alias("ror_upper_ci"),
                prr.alias("prr"), prr_lo.alias("prr_lower_ci"), prr_hi.alias("prr_upper_ci"),
                ic.alias("ic"), ic_lo.alias("ic_025"), ic_hi.alias("ic_975"),
                is_signal(ror_lo, prr, ic_lo, limits).alias("is_signal"), "avg_severity")
    )


def detect_signals(facts: DataFrame, study: Study,
                   cohorts: Sequence[str] | None = SIGNAL_COHORTS) -> DataFrame:
    """Signals of each named cohort in one run, or of all pairs pooled (``cohorts=None``)."""
    if cohorts is None:
        facts = facts.withColumn("cohort", F.lit(ALL_COHORTS))
    else:
        facts = facts.where(F.col("cohort").isin(*cohorts))
    limits = study.thresholds
    return score_cells(contingency(facts, study, limits.min_cases), limits)


def by_strength(signals: DataFrame) -> DataFrame:
    """Signals by cohort, strongest first."""
    return signals.orderBy("cohort", F.desc("ror"), "drug", "adr")


def top_signals(signals: DataFrame, n: int = 20) -> DataFrame:
    """The n strongest signals with error-bar widths and short labels."""
    return (
        signals.where("is_signal").orderBy(F.desc("ror"), "drug", "adr", "cohort").limit(n)
        .select("drug", "adr", "cohort", "n_cases", "ror", "ror_lower_ci", "ror_upper_ci",
                "avg_severity",
                (F.col("ror") - F.col("ror_lower_ci")).alias("err_lower"),
                (F.col("ror_upper_ci") - F.col("ror")).alias("err_upper"),
                F.substring("drug", 1, 15).alias("drug_label"),
                F.substring("adr", 1, 40).alias("adr_label"))
    )


def top_signals_per_cohort(signals: DataFrame, n: int = 10) -> DataFrame:
    """The n strongest signals of each cohort."""
    order = Window.partitionBy("cohort").orderBy(F.desc("ror"), "drug", "adr")
    return (
        signals.where("is_signal")
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
        .select("cohort", "rank", "drug", "adr", "n_cases", "ror")
    )


def signals_per_cohort(signals: DataFrame) -> DataFrame:
    return signals.groupBy("cohort").agg(
        F.count("*").alias("n_combinations"),
        F.sum(F.col("is_signal").cast("long")).alias("n_signals"))


def drug_risk_scores(signals: DataFrame) -> DataFrame:
    """Mean ROR per drug over every row, signal or not."""
    return signals.groupBy("drug").agg(F.avg("ror").alias("risk_score"))


def risk_score_lines(scores: DataFrame) -> DataFrame:
    """Scores as text lines, one per drug, for the score file."""
    return scores.orderBy("drug").select(
        F.format_string("'%s': %.4f,", "drug", "risk_score").alias("line"))
