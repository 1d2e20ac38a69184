"""Feature table for the risk models, at two grains.

``case_drug``: one row per case, cohort and drug class, missing values as 0 (text '0').
``case``: one row per case with multi-hot cohort and drug flags and imputed age.

Each source table is reduced to one row per case before any join, so the joins meet on
unique keys and the fan-out to cohorts and classes is an explode.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from adrlens.functions import cleaning, clinical
from adrlens.functions.clinical import flag
from adrlens.functions.matching import has_bit, names_of_bits
from adrlens.operators.cohorts import (all_cohorts, antiviral, assign_cohorts, exposures,
                                       row_bits)
from adrlens.operators.pairs import reaction_counts
from adrlens.operators.profiles import distributions
from adrlens.session import materialise
from adrlens.sources.case_tables import CaseTables
from adrlens.study import AUTOIMMUNE, COINFECTION, MONO, Study

GRAINS = ("case_drug", "case")
COHORT_FLAGS = {"cohort_hbv_mono": MONO, "cohort_hiv_hbv": COINFECTION,
                "cohort_autoimmune": AUTOIMMUNE}
DEFAULT_RISK_SCORE = 1.0
MEDIAN_BINS = 4_096


def demographic_features(demo: DataFrame, study: Study) -> DataFrame:
    """Age, sex, region and reporter columns of cleaned demographics."""
    years = cleaning.to_number(F.col("age_years").cast("string"))
    sex, country, reporter = (F.coalesce(c, F.lit("Unknown"))
                              for c in ("sex", "reporter_country", "occp_cod"))
    return demo.select(
        "primaryid",
        clinical.age_category(years).alias("age_category"), years.alias("age_years"),
        sex.alias("sex"), flag(sex == "M").alias("sex_binary"), flag(sex == "F").alias("sex_female"),
        country.alias("country"), clinical.region_of(country, study.regions).alias("region"),
        reporter.alias("reporter_type"), flag(reporter.isin("MD", "HP")).alias("reporter_md"),
        flag(reporter == "LW").alias("reporter_lawyer"),
        flag(reporter == "CN").alias("reporter_consumer"))


def severity_features(outc: DataFrame, study: Study) -> DataFrame:
    """Outcome flags and severity score of cases that have outcome rows."""
    code = F.col("outc_cod")

    def any_outcome(*codes: str) -> Column:
        return F.max(flag(code.isin(*codes)))

    return outc.where(F.col("primaryid").isNotNull()).groupBy("primaryid").agg(
        any_outcome("DE").alias("outcome_death"),
        any_outcome("LT").alias("outcome_life_threat"),
        any_outcome("HO").alias("outcome_hospitalization"),
        any_outcome("DS").alias("outcome_disability"),
        any_outcome("DE", "LT").alias("severe_disease"),
        F.max(clinical.severity_grade(code, study.severity_grades)).alias("severity_score"))


def _polypharmacy_flags(count: Column) -> list[Column]:
    return [clinical.polypharmacy_category(count).alias("polypharmacy_category"),
            flag(count <= 2).alias("polypharmacy_low"),
            flag((count > 2) & (count <= 5)).alias("polypharmacy_medium"),
            flag(count > 5).alias("polypharmacy_high")]


def drug_profile(drug: DataFrame, study: Study) -> DataFrame:
    """Distinct drug names and exposure bits per case, from one scan of the drug table."""
    return (drug.where(F.col("primaryid").isNotNull())
            .select("primaryid", "drugname", row_bits(study).alias("bits"))
            .groupBy("primaryid")
            .agg(F.countDistinct("drugname").alias("drug_count"), F.bit_or("bits").alias("bits")))


def polypharmacy_features(drug: DataFrame) -> DataFrame:
    """Number of distinct drug names per case, its category and flags."""
    return (drug.where(F.col("primaryid").isNotNull()).groupBy("primaryid")
            .agg(F.countDistinct("drugname").alias("drug_count"))
            .select("primaryid", "drug_count", *_polypharmacy_flags(F.col("drug_count"))))


def event_labels(reac: DataFrame, study: Study, column: str = "pt") -> DataFrame:
    """One flag per event category for every case with reactions."""
    return (reac.where(F.col("primaryid").isNotNull()).groupBy("primaryid")
            .agg(*[F.max(flag(clinical.in_terms(F.col(column), terms))).alias(f"adr_{category}")
                   for category, terms in study.adr_categories.items()]))


@dataclass(frozen=True)
class Reduced:
    """The two large tables of a run, each reduced once to what all later steps read.

    ``drugs``: distinct drug names and exposure bits per case; ``reactions``: rows per case and
    event.
    """

    drugs: DataFrame
    reactions: DataFrame

    @property
    def exposures(self) -> DataFrame:
        return self.drugs.where("bits != 0").select("primaryid", "bits")


def reduced(tables: CaseTables, study: Study) -> Reduced:
    """Read drugs and reactions once; both results are written to the shared folder."""
    return Reduced(materialise(drug_profile(tables.drug, study), "drug_profile"),
                   materialise(reaction_counts(tables.reac), "reaction_counts"))


def patient_drugs(reac: DataFrame, exposed: DataFrame, study: Study) -> DataFrame:
    """Distinct (primaryid, drug_class) of pairs: classes of cases that have reactions."""
    with_reaction = reac.select("primaryid").distinct()
    return (exposed.join(with_reaction, "primaryid", "left_semi")
            .select("primaryid", F.explode(names_of_bits(F.col("bits"), study.drug_classes))
                    .alias("drug_class")))


def feature_distributions(tables: CaseTables, study: Study) -> DataFrame:
    """(feature, value, n_rows): age, sex and region per case, polypharmacy per case with
    drugs, cohort per assignment, drug class per patient and class."""
    exposed = exposures(tables.drug, study)
    assigned = assign_cohorts(tables.demo, exposed, study)
    parts = [
        distributions(demographic_features(tables.demo, study), ["age_category", "sex", "region"]),
        distributions(polypharmacy_features(tables.drug), ["polypharmacy_category"]),
        distributions(assigned, ["cohort"]),
        distributions(patient_drugs(tables.reac, exposed, study), ["drug_class"]),
    ]
    return reduce(DataFrame.unionByName, parts)


def _case_rows(tables: CaseTables, study: Study, small: Reduced) -> DataFrame:
    """One wide row per demographic row: four per-case tables joined on the case.

    Rows without a report id belong to no case and have no features.
    """
    labels = event_labels(small.reactions, study, "adr").withColumn("has_reaction", F.lit(True))
    return (
        demographic_features(tables.demo.where(F.col("primaryid").isNotNull()), study)
        .join(severity_features(tables.outc, study), "primaryid", "left")
        .join(small.drugs, "primaryid", "left")
        .join(labels, "primaryid", "left")
        # Pairs need an antiviral and a reaction row; labels and classes come from pairs.
        .withColumn("in_pairs", F.coalesce(F.col("has_reaction") & antiviral(F.col("bits"), study),
                                           F.lit(False)))
    )


def _zero(columns: Sequence[str]) -> list[Column]:
    return [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in columns]


_DEMO = ["primaryid", "age_category", "age_years", "sex", "sex_binary", "sex_female", "country",
         "region", "reporter_type", "reporter_md", "reporter_lawyer", "reporter_consumer"]
_OUTCOME = ["outcome_death", "outcome_life_threat", "outcome_hospitalization",
            "outcome_disability", "severe_disease", "severity_score"]
_POLY = ["drug_count", "polypharmacy_category", "polypharmacy_low", "polypharmacy_medium",
         "polypharmacy_high"]


def _labels(study: Study) -> list[Column]:
    return [F.when(F.col("in_pairs"), F.col(c)).otherwise(0).alias(c) for c in study.labels]


def case_drug_features(tables: CaseTables, scores: DataFrame, study: Study,
                       small: Reduced | None = None) -> DataFrame:
    """Grain case x cohort x drug class, every missing value 0 (or '0').

    ``scores`` holds one row per drug class, so the join is a broadcast of at most as
    many rows as the study has classes.
    """
    classes = names_of_bits(F.when(F.col("in_pairs"), F.col("bits")).otherwise(0),
                            study.drug_classes)
    rows = (
        _case_rows(tables, study, small or reduced(tables, study))
        .withColumn("cohort", F.explode(all_cohorts(F.col("bits"), study)))
        .withColumn("drug_class", F.explode_outer(classes))
    )
    few = scores.where(F.col("drug").isin(*study.drug_classes)).withColumnRenamed("drug", "drug_class")
    risk = (F.when(F.col("drug_class").isNull(), 0.0)
            .otherwise(F.coalesce("risk_score", F.lit(DEFAULT_RISK_SCORE))))
    return (
        rows.join(F.broadcast(few), "drug_class", "left")
        .withColumns(dict(zip(_POLY[1:], _polypharmacy_flags(F.col("drug_count")))))
        .select(
            *_DEMO[:2], F.coalesce("age_years", F.lit(0.0)).alias("age_years"), *_DEMO[3:],
            *_zero(_OUTCOME),
            F.coalesce("drug_count", F.lit(0)).alias("drug_count"),
            F.coalesce("polypharmacy_category", F.lit("0")).alias("polypharmacy_category"),
            *_zero(_POLY[2:]),
            "cohort", *[flag(F.col("cohort") == v).alias(k) for k, v in COHORT_FLAGS.items()],
            F.coalesce("drug_class", F.lit("0")).alias("drug_class"),
            *[flag(F.col("drug_class") == c).alias(f) for c, f in
              zip(study.drug_classes, study.drug_flags)],
            risk.alias("drug_risk_score"), *_labels(study))
    )


def median_of(df: DataFrame, column: str) -> float | None:
    """Exact median.

    Counts per bin of a grid between the extremes find the bin or two that hold the middle;
    only their values are ranked.  The driver sees at most one count per bin.
    """
    values = df.where(F.col(column).isNotNull()).select(F.col(column).alias("v"))
    ends = values.agg(F.min("v").alias("low"), F.max("v").alias("high")).first()
    if ends["low"] is None or ends["low"] == ends["high"]:
        return ends["low"]
    position = (F.col("v") - ends["low"]) / (ends["high"] - ends["low"])
    binned = values.withColumn("bin", F.floor(position * MEDIAN_BINS))
    counts = sorted((r["bin"], r["count"]) for r in binned.groupBy("bin").count().collect())
    upto = list(accumulate(n for _, n in counts))
    bins, ranks = zip(*((counts[i][0], rank - (upto[i] - counts[i][1])) for rank in
                        ((upto[-1] - 1) // 2, upto[-1] // 2) for i in [bisect_right(upto, rank)]))
    low, high = bins  # the lower and the upper middle; ranks count from 0 inside their bin
    order = Window.partitionBy("bin").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (binned.where(F.col("bin").isin(low, high)).groupBy("bin", "v").agg(F.count("*").alias("n"))
              .withColumn("before", F.coalesce(F.sum("n").over(order), F.lit(0))))

    def at(bin_: int, rank: int) -> Column:
        holds = (F.col("bin") == bin_) & (F.col("before") <= rank) & (rank < F.col("before") + F.col("n"))
        return F.max(F.when(holds, F.col("v")))

    middle = ranked.agg(at(low, ranks[0]).alias("a"), at(high, ranks[1]).alias("b")).first()
    return (middle["a"] + middle["b"]) / 2


def score_map(scores: DataFrame, study: Study) -> DataFrame:
    """Scores as one map, at most one entry per drug class of the study."""
    entry = F.struct("drug", "risk_score")
    return (scores.where(F.col("drug").isin(*study.drug_classes))
            .agg(F.map_from_entries(F.collect_list(entry)).alias("score_of")))


def case_features(tables: CaseTables, scores: DataFrame, study: Study,
                  small: Reduced | None = None) -> DataFrame:
    """Grain case: multi-hot flags, mean risk score of the case's classes, imputed age."""
    bits = F.when(F.col("in_pairs"), F.col("bits")).otherwise(0)
    cohorts = all_cohorts(F.col("bits"), study)
    class_scores = F.transform(
        names_of_bits(bits, study.drug_classes),
        lambda c: F.coalesce(F.try_element_at("score_of", c), F.lit(DEFAULT_RISK_SCORE)))
    mean_score = F.try_divide(F.aggregate(class_scores, F.lit(0.0), lambda x, y: x + y),
                              F.size(class_scores))
    known = tables.demo.where(F.col("primaryid").isNotNull())
    median = F.lit(median_of(demographic_features(known, study), "age_years")).cast("double")
    return (
        _case_rows(tables, study, small or reduced(tables, study))
        .withColumn("score_of", score_map(scores, study).scalar())
        .withColumns(dict(zip(_POLY[1:], _polypharmacy_flags(F.col("drug_count")))))
        .select(
            *_DEMO[:2], F.coalesce("age_years", median).alias("age_years"), *_DEMO[3:],
            *_zero(_OUTCOME), F.coalesce("drug_count", F.lit(0)).alias("drug_count"),
            F.coalesce("polypharmacy_category", F.lit("0")).alias("polypharmacy_category"),
            *_zero(_POLY[2:]),
            *[flag(F.array_contains(cohorts, v)).alias(k) for k, v in COHORT_FLAGS.items()],
            *[flag(has_bit(bits, i)).alias(f) for i, f in enumerate(study.drug_flags)],
            F.coalesce(mean_score, F.lit(0.0)).alias("drug_risk_score"), *_labels(study))
    )


def label_prevalence(features: DataFrame, study: Study) -> DataFrame:
    """(label, positives, prevalence) per label, and the rows without any label."""
    none = sum((F.col(c) for c in study.labels), F.lit(0)) == 0
    entries = F.array(*[
        F.struct(F.lit(c).alias("label"), F.col(f"sum_{c}").alias("n_positive"),
                 (F.col(f"sum_{c}") / F.col("n_rows")).alias("prevalence"))
        for c in [*study.labels, "no_label"]])
    return (
        features.agg(F.count("*").alias("n_rows"), F.sum(flag(none)).alias("sum_no_label"),
                     *[F.sum(c).alias(f"sum_{c}") for c in study.labels])
        .select(F.inline(entries))
    )


def polypharmacy_profile(drug: DataFrame) -> DataFrame:
    """Cases, mean and exact median of the drug count, cases per category.

    Cases are first counted per drug count, so the median reads a short table.
    """
    count, n = F.col("drug_count"), F.col("n_cases")
    per_count = polypharmacy_features(drug).groupBy("drug_count").agg(F.count("*").alias("n_cases"))
    return per_count.agg(
        F.sum(n).alias("n_cases"),
        (F.sum(count * n) / F.sum(n)).alias("mean_drugs"),
        F.percentile("drug_count", F.lit(0.5), n).alias("median_drugs"),
        F.sum(F.when(count <= 2, n).otherwise(0)).alias("n_low"),
        F.sum(F.when((count > 2) & (count <= 5), n).otherwise(0)).alias("n_medium"),
        F.sum(F.when(count > 5, n).otherwise(0)).alias("n_high"))


def severity_rates(outc: DataFrame, study: Study) -> DataFrame:
    """Severe, death and hospitalisation rates over cases with outcomes."""
    return severity_features(outc, study).agg(
        F.count("*").alias("n_cases"),
        F.avg("severe_disease").alias("severe_rate"),
        F.avg("outcome_death").alias("death_rate"),
        F.avg("outcome_hospitalization").alias("hospitalization_rate"))
