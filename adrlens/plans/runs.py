"""End-to-end runs: report files to case tables, statistics, features, models and scores.

Each run reads tables and writes tables, so a run can be repeated or resumed on its own.
A result that several outputs share is written once and read back.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from adrlens.operators import (cases, cohorts, compare, features, ladder, ml, pairs, profiles,
                               scoring, severity, signals)
from adrlens.schemas import DERIVED_SCHEMAS, REPORT_TABLES, report_schema
from adrlens.session import intermediates, materialise
from adrlens.sources.case_tables import CaseTables
from adrlens.sources.report_files import (YEARS, find_report_files, has_column, kept_rows,
                                          parse_report_table, rejected_rows, skipped_report_files)
from adrlens.sources.tables import load_models, read_table, save_models, write_table
from adrlens.study import HBV_STUDY, Study



def run(step):
    """A run whose intermediate tables are removed at its end; results lie in its output folder."""
    @wraps(step)
    def owned(*args, **kwargs):
        with intermediates(SparkSession.active()):
            return step(*args, **kwargs)

    return owned


CLEAN_DEMO_TYPES = {"age": "double", "caseversion": "double"}


def extracted_schema(name: str) -> str:
    """Declared schema of an extracted table."""
    types = CLEAN_DEMO_TYPES if name == "demo" else {}
    fields = [f"{f.name} {types.get(f.name, 'string')}" for f in report_schema(name)]
    if name == "demo":
        fields += ["age_years double", "event_date date"]
    return ", ".join(fields)


def _in_order(df: DataFrame, name: str) -> DataFrame:
    return df.select(*[c.split()[0] for c in extracted_schema(name).split(", ")])


def load_extracted(spark: SparkSession, folder: str) -> CaseTables:
    return CaseTables(**{
        name: read_table(spark, f"{folder}/{name}", extracted_schema(name))
        for name in REPORT_TABLES})


@run
def run_extraction(spark: SparkSession, reports: str, out: str, study: Study = HBV_STUDY,
                   years: Iterable[int] = YEARS) -> CaseTables:
    """Report files to extracted case tables, with profile, frequencies and rejected lines.

    The text is parsed once into Parquet, partitioned by quarter; both passes (find cases,
    keep their rows) then read columns, not text.
    """
    files = find_report_files(spark, reports, years=years)
    staged, rejects = {}, []
    for name in REPORT_TABLES:
        path, parsed = f"{out}/staged/{name}", parse_report_table(spark, name, files)
        write_table(parsed, path, partition_by=["reason", "year_quarter"])
        written = read_table(spark, path, parsed.schema)
        staged[name] = kept_rows(written)
        rejects.append(rejected_rows(written).withColumn("table_name", F.lit(name)))
    tables = CaseTables(versioned=has_column(spark, "demo", "caseversion", files), **staged)
    write_table(skipped_report_files(spark, reports, years=years), f"{out}/skipped_files")
    write_table(reduce(DataFrame.unionByName, rejects).groupBy("table_name", "year_quarter", "reason")
                .agg(F.count("*").alias("n_lines")), f"{out}/rejected_lines")
    ids = materialise(cases.case_ids(tables, study), "case_ids")
    write_table(_in_order(cases.extract_demographics(tables, ids), "demo"), f"{out}/demo")
    demo = read_table(spark, f"{out}/demo", extracted_schema("demo"))
    for name, df in cases.keep_children(tables, demo).items():
        if name != "demo":
            write_table(_in_order(df, name), f"{out}/{name}")
    found = tables.demo.join(ids, "primaryid", "left_semi")
    write_table(cases.dedupe_counts(found, tables.versioned), f"{out}/dedupe_counts")
    extracted = load_extracted(spark, out)
    write_table(profiles.extraction_profile(extracted), f"{out}/profile")
    write_table(profiles.frequency_tables(extracted, study), f"{out}/frequencies")
    return extracted


@run
def run_analysis(tables: CaseTables, out: str, study: Study = HBV_STUDY) -> None:
    """Cohorts, pairs, signals, comparison, severity and summaries of extracted tables."""
    exposures = materialise(cohorts.exposures(tables.drug, study), "exposures")
    exposed = materialise(pairs.exposed_cases(exposures, tables.outc, study), "exposed")
    facts = materialise(pairs.pair_facts(pairs.of_exposed(tables.reac, exposed), exposed), "facts")
    found = materialise(signals.detect_signals(facts, study), "signals")
    results = {
        "cohort_assignments": cohorts.assign_cohorts(tables.demo, exposures, study),
        "drug_adr_pairs": pairs.drug_adr_pairs(tables.reac, exposed, study),
        "all_signals": signals.by_strength(found),
        "cohort_comparison": compare.by_risk_ratio(compare.compare_cohorts(facts, study)),
        "severity_by_cohort": severity.severity_profile(
            pairs.case_records(tables.reac, exposed, study)),
        "drug_risk_scores": signals.drug_risk_scores(found),
        "exposure_counts": cohorts.exposure_counts(exposures, study),
        "pairs_profile": profiles.pairs_profile(facts, study),
        "signals_per_cohort": signals.signals_per_cohort(found),
        "top_signals": signals.top_signals(found),
        "top_events_per_drug": profiles.top_events_per_drug(facts, study),
    }
    for name, df in results.items():
        write_table(df, f"{out}/{name}")


def derived(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, f"{folder}/{name}", DERIVED_SCHEMAS[name])


@run
def run_charts(spark: SparkSession, analysis: str, out: str) -> None:
    """The data behind the comparison charts, from written results."""
    comparison = derived(spark, analysis, "cohort_comparison")
    points = compare.volcano(comparison)
    profile = derived(spark, analysis, "severity_by_cohort")
    results = {
        "cohort_sizes": cohorts.cohort_sizes(derived(spark, analysis, "cohort_assignments")),
        "severity_main": severity.main_cohorts_only(profile),
        "largest_differences": compare.largest_differences(comparison),
        "risk_ratio_extremes": compare.risk_ratio_extremes(comparison),
        "volcano": points,
        "volcano_labels": compare.volcano_labels(points),
    }
    for name, df in results.items():
        write_table(df, f"{out}/{name}")


@run
def run_features(tables: CaseTables, scores: DataFrame, out: str, study: Study = HBV_STUDY,
                 grain: str = "case_drug") -> DataFrame:
    """The feature table at one grain, its label prevalence and distributions."""
    build = {"case_drug": features.case_drug_features, "case": features.case_features}[grain]
    matrix = build(tables, scores, study)
    write_table(matrix, f"{out}/feature_matrix")
    matrix = read_table(tables.demo.sparkSession, f"{out}/feature_matrix", matrix.schema)
    write_table(features.label_prevalence(matrix, study), f"{out}/label_prevalence")
    write_table(features.feature_distributions(tables, study), f"{out}/distributions")
    return matrix


@run
def run_training(matrix: DataFrame, out: str, study: Study = HBV_STUDY,
                 params: ml.ForestParams = ml.ForestParams()) -> None:
    """Split, train, save the models, evaluate both sides, write curves and importance."""
    spark = matrix.sparkSession
    divided = ml.split(matrix, study, params.test_size, params.seed)
    write_table(ml.split_prevalence(divided, study), f"{out}/split_prevalence")
    models = ml.train_forests(divided.where(~F.col("is_test")), study, params)
    save_models(models, f"{out}/models")
    predictions = materialise(
        ml.long_predictions(ml.predict(divided, models, study), list(models)), "predictions")
    performance = materialise(ml.evaluate(predictions), "performance")
    write_table(performance, f"{out}/performance")
    write_table(ladder.verdict(performance), f"{out}/verdict")
    write_table(ladder.roc_points(predictions.where("is_test")), f"{out}/roc_points")
    write_table(ladder.roc_corners(predictions.where("is_test")), f"{out}/roc_corners")
    write_table(ml.feature_importance(models, study, spark), f"{out}/feature_importance")


@run
def run_scoring(profile_table: DataFrame, trained: str, out: str, labels: list[str],
                study: Study = HBV_STUDY) -> None:
    """Risks and advice for a table of patient profiles, with the saved models."""
    scored = scoring.score_profiles(profile_table, load_models(f"{trained}/models", labels), study)
    write_table(scored, f"{out}/risks")
    risks = read_table(profile_table.sparkSession, f"{out}/risks", scored.schema)
    write_table(scoring.risk_summary(risks, study), f"{out}/summary")
