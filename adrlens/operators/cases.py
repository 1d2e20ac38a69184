"""Case finding, extraction, latest version per case and demographic cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from adrlens.functions import cleaning
from adrlens.functions.matching import any_term
from adrlens.sources.case_tables import CaseTables
from adrlens.study import Study

DRUG_TEXT = ("drugname", "prod_ai")


def _matching_rows(tables: CaseTables, study: Study) -> DataFrame:
    """(primaryid, source) of every row that meets the case definition."""
    def hits(df: DataFrame, columns, terms, source: str) -> DataFrame:
        return (df.where(any_term(columns, terms, study.match) & F.col("primaryid").isNotNull())
                .select("primaryid", F.lit(source).alias("source")))

    return (
        hits(tables.indi, ["indi_pt"], study.case_terms, "indi")
        .unionByName(hits(tables.reac, ["pt"], study.case_terms, "reac"))
        .unionByName(hits(tables.drug, DRUG_TEXT, study.case_drugs, "drug"))
    )


def case_hits(tables: CaseTables, study: Study) -> DataFrame:
    """One row per case and source (indi, reac, drug) in which the case definition matches."""
    return _matching_rows(tables, study).distinct()


def case_ids(tables: CaseTables, study: Study) -> DataFrame:
    """Distinct ids of all cases, over all sources and quarters."""
    return _matching_rows(tables, study).select("primaryid").distinct()


def keep_cases(tables: CaseTables, ids: DataFrame) -> CaseTables:
    """Rows of every table and quarter whose case is in ``ids``."""
    return tables.map(lambda _, df: df.join(ids, "primaryid", "left_semi"))


def latest_versions(demo: DataFrame, versioned: bool = True) -> DataFrame:
    """The latest version of each case; cases without an id count as one case.

    Highest numeric version first, missing versions last, then the earliest quarter and
    the smallest report id.  Spark limits each group before the shuffle, so a case with
    very many rows sends one row per task.  Where no layout has a case version
    (``versioned`` is false) the first row of each report stays instead.
    """
    version = cleaning.to_number(F.col("caseversion"))
    order = [F.col("_version").desc_nulls_last(), "year_quarter", "primaryid"]
    unit = "caseid" if versioned else "primaryid"
    return (
        demo.withColumn("_version", version)
        .withColumn("_rank", F.row_number().over(Window.partitionBy(unit).orderBy(*order)))
        .where("_rank = 1")
        .withColumn("caseversion", F.col("_version"))
        .drop("_version", "_rank")
    )


def keep_children(tables: CaseTables, demo: DataFrame) -> CaseTables:
    """``demo`` with the rows of every other table that belong to its reports."""
    ids = demo.select("primaryid").distinct()
    return tables.map(
        lambda name, df: demo if name == "demo" else df.join(ids, "primaryid", "left_semi"))


def keep_latest(tables: CaseTables) -> CaseTables:
    """Latest version of each case, and the child rows of those reports only."""
    return keep_children(tables, latest_versions(tables.demo, tables.versioned))


def dedupe_counts(demo: DataFrame, versioned: bool = True) -> DataFrame:
    """One row: distinct reports before and after the latest versions are kept, and removed."""
    n = F.countDistinct("primaryid")
    before = demo.agg(n.alias("n_before"))
    after = latest_versions(demo, versioned).agg(n.alias("n_after")).scalar()
    return (before.withColumn("n_after", after)
            .withColumn("n_removed", F.col("n_before") - F.col("n_after")))


def clean_demographics(demo: DataFrame) -> DataFrame:
    """Typed and normalised demographics: numeric age, age in years, tidy sex, event date."""
    return (
        demo.withColumn("age", cleaning.to_number(F.col("age").cast("string")))
        .withColumn("age_years", cleaning.age_in_years(F.col("age"), F.col("age_cod")))
        .withColumn("sex", cleaning.tidy_code(F.col("sex")))
        .withColumn("event_date", cleaning.report_date(F.col("event_dt")))
    )


def extract_demographics(tables: CaseTables, ids: DataFrame) -> DataFrame:
    """Cleaned demographics of the latest version of each case in ``ids``."""
    return clean_demographics(latest_versions(
        tables.demo.join(ids, "primaryid", "left_semi"), tables.versioned))


def extract_cases(tables: CaseTables, study: Study) -> CaseTables:
    """The whole extraction: find cases, keep their latest reports, clean demographics.

    The reports of the kept demographics are all cases, so the other tables need one
    semi join only.
    """
    return keep_children(tables, extract_demographics(tables, case_ids(tables, study)))
