"""Counts, frequency tables and summaries of cases, pairs and features."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from adrlens.functions.clinical import outcome_name
from adrlens.functions.matching import count_bits, first_bits, names_of_bits
from adrlens.sources.case_tables import CaseTables
from adrlens.study import MONO, Study


def frequency(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """(value, n_rows) of a column without nulls, most frequent first, ties by value."""
    counts = (df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
              .agg(F.count("*").alias("n_rows")))
    ordered = counts.orderBy(F.desc("n_rows"), "value")
    return counts if n is None else ordered.limit(n)


def _labelled(name: str, table: DataFrame, percent: Column | None = None) -> DataFrame:
    percent = F.lit(None).cast("double") if percent is None else percent
    return table.select(F.lit(name).alias("table_name"), F.col("value").cast("string").alias("value"),
                        "n_rows", percent.alias("percent"))


def frequency_tables(tables: CaseTables, study: Study) -> DataFrame:
    """Sex, top 10 countries, top 20 drugs, top 20 reactions and outcomes (by name).

    Sexes also have their percentage of all cases, those of unknown sex included.
    """
    outcomes = frequency(tables.outc, "outc_cod").withColumn(
        "value", F.format_string("%s (%s)", outcome_name(F.col("value"), study.outcome_names),
                                 F.col("value")))
    n_cases = tables.demo.agg(F.count("*").alias("n")).scalar()
    parts = [
        _labelled("sex", frequency(tables.demo, "sex"), F.col("n_rows") * 100.0 / n_cases),
        _labelled("country", frequency(tables.demo, "reporter_country", 10)),
        _labelled("drug", frequency(tables.drug, "drugname", 20)),
        _labelled("reaction", frequency(tables.reac, "pt", 20)),
        _labelled("outcome", outcomes),
    ]
    return reduce(DataFrame.unionByName, parts)


def distributions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, n_rows) of several columns in one pass."""
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"))
                        for c in columns])
    return (df.select(F.inline(entries)).groupBy("feature", "value")
            .agg(F.count("*").alias("n_rows")))


def extraction_profile(tables: CaseTables) -> DataFrame:
    """(metric, value) rows: case and record counts, age statistics, distinct names."""
    def metrics(df: DataFrame, **values) -> DataFrame:
        named = [F.struct(F.lit(k).alias("metric"), F.col(k).cast("double").alias("value"))
                 for k in values]
        return (df.agg(*[v.alias(k) for k, v in values.items()])
                .select(F.inline(F.array(*named))))

    def rows(df: DataFrame, name: str) -> DataFrame:
        return metrics(df, **{f"{name}_records": F.count("*")})

    parts = [
        metrics(tables.demo, cases=F.count("*"), age_min=F.min("age_years"),
                age_max=F.max("age_years"), age_mean=F.avg("age_years"),
                valid_ages=F.count("age_years"), valid_dates=F.count("event_date")),
        metrics(tables.drug, drug_records=F.count("*"), distinct_drugs=F.countDistinct("drugname")),
        metrics(tables.reac, reac_records=F.count("*"), distinct_reactions=F.countDistinct("pt")),
        rows(tables.indi, "indi"), rows(tables.outc, "outc"), rows(tables.rpsr, "rpsr"),
    ]
    return reduce(DataFrame.unionByName, parts)


def extract_counts(tables: CaseTables) -> DataFrame:
    """Rows and quarters of every table, for the record of an extraction."""
    parts = [df.groupBy("year_quarter").agg(F.count("*").alias("n_rows"))
             .select(F.lit(name).alias("table_name"), "year_quarter", "n_rows")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def pairs_profile(facts: DataFrame, study: Study) -> DataFrame:
    """Cases, pair rows and distinct events per cohort.

    Events are first counted per cohort and event, so a frequent event is one row.
    """
    records = F.col("n_rows") * count_bits(F.col("bits"), len(study.drug_classes))
    is_case = F.col("is_case")
    return (
        facts.groupBy("cohort", "adr", "is_case")
        .agg(F.count("*").alias("n"), F.sum(records).alias("records"))
        .groupBy("cohort").agg(
            F.sum(F.when(is_case, F.col("n"))).alias("n_cases"),
            F.sum(F.when(is_case, F.col("records"))).alias("n_adr_records"),
            F.sum(F.when(is_case, 0).otherwise(1)).alias("n_adrs"))
    )


def top_events_per_drug(facts: DataFrame, study: Study, cohort: str = MONO, n: int = 10) -> DataFrame:
    """The n most frequent events of each drug class in one cohort, by pair rows."""
    bits = first_bits(F.col("bits"), len(study.drug_classes)).alias("bits")
    order = Window.partitionBy("drug_class").orderBy(F.desc("n_rows"), "adr")
    return (
        facts.where((F.col("cohort") == cohort) & ~F.col("is_case"))
        .groupBy(bits, "adr").agg(F.sum("n_rows").alias("n_rows"))  # unfold sums, not rows
        .select(F.explode(names_of_bits(F.col("bits"), study.drug_classes)).alias("drug_class"),
                "adr", "n_rows")
        .groupBy("drug_class", "adr").agg(F.sum("n_rows").alias("n_rows"))
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)
        .select("drug_class", "rank", "adr", F.substring("adr", 1, 30).alias("adr_label"), "n_rows")
    )
