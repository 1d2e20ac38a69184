"""Drug-event pairs.

Two forms.  ``drug_adr_pairs`` is the full table, one row per class and reaction row.
``pair_facts`` is what the statistics read: reactions are first counted per case and
event (combined before the shuffle), then meet one exposure row per case.  A case or an
event with very many rows has collapsed by then, and distinct-case counts are row counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from adrlens.functions.matching import count_bits, names_of_bits
from adrlens.operators.cohorts import antiviral, exposures, first_cohort
from adrlens.operators.severity import case_severity
from adrlens.sources.case_tables import CaseTables
from adrlens.study import COHORT_ORDER, Study

DEFAULT_SEVERITY = 1
FEW_CASES = 1_000_000  # ids that may be broadcast
FILTER_BITS = 1 << 28  # marks of the filter beyond, 32 MB


def exposed_cases(exposures: DataFrame, outc: DataFrame, study: Study,
                  precedence: Sequence[str] = COHORT_ORDER) -> DataFrame:
    """One row per case exposed to an antiviral: primaryid, bits, cohort, severity.

    The cohort is the first in ``precedence``; by default an autoimmune case counts as
    mono-infected.  Put the autoimmune cohort first to single it out.
    """
    bits = F.col("bits")
    return (
        exposures.where(antiviral(bits, study))
        .join(case_severity(outc, study), "primaryid", "left")
        .select("primaryid", "bits", first_cohort(bits, study, precedence).alias("cohort"),
                F.coalesce("severity", F.lit(DEFAULT_SEVERITY)).alias("severity"))
    )


def exposed_cases_of(tables: CaseTables, study: Study,
                     precedence: Sequence[str] = COHORT_ORDER) -> DataFrame:
    return exposed_cases(exposures(tables.drug, study), tables.outc, study, precedence)


def drug_adr_pairs(reac: DataFrame, exposed: DataFrame, study: Study) -> DataFrame:
    """One row per antiviral class of a case and reaction row of that case.

    The exposed side has one row per case and class, so adaptive execution can split a
    case with very many reaction rows over several tasks.
    """
    classes = exposed.select(
        "primaryid", F.explode(names_of_bits(F.col("bits"), study.drug_classes)).alias("drug_class"),
        "cohort", "severity")
    return (reac.select("primaryid", F.col("pt").alias("adr")).join(classes, "primaryid")
            .select("primaryid", "drug_class", "adr", "cohort", "severity"))


def case_records(reac: DataFrame, exposed: DataFrame, study: Study) -> DataFrame:
    """One row per case in pairs: cohort, severity, n_records (its number of pair rows)."""
    rows = reac.groupBy("primaryid").agg(F.count("*").alias("n_rows"))
    classes = count_bits(F.col("bits"), len(study.drug_classes))
    return (rows.join(exposed, "primaryid")
            .select("primaryid", "cohort", "severity",
                    (F.col("n_rows") * classes).alias("n_records")))


def reaction_counts(reac: DataFrame) -> DataFrame:
    """(primaryid, adr, n_rows): reaction rows per case and event, also those without text."""
    return (reac.where(F.col("primaryid").isNotNull()).groupBy("primaryid", F.col("pt").alias("adr"))
            .agg(F.count("*").alias("n_rows")))


def facts_from_counts(counts: DataFrame, exposed: DataFrame) -> DataFrame:
    """``pair_facts`` from reactions that are counted already, one row per case and event."""
    events = counts.where("adr IS NOT NULL").select("primaryid", "adr", F.lit(False).alias("is_case"), "n_rows")
    per_case = (counts.groupBy("primaryid").agg(F.sum("n_rows").alias("n_rows"))
                .select("primaryid", F.lit(None).cast("string").alias("adr"), F.lit(True).alias("is_case"), "n_rows"))
    return events.unionByName(per_case).join(exposed, "primaryid")


def may_be_among(df: DataFrame, ids: DataFrame, key: str = "primaryid", bits: int = FILTER_BITS) -> DataFrame:
    """Rows of ``df`` whose key may be among ``ids``: none of those that are is left out.

    Each id sets one of ``bits`` marks by its hash.  The marks are aggregated to blocks of 4 KB,
    at most ``bits`` / 8 bytes whatever the number of ids, so they may be broadcast; about
    (number of ids) / ``bits`` of the other rows pass.
    """
    mark = F.pmod(F.xxhash64(key), F.lit(bits)) + 1
    marks = (ids.where(F.col(key).isNotNull()).select(mark.alias("mark"))
             .groupBy(F.bitmap_bucket_number("mark").alias("_block"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("mark")).alias("_marks")))
    place = F.bitmap_bit_position(mark)
    byte = F.conv(F.hex(F.substring("_marks", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return (df.where(F.col(key).isNotNull()).withColumn("_block", F.bitmap_bucket_number(mark))
            .join(F.broadcast(marks), "_block").where(F.getbit(byte, (place % 8).cast("int")) == 1)
            .drop("_block", "_marks"))


def of_exposed(reac: DataFrame, exposed: DataFrame, few: int = FEW_CASES) -> DataFrame:
    """Reactions of exposed cases, before anything is shuffled.

    The ids are counted, and broadcast if there are at most ``few``; otherwise a filter of fixed
    size takes their place (``may_be_among``), and what it lets through drops out in the join that
    follows.
    """
    ids = exposed.select("primaryid")
    if ids.limit(few + 1).count() > few:
        return may_be_among(reac, ids)
    return reac.join(F.broadcast(ids), "primaryid", "left_semi")


def pair_facts(reac: DataFrame, exposed: DataFrame) -> DataFrame:
    """One row per case and event, and one per case (``is_case``, no event).

    Columns: primaryid, adr, is_case, n_rows (reaction rows), bits, cohort, severity.
    The case rows carry the margins over events, so that cells and margins come from
    one aggregate.  A reaction without text counts in the case row only.
    """
    event = F.struct(F.col("pt").alias("adr"), F.lit(False).alias("is_case"))
    case = F.struct(F.lit(None).cast("string").alias("adr"), F.lit(True).alias("is_case"))
    counted = (
        reac.select("primaryid", F.inline(F.array(event, case)))
        .where("is_case OR adr IS NOT NULL")
        .groupBy("primaryid", "adr", "is_case").agg(F.count("*").alias("n_rows"))
    )
    return counted.join(exposed, "primaryid")


def pair_facts_of(tables: CaseTables, study: Study,
                  precedence: Sequence[str] = COHORT_ORDER) -> DataFrame:
    return pair_facts(tables.reac, exposed_cases_of(tables, study, precedence))
