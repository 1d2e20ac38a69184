"""Case tables derived from the star-schema test tables.

An order is a case, its line items are drugs, reactions, indications and outcomes.
Every value is derived from the stored columns; all columns are strings as in a report.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adrlens.sources.case_tables import CaseTables

# Fixed values of the mapping.
COUNTRIES = ("US", "CA", "MX", "GB", "DE", "FR", "IT", "ES", "JP", "CN", "KR", "TW", "IN",
             "BR", "AU", None)
AGE_CODES = {"1": "YR", "2": "MON", "3": "DY", "4": "DEC"}  # by leading digit of the priority
SEXES = {"BUILDING": "M", "AUTOMOBILE": "F", "MACHINERY": " m ", "HOUSEHOLD": "f"}
REPORTERS = {"P": "MD", "O": "CN", "F": "LW"}
REPORT_SOURCES = {"P": "HP", "O": "CSM", "F": "FGN"}
OUTCOMES = ("DE", "LT", "HO", "DS", "CA", "RI", "OT")  # by line number
MAX_OUTCOME_QUANTITY = 10


# Declared, so that building a query reads no file footers.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _coded(key: Column, mapping: dict[str, str]) -> Column:
    chain = F
    for code, value in mapping.items():
        chain = chain.when(key == code, F.lit(value))
    return chain


def _quarter(day: Column) -> Column:
    return F.concat(F.year(day).cast("string"), F.lit(" Q"), F.quarter(day).cast("string"))


def _case(key: Column) -> list[Column]:
    return [key.cast("string").alias("primaryid"),
            F.floor(key / 2).cast("string").alias("caseid")]


def demo(spark: SparkSession, sf_dir: str) -> DataFrame:
    country = F.element_at(F.array(*[F.lit(c) for c in COUNTRIES]),
                           F.col("n_nationkey") % len(COUNTRIES) + 1)
    key = F.col("o_orderkey")
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            *_case(key),
            (key % 2 + 1).cast("string").alias("caseversion"),
            F.lit(None).cast("string").alias("i_f_code"),
            F.date_format("o_orderdate", "yyyyMMdd").alias("event_dt"),
            (F.floor("o_totalprice") % 130).cast("string").alias("age"),
            _coded(F.substring("o_orderpriority", 1, 1), AGE_CODES).alias("age_cod"),
            _coded(F.col("c_mktsegment"), SEXES).alias("sex"),
            F.lit(None).cast("string").alias("wt"),
            F.lit(None).cast("string").alias("wt_cod"),
            _coded(F.col("o_orderstatus"), REPORTERS).alias("occp_cod"),
            country.alias("reporter_country"),
            _quarter(F.col("o_orderdate")).alias("year_quarter"),
        )
    )


def _lines_with_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))


def drug(spark: SparkSession, sf_dir: str) -> DataFrame:
    empty = [F.lit(None).cast("string").alias(c)
             for c in ("val_vbm", "route", "dose_vbm", "dechal", "rechal")]
    return _lines_with_part(spark, sf_dir).select(
        *_case(F.col("l_orderkey")),
        F.col("l_linenumber").cast("string").alias("drug_seq"),
        F.col("l_returnflag").alias("role_cod"),
        F.col("p_name").alias("drugname"),
        F.lit(None).cast("string").alias("prod_ai"),
        *empty,
        _quarter(F.col("l_shipdate")).alias("year_quarter"),
    )


def reac(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines_with_part(spark, sf_dir).select(
        *_case(F.col("l_orderkey")),
        F.concat_ws(" ", "p_brand", "p_type").alias("pt"),
        F.lit(None).cast("string").alias("drug_rec_act"),
        _quarter(F.col("l_shipdate")).alias("year_quarter"),
    )


def indi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines_with_part(spark, sf_dir).select(
        *_case(F.col("l_orderkey")),
        F.col("l_linenumber").cast("string").alias("indi_drug_seq"),
        F.col("p_type").alias("indi_pt"),
        _quarter(F.col("l_shipdate")).alias("year_quarter"),
    )


def outc(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.element_at(F.array(*[F.lit(c) for c in OUTCOMES]), F.col("l_linenumber"))
    return (
        table(spark, sf_dir, "lineitem")
        .where(F.col("l_quantity") <= MAX_OUTCOME_QUANTITY)
        .select(*_case(F.col("l_orderkey")), code.alias("outc_cod"),
                _quarter(F.col("l_shipdate")).alias("year_quarter"))
    )


def rpsr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        *_case(F.col("o_orderkey")),
        _coded(F.col("o_orderstatus"), REPORT_SOURCES).alias("rpsr_cod"),
        _quarter(F.col("o_orderdate")).alias("year_quarter"),
    )


def star_case_tables(spark: SparkSession, sf_dir: str) -> CaseTables:
    builders = dict(demo=demo, drug=drug, reac=reac, indi=indi, outc=outc, rpsr=rpsr)
    return CaseTables(**{name: partial(build, spark, sf_dir) for name, build in builders.items()})
