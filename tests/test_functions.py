"""Column functions on handmade values."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from adrlens.functions import association, cleaning, clinical, disproportionality as dp, matching
from adrlens.study import HBV_STUDY
from conftest import rows


def column(spark, values, kind, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


def test_numbers(spark):
    values = [" 12 ", "1e2", "1,000", "1d", "abc", "0x10", "1_0", None, "-3.5", ".5"]
    assert column(spark, values, "string", cleaning.to_number) == [
        12, 100, None, None, None, None, None, None, -3.5, 0.5]


def test_dates(spark):
    values = ["20200315", "20201301", "202003", "202011", None, "20210229"]
    assert column(spark, values, "string", cleaning.report_date) == [
        datetime.date(2020, 3, 15), None, None, None, None, None]


def test_age_in_years(spark):
    given = [(5, "DEC", 50), (24, "MON", 2), (104, "WK", 2), (730, "DY", 2), (8760, "HR", 1),
             (40, "YR", 40), (40, None, 40), (130, "YR", None), (-1, "YR", None), (13, "DEC", None),
             (None, "YR", None)]
    df = spark.createDataFrame([(i, None if a is None else float(a), u) for i, (a, u, _) in
                                enumerate(given)], "i int, a double, u string").orderBy("i")
    got = [r[0] for r in df.select(cleaning.age_in_years(F.col("a"), F.col("u"))).collect()]
    assert got == [e for *_, e in given]


def test_null_tokens(spark):
    assert column(spark, ["NA", "None", "NULL", "", "US", "n/a", "na"], "string",
                  cleaning.null_tokens) == [None, None, None, None, "US", None, "na"]


def test_minimal_terms():
    assert matching.minimal_terms(HBV_STUDY.case_terms) == [
        "HEPATITIS B", "HEPATOCELLULAR CARCINOMA", "HEPATIC CIRRHOSIS", "LIVER DISORDER",
        "HEPATIC FAILURE", "HEPATIC ENCEPHALOPATHY"]
    assert "PEGINTERFERON ALFA" not in matching.minimal_terms(HBV_STUDY.case_drugs)


def test_case_terms_match_literally(spark):
    values = ["Chronic Hepatitis B virus", None, "hepatitis c", "Liver disorder (mild)", ""]
    got = column(spark, values, "string", lambda _: matching.any_term(["v"], HBV_STUDY.case_terms))
    assert got == [True, False, False, True, False]


def test_pattern_characters_are_literal(spark):
    assert column(spark, ["a.c", "abc"], "string", lambda _: matching.any_term(["v"], ["A.C"])) == [
        True, False]
    assert column(spark, ["x a.c y", "abc"], "string",
                  lambda _: matching.any_term(["v"], ["A.C"], "word")) == [True, False]


def test_classes_of_a_drug_row(spark):
    df = spark.createDataFrame([("LAMIVUDINE; TENOFOVIR", None), ("Tafinlar", None),
                                (None, "Epivir"), ("aspirin", None), (None, None)],
                               "drugname string, prod_ai string")

    def classes(match):
        bits = matching.group_bits(["drugname", "prod_ai"], HBV_STUDY.drug_classes, match)
        return [r[0] for r in df.select(matching.names_of_bits(bits, HBV_STUDY.drug_classes)).collect()]

    assert classes("substring") == [["TENOFOVIR", "LAMIVUDINE"], ["TENOFOVIR"], ["LAMIVUDINE"], [], []]
    assert classes("word") == [["TENOFOVIR", "LAMIVUDINE"], [], ["LAMIVUDINE"], [], []]


def test_count_bits(spark):
    assert column(spark, [0, 1, 63, 64, 192, 65], "int", lambda b: matching.count_bits(b, 6)) == [
        0, 1, 6, 0, 0, 1]


def square(spark, a, b, c, d, measure):
    df = spark.createDataFrame([(a, b, c, d)], "a long, b long, c long, d long")
    return tuple(df.select(*measure(*[F.col(x) for x in "abcd"])).first())


def test_disproportionality_values(spark):
    cells = (10, 20, 30, 940)
    assert square(spark, *cells, dp.reporting_odds_ratio) == pytest.approx(
        (15.666666666666666, 6.7522926128923455, 36.349793842732815), rel=1e-12)
    assert square(spark, *cells, dp.proportional_reporting_ratio) == pytest.approx(
        (10.777777777777777, 5.81757282964178, 19.96717483884308), rel=1e-12)
    assert square(spark, *cells, dp.information_component) == pytest.approx(
        (3.0588936890535687, 2.4390872676605664, 3.678700110446571), rel=1e-12)


@pytest.mark.parametrize("cells", [(0, 1, 1, 1), (1, 0, 1, 1), (1, 1, 0, 1), (1, 1, 1, 0)])
def test_empty_cell_has_no_odds_ratio(spark, cells):
    assert square(spark, *cells, dp.reporting_odds_ratio) == (None, None, None)


def test_prr_guards_its_own_denominators(spark):
    assert square(spark, 3, 0, 0, 5, dp.proportional_reporting_ratio) == (None, None, None)
    assert square(spark, 0, 0, 0, 0, dp.information_component) == (None, None, None)


def test_two_group_test(spark):
    df = spark.createDataFrame([(12, 100, 30, 100), (4, 100, 30, 100), (50, 100, 50, 100)],
                               "k1 long, n1 long, k2 long, n2 long")
    chi2 = association.yates_chi2(*[F.col(c) for c in df.columns])
    got = df.select(chi2.alias("chi2")).withColumn("p", association.chi2_p_value(F.col("chi2"))).collect()
    assert tuple(got[0]) == pytest.approx((8.710066305003014, 0.0031645769736923916), rel=1e-12)
    assert tuple(got[1]) == (None, None)
    assert tuple(got[2]) == pytest.approx((0.0, 1.0))


def test_infinities(spark):
    assert column(spark, [0.0, 1.0, 4.0, None], "double", association.log2_or_infinity) == [
        -math.inf, 0.0, 2.0, None]
    assert column(spark, [0.0, 0.01, None], "double", association.negative_log10) == [
        math.inf, 2.0, None]
    assert column(spark, [math.inf, -math.inf, math.nan, None, 1.0], "double",
                  association.is_finite) == [False, False, False, False, True]


def test_volcano_class(spark):
    df = spark.createDataFrame([(2.0, 0.01), (-2.0, 0.01), (0.5, 0.01), (3.0, 0.05)], "x double, p double")
    got = [r[0] for r in df.select(association.volcano_class(F.col("x"), F.col("p"))).collect()]
    assert got == ["enriched_mono", "enriched_coinfection", "significant_small", "not_significant"]


def test_codings(spark):
    assert column(spark, [17.9, 18.0, 40.9, 41.0, 65.9, 66.0, None], "double", clinical.age_category) == [
        "<18", "18-40", "18-40", "41-65", "41-65", ">65", "Unknown"]
    assert column(spark, [0, 2, 3, 5, 6, None], "int", clinical.polypharmacy_category) == [
        "1-2_drugs", "1-2_drugs", "3-5_drugs", "3-5_drugs", "6+_drugs", None]
    assert column(spark, [30.0, 30.1, 50.0, 50.1], "double", clinical.risk_band) == [
        "Low", "Medium", "Medium", "High"]
    assert column(spark, ["DE", "LT", "HO", "DS", "CA", "RI", "OT", "XX", None], "string",
                  lambda c: clinical.severity_grade(c, HBV_STUDY.severity_grades)) == [
        5, 4, 3, 3, 2, 2, 1, 1, 1]
    assert column(spark, ["US", "GB", "IN", "NA", None], "string",
                  lambda c: clinical.region_of(c, HBV_STUDY.regions)) == [
        "North_America", "Europe", "Asia", "Other", "Other"]
    assert column(spark, ["DE", "ZZ"], "string",
                  lambda c: clinical.outcome_name(c, HBV_STUDY.outcome_names)) == ["Death", "ZZ"]


def test_exact_category_membership(spark):
    terms = HBV_STUDY.adr_categories["bone_tooth"]
    assert column(spark, ["TOOTH LOSS", "Tooth loss partial", None], "string",
                  lambda c: clinical.flag(clinical.in_terms(c, terms))) == [1, 0, 0]


def test_feature_columns():
    assert len(HBV_STUDY.feature_columns) == 26
    assert HBV_STUDY.drug_flags[0] == "drug_entecavir"
    assert sum(len(t) for t in HBV_STUDY.adr_categories.values()) == 55


def test_rows_helper(spark):
    assert rows(spark.range(3)) == [(0,), (1,), (2,)]


def test_p_value_against_erfc(spark):
    values = [0.0, 1e-12, 1e-3, 0.4394531, *(i * 0.13 for i in range(1, 400)), *(float(i) for i in range(53, 701))]
    got = spark.createDataFrame([(x,) for x in [*values, None]], "x double").select(
        "x", association.chi2_p_value(F.col("x")).alias("p")).collect()
    assert got[-1]["p"] is None
    for row in got[:-1]:
        want = math.erfc(math.sqrt(row["x"] / 2))
        assert abs(row["p"] - want) <= 1e-12 * want


def test_white_space_of_any_kind_is_trimmed(spark):
    df = spark.createDataFrame([("\tF\t",), (" m\n",), ("\u00a0f",), (None,)], "x string")
    assert [r[0] for r in df.select(cleaning.tidy_code(F.col("x"))).collect()] == ["F", "M", "F", None]
