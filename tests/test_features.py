"""Feature tables at both grains on handmade rows."""

import statistics

import pytest
from pyspark.sql import functions as F

from adrlens.operators import cases, features, pairs, signals
from adrlens.study import HBV_STUDY as STUDY
from conftest import rows


@pytest.fixture(scope="module")
def tables(make_tables):
    def demo(i, **more):
        return dict(primaryid=i, caseid=i, **more)

    made = make_tables(
        demo=[demo("1", age="50", age_cod="YR", sex="F", occp_cod="HP", reporter_country="JP"),
              demo("2", sex=" m ", occp_cod="LW", reporter_country="BR"),
              demo("3", age="70", age_cod="YR"), demo("4", age="30", age_cod="YR", occp_cod="CN")],
        drug=[dict(primaryid="1", drugname="Viread"), dict(primaryid="1", drugname="Epivir"),
              dict(primaryid="1", drugname="Humira"), dict(primaryid="1", drugname="Viread"),
              dict(primaryid="3", drugname="Baraclude"), dict(primaryid="3", drugname=None),
              dict(primaryid="4", drugname="aspirin")],
        reac=[dict(primaryid="1", pt="tooth LOSS"), dict(primaryid="1", pt="Anaemia"),
              dict(primaryid="2", pt="Anaemia"), dict(primaryid="4", pt=None)],
        outc=[dict(primaryid="1", outc_cod="LT"), dict(primaryid="1", outc_cod="DS"),
              dict(primaryid="4", outc_cod=None)])
    return made.map(lambda n, df: cases.clean_demographics(df) if n == "demo" else df)


@pytest.fixture(scope="module")
def scores(spark):
    return spark.createDataFrame([("TENOFOVIR", 4.0), ("UNLISTED", 9.0)], "drug string, risk_score double")


def test_case_drug_grain(tables, scores):
    df = features.case_drug_features(tables, scores, STUDY)
    assert len(df.columns) == 40
    assert rows(df, "primaryid", "cohort", "drug_class", "drug_risk_score") == [
        ("1", "HBV_AUTOIMMUNE", "LAMIVUDINE", 1.0), ("1", "HBV_AUTOIMMUNE", "TENOFOVIR", 4.0),
        ("1", "HBV_MONO", "LAMIVUDINE", 1.0), ("1", "HBV_MONO", "TENOFOVIR", 4.0),
        ("2", "HBV_OTHER", "0", 0.0), ("3", "HBV_MONO", "0", 0.0), ("4", "HBV_OTHER", "0", 0.0)]
    one = df.where("primaryid = '1' AND cohort = 'HBV_MONO' AND drug_class = 'TENOFOVIR'").first()
    assert (one.severity_score, one.severe_disease, one.outcome_death, one.outcome_disability) == (4, 1, 0, 1)
    assert (one.drug_count, one.polypharmacy_category, one.polypharmacy_medium) == (3, "3-5_drugs", 1)
    assert (one.adr_bone_tooth, one.adr_hematologic, one.adr_neurologic) == (1, 1, 0)
    assert (one.drug_tenofovir, one.drug_lamivudine, one.region, one.reporter_md) == (1, 0, "Asia", 1)
    two = df.where("primaryid = '2'").first()
    assert (two.age_category, two.age_years, two.sex, two.sex_binary) == ("Unknown", 0.0, "M", 1)
    assert (two.severity_score, two.drug_count, two.polypharmacy_category) == (0, 0, "0")
    assert two.adr_hematologic == 0, "labels come from pairs"
    four = df.where("primaryid = '4'").first()
    assert (four.severity_score, four.sex, four.country, four.drug_count) == (1, "Unknown", "Unknown", 1)


def test_case_grain(tables, scores):
    df = features.case_features(tables, scores, STUDY)
    assert df.count() == 4
    got = {r.primaryid: r for r in df.collect()}
    one = got["1"]
    assert (one.drug_tenofovir, one.drug_lamivudine, one.cohort_hbv_mono, one.cohort_autoimmune) == (1, 1, 1, 1)
    assert one.drug_risk_score == 2.5 and got["2"].drug_risk_score == 0.0
    assert got["2"].age_years == 50.0  # median of 30, 50, 70
    assert set(STUDY.feature_columns) <= set(df.columns)


def test_null_drug_names_are_not_counted(tables):
    assert rows(features.polypharmacy_features(tables.drug), "primaryid", "drug_count") == [
        ("1", 3), ("3", 1), ("4", 1)]


def test_profiles(tables, scores):
    (r,) = features.polypharmacy_profile(tables.drug).collect()
    assert (r.n_cases, r.mean_drugs, r.median_drugs, r.n_low, r.n_medium, r.n_high) == (
        3, pytest.approx(5 / 3), 1.0, 2, 1, 0)
    (s,) = features.severity_rates(tables.outc, STUDY).collect()
    assert tuple(s) == (2, 0.5, 0.0, 0.0)
    prevalence = {r.label: (r.n_positive, r.prevalence) for r in features.label_prevalence(
        features.case_features(tables, scores, STUDY), STUDY).collect()}
    assert prevalence["adr_bone_tooth"] == (1, 0.25) and prevalence["no_label"] == (3, 0.75)


def test_scores_of_detected_signals_feed_features(tables):
    found = signals.detect_signals(pairs.pair_facts_of(tables, STUDY), STUDY)
    df = features.case_drug_features(tables, signals.drug_risk_scores(found), STUDY)
    assert df.where("drug_class = 'TENOFOVIR'").select(F.max("drug_risk_score")).first()[0] == 1.0


def test_distributions_count_cases_assignments_and_patient_classes(tables):
    got = {}
    for feature, value, n in rows(features.feature_distributions(tables, STUDY)):
        got.setdefault(feature, {})[value] = n
    assert got["age_category"] == {"41-65": 1, "Unknown": 1, ">65": 1, "18-40": 1}
    assert got["sex"] == {"F": 1, "M": 1, "Unknown": 2}
    assert got["region"] == {"Asia": 1, "Other": 3}
    assert got["polypharmacy_category"] == {"3-5_drugs": 1, "1-2_drugs": 2}
    assert got["cohort"] == {"HBV_MONO": 2, "HBV_AUTOIMMUNE": 1, "HBV_OTHER": 2}
    assert got["drug_class"] == {"TENOFOVIR": 1, "LAMIVUDINE": 1}  # case 3 has no reaction


@pytest.mark.parametrize("values", [[], [None], [3.0], [1.0, 2.0], [5.0, 1.0, 1.0, 9.0], [2.5] * 7,
                                    [i * i % 97 / 7 for i in range(500)], [1.0] * 300 + [1e9, 2.0, 3.0],
                                    [-1e-9, 0.0, 1e-9, 1e12]])
def test_median(spark, values, monkeypatch):
    known = [v for v in values if v is not None]
    for bins in (2, 4096):
        monkeypatch.setattr(features, "MEDIAN_BINS", bins)
        got = features.median_of(spark.createDataFrame([(v,) for v in values], "x double"), "x")
        assert got == (statistics.median(known) if known else None)


def test_rows_without_an_id_have_no_features(make_tables, scores):
    made = make_tables(demo=[dict(primaryid=None, caseid="9"), dict(primaryid="1", caseid="1")],
                       drug=[dict(primaryid=None, drugname="Viread")], reac=[dict(primaryid=None, pt="x")])
    made = made.map(lambda n, df: cases.clean_demographics(df) if n == "demo" else df)
    for build in (features.case_drug_features, features.case_features):
        assert rows(build(made, scores, STUDY), "primaryid") == [("1",)]


def test_facts_from_counts_equal_pair_facts(tables):
    exposed = pairs.exposed_cases_of(tables, STUDY)
    counted = pairs.facts_from_counts(pairs.reaction_counts(tables.reac), exposed)
    plain = pairs.pair_facts(tables.reac, exposed)
    assert rows(counted.select(plain.columns)) == rows(plain)
    for few in (0, 100):
        kept = pairs.of_exposed(tables.reac, exposed, few)
        assert rows(pairs.pair_facts(kept, exposed)) == rows(plain)
        assert kept.count() < tables.reac.count()  # by a broadcast, and by the filter beyond it
