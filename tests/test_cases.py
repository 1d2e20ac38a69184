"""Case finding, extraction, latest versions and cleaning on handmade rows."""

from pyspark.sql import functions as F

from adrlens.operators import cases
from adrlens.study import HBV_STUDY
from conftest import rows


def test_cases_come_from_three_sources(make_tables):
    tables = make_tables(
        indi=[dict(primaryid="1", indi_pt="Chronic hepatitis B"), dict(primaryid="2", indi_pt=None),
              dict(primaryid=None, indi_pt="Hepatitis B")],
        reac=[dict(primaryid="3", pt="Hepatic failure acute"), dict(primaryid="1", pt="Hepatitis B")],
        drug=[dict(primaryid="4", drugname="x", prod_ai="tenofovir alafenamide"),
              dict(primaryid="5", drugname="Baraclude"), dict(primaryid="6", drugname="Pegasys"),
              dict(primaryid="7", drugname=None)])
    assert rows(cases.case_ids(tables, HBV_STUDY)) == [("1",), ("3",), ("4",), ("5",)]
    assert rows(cases.case_hits(tables, HBV_STUDY), "source", "primaryid") == [
        ("drug", "4"), ("drug", "5"), ("indi", "1"), ("reac", "1"), ("reac", "3")]


def test_rows_of_every_quarter_are_kept(make_tables):
    tables = make_tables(
        indi=[dict(primaryid="1", indi_pt="Hepatitis B", year_quarter="2020 Q1")],
        reac=[dict(primaryid="1", pt="Rash", year_quarter="2020 Q3"),
              dict(primaryid="2", pt="Rash", year_quarter="2020 Q3")])
    kept = cases.keep_cases(tables, cases.case_ids(tables, HBV_STUDY))
    assert rows(kept.reac, "primaryid", "year_quarter") == [("1", "2020 Q3")]


def test_latest_version(make_tables):
    tables = make_tables(
        demo=[dict(primaryid="a1", caseid="A", caseversion="1", year_quarter="2020 Q1"),
              dict(primaryid="a0", caseid="A", caseversion=None, year_quarter="2020 Q1"),
              dict(primaryid="a3", caseid="A", caseversion="2", year_quarter="2020 Q3"),
              dict(primaryid="a2", caseid="A", caseversion="2", year_quarter="2020 Q2"),
              dict(primaryid="b1", caseid="B", caseversion="10", year_quarter="2020 Q1"),
              dict(primaryid="b2", caseid="B", caseversion="9", year_quarter="2020 Q1"),
              dict(primaryid="n1", caseid=None, caseversion="1", year_quarter="2020 Q2"),
              dict(primaryid="n2", caseid=None, caseversion="1", year_quarter="2020 Q1")],
        reac=[dict(primaryid=p, pt="x") for p in ("a2", "a2", "a3", "b1", "n1")])
    latest = cases.keep_latest(tables)
    assert rows(latest.demo, "primaryid", "caseversion") == [("a2", 2.0), ("b1", 10.0), ("n2", 1.0)]
    assert rows(latest.reac, "primaryid") == [("a2",), ("a2",), ("b1",)]


def test_cleaning(make_tables):
    tables = make_tables(demo=[
        dict(primaryid="1", age="24", age_cod="MON", sex=" m ", event_dt="20200229"),
        dict(primaryid="2", age="1d", age_cod="YR", sex=None, event_dt="2020")])
    clean = cases.clean_demographics(tables.demo)
    got = rows(clean.select("primaryid", "age", "age_years", "sex",
                            F.col("event_date").cast("string").alias("d")))
    assert got == [("1", 24.0, 2.0, "M", "2020-02-29"), ("2", None, None, None, None)]


def test_extraction(make_tables):
    tables = make_tables(
        demo=[dict(primaryid="1", caseid="c", caseversion="1"), dict(primaryid="2", caseid="d"),
              dict(primaryid="3", caseid="c", caseversion="2")],
        drug=[dict(primaryid="1", drugname="Epivir"), dict(primaryid="2", drugname="x"),
              dict(primaryid="3", drugname="Epivir"), dict(primaryid="3", drugname="y")],
        rpsr=[dict(primaryid=i, rpsr_cod="HP") for i in "123"])
    out = cases.extract_cases(tables, HBV_STUDY)
    stepwise = cases.keep_latest(cases.keep_cases(tables, cases.case_ids(tables, HBV_STUDY)))
    assert rows(out.demo, "primaryid") == [("3",)] and "age_years" in out.demo.columns
    assert rows(out.drug, "drugname") == rows(stepwise.drug, "drugname") == [("Epivir",), ("y",)]
    assert rows(out.rpsr, "primaryid") == rows(stepwise.rpsr, "primaryid") == [("3",)]


def test_latest_version_limits_groups_before_the_shuffle(make_tables, capsys):
    demo = make_tables(demo=[dict(primaryid="1", caseid="c")]).demo
    cases.latest_versions(demo).explain()
    plan = capsys.readouterr().out
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
