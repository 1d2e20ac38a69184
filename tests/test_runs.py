"""The whole way from report files to scores, on reports written from the test tables."""

from pathlib import Path

import pytest

from adrlens import session
from adrlens.operators import cases, ml
from adrlens.plans import queries as q, runs
from adrlens.sources.report_files import write_report_files
from adrlens.sources.star_schema import star_case_tables
from adrlens.study import STAR_STUDY as STUDY
from conftest import SMALL, rows


def files_in(folder):
    return {str(p) for p in Path(folder.removeprefix("file:")).rglob("part-*")}


@pytest.fixture(scope="module")
def extracted(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("runs")
    write_report_files(star_case_tables(spark, SMALL), f"{base}/reports")
    with open(f"{base}/reports/outc/report=OUTC95Q1.txt/zz.csv", "w") as extra:
        extra.write("primaryid$caseid$outc_cod\n1$2$3$4\n")
    runs.run_extraction(spark, f"{base}/reports", f"{base}/cases", STUDY, years=range(1970, 2070))
    return base, runs.load_extracted(spark, f"{base}/cases")


def test_extraction(spark, extracted):
    base, tables = extracted
    direct = cases.extract_cases(star_case_tables(spark, SMALL), STUDY)
    for name, df in tables.items():
        assert df.count() == getattr(direct, name).count(), name
        if name == "demo":
            assert rows(df, *df.columns) == rows(direct.demo, *df.columns)
    assert rows(spark.read.parquet(f"{base}/cases/rejected_lines")) == [
        ("outc", "1995 Q1", "too_many_fields", 1)]


def test_records_of_the_extraction(spark, extracted):
    base, tables = extracted
    before, after, removed = rows(spark.read.parquet(f"{base}/cases/dedupe_counts"))[0]
    assert (after, removed) == (tables.demo.count(), before - after) and removed > 0
    assert spark.read.parquet(f"{base}/cases/skipped_files").count() == 0


def test_analysis_features_training_scoring(spark, extracted):
    base, tables = extracted
    left = files_in(session.shared_folder(spark))
    runs.run_analysis(tables, f"{base}/analysis", STUDY)
    runs.run_charts(spark, f"{base}/analysis", f"{base}/charts")
    assert runs.derived(spark, f"{base}/analysis", "all_signals").count() > 0
    sizes = dict(rows(spark.read.parquet(f"{base}/charts/cohort_sizes")))
    assert sum(n for c, n in sizes.items() if c != "HBV_AUTOIMMUNE") == tables.demo.count()

    scores = runs.derived(spark, f"{base}/analysis", "drug_risk_scores")
    by_case = runs.run_features(tables, scores, f"{base}/by_case", STUDY, grain="case")
    assert by_case.count() == tables.demo.count()
    matrix = runs.run_features(tables, scores, f"{base}/features", STUDY)
    assert matrix.count() >= tables.demo.count()

    few = ml.ForestParams(trees=5, depth=4)
    runs.run_training(matrix, f"{base}/trained", STUDY, few)
    assert spark.read.parquet(f"{base}/trained/performance").count() == 5
    assert spark.read.parquet(f"{base}/trained/verdict").count() == 1

    runs.run_scoring(q._profiles(spark, SMALL), f"{base}/trained", f"{base}/scored", STUDY.labels, STUDY)
    orders = spark.read.parquet(f"{SMALL}/orders.parquet").count()
    assert spark.read.parquet(f"{base}/scored/risks").count() == 5 * orders
    assert spark.read.parquet(f"{base}/scored/summary").count() == orders
    assert files_in(session.shared_folder(spark)) <= left  # intermediate tables are gone
