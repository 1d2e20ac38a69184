"""Physical plans: no cross joins, pruned scans, no Python."""

import re

import pytest

from adrlens.operators import features
from adrlens.plans import queries as plans
from adrlens.plans.queries import QUERIES
from conftest import SMALL

TRAINED = {"train_eval", "feature_importance", "score_profiles"}
WRITING = {"report_files", "report_lines", "reloaded_table"}


def plan_of(df, mode="FORMATTED"):
    session = df.sparkSession
    df.createOrReplaceTempView("planned")
    return session.sql(f"EXPLAIN {mode} SELECT * FROM planned").first()[0]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - TRAINED - WRITING))
def test_plan(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
    for schema in re.findall(r"ReadSchema: struct<(.*)>", plan):
        assert len(schema.split(",")) <= 6, "a scan reads columns it does not need"


def test_signals_scan_each_source_once(spark):
    def scans(name):
        plan = plan_of(QUERIES[name](spark, SMALL))
        return sorted(re.findall(r"Location: .*?/(\w+)\.parquet", plan))

    assert scans("all_signals") == ["lineitem"] * 3 + ["part"] * 2  # drugs, reactions, outcomes
    assert scans("signals_per_cohort") == ["lineitem"] * 2 + ["part"] * 2  # severity not needed


def test_filters_reach_the_scan(spark):
    assert "LessThanOrEqual(l_quantity,10.0)" in plan_of(QUERIES["case_severity"](spark, SMALL))


def test_hot_cases_are_limited_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan_of(QUERIES["dedupe_latest"](spark, SMALL))
    assert "WindowGroupLimit" in plan_of(QUERIES["top_adr_per_drug"](spark, SMALL))


@pytest.fixture
def written(monkeypatch):
    """Names of the tables that queries write on their way."""
    names, real = [], plans.materialise

    def record(df, name, **more):
        names.append((name, re.findall(r"Location: .*?/(\w+)\.parquet", plan_of(df))))
        return real(df, name, **more)

    monkeypatch.setattr(features, "materialise", record)
    monkeypatch.setattr(plans, "materialise", record)
    return names


def test_features_read_drugs_and_reactions_once(spark, written):
    plan = plan_of(QUERIES["features_case_drug"](spark, SMALL))
    assert [(n, sorted(set(t))) for n, t in written] == [
        ("drug_profile", ["lineitem", "part"]), ("reaction_counts", ["lineitem", "part"])]
    assert set(re.findall(r"Location: .*?/(\w+)\.parquet", plan)) == {"orders", "customer", "nation", "lineitem"}
    assert "part.parquet" not in plan  # what is left of the lines is outcomes


def test_split_joins_the_case_tables_once(spark, written):
    plan = plan_of(QUERIES["split"](spark, SMALL))
    assert [n for n, _ in written] == ["drug_profile", "reaction_counts", "features"]
    assert "lineitem.parquet" not in plan and "orders.parquet" not in plan


def test_curves_meet_their_totals_without_a_shuffle(spark):
    plan = plan_of(QUERIES["roc_points"](spark, SMALL))
    assert not re.search(r"SortMergeJoin.*?\n.*?label", plan) or "BroadcastHashJoin" in plan
    assert "SinglePartition" not in plan
