"""Cohorts, pairs, signals, comparison and severity against brute force."""

import math
import statistics

import pytest
from pyspark.sql import functions as F

from adrlens.operators import cohorts, compare, pairs, profiles, severity, signals
from adrlens.study import AUTOIMMUNE, COINFECTION, HBV_STUDY as STUDY, MONO, OTHER, SignalThresholds
from conftest import rows
from reference_rules import cells, cohort_sets, pair_rows, random_data, signals as brute_signals


@pytest.fixture(scope="module", params=[(60, 0, 1), (40, 400, 2)], ids=["even", "hot_case"])
def case(request, make_tables):
    n, hot, seed = request.param
    data = random_data(STUDY, n, hot, seed)
    return data, make_tables(**data)


def test_cohorts(case):
    data, tables = case
    _, expected = cohort_sets(data, STUDY)
    assigned = cohorts.assign_cohorts(tables.demo, cohorts.exposures(tables.drug, STUDY), STUDY)
    assert rows(assigned, "cohort", "primaryid") == sorted(
        ((c, i) for c, ids in expected.items() for i in ids), key=repr)


def test_three_cohorts_partition_the_cases(case):
    data, tables = case
    assigned = cohorts.assign_cohorts(tables.demo, cohorts.exposures(tables.drug, STUDY), STUDY)
    main = assigned.where(F.col("cohort").isin(MONO, COINFECTION, OTHER))
    assert main.count() == main.select("primaryid").distinct().count() == len(data["demo"])


def test_exposure_counts(case):
    data, tables = case
    exposed, expected = cohort_sets(data, STUDY)
    got = dict(rows(cohorts.exposure_counts(cohorts.exposures(tables.drug, STUDY), STUDY)))
    assert got[cohorts.ANY_ANTIVIRAL] == len(set().union(*exposed.values()))
    assert all(got.get(c, 0) == len(ids) for c, ids in exposed.items())


@pytest.mark.parametrize("order", [(MONO, COINFECTION, AUTOIMMUNE, OTHER),
                                   (AUTOIMMUNE, MONO, COINFECTION, OTHER)])
def test_pair_rows(case, order):
    data, tables = case
    got = rows(pairs.drug_adr_pairs(
        tables.reac, pairs.exposed_cases_of(tables, STUDY, order), STUDY))
    assert got == sorted(pair_rows(data, STUDY, order), key=repr)


def test_cells_and_margins(case):
    data, tables = case
    facts = pairs.pair_facts_of(tables, STUDY)
    expected = {}
    for cohort in (MONO, COINFECTION):
        mine = [p for p in pair_rows(data, STUDY) if p[3] == cohort]
        expected.update({(cohort, *k): v for k, v in cells(mine).items()})
    got = {tuple(r[:3]): tuple(r[3:]) for r in signals.contingency(facts, STUDY).collect()}
    assert got.keys() == expected.keys()
    for key, value in expected.items():
        assert got[key] == pytest.approx(value)
        assert min(got[key][:4]) >= 0


LOOSE = SignalThresholds(ror_lower_ci=0.2, prr=1.0, ic_lower_ci=-2.0, min_cases=2)


@pytest.mark.parametrize("pooled", [False, True])
def test_signals(case, pooled):
    data, tables = case
    study = STUDY.__class__(**{**STUDY.__dict__, "thresholds": LOOSE})
    all_pairs = pair_rows(data, study)
    groups = {"ALL": all_pairs} if pooled else {
        c: [p for p in all_pairs if p[3] == c] for c in (MONO, COINFECTION)}
    expected = {(c, *k): v for c, ps in groups.items() for k, v in brute_signals(ps, LOOSE).items()}
    found = signals.detect_signals(pairs.pair_facts_of(tables, study), study,
                                   None if pooled else (MONO, COINFECTION, AUTOIMMUNE))
    got = {(r.cohort, r.drug, r.adr): (r.n_cases, r.ror, r.ror_lower_ci, r.prr, r.ic, r.ic_025,
                                       r.avg_severity, r.is_signal) for r in found.collect()}
    assert expected and got.keys() == expected.keys()
    for key, value in expected.items():
        assert got[key] == pytest.approx(value), key
    for r in found.collect():
        assert r.ror_lower_ci * r.ror_upper_ci == pytest.approx(r.ror ** 2)


def test_row_order_changes_nothing(case, make_tables):
    data, tables = case
    flipped = make_tables(**{k: list(reversed(v)) for k, v in data.items()})
    first, second = (signals.contingency(pairs.pair_facts_of(t, STUDY), STUDY) for t in (tables, flipped))
    assert rows(first) == rows(second)


def test_null_event_counts_in_margins_only(make_tables):
    tables = make_tables(
        drug=[dict(primaryid=str(i), drugname="VIREAD") for i in range(4)],
        reac=[dict(primaryid=str(i), pt="rash") for i in range(3)] + [dict(primaryid="3", pt=None)])
    (cell,) = rows(signals.contingency(pairs.pair_facts_of(tables, STUDY), STUDY))
    assert cell == (MONO, "TENOFOVIR", "rash", 3, 1, 0, 0, 1.0)
    assert signals.detect_signals(pairs.pair_facts_of(tables, STUDY), STUDY).count() == 0


def test_hand_checked_signal(spark):
    cell = spark.createDataFrame([("c", "d", "e", 10, 20, 30, 940, 2.0), ("c", "d", "f", 2, 20, 30, 940, 2.0),
                                  ("c", "d", "g", 5, 20, 0, 940, 2.0)],
                                 "cohort string, drug string, adr string, a long, b long, c long, d long, "
                                 "avg_severity double")
    (row,) = signals.score_cells(cell, STUDY.thresholds).collect()
    assert row.is_signal and row.n_cases == 10 and row.prr == pytest.approx(10.777777777777777)


def test_severity_profile(case):
    data, tables = case
    got = {r.cohort: r for r in severity.severity_profile(pairs.case_records(
        tables.reac, pairs.exposed_cases_of(tables, STUDY), STUDY)).collect()}
    for cohort in (MONO, COINFECTION):
        mine = [p for p in pair_rows(data, STUDY) if p[3] == cohort]
        grades = [p[4] for p in mine]
        r = got.pop(cohort)
        assert (r.n_cases, r.n_adr_records) == (len({p[0] for p in mine}), len(mine))
        assert r.mean_severity == pytest.approx(statistics.fmean(grades))
        assert r.median_severity == statistics.median(grades)
        assert [r[f"severity_{g}_count"] for g in range(1, 6)] == [grades.count(g) for g in range(1, 6)]
    assert not got


def test_case_severity(make_tables):
    tables = make_tables(outc=[dict(primaryid="1", outc_cod="OT"), dict(primaryid="1", outc_cod="HO"),
                               dict(primaryid="2", outc_cod="XX"), dict(primaryid="3", outc_cod=None)])
    assert rows(severity.case_severity(tables.outc, STUDY)) == [("1", 3), ("2", 1), ("3", 1)]


def test_comparison(case):
    data, tables = case
    all_pairs = pair_rows(data, STUDY)
    one, two = ([p[2] for p in all_pairs if p[3] == c] for c in (MONO, COINFECTION))
    got = {r.adr: r for r in compare.compare_cohorts(pairs.pair_facts_of(tables, STUDY), STUDY).collect()}
    assert got.keys() == {a for a in one + two if a is not None}
    for adr, r in got.items():
        k1, k2, n1, n2 = one.count(adr), two.count(adr), len(one), len(two)
        assert (r.hbv_mono_count, r.hiv_hbv_count) == (k1, k2)
        assert r.hbv_mono_prop == pytest.approx(k1 / n1)
        assert r.risk_ratio == (pytest.approx(k1 / n1 / (k2 / n2)) if k2 else None)
        if min(k1, k2) < 5:
            assert r.chi2 is None and r.p_value is None
            continue
        expected = [(n, k * n / (n1 + n2)) for n in (n1, n2) for k in (k1 + k2, n1 + n2 - k1 - k2)]
        observed = [k1, n1 - k1, k2, n2 - k2]
        chi2 = sum((o + math.copysign(min(0.5, abs(e - o)), e - o) - e) ** 2 / e
                   for o, (_, e) in zip(observed, expected))
        assert r.chi2 == pytest.approx(chi2)
        assert r.p_value == pytest.approx(math.erfc(math.sqrt(chi2 / 2)))


def test_zero_risk_ratio_ranks_first(spark):
    df = spark.createDataFrame(
        [("a", 0.0, 0.0, 0.1), ("b", 8.0, 0.8, 0.1), ("c", None, 0.1, 0.0), ("d", 0.1, 0.01, 0.1)],
        "adr string, risk_ratio double, hbv_mono_prop double, hiv_hbv_prop double")
    got = [(r.adr, r.abs_diff) for r in compare.largest_differences(df, 3).collect()]
    assert got[0] == ("a", math.inf) and [g[0] for g in got] == ["a", "d", "b"]


def test_volcano_leaves_out_infinities(spark):
    df = spark.createDataFrame([("a", 0.0, 0.01), ("b", 4.0, 0.0), ("c", 4.0, 0.01), ("d", 4.0, None)],
                               "adr string, risk_ratio double, p_value double")
    points = compare.volcano(df)
    assert rows(points, "adr", "volcano_class") == [("c", "enriched_mono")]
    assert rows(compare.volcano_labels(points), "rank", "adr") == [(1, "c")]


def test_pairs_profile_and_top_events(case):
    data, tables = case
    facts = pairs.pair_facts_of(tables, STUDY)
    all_pairs = pair_rows(data, STUDY)
    for cohort, n_cases, n_rows, n_adrs in rows(profiles.pairs_profile(facts, STUDY)):
        mine = [p for p in all_pairs if p[3] == cohort]
        assert (n_cases, n_rows) == (len({p[0] for p in mine}), len(mine))
        assert n_adrs == len({p[2] for p in mine} - {None})
    mono = [p for p in all_pairs if p[3] == MONO and p[2] is not None]
    expected = []
    for drug in sorted({p[1] for p in mono}):
        events = [p[2] for p in mono if p[1] == drug]
        ranked = sorted(set(events), key=lambda e: (-events.count(e), e))[:3]
        expected += [(drug, i + 1, e, events.count(e)) for i, e in enumerate(ranked)]
    top = profiles.top_events_per_drug(facts, STUDY, n=3)
    assert rows(top, "drug_class", "rank", "adr", "n_rows") == sorted(expected, key=repr)


def test_risk_scores(spark):
    df = spark.createDataFrame([("B", 2.0), ("A", 1.0), ("A", 4.0)], "drug string, ror double")
    scores = signals.drug_risk_scores(df)
    assert rows(scores) == [("A", 2.5), ("B", 2.0)]
    assert [r.line for r in signals.risk_score_lines(scores).collect()] == ["'A': 2.5000,", "'B': 2.0000,"]


@pytest.mark.parametrize("bits, error", [(1 << 28, 0.001), (1 << 16, 0.02), (64, 1.0)])
def test_filter_of_many_ids_loses_none(spark, bits, error):
    ids = spark.range(0, 20_000, 20).select(F.concat(F.lit("c"), "id").alias("primaryid"))
    rows_ = spark.range(20_000).select(F.concat(F.lit("c"), "id").alias("primaryid"), F.lit("x").alias("pt"))
    rows_ = rows_.unionByName(rows_.limit(1).withColumn("primaryid", F.lit(None).cast("string")))
    kept = pairs.may_be_among(rows_, ids, bits=bits)
    assert kept.columns == ["primaryid", "pt"]
    assert kept.join(ids, "primaryid", "left_semi").count() == 1000
    assert kept.count() <= 1000 + error * 19_000
    assert pairs.may_be_among(rows_, ids.limit(0)).isEmpty()


def test_reactions_beyond_a_broadcast_are_filtered_before_the_shuffle(spark):
    """With more ids than may be broadcast, only the exposed share of the reactions is left."""
    reac = spark.range(30_000).select(F.concat(F.lit("c"), (F.col("id") % 10_000).cast("string")).alias("primaryid"),
                                      F.lit("x").alias("pt"))
    exposed = spark.range(0, 10_000, 25).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("primaryid"), F.lit(1).alias("bits"))
    few, many = pairs.of_exposed(reac, exposed), pairs.of_exposed(reac, exposed, few=10)
    assert few.count() == 1200 and 1200 <= many.count() <= 1200 + 0.001 * 28_800
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert many.join(exposed, "primaryid").count() == 1200
