"""Split, ladder, metrics, training and scoring."""

import dataclasses
import random

import pytest
from pyspark.sql import functions as F

from adrlens.operators import ladder, ml, scoring
from adrlens.sources.tables import load_models, save_models
from adrlens.study import HBV_STUDY as STUDY
from conftest import rows


@pytest.fixture(scope="module")
def planted(spark):
    """Feature rows whose labels follow the inputs; two rows per case."""
    n = F.col("id")
    noise = F.pmod(F.hash("id"), F.lit(100)) / 100.0
    values = {c: F.lit(0.0) for c in STUDY.feature_columns}
    values["age_years"] = F.pmod(F.hash(n + 7), F.lit(90)).cast("double")
    values["sex_binary"] = n % 2
    values["drug_tenofovir"] = (F.floor(n / 2) % 2).cast("int")
    values["drug_risk_score"] = noise
    flag = (F.col("drug_tenofovir") == 1) & (F.col("age_years") > 40)
    base = spark.range(3000).select((F.floor(n / 2)).cast("string").alias("primaryid"),
                                    *[v.cast("double").alias(c) for c, v in values.items()])
    labels = {c: F.lit(0) for c in STUDY.labels}
    labels["adr_nephrotoxicity"] = F.when(flag, 1).otherwise(0)
    labels["adr_bone_tooth"] = F.when(F.col("age_years") > 60, 1).otherwise(0)
    return base.select("*", *[v.alias(c) for c, v in labels.items()]).cache()


def test_split(planted):
    sides = ml.split(planted, STUDY, 0.2, 42).select(
        "primaryid", ml.has_any_label(STUDY).alias("s"), "is_test")
    per_row = ml.split(planted.withColumn("row", F.monotonically_increasing_id()), STUDY, 0.2, 42,
                       unit=("primaryid", "row"))
    total = per_row.groupBy(ml.has_any_label(STUDY).alias("s")).agg(
        F.count("*").alias("n"), F.sum(F.col("is_test").cast("int")).alias("k"))
    assert all(k == round(n * 0.2) for _, n, k in total.collect())
    assert rows(sides) == rows(ml.split(planted.repartition(7), STUDY, 0.2, 42).select(
        "primaryid", ml.has_any_label(STUDY).alias("s"), "is_test"))
    assert rows(sides) != rows(ml.split(planted, STUDY, 0.2, 43).select(
        "primaryid", ml.has_any_label(STUDY).alias("s"), "is_test"))


def test_rows_of_a_case_stay_together(planted):
    constant = planted.withColumn("adr_nephrotoxicity", F.lit(0)).withColumn("adr_bone_tooth", F.lit(0))
    sides = ml.split(constant, STUDY).groupBy("primaryid").agg(F.countDistinct("is_test").alias("n"))
    assert sides.where("n > 1").count() == 0
    assert ml.split(constant, STUDY).where("is_test").count() == 600


def brute_auc(data):
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    wins = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
    return wins / (len(pos) * len(neg)) if pos and neg else 0.0


def test_auc_by_hand(spark):
    df = spark.createDataFrame([("a", y, s) for y, s in zip((1, 1, 0, 1, 0), (.9, .8, .8, .4, .1))]
                               + [("one", 1, 0.5), ("one", 1, 0.7)], "label string, y int, score double")
    assert dict(rows(ladder.auc(df))) == {"a": 0.75, "one": 0.0}
    assert rows(ladder.roc_points(df).where("label = 'one'")) == []


def test_ladder_against_brute_force(spark):
    rng = random.Random(5)
    choices = [0.0, 1.0, 0.5, 0.5 + 1e-9, 0.5 + 2e-9, 0.25, 1 / 3]
    data = [(label, rng.randint(0, 1), rng.choice([rng.random(), rng.random() / 1000, *choices]))
            for label in "ab" for _ in range(300)]
    data += [("a", 1, 0.5)] * 200  # one score holds a third of the rows
    df = spark.createDataFrame(data, "label string, y int, score double")
    got = {(r.label, r.score): (r.pos, r.neg, r.pos_above, r.neg_above)
           for r in ladder.score_ladder(df).collect()}
    for label in "ab":
        mine = [(y, s) for lab, y, s in data if lab == label]
        for score in {s for _, s in mine}:
            assert got[label, score] == (
                sum(1 for y, s in mine if y and s == score), sum(1 for y, s in mine if not y and s == score),
                sum(1 for y, s in mine if y and s > score), sum(1 for y, s in mine if not y and s > score))
        assert dict(rows(ladder.auc(df)))[label] == pytest.approx(brute_auc(mine))
    curve = sorted((r.fpr, r.tpr) for r in ladder.roc_points(df).where("label = 'a'").collect())
    assert curve[0] == (0.0, 0.0) and curve[-1] == (1.0, 1.0)


def test_classification_metrics(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 0, 1), ("a", 1, 0), ("a", 0, 0), ("a", 1, 1),
                                ("none", 1, 0), ("none", 0, 0)], "label string, y int, prediction int")
    got = {r.label: r for r in ladder.classification_metrics(df).collect()}
    assert (got["a"].precision, got["a"].recall, got["a"].f1) == pytest.approx((2 / 3, 2 / 3, 2 / 3))
    assert (got["none"].precision, got["none"].recall, got["none"].f1) == (0.0, 0.0, 0.0)
    hard = dict(rows(ladder.hard_label_auc(ladder.classification_metrics(df))))
    assert hard["a"] == pytest.approx(brute_auc([(1, 1), (0, 1), (1, 0), (0, 0), (1, 1)]))


def test_verdict(spark):
    def of(value):
        df = spark.createDataFrame([(value, 0.1, 0.2, 0.3)], "test_auc double, precision double, "
                                   "recall double, f1 double")
        return ladder.verdict(df).first().verdict

    assert [of(x) for x in (0.75, 0.70, 0.65, 0.6)] == ["EXCELLENT", "GOOD", "FAIR", "WEAK"]


def test_scaling_is_by_population(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, c double")
    got = {r.feature: (r["mean"], r["std"]) for r in ml.scaling(df, ["x", "c"]).collect()}
    assert got["x"] == pytest.approx((2.0, 0.816496580927726)) and got["c"] == (5.0, 0.0)
    scaled = ml.scaler_stage(df, ["x", "c"]).transform(df).orderBy("x").collect()
    assert [r.scaled_x for r in scaled] == pytest.approx([-1.224744871391589, 0, 1.224744871391589])
    assert [r.scaled_c for r in scaled] == [0.0, 0.0, 0.0]


@pytest.fixture(scope="module")
def trained(planted):
    divided = ml.split(planted, STUDY)
    return divided, ml.train_forests(divided.where("NOT is_test"), STUDY, ml.ForestParams(trees=10))


def test_training_finds_the_planted_signal(trained):
    divided, models = trained
    assert set(models) == {"adr_nephrotoxicity", "adr_bone_tooth"}  # the others have one class
    predicted = ml.predict(divided, models, STUDY)
    assert predicted.where("score_adr_bone_tooth < 0 OR score_adr_bone_tooth > 1").count() == 0
    table = {r.category: r for r in ml.evaluate(ml.long_predictions(predicted, list(models))).collect()}
    assert table["adr_nephrotoxicity"].test_auc > 0.95 and table["adr_bone_tooth"].test_auc > 0.95
    assert table["adr_bone_tooth"].train_auc <= table["adr_bone_tooth"].train_auc_probability + 1e-9


def test_training_rows_lie_sorted_in_each_partition(planted, monkeypatch):
    prepared = []

    write = ml.materialise

    def keep(df, *args, **options):
        prepared.append(df)
        return write(df, *args, **options)

    monkeypatch.setattr(ml, "materialise", keep)
    ml.train_forests(planted, STUDY, ml.ForestParams(trees=1, depth=1))
    parts = prepared[0].select("features", F.spark_partition_id().alias("part")).collect()
    assert len(parts) == planted.count()
    for part in {r["part"] for r in parts}:
        own = [tuple(r["features"].toArray()[::-1]) for r in parts if r["part"] == part]
        assert own == sorted(own)


def test_importance(spark, trained):
    top = ml.feature_importance(trained[1], STUDY, spark).where("rank = 1")
    assert dict(rows(top, "label", "feature"))["adr_bone_tooth"] == "age_years"


def test_saved_models_score_the_same(trained, tmp_path):
    divided, models = trained
    save_models(models, f"{tmp_path}/models")
    again = load_models(f"{tmp_path}/models", list(models))
    few = divided.limit(50)
    first, second = (rows(ml.predict(few, m, STUDY), "primaryid", "score_adr_bone_tooth")
                     for m in (models, again))
    assert first == second


PROFILE = "profile_id string, age int, sex string, cohort string, reporter string, drug string, polypharmacy string"


def test_profile_features(spark):
    df = spark.createDataFrame(
        [("a", 45, "Male", "HBV Monoinfection", "Healthcare Professional", "TENOFOVIR", "Low (1-2)"),
         ("b", 30, "Female", "HIV/HBV Coinfection", "Lawyer", "ADEFOVIR", "Medium (3-5)"),
         ("c", 80, "Female", "HBV + Autoimmune", "Consumer", "OTHER", "High (6+)"),
         ("d", 80, "Female", "HBV Other", "Consumer", "INTERFERON", "High (6+)")], PROFILE)
    got = scoring.profile_features(df, STUDY)
    assert got.columns == ["profile_id", *STUDY.feature_columns]
    assert rows(got, "profile_id", "sex_binary", "reporter_md", "reporter_lawyer", "reporter_consumer",
                "drug_count", "cohort_hbv_mono", "cohort_hiv_hbv", "cohort_autoimmune", "drug_risk_score",
                "severity_score") == [
        ("a", 1, 1, 0, 0, 1.5, 1, 0, 0, 4.022, 1), ("b", 0, 0, 1, 0, 4.0, 0, 1, 0, 24.5285, 1),
        ("c", 0, 0, 0, 1, 7.0, 0, 0, 1, 1.0, 1), ("d", 0, 0, 0, 1, 7.0, 0, 0, 0, 11.2757, 1)]


def test_scoring(spark, trained):
    df = spark.createDataFrame(
        [("a", 85, "Male", "HBV Monoinfection", "Consumer", "TENOFOVIR", "Low (1-2)"),
         ("b", 20, "Male", "HBV Monoinfection", "Consumer", "ENTECAVIR", "Low (1-2)")], PROFILE)
    scored = scoring.score_profiles(df, trained[1], STUDY)
    got = {(r.profile_id, r.category): r for r in scored.collect()}
    assert got["a", "bone_tooth"].risk_level == "High" and "DEXA" in got["a", "bone_tooth"].advice
    assert got["b", "bone_tooth"].risk_level != "High" and got["b", "bone_tooth"].advice is None
    summary = {r.profile_id: r for r in scoring.risk_summary(scored, STUDY).collect()}
    assert summary["a"].action == "Action Required" and "Bone Tooth" in summary["a"].high_risks
    assert summary["b"].high_risks == "" and summary["b"].action != "Action Required"


def test_profiles_of_one_partition_are_scored_on_several(spark, trained):
    _, models = trained
    profiles = spark.range(20_000).coalesce(1).selectExpr(
        "cast(id as string) profile_id", "id % 90 age", "'Male' sex", "'HBV Monoinfection' cohort", "'Lawyer' reporter",
        "'TENOFOVIR' drug", "'Low (1-2)' polypharmacy")
    scored = scoring.score_profiles(profiles, models, STUDY)
    assert "RebalancePartitions" in scored._jdf.queryExecution().optimizedPlan().toString()
    assert scored.count() == 20_000 * len(models)


def test_no_auc_where_a_side_lacks_a_class(spark):
    data = [(False, "a|test", y, s, int(s > 0.5)) for y, s in ((1, 0.9), (0, 0.1))]
    data += [(True, "a|test", 0, s, int(s > 0.5)) for s in (0.2, 0.7)]
    data += [(side, "b", y, s, int(s > 0.5)) for side in (False, True) for y, s in ((1, 0.8), (0, 0.3))]
    table = {r["category"]: r for r in ml.evaluate(spark.createDataFrame(
        data, "is_test boolean, label string, y int, score double, prediction int")).collect()}
    assert [table["a|test"][c] for c in ("train_auc", "train_auc_probability", "test_auc")] == [0.0, 0.0, 0.0]
    assert [table["b"][c] for c in ("train_auc", "train_auc_probability", "test_auc")] == [1.0, 1.0, 1.0]


def test_a_study_has_a_limit_of_classes():
    classes = {f"C{i}": (f"C{i}",) for i in range(62)}
    with pytest.raises(ValueError, match="61 drug classes"):
        dataclasses.replace(STUDY, drug_classes=classes)
    dataclasses.replace(STUDY, drug_classes=dict(list(classes.items())[:61]))


def test_roc_corners_leave_out_points_between_equal_steps(spark, monkeypatch):
    """Against the rule on plain lists, with bins so coarse or fine that steps cross their borders."""
    import random
    pick = random.Random(2)
    own = [(label, pick.choice((0, 1)) if label != "one" else 1, pick.randrange(n) / n)
           for label, n in (("a", 400), ("b", 12), ("c", 3), ("one", 5)) for _ in range(600)]
    own += [("ties", i % 2, 0.5) for i in range(10)] + [("line", y, i / 64) for i in range(64) for y in (0, 1)]
    df = spark.createDataFrame(own, "label string, y int, score double")
    want = set()
    for label in {r[0] for r in own} - {"one"}:
        steps = {s: (sum(r == (label, 1, s) for r in own), sum(r == (label, 0, s) for r in own)) for _, _, s in own if (label, 1, s) in own or (label, 0, s) in own}
        order = sorted(steps, reverse=True)
        want.add((label, None))
        want |= {(label, s) for i, s in enumerate(order) if i in (0, len(order) - 1) or steps[s] != steps[order[i + 1]]}
    points = {(r.label, r.threshold): (r.tpr, r.fpr) for r in ladder.roc_points(df).collect()}
    for coarse, fine in ((1 << 12, 1 << 24), (4, 16), (1, 2)):
        monkeypatch.setattr(ladder, "COARSE", coarse)
        monkeypatch.setattr(ladder, "FINE", fine)
        found = {(r.label, r.threshold): (r.tpr, r.fpr) for r in ladder.roc_corners(df).collect()}
        assert found.keys() == want and all(points[k] == v for k, v in found.items())
    assert sum(k[0] == "line" for k in found) == 3 and len(found) < len(points)
