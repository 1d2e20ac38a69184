"""Every operator as a query over the star-schema test tables.

A query takes (spark, sf_dir) and returns a frame; doubles are rounded to six decimals so
that two engines agree on the last digits.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from adrlens.functions.matching import any_term
from adrlens.operators import (cases, cohorts, compare, features, ladder, ml, pairs, profiles,
                               scoring, severity, signals)
from adrlens.session import materialise, new_shared_path
from adrlens.sources.case_tables import CaseTables
from adrlens.sources.report_files import read_reports, write_report_files
from adrlens.sources.star_schema import star_case_tables, table
from adrlens.sources.tables import load_models, read_table, save_models, write_table
from adrlens.study import AUTOIMMUNE, COINFECTION, MONO, OTHER, RARE_STUDY, STAR_STUDY as STUDY

Query = Callable[[SparkSession, str], DataFrame]
DIGITS = 6
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = build(spark, sf_dir)
        return df.select(*[F.round(c, DIGITS).alias(c) if t == "double" else F.col(c)
                           for c, t in df.dtypes])

    run.__name__, run.__doc__ = build.__name__, build.__doc__
    QUERIES[build.__name__] = run
    return build


def _facts(spark, sf_dir) -> DataFrame:
    return pairs.pair_facts_of(star_case_tables(spark, sf_dir), STUDY)


# --- signals --------------------------------------------------------------------

def _signals(spark, sf_dir) -> DataFrame:
    return signals.detect_signals(_facts(spark, sf_dir), STUDY)


@query
def all_signals(spark, sf_dir):
    """Signals of each cohort."""
    return signals.by_strength(_signals(spark, sf_dir))


@query
def signals_pooled(spark, sf_dir):
    """Signals over the pairs of all cohorts together."""
    return signals.by_strength(
        signals.detect_signals(_facts(spark, sf_dir), STUDY, cohorts=None))


@query
def signals_autoimmune_first(spark, sf_dir):
    """Signals when an autoimmune case counts for its own cohort."""
    facts = pairs.pair_facts_of(star_case_tables(spark, sf_dir), STUDY,
                                precedence=(AUTOIMMUNE, MONO, COINFECTION, OTHER))
    return signals.by_strength(signals.detect_signals(facts, STUDY))


@query
def top_signals(spark, sf_dir):
    return signals.top_signals(_signals(spark, sf_dir))


@query
def top_signals_per_cohort(spark, sf_dir):
    return signals.top_signals_per_cohort(_signals(spark, sf_dir))


@query
def signals_per_cohort(spark, sf_dir):
    return signals.signals_per_cohort(_signals(spark, sf_dir))


@query
def drug_risk_scores(spark, sf_dir):
    return signals.drug_risk_scores(_signals(spark, sf_dir))


@query
def risk_score_lines(spark, sf_dir):
    return signals.risk_score_lines(signals.drug_risk_scores(_signals(spark, sf_dir)))


# --- cohorts, pairs, severity ---------------------------------------------------

def _assignments(spark, sf_dir) -> DataFrame:
    tables = star_case_tables(spark, sf_dir)
    return cohorts.assign_cohorts(tables.demo, cohorts.exposures(tables.drug, STUDY), STUDY)


@query
def cohort_assignments(spark, sf_dir):
    return _assignments(spark, sf_dir)


@query
def cohort_sizes(spark, sf_dir):
    return cohorts.cohort_sizes(_assignments(spark, sf_dir))


@query
def exposure_counts(spark, sf_dir):
    tables = star_case_tables(spark, sf_dir)
    return cohorts.exposure_counts(cohorts.exposures(tables.drug, STUDY), STUDY)


@query
def drug_adr_pairs(spark, sf_dir):
    tables = star_case_tables(spark, sf_dir)
    return pairs.drug_adr_pairs(tables.reac, pairs.exposed_cases_of(tables, STUDY), STUDY)


@query
def pairs_profile(spark, sf_dir):
    return profiles.pairs_profile(_facts(spark, sf_dir), STUDY)


@query
def top_adr_per_drug(spark, sf_dir):
    return profiles.top_events_per_drug(_facts(spark, sf_dir), STUDY)


def _severity(spark, sf_dir) -> DataFrame:
    tables = star_case_tables(spark, sf_dir)
    return severity.severity_profile(
        pairs.case_records(tables.reac, pairs.exposed_cases_of(tables, STUDY), STUDY))


@query
def severity_profile(spark, sf_dir):
    return _severity(spark, sf_dir)


@query
def severity_main(spark, sf_dir):
    return severity.main_cohorts_only(_severity(spark, sf_dir))


@query
def case_severity(spark, sf_dir):
    return severity.case_severity(star_case_tables(spark, sf_dir).outc, STUDY)


# --- comparison -----------------------------------------------------------------

def _comparison(spark, sf_dir) -> DataFrame:
    return compare.compare_cohorts(_facts(spark, sf_dir), STUDY)


@query
def cohort_compare(spark, sf_dir):
    """The logarithm beside the p-value shows the digits of very small ones."""
    return (compare.by_risk_ratio(_comparison(spark, sf_dir))
            .withColumn("log10_p", F.when(F.col("p_value") > 0, F.log10("p_value"))))


@query
def rr_extremes(spark, sf_dir):
    return compare.risk_ratio_extremes(_comparison(spark, sf_dir))


@query
def rr_heatmap(spark, sf_dir):
    return compare.largest_differences(_comparison(spark, sf_dir))


@query
def volcano(spark, sf_dir):
    return compare.volcano(_comparison(spark, sf_dir))


@query
def volcano_labels(spark, sf_dir):
    return compare.volcano_labels(compare.volcano(_comparison(spark, sf_dir)))


# --- rare exposure: cells below the least count, ratios of zero, no test ---------------

def _rare_facts(spark, sf_dir) -> DataFrame:
    return pairs.pair_facts_of(star_case_tables(spark, sf_dir), RARE_STUDY)


@query
def rare_signals(spark, sf_dir):
    return signals.by_strength(signals.detect_signals(_rare_facts(spark, sf_dir), RARE_STUDY))


@query
def rare_compare(spark, sf_dir):
    return compare.by_risk_ratio(compare.compare_cohorts(_rare_facts(spark, sf_dir), RARE_STUDY))


@query
def rare_heatmap(spark, sf_dir):
    return compare.largest_differences(compare.compare_cohorts(_rare_facts(spark, sf_dir), RARE_STUDY))


# --- extraction -----------------------------------------------------------------

@query
def case_hits(spark, sf_dir):
    return (cases.case_hits(star_case_tables(spark, sf_dir), STUDY)
            .groupBy("source").agg(F.count("*").alias("n_cases")))


@query
def case_ids(spark, sf_dir):
    return cases.case_ids(star_case_tables(spark, sf_dir), STUDY)


@query
def case_drug_rows(spark, sf_dir):
    """Drug rows that match a whole word of a drug class name."""
    drug = star_case_tables(spark, sf_dir).drug
    terms = [t for names in STUDY.drug_classes.values() for t in names]
    return (drug.where(any_term(cases.DRUG_TEXT, terms, match="word"))
            .groupBy("drugname").agg(F.count("*").alias("n_rows")))


def _kept(spark, sf_dir) -> CaseTables:
    tables = star_case_tables(spark, sf_dir)
    return cases.keep_cases(tables, cases.case_ids(tables, STUDY))


@query
def extract_tables(spark, sf_dir):
    return profiles.extract_counts(_kept(spark, sf_dir))


def _extracted(spark, sf_dir) -> CaseTables:
    return cases.extract_cases(star_case_tables(spark, sf_dir), STUDY)


@query
def dedupe_latest(spark, sf_dir):
    demo = cases.latest_versions(star_case_tables(spark, sf_dir).demo)
    return demo.select("primaryid", "caseid", "caseversion", "year_quarter")


@query
def dedupe_counts(spark, sf_dir):
    """Reports before and after the latest version of each case is kept."""
    return cases.dedupe_counts(star_case_tables(spark, sf_dir).demo)


@query
def cascade(spark, sf_dir):
    """Rows per table and quarter once only the latest report of each case is left."""
    return profiles.extract_counts(_extracted(spark, sf_dir))


@query
def demographics(spark, sf_dir):
    demo = cases.clean_demographics(star_case_tables(spark, sf_dir).demo)
    return demo.select("primaryid", "age", "age_cod", "age_years", "sex", "event_dt", "event_date")


@query
def extraction_profile(spark, sf_dir):
    return profiles.extraction_profile(_extracted(spark, sf_dir))


@query
def frequency_tables(spark, sf_dir):
    return profiles.frequency_tables(_extracted(spark, sf_dir), STUDY)


@query
def report_files(spark, sf_dir):
    """Write all tables as quarterly report files, read them back, count per quarter."""
    folder = new_shared_path(spark, "reports")
    write_report_files(star_case_tables(spark, sf_dir), folder)
    return profiles.extract_counts(read_reports(spark, folder, years=range(1970, 2070)))


REACTION_HEADER, DRUG_HEADER = "primaryid$caseid$pt$drug_rec_act", " PRIMARYID $ CASEID$  DrugName  "


def _write_lines(lines: DataFrame, header: str, table_name: str, folder: str) -> None:
    """(year_quarter, line) as one text file per quarter, its header first."""
    report = F.format_string(f"{table_name}%sQ%s.txt", F.substring("year_quarter", 3, 2), F.substring("year_quarter", 7, 1))
    rows = lines.select(report.alias("report"), F.lit(1).alias("rank"), F.col("line").alias("value"))
    heads = rows.select("report", F.lit(0).alias("rank"), F.lit(header).alias("value")).distinct()
    (rows.unionByName(heads).repartition("report").sortWithinPartitions("report", "rank")
     .select("report", "value").write.partitionBy("report").text(folder))


@query
def report_lines(spark, sf_dir):
    """Values read from lines that are written as plain text: quotes, breaks, short, long and empty lines."""
    folder = new_shared_path(spark, "lines")
    tables = star_case_tables(spark, sf_dir)
    text, key, early = F.col("pt"), F.col("primaryid").cast("long"), F.substring("year_quarter", 7, 1) < "3"
    case = F.concat_ws("$", "primaryid", "caseid")
    kinds = [F.concat(case, F.lit("$"), text, F.lit("$x")),
             F.concat(case, F.lit('$"a ""'), text, F.lit('"" c"$x')),
             F.when(early, F.concat(case, F.lit('$"one\n'), text, F.lit('"$y'))).otherwise(F.lit("")),
             F.concat(case, F.lit('$"'), text, F.lit('\\"$w')),
             case,
             F.concat(case, F.lit("$a$b$"), text),
             F.concat(case, F.lit("$NA$None")),
             F.concat(case, F.lit('$"'), text, F.lit('$d"$"z"')),
             F.lit("$$$"),
             F.when(early, F.concat(case, F.lit("$"), text, F.lit("$x"))).otherwise(
                 F.concat(case, F.lit('$"open '), text, F.lit("$v")))]
    line = F.element_at(F.array(*kinds), (key % len(kinds) + 1).cast("int"))
    _write_lines(tables.reac.select("year_quarter", line.alias("line")), REACTION_HEADER, "REAC", f"{folder}/r")
    _write_lines(tables.drug.select("year_quarter", F.concat_ws("$", "primaryid", "caseid", "drugname").alias("line")),
                 DRUG_HEADER, "drug", f"{folder}/d")
    read = read_reports(spark, folder, years=range(1970, 2070))
    return (read.reac.select(F.lit("reac").alias("table_name"), "primaryid", "caseid", F.col("pt").alias("text"),
                             F.col("drug_rec_act").alias("more"), "year_quarter")
            .unionByName(read.drug.select(F.lit("drug").alias("table_name"), "primaryid", "caseid",
                                          F.col("drugname").alias("text"), F.col("prod_ai").alias("more"), "year_quarter")))


@query
def reloaded_table(spark, sf_dir):
    """Text with blanks, tabs, quotes, breaks, nulls and empty text, written as CSV and reloaded."""
    key, name = F.col("c_custkey"), F.col("c_name")
    texts = [F.concat(F.lit(" "), name, F.lit("  ")), F.concat(name, F.lit("\t")), F.concat(F.lit('a "'), name, F.lit('"')),
             F.concat(name, F.lit("\nnext")), F.concat(name, F.lit("\\")), F.lit(""), F.lit(None).cast("string")]
    df = table(spark, sf_dir, "customer").select(
        key.cast("string").alias("id"), F.element_at(F.array(*texts), (key % len(texts) + 1).cast("int")).alias("sex"))
    path = new_shared_path(spark, "sink")
    write_table(df, path, "csv")
    return read_table(spark, path, df.schema, "csv")


# --- features -------------------------------------------------------------------

def _clean_tables(spark, sf_dir) -> CaseTables:
    return star_case_tables(spark, sf_dir).map(
        lambda name, df: cases.clean_demographics(df) if name == "demo" else df)


def _reduced(spark, sf_dir) -> tuple[CaseTables, DataFrame, features.Reduced]:
    """Clean tables, risk scores and the reduced drugs and reactions that both come from."""
    tables = _clean_tables(spark, sf_dir)
    small = features.reduced(tables, STUDY)
    exposed = pairs.exposed_cases(small.exposures, tables.outc, STUDY)
    found = signals.detect_signals(pairs.facts_from_counts(small.reactions, exposed), STUDY)
    return tables, signals.drug_risk_scores(found), small


def _case_drug(spark, sf_dir) -> DataFrame:
    tables, scores, small = _reduced(spark, sf_dir)
    return features.case_drug_features(tables, scores, STUDY, small)


@query
def features_case_drug(spark, sf_dir):
    return _case_drug(spark, sf_dir)


@query
def features_case(spark, sf_dir):
    tables, scores, small = _reduced(spark, sf_dir)
    return features.case_features(tables, scores, STUDY, small)


@query
def label_prevalence(spark, sf_dir):
    return features.label_prevalence(_case_drug(spark, sf_dir), STUDY)


@query
def feature_distributions(spark, sf_dir):
    return features.feature_distributions(_clean_tables(spark, sf_dir), STUDY)


@query
def split_prevalence(spark, sf_dir):
    """Label prevalence of the train and the test side."""
    return ml.split_prevalence(ml.split(materialise(_case_drug(spark, sf_dir), "features"), STUDY), STUDY)


@query
def polypharmacy_profile(spark, sf_dir):
    return features.polypharmacy_profile(star_case_tables(spark, sf_dir).drug)


@query
def severity_rates(spark, sf_dir):
    return features.severity_rates(star_case_tables(spark, sf_dir).outc, STUDY)


@query
def scaling(spark, sf_dir):
    return ml.scaling(_case_drug(spark, sf_dir), STUDY.feature_columns)


@query
def split(spark, sf_dir):
    """Side of every case and its stratum."""
    divided = ml.split(materialise(_case_drug(spark, sf_dir), "features"), STUDY)
    return (divided.groupBy("primaryid", ml.has_any_label(STUDY).alias("any_label"))
            .agg(F.max("is_test").alias("is_test"), F.count("*").alias("n_rows")))


# --- metrics on a planted score -------------------------------------------------

def _planted(spark, sf_dir) -> DataFrame:
    """(label, y, score): labels of every case with a score that leans towards them."""
    labels = features.event_labels(star_case_tables(spark, sf_dir).reac, STUDY)
    key = F.col("primaryid").cast("long")
    entries = F.array(*[
        F.struct(F.lit(c).alias("label"), F.col(c).alias("y"),
                 (((key * 37 + 11 * i) % 101 + 40 * F.col(c)) / F.lit(141.0)).alias("score"))
        for i, c in enumerate(STUDY.labels)])
    return labels.select("primaryid", F.inline(entries))


def _planted_classes(spark, sf_dir) -> DataFrame:
    return _planted(spark, sf_dir).withColumn(
        "prediction", F.when(F.col("score") > 0.5, 1).otherwise(0))


@query
def roc_points(spark, sf_dir):
    return ladder.roc_points(_planted(spark, sf_dir))


@query
def roc_corners(spark, sf_dir):
    return ladder.roc_corners(_planted(spark, sf_dir))


@query
def auc(spark, sf_dir):
    return ladder.auc(_planted(spark, sf_dir))


@query
def classification_metrics(spark, sf_dir):
    return ladder.classification_metrics(_planted_classes(spark, sf_dir))


@query
def performance_verdict(spark, sf_dir):
    """Test metrics and verdict with a fifth of the cases as the test side."""
    sided = _planted_classes(spark, sf_dir).withColumn(
        "is_test", F.col("primaryid").cast("long") % 5 == 0)
    return ladder.verdict(ml.evaluate(sided))


@query
def evaluation(spark, sf_dir):
    """The evaluation table of the planted score."""
    sided = _planted_classes(spark, sf_dir).withColumn(
        "is_test", F.col("primaryid").cast("long") % 5 == 0)
    return ml.evaluate(sided)


@query
def risk_bands(spark, sf_dir):
    planted = _planted(spark, sf_dir).select(
        F.col("primaryid").alias("profile_id"),
        F.expr("substring(label, 5)").alias("category"), F.col("score").alias("probability"))
    return scoring.risk_assessment(planted, STUDY)


@query
def risk_summary(spark, sf_dir):
    planted = _planted(spark, sf_dir).select(
        F.col("primaryid").alias("profile_id"),
        F.expr("substring(label, 5)").alias("category"), F.col("score").alias("probability"))
    return scoring.risk_summary(scoring.risk_assessment(planted, STUDY), STUDY)


# --- models ---------------------------------------------------------------------

PROFILE_COHORTS = ("HBV Monoinfection", "HIV/HBV Coinfection", "HBV + Autoimmune", "HBV Other")
PROFILE_REPORTERS = ("Healthcare Professional", "Consumer", "Lawyer")
PROFILE_LEVELS = ("Low (1-2)", "Medium (3-5)", "High (6+)")


def _choice(key, options):
    return F.element_at(F.array(*[F.lit(o) for o in options]),
                        (F.pmod(key, F.lit(len(options))) + 1).cast("int"))


def _profiles(spark, sf_dir) -> DataFrame:
    """One patient profile per order."""
    key, price = F.col("o_orderkey"), F.floor("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        key.cast("string").alias("profile_id"), (key % 73 + 18).alias("age"),
        _choice(F.col("o_custkey"), ("Male", "Female")).alias("sex"),
        _choice(F.floor(F.col("o_custkey") / 2), PROFILE_COHORTS).alias("cohort"),
        _choice(price, PROFILE_REPORTERS).alias("reporter"),
        _choice(key, tuple(STUDY.drug_classes)).alias("drug"),
        _choice(F.floor(price / 3), PROFILE_LEVELS).alias("polypharmacy"))


@query
def profile_features(spark, sf_dir):
    return scoring.profile_features(_profiles(spark, sf_dir), STUDY)


LEAST_AUC = 0.55  # what every forest has to reach on the test side


def _trained(spark: SparkSession, sf_dir: str):
    """Split features and fitted models of a folder, saved to the shared folder and reloaded."""
    divided = materialise(ml.split(materialise(_case_drug(spark, sf_dir), "features", spread=True), STUDY), "split")
    path = new_shared_path(spark, "models")
    models = ml.train_forests(divided.where(~F.col("is_test")), STUDY)
    save_models(models, path)
    return divided, models, load_models(path, list(models))


@query
def train_eval(spark, sf_dir):
    """Train, save and reload the forests: facts about their predictions on the test side."""
    divided, fitted, loaded = _trained(spark, sf_dir)
    labels = list(loaded)
    test = materialise(ml.predict(divided.where("is_test"), loaded, STUDY), "predictions")
    again = ml.predict(divided.where("is_test"), fitted, STUDY)
    long = ml.long_predictions(test, labels)
    sums = lambda df: df.agg(*[F.sum(f"score_{m}").alias(m) for m in labels]).first()  # noqa: E731  one row
    kept, saved = sums(again), sums(test)
    same = [m for m in labels if abs(kept[m] - saved[m]) <= 1e-9 * max(1.0, kept[m])]
    return (
        long.groupBy("label").agg(
            F.count("*").alias("n_test"), F.sum("y").alias("n_positive"),
            F.min(F.col("score").between(0, 1)).alias("probabilities_valid"),
            F.min((F.col("prediction") == 1) == (F.col("score") > 0.5)).alias("classes_follow_scores"))
        .join(ladder.auc(long).select("label", (F.col("auc") > LEAST_AUC).alias("auc_above_floor")), "label")
        .withColumn("reloaded_agrees", F.col("label").isin(same)))


@query
def feature_importance(spark, sf_dir):
    """Per label: features ranked, whether all names are known and all importances sum to one."""
    _, _, models = _trained(spark, sf_dir)
    all_ = ml.feature_importance(models, STUDY, spark, n=len(STUDY.feature_columns))
    top = ml.feature_importance(models, STUDY, spark)
    known = all_.groupBy("label").agg(
        F.count("*").alias("n_features"), (F.abs(F.sum("importance") - 1) < 1e-9).alias("sums_to_one"),
        F.min(F.col("feature").isin(STUDY.feature_columns)).alias("names_known"))
    return top.groupBy("label").agg(
        F.count("*").alias("n_top"), F.array_join(F.sort_array(F.collect_list("rank")), ",").alias("ranks"),
        (F.min("importance") >= 0).alias("not_negative")).join(known, "label")


@query
def score_profiles(spark, sf_dir):
    """Per category: profiles scored, bands that fit their percentage, advice for High only."""
    _, _, models = _trained(spark, sf_dir)
    scored = scoring.score_profiles(_profiles(spark, sf_dir), models, STUDY)
    percent, level = F.col("risk_percent"), F.col("risk_level")
    band = F.when(percent > 50, "High").when(percent > 30, "Medium").otherwise("Low")
    advice = F.create_map(*[F.lit(x) for pair in STUDY.monitoring_advice.items() for x in pair])[F.col("category")]
    fits = F.col("advice").eqNullSafe(F.when(level == "High", advice))
    return scored.groupBy("category").agg(
        F.count("*").alias("n_profiles"), F.countDistinct("profile_id").alias("n_distinct"),
        F.min(percent.between(0, 100)).alias("percent_valid"), F.min(level == band).alias("bands_fit"),
        F.min(fits).alias("advice_fits"))
