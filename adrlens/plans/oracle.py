"""SQL counterparts of the queries, for an independent engine over the same tables.

Written from the definitions: sets, distinct counts and row-level joins, not the plans the
operators use.
"""

from __future__ import annotations

import textwrap

# --- case tables ----------------------------------------------------------------

TABLES = """
demo AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS primaryid,
         CAST(o_orderkey // 2 AS VARCHAR) AS caseid,
         CAST(o_orderkey % 2 + 1 AS VARCHAR) AS caseversion,
         strftime(o_orderdate, '%Y%m%d') AS event_dt,
         CAST(CAST(floor(o_totalprice) AS BIGINT) % 130 AS VARCHAR) AS age,
         CASE left(o_orderpriority, 1) WHEN '1' THEN 'YR' WHEN '2' THEN 'MON'
              WHEN '3' THEN 'DY' WHEN '4' THEN 'DEC' END AS age_cod,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'M' WHEN 'AUTOMOBILE' THEN 'F'
              WHEN 'MACHINERY' THEN ' m ' WHEN 'HOUSEHOLD' THEN 'f' END AS sex,
         CASE o_orderstatus WHEN 'P' THEN 'MD' WHEN 'O' THEN 'CN' WHEN 'F' THEN 'LW' END AS occp_cod,
         ['US','CA','MX','GB','DE','FR','IT','ES','JP','CN','KR','TW','IN','BR','AU',NULL]
           [n_nationkey % 16 + 1] AS reporter_country,
         year(o_orderdate) || ' Q' || quarter(o_orderdate) AS year_quarter
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
line AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS primaryid, l_linenumber, l_quantity, p_name, p_brand, p_type,
         year(l_shipdate) || ' Q' || quarter(l_shipdate) AS year_quarter
  FROM lineitem JOIN part ON l_partkey = p_partkey),
drug AS (SELECT primaryid, p_name AS drugname, upper(p_name) AS name, year_quarter FROM line),
reac AS (SELECT primaryid, p_brand || ' ' || p_type AS pt, year_quarter FROM line),
indi AS (SELECT primaryid, p_type AS indi_pt, year_quarter FROM line),
outc AS (SELECT CAST(l_orderkey AS VARCHAR) AS primaryid,
                ['DE','LT','HO','DS','CA','RI','OT'][l_linenumber] AS outc_cod,
                year(l_shipdate) || ' Q' || quarter(l_shipdate) AS year_quarter
         FROM lineitem WHERE l_quantity <= 10),
rpsr AS (SELECT CAST(o_orderkey AS VARCHAR) AS primaryid,
                year(o_orderdate) || ' Q' || quarter(o_orderdate) AS year_quarter FROM orders)
"""

# --- cohorts and pairs ----------------------------------------------------------

COHORTS = """
class(drug_class) AS (VALUES ('RING'), ('GEAR'), ('ROD'), ('BOLT'), ('PLATE'), ('GIZMO')),
exposed AS (SELECT DISTINCT primaryid, drug_class FROM drug JOIN class ON contains(name, drug_class)),
antiviral AS (SELECT DISTINCT primaryid FROM exposed),
hiv AS (SELECT DISTINCT primaryid FROM drug WHERE contains(name, 'WIDGET')),
immuno AS (SELECT DISTINCT primaryid FROM drug WHERE contains(name, 'ANVIL')),
mono AS (SELECT * FROM antiviral EXCEPT SELECT * FROM hiv),
coinfection AS (SELECT * FROM antiviral INTERSECT SELECT * FROM hiv),
autoimmune AS ((SELECT * FROM antiviral INTERSECT SELECT * FROM immuno) EXCEPT SELECT * FROM hiv),
other AS (SELECT DISTINCT primaryid FROM demo EXCEPT SELECT * FROM antiviral),
assignment AS (
  SELECT primaryid, 'HBV_MONO' AS cohort FROM mono
  UNION ALL SELECT primaryid, 'HIV_HBV_COINFECTION' FROM coinfection
  UNION ALL SELECT primaryid, 'HBV_AUTOIMMUNE' FROM autoimmune
  UNION ALL SELECT primaryid, 'HBV_OTHER' FROM other)
"""

GRADE = """CASE outc_cod WHEN 'DE' THEN 5 WHEN 'LT' THEN 4 WHEN 'HO' THEN 3 WHEN 'DS' THEN 3
     WHEN 'CA' THEN 2 WHEN 'RI' THEN 2 ELSE 1 END"""

PAIRS = COHORTS + f""",
severity AS (SELECT primaryid, CAST(max({GRADE}) AS INTEGER) AS severity FROM outc GROUP BY 1),
pairs AS (
  SELECT r.primaryid, e.drug_class, r.pt AS adr,
         CASE WHEN m.primaryid IS NOT NULL THEN 'HBV_MONO'
              WHEN c.primaryid IS NOT NULL THEN 'HIV_HBV_COINFECTION' ELSE 'UNKNOWN' END AS cohort,
         coalesce(s.severity, 1) AS severity
  FROM reac r JOIN exposed e USING (primaryid)
  LEFT JOIN mono m ON m.primaryid = r.primaryid
  LEFT JOIN coinfection c ON c.primaryid = r.primaryid
  LEFT JOIN severity s ON s.primaryid = r.primaryid)
"""


def signal_ctes(pairs: str = "pairs") -> str:
    return f"""
cell AS (SELECT cohort, drug_class AS drug, adr, count(DISTINCT primaryid) AS a,
                avg(severity) AS avg_severity FROM {pairs} GROUP BY ALL),
by_drug AS (SELECT cohort, drug_class AS drug, count(DISTINCT primaryid) AS n FROM {pairs} GROUP BY ALL),
by_adr AS (SELECT cohort, adr, count(DISTINCT primaryid) AS n FROM {pairs} GROUP BY ALL),
by_cohort AS (SELECT cohort, count(DISTINCT primaryid) AS n FROM {pairs} GROUP BY ALL),
square AS (
  SELECT cohort, drug, adr, avg_severity, a, CAST(d.n - a AS DOUBLE) AS b, CAST(r.n - a AS DOUBLE) AS c,
         CAST(t.n - d.n - r.n + a AS DOUBLE) AS d
  FROM cell JOIN by_drug d USING (cohort, drug) JOIN by_adr r USING (cohort, adr)
            JOIN by_cohort t USING (cohort)),
estimate AS (
  SELECT *, a * d / (b * c) AS ror, sqrt(1 / a + 1 / b + 1 / c + 1 / d) AS se_ror,
         (a / (a + b)) / (c / (c + d)) AS prr,
         sqrt(1 / a - 1 / (a + b) + 1 / c - 1 / (c + d)) AS se_prr,
         log2(a / ((a + b) * (a + c) / (a + b + c + d))) AS ic, sqrt(1 / a) AS se_ic
  FROM square WHERE a >= 3 AND b > 0 AND c > 0 AND d > 0),
bounds AS (
  SELECT *, exp(ln(ror) - 1.96 * se_ror) AS ror_lower_ci, exp(ln(ror) + 1.96 * se_ror) AS ror_upper_ci,
         exp(ln(prr) - 1.96 * se_prr) AS prr_lower_ci, exp(ln(prr) + 1.96 * se_prr) AS prr_upper_ci,
         ic - 1.96 * se_ic AS ic_025, ic + 1.96 * se_ic AS ic_975
  FROM estimate),
signals AS (
  SELECT drug, adr, cohort, a AS n_cases, ror, ror_lower_ci, ror_upper_ci, prr, prr_lower_ci,
         prr_upper_ci, ic, ic_025, ic_975,
         ror_lower_ci >= 2 AND prr >= 2 AND ic_025 >= 0 AS is_signal, avg_severity
  FROM bounds),
risk AS (SELECT drug, avg(ror) AS risk_score FROM signals GROUP BY drug)
"""


def r6(*names: str) -> str:
    """Select items rounded to six decimals; 'expr AS name' or a plain name."""
    items = []
    for name in names:
        expr, _, alias = name.partition(" AS ")
        items.append(f"round({expr}, 6) AS {alias or expr}")
    return ", ".join(items)


def with_ctes(select: str, *ctes: str) -> str:
    return f"WITH {','.join(c.strip() for c in (TABLES, *ctes))}\n{textwrap.dedent(select).strip()}"


SIGNALS = signal_ctes()
SIGNAL_ROWS = "SELECT drug, adr, cohort, n_cases, " + r6(
    "ror", "ror_lower_ci", "ror_upper_ci", "prr", "prr_lower_ci", "prr_upper_ci", "ic", "ic_025",
    "ic_975") + ", is_signal, " + r6("avg_severity") + " FROM signals"

# --- comparison -----------------------------------------------------------------

# The p-value is the normal tail integral by Simpson's rule, scaled by exp(-x*x) so that
# small values keep their precision.
COMPARE = """
total AS (SELECT count(*) FILTER (cohort = 'HBV_MONO') AS n1,
                 count(*) FILTER (cohort = 'HIV_HBV_COINFECTION') AS n2 FROM pairs),
freq AS (SELECT adr, count(*) FILTER (cohort = 'HBV_MONO') AS k1,
                count(*) FILTER (cohort = 'HIV_HBV_COINFECTION') AS k2
         FROM pairs WHERE cohort IN ('HBV_MONO', 'HIV_HBV_COINFECTION') GROUP BY adr),
expected AS (
  SELECT adr, k1, k2, n1, n2, k1 / n1 AS p1, k2 / n2 AS p2,
         n1 * (k1 + k2) / (n1 + n2) AS e11, n1 * (n1 + n2 - k1 - k2) / (n1 + n2) AS e12,
         n2 * (k1 + k2) / (n1 + n2) AS e21, n2 * (n1 + n2 - k1 - k2) / (n1 + n2) AS e22
  FROM freq, total WHERE n1 > 0 AND n2 > 0),
tested AS (
  SELECT *, CASE WHEN p2 > 0 THEN p1 / p2 END AS risk_ratio,
         CASE WHEN k1 >= 5 AND k2 >= 5 THEN
           pow(greatest(abs(k1 - e11) - 0.5, 0), 2) * (1 / e11 + 1 / e12 + 1 / e21 + 1 / e22) END AS chi2
  FROM expected),
node AS (SELECT i, i * 0.002 AS u, CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w
         FROM range(4001) t(i)),
tail AS (
  SELECT adr, 2 / sqrt(pi()) * exp(-chi2 / 2) * 0.002 / 3 * sum(w * exp(-2 * sqrt(chi2 / 2) * u - u * u)) AS p_value
  FROM tested, node WHERE chi2 IS NOT NULL GROUP BY adr, chi2),
comparison AS (
  SELECT adr, k1 AS hbv_mono_count, p1 AS hbv_mono_prop, k2 AS hiv_hbv_count, p2 AS hiv_hbv_prop,
         risk_ratio, chi2, p_value FROM tested LEFT JOIN tail USING (adr)),
point AS (
  SELECT adr, log2(risk_ratio) AS log2_rr, -log10(p_value) AS neg_log10_p, p_value,
         CASE WHEN p_value >= 0.05 THEN 'not_significant' WHEN risk_ratio > 2 THEN 'enriched_mono'
              WHEN risk_ratio < 0.5 THEN 'enriched_coinfection' ELSE 'significant_small' END AS volcano_class
  FROM comparison WHERE risk_ratio > 0 AND p_value > 0)
"""

# --- extraction -----------------------------------------------------------------

CASES = """
hit AS (
  SELECT DISTINCT primaryid, 'indi' AS source FROM indi WHERE upper(indi_pt) LIKE '%PROMO%'
  UNION ALL SELECT DISTINCT primaryid, 'reac' FROM reac WHERE upper(pt) LIKE '%PROMO%'
  UNION ALL SELECT DISTINCT primaryid, 'drug' FROM drug WHERE name LIKE '%ANVIL%'),
ids AS (SELECT DISTINCT primaryid FROM hit),
kept_demo AS (SELECT * FROM demo WHERE primaryid IN (SELECT primaryid FROM ids)),
latest AS (
  SELECT * FROM kept_demo
  QUALIFY row_number() OVER (PARTITION BY caseid ORDER BY CAST(caseversion AS DOUBLE) DESC NULLS LAST,
                             year_quarter, primaryid) = 1),
survivor AS (SELECT primaryid FROM latest)
"""

CLEAN = """
years AS (
  SELECT *, CAST(age AS DOUBLE) * CASE age_cod WHEN 'DEC' THEN 10 ELSE 1 END
            / CASE age_cod WHEN 'MON' THEN 12 WHEN 'WK' THEN 52 WHEN 'DY' THEN 365
              WHEN 'HR' THEN 8760 ELSE 1 END AS y FROM demo),
clean AS (
  SELECT primaryid, CAST(age AS DOUBLE) AS age, age_cod, CASE WHEN y BETWEEN 0 AND 120 THEN y END AS age_years,
         trim(upper(sex)) AS sex, event_dt, CAST(strptime(event_dt, '%Y%m%d') AS DATE) AS event_date,
         reporter_country, occp_cod FROM years)
"""


def counts_per_quarter(where: str, names: dict[str, str] | None = None) -> str:
    names = names or {t: t for t in ("demo", "drug", "reac", "indi", "outc", "rpsr")}
    return "\nUNION ALL ".join(
        f"SELECT '{label}' AS table_name, year_quarter, count(*) AS n_rows FROM {source} "
        f"{where if source != 'latest' else ''} GROUP BY ALL" for label, source in names.items())


# --- features -------------------------------------------------------------------

LABELS = ["economy", "large", "medium", "promo", "small"]
CLASSES = ["RING", "GEAR", "ROD", "BOLT", "PLATE", "GIZMO"]

_LABEL_FLAGS = ", ".join(
    "max(CASE WHEN upper(pt) IN ({}) THEN 1 ELSE 0 END) AS adr_{}".format(
        ", ".join(f"'BRAND#{i} {c.upper()}'" for i in range(1, 6)), c) for c in LABELS)

FEATURES = f"""
outcome AS (
  SELECT primaryid, max(CAST(outc_cod = 'DE' AS INTEGER)) AS outcome_death,
         max(CAST(outc_cod = 'LT' AS INTEGER)) AS outcome_life_threat,
         max(CAST(outc_cod = 'HO' AS INTEGER)) AS outcome_hospitalization,
         max(CAST(outc_cod = 'DS' AS INTEGER)) AS outcome_disability,
         max(CAST(outc_cod IN ('DE', 'LT') AS INTEGER)) AS severe_disease,
         max({GRADE}) AS severity_score FROM outc GROUP BY 1),
poly AS (SELECT primaryid, count(DISTINCT drugname) AS drug_count FROM drug GROUP BY 1),
label AS (SELECT primaryid, {_LABEL_FLAGS} FROM reac
          WHERE primaryid IN (SELECT primaryid FROM pairs) GROUP BY 1),
patient_drug AS (SELECT DISTINCT p.primaryid, p.drug_class, coalesce(risk_score, 1.0) AS drug_risk_score
                 FROM pairs p LEFT JOIN risk ON risk.drug = p.drug_class),
person AS (
  SELECT primaryid,
         CASE WHEN age_years IS NULL THEN 'Unknown' WHEN age_years < 18 THEN '<18' WHEN age_years < 41 THEN '18-40'
              WHEN age_years < 66 THEN '41-65' ELSE '>65' END AS age_category,
         age_years, coalesce(sex, 'Unknown') AS sex, CAST(coalesce(sex, '') = 'M' AS INTEGER) AS sex_binary,
         CAST(coalesce(sex, '') = 'F' AS INTEGER) AS sex_female,
         coalesce(reporter_country, 'Unknown') AS country,
         CASE WHEN reporter_country IN ('US', 'CA', 'MX') THEN 'North_America'
              WHEN reporter_country IN ('GB', 'DE', 'FR', 'IT', 'ES') THEN 'Europe'
              WHEN reporter_country IN ('JP', 'CN', 'KR', 'TW', 'IN') THEN 'Asia' ELSE 'Other' END AS region,
         coalesce(occp_cod, 'Unknown') AS reporter_type,
         CAST(coalesce(occp_cod, '') IN ('MD', 'HP') AS INTEGER) AS reporter_md,
         CAST(coalesce(occp_cod, '') = 'LW' AS INTEGER) AS reporter_lawyer,
         CAST(coalesce(occp_cod, '') = 'CN' AS INTEGER) AS reporter_consumer FROM clean),
case_part AS (
  SELECT primaryid, coalesce(outcome_death, 0) AS outcome_death, coalesce(outcome_life_threat, 0) AS outcome_life_threat,
         coalesce(outcome_hospitalization, 0) AS outcome_hospitalization,
         coalesce(outcome_disability, 0) AS outcome_disability, coalesce(severe_disease, 0) AS severe_disease,
         coalesce(severity_score, 0) AS severity_score, coalesce(drug_count, 0) AS drug_count,
         CASE WHEN drug_count IS NULL THEN '0' WHEN drug_count <= 2 THEN '1-2_drugs'
              WHEN drug_count <= 5 THEN '3-5_drugs' ELSE '6+_drugs' END AS polypharmacy_category,
         CASE WHEN drug_count <= 2 THEN 1 ELSE 0 END AS polypharmacy_low,
         CASE WHEN drug_count BETWEEN 3 AND 5 THEN 1 ELSE 0 END AS polypharmacy_medium,
         CASE WHEN drug_count > 5 THEN 1 ELSE 0 END AS polypharmacy_high,
         {", ".join(f"coalesce(adr_{c}, 0) AS adr_{c}" for c in LABELS)}
  FROM person LEFT JOIN outcome USING (primaryid) LEFT JOIN poly USING (primaryid)
              LEFT JOIN label USING (primaryid)),
wide AS (
  SELECT person.* REPLACE (coalesce(age_years, 0) AS age_years), case_part.* EXCLUDE (primaryid), cohort,
         CAST(cohort = 'HBV_MONO' AS INTEGER) AS cohort_hbv_mono,
         CAST(cohort = 'HIV_HBV_COINFECTION' AS INTEGER) AS cohort_hiv_hbv,
         CAST(cohort = 'HBV_AUTOIMMUNE' AS INTEGER) AS cohort_autoimmune,
         coalesce(drug_class, '0') AS drug_class,
         {", ".join(f"CAST(coalesce(drug_class, '') = '{c}' AS INTEGER) AS drug_{c.lower()}" for c in CLASSES)},
         coalesce(drug_risk_score, 0) AS drug_risk_score
  FROM person JOIN case_part USING (primaryid) LEFT JOIN assignment USING (primaryid)
       LEFT JOIN patient_drug USING (primaryid))
"""
FEATURE_CTES = (PAIRS, SIGNALS, CLEAN, FEATURES)

SIDES = f"""
side AS (
  SELECT primaryid, any_label, position <= round(total * 0.2) AS is_test, n_rows FROM (
    SELECT *, row_number() OVER (PARTITION BY any_label ORDER BY md5(primaryid || ':42')) AS position,
           count(*) OVER (PARTITION BY any_label) AS total FROM (
      SELECT primaryid, max({' + '.join(f'adr_{c}' for c in LABELS)}) > 0 AS any_label, count(*) AS n_rows
      FROM wide GROUP BY primaryid)))
"""

MODEL_INPUTS = [
    "age_years", "sex_binary", "sex_female", "reporter_md", "reporter_lawyer", "reporter_consumer",
    "outcome_death", "outcome_life_threat", "outcome_hospitalization", "outcome_disability",
    "severe_disease", "severity_score", "drug_count", "polypharmacy_low", "polypharmacy_medium",
    "polypharmacy_high", "cohort_hbv_mono", "cohort_hiv_hbv", "cohort_autoimmune",
    *[f"drug_{c.lower()}" for c in CLASSES], "drug_risk_score"]

# --- planted scores -------------------------------------------------------------

PLANTED = f"""
case_label AS (SELECT primaryid, {_LABEL_FLAGS} FROM reac GROUP BY 1),
planted AS ({" UNION ALL ".join(
    f"SELECT primaryid, 'adr_{c}' AS label, adr_{c} AS y, "
    f"((CAST(primaryid AS BIGINT) * 37 + {11 * i}) % 101 + 40 * adr_{c}) / 141.0::DOUBLE AS score FROM case_label"
    for i, c in enumerate(LABELS))}),
sided AS (SELECT *, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS prediction,
                 CAST(primaryid AS BIGINT) % 5 = 0 AS is_test FROM planted)
"""


def auc_sql(source: str, score: str, where: str) -> str:
    """Mean rank formula: midranks of the positives."""
    return f"""SELECT label, (sum(midrank) FILTER (y = 1) - n1 * (n1 + 1) / 2) / (n1 * n0) AS auc FROM (
      SELECT label, y, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) OVER l AS n1,
             sum(CASE WHEN y = 1 THEN 0 ELSE 1 END) OVER l AS n0,
             rank() OVER (PARTITION BY label ORDER BY {score})
               + (count(*) OVER (PARTITION BY label, {score}) - 1) / 2 AS midrank
      FROM {source} WHERE {where} WINDOW l AS (PARTITION BY label)) GROUP BY label, n1, n0"""


EVALUATION = f"""
confusion AS (
  SELECT label, count(*) FILTER (y = 1 AND prediction = 1) AS tp, count(*) FILTER (y = 0 AND prediction = 1) AS fp,
         count(*) FILTER (y = 1 AND prediction = 0) AS fn FROM sided WHERE is_test GROUP BY label),
performance AS (
  SELECT substring(label, 5) AS short, label, h.auc AS train_auc, p.auc AS train_auc_probability, t.auc AS test_auc,
         tp / (tp + fp) AS precision, tp / (tp + fn) AS recall, 2 * tp / (2 * tp + fp + fn) AS f1
  FROM confusion JOIN ({auc_sql('sided', 'prediction', 'NOT is_test')}) h USING (label)
       JOIN ({auc_sql('sided', 'score', 'NOT is_test')}) p USING (label)
       JOIN ({auc_sql('sided', 'score', 'is_test')}) t USING (label))
"""

_RISK = """
risk_row AS (
  SELECT primaryid AS profile_id, substring(label, 5) AS category, score * 100 AS risk_percent,
         CASE WHEN score * 100 > 50 THEN 'High' WHEN score * 100 > 30 THEN 'Medium' ELSE 'Low' END AS risk_level
  FROM planted)
"""

ORACLE_SQL = {
    "all_signals": with_ctes(SIGNAL_ROWS, PAIRS, SIGNALS),
    "signals_pooled": with_ctes(
        SIGNAL_ROWS, PAIRS, "pooled AS (SELECT * REPLACE ('ALL' AS cohort) FROM pairs)",
        signal_ctes("pooled")),
    "signals_autoimmune_first": with_ctes(
        SIGNAL_ROWS, PAIRS,
        """regrouped AS (SELECT * REPLACE (CASE WHEN primaryid IN (SELECT primaryid FROM autoimmune)
             THEN 'HBV_AUTOIMMUNE' ELSE cohort END AS cohort) FROM pairs)""",
        signal_ctes("regrouped")),
    "top_signals": with_ctes(
        "SELECT drug, adr, cohort, n_cases, "
        + r6("ror", "ror_lower_ci", "ror_upper_ci", "avg_severity", "ror - ror_lower_ci AS err_lower",
             "ror_upper_ci - ror AS err_upper")
        + """, left(drug, 15) AS drug_label, left(adr, 40) AS adr_label
        FROM signals WHERE is_signal ORDER BY ror DESC, drug, adr, cohort LIMIT 20""", PAIRS, SIGNALS),
    "top_signals_per_cohort": with_ctes(
        """SELECT cohort, CAST(rank AS INTEGER) AS rank, drug, adr, n_cases, round(ror, 6) AS ror FROM (
          SELECT *, row_number() OVER (PARTITION BY cohort ORDER BY ror DESC, drug, adr) AS rank
          FROM signals WHERE is_signal) WHERE rank <= 10""", PAIRS, SIGNALS),
    "signals_per_cohort": with_ctes(
        """SELECT cohort, count(*) AS n_combinations, count(*) FILTER (is_signal) AS n_signals
        FROM signals GROUP BY cohort""", PAIRS, SIGNALS),
    "drug_risk_scores": with_ctes(f"SELECT drug, {r6('risk_score')} FROM risk", PAIRS, SIGNALS),
    "risk_score_lines": with_ctes(
        "SELECT printf('''%s'': %.4f,', drug, risk_score) AS line FROM risk ORDER BY drug", PAIRS, SIGNALS),
    "cohort_assignments": with_ctes("SELECT primaryid, cohort FROM assignment", COHORTS),
    "cohort_sizes": with_ctes("SELECT cohort, count(*) AS n_cases FROM assignment GROUP BY 1", COHORTS),
    "exposure_counts": with_ctes(
        """SELECT drug_class AS drug_group, count(DISTINCT primaryid) AS n_cases FROM exposed GROUP BY 1
        UNION ALL SELECT 'ANY_ANTIVIRAL', count(*) FROM antiviral
        UNION ALL SELECT 'HIV', count(*) FROM hiv
        UNION ALL SELECT 'IMMUNOSUPPRESSANT', count(*) FROM immuno""", COHORTS),
    "drug_adr_pairs": with_ctes("SELECT primaryid, drug_class, adr, cohort, severity FROM pairs", PAIRS),
    "pairs_profile": with_ctes(
        """SELECT cohort, count(DISTINCT primaryid) AS n_cases, count(*) AS n_adr_records,
               count(DISTINCT adr) AS n_adrs FROM pairs GROUP BY cohort""", PAIRS),
    "top_adr_per_drug": with_ctes(
        """SELECT drug_class, CAST(rank AS INTEGER) AS rank, adr, left(adr, 30) AS adr_label, n_rows FROM (
          SELECT *, row_number() OVER (PARTITION BY drug_class ORDER BY n_rows DESC, adr) AS rank FROM (
            SELECT drug_class, adr, count(*) AS n_rows FROM pairs WHERE cohort = 'HBV_MONO' GROUP BY ALL))
        WHERE rank <= 10""", PAIRS),
    "case_severity": with_ctes("SELECT primaryid, severity FROM severity", PAIRS),
    "cohort_compare": with_ctes(
        "SELECT adr, hbv_mono_count, hiv_hbv_count, "
        + r6("hbv_mono_prop", "hiv_hbv_prop", "risk_ratio", "chi2", "p_value")
        + ", round(CASE WHEN p_value > 0 THEN log10(p_value) END, 6) AS log10_p FROM comparison",
        PAIRS, COMPARE),
    "rr_extremes": with_ctes(
        f"""(SELECT adr, {r6('risk_ratio', 'p_value')}, 'HBV_MONO' AS side FROM comparison
           WHERE risk_ratio IS NOT NULL ORDER BY comparison.risk_ratio DESC, adr LIMIT 10)
        UNION ALL
        (SELECT adr, {r6('risk_ratio', 'p_value')}, 'HIV_HBV_COINFECTION' FROM comparison
           WHERE risk_ratio IS NOT NULL ORDER BY comparison.risk_ratio, adr LIMIT 10)""", PAIRS, COMPARE),
    "rr_heatmap": with_ctes(
        "SELECT adr, " + r6("hbv_mono_prop * 100 AS hbv_mono_pct", "hiv_hbv_prop * 100 AS hiv_hbv_pct",
                            "diff AS abs_diff")
        + """ FROM (SELECT *, CASE WHEN risk_ratio = 0 THEN 'infinity'::DOUBLE ELSE abs(log2(risk_ratio)) END AS diff
          FROM comparison WHERE risk_ratio IS NOT NULL) ORDER BY diff DESC, adr LIMIT 30""", PAIRS, COMPARE),
    "volcano": with_ctes(
        f"SELECT adr, {r6('log2_rr', 'neg_log10_p', 'p_value')}, volcano_class FROM point", PAIRS, COMPARE),
    "volcano_labels": with_ctes(
        f"""SELECT volcano_class, CAST(rank AS INTEGER) AS rank, adr, left(adr, 20) AS adr_label,
               {r6('log2_rr', 'neg_log10_p')}
        FROM (SELECT *, row_number() OVER (PARTITION BY volcano_class ORDER BY neg_log10_p DESC, adr) AS rank
              FROM point WHERE volcano_class LIKE 'enriched%') WHERE rank <= 5""", PAIRS, COMPARE),
    "case_hits": with_ctes("SELECT source, count(*) AS n_cases FROM hit GROUP BY source", CASES),
    "case_ids": with_ctes("SELECT primaryid FROM ids", CASES),
    "case_drug_rows": with_ctes(
        r"""SELECT drugname, count(*) AS n_rows FROM drug
        WHERE regexp_matches(name, '\b(RING|GEAR|ROD|BOLT|PLATE|GIZMO)\b') GROUP BY 1"""),
    "extract_tables": with_ctes(
        counts_per_quarter("WHERE primaryid IN (SELECT primaryid FROM ids)"), CASES),
    "dedupe_latest": with_ctes(
        """SELECT primaryid, caseid, CAST(caseversion AS DOUBLE) AS caseversion, year_quarter FROM demo
        QUALIFY row_number() OVER (PARTITION BY caseid ORDER BY CAST(caseversion AS DOUBLE) DESC NULLS LAST,
                                   year_quarter, primaryid) = 1"""),
    "cascade": with_ctes(
        counts_per_quarter("WHERE primaryid IN (SELECT primaryid FROM survivor)",
                           {"demo": "latest", **{t: t for t in ("drug", "reac", "indi", "outc", "rpsr")}}),
        CASES),
    "demographics": with_ctes(
        f"SELECT primaryid, age, age_cod, {r6('age_years')}, sex, event_dt, event_date FROM clean", CLEAN),
    "report_files": with_ctes(counts_per_quarter("")),
    "features_case_drug": with_ctes(
        f"SELECT * REPLACE ({r6('age_years', 'drug_risk_score')}) FROM wide", *FEATURE_CTES),
    "features_case": with_ctes(
        f"""SELECT person.* REPLACE (round(coalesce(age_years, (SELECT median(age_years) FROM person)), 6) AS age_years),
          case_part.* EXCLUDE (primaryid),
          CAST(primaryid IN (SELECT primaryid FROM mono) AS INTEGER) AS cohort_hbv_mono,
          CAST(primaryid IN (SELECT primaryid FROM coinfection) AS INTEGER) AS cohort_hiv_hbv,
          CAST(primaryid IN (SELECT primaryid FROM autoimmune) AS INTEGER) AS cohort_autoimmune,
          {", ".join(f"coalesce(drug_{c.lower()}, 0) AS drug_{c.lower()}" for c in CLASSES)},
          round(coalesce(mean_risk, 0), 6) AS drug_risk_score
        FROM person JOIN case_part USING (primaryid) LEFT JOIN (
          SELECT primaryid, avg(drug_risk_score) AS mean_risk,
                 {", ".join(f"max(CAST(drug_class = '{c}' AS INTEGER)) AS drug_{c.lower()}" for c in CLASSES)}
          FROM patient_drug GROUP BY primaryid) USING (primaryid)""", *FEATURE_CTES),
    "label_prevalence": with_ctes(
        "\nUNION ALL ".join([
            f"SELECT 'adr_{c}' AS label, CAST(sum(adr_{c}) AS BIGINT) AS n_positive, "
            f"round(avg(adr_{c}), 6) AS prevalence FROM wide" for c in LABELS] + [
            "SELECT 'no_label', count(*) FILTER (n = 0), round(avg(CAST(n = 0 AS INTEGER)), 6) FROM "
            f"(SELECT {' + '.join(f'adr_{c}' for c in LABELS)} AS n FROM wide)"]), *FEATURE_CTES),
    "feature_distributions": with_ctes(
        """SELECT 'age_category' AS feature, age_category AS value, count(*) AS n_rows FROM person GROUP BY ALL
        UNION ALL SELECT 'sex', sex, count(*) FROM person GROUP BY ALL
        UNION ALL SELECT 'region', region, count(*) FROM person GROUP BY ALL
        UNION ALL SELECT 'polypharmacy_category', CASE WHEN drug_count <= 2 THEN '1-2_drugs'
          WHEN drug_count <= 5 THEN '3-5_drugs' ELSE '6+_drugs' END, count(*) FROM poly GROUP BY ALL
        UNION ALL SELECT 'cohort', cohort, count(*) FROM assignment GROUP BY ALL
        UNION ALL SELECT 'drug_class', drug_class, count(*) FROM patient_drug GROUP BY ALL""",
        *FEATURE_CTES),
    "split_prevalence": with_ctes(
        "\nUNION ALL ".join(
            f"SELECT is_test, 'adr_{c}' AS label, CAST(sum(adr_{c}) AS BIGINT) AS n_positive, "
            f"round(avg(adr_{c}), 6) AS prevalence FROM wide JOIN side USING (primaryid) GROUP BY is_test"
            for c in LABELS),
        *FEATURE_CTES, SIDES),
    "polypharmacy_profile": with_ctes(
        """SELECT count(*) AS n_cases, round(avg(n), 6) AS mean_drugs, median(n) AS median_drugs,
          count(*) FILTER (n <= 2) AS n_low, count(*) FILTER (n BETWEEN 3 AND 5) AS n_medium,
          count(*) FILTER (n > 5) AS n_high
        FROM (SELECT primaryid, count(DISTINCT drugname) AS n FROM drug GROUP BY 1)"""),
    "severity_rates": with_ctes(
        """SELECT count(DISTINCT primaryid) AS n_cases,
          round(count(DISTINCT primaryid) FILTER (outc_cod IN ('DE', 'LT')) / count(DISTINCT primaryid), 6) AS severe_rate,
          round(count(DISTINCT primaryid) FILTER (outc_cod = 'DE') / count(DISTINCT primaryid), 6) AS death_rate,
          round(count(DISTINCT primaryid) FILTER (outc_cod = 'HO') / count(DISTINCT primaryid), 6)
            AS hospitalization_rate FROM outc"""),
    "scaling": with_ctes(
        "\nUNION ALL ".join(
            f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std FROM wide"
            for c in MODEL_INPUTS), *FEATURE_CTES),
    "split": with_ctes(
        "SELECT primaryid, any_label, is_test, n_rows FROM side", *FEATURE_CTES, SIDES),
    "roc_points": with_ctes(
        """SELECT DISTINCT label, round(score, 6) AS threshold, round(tp / n1, 6) AS tpr, round(fp / n0, 6) AS fpr FROM (
          SELECT label, score, sum(y) OVER upto AS tp, sum(1 - y) OVER upto AS fp,
                 sum(y) OVER every AS n1, sum(1 - y) OVER every AS n0 FROM planted
          WINDOW upto AS (PARTITION BY label ORDER BY score DESC), every AS (PARTITION BY label))
        WHERE n1 > 0 AND n0 > 0
        UNION ALL SELECT label, NULL, 0.0::DOUBLE, 0.0::DOUBLE FROM planted GROUP BY label
        HAVING min(y) = 0 AND max(y) = 1""", PLANTED),
    "roc_corners": with_ctes(
        """SELECT label, round(score, 6) AS threshold, round(tp / n1, 6) AS tpr, round(fp / n0, 6) AS fpr FROM (
          SELECT *, sum(p) OVER upto AS tp, sum(n) OVER upto AS fp, sum(p) OVER every AS n1, sum(n) OVER every AS n0,
                 lead(p) OVER upto AS p_next, lead(n) OVER upto AS n_next, row_number() OVER upto AS place
          FROM (SELECT label, score, sum(y) AS p, sum(1 - y) AS n FROM planted GROUP BY label, score)
          WINDOW upto AS (PARTITION BY label ORDER BY score DESC), every AS (PARTITION BY label))
        WHERE n1 > 0 AND n0 > 0 AND (place = 1 OR p_next IS NULL OR p_next <> p OR n_next <> n)
        UNION ALL SELECT label, NULL, 0.0::DOUBLE, 0.0::DOUBLE FROM planted GROUP BY label
        HAVING min(y) = 0 AND max(y) = 1""", PLANTED),
    "auc": with_ctes(f"SELECT label, round(auc, 6) AS auc FROM ({auc_sql('planted', 'score', 'true')})", PLANTED),
    "classification_metrics": with_ctes(
        """SELECT label, tp, fp, fn, tn, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
          round(2 * tp / (2 * tp + fp + fn), 6) AS f1
        FROM (SELECT label, count(*) FILTER (y = 1 AND prediction = 1) AS tp,
          count(*) FILTER (y = 0 AND prediction = 1) AS fp, count(*) FILTER (y = 1 AND prediction = 0) AS fn,
          count(*) FILTER (y = 0 AND prediction = 0) AS tn FROM sided GROUP BY label)""", PLANTED),
    "evaluation": with_ctes(
        "SELECT label AS category, " + r6("train_auc", "train_auc_probability", "test_auc", "precision", "recall",
                                          "f1") + " FROM performance", PLANTED, EVALUATION),
    "performance_verdict": with_ctes(
        "SELECT " + r6("avg(test_auc) AS mean_test_auc", "avg(precision) AS mean_precision",
                       "avg(recall) AS mean_recall", "avg(f1) AS mean_f1")
        + """, CASE WHEN avg(test_auc) >= 0.75 THEN 'EXCELLENT' WHEN avg(test_auc) >= 0.7 THEN 'GOOD'
          WHEN avg(test_auc) >= 0.65 THEN 'FAIR' ELSE 'WEAK' END AS verdict FROM performance""",
        PLANTED, EVALUATION),
    "risk_bands": with_ctes(
        """SELECT profile_id, category, round(risk_percent, 6) AS risk_percent, risk_level,
          CASE WHEN risk_level = 'High' THEN CASE category
            WHEN 'economy' THEN 'Review economy events monthly.'
            WHEN 'large' THEN 'Review large events every 3 months.'
            WHEN 'medium' THEN 'Review medium events annually.'
            WHEN 'promo' THEN 'Review promo events every 2 months.'
            WHEN 'small' THEN 'Review small events as reported.' END END AS advice FROM risk_row""", PLANTED, _RISK),
    "risk_summary": with_ctes(
        """SELECT profile_id, high_risks, medium_risks,
          CASE WHEN high_risks <> '' THEN 'Action Required' WHEN medium_risks <> '' THEN 'Moderate Risk'
               ELSE 'Low Risk Profile' END AS action FROM (
          SELECT profile_id,
            coalesce(string_agg(upper(left(category, 1)) || substring(category, 2), ', ' ORDER BY category)
              FILTER (risk_level = 'High'), '') AS high_risks,
            coalesce(string_agg(upper(left(category, 1)) || substring(category, 2), ', ' ORDER BY category)
              FILTER (risk_level = 'Medium'), '') AS medium_risks
          FROM risk_row GROUP BY profile_id)""", PLANTED, _RISK),
    "profile_features": f"""WITH profile AS (
        SELECT CAST(o_orderkey AS VARCHAR) AS profile_id, o_orderkey % 73 + 18 AS age, o_custkey % 2 AS sex,
               (o_custkey // 2) % 4 AS cohort, CAST(floor(o_totalprice) AS BIGINT) AS price, o_orderkey % 6 AS drug
        FROM orders)
        SELECT profile_id, CAST(age AS DOUBLE) AS age_years, CAST(sex = 0 AS INTEGER) AS sex_binary,
          CAST(sex = 1 AS INTEGER) AS sex_female, CAST(price % 3 = 0 AS INTEGER) AS reporter_md,
          CAST(price % 3 = 2 AS INTEGER) AS reporter_lawyer, CAST(price % 3 = 1 AS INTEGER) AS reporter_consumer,
          0 AS outcome_death, 0 AS outcome_life_threat, 0 AS outcome_hospitalization, 0 AS outcome_disability,
          0 AS severe_disease, 1 AS severity_score,
          CAST([1.5, 4.0, 7.0][(price // 3) % 3 + 1] AS DOUBLE) AS drug_count,
          CAST((price // 3) % 3 = 0 AS INTEGER) AS polypharmacy_low,
          CAST((price // 3) % 3 = 1 AS INTEGER) AS polypharmacy_medium,
          CAST((price // 3) % 3 = 2 AS INTEGER) AS polypharmacy_high,
          CAST(cohort = 0 AS INTEGER) AS cohort_hbv_mono, CAST(cohort = 1 AS INTEGER) AS cohort_hiv_hbv,
          CAST(cohort = 2 AS INTEGER) AS cohort_autoimmune,
          {", ".join(f"CAST(drug = {i} AS INTEGER) AS drug_{c.lower()}" for i, c in enumerate(CLASSES))},
          CAST([24.5285, 8.5138, 11.2757, 6.2125, 284.8836, 4.022][drug + 1] AS DOUBLE) AS drug_risk_score
        FROM profile""",
}

_SEVERITY = (
    """SELECT cohort, count(DISTINCT primaryid) AS n_cases, count(*) AS n_adr_records,
      round(avg(severity), 6) AS mean_severity, median(severity) AS median_severity,
      """ + ", ".join(f"count(*) FILTER (severity = {g}) AS severity_{g}_count" for g in range(1, 6))
    + " FROM pairs {} GROUP BY cohort")
ORACLE_SQL["severity_profile"] = with_ctes(_SEVERITY.format(""), PAIRS)
ORACLE_SQL["severity_main"] = with_ctes(
    _SEVERITY.format("WHERE cohort IN ('HBV_MONO', 'HIV_HBV_COINFECTION')"), PAIRS)

_SURVIVING = """
demo_out AS (SELECT * FROM clean WHERE primaryid IN (SELECT primaryid FROM survivor)),
drug_out AS (SELECT * FROM drug WHERE primaryid IN (SELECT primaryid FROM survivor)),
reac_out AS (SELECT * FROM reac WHERE primaryid IN (SELECT primaryid FROM survivor)),
indi_out AS (SELECT * FROM indi WHERE primaryid IN (SELECT primaryid FROM survivor)),
outc_out AS (SELECT * FROM outc WHERE primaryid IN (SELECT primaryid FROM survivor)),
rpsr_out AS (SELECT * FROM rpsr WHERE primaryid IN (SELECT primaryid FROM survivor))
"""
_METRICS = [
    ("cases", "count(*)", "demo"), ("age_min", "min(age_years)", "demo"), ("age_max", "max(age_years)", "demo"),
    ("age_mean", "avg(age_years)", "demo"), ("valid_ages", "count(age_years)", "demo"),
    ("valid_dates", "count(event_date)", "demo"), ("drug_records", "count(*)", "drug"),
    ("distinct_drugs", "count(DISTINCT drugname)", "drug"), ("reac_records", "count(*)", "reac"),
    ("distinct_reactions", "count(DISTINCT pt)", "reac"), ("indi_records", "count(*)", "indi"),
    ("outc_records", "count(*)", "outc"), ("rpsr_records", "count(*)", "rpsr")]
ORACLE_SQL["extraction_profile"] = with_ctes(
    "\nUNION ALL ".join(f"SELECT '{m}' AS metric, round(CAST({e} AS DOUBLE), 6) AS value FROM {t}_out"
                        for m, e, t in _METRICS), CASES, CLEAN, _SURVIVING)


def _frequency(label: str, column: str, source: str, limit: str = "") -> str:
    percent = f"round(count(*) * 100.0 / (SELECT count(*) FROM {source}), 6)" if label == "sex" else "NULL"
    return (f"(SELECT '{label}' AS table_name, {column} AS value, count(*) AS n_rows, "
            f"CAST({percent} AS DOUBLE) AS percent FROM {source} WHERE {column} IS NOT NULL GROUP BY ALL ORDER BY n_rows DESC, value {limit})")


ORACLE_SQL["frequency_tables"] = with_ctes(
    "\nUNION ALL ".join([
        _frequency("sex", "sex", "demo_out"), _frequency("country", "reporter_country", "demo_out", "LIMIT 10"),
        _frequency("drug", "drugname", "drug_out", "LIMIT 20"), _frequency("reaction", "pt", "reac_out", "LIMIT 20"),
        """(SELECT 'outcome' AS table_name, CASE outc_cod WHEN 'DE' THEN 'Death' WHEN 'LT' THEN 'Life-Threatening'
          WHEN 'HO' THEN 'Hospitalization' WHEN 'DS' THEN 'Disability' WHEN 'CA' THEN 'Congenital Anomaly'
          WHEN 'RI' THEN 'Required Intervention' ELSE 'Other' END || ' (' || outc_cod || ')' AS value,
          count(*) AS n_rows, CAST(NULL AS DOUBLE) AS percent FROM outc_out GROUP BY ALL)"""]), CASES, CLEAN, _SURVIVING)

ORACLE_SQL["dedupe_counts"] = with_ctes(
    """SELECT n_before, n_after, n_before - n_after AS n_removed FROM (
      SELECT (SELECT count(DISTINCT primaryid) FROM demo) AS n_before, count(DISTINCT primaryid) AS n_after FROM (
        SELECT primaryid FROM demo QUALIFY row_number() OVER (
          PARTITION BY caseid ORDER BY CAST(caseversion AS DOUBLE) DESC NULLS LAST, year_quarter, primaryid) = 1))""")

_CASEID = "CAST(CAST(primaryid AS BIGINT) // 2 AS VARCHAR)"
_EARLY = "right(year_quarter, 1) IN ('1', '2')"
ORACLE_SQL["report_lines"] = with_ctes(
    f"""SELECT 'reac' AS table_name, primaryid, {_CASEID} AS caseid,
      CASE CAST(primaryid AS BIGINT) % 10 WHEN 0 THEN pt WHEN 1 THEN 'a "' || pt || '" c' WHEN 2 THEN 'one' || chr(10) || pt
        WHEN 3 THEN pt || chr(92) WHEN 7 THEN pt || '$d' WHEN 9 THEN pt END AS text,
      CASE CAST(primaryid AS BIGINT) % 10 WHEN 0 THEN 'x' WHEN 1 THEN 'x' WHEN 2 THEN 'y' WHEN 3 THEN 'w' WHEN 7 THEN 'z'
        WHEN 9 THEN 'x' END AS more, year_quarter
    FROM reac WHERE CAST(primaryid AS BIGINT) % 10 NOT IN (5, 8)
      AND (CAST(primaryid AS BIGINT) % 10 NOT IN (2, 9) OR {_EARLY})
    UNION ALL SELECT 'drug', primaryid, {_CASEID}, drugname, NULL, year_quarter FROM drug""")

ORACLE_SQL["reloaded_table"] = """
SELECT CAST(c_custkey AS VARCHAR) AS id, CASE c_custkey % 7 WHEN 0 THEN ' ' || c_name || '  ' WHEN 1 THEN c_name || chr(9)
  WHEN 2 THEN 'a "' || c_name || '"' WHEN 3 THEN c_name || chr(10) || 'next' WHEN 4 THEN c_name || chr(92)
  WHEN 5 THEN '' END AS sex FROM customer"""

_MODELLED = "HAVING count(DISTINCT CASE WHEN NOT is_test THEN adr_{c} END) = 2"
ORACLE_SQL["train_eval"] = with_ctes("\nUNION ALL ".join(
    f"""SELECT 'adr_{c}' AS label, count(*) FILTER (is_test) AS n_test,
      CAST(sum(adr_{c}) FILTER (is_test) AS BIGINT) AS n_positive, true AS probabilities_valid,
      true AS classes_follow_scores, true AS auc_above_floor, true AS reloaded_agrees
    FROM wide JOIN side USING (primaryid) {_MODELLED.format(c=c)}""" for c in LABELS), *FEATURE_CTES, SIDES)
ORACLE_SQL["feature_importance"] = with_ctes("\nUNION ALL ".join(
    f"""SELECT 'adr_{c}' AS label, 10::BIGINT AS n_top, '1,2,3,4,5,6,7,8,9,10' AS ranks, true AS not_negative,
      {len(MODEL_INPUTS)}::BIGINT AS n_features, true AS sums_to_one, true AS names_known
    FROM wide JOIN side USING (primaryid) {_MODELLED.format(c=c)}""" for c in LABELS), *FEATURE_CTES, SIDES)
ORACLE_SQL["score_profiles"] = with_ctes("\nUNION ALL ".join(
    f"""SELECT '{c}' AS category, (SELECT count(*) FROM orders) AS n_profiles,
      (SELECT count(DISTINCT o_orderkey) FROM orders) AS n_distinct, true AS percent_valid, true AS bands_fit, true AS advice_fits
    FROM wide JOIN side USING (primaryid) {_MODELLED.format(c=c)}""" for c in LABELS), *FEATURE_CTES, SIDES)


def _rare(sql: str) -> str:
    """The same SQL for the study of rare classes."""
    often = ", ".join(f"('{c}')" for c in CLASSES)
    hiv = " OR ".join(f"contains(name, '{n}')" for n in ("RING", "GEAR", "ROD", "BOLT", "PLATE", "WIDGET", "ANVIL"))
    return (sql.replace(often, "('HOT GIZMO'), ('OLD GIZMO'), ('NEW GIZMO')")
            .replace("contains(name, 'WIDGET')", f"({hiv})"))


ORACLE_SQL["rare_signals"] = _rare(ORACLE_SQL["all_signals"])
ORACLE_SQL["rare_compare"] = _rare(ORACLE_SQL["cohort_compare"]).replace(
    ", round(CASE WHEN p_value > 0 THEN log10(p_value) END, 6) AS log10_p", "")
ORACLE_SQL["rare_heatmap"] = _rare(ORACLE_SQL["rr_heatmap"])
