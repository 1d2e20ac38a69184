"""Column layouts of the report tables (raw, all strings)."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns kept from each report table, in output order.
REPORT_COLUMNS = {
    "demo": ["primaryid", "caseid", "caseversion", "i_f_code", "event_dt", "age", "age_cod",
             "sex", "wt", "wt_cod", "occp_cod", "reporter_country"],
    "drug": ["primaryid", "caseid", "drug_seq", "role_cod", "drugname", "prod_ai", "val_vbm",
             "route", "dose_vbm", "dechal", "rechal"],
    "reac": ["primaryid", "caseid", "pt", "drug_rec_act"],
    "indi": ["primaryid", "caseid", "indi_drug_seq", "indi_pt"],
    "outc": ["primaryid", "caseid", "outc_cod"],
    "rpsr": ["primaryid", "caseid", "rpsr_cod"],
}

REPORT_TABLES = tuple(REPORT_COLUMNS)


def string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def report_schema(table: str) -> T.StructType:
    """Schema of a report table after reading: its columns plus the quarter label."""
    return string_schema([*REPORT_COLUMNS[table], "year_quarter"])


DERIVED_SCHEMAS = {
    "cohort_assignments": "primaryid string, cohort string",
    "drug_adr_pairs": "primaryid string, drug_class string, adr string, cohort string, severity int",
    "all_signals": "drug string, adr string, cohort string, n_cases long, ror double, "
                   "ror_lower_ci double, ror_upper_ci double, prr double, prr_lower_ci double, "
                   "prr_upper_ci double, ic double, ic_025 double, ic_975 double, "
                   "is_signal boolean, avg_severity double",
    "cohort_comparison": "adr string, hbv_mono_count long, hbv_mono_prop double, "
                         "hiv_hbv_count long, hiv_hbv_prop double, risk_ratio double, "
                         "chi2 double, p_value double",
    "severity_by_cohort": "cohort string, n_cases long, n_adr_records long, "
                          "mean_severity double, median_severity double, severity_1_count long, "
                          "severity_2_count long, severity_3_count long, severity_4_count long, "
                          "severity_5_count long",
    "drug_risk_scores": "drug string, risk_score double",
}
