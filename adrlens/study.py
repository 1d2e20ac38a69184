"""Study definitions: the dictionaries and thresholds every operator is parameterised by.

A ``Study`` is plain, small, driver-side configuration.  Operators turn it into
literal column expressions, so no dictionary is ever joined or shipped as a table.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# Cohort labels, in the order in which a case is looked up (first match wins).
MONO = "HBV_MONO"
COINFECTION = "HIV_HBV_COINFECTION"
AUTOIMMUNE = "HBV_AUTOIMMUNE"
OTHER = "HBV_OTHER"
UNKNOWN_COHORT = "UNKNOWN"
COHORT_ORDER = (MONO, COINFECTION, AUTOIMMUNE, OTHER)
MAIN_COHORTS = (MONO, COINFECTION)
SIGNAL_COHORTS = (MONO, COINFECTION, AUTOIMMUNE)


@dataclass(frozen=True)
class SignalThresholds:
    ror_lower_ci: float = 2.0
    prr: float = 2.0
    ic_lower_ci: float = 0.0
    min_cases: int = 3


MOST_CLASSES = 61


@dataclass(frozen=True)
class Study:
    """Dictionaries of one study; every name is matched upper-cased."""

    case_terms: tuple[str, ...]
    case_drugs: tuple[str, ...]
    drug_classes: dict[str, tuple[str, ...]]
    hiv_drugs: tuple[str, ...]
    immunosuppressants: tuple[str, ...]
    adr_categories: dict[str, tuple[str, ...]]
    severity_grades: dict[str, int]
    outcome_names: dict[str, str]
    regions: dict[str, tuple[str, ...]]
    profile_risk_scores: dict[str, float] = field(default_factory=dict)
    monitoring_advice: dict[str, str] = field(default_factory=dict)
    thresholds: SignalThresholds = SignalThresholds()
    match: str = "substring"  # or "word"

    def __post_init__(self):
        if len(self.drug_classes) > MOST_CLASSES:
            raise ValueError(f"a study can have {MOST_CLASSES} drug classes, this one has {len(self.drug_classes)}: "
                             "the classes and two further drug groups of a case are bits of one long integer")

    @property
    def labels(self) -> list[str]:
        return [f"adr_{c}" for c in self.adr_categories]

    @property
    def drug_flags(self) -> list[str]:
        return [f"drug_{c.lower()}" for c in self.drug_classes]

    @property
    def feature_columns(self) -> list[str]:
        """The 26 model inputs (with six drug classes), in training order."""
        return [
            "age_years", "sex_binary", "sex_female",
            "reporter_md", "reporter_lawyer", "reporter_consumer",
            "outcome_death", "outcome_life_threat", "outcome_hospitalization",
            "outcome_disability", "severe_disease", "severity_score",
            "drug_count", "polypharmacy_low", "polypharmacy_medium", "polypharmacy_high",
            "cohort_hbv_mono", "cohort_hiv_hbv", "cohort_autoimmune",
            *self.drug_flags, "drug_risk_score",
        ]


# --- Fixed values: result parity depends on every entry below -------------------

SEVERITY_GRADES = {"DE": 5, "LT": 4, "HO": 3, "DS": 3, "CA": 2, "RI": 2, "OT": 1}

OUTCOME_NAMES = {
    "DE": "Death",
    "LT": "Life-Threatening",
    "HO": "Hospitalization",
    "DS": "Disability",
    "CA": "Congenital Anomaly",
    "RI": "Required Intervention",
    "OT": "Other",
}

REGIONS = {
    "North_America": ("US", "CA", "MX"),
    "Europe": ("GB", "DE", "FR", "IT", "ES"),
    "Asia": ("JP", "CN", "KR", "TW", "IN"),
}

HBV_STUDY = Study(
    case_terms=(
        "HEPATITIS B", "CHRONIC HEPATITIS B", "HEPATITIS B ACUTE", "HEPATITIS B CARRIER",
        "HEPATITIS B REACTIVATION", "HEPATITIS B ANTIGEN POSITIVE",
        "HEPATITIS B SURFACE ANTIGEN POSITIVE", "HEPATITIS B E ANTIGEN POSITIVE",
        "HEPATITIS B ANTIBODY POSITIVE", "HEPATITIS B VIRUS INFECTION",
        "HEPATOCELLULAR CARCINOMA", "HEPATIC CIRRHOSIS", "LIVER DISORDER",
        "HEPATIC FAILURE", "HEPATIC ENCEPHALOPATHY",
    ),
    case_drugs=(
        "ENTECAVIR", "TENOFOVIR", "LAMIVUDINE", "ADEFOVIR", "TELBIVUDINE", "EMTRICITABINE",
        "BARACLUDE", "VIREAD", "EPIVIR", "HEPSERA", "TYZEKA", "EMTRIVA", "VEMLIDY",
        "TENOFOVIR DISOPROXIL", "TENOFOVIR ALAFENAMIDE", "PEGINTERFERON ALFA",
        "INTERFERON ALFA",
    ),
    drug_classes={
        "ENTECAVIR": ("ENTECAVIR", "BARACLUDE"),
        "TENOFOVIR": ("TENOFOVIR", "VIREAD", "VEMLIDY", "TENOFOVIR DISOPROXIL",
                      "TENOFOVIR ALAFENAMIDE", "TDF", "TAF"),
        "LAMIVUDINE": ("LAMIVUDINE", "EPIVIR", "3TC"),
        "ADEFOVIR": ("ADEFOVIR", "HEPSERA"),
        "TELBIVUDINE": ("TELBIVUDINE", "TYZEKA"),
        "INTERFERON": ("PEGINTERFERON ALFA", "INTERFERON ALFA", "PEGASYS"),
    },
    hiv_drugs=(
        "TRUVADA", "ATRIPLA", "BIKTARVY", "STRIBILD", "DESCOVY", "GENVOYA", "COMPLERA",
        "ODEFSEY", "TRIUMEQ", "DOVATO", "TIVICAY", "ISENTRESS", "PREZISTA", "NORVIR",
        "KALETRA", "EVOTAZ", "PREZCOBIX", "EFAVIRENZ", "NEVIRAPINE", "RILPIVIRINE",
        "ETRAVIRINE", "RALTEGRAVIR", "DOLUTEGRAVIR", "ELVITEGRAVIR", "BICTEGRAVIR",
        "DARUNAVIR", "ATAZANAVIR", "LOPINAVIR", "RITONAVIR", "EMTRICITABINE", "ABACAVIR",
        "ZIDOVUDINE", "DIDANOSINE",
    ),
    immunosuppressants=(
        "METHOTREXATE", "SULFASALAZINE", "RITUXIMAB", "ACTEMRA", "ORENCIA", "HUMIRA",
        "ENBREL", "REMICADE", "PREDNISONE", "AZATHIOPRINE", "CYCLOSPORINE", "TACROLIMUS",
        "MYCOPHENOLATE",
    ),
    adr_categories={
        "hepatotoxicity": (
            "Hepatic failure", "Hepatotoxicity", "Liver disorder", "Hepatic cirrhosis",
            "Hepatitis", "Hepatic necrosis", "Hepatomegaly", "Jaundice",
            "Liver function test abnormal", "Hepatocellular carcinoma", "Hepatic fibrosis",
        ),
        "nephrotoxicity": (
            "Renal failure", "Renal impairment", "Chronic kidney disease", "Renal injury",
            "Acute kidney injury", "Nephropathy", "Renal tubular disorder",
            "Fanconi syndrome acquired", "Blood creatinine increased", "Proteinuria",
        ),
        "bone_tooth": (
            "Bone density decreased", "Osteoporosis", "Osteopenia", "Tooth loss",
            "Osteonecrosis", "Bone loss", "Skeletal injury", "Osteomalacia", "Bone fracture",
            "Dental caries", "Periodontal disease", "Tooth disorder",
        ),
        "hematologic": (
            "Neutropenia", "Anaemia", "Thrombocytopenia", "Leukopenia", "Pancytopenia",
            "White blood cell count decreased", "Platelet count decreased",
            "Haemoglobin decreased", "Bone marrow failure", "Lymphopenia",
        ),
        "neurologic": (
            "Neuropathy peripheral", "Headache", "Dizziness", "Seizure", "Encephalopathy",
            "Tremor", "Paraesthesia", "Cognitive disorder", "Confusion", "Somnolence",
            "Insomnia", "Peripheral sensory neuropathy",
        ),
    },
    severity_grades=SEVERITY_GRADES,
    outcome_names=OUTCOME_NAMES,
    regions=REGIONS,
    profile_risk_scores={
        "ADEFOVIR": 24.5285, "ENTECAVIR": 8.5138, "INTERFERON": 11.2757,
        "LAMIVUDINE": 6.2125, "TELBIVUDINE": 284.8836, "TENOFOVIR": 4.0220,
    },
    monitoring_advice={
        "hepatotoxicity": "Monitor liver enzymes (ALT, AST) monthly. "
                          "Watch for signs of hepatic decompensation.",
        "nephrotoxicity": "Monitor kidney function (eGFR, creatinine) every 3 months. "
                          "Consider dose adjustment if eGFR < 50 mL/min.",
        "bone_tooth": "DEXA scan annually. Recommend Calcium/Vitamin D supplementation. "
                      "Dental exam every 6 months.",
        "hematologic": "Complete blood count (CBC) every 2 months. Monitor for cytopenias.",
        "neurologic": "Assess for peripheral neuropathy symptoms. "
                      "Consider neurological consultation.",
    },
)

# --- Study over the star-schema test tables -------------------------------------

_PROXY_BRANDS = tuple(f"Brand#{i}" for i in range(1, 6))

STAR_STUDY = Study(
    case_terms=("PROMO",),
    case_drugs=("ANVIL",),
    drug_classes={c: (c,) for c in ("RING", "GEAR", "ROD", "BOLT", "PLATE", "GIZMO")},
    hiv_drugs=("WIDGET",),
    immunosuppressants=("ANVIL",),
    adr_categories={
        t: tuple(f"{b} {t}" for b in _PROXY_BRANDS)
        for t in ("economy", "large", "medium", "promo", "small")
    },
    severity_grades=SEVERITY_GRADES,
    outcome_names=OUTCOME_NAMES,
    regions=REGIONS,
    profile_risk_scores={"RING": 24.5285, "GEAR": 8.5138, "ROD": 11.2757,
                         "BOLT": 6.2125, "PLATE": 284.8836, "GIZMO": 4.022},
    monitoring_advice={
        "economy": "Review economy events monthly.",
        "large": "Review large events every 3 months.",
        "medium": "Review medium events annually.",
        "promo": "Review promo events every 2 months.",
        "small": "Review small events as reported.",
    },
)

#: Rare classes and a common second drug group: cells too small to count, no or few cases alone.
RARE_STUDY = replace(
    STAR_STUDY, drug_classes={c: (c,) for c in ("HOT GIZMO", "OLD GIZMO", "NEW GIZMO")},
    hiv_drugs=("RING", "GEAR", "ROD", "BOLT", "PLATE", "WIDGET", "ANVIL"))
