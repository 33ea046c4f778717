"""Column names, code tables and settings."""

from __future__ import annotations

from dataclasses import dataclass

#: Columns of ingested rows, in their order.
INGEST_COLUMNS = ("case_id", "drug", "event", "age_years", "age_group", "sex", "weight_kg", "reporter_country", "occr_country", "mfr_sndr", "occp_cod", "mfr_num", "fda_dt", "event_dt", "role_code", "report_sources", "outcomes", "therapy_summary")
INGEST_SCHEMA = "case_id long, drug string, event string, age_years double, age_group string, sex string, weight_kg double, reporter_country string, occr_country string, mfr_sndr string, occp_cod string, mfr_num string, fda_dt string, event_dt string, role_code string, report_sources string, outcomes string, therapy_summary string"
#: Columns of signal results, in their order.
SIGNAL_COLUMNS = ("drug", "event", "n", "prr", "prr_lower_ci", "prr_upper_ci", "prr_signal", "ror", "ror_lower_ci", "ror_signal", "ic", "ic025", "ic_signal", "ebgm", "eb05", "ebgm_signal")
REPORT_SCHEMA = "safety_report_id string, case_version int, receipt_date string, patient_age int, patient_sex string, patient_weight double, occur_country string, primary_drug string, primary_reaction string, event_date string, report_type int, serious boolean, mfr_num string"
NDC_SCHEMA = "product_ndc string, brand_name string, generic_name string, labeler_name string, product_type string, route array<string>, dosage_form string, active_ingredients array<string>, marketing_category string, application_number string, start_date string, listing_expiration string"
SUSPECT_ROLES = ("PS", "SS")

# Weights of reaction outcomes, seriousness criteria and reporter qualifications.
OUTCOME_WEIGHTS = {"1": 0.0, "2": 1.0, "3": 3.0, "4": 2.0, "5": 5.0, "6": 0.5}
OUTCOME_LABELS = {"1": "Recovered", "2": "Recovering", "3": "Not recovered", "4": "Recovered with sequelae", "5": "Fatal", "6": "Unknown"}
SERIOUSNESS_WEIGHTS = {"death": 5.0, "congenital": 4.5, "life_threatening": 4.0, "disabling": 3.0, "hospitalization": 2.0, "other": 1.0}
REPORTER_WEIGHTS = {"1": 1.0, "2": 0.9, "3": 0.8, "4": 0.5, "5": 0.6}
REPORTER_LABELS = {"1": "Physician", "2": "Pharmacist", "3": "Other health professional", "4": "Lawyer", "5": "Consumer"}
DRUG_ROLES = {"PS": "Primary suspect", "SS": "Secondary suspect", "C": "Concomitant", "I": "Interacting"}
CHARACTERIZATIONS = {"1": "Suspect", "2": "Concomitant", "3": "Interacting"}


@dataclass(frozen=True)
class SignalConfig:
    """Thresholds of the four metrics; z is that of two-sided 95 %."""

    z: float = 1.96
    prr: float = 2.0
    chi_squared: float = 4.0
    min_cases: int = 3
    eb05: float = 2.0
    #: alpha1, beta1, alpha2, beta2, mixing share of the two-gamma prior.
    prior: tuple[float, float, float, float, float] = (0.2, 0.1, 2.0, 4.0, 1 / 3)


@dataclass(frozen=True)
class OutcomeConfig:
    min_cases: int = 3
    threshold: float = 2.0


@dataclass(frozen=True)
class VelocityConfig:
    min_months: int = 3
    min_cases: int = 3
    acceleration: float = 0.5
    known_prr: float = 2.0


@dataclass(frozen=True)
class CascadeConfig:
    min_cases: int = 3
    death_rate: float = 0.1
    #: Kept for callers; no result depends on it.
    cascade_threshold: float = 3.0


@dataclass(frozen=True)
class PolypharmacyConfig:
    min_pair_count: int = 3
    interaction: float = 1.0


@dataclass(frozen=True)
class ReporterConfig:
    min_cases: int = 3
    diversity: float = 0.5
    bonus: float = 0.2


@dataclass(frozen=True)
class GeographicConfig:
    min_cases: int = 5
    min_country_cases: int = 2
    ratio: float = 3.0
    alpha: float = 0.05


@dataclass(frozen=True)
class DedupConfig:
    similarity_threshold: float = 0.85
    age_bucket: int = 5
    prefer_latest: bool = True
    prefer_complete: bool = True
