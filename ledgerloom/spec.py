"""The datasets: source columns, types and rules. All values here are fixed values of the data model."""

from __future__ import annotations

from dataclasses import dataclass

from ledgerloom.functions.rules import RuleSpec, Subtype

# Source columns in file order.
DEFICIENCY_COLUMNS = (
    "cms_certification_number_ccn", "provider_name", "provider_address", "citytown", "state", "zip_code", "survey_date", "survey_footnote", "survey_type", "deficiency_prefix",
    "deficiency_category", "deficiency_tag_number", "deficiency_description", "scope_severity_code", "deficiency_corrected", "correction_date", "inspection_cycle", "standard_deficiency",
    "complaint_deficiency", "infection_control_inspection_deficiency", "citation_under_idr", "citation_under_iidr", "location", "processing_date",
)
PENALTY_COLUMNS = (
    "cms_certification_number_ccn", "provider_name", "provider_address", "citytown", "state", "zip_code", "penalty_date", "penalty_type", "fine_id", "fine_amount",
    "payment_denial_start_date", "payment_denial_length_in_days", "location", "processing_date",
)
QUALITY_COLUMNS = (
    "cms_certification_number_ccn", "provider_name", "provider_address", "citytown", "state", "zip_code", "measure_code", "measure_description", "resident_type",
    "q1_measure_score", "footnote_for_q1_measure_score", "q2_measure_score", "footnote_for_q2_measure_score", "q3_measure_score", "footnote_for_q3_measure_score",
    "q4_measure_score", "footnote_for_q4_measure_score", "four_quarter_average_score", "footnote_for_four_quarter_average_score", "used_in_quality_measure_five_star_rating",
    "measure_period", "location", "processing_date",
)

# Rules of the data model.
CCN, STATE, ZIP = "[0-9A-Z]{6}", "[A-Z]{2}", "[0-9]{5}"
WITH_CORRECTION_DATE = "Deficient, Provider has date of correction"

DEFICIENCIES = RuleSpec(
    source=DEFICIENCY_COLUMNS,
    types={"survey_date": "date", "correction_date": "date", "processing_date": "date", "survey_footnote": "int", "inspection_cycle": "int"},
    flags=("standard_deficiency", "complaint_deficiency", "infection_control_inspection_deficiency", "citation_under_idr", "citation_under_iidr"),
    upper=("cms_certification_number_ccn", "state", "deficiency_prefix", "scope_severity_code"),
    required=("cms_certification_number_ccn", "survey_date", "survey_type", "deficiency_prefix", "deficiency_tag_number", "inspection_cycle"),
    regex={"cms_certification_number_ccn": CCN, "state": STATE, "zip_code": ZIP, "deficiency_tag_number": "[0-9]{4}"},
    domain={"scope_severity_code": tuple("ABCDEFGHIJKL"), "inspection_cycle": (1, 2, 3)},
    conditional=(Subtype("correction_date_required", "deficiency_corrected", WITH_CORRECTION_DATE, ("correction_date",)),),
)
PENALTIES = RuleSpec(
    source=PENALTY_COLUMNS,
    types={"penalty_date": "date", "payment_denial_start_date": "date", "processing_date": "date", "fine_amount": "decimal(14,2)", "payment_denial_length_in_days": "int"},
    upper=("cms_certification_number_ccn", "state"),
    required=("cms_certification_number_ccn", "penalty_date", "penalty_type"),
    regex={"cms_certification_number_ccn": CCN, "state": STATE, "zip_code": ZIP},
    domain={"penalty_type": ("Fine", "Payment Denial")},
    non_negative=("fine_amount", "payment_denial_length_in_days"),
    conditional=(
        Subtype("fine_subtype", "penalty_type", "Fine", ("fine_id", "fine_amount"), ("payment_denial_start_date", "payment_denial_length_in_days")),
        Subtype("payment_denial_subtype", "penalty_type", "Payment Denial", ("payment_denial_start_date", "payment_denial_length_in_days"), ("fine_id", "fine_amount")),
    ),
)
_SCORES = ("q1_measure_score", "q2_measure_score", "q3_measure_score", "q4_measure_score", "four_quarter_average_score")
_QUALITY_NOTES = tuple(c for c in QUALITY_COLUMNS if c.startswith("footnote_for_q"))
QUALITY = RuleSpec(
    source=QUALITY_COLUMNS,
    types={**{c: "double" for c in _SCORES}, **{c: "int" for c in _QUALITY_NOTES}, "processing_date": "date"},
    flags=("used_in_quality_measure_five_star_rating",),
    upper=("cms_certification_number_ccn", "state"),
    required=("cms_certification_number_ccn", "measure_code", "resident_type", "measure_period", "used_in_quality_measure_five_star_rating"),
    regex={"cms_certification_number_ccn": CCN, "state": STATE, "zip_code": ZIP, "measure_code": "[0-9A-Z]{3}", "measure_period": "[0-9]{4}Q[1-4]-[0-9]{4}Q[1-4]"},
    domain={"resident_type": ("Long Stay", "Short Stay")},
    ranges={c: (0, 100) for c in _SCORES},
)
# Provider columns in file order and their types; the other columns are text.
PROVIDER_COLUMNS = (
    "cms_certification_number_ccn", "provider_name", "provider_address", "citytown", "state", "zip_code", "telephone_number", "provider_ssa_county_code", "countyparish",
    "urban", "ownership_type", "number_of_certified_beds", "average_number_of_residents_per_day", "average_number_of_residents_per_day_footnote", "provider_type",
    "provider_resides_in_hospital", "legal_business_name", "date_first_approved_to_provide_medicare_and_medicaid_services", "chain_name", "chain_id",
    "number_of_facilities_in_chain", "chain_average_overall_5star_rating", "chain_average_health_inspection_rating", "chain_average_staffing_rating",
    "chain_average_qm_rating", "continuing_care_retirement_community", "special_focus_status", "abuse_icon", "high_performing_icon",
    "most_recent_health_inspection_more_than_2_years_ago", "provider_changed_ownership_in_last_12_months", "with_a_resident_and_family_council",
    "automatic_sprinkler_systems_in_all_required_areas", "overall_rating", "overall_rating_footnote", "health_inspection_rating", "health_inspection_rating_footnote",
    "qm_rating", "qm_rating_footnote", "longstay_qm_rating", "longstay_qm_rating_footnote", "shortstay_qm_rating", "shortstay_qm_rating_footnote", "staffing_rating",
    "staffing_rating_footnote", "reported_staffing_footnote", "physical_therapist_staffing_footnote", "reported_nurse_aide_staffing_hours_per_resident_per_day",
    "reported_lpn_staffing_hours_per_resident_per_day", "reported_rn_staffing_hours_per_resident_per_day", "reported_licensed_staffing_hours_per_resident_per_day",
    "reported_total_nurse_staffing_hours_per_resident_per_day", "total_number_of_nurse_staff_hours_per_resident_per_day_on_t_4a14",
    "registered_nurse_hours_per_resident_per_day_on_the_weekend", "reported_physical_therapist_staffing_hours_per_resident_per_day", "total_nursing_staff_turnover",
    "total_nursing_staff_turnover_footnote", "registered_nurse_turnover", "registered_nurse_turnover_footnote",
    "number_of_administrators_who_have_left_the_nursing_home", "administrator_turnover_footnote", "nursing_casemix_index", "nursing_casemix_index_ratio",
    "casemix_nurse_aide_staffing_hours_per_resident_per_day", "casemix_lpn_staffing_hours_per_resident_per_day", "casemix_rn_staffing_hours_per_resident_per_day",
    "casemix_total_nurse_staffing_hours_per_resident_per_day", "casemix_weekend_total_nurse_staffing_hours_per_resident_per_day",
    "adjusted_nurse_aide_staffing_hours_per_resident_per_day", "adjusted_lpn_staffing_hours_per_resident_per_day", "adjusted_rn_staffing_hours_per_resident_per_day",
    "adjusted_total_nurse_staffing_hours_per_resident_per_day", "adjusted_weekend_total_nurse_staffing_hours_per_resident_per_day",
    "rating_cycle_1_standard_survey_health_date", "rating_cycle_1_standard_survey_footnote", "rating_cycle_1_total_number_of_health_deficiencies",
    "rating_cycle_1_number_of_standard_health_deficiencies", "rating_cycle_1_number_of_complaint_health_deficiencies", "rating_cycle_1_health_deficiency_score",
    "rating_cycle_1_number_of_health_revisits", "rating_cycle_1_health_revisit_score", "rating_cycle_1_total_health_score", "rating_cycle_2_standard_health_survey_date",
    "rating_cycle_2_standard_survey_footnote", "rating_cycle_23_total_number_of_health_deficiencies", "rating_cycle_2_number_of_standard_health_deficiencies",
    "rating_cycle_23_number_of_complaint_health_deficiencies", "rating_cycle_23_health_deficiency_score", "rating_cycle_23_number_of_health_revisits",
    "rating_cycle_23_health_revisit_score", "rating_cycle_23_total_health_score", "total_weighted_health_survey_score",
    "number_of_citations_from_infection_control_inspections", "number_of_fines", "total_amount_of_fines_in_dollars", "number_of_payment_denials",
    "total_number_of_penalties", "location", "latitude", "longitude", "geocoding_footnote", "processing_date",
)
_PROVIDER_FLAGS = (
    "urban", "provider_resides_in_hospital", "continuing_care_retirement_community", "abuse_icon", "high_performing_icon",
    "most_recent_health_inspection_more_than_2_years_ago", "provider_changed_ownership_in_last_12_months",
)
_PROVIDER_DATES = (
    "date_first_approved_to_provide_medicare_and_medicaid_services", "rating_cycle_1_standard_survey_health_date", "rating_cycle_2_standard_health_survey_date",
)
_PROVIDER_DOUBLES = (
    "latitude", "longitude", "average_number_of_residents_per_day", "chain_average_overall_5star_rating", "chain_average_health_inspection_rating",
    "chain_average_staffing_rating", "chain_average_qm_rating", "reported_nurse_aide_staffing_hours_per_resident_per_day",
    "reported_lpn_staffing_hours_per_resident_per_day", "reported_rn_staffing_hours_per_resident_per_day", "reported_licensed_staffing_hours_per_resident_per_day",
    "reported_total_nurse_staffing_hours_per_resident_per_day", "total_number_of_nurse_staff_hours_per_resident_per_day_on_t_4a14",
    "registered_nurse_hours_per_resident_per_day_on_the_weekend", "reported_physical_therapist_staffing_hours_per_resident_per_day", "total_nursing_staff_turnover",
    "registered_nurse_turnover", "nursing_casemix_index", "nursing_casemix_index_ratio", "casemix_nurse_aide_staffing_hours_per_resident_per_day",
    "casemix_lpn_staffing_hours_per_resident_per_day", "casemix_rn_staffing_hours_per_resident_per_day", "casemix_total_nurse_staffing_hours_per_resident_per_day",
    "casemix_weekend_total_nurse_staffing_hours_per_resident_per_day", "adjusted_nurse_aide_staffing_hours_per_resident_per_day",
    "adjusted_lpn_staffing_hours_per_resident_per_day", "adjusted_rn_staffing_hours_per_resident_per_day", "adjusted_total_nurse_staffing_hours_per_resident_per_day",
    "adjusted_weekend_total_nurse_staffing_hours_per_resident_per_day", "total_weighted_health_survey_score",
)
_PROVIDER_INTS = (
    "geocoding_footnote", "number_of_certified_beds", "average_number_of_residents_per_day_footnote", "number_of_facilities_in_chain", "overall_rating",
    "overall_rating_footnote", "health_inspection_rating", "health_inspection_rating_footnote", "qm_rating", "qm_rating_footnote", "longstay_qm_rating",
    "longstay_qm_rating_footnote", "shortstay_qm_rating", "shortstay_qm_rating_footnote", "staffing_rating", "staffing_rating_footnote", "reported_staffing_footnote",
    "physical_therapist_staffing_footnote", "total_nursing_staff_turnover_footnote", "registered_nurse_turnover_footnote",
    "number_of_administrators_who_have_left_the_nursing_home", "administrator_turnover_footnote", "rating_cycle_1_standard_survey_footnote",
    "rating_cycle_1_total_number_of_health_deficiencies", "rating_cycle_1_number_of_standard_health_deficiencies",
    "rating_cycle_1_number_of_complaint_health_deficiencies", "rating_cycle_1_health_deficiency_score", "rating_cycle_1_number_of_health_revisits",
    "rating_cycle_1_health_revisit_score", "rating_cycle_1_total_health_score", "rating_cycle_2_standard_survey_footnote",
    "rating_cycle_23_total_number_of_health_deficiencies", "rating_cycle_2_number_of_standard_health_deficiencies",
    "rating_cycle_23_number_of_complaint_health_deficiencies", "rating_cycle_23_health_deficiency_score", "rating_cycle_23_number_of_health_revisits",
    "rating_cycle_23_health_revisit_score", "rating_cycle_23_total_health_score", "number_of_citations_from_infection_control_inspections", "number_of_fines",
    "number_of_payment_denials", "total_number_of_penalties",
)
_RATINGS = (
    "chain_average_overall_5star_rating", "chain_average_health_inspection_rating", "chain_average_staffing_rating", "chain_average_qm_rating", "overall_rating",
    "health_inspection_rating", "qm_rating", "longstay_qm_rating", "shortstay_qm_rating", "staffing_rating",
)
_MAY_BE_NEGATIVE = {"latitude", "longitude"}
_PROVIDER_TYPES = {
    **{c: "double" for c in _PROVIDER_DOUBLES}, **{c: "int" for c in _PROVIDER_INTS}, **{c: "date" for c in (*_PROVIDER_DATES, "processing_date")},
    "total_amount_of_fines_in_dollars": "decimal(14,2)",
}
PROVIDERS = RuleSpec(
    source=PROVIDER_COLUMNS,
    types=_PROVIDER_TYPES,
    flags=_PROVIDER_FLAGS,
    upper=("cms_certification_number_ccn", "state"),
    required=("cms_certification_number_ccn",),
    regex={"cms_certification_number_ccn": CCN, "state": STATE, "zip_code": ZIP},
    domain={
        "special_focus_status": ("SFF", "SFF Candidate"),
        "with_a_resident_and_family_council": ("Resident", "Family", "Both", "None"),
        "automatic_sprinkler_systems_in_all_required_areas": ("Yes", "Partial", "No", "Data Not Available"),
    },
    ranges={**{c: (1, 5) for c in _RATINGS}, "latitude": (-90, 90), "longitude": (-180, 180)},
    # every measure except footnotes, coordinates and the ratings that already have a range of their own
    non_negative=tuple(
        c for c in PROVIDER_COLUMNS
        if _PROVIDER_TYPES.get(c) in ("double", "int", "decimal(14,2)") and "footnote" not in c and c not in _MAY_BE_NEGATIVE and (c not in _RATINGS or c.startswith("chain_"))
    ),
)
HEADER_OVERRIDES = {
    "provider_info": {"Total number of nurse staff hours per resident per day on the weekend": "total_number_of_nurse_staff_hours_per_resident_per_day_on_t_4a14"},
}

DATASETS: dict[str, RuleSpec] = {"health_deficiencies": DEFICIENCIES, "penalties": PENALTIES, "mds_quality": QUALITY, "provider_info": PROVIDERS}

BRONZE_METADATA = ("_dataset_id", "_source_file", "_source_file_sha256", "_batch_id", "_load_type", "_ingest_date", "load_timestamp")
LINEAGE = ("row_hash", "is_deleted", "source_file", "source_file_sha256", "source_batch_id", "source_processing_date", "load_timestamp")


@dataclass(frozen=True)
class DatasetSpec:
    """Where a dataset comes from, how it is loaded and what identifies a record."""

    name: str
    dataset_id: str
    strategy: str
    entity_key: str
    key: tuple[str, ...]
    nullable_key: tuple[str, ...] = ()
    watermark: str | None = None
    bronze_table: str = ""
    silver_table: str = ""

    @property
    def rules(self) -> RuleSpec:
        return DATASETS[self.name]


# The registry of datasets.
REGISTRY = {
    d.name: d
    for d in (
        DatasetSpec(
            "health_deficiencies", "r5ix-sfxw", "api_date_window", "deficiency_key",
            ("cms_certification_number_ccn", "survey_date", "survey_type", "deficiency_prefix", "deficiency_tag_number", "inspection_cycle"),
            watermark="survey_date", bronze_table="bronze_nh_health_deficiencies", silver_table="silver_deficiency",
        ),
        DatasetSpec(
            "penalties", "g6vv-u9sr", "api_date_window", "penalty_key", ("cms_certification_number_ccn", "penalty_date", "penalty_type", "fine_id", "payment_denial_start_date"),
            nullable_key=("fine_id", "payment_denial_start_date"), watermark="penalty_date", bronze_table="bronze_nh_penalties", silver_table="silver_penalty",
        ),
        DatasetSpec("provider_info", "4pq5-n9py", "snapshot_diff", "facility_key", ("cms_certification_number_ccn",), bronze_table="bronze_nh_provider_info", silver_table="silver_facility"),
        DatasetSpec(
            "mds_quality", "djen-97ju", "snapshot_diff", "mds_key", ("cms_certification_number_ccn", "measure_code", "resident_type", "measure_period"),
            bronze_table="bronze_nh_mds_quality", silver_table="silver_mds_quality",
        ),
    )
}


def dataset(name: str) -> DatasetSpec:
    if name not in REGISTRY:
        raise ValueError(f"unknown dataset {name!r}; known are {', '.join(sorted(REGISTRY))}")
    return REGISTRY[name]


def check_contract() -> None:
    """The locked sizes of the data model; run by the tests and cheap enough to run anywhere."""
    sizes = {"health_deficiencies": 24, "penalties": 14, "provider_info": 102, "mds_quality": 23}
    for name, n in sizes.items():
        columns = DATASETS[name].source
        if len(columns) != n or len(set(columns)) != n:
            raise ValueError(f"{name}: {len(columns)} source columns, {n} expected without repetition")


def silver_kinds(spec: RuleSpec) -> dict[str, str]:
    """Silver kind of each source column, '' for text."""
    return {c: "boolean" if c in spec.flags else spec.types.get(c, "") for c in spec.source}
