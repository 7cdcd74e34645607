"""Positional layout of the ADT segments we extract.

Every output column is keyed on a position in the message: segment id,
field number, component number and, for the optional numbered mode, a
repetition number.  The business names and the raw names they replace are
fixed values that must equal the reference's output; everything else in this
module is derived from them by rule.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from typing import Iterable

from segflow.ignore_names import IGNORE_NAMES

# ---------------------------------------------------------------------------
# Fixed values (must match the reference's configuration and output names).
# ---------------------------------------------------------------------------

# Segment fields dropped whole, `SEG_n` (exact match: PID_1 does not drop PID_10).
IGNORE_SEG_FIELDS = ("PID_1", "PID_12", "PV1_1", "IN1_1", "EVN_1", "OBX_1", "AL1_1", "GT1_1", "DG1_1")

# Components dropped wherever a field of that datatype appears, `TYPE_n`.
IGNORE_COMPONENT_FIELDS = ("CX_4", "CX_5", "XTN_2", "XTN_3", "XTN_5", "XTN_6", "XTN_7", "XCN_4", "XPN_3")

# Configured segments, in configured order.
HL7_SEGMENTS = ("pid", "pv1", "pv2", "pd1", "evn", "in1", "in2", "obx", "al1", "gt1", "zpv", "dg1", "nk1")

# States kept by the output filter (case-sensitive, untrimmed).
STATES = ("CA", "OR", "WA", "ID", "UT")

# Full raw names dropped before renaming; a list in the same one-name-per-line
# format can be passed through `ignore_names=` / `load_name_list()` instead.
DEFAULT_IGNORE_NAMES = tuple(IGNORE_NAMES)

# HL7 v2 datatype codes that occur inside raw names.
DATATYPE_CODES = (
    "ce", "cx", "dld", "dt", "fc", "hd", "id", "is", "nm", "pl", "si", "st", "ts",
    "varies", "xad", "xcn", "xon", "xpn", "xtn",
)

# Table name prefix per output data model version, and JDBC batch size.
TABLE_VERSION = "v4"
JDBC_BATCH_SIZE = 2000

# Postgres identifier limit: names over 63 bytes are cut to 62 characters.
NAME_MAX_BYTES = 63
NAME_CUT_CHARS = 62

# Raw name -> business name, in the reference's order.
FIELD_MAP = (
    ("al1_2_allergen_type_code_ce_1_identifier", "pt_allergy_allergen_type_code_1"),
    ("al1_2_allergen_type_code_ce_1_identifier_2", "pt_allergy_allergen_type_code_2"),
    ("al1_2_allergen_type_code_ce_1_identifier_3", "pt_allergy_allergen_type_code_3"),
    ("al1_3_allergen_code_mnemonic_description_ce_1_identifier", "pt_allergy_allergen_code_identifier"),
    ("al1_3_allergen_code_mnemonic_description_ce_2_text", "pt_allergy_allergen_code_text_1"),
    ("al1_3_allergen_code_mnemonic_description_ce_3_name_of_coding_system", "pt_allergy_allergen_code_system"),
    ("al1_4_allergy_severity_code_ce_1_identifier", "pt_allergy_severity_code_identifier"),
    ("al1_5_allergy_reaction_code_st_none", "pt_allergy_reaction_code_identifier"),
    ("al1_5_allergy_reaction_code_st_none_2", "pt_allergy_reaction_code_identifier_2"),
    ("al1_6_identification_date_dt_none", "pt_allergy_date"),
    ("dg1_2_diagnosis_coding_method_id_none", "pt_diag_coding_method_id"),
    ("dg1_3_diagnosis_code_dg1_ce_1_identifier", "pt_diag_code_identifier"),
    ("dg1_3_diagnosis_code_dg1_ce_2_text", "pt_diag_code_text_1"),
    ("dg1_3_diagnosis_code_dg1_ce_3_name_of_coding_system_1", "pt_diag_coding_system_name"),
    ("dg1_4_diagnosis_description_st_none", "pt_diag_description_1"),
    ("dg1_5_diagnosis_date_time_ts_1_time", "pt_diag_date_time"),
    ("dg1_6_diagnosis_type_is_none", "pt_diag_type_1"),
    ("evn_2_recorded_date_time_ts_1_time", "pt_event_recorded_date_time_1"),
    ("evn_2_recorded_date_time_ts_1_time_2", "pt_event_recorded_date_time_2"),
    ("evn_4_event_reason_code_is_none", "pt_event_reason_code"),
    ("evn_5_operator_id_xcn_14_assigning_facility", "pt_opr_assigning_facility_1"),
    ("evn_5_operator_id_xcn_1_id_number", "pt_event_operator_id_num_1"),
    ("evn_5_operator_id_xcn_1_id_number_2", "pt_event_operator_id_num_2"),
    ("evn_5_operator_id_xcn_2_family_name", "pt_event_operator_last_name"),
    ("evn_5_operator_id_xcn_3_given_name", "pt_event_operator_first_name"),
    ("evn_5_operator_id_xcn_9_assigning_authority", "pt_opr_assigning_auth_1"),
    ("evn_6_event_occurred_ts_1_time", "pt_event_occur_date_time"),
    ("evn_7_event_facility_hd_1_namespace_id", "pt_event_facil_namespace_id"),
    ("evn_7_event_facility_hd_2_universal_id", "pt_event_facil_universal_id"),
    ("evn_7_event_facility_hd_3_universal_id_type", "pt_event_facil_universal_id_type"),
    ("gt1_2_guarantor_number_cx_1_id_number", "guarantor_id_number"),
    ("gt1_3_guarantor_name_xpn_1_family_name", "guarantor_last_name"),
    ("gt1_3_guarantor_name_xpn_2_given_name", "guarantor_first_name"),
    ("gt1_46_contact_person_s_telephone_number_xtn_1_telephone_number", "guarantor_contact_phone_number"),
    ("gt1_49_job_title_st_none", "guarantor_job_title"),
    ("gt1_6_guarantor_ph_num_home_xtn_1_telephone_number", "guarantor_phone_number_1"),
    ("in1_16_name_of_insured_xpn_1_family_name", "insured_last_name"),
    ("in1_16_name_of_insured_xpn_2_given_name", "insured_first_name"),
    ("in1_17_insured_s_relationship_to_patient_ce_1_identifier", "insured_relation_to_pt"),
    ("in1_18_insured_s_date_of_birth_ts_1_time", "insured_dob"),
    ("in1_19_insured_s_address_xad_1_street_address", "insured_address_street"),
    ("in1_19_insured_s_address_xad_3_city", "insured_address_city"),
    ("in1_19_insured_s_address_xad_4_state_or_province", "insured_address_state_prov"),
    ("in1_19_insured_s_address_xad_5_zip_or_postal_code", "insured_address_zip_post"),
    ("in1_19_insured_s_address_xad_6_country", "insured_address_country"),
    ("in1_19_insured_s_address_xad_9_county_parish_code", "insured_address_county_parish"),
    ("in1_22_coord_of_ben_priority_st_none", "coord_ben_priority"),
    ("in1_25_report_of_eligibility_flag_id_none", "report_eligibility_flag_id"),
    ("in1_2_insurance_plan_id_ce_1_identifier", "pt_insurance_plan_id"),
    ("in1_2_insurance_plan_id_ce_2_text", "pt_insurance_plan_id_text"),
    ("in1_35_company_plan_code_is_none", "insurance_company_plan_code"),
    ("in1_36_policy_number_st_none", "insurance_policy_number"),
    ("in1_3_insurance_company_id_cx_1_id_number", "pt_insurance_company_id"),
    ("in1_3_insurance_company_id_cx_2_check_digit", "pt_insurance_co_id_check_digit"),
    ("in1_42_insured_s_employment_status_ce_1_identifier", "insured_employeement_status"),
    ("in1_43_insured_s_administrative_sex_is_none", "insured_gender"),
    ("in1_47_coverage_type_is_none", "insured_coverage_type"),
    ("in1_4_insurance_company_name_xon_1_organization_name", "pt_insurance_company_name"),
    ("in1_5_insurance_company_address_xad_1_street_address", "pt_insurance_company_add_street"),
    ("in1_5_insurance_company_address_xad_3_city", "pt_insurance_company_add_city"),
    ("in1_5_insurance_company_address_xad_4_state_or_province", "pt_insurance_company_add_state_prov"),
    ("in1_5_insurance_company_address_xad_5_zip_or_postal_code", "pt_insurance_company_add_zip_postal"),
    ("in1_7_insurance_co_phone_number_xtn_1_telephone_number", "pt_insurance_company_add_phone_num"),
    ("in1_8_group_number_st_none", "pt_insurance_group_num"),
    ("in1_9_group_name_xon_1_organization_name", "pt_insurance_group_name"),
    ("in2_2_insured_s_social_security_number_st_none", "insured_ssn"),
    ("in2_5_mail_claim_party_is_none", "insured_mail_claim_party"),
    ("in2_61_patient_member_number_cx_1_id_number", "pt_insurance_member_number"),
    ("in2_63_insured_s_phone_number_home_xtn_1_telephone_number", "insured_phone_number_1"),
    ("in2_64_insured_s_employer_phone_number_xtn_1_telephone_number", "insured_employer_phone_number_1"),
    ("in2_6_medicare_health_ins_card_number_st_none", "medicare_card_number"),
    ("in2_70_insured_employer_organization_name_and_id_xon_1_organization_name", "insured_employer_org_name_1"),
    ("obx_11_observation_result_status_id_none", "clinical_observation_result_status_id"),
    ("obx_2_value_type_id_none", "clinical_observation_type_id"),
    ("obx_3_observation_identifier_ce_1_identifier", "clinical_observation_identifier"),
    ("obx_4_observation_sub_id_st_none", "clinical_observation_sub_identifier"),
    ("obx_5_observation_value_varies_1_none", "clinical_observation_value"),
    ("pd1_15_advance_directive_code_ce_1_identifier", "pt_ad_code_identifier"),
    ("pd1_15_advance_directive_code_ce_2_text", "pt_ad_code_text"),
    ("pd1_3_patient_primary_facility_xon_1_organization_name", "pt_primary_facility_name"),
    ("pd1_3_patient_primary_facility_xon_3_id_number", "pt_primary_facility_id"),
    ("pd1_4_patient_primary_care_provider_name_id_no_xcn_13_identifier_type_code", "pt_pcp_id_type_code"),
    ("pd1_4_patient_primary_care_provider_name_id_no_xcn_1_id_number", "pt_pcp_id_num"),
    ("pd1_4_patient_primary_care_provider_name_id_no_xcn_2_family_name", "pt_pcp_last_name"),
    ("pd1_4_patient_primary_care_provider_name_id_no_xcn_3_given_name", "pt_pcp_first_name"),
    ("pd1_4_patient_primary_care_provider_name_id_no_xcn_9_assigning_authority", "pt_pcp_assign_auth"),
    ("pid_10_race_ce_1_identifier", "pt_race_identifier"),
    ("pid_10_race_ce_2_text", "pt_race_text"),
    ("pid_11_patient_address_xad_13_effective_date", "pt_address_effect_date"),
    ("pid_11_patient_address_xad_1_street_address", "pt_address_st_1"),
    ("pid_11_patient_address_xad_3_city", "pt_address_city"),
    ("pid_11_patient_address_xad_4_state_or_province", "pt_address_state_prov"),
    ("pid_11_patient_address_xad_5_zip_or_postal_code", "pt_address_zip_postal"),
    ("pid_11_patient_address_xad_6_country", "pt_address_country"),
    ("pid_11_patient_address_xad_7_address_type", "pt_address_type"),
    ("pid_11_patient_address_xad_9_county_parish_code", "pt_county_parish"),
    ("pid_13_phone_number_home_xtn_1_telephone_number", "pt_contact_phone_number_1"),
    ("pid_13_phone_number_home_xtn_1_telephone_number_2", "pt_contact_phone_number_2"),
    ("pid_13_phone_number_home_xtn_4_email_address", "pt_email"),
    ("pid_13_phone_number_home_xtn_9_any_text", "pt_notes_1"),
    ("pid_13_phone_number_home_xtn_9_any_text_2", "pt_notes_2"),
    ("pid_13_phone_number_home_xtn_9_any_text_3", "pt_notes_3"),
    ("pid_14_phone_number_business_xtn_1_telephone_number", "pt_business_phone_number_2"),
    ("pid_15_primary_language_ce_1_identifier", "pt_primary_lang_identifier"),
    ("pid_15_primary_language_ce_2_text", "pt_primary_lang_text"),
    ("pid_16_marital_status_ce_1_identifier", "pt_marital_status"),
    ("pid_17_religion_ce_1_identifier", "pt_religion"),
    ("pid_18_patient_account_number_cx_1_id_number", "pt_account_number_1"),
    ("pid_18_patient_account_number_cx_1_id_number_2", "pt_account_number_2"),
    ("pid_19_ssn_number_patient_st_none", "pt_ssn"),
    ("pid_22_ethnic_group_ce_1_identifier", "pt_ethnicity_identifier"),
    ("pid_22_ethnic_group_ce_2_text", "pt_ethnicity_text"),
    ("pid_27_veterans_military_status_ce_1_identifier", "pt_veterans_military_status"),
    ("pid_28_nationality_ce_1_identifier", "pt_nationality"),
    ("pid_29_patient_death_date_and_time_ts_1_time", "pt_death_date_time"),
    ("pid_2_patient_id_cx_1_id_number", "pt_id_4"),
    ("pid_30_patient_death_indicator_id_none", "pt_death_indicator"),
    ("pid_3_patient_identifier_list_cx_1_id_number_2", "pt_id_2"),
    ("pid_3_patient_identifier_list_cx_1_id_number_3", "pt_id_5"),
    ("pid_4_alternate_patient_id_pid_cx_1_id_number", "pt_id_3"),
    ("pid_5_patient_name_xpn_1_family_name", "pt_last_name"),
    ("pid_5_patient_name_xpn_2_given_name", "pt_first_name"),
    ("pid_5_patient_name_xpn_5_prefix_e_g_dr", "pt_name_prefix"),
    ("pid_7_date_time_of_birth_ts_1_time", "pt_dob"),
    ("pid_8_administrative_sex_is_none", "pt_gender"),
    ("pid_9_patient_alias_xpn_1_family_name", "pt_last_name_alias"),
    ("pid_9_patient_alias_xpn_2_given_name", "pt_first_name_alias"),
    ("pv1_10_hospital_service_is_none", "pt_hospital_service"),
    ("pv1_11_temporary_location_pl_4_facility", "pt_temp_loc_facility"),
    ("pv1_14_admit_source_is_none", "pt_admit_source_1"),
    ("pv1_17_admitting_doctor_xcn_10_name_type_code", "pt_admitting_doc_name_type_code"),
    ("pv1_17_admitting_doctor_xcn_12_check_digit_scheme", "pt_admitting_doc_chk_digit_scheme_1"),
    ("pv1_17_admitting_doctor_xcn_1_id_number", "pt_admitting_doc_id_num"),
    ("pv1_17_admitting_doctor_xcn_2_family_name", "pt_admitting_doc_last_name"),
    ("pv1_18_patient_type_is_none", "pt_type"),
    ("pv1_19_visit_number_cx_1_id_number", "pt_visit_number"),
    ("pv1_20_financial_class_fc_1_financial_class_code", "pt_fin_class"),
    ("pv1_2_patient_class_is_none", "pt_class"),
    ("pv1_36_discharge_disposition_is_none", "pt_discharge_disp"),
    ("pv1_37_discharged_to_location_dld_1_discharge_location", "pt_discharge_loc"),
    ("pv1_3_assigned_patient_location_pl_11_assigning_authority_for_location", "pt_loc_assign_auth_for_loc"),
    ("pv1_3_assigned_patient_location_pl_1_point_of_care", "pt_loc_poc_1"),
    ("pv1_3_assigned_patient_location_pl_2_room", "pt_loc_room_1"),
    ("pv1_3_assigned_patient_location_pl_3_bed", "pt_loc_bed_1"),
    ("pv1_3_assigned_patient_location_pl_4_facility", "pt_loc_facility_1"),
    ("pv1_3_assigned_patient_location_pl_5_location_status", "pt_assigned_loc_status_1"),
    ("pv1_3_assigned_patient_location_pl_6_person_location_type", "pt_assigned_loc_person_loc_type"),
    ("pv1_3_assigned_patient_location_pl_9_location_description", "pt_loc_description"),
    ("pv1_41_account_status_is_none", "pt_account_status_1"),
    ("pv1_44_admit_date_time_ts_1_time", "pt_admit_date_1"),
    ("pv1_45_discharge_date_time_ts_1_time", "pt_discharge_date_time"),
    ("pv1_47_total_charges_nm_none", "pt_total_charges"),
    ("pv1_4_admission_type_is_none", "pt_addmission_type"),
    ("pv1_50_alternate_visit_id_cx_1_id_number", "pt_alt_visid_id_num"),
    ("pv1_52_other_healthcare_provider_xcn_5_suffix_e_g_jr_or_iii", "provider_suffix"),
    ("pv1_6_prior_patient_location_pl_1_point_of_care", "pt_prior_loc_poc_1"),
    ("pv1_6_prior_patient_location_pl_2_room", "pt_prior_loc_room_1"),
    ("pv1_6_prior_patient_location_pl_3_bed", "pt_prior_loc_bed_1"),
    ("pv1_6_prior_patient_location_pl_4_facility", "pt_prior_facil_loc"),
    ("pv1_6_prior_patient_location_pl_7_building", "pt_prior_loc_person_loc_building"),
    ("pv1_7_attending_doctor_xcn_13_identifier_type_code", "pt_attending_doc_id_type_code"),
    ("pv1_7_attending_doctor_xcn_1_id_number", "pt_attending_doc_id_num"),
    ("pv1_7_attending_doctor_xcn_2_family_name", "pt_attending_doc_last_name"),
    ("pv1_7_attending_doctor_xcn_3_given_name", "pt_attending_doc_first_name"),
    ("pv1_7_attending_doctor_xcn_9_assigning_authority", "pt_attending_doc_assign_auth"),
    ("pv1_8_referring_doctor_xcn_13_identifier_type_code", "pt_referring_doc_id_type_code"),
    ("pv1_8_referring_doctor_xcn_1_id_number", "pt_referring_doc_id_num"),
    ("pv1_8_referring_doctor_xcn_2_family_name", "pt_referring_doc_last_name"),
    ("pv1_8_referring_doctor_xcn_3_given_name", "pt_referring_doc_first_name"),
    ("pv1_8_referring_doctor_xcn_9_assigning_authority", "pt_referring_doc_assign_auth"),
    ("pv2_10_estimated_length_of_inpatient_stay_nm_none", "pt_est_length_inpatient_stay"),
    ("pv2_12_visit_description_st_none", "pt_visit_description"),
    ("pv2_21_visit_publicity_code_is_none", "pt_visit_publicity_code"),
    ("pv2_22_visit_protection_indicator_id_none", "pt_protection_indicator_id"),
    ("pv2_2_accommodation_code_ce_1_identifier", "pt_accomodation_code_id"),
    ("pv2_32_billing_media_code_id_none", "pt_billing_media_code_id"),
    ("pv2_38_mode_of_arrival_code_ce_1_identifier", "pt_visit_arrival_mode"),
    ("pv2_40_admission_level_of_care_code_ce_1_identifier", "pt_admission_level_of_care_id"),
    ("pv2_8_expected_admit_date_time_ts_1_time", "pt_expected_admit_date"),
    ("pv2_9_expected_discharge_date_time_ts_1_time", "pt_expected_discharge_date_time"),
    ("zpv_15_none_st_none", "pt_discharge_reason_other"),
    ("zpv_39_none_st_none", "zpv_phone_number_1"),
)

# ---------------------------------------------------------------------------
# Derived by rule.
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Position:
    """One extracted value: `segment`-`field`.`component`, optional repetition.

    `rep` is None for the default reading (last non-blank repetition) and k for
    the k-th repetition in numbered mode.  Simple types (ST, IS, ...) carry
    component 1.
    """

    segment: str
    field: int
    datatype: str
    component: int
    rep: int | None

    @property
    def key(self) -> str:
        """Positional key used for `extras` and long-form rows."""
        return f"{self.segment}_{self.field}_{self.component}"


def parse_raw_name(name: str) -> Position | None:
    """Read the position out of a raw `seg_pos_long_type_comp_complong[_k]` name.

    The datatype token is the first known code followed by a component number
    or `none`; a trailing number after the component's long name is the
    repetition.  Names with no readable position return None.
    """
    tokens = name.lower().split("_")
    if len(tokens) < 4 or not tokens[1].isdigit():
        return None
    seg, field = tokens[0], int(tokens[1])
    for i in range(2, len(tokens) - 1):
        nxt = tokens[i + 1]
        if tokens[i] in DATATYPE_CODES and (nxt.isdigit() or nxt == "none"):
            datatype = tokens[i]
            comp = int(nxt) if nxt.isdigit() else 1
            tail = tokens[i + 2:]
            rep = None
            if len(tail) >= 1 and tail[-1].isdigit() and (len(tail) >= 2 or nxt == "none"):
                rep = int(tail[-1])
            return Position(seg, field, datatype, comp, rep)
    return None


@dataclass(frozen=True)
class Column:
    raw: str
    name: str
    pos: Position


@lru_cache(maxsize=None)
def _columns(field_map: tuple = FIELD_MAP) -> tuple[Column, ...]:
    out = []
    for raw, name in field_map:
        pos = parse_raw_name(raw)
        if pos is None:
            raise ValueError(f"no position in raw name {raw!r}")
        out.append(Column(raw, name, pos))
    names = [c.name for c in out]
    if len(set(names)) != len(names):
        raise ValueError("duplicate business names in field map")
    return tuple(out)


def columns(field_map: Iterable[tuple[str, str]] = FIELD_MAP) -> tuple[Column, ...]:
    """Every mapped column with its position (numbered ones included)."""
    return _columns(tuple(field_map))


def field_datatypes(field_map: Iterable[tuple[str, str]] = FIELD_MAP,
                    extra_names: Iterable[str] = ()) -> dict[tuple[str, int], str]:
    """(segment, field) -> datatype for every field named in the given lists."""
    out: dict[tuple[str, int], str] = {}
    for raw in [r for r, _ in field_map] + list(extra_names):
        pos = parse_raw_name(raw)
        if pos is not None:
            out.setdefault((pos.segment, pos.field), pos.datatype)
    return out


@dataclass(frozen=True)
class IgnoreRules:
    """The three ignore lists, resolved to positions.

    seg_fields: {(segment, field)}; components: {(datatype, component)};
    names: {(segment, field, component, rep)} where rep None is the
    unnumbered reading.
    """

    seg_fields: frozenset
    components: frozenset
    names: frozenset
    datatypes: dict

    def drops(self, segment: str, field: int, component: int, rep: int | None = None) -> bool:
        if (segment, field) in self.seg_fields:
            return True
        dt = self.datatypes.get((segment, field))
        if dt is not None and (dt, component) in self.components:
            return True
        return (segment, field, component, rep) in self.names


def ignore_rules(seg_fields: Iterable[str] = IGNORE_SEG_FIELDS,
                 component_fields: Iterable[str] = IGNORE_COMPONENT_FIELDS,
                 ignore_names: Iterable[str] = DEFAULT_IGNORE_NAMES,
                 field_map: Iterable[tuple[str, str]] = FIELD_MAP) -> IgnoreRules:
    ignore_names = list(ignore_names)
    sf = set()
    for item in seg_fields:
        seg, _, num = item.lower().partition("_")
        sf.add((seg, int(num)))
    cf = set()
    for item in component_fields:
        dt, _, num = item.lower().partition("_")
        cf.add((dt, int(num)))
    names = set()
    for raw in ignore_names:
        pos = parse_raw_name(raw)
        if pos is not None:
            names.add((pos.segment, pos.field, pos.component, pos.rep))
    return IgnoreRules(frozenset(sf), frozenset(cf), frozenset(names),
                       field_datatypes(field_map, ignore_names))


def load_name_list(path: str) -> list[str]:
    """Read an ignore-name file: one raw name per line."""
    with open(path, encoding="utf-8") as fh:
        return [line.rstrip("\n") for line in fh if line.strip()]


def load_field_map(path: str) -> list[tuple[str, str]]:
    """Read a field-map file: one `('raw', 'business')` tuple per line."""
    import ast

    with open(path, encoding="utf-8") as fh:
        return [tuple(ast.literal_eval(line)) for line in fh if line.strip()]


def wide_columns(segments: Iterable[str] = HL7_SEGMENTS,
                 numbered: bool = False,
                 rules: IgnoreRules | None = None,
                 field_map: Iterable[tuple[str, str]] = FIELD_MAP) -> list[Column]:
    """Mapped columns the wide output carries, in field-map order.

    Default mode keeps the unnumbered names (170 for the shipped map);
    numbered mode adds the ones ending in a repetition number.  Ignored
    positions are left out.
    """
    rules = rules or ignore_rules()
    segs = {s.lower() for s in segments}
    out = []
    for c in columns(field_map):
        p = c.pos
        if p.segment not in segs:
            continue
        if p.rep is not None and not numbered:
            continue
        if rules.drops(p.segment, p.field, p.component, p.rep):
            continue
        out.append(c)
    return out


def mapped_keys(field_map: Iterable[tuple[str, str]] = FIELD_MAP) -> frozenset:
    """Positional keys (`seg_field_comp`) that have an unnumbered business name."""
    return frozenset(c.pos.key for c in columns(field_map) if c.pos.rep is None)


def listed_repetitions(field_map: Iterable[tuple[str, str]] = FIELD_MAP) -> dict[str, set[int]]:
    """Positional key -> repetitions that have a business name in numbered mode."""
    out: dict[str, set[int]] = {}
    for c in columns(field_map):
        out.setdefault(c.pos.key, set()).add(c.pos.rep or 1)
    return out


def truncated_name(name: str) -> str:
    """Postgres-safe name: over 63 bytes -> first 62 characters."""
    if len(name.encode("utf-8")) > NAME_MAX_BYTES:
        return name[:NAME_CUT_CHARS]
    return name


def table_name(feed: str, version: str = TABLE_VERSION) -> str:
    """Output table per feed: version + '_' + feed with '-' -> '_'."""
    return f"{version}_{feed.replace('-', '_')}"
