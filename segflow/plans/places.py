"""Business names and their places, written out for the oracles.

Kept apart from `segflow.layout` on purpose: the oracles compare the layout, which
reads places out of raw names, against this table.
"""

# Business names and places.
PLACES = {}
for _line in """
pt_allergy_allergen_type_code_1 al1-2.1
pt_allergy_allergen_code_identifier al1-3.1
pt_allergy_allergen_code_text_1 al1-3.2
pt_allergy_allergen_code_system al1-3.3
pt_allergy_severity_code_identifier al1-4.1
pt_allergy_reaction_code_identifier al1-5.1
pt_allergy_date al1-6.1
pt_diag_coding_method_id dg1-2.1
pt_diag_code_identifier dg1-3.1
pt_diag_code_text_1 dg1-3.2
pt_diag_description_1 dg1-4.1
pt_diag_date_time dg1-5.1
pt_diag_type_1 dg1-6.1
pt_event_recorded_date_time_1 evn-2.1
pt_event_reason_code evn-4.1
pt_opr_assigning_facility_1 evn-5.14
pt_event_operator_id_num_1 evn-5.1
pt_event_operator_last_name evn-5.2
pt_event_operator_first_name evn-5.3
pt_opr_assigning_auth_1 evn-5.9
pt_event_occur_date_time evn-6.1
pt_event_facil_namespace_id evn-7.1
pt_event_facil_universal_id evn-7.2
pt_event_facil_universal_id_type evn-7.3
guarantor_id_number gt1-2.1
guarantor_last_name gt1-3.1
guarantor_first_name gt1-3.2
guarantor_contact_phone_number gt1-46.1
guarantor_job_title gt1-49.1
guarantor_phone_number_1 gt1-6.1
insured_last_name in1-16.1
insured_first_name in1-16.2
insured_relation_to_pt in1-17.1
insured_dob in1-18.1
insured_address_street in1-19.1
insured_address_city in1-19.3
insured_address_state_prov in1-19.4
insured_address_zip_post in1-19.5
insured_address_country in1-19.6
insured_address_county_parish in1-19.9
coord_ben_priority in1-22.1
report_eligibility_flag_id in1-25.1
pt_insurance_plan_id in1-2.1
pt_insurance_plan_id_text in1-2.2
insurance_company_plan_code in1-35.1
insurance_policy_number in1-36.1
pt_insurance_company_id in1-3.1
pt_insurance_co_id_check_digit in1-3.2
insured_employeement_status in1-42.1
insured_gender in1-43.1
insured_coverage_type in1-47.1
pt_insurance_company_name in1-4.1
pt_insurance_company_add_street in1-5.1
pt_insurance_company_add_city in1-5.3
pt_insurance_company_add_state_prov in1-5.4
pt_insurance_company_add_zip_postal in1-5.5
pt_insurance_company_add_phone_num in1-7.1
pt_insurance_group_num in1-8.1
pt_insurance_group_name in1-9.1
insured_ssn in2-2.1
insured_mail_claim_party in2-5.1
pt_insurance_member_number in2-61.1
insured_phone_number_1 in2-63.1
insured_employer_phone_number_1 in2-64.1
medicare_card_number in2-6.1
insured_employer_org_name_1 in2-70.1
clinical_observation_result_status_id obx-11.1
clinical_observation_type_id obx-2.1
clinical_observation_identifier obx-3.1
clinical_observation_sub_identifier obx-4.1
clinical_observation_value obx-5.1
pt_ad_code_identifier pd1-15.1
pt_ad_code_text pd1-15.2
pt_primary_facility_name pd1-3.1
pt_primary_facility_id pd1-3.3
pt_pcp_id_type_code pd1-4.13
pt_pcp_id_num pd1-4.1
pt_pcp_last_name pd1-4.2
pt_pcp_first_name pd1-4.3
pt_pcp_assign_auth pd1-4.9
pt_race_identifier pid-10.1
pt_race_text pid-10.2
pt_address_effect_date pid-11.13
pt_address_st_1 pid-11.1
pt_address_city pid-11.3
pt_address_state_prov pid-11.4
pt_address_zip_postal pid-11.5
pt_address_country pid-11.6
pt_address_type pid-11.7
pt_county_parish pid-11.9
pt_contact_phone_number_1 pid-13.1
pt_email pid-13.4
pt_notes_1 pid-13.9
pt_business_phone_number_2 pid-14.1
pt_primary_lang_identifier pid-15.1
pt_primary_lang_text pid-15.2
pt_marital_status pid-16.1
pt_religion pid-17.1
pt_account_number_1 pid-18.1
pt_ssn pid-19.1
pt_ethnicity_identifier pid-22.1
pt_ethnicity_text pid-22.2
pt_veterans_military_status pid-27.1
pt_nationality pid-28.1
pt_death_date_time pid-29.1
pt_id_4 pid-2.1
pt_death_indicator pid-30.1
pt_id_3 pid-4.1
pt_last_name pid-5.1
pt_first_name pid-5.2
pt_name_prefix pid-5.5
pt_dob pid-7.1
pt_gender pid-8.1
pt_last_name_alias pid-9.1
pt_first_name_alias pid-9.2
pt_hospital_service pv1-10.1
pt_temp_loc_facility pv1-11.4
pt_admit_source_1 pv1-14.1
pt_admitting_doc_name_type_code pv1-17.10
pt_admitting_doc_chk_digit_scheme_1 pv1-17.12
pt_admitting_doc_id_num pv1-17.1
pt_admitting_doc_last_name pv1-17.2
pt_type pv1-18.1
pt_visit_number pv1-19.1
pt_fin_class pv1-20.1
pt_class pv1-2.1
pt_discharge_disp pv1-36.1
pt_discharge_loc pv1-37.1
pt_loc_assign_auth_for_loc pv1-3.11
pt_loc_poc_1 pv1-3.1
pt_loc_room_1 pv1-3.2
pt_loc_bed_1 pv1-3.3
pt_loc_facility_1 pv1-3.4
pt_assigned_loc_status_1 pv1-3.5
pt_assigned_loc_person_loc_type pv1-3.6
pt_loc_description pv1-3.9
pt_account_status_1 pv1-41.1
pt_admit_date_1 pv1-44.1
pt_discharge_date_time pv1-45.1
pt_total_charges pv1-47.1
pt_addmission_type pv1-4.1
pt_alt_visid_id_num pv1-50.1
provider_suffix pv1-52.5
pt_prior_loc_poc_1 pv1-6.1
pt_prior_loc_room_1 pv1-6.2
pt_prior_loc_bed_1 pv1-6.3
pt_prior_facil_loc pv1-6.4
pt_prior_loc_person_loc_building pv1-6.7
pt_attending_doc_id_type_code pv1-7.13
pt_attending_doc_id_num pv1-7.1
pt_attending_doc_last_name pv1-7.2
pt_attending_doc_first_name pv1-7.3
pt_attending_doc_assign_auth pv1-7.9
pt_referring_doc_id_type_code pv1-8.13
pt_referring_doc_id_num pv1-8.1
pt_referring_doc_last_name pv1-8.2
pt_referring_doc_first_name pv1-8.3
pt_referring_doc_assign_auth pv1-8.9
pt_est_length_inpatient_stay pv2-10.1
pt_visit_description pv2-12.1
pt_visit_publicity_code pv2-21.1
pt_protection_indicator_id pv2-22.1
pt_accomodation_code_id pv2-2.1
pt_billing_media_code_id pv2-32.1
pt_visit_arrival_mode pv2-38.1
pt_admission_level_of_care_id pv2-40.1
pt_expected_admit_date pv2-8.1
pt_expected_discharge_date_time pv2-9.1
pt_discharge_reason_other zpv-15.1
zpv_phone_number_1 zpv-39.1
""".split("\n"):
    if _line:
        _name, _place = _line.split()
        PLACES[_name] = _place

# Segment fields that are ignored whole.
IGNORED_FIELDS = (
    "al1_1", "dg1_1", "evn_1", "gt1_1", "in1_1", "obx_1", "pid_1", "pid_12", "pv1_1",
)

# Components that are ignored: by the type of their field, or by name.
IGNORED_PLACES = (
    "evn_1_1", "evn_5_4", "gt1_16_3", "gt1_18_2", "gt1_18_3", "gt1_18_5", "gt1_18_6", "gt1_18_7", "gt1_2_4",
    "gt1_2_5", "gt1_3_3", "gt1_46_2", "gt1_46_3", "gt1_46_5", "gt1_46_6", "gt1_46_7", "gt1_4_3", "gt1_6_2",
    "gt1_6_3", "gt1_6_5", "gt1_6_6", "gt1_6_7", "gt1_7_2", "gt1_7_3", "gt1_7_5", "gt1_7_6", "gt1_7_7", "in1_16_3",
    "in1_3_4", "in1_3_5", "in1_6_3", "in1_7_2", "in1_7_3", "in1_7_5", "in1_7_6", "in1_7_7", "in2_61_4",
    "in2_61_5", "in2_63_2", "in2_63_3", "in2_63_5", "in2_63_6", "in2_63_7", "in2_64_2", "in2_64_3", "in2_64_5",
    "in2_64_6", "in2_64_7", "pd1_4_4", "pid_13_2", "pid_13_3", "pid_13_5", "pid_13_6", "pid_13_7", "pid_14_2",
    "pid_14_3", "pid_14_5", "pid_14_6", "pid_14_7", "pid_18_4", "pid_18_5", "pid_1_1", "pid_21_4", "pid_21_5",
    "pid_2_4", "pid_2_5", "pid_3_1", "pid_3_4", "pid_3_5", "pid_4_4", "pid_4_5", "pid_5_3", "pid_6_3", "pid_9_3",
    "pv1_17_4", "pv1_19_4", "pv1_19_5", "pv1_3_7", "pv1_50_4", "pv1_50_5", "pv1_52_4", "pv1_7_4", "pv1_8_4",
    "pv1_9_4",
)

# Repetitions that have a name in numbered mode, for places with a numbered name.
NUMBERED = {
    "al1_2_1": [1, 2, 3], "al1_5_1": [1, 2], "dg1_3_3": [1], "evn_2_1": [1, 2], "evn_5_1": [1, 2], "pid_13_1": [1,
    2], "pid_13_9": [1, 2, 3], "pid_18_1": [1, 2], "pid_3_1": [2, 3],
}
