"""Raw names that are dropped before renaming, one per line.

Fixed values: they must equal the names that the feed's parser produces and the
job ignores, in the order in which they are configured.  Names that end in a
repetition number apply in numbered mode only.
"""

IGNORE_NAMES = """
al1_1_set_id_al1_si_none_1
evn_1_event_type_code_id_none
evn_5_operator_id_xcn_2_family_name_2
evn_5_operator_id_xcn_3_given_name_2
evn_5_operator_id_xcn_9_assigning_authority_1
gt1_10_guarantor_type_is_none_1
gt1_11_guarantor_relationship_ce_1_identifier_1
gt1_12_guarantor_ssn_st_none_1
gt1_16_guarantor_employer_name_xpn_1_family_name_1
gt1_17_guarantor_employer_address_xad_1_street_address_1
gt1_17_guarantor_employer_address_xad_3_city_1
gt1_17_guarantor_employer_address_xad_4_state_or_province_1
gt1_17_guarantor_employer_address_xad_5_zip_or_postal_code_1
gt1_17_guarantor_employer_address_xad_6_country_1
gt1_18_guarantor_employer_phone_number_xtn_1_telephone_number_1
gt1_20_guarantor_employment_status_is_none_1
gt1_23_guarantor_credit_rating_code_ce_1_identifier_1
gt1_2_guarantor_number_cx_1_id_number_1
gt1_3_guarantor_name_xpn_4_suffix_e_g_jr_or_iii_1
gt1_3_guarantor_name_xpn_5_prefix_e_g_dr_1
gt1_3_guarantor_name_xpn_7_name_type_code_1
gt1_4_guarantor_spouse_name_xpn_1_family_name_1
gt1_4_guarantor_spouse_name_xpn_2_given_name_1
gt1_5_guarantor_address_xad_1_street_address_1
gt1_5_guarantor_address_xad_2_other_designation_1
gt1_5_guarantor_address_xad_3_city_1
gt1_5_guarantor_address_xad_4_state_or_province_1
gt1_5_guarantor_address_xad_5_zip_or_postal_code_1
gt1_5_guarantor_address_xad_6_country_1
gt1_5_guarantor_address_xad_9_county_parish_code_1
gt1_6_guarantor_ph_num_home_xtn_12_unformatted_telephone_number_1
gt1_7_guarantor_ph_num_business_xtn_1_telephone_number_1
gt1_8_guarantor_date_time_of_birth_ts_1_time_1
gt1_9_guarantor_administrative_sex_is_none_1
in1_16_name_of_insured_xpn_4_suffix_e_g_jr_or_iii_1
in1_19_insured_s_address_xad_2_other_designation_1
in1_44_insured_s_employer_s_address_xad_1_street_address_1
in1_44_insured_s_employer_s_address_xad_3_city_1
in1_44_insured_s_employer_s_address_xad_4_state_or_province_1
in1_44_insured_s_employer_s_address_xad_5_zip_or_postal_code_1
in1_44_insured_s_employer_s_address_xad_6_country_1
in1_5_insurance_company_address_xad_2_other_designation_1
in1_5_insurance_company_address_xad_6_country_1
in1_6_insurance_co_contact_person_xpn_1_family_name_1
in1_6_insurance_co_contact_person_xpn_2_given_name_1
in2_63_insured_s_phone_number_home_xtn_12_unformatted_telephone_number_1
none_none_varies_1_none_1
obx_1_set_id_obx_si_none_1
pid_10_race_ce_1_identifier_2
pid_11_patient_address_xad_1_street_address_2
pid_11_patient_address_xad_2_other_designation_1
pid_11_patient_address_xad_3_city_2
pid_11_patient_address_xad_4_state_or_province_2
pid_11_patient_address_xad_5_zip_or_postal_code_2
pid_11_patient_address_xad_6_country_2
pid_11_patient_address_xad_7_address_type_2
pid_11_patient_address_xad_9_county_parish_code_2
pid_11_patient_address_xad_9_county_parish_code_2
pid_13_phone_number_home_xtn_1_telephone_number_3
pid_14_phone_number_business_xtn_1_telephone_number_2
pid_14_phone_number_business_xtn_8_extension_1
pid_16_marital_status_ce_1_identifier_2
pid_16_marital_status_ce_1_identifier_2
pid_18_patient_account_number_cx_1_id_number_2
pid_19_ssn_number_patient_st_none_2
pid_1_set_id_pid_si_none
pid_21_mother_s_identifier_cx_1_id_number_1
pid_21_mother_s_identifier_cx_2_check_digit_1
pid_21_mother_s_identifier_cx_3_check_digit_scheme_1
pid_23_birth_place_st_none_1
pid_23_birth_place_st_none_2
pid_23_birth_place_st_none_3
pid_23_birth_place_st_none_4
pid_23_birth_place_st_none_5
pid_23_birth_place_st_none_6
pid_24_multiple_birth_indicator_id_none_1
pid_25_birth_order_nm_none_1
pid_2_patient_id_cx_1_id_number_2
pid_3_patient_identifier_list_cx_1_id_number
pid_5_patient_name_xpn_1_family_name_2
pid_5_patient_name_xpn_2_given_name_2
pid_5_patient_name_xpn_4_suffix_e_g_jr_or_iii_1
pid_5_patient_name_xpn_7_name_type_code_1
pid_5_patient_name_xpn_7_name_type_code_2
pid_6_mother_s_maiden_name_xpn_1_family_name_1
pid_7_date_time_of_birth_ts_1_time_2
pid_8_administrative_sex_is_none_2
pid_9_patient_alias_xpn_1_family_name_10
pid_9_patient_alias_xpn_1_family_name_2
pid_9_patient_alias_xpn_1_family_name_2
pid_9_patient_alias_xpn_1_family_name_3
pid_9_patient_alias_xpn_1_family_name_3
pid_9_patient_alias_xpn_1_family_name_4
pid_9_patient_alias_xpn_1_family_name_5
pid_9_patient_alias_xpn_1_family_name_6
pid_9_patient_alias_xpn_1_family_name_7
pid_9_patient_alias_xpn_1_family_name_8
pid_9_patient_alias_xpn_1_family_name_9
pid_9_patient_alias_xpn_2_given_name_10
pid_9_patient_alias_xpn_2_given_name_2
pid_9_patient_alias_xpn_2_given_name_2
pid_9_patient_alias_xpn_2_given_name_3
pid_9_patient_alias_xpn_2_given_name_3
pid_9_patient_alias_xpn_2_given_name_4
pid_9_patient_alias_xpn_2_given_name_5
pid_9_patient_alias_xpn_2_given_name_6
pid_9_patient_alias_xpn_2_given_name_7
pid_9_patient_alias_xpn_2_given_name_8
pid_9_patient_alias_xpn_2_given_name_9
pv1_11_temporary_location_pl_1_point_of_care_1
pv1_17_admitting_doctor_xcn_13_identifier_type_code_1
pv1_17_admitting_doctor_xcn_3_given_name_1
pv1_17_admitting_doctor_xcn_7_degree_e_g_md_1
pv1_17_admitting_doctor_xcn_9_assigning_authority_1
pv1_1_set_id_pv1_si_none_1
pv1_39_servicing_facility_is_none_1
pv1_3_assigned_patient_location_pl_7_building
pv1_7_attending_doctor_xcn_10_name_type_code_1
pv1_7_attending_doctor_xcn_13_identifier_type_code_2
pv1_7_attending_doctor_xcn_2_family_name_2
pv1_7_attending_doctor_xcn_3_given_name_2
pv1_7_attending_doctor_xcn_7_degree_e_g_md_1
pv1_7_attending_doctor_xcn_9_assigning_authority_2
pv1_9_consulting_doctor_xcn_13_identifier_type_code_1
pv1_9_consulting_doctor_xcn_13_identifier_type_code_10
pv1_9_consulting_doctor_xcn_13_identifier_type_code_11
pv1_9_consulting_doctor_xcn_13_identifier_type_code_12
pv1_9_consulting_doctor_xcn_13_identifier_type_code_13
pv1_9_consulting_doctor_xcn_13_identifier_type_code_14
pv1_9_consulting_doctor_xcn_13_identifier_type_code_15
pv1_9_consulting_doctor_xcn_13_identifier_type_code_16
pv1_9_consulting_doctor_xcn_13_identifier_type_code_17
pv1_9_consulting_doctor_xcn_13_identifier_type_code_18
pv1_9_consulting_doctor_xcn_13_identifier_type_code_19
pv1_9_consulting_doctor_xcn_13_identifier_type_code_2
pv1_9_consulting_doctor_xcn_13_identifier_type_code_20
pv1_9_consulting_doctor_xcn_13_identifier_type_code_21
pv1_9_consulting_doctor_xcn_13_identifier_type_code_3
pv1_9_consulting_doctor_xcn_13_identifier_type_code_4
pv1_9_consulting_doctor_xcn_13_identifier_type_code_5
pv1_9_consulting_doctor_xcn_13_identifier_type_code_6
pv1_9_consulting_doctor_xcn_1_id_number_1
pv1_9_consulting_doctor_xcn_1_id_number_10
pv1_9_consulting_doctor_xcn_1_id_number_11
pv1_9_consulting_doctor_xcn_1_id_number_12
pv1_9_consulting_doctor_xcn_1_id_number_13
pv1_9_consulting_doctor_xcn_1_id_number_14
pv1_9_consulting_doctor_xcn_1_id_number_15
pv1_9_consulting_doctor_xcn_1_id_number_16
pv1_9_consulting_doctor_xcn_1_id_number_17
pv1_9_consulting_doctor_xcn_1_id_number_18
pv1_9_consulting_doctor_xcn_1_id_number_19
pv1_9_consulting_doctor_xcn_1_id_number_2
pv1_9_consulting_doctor_xcn_1_id_number_20
pv1_9_consulting_doctor_xcn_1_id_number_21
pv1_9_consulting_doctor_xcn_1_id_number_3
pv1_9_consulting_doctor_xcn_1_id_number_4
pv1_9_consulting_doctor_xcn_1_id_number_5
pv1_9_consulting_doctor_xcn_1_id_number_6
pv1_9_consulting_doctor_xcn_2_family_name_1
pv1_9_consulting_doctor_xcn_2_family_name_10
pv1_9_consulting_doctor_xcn_2_family_name_11
pv1_9_consulting_doctor_xcn_2_family_name_12
pv1_9_consulting_doctor_xcn_2_family_name_13
pv1_9_consulting_doctor_xcn_2_family_name_14
pv1_9_consulting_doctor_xcn_2_family_name_15
pv1_9_consulting_doctor_xcn_2_family_name_16
pv1_9_consulting_doctor_xcn_2_family_name_17
pv1_9_consulting_doctor_xcn_2_family_name_18
pv1_9_consulting_doctor_xcn_2_family_name_19
pv1_9_consulting_doctor_xcn_2_family_name_2
pv1_9_consulting_doctor_xcn_2_family_name_20
pv1_9_consulting_doctor_xcn_2_family_name_21
pv1_9_consulting_doctor_xcn_2_family_name_3
pv1_9_consulting_doctor_xcn_2_family_name_4
pv1_9_consulting_doctor_xcn_2_family_name_5
pv1_9_consulting_doctor_xcn_2_family_name_6
pv1_9_consulting_doctor_xcn_3_given_name_1
pv1_9_consulting_doctor_xcn_3_given_name_10
pv1_9_consulting_doctor_xcn_3_given_name_11
pv1_9_consulting_doctor_xcn_3_given_name_12
pv1_9_consulting_doctor_xcn_3_given_name_13
pv1_9_consulting_doctor_xcn_3_given_name_14
pv1_9_consulting_doctor_xcn_3_given_name_15
pv1_9_consulting_doctor_xcn_3_given_name_16
pv1_9_consulting_doctor_xcn_3_given_name_17
pv1_9_consulting_doctor_xcn_3_given_name_18
pv1_9_consulting_doctor_xcn_3_given_name_19
pv1_9_consulting_doctor_xcn_3_given_name_2
pv1_9_consulting_doctor_xcn_3_given_name_20
pv1_9_consulting_doctor_xcn_3_given_name_21
pv1_9_consulting_doctor_xcn_3_given_name_3
pv1_9_consulting_doctor_xcn_3_given_name_4
pv1_9_consulting_doctor_xcn_3_given_name_5
pv1_9_consulting_doctor_xcn_3_given_name_6
pv1_9_consulting_doctor_xcn_9_assigning_authority_1
pv1_9_consulting_doctor_xcn_9_assigning_authority_10
pv1_9_consulting_doctor_xcn_9_assigning_authority_11
pv1_9_consulting_doctor_xcn_9_assigning_authority_12
pv1_9_consulting_doctor_xcn_9_assigning_authority_13
pv1_9_consulting_doctor_xcn_9_assigning_authority_14
pv1_9_consulting_doctor_xcn_9_assigning_authority_15
pv1_9_consulting_doctor_xcn_9_assigning_authority_16
pv1_9_consulting_doctor_xcn_9_assigning_authority_17
pv1_9_consulting_doctor_xcn_9_assigning_authority_18
pv1_9_consulting_doctor_xcn_9_assigning_authority_19
pv1_9_consulting_doctor_xcn_9_assigning_authority_2
pv1_9_consulting_doctor_xcn_9_assigning_authority_20
pv1_9_consulting_doctor_xcn_9_assigning_authority_21
pv1_9_consulting_doctor_xcn_9_assigning_authority_3
pv1_9_consulting_doctor_xcn_9_assigning_authority_4
pv1_9_consulting_doctor_xcn_9_assigning_authority_5
pv1_9_consulting_doctor_xcn_9_assigning_authority_6
zpv_11_none_st_none_1
zpv_12_none_st_none_1
zpv_13_none_st_none_1
zpv_39_none_st_none_2
zpv_39_none_st_none_3
zpv_39_none_st_none_4
zpv_39_none_st_none_5
zpv_39_none_st_none_6
zpv_39_none_st_none_7
zpv_5_none_st_none_1
zpv_5_none_st_none_2
zpv_5_none_st_none_3
zpv_5_none_st_none_4
zpv_5_none_st_none_5
zpv_5_none_st_none_6
zpv_5_none_st_none_7
zpv_6_none_st_none_1
""".split()
