"""Column names and order of the four extracts.

Fixed values: receivers read these files by column name.
"""

ELIGIBILITY = """
Source_System SOURCE_SYSTEM_SK TENANT_SK Entity_Member_Id HP_MEMBER_ID Provider_Id
Provider_Group_Id Location_Id Eligibility_Pod_Id Record_Start_Dt Record_End_Dt Health_Plan
BENEFIT_PLAN_KEY Benefit_Plan_Desc Contract PBP Business_Type Business_Line
Benefit_Plan_Eff_Date Benefit_Plan_Term_Date
""".split()

LAB_RESULT = """
SOURCE_SYSTEM TENANT_SK SOURCE_SYSTEM_SK CONTRACT PBP ENTITY_MEMBER_ID PATIENT_NAME
PATIENT_BIRTH_DATE PATIENT_MBI_OR_HICN LAB_ORDER_NUMBER LAB_RESULT_NAME
LAB_RESULT_OBSERVATION_DATE LAB_RESULT_OBSERVATION_TIME LAB_RESULT_VALUE
LAB_RESULT_UNIT_OF_MEASURE LAB_RESULT_REFERENCE_RANGE LAB_RESULT_OBSERVE_STATUS
LAB_RESULT_COMMENT LAB_RESULT_TEST_NAME LAB_RESULT_TYPE LAB_RESULT_LOINC_CODE
LAB_RESULT_CPT_CODE LAB_RESULT_FILLER_ORDER_NUMBER LAB_RESULT_REQUESTED_DATE_TIME
LAB_RESULT_ORDERED_DATE_TIME LAB_RESULT_OBSERVATION_REQUEST_TIME
LAB_RESULT_OBSERVE_REQUEST_RESULT_STATUS LAB_RESULT_SPECIMEN_SOURCE LAB_RESULT_ABNORMAL_FLAG
LAB_RESULT_NATURE_OF_ABNORMAL_TEST
""".split()

LAB_STATE = [
    "TENANT_SK",
    "SOURCE_SYSTEM_SK",
    "LAB_RESULT_SK",
    "SOURCE_SYSTEM",
    "CONTRACT",
    "PBP",
    "ENTITY_MEMBER_ID",
    "FIRST_NAME",
    "MIDDLE_NAME",
    "LAST_NAME",
    *LAB_RESULT[LAB_RESULT.index("PATIENT_BIRTH_DATE") :],
]

LAB_KEY = """
TENANT_SK SOURCE_SYSTEM_SK ENTITY_MEMBER_ID LAB_ORDER_NUMBER LAB_RESULT_NAME
LAB_RESULT_OBSERVATION_DATE LAB_RESULT_TEST_NAME LAB_RESULT_LOINC_CODE
""".split()

CLAIM_LINE_VALUES = """
SOURCE_SYSTEM CLAIM_NUMBER SERVICE_LINE REVENUE_CODE FACILITY_TYPE_CODE PROCEDURE_CODE
MODIFIER_1 MODIFIER_2 MODIFIER_3 MODIFIER_4 EMERGENCY_FLAG NDC_CODE HOSPITAL_RELATED_FLAG
OUTSIDE_LABS_FLAG CAPPED_INDICATOR PAID_AMOUNT BILLED_AMOUNT ALLOWED_AMOUNT UNIT_COUNT
SERVICE_FROM_DATE SERVICE_TO_DATE BILLED_DATE PROCESSED_DATE PAID_DATE
""".split()

CLAIM_LINE_STATE = [
    *CLAIM_LINE_VALUES,
    "CLAIM_DETAIL_SK",
    "TENANT_SK",
    "SOURCE_SYSTEM_SK",
    "CLAIM_HEADER_SK",
    "DEL_IND",
]

CLAIM_LINE = ["TENANT_SK", "SOURCE_SYSTEM_SK", *CLAIM_LINE_VALUES]

# Claim numbers of some sources carry no prefix, so tenants and sources may share one.
CLAIM_LINE_KEY = ["TENANT_SK", "SOURCE_SYSTEM_SK", "CLAIM_NUMBER", "SERVICE_LINE"]

DIAGNOSIS_SLOTS = 34
PROCEDURE_SLOTS = 6

CLAIM_HEADER = """
Tenant_sk Source_System_sk Source_System Contract Pbp Entity_Member_Id Health_Plan Hp_Member_Id
Claim_Number Claim_Status Claim_Type Claim_Adjust_Type Orig_Claim_Number Admit_Date
Discharge_Date Statement_From_Date Statement_To_Date Bill_Type Inpatient_Flag Drg_Code
Icd_Diag_Admit
""".split()
for _slot in range(1, DIAGNOSIS_SLOTS + 1):
    CLAIM_HEADER += [f"Icd_Diag_{_slot}", f"Diag_Code_{_slot}_Poa"]
CLAIM_HEADER += """
Facility_Type Charge_Amount Rendering_Provider_Npi Referring_Provider_Npi Referral_Number
Rendering_Provider_Id Referring_Provider_Id Payto_Provider_Tin Rendering_Provider_Group_Id
Specialty_Code Specialty_Name Authorization_Number Type_Of_Admit Admit_Source Discharge_Status
Capped_Indicator Icd_Proc_1 Icd_Proc_2 Icd_Proc_3 Icd_Proc_4 Icd_Proc_5 Icd_Proc_6 E_Code_1
E_Code_2 E_Code_3 Icd_Code_Type
""".split()

CLAIM_HEADER_STATE = [
    *[name.upper() for name in CLAIM_HEADER],
    "SOURCE_PATIENT_ID",
    "UPDATE_TYPE",
    "SERV_FROM_DT",
    "DEL_IND",
]

# Kept in the state beside its columns: what tells the newest of several rows for one claim.
CLAIM_HEADER_NEWEST = ["AUD_UPD_DT", "CLAIM_HEADER_SK"]

CLAIM_HEADER_KEY = ["TENANT_SK", "SOURCE_SYSTEM", "CLAIM_NUMBER"]
