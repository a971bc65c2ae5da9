"""Small frames with the input schemas of the four extracts."""

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from loomfeed.plans.claim_headers import ClaimHeaderInputs
from loomfeed.plans.claim_lines import ClaimLineInputs
from loomfeed.plans.config import RunConfig
from loomfeed.plans.eligibility import EligibilityInputs
from loomfeed.plans.labs import LabInputs

TYPES = {"s": "string", "i": "int", "l": "bigint", "t": "timestamp_ntz", "d": "date", "m": "decimal(18,2)"}

HEADER = """claim_header_sk l, tenant_sk i, source_system_sk s, source_patient_id s, contract_number s,
pbp s, health_plan_standard_value s, health_plan_card_id s, claim_number s, claim_status_cd s,
claim_type_cd s, claim_adjust_type s, orig_claim_nbr s, adm_dt t, disch_dt t, serv_from_dt t,
serv_thru_dt t, service_dt t, bill_type s, inpatient_flg s, drg_code s, cms_pos s,
source_rend_prov_npi s, source_refr_prov_npi s, referral_num s, pay_to_prov_tin s,
rend_prov_cms_spec_cd s, rend_prov_cms_spec_desc s, admit_type s, admit_src s, disch_status s,
statistical_ind i, e_code_1 s, e_code_2 s, e_code_3 s, rendering_prov_sk l, refr_prov_sk l,
provider_group_sk s, final_status_flg s, aud_upd_dt t, del_ind i"""
DETAIL = """claim_detail_sk l, claim_header_sk l, tenant_sk i, source_system_sk s, claim_number s,
claim_line i, ub_rev_code s, cms_pos s, procedure_code s, procedure_code_sk l, mod_1 s, mod_2 s,
mod_3 s, mod_4 s, er_flg s, ndc_code s, hospital_flg s, outside_lab_flg s, statistical_ind s,
chg_amt m, allowed_amt m, pmt_amt m, approved_units s, serv_from_dt t, serv_thru_dt t, billed_dt t,
processed_dt t, paid_dt t, aud_upd_dt t, del_ind i"""
DIAGNOSIS = "claim_header_sk l, admit_diag_cd s, del_ind i, " + ", ".join(
    f"icd_diag_cd_{n} s, diag_code_{n}_poa s" for n in range(1, 35)
)
PROCEDURES = "claim_header_sk l, del_ind i, " + ", ".join(f"icd_proc_{n} s" for n in range(1, 7))
ELIGIBILITY = """eligibility_sk l, tenant_sk i, source_system_sk s, source_patient_id s,
health_plan_card_id s, enrollment_pcp_id s, provider_group_id s, provider_group_sk s, pod_id s,
record_start_dt t, record_end_dt t, health_plan_standard_value s, benefit_plan_desc s,
benefit_plan_effective_dt t, benefit_plan_term_dt t, contract_number s, plan_benefit_package s,
business_type s, line_of_business s, primary_coverage_flg s, aud_upd_dt t, del_ind i"""
LAB = """lab_result_sk l, tenant_sk i, source_system_sk s, patient_sk l, lab_order_id s,
lab_order_desc s, lab_order_perf_dt t, lab_result_value_raw s, lab_result_value_uom s,
result_ref_range s, result_status s, result_comment s, lab_order_test_name s, lab_orderable_cd s,
loinc_cd s, cpt_cd s, accession_number s, order_request_dt t, lab_ordered_dt t,
observation_request_dt t, specimen_source_desc s, abnormal_status_cd s, abnormal_test_nature s,
lab_result_sequence i, aud_upd_dt t, del_ind i"""
PATIENT = """patient_sk l, source_patient_id s, first_name s, middle_name s, last_name s,
birth_date d, hicn_mbi s, del_ind i"""
RULES = """source_attribute s, source_systems s, attribute s, operator s, match_value s,
default_value s, priority i"""

NOW = datetime(2024, 6, 10, 5)
CONFIG = RunConfig(
    market="ny",
    tenants=(1,),
    as_of=date(2024, 6, 10),
    project="MAIN",
    system="FEED",
    status_set="STATUS",
    file_prefix="NYFILE",
)


def frame(spark, schema, rows):
    fields = [f.split() for f in schema.replace("\n", " ").split(",")]
    ddl = ", ".join(f"{name} {TYPES[kind]}" for name, kind in fields)
    data = [tuple({"del_ind": 0, **row}.get(name) for name, _ in fields) for row in rows]
    return spark.createDataFrame(data, ddl)


def day(text):
    return datetime.fromisoformat(text)


def header(sk, **values):
    base = {
        "claim_header_sk": sk,
        "tenant_sk": 1,
        "source_system_sk": "20",
        "source_patient_id": "P1",
        "claim_number": f"C{sk}",
        "claim_status_cd": "1",
        "claim_adjust_type": "ORIGINAL",
        "serv_from_dt": day("2024-05-01"),
        "aud_upd_dt": day("2024-05-02"),
    }
    return {**base, **values}


def detail(sk, header_sk, line, **values):
    base = {
        "claim_detail_sk": sk,
        "claim_header_sk": header_sk,
        "tenant_sk": 1,
        "source_system_sk": "20",
        "claim_number": f"C{header_sk}",
        "claim_line": line,
        "chg_amt": Decimal(10),
        "serv_from_dt": day("2024-05-01"),
        "aud_upd_dt": day("2024-05-02"),
    }
    return {**base, **values}


def shared(spark):
    systems = [
        {"source_system_sk": "20", "source_system_abbr": "TWENTY", "source_system_name": "Twenty"},
        {"source_system_sk": "30", "source_system_abbr": "DEAD", "source_system_name": "Dead", "del_ind": 1},
    ]
    members = [
        {"source_patient_id": "P1", "tenant_sk": 1, "projectabbr": "MAIN", "lasteligenddate": day("2024-12-31")},
        {"source_patient_id": "P1", "tenant_sk": 1, "projectabbr": "MAIN", "lasteligenddate": day("2024-06-30")},
        {"source_patient_id": "P2", "tenant_sk": 1, "projectabbr": "MAIN", "lasteligenddate": day("2024-04-30")},
        {"source_patient_id": "P3", "tenant_sk": 1, "projectabbr": "OTHER", "lasteligenddate": day("2024-12-31")},
    ]
    return {
        "source_system": frame(
            spark, "source_system_sk s, source_system_abbr s, source_system_name s, del_ind i", systems
        ),
        "cohort": frame(
            spark, "source_patient_id s, tenant_sk i, projectabbr s, lasteligenddate t, del_ind i", members
        ),
        "rules": frame(spark, RULES, []),
    }


def line_inputs(spark, headers, details, procedures=()):
    return ClaimLineInputs(
        claim_detail=frame(spark, DETAIL, details),
        claim_header=frame(spark, HEADER, headers),
        claim_procedure=frame(spark, "claim_procedure_sk l, aud_upd_dt t, del_ind i", procedures),
        **shared(spark),
    )


def header_inputs(spark, headers, details, diagnoses=()):
    groups = "provider_group_sk s, provider_group_id s, revised_provider_group_id s, del_ind i"
    return ClaimHeaderInputs(
        claim_header=frame(spark, HEADER, headers),
        claim_detail=frame(spark, DETAIL, details),
        diagnosis_pivot=frame(spark, DIAGNOSIS, diagnoses),
        procedure_pivot=frame(spark, PROCEDURES, []),
        code_value_map=frame(
            spark,
            "std_cd_val s, target_cd_val s, sys_of_ctrl_name s, target_cd_set_name s",
            [{"std_cd_val": "1", "target_cd_val": "Paid", "sys_of_ctrl_name": "FEED", "target_cd_set_name": "STATUS"}],
        ),
        provider=frame(spark, "provider_sk l, provider_id s", [{"provider_sk": 5, "provider_id": " N5 "}]),
        provider_group=frame(
            spark, groups, [{"provider_group_sk": "7", "provider_group_id": "G7"}]
        ).drop("revised_provider_group_id"),
        provider_group_xwalk=frame(
            spark, groups, [{"provider_group_sk": "7", "revised_provider_group_id": "R7"}]
        ).drop("provider_group_id"),
        **shared(spark),
    )


def span(sk, **values):
    base = {
        "eligibility_sk": sk,
        "tenant_sk": 1,
        "source_system_sk": "20",
        "source_patient_id": "P1",
        "pod_id": "POD",
        "provider_group_sk": "7",
        "record_start_dt": day("2024-01-01"),
        "line_of_business": "hmo",
        "aud_upd_dt": day("2024-05-02"),
    }
    return {**base, **values}


def eligibility_inputs(spark, spans, **values):
    groups = "provider_group_sk s, provider_group_id s, revised_provider_group_id s, del_ind i"
    return EligibilityInputs(
        eligibility=frame(spark, ELIGIBILITY, spans),
        provider_group=frame(spark, groups, [{"provider_group_sk": "7", "provider_group_id": "G7"}]),
        provider_group_xwalk=frame(
            spark, groups, [{"provider_group_sk": "7", "revised_provider_group_id": "R7"}]
        ),
        pod_xwalk=frame(spark, "source_pod_id s, del_ind i", [{"source_pod_id": "POD"}]),
        business_type_xwalk=frame(spark, "standard_value s, active_flag i, source s", []),
        business_source="FEED",
        location=F.lit("LOC"),
        benefit_plan_key=F.lit("KEY"),
        pod=F.col("source_pod_id"),
        **{**shared(spark), **values},
    )


def lab(sk, **values):
    base = {
        "lab_result_sk": sk,
        "tenant_sk": 1,
        "source_system_sk": "20",
        "patient_sk": 1,
        "lab_order_id": "O1",
        "lab_order_desc": "panel",
        "lab_order_perf_dt": day("2024-05-01 08:30:00"),
        "lab_result_value_raw": "5",
        "loinc_cd": "1-2",
        "aud_upd_dt": day("2024-05-02"),
        "lab_result_sequence": 1,
    }
    return {**base, **values}


def lab_inputs(spark, results):
    people = [
        {"patient_sk": 1, "source_patient_id": "P1", "first_name": "tA", "middle_name": "tB", "last_name": "tL", "hicn_mbi": "tH"},
        {"patient_sk": 2, "source_patient_id": "P2", "first_name": "tA", "last_name": "tL", "hicn_mbi": "tH"},
    ]
    vault = [("tA", " Ann "), ("tB", "  "), ("tL", "Lee"), ("tH", "1EG4")]
    return LabInputs(
        lab_result=frame(spark, LAB, results),
        patient=frame(spark, PATIENT, people),
        vault=spark.createDataFrame(vault, "token string, value string"),
        **shared(spark),
    )
