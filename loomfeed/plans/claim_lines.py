"""Claim lines: normalised lines of cohort members, merged into the current state."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes, dates, text
from ..functions.fingerprint import row_fingerprint
from ..operators.changes import upsert_by_fingerprint
from ..operators.joins import in_scope, last_eligible, lookup, near_keys
from ..operators.rules import apply_default_rules
from ..operators.shape import final_rows, project, scope_filter
from . import layouts
from .config import RunConfig


@dataclass(frozen=True)
class ClaimLineInputs:
    claim_detail: DataFrame
    claim_header: DataFrame
    claim_procedure: DataFrame
    source_system: DataFrame
    cohort: DataFrame
    rules: DataFrame


def cohort_members(config: RunConfig, cohort: DataFrame) -> DataFrame:
    """Live cohort rows of the project, one per patient and tenant."""
    wanted = (F.col("del_ind") == 0) & (F.col("projectabbr") == config.project)
    return last_eligible(cohort, ["source_patient_id", "tenant_sk"], "lasteligenddate", wanted)


def recent_headers(config: RunConfig, claim_header: DataFrame) -> DataFrame:
    """Final claims in the lookback."""
    return final_rows(claim_header).filter(
        dates.within_lookback("serv_from_dt", config.lookback_months, config.as_of)
    )


def scoped_headers(config: RunConfig, inputs: ClaimLineInputs) -> DataFrame:
    """Final claims in the lookback that started while the patient was in the cohort.

    The cohort test needs header columns only, so it is done on the narrow header rows and the
    lines meet its result in the join they need anyway. ``cohort_tenant`` remains to be compared
    with the line's tenant.
    """
    headers = recent_headers(config, inputs.claim_header)
    return in_scope(
        headers.select("claim_header_sk", "source_patient_id", "serv_from_dt", "aud_upd_dt"),
        cohort_members(config, inputs.cohort).withColumnRenamed("tenant_sk", "cohort_tenant"),
        [("source_patient_id", "source_patient_id")],
        until=("serv_from_dt", "lasteligenddate"),
        take={"cohort_tenant": "cohort_tenant"},
    )


def claim_line_source(config: RunConfig, inputs: ClaimLineInputs) -> DataFrame:
    """Lines of in-scope claims that were touched in the lookback, directly or through their
    header or procedure.

    Lines of claims out of the lookback go first, by the claim's key alone, so that the joins move
    few of these wide rows.
    """
    window = (config.lookback_months, config.as_of)
    lines = near_keys(
        inputs.claim_detail, recent_headers(config, inputs.claim_header), "claim_header_sk"
    )
    lines = scope_filter(lines, config.tenants, config.sources).filter(
        F.col("serv_from_dt").isNotNull()
    )
    lines = lookup(
        lines,
        inputs.source_system,
        [("source_system_sk", "source_system_sk")],
        {"source_system": "source_system_abbr"},
        how="inner",
        where=F.col("del_ind") == 0,
    )
    lines = lookup(
        lines,
        scoped_headers(config, inputs),
        [("claim_header_sk", "claim_header_sk"), ("tenant_sk", "cohort_tenant")],
        {"header_upd_dt": "aud_upd_dt"},
        how="inner",
        spread_by=["claim_detail_sk"],
        salts=config.salts,
    )
    # Only a recently updated procedure can bring in a line that is not recent by itself, so the
    # join is limited to those on both sides.
    touched = F.coalesce(
        dates.any_within_lookback(["aud_upd_dt", "header_upd_dt"], *window), F.lit(False)
    )
    recent = (F.col("del_ind") == 0) & dates.within_lookback("aud_upd_dt", *window)
    procedures = inputs.claim_procedure.filter(recent).select("claim_procedure_sk").distinct()
    lines = lookup(
        lines,
        procedures,
        [("procedure_code_sk", "claim_procedure_sk")],
        {"procedure_touched": F.lit(True)},
        left_where=~touched,
        spread_by=["claim_detail_sk"],
    )
    lines = lines.filter(touched | F.col("procedure_touched").isNotNull())
    return project(lines, _columns(config))


def _columns(config: RunConfig) -> dict[str, Column | str]:
    def money(name: str) -> Column | str:
        return text.null_if_longer(name, 13) if config.extended else F.col(name)

    billed = money("chg_amt")
    if not config.extended:
        billed = codes.typed_default("chg_amt", "0.00", "decimal(18,2)")
    return {
        "SOURCE_SYSTEM": "source_system",
        "CLAIM_NUMBER": codes.composite_key("source_system_sk", "claim_number"),
        "SERVICE_LINE": "claim_line",
        "REVENUE_CODE": codes.pad_code("ub_rev_code"),
        "FACILITY_TYPE_CODE": "cms_pos",
        "PROCEDURE_CODE": "procedure_code",
        **{f"MODIFIER_{n}": f"mod_{n}" for n in range(1, 5)},
        "EMERGENCY_FLAG": codes.yn_flag("er_flg"),
        "NDC_CODE": "ndc_code",
        "HOSPITAL_RELATED_FLAG": codes.yn_flag("hospital_flg"),
        "OUTSIDE_LABS_FLAG": codes.yn_flag("outside_lab_flg"),
        "CAPPED_INDICATOR": codes.one_flag("statistical_ind"),
        "PAID_AMOUNT": money("pmt_amt"),
        "BILLED_AMOUNT": billed,
        "ALLOWED_AMOUNT": money("allowed_amt"),
        "UNIT_COUNT": F.coalesce("approved_units", F.lit("0")),
        "SERVICE_FROM_DATE": dates.floor_date("serv_from_dt"),
        "SERVICE_TO_DATE": dates.floor_date("serv_thru_dt", "null"),
        "BILLED_DATE": dates.floor_date("billed_dt", "null"),
        "PROCESSED_DATE": dates.floor_date("processed_dt", "null"),
        "PAID_DATE": dates.floor_date("paid_dt", "null"),
        "DEL_IND": "del_ind",
        "CLAIM_DETAIL_SK": "claim_detail_sk",
        "TENANT_SK": "tenant_sk",
        "SOURCE_SYSTEM_SK": "source_system_sk",
        "CLAIM_HEADER_SK": "claim_header_sk",
    }


def claim_line_current(config: RunConfig, inputs: ClaimLineInputs) -> DataFrame:
    source = claim_line_source(config, inputs).select(*layouts.CLAIM_LINE_STATE)
    defaulted = apply_default_rules(source, inputs.rules)
    return row_fingerprint(defaulted, exclude=["CLAIM_HEADER_SK"])


def claim_line_state(
    config: RunConfig, inputs: ClaimLineInputs, previous: DataFrame, pending: bool = False
) -> DataFrame:
    """New current state with ``_change_type``; of several rows for one claim line the newest
    surrogate counts. ``pending`` keeps the changes of a ``previous`` that was not published."""
    current = claim_line_current(config, inputs)
    return upsert_by_fingerprint(
        previous, current, layouts.CLAIM_LINE_KEY, order=newest(), pending=pending
    )


def newest() -> list[Column]:
    """Which of several rows for one claim line counts."""
    return [F.col("CLAIM_DETAIL_SK").desc_nulls_first(), F.col("HASH")]
