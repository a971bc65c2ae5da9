"""Claim headers: merge, classification against line changes, and both claim extracts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes, dates, text
from ..functions.fingerprint import row_fingerprint
from ..operators.changes import (
    CHANGE,
    affected_keys,
    changed_rows,
    classify_changes,
    select_published,
    upsert_by_fingerprint,
)
from ..operators.detokenize import detokenize
from ..operators.joins import (
    attach_rollup,
    crosswalk,
    in_scope,
    keep_keys,
    latest_batch,
    lookup,
    near_keys,
    role_lookup,
)
from ..operators.rules import apply_default_rules
from ..operators.shape import collapse_tenants, project, scope_filter, split_by_flag
from . import layouts
from .claim_lines import cohort_members, recent_headers
from .config import RunConfig


# A pivot, or how to make it for the claims in a frame with their ``claim_header_sk``; it may then
# have others, too. What is made from lines is so made for the claims of a run only.
Pivot = DataFrame | Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class ClaimHeaderInputs:
    claim_header: DataFrame
    claim_detail: DataFrame
    diagnosis_pivot: Pivot
    procedure_pivot: Pivot
    source_system: DataFrame
    code_value_map: DataFrame
    provider: DataFrame
    provider_group: DataFrame
    provider_group_xwalk: DataFrame
    cohort: DataFrame
    rules: DataFrame
    vault: DataFrame | None = None


@dataclass(frozen=True)
class LineExtract:
    history: DataFrame
    delta: DataFrame
    deleted: DataFrame


@dataclass(frozen=True)
class HeaderExtract:
    history: DataFrame
    delta: DataFrame


def _slots(pattern: str, count: int) -> dict[str, str]:
    names = [pattern.format(n=n) for n in range(1, count + 1)]
    return {name: name for name in names}


def _made_for(pivot: Pivot, claims: DataFrame) -> DataFrame:
    return pivot if isinstance(pivot, DataFrame) else pivot(claims)


def claim_header_source(config: RunConfig, inputs: ClaimHeaderInputs) -> DataFrame:
    """Normalised headers of final claims in the lookback, while the patient was in the cohort.

    The cohort comes first, as it needs raw columns only and leaves fewer and narrower rows to
    move. The joins on the header key share one partitioning; the lookups by code, provider and
    group follow, with rows that have no such key spread out.
    """
    rows = recent_headers(
        config, scope_filter(inputs.claim_header, config.tenants, config.sources)
    )
    # Made from raw columns alone, without the cohort, so that it costs next to nothing again.
    claims = rows.select("claim_header_sk")
    rows = in_scope(
        rows,
        cohort_members(config, inputs.cohort),
        [("source_patient_id", "source_patient_id"), ("tenant_sk", "tenant_sk")],
        until=("serv_from_dt", "lasteligenddate"),
        spread_by=["claim_header_sk"],
        salts=config.salts,
    )
    alive = F.col("del_ind") == 0
    header = [("claim_header_sk", "claim_header_sk")]
    rows = lookup(
        rows,
        _made_for(inputs.diagnosis_pivot, claims),
        header,
        {
            "admit_diag_cd": "admit_diag_cd",
            **_slots("icd_diag_cd_{n}", layouts.DIAGNOSIS_SLOTS),
            **_slots("diag_code_{n}_poa", layouts.DIAGNOSIS_SLOTS),
        },
        where=alive,
    )
    rows = lookup(
        rows,
        _made_for(inputs.procedure_pivot, claims),
        header,
        _slots("icd_proc_{n}", layouts.PROCEDURE_SLOTS),
        where=alive,
    )
    lines = near_keys(inputs.claim_detail, claims, "claim_header_sk")
    rows = attach_rollup(rows, lines, header, "chg_amt", "charge", where=alive)
    rows = lookup(
        rows,
        inputs.source_system,
        [("source_system_sk", "source_system_sk")],
        {"source_system": "source_system_abbr"},
    )
    rows = crosswalk(
        rows,
        inputs.code_value_map,
        "claim_status_cd",
        "status_word",
        config.system,
        config.status_set,
        spread_by=["claim_header_sk"],
    )
    rows = role_lookup(
        rows,
        inputs.provider,
        "provider_sk",
        {"rendering_id": "rendering_prov_sk", "referring_id": "refr_prov_sk"},
        "provider_id",
        spread_by=["claim_header_sk"],
    )
    group = F.col("provider_group_sk")
    rows = lookup(
        rows,
        inputs.provider_group,
        [(group, group)],
        {"group_id": "provider_group_id", "group_sk": group},
        spread_by=["claim_header_sk"],
    )
    rows = lookup(
        rows,
        inputs.provider_group_xwalk,
        [("group_sk", group)],
        {"revised_group": "revised_provider_group_id"},
        where=alive,
        left_where=~F.col("group_sk").isin("0", "-1"),
        spread_by=["claim_header_sk"],
    )
    columns = [value.alias(name) for name, value in _columns(config).items()]
    rows = rows.select(*columns, *_diagnoses(config))
    return rows.select(*layouts.CLAIM_HEADER_STATE, *layouts.CLAIM_HEADER_NEWEST)


def _diagnoses(config: RunConfig) -> list[Column]:
    first = codes.UNKNOWN if config.extended else None
    return codes.diagnosis_slots(layouts.DIAGNOSIS_SLOTS, first_default=first)


def _columns(config: RunConfig) -> dict[str, Column]:
    ext = config.extended

    def trimmed(name: str) -> Column:
        return F.trim(F.col(name))

    def encounter(name: str) -> Column:
        value = dates.floor_date(name, "null")
        return dates.null_dates(value) if ext else value

    if ext:
        contract = codes.sentinel_default(
            "contract_number", codes.CONTRACT_SENTINELS, compare_trimmed=True
        )
        plan = codes.sentinel_default("pbp", codes.PLAN_SENTINELS, compare_trimmed=True)
        charge = text.null_if_longer("charge", 13)
    else:
        contract, plan = F.col("contract_number"), F.col("pbp")
        charge = codes.typed_default("charge", "0.00", "decimal(32,2)")
    number = ("source_system_sk", "claim_number")
    return {
        "TENANT_SK": F.col("tenant_sk"),
        "SOURCE_SYSTEM_SK": F.col("source_system_sk"),
        "SOURCE_SYSTEM": trimmed("source_system"),
        "ENTITY_MEMBER_ID": trimmed("source_patient_id"),
        "CONTRACT": contract,
        "PBP": plan,
        "HEALTH_PLAN": text.truncate("health_plan_standard_value", 15)
        if ext
        else trimmed("health_plan_standard_value"),
        "HP_MEMBER_ID": text.null_if_longer("health_plan_card_id", 20)
        if ext
        else trimmed("health_plan_card_id"),
        "CLAIM_NUMBER": codes.composite_key(*number),
        "CLAIM_STATUS": codes.map_codes("status_word", default="U" if ext else None),
        "CLAIM_TYPE": trimmed("claim_type_cd"),
        "CLAIM_ADJUST_TYPE": codes.adjust_type(
            "claim_adjust_type", "del_ind", codes.UNKNOWN if ext else None
        ),
        "ORIG_CLAIM_NUMBER": codes.original_claim_number(
            "source_system_sk", "orig_claim_nbr", "claim_adjust_type"
        ),
        "ADMIT_DATE": encounter("adm_dt"),
        "DISCHARGE_DATE": encounter("disch_dt"),
        "STATEMENT_FROM_DATE": dates.statement_from("serv_from_dt", "service_dt"),
        "STATEMENT_TO_DATE": dates.statement_to("serv_thru_dt", "serv_from_dt", "service_dt"),
        "BILL_TYPE": trimmed("bill_type"),
        "INPATIENT_FLAG": trimmed("inpatient_flg"),
        "DRG_CODE": trimmed("drg_code"),
        "RENDERING_PROVIDER_GROUP_ID": codes.sentinel_crosswalk("group_id", "revised_group"),
        "ICD_DIAG_ADMIT": trimmed("admit_diag_cd"),
        "FACILITY_TYPE": trimmed("cms_pos"),
        "CHARGE_AMOUNT": charge,
        "RENDERING_PROVIDER_NPI": trimmed("source_rend_prov_npi"),
        "REFERRING_PROVIDER_NPI": trimmed("source_refr_prov_npi"),
        "REFERRAL_NUMBER": trimmed("referral_num"),
        "RENDERING_PROVIDER_ID": codes.sentinel_default("rendering_id", max_length=24),
        "REFERRING_PROVIDER_ID": codes.sentinel_default("referring_id", max_length=24),
        "PAYTO_PROVIDER_TIN": trimmed("pay_to_prov_tin"),
        "SPECIALTY_CODE": trimmed("rend_prov_cms_spec_cd"),
        "SPECIALTY_NAME": trimmed("rend_prov_cms_spec_desc"),
        "AUTHORIZATION_NUMBER": trimmed("referral_num"),
        "TYPE_OF_ADMIT": trimmed("admit_type"),
        "ADMIT_SOURCE": trimmed("admit_src"),
        "DISCHARGE_STATUS": trimmed("disch_status"),
        "CAPPED_INDICATOR": codes.one_flag("statistical_ind"),
        **{
            f"ICD_PROC_{n}": trimmed(f"icd_proc_{n}")
            for n in range(1, layouts.PROCEDURE_SLOTS + 1)
        },
        **{f"E_CODE_{n}": trimmed(f"e_code_{n}") for n in range(1, 4)},
        "ICD_CODE_TYPE": dates.code_era("serv_from_dt"),
        "SOURCE_PATIENT_ID": F.col("source_patient_id"),
        "UPDATE_TYPE": F.lit(""),
        "SERV_FROM_DT": F.col("serv_from_dt"),
        "DEL_IND": F.col("del_ind"),
        # Not sent; of several rows for one claim they tell which is the newest.
        "CLAIM_HEADER_SK": F.col("claim_header_sk"),
        "AUD_UPD_DT": F.col("aud_upd_dt"),
    }


def _charged(config: RunConfig, df: DataFrame) -> DataFrame:
    return df.withColumn("CHARGE_AMOUNT", codes.amount("CHARGE_AMOUNT", config.extended))


def claim_header_current(config: RunConfig, inputs: ClaimHeaderInputs) -> DataFrame:
    source = claim_header_source(config, inputs)
    defaulted = _charged(config, apply_default_rules(source, inputs.rules))
    return row_fingerprint(defaulted, exclude=["UPDATE_TYPE", *layouts.CLAIM_HEADER_NEWEST])


def newest() -> list[Column]:
    """The order of several rows for one claim, the one that counts first."""
    return [
        F.col("SERV_FROM_DT").desc_nulls_first(),
        F.col("AUD_UPD_DT").desc_nulls_last(),
        F.col("CLAIM_HEADER_SK").desc_nulls_last(),
        F.col("HASH"),
    ]


def claim_header_state(
    config: RunConfig,
    inputs: ClaimHeaderInputs,
    previous: DataFrame,
    line_state: DataFrame,
    pending: bool = False,
) -> DataFrame:
    """New current state, with every changed claim classified in UPDATE_TYPE.

    Of several rows for one claim the latest service date counts, then the latest update, then
    the newest surrogate. ``pending`` keeps the changes of a ``previous`` that was not published.
    """
    merged = upsert_by_fingerprint(
        previous,
        claim_header_current(config, inputs),
        layouts.CLAIM_HEADER_KEY,
        order=newest(),
        pending=pending,
    )
    return classify_changes(merged, changed_rows(line_state))


def claim_line_extract(
    config: RunConfig, header_state: DataFrame, line_state: DataFrame
) -> LineExtract:
    """All lines of changed claims whose header is to be sent, split into live and deleted."""
    touched = affected_keys("CLAIM_NUMBER", changed_rows(line_state), changed_rows(header_state))
    sent = header_state.filter(
        F.col("UPDATE_TYPE").isin(codes.ORIGINAL, codes.ADJUSTMENT, codes.BACKOUT)
    )
    lines = keep_keys(keep_keys(line_state, touched, ["CLAIM_NUMBER"]), sent, ["CLAIM_NUMBER"])
    live, deleted = split_by_flag(lines, "DEL_IND", layouts.CLAIM_LINE)
    history = collapse_tenants(live, config.tenants)
    return LineExtract(history, history.drop("TENANT_SK", "SOURCE_SYSTEM_SK"), deleted)


def claim_header_extract(
    config: RunConfig,
    inputs: ClaimHeaderInputs,
    header_state: DataFrame,
    lines: LineExtract,
    line_history: DataFrame,
) -> HeaderExtract:
    """Headers to send and to record.

    ``line_history`` is the recorded line history including the batch just written: live lines
    count when their claim is in its last batch, deleted lines when their claim is anywhere in it.
    """
    key = ["CLAIM_NUMBER"]
    last = latest_batch(latest_batch(line_history, "LoadDate"), "LoadTime")
    claims = keep_keys(lines.history.select(*key).distinct(), last, key).unionByName(
        keep_keys(lines.deleted.select(*key).distinct(), line_history, key)
    )
    sent, recorded = select_published(header_state, claims, config.run_type)
    history = _published(config, inputs, recorded)
    delta = history if config.run_type != "Hist" else _published(config, inputs, sent)
    return HeaderExtract(history, delta.drop("Tenant_sk", "Source_System_sk"))


def _published(config: RunConfig, inputs: ClaimHeaderInputs, rows: DataFrame) -> DataFrame:
    kind = codes.published_adjust_type("CLAIM_ADJUST_TYPE", "UPDATE_TYPE")
    rows = rows.withColumn("CLAIM_ADJUST_TYPE", kind).drop(CHANGE)
    # The columns hold the key of the state, so no two rows are alike.
    rows = project(rows, {name: name.upper() for name in layouts.CLAIM_HEADER})
    if inputs.vault is not None:
        rows = detokenize(
            rows, ["Payto_Provider_Tin"], inputs.vault, spread_by=["Claim_Number"]
        )
    rows = apply_default_rules(rows, inputs.rules)
    amount = codes.amount("Charge_Amount", config.extended)
    return collapse_tenants(rows.withColumn("Charge_Amount", amount), config.tenants)
