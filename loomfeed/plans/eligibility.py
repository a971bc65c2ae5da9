"""Eligibility: latest row per member and start date, rebuilt in full on every run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes, dates, text
from ..operators.joins import drop_keys, in_scope, join_where, keep_keys, lookup
from ..operators.rules import apply_default_rules, apply_reference_lists
from ..operators.shape import collapse_tenants, latest_per_key, live_rows, project, scope_filter
from . import layouts
from .config import RunConfig


@dataclass(frozen=True)
class EligibilityInputs:
    """Frames and market-specific expressions.

    ``location``, ``benefit_plan_key`` and ``pod`` read the eligibility columns and
    ``source_pod_id``; ``start`` replaces the record start in the extended model. The lists come
    from ``reference_list``; ``tin_exclude`` drops members of provider groups with these tax numbers
    (``provider_group_tin``). ``group_condition`` is a further condition of the join with the provider
    groups, as text over the eligibility columns (``e.``) and theirs (``d.``).
    """

    eligibility: DataFrame
    source_system: DataFrame
    provider_group: DataFrame
    provider_group_xwalk: DataFrame
    pod_xwalk: DataFrame
    business_type_xwalk: DataFrame
    cohort: DataFrame
    rules: DataFrame
    business_source: str
    location: Column
    benefit_plan_key: Column
    pod: Column
    provider: Column | None = None
    start: Column | None = None
    lob_include: DataFrame | None = None
    lob_exclude: DataFrame | None = None
    plan_include: DataFrame | None = None
    plan_exclude: DataFrame | None = None
    extra: DataFrame | None = None
    tin_exclude: DataFrame | None = None
    group_condition: str | None = None


@dataclass(frozen=True)
class EligibilityExtract:
    source: DataFrame
    history: DataFrame
    delta: DataFrame


def eligibility_source(config: RunConfig, inputs: EligibilityInputs) -> DataFrame:
    """Normalised rows, one per tenant, member and start date."""
    rows = live_rows(scope_filter(inputs.eligibility, config.tenants, config.sources))
    for end in ("benefit_plan_term_dt", "record_end_dt"):
        rows = rows.filter(
            dates.within_lookback(end, config.lookback_months, config.as_of, open_ended=True)
        )
    rows = apply_reference_lists(
        rows, "line_of_business", inputs.lob_include, inputs.lob_exclude
    )
    rows = apply_reference_lists(
        rows, "health_plan_standard_value", inputs.plan_include, inputs.plan_exclude
    )
    alive = F.col("del_ind") == 0
    sk = F.col("provider_group_sk")
    rows = lookup(
        rows,
        inputs.source_system,
        [("source_system_sk", "source_system_sk")],
        {"source_system": "source_system_abbr"},
        how="inner",
        where=alive,
    )
    if inputs.group_condition is None:
        rows = lookup(rows, inputs.provider_group, [(sk, sk)], {}, how="inner", where=alive)
    else:
        key = [("provider_group_sk", "provider_group_sk")]
        rows = join_where(rows, inputs.provider_group, key, inputs.group_condition, where=alive)
    if inputs.tin_exclude is not None:
        rows = drop_keys(rows, _excluded_groups(inputs), ["provider_group_sk"])
    rows = lookup(
        rows,
        inputs.pod_xwalk,
        [("pod_id", "source_pod_id")],
        {"source_pod_id": "source_pod_id"},
        how="inner",
        where=alive,
    )
    rows = lookup(
        rows,
        inputs.provider_group_xwalk,
        [(sk, sk)],
        {"revised_group": "revised_provider_group_id"},
        where=alive,
        left_where=~sk.isin("0", "-1"),
        spread_by=["eligibility_sk"],
    )
    rows = lookup(
        rows,
        inputs.business_type_xwalk,
        [(F.upper("business_type"), F.upper("standard_value"))],
        {"business_value": "standard_value"},
        where=(F.col("active_flag") == 1) & (F.col("source") == inputs.business_source),
        spread_by=["eligibility_sk"],
    )
    rows = latest_per_key(
        rows,
        ["tenant_sk", "source_patient_id", "record_start_dt"],
        [
            F.when(F.col("primary_coverage_flg") == "Y", 1).otherwise(0).desc(),
            F.col("aud_upd_dt").desc_nulls_first(),
            F.col("eligibility_sk").desc_nulls_first(),
        ],
    )
    result = project(rows, _columns(config, inputs))
    return result if inputs.extra is None else result.unionByName(inputs.extra).distinct()


def _excluded_groups(inputs: EligibilityInputs) -> DataFrame:
    """Provider groups whose tax number is on the exclusion list."""
    groups = inputs.provider_group.select("provider_group_sk", F.upper("provider_group_tin").alias("tin"))
    return keep_keys(groups, inputs.tin_exclude.select(F.col("value").alias("tin")), ["tin"]).select(
        "provider_group_sk"
    )


def _columns(config: RunConfig, inputs: EligibilityInputs) -> dict[str, Column | str]:
    ext = config.extended
    start = dates.floor_date("record_start_dt")
    if ext and inputs.start is not None:
        start = inputs.start
    provider = codes.sentinel_default("enrollment_pcp_id", ("-1",), trim=False)
    if ext and inputs.provider is not None:
        provider = inputs.provider
    card, plan = F.col("health_plan_card_id"), F.col("health_plan_standard_value")
    return {
        "SOURCE_SYSTEM": "source_system",
        "SOURCE_SYSTEM_SK": "source_system_sk",
        "TENANT_SK": "tenant_sk",
        "ENTITY_MEMBER_ID": "source_patient_id",
        "HP_MEMBER_ID": text.null_if_longer(card, 20, trim=False) if ext else card,
        "PROVIDER_ID": provider,
        "PROVIDER_GROUP_ID": codes.sentinel_crosswalk(
            "provider_group_id", "revised_group", ("-1",)
        ),
        "LOCATION_ID": inputs.location,
        "ELIGIBILITY_POD_ID": inputs.pod.cast("string"),
        "RECORD_START_DT": start,
        "RECORD_END_DT": dates.floor_date("record_end_dt"),
        "HEALTH_PLAN": text.truncate(plan, 15) if ext else plan,
        "BENEFIT_PLAN_KEY": inputs.benefit_plan_key,
        "BENEFIT_PLAN_DESC": "benefit_plan_desc",
        "CONTRACT": "contract_number",
        "PBP": "plan_benefit_package",
        "BUSINESS_TYPE": F.upper("business_value"),
        "BUSINESS_LINE": "line_of_business",
        "BENEFIT_PLAN_EFF_DATE": dates.floor_date(
            "benefit_plan_effective_dt", "null" if ext else "clamp"
        ),
        "BENEFIT_PLAN_TERM_DATE": dates.floor_date("benefit_plan_term_dt"),
    }


def eligibility(
    config: RunConfig, inputs: EligibilityInputs, source: DataFrame | None = None
) -> EligibilityExtract:
    """The extract: cohort members only, defaults applied, tenants collapsed.

    ``source`` is the stored result of ``eligibility_source``, if there is one.
    """
    source = eligibility_source(config, inputs) if source is None else source
    scoped = in_scope(
        source,
        inputs.cohort,
        [("ENTITY_MEMBER_ID", "source_patient_id"), ("TENANT_SK", "tenant_sk")],
        where=F.col("projectabbr") == config.project,
    ).select(*layouts.ELIGIBILITY)
    history = collapse_tenants(apply_default_rules(scoped, inputs.rules), config.tenants)
    return EligibilityExtract(source, history, history.drop("SOURCE_SYSTEM_SK", "TENANT_SK"))
