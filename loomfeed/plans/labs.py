"""Lab results: latest result per order, merged into the current state; changes are sent."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, text
from ..functions.fingerprint import row_fingerprint
from ..operators.changes import changed_rows, upsert_by_fingerprint
from ..operators.detokenize import detokenize
from ..operators.joins import last_eligible, lookup
from ..operators.rules import apply_default_rules
from ..operators.shape import collapse_tenants, latest_per_key, live_rows, project, scope_filter
from . import layouts
from .config import RunConfig


@dataclass(frozen=True)
class LabInputs:
    """``observed`` computes the observation date from the lab columns; ``ordered`` is a further
    market-specific filter. ``vault`` maps name and member id tokens to clear text."""

    lab_result: DataFrame
    patient: DataFrame
    source_system: DataFrame
    cohort: DataFrame
    rules: DataFrame
    vault: DataFrame | None = None
    observed: Column | None = None
    ordered: Column | None = None


@dataclass(frozen=True)
class LabExtract:
    state: DataFrame
    history: DataFrame
    delta: DataFrame


NAMES = ["first_name", "middle_name", "last_name"]


def _patients(inputs: LabInputs) -> DataFrame:
    """Live cohort patients with clear names and last eligible day.

    Cohort and tokens are resolved per patient rather than per result.
    """
    people = live_rows(inputs.patient).select(
        "patient_sk", "source_patient_id", *NAMES, "birth_date", "hicn_mbi"
    )
    key = "source_patient_id"
    people = lookup(
        people,
        last_eligible(inputs.cohort, [key], "lasteligenddate"),
        [(key, key)],
        {"last_day": F.to_date("lasteligenddate")},
        how="inner",
    )
    if inputs.vault is not None:
        people = detokenize(
            people, [*NAMES, "hicn_mbi"], inputs.vault, spread_by=["patient_sk"]
        )
    return people.withColumns(
        {
            "first_name": F.trim("first_name"),
            "middle_name": text.blank_to_null("middle_name"),
            "last_name": F.trim("last_name"),
        }
    )


def lab_source(config: RunConfig, inputs: LabInputs) -> DataFrame:
    """Normalised results of cohort members up to their last eligible day, one per order, test,
    code and observation day.

    The cohort test looks at member and observation day only, which all rows of one such group
    share, so it may come before the choice of the latest row. Linked identities only ever
    confirm that a result has a patient, which the patient join already does, so they are not
    expanded here.
    """
    rows = live_rows(scope_filter(inputs.lab_result, config.tenants, config.sources))
    rows = rows.filter(F.col("loinc_cd").contains("-"))
    if inputs.ordered is not None:
        rows = rows.filter(inputs.ordered)
    rows = rows.filter(dates.within_lookback("aud_upd_dt", config.lookback_months, config.as_of))
    rows = lookup(
        rows,
        inputs.source_system,
        [("source_system_sk", "source_system_sk")],
        {"source_system": "source_system_name"},
        how="inner",
        where=F.col("del_ind") == 0,
    )
    observed = inputs.observed if inputs.observed is not None else F.to_date("lab_order_perf_dt")
    results = project(
        rows,
        {
            "TENANT_SK": "tenant_sk",
            "SOURCE_SYSTEM_SK": "source_system_sk",
            "LAB_RESULT_SK": "lab_result_sk",
            "SOURCE_SYSTEM": "source_system",
            "CONTRACT": F.lit("0"),
            "PBP": F.lit("0"),
            "LAB_ORDER_NUMBER": "lab_order_id",
            "LAB_RESULT_NAME": F.coalesce(text.truncate("lab_order_desc", 128), F.lit("")),
            "LAB_RESULT_OBSERVATION_DATE": observed,
            "LAB_RESULT_OBSERVATION_TIME": dates.time_of_day("lab_order_perf_dt"),
            "LAB_RESULT_VALUE": "lab_result_value_raw",
            "LAB_RESULT_UNIT_OF_MEASURE": text.strip_nonprintable("lab_result_value_uom"),
            "LAB_RESULT_REFERENCE_RANGE": text.default_if_blank("result_ref_range", "0-0"),
            "LAB_RESULT_OBSERVE_STATUS": F.coalesce("result_status", F.lit("F")),
            "LAB_RESULT_COMMENT": text.strip_nonprintable(text.truncate("result_comment", 255)),
            "LAB_RESULT_TEST_NAME": text.truncate(
                F.coalesce("lab_order_test_name", "lab_order_desc", F.lit("")), 100
            ),
            "LAB_RESULT_TYPE": "lab_orderable_cd",
            "LAB_RESULT_LOINC_CODE": "loinc_cd",
            "LAB_RESULT_CPT_CODE": "cpt_cd",
            "LAB_RESULT_FILLER_ORDER_NUMBER": "accession_number",
            "LAB_RESULT_REQUESTED_DATE_TIME": dates.timestamp_text("order_request_dt"),
            "LAB_RESULT_ORDERED_DATE_TIME": dates.timestamp_text("lab_ordered_dt"),
            "LAB_RESULT_OBSERVATION_REQUEST_TIME": dates.timestamp_text("observation_request_dt"),
            "LAB_RESULT_OBSERVE_REQUEST_RESULT_STATUS": F.lit("F"),
            "LAB_RESULT_SPECIMEN_SOURCE": "specimen_source_desc",
            "LAB_RESULT_ABNORMAL_FLAG": "abnormal_status_cd",
            "LAB_RESULT_NATURE_OF_ABNORMAL_TEST": "abnormal_test_nature",
            "__sequence": "lab_result_sequence",
            "__patient": "patient_sk",
        },
    )
    results = lookup(
        results,
        _patients(inputs),
        [("__patient", "patient_sk")],
        {
            "ENTITY_MEMBER_ID": "source_patient_id",
            "FIRST_NAME": "first_name",
            "MIDDLE_NAME": "middle_name",
            "LAST_NAME": "last_name",
            "PATIENT_BIRTH_DATE": F.to_date("birth_date"),
            "PATIENT_MBI_OR_HICN": "hicn_mbi",
            "__last_day": "last_day",
        },
        how="inner",
        spread_by=["LAB_RESULT_SK"],
        salts=config.salts,
    ).filter(F.col("LAB_RESULT_OBSERVATION_DATE") <= F.col("__last_day"))
    latest = latest_per_key(
        results,
        layouts.LAB_KEY,
        [F.col("__sequence").desc_nulls_first(), F.col("LAB_RESULT_SK").desc_nulls_first()],
    )
    return latest.select(*layouts.LAB_STATE)


def lab_current(config: RunConfig, inputs: LabInputs) -> DataFrame:
    """Results with defaults and fingerprint."""
    defaulted = apply_default_rules(lab_source(config, inputs), inputs.rules)
    return row_fingerprint(defaulted, exclude=["LAB_RESULT_SK"])


def lab_state(
    config: RunConfig, inputs: LabInputs, previous: DataFrame, pending: bool = False
) -> DataFrame:
    """New current state with ``_change_type``.

    Defaults may make keys equal that were distinct; the newest result counts. ``pending`` keeps
    the changes of a ``previous`` that was not published.
    """
    current = lab_current(config, inputs)
    return upsert_by_fingerprint(
        previous, current, layouts.LAB_KEY, order=newest(), pending=pending
    )


def newest() -> list[Column]:
    """Which of several results for one key counts."""
    return [F.col("LAB_RESULT_SK").desc_nulls_first(), F.col("HASH")]


def lab_extract(config: RunConfig, state: DataFrame) -> LabExtract:
    changes = changed_rows(state).withColumn(
        "PATIENT_NAME",
        text.full_name(
            "LAST_NAME", "FIRST_NAME", "MIDDLE_NAME", trailing_space=not config.extended
        ),
    )
    number = F.col("LAB_ORDER_NUMBER").cast("string")
    rows = changes.withColumn("LAB_ORDER_NUMBER", number).select(*layouts.LAB_RESULT)
    history = collapse_tenants(rows, config.tenants)
    return LabExtract(state, history, history.drop("SOURCE_SYSTEM_SK", "TENANT_SK"))
