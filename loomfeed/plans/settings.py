"""The settings of a run, found in tables by market and consumer.

One resolver gives the parameters, the rules and the lists of a run, so that every plan of it works
with those of its own market and consumer. Several different values for one setting are an error.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields, replace
from datetime import date
from typing import TypeVar

from pyspark.sql import DataFrame

from ..functions import dates
from ..operators.rules import (
    config_value,
    enterprise_id_applied,
    file_prefix,
    market_config,
    model_type,
    reference_list,
    rules_for,
)
from .config import EXTENDED, STANDARD, RunConfig

# How the tables name the source data models.
MODELS = {"SDM2": STANDARD, "SDM3": EXTENDED, STANDARD.upper(): STANDARD, EXTENDED.upper(): EXTENDED}
# The lists of the eligibility extract: reference name, kind and input.
LISTS = {
    "lob_include": ("line_of_business", "inclusion"),
    "lob_exclude": ("line_of_business", "exclusion"),
    "plan_include": ("health_plan_standard_value", "inclusion"),
    "plan_exclude": ("health_plan_standard_value", "exclusion"),
    "tin_exclude": ("provider_group_tin", "exclusion"),
}
Inputs = TypeVar("Inputs")


@dataclass(frozen=True)
class SettingTables:
    """``names`` has tenant, target_market, filename, sdm_type and eid_applied; ``configs`` domain,
    markets, consumer, project, system, status_set and lookback_months; ``rules`` and
    ``references`` are read by ``rules_for`` and ``reference_list``."""

    names: DataFrame
    configs: DataFrame
    rules: DataFrame
    references: DataFrame | None = None


@dataclass(frozen=True)
class RunSettings:
    tables: SettingTables
    config: RunConfig
    enterprise_ids: bool

    def rules(self, domain: str) -> DataFrame:
        """Active rules of this market, consumer and domain."""
        return rules_for(self.tables.rules, self.config.market, domain, self.config.consumer or None)

    def values(self, domain: str, reference: str, kind: str) -> DataFrame:
        """One include or exclude list of this market and consumer."""
        market, consumer = self.config.market, self.config.consumer
        return reference_list(self.tables.references, market, domain, reference, consumer, kind)

    def inputs(self, inputs: Inputs, domain: str) -> Inputs:
        """``inputs`` of a plan with the rules of this run, and its lists where it takes any."""
        found = {"rules": self.rules(domain)}
        if self.tables.references is not None:
            taken = {f.name for f in fields(inputs)}
            lists = {k: v for k, v in LISTS.items() if k in taken and getattr(inputs, k) is None}
            found |= {name: self.values(domain, *what) for name, what in lists.items()}
        return replace(inputs, **found)


def resolve(
    tables: SettingTables,
    market: str,
    tenants: Sequence[int],
    as_of: date,
    domain: str = "CLAIMS",
    consumer: str = "",
    sources: tuple[str, ...] | str = "All",
    run_type: str = "Delta",
) -> RunSettings:
    """The settings of one run. A market without a model or a configuration is an error; other
    settings that the tables do not hold are empty."""
    model = model_type(tables.names, market).upper()
    if model not in MODELS:
        raise LookupError(f"no source data model for market {market!r}")
    rows = market_config(tables.configs, domain, market, consumer)
    if rows.isEmpty():
        raise LookupError(f"no configuration of {domain} for market {market!r}")
    config = RunConfig(
        market=market,
        tenants=tuple(tenants),
        as_of=as_of,
        project=config_value(rows, "project"),
        system=config_value(rows, "system"),
        status_set=config_value(rows, "status_set"),
        sources=sources,
        lookback_months=int(config_value(rows, "lookback_months", str(dates.DEFAULT_LOOKBACK))),
        model=MODELS[model],
        consumer=consumer,
        run_type=run_type,
        file_prefix=file_prefix(tables.names, ",".join(map(str, tenants)), market),
    )
    return RunSettings(tables, config, enterprise_id_applied(tables.names, market).upper() == "Y")
