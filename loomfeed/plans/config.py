"""Parameters of a run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime
from functools import cached_property

from ..functions import dates

STANDARD, EXTENDED = "standard", "extended"


@dataclass(frozen=True)
class RunConfig:
    """One run for one market.

    ``tenants`` and ``sources`` limit the facts (``sources="All"`` takes every source system).
    ``as_of`` is the day lookbacks count from. ``project`` picks the cohort rows, ``system`` and
    ``status_set`` the rows of the code map. ``model`` is the source data model of the market.
    ``salts`` splits the facts of each claim or patient over that many partitions in the joins
    that collect them, for markets where one of them holds a large share.
    """

    market: str
    tenants: tuple[int, ...]
    as_of: date
    project: str
    system: str = ""
    status_set: str = ""
    sources: tuple[str, ...] | str = "All"
    lookback_months: int = dates.DEFAULT_LOOKBACK
    model: str = STANDARD
    consumer: str = ""
    run_type: str = "Delta"
    file_prefix: str = ""
    salts: int = 1

    def __post_init__(self) -> None:
        if self.model not in (STANDARD, EXTENDED):
            raise ValueError(f"unknown model {self.model!r}")

    @cached_property
    def extended(self) -> bool:
        return self.model == EXTENDED


def report_title(config: RunConfig, label: str, last: datetime, current: datetime) -> str:
    """File name of an extract: prefix, run type, label, last and current run as yyMMdd."""
    parts = [config.file_prefix, config.run_type, label]
    return "_".join([*parts, last.strftime("%y%m%d"), current.strftime("%y%m%d")])
