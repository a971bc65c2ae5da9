"""One point in time for all sources of a run.

The version of every source is chosen once, before anything is read, so that a source that gets a
new version meanwhile is still read as it was, and all sources are of the same moment.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace
from datetime import date, datetime

from pyspark.sql import DataFrame, Row, SparkSession

from ..functions import dates
from ..plans.config import RunConfig
from .snapshots import (
    MAX_AGE_HOURS,
    MAX_AGE_HOURS_PRODUCTION,
    read_version,
    rebuild_time,
    row_as_of,
    version_log,
)


@dataclass(frozen=True)
class Point:
    """The chosen version of each source, by name, and the day from which a run looks back."""

    spark: SparkSession
    roots: Mapping[str, str]
    versions: Mapping[str, Row]
    as_of: datetime | None
    lookback: date

    def read(self, name: str) -> DataFrame:
        return read_version(self.spark, self.roots[name], self.versions[name])

    def config(self, config: RunConfig) -> RunConfig:
        """The run's parameters, looking back from this point."""
        return replace(config, as_of=self.lookback)


def fix_point(
    spark: SparkSession,
    roots: Mapping[str, str],
    rebuilds: DataFrame,
    now: datetime,
    production: bool = False,
) -> Point:
    """The point of the last rebuild in the log ``rebuilds``, if it may still be read back, else now.

    The lookback counts from the rebuild's day when it lies in another calendar month than ``now``.
    A source without a version at that time is an error.
    """
    hours = MAX_AGE_HOURS_PRODUCTION if production else MAX_AGE_HOURS
    found = rebuild_time(rebuilds, dates.timestamp(now), hours).first()
    as_of = None if found is None else found.committed_at
    versions = {name: row_as_of(version_log(spark, root), as_of) for name, root in roots.items()}
    missing = sorted(name for name, row in versions.items() if row is None)
    if missing:
        raise LookupError(f"no version of {', '.join(missing)} committed by {as_of or now}")
    day = dates.lookback_as_of(None if as_of is None else as_of.date(), now.date())
    return Point(spark, dict(roots), versions, as_of, day)
