"""Running the extracts: new state, file, history and control table.

A run may stop anywhere and be repeated. A state that was not published keeps naming its changes,
so the next run sends them; what a run delivers carries the number of the publication it belongs
to (the batch), which stays the same until the publication is marked, so a repeated run writes its
own file, history rows and control times over.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates
from ..operators.changes import changed_rows, classify_changes, reset_published
from ..operators.control import advance_watermark, read_watermark
from ..operators.history import (
    ARCHIVE_DAYS,
    HISTORY_DAYS,
    cutoff,
    history_rows,
    rotate_extracts,
)
from ..sources.buckets import merge_state, release_versions
from ..sources.extract import write_extract, write_extract_parts
from ..sources.snapshots import (
    MERGE,
    REBUILD,
    append_log,
    has_snapshot,
    latest_version,
    read_before,
    read_log,
    read_snapshot,
    version_log,
    write_snapshot,
)
from ..sources.staging import stage
from ..sources.tables import (
    drop_partitions,
    drop_where,
    overwrite_partitions,
    read_table,
    table_exists,
    write_table,
)
from .claim_headers import (
    ClaimHeaderInputs,
    LineExtract,
    claim_header_current,
    claim_header_extract,
    claim_line_extract,
)
from . import claim_headers, claim_lines, labs, layouts
from .claim_lines import ClaimLineInputs, claim_line_current
from .config import RunConfig, report_title
from .eligibility import EligibilityInputs, eligibility, eligibility_source
from .labs import LabInputs, lab_current, lab_extract

INDEX = "Filename string, folder string"
PUBLICATIONS = "domain string, version long, published_at timestamp_ntz"


@dataclass(frozen=True)
class Store:
    """Where one market and consumer keeps its data: states, control times and files under a
    shared root, history and archive as tables of one database."""

    spark: SparkSession
    root: str
    database: str
    # How long past versions of states stay, and whether files have one header or one in each part.
    production: bool = True
    one_header: bool = False

    def state(self, domain: str) -> str:
        return f"{self.root}/state/{domain}"

    def extract(self, report: str, batch: int) -> str:
        """Folder of one delivery; reports of several runs may share a name."""
        return f"{self.root}/extract/batch={batch}/{report}"

    def history(self, domain: str) -> str:
        return f"{self.database}.{domain}_hist"

    def archive(self, domain: str) -> str:
        return f"{self.database}.{domain}_archive"

    @property
    def control(self) -> str:
        return f"{self.root}/control"

    @property
    def publications(self) -> str:
        return f"{self.root}/publications"


def previous_state(store: Store, domain: str, like: DataFrame) -> DataFrame:
    """Current state of ``domain``, empty with the schema of ``like`` on the first run."""
    if has_snapshot(store.spark, store.state(domain)):
        return read_snapshot(store.spark, store.state(domain))
    return store.spark.createDataFrame([], like.schema)


def save_state(
    store: Store, domain: str, df: DataFrame, now: datetime, operation: str = MERGE
) -> DataFrame:
    """Write the next version and read it back, which also ends its lineage."""
    write_snapshot(df, store.state(domain), now, operation)
    return read_snapshot(store.spark, store.state(domain))


def merge_rows(
    store: Store,
    domain: str,
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    now: datetime,
    bucket_by: Sequence[str] | None = None,
    cleared: str | None = None,
    decide: Callable[[DataFrame], DataFrame] | None = None,
    beside: DataFrame | None = None,
) -> DataFrame:
    """Merge ``rows`` into the state of ``domain`` and read it back; buckets without a change are
    carried over. Changes that were not published yet stay named."""
    sent = _publications(store, domain).agg(F.max("version")).first()[0]
    merge_state(rows, store.state(domain), keys, now, order, published=sent or 0,
                bucket_by=bucket_by, cleared=cleared, decide=decide, beside=beside)
    return read_snapshot(store.spark, store.state(domain))


def _current_version(store: Store, domain: str) -> int | None:
    last = latest_version(version_log(store.spark, store.state(domain))).first()
    return None if last is None else last.version


def _publications(store: Store, domain: str) -> DataFrame:
    log = read_log(store.spark, store.publications, PUBLICATIONS)
    return log.filter(F.col("domain") == domain)


def mark_published(store: Store, domains: Sequence[str], now: datetime) -> None:
    """Note that the changes of the current versions went out, of all domains or of none."""
    rows = [(domain, _current_version(store, domain), now) for domain in domains]
    append_log(store.spark, store.publications, rows, PUBLICATIONS)


def finish(store: Store, domains: Sequence[str], now: datetime) -> None:
    """Mark the publication, then let go of states that are too old to be read back."""
    mark_published(store, domains, now)
    for domain in domains:
        release_versions(store.spark, store.state(domain), now, store.production)


def is_published(store: Store, domain: str) -> bool:
    version = _current_version(store, domain)
    return not _publications(store, domain).filter(F.col("version") == version).isEmpty()


def pending_changes(store: Store, domain: str) -> bool:
    """Whether the current state of ``domain`` holds changes that did not go out yet."""
    return _current_version(store, domain) is not None and not is_published(store, domain)


def record_history(
    store: Store, domain: str, rows: DataFrame, filename: str, now: datetime, batch: int = 0
) -> DataFrame:
    """Add the delivered rows to the history table, partitioned by load date and batch.

    Rows that an interrupted run recorded for the same batch go first.
    """
    stamped = history_rows(rows, filename, now).withColumn("Batch", F.lit(batch))
    if table_exists(store.spark, store.history(domain)):
        drop_where(store.spark, store.history(domain), "Batch", batch)
    write_table(stamped, store.history(domain), partition_by=["LoadDate", "Batch"])
    return read_table(store.spark, store.history(domain))


def age_history(store: Store, domain: str, today: datetime) -> None:
    """Move load dates past the history limit to the archive and drop those past its own.

    The archive is written before the history lets go of a date, and whole dates are written
    over, so a repeated or interrupted run neither loses nor doubles rows.
    """
    move, drop = cutoff(today.date(), HISTORY_DAYS), cutoff(today.date(), ARCHIVE_DAYS)
    history = read_table(store.spark, store.history(domain))
    aged = history.filter((F.col("LoadDate") < move) & (F.col("LoadDate") >= drop))
    if table_exists(store.spark, store.archive(domain)):
        overwrite_partitions(aged, store.archive(domain))
        drop_partitions(store.spark, store.archive(domain), "LoadDate", drop)
    else:
        write_table(aged, store.archive(domain), partition_by=["LoadDate", "Batch"])
    drop_partitions(store.spark, store.history(domain), "LoadDate", move)


def index_extract(
    store: Store, config: RunConfig, label: str, report: str, now: datetime, batch: int
) -> None:
    """List the new extract as current and the earlier ones of its kind as archived.

    An entry of the same folder is that of an interrupted run and is replaced.
    """
    prefixes = [f"{config.file_prefix}_{run}_{label}_" for run in ("Hist", config.run_type)]
    folder = store.extract(report, batch)
    entry = store.spark.createDataFrame([(report, folder)], INDEX)
    listed = previous_state(store, "extracts", entry.withColumn("place", F.lit("")))
    listed = listed.filter(F.col("folder") != folder)
    is_current = F.col("place") == "current"
    current, archived = rotate_extracts(
        listed.filter(is_current), listed.filter(~is_current), prefixes
    )
    archived = archived.withColumn("place", F.lit("archive"))
    fresh = entry.withColumn("place", F.lit("current"))
    save_state(store, "extracts", current.unionByName(archived).unionByName(fresh), now)


def _control(store: Store, domain: str) -> tuple[DataFrame, int, bool]:
    """Control times as they were before the batch that is due, its number, and whether an
    interrupted run has moved them for it already."""
    batch = _publications(store, domain).count() + 1
    before = read_before(store.spark, store.control, f"{domain} {batch}")
    if before is not None:
        return before, batch, True
    return read_snapshot(store.spark, store.control), batch, False


def publish(
    store: Store,
    config: RunConfig,
    domain: str,
    label: str,
    history: DataFrame,
    now: datetime,
    delta: DataFrame | None = None,
    last: datetime | None = None,
    keep_previous: bool = False,
) -> DataFrame:
    """Write the file, record the history and move the control time; returns the history.

    Everything is written for the batch that follows the last publication of ``domain``; the
    control time is moved once for a batch. The caller marks the publication. Load dates past
    their limit move to the archive at the end.

    The file holds the history rows without their tenant and source keys, unless ``delta`` says
    otherwise.
    ``last`` replaces the domain's own last extract time in the file name and as previous time.
    """
    control, batch, moved = _control(store, domain)
    start = last or read_watermark(control, domain) or dates.default_start(config.as_of)
    report = report_title(config, label, start, read_watermark(control) or now)
    history = stage(history, domain)
    delta = history.drop("TENANT_SK", "SOURCE_SYSTEM_SK") if delta is None else delta
    write = write_extract_parts if store.one_header else write_extract
    write(delta, store.extract(report, batch))
    index_extract(store, config, label, report, now, batch)
    recorded = record_history(store, domain, history, f"{report}.txt", now, batch)
    if not moved:
        times = advance_watermark(control, domain, previous=last, keep_previous=keep_previous)
        write_snapshot(times, store.control, now, f"{domain} {batch}")
    age_history(store, domain, now)
    return recorded


def run_eligibility(
    store: Store, config: RunConfig, inputs: EligibilityInputs, now: datetime
) -> None:
    source = save_state(store, "eligibility", eligibility_source(config, inputs), now, REBUILD)
    history = eligibility(config, inputs, source).history
    publish(store, config, "eligibility", "Eligibility", history, now, keep_previous=True)
    finish(store, ["eligibility"], now)


def run_labs(store: Store, config: RunConfig, inputs: LabInputs, now: datetime) -> None:
    current = lab_current(config, inputs)
    state = merge_rows(store, "lab_result", current, layouts.LAB_KEY, labs.newest(), now)
    publish(store, config, "lab_result", "Lab", lab_extract(config, state).history, now)
    finish(store, ["lab_result"], now)


def run_claim_lines(
    store: Store, config: RunConfig, inputs: ClaimLineInputs, now: datetime
) -> DataFrame:
    """The lines' changes go out with the headers of the same run, or of a later one."""
    current = claim_line_current(config, inputs)
    keys, newest = layouts.CLAIM_LINE_KEY, claim_lines.newest()
    return merge_rows(store, "medclaim_details", current, keys, newest, now)


def previous_headers(store: Store, like: DataFrame) -> DataFrame:
    """Header state before a run: classified changes that went out are cleared, others wait."""
    state = previous_state(store, "medclaim_header", like)
    return reset_published(state) if is_published(store, "medclaim_header") else state


def run_claim_headers(
    store: Store, config: RunConfig, inputs: ClaimHeaderInputs, now: datetime
) -> None:
    """Runs after the claim lines of the same run; sends both claim files."""
    lines = read_snapshot(store.spark, store.state("medclaim_details"))
    changed = changed_rows(lines)
    # A claim may have to be sent for its lines alone, so their claims are classified as well.
    state = merge_rows(
        store,
        "medclaim_header",
        claim_header_current(config, inputs),
        layouts.CLAIM_HEADER_KEY,
        claim_headers.newest(),
        now,
        bucket_by=["TENANT_SK", "CLAIM_NUMBER"],
        cleared="UPDATE_TYPE",
        decide=lambda rows: classify_changes(rows, changed),
        beside=changed,
    )
    line = claim_line_extract(config, state, lines)
    line = LineExtract(stage(line.history, "lines"), line.delta, stage(line.deleted, "deleted"))
    # Both files are named after the last header run.
    last = read_watermark(_control(store, "medclaim_header")[0], "medclaim_header")
    recorded = publish(
        store, config, "medclaim_details", "MedClaim_D", line.history, now, last=last
    )
    header = claim_header_extract(config, inputs, state, line, recorded)
    delta = header.delta if config.run_type == "Hist" else None
    publish(store, config, "medclaim_header", "MedClaim_H", header.history, now, delta)
    finish(store, ["medclaim_details", "medclaim_header"], now)
