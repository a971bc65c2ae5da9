"""States kept in buckets of their key: a version writes the buckets that change and lists the rest.

A version has a folder of its own with the buckets it rewrote (``data``), its change set
(``changes``) and a list of all buckets of the state with the folder that holds each (``buckets``).
Untouched buckets are carried over by that list; they are neither read nor moved. What changed
between two versions is read from the change sets, not by comparing states.

A row keeps the version that changed it last. The list of a version says up to which version
changes were published, so rows need not be rewritten to clear their marks. A further column may
hold a mark that counts only that long (``cleared``), such as the kind of change to be sent.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timedelta
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.changes import BEFORE, CHANGE, INSERT, UPDATE, one_per_key
from .snapshots import (
    LOG_SCHEMA,
    MAX_AGE_HOURS,
    MAX_AGE_HOURS_PRODUCTION,
    MERGE,
    RELEASED,
    append_log,
    commit_version,
    latest_version,
    next_version,
    readable,
    version_log,
)
from .staging import stage

# A bucket should stay within some GB; its rows are merged and written in parts of some PART_ROWS.
BUCKETS = 64
PART_ROWS = 2_000_000
# Fingerprints are most of a narrow row, and hexadecimal digits take half the room this way.
COMPRESSION = "zstd"
BUCKET, KEY, VERSION = "__bucket", "__key", "__version"
LIST_SCHEMA = "bucket int, folder string, published long, buckets int, cleared string"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row; a missing key part counts as such."""
    parts = [F.col(k).cast("string") for k in keys]
    marks = [F.col(k).isNull() for k in keys]
    return F.pmod(F.xxhash64(*parts, *marks), F.lit(buckets)).cast("int")


def bucket_list(spark: SparkSession, root: str, folder: str) -> DataFrame:
    return spark.read.schema(LIST_SCHEMA).parquet(f"{root}/{folder}/buckets")


def is_bucketed(folder: str) -> bool:
    return folder.startswith("buckets-")


class _Version:
    """What a committed version consists of; the list has one row for each bucket."""

    def __init__(self, spark: SparkSession, root: str, folder: str) -> None:
        self.spark, self.root, self.folder = spark, root, folder
        rows = bucket_list(spark, root, folder).collect()
        self.place = {r.bucket: r.folder for r in rows if r.folder is not None}
        self.published = rows[0].published
        self.buckets = rows[0].buckets
        self.cleared = rows[0].cleared
        # The schema of the state, whichever buckets have rows.
        self.schema = spark.read.parquet(f"{root}/{folder}/changes").schema

    def rows(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The rows of some buckets, or of all, with the columns of the state and ``VERSION``."""
        wanted = self.place if buckets is None else [b for b in buckets if b in self.place]
        paths = [f"{self.root}/{self.place[b]}/data/{BUCKET}={b}" for b in wanted]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)


def read_buckets(spark: SparkSession, root: str, folder: str) -> DataFrame:
    """The state of a version; ``_change_type`` names the changes not published before it."""
    version = _Version(spark, root, folder)
    return _waiting(version.rows(), version.published, version.cleared).drop(VERSION)


def _waiting(rows: DataFrame, published: int, cleared: str | None) -> DataFrame:
    """``rows`` without the marks of changes that were published."""
    waits = F.col(VERSION) > published
    rows = rows.withColumn(CHANGE, F.when(waits, F.col(CHANGE)))
    if cleared is None:
        return rows
    return rows.withColumn(cleared, F.when(waits, F.col(cleared)).otherwise(""))


def merge_state(
    source: DataFrame,
    root: str,
    keys: Sequence[str],
    committed_at: datetime,
    order: Sequence[Column] | None = None,
    fingerprint: str = "HASH",
    published: int = 0,
    buckets: int = BUCKETS,
    operation: str = MERGE,
    bucket_by: Sequence[str] | None = None,
    cleared: str | None = None,
    decide: Callable[[DataFrame], DataFrame] | None = None,
    beside: DataFrame | None = None,
) -> int:
    """Merge ``source`` into the state under ``root`` as its next version; returns the number.

    As ``upsert_by_fingerprint`` with null-safe keys: a source row replaces the row of its key
    when the fingerprints differ and is added when the key is new; other rows stay. Changes after
    version ``published`` still wait: a waiting insert that changes again remains an insert.

    Of the state only key, fingerprint and marks are read at first, in the buckets that ``source``
    has rows for; whole rows only where something changed. A state that was not kept in this
    number of buckets is rewritten once.

    ``cleared`` names a column with a mark that counts until it is published, and reads as an empty
    text afterwards. ``decide`` sets it on the rows it is given: those that changed, and those
    whose ``bucket_by`` columns, part of the key, are in ``beside``, which are read in the buckets
    of these. A row that gets another mark is written again, but is no change.
    """
    spark = source.sparkSession
    bucket_by = bucket_by or keys
    last = latest_version(version_log(spark, root)).first()
    number = next_version(last)
    folder = f"buckets-{number}-{uuid4().hex}"
    old, place, moved = _current(spark, root, last, source, keys, buckets)
    columns = old.drop(CHANGE, VERSION, BUCKET).columns
    key = F.struct(*[F.col(k) for k in keys])
    new = source.select(*[F.col(c).cast(old.schema[c].dataType).alias(c) for c in columns])
    new = new.withColumn(BUCKET, bucket_of(bucket_by, buckets))
    marks = old
    if not moved:
        new = stage(new, "merge-source", COMPRESSION)
        touched = sorted(r[0] for r in new.select(BUCKET).distinct().collect())
        marks = _Version(spark, root, last.folder).rows(touched)
    # Picked after the rows are staged, so that the join finds them dealt by key.
    new = one_per_key(new.withColumn(KEY, key), [KEY], order)
    marks = marks.select(
        key.alias(KEY), F.col(fingerprint).alias("__old"), F.col(CHANGE).alias("__was"), F.col(VERSION).alias("__at")
    )
    paired = new.join(marks, KEY, "left")
    kind = F.when(F.col("__at").isNull(), INSERT).when(F.col("__old") != F.col(fingerprint), UPDATE)
    still = (F.col("__at") > published) & (F.col("__was") == INSERT)
    fresh = paired.withColumn("__kind", kind).filter(F.col("__kind").isNotNull())
    fresh = fresh.withColumn(CHANGE, F.when(still, INSERT).otherwise(F.col("__kind")))
    fresh = fresh.withColumn(VERSION, F.lit(number).cast("long"))
    fresh = stage(fresh.select(*columns, CHANGE, VERSION, BUCKET, "__kind"), "merge-changes", COMPRESSION)
    fresh = fresh.withColumn(KEY, key)
    if decide is not None:
        fresh = _decided(fresh, old if moved else _Version(spark, root, last.folder), keys, bucket_by, buckets,
                         published, number, cleared, decide, beside)
    changed = sorted(r[0] for r in fresh.select(BUCKET).distinct().collect())
    rest = old if moved else _Version(spark, root, last.folder).rows(changed)
    rest = rest.withColumn(KEY, key)
    updated = fresh.filter(F.col("__kind") == UPDATE).select(KEY)
    before = _waiting(rest.join(updated, KEY, "left_semi"), published, cleared).withColumn(CHANGE, F.lit(BEFORE))
    after = fresh.filter(F.col("__kind").isNotNull()).withColumn(CHANGE, F.col("__kind"))
    images = [f.select(*columns, CHANGE, F.lit(number).cast("long").alias(VERSION)) for f in (before, after)]
    reduce(DataFrame.unionByName, images).write.parquet(
        f"{root}/{folder}/changes", compression=COMPRESSION
    )
    if changed or moved:
        held = rest.withColumn(BUCKET, bucket_of(bucket_by, buckets))
        data = _replaced(held, fresh, [*columns, CHANGE, VERSION, BUCKET], buckets)
        data.write.partitionBy(BUCKET).parquet(f"{root}/{folder}/data", compression=COMPRESSION)
        if moved:
            changed = sorted(r[0] for r in data.select(BUCKET).distinct().collect())
    place = {**({} if moved else place), **dict.fromkeys(changed, folder)}
    listed = [(b, place.get(b), published, buckets, cleared) for b in range(buckets)]
    append_log(spark, f"{root}/{folder}/buckets", listed, LIST_SCHEMA)
    commit_version(spark, root, number, committed_at, operation, folder)
    return number


def _replaced(held: DataFrame, fresh: DataFrame, columns: Sequence[str], buckets: int) -> DataFrame:
    """The rows of ``held`` whose key is not in ``fresh``, and those of ``fresh``.

    One shuffle by bucket and part serves the comparison and the files.
    """
    parts = 1 + (held.count() + fresh.count()) // (buckets * PART_ROWS)
    part = F.pmod(F.xxhash64(F.lit(parts), KEY), F.lit(parts))
    sides = [df.select(*columns, KEY, F.lit(i).alias("__fresh")) for i, df in enumerate((held, fresh))]
    both = sides[0].unionByName(sides[1]).withColumn("__part", part)
    # Rows of ``held`` that share a key tie, so that all or none of them stay.
    first = Window.partitionBy(BUCKET, "__part", KEY).orderBy(F.desc("__fresh"))
    ranked = both.repartition(BUCKET, "__part").withColumn("__rank", F.rank().over(first))
    return ranked.filter("__rank = 1").select(*columns)


def _decided(fresh, held, keys, bucket_by, buckets, published, number, cleared, decide, beside) -> DataFrame:
    """The changed rows and the rows beside them whose mark is another now, with their marks."""
    near = F.struct(*[F.col(k) for k in bucket_by])
    wanted = beside.select(near.alias("__near"), bucket_of(bucket_by, buckets).alias(BUCKET)).distinct()
    wanted = stage(wanted, "merge-beside")
    if isinstance(held, _Version):
        held = held.rows(sorted(r[0] for r in wanted.select(BUCKET).distinct().collect()))
    held = _waiting(held, published, cleared).withColumn(KEY, F.struct(*[F.col(k) for k in keys]))
    held = held.withColumn("__near", near).join(wanted, "__near", "left_semi").drop("__near")
    held = held.join(fresh.select(KEY), KEY, "left_anti")
    held = held.withColumns({
        VERSION: F.lit(number).cast("long"),
        BUCKET: bucket_of(bucket_by, buckets),
        "__kind": F.lit(None).cast("string"),
        "__mark": F.col(cleared),
    })
    both = decide(fresh.withColumn("__mark", F.lit(None).cast("string")).unionByName(held))
    other = F.col("__kind").isNotNull() | ~F.col("__mark").eqNullSafe(F.col(cleared))
    return stage(both.filter(other).drop("__mark"), "merge-decided")


def _current(spark, root, last, source, keys, buckets):
    """Rows to start from, the place of each bucket, and whether all have to be written anew."""
    if last is None:
        schema = source.withColumns({CHANGE: F.lit("").cast("string"), VERSION: F.lit(0).cast("long")}).schema
        return spark.createDataFrame([], schema), {}, True
    if is_bucketed(last.folder):
        version = _Version(spark, root, last.folder)
        return version.rows(), version.place, version.buckets != buckets
    whole = spark.read.parquet(f"{root}/{last.folder}")
    if CHANGE not in whole.columns:
        whole = whole.withColumn(CHANGE, F.lit(None).cast("string"))
    at = F.when(F.col(CHANGE).isNull(), 0).otherwise(last.version).cast("long")
    return whole.withColumn(VERSION, at), {}, True


def changes_between(
    spark: SparkSession, root: str, keys: Sequence[str], after: int, until: int, fingerprint: str = "HASH"
) -> DataFrame:
    """Row changes from version ``after`` to version ``until``, as ``snapshot_changes`` gives them.

    Read from the change sets of the versions between: of each key its first image and its last.
    A row that changed and changed back is no change. A version that was released, or that was not
    kept in buckets, is an error.
    """
    log = readable(version_log(spark, root))
    wanted = range(after + 1, until + 1)
    folders = {r.version: r.folder for r in log.filter(F.col("version").between(after + 1, until)).collect()}
    missing = [v for v in wanted if not is_bucketed(folders.get(v, ""))]
    if missing or not folders:
        raise LookupError(f"no change sets of versions {missing or [until]} of {root}")
    sets = spark.read.parquet(*[f"{root}/{folders[v]}/changes" for v in wanted])
    columns = [c for c in sets.columns if c not in (CHANGE, VERSION)]
    image = F.struct(*columns, CHANGE)
    place = F.struct(F.col(VERSION), F.col(CHANGE) != BEFORE)
    key = F.struct(*[F.col(k) for k in keys])
    ends = sets.groupBy(key.alias(KEY)).agg(
        F.min_by(image, place).alias("first"), F.max_by(image, place).alias("last")
    )

    def marked(side: str, change: str) -> Column:
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in columns], F.lit(change).alias(CHANGE))

    differs = F.col(f"first.{fingerprint}") != F.col(f"last.{fingerprint}")
    images = F.when(F.col(f"first.{CHANGE}") == INSERT, F.array(marked("last", INSERT))).when(
        differs, F.array(marked("first", BEFORE), marked("last", UPDATE))
    )
    return ends.select(F.inline(images)).select(*columns, CHANGE)


def release_versions(spark: SparkSession, root: str, now: datetime, production: bool = False) -> list[int]:
    """Remove versions that can no longer be read back, but for buckets that later ones refer to.

    A version may be read while it was current within the limit. The log names a released version
    before its files go, so an interrupted release is finished by the next one. Returns the numbers.
    """
    hours = MAX_AGE_HOURS_PRODUCTION if production else MAX_AGE_HOURS
    log = version_log(spark, root)
    rows = sorted(readable(log).collect(), key=lambda r: r.version)
    limit = now - timedelta(hours=hours)
    # The last version committed by the limit was current then, and may still be read.
    first = max((i for i, r in enumerate(rows) if r.committed_at <= limit), default=0)
    gone, kept = rows[:first], rows[first:]
    released = [r.version for r in log.filter(F.col("operation") == RELEASED).collect()]
    if gone:
        append_log(spark, f"{root}/log", [(r.version, now, RELEASED, None) for r in gone], LOG_SCHEMA)
    used = {(r.folder, None) for r in kept}
    for row in kept:
        if is_bucketed(row.folder):
            used |= {(f, b) for b, f in _Version(spark, root, row.folder).place.items()}
    past = log.filter(F.col("folder").isNotNull() & (F.col("operation") != RELEASED)).collect()
    removed = {r.version for r in gone} | set(released)
    for row in past:
        if row.version in removed:
            _remove(spark, f"{root}/{row.folder}", {b for f, b in used if f == row.folder})
    return [r.version for r in gone]


def _remove(spark: SparkSession, folder: str, used: set[int]) -> None:
    """Delete a version's folder, or all of it but the buckets still used."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    if not used:
        system.delete(path(folder), True)
        return
    for part in ("changes", "buckets"):
        system.delete(path(f"{folder}/{part}"), True)
    if system.exists(path(f"{folder}/data")):
        for status in system.listStatus(path(f"{folder}/data")):
            name = status.getPath().getName()
            if name.startswith(f"{BUCKET}=") and int(name.rpartition("=")[2]) not in used:
                system.delete(status.getPath(), True)
