import glob
from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from loomfeed import session
from loomfeed.sources import extract, snapshots, staging, tables


def text_of(folder):
    files = sorted(glob.glob(f"{folder}/*.txt"))
    return [open(f, encoding="utf-8").read() for f in files]


def test_extract_text(spark, folder):
    df = spark.createDataFrame(
        [(1, '  say "hi" ', "a\tb\t c", None, datetime(2024, 1, 2, 3, 4, 5, 600000))],
        "id int, Note string, Tabs string, Gap string, At timestamp_ntz",
    )
    extract.write_extract(df.coalesce(1), f"{folder}/x")
    assert text_of(f"{folder}/x") == [
        'ID|NOTE|TABS|GAP|AT\n1|"say \\"hi\\""|a\tbc||2024-01-02 03:04:05.600\n'
    ]


def test_empty_extract_has_a_header(spark, folder):
    extract.write_extract(spark.range(5).filter("id > 9").withColumn("Name", F.lit("x")), f"{folder}/x")
    assert text_of(f"{folder}/x") == ["ID|NAME\n"]


def test_parts_are_bounded_and_complete(spark, folder):
    extract.write_extract(spark.range(0, 100, 1, 2), f"{folder}/x", max_records_per_file=20)
    parts = text_of(f"{folder}/x")
    assert len(parts) == 6
    assert all(p.startswith("ID\n") for p in parts)
    back = extract.read_extract(spark, f"{folder}/x", ["ID"])
    assert back.count() == 100
    assert back.dtypes == [("ID", "string")]


def test_read_delimited_checks_the_header(spark, folder):
    with open(f"{folder}/names.txt", "w", encoding="utf-8") as file:
        file.write("tenant|market\n1|NY\n|CT\n")
    assert rows(tables.read_delimited(spark, f"{folder}/names.txt", ["tenant", "market"])) == [
        ("1", "NY"),
        (None, "CT"),
    ]
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_delimited(spark, f"{folder}/names.txt", ["tenant", "region"]).collect()


def test_tables(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    tables.drop_table(spark, "some_table")
    assert not tables.table_exists(spark, "some_table")
    tables.ensure_table(df, "some_table")
    assert tables.read_table(spark, "some_table").count() == 0
    tables.write_table(df, "some_table", "anything")
    tables.write_table(df, "some_table", "append")
    tables.ensure_table(df, "some_table")
    assert tables.read_table(spark, "some_table").count() == 4
    tables.write_table(df, "some_table", "OverWrite")
    got = tables.read_query(spark, "SELECT v FROM some_table WHERE k = :k", k=2)
    assert rows(got) == [("b",)]
    tables.drop_table(spark, "some_table")
    assert not tables.table_exists(spark, "some_table")


def test_bucketed_state_is_not_shuffled_for_its_key(spark):
    df = spark.range(100).withColumn("v", F.lit("x"))
    tables.write_table(df, "bucketed", "overwrite", bucket_by=["id"], buckets=4)
    plan = (
        tables.read_table(spark, "bucketed").groupBy("id").count()
    )._jdf.queryExecution().executedPlan().toString()
    tables.drop_table(spark, "bucketed")
    assert "Exchange hashpartitioning" not in plan


def test_snapshots(spark, folder):
    with pytest.raises(LookupError):
        snapshots.read_snapshot(spark, f"{folder}/t")
    first, second = datetime(2024, 1, 1), datetime(2024, 2, 1)
    assert snapshots.write_snapshot(spark.range(3), f"{folder}/t", first, snapshots.REBUILD) == 1
    # A run reads the current version while it writes the next.
    current = snapshots.read_snapshot(spark, f"{folder}/t")
    assert snapshots.write_snapshot(current.filter("id > 0"), f"{folder}/t", second) == 2
    # A version without a log entry, as left by a run that was cut off, is not seen.
    spark.range(9).write.parquet(f"{folder}/t/version=3")
    assert snapshots.read_snapshot(spark, f"{folder}/t").count() == 2
    assert snapshots.read_snapshot(spark, f"{folder}/t", datetime(2024, 1, 15)).count() == 3
    with pytest.raises(LookupError):
        snapshots.read_snapshot(spark, f"{folder}/t", datetime(2023, 12, 31))
    # The next run takes the number of the unfinished version over.
    assert snapshots.write_snapshot(spark.range(1), f"{folder}/t", datetime(2024, 3, 1)) == 3
    assert snapshots.read_snapshot(spark, f"{folder}/t").count() == 1


def test_read_back_window(spark, folder):
    root = f"{folder}/t"
    snapshots.write_snapshot(spark.range(3), root, datetime(2024, 1, 1), snapshots.REBUILD)
    log = snapshots.version_log(spark, root)
    snapshots.write_snapshot(spark.range(5), root, datetime(2024, 1, 2))

    def size(now, production):
        return snapshots.read_rebuilt(spark, root, log, now, production).count()

    assert size(datetime(2024, 1, 1, 22), False) == 3
    assert size(datetime(2024, 1, 1, 23), False) == 5
    assert size(datetime(2024, 3, 1), True) == 3
    assert size(datetime(2024, 3, 30, 23), True) == 5


class Settings:
    """A session that only answers where its working files go."""

    def __init__(self, named, master):
        self.conf = {"spark.checkpoint.dir": named} if named else {}
        self.sparkContext = self
        self.master = master
        self.own = None

    def getCheckpointDir(self):  # noqa: N802
        return self.own

    def setCheckpointDir(self, path):  # noqa: N802
        self.own = path


def test_working_folder():
    assert session.work_dir(Settings("hdfs://shared", "yarn")) == "hdfs://shared"
    assert session.work_dir(Settings("hdfs://shared", "local[2]")) == "hdfs://shared"
    own = Settings(None, "local[2]")
    assert session.work_dir(own).startswith("/tmp/run-")
    assert session.work_dir(own) == own.own
    with pytest.raises(RuntimeError):
        session.work_dir(Settings(None, "yarn"))


def test_stage_keeps_rows_and_types(spark):
    df = spark.range(7).withColumn("a", F.lit(None).cast("string"))
    staged = staging.stage(df, "part")
    assert rows(staged) == rows(df)
    assert staged.dtypes == df.dtypes
    assert all(session.work_dir(spark) in f for f in staged.inputFiles())
