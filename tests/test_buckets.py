"""States in buckets, change sets, release of versions, and what else works on stored data."""

import glob
import re
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from loomfeed.operators.changes import CHANGE, snapshot_changes, upsert_by_fingerprint
from loomfeed.operators.detokenize import detokenize
from loomfeed.operators.joins import join_condition, join_where
from loomfeed.operators.rules import apply_reference_lists
from loomfeed.sources import buckets, consumers, extract, points, snapshots, tables

NOW = datetime(2024, 6, 10, 5)
SCHEMA = "a int, b string, v string, HASH string"


def state(spark, values):
    return spark.createDataFrame([(a, b, v, f"h{v}") for a, b, v in values], SCHEMA)


def merge(spark, root, values, hours=0, **options):
    at = NOW + timedelta(hours=hours)
    return buckets.merge_state(state(spark, values), root, ["a", "b"], at, buckets=8, **options)


def files(df):
    return {re.search(r"(buckets-\d+)-[^/]*/data/__bucket=(\d+)", f).groups() for f in df.inputFiles()}


def test_merge_equals_upsert(spark, folder):
    first = [(i, None if i % 5 == 0 else "x", "1") for i in range(40)]
    second = [(i, b, "2" if i % 7 == 0 else "1") for i, b, _ in first[5:]] + [(50, None, "1"), (None, None, "1")]
    merge(spark, folder, first)
    merge(spark, folder, second, 1, published=1)
    old = state(spark, first)
    wanted = upsert_by_fingerprint(old, state(spark, second), ["a", "b"])
    assert rows(snapshots.read_snapshot(spark, folder)) == rows(wanted)
    found = buckets.changes_between(spark, folder, ["a", "b"], 1, 2)
    both = snapshot_changes(old, state(spark, second), ["a", "b"]).filter(F.col(CHANGE) != "delete")
    assert rows(found) == rows(both)
    # The state as of the first version is still there, its rows as inserts.
    assert {r[CHANGE] for r in snapshots.read_snapshot(spark, folder, NOW).collect()} == {"insert"}


def test_untouched_buckets_are_carried_over(spark, folder):
    merge(spark, folder, [(i, "x", "1") for i in range(100)])
    merge(spark, folder, [(3, "x", "2")], 1)
    now = files(snapshots.read_snapshot(spark, folder))
    assert len(now) == 8 and sum(name == "buckets-2" for name, _ in now) == 1
    # Nothing differs: no bucket is written, and none of other buckets is read.
    merge(spark, folder, [(3, "x", "2")], 2)
    assert files(snapshots.read_snapshot(spark, folder)) == now
    listed = {r.bucket: r.folder for r in buckets.bucket_list(spark, folder, snapshots.latest_version(
        snapshots.version_log(spark, folder)).first().folder).collect()}
    version = buckets._Version(spark, folder, snapshots.latest_version(snapshots.version_log(spark, folder)).first().folder)
    touched = [b for b, f in listed.items() if f.startswith("buckets-2-")]
    assert {int(b) for _, b in files(version.rows(touched))} == set(touched)


def test_waiting_changes(spark, folder):
    merge(spark, folder, [(1, "x", "1"), (2, "x", "1")])
    merge(spark, folder, [(1, "x", "2")], 1)  # the first version was not published
    assert rows(snapshots.read_snapshot(spark, folder), "a", "v", CHANGE) == [(1, "2", "insert"), (2, "1", "insert")]
    merge(spark, folder, [(1, "x", "3")], 2, published=2)
    assert rows(snapshots.read_snapshot(spark, folder), "a", "v", CHANGE) == [(1, "3", "update_postimage"), (2, "1", None)]
    merge(spark, folder, [(1, "x", "3")], 3, published=3)
    assert {r[CHANGE] for r in snapshots.read_snapshot(spark, folder).collect()} == {None}


def test_marks_are_decided_and_cleared(spark, folder):
    """Rows beside a change get a mark without being a change; marks end when they are published."""

    def run(values, lines, hours, published):
        beside = spark.createDataFrame([(a,) for a in lines], "a int")
        mark = F.when(F.col(CHANGE).isNotNull(), F.col(CHANGE)).when(F.col("a").isin(lines), "beside")
        merge(
            spark, folder, values, hours, published=published, bucket_by=["a"], cleared="v", beside=beside,
            decide=lambda rows: rows.withColumn("v", F.when(F.col("v") == "", F.coalesce(mark, F.lit(""))).otherwise(F.col("v"))),
        )
        return sorted(tuple(r) for r in snapshots.read_snapshot(spark, folder).select("a", "v", CHANGE).collect())

    def unmarked(*pairs):
        return [(a, b, "") for a, b in pairs]

    first = [(i, "x", "insert", "insert") for i in range(12)]
    assert run(unmarked(*[(i, "x") for i in range(12)]), [3], 0, 0) == [(a, v, c) for a, _, v, c in first]
    # All was published; a key beside that the state lacks is passed over.
    second = run(unmarked((0, "x"), (20, "x")), [2, 5, 99], 1, 1)
    wanted = {2: ("beside", None), 5: ("beside", None), 20: ("insert", "insert")}
    assert second == [(a, *wanted.get(a, ("", None))) for a in [*range(12), 20]]
    # Nothing was published: marks stay, and nothing is written.
    now = files(snapshots.read_snapshot(spark, folder))
    assert run([], [2, 5], 2, 1) == second and files(snapshots.read_snapshot(spark, folder)) == now
    assert rows(buckets.changes_between(spark, folder, ["a", "b"], 1, 3), "a", CHANGE) == [(20, "insert")]
    assert {v for _, v, _ in run([], [], 3, 3)} == {""}


def test_repeated_keys(spark, folder):
    with pytest.raises(Exception, match="several source rows for one key"):
        merge(spark, folder, [(1, "x", "1"), (1, "x", "2")])
    merge(spark, folder, [(1, "x", "1"), (1, "x", "2")], order=[F.col("v").desc()])
    assert rows(snapshots.read_snapshot(spark, folder), "v") == [("2",)]


def test_whole_versions_and_other_bucket_numbers_are_taken_over(spark, folder):
    old = state(spark, [(1, "x", "1"), (2, "x", "1")]).withColumn(CHANGE, F.lit("insert"))
    snapshots.write_snapshot(old, folder, NOW)
    merge(spark, folder, [(3, "x", "1")], 1, published=1)
    assert rows(snapshots.read_snapshot(spark, folder), "a", CHANGE) == [(1, None), (2, None), (3, "insert")]
    again = state(spark, [(1, "x", "2")])
    buckets.merge_state(again, folder, ["a", "b"], NOW + timedelta(hours=2), buckets=3, published=2)
    assert rows(snapshots.read_snapshot(spark, folder), "a", CHANGE) == [(1, "update_postimage"), (2, None), (3, None)]
    with pytest.raises(LookupError):
        buckets.changes_between(spark, folder, ["a", "b"], 0, 3)


def test_empty_states(spark, folder):
    merge(spark, folder, [])
    assert snapshots.read_snapshot(spark, folder).count() == 0
    merge(spark, folder, [(1, None, "1")], 1)
    assert rows(snapshots.read_snapshot(spark, folder), "a", CHANGE) == [(1, "insert")]


def test_release(spark, folder):
    for hours, value in ((0, "1"), (10, "2"), (20, "3"), (30, "4")):
        merge(spark, folder, [(i, "x", value) for i in range(20 if hours == 0 else 3)], hours)
    # 23 hours before is hour 17, when the second version was current.
    assert buckets.release_versions(spark, folder, NOW + timedelta(hours=40)) == [1]
    oldest = snapshots.read_snapshot(spark, folder, NOW + timedelta(hours=17))
    assert rows(oldest.groupBy("v").count()) == [("1", 17), ("2", 3)]
    with pytest.raises(LookupError):
        snapshots.read_snapshot(spark, folder, NOW + timedelta(hours=9))
    assert not glob.glob(f"{folder}/buckets-1-*/changes")
    assert glob.glob(f"{folder}/buckets-1-*/data")  # buckets that later versions refer to
    assert buckets.release_versions(spark, folder, NOW + timedelta(hours=40)) == []
    # In production they stay 2,159 hours.
    assert buckets.release_versions(spark, folder, NOW + timedelta(hours=2000), production=True) == []
    merge(spark, folder, [(i, "x", "5") for i in range(20)], 50)
    assert buckets.release_versions(spark, folder, NOW + timedelta(hours=90)) == [2, 3, 4]
    assert not glob.glob(f"{folder}/buckets-[1-4]-*")
    assert rows(snapshots.read_snapshot(spark, folder).groupBy("v").count()) == [("5", 20)]


def test_of_two_writers_one_counts(spark, folder):
    for name in ("version=1-b", "version=1-a"):
        state(spark, [(1, name[-1], "1")]).write.parquet(f"{folder}/{name}")
    snapshots.commit_version(spark, folder, 1, NOW, snapshots.MERGE, "version=1-b")
    snapshots.commit_version(spark, folder, 1, NOW, snapshots.MERGE, "version=1-a")
    with pytest.raises(RuntimeError):
        snapshots.commit_version(spark, folder, 1, NOW, snapshots.MERGE, "version=1-c")
    assert rows(snapshots.read_snapshot(spark, folder), "b") == [("a",)]


def test_a_point_is_fixed(spark, folder):
    roots = {n: f"{folder}/{n}" for n in ("x", "y")}
    for root in roots.values():
        snapshots.write_snapshot(state(spark, [(1, "x", "1")]), root, NOW)
    none = spark.createDataFrame([], snapshots.LOG_SCHEMA)
    point = points.fix_point(spark, roots, none, NOW + timedelta(hours=1))
    snapshots.write_snapshot(state(spark, [(1, "x", "2")]), roots["x"], NOW + timedelta(minutes=5))
    assert rows(point.read("x"), "v") == [("1",)] and point.lookback == NOW.date()
    early = spark.createDataFrame([(1, NOW - timedelta(hours=2), snapshots.REBUILD, "r")], snapshots.LOG_SCHEMA)
    with pytest.raises(LookupError, match="x, y"):
        points.fix_point(spark, roots, early, NOW)


def test_one_header(spark, folder):
    df = spark.createDataFrame([(i, f'a|"{i}"') for i in range(50)], "n int, t string")
    extract.write_extract_parts(df.repartition(3), folder, max_records_per_file=10)
    parts = sorted(glob.glob(f"{folder}/*.txt"))
    assert open(parts[0]).read() == "N|T\n" and len(parts) >= 6
    whole = "".join(open(p).read() for p in parts)
    assert whole.count("N|T") == 1 and whole.count("\n") == 51
    assert rows(extract.read_extract_parts(spark, folder, ["N", "T"]).filter("N = '7'")) == [("7", 'a|"7"')]
    manifest = {r.file: r.n for r in extract.read_manifest(spark, folder).collect()}
    assert sum(manifest.values()) == 50 and set(manifest) <= {p.rpartition("/")[2] for p in parts}
    extract.write_extract_parts(df.limit(0), folder)
    assert [open(p).read() for p in sorted(glob.glob(f"{folder}/*.txt"))][0] == "N|T\n"
    assert extract.read_extract_parts(spark, folder, ["N", "T"]).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        extract.read_extract_parts(spark, f"{folder}/_manifest", ["N"])


def test_deletes_are_finished(spark, folder, monkeypatch):
    tag = folder.rsplit("-", 1)[-1].lower()
    names = [f"sent_{n}_{tag}" for n in ("a", "b")]
    for name in names:
        for market, consumer in (("ny", "C"), ("ny", ""), ("ct", "C")):
            rows_ = spark.createDataFrame([(1,)], "id int")
            consumers.store_sent(rows_, name, market, consumer, path=f"{folder}/{name}")
    log, calls = f"{folder}/log", []

    def once(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("cut off")
        return tables.drop_matching(*args)

    monkeypatch.setattr(consumers, "drop_matching", once)
    with pytest.raises(RuntimeError):
        consumers.delete_consumer(spark, names, "NY", "C", log, NOW)
    assert [spark.table(n).count() for n in names] == [2, 3]
    assert consumers.finish_deletes(spark, names, log) == 1
    for name in names:
        assert rows(spark.table(name), consumers.MARKET, consumers.CONSUMER) == [("ct", "C"), ("ny", "__none")]
    assert consumers.finish_deletes(spark, names, log) == 0
    assert len(consumers.DOMAINS) == 12


def test_detokenise_reads_the_vault_once(spark, folder):
    vault = spark.createDataFrame([("t1", "A"), ("t2", "B"), ("t2", "C"), (None, "N")], "token string, value string")
    vault.write.parquet(f"{folder}/vault")
    people = [(1, "t1", "t2"), (2, None, None), (3, "t9", "t1"), (3, "t9", "t1"), (4, None, "t2")]
    df = spark.createDataFrame(people, "id int, x string, y string")
    clear = detokenize(df, ["x", "y"], spark.read.parquet(f"{folder}/vault"), spread_by=["id"])
    assert rows(clear) == [(1, "A", "C"), (2, None, None), (3, None, "A"), (3, None, "A"), (4, None, "C")]
    assert clear.columns == df.columns
    plan = clear._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan parquet") == 1


def test_lists_agree_with_joins(spark):
    df = spark.createDataFrame([(v,) for v in ("a", "B", "c", "", None, "b")], "v string")
    lists = [["A", "B"], ["", "C"], []]
    frames = [spark.createDataFrame([(x,) for x in v], "value string") for v in lists]
    for include in (None, *frames):
        for exclude in (None, *frames):
            written = apply_reference_lists(df, "v", include, exclude)
            joined = apply_reference_lists(df, "v", include, exclude, literal_values=-1)
            assert rows(written) == rows(joined)
    plan = apply_reference_lists(df, "v", frames[0], frames[1])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_join_conditions_are_checked(spark):
    left = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x")], "k int, v string")
    right = spark.createDataFrame([(1, "x", 0), (2, "y", 0), (2, "x", 1)], "k int, w string, gone int")
    joined = join_where(left, right, [("k", "k")], "e.v = d.w OR e.v = 'y'", where=F.col("gone") == 0)
    assert joined.columns == left.columns and rows(joined) == [(1, "x"), (1, "y")]
    with pytest.raises(ValueError):
        join_condition(left, right, "e.k + d.k")
    for text in ("e.missing = 1", "k = 1"):
        with pytest.raises(Exception, match="UNRESOLVED|AMBIGUOUS"):
            join_condition(left, right, text)


def test_settings_of_a_run(spark):
    from datetime import date

    from fixtures import eligibility_inputs, lab, lab_inputs

    from loomfeed.plans.labs import lab_current
    from loomfeed.plans.settings import SettingTables, resolve

    names = spark.createDataFrame(
        [("1", "NY", "NYFILE", "SDM3", "y"), ("1", "UT", "A", "SDM2", None), ("2", "UT", "B", "SDM3", None)],
        "tenant string, target_market string, filename string, sdm_type string, eid_applied string",
    )
    configs = spark.createDataFrame(
        [("Claims", '("NY","UT")', None, "MAIN", "FEED", "S", None), ("Claims", "ZZ", "", "P", "", "", "3")],
        "domain string, markets string, consumer string, project string, system string, status_set string, "
        "lookback_months string",
    )
    columns = (
        "source_attribute string, source_systems string, attribute string, operator string, match_value string, "
        "default_value string, priority int, active_value string, domain string, target_market string, consumer string"
    )
    rule = ("LAB_RESULT_VALUE", "all", "LAB_RESULT_VALUE", "=", None)
    rules = spark.createDataFrame(
        [
            (*rule, "'mine'", 3, "Y", "lab", "NY", None),
            (*rule, "'idle'", 1, "N", "lab", "NY", None),
            (*rule, "'other market'", 1, "Y", "lab", "UT", None),
            (*rule, "'other consumer'", 1, "Y", "lab", "NY", "SHOP"),
            (*rule, "'other domain'", 1, "Y", "eligibility", "NY", None),
        ],
        columns,
    )
    lists = spark.createDataFrame(
        [("Y", "PROVIDER_GROUP_TIN", "Eligibility", "ALL", "NY", "T1,T2", None)],
        "active_flg string, reference string, domain string, consumer string, market string, "
        "value_exclusion string, value_inclusion string",
    )
    tables_ = SettingTables(names, configs, rules, lists)
    found = resolve(tables_, "ny", (1,), date(2024, 6, 10))
    assert found.enterprise_ids and found.config.extended and found.config.lookback_months == 39
    assert (found.config.file_prefix, found.config.project, found.config.system) == ("NYFILE", "MAIN", "FEED")
    # Raw rules hold those of others; the run's own inputs do not.
    inputs = lab_inputs(spark, [lab(1, lab_result_value_raw=None)])
    mine = found.inputs(inputs, "lab")
    assert rows(lab_current(found.config, mine), "LAB_RESULT_VALUE") == [("mine",)]
    spans = found.inputs(eligibility_inputs(spark, []), "eligibility")
    assert rows(spans.tin_exclude) == [("T1",), ("T2",)]
    with pytest.raises(ValueError, match="several values"):
        resolve(tables_, "ut", (1,), date(2024, 6, 10))
    with pytest.raises(LookupError):
        resolve(tables_, "zz", (1,), date(2024, 6, 10))


def test_merged_rows_are_shuffled_once(spark):
    """The comparison with the state and the files by bucket share one shuffle."""
    rows = [(1, "a", 0), (2, "b", 0), (2, "c", 0), (None, "d", 1), (4, "e", 1)]
    held = spark.createDataFrame(rows, "k long, v string, __bucket int").withColumn("__key", F.struct("k"))
    fresh = spark.createDataFrame([(2, "B", 0), (None, "D", 1), (5, "f", 1)], "k long, v string, __bucket int")
    fresh = fresh.withColumn("__key", F.struct("k"))
    data = buckets._replaced(held, fresh, ["k", "v", "__bucket"], 2)
    assert data._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    assert sorted(r.v for r in data.collect()) == ["B", "D", "a", "e", "f"]
