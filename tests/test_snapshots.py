"""Snapshot store: visibility, conflicts, bucketed upserts, footers' counts, the bucketed crosswalk."""

import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalink.operators.crosswalk import only_new, remap
from catalink.plans import jobs
from catalink.plans.cve_status import STATUS, upsert_fix_status
from catalink.sources.bucketed import read_bucketed_crosswalk, write_bucketed_crosswalk
from catalink.sources.catalog import conform, read_sources
from catalink.sources.fixtures import fixture_catalogue
from catalink.sources.schemas import TARGET_SCHEMAS
from catalink.sources.sinks import write_replace
from catalink.sources.snapshots import Buckets, CommitConflict, SnapshotStore, file_row_counts, upsert_buckets

ID = T.StructType([T.StructField("id", T.LongType())])
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def written(commit, table, df, append=False):
    write_replace(df, commit.path(table))
    (commit.append if append else commit.replace)(table)
    return commit


def ids(store, table, snapshot=None):
    return sorted(r["id"] for r in store.read(table, ID, snapshot).collect())


def test_readers_see_all_of_a_run_or_nothing(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    assert store.snapshot().version == 0 and ids(store, "a") == []
    first = written(store.begin(), "a", spark.range(2))
    written(first, "b", spark.range(3)).publish()
    opened = store.read("a", ID)
    second = written(store.begin(), "a", spark.range(10, 12), append=True)
    assert ids(store, "a") == [0, 1] and ids(store, "b") == [0, 1, 2]  # one table written, the other not yet
    written(second, "b", spark.range(7, 8))
    assert ids(store, "a") == [0, 1] and ids(store, "b") == [0, 1, 2]  # all written, not published
    second.publish()
    assert ids(store, "a") == [0, 1, 10, 11] and ids(store, "b") == [7]
    assert sorted(r["id"] for r in opened.collect()) == [0, 1]  # a frame opened before stays as it was
    assert ids(store, "b", store.snapshot(1)) == [0, 1, 2]


def test_a_run_that_dies_leaves_nothing_visible_and_nothing_of_others_is_dropped(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    written(store.begin(), "a", spark.range(2)).publish()
    running = written(store.begin(), "a", spark.range(5, 6), append=True)  # dies here, or is still at work
    assert ids(store, "a") == [0, 1]
    assert store.vacuum() == 0  # young folders may belong to a running load
    running.publish()
    assert ids(store, "a") == [0, 1, 5]
    written(store.begin(), "a", spark.range(1)).publish()
    assert store.vacuum(keep=1, older_than_s=-60) == 2
    assert ids(store, "a") == [0] and store.versions() == [3]


def test_the_second_of_two_interleaved_runs_fails(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    one = written(store.begin(), "a", spark.range(1))
    two = written(store.begin(), "a", spark.range(2))
    one.publish()
    with pytest.raises(CommitConflict):
        two.publish()
    assert ids(store, "a") == [0] and store.versions() == [1]
    assert os.listdir(tmp_path / "_data") == [one.run]


def test_interleaved_loads_hand_out_no_key_twice(spark, tmp_path, monkeypatch):
    fx = fixture_catalogue(spark, "/root/testdata/sf0.001")
    for name, df in fx.sources.items():
        df.write.parquet(str(tmp_path / "all" / name))
    everything = read_sources(spark, str(tmp_path / "all"))
    half = everything.replace(projects=everything.projects.where("id % 2 = 0"))
    targets, ts = str(tmp_path / "targets"), "2025-02-11 00:00:00"
    real, meanwhile = jobs.incremental_load, []

    def load(*args):
        if not meanwhile:  # another load runs in full between this one's start and its publishing
            meanwhile.append(True)
            jobs.run_incremental_load(spark, half, targets, ts)
        return real(*args)

    monkeypatch.setattr(jobs, "incremental_load", load)
    counts = jobs.run_incremental_load(spark, everything, targets, ts)
    assert SnapshotStore(spark, targets).versions() == [1, 2]
    pairs = jobs.read_loaded_crosswalk(spark, targets)
    assert pairs.groupBy("table_name", "old_id").count().where("count > 1").count() == 0
    projects = jobs.read_loaded(spark, targets, "project")
    assert projects.count() == projects.select("prj_id").distinct().count() == pairs.where("table_name = 'projects'").count()
    assert 0 < counts["project"] < projects.count()


def status_rows(spark, rows):
    schema = TARGET_SCHEMAS[STATUS]
    return conform(spark.createDataFrame(rows, schema), schema)


def test_upsert_rewrites_only_touched_buckets(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    commit = store.begin()
    rows, touched = upsert_fix_status(commit, status_rows(spark, [(v, c, v * 10, None, None) for v in range(40) for c in range(3)]), 16)
    commit.publish()
    assert rows == 120 and len(touched) == 16
    place = lambda: {b: (f, sorted(os.listdir(tmp_path / f))) for b, f in store.snapshot().tables[STATUS].by_bucket.items()}
    before = place()
    commit = store.begin()
    rows, touched = upsert_fix_status(commit, status_rows(spark, [(3, 1, 999, 7, None), (100, 0, 5, None, 42)]))
    commit.publish()
    after = place()
    assert rows == 2 and 1 <= len(touched) <= 2
    assert {b for b in before if before[b] == after[b]} == set(before) - set(touched)
    got = {(r[0], r[1]): tuple(r)[2:] for r in store.read(STATUS, TARGET_SCHEMAS[STATUS]).collect()}
    want = {(v, c): (v * 10, None, None) for v in range(40) for c in range(3)}
    want |= {(3, 1): (30, 7, None), (100, 0): (5, None, 42)}
    assert got == want
    commit = store.begin()
    assert upsert_fix_status(commit, status_rows(spark, [(1, 1, 1, 1, 1)]).limit(0)) == (0, []) and commit.tables == commit.base.tables
    with pytest.raises(ValueError):
        upsert_buckets(commit, STATUS, status_rows(spark, [(1, 1, 1, 1, 1)]), TARGET_SCHEMAS[STATUS], Buckets(("vulnerability_id",), 4), lambda old, new: new)


def test_upsert_reads_only_touched_buckets(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    commit = store.begin()
    upsert_fix_status(commit, status_rows(spark, [(v, 0, 1, None, None) for v in range(64)]), 8)
    commit.publish()
    some = store.read(STATUS, TARGET_SCHEMAS[STATUS], buckets=[2, 5])
    assert {f.split("/bucket=")[1].split("/")[0] for f in some.inputFiles()} == {"2", "5"}


def test_counts_are_those_of_committed_files_after_a_retried_task(tmp_path):
    """A task that fails after it has handed on its rows is run again; the rows count once."""
    script = f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        from pyspark import TaskContext
        from catalink.session import build_session
        from catalink.sources.snapshots import file_row_counts
        spark = build_session("local[2,3]", "retry", 2)

        def flaky(batches):
            yield from batches
            if TaskContext.get().attemptNumber() == 0:
                raise RuntimeError("lost")

        df = spark.range(0, 1000, 1, 4).mapInArrow(flaky, "id long")
        df.write.parquet({str(tmp_path / "t")!r})
        print("COUNTS", file_row_counts(spark, {{"t": ({str(tmp_path / "t")!r}, df.schema)}}))
    """
    out = subprocess.run([sys.executable, "-c", textwrap.dedent(script)], capture_output=True, text=True, timeout=120)
    assert "COUNTS {'t': 1000}" in out.stdout, out.stderr[-2000:]


def test_counts_read_no_column(spark, tmp_path):
    write_replace(spark.range(7), str(tmp_path / "a"))
    write_replace(spark.range(0), str(tmp_path / "b"))
    assert file_row_counts(spark, {n: (str(tmp_path / n), ID) for n in "ab"}) == {"a": 7, "b": 0}
    assert file_row_counts(spark, {}) == {}
    plan = spark.read.schema(ID).parquet(str(tmp_path / "a")).agg(F.count(F.lit(1)))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


@pytest.fixture(scope="module")
def crosswalk_folders(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("xw")
    folders = []
    for k in range(2):
        pairs = spark.range(k * 5000, (k + 1) * 5000).selectExpr("if(id % 10 = 0, 'projects', 'changes') table_name", "id old_id", "id + 7 new_id")
        write_bucketed_crosswalk(pairs, f"{root}/{k}", 8)
        folders.append(f"{root}/{k}")
    return folders


def exchanges_on(plan, column):
    return [line for line in plan.splitlines() if "Exchange" in line and column in line]


def test_bucketed_crosswalk_is_not_shuffled(spark, crosswalk_folders):
    crosswalk = read_bucketed_crosswalk(spark, crosswalk_folders, 8)
    assert crosswalk.count() == 10000 and crosswalk.where("table_name = 'projects'").count() == 1000
    rows = spark.range(0, 20000, 3).selectExpr("id", "id prj_ref", "id old_id")
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df, n in ((remap(rows, crosswalk, "changes", "prj_ref", "chg"), 3000), (only_new(rows, crosswalk, "projects"), 6667 - 334)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == 1, plan  # the other side only
            assert "SelectedBucketsCount: 8 out of 8" in plan
            assert df.count() == n
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


def test_bucketed_crosswalk_edge_cases(spark, tmp_path):
    assert read_bucketed_crosswalk(spark, []).count() == 0
    write_bucketed_crosswalk(read_bucketed_crosswalk(spark, []), str(tmp_path / "none"), 4)
    assert read_bucketed_crosswalk(spark, [str(tmp_path / "none")], 4).count() == 0
