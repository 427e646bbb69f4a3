from catalink.plans.cve_status import merge_fix_status

COLS = "pkg_vrs_id long, vulnerability_id long, changelog_string_number long, fixed_tracker_string_number long, manual_input_user_id long"


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_upsert_first_non_null_wins(spark):
    existing = spark.createDataFrame([(1, 1, None, 7, 42), (2, 2, 5, None, None)], COLS)
    incoming = spark.createDataFrame([(1, 1, 9, 8, None), (2, 2, 6, 3, None), (3, 3, 1, None, None)], COLS)
    merged = merge_fix_status(existing, incoming)
    assert _rows(merged) == [(1, 1, 9, 7, 42), (2, 2, 5, 3, None), (3, 3, 1, None, None)]


def test_upsert_idempotent(spark):
    existing = spark.createDataFrame([(1, 1, None, 7, 42)], COLS)
    incoming = spark.createDataFrame([(1, 1, 9, 8, None), (3, 3, 1, None, None)], COLS)
    once = merge_fix_status(existing, incoming)
    twice = merge_fix_status(once, incoming)
    assert _rows(once) == _rows(twice)


def test_run_fix_status_without_evidence_leaves_table(spark, tmp_path):
    from catalink.plans.cve_status import run_fix_status
    from catalink.sources.sinks import write_replace

    loc = str(tmp_path / "fixed")
    write_replace(spark.createDataFrame([(1, 1, 2, 3, 4)], COLS), loc)
    assert run_fix_status(spark, loc, spark.createDataFrame([], COLS)) == 0
    assert _rows(spark.read.parquet(loc)) == [(1, 1, 2, 3, 4)]
    assert run_fix_status(spark, loc, spark.createDataFrame([(1, 1, 9, None, None), (5, 5, 1, 1, None)], COLS)) == 2
    assert _rows(spark.read.parquet(loc)) == [(1, 1, 2, 3, 4), (5, 5, 1, 1, None)]
