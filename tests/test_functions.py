import datetime as dt


from catalink.functions import clean as C
from catalink.functions.cve import cve_tokens, explode_cves


def test_cve_tokens_pattern_edges(spark):
    df = spark.createDataFrame(
        [
            (1, "Fix CVE-2020-12345678 and CVE-2020-1234, again CVE-2020-1234"),
            (2, "lower cve-2020-1234 is not matched; CVE-20-1234 neither"),
            (3, None),
            (4, "xCVE-2019-0001y"),
        ],
        "id long, t string",
    )
    rows = {r.id: r.c for r in df.select("id", cve_tokens("t").alias("c")).collect()}
    assert rows[1] == ["CVE-2020-1234567", "CVE-2020-1234"]  # cut after 7 digits, no boundary, distinct
    assert rows[2] == []
    assert rows[3] is None  # NULL text gives no match instead of an error
    assert rows[4] == ["CVE-2019-0001"]


def test_explode_cves_skips_text_without_match(spark):
    df = spark.createDataFrame([(1, "CVE-2001-0001 CVE-2001-0001"), (2, None), (3, "none")], "id long, t string")
    out = explode_cves(df, "t").collect()
    assert [(r.id, r.cve) for r in out] == [(1, "CVE-2001-0001")]


def test_epoch_conversions(spark):
    df = spark.createDataFrame([(0,), (None,), (86400,)], "t long")
    run_ts = "2025-02-11 00:00:00"
    out = df.select(
        C.epoch_to_ts("t").alias("x7"),
        C.epoch_to_ts_zero_null("t").alias("x8"),
        C.epoch_or_load_time("t", run_ts, zero_is_null=True).alias("x5"),
        C.epoch_or_load_time("t", run_ts, zero_is_null=False).alias("x6"),
    ).collect()
    epoch, day, load = dt.datetime(1970, 1, 1), dt.datetime(1970, 1, 2), dt.datetime(2025, 2, 11)
    assert [tuple(r) for r in out] == [(epoch, None, load, epoch), (None, None, load, load), (day, day, day, day)]


def test_defaults_and_sentinels(spark):
    df = spark.createDataFrame([("", 0, None), (None, 5, "x")], "v string, n long, s string")
    out = df.select(
        C.version_or_default("v").alias("v"), C.null_if_zero("n").alias("n"),
        C.text_or_empty("s").alias("s"), C.present("v").alias("p"),
    ).collect()
    assert [tuple(r) for r in out] == [("0.0.0", None, "", False), ("0.0.0", 5, "x", False)]


def test_any_epoch_is_converted_or_null(spark):
    from catalink.functions.clean import epoch_in_range, epoch_to_ts

    df = spark.createDataFrame([(0,), (-1,), (86399,), (1700000000,), (1700000000000,), (9 * 10**15,), (None,)], "t long")
    got = df.select("t", epoch_to_ts("t").cast("string").alias("s"), epoch_in_range("t").alias("ok")).collect()
    values = {r.t: (r.s, r.ok) for r in got}
    assert "55840" in values.pop(1700000000000)[0]
    assert values == {
        0: ("1970-01-01 00:00:00", True),
        -1: ("1969-12-31 23:59:59", True),
        86399: ("1970-01-01 23:59:59", True),
        1700000000: ("2023-11-14 22:13:20", True),
        9 * 10**15: (None, False),
        None: (None, True),
    }
