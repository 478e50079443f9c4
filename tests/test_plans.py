"""What the plans of the main queries look like: filters reach the files, no nested loops over events, few scans."""

import pytest
from pyspark.sql import functions as F

from ledgerline import catalogue
from ledgerline.operators import reconcile as C
from ledgerline.operators import ranges as R
from ledgerline.sources.events import NOW_MS, source, target

SF = "/root/testdata/sf0.001"
DAY = 86_400_000


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["range_scan", "range_count", "closed_range_count", "first_last_ids", "mid_window_ids", "membership_count", "keyset_page", "reindex_window", "backfill_day", "tail_poll"])
def test_time_filters_reach_the_files(spark, name):
    scans = [line for line in plan(catalogue.queries()[name](spark, SF)).splitlines() if "FileScan parquet" in line and "events.parquet" in line]
    assert scans and any("GreaterThan" in s and "(ts," in s for s in scans)
    if name not in ("reindex_window",):
        assert all("(ts," in s for s in scans)


def test_reconcile_is_linear(spark):
    """Neither nested loops nor more scans with more ranges."""
    days = lambda n: spark.range(n).select((NOW_MS - (F.col("id") + 1) * DAY).alias("start_ms"), (NOW_MS - F.col("id") * DAY).alias("end_ms"))
    text = plan(C.decisions(source(spark, SF), target(spark, SF), days(30)))
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    # Two scans a side in all, of which one each ran before (its small result is read back); the target has two parts.
    assert text.count("events.parquet") <= 1 + 2
    due = spark.createDataFrame([(NOW_MS - 12 * DAY, NOW_MS - 10 * DAY)], "s long, e long")
    text = plan(C.full_replace(source(spark, SF), target(spark, SF), due))
    assert "NestedLoop" not in text and "SortMergeJoin" not in text and text.count("events.parquet") <= 2


def test_windows_of_any_length(spark):
    """Ranges that no power of two divides: each node by a plain count of its rows."""
    ranges = [(NOW_MS - 29 * DAY + 7, NOW_MS - 25 * DAY), (NOW_MS - 20 * DAY, NOW_MS - 20 * DAY + 38), (NOW_MS - 9 * DAY, NOW_MS - 5 * DAY - 12345)]
    got = C.decisions(source(spark, SF), target(spark, SF), spark.createDataFrame(ranges, "start_ms long, end_ms long")).collect()
    a, b = ([(r["timestamp_ms"], r["id"]) for r in t(spark, SF).collect()] for t in (source, target))
    assert {(r["s"], r["e"]) for r in got if r["level"] == 0} == set(ranges)
    for r in got:
        assert r["source_n"] == sum(r["s"] <= t < r["e"] for t, _ in a) and r["target_n"] == sum(r["s"] <= t < r["e"] for t, _ in b)


def test_empty_fetch_deletes_nothing(spark):
    kind = "id string, timestamp_ms long, message string, log_group string"
    src = spark.createDataFrame([("1", 5, "x", "g"), ("2", 1005, "  ", "g"), ("9", 2500, "elsewhere", "g")], kind)
    dst = spark.createDataFrame([("o1", 6, "x", "g"), ("o2", 1006, "x", "g"), ("o3", 3006, "x", "g"), ("9", 7, "moved", "g")], kind)
    due = spark.createDataFrame([(0, 1000), (1000, 2000), (3000, 4000)], "s long, e long")
    got = sorted(r["id"] for r in C.full_replace(src, dst, due, 1000).collect())
    # o1 is an orphan of a range with rows; 9 too, since its range's own fetch has it not; the others had no usable row.
    assert got == ["1", "o2", "o3"]


def test_same_windows(spark):
    a = spark.createDataFrame([("1", 1), ("2", 2), ("3", 11)], "id string, timestamp_ms long")
    b = spark.createDataFrame([("1", 1), ("x", 2), ("3", 11)], "id string, timestamp_ms long")
    w = spark.createDataFrame([(0, 10), (10, 20), (20, 30)], "s long, e long")
    assert sorted((r["s"], r["same"]) for r in R.same_windows(a, b, w, bin_ms=10).collect()) == [(0, False), (10, True), (20, True)]
