"""Runs over whole days: backfill and heal a day, replay the last days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import reconcile as C
from .control import day_priority
from .enrich import enrich
from .ranges import DAY_MS, absent, one_per_id, scan

IDLE = 0


def day(now_ms: int, days_ago: int, floor_ms: int | None = None) -> tuple[int, int] | None:
    """The UTC day so many days ago, cut to the supported history; None if nothing is left of it."""
    start = now_ms - now_ms % DAY_MS - days_ago * DAY_MS
    first = start if floor_ms is None else max(start, floor_ms)
    return (first, start + DAY_MS) if first < start + DAY_MS else None


def backfill_day(source: DataFrame, target: DataFrame, now_ms: int, days_ago: int, floor_ms: int | None = None) -> DataFrame:
    """The documents that a backfill of one day adds to ``target`` (id), with the ``priority`` of its age."""
    window = day(now_ms, days_ago, floor_ms)
    rows = scan(source, *window) if window else source.where(F.lit(False))
    docs = enrich(absent(target, one_per_id(rows)))
    return docs.withColumn("priority", day_priority(F.lit(days_ago)))


def heal_day(source: DataFrame, target: DataFrame, now_ms: int, days_ago: int, floor_ms: int | None = None) -> DataFrame:
    """The same when nothing else is to be done."""
    return backfill_day(source, target, now_ms, days_ago, floor_ms).withColumn("priority", F.lit(IDLE))


def backfill(source: DataFrame, target: DataFrame, now_ms: int, days: int, floor_ms: int | None = None) -> DataFrame:
    """The documents of all of the last ``days`` days at once, each with its day's priority."""
    last = now_ms - now_ms % DAY_MS + DAY_MS
    first = last - days * DAY_MS if floor_ms is None else max(last - days * DAY_MS, floor_ms)
    docs = enrich(absent(target, one_per_id(scan(source, first, last))))
    return docs.withColumn("priority", day_priority(F.expr(f"({last - DAY_MS} - ts_ms + pmod(ts_ms, {DAY_MS})) div {DAY_MS}")))


def rolling(source: DataFrame, target: DataFrame, now_ms: int, days: int = 10, floor_ms: int | None = None) -> DataFrame:
    """The target after a replay of the last ``days`` days up to now: one root range, halved to sixteenths."""
    window = C.rolling_window(now_ms, days, floor_ms)
    if window is None:
        return target
    ranges = source.sparkSession.createDataFrame([window], "start_ms long, end_ms long")
    return C.reconcile(source, target, ranges, max(1, (window[1] - window[0]) // C.LEAVES))
