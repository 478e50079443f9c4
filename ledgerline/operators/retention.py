"""Retention: which segments go, in what order, and how far the supported history begins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import DAY_MS, segment_date_ms
from ..sources.state import merge_watermarks

LEAST_LONG = -(1 << 63)


def delete_candidates(segments: DataFrame, cutoff_ms: int, emergency: bool) -> DataFrame:
    """(stable_alias, index, sort_key_ms, watermark_ms, store_bytes, reason) of ``segments`` (stable_alias, index, seq,
    max_ts_ms, store_bytes): the old ones but the last of each stream, which is written to; if none is old and
    ``emergency``, the first."""
    down, up = Window.partitionBy("stable_alias").orderBy(F.desc("seq")), Window.partitionBy("stable_alias").orderBy("seq")
    read = segments.withColumns({"last": F.row_number().over(down) == 1, "nth": F.row_number().over(up)}).where("not last")
    ts, day = F.when(F.col("max_ts_ms") > 0, F.col("max_ts_ms")), segment_date_ms(F.col("index"))
    read = read.withColumns({"ts": ts, "day": day})
    old = F.coalesce(F.coalesce("ts", "day") < cutoff_ms, F.lit(False))
    read = read.withColumn("old", old).withColumn("any_old", F.max("old").over(Window.partitionBy("stable_alias")))
    due = read.where("old").select("stable_alias", "index", F.coalesce("ts", "day").alias("sort_key_ms"), F.coalesce("ts", F.col("day") + (DAY_MS - 1)).alias("watermark_ms"), "store_bytes", F.when(F.col("ts").isNotNull(), "TimestampEligible").otherwise("NameDateEligible").alias("reason"))
    if not emergency:
        return due
    first = read.where("not any_old and nth = 1").select("stable_alias", "index", F.coalesce("day", F.lit(LEAST_LONG)).alias("sort_key_ms"), F.lit(cutoff_ms).cast("long").alias("watermark_ms"), "store_bytes", F.lit("EmergencyOldest").alias("reason"))
    return due.union(first)


def delete_until(candidates: DataFrame, deficit_bytes: int) -> DataFrame:
    """The candidates, oldest then largest first, until their bytes cover the deficit."""
    w = Window.orderBy("sort_key_ms", F.desc_nulls_last("store_bytes"), "index").rowsBetween(Window.unboundedPreceding, -1)
    freed = F.coalesce(F.sum(F.coalesce("store_bytes", F.lit(0))).over(w), F.lit(0))  # candidates are segments: few
    return candidates.withColumn("freed_before", freed).where(F.col("freed_before") < deficit_bytes)


def clamp(windows: DataFrame, watermarks: DataFrame) -> DataFrame:
    """``windows`` (stable, start_ms, end_ms) cut to what is still supported; those wholly before go."""
    j = windows.join(watermarks, "stable", "left").where("watermark_ms is null or end_ms > watermark_ms")
    return j.select("stable", F.greatest("start_ms", "watermark_ms").alias("start_ms"), "end_ms")


def refresh_plan(segments: DataFrame, cold_before_ms: int, hot: str = "1s", cold: str = "30s") -> DataFrame:
    """(index, interval) of the segments whose refresh interval should change."""
    want = F.when(F.col("max_ts_ms").isNull() | (F.col("max_ts_ms") >= cold_before_ms), hot).otherwise(cold)
    return segments.withColumn("interval", want).where(~F.col("interval").eqNullSafe(F.col("current"))).select("index", "interval")


def disk_pressure(paths: DataFrame, buffer_bytes: int) -> DataFrame:
    """One row: least available, most needed, and whether space must be freed."""
    agg = paths.agg(F.min("available").alias("available_min"), F.max(F.col("high") + buffer_bytes).alias("needed_max"), F.max("high").alias("high_max"))
    return agg.select("*", F.coalesce(F.col("available_min") < F.col("needed_max"), F.lit(False)).alias("pressure"))


def segment_bounds(rows: DataFrame) -> DataFrame:
    """(segment, min_ts, max_ts, n), one pass; segments without a positive bound are left out."""
    return rows.groupBy("segment").agg(F.min("timestamp_ms").alias("min_ts"), F.max("timestamp_ms").alias("max_ts"), F.count("*").alias("n")).where("min_ts > 0 and max_ts > 0")


def overlapping(bounds: DataFrame, windows: DataFrame) -> DataFrame:
    """Segments that meet a window (both ends count); windows are few."""
    return bounds.join(windows, (F.col("max_ts") >= F.col("s")) & (F.col("min_ts") <= F.col("e")))


def within(bounds: DataFrame, windows: DataFrame) -> DataFrame:
    return bounds.join(windows, (F.col("min_ts") >= F.col("s")) & (F.col("max_ts") <= F.col("e")))


def advanced(watermarks: DataFrame, deleted: DataFrame) -> DataFrame:
    """``watermarks`` (stable, watermark_ms) after the ``deleted`` candidates: they only rise."""
    return merge_watermarks(watermarks, deleted.select(F.col("stable_alias").alias("stable"), "watermark_ms"))


def hygiene(indices: DataFrame, prefix: str | None = None) -> DataFrame:
    """Indices to drop: temporary copies, empty ones in bad health, and the prefix's default index."""
    default = F.col("index") == f"{prefix}-default" if prefix else F.lit(False)
    return indices.where(default | F.col("index").contains("-temp") | ((F.col("docs") == 0) & (F.col("health") == "red")))


def sized(bounds: DataFrame, sizes: DataFrame) -> DataFrame:
    """``bounds`` (segment, min_ts, max_ts, n) with store_bytes of ``sizes`` (segment, store_bytes), null if unknown."""
    return bounds.join(sizes.select("segment", "store_bytes"), "segment", "left")


def refresh_settings(indices: DataFrame, phase: str, normal: str = "1s") -> DataFrame:
    """(index, refresh_interval, replicas): off and none while a ``backfill`` runs, back to normal to ``restore``."""
    off = phase == "backfill"
    return indices.select("index", F.lit("-1" if off else normal).alias("refresh_interval"), (F.lit(0) if off else F.col("replicas")).cast("int").alias("replicas"))


def is_system(index: Column) -> Column:
    return index.rlike(r"^(\.|ilm-history|slm-history|shrink-|restore-|partial-)")
