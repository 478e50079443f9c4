"""Healing: copy a window whose types conflict into the other version of its stream, verify, then move the alias."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schema as H
from .ranges import in_range, one_per_id, same_windows
from .retention import overlapping, segment_bounds, within


def heal(types: DataFrame, mapping: DataFrame) -> DataFrame:
    """(index): every index whose data contradict its mapping, or whose mapping contradicts those of its stream."""
    return H.mismatches(types, mapping).select("index").union(H.minority(mapping).select("index")).distinct()


def fixable(conflicts: DataFrame, mapping: DataFrame) -> DataFrame:
    """(index): of the ``conflicts`` (index, path, type of one sample a row) those where the samples' consensus is
    reliable and does not fit the mapping's type."""
    return H.mismatches(conflicts, mapping).select("index").distinct()


def cutover_alias(aliases: DataFrame, alias: str, stream: str) -> DataFrame:
    """``aliases`` (alias, index) with the alias on the stream alone: all its old targets go in the same step."""
    new = aliases.sparkSession.createDataFrame([(alias, stream)], "alias string, index string")
    return aliases.where(F.col("alias") != alias).select("alias", "index").union(new)


def drop_segments(rows: DataFrame, segments: DataFrame) -> DataFrame:
    """``rows`` without the named ``segments`` (segment); names that are not there do no harm."""
    return rows.join(segments.select("segment"), "segment", "left_anti")


def cleanup_window(rows: DataFrame, start: int, end: int) -> DataFrame:
    """``rows`` without the segments that lie wholly in [start, end)."""
    window = rows.sparkSession.createDataFrame([(start, end - 1)], "s long, e long")
    return drop_segments(rows, within(segment_bounds(rows), window)) if end > start else rows


def window_copied(old: DataFrame, dest: DataFrame, start: int, end: int) -> DataFrame:
    """The next version of a stream: what ``dest`` holds, then the rows of ``old`` that it lacks: the window's, re-created,
    and all outside, so that nothing is lost behind the alias."""
    fresh = old.where(in_range(start, end))
    kept = old.where(~in_range(start, end))
    return dest.unionByName(one_per_id(fresh.unionByName(kept)).join(dest.select("id"), "id", "left_anti").select(*dest.columns))


def repair_window(old: DataFrame, dest: DataFrame, aliases: DataFrame, alias: str, stream: str, start: int, end: int) -> tuple[DataFrame, DataFrame]:
    """(rows of the new version, aliases) after the window was copied, found equal in count and boundary ids, and the alias
    moved to ``stream``.  Raises if the copy is not equal."""
    new = window_copied(old, dest, start, end)
    window = old.sparkSession.createDataFrame([(start, end)], "s long, e long")
    if end > start and not same_windows(old, new, window).first()["same"]:
        raise ValueError(f"the copy of [{start}, {end}) is not equal to its source")
    return new, cutover_alias(aliases, alias, stream)


def heal_window(rows: DataFrame, types: DataFrame, mapping: DataFrame, aliases: DataFrame, alias: str, start: int, end: int) -> tuple[DataFrame, DataFrame] | None:
    """``repair_window`` of the stream behind the alias, if any segment of it that meets the window is in conflict.

    ``rows`` (stream, segment, id, timestamp_ms, message, ...), ``types`` (index, path, type) and ``mapping`` (index, path,
    es_type) by segment.  None if the alias has not exactly one target, no segment meets the window, or none is in conflict.
    """
    own = H.resolve_alias(aliases).where(F.col("alias") == alias).first()
    if own is None or end <= start:
        return None
    stream = own["index"]
    old = rows.where(F.col("stream") == stream)
    window = rows.sparkSession.createDataFrame([(start, end - 1)], "s long, e long")
    met = overlapping(segment_bounds(old), window).select(F.col("segment").alias("index"))
    conflicts = heal(types.join(met, "index", "left_semi"), mapping.join(met, "index", "left_semi"))
    if conflicts.isEmpty():
        return None
    other = next_version(stream, alias)
    new, moved = repair_window(old, rows.where(F.col("stream") == other), aliases, alias, other, start, end)
    return new.withColumn("stream", F.lit(other)), moved


def next_version(stream: str, alias: str) -> str:
    """The other of a stream's two versions."""
    head, dash, tail = stream.rpartition("-")
    return f"{head}-{ {'v1': 'v2', 'v2': 'v1'}[tail] }" if dash and tail in ("v1", "v2") else f"{alias}-v2"


def reindexed(docs: DataFrame, path: str, kind: str) -> DataFrame:
    """``docs`` (json) with ``value``: the field as ``kind``, coerced where that is possible and null where it is not; no
    document is lost."""
    return docs.withColumn("value", F.get_json_object("json", f"$.{path}").try_cast(kind))


def replicas(wanted: Column, nodes: Column) -> Column:
    """Copies of a segment: no more than there are other nodes."""
    return F.least(wanted, F.greatest(nodes - 1, F.lit(0)))


def ensure_table(spark: SparkSession, name: str, schema: str, partition: str, properties: dict[str, str] | None = None) -> None:
    """Creates a partitioned Parquet table; one that is there stays as it is."""
    props = ", ".join(f"'{k}' = '{v}'" for k, v in sorted((properties or {}).items()))
    spark.sql(f"create table if not exists {name} ({schema}) using parquet partitioned by ({partition})" + (f" tblproperties ({props})" if props else ""))
