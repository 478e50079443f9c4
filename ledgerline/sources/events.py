"""The event tables: a source stream, and a target with known damage to reconcile it with."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
#: 2024-01-31 00:00:00 UTC: the clock of all registered queries.
NOW_MS = 1_706_659_200_000


def _bounds(ts: str, kind: str, start: int | None, end: int | None) -> list:
    """Filters on the stored column, in its own type, so that they reach the Parquet row groups."""
    plain = lambda ms: F.lit(str(datetime(1970, 1, 1) + timedelta(milliseconds=ms))).cast("timestamp_ntz")
    at = plain if kind == "timestamp_ntz" else lambda ms: F.timestamp_millis(F.lit(ms))
    return ([F.col(ts) >= at(start)] if start is not None else []) + ([F.col(ts) < at(end)] if end is not None else [])


def source(spark: SparkSession, sf_dir: str, start: int | None = None, end: int | None = None) -> DataFrame:
    """id, timestamp_ms, message, log_group, from ``start`` to before ``end``; rows with a null part are no events."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    for bound in _bounds("ts", dict(e.dtypes)["ts"], start, end):
        e = e.where(bound)
    micros = F.expr(f"timestampdiff(MICROSECOND, {EPOCH}, ts)")
    # In a UTC session the stored instant is a plain long; elsewhere wall time must be told from it.
    utc = spark.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "GMT", "Z")
    millis = F.unix_millis(F.col("ts").cast("timestamp")) if utc else ((micros - F.pmod(micros, F.lit(1000))) / 1000).cast("long")
    out = e.select(
        F.col("event_id").cast("string").alias("id"),
        millis.alias("timestamp_ms"),
        F.col("props").alias("message"),
        F.concat(F.lit("/app/"), "event_type").alias("log_group"),
    )
    return out.dropna(subset=["id", "timestamp_ms", "message"])


def target(spark: SparkSession, sf_dir: str, start: int | None = None, end: int | None = None) -> DataFrame:
    """The source with rows missing (some everywhere, half of 12 January, all of 20 January; none from 3 to 5 January)
    and orphans."""
    s = source(spark, sf_dir, start, end)
    n, day = F.col("id").cast("long"), F.expr("timestamp_ms div 86400000")
    jan = lambda d: 19_722 + d  # noqa: E731  days since the epoch
    lost = (n % 97 == 5) | ((day == jan(12)) & (n % 2 == 0)) | (day == jan(20))
    kept = s.where(~lost | day.between(jan(3), jan(5)))
    orphans = s.where((n % 211 == 0) & ~day.between(jan(3), jan(5))).withColumn("id", F.concat(F.lit("orphan-"), "id"))
    return kept.union(orphans)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, ms, user_id, event_type and k, the number in the event's JSON, of every event."""
    e = source(spark, sf_dir).select(F.col("id").cast("long").alias("event_id"), F.col("timestamp_ms").alias("ms"), F.replace(F.col("log_group"), F.lit("/app/"), F.lit("")).alias("event_type"), F.get_json_object("message", "$.k").cast("long").alias("k"))
    return e.join(table(spark, sf_dir, "events").select("event_id", "user_id"), "event_id")


RAW = "raw as (select event_id, epoch_us(ts) // 1000 as ms, user_id, event_type, json_extract(props, '$.k')::bigint as k from events where event_id is not null and ts is not null and props is not null)"


#: The same as common table expressions.
SQL = """
source as (
  select event_id::varchar as id, epoch_us(ts) // 1000 as timestamp_ms, props as message, '/app/' || event_type as log_group
  from events where event_id is not null and ts is not null and props is not null
), target as (
  select * from source where not (id::bigint % 97 = 5 or (timestamp_ms // 86400000 = 19734 and id::bigint % 2 = 0) or timestamp_ms // 86400000 = 19742)
    or timestamp_ms // 86400000 between 19725 and 19727
  union all
  select 'orphan-' || id, timestamp_ms, message, log_group from source
  where id::bigint % 211 = 0 and not timestamp_ms // 86400000 between 19725 and 19727
)
"""


def values(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def sql_values(names: str, rows: list[tuple]) -> str:
    """The rows as a DuckDB table expression."""
    def lit(x) -> str:
        if x is None:
            return "null"
        if isinstance(x, bool):
            return str(x).lower()
        return str(x) if isinstance(x, (int, float)) else "'" + str(x).replace("'", "''") + "'"

    return "(values " + ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in rows) + f") t({names})"
