"""Tailing an event stream into a target table: exactly once by checkpoint and idempotent by id.

Nothing here has an event-time watermark on the way to the target: a row is inserted however late it comes.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.enrich import enrich
from ..operators.ranges import absent, one_per_id
from ..sources import state
from ..sources.shared import cut, drop

HOUR_MS = 3_600_000
MOST_ATTEMPTS = 20


def read(spark: SparkSession, path: str, schema: StructType | str, files_per_trigger: int = 100) -> DataFrame:
    """The files of a folder as a stream; back-pressure is the number of files a trigger takes.  Rows with a null id, time
    or message are no events."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path).dropna(subset=["id", "timestamp_ms", "message"])


def held_ids(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    """The ids of the target, or none if it is not there yet."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    own = spark.read.schema(schema).parquet(target) if there else spark.createDataFrame([], schema)
    return own.select("id")


def insert(rows: DataFrame, target: str) -> None:
    """Appends the ``rows`` (id, ts_ms, message, event_date, ...) whose id the target does not hold, under whatever day.

    Only the id column of the target is read, and cut down to the ids asked for before it meets the rows.
    """
    rows = cut(one_per_id(rows.withColumnRenamed("ts_ms", "timestamp_ms")).withColumnRenamed("timestamp_ms", "ts_ms"), "batch")  # read twice
    absent(held_ids(rows.sparkSession, target, rows.schema), rows).write.mode("append").partitionBy("event_date").parquet(target)
    drop(rows)


def insert_batch(target: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function; a repeated batch adds nothing."""
    return lambda batch, batch_id: insert(batch, target)


def documents(events: DataFrame, parse_json: bool = True) -> DataFrame:
    """Events as rows of the target."""
    return enrich(events, parse_json).withColumn("id", F.col("event.id")).drop("event", "tags")


def start(spark: SparkSession, source: str, schema: StructType | str, target: str, checkpoint: str, parse_json: bool = True, every: str | None = None, files_per_trigger: int = 100):
    """Starts the stream: over all files that are there, then it stops, or ``every`` so often (``15 seconds``) for good.  A
    restart goes on where the checkpoint ends."""
    docs = documents(read(spark, source, schema, files_per_trigger), parse_json)
    writer = docs.writeStream.foreachBatch(insert_batch(target)).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def tail(spark: SparkSession, source: str, schema: StructType | str, target: str, checkpoint: str, parse_json: bool = True, files_per_trigger: int = 100):
    query = start(spark, source, schema, target, checkpoint, parse_json, None, files_per_trigger)
    query.awaitTermination()
    return query


# Tailing by cursor, for sources that are asked and not streamed -----------------------------------------------------------


def poll(events: DataFrame, cursors: DataFrame, now_ms: int) -> DataFrame:
    """The ``events`` (stream, id, timestamp_ms, ...) at or after their stream's cursor (stream, next_start_time_ms); a
    stream without one begins an hour ago."""
    start = F.coalesce("next_start_time_ms", F.lit(now_ms - HOUR_MS))
    return events.join(cursors.select("stream", "next_start_time_ms"), "stream", "left").where(F.col("timestamp_ms") >= start).drop("next_start_time_ms")


def advance(polled: DataFrame, streams: DataFrame, cursors: DataFrame, now_ms: int) -> DataFrame:
    """(stream, next_start_time_ms) after a poll of ``streams`` (stream): just after the newest event, or after the start if
    none came."""
    newest = polled.groupBy("stream").agg(F.max("timestamp_ms").alias("newest"))
    start = F.coalesce("next_start_time_ms", F.lit(now_ms - HOUR_MS))
    return streams.select("stream").join(cursors.select("stream", "next_start_time_ms"), "stream", "left").join(newest, "stream", "left").select("stream", (F.greatest("newest", start) + 1).alias("next_start_time_ms"))


def poll_once(events: DataFrame, path: str, target: str, now_ms: int, streams: list[str]) -> dict:
    """One poll into the target; the cursors are saved only after the rows are written, so a crash repeats the poll, and
    ids make the repeat harmless.  Returns the new state of the cursors' file ``path``."""
    spark = events.sparkSession
    old = state.load(path, {"streams": {}})
    cursors = state.cursors(spark, old)
    rows = poll(events, cursors, now_ms)
    insert(documents(rows.withColumn("log_group", F.col("stream"))), target)
    names = spark.createDataFrame([(s,) for s in streams], "stream string")
    moved = {r["stream"]: {"next_token": None, "next_start_time_ms": r["next_start_time_ms"]} for r in advance(rows, names, cursors, now_ms).collect()}  # one row a stream
    new = {"streams": old["streams"] | moved}
    state.save(path, new)
    return new


def keep_polling(poll: Callable[[], object], interval_s: float, base_s: float, most_s: float, more: Callable[[], bool], sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.monotonic) -> None:
    """Polls while ``more()``: each starts an interval after the one before, or after a back-off if that one overran.  The
    back-off doubles with each failure, up to ``most_s``, and a success resets it."""
    backoff = base_s
    while more():
        began = clock()
        try:
            poll()
            backoff = base_s
        except Exception:  # noqa: BLE001  whatever failed is asked for again
            backoff = min(backoff * 2, most_s)
        rest = interval_s - (clock() - began)
        sleep(rest if rest > 0 else backoff)


class Throttled(Exception):
    """The source asks for fewer requests."""


class Unavailable(Exception):
    """The source may answer later."""


def asked(request: Callable[[], object], backoff_ms: Callable[[], int], failed: Callable[[], None] = lambda: None, succeeded: Callable[[], None] = lambda: None, sleep: Callable[[float], None] = time.sleep):
    """The answer to a request, asked up to 20 times: after the tracker's back-off if the source throttles (which counts as
    a failure), after half a second more each time, up to five, if it is away."""
    for attempt in range(1, MOST_ATTEMPTS + 1):
        try:
            out = request()
            succeeded()
            return out
        except Throttled:
            failed()
            if attempt == MOST_ATTEMPTS:
                raise
            sleep(backoff_ms() / 1000)
        except Unavailable:
            if attempt == MOST_ATTEMPTS:
                raise
            sleep(0.5 * min(attempt, 10))


# Windows ------------------------------------------------------------------------------------------------------------------


def windowed_counts(events: DataFrame, length: str = "1 day", delay: str = "2 days", slide: str | None = None) -> DataFrame:
    """Events a window and group, for tables and streams; ``slide`` makes the windows overlap.

    On a stream the delay bounds the state: a row later than that misses its count, though never the target table, and a
    count over the table has it.  On a table nothing is late.
    """
    timed = events.withColumn("_t", F.timestamp_millis("timestamp_ms"))
    timed = timed.withWatermark("_t", delay) if events.isStreaming else timed
    window = F.window("_t", length, slide) if slide else F.window("_t", length)
    return timed.groupBy(window, "log_group").agg(F.count("*").alias("n")).select(F.unix_millis("window.start").alias("start_ms"), "log_group", "n")
