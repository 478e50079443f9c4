"""Enrichment: raw text events to typed documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import jsonnorm, text


def tagged(raw: DataFrame) -> DataFrame:
    """``raw`` (message, ...) with the tags that ``enrich`` gives, without rewriting the JSON; events without text are dropped."""
    clean = raw.withColumn("message", text.clean_message(F.col("message"))).where("message <> ''")
    json = F.coalesce(jsonnorm.is_json(F.when(F.col("message").rlike(r"^[\{\[]"), F.col("message"))), F.lit(False))
    return clean.withColumn("tags", F.array(F.when(json, "json_parsed").otherwise("not_json_message"), F.lit("sync"), F.lit("synced")))


def enrich(raw: DataFrame, parse_json: bool = True) -> DataFrame:
    """Documents of ``raw`` (id, timestamp_ms, message, log_group); events without text are dropped.

    Columns: ``@timestamp``, event struct<id>, log_group, message, parsed (normalised JSON or null), tags, ts_ms,
    event_date.  The JSON gate runs in the JVM, so only texts that start like JSON reach Python.
    """
    clean = raw.withColumn("message", text.clean_message(F.col("message"))).where("message <> ''")
    if parse_json:
        clean = clean.withColumn("parsed", jsonnorm.normalize_json(F.when(F.col("message").rlike(r"^[\{\[]"), F.col("message"))))
    else:
        clean = clean.withColumn("parsed", F.lit(None).cast("string"))
    kind = F.when(F.col("parsed").isNotNull(), "json_parsed").otherwise("not_json_message")
    return clean.select(
        text.rfc3339(F.col("timestamp_ms")).alias("@timestamp"),
        F.struct("id").alias("event"),
        "log_group",
        "message",
        "parsed",
        F.array(kind, F.lit("sync"), F.lit("synced")).alias("tags"),
        F.col("timestamp_ms").alias("ts_ms"),
        F.to_date(F.timestamp_millis("timestamp_ms")).alias("event_date"),
    )
