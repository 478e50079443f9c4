"""What to do with documents that the store refused."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Error types by kind.
MAPPING = ("mapper_parsing_exception", "illegal_argument_exception", "strict_dynamic_mapping_exception")
CONFLICT = ("version_conflict_engine_exception", "document_already_exists_exception")
RETRY = ("circuit_breaker", "timeout", "es_rejected_execution", "cluster_block")


def classify(kind: Column, reason: Column) -> Column:
    """ShardLimitExceeded, FieldLimitExceeded, Mapping, VersionConflict, Retryable or Other: the first that holds."""
    any_of = lambda c, words: F.greatest(*[c.contains(w) for w in words])
    return (
        F.when((kind == "validation_exception") & reason.contains("maximum normal shards open"), "ShardLimitExceeded")
        .when((kind == "document_parsing_exception") & reason.contains("Limit of total fields"), "FieldLimitExceeded")
        .when(kind.isin(*MAPPING) | any_of(reason, ("mapper", "dynamic", "type")), "Mapping")
        .when(kind.isin(*CONFLICT), "VersionConflict")
        .when(any_of(kind, RETRY), "Retryable")
        .otherwise("Other")
    )


def action(kind: Column) -> Column:
    """The next step for a refused document."""
    steps = {"ShardLimitExceeded": "wait_and_retry", "FieldLimitExceeded": "reduce_and_retry", "Mapping": "flatten_and_retry", "VersionConflict": "skip", "Retryable": "retry"}
    m = F.create_map(*[F.lit(x) for kv in steps.items() for x in kv])
    return F.coalesce(m[kind], F.lit("fallback"))


def failed_items(responses: DataFrame, batch: int, by: list[str] | None = None) -> DataFrame:
    """(by, position, status, type, reason) of the items of bulk responses (by, json) that failed."""
    item = "struct<status: int, error: struct<type: string, reason: string>>"
    items, key = F.from_json("json", f"struct<items: array<map<string, {item}>>>")["items"], by or []
    each = responses.select(*key, F.posexplode(items).alias("position", "item")).select(*key, "position", F.map_values("item")[0].alias("i"))
    return each.where((F.col("i.status") >= 400) & (F.col("position") < batch)).select(*key, "position", F.col("i.status").alias("status"), F.col("i.error.type").alias("type"), F.col("i.error.reason").alias("reason"))


def fallback(docs: DataFrame) -> DataFrame:
    """``docs`` (message, parsed, tags, error_type, error_reason) as documents that are always accepted."""
    error = F.struct(F.col("error_type").alias("type"), F.left("error_reason", F.lit(500)).alias("reason"), F.left("message", F.lit(1000)).alias("original_message_preview"))
    keep = [F.get_json_object("parsed", f"$.{k}").alias(k) for k in ("event", "level", "service_name")]
    return docs.withColumns({"parsed": F.to_json(F.struct(error.alias("_ingestion_error"), *keep)), "tags": F.array_append("tags", F.lit("ingestion_error"))})
