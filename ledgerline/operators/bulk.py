"""Writing documents in bulk: how large batches are, what is sent, and what becomes of what the store refuses."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import jsonnorm
from ..functions.text import target_index
from ..sources.shared import cut
from .control import channel_rank
from .docrepair import action, classify, fallback
from .ranges import even_chunks

# Fixed values.
LEAST_CHUNK = 100
ATTEMPTS = 3
EVENT_BYTES = 1024
MOST_BUFFER = 10_000_000
#: Buffer: multiplier, floor, and what else it is at least as large as.
BUFFERS = {"tail_raw": (5, 1024, "sink_enriched"), "reconcile_raw": (4, 2048, "sink_enriched"), "heal_raw": (4, 2048, "sink_enriched"), "backfill_raw": (10, 4096, "reconcile_raw")}


def effective_batch(target: Column, level: Column) -> Column:
    """Documents a batch takes under stress: half when elevated, a quarter when critical."""
    return F.when(level == "critical", F.floor(target / 4)).when(level == "elevated", F.floor(target / 2)).otherwise(target)


def effective_in_flight(n: Column, level: Column) -> Column:
    return F.when(level == "critical", F.lit(1)).when(level == "elevated", F.greatest(F.lit(1), F.floor(n / 2))).otherwise(n)


def batches(queue: DataFrame, by: list[str], order: list[str], size: Column) -> DataFrame:
    """``queue`` (by, priority, order...) with ``batch``: drawn by channel, first in first out within it, ``size`` at a
    time; the last batch of a queue is flushed short.  A queue is what one sender holds: bounded by its channels."""
    w = Window.partitionBy(*by).orderBy(channel_rank(F.col("priority")), *order)
    return queue.withColumn("_rn", F.row_number().over(w) - 1).withColumn("_size", F.greatest(F.lit(1), size).cast("long")).withColumn("batch", F.expr("_rn div _size")).drop("_rn", "_size")


def chunked(batch: DataFrame, by: list[str], order: list[str], in_flight: Column, level: Column) -> DataFrame:
    """``batch`` with ``chunk``: as many even parts as may be in flight, but none for fewer than 100 documents."""
    n = F.least(F.greatest(F.floor(F.count("*").over(Window.partitionBy(*by)) / LEAST_CHUNK), F.lit(1)), effective_in_flight(in_flight, level))
    return even_chunks(batch.withColumn("_chunks", n), order, F.col("_chunks"), by).drop("_chunks")


def body(docs: DataFrame, prefix: str, op: str = "create") -> DataFrame:
    """(id, action, document): the two lines of each document of ``docs`` (as ``enrich`` makes them) in a bulk request."""
    head = F.to_json(F.struct(F.struct(target_index(prefix, F.col("log_group")).alias("_index"), F.col("event.id").alias("_id")).alias(op)))
    rest = F.to_json(F.struct("`@timestamp`", "event", "log_group", "message"))
    parsed = F.when(F.col("parsed").isNotNull(), F.concat(F.lit(',"parsed":'), "parsed")).otherwise(F.lit(""))
    document = F.concat(F.expr("left(_rest, length(_rest) - 1)"), parsed, F.lit(',"tags":'), F.to_json("tags"), F.lit("}"))
    return docs.withColumn("_rest", rest).select(F.col("event.id").alias("id"), head.alias("action"), document.alias("document"))


def deliver(docs: DataFrame, refuse: Callable[[DataFrame, int], DataFrame], attempts: int = ATTEMPTS) -> DataFrame:
    """Sends ``docs`` (id, message, parsed, tags) until nothing more can be done: (id, message, parsed, tags, attempt,
    outcome), outcome sent, skipped (the store holds the id), fallback (sent as a raw document), stringified, or failed.

    ``refuse(docs, attempt)`` gives (id, type, reason) of what the store refuses.  Refused documents are flattened,
    reduced or sent again as they are, by the kind of error; what is left after all attempts goes as plain text once.
    Each round is as large as what the round before was refused.
    """
    columns = ["id", "message", "parsed", "tags"]
    pending, done = docs.select(*columns), []
    for attempt in range(1, attempts + 1):
        errors = refuse(pending, attempt).select("id", F.col("type").alias("error_type"), F.col("reason").alias("error_reason"))
        own = cut(pending.join(errors, "id", "left").withColumn("step", action(classify(F.col("error_type"), F.coalesce("error_reason", F.lit(""))))), f"round-{attempt}")
        take = lambda where, outcome: own.where(where).select(*columns, F.lit(attempt).alias("attempt"), F.lit(outcome).alias("outcome"))  # noqa: B023, E731
        done += [take("error_type is null", "sent"), take("error_type is not null and step = 'skip'", "skipped")]
        raw = fallback(own.where("error_type is not null and step = 'fallback'")).select(*columns)
        again = refuse(raw, attempt).select("id", F.lit("failed").alias("outcome"))
        done.append(raw.join(again, "id", "left").select(*columns, F.lit(attempt).alias("attempt"), F.coalesce("outcome", F.lit("fallback")).alias("outcome")))
        left = own.where("error_type is not null and step not in ('skip', 'fallback')")
        mended = F.when(F.col("step") == "flatten_and_retry", jsonnorm.flatten_json(F.col("parsed"))).when(F.col("step") == "reduce_and_retry", jsonnorm.reduce_json(F.col("parsed"))).otherwise(F.col("parsed"))
        pending = cut(left.withColumn("parsed", F.coalesce(mended, F.col("parsed"))).select(*columns), f"pending-{attempt}")
    last = pending.withColumn("parsed", as_string(F.col("parsed")))
    gone = refuse(last, attempts + 1).select("id", F.lit("failed").alias("outcome"))
    out = last.join(gone, "id", "left").select(*columns, F.lit(attempts + 1).alias("attempt"), F.coalesce("outcome", F.lit("stringified")).alias("outcome"))
    for one in done:
        out = out.unionByName(one)
    return out


def as_string(parsed: Column) -> Column:
    """A JSON text as one JSON string."""
    quoted = F.to_json(F.struct(parsed.alias("x")))
    return F.when(parsed.isNotNull(), F.regexp_extract(quoted, r'(?s)^\{"x":(.*)\}$', 1))


@dataclass(frozen=True)
class Buffers:
    """How many events each buffer holds."""

    sink_enriched: int
    tail_raw: int
    reconcile_raw: int
    heal_raw: int
    backfill_raw: int
    resync_per_sample: int

    def bytes(self) -> int:
        return EVENT_BYTES * (self.sink_enriched + self.tail_raw + self.reconcile_raw + self.heal_raw + self.backfill_raw + self.resync_per_sample)

    def check(self) -> None:
        if self.sink_enriched < 1 or self.tail_raw < 1:
            raise ValueError("sink_enriched and tail_raw must be positive")
        if max(self.sink_enriched, self.backfill_raw) > MOST_BUFFER:
            raise ValueError(f"a buffer exceeds {MOST_BUFFER} events")


def buffer_columns(batch_size: Column, in_flight: Column) -> dict[str, Column]:
    """The capacities of all buffers and their bytes, by name."""
    batch, flight = F.greatest(batch_size, F.lit(1)).cast("long"), F.greatest(in_flight, F.lit(1)).cast("long")
    out = {"sink_enriched": batch * 4}
    for name, (times, floor, base) in BUFFERS.items():
        out[name] = F.greatest(batch * flight * times, F.lit(floor), out[base])
    out["resync_per_sample"] = F.greatest(flight * 8, F.lit(16))
    return out | {"bytes": sum(out.values(), F.lit(0)) * EVENT_BYTES}


def buffers(batch_size: int, in_flight: int) -> Buffers:
    """The same for one configuration, checked."""
    batch, flight = max(batch_size, 1), max(in_flight, 1)
    out = {"sink_enriched": batch * 4}
    for name, (times, floor, base) in BUFFERS.items():
        out[name] = max(batch * flight * times, floor, out[base])
    own = Buffers(**out, resync_per_sample=max(flight * 8, 16))
    own.check()
    return own


def check_backfill(days: int, concurrency: int) -> None:
    if concurrency < 1:
        raise ValueError("concurrency must be at least 1")
    if days > 36_500:
        raise ValueError("backfill_days exceeds 100 years")
