"""Control decisions as expressions over tables of samples: priorities, stress, adaptive batch sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Priorities here, and the thresholds and steps of all functions below.
CRITICAL, HIGH, NORMAL, LOW, IDLE = 255, 192, 128, 64, 0


def day_priority(days_ago: Column) -> Column:
    return F.when(days_ago <= 0, CRITICAL).when(days_ago <= 3, HIGH).when(days_ago <= 7, NORMAL).when(days_ago <= 30, LOW).otherwise(IDLE)


def effective_priority(p: Column, wait_s: Column) -> Column:
    return F.least(F.lit(255), p + F.floor(wait_s / 10)).cast("int")


def channel(p: Column) -> Column:
    return F.when(p == 255, "critical").when(p >= 192, "high").when(p >= 128, "normal").when(p >= 64, "low").otherwise("idle")


#: Events a channel holds.
CAPACITY = {"critical": 10_000, "high": 50_000, "normal": 100_000, "low": 100_000, "idle": 100_000}


def channel_rank(p: Column) -> Column:
    """0 for the channel that is drained first."""
    return F.when(p == 255, 0).when(p >= 192, 1).when(p >= 128, 2).when(p >= 64, 3).otherwise(4)


def drain_order(queue: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``queue`` (by, priority, seq) with ``turn``: by channel, first in first out inside it.  A queue is bounded by the
    capacities of its channels."""
    return queue.withColumn("turn", F.row_number().over(Window.partitionBy(*(by or [])).orderBy(channel_rank(F.col("priority")), "seq")))


def waiting(queue: DataFrame, by: list[str]) -> DataFrame:
    """(by, channel, queued, waiting): how many events each channel takes, and how many must wait outside it."""
    caps = F.create_map(*[F.lit(x) for kv in CAPACITY.items() for x in kv])
    n = queue.groupBy(*by, channel(F.col("priority")).alias("channel")).agg(F.count("*").alias("n"))
    return n.select(*by, "channel", F.least("n", caps[F.col("channel")]).alias("queued"), F.greatest(F.col("n") - caps[F.col("channel")], F.lit(0)).alias("waiting"))


def process_states(log: DataFrame) -> DataFrame:
    """(process, state) after the ordered steps (process, seq, step) of each: spawn and unblock make it ready, schedule
    running, block blocked, terminate done for good."""
    to = F.create_map(*[F.lit(x) for kv in {"spawn": "ready", "unblock": "ready", "schedule": "running", "block": "blocked", "terminate": "done"}.items() for x in kv])
    last = log.groupBy("process").agg(F.max_by("step", "seq").alias("step"), F.max(F.col("step") == "terminate").alias("over"))
    return last.select("process", F.when(F.col("over"), "done").otherwise(to[F.col("step")]).alias("state"))


def pause_secs(p: Column, level: Column, streak: Column, backoff: Column) -> Column:
    """Seconds that work of a priority pauses, or null."""
    return (
        F.when(p >= 250, None)
        .when(p >= 180, F.when(level == "critical", backoff))
        .when(p >= 100, F.when(level.isin("elevated", "critical"), backoff))
        .when(p >= 50, F.when(streak >= 1, backoff))
        .otherwise(F.when(streak >= 1, backoff * 2))
    )


def pressure(heap: Column, cpu: Column) -> Column:
    return F.when((heap >= 0.85) | (cpu >= 0.90), "critical").when((heap >= 0.70) | (cpu >= 0.70), "moderate").otherwise("none")


#: What a check that got no answer counts as.
UNKNOWN_USE = 0.95


def node_pressure(samples: DataFrame, by: list[str]) -> DataFrame:
    """(by, heap, cpu, breaker, memory, pressure): the largest of all nodes' ``samples`` (heap, cpu, breaker; a null is a
    check that failed)."""
    top = lambda c: F.max(F.coalesce(c, F.lit(UNKNOWN_USE))).alias(c)
    out = samples.groupBy(*by).agg(top("heap"), top("cpu"), F.max(F.coalesce("breaker", F.lit(0.0))).alias("breaker"))
    return out.withColumn("memory", F.greatest("heap", "breaker")).withColumn("pressure", pressure(F.col("memory"), F.col("cpu")))


def pressure_fold(samples: DataFrame) -> DataFrame:
    """(tracker, batch, in_flight, delay, pressed) after the ordered ``samples`` (tracker, seq, heap, cpu): critical halves,
    moderate takes a quarter off, and only a sample without either clears the pressure."""
    start = "named_struct('batch', 5000L, 'in_flight', 4L, 'delay', 0L, 'pressed', false)"
    halt = "named_struct('batch', greatest(a.batch div 2, 100L), 'in_flight', greatest(a.in_flight div 2, 1L), 'delay', least(a.delay + 500, 5000L), 'pressed', true)"
    back = "named_struct('batch', greatest(a.batch * 3 div 4, 100L), 'in_flight', greatest(a.in_flight * 3 div 4, 1L), 'delay', least(a.delay + 200, 2000L), 'pressed', true)"
    calm = "named_struct('batch', a.batch, 'in_flight', a.in_flight, 'delay', a.delay, 'pressed', false)"
    x = samples.select("tracker", "seq", pressure(F.coalesce("heap", F.lit(UNKNOWN_USE)), F.coalesce("cpu", F.lit(UNKNOWN_USE))).alias("p"))
    step = f"case x.p when 'critical' then {halt} when 'moderate' then {back} else {calm} end"
    return x.groupBy("tracker").agg(F.expr(f"aggregate(array_sort(collect_list(struct(seq, p))), {start}, (a, x) -> {step})").alias("s")).select("tracker", "s.*")


def node_totals(stats: DataFrame) -> DataFrame:
    """``stats`` (breakers map<string, long>, write_queue, bulk_queue, ...) with trips, the sum over all breakers, and queue."""
    trips = F.aggregate(F.coalesce(F.map_values("breakers"), F.array().cast("array<bigint>")), F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return stats.withColumns({"trips": trips, "queue": F.coalesce("write_queue", F.lit(0)) + F.coalesce("bulk_queue", F.lit(0))})


def recovery_failures(samples: DataFrame) -> DataFrame:
    """``samples`` (node, seq, trips, heap_percent, queue, status, pending) with ``failed``."""
    before = F.lag("trips").over(Window.partitionBy("node").orderBy("seq"))
    bad = F.coalesce(F.col("trips") > F.coalesce(before, F.lit(0)), F.lit(False)) | (F.col("heap_percent") > 85) | (F.col("queue") > 200) | (F.col("status") == "red") | (F.col("pending") > 100)
    return samples.withColumn("failed", bad)


def combined_stress(states: DataFrame, by: list[str], p: Column) -> DataFrame:
    """(by, pause, level): the longest pause that any tracker of ``states`` (streak, backoff, level) asks of a priority,
    and the highest level."""
    rank = F.when(F.col("level") == "critical", 2).when(F.col("level") == "elevated", 1).otherwise(0)
    out = states.withColumns({"_p": pause_secs(p, F.col("level"), F.col("streak"), F.col("backoff")), "_r": rank}).groupBy(*by).agg(F.max("_p").alias("pause"), F.max("_r").alias("r"))
    return out.select(*by, "pause", F.when(F.col("r") == 2, "critical").when(F.col("r") == 1, "elevated").otherwise("normal").alias("level"))


def retry_wait(attempt: Column, throttled: Column, retryable: Column, backoff_ms: Column) -> Column:
    """Milliseconds until a failed request goes again: the tracker's back-off if it was throttled, else longer with each
    attempt; null if it is given up, after 20 attempts or for another error."""
    return F.when((throttled | retryable) & (attempt < 20), F.when(throttled, backoff_ms).otherwise(500 * F.least(attempt, F.lit(10))))


def buffer_capacity(in_flight: Column, multiplier: Column, floor: Column, baseline: Column) -> Column:
    return F.greatest(in_flight * multiplier, floor, baseline)


def stress(outcomes: DataFrame, least: int = 3, most: int = 60) -> DataFrame:
    """(tracker, streak, backoff, failures, level) after the ordered outcomes (tracker, seq, ok) of each tracker."""
    start = f"named_struct('streak', 0L, 'backoff', {least}L, 'failures', 0L)"
    step = (
        f"case when x.ok then named_struct('streak', greatest(a.streak - 1, 0L), 'backoff', greatest(a.backoff div 2, {least}L), 'failures', a.failures) "
        f"else named_struct('streak', a.streak + 1, 'backoff', least(a.backoff * 2, {most}L), 'failures', a.failures + 1) end"
    )
    fold = F.expr(f"aggregate(array_sort(collect_list(struct(seq, ok))), {start}, (a, x) -> {step})")
    out = outcomes.groupBy("tracker").agg(fold.alias("s")).select("tracker", "s.*")
    return out.withColumn("level", F.when(F.col("streak") >= 10, "critical").when(F.col("streak") >= 3, "elevated").otherwise("normal"))


def latency_average(latencies: DataFrame, window: int = 20) -> DataFrame:
    """Whole mean of the last ``window`` latencies at each (tracker, seq)."""
    w = Window.partitionBy("tracker").orderBy("seq").rowsBetween(-(window - 1), 0)
    return latencies.withColumn("avg_ms", F.floor(F.avg("latency_ms").over(w)))


def adaptive(latencies: DataFrame) -> DataFrame:
    """(tracker, batch, in_flight, delay) after the ordered latencies (tracker, seq, latency_ms, ok, due, pressed): due
    says whether the adjustment interval has passed, pressed whether the store is under pressure."""
    x = latencies.join(latency_average(latencies).select("tracker", "seq", "avg_ms"), ["tracker", "seq"])
    start = "named_struct('batch', 5000L, 'in_flight', 4L, 'delay', 0L, 'slow', 0L, 'fast', 0L)"
    state = lambda b, i, d, s, f: f"named_struct('batch', {b}, 'in_flight', {i}, 'delay', {d}, 'slow', {s}, 'fast', {f})"
    slow = "case when not x.ok or x.latency_ms > 2000 then a.slow + 1 when x.latency_ms < 500 then 0L else a.slow end"
    fast = "case when not x.ok or x.latency_ms > 2000 then 0L when x.latency_ms < 500 then a.fast + 1 else a.fast end"
    counted = state("a.batch", "a.in_flight", "a.delay", slow, fast)
    halt = state("greatest(c.batch div 2, 100L)", "greatest(c.in_flight div 2, 1L)", "least(c.delay + 500, 5000L)", "0L", "0L")
    back = state("greatest(c.batch * 3 div 4, 100L)", "case when c.in_flight > 2 then c.in_flight - 1 else 1L end", "least(c.delay + 100, 2000L)", "0L", "c.fast")
    up = state("least(c.batch * 5 div 4, 20000L)", "least(c.in_flight + 1, 16L)", "greatest(c.delay - 50, 0L)", "c.slow", "0L")
    step = f"transform(array({counted}), c -> case when x.latency_ms > 10000 then {halt} when x.due and c.slow >= 3 then {back} when x.due and c.fast >= 10 and x.avg_ms < 500 and not x.pressed then {up} else c end)[0]"
    fold = F.expr(f"aggregate(array_sort(collect_list(struct(seq, latency_ms, ok, due, pressed, avg_ms))), {start}, (a, x) -> {step})")
    return x.groupBy("tracker").agg(fold.alias("s")).select("tracker", "s.batch", "s.in_flight", "s.delay")


def state_counts(processes: DataFrame) -> DataFrame:
    return processes.groupBy("state").agg(F.count("*").alias("n"))


def worker_rollup(workers: DataFrame) -> DataFrame:
    """Events, milliseconds and processes of all workers, and events a second."""
    out = workers.agg(F.sum("events").alias("events"), F.sum("ms").alias("ms"), F.sum("processes").alias("processes"))
    return out.withColumn("eps", F.expr("case when ms = 0 then 0 else events * 1000 div ms end"))
