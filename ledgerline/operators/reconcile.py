"""Reconciliation: compare source and target over recursively halved time ranges and repair what differs.

The recursion is one plan.  Rows meet the leaves of all root ranges in one equi-join on time bins and are counted once
per leaf; nodes sum their leaves, first and last ids of a node come from those of its leaves, and a node counts only
if all above it were split.  ``decisions`` scans each side twice (counts, samples), whatever the number of ranges;
everything after the scans is as small as the tree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_message
from ..sources.shared import cut
from .ranges import DAY_MS, TS, absent, end_samples, in_windows, one_per_id

# Fixed values.
LEAVES = 16
REPLACE_PERCENT = 30
SAMPLE = 16
LEARN_PERCENT = 25
TRUST_PERCENT = 50
#: Halving a range of any length until 1/16 of it takes five steps at most.
LEVELS = 5
NODE = ["root", "level", "node"]


def sync_params(ranges: DataFrame) -> DataFrame:
    """``ranges`` (start_ms, end_ms) with leaf_ms, leaves, sample and mid_span_ms."""
    leaf = F.expr(f"greatest(1L, (end_ms - start_ms) div {LEAVES})")
    out = ranges.withColumn("leaf_ms", leaf).withColumn("leaves", F.expr("greatest(1L, (end_ms - start_ms) div leaf_ms)"))
    return out.withColumns({"sample": F.expr(f"greatest({SAMPLE}L, leaves div 4)"), "mid_span_ms": F.expr("greatest(1L, (end_ms - start_ms) div 8)")})


def difference_percent(a: Column, b: Column) -> Column:
    top = F.greatest(a, b)
    return F.when(top > 0, F.floor(F.abs(a - b) * 100 / top)).otherwise(0)


def tree(ranges: DataFrame) -> DataFrame:
    """The nodes (root, level, node, s, e, leaf) below each of ``ranges`` (start_ms, end_ms): halves of halves, the
    first rounded down, until a node is no longer than the leaf length.  ``node`` is the path from the root in bits."""
    p = sync_params(ranges).select(F.col("start_ms").alias("root"), "start_ms", "end_ms", "leaf_ms", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))).alias("level"))
    p = p.withColumn("node", F.explode(F.expr("sequence(0L, shiftleft(1L, level) - 1)")))
    half, bit = "(a.s + (a.e - a.s) div 2)", "(shiftright(node, level - i) & 1)"
    step = f"named_struct('s', if({bit} = 0, a.s, {half}), 'e', if({bit} = 0, {half}, a.e), 'ok', a.ok and a.e - a.s > leaf_ms)"
    at = F.expr(f"aggregate(filter(sequence(0, level), i -> i > 0), named_struct('s', start_ms, 'e', end_ms, 'ok', end_ms > start_ms), (a, i) -> {step})")
    return p.withColumn("at", at).where("at.ok").select("root", "level", "node", "at.s", "at.e", (F.expr("at.e - at.s <= leaf_ms")).alias("leaf"))


def _upwards(leaves: DataFrame) -> DataFrame:
    """Each leaf once for itself and for every node above it."""
    up = leaves.withColumnsRenamed({"level": "_l", "node": "_n"}).withColumn("level", F.explode(F.sequence(F.lit(0), F.col("_l"))))
    return up.withColumn("node", F.expr("shiftright(_n, _l - level)")).drop("_l", "_n")


def _nodes(ranges: DataFrame) -> DataFrame:
    """The tree with the middle window (ms, me) of each node; null where that is the whole node: there the ids asked for
    would be the node's first, which are compared anyway."""
    span = F.expr("greatest(1L, greatest(1L, (end_ms - start_ms) div 8) div 2)").alias("half")
    mid = tree(ranges).join(ranges.select(F.col("start_ms").alias("root"), span), "root").withColumn("mid", F.expr("s + (e - s) div 2"))
    mid = mid.withColumns({"ms": F.greatest(F.col("mid") - F.col("half"), "s"), "me": F.least(F.col("mid") + F.col("half"), "e")})
    part = (F.col("ms") > F.col("s")) | (F.col("me") < F.col("e"))
    return mid.select(*NODE, "s", "e", "leaf", F.when(part, F.col("ms")).alias("ms"), F.when(part, F.col("me")).alias("me"))


def decisions(source: DataFrame, target: DataFrame, ranges: DataFrame, bin_ms: int = DAY_MS // 16) -> DataFrame:
    """Every node with counts and decision: skip, replace, accept, split, or replace_leaf; and ``visited``.

    ``ranges`` (start_ms, end_ms): disjoint root windows of any length.  ``bin_ms``: about a leaf's length.  A node is
    accepted if the counts are equal, the first and last 16 ids are the same in one order, and the first 16 source ids
    around its middle are all in the target there.
    """
    nodes = cut(_nodes(ranges), "nodes")  # a few dozen rows a range
    leaves = nodes.where("leaf").select(*NODE, "s", "e")
    mids = nodes.where("ms is not null").select(*NODE, F.col("ms").alias("s"), F.col("me").alias("e"))
    windows = leaves.withColumn("mid", F.lit(False)).unionByName(mids.withColumn("mid", F.lit(True)))
    a, b = source.select(TS, "id"), target.select(TS, "id")
    counted = lambda rows, *more: in_windows(rows, leaves, bin_ms).groupBy(*NODE).agg(F.count("*").alias("n"), *more)
    own = cut(end_samples(in_windows(a, windows, bin_ms), [*NODE, "mid"], SAMPLE), "samples")
    asked = own.where("mid").select(*NODE, F.explode("first").alias("x")).select(*NODE, F.col("x.id").alias("id"))
    # The target's count pass also marks the ids asked for; a leaf is asked for few, so the set is bounded.
    marked = b.join(asked.select("id").distinct().withColumn("asked", F.lit(True)), "id", "left")
    found = cut(counted(marked, F.collect_set(F.when(F.col("asked"), F.struct(TS, "id"))).alias("found")), "found")
    held = found.select(F.explode("found").alias("x")).select(F.col("x.id").alias("id"), F.col(f"x.{TS}").alias(TS))
    hits = asked.join(mids, NODE).join(held, "id", "left")
    hits = hits.groupBy(*NODE, "id").agg(F.max(F.coalesce((F.col(TS) >= F.col("s")) & (F.col(TS) < F.col("e")), F.lit(False))).alias("there"))
    # All facts about leaves go upwards together, and meet the nodes in one aggregation.
    theirs = end_samples(in_windows(b, leaves, bin_ms), NODE, SAMPLE)
    every = _upwards(counted(a).withColumnRenamed("n", "source_n"))
    for more in (
        _upwards(found.select(*NODE, F.col("n").alias("target_n"))),
        _upwards(own.where("not mid").select(*NODE, F.col("first").alias("f"), F.col("last").alias("l"))),
        _upwards(theirs.select(*NODE, F.col("first").alias("fb"), F.col("last").alias("lb"))),
        hits.select(*NODE, "there"),
        nodes.select(*NODE, F.struct("s", "e", "leaf").alias("at")),
    ):
        every = every.unionByName(more, allowMissingColumns=True)
    head = lambda c: F.slice(F.array_sort(F.flatten(F.collect_list(c))), 1, SAMPLE)  # noqa: E731  a node has 31 leaves at most
    tail = lambda c: F.slice(F.reverse(F.array_sort(F.flatten(F.collect_list(c)))), 1, SAMPLE)
    name = lambda c: F.transform(c, lambda x: x["id"])
    out = every.groupBy(*NODE).agg(
        F.max("at").alias("at"), F.coalesce(F.sum("source_n"), F.lit(0)).alias("source_n"), F.coalesce(F.sum("target_n"), F.lit(0)).alias("target_n"),
        (name(head("f")) == name(head("fb"))).alias("same_first"), (name(tail("l")) == name(tail("lb"))).alias("same_last"), F.coalesce(F.min("there"), F.lit(True)).alias("found"),
    ).select(*NODE, "at.*", "source_n", "target_n", (F.col("same_first") & F.col("same_last") & F.col("found")).alias("same"))
    decision = (
        F.when((F.col("source_n") == 0) & (F.col("target_n") == 0), "skip")
        .when(difference_percent(F.col("source_n"), F.col("target_n")) >= REPLACE_PERCENT, "replace")
        .when((F.col("source_n") == F.col("target_n")) & F.col("same"), "accept")
        .when(~F.col("leaf"), "split")
        .otherwise("replace_leaf")
    )
    # At most 63 nodes a root: each looks for one above it that was not split.
    ended = F.expr("transform(filter(collect_list(struct(level, node, decision)) over (partition by root), x -> x.decision <> 'split'), x -> struct(x.level, x.node))")
    out = out.withColumn("decision", decision).withColumn("ended", ended)
    visited = F.expr("not exists(ended, x -> x.level < level and x.node = shiftright(node, level - x.level))")
    return out.select(*NODE, "s", "e", "source_n", "target_n", "decision", visited.alias("visited"))


def replace_ranges(nodes: DataFrame) -> DataFrame:
    return nodes.where("visited and decision in ('replace', 'replace_leaf')").select("s", "e")


def _usable(rows: DataFrame) -> DataFrame:
    """Rows that enrichment keeps: those with text."""
    return rows.where(clean_message(F.col("message")) != "")


def replaced(source: DataFrame, target: DataFrame, ranges: DataFrame, bin_ms: int = DAY_MS // 16) -> tuple[DataFrame, DataFrame]:
    """(new, gone): the rows to insert and the target ids to delete, so that ``ranges`` (s, e; disjoint) equal the source.

    Insert: source rows of a range whose id the target does not hold.  Delete: target ids in a range that the range's
    own fetch lacks, and only if the fetch had a usable row: an empty one is no proof that rows should go.  With a
    column ``purge``, only where it is true.
    """
    purge = "purge" if "purge" in ranges.columns else F.lit(True).alias("purge")
    fetched = cut(in_windows(source, ranges.select("s", "e", purge), bin_ms), "fetched")
    usable = _usable(fetched)
    proven = usable.where("purge").select("s", "e").distinct()
    held = in_windows(target.select(TS, "id"), proven, bin_ms)
    gone = held.join(fetched.select("s", "id").distinct(), ["s", "id"], "left_anti").select("id").distinct()
    # Written, so that their size is known and a small one is broadcast against the target.
    return cut(absent(target, one_per_id(usable.select(*target.columns))), "new"), cut(gone, "gone")


def full_replace(source: DataFrame, target: DataFrame, ranges: DataFrame, bin_ms: int = DAY_MS // 16) -> DataFrame:
    """The target after ``replaced``, as one new state: nothing is deleted before what replaces it is there."""
    new, gone = replaced(source, target, ranges, bin_ms)
    return target.join(gone, "id", "left_anti").unionByName(new.select(*target.columns))


def replace_counts(source: DataFrame, target: DataFrame, ranges: DataFrame, bin_ms: int = DAY_MS // 16) -> DataFrame:
    """``ranges`` with fetched, ingested, failed, missing and orphans of a full replace."""
    key = ["s", "e"]
    fetched = in_windows(source, ranges.select(*key), bin_ms).withColumn("ok", clean_message(F.col("message")) != "")
    held = in_windows(target.select(TS, "id"), ranges.select(*key), bin_ms).select(*key, "id").distinct().withColumn("b", F.lit(True))
    ids = fetched.select(*key, "id").distinct().withColumn("a", F.lit(True)).join(held, [*key, "id"], "full_outer")
    sides = ids.groupBy(*key).agg(F.count_if(F.col("b").isNull()).alias("missing"), F.count_if(F.col("a").isNull()).alias("extra"))
    n = fetched.groupBy(*key).agg(F.count("*").alias("fetched"), F.count_if(F.col("ok")).alias("ingested"), F.count_if(~F.col("ok")).alias("failed"))
    out = ranges.select(*key).join(n, key, "left").join(sides, key, "left").na.fill(0)
    return out.withColumn("orphans", F.when(F.col("ingested") > 0, F.col("extra")).otherwise(0)).drop("extra")


def live_learn(source_n: Column, target_n: Column, stressed: Column) -> Column:
    """trust_target or replace, without a model: up to 25 % difference is trusted, and more target than source under stress."""
    d = difference_percent(source_n, target_n)
    return F.when((source_n == 0) & (target_n == 0), "trust_target").when(d <= LEARN_PERCENT, "trust_target").when((target_n > source_n) & stressed, "trust_target").otherwise("replace")


def blend_decision(source_n: Column, target_n: Column, expected: Column, sd: Column, level: Column) -> Column:
    """full_replace, live_learn or check_integrity, with a model's expectation; level is normal, elevated or critical."""
    sigma = F.when(level == "critical", 1.5).when(level == "elevated", 2.5).otherwise(4.0)
    bound = F.greatest(sigma * sd, 0.1 * expected, F.lit(10.0))
    d = difference_percent(source_n, target_n)
    return (
        F.when(F.abs(source_n - expected) <= bound, "full_replace")
        .when(d <= LEARN_PERCENT, "live_learn")
        .when((target_n > source_n) & (level != "normal"), "live_learn")
        .when(d <= TRUST_PERCENT, "live_learn")
        .otherwise("check_integrity")
    )


def history(now_ms: int, days: int, floor_ms: int | None = None, first: int = 7) -> list[tuple[int, int, bool]]:
    """The days of a full history, newest first, as (start_ms, end_ms, urgent): the first seven come before the rest.
    A floor (retention, or the oldest row) cuts the windows, and bounds them if ``days`` is 0, which means all."""
    today = now_ms - now_ms % DAY_MS
    if days == 0:
        if floor_ms is None:
            raise ValueError("an unbounded history needs the time of its oldest row")
        days = (now_ms - floor_ms) // DAY_MS + 1
    out = [(today - i * DAY_MS, today - (i - 1) * DAY_MS, i < first) for i in range(days)]
    return [(max(s, floor_ms or s), e, u) for s, e, u in out if floor_ms is None or e > floor_ms]


def rolling_window(now_ms: int, days: int = 10, floor_ms: int | None = None) -> tuple[int, int] | None:
    """The window that a rolling reconcile replays, cut to the supported history; None if nothing is left of it."""
    start = max(now_ms - days * DAY_MS, floor_ms if floor_ms is not None else now_ms - days * DAY_MS)
    return (start, now_ms) if now_ms > start else None


def reconcile(source: DataFrame, target: DataFrame, ranges: DataFrame, bin_ms: int = DAY_MS // 16) -> DataFrame:
    """The target after a sync of ``ranges`` (start_ms, end_ms): decisions, then a full replace where they ask for it."""
    due = cut(replace_ranges(decisions(source, target, ranges, bin_ms)), "ranges")
    return full_replace(source, target, due, bin_ms)
