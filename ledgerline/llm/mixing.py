"""Mixing sources to target weights, in DataFrame operations only.

Each source gets a budget of words.  Its documents are put in the order of a hash-random key, and prefix sums of their
sizes along that order say which document covers which words; the budget cuts the order at an exact word.  A budget
beyond the source's size takes whole epochs first.

The prefix sums are distributed: the key's range is cut into buckets of about ``BUCKET_ROWS`` rows, each (source,
bucket) is sorted and summed by itself, and adds the total of the buckets before it: those of its own run of buckets,
and whole runs before that, so that no window sees more than about the square root of a source's buckets.  So a source
of any size is spread over as many tasks as its rows need.  Identical documents (source, identifier, text hash, size) are one row with a
multiplicity up to the end, so repeats cannot fill a bucket.

Budgets: weights 1, 2, 3, 1, ... by source in code point order, null last; together they share all words.  A target
stops at ``MOST`` times its source's size and the excess goes to the others by weight, until none is above: the target
is min(cap, level * weight), and the level is found with one sort of the sources by cap / weight.

Edge cases: a null or blank text has size 0 and is taken 0 times.  Sources of size 0 have target 0.  An empty table
gives an empty result.  Equal keys fall back on identifier, then text hash; repeated rows share their words in
sequence.  Reruns agree, whatever the partitions.  Texts of any length are counted whole.  Extra columns play no part.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_broadcast, cut, documents

MOST = 3
CYCLE = 3
BUCKET_ROWS = 4096
SALT = "mix-1"


def word_count(text="text"):
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame) -> DataFrame:
    """``sources`` (source, source_size) with weight and target.  One row a source; every window runs over these."""
    one = Window.partitionBy(F.lit(0))
    order = one.orderBy(F.col("source").asc_nulls_last())
    weighed = sources.withColumn("weight", ((F.row_number().over(order) - 1) % CYCLE + 1).cast("double"))
    weighed = weighed.withColumns({"cap": (MOST * F.col("source_size")).cast("double"), "total": F.sum("source_size").over(one).cast("double")})
    ranked = one.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = ranked.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(ranked.rowsBetween(0, Window.unboundedFollowing))
    leveled = weighed.withColumn("own_level", level).withColumn("level", F.min(F.when(F.col("own_level") <= F.col("cap") / F.col("weight"), F.struct(F.col("cap") / F.col("weight"), "own_level"))).over(one)["own_level"])
    return leveled.select("source", "source_size", "weight", F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"))


def _on_source(left: DataFrame, right: DataFrame, also=None) -> DataFrame:
    """An inner join on the source, null being one, and what else holds."""
    other = right.withColumnRenamed("source", "s_")
    same = left["source"].eqNullSafe(F.col("s_"))
    return left.join(other, same if also is None else same & also).drop("s_")


def mix(sizes: DataFrame) -> DataFrame:
    """``sizes`` (source, doc_id, h, size; h any hash of the content) with source_size, target, taken and copies.

    ``taken`` are the words of the document that the mix takes, repeats counted; ``copies`` the number of times it is
    taken as a whole document, the cut one counting if half of it or more lies within the budget.
    """
    key = F.xxhash64(F.lit(SALT), F.col("doc_id").cast("string"), "h")
    rows = cut(sizes.groupBy("source", "doc_id", "h", "size").agg(F.count("*").alias("m")).withColumn("key", key), "sizes")
    n = rows.count()
    bits = min(40, max(0, math.ceil(math.log2(max(1, n) / BUCKET_ROWS))))
    rows = rows.withColumn("bucket", F.shiftrightunsigned("key", 64 - bits) if bits else F.lit(0).cast("long"))
    rows = rows.withColumn("run", F.shiftright("bucket", bits // 2))
    buckets = cut(rows.groupBy("source", "run", "bucket").agg(F.sum(F.col("size") * F.col("m")).alias("words")), "mix-buckets")
    runs = buckets.groupBy("source", "run").agg(F.sum("words").alias("all"))
    budget = targets(runs.groupBy("source").agg(F.sum("all").alias("source_size")))
    ahead = lambda by, c: F.coalesce(F.sum(c).over(Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = runs.withColumn("start", ahead(["source", "run"], "all")).drop("all")
    starts = cut(_on_source(starts, bounded_broadcast(budget)), "mix-runs")
    offsets = buckets.withColumn("inner", ahead(["source", "run", "bucket"], "words")).drop("words")
    starts = bounded_broadcast(starts.withColumnRenamed("run", "r_"))
    offsets = _on_source(offsets, starts, F.col("run") == F.col("r_")).withColumn("offset", F.col("start") + F.col("inner")).drop("r_", "run", "start", "inner")
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "h", "size").rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.drop("run").withColumn("before", F.coalesce(F.sum(F.col("size") * F.col("m")).over(inside), F.lit(0)))
    offsets = bounded_broadcast(cut(offsets, "mix-offsets").withColumnRenamed("bucket", "b_"))
    placed = _on_source(summed, offsets, F.col("bucket") == F.col("b_"))
    each = placed.withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)))
    at = F.col("offset") + F.col("before") + F.col("c") * F.col("size")
    budget_words = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("cast(round(target) as bigint) div source_size")).otherwise(0)
    each = each.withColumns({"epochs": epochs, "rest": F.when(F.col("source_size") > 0, budget_words - epochs * F.col("source_size")).otherwise(0)})
    part = F.greatest(F.lit(0).cast("long"), F.least("size", F.col("rest") - at))
    each = each.withColumn("part", part)
    return each.select("source", "doc_id", "h", "size", "source_size", "target", "c", (F.col("epochs") * F.col("size") + F.col("part")).cast("long").alias("taken"), (F.col("epochs") + F.when((F.col("part") > 0) & (2 * F.col("part") >= F.col("size")), 1).otherwise(0)).cast("int").alias("copies"))


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document, and its source."""
    sizes = documents(spark, sf_dir).select("source", "doc_id", F.xxhash64("text").alias("h"), word_count().alias("size"))
    return mix(sizes).select("doc_id", "size", "source_size", "target", "taken", "source")
