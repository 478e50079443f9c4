"""Range scans, counts, samples and set algebra over (id, timestamp_ms) tables.

``sources.events`` puts the same bounds on the stored column, so they reach the Parquet row groups; samples are
TakeOrdered, never full sorts.  Joins with windows are equi-joins on time bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TS = "timestamp_ms"
DAY_MS = 86_400_000


def in_range(start: int, end: int) -> Column:
    """Half open, in milliseconds."""
    return (F.col(TS) >= start) & (F.col(TS) < end)


def in_closed_range(start: int, end: int) -> Column:
    """Both ends count."""
    return F.col(TS).between(start, end)


def scan(df: DataFrame, start: int, end: int) -> DataFrame:
    return df.where(in_range(start, end)) if end > start else df.where(F.lit(False))


def in_windows(rows: DataFrame, windows: DataFrame, bin_ms: int = DAY_MS) -> DataFrame:
    """``rows`` joined with the half-open ``windows`` (s, e, ...) that hold them, once per window.

    Both sides carry the number of a time bin, so this is an equi-join whatever the number of windows: Spark broadcasts
    the windows if their size allows, and shuffles by bin if not.  ``bin_ms`` should be about a window's length.
    """
    bin_of = lambda c: F.expr(f"({c} - pmod({c}, {bin_ms})) div {bin_ms}")
    binned = windows.where("e > s").withColumn("_last", F.col("e") - 1).withColumn("_bin", F.explode(F.sequence(bin_of("s"), bin_of("_last")))).drop("_last")
    return rows.withColumn("_bin", bin_of(TS)).join(binned, "_bin").where((F.col(TS) >= F.col("s")) & (F.col(TS) < F.col("e"))).drop("_bin")


def first_ids(df: DataFrame, start: int, end: int, n: int) -> DataFrame:
    return scan(df, start, end).select(TS, "id").orderBy(TS, "id").limit(n)


def last_ids(df: DataFrame, start: int, end: int, n: int) -> DataFrame:
    """The last n, in ascending order like the first: both sides compare in one order."""
    return scan(df, start, end).select(TS, "id").orderBy(F.desc(TS), F.desc("id")).limit(n).orderBy(TS, "id")


def page_after(df: DataFrame, after: tuple[int, str], n: int) -> DataFrame:
    """The page of n rows that follows (timestamp_ms, id)."""
    t, i = after
    return df.where((F.col(TS) > t) | ((F.col(TS) == t) & (F.col("id") > i))).orderBy(TS, "id").limit(n)


def pages(df: DataFrame, start: int, end: int, n: int = 5000):
    """The rows of a range page by page, each a list, until one is short.  For callers that take pages; a scan needs none."""
    after = None
    while True:
        own = scan(df, start, end).orderBy(TS, "id").limit(n) if after is None else page_after(scan(df, start, end), after, n)
        rows = own.collect()  # one page
        if rows:
            yield rows
        if len(rows) < n:
            return
        after = (rows[-1][TS], rows[-1]["id"])


def missing(source: DataFrame, target: DataFrame) -> DataFrame:
    return source.join(target.select("id"), "id", "left_anti")


def orphans(source: DataFrame, target: DataFrame) -> DataFrame:
    return target.join(source.select("id"), "id", "left_anti")


def overlap(source: DataFrame, target: DataFrame) -> DataFrame:
    return source.join(target.select("id"), "id", "left_semi")


def membership_count(target: DataFrame, ids: DataFrame, start: int, end: int) -> DataFrame:
    return scan(target, start, end).join(ids.select("id").distinct(), "id", "left_semi").agg(F.count("*").alias("n"))


def window_counts(source: DataFrame, target: DataFrame, length_ms: int) -> DataFrame:
    """Rows of both sides in each tumbling window, 0 where a side has none: one pass over each."""
    w = (F.col(TS) - F.pmod(F.col(TS), F.lit(length_ms))).alias("start_ms")
    s = source.groupBy(w).agg(F.count("*").alias("source_n"))
    t = target.groupBy(w).agg(F.count("*").alias("target_n"))
    return s.join(t, "start_ms", "full_outer").na.fill(0, ["source_n", "target_n"])


def one_per_id(df: DataFrame) -> DataFrame:
    """The earliest row of each id (then least message): a winner that does not depend on partitions."""
    w = Window.partitionBy("id").orderBy(TS, "message")
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def absent(target: DataFrame, new: DataFrame) -> DataFrame:
    """The rows of ``new`` whose id the target does not hold.  The target's ids are first cut down to those asked for,
    so a small ``new`` is broadcast and the target is not shuffled."""
    held = target.select("id").join(new.select("id"), "id", "left_semi")
    return new.join(held, "id", "left_anti")


def insert_if_absent(target: DataFrame, new: DataFrame) -> DataFrame:
    """The target with the new ids added; an id that is there keeps its row."""
    return target.unionByName(one_per_id(new).join(target.select("id"), "id", "left_anti").select(*target.columns))


def delete_ids(target: DataFrame, ids: DataFrame) -> DataFrame:
    return target.join(ids.select("id"), "id", "left_anti")


def delete_range(target: DataFrame, start: int, end: int) -> DataFrame:
    return target.where(~in_range(start, end)) if end > start else target


def reindex_window(dest: DataFrame, src: DataFrame, start: int, end: int) -> DataFrame:
    return insert_if_absent(dest, scan(src, start, end))


def end_samples(rows: DataFrame, key: list[str], n: int) -> DataFrame:
    """(key, first, last) with the first and last ``n`` of each key's rows as arrays of (timestamp_ms, id) in ascending order.

    Each row goes in twice, once per end, and one ranking serves both, so Spark cuts each group to ``n`` rows an end
    before it shuffles.
    """
    both = rows.select(*key, TS, "id", F.explode(F.array(F.lit(True), F.lit(False))).alias("up"))
    asc, desc = (lambda c: F.when(F.col("up"), F.col(c)).asc()), (lambda c: F.when(~F.col("up"), F.col(c)).desc())
    w = Window.partitionBy(*key, "up").orderBy(asc(TS), asc("id"), desc(TS), desc("id"))
    few = both.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    ends = lambda c: F.array_sort(F.collect_list(F.when(c, F.struct(TS, "id"))))  # noqa: E731  at most n
    return few.groupBy(*key).agg(ends(F.col("up")).alias("first"), ends(~F.col("up")).alias("last"))


def same_windows(a: DataFrame, b: DataFrame, windows: DataFrame, n: int = 64, bin_ms: int = DAY_MS) -> DataFrame:
    """``windows`` (s, e) with ``same``: equal counts, and equal first and last n ids.  Two scans a side, whatever the
    number of windows; an empty window is the same."""
    key = ["s", "e"]

    def side(df: DataFrame, name: str) -> DataFrame:
        hit = in_windows(df.select(TS, "id"), windows.select(*key), bin_ms)
        ids = lambda c: F.transform(c, lambda x: x["id"])
        out = hit.groupBy(*key).agg(F.count("*").alias("n")).join(end_samples(hit, key, n), key)
        return out.select(*key, F.struct("n", ids(F.col("first")).alias("f"), ids(F.col("last")).alias("l")).alias(name))

    out = windows.join(side(a, "x"), key, "left").join(side(b, "y"), key, "left")
    return out.withColumn("same", F.col("x").eqNullSafe(F.col("y"))).drop("x", "y")


def even_chunks(df: DataFrame, order: list[str], n: int | Column, by: list[str] | None = None) -> DataFrame:
    """``df`` with ``chunk``, 0 to n - 1, of sizes that differ by one at most, the larger first; within each batch ``by``.
    A batch is what one sender holds, so of bounded size."""
    w = Window.partitionBy(*(by or []))
    if isinstance(n, int) and by is None:
        return df.withColumn("chunk", F.ntile(n).over(w.orderBy(*order)) - 1)
    n = F.lit(n) if isinstance(n, int) else n
    out = df.withColumns({"_rn": F.row_number().over(w.orderBy(*order)) - 1, "_len": F.count("*").over(w), "_n": n.cast("long")})
    base, rem = F.expr("_len div _n"), F.expr("_len % _n")
    chunk = F.when(F.col("_rn") < rem * (base + 1), F.expr("_rn div (_len div _n + 1)")).otherwise(rem + F.expr("(_rn - (_len % _n) * (_len div _n + 1)) div greatest(_len div _n, 1)"))
    return out.withColumn("chunk", chunk.cast("int")).drop("_rn", "_len", "_n")
