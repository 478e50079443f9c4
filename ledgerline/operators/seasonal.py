"""The volume model: kernel regression over seasonal features, feasibility of counts, integrity of event sets.

Samples are hourly counts, kept by ``keep_diverse`` to at most ``MOST_SAMPLES`` a series, so joining queries with all
samples is a join with a side of fixed size, not with the data.  Phases are of whole seconds.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranges import in_windows

# Fixed values.
MOST_SAMPLES = 1000
LEAST_SAMPLES = 5
RECENT = 10
REGIME = 2.0
BANDWIDTHS = {"hour": 2.0, "day": 1.0, "week": 0.5, "month": 0.3}
PERIODS = {"hour": ("{s} % 86400.0", 86400.0), "day": ("({s} / 86400.0) % 7.0", 7.0), "week": ("({s} / 86400.0) % 28.0", 28.0), "month": ("({s} / 86400.0) % 365.25", 365.25)}
HALF_LIFE_DAYS = 30.0
EVICT_HALF_LIFE_DAYS = 90.0
SELF_RELIANT = 0.85
HOUR_MS = 3_600_000
DAY_MS = 86_400_000


def features(ts: str) -> dict[str, Column]:
    """sin and cos of the place in the day, week, four weeks and year, by name, for a column of milliseconds."""
    out = {}
    for name, (phase, period) in PERIODS.items():
        angle = F.lit(2 * math.pi) * F.expr(phase.format(s=f"cast({ts} div 1000 as double)")).cast("double") / F.lit(period)
        out |= {f"{name}_sin": F.sin(angle), f"{name}_cos": F.cos(angle)}
    return out


def hourly_samples(events: DataFrame) -> DataFrame:
    """(timestamp_ms, value): events an hour.  One sample an hour keeps the model's unit that of its use."""
    hour = F.col("timestamp_ms") - F.pmod(F.col("timestamp_ms"), F.lit(HOUR_MS))
    return events.groupBy(hour.alias("timestamp_ms")).agg(F.count("*").alias("value"))


def _d2(a: dict[str, Column], b: dict[str, Column]) -> Column:
    return sum((((a[f"{n}_{f}"] - b[f"{n}_{f}"]) ** 2) / F.lit(w * w) for n, w in BANDWIDTHS.items() for f in ("sin", "cos")), F.lit(0.0))


def similarity(ts_a: str, ts_b: str, ref: str) -> Column:
    """Weight of sample b for a query at a, as seen from time ref: seasonal nearness times freshness."""
    age = F.greatest(F.lit(0.0), (F.col(ref) - F.col(ts_b)) / F.lit(86_400_000.0))
    return F.exp(-_d2(features(ts_a), features(ts_b)) / 2) * F.exp(-age * math.log(2) / HALF_LIFE_DAYS)


def regime(recent: Column, mean: Column) -> Column:
    """The factor for a recent mean (null: too few samples) that is far from the expected one."""
    ratio = recent / mean
    return F.when(recent.isNull() | (mean < 1), 1.0).when((ratio < 1 / REGIME) | (ratio > REGIME), F.sqrt(ratio)).otherwise(1.0)


def regime_change(recent: Column, expected: Column) -> Column:
    """How far the recent mean is from the expected one, as a ratio; null if it is near, or either is not known."""
    ratio = recent / expected
    return F.when((expected >= 1) & ((ratio < 1 / REGIME) | (ratio > REGIME)), ratio)


def recent_mean(samples: DataFrame) -> DataFrame:
    """One row: the newest sample's time, the number of samples, and the mean of the last ten, null below three."""
    last = samples.orderBy(F.desc("timestamp_ms")).limit(RECENT).agg(F.when(F.count("*") >= 3, F.avg("value")).alias("recent"))
    return samples.agg(F.max("timestamp_ms").alias("newest"), F.count("*").alias("n_samples")).crossJoin(last)  # one row each


def expected(queries: DataFrame, samples: DataFrame) -> DataFrame:
    """``queries`` (q_ms, ...) with mean and sd of the expected hourly count and the regime factor in the mean; null below
    five samples or without weight.  ``samples``: a kept table, so at most ``MOST_SAMPLES`` rows."""
    q = queries.select("q_ms").distinct().crossJoin(recent_mean(samples)).withColumn("ref", F.greatest("newest", "q_ms"))
    pairs = q.crossJoin(samples.select("timestamp_ms", F.col("value").cast("double").alias("v")))
    w = pairs.withColumn("w", similarity("q_ms", "timestamp_ms", "ref")).where("w > 1e-10")
    sums = w.groupBy("q_ms", "n_samples", "recent").agg(F.sum("w").alias("sw"), F.sum(F.col("w") * F.col("v")).alias("swv"), F.sum(F.col("w") * F.col("v") * F.col("v")).alias("swvv"))
    mean = F.col("swv") / F.col("sw")
    sd = F.sqrt(F.greatest(F.lit(0.0), F.col("swvv") / F.col("sw") - mean * mean))
    known = sums.where((F.col("n_samples") >= LEAST_SAMPLES) & (F.col("sw") >= 1e-10)).select("q_ms", mean.alias("m"), sd.alias("sd"), "recent")
    known = known.withColumn("regime", regime(F.col("recent"), F.col("m"))).withColumn("mean", F.col("m") * F.col("regime"))
    return queries.join(known.select("q_ms", "mean", "sd", "regime", "recent"), "q_ms", "left")


def feasibility(n: Column, mean: Column, sd: Column, hours: Column, level: Column) -> Column:
    sigma = F.when(level == "critical", 2.5).when(level == "elevated", 4.0).otherwise(6.0)
    bound = F.greatest(sigma * sd * F.sqrt(hours), 0.3 * mean * hours, F.lit(100.0))
    return F.when(mean.isNull(), "no_history").when(F.abs(n - mean * hours) <= bound, "feasible").otherwise("suspicious")


def confidence(samples: DataFrame) -> DataFrame:
    """One row, ``confidence``: how many samples there are, and how they cover day and week."""
    f = features("timestamp_ms")
    agg = samples.agg(F.count("*").alias("n"), *[F.avg(f[c]).alias(c) for c in ("hour_sin", "hour_cos", "day_sin", "day_cos")])
    cover = lambda a: F.least(F.lit(1.0), (1 - F.sqrt(F.col(f"{a}_sin") ** 2 + F.col(f"{a}_cos") ** 2)) * F.least(F.lit(1.0), F.col("n") / 24.0))
    out = F.least(F.lit(1.0), (1 - F.exp(-F.col("n") / 100.0)) * F.least(F.lit(1.0), 0.6 * cover("hour") + 0.4 * cover("day")))
    return agg.select(F.when(F.col("n") < LEAST_SAMPLES, 0.0).otherwise(out).alias("confidence"))


def blend(mean: Column, sd: Column, conf: Column, n: Column) -> tuple[Column, Column]:
    """Mean and sd of the model blended with the target's count ``n``."""
    m = F.when(mean.isNull(), n.cast("double")).otherwise(mean * conf + n * (1 - conf))
    wide = F.greatest(sd, F.abs(n - (mean * conf + n * (1 - conf))) * (1 - conf), F.lit(10.0))
    return m, F.when(mean.isNull(), F.greatest(F.sqrt(n.cast("double")), F.lit(10.0))).when(conf < 0.5, wide).otherwise(sd)


def self_reliant(conf: Column) -> Column:
    """Whether the model needs no help from the target's counts."""
    return conf >= SELF_RELIANT


def near_sample(queries: DataFrame, samples: DataFrame, tolerance_ms: int = HOUR_MS) -> DataFrame:
    """``queries`` (q_ms, ...) with ``near``: whether a sample lies less than the tolerance away.  An equi-join on time
    bins of the tolerance, each with its neighbours."""
    bin_of = lambda c: F.expr(f"({c} - pmod({c}, {tolerance_ms})) div {tolerance_ms}")
    s = samples.select("timestamp_ms", F.explode(F.array(*[bin_of("timestamp_ms") + i for i in (-1, 0, 1)])).alias("b"))
    close = F.abs(F.col("timestamp_ms") - F.col("q_ms")) < tolerance_ms
    hit = queries.select("q_ms", bin_of("q_ms").alias("b")).distinct().join(s, "b").where(close).select("q_ms").distinct()
    return queries.join(hit.withColumn("near", F.lit(True)), "q_ms", "left").na.fill(False, ["near"])


def nearest(samples: DataFrame, now_ms: int) -> DataFrame:
    """``samples`` with ``diversity``: distance to the nearest other, less with age.  For a kept table: its square is
    at most MOST_SAMPLES^2."""
    other = samples.select(F.col("timestamp_ms").alias("o_ms"))
    near = samples.crossJoin(other).where("timestamp_ms <> o_ms").groupBy("timestamp_ms", "value").agg(F.min(_d2(features("timestamp_ms"), features("o_ms"))).alias("d2"))
    age = F.greatest(F.lit(0.0), (F.lit(now_ms) - F.col("timestamp_ms")) / F.lit(86_400_000.0))
    return near.withColumn("diversity", F.sqrt("d2") * (0.5 + 0.5 * F.exp(-age * math.log(2) / EVICT_HALF_LIFE_DAYS))).drop("d2")


def most_diverse(samples: DataFrame, now_ms: int, keep: int) -> DataFrame:
    """The ``keep`` samples of largest diversity, ties to the earlier."""
    return nearest(samples, now_ms).orderBy(F.desc(F.round("diversity", 9)), "timestamp_ms").limit(keep)


def diversity_stats(samples: DataFrame, now_ms: int) -> DataFrame:
    """One row: mean and least diversity; null below two samples."""
    return nearest(samples, now_ms).agg(F.avg("diversity").alias("mean"), F.min("diversity").alias("least"))


def _points(ts: np.ndarray) -> np.ndarray:
    """Features over their bandwidths, so that distances are plain."""
    days = (ts // 1000).astype(float) / 86400.0
    parts = []
    for name, period in (("hour", 1.0), ("day", 7.0), ("week", 28.0), ("month", 365.25)):
        x = 2 * math.pi * (days % period) / period
        parts += [np.sin(x) / BANDWIDTHS[name], np.cos(x) / BANDWIDTHS[name]]
    return np.stack(parts, 1)


def evict(ts: np.ndarray, most: int = MOST_SAMPLES) -> np.ndarray:
    """Which of the samples, added in this order, remain if each that finds ``most`` there first puts out the least
    diverse (ties: the earliest); as indices."""
    if len(ts) <= most:
        return np.arange(len(ts))
    x, own = _points(ts), np.arange(most)
    d2 = ((x[own][:, None] - x[own][None]) ** 2).sum(2)
    np.fill_diagonal(d2, np.inf)
    for new in range(most, len(ts)):
        age = np.maximum(0.0, (ts[new] - ts[own]) / 86_400_000.0)
        value = np.round(np.sqrt(d2.min(1)) * (0.5 + 0.5 * np.exp(-age * math.log(2) / EVICT_HALF_LIFE_DAYS)), 12)
        out = np.lexsort((ts[own], value))[0]
        own[out] = new
        d = ((x[own] - x[new]) ** 2).sum(1)
        d[out] = np.inf
        d2[out], d2[:, out] = d, d
    return np.sort(own)


def keep_diverse(samples: DataFrame, most: int = MOST_SAMPLES) -> DataFrame:
    """``samples`` (series, timestamp_ms, value) in order of time with the least diverse put out whenever there are
    ``most`` of a series.  One task a series: its samples are hours, whatever the number of events."""
    def run(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values(["timestamp_ms", "value"]).reset_index(drop=True)
        return own.iloc[evict(own["timestamp_ms"].to_numpy(), most)]

    few = samples.withColumn("_n", F.count("*").over(Window.partitionBy("series")))
    whole = few.where(F.col("_n") <= most).drop("_n")
    return whole.unionByName(few.where(F.col("_n") > most).drop("_n").groupBy("series").applyInPandas(run, samples.schema))


def integrity(events: DataFrame, window_ms: int) -> DataFrame:
    """``integrity_of`` each tumbling window that holds events, by start_ms."""
    t = F.col("timestamp_ms")
    start = t - F.pmod(t, F.lit(window_ms))
    return _integrity(events.select(start.alias("s"), (start + window_ms).alias("e"), "timestamp_ms")).withColumnRenamed("s", "start_ms").drop("e")


def integrity_of(events: DataFrame, windows: DataFrame, bin_ms: int = DAY_MS) -> DataFrame:
    """``windows`` (s, e) with (n, temporal, diversity, uniformity, gap, score, status) of their events; without an event
    a window is Invalid."""
    out = windows.join(_integrity(in_windows(events.select("timestamp_ms"), windows.select("s", "e"), bin_ms)), ["s", "e"], "left")
    return out.na.fill(0, ["n"]).na.fill("Invalid", ["status"])


def _integrity(rows: DataFrame) -> DataFrame:
    """Scores of ``rows`` (s, e, timestamp_ms) by window.

    No task sees more than a window's seconds, however many events they hold: events are counted by millisecond, gaps
    folded within each second (1000 values), and only then do windows run, over seconds.  Neighbours on the circle of
    the day are adjacent in angle, so a sort of the seconds replaces the comparison of all pairs.
    """
    key = ["s", "e"]
    ms = rows.groupBy(*key, F.expr("timestamp_ms div 1000").alias("sec"), "timestamp_ms").agg(F.count("*").alias("c"))
    fold = "aggregate(slice(t, 2, size(t) - 1), named_struct('p', t[0], 'q', 0.0D, 'm', 0L), (a, x) -> named_struct('p', x, 'q', a.q + cast(x - a.p as double) * (x - a.p), 'm', greatest(a.m, x - a.p)))"
    sec = ms.groupBy(*key, "sec").agg(F.sum("c").alias("c"), F.array_sort(F.collect_list("timestamp_ms")).alias("t"))
    sec = sec.select(*key, "sec", "c", F.col("t")[0].alias("first"), F.element_at("t", -1).alias("last"), F.expr(fold).alias("g")).select("*", "g.q", "g.m").drop("g")
    by_time = Window.partitionBy(*key).orderBy("sec")
    every = Window.partitionBy(*key)
    sec = sec.withColumns({
        "n": F.sum("c").over(every),
        "end": F.sum("c").over(by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "border": F.coalesce(F.col("first") - F.lag("last").over(by_time), F.lit(0)),
        "place": F.pmod(F.col("sec"), F.lit(86400)),
    })
    # Every step-th event is asked for its nearest in phase: so many of a second's events are.
    step = F.expr("n div least(n, 50)")
    upto = lambda x: F.ceil(x / step)
    sec = sec.withColumn("asked", upto(F.col("end")) - upto(F.col("end") - F.col("c")))
    place = sec.groupBy(*key, "place").agg(F.sum("c").alias("c"), F.sum("asked").alias("asked"))
    by_place = every.orderBy("place")
    left = F.coalesce(F.col("place") - F.lag("place").over(by_place), F.col("place") + 86400 - F.max("place").over(every))
    right = F.coalesce(F.lead("place").over(by_place) - F.col("place"), F.min("place").over(every) + 86400 - F.col("place"))
    angle = F.lit(2 * math.pi) * F.col("place") / 86400.0
    place = place.withColumns({"near": F.when(F.col("c") > 1, 0).otherwise(F.least(left, right)), "angle": angle})
    weighted = lambda f: F.sum(F.col("c") * f("angle")) / F.sum("c")
    circle = place.groupBy(*key).agg(
        (F.sum(F.col("asked") * 2 * F.abs(F.sin(F.lit(math.pi) * F.col("near") / 86400.0))) / F.sum("asked")).alias("chord"),
        F.sqrt(weighted(F.sin) ** 2 + weighted(F.cos) ** 2).alias("r"),
    )
    gaps = F.greatest(F.col("n") - 1, F.lit(1))
    line = sec.groupBy(*key).agg(
        F.max("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"),
        F.sum(F.col("q") + F.col("border").cast("double") * F.col("border")).alias("q"), F.max(F.greatest("m", "border")).alias("gm"),
    )
    g = (F.col("last") - F.col("first")) / gaps
    agg = line.withColumns({"g": g, "gs": F.sqrt(F.greatest(F.lit(0.0), F.col("q") / gaps - g * g))}).join(circle, key)
    w, hours = (F.col("e") - F.col("s")).cast("double"), (F.col("e") - F.col("s")) / float(HOUR_MS)
    dist = lambda x: F.least(F.lit(1.0), F.abs(x) / w)
    temporal = F.when(F.col("n") < 2, 0.5).otherwise(F.least(F.lit(1.0), (F.col("last") - F.col("first")) / w * (1 - (dist(F.col("first") - F.col("s")) + dist(F.col("e") - F.col("last"))) / 4)))
    diversity = F.when(F.col("n") < 3, 0.5).otherwise(F.least(F.lit(1.0), F.col("chord") / 2 * 4))
    spread = F.when(hours >= 24, 0.8).otherwise(hours / 30)
    uniformity = F.when(F.col("n") < 4, 0.5).otherwise(F.least(F.lit(1.0), (1 - F.col("r")) / 2 / spread))
    want = w / F.col("n")
    mean_score = 1 - F.least(F.lit(1.0), F.abs(F.col("g") - want) / want)
    cv = F.when(F.col("g") > 0, F.col("gs") / F.col("g")).otherwise(1.0)
    widest = F.when(F.col("gm") / w > 0.5, 0.3).otherwise(1 - F.col("gm") / w)
    gap = F.when(F.col("n") < 3, 0.5).otherwise(0.3 * mean_score + 0.4 * F.exp(-cv / 2) + 0.3 * widest)
    out = agg.select(*key, "n", temporal.alias("temporal"), diversity.alias("diversity"), uniformity.alias("uniformity"), gap.alias("gap"))
    score = 0.25 * F.col("temporal") + 0.30 * F.col("diversity") + 0.25 * F.col("uniformity") + 0.20 * F.col("gap")
    out = out.withColumn("score", F.when(F.col("n") < 3, 0.1).otherwise(score))
    return out.withColumn("status", F.when(F.col("n") < 3, "Partial").when(F.col("score") > 0.7, "Valid").when(F.col("score") > 0.3, "Partial").otherwise("Invalid"))
