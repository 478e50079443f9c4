"""The volume model and integrity scores against plain loops."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from ledgerline.operators import seasonal as S

HOUR = 3_600_000


def phases(ms):
    s = float(ms // 1000)
    return [(s % 86400) / 86400, (s / 86400 % 7) / 7, (s / 86400 % 28) / 28, (s / 86400 % 365.25) / 365.25]


def distance2(a, b):
    out = 0.0
    for x, y, w in zip(phases(a), phases(b), (2.0, 1.0, 0.5, 0.3), strict=True):
        out += ((math.sin(2 * math.pi * x) - math.sin(2 * math.pi * y)) ** 2 + (math.cos(2 * math.pi * x) - math.cos(2 * math.pi * y)) ** 2) / w**2
    return out


def brute_evict(ts, most):
    kept = []
    for i, now in enumerate(ts):
        if len(kept) >= most:
            def value(j):
                near = min(distance2(ts[j], ts[o]) for o in kept if o != j)
                return round(math.sqrt(near) * (0.5 + 0.5 * math.exp(-max(0, now - ts[j]) / 86_400_000 * math.log(2) / 90)), 12), ts[j]  # noqa: B023
            kept.remove(min(kept, key=value))
        kept.append(i)
    return sorted(kept)


def test_eviction_is_sequential():
    rng = random.Random(1)
    ts = sorted({1_700_000_000_000 + rng.randrange(2000) * HOUR for _ in range(120)})
    assert list(S.evict(np.array(ts), 20)) == brute_evict(ts, 20)
    assert list(S.evict(np.array(ts[:5]), 20)) == list(range(5))


def test_more_samples_than_are_kept(spark):
    """Over 1000 hours: 1000 stay, the result does not hang on partitions, and the model uses just these."""
    rows = spark.range(1300).select(F.lit("x").alias("series"), (F.col("id") * HOUR).alias("timestamp_ms"), (50 + F.col("id") % 24).alias("value"))
    kept = S.keep_diverse(rows.repartition(7))
    again = S.keep_diverse(rows.repartition(3))
    got = sorted(r["timestamp_ms"] for r in kept.collect())
    assert len(got) == 1000 and got == sorted(r["timestamp_ms"] for r in again.collect()) and got[-1] == 1299 * HOUR
    q = spark.createDataFrame([(1300 * HOUR,)], "q_ms long")
    mean = S.expected(q, kept.drop("series")).first()["mean"]
    table = [(t, 50 + t // HOUR % 24) for t in got]
    ws = [(math.exp(-distance2(1300 * HOUR, t) / 2) * math.exp(-(1300 * HOUR - t) / 86_400_000 * math.log(2) / 30), v) for t, v in table]
    m = sum(w * v for w, v in ws) / sum(w for w, _ in ws)
    assert abs(mean - m) < 1e-6


def test_whole_seconds(spark):
    df = spark.createDataFrame([(1_700_000_000_001, 1_700_000_000_999)], "a long, b long")
    assert df.select(*[(S.features("a")[k] == S.features("b")[k]).alias(k) for k in S.features("a")]).first() == (True,) * 8


def brute_integrity(ts, s, e):
    if not ts:
        return 0.0, "Invalid"
    if len(ts) < 3:
        return 0.1, "Partial"
    ts, n, w = sorted(ts), len(ts), float(e - s)
    temporal = min(1.0, (ts[-1] - ts[0]) / w * (1 - (min(1, abs(ts[0] - s) / w) + min(1, abs(e - ts[-1]) / w)) / 4))
    at = [2 * math.pi * ((t // 1000) % 86400) / 86400 for t in ts]
    points = [(math.sin(x), math.cos(x)) for x in at]
    near = [min(math.dist(points[i], points[j]) for j in range(n) if j != i) for i in range(0, n, max(1, n // min(n, 50)))]
    diversity = min(1.0, sum(near) / len(near) / 2 * 4)
    r = math.hypot(sum(p[0] for p in points) / n, sum(p[1] for p in points) / n)
    hours = w / HOUR
    uniformity = 0.5 if n < 4 else min(1.0, (1 - r) / 2 / (0.8 if hours >= 24 else hours / 30))
    gaps = [b - a for a, b in zip(ts, ts[1:], strict=False)]
    mean = sum(gaps) / len(gaps)
    sd = math.sqrt(sum((g - mean) ** 2 for g in gaps) / len(gaps))
    want = w / n
    gap = 0.3 * (1 - min(1, abs(mean - want) / want)) + 0.4 * math.exp(-(sd / mean if mean else 1.0) / 2) + 0.3 * (0.3 if max(gaps) / w > 0.5 else 1 - max(gaps) / w)
    score = 0.25 * temporal + 0.30 * diversity + 0.25 * uniformity + 0.20 * gap
    return score, "Valid" if score > 0.7 else "Partial" if score > 0.3 else "Invalid"


def test_integrity(spark):
    """Windows of minutes and of several days, dense ones with many events in a second, single ones, empty ones."""
    rng = random.Random(5)
    windows = [(i * 10**9, i * 10**9 + w) for i, w in enumerate((60_000, HOUR, 6 * HOUR, 24 * HOUR, 250 * HOUR, HOUR, HOUR, HOUR, HOUR, HOUR))]
    events = {}
    for i, (s, e) in enumerate(windows):
        n = (40, 400, 1000, 300, 700, 1, 2, 3, 0, 4)[i]
        own = [rng.randrange(s, e) for _ in range(n)]
        events[s] = own + ([s + 1000] * 60 if i == 1 else [])
    df = spark.createDataFrame([(t,) for own in events.values() for t in own], "timestamp_ms long")
    got = {r["s"]: r for r in S.integrity_of(df, spark.createDataFrame(windows, "s long, e long")).collect()}
    for s, e in windows:
        score, status = brute_integrity(events[s], s, e)
        assert got[s]["status"] == status and got[s]["n"] == len(events[s]) and abs((got[s]["score"] or 0.0) - score) < 1e-9
