"""What a reconcile does with a range that differs: ask the volume model whether the source's answer is plausible, then
replace, insert only, or keep; and what the model learns from it.

All ranges of a run are judged by one state of the model; what they record is its next state.  Samples are hourly, so a
count enters the model divided by its hours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import cut
from . import seasonal as S
from .ranges import DAY_MS, TS, in_windows
from .reconcile import blend_decision, full_replace, live_learn


def range_counts(source: DataFrame, target: DataFrame, ranges: DataFrame, bin_ms: int = DAY_MS) -> DataFrame:
    """``ranges`` (s, e) with source_n and target_n: one pass over each side."""
    n = lambda rows, name: in_windows(rows.select(TS), ranges.select("s", "e"), bin_ms).groupBy("s", "e").agg(F.count("*").alias(name))
    return ranges.join(n(source, "source_n"), ["s", "e"], "left").join(n(target, "target_n"), ["s", "e"], "left").na.fill(0, ["source_n", "target_n"])


def decide(counts: DataFrame, samples: DataFrame, level: str = "normal") -> DataFrame:
    """``counts`` (s, e, source_n, target_n) with feasibility (feasible, suspicious, no_history, or blend where the model
    is not yet self-reliant), action (full_replace, live_learn, check_integrity), and the sample that is verified by it
    (null: none).  ``level``: the source's stress, normal, elevated or critical."""
    hours = (F.col("e") - F.col("s")) / F.lit(float(S.HOUR_MS))
    q = counts.withColumn("q_ms", F.expr("s + (e - s) div 2"))
    x = S.expected(q, samples).crossJoin(S.confidence(samples)).withColumn("hours", hours)  # one row of confidence
    lvl, stressed = F.lit(level), F.lit(level != "normal")
    plain = S.feasibility(F.col("source_n"), F.col("mean"), F.col("sd"), F.col("hours"), lvl)
    x = x.withColumn("feasibility", F.when(S.self_reliant(F.col("confidence")), plain).otherwise("blend"))
    mean, sd = S.blend(F.col("mean"), F.col("sd"), F.col("confidence"), F.col("target_n") / F.col("hours"))
    blended = blend_decision(F.col("source_n"), F.col("target_n"), mean * F.col("hours"), sd * F.sqrt("hours"), lvl)
    learned = F.when(live_learn(F.col("source_n"), F.col("target_n"), stressed) == "trust_target", "live_learn").otherwise("full_replace")
    x = x.withColumn("action", F.when(F.col("feasibility") == "blend", blended).when(F.col("feasibility") == "no_history", learned).when(F.col("feasibility") == "feasible", "full_replace").otherwise("check_integrity"))
    unproven = (F.col("feasibility") == "no_history") & (F.col("source_n") == 0) & stressed
    verified = F.when(F.col("action") == "live_learn", F.col("target_n")).when((F.col("action") == "full_replace") & ~unproven, F.col("source_n"))
    return x.select("s", "e", "source_n", "target_n", "feasibility", "action", (verified / F.col("hours")).alias("verified"), "hours")


def recorded(decided: DataFrame, samples: DataFrame) -> DataFrame:
    """(timestamp_ms, value): the samples that a run adds.  Besides the verified ones, the target's own count where the
    model needed it and no sample lay within an hour."""
    own = decided.where("verified is not null").select(F.col("s").alias(TS), F.col("verified").alias("value"))
    asked = S.near_sample(decided.where("feasibility = 'blend'").withColumn("q_ms", F.col("s")), samples).where("not near")
    return own.unionByName(asked.select(F.col("s").alias(TS), (F.col("target_n") / F.col("hours")).alias("value")))


def learn(samples: DataFrame, new: DataFrame, most: int = S.MOST_SAMPLES) -> DataFrame:
    """The model's next state: ``samples`` (series, timestamp_ms, value) with the new ones, the least diverse put out."""
    return S.keep_diverse(samples.unionByName(new.select(*samples.columns)), most)


def insert_usable(source: DataFrame, target: DataFrame, ranges: DataFrame, bin_ms: int = DAY_MS) -> DataFrame:
    """The target with what it lacks of those ``ranges`` (s, e) whose source events are Valid or Partial; nothing is deleted."""
    good = S.integrity_of(source, ranges, bin_ms).where("status <> 'Invalid'").select("s", "e")
    return full_replace(source, target, cut(good.withColumn("purge", F.lit(False)), "usable"), bin_ms)


def apply(source: DataFrame, target: DataFrame, decided: DataFrame, bin_ms: int = DAY_MS) -> DataFrame:
    """The target after all actions: ranges to replace are made equal to the source, the others get what they lack if
    their events are usable, and lose nothing."""
    status = S.integrity_of(source, decided.where("action <> 'full_replace'").select("s", "e"), bin_ms).where("status <> 'Invalid'")
    due = decided.where("action = 'full_replace'").select("s", "e", F.lit(True).alias("purge")).unionByName(status.select("s", "e", F.lit(False).alias("purge")))
    return full_replace(source, target, cut(due, "due"), bin_ms)


def safe_replace(source: DataFrame, target: DataFrame, ranges: DataFrame, samples: DataFrame, level: str = "normal", bin_ms: int = DAY_MS) -> tuple[DataFrame, DataFrame]:
    """(the target after the run, the samples it adds) for ``ranges`` (s, e)."""
    decided = cut(decide(range_counts(source, target, ranges, bin_ms), samples, level), "decided")
    return apply(source, target, decided, bin_ms), recorded(decided, samples)
