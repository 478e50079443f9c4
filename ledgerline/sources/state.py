"""Small state kept between runs: cursors, watermarks, samples; and the configuration."""

from __future__ import annotations

import json
import os
import tomllib
from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save(path: str, state: dict) -> None:
    """Writes beside the file, then renames: a reader sees the old state or the new."""
    with open(path + ".tmp", "w") as f:
        json.dump(state, f, sort_keys=True)
    os.replace(path + ".tmp", path)


def load(path: str, default: dict, strict: bool = True) -> dict:
    """The state, or ``default`` if there is no file; a damaged file raises, or gives the default if not ``strict``."""
    try:
        with open(path) as f:
            return json.load(f)
    except FileNotFoundError:
        return default
    except ValueError:
        if strict:
            raise
        return default


def cursors(spark: SparkSession, state: dict) -> DataFrame:
    """(stream, next_token, next_start_time_ms) of a checkpoint."""
    rows = [(k, v.get("next_token"), v.get("next_start_time_ms")) for k, v in sorted(state.get("streams", {}).items())]
    return spark.createDataFrame(rows, "stream string, next_token string, next_start_time_ms long")


def merge_watermarks(old: DataFrame, new: DataFrame) -> DataFrame:
    """(stable, watermark_ms, changed): watermarks only rise."""
    both = old.select("stable", F.col("watermark_ms").alias("o")).join(new.groupBy("stable").agg(F.max("watermark_ms").alias("n")), "stable", "full_outer")
    return both.select("stable", F.greatest("o", "n").alias("watermark_ms"), F.coalesce(F.col("n") > F.col("o"), F.col("o").isNull()).alias("changed"))


@dataclass(frozen=True)
class Config:
    """All settings, with their defaults."""

    log_groups: tuple[str, ...] = ()
    index_prefix: str = "logs"
    batch_size: int = 100
    max_in_flight: int = 2
    poll_interval_secs: int = 15
    reconcile_interval_secs: int = 900
    backfill_days: int = 30
    heal_days: int = 30
    http_timeout_secs: int = 30
    backoff_base_ms: int = 200
    backoff_max_ms: int = 10_000
    disable_reconcile: bool = False
    disable_conflict_reindex: bool = False
    cold_age_days: int = 7
    disk_guard: bool = True
    disk_buffer_bytes: int = 2 << 30
    min_keep_days: int = 7

    @staticmethod
    def load(path: str | None = None, env: dict[str, str] | None = None) -> Config:
        """File, then environment (upper-case names; numbers that do not parse are passed over), then a check."""
        out = Config()
        if path:
            with open(path, "rb") as f:
                raw = tomllib.load(f)
            out = replace(out, **{k: tuple(v) if isinstance(v, list) else v for k, v in raw.items() if k in {x.name for x in fields(Config)}})
        for f in fields(Config):
            text = (env or {}).get(f.name.upper())
            if text is None:
                continue
            kind = type(getattr(out, f.name))
            if kind is bool:
                out = replace(out, **{f.name: text in ("1", "true")})
            elif kind is int:
                if text.strip().lstrip("-").isdigit():
                    out = replace(out, **{f.name: int(text)})
            else:
                out = replace(out, **{f.name: tuple(x.strip() for x in text.split(",") if x.strip()) if kind is tuple else text})
        if not out.log_groups:
            raise ValueError("no log group is given")
        if out.batch_size < 1 or out.max_in_flight < 1:
            raise ValueError("batch_size and max_in_flight must be positive")
        return out
