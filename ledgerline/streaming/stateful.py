"""Control state kept by the stream itself: one small state a tracker, however long its history."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Failures in a row for each level.
ELEVATED, CRITICAL = 3, 10


def level_of(streak: int) -> str:
    return "critical" if streak >= CRITICAL else "elevated" if streak >= ELEVATED else "normal"


def stepped(streak: int, backoff: int, failures: int, ok: bool, least: int, most: int) -> tuple[int, int, int]:
    """The tracker's state after one more outcome."""
    if ok:
        return max(streak - 1, 0), max(backoff // 2, least), failures
    return streak + 1, min(backoff * 2, most), failures + 1


def stress(outcomes: DataFrame, least: int = 3, most: int = 60) -> DataFrame:
    """(tracker, streak, backoff, failures, level) after each batch of a stream of outcomes (tracker, seq, ok); within a
    batch in order of seq."""
    def run(key: tuple, batches: Iterator[pd.DataFrame], own: GroupState) -> Iterator[pd.DataFrame]:
        now = own.get if own.exists else (0, least, 0)
        rows = pd.concat(list(batches)).sort_values("seq")
        for ok in rows["ok"]:
            now = stepped(*now, bool(ok), least, most)
        own.update(now)
        yield pd.DataFrame({"tracker": [key[0]], "streak": [now[0]], "backoff": [now[1]], "failures": [now[2]], "level": [level_of(now[0])]})

    kind = "tracker string, streak long, backoff long, failures long, level string"
    return outcomes.groupBy("tracker").applyInPandasWithState(run, kind, "streak long, backoff long, failures long", "update", GroupStateTimeout.NoTimeout)
