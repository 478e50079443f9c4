"""The tail: late rows, repeats, restarts, state."""

import pytest
from pyspark.sql import functions as F

from ledgerline import catalogue
from ledgerline.operators import ranges as R
from ledgerline.sources import state
from ledgerline.streaming import stateful, tail

HOUR, DAY = 3_600_000, 86_400_000
SCHEMA = "id string, timestamp_ms long, message string, log_group string"


def put(spark, folder, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}.parquet")


def ids(spark, target):
    return sorted((r["id"], r["ts_ms"]) for r in spark.read.parquet(target).collect())


def test_late_rows_repeats_and_restart(spark, tmp_path):
    src, dst, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    put(spark, src, "a", [("1", 100 * HOUR, '{"a":1}', "g"), ("n", None, "x", "g"), ("m", 5, None, "g")])
    put(spark, src, "b", [("2", 200 * HOUR, "two", "g"), ("1", 100 * HOUR, '{"a":1}', "g")])
    put(spark, src, "c", [("3", 10 * HOUR, "late", "g"), ("e", 1, "  ", "g")])
    read = f"{src}/*.parquet"
    tail.tail(spark, read, SCHEMA, dst, check, files_per_trigger=1)
    assert ids(spark, dst) == [("1", 100 * HOUR), ("2", 200 * HOUR), ("3", 10 * HOUR)]
    # A restart takes the new file alone; an id that returns under another day keeps its row.
    put(spark, src, "d", [("1", 300 * HOUR, "moved", "g"), ("4", 5 * HOUR, "very late", "g")])
    query = tail.tail(spark, read, SCHEMA, dst, check, files_per_trigger=1)
    assert query.lastProgress["numInputRows"] == 2
    assert ids(spark, dst) == [("1", 100 * HOUR), ("2", 200 * HOUR), ("3", 10 * HOUR), ("4", 5 * HOUR)]
    # Without its checkpoint the stream begins again, and adds nothing.
    tail.tail(spark, read, SCHEMA, dst, str(tmp_path / "check2"))
    assert len(ids(spark, dst)) == 4


def test_total_beyond_a_long(spark, tmp_path):
    """Times whose sum no long holds are summed exactly; a sum that a long holds is one."""
    for n, kind in ((3000, "decimal(29,0)"), (300, "bigint")):
        kept = [i for i in range(n) if i % 97 != 5 and i % 211]
        at = 8_000_000_000_000_000
        rows = spark.range(n).where("id % 97 <> 5 and id % 211 <> 0").select(F.col("id").alias("event_id"), F.timestamp_millis(F.col("id") + at).alias("ts"), F.lit("click").alias("event_type"), F.lit("{}").alias("props"))
        rows.write.parquet(f"{tmp_path}/{n}/events.parquet")
        got = catalogue.queries()["tail_inserts"](spark, f"{tmp_path}/{n}")
        assert dict(got.dtypes)["total"] == kind
        assert [int(x) for x in got.first()] == [len(kept), len(kept), sum(i + at for i in kept)]


def test_poll_moves_the_cursor_after_the_write(spark, tmp_path):
    path, dst, now = str(tmp_path / "cursor.json"), str(tmp_path / "out"), 10 * DAY
    events = spark.createDataFrame([("1", now - 2 * HOUR, "old", "g"), ("2", now - 1, "new", "g"), ("3", now - 5, "other", "h")], "id string, timestamp_ms long, message string, stream string")
    new = tail.poll_once(events, path, dst, now, ["g", "h", "quiet"])
    assert ids(spark, dst) == [("2", now - 1), ("3", now - 5)]
    assert {k: v["next_start_time_ms"] for k, v in new["streams"].items()} == {"g": now, "h": now - 4, "quiet": now - HOUR + 1}
    assert state.load(path, {}) == new
    tail.poll_once(events, path, dst, now, ["g", "h"])
    assert len(ids(spark, dst)) == 2


def test_polling_backs_off():
    slept, calls, clock = [], iter("okffffs"), [0.0]

    def poll():
        step = next(calls)
        clock[0] += 100.0 if step in "fs" else 1.0
        if step == "f":
            raise OSError

    turns = iter([True] * 7 + [False])
    tail.keep_polling(poll, 15, 0.2, 1.0, lambda: next(turns), slept.append, lambda: clock[0])
    assert slept == [14.0, 14.0, 0.4, 0.8, 1.0, 1.0, 0.2]


def test_asking_again():
    slept, fails = [], [0]
    answers = iter([tail.Throttled(), tail.Unavailable(), "yes"])

    def request():
        x = next(answers)
        if isinstance(x, Exception):
            raise x
        return x

    def failed():
        fails[0] += 1

    assert tail.asked(request, lambda: 3000, failed, sleep=slept.append) == "yes" and slept == [3.0, 1.0] and fails == [1]

    def always():
        raise tail.Unavailable

    with pytest.raises(tail.Unavailable):
        tail.asked(always, lambda: 1, sleep=slept.append)
    assert len(slept) == 2 + 19 and slept[-1] == 5.0


def test_windows_on_a_stream(spark, tmp_path):
    src = str(tmp_path / "in")
    put(spark, src, "a", [("1", 5, "x", "g"), ("2", DAY + 5, "x", "g"), ("3", DAY + 6, "x", "g")])
    counts = tail.windowed_counts(tail.read(spark, f"{src}/*.parquet", SCHEMA))
    q = counts.writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(tuple(r) for r in spark.table("windows").collect()) == [(0, "g", 1), (DAY, "g", 2)]


def test_stress_kept_by_the_stream(spark, tmp_path):
    src = str(tmp_path / "in")
    kind = "tracker string, seq int, ok boolean"
    for i, part in enumerate(([("a", 0, True), ("a", 1, False), ("b", 0, False)], [("a", 2, False), ("a", 3, False), ("b", 1, True)])):
        spark.createDataFrame(part, kind).coalesce(1).write.parquet(f"{src}/{i}.parquet")
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(f"{src}/*.parquet")
    seen = {}
    q = stateful.stress(stream).writeStream.outputMode("update").foreachBatch(lambda df, i: seen.update({r["tracker"]: tuple(r)[1:] for r in df.collect()})).trigger(availableNow=True).start()
    q.awaitTermination()
    assert seen == {"a": (3, 24, 3, "elevated"), "b": (0, 3, 1, "normal")}


def test_state_files(spark, tmp_path):
    path = str(tmp_path / "s.json")
    assert state.load(path, {"x": 1}) == {"x": 1}
    state.save(path, {"streams": {"g": {"next_token": None, "next_start_time_ms": 5}}})
    assert [tuple(r) for r in state.cursors(spark, state.load(path, {})).collect()] == [("g", None, 5)]
    with open(path, "w") as f:
        f.write("{")
    with pytest.raises(ValueError):
        state.load(path, {})
    assert state.load(path, {}, strict=False) == {}


def test_config(tmp_path):
    path = tmp_path / "c.toml"
    path.write_text('log_groups = ["a", "b"]\nbatch_size = 7\n')
    own = state.Config.load(str(path), {"BATCH_SIZE": "9", "MAX_IN_FLIGHT": "many", "DISABLE_RECONCILE": "1", "DISK_GUARD": "yes"})
    assert own.log_groups == ("a", "b") and own.batch_size == 9 and own.max_in_flight == 2 and own.disable_reconcile and not own.disk_guard
    with pytest.raises(ValueError):
        state.Config.load(None, {})


def test_pages(spark):
    df = spark.range(23).select(F.col("id").cast("string").alias("id"), (F.col("id") % 5).alias("timestamp_ms"))
    got = [(r["timestamp_ms"], r["id"]) for page in R.pages(df, 0, 5, 4) for r in page]
    assert got == sorted((i % 5, str(i)) for i in range(23))
