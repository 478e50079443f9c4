"""Queries over control decisions, and streams."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import bulk as B
from ..operators import control as K
from ..sources.events import NOW_MS, RAW, SQL, raw, source, table, target, values
from ..sources.shared import cut
from ..streaming import tail as T
from .registry import query

DAY = 86_400_000


@query("""with d as (select o_orderkey, date_diff('day', o_orderdate, max(o_orderdate) over ()) as days from orders)
  select o_orderkey, days::int as days, (case when days = 0 then 255 when days <= 3 then 192 when days <= 7 then 128 when days <= 30 then 64 else 0 end)::int as priority from d""")
def day_priority(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    last = o.agg(F.max("o_orderdate").alias("last"))  # one row
    days = F.date_diff("last", "o_orderdate")
    return o.crossJoin(last).select("o_orderkey", days.alias("days"), K.day_priority(days).alias("priority"))


_PRIORITY = "(case k % 6 when 0 then 255 when 1 then 200 when 2 then 128 when 3 then 100 when 4 then 64 else 0 end)"


@query(f"with {RAW} select event_id, least(255, {_PRIORITY} + (k * 29) // 10)::int as effective from raw")
def effective_priority(spark, sf_dir):
    return raw(spark, sf_dir).select("event_id", K.effective_priority(F.expr(_PRIORITY), F.col("k") * 29).alias("effective"))


_RANK = f"case when {_PRIORITY} = 255 then 0 when {_PRIORITY} >= 192 then 1 when {_PRIORITY} >= 128 then 2 when {_PRIORITY} >= 64 then 3 else 4 end"


@query(f"with {RAW} select event_id, row_number() over (partition by event_type, ms // {DAY} order by {_RANK}, event_id)::int as turn from raw")
def priority_drain(spark, sf_dir):
    queue = raw(spark, sf_dir).select("event_id", "event_type", F.expr(f"ms div {DAY}").alias("day"), F.expr(_PRIORITY).alias("priority"), F.col("event_id").alias("seq"))
    return K.drain_order(queue, ["event_type", "day"]).select("event_id", "turn")


_LINE_PRIORITY = "case when l_linenumber <= 5 then 255 when l_linenumber = 6 then 192 else 0 end"


@query(f"""select l_linestatus, case {_LINE_PRIORITY} when 255 then 'critical' when 192 then 'high' else 'idle' end as channel, least(count(*), case {_LINE_PRIORITY} when 255 then 10000 when 192 then 50000 else 100000 end)::bigint as queued,
  greatest(count(*) - case {_LINE_PRIORITY} when 255 then 10000 when 192 then 50000 else 100000 end, 0)::bigint as waiting from lineitem group by l_linestatus, {_LINE_PRIORITY}""")
def channel_waiting(spark, sf_dir):
    return K.waiting(table(spark, sf_dir, "lineitem").withColumn("priority", F.expr(_LINE_PRIORITY)), ["l_linestatus"])


#: Every user is a tracker, and an event with k >= 55 a failure.
_SEQ = "seqd as (select user_id as tracker, row_number() over (partition by user_id order by ms, event_id) as i, * from raw)"
_STRESS = f"""{RAW}, {_SEQ}, st(tracker, i, streak, backoff, failures) as (
  select distinct user_id, 0::bigint, 0::bigint, 3::bigint, 0::bigint from raw union all
  select st.tracker, st.i + 1, case when k < 55 then greatest(streak - 1, 0) else streak + 1 end, case when k < 55 then greatest(backoff // 2, 3) else least(backoff * 2, 60) end, failures + (case when k < 55 then 0 else 1 end)
  from st join seqd on seqd.tracker = st.tracker and seqd.i = st.i + 1),
  stress as (select tracker, streak, backoff, failures, case when streak >= 10 then 'critical' when streak >= 3 then 'elevated' else 'normal' end as level from (select *, max(i) over (partition by tracker) as last from st) where i = last)"""


def _sequence(spark, sf_dir):
    seq = F.row_number().over(Window.partitionBy("user_id").orderBy("ms", "event_id"))
    return raw(spark, sf_dir).withColumn("seq", seq).withColumn("tracker", F.col("user_id"))


def _stress(spark, sf_dir):
    return K.stress(_sequence(spark, sf_dir).select("tracker", "seq", (F.col("k") < 55).alias("ok")))


@query(f"with recursive {_STRESS} select * from stress")
def stress_fold(spark, sf_dir):
    return _stress(spark, sf_dir)


_PAUSE = "case when p >= 250 then null when p >= 180 then (case when level = 'critical' then backoff end) when p >= 100 then (case when level <> 'normal' then backoff end) when p >= 50 then (case when streak >= 1 then backoff end) when streak >= 1 then backoff * 2 end"


@query(f"with recursive {_STRESS} select tracker, p::int as p, ({_PAUSE})::bigint as pause from stress, (values (255), (192), (128), (64), (0)) t(p)")
def pause_matrix(spark, sf_dir):
    rows = _stress(spark, sf_dir).crossJoin(values(spark, "p int", [(p,) for p in (255, 192, 128, 64, 0)]))
    return rows.select("tracker", "p", K.pause_secs(F.col("p"), F.col("level"), F.col("streak"), F.col("backoff")).alias("pause"))


@query(f"""with recursive {_STRESS}, x as (select tracker % 10 as pool, p, {_PAUSE} as pause, case level when 'critical' then 2 when 'elevated' then 1 else 0 end as r from stress, (values (192), (64), (0)) t(p))
  select pool, p::int as p, max(pause)::bigint as pause, case max(r) when 2 then 'critical' when 1 then 'elevated' else 'normal' end as level from x group by pool, p""")
def combined_stress(spark, sf_dir):
    rows = _stress(spark, sf_dir).withColumn("pool", F.col("tracker") % 10).crossJoin(values(spark, "p int", [(p,) for p in (192, 64, 0)]))
    return K.combined_stress(rows, ["pool", "p"], F.col("p"))


#: Latencies mostly fast, some slow, few critical.
_LATENCY = "(case when k < 92 then k * 5 when k < 98 then k * 30 else 12000 end)"
_ADAPTIVE = f"""{RAW}, {_SEQ}, lat as (select tracker, i, {_LATENCY} as latency, event_id % 17 <> 0 as ok, event_id % 3 <> 0 as due, event_id % 11 = 0 as pressed,
    floor(avg({_LATENCY}) over (partition by tracker order by i rows between 19 preceding and current row)) as av from seqd),
  ad(tracker, i, batch, flight, delay, slow, fast) as (
  select distinct user_id, 0::bigint, 5000::bigint, 4::bigint, 0::bigint, 0::bigint, 0::bigint from raw union all
  select tracker, i, case act when 'halt' then greatest(batch // 2, 100) when 'back' then greatest(batch * 3 // 4, 100) when 'up' then least(batch * 5 // 4, 20000) else batch end,
    case act when 'halt' then greatest(flight // 2, 1) when 'back' then (case when flight > 2 then flight - 1 else 1 end) when 'up' then least(flight + 1, 16) else flight end,
    case act when 'halt' then least(delay + 500, 5000) when 'back' then least(delay + 100, 2000) when 'up' then greatest(delay - 50, 0) else delay end,
    case when act in ('halt', 'back') then 0 else slow end, case when act in ('halt', 'up') then 0 else fast end
  from (select *, case when latency > 10000 then 'halt' when due and slow >= 3 then 'back' when due and fast >= 10 and av < 500 and not pressed then 'up' else 'none' end as act from (
    select ad.tracker, ad.i + 1 as i, batch, flight, delay, latency, due, pressed, av, case when not ok or latency > 2000 then slow + 1 when latency < 500 then 0 else slow end as slow, case when not ok or latency > 2000 then 0 when latency < 500 then fast + 1 else fast end as fast
    from ad join lat on lat.tracker = ad.tracker and lat.i = ad.i + 1)))"""


@query(f"with recursive {_ADAPTIVE} select tracker, batch, flight as in_flight, delay from (select *, max(i) over (partition by tracker) as last from ad) where i = last")
def adaptive_fold(spark, sf_dir):
    e = F.col("event_id")
    rows = _sequence(spark, sf_dir).select("tracker", "seq", F.expr(_LATENCY).cast("long").alias("latency_ms"), (e % 17 != 0).alias("ok"), (e % 3 != 0).alias("due"), (e % 11 == 0).alias("pressed"))
    return K.adaptive(rows)


@query(f"with {RAW}, {_SEQ} select tracker, i::int as seq, {_LATENCY}::bigint as latency_ms, floor(avg({_LATENCY}) over (partition by tracker order by i rows between 19 preceding and current row))::bigint as avg_ms from seqd")
def latency_moving_avg(spark, sf_dir):
    return K.latency_average(_sequence(spark, sf_dir).select("tracker", "seq", F.expr(_LATENCY).cast("long").alias("latency_ms")))


#: Use of a node's memory and processor; a check that failed gives nothing.
_HEAP, _CPU = "(case when event_id % 50 = 0 then null else (event_id % 43) / 48.0D end)", "(case when event_id % 50 = 0 then null else (event_id % 37) / 39.0D end)"
_USE = "(case when event_id % 50 = 0 then 0.95 else (event_id % 43) / 48.0 end)::double as heap, (case when event_id % 50 = 0 then 0.95 else (event_id % 37) / 39.0 end)::double as cpu, (k / 120.0)::double as breaker"
_LEVEL = "case when {h} >= 0.85 or cpu >= 0.90 then 'critical' when {h} >= 0.70 or cpu >= 0.70 then 'moderate' else 'none' end"


@query(f"""with {RAW}, u as (select ms // 14400000 as slot, {_USE} from raw), m as (select slot, max(heap) as heap, max(cpu) as cpu, max(breaker) as breaker from u group by slot)
  select slot, round(heap, 6) as heap, round(cpu, 6) as cpu, round(breaker, 6) as breaker, round(greatest(heap, breaker), 6) as memory, {_LEVEL.format(h="greatest(heap, breaker)")} as pressure from m""")
def pressure_levels(spark, sf_dir):
    rows = raw(spark, sf_dir).select(F.expr("ms div 14400000").alias("slot"), F.expr(_HEAP).alias("heap"), F.expr(_CPU).alias("cpu"), (F.col("k") / 120.0).alias("breaker"))
    out = K.node_pressure(rows, ["slot"])
    return out.select("slot", *[F.round(c, 6).alias(c) for c in ("heap", "cpu", "breaker", "memory")], "pressure")


@query(f"""with recursive {RAW}, {_SEQ}, u as (select tracker, i, {_LEVEL.format(h="heap")} as p from (select tracker, i, {_USE} from seqd)),
  f(tracker, i, batch, flight, delay, pressed) as (select distinct user_id, 0::bigint, 5000::bigint, 4::bigint, 0::bigint, false from raw union all
  select f.tracker, f.i + 1, case p when 'critical' then greatest(batch // 2, 100) when 'moderate' then greatest(batch * 3 // 4, 100) else batch end, case p when 'critical' then greatest(flight // 2, 1) when 'moderate' then greatest(flight * 3 // 4, 1) else flight end,
    case p when 'critical' then least(delay + 500, 5000) when 'moderate' then least(delay + 200, 2000) else delay end, p <> 'none' from f join u on u.tracker = f.tracker and u.i = f.i + 1)
  select tracker, batch, flight as in_flight, delay, pressed from (select *, max(i) over (partition by tracker) as last from f) where i = last""")
def pressure_fold(spark, sf_dir):
    return K.pressure_fold(_sequence(spark, sf_dir).select("tracker", "seq", F.expr(_HEAP).alias("heap"), F.expr(_CPU).alias("cpu")))


@query("""with c as (select distinct (l_quantity::bigint * 40) as batch, l_linenumber as flight from lineitem), a as (select batch, flight, batch * 4 as sink_enriched, greatest(flight * 8, 16) as resync_per_sample from c),
  b as (select *, greatest(batch * flight * 5, 1024, sink_enriched) as tail_raw, greatest(batch * flight * 4, 2048, sink_enriched) as reconcile_raw, greatest(batch * flight * 4, 2048, sink_enriched) as heal_raw from a),
  d as (select *, greatest(batch * flight * 10, 4096, reconcile_raw) as backfill_raw from b)
  select batch::bigint as batch, flight::bigint as flight, sink_enriched::bigint as sink_enriched, tail_raw::bigint as tail_raw, reconcile_raw::bigint as reconcile_raw, heal_raw::bigint as heal_raw, backfill_raw::bigint as backfill_raw, resync_per_sample::bigint as resync_per_sample,
    ((sink_enriched + tail_raw + reconcile_raw + heal_raw + backfill_raw + resync_per_sample) * 1024)::bigint as bytes from d""")
def buffer_caps(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select((F.col("l_quantity").cast("long") * 40).alias("batch"), F.col("l_linenumber").cast("long").alias("flight")).distinct()
    return rows.select("batch", "flight", *[c.cast("long").alias(n) for n, c in B.buffer_columns(F.col("batch"), F.col("flight")).items()])


@query(f"""with {RAW}, x as (select *, user_id % 7 as node, k % 4 + (case when k > 50 then event_id % 3 else 0 end) as trips from raw)
  select event_id, coalesce(trips > coalesce(lag(trips) over (partition by node order by ms, event_id), 0), false) or k > 85 or (event_id % 190) + (k // 3) > 200 or (event_type = 'error' and k < 5) or event_id % 113 > 100 as failed from x""")
def recovery_checks(spark, sf_dir):
    r, e, k = raw(spark, sf_dir), F.col("event_id"), F.col("k")
    breakers = F.create_map(F.lit("parent"), k % 4, F.lit("request"), F.when(k > 50, e % 3))
    rows = r.select("event_id", (F.col("user_id") % 7).alias("node"), F.struct("ms", "event_id").alias("seq"), breakers.alias("breakers"), k.alias("heap_percent"), (e % 190).alias("write_queue"), F.expr("k div 3").alias("bulk_queue"), F.when((F.col("event_type") == "error") & (k < 5), "red").otherwise("green").alias("status"), (e % 113).alias("pending"))
    return K.recovery_failures(K.node_totals(rows)).select("event_id", "failed")


_STEP = "(case when k = 0 then 'terminate' when k % 4 = 0 then 'spawn' when k % 4 = 1 then 'schedule' when k % 4 = 2 then 'block' else 'unblock' end)"


@query(f"""with {RAW}, s as (select user_id, max_by({_STEP}, (ms, event_id)) as step, bool_or(k = 0) as over from raw group by user_id)
  select case when over or step = 'terminate' then 'done' when step in ('spawn', 'unblock') then 'ready' when step = 'schedule' then 'running' else 'blocked' end as state, count(*)::bigint as n from s group by 1""")
def process_counts(spark, sf_dir):
    log = raw(spark, sf_dir).select(F.col("user_id").alias("process"), F.struct("ms", "event_id").alias("seq"), F.expr(_STEP).alias("step"))
    return K.state_counts(K.process_states(log))


@query(f"""with {RAW}, w as (select event_type, count(*) as n, sum(k) as t, count(distinct user_id) as p from raw group by 1) select sum(n)::bigint as events, sum(t)::bigint as ms, sum(p)::bigint as processes, (sum(n)::bigint * 1000 // sum(t)::bigint)::bigint as eps from w""")
def worker_rollup(spark, sf_dir):
    workers = raw(spark, sf_dir).groupBy("event_type").agg(F.count("*").alias("events"), F.sum("k").alias("ms"), F.count_distinct("user_id").alias("processes"))
    return K.worker_rollup(workers)


@query(f"with {RAW} select user_id, (case when sum(k) = 0 then 0 else count(*) * 1000 // sum(k)::bigint end)::bigint as eps from raw group by user_id")
def worker_rates(spark, sf_dir):
    from ..functions.text import events_per_second

    return raw(spark, sf_dir).groupBy("user_id").agg(F.count("*").alias("n"), F.sum("k").alias("ms")).select("user_id", events_per_second(F.col("n"), F.col("ms")).alias("eps"))


@query(f"with {RAW} select event_id, (case when (event_type = 'error' or event_type = 'click') and k % 24 + 1 < 20 then case when event_type = 'error' then 1000 + k else 500 * least(k % 24 + 1, 10) end end)::bigint as wait_ms from raw")
def retry_waits(spark, sf_dir):
    t, k = F.col("event_type"), F.col("k")
    return raw(spark, sf_dir).select("event_id", K.retry_wait(k % 24 + 1, t == "error", t == "click", 1000 + k).cast("long").alias("wait_ms"))


# Streams -----------------------------------------------------------------------------------------------------------------


@query(f"with {SQL} select timestamp_ms // 86400000 * 86400000 as start_ms, log_group, count(*)::bigint as n from source group by all")
def day_windows(spark, sf_dir):
    return T.windowed_counts(source(spark, sf_dir))


@query(f"with {SQL} select (timestamp_ms // {DAY} - i) * {DAY} as start_ms, log_group, count(*)::bigint as n from source, range(10) t(i) group by all")
def sliding_windows(spark, sf_dir):
    """Ten days each, a day apart: what a rolling reconcile replays."""
    return T.windowed_counts(source(spark, sf_dir), "10 days", slide="1 day")


#: Two groups have a cursor, the others begin an hour before now.
_CURSORS = [("/app/click", NOW_MS - 3 * DAY), ("/app/view", NOW_MS + DAY)]
_POLLED = f"""c as (select * from (values {", ".join(map(str, _CURSORS))}) t(stream, since)), polled as (select s.* from source s left join c on s.log_group = stream where timestamp_ms >= coalesce(since, {NOW_MS - 3_600_000}))"""


def _polled(spark, sf_dir):
    cursors = values(spark, "stream string, next_start_time_ms long", _CURSORS)
    return source(spark, sf_dir, NOW_MS - 3 * DAY).withColumn("stream", F.col("log_group")), cursors


@query(f"with {SQL}, {_POLLED} select id, timestamp_ms, log_group from polled")
def tail_poll(spark, sf_dir):
    return T.poll(*_polled(spark, sf_dir), NOW_MS).select("id", "timestamp_ms", "log_group")


@query(f"""with {SQL}, {_POLLED}, g as (select distinct log_group from source) select g.log_group as stream, (greatest(coalesce(max(polled.timestamp_ms), 0), coalesce(any_value(c.since), {NOW_MS - 3_600_000})) + 1)::bigint as next_start_time_ms
  from g left join polled using (log_group) left join c on c.stream = g.log_group group by 1""")
def tail_cursors(spark, sf_dir):
    events, cursors = _polled(spark, sf_dir)
    streams = source(spark, sf_dir).select(F.col("log_group").alias("stream")).distinct()
    return T.advance(T.poll(events, cursors, NOW_MS), streams, cursors, NOW_MS)


@query(f"with {SQL} select count(*)::bigint as n, count(distinct id)::bigint as ids, sum(timestamp_ms)::bigint as total from (select distinct on (id) * from (select *, 0 as o from target union all select *, 1 from source where log_group in ('/app/error', '/app/view')) order by id, o)")
def tail_inserts(spark, sf_dir):
    """What a tail of two groups adds to the target, counted: an id that is there under any day keeps its row.

    The total is summed as a decimal: some 5.4 million times of today pass a long.  It comes as the long of the SQL wherever
    a long holds it, and as the exact decimal beyond, where the SQL's own cast fails.
    """
    from ..operators.ranges import absent, one_per_id

    t = target(spark, sf_dir)
    new = absent(t, one_per_id(source(spark, sf_dir).where("log_group in ('/app/error', '/app/view')")))
    return _long_total(t.unionByName(new).agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"), F.sum(F.col("timestamp_ms").cast("decimal(19,0)")).alias("total")))


def _long_total(row):
    """The one ``row`` with its decimal total as a long, if a long holds it."""
    row = cut(row, "total")
    beyond = row.where(F.col("total").isNotNull() & F.col("total").try_cast("long").isNull()).count()
    return row if beyond else row.withColumn("total", F.col("total").cast("long"))
