"""Queries over ranges, set algebra and reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bulk as B
from ..operators import ranges as R
from ..operators import reconcile as C
from ..sources.events import NOW_MS, SQL, source, sql_values, target, values
from .registry import query

DAY = 86_400_000
JAN1 = NOW_MS - 30 * DAY
START, END = JAN1 + 5 * DAY, JAN1 + 8 * DAY
_IN = f"timestamp_ms >= {START} and timestamp_ms < {END}"


@query(f"with {SQL} select id, timestamp_ms, message, log_group from source where {_IN}")
def range_scan(spark, sf_dir):
    return R.scan(source(spark, sf_dir, START, END), START, END)


@query(f"with {SQL} select count(*)::bigint as n from source where timestamp_ms between {START} and {END}")
def closed_range_count(spark, sf_dir):
    return source(spark, sf_dir, START, END + 1).where(R.in_closed_range(START, END)).agg(F.count("*").alias("n"))


@query(f"with {SQL} select (select count(*) from source where {_IN})::bigint as source_n, (select count(*) from target where {_IN})::bigint as target_n")
def range_count(spark, sf_dir):
    a, b = (R.scan(t, START, END).agg(F.count("*").alias(n)) for t, n in ((source(spark, sf_dir, START, END), "source_n"), (target(spark, sf_dir, START, END), "target_n")))
    return a.crossJoin(b)  # one row each


@query(f"""with {SQL} select 'first' as which, id, timestamp_ms from (select * from source where {_IN} order by timestamp_ms, id limit 16)
  union all select 'last', id, timestamp_ms from (select * from source where {_IN} order by timestamp_ms desc, id desc limit 16)""")
def first_last_ids(spark, sf_dir):
    s = source(spark, sf_dir, START, END)
    first, last = R.first_ids(s, START, END, 16), R.last_ids(s, START, END, 16)
    return first.withColumn("which", F.lit("first")).unionByName(last.withColumn("which", F.lit("last")))


_MID = (START + END) // 2


@query(f"with {SQL} select id, timestamp_ms from source where timestamp_ms >= {_MID - 3600000} and timestamp_ms < {_MID + 3600000} order by timestamp_ms, id limit 16")
def mid_window_ids(spark, sf_dir):
    return R.first_ids(source(spark, sf_dir, _MID - 3_600_000, _MID + 3_600_000), _MID - 3_600_000, _MID + 3_600_000, 16)


@query(f"with {SQL} select count(*)::bigint as n from target where {_IN} and id in (select id from (select * from source where {_IN} order by timestamp_ms, id limit 64))")
def membership_count(spark, sf_dir):
    return R.membership_count(target(spark, sf_dir, START, END), R.first_ids(source(spark, sf_dir, START, END), START, END, 64), START, END)


@query(f"with {SQL} select id, timestamp_ms, message, log_group from target where timestamp_ms > {START} or (timestamp_ms = {START} and id > '5') order by timestamp_ms, id limit 100")
def keyset_page(spark, sf_dir):
    return R.page_after(target(spark, sf_dir, START), (START, "5"), 100)


@query(f"with {SQL} select id, timestamp_ms from source where id not in (select id from target)")
def missing_ids(spark, sf_dir):
    return R.missing(source(spark, sf_dir), target(spark, sf_dir)).select("id", "timestamp_ms")


@query(f"with {SQL} select id, timestamp_ms from target where id not in (select id from source)")
def orphan_ids(spark, sf_dir):
    return R.orphans(source(spark, sf_dir), target(spark, sf_dir)).select("id", "timestamp_ms")


@query(f"with {SQL} select id, timestamp_ms from source where id in (select id from target)")
def overlap_ids(spark, sf_dir):
    return R.overlap(source(spark, sf_dir), target(spark, sf_dir)).select("id", "timestamp_ms")


@query(f"with {SQL} select * from target union all select * from source where id not in (select id from target)")
def insert_if_absent(spark, sf_dir):
    s = source(spark, sf_dir)
    return R.insert_if_absent(target(spark, sf_dir), s.union(s))


@query(f"with {SQL} select * from target where id in (select id from source)")
def delete_ids(spark, sf_dir):
    s, t = source(spark, sf_dir), target(spark, sf_dir)
    return R.delete_ids(t, R.orphans(s, t))


@query(f"with {SQL} select * from target where not ({_IN})")
def delete_range(spark, sf_dir):
    return R.delete_range(target(spark, sf_dir), START, END)


@query(f"with {SQL} select * from target where id like 'orphan-%' union all select * from source where {_IN}")
def reindex_window(spark, sf_dir):
    return R.reindex_window(target(spark, sf_dir).where("id like 'orphan-%'"), source(spark, sf_dir, START, END), START, END)


@query(f"""with {SQL}, a as (select timestamp_ms // {DAY} * {DAY} as start_ms, count(*) as n from source group by 1), b as (select timestamp_ms // {DAY} * {DAY} as start_ms, count(*) as n from target group by 1)
  select start_ms, coalesce(a.n, 0)::bigint as source_n, coalesce(b.n, 0)::bigint as target_n from a full join b using (start_ms)""")
def window_count_compare(spark, sf_dir):
    return R.window_counts(source(spark, sf_dir), target(spark, sf_dir), DAY)


_DAYS = f"days as (select {JAN1} + i * {DAY} as s, {JAN1} + (i + 1) * {DAY} as e from range(30) t(i))"


def _days(spark, s: str = "s", e: str = "e"):
    return spark.range(30).select((F.lit(JAN1) + F.col("id") * DAY).alias(s), (F.lit(JAN1) + (F.col("id") + 1) * DAY).alias(e))


def _ends(side: str) -> str:
    return f"""{side}_w as (select timestamp_ms // {DAY} * {DAY} as s, id, row_number() over (partition by timestamp_ms // {DAY} order by timestamp_ms, id) as u, row_number() over (partition by timestamp_ms // {DAY} order by timestamp_ms desc, id desc) as d from {side}),
  {side}_e as (select s, count(*) as n, coalesce(string_agg(id, ',' order by u) filter (where u <= 64), '') as f, coalesce(string_agg(id, ',' order by u) filter (where d <= 64), '') as l from {side}_w group by s)"""


@query(f"""with {SQL}, {_DAYS}, {_ends("source")}, {_ends("target")} select days.s::bigint as s, days.e::bigint as e, coalesce(a.n, 0) = coalesce(b.n, 0) and coalesce(a.f, '') = coalesce(b.f, '') and coalesce(a.l, '') = coalesce(b.l, '') as same
  from days left join source_e a using (s) left join target_e b on b.s = days.s""")
def verify_window(spark, sf_dir):
    return R.same_windows(source(spark, sf_dir), target(spark, sf_dir), _days(spark))


_CHUNKED = f"""b as (select id, timestamp_ms, log_group, level, f, row_number() over (partition by log_group, level order by timestamp_ms, id) - 1 as rn, count(*) over (partition by log_group, level) as len
    from source, (values ('normal', 4), ('elevated', 2), ('critical', 1)) t(level, f)), c as (select *, least(greatest(len // 100, 1), f) as n from b)"""


@query(f"""with {SQL}, {_CHUNKED} select log_group, level, chunk::int as chunk, count(*)::bigint as n, min(timestamp_ms)::bigint as first_ms from (
  select *, case when rn < (len % n) * (len // n + 1) then rn // (len // n + 1) else (len % n) + (rn - (len % n) * (len // n + 1)) // (len // n) end as chunk from c) group by all""")
def batch_chunks(spark, sf_dir):
    levels = values(spark, "level string", [("normal",), ("elevated",), ("critical",)])
    rows = B.chunked(source(spark, sf_dir).crossJoin(levels), ["log_group", "level"], ["timestamp_ms", "id"], F.lit(4), F.col("level"))
    return rows.groupBy("log_group", "level", "chunk").agg(F.count("*").alias("n"), F.min("timestamp_ms").alias("first_ms"))


#: Ranges of any length: from the first to the last event of each user.
_SPANS = f"spans as (select min(epoch_us(ts) // 1000) as start_ms, max(epoch_us(ts) // 1000) + 1 as end_ms from events where event_id is not null and ts is not null and props is not null group by user_id)"


def _spans(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").where("event_id is not null").select(F.col("event_id").cast("string").alias("id"), "user_id")
    return source(spark, sf_dir).join(e, "id").groupBy("user_id").agg(F.min("timestamp_ms").alias("start_ms"), (F.max("timestamp_ms") + 1).alias("end_ms")).drop("user_id")


@query(f"""with {_SPANS}, p as (select *, greatest(1, (end_ms - start_ms) // 16) as leaf_ms from spans), l as (select *, greatest(1, (end_ms - start_ms) // leaf_ms) as leaves from p)
  select start_ms::bigint as start_ms, end_ms::bigint as end_ms, leaf_ms::bigint as leaf_ms, leaves::bigint as leaves, greatest(16, leaves // 4)::bigint as sample, greatest(1, (end_ms - start_ms) // 8)::bigint as mid_span_ms from l""")
def sync_params(spark, sf_dir):
    return C.sync_params(_spans(spark, sf_dir))


@query(f"""with recursive {_SPANS}, t(root, level, node, s, e, leaf_ms) as (
  select start_ms, 0, 0::bigint, start_ms, end_ms, greatest(1, (end_ms - start_ms) // 16) from spans
  union all select root, level + 1, node * 2 + b, case when b = 0 then s else s + (e - s) // 2 end, case when b = 0 then s + (e - s) // 2 else e end, leaf_ms from t, (values (0), (1)) h(b) where e - s > leaf_ms)
  select root::bigint as root, level::int as level, node::bigint as node, s::bigint as s, e::bigint as e, e - s <= leaf_ms as leaf from t""")
def bisection_tree(spark, sf_dir):
    return C.tree(_spans(spark, sf_dir))


_TREE = f"""tree as (
  select root, level, node, root + node * ({DAY} // (1 << level)) as s, root + (node + 1) * ({DAY} // (1 << level)) as e
  from (select {JAN1} + i * {DAY} as root from range(30) t(i)), range(5) l(level), range(16) n(node) where node < (1 << level))"""
_HALF = DAY // 16  # half the middle span of a day, at every level
_MIDDLE = f"timestamp_ms >= greatest(s, s + ({DAY} >> level) // 2 - {_HALF}) and timestamp_ms < least(s + ({DAY} >> level), s + ({DAY} >> level) // 2 + {_HALF})"


def _side(name: str) -> str:
    key = "partition by root, level, node"
    return f"""{name}_in as materialized (
  select id, timestamp_ms, root, level, (timestamp_ms - root) // ({DAY} >> level) as node, root + (timestamp_ms - root) // ({DAY} >> level) * ({DAY} >> level) as s
  from (select id, timestamp_ms, timestamp_ms // {DAY} * {DAY} as root from {name}), range(5) l(level)
), {name}_at as materialized (
  select root, level, node, count(*) as n, string_agg(id, ',' order by timestamp_ms, id) filter (where u <= 16) as f, string_agg(id, ',' order by timestamp_ms, id) filter (where d <= 16) as l
  from (select *, row_number() over ({key} order by timestamp_ms, id) as u, row_number() over ({key} order by timestamp_ms desc, id desc) as d from {name}_in) group by root, level, node
), {name}_mid as materialized (
  select root, level, node, id, row_number() over ({key} order by timestamp_ms, id) as rn from {name}_in where {_MIDDLE}
)"""


_NODES = f"""{_TREE}, {_side("source")}, {_side("target")}, lost as materialized (
  select distinct root, level, node from source_mid a anti join target_mid b using (root, level, node, id) where rn <= 16
), decided as materialized (
  select t.*, coalesce(x.n, 0) as a, coalesce(y.n, 0) as b, case when coalesce(x.n, 0) = 0 and coalesce(y.n, 0) = 0 then 'skip' when abs(coalesce(x.n, 0) - coalesce(y.n, 0)) * 100 // greatest(coalesce(x.n, 0), coalesce(y.n, 0)) >= 30 then 'replace'
    when x.n = y.n and x.f = y.f and x.l = y.l and lost.root is null then 'accept' when t.level < 4 then 'split' else 'replace_leaf' end as decision
  from tree t left join source_at x using (root, level, node) left join target_at y using (root, level, node) left join lost using (root, level, node)
), nodes as materialized (
  select d.*, not exists (select 1 from decided p where p.root = d.root and p.level < d.level and p.node = d.node >> (d.level - p.level) and p.decision <> 'split') as visited from decided d
)"""


def _roots(spark):
    return _days(spark, "start_ms", "end_ms")


@query(f"with {SQL}, {_NODES} select root::bigint as root, level::int as level, node::bigint as node, s::bigint as s, e::bigint as e, a::bigint as source_n, b::bigint as target_n, decision, visited from nodes")
def bisection_decisions(spark, sf_dir):
    return C.decisions(source(spark, sf_dir), target(spark, sf_dir), _roots(spark))


@query(f"with {SQL}, {_NODES} select s::bigint as s, e::bigint as e from nodes where visited and decision like 'replace%'")
def replace_ranges(spark, sf_dir):
    return C.replace_ranges(C.decisions(source(spark, sf_dir), target(spark, sf_dir), _roots(spark)))


#: The rows of both sides in the ranges r (s, e), what replacing the ranges adds and what it deletes.
_REPLACED = """a as materialized (select x.*, r.s from source x join r on x.timestamp_ms >= r.s and x.timestamp_ms < r.e), b as materialized (select x.id, r.s from target x join r on x.timestamp_ms >= r.s and x.timestamp_ms < r.e),
  gone as materialized (select distinct id from b where s in (select s from a where trim(message) <> '') and not exists (select 1 from a where a.s = b.s and a.id = b.id)),
  new as materialized (select id, timestamp_ms, message, log_group from a where trim(message) <> '' and id not in (select id from target))"""
_AFTER = "select * from target where id not in (select id from gone) union all select * from new"


@query(f"with {SQL}, {_NODES}, r as materialized (select s, e from nodes where visited and decision like 'replace%'), {_REPLACED} {_AFTER}")
def full_replace_result(spark, sf_dir):
    return C.reconcile(source(spark, sf_dir), target(spark, sf_dir), _roots(spark))


@query(f"""with {SQL}, {_DAYS}, r as materialized (select * from days), {_REPLACED}
  select s::bigint as s, e::bigint as e, (select count(*) from a where a.s = days.s)::bigint as fetched, (select count(*) from a where a.s = days.s and trim(message) <> '')::bigint as ingested, (select count(*) from a where a.s = days.s and trim(message) = '')::bigint as failed,
    (select count(*) from a where a.s = days.s and id not in (select id from b where b.s = days.s))::bigint as missing, (select count(*) from b where b.s = days.s and id not in (select id from a where a.s = days.s))::bigint as orphans from days""")
def replace_counts(spark, sf_dir):
    return C.replace_counts(source(spark, sf_dir), target(spark, sf_dir), _days(spark))


_FLOOR = JAN1 + 20 * DAY + DAY // 3


@query(f"""with d as (select {NOW_MS} - i * {DAY} as s, {NOW_MS} - (i - 1) * {DAY} as e, i < 7 as urgent from range(30) t(i)), {SQL}
  select greatest(s, {_FLOOR})::bigint as s, e::bigint as e, urgent, (select count(*) from source where timestamp_ms >= greatest(s, {_FLOOR}) and timestamp_ms < e)::bigint as n from d where e > {_FLOOR}""")
def history_days(spark, sf_dir):
    days = values(spark, "s long, e long, urgent boolean", C.history(NOW_MS, 30, _FLOOR))
    n = R.in_windows(source(spark, sf_dir, _FLOOR).select("timestamp_ms"), days).groupBy("s").agg(F.count("*").alias("n"))
    return days.join(n, "s", "left").na.fill(0, ["n"])


_HOURLY = f"h as (select s, coalesce(a.n, 0) as a, coalesce(b.n, 0) as b from (select timestamp_ms // 3600000 * 3600000 as s, count(*) as n from source group by 1) a full join (select timestamp_ms // 3600000 * 3600000 as s, count(*) as n from target group by 1) b using (s))"
_PERCENT = "abs(a - b) * 100 // greatest(a, b)"


def _hourly(spark, sf_dir):
    return R.window_counts(source(spark, sf_dir), target(spark, sf_dir), 3_600_000)


@query(f"""with {SQL}, {_HOURLY} select s::bigint as start_ms, stressed, case when {_PERCENT} <= 25 or (b > a and stressed) then 'trust_target' else 'replace' end as decision from h, (values (true), (false)) t(stressed)""")
def live_learn_decision(spark, sf_dir):
    rows = _hourly(spark, sf_dir).crossJoin(values(spark, "stressed boolean", [(True,), (False,)]))
    return rows.select("start_ms", "stressed", C.live_learn(F.col("source_n"), F.col("target_n"), F.col("stressed")).alias("decision"))


_LEVELS3 = [("normal", 4.0), ("elevated", 2.5), ("critical", 1.5)]


@query(f"""with {SQL}, {_HOURLY}, m as (select s // 3600000 % 24 as hour, round(avg(a), 6) as expected, round(stddev_pop(a), 6) as sd from h group by 1)
  select s::bigint as start_ms, level, case when abs(a - expected) <= greatest(sigma * sd, 0.1 * expected, 10) then 'full_replace' when {_PERCENT} <= 25 then 'live_learn' when b > a and level <> 'normal' then 'live_learn' when {_PERCENT} <= 50 then 'live_learn' else 'check_integrity' end as decision
  from h join m on s // 3600000 % 24 = hour, {sql_values("level, sigma", _LEVELS3)}""")
def blend_decision(spark, sf_dir):
    h = _hourly(spark, sf_dir).withColumn("hour", F.expr("start_ms div 3600000 % 24"))
    m = h.groupBy("hour").agg(F.round(F.avg("source_n"), 6).alias("expected"), F.round(F.stddev_pop("source_n"), 6).alias("sd"))
    rows = h.join(m, "hour").crossJoin(values(spark, "level string", [(x,) for x, _ in _LEVELS3]))
    return rows.select("start_ms", "level", C.blend_decision(F.col("source_n"), F.col("target_n"), F.col("expected"), F.col("sd"), F.col("level")).alias("decision"))
