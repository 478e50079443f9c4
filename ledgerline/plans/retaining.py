"""Queries over segments and retention."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import catalogue as G
from ..operators import retention as T
from ..sources.events import NOW_MS, RAW, SQL, raw, source, table, values
from ..sources.state import merge_watermarks
from .registry import query

DAY = 86_400_000
JAN1 = NOW_MS - 30 * DAY


def _rows(spark, sf_dir):
    stream = F.replace(F.col("log_group"), F.lit("/app/"), F.lit(""))
    return source(spark, sf_dir).withColumn("stream", stream).withColumn("segment", F.concat("stream", F.lit("-"), F.expr("timestamp_ms div 86400000").cast("string")))


_BOUNDS = "bounds as (select replace(log_group, '/app/', '') || '-' || (timestamp_ms // 86400000) as segment, min(timestamp_ms)::bigint as min_ts, max(timestamp_ms)::bigint as max_ts, count(*)::bigint as n from source group by 1)"


@query(f"with {SQL}, {_BOUNDS} select * from bounds")
def segment_bounds(spark, sf_dir):
    return T.segment_bounds(_rows(spark, sf_dir))


_WINDOW = (JAN1 + 3 * DAY + DAY // 2, JAN1 + 6 * DAY)


@query(f"with {SQL}, {_BOUNDS} select segment from bounds where max_ts >= {_WINDOW[0]} and min_ts <= {_WINDOW[1]}")
def segments_overlapping(spark, sf_dir):
    return T.overlapping(T.segment_bounds(_rows(spark, sf_dir)), values(spark, "s long, e long", [_WINDOW])).select("segment")


@query(f"with {SQL}, {_BOUNDS} select segment from bounds where min_ts >= {_WINDOW[0]} and max_ts <= {_WINDOW[1]}")
def segments_within(spark, sf_dir):
    return T.within(T.segment_bounds(_rows(spark, sf_dir)), values(spark, "s long, e long", [_WINDOW])).select("segment")


@query(f"with {SQL}, {_BOUNDS} select segment, regexp_replace(segment, '-[^-]*$', '') as stream, row_number() over (partition by regexp_replace(segment, '-[^-]*$', '') order by min_ts, segment)::int as seq from bounds")
def segments_in_order(spark, sf_dir):
    return G.segments(_rows(spark, sf_dir))


@query(f"with {SQL}, {_BOUNDS} select segment from bounds")
def segments_joined(spark, sf_dir):
    return G.joined_lists(G.segment_lists(_rows(spark, sf_dir)))


#: A stream a type, in two versions by the half of the month; a segment a day; some times and sizes are not known.
_SEGMENTS = f"""segments as (select event_type || case when d < 15 then '-v1' else '-v2' end as stable_alias, '.ds-' || event_type || case when d < 15 then '-v1-' else '-v2-' end || strftime(make_timestamp(({JAN1} + d * {DAY}) * 1000), '%Y.%m.%d') || '-' || printf('%06d', d::int) as index, d::int as seq,
  case when d % 5 = 2 then null when d % 7 = 3 then 0 else max(ms) end as max_ts_ms, case when d % 3 = 1 then null else count(*) * 100 end as store_bytes from (select *, (ms - {JAN1}) // {DAY} as d from raw) group by event_type, d)"""


def _segments(spark, sf_dir):
    r = raw(spark, sf_dir).withColumn("d", F.expr(f"(ms - {JAN1}) div {DAY}"))
    version = F.when(F.col("d") < 15, "-v1").otherwise("-v2")
    alias = F.concat("event_type", version)
    name = F.concat(F.lit(".ds-"), alias, F.lit("-"), F.date_format(F.timestamp_millis(F.lit(JAN1) + F.col("d") * DAY), "yyyy.MM.dd"), F.lit("-"), F.lpad(F.col("d").cast("string"), 6, "0"))
    out = r.groupBy(alias.alias("stable_alias"), name.alias("index"), F.col("d")).agg(F.max("ms").alias("m"), (F.count("*") * 100).alias("b"))
    ts = F.when(F.col("d") % 5 == 2, None).when(F.col("d") % 7 == 3, 0).otherwise(F.col("m"))
    return out.select("stable_alias", "index", F.col("d").cast("int").alias("seq"), ts.alias("max_ts_ms"), F.when(F.col("d") % 3 != 1, F.col("b")).alias("store_bytes"))


_CUTOFF = JAN1 + 9 * DAY
#: What may go of the segments: never the last of a stream; where nothing is old the first, since this is an emergency.
_DUE = f"""read as (select *, case when max_ts_ms > 0 then max_ts_ms end as ts, epoch_ms(strptime(regexp_extract(index, '(\\d{{4}}\\.\\d{{2}}\\.\\d{{2}})-\\d+$', 1), '%Y.%m.%d')) as day, row_number() over (partition by stable_alias order by seq) as nth, row_number() over (partition by stable_alias order by seq desc) as last from segments),
  old as (select *, bool_or(coalesce(ts, day) < {_CUTOFF}) over (partition by stable_alias) as any_old from read where last > 1),
  due as (select stable_alias, index, coalesce(ts, day) as sort_key_ms, coalesce(ts, day + {DAY - 1}) as watermark_ms, store_bytes, case when ts is not null then 'TimestampEligible' else 'NameDateEligible' end as reason from old where coalesce(ts, day) < {_CUTOFF}
    union all select stable_alias, index, day, {_CUTOFF}, store_bytes, 'EmergencyOldest' from old where not any_old and nth = 1)"""


@query(f"with {RAW}, {_SEGMENTS}, {_DUE} select stable_alias, index, sort_key_ms::bigint as sort_key_ms, watermark_ms::bigint as watermark_ms, store_bytes::bigint as store_bytes, reason from due")
def delete_candidates(spark, sf_dir):
    return T.delete_candidates(_segments(spark, sf_dir), _CUTOFF, True)


_RELIEVED = "o as (select *, coalesce(sum(coalesce(store_bytes, 0)) over (order by sort_key_ms, store_bytes desc nulls last, index rows between unbounded preceding and 1 preceding), 0) as f from due), gone as (select * from o where f < (select count(*) * 15 from raw))"


def _relieved(spark, sf_dir):
    need = table(spark, sf_dir, "events").count() * 15
    return T.delete_until(T.delete_candidates(_segments(spark, sf_dir), _CUTOFF, True), need)


@query(f"with {RAW}, {_SEGMENTS}, {_DUE}, {_RELIEVED} select index, f::bigint as freed_before from gone")
def delete_until_relieved(spark, sf_dir):
    return _relieved(spark, sf_dir).select("index", "freed_before")


_MARKS = f"marks as (select event_type || v as stable, min(ms) + {DAY} * (length(event_type) - 3) as watermark_ms from raw, (values ('-v1'), ('-v3')) t(v) group by 1, event_type)"


def _marks(spark, sf_dir):
    r = raw(spark, sf_dir).crossJoin(values(spark, "v string", [("-v1",), ("-v3",)]))
    return r.groupBy(F.concat("event_type", "v").alias("stable"), "event_type").agg(F.min("ms").alias("m")).select("stable", (F.col("m") + DAY * (F.length("event_type") - 3)).alias("watermark_ms"))


_MERGED = "select coalesce(m.stable, n.stable) as stable, greatest(m.watermark_ms, n.w)::bigint as watermark_ms, coalesce(n.w > m.watermark_ms, m.watermark_ms is null) as changed from marks m full join {new} n on m.stable = n.stable"


@query(f"with {RAW}, {_SEGMENTS}, {_DUE}, {_RELIEVED}, {_MARKS}, new as (select stable_alias as stable, max(watermark_ms) as w from gone group by 1) " + _MERGED.format(new="new"))
def watermarks_after_delete(spark, sf_dir):
    return T.advanced(_marks(spark, sf_dir), _relieved(spark, sf_dir))


@query(f"with {RAW}, {_SEGMENTS}, {_MARKS}, new as (select stable_alias as stable, max(max_ts_ms) as w from segments group by 1) " + _MERGED.format(new="new"))
def watermark_merge(spark, sf_dir):
    new = _segments(spark, sf_dir).where("max_ts_ms is not null").select(F.col("stable_alias").alias("stable"), F.col("max_ts_ms").alias("watermark_ms"))
    return merge_watermarks(_marks(spark, sf_dir), new)


@query(f"""with {RAW}, {_MARKS}, w as (select distinct event_type || case when ms % 2 = 0 then '-v1' else '-v2' end as stable, ms // {DAY} * {DAY} as s from raw)
  select w.stable, greatest(s, coalesce(watermark_ms, s))::bigint as start_ms, (s + {DAY})::bigint as end_ms from w left join marks using (stable) where watermark_ms is null or s + {DAY} > watermark_ms""")
def prune_clamp(spark, sf_dir):
    start = F.expr(f"ms div {DAY} * {DAY}")
    windows = raw(spark, sf_dir).select(F.concat("event_type", F.when(F.col("ms") % 2 == 0, "-v1").otherwise("-v2")).alias("stable"), start.alias("start_ms"), (start + DAY).alias("end_ms")).distinct()
    return T.clamp(windows, _marks(spark, sf_dir))


@query(f"""with {RAW}, {_SEGMENTS}, w as (select index, case when seq % 2 = 0 then '1s' else '30s' end as current, case when max_ts_ms is null or max_ts_ms >= {NOW_MS - 7 * DAY} then '1s' else '30s' end as interval from segments) select index, interval from w where interval <> current""")
def refresh_plan(spark, sf_dir):
    return T.refresh_plan(_segments(spark, sf_dir).withColumn("current", F.when(F.col("seq") % 2 == 0, "1s").otherwise("30s")), NOW_MS - 7 * DAY)


@query(f"""with {RAW}, {_SEGMENTS} select p as phase, index, case when p = 'backfill' then '-1' else '1s' end as refresh_interval, (case when p = 'backfill' then 0 else 1 + seq % 2 end)::int as replicas from segments, (values ('backfill'), ('restore')) t(p)""")
def refresh_settings(spark, sf_dir):
    s = _segments(spark, sf_dir).withColumn("replicas", 1 + F.col("seq") % 2)
    return T.refresh_settings(s, "backfill").withColumn("phase", F.lit("backfill")).unionByName(T.refresh_settings(s, "restore").withColumn("phase", F.lit("restore")))


@query(f"with {SQL}, {_BOUNDS} select segment, max_ts, (case when n % 3 = 0 then null else n * 100 end)::bigint as store_bytes from bounds")
def segment_sizes(spark, sf_dir):
    b = T.segment_bounds(_rows(spark, sf_dir))
    return T.sized(b, b.where("n % 3 <> 0").select("segment", (F.col("n") * 100).alias("store_bytes"))).select("segment", "max_ts", "store_bytes")


@query("""with p as (select floor(abs(c_acctbal))::bigint as available, floor(abs(c_acctbal) / 3)::bigint as high, c_mktsegment from customer)
  select min(available)::bigint as available_min, max(high + 500)::bigint as needed_max, max(high)::bigint as high_max, min(available) < max(high + 500) as pressure from p""")
def disk_pressure(spark, sf_dir):
    b = F.abs("c_acctbal")
    return T.disk_pressure(table(spark, sf_dir, "customer").select(F.floor(b).alias("available"), F.floor(b / 3).alias("high")), 500)


_INDEX = "case p_partkey % 8 when 0 then '.' || p_brand when 1 then 'ilm-history-' || p_partkey when 2 then 'logs-' || p_type when 3 then 'partial-' || p_brand when 4 then 'logs-temp-' || p_partkey when 5 then 'logs-default' when 6 then 'x-shrink-' || p_size else 'restore-' || p_partkey end"


def _indices(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.expr(_INDEX).alias("index"), (F.col("p_size") % 3).alias("docs"), F.when(F.col("p_partkey") % 5 < 2, "red").otherwise("green").alias("health"))


@query(f"with i as (select p_partkey, {_INDEX} as index, p_size % 3 as docs, case when p_partkey % 5 < 2 then 'red' else 'green' end as health from part) select p_partkey, index from i where index = 'logs-default' or index like '%-temp%' or (docs = 0 and health = 'red')")
def hygiene(spark, sf_dir):
    return T.hygiene(_indices(spark, sf_dir), "logs").select("p_partkey", "index")


_SYSTEM = "index like '.%' or index like 'ilm-history%' or index like 'slm-history%' or index like 'shrink-%' or index like 'restore-%' or index like 'partial-%'"


@query(f"with i as (select p_partkey, {_INDEX} as index from part) select p_partkey, index, {_SYSTEM} as system from i")
def system_indices(spark, sf_dir):
    return _indices(spark, sf_dir).select("p_partkey", "index", T.is_system(F.col("index")).alias("system"))


@query(f"with i as (select {_INDEX} as index, p_partkey as k from part) select index, count(*)::bigint as docs, min(k)::bigint as first_ms, max(k)::bigint as last_ms from i where not ({_SYSTEM}) group by index")
def user_indices(spark, sf_dir):
    rows = _indices(spark, sf_dir).select("index", F.col("p_partkey").alias("timestamp_ms"))
    return G.user_indices(G.indices(rows))


@query(f"with {RAW}, {_SEGMENTS} select index, epoch_ms(strptime(regexp_extract(index, '(\\d{{4}}\\.\\d{{2}}\\.\\d{{2}})-\\d+$', 1), '%Y.%m.%d'))::bigint as day_ms, regexp_replace(index, '-[^-]*$', '') as head from segments")
def segment_name_parts(spark, sf_dir):
    return _segments(spark, sf_dir).select("index", text.segment_date_ms(F.col("index")).alias("day_ms"), text.name_before_dash(F.col("index")).alias("head"))


@query("""with n as (select o_orderkey, case o_custkey % 3 when 0 then 'logs-' when 1 then 'logs' else 'other-' end || strftime(o_orderdate, '%Y.%m.%d') || case when o_custkey % 5 = 0 then '-000001' else '' end as name from orders)
  select o_orderkey, case when regexp_matches(name, '^logs-\\d{4}\\.\\d{2}\\.\\d{2}$') then epoch_ms(strptime(substr(name, 6), '%Y.%m.%d')) end::bigint as day_ms from n""")
def index_dates(spark, sf_dir):
    c = F.col("o_custkey")
    name = F.concat(F.when(c % 3 == 0, "logs-").when(c % 3 == 1, "logs").otherwise("other-"), F.date_format("o_orderdate", "yyyy.MM.dd"), F.when(c % 5 == 0, "-000001").otherwise(""))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.index_date_ms(name, "logs").alias("day_ms"))
