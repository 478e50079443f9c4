"""Queries over bulk writes and runs over days."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import backfill as K
from ..operators import bulk as B
from ..operators.enrich import enrich
from ..sources.events import NOW_MS, RAW, SQL, raw, source, table, target, values
from .enrichment import _PARSED, _STAMP
from .reconciliation import _AFTER, _REPLACED
from .registry import query

DAY = 86_400_000


@query(f"""with {SQL} select id, '{{"create":{{"_index":"myapp-' || replace(substr(log_group, 2), '/', '-') || '","_id":"' || id || '"}}}}' as action,
  '{{"@timestamp":"' || {_STAMP} || '","event":{{"id":"' || id || '"}},"log_group":"' || log_group || '","message":"' || replace(message, '"', '\\"') || '","parsed":' || {_PARSED} || ',"tags":["json_parsed","sync","synced"]}}' as document from source""")
def bulk_body(spark, sf_dir):
    return B.body(enrich(source(spark, sf_dir)), "myapp")


_LEVELS = "(values ('normal', 1), ('elevated', 2), ('critical', 4)) t(level, part)"
_RANK = "case when k % 5 = 0 then 0 when k % 5 = 1 then 1 when k % 5 = 2 then 2 when k % 5 = 3 then 3 else 4 end"


@query(f"with {RAW} select event_id, level, ((row_number() over (partition by event_type, level order by {_RANK}, event_id) - 1) // (48 // part))::bigint as batch from raw, {_LEVELS}")
def bulk_batches(spark, sf_dir):
    p = F.expr("case when k % 5 = 0 then 255 when k % 5 = 1 then 192 when k % 5 = 2 then 128 when k % 5 = 3 then 64 else 0 end")
    queue = raw(spark, sf_dir).withColumn("priority", p).crossJoin(values(spark, "level string", [("normal",), ("elevated",), ("critical",)]))
    return B.batches(queue, ["event_type", "level"], ["event_id"], B.effective_batch(F.lit(48), F.col("level"))).select("event_id", "level", "batch")


@query(f"with {RAW} select level, flight::bigint as flight, (case level when 'critical' then 1 when 'elevated' then greatest(1, flight // 2) else flight end)::bigint as effective from (select distinct k as flight from raw where k > 0), {_LEVELS}")
def in_flight_limits(spark, sf_dir):
    rows = raw(spark, sf_dir).where("k > 0").select(F.col("k").alias("flight")).distinct().crossJoin(values(spark, "level string", [("normal",), ("elevated",), ("critical",)]))
    return rows.select("level", "flight", B.effective_in_flight(F.col("flight"), F.col("level")).cast("long").alias("effective"))


def _refuse(docs, attempt: int):
    """A store that refuses an order by its key, until the document is as that store wants it."""
    k, parsed = F.col("id").cast("long") % 8, F.col("parsed")
    deep, whole = F.get_json_object("parsed", "$.a.b.c").isNotNull(), parsed.startswith('"')
    error = lambda t, r: F.struct(F.lit(t).alias("type"), F.lit(r).alias("reason"))
    why = (
        F.when(parsed.contains("_ingestion_error"), F.when(F.col("id").cast("long") % 16 == 12, error("x", "again")))
        .when((k == 1), error("version_conflict_engine_exception", "exists"))
        .when((k == 2) & deep, error("mapper_parsing_exception", "any"))
        .when((k == 3) & (F.lit(attempt) == 1), error("timeout_exception", "neutral"))
        .when((k == 4), error("unknown", "neutral"))
        .when((k == 5) & ~whole, error("mapper_parsing_exception", "always"))
        .when((k == 6) & (F.lit(attempt) < 3), error("validation_exception", "maximum normal shards open"))
        .when((k == 7), error("mapper_parsing_exception", "never"))
    )
    return docs.withColumn("why", why).where("why is not null").select("id", "why.type", "why.reason")


_DOC = """'{"a":{"b":{"c":' || o_custkey || '},"x":1}}'"""
_FLAT = """'{"a":{"b":"{\\"c\\":' || o_custkey || '}","x":1}}'"""


@query(f"""select o_orderkey::varchar as id, (case o_orderkey % 8 when 2 then 2 when 3 then 2 when 5 then 4 when 6 then 3 when 7 then 4 else 1 end)::int as attempt,
  case o_orderkey % 8 when 1 then 'skipped' when 4 then case when o_orderkey % 16 = 12 then 'failed' else 'fallback' end when 5 then 'stringified' when 7 then 'failed' else 'sent' end as outcome,
  case o_orderkey % 8 when 2 then {_FLAT} when 4 then '{{"_ingestion_error":{{"type":"unknown","reason":"neutral","original_message_preview":"' || o_orderpriority || '"}}}}' when 5 then to_json({_FLAT})::varchar when 7 then to_json({_FLAT})::varchar else {_DOC} end as parsed from orders""")
def bulk_outcomes(spark, sf_dir):
    docs = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("message"), F.expr(_DOC).alias("parsed"), F.array(F.lit("sync")).alias("tags"))
    return B.deliver(docs, _refuse).select("id", "attempt", "outcome", "parsed")


# Days -----------------------------------------------------------------------------------------------------------------------

_AGO = 11  # 20 January, of which the target has nothing


def _inserted(days: str, priority: str) -> str:
    return f"with {SQL} select id, timestamp_ms as ts_ms, message, ({priority})::int as priority from source where {days} and id not in (select id from target)"


@query(_inserted(f"timestamp_ms >= {NOW_MS - _AGO * DAY} and timestamp_ms < {NOW_MS - (_AGO - 1) * DAY}", "64"))
def backfill_day(spark, sf_dir):
    s, t = (f(spark, sf_dir, NOW_MS - _AGO * DAY, NOW_MS - (_AGO - 1) * DAY) for f in (source, target))
    return K.backfill_day(s, t, NOW_MS, _AGO).select(F.col("event.id").alias("id"), "ts_ms", "message", "priority")


_FLOOR = NOW_MS - 20 * DAY + DAY // 4


@query(_inserted(f"timestamp_ms >= {_FLOOR} and timestamp_ms < {NOW_MS - 19 * DAY}", "0"))
def heal_day(spark, sf_dir):
    return K.heal_day(source(spark, sf_dir), target(spark, sf_dir), NOW_MS, 20, _FLOOR).select(F.col("event.id").alias("id"), "ts_ms", "message", "priority")


@query(_inserted(f"timestamp_ms >= {_FLOOR}", f"case when ({NOW_MS} - timestamp_ms // {DAY} * {DAY}) // {DAY} <= 0 then 255 when ({NOW_MS} - timestamp_ms // {DAY} * {DAY}) // {DAY} <= 3 then 192 when ({NOW_MS} - timestamp_ms // {DAY} * {DAY}) // {DAY} <= 7 then 128 else 64 end"))
def backfill_days(spark, sf_dir):
    out = K.backfill(source(spark, sf_dir, _FLOOR), target(spark, sf_dir, _FLOOR), NOW_MS, 31, _FLOOR)
    return out.select(F.col("event.id").alias("id"), "ts_ms", "message", "priority")


_SPAN = NOW_MS - _FLOOR


@query(f"""with recursive {SQL}, t(level, node, s, e) as (select 0, 0::bigint, {_FLOOR}::bigint, {NOW_MS}::bigint union all select level + 1, node * 2 + b, case when b = 0 then s else s + (e - s) // 2 end, case when b = 0 then s + (e - s) // 2 else e end from t, (values (0), (1)) h(b) where e - s > {_SPAN // 16}),
 x as (select t.*, greatest(s, s + (e - s) // 2 - {_SPAN // 16}) as ms, least(e, s + (e - s) // 2 + {_SPAN // 16}) as me from t),
 side as (select level, node, s, e, ms, me, which, list(id order by timestamp_ms, id) as ids, list(id order by timestamp_ms, id) filter (where timestamp_ms >= ms and timestamp_ms < me) as mid from x join (select *, 'a' as which from source union all select *, 'b' from target) r on timestamp_ms >= s and timestamp_ms < e group by all),
 n as (select x.level, x.node, x.s, x.e, coalesce(len(a.ids), 0) as a, coalesce(len(b.ids), 0) as b, a.ids[:16] = b.ids[:16] and a.ids[-16:] = b.ids[-16:] and len(list_filter(coalesce(a.mid, [])[:16], lambda i: not list_contains(coalesce(b.mid, []), i))) = 0 as same
   from x left join (select * from side where which = 'a') a on a.level = x.level and a.node = x.node left join (select * from side where which = 'b') b on b.level = x.level and b.node = x.node),
 d as (select *, case when a = 0 and b = 0 then 'skip' when abs(a - b) * 100 // greatest(a, b) >= 30 then 'replace' when a = b and same then 'accept' when e - s > {_SPAN // 16} then 'split' else 'replace_leaf' end as decision from n),
 r as materialized (select s, e from d where decision like 'replace%' and not exists (select 1 from d p where p.level < d.level and p.node = d.node >> (d.level - p.level) and p.decision <> 'split')), {_REPLACED} {_AFTER}""")
def rolling_reconcile(spark, sf_dir):
    return K.rolling(source(spark, sf_dir), target(spark, sf_dir), NOW_MS, 25, _FLOOR)
