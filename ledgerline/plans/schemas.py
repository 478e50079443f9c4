"""Queries over field types, schema conflicts and their repair."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalogue as G
from ..operators import docrepair as D
from ..operators import repair as P
from ..operators import schema as H
from ..sources.events import NOW_MS, RAW, SQL, raw, source, table, values
from .registry import query

DAY = 86_400_000
JAN1 = NOW_MS - 30 * DAY


@query(f"with {SQL} select replace(log_group, '/app/', 'logs-') as index, 'k' as path, 'Number' as type from source group by all")
def field_type_mode(spark, sf_dir):
    docs = source(spark, sf_dir).select(F.replace(F.col("log_group"), F.lit("/app/"), F.lit("logs-")).alias("index"), F.col("message").alias("json"))
    return H.consensus(H.field_types(docs))


#: Documents whose fields have mixed types: x a number or a word by k, n sometimes null, d a date, o.p a boolean, l a list.
_FORM = '{"x":%s,"n":%s,"d":"2024-01-01T00:00:%02d","o":{"p":%s},"l":["a",%d],"e":[]}'
_TYPES = """types as (select event_type as index, p as path, case p when 'x' then case when k % 10 < 6 then 'Number' else 'String' end when 'n' then case when k % 2 = 0 then 'Null' else 'Number' end
  when 'd' then 'Date' when 'o.p' then 'Boolean' when 'l' then 'String' else 'Unknown' end as type from raw, (values ('x'), ('n'), ('d'), ('o.p'), ('l'), ('e')) t(p)),
 best as (select index, path, arg_max(type, n * 1000 - ascii(type)) as type from (select index, path, type, count(*) as n from types where type <> 'Null' group by all) group by all)"""
_MAPPED = [("x", "text"), ("n", "long"), ("d", "keyword"), ("o.p", "keyword"), ("l", "long"), ("e", "long")]


def _docs(spark, sf_dir):
    k = F.col("k")
    j = F.format_string(_FORM, F.when(k % 10 < 6, k.cast("string")).otherwise('"w"'), F.when(k % 2 == 0, "null").otherwise(k.cast("string")), k % 60, F.when(k % 3 == 0, "true").otherwise("false"), k)
    return raw(spark, sf_dir).select(F.col("event_type").alias("index"), F.col("ms").alias("timestamp_ms"), F.col("event_id").cast("string").alias("id"), j.alias("json"))


def _mapping(spark, sf_dir):
    return _docs(spark, sf_dir).select("index").distinct().crossJoin(values(spark, "path string, es_type string", _MAPPED))


@query(f"with {RAW}, {_TYPES} select * from best")
def field_type_consensus(spark, sf_dir):
    return H.consensus(H.field_types(_docs(spark, sf_dir)))


_STORE = "case es_type when 'text' then 'String' when 'keyword' then 'String' when 'long' then 'Number' when 'date' then 'Date' else 'Unknown' end"


@query(f"""with {RAW}, {_TYPES}, m as (select path, {_STORE} as store from (values {", ".join(map(str, _MAPPED))}) t(path, es_type))
  select index, path, type, store from best join m using (path) where type not in ('Unknown', 'Null') and not (type = store or (type = 'String' and store = 'Date') or (type = 'Date' and store = 'String') or (type = 'Array' and store in ('String', 'Number', 'Boolean', 'Date')))""")
def type_mismatches(spark, sf_dir):
    return H.mismatches(H.field_types(_docs(spark, sf_dir)), _mapping(spark, sf_dir))


_SAMPLED = "sampled as (select * from (select *, row_number() over (partition by event_type order by ms, event_id::varchar) as rn from raw) where rn <= 100)"


@query(f"with {RAW}, {_SAMPLED} select event_type as index, event_id::varchar as id from sampled")
def sample_documents(spark, sf_dir):
    return G.sample_documents(_docs(spark, sf_dir)).select("index", "id")


@query(f"""with {RAW}, {_SAMPLED}, {_TYPES.replace("from raw", "from sampled")} select distinct index from best where (path = 'x' and type = 'Number') or (path = 'o.p') or path = 'l' and type = 'String'""")
def heal_sampled(spark, sf_dir):
    """Indices whose first 100 documents contradict their mapping."""
    return P.fixable(H.field_types(G.sample_documents(_docs(spark, sf_dir))), _mapping(spark, sf_dir))


#: A mapping a segment: its field types change with the day.
_SEGMENTS = f"""segments as (select event_type, d, '.ds-' || event_type || '-v1-' || strftime(make_timestamp(({JAN1} + d * {DAY}) * 1000), '%Y.%m.%d') || '-' || printf('%06d', d::int) as index from (select distinct event_type, (ms - {JAN1}) // {DAY} as d from raw)),
 mapped as (select event_type, index, path, case path when 'a' then case when d % 4 = 0 then 'keyword' else 'long' end when 'b' then 'date' when 'c' then case when d % 2 = 0 then 'text' else 'keyword' end else case when d = 3 then 'long' else 'object' end end as es_type from segments, (values ('a'), ('b'), ('c'), ('o.p')) t(path))"""


def _segments(spark, sf_dir):
    r = raw(spark, sf_dir).select("event_type", F.expr(f"(ms - {JAN1}) div {DAY}").alias("d")).distinct()
    name = F.concat(F.lit(".ds-"), "event_type", F.lit("-v1-"), F.date_format(F.timestamp_millis(F.lit(JAN1) + F.col("d") * DAY), "yyyy.MM.dd"), F.lit("-"), F.lpad(F.col("d").cast("string"), 6, "0"))
    rows = r.withColumn("index", name).crossJoin(values(spark, "path string", [("a",), ("b",), ("c",), ("o.p",)]))
    d = F.col("d")
    kind = F.when(F.col("path") == "a", F.when(d % 4 == 0, "keyword").otherwise("long")).when(F.col("path") == "b", "date").when(F.col("path") == "c", F.when(d % 2 == 0, "text").otherwise("keyword")).otherwise(F.when(d == 3, "long").otherwise("object"))
    return rows.select("event_type", "index", "path", kind.alias("es_type"))


_MINOR = "minor as (select event_type, path, index, es_type from (select *, max(n) over (partition by event_type, path) as mx from (select *, count(*) over (partition by event_type, path, es_type) as n from mapped)) where n < mx)"


@query(f"with {RAW}, {_SEGMENTS}, {_MINOR} select event_type || '-v1' as stream, path, index, es_type from minor")
def cross_index_minority(spark, sf_dir):
    return H.minority(_segments(spark, sf_dir).drop("event_type"))


@query(f"with {RAW}, {_SEGMENTS} select distinct path, index from mapped where path in (select path from mapped group by path having count(distinct es_type) > 1)")
def field_caps_conflicts(spark, sf_dir):
    return H.caps_conflicts(_segments(spark, sf_dir).drop("event_type"))


_OBJECT = '{"properties":{"a":{"type":"%s"},"o":{"properties":{"p":{"type":"%s"},"q":{"type":"object","properties":{"r":{"type":"date"}}}}},"x":{"analyzer":"%s"}}}'


@query("""select o_orderkey::varchar as index, path, case path when 'a' then case when o_custkey % 2 = 0 then 'long' else 'keyword' end when 'o.p' then lower(o_orderstatus) when 'o.q' then 'object' else 'date' end as es_type from orders, (values ('a'), ('o.p'), ('o.q'), ('o.q.r')) t(path)""")
def mapping_leaves(spark, sf_dir):
    j = F.format_string(_OBJECT, F.when(F.col("o_custkey") % 2 == 0, "long").otherwise("keyword"), F.lower("o_orderstatus"), "o_orderpriority")
    return G.mapping_types(table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("index"), j.alias("json")))


@query(f"with {RAW}, {_SEGMENTS} select index, case when event_type = 'view' then null else max(es_type) filter (where path = 'a') end as es_type from mapped group by index, event_type")
def field_of_index(spark, sf_dir):
    fields = _segments(spark, sf_dir).where("not (event_type = 'view' and path = 'a')")
    texts = fields.groupBy("index").agg(G.mapping_json(F.collect_list(F.struct("path", "es_type"))).alias("json"))
    return G.field_type(G.mapping_types(texts), "a")


@query("with a as (select distinct o_custkey as alias, o_orderpriority as index from orders) select alias, any_value(index) as index from a group by alias having count(*) = 1")
def resolve_alias(spark, sf_dir):
    return H.resolve_alias(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("alias"), F.col("o_orderpriority").alias("index")).distinct())


_BEFORE = "aliases as (select distinct 'logs-' || event_type as alias, 'logs-' || event_type || v as index from raw, (values ('-v1'), ('-v2')) t(v) where event_type <> 'view' or v = '-v1')"


@query(f"with {RAW}, {_BEFORE} select * from aliases where alias <> 'logs-click' union all select 'logs-click', 'logs-click-v3'")
def alias_cutover(spark, sf_dir):
    types = raw(spark, sf_dir).select("event_type").distinct().crossJoin(values(spark, "v string", [("-v1",), ("-v2",)])).where("event_type <> 'view' or v = '-v1'")
    aliases = types.select(F.concat(F.lit("logs-"), "event_type").alias("alias"), F.concat(F.lit("logs-"), "event_type", "v").alias("index"))
    return P.cutover_alias(aliases, "logs-click", "logs-click-v3")


#: The window that is healed, and the two versions of a stream: the second holds some rows already.
_FROM, _TO = JAN1 + 4 * DAY + DAY // 2, JAN1 + 7 * DAY


def _versions(spark, sf_dir):
    s = source(spark, sf_dir).withColumn("segment", F.expr("timestamp_ms div 86400000").cast("string"))
    old = s.withColumn("stream", F.lit("logs-all-v1"))
    kept = s.where("cast(id as bigint) % 10 = 0").withColumns({"stream": F.lit("logs-all-v2"), "message": F.lit("kept")})
    return old.unionByName(kept)


@query(f"with {SQL} select id, timestamp_ms, case when id::bigint % 10 = 0 then 'kept' else message end as message, 'logs-all-v2' as stream from source")
def heal_window(spark, sf_dir):
    rows = _versions(spark, sf_dir)
    days = rows.where("stream = 'logs-all-v1'").select(F.col("segment").alias("index")).distinct()
    types = days.select("index", F.lit("k").alias("path"), F.lit("Number").alias("type"))
    mapping = days.select("index", F.lit("k").alias("path"), F.when(F.col("index").cast("long") % 3 == 0, "boolean").otherwise("long").alias("es_type"))
    aliases = values(spark, "alias string, index string", [("logs-all", "logs-all-v1")])
    return P.heal_window(rows, types, mapping, aliases, "logs-all", _FROM, _TO)[0].select("id", "timestamp_ms", "message", "stream")


@query(f"with {RAW}, {_SEGMENTS}, {_MINOR} select distinct index from minor union select distinct index from mapped where path = 'b' and event_type = 'click'")
def heal_all(spark, sf_dir):
    """Indices to rebuild: data against mapping, and mapping against its stream's."""
    s = _segments(spark, sf_dir)
    types = s.where("path = 'b'").select("index", "path", F.when(F.col("event_type") == "click", "Boolean").otherwise("Date").alias("type"))
    return P.heal(types, s.drop("event_type"))


@query(f"with {SQL}, b as (select timestamp_ms // {DAY} as d, min(timestamp_ms) as f, max(timestamp_ms) as l from source group by 1) select id, timestamp_ms from source where timestamp_ms // {DAY} not in (select d from b where f >= {_FROM} and l <= {_TO - 1})")
def cleanup_window(spark, sf_dir):
    rows = source(spark, sf_dir).withColumn("segment", F.expr("timestamp_ms div 86400000").cast("string"))
    return P.cleanup_window(rows, _FROM, _TO).select("id", "timestamp_ms")


@query(f"with {SQL} select id from source where log_group not in ('/app/click', '/app/none')")
def drop_segments(spark, sf_dir):
    rows = source(spark, sf_dir).withColumn("segment", F.col("log_group"))
    return P.drop_segments(rows, values(spark, "segment string", [("/app/click",), ("/app/none",)])).select("id")


@query(f"with {RAW} select event_id::varchar as id, case when k % 10 < 6 then k end::bigint as value from raw")
def reindex_tolerant(spark, sf_dir):
    return P.reindexed(_docs(spark, sf_dir), "x", "bigint").select("id", "value")


@query("select o_orderkey, least(o_custkey % 4, greatest(length(o_orderpriority) - 5 - 1, 0))::bigint as replicas from orders")
def replica_counts(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", P.replicas(F.col("o_custkey") % 4, F.length("o_orderpriority") - 5).cast("long").alias("replicas"))


# Errors of the store -------------------------------------------------------------------------------------------------------

_KINDS = ("mapper_parsing_exception", "illegal_argument_exception", "x", "version_conflict_engine_exception", "circuit_breaker_exception", "timeout_exception", "document_parsing_exception", "validation_exception")
_REASONS = ("any", "bad mapper", "Limit of total fields [1000] has been exceeded", "maximum normal shards open", "neutral")
_PICK = "case k % 8 " + " ".join(f"when {i} then '{x}'" for i, x in enumerate(_KINDS)) + " end as type, case event_id % 5 " + " ".join(f"when {i} then '{x}'" for i, x in enumerate(_REASONS)) + " end as reason"
_CLASS = """case when type = 'validation_exception' and reason like '%maximum normal shards open%' then 'ShardLimitExceeded' when type = 'document_parsing_exception' and reason like '%Limit of total fields%' then 'FieldLimitExceeded'
  when type in ('mapper_parsing_exception', 'illegal_argument_exception', 'strict_dynamic_mapping_exception') or reason like '%mapper%' or reason like '%dynamic%' or reason like '%type%' then 'Mapping'
  when type in ('version_conflict_engine_exception', 'document_already_exists_exception') then 'VersionConflict' when type like '%circuit_breaker%' or type like '%timeout%' or type like '%es_rejected_execution%' or type like '%cluster_block%' then 'Retryable' else 'Other' end"""


@query(f"""with {RAW}, e as (select event_id, {_PICK} from raw), c as (select event_id, {_CLASS} as kind from e)
  select event_id, kind, case kind when 'ShardLimitExceeded' then 'wait_and_retry' when 'FieldLimitExceeded' then 'reduce_and_retry' when 'Mapping' then 'flatten_and_retry' when 'VersionConflict' then 'skip' when 'Retryable' then 'retry' else 'fallback' end as action from c""")
def classify_errors(spark, sf_dir):
    rows = raw(spark, sf_dir).selectExpr("event_id", *_PICK.split(", case event_id")[:1], "case event_id" + _PICK.split(", case event_id")[1])
    kind = D.classify(F.col("type"), F.col("reason"))
    return rows.select("event_id", kind.alias("kind"), D.action(kind).alias("action"))


@query(f"with {RAW}, r as (select *, ms // 3600000 as batch, row_number() over (partition by ms // 3600000 order by event_id) - 1 as position from raw) select batch, position::int as position, (400 + k)::int as status, 'kind' || k as type, 'r' || event_id as reason from r where k % 3 = 0 and position < 5")
def failed_items(spark, sf_dir):
    k = F.col("k")
    bad = F.format_string('{"create":{"status":%d,"error":{"type":"kind%d","reason":"r%d"}}}', 400 + k, k, "event_id")
    item = F.struct("event_id", F.when(k % 3 == 0, bad).otherwise('{"create":{"status":201}}').alias("x"))
    bodies = raw(spark, sf_dir).groupBy(F.expr("ms div 3600000").alias("batch")).agg(F.concat(F.lit('{"items":['), F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["x"]), ","), F.lit("]}")).alias("json"))
    return D.failed_items(bodies, 5, ["batch"])


@query("""select doc_id::bigint as doc_id, 't' as type, repeat('r', 500) as reason, substr(text, 1, 1000) as preview, 'info' as level, 'sync,ingestion_error' as tags from documents""")
def fallback_docs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", F.col("text").alias("message"), F.lit('{"level":"info","x":1}').alias("parsed"), F.array(F.lit("sync")).alias("tags"), F.lit("t").alias("error_type"), F.repeat(F.lit("r"), F.lit(600)).alias("error_reason"))
    out = D.fallback(rows).withColumn("e", F.from_json("parsed", "_ingestion_error struct<type: string, reason: string, original_message_preview: string>, level string"))
    return out.select("doc_id", "e._ingestion_error.type", "e._ingestion_error.reason", F.col("e._ingestion_error.original_message_preview").alias("preview"), F.col("e.level").alias("level"), F.array_join("tags", ",").alias("tags"))
