"""Small cases with known answers."""

import json
import time

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import jsonnorm, text
from ledgerline.operators import bulk, docrepair, repair, schema
from ledgerline.operators import control as K
from ledgerline.operators import retention as T
from ledgerline.sources.events import values
from ledgerline.sources.state import merge_watermarks


def rows(df):
    return sorted(tuple(r) for r in df.collect())


MESSAGES = [
    ("hello there", None),
    ('{"depth":"low","text":"sample"}', '{"depth":"low","text":"sample"}'),
    ('{"Large": 12345678901234567890}', '{"large":"12345678901234567000"}'),
    ('{"kept": "x", "gone": null}', '{"kept":"x"}'),
    ('{"a": {"b.c": "x"}}', '{"a":{"b_c":"x"}}'),
    ("[1, 2.50, 3]", '["1","2.5","3"]'),
    ('{"open": ', None),
    ('{"_index": "x", "_own": "y"}', '{"index":"x","own":"y"}'),
    ('{"m": [1, "b", {"c": 3}]}', '{"m":["1","b","{\\"c\\":3}"]}'),
    ('{"type": {"x": "y"}, "code": [1, 2]}', '{"code":"[1,2]","type":"{\\"x\\":\\"y\\"}"}'),
    ("42", None),
    ('{"a":1} x', None),
    ('{"a":NaN}', None),
    ('{"a":1e999}', None),
    ('{"a":' + "9" * 400 + "}", None),
    ('{"a":"\\ud800"}', None),
    ('{"a":"\\ud83d\\ude00"}', '{"a":"\U0001f600"}'),
    ('{"a":"\\\\ud800"}', '{"a":"\\\\ud800"}'),
    ('{"a":1.0,"b":1e21,"c":1e-7,"d":true}', '{"a":"1","b":"1000000000000000000000","c":"0.0000001","d":true}'),
    ('{"a":{"a":{"a":{"a":{"a":{"a":{"a":{"a":1}}}}}}}}', '{"a":{"a":{"a":{"a":{"a":{"a":{"a":"{\\"a\\":1}"}}}}}}}'),
]


def test_normalize(spark):
    df = values(spark, "i int, m string", [(i, m) for i, (m, _) in enumerate(MESSAGES)])
    got = dict(rows(df.select("i", jsonnorm.normalize_json(F.col("m")))))
    assert got == {i: p for i, (_, p) in enumerate(MESSAGES)}


def test_long_strings_are_cut_at_a_character():
    cut = jsonnorm.normalize({"s": "é" * 16_001})["s"]
    assert cut == "é" * 16_000 + "...[truncated]"


def test_depth_is_found_in_long_texts():
    """A long text costs a scan for brackets, not a step a character; depth is that outside strings."""
    text = '{"s":"' + "x" * 8_000_000 + '"}'
    began = time.process_time()
    assert jsonnorm.parse(text)["s"].startswith("xx")
    assert time.process_time() - began < 0.25
    deep = lambda n, s: "[" * n + json.dumps(s) + "]" * n
    assert jsonnorm.parse(deep(127, '[{\\"' * 300))
    for bad in (deep(128, ""), deep(128, '[\\"'), '{"a":"' + "[" * 200, '{"a":"\\"' + "{" * 200 + "}"):
        with pytest.raises(jsonnorm.NotJson):
            jsonnorm.parse(bad)


def test_string_sizes_and_repeats(spark):
    """Sizes of the rewritten string; texts that a batch repeats, nulls among them, keep their places."""
    each = [("é" * 20_000, 16_014, 32_014), ("x" * 33_000, 32_014, 32_014), ("ab", 2, 2)]
    texts = [json.dumps({"S": s}, ensure_ascii=False) for s, _, _ in each] + [None, "{", '{"s":1.50}', "[1]", '{"s":[]}']
    want = [(c, b) for _, c, b in each] + [None, None, (3, 3), None, None]
    df = values(spark, "i int, m string", [(i, texts[i % 8]) for i in range(40)]).coalesce(1)
    got = rows(df.select("i", jsonnorm.string_sizes(F.col("m"), "s"), jsonnorm.normalize_json(F.col("m"))))
    assert [x and tuple(x) for _, x, _ in got] == want * 5
    assert [x for _, _, x in got][3:8] == [None, None, '{"s":"1.5"}', '["1"]', '{"s":[]}'] and len({x for _, _, x in got}) == 7


def test_long_texts_are_dealt_out(spark):
    """A small file of keys that become long texts is no single task."""
    from ledgerline import catalogue

    df = catalogue.queries()["long_strings"](spark, "/root/testdata/sf0.001")
    assert df.rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism


def test_flatten():
    flat = jsonnorm.flatten_all
    assert flat({"u": {"p": {"n": 1}}, "s": "v"}) == {"s": "v", "u": {"p": '{"n":1}'}}
    assert flat([{"a": {"b": 1}}, 2]) == [{"a": '{"b":1}'}, 2]
    assert flat({"l": [[{"a": {"b": 1}}]]}) == {"l": [[{"a": '{"b":1}'}]]}
    assert flat({"l": [{"a": 1}], "t": ["x"]}) == {"l": '[{"a":1}]', "t": ["x"]}


def test_reduce():
    small = {"a": {"x": 1, "y": {"z": [{"q": 1}, {"r": 2}]}}, "b": 2}
    assert jsonnorm.reduce_fields(small) == small and len(jsonnorm.paths(small)) == 7 and jsonnorm.max_depth(small) == 5
    flat = {f"f{i}": i for i in range(1000)}
    assert jsonnorm.reduce_fields(flat) == jsonnorm.compact(flat)
    wide = {f"o{i}": {f"f{j}": j for j in range(20)} for i in range(100)}
    out = jsonnorm.reduce_fields(wide)
    assert len(jsonnorm.paths(out)) == 100 and json.loads(out["o1"]) == wide["o1"]
    uneven = {"a": {f"f{i}": i for i in range(800)}, "b": {"c": {f"g{i}": i for i in range(500)}}}
    out = jsonnorm.reduce_fields(uneven)
    assert len(jsonnorm.paths(out)) <= 900 and isinstance(out["a"], dict)


def test_names(spark):
    one = values(spark, "x string", [("/aws/group_1",)])
    got = one.select(text.stable_alias("logs", F.col("x")), text.version_of(text.stable_alias("logs", F.col("x")), "v1"), text.checkpoint_file(F.col("x")), text.index_date_ms(F.lit("p-2025.99.25"), "p"), text.segment_date_ms(F.lit("x-2025.12.25-000001"))).first()
    assert tuple(got) == ("logs-aws-group-1", "logs-aws-group-1-v1", "checkpoints--aws-group-1.json", None, 1766620800000)
    assert [repair.next_version(x, "a") for x in ("a-v1", "a-v2", "b")] == ["a-v2", "a-v1", "a-v2"]


def test_stress_and_adaptive(spark):
    seq = [("a", i, ok) for i, ok in enumerate((True, False, False, False))] + [("b", 0, False), ("b", 1, True)] + [("c", i, False) for i in range(12)]
    assert rows(K.stress(values(spark, "tracker string, seq int, ok boolean", seq))) == [("a", 3, 24, 3, "elevated"), ("b", 0, 3, 1, "normal"), ("c", 12, 60, 12, "critical")]
    lat = [("calm", i, 100, True, True, False) for i in range(10)] + [("slow", i, 3000, True, True, False) for i in range(3)] + [("dead", 0, 20000, True, False, False)] + [("held", i, 100, True, True, True) for i in range(12)]
    got = rows(K.adaptive(values(spark, "tracker string, seq int, latency_ms long, ok boolean, due boolean, pressed boolean", lat)))
    assert got == [("calm", 6250, 5, 0), ("dead", 2500, 2, 500), ("held", 5000, 4, 0), ("slow", 3750, 3, 100)]


def test_retry_wait(spark):
    df = values(spark, "i int, a int, t boolean, r boolean", [(0, 1, True, False), (1, 3, False, True), (2, 15, False, True), (3, 20, True, True), (4, 1, False, False)])
    assert [r[1] for r in rows(df.select("i", K.retry_wait(F.col("a"), F.col("t"), F.col("r"), F.lit(7000))))] == [7000, 1500, 5000, None, None]


def test_errors(spark):
    kinds = [
        ("mapper_parsing_exception", "any", "Mapping"), ("x", "wrong type", "Mapping"), ("version_conflict_engine_exception", "there", "VersionConflict"), ("es_rejected_execution_exception", "full", "Retryable"),
        ("document_parsing_exception", "Limit of total fields [9] exceeded", "FieldLimitExceeded"), ("validation_exception", "maximum normal shards open", "ShardLimitExceeded"), ("y", "else", "Other"),
    ]
    df = values(spark, "t string, r string, k string", kinds)
    assert df.where(docrepair.classify(F.col("t"), F.col("r")) != F.col("k")).count() == 0


def test_buffers(spark):
    own = bulk.buffers(100, 2)
    assert (own.sink_enriched, own.tail_raw, own.reconcile_raw, own.backfill_raw, own.heal_raw, own.resync_per_sample) == (400, 1024, 2048, 4096, 2048, 16)
    assert own.bytes() == 1024 * (400 + 1024 + 2048 + 4096 + 2048 + 16)
    got = spark.range(1).select(*[c.alias(n) for n, c in bulk.buffer_columns(F.lit(100), F.lit(2)).items()]).first()
    assert got["bytes"] == own.bytes()
    for bad in ((10_000_000, 1), (1000, 5000)):
        with pytest.raises(ValueError):
            bulk.buffers(*bad)
    bulk.check_backfill(30, 2)
    for bad in ((30, 0), (40_000, 1)):
        with pytest.raises(ValueError):
            bulk.check_backfill(*bad)


def test_watermarks_and_clamp(spark):
    kind = "stable string, watermark_ms long"
    old, new = values(spark, kind, [("a", 100), ("b", 100), ("d", 9)]), values(spark, kind, [("a", 50), ("b", 150), ("b", 120), ("c", 7)])
    assert rows(merge_watermarks(old, new)) == [("a", 100, False), ("b", 150, True), ("c", 7, True), ("d", 9, False)]
    windows = values(spark, "stable string, start_ms long, end_ms long", [("a", 1000, 2000), ("a", 500, 2000), ("a", 0, 1000), ("b", 0, 10)])
    assert rows(T.clamp(windows, values(spark, kind, [("a", 1000)]))) == [("a", 1000, 2000), ("a", 1000, 2000), ("b", 0, 10)]


def test_delete_candidates(spark):
    named = lambda a, ts, by: [(a, f".ds-{a}-v1-2025.12.{25 + i}-00000{i + 1}", i + 1, t, b) for i, (t, b) in enumerate(zip(ts, by, strict=True))]
    segments = named("old", [900, 1500, 1], [5, 6, 7]) + named("none", [2000, 3000, 1], [1, None, 2]) + [("bad", "bad-a", 1, None, 3), ("bad", "bad-b", 2, None, None), ("one", "one-a", 1, 1, 1)]
    df = values(spark, "stable_alias string, index string, seq int, max_ts_ms long, store_bytes long", segments)
    want = [("bad", "bad-a", -(1 << 63), 1000, 3, "EmergencyOldest"), ("none", ".ds-none-v1-2025.12.25-000001", 1766620800000, 1000, 1, "EmergencyOldest"), ("old", ".ds-old-v1-2025.12.25-000001", 900, 900, 5, "TimestampEligible")]
    assert rows(T.delete_candidates(df, 1000, True)) == want
    assert rows(T.delete_candidates(df, 1000, False)) == want[2:]


def test_types(spark):
    docs = values(spark, "index string, json string", [("a", '{"x":"hello","n":1,"d":"2024-01-01T00:00:00Z","o":{"p":true}}'), ("a", '{"x":"world","n":"one","d":null,"l":["a"]}'), ("a", '{"x":5,"n":2,"e":[]}')])
    mapping = values(spark, "index string, path string, es_type string", [("a", "x", "long"), ("a", "n", "long"), ("a", "d", "keyword"), ("a", "o.p", "keyword"), ("a", "l", "keyword"), ("a", "e", "long")])
    assert rows(schema.mismatches(schema.field_types(docs), mapping)) == [("a", "o.p", "Boolean", "String"), ("a", "x", "String", "Number")]
