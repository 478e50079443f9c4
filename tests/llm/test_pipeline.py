"""The pipeline's stages, each against what it must keep."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm import graph, near_copies, secret_scan
from ledgerline.llm.common import cut

from .test_texts import ODD, brute_spans

SF = "/root/testdata/sf0.001"


def brute_kept(rows):
    """The ids that stay: the least of each class of texts linked by a Jaccard similarity of 0.8 of five-word shingles."""
    words = [(r["text"] or "").encode().lower().split() for r in rows]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in words]
    of, root = {}, list(range(len(sets)))
    for i, s in enumerate(sets):
        for x in s:
            of.setdefault(x, []).append(i)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in enumerate(sets):
        shared = collections.Counter(j for x in s for j in of[x] if j < i)
        for j, n in shared.items():
            if n >= 0.8 * (len(s) + len(sets[j]) - n) - 1e-9:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    least = {}
    for i, r in enumerate(rows):
        least[find(i)] = min(r["doc_id"], least.get(find(i), r["doc_id"]))
    return sorted(least.values())


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(10_000 + i, t, None, None, 0) for i, t in enumerate(ODD)] + [(7_000, "password=abcdefghijklmnop one", "en", "s", 0), (7_001, "the same words here again", "en", "s", 0), (7_001, "the same words here again", "en", "s", 0)], docs.schema)
    docs = docs.union(odd)
    stages = dict(corpus_pipeline.STAGES)
    first = cut(stages["language_id"](spark, docs, SF))
    assert first.columns == docs.columns
    gone = {r["doc_id"] for r in docs.join(first.select("doc_id"), "doc_id", "left_anti").collect()}
    assert {10_000, 10_001, 10_002} <= gone and len(gone) <= 6
    second = cut(stages["simhash_dedup"](spark, first, SF))
    assert sorted(r["doc_id"] for r in second.collect()) == brute_kept(first.collect())
    third = cut(stages["secret_scan"](spark, second, SF))
    before = {r["doc_id"]: r["text"] for r in second.collect()}
    for r in third.collect():
        assert not brute_spans(r["text"]) and (r["text"] == before[r["doc_id"]]) == (not brute_spans(before[r["doc_id"]]))
    fourth = cut(stages["mixing"](spark, third, SF))
    assert fourth.columns == docs.columns
    sizes = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in third.collect()}
    got = fourth.groupBy("doc_id").count().collect()
    assert all(r["count"] <= 3 for r in got)
    assert abs(sum(r["count"] * sizes[r["doc_id"]] for r in got) / sum(sizes.values()) - 1) < 0.1
    last = stages["sentencepiece"](spark, fourth, SF)
    assert last.count() == fourth.count() and last.where("not round_trip").count() == 0


def test_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, SF))
    assert docs.count() == 0


def test_masks_stay_masked(spark):
    docs = spark.createDataFrame([(1, "a password=abcdefghijklmnop z AKIA" + "B" * 20)], "doc_id long, text string").withColumn("n_chars", F.length("text"))
    out = secret_scan.masked(docs).first()
    assert out["text"] == "a [assign] z [access]" and out["n_chars"] == len(out["text"])


def _edited(rng, words, every):
    """A copy with every so-manieth word replaced."""
    return [f"new{rng.randrange(10**9)}" if i % every == every // 2 else w for i, w in enumerate(words)]


@pytest.mark.parametrize(("small", "hot", "block"), [(16, 64, 128), (1, 64, 128), (2, 2, 3), (2, 10_000, 128)])
def test_dedup_finds_edited_copies(spark, monkeypatch, small, hot, block):
    """Classes by brute force: five-word shingles, Jaccard similarity 0.8 or more; by each of the ways for large groups."""
    for name, value in (("SMALL", small), ("HOT", hot), ("BLOCK", block)):
        monkeypatch.setattr(near_copies, name, value)
    rng = random.Random(3)
    texts = []
    for size in (40, 100, 200, 500, 1000):
        for every in (200, 100, 60, 48, 40, 30, 15):
            words = [f"w{rng.randrange(50_000)}" for _ in range(size)]
            texts += [words, _edited(rng, words, every), _edited(rng, _edited(rng, words, every), every + 7)]
    words = [f"w{rng.randrange(50_000)}" for _ in range(300)]
    texts += [_edited(rng, words, 300 + i % 5) for i in range(80)]
    # A passage that many share, with little or much beside it, and a family of texts about as near as the limit.
    passage = [f"p{i}" for i in range(90)]
    texts += [passage + [f"own{rng.randrange(10**9)}" for _ in range(n)] for n in (8, 12, 20, 60, 200) for _ in range(12)]
    near = [f"n{i}" for i in range(150)]
    for _ in range(60):
        at = set(rng.sample(range(150), 2))
        texts.append([f"x{rng.randrange(10**9)}" if i in at else w for i, w in enumerate(near)])
    texts += [["one"], ["One"], ["one", "two"], ["two"]]
    rng.shuffle(texts)
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    docs = spark.createDataFrame([(i, " ".join(t), "en", "s", 0) for i, t in enumerate(texts)], schema)
    want = brute_kept(docs.collect())
    got = sorted(r["doc_id"] for r in dict(corpus_pipeline.STAGES)["simhash_dedup"](spark, docs, SF).collect())
    assert 100 < len(want) < 320 and got == want


def test_centres_are_compared_once(spark, monkeypatch):
    """A family of near copies meets in most segments of its ring, mostly with the same centres: a node is compared with each
    of them once a level, so its pairs are few, and all of the family is one class."""
    monkeypatch.setattr(near_copies, "SMALL", 1)
    asked, confirmed = [], near_copies._confirmed

    def counted(pairs, sets):
        asked.append((pairs.count(), pairs.distinct().count()))
        return confirmed(pairs, sets)

    monkeypatch.setattr(near_copies, "_confirmed", counted)
    rng = random.Random(9)
    words = [f"w{rng.randrange(50_000)}" for _ in range(300)]
    texts = [(i, " ".join(_edited(rng, words, 300 + i % 5)), "en", "s", 0) for i in range(120)]
    docs = spark.createDataFrame(texts, spark.read.parquet(f"{SF}/documents.parquet").schema)
    stage = dict(corpus_pipeline.STAGES)["simhash_dedup"]
    assert [r["doc_id"] for r in stage(spark, docs, SF).collect()] == brute_kept(docs.collect()) == [0]
    # Two levels, and two centres that ask for each other.
    rows, pairs = asked[0]
    assert 119 <= pairs <= rows <= 4 * pairs


def test_near_copies_meet_on_the_ring():
    """Keys are the SimHashes of the ring's segments, and sets at the limit of similarity share one, whole or sampled."""
    rng = np.random.default_rng(5)
    for a in (5, 9, 31, 33, 64, 127, 200, 255, 256, 500, 1023, 5000):
        for b in {a, a + a // 8, a + a // 4}:
            for _ in range(20):
                common = -(-8 * (a + b) // 18)  # the least that gives 0.8
                pool = np.unique(rng.integers(0, 1 << 64, a + b - common, np.uint64, endpoint=False))
                rng.shuffle(pool)
                x, y = np.sort(pool[:a]), np.sort(np.concatenate([pool[:common], pool[a:]]))
                keys = [set(zip(*near_copies.ring_keys(h)[:2].tolist(), strict=True)) for h in (x, y)]
                assert common <= a and keys[0] & keys[1]
    h = np.sort(rng.integers(0, 1 << 64, 200, np.uint64))
    for i, k, _ in near_copies.ring_keys(h).T.tolist():
        own = [v for v in h.tolist() if (v & 0xFFFFFFFF) * near_copies.segments_of(i // 64) >> 32 == i % 64]
        assert k == sum((2 * sum(v >> b & 1 for v in own) > len(own)) << b for b in range(64))


def test_odd_rows_in_every_stage(spark):
    """Nulls in any column, repeated rows, clashing extra columns: each stage keeps the columns, and the pipeline's last
    stage has a row for each document that the mix takes."""
    base = [(i, f"the house stands near water and trees number {i} " * 4, "en", "a", 10) for i in range(30)]
    odd = [(None, "der hund und die katze laufen weit " * 5, "de", None, 3), (None, "der hund und die katze laufen weit " * 5, "de", None, 3), (5, None, None, None, None), (6, "", "en", "a", 0), (7, " \n ", None, "b", 1)]
    docs = spark.createDataFrame(base + odd + base[:3], "doc_id long, text string, lang string, source string, n_chars long")
    for c in ("h_", "m_", "d_", "r_", "secrets", "size_", "id_lang_pred"):
        docs = docs.withColumn(c, F.lit(c))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, SF))
        if name != "sentencepiece":
            assert docs.columns == columns and docs.where("h_ <> 'h_' or secrets <> 'secrets' or size_ <> 'size_'").count() == 0
        if name == "simhash_dedup":
            assert docs.groupBy("doc_id", "text").count().where("count > 1").count() == 0
    assert docs.count() > 10 and docs.where("not round_trip").count() == 0


def test_kept_row_does_not_hang_on_partitions(spark):
    """Rows of one id and text that differ elsewhere: the same one stays, however the table is dealt."""
    rows = [(1, "some words of one text that repeat here and there", "en", f"s{i}", i) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stage = dict(corpus_pipeline.STAGES)["simhash_dedup"]
    assert stage(spark, docs.repartition(7), SF).collect() == stage(spark, docs.coalesce(1).orderBy(F.desc("n_chars")), SF).collect()


def test_components(spark, monkeypatch):
    """Paths, stars, hubs dealt over tasks, loops and repeats, by union-find."""
    monkeypatch.setattr(graph, "HUB", 16)
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, 200 + i) for i in range(80)] + [(300, 300), (400, 401), (401, 400), (400, 401)] + [(rng.randrange(500, 600), rng.randrange(500, 600)) for _ in range(70)]
    got = {r["node"]: r["root"] for r in graph.connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    root = {x: x for u, v in links if u != v for x in (u, v)}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in links:
        if u != v:
            a, b = sorted((find(u), find(v)))
            root[b] = a
    assert got == {x: find(x) for x in root}
    assert graph.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
