"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, and what these link.

This is SimHash near-dedup with a pigeonring filter, as ``simhash_dedup``, at a wide threshold.  At a similarity of 0.8
the 64-bit fingerprints of five-word shingles differ in 10 bits on average and in ``TAU`` at most, but for a chance of 2
in a million.  Cut into segments, those 64 bits give no key: so many differences leave none that must agree.  So the
fingerprint is made longer: the hash space of the shingles is the ring, cut into ``m`` segments, and each has a SimHash of
its own, of the shingles that fall into it.

Pigeonring.  Sets of a and b shingles with a similarity of 0.8 differ in at most tau = (a + b) / 9 shingles, which lie
somewhere on the ring; so some segment starts a chain in which the first l segments hold at most l * tau / m of them, for
every l.  Segments without a difference have equal SimHashes, which are the equi-join key.  Pairs that meet must have a
start whose longer chains keep their quotas, told by one bit of each segment's SimHash (two that differ hold at least one
difference, so no near pair is lost); then comes the Hamming check of the whole fingerprints, and the exact similarity (of
64-bit shingle hashes) decides, so no other text is linked.

Rings.  A set of 2^t to 2^(t+1) - 1 shingles has the ring of level t, and that of the level below if near copies may stand
there: near copies share a level.  A ring of sets of ``WHOLE`` shingles and more holds those whose hashes begin with t - 7
zeros, some 128 to 320.  Then tau comes near m or passes it, and a key is no longer certain, but likely: that every segment
with a shingle has a difference has a chance of 1 in a million at a similarity of 0.8, and less for closer pairs.

Groups.  Texts of the same words (ASCII letters in lower case) are one node, so exact copies cost nothing.  In a group of
up to ``SMALL`` nodes all pairs are candidates.  In a larger one each node is first compared with ``CENTRES`` of the group,
which links large groups of near copies.  Large groups that still hold several classes are mostly texts that share a
passage.  Their nodes are joined another way, which is exact: with the shingles of each in order of rarity (among these
nodes, all counted), two sets as similar as that share one of the larger set's first fifth, within the smaller set's
first ninth.  A shared passage stands last in that order, so such texts no longer meet.  Only pairs that differ in class,
fit in size and are near by fingerprint are made rows.  A shingle that decides for more than ``HOT`` nodes marks a family
of texts that are close, yet not all near copies: families are compared whole, in rows of two blocks of at most ``BLOCK``
nodes with their shingles, from which only the links come out.  Nothing is capped.

Edge cases: texts without a word, null ones too, are one node.  A text of fewer words than a shingle is one shingle; sets
of fewer than ``FEW`` shingles skip the fingerprints, whose bits then vary more.  Texts of any length count whole.
Repeated rows are one node, an empty table has none.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, drop, short_batches
from .graph import connected_components
from .simhash_dedup import bits_set, majority

WIDTH = 5
LEAST = 0.8
CENTRES = 3
#: Nodes of a group whose pairs are all candidates; nodes for which a shingle decides before they are a family; nodes and
#: shingles of a family that meet in one row, a side.
SMALL, HOT, BLOCK, BLOCK_SHINGLES = 16, 64, 128, 1 << 20
#: Bits that the fingerprints of near copies may differ in, and the least set they are asked for.
TAU, FEW = 24, 20
SEED = 42
CHUNK = 1 << 12
#: The least set of which a ring holds a sample, its level, and by how many deviations a sample's tau passes its mean.
WHOLE, SAMPLED, DEVIATIONS = 256, 8, 6
KEYS = pa.struct([("i", pa.int32()), ("k", pa.int64()), ("ring", pa.int64())])


def shingles(words: list[bytes]) -> np.ndarray:
    """The distinct hashes of the shingles of ``words``, sorted."""
    digest = xxhash.xxh64_intdigest
    own = zip(*(words[i:] for i in range(WIDTH)), strict=False) if len(words) >= WIDTH else [words]
    return np.unique(np.array([digest(b" ".join(s), SEED) for s in own], np.uint64))


def level(n: int) -> int:
    return n.bit_length() - 1


def segments_of(t: int) -> int:
    """The number m of segments in the ring of level t."""
    return 64 if t < 4 else 32 if t < 7 else 48


def ring(h: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The segments of level t that hold shingles of the sorted hashes ``h``, their SimHashes, and for each the ring's bits:
    one of every SimHash, at the place of its segment."""
    m, zeros = segments_of(t), max(0, t + 1 - SAMPLED)
    own = h[: np.searchsorted(h, np.uint64(1 << (64 - zeros)))] if zeros else h
    at = (own & np.uint64(0xFFFFFFFF)) * np.uint64(m) >> np.uint64(32)
    order = np.argsort(at, kind="stable")
    held, first, sizes = np.unique(at[order], return_index=True, return_counts=True)
    if not len(held):
        return held, held, held
    bits = np.unpackbits(own[order].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    prints = np.packbits(np.add.reduceat(bits, first, axis=0, dtype=np.int32) * 2 > sizes[:, None], axis=1, bitorder="little").view("<u8")[:, 0]
    odd = np.bitwise_count(prints).astype(np.uint64) & np.uint64(1)
    return held, prints, np.full(len(held), np.bitwise_or.reduce(odd << held), np.uint64)


def ring_keys(h: np.ndarray) -> np.ndarray:
    """i (level * 64 + segment), k (the segment's SimHash) and the ring's bits of each segment that holds a shingle, for the
    set's level and that of its smallest near copies; as columns."""
    own = [(t, *ring(h, t)) for t in {level(len(h)), level(max(1, math.ceil(LEAST * len(h) - 1e-9)))}]
    return np.concatenate([np.stack([held + np.uint64(64 * t), prints, bits]) for t, held, prints, bits in own], axis=1)


def _words(text: str | None) -> list[bytes]:
    return text.encode().lower().split() if text else []


def with_keys(docs: DataFrame, into: str) -> DataFrame:
    """``docs`` with ``into``: struct<node: of the words, n: distinct shingles, fp: their fingerprint, keys: of the rings>
    of ``text``."""
    short_batches(docs.sparkSession)

    def run(batch):
        nodes, sizes, prints, keys = [], [], [], []
        for t in batch.to_pylist():
            w = _words(t)
            h = shingles(w)
            nodes.append(xxhash.xxh64_intdigest(b" ".join(w), SEED))
            sizes.append(len(h))
            prints.append(majority(sum(bits_set(h[at : at + CHUNK]) for at in range(0, len(h), CHUNK)), len(h)))
            keys.append(ring_keys(h))
        i, k, bits = np.concatenate(keys, axis=1).view(np.int64) if keys else np.empty((3, 0), np.int64)
        ends = np.cumsum([0, *(x.shape[1] for x in keys)], dtype=np.int32)
        keys = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(i.astype(np.int32)), pa.array(k), pa.array(bits)], fields=list(KEYS)))
        nodes = pa.array(np.array(nodes, np.uint64).view(np.int64), pa.int64())
        return pa.StructArray.from_arrays([nodes, pa.array(sizes, pa.int32()), pa.array(prints, pa.int64()), keys], ["node", "n", "fp", "keys"])

    return docs.withColumn(into, F.arrow_udf(run, "node long, n int, fp long, keys array<struct<i: int, k: long, ring: long>>", F.ArrowUDFType.SCALAR)(F.col("text")))


def _sets(texts: DataFrame) -> DataFrame:
    """(node, s): the shingle hashes of ``texts`` (node, text)."""

    def run(batch):
        return pa.array([shingles(_words(t)).view(np.int64) for t in batch.to_pylist()], pa.list_(pa.int64()))

    return texts.select("node", F.arrow_udf(run, "array<long>", F.ArrowUDFType.SCALAR)(F.col("text")).alias("s"))


def _may(x: Column, y: Column) -> Column:
    """Whether two nodes (structs with n, fp) may be near, by size and fingerprint."""
    least, most = F.least(x["n"], y["n"]), F.greatest(x["n"], y["n"])
    return (least >= LEAST * most - 1e-9) & ((least < FEW) | (F.bit_count(x["fp"].bitwiseXOR(y["fp"])) <= TAU))


def _keeps(t: Column, x: Column, y: Column) -> Column:
    """Whether some start in the ring of two nodes (structs with n, ring) that meet at level ``t`` keeps the quotas of its
    chains: of one segment, a quarter, a half and all of the ring."""
    d = x["ring"].bitwiseXOR(y["ring"])
    mean = (x["n"] + y["n"]) * ((1 - LEAST) / (1 + LEAST)) / F.pow(F.lit(2.0), F.greatest(F.lit(0), t + 1 - SAMPLED))
    tau = F.when(t < SAMPLED, mean).otherwise(mean + DEVIATIONS * F.sqrt(mean)) + 1e-9

    def chains(m: int) -> Column:
        turned = lambda s: F.call_function("shiftrightunsigned", d, s).bitwiseOR(F.call_function("shiftleft", d, m - s))
        low = lambda w, n: F.bit_count(w.bitwiseAND(F.lit((1 << n) - 1 if n < 64 else -1))) <= F.floor(tau * (n / m))
        some = F.exists(F.sequence(F.lit(0), F.lit(m - 1)), lambda s: low(turned(s), 1) & low(turned(s), m // 4) & low(turned(s), m // 2))
        # Half of the bits differ at most by chance, so wide quotas need no look at the chains.
        return (tau >= m) | (low(d, m) & some)

    return F.when(t < 4, chains(64)).when(t < 7, chains(32)).otherwise(chains(48))


def _ordered(x: Column, y: Column) -> list[Column]:
    return [F.least(x["node"], y["node"]).alias("u"), F.greatest(x["node"], y["node"]).alias("v")]


def _pairs(table: DataFrame, a: str, b: str, ok: Callable[[Column, Column], Column]) -> DataFrame:
    """(u, v) of the pairs from the arrays of nodes ``a`` and ``b`` of each row that are ``ok``; if both are one array, each
    pair once."""
    if a == b:
        inner = lambda x: F.filter(a, lambda y: (y["node"] > x["node"]) & ok(x, y))
    else:
        inner = lambda x: F.filter(b, lambda y: ok(x, y))
    found = F.flatten(F.transform(a, lambda x: F.transform(inner(x), lambda y: F.struct(*_ordered(x, y)))))
    return table.select(F.explode(found).alias("p")).select("p.u", "p.v")


def _stars(large: DataFrame, centres: DataFrame, near: Callable[[Column, Column, Column], Column]) -> DataFrame:
    """(u, v) of the nodes x of ``large`` (i, k, x) and those of their ``centres`` (i, k, centres) that are ``near``.  Similar
    groups have the same centres, and a node meets them in most segments of its ring: it is compared with each once a level."""
    met = large.join(centres, ["i", "k"]).groupBy(F.shiftright("i", 6).alias("t"), "x").agg(F.array_distinct(F.flatten(F.collect_list("centres"))).alias("m"))
    each = met.select("t", "x", F.explode("m").alias("y")).where("x.node <> y.node")
    return each.where(near(F.col("t"), F.col("x"), F.col("y"))).select(*_ordered(F.col("x"), F.col("y")))


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs`` (u, v) that are similar enough."""
    a, b = sets.toDF("u", "a"), sets.toDF("v", "b")
    both = pairs.distinct().join(a, "u").join(b, "v").withColumn("c", F.size(F.array_intersect("a", "b")))
    return both.where(F.col("c") >= LEAST * (F.size("a") + F.size("b") - F.col("c")) - 1e-9).select("u", "v")


def _rare_first(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """(t, x): the shingles t that decide for each of ``nodes`` (node, n, fp, root): of its first fifth by rarity, those that
    another node holds; x the node with ``short``, whether t stands in its first ninth."""
    tokens = sets.join(nodes, "node").select("node", "n", "fp", "root", F.explode("s").alias("t"))
    common = tokens.groupBy("t").agg(F.count("*").alias("df")).where("df > 1")
    held = tokens.join(common, "t").groupBy("node", "n", "fp", "root").agg(F.array_sort(F.collect_list(F.struct("df", "t"))).alias("own"))
    # Shingles of one node alone come first; so many are left of the first fifth, and of the first ninth.
    alone = F.col("n") - F.size("own")
    left = lambda share: F.greatest(F.lit(0), F.col("n") - F.ceil(share * F.col("n") - 1e-9) + 1 - alone).cast("int")
    held = held.withColumns({"far": left(LEAST), "near": left(2 * LEAST / (1 + LEAST))}).where("far > 0")
    each = held.select("node", "n", "fp", "root", "near", F.posexplode(F.expr("slice(own, 1, far)")).alias("i", "o"))
    return each.select("o.t", F.struct("node", "n", "fp", "root", (F.col("i") < F.col("near")).alias("short")).alias("x"))


def _prefix_pairs(met: DataFrame, groups: DataFrame) -> DataFrame:
    """(u, v) of the pairs of different roots that may be near and share a deciding shingle of few nodes."""
    few = met.join(groups.where(f"c <= {HOT}").select("t"), "t").groupBy("t").agg(F.collect_list("x").alias("m"))
    # The smaller set's shingle must stand in its first ninth.
    shorter = lambda x, y: F.when(x["n"] < y["n"], x["short"]).when(y["n"] < x["n"], y["short"]).otherwise(x["short"] | y["short"])
    return _pairs(few, "m", "m", lambda x, y: (x["root"] != y["root"]) & shorter(x, y) & _may(x, y))


def _family_links(met: DataFrame, groups: DataFrame, sets: DataFrame) -> DataFrame:
    """(u, v) of all links of different roots within the families that shingles of many nodes make."""
    hot = met.join(groups.where(f"c > {HOT}").select("t", "first"), "t").select(F.col("x.node").alias("node"), "first", F.struct("x.n", "x.fp", "x.root").alias("x"))
    hot = cut(hot, "hot")
    family = connected_components(hot.select(F.col("node").alias("u"), F.col("first").alias("v"))).withColumnRenamed("root", "family")
    whole = hot.groupBy("node").agg(F.min("x").alias("x")).join(family, "node").join(sets, "node")
    whole = cut(whole.select("family", F.struct("node", "x.n", "x.fp", "x.root", "s").alias("x")), "family")
    size = whole.groupBy("family").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("x.n") / BLOCK_SHINGLES)).cast("int").alias("k"))
    dealt = whole.join(size, "family").withColumn("b", F.pmod(F.xxhash64("x.node"), F.col("k")).cast("int"))
    blocks = cut(dealt.groupBy("family", "k", "b").agg(F.collect_list("x").alias("m")), "blocks")
    alike = lambda x, y: F.size(F.array_intersect(x["s"], y["s"])) * (1 + LEAST) >= LEAST * (x["n"] + y["n"]) - 1e-9
    ok = lambda x, y: (x["root"] != y["root"]) & F.when(_may(x, y), alike(x, y)).otherwise(False)
    across = blocks.where("k > 1").join(blocks.select("family", F.col("b").alias("b2"), F.col("m").alias("m2")), "family").where("b < b2")
    return _pairs(blocks, "m", "m", ok).union(_pairs(across, "m", "m2", ok))


def roots(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, root) of every node of ``rows`` (h long, node long, n int, fp long, keys array<struct<i int, k long, ring long>>) that has near copies.
    ``docs`` (text) holds the texts, h their xxhash64.  Both are read repeatedly."""
    nodes = rows.groupBy("node").agg(F.min(F.struct("h", "n", "fp", "keys")).alias("k")).select("node", "k.h", "k.n", "k.fp", "k.keys")
    nodes = cut(nodes, "nodes")
    each = nodes.select("node", "n", "fp", F.explode("keys").alias("e")).select("e.i", "e.k", F.struct("node", "n", "fp", "e.ring").alias("x"))
    sizes = cut(each.groupBy("i", "k").agg(F.count("*").alias("c")).where("c > 1"), "sizes")
    met = cut(each.join(sizes, ["i", "k"]), "met")
    wanted = nodes.join(met.select("x.node").distinct(), "node").select("node", "h")
    texts = docs.select(F.xxhash64("text").alias("h"), "text").join(wanted, "h").dropDuplicates(["node"])
    sets = cut(_sets(texts), "shingles")
    small = met.where(f"c <= {SMALL}").groupBy("i", "k").agg(F.collect_list("x").alias("m"))
    large = met.where(f"c > {SMALL}").select("i", "k", "x")
    centres = large.groupBy("i", "k").agg(F.array_distinct(F.array(*[F.min_by("x", F.xxhash64("x.node", F.lit(c))) for c in range(CENTRES)])).alias("centres"))
    near = lambda t, x, y: _may(x, y) & _keeps(t, x, y)
    links = cut(_confirmed(_pairs(small, "m", "m", lambda x, y: near(F.shiftright("i", 6), x, y)).union(_stars(large, centres, near)), sets), "stars")
    first = cut(connected_components(links), "first")
    # Nodes of the large groups that hold several classes by now.
    parted = large.select("i", "k", "x.*").join(first, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = parted.groupBy("i", "k").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("i", "k")
    rest = cut(parted.join(several, ["i", "k"]).select("node", "n", "fp", "root").distinct(), "rest")
    deciding = cut(_rare_first(rest, sets), "deciding")
    groups = deciding.groupBy("t").agg(F.count("*").alias("c"), F.min("x.root").alias("lo"), F.max("x.root").alias("hi"), F.min("x.node").alias("first")).where("lo < hi")
    groups = cut(groups, "groups")
    more = cut(_confirmed(_prefix_pairs(deciding, groups), sets).union(_family_links(deciding, groups, sets)), "more")
    out = cut(connected_components(links.union(more)), "roots")
    drop(nodes, sizes, met, sets, links, first, rest, deciding, groups, more)
    return out
