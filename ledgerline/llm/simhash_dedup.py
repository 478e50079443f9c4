"""Near-duplicates by SimHash, with a pigeonring filter before the full Hamming check.

A fingerprint has 64 bits: bit b is 1 if it is set in over half of the XXH64 hashes (seed 42) of the text's shingles.
Two fingerprints link if they differ in at most ``tau`` bits; classes are the connected components of the links.

Candidates.  The 64 bits form a ring of ``m`` segments.  If two fingerprints differ in at most tau bits, some segment
starts a chain in which the first l segments differ in at most l * tau / m bits, for every l.  While that quota is
below 1 the segments agree, so they make an equi-join key (tau 2, m 5: two segments, 26 bits, five keys a fingerprint).
Pairs that meet must also keep the quotas of the longer chains; then comes the full check.

Copies of a fingerprint are one node, so groups of exact copies cost nothing.  A bucket of up to ``BUCKET``
fingerprints is checked pair by pair within its row.  In a larger one pairs would grow with the square, so its
fingerprints are linked exactly another way: each lists the words one bit away (64, and itself); two fingerprints
differ in at most two bits just when their lists meet, and a word is listed by 65 fingerprints at most, which are
linked in a star.  For other tau than 2 large buckets are checked pair by pair, in blocks of ``BLOCK``: exact, but their
time grows with the square of the distinct fingerprints that share a head.

Edge cases: a null or blank text has fingerprint 0 and links like any other.  A text of fewer words than a shingle
holds is one shingle; texts of any length count whole.  A bit that is set in exactly half of the hashes is 0.  Null ids
are passed over in the smallest id; a class of null ids alone has none.  Repeated rows each give a row, an empty table
none.  Extra columns are kept; one called as the result is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, documents, short_batches
from .graph import connected_components

SEED = 42
BUCKET = 64
#: Fingerprints of a large bucket that meet in one group, for other tau than 2.
BLOCK = 4096
CHUNK = 1 << 16


def bits_set(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes (little-endian u64) set each of the 64 bits."""
    return np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)


def majority(counts: np.ndarray, n: int) -> int:
    """The bits set in over half of n hashes, as a signed 64-bit number."""
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<i8")[0])


def fingerprint(text: str | None, width: int = 3) -> int:
    """The fingerprint of a whole text, as a signed 64-bit number."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        own = words[at : min(n, at + CHUNK) + width - 1]
        shingles = zip(*(own[i:] for i in range(width)), strict=False) if len(own) >= width else [own]
        counts += bits_set(np.array([digest(b" ".join(s), SEED) for s in shingles], np.uint64))
    return majority(counts, n)


def with_fingerprints(docs: DataFrame, into: str, width: int = 3) -> DataFrame:
    """``docs`` with the column ``into``: the fingerprint of ``text``."""
    short_batches(docs.sparkSession)

    def run(batch):
        return pa.array([fingerprint(t, width) for t in batch.to_pylist()], pa.int64())

    return docs.withColumn(into, F.arrow_udf(run, "long", F.ArrowUDFType.SCALAR)(F.col("text")))


def segments(m: int) -> list[int]:
    """The masks of the m segments of the ring, from bit 0, as unsigned numbers."""
    ends = [-(-64 * i // m) for i in range(m + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(ends, ends[1:], strict=False)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def chains(tau: int, m: int) -> list[list[tuple[int, int]]]:
    """For each start segment, (mask, quota) of the chains of 1 to m segments."""
    seg = segments(m)
    return [[(sum(seg[(i + j) % m] for j in range(n)), n * tau // m) for n in range(1, m + 1)] for i in range(m)]


def _keeps(d: Column, chain: list[tuple[int, int]]) -> Column:
    """Whether the difference d keeps the quotas of a chain; only the longest chain of each quota needs a test."""
    tests = [(mask, q) for (mask, q), after in zip(chain, [*chain[1:], (0, None)], strict=True) if q != after[1]]
    out = F.lit(True)
    for mask, q in tests:
        out = out & (F.bit_count(d.bitwiseAND(F.lit(_signed(mask)))) <= q)
    return out


def near_pairs(prints: DataFrame, tau: int = 2, m: int = 5, bucket: int = BUCKET) -> DataFrame:
    """Links (u, v) between the distinct fingerprints of ``prints`` (fp long): all pairs, but within large buckets
    stars with the same components."""
    ring = chains(tau, m)
    heads = [next(mask for mask, q in reversed(chain) if q == 0) for chain in ring]
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(_signed(k))).alias("k")) for i, k in enumerate(heads)]))
    met = prints.select("fp", keys.alias("s")).select("fp", "s.i", "s.k")
    sizes = cut(met.groupBy("i", "k").agg(F.count("*").alias("c"), F.min("fp").alias("u"), F.max("fp").alias("v")).where("c > 1"), "buckets")
    near = lambda x, y: F.bit_count(x.bitwiseXOR(y)) <= tau
    passes = lambda i, x, y: F.coalesce(*[F.when(i == j, _keeps(x.bitwiseXOR(y), c)) for j, c in enumerate(ring)]) & near(x, y)
    pairs = sizes.where("c = 2").where(passes(F.col("i"), F.col("u"), F.col("v"))).select("u", "v")
    some = met.join(sizes.where(f"c > 2 and c <= {bucket}").select("i", "k"), ["i", "k"]).groupBy("i", "k").agg(F.array_sort(F.collect_list("fp")).alias("a"))
    inner = lambda x: F.transform(F.filter("a", lambda y: (y > x) & passes(F.col("i"), x, y)), lambda y: F.struct(x.alias("u"), y.alias("v")))
    pairs = pairs.union(some.select(F.explode(F.flatten(F.transform("a", inner))).alias("p")).select("p.u", "p.v"))
    large = sizes.where(f"c > {bucket}").select("i", "k")
    many = met.join(large, ["i", "k"])
    if tau == 2:
        # Members of a bucket agree on its head, so one-bit neighbours are needed outside the head only.
        flips = F.coalesce(*[F.when(F.col("i") == i, F.array(*[F.lit(_signed(1 << b)) for b in range(64) if not k >> b & 1])) for i, k in enumerate(heads)])
        words = many.select("i", "fp", F.explode(F.concat(F.array(F.lit(0).cast("long")), flips)).alias("b")).select("i", "fp", F.col("fp").bitwiseXOR(F.col("b")).alias("w"))
        stars = words.groupBy("i", "w").agg(F.array_sort(F.collect_list("fp")).alias("a")).where("size(a) > 1")
        return pairs.union(stars.select(F.col("a")[0].alias("u"), F.explode(F.slice("a", 2, F.size("a") - 1)).alias("v"))).distinct()
    # Blocks of a large bucket by hash, each met by every fingerprint of the bucket once.
    dealt = many.join(sizes.select("i", "k", F.ceil(F.col("c") / BLOCK).cast("int").alias("salts")), ["i", "k"])
    left = dealt.select("i", "k", F.col("fp").alias("u"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    right = dealt.select("i", "k", F.col("fp").alias("v"), F.pmod(F.xxhash64("fp"), F.col("salts")).cast("int").alias("salt"))
    return pairs.union(left.join(right, ["i", "k", "salt"]).where("u < v").where(near(F.col("u"), F.col("v"))).select("u", "v")).distinct()


def classes(rows: DataFrame, tau: int = 2, m: int = 5) -> DataFrame:
    """``rows`` (id long, fp long) with ``component_id``, the smallest id of the class.  ``rows`` is read repeatedly."""
    prints = rows.groupBy("fp").agg(F.min("id").alias("least"))
    comp = connected_components(near_pairs(prints.select("fp"), tau, m))
    rooted = prints.join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(rooted.select("fp", "root").join(least, "root").select("fp", "component_id"), "fp")


def op10_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint (hex), component_id of every document."""
    rows = with_fingerprints(documents(spark, sf_dir).select(F.col("doc_id").alias("id"), "text"), "fp").select("id", "fp")
    out = classes(cut(rows, "prints"))
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
