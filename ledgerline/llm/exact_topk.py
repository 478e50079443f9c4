"""Exact top-k by integer inner product: a pivot-distance index.

Components become integers, floor(1024 x).  With M the largest norm, a vector x gets one more component,
sqrt(M^2 - |x|^2), a query 0: then |q' - x'|^2 = |q|^2 + M^2 - 2 <q, x>, so the largest inner products are the least
distances.  Every vector is keyed by its nearest pivot and its distance from it, and the distances of a pivot are cut
into annuli.  For a query at distance d from a pivot, no vector of the annulus [a, b] is nearer than
max(0, a - d, d - b) (triangle inequality).

A search expands annuli in the order of that bound, in waves: the first wave's k-th score gives a radius, and an
annulus whose bound exceeds the radius is passed over; so the result is exact.  Bounds carry a margin of 1e-6 of the
scale against rounding.  The pivots and the annulus borders come from a bounded sample (``SAMPLE``); every row is
indexed, and the annuli's least and largest distances are those of all rows.

Edge cases: vectors null, empty or holding null or non-finite components, null ids and vectors of another length than
most take no part; zero vectors do.  Ties go to the smaller vec_id.  Fewer candidates than k give them all, an empty table
none.  A row repeated as a whole counts once, and never as its own neighbour.  Extra columns play no part.  Inner
products must fit 53 bits: larger vectors raise an error, since their order could not be told exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ann import balanced_centroids
from .common import cut, embeddings, short_batches
from .vectors import best_of, bounded_sample, matrix, meet, top_per_query, usable

SCALE = 1024
SAMPLE = 8192
PIVOTS = 32
ANNULUS_ROWS = 1024
#: Annuli that each wave adds for a query; the last takes all that the radius leaves.
WAVES = (2, 8, None)
MARGIN = 1e-6
MOST_SQUARE = 1 << 53


def quantised(rows: DataFrame) -> DataFrame:
    """(vec_id, v) with v the integers floor(1024 x), as doubles."""
    return usable(rows, nonzero=False, form=lambda v: F.transform(v, lambda x: F.floor(x * SCALE).cast("double")))


def _distances(x: np.ndarray, extra: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    a = np.concatenate([x, extra[:, None]], axis=1)
    return np.sqrt(np.maximum(0, (a * a).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * a @ pivots.T))


def search_inner(k: int):
    def search(qids, q, ids, x):
        scores = q @ x.T  # sums of integers below 2^53: exact
        rows, cols = best_of(scores, ids, qids, k)
        return qids[rows], ids[cols], scores[rows, cols].astype(np.int64)

    return search


def top_inner(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` largest inner products among ``rows`` (both vec_id, v)."""
    spark = rows.sparkSession
    short_batches(spark, 4096)
    norm2 = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    top = rows.agg(F.max(norm2).alias("m"), F.count("*").alias("n")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not top["n"]:
        return empty
    m2, n = float(top["m"]), int(top["n"])
    if m2 >= MOST_SQUARE:  # no inner product exceeds the largest square of a norm
        raise ValueError(f"vectors of a squared norm of {m2:g} have inner products beyond {MOST_SQUARE}")
    sample = bounded_sample(rows, SAMPLE)
    lift = lambda x: np.sqrt(np.maximum(0, m2 - (x * x).sum(1)))
    lifted = np.concatenate([sample, lift(sample)[:, None]], axis=1)
    pivots = balanced_centroids(lifted, min(PIVOTS, len(sample)))
    own = _distances(sample, lift(sample), pivots)
    near = own.argmin(1)
    edges = []
    for p in range(len(pivots)):
        d = np.sort(own[near == p, p])
        rings = int(max(1, min(len(d) // 2, round(n * len(d) / len(sample) / ANNULUS_ROWS))))
        edges.append(np.unique(np.quantile(d, np.linspace(0, 1, rings + 1)[1:-1])) if len(d) and rings > 1 else np.zeros(0))
    first = np.concatenate([[0], np.cumsum([len(e) + 1 for e in edges])])
    shared = spark.sparkContext.broadcast((pivots, edges, first))

    def index(batches):
        pivots, edges, first = shared.value
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(1))
                d = _distances(x, lift(x), pivots)
                p = d.argmin(1)
                d = d[np.arange(len(p)), p]
                cell = np.array([first[i] + np.searchsorted(edges[i], r, side="right") for i, r in zip(p, d, strict=True)], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(d), batch.column(0), batch.column(1)], names=["cell", "d", "vec_id", "v"])

    postings = cut(rows.select("vec_id", "v").mapInArrow(index, "cell long, d double, vec_id long, v array<double>"), "annuli")
    stats = postings.groupBy("cell").agg(F.min("d"), F.max("d")).collect()  # as many as the sample has borders, at most
    cells = np.array([r[0] for r in stats])
    low, high = np.array([r[1] for r in stats]), np.array([r[2] for r in stats])
    of = np.searchsorted(first, cells, side="right") - 1
    ring = spark.sparkContext.broadcast((cells, low, high, of))

    def probe(wave):
        skip = sum(x for x in WAVES[:wave] if x)
        take = WAVES[wave]

        def run(batches):
            pivots, _, _ = shared.value
            cells, low, high, of = ring.value
            for batch in batches:
                if batch.num_rows:
                    q = matrix(batch.column(1))
                    d = _distances(q, np.zeros(len(q)), pivots)[:, of]
                    bound = np.maximum(0, np.maximum(low - d, d - high))
                    order = np.lexsort((np.broadcast_to(np.abs(d - (low + high) / 2), bound.shape), bound), axis=1)
                    kth = np.array([-np.inf if s is None else s for s in batch.column(2).to_pylist()])
                    radius = np.sqrt(np.maximum(0, (q * q).sum(1) + m2 - 2 * kth))
                    rank = np.empty_like(order)
                    np.put_along_axis(rank, order, np.broadcast_to(np.arange(len(cells)), order.shape), 1)
                    keep = (rank >= skip) & (bound <= radius[:, None] + MARGIN * np.sqrt(m2 + (q * q).sum(1))[:, None])
                    if take:
                        keep &= rank < skip + take
                    i, j = np.nonzero(keep)
                    at = pa.array(i)
                    yield pa.RecordBatch.from_arrays([pa.array(cells[j]), batch.column(0).take(at), batch.column(1).take(at)], names=["cell", "query_id", "q"])

        return run

    asked = queries.select(F.col("vec_id").alias("query_id"), "v").withColumn("kth", F.lit(None).cast("double"))
    hits = None
    for wave in range(len(WAVES)):
        probes = cut(asked.mapInArrow(probe(wave), "cell long, query_id long, q array<double>"), "expand")
        found = meet(postings.select("cell", "vec_id", "v"), probes, search_inner(k), "long")
        best = top_per_query(found if hits is None else hits.select("query_id", "vec_id", "score").union(found), k)
        if wave == len(WAVES) - 1:
            return best
        hits = cut(best, "hits")
        kth = hits.where(F.col("rank") == k).select("query_id", F.col("score").cast("double").alias("kth"))
        asked = queries.select(F.col("vec_id").alias("query_id"), "v").join(kth, "query_id", "left").select("query_id", "v", "kth")
    return empty


def op8_exact_topk(spark, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: the 10 largest inner products of every vector whose id is divisible by 100."""
    rows = quantised(embeddings(spark, sf_dir))
    return top_inner(rows, rows.where("vec_id % 100 = 0"), 10)
