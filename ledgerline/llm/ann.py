"""Approximate nearest neighbours by cosine: balanced posting lists.

Centroids come from a bounded sample, by splitting it in two at the median of its main direction until the parts are
small: equal parts, so balanced lists.  Every vector goes to the list of its nearest centroid and, near a border, to
more (``REPLICAS`` at most, within ``SPREAD`` of the nearest distance, and none that lies nearer to a list already
chosen than to the vector).  A query finds its nearest centroids by best-first search in an in-memory graph of them,
and reads the lists within ``RATIO`` of the nearest distance, at most ``PROBES`` or ``SHARE`` of all lists, whichever
is more: a fixed number would lose recall as lists grow in number.  Candidates get the exact cosine of
the original vectors in double precision, and are ranked by it.

The number of lists follows that of the rows, a list for ``LIST_ROWS``, up to ``MOST_LISTS``: so many centroids fit a
worker's memory with their graph.  Beyond two million rows lists grow instead.  Every row is indexed; only the centroids
are fitted on a sample (``SAMPLE`` rows a list).  Lists of any size are dealt into blocks (``vectors.meet``), so a very
common vector fills no task.

Edge cases: null, empty, zero or non-finite vectors, null ids and vectors of another length than most take no part.
Ties go to the smaller vec_id.  Fewer candidates than k give them all, an empty table none.  A row repeated as a whole
counts once, and never as its own neighbour.  Extra columns play no part.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import cut, embeddings, short_batches
from .vectors import best_of, bounded_sample, first_of, matrix, meet, top_per_query, usable

#: Rows of the sample for each list.
SAMPLE = 8
LEAST_SAMPLE = 16_384
LIST_ROWS = 128
MOST_LISTS = 16_384
#: Vectors, or centroids, that are compared with all centroids at once.
ROWS = 1024
#: How far a product of unit vectors may be from their exact cosine.
SLACK = 1e-9
REPLICAS, SPREAD = 6, 0.25
RATIO, PROBES, SHARE = 1.25, 48, 3 / 64
DEGREE, BEAM = 24, 128


def unit(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x).max(1, keepdims=True)
    x = x / scale
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def balanced_centroids(x: np.ndarray, n: int) -> np.ndarray:
    """``n`` centroids of equal parts of the sample ``x``, without repeats."""
    parts = [x]
    while len(parts) < n and max(map(len, parts)) > 1:
        parts.sort(key=len)
        own = parts.pop()
        d = own - own.mean(0)
        axis = d[np.argmax((d * d).sum(1))]
        for _ in range(8):
            axis = d.T @ (d @ axis)
            size = np.sqrt(axis @ axis)
            if size == 0:
                break
            axis /= size
        order = np.argsort(d @ axis, kind="stable")
        parts += [own[order[: len(own) // 2]], own[order[len(own) // 2 :]]]
    means = np.array([p.mean(0) for p in parts])
    # A few rounds of nearest-centroid means sharpen the parts without moving their sizes far.
    for _ in range(3):
        half = (means * means).sum(1) / 2
        near = np.concatenate([np.argmax(x[at : at + ROWS] @ means.T - half, axis=1) for at in range(0, len(x), ROWS)])
        sums, counts = np.zeros_like(means), np.bincount(near, minlength=len(means))
        np.add.at(sums, near, x)
        means = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], means)
    return np.unique(means.round(12), axis=0)


class CentroidGraph:
    """Nearest-neighbour graph of the centroids, with best-first search."""

    def __init__(self, centroids: np.ndarray):
        self.c = centroids
        self.sq = (centroids * centroids).sum(1)
        n = len(centroids)
        self.probes = max(PROBES, int(n * SHARE))
        self.beam = max(BEAM, 2 * self.probes)
        near, degree = np.zeros((n, min(DEGREE, n - 1)), np.int64), min(DEGREE, n - 1)
        for at in range(0, n if degree else 0, ROWS):
            far = self.sq[None, :] - 2 * centroids[at : at + ROWS] @ centroids.T
            far[np.arange(len(far)), at + np.arange(len(far))] = np.inf
            few = np.argpartition(far, degree - 1, axis=1)[:, :degree]
            order = np.lexsort((few, np.take_along_axis(far, few, 1)), axis=1)
            near[at : at + ROWS] = np.take_along_axis(few, order, 1)
        links: list[set[int]] = [set(map(int, row)) for row in near]
        for i, row in enumerate(near):
            for j in row:
                links[int(j)].add(i)
        for i in range(n):  # a ring makes every centroid reachable
            links[i] |= {(i + 1) % n, (i - 1) % n} - {i}
        self.links = [np.array(sorted(s), np.int64) for s in links]
        self.entries = np.unique(np.linspace(0, n - 1, min(n, 16)).astype(np.int64))

    def search(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest centroids found and their squared distances, nearest first."""
        far = lambda ids: (self.sq[ids] - 2 * self.c[ids] @ q + q @ q).tolist()
        seen = set(self.entries.tolist())
        todo = list(zip(far(self.entries), self.entries.tolist(), strict=True))
        heapq.heapify(todo)
        beam, best = self.beam, [(-d, i) for d, i in todo]
        heapq.heapify(best)
        while todo:
            d, i = heapq.heappop(todo)
            if len(best) >= beam and d > -best[0][0]:
                break
            new = [j for j in self.links[i].tolist() if j not in seen]
            if new:
                seen.update(new)
                for d, j in zip(far(np.array(new)), new, strict=True):
                    if len(best) < beam or d < -best[0][0]:
                        heapq.heappush(todo, (d, j))
                        heapq.heappush(best, (-d, j))
                        if len(best) > beam:
                            heapq.heappop(best)
        best.sort(key=lambda x: (-x[0], x[1]))
        return np.array([i for _, i in best], np.int64), np.array([max(0.0, -d) for d, _ in best])

    def lists(self, q: np.ndarray) -> np.ndarray:
        ids, d = self.search(q)
        return ids[np.sqrt(d) <= RATIO * np.sqrt(d[0]) + 1e-12][: self.probes]


def assign(c: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, list) pairs: the nearest centroid of every vector, and the replicas near borders."""
    if len(x) > ROWS:
        parts = [assign(c, x[at : at + ROWS]) for at in range(0, len(x), ROWS)]
        return np.concatenate([r + i * ROWS for i, (r, _) in enumerate(parts)]), np.concatenate([p for _, p in parts])
    sq = (c * c).sum(1)
    d = np.sqrt(np.maximum(0, sq[None, :] - 2 * x @ c.T + (x * x).sum(1)[:, None]))
    m = min(REPLICAS * 2, len(c))
    near = np.argpartition(d, m - 1, axis=1)[:, :m]
    dist = np.take_along_axis(d, near, 1)
    order = np.argsort(dist, axis=1, kind="stable")
    near, dist = np.take_along_axis(near, order, 1), np.take_along_axis(dist, order, 1)
    taken = np.zeros(near.shape, bool)
    taken[:, 0] = True
    own = c[near]  # the few centroids that each vector may go to
    between = np.sqrt(np.maximum(0, sq[near][:, :, None] + sq[near][:, None, :] - 2 * own @ own.transpose(0, 2, 1)))
    for j in range(1, m):
        ok = (dist[:, j] <= (1 + SPREAD) * dist[:, 0]) & (taken.sum(1) < REPLICAS)
        for i in range(j):
            ok &= ~taken[:, i] | (between[:, i, j] > 0.5 * dist[:, j])
        taken[:, j] = ok
    rows, cols = np.nonzero(taken)
    return rows, near[rows, cols]


def cosine_search(k: int):
    def search(qids, q, ids, x):
        qu, xu = unit(q), unit(x)
        rows, cols = best_of(qu @ xu.T, ids, qids, k, SLACK)
        a, b = q[rows], x[cols]
        score = (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))
        rows, cols, score = first_of(rows, cols, score, ids, k)
        return qids[rows], ids[cols], score

    return search


def nearest(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found in ``rows`` for each of ``queries`` (both vec_id, v)."""
    spark = rows.sparkSession
    short_batches(spark, 4096)
    n = rows.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    wanted = max(1, min(MOST_LISTS, n // LIST_ROWS))
    sample = bounded_sample(rows, max(LEAST_SAMPLE, SAMPLE * wanted))
    centroids = balanced_centroids(unit(sample), min(wanted, max(1, len(sample) // SAMPLE)))
    shared = spark.sparkContext.broadcast(centroids)

    def index(batches):
        c = shared.value
        for batch in batches:
            if batch.num_rows:
                which, lists = assign(c, unit(matrix(batch.column(1))))
                at = pa.array(which)
                yield pa.RecordBatch.from_arrays([pa.array(lists, pa.int64()), batch.column(0).take(at), batch.column(1).take(at)], names=["cell", "vec_id", "v"])

    def probe(batches):
        graph = CentroidGraph(shared.value)
        for batch in batches:
            if batch.num_rows:
                found = [graph.lists(q) for q in unit(matrix(batch.column(1)))]
                at = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found), pa.int64()), batch.column(0).take(at), batch.column(1).take(at)], names=["cell", "query_id", "q"])

    postings = cut(rows.select("vec_id", "v").mapInArrow(index, "cell long, vec_id long, v array<double>"), "postings")
    probes = cut(queries.select("vec_id", "v").mapInArrow(probe, "cell long, query_id long, q array<double>"), "probes")
    return top_per_query(meet(postings, probes, cosine_search(k)), k)


def op4_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: the 5 nearest found of every vector whose id is divisible by 50."""
    rows = usable(embeddings(spark, sf_dir), nonzero=True)
    return nearest(rows, rows.where("vec_id % 50 = 0"), 5)
