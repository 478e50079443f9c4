"""Vector search shared by the two indexes: cells of vectors meet the queries that probe them, in bounded blocks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

#: Vectors, and queries, that meet in one group at most (on average, by hash).
CELL_ROWS = 4096
#: Rows of the score matrix held at once.
SLAB = 1 << 22

HITS = "query_id long, vec_id long, score {}"


def matrix(column) -> np.ndarray:
    """An Arrow list column without nulls as a float64 matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def usable(rows: DataFrame, nonzero: bool, form: Callable = lambda v: v) -> DataFrame:
    """(vec_id, v array<double>): no null, empty or non-finite vector, none of another length than the most frequent
    one; with ``nonzero`` no zero vector.  v in the form ``form``; rows repeated in it count once, before any block's
    best are chosen.  Of several vectors of one vec_id all take part.  Written, as it is read repeatedly."""
    v = F.col("embedding").cast("array<double>")
    good = F.coalesce(F.size("v") > 0, F.lit(False)) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    if nonzero:
        good = good & F.exists("v", lambda x: x != 0)
    out = rows.select("vec_id", v.alias("v")).where("vec_id is not null").where(good)
    dims = out.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    out = out.where(F.size("v") == (dims["d"] if dims else 0))
    return cut(out.select("vec_id", form(F.col("v")).alias("v")).distinct(), "vectors")


def bounded_sample(rows: DataFrame, n: int) -> np.ndarray:
    """At most ``n`` of the vectors, by smallest hash."""
    got = rows.select(F.xxhash64("vec_id", "v").alias("h"), "v").orderBy("h").limit(n).toArrow()
    return matrix(got["v"])


def top_per_query(hits: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = hits.distinct().withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def meet(postings: DataFrame, probes: DataFrame, search: Callable, score_type: str = "double") -> DataFrame:
    """The hits of ``search(query ids, query matrix, vec ids, matrix)`` -> three arrays, over every cell's blocks.

    ``postings`` (cell, vec_id, v), ``probes`` (cell, query_id, q).  A cell of many vectors or queries is dealt into
    blocks; every block of vectors meets every block of queries, so nothing is left out and no group is large.
    """
    def blocks(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("cell").agg(F.ceil(F.count("*") / CELL_ROWS).cast("int").alias(name))

    deal = F.broadcast(blocks(postings, "nv").join(blocks(probes, "nq"), "cell"))  # a row a cell: 16,384 lists, or the annuli of a sample, at most
    spread = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = postings.join(deal, "cell").withColumn("bv", spread("vec_id", "nv")).withColumn("bq", every("nq")).select("cell", "bv", "bq", "vec_id", "v")
    right = probes.join(deal, "cell").withColumn("bq", spread("query_id", "nq")).withColumn("bv", every("nv")).select("cell", "bv", "bq", "query_id", "q")
    kind = pa.int64() if score_type == "long" else pa.float64()
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", kind)])

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return schema.empty_table()
        ids, x, qids, q = a["vec_id"].to_numpy(), matrix(a["v"]), b["query_id"].to_numpy(), matrix(b["q"])
        step, out = max(1, SLAB // len(ids)), []
        for at in range(0, len(qids), step):
            out.append(search(qids[at : at + step], q[at : at + step], ids, x))
        return pa.Table.from_arrays([pa.array(np.concatenate(c), f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    keys = ["cell", "bv", "bq"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, HITS.format(score_type))


def best_of(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int, slack: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's ``k`` best, ties to smaller ids, without the query's own; all where fewer.  With
    ``slack``, all that are within it of the k-th, in no order."""
    scores = np.where(ids[None, :] == own[:, None], -np.inf, scores)
    if scores.shape[1] > 4 * k:
        floor = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k] - (slack or 0)
    else:
        floor = np.full(len(scores), -np.inf)
    rows, cols = np.nonzero((scores >= floor[:, None]) & (scores > -np.inf))
    return (rows, cols) if slack is not None else first_of(rows, cols, scores[rows, cols], ids, k)[:2]


def first_of(rows: np.ndarray, cols: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best of each row, ties to smaller ids."""
    order = np.lexsort((ids[cols], -score, rows))
    rows, cols, score = rows[order], cols[order], score[order]
    keep = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
    return rows[keep], cols[keep], score[keep]
