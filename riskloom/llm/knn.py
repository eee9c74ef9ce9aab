"""Exact nearest neighbours by a block matrix join of int8 tiles.

Query rows are dealt into blocks and all rows into stripes; each (block,
stripe) pair is one tile and one task-sized group. Inside a tile every vector
is scaled to int8; one integer product of the two matrices gives all
approximate distances, and the norms of the rounding errors bound how far
each is from the true one (triangle inequality). Only pairs whose lower bound
does not exceed the tile's k-th smallest upper bound can be among the k
nearest; they are recomputed in double precision on the original vectors.
The tiles' short lists are merged per query. The result is exact.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import blocks_for
from riskloom.session import ship_package

QUERY_BLOCK = 1024  # query rows in a tile
STRIPE = 8192       # candidate rows in a tile
STEP = 256          # query rows whose distances to a stripe are held at once
FOUND = "query_id long, vec_id long, score double"


def _int8(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scales, squared norms of the coded vectors, norms of the rounding errors."""
    scale = np.abs(x).max(axis=1) / 127.0
    with np.errstate(divide="ignore", invalid="ignore"):
        codes = np.where(scale[:, None] > 0, np.rint(x / scale[:, None]), 0.0)
    codes = np.nan_to_num(codes).clip(-127, 127).astype(np.int8)
    back = codes * scale[:, None]
    return codes, scale, (back * back).sum(axis=1), np.sqrt(((x - back) ** 2).sum(axis=1))


def _distances(c: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean distances; squares that leave the range of a double are taken of scaled differences."""
    with np.errstate(over="ignore", invalid="ignore", under="ignore"):
        gap = c - q
        out = np.sqrt((gap ** 2).sum(axis=1))
        odd = ~np.isfinite(out) | ((out < 1e-140) & (gap != 0).any(axis=1))
        if odd.any():
            most = np.abs(gap[odd]).max(axis=1)
            out[odd] = np.where(np.isfinite(most), most * np.sqrt(((gap[odd] / most[:, None]) ** 2).sum(axis=1)), np.inf)
    return out


def _tile(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int):
    """(query, candidate, distance) of the k nearest distinct ids in the tile."""
    # float products of int8 codes are exact integers up to 2**24 / 127**2 components
    exact = np.float32 if q.shape[1] <= 1040 else np.float64
    cc, cs, cn, ce = _int8(c)
    cc = cc.astype(exact)
    repeats = int(np.unique(c_ids, return_counts=True)[1].max())
    for at in range(0, len(q), STEP):
        ids, part = q_ids[at:at + STEP], q[at:at + STEP]
        qc, qs, qn, qe = _int8(part)
        dots = (qc.astype(exact) @ cc.T).astype(np.float64)
        own = ids[:, None] == c_ids
        with np.errstate(over="ignore", invalid="ignore"):
            near = np.sqrt(np.maximum(qn[:, None] + cn - 2.0 * qs[:, None] * cs * dots, 0.0))
            # besides the errors of coding, the rounding of these sums themselves
            slack = qe[:, None] + ce + 1e-6 * (np.sqrt(qn)[:, None] + np.sqrt(cn))
            high = np.where(own, np.inf, near + slack)
            high[np.isnan(high)] = np.inf
            kth = min(k * repeats, len(c_ids)) - 1
            bound = np.partition(high, kth, axis=1)[:, kth]
            # sums beyond the range of a double bound nothing: those pairs are recomputed
            alive = ~(near - slack > bound[:, None]) & ~own
        for i in range(len(part)):
            rows = np.flatnonzero(alive[i])
            true = _distances(c[rows], part[i])
            best: dict[int, float] = {}
            for score, vec in zip(true.tolist(), c_ids[rows].tolist()):
                if score < best.get(vec, np.inf):
                    best[vec] = score
            for score, vec in heapq.nsmallest(k, ((s, v) for v, s in best.items())):
                yield int(ids[i]), vec, score


def _tiles(k: int):
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int, float]] = []
        q_dim, c_dim = queries["vec"].map(len), rows["vec"].map(len)
        for dim in q_dim.unique():  # vectors of unlike length are not compared
            some_q, some_c = queries[q_dim == dim], rows[c_dim == dim]
            if len(some_c):
                found += _tile(some_q["id"].to_numpy(), np.stack(some_q["vec"].to_numpy()).astype(np.float64),
                               some_c["id"].to_numpy(), np.stack(some_c["vec"].to_numpy()).astype(np.float64), k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"})
    return run


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Distinct (id, vec) rows that take part in a search.

    Out: a null id; a null, empty or all-zero vector; one holding a null or
    non-finite component.
    """
    vec = F.col(vec_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.col("id").isNotNull() & F.col("vec").isNotNull() & ~F.coalesce(bad, F.lit(True))
                       & F.exists("vec", lambda x: x != 0)).distinct()


def nearest(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 10,
            query_every: int = 100, query_block: int = QUERY_BLOCK, stripe: int = STRIPE) -> DataFrame:
    """The k nearest other rows of each row whose id is divisible by ``query_every``.

    Columns ``query_id, rank, vec_id, score``; Euclidean distance in double
    precision, ties to the smaller id, all candidates if there are fewer than
    k. Rows that share an id are one item with several vectors: its distance
    is the smallest. Equal rows count once. No usable row: no result. A distance
    beyond the largest double is infinite; components of any size take part.
    Other columns of ``df`` are ignored whatever their names.
    """
    ship_package(df.sparkSession)
    rows = usable(df, id_col, vec_col)
    is_query = F.pmod(F.col("id"), F.lit(query_every)) == 0
    n, n_queries = df.agg(F.count(id_col), F.count(F.when(F.pmod(F.col(id_col).cast("long"), F.lit(query_every)) == 0, 1))).first()
    blocks, stripes = blocks_for(n_queries, query_block), blocks_for(n, stripe)
    dealt = lambda parts, seed: F.pmod(F.xxhash64("id", "vec", F.lit(seed)), F.lit(parts)).cast("int")
    queries = (rows.filter(is_query).withColumn("block", dealt(blocks, 1))
               .withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1)))))
    items = (rows.withColumn("stripe", dealt(stripes, 2))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    found = (queries.groupBy("block", "stripe").cogroup(items.groupBy("block", "stripe"))
             .applyInPandas(_tiles(k), FOUND))
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
