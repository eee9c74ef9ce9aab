"""Exact top-k inner products on a bit-sliced index.

Components become integers ``floor(256 * x)``. The index holds, for a stripe
of rows sorted by id, one bitmap for each bit of each component (offset by the
component's least value in the stripe). A query adds the bitmaps of the upper
slices, each weighted by the bits of its own component, with full adders on
whole bitmaps; components with a negative weight enter as complements, so what
the dropped low slices could add is never negative and at most a known width.
The k largest sums are picked from the most significant slice of the total
downward. Rows within the width below the k-th sum, the boundary, are computed
exactly from all their slices. Tiles (query block, stripe) hand on their
best rows, which are merged per query.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import blocks_for, stored
from riskloom.session import ship_package

SCALE = 256           # integers are floor(SCALE * x)
WIDE = 2 ** 22        # rows with a component of this size or more stay outside the bitmaps
SLICES = 7            # upper slices that are added up
STRIPE = 32_768       # rows of a stripe
QUERY_BLOCK = 128     # queries of a tile
LONG = 2 ** 63 - 1
INDEX = "stripe int, dim int, bits int, ids binary, low binary, slices binary, wide_ids binary, wide binary"
FOUND = "query_id long, vec_id long, score long"


def whole(x: float) -> int:
    """floor(SCALE * x) of any finite double."""
    return math.floor(x * SCALE) if abs(x) < 2.0 ** 60 else int(x) * SCALE


# -- index ---------------------------------------------------------------------
def _slices(u: np.ndarray, bits: int) -> np.ndarray:
    """Bitmaps (component, bit, word) of non-negative integers (row, component)."""
    n, dim = u.shape
    words = -(-n // 64)
    out = np.zeros((dim, bits, words * 8), dtype=np.uint8)
    for j in range(bits):
        packed = np.packbits(((u >> j) & 1).astype(np.uint8).T, axis=1, bitorder="little")
        out[:, j, :packed.shape[1]] = packed
    return out


def _build(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    stripe, dim = key[0].as_py(), key[1].as_py()
    rows = rows.combine_chunks()
    ids = rows.column("id").to_numpy()
    x = np.asarray(pa.chunked_array([c.flatten() for c in rows.column("vec").chunks], pa.float64())).reshape(len(ids), dim)
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    wide = (np.abs(x) >= WIDE / SCALE).any(axis=1)
    ints = np.floor(x[~wide] * SCALE).astype(np.int64)
    low = ints.min(axis=0) if len(ints) else np.zeros(dim, dtype=np.int64)
    u = ints - low
    bits = max(1, int(u.max(initial=0)).bit_length())
    cells = [[stripe], [dim], [bits], [ids[~wide].tobytes()], [low.tobytes()], [_slices(u, bits).tobytes()],
             [ids[wide].tobytes()], [x[wide].tobytes()]]
    kinds = [pa.int32()] * 3 + [pa.binary()] * 5
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds)],
                                names=["stripe", "dim", "bits", "ids", "low", "slices", "wide_ids", "wide"])


# -- arithmetic on bitmaps -------------------------------------------------------
def add_up(columns: list[np.ndarray], words: int) -> list[np.ndarray]:
    """Slices of the total of bitmaps: ``columns[w]`` are those of weight 2**w."""
    out, carry, w = [], np.zeros((0, words), dtype=np.uint64), 0
    while w < len(columns) or len(carry):
        rows = np.concatenate([columns[w], carry]) if w < len(columns) else carry
        carries = []
        while len(rows) > 2:
            third = len(rows) // 3
            a, b, c = rows[:third], rows[third:2 * third], rows[2 * third:3 * third]
            ab = a ^ b
            carries.append((a & b) | (ab & c))
            rows = np.concatenate([ab ^ c, rows[3 * third:]])
        if len(rows) == 2:
            carries.append((rows[0] & rows[1])[None, :])
            rows = (rows[0] ^ rows[1])[None, :]
        out.append(rows[0] if len(rows) else np.zeros(words, dtype=np.uint64))
        carry = np.concatenate(carries) if carries else np.zeros((0, words), dtype=np.uint64)
        w += 1
    return out


def kth_largest(total: list[np.ndarray], alive: np.ndarray, k: int) -> int:
    """The k-th largest total among the rows of ``alive`` (at least k), from the
    most significant slice downward."""
    value, above, equal = 0, 0, alive
    for w in range(len(total) - 1, -1, -1):
        ones = equal & total[w]
        n = int(np.bitwise_count(ones).sum())
        if above + n >= k:
            equal, value = ones, value | 1 << w
        else:
            above, equal = above + n, equal & ~total[w]
    return value


def at_least(total: list[np.ndarray], alive: np.ndarray, value: int) -> np.ndarray:
    """Bitmap of the rows of ``alive`` whose total is ``value`` or more."""
    if value >> len(total):
        return np.zeros_like(alive)
    more, equal = np.zeros_like(alive), alive
    for w in range(len(total) - 1, -1, -1):
        if value >> w & 1:
            equal = equal & total[w]
        else:
            more |= equal & total[w]
            equal = equal & ~total[w]
    return more | equal


class Stripe:
    """One row of the index, ready for queries."""

    def __init__(self, row: dict, upper: int = SLICES):
        self.dim, self.bits = row["dim"], row["bits"]
        self.ids = np.frombuffer(row["ids"], dtype=np.int64)
        self.low = np.frombuffer(row["low"], dtype=np.int64)
        self.words = -(-len(self.ids) // 64)
        self.slices = np.frombuffer(row["slices"], dtype=np.uint64).reshape(self.dim, self.bits, self.words)
        self.drop = max(0, self.bits - upper)
        kept = self.slices[:, self.drop:]
        self.planes = np.stack([kept, ~kept])  # complements serve negative weights
        self.full = np.packbits(np.arange(self.words * 64) < len(self.ids), bitorder="little").view(np.uint64)
        self.repeats = int(np.unique(self.ids, return_counts=True)[1].max()) if len(self.ids) else 1
        self.wide_ids = np.frombuffer(row["wide_ids"], dtype=np.int64)
        self.wide = np.frombuffer(row["wide"], dtype=np.float64).reshape(len(self.wide_ids), self.dim)

    def integers(self, rows: np.ndarray) -> np.ndarray:
        """Exact integers (component, row) from all slices."""
        word, bit = rows >> 6, (rows & 63).astype(np.uint64)
        out = np.repeat(self.low[:, None], len(rows), axis=1)
        for j in range(self.bits):
            out += ((self.slices[:, j, word] >> bit) & np.uint64(1)).astype(np.int64) << j
        return out

    def total(self, weights: np.ndarray) -> list[np.ndarray]:
        """Slices of the weighted total of the upper slices."""
        size, sign = np.abs(weights), (weights < 0).astype(int)
        columns: dict[int, list[np.ndarray]] = {}
        for p in range(int(size.max(initial=0)).bit_length()):
            d = np.flatnonzero(size >> p & 1)
            for j in range(self.planes.shape[2]):
                columns.setdefault(p + j, []).append(self.planes[sign[d], d, j])
        return add_up([np.concatenate(columns[w]) if w in columns else np.zeros((0, self.words), np.uint64)
                       for w in range(max(columns, default=-1) + 1)], self.words)

    def boundary(self, weights: np.ndarray, own: int, k: int) -> np.ndarray:
        """Rows that can be among the k best ids, own id left out."""
        alive = self.full
        mine = np.arange(*np.searchsorted(self.ids, [own, own + 1]))
        if len(mine):
            hidden = np.zeros(self.words * 64, dtype=bool)
            hidden[mine] = True
            alive = alive & ~np.packbits(hidden, bitorder="little").view(np.uint64)
        k *= self.repeats  # that many rows hold k ids
        if k < len(self.ids) - len(mine):
            total = self.total(weights)
            # a total misses at most (2**drop - 1) / 2**drop of the sum of the weights
            missing = ((1 << self.drop) - 1) * int(np.abs(weights).sum())
            least = kth_largest(total, alive, k) - (missing >> self.drop)
            alive = at_least(total, alive, max(0, least))
        return np.flatnonzero(np.unpackbits(alive.view(np.uint8), bitorder="little"))

    def best(self, own: int, vec: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(id, score) of the k best ids of the stripe."""
        wide = bool((np.abs(vec) >= WIDE / SCALE).any())
        exact = [whole(v) for v in vec.tolist()]
        scores: dict[int, int] = {}
        if wide:
            pairs = zip(self.ids.tolist(), self.integers(np.arange(len(self.ids))).T.tolist())
        else:
            weights = np.array(exact, dtype=np.int64)
            rows = self.boundary(weights, own, k)
            for at in range(0, len(rows), 8192):
                part = rows[at:at + 8192]
                for i, s in zip(self.ids[part].tolist(), (weights @ self.integers(part)).tolist()):
                    if s > scores.get(i, -LONG - 1):
                        scores[i] = s
            pairs = iter(())
        pairs = [*pairs, *zip(self.wide_ids.tolist(), ([whole(v) for v in r] for r in self.wide.tolist()))]
        for i, ints in pairs:
            s = max(-LONG - 1, min(LONG, sum(a * b for a, b in zip(exact, ints))))
            if i not in scores or s > scores[i]:
                scores[i] = s
        scores.pop(own, None)
        return sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k]


def _tiles(k: int, upper: int):
    def run(queries: pa.Table, index: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int]] = []
        for row in index.to_pylist():
            stripe = Stripe(row, upper)
            for q, vec in zip(queries.column("id").to_pylist(), queries.column("vec").to_pylist()):
                if len(vec) == stripe.dim:  # vectors of unlike length are not compared
                    found += [(q, i, s) for i, s in stripe.best(q, np.array(vec), k)]
        return pa.Table.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in range(3)],
                                    names=["query_id", "vec_id", "score"])
    return run


# -- Spark ---------------------------------------------------------------------
def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, vec`` of the rows that take part in a search."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.col("id").isNotNull() & (F.size("vec") > 0) & ~F.coalesce(bad, F.lit(True)))


def bit_sliced_index(rows: DataFrame, stripe: int = STRIPE) -> DataFrame:
    """The index of all ``rows``: one row a stripe (and vector length), stored."""
    parts = blocks_for(rows.count(), stripe)
    dealt = F.pmod(F.xxhash64("id", "vec"), F.lit(parts)).cast("int")
    return stored(rows.distinct().select(dealt.alias("stripe"), F.size("vec").alias("dim"), "id", "vec")
                  .groupBy("stripe", "dim").applyInArrow(_build, INDEX), "bit-slices")


def top_products(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5, query_every: int = 50,
                 stripe: int = STRIPE, query_block: int = QUERY_BLOCK, upper: int = SLICES) -> DataFrame:
    """The k rows of largest integer inner product for each row whose id is
    divisible by ``query_every``: ``query_id, rank, vec_id, score``.

    Ties go to the smaller id; all candidates if there are fewer than k. Out:
    a null id; a vector that is null, empty, or holds a null or non-finite
    component. All-zero vectors take part. Rows that share an id are one item
    with several vectors: its score is the largest; equal rows count once.
    Vectors of unlike length are not compared. Scores beyond the range of a
    long are held at its ends. No usable row: no result. Other columns of
    ``df`` are ignored whatever their names.
    """
    ship_package(df.sparkSession)
    rows = usable(df, id_col, vec_col)
    index = bit_sliced_index(rows, stripe)
    queries = rows.filter(F.pmod(F.col("id"), F.lit(query_every)) == 0).distinct()
    blocks = blocks_for(queries.count(), query_block)
    last = index.agg(F.max("stripe")).first()[0] or 0
    asked = (queries.select("id", "vec", F.pmod(F.xxhash64("id", "vec"), F.lit(blocks)).cast("int").alias("block"))
             .select("*", F.explode(F.sequence(F.lit(0), F.lit(last))).alias("stripe")))
    copies = index.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    found = (asked.groupBy("block", "stripe").cogroup(copies.groupBy("block", "stripe"))
             .applyInArrow(_tiles(k, upper), FOUND))
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def oracle(k: int = 5, query_every: int = 50) -> str:
    """DuckDB SQL of the same rows over ``embeddings`` with distinct ids."""
    return f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS a
  FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
        CAST(list_sum([z[1] * z[2] FOR z IN list_zip(q.a, c.a)]) AS BIGINT) AS score
      FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.a) = len(q.a) WHERE q.vec_id % {query_every} = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {k}
"""
