"""Minority oversampling over a whole table (B7 beyond one session).

Synthetic rows lie between a minority row and one of its k nearest minority
neighbours. The neighbour graph comes from a forest of random trees: in each
tree, nodes with too many rows are split at the mean of a random projection, all
nodes of a level together, until every leaf fits one group; rows are compared
with the rows of their leaves, and the trees' short lists are merged. The share
of true neighbours found is measured on a sample against all rows; more trees
are grown until it reaches the target, and if they do not get there the exact
neighbours are taken from blocks of rows against all rows.

Rows that repeat a vector more than k + 1 times have the first of these copies as
their neighbours, at distance 0, and stay out of the trees.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.ranking import assign_by_rank, hash_key, hex_bucket
from riskloom.session import materialize, ship_package

LEAF = 1024        # rows of a leaf
TREES = 4          # at first; doubled up to MOST_TREES
MOST_TREES = 32
SAMPLE = 256       # rows on which recall is measured
RECALL = 0.95
BLOCK = 1024       # rows whose exact neighbours are looked for at once
FOUND = "id string, nb string, dist double"


def _near(ids: np.ndarray, x: np.ndarray, other_ids: np.ndarray, y: np.ndarray, k: int) -> pd.DataFrame:
    """The k nearest others of each row by exact distances, ties to the smaller id.

    Squared distances from inner products, right up to rounding, leave out the others that are
    surely further than the k-th nearest; only the rest are compared exactly."""
    out = []
    code = pd.factorize(np.concatenate([ids, other_ids]))[0]
    own, others = code[:len(ids)], code[len(ids):]
    with np.errstate(all="ignore"):
        yy = (y * y).sum(axis=1)
        for at in range(0, len(x) if len(y) else 0, 256):
            some = x[at:at + 256]
            xx = (some * some).sum(axis=1)[:, None]
            rough = xx + yy - 2.0 * (some @ y.T)
            rough[own[at:at + 256, None] == others] = np.inf
            last = min(k, len(y)) - 1
            limit = np.partition(rough, last, axis=1)[:, last, None] + 1e-9 * (xx + yy.max()) + 1e-300
            far = rough > limit  # not where either is no number
            for i, n, v, out_of_reach in zip(ids[at:at + 256], own[at:at + 256], some, far):
                near = np.flatnonzero(~out_of_reach)
                dist = np.where(others[near] == n, np.inf, np.sqrt(((y[near] - v) ** 2).sum(axis=1)))
                best = np.lexsort((other_ids[near], dist))[:k]
                out += [(i, other_ids[near[j]], dist[j]) for j in best if np.isfinite(dist[j])]
    return pd.DataFrame(out, columns=["id", "nb", "dist"]).astype({"dist": "float64"})


def _leaf(k: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(rows["vec"].to_numpy()).astype(np.float64)
        ids = rows["id"].to_numpy()
        return _near(ids, x, ids, x, k)
    return run


def _against(sent, k: int):
    """Nearest rows of each partition to the broadcast ones."""
    def run(batches):
        ids, x = sent.value
        for batch in batches:
            if batch.num_rows and len(ids):
                y = np.asarray(batch.column("vec").flatten(), dtype=np.float64).reshape(batch.num_rows, -1)
                found = _near(ids, x, np.array(batch.column("id").to_pylist(), dtype=object), y, k)
                yield pa.RecordBatch.from_pandas(found, schema=pa.schema([("id", pa.string()), ("nb", pa.string()), ("dist", pa.float64())]),
                                                 preserve_index=False)
    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    near = found.groupBy("id", "nb").agg(F.min("dist").alias("dist"))
    order = Window.partitionBy("id").orderBy("dist", "nb")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _leaves(rows: DataFrame, trees: list[int], width: int, leaf: int, seed: int) -> DataFrame:
    """tree, node, id, vec: rows in the leaves of each tree."""
    out = rows.select("id", "vec", F.explode(F.array(*[F.lit(t) for t in trees])).alias("tree"), F.lit(1).cast("long").alias("node"))
    done = None
    for level in range(60):
        sizes = materialize(out.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("size")), "leaf-sizes")
        if not sizes.where(F.col("size") > leaf).limit(1).count():
            break
        rnd = np.random.default_rng([seed, level])
        ways = {t: rnd.normal(size=width) for t in range(max(trees) + 1)}
        way = F.element_at(F.array(*[F.array(*[F.lit(float(v)) for v in ways[t]]) for t in range(max(trees) + 1)]), F.col("tree") + 1)
        dot = F.aggregate(F.zip_with("vec", way, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
        placed = materialize(out.join(sizes, ["tree", "node"]).withColumn("dot", F.when(F.col("size") > leaf, dot)), "leaf-level")
        small = placed.where(F.col("size") <= leaf).select("id", "vec", "tree", "node")
        done = small if done is None else done.unionByName(small)
        large = placed.where(F.col("size") > leaf)
        means = materialize(large.groupBy("tree", "node").agg(F.avg("dot").alias("mean"), F.min("dot").alias("lo"), F.max("dot").alias("hi")), "leaf-means")
        # rows that a projection cannot tell apart are dealt out by hash
        side = F.when(F.col("lo") < F.col("hi"), F.col("dot") > F.col("mean")).otherwise(F.pmod(F.xxhash64("id", F.lit(level)), F.lit(2)) == 1)
        out = materialize(large.join(means, ["tree", "node"]).select(
            "id", "vec", "tree", (F.col("node") * 2 + side.cast("long")).alias("node")), "leaf-split")
    return out if done is None else done.unionByName(out)


def neighbour_graph(rows: DataFrame, k: int = 5, recall: float = RECALL, leaf: int = LEAF, trees: int = TREES,
                    most_trees: int = MOST_TREES, seed: int = 42) -> tuple[DataFrame, float]:
    """(id, nb, dist, rank) of each row's k nearest others, and the recall
    measured on a sample (1.0 where the exact way was taken).

    ``rows``: id string (distinct), vec array<double> of one length."""
    spark = rows.sparkSession
    ship_package(spark)
    rows = materialize(rows.select("id", "vec", F.xxhash64("vec").alias("same")), "minority")
    copies = Window.partitionBy("same").orderBy("id")
    first = materialize(rows.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).drop("copy"), "first-copies")
    width = rows.agg(F.max(F.size("vec"))).first()[0] or 0
    sample = rows_of(first.orderBy(F.xxhash64("id", F.lit(seed))).limit(SAMPLE))
    exact = _best(first.select("id", "vec").mapInArrow(_against(spark.sparkContext.broadcast(sample), k), FOUND), k)
    truth: dict[str, list[float]] = {}
    for r in exact.orderBy("id", "rank").collect():  # SAMPLE * k rows
        truth.setdefault(r.id, []).append(r.dist)
    found, grown, got = None, 0, 0.0
    while grown < most_trees:
        more = list(range(grown, max(trees, 2 * grown) if grown else trees))
        near = _leaves(first.select("id", "vec"), more, width, leaf, seed).groupBy("tree", "node").applyInPandas(_leaf(k), FOUND)
        found = materialize(_best(near if found is None else near.unionByName(found.drop("rank")), k), "neighbours")
        grown = more[-1] + 1
        hits = found.where(F.col("id").isin(*truth)).select("id", "dist").collect() if truth else []  # SAMPLE * k rows
        total = sum(len(d) for d in truth.values())
        got = sum(h.dist <= truth[h.id][-1] for h in hits) / total if total else 1.0
        if got >= recall:
            break
    if got < recall:
        parts = None
        blocks = -(-first.count() // BLOCK)
        for b in range(blocks):
            some = rows_of(first.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b))
            near = materialize(_best(first.select("id", "vec").mapInArrow(_against(spark.sparkContext.broadcast(some), k), FOUND), k), "exact")
            parts = near if parts is None else parts.unionByName(near)
        found, got = parts, 1.0
    # further copies of a vector: the first ones are their neighbours
    later = rows.join(first.select("id"), "id", "left_anti").select("id", "same")
    order = Window.partitionBy("same").orderBy("id")
    heads = first.select("same", F.col("id").alias("nb"), F.row_number().over(order).alias("rank")).where(F.col("rank") <= k)
    others = later.join(heads, "same").select("id", "nb", F.lit(0.0).alias("dist"), "rank")
    return found.select("id", "nb", "dist", "rank").unionByName(others), got


def rows_of(df: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """A bounded number of rows as arrays."""
    got = df.select("id", "vec").collect()
    return np.array([r.id for r in got], dtype=object), np.array([r.vec for r in got], dtype=np.float64).reshape(len(got), -1)


def oversample(df: DataFrame, id_col: str = "row_id", features: str = "features", label: str = "y", k: int = 5,
               gate: float = 0.3, ratio: float = 0.3, seed: int = 42, **how) -> DataFrame:
    """(row_id, features, y, synthetic, base, neighbour): all rows and, where
    the positives' share is below ``gate``, as many synthetic positives as
    lift them to ``ratio`` of the negatives.

    Every positive with a neighbour is the base of equally many synthetic rows,
    the first ones by hash of one more; which neighbour and how far towards it
    follow from hashes of seed, row and number, so a retried task makes the
    same rows. Rows with a null label, id or vector are kept and never a base;
    fewer than two positives: no synthetic rows. Ids are compared as text."""
    rows = df.select(F.col(id_col).cast("string").alias("row_id"), F.col(features).cast("array<double>").alias("features"),
                     F.col(label).cast("int").alias("y"))
    none = F.lit(None).cast("string")
    kept = rows.select("*", F.lit(0).alias("synthetic"), none.alias("base"), none.alias("neighbour"))
    n = rows.agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg")).first()
    want = int(n.neg * ratio) - n.pos
    minority = rows.where("y = 1 AND row_id IS NOT NULL AND features IS NOT NULL").select(
        F.col("row_id").alias("id"), F.col("features").alias("vec"))
    if want <= 0 or n.pos < 2 or n.pos >= gate * (n.pos + n.neg):
        return kept
    minority = materialize(minority, "minority-rows")
    graph, _ = neighbour_graph(minority, k, seed=seed, **how)
    near = materialize(graph.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("rank", "nb"))).alias("near")), "graph")
    bases = near.count()
    if not bases:
        return kept
    hashed = near.withColumns({"h": hash_key("id", seed), "all": F.lit(0)})
    hashed = hashed.withColumn("b", hex_bucket(F.col("h"), 4))
    cut = df.sparkSession.createDataFrame([(0, want % bases)], "all int, cut_1 long")
    dealt = assign_by_rank(hashed, ["all"], "b", [F.col("h"), F.col("id")], cut, 1, "later")
    each = F.lit(want // bases) + F.when(F.col("later") == 0, 1).otherwise(0)
    made = dealt.withColumn("i", F.explode(F.when(each > 0, F.sequence(F.lit(1), each)).otherwise(F.array().cast("array<bigint>"))))
    pick = F.pmod(F.xxhash64("id", "i", F.lit(seed)), F.size("near")).cast("int")
    share = F.pmod(F.xxhash64("id", "i", F.lit(seed + 1)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    made = made.select("id", "i", F.element_at("near", pick + 1)["nb"].alias("nb"), share.alias("u"))
    ends = made.join(minority, "id").join(minority.select(F.col("id").alias("nb"), F.col("vec").alias("to")), "nb")
    point = F.transform(F.arrays_zip("vec", "to"), lambda z: z["vec"] + F.col("u") * (z["to"] - z["vec"]))
    made = ends.select(F.concat_ws("#", "id", F.col("i").cast("string")).alias("row_id"), point.alias("features"), F.lit(1).alias("y"),
                       F.lit(1).alias("synthetic"), F.col("id").alias("base"), F.col("nb").alias("neighbour"))
    return kept.unionByName(made)
