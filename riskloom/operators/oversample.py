"""Minority oversampling (B7): SMOTE-style interpolation inside bounded groups.

The reference oversamples one training *session* at a time (a positional
slice of at most ``per_session`` rows). Here every row gets its session by
exact position (two-phase rank over quantile buckets of the order key), and
``groupBy(session).applyInPandas`` runs the interpolation per session: each
group is bounded by ``per_session`` rows, so the exact k-nearest-neighbour
search (blocked distance products in numpy, never materialised as row
pairs) stays bounded too. Seeds are fixed per session, so a retried task
reproduces its rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.ranking import rank_in_buckets, sampled_range_bucket
from riskloom.session import ship_package

# Gate on the positive share, target minority/majority ratio,
# neighbours, seed.
GATE_SHARE = 0.3
TARGET_RATIO = 0.3
K_NEIGHBOURS = 5
SEED = 42
MAX_BUCKETS = 4096
ROWS_PER_BUCKET = 1_000_000


def positional_index(df: DataFrame, order_col: str, name: str = "position",
                     rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Exact 0-based position by ``order_col`` (unique). Buckets come from
    approximate quantiles (at most MAX_BUCKETS bounds collected) and are
    assigned by binary search (Bucketizer); ranks are exact regardless of
    how even the buckets are."""
    n = df.count()
    b = int(min(MAX_BUCKETS, max(1, -(-n // rows_per_bucket))))
    if b > 1 and dict(df.dtypes)[order_col] == "string":
        d = df.withColumn("__all", F.lit(0))
        d = d.withColumn("__b", sampled_range_bucket(d, "__all", order_col, buckets=b)).drop("__all")
    elif b > 1:
        qs = [i / b for i in range(1, b)]
        bounds = df.select(F.percentile_approx(F.col(order_col).cast("double"), qs, 10000)).first()[0]
        splits = [-float("inf")] + sorted(set(bounds)) + [float("inf")]
        d = df.withColumn("__x", F.col(order_col).cast("double"))
        d = Bucketizer(splits=splits, inputCol="__x", outputCol="__b", handleInvalid="keep").transform(d).drop("__x")
    else:
        d = df.withColumn("__b", F.lit(0.0))
    d = d.withColumn("__all", F.lit(0))
    r = rank_in_buckets(d, ["__all"], "__b", [F.col(order_col)], name="__rk")
    return r.withColumn(name, F.col("__rk") - 1).drop("__rk", "__b", "__all")


def knn_indices(x: np.ndarray, k: int, block: int = 512) -> np.ndarray:
    """Exact k nearest neighbours (excluding self) by blocked squared distances."""
    m = len(x)
    sq = (x * x).sum(axis=1)
    out = np.empty((m, k), dtype=np.int64)
    for s in range(0, m, block):
        e = min(m, s + block)
        d2 = sq[s:e, None] + sq[None, :] - 2.0 * (x[s:e] @ x.T)
        d2[np.arange(e - s), np.arange(s, e)] = np.inf
        idx = np.argpartition(d2, k - 1, axis=1)[:, :k]
        # order the k by distance, then index, for a deterministic result
        dk = np.take_along_axis(d2, idx, axis=1)
        o = np.lexsort((idx, dk), axis=1)
        out[s:e] = np.take_along_axis(idx, o, axis=1)
    return out


def smote_group(pdf: pd.DataFrame, id_col: str, feat_col: str, label: str, gate_share: float,
                target_ratio: float, k: int, seed: int) -> pd.DataFrame:
    pdf = pdf.assign(synthetic=0)
    n = len(pdf)
    if n == 0:
        return pdf
    y = pdf[label].to_numpy()
    n_pos = int((y == 1).sum())
    if not (n_pos / n < gate_share):
        return pdf
    minority = 1 if n_pos <= n - n_pos else 0
    xm = np.stack(pdf.loc[y == minority, feat_col].to_numpy()).astype(np.float64) if (y == minority).any() else None
    m = 0 if xm is None else len(xm)
    n_major = n - m
    n_new = int(n_major * target_ratio - m)
    if n_new <= 0 or m < 2:
        return pdf
    kk = min(k, m - 1)
    nn = knn_indices(xm, kk)
    sess = int(pdf["session"].iloc[0])
    rng = np.random.default_rng([seed, sess])
    base = rng.integers(0, m, n_new)
    nb = nn[base, rng.integers(0, kk, n_new)]
    gap = rng.random(n_new)[:, None]
    xn = xm[base] + gap * (xm[nb] - xm[base])
    ids = pdf.loc[y == minority, id_col].to_numpy()[base]
    new = pd.DataFrame({id_col: ids, "session": sess, feat_col: list(xn), label: minority, "synthetic": 1})
    return pd.concat([pdf, new[pdf.columns]], ignore_index=True)


def smote_sessions(df: DataFrame, id_col: str, feat_col: str, label: str, per_session: int = 5000,
                   gate_share: float = GATE_SHARE, target_ratio: float = TARGET_RATIO, k: int = K_NEIGHBOURS,
                   seed: int = SEED) -> DataFrame:
    """Rows of every session plus synthetic minority rows (``synthetic`` = 1;
    their ``row_id`` is the base row they were interpolated from)."""
    ship_package(df.sparkSession)
    pos = positional_index(df.select(id_col, feat_col, label), id_col)
    s = pos.select(id_col, (F.floor(F.col("position") / per_session) + 1).cast("long").alias("session"),
                   F.col(feat_col).cast("array<double>").alias(feat_col), F.col(label).cast("int").alias(label))
    schema = f"{id_col} {dict(df.dtypes)[id_col]}, session long, {feat_col} array<double>, {label} int, synthetic int"

    def fn(pdf):
        return smote_group(pdf, id_col, feat_col, label, gate_share, target_ratio, k, seed)

    return s.groupBy("session").applyInPandas(fn, schema)
