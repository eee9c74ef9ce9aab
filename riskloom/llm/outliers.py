"""Quality rules with robust multivariate outliers.

Each text is counted (words, symbols, repeated lines and windows of words).
Rates of these counts, drawn towards their group's median where a text is too
short to tell, make a statistic vector. Per language and source, a minimum
covariance determinant estimate is fitted over all rows that pass the base
rules: from medians and median deviations, concentration steps keep the share
``SUBSET`` of the group with the smallest Mahalanobis distances and take their
mean and covariance anew; a reweighted step follows. A text is rejected when
its distance is beyond what clean normal vectors would reach.

Every step is an aggregation over (group) that combines before the shuffle:
distances go into narrow bins, so a group of any size gives a bounded number
of counts, and no group is gathered in one task. Only the inverse of a
4 x 4 matrix a group is computed in Python.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import stored
from riskloom.session import ship_package

SYMBOLS = "#*$%&|<>"        # fixed
BLANKS = " \t\n\v\f\r"      # fixed
SUBSET = 0.75               # share of a group that the determinant is taken over
STEPS = 4                   # concentration steps
MIN_GROUP = 200             # smaller groups of a language are fitted together
TAIL = 1e-4                 # share of clean normal vectors beyond the cut

COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

#: Rates: count, of what, weight of the group's median in the same unit,
#: transform, and the least standard deviation of the transformed rate.
RATES = (
    ("word_chars", "n_words", 200.0, "log", 0.03),
    ("n_symbols", "word_chars", 1000.0, "sqrt", 0.04),
    ("n_dup_lines", "n_lines", 10.0, "sqrt", 0.12),
    ("n_repeat_words", "n_words", 200.0, "sqrt", 0.12),
)
DIM = len(RATES)


def count(text: str | None) -> tuple[int, ...]:
    """The counts of one text; null has none. Blanks are ASCII white space."""
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        often, until = Counter(windows), 0
        for i, window in enumerate(windows):
            if often[window] > 1:
                repeated += i + 3 - max(i, until)
                until = i + 3
    return (len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)),
            len(lines), len(lines) - len(set(lines)), repeated)


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            made = zip(*map(count, part.column(part.num_columns - 1).to_pylist()))
            arrays = [*part.columns[:-1], *(pa.array(c, pa.int64()) for c in made)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "lang", "source", *COUNTS])


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source``, the counts and ``base_failed`` of every row; stored once."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("source").cast("string"),
                       F.col("text").cast("string"))
    counted = rows.mapInArrow(_count_batches, "doc_id long, lang string, source string, "
                              + ", ".join(f"{c} long" for c in COUNTS))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return stored(counted.withColumn("base_failed", failed), "statistics")


def _chi2_4(x: float) -> float:
    return 1 - math.exp(-x / 2) * (1 + x / 2)


def _chi2_6(x: float) -> float:
    return 1 - math.exp(-x / 2) * (1 + x / 2 + x * x / 8)


def chi2_4_quantile(p: float) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2_4(mid) < p else (low, mid)
    return low


def _consistent(share: float) -> float:
    """Factor that makes the covariance of the nearest ``share`` of normal vectors that of all."""
    return share / _chi2_6(chi2_4_quantile(share))


PAIRS = [(i, j) for i in range(DIM) for j in range(i, DIM)]
FITTED = "lang string, pool string, " + ", ".join([f"m{i} double" for i in range(DIM)] + [f"p{i}{j} double" for i, j in PAIRS])


def _inverse(factor: float):
    """Location and inverse covariance from a group's moments, or (no moments) from its median deviations."""
    floor = np.array([r[4] for r in RATES])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                if hasattr(row, "n"):
                    mean = np.array([getattr(row, f"s{i}") for i in range(DIM)]) / row.n
                    cov = np.empty((DIM, DIM))
                    for i, j in PAIRS:
                        cov[i, j] = cov[j, i] = (getattr(row, f"s{i}{j}") / row.n - mean[i] * mean[j]) * factor
                else:
                    mean = np.array([getattr(row, f"m{i}") for i in range(DIM)])
                    cov = np.diag([(1.4826 * getattr(row, f"d{i}")) ** 2 for i in range(DIM)])
                values, vectors = np.linalg.eigh(cov / np.outer(floor, floor))
                # no direction is narrower than the least deviations allow
                inverse = (vectors / np.maximum(values, 1.0)) @ vectors.T / np.outer(floor, floor)
                out.append((row.lang, row.pool, *mean.tolist(), *(float(inverse[i, j]) for i, j in PAIRS)))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in FITTED.split(", ")])
    return run


def _distance() -> Column:
    gap = [F.col(f"x{i}") - F.col(f"m{i}") for i in range(DIM)]
    return sum((F.col(f"p{i}{j}") * gap[i] * gap[j] * (1 if i == j else 2) for i, j in PAIRS), F.lit(0.0))


def _near(rows: DataFrame, fitted: DataFrame) -> DataFrame:
    return rows.join(fitted, ["lang", "pool"]).withColumn("d2", _distance())


def _moments(rows: DataFrame) -> DataFrame:
    return rows.groupBy("lang", "pool").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(f"x{i}").alias(f"s{i}") for i in range(DIM)],
        *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}{j}") for i, j in PAIRS])


def _nearest_share(near: DataFrame, share: float) -> DataFrame:
    """Rows whose distance is in the bins that hold the nearest ``share`` of their group."""
    # 64 bins to each doubling of the squared distance: a few thousand a group at most
    binned = near.withColumn("bin", F.floor(F.log2(F.col("d2") + 1e-9) * 64).cast("int"))
    per_bin = binned.groupBy("lang", "pool", "bin").agg(F.count(F.lit(1)).alias("in_bin"))
    group = Window.partitionBy("lang", "pool")
    below = F.sum("in_bin").over(group.orderBy("bin")) - F.col("in_bin")
    kept = per_bin.withColumn("below", below).withColumn("all", F.sum("in_bin").over(group))
    last = stored(kept.filter(F.col("below") < share * F.col("all")).groupBy("lang", "pool").agg(F.max("bin").alias("last")), "last")
    return binned.join(last, ["lang", "pool"]).filter(F.col("bin") <= F.col("last"))


def vectors(stats: DataFrame) -> DataFrame:
    """Adds the group (``lang, pool``) and the statistic vector ``x0..x3``.

    Null languages and sources are groups of their own. Sources with fewer
    than ``MIN_GROUP`` rows that pass the base rules are fitted together
    within their language.
    """
    named = stats.withColumns({"lang": F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-")),
                               "source": F.coalesce(F.concat(F.lit("="), "source"), F.lit("-"))})
    # tables of one row a group are stored, so that their size is known and Spark broadcasts them if small
    sizes = stored(named.groupBy("lang", "source").agg(F.count(F.when(~F.col("base_failed"), 1)).alias("size")), "sizes")
    pool = F.when(F.col("size") >= MIN_GROUP, F.col("source")).otherwise(F.lit("*"))
    pooled = named.join(sizes.select("lang", "source", pool.alias("pool")), ["lang", "source"])
    rate = [F.col(a) / F.greatest(F.col(b), F.lit(1)) for a, b, *_ in RATES]
    usual = stored(pooled.groupBy("lang", "pool").agg(
        *[F.coalesce(F.percentile_approx(F.when(~F.col("base_failed"), r), 0.5), F.lit(0.0)).alias(f"r{i}") for i, r in enumerate(rate)]), "usual")
    made = {}
    for i, (a, b, weight, how, _) in enumerate(RATES):
        shrunk = (F.col(a) + weight * F.col(f"r{i}")) / (F.col(b) + weight)
        made[f"x{i}"] = F.sqrt(shrunk) if how == "sqrt" else F.log(F.greatest(shrunk, F.lit(1e-3)))
    return stored(pooled.join(usual, ["lang", "pool"]).withColumns(made).drop(*[f"r{i}" for i in range(DIM)]), "vectors")


def fit(rows: DataFrame) -> DataFrame:
    """Reweighted minimum-covariance-determinant location and inverse covariance of each group."""
    used = rows.filter(~F.col("base_failed")).select("lang", "pool", *[f"x{i}" for i in range(DIM)])
    middle = stored(used.groupBy("lang", "pool").agg(
        *[F.percentile_approx(f"x{i}", 0.5, 10_000).alias(f"m{i}") for i in range(DIM)]), "middle")
    spread = used.join(middle, ["lang", "pool"]).groupBy("lang", "pool").agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in range(DIM)],
        *[F.percentile_approx(F.abs(F.col(f"x{i}") - F.col(f"m{i}")), 0.5, 10_000).alias(f"d{i}") for i in range(DIM)])
    fitted = stored(spread.mapInPandas(_inverse(1.0), FITTED), "fitted")
    for _ in range(STEPS):
        nearest = _nearest_share(_near(used, fitted), SUBSET)
        fitted = stored(_moments(nearest).mapInPandas(_inverse(_consistent(SUBSET)), FITTED), "fitted")
    clean = _near(used, fitted).filter(F.col("d2") <= chi2_4_quantile(0.975))
    # a group whose rows all lie beyond keeps its unweighted estimate
    better = _moments(clean).mapInPandas(_inverse(_consistent(0.975)), FITTED)
    rest = fitted.join(better, ["lang", "pool"], "left_anti")
    return stored(better.union(rest), "fitted")


def judge(docs: DataFrame, tail: float = TAIL) -> DataFrame:
    """Counts and verdict of every document.

    Columns ``doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, distance`` (squared). A null or empty
    text has no words and fails the base rules. Null languages or sources
    form groups of their own; repeated rows each get a row and count in the
    fit; an empty table gives none; other columns are ignored. A group with
    no row that passes the base rules has no fit and null distances.
    """
    rows = vectors(statistics(docs))
    judged = rows.join(fit(rows), ["lang", "pool"], "left").withColumn("distance", _distance())
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= chi2_4_quantile(1 - tail), F.lit(False))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", kept.alias("kept"), "distance")
