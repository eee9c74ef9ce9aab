"""Exact stratified splits, per-model samples, fixed-size samples and
positional slices (B1-B6).

Counts follow the reference's splitter: the held-out size is
ceil(ratio * n), the kept size n minus that, shared among classes by largest
remainder (kept side first, as the reference allocates it); ties go to the
lower class. Members are chosen by an md5(seed-id) order, so they are
reproducible in any engine but differ from the reference's generator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.ranking import (assign_by_rank, cut_keys, hash_key, hex_bucket, join_null_safe, key_bucket,
                                       largest_remainder, mix32, row_key32, sampled_range_bucket)
from riskloom.session import materialize

# Split presets (held-out ratio, second ratio, second applies to).
PRESETS = {
    "60/20/20": (0.2, 0.25, "rest"),   # test 20 %, then val = 25 % of the rest
    "70/15/15": (0.3, 0.5, "holdout"),  # hold 30 %, then test = 50 % of the hold
}
SEGMENTS = ["test", "val", "train"]
DEFAULT_SEED = 42


#: Leading hex digits of a hash that make a bucket. Exactness never depends on
#: them; they balance the bucket counts (16^d a class) against the keys of a cut
#: bucket that are put in order (n / 16^d).
BUCKET_DIGITS = 4


def _holdout_quota(counts, part, label, n_col, ratio, name):
    """held-out rows per class: n_c - largest_remainder(n - ceil(ratio*n))."""
    tot = F.sum(n_col).over(Window.partitionBy(*part))
    keep_total = tot - F.ceil(F.lit(float(ratio)) * tot.cast("double")).cast("long")
    kept = largest_remainder(counts, part, label, n_col, keep_total, "__kept")
    return kept.withColumn(name, F.col(n_col) - F.col("__kept")).drop("__kept")


def split_quotas_from_counts(c: DataFrame, label: str, preset: str = "60/20/20",
                             part: list[str] | None = None) -> DataFrame:
    """Per class of a (part..., label, __nc) counts table: cut_1 = test rows, cut_2 = test + val rows."""
    part = part or []
    r1, r2, where = PRESETS[preset]
    c = _holdout_quota(c, part, label, "__nc", r1, "__h1")
    if where == "rest":
        c = c.withColumn("__rest", F.col("__nc") - F.col("__h1"))
        c = _holdout_quota(c, part, label, "__rest", r2, "__h2")
        c = c.select(*part, label, F.col("__h1").alias("cut_1"), (F.col("__h1") + F.col("__h2")).alias("cut_2"))
    else:
        c = _holdout_quota(c, part, label, "__h1", r2, "__t")
        c = c.select(*part, label, F.col("__t").alias("cut_1"), F.col("__h1").alias("cut_2"))
    return c


def stratified_split(df: DataFrame, id_col: str, label: str, preset: str = "60/20/20",
                     seed: int = DEFAULT_SEED, digits: int | None = None, name: str = "split") -> DataFrame:
    """B1/B2: add ``split`` in {train, val, test} with exact per-class counts."""
    h = df.withColumn("__h", hash_key(id_col, seed))
    h = h.withColumn("__b", hex_bucket(F.col("__h"), digits or BUCKET_DIGITS))
    seg = assign_by_rank(h, [label], "__b", [F.col("__h"), F.col(id_col)],
                         lambda c: split_quotas_from_counts(c, label, preset), 2, "__seg")
    return seg.withColumn(name, F.element_at(F.array(*[F.lit(s) for s in SEGMENTS]), F.col("__seg") + 1)) \
              .drop("__h", "__b", "__seg")


def two_way_split(df: DataFrame, id_col: str, label: str, ratio: float, seed: int = DEFAULT_SEED,
                  digits: int | None = None, name: str = "holdout") -> DataFrame:
    """B1: ``holdout`` = 1 for ceil(ratio*n) rows shared by class, else 0."""
    h = df.withColumn("__h", hash_key(id_col, seed)).withColumn("__b", hex_bucket(F.col("__h"), digits or BUCKET_DIGITS))
    seg = assign_by_rank(h, [label], "__b", [F.col("__h"), F.col(id_col)],
                         lambda c: _holdout_quota(c, [], label, "__nc", ratio, "cut_1").select(label, "cut_1"),
                         1, "__seg")
    return seg.withColumn(name, (F.col("__seg") == 0).cast("int")).drop("__h", "__b", "__seg")


def stratified_samples(df: DataFrame, id_col: str, label: str, split_col: str = "split", n_models: int = 12,
                       fraction: float | None = None, seed_base: int = DEFAULT_SEED,
                       split_offsets: dict[str, int] | None = None, digits: int | None = None,
                       approximate: bool = False) -> DataFrame:
    """For every model m and split s an independent stratified sample of
    ``fraction`` (default 1/n_models) of the split's rows, seed
    seed_base + m + offset(s). Samples overlap across models, as in the
    reference. Output: input rows x their (model_id) memberships, long form.
    The per-model order is a 32-bit scramble (``mix32``) of one md5 key per
    row, so each (row, model) pair costs integer arithmetic, not a digest.

    Narrow rows (keys and classes) give the cut key of every (model, split,
    class); the wide rows are compared with them where they are read and copied
    only for the models they belong to.
    """
    fraction = fraction if fraction is not None else 1.0 / n_models
    offsets = split_offsets or {"train": 0, "val": 100, "test": 200}
    if approximate:
        # Bernoulli per (model, split, class) stratum: no counts pass, sizes
        # only approximately equal to the quota
        labels = [r[0] for r in df.select(label).distinct().collect()]  # one row per class
        parts = []
        for m in range(1, n_models + 1):
            for sp, off in offsets.items():
                sub = df.where(F.col(split_col) == sp)
                parts.append(sub.sampleBy(label, {c: fraction for c in labels}, seed_base + m + off)
                             .withColumn("model_id", F.lit(m)))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
    off = F.coalesce(F.element_at(F.create_map(*[x for k, v in offsets.items() for x in (F.lit(k), F.lit(v))]),
                                  F.col(split_col)), F.lit(0))
    # one md5 per row; each (row, model) pair only scrambles it with integer
    # arithmetic (seed = seed_base + model + split offset)
    d = BUCKET_DIGITS if digits is None else digits
    rows = df.withColumns({"__x": row_key32(id_col, f"{seed_base}s"), "__off": off})
    hashed = lambda m: mix32(F.col("__x"), F.lit(seed_base) + m + F.col("__off"))
    models = F.sequence(F.lit(1), F.lit(n_models))
    narrow = rows.select(split_col, label, "__x", "__off", F.col(id_col).alias("__id"), F.explode(models).alias("model_id"))
    narrow = narrow.withColumn("__h", hashed(F.col("model_id")))
    part = ["model_id", split_col]

    def cuts(c):
        return _holdout_quota(c, part, label, "__nc", fraction, "cut_1").select(*part, label, "cut_1")

    # the cut keys of every (model, split, class) at once, from narrow rows ...
    keys = cut_keys(narrow.select(*part, label, key_bucket(F.col("__h"), d).alias("__b"),
                                  F.struct(F.col("__h").alias("k0"), F.col("__id").alias("k1")).alias("__key")), [*part, label], cuts, 1)
    # ... side by side for each (split, class): a row meets those of its own
    c = F.col("__cuts")[0]
    mine = keys.groupBy(split_col, label).agg(F.array_sort(F.collect_list(F.struct(
        F.col("model_id").alias("m"), c["__cut"].alias("cut"), c["__key"].alias("key"), c["__equal"].alias("equal"),
        c["__take"].alias("take")))).alias("__grid"))
    j = join_null_safe(rows, materialize(mine, "sample-cuts"), [split_col, label])
    own = lambda g: F.struct(hashed(g["m"]).alias("k0"), F.col(id_col).alias("k1"))
    member = F.filter("__grid", lambda g: (g["cut"] > 0) & (own(g) <= g["key"]))
    # a row is copied only for the models it is in
    out = j.withColumn("__g", F.explode(member))
    tied = (own(F.col("__g")) == F.col("__g.key")) & (F.col("__g.take") < F.col("__g.equal"))
    keep = [*df.columns, "model_id"]
    out = out.withColumn("model_id", F.col("__g.m"))
    if not keys.where("__cuts[0].__take < __cuts[0].__equal").limit(1).count():
        return out.select(*keep)
    same = Window.partitionBy("model_id", split_col, label, "__g.key").orderBy(F.xxhash64(*df.columns))
    rest = out.where(tied).withColumn("__rn", F.row_number().over(same)).where(F.col("__rn") <= F.col("__g.take"))
    return out.where(~tied).select(*keep).unionByName(rest.select(*keep))


def fixed_sample(df: DataFrame, id_col: str, label: str, n: int, seed: int = DEFAULT_SEED,
                 digits: int | None = None) -> DataFrame:
    """Exactly n rows with class shares kept (largest remainder), only
    when the table has more than n rows; otherwise the table itself."""
    def cuts(counts):
        tot = F.sum("__nc").over(Window.partitionBy())
        want = F.least(F.lit(int(n)).cast("long"), tot)
        return largest_remainder(counts, [], label, "__nc", want, "cut_1").select(label, "cut_1")

    h = df.withColumn("__h", hash_key(id_col, seed)).withColumn("__b", hex_bucket(F.col("__h"), digits or BUCKET_DIGITS))
    seg = assign_by_rank(h, [label], "__b", [F.col("__h"), F.col(id_col)], cuts, 1, "__seg")
    return seg.where(F.col("__seg") == 0).drop("__h", "__b", "__seg")


def quantile_buckets(df: DataFrame, col: str, out: str = "__b", buckets: int = 1024) -> DataFrame:
    """Add a monotone bucket of a numeric column: bounds are approximate
    quantiles (``buckets`` values collected: a fixed bound), assigned by a
    JVM binary search (Bucketizer)."""
    from pyspark.ml.feature import Bucketizer
    qs = [i / buckets for i in range(1, buckets)]
    bounds = df.select(F.percentile_approx(F.col(col).cast("double"), qs, 10000).alias("q")).first()["q"] or []
    splits = [-float("inf")] + sorted(set(bounds)) + [float("inf")]
    x = df.withColumn("__x", F.col(col).cast("double"))
    return Bucketizer(splits=splits, inputCol="__x", outputCol=out, handleInvalid="keep").transform(x).drop("__x")


def positional_segments(df: DataFrame, order_col: str, cuts: list[int], name: str = "segment") -> DataFrame:
    """Segment of each row by its exact position under ``order_col`` (a
    unique key): position < cuts[0] -> 0, < cuts[1] -> 1, ..."""
    d = df.withColumn("__all", F.lit(0))
    if dict(df.dtypes)[order_col] == "string":  # range buckets in the text's own order
        d = d.withColumn("__b", sampled_range_bucket(d, "__all", order_col))
    else:
        d = quantile_buckets(d, order_col)
    spark = df.sparkSession
    cut_df = spark.createDataFrame([tuple([0] + [int(c) for c in cuts])],
                                   ["__all"] + [f"cut_{i + 1}" for i in range(len(cuts))])
    seg = assign_by_rank(d, ["__all"], "__b", [F.col(order_col)], cut_df, len(cuts), name)
    return seg.drop("__all", "__b")


def session_slice(df: DataFrame, order_col: str, session: int, per_session: int) -> DataFrame:
    """Rows at positions [(s-1)*n, min(s*n, N)) under ``order_col``."""
    lo, hi = (session - 1) * per_session, session * per_session
    seg = positional_segments(df, order_col, [lo, hi], "__seg")
    return seg.where(F.col("__seg") == 1).drop("__seg")


def half_split(df: DataFrame, order_col: str, name: str = "half") -> DataFrame:
    """First floor(N/2) rows by position -> 'first', the rest -> 'second'."""
    n = df.count()
    seg = positional_segments(df, order_col, [n // 2], "__seg")
    return seg.withColumn(name, F.when(F.col("__seg") == 0, "first").otherwise("second")).drop("__seg")
