"""Exact ranks without a single-task window.

``row_number() over (partition by label order by h)`` puts a whole class
(95 % of a rare-event table) into one task. Instead every row gets a
*bucket* that is monotone in the order (hash prefix, value prefix or a
quantile bucket), and:

1. counts per (partition, bucket) are aggregated map-side (<= partitions x
   buckets rows);
2. a window over that small table gives each bucket's start offset;
3. the exact rank is start + row_number inside (partition, bucket).

``assign_by_rank`` goes further for splits and samples: it finds the exact key at
each cut position from narrow rows (the keys alone, and of those only the rows
of the buckets that hold a cut are put in order), and then every row of the
wide table is compared with its partition's cut keys: no shuffle, no window.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import materialize


def hash_key(id_col, seed) -> Column:
    """md5(seed || '-' || id): the same hex string in Spark and DuckDB. Rows
    with a null id share the key of the text 'null' and are interchangeable."""
    seed_c = seed if isinstance(seed, Column) else F.lit(str(seed))
    return F.md5(F.concat(seed_c.cast("string"), F.lit("-"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))


def join_null_safe(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a null key matches a null key; keeps the left keys."""
    named = {c: f"__on_{c}" for c in on}
    r = right.withColumnsRenamed(named)
    cond = None
    for c in on:
        one = F.col(c).eqNullSafe(F.col(named[c]))
        cond = one if cond is None else cond & one
    return left.join(r, cond, how).drop(*named.values())


# 32-bit mixing constants (golden-ratio multiplier, finaliser
# multiplier); every product stays below 2^63, so Spark and DuckDB compute
# the same BIGINTs.
GOLDEN32 = 2654435761
MIX32 = 0x45D9F3B
MOD32 = 1 << 32


def row_key32(id_col, salt: str) -> Column:
    """Unsigned 32-bit key from the first 8 hex digits of md5(salt-id)."""
    h = F.md5(F.concat(F.lit(salt), F.lit("-"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long")


def mix32(x: Column, seed: Column) -> Column:
    """Per-seed scramble of a 32-bit key: xor with a seed constant, then the
    shift-multiply finaliser. A bijection on [0, 2^32) for every seed, so
    each seed orders the rows differently from one md5 per row."""
    mod = F.lit(MOD32)
    h = x.bitwiseXOR((seed.cast("long") * F.lit(GOLDEN32)) % mod)
    h = h.bitwiseXOR(F.shiftright(h, 16))
    h = (h * F.lit(MIX32)) % mod
    h = h.bitwiseXOR(F.shiftright(h, 16))
    h = (h * F.lit(MIX32)) % mod
    return h.bitwiseXOR(F.shiftright(h, 16))


def key_bucket(h: Column, digits: int = 3) -> Column:
    """Leading hex digits of a 32-bit key: monotone in the key."""
    return F.shiftright(h, 32 - 4 * digits).cast("int")


def hex_bucket(h: Column, digits: int = 3) -> Column:
    """Leading hex digits of a hash as a number: monotone in the hash order."""
    return F.conv(F.substring(h, 1, digits), 16, 10).cast("int")


def sampled_range_bucket(df: DataFrame, part: str, value: str, buckets: int = 256, per_bucket: int = 20,
                         seed: int = 42) -> Column:
    """Monotone bucket for any orderable column: boundaries are quantiles of
    a bounded sample (about ``buckets * per_bucket`` values per part value
    collected), bucket = number of boundaries <= value (same part).

    Unlike a fixed prefix, the buckets follow the data: values sharing a
    long common prefix (ids, dates) still spread over many buckets.
    """
    counts = {r[0]: r[1] for r in df.groupBy(part).count().collect()}  # one row per part value
    want = buckets * per_bucket
    if all(n <= want for n in counts.values()):
        return F.lit(0)  # every part is small: one bucket each, no sample needed
    fractions = {p: min(1.0, want / max(n, 1)) for p, n in counts.items()}
    samples: dict = {p: [] for p in counts}
    for r in df.select(part, value).sampleBy(part, fractions, seed).collect():  # ~want rows per part
        samples[r[0]].append(r[1])
    bounds: dict = {}
    for p, vals in samples.items():
        vals = sorted(v for v in vals if v is not None)
        step = max(1, len(vals) // buckets)
        bounds[p] = sorted(set(vals[step::step]))
    if not any(bounds.values()):
        return F.lit(0)
    m = F.create_map(*[x for p, b in bounds.items() if b for x in (F.lit(p), F.array(*[F.lit(v) for v in b]))])
    arr = F.coalesce(F.element_at(m, F.col(part)), F.array().cast(f"array<{dict(df.dtypes)[value]}>"))
    return F.size(F.filter(arr, lambda b: b <= F.col(value)))


def bucket_offsets(df: DataFrame, part: list[str], bucket: str) -> DataFrame:
    """(part..., bucket, __n, __start): rows per bucket and rows before it."""
    counts = df.groupBy(*part, bucket).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*part).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("__start", F.coalesce(F.sum("__n").over(w), F.lit(0)))


def rank_in_buckets(df: DataFrame, part: list[str], bucket: str, order: list, name: str = "rank") -> DataFrame:
    """Exact 1-based rank inside ``part`` by (bucket, order)."""
    offs = bucket_offsets(df, part, bucket).drop("__n")
    w = Window.partitionBy(*part, bucket).orderBy(*order)
    ranked = df.withColumn("__lr", F.row_number().over(w))
    return (join_null_safe(ranked, offs, [*part, bucket])
            .withColumn(name, F.col("__start") + F.col("__lr")).drop("__start", "__lr"))


def cut_keys(keys: DataFrame, part: list[str], cuts, n_cuts: int) -> DataFrame:
    """The key at each cut position of each partition, written once.

    ``keys``: part..., ``__b`` (bucket, monotone in the key), ``__key`` (an
    orderable struct). ``cuts``: part... + cut_1..cut_n (non-decreasing
    positions, at most the partition's rows), or a function of the rows per
    partition (part..., __nc) that gives them. Result: part..., ``__cuts``:
    for each cut its key (null: position 0), the rows equal to the key and how
    many of them lie before the cut. One row a partition.
    """
    offs = materialize(bucket_offsets(keys, part, "__b"), "bucket-offsets")
    if callable(cuts):
        cuts = cuts(offs.groupBy(*part).agg(F.sum("__n").alias("__nc")))
    cuts = materialize(cuts.select(*part, F.array(*[F.col(f"cut_{i}").cast("long") for i in range(1, n_cuts + 1)]).alias("__at")), "cuts")
    places = cuts.select(*part, F.posexplode("__at").alias("__i", "__cut"))
    # buckets in which a cut lies; a bucket may hold several
    hits = join_null_safe(offs, places, part).where("__start < __cut AND __cut <= __start + __n")
    hits = materialize(hits.select(*part, "__b", "__i", (F.col("__cut") - F.col("__start")).alias("__place")), "cut-buckets")
    near = join_null_safe(keys, hits.select(*part, "__b").distinct(), [*part, "__b"], "left_semi")
    group = Window.partitionBy(*part, "__b")
    ranked = near.withColumns({"__lr": F.row_number().over(group.orderBy("__key")), "__first": F.rank().over(group.orderBy("__key")),
                               "__equal": F.count(F.lit(1)).over(Window.partitionBy(*part, "__b", "__key"))})
    found = join_null_safe(ranked, hits, [*part, "__b"]).where("__lr = __place").select(
        *part, "__i", "__key", "__equal", (F.col("__lr") - F.col("__first") + 1).cast("long").alias("__take"))
    return materialize(
        join_null_safe(places, found, [*part, "__i"], "left").groupBy(*part)
        .agg(F.array_sort(F.collect_list(F.struct("__i", "__cut", "__key", "__equal", "__take"))).alias("__cuts")), "cut-keys")


def assign_by_rank(df: DataFrame, part: list[str], bucket: str, order: list, cuts, n_cuts: int, name: str = "segment") -> DataFrame:
    """Segment index of each row: the number of cuts its rank exceeds.

    ``cuts`` has columns part... + cut_1..cut_n (non-decreasing rank
    positions per partition; rank <= cut_1 -> segment 0, and so on), or is a
    function of the per-partition counts (part..., __nc). A null partition
    value is a partition like any other. Rows equal in all ``order`` values are
    interchangeable; only where a cut falls between such rows are those rows,
    and no others, counted off.
    """
    key = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)])
    keys = cut_keys(df.select(*part, F.col(bucket).alias("__b"), key.alias("__key")), part, cuts, n_cuts)
    j = join_null_safe(df.withColumn("__key", key), keys, part)  # one small row a partition: broadcast by its size
    cut = lambda i: F.col("__cuts")[i]
    split = lambda i: (F.col("__key") == cut(i)["__key"]) & (cut(i)["__take"] < cut(i)["__equal"])
    past = lambda i: F.when(cut(i)["__cut"] <= 0, 1).when(F.col("__key") > cut(i)["__key"], 1).otherwise(0)
    keep = [*df.columns, name]
    seg = sum((past(i) for i in range(n_cuts)), F.lit(0))
    if not keys.where(F.exists("__cuts", lambda c: c["__take"] < c["__equal"])).limit(1).count():
        return j.withColumn(name, seg).select(*keep)
    tied = reduce(or_, [F.coalesce(split(i), F.lit(False)) for i in range(n_cuts)])
    same = Window.partitionBy(*part, "__key").orderBy(F.xxhash64(*df.columns))
    rest = j.where(tied).withColumn("__rn", F.row_number().over(same))
    counted = sum((F.when(F.coalesce(split(i), F.lit(False)), (F.col("__rn") > cut(i)["__take"]).cast("int")).otherwise(past(i))
                   for i in range(n_cuts)), F.lit(0))
    return j.where(~tied).withColumn(name, seg).select(*keep).unionByName(rest.withColumn(name, counted).select(*keep))


def largest_remainder(counts: DataFrame, part: list[str], cls: str, n_col: str, total: Column,
                      name: str) -> DataFrame:
    """Share an integer ``total`` (per partition) among classes in proportion
    to their counts: floor shares first, then one more to the largest
    remainders, lower class first on ties (own deterministic rule).

    ``counts``: part..., cls, n_col; ``total`` may refer to '__tot' (rows in
    the partition). Small table in, small table out.
    """
    wp = Window.partitionBy(*part)
    c = counts.withColumn("__tot", F.sum(n_col).over(wp)).withColumn("__want", total)
    # n_c / n * total, in this order (as the reference's splitter computes it)
    exact = F.col(n_col).cast("double") / F.col("__tot").cast("double") * F.col("__want").cast("double")
    c = c.withColumn("__fl", F.floor(exact).cast("long")).withColumn("__rem", exact - F.floor(exact))
    c = c.withColumn("__left", F.col("__want") - F.sum("__fl").over(wp))
    wr = Window.partitionBy(*part).orderBy(F.col("__rem").desc(), F.col(cls).asc_nulls_last())
    c = c.withColumn("__rr", F.row_number().over(wr))
    c = c.withColumn(name, F.col("__fl") + F.when(F.col("__rr") <= F.col("__left"), 1).otherwise(0))
    return c.drop("__tot", "__want", "__fl", "__rem", "__left", "__rr")
