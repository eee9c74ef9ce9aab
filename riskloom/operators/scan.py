"""Prefix (running) aggregates that survive a hot partition key.

``prefix_agg`` computes running sum/min/max/count per ``part`` in ``order``.
Without ``bucket`` it is one window per part. With a ``bucket`` column that
is monotone in the order (e.g. iteration // 4096, or the day of a
timestamp), windows run per (part, bucket) - so a run holding a third of all
rows is spread over many tasks - and each bucket's carry-in comes from a
small per-bucket totals table, windowed by part and joined back on the same
keys as the window partitioning (no re-shuffle of the big side).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_FN = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count}


def _combine(fn: str, carry: Column, local: Column) -> Column:
    if fn in ("sum", "count"):
        if fn == "count":
            return F.coalesce(carry, F.lit(0)) + F.coalesce(local, F.lit(0))
        return F.when(carry.isNull(), local).when(local.isNull(), carry).otherwise(carry + local)
    return F.least(carry, local) if fn == "min" else F.greatest(carry, local)


def prefix_agg(df: DataFrame, part: list[str], order: list, aggs: dict[str, tuple[str, object, bool]],
               bucket: Column | None = None) -> DataFrame:
    """aggs: name -> (fn in sum|min|max|count, column or expression, inclusive).
    inclusive=True: rows up to and including the current one; False: strictly before."""
    def src(c):
        return F.col(c) if isinstance(c, str) else c

    if bucket is None:
        w = Window.partitionBy(*part).orderBy(*order)
        exprs = {}
        for name, (fn, c, inc) in aggs.items():
            frame = w.rowsBetween(Window.unboundedPreceding, 0 if inc else -1)
            exprs[name] = _FN[fn](src(c)).over(frame)
            if fn == "count":
                exprs[name] = F.coalesce(exprs[name], F.lit(0))
        return df.withColumns(exprs)

    d = df.withColumn("__pb", bucket)
    pk = [*part, "__pb"]
    w = Window.partitionBy(*pk).orderBy(*order)
    local = {}
    totals = {}
    for i, (name, (fn, c, inc)) in enumerate(aggs.items()):
        frame = w.rowsBetween(Window.unboundedPreceding, 0 if inc else -1)
        local[f"__loc{i}"] = _FN[fn](src(c)).over(frame)
        totals[f"__tot{i}"] = _FN[fn](src(c))
    d = d.withColumns(local)
    t = d.groupBy(*pk).agg(*[v.alias(k) for k, v in totals.items()])
    wt = Window.partitionBy(*part).orderBy("__pb").rowsBetween(Window.unboundedPreceding, -1)
    carry_fn = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
    carries = t.select(*pk, *[carry_fn[fn](f"__tot{i}").over(wt).alias(f"__car{i}")
                              for i, (_, (fn, _c, _inc)) in enumerate(aggs.items())])
    j = d.join(carries, on=pk, how="left")
    out = j.withColumns({name: _combine(fn, F.col(f"__car{i}"), F.col(f"__loc{i}"))
                         for i, (name, (fn, _c, _inc)) in enumerate(aggs.items())})
    return out.drop("__pb", *local, *[f"__car{i}" for i in range(len(aggs))])
