"""Ensemble selection after training.

Input is the long score table (row_id, model_id, score, y). Per-row
combinations run as one ``groupBy(row_id)`` whose groups hold one value per
model (bounded by the model count); each row sums its models' terms in
model order, so results are deterministic under retries and match the
reference's matrix products.

The threshold sweep (E4) is one pass: a row's score becomes k = the number
of grid cuts it clears; counts by (strategy, k, label) - at most
strategies x 42 x 2 rows - give every cut's confusion counts through reverse
cumulative sums. E5-E7 then work on those tiny tables only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.scalar import decide
from riskloom.operators.metrics import metric_columns
from riskloom.session import materialize

# The threshold grid is arange(0.20, 0.61, 0.01) - 41 cuts;
# strategies in the order the reference lists (and breaks ties by).
GRID_START, GRID_STOP, GRID_STEP = 0.20, 0.61, 0.01
STRATEGIES = ["simple_average", "f1_weighted", "recall_weighted"]
SCREEN_CUT = 0.5


def threshold_grid(start: float = GRID_START, stop: float = GRID_STOP, step: float = GRID_STEP) -> list[float]:
    """The grid as numpy builds it: start + i * ((start + step) - start)."""
    import math
    n = int(math.ceil((stop - start) / step))
    delta = (start + step) - start
    return [start + i * delta for i in range(n)]


# -- E1 ------------------------------------------------------------------------
def screen_models(scores: DataFrame, model_info: DataFrame | None = None, min_val_f1: float | None = 0.01,
                  cut: float = SCREEN_CUT) -> DataFrame:
    """(model_id, positives, negatives, val_f1, keep): keep a model when its
    decisions at ``cut`` contain both classes [and val_f1 > min_val_f1]."""
    d = decide("score", cut)
    s = scores.groupBy("model_id").agg(F.count_if(d == 1).alias("positives"), F.count_if(d == 0).alias("negatives"))
    diverse = (F.col("positives") > 0) & (F.col("negatives") > 0)
    if model_info is not None and min_val_f1 is not None:
        s = s.join(model_info.select("model_id", "val_f1"), "model_id", "left")
        keep = diverse & F.coalesce(F.col("val_f1") > F.lit(float(min_val_f1)), F.lit(False))
    else:
        s = s.withColumn("val_f1", F.lit(None).cast("double"))
        keep = diverse
    return s.withColumn("keep", keep)


def working_scores(scores: DataFrame, screened: DataFrame) -> DataFrame:
    return scores.join(F.broadcast(screened.where("keep").select("model_id")), "model_id", "left_semi")


# -- E3 weights ----------------------------------------------------------------
def strategy_weights(screened: DataFrame, model_info: DataFrame, missing: str = "error",
                     default_f1: float = 0.1, default_recall: float = 0.5) -> DataFrame:
    """(model_id, simple_average, f1_weighted, recall_weighted) for kept
    models: 1/k, metric / sum(metric); a zero sum falls back to 1/k.

    A kept model without val_f1/val_recall is an error (``missing='error'``)
    or gets the explicit defaults (``missing='default'``, the values the
    reference's second optimiser falls back to, which make the weighted
    strategies equal the simple average)."""
    kept = screened.where("keep").select("model_id").join(
        model_info.select("model_id", "val_f1", "val_recall"), "model_id", "left")
    if missing == "error":
        # fails the job that reads the weights, without a separate pass
        lacking = F.col("val_f1").isNull() | F.col("val_recall").isNull()
        msg = F.concat(F.lit("model without validation metrics: "), F.col("model_id").cast("string"))
        kept = kept.withColumns({c: F.when(lacking, F.raise_error(msg).cast("double")).otherwise(F.col(c))
                                 for c in ("val_f1", "val_recall")})
    elif missing == "default":
        kept = kept.withColumns({"val_f1": F.coalesce("val_f1", F.lit(float(default_f1))),
                                 "val_recall": F.coalesce("val_recall", F.lit(float(default_recall)))})
    else:
        raise ValueError(missing)
    # sums run in model order (ordered full frame), so weights are the same
    # bits on every run and every retry
    w = Window.orderBy("model_id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    k = F.count(F.lit(1)).over(w).cast("double")
    out = {"simple_average": F.lit(1.0) / k}
    for name, col in (("f1_weighted", "val_f1"), ("recall_weighted", "val_recall")):
        tot = F.sum(col).over(w)
        out[name] = F.when(tot > 0, F.col(col) / tot).otherwise(F.lit(1.0) / k)
    return kept.select("model_id", *[v.alias(n) for n, v in out.items()])


# -- E2/E3 combination ------------------------------------------------------------
def combine_scores(scores: DataFrame, weights: DataFrame) -> DataFrame:
    """Per row: simple average (sum / k, E2) and metric-weighted sums (E3),
    each summed in model order. Weights have one row per model (broadcast)."""
    j = scores.join(F.broadcast(weights), "model_id", "inner")
    g = j.groupBy("row_id").agg(
        F.array_sort(F.collect_list(F.struct("model_id", "score", *STRATEGIES[1:]))).alias("m"),
        F.max("y").alias("y"))

    def wsum(name):
        return F.aggregate("m", F.lit(0.0), lambda acc, e: acc + e[name] * e["score"])

    simple = F.aggregate("m", F.lit(0.0), lambda acc, e: acc + e["score"]) / F.size("m").cast("double")
    return g.select("row_id", "y", simple.alias("simple_average"), wsum("f1_weighted").alias("f1_weighted"),
                    wsum("recall_weighted").alias("recall_weighted"))


def stack_strategies(combined: DataFrame, strategies=tuple(STRATEGIES)) -> DataFrame:
    """Wide per-row strategy scores -> long (strategy, row_id, score, y)."""
    arms = [F.struct(F.lit(s).alias("strategy"), F.col(s).alias("score")) for s in strategies]
    return combined.select("row_id", "y", F.explode(F.array(*arms)).alias("e")).select(
        "e.strategy", "row_id", "e.score", "y")


# -- E4 ------------------------------------------------------------------------
def cut_counts(long_scores: DataFrame, grid: list[float] | None = None, keys=("strategy",),
               score: str = "score", label: str = "y") -> DataFrame:
    """(keys..., cut, threshold, tn, fp, fn, tp) for every grid cut in one pass."""
    grid = grid or threshold_grid()
    keys = list(keys)
    g = F.array(*[F.lit(float(t)) for t in grid])
    s = F.nanvl(F.col(score), F.lit(None).cast("double"))
    k = F.coalesce(F.size(F.filter(g, lambda t: s >= t)), F.lit(0))
    hist = long_scores.groupBy(*keys, k.alias("k"), F.col(label).alias("y")).agg(F.count(F.lit(1)).alias("n"))
    # tiny table: expand to (cut, k) pairs and fold: decision at cut i is 1 iff k > i
    cuts = hist.withColumn("cut", F.explode(F.sequence(F.lit(0), F.lit(len(grid) - 1))))
    pos = (F.col("k") > F.col("cut"))
    c = cuts.groupBy(*keys, "cut").agg(
        F.sum(F.when(pos & (F.col("y") == 1), F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.when(pos & (F.col("y") != 1), F.col("n")).otherwise(0)).alias("fp"),
        F.sum(F.when(~pos & (F.col("y") == 1), F.col("n")).otherwise(0)).alias("fn"),
        F.sum(F.when(~pos & (F.col("y") != 1), F.col("n")).otherwise(0)).alias("tn"))
    return c.withColumn("threshold", F.element_at(g, F.col("cut") + 1))


def threshold_curve(long_scores: DataFrame, grid: list[float] | None = None, keys=("strategy",)) -> DataFrame:
    """Every A5 metric at every cut."""
    return cut_counts(long_scores, grid, keys).withColumns(metric_columns())


# -- E5 ------------------------------------------------------------------------
def best_thresholds(curve: DataFrame, keys=("strategy",)) -> DataFrame:
    """E5: for each criterion (accuracy, balanced_accuracy) the cut with the
    highest value; the lowest cut wins ties."""
    keys = list(keys)
    outs = []
    for crit in ("accuracy", "balanced_accuracy"):
        w = Window.partitionBy(*keys).orderBy(F.col(crit).desc(), F.col("cut").asc())
        outs.append(curve.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")
                    .withColumn("criterion", F.lit(crit)))
    return outs[0].unionByName(outs[1])


# -- E6/E7 ---------------------------------------------------------------------
def strategy_table(curve: DataFrame, chosen_cut: DataFrame) -> DataFrame:
    """Every strategy's metrics at the chosen cut (``chosen_cut``: one row
    with column ``cut``), with its listing position."""
    order = F.array_position(F.array(*[F.lit(s) for s in STRATEGIES]), F.col("strategy")).cast("int")
    return (curve.join(F.broadcast(chosen_cut.select("cut")), "cut", "inner")
            .withColumn("position", order))


def best_strategy(table: DataFrame) -> DataFrame:
    """Highest balanced accuracy; listed order breaks ties."""
    return table.orderBy(F.col("balanced_accuracy").desc(), F.col("position").asc()).limit(1)


def optimise(scores: DataFrame, model_info: DataFrame, min_val_f1: float | None = 0.01,
             grid: list[float] | None = None) -> dict[str, DataFrame]:
    """E-2 end to end: screen -> combine -> sweep -> best cut (balanced
    accuracy on the simple average) -> strategies at that cut -> best."""
    screened = screen_models(scores, model_info, min_val_f1)
    weights = strategy_weights(screened, model_info)
    combined = combine_scores(working_scores(scores, screened), weights)
    # at most 41 rows a strategy: stored once, so that the scores are read once
    curve = materialize(threshold_curve(stack_strategies(combined), grid), "curve")
    best = best_thresholds(curve)
    chosen = best.where((F.col("strategy") == "simple_average") & (F.col("criterion") == "balanced_accuracy"))
    table = strategy_table(curve, chosen)
    top = best_strategy(table)
    return {"screened": screened, "weights": weights, "combined": combined, "curve": curve, "best": best,
            "strategies": table, "best_strategy": top}


# -- E8 / S7 -------------------------------------------------------------------
def config_table(top: DataFrame, weights: DataFrame) -> DataFrame:
    """Long config: (threshold, strategy, model_id, weight, performance...)."""
    long_w = weights.select("model_id", F.explode(F.array(*[
        F.struct(F.lit(s).alias("strategy"), F.col(s).alias("weight")) for s in STRATEGIES])).alias("e")) \
        .select("model_id", "e.strategy", "e.weight")
    return top.select("strategy", "threshold", "balanced_accuracy", "f1", "recall", "specificity") \
        .join(long_w, "strategy", "inner")


def config_row(long_config: DataFrame) -> DataFrame:
    """S7 shape: one row, weights and model ids as arrays in model order,
    performance nested."""
    g = long_config.groupBy("strategy", "threshold", "balanced_accuracy", "f1", "recall", "specificity").agg(
        F.array_sort(F.collect_list(F.struct("model_id", "weight"))).alias("m"))
    return g.select("threshold", "strategy", F.transform("m", lambda e: e["weight"]).alias("weights"),
                    F.transform("m", lambda e: e["model_id"]).alias("model_ids"),
                    F.struct("balanced_accuracy", "f1", "recall", "specificity").alias("performance"))


def apply_config(scores: DataFrame, long_config: DataFrame) -> DataFrame:
    """Weighted score per row from the config's weights, decided at its
    cut. The config holds one row per model (broadcast)."""
    w = long_config.select("model_id", "weight", "threshold")
    j = scores.join(F.broadcast(w), "model_id", "inner")
    g = j.groupBy("row_id").agg(F.array_sort(F.collect_list(F.struct("model_id", "score", "weight"))).alias("m"),
                                F.max("threshold").alias("threshold"))
    s = F.aggregate("m", F.lit(0.0), lambda acc, e: acc + e["weight"] * e["score"])
    return g.select("row_id", s.alias("score"), "threshold").withColumn(
        "decision", decide(F.col("score"), F.col("threshold")))


def column(c) -> Column:  # small helper for callers composing their own decisions
    return F.col(c) if isinstance(c, str) else c


# -- wide form: one score array per row (model order) -------------------------
# Applying every model to the same row yields the scores side by side; kept
# that way, per-model statistics are one global partial aggregation and the
# combinations are projections, so no step shuffles rows x models values.
def _score(i: int, scores: str = "scores") -> Column:
    return F.element_at(F.col(scores), i + 1)


def long_view(wide: DataFrame, model_ids: list[int], label: str = "y", scores: str = "scores") -> DataFrame:
    """(row_id, model_id, score, y) from wide scores by posexplode: no shuffle.
    Per-model statistics run on this view as ``groupBy(model_id)``, which
    Spark combines map-side to at most one row per model per task."""
    ids = F.array(*[F.lit(int(m)) for m in model_ids])
    return wide.select("row_id", F.col(label).alias("y"), F.posexplode(scores).alias("__pos", "score")).select(
        "row_id", F.element_at(ids, F.col("__pos") + 1).alias("model_id"), "score", "y")


def confusion_wide(wide: DataFrame, model_ids: list[int], threshold: float = SCREEN_CUT, inclusive: bool = True,
                   label: str = "y", scores: str = "scores") -> DataFrame:
    """(model_id, tn, fp, fn, tp) for every model."""
    from riskloom.operators.metrics import confusion
    lv = long_view(wide, model_ids, label, scores)
    return confusion(lv.withColumn("__d", decide("score", threshold, inclusive)), "__d", "y", ["model_id"])


def validation_metrics_wide(wide: DataFrame, model_ids: list[int], threshold: float = 0.5,
                            label: str = "y", scores: str = "scores") -> DataFrame:
    """A6 on wide scores: F1 / recall / precision per model at score > cut."""
    from riskloom.operators.metrics import validation_metrics
    return validation_metrics(long_view(wide, model_ids, label, scores), threshold)


def score_range_wide(wide: DataFrame, model_ids: list[int], scores: str = "scores") -> DataFrame:
    from riskloom.operators.metrics import score_range
    return score_range(long_view(wide, model_ids, scores=scores))


def screen_models_wide(wide: DataFrame, model_ids: list[int], model_info: DataFrame | None = None,
                       min_val_f1: float | None = 0.01, cut: float = SCREEN_CUT, scores: str = "scores") -> DataFrame:
    """E1 on wide scores (same output as ``screen_models``)."""
    return screen_models(long_view(wide, model_ids, scores=scores), model_info, min_val_f1, cut)


def combine_wide(wide: DataFrame, model_ids: list[int], weights: DataFrame, label: str = "y",
                 scores: str = "scores") -> DataFrame:
    """E2/E3 as one projection. ``weights`` (one row per kept model: a fixed
    bound) is collected; each strategy is an unrolled left-to-right sum over
    the kept models in model order, the same arithmetic as ``combine_scores``."""
    w = {r["model_id"]: r for r in weights.collect()}
    kept = [(i, m) for i, m in enumerate(model_ids) if m in w]
    if not kept:
        raise ValueError("no model passed screening")
    simple = F.lit(0.0)
    f1w = F.lit(0.0)
    recw = F.lit(0.0)
    for i, m in kept:
        s = _score(i, scores)
        simple = simple + s
        f1w = f1w + F.lit(float(w[m]["f1_weighted"])) * s
        recw = recw + F.lit(float(w[m]["recall_weighted"])) * s
    return wide.select("row_id", F.col(label).alias("y"), (simple / F.lit(float(len(kept)))).alias("simple_average"),
                       f1w.alias("f1_weighted"), recw.alias("recall_weighted"))


def optimise_wide(wide: DataFrame, model_ids: list[int], model_info: DataFrame | None = None,
                  min_val_f1: float | None = 0.01, grid: list[float] | None = None) -> dict[str, DataFrame]:
    """E-2 on wide scores: no step shuffles the score table."""
    info = model_info if model_info is not None else validation_metrics_wide(wide, model_ids)
    screened = screen_models_wide(wide, model_ids, info, min_val_f1)
    weights = strategy_weights(screened, info)
    combined = combine_wide(wide, model_ids, weights)
    # at most 41 rows a strategy: stored once, so that the scores are read once
    curve = materialize(threshold_curve(stack_strategies(combined), grid), "curve")
    best = best_thresholds(curve)
    chosen = best.where((F.col("strategy") == "simple_average") & (F.col("criterion") == "balanced_accuracy"))
    table = strategy_table(curve, chosen)
    return {"model_info": info, "screened": screened, "weights": weights, "combined": combined, "curve": curve,
            "best": best, "strategies": table, "best_strategy": best_strategy(table)}


def apply_config_wide(wide: DataFrame, model_ids: list[int], long_config: DataFrame,
                      scores: str = "scores") -> DataFrame:
    """E8 on wide scores: one projection with the config's weights and cut."""
    rows = long_config.select("model_id", "weight", "threshold").collect()  # one row per model
    w = {r["model_id"]: float(r["weight"]) for r in rows}
    cut = float(rows[0]["threshold"])
    s = F.lit(0.0)
    for i, m in enumerate(model_ids):
        if m in w:
            s = s + F.lit(w[m]) * _score(i, scores)
    return wide.select("row_id", s.alias("score"), F.lit(cut).alias("threshold")).withColumn(
        "decision", decide(F.col("score"), F.col("threshold")))
