"""Class balance, weights, confusion counts and derived metrics (A1-A10).

All are aggregations with bounded buffers (counts, sums, min/max), so Spark
combines them map-side; grouped variants take ``keys`` (e.g. model_id).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.scalar import decide, sign_decision, signed_label
from riskloom.operators.scan import prefix_agg

METRICS = ["recall", "specificity", "balanced_accuracy", "accuracy", "precision", "f1"]


def _ratio(num: Column, den: Column) -> Column:
    """num/den as double, 0 when the denominator is 0 (guarded form)."""
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


# -- A1-A3 --------------------------------------------------------------------
def class_balance(df: DataFrame, label: str) -> DataFrame:
    """A1/A2: one row: n, positives, positive_share, pos_weight = n_neg/n_pos (NULL without positives)."""
    y = F.col(label)
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_if(y == 1).alias("positives")).select(
        "n", "positives", _ratio(F.col("positives"), F.col("n")).alias("positive_share"),
        F.when(F.col("positives") > 0, (F.col("n") - F.col("positives")).cast("double") / F.col("positives"))
        .alias("pos_weight"))


def class_weights(df: DataFrame, label: str, classes=(0, 1)) -> DataFrame:
    """A3: (label, n_class, weight): n / (2 * n_class); all 1 when a class is empty."""
    y = F.col(label)
    tot = df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(y == c).alias(f"n{i}") for i, c in enumerate(classes)])
    any_empty = F.lit(False)
    for i in range(len(classes)):
        any_empty = any_empty | (F.col(f"n{i}") == 0)
    arms = [F.struct(F.lit(c).alias(label), F.col(f"n{i}").alias("n_class"),
                     F.when(any_empty, F.lit(1.0))
                     .otherwise(F.col("n").cast("double") / (F.lit(float(len(classes))) * F.col(f"n{i}")))
                     .alias("weight")) for i, c in enumerate(classes)]
    return tot.select(F.explode(F.array(*arms)).alias("e")).select("e.*")


# -- A4/A5 ---------------------------------------------------------------------
def confusion(df: DataFrame, pred: str, label: str, keys: list[str] | None = None) -> DataFrame:
    """A4: tn, fp, fn, tp (always all four) per keys."""
    p, y = F.col(pred), F.col(label)
    aggs = [F.count_if((p == 0) & (y == 0)).alias("tn"), F.count_if((p == 1) & (y == 0)).alias("fp"),
            F.count_if((p == 0) & (y == 1)).alias("fn"), F.count_if((p == 1) & (y == 1)).alias("tp")]
    return df.groupBy(*(keys or [])).agg(*aggs)


def metric_columns(tn="tn", fp="fp", fn="fn", tp="tp") -> dict[str, Column]:
    """A5 over confusion counts; every zero denominator gives 0."""
    tn, fp, fn, tp = (F.col(x) for x in (tn, fp, fn, tp))
    recall = _ratio(tp, tp + fn)
    spec = _ratio(tn, tn + fp)
    return {
        "recall": recall,
        "specificity": spec,
        "balanced_accuracy": (recall + spec) / F.lit(2.0),
        "accuracy": _ratio(tp + tn, tp + tn + fp + fn),
        "precision": _ratio(tp, tp + fp),
        "f1": _ratio(F.lit(2) * tp, (tp + fn) + (tp + fp)),
        "false_alarms": fp,
    }


def with_metrics(counts: DataFrame) -> DataFrame:
    return counts.withColumns(metric_columns())


def evaluate(df: DataFrame, score: str, label: str, threshold: float, inclusive: bool = True,
             keys: list[str] | None = None) -> DataFrame:
    """P9 + A4 + A5 in one aggregation."""
    d = df.withColumn("__pred", decide(score, threshold, inclusive))
    return with_metrics(confusion(d, "__pred", label, keys))


def validation_metrics(scores: DataFrame, threshold: float = 0.5, model_col: str = "model_id",
                       score: str = "score", label: str = "y") -> DataFrame:
    """Per model F1 / recall / precision at score > 0.5 (exclusive cut)."""
    m = evaluate(scores, score, label, threshold, inclusive=False, keys=[model_col])
    return m.select(model_col, F.col("f1").alias("val_f1"), F.col("recall").alias("val_recall"),
                    F.col("precision").alias("val_precision"))


# -- A7/A8 ---------------------------------------------------------------------
def weighted_sq_error(df: DataFrame, expectation: str, label: str, keys: list[str] | None = None) -> DataFrame:
    """mean(w_y * (e - (2y - 1))^2) with A3 weights, plus sign-decision accuracy (P10)."""
    if not keys:
        df, keys, drop = df.withColumn("__g", F.lit(0)), ["__g"], True
    else:
        drop = False
    # one pass: sums per class, then the class weights on those sums
    y = (F.col(label) == 1).cast("int")
    err = F.col(expectation) - signed_label(F.col(label)).cast("double")
    per = df.groupBy(*keys, y.alias("__y")).agg(
        F.count(F.lit(1)).alias("__n"), F.count(err).alias("__ne"), F.sum(err * err).alias("__e"),
        F.sum((sign_decision(expectation) == F.col(label)).cast("double")).alias("__a"),
        F.count(sign_decision(expectation) == F.col(label)).alias("__na"))
    n, p = F.sum("__n"), F.sum(F.when(F.col("__y") == 1, F.col("__n")).otherwise(0))
    one = lambda c, v: F.coalesce(F.sum(F.when(F.coalesce(F.col("__y"), F.lit(0)) == v, F.col(c))), F.lit(0))
    tot = per.groupBy(*keys).agg(n.alias("n"), p.alias("p"), *[one(c, v).alias(f"{c}{v}") for c in ("__ne", "__e") for v in (0, 1)],
                                 F.sum("__a").alias("a"), F.sum("__na").alias("na"))
    nd, pd_ = F.col("n").cast("double"), F.col("p").cast("double")
    single = (F.col("p") == 0) | (F.col("p") == F.col("n"))
    w1 = F.when(single, 1.0).otherwise(F.try_divide(nd, 2.0 * pd_))
    w0 = F.when(single, 1.0).otherwise(F.try_divide(nd, 2.0 * (nd - pd_)))
    loss = F.try_divide(F.coalesce(w1, F.lit(0.0)) * F.col("__e1") + F.coalesce(w0, F.lit(0.0)) * F.col("__e0"), F.col("__ne0") + F.col("__ne1"))
    out = tot.select(*keys, loss.alias("loss"), F.try_divide(F.col("a"), F.col("na")).alias("accuracy"))
    return out.drop("__g") if drop else out


def score_range(df: DataFrame, score: str = "score", keys=("model_id",)) -> DataFrame:
    """Min / max score per model."""
    return df.groupBy(*keys).agg(F.min(score).alias("min_score"), F.max(score).alias("max_score"))


# -- A9/A10 ----------------------------------------------------------------------
def history_rollup(hist: DataFrame, run=("model_id", "session"), iteration: str = "iteration",
                   samples: str = "samples", seconds: str = "seconds", chunk: int | None = 4096) -> DataFrame:
    """Throughput per iteration, cumulative samples, running average
    throughput (cumulative samples / cumulative seconds)."""
    bucket = F.floor(F.col(iteration) / F.lit(chunk)) if chunk else None
    r = prefix_agg(hist, list(run), [F.col(iteration)],
                   {"cumulative_samples": ("sum", samples, True), "elapsed": ("sum", seconds, True)}, bucket)
    return r.withColumns({
        "samples_per_sec": F.when(F.col(seconds) > 0, F.col(samples) / F.col(seconds)).otherwise(F.lit(0.0)),
        "avg_throughput": F.when(F.col("elapsed") > 0, F.col("cumulative_samples") / F.col("elapsed"))
        .otherwise(F.lit(0.0)),
    })


def early_stop(runs: DataFrame, run: list[str], order: list, loss: str = "loss", patience: int = 5,
               bucket: Column | None = None) -> DataFrame:
    """A10: per run, the iteration where training stops: the first with
    ``patience`` consecutive losses not below the best so far (NULL if never),
    with the best loss and its iteration up to that point.

    iteration = 1-based position in ``order``. Two prefix scans (chunkable by
    a monotone ``bucket``) and one aggregation: the values at the stop row
    (or the last row) are picked with min_by / max_by, no join.
    """
    step = prefix_agg(runs, run, order, {"iteration": ("count", F.lit(1), True),
                                         "__prev_best": ("min", loss, False),
                                         "__best": ("min", loss, True)}, bucket)
    improved = F.col("__prev_best").isNull() | (F.col(loss) < F.col("__prev_best"))
    step = step.withColumn("__impr_it", F.when(improved, F.col("iteration")))
    step = prefix_agg(step, run, order, {"__last_impr": ("max", "__impr_it", True)}, bucket)
    stop = (F.col("iteration") - F.col("__last_impr")) >= patience
    state = F.struct(F.col("iteration").alias("it"), F.col("__best").alias("best"),
                     F.col("__last_impr").alias("best_it"))
    agg = step.groupBy(*run).agg(
        F.count(F.lit(1)).alias("iterations"),
        F.min(F.when(stop, F.col("iteration"))).alias("stop_iteration"),
        F.min_by(state, F.when(stop, F.col("iteration"))).alias("__at_stop"),
        F.max_by(state, F.col("iteration")).alias("__at_end"))
    at = F.coalesce(F.col("__at_stop"), F.col("__at_end"))
    return agg.select(*run, "iterations", at["it"].alias("iterations_run"), "stop_iteration",
                      at["best"].alias("best_loss"), at["best_it"].alias("best_iteration"))
