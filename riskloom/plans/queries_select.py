"""Registered queries for metrics (A*) and ensemble selection (E*, S7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions.scalar import rescale_unit
from riskloom.operators import ensemble as E
from riskloom.operators import metrics as Q
from riskloom.plans.common import rounded
from riskloom.sources import adapters as A

CURVE_COLS = ["strategy", "cut", "threshold", "tn", "fp", "fn", "tp", "recall", "specificity",
              "balanced_accuracy", "accuracy", "precision", "f1", "false_alarms"]


def _model_info(scores):
    info = Q.validation_metrics(scores)
    return info.withColumn("model_type", F.when(F.col("model_id") <= 6, "depth").otherwise("leaf"))


MODEL_IDS = list(range(1, 13))


def _opt(spark, sf_dir):
    """E-2 on wide scores (the scale path: no step shuffles the score table)."""
    w = A.scores_wide(spark, sf_dir)
    return w, E.optimise_wide(w, MODEL_IDS, min_val_f1=0.01)


def _opt_long(spark, sf_dir):
    s = A.scores(spark, sf_dir)
    return s, E.optimise(s, _model_info(s), min_val_f1=0.01)


def q_class_balance(spark, sf_dir):
    return rounded(Q.class_balance(A.class_table(spark, sf_dir), "toxic"))


def q_class_weights(spark, sf_dir):
    return rounded(Q.class_weights(A.class_table(spark, sf_dir), "toxic"))


def q_model_metrics(spark, sf_dir):
    s = A.scores(spark, sf_dir)
    m = Q.evaluate(s, "score", "y", 0.5, inclusive=False, keys=["model_id"])
    return rounded(m)


def q_model_info(spark, sf_dir):
    return rounded(_model_info(A.scores(spark, sf_dir)))


def q_weighted_sq_error(spark, sf_dir):
    s = A.scores(spark, sf_dir).withColumn("e", F.col("score") * F.lit(2.0) - F.lit(1.0))
    loss = Q.weighted_sq_error(s, "e", "y", ["model_id"])
    prob = s.groupBy("model_id").agg(F.avg(rescale_unit("e")).alias("mean_prob"))
    return rounded(loss.join(prob, "model_id"))


def q_score_range(spark, sf_dir):
    return rounded(Q.score_range(A.scores(spark, sf_dir)))


def q_history_rollup(spark, sf_dir):
    h = Q.history_rollup(A.history(spark, sf_dir), chunk=3)
    return rounded(h.select("model_id", "session", "iteration", "samples_per_sec", "cumulative_samples",
                            "elapsed", "avg_throughput"))


def q_early_stop(spark, sf_dir):
    runs = A.loss_runs(spark, sf_dir)
    day = F.datediff(F.col("ts").cast("date"), F.lit("1970-01-01").cast("date"))
    return rounded(Q.early_stop(runs, ["model_id"], [F.col("ts"), F.col("event_id")], "loss", 5, bucket=day))


def q_screen_models(spark, sf_dir):
    _, o = _opt_long(spark, sf_dir)
    return rounded(o["screened"])


def q_average_scores(spark, sf_dir):
    _, o = _opt(spark, sf_dir)
    return rounded(o["combined"].select("row_id", "y", "simple_average"))


def q_weighted_scores(spark, sf_dir):
    _, o = _opt(spark, sf_dir)
    return rounded(o["combined"].select("row_id", "f1_weighted", "recall_weighted"))


def q_threshold_curve(spark, sf_dir):
    _, o = _opt(spark, sf_dir)
    return rounded(o["curve"].select(*CURVE_COLS))


def q_best_threshold(spark, sf_dir):
    _, o = _opt(spark, sf_dir)
    return rounded(o["best"].select("criterion", *CURVE_COLS))


def q_strategy_table(spark, sf_dir):
    _, o = _opt(spark, sf_dir)
    return rounded(o["strategies"].select("position", *CURVE_COLS))


def q_best_strategy(spark, sf_dir):
    _, o = _opt(spark, sf_dir)
    return rounded(o["best_strategy"].select("position", *CURVE_COLS))


def q_optimal_config(spark, sf_dir):
    _, o = _opt(spark, sf_dir)
    return rounded(E.config_table(o["best_strategy"], o["weights"]))


def q_apply_config(spark, sf_dir):
    w, o = _opt(spark, sf_dir)
    return rounded(E.apply_config_wide(w, MODEL_IDS, E.config_table(o["best_strategy"], o["weights"])))


def q_artefact_audit(spark, sf_dir):
    from riskloom.sources.audit import daily_gaps
    return daily_gaps(A.obs_daily(spark, sf_dir), ["latitude", "longitude"])


def registry() -> dict:
    return {
        "artefact_audit": q_artefact_audit,
        "class_balance": q_class_balance,
        "class_weights": q_class_weights,
        "model_metrics": q_model_metrics,
        "model_info": q_model_info,
        "weighted_sq_error": q_weighted_sq_error,
        "score_range": q_score_range,
        "history_rollup": q_history_rollup,
        "early_stop": q_early_stop,
        "screen_models": q_screen_models,
        "average_scores": q_average_scores,
        "weighted_scores": q_weighted_scores,
        "threshold_curve": q_threshold_curve,
        "best_threshold": q_best_threshold,
        "strategy_table": q_strategy_table,
        "best_strategy": q_best_strategy,
        "optimal_config": q_optimal_config,
        "apply_config": q_apply_config,
    }
