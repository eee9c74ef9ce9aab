"""Registered queries of the trained models.

They use the ``full`` preset: up to 500 boosting rounds on all training rows,
each model stopped by patience 50 and kept to its best validation round. A run
is trained once per table and kept in the run store under the checkpoint
folder; the queries read what it saved. Fits have no SQL; row sets, labels and
counts do (``*_rows``).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.plans import train as T
from riskloom.sources import adapters as A

PRESET = "full"


def _run(spark, sf_dir):
    return T.trained(spark, A.training_set(spark, sf_dir), "embeddings", preset=PRESET)


def q_boosted_scores(spark, sf_dir):
    return _run(spark, sf_dir)["test_scores"]


def q_boosted_score_rows(spark, sf_dir):
    """Scored rows of both splits: labels, number of models, scores outside [0, 1]."""
    run = _run(spark, sf_dir)
    both = [run[f"{k}_scores"].withColumn("split", F.lit(k)) for k in ("val", "test")]
    return both[0].unionByName(both[1]).groupBy("split", "row_id").agg(
        F.max("y").alias("y"), F.countDistinct("model_id").alias("models"),
        F.count_if(~F.col("score").between(0.0, 1.0) | F.col("score").isNull()).alias("bad"))


def q_stacked_logistic(spark, sf_dir):
    return T.logistic_stack(_run(spark, sf_dir))


def q_stacked_forest(spark, sf_dir):
    return T.forest_stack(_run(spark, sf_dir))


def q_stacked_score_rows(spark, sf_dir):
    """Rows that each stacker scored, from the saved stacked scores, and
    whether the stacker read back from disk gives the saved score again."""
    run = _run(spark, sf_dir)
    again = (T.logistic_stack(run).withColumn("stacker", F.lit("logistic"))
             .unionByName(T.forest_stack(run).withColumn("stacker", F.lit("forest"))))
    again = again.select("stacker", "row_id", F.col("score").alias("again"), F.col("decision").alias("decided"))
    return run["stacked"].join(again, ["stacker", "row_id"], "left").select(
        "stacker", "row_id", "y", ((F.col("score") == F.col("again")) & (F.col("decision") == F.col("decided"))).alias("equal"))


def q_new_data_scores(spark, sf_dir):
    return T.score_new_data(_run(spark, sf_dir), A.training_set(spark, sf_dir))


def q_oversample_counts(spark, sf_dir):
    """Rows per (session, class, synthetic) of the oversampler's real output."""
    from riskloom.operators.oversample import smote_sessions
    out = smote_sessions(A.training_set(spark, sf_dir), "row_id", "features", "y", per_session=200)
    return out.groupBy("session", "y", "synthetic").agg(F.count(F.lit(1)).alias("n"))


def q_minority_oversample(spark, sf_dir):
    from riskloom.operators.oversample import smote_sessions
    data = A.training_set(spark, sf_dir)
    return smote_sessions(data, "row_id", "features", "y", per_session=5000).select(
        "row_id", "session", "synthetic", "y", F.size("features").alias("width"))


def q_graph_oversample(spark, sf_dir):
    """B7 over the whole table: each synthetic row with its base and neighbour."""
    from riskloom.operators.minority import oversample
    out = oversample(A.training_set(spark, sf_dir))
    return out.select("row_id", "y", "synthetic", "base", "neighbour", F.size("features").alias("width"))


def q_graph_oversample_counts(spark, sf_dir):
    return q_graph_oversample(spark, sf_dir).groupBy("y", "synthetic", "width").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("base").alias("bases"))


def q_model_shards(spark, sf_dir):
    from riskloom.plans.shard import model_shards, prepare_vectors
    vec, _ = prepare_vectors(A.obs_daily(spark, sf_dir))
    return model_shards(vec).select("row_id", "model_id", "split", "y", F.size("features").alias("width"))


def q_strategy_report(spark, sf_dir):
    return T.strategy_report(_run(spark, sf_dir))


def q_trained_model_info(spark, sf_dir):
    return _run(spark, sf_dir)["model_info"].drop("params")


def q_observation_scores(spark, sf_dir):
    """E-1 on engineered observation features: impute, encode, split,
    scale on train, 12 boosted models; test-row scores (long form)."""
    vec, _ = T.classical_vectors(A.obs_daily(spark, sf_dir))
    return T.trained(spark, vec, "observations", preset=PRESET)["test_scores"]


# -- arriving rows (L7) --------------------------------------------------------
NEW_DAYS = 10
CARRIED = ["temp_3day_avg", "temp_7day_avg", "vpd_3day_avg", "vpd_7day_avg", "humidity_3day_avg", "temp_lag1", "vpd_lag1",
           "humidity_lag1", "temp_change", "humidity_change", "vpd_change"]


def _history_and_new(obs):
    """Rows up to and after the last days: what was there, and what comes in."""
    last = obs.agg(F.max("d")).first()[0]
    border = F.date_sub(F.lit(last), NEW_DAYS)
    return obs.where(F.col("d") <= border), obs.where(F.col("d") > border)


def q_carried_features(spark, sf_dir):
    """Window features of the last days' rows from the saved last rows of the
    days before, with missing values in the sources; nothing older is read."""
    from riskloom.operators.carry import carried_features, window_state
    from riskloom.plans.common import rounded
    from riskloom.session import materialize
    history, new = _history_and_new(A.obs_daily_with_gaps(spark, sf_dir))
    out = carried_features(new, materialize(window_state(history), "window_state"))
    return rounded(out.select("latitude", "longitude", "d", "late", *CARRIED))


def q_new_observation_rows(spark, sf_dir):
    """Raw rows of the last days scored by the run trained on the days before:
    what a score must be, row by row."""
    history, new = _history_and_new(A.obs_daily(spark, sf_dir))
    run = T.train_observations(spark, history, "history", preset=PRESET)
    cut = run["config"].first()["threshold"]
    return T.score_observations(run, new).select(
        "row_id", "late", F.coalesce(F.col("score").between(0.0, 1.0), F.lit(False)).alias("in_range"),
        (F.col("decision") == (F.col("score") >= F.lit(cut)).cast("int")).alias("decided_at_cut"))


def registry() -> dict:
    return {
        "carried_features": q_carried_features,
        "new_observation_rows": q_new_observation_rows,
        "observation_scores": q_observation_scores,
        "strategy_report": q_strategy_report,
        "trained_model_info": q_trained_model_info,
        "model_shards": q_model_shards,
        "boosted_scores": q_boosted_scores,
        "boosted_score_rows": q_boosted_score_rows,
        "stacked_score_rows": q_stacked_score_rows,
        "stacked_logistic": q_stacked_logistic,
        "stacked_forest": q_stacked_forest,
        "new_data_scores": q_new_data_scores,
        "minority_oversample": q_minority_oversample,
        "graph_oversample": q_graph_oversample,
        "graph_oversample_counts": q_graph_oversample_counts,
        "oversample_counts": q_oversample_counts,
    }
