"""Training and scoring plans (E-1 second half, E-2 on trained scores, L7).

split (exact, stratified) -> scale (fit on train) -> 12 boosted models ->
wide scores for val and test -> model_info (A6 on val) -> stackers -> config.
A run's artefacts go into a ``RunStore``; everything after training reads them
from there.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.scalar import bool_target
from riskloom.operators import ensemble as E
from riskloom.operators import models as L
from riskloom.operators.boosting import RULES
from riskloom.operators.ensemble import screen_models_wide
from riskloom.operators.metrics import validation_metrics
from riskloom.operators.carry import advanced_state, carried_features, window_state
from riskloom.operators.sampling import half_split, stratified_split
from riskloom.operators.stages import MissingFills, preparation
from riskloom.plans.engineer import engineer_features, feature_columns
from riskloom.schema import Roles
from riskloom.session import checkpoint_dir, materialize
from riskloom.sources import io
from riskloom.sources.artefacts import RunStore, fingerprint, read_boosters, read_stacker, write_boosters, write_stacker


def train_ensemble(spark: SparkSession, data: DataFrame, preset: str = "full", split_preset: str = "60/20/20",
                   fit_scaler_on: str = "train", shard_train: bool = False, path: str | None = None) -> dict:
    """data: (row_id, features array<double>, y).

    ``shard_train``: each model fits its own stratified 1/12 sample of the
    train split (per-model shards, seeds 42 + m) instead of all of it.
    ``path``: folder of the fit, from which a lost one goes on."""
    s = stratified_split(data, "row_id", "y", split_preset)
    where = F.col("split") == fit_scaler_on if fit_scaler_on else None
    stats = L.fit_array_scaler(s, where=where)
    # written once: the fit, the scores and the quantiles all read it
    s = materialize(L.apply_array_scaler(s, stats), "split_scaled")
    train, val, test = (s.where(F.col("split") == k) for k in ("train", "val", "test"))
    configs = L.ensemble_configs(preset)
    per_model = None
    if shard_train:
        from riskloom.operators.sampling import stratified_samples
        shards = materialize(stratified_samples(train, "row_id", "y", "split", n_models=len(configs)), "train_shards")
        per_model = {c.model_id: shards.where(F.col("model_id") == i) for i, c in enumerate(configs, 1)}
    fitted = L.fit_ensemble(train, configs, val=val, per_model=per_model, path=path)
    rounds = spark.createDataFrame([(c.model_id, b.getNumTrees, b.rounds_fitted) for c, b in fitted],
                                   "model_id int, best_round int, stop_round int")
    # score tables are written once (the reference caches test predictions too)
    ids = [c.model_id for c, _ in fitted]
    val_wide = materialize(L.score_wide(fitted, val), "val_scores")
    test_wide = materialize(L.score_wide(fitted, test), "test_scores")
    val_scores, test_scores = L.wide_to_long(val_wide, ids), L.wide_to_long(test_wide, ids)
    info = L.model_info_table(spark, fitted, validation_metrics(val_scores)).join(rounds, "model_id", "left")
    return {"split": s, "scaler": stats, "fitted": fitted, "model_ids": ids, "val_wide": val_wide,
            "test_wide": test_wide, "val_scores": val_scores, "test_scores": test_scores, "model_info": info}


def observation_table(features: DataFrame, roles: Roles = Roles()) -> tuple[DataFrame, list[str]]:
    """(row_id, feature columns, target if there) of an engineered table, and
    the feature columns; row_id is the entity and time as text."""
    types = dict(features.dtypes)
    able = ("double", "float", "int", "bigint", "smallint", "tinyint", "string")
    feats = [c for c in feature_columns(features, roles, extra_exclude=("d", "late")) if types[c] in able]
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in roles.entity], F.col(roles.time).cast("string"))
    kept = [c for c in (roles.target, "late") if c in features.columns]
    return features.select(key.alias("row_id"), *feats, *kept), feats


def prepared_vectors(obs: DataFrame, chunk_days: int | str | None = "auto",
                     roles: Roles = Roles()) -> tuple[DataFrame, PipelineModel, list[str]]:
    """Observations -> (row_id, features array<double>, y) the way the
    classical path prepares them: engineer, median-impute numeric columns,
    mode-impute text columns, label-encode text features, 0/1 target; and the
    fitted preparation. The engineered table is written once (several passes
    read it)."""
    table, feats = observation_table(engineer_features(obs, roles, chunk_days=chunk_days), roles)
    table = materialize(table, "classical_features")
    target = MissingFills(inputCols=[roles.target]).fit(table)
    fitted = preparation(table, feats).fit(table)
    out = target.transform(fitted.transform(table))
    return out.select("row_id", "features", bool_target(roles.target).alias("y")), fitted, fitted.stages[-1].columns()


def classical_vectors(obs: DataFrame, chunk_days: int | str | None = "auto") -> tuple[DataFrame, list[str]]:
    vec, _, names = prepared_vectors(obs, chunk_days)
    return vec, names


def fit_stackers(run: dict, min_val_f1: float | None = 0.01) -> dict:
    """The logistic stacker on validation scores; the forest on the
    working models' scores of the first half of the test rows (by row_id)."""
    all_ids = run["model_ids"]
    screened = screen_models_wide(run["test_wide"], all_ids, run["model_info"], min_val_f1)
    kept = {r.model_id for r in screened.where("keep").select("model_id").collect()}  # one row per model
    positions = [i for i, m in enumerate(all_ids) if m in kept] or list(range(len(all_ids)))
    halves = materialize(half_split(L.wide_vector(run["test_wide"], positions), "row_id"), "halves")
    return {"logistic": L.fit_logistic_stacker(L.wide_vector(run["val_wide"])),
            "forest": L.fit_forest_stacker(halves.where("half = 'first'")), "halves": halves}


def logistic_stack(run: dict, cut: float = L.LOGISTIC_CUT) -> DataFrame:
    """The test rows under the saved stacker, or one fitted on validation scores."""
    model = run["stackers"]["logistic"] if "stackers" in run else L.fit_logistic_stacker(L.wide_vector(run["val_wide"]))
    return L.stacked_scores(model, L.wide_vector(run["test_wide"]), cut)


def forest_stack(run: dict, cut: float = 0.5, min_val_f1: float | None = 0.01) -> DataFrame:
    """The second half of the test rows under the saved or a fitted forest."""
    stackers = run["stackers"] if "stackers" in run else fit_stackers(run, min_val_f1)
    return L.stacked_scores(stackers["forest"], stackers["halves"].where("half = 'second'"), cut)


def strategy_report(run: dict, min_val_f1: float | None = 0.01) -> DataFrame:
    """E6 as reported: the three combinations at the chosen cut (ranked by
    balanced accuracy, listed order on ties) plus the forest stacker at the
    same cut, evaluated on the second half of the test rows and excluded
    from the choice (``note``)."""
    from riskloom.operators.metrics import evaluate
    opt = E.optimise_wide(run["test_wide"], run["model_ids"], run["model_info"], min_val_f1)
    cut = opt["strategies"].select("threshold").first()["threshold"]  # one value
    cols = ["strategy", "threshold", "recall", "specificity", "balanced_accuracy", "f1"]
    table = opt["strategies"].select(*cols).withColumn("note", F.lit(None).cast("string"))
    forest = evaluate(forest_stack(run, cut, min_val_f1), "score", "y", cut).select(
        F.lit("meta_learner").alias("strategy"), F.lit(cut).alias("threshold"), "recall", "specificity",
        "balanced_accuracy", "f1", F.lit("evaluated on 50% of the test rows").alias("note"))
    return table.unionByName(forest)


# -- artefacts (S4-S7) ---------------------------------------------------------
def save_run(store: RunStore, name: str, run: dict, about: dict | None = None, path: str | None = None,
             min_val_f1: float | None = 0.01) -> str:
    """Write scaler, models, scores, stackers, stacked scores and config of a
    run into a folder of its own, then publish it as the newest version."""
    spark, path = store.spark, path or store.begin(name)
    means, stds = run["scaler"]
    stats = spark.createDataFrame([(i, m, s) for i, (m, s) in enumerate(zip(means, stds))],
                                  "position int, mean double, std double")
    io.write_preprocessing_state(spark, f"{path}/preprocessing", stats, None, {"width": len(means)})
    write_boosters(spark, run["fitted"], path)
    # both splits side by side, one row a scored row
    wide = run["val_wide"].withColumn("split", F.lit("val")).unionByName(run["test_wide"].withColumn("split", F.lit("test")))
    io.write_table(wide, f"{path}/scores")
    io.write_table(run["model_info"], f"{path}/model_info")
    stackers = fit_stackers(run, min_val_f1)
    for kind in ("logistic", "forest"):
        write_stacker(stackers[kind], path, kind)
    io.write_table(stackers["halves"].select("row_id", "y", "sv", "half"), f"{path}/halves")
    logistic = L.stacked_scores(stackers["logistic"], L.wide_vector(run["test_wide"]), L.LOGISTIC_CUT)
    forest = L.stacked_scores(stackers["forest"], stackers["halves"].where("half = 'second'"), 0.5)
    io.write_table(logistic.withColumn("stacker", F.lit("logistic")).unionByName(forest.withColumn("stacker", F.lit("forest"))),
                   f"{path}/stacked_scores")
    # E-2 on what was written: the optimiser reads the scores, not the models
    saved = spark.read.parquet(f"{path}/scores").where("split = 'test'").drop("split")
    opt = E.optimise_wide(saved, run["model_ids"], spark.read.parquet(f"{path}/model_info"), min_val_f1)
    io.write_config(E.config_row(E.config_table(opt["best_strategy"], opt["weights"])), f"{path}/config")
    store.publish(name, path, about or {})
    return path


def load_run(store: RunStore, name: str) -> dict | None:
    """The newest published run, everything read back from its folder."""
    spark, found = store.spark, store.current(name)
    if found is None:
        return None
    path = found["path"]
    state = io.read_preprocessing_state(spark, f"{path}/preprocessing")
    st = sorted((r.position, r.mean, r.std) for r in state["scaler_stats"].collect())  # width rows
    models = read_boosters(spark, path)
    ids = [m for m, _, _, _ in models]
    wide = spark.read.parquet(f"{path}/scores")
    val_wide, test_wide = (wide.where(F.col("split") == k).drop("split") for k in ("val", "test"))
    fitted = [(L.ModelConfig(m, family, int(p["max_depth"]), p["step"], int(p["min_instances"]), int(p["rounds"]), 0, "",
                             int(p["leaves"])), b) for m, family, p, b in models]
    return {"about": found["about"], "version": found["version"], "path": path, "scaler": ([m for _, m, _ in st], [s for _, _, s in st]),
            "fitted": fitted, "model_ids": ids, "val_wide": val_wide, "test_wide": test_wide,
            "val_scores": L.wide_to_long(val_wide, ids), "test_scores": L.wide_to_long(test_wide, ids),
            "model_info": spark.read.parquet(f"{path}/model_info"),
            "stackers": {k: read_stacker(path, k) for k in ("logistic", "forest")}
            | {"halves": spark.read.parquet(f"{path}/halves")},
            "stacked": spark.read.parquet(f"{path}/stacked_scores"), "config": io.read_config(spark, f"{path}/config")}


def trained(spark: SparkSession, data: DataFrame, name: str, preset: str = "full", store: RunStore | None = None,
            **how) -> dict:
    """The published run of these rows and settings, trained first if there is
    none. Rows are known by their fingerprint, so a changed table is trained
    anew; a training that was lost half-way goes on from its fit's folder."""
    store = store or RunStore(spark, f"{checkpoint_dir(spark).rstrip('/')}/runs")
    about = {"rows": fingerprint(data), "rules": RULES, "preset": preset, "how": {k: str(v) for k, v in sorted(how.items())}}
    run = load_run(store, name)
    if run is None or run["about"] != about:
        key = F.sha2(F.lit(str(about)), 256)
        folder = f"{store.base}/{name}/fit-{spark.range(1).select(key).first()[0][:16]}"
        save_run(store, name, train_ensemble(spark, data, preset=preset, path=folder, **how), about)
        run = load_run(store, name)
    return run


# -- L7 --------------------------------------------------------------------------
def score_new_data(run: dict, data: DataFrame) -> DataFrame:
    """Saved scaler -> each saved model -> the saved config's weights and cut.
    ``data``: (row_id, features array<double>[, y])."""
    wide = L.score_wide(run["fitted"], L.apply_array_scaler(data, run["scaler"]))
    config = run["config"].first()  # one row
    s = F.lit(0.0)
    for m, w in zip(config["model_ids"], config["weights"]):
        s = s + F.lit(float(w)) * F.element_at("scores", run["model_ids"].index(m) + 1)
    return wide.select("row_id", "y", s.alias("score"),
                       F.coalesce(s >= F.lit(float(config["threshold"])), F.lit(False)).cast("int").alias("decision"))


def train_observations(spark: SparkSession, obs: DataFrame, name: str, preset: str = "full",
                       store: RunStore | None = None, roles: Roles = Roles()) -> dict:
    """E-1 from raw observations, published with all that later rows need: the
    fitted preparation and the window state beside models, scaler and config."""
    store = store or RunStore(spark, f"{checkpoint_dir(spark).rstrip('/')}/runs")
    about = {"rows": fingerprint(obs), "rules": RULES, "preset": preset}
    run = load_run(store, name)
    if run is None or run["about"] != about:
        path = store.begin(name)
        vec, fitted, _ = prepared_vectors(obs, roles=roles)
        fitted.write().save(f"{path}/preparation")
        io.write_table(window_state(obs, roles), f"{path}/window_state")
        save_run(store, name, train_ensemble(spark, vec, preset=preset), about, path)
        run = load_run(store, name)
    return run | {"preparation": PipelineModel.load(f"{run['path']}/preparation"),
                  "window_state": spark.read.parquet(f"{run['path']}/window_state")}


def score_observations(run: dict, new: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """L7 from raw rows: (row_id, late, score, decision) of arriving
    observations by the run's window state, preparation, scaler, models,
    weights and cut."""
    table, _ = observation_table(carried_features(new, run["window_state"], roles), roles)
    ready = run["preparation"].transform(table).select("row_id", "features", F.col("late").cast("int").alias("y"))
    return score_new_data(run, ready).select("row_id", (F.col("y") == 1).alias("late"), "score", "decision")


def carry_on(store: RunStore, run: dict, name: str, new: DataFrame, roles: Roles = Roles()) -> str:
    """Write the window state that holds ``new`` too beside the run's own;
    returns its folder. The published run stays as it is."""
    path = f"{store.begin(name)}/window_state"
    io.write_table(advanced_state(run["window_state"], new, roles), path)
    return path
