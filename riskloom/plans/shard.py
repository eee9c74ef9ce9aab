"""Shard preparation (E-3): observations -> 64-wide scaled vectors -> exact
70/15/15 split -> 12 overlapping per-model stratified samples -> one Parquet
table partitioned by (model_id, split).

One lazy plan up to the sink; the only driver round trips are bounded
statistics (scaler means/stds, one row per feature).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.scalar import assemble_array, bool_target, fit_width, narrow_feature, narrow_target
from riskloom.operators.prepare import apply_scaler, fit_scaler
from riskloom.operators.sampling import stratified_samples, stratified_split
from riskloom.plans.engineer import engineer_features, feature_columns
from riskloom.schema import Roles, require_columns
from riskloom.session import materialize

WIDTH = 64
N_MODELS = 12


def prepare_vectors(obs: DataFrame, roles: Roles = Roles(), width: int = WIDTH, fit_on_all: bool = True,
                    chunk_days: int | str | None = "auto", id_col: str = "row_id",
                    write_once: bool = True) -> tuple[DataFrame, list[str]]:
    """(row_id, features array<double>[width], y) plus the feature names.

    row_id is the entity/time key as text (unique by construction). Target:
    yes/true/1 text -> 1 (P5). Scaling is fitted on all rows as the 64-wide
    path does (``fit_on_all=False`` leaves scaling to the caller).
    """
    require_columns(obs, [roles.target], "target column")
    eng = engineer_features(obs, roles, chunk_days=chunk_days)
    feats = [c for c in feature_columns(eng, roles, extra_exclude=("d",))
             if dict(eng.dtypes)[c] not in ("string", "date", "timestamp", "timestamp_ntz")]
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in roles.entity], F.col(roles.time).cast("string"))
    # narrowed to float32 before scaling, as the 64-wide path does (P6);
    # also halves the bytes of the table written below
    x = eng.select(key.alias(id_col), *[narrow_feature(c).alias(c) for c in feats],
                   narrow_target(bool_target(roles.target)).cast("int").alias("y"))
    if write_once:
        # the scaler fit, the split counts and the sample counts all read this
        # table: write it once to the shared checkpoint folder instead of
        # recomputing the feature plan for every pass
        x = materialize(x, "engineered")
    if fit_on_all:
        x = apply_scaler(x, fit_scaler(x, feats), feats)
    # float32 vectors, as the 64-wide path stores them (P6): half the bytes
    # for the split table and every shard read
    vec = fit_width(F.transform(assemble_array(feats, "float"), lambda v: narrow_feature(v)), width)
    return x.select(id_col, vec.cast("array<float>").alias("features"), "y"), feats


def model_shards(vectors: DataFrame, n_models: int = N_MODELS, id_col: str = "row_id",
                 split_preset: str = "70/15/15") -> DataFrame:
    # written once: the per-model sampling reads the split several times
    s = materialize(stratified_split(vectors, id_col, "y", split_preset), "splits")
    return stratified_samples(s, id_col, "y", "split", n_models=n_models)
