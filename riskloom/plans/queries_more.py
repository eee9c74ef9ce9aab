"""Registered queries for preparation, sampling, metrics and ensemble
selection (Spark side). Oracle SQL lives in ``oracle_more``."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.functions import scalar as S
from riskloom.operators import prepare as M
from riskloom.operators import sampling as B
from riskloom.plans.common import rounded
from riskloom.sources import adapters as A

KEYS = ["latitude", "longitude", "d"]
RAW = ["tmmx", "tmmn", "rmax", "rmin", "vpd", "vs", "erc", "bi", "fm100", "fm1000", "pr", "srad"]
GAP_COLS = ["tmmx", "vpd", "rmin"]
SEED = 42


# -- preparation --------------------------------------------------------------
def q_median_impute(spark, sf_dir):
    g = A.obs_daily_with_gaps(spark, sf_dir)
    return rounded(M.median_impute(g).select(*KEYS, *GAP_COLS))


def q_mode_impute(spark, sf_dir):
    g = A.obs_daily_with_gaps(spark, sf_dir)
    return M.mode_impute(g, ["wildfire"]).select(*KEYS, "wildfire")


def q_label_encode(spark, sf_dir):
    docs = A.table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return M.label_encode(docs, ["lang", "source"], suffix="_code").select(
        "doc_id", "lang", "source", "lang_code", "source_code")


def q_target_encode(spark, sf_dir):
    o = A.obs_daily(spark, sf_dir).select(*KEYS, "wildfire")
    enc, _ = M.encode_target(o, "wildfire")
    return enc.select(*KEYS, "wildfire")


def q_scaler_stats(spark, sf_dir):
    o = A.obs_daily(spark, sf_dir)
    return rounded(M.fit_scaler(o, RAW))


def q_standardise(spark, sf_dir):
    o = A.obs_daily(spark, sf_dir)
    stats = M.fit_scaler(o, RAW)
    return rounded(M.apply_scaler(o, stats, RAW).select(*KEYS, *RAW))


def q_bool_target(spark, sf_dir):
    g = A.obs_daily_with_gaps(spark, sf_dir)
    return g.select(*KEYS, "wildfire", S.narrow_target(S.bool_target("wildfire")).alias("y"))


def q_fit_width(spark, sf_dir):
    e = A.table(spark, sf_dir, "embeddings")
    return e.select("vec_id", S.fit_width("embedding", 3).alias("v3"), S.fit_width("embedding", 64).alias("v64"),
                    S.fit_width("embedding", 70).alias("v70"))


def q_l2_normalise(spark, sf_dir):
    e = A.table(spark, sf_dir, "embeddings")
    return rounded(e.select("vec_id", S.l2_normalise("embedding").alias("unit")))


# -- sampling -------------------------------------------------------------------
def _labels(spark, sf_dir):
    return A.class_table(spark, sf_dir).select("doc_id", "toxic")


def q_stratified_split(spark, sf_dir):
    return B.stratified_split(_labels(spark, sf_dir), "doc_id", "toxic", "60/20/20", SEED)


def q_stratified_split_70(spark, sf_dir):
    return B.stratified_split(_labels(spark, sf_dir), "doc_id", "toxic", "70/15/15", SEED)


def q_stratified_samples(spark, sf_dir):
    from riskloom.session import materialize
    # the split table is written once (as the reference writes its splits):
    # the per-model sampling reads it several times
    s = materialize(B.stratified_split(_labels(spark, sf_dir), "doc_id", "toxic", "70/15/15", SEED), "splits")
    return B.stratified_samples(s, "doc_id", "toxic", "split", n_models=12).select(
        "doc_id", "toxic", "split", "model_id")


def q_fixed_sample(spark, sf_dir):
    return B.fixed_sample(_labels(spark, sf_dir), "doc_id", "toxic", 100, SEED)


def q_session_slice(spark, sf_dir):
    return B.session_slice(_labels(spark, sf_dir), "doc_id", session=2, per_session=100)


def q_half_split(spark, sf_dir):
    return B.half_split(_labels(spark, sf_dir), "doc_id")


def q_split_null_labels(spark, sf_dir):
    """Rows with a null label or id keep their place: null is a class of its own."""
    nulled = _labels(spark, sf_dir).select(F.when(F.col("doc_id") % 10 != 7, F.col("doc_id")).alias("doc_id"),
                                           F.when(F.col("doc_id") % 10 != 3, F.col("toxic")).alias("toxic"))
    return B.stratified_split(nulled, "doc_id", "toxic", "60/20/20", SEED)


def q_two_way_split(spark, sf_dir):
    return B.two_way_split(_labels(spark, sf_dir), "doc_id", "toxic", 0.2, SEED)


def q_half_split_text_id(spark, sf_dir):
    text = _labels(spark, sf_dir).withColumn("doc_id", F.concat(F.lit("d|"), F.col("doc_id").cast("string")))
    return B.half_split(text, "doc_id")


def registry() -> dict:
    out = {
        "median_impute": q_median_impute,
        "mode_impute": q_mode_impute,
        "label_encode": q_label_encode,
        "target_encode": q_target_encode,
        "scaler_stats": q_scaler_stats,
        "standardise": q_standardise,
        "bool_target": q_bool_target,
        "fit_width": q_fit_width,
        "l2_normalise": q_l2_normalise,
        "stratified_split": q_stratified_split,
        "stratified_split_70": q_stratified_split_70,
        "stratified_samples": q_stratified_samples,
        "fixed_sample": q_fixed_sample,
        "session_slice": q_session_slice,
        "half_split": q_half_split,
        "split_null_labels": q_split_null_labels,
        "two_way_split": q_two_way_split,
        "half_split_text_id": q_half_split_text_id,
    }
    from riskloom.plans import queries_ml, queries_select
    out.update(queries_select.registry())
    out.update(queries_ml.registry())
    return out

