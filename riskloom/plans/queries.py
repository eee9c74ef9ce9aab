"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each reads whole driver tables through ``sources.adapters`` and runs one
library operator (or a composed plan). Floating outputs are rounded to 6
places so they compare by value hash with the DuckDB oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.features import ROW_FEATURES, SEASON_FEATURES, add_row_features
from riskloom.operators.windows import WINDOW_FEATURES, add_weather_window_features
from riskloom.plans.common import rounded
from riskloom.plans.engineer import engineer_features
from riskloom.sources import adapters as A

KEYS = ["latitude", "longitude"]
RAW = ["tmmx", "tmmn", "rmax", "rmin", "vpd", "vs", "erc", "bi", "fm100", "fm1000", "pr", "srad"]
LAGCHG = ["temp_lag1", "vpd_lag1", "humidity_lag1", "temp_change", "humidity_change", "vpd_change"]
ROLL = ["temp_3day_avg", "temp_7day_avg", "vpd_3day_avg", "vpd_7day_avg", "humidity_3day_avg"]

# Flagship window plan: chosen from the largest entity's size ('auto').
FLAGSHIP_CHUNK_DAYS = "auto"


def _obs_parsed(spark, sf_dir):
    return A.obs_daily(spark, sf_dir).withColumn("ts", F.col("datetime").cast("timestamp_ntz"))


def q_row_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = A.obs_daily(spark, sf_dir)
    return rounded(add_row_features(o).select(*KEYS, "d", *ROW_FEATURES))


def q_season_features(spark, sf_dir):
    o = _obs_parsed(spark, sf_dir)
    return rounded(add_row_features(o, "ts").select(*KEYS, "d", "datetime", *SEASON_FEATURES))


def _windowed(spark, sf_dir, fill, chunk_days=None):
    o = add_row_features(_obs_parsed(spark, sf_dir), "ts")
    return add_weather_window_features(o, keys=KEYS, time_col="ts", fill=fill, chunk_days=chunk_days)


def q_rolling_means(spark, sf_dir):
    return rounded(_windowed(spark, sf_dir, "none").select(*KEYS, "d", *ROLL))


def q_lags_changes(spark, sf_dir):
    return rounded(_windowed(spark, sf_dir, "none").select(*KEYS, "d", *LAGCHG))


def q_filled_lags(spark, sf_dir):
    # the skew-safe chunked plan with 3-day chunks: most rows' look-back and
    # look-ahead cross chunk borders, so the halo and later-chunk fill are exercised
    return rounded(_windowed(spark, sf_dir, "bfill_zero", chunk_days=3).select(*KEYS, "d", *LAGCHG))


def engineered(spark, sf_dir, chunk_days=FLAGSHIP_CHUNK_DAYS):
    return engineer_features(A.obs_daily(spark, sf_dir), chunk_days=chunk_days)


def q_engineered_table(spark, sf_dir):
    e = engineered(spark, sf_dir)
    return rounded(e.select(*KEYS, "d", "datetime", *RAW, "wildfire", *ROW_FEATURES, *SEASON_FEATURES,
                            *WINDOW_FEATURES))


def q_engineered_table_chunked(spark, sf_dir):
    """The flagship with the skew-safe plan forced (32-day chunks)."""
    e = engineered(spark, sf_dir, chunk_days=32)
    return rounded(e.select(*KEYS, "d", "datetime", *RAW, "wildfire", *ROW_FEATURES, *SEASON_FEATURES,
                            *WINDOW_FEATURES))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {
        "engineered_table_chunked": q_engineered_table_chunked,
        "row_features": q_row_features,
        "season_features": q_season_features,
        "rolling_means": q_rolling_means,
        "lags_changes": q_lags_changes,
        "filled_lags": q_filled_lags,
        "engineered_table": q_engineered_table,
    }
    from riskloom.plans import queries_more, queries_store
    out.update(queries_more.registry())
    out.update(queries_store.registry())
    return out
