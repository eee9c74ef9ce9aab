"""Views over the driver's tables in the shapes the operators expect.

Each adapter reads whole tables (only the columns it needs: Parquet column
pruning) and is a lazy DataFrame, so all work grows with the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.scalar import fit_width

N_MODELS = 12


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def obs_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily observation table from ``events``: one row per (user, day).

    Entity = (latitude, longitude) derived from user_id; ``d`` is the date,
    ``datetime`` its ISO text (the reference's raw time column);
    ``wildfire`` is 'Yes' when the user had an error that day.
    """
    e = table(spark, sf_dir, "events").select(
        "user_id", "ts", "event_type", "value",
        F.regexp_extract("props", r"([0-9]+)", 1).cast("double").alias("k"))
    d = F.col("ts").cast("date")
    g = e.groupBy("user_id", d.alias("d")).agg(
        F.max("value").alias("tmmx"), F.min("value").alias("tmmn"),
        F.max("k").alias("rmax"), F.min("k").alias("rmin"),
        F.sum("value").alias("vpd"), F.count(F.lit(1)).cast("double").alias("vs"),
        F.sum("k").alias("erc"), (F.max("k") - F.min("k")).alias("bi"),
        (F.min("k") + F.lit(1.0)).alias("fm100"), (F.max("k") + F.lit(2.0)).alias("fm1000"),
        F.sum(F.when(F.col("event_type") == "view", 1).otherwise(0)).cast("double").alias("pr"),
        (F.max("value") * F.lit(2.0)).alias("srad"),
        # max over an int flag keeps the aggregation hash-based (max of text would sort)
        F.max(F.when(F.col("event_type") == "error", 1).otherwise(0)).alias("__err"),
    ).withColumn("wildfire", F.when(F.col("__err") == 1, "Yes").otherwise("No"))
    return g.select(
        (F.col("user_id") % 12).cast("double").alias("latitude"),
        F.floor(F.col("user_id") / F.lit(12.0)).cast("double").alias("longitude"),
        "d", F.col("d").cast("string").alias("datetime"),
        "tmmx", "tmmn", "rmax", "rmin", "vpd", "vs", "erc", "bi", "fm100", "fm1000", "pr", "srad", "wildfire",
    )


def obs_daily_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """obs_daily with missing values set by rule (to exercise imputation)."""
    o = obs_daily(spark, sf_dir)
    return o.withColumns({
        "tmmx": F.when(F.col("vs") > 2, F.col("tmmx")),
        "vpd": F.when(F.col("pr") < 2, F.col("vpd")),
        "rmin": F.when(F.col("bi") > 10, F.col("rmin")),
        "wildfire": F.when(F.col("erc") < 150, F.col("wildfire")),
    })


def scores(spark: SparkSession, sf_dir: str, n_models: int = N_MODELS) -> DataFrame:
    """Long score table (row_id, model_id, score, y) from ``embeddings``:
    model m's score = clamp(0.5 + embedding[m], 0, 1); y = (label = 0)."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(
        F.col("vec_id").alias("row_id"),
        F.posexplode(F.slice("embedding", 1, n_models)).alias("pos", "e"),
        F.when(F.col("label") == 0, 1).otherwise(0).alias("y"),
    ).select(
        "row_id", (F.col("pos") + 1).cast("int").alias("model_id"),
        F.least(F.greatest(F.lit(0.5) + F.col("e").cast("double"), F.lit(0.0)), F.lit(1.0)).alias("score"),
        "y",
    )


def scores_wide(spark: SparkSession, sf_dir: str, n_models: int = N_MODELS) -> DataFrame:
    """The same scores as ``scores`` side by side: (row_id, y, scores array)
    with scores[m-1] = clamp(0.5 + embedding[m], 0, 1)."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(
        F.col("vec_id").alias("row_id"), F.when(F.col("label") == 0, 1).otherwise(0).alias("y"),
        F.transform(F.slice("embedding", 1, n_models),
                    lambda e: F.least(F.greatest(F.lit(0.5) + e.cast("double"), F.lit(0.0)), F.lit(1.0)))
        .alias("scores"))


def training_set(spark: SparkSession, sf_dir: str, width: int = 64) -> DataFrame:
    """(row_id, features array<double>[width], y) from ``embeddings``."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(F.col("vec_id").alias("row_id"), fit_width("embedding", width).alias("features"),
                      F.when(F.col("label") == 0, 1).otherwise(0).alias("y"))


def class_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, quality, toxic) from ``labels``."""
    return table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training history from ``lineitem``: order = model, line = iteration.

    iteration is the line's position inside its order by (l_linenumber,
    l_partkey, l_suppkey); loss = l_extendedprice; samples = l_quantity;
    seconds = 0.5 + 10 * l_discount; accuracy = 1 - l_tax.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
        "l_discount", "l_tax")
    from pyspark.sql import Window
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    return li.select(
        F.col("l_orderkey").alias("model_id"), F.lit(1).alias("session"),
        F.row_number().over(w).alias("iteration"),
        F.col("l_extendedprice").alias("loss"), (F.lit(1.0) - F.col("l_tax")).alias("accuracy"),
        (F.lit(0.5) + F.lit(10.0) * F.col("l_discount")).alias("seconds"),
        F.col("l_quantity").cast("long").alias("samples"),
    )


def loss_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long loss runs from ``events``: run = user, loss = value, ordered by (ts, event_id)."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("model_id"), "ts", "event_id", F.col("value").alias("loss"))
