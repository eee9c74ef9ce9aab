"""Structured Streaming form of config application (E8 / L7 for arriving data).

New score files (one row per scored observation, model scores as an array in
the config's model order) arrive in a folder; every micro-batch computes the
weighted score and the decision with the saved weights and cut. Stateless:
no watermark needed; progress and exactly-once output come from the
checkpoint location, which must be a shared folder (by default under the
session's ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import checkpoint_dir

WIDE_SCORES_SCHEMA = "row_id long, scores array<double>"


def weighted_decision(stream: DataFrame, weights: list[float], threshold: float,
                      scores_col: str = "scores") -> DataFrame:
    """sum_i w_i * s_i in model order, then score >= cut (NULL/NaN -> 0)."""
    w = F.array(*[F.lit(float(x)) for x in weights])
    s = F.aggregate(F.zip_with(F.col(scores_col), w, lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
    s = F.nanvl(s, F.lit(None).cast("double"))
    return stream.withColumn("score", s).withColumn(
        "decision", F.coalesce(F.col("score") >= F.lit(float(threshold)), F.lit(False)).cast("int"))


def config_values(config_row: DataFrame) -> tuple[list[float], float]:
    """(weights in model order, threshold) from the one-row config (bounded)."""
    r = config_row.select("weights", "threshold").first()
    return list(r["weights"]), float(r["threshold"])


def start_scoring(spark: SparkSession, source: str, sink: str, weights: list[float], threshold: float,
                  checkpoint: str | None = None, available_now: bool = False, max_files: int = 1000):
    """Start the stream: parquet files in ``source`` -> decisions as parquet in ``sink``."""
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex[:8]}"
    src = (spark.readStream.schema(WIDE_SCORES_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(source))
    out = weighted_decision(src, weights, threshold)
    w = out.writeStream.format("parquet").option("path", sink).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
