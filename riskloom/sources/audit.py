"""Artefact and table completeness audit.

Missing days are found as runs: each entity's days are put in order and a run
of missing days is where the next day is more than one away, so nothing is
generated for the days that are there and one far-off date costs one row.
Artefacts are found by listing their files as a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def missing_keys(expected: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    return expected.select(*keys).join(found.select(*keys).distinct(), on=keys, how="left_anti")


def gap_runs(obs: DataFrame, entity: list[str], day_col: str = "d") -> DataFrame:
    """Runs of missing days of each entity between the table's first and last
    day: entity..., first_missing, last_missing, days.

    Days are distinct before they are put in order, so an entity takes as many
    rows as it has days, however many rows it has. Rows without a day, and
    entities that hold a null, do not take part."""
    ends = obs.agg(F.min(day_col).alias("lo"), F.max(day_col).alias("hi")).first()
    days = obs.select(*entity, F.col(day_col).cast("date").alias("__d")).dropna().distinct()
    lo, hi = (F.lit(ends[k]).cast("date") for k in ("lo", "hi"))
    order = Window.partitionBy(*entity).orderBy("__d")
    seen = days.withColumns({"__next": F.lead("__d").over(order), "__before": F.lag("__d").over(order)})
    run = lambda a, b: F.struct(a.alias("first_missing"), b.alias("last_missing"))
    after = run(F.date_add("__d", 1), F.date_sub(F.coalesce("__next", F.date_add(hi, 1)), 1))
    first = run(lo, F.date_sub("__d", 1))
    runs = F.array(after, F.when(F.col("__before").isNull(), first))
    out = seen.select(*entity, F.explode(F.filter(runs, lambda r: r.isNotNull() & (r["first_missing"] <= r["last_missing"])))
                      .alias("r")).select(*entity, "r.*")
    return out.withColumn("days", F.datediff("last_missing", "first_missing") + 1)


def daily_gaps(obs: DataFrame, entity: list[str], day_col: str = "d") -> DataFrame:
    """Entity-days missing between the table's first and last day, one row each."""
    runs = gap_runs(obs, entity, day_col)
    return runs.select(*entity, F.explode(F.sequence("first_missing", "last_missing")).alias(day_col))


# -- artefacts -------------------------------------------------------------------
def listing(spark: SparkSession, path: str, levels: list[str], pattern: str = "*") -> DataFrame:
    """Files below ``path`` as a table: path, length, modified, and the value of
    each ``level=value`` folder (null where a file lies elsewhere). The files'
    content is not read; empty files are not listed."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
             .select("path", "length", F.col("modificationTime").alias("modified")))
    value = lambda k: F.regexp_extract("path", rf"[/]{k}=([^/]+)[/]", 1)
    return files.withColumns({k: F.when(value(k) != "", value(k)) for k in levels})


def artefact_gaps(files: DataFrame, n_models: int, n_sessions: int, least_bytes: int = 1) -> DataFrame:
    """(model_id, session) pairs of the expected grid without a file of at least
    ``least_bytes``: a file cut short counts as missing."""
    found = files.where(F.col("length") >= least_bytes).select(
        F.col("model_id").try_cast("int").alias("model_id"), F.col("session").try_cast("int").alias("session"))
    return model_session_gaps(found, n_models, n_sessions)


def model_session_gaps(manifest: DataFrame, n_models: int, n_sessions: int) -> DataFrame:
    """(model_id, session) pairs with no manifest entry; the grid is two
    sequences exploded in one projection of a one-row frame."""
    spark = manifest.sparkSession
    grid = (spark.range(1).select(F.explode(F.sequence(F.lit(1), F.lit(n_models))).alias("model_id"))
            .select("model_id", F.explode(F.sequence(F.lit(1), F.lit(n_sessions))).alias("session")))
    return missing_keys(grid, manifest, ["model_id", "session"])
