"""Registered queries of sources, sinks and audits (S1-S3, S8), and of the
plans that only large or untidy tables need (M1, W1-W6), with their SQL.

Those of sources and sinks write files from whole tables to a folder of their
own under the shared checkpoint folder and return what the library reads back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskloom.functions.features import add_row_features
from riskloom.operators.order_stats import exact_medians
from riskloom.operators.sampling import stratified_samples, stratified_split
from riskloom.operators.windows import add_weather_window_features
from riskloom.plans.common import rounded
from riskloom.plans.oracle import KEY, OBS_DAILY, OBS_GAPS, _sel_round, filled
from riskloom.session import checkpoint_dir, materialize
from riskloom.sources import adapters as A
from riskloom.sources import audit
from riskloom.sources.infer import read_csv
from riskloom.sources.shards import ShardStore

ENTITY = ["latitude", "longitude"]
MODELS, SESSIONS = 12, 6


UNTIDY_COLUMNS = ["latitude", "longitude", "d", "datetime", "tmmx", "tmmn", "rmax", "rmin", "vpd", "vs", "erc", "bi", "fm100", "fm1000",
                  "pr", "srad"]


def _folder(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"


# -- S1 --------------------------------------------------------------------------
def _events_csv(spark, sf_dir):
    """``events`` as CSV, some cells of ``value`` unreadable or empty."""
    path = _folder(spark, "events-csv")
    i = F.col("event_id")
    value = F.when(i % 97 == 0, "oops").when(i % 89 == 0, "").otherwise(F.col("value").cast("string"))
    A.table(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("string").alias("ts"), "event_type",
                                            value.alias("value"), "props").write.option("header", True).csv(path)
    return path


def q_csv_type_report(spark, sf_dir):
    return read_csv(spark, _events_csv(spark, sf_dir), tolerance=0.05)[1]


def q_csv_typed_rows(spark, sf_dir):
    typed, _ = read_csv(spark, _events_csv(spark, sf_dir), tolerance=0.05)
    return typed.select("event_id", "user_id", "event_type", F.round("value", 6).alias("value"), "props")


# -- S2 / S3 ---------------------------------------------------------------------
def q_shard_round_trip(spark, sf_dir):
    """Samples written as shards in two commits, the second of which finds the
    shards of the first unchanged, and read back verified."""
    labels = A.class_table(spark, sf_dir).select("doc_id", "toxic")
    split = materialize(stratified_split(labels, "doc_id", "toxic", "70/15/15"), "splits")
    samples = stratified_samples(split, "doc_id", "toxic", "split")
    store = ShardStore(spark, _folder(spark, "shards"))
    store.write(samples.where("split <> 'train'"))
    store.write(samples)
    return store.read().select("doc_id", "toxic", "split", "model_id")


# -- S8 --------------------------------------------------------------------------
def q_gap_runs(spark, sf_dir):
    return audit.gap_runs(A.obs_daily(spark, sf_dir), ENTITY)


def q_artefact_listing_gaps(spark, sf_dir):
    """One file a (model, session) that had an error on a busy day; the pairs
    of the expected grid without a file, from the listing."""
    obs = A.obs_daily(spark, sf_dir)
    start = obs.agg(F.min("d")).first()[0]
    kept = obs.where("wildfire = 'Yes' AND vs > 4").select(
        (F.col("latitude") + 1).cast("int").alias("model_id"),
        (F.floor(F.datediff("d", F.lit(start)) / 7) + 1).cast("int").alias("session"), "tmmx")
    path = _folder(spark, "artefacts")
    kept.repartition("model_id", "session").write.partitionBy("model_id", "session").parquet(path)
    files = audit.listing(spark, path, ["model_id", "session"], "*.parquet")
    return audit.artefact_gaps(files, MODELS, SESSIONS)


# -- M1: medians by histogram passes ----------------------------------------------
MEDIANS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_partkey"]


def q_histogram_medians(spark, sf_dir):
    """Medians of ``lineitem`` columns with bands so small that the bucket
    refinement runs, as it does for columns of any size beyond a band."""
    rows = A.table(spark, sf_dir, "lineitem").select(*[F.col(c).cast("double").alias(c) for c in MEDIANS])
    found = exact_medians(rows, MEDIANS, max_band=500)
    return spark.createDataFrame([(c, found[c]) for c in MEDIANS], "column string, median double")


# -- W1-W6 on an untidy table --------------------------------------------------------
UNTIDY = ["temp_3day_avg", "temp_7day_avg", "vpd_3day_avg", "vpd_7day_avg", "humidity_3day_avg", "temp_lag1", "vpd_lag1",
          "humidity_lag1", "temp_change", "humidity_change", "vpd_change"]


def _untidy(spark, sf_dir):
    """Daily rows with missing values, missing times, missing entities and days given twice."""
    o = A.obs_daily_with_gaps(spark, sf_dir).drop("wildfire")
    twice = o.where("vs > 3").withColumn("tmmx", F.col("tmmx") + 1).withColumn("k", F.lit(1))
    both = o.withColumn("k", F.lit(0)).unionByName(twice)
    return both.withColumns({"latitude": F.when(~((F.col("latitude") == 11) & (F.col("vs") > 3)), F.col("latitude")),
                             "datetime": F.when(~((F.col("latitude") == 3) & (F.col("pr") == 0)), F.col("datetime"))})


def _untidy_windows(spark, sf_dir, **how):
    o = _untidy(spark, sf_dir).withColumn("ts", F.col("datetime").cast("timestamp_ntz"))
    out = add_weather_window_features(add_row_features(o, "ts"), ENTITY, "ts", ("k", "d"), **how)
    return rounded(out.select(*ENTITY, "d", "k", *UNTIDY))


def q_untidy_windows(spark, sf_dir):
    return _untidy_windows(spark, sf_dir)


def q_untidy_windows_chunked(spark, sf_dir):
    return _untidy_windows(spark, sf_dir, chunk_days=4)


def q_untidy_windows_measured(spark, sf_dir):
    """Chunks of about seven rows, cut where the counts say."""
    return _untidy_windows(spark, sf_dir, chunk_rows=7)


def registry() -> dict:
    return {"histogram_medians": q_histogram_medians, "untidy_windows": q_untidy_windows,
            "untidy_windows_chunked": q_untidy_windows_chunked, "untidy_windows_measured": q_untidy_windows_measured, "csv_type_report": q_csv_type_report, "csv_typed_rows": q_csv_typed_rows, "shard_round_trip": q_shard_round_trip,
            "gap_runs": q_gap_runs, "artefact_listing_gaps": q_artefact_listing_gaps}


def all_sql() -> dict[str, str]:
    from riskloom.plans.oracle_more import samples_sql
    from riskloom.plans.oracle_select import daily_gaps_sql
    cells = ", ".join(f"({i}, '{c}', '{k}')" for i, (c, k) in enumerate(
        [("event_id", "long"), ("user_id", "long"), ("ts", "text"), ("event_type", "text"), ("value", "double"), ("props", "text")]))
    gaps = daily_gaps_sql()
    tidy = ", ".join(c for c in UNTIDY_COLUMNS if c not in ("latitude", "datetime", "tmmx"))
    row = ("SELECT CASE WHEN latitude = 11 AND vs > 3 THEN NULL ELSE latitude END AS latitude, "
           "CASE WHEN latitude = 3 AND pr = 0 THEN NULL ELSE datetime END AS datetime, {t} AS tmmx, {k} AS k, " + tidy + f" FROM ({OBS_GAPS}) g")
    untidy = row.format(t="tmmx", k=0) + " UNION ALL " + row.format(t="tmmx + 1", k=1) + " WHERE vs > 3"
    windows = filled(untidy).replace(KEY, "PARTITION BY latitude, longitude ORDER BY ts ASC NULLS LAST, k, d")
    windows = f"SELECT latitude, longitude, d, k, {_sel_round(UNTIDY)} FROM ({windows}) w"
    return {
        "untidy_windows": windows,
        "untidy_windows_chunked": windows,
        "untidy_windows_measured": windows,
        "histogram_medians": " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", CAST(median(CAST({c} AS DOUBLE)) AS DOUBLE) AS median FROM lineitem" for c in MEDIANS),
        "csv_type_report": f"""
SELECT CAST(t.place AS INTEGER) AS place, t.name AS "column", t.kind, e.cells,
       CASE WHEN t.name = 'value' THEN e.missing ELSE 0 END AS missing, CASE WHEN t.name = 'value' THEN e.bad ELSE 0 END AS bad
FROM (VALUES {cells}) t(place, name, kind), (SELECT count(*) AS cells, count(*) FILTER (event_id % 97 = 0) AS bad,
      count(*) FILTER (event_id % 97 <> 0 AND event_id % 89 = 0) AS missing FROM events) e""",
        "csv_typed_rows": """
SELECT event_id, user_id, event_type, CASE WHEN event_id % 97 <> 0 AND event_id % 89 <> 0 THEN round(value, 6) END AS value, props
FROM events""",
        "shard_round_trip": samples_sql(),
        "gap_runs": f"""
SELECT latitude, longitude, min(d) AS first_missing, max(d) AS last_missing, CAST(count(*) AS INTEGER) AS days FROM
  (SELECT *, d - CAST(row_number() OVER (PARTITION BY latitude, longitude ORDER BY d) AS INTEGER) AS run FROM ({gaps}) g)
GROUP BY latitude, longitude, run""",
        "artefact_listing_gaps": f"""
SELECT CAST(m.range AS INTEGER) AS model_id, CAST(s.range AS INTEGER) AS session FROM range(1, {MODELS + 1}) m, range(1, {SESSIONS + 1}) s
WHERE NOT EXISTS (SELECT 1 FROM ({OBS_DAILY}) o WHERE o.wildfire = 'Yes' AND o.vs > 4 AND o.latitude + 1 = m.range
  AND floor((o.d - (SELECT min(d) FROM ({OBS_DAILY}) p)) / 7) + 1 = s.range)""",
    }
