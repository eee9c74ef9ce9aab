"""Round trips of sources and sinks (S1-S3, S5, S7, S8) in a scratch folder."""

import os

from pyspark.sql import functions as F

from riskloom.sources import io
from riskloom.sources.audit import model_session_gaps


def test_csv_scan(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "obs.csv")
    with open(p, "w") as f:
        f.write("latitude,longitude,datetime,tmmx,Wildfire\n1.5,2.5,2024-01-02,30.1,Yes\n")
    df = io.read_observations(spark, p)
    r = df.first()
    assert r.latitude == 1.5 and r.wildfire == "Yes" and r.tmmx == 30.1 and "pr" not in df.columns
    assert dict(df.dtypes)["tmmx"] == "double"


def test_shards_round_trip(spark, tmpdir_path):
    df = spark.createDataFrame([(i, i % 3 + 1, ["train", "val"][i % 2]) for i in range(30)],
                               "row_id long, model_id int, split string")
    p = os.path.join(tmpdir_path, "shards")
    io.write_shards(df, p)
    one = io.read_shard(spark, p, 2, "train")
    assert sorted(r.row_id for r in one.collect()) == sorted(i for i in range(30) if i % 3 == 1 and i % 2 == 0)
    assert "PartitionFilters" in one._jdf.queryExecution().executedPlan().toString()


def test_config_round_trip(spark, tmpdir_path):
    row = spark.createDataFrame([(0.48, "f1_weighted", [0.5, 0.5], [1, 3], (0.8, 0.3, 0.85, 0.75))],
                                io.CONFIG_SCHEMA)
    p = os.path.join(tmpdir_path, "config")
    io.write_config(row, p)
    back = io.read_config(spark, p).first()
    assert back.model_ids == [1, 3] and back.performance.f1 == 0.3
    long = io.config_to_long(io.read_config(spark, p)).collect()
    assert [(r.model_id, r.weight) for r in long] == [(1, 0.5), (3, 0.5)]


def test_model_session_audit(spark):
    man = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "model_id int, session int")
    miss = {(r.model_id, r.session) for r in model_session_gaps(man, 2, 2).collect()}
    assert miss == {(2, 2)}


def test_daily_gaps_fixture(spark):
    import datetime as dt
    from riskloom.sources.audit import daily_gaps
    d = dt.date(2024, 1, 1)
    rows = [(1.0, 0.0, d), (1.0, 0.0, d + dt.timedelta(days=2)), (2.0, 0.0, d + dt.timedelta(days=1))]
    obs = spark.createDataFrame(rows, "latitude double, longitude double, d date")
    miss = {(r.latitude, r.d.day) for r in daily_gaps(obs, ["latitude", "longitude"]).collect()}
    assert miss == {(1.0, 2), (2.0, 1), (2.0, 3)}
