"""Session helpers: checkpoint folder, lineage cut by a written table, sizing."""

from riskloom.session import checkpoint_dir, materialize, scale_conf


def test_checkpoint_dir_from_session(spark):
    path = checkpoint_dir(spark)
    assert path and spark.sparkContext.getCheckpointDir() is not None


def test_materialize_cuts_lineage(spark):
    df = spark.range(100).selectExpr("id", "id * 2 AS y")
    m = materialize(df, "t")
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and m.count() == 100
    assert m.where("y = 42").first().id == 21


def test_scale_conf_bounds():
    c = scale_conf(30 * 10**12, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) >= 2 * 8000
    assert int(c["spark.sql.adaptive.advisoryPartitionSizeInBytes"]) == 256 << 20
    small = scale_conf(10**6, 16)
    assert small["spark.sql.shuffle.partitions"] == "32"
