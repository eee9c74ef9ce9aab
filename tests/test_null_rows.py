from pyspark.sql import functions as F

from riskloom.operators import oversample, sampling
from riskloom.sources import io


def test_split_keeps_null_labels_and_ids(spark):
    rows = [(i if i % 9 else None, None if i % 10 == 3 else i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, y int")
    got = sampling.stratified_split(df, "id", "y")
    assert got.count() == 200
    assert got.filter("y is null").count() == sum(y is None for _, y in rows)
    assert got.filter("id is null").count() == sum(i is None for i, _ in rows)
    assert sampling.two_way_split(df, "id", "y", 0.25).count() == 200
    assert sampling.fixed_sample(df, "id", "y", 150).count() == 150


def test_text_ids(spark):
    df = spark.range(101).select(F.concat(F.lit("1.0|"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("id"),
                                 (F.col("id") % 5 == 0).cast("int").alias("y"),
                                 F.array(F.col("id").cast("double"), F.lit(1.0)).alias("x"))
    half = {r.id: r.half for r in sampling.half_split(df, "id").collect()}
    assert [half[k] for k in sorted(half)] == ["first"] * 50 + ["second"] * 51
    cut = sorted(r.id for r in sampling.session_slice(df, "id", 2, 10).collect())
    assert cut == sorted(half)[10:20]
    made = oversample.smote_sessions(df, "id", "x", "y", per_session=50)
    ids = {r.id for r in made.collect()}
    assert dict(made.dtypes)["id"] == "string" and ids == set(half)
    assert made.filter("synthetic = 0").count() == 101
    assert oversample.positional_index(df, "id", rows_per_bucket=10).agg(F.max("position")).first()[0] == 100


def test_csv_cells_that_are_missing(spark, tmpdir_path):
    with open(f"{tmpdir_path}/x.csv", "w") as f:
        f.write("latitude,longitude,datetime,tmmx,vpd\n1.0,2.0,2020-01-01,NA,0.5\n1.0,2.0,2020-01-02,280.5,not a number\n1.0,,2020-01-03,,n/a\n")
    got = io.read_observations(spark, tmpdir_path).orderBy("datetime").collect()
    assert [(r.tmmx, r.vpd) for r in got] == [(None, 0.5), (280.5, None), (None, None)] and got[2].longitude is None
