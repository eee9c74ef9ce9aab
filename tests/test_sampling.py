"""Splits and samples: counts, disjointness, equality with the plain window rank."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from riskloom.operators import sampling as B
from riskloom.operators.ranking import hash_key, hex_bucket, rank_in_buckets


def labels(spark, n=997, pos_every=7):
    return spark.createDataFrame([(i, 1 if i % pos_every == 0 else 0) for i in range(n)], "id long, y int")


def test_split_counts_and_disjoint(spark):
    df = labels(spark)
    s = B.stratified_split(df, "id", "y", "60/20/20")
    rows = s.collect()
    assert len(rows) == 997 and len({r.id for r in rows}) == 997
    n = {k: sum(1 for r in rows if r.split == k) for k in ("train", "val", "test")}
    # test = ceil(0.2*997) = 200; val = ceil(0.25*797) = 200
    assert n == {"test": 200, "val": 200, "train": 597}
    for k in ("train", "val", "test"):
        share = sum(1 for r in rows if r.split == k and r.y == 1) / n[k]
        assert abs(share - 143 / 997) < 0.01


def test_split_70(spark):
    s = B.stratified_split(labels(spark), "id", "y", "70/15/15").groupBy("split").count().collect()
    got = {r.split: r["count"] for r in s}
    assert got == {"test": 150, "val": 150, "train": 697}


def test_two_phase_rank_equals_row_number(spark):
    df = labels(spark).withColumn("h", hash_key("id", 42)).withColumn("b", hex_bucket(F.col("h"), 2))
    r1 = rank_in_buckets(df, ["y"], "b", [F.col("h"), F.col("id")], "rk")
    w = Window.partitionBy("y").orderBy("h", "id")
    r2 = df.withColumn("rk2", F.row_number().over(w))
    j = r1.join(r2.select("id", "rk2"), "id")
    assert j.where("rk != rk2").count() == 0


def test_samples_per_model(spark):
    s = B.stratified_split(labels(spark), "id", "y", "70/15/15")
    smp = B.stratified_samples(s, "id", "y", "split", n_models=12)
    c = {(r.model_id, r.split): r["count"] for r in smp.groupBy("model_id", "split").count().collect()}
    assert c[(1, "train")] == 697 - (697 - -(-697 // 12))  # ceil(697/12) = 59
    assert all(c[(m, "val")] == 13 for m in range(1, 13))
    # independent seeds: model samples differ
    a = {r.id for r in smp.where("model_id = 1 AND split = 'train'").collect()}
    b = {r.id for r in smp.where("model_id = 2 AND split = 'train'").collect()}
    assert a != b


def test_fixed_sample_only_if_larger(spark):
    df = labels(spark, 50)
    assert B.fixed_sample(df, "id", "y", 100).count() == 50
    assert B.fixed_sample(df, "id", "y", 20).count() == 20


def test_session_slice_and_half(spark):
    df = labels(spark, 250)
    ids = sorted(r.id for r in B.session_slice(df, "id", 3, 100).collect())
    assert ids == list(range(200, 250))
    h = B.half_split(df, "id")
    assert sorted(r.id for r in h.where("half = 'first'").collect()) == list(range(125))


def test_knn_exact_against_brute_force():
    import numpy as np
    from riskloom.operators.oversample import knn_indices
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 8))
    got = knn_indices(x, 5, block=64)
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(-1)
    np.fill_diagonal(d, np.inf)
    exp = np.argsort(d, axis=1, kind="stable")[:, :5]
    assert (np.sort(got, axis=1) == np.sort(exp, axis=1)).all()


def test_smote_ratio_and_interpolation(spark):
    from riskloom.operators.oversample import smote_sessions, positional_index
    rows = [(i, [float(i % 13), float(i % 7)], 1 if i % 10 == 0 else 0) for i in range(400)]
    df = spark.createDataFrame(rows, "row_id long, features array<double>, y int")
    out = smote_sessions(df, "row_id", "features", "y", per_session=200).collect()
    for s in (1, 2):
        ys = [r.y for r in out if r.session == s]
        pos, neg = sum(ys), len(ys) - sum(ys)
        assert pos == int(neg * 0.3) and neg == 180
    # synthetic points lie inside the minority bounding box
    syn = [r.features for r in out if r.synthetic == 1]
    assert syn and all(0.0 <= f[0] <= 12.0 and 0.0 <= f[1] <= 6.0 for f in syn)
    p = positional_index(df, "row_id").collect()
    assert sorted((r.row_id, r.position) for r in p) == [(i, i) for i in range(400)]


def test_samples_approximate_mode(spark):
    s = B.stratified_split(labels(spark), "id", "y", "70/15/15")
    smp = B.stratified_samples(s, "id", "y", "split", n_models=3, approximate=True)
    n = smp.where("split = 'train'").groupBy("model_id").count().collect()
    assert len(n) == 3 and all(180 <= r["count"] <= 290 for r in n)  # ~697/3


def test_bucket_width_does_not_change_results(spark):
    df = labels(spark, 600)
    outs = [B.stratified_split(df, "id", "y", "60/20/20", digits=d) for d in (1, 2, 4)]
    assert outs[0].exceptAll(outs[1]).count() == 0 and outs[0].exceptAll(outs[2]).count() == 0


def test_ties_and_null_ids_are_counted_off_exactly(spark):
    # 120 rows without an id, 60 rows of one id, some of them equal in every column
    rows = [(None, k % 2, "a") for k in range(120)] + [(5, 0, f"p{k % 3}") for k in range(60)] + [(i, i % 2, "z") for i in range(10, 90)]
    df = spark.createDataFrame(rows, "id long, y int, pay string").repartition(5)
    s = B.stratified_split(df, "id", "y", "60/20/20")
    assert {r.split: r["count"] for r in s.groupBy("split").count().collect()} == {"test": 52, "val": 52, "train": 156}
    assert s.drop("split").exceptAll(df).count() == 0 == df.exceptAll(s.drop("split")).count()
    smp = B.stratified_samples(s, "id", "y", "split", n_models=4)
    assert {(r.model_id, r.split): r["count"] for r in smp.groupBy("model_id", "split").count().collect()} == {
        (m, k): n for m in range(1, 5) for k, n in (("train", 39), ("val", 13), ("test", 13))}
    assert B.fixed_sample(df, "id", "y", 77).count() == 77
    assert B.two_way_split(df, "id", "y", 0.25).agg(F.sum("holdout")).first()[0] == 65


def test_wide_rows_are_not_shuffled(spark, tmpdir_path):
    wide = labels(spark, 3000).withColumn("pay", F.array_repeat(F.lit(1.5), 30))
    wide.write.parquet(tmpdir_path + "/wide")
    df = spark.read.parquet(tmpdir_path + "/wide")
    split = B.stratified_split(df, "id", "y")
    split.write.parquet(tmpdir_path + "/split")
    samples = B.stratified_samples(spark.read.parquet(tmpdir_path + "/split"), "id", "y", "split")
    for out in (split, B.two_way_split(df, "id", "y", 0.3), B.fixed_sample(df, "id", "y", 500), samples):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "Window" not in plan and "SortMergeJoin" not in plan
        assert plan.count("FileScan") == 2  # the rows, and the cut keys


def test_empty_table_splits(spark):
    none = spark.createDataFrame([], "id long, y int")
    assert B.stratified_split(none, "id", "y").count() == 0 and B.fixed_sample(none, "id", "y", 5).count() == 0
    assert B.stratified_samples(none.withColumn("split", F.lit("train")), "id", "y", "split").count() == 0
