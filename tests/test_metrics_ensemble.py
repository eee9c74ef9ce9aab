"""Metrics and selection: one_class, grid_edge, best_tie, strategy_tie, dead_model, patience, sweep property."""

from pyspark.sql import functions as F

from riskloom.operators import ensemble as E
from riskloom.operators import metrics as Q


def test_grid():
    g = E.threshold_grid()
    assert len(g) == 41 and g[28] == 0.48000000000000026 and g[-1] == 0.6000000000000003


def test_one_class(spark):
    df = spark.createDataFrame([(0.9, 0), (0.1, 0)], "s double, y int")
    r = Q.evaluate(df, "s", "y", 0.5).first()
    assert (r.tp, r.fn, r.recall) == (0, 0, 0.0)
    w = {x.y: x.weight for x in Q.class_weights(df, "y").collect()}
    assert w == {0: 1.0, 1: 1.0}


def test_sweep_equals_direct(spark):
    import random
    rnd = random.Random(3)
    rows = [("s", i, rnd.random(), rnd.randint(0, 1)) for i in range(400)] + [("s", 400, float("nan"), 1)]
    df = spark.createDataFrame(rows, "strategy string, row_id long, score double, y int")
    curve = {r.cut: (r.tp, r.fp, r.fn, r.tn) for r in E.threshold_curve(df).collect()}
    g = E.threshold_grid()
    for i, t in enumerate(g):
        tp = sum(1 for r in rows if r[2] == r[2] and r[2] >= t and r[3] == 1)
        fp = sum(1 for r in rows if r[2] == r[2] and r[2] >= t and r[3] == 0)
        assert curve[i][:2] == (tp, fp)
    recalls = [r.recall for r in E.threshold_curve(df).orderBy("cut").collect()]
    assert all(a >= b for a, b in zip(recalls, recalls[1:]))


def test_grid_edge_and_best_tie(spark):
    # every cut has the same metrics -> the lowest cut wins
    df = spark.createDataFrame([("s", 1, 0.9, 1), ("s", 2, 0.1, 0)], "strategy string, row_id long, score double, y int")
    best = E.best_thresholds(E.threshold_curve(df)).collect()
    assert all(r.cut == 0 for r in best)
    # a score of exactly 0.48 is below the 0.48000000000000026 cut
    df2 = spark.createDataFrame([("s", 1, 0.48, 1)], "strategy string, row_id long, score double, y int")
    c = {r.cut: r.tp for r in E.threshold_curve(df2).collect()}
    assert c[27] == 1 and c[28] == 0


def test_strategy_tie_listed_order(spark):
    rows = [(s, 1, 0.9, 1) for s in E.STRATEGIES] + [(s, 2, 0.1, 0) for s in E.STRATEGIES]
    df = spark.createDataFrame(rows, "strategy string, row_id long, score double, y int")
    curve = E.threshold_curve(df)
    chosen = spark.createDataFrame([(0,)], "cut int")
    top = E.best_strategy(E.strategy_table(curve, chosen)).first()
    assert top.strategy == "simple_average"


def test_dead_model_screened(spark):
    rows = [(i, 1, 0.2 + 0.001 * i, i % 2) for i in range(10)] + [(i, 2, 0.3 + 0.05 * i, i % 2) for i in range(10)]
    s = spark.createDataFrame(rows, "row_id long, model_id int, score double, y int")
    info = Q.validation_metrics(s)
    keep = {r.model_id: r.keep for r in E.screen_models(s, info).collect()}
    assert keep == {1: False, 2: True}


def test_patience(spark):
    rows = [(1, i + 1, v) for i, v in enumerate([5.0, 4.0, 4.0, 4.0, 4.0, 4.0, 4.0])]
    df = spark.createDataFrame(rows, "model_id int, it int, loss double")
    for bucket in (None, F.floor(F.col("it") / 2)):
        r = Q.early_stop(df, ["model_id"], [F.col("it")], "loss", 5, bucket=bucket).first()
        assert (r.stop_iteration, r.best_iteration, r.best_loss) == (7, 2, 4.0)


def test_prefix_chunked_equals_plain(spark):
    from riskloom.operators.scan import prefix_agg
    rows = [(k, i, float((i * 37) % 11)) for k in range(3) for i in range(50)]
    df = spark.createDataFrame(rows, "k int, i int, x double")
    aggs = {"s": ("sum", "x", True), "m": ("min", "x", False), "c": ("count", F.lit(1), True)}
    a = {(r.k, r.i): (r.s, r.m, r.c) for r in prefix_agg(df, ["k"], [F.col("i")], aggs).collect()}
    b = {(r.k, r.i): (r.s, r.m, r.c) for r in prefix_agg(df, ["k"], [F.col("i")], aggs, F.floor(F.col("i") / 7)).collect()}
    assert a == b


def test_wide_path_equals_long_path(spark):
    from riskloom.sources import adapters as A
    sf = "/root/testdata/sf0.001"
    long, wide, ids = A.scores(spark, sf), A.scores_wide(spark, sf), list(range(1, 13))
    ol = E.optimise(long, Q.validation_metrics(long))
    ow = E.optimise_wide(wide, ids)
    for k in ("screened", "weights", "combined", "curve", "best", "strategies"):
        assert ol[k].exceptAll(ow[k].select(*ol[k].columns)).count() == 0, k
    cfg = E.config_table(ow["best_strategy"], ow["weights"])
    a = E.apply_config(long, cfg)
    b = E.apply_config_wide(wide, ids, cfg)
    assert a.exceptAll(b.select(*a.columns)).count() == 0
    c1 = Q.confusion(long.withColumn("d", F.when(F.col("score") > 0.5, 1).otherwise(0)), "d", "y", ["model_id"])
    c2 = E.confusion_wide(wide, ids, 0.5, inclusive=False)
    assert c1.exceptAll(c2.select(*c1.columns)).count() == 0
    assert Q.score_range(long).exceptAll(E.score_range_wide(wide, ids)).count() == 0


def test_history_rollup_fixture(spark):
    rows = [(1, 1, 1, 10, 1.0), (1, 1, 2, 20, 2.0), (1, 1, 3, 30, 2.0), (2, 1, 1, 5, 0.0)]
    df = spark.createDataFrame(rows, "model_id int, session int, iteration int, samples long, seconds double")
    for chunk in (None, 2):
        got = {(r.model_id, r.iteration): (r.samples_per_sec, r.cumulative_samples, r.elapsed, r.avg_throughput)
               for r in Q.history_rollup(df, chunk=chunk).collect()}
        assert got == {(1, 1): (10.0, 10, 1.0, 10.0), (1, 2): (10.0, 30, 3.0, 10.0),
                       (1, 3): (15.0, 60, 5.0, 12.0), (2, 1): (0.0, 5, 0.0, 0.0)}


def test_missing_metrics_error_or_default(spark):
    import pytest
    screened = spark.createDataFrame([(1, True), (2, True)], "model_id int, keep boolean")
    info = spark.createDataFrame([(1, 0.4, 0.6)], "model_id int, val_f1 double, val_recall double")
    with pytest.raises(Exception, match="without validation metrics"):
        E.strategy_weights(screened, info).collect()
    w = {r.model_id: r for r in E.strategy_weights(screened, info, missing="default").collect()}
    assert abs(w[2].f1_weighted - 0.1 / 0.5) < 1e-12 and abs(w[1].simple_average - 0.5) < 1e-12
