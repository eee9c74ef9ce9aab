"""Streaming config application: micro-batches over arriving files."""

import os

from riskloom.streaming.scoring import start_scoring, weighted_decision


def test_stream_applies_config(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    sink = os.path.join(tmpdir_path, "out")
    ck = os.path.join(tmpdir_path, "ck")
    rows = [(1, [0.9, 0.1]), (2, [0.2, 0.2]), (3, [float("nan"), 0.9])]
    spark.createDataFrame(rows, "row_id long, scores array<double>").write.parquet(src)
    q = start_scoring(spark, src, sink, [0.5, 0.5], 0.48, checkpoint=ck, available_now=True)
    q.awaitTermination(120)
    got = {r.row_id: (round(r.score, 9) if r.score is not None else None, r.decision)
           for r in spark.read.parquet(sink).collect()}
    assert got == {1: (0.5, 1), 2: (0.2, 0), 3: (None, 0)}


def test_batch_and_stream_share_expression(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0])], "row_id long, scores array<double>")
    r = weighted_decision(df, [0.25, 0.75], 0.25).first()
    assert (r.score, r.decision) == (0.25, 1)


def test_config_round_trip_matches_batch_apply(spark, tmpdir_path):
    from pyspark.sql import functions as F
    from riskloom.operators import ensemble as E
    from riskloom.sources import adapters as A
    from riskloom.sources import io
    from riskloom.streaming.scoring import config_values
    wide, ids = A.scores_wide(spark, "/root/testdata/sf0.001"), list(range(1, 13))
    o = E.optimise_wide(wide, ids)
    long_cfg = E.config_table(o["best_strategy"], o["weights"])
    path = tmpdir_path + "/cfg"
    io.write_config(E.config_row(long_cfg), path)
    weights, cut = config_values(io.read_config(spark, path))
    kept = [r.model_id for r in io.config_to_long(io.read_config(spark, path)).collect()]
    # stream-side input: the kept models' scores side by side in config order
    streamed = wide.select("row_id", F.array(*[F.element_at("scores", m) for m in kept]).alias("scores"))
    got = weighted_decision(streamed, weights, cut).select("row_id", "decision")
    exp = E.apply_config_wide(wide, ids, long_cfg).select("row_id", "decision")
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
