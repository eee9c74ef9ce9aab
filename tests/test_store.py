"""Shard store, CSV inference, gap runs, artefact listing."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from riskloom.sources import audit
from riskloom.sources.infer import read_csv, type_report
from riskloom.sources.shards import ShardError, ShardStore


def rows(spark, n=200):
    return spark.range(n).select(F.col("id").alias("row_id"), (F.col("id") % 3).cast("int").alias("model_id"),
                                 F.when(F.col("id") % 5 == 0, "val").otherwise("train").alias("split"),
                                 F.when(F.col("id") % 7 != 0, F.col("id") * 0.5).alias("x")).repartition(3)


def content(df):
    return sorted(map(str, df.select("row_id", "model_id", "split", "x").collect()))


def test_shards_round_trip_and_unchanged_shards_stay(spark, tmpdir_path):
    df, store = rows(spark), ShardStore(spark, tmpdir_path + "/s")
    with pytest.raises(ShardError):
        store.read()
    assert store.write(df) == {"written": 6, "kept": 0, "removed": 0}
    got = store.read()
    assert content(got) == content(df) and got.schema["model_id"].dataType.simpleString() == "int"
    assert content(store.read(model_id=1, split="val")) == content(df.where("model_id = 1 AND split = 'val'"))
    assert store.read(model_id=9).count() == 0
    one = len(store.read(model_id=1, split="val").inputFiles())
    assert one < len(got.inputFiles())  # only the shard's own files are opened
    # one shard changes, one goes: the others keep their files
    changed = df.withColumn("x", F.when(F.col("row_id") == 4, -1.0).otherwise(F.col("x"))).where("NOT (model_id = 0 AND split = 'val')")
    before = {k: s["folder"] for k, s in store.manifest().items()}
    assert store.write(changed) == {"written": 1, "kept": 4, "removed": 1}
    assert content(store.read()) == content(changed)
    after = {k: s["folder"] for k, s in store.manifest().items()}
    assert [k for k in after if after[k] != before[k]] == [("1", "train")]
    assert store.write(changed.repartition(7)) == {"written": 0, "kept": 5, "removed": 0}
    # folders no commit names go; nothing else
    store.write(rows(spark).withColumn("x", F.lit(0.0)))
    assert store.vacuum() == 2 and store.read().count() == 200


def test_torn_writes_are_refused(spark, tmpdir_path):
    df, path = rows(spark), tmpdir_path + "/s"
    store = ShardStore(spark, path)
    store.write(df)
    # data written without a commit is not seen
    df.write.parquet(f"{path}/data/write-lost/shard=0")
    assert content(store.read()) == content(df)
    victim = sorted(glob.glob(f"{path}/data/write-*/shard=0/*.parquet"))[0]
    victim = next(f for f in glob.glob(f"{path}/{store.manifest()[('0', 'train')]['folder']}/*.parquet"))
    os.remove(victim)
    with pytest.raises(ShardError):
        store.read()
    assert content(store.read(model_id=1)) == content(df.where("model_id = 1"))


def test_shards_with_null_keys_and_no_rows(spark, tmpdir_path):
    store = ShardStore(spark, tmpdir_path + "/s")
    df = spark.createDataFrame([(1, None, "a/b=c %", 1.0), (2, None, None, None), (2, None, None, None)],
                               "row_id long, model_id int, split string, x double")
    assert store.write(df)["written"] == 2 and content(store.read()) == content(df)
    assert store.write(df.limit(0)) == {"written": 0, "kept": 0, "removed": 2} and store.read().count() == 0


def test_types_of_csv_cells(spark, tmpdir_path):
    raw = spark.createDataFrame([("1", "1.5", "True", "x", None, "7"), ("-2", "2", "FALSE", "1", "", "8"), (" 3 ", "NaN", "NA", "2", "NA", "oops"),
                                 ("+4", "1e-3", "true", "3", " ", "9")], "a string, b string, c string, d string, e string, f string")
    kinds = lambda t: {r["column"]: (r.kind, r.cells, r.missing, r.bad) for r in type_report(raw, t).collect()}
    strict = {"a": ("long", 4, 0, 0), "b": ("double", 4, 1, 0), "c": ("boolean", 4, 1, 0), "d": ("text", 4, 0, 0),
              "e": ("double", 4, 4, 0), "f": ("text", 4, 0, 0)}
    assert kinds(0.0) == strict
    assert kinds(0.25) == strict | {"d": ("long", 4, 0, 1), "f": ("long", 4, 0, 1)}
    raw.write.option("header", True).csv(tmpdir_path + "/c")
    typed, _ = read_csv(spark, tmpdir_path + "/c", tolerance=0.25)
    assert [t for _, t in typed.dtypes] == ["bigint", "double", "boolean", "bigint", "double", "bigint"]
    assert sorted((r.a, r.b, r.c, r.d, r.e, r.f) for r in typed.collect()) == [
        (-2, 2.0, False, 1, None, 8), (1, 1.5, True, None, None, 7), (3, None, None, 2, None, None), (4, 0.001, True, 3, None, 9)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_csv(spark, tmpdir_path + "/nowhere")


def test_gap_runs(spark):
    day = lambda k: dt.date(2024, 3, k)
    obs = spark.createDataFrame([("a", day(2)), ("a", day(2)), ("a", day(6)), ("b", day(1)), ("b", day(2)), ("c", None), (None, day(3)),
                                 ("d", day(8))], "e string, d date")
    got = sorted((r.e, r.first_missing.day, r.last_missing.day, r.days) for r in audit.gap_runs(obs, ["e"]).collect())
    assert got == [("a", 1, 1, 1), ("a", 3, 5, 3), ("a", 7, 8, 2), ("b", 3, 8, 6), ("d", 1, 7, 7)]
    assert audit.daily_gaps(obs, ["e"]).count() == 19 and audit.gap_runs(obs.limit(0), ["e"]).count() == 0
    far = obs.unionByName(spark.createDataFrame([("b", dt.date(9999, 1, 1))], "e string, d date"))
    assert audit.gap_runs(far, ["e"]).count() == 6  # one wrong date: longer runs, not a grid


def test_listing_finds_missing_and_cut_artefacts(spark, tmpdir_path):
    root = tmpdir_path + "/a"
    for m, s, size in ((1, 1, 10), (1, 2, 2), (2, 2, 3), (2, 1, 0)):
        os.makedirs(f"{root}/model_id={m}/session={s}")
        with open(f"{root}/model_id={m}/session={s}/w.bin", "wb") as f:
            f.write(b"x" * size)
    with open(f"{root}/stray.bin", "wb") as f:
        f.write(b"x")
    files = audit.listing(spark, root, ["model_id", "session"])
    assert sorted((r.model_id or "-", r.session or "-", r.length) for r in files.collect()) == [
        ("-", "-", 1), ("1", "1", 10), ("1", "2", 2), ("2", "2", 3)]
    assert sorted((r.model_id, r.session) for r in audit.artefact_gaps(files, 2, 2, least_bytes=3).collect()) == [(1, 2), (2, 1)]
