"""Shard store with manifest commits.

A shard is the rows of one (model, split). Shards are written to a folder that
no reader knows yet; the manifest, one small file that is there or not, then
names for every shard its folder, row count and checksum. A write that was
torn leaves the old manifest in force. Shards whose content did not change keep
their files, only the others are written. Readers open just the folders of the
shards they ask for and compare rows and checksum with the manifest.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.schema import require_columns
from riskloom.session import drop_path, materialize

MANIFEST = "commit int, shards array<struct<key:array<string>,rows:bigint,checksum:string,folder:string>>, schema string"


class ShardError(IOError):
    """Stored shards are not what their manifest says."""


def checksums(df: DataFrame, keys: list[str]) -> DataFrame:
    """keys (as text)..., rows, checksum: sums of row hashes, whatever the order of the rows."""
    h = F.xxhash64(*sorted(df.columns))
    low = F.pmod(h, F.lit(1 << 31)).cast("decimal(38,0)")
    total = F.concat_ws("-", F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).cast("string"),
                        F.coalesce(F.sum(low * low), F.lit(0)).cast("string"))
    return df.groupBy(*[F.col(k).cast("string").alias(k) for k in keys]).agg(F.count(F.lit(1)).alias("rows"), total.alias("checksum"))


class ShardStore:
    def __init__(self, spark: SparkSession, path: str, keys: tuple[str, ...] = ("model_id", "split")):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)

    def _commits(self) -> list:
        try:
            rows = self.spark.read.schema(MANIFEST).json(f"{self.path}/manifest").collect()
        except Exception as e:  # noqa: BLE001 - nothing committed yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return []
        return sorted(rows, key=lambda r: r.commit)

    def manifest(self) -> dict[tuple, dict]:
        """Shards of the newest commit by key."""
        commits = self._commits()
        return {tuple(s.key): s.asDict() for s in commits[-1].shards} if commits else {}

    def write(self, df: DataFrame) -> dict[str, int]:
        """Make ``df`` the content of the store; how many shards were written,
        kept and removed. Null keys are keys too."""
        require_columns(df, self.keys)
        # rows may come from a plan that is costly or not repeatable: both passes read one copy
        df = materialize(df, "shards-staged")
        want = {tuple(r[k] for k in self.keys): r for r in checksums(df, self.keys).collect()}  # one row a shard
        commits = self._commits()
        old = {tuple(s.key): s for s in commits[-1].shards} if commits and commits[-1].schema == df.schema.json() else {}
        gone = [k for k in (self.manifest() if commits else {}) if k not in want]
        kept = {k: s for k, s in old.items() if k in want and (s.rows, s.checksum) == (want[k].rows, want[k].checksum)}
        changed = [k for k in want if k not in kept]
        folder = f"data/write-{uuid.uuid4().hex[:12]}"
        if changed:
            names = [f"key{i}" for i in range(len(self.keys))]
            which = self.spark.createDataFrame([(*k, i) for i, k in enumerate(changed)],
                                               ", ".join(f"{n} string" for n in names) + ", shard int")  # models times splits rows
            match = reduce(and_, [F.col(k).cast("string").eqNullSafe(F.col(n)) for k, n in zip(self.keys, names)])
            dealt = df.join(F.broadcast(which), match).drop(*names)
            dealt.hint("rebalance", "shard").write.partitionBy("shard").parquet(f"{self.path}/{folder}")
        shards = [(list(k), s.rows, s.checksum, s.folder) for k, s in kept.items()]
        shards += [(list(k), want[k].rows, want[k].checksum, f"{folder}/shard={i}") for i, k in enumerate(changed)]
        number = commits[-1].commit + 1 if commits else 1
        row = self.spark.createDataFrame([(number, shards, df.schema.json())], MANIFEST)
        row.coalesce(1).write.mode("append").json(f"{self.path}/manifest")
        return {"written": len(changed), "kept": len(kept), "removed": len(gone)}

    def read(self, verify: bool = True, **keys) -> DataFrame:
        """Rows of the shards whose keys are as given; none asked for: all.

        ``verify`` compares rows and checksum of every shard first and raises
        ``ShardError`` where files are missing or changed."""
        commits = self._commits()
        if not commits:
            raise ShardError(f"{self.path}: no commit")
        schema = T.StructType.fromJson(json.loads(commits[-1].schema))
        wanted = {k: str(v) for k, v in keys.items()}
        shards = [s for s in commits[-1].shards if all(s.key[self.keys.index(k)] == v for k, v in wanted.items())]
        if not shards:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path}/{s.folder}" for s in shards]
        try:
            df = self.spark.read.schema(schema).parquet(*paths)
        except Exception as e:  # noqa: BLE001
            raise ShardError(f"{self.path}: a shard's folder is missing") from e
        if verify:
            found = {tuple(r[k] for k in self.keys): (r.rows, r.checksum) for r in checksums(df, self.keys).collect()}
            wrong = [s.key for s in shards if found.get(tuple(s.key)) != (s.rows, s.checksum)]
            if wrong:
                raise ShardError(f"{self.path}: shards differ from their manifest: {wrong[:5]}")
        return df

    def vacuum(self) -> int:
        """Delete written folders none of whose shards the newest commit names."""
        used = {s.folder.split("/")[1] for s in self._commits()[-1].shards}
        data = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/data")
        found = [s.getPath().getName() for s in data.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(data)]
        stale = [name for name in found if name not in used]
        for name in stale:
            drop_path(self.spark, f"{self.path}/data/{name}")
        return len(stale)
