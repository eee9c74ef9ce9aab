"""Session helpers.

Nothing here hard-codes a cluster: on a real cluster the session already
exists (``getOrCreate`` returns it) and its configuration wins. The local
defaults only apply when this module creates the session itself (tests,
bench).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "4g",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "riskloom", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build a local one with sane defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(LOCAL_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder for lineage cuts.

    Read ``spark.checkpoint.dir`` from the session (the cluster names a shared
    folder there). Only when it is unset *and* the master is local do we make
    a private scratch folder, as in tests; on a cluster an unset value is an
    error, because a machine-local folder would not survive executor loss.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if conf:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(conf)
        return conf
    existing = sc.getCheckpointDir()
    if existing:
        return existing
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="riskloom-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    try:
        spark.conf.set("spark.checkpoint.dir", path)
    except Exception:  # some deployments forbid runtime changes of core confs
        pass
    sc.setCheckpointDir(path)
    return path


def materialize(df, name: str = "table"):
    """Cut lineage by writing ``df`` as a Parquet table under the shared
    checkpoint folder and reading it back (columnar, compressed, vectorised
    reads; survives executor loss, unlike cached blocks)."""
    import uuid
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a table that nothing reads any more, on whatever file system it is."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors (once per application), so that
    functions run by ``mapInPandas`` and the like can be unpickled there even
    when the package is only on the driver's ``sys.path``."""
    import zipfile
    sc = spark.sparkContext
    if getattr(sc, "_riskloom_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="riskloom-ship-"), "riskloom.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)  # Spark serves the file to every executor
    sc._riskloom_shipped = True


def scale_conf(shuffle_bytes: int, total_cores: int, target_bytes: int = 256 << 20) -> dict:
    """Partition sizing for a cluster run: about ``target_bytes`` per shuffle
    partition (fits executor memory without spilling much), never fewer than
    two waves of tasks; AQE then coalesces small partitions and splits skewed
    ones at runtime. Apply with ``spark.conf.set`` before the job."""
    import math
    n = max(2 * total_cores, math.ceil(shuffle_bytes / target_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
