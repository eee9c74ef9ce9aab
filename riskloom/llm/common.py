"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts lineage with a copy that outlives any executor, and keeps costly
    upstream work from running once per consumer.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    made = spark.read.schema(df.schema).parquet(path)
    made.stored_path = path
    return made


def tidy(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of steps that nothing can read again, before a large one."""
    spark._jvm.System.gc()


def discard(*made: DataFrame) -> None:
    """Delete tables of :func:`stored` whose readers are all stored themselves.

    Their plans are let go too, so that Spark's cleaner removes the shuffle
    files of steps that nothing can read again.
    """
    for df in made:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.stored_path)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
        jvm.System.gc()


def text_or_empty(col: str = "text") -> Column:
    """A null text counts as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def row_key(*cols: str) -> Column:
    """128-bit content key of a row: equal rows share it, null differs from empty."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in cols]
    return F.md5(F.concat_ws("\x1f", *parts))


def blocks_for(rows: int, per_block: int) -> int:
    """How many blocks of about ``per_block`` rows hold ``rows`` rows."""
    return max(1, math.ceil(rows / per_block))
