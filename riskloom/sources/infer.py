"""CSV with inferred types.

One distributed aggregation looks at every cell and counts, for each column,
how many cells are missing and how many parse as a whole number, a number or a
truth value. From whole number up to text each type holds all that is below it;
a column gets the lowest type that all its cells parse as, or all but a
tolerated share, whose cells are counted as bad and read as missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.sources.io import MISSING

# Spellings of truth values.
TRUTH = ["True", "TRUE", "true", "False", "FALSE", "false"]
WHOLE = "^[+-]?[0-9]{1,18}$"
NUMBER = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
KINDS = {"boolean": T.BooleanType(), "long": T.LongType(), "double": T.DoubleType(), "text": T.StringType()}


def _cell(name: str) -> Column:
    """The trimmed cell; null where it stands for a missing value."""
    text = F.trim(F.col(f"`{name}`"))
    return F.when(~text.isin(MISSING), text)


def cell_counts(raw: DataFrame) -> DataFrame:
    """One row a column: place, column, cells, missing, and cells that parse as each type."""
    aggs = []
    for i, c in enumerate(raw.columns):
        x = _cell(c)
        aggs.append(F.struct(
            F.lit(i).alias("place"), F.lit(c).alias("column"), F.count(F.lit(1)).alias("cells"),
            F.count_if(x.isNull()).alias("missing"), F.count_if(x.isin(TRUTH)).alias("boolean"),
            F.count_if(x.rlike(WHOLE)).alias("long"), F.count_if(x.rlike(NUMBER)).alias("double")).alias(f"c{i}"))
    return raw.agg(*aggs).select(F.explode(F.array(*[F.col(f"c{i}") for i in range(len(aggs))])).alias("e")).select("e.*")


def type_report(raw: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """place, column, kind, cells, missing, bad: a column's kind is the lowest
    type that at least 1 - ``tolerance`` of its present cells parse as, text
    otherwise; bad are the present cells that do not parse as it. A column
    without any present cell is a double."""
    there = F.col("cells") - F.col("missing")
    able = lambda k: there - F.col(k) <= F.lit(float(tolerance)) * there
    kind = (F.when(there == 0, "double").when(able("boolean"), "boolean").when(able("long"), "long")
            .when(able("double"), "double").otherwise("text"))
    bad = F.when(F.col("kind") == "text", F.lit(0)).otherwise(there - F.coalesce(*[
        F.when(F.col("kind") == k, F.col(k)) for k in ("boolean", "long", "double")]))
    return (cell_counts(raw).withColumn("kind", kind).withColumn("bad", bad.cast("long"))
            .select("place", "column", "kind", "cells", "missing", "bad"))


def read_csv(spark: SparkSession, path: str, tolerance: float = 0.0, **options) -> tuple[DataFrame, DataFrame]:
    """The typed table of CSV files with a header, and its type report.

    Files are read once to find the types and again as the result is used.
    Missing and bad cells are null; a path that is not there fails at once."""
    raw = spark.read.options(header=True, mode="PERMISSIVE", **options).csv(path)
    report = type_report(raw, tolerance)
    kinds = {r["column"]: r["kind"] for r in report.collect()}  # one row a column
    able = {"boolean": lambda x: x.isin(TRUTH), "long": lambda x: x.rlike(WHOLE), "double": lambda x: x.rlike(NUMBER)}

    def typed(c: str) -> Column:
        x, kind = _cell(c), kinds[c]
        return x if kind == "text" else F.when(able[kind](x), x).try_cast(KINDS[kind])

    return raw.select(*[typed(c).alias(c) for c in raw.columns]), report
