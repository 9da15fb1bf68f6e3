"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(column: Column) -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(column, F.lit(""))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder that every executor reaches; a run never meets another run's rows."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: survives lost executors and cuts lineage."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept_rows(df: DataFrame, kept: str, row: str) -> DataFrame:
    """The fields of ``row`` where ``kept`` holds.

    A filter would be pushed below the columns it is computed from, with all of them written
    out in it again; behind an outer generator each of them is computed once.
    """
    one = F.when(F.col(kept), F.array(row))
    out = df.select(F.posexplode_outer(one).alias("__pos", "__row"))
    return out.filter("__pos is not null").select("__row.*")


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder below the shared one, wherever that lives."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
