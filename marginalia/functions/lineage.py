"""Cutting lineage through written tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import shared_dir


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The copy survives the loss of executors, keeps column pruning and filter pushdown
    for its readers, and gives the optimizer real sizes to choose joins by.
    ``codec`` is for tables of texts, which the session's codec may leave large.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)
