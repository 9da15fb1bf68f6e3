"""Writers: documents, chunks, versioned snapshots, append-only logs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C


def write_documents(docs: DataFrame, path: str) -> None:
    """Canonical documents laid out by locale and section folder.

    Rows are rebalanced by folder: small folders get one file each, and AQE splits a
    folder that holds a large share of the corpus over as many tasks as its size asks for.
    """
    laid = docs.withColumn("section_dir", F.coalesce(C.non_empty(C.section_dir("section")), F.lit("_root")))
    laid = laid.hint("rebalance", "locale", "section_dir")
    laid.write.mode("overwrite").partitionBy("locale", "section_dir").parquet(path)


def write_chunks(chunks: DataFrame, path: str) -> None:
    """Chunks by locale, rebalanced so that a large locale is split and files stay whole."""
    chunks.hint("rebalance", "locale").write.mode("overwrite").partitionBy("locale").parquet(path)


def chunk_manifest(chunks: DataFrame) -> DataFrame:
    """One header row; the chunk rows themselves stay in the table."""
    return chunks.agg(F.lit("1.0").alias("schema_version"), F.count(F.lit(1)).alias("chunks"))


class SnapshotStore:
    """Versioned snapshots of a table below one folder.

    Each publish writes a folder of its own, counts it, and only then appends a pointer
    row that names it: a reader sees the old or the new rows, and a refused publish
    touches nothing that is published, whatever its version is called. The last pointer
    row counts; a version published again points to its new folder.
    """

    POINTER = "version string, n_rows bigint, folder string, published_at timestamp"

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _pointer(self) -> DataFrame:
        """Pointer rows so far; an empty table before the first publish."""
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/pointer")
        fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return self.spark.createDataFrame([], self.POINTER)
        return self.spark.read.schema(self.POINTER).parquet(f"{self.root}/pointer")

    def _last(self):
        return self._pointer().agg(F.max(F.struct("version", "published_at", "n_rows", "folder")).alias("v")).first()["v"]

    def latest(self) -> tuple[str, int] | None:
        row = self._last()
        return (row["version"], row["n_rows"]) if row else None

    def publish(self, table: DataFrame, version: str, read_errors: int = 0) -> str:
        """Write and point to a version. Refuses a run with read errors, and an empty
        result over a non-empty one. Returns written, read_errors or clobbered."""
        if read_errors:
            return "read_errors"
        folder = f"version={version}/{uuid.uuid4().hex}"
        table.write.parquet(f"{self.root}/{folder}")
        n = self.spark.read.schema(table.schema).parquet(f"{self.root}/{folder}").count()
        before = self.latest()
        if n == 0 and before and before[1] > 0:
            return "clobbered"
        row = self.spark.createDataFrame([(version, n, folder)], "version string, n_rows bigint, folder string")
        row.withColumn("published_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{self.root}/pointer")
        return "written"

    def read(self, schema) -> DataFrame:
        """The latest published version, an empty table when there is none."""
        now = self._last()
        if now is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{now['folder']}")


def append_failures(failures: DataFrame, path: str) -> None:
    """Failure log: earlier entries are kept."""
    failures.write.mode("append").parquet(path)


def merge_failures(earlier: DataFrame, failures: DataFrame) -> DataFrame:
    return earlier.unionByName(failures)


def asset_pool(assets: DataFrame) -> DataFrame:
    """Content-addressed pool: equal bytes share one key.

    Only the hash, the extension and the size are shuffled, never the bytes.
    """
    digest = F.sha2("content", 256)
    keyed = assets.select(
        digest.alias("sha256"),
        F.concat(F.lit("assets/"), digest, C.extension_of("mime_type")).alias("key"),
        F.octet_length("content").cast("bigint").alias("size_bytes"),
    )
    return keyed.groupBy("key", "sha256").agg(F.max("size_bytes").alias("size_bytes"), F.count(F.lit(1)).alias("refs"))
