"""Token counts through a digest cache.

Counts are stored by the digest of the normalised content and the version digest of the
tokenizer. A run settles on keys which digests are new, fetches one text for each of those,
encodes it, appends the count to the cache, and joins every document to its count.

Normalising must keep the count, and a byte-level tokenizer tells all characters apart, so it
only turns null into the empty text. Documents with equal texts share one stored count. Nulls
in the id, repeated ids and repeated rows are kept as they come; an empty input gives an empty
result. Only the id, the digest and the size of a document are shuffled with its copies; texts
move once, spread by (digest, id), and only those to encode.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import blocks
from .common import text_of, written
from .tokens import tokenizer, version

CACHE = "digest binary, n_tokens long"


def content_digest(text: Column) -> Column:
    """Digest of the normalised content."""
    return F.unhex(F.sha2(text_of(text), 256))


def count_column(text: Column, path: str) -> Column:
    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ids = tokenizer(path).ids
        for values in batches:
            yield pa.array((len(ids(t)) for b in blocks(values, 64) for t in b), pa.int64())

    return count(text_of(text))


def stored_counts(spark: SparkSession, cache: str, path: str) -> DataFrame:
    """One count per digest for this version of the tokenizer; none if nothing is stored yet."""
    try:
        found = spark.read.schema(CACHE).parquet(f"{cache}/tokenizer={version(path)}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], CACHE)
    # Two runs at the same time may have stored a digest twice.
    return found.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(docs: DataFrame, cache: str, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, digest, n_bytes, n_tokens`` of every row; new counts are appended to ``cache``."""
    spark = docs.sparkSession
    body = docs.select(F.col(doc_id).alias("doc_id"), text_of(F.col(text)).alias("body"))
    keys = written(body.select("doc_id", content_digest(F.col("body")).alias("digest"), F.octet_length("body").cast("long").alias("n_bytes")), "digests")
    new = keys.groupBy("digest").agg(F.min("doc_id").alias("first_id")).join(stored_counts(spark, cache, path), "digest", "left_anti")
    texts = body.withColumn("own", content_digest(F.col("body"))).join(
        new.hint("shuffle_hash"), (F.col("own") == F.col("digest")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    )
    counted = texts.select("digest", count_column(F.col("body"), path).alias("n_tokens"))
    # Rows that repeat id and text meet here again.
    counted = counted.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    counted.write.mode("append").parquet(f"{cache}/tokenizer={version(path)}")
    # Written, so that no aggregate keeps the join from splitting a digest of very many copies.
    counts = written(stored_counts(spark, cache, path), "counts")
    return keys.join(counts, "digest").select("doc_id", "digest", "n_bytes", "n_tokens")
