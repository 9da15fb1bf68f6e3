"""Readers: metadata blobs, Markdown documents, raw snapshots, listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed

METADATA_SCHEMA = """page_id string, title string, source_url string, notion_last_edited_time string,
    content_hash string, raw_hash string, locale string, section string, section_order int,
    slug string, docusaurus_id string, status string, keywords array<string>, tags array<string>,
    icon string, published_date string, element_type string, drafting_status string,
    sub_items array<string>, language_source string,
    assets array<struct<original_url: string, r2_key: string, sha256: string, mime_type: string>>"""
REQUIRED = (
    "page_id", "title", "source_url", "notion_last_edited_time", "content_hash", "raw_hash",
    "locale", "slug", "docusaurus_id", "status", "assets",
)

# Fields that hold one of a few values; an absent optional one is sound.
ALLOWED = {"status": fixed.STATUSES, "language_source": fixed.LANGUAGE_SOURCES}


def scan_metadata(
    blobs: DataFrame, schema: str, required: tuple[str, ...], raw: str = "raw", allowed: dict[str, tuple[str, ...]] | None = None
) -> DataFrame:
    """Parse JSON blobs in one pass and label each row page, skipped or read_error.

    A missing blob is a read error (transient); malformed JSON and rows that break the
    schema, its enumerations included, are skipped (permanent). Parsed fields are under ``meta``.
    """
    broken = "__broken"
    parsed = F.from_json(
        raw, f"{schema}, {broken} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken}
    )
    rows = blobs.withColumn("meta", parsed)
    complete = F.lit(True)
    for name in required:
        complete = complete & F.col(f"meta.{name}").isNotNull()
    for name, values in (allowed or {}).items():
        complete = complete & F.coalesce(F.col(f"meta.{name}").isin(*values), F.lit(True))
    outcome = (
        F.when(F.col(raw).isNull(), "read_error")
        .when(F.col(f"meta.{broken}").isNotNull() | ~complete, "skipped")
        .otherwise("page")
    )
    return rows.withColumn("outcome", outcome).withColumn("meta", F.col("meta").dropFields(broken))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Metadata blobs of a folder, one file each. Read once and pack the result."""
    blobs = spark.read.text(path, wholetext=True, pathGlobFilter="*metadata.json", recursiveFileLookup=True)
    blobs = blobs.select(F.col("value").alias("raw"), F.col("_metadata.file_path").alias("key"))
    return scan_metadata(blobs, METADATA_SCHEMA, REQUIRED, allowed=ALLOWED)


def split_document(docs: DataFrame, content: str = "content") -> DataFrame:
    """Add ``frontmatter`` (map) and ``body``; no header gives an empty map."""
    pattern = r"(?s)\A---\n(.*?)\n---\n(.*)\z"
    found = F.col(content).rlike(pattern)
    lines = F.transform(F.split(F.regexp_extract(content, pattern, 1), "\n"), F.trim)
    lines = F.filter(lines, lambda l: l.contains(":") & ~l.startswith("#"))
    pairs = F.transform(
        lines,
        lambda l: F.struct(
            F.trim(F.substring_index(l, ":", 1)).alias("key"),
            F.regexp_replace(F.trim(F.regexp_replace(l, "^[^:]*:", "")), "^[\"']|[\"']$", "").alias("value"),
        ),
    )
    # A repeated key keeps its last value.
    last = F.filter(
        pairs,
        lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["key"] == p["key"]),
    )
    empty = F.expr("CAST(map() AS map<string, string>)")
    return docs.withColumns(
        {
            "frontmatter": F.when(found, F.map_from_entries(last)).otherwise(empty),
            "body": F.when(found, F.regexp_extract(content, pattern, 2)).otherwise(F.col(content)),
        }
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.md", recursiveFileLookup=True)
    return split_document(files.select(F.col("value").alias("content"), F.col("_metadata.file_path").alias("key")))


def scan_snapshots(snapshots: DataFrame, key: str, raw: str) -> DataFrame:
    """Raw snapshots as VARIANT by key, for extraction without fetching again."""
    return snapshots.select(key, F.try_parse_json(raw).alias("snapshot"))


def list_prefix(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """Keys and sizes of the files below a prefix, contents not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if suffix:
        files = files.option("pathGlobFilter", f"*{suffix}")
    return files.load(path).select(F.col("path").alias("key"), F.col("length").alias("size_bytes"))


def filter_prefix(inventory: DataFrame, prefix: str, suffix: str = "") -> DataFrame:
    return inventory.filter(F.col("key").startswith(prefix) & F.col("key").endswith(suffix))


def artifact_inventory(pages: DataFrame) -> DataFrame:
    """One row per written artifact: key, type, page, content hash, size."""
    none = F.lit(None).cast("string")
    rows = F.array(
        _artifact(C.page_key("page_id", "metadata.json"), "metadata", F.col("content_hash"), F.octet_length("title")),
        _artifact(C.document_key("locale", "section", "slug"), "doc", F.col("content_hash"), F.octet_length("body")),
        _artifact(C.page_key("page_id", "raw-page.json"), "raw_page", none, F.octet_length("title")),
        _artifact(C.page_key("page_id", "raw-blocks.json"), "raw_blocks", none, F.octet_length("body")),
    )
    return pages.select("page_id", F.explode(rows).alias("a")).select("page_id", "a.*")


def _artifact(key: Column, kind: str, content_hash: Column, size: Column) -> Column:
    return F.struct(
        key.alias("key"),
        F.lit(kind).alias("artifact_type"),
        content_hash.alias("content_hash"),
        size.cast("bigint").alias("size_bytes"),
    )
