"""Validation rules and error reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed


def catalog_violations(docs: DataFrame, scope: tuple[str, ...] = ("locale",), version: str = "1.0") -> DataFrame:
    """Slugs held twice within ``scope``, missing ids and hashes, unknown versions.

    An empty ``scope`` makes slugs unique over the whole catalog.
    """
    held = docs.groupBy(*scope, "slug").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    twice = held.select(
        F.lit("duplicate-slug").alias("violation"), F.concat_ws("/", *scope, "slug").alias("subject"), "n"
    )
    found = F.array(
        _finding(C.non_empty("page_id").isNull(), "missing-page-id", "title"),
        _finding(C.non_empty("content_hash").isNull(), "missing-content-hash", "page_id"),
        _finding(F.col("schema_version") != version, "unsupported-version", "page_id"),
    )
    rows = docs.select(F.explode(F.filter(found, lambda f: f.isNotNull())).alias("f"))
    return twice.unionByName(rows.select("f.violation", "f.subject", F.lit(1).cast("bigint").alias("n")))


def _finding(condition: Column, violation: str, subject: str) -> Column:
    return F.when(condition, F.struct(F.lit(violation).alias("violation"), F.col(subject).alias("subject")))


def metadata_rules(docs: DataFrame) -> DataFrame:
    """One row per (page, broken rule) of the metadata schema."""
    def absent(c: str) -> Column:
        return F.col(c).isNull()

    rules = {
        "page_id required": absent("page_id"),
        "title required": absent("title"),
        "content_hash required": absent("content_hash"),
        "locale required": absent("locale"),
        "slug required": absent("slug"),
        "status known": ~F.coalesce(F.col("status").isin(*fixed.STATUSES), F.lit(False)),
        "language_source known": ~F.coalesce(F.col("language_source").isin(*fixed.LANGUAGE_SOURCES), F.lit(True)),
        "publish status present": absent("publish_status"),
    }
    broken = F.filter(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]), lambda r: r.isNotNull())
    return docs.select("page_id", F.explode(broken).alias("rule"))


def error_category(status: Column | str, message: Column | str, kind: Column | str | None = None) -> Column:
    """Category from the failure kind, then the status code, then the message text."""
    s, m = C.col(status), C.col(message)
    out = F.when(F.lit(False), "")
    if kind is not None:
        k = C.col(kind)
        out = out.when(k == "network", "network").when(k == "abort", "timeout")
    return (
        out.when(s == 429, "rate_limit")
        .when(s >= 500, "http_5xx")
        .when(s >= 400, "http_4xx")
        .when(m.rlike("JSON|parse|schema|validation"), "validation")
        .otherwise("unknown")
    )


def is_retryable(category: Column | str) -> Column:
    return C.col(category).isin(*fixed.RETRYABLE)


def error_summary(errors: DataFrame, top: int = 5) -> DataFrame:
    """Total, count per category and the most frequent messages as one report."""
    one = F.count(F.lit(1)).alias("n")
    total = errors.agg(one).select(F.lit("total").alias("line"), F.lit("").alias("name"), "n")
    by_cat = errors.groupBy("category").agg(one).select(F.lit("category").alias("line"), F.col("category").alias("name"), "n")
    by_msg = errors.groupBy("message").agg(one).orderBy(F.desc("n"), "message").limit(top)
    by_msg = by_msg.select(F.lit("message").alias("line"), F.col("message").alias("name"), "n")
    return total.unionByName(by_cat).unionByName(by_msg)


def manifest_header(scanned: DataFrame) -> DataFrame:
    """Counts of a catalog run: documents in all and per locale and status, blobs skipped,
    blobs that could not be read. One aggregate over the outcome of ``scan_metadata``."""
    page = F.col("outcome") == "page"
    counts = scanned.groupBy(
        "outcome", F.when(page, F.col("meta.locale")).alias("locale"), F.when(page, F.col("meta.status")).alias("status")
    ).agg(F.count(F.lit(1)).alias("n"))
    names = F.create_map(*[F.lit(x) for x in ("page", "docs", "skipped", "skipped", "read_error", "read_errors")])
    per_group = counts.select(F.element_at(names, F.col("outcome")).alias("measure"), "locale", "status", "n")
    none = F.lit(None).cast("string")
    total = counts.filter("outcome = 'page'").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return per_group.unionByName(
        total.select(F.lit("docs_total").alias("measure"), none.alias("locale"), none.alias("status"), "n")
    )
