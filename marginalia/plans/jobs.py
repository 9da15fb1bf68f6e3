"""The jobs of a content run, from raw snapshots to published tables.

Each job takes and writes tables; the operators stay lazy in between. They correspond to
a full build of the catalog, a publish, a chunk build and a validation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.lineage import written
from ..operators import assets, chunks, extraction, hierarchy, links, quality, text
from ..sources import scans, sinks


def build_catalog(snapshots: DataFrame, bodies: DataFrame) -> DataFrame:
    """Catalog of all pages, dead ones included, with unique slugs, body hashes and
    positions for pages that state none. ``bodies`` has page_id and body."""
    meta = written(extraction.extract_metadata(snapshots), "metadata")
    hashes = bodies.select(
        "page_id", C.content_hash("body").alias("content_hash"), (~C.is_stub("body")).alias("has_body")
    )
    slugs = hierarchy.unique_slugs(meta).select("page_id", "slug")
    placed = hierarchy.fallback_positions(meta).select("page_id", "section_order")
    out = meta.drop("section_order").join(slugs, "page_id").join(placed, "page_id").join(hashes, "page_id", "left")
    return out.withColumn("has_body", F.coalesce("has_body", F.lit(False)))


@dataclass
class Published:
    """Tables of one publish run."""

    plan: hierarchy.HierarchyPlan
    pages: DataFrame
    headers: DataFrame
    broken: DataFrame
    counters: DataFrame


def publish(catalog: DataFrame, bodies: DataFrame, include_drafts: bool = False) -> Published:
    """Routes, final bodies and headers of everything that goes live."""
    plan = hierarchy.HierarchyPlan(catalog, include_drafts)
    routes = plan.routes
    emitted = text.emit_pages(
        routes.select("page_id", "locale", "en_fallback_id", "en_sibling_id", "title", "canonical_section", "route_toggle", "canonical_slug"),
        bodies.select("page_id", "body"),
    )
    emitted = assets.repair_images(emitted, bodies.select("page_id", "body")).drop("en_sibling_id")
    emitted = written(emitted, "emitted")
    slugs, ids = links.slug_routes(plan.docs, plan.published_slugs), links.id_routes(plan.published_slugs)
    slugs, ids = written(slugs, "slug-routes"), written(ids, "id-routes")
    live = emitted.filter(F.col("outcome").isin("published", "fallback"))
    pages = links.rewrite_links(live, slugs, ids).withColumn("body", assets.static_images("body"))
    pages = pages.withColumn("path", C.route_path("canonical_section", "route_toggle", "canonical_slug"))
    targets = F.array_distinct(F.regexp_extract_all("body", F.lit(r"(?<!!)\[[^\]]*\]\(([^)]+)\)"), 1))
    found = live.select("page_id", "locale", F.explode(targets).alias("target"))
    broken = links.broken_links(links.resolve_links(found, slugs, ids))
    stored = catalog.select(
        "page_id", F.col("slug").alias("stored_slug"), F.col("section_order").alias("stored_order"),
        F.col("icon").isNotNull().alias("has_props"),
    )
    overrides = stored.join(routes.select("page_id", "canonical_slug", "canonical_order", "heading"), "page_id")
    headers = extraction.header_overrides(
        extraction.frontmatter_rows(catalog.join(routes.select("page_id"), "page_id", "left_semi")), overrides
    )
    return Published(plan, pages, headers, broken, text.emit_counters(emitted))


def write_published(run: Published, root: str) -> None:
    """Documents by locale and section folder, headers, navigation and messages."""
    documents = run.pages.withColumn("section", F.col("canonical_section"))
    sinks.write_documents(documents, f"{root}/documents")
    run.headers.write.mode("overwrite").parquet(f"{root}/headers")
    run.plan.nav_edges.write.mode("overwrite").parquet(f"{root}/navigation")
    run.plan.categories.write.mode("overwrite").parquet(f"{root}/categories")
    hierarchy.translation_messages(run.plan).write.mode("overwrite").parquet(f"{root}/messages")
    run.plan.diagnostics.write.mode("overwrite").parquet(f"{root}/diagnostics")


def build_chunks(catalog: DataFrame, bodies: DataFrame, include_drafts: bool = False) -> DataFrame:
    """Retrieval chunks of all publishable content pages.

    A stored text may begin with its header. Chunks are cut from what follows it, and the
    title, locale, slug and hash that the header names win over the catalog's.
    """
    pages = chunks.chunkable_pages(catalog, include_drafts).select("page_id", "title", "locale", "slug", "content_hash")
    docs = chunks.attach_bodies(pages, bodies.select(F.col("page_id").alias("key"), "body"))
    docs = scans.split_document(docs.withColumn("path", F.concat(F.lit("/"), "slug")), "body")
    named = {
        c: F.coalesce(C.non_empty(F.try_element_at("frontmatter", F.lit(c))), F.col(c)) for c in ("title", "locale", "slug", "content_hash")
    }
    docs = docs.withColumns(named).drop("frontmatter")
    rows = chunks.chunk_rows(docs.withColumn("lines", F.split("body", "\n")).drop("body"))
    return rows.withColumns(
        {
            "source_url": F.concat(F.lit(extraction.fixed.SOURCE_URL), C.undashed("page_id")),
            "docusaurus_path": F.col("path"),
            "status": F.lit("active"),
        }
    ).drop("path")


def validate(catalog: DataFrame, version: str = "1.0") -> DataFrame:
    """Findings that make a catalog unfit for publishing; no rows when it is sound."""
    return quality.catalog_violations(catalog.withColumn("schema_version", F.lit(version)))
