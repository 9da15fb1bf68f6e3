"""Catalog rows and document headers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed
from ..functions.rows import array_rows


# --- fixed values: property names of a source page --------------------------------
ELEMENT_TYPE = "Element Type"
PUBLISH_STATUS = "Publish Status"
RELATED = "Sub-item"
LANGUAGE = "Language"
SECTION = "Content Section"
ORDER = "Order"
KEYWORDS = "Keywords"
TAGS = "Tags"
PUBLISHED = "Date Published"


def extract_metadata(snapshots: DataFrame, default_keywords=fixed.DEFAULT_KEYWORDS, default_tags=()) -> DataFrame:
    """Typed metadata of raw page snapshots.

    ``snapshots`` has page_id, source_idx and ``snapshot``, the page's JSON as VARIANT
    (see sources.scans.scan_snapshots). Every field is read by path, in one pass.
    """
    s = F.col("snapshot")

    def prop(name: str) -> Column:
        return F.try_variant_get(s, f'$.properties["{name}"]', "variant")

    def names(name: str, field: str, part: str) -> Column:
        items = F.try_variant_get(s, f'$.properties["{name}"].{field}', f"array<struct<{part}: string>>")
        return F.coalesce(F.transform(items, lambda i: i[part]), F.expr("CAST(array() AS array<string>)"))

    runs = "array<struct<plain_text: string>>"
    # The first title property present decides, even when it holds no text.
    title = F.lit(None).cast("string")
    for name in reversed(fixed.TITLE_PROPERTIES):
        held = F.try_variant_get(s, f'$.properties["{name}"].title', runs)
        text = F.when(F.size(held) > 0, C.joined_runs(held))
        title = F.when(prop(name).isNotNull(), text).otherwise(title)
    language = C.property_text(prop(LANGUAGE))
    label = C.property_text(prop(PUBLISH_STATUS))
    order = F.regexp_extract(C.property_text(prop(ORDER)), r"^\s*([+-]?\d+)", 1)
    listed = names(RELATED, "relation", "id")
    return snapshots.select(
        "page_id",
        "source_idx",
        F.coalesce(title, "page_id").alias("title"),
        C.normalize_locale(language).alias("locale"),
        C.property_text(prop(SECTION)).alias("section"),
        F.when(order != "", order.cast("int")).alias("section_order"),
        C.property_text(prop(ELEMENT_TYPE)).alias("element_type"),
        label.alias("publish_status"),
        C.status_of(label).alias("status"),
        F.filter(listed, lambda i: i.isNotNull() & (i != "")).alias("sub_items"),
        C.names_or_default(names(KEYWORDS, "multi_select", "name"), default_keywords).alias("keywords"),
        C.names_or_default(names(TAGS, "multi_select", "name"), default_tags).alias("tags"),
        F.try_variant_get(s, f'$.properties["{PUBLISHED}"].date.start', "string").alias("published_date"),
        C.emoji_icon(
            F.try_variant_get(s, "$.icon.type", "string"), F.try_variant_get(s, "$.icon.emoji", "string")
        ).alias("icon"),
        C.language_provenance(language).alias("language_source"),
        F.try_variant_get(s, "$.last_edited_time", "string").alias("edited_at"),
    )


def manifest_docs(meta: DataFrame) -> DataFrame:
    """Metadata row to catalog row, 18 columns, dead pages included."""
    return meta.select(
        "page_id", "title", "locale", "section", "section_order",
        "element_type", F.col("publish_status").alias("drafting_status"), "slug",
        C.document_id("section", "slug").alias("docusaurus_id"),
        F.concat(F.lit("/"), "slug").alias("docusaurus_path"),
        C.document_key("locale", "section", "slug").alias("r2_doc_key"),
        C.page_key("page_id", "metadata.json").alias("r2_metadata_key"),
        F.concat(F.lit(fixed.SOURCE_URL), C.undashed("page_id")).alias("source_url"),
        "edited_at", "content_hash", "status",
        "sub_items", "language_source",
    )


def stable_fingerprint(meta: DataFrame, fields: list[str]) -> Column:
    """Hash of the fields that decide artifacts. Edit time and raw hash are left out by
    the caller's list; of assets only the content address counts."""
    parts = [
        F.transform("assets", lambda a: a.dropFields("original_url")).alias("assets") if f == "assets" else F.col(f)
        for f in sorted(fields)
    ]
    return C.content_hash(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}))


def frontmatter_rows(meta: DataFrame, author: str = "editors") -> DataFrame:
    """Header lines of each document in order; empty and missing values leave no line."""
    def line(key: str, value: Column) -> Column:
        return F.struct(F.lit(key).alias("key"), F.concat(F.lit(f"{key}: "), value).alias("line"))

    def listed(key: str, c: str) -> Column:
        items = F.array_join(F.transform(c, lambda v: C.yaml_scalar(v)), ", ")
        return F.struct(
            F.lit(key).alias("key"),
            F.when(F.size(c) > 0, F.concat(F.lit(f"{key}: ["), items, F.lit("]"))).alias("line"),
        )

    def text(key: str, c: Column | str) -> Column:
        return line(key, C.yaml_scalar(c))

    updated = F.concat(
        F.lit("last_update:\n  "), F.lit("date: "), C.display_date(F.coalesce(C.non_empty("published_date"), F.col("edited_at"))), F.lit(f"\n  author: {author}")
    )
    icon = F.concat(F.lit("sidebar_custom_props:\n  icon: "), F.col("icon"))
    rows = F.array(
        text("id", "slug"),
        text("title", "title"),
        text("slug", F.concat(F.lit("/"), "slug")),
        text("sidebar_label", "title"),
        line("sidebar_position", F.col("section_order").cast("string")),
        text("pagination_label", "title"),
        text("custom_edit_url", F.concat(F.lit(fixed.EDIT_URL), C.undashed("page_id"))),
        line("source", F.lit("notion")),
        text("notion_page_id", "page_id"),
        text("notion_last_edited_time", "edited_at"),
        text("content_hash", "content_hash"),
        text("status", "status"),
        text("locale", "locale"),
        text("section", "section"),
        listed("keywords", "keywords"),
        listed("tags", "tags"),
        F.struct(F.lit("last_update").alias("key"), updated.alias("line")),
        F.struct(F.lit("sidebar_custom_props").alias("key"), icon.alias("line")),
    )
    kept = F.filter(rows, lambda r: r["line"].isNotNull())
    return array_rows(meta, ["page_id"], kept, "ord", "r").select("page_id", "ord", "r.key", "r.line")


def header_overrides(headers: DataFrame, overrides: DataFrame) -> DataFrame:
    """Replace id, slug and position by canonical values where they differ and put an
    inherited heading in. ``overrides`` has one row per page."""
    rows = headers.join(overrides, "page_id", "left")
    differs = F.col("canonical_slug").isNotNull() & (F.col("canonical_slug") != F.col("stored_slug"))
    moved = F.col("canonical_order").isNotNull() & (
        F.col("canonical_order") != F.coalesce("stored_order", F.lit(fixed.UNCATEGORIZED_ORDER))
    )
    titled = C.non_empty("heading").isNotNull()
    quoted = F.concat(F.lit('  title: "'), F.replace(F.col("heading"), F.lit('"'), F.lit('\\"')), F.lit('"'))
    props = F.concat(F.lit("sidebar_custom_props:\n"), quoted)
    position = F.when(moved, F.concat(F.lit("sidebar_position: "), F.col("canonical_order").cast("string"))).otherwise(
        F.col("line")
    )
    new = (
        F.when((F.col("key") == "id") & differs, F.concat(F.lit('id: "'), "canonical_slug", F.lit('"')))
        .when((F.col("key") == "slug") & differs, F.concat(F.lit("slug: /"), "canonical_slug"))
        .when(
            (F.col("key") == "sidebar_position") & titled & ~F.col("has_props"),
            F.concat(position, F.lit("\n"), props),
        )
        .when(F.col("key") == "sidebar_position", position)
        .when((F.col("key") == "sidebar_custom_props") & titled, props)
        .otherwise(F.col("line"))
    )
    return rows.select("page_id", "ord", "key", new.alias("line"))
