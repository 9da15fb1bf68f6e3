"""Route lookup tables and the resolution of internal links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed
from ..functions.ordered import best_per_group
from ..functions.rows import array_rows


def slug_routes(docs: DataFrame, published: DataFrame) -> DataFrame:
    """Every slug an author may write to the published slug; own slugs win over title
    slugs, those over published slugs, and the earliest page wins within a source."""
    known = docs.select("page_id", "slug", "title", "source_idx").join(published, "page_id")
    keys = F.array(C.slugify("slug"), C.slugify("title"), C.slugify("canonical_slug"))
    rows = known.select("source_idx", "canonical_slug", F.posexplode(keys).alias("pass", "key"))
    return best_per_group(
        rows.filter("key <> ''"), ["key"], [F.col("pass"), F.col("source_idx")], ["canonical_slug"]
    )


def id_routes(published: DataFrame) -> DataFrame:
    """Dashless page id, as links name it, to the published slug."""
    return published.select(C.undashed("page_id").alias("key"), "canonical_slug")


def _parts(target: Column | str) -> dict[str, Column]:
    t = F.regexp_replace(F.trim(C.col(target)), fixed.SOURCE_HOST, "")
    before, anchor = F.substring_index(t, "#", 1), F.regexp_extract(t, r"(?s)#(.*)$", 1)
    path = F.regexp_replace(F.regexp_replace(before, "/+$", ""), r"(?i)^/(?:es|pt)(?=/)", "")
    last = F.regexp_extract(path, r"(?i)^/docs/(?:.*/)?([^/]+)$", 1)
    in_docs = path.rlike("(?i)^/docs/.+")
    decoded = F.coalesce(F.try_url_decode(F.replace(last, F.lit("+"), F.lit("%2B"))), last)
    hex_id = F.lower(F.regexp_extract(path, "^/([0-9a-fA-F]{32})", 1))
    return {
        "link": t,
        "same_page": F.trim(C.col(target)).startswith("#"),
        "anchor": F.when(anchor != "", F.concat(F.lit("#"), C.anchor_slug(anchor))).otherwise(""),
        "slug_key": F.when(t.startswith("/") & in_docs, C.slugify(decoded)),
        "id_key": F.when(t.startswith("/") & ~in_docs, C.non_empty(hex_id)),
    }


def resolve_links(links: DataFrame, slugs: DataFrame, ids: DataFrame) -> DataFrame:
    """Add ``resolved``: the published route of ``target`` for a row's locale, or NULL.

    Both lookups are left joins on unique keys; when a map is small Spark broadcasts it,
    otherwise a popular target is split by AQE because its right side is a single row.
    """
    rows = links.withColumns(_parts("target"))
    by_slug = slugs.select(F.col("key").alias("slug_key"), F.col("canonical_slug").alias("__s"))
    by_id = ids.select(F.col("key").alias("id_key"), F.col("canonical_slug").alias("__i"))
    rows = rows.join(by_slug, "slug_key", "left").join(by_id, "id_key", "left")
    found = F.coalesce("__s", "__i")
    prefix = F.when(F.col("locale").isin(*fixed.PREFIXED_LOCALES), F.concat(F.lit("/"), "locale")).otherwise("")
    resolved = F.when(F.col("same_page"), F.nullif(F.col("anchor"), F.lit("#"))).when(
        found.isNotNull(), F.concat(prefix, F.lit("/docs/"), found, F.col("anchor"))
    )
    return rows.withColumn("resolved", resolved).drop("__s", "__i", "slug_key", "id_key", "anchor", "same_page")


def broken_links(resolved: DataFrame) -> DataFrame:
    """Internal targets without a route, with the number of links to each."""
    internal = F.col("link").startswith("/")
    return (
        resolved.filter(internal & F.col("resolved").isNull())
        .groupBy("target")
        .agg(F.count(F.lit(1)).alias("n"))
    )


_MARK = "\u0001"
_LINK = r"(?<!!)\[[^\]]*\]\(([^)]+)\)"


def rewrite_links(docs: DataFrame, slugs: DataFrame, ids: DataFrame, key: str = "page_id", text: str = "body") -> DataFrame:
    """Internal links of each document rewritten to published routes; images, external
    and unknown targets stay.

    Targets travel to the lookup, not texts; a document gets the map of its own resolved
    targets back and replaces inside its row. Needs ``locale``.
    """
    targets = F.array_distinct(F.regexp_extract_all(text, F.lit(_LINK), 1))
    links = array_rows(docs, [key, "locale"], targets, "pos", "target").drop("pos")
    found = resolve_links(links, slugs, ids).filter("resolved IS NOT NULL")
    # A document's own distinct targets, no more than its text already holds.
    routes = F.map_from_entries(F.collect_list(F.struct("target", "resolved"))).alias("__routes")
    rows = docs.join(found.groupBy(key).agg(routes), key, "left")
    parts = F.split(F.regexp_replace(F.col(text), f"({_LINK})", f"{_MARK}$1{_MARK}"), _MARK)

    def rewritten(part: Column, i: Column) -> Column:
        target = F.regexp_extract(part, r"\]\(([^)]+)\)$", 1)
        route = F.try_element_at("__routes", target)
        link = F.concat(F.regexp_extract(part, r"^(\[[^\]]*\]\()", 1), route, F.lit(")"))
        return F.when((i % 2 == 1) & route.isNotNull(), link).otherwise(part)

    new = F.when(F.col("__routes").isNull(), F.col(text)).otherwise(F.array_join(F.transform(parts, rewritten), ""))
    return rows.withColumn(text, new).drop("__routes")
