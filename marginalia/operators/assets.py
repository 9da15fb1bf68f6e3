"""Asset references: extraction, rewriting, the pool and image repair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed
from ..functions.folds import bound
from ..functions.ordered import block_of, bounded_row_number
from ..functions.rows import array_rows

_MARK = "\u0001"
_LINKED = r"\[!\[[^\]]*\]\(([^)]+)\)\]\([^)]+\)"
_PLAIN = r"!\[[^\]]*\]\(([^)]+)\)"
_HTML = r"(?i)<img\s[^>]*src=([\"'])([^\"']+)\1[^>]*>"


def asset_urls(text: Column | str) -> Column:
    """Image URLs of a text: linked images, plain images, tags; each once, in that order."""
    t = C.col(text)
    found = F.concat(
        F.regexp_extract_all(t, F.lit(_LINKED), 1),
        F.regexp_extract_all(t, F.lit(_PLAIN), 1),
        F.regexp_extract_all(t, F.lit(_HTML), 2),
    )
    return F.array_distinct(found)


def distinct_assets(docs: DataFrame, key: str, text: str) -> DataFrame:
    return array_rows(docs, [key], asset_urls(text), "ord", "url").withColumn(
        "managed", C.is_managed_asset("url")
    )


def _quoted(url: Column) -> Column:
    return F.concat(F.lit("\\Q"), url, F.lit("\\E"))


def _safe(text: Column) -> Column:
    """Text for use as a regex replacement."""
    return F.regexp_replace(text, r"([\\$])", r"\\$1")


def rewrite_assets(docs: DataFrame, pool: DataFrame, key: str, text: str) -> DataFrame:
    """Replace managed asset URLs by their pool key, mark those the pool lacks.

    Only URLs travel to the pool join; each document gets its own small map of URLs back
    and replaces inside its row, longest URL first. ``pool`` has url and asset_key.
    """
    urls = distinct_assets(docs, key, text).filter("managed").select(key, "url")
    found = urls.join(pool.select("url", "asset_key"), "url", "left")
    per_doc = found.groupBy(key).agg(
        F.sort_array(
            F.collect_list(F.struct(F.length("url").alias("n"), "url", "asset_key")), asc=False
        ).alias("__urls")
    )
    rows = docs.join(per_doc, key, "left")
    marker = lambda u: F.concat(F.lit("\n<!-- failed-asset: "), C.unsigned_url(u), F.lit(" -->"))

    def replaced(t: Column, u: Column) -> Column:
        note = _safe(marker(u["url"]))
        blank = F.regexp_replace(
            t, F.concat(F.lit(r"!\[\s*\]\("), _quoted(u["url"]), F.lit(r"\)")),
            F.concat(F.lit("**[Image unavailable]**"), note),
        )
        named = F.regexp_replace(
            blank, F.concat(F.lit(r"!\[([^\]]*)\]\("), _quoted(u["url"]), F.lit(r"\)")),
            F.concat(F.lit("**[Image unavailable: $1]**"), note),
        )
        tagged = F.regexp_replace(
            named,
            F.concat(F.lit("(?i)<img(?![A-Za-z0-9_])[^>]*\\ssrc=([\"'])"), _quoted(u["url"]), F.lit("\\1[^>]*>")),
            F.concat(F.lit("**[Image unavailable]**"), note),
        )
        return F.when(u["asset_key"].isNotNull(), F.replace(t, u["url"], u["asset_key"])).otherwise(tagged)

    none = F.expr("CAST(array() AS array<struct<n: int, url: string, asset_key: string>>)")
    return rows.withColumn(text, F.aggregate(F.coalesce("__urls", none), F.col(text), replaced)).drop("__urls")


def static_images(text: Column | str) -> Column:
    """Relative tag sources become site-root paths; names with path parts are left."""
    return F.regexp_replace(
        C.col(text), r'(?<![A-Za-z0-9_])src="assets/((?:(?!\.\.)[^"/\\])+)"', f'src="{fixed.STATIC_IMAGE_PREFIX}$1"'
    )


def referenced_assets(bodies: DataFrame, pool: DataFrame, key: str, text: str) -> DataFrame:
    """Asset names in bodies with their state: present, missing or unsafe."""
    names = F.array_distinct(
        F.concat(
            F.regexp_extract_all(text, F.lit(r'(?<![A-Za-z0-9_])src="assets/([^"]+)"'), 1),
            F.regexp_extract_all(text, F.lit(r"\]\(assets/([^)]+)\)"), 1),
        )
    )
    refs = array_rows(bodies, [key], names, "pos", "name").select(key, "name").distinct()
    known = pool.select("name").distinct().withColumn("__known", F.lit(True))
    state = (
        F.when(~C.safe_basename("name"), "unsafe").when(F.col("__known"), "present").otherwise("missing")
    )
    return refs.join(known, "name", "left").select(key, "name", state.alias("state"))


def repair_image_slots(slots: DataFrame, siblings: DataFrame) -> DataFrame:
    """The n-th slot of a translation, if a placeholder, takes the n-th real image of its
    English sibling; slots beyond the sibling's images stay.

    ``siblings`` maps page_id to en_page_id. Slots and images are numbered in buckets, so
    a page with very many images is not one task.
    """
    at = [block_of("ord")]
    numbered = bounded_row_number(slots, ["page_id"], at, ["ord"], "n")
    real = bounded_row_number(slots.filter("kind = 'real'"), ["page_id"], at, ["ord"], "n").select(
        F.col("page_id").alias("en_page_id"), "n", F.col("name").alias("en_name")
    )
    rows = numbered.join(siblings.select("page_id", "en_page_id"), "page_id", "left")
    rows = rows.join(real, ["en_page_id", "n"], "left")
    take = (F.col("kind") == "placeholder") & (F.col("locale") != "en") & F.col("en_name").isNotNull()
    return rows.select("page_id", "ord", "kind", "name", F.when(take, F.col("en_name")).otherwise(F.col("name")).alias("repaired"))


def with_repaired_images(body: Column, english: Column) -> Column:
    """``body`` with each note for a lost image replaced by the image of the same number in ``english``.

    All image slots of the body count, notes and images alike, so an image that is still there
    keeps the ones behind it in step. A note beyond the English images stays.
    """
    images = F.regexp_extract_all(english, F.lit(fixed.STORED_IMAGE), 0)
    pieces = F.split(F.regexp_replace(body, f"({fixed.LOST_IMAGE}|{fixed.STORED_IMAGE})", f"{_MARK}$1{_MARK}"), _MARK)

    def piece(own: Column, have: Column) -> Column:
        slot = lambda p, i: F.coalesce(F.when(p.startswith(fixed.LOST_IMAGE_START), F.get(have, ((i - 1) / 2).cast("int"))), p)
        return F.array_join(F.transform(own, lambda p, i: F.when(i % 2 == 1, slot(p, i)).otherwise(p)), "")

    return bound(pieces, lambda own: bound(images, lambda have: piece(own, have)))


def repair_images(docs: DataFrame, bodies: DataFrame, sibling: str = "en_sibling_id", body: str = "body") -> DataFrame:
    """``docs`` with lost images of translations put back from their English siblings.

    Needs page_id, locale and ``sibling``; ``bodies`` has page_id and body, one row a page. Only
    rows that hold a note for a lost image take part in the join, each with the one body it needs.
    """
    lost = F.col(body).contains(fixed.LOST_IMAGE_START) & (F.col("locale") != "en") & F.col(sibling).isNotNull()
    held = F.coalesce(lost, F.lit(False))
    some = docs.filter(held)
    english = bodies.select(F.col("page_id").alias("__en"), F.col("body").alias("__en_body")).filter(F.col("__en_body").contains("](assets/"))
    joined = some.join(english, some[sibling] == english["__en"], "left")
    fixed_up = F.when(F.col("__en_body").isNotNull(), with_repaired_images(F.col(body), F.col("__en_body"))).otherwise(F.col(body))
    return docs.filter(~held).unionByName(joined.withColumn(body, fixed_up).select(*docs.columns))
