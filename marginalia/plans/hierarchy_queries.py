"""Families, replay, routes, navigation and their reports as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import hierarchy as H
from ..sources import tables as T
from . import ctes
from .shared import plan

QUERIES = {}
CHECKS = {}


def query(name: str, check: str):
    def add(fn):
        QUERIES[name] = fn
        CHECKS[name] = check
        return fn

    return add


def with_plan(body: str) -> str:
    return f"WITH {ctes.PLAN}\n{body}"


def with_corpus(body: str) -> str:
    return f"WITH {ctes.CORPUS}\n{body}"


@query("family_members", with_plan("SELECT family_id, page_id, locale, is_child FROM members"))
def family_members(spark, folder):
    return plan(spark, folder).members.select("family_id", "page_id", "locale", "is_child")


@query(
    "nested_family_skip",
    with_plan(
        "SELECT page_id, title, page_id IN (SELECT child_id FROM foreign_children) AS skipped "
        "FROM visible WHERE len(sub_offsets) > 0"
    ),
)
def nested_family_skip(spark, folder):
    p = plan(spark, folder)
    return p.parents.select("page_id", "title", F.col("foreign").alias("skipped"))


@query(
    "standalone_pages",
    with_plan(
        "SELECT page_id, 'structural' AS kind FROM alone_rows UNION ALL "
        "SELECT page_id, 'content' AS kind FROM alone_content"
    ),
)
def standalone_pages(spark, folder):
    p = plan(spark, folder)
    return p.standalone_structural.select("page_id", F.lit("structural").alias("kind")).unionByName(
        p.standalone_content.select("page_id", F.lit("content").alias("kind"))
    )


@query(
    "en_sibling",
    with_plan("SELECT page_id, locale, family_id, en_sibling_id, en_fallback_id FROM pages_plan WHERE family_id IS NOT NULL"),
)
def en_sibling(spark, folder):
    return plan(spark, folder).family_pages.select("page_id", "locale", "family_id", "en_sibling_id", "en_fallback_id")


@query("locale_winner", with_plan("SELECT family_id, locale, page_id, is_child FROM selected"))
def locale_winner(spark, folder):
    return plan(spark, folder).selected.select("family_id", "locale", "page_id", "is_child")


@query(
    "family_canonical",
    with_plan("SELECT family_id, canonical_slug, canonical_section, canonical_order, flow_order FROM families"),
)
def family_canonical(spark, folder):
    return plan(spark, folder).families.select(
        "family_id", "canonical_slug", "canonical_section", "canonical_order", "flow_order"
    )


@query(
    "event_replay",
    with_plan("SELECT canonical_section, locale, event, event_order, event_idx, toggle_dir, heading, open_toggle FROM replay"),
)
def event_replay(spark, folder):
    return plan(spark, folder).replay.select(
        "canonical_section", "locale", "event", "event_order", "event_idx", "toggle_dir", "heading", "open_toggle"
    )


@query("section_positions", with_plan("SELECT canonical_section, rank, position FROM section_positions"))
def section_positions(spark, folder):
    return plan(spark, folder).section_positions


@query(
    "label_lookup",
    with_plan(
        "SELECT locale, section_dir, '' AS toggle_dir, label, position FROM section_cats UNION ALL "
        "SELECT locale, section_dir, toggle_dir, label, position FROM toggle_cats"
    ),
)
def label_lookup(spark, folder):
    p = plan(spark, folder)
    cols = ["locale", "section_dir", "toggle_dir", "label", "position"]
    sections = p.section_categories.withColumn("toggle_dir", F.lit(""))
    return sections.select(*cols).unionByName(p.toggle_categories.select(*cols))


@query(
    "nonempty_toggles",
    with_plan("SELECT locale, section_dir, toggle_dir, label, position, heading FROM filled"),
)
def nonempty_toggles(spark, folder):
    return plan(spark, folder).filled_toggles.select("locale", "section_dir", "toggle_dir", "label", "position", "heading")


I18N_CHECK = with_plan(
    f"""
, cats AS (
  SELECT locale, section_dir, '' AS toggle_dir, label, section_dir AS key, 0 AS ord, 0 AS tie FROM section_cats UNION ALL
  SELECT locale, section_dir, toggle_dir, label, concat(section_dir, '/', toggle_dir), position, event_idx FROM filled),
slots AS (
  SELECT * FROM cats QUALIFY row_number() OVER (PARTITION BY locale, section_dir, toggle_dir ORDER BY ord DESC, tie DESC) = 1),
en_pages AS (
  SELECT DISTINCT concat({ctes.folder('canonical_section')}, '/', route_toggle) AS key FROM routes WHERE locale = 'en' AND route_toggle <> ''),
en AS (
  SELECT * FROM slots WHERE locale = 'en' AND NOT (section_dir = 'uncategorized' AND toggle_dir = '')
    AND (toggle_dir = '' OR key IN (SELECT key FROM en_pages))),
locs AS (SELECT DISTINCT locale FROM cats WHERE locale <> 'en'),
msgs AS (
  SELECT l.locale, concat('sidebar.docsSidebar.category.', en.key) AS message_key, coalesce(s.label, en.label) AS message
  FROM en CROSS JOIN locs l LEFT JOIN slots s ON s.locale = l.locale AND s.section_dir = en.section_dir AND s.toggle_dir = en.toggle_dir)
SELECT locale, message_key, message FROM msgs
UNION ALL SELECT locale, concat(message_key, '.link.generated-index.title'), message FROM msgs
UNION ALL SELECT locale, 'version.label', 'Latest' FROM locs""".lstrip()
)


@query("i18n_key_parity", I18N_CHECK)
def i18n_key_parity(spark, folder):
    return H.translation_messages(plan(spark, folder))


@query("missing_translations", with_plan(
    "SELECT family_id, concat_ws(', ', CASE WHEN NOT bool_or(locale = 'es') THEN 'ES' END, "
    "CASE WHEN NOT bool_or(locale = 'pt') THEN 'PT' END) AS missing FROM selected WHERE fam_content "
    "GROUP BY family_id HAVING NOT bool_or(locale = 'es') OR NOT bool_or(locale = 'pt')"))
def missing_translations(spark, folder):
    return plan(spark, folder).missing_translations


@query("missing_language", with_plan(
    "SELECT page_id, family_id, locale, title FROM selected WHERE fam_content AND language_source = 'fallback' AND locale <> 'en'"))
def missing_language(spark, folder):
    return plan(spark, folder).missing_language


DIAGNOSTICS_CHECK = with_plan(
    """, found AS (
  SELECT 'nested-family-skipped' AS category FROM visible WHERE len(sub_offsets) > 0 AND page_id IN (SELECT child_id FROM foreign_children)
  UNION ALL SELECT 'duplicate-public-route' FROM ranked WHERE route_rank > 1
  UNION ALL SELECT 'missing-translation-children' FROM selected WHERE fam_content GROUP BY family_id
    HAVING NOT bool_or(locale = 'es') OR NOT bool_or(locale = 'pt')
  UNION ALL SELECT 'missing-language' FROM selected WHERE fam_content AND language_source = 'fallback' AND locale <> 'en')
SELECT 'warn' AS severity, category, count(*) AS n FROM found GROUP BY category"""
)


@query("diagnostics_union", DIAGNOSTICS_CHECK)
def diagnostics_union(spark, folder):
    return plan(spark, folder).diagnostics.groupBy("severity", "category").agg(F.count(F.lit(1)).alias("n"))


@query(
    "route_dedupe",
    with_plan(
        "SELECT locale, route_section, route_toggle, canonical_slug, winner_id, page_id AS dropped_id FROM ranked WHERE route_rank > 1"
    ),
)
def route_dedupe(spark, folder):
    p = plan(spark, folder)
    return p.dropped_pages.select(*p.ROUTE, "winner_id", F.col("page_id").alias("dropped_id"))


ROUTES = (
    "locale, route_section, route_toggle, canonical_slug, page_id, canonical_section, canonical_order, heading, candidates"
)


@query("canonical_routes", with_plan(f"SELECT {ROUTES} FROM routes"))
def canonical_routes(spark, folder):
    return plan(spark, folder).routes.select(*ROUTES.split(", "))


@query("route_aliases", f"WITH {ctes.ALIASES}\nSELECT canonical_slug, alias_key, page_id FROM aliases")
def route_aliases(spark, folder):
    return plan(spark, folder).route_aliases


NAV_CHECK = with_plan(
    f""", t AS (
  SELECT locale, section_dir, toggle_dir, label, position FROM filled
  QUALIFY row_number() OVER (PARTITION BY locale, section_dir, toggle_dir ORDER BY position, event_idx) = 1),
edges AS (
  SELECT locale, '' AS parent_key, section_dir AS node_key, 'section' AS kind, label, 0 AS last, position AS ord, 0 AS rank, false AS alone, 0 AS tie
  FROM section_cats WHERE canonical_section <> 'Uncategorized'
  UNION ALL SELECT locale, CASE WHEN section_dir = 'uncategorized' THEN '' ELSE section_dir END, concat(section_dir, '/', toggle_dir),
    'toggle', label, CASE WHEN section_dir = 'uncategorized' THEN 1 ELSE 0 END, position, 1, false, -1 FROM t
  UNION ALL SELECT locale, CASE WHEN route_toggle <> '' THEN concat({ctes.folder('canonical_section')}, '/', route_toggle)
      WHEN canonical_section = 'Uncategorized' THEN '' ELSE {ctes.folder('canonical_section')} END,
    concat(CASE WHEN canonical_section = 'Uncategorized' THEN '' ELSE concat({ctes.folder('canonical_section')}, '/') END,
      CASE WHEN route_toggle = '' THEN '' ELSE concat(route_toggle, '/') END, canonical_slug),
    'page', title, CASE WHEN route_toggle = '' AND canonical_section = 'Uncategorized' THEN 1 ELSE 0 END, canonical_order, 2, family_id IS NULL, parent_idx FROM routes)
SELECT locale, parent_key, node_key, kind, label,
  row_number() OVER (PARTITION BY locale, parent_key ORDER BY last, ord, rank, alone, tie, node_key) AS position FROM edges"""
)


@query("nav_tree", NAV_CHECK)
def nav_tree(spark, folder):
    return plan(spark, folder).nav_edges


@query("stale_locales", with_plan(
    "SELECT DISTINCT lang AS locale FROM documents WHERE lang NOT IN (SELECT locale FROM section_locales)"))
def stale_locales(spark, folder):
    published_before = T.table(spark, folder, "documents").select(F.col("lang").alias("locale")).distinct()
    return H.stale_locales(published_before, plan(spark, folder).section_locales)


@query(
    "page_union",
    with_plan(
        "SELECT page_id, locale, 'family' AS origin FROM pages_plan WHERE family_id IS NOT NULL UNION ALL "
        "SELECT page_id, locale, 'standalone' FROM pages_plan WHERE family_id IS NULL UNION ALL "
        "SELECT page_id, locale, 'structural' FROM alone_rows"
    ),
)
def page_union(spark, folder):
    p = plan(spark, folder)
    cols = ["page_id", "locale"]
    out = p.family_pages.select(*cols, F.lit("family").alias("origin"))
    out = out.unionByName(p.standalone_pages.select(*cols, F.lit("standalone").alias("origin")))
    return out.unionByName(p.standalone_structural.select(*cols, F.lit("structural").alias("origin")))


@query(
    "route_map",
    f"WITH {ctes.ALIASES}\nSELECT 'slug' AS kind, key, canonical_slug FROM slug_map UNION ALL SELECT 'id', key, canonical_slug FROM id_map",
)
def route_map(spark, folder):
    from ..operators.links import id_routes, slug_routes

    p = plan(spark, folder)
    slugs = slug_routes(p.docs, p.published_slugs).withColumn("kind", F.lit("slug"))
    return slugs.unionByName(id_routes(p.published_slugs).withColumn("kind", F.lit("id"))).select("kind", "key", "canonical_slug")


@query(
    "section_order_min",
    with_corpus(
        "SELECT section, min(coalesce(section_order, 999)) OVER (PARTITION BY section) AS section_min, page_id, "
        "row_number() OVER (PARTITION BY section ORDER BY coalesce(section_order, 999), source_idx) AS position "
        "FROM corpus WHERE status = 'active' AND section <> ''"
    ),
)
def section_order_min(spark, folder):
    return H.section_order_min(T.pages_meta(spark, folder))


@query(
    "fallback_positions",
    with_corpus(
        "SELECT page_id, section, CAST(CASE WHEN section_order IS NOT NULL THEN section_order ELSE "
        "greatest(0, coalesce(max(section_order) OVER (PARTITION BY coalesce(section, '')), 0)) + "
        "sum(CASE WHEN section_order IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY coalesce(section, '') ORDER BY source_idx) END AS INT) "
        "AS section_order FROM corpus"
    ),
)
def fallback_positions(spark, folder):
    return H.fallback_positions(T.pages_meta(spark, folder))


@query(
    "unique_slug",
    with_corpus(
        "SELECT page_id, slug AS base, CASE WHEN row_number() OVER (PARTITION BY slug ORDER BY source_idx) = 1 THEN slug "
        "ELSE concat(slug, '-', left(page_id, 8)) END AS slug FROM corpus"
    ),
)
def unique_slug(spark, folder):
    return H.unique_slugs(T.pages_meta(spark, folder))


@query(
    "toc_order",
    with_corpus("SELECT page_id, title, coalesce(section_order, 9999) AS toc_order FROM corpus ORDER BY 3, source_idx, 1"),
)
def toc_order(spark, folder):
    return H.toc_order(T.pages_meta(spark, folder)).select("page_id", "title", "toc_order")


DUPLICATES = with_corpus(
    """SELECT 'duplicate-slug' AS violation, concat(locale, '/', slug) AS subject, count(*) AS n FROM corpus GROUP BY locale, slug HAVING count(*) > 1
UNION ALL SELECT 'missing-page-id', title, 1 FROM corpus WHERE coalesce(page_id, '') = ''
UNION ALL SELECT 'missing-content-hash', page_id, 1 FROM corpus WHERE doc_id % 19 = 0
UNION ALL SELECT 'unsupported-version', page_id, 1 FROM corpus WHERE doc_id % 23 = 0"""
)


@query("duplicate_slugs", DUPLICATES)
def duplicate_slugs(spark, folder):
    from ..operators.quality import catalog_violations

    c = T.corpus(spark, folder)
    c = c.withColumns(
        {
            "content_hash": F.when(F.col("doc_id") % 19 != 0, C.content_hash("body")),
            "schema_version": F.when(F.col("doc_id") % 23 == 0, "0.9").otherwise("1.0"),
        }
    )
    return catalog_violations(c)
