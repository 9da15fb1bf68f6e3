"""Scans, sinks, projections and filters as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed
from ..operators import extraction as X
from ..operators import quality as Q
from ..operators import schemas as SC
from ..session import shared_dir
from ..sources import scans, sinks
from ..sources import tables as T
from . import ctes

QUERIES = {}
CHECKS = {}


def query(name: str, check: str):
    def add(fn):
        QUERIES[name] = fn
        CHECKS[name] = check
        return fn

    return add


def with_corpus(body: str) -> str:
    return f"WITH {ctes.CORPUS}\n{body}"


META = ctes.CORPUS + """,
meta AS (
  SELECT *, concat('sha256:', sha256(body)) AS content_hash,
    concat('2024-02-', lpad(CAST(1 + doc_id % 28 AS VARCHAR), 2, '0'), 'T00:00:00.000Z') AS edited_at,
    CASE WHEN doc_id % 9 <> 4 THEN concat('2024-01-', lpad(CAST(1 + doc_id % 28 AS VARCHAR), 2, '0')) END AS published_date,
    CASE WHEN doc_id % 10 = 0 THEN '🌱' END AS icon,
    CASE WHEN section IS NULL THEN ['docs'] ELSE string_split(section, ' ') END AS keywords,
    CASE WHEN doc_id % 2 = 0 THEN [locale, status] ELSE [] END AS tags FROM corpus)"""


def meta(spark, folder):
    m = F.col("doc_id") % 28 + 1
    day = F.lpad(m.cast("string"), 2, "0")
    c = T.corpus(spark, folder)
    return c.withColumns(
        {
            "content_hash": C.content_hash("body"),
            "edited_at": F.concat(F.lit("2024-02-"), day, F.lit("T00:00:00.000Z")),
            "published_date": F.when(F.col("doc_id") % 9 != 4, F.concat(F.lit("2024-01-"), day)),
            "icon": C.emoji_icon(F.when(F.col("doc_id") % 10 == 0, "emoji").otherwise("external"), F.lit("🌱")),
            "keywords": C.names_or_default(F.coalesce(F.split("section", " "), F.array()), fixed.DEFAULT_KEYWORDS),
            "tags": F.when(F.col("doc_id") % 2 == 0, F.array("locale", "status")).otherwise(
                F.expr("CAST(array() AS array<string>)")
            ),
        }
    )


def with_meta(body: str) -> str:
    return f"WITH {META}\n{body}"


# --- scans -------------------------------------------------------------------------


@query(
    "metadata_scan",
    """WITH blobs AS (
  SELECT event_id, CASE WHEN event_id % 97 = 0 THEN left(props, 3) WHEN event_id % 89 = 0 THEN NULL
    WHEN event_id % 83 = 0 THEN '{"k": "x"}' WHEN event_id % 79 = 0 THEN '{"other": 1}' ELSE props END AS raw FROM events)
SELECT event_id, CASE WHEN raw IS NULL THEN 'read_error' WHEN NOT json_valid(raw) THEN 'skipped'
    WHEN json_type(raw, '$.k') IS DISTINCT FROM 'UBIGINT' THEN 'skipped' ELSE 'page' END AS outcome,
  CASE WHEN json_valid(raw) THEN TRY_CAST(json_extract_string(raw, '$.k') AS BIGINT) END AS k FROM blobs""",
)
def metadata_scan(spark, folder):
    blobs = T.table(spark, folder, "events").select(
        "event_id",
        F.expr(
            "CASE WHEN event_id % 97 = 0 THEN left(props, 3) WHEN event_id % 89 = 0 THEN NULL "
            "WHEN event_id % 83 = 0 THEN '{\"k\": \"x\"}' WHEN event_id % 79 = 0 THEN '{\"other\": 1}' ELSE props END"
        ).alias("raw"),
    )
    found = scans.scan_metadata(blobs, "k bigint", ("k",))
    return found.select("event_id", "outcome", F.col("meta.k").alias("k"))


@query(
    "manifest_header",
    with_corpus(
        """, b AS (SELECT *, CASE WHEN doc_id % 97 = 0 THEN 'skipped' WHEN doc_id % 89 = 0 THEN 'read_errors' WHEN doc_id % 83 = 0 THEN 'skipped' ELSE 'docs' END AS measure FROM corpus)
SELECT measure, CASE WHEN measure = 'docs' THEN locale END AS locale, CASE WHEN measure = 'docs' THEN status END AS status, count(*) AS n FROM b GROUP BY 1, 2, 3
UNION ALL SELECT 'docs_total', NULL, NULL, count(*) FROM b WHERE measure = 'docs'"""
    ),
)
def manifest_header(spark, folder):
    d = F.col("doc_id")
    title = F.when(d % 83 != 0, F.col("title"))
    raw = F.to_json(F.struct("page_id", title.alias("title"), "locale", "status"))
    blob = F.when(d % 97 == 0, F.left(raw, F.lit(9))).when(d % 89 != 0, raw)
    blobs = T.corpus(spark, folder).select(blob.alias("raw"))
    schema = "page_id string, title string, locale string, status string"
    return Q.manifest_header(scans.scan_metadata(blobs, schema, ("page_id", "title", "locale", "status")))


@query(
    "doc_scan",
    with_meta(
        """SELECT page_id, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE slug END AS fm_slug,
  CASE WHEN doc_id % 7 = 0 THEN NULL ELSE status END AS fm_status,
  CASE WHEN doc_id % 7 = 0 THEN 0 ELSE 3 END AS n_keys, concat('sha256:', sha256(body)) AS body_hash FROM meta"""
    ),
)
def doc_scan(spark, folder):
    c = T.corpus(spark, folder)
    head = F.concat(
        F.lit("---\nslug: old\n# note: none\nslug: \""), "slug", F.lit("\"\nstatus: '"), "status",
        F.lit("'\nlocale: "), "locale", F.lit("\n---\n"), "body",
    )
    docs = c.select("page_id", F.when(F.col("doc_id") % 7 == 0, F.col("body")).otherwise(head).alias("content"))
    out = scans.split_document(docs)
    return out.select(
        "page_id",
        F.try_element_at("frontmatter", F.lit("slug")).alias("fm_slug"),
        F.try_element_at("frontmatter", F.lit("status")).alias("fm_status"),
        F.size("frontmatter").alias("n_keys"),
        C.content_hash("body").alias("body_hash"),
    )


@query("raw_snapshot_scan", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def raw_snapshot_scan(spark, folder):
    snaps = scans.scan_snapshots(T.table(spark, folder, "events"), "event_id", "props")
    return snaps.select("event_id", F.variant_get("snapshot", "$.k", "bigint").alias("k"))


INVENTORY = """inventory AS (
  SELECT page_id, concat('pages/', page_id, '/metadata.json') AS key, 'metadata' AS artifact_type, content_hash, strlen(title) AS size_bytes FROM meta
  UNION ALL SELECT page_id, concat('docs/', locale, '/docs/', coalesce(section || '/', ''), slug, '.md'), 'doc', content_hash, strlen(body) FROM meta
  UNION ALL SELECT page_id, concat('pages/', page_id, '/raw-page.json'), 'raw_page', NULL, strlen(title) FROM meta
  UNION ALL SELECT page_id, concat('pages/', page_id, '/raw-blocks.json'), 'raw_blocks', NULL, strlen(body) FROM meta)"""


@query("artifact_inventory", with_meta(f", {INVENTORY} SELECT * FROM inventory"))
def artifact_inventory(spark, folder):
    return scans.artifact_inventory(meta(spark, folder))


@query(
    "prefix_listing",
    with_meta(f", {INVENTORY} SELECT key, size_bytes FROM inventory WHERE starts_with(key, 'pages/') AND ends_with(key, '/metadata.json')"),
)
def prefix_listing(spark, folder):
    return scans.filter_prefix(artifact_inventory(spark, folder), "pages/", "/metadata.json").select("key", "size_bytes")


@query(
    "orphan_outputs",
    with_meta(f", {INVENTORY} SELECT key FROM inventory WHERE artifact_type = 'doc' EXCEPT "
              "SELECT concat('docs/', locale, '/docs/', coalesce(section || '/', ''), slug, '.md') FROM meta WHERE status = 'active'"),
)
def orphan_outputs(spark, folder):
    from ..operators.state import orphans

    m = meta(spark, folder)
    present = scans.artifact_inventory(m).filter("artifact_type = 'doc'").select("key")
    kept = m.filter(C.publishable("status")).select(C.document_key("locale", "section", "slug").alias("key"))
    return orphans(present, kept)


# --- sinks ---------------------------------------------------------------------------


@query(
    "doc_sink",
    with_corpus(f"SELECT page_id, locale, coalesce(nullif({ctes.folder('section')}, ''), '_root') AS section_dir, slug FROM corpus"),
)
def doc_sink(spark, folder):
    import uuid

    path = f"{shared_dir(spark)}/docs-{uuid.uuid4().hex}"
    docs = T.corpus(spark, folder).select("page_id", "locale", "section", "slug", "title", "body")
    sinks.write_documents(docs, path)
    return spark.read.parquet(path).select("page_id", "locale", "section_dir", "slug")


@query("manifest_snapshot", with_corpus("SELECT page_id, title, slug, status FROM corpus"))
def manifest_snapshot(spark, folder):
    """Publishes the catalog, then tries an empty one under the same name and one with read
    errors, which the store refuses; reading back gives what was published."""
    import uuid

    store = sinks.SnapshotStore(spark, f"{shared_dir(spark)}/manifest-{uuid.uuid4().hex}")
    docs = T.corpus(spark, folder).select("page_id", "title", "slug", "status")
    store.publish(docs, "2024-01-01T00-00-00Z")
    store.publish(docs.filter("page_id IS NULL"), "2024-01-01T00-00-00Z")
    store.publish(docs, "2024-01-02T00-00-00Z", read_errors=1)
    return store.read(docs.schema)


@query(
    "manifest_read",
    with_corpus("SELECT page_id, slug, status FROM corpus WHERE status = 'active'"),
)
def manifest_read(spark, folder):
    """Publishes the whole catalog, then its live pages as a newer version, and reads by pointer."""
    import uuid

    store = sinks.SnapshotStore(spark, f"{shared_dir(spark)}/manifest-{uuid.uuid4().hex}")
    docs = T.corpus(spark, folder).select("page_id", "slug", "status")
    store.publish(docs, "2024-01-01T00-00-00Z")
    store.publish(docs.filter("status = 'active'"), "2024-01-02T00-00-00Z")
    return store.read(docs.schema)


@query(
    "asset_pool",
    """WITH a AS (
  SELECT sha256(text) AS sha256, strlen(text) AS size_bytes, CASE doc_id % 2 WHEN 0 THEN '.jpg' ELSE '.png' END AS ext FROM documents)
SELECT concat('assets/', sha256, ext) AS key, sha256, max(size_bytes) AS size_bytes, count(*) AS refs FROM a GROUP BY sha256, ext""",
)
def asset_pool(spark, folder):
    assets = T.table(spark, folder, "documents").select(
        F.col("text").cast("binary").alias("content"),
        F.when(F.col("doc_id") % 2 == 0, "image/jpeg").otherwise("application/unknown").alias("mime_type"),
    )
    return sinks.asset_pool(assets)


# --- projections -----------------------------------------------------------------------


@query(
    "property_extract",
    """SELECT event_id, CASE event_id % 6 WHEN 0 THEN concat('s', k) WHEN 1 THEN concat('t', k) WHEN 2 THEN concat('r', k, 'x')
  WHEN 3 THEN concat('f', k) WHEN 4 THEN k END AS value FROM (SELECT event_id, json_extract_string(props, '$.k') AS k FROM events)""",
)
def property_extract(spark, folder):
    k = F.get_json_object("props", "$.k")
    shape = F.element_at(
        F.array(
            F.concat(F.lit('{"select":{"name":"s'), k, F.lit('"},"status":{"name":"no"}}')),
            F.concat(F.lit('{"status":{"name":"t'), k, F.lit('"}}')),
            F.concat(F.lit('{"rich_text":[{"plain_text":"r'), k, F.lit('"},{"plain_text":"x"},{"type":"text"}]}')),
            F.concat(F.lit('{"formula":{"string":"f'), k, F.lit('"}}')),
            F.concat(F.lit('{"number":'), k, F.lit("}")),
            F.lit('{"select":null}'),
        ),
        (F.col("event_id") % 6 + 1).cast("int"),
    )
    e = T.table(spark, folder, "events").select("event_id", F.parse_json(shape).alias("prop"))
    return e.select("event_id", C.property_text("prop").alias("value"))


@query(
    "title_extract",
    with_corpus("SELECT page_id, CASE WHEN doc_id % 5 = 4 THEN page_id WHEN doc_id % 5 = 2 THEN concat(title, '!') ELSE title END AS title FROM corpus"),
)
def title_extract(spark, folder):
    c = T.corpus(spark, folder)
    run = lambda x: F.struct(x.alias("plain_text"))
    halves = F.array(run(F.left("title", F.lit(5))), run(F.lit(None).cast("string")), run(F.substr("title", F.lit(6))))
    marked = F.concat(halves, F.array(run(F.lit("!"))))
    m = F.col("doc_id") % 5
    none = F.expr("CAST(array() AS array<struct<plain_text: string>>)")
    titles = (
        F.when(m == 0, F.create_map(F.lit("Content elements"), halves, F.lit("Title"), marked))
        .when(m == 1, F.create_map(F.lit("title"), halves, F.lit("Title"), marked))
        .when(m == 2, F.create_map(F.lit("Title"), halves, F.lit("Name"), marked))
        .when(m == 3, F.create_map(F.lit("Name"), halves))
        .otherwise(F.create_map(F.lit("Name"), none))
    )
    return c.select("page_id", C.title_text(titles, "page_id").alias("title"))


@query(
    "list_extract",
    with_corpus(
        "SELECT page_id, CASE WHEN section IS NULL THEN 'docs' ELSE array_to_string(list_filter(string_split(section, ' '), lambda x: x <> ''), '|') END AS keywords, "
        "len(sub_offsets) AS n_related FROM corpus"
    ),
)
def list_extract(spark, folder):
    c = T.corpus(spark, folder)
    names = F.coalesce(F.concat(F.split("section", " "), F.array(F.lit(""))), F.array())
    return c.select(
        "page_id",
        F.array_join(C.names_or_default(names, fixed.DEFAULT_KEYWORDS), "|").alias("keywords"),
        F.size(F.filter(F.concat("sub_items", F.array(F.lit(""))), lambda x: x != "")).cast("bigint").alias("n_related"),
    )


@query(
    "date_icon_extract",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS published_date, strftime(o_orderdate, '%-m/%-d/%Y') AS display_date, "
    "CASE WHEN o_orderkey % 3 = 0 THEN '📘' END AS icon FROM orders",
)
def date_icon_extract(spark, folder):
    o = T.table(spark, folder, "orders")
    raw = F.concat(F.lit('{"date":{"start":"'), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit('"}}'))
    o = o.select("o_orderkey", F.parse_json(raw).alias("prop"))
    start = F.try_variant_get("prop", "$.date.start", "string")
    kind = F.when(F.col("o_orderkey") % 3 == 0, "emoji").otherwise("external")
    return o.select(
        "o_orderkey",
        start.alias("published_date"),
        C.display_date(start).alias("display_date"),
        C.emoji_icon(kind, F.lit("📘")).alias("icon"),
    )


LANG_LABEL = (
    "CASE doc_id % 7 WHEN 0 THEN upper(lang) WHEN 1 THEN 'ES - automated' WHEN 2 THEN '' WHEN 3 THEN NULL "
    "WHEN 4 THEN 'Portuguese' WHEN 5 THEN 'pt-BR' ELSE lang END"
)


@query(
    "locale_normalize",
    f"""SELECT doc_id, CASE WHEN coalesce(x, '') = '' THEN 'en' WHEN lower(x) = 'es - automated' THEN 'es'
  WHEN lower(x) IN ('portuguese', 'pt-br') THEN 'pt' ELSE lower(x) END AS locale FROM (SELECT doc_id, {LANG_LABEL} AS x FROM documents)""",
)
def locale_normalize(spark, folder):
    d = T.table(spark, folder, "documents").select("doc_id", F.expr(LANG_LABEL).alias("label"))
    return d.select("doc_id", C.normalize_locale("label").alias("locale"))


@query(
    "language_source",
    with_corpus(
        "SELECT page_id, CASE WHEN doc_id % 4 = 0 THEN language_source WHEN doc_id % 4 = 1 THEN 'explicit' "
        "WHEN doc_id % 8 = 2 THEN 'automated' WHEN doc_id % 8 = 6 THEN 'explicit' ELSE 'fallback' END AS provenance FROM corpus"
    ),
)
def language_source(spark, folder):
    m = F.col("doc_id") % 4
    label = F.when(F.col("doc_id") % 8 == 2, "PT - Automated").when(F.col("doc_id") % 8 == 6, "Portuguese")
    return T.corpus(spark, folder).select(
        "page_id",
        C.language_source(
            F.when(m == 0, F.col("language_source")), F.when(m == 1, F.lit("explicit")), label
        ).alias("provenance"),
    )


STATUS_LABEL = (
    "CASE doc_id % 9 WHEN 0 THEN 'X ' || publish_status || ' (old)' WHEN 1 THEN 'X - Depreciated' WHEN 2 THEN 'Page deleted' "
    "WHEN 3 THEN 'Editing' WHEN 4 THEN '  REMOVE ' WHEN 5 THEN 'pre-publish' ELSE publish_status END"
)


@query("status_classify", with_corpus(f"SELECT page_id, label, {ctes.status('label')} AS status FROM (SELECT page_id, {STATUS_LABEL} AS label FROM corpus)"))
def status_classify(spark, folder):
    c = T.corpus(spark, folder).select("page_id", F.expr(STATUS_LABEL).alias("label"))
    return c.select("page_id", "label", C.status_of("label").alias("status"))


@query(
    "element_type_unwrap",
    with_corpus("SELECT page_id, CASE WHEN doc_id % 4 = 3 THEN '' ELSE element_type END AS element_type FROM corpus"),
)
def element_type_unwrap(spark, folder):
    name = F.concat(F.lit('"'), "element_type", F.lit('"'))
    shape = F.element_at(
        F.array(
            name,
            F.concat(F.lit('{"select":{"name":'), name, F.lit("}}")),
            F.concat(F.lit('{"name":'), name, F.lit("}")),
            F.lit('{"select":null}'),
        ),
        (F.col("doc_id") % 4 + 1).cast("int"),
    )
    c = T.corpus(spark, folder).select("page_id", F.parse_json(shape).alias("raw"))
    return c.select("page_id", C.element_type_text("raw").alias("element_type"))


SECTION = "coalesce(section, 'Uncategorized')"


@query(
    "section_columns",
    with_corpus(
        f"SELECT page_id, {ctes.label(SECTION)} AS label, {ctes.folder(SECTION)} AS section_dir, "
        "CASE WHEN section IS NULL THEN 9999 ELSE CAST(regexp_extract(section, '^(\\d+)', 1) AS INT) END AS rank FROM corpus"
    ),
)
def section_columns(spark, folder):
    s = F.coalesce("section", F.lit(fixed.UNCATEGORIZED))
    return T.corpus(spark, folder).select(
        "page_id", C.section_label(s).alias("label"), C.section_dir(s).alias("section_dir"), C.section_rank(s).alias("rank")
    )


@query("slugify", with_corpus("SELECT page_id, slug FROM corpus"))
def slugify(spark, folder):
    return T.corpus(spark, folder).select("page_id", C.slugify("title").alias("slug"))


@query(
    "artifact_keys",
    with_corpus(
        "SELECT page_id, concat(coalesce(section || '/', ''), slug) AS document_id, "
        "concat('docs/', locale, '/docs/', coalesce(section || '/', ''), slug, '.md') AS doc_key, "
        "concat('pages/', page_id, '/metadata.json') AS metadata_key, concat('https://notion.so/', replace(page_id, '-', '')) AS source_url, "
        "concat('https://www.notion.so/', replace(page_id, '-', '')) AS edit_url FROM corpus"
    ),
)
def artifact_keys(spark, folder):
    return T.corpus(spark, folder).select(
        "page_id",
        C.document_id("section", "slug").alias("document_id"),
        C.document_key("locale", "section", "slug").alias("doc_key"),
        C.page_key("page_id", "metadata.json").alias("metadata_key"),
        F.concat(F.lit(fixed.SOURCE_URL), C.undashed("page_id")).alias("source_url"),
        F.concat(F.lit(fixed.EDIT_URL), C.undashed("page_id")).alias("edit_url"),
    )


@query("content_hash", "SELECT doc_id, concat('sha256:', sha256(text)) AS content_hash FROM documents")
def content_hash(spark, folder):
    return T.table(spark, folder, "documents").select("doc_id", C.content_hash("text").alias("content_hash"))


@query(
    "canonical_json_hash",
    """SELECT event_id, concat('sha256:', sha256(concat('{"edit":{"kind":"', event_type, '","user":', CAST(user_id AS VARCHAR), '},"k":',
  json_extract_string(props, '$.k'), '}'))) AS json_hash FROM events""",
)
def canonical_json_hash(spark, folder):
    e = T.table(spark, folder, "events")
    fields = {"k": F.get_json_object("props", "$.k").cast("bigint"), "edit": {"user": "user_id", "kind": "event_type"}}
    return e.select("event_id", C.canonical_json_hash(fields).alias("json_hash"))


@query(
    "stable_fingerprint",
    with_meta(
        """SELECT page_id, concat('sha256:', sha256(concat('{"assets":[{"r2_key":"assets/', page_id, '.png","sha256":"', page_id,
  '"}],"content_hash":"', content_hash, '","locale":"', locale, '","section_order":', coalesce(CAST(section_order AS VARCHAR), 'null'),
  ',"slug":"', slug, '","status":"', status, '"}'))) AS fingerprint FROM meta"""
    ),
)
def stable_fingerprint(spark, folder):
    asset = F.struct(
        F.concat(F.lit("https://files.example/"), "page_id", F.lit("?sig="), F.rand(1).cast("string")).alias("original_url"),
        F.concat(F.lit("assets/"), "page_id", F.lit(".png")).alias("r2_key"),
        F.col("page_id").alias("sha256"),
    )
    m = meta(spark, folder).withColumn("assets", F.array(asset))
    fields = ["content_hash", "locale", "section_order", "slug", "status", "assets"]
    return m.select("page_id", X.stable_fingerprint(m, fields).alias("fingerprint"))


def _yaml(x: str) -> str:
    return (
        f"CASE WHEN regexp_matches({x}, '[&:\\[\\]{{}}|>*!%@`#\"''-]|^\\s') THEN concat('\"', replace({x}, '\"', '\\\"'), '\"') ELSE {x} END"
    )


FRONTMATTER = f"""header0 AS (
  SELECT page_id, section_order, slug, unnest([
    {{'key': 'id', 'line': concat('id: ', {_yaml('slug')})}},
    {{'key': 'title', 'line': concat('title: ', {_yaml('title')})}},
    {{'key': 'slug', 'line': concat('slug: ', {_yaml("concat('/', slug)")})}},
    {{'key': 'sidebar_label', 'line': concat('sidebar_label: ', {_yaml('title')})}},
    {{'key': 'sidebar_position', 'line': 'sidebar_position: ' || CAST(section_order AS VARCHAR)}},
    {{'key': 'pagination_label', 'line': concat('pagination_label: ', {_yaml('title')})}},
    {{'key': 'custom_edit_url', 'line': concat('custom_edit_url: "https://www.notion.so/', page_id, '"')}},
    {{'key': 'source', 'line': 'source: notion'}},
    {{'key': 'notion_page_id', 'line': concat('notion_page_id: ', page_id)}},
    {{'key': 'notion_last_edited_time', 'line': concat('notion_last_edited_time: "', edited_at, '"')}},
    {{'key': 'content_hash', 'line': concat('content_hash: "', content_hash, '"')}},
    {{'key': 'status', 'line': concat('status: ', status)}},
    {{'key': 'locale', 'line': concat('locale: ', locale)}},
    {{'key': 'section', 'line': 'section: "' || section || '"'}},
    {{'key': 'keywords', 'line': concat('keywords: [', array_to_string(list_transform(keywords, lambda v: {_yaml('v')}), ', '), ']')}},
    {{'key': 'tags', 'line': CASE WHEN len(tags) > 0 THEN concat('tags: [', array_to_string(tags, ', '), ']') END}},
    {{'key': 'last_update', 'line': concat('last_update:', chr(10), '  date: ', CASE WHEN doc_id % 9 = 4 THEN '2/' ELSE '1/' END, CAST(1 + doc_id % 28 AS VARCHAR), '/2024', chr(10), '  author: editors')}},
    {{'key': 'sidebar_custom_props', 'line': 'sidebar_custom_props:' || chr(10) || '  icon: ' || icon}}]) AS r,
    unnest(range(0, 18)) AS pos, icon FROM meta),
headers AS (
  SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS INT) AS ord, r.key AS key, r.line AS line, section_order, slug, icon
  FROM header0 WHERE r.line IS NOT NULL)"""


@query("frontmatter_rows", with_meta(f", {FRONTMATTER} SELECT page_id, ord, key, line FROM headers"))
def frontmatter_rows(spark, folder):
    return X.frontmatter_rows(meta(spark, folder))


@query(
    "header_overrides",
    f"WITH {ctes.PLAN}{META[len(ctes.CORPUS):]}, {FRONTMATTER}"
    """, o AS (SELECT page_id, canonical_slug, canonical_order, heading FROM routes)
SELECT h.page_id, h.ord, h.key, CASE
    WHEN h.key = 'id' AND o.canonical_slug <> h.slug THEN concat('id: "', o.canonical_slug, '"')
    WHEN h.key = 'slug' AND o.canonical_slug <> h.slug THEN concat('slug: /', o.canonical_slug)
    WHEN h.key = 'sidebar_position' THEN concat(
      CASE WHEN o.canonical_order <> coalesce(h.section_order, 9999) THEN concat('sidebar_position: ', CAST(o.canonical_order AS VARCHAR)) ELSE h.line END,
      CASE WHEN coalesce(o.heading, '') <> '' AND h.icon IS NULL
        THEN concat(chr(10), 'sidebar_custom_props:', chr(10), '  title: "', replace(o.heading, '"', '\\"'), '"') ELSE '' END)
    WHEN h.key = 'sidebar_custom_props' AND coalesce(o.heading, '') <> ''
      THEN concat('sidebar_custom_props:', chr(10), '  title: "', replace(o.heading, '"', '\\"'), '"')
    ELSE h.line END AS line
FROM headers h LEFT JOIN o USING (page_id)""",
)
def header_overrides(spark, folder):
    from .shared import plan

    m = meta(spark, folder)
    stored = m.select(
        "page_id", F.col("slug").alias("stored_slug"), F.col("section_order").alias("stored_order"),
        F.col("icon").isNotNull().alias("has_props"),
    )
    routes = plan(spark, folder).routes.select("page_id", "canonical_slug", "canonical_order", "heading")
    return X.header_overrides(X.frontmatter_rows(m), stored.join(routes, "page_id", "left"))


@query(
    "url_signature_strip",
    "SELECT page_id, CASE WHEN page_id % 5 = 0 THEN concat('not a url ', page_id) ELSE split_part(split_part(url, '#', 1), '?', 1) END AS stripped FROM pages",
)
def url_signature_strip(spark, folder):
    p = T.asset_refs(spark, folder)
    url = F.when(F.col("page_id") % 5 == 0, F.concat(F.lit("not a url "), F.col("page_id").cast("string"), F.lit("?a=1")))
    return p.select("page_id", C.unsigned_url(url.otherwise(F.col("url"))).alias("stripped"))


@query(
    "fallback_slug",
    with_corpus("SELECT page_id, CASE WHEN doc_id % 6 = 0 THEN left(page_id, 8) WHEN doc_id % 3 = 0 THEN slug ELSE concat('own-', page_id) END AS slug FROM corpus"),
)
def fallback_slug(spark, folder):
    stored = F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.concat(F.lit("own-"), "page_id"))
    title = F.when(F.col("doc_id") % 6 == 0, "!!!").otherwise(F.col("title"))
    return T.corpus(spark, folder).select(
        "page_id",
        F.coalesce(C.non_empty(stored), C.non_empty(C.slugify(title)), F.left("page_id", F.lit(8))).alias("slug"),
    )


@query(
    "manifest_docs",
    with_meta(
        """SELECT page_id, title, locale, section, section_order, element_type, publish_status AS drafting_status, slug,
  concat(coalesce(section || '/', ''), slug) AS docusaurus_id, concat('/', slug) AS docusaurus_path,
  concat('docs/', locale, '/docs/', coalesce(section || '/', ''), slug, '.md') AS r2_doc_key,
  concat('pages/', page_id, '/metadata.json') AS r2_metadata_key, concat('https://notion.so/', page_id) AS source_url,
  edited_at, content_hash, status, array_to_string(list_transform(sub_offsets, lambda i: CAST(doc_id + i AS VARCHAR)), '|') AS sub_items,
  language_source FROM meta"""
    ),
)
def manifest_docs(spark, folder):
    docs = X.manifest_docs(meta(spark, folder))
    return docs.withColumn("sub_items", F.array_join("sub_items", "|"))


# --- filters ---------------------------------------------------------------------------------


@query(
    "dead_status_filter",
    with_corpus("SELECT page_id, publish_status FROM corpus WHERE publish_status IS NULL OR publish_status NOT IN ('Remove', 'Unplublished')"),
)
def dead_status_filter(spark, folder):
    return T.corpus(spark, folder).filter(C.keeps_label("publish_status")).select("page_id", "publish_status")


@query(
    "publish_gate",
    with_corpus("SELECT page_id, status, status = 'active' AS published, status IN ('active', 'draft') AS with_drafts FROM corpus"),
)
def publish_gate(spark, folder):
    return T.corpus(spark, folder).select(
        "page_id", "status", C.publishable("status").alias("published"), C.publishable("status", True).alias("with_drafts")
    )


@query(
    "content_vs_structural",
    with_corpus(
        "SELECT page_id, CASE WHEN doc_id % 13 = 0 THEN true ELSE element_type = 'Page' END AS content, "
        "CASE WHEN doc_id % 13 = 0 THEN false ELSE element_type <> 'Page' END AS structural FROM corpus"
    ),
)
def content_vs_structural(spark, folder):
    et = F.when(F.col("doc_id") % 13 != 0, F.col("element_type"))
    return T.corpus(spark, folder).select(
        "page_id", C.is_content(et).alias("content"), C.is_structural(et).alias("structural")
    )


ODD_TITLE = (
    "CASE doc_id % 29 WHEN 0 THEN concat(title, ' (Internal draft)') WHEN 1 THEN ' New Element ' WHEN 2 THEN concat('[Add content here] ', title) "
    "WHEN 3 THEN CAST(doc_id AS {string}) WHEN 4 THEN concat('(Test) ', title) WHEN 5 THEN concat('Testing', title) ELSE title END"
)


@query(
    "internal_title_filter",
    with_corpus(
        f"""
, t AS (SELECT doc_id, page_id, sub_offsets, {ODD_TITLE.format(string='VARCHAR')} AS t FROM corpus),
i AS (SELECT * FROM t WHERE contains(t, '(Internal') OR trim(t) = 'New Element' OR contains(lower(t), '[add content here]') OR trim(t) = page_id),
ids AS (SELECT page_id FROM i UNION SELECT CAST(doc_id + unnest(sub_offsets) AS VARCHAR) FROM i)
SELECT page_id, regexp_matches(t, '^\\s*[\\[(]?\\s*(testing|test|teste|prueba)\\b', 'i') AS test_title FROM t WHERE page_id NOT IN (SELECT page_id FROM ids)"""
    ),
)
def internal_title_filter(spark, folder):
    from ..operators.hierarchy import HierarchyPlan

    odd = T.pages_meta(spark, folder).withColumn("doc_id", F.col("source_idx"))
    odd = odd.withColumn("title", F.expr(ODD_TITLE.format(string="STRING")))
    return HierarchyPlan(odd).visible.select("page_id", C.is_test_title("title").alias("test_title"))


STUB_BODY = (
    "CASE doc_id % 13 WHEN 0 THEN concat('---', chr(10), 'id: a', chr(10), '---', chr(10), chr(10)) "
    "WHEN 1 THEN concat('---', chr(10), '[ Insert content  here ]', chr(10)) WHEN 2 THEN concat('[ADD content here]', chr(10), body) "
    "WHEN 3 THEN concat('<div class=\"notion-spacer\" x></div>', chr(10), '---  ') WHEN 4 THEN '' ELSE body END"
)


@query("stub_body", with_corpus("SELECT page_id, doc_id % 13 IN (0, 1, 3, 4) AS stub FROM corpus"))
def stub_body(spark, folder):
    return T.corpus(spark, folder).select("page_id", C.is_stub(F.expr(STUB_BODY)).alias("stub"))


@query(
    "schema_validity",
    with_corpus(
        """, c AS (SELECT page_id, CASE WHEN doc_id % 31 <> 0 THEN title END AS title, CASE WHEN doc_id % 37 = 0 THEN 'live' ELSE status END AS status,
  CASE WHEN doc_id % 41 = 0 THEN 'guess' WHEN doc_id % 43 = 0 THEN NULL ELSE language_source END AS language_source, publish_status FROM corpus)
SELECT page_id, 'title required' AS rule FROM c WHERE title IS NULL
UNION ALL SELECT page_id, 'status known' FROM c WHERE status = 'live'
UNION ALL SELECT page_id, 'language_source known' FROM c WHERE language_source = 'guess'
UNION ALL SELECT page_id, 'publish status present' FROM c WHERE publish_status IS NULL"""
    ),
)
def schema_validity(spark, folder):
    d = F.col("doc_id")
    c = meta(spark, folder).withColumns(
        {
            "title": F.when(d % 31 != 0, F.col("title")),
            "status": F.when(d % 37 == 0, "live").otherwise(F.col("status")),
            "language_source": F.when(d % 41 == 0, "guess").when(d % 43 != 0, F.col("language_source")),
        }
    )
    return Q.metadata_rules(c)


# A chunk's record of every document, and a manifest of one document each, with faults by number.
CHUNK_FAULTS = (
    (7, '"status":"active"', '"status":"live"', "$.status", "is none of the known values"),
    (11, '"slug":', '"slug_":', "$.slug", "is missing"),
    (13, '"heading_path":["a"]', '"heading_path":["a",7,null]', "$.heading_path[1]", "is no text"),
    (13, '"heading_path":["a"]', '"heading_path":["a",7,null]', "$.heading_path[2]", "is no text"),
    (17, '"locale":', '"locale":5,"locale_":', "$.locale", "is no text"),
)
MANIFEST_FAULTS = (
    (7, '"schema_version":"1.0"', '"schema_version":"2.0"', "$.schema_version", "is none of the known values"),
    (11, '"section_order":1', '"section_order":"1"', "$.docs[0].section_order", "is no number"),
    (13, '"items":["b"]', '"items":["b",{"type":"category","label":"x"}]', "$.sidebars.en[1].items[1].items", "is missing"),
    (17, '"source":{', '"source":{"type":"other"},"source_":{', "$.source.type", "is none of the known values"),
    (17, '"source":{', '"source":{"type":"other"},"source_":{', "$.source.database_id", "is missing"),
    (17, '"source":{', '"source":{"type":"other"},"source_":{', "$.source.data_source_id", "is missing"),
    (19, '"rag":{', '"rag":null,"rag_":{', "$.rag", "is no record"),
)


def with_faults(spark, folder, json: str, known: tuple):
    """``page_id, json``: records of the documents; every nineteenth or so has one of the known faults, every 23rd is cut."""
    c = meta(spark, folder).join(T.table(spark, folder, "documents").select("doc_id", "text"), "doc_id")
    out = F.expr(json)
    for n, good, bad in dict.fromkeys(k[:3] for k in known):
        out = F.when(F.col("doc_id") % n == 0, F.replace(out, F.lit(good), F.lit(bad))).otherwise(out)
    return c.select("page_id", F.when(F.col("doc_id") % 23 == 0, F.left(out, F.lit(40))).otherwise(out).alias("json"))


def faults_sql(known: tuple) -> str:
    rows = [f"SELECT page_id, '{path}' AS path, '{problem}' AS problem FROM corpus WHERE doc_id % {n} = 0 AND doc_id % 23 <> 0" for n, _, _, path, problem in known]
    return with_corpus(" UNION ALL ".join([*rows, "SELECT page_id, '$', 'is no JSON' FROM corpus WHERE doc_id % 23 = 0"]))


@query("chunk_schema_validity", faults_sql(CHUNK_FAULTS))
def chunk_schema_validity(spark, folder):
    fields = "to_json(named_struct('chunk_id', page_id, 'page_id', page_id, 'title', title, 'locale', locale, 'slug', slug, 'heading_path', array('a'), 'text', text, 'source_url', 'u', 'docusaurus_path', 'p', 'content_hash', 'h', 'status', 'active'))"
    return SC.violations(with_faults(spark, folder, fields, CHUNK_FAULTS), SC.CHUNK, "page_id", "json")


@query("manifest_schema_validity", faults_sql(MANIFEST_FAULTS))
def manifest_schema_validity(spark, folder):
    doc = (
        "named_struct('page_id', page_id, 'title', title, 'locale', locale, 'section', coalesce(section, 's'), 'section_order', 1, 'element_type', element_type, 'drafting_status', 'd', 'slug', slug, "
        "'docusaurus_id', 'i', 'docusaurus_path', 'p', 'r2_doc_key', 'k', 'r2_metadata_key', 'm', 'source_url', 'u', 'notion_last_edited_time', 't', 'content_hash', 'h', 'status', status, "
        "'sub_items', array(page_id), 'language_source', language_source)"
    )
    fields = (
        f"to_json(named_struct('schema_version', '1.0', 'generated_at', 'now', 'source', named_struct('type', 'notion', 'database_id', 'd', 'data_source_id', 's'), 'docs', array({doc}), "
        "'sidebars', map('en', from_json('[]', 'array<string>')), 'rag', named_struct('chunks_manifest_key', 'k')))"
    )
    sidebars = '"sidebars":{"en":["a",{"type":"category","label":"l","collapsed":true,"items":["b"]}]}'
    whole = f"""replace({fields}, '"sidebars":{{"en":[]}}', '{sidebars}')"""
    return SC.violations(with_faults(spark, folder, whole, MANIFEST_FAULTS), SC.MANIFEST, "page_id", "json")


@query(
    "word_character_filter",
    f"WITH {ctes.MD_LINES} SELECT doc_id, line_no, line FROM md_lines WHERE regexp_matches(line, '[\\p{{L}}\\p{{N}}]')",
)
def word_character_filter(spark, folder):
    return T.md_lines(spark, folder).filter(C.has_word_character("line"))
