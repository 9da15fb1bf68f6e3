"""Links and assets as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed
from ..operators import assets as A
from ..operators import links as K
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


def with_aliases(body: str) -> str:
    return f"WITH {ctes.ALIASES}\n{body}"


def _maps(spark, folder):
    p = plan(spark, folder)
    # Page ids of these tables are short numbers; links name them by 32 digits.
    ids = K.id_routes(p.published_slugs).withColumn("key", F.lpad("key", 32, "0"))
    return K.slug_routes(p.docs, p.published_slugs), ids


BODY_LINES = """body_lines AS (
  SELECT doc_id, page_id, unnest(string_split(body, chr(10))) AS line, generate_subscripts(string_split(body, chr(10)), 1) - 1 AS i FROM corpus)"""


def whole_bodies(spark, folder, line: str):
    """All bodies with markup put around their lines: ``line`` is SQL over line, i and the columns of the corpus."""
    c = T.corpus(spark, folder).select("doc_id", "page_id", "locale", "body")
    return c.withColumn("body", F.array_join(F.expr(f"transform(split(body, '\\n'), (line, i) -> {line})"), "\n"))


@query(
    "link_resolution",
    with_aliases(
        f""", {BODY_LINES}, linked AS (
  SELECT b.*, r.target, coalesce(r.resolved, r.target) AS route FROM body_lines b LEFT JOIN resolved r USING (page_id))
SELECT page_id, sha256(string_agg(CASE WHEN target IS NULL THEN line WHEN i % 4 = 0 THEN concat('[', line, '](', route, ')') WHEN i % 4 = 1 THEN concat('![', line, '](', target, ')')
  WHEN i % 4 = 2 THEN concat(line, ' [out](https://x.org/a) [again](', route, ').') ELSE line END, chr(10) ORDER BY i)) AS body_hash FROM linked GROUP BY page_id"""
    ),
)
def link_resolution(spark, folder):
    links = T.xlinks(spark, folder).select("page_id", "target")
    line = (
        "CASE WHEN target IS NULL THEN line WHEN i % 4 = 0 THEN concat('[', line, '](', target, ')') WHEN i % 4 = 1 THEN concat('![', line, '](', target, ')') "
        "WHEN i % 4 = 2 THEN concat(line, ' [out](https://x.org/a) [again](', target, ').') ELSE line END"
    )
    c = T.corpus(spark, folder).select("page_id", "locale", "body").join(links, "page_id", "left")
    docs = c.withColumn("body", F.array_join(F.expr(f"transform(split(body, '\\n'), (line, i) -> {line})"), "\n"))
    return K.rewrite_links(docs, *_maps(spark, folder)).select("page_id", F.sha2("body", 256).alias("body_hash"))


@query(
    "broken_links",
    with_aliases("SELECT target, count(*) AS n FROM resolved WHERE starts_with(t, '/') AND resolved IS NULL GROUP BY target"),
)
def broken_links(spark, folder):
    return K.broken_links(K.resolve_links(T.xlinks(spark, folder), *_maps(spark, folder)))


# What would end or break the syntaxes of images, as it is written in a URL.
ENCODED = {" ": "%20", "(": "%28", ")": "%29", "''": "%27", "\\t": "%09", "\\n": "%0A", "\\r": "%0D"}


def encoded(href: str, spark: bool = False) -> str:
    for character, code in ENCODED.items():
        if not spark and character in ("\\t", "\\n", "\\r"):
            character, quote = f"chr({ {'t': 9, 'n': 10, 'r': 13}[character[-1]] })", ""
        else:
            quote = "'"
        href = f"replace({href}, {quote}{character}{quote}, '{code}')"
    return href


HREFS = """hrefs AS (
  SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href,
    generate_subscripts(regexp_extract_all(html, 'href="([^"]*)"', 1), 1) - 1 AS pos FROM pages)"""


@query(
    "distinct_assets",
    f"""WITH {HREFS}, u AS (
  SELECT page_id, concat('https://', CASE pos % 2 WHEN 0 THEN 'files.amazonaws.com' ELSE 'img.example' END, {encoded('href')}) AS url, pos % 3 AS syntax, pos FROM hrefs),
f AS (SELECT page_id, url, min(CASE syntax WHEN 2 THEN 1 ELSE 0 END * 1000000 + CASE syntax WHEN 0 THEN 0 WHEN 1 THEN 500000 ELSE 0 END + pos) AS k FROM u GROUP BY 1, 2)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY k) - 1 AS INT) AS ord, url, contains(url, '//files.amazonaws.com') AS managed FROM f""",
)
def distinct_assets(spark, folder):
    return A.distinct_assets(image_texts(spark, folder), "page_id", "text")


def image_texts(spark, folder):
    """Texts holding each page's link targets as images of the three syntaxes in turn."""
    p = T.table(spark, folder, "pages")
    hrefs = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)
    image = (
        "transform(hrefs, (h, i) -> CASE i % 3 WHEN 0 THEN concat('[![a](', host(i), url(h), ')](https://x.org)') "
        "WHEN 1 THEN concat('![b](', host(i), url(h), ')') ELSE concat('<img class=\"c\" src=\"', host(i), url(h), '\">') END)"
    ).replace("host(i)", "concat('https://', CASE i % 2 WHEN 0 THEN 'files.amazonaws.com' ELSE 'img.example' END)").replace("url(h)", encoded("h", spark=True))
    return p.select("page_id", hrefs.alias("hrefs")).select("page_id", F.array_join(F.expr(image), "\n").alias("text"))


ASSET_URL = (
    "CASE page_id % 6 WHEN 0 THEN concat('https://prod-files-secure.s3.us-west-2.amazonaws.com/', page_id, '.png?sig=1') "
    "WHEN 1 THEN concat('http://WWW.notion.so/', page_id) WHEN 2 THEN concat('https://evilnotion.so/', page_id) "
    "WHEN 3 THEN concat('data:image/gif;base64,', page_id) ELSE url END"
)
MIME = (
    "CASE page_id % 7 WHEN 0 THEN 'image/jpeg' WHEN 1 THEN 'image/gif' WHEN 2 THEN 'image/webp' WHEN 3 THEN 'image/svg+xml' "
    "WHEN 4 THEN 'text/html' WHEN 5 THEN NULL ELSE 'image/png' END"
)


@query(
    "asset_extract",
    f"""SELECT page_id, {ASSET_URL} AS asset_url, page_id % 6 IN (0, 1, 3) AS managed,
  CASE page_id % 7 WHEN 0 THEN '.jpg' WHEN 1 THEN '.gif' WHEN 2 THEN '.webp' WHEN 3 THEN '.svg' ELSE '.png' END AS extension FROM pages""",
)
def asset_extract(spark, folder):
    p = T.asset_refs(spark, folder).select("page_id", F.expr(ASSET_URL).alias("asset_url"), F.expr(MIME).alias("mime"))
    return p.select("page_id", "asset_url", C.is_managed_asset("asset_url").alias("managed"), C.extension_of("mime").alias("extension"))


@query(
    "asset_rewrite",
    f"""WITH {ctes.CORPUS}, {BODY_LINES},
u AS (SELECT *, doc_id % 40 AS slot, concat('https://files.amazonaws.com/', CAST(doc_id % 40 AS VARCHAR)) AS base FROM body_lines),
v AS (SELECT *, CASE WHEN slot % 3 = 0 THEN NULL ELSE concat('assets/', sha256(concat(base, '.png?sig=1')), '.png') END AS a,
    CASE WHEN slot % 5 = 0 THEN NULL ELSE concat('assets/', sha256(concat(base, '.png?sig=1&v=2')), '.png') END AS b, concat(chr(10), '<!-- failed-asset: ', base, '.png -->') AS note FROM u)
SELECT page_id, sha256(string_agg(CASE i % 5
  WHEN 0 THEN CASE WHEN a IS NOT NULL THEN concat('![', line, '](', a, ')') WHEN regexp_matches(line, '^\\s*$') THEN concat('**[Image unavailable]**', note) ELSE concat('**[Image unavailable: ', line, ']**', note) END
  WHEN 1 THEN concat(CASE WHEN b IS NOT NULL THEN concat('![ ](', b, ')') ELSE concat('**[Image unavailable]**', note) END, ' ', line)
  WHEN 2 THEN concat(CASE WHEN a IS NOT NULL THEN concat('<img alt="x" src="', a, '">') ELSE concat('**[Image unavailable]**', note) END, line)
  WHEN 3 THEN concat('![k](https://x.org/k.png) ', line) ELSE line END, chr(10) ORDER BY i)) AS text_hash FROM v GROUP BY page_id""",
)
def asset_rewrite(spark, folder):
    url = "concat('https://files.amazonaws.com/', CAST(doc_id % 40 AS STRING), '.png?sig=1')"
    docs = whole_bodies(
        spark, folder,
        f"CASE i % 5 WHEN 0 THEN concat('![', line, '](', {url}, ')') WHEN 1 THEN concat('![ ](', {url}, '&v=2) ', line) "
        f"WHEN 2 THEN concat('<img alt=\"x\" src=\"', {url}, '\">', line) WHEN 3 THEN concat('![k](https://x.org/k.png) ', line) ELSE line END",
    )
    slot = F.col("doc_id") % 40
    have = F.array(F.when(slot % 3 != 0, F.expr(url)), F.when(slot % 5 != 0, F.concat(F.expr(url), F.lit("&v=2"))))
    pool = T.table(spark, folder, "documents").select(F.explode(have).alias("url")).filter("url IS NOT NULL").distinct()
    pool = pool.withColumn("asset_key", F.concat(F.lit("assets/"), F.sha2("url", 256), F.lit(".png")))
    return A.rewrite_assets(docs, pool, "page_id", "body").select("page_id", F.sha2("body", 256).alias("text_hash"))


REFS = ctes.IMAGE_SLOTS + """,
refs AS (SELECT page_id, replace(name, 'assets/', '') AS name FROM image_slots WHERE kind = 'real'
  UNION SELECT page_id, concat('../', page_id, '.png') FROM image_slots WHERE kind = 'placeholder'),
pool AS (SELECT replace(name, 'assets/', '') AS name FROM image_slots WHERE ord < 2)"""


@query(
    "referenced_assets",
    f"""WITH {ctes.CORPUS}, {BODY_LINES},
refs AS (SELECT DISTINCT page_id, CASE i % 4 WHEN 2 THEN concat('../', page_id, '.png') ELSE concat(page_id, '-', CAST(i % 8 AS VARCHAR), '.png') END AS name FROM body_lines WHERE i % 4 < 3)
SELECT page_id, name, CASE WHEN contains(name, '..') THEN 'unsafe' WHEN name IN (SELECT concat(page_id, k, '.png') FROM corpus, (VALUES ('-0'), ('-1')) v(k)) THEN 'present' ELSE 'missing' END AS state FROM refs""",
)
def referenced_assets(spark, folder):
    name = "concat(page_id, '-', CAST(i % 8 AS STRING), '.png')"
    bodies = whole_bodies(
        spark, folder,
        f"CASE i % 4 WHEN 0 THEN concat('<img src=\"assets/', {name}, '\">', line) WHEN 1 THEN concat('![', line, '](assets/', {name}, ')') "
        "WHEN 2 THEN concat('<img src=\"assets/../', page_id, '.png\"> ', line) ELSE line END",
    )
    ends = F.array(F.lit("-0.png"), F.lit("-1.png"))
    pool = T.corpus(spark, folder).select(F.explode(F.transform(ends, lambda e: F.concat("page_id", e))).alias("name"))
    return A.referenced_assets(bodies, pool, "page_id", "body")


@query(
    "image_slot_repair",
    f"""WITH {ctes.IMAGE_SLOTS},
n AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY ord) AS n FROM image_slots),
r AS (SELECT page_id, name, row_number() OVER (PARTITION BY page_id ORDER BY ord) AS n FROM image_slots WHERE kind = 'real')
SELECT n.page_id, n.ord, n.kind, n.name, CASE WHEN n.kind = 'placeholder' AND n.locale <> 'en' AND r.name IS NOT NULL THEN r.name ELSE n.name END AS repaired
FROM n LEFT JOIN r ON r.page_id = CAST(CAST(n.family_id AS BIGINT) + 1 AS VARCHAR) AND r.n = n.n""",
)
def image_slot_repair(spark, folder):
    s = T.image_slots(spark, folder)
    # The second English page of a family has two slots, so translations have a surplus.
    sibling = (F.col("family_id").cast("bigint") + 1).cast("string")
    siblings = s.select("page_id", sibling.alias("en_page_id")).distinct()
    return A.repair_image_slots(s, siblings)


LOST = "CASE WHEN doc_id % 2 = 0 THEN '[Image Placeholder]' ELSE concat('static/images/', page_id, '_', CAST(i AS $text), '.png') END"


@query(
    "image_repair",
    f"""WITH {ctes.CORPUS}, {BODY_LINES}, slots AS (
  SELECT doc_id, page_id, line, i, CASE WHEN i % 6 = 1 OR i % 12 = 5 THEN 'lost' WHEN i % 3 = 0 THEN 'real' END AS kind,
    CASE WHEN i % 6 = 1 OR i % 12 = 5 THEN concat(':::note 🖼️', chr(10), {LOST.replace('$text', 'VARCHAR')}, chr(10), chr(10), ':::')
      WHEN i % 3 = 0 THEN concat('![', line, '](assets/', page_id, '-', CAST(i AS VARCHAR), '.png)') END AS slot FROM body_lines),
numbered AS (SELECT *, row_number() OVER (PARTITION BY page_id, kind IS NULL ORDER BY i) AS n FROM slots),
english AS (SELECT page_id, slot AS image, row_number() OVER (PARTITION BY page_id ORDER BY i) AS n FROM slots WHERE kind = 'real'),
mended AS (
  SELECT s.*, c.locale, CASE WHEN s.kind = 'lost' AND c.locale <> 'en' THEN coalesce(e.image, s.slot) ELSE s.slot END AS now
  FROM numbered s JOIN corpus c ON c.page_id = s.page_id LEFT JOIN english e ON e.page_id = c.family_id AND e.n = s.n AND s.kind = 'lost')
SELECT page_id, sha256(string_agg(CASE kind WHEN 'lost' THEN concat(now, chr(10), line) WHEN 'real' THEN now ELSE line END, chr(10) ORDER BY i)) AS body_hash, bool_or(coalesce(now <> slot, false)) AS mended
FROM mended GROUP BY page_id""",
)
def image_repair(spark, folder):
    docs = whole_bodies(
        spark, folder,
        f"CASE WHEN i % 6 = 1 OR i % 12 = 5 THEN concat(':::note 🖼️\\n', {LOST.replace('$text', 'STRING')}, '\\n\\n:::\\n', line) "
        "WHEN i % 3 = 0 THEN concat('![', line, '](assets/', page_id, '-', CAST(i AS STRING), '.png)') ELSE line END",
    )
    docs = docs.withColumn("en_sibling_id", (F.col("doc_id") - F.col("doc_id") % 4).cast("string"))
    before = docs.select("page_id", F.xxhash64("body").alias("was"))
    after = A.repair_images(docs, docs.select("page_id", "body")).join(before, "page_id")
    return after.select("page_id", F.sha2("body", 256).alias("body_hash"), (F.xxhash64("body") != F.col("was")).alias("mended"))


@query("static_images", f"WITH {REFS} SELECT page_id, ord, CASE WHEN kind = 'real' THEN concat('<img src=\"{fixed.STATIC_IMAGE_PREFIX}', replace(name, 'assets/', ''), '\">') "
       "ELSE concat('<img src=\"assets/../', page_id, '.png\">') END AS body FROM image_slots")
def static_images(spark, folder):
    s = T.image_slots(spark, folder)
    body = F.when(F.col("kind") == "real", F.concat(F.lit('<img src="'), "name", F.lit('">'))).otherwise(
        F.concat(F.lit('<img src="assets/../'), "page_id", F.lit('.png">'))
    )
    return s.select("page_id", "ord", A.static_images(body).alias("body"))
