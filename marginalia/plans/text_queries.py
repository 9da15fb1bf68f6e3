"""Line structure, cleaning, blocks and chunks as queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import lines as L
from ..functions.ordered import best_per_group
from ..functions.rows import array_rows
from ..operators import blocks as B
from ..operators import chunks as K
from ..operators import text as X
from ..session import shared_dir
from ..sources import sinks
from ..sources import tables as T
from . import ctes
from .shared import plan

QUERIES = {}
CHECKS = {}


def query(name: str, check: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if check:
            CHECKS[name] = check
        return fn

    return add


def with_lines(body: str) -> str:
    return f"WITH {ctes.FENCED}\n{body}"


def with_corpus(body: str) -> str:
    return f"WITH {ctes.CORPUS}\n{body}"


# --- line structure -------------------------------------------------------------------


@query("fence_state", with_lines("SELECT doc_id, line_no, is_fence, in_fence FROM fenced"))
def fence_state(spark, folder):
    d = T.md_docs(spark, folder)
    rows = array_rows(d, ["doc_id"], F.arrays_zip(F.col("lines").alias("line"), L.fence_open().alias("open")), "line_no", "r")
    return rows.select(
        "doc_id", "line_no", F.col("r.line").startswith(L.FENCE).alias("is_fence"), F.col("r.open").alias("in_fence")
    )


HEADINGS = """headed AS (
  SELECT *, CASE WHEN NOT in_fence AND regexp_matches(line, '^#{1,6}\\s+.+') THEN length(regexp_extract(line, '^(#{1,6})', 1)) END AS level,
    trim(regexp_replace(regexp_replace(regexp_replace(trim(regexp_extract(line, '^#{1,6}\\s+(.+)', 1)), '<[^>]+>', ' ', 'g'), '\\*\\*|`', '', 'g'), '\\s+', ' ', 'g')) AS heading
  FROM fenced),
opened AS (
  SELECT *, last_value(CASE WHEN level = 2 THEN line_no END IGNORE NULLS) OVER w AS at2, last_value(CASE WHEN level = 2 THEN heading END IGNORE NULLS) OVER w AS t2,
    last_value(CASE WHEN level = 3 THEN line_no END IGNORE NULLS) OVER w AS at3, last_value(CASE WHEN level = 3 THEN heading END IGNORE NULLS) OVER w AS t3,
    CAST(count(level) OVER w AS INT) AS section
  FROM headed WINDOW w AS (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
pathed AS (SELECT *, concat_ws('/', t2, CASE WHEN at3 > coalesce(at2, -1) THEN t3 END) AS path FROM opened)"""


@query("heading_path", with_lines(f", {HEADINGS} SELECT doc_id, line_no, path FROM pathed"))
def heading_path(spark, folder):
    d = T.md_docs(spark, folder)
    rows = array_rows(d, ["doc_id"], L.heading_stacks(), "line_no", "stack")
    return rows.select("doc_id", "line_no", F.array_join("stack", "/").alias("path"))


UNITS = """kinds AS (
  SELECT *, CASE WHEN is_fence OR in_fence THEN 3 WHEN regexp_matches(line, '^\\s*$') THEN 0 WHEN starts_with(line, '|') THEN 2 ELSE 1 END AS kind FROM fenced),
starts AS (
  SELECT *, CASE WHEN kind = 3 THEN is_fence AND NOT in_fence WHEN kind = 0 THEN false
    ELSE kind <> coalesce(lag(kind) OVER (PARTITION BY doc_id ORDER BY line_no), -1) END AS begins FROM kinds),
unit_lines AS (
  SELECT *, sum(CASE WHEN begins THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) - 1 AS unit_no FROM starts WHERE kind <> 0),
units AS (SELECT doc_id, CAST(unit_no AS INT) AS unit_no, string_agg(line, chr(10) ORDER BY line_no) AS text FROM unit_lines GROUP BY 1, 2)"""


@query("paragraph_units", with_lines(f", {UNITS} SELECT doc_id, unit_no, text FROM units"))
def paragraph_units(spark, folder):
    d = T.md_docs(spark, folder)
    return array_rows(d, ["doc_id"], L.paragraph_units(F.col("lines")), "unit_no", "text")


@query(
    "section_split",
    with_lines(
        f""", {HEADINGS}, cut AS (
  SELECT doc_id, section, any_value(path) AS path, trim(string_agg(line, chr(10) ORDER BY line_no), ' ' || chr(9) || chr(10) || chr(13)) AS text
  FROM pathed GROUP BY doc_id, section)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY section) - 1 AS INT) AS section_no, path, text FROM cut WHERE path <> '' OR text <> ''"""
    ),
)
def section_split(spark, folder):
    d = T.md_docs(spark, folder)
    rows = array_rows(d, ["doc_id"], L.sections(), "section_no", "s")
    return rows.select("doc_id", "section_no", F.array_join("s.path", "/").alias("path"), F.col("s.text").alias("text"))


SECTION_FOLD = f"""RECURSIVE {ctes.FENCED}, {HEADINGS}, cut AS (
  SELECT doc_id, section, any_value(path) AS path, trim(string_agg(line, chr(10) ORDER BY line_no), ' ' || chr(9) || chr(10) || chr(13)) AS text
  FROM pathed GROUP BY doc_id, section),
real AS (
  SELECT doc_id, path, text, {ctes.utf16('text')} AS n, row_number() OVER (PARTITION BY doc_id ORDER BY section) AS i FROM cut
  WHERE regexp_matches(text, '[\\p{{L}}\\p{{N}}]')),
fold AS (
  SELECT doc_id, i, CAST(0 AS BIGINT) AS section_no, path, n FROM real WHERE i = 1
  UNION ALL
  SELECT f.doc_id, r.i, CASE WHEN ceil(f.n / 4.0) < 400 AND ceil(f.n / 4.0) + ceil(r.n / 4.0) <= 800 THEN f.section_no ELSE f.section_no + 1 END,
    CASE WHEN ceil(f.n / 4.0) < 400 AND ceil(f.n / 4.0) + ceil(r.n / 4.0) <= 800 THEN f.path ELSE r.path END,
    CASE WHEN ceil(f.n / 4.0) < 400 AND ceil(f.n / 4.0) + ceil(r.n / 4.0) <= 800 THEN f.n + 2 + r.n ELSE r.n END
  FROM fold f JOIN real r ON r.doc_id = f.doc_id AND r.i = f.i + 1)
SELECT f.doc_id, CAST(f.section_no AS INT) AS section_no, any_value(f.path) AS path, string_agg(r.text, chr(10) || chr(10) ORDER BY f.i) AS text
FROM fold f JOIN real r ON r.doc_id = f.doc_id AND r.i = f.i GROUP BY 1, 2"""


@query("section_coalesce", f"WITH {SECTION_FOLD}")
def section_coalesce(spark, folder):
    s = K.page_sections(T.md_docs(spark, folder))
    return s.select("doc_id", "section_no", F.array_join("heading_path", "/").alias("path"), "text")


# --- packing (every line of a document is a paragraph here) -------------------------------

PACKED = f"""RECURSIVE {ctes.DOC_LINES}, paras AS (
  SELECT doc_id, raw AS text, {ctes.tokens('raw')} AS t, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS i
  FROM doc_lines WHERE NOT regexp_matches(raw, '^\\s*$')),
packed AS (
  SELECT doc_id, i, 0 AS piece_no, t AS n FROM paras WHERE i = 1
  UNION ALL
  SELECT p.doc_id, q.i, CASE WHEN p.n + q.t > 800 THEN p.piece_no + 1 ELSE p.piece_no END, CASE WHEN p.n + q.t > 800 THEN q.t ELSE p.n + q.t END
  FROM packed p JOIN paras q ON q.doc_id = p.doc_id AND q.i = p.i + 1)"""


def spaced_docs(spark, folder):
    """Documents with an empty line between all lines, so that each line is a paragraph."""
    d = T.table(spark, folder, "documents")
    return d.select("doc_id", F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"))


def packed_docs(spark, folder):
    d = spaced_docs(spark, folder)
    return d.select("doc_id", K.pack(L.paragraph_units(F.split("text", "\n"))).alias("pieces"))


@query(
    "greedy_pack",
    f"WITH {PACKED} SELECT p.doc_id, p.piece_no, string_agg(q.text, chr(10) || chr(10) ORDER BY p.i) AS text, count(*) AS paragraphs "
    "FROM packed p JOIN paras q ON q.doc_id = p.doc_id AND q.i = p.i GROUP BY 1, 2",
)
def greedy_pack(spark, folder):
    p = array_rows(packed_docs(spark, folder), ["doc_id"], "pieces", "piece_no", "piece")
    return p.select(
        "doc_id", "piece_no", F.array_join("piece", "\n\n").alias("text"), F.size("piece").cast("bigint").alias("paragraphs")
    )


def repair_sql(paras: str, packed: str) -> str:
    """CTEs that repair sizes one step at a time: ``pieced`` with sid, piece_no and the first and last paragraph.

    ``paras`` has sid, i, u (size), t (estimate); ``packed`` sid, i, piece_no. The state is the list of the pieces'
    first paragraphs, the place in it, and whether this pass changed anything.
    """
    tokens = lambda a, b: f"CAST(ceil((us[{b}] - coalesce(us[{a} - 1], 0) + 2 * ({b} - ({a}))) / 4.0) AS BIGINT)"
    total = lambda a, b: f"(es[{b}] - coalesce(es[{a} - 1], 0))"
    return f"""sums AS (
  SELECT sid, list(cu ORDER BY i) AS us, list(ce ORDER BY i) AS es, count(*) AS m FROM (
    SELECT sid, i, CAST(sum(u) OVER w AS BIGINT) AS cu, CAST(sum(t) OVER w AS BIGINT) AS ce FROM {paras} WINDOW w AS (PARTITION BY sid ORDER BY i)) GROUP BY sid),
rep AS (
  SELECT sid, 1 AS pass, CAST(1 AS BIGINT) AS i, false AS changed, list(first ORDER BY first) AS s, false AS done
  FROM (SELECT sid, piece_no, CAST(min(i) AS BIGINT) AS first FROM {packed} GROUP BY 1, 2) GROUP BY sid
  UNION ALL
  SELECT sid, CASE WHEN act = 'end' THEN pass + 1 ELSE pass END, CASE WHEN act = 'end' THEN 1 WHEN act IN ('prev', 'join') OR shared THEN i ELSE i + 1 END,
    act <> 'end' AND (changed OR act IN ('prev', 'join') OR shared),
    CASE WHEN act = 'prev' THEN list_concat(s[1:i - 1], s[i + 1:]) WHEN act = 'join' THEN list_concat(s[1:i], s[i + 2:])
      WHEN shared THEN list_concat(list_append(s[1:CASE WHEN ahead THEN i ELSE i - 1 END], border + 1), s[CASE WHEN ahead THEN i + 2 ELSE i + 1 END:]) ELSE s END,
    act = 'end' AND (pass = 2 OR NOT changed)
  FROM (SELECT *, coalesce(act = 'even' AND many >= 2 AND {total('ea', 'eb')} >= 800 AND {tokens('ea', 'border')} >= 400 AND {tokens('border + 1', 'eb')} >= 400, false) AS shared
    FROM (SELECT *, CASE WHEN act = 'even' AND eb > ea THEN list_min(list_transform(range(ea, eb), lambda k: row(abs(2 * (es[k] - coalesce(es[ea - 1], 0)) - {total('ea', 'eb')}), k)))[2] END AS border
      FROM (SELECT *, CASE WHEN i > n THEN 'end' WHEN tc >= 400 THEN 'next' WHEN tpc <= 960 THEN 'prev' WHEN tcn <= 960 THEN 'join' ELSE 'even' END AS act,
          CASE WHEN ahead THEN ca ELSE pa END AS ea, CASE WHEN ahead THEN nb ELSE cb END AS eb, CASE WHEN ahead THEN nb - cb ELSE ca - pa END AS many
        FROM (SELECT *, tn IS NOT NULL AND (tp IS NULL OR tn >= tp) AS ahead
          FROM (SELECT *, {tokens('ca', 'cb')} AS tc, CASE WHEN i > 1 THEN {tokens('pa', 'ca - 1')} END AS tp, CASE WHEN i < n THEN {tokens('cb + 1', 'nb')} END AS tn,
              CASE WHEN i > 1 THEN {tokens('pa', 'cb')} END AS tpc, CASE WHEN i < n THEN {tokens('ca', 'nb')} END AS tcn
            FROM (SELECT r.*, a.us, a.es, a.m, len(s) AS n, s[i] AS ca, coalesce(s[i + 1] - 1, m) AS cb, s[i - 1] AS pa, coalesce(s[i + 2] - 1, m) AS nb
              FROM rep r JOIN sums a USING (sid) WHERE NOT done)))))) z),
pieced AS (
  SELECT sid, k - 1 AS piece_no, s[k] AS a, coalesce(s[k + 1] - 1, m) AS b
  FROM (SELECT sid, s, m, unnest(range(1, len(s) + 1)) AS k FROM rep JOIN sums USING (sid) WHERE done))"""


def overlap_sql(paras: str) -> str:
    """CTEs that lead every piece of ``pieced`` but the first by the end of the one before: ``led`` with sid, piece_no, text."""
    return f"""placed AS (
  SELECT p.sid, p.piece_no, q.i, q.text, q.t, sum(q.t) OVER (PARTITION BY p.sid, p.piece_no ORDER BY q.i DESC) AS back,
    row_number() OVER (PARTITION BY p.sid, p.piece_no ORDER BY q.i DESC) AS from_end FROM pieced p JOIN {paras} q ON q.sid = p.sid AND q.i BETWEEN p.a AND p.b),
bodies AS (SELECT sid, piece_no, string_agg(text, chr(10) || chr(10) ORDER BY i) AS body FROM placed GROUP BY 1, 2),
tails AS (
  SELECT sid, piece_no, string_agg(text, chr(10) || chr(10) ORDER BY i) FILTER (back <= 120) AS whole,
    CAST(coalesce(max(back) FILTER (back <= 120), 0) AS INT) AS have, count(*) FILTER (back <= 120) AS n FROM placed GROUP BY 1, 2),
leads AS (
  SELECT t.sid, t.piece_no, t.n, t.have, t.whole, p.text AS older, starts_with(p.text, '|') OR starts_with(p.text, '```') AS atomic
  FROM tails t LEFT JOIN placed p ON p.sid = t.sid AND p.piece_no = t.piece_no AND p.from_end = t.n + 1),
leads2 AS (
  SELECT sid, piece_no + 1 AS piece_no, CASE WHEN n = 0 AND atomic THEN '' WHEN n = 0 THEN right(older, 400)
    WHEN have < 80 AND older IS NOT NULL AND NOT atomic THEN concat(right(older, (100 - have) * 4), chr(10), chr(10), whole) ELSE whole END AS lead FROM leads),
led AS (
  SELECT p.sid, p.piece_no, CASE WHEN coalesce(o.lead, '') = '' THEN p.body ELSE concat(o.lead, chr(10), chr(10), p.body) END AS text
  FROM bodies p LEFT JOIN leads2 o ON o.sid = p.sid AND o.piece_no = p.piece_no)"""


@query(
    "min_size_repair",
    f"""WITH {PACKED}, own AS (SELECT doc_id AS sid, i, text, {ctes.utf16('text')} AS u, t FROM paras), packs AS (SELECT doc_id AS sid, i, piece_no FROM packed),
{repair_sql('own', 'packs')}
SELECT sid AS doc_id, CAST(piece_no AS INT) AS piece_no, text, {ctes.tokens('text')} AS tokens FROM (
  SELECT p.sid, p.piece_no, string_agg(q.text, chr(10) || chr(10) ORDER BY q.i) AS text FROM pieced p JOIN own q ON q.sid = p.sid AND q.i BETWEEN p.a AND p.b GROUP BY 1, 2)""",
)
def min_size_repair(spark, folder):
    p = packed_docs(spark, folder).withColumn("s", F.array("pieces"))
    r = array_rows(K.with_repair(p, "s", "r"), ["doc_id"], F.col("r")[0], "piece_no", "piece")
    return r.select(
        "doc_id", "piece_no", F.array_join("piece", "\n\n").alias("text"), K.piece_tokens(F.col("piece")).alias("tokens")
    )


@query(
    "overlap",
    f"""WITH {PACKED}, placed AS (
  SELECT p.doc_id, p.piece_no, p.i, q.text, q.t, sum(q.t) OVER (PARTITION BY p.doc_id, p.piece_no ORDER BY p.i DESC) AS back,
    row_number() OVER (PARTITION BY p.doc_id, p.piece_no ORDER BY p.i DESC) AS from_end FROM packed p JOIN paras q ON q.doc_id = p.doc_id AND q.i = p.i),
pieces AS (SELECT doc_id, piece_no, string_agg(text, chr(10) || chr(10) ORDER BY i) AS body FROM placed GROUP BY 1, 2),
tails AS (
  SELECT doc_id, piece_no, string_agg(text, chr(10) || chr(10) ORDER BY i) FILTER (back <= 120) AS whole,
    CAST(coalesce(max(back) FILTER (back <= 120), 0) AS INT) AS have, count(*) FILTER (back <= 120) AS n FROM placed GROUP BY 1, 2),
leads AS (
  SELECT t.doc_id, t.piece_no, t.n, t.have, t.whole, p.text AS older, starts_with(p.text, '|') OR starts_with(p.text, '```') AS atomic
  FROM tails t LEFT JOIN placed p ON p.doc_id = t.doc_id AND p.piece_no = t.piece_no AND p.from_end = t.n + 1),
leads2 AS (
  SELECT doc_id, piece_no + 1 AS piece_no, CASE WHEN n = 0 AND atomic THEN '' WHEN n = 0 THEN right(older, 400)
    WHEN have < 80 AND older IS NOT NULL AND NOT atomic THEN concat(right(older, (100 - have) * 4), chr(10), chr(10), whole) ELSE whole END AS lead FROM leads)
SELECT p.doc_id, p.piece_no, CASE WHEN coalesce(o.lead, '') = '' THEN p.body ELSE concat(o.lead, chr(10), chr(10), p.body) END AS text
FROM pieces p LEFT JOIN leads2 o ON o.doc_id = p.doc_id AND o.piece_no = p.piece_no""",
)
def overlap(spark, folder):
    p = packed_docs(spark, folder)
    return array_rows(p, ["doc_id"], K.overlapped(F.col("pieces")), "piece_no", "text")


@query(
    "token_estimate",
    f"SELECT lang, count(*) AS documents, CAST(sum({ctes.tokens('text')}) AS BIGINT) AS tokens, max({ctes.tokens('text')}) AS largest, "
    f"median({ctes.tokens('text')}) AS median_tokens FROM documents GROUP BY lang",
)
def token_estimate(spark, folder):
    d = T.table(spark, folder, "documents").select("lang", C.token_estimate("text").alias("t"))
    return d.groupBy("lang").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("t").alias("tokens"), F.max("t").alias("largest"),
        F.expr("percentile(t, 0.5)").alias("median_tokens"),
    )


def _chunk_input(spark, folder):
    """Published content pages with their lines. Bodies of explicitly labelled pages are
    filed by slug, the first page of a slug counting; all others by page id."""
    c = T.corpus(spark, folder).withColumnRenamed("body", "text")
    pages = K.chunkable_pages(c).select("page_id", "title", "locale", "slug", C.content_hash("text").alias("content_hash"))
    bodies = c.select("page_id", "slug", "source_idx", "language_source", F.expr(T.DECORATED).alias("body"))
    named = F.col("language_source") == "explicit"
    by_id = bodies.filter(~named).select(F.col("page_id").alias("key"), "body")
    first = best_per_group(bodies.filter(named & (F.col("slug") != "")), ["slug"], [F.col("source_idx")], ["page_id"])
    by_slug = bodies.select("page_id", "body").join(first, "page_id").select(F.col("slug").alias("key"), "body")
    return K.attach_bodies(pages, by_id.unionByName(by_slug)).withColumnRenamed("body", "lines")


def _chunks(spark, folder):
    docs = _chunk_input(spark, folder).select("page_id", "title", "locale", "slug", "content_hash", "lines")
    return K.chunk_rows(docs).withColumns(
        {
            "source_url": F.concat(F.lit("https://notion.so/"), C.undashed("page_id")),
            "docusaurus_path": F.concat(F.lit("/"), "slug"),
            "status": F.lit("active"),
        }
    )


# All chunks of published pages, by the folds above. A section over the maximum is cut again into its own lines.
CHUNKS = f"""{SECTION_FOLD[:SECTION_FOLD.rindex('SELECT f.doc_id')].rstrip()},
wide AS (
  SELECT f.doc_id, f.section_no, concat(f.doc_id, '-', f.section_no) AS sid, any_value(f.path) AS path, string_agg(r.text, chr(10) || chr(10) ORDER BY f.i) AS text, max(f.n) AS n
  FROM fold f JOIN real r ON r.doc_id = f.doc_id AND r.i = f.i GROUP BY 1, 2),
long_lines AS (
  SELECT sid, line_no, line, starts_with(line, '```') AS is_fence,
    coalesce(sum(CASE WHEN starts_with(line, '```') THEN 1 ELSE 0 END) OVER (PARTITION BY sid ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) % 2 = 1 AS in_fence
  FROM (SELECT sid, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM wide WHERE ceil(n / 4.0) > 800)),
long_kinds AS (
  SELECT *, CASE WHEN is_fence OR in_fence THEN 3 WHEN trim(line, ' ' || chr(9) || chr(10) || chr(13)) = '' THEN 0 WHEN starts_with(line, '|') THEN 2 ELSE 1 END AS kind FROM long_lines),
long_starts AS (
  SELECT *, CASE WHEN kind = 3 THEN is_fence AND NOT in_fence WHEN kind = 0 THEN false
    ELSE kind <> coalesce(lag(kind) OVER (PARTITION BY sid ORDER BY line_no), -1) END AS begins FROM long_kinds),
long_units AS (
  SELECT sid, unit, string_agg(line, chr(10) ORDER BY line_no) AS text FROM (
    SELECT *, sum(CASE WHEN begins THEN 1 ELSE 0 END) OVER (PARTITION BY sid ORDER BY line_no) AS unit FROM long_starts WHERE kind <> 0) GROUP BY 1, 2),
own AS (
  SELECT sid, row_number() OVER (PARTITION BY sid ORDER BY unit) AS i, text, {ctes.utf16('text')} AS u, {ctes.tokens('text')} AS t FROM long_units),
packs AS (
  SELECT sid, i, 0 AS piece_no, t AS n FROM own WHERE i = 1
  UNION ALL
  SELECT p.sid, q.i, CASE WHEN p.n + q.t > 800 THEN p.piece_no + 1 ELSE p.piece_no END, CASE WHEN p.n + q.t > 800 THEN q.t ELSE p.n + q.t END
  FROM packs p JOIN own q ON q.sid = p.sid AND q.i = p.i + 1),
{repair_sql('own', 'packs')},
{overlap_sql('own')},
cuts AS (
  SELECT w.doc_id, w.section_no, l.piece_no, w.path, l.text FROM wide w JOIN led l USING (sid)
  UNION ALL SELECT doc_id, section_no, 0, path, text FROM wide WHERE ceil(n / 4.0) <= 800),
{ctes.CORPUS},
filed AS (
  SELECT page_id AS key, doc_id FROM corpus WHERE language_source <> 'explicit'
  UNION ALL (SELECT slug, doc_id FROM corpus WHERE language_source = 'explicit' AND slug <> '' QUALIFY row_number() OVER (PARTITION BY slug ORDER BY source_idx, page_id) = 1)),
gated AS (
  SELECT c.page_id, c.title, c.locale, c.slug, concat('sha256:', sha256(c.body)) AS content_hash,
    CASE WHEN EXISTS (SELECT 1 FROM filed f WHERE f.key = c.page_id) THEN c.page_id ELSE c.slug END AS key
  FROM corpus c WHERE c.status = 'active' AND c.element_type = 'Page'),
rag AS (
  SELECT concat('sha256:', sha256(concat_ws(':', page_id, content_hash, path, CAST(chunk_index AS VARCHAR)))) AS chunk_id, *,
    concat('https://notion.so/', replace(page_id, '-', '')) AS source_url, concat('/', slug) AS docusaurus_path, 'active' AS status
  FROM (SELECT g.page_id, g.title, g.locale, g.slug, g.content_hash, CAST(row_number() OVER (PARTITION BY g.page_id ORDER BY c.section_no, c.piece_no) - 1 AS INT) AS chunk_index,
      c.path AS heading_path, trim(c.text, ' ' || chr(9) || chr(10) || chr(13)) AS text, c.path AS path
    FROM gated g JOIN filed f ON f.key = g.key JOIN cuts c ON c.doc_id = f.doc_id))"""


@query("rag_chunks", f"WITH {CHUNKS} SELECT * EXCLUDE (path) FROM rag")
def rag_chunks(spark, folder):
    return _chunks(spark, folder).withColumn("heading_path", F.array_join("heading_path", "/"))


@query(
    "chunk_stats",
    f"""WITH {CHUNKS}, sized AS (SELECT locale, page_id, {ctes.tokens('text')} AS t FROM rag),
per AS (SELECT locale, count(*) AS chunks, median(t) AS median_tokens, count(*) FILTER (t < 50) AS small FROM sized GROUP BY locale),
bare AS (SELECT locale, count(*) AS pages, count(*) FILTER (page_id NOT IN (SELECT page_id FROM sized)) AS without FROM gated GROUP BY locale)
SELECT locale, pages, coalesce(chunks, 0) AS chunks, CAST(median_tokens AS DOUBLE) AS median_tokens, coalesce(small, 0) AS small, round(small / chunks, 6) AS small_share,
  without AS pages_without_chunks FROM bare LEFT JOIN per USING (locale)""",
)
def chunk_stats(spark, folder):
    pages = K.chunkable_pages(T.corpus(spark, folder)).select("page_id", "locale")
    return K.chunk_stats(pages, _chunks(spark, folder).select("page_id", "text"))


@query(
    "chunk_sink",
    f"WITH {CHUNKS} SELECT locale, '1.0' AS schema_version, count(*) AS chunks FROM rag GROUP BY locale UNION ALL SELECT '', '1.0', count(*) FROM rag",
)
def chunk_sink(spark, folder):
    import uuid

    path = f"{shared_dir(spark)}/chunks-{uuid.uuid4().hex}"
    sinks.write_chunks(_chunks(spark, folder), path)
    stored = spark.read.parquet(path)
    header = sinks.chunk_manifest(stored).select(F.lit("").alias("locale"), "schema_version", "chunks")
    per_locale = stored.groupBy("locale").agg(F.lit("1.0").alias("schema_version"), F.count(F.lit(1)).alias("chunks"))
    return per_locale.unionByName(header)


# --- cleaning ---------------------------------------------------------------------------------

# Markup around whole lines, and lines of markup between them; no character of a text is left out.
MESSY = """
    flatten(transform(split(text, '\\n'), (line, i) -> CASE
        WHEN i = 0 AND doc_id % 3 = 0 THEN array(concat('# ', line))
        WHEN i % 14 = 1 THEN array(concat('**', line, '**'))
        WHEN i % 14 = 2 THEN array(concat(line, ' <b one two> or <link to section.>'))
        WHEN i % 14 = 3 THEN array(concat('{x {', line, ' }}'))
        WHEN i % 14 = 4 THEN array(concat('![a]( b c.png ) ', line))
        WHEN i % 14 = 5 THEN array(concat('![a](undefined)', line))
        WHEN i % 14 = 6 THEN array('[Image: http://x]', line)
        WHEN i % 14 = 8 THEN array(concat('# ', line))
        WHEN i % 14 = 9 THEN array('##', line)
        WHEN i % 14 IN (11, 13) THEN array(concat('```', line))
        WHEN i % 14 = 12 THEN array(concat('{keep} # x', line))
        ELSE array(line) END))
"""


def messy_docs(spark, folder):
    return T.table(spark, folder, "documents").select(
        "doc_id", F.substring_index("text", "\n", 1).alias("title"), F.array_join(F.expr(MESSY), "\n").alias("text")
    )


@query(
    "clean_corpus",
    """WITH raw AS (
  SELECT doc_id, split_part(text, chr(10), 1) AS title, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
m AS (SELECT doc_id, title, i, i % 14 IN (6, 9) AS plain, i % 14 = 9 AS after_empty, CASE
    WHEN i = 0 AND doc_id % 3 = 0 THEN concat('# ', line) WHEN i % 14 = 1 THEN concat('**', line, '**') WHEN i % 14 = 2 THEN concat(line, ' <b one two> or <link to section.>')
    WHEN i % 14 = 3 THEN concat('{x {', line, ' }}') WHEN i % 14 = 4 THEN concat('![a]( b c.png ) ', line)
    WHEN i % 14 = 5 THEN concat('![a](undefined)', line)
    WHEN i % 14 = 8 THEN concat('# ', line) WHEN i % 14 IN (11, 13) THEN concat('```', line) WHEN i % 14 = 12 THEN concat('{keep} # x', line) ELSE line END AS line, 1 AS sub FROM raw
  UNION ALL SELECT doc_id, title, i, false, false, CASE i % 14 WHEN 6 THEN '[Image: http://x]' ELSE '##' END, 0 FROM raw WHERE i % 14 IN (6, 9)),
n AS (SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY i, sub) AS next_line, max(i) OVER (PARTITION BY doc_id) AS last_i,
    row_number() OVER (PARTITION BY doc_id, regexp_matches(line, '^\\s{0,3}#\\s*[^#\\s]') AND i % 14 <> 12 ORDER BY i, sub) AS nth FROM m),
a AS (SELECT *, i % 14 = 12 AND last_i > i AS in_code, regexp_matches(line, '^\\s{0,3}#\\s*[^#\\s]') AND i % 14 <> 12 AS top,
    regexp_matches(trim(line), '^\\s*\\*\\*[^*].*\\*\\*\\s*$') AND coalesce(regexp_matches(next_line, '\\S'), false) AS bold FROM n),
b AS (SELECT *, CASE WHEN bold THEN line || chr(10) ELSE line END AS l1 FROM a),
c AS (SELECT *, CASE WHEN in_code THEN l1 WHEN i % 14 = 9 AND sub = 0 THEN '' WHEN top AND nth > 1 THEN concat('## ', trim(regexp_extract(l1, '^\\s{0,3}#\\s*(.*)$', 1)))
    ELSE l1 END AS l2 FROM b),
d AS (SELECT *, CASE WHEN in_code THEN l2 WHEN i % 14 = 3 THEN concat('x ', trim(substr(l2, 5, length(l2) - 6))) WHEN i % 14 = 12 THEN replace(replace(l2, '{', ''), '}', '') ELSE l2 END AS l3 FROM c),
d2 AS (SELECT *, CASE WHEN i % 14 = 2 THEN replace(l3, ' <b one two> or <link to section.>', ' [b](#b) or [link to section](#section)') ELSE l3 END AS l3b FROM d),
e AS (SELECT *, CASE WHEN i % 14 = 5 THEN substr(l3b, 16) WHEN i % 14 = 4 THEN replace(l3b, '( b c.png )', '(bc.png)') ELSE l3b END AS l4 FROM d2),
f AS (SELECT *, CASE WHEN i % 14 = 6 AND sub = 0 THEN '' ELSE l4 END AS l5 FROM e),
g AS (SELECT doc_id, any_value(title) AS title, bool_or(l1 <> line) AS bold_breaks, bool_or(l2 <> l1) AS headings, bool_or(l3 <> l2) AS braces, bool_or(l3b <> l3) AS tags,
    string_agg(l3b, chr(10) ORDER BY i, sub) AS t3, regexp_replace(string_agg(l4, chr(10) ORDER BY i, sub), chr(10) || '{3,}', chr(10) || chr(10), 'g') AS t4,
    regexp_replace(regexp_replace(string_agg(l5, chr(10) ORDER BY i, sub), chr(10) || '{3,}', chr(10) || chr(10), 'g'), chr(10) || '{3,}', chr(10) || chr(10), 'g') AS t5 FROM f GROUP BY doc_id),
h AS (SELECT *, trim(substr(split_part(t5, chr(10), 1), 3)) AS h1 FROM g)
SELECT doc_id, bold_breaks, headings, braces, tags, t4 <> t3 AS images, t5 <> t4 AS image_notes,
  starts_with(t5, '# ') AND (contains(title, h1) OR contains(h1, title)) AS titles,
  sha256(CASE WHEN starts_with(t5, '# ') AND (contains(title, h1) OR contains(h1, title)) THEN regexp_replace(t5, '^[^' || chr(10) || ']*' || chr(10) || '*', '') ELSE t5 END) AS text_hash FROM h""",
)
def clean_corpus(spark, folder):
    out = X.clean_corpus(messy_docs(spark, folder))
    return out.select("doc_id", *X.CLEANING, F.sha2("cleaned", 256).alias("text_hash"))


@query(
    "clean_counts",
    """SELECT rule, count(*) AS documents FROM (UNPIVOT (SELECT doc_id, bold_breaks, headings, braces, tags, images, image_notes, titles FROM ($clean)) ON COLUMNS(* EXCLUDE doc_id) INTO NAME rule VALUE hit) WHERE hit GROUP BY rule""".replace(
        "$clean", CHECKS["clean_corpus"]
    ),
)
def clean_counts(spark, folder):
    return X.rule_counts(X.clean_corpus(messy_docs(spark, folder)))


@query(
    "duplicate_title",
    with_corpus(
        """SELECT page_id, doc_id % 4 <> 2 AND doc_id % 4 <> 3 AS dropped, sha256(CASE doc_id % 4
  WHEN 0 THEN concat('---', chr(10), '![hero](x.png)', chr(10), chr(10), body) WHEN 1 THEN concat(chr(10), '  ', body)
  WHEN 2 THEN concat('# Unrelated heading', chr(10), chr(10), body) ELSE body END) AS text_hash FROM corpus"""
    ),
)
def duplicate_title(spark, folder):
    text = (
        "CASE doc_id % 4 WHEN 0 THEN concat('---\\n![hero](x.png)\\n\\n# ', title, '\\n\\n', body) "
        "WHEN 1 THEN concat('\\n  # ', left(title, 10), '\\n\\n\\n', body) WHEN 2 THEN concat('# Unrelated heading\\n\\n', body) ELSE body END"
    )
    c = T.corpus(spark, folder).select("page_id", "title", F.expr(text).alias("text"))
    c = c.withColumn("kept", X.drop_duplicate_title(F.col("text"), F.col("title")))
    return c.select("page_id", (F.col("kept") != F.col("text")).alias("dropped"), F.sha2("kept", 256).alias("text_hash"))


@query(
    "heading_levels",
    f"""WITH {ctes.MD_LINES}, h AS (
  SELECT doc_id, line_no, 1 AS sub, CASE WHEN line_no % 12 = 2 THEN concat('# ', line) WHEN line_no % 12 = 8 THEN concat('# code', line) ELSE line END AS line,
    max(line_no) OVER (PARTITION BY doc_id) AS last_no FROM md_lines
  UNION ALL SELECT doc_id, line_no, 0, ' ##  ', line_no + 1 FROM md_lines WHERE line_no % 12 = 3),
t AS (SELECT *, line_no % 12 = 8 AND last_no > line_no AS code, regexp_matches(line, '^\\s{{0,3}}#\\s*[^#\\s]') AS h1 FROM h),
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id, h1 AND NOT code ORDER BY line_no, sub) AS nth FROM t)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY line_no, sub) - 1 AS INT) AS line_no, CASE WHEN code THEN line WHEN regexp_matches(line, '^\\s{{0,3}}#{{1,6}}\\s*$') THEN ''
  WHEN h1 AND nth > 1 THEN concat('## ', trim(regexp_extract(line, '^\\s{{0,3}}#\\s*(.*)$', 1))) ELSE line END AS line FROM n""",
)
def heading_levels(spark, folder):
    d = T.md_docs(spark, folder).select(
        "doc_id",
        F.array_join(
            F.expr(
                "flatten(transform(lines, (l, i) -> CASE WHEN i % 12 = 2 THEN array(concat('# ', l)) WHEN i % 12 = 3 THEN array(' ##  ', l) "
                "WHEN i % 12 = 8 THEN array(concat('# code', l)) ELSE array(l) END))"
            ),
            "\n",
        ).alias("text"),
    )
    return array_rows(d, ["doc_id"], F.split(X.fix_headings(F.col("text")), "\n"), "line_no", "line")


@query(
    "hazard_lint",
    with_lines(
        """SELECT doc_id, line_no + 1 AS line, 'string-or-bare-style' AS kind, left(trim(CASE WHEN line_no % 17 = 3 THEN concat(line, ' style="a"') ELSE line END), 120) AS snippet
FROM fenced WHERE NOT in_fence AND NOT is_fence AND (line_no % 17 = 3 OR contains(line, 'style='))"""
    ),
)
def hazard_lint(spark, folder):
    d = T.md_docs(spark, folder).select(
        "doc_id",
        F.expr(
            "transform(lines, (l, i) -> CASE WHEN i % 17 = 3 THEN concat(l, ' style=\"a\"') WHEN i % 17 = 4 THEN concat(l, ' `style=b` style={{c: 1}}') ELSE l END)"
        ).alias("lines"),
    )
    return X.style_hazards(d)


@query("anchor_slug", with_corpus(
    "SELECT page_id, replace(regexp_replace(lower(trim(title)), '[^\\p{L}\\p{M}\\p{N}_\\- ]', '', 'g'), ' ', '-') AS anchor FROM corpus"))
def anchor_slug(spark, folder):
    return T.corpus(spark, folder).select("page_id", C.anchor_slug("title").alias("anchor"))


@query(
    "emit_cleanup",
    with_corpus(
        """SELECT page_id, sha256(CASE doc_id % 6 WHEN 0 THEN concat('kept', chr(10), body) WHEN 1 THEN concat(body, chr(10)) WHEN 2 THEN
    (CASE WHEN locale = 'en' THEN concat(':::note', chr(10), 'Content coming soon — this page has no content in Notion yet.', chr(10), ':::', chr(10)) ELSE '' END)
  WHEN 3 THEN (CASE WHEN locale = 'en' THEN concat(':::note', chr(10), 'Content coming soon — this page has no content in Notion yet.', chr(10), ':::', chr(10)) ELSE '' END)
  ELSE body END) AS text_hash FROM corpus"""
    ),
)
def emit_cleanup(spark, folder):
    body = (
        "CASE doc_id % 6 WHEN 0 THEN concat('kept\\n  [ INSERT content here ] \\n', body) WHEN 1 THEN concat(body, '\\n\\n---\\n') "
        "WHEN 2 THEN '' WHEN 3 THEN '[add content here]' ELSE body END"
    )
    c = T.corpus(spark, folder).select("page_id", "locale", F.expr(body).alias("body"))
    return c.select("page_id", F.sha2(X.emit_body(F.col("body"), F.col("locale")), 256).alias("text_hash"))


EMITTED = f"""WITH {ctes.PLAN}, b AS (SELECT page_id, has_body, body FROM corpus WHERE section_order IS DISTINCT FROM 7),
emitted AS (
  SELECT r.page_id, r.locale, CASE WHEN b.page_id IS NULL THEN 'missing' WHEN r.locale = 'en' OR b.has_body THEN 'published'
    WHEN e.has_body THEN 'fallback' ELSE 'skipped' END AS outcome, b.has_body, b.body, e.body AS en_body
  FROM routes r LEFT JOIN b ON b.page_id = r.page_id LEFT JOIN b e ON e.page_id = r.en_fallback_id AND NOT b.has_body)"""


def _emitted(spark, folder):
    routes = plan(spark, folder).routes.select("page_id", "locale", "en_fallback_id")
    fetched = ~F.col("section_order").eqNullSafe(F.lit(7))
    bodies = T.corpus(spark, folder).filter(fetched).select(
        "page_id", F.when(F.col("has_body"), F.col("body")).otherwise("").alias("body")
    )
    return X.emit_pages(routes, bodies)


@query(
    "body_fallback",
    f"""{EMITTED} SELECT page_id, locale, outcome, sha256(CASE WHEN outcome = 'published' AND has_body THEN body WHEN outcome = 'published'
  THEN concat(':::note', chr(10), 'Content coming soon — this page has no content in Notion yet.', chr(10), ':::', chr(10))
  WHEN outcome = 'fallback' THEN en_body END) AS body_hash FROM emitted""",
)
def body_fallback(spark, folder):
    return _emitted(spark, folder).select("page_id", "locale", "outcome", F.sha2("body", 256).alias("body_hash"))


@query(
    "emit_counters",
    f"""{EMITTED} SELECT locale, count(*) FILTER (outcome = 'published') AS published, count(*) FILTER (outcome = 'fallback') AS fallbacks,
  count(*) FILTER (outcome = 'skipped') AS skipped, count(*) FILTER (outcome = 'missing') AS missing FROM emitted GROUP BY locale""",
)
def emit_counters(spark, folder):
    return X.emit_counters(_emitted(spark, folder))


# --- blocks -------------------------------------------------------------------------------------

KNOWN = ("user", "assistant")


@query(
    "block_rollup",
    f"""WITH {ctes.BLOCKS}, r AS (
  SELECT *, CASE WHEN type IN ('user', 'assistant') THEN text ELSE concat('> [!NOTE]', chr(10), '> Unsupported Notion block: `', type, '`') END AS rendered,
    concat(lpad(CAST(pos AS VARCHAR), 19, '0'), '.', block_id) AS here FROM blocks)
SELECT a.page_id, a.block_id, CASE WHEN p.block_id IS NULL THEN 0 ELSE 1 END AS depth, concat_ws('/', p.here, a.here) AS path, a.type, a.rendered, false AS orphan
FROM r a LEFT JOIN r p ON p.block_id = a.parent_id""",
)
def block_rollup(spark, folder):
    return B.block_rollup(T.blocks(spark, folder), KNOWN)


@query(
    "block_documents",
    f"""WITH {ctes.BLOCKS}, r AS (
  SELECT *, CASE WHEN type IN ('user', 'assistant') THEN text ELSE concat('> [!NOTE]', chr(10), '> Unsupported Notion block: `', type, '`') END AS rendered FROM blocks),
t AS (SELECT a.page_id, coalesce(p.pos, a.pos) AS root, CASE WHEN p.pos IS NULL THEN -1 ELSE a.pos END AS below,
    concat(CASE WHEN p.pos IS NULL THEN chr(10) || chr(10) ELSE chr(10) END, a.rendered) AS text FROM r a LEFT JOIN r p ON p.block_id = a.parent_id WHERE a.rendered <> '')
SELECT page_id, CAST(0 AS BIGINT) AS part, concat(ltrim(string_agg(text, '' ORDER BY root, below), chr(10)), chr(10)) AS body FROM t GROUP BY page_id""",
)
def block_documents(spark, folder):
    return B.assemble_documents(B.block_rollup(T.blocks(spark, folder), KNOWN)).drop("last")


# Every line of a document as a block: trees of nineteen, up to thirteen deep, of all kinds that nest or have a form.
OUTLINE_TYPES = (
    "bulleted_list_item", "numbered_list_item", "bulleted_list_item", "quote", "numbered_list_item", "toggle", "paragraph", "to_do", "column", "code", "heading_2", "mystery",
)


def outline_blocks(spark, folder):
    """Blocks of all documents, most of them list items in list items."""
    kinds = F.array(*map(F.lit, OUTLINE_TYPES))
    lines = array_rows(T.table(spark, folder, "documents"), ["doc_id"], F.split("text", "\n"), "i", "line")
    k = F.col("i") % 19
    up = F.when(k > 0, F.col("i") - 1 - F.when((k > 1) & (k % 3 == 2), 1).otherwise(0))
    # Four in a row are of one kind, so that lists nest.
    kind = F.element_at(kinds, ((F.floor(F.col("i") / 4) * 5 + F.col("doc_id")) % len(OUTLINE_TYPES) + 1).cast("int"))
    name = lambda i: F.concat_ws("-", "doc_id", i)
    return lines.select(
        F.col("doc_id").alias("page_id"), name(F.col("i")).alias("block_id"), F.when(up.isNotNull(), name(up)).alias("parent_id"), F.col("i").alias("pos"),
        kind.alias("type"), F.col("line").alias("text"), (F.col("i") % 2 == 0).alias("checked"), F.lit("txt").alias("language"),
    )


@query(
    "nested_documents",
    f"""WITH RECURSIVE lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
b AS (
  SELECT doc_id, i, line, CASE WHEN i % 19 > 0 THEN i - 1 - CASE WHEN i % 19 > 1 AND (i % 19) % 3 = 2 THEN 1 ELSE 0 END END AS up,
    {list(OUTLINE_TYPES)}[CAST(((i // 4) * 5 + doc_id) % {len(OUTLINE_TYPES)} + 1 AS INT)] AS kind FROM lines),
f AS (
  SELECT *, CASE kind WHEN 'bulleted_list_item' THEN concat('- ', line) WHEN 'numbered_list_item' THEN concat('1. ', line) WHEN 'quote' THEN concat('> ', line)
      WHEN 'toggle' THEN concat('<details>', chr(10), '<summary>', line, '</summary>', chr(10)) WHEN 'to_do' THEN concat('- ', CASE WHEN i % 2 = 0 THEN '[x] ' ELSE '[ ] ' END, line)
      WHEN 'column' THEN '' WHEN 'code' THEN concat('```txt', chr(10), line, chr(10), '```') WHEN 'heading_2' THEN concat('## ', line)
      WHEN 'mystery' THEN concat('> [!NOTE]', chr(10), '> Unsupported Notion block: `mystery`') ELSE line END AS form FROM b),
t AS (
  SELECT doc_id, i, kind, form, 0 AS depth, lpad(CAST(i AS VARCHAR), 9, '0') AS path, 0 AS nest, '' AS quote FROM f WHERE up IS NULL
  UNION ALL
  SELECT f.doc_id, f.i, f.kind, f.form, t.depth + 1, concat(t.path, '/', lpad(CAST(f.i AS VARCHAR), 9, '0')), CASE WHEN t.kind LIKE '%list_item' THEN t.nest + 1 ELSE 0 END,
    CASE WHEN t.kind = 'quote' THEN concat(t.quote, '> ') ELSE t.quote END FROM t JOIN f ON f.doc_id = t.doc_id AND f.up = t.i),
r AS (
  SELECT doc_id, path, depth, quote, concat(CASE WHEN kind LIKE '%list_item' THEN repeat('  ', nest) ELSE '' END, form) AS text FROM t
  UNION ALL SELECT doc_id, concat(path, '/~'), depth + 1, quote, CASE WHEN EXISTS (SELECT 1 FROM b WHERE b.doc_id = t.doc_id AND b.up = t.i) THEN concat(chr(10), '</details>') ELSE '</details>' END FROM t WHERE kind = 'toggle'),
q AS (SELECT doc_id, path, concat(CASE WHEN depth = 0 THEN chr(10) || chr(10) ELSE chr(10) END, quote, replace(text, chr(10), chr(10) || quote)) AS text FROM r WHERE text <> '')
SELECT doc_id AS page_id, sha256(concat(ltrim(string_agg(text, '' ORDER BY path), chr(10)), chr(10))) AS body_hash, max(length(path) - length(replace(path, '/', ''))) AS depth FROM q GROUP BY doc_id""",
)
def nested_documents(spark, folder):
    rows = B.block_rollup(outline_blocks(spark, folder))
    deep = rows.filter("rendered <> ''").groupBy("page_id").agg(F.max("depth").cast("bigint").alias("depth"))
    # The body of a page of one part is hashed where it is; only pieces of longer pages meet once more.
    one = (F.col("part") == 0) & F.col("last")
    parts = B.assemble_documents(rows).select("page_id", "part", F.when(one, F.sha2("body", 256)).alias("hash"), F.when(~one, F.col("body")).alias("piece"))
    joined = F.sha2(F.expr("listagg(piece, '') WITHIN GROUP (ORDER BY part)"), 256)
    return parts.groupBy("page_id").agg(F.coalesce(F.max("hash"), joined).alias("body_hash")).join(deep, "page_id")


@query("unsupported_census", f"WITH {ctes.BLOCKS} SELECT type, count(*) AS blocks, type IN ('user', 'assistant') AS supported FROM blocks GROUP BY type")
def unsupported_census(spark, folder):
    return B.type_census(T.blocks(spark, folder), KNOWN)


@query("block_plain_text", f"WITH {ctes.BLOCKS} SELECT block_id, replace(text, chr(10), '') AS plain FROM blocks")
def block_plain_text(spark, folder):
    runs = F.transform(F.split("text", "\n"), lambda t: F.struct(t.alias("plain_text")))
    none = F.expr("CAST(array() AS array<struct<plain_text: string>>)")
    caption_only = F.col("type") == "system"
    b = T.blocks(spark, folder)
    return b.select(
        "block_id",
        B.plain_text(F.when(caption_only, none).otherwise(runs), F.when(caption_only, runs)).alias("plain"),
    )


RUN_TEXTS = ["left(text, 10)", "substr(text, 11, 10)", "concat(' ', substr(text, 21), ' ')", "':'"]


def _lines(x: str, before: str, after: str, bare: str = "s") -> str:
    """Check SQL: markers around each line of a run; ``bare`` renders plain punctuation."""
    core = "regexp_replace(s, '^\\s+|\\s+$', '', 'g')"
    return (
        f"array_to_string(list_transform(string_split({x}, chr(10)), lambda s: CASE WHEN trim(s, ' ' || chr(9)) = '' THEN s "
        f"WHEN NOT regexp_matches(s, '[\\p{{L}}\\p{{N}}]') THEN {bare} "
        f"ELSE concat(regexp_extract(s, '^(\\s*)', 1), '{before}', {core}, '{after}', regexp_extract(s, '(\\s*)$', 1)) END), chr(10))"
    )


RED = ('<span style={{color:"red"}}>', "</span>")


@query(
    "run_render",
    f"""WITH r AS (SELECT conv_id, turn, {RUN_TEXTS[0]} AS a, {RUN_TEXTS[1]} AS b, {RUN_TEXTS[2]} AS c FROM conversations)
SELECT conv_id, turn, concat(CASE WHEN turn % 2 = 0 THEN {_lines('a', '**', '**')} ELSE a END,
  CASE WHEN turn % 5 <> 1 THEN {_lines('b', '~~*', '*~~')} WHEN trim(b, ' ' || chr(10)) = '' THEN b
    ELSE concat(regexp_extract(b, '^(\\s*)', 1), '[', regexp_replace(b, '^\\s+|\\s+$', '', 'g'), '](https://x.org)', regexp_extract(b, '(\\s*)$', 1)) END,
  CASE WHEN turn % 4 = 1 THEN {_lines('c', *RED, bare=f"concat('{RED[0]}', s, '{RED[1]}')")} ELSE c END, ':') AS rendered FROM r""",
)
def run_render(spark, folder):
    c = T.table(spark, folder, "conversations")
    turn = F.col("turn")

    def run(text: str, **on):
        flag = lambda k: F.coalesce(on.get(k, F.lit(False)), F.lit(False)).alias(k)
        return F.struct(
            F.expr(text).alias("plain_text"),
            *[flag(k) for k in ("bold", "italic", "strikethrough", "underline", "code")],
            on.get("color", F.lit("default")).alias("color"),
            on.get("href", F.lit(None).cast("string")).alias("href"),
        )

    runs = F.array(
        run(RUN_TEXTS[0], bold=turn % 2 == 0),
        run(RUN_TEXTS[1], italic=F.lit(True), strikethrough=F.lit(True), href=F.when(turn % 5 == 1, "https://x.org")),
        run(RUN_TEXTS[2], color=F.when(turn % 4 == 1, "red").otherwise("blue_background")),
        run(RUN_TEXTS[3], bold=F.lit(True)),
    )
    return c.select("conv_id", "turn", B.render_runs(runs).alias("rendered"))


@query(
    "table_assemble",
    """WITH t AS (SELECT *, min(l_linenumber) OVER (PARTITION BY l_orderkey) AS first_no,
  concat('| ', CAST(l_linenumber AS VARCHAR), ' | ', CAST(l_partkey AS VARCHAR), ' | ', l_returnflag, ' | ', l_linestatus, ' |') AS line FROM lineitem)
SELECT l_orderkey, l_linenumber AS row_no, 0 AS part, line FROM t
UNION ALL SELECT l_orderkey, l_linenumber, 1, '| --- | --- | --- | --- |' FROM t WHERE l_linenumber = first_no""",
)
def table_assemble(spark, folder):
    rows = T.table(spark, folder, "lineitem")
    return B.table_lines(rows, "l_orderkey", "l_linenumber", ["l_linenumber", "l_partkey", "l_returnflag", "l_linestatus"])
