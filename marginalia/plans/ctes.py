"""Shared WITH clauses of the check queries, in the SQL dialect of the checker."""

from ..functions import fixed


def _slug(x: str) -> str:
    return (
        f"trim(regexp_replace(translate(replace(lower(coalesce({x}, '')), 'æ', 'ae'), "
        f"'{fixed.ACCENTED}', '{fixed.UNACCENTED}'), '[^a-z0-9]+', '-', 'g'), '-')"
    )


def _status(x: str) -> str:
    quoted = lambda xs: ", ".join(f"'{v}'" for v in xs)
    exact = " ".join(
        f"WHEN lower(trim({x})) IN ({quoted(v)}) THEN '{k}'" for k, v in fixed.STATUS_LABELS.items()
    )
    fuzzy = " ".join(
        f"WHEN regexp_matches(lower({x}), '{p}') THEN '{k}'" for k, p in fixed.STATUS_PATTERNS
    )
    return f"CASE WHEN {x} IS NULL OR trim({x}) = '' THEN 'draft' {exact} {fuzzy} ELSE 'draft' END"


def _label(x: str) -> str:
    return f"trim(regexp_replace({x}, '^\\d+[+-]\\s*(-\\s*)?', ''))"


def _dir(x: str) -> str:
    return (
        f"regexp_replace(regexp_replace(replace(lower({_label(x)}), '&', 'and'), "
        f"'[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g')"
    )


def _utf16(x: str) -> str:
    return f"(length({x}) + length(regexp_replace({x}, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')))"


def _tokens(x: str) -> str:
    return f"CAST(ceil({_utf16(x)} / 4.0) AS INTEGER)"


slug, status, label, folder, utf16, tokens = _slug, _status, _label, _dir, _utf16, _tokens

CORPUS = f"""corpus0 AS (
  SELECT doc_id, doc_id AS source_idx, CAST(doc_id AS VARCHAR) AS page_id,
    CAST(doc_id - doc_id % 4 AS VARCHAR) AS family_id,
    CASE doc_id % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'en' WHEN 2 THEN 'es' ELSE 'pt' END AS locale,
    split_part(text, chr(10), 1) AS title,
    CASE WHEN doc_id % 11 = 0 THEN NULL
      ELSE concat(CAST(10 * (1 + CAST(substr(source, 4) AS INT) % 6) AS VARCHAR), '-', source, ' & more') END AS section,
    CASE WHEN doc_id % 5 = 0 THEN NULL ELSE CAST(doc_id % 37 AS INT) END AS section_order,
    CASE doc_id % 15 WHEN 13 THEN 'Title' WHEN 14 THEN 'Toggle' ELSE 'Page' END AS element_type,
    CASE doc_id % 17 WHEN 0 THEN 'Published' WHEN 1 THEN 'Remove' WHEN 2 THEN 'Unplublished'
      WHEN 3 THEN NULL WHEN 4 THEN 'EN Done' WHEN 5 THEN 'Ready to publish' WHEN 6 THEN 'Not started'
      ELSE 'Draft published' END AS publish_status,
    CASE doc_id % 3 WHEN 0 THEN 'explicit' WHEN 1 THEN 'automated' ELSE 'fallback' END AS language_source,
    CASE WHEN doc_id % 4 = 0 AND doc_id % 28 <> 0 THEN [1, 2, 3]
      WHEN doc_id % 20 = 1 THEN [1] ELSE CAST([] AS INT[]) END AS sub_offsets,
    text AS body FROM documents),
corpus AS (SELECT *, length(body) > 200 AS has_body, {_slug('title')} AS slug, {_status('publish_status')} AS status FROM corpus0)"""

DOC_LINES = """doc_lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS raw,
    generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents)"""

MD_LINES = DOC_LINES + """,
md_lines AS (
  SELECT doc_id, CAST(line_no AS INT) AS line_no, CASE
    WHEN line_no % 12 = 0 THEN concat('## ', raw)
    WHEN line_no % 12 = 5 THEN concat('### ', raw)
    WHEN line_no % 12 IN (7, 9) THEN concat('```', raw)
    WHEN line_no % 12 IN (10, 11) THEN concat('| ', raw, ' |')
    ELSE raw END AS line FROM doc_lines)"""

FENCED = MD_LINES + """,
fenced AS (
  SELECT *, starts_with(line, '```') AS is_fence,
    coalesce(sum(CASE WHEN starts_with(line, '```') THEN 1 ELSE 0 END) OVER (
      PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) % 2 = 1 AS in_fence
  FROM md_lines)"""

SYNC_EVENTS = """sync_events AS (
  SELECT event_id, user_id AS page_id, date_trunc('minute', ts) AS edited_at, ts,
    CASE event_type WHEN 'signup' THEN 'page.created' WHEN 'purchase' THEN 'database.updated'
      WHEN 'error' THEN 'failed' ELSE 'page.updated' END AS kind,
    CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)"""

STATE = SYNC_EVENTS + """,
stored_state AS (
  SELECT page_id, edited_at, k FROM sync_events WHERE edited_at < TIMESTAMP '2024-01-15 00:00:00'
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY edited_at DESC, event_id DESC) = 1),
changed_feed AS (
  SELECT page_id, edited_at, k FROM sync_events WHERE edited_at >= TIMESTAMP '2024-01-14 23:59:00'
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY edited_at DESC, event_id DESC) = 1)"""

BLOCKS = """blocks AS (
  SELECT conv_id AS page_id, concat(conv_id, '-', turn) AS block_id,
    CASE WHEN role = 'assistant' AND asked IS NOT NULL THEN concat(conv_id, '-', asked) END AS parent_id,
    turn AS pos, role AS type, text
  FROM (SELECT *, max(CASE WHEN role = 'user' THEN turn END) OVER (
      PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS asked FROM conversations))"""

XLINKS = CORPUS + """,
xlinks AS (
  SELECT c.page_id, c.locale, CASE c.doc_id % 5 WHEN 0 THEN concat('/docs/', t.slug)
    WHEN 1 THEN concat('/es/docs/', t.slug, '/')
    WHEN 2 THEN concat('https://www.notion.so/', lpad(t.page_id, 32, '0'))
    WHEN 3 THEN concat('/docs/unknown-', c.page_id, '#Some Anchor') ELSE '#Some Anchor' END AS target
  FROM corpus c JOIN corpus t ON t.doc_id = c.doc_id + 1)"""

IMAGE_SLOTS = CORPUS + """,
image_slots AS (
  SELECT page_id, family_id, locale, ord,
    CASE WHEN (doc_id + ord) % 3 = 0 THEN 'placeholder' ELSE 'real' END AS kind,
    concat('assets/', page_id, '-', CAST(ord AS VARCHAR), '.png') AS name
  FROM (SELECT *, CAST(unnest(range(0, doc_id % 4 + 1)) AS INT) AS ord FROM corpus))"""

_LABELS = ", ".join(
    f"('{loc}', '{k}', '{v}')" for loc, m in fixed.SECTION_LABELS.items() for k, v in m.items()
)

# The publishing plan, written with windows and narrowing steps instead of ranks.
PLAN = CORPUS + f""",
labels(locale, plain, curated) AS (VALUES {_LABELS}),
internal AS (
  SELECT page_id FROM corpus WHERE regexp_matches(title, '^\\s*(new element|process checklist)\\s*$', 'i')
    OR regexp_matches(title, '\\[\\s*(add content here|en title|insert content here)\\s*\\]', 'i')
    OR regexp_matches(title, '\\((translating|translation|for translation|staging|do not publish|internal)[^)]*\\)', 'i')
    OR trim(title) = page_id),
internal_ids AS (
  SELECT page_id FROM internal UNION
  SELECT CAST(doc_id + unnest(sub_offsets) AS VARCHAR) FROM corpus WHERE page_id IN (SELECT page_id FROM internal)),
visible AS (SELECT * FROM corpus WHERE page_id NOT IN (SELECT page_id FROM internal_ids)),
relations AS (
  SELECT page_id AS family_id, CAST(doc_id + unnest(sub_offsets) AS VARCHAR) AS child_id,
    generate_subscripts(sub_offsets, 1) AS rel_pos FROM visible WHERE len(sub_offsets) > 0),
claimed AS (SELECT family_id AS page_id FROM relations UNION SELECT child_id FROM relations),
foreign_children AS (SELECT DISTINCT child_id FROM relations WHERE child_id <> family_id),
roots AS (
  SELECT *, element_type = 'Page' AS is_content FROM visible
  WHERE len(sub_offsets) > 0 AND page_id NOT IN (SELECT child_id FROM foreign_children)
    AND status NOT IN ('deprecated', 'archived') AND (element_type <> 'Page' OR status = 'active')),
members AS (
  SELECT r.page_id AS family_id, r.is_content AS fam_content, r.locale AS parent_locale, x.rel_pos, true AS is_child, c.*
  FROM roots r JOIN relations x ON x.family_id = r.page_id JOIN visible c ON c.page_id = x.child_id
  WHERE c.status NOT IN ('deprecated', 'archived') AND (NOT r.is_content OR c.status = 'active')
  UNION ALL
  SELECT r.page_id, r.is_content, r.locale, 99, false, c.* FROM roots r JOIN corpus c ON c.page_id = r.page_id),
step1 AS (
  SELECT *, (locale = 'en' AND parent_locale = 'en') AS en_parent,
    bool_or(is_child) OVER (PARTITION BY family_id, locale) AS any_child FROM members),
step2 AS (
  SELECT *, bool_or(has_body) OVER (PARTITION BY family_id, locale) AS any_body FROM step1
  WHERE en_parent OR is_child OR NOT any_child),
step3 AS (
  SELECT *, bool_or(is_child) OVER (PARTITION BY family_id, locale) AS any_child2 FROM step2 WHERE has_body OR NOT any_body),
step4 AS (SELECT * FROM step3 WHERE NOT en_parent OR is_child OR NOT any_child2),
selected AS (
  SELECT * FROM step4 QUALIFY row_number() OVER (PARTITION BY family_id, locale ORDER BY
    CASE language_source WHEN 'explicit' THEN 0 WHEN 'automated' THEN 1 ELSE 2 END,
    CASE WHEN regexp_matches(title, '[-_]\\d{{4}}-\\d{{2}}-\\d{{2}}\\s*translation', 'i') THEN 1 ELSE 0 END,
    coalesce(section_order, 99999), rel_pos) = 1),
sel_en AS (SELECT * FROM selected WHERE locale = 'en'),
families AS (
  SELECT r.page_id AS family_id, r.is_content, r.locale AS parent_locale, r.title AS parent_title,
    lower(r.element_type) AS parent_type, r.source_idx AS parent_idx,
    coalesce(nullif(r.section, ''), nullif(e.section, ''), 'Uncategorized') AS canonical_section,
    coalesce(r.section_order, e.section_order, 9999) AS canonical_order,
    CASE WHEN r.locale = 'en' OR e.page_id IS NULL THEN coalesce(nullif({_slug('r.title')}, ''), r.slug)
      ELSE coalesce(nullif({_slug('e.title')}, ''), e.slug) END AS canonical_slug,
    coalesce(e.section_order, r.section_order, 9999) AS flow_order,
    e.page_id AS en_page_id, e.has_body AS en_has_body, e.source_idx AS en_idx
  FROM roots r LEFT JOIN sel_en e ON e.family_id = r.page_id),
alone_rows AS (SELECT * FROM visible WHERE page_id NOT IN (SELECT page_id FROM claimed) AND element_type <> 'Page'),
alone_content AS (
  SELECT * FROM visible WHERE page_id NOT IN (SELECT page_id FROM claimed) AND element_type = 'Page' AND status = 'active'
    AND NOT regexp_matches(title, '^\\s*[\\[(]?\\s*(testing|test|teste|prueba)\\b', 'i')),
pages_plan AS (
  SELECT s.page_id, s.title, s.slug, s.section, s.section_order, s.language_source, s.has_body, s.source_idx, s.locale,
    f.canonical_slug, f.canonical_section, f.canonical_order, f.flow_order AS event_order, f.family_id, f.parent_idx,
    CASE WHEN s.locale <> 'en' THEN f.en_page_id END AS en_sibling_id,
    CASE WHEN s.locale <> 'en' AND NOT s.has_body AND f.en_has_body THEN f.en_page_id END AS en_fallback_id
  FROM selected s JOIN families f USING (family_id) WHERE f.is_content AND s.element_type = 'Page'
  UNION ALL
  SELECT page_id, title, slug, section, section_order, language_source, has_body, source_idx, locale,
    coalesce(nullif(slug, ''), nullif({_slug('title')}, ''), left(page_id, 8)), coalesce(nullif(section, ''), 'Uncategorized'),
    coalesce(section_order, 9999), coalesce(section_order, 9999), NULL, source_idx, NULL, NULL FROM alone_content),
srows AS (
  SELECT family_id, parent_title, parent_type, canonical_section, flow_order, coalesce(en_idx, parent_idx) AS event_idx, false AS alone, parent_idx
  FROM families WHERE NOT is_content
  UNION ALL
  SELECT page_id, title, lower(element_type), coalesce(nullif(section, ''), 'Uncategorized'), coalesce(section_order, 9999), source_idx, true, source_idx FROM alone_rows),
smembers AS (
  SELECT family_id, locale, title AS member_title FROM selected WHERE NOT fam_content
  UNION ALL SELECT page_id, locale, title FROM alone_rows),
section_locales AS (
  SELECT canonical_section, locale FROM pages_plan UNION
  SELECT s.canonical_section, m.locale FROM srows s JOIN smembers m USING (family_id)),
plan_events AS (
  SELECT s.canonical_section, l.locale, s.parent_type AS event, s.flow_order AS event_order, s.event_idx, s.family_id, m.member_title,
    CASE WHEN s.parent_type = 'toggle' THEN coalesce(nullif({_slug('s.parent_title')}, ''), concat('toggle-', left(s.family_id, 8))) END AS toggle_dir,
    s.parent_title
  FROM srows s JOIN section_locales l USING (canonical_section) LEFT JOIN smembers m ON m.family_id = s.family_id AND m.locale = l.locale
  UNION ALL
  SELECT canonical_section, locale, 'page', event_order, source_idx, NULL, NULL, NULL, NULL FROM pages_plan),
replay0 AS (
  SELECT *, lag(event) OVER w AS prev_event, lag(member_title) OVER w AS prev_title,
    max(CASE WHEN event <> 'page' THEN rn END) OVER (PARTITION BY canonical_section, locale ORDER BY rn
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS open_rn
  FROM (SELECT *, row_number() OVER (PARTITION BY canonical_section, locale ORDER BY event_order, event_idx) AS rn FROM plan_events)
  WINDOW w AS (PARTITION BY canonical_section, locale ORDER BY rn)),
replay AS (
  SELECT r.*, CASE WHEN r.prev_event = 'title' THEN r.prev_title END AS heading,
    CASE WHEN r.event = 'page' THEN o.toggle_dir END AS open_toggle
  FROM replay0 r LEFT JOIN replay0 o ON o.canonical_section = r.canonical_section AND o.locale = r.locale AND o.rn = r.open_rn),
routed AS (
  SELECT p.*, r.heading, coalesce(r.open_toggle, '') AS route_toggle,
    CASE WHEN p.canonical_section = 'Uncategorized' THEN '' ELSE {_dir('p.canonical_section')} END AS route_section
  FROM pages_plan p JOIN replay r ON r.event = 'page' AND r.event_idx = p.source_idx AND r.locale = p.locale AND r.canonical_section = p.canonical_section),
ranked AS (
  SELECT *, row_number() OVER w AS route_rank, count(*) OVER (PARTITION BY locale, route_section, route_toggle, canonical_slug) AS candidates,
    first_value(page_id) OVER w AS winner_id,
    first_value(nullif(heading, '') IGNORE NULLS) OVER (PARTITION BY locale, route_section, route_toggle, canonical_slug ORDER BY
      CASE WHEN has_body THEN 0 ELSE 1 END, CASE WHEN has_body THEN 0 WHEN en_fallback_id IS NULL THEN 1 ELSE 0 END,
      CASE language_source WHEN 'explicit' THEN 0 WHEN 'automated' THEN 1 ELSE 2 END,
      CASE WHEN regexp_matches(title, '[-_]\\d{{4}}-\\d{{2}}-\\d{{2}}\\s*translation', 'i') THEN 1 ELSE 0 END,
      canonical_order, source_idx ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS any_heading
  FROM routed WINDOW w AS (PARTITION BY locale, route_section, route_toggle, canonical_slug ORDER BY
      CASE WHEN has_body THEN 0 ELSE 1 END, CASE WHEN has_body THEN 0 WHEN en_fallback_id IS NULL THEN 1 ELSE 0 END,
      CASE language_source WHEN 'explicit' THEN 0 WHEN 'automated' THEN 1 ELSE 2 END,
      CASE WHEN regexp_matches(title, '[-_]\\d{{4}}-\\d{{2}}-\\d{{2}}\\s*translation', 'i') THEN 1 ELSE 0 END,
      canonical_order, source_idx)),
routes AS (SELECT * REPLACE (coalesce(nullif(heading, ''), any_heading) AS heading) FROM ranked WHERE route_rank = 1),
seen AS (
  SELECT canonical_section, 0 AS kind, alone, parent_idx AS idx FROM srows WHERE family_id IN (SELECT family_id FROM smembers)
  UNION ALL SELECT canonical_section, 1, family_id IS NULL, parent_idx FROM pages_plan),
sections AS (SELECT * FROM seen QUALIFY row_number() OVER (PARTITION BY canonical_section ORDER BY kind, alone, idx) = 1),
section_positions AS (
  SELECT canonical_section, rank, CAST(row_number() OVER (ORDER BY rank, kind, alone, idx, canonical_section) AS INT) AS position FROM (
    SELECT *, CASE WHEN canonical_section = 'Uncategorized' THEN 9999
      WHEN regexp_matches(canonical_section, '^\\d') THEN CAST(regexp_extract(canonical_section, '^(\\d+)', 1) AS INT) ELSE -1 END AS rank FROM sections)),
other_section AS (
  SELECT canonical_section, locale, section AS other FROM pages_plan WHERE section <> '' AND section <> canonical_section
  QUALIFY row_number() OVER (PARTITION BY canonical_section, locale ORDER BY family_id IS NULL, parent_idx, source_idx) = 1),
section_cats0 AS (
  SELECT s.locale, s.canonical_section, {_dir('s.canonical_section')} AS section_dir, p.position,
    coalesce(a.curated, b.curated, {_label('o.other')}, {_label('s.canonical_section')}) AS label
  FROM section_locales s JOIN section_positions p USING (canonical_section)
  LEFT JOIN other_section o ON o.canonical_section = s.canonical_section AND o.locale = s.locale
  LEFT JOIN labels a ON a.locale = s.locale AND a.plain = {_label('s.canonical_section')}
  LEFT JOIN labels b ON b.locale = s.locale AND b.plain = {_label('o.other')}),
section_cats AS (
  SELECT locale, section_dir, first(label ORDER BY position) AS label, max(position) AS position,
    first(canonical_section ORDER BY position) AS canonical_section FROM section_cats0 GROUP BY ALL HAVING true),
toggle_cats AS (
  SELECT r.locale, {_dir('r.canonical_section')} AS section_dir, r.toggle_dir,
    CASE WHEN r.member_title IS NULL THEN coalesce(t.curated, {_label('r.parent_title')})
      WHEN regexp_matches(trim(r.member_title), '(…|\\.\\.\\.)$') THEN coalesce(c.curated, {_label('r.member_title')})
      ELSE r.member_title END AS label,
    r.event_order AS position, r.heading, r.event_idx
  FROM replay r LEFT JOIN labels c ON c.locale = r.locale AND c.plain = {_label('r.canonical_section')}
  LEFT JOIN labels t ON t.locale = r.locale AND t.plain = {_label('r.parent_title')} WHERE r.event = 'toggle'),
filled AS (
  SELECT t.* FROM toggle_cats t WHERE EXISTS (SELECT 1 FROM routes r WHERE r.locale = t.locale AND r.route_toggle <> ''
    AND r.route_toggle = t.toggle_dir AND {_dir('r.canonical_section')} = t.section_dir))"""
# Grouping by the two keys only; spelled out since the select list also holds aggregates.
PLAN = PLAN.replace("FROM section_cats0 GROUP BY ALL HAVING true", "FROM section_cats0 GROUP BY locale, section_dir")

ALIASES = PLAN + f""",
fam_members AS (
  SELECT family_id, child_id AS page_id FROM relations WHERE family_id IN (SELECT page_id FROM roots WHERE is_content)
  UNION SELECT page_id, page_id FROM roots WHERE is_content),
alias0 AS (
  SELECT f.canonical_slug, c.page_id, c.slug, {_slug('c.title')} AS title_slug
  FROM selected s JOIN families f ON f.family_id = s.family_id AND f.is_content
  JOIN fam_members m ON m.family_id = s.family_id AND m.page_id <> s.page_id JOIN corpus c ON c.page_id = m.page_id),
aliases AS (
  SELECT canonical_slug, {_slug('slug')} AS alias_key, page_id FROM alias0 WHERE slug <> '' AND slug <> canonical_slug
  UNION SELECT canonical_slug, title_slug, page_id FROM alias0 WHERE title_slug <> '' AND title_slug <> canonical_slug AND title_slug <> slug
  UNION SELECT f.canonical_slug, replace(s.page_id, '-', ''), s.page_id FROM selected s JOIN families f ON f.family_id = s.family_id AND f.is_content
  UNION SELECT canonical_slug, replace(page_id, '-', ''), page_id FROM pages_plan WHERE family_id IS NULL
  UNION SELECT canonical_slug, {_slug('slug')}, page_id FROM pages_plan WHERE family_id IS NULL AND slug <> canonical_slug),
published AS (
  SELECT page_id, canonical_slug FROM (
    SELECT page_id, canonical_slug, 0 AS pass FROM routes UNION ALL SELECT page_id, canonical_slug, 1 FROM aliases)
  QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY pass, canonical_slug) = 1),
slug_map AS (
  SELECT key, canonical_slug FROM (
    SELECT {_slug('c.slug')} AS key, p.canonical_slug, 1 AS pass, c.source_idx FROM corpus c JOIN published p USING (page_id)
    UNION ALL SELECT {_slug('c.title')}, p.canonical_slug, 2, c.source_idx FROM corpus c JOIN published p USING (page_id)
    UNION ALL SELECT {_slug('p.canonical_slug')}, p.canonical_slug, 3, c.source_idx FROM corpus c JOIN published p USING (page_id))
  WHERE key <> '' QUALIFY row_number() OVER (PARTITION BY key ORDER BY pass, source_idx) = 1),
id_map AS (SELECT replace(page_id, '-', '') AS key, canonical_slug FROM published),
xl AS (
  SELECT page_id, locale, target, regexp_replace(trim(target), '^https?://(www\\.)?notion\\.so', '', 'i') AS t FROM xlinks),
xl2 AS (
  SELECT *, CASE WHEN contains(t, '#') THEN substr(t, strpos(t, '#') + 1) ELSE '' END AS raw_anchor,
    regexp_replace(regexp_replace(split_part(t, '#', 1), '/+$', ''), '^/(es|pt)/', '/', 'i') AS path FROM xl),
xl3 AS (
  SELECT *, CASE WHEN regexp_matches(path, '^/docs/.+', 'i') THEN {_slug("url_decode(split_part(path, '/', -1))")} END AS slug_key,
    CASE WHEN NOT regexp_matches(path, '^/docs/.+', 'i') THEN lower(regexp_extract(path, '^/([0-9a-fA-F]{{32}})', 1)) END AS id_key,
    CASE WHEN raw_anchor <> '' THEN concat('#', replace(regexp_replace(lower(trim(raw_anchor)), '[^\\p{{L}}\\p{{M}}\\p{{N}}_\\- ]', '', 'g'), ' ', '-')) ELSE '' END AS anchor
  FROM xl2),
resolved AS (
  SELECT x.page_id, x.locale, x.target, x.t, CASE WHEN starts_with(trim(x.target), '#') THEN nullif(x.anchor, '#')
    WHEN coalesce(s.canonical_slug, i.canonical_slug) IS NOT NULL
      THEN concat(CASE WHEN x.locale IN ('es', 'pt') THEN concat('/', x.locale) ELSE '' END, '/docs/', coalesce(s.canonical_slug, i.canonical_slug), x.anchor) END AS resolved
  FROM xl3 x LEFT JOIN slug_map s ON s.key = x.slug_key LEFT JOIN id_map i ON lpad(i.key, 32, '0') = x.id_key)"""
ALIASES = ALIASES.replace(",\nfam_members AS", XLINKS[len(CORPUS):] + ",\nfam_members AS", 1)
