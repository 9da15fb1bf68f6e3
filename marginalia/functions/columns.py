"""Column expressions shared by the operators. Everything here stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def non_empty(c: Column | str) -> Column:
    """The value, or NULL when it is the empty string."""
    return F.nullif(col(c), F.lit(""))


# --- text -----------------------------------------------------------------------


def slugify(title: Column | str) -> Column:
    lowered = F.replace(F.lower(F.coalesce(col(title), F.lit(""))), F.lit("æ"), F.lit("ae"))
    folded = F.translate(lowered, fixed.ACCENTED, fixed.UNACCENTED)
    return F.trim(F.regexp_replace(folded, "[^a-z0-9]+", "-"), F.lit("-"))


def anchor_slug(text: Column | str) -> Column:
    """Heading anchor: case folded, punctuation dropped, spaces to dashes one by one."""
    kept = F.regexp_replace(F.lower(F.trim(col(text))), r"[^\p{L}\p{M}\p{N}_\- ]", "")
    return F.translate(kept, " ", "-")


def utf16_length(text: Column | str) -> Column:
    """Length in UTF-16 code units, the unit all size limits are stated in."""
    return (F.octet_length(F.encode(col(text), "UTF-16BE")) / 2).cast("int")


def token_estimate(text: Column | str) -> Column:
    """Four UTF-16 units per token, rounded up."""
    return F.ceil(F.octet_length(F.encode(col(text), "UTF-16BE")) / 8).cast("int")


def trim_space(text: Column | str) -> Column:
    """Trim every kind of leading and trailing white space, not only blanks."""
    return F.trim(col(text), F.lit(fixed.SPACE))


def has_word_character(text: Column | str) -> Column:
    return col(text).rlike(r"[\p{L}\p{N}]")


# --- identity and hashing ------------------------------------------------------------


def content_hash(text: Column | str) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(col(text).cast("binary"), 256))


def sorted_struct(fields: dict) -> Column:
    """Struct whose fields are in key order at every level; nested dicts are structs."""
    return F.struct(
        *[
            (sorted_struct(v) if isinstance(v, dict) else col(v)).alias(k)
            for k, v in sorted(fields.items())
        ]
    )


def canonical_json_hash(fields: dict) -> Column:
    """Hash of the key-sorted JSON text of ``fields``."""
    return content_hash(F.to_json(sorted_struct(fields), {"ignoreNullFields": "false"}))


def undashed(page_id: Column | str) -> Column:
    return F.replace(col(page_id), F.lit("-"), F.lit(""))


# --- editorial fields --------------------------------------------------------------------


def normalize_locale(label: Column | str) -> Column:
    lowered = F.lower(non_empty(label))
    known = F.create_map(*[F.lit(x) for kv in fixed.LOCALE_LABELS.items() for x in kv])
    return F.coalesce(F.try_element_at(known, lowered), lowered, F.lit(fixed.DEFAULT_LOCALE))


def language_provenance(label: Column | str) -> Column:
    present = non_empty(label)
    return (
        F.when(present.isNull(), "fallback")
        .when(present.rlike(fixed.AUTOMATED), "automated")
        .otherwise("explicit")
    )


def language_source(declared: Column | str, stored: Column | str, label: Column | str) -> Column:
    """First of the manifest's value, the metadata's value, the raw language label."""
    return F.coalesce(non_empty(declared), non_empty(stored), language_provenance(label))


def status_of(label: Column | str) -> Column:
    cleaned = F.lower(F.trim(col(label)))
    out = F.when(cleaned.isNull() | (cleaned == ""), "draft")
    for status, labels in fixed.STATUS_LABELS.items():
        out = out.when(cleaned.isin(labels), status)
    for status, pattern in fixed.STATUS_PATTERNS:
        out = out.when(cleaned.rlike(pattern), status)
    return out.otherwise("draft")


def is_dead(status: Column | str) -> Column:
    return col(status).isin(*fixed.DEAD_STATUSES)


def publishable(status: Column | str, include_drafts: bool = False) -> Column:
    return ~is_dead(status) if include_drafts else col(status) == "active"


def keeps_label(label: Column | str) -> Column:
    """Rows without a status stay; only the two take-down labels go."""
    return col(label).isNull() | ~col(label).isin(*fixed.DEAD_LABELS)


def is_content(element_type: Column | str) -> Column:
    return F.lower(F.coalesce(col(element_type), F.lit(""))).isin("", "page")


def is_structural(element_type: Column | str) -> Column:
    return F.lower(F.coalesce(col(element_type), F.lit(""))).isin("toggle", "title")


def element_type_text(raw: Column | str) -> Column:
    """Element type from a VARIANT: a string, a select object or a name object."""
    v = col(raw)
    return F.when(F.schema_of_variant(v) == "STRING", v.cast("string")).otherwise(
        F.coalesce(
            F.try_variant_get(v, "$.select.name", "string"),
            F.try_variant_get(v, "$.name", "string"),
            F.lit(""),
        )
    )


def property_text(raw: Column | str) -> Column:
    """Text of a property VARIANT; the order of the branches decides ties."""
    v = col(raw)
    runs = F.try_variant_get(v, "$.rich_text", "array<struct<plain_text:string>>")
    joined = F.array_join(F.transform(runs, lambda r: F.coalesce(r["plain_text"], F.lit(""))), "")
    formula = F.try_variant_get(v, "$.formula.string", "string")
    return F.coalesce(
        F.try_variant_get(v, "$.select.name", "string"),
        F.try_variant_get(v, "$.status.name", "string"),
        joined,
        formula,
        F.try_variant_get(v, "$.number", "bigint").cast("string"),
    )


def joined_runs(runs: Column | str) -> Column:
    """Plain text of an array of runs."""
    return F.array_join(F.transform(col(runs), lambda r: F.coalesce(r["plain_text"], F.lit(""))), "")


def title_text(titles: Column | str, page_id: Column | str) -> Column:
    """Title from a map of property name to runs, else the page id."""
    found = [F.try_element_at(col(titles), F.lit(name)) for name in fixed.TITLE_PROPERTIES]
    first = F.coalesce(*found)
    return F.when(F.size(first) > 0, joined_runs(first)).otherwise(col(page_id))


def names_or_default(names: Column | str, default: tuple[str, ...]) -> Column:
    kept = F.filter(col(names), lambda x: x.isNotNull() & (x != ""))
    fallback = F.array(*[F.lit(d) for d in default]).cast("array<string>")
    return F.when(F.size(kept) > 0, kept).otherwise(fallback)


def display_date(iso: Column | str) -> Column:
    return F.date_format(F.to_date(F.left(col(iso), F.lit(10))), "M/d/yyyy")


def emoji_icon(icon_type: Column | str, emoji: Column | str) -> Column:
    return F.when(col(icon_type) == "emoji", non_empty(emoji))


# --- sections ----------------------------------------------------------------------------


def section_label(section: Column | str) -> Column:
    return F.trim(F.regexp_replace(col(section), fixed.SECTION_PREFIX, ""))


def section_dir(section: Column | str) -> Column:
    words = F.replace(F.lower(section_label(section)), F.lit("&"), F.lit("and"))
    return F.regexp_replace(F.regexp_replace(words, "[^a-z0-9]+", "-"), "^-|-$", "")


def section_rank(section: Column | str) -> Column:
    s = col(section)
    digits = F.regexp_extract(s, r"^(\d+)", 1)
    return (
        F.when(s == fixed.UNCATEGORIZED, F.lit(fixed.UNCATEGORIZED_ORDER))
        .when(digits == "", F.lit(-1))
        .otherwise(digits.cast("int"))
    )


# --- titles and bodies ----------------------------------------------------------------------


def is_internal_title(title: Column | str, page_id: Column | str) -> Column:
    t = F.coalesce(col(title), F.lit(""))
    return (
        t.rlike(fixed.INTERNAL_TITLE)
        | t.rlike(fixed.INTERNAL_MARKER)
        | t.rlike(fixed.INTERNAL_NOTE)
        | (F.trim(t) == col(page_id))
    )


def is_test_title(title: Column | str) -> Column:
    return F.coalesce(col(title), F.lit("")).rlike(fixed.TEST_TITLE)


def is_staging_title(title: Column | str) -> Column:
    return F.coalesce(col(title), F.lit("")).rlike(fixed.STAGING_TITLE)


def without_header(text: Column | str) -> Column:
    return F.regexp_replace(col(text), r"(?s)\A---\n.*?\n---\n?", "")


def is_stub(text: Column | str) -> Column:
    """No content once header, spacers, rules and one placeholder marker are gone."""
    body = without_header(text)
    body = F.regexp_replace(body, fixed.SPACER, "")
    body = F.regexp_replace(body, r"(?m)^---\s*$", "")
    unmarked = F.regexp_replace(trim_space(body), r"(?s)^(.*?)" + fixed.STUB_MARKER, "$1")
    return trim_space(unmarked) == ""


# --- urls -----------------------------------------------------------------------------------


def unsigned_url(url: Column | str) -> Column:
    """Origin and path only; a text that is no URL is cut at its question mark."""
    u = col(url)
    host = F.lower(F.try_parse_url(u, F.lit("HOST")))
    path = F.try_parse_url(u, F.lit("PATH"))
    scheme = F.lower(F.try_parse_url(u, F.lit("PROTOCOL")))
    port = F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*?(:\d+)(?:[/?#]|$)", 1)
    parsed = F.concat(scheme, F.lit("://"), host, port, F.when(path == "", "/").otherwise(path))
    return F.coalesce(parsed, F.substring_index(u, "?", 1))


def is_managed_asset(url: Column | str) -> Column:
    """True for data URIs and for hosts equal to, or below, a managed host."""
    u = col(url)
    host = F.lower(F.try_parse_url(u, F.lit("HOST")))
    on_host = F.lit(False)
    for known in fixed.ASSET_HOSTS:
        on_host = on_host | (host == known) | host.endswith("." + known)
    return F.coalesce(on_host, F.lit(False)) | u.startswith("data:")


def extension_of(mime: Column | str) -> Column:
    known = F.create_map(*[F.lit(x) for kv in fixed.MIME_EXTENSIONS.items() for x in kv])
    return F.coalesce(F.try_element_at(known, col(mime)), F.lit(fixed.DEFAULT_EXTENSION))


def safe_basename(name: Column | str) -> Column:
    n = col(name)
    return n.isNotNull() & (n != "") & ~n.rlike(r"[/\\]|\.\.")


# --- artifact keys ------------------------------------------------------------------------------


def document_id(section: Column | str, slug: Column | str) -> Column:
    return F.concat_ws("/", non_empty(section), col(slug))


def document_key(locale: Column | str, section: Column | str, slug: Column | str) -> Column:
    return F.concat(
        F.concat_ws("/", F.lit("docs"), col(locale), F.lit("docs"), non_empty(section), col(slug)),
        F.lit(".md"),
    )


def page_key(page_id: Column | str, leaf: str) -> Column:
    return F.concat(F.lit("pages/"), col(page_id), F.lit("/" + leaf))


def route_path(section: Column | str, toggle: Column | str, slug: Column | str) -> Column:
    """Section folder (none for the root), toggle folder, slug."""
    folder = F.when(col(section) != fixed.UNCATEGORIZED, section_dir(section))
    return F.concat_ws("/", folder, non_empty(toggle), col(slug))


# --- header lines ---------------------------------------------------------------------------------


def yaml_scalar(value: Column | str) -> Column:
    """Quote a text holding characters that mean something in YAML."""
    v = col(value)
    risky = v.rlike("[&:\\[\\]{}|>*!%@`#\"'-]|^\\s")
    return F.when(
        risky, F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('\\"')), F.lit('"'))
    ).otherwise(v)
