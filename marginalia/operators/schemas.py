"""Schemas of stored JSON as data, and the path of everything in a record that breaks them.

A record is a VARIANT, so what it holds is seen as it is: a number where a text belongs is a
fault, not a cast. All checks of a record are one expression over its own row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.folds import bound

NUMBERS = ("BIGINT", "DOUBLE", "DECIMAL", "FLOAT")
FAULT = "array<struct<path:string,problem:string>>"


@dataclass(frozen=True)
class Rule:
    """What a value must be: ``text``, ``number``, ``flag``, ``record`` (of ``fields``), ``list`` or ``map`` (of ``items``), or
    ``either`` (the first of ``fields`` whose kind fits)."""

    kind: str
    among: tuple[str, ...] = ()
    fields: tuple[tuple[str, "Rule"], ...] = field(default=())
    items: "Rule | None" = None
    optional: bool = False
    nullable: bool = False


def text(*among: str, optional: bool = False, nullable: bool = False) -> Rule:
    return Rule("text", among, optional=optional, nullable=nullable)


def record(optional: bool = False, **fields: Rule) -> Rule:
    return Rule("record", fields=tuple(fields.items()), optional=optional)


def list_of(items: Rule, optional: bool = False) -> Rule:
    return Rule("list", items=items, optional=optional)


def sidebar_item(levels: int) -> Rule:
    """A page's id, or a category of items; categories in each other down to ``levels``."""
    own = dict(type=text("category"), label=text(), collapsible=Rule("flag", optional=True), collapsed=Rule("flag", optional=True), key=text(optional=True))
    link = record(optional=True, type=text(), title=text(optional=True))
    inside = list_of(sidebar_item(levels - 1) if levels else text())
    return Rule("either", fields=(("page", text()), ("category", record(**own, link=link, items=inside))))


# The stored records.
CHUNK = record(
    chunk_id=text(), page_id=text(), title=text(), locale=text(), slug=text(), heading_path=list_of(text()), text=text(), source_url=text(),
    docusaurus_path=text(), content_hash=text(), status=text("active"),
)
CHUNKS_MANIFEST = record(schema_version=text("1.0"), generated_at=text(), chunks=list_of(CHUNK))
DOCUMENT = record(
    page_id=text(), title=text(), locale=text(), section=text(nullable=True), section_order=Rule("number", nullable=True), element_type=text(nullable=True),
    drafting_status=text(nullable=True), slug=text(), docusaurus_id=text(), docusaurus_path=text(), r2_doc_key=text(), r2_metadata_key=text(), source_url=text(),
    notion_last_edited_time=text(), content_hash=text(), status=text(*fixed.STATUSES), sub_items=list_of(text(), optional=True),
    language_source=text(*fixed.LANGUAGE_SOURCES, optional=True),
)
MANIFEST = record(
    schema_version=text("1.0"), generated_at=text(), source=record(type=text("notion"), database_id=text(), data_source_id=text()), docs=list_of(DOCUMENT),
    sidebars=Rule("map", items=list_of(sidebar_item(2))), rag=record(optional=True, chunks_manifest_key=text()),
)


def _is(v: Column, kind: str) -> Column:
    own = F.schema_of_variant(v)
    if kind == "text":
        return own == "STRING"
    if kind == "number":
        out = F.lit(False)
        for n in NUMBERS:
            out = out | own.startswith(n)
        return out
    return {"flag": own == "BOOLEAN", "list": own.startswith("ARRAY"), "record": own.startswith("OBJECT"), "map": own.startswith("OBJECT")}[kind]


def faults(value: Column, rule: Rule, path: Column) -> Column:
    """``path, problem`` of everything in the variant ``value`` that breaks ``rule``; ``path`` leads to it."""
    return _faults(value, rule, path) if rule.kind in ("text", "number", "flag") else bound(value, lambda v: _faults(v, rule, path))


def _faults(v: Column, rule: Rule, path: Column) -> Column:
    none = F.array().cast(FAULT)
    one = lambda problem: F.array(F.struct(path.alias("path"), F.lit(problem).alias("problem")))
    if rule.kind == "either":
        held = F.lit(False)
        chosen = one("no known form")
        for _, form in reversed(rule.fields):
            chosen = F.when(_is(v, form.kind), _faults(v, form, path)).otherwise(chosen)
        inner, fits = chosen, ~held
    else:
        fits = _is(v, rule.kind)
        inner = none
    if rule.among:
        inner = F.when(F.variant_get(v, "$", "string").isin(*rule.among), none).otherwise(one("is none of the known values"))
    elif rule.kind == "record":
        parts = [faults(F.try_variant_get(v, f"$.{name}", "variant"), own, F.concat(path, F.lit(f".{name}"))) for name, own in rule.fields]
        inner = F.concat(*parts)
    elif rule.kind == "list":
        inner = F.flatten(F.transform(F.variant_get(v, "$", "array<variant>"), lambda x, i: faults(x, rule.items, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")))))
    elif rule.kind == "map":
        entries = F.map_entries(F.variant_get(v, "$", "map<string,variant>"))
        inner = F.flatten(F.transform(entries, lambda e: faults(e["value"], rule.items, F.concat(path, F.lit("."), e["key"]))))
    present = F.when(F.is_variant_null(v), none if rule.nullable else one(f"is no {rule.kind}")).when(~fits, one(f"is no {rule.kind}")).otherwise(inner)
    return F.when(v.isNull(), none if rule.optional else one("is missing")).otherwise(present)


def violations(records: DataFrame, rule: Rule, key: str, json: str) -> DataFrame:
    """``key, path, problem``: one row per fault of each JSON text. A text that is no JSON has one fault."""
    parsed = F.try_parse_json(F.coalesce(json, F.lit("")))
    unread = F.array(F.struct(F.lit("$").alias("path"), F.lit("is no JSON").alias("problem")))
    rows = records.select(key, parsed.alias("v")).select(key, F.when(F.col("v").isNull(), unread).otherwise(faults(F.col("v"), rule, F.lit("$"))).alias("f"))
    return rows.select(key, F.inline("f"))
