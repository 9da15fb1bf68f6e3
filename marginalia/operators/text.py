"""Cleaning and repair of document texts, one document per row, nothing shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed
from ..functions import lines as L
from ..functions.folds import bound
from ..functions.rows import array_rows

# Code that no rule may touch, and JSX style objects which must keep their braces.
_KEPT = r"```[\s\S]*?```|`[^`\n]*`|style=\{\{[^{}]*\}\}"
_EMOJI_STYLE = r"(?=[^{}]*display:)(?=[^{}]*height:)(?=[^{}]*margin:)"
_MARK = "\u0001"
_FOLD = "\u0002"


# --- rules over the lines of a document -----------------------------------------------


def break_after_bold(lines: Column) -> Column:
    """An empty line after a line that is only bold text and is followed by text."""
    def fixed_line(l: Column, i: Column) -> Column:
        following = F.try_element_at(lines, i + 2)
        alone = l.contains("**") & F.trim(l).rlike(r"^\s*\*\*[^*].*\*\*\s*$")
        return F.when(alone & F.coalesce(C.trim_space(following) != "", F.lit(False)), F.concat(l, F.lit("\n"))).otherwise(l)

    return F.transform(lines, fixed_line)


def fix_headings(text: Column) -> Column:
    """The first top heading stays, later ones drop one level, empty headings vanish.

    A closed code block is folded into one line first, and such lines are left alone.
    """
    parts = F.split(F.regexp_replace(text, r"(```[\s\S]*?```)", f"{_MARK}$1{_MARK}"), _MARK)
    folded = F.transform(parts, lambda p, i: F.when(i % 2 == 1, F.replace(p, F.lit("\n"), F.lit(_FOLD))).otherwise(p))
    lines = F.split(F.when(text.contains("```"), F.array_join(folded, "")).otherwise(text), "\n")
    top, code = r"^\s{0,3}#(?!#)\s*\S", "```.*```"
    first = F.array_position(F.transform(lines, lambda l: l.contains("#") & l.rlike(top) & ~l.rlike(code)), F.lit(True))

    def fixed_line(l: Column, i: Column) -> Column:
        demoted = F.concat(
            F.regexp_extract(l, r"^(\s{0,3})#", 1), F.lit("## "), F.trim(F.regexp_extract(l, r"^\s{0,3}#\s*(.*)$", 1))
        )
        return (
            F.when(~l.contains("#") | l.rlike(code), l)
            .when(l.rlike(r"^\s{0,3}#{1,6}\s*$"), "")
            .when(l.rlike(top) & (i + 1 != first), demoted)
            .otherwise(l)
        )

    fixed = F.replace(F.array_join(F.transform(lines, fixed_line), "\n"), F.lit(_FOLD), F.lit("\n"))
    return F.when(text.contains("#"), fixed).otherwise(text)


# --- rules over the text of a document ---------------------------------------------------


def _unwrap(text: Column, inner: str, passes: int) -> Column:
    """At most ``passes`` passes; one that changes nothing is the last."""
    pattern = rf"({_KEPT})|\{{(?!{_EMOJI_STYLE}){inner}\}}"
    pair = lambda t, more: F.struct(t.alias("t"), more.alias("more"))

    def once(s: Column, _: Column) -> Column:
        new = bound(F.regexp_replace(s["t"], pattern, "$1$2"), lambda n: pair(n, n != s["t"]))
        return F.when(s["more"], new).otherwise(s)

    unwrapped = F.aggregate(F.sequence(F.lit(1), F.lit(passes)), pair(text, F.lit(True)), once, lambda s: s["t"])
    return F.when(text.contains("{") & text.contains("}"), unwrapped).otherwise(text)


def strip_braces(text: Column) -> Column:
    """Unwrap braces outside code, from the inside out; style objects are kept."""
    return _unwrap(text, r"\s*([^{}]*?)\s*", 5)


def strip_left_braces(text: Column) -> Column:
    """Unwrap what is left or has come up since, white space included."""
    return _unwrap(text, r"([^{}]*)", 3)


def _outside_code(text: Column, rule) -> Column:
    parts = F.split(F.regexp_replace(text, f"({_KEPT})", f"{_MARK}$1{_MARK}"), _MARK)
    return F.array_join(F.transform(parts, lambda p, i: F.when(i % 2 == 1, p).otherwise(rule(p))), "")


def fix_tags(text: Column) -> Column:
    """Malformed link and other tags become plain links."""
    def rule(p: Column) -> Column:
        p = F.regexp_replace(p, r"(?i)<link\s+to\s+section\.?>", "[link to section](#section)")
        p = F.regexp_replace(p, r"<link\s+[^>]*[^\w\s\"=-][^>]*>", "[link](#)")
        p = F.regexp_replace(p, r"<Link\s+[^>]*[^\w\s\"=-][^>]*>", "[Link](#)")
        dotted = r"[^>.\s]*\s*\.[.\s]*[^>]*"
        spaced = r"[^>.\s=]*\s* \s*[^>]*"
        broken = rf"<(?!(?i:img)\s[^>]*className=\"emoji\")([a-zA-Z][a-zA-Z0-9]*)\s+(?:{dotted}|{spaced})>"
        # One pass marks them all; each is then replaced where it stands.
        pieces = F.split(F.regexp_replace(p, f"({broken})", f"{_FOLD}$1{_FOLD}"), _FOLD)
        tag = lambda m: F.regexp_extract(m, "^<([a-zA-Z0-9]+)", 1)
        link = lambda m: F.concat(F.lit("["), tag(m), F.lit("](#"), F.lower(tag(m)), F.lit(")"))
        return F.array_join(F.transform(pieces, lambda m, i: F.when(i % 2 == 1, link(m)).otherwise(m)), "")

    return F.when(text.contains("<"), _outside_code(text, lambda p: F.when(p.contains("<"), rule(p)).otherwise(p))).otherwise(text)


def collapse_blank_lines(text: Column) -> Column:
    return F.regexp_replace(text, "\n{3,}", "\n\n")


def clean_images(text: Column) -> Column:
    """Images without a usable URL go, white space inside image URLs goes."""
    kept = F.regexp_replace(text, r"(?i)!\[[^\]]*\]\((?:undefined|null)\)", "")
    kept = F.regexp_replace(kept, r"!\[[^\]]*\]\(\s*\)", "")
    spaced = F.array_distinct(F.regexp_extract_all(kept, F.lit(r"!\[[^\]]*\]\([^)]*\s[^)]*\)"), 0))
    url = lambda m: F.regexp_extract(m, r"\]\(([^)]+)\)$", 1)
    tight = lambda m: F.concat(
        F.regexp_extract(m, r"^(!\[[^\]]*\]\()", 1), F.regexp_replace(url(m), r"\s+", ""), F.lit(")")
    )
    tightened = F.aggregate(spaced, kept, lambda t, m: F.replace(t, m, tight(m)))
    return collapse_blank_lines(F.when(text.contains("!["), tightened).otherwise(text))


def drop_image_notes(text: Column) -> Column:
    note = r"(?m)^[ \t]*(?:\*\*)?[ \t]*\[[ \t]*[Ii]mage:[ \t]*[^\]]*\][ \t]*(?:\*\*)?[ \t]*\r?$"
    return collapse_blank_lines(F.when(text.contains("mage:"), F.regexp_replace(text, note, "")).otherwise(text))


_SPACER_TAG = '<div class="notion-spacer" aria-hidden="true" role="presentation"></div>'
_RULE = r"---[^\n]*(?:\n\s*|\z)"
_DECOR = (
    rf"\s*(?:{_RULE})*(?:{_SPACER_TAG}\s*(?:{_RULE})*)*"
    rf"(?:!\[[^\n]*(?:\n\s*|\z)(?:{_SPACER_TAG}\s*)*)*"
)
_LEAD = rf"(?s)\A({_DECOR})# ([^\n]*)(?:\n+|\z)"


def drop_duplicate_title(text: Column, title: Column) -> Column:
    """Drop a first heading equal to, holding or held by the title; what decorates the
    start (rules, spacers, images) stays."""
    heading = F.trim(F.regexp_extract(text, _LEAD, 2))
    same = (heading == title) | title.contains(heading) | heading.contains(title)
    return F.when(text.rlike(_LEAD) & (title != "") & same, F.regexp_replace(text, _LEAD, "$1")).otherwise(text)


CLEANING = ["bold_breaks", "headings", "braces", "tags", "images", "image_notes", "titles"]


def clean_corpus(docs: DataFrame) -> DataFrame:
    """Apply all rules in order to ``text`` and mark which rules changed a document.

    Adds ``cleaned`` and one boolean per rule. Needs columns text and title.
    """
    df = docs.withColumn("__t0", F.array_join(break_after_bold(F.split("text", "\n")), "\n"))
    steps = [
        ("__t1", lambda: fix_headings(F.col("__t0"))),
        ("__t2", lambda: strip_braces(F.col("__t1"))),
        ("__t3", lambda: strip_left_braces(fix_tags(F.col("__t2")))),
        ("__t4", lambda: clean_images(F.col("__t3"))),
        ("__t5", lambda: drop_image_notes(F.col("__t4"))),
        ("__t6", lambda: drop_duplicate_title(F.col("__t5"), F.col("title"))),
    ]
    for name, step in steps:
        df = df.withColumn(name, step())
    before = ["text", "__t0", "__t1", "__t2", "__t3", "__t4", "__t5"]
    changed = {
        rule: F.col(before[i]) != F.col(f"__t{i}") for i, rule in enumerate(CLEANING)
    }
    return df.select(*docs.columns, F.col("__t6").alias("cleaned"), *[c.alias(r) for r, c in changed.items()])


def rule_counts(cleaned: DataFrame) -> DataFrame:
    """Documents changed per rule, counted map-side."""
    flags = F.array(*[F.when(F.col(r), F.lit(r)) for r in CLEANING])
    hits = cleaned.select(F.explode(F.filter(flags, lambda f: f.isNotNull())).alias("rule"))
    return hits.groupBy("rule").agg(F.count(F.lit(1)).alias("documents"))


def style_hazards(docs: DataFrame, key: str = "doc_id", lines: str = "lines") -> DataFrame:
    """Lines outside code holding a style attribute that is no object."""
    code = L.in_code(lines)
    rows = array_rows(docs, [key], F.arrays_zip(F.col(lines).alias("line"), code.alias("code")), "i", "r")
    shown = F.regexp_replace("r.line", "`[^`]*`", " ")
    bad = ~F.col("r.code") & shown.rlike(r"(?<![A-Za-z0-9_])style=(?!\{\{)")
    # The snippet shows the masked line, code spans blanked at their length.
    return rows.filter(bad).select(
        key,
        (F.col("i") + 1).alias("line"),
        F.lit("string-or-bare-style").alias("kind"),
        F.left(C.trim_space(_blank_spans(F.col("r.line"))), F.lit(120)).alias("snippet"),
    )


def _blank_spans(line: Column) -> Column:
    spans = F.regexp_extract_all(line, F.lit("`[^`]*`"), 0)
    return F.aggregate(spans, line, lambda t, s: F.replace(t, s, F.repeat(F.lit(" "), F.length(s))))


def emit_body(body: Column, locale: Column) -> Column:
    """Placeholder lines and one closing rule removed; an empty English body gets a notice."""
    marker = r"(?im)^[ \t]*\[\s*(?:insert|add)\s+content\s+here\s*\][ \t]*(?:\r?\n|\r|\z)"
    kept = F.regexp_replace(F.regexp_replace(body, marker, ""), r"\n*---\n*\z", "\n")
    return F.when(C.is_stub(kept) & (locale == "en"), fixed.EMPTY_BODY_NOTICE + "\n").otherwise(kept)


def emit_pages(routes: DataFrame, bodies: DataFrame) -> DataFrame:
    """Bodies as published: own body, English body for a stub translation, or skipped.

    ``bodies`` has one row per page. English bodies are joined only to the stub
    translations that may use them.
    """
    own = routes.join(bodies, "page_id", "left")
    own = own.withColumn("body", emit_body(F.col("body"), F.col("locale")))
    stub = (F.col("locale") != "en") & F.coalesce(C.is_stub("body"), F.lit(False))
    own = own.withColumn("__stub", stub).withColumn(
        "__wanted", F.when(F.col("__stub"), F.col("en_fallback_id"))
    )
    english = bodies.select(F.col("page_id").alias("__wanted"), F.col("body").alias("__en"))
    out = own.join(english, "__wanted", "left")
    usable = F.coalesce(~C.is_stub("__en"), F.lit(False))
    outcome = (
        F.when(F.col("body").isNull(), "missing")
        .when(~F.col("__stub"), "published")
        .when(usable, "fallback")
        .otherwise("skipped")
    )
    text = F.when(outcome == "published", F.col("body")).when(outcome == "fallback", F.col("__en"))
    return out.withColumns({"outcome": outcome, "body": text}).drop("__en", "__wanted", "__stub")


def emit_counters(emitted: DataFrame) -> DataFrame:
    n = lambda o: F.count_if(F.col("outcome") == o)
    return emitted.groupBy("locale").agg(
        n("published").alias("published"), n("fallback").alias("fallbacks"),
        n("skipped").alias("skipped"), n("missing").alias("missing"),
    )
