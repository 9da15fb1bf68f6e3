"""Line-structure expressions over a document's array of lines.

A document is one row, so its fences, headings and paragraphs are found inside the row:
no line leaves its task, nothing is shuffled. Ordered state (open fences, open headings) comes
from scans that are linear in the lines; they keep positions, and texts are cut at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import col, trim_space
from .folds import bound, running_sum, scan, where

FENCE = "```"
_HEADING = r"^(#{1,6})\s+(.+)"

# Expressions below are SQL texts over a column named `lines`; callers that use another
# name pass it in. They are written as SQL because folds over structs read better so.


def _sql(text: str, lines: str) -> Column:
    return F.expr(text.replace("$lines", lines).replace("$fence", FENCE))


def _open_before(is_fence: str, lines: str) -> Column:
    """For every line whether a fence is open before it: an odd number of fences so far."""
    marks = _sql(f"transform($lines, l -> if({is_fence}, 1, 0))", lines)
    return bound(marks, lambda m: F.zip_with(running_sum(m), m, lambda s, f: (s - f) % 2 == 1))


def fence_open(lines: str = "lines") -> Column:
    """For every line whether a code fence is open before it (array of booleans)."""
    return _open_before("startswith(l, '$fence')", lines)


# A fence that may be indented or made of tildes.
_ANY_FENCE = r"(l rlike '^\\s*(```|~~~)')"


def in_code(lines: str = "lines") -> Column:
    """For every line whether it is a fence of any kind or lies inside one."""
    before = _open_before(_ANY_FENCE, lines)
    return F.zip_with(before, col(lines), lambda o, l: o | l.rlike(r"^\s*(```|~~~)"))


def clean_heading(raw: Column) -> Column:
    """A heading's title: no tags, no emphasis, single blanks; an image-only heading is
    named by the image's alt text."""
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(raw, "<[^>]+>", " "), "[*][*]|`", ""), r"\s+", " ")
    return F.coalesce(F.nullif(F.trim(plain), F.lit("")), F.regexp_extract(raw, 'alt="([^"]*)"', 1))


_STACK = "array<struct<level:int,title:string>>"


def section_spans(lines: str = "lines") -> Column:
    """Spans between headings: array of (path, first line, line count), in order.

    Only headings are scanned for their open ancestors; all other lines are merely counted.
    """
    # The prefix test spares most lines the pattern.
    marked = F.zip_with(fence_open(lines), col(lines), lambda o, l: ~o & l.startswith("#") & l.rlike(r"^#{1,6}\s+.+"))
    at = lambda i: F.get(col(lines), i)
    named = F.transform(where(marked), lambda i: F.struct(i.alias("i"), at(i).alias("l")))
    heads = F.transform(named, lambda h: F.struct(h["i"].alias("i"), *_heading_parts(h["l"])))

    def push(stack: Column, h: Column) -> Column:
        above = F.filter(stack, lambda x: x["level"] < h["level"])
        return F.concat(above, F.array(F.struct(h["level"].alias("level"), h["title"].alias("title"))))

    def emit(stack: Column, h: Column) -> Column:
        return F.struct(F.transform(stack, lambda x: x["title"]).alias("path"), h["i"].alias("first"))

    opened = scan(heads, F.array().cast(_STACK), push, emit, "struct<path:array<string>,first:int>")
    lead = F.struct(F.array().cast("array<string>").alias("path"), F.lit(0).alias("first"))
    total = F.size(col(lines))
    return bound(
        F.concat(F.array(lead), opened),
        lambda o: F.transform(
            o,
            lambda s, k: F.struct(s["path"].alias("path"), s["first"].alias("first"), (F.coalesce(F.get(o, k + 1)["first"], total) - s["first"]).alias("n")),
        ),
    )


def _heading_parts(line: Column) -> list[Column]:
    """Level and title of a heading line."""
    level = F.length(F.regexp_extract(line, r"^(#{1,6})\s+(.+)", 1))
    raw = F.trim(F.regexp_extract(line, r"^(#{1,6})\s+(.+)", 2))
    return [level.alias("level"), clean_heading(raw).alias("title")]


def heading_stacks(lines: str = "lines") -> Column:
    """For every line the titles of the open headings, a heading line included in its
    own path (array of arrays of text)."""
    return F.flatten(F.transform(section_spans(lines), lambda s: F.array_repeat(s["path"], s["n"])))


def sections(lines: str = "lines") -> Column:
    """Sections as array of (path, text); only a document's empty lead has no section."""
    spans = section_spans(lines)
    cut = F.transform(
        spans,
        lambda s: F.struct(
            s["path"].alias("path"),
            trim_space(F.array_join(F.slice(col(lines), s["first"] + 1, s["n"]), "\n")).alias("text"),
        ),
    )
    return F.filter(cut, lambda s: (s["text"] != "") | (F.size(s["path"]) > 0))


def paragraph_units(lines: Column) -> Column:
    """Paragraphs as array of text; a fenced block or a run of table lines is one unit.

    Every line gets a kind (0 none, 1 prose, 2 table, 3 code). A unit begins where the kind
    changes, or at the fence that opens a block, and ends before the next beginning or gap.
    """
    return bound(lines, _units_of)


def _units_of(lines: Column) -> Column:
    def kinds(marks: Column) -> Column:
        before = F.zip_with(running_sum(marks), marks, lambda s, f: (s - f) % 2 == 1)
        typed = F.zip_with(
            before, lines,
            lambda o, l: F.when(o | l.startswith(FENCE), 3).when(trim_space(l) == "", 0).when(l.startswith("|"), 2).otherwise(1),
        )
        return F.zip_with(typed, before, lambda k, o: F.struct(k.alias("k"), o.alias("inside")))

    def begins(rows: Column, i: Column) -> Column:
        now, last = F.get(rows, i), F.coalesce(F.get(rows, i - 1)["k"], F.lit(0))
        return F.when(now["k"] == 3, ~now["inside"]).otherwise((now["k"] != 0) & (now["k"] != last))

    def spans(rows: Column) -> Column:
        index = F.transform(rows, lambda _, i: i)
        first = F.filter(index, lambda i: begins(rows, i))
        last = F.filter(index, lambda i: (F.get(rows, i)["k"] != 0) & ((F.coalesce(F.get(rows, i + 1)["k"], F.lit(0)) == 0) | begins(rows, i + 1)))
        return F.zip_with(first, last, lambda a, b: F.array_join(F.slice(lines, a + 1, b - a + 1), "\n"))

    marks = F.transform(lines, lambda l: F.when(l.startswith(FENCE), 1).otherwise(0))
    units = bound(bound(marks, kinds), spans)
    return F.filter(units, lambda t: trim_space(t) != "")
