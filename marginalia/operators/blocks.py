"""Block trees: nesting, rendering, tables and the census of types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..functions import columns as C
from ..functions import fixed
from ..functions.lineage import written

LIST_ITEMS = ("bulleted_list_item", "numbered_list_item")
INDENT = "  "  # of a list item inside another one
AFTER = "~"  # sorts behind every place in a path
NESTED_ROWS = 100_000  # nested blocks, without their texts, in a task of a level

# Line prefix per block type; anything not listed renders as plain text or a note.
PREFIX = {
    "heading_1": "# ",
    "heading_2": "## ",
    "heading_3": "### ",
    "bulleted_list_item": "- ",
    "numbered_list_item": "1. ",
    "quote": "> ",
    "user": "",
    "assistant": "",
    "paragraph": "",
}


def is_supported(kind: Column | str, extra: tuple[str, ...] = ()) -> Column:
    return C.col(kind).isin(*fixed.SUPPORTED_BLOCKS, *extra)


# Types without a text of their own; what is nested in them still shows.
SILENT = (
    "child_database", "breadcrumb", "table_of_contents", "table_row", "synced_block", "column_list", "column",
    "unsupported", "ai_block",
)


def _own_form(kind: Column, text: Column, checked: Column, language: Column) -> Column:
    """Types whose form is more than a prefix; NULL for all others."""
    mark = F.when(F.coalesce(checked, F.lit(False)), "[x]").otherwise("[ ]")
    return (
        F.when(kind == "to_do", F.concat(F.lit("- "), mark, F.lit(" "), text))
        .when(kind == "code", F.concat(F.lit("```"), F.coalesce(language, F.lit("")), F.lit("\n"), text, F.lit("\n```")))
        .when(kind == "divider", F.lit("\n---"))
        .when(kind == "toggle", F.concat(F.lit("<details>\n<summary>"), text, F.lit("</summary>\n")))
        .when(kind == "equation", F.when(text == "", "").otherwise(F.concat(F.lit("$$"), text, F.lit("$$"))))
        .when(kind == "child_page", F.concat(F.lit("📄 "), F.when(text == "", "child page").otherwise(text)))
        .when(kind.isin(*SILENT), "")
    )


def block_text(
    kind: Column, text: Column, extra: tuple[str, ...] = (), checked: Column | None = None, language: Column | None = None
) -> Column:
    """A block's own text. ``checked`` of to-dos and ``language`` of code may be given."""
    prefix = F.create_map(*[F.lit(x) for kv in PREFIX.items() for x in kv])
    text = F.coalesce(text, F.lit(""))
    none = F.lit(None)
    own = _own_form(kind, text, none.cast("boolean") if checked is None else checked, none.cast("string") if language is None else language)
    note = F.concat(F.lit("> [!NOTE]\n> Unsupported Notion block: `"), kind, F.lit("`"))
    plain = F.concat(F.coalesce(F.try_element_at(prefix, kind), F.lit("")), text)
    return F.when(is_supported(kind, extra), F.coalesce(own, plain)).otherwise(note)


def _in_context(rendered: Column, kind: Column, nest: Column, quote: Column) -> Column:
    """A block's text where it stands: list items indented, every line behind the quotes it is in."""
    indented = F.when(kind.isin(*LIST_ITEMS), F.concat(F.repeat(F.lit(INDENT), nest), rendered)).otherwise(rendered)
    return F.when((quote == "") | (rendered == ""), indented).otherwise(F.concat(quote, F.replace(indented, F.lit("\n"), F.concat(F.lit("\n"), quote))))


def block_rollup(blocks: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Document text of block trees as ordered rows.

    Every block becomes one row with its depth and a sortable path of positions, found
    level by level from the roots until a level is empty. What a block's place asks for is
    carried down the levels: a list item in a list item is indented once more, whatever stands
    in a quote has its mark on every line, and a toggle has a second row behind all that is
    in it, which closes it. A block whose parent is not there is kept as a root of its own and
    marked ``orphan``. Reading a page's rows in path order gives its text; no page is gathered
    into one task. Blocks that hang on each other in a ring have no root: they stop the run,
    none is dropped.

    Levels are found without the texts, which join their places once, at the end. Nested
    blocks are shuffled once, to where their parents will come, and stay there: a level moves
    only the places of the level above. So every block is moved a fixed number of times,
    however deep the trees; only paths grow with the depth. Each level is written out, so that
    lineage does not grow with it.
    """
    here = F.concat(F.lpad(F.col("pos").cast("string"), 19, "0"), F.lit("."), F.col("block_id").cast("string"))
    shaped = blocks.select(
        F.monotonically_increasing_id().alias("__id"), "page_id", "block_id", "parent_id", "type", here.alias("here"),
        block_text(
            F.col("type"), F.col("text"), extra,
            F.col("checked") if "checked" in blocks.columns else None, F.col("language") if "language" in blocks.columns else None,
        ).alias("rendered"),
    )
    shaped = written(shaped, "blocks", "zstd")
    known = shaped.select(F.col("page_id").alias("__page"), F.col("block_id").alias("__block"), F.col("__id").alias("__up"))
    hung = shaped.join(known, (F.col("page_id") == F.col("__page")) & (F.col("parent_id") == F.col("__block")), "left")
    orphan = F.col("parent_id").isNotNull() & F.col("__up").isNull()
    hung = written(hung.select("__id", "__up", "here", "type", orphan.alias("orphan")), "hung")
    cols = ["__id", "depth", "path", "type", "orphan", "nest", "quote"]
    first = {"depth": F.lit(0), "path": F.col("here"), "nest": F.lit(0), "quote": F.lit("")}
    level, out, depth = written(hung.filter("__up IS NULL").withColumns(first).select(*cols), "level-0"), None, 0
    nested = hung.filter("__up IS NOT NULL").repartition(hung.count() // NESTED_ROWS + 1, "__up").sortWithinPartitions("__up").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        nested.count()  # Once it is kept, joins find it in place.
        while not level.isEmpty():
            out = level if out is None else out.unionByName(level)
            depth += 1
            # Only an item right below an item is nested; any other block begins lists anew.
            below = F.when(F.col("type").isin(*LIST_ITEMS), F.col("nest") + 1).otherwise(0)
            marked = F.when(F.col("type") == "quote", F.concat("quote", F.lit("> "))).otherwise(F.col("quote"))
            above = level.select(F.col("__id").alias("__up"), F.col("path").alias("above"), below.alias("nest"), marked.alias("quote"))
            path = F.concat_ws("/", "above", "here")
            # By merge, as the nested blocks already lie in the order of their parents; paths are too long to broadcast.
            level = written(nested.join(above.hint("merge"), "__up").withColumns({"depth": F.lit(depth), "path": path}).select(*cols), f"level-{depth}")
        out = level if out is None else out
        # Blocks are counted, not places: below a repeated block a block has several.
        if ring := shaped.count() - out.select("__id").distinct().count():
            raise ValueError(f"{ring} blocks hang on each other in a ring")
        places = out.withColumn("close", F.lit(None).cast("string"))
        parents = nested.select(F.col("__up").alias("__id")).distinct().withColumn("__full", F.lit(True))
        ends = places.filter("type = 'toggle'").join(parents, "__id", "left")
        close = F.when(F.col("__full"), "\n</details>").otherwise("</details>")
        ends = ends.withColumns({"depth": F.col("depth") + 1, "path": F.concat_ws("/", "path", F.lit(AFTER)), "close": close}).drop("__full")
        texts = shaped.select("__id", "page_id", "block_id", "rendered")
        rows = places.unionByName(ends).join(texts, "__id").withColumn("rendered", F.coalesce("close", "rendered"))
        placed_text = _in_context(F.col("rendered"), F.col("type"), F.col("nest"), F.col("quote"))
        return written(rows.select("page_id", "block_id", "depth", "path", "type", placed_text.alias("rendered"), "orphan"), "rolled", "zstd")
    finally:
        nested.unpersist()


def assemble_documents(rows: DataFrame, part_chars: int = 4_000_000) -> DataFrame:
    """Document texts from the rows of ``block_rollup``.

    A page of up to ``part_chars`` characters, as any ordinary one, is one part, part 0, and
    its texts are shuffled once. The rows of longer pages are ranged by page and path, and
    lengths are summed within each range and, one number a range, over the ranges of a page;
    so no task grows with a page. Such a page's text is cut into parts wherever ``part_chars``
    characters have come together, counted along the path; ``last`` marks a page's last part.
    Joining the parts of a page in order, without anything between them, gives its text.
    Top-level blocks are set apart by an empty line, nested ones follow on the next line.
    """
    spaced = F.concat(F.when(F.col("depth") == 0, "\n\n").otherwise("\n"), F.col("rendered"))
    texts = rows.filter("rendered <> ''").select("page_id", "path", spaced.alias("text"))
    size = F.length("text").cast("bigint")
    body = F.expr("listagg(text, '') WITHIN GROUP (ORDER BY path)")
    # One row for every part_chars characters at most: few enough to broadcast.
    long_pages = F.broadcast(written(texts.groupBy("page_id").agg(F.sum(size).alias("n")).filter(F.col("n") > part_chars).select("page_id"), "long-pages"))
    ordinary = texts.join(long_pages, "page_id", "left_anti").groupBy("page_id").agg(body.alias("body"))
    ordinary = ordinary.select("page_id", F.lit(0).cast("bigint").alias("part"), "body", F.lit(True).alias("last"))
    ranged = texts.join(long_pages, "page_id", "left_semi").repartitionByRange("page_id", "path").withColumn("__range", F.spark_partition_id())
    ranged = written(ranged, "ranged", "zstd")
    sums = ranged.groupBy("page_id", "__range").agg(F.sum(size).alias("n"), F.max("path").alias("last"))
    over_ranges = Window.partitionBy("page_id").orderBy("__range")
    earlier = F.coalesce(F.sum("n").over(over_ranges.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begins = sums.select("page_id", "__range", earlier.alias("__earlier"), F.when(F.lead("last").over(over_ranges).isNull(), F.col("last")).alias("__end"))
    inside = F.sum(size).over(Window.partitionBy("page_id", "__range").orderBy("path").rowsBetween(Window.unboundedPreceding, -1))
    placed = ranged.withColumn("__inside", F.coalesce(inside, F.lit(0))).join(begins, ["page_id", "__range"])
    before, last = F.col("__earlier") + F.col("__inside"), F.coalesce(F.col("path") == F.col("__end"), F.lit(False))
    parts = placed.select("page_id", F.floor(before / part_chars).alias("part"), "path", "text", last.alias("last"))
    gathered = ordinary.unionByName(parts.groupBy("page_id", "part").agg(body.alias("body"), F.max("last").alias("last")))
    opened = F.when(F.col("part") == 0, F.ltrim("body", F.lit("\n"))).otherwise(F.col("body"))
    return gathered.select("page_id", "part", F.concat(opened, F.when(F.col("last"), "\n").otherwise("")).alias("body"), "last")


def type_census(blocks: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    counted = blocks.groupBy("type").agg(F.count(F.lit(1)).alias("blocks"))
    return counted.withColumn("supported", is_supported("type", extra))


def plain_text(runs: Column, caption: Column) -> Column:
    """Text of the runs, or of the caption when a block has no runs."""
    return F.when(F.size(runs) > 0, C.joined_runs(runs)).otherwise(F.coalesce(C.joined_runs(caption), F.lit("")))


# --- inline runs ---------------------------------------------------------------------


def _marked(segment: Column, run: Column) -> Column:
    """Markers around one line of a run, white space kept outside. Blank segments and
    plain punctuation carry no markers."""
    lead = F.regexp_extract(segment, r"^(\s*)", 1)
    core = F.regexp_replace(segment, r"^\s+|\s+$", "")
    trail = F.regexp_extract(segment, r"(\s*)$", 1)
    worded = C.has_word_character(segment) | run["code"]

    def around(text: Column, flag: str, before: str, after: str) -> Column:
        return F.when(run[flag] & worded, F.concat(F.lit(before), text, F.lit(after))).otherwise(text)

    body = core
    for flag, before, after in [
        ("bold", "**", "**"), ("italic", "*", "*"), ("strikethrough", "~~", "~~"),
        ("underline", "<u>", "</u>"), ("code", "`", "`"),
    ]:
        body = around(body, flag, before, after)
    tinted = (
        run["color"].isNotNull() & (run["color"] != "") & (run["color"] != "default") & ~run["color"].endswith("_background")
    )
    span = lambda t: F.concat(F.lit('<span style={{color:"'), run["color"], F.lit('"}}>'), t, F.lit("</span>"))
    # Colored punctuation keeps its white space inside the span.
    return (
        F.when(core == "", segment)
        .when(~worded, F.when(tinted, span(segment)).otherwise(segment))
        .otherwise(F.concat(lead, F.when(tinted, span(body)).otherwise(body), trail))
    )


# --- fixed value: how an inline emoji image is written -------------------------------
EMOJI_STYLE = 'className="emoji" style={{display:"inline",height:"1.2em",width:"auto",verticalAlign:"text-bottom",margin:"0 0.1em"}} />'


def emoji_image(url: Column, name: Column) -> Column:
    named = F.replace(F.coalesce(F.nullif(name, F.lit("")), F.lit("emoji")), F.lit('"'), F.lit("&quot;"))
    return F.concat(F.lit('<img src="'), url, F.lit('" alt="'), named, F.lit('" '), F.lit(EMOJI_STYLE))


def render_runs(runs: Column, mentions: bool = False) -> Column:
    """Inline runs to text. Markers open and close on the same line; a link wraps the
    plain text of its run, except in code. With ``mentions``, runs have ``emoji_url`` and
    ``emoji_name``, and those with a URL become an inline image."""
    def render(r: Column) -> Column:
        return F.when(F.coalesce(r["emoji_url"], F.lit("")) != "", emoji_image(r["emoji_url"], r["emoji_name"])).otherwise(worded(r)) if mentions else worded(r)

    def worded(r: Column) -> Column:
        text = F.coalesce(r["plain_text"], F.lit(""))
        styled = F.array_join(F.transform(F.split(text, "\n"), lambda s: _marked(s, r)), "\n")
        core = F.regexp_replace(text, r"^\s+|\s+$", "")
        link = F.concat(
            F.regexp_extract(text, r"^(\s*)", 1), F.lit("["), core, F.lit("]("), r["href"], F.lit(")"),
            F.regexp_extract(text, r"(\s*)\z", 1),
        )
        linked = r["href"].isNotNull() & (r["href"] != "") & ~r["code"]
        return F.when(linked & (core != ""), link).when(linked, text).otherwise(styled)

    return F.array_join(F.transform(runs, render), "")


# --- tables --------------------------------------------------------------------------------


def table_lines(rows: DataFrame, table: str, row_no: str, cells: list[str]) -> DataFrame:
    """Markdown lines of tables stored as rows: the first row of a table is followed by
    the separator. One row in gives its own lines out, so no table is gathered."""
    clean = lambda c: F.replace(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit("\n"), F.lit("<br />"))
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *[clean(c) for c in cells]), F.lit(" |"))
    separator = "| " + " | ".join(["---"] * len(cells)) + " |"
    lines = rows.select(table, F.col(row_no).alias("row_no"), F.lit(0).alias("part"), line.alias("line"))
    # A separator behind the first row, or each of them where several share its number. Only
    # table and number are shuffled, never the cells.
    sizes = rows.groupBy(table, F.col(row_no).alias("row_no")).agg(F.count(F.lit(1)).cast("int").alias("n"))
    first = sizes.groupBy(table).agg(F.min(F.struct("row_no", "n")).alias("f"))
    return lines.unionByName(
        first.select(table, "f.row_no", F.lit(1).alias("part"), F.explode(F.array_repeat(F.lit(separator), F.col("f.n"))).alias("line"))
    )
