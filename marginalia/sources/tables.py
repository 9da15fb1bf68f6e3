"""Input tables and the content views derived from them.

Every view is a lazy DataFrame over the given Parquet tables. Timestamps are read as
plain TIMESTAMP, so that streaming watermarks accept them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.rows import array_rows

CUTOFF = "2024-01-15 00:00:00"
# The cutoff with the lookback of a minute taken off.
LOOKED_BACK = "2024-01-14 23:59:00"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table, a single file or a folder of files, read as its files split."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    for field in df.schema.fields:
        if field.dataType.simpleString() == "timestamp_ntz":
            df = df.withColumn(field.name, F.col(field.name).cast("timestamp"))
    return df


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Page metadata with body: families of four, three locales, editorial fields."""
    d = table(spark, folder, "documents")
    m = lambda n: F.col("doc_id") % n
    d = d.select(
        "doc_id",
        F.col("doc_id").alias("source_idx"),
        F.col("doc_id").cast("string").alias("page_id"),
        (F.col("doc_id") - m(4)).cast("string").alias("family_id"),
        F.when(m(4) < 2, "en").when(m(4) == 2, "es").otherwise("pt").alias("locale"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.when(
            m(11) != 0,
            F.concat(
                (10 * (1 + F.substr("source", F.lit(4)).cast("int") % 6)).cast("string"),
                F.lit("-"), "source", F.lit(" & more"),
            ),
        ).alias("section"),
        F.when(m(5) != 0, m(37).cast("int")).alias("section_order"),
        F.when(m(15) == 13, "Title").when(m(15) == 14, "Toggle").otherwise("Page").alias("element_type"),
        F.expr(
            "CASE doc_id % 17 WHEN 0 THEN 'Published' WHEN 1 THEN 'Remove' WHEN 2 THEN 'Unplublished' "
            "WHEN 3 THEN NULL WHEN 4 THEN 'EN Done' WHEN 5 THEN 'Ready to publish' "
            "WHEN 6 THEN 'Not started' ELSE 'Draft published' END"
        ).alias("publish_status"),
        F.when(m(3) == 0, "explicit").when(m(3) == 1, "automated").otherwise("fallback").alias("language_source"),
        F.expr(
            "CASE WHEN doc_id % 4 = 0 AND doc_id % 28 <> 0 "
            "THEN transform(array(1, 2, 3), i -> CAST(doc_id + i AS STRING)) "
            "WHEN doc_id % 20 = 1 THEN array(CAST(doc_id + 1 AS STRING)) "
            "ELSE CAST(array() AS array<string>) END"
        ).alias("sub_items"),
        F.col("text").alias("body"),
    )
    return d.withColumns(
        {
            "has_body": F.length("body") > 200,
            "slug": C.slugify("title"),
            "status": C.status_of("publish_status"),
        }
    )


def pages_meta(spark: SparkSession, folder: str) -> DataFrame:
    """The corpus without bodies, the input of all hierarchy operators."""
    return corpus(spark, folder).drop("body", "family_id", "doc_id")


# Decorates lines by position so that prose gains headings, fences and table rows.
DECORATED = """
    transform(split(text, '\\n'), (line, i) -> CASE
        WHEN i % 12 = 0 THEN concat('## ', line)
        WHEN i % 12 = 5 THEN concat('### ', line)
        WHEN i % 12 IN (7, 9) THEN concat('```', line)
        WHEN i % 12 IN (10, 11) THEN concat('| ', line, ' |')
        ELSE line END)
"""


def md_docs(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document with its decorated lines as an array."""
    d = table(spark, folder, "documents")
    return d.select("doc_id", F.expr(DECORATED).alias("lines"))


def md_lines(spark: SparkSession, folder: str) -> DataFrame:
    d = md_docs(spark, folder)
    return array_rows(d, ["doc_id"], "lines", "line_no", "line")


def sync_events(spark: SparkSession, folder: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """Change feed: one row per event, minute-granular edit time, fingerprint k.

    ``since`` (inclusive) and ``until`` (exclusive) must be whole minutes. They are set on
    the stored column, before it is cut to minutes, so they reach the Parquet scan.
    """
    e = spark.read.parquet(f"{folder}/events.parquet")
    stored = e.schema["ts"].dataType
    if since:
        e = e.filter(F.col("ts") >= F.lit(since).cast(stored))
    if until:
        e = e.filter(F.col("ts") < F.lit(until).cast(stored))
    return shape_events(e)


def shape_events(e: DataFrame) -> DataFrame:
    return e.select(
        "event_id",
        F.col("user_id").alias("page_id"),
        F.date_trunc("minute", F.col("ts").cast("timestamp")).alias("edited_at"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.expr(
            "CASE event_type WHEN 'signup' THEN 'page.created' WHEN 'purchase' THEN 'database.updated' "
            "WHEN 'error' THEN 'failed' ELSE 'page.updated' END"
        ).alias("kind"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )


def _latest(events: DataFrame) -> DataFrame:
    newest = F.max_by(F.struct("edited_at", "k"), F.struct("edited_at", "event_id")).alias("s")
    return events.groupBy("page_id").agg(newest).select("page_id", "s.edited_at", "s.k")


def stored_state(spark: SparkSession, folder: str) -> DataFrame:
    return _latest(sync_events(spark, folder, until=CUTOFF))


def changed_feed(spark: SparkSession, folder: str) -> DataFrame:
    return _latest(sync_events(spark, folder, since=LOOKED_BACK))


def blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns as a block tree: an answer hangs under the turn it answers.

    An assistant turn's parent is the nearest earlier user turn; a turn's block id is
    its conversation and number.
    """
    from ..functions.ordered import block_of, latest_before

    c = table(spark, folder, "conversations")
    hung = latest_before(
        c,
        ["conv_id"],
        [block_of("turn")],
        ["turn"],
        {"asked": (F.struct("turn"), F.col("role") == "user")},
    )
    return hung.select(
        F.col("conv_id").alias("page_id"),
        F.concat_ws("-", "conv_id", "turn").alias("block_id"),
        F.when((F.col("role") == "assistant") & F.col("asked.turn").isNotNull(), F.concat_ws("-", "conv_id", "asked.turn")).alias("parent_id"),
        F.col("turn").alias("pos"),
        F.col("role").alias("type"),
        "text",
    )


def hrefs(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "pages")
    found = F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1)
    return array_rows(p, ["page_id"], found, "ord", "href")


def asset_refs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select("page_id", "url")


def xlinks(spark: SparkSession, folder: str) -> DataFrame:
    """One link per page, of five shapes, mostly to the following page."""
    c = corpus(spark, folder).select("doc_id", "page_id", "locale")
    t = corpus(spark, folder).select(
        (F.col("doc_id") - 1).alias("doc_id"), F.col("page_id").alias("t_page"), F.col("slug").alias("t_slug")
    )
    j = c.join(t, "doc_id")
    target = F.expr(
        "CASE doc_id % 5 WHEN 0 THEN concat('/docs/', t_slug) WHEN 1 THEN concat('/es/docs/', t_slug, '/') "
        "WHEN 2 THEN concat('https://www.notion.so/', lpad(t_page, 32, '0')) "
        "WHEN 3 THEN concat('/docs/unknown-', page_id, '#Some Anchor') ELSE '#Some Anchor' END"
    )
    return j.select("page_id", "locale", target.alias("target"))


def image_slots(spark: SparkSession, folder: str) -> DataFrame:
    c = corpus(spark, folder).select(
        "doc_id", "page_id", "family_id", "locale", F.explode(F.expr("sequence(0, CAST(doc_id % 4 AS INT))")).alias("ord")
    )
    return c.select(
        "page_id",
        "family_id",
        "locale",
        "ord",
        F.when((F.col("doc_id") + F.col("ord")) % 3 == 0, "placeholder").otherwise("real").alias("kind"),
        F.concat(F.lit("assets/"), "page_id", F.lit("-"), F.col("ord").cast("string"), F.lit(".png")).alias("name"),
    )
