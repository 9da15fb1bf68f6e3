"""Retrieval chunks: sections, coalescing, packing, size repair, overlap.

The whole chain works inside the document's row, in the JVM, and shuffles nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import fixed
from ..functions import lines as L
from ..functions.folds import bound, running_sum, scan, where
from ..functions.rows import array_rows

def _units(text: Column) -> Column:
    return C.utf16_length(text)


def _tokens_of(units: Column) -> Column:
    return F.ceil(units / 4).cast("int")


def coalesce_sections(sections: Column) -> Column:
    """Drop sections without a letter or digit, then let a section take in the next one
    while it is under the minimum and the sum stays within the maximum."""
    real = F.filter(sections, lambda s: C.has_word_character(s["text"]))
    sized = F.transform(
        real, lambda s: F.struct(s["path"].alias("path"), s["text"].alias("text"), _units(s["text"]).alias("n"))
    )

    def step(a: Column, s: Column) -> Column:
        have, more = _tokens_of(a["n"]), _tokens_of(s["n"])
        fits = a["n"].isNotNull() & (have < fixed.CHUNK_MIN) & (have + more <= fixed.CHUNK_MAX)
        return F.struct(F.when(fits, a["n"] + 2 + s["n"]).otherwise(s["n"]).cast("int").alias("n"), (~F.coalesce(fits, F.lit(False))).alias("new"))

    zero = F.struct(F.lit(None).cast("int").alias("n"), F.lit(False).alias("new"))

    def merged(own: Column) -> Column:
        seen = scan(own, zero, step, lambda a, _: a, "struct<n:int,new:boolean>")
        return bound(seen, lambda m: F.transform(_runs(F.transform(m, lambda x: x["new"])), lambda r: F.struct(
            F.get(own, r["first"])["path"].alias("path"),
            F.array_join(F.transform(F.slice(own, r["first"] + 1, r["n"]), lambda s: s["text"]), "\n\n").alias("text"),
            _tokens_of(F.get(m, r["first"] + r["n"] - 1)["n"]).alias("tokens"),
        )))

    return bound(sized, merged)


def _runs(begins: Column) -> Column:
    """Runs of elements as (first, n); the first element always begins one."""
    return bound(
        where(begins),
        lambda w: F.transform(w, lambda i, k: F.struct(i.alias("first"), (F.coalesce(F.get(w, k + 1), F.size(begins)) - i).alias("n"))),
    )


def pack(units: Column) -> Column:
    """Pack paragraphs in order into pieces of at most the maximum; a larger paragraph
    makes a piece of its own."""
    def step(a: Column, t: Column) -> Column:
        full = a["n"].isNull() | (a["n"] + t > fixed.CHUNK_MAX)
        return F.struct(F.when(full, t).otherwise(a["n"] + t).cast("int").alias("n"), full.alias("new"))

    zero = F.struct(F.lit(None).cast("int").alias("n"), F.lit(False).alias("new"))

    def cut(own: Column) -> Column:
        new = scan(F.transform(own, C.token_estimate), zero, step, lambda a, _: a["new"], "boolean")
        return F.transform(bound(new, _runs), lambda r: F.slice(own, r["first"] + 1, r["n"]))

    return bound(units, cut)


def piece_tokens(piece: Column) -> Column:
    return C.token_estimate(F.array_join(piece, "\n\n"))


def needs_repair(pieces: Column) -> Column:
    return (F.size(pieces) > 1) & F.exists(pieces, lambda p: piece_tokens(p) < fixed.CHUNK_MIN)


# --- size repair ----------------------------------------------------------------------------

# Paragraphs of the piece before the one at hand, of that one, and of a piece that is settled.
_SPANS = "struct<pa:int,pb:int,ca:int,cb:int,oa:int,ob:int>"


def _spans(pa, pb, ca, cb, oa=None, ob=None) -> Column:
    named = {"pa": pa, "pb": pb, "ca": ca, "cb": cb, "oa": oa, "ob": ob}
    return F.struct(*(F.lit(v).cast("int").alias(k) for k, v in named.items()))


def _pass(spans: Column, sizes: Column, estimates: Column) -> Column:
    """One pass of size repair over pieces given as spans of paragraphs.

    ``sizes`` and ``estimates`` are running sums over the paragraphs, so that any span is measured
    by two looks. A piece under the minimum joins the piece before it, else the one after it, when
    the two fit; else it shares paragraphs with the larger of them, at the most even border that
    leaves both sides large enough; else it stays. Each element read settles at most one piece, so
    a pass is one scan, with two empty elements at its end to settle the last two.
    """
    upto = lambda sums, i: F.coalesce(F.get(sums, i), F.lit(0))
    between = lambda sums, a, b: upto(sums, b) - upto(sums, a - 1)
    tokens = lambda a, b: _tokens_of(between(sizes, a, b) + 2 * (b - a))

    def border(a: Column, b: Column) -> Column:
        """Last paragraph of the first side, at the first of the most even borders."""
        gap = lambda k: F.abs(2 * between(estimates, a, k) - between(estimates, a, b))
        return F.array_min(F.transform(F.sequence(a, b - 1), lambda k: F.struct(gap(k).alias("gap"), k.alias("k"))))["k"]

    def step(s: Column, x: Column) -> Column:
        pa, pb, ca, cb, xa, xb = s["pa"], s["pb"], s["ca"], s["cb"], x["a"], x["b"]
        small = ca.isNotNull() & (tokens(ca, cb) < fixed.CHUNK_MIN)
        fits = lambda a, b, side: side.isNotNull() & (tokens(a, b) <= fixed.CHUNK_MERGE_MAX)
        following = xa.isNotNull() & (pa.isNull() | (tokens(xa, xb) >= tokens(pa, pb)))
        first, last = F.when(following, ca).otherwise(pa), F.when(following, xb).otherwise(cb)
        several = F.when(following, xb > xa).otherwise(pb > pa)
        enough = several & (between(estimates, first, last) >= 2 * fixed.CHUNK_MIN)
        shared = F.when(enough, bound(border(first, last), lambda k: F.when(F.least(tokens(first, k), tokens(k + 1, last)) >= fixed.CHUNK_MIN, k)))
        go_on = _spans(ca, cb, xa, xb, pa, pb)

        def share(k: Column) -> Column:
            ahead = _spans(ca, k, k + 1, xb, pa, pb)
            behind = _spans(k + 1, cb, xa, xb, pa, k)
            return F.when(k.isNull(), go_on).when(following, ahead).otherwise(behind)

        return (
            F.when(~small, go_on)
            .when(fits(pa, cb, pa), _spans(pa, cb, xa, xb))
            .when(fits(ca, xb, xa), _spans(pa, pb, ca, xb))
            .otherwise(bound(shared, share))
        )

    none = F.struct(F.lit(None).cast("int").alias("a"), F.lit(None).cast("int").alias("b"))
    settled = scan(
        F.concat(spans, F.array(none, none)), _spans(None, None, None, None), step,
        lambda s, _: F.struct(s["oa"].alias("a"), s["ob"].alias("b")), "struct<a:int,b:int>",
    )
    return F.filter(settled, lambda o: o["a"].isNotNull())


def _measured(pieces: Column) -> Column:
    """Of pieces in need of repair their paragraphs, running sums over them, and the pieces as spans."""

    def spans(counts: Column) -> Column:
        return F.zip_with(running_sum(counts), counts, lambda end, n: F.struct((end - n).alias("a"), (end - 1).alias("b")))

    texts = F.flatten(pieces)
    fields = F.struct(
        texts.alias("texts"), running_sum(F.transform(texts, _units)).alias("size"),
        running_sum(F.transform(texts, C.token_estimate)).alias("estimate"), spans(F.transform(pieces, F.size)).alias("spans"),
    )
    return F.when(needs_repair(pieces), fields)


def with_repair(df: DataFrame, packed: str, out: str) -> DataFrame:
    """Bring pieces under the minimum up to size, in two passes, in every section of ``packed``.

    Most sections need no repair and keep their packing. Each step is a column of its own: nested
    in one expression, the steps are too deep to be analyzed.
    """
    once = lambda m: F.when(m.isNotNull(), _pass(m["spans"], m["size"], m["estimate"]))
    twice = lambda m, i: F.when(m.isNotNull(), _pass(F.get("__once", i), m["size"], m["estimate"]))

    def pieces(p: Column, i: Column) -> Column:
        texts = F.get("__measured", i)["texts"]
        cut = F.transform(F.get("__twice", i), lambda s: F.slice(texts, s["a"] + 1, s["b"] - s["a"] + 1))
        return F.coalesce(cut, p)

    steps = df.withColumn("__measured", F.transform(packed, _measured))
    steps = steps.withColumn("__once", F.transform("__measured", once)).withColumn("__twice", F.transform("__measured", twice))
    return steps.withColumn(out, F.transform(packed, pieces)).drop("__measured", "__once", "__twice")


# --- overlap ------------------------------------------------------------------------------


def last_units(text: Column, n: Column) -> Column:
    """The end of a text in UTF-16 code units, as token estimates count them; a pair whose
    first half falls outside is left out."""
    coded = F.encode(text, "UTF-16BE")
    size = F.least(n, (F.octet_length(coded) / 2).cast("int"))
    tail = F.substring(coded, F.octet_length(coded) - 2 * size + 1, 2 * size)
    half = F.hex(F.substring(tail, F.lit(1), F.lit(1))).between("DC", "DF")
    return F.decode(F.when(half, F.substring(tail, F.lit(3), 2 * size - 2)).otherwise(tail), "UTF-16BE")


def tail_overlap(units: Column) -> Column:
    """Text carried over from the end of a piece: whole paragraphs up to the maximum,
    topped up with the end of the paragraph before when short. Fences and tables are
    never cut; a tail that is one such unit over the maximum is not carried at all."""
    backwards = F.reverse(units)

    def step(a: Column, u: Column) -> Column:
        t = C.token_estimate(u)
        take = a["open"] & (a["tokens"] + t <= fixed.OVERLAP_MAX)
        return F.struct(
            F.when(take, a["tokens"] + t).otherwise(a["tokens"]).alias("tokens"),
            F.when(take, a["n"] + 1).otherwise(a["n"]).alias("n"),
            take.alias("open"),
        )

    zero = F.struct(F.lit(0).alias("tokens"), F.lit(0).alias("n"), F.lit(True).alias("open"))

    def finish(a: Column) -> Column:
        n = a["n"]
        whole = F.slice(units, F.size(units) - n + 1, n)
        before = F.try_element_at(backwards, n + 1)
        atomic = before.startswith(L.FENCE) | before.startswith("|")
        short = (a["tokens"] < fixed.OVERLAP_FLOOR) & before.isNotNull() & ~atomic
        cut = last_units(before, (fixed.OVERLAP_TARGET - a["tokens"]) * 4)
        joined = F.array_join(F.when(short, F.concat(F.array(cut), whole)).otherwise(whole), "\n\n")
        return F.when(
            n == 0, F.when(atomic, "").otherwise(last_units(before, F.lit(fixed.OVERLAP_TARGET * 4)))
        ).otherwise(joined)

    return F.aggregate(backwards, zero, step, finish)


def overlapped(pieces: Column) -> Column:
    """Texts of the pieces, each but the first led by the tail of the one before."""
    def text(p: Column, i: Column) -> Column:
        lead = F.when(i > 0, tail_overlap(F.try_element_at(pieces, i)))
        body = F.array_join(p, "\n\n")
        return F.when(F.coalesce(lead, F.lit("")) == "", body).otherwise(F.concat(lead, F.lit("\n\n"), body))

    return F.transform(pieces, text)


# --- the chain ---------------------------------------------------------------------------------


def page_sections(docs: DataFrame, lines: str = "lines") -> DataFrame:
    """One row per coalesced section with its number in the document."""
    keep = [c for c in docs.columns if c != lines]
    packed = docs.withColumn("__s", coalesce_sections(L.sections(lines)))
    return array_rows(packed, keep, "__s", "section_no", "s").select(
        *keep, "section_no", F.col("s.path").alias("heading_path"), F.col("s.text").alias("text"), "s.tokens"
    )


def packed_text(text: Column, tokens: Column) -> Column:
    """Packing of a section over the maximum; NULL for a section that is one chunk."""
    return F.when(tokens > fixed.CHUNK_MAX, pack(L.paragraph_units(F.split(text, "\n"))))


def section_pieces(sections: DataFrame) -> DataFrame:
    """Add ``packed`` and ``pieces``, the packing before and after size repair."""
    packed = sections.withColumn("packed", packed_text(F.col("text"), F.col("tokens")))
    repaired = with_repair(packed.withColumn("__p", F.array("packed")), "__p", "__r")
    return repaired.withColumn("pieces", F.col("__r")[0]).drop("__p", "__r")


def chunk_texts(text: Column, pieces: Column) -> Column:
    """Texts of a section's chunks: its overlapped pieces, or the section itself."""
    return F.when(pieces.isNotNull(), F.transform(overlapped(pieces), C.trim_space)).otherwise(F.array(C.trim_space(text)))


def chunk_rows(docs: DataFrame, key: str = "page_id", content_hash: str = "content_hash") -> DataFrame:
    """All chunks of all documents: chunk id, index per page, heading path and text.

    ``docs`` holds ``lines`` and the columns to carry. The index runs over the sections
    of a page in order, so everything stays in the page's row until the last step.
    """
    keep = [c for c in docs.columns if c != "lines"]
    cut = docs.select(*keep, coalesce_sections(L.sections("lines")).alias("__s"))
    cut = with_repair(cut.withColumn("__p", F.transform("__s", lambda s: packed_text(s["text"], s["tokens"]))), "__p", "__r")
    texts = F.transform(
        "__s",
        lambda s, i: F.transform(
            chunk_texts(s["text"], F.get("__r", i)),
            lambda t: F.struct(s["path"].alias("path"), t.alias("text")),
        ),
    )
    rows = array_rows(cut, keep, F.flatten(texts), "chunk_index", "c")
    identity = F.concat_ws(":", key, content_hash, F.array_join("c.path", "/"), F.col("chunk_index").cast("string"))
    return rows.select(
        C.content_hash(identity).alias("chunk_id"),
        *keep,
        "chunk_index",
        F.col("c.path").alias("heading_path"),
        F.col("c.text").alias("text"),
    )


def chunkable_pages(docs: DataFrame, include_drafts: bool = False) -> DataFrame:
    """Published content pages; titles and toggles carry labels only."""
    return docs.filter(C.publishable("status", include_drafts) & ~C.is_structural("element_type"))


def attach_bodies(pages: DataFrame, bodies: DataFrame) -> DataFrame:
    """Body by page id, else the body filed under the page's slug; pages without either
    drop out. ``bodies`` has key (unique) and body.

    Which key a page uses is settled on keys alone, so bodies move through one join.
    """
    filed = bodies.select(F.col("key").alias("page_id"), F.lit(True).alias("__filed"))
    keyed = pages.join(filed, "page_id", "left").withColumn(
        "key", F.when(F.col("__filed"), F.col("page_id")).otherwise(F.col("slug"))
    )
    return keyed.drop("__filed").join(bodies.select("key", "body"), "key").drop("key")


def chunk_stats(pages: DataFrame, chunks: DataFrame) -> DataFrame:
    """Per locale of ``pages`` its pages and those without any chunk; chunk count, median and share of small chunks.

    Each page counts its own chunks first, so that no locale's chunks meet in one task but as numbers.
    """
    sized = chunks.groupBy("page_id", C.token_estimate("text").alias("tokens")).agg(F.count("*").alias("n"))
    joined = pages.join(sized, "page_id", "left")
    held = F.col("tokens").isNotNull()
    per_size = joined.groupBy("locale", "tokens").agg(F.sum("n").alias("n"), F.count("*").alias("rows"))
    per_page = pages.join(chunks.select("page_id").distinct().withColumn("has", F.lit(True)), "page_id", "left")
    counted = per_page.groupBy("locale").agg(F.count("*").alias("pages"), F.count_if(F.col("has").isNull()).alias("pages_without_chunks"))
    small = F.coalesce(F.sum(F.when(F.col("tokens") < 50, F.col("n"))), F.lit(0))
    total = F.coalesce(F.sum("n"), F.lit(0))
    stats = per_size.filter(held).groupBy("locale").agg(
        total.alias("chunks"), F.expr("percentile(tokens, 0.5, n)").alias("median_tokens"), small.alias("small"), F.round(small / total, 6).alias("small_share")
    )
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    stats = stats.withColumnRenamed("locale", "of")
    return counted.join(stats, counted["locale"].eqNullSafe(stats["of"]), "left").select("locale", "pages", zero("chunks"), "median_tokens", zero("small"), "small_share", "pages_without_chunks")
