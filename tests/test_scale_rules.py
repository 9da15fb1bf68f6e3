"""Depth, orphans, growth of the line folds and overlap in code units."""

import time

import pytest
from pyspark.sql import functions as F

from marginalia.functions import folds
from marginalia.functions import lines as L
from marginalia.operators import blocks as B
from marginalia.operators import chunks as K


def block(i, parent, page=1, text=None):
    return (page, f"b{i}", None if parent is None else f"b{parent}", i, "paragraph", text or f"t{i}")


SCHEMA = "page_id long, block_id string, parent_id string, pos long, type string, text string"


def test_deep_trees_and_orphans_are_whole(spark):
    rows = [block(0, None)] + [block(i, i - 1) for i in range(1, 15)] + [block(40, 39)]
    got = B.block_rollup(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 16 and max(r.depth for r in got) == 14
    assert [(r.block_id, r.depth) for r in got if r.orphan] == [("b40", 0)]
    none = B.block_rollup(spark.createDataFrame([], SCHEMA))
    assert none.count() == 0 and B.assemble_documents(none).count() == 0


def test_rings_fail_instead_of_vanishing(spark):
    df = spark.createDataFrame([block(0, None), block(1, 2), block(2, 1)], SCHEMA)
    with pytest.raises(ValueError, match="2 blocks"):
        B.block_rollup(df)


def test_parts_join_to_the_text(spark):
    rows = [block(i, None if i % 5 == 0 else i - i % 5, text="x" * 30) for i in range(40)]
    tree = B.block_rollup(spark.createDataFrame(rows, SCHEMA))
    whole = B.assemble_documents(tree).collect()
    cut = sorted(B.assemble_documents(tree, part_chars=100).collect(), key=lambda r: r.part)
    assert len(whole) == 1 and len(cut) > 5
    assert "".join(r.body for r in cut) == whole[0].body


def test_scan_runs_over_block_borders(spark):
    for n in (0, 1, 255, 256, 257, 1000):
        values = F.when(F.lit(n) > 0, F.sequence(F.lit(1), F.lit(max(n, 1)))).otherwise(F.array().cast("array<int>"))
        got = spark.range(1).select(folds.running_sum(values).alias("s")).first().s
        assert got == [i * (i + 1) // 2 for i in range(1, n + 1)]


def test_line_folds_grow_with_the_lines(spark):
    def seconds(n):
        text = "\n".join(f"## h{i}\ntext {i}" for i in range(n))
        df = spark.createDataFrame([(text,)], "text string").select(F.split("text", "\n").alias("lines")).cache()
        df.count()
        start = time.perf_counter()
        assert df.select(F.size(L.sections())).first()[0] == n
        return time.perf_counter() - start

    seconds(500)
    assert seconds(32_000) < 8 * seconds(8_000) + 2


def test_overlap_stays_within_its_bounds_on_astral_text(spark):
    text = "🌱" * 4000
    got = spark.range(1).select(K.last_units(F.lit(text), F.lit(400)).alias("even"), K.last_units(F.lit(text + "x"), F.lit(400)).alias("odd"), K.last_units(F.lit("ab"), F.lit(400)).alias("short")).first()
    units = lambda s: len(s.encode("utf-16-le")) // 2
    assert units(got.even) == 400 and got.even == "🌱" * 200
    assert units(got.odd) == 399 and got.odd == "🌱" * 199 + "x"
    assert got.short == "ab"


def test_forms_of_blocks(spark):
    kinds = [
        ("to_do", "task", True, None, "- [x] task"), ("to_do", "task", None, None, "- [ ] task"), ("code", "a\nb", None, "py", "```py\na\nb\n```"),
        ("divider", None, None, None, "\n---"), ("equation", "x^2", None, None, "$$x^2$$"), ("equation", "", None, None, ""), ("child_page", "Title", None, None, "📄 Title"),
        ("child_page", None, None, None, "📄 child page"), ("breadcrumb", "x", None, None, ""), ("child_database", "x", None, None, ""), ("quote", "q", None, None, "> q"),
        ("odd", "x", None, None, "> [!NOTE]\n> Unsupported Notion block: `odd`"),
    ]
    rows = [(1, str(i), None, i, k, t, c, lang) for i, (k, t, c, lang, _) in enumerate(kinds)]
    df = spark.createDataFrame(rows, SCHEMA + ", checked boolean, language string")
    got = {int(r.block_id): r.rendered for r in B.block_rollup(df).collect()}
    assert got == {i: k[-1] for i, k in enumerate(kinds)}


def test_emoji_mentions(spark):
    fields = ["plain_text", "bold", "italic", "strikethrough", "underline", "code", "color", "href", "emoji_url", "emoji_name"]
    base = {"plain_text": "hi ", "bold": True, "italic": False, "strikethrough": False, "underline": False, "code": False, "color": "default", "href": "", "emoji_url": "", "emoji_name": ""}
    make = lambda **k: F.struct(*[F.lit((base | k)[f]).alias(f) for f in fields])
    out = spark.range(1).select(B.render_runs(F.array(make(), make(plain_text=":p:", emoji_url="https://x.org/p.png", emoji_name='p"q')), mentions=True).alias("t")).first().t
    assert out == '**hi** <img src="https://x.org/p.png" alt="p&quot;q" className="emoji" style={{display:"inline",height:"1.2em",width:"auto",verticalAlign:"text-bottom",margin:"0 0.1em"}} />'
