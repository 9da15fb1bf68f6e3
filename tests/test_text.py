import pytest
from pyspark.sql import functions as F

from marginalia.functions import columns as C
from marginalia.operators import assets as A
from marginalia.operators import blocks as B
from marginalia.operators import links as K
from marginalia.operators import text as X


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "title, slug",
    [("Olá, Mundo!", "ola-mundo"), ("Æther & Ñandú", "aether-nandu"), ("--a  b--", "a-b"), ("日本", ""), ("A_B.c", "a-b-c")],
)
def test_slugify(spark, title, slug):
    assert one(spark, C.slugify(F.lit(title))) == slug


@pytest.mark.parametrize(
    "label, status",
    [("Remove", "deprecated"), ("UNPLUBLISHED", "archived"), ("EN Done", "active"), ("X - Depreciated", "deprecated"),
     ("page deleted", "archived"), (" Draft published ", "active"), ("", "draft"), (None, "draft"), ("whatever", "draft"), ("unpublished now", "archived")],
)
def test_status(spark, label, status):
    assert one(spark, C.status_of(F.lit(label).cast("string"))) == status


@pytest.mark.parametrize(
    "body, stub",
    [("", True), ("---\na: b\n---\n", True), ("\n---\n \n", True), ("[ ADD content here ]", True), ("[insert content here] but more", False),
     ('<div class="notion-spacer" x></div>\n', True), ("text", False), ("[insert content here][insert content here]", False)],
)
def test_stub(spark, body, stub):
    assert one(spark, C.is_stub(F.lit(body))) is stub


@pytest.mark.parametrize(
    "url, plain",
    [("https://A.b/c/d.png?x=1#y", "https://a.b/c/d.png"), ("https://a.b", "https://a.b/"), ("no url?x=1", "no url"), ("https://a.b:81/p?q", "https://a.b:81/p")],
)
def test_unsigned_url(spark, url, plain):
    assert one(spark, C.unsigned_url(F.lit(url))) == plain


@pytest.mark.parametrize(
    "raw, cleaned",
    [
        ("{a {b} c}", "a b c"),
        ("`{keep}` {x}", "`{keep}` x"),
        ("```\n{keep}\n``` { x }", "```\n{keep}\n``` x"),
        ('<span style={{color:"red"}}>{x}</span>', '<span style={{color:"red"}}>x</span>'),
    ],
)
def test_braces(spark, raw, cleaned):
    assert one(spark, X.strip_braces(F.lit(raw))) == cleaned


@pytest.mark.parametrize(
    "raw, cleaned",
    [
        ("see <link to section.> x", "see [link to section](#section) x"),
        ("<Foo a.b> y", "[Foo](#foo) y"),
        ("<b> y", "<b> y"),
        ('<img src="a.png" className="emoji" /> y', '<img src="a.png" className="emoji" /> y'),
        ("`<Foo a.b>` y", "`<Foo a.b>` y"),
    ],
)
def test_tags(spark, raw, cleaned):
    assert one(spark, X.fix_tags(F.lit(raw))) == cleaned


@pytest.mark.parametrize(
    "raw, cleaned",
    [
        ("# A\n# B\n##\n### C", "# A\n## B\n\n### C"),
        ("```\n# x\n```\n# A\n#B", "```\n# x\n```\n# A\n## B"),
        ("```\n# open\n# second", "```\n# open\n## second"),
    ],
)
def test_headings(spark, raw, cleaned):
    assert one(spark, X.fix_headings(F.lit(raw))) == cleaned


@pytest.mark.parametrize(
    "raw, cleaned",
    [("![a](undefined)b", "b"), ("![a]( )b", "b"), ("![a](x y .png)", "![a](xy.png)"), ("a\n\n\n\nb", "a\n\nb")],
)
def test_images(spark, raw, cleaned):
    assert one(spark, X.clean_images(F.lit(raw))) == cleaned


def test_bold_line_gets_a_break(spark):
    lines = F.split(F.lit("**Bold**\ntext\n**Other**\n\n**last**"), "\n")
    assert one(spark, F.array_join(X.break_after_bold(lines), "\n")) == "**Bold**\n\ntext\n**Other**\n\n**last**"


@pytest.mark.parametrize(
    "raw, title, kept",
    [("# T\n\nx", "T", "x"), ("---\n\n# T here\nx", "T", "---\n\nx"), ("intro\n# T", "T", "intro\n# T"), ("![h](a)\n# Tit", "Title", "![h](a)\n"), ("## T\nx", "T", "## T\nx")],
)
def test_duplicate_title(spark, raw, title, kept):
    assert one(spark, X.drop_duplicate_title(F.lit(raw), F.lit(title))) == kept


def test_hazards_name_line_and_skip_code(spark):
    text = "a style=\"x\"\n```\nstyle=b\n```\n`style=c` ok\nstyle={{a:1}}\n~~~\nstyle=d\n~~~\n  style=e"
    df = spark.createDataFrame([(1, text)], "doc_id int, t string").select("doc_id", F.split("t", "\n").alias("lines"))
    got = {(r["line"], r["snippet"]) for r in X.style_hazards(df).collect()}
    assert got == {(1, 'a style="x"'), (10, "style=e")}


def test_runs(spark):
    schema = "array<struct<plain_text: string, href: string, bold: boolean, italic: boolean, strikethrough: boolean, underline: boolean, code: boolean, color: string>>"
    def run(text, href=None, color="default", **on):
        return (text, href, *[on.get(k, False) for k in ("bold", "italic", "strikethrough", "underline", "code")], color)

    rows = [run(" Step 1 ", bold=True), run(":", bold=True), run("a\n\nb", italic=True), run("red", color="red"), run(" x ", href="u"), run("c", href="u", code=True)]
    df = spark.createDataFrame([(rows,)], f"r {schema}")
    got = df.select(B.render_runs(F.col("r")).alias("v")).first()["v"]
    assert got == ' **Step 1** :*a*\n\n*b*<span style={{color:"red"}}>red</span> [x](u) `c`'


def test_deep_block_trees(spark):
    rows = [(1, i, i - 1 if i > 1 else None, 0, "paragraph", f"t{i}") for i in range(1, 6)] + [(1, 9, None, 1, "odd", "z")]
    df = spark.createDataFrame(rows, "page_id long, block_id long, parent_id long, pos long, type string, text string")
    got = B.block_rollup(df).orderBy("path").collect()
    assert [(r["block_id"], r["depth"]) for r in got] == [(1, 0), (2, 1), (3, 2), (4, 3), (5, 4), (9, 0)]
    assert got[-1]["rendered"].startswith("> [!NOTE]")


def test_asset_urls_are_found_once(spark):
    text = "[![a](u1)](l) ![b](u2) <img alt='x' src='u3'> ![c](u1)"
    assert one(spark, A.asset_urls(F.lit(text))) == ["u1", "u2", "u3"]


def test_links(spark):
    slugs = spark.createDataFrame([("the-slug", "canon"), ("canon", "other")], "key string, canonical_slug string")
    ids = spark.createDataFrame([("0" * 31 + "a", "by-id")], "key string, canonical_slug string")
    body = (
        "[a](/docs/The%20Slug/) ![i](/docs/the-slug) [b](/pt/docs/x/canon#Some  Head) [c](https://notion.so/" + "0" * 31 + "A?pvs=4) "
        "[d](/docs/none) [e](https://x.org) [f](#My Part)"
    )
    docs = spark.createDataFrame([("p", "es", body)], "page_id string, locale string, body string")
    got = K.rewrite_links(docs, slugs, ids).first()["body"]
    assert got == (
        "[a](/es/docs/canon) ![i](/docs/the-slug) [b](/es/docs/other#some--head) [c](/es/docs/by-id) "
        "[d](/docs/none) [e](https://x.org) [f](#my-part)"
    )


def test_rewritten_links_are_not_rewritten_again(spark):
    slugs = spark.createDataFrame([("a", "b"), ("b", "c")], "key string, canonical_slug string")
    ids = spark.createDataFrame([], "key string, canonical_slug string")
    docs = spark.createDataFrame([("p", "en", "[x](/docs/a) [y](/docs/b)")], "page_id string, locale string, body string")
    assert K.rewrite_links(docs, slugs, ids).first()["body"] == "[x](/docs/b) [y](/docs/c)"


def test_lost_images_come_back_by_number(spark):
    note = lambda t: f":::note 🖼️\n{t}\n\n:::"
    english = "![a](assets/1.png) text ![b](assets/2.png)\n![far](https://x.org/x.png) ![c](assets/3.png)"
    body = f"{note('[Marcador]')} x ![eigen](assets/own.png)\n{note('static/images/n_0.png')}\n{note('[more]')} {note('a real note')}"
    want = f"![a](assets/1.png) x ![eigen](assets/own.png)\n![c](assets/3.png)\n{note('[more]')} {note('a real note')}"
    rows = [("p", "pt", "e", body), ("q", "en", "e", body), ("r", "pt", None, body), ("s", "pt", "gone", body), ("t", "es", "e", None), ("u", "es", "e", "plain")]
    docs = spark.createDataFrame(rows, "page_id string, locale string, en_sibling_id string, body string")
    bodies = spark.createDataFrame([("e", english), ("gone2", "x")], "page_id string, body string")
    got = {r.page_id: r.body for r in A.repair_images(docs, bodies).collect()}
    assert got == {"p": want, "q": body, "r": body, "s": body, "t": None, "u": "plain"}
