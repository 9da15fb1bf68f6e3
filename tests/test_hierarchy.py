from pyspark.sql import functions as F

from marginalia.functions import ordered
from marginalia.functions.ordered import bounded_row_number, latest_before
from marginalia.operators.hierarchy import HierarchyPlan

SCHEMA = (
    "page_id string, title string, locale string, section string, section_order int, element_type string, slug string, "
    "status string, sub_items array<string>, language_source string, has_body boolean, source_idx bigint"
)


def page(page_id, title, locale="en", section="10-Basics", order=1, kind="Page", status="active", subs=(), source="explicit", body=True, idx=None):
    slug = title.lower().replace(" ", "-")
    return [page_id, title, locale, section, order, kind, slug, status, list(subs), source, body, idx]


def build(spark, *rows, **kw):
    data = []
    for i, r in enumerate(rows):
        r = list(r)
        r[-1] = i if r[-1] is None else r[-1]
        data.append(tuple(r))
    return HierarchyPlan(spark.createDataFrame(data, SCHEMA), **kw)


def chosen(plan):
    return {(r["family_id"], r["locale"]): r["page_id"] for r in plan.selected.collect()}


def test_english_parent_with_body_beats_an_empty_english_child(spark):
    p = build(spark, page("p", "Parent", subs=["c"]), page("c", "Child", body=False))
    assert chosen(p) == {("p", "en"): "p"}


def test_english_child_with_body_beats_the_parent(spark):
    p = build(spark, page("p", "Parent", subs=["c"]), page("c", "Child"))
    assert chosen(p) == {("p", "en"): "c"}


def test_own_locale_child_of_a_foreign_parent_wins_even_as_stub(spark):
    p = build(
        spark,
        page("p", "Pai", "pt", subs=["c", "e"]),
        page("c", "Filho", "pt", body=False),
        page("e", "English name", "en", order=7),
    )
    assert chosen(p) == {("p", "pt"): "c", ("p", "en"): "e"}
    fam = p.families.first()
    assert fam["canonical_slug"] == "english-name" and fam["flow_order"] == 7
    pages = {r["page_id"]: r for r in p.pages.collect()}
    assert pages["c"]["en_fallback_id"] == "e" and pages["c"]["en_sibling_id"] == "e"


def test_rank_source_then_staging_then_order_then_position(spark):
    p = build(
        spark,
        page("p", "Parent", subs=["a", "b", "c", "d"]),
        page("a", "Uno", "es", source="automated"),
        page("b", "Dos-2024-01-01 translation", "es"),
        page("c", "Tres", "es", order=9),
        page("d", "Cuatro", "es", order=2),
    )
    assert chosen(p)[("p", "es")] == "d"


def test_draft_and_dead_children_do_not_publish(spark):
    rows = [page("p", "Parent", subs=["a", "b"]), page("a", "Uno", "es", status="draft"), page("b", "Um", "pt", status="archived")]
    assert chosen(build(spark, *rows)) == {("p", "en"): "p"}
    assert chosen(build(spark, *rows, include_drafts=True)) == {("p", "en"): "p", ("p", "es"): "a"}


def test_nested_family_is_skipped_and_reported(spark):
    p = build(spark, page("p", "Parent", subs=["c"]), page("c", "Child", "es", subs=["x"]), page("x", "Grandchild", "pt"))
    assert {k[0] for k in chosen(p)} == {"p"}
    assert [r["page_id"] for r in p.diagnostics.filter("category = 'nested-family-skipped'").collect()] == ["c"]
    assert "x" not in {r["page_id"] for r in p.pages.collect()}


def test_a_page_listing_itself_is_no_nested_family(spark):
    p = build(spark, page("p", "Parent", subs=["p", "c"]), page("c", "Hijo", "es"))
    assert chosen(p) == {("p", "en"): "p", ("p", "es"): "c"}


def test_internal_pages_take_their_children_along(spark):
    p = build(spark, page("p", "Guide (internal use)", subs=["c"]), page("c", "Guia", "es"), page("t", "Testing things"), page("k", "Kept"))
    assert {r["page_id"] for r in p.pages.collect()} == {"k"}


def test_title_names_only_the_next_page_and_toggle_stays_open(spark):
    p = build(
        spark,
        page("h", "Heading", order=1, kind="Title"),
        page("a", "A", order=2),
        page("b", "B", order=3),
        page("g", "Group", order=4, kind="Toggle"),
        page("c", "C", order=5),
        page("d", "D", order=6),
        page("h2", "Second", order=7, kind="Title"),
        page("e", "E", order=8),
    )
    got = {r["page_id"]: (r["heading"], r["route_toggle"]) for r in p.routes.collect()}
    assert got == {
        "a": ("Heading", ""), "b": (None, ""), "c": (None, "group"), "d": (None, "group"), "e": ("Second", ""),
    }


def test_toggle_takes_the_heading_and_empty_toggles_vanish(spark):
    p = build(
        spark,
        page("h", "Heading", order=1, kind="Title"),
        page("g", "Group", order=2, kind="Toggle"),
        page("a", "A", order=3),
        page("z", "Empty", order=4, kind="Toggle"),
    )
    toggles = {r["toggle_dir"]: r["heading"] for r in p.filled_toggles.collect()}
    assert toggles == {"group": "Heading"}
    assert p.routes.first()["heading"] is None


def test_route_winner_inherits_a_heading(spark):
    p = build(
        spark,
        page("h", "Heading", order=1, kind="Title"),
        page("a", "Same", order=2, source="fallback"),
        page("b", "Same", order=3),
    )
    r = p.routes.first()
    assert (r["page_id"], r["heading"], r["candidates"]) == ("b", "Heading", 2)
    lost = p.diagnostics.filter("category = 'duplicate-public-route'").collect()
    assert [(x["page_id"], x["detail"]) for x in lost] == [("b", "dropped: a")]


def test_section_labels(spark):
    p = build(
        spark,
        page("p", "Parent", section="20-Managing Projects", subs=["c"]),
        page("c", "Hijo", "es", section="20-Other name"),
        page("q", "Question", section="10-Plain"),
        page("r", "Root", section=None),
    )
    got = {(r["locale"], r["section_dir"]): (r["label"], r["position"]) for r in p.section_categories.collect()}
    assert got == {
        ("en", "plain"): ("Plain", 1),
        ("en", "managing-projects"): ("Managing Projects", 2),
        ("es", "managing-projects"): ("Gestión de Proyectos", 2),
        ("en", "uncategorized"): ("Uncategorized", 3),
    }


def test_root_items_follow_the_sections(spark):
    p = build(spark, page("r", "Root", section=None, order=0), page("a", "A", section="90-Last"))
    rows = p.nav_edges.filter("parent_key = ''").orderBy("position").collect()
    assert [(r["node_key"], r["kind"]) for r in rows] == [("last", "section"), ("root", "page")]


def test_bucketed_row_numbers_equal_a_window(spark, monkeypatch):
    monkeypatch.setattr(ordered, "BLOCK", 4)
    df = spark.range(101).select(
        (F.col("id") % 3).alias("g"), (F.col("id") * 7 % 5).alias("o"), F.col("id").alias("i")
    )
    got = bounded_row_number(df, ["g"], [F.col("o"), ordered.block_of("i")], ["o", "i"], "n").collect()
    want = {}
    for g in range(3):
        ids = sorted((i for i in range(101) if i % 3 == g), key=lambda i: (i * 7 % 5, i))
        want.update({i: n + 1 for n, i in enumerate(ids)})
    assert {r["i"]: r["n"] for r in got} == want


def test_bucketed_carry_equals_a_scan(spark, monkeypatch):
    monkeypatch.setattr(ordered, "BLOCK", 3)
    df = spark.range(60).select((F.col("id") % 2).alias("g"), F.col("id").alias("i"))
    out = latest_before(
        df, ["g"], [ordered.block_of("i")], ["i"],
        {"prev": (F.struct("i"), F.lit(True)), "tenth": (F.struct("i"), F.col("i") % 10 < 2)},
    ).collect()
    for r in out:
        before = [i for i in range(r["i"]) if i % 2 == r["g"]]
        tenths = [i for i in before if i % 10 < 2]
        assert (r["prev"].i if r["prev"] else None) == (before[-1] if before else None)
        assert (r["tenth"].i if r["tenth"] else None) == (tenths[-1] if tenths else None)
