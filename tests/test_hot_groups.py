"""One family, section, route or page holding nearly all rows gives the same results."""

from pyspark.sql import functions as F

from marginalia.functions import ordered
from marginalia.operators import hierarchy as H
from marginalia.operators import state as S
from marginalia.operators.assets import repair_image_slots

N = 3000


def catalog(spark, **over):
    base = {
        "page_id": F.concat(F.lit("p"), F.col("id").cast("string")),
        "title": F.lit("Same title"),
        "locale": F.lit("en"),
        "section": F.lit("10-Hot"),
        "section_order": F.lit(1),
        "element_type": F.lit("Page"),
        "slug": F.lit("same-title"),
        "status": F.lit("active"),
        "sub_items": F.expr("CAST(array() AS array<string>)"),
        "language_source": F.lit("explicit"),
        "has_body": F.lit(True),
        "source_idx": F.col("id"),
    }
    return spark.range(N).select(*[c.alias(n) for n, c in (base | over).items()])


def test_one_route(spark, monkeypatch):
    monkeypatch.setattr(ordered, "BLOCK", 64)
    plan = H.HierarchyPlan(catalog(spark))
    route = plan.routes.collect()
    assert [(r["page_id"], r["candidates"]) for r in route] == [("p0", N)]
    assert plan.dropped_pages.count() == N - 1


def test_one_family(spark):
    children = F.when(F.col("id") == 0, F.expr(f"transform(sequence(1, {N - 1}), i -> concat('p', i))"))
    plan = H.HierarchyPlan(
        catalog(
            spark,
            sub_items=children,
            locale=F.when(F.col("id") % 3 == 0, "en").when(F.col("id") % 3 == 1, "es").otherwise("pt"),
            has_body=F.col("id") > 10,
        )
    )
    got = {r["locale"]: r["page_id"] for r in plan.selected.collect()}
    assert got == {"en": "p12", "es": "p13", "pt": "p11"}


def test_one_section_replay(spark, monkeypatch):
    monkeypatch.setattr(ordered, "BLOCK", 64)
    kind = F.when(F.col("id") % 100 == 0, "Toggle").when(F.col("id") % 100 == 50, "Title").otherwise("Page")
    title = F.concat(F.lit("Row "), F.col("id").cast("string"))
    plan = H.HierarchyPlan(catalog(spark, element_type=kind, title=title, slug=F.concat(F.lit("row-"), F.col("id").cast("string"))))
    rows = {r["source_idx"]: r for r in plan.routes.collect()}
    assert len(rows) == N - N // 50
    for i, r in rows.items():
        inside = i % 100 < 50
        assert r["route_toggle"] == (f"row-{i - i % 100}" if inside else "")
        assert r["heading"] == (f"Row {i - 1}" if i % 100 == 51 else None)


def test_one_slug_and_one_section_position(spark, monkeypatch):
    monkeypatch.setattr(ordered, "BLOCK", 64)
    docs = catalog(spark, section_order=F.when(F.col("id") == 5, 40))
    slugs = [r["slug"] for r in H.unique_slugs(docs).collect()]
    assert len(set(slugs)) == N and slugs.count("same-title") == 1
    placed = {r["page_id"]: r["section_order"] for r in H.fallback_positions(docs).collect()}
    want = {f"p{i}": 40 + n for n, i in enumerate((i for i in range(N) if i != 5), start=1)} | {"p5": 40}
    assert placed == want


def test_one_page_of_slots(spark, monkeypatch):
    monkeypatch.setattr(ordered, "BLOCK", 64)
    def slots(page, locale, every):
        return spark.range(N).select(
            F.lit(page).alias("page_id"), F.lit(locale).alias("locale"), F.col("id").alias("ord"),
            F.when(F.col("id") % every == 0, "placeholder").otherwise("real").alias("kind"),
            F.concat(F.lit(f"{page}-"), F.col("id").cast("string")).alias("name"),
        )

    both = slots("es", "es", 2).unionByName(slots("en", "en", 3))
    pairs = spark.createDataFrame([("es", "en")], "page_id string, en_page_id string")
    got = {r["ord"]: r["repaired"] for r in repair_image_slots(both, pairs).filter("page_id = 'es'").collect()}
    images = [f"en-{i}" for i in range(N) if i % 3]
    for i in range(N):
        assert got[i] == (images[i] if i % 2 == 0 and i < len(images) else f"es-{i}")


def test_one_page_of_events(spark):
    feed = spark.range(N).select(
        F.lit(1).alias("page_id"), F.col("id").alias("event_id"), F.lit("page.updated").alias("kind"), F.col("id").alias("k"),
        F.timestamp_seconds(F.col("id")).alias("edited_at"),
    )
    row = S.newest_per_page(feed).collect()
    assert [(r["page_id"], r["k"]) for r in row] == [(1, N - 1)]
    state = feed.select("page_id", "edited_at", "k").limit(1)
    assert S.upsert(state, feed, ["page_id"], "edited_at").first()["k"] == N - 1
