import json
import uuid

import pytest
from pyspark.sql import functions as F

from marginalia.plans import jobs
from marginalia.session import shared_dir
from marginalia.sources.scans import scan_snapshots


def select(name):
    return {"type": "select", "select": {"name": name}}


def page(title, status="Published", language=None, section="10-Start", order=None, kind="Page", subs=(), **extra):
    props = {
        "Content elements": {"title": [{"plain_text": title[:3]}, {"plain_text": title[3:]}]},
        "Publish Status": select(status),
        "Content Section": select(section),
        "Element Type": select(kind),
        "Sub-item": {"relation": [{"id": s} for s in subs]},
    }
    if language:
        props["Language"] = select(language)
    if order is not None:
        props["Order"] = {"type": "number", "number": order}
    return {"last_edited_time": "2024-03-01T10:00:00.000Z", "properties": props, **extra}


PAGES = {
    "a1": page("Getting Started", order=1, subs=["a2", "a3"], icon={"type": "emoji", "emoji": "🌱"}),
    "a2": page("Primeros pasos", language="Spanish", order=1),
    "a3": page("Primeiros passos", language="PT - automated", order=1),
    "b1": page("Next Steps"),
    "c1": page("Gone", status="Remove"),
    "d1": page("Chapter", kind="Title", order=0),
}
BODIES = {
    "a1": "Read [on](/docs/next-steps) or [lost](/docs/nowhere).\n\n<img src=\"assets/x.png\">",
    "a2": "[Insert content here]",
    "a3": "Leia [mais](/docs/getting-started#Part One).",
    "b1": "Back to [start](/docs/primeros-pasos).",
    "c1": "Old.",
}


@pytest.fixture(scope="module")
def inputs(spark):
    rows = [(k, i, json.dumps(v)) for i, (k, v) in enumerate(PAGES.items())]
    raw = spark.createDataFrame(rows, "page_id string, source_idx long, raw string")
    snaps = raw.select("page_id", "source_idx", F.parse_json("raw").alias("snapshot"))
    bodies = spark.createDataFrame(list(BODIES.items()), "page_id string, body string")
    return snaps, bodies


@pytest.fixture(scope="module")
def catalog(inputs):
    return jobs.build_catalog(*inputs)


def test_catalog(catalog):
    rows = {r["page_id"]: r for r in catalog.collect()}
    assert rows["a1"]["title"] == "Getting Started" and rows["a1"]["icon"] == "🌱"
    assert rows["a3"]["locale"] == "pt" and rows["a3"]["language_source"] == "automated"
    assert rows["c1"]["status"] == "deprecated" and rows["b1"]["language_source"] == "fallback"
    # Pages without an order follow the largest one of their section.
    assert (rows["b1"]["section_order"], rows["c1"]["section_order"]) == (2, 3)
    assert rows["a2"]["has_body"] is False and rows["a1"]["keywords"] == ["docs"]


def test_publish(spark, inputs, catalog):
    run = jobs.publish(catalog, inputs[1])
    pages = {r["page_id"]: r for r in run.pages.collect()}
    assert set(pages) == {"a1", "a2", "a3", "b1"}
    assert pages["a2"]["outcome"] == "fallback" and pages["a2"]["path"] == "start/getting-started"
    assert pages["a1"]["body"] == (
        'Read [on](/docs/next-steps) or [lost](/docs/nowhere).\n\n<img src="/images/notion/x.png">'
    )
    assert pages["a2"]["body"].startswith("Read [on](/es/docs/next-steps)")
    assert pages["a3"]["body"] == "Leia [mais](/pt/docs/getting-started#part-one)."
    assert pages["b1"]["body"] == "Back to [start](/docs/getting-started)."
    assert {r["target"]: r["n"] for r in run.broken.collect()} == {"/docs/nowhere": 2}
    heads = {(r["page_id"], r["key"]): r["line"] for r in run.headers.collect()}
    assert heads[("a2", "slug")] == "slug: /getting-started" and heads[("a1", "id")] == 'id: "getting-started"'
    assert heads[("a1", "sidebar_custom_props")] == 'sidebar_custom_props:\n  title: "Chapter"'
    counts = {r["locale"]: r["fallbacks"] for r in run.counters.collect()}
    assert counts["es"] == 1
    root = f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"
    jobs.write_published(run, root)
    assert spark.read.parquet(f"{root}/documents").count() == 4
    assert spark.read.parquet(f"{root}/navigation").filter("kind = 'page'").count() == 4


def test_chunks(inputs, catalog):
    got = jobs.build_chunks(catalog, inputs[1])
    assert {r["page_id"] for r in got.collect()} == {"a1", "a2", "a3", "b1"}


def test_chunks_of_headed_documents(spark, inputs, catalog):
    head = '---\ntitle: "Own title"\nlocale: pt\nslug: own-slug\n---\n'
    bodies = inputs[1].withColumn("body", F.when(F.col("page_id") == "a1", F.concat(F.lit(head), "body")).otherwise(F.col("body")))
    plain = {r["page_id"]: r for r in jobs.build_chunks(catalog, inputs[1]).collect()}
    got = {r["page_id"]: r for r in jobs.build_chunks(catalog, bodies).collect()}
    assert (got["a1"]["title"], got["a1"]["locale"], got["a1"]["slug"]) == ("Own title", "pt", "own-slug")
    assert got["a1"]["text"] == plain["a1"]["text"] and got["a1"]["docusaurus_path"] == plain["a1"]["docusaurus_path"]
    assert got["b1"] == plain["b1"]


def test_validation(catalog):
    assert {(r["violation"], r["subject"]) for r in jobs.validate(catalog).collect()} == {("missing-content-hash", "d1")}


def test_raw_snapshots(spark):
    df = spark.createDataFrame([("a", '{"x": 1}'), ("b", "{broken")], "id string, raw string")
    rows = {r["id"]: r["snapshot"] for r in scan_snapshots(df, "id", "raw").collect()}
    assert rows["b"] is None and rows["a"].toPython() == {"x": 1}
