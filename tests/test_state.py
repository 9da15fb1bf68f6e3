import uuid

from pyspark.sql import functions as F

from marginalia.operators import state as S
from marginalia.session import shared_dir
from marginalia.sources import scans
from marginalia.sources.sinks import SnapshotStore
from marginalia.streaming import feed as SF


def fresh(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def feed(spark, *rows):
    df = spark.createDataFrame(list(rows), "event_id long, page_id long, edited_at string, k long")
    return df.withColumns({"edited_at": F.col("edited_at").cast("timestamp"), "kind": F.lit("page.updated")})


def test_ties_at_the_cut_are_kept(spark):
    rows = [(i, i, f"2024-01-01 00:0{i // 3}:00", 0) for i in range(12)]
    assert S.take_with_ties(feed(spark, *rows), 4).count() == 6
    assert S.take_with_ties(feed(spark, *rows), 3).count() == 3
    assert S.take_with_ties(feed(spark, *rows), 50).count() == 12


def test_snapshot_store_refuses_empty_and_partial_results(spark):
    store = SnapshotStore(spark, fresh(spark, "store"))
    schema = "id long"
    empty = spark.createDataFrame([], schema)
    assert store.read(empty.schema).count() == 0
    assert store.publish(empty, "v0") == "written"
    assert store.publish(spark.range(3), "v1") == "written"
    assert store.publish(empty, "v2") == "clobbered"
    assert store.publish(spark.range(9), "v3", read_errors=2) == "read_errors"
    assert store.publish(empty, "v1") == "clobbered"
    assert store.latest() == ("v1", 3)
    assert store.read(spark.range(1).schema).count() == 3


def test_late_distinct_events_are_delivered(spark):
    root = fresh(spark, "once")
    rows = lambda *xs: spark.createDataFrame([(i, t) for i, t in xs], "event_id long, at string").select("event_id", F.col("at").cast("timestamp").alias("ts"))
    SF.deliver_once(rows((1, "2024-01-02 10:00:00"), (2, "2024-01-02 11:00:00"), (2, "2024-01-02 11:00:00")), 0, root)
    SF.deliver_once(rows((3, "2024-01-02 12:00:00"), (1, "2024-01-02 10:00:00")), 1, root)
    for _ in range(2):
        SF.deliver_once(rows((4, "2024-01-01 07:00:00"), (2, "2024-01-02 11:00:00")), 2, root)
    got = spark.read.parquet(root).select("event_id").collect()
    assert sorted(r["event_id"] for r in got) == [1, 2, 3, 4]


def test_documents_round_trip(spark):
    path = fresh(spark, "md")
    text = '---\ntitle: "A: b"\nslug: x\n---\nbody\n---\nmore'
    df = spark.createDataFrame([(text,), ("no header",)], "content string")
    rows = {r["body"]: r["frontmatter"] for r in scans.split_document(df).collect()}
    assert rows == {"body\n---\nmore": {"title": "A: b", "slug": "x"}, "no header": {}}


def test_metadata_files(spark):
    import json
    import os

    path = fresh(spark, "pages")
    good = {n: "x" for n in scans.REQUIRED if n != "assets"} | {"assets": [], "status": "active"}
    for name, raw in {"a": json.dumps(good), "b": "{bad", "c": json.dumps({"page_id": "c"}), "d": json.dumps(good | {"status": "live"})}.items():
        os.makedirs(f"{path}/{name}")
        with open(f"{path}/{name}/metadata.json", "w") as f:
            f.write(raw)
    got = {r["key"].split("/")[-2]: r["outcome"] for r in scans.read_metadata(spark, path).collect()}
    assert got == {"a": "page", "b": "skipped", "c": "skipped", "d": "skipped"}
    assert scans.list_prefix(spark, path, "metadata.json").count() == 4
