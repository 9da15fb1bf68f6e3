"""What block trees move, and pages of one part beside pages of many."""

import pytest
from pyspark.sql import functions as F

from marginalia.operators import blocks as B

SCHEMA = "page_id long, block_id string, parent_id string, pos long, type string, text string"


def shuffles(spark):
    """Bytes written to shuffles by each stage."""
    gateway = spark.sparkContext._gateway
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
    return {s.stageId(): s.shuffleWriteBytes() for s in map(stages.apply, range(stages.size()))}


@pytest.fixture
def merged(spark):
    """Joins as they are at size, where no side is small enough to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_texts_are_shuffled_once_however_deep_the_trees(spark, merged, tmp_path):
    depth, n, text = 10, 800, F.concat(*[F.sha2(F.concat(F.lit(i), F.col("id").cast("string")), 256) for i in range(16)])
    up = F.when(F.col("id") % depth > 0, F.concat(F.lit("b"), F.col("id") - 1))
    made = spark.range(n).select(
        F.floor(F.col("id") / 100).alias("page_id"), F.concat(F.lit("b"), "id").alias("block_id"), up.alias("parent_id"),
        F.col("id").alias("pos"), F.lit("paragraph").alias("type"), text.alias("text"),
    )
    made.write.parquet(f"{tmp_path}/blocks")
    start = max(shuffles(spark))
    moved = lambda: sum(n for stage, n in shuffles(spark).items() if stage > start)
    rows = B.block_rollup(spark.read.parquet(f"{tmp_path}/blocks"))
    assert rows.agg(F.count("*"), F.max("depth")).first()[:] == (n, depth - 1)
    tree = moved()
    # Two line breaks before a root, one before any other; of each page's first the two go, and one is added at its end.
    roots = n // depth
    assert B.assemble_documents(rows).agg(F.sum(F.length("body"))).first()[0] == n * 1024 + 2 * roots + (n - roots) - n // 100
    # Once for their places, once for their pages; one shuffle a level would be ten times the texts.
    assert 0 < tree < 2 * n * 1024 and moved() < 3 * n * 1024


def test_levels_leave_nested_blocks_where_they_are(spark, monkeypatch):
    plans, keep = {}, B.written

    def noted(df, name, *codec):
        out = keep(df, name, *codec)
        plans[name] = (df.columns, df._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(B, "written", noted)
    monkeypatch.setattr(B, "NESTED_ROWS", 20)
    rows = [(1, f"b{i}", None if i % 6 == 0 else f"b{i - 1}", i, "toggle", f"t{i}") for i in range(90)]
    got = B.block_rollup(spark.createDataFrame(rows, SCHEMA)).orderBy("path").collect()
    assert [r.rendered for r in got if r.rendered.startswith("<details>")] == [f"<details>\n<summary>t{i}</summary>\n" for i in range(90)]
    assert len(got) == 180 and sum(r.rendered == "\n</details>" for r in got) == 75
    for level in range(1, 6):
        columns, plan = plans[f"level-{level}"]
        assert "rendered" not in columns and plan.count("ENSURE_REQUIREMENTS") == 1


def test_long_pages_are_cut_and_the_others_whole(spark):
    rows = [(page, f"b{i}", None, i, "paragraph", f"{page}-{i}-" + "x" * 30) for page, n in ((1, 40), (2, 1), (3, 2)) for i in range(n)]
    tree = B.block_rollup(spark.createDataFrame(rows, SCHEMA))
    cut = B.assemble_documents(tree, part_chars=100).collect()
    for page, n in ((1, 40), (2, 1), (3, 2)):
        parts = sorted((r for r in cut if r.page_id == page), key=lambda r: r.part)
        assert [r.last for r in parts] == [False] * (len(parts) - 1) + [True]
        assert (len(parts) > 5) == (page == 1) and (len(parts) == 1) == (page != 1)
        assert "".join(r.body for r in parts) == "\n\n".join(f"{page}-{i}-" + "x" * 30 for i in range(n)) + "\n"


def test_a_ring_beside_repeated_blocks_fails_too(spark):
    # Two of the name b0 give four below them two places each, which made up for the four of the ring.
    rows = [(1, "b0", None, 0, "paragraph", "a"), (1, "b0", None, 1, "paragraph", "b")]
    rows += [(1, f"c{i}", "b0" if i == 0 else f"c{i - 1}", i, "paragraph", "c") for i in range(4)]
    rows += [(1, f"r{i}", f"r{(i + 1) % 4}", i, "paragraph", "r") for i in range(4)]
    with pytest.raises(ValueError, match="4 blocks"):
        B.block_rollup(spark.createDataFrame(rows, SCHEMA))
