"""The views that put markup into texts leave out none of their characters."""

import pytest
from pyspark.sql import functions as F

from marginalia.plans import link_queries as LQ
from marginalia.plans import text_queries as TQ
from marginalia.sources import tables as T


def lines_found(text, view):
    at = 0
    for line in text.split("\n"):
        at = view.find(line, at)
        if at < 0:
            return False
        at += len(line)
    return True


@pytest.mark.parametrize("line", ["concat('[', line, '](', i, ')')", "concat('x', line)"])
def test_bodies_with_links_hold_whole_texts(spark, folder, line):
    texts = {str(r.doc_id): r.text for r in T.table(spark, folder, "documents").collect()}
    got = LQ.whole_bodies(spark, folder, line).collect()
    assert len(got) == len(texts) and all(lines_found(texts[r.page_id], r.body) for r in got)


def test_messy_and_decorated_texts_are_whole(spark, folder):
    docs = T.table(spark, folder, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    decorated = T.md_docs(spark, folder).select("doc_id", F.array_join("lines", "\n").alias("text"))
    for view in (TQ.messy_docs(spark, folder), decorated, TQ.spaced_docs(spark, folder)):
        got = view.collect()
        assert len(got) == len(texts) and all(lines_found(texts[r.doc_id], r.text) for r in got)


def test_odd_hrefs_are_encoded_not_dropped(spark, tmp_path, con):
    rows = [(1, "u", '<a href="a b(c)"> <a href="it\'s"> <a href=""> <a href="x\ty">')]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(r.url for r in LQ.distinct_assets(spark, str(tmp_path)).collect())
    assert got == ["https://files.amazonaws.com", "https://files.amazonaws.coma%20b%28c%29", "https://img.exampleit%27s", "https://img.examplex%09y"]
