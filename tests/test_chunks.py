import random

import pytest
from pyspark.sql import functions as F

from marginalia.functions import lines as L
from tests.slow_repair import repair_pieces
from marginalia.operators import chunks as K


def tokens(text):
    return -(-(len(text.encode("utf-16-be")) // 2) // 4)


def words(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdeé") for _ in range(r.randint(2, 9))) for _ in range(n))


DOC = "\n".join(
    [
        "lead text",
        "## First **bold**",
        words(300, 1),
        "",
        "```",
        "## not a heading",
        "```",
        "### Inner <b>tag</b>",
        "---",
        "# Top",
        "\n\n".join(words(60, s) for s in range(2, 30)),
        "",
        "| a | b |",
        "| --- | --- |",
        "| " + words(200, 40) + " | x |",
        "",
        "```py",
        *[words(20, s) for s in range(50, 70)],
        "",
        "```",
        "tail 😀 end",
    ]
)


@pytest.fixture(scope="module")
def chunks(spark):
    df = spark.createDataFrame([("p", "h", DOC)], "page_id string, content_hash string, body string")
    df = df.select("page_id", "content_hash", F.split("body", "\n").alias("lines"))
    return K.chunk_rows(df).orderBy("chunk_index").collect()


def test_sections_follow_headings_outside_fences(spark):
    df = spark.createDataFrame([(DOC,)], "body string").select(F.split("body", "\n").alias("lines"))
    paths = [list(s.path) for s in df.select(L.sections().alias("s")).first()["s"]]
    assert paths == [[], ["First bold"], ["First bold", "Inner tag"], ["Top"]]


def test_all_text_is_kept(chunks):
    joined = "\n".join(c["text"] for c in chunks)
    for line in (x.strip() for x in DOC.split("\n")):
        assert line in joined or line == "---"


def test_sizes_and_ids(chunks):
    assert [c["chunk_index"] for c in chunks] == list(range(len(chunks)))
    assert len({c["chunk_id"] for c in chunks}) == len(chunks)
    for c in chunks:
        # A piece of at most 960 tokens, an overlap of at most 120, their joints.
        assert tokens(c["text"]) <= 960 + 120 + 10 or c["text"].count("\n\n") <= 2


def test_fences_and_tables_are_whole(chunks):
    for c in chunks:
        assert c["text"].count("```") % 2 == 0
    assert any("| a | b |\n| --- | --- |\n| " in c["text"] for c in chunks)


def test_chunks_of_a_page_are_stable(spark, chunks):
    df = spark.createDataFrame([("p", "h", DOC)], "page_id string, content_hash string, body string")
    again = K.chunk_rows(df.select("page_id", "content_hash", F.split("body", "\n").alias("lines")))
    assert [r["chunk_id"] for r in again.orderBy("chunk_index").collect()] == [r["chunk_id"] for r in chunks]


def test_noise_sections_are_dropped_and_small_ones_join(spark):
    body = "# A\none\n\n## ---\n***\n\n## B\ntwo"
    df = spark.createDataFrame([("d", body)], "doc_id string, body string")
    got = K.page_sections(df.select("doc_id", F.split("body", "\n").alias("lines"))).collect()
    assert len(got) == 1 and list(got[0]["heading_path"]) == ["A"]
    assert got[0]["text"] == "# A\none\n\n## B\ntwo"


def units(*sizes):
    return [["x" * (4 * s)] for s in sizes]


def sizes(pieces):
    return [[len(t) // 4 for t in p] for p in pieces]


def test_repair_joins_the_previous_piece_first():
    assert sizes(repair_pieces(units(500, 300, 500))) == [[500, 300], [500]]


def test_repair_joins_the_next_piece_when_the_previous_is_full():
    assert sizes(repair_pieces(units(800, 300, 500))) == [[800], [300, 500]]


def test_repair_rebalances_with_the_larger_neighbour():
    pieces = [["x" * 1200, "y" * 1200, "z" * 800], ["w" * 800]]
    assert sizes(repair_pieces(pieces)) == [[300, 300], [200, 200]]


def test_repair_leaves_a_piece_next_to_one_large_unit():
    assert sizes(repair_pieces(units(900, 100))) == [[900], [100]]


def test_repair_keeps_every_paragraph_in_order():
    for seed in range(200):
        r = random.Random(seed)
        pieces = [["p" * (4 * r.randint(1, 700)) for _ in range(r.randint(1, 4))] for _ in range(r.randint(2, 6))]
        out = repair_pieces(pieces)
        assert [t for p in out for t in p] == [t for p in pieces for t in p]
        assert all(out)
        for i, p in enumerate(out):
            size = tokens("\n\n".join(p))
            if size >= 400:
                continue
            # What stays small could neither join a neighbour ...
            for j in (i - 1, i + 1):
                if 0 <= j < len(out):
                    both = "\n\n".join((out[j] + p) if j < i else (p + out[j]))
                    assert tokens(both) > 960


def test_overlap_bounds(spark):
    def lead(*parts):
        df = spark.createDataFrame([([list(parts), ["next"]],)], "p array<array<string>>")
        return df.select(K.overlapped(F.col("p"))[1].alias("t")).first()["t"].removesuffix("next").rstrip("\n")

    assert lead("a" * 400, "b" * 360) == "b" * 360
    assert lead("a" * 400, "b" * 200) == "a" * 200 + "\n\n" + "b" * 200
    assert lead("c" * 900) == "c" * 400
    assert lead("|" + "c" * 900) == ""
    assert lead("```" + "c" * 900, "b" * 40) == "b" * 40
    assert lead("a" * 120, "b" * 160, "c" * 160) == "a" * 120 + "\n\n" + "b" * 160 + "\n\n" + "c" * 160


def test_paragraph_units(spark):
    text = "a\nb\n\n| t |\n| u |\nprose\n```\ncode\n\n| x |\n```\nafter\n```\nopen"
    got = spark.range(1).select(L.paragraph_units(F.split(F.lit(text), "\n")).alias("u")).first()["u"]
    assert got == ["a\nb", "| t |\n| u |", "prose", "```\ncode\n\n| x |\n```", "after", "```\nopen"]


def test_repair_in_expressions_equals_the_loop(spark):
    r = random.Random(11)
    rows = []
    for k in range(300):
        big = r.choice([300, 700, 1000])
        rows.append([["pé" * (2 * r.randint(1, big)) + "😀" * r.randint(0, 2) for _ in range(r.randint(1, 5))] for _ in range(r.randint(1, 9))])
    rows += [[["x" * 1200, "y" * 1200, "z" * 800], ["w" * 800]], units(900, 100), units(10), [["a"] * 700, ["b" * 100]]]
    df = spark.createDataFrame([(i, [p, None]) for i, p in enumerate(rows)], "i int, p array<array<array<string>>>")
    got = {r.i: (r.r, r.p) for r in K.with_repair(df, "p", "r").collect()}
    changed = 0
    for i, pieces in enumerate(rows):
        assert [list(p) for p in got[i][0][0]] == repair_pieces(pieces)
        assert got[i][0][1] is None
        changed += repair_pieces(pieces) != pieces
    assert changed > 100


def test_repair_of_many_pieces_is_linear(spark):
    import time

    def seconds(n):
        df = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.array(F.repeat(F.lit("x"), 1000 + 900 * (i % 3)), F.repeat(F.lit("y"), 600))).alias("p"))
        out = K.with_repair(df.select(F.array("p").alias("p")), "p", "r").select(F.aggregate(F.col("r")[0], F.lit(0), lambda a, p: a + F.size(p)).alias("n"))
        begin = time.perf_counter()
        assert out.first()["n"] == 2 * n
        return time.perf_counter() - begin

    seconds(200)
    assert seconds(8_000) < 8 * max(seconds(2_000), 0.5)


def test_chunk_stats_count_pages_without_chunks(spark):
    pages = spark.createDataFrame([("a", "en"), ("b", "en"), ("c", "pt"), ("d", None)], "page_id string, locale string")
    chunks = spark.createDataFrame([("a", "x" * 40), ("a", "x" * 400), ("a", "x" * 800)], "page_id string, text string")
    got = {r.locale: tuple(r)[1:] for r in K.chunk_stats(pages, chunks).collect()}
    assert got["en"] == (2, 3, 100.0, 1, 0.333333, 1) and got["pt"] == (1, 0, None, 0, None, 1)
