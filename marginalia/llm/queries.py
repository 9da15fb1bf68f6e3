"""One query per operator over its whole table, and the SQL some of them are checked by."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, centroids, chat, html_extract, huffman, lattice, lexical, ordinal, packing, pii, quality_rules, simhash, token_counts
from .common import scratch, table, text_of

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def sha256_of(text: Column) -> Column:
    return F.sha2(text, 256)


def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded and decoded again."""
    encoded = bpe.encode(table(spark, folder, "documents").select("doc_id", "text"), BYTE_BPE)
    both = bpe.decode(encoded, BYTE_BPE)
    return both.select(
        "doc_id", bpe.token_count(F.col("ids")).alias("n_tokens"),
        sha256_of(F.col("ids")).alias("ids_sha256"), sha256_of(F.col("decoded")).alias("decoded_sha256"),
    )


def op2_html(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of every page."""
    done = html_extract.extract(table(spark, folder, "pages").select("page_id", "url", "html"))
    return done.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents packed into sequences of 1024 ids."""
    pieces = packing.split_pieces(table(spark, folder, "documents"), BYTE_BPE, capacity=1024, end_id=2)
    return packing.pack(pieces, 1024).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """The fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"), "component_id")


def rated(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, grade`` of the rated documents."""
    return table(spark, folder, "labels").select("doc_id", ordinal.grade_of(F.col("quality"), F.col("toxic")).alias("grade"))


def op5_ordinal(spark: SparkSession, folder: str) -> DataFrame:
    """Expected grade and verdict of every document."""
    docs = table(spark, folder, "documents")
    scored = ordinal.score(docs, ordinal.fit(docs, rated(spark, folder)))
    return ordinal.select(scored).select("doc_id", "expected_grade", "tail", "kept")


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document."""
    found, weights = pii.fit(table(spark, folder, "documents"))
    done = pii.spans(found, weights)

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = map(count, pii.KINDS)
    return done.select("doc_id", *counts, sha256_of(pii.listed(F.col("base"))).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"))


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts of every document. The cache starts empty, so that each run does its whole work."""
    counted = token_counts.count_tokens(table(spark, folder, "documents"), scratch(spark, "token-cache"), BYTE_BPE)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Measurements, failure bits and verdict of every document."""
    entries = quality_rules.apply_policy(quality_rules.ledger(table(spark, folder, "documents")))
    base = F.col("failed").bitwiseAND(F.lit(quality_rules.bits(quality_rules.BASE))) != 0
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept", "failed"
    )


def op9_lattice(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of all vectors of a label at cosine 0.93."""
    found = lattice.near_duplicates(table(spark, folder, "embeddings"), 0.93)
    return found.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))


def op10_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation, and one whose texts hold control strings, formatted and read back."""
    tricky = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string")
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    done = chat.format_paths(chat.linear_tree(rows, "conv_id", "turn", "role", "text"), unique=True)
    read = done.select(
        "conv_id", F.length("formatted").cast("long").alias("formatted_chars"), chat.read_turns(F.col("formatted")).alias("turns"),
        F.array_join(chat.read_loss(F.col("formatted"), F.col("loss_spans")), "").alias("loss"),
    )
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        sha256_of(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), sha256_of(F.col("loss")).alias("loss_sha256"), "formatted_chars",
    )


def op11_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """The ids of all documents, written under one Huffman code and read back."""
    width = huffman.width_of(BYTE_BPE)
    docs = table(spark, folder, "documents").select("doc_id", huffman.ids_column(F.col("text"), BYTE_BPE, 0, width).alias("ids"))
    files = scratch(spark, "token-files")
    huffman.write_ids(docs, files, width)
    return huffman.read_ids(spark, files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op12_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """Eight clusters of all vectors of 64 components after ten rounds."""
    return centroids.describe(*centroids.cluster(table(spark, folder, "embeddings"), width=64, k=8, rounds=10, salt="3:"))


def op13_lexical(spark: SparkSession, folder: str) -> DataFrame:
    """The twenty best documents of every benchmark item."""
    index = lexical.build_index(table(spark, folder, "documents"), scratch(spark, "lexical-index"))
    return lexical.search(index, table(spark, folder, "benchmark"), 20)


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_html": op2_html,
    "op3_packing": op3_packing,
    "op4_simhash": op4_simhash,
    "op5_ordinal": op5_ordinal,
    "op6_pii": op6_pii,
    "op7_token_counts": op7_token_counts,
    "op8_quality_rules": op8_quality_rules,
    "op9_lattice": op9_lattice,
    "op10_chat": op10_chat,
    "op11_token_files": op11_token_files,
    "op12_centroids": op12_centroids,
    "op13_lexical": op13_lexical,
}

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _without(text: str, characters: str) -> str:
    return f"length(translate({text}, {characters}, ''))"


def _clusters_sql(width: int, k: int, rounds: int) -> str:
    near = "SELECT v.rid, any_value(v.vec_id) AS vec_id, any_value(v.v) AS v, min(row(list_sum(list_transform(list_zip(v.v, c.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), c.k)) AS b FROM v CROSS JOIN {c} c GROUP BY v.rid"
    parts = [
        f"""WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {width} AND len(embedding) = {width}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS k, v AS c FROM v QUALIFY k < {k})"""
    ]
    for i in range(rounds):
        parts += [
            f"a{i} AS MATERIALIZED ({near.format(c=f'c{i}')})",
            f"""m{i} AS MATERIALIZED (SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM (
  SELECT b[2] AS k, i, sum(x) AS s, count(*) AS n FROM (SELECT b, unnest(v) AS x, unnest(range(1, {width + 1})) AS i FROM a{i}) GROUP BY ALL) GROUP BY k)""",
            f"c{i + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.c, c.c) AS c FROM c{i} c LEFT JOIN m{i} m ON m.k = c.k)",
        ]
    last = f"c{rounds}"
    parts.append(f"e AS MATERIALIZED (SELECT vec_id, CAST(b[2] AS INTEGER) AS cluster, CAST(b[1] AS BIGINT) AS distance FROM ({near.format(c=last)}))")
    return ",\n".join(parts) + f"""
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(list_transform(c.c, lambda x: CAST(x AS VARCHAR)), ',')) AS centroid_sha256 FROM e JOIN {last} c ON c.k = e.cluster"""


CHECKS = {
    "op8_quality_rules": f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split(translate(t, {_BLANKS}, '      '), ' '), lambda x: x <> '') AS ws,
  list_filter(string_split(t, chr(10)), lambda x: translate(x, {_BLANKS}, '') <> '') AS ls FROM d),
wins AS (SELECT rid, i, concat_ws(' ', ws[i], ws[i + 1], ws[i + 2]) AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
often AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM wins),
covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM often, (VALUES (0), (1), (2)) v(k) WHERE c > 1 GROUP BY rid),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, {_without('t', _BLANKS)} AS word_chars,
    length(t) - {_without('t', "'#*$%&|<>'")} AS n_symbols, CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    coalesce(c.n, 0) AS n_repeat_words, length(t) - {_without('t', "'ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝ'")} AS n_capitals,
    length(t) - {_without('t', "'!'")} AS n_exclamations FROM w LEFT JOIN covered c USING (rid)),
f AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END) + (CASE WHEN 2 * n_repeat_words > n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 5 * n_symbols > n_words THEN 4 ELSE 0 END) + (CASE WHEN 2 * n_capitals > word_chars THEN 8 ELSE 0 END)
    + (CASE WHEN 10 * n_dup_lines > 6 * n_lines THEN 16 ELSE 0 END) + (CASE WHEN word_chars > 25 * n_words THEN 32 ELSE 0 END)
    + (CASE WHEN 5 * n_exclamations > n_words THEN 64 ELSE 0 END) AS mask FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, mask % 4 <> 0 AS base_failed, mask = 0 AS kept, CAST(mask AS BIGINT) AS failed FROM f""",
    "op12_centroids": _clusters_sql(64, 8, 10),
    "op13_lexical": """WITH t AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
d AS (SELECT rid, doc_id, ws, CAST(len(ws) AS BIGINT) AS n FROM t WHERE len(ws) > 0),
g AS (SELECT count(*) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM d),
p AS (SELECT rid, w, count(*) AS tf FROM (SELECT rid, unnest(ws) AS w FROM d) GROUP BY rid, w),
df AS (SELECT w, CAST(floor(1000 * ln((2 * (SELECT big_n FROM g) + 2) / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS weight FROM p GROUP BY w),
q AS (SELECT iid, item_id, w, count(*) AS times FROM (SELECT row_number() OVER () AS iid, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS w FROM benchmark) GROUP BY iid, item_id, w),
s AS (SELECT q.iid, q.item_id, d.rid, d.doc_id, CAST(sum(q.times * df.weight * ((1000000000 * p.tf) // (1000 * p.tf + 12 * (75 + (25 * d.n * g.big_n) // g.big_l)))) AS BIGINT) AS score
  FROM q JOIN p ON q.w = p.w JOIN df ON q.w = df.w JOIN d ON d.rid = p.rid CROSS JOIN g GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 20""",
}
