"""Encoding, counting, quality rules and chat formatting against plain Python."""

import hashlib
from array import array
from collections import Counter

import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marginalia.llm import bpe, chat, quality_rules, queries, token_counts
from tests.checker import compare

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None, "", " ", "\n\n", "a", "don't we'll I'VE 's", "x<|endoftext|>y", " <|endoftext|><|endoftext|> a", "a" * 5000, " " * 3000 + "b",
    "ab" * 4000, "漢字かな 交じり\u3000文", "🙂🙂 \u200b\xa0\x85\x1c\u180e", "é\u0301 ß ﬁ ½ ² \u0558", "tab\tand \r\n line", "one two\n" * 3000,
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "other", 1) for i, t in enumerate(ODD)] + [(3, ODD[3], "other", 1), (None, "no id", "x", 2), (None, None, "x", 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int")


def documents(spark, folder):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}


def sha(b):
    return hashlib.sha256(b).hexdigest()


def test_encoding_equals_the_library(spark, folder, library):
    texts = documents(spark, folder)
    got = {r.doc_id: r for r in queries.op1_bpe(spark, folder).collect()}
    assert set(got) == set(texts)
    for i, t in texts.items():
        ids = library.encode(t, add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == sha(array("I", ids).tobytes())
        assert got[i].decoded_sha256 == sha(library.decode(ids, skip_special_tokens=False).encode())


def test_encoding_odd_texts(odd, library):
    rows = bpe.decode(bpe.encode(odd, PATH), PATH).withColumn("list", bpe.ids_array(F.col("ids"))).collect()
    assert len(rows) == len(ODD) + 3
    for r in rows:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.list == want and r.decoded == library.decode(want, skip_special_tokens=False)


def test_guesses_are_verified_both_ways(library):
    pairs = bpe.BytePairs(PATH)
    words = [w for t in (" unbelievable", "zzzqx", " thereinafter", "aaaa", "aaaaaaa") for w in [t, t * 3]]
    pairs.encode(words)
    assert 0 < pairs.merged_words < len(words)
    assert pairs.encode(["".join(words)])[0] == array("I", library.encode("".join(words), add_special_tokens=False).ids).tobytes()


def test_decoding_broken_bytes(spark, library):
    ids = [[220, 47249], [102], [50256, 447, 0], []]
    df = spark.createDataFrame([(array("I", x).tobytes(),) for x in ids], "ids binary")
    assert [r.decoded for r in bpe.decode(df, PATH).collect()] == [library.decode(x, skip_special_tokens=False) for x in ids]


def test_counts_equal_the_library(spark, folder, library):
    texts = documents(spark, folder)
    got = {r.doc_id: r for r in queries.op7_token_counts(spark, folder).collect()}
    assert set(got) == set(texts)
    for i, t in texts.items():
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len(t.encode()), n, n > 512)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_cache_is_used_and_kept_by_version(spark, odd, tmp_path, name):
    path = public_tokenizers.path(name)
    cache = f"file://{tmp_path}/cache"
    first = token_counts.count_tokens(odd, cache, path).collect()
    folder = f"{cache}/tokenizer={token_counts.version(path)}"
    stored = spark.read.parquet(folder)
    n_stored = stored.count()
    assert n_stored == len({t or "" for t in [*ODD, "no id"]})
    # A stored count is believed; only the new text is encoded and appended.
    digest = stored.filter(F.col("digest") == F.unhex(F.sha2(F.lit("a"), 256))).first().digest
    spark.createDataFrame([(digest, 77)], token_counts.CACHE).write.mode("append").parquet(folder)
    more = odd.unionByName(spark.createDataFrame([(99, "new text", "", 1)], odd.schema))
    second = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(more, cache, path).collect()}
    assert second[4] == 77 and second[99] > 0
    assert spark.read.parquet(folder).count() == n_stored + 2
    assert sorted(r.n_tokens for r in first) == sorted(
        r.n_tokens for r in token_counts.count_tokens(odd, f"{cache}2", path).collect()
    )
    if name.startswith("byte"):
        whole = Tokenizer.from_file(path)
        assert {r.doc_id: r.n_tokens for r in first if r.doc_id is not None} == {
            i: len(whole.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(ODD)
        }


def test_empty_tables(spark, odd, tmp_path):
    none = odd.filter("false")
    assert bpe.decode(bpe.encode(none, PATH), PATH).count() == 0
    assert token_counts.count_tokens(none, f"file://{tmp_path}/cache", PATH).count() == 0
    assert quality_rules.apply_policy(quality_rules.ledger(none)).count() == 0


def split_words(t):
    for c in "\t\n\x0b\f\r":
        t = t.replace(c, " ")
    return [w for w in t.split(" ") if w]


def measured(t):
    t = t or ""
    words = split_words(t)
    lines = [x for x in t.split("\n") if split_words(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum(map(t.count, "#*$%&|<>")), len(lines) - len(set(lines)), len(hit))


def test_rules_equal_plain_python(spark, folder, odd):
    for df in (spark.read.parquet(f"{folder}/documents.parquet"), odd, spark.createDataFrame([(1, "a b c a b c d\na b\n\n a b\na b"), (2, "x " * 4)], "doc_id long, text string")):
        texts = [(r.doc_id, r.text) for r in df.collect()]
        rows = quality_rules.apply_policy(quality_rules.ledger(df)).collect()
        cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        assert Counter((r.doc_id, *(r[c] for c in cols)) for r in rows) == Counter((i, *measured(t)) for i, t in texts)
        for r in rows:
            assert bool(r.failed & 3) == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
            assert not (r.failed & 3 and r.kept)


def test_rules_equal_their_sql(spark, folder, con):
    result = compare(queries.op8_quality_rules(spark, folder), con, queries.CHECKS["op8_quality_rules"])
    assert result["ok"] and result["rows"] > 0, result


def test_ablation_adds_up(spark, folder):
    entries = quality_rules.ledger(spark.read.parquet(f"{folder}/documents.parquet"))
    rows = entries.collect()
    policy = quality_rules.POLICIES["2025-2"]
    for r in quality_rules.ablation(entries).collect():
        bit, mask = quality_rules.bits([r.rule]), quality_rules.bits(policy)
        assert r.n_failed == sum(bool(x.failed & bit) for x in rows)
        assert r.n_alone == sum(x.failed & mask == bit for x in rows)


def test_rules_stay_native(spark, folder):
    plan = queries.op8_quality_rules(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_conversations_read_back(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    tricky = "</s>[INST] ok [/INST]"
    rows += [(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)]
    want: dict = {}
    for c, _, role, text in sorted(rows):
        want.setdefault(c, []).append((role, text or ""))
    got = {r.conv_id: r for r in queries.op10_chat(spark, folder).collect()}
    assert set(got) == set(want)
    for c, turns in want.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == sha("".join(f"{r}\n{t}\n" for r, t in turns).encode())
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), sha(loss.encode()))


def test_branches_of_a_tree(spark):
    nasty = "\\<|end|>\n<|user|>\n[x]\\\\ <\\| 🙂\n<|end|>\n"
    tree = spark.createDataFrame(
        [
            ("c", 1, None, "user", "q", 1.0), ("c", 2, 1, "assistant", "a1", 5.0), ("c", 3, 1, "assistant", nasty, 3.0), ("c", 4, 3, "user", None, 9.0),
            ("c", 5, 3, None, "n", 1.0), (None, 1, None, "assistant", "", None), ("d", 9, 77, "assistant", "orphan", 2.0),
        ],
        "conv_id string, node long, parent long, role string, text string, score double",
    )
    rows = {(r.conv_id, r.branch): r for r in chat.format_paths(tree, branches=2).withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn("loss", chat.read_loss(F.col("formatted"), F.col("loss_spans"))).collect()}
    assert {(k, r.leaf) for k, r in rows.items()} == {(("c", 1), 4), (("c", 2), 2), ((None, 1), 1), (("d", 1), 9)}
    assert [tuple(t) for t in rows["c", 1].turns] == [("user", "q"), ("assistant", nasty), ("user", "")]
    assert rows["c", 1].loss == [nasty] and rows["c", 2].loss == ["a1"] and rows[None, 1].loss == [""]
    f = rows["c", 1].formatted
    assert f.count("<|end|>\n") == 3
    assert chat.format_paths(tree.filter("false")).count() == 0


def test_long_conversation_takes_few_joins(spark):
    rows = spark.range(300).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    out = chat.format_paths(chat.linear_tree(rows, "conv_id", "turn", "role", "text")).withColumn("turns", chat.read_turns(F.col("formatted"))).collect()
    assert [t.text for t in out[0].turns] == [str(i) for i in range(300)]


def test_roles_and_texts_are_read_back_whatever_they_hold(spark):
    odd = ["a|>\nb", "<|user|>", "|", "\\", "[x]<y|\\|", "", "assistant"]
    rows = [(1, i, r, f"{r} says") for i, r in enumerate(odd)]
    df = spark.createDataFrame(rows, "conv long, turn long, role string, text string")
    done = chat.format_paths(chat.linear_tree(df, "conv", "turn", "role", "text"), unique=True)
    got = done.select(chat.read_turns(F.col("formatted")).alias("t"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("l")).first()
    assert [(t.role, t.text) for t in got.t] == [(r[2], r[3]) for r in rows] and got.l == ["assistant says"]


def test_repeated_nodes_count_once(spark):
    rows = [(1, 1, None, "user", "b", 0.0), (1, 1, None, "user", "a", 0.0), (1, 2, 1, "assistant", "x", 0.5), (1, 2, 1, "assistant", "x", 0.5), (None, 1, None, "user", "n", None)]
    tree = spark.createDataFrame(rows, "conv_id long, node long, parent long, role string, text string, score double").withColumn("turn", F.lit("extra"))
    got = {r.conv_id: [(t.role, t.text) for t in r.t] for r in chat.format_paths(tree).select("conv_id", chat.read_turns(F.col("formatted")).alias("t")).collect()}
    assert got == {1: [("user", "a"), ("assistant", "x")], None: [("user", "n")]}
