"""Quality rules as a bitmask ledger, in native columns only.

Every rule is evaluated once a document. The ledger keeps the measurements and one failure bit
per rule; policies are named versions of a bit set, so applying another policy or asking what a
rule alone costs reads the ledger, never the texts.

Words are ``[^\\x20\\x09-\\x0D]+``. A null text counts as empty: no words, which fails the rule on
few words. Null or repeated ids are rows like any other; an empty table gives an empty ledger.
Texts are measured whole; a row's work is linear in its text but for sorting the word windows of
texts that repeat some. Extra columns do not matter: only the id and the text are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import kept_rows, text_of

BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝ"
WINDOW = 3

# The order gives the bits: rule k is bit k. New rules are added at the end.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 20 * n_words",
    "capitals": "100 * n_capitals > 50 * word_chars",
    "repeated_lines": "100 * n_dup_lines > 60 * n_lines",
    "long_words": "word_chars > 25 * n_words",
    "exclamations": "100 * n_exclamations > 20 * n_words",
}
BASE = ("few_words", "repeated_windows")
# Versioned policies: the rules each rejects by.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": BASE,
    "2025-1": (*BASE, "symbols", "capitals", "repeated_lines", "long_words"),
    "2025-2": (*BASE, "symbols", "capitals", "repeated_lines", "long_words", "exclamations"),
}
CURRENT = "2025-2"


def bits(rules) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in rules)


def _count_of(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def _repeated_words(words: Column, n: Column) -> Column:
    """Words inside windows that the text holds twice or more, the first included.

    Hashes tell most texts to have none; only the others compare their windows as text.
    """
    starts = F.sequence(F.lit(0), n - WINDOW)

    def window(i: Column) -> list[Column]:
        return [F.get(words, i + k) for k in range(WINDOW)]

    hashes = F.transform(starts, lambda i: F.xxhash64(*window(i)))
    placed = F.array_sort(F.transform(starts, lambda i: F.struct(F.concat_ws(" ", *window(i)).alias("w"), i.alias("i"))))
    # Sorted, equal windows are neighbours. Bound once, since each step looks at it thrice.
    found = F.transform(
        F.array(placed),
        lambda p: F.filter(p, lambda x, k: (F.get(p, k - 1)["w"] == x["w"]) | (F.get(p, k + 1)["w"] == x["w"])),
    )
    covered = F.flatten(F.transform(F.get(found, F.lit(0)), lambda x: F.sequence(x["i"], x["i"] + (WINDOW - 1))))
    exact = F.size(F.array_distinct(covered))
    return F.when(n < WINDOW, 0).when(F.size(F.array_distinct(hashes)) == n - (WINDOW - 1), 0).otherwise(exact).cast("long")


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """``doc_id`` and all measurements, one row per document; with ``carry``, the whole row as ``row``."""
    own = [F.struct("*").alias("row")] if carry else []
    body = docs.select(F.col(doc_id).alias("doc_id"), text_of(F.col(text)).alias("body"), *own)
    row = ["row"] if carry else []
    split = body.select(
        "doc_id", "body", *row,
        F.array_remove(F.split(F.translate("body", BLANKS, " " * len(BLANKS)), " "), "").alias("words"),
        F.filter(F.split("body", "\n"), lambda x: F.translate(x, BLANKS, "") != "").alias("lines"),
    )
    sized = split.withColumn("n", F.size("words")).withColumn("m", F.size("lines"))
    return sized.select(
        "doc_id", *row,
        F.col("n").cast("long").alias("n_words"),
        F.length(F.translate("body", BLANKS, "")).cast("long").alias("word_chars"),
        _count_of(F.col("body"), SYMBOLS).alias("n_symbols"),
        F.col("m").cast("long").alias("n_lines"),
        (F.col("m") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated_words(F.col("words"), F.col("n")).alias("n_repeat_words"),
        _count_of(F.col("body"), CAPITALS).alias("n_capitals"),
        _count_of(F.col("body"), "!").alias("n_exclamations"),
    )


def ledger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """Measurements and ``failed``, the bits of all rules that the document breaks."""
    failed = reduce(
        lambda a, b: a.bitwiseOR(b),
        [F.when(F.expr(rule), F.lit(1 << k)).otherwise(F.lit(0)) for k, rule in enumerate(RULES.values())],
    )
    return measure(docs, doc_id, text, carry).withColumn("failed", failed.cast("long"))


def apply_policy(entries: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The ledger with ``kept`` under a policy."""
    return entries.withColumn("kept", F.col("failed").bitwiseAND(F.lit(bits(POLICIES[policy]))) == 0)


def ablation(entries: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of a policy: documents that break it, and those it alone rejects.

    Works on the counts of distinct masks, of which there are at most two to the number of rules.
    """
    masks = entries.groupBy(F.col("failed").bitwiseAND(F.lit(bits(POLICIES[policy]))).alias("mask")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(bits([r])).alias("bit")) for r in POLICIES[policy]]))
    each = masks.select("mask", "n", rules.alias("r")).select("mask", "n", "r.rule", "r.bit")
    return each.groupBy("rule").agg(
        F.sum(F.when(F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("mask") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_alone"),
    )


def keep_good(docs: DataFrame, policy: str = CURRENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that a policy keeps, as they are."""
    return kept_rows(apply_policy(ledger(docs, doc_id, text, carry=True), policy), "kept", "row")
