"""Personal data by weak supervision, in native columns only.

Rules with exact patterns give the base spans: mail and network addresses, card and phone
numbers. Further spans are guessed: a broad pattern proposes candidates (long codes, long
numbers, titled names), and five labelers vote on each for, against or not at all: a strict
shape, a gazetteer, the words before, the signs of harmless numbers, and the spread of
characters. Expectation-maximisation over the counts of vote patterns of the whole corpus
estimates how reliable each labeler is, kind by kind, and how likely each pattern is personal
data. These likelihoods train the final span classifier, a logistic regression over votes, kind
and size, which decides each candidate. The corpus's part is one aggregate; only its distinct
patterns, a number fixed by the votes and size levels, come to the driver.

Positions are code points, ends exclusive. Per kind, base matches are leftmost and do not
overlap, and a match that fails its test is dropped without another try. A guessed span never
touches a base span. All work on a text happens in its own row, without a shuffle; running
positions are summed in blocks, so a text of very many matches stays near linear. Null and empty
texts have no spans; null and repeated ids are rows like any other; an empty table gives an
empty result. Texts are read whole.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of, written

KINDS = ("email", "ip", "card", "phone")
GUESSED = ("secret", "number", "name")
LOCAL = "[A-Za-z0-9._%+-]"
# The base patterns in a form that never reads a run of characters twice: a run is entered at its
# start or where the last match ended, and is never given back.
PATTERNS = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SIGNS = {"email": "[@]", "ip": "[0-9][.]", "card": "[0-9]", "phone": "[+][0-9]"}  # without these no match
TITLES = "Mr|Mrs|Ms|Dr|Prof|Mme|Mlle|Herr|Frau|Sra|Señor|Señora"
NAME = rf"(?:{TITLES})\.?\x20\p{{Lu}}\p{{Ll}}++(?:\x20\p{{Lu}}\p{{Ll}}++)?"
CODE = r"(?=[A-Za-z_-]*+[0-9])(?=[0-9_-]*+[A-Za-z])[A-Za-z0-9_-]{16,}+"
NUMBER = r"[0-9](?:[\x20()./-]?[0-9]){6,}+"
CANDIDATE = rf"(?<![\p{{L}}\p{{N}}_-])(?:{NAME}|{CODE}|{NUMBER})"
HINT = rf"[0-9]|(?:{TITLES})\.?\x20"  # without these no candidate
# Gazetteer: given names, and beginnings of keys that services hand out.
GIVEN = "Anna|Maria|John|James|Mary|Peter|Paul|Thomas|Michael|David|Sarah|Laura|Julia|Hans|Pierre|Jean|Marie|José|Juan|Carlos|Ana|Luis"
KEYS = "AKIA|ASIA|ghp_|gho_|xox[bap]-|sk_live|sk-|pk_live|AIza|eyJ"
WORDS = (
    r"(?i)(?:tok[e]n|secret|api[ _-]?key|key|passw(?:or)?d|pwd|auth|bearer|tel|phone|fax|call|mobile|ssn|iban|account|konto|compte|cuenta|"
    r"passport|licen[cs]e no|id|card)[\s:=\"'#.]{1,6}\z"
)
LABELERS = ("shape", "gazetteer", "context", "harmless", "spread")
SIZES = 6
LEAST = 0.5
BLOCK = 256


# --- spans of a pattern -----------------------------------------------------------------------


def _sums(values: Column) -> Column:
    """Running sums of an array of longs, appended block by block."""

    def within(block: Column, base: Column) -> Column:
        empty = F.struct(base.alias("at"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(block, empty, lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["out"], F.array(a["at"] + x)).alias("out")))

    def run(own: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.greatest(F.size(own) - 1, F.lit(0)), F.lit(BLOCK)), lambda i: F.slice(own, i + 1, BLOCK))
        empty = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<array<bigint>>").alias("out"))
        return F.aggregate(blocks, empty, add, lambda a: F.flatten(a["out"]))

    def add(a: Column, block: Column) -> Column:
        # Bound once: the block's own sums are both its result and its end.
        return F.transform(F.array(within(block, a["at"])), lambda w: F.struct(w["at"].alias("at"), F.concat(a["out"], F.array(w["out"])).alias("out")))[0]

    # Bound once: every block cuts from the same array.
    return F.transform(F.array(values), run)[0]


def _cut(body: Column, pattern: str, sign: str) -> Column:
    """``(gaps, hits)``: the text around and in the matches of a pattern; null without a sign of one."""
    return F.when(body.rlike(sign), F.struct(F.split(body, pattern, -1).alias("gaps"), F.regexp_extract_all(body, F.lit(pattern), F.lit(0)).alias("hits")))


def _places(cut: Column) -> Column:
    """Start of each hit."""
    sizes = F.transform(cut["hits"], lambda h, i: (F.length(F.get(cut["gaps"], i)) + F.length(h)).cast("bigint"))
    ends = F.transform(F.array(_sums(sizes)), lambda e: F.transform(cut["hits"], lambda h, i: F.get(e, i) - F.length(h)))
    return F.get(ends, F.lit(0))


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def share(i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int") * (F.lit(2) - i % 2)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + share(i)) % 10 == 0


def _between(n: Column, low: int, high: int) -> Column:
    return (n >= low) & (n <= high)


def holds(kind: str, hit: Column) -> Column:
    """Whether a match of the kind's pattern passes its test."""
    if kind == "ip":
        return hit.rlike(r"\A(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.|\z)){4}\z")
    if kind == "card":
        digits = _digits(hit)
        return F.when(_between(F.length(digits), 14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return _between(F.length(_digits(hit)), 10, 15)
    return F.lit(True)


def _spans(cut: Column, kind: str, order: int) -> Column:
    """Passing matches as array of (start, order, kind, end)."""
    found = F.zip_with(
        cut["hits"], _places(cut),
        lambda h, s: F.struct(s.alias("start"), F.lit(order).alias("order"), F.lit(kind).alias("kind"), (s + F.length(h)).alias("end"), holds(kind, h).alias("ok")),
    )
    passed = F.transform(F.filter(found, lambda x: x["ok"]), lambda x: F.struct(*[x[c].alias(c) for c in ("start", "order", "kind", "end")]))
    none = F.array().cast("array<struct<start:bigint,order:int,kind:string,end:bigint>>")
    return F.when(cut.isNull() | (F.size(cut["hits"]) == 0), none).otherwise(passed)


def _put(cut: Column, body: Column, new: Callable[[Column, Column], Column]) -> Column:
    """The text with ``new(hit, position)`` for each hit; untouched without hits."""
    # The last gap has no hit behind it.
    hit = lambda i: F.get(cut["hits"], i)
    parts = F.transform(cut["gaps"], lambda g, i: F.concat(g, F.coalesce(F.when(hit(i).isNotNull(), new(hit(i), i)), F.lit(""))))
    return F.when(cut.isNull() | (F.size(cut["hits"]) == 0), body).otherwise(F.array_join(parts, ""))


def _each_kind(df: DataFrame, body: str, new: Callable[[str, Column], Column]) -> DataFrame:
    """``body`` with all passing matches of all kinds replaced, kind after kind."""
    for kind in KINDS:
        df = df.withColumn("__cut", _cut(F.col(body), PATTERNS[kind], SIGNS[kind])).withColumn(
            body, _put(F.col("__cut"), F.col(body), lambda h, i, kind=kind: F.when(holds(kind, h), new(kind, h)).otherwise(h))
        )
    return df.drop("__cut")


# --- candidates and votes ---------------------------------------------------------------------


def _vote(yes: Column, no: Column | None = None) -> Column:
    votes = F.when(yes, 1)
    return (votes if no is None else votes.when(no, -1)).otherwise(0)


def _judged(cut: Column) -> Column:
    """``(kind, size, votes...)`` of each candidate."""

    def judge(h: Column, i: Column) -> Column:
        digits = F.length(_digits(h))
        before = F.right(F.get(cut["gaps"], i), F.lit(24))
        kind = F.when(digits == 0, "name").when(h.rlike("[A-Za-z]"), "secret").otherwise("number")
        strict = h.rlike(
            r"\A(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|[A-Za-z0-9_-]{24,}|[0-9]{3}-[0-9]{2}-[0-9]{4}|(?:[0-9]{4}[ -]){3}[0-9]{4}|"
            rf"\(?[0-9]{{3}}\)?[ .-][0-9]{{3}}[ .-][0-9]{{4}}|(?:{TITLES})\.? .+)\z"
        )
        listed = h.rlike(rf"\A(?:{KEYS})|\b(?:{GIVEN})\b")
        harmless = h.rlike(r"\A(?:(?:19|20)[0-9]{2}[-/.][0-9]{1,2}[-/.][0-9]{1,2}.*|[0-9]{1,2}[-/.][0-9]{1,2}[-/.](?:19|20)[0-9]{2}|97[89][ -]?[0-9].*|[0-9]+[.][0-9]+|(.)\1*|[A-Za-z-]+[0-9]{1,4})\z")
        kinds_of = F.size(F.array_distinct(F.split(h, "")))
        return F.struct(
            kind.alias("kind"), F.least(F.lit(SIZES - 1), F.floor(F.log2(F.length(h))).cast("int") - 1).alias("size"),
            _vote(strict).alias("shape"), _vote(listed).alias("gazetteer"), _vote(before.rlike(WORDS)).alias("context"),
            F.when(harmless, -1).otherwise(0).alias("harmless"), _vote(kinds_of >= 8, kinds_of <= 3).alias("spread"),
        )

    return F.transform(cut["hits"], judge)


FACTS = ("kind", "size", *LABELERS)


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, base, guesses``: base spans, and candidates with what the labelers say."""
    df = docs.select(F.col(doc_id).alias("doc_id"), text_of(F.col(text)).alias("body"))
    for order, kind in enumerate(KINDS):
        df = df.withColumn("__cut", _cut(F.col("body"), PATTERNS[kind], SIGNS[kind])).withColumn(kind, _spans(F.col("__cut"), kind, order))
    df = df.withColumn("base", F.array_sort(F.concat(*KINDS))).select("doc_id", "body", "base")
    # Base spans are blanked out before candidates are sought, at equal length.
    df = _each_kind(df, "body", lambda _, h: F.repeat(F.lit("\u0001"), F.length(h)))
    df = df.withColumn("cut", _cut(F.col("body"), CANDIDATE, HINT))
    found = F.zip_with(
        F.zip_with(F.col("cut.hits"), _places(F.col("cut")), lambda h, s: F.struct(s.alias("start"), (s + F.length(h)).alias("end"))),
        _judged(F.col("cut")), lambda s, f: F.struct(s["start"].alias("start"), s["end"].alias("end"), *[f[c].alias(c) for c in FACTS]),
    )
    df = df.select("doc_id", "base", F.when(F.size("cut.hits") > 0, found).alias("guesses"))
    # Kinds can overlap each other, so blanking one after the other may leave an edge of a base span.
    taken = F.flatten(F.transform("base", lambda b: F.sequence(b["start"], b["end"] - 1)))
    wanted = F.flatten(F.transform("guesses", lambda g: F.sequence(g["start"], g["end"] - 1)))
    apart = F.filter("guesses", lambda g: ~F.exists(F.col("base"), lambda b: (b["start"] < g["end"]) & (g["start"] < b["end"])))
    clash = (F.size("base") > 0) & F.arrays_overlap(taken, wanted)
    return df.withColumn("guesses", F.when(F.col("guesses").isNull(), None).when(clash, apart).otherwise(F.col("guesses")))


# --- reliabilities and the classifier ---------------------------------------------------------


def patterns(found: DataFrame) -> dict[tuple, int]:
    """How often each combination of kind, size and votes occurs in the corpus."""
    rows = found.select(F.explode("guesses").alias("g")).groupBy(*[F.col(f"g.{c}").alias(c) for c in FACTS]).agg(F.count("*").alias("n"))
    return {tuple(r[c] for c in FACTS): r["n"] for r in rows.collect()}


def reliabilities(counts: dict[tuple, int], rounds: int = 40) -> tuple[dict[tuple, float], dict]:
    """Expectation-maximisation: likelihood of each pattern, and P(vote | truth) of each labeler by kind."""
    likely = {}
    for p in counts:
        votes = p[2:]
        likely[p] = min(0.95, max(0.05, 0.35 + 0.25 * sum(votes)))
    table: dict = {}
    for _ in range(rounds):
        seen: dict = defaultdict(float)
        for p, n in counts.items():
            for truth, q in ((1, likely[p]), (0, 1 - likely[p])):
                seen[p[0], truth] += n * q
                for name, vote in zip(LABELERS, p[2:]):
                    seen[p[0], truth, name, vote] += n * q
        # Labelers are held to be right more often than not: votes for count as seen once more in truth.
        lean = {(1, 1): 2.0, (0, -1): 2.0}
        table = {
            (kind, truth, name, vote): (seen[kind, truth, name, vote] + lean.get((truth, vote), 1.0)) / (seen[kind, truth] + 4.0)
            for kind in GUESSED for truth in (0, 1) for name in LABELERS for vote in (-1, 0, 1)
        }
        prior = {(kind, truth): (seen[kind, truth] + 1.0) / (seen[kind, 0] + seen[kind, 1] + 2.0) for kind in GUESSED for truth in (0, 1)}
        for p in counts:
            odds = math.log(prior[p[0], 1] / prior[p[0], 0])
            odds += sum(math.log(table[p[0], 1, name, v] / table[p[0], 0, name, v]) for name, v in zip(LABELERS, p[2:]))
            likely[p] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return likely, table


def _names(p: tuple) -> list[str]:
    """Features of a pattern: each labeler's vote within its kind, the kind and the size."""
    return [p[0], f"size:{p[1]}", *[f"{p[0]}:{name}:{v}" for name, v in zip(LABELERS, p[2:]) if v]]


def train(counts: dict[tuple, int], rounds: int = 400) -> dict[str, float]:
    """Weights of the span classifier, fitted to the estimated likelihoods."""
    if not counts:
        return {}
    likely, _ = reliabilities(counts)
    total = sum(counts.values())
    # Kinds weigh alike, so that a rare one is learned as well.
    of_kind: dict = defaultdict(int)
    for p, n in counts.items():
        of_kind[p[0]] += n
    rows = [(_names(p), n / of_kind[p[0]] / len(of_kind), likely[p]) for p, n in sorted(counts.items())]
    w: dict[str, float] = defaultdict(float)
    assert total > 0
    for _ in range(rounds):
        slope: dict = defaultdict(float)
        for names, n, y in rows:
            q = 1 / (1 + math.exp(-sum(w[f] for f in names)))
            for f in names:
                slope[f] += n * (q - y)
        for f, g in slope.items():
            w[f] -= 2.0 * (g + 1e-4 * w[f])
    return dict(w)


def chance(facts: Column, weights: dict[str, float]) -> Column:
    """The classifier's probability of a candidate."""
    if not weights:
        return F.lit(0.0)
    score = F.lit(0.0)
    for kind in GUESSED:
        own = F.lit(float(weights.get(kind, 0.0)))
        for name in LABELERS:
            for vote in (1, -1):
                if (v := weights.get(f"{kind}:{name}:{vote}")) is not None:
                    own = own + F.when(facts[name] == vote, float(v)).otherwise(0.0)
        score = F.when(facts["kind"] == kind, own).otherwise(score)
    for size in range(-1, SIZES):
        if (v := weights.get(f"size:{size}")) is not None:
            score = score + F.when(facts["size"] == size, float(v)).otherwise(0.0)
    return 1 / (1 + F.exp(-score))


def spans(found: DataFrame, weights: dict[str, float], least: float = LEAST) -> DataFrame:
    """``doc_id, base, spans``: base spans, and those with the guessed ones, by start and kind."""
    orders = F.create_map(*[x for k, kind in enumerate(GUESSED) for x in (F.lit(kind), F.lit(len(KINDS) + k))])
    chosen = F.transform(
        F.filter("guesses", lambda g: chance(g, weights) >= least),
        lambda g: F.struct(g["start"].alias("start"), orders[g["kind"]].alias("order"), g["kind"].alias("kind"), g["end"].alias("end")),
    )
    return found.select("doc_id", "base", F.when(F.col("guesses").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", chosen))).alias("spans"))


def listed(spans_of: Column) -> Column:
    """Spans as ``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(spans_of, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, dict[str, float]]:
    """What was found in every document, and the classifier that the whole corpus gives."""
    found = written(find(docs, doc_id, text), "personal")
    return found, train(patterns(found))


def redact(docs: DataFrame, weights: dict[str, float], text: str = "text", least: float = LEAST) -> DataFrame:
    """``docs`` with each span replaced by its kind in angle brackets. Null texts stay null."""
    # The row travels as one field, so that no column of the user meets one of ours.
    df = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), text_of(F.col(f"`{text}`")).alias("__body"))
    df = _each_kind(df, "__body", lambda kind, _: F.lit(f"<{kind.upper()}>"))
    df = df.withColumn("__cut", _cut(F.col("__body"), CANDIDATE, HINT)).withColumn("__facts", _judged(F.col("__cut")))

    def new(hit: Column, i: Column) -> Column:
        facts = F.get(F.col("__facts"), i)
        return F.when(chance(facts, weights) >= least, F.concat(F.lit("<"), F.upper(facts["kind"]), F.lit(">"))).otherwise(hit)

    cleaned = F.when(F.col(f"row.`{text}`").isNotNull(), _put(F.col("__cut"), F.col("__body"), new))
    return df.select(*(cleaned.alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns))
