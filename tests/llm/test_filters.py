"""Extraction, classifier, personal data and the pipeline."""

import re
from html.parser import HTMLParser

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from marginalia.llm import html_extract, ordinal, pii, quality_rules, queries, simhash
from tests.llm.test_grouping_ops import check_packing, groups_of, slow_fingerprint, slow_shingles
from tests.llm.test_text_ops import ODD, measured, sha

# --- extraction ---

FURNITURE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body>
<div class="cookie-notice">We use cookies</div><header><h2>Site</h2><nav><a href=x>Home</a></nav></header>
<script>var t="</p>";</script><!-- <p>hidden</p> --><div id="sidebar"><p>%s</p></div>"""
TAIL = '<div class="comments"><p>First! nice article, long comment here to read</p></div><form><label>Name</label><input></form><footer>&copy; 2024</footer></body></html>'


def test_article_without_furniture():
    page = FURNITURE % ("aside " * 50) + "<article><h1>Big &amp; bold</h1><p>One <b>two</b>\n three&nbsp;x<br>four<p>Short.</p><div class=ad>Buy</div><ul><li>i1</li><li><a href=y>i2</a></li></ul></article>" + TAIL
    assert html_extract.main_text(page) == "Big & bold\nOne two three x four\nShort.\ni1\ni2"


def test_page_without_article_element():
    body = "".join(f"<p>Sentence number {i} of the running text is long enough.</p>" for i in range(9))
    page = FURNITURE % "x" + f'<div id="content"><h1>Head</h1>{body}</div><div><p>Tiny</p></div>' + TAIL
    assert html_extract.main_text(page) == "\n".join(["Head"] + [f"Sentence number {i} of the running text is long enough." for i in range(9)])


LONG = [f"Sentence number {i} of the running text is long enough." for i in range(9)]
PARAS = "".join(f"<p>{t}</p>" for t in LONG)


@pytest.mark.parametrize(
    "body, want",
    [
        (f"<div id=content><div><h1>Head</h1></div>{PARAS}<ul><li>a<li>b</ul><p>Short end.</p></div><div><p>Tiny</p></div>", ["Head", *LONG, "a", "b", "Short end."]),
        (f"<div id=content><div><div>{PARAS}</div></div><table><tr><td>x<td>y</table><div><p>Short end.</p></div></div>", [*LONG, "x", "y", "Short end."]),
        (f"<section><h2>One</h2><p>Brief.</p></section><section>{PARAS}</section><section><p>Last.</p></section>", ["One", "Brief.", *LONG, "Last."]),
        (f"<div><h1>Head</h1></div><div>{PARAS}</div><div><p>Tiny</p></div>", ["Head", *LONG]),
        (f"<div>{PARAS}</div><div><p>Between.</p></div><div>{PARAS}</div>", [*LONG, "Between.", *LONG]),
        (f"<h1>Head</h1>{PARAS}<div><dl><dt>t<dd>d</dl></div><p>End.</p>", ["Head", *LONG, "t", "d", "End."]),
    ],
)
def test_pages_of_div_and_section_keep_short_parts(body, want):
    assert html_extract.main_text(FURNITURE % "x" + body + TAIL).split("\n") == want


@pytest.mark.parametrize("page", ["", " ", "<", "<p", "a < b", "<!-- open", "<script>x", "</p></div>", "<nav>x</nav>", "<article>", "<p class='x>y"])
def test_broken_pages_do_not_crash(page):
    assert isinstance(html_extract.main_text(page), str)


def test_unclosed_furniture_ends_at_the_article():
    assert html_extract.main_text("<body><div class=ad>Buy<article><p>Text here.</article>") == "Text here."
    assert html_extract.main_text("<article><p>cut off he") == "cut off he"


COMMENTS = '<div id=comments><ol class=comment-list><li><article class=comment-body><p>%s</p></article></li><li><article><p>Me too</p></article></li></ol></div>' % ("I liked it. " * 30)
CARDS = "<div class=related><article class=card><h2>Teaser</h2><p>Read this one</p></article></div>"


def test_articles_inside_furniture_are_no_text():
    text = "\n".join(LONG)
    for extra in (COMMENTS, CARDS, COMMENTS + CARDS):
        assert html_extract.main_text(f"<body><div id=content>{PARAS}</div>{extra}</body>") == text
        assert html_extract.main_text(f"<body><article>{PARAS}{extra}</article></body>") == text
        assert html_extract.main_text(f"<body><article>{PARAS}</article>{extra}</body>") == text
    assert html_extract.main_text(f"<body><article>{PARAS}<article class=comment><p>Me</p></article></article>") == text
    # Furniture left open within a wrapper, and a page whose only text stands in such an article.
    assert html_extract.main_text(f"<body><div id=page><div class=ad>Buy<article>{PARAS}</article></div></body>") == text
    assert html_extract.main_text(f"<body><div class=widget><article>{PARAS}</article></div></body>") == text


def test_furniture_without_end_tag_ends_at_the_next_block():
    assert html_extract.main_text("<article><p class=ad>Buy<p>One.<p>Two.</article>") == "One.\nTwo."
    assert html_extract.main_text("<article><p class=ad>Buy<div>One.</div><h2>Two</h2></article>") == "One.\nTwo"
    assert html_extract.main_text("<article><ul><li class=share>Share<li>One<li><p>Two</ul><p>Three</article>") == "One\nTwo\nThree"
    assert html_extract.main_text("<article><ul><li class=share><ul><li>X</ul><div>Y</div><li>One</ul></article>") == "One"
    assert html_extract.main_text("<article><table><tr><td class=ad>Buy<td>One<tr><td>Two</table></article>") == "One\nTwo"


def test_pages_hold_their_documents(spark, folder):
    squeeze = lambda t: "".join((t or "").split())
    texts = {squeeze(r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.op2_html(spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/pages.parquet").count()
    for r in rows:
        assert r.n_chars == len(r.text)
        assert squeeze(r.text.split("\n", 1)[1]) in texts


class Plain(HTMLParser):
    """Text of the article of a well-meant page, block by block: no weights, no windows."""

    BLOCKS = frozenset("p h1 h2 h3 h4 ul ol li div article section blockquote pre table tr td th hr figure figcaption dl dt dd".split())
    OUT = frozenset("nav header footer aside form script style noscript".split())

    def __init__(self):
        super().__init__()
        self.blocks, self.inside, self.out = [[]], 0, []

    def handle_starttag(self, tag, attrs):
        names = " ".join(v or "" for k, v in attrs if k in ("class", "id"))
        if self.out or tag in self.OUT or re.search(r"\b(ad|ads|cookie|sidebar|comments|promo|share|related|newsletter)\b", names):
            self.out += [tag] if tag not in ("br", "img", "hr", "input", "meta", "link", "p", "li") else []
        elif tag == "br":
            self.handle_data(" ")
        self.inside += tag == "article"
        if tag in self.BLOCKS:
            self.blocks.append([])

    def handle_endtag(self, tag):
        if tag in self.out:
            while self.out.pop() != tag:
                pass
        self.inside -= tag == "article"
        if tag in self.BLOCKS:
            self.blocks.append([])

    def handle_data(self, data):
        if self.inside and not self.out:
            self.blocks[-1].append(data)

    @classmethod
    def text(cls, page):
        own = cls()
        own.feed(page)
        own.close()
        return "\n".join(t for t in (" ".join("".join(b).split()) for b in own.blocks) if t)


def test_extraction_equals_a_plain_parser(spark, folder):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    got = {r.page_id: r.text for r in queries.op2_html(spark, folder).collect()}
    assert got == {k: Plain.text(v or "") for k, v in pages.items()}


def test_no_page_hangs_on_its_article_tags(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    plain = pages.withColumn("html", F.regexp_replace("html", "(?i)<(/?)(article|main)\\b", "<$1div"))
    assert plain.filter("html rlike '(?i)<article'").count() == 0
    got, want = (sorted((r.page_id, r.text) for r in html_extract.extract(p).collect()) for p in (plain, pages))
    assert got == want and all(text for _, text in got)


def test_passages_decide_over_tags():
    # A teaser in an article is no match for running text ten times as long in plain containers.
    long = "".join(f"<p>{'A sentence of the text that runs on. ' * 20}{i}</p>" for i in range(9))
    page = f"<body><div id=content>{long}</div><article><p>See also.</p></article></body>"
    assert "See also" not in html_extract.main_text(page)
    assert html_extract.main_text(page).count("\n") == 8
    # Text within fewer pieces of named furniture outweighs any amount within more.
    page = f"<body><div class=widget><article><p>Short text.</p></article></div><div class=widget><div class=comments><article>{long}</article></div></div></body>"
    assert html_extract.main_text(page) == "Short text."
    # Only furniture: no text.
    assert html_extract.main_text(f"<body><nav>{long}</nav><div class=comments>{long}</div></body>") == ""


def test_passages_of_equal_sums_and_repeated_pages(spark):
    part = "<section><p>Words of one part.</p></section>"
    page = f"<body><div class=ad>Buy</div>{part}{part}{part}</body>"
    df = spark.createDataFrame([(1, page), (1, page), (2, "")], "page_id long, html string")
    got = sorted((r.page_id, r.text) for r in html_extract.extract(df).collect())
    assert got == [(1, "\n".join(["Words of one part."] * 3))] * 2 + [(2, "")]


def test_extraction_keeps_columns(spark):
    df = spark.createDataFrame([(1, None, "old"), (None, "", "old"), (2, "<p>" + "a " * 90000, "old")], "page_id long, html string, text string")
    got = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    assert got == {1: "", None: "", 2: ("a " * 90000).strip()}
    assert html_extract.extract(df.filter("false")).count() == 0


# --- classifier ---


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rated = queries.rated(spark, folder)
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(4))
    model = ordinal.fit(docs, rated.filter(fold > 0))
    assert model[1] == sorted(model[1])
    scored = ordinal.select(ordinal.score(docs, model)).join(rated.filter(fold == 0), "doc_id").collect()
    good = [r.kept for r in scored if r.grade == 2]
    bad = [not r.kept for r in scored if r.grade == 0]
    assert len(bad) > 50 and np.mean(good) > 0.98 and np.mean(bad) > 0.95
    means = [np.mean([r.expected_grade for r in scored if r.grade == g]) for g in range(3)]
    assert means[0] < means[1] < means[2]
    again = ordinal.fit(docs.repartition(5), rated.filter(fold > 0))
    assert again == model


def test_classifier_odd_rows(spark):
    rows = [(i, t, 1) for i, t in enumerate(ODD)] + [(None, "x", 1), (2, "again", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, grade int")
    ratings = spark.createDataFrame([(i, i % 3) for i in range(12)] + [(None, 1), (3, None), (77, 2)], "doc_id long, grade int")
    out = ordinal.select(ordinal.score(docs, ordinal.fit(docs, ratings))).collect()
    assert len(out) == len(rows) and all(0 <= r.expected_grade <= 2 for r in out)
    none = ordinal.select(ordinal.score(docs, ordinal.fit(docs, ratings.filter("false"))))
    assert all(r.kept and r.expected_grade is None for r in none.collect())
    assert ordinal.keep_good(docs.filter("false"), ratings).count() == 0
    assert ordinal.keep_good(docs, ratings).columns == docs.columns


# --- personal data ---

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(d))) % 10 == 0


def slow_base(text):
    out = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")), "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), order, kind, m.end()))
    return sorted(out)


TRICKY = [
    "a@b.c.d@e.f x_y@q.w", "a@b.c_d@e.f", "é🙂a.b+c@x-y.co.uk, 1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255", "4111 1111 1111 1111 and 4111-1111-1111-1111, 4111  1111",
    "+1 (234) 567-8901 ++49 170 1234567. +1.2 +123456789012345678", "1.2.3.4@5.6", "4539578763621486" * 3, "0" * 15, "+1 4111 1111 1111 1111", "@@ a@ @b.c a@b a@.c",
    "x" * 6000 + "@", "1" * 6000, "1." * 3000, "+1" + "(" * 6000, "a@b.cc " * 1500, "key = 9f86d081884c7d659a2feaa0c55ad015 on 2024-01-02, Dr Anna Smith",
]


def span_text(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)


def test_base_spans(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = {r.doc_id: r for r in queries.op6_pii(spark, folder).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        want = slow_base(t)
        assert got[i].base_sha256 == sha(span_text(want).encode())
        assert [got[i][f"n_{k}"] for k in PATTERNS] == [sum(s[2] == k for s in want) for k in PATTERNS]
        own = [x for x in got[i].spans.split(",") if x]
        assert [x for x in own if x.split(":")[0] in PATTERNS] == [x for x in span_text(want).split(",") if x]
        base = [(a, b) for a, _, _, b in want]
        for x in own:
            kind, a, b = x.split(":")
            assert kind in PATTERNS or not any(int(a) < e and s < int(b) for s, e in base)


def test_tricky_and_odd_texts(spark):
    texts = [*ODD, *TRICKY]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, TRICKY[0], "x"), (1, TRICKY[1], "x")], "doc_id long, text string, base string")
    rows = pii.spans(pii.find(df), {}).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        if r.doc_id is not None and r.doc_id != 1:
            assert [tuple(s) for s in r.base] == slow_base(texts[r.doc_id])
    found, weights = pii.fit(df)
    listed = {r.doc_id: r.s for r in pii.spans(found, weights).select("doc_id", pii.listed(F.col("spans")).alias("s")).collect()}
    at = TRICKY[-1].index("9f86")
    assert f"secret:{at}:{at + 32}" in listed[len(texts) - 1]
    assert pii.fit(df.filter("false"))[1] == {}


def test_reliabilities_follow_the_votes():
    counts = {("secret", 4, 1, 0, 1, 0, 1): 80, ("secret", 3, -0, 0, 0, -1, 0): 300, ("secret", 4, 1, 0, 0, 0, 1): 20, ("number", 2, 0, 0, 0, -1, -1): 50, ("number", 3, 1, 0, 1, 0, 1): 9}
    likely, table = pii.reliabilities(counts)
    assert likely["secret", 4, 1, 0, 1, 0, 1] > 0.9 and likely["secret", 3, 0, 0, 0, -1, 0] < 0.1
    assert table["secret", 1, "context", 1] > table["secret", 0, "context", 1]
    weights = pii.train(counts)
    score = lambda p: sum(weights.get(f, 0) for f in pii._names(p))
    assert score(("secret", 4, 1, 0, 1, 0, 1)) > 0 > score(("secret", 3, 0, 0, 0, -1, 0)) and score(("number", 3, 1, 0, 1, 0, 1)) > 0


def test_redaction_leaves_no_base_span(spark, folder):
    df = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame([(-1, None), *[(-2 - i, t) for i, t in enumerate(TRICKY)]], "doc_id long, text string"))
    _, weights = pii.fit(df)
    before = {r.doc_id: r.text for r in df.collect()}
    for r in pii.redact(df, weights).collect():
        if r.doc_id == -1:
            assert r.text is None
            continue
        if not slow_base(before[r.doc_id]) and not re.search("[0-9]{2}|[A-Za-z_-][0-9]|Dr", before[r.doc_id]):
            assert r.text == before[r.doc_id]
        assert slow_base(r.text) == []
    assert pii.redact(df, weights).columns == df.columns


def test_every_candidate_passes_the_hint(spark):
    texts = ["7KqwErtyUiopasDfghZx", "1 2 3 4 5 6 7 8 9", "a key: 7KqwErtyUiopasDfghZx.", "(1.2.3.4/5 6 7)", "Mr. Ömer Ünal", "Señora Ana", "-_Qwertyuiopasdfgh_1", "Abcdefghijklmnopqrst9"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    found = df.select("text", F.col("text").rlike(pii.CANDIDATE).alias("candidate"), F.col("text").rlike(pii.HINT).alias("hint")).collect()
    assert sum(r.candidate for r in found) >= 7 and all(r.hint for r in found if r.candidate)
    # Whether a span is found does not depend on what else stands in the text.
    cut = lambda t: pii._cut(t, pii.CANDIDATE, pii.HINT)["hits"]
    for r in df.select("text", cut(F.col("text")).alias("alone"), cut(F.concat("text", F.lit(" ; 12"))).alias("beside")).collect():
        assert (r.alone or []) == r.beside


def test_personal_data_stays_native(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for df in (pii.find(docs), pii.redact(docs, {"secret": 1.0})):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# --- pipeline ---


def slow_survivors(texts):
    """The smallest id of each group linked by two bits of the fingerprints or by a five-word similarity of 0.8."""
    ids = sorted(texts)
    marks, sets = [slow_fingerprint(texts[i]) for i in ids], [slow_shingles(texts[i]) for i in ids]
    near = lambda a, b: (marks[a] ^ marks[b]).bit_count() <= 2 or sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])
    return {ids[k] for k in groups_of(len(ids), [(a, b) for a in range(len(ids)) for b in range(a) if near(a, b)])}


def test_pipeline_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    out = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in out.collect()}
        out = corpus_pipeline.written(stage(spark, out, folder), name)
        assert out.columns == docs.columns
        after = {r.doc_id: r.text for r in out.collect()}
        if name == "quality_rules":
            base = {i for i, t in before.items() if (m := measured(t))[0] >= 50 and 100 * m[4] <= 50 * m[0]}
            assert set(after) <= base and len(after) > 0.5 * len(texts)
        if name == "near_duplicates":
            assert set(after) == slow_survivors(before)
        if name == "private_data":
            assert set(after) == set(before) and not any(slow_base(t) for t in after.values())
            assert all(r.n_chars == len(r.text) for r in out.collect())
        else:
            assert all(before[i] == t for i, t in after.items())
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lengths = {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in after.items()}
    check_packing(corpus_pipeline.STAGES[-1][1](spark, out, folder).collect(), lengths, 1024)


def test_pipeline_on_odd_rows(spark, folder):
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(ODD)] + [(None, None, None, None, None), (8, ODD[8], "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    for rows in (docs, docs.filter("false")):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, rows, folder).count() >= 0
    kept = simhash.keep_one(docs.unionByName(docs.filter("doc_id is null or doc_id = 4")))
    assert kept.columns == docs.columns
    assert kept.filter("doc_id = 4").count() == 1 and kept.filter("doc_id is null").count() == 0
    assert quality_rules.keep_good(docs).columns == docs.columns


def test_many_open_tags_are_read_in_linear_time():
    import time

    def seconds(n):
        page = "<div class=ad>" * n + "<article><h1>Head</h1>" + "<p>Text of the page.</p>" * n + "</article>"
        begin = time.perf_counter()
        assert html_extract.main_text(page).split("\n")[:2] == ["Head", "Text of the page."]
        return time.perf_counter() - begin

    seconds(1_000)
    assert seconds(40_000) < 12 * max(seconds(8_000), 0.05)


@pytest.mark.parametrize("part", ["<div class=ad><article>x", "<ul><li>x", "<div><p>x", "<li class=ad>x<ul>", "<div class=ad><p class=ad>x<section>"])
def test_deep_pages_are_read_in_linear_time(part):
    import time

    def seconds(n):
        begin = time.perf_counter()
        html_extract.main_text("<body>" + part * n + "<article><p>Text")
        return time.perf_counter() - begin

    seconds(1_000)
    assert seconds(40_000) < 12 * max(seconds(8_000), 0.05)


def test_formulas_stay():
    page = "<article><p>Before the formula <math><mi>x</mi><mo>=</mo><mn>1</mn></math> and after it.</p></article>"
    assert html_extract.main_text(page) == "Before the formula x=1 and after it."


def test_redact_with_clashing_names(spark):
    rows = [("write to a.b@example.org now", "b", 1, "c", "f"), (None, "b", 2, None, "f"), ("nothing", None, 3, "c", None)]
    df = spark.createDataFrame(rows, "text string, __body string, row long, __cut string, __facts string")
    got = sorted(map(tuple, pii.redact(df, {}).collect()), key=lambda r: r[2])
    assert got == [("write to <EMAIL> now", "b", 1, "c", "f"), rows[1], rows[2]]
    assert pii.redact(df, {}).columns == df.columns


def test_private_data_without_a_length_column(spark, folder):
    docs = spark.createDataFrame([(1, "call +49 170 1234567 now"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in corpus_pipeline.private_data(spark, docs, folder).collect()}
    assert got == {1: "call <PHONE> now", 2: None}
