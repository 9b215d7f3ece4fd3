"""Toxicity, personal data, page text, licences and the pipeline on small tables."""

import random
import re
import time
import zlib
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from marketloom.llm import html_text, licences, pii, toxicity

DOCS = "doc_id long, text string, features string, probability string, spans string, label double, path string"


def table(spark, texts, schema=DOCS):
    return spark.createDataFrame([(i, t, "f", "p", "s", 1.0, "q") for i, t in enumerate(texts)], schema)


def labelled(n=400, seed=1):
    rng = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        body = [f"word{rng.randrange(200)}" for _ in range(30)]
        toxic = i % 4 == 0
        if toxic:
            body[5:5] = ["you", rng.choice(["idiot", "blorgon", "blorgons"])]
        texts.append(" ".join(body))
        labels.append((i, int(toxic)))
    return texts, labels


def test_toxicity_learns_and_scores_every_row(spark):
    texts, labels = labelled()
    docs = table(spark, [*texts, None, "", "!!! 123", "you blorgon " * 20_000])
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    scored = model.score(docs)
    assert scored.columns == [*docs.columns, "score"]
    got = {r.doc_id: r.score for r in scored.collect()}
    assert len(got) == docs.count() and all(0 <= s <= 1 for s in got.values())
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum((got[i] >= 0.5) == bool(labels[i][1]) for i in held)
    assert right / len(held) > 0.9 and got[403] >= 0.5 and got[400] < 0.5


def test_toxicity_without_labels_or_with_one_class(spark):
    docs = table(spark, ["a", None])
    none = spark.createDataFrame([(0, None), (None, 1)], "doc_id long, toxic int")
    assert [r.score for r in toxicity.fit(docs, none).score(docs).collect()] == [0.5, 0.5]
    one = spark.createDataFrame([(i, 0) for i in range(2)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.fit(docs, one).score(docs).collect()} <= {0.0, 0.5}


def test_features_are_bounded_for_odd_texts():
    for text in [None, "", "1 2", "É" * 10, "A", "\ud800 x"]:
        row = toxicity.features_of(text, {"x": 1.0}, set(), {"x"})
        assert len(row) == len(toxicity.FEATURES) and np.isfinite(row).all()


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, text):
    digits = re.sub(r"\D", "", text)
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def test_patterns_equal_their_expressions():
    rng = random.Random(5)
    alphabet = "0123456789..@@ab- +()_é\n"
    for _ in range(20_000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
        want = [(k, *m.span()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if valid(k, m[0])]
        assert pii.patterns(text) == sorted(want, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_viterbi_equals_all_paths():
    field = pii.fit(rounds=30)
    rng = np.random.default_rng(1)
    lengths = np.array([1, 3, 4])
    classes = np.zeros((3, 4), np.int64)
    for i, n in enumerate(lengths):
        classes[i, :n] = rng.integers(1, len(pii.CLASSES), n)
    e, paths = field.emissions(classes), field.decode(classes, lengths)
    for i, n in enumerate(lengths):
        score = lambda p: sum(e[i, t, y] for t, y in enumerate(p)) + sum(field.steps[a, b] for a, b in zip(p, p[1:]))  # noqa: B023, E731
        best = max(product(range(len(pii.LABELS)), repeat=int(n)), key=score)
        assert np.isclose(score(tuple(paths[i, :n])), score(best))


def test_field_learns_its_table_and_finds_names(spark):
    docs = table(spark, ["my name is Rosa Lopez , call +1 (017) 555-7713 or a.b@c.example.org", None, "", "The Name of this is plain", "x " * 50_000 + "1.2.3.4"])
    found = {r.doc_id: [(s.kind, s.base) for s in r.spans] for r in pii.find(docs.drop("spans")).collect()}
    assert found[0] == [("name", False), ("phone", True), ("email", True)]
    assert found[1] == found[2] == found[3] == [] and found[4] == [("ip", True)]
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert clean[0] == "my name is [NAME] , call [PHONE] or [EMAIL]" and clean[1] is None and clean[4].endswith("x [IP]")
    assert pii.find(docs.filter("doc_id > 99")).count() == 0


def test_field_reads_whole_lines_and_every_line_with_a_cue():
    field = pii.fit()
    spans = lambda text: [(k, text[a:b]) for k, a, b, base in pii.find_in([text], field)[0] if not base]
    assert spans("e-mail : ada at example dot org") == [("email", "ada at example dot org")]
    assert spans("email me at ada at example dot org") == [("email", "ada at example dot org")]
    assert spans("a plain line\nName:Ada Lovelace was here") == [("name", "Ada Lovelace")]
    # What is found is what the field says of the whole line, for every row of its own table.
    for text, marked in pii.labelled_table():
        ((classes, labels),) = pii._training_rows([(text, marked)])
        assert field.decode(np.array([classes]), np.array([len(classes)]))[0].tolist() == labels
        words = pii.chunks(text)
        inside = {k for k, (a, b, _) in enumerate(words) for _, x, y, _ in pii.find_in([text], field)[0] if x < b and a < y}
        assert {k for k, y in enumerate(labels) if y} <= inside
    for c in pii.ANNOUNCING:
        assert pii.announces(f"of the:({c.upper()}):x")
    assert pii.announces("x²") and not pii.announces("of the named-thing: plain")


def test_field_decides_every_line_also_without_a_cue():
    states, name = np.zeros((len(pii.OFFSETS), len(pii.CLASSES), len(pii.LABELS))), pii.LABELS.index("name")
    states[pii.OFFSETS.index(0), pii.CLASS["capital"], name] = 1
    field = pii.Field(states, np.zeros((len(pii.LABELS),) * 2))
    text = "of the (Rosa Lopez) here\n\n \nplain\r\nan Otto " + "x " * 20 + "Ada:"
    spans = [(k, text[a:b]) for k, a, b, _ in pii.find_in([None, text], field)[1]]
    assert spans == [("name", "Rosa Lopez"), ("name", "Otto"), ("name", "Ada")]
    # Lines of one batch are decided as they are alone.
    lines = ["is is is is of it", "Ada wrote", "At At At At", "x " * 300 + "Mr Jan Novak"]
    field, alone = pii.fit(), []
    for line in lines:
        alone += [s[:3] for s in pii.find_in([line], field)[0]]
    at = np.cumsum([0, *[len(x) + 1 for x in lines]])
    whole = [(k, a - at[np.searchsorted(at, a, "right") - 1], b - a) for k, a, b, _ in pii.find_in(["\n".join(lines)], field)[0]]
    assert whole == [(k, a, b - a) for k, a, b in alone] and alone


def test_long_lines_decode_as_one_piece(monkeypatch):
    field = pii.fit(rounds=30)
    classes = np.random.default_rng(3).integers(1, len(pii.CLASSES), (3, 700))
    lengths = np.array([700, 513, 20])
    whole = field.decode(classes, lengths)
    for slab in (7, 10_000):
        monkeypatch.setattr(pii, "SLAB", slab)
        assert (field.decode(classes, lengths) == whole).all()


PAGE = """<html><head><title>t</title><style>p{{}}</style></head><body class="x"><nav><ul><li>menu</ul></nav>
<div class="cookie-notice">we use cookies</div><div class="wrap no-sidebar"><div class="post-{n} content"><h1>Head &amp; line</h1>
<p>One <b>two</b>&nbsp;three<br>four<p>Five &lt;x&gt; <a href="q">link</a></div><aside>side</aside>
<section id="comments"><p>{c}</p></section></div><form><p>your name</p></form><script>var a="</p>";</script><footer>foot</footer></body></html>"""


def test_page_text_follows_the_host(spark):
    odd = [None, "", "plain text", "<div", "<!-- open", "<p>x", "<script>x", "<div>" * 3000 + "deep"]
    htmls = [PAGE.format(n=n, c="A long reader comment " * 40 * (n == 7)) for n in range(8)] + odd
    rows = [(i, f"https://Site.example/{i}" if i < 8 else [None, "no url", "http://h/x"][i % 3], h, "t", "h", "p") for i, h in enumerate(htmls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, host string, path string")
    got = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    want = "Head & line\nOne two three four\nFive <x> link"
    assert len(got) == len(rows) and all(got[i] == want for i in range(8))
    assert [got[i] for i in range(8, 16)] == ["", "", "plain text", "<div", "", "x", "", "deep"]
    paths = {r.host: r.path for r in html_text.host_paths(pages).collect()}
    assert paths["site.example"] == "div.no-sidebar.wrap>div.content.post-N"
    assert html_text.extract(pages.filter("page_id > 99")).count() == 0


def test_articles_are_found_without_votes():
    page = "<article><header><h1>T</h1></header><p>a</p><div class='ad'>buy</div><ul><li>i</li><li>j</ul></article><div><p>" + "other " * 9 + "</p></div>"
    assert html_text.main_text(page, "article") == "T\na\ni\nj"
    assert html_text.main_text(page, "div.absent") in ("T\na\ni\nj", ("other " * 9).strip())


LEAD, CLOSING = "A lead of some length that runs on. " * 4, "The closing words that end this page."


def _sections(n, quotes=0):
    parts = "".join(f"<div class='section'><h2>Part {i}</h2><p>{f'What part {i} says at length. ' * 8}</p></div>" for i in range(n))
    quoted = "".join(f"<blockquote><p>{'A long quotation. ' * 40}</p></blockquote>" for _ in range(quotes))
    return f"<body><div class='links'><a href='a'>one</a> <a href='b'>two</a></div><div class='content'><h1>Title</h1>{LEAD}{parts}{quoted}<p>{CLOSING}</p></div></body>"


@pytest.mark.parametrize("quotes", [0, 2])
@pytest.mark.parametrize("n", [0, 2, 4, 20])
def test_enclosing_text_is_kept_with_any_number_of_sections(spark, n, quotes):
    rows = [(i, "http://h/x", _sections(n, quotes)) for i in range(3)]
    got = {r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    parts = [line for i in range(n) for line in (f"Part {i}", (f"What part {i} says at length. " * 8).strip())]
    want = "\n".join(["Title", LEAD.strip(), *parts, *[("A long quotation. " * 40).strip()] * quotes, CLOSING])
    assert got == {want}


def test_names_of_headings_and_sections_keep_their_text():
    kept = [
        "<h2 id='related-work'>a</h2>", "<section id='search-methods'><p>b</p></section>", "<h3 id='copyright'>c</h3>", "<p id='reply-3'>d</p>",
        "<section class='notice'><p>e</p></section>", "<p class='share'>f</p>",
    ]
    gone = [
        "<div class='ad'>buy</div>", "<div class='comment-list'><p>me too</p></div>", "<section id='comments'><p>no</p></section>", "<form><p>mail</p></form>",
        "<div class='search'><input name='q'>find</div>", "<ul class='social-links'><li><a href='x'>tell</a></ul>", "<div id='sidebar-left'>side</div>",
        "<p hidden>x</p>", "<nav>n</nav>",
    ]
    body = "".join(k + g for k, g in zip(kept, gone)) + "".join(gone[len(kept) :])
    assert html_text.main_text(f"<body><article><h1>T</h1>{body}</article></body>", None) == "T\na\nb\nc\nd\ne\nf"
    # Outside an article: names of headings say nothing, classes with such a word do.
    page = f"<body><div class='content'><h1 class='header'>T</h1><p>{LEAD}</p><h2 id='related-work'>R</h2></div><div class='x-footer'>foot</div></body>"
    assert html_text.main_text(page, None) == f"T\n{LEAD.strip()}\nR"


def test_made_pages_are_read_back():
    rng = random.Random(5)
    words = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(n))
    for _ in range(60):
        want, inner = [], ""
        for _ in range(rng.randint(1, 12)):
            text = words(rng.randint(8, 60))
            want.append(text)
            block = f"<{(t := rng.choice(['p', 'li', 'h2', 'blockquote']))}>{text}</{t}>"
            inner += rng.choice([block, f"<div class='part'>{block}</div>", f"<section>{block}</section>"])
        noise = rng.choice(["<div class='ad'>buy this now</div>", "<aside><p>" + words(30) + "</p></aside>", "<div><a href='x'>" + words(9) + "</a></div>"])
        page = f"<body>{noise}<div class='text'>{inner}</div>{noise}<footer>{words(20)}</footer></body>"
        assert html_text.main_text(page, None) == "\n".join(want)


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "</p>" * 100_000, "<div>" * 50_000 + "<p>x</div>" * 50_000, "<li>x" * 100_000, "</x>" * 200_000])
def test_reading_is_linear_in_the_tags(page):
    began = time.monotonic()
    html_text.votes(page)
    html_text.main_text(page, "div")
    assert time.monotonic() - began < 20


@pytest.fixture(scope="module")
def model(spark):
    return licences.fit(spark)


def test_words_of_a_paragraph_are_cut_once(spark, model):
    long = "Licensed under the MIT License. " + "word " * 5000
    scored = model.classify(table(spark, [long]).select("doc_id", "text"), "text").filter(F.col("family") != licences.UNKNOWN)
    # A filter on the family must not carry the cutting of words into the loop over n-grams.
    assert scored._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") <= 2
    assert licences.scan(table(spark, [long, long[:31]]), model=model).filter("id = 1 and family = 'MIT'").count() == 1


def test_licences_are_named_and_confirmed(spark, model):
    texts = [
        "Some prose.\nLicensed under CC BY-NC 4.0.\nMore", "This work is licensed under the GNU General Public License, version 3.", "Released under the MIT License.",
        "Licensed under the Apache License, Version 2.0.", "You need a driving licence to drive", "the copyright of the song", None, "", "x " * 100_000,
        "Released under the MIT License.",
    ]
    found = licences.scan(table(spark, texts), model=model)
    got = sorted((r.id, r.paragraph, r.family, r.confirmed) for r in found.collect())
    assert got == [(0, 1, "CC-BY-NC", True), (1, 0, "GPL-3.0", True), (2, 0, "MIT", True), (3, 0, "Apache-2.0", True), (9, 0, "MIT", True)]
    assert licences.scan(table(spark, texts).filter("doc_id > 99"), model=model).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_every_notice_is_scored_in_documents(spark, model):
    notices = [(t, f) for t, f, _ in licences.labelled_rows() if f != licences.UNKNOWN]
    frame = spark.createDataFrame([(i, t, f) for i, (t, f) in enumerate(notices)], "doc_id long, text string, name string")
    assert frame.filter(~licences.asked(F.col("text"))).count() == 0
    alone = model.classify(frame, "text").filter(F.col("family") != licences.UNKNOWN).select("doc_id", "family").collect()
    found = licences.scan(frame, model=model).select("id", "family").collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, alone))
    assert {"Released under the MIT.", "See the MIT for details.", "Distributed under the terms of the ISC."} <= {notices[r.id][0] for r in found}


def test_held_out_notices_get_no_wrong_family(spark, model):
    rows = [(t, f) for t, f, part in licences.labelled_rows() if part]
    frame = spark.createDataFrame(rows, "text string, name string")
    out = model.classify(frame, "text").select("name", "family").collect()
    assert not [r for r in out if r.family not in (r.name, licences.UNKNOWN)]
    assert sum(r.family == r.name for r in out) / len(out) > 0.7


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, sf)
        if name != "packing":
            assert after.columns == docs.columns
            before, kept = {r.doc_id for r in docs.select("doc_id").collect()}, [r.doc_id for r in after.select("doc_id").collect()]
            assert set(kept) <= before and len(kept) == len(set(kept)) and len(kept) > 0.7 * len(before)
            after = corpus_pipeline.Stage(spark, "test").keep(name, after)
            docs = after
    ends = after.groupBy("doc_id").agg(F.max(F.col("start") + F.col("length")).alias("n"))
    assert ends.count() == docs.count()
    assert not docs.filter("text rlike '[0-9]{1,3}([.][0-9]{1,3}){3}|@[a-z0-9]+[.]example'").count()
    assert entry.queries()["pipeline"] is corpus_pipeline.run
