"""Quality rules, toxicity, main text and URL rules."""

import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from helpers import awkward, empty, frame, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stationcast.llm import density, quality, toxicity, url_rules
from stationcast.llm.support import WORD, map_arrow


def test_batches_are_bounded(spark):
    df = spark.range(40).selectExpr("id", "repeat('x', 1000000) AS text").coalesce(1)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], ["n"])

    found = [r.n for r in map_arrow(df, sizes, "n long").collect()]
    assert sum(found) == 40 and max(found) <= 6


# ---------------------------------------------------------------- quality

def brute_measures(text):
    text = text or ""
    w = re.findall(WORD, text)
    grams = Counter(zip(w, w[1:], w[2:]))
    hit = {i + j for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(WORD, line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \n\t\x0b\x0c\r\x1c\x85\xa0 #é😀A", max_size=60))
def test_measures(text):
    assert quality.measure(text)[:5] == brute_measures(text)


def test_quality_verdicts(spark):
    rng = random.Random(2)
    rows = [(i, words(rng, 80, 9000), "en" if i % 2 else "de", f"s{i % 4}", 0, 0, 0.0, "k") for i in range(300)]
    junk = [(1000, " ".join(f"w{i}###" for i in range(90))), (1001, "same words again here\n" * 40), (1002, words(rng, 49, 9000)), (1003, " ".join("x" * 40 + str(i) for i in range(80)))]
    rows += [(i, t, "en", "s1", 0, 0, 0.0, "k") for i, t in junk]
    lone = [(2000, words(rng, 80, 9000), None, "only", 0, 0, 0.0, "k"), (2001, None, None, None, 0, 0, 0.0, "k")]
    got = {r.doc_id: r for r in quality.judge(frame(spark, rows + lone)).collect()}
    assert not any(got[i].kept for i in (1000, 1001, 1002, 1003, 2001)) and got[1001].base_failed and got[1002].base_failed and not got[1000].base_failed
    assert all(got[i].kept for i in range(300)) and got[2000].kept
    kept = quality.kept_documents(frame(spark, rows + lone))
    assert kept.columns == frame(spark).columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}
    assert quality.judge(empty(spark)).count() == 0 and quality.kept_documents(empty(spark)).count() == 0
    fences = [sorted(map(str, quality.cut_offs(quality.measured(frame(spark, rows + lone).repartition(n), ["lang", "source"])).collect())) for n in (1, 7)]
    assert fences[0] == fences[1] and len(fences[0]) > 4
    odd = frame(spark, rows + lone).withColumnsRenamed({"key": "_lang", "n_words": "_source", "score": "_fences"}).withColumn("_one", F.lit(1))
    assert quality.kept_documents(odd).columns == odd.columns and quality.kept_documents(odd).count() == kept.count()
    again = quality.judge(frame(spark, rows[:50] + [(1, None, None, None, 0, 0, 0.0, "k")] * 2))
    assert again.count() == 52
    assert quality.judge(frame(spark)).count() == len(awkward())


# ---------------------------------------------------------------- toxicity

def brute_segments(scores):
    """Ruzzo and Tompa's definition: the best segment, then the same left and right of it."""
    if not scores:
        return []
    best, span = 0.0, None
    for a in range(len(scores)):
        for b in range(a + 1, len(scores) + 1):
            s = sum(scores[a:b])
            if s > best + 1e-9:
                best, span = s, (a, b)
    if span is None:
        return []
    a, b = span
    left = brute_segments(scores[:a])
    right = [(x + b, y + b) for x, y in brute_segments(scores[b:])]
    return left + [span] + right


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([-3.7, -2.1, -1.3, -0.4, 0.9, 1.6, 2.3, 4.1]), max_size=12))
def test_maximal_segments(scores):
    got = toxicity.maximal_segments(scores)
    assert [round(s, 6) for *_, s in got] == [round(sum(scores[a:b]), 6) for a, b, _ in got]
    want = brute_segments(scores)
    assert len(got) == len(want) and sorted(round(sum(scores[a:b]), 6) for a, b in want) == sorted(round(s, 6) for *_, s in got)


def labelled(seed=1, n=600):
    rng, docs, labels = random.Random(seed), [], []
    for i in range(n):
        w, toxic = words(rng, rng.randrange(40, 120), 3000).split(), i % 8 == 0
        if toxic:
            at = rng.randrange(len(w))
            w[at:at] = rng.sample(["grubble,", "SNARKY", "vexor", "Grubble", "blarg"], rng.randrange(3, 6))
        docs.append((i, " ".join(w), "en", "s", 0, 0, 0.0, "k"))
        if i % 2 == 0:
            labels.append((i, int(toxic)))
    return docs, labels


def test_toxic_passages_are_found_on_unseen_rows(spark):
    docs, labels = labelled()
    docs += [(9000, None, "en", "s", 0, 0, 0.0, "k"), (9001, "", "en", "s", 0, 0, 0.0, "k"), (None, "a grubble vexor snarky", None, None, 0, 0, 0.0, "k")]
    labels += labels[:20] + [(77777, 1), (None, 1), (5, None)]
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.learn(frame(spark, docs), table)
    assert {b"grubble", b"snarky", b"vexor"} <= set(model.weights)
    got = {r.doc_id: r for r in toxicity.scored(frame(spark, docs), model, keep=("doc_id",)).collect()}
    for i, text, *_ in docs[:600]:
        assert (got[i].score >= 0.5) == (i % 8 == 0) and 0 <= got[i].score <= 1
    first = got[8].passages[0]
    span = toxicity.words_of(docs[8][1])[first["first"] : first["last"]]
    assert span[0] in model.weights and span[-1] in model.weights
    assert got[9000].score == got[9001].score < 0.5 and got[None].score >= 0.5
    clean = toxicity.clean_documents(frame(spark, docs), table)
    assert clean.columns == frame(spark).columns and {r.doc_id for r in clean.collect()} == {i for i, r in got.items() if r.score < 0.5}


def test_held_out_rows_are_not_learnt_from(spark):
    import zlib

    docs, labels = labelled()
    held = {i for i, *_ in docs if zlib.crc32(str(i).encode()) % 5 == 0}
    got = {r.doc_id for r in frame(spark, docs).filter(toxicity.held_out(F.col("doc_id"))).collect()}
    assert got == held
    flipped = [(i, 1 - y if i in held else y) for i, y in labels]
    a, b = (toxicity.learn(frame(spark, docs), spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, flipped))
    assert a == b


def test_toxicity_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.learn(frame(spark), none)
    assert all(r.score < 0.5 for r in toxicity.scored(frame(spark), model, keep=("doc_id",)).collect())
    assert toxicity.scored(empty(spark), model, keep=("doc_id",)).count() == 0
    assert toxicity.clean_documents(empty(spark), none).count() == 0
    one = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert all(r.score < 0.5 for r in toxicity.scored(frame(spark), toxicity.learn(frame(spark), one), keep=("doc_id",)).collect())


def test_decay_solves_its_equation():
    rates = {5.0: 1e-4, 2.0: 1e-3}
    x = toxicity._decay(rates, 0.1)
    assert sum(p * math.exp(x * s) for s, p in rates.items()) + (1 - 1.1e-3) * math.exp(-0.1 * x) == pytest.approx(1, abs=1e-6)


def test_each_toxic_passage_of_a_long_text_is_reported():
    bad = [b"grubble", b"snarky", b"vexor", b"blarg", b"crux"]
    model = toxicity.Model({**{w: 8.0 for w in bad}, b"calm": -3.0}, decay=1.0)
    insult = b" ".join(bad).decode()
    plain = [f"w{i}" for i in range(4000)]
    n, found = model.passages(" ".join([*plain[:200], insult, *plain[200:3200], insult, *plain[3200:]]), {})
    assert n == 4010 and [(a, b) for a, b, *_ in found] == [(200, 205), (3205, 3210)]
    assert found[0][2:] == pytest.approx(found[1][2:])
    # single uses before it take nothing from a passage
    n, found = model.passages(" ".join([x for w in bad for x in (w.decode(), *(["calm"] * 9))] + plain[:500] + [insult] + plain[500:]), {})
    assert (550, 555) in [(a, b) for a, b, *_ in found] and max(s for *_, s, _ in found) == pytest.approx(40)
    # a word of clean texts ends a passage, and repeats weigh less as evidence than new words
    assert [(a, b) for a, b, *_ in model.passages("grubble calm calm calm grubble", {})[1]] == [(0, 1), (4, 5)]
    once, many = insult, " ".join([insult] * 3)
    weigh = lambda t: model.evidence(1000, model.tempered(t, model.passages(t, {})[1], {}))
    assert weigh(once) < weigh(many) < 2 * weigh(once)


def test_clean_words_count_against_a_passage(spark):
    docs, labels = labelled()
    docs = [(i, t + " sunny meadow" if i % 8 else t, *rest) for i, t, *rest in docs]
    model = toxicity.learn(frame(spark, docs), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert model.weights[b"sunny"] < -1 and model.weights[b"meadow"] < -1 and model.weights[b"grubble"] > 0


# ---------------------------------------------------------------- main text

ARTICLE = "<h1>Tit&eacute;l</h1><p>First  para\n graph &amp; more.</p><p>Second <b>bold</b> words<br>here.<p>Third &lt;tag&gt; one"
TEXT = "Titél\nFirst para graph & more.\nSecond bold words here.\nThird <tag> one"


@pytest.mark.parametrize("page", [
    f"<html><body><nav><ul><li><a href=x>menu</a></ul></nav><article>{ARTICLE}</article><footer>foot</footer></body></html>",
    f"<body><div class='ad'>Buy now, this is a long advert with many words in it.</div><main>{ARTICLE}</main><aside>side bar text</aside>",
    f"<div id=cookie-notice>We use cookies</div><header><a href=/>Site</a></header><article>{ARTICLE}<section class=comments><p>reader says hi</p></section></article>",
    f"<script>if (a</b>) '<p>'</script><style>p{{}}</style><!-- <p>no</p> --><article>{ARTICLE}<form><input><p>join</p></form></article><noscript>x</noscript>",
    f"<ARTICLE><ul class='share-buttons'><li>share</li></ul>{ARTICLE}</ARTICLE><div role=\"complementary\">more</div></p></b></div>",
    f"<body><article><header>{ARTICLE.split('<p>')[0]}</header>{ARTICLE[ARTICLE.index('<p>'):]}</article><div hidden>gone</div>",
])
def test_main_text(page):
    assert density.main_text(page) == TEXT


def test_main_text_without_semantic_tags():
    links = "".join(f"<li><a href='/{i}'>link number {i}</a></li>" for i in range(30))
    paras = "".join(f"<p>{'long sentence of running text ' * 12}{i}.</p>" for i in range(6))
    page = f"<html><body><div><ul>{links}</ul></div><div><div>{paras}</div></div><div><ul>{links}</ul></div></body></html>"
    got = density.main_text(page)
    assert got.count("\n") == 5 and got.startswith("long sentence") and "link number" not in got


PARAS = [f"Paragraph {i} of running text that goes on for a while, as in any story that is told at length {i}." for i in range(6)]


@pytest.mark.parametrize("wrap", [
    '<p class="notice">{}</p>', '<div class="header"><p>{}</p></div>', '<div id="search"><p>{}</p></div>', '<div class="related"><p>{}</p></div>', "<form><p>{}</p></form>",
])
def test_names_alone_cut_no_running_text(wrap):
    paras = [f"<p>{x}</p>" for x in PARAS]
    paras[3] = wrap.format(PARAS[3])
    assert density.main_text(f"<body><nav><a href=x>menu</a></nav><article>{''.join(paras)}</article></body>") == "\n".join(PARAS)
    assert density.main_text(f"<body><nav><a href=x>menu</a></nav><div>{''.join(paras)}</div><footer>foot</footer></body>") == "\n".join(PARAS)


def test_names_that_cover_the_article_tell_nothing():
    widgets = "".join(f'<div class="elementor-widget elementor-widget-text-editor"><div class="elementor-widget-container"><p>{x}</p></div></div>' for x in PARAS)
    share = '<div class="elementor-widget elementor-widget-share-buttons"><a href=f>share</a></div>'
    for page in (f"<article>{widgets}{share}</article>", f"<body><div>{widgets}</div>{share}<footer>foot</footer></body>"):
        assert density.main_text(page) == "\n".join(PARAS)
    body = "".join(f"<p>{x}</p>" for x in PARAS)
    assert density.main_text(f"<body><form id=aspnetForm><div><a href=/>Site</a></div><div>{body}</div><div class=footer>foot</div></form></body>") == "\n".join(PARAS)


@pytest.mark.parametrize("attrs", ['href="/hidden-figures-review"', 'title="a hidden gem"', 'href="/p?id=related"', 'data-hidden="false"', "href=/p?class=ad", 'data-class="ad"'])
def test_values_are_not_read_as_attributes(attrs):
    assert density.main_text(f"<article><p>Words and <a {attrs}>words inside</a> sentences that stay whole, however they are linked.</p></article>") == \
        "Words and words inside sentences that stay whole, however they are linked."


def test_only_the_main_article_is_spared():
    body = "".join(f"<p>{x}</p>" for x in PARAS)
    teasers = "".join(f"<article><h3>Teaser {i}</h3><p>A few words on another story, number {i}, long enough to look like text.</p></article>" for i in range(3))
    for name in ("div class=related", "aside", "section id=comments"):
        assert density.main_text(f"<body><div class='page has-sidebar'><main>{body}</main><{name}>{teasers}</{name.split()[0]}></div></body>") == "\n".join(PARAS)
        assert density.main_text(f"<body><article>{body}<{name}>{teasers}</{name.split()[0]}></article></body>") == "\n".join(PARAS)
    assert density.main_text(f"<article>{body}<div hidden><p>{PARAS[0]}</p></div><p>End of it.</p></article>") == "\n".join([*PARAS, "End of it."])


def test_slash_of_an_unquoted_value_closes_nothing():
    links = "".join(f"<li><a href=/section{i}/>Section number {i}</a></li>" for i in range(20))
    body = "".join(f"<p>{p}</p>" for p in PARAS)
    for page in (f"<nav><ul>{links}</ul></nav><article>{body}</article>", f"<body><div class=top><ul>{links}</ul></div><div>{body}</div></body>"):
        assert density.main_text(page) == "\n".join(PARAS)
    assert density.main_text("<article><p>One<br/>two <b/>three</b></p><svg><path d=M0/><g/><text>x</text></svg><p>four</p></article>") == "One two three\nfour"


def test_quotes_open_values_only_behind_an_equals_sign():
    assert density.main_text("<p title=don't>First text here</p><p>It isn't > lost words</p>") == "First text here\nIt isn't > lost words"
    assert density.main_text("<article><p it's>One</p><p a = 'x > y' b=\"'>\">two</p><p =>three</p></article>") == "One\ntwo\nthree"
    assert density.main_text("<article><p>a</p><p title=\"open>b</p><p>c</p></article>") == "a\nb\nc"


@pytest.mark.parametrize("unit,end", [("<p it's ", ""), ("<p it's ", ">"), ("<a =\"x>y\" ", ""), ("<p a=\"", ""), ("<!x ", ""), ("<b/ c='", "x>"), ("<p ", "<p>x</p>")])
def test_broken_tags_take_linear_time(unit, end):
    import time

    density.main_text(unit * 100 + end)
    began = time.process_time()
    density.main_text(unit * 40_000 + end)
    assert time.process_time() - began < 1


def test_density_finds_the_article_without_its_element(spark):
    """The given pages, their `<article>` replaced by a plain element."""
    import html as entities

    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    wrong = 0
    for r in rows:
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = (" ".join(entities.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inner))
        plain = r.html.replace("<article>", "<div>").replace("</article>", "</div>")
        wrong += density.main_text(plain) != "\n".join(b for b in blocks if b)
    assert wrong <= len(rows) // 50, wrong


def test_main_text_of_odd_pages(spark):
    assert [density.main_text(x) for x in (None, "", "<p>", "<!-- ", "<script>x")] == [""] * 5
    assert density.main_text("plain < words & more") == "plain < words & more"
    assert density.main_text("<div>" * 20000 + "deep" + "</div>" * 20000) == "deep"
    assert density.main_text("<p a='" + "x" * 300000) == "<p a='" + "x" * 300000
    assert len(density.main_text("<article>" + "<p>word</p>" * 50000)) == 50000 * 5 - 1
    rows = [(1, "u", f"<article>{ARTICLE}</article>", "t", 3), (1, "u", f"<article>{ARTICLE}</article>", "t", 3), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = [tuple(r) for r in density.extract_main_text(df).collect()]
    assert got == [(1, "u", TEXT, len(TEXT))] * 2 + [(None, None, "", 0)]
    assert density.extract_main_text(df.limit(0)).count() == 0


# ---------------------------------------------------------------- URL rules

def brute_judge(url, rules, default):
    host, path = url_rules.split_url(url)
    fit = [(len(r), -i, r, v) for i, (v, r) in enumerate(rules)
           for h, p in [(r[: r.index("/")], r[r.index("/") :])] if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (max(fit)[2], max(fit)[3]) if fit else (None, default)


URLS = ["http://Example.ORG/es/x", "https://a.example.org/en/12?q#f", "http://example.org", "x", None, "", "http://notexample.org/es/", "ftp://com/fr/", "http://a.com/de/",
        "http://a.com/DE/", "http://.org/", "://org/x", "a://b://org/", "http://com/x.org/es/", "http://example.org/en/1", "http://user@example.org:80/es/", "http://é.org/é", "http://x.org/" + "y" * 100000]


def test_url_rules(spark):
    rules = url_rules.RULES + (("block", "org/"), ("allow", "net/a*b?"))
    df = spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(URLS + URLS[:3])], "page_id long, url string, host string, verdict int")
    got = {r.page_id: r for r in url_rules.judge_urls(df, rules=url_rules.RULES, default="block", batch_chars=50).collect()}
    assert len(got) == len(URLS) + 3
    for i, u in enumerate(URLS + URLS[:3]):
        assert (got[i].host, got[i].path) == url_rules.split_url(u) and (got[i].rule, got[i].verdict) == brute_judge(u, url_rules.RULES, "block"), u
    assert brute_judge("http://b.org/", rules, "x") == ("org/", "allow")
    assert url_rules.judge_urls(df.limit(0)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab/.*?", max_size=7), min_size=1, max_size=30), st.lists(st.text(alphabet="ab/.é", max_size=9), min_size=1, max_size=12))
def test_globs_match_like_patterns(globs, urls):
    def pattern(glob):
        return re.compile("".join({"**": "(?s:.*)", "*": "[^/]*", "?": "[^/]"}.get(p, re.escape(p)) for p in re.findall(r"\*\*|.", glob)) + r"\Z")

    globs = [re.sub(r"\*{3,}", "**", g) for g in globs]
    got = url_rules.first_rule(url_rules.compiled([(g, i) for i, g in enumerate(globs)]), urls, len(globs)).tolist()
    want = [next((i for i, g in enumerate(globs) if pattern(g).match(u)), len(globs)) for u in urls]
    assert got == want
