"""Operators that answer row by row, against plain Python on small tables and on the test data."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import SF_DIR

from viewlog.llm import byte_bpe, fm_quality, html_mincut, language_id, license_rules, quality_rules
from viewlog.llm.queries import all_queries
from viewlog.llm.tables import HELD_OUT_OF

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string, Score int"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def docs(spark, *texts):
    return spark.createDataFrame(
        [(number, text, "en", None, None, "x", 1) for number, text in enumerate(texts)], SCHEMA)


def by_id(frame):
    return {row["doc_id"]: row for row in frame.collect()}


def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


ODD = [None, "", " \t\n", "a", "the the the the the", "x" * 200_000, "É 漢字   𝒳 é́", "a\x00b \x0b c", "a b c\na b c\na b c"]


# --- Quality rules --------------------------------------------------------------------------------


def plain_statistics(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[at:at + 3]) for at in range(len(words) - 2)]
    often = Counter(windows)
    covered = {at + step for at, window in enumerate(windows) if often[window] > 1 for step in range(3)}
    lines = [line for line in text.split("\n") if WORDS.search(line)]
    return (len(words), sum(map(len, words)), sum(text.count(one) for one in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered))


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_statistics_of_odd_texts(spark):
    found = by_id(quality_rules.text_statistics(docs(spark, *ODD)))
    for number, text in enumerate(ODD):
        assert tuple(found[number][name] for name in NAMES) == plain_statistics(text), text


def test_statistics_of_the_test_data(spark):
    texts = {row["doc_id"]: row["text"] for row in documents(spark).collect()}
    found = by_id(all_queries()["op2_quality_rules"](spark, SF_DIR))
    assert len(found) == len(texts)
    for doc_id, text in texts.items():
        row = found[doc_id]
        assert tuple(row[name] for name in NAMES) == plain_statistics(text)
        failed = row["n_words"] < 50 or 100 * row["n_repeat_words"] > 50 * row["n_words"]
        assert row["base_failed"] == failed
        assert not (failed and row["kept"])


def cloud(spark, rows):
    """Rows of whole-unit statistics in one group."""
    return spark.createDataFrame(
        [("=en", "=a", number % 2, *map(int, row)) for number, row in enumerate(rows)],
        ["cell_lang", "cell_source", "slot", *quality_rules.STATISTICS])


def test_estimate_ignores_a_fifth_of_outliers(spark):
    chance = np.random.default_rng(1)
    good = chance.multivariate_normal([5, 2, 1, 1], np.diag([1.0, 0.5, 0.7, 0.6]) ** 2, 800)
    bad = chance.multivariate_normal([9, 5, 6, 4], np.eye(4) * 0.01, 200)
    rows = cloud(spark, np.round(np.concatenate([good, bad]) * quality_rules.UNITS))
    estimate = quality_rules.robust_estimates(rows).collect()[0]
    centre = [estimate[f"m{i}"] for i in range(4)]
    assert np.allclose(centre, [5, 2, 1, 1], atol=0.15)
    limit = quality_rules._chi2_beyond(quality_rules.CUTOFF, 4)
    marked = quality_rules.with_distance(rows.crossJoin(quality_rules.robust_estimates(rows).select(*quality_rules.ESTIMATE)))
    far = [row["distance"] > limit for row in marked.orderBy("x_words", "x_symbols").collect()]
    assert sum(far) == 200


def test_estimate_equals_numpy_on_all_rows(spark):
    chance = np.random.default_rng(2)
    data = np.round(chance.normal(3, 1, (300, 4)) * quality_rules.UNITS)
    every = quality_rules._estimate(cloud(spark, data).groupBy(*quality_rules.GROUP).agg(*quality_rules._sums()), quality_rules.GROUP, 1.0)
    row = every.collect()[0]
    scaled = data / quality_rules.UNITS
    cov = np.cov(scaled.T, bias=True) + np.eye(4) * quality_rules.SPREAD_FLOOR ** 2
    lower = np.linalg.cholesky(cov)
    for i in range(4):
        assert row[f"m{i}"] == pytest.approx(scaled[:, i].mean())
        for j in range(i + 1):
            assert row[f"l{i}_{j}"] == pytest.approx(lower[i, j])


def test_chi_square():
    assert quality_rules._chi2(quality_rules._chi2_beyond(0.25, 4), 4) == pytest.approx(0.75)
    assert quality_rules._chi2_beyond(0.05, 4) == pytest.approx(9.4877, abs=1e-3)
    assert quality_rules.consistency(1 - 1e-12) == pytest.approx(1.0, abs=1e-6)


def test_small_groups_are_judged_by_the_base(spark):
    plain = " ".join(f"word{n}" for n in range(60))
    found = by_id(quality_rules.quality_rules(docs(spark, plain, "few words", None)))
    assert [found[n]["kept"] for n in range(3)] == [True, False, False]
    assert found[0]["distance"] is None


def test_chi_square_of_any_degrees():
    assert quality_rules._chi2_beyond(0.05, 1) == pytest.approx(3.8415, abs=1e-3)
    assert quality_rules._chi2_beyond(0.001, 5) == pytest.approx(20.515, abs=1e-3)


def test_repetition_alone_and_a_few_symbols_are_rejected(spark):
    chance = np.random.default_rng(3)

    def lines(count):
        return [" ".join("".join(chance.choice(list("abcdefgh"), 5)) for _ in range(8)) for _ in range(count)]

    texts = ["\n".join(lines(chance.integers(15, 60))) for _ in range(120)]
    short_line = "\n".join(x for line in lines(30) for x in (line, "read more"))
    phrase = "\n".join([*lines(25), " ".join(["one two three four"] * 20)])
    symbols = "\n".join(line + " ##" for line in lines(30))
    found = by_id(quality_rules.quality_rules(docs(spark, *texts, short_line, phrase, symbols)))
    assert not any(found[n]["base_failed"] for n in range(len(found)))
    assert [found[120 + n]["kept"] for n in range(3)] == [False, False, False]
    assert sum(found[n]["kept"] for n in range(120)) >= 117


def test_no_rows(spark):
    empty = documents(spark).limit(0)
    assert quality_rules.quality_rules(empty).collect() == []
    assert license_rules.license_scan(empty).collect() == []
    assert language_id.predictions(empty).collect() == []
    assert fm_quality.scores(empty, spark.read.parquet(f"{SF_DIR}/labels.parquet").limit(0)).collect() == []
    assert html_mincut.extract_pages(spark.read.parquet(f"{SF_DIR}/pages.parquet").limit(0)).collect() == []


# --- HTML extraction ------------------------------------------------------------------------------

FULL_PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<header class="site-header"><a href="/">Site name</a> <p>Our slogan is long enough to look like a sentence, is it not?</p></header>
<nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies to make this site better for you. Please agree to them.</p></div>
<div class="ad">Buy this thing now, it is the best thing that you can buy today.</div>
<main><article><header><h1>The heading &amp; more</h1></header>
<p>First   paragraph of the article,<br>with a break and an &eacute; in it. It has several words.</p>
<div class="advert">Another advert inside the article, with a full sentence in it.</div>
<p>Second paragraph with <a href="/x">a link</a> and <b>bold words</b>.
<p>Unclosed third one.
<ul><li>First point</li><li>Second point</li></ul>
<table><tr><td>Cell one</td><td>Cell two</td></tr></table>
<form action="/s"><input name="q"><label>Your mail address please</label><button>Send</button></form>
<section class="comments"><article class="comment"><p>I am a reader, and I think that this is a very good article.</p></article></section>
</article></main>
<aside><p>Sidebar text about something else that is rather long, to be sure.</p></aside>
<footer>&copy; 2024 Site name &middot; All rights reserved</footer></body></html>"""


def test_a_page_with_everything():
    assert html_mincut.main_text(FULL_PAGE) == (
        "The heading & more First paragraph of the article, with a break and an é in it. It has several words. "
        "Second paragraph with a link and bold words . Unclosed third one. First point Second point Cell one Cell two"
    ).replace("words .", "words.")


@pytest.mark.parametrize("cut", range(0, len(FULL_PAGE), 37))
def test_pages_may_end_anywhere(cut):
    text = html_mincut.main_text(FULL_PAGE[:cut])
    assert "<" not in text
    assert "slogan" not in text or cut < 400


def test_plain_layout_without_an_article():
    page = ("<html><body><div id='menu'><a href='1'>Home</a> <a href='2'>News</a></div><div id='content'>"
            + "<p>A long paragraph that says many things, one after the other, and ends like a sentence does.</p>" * 3
            + "</div><div id='footer'>Imprint and contact</div></body></html>")
    assert html_mincut.main_text(page).count("A long paragraph") == 3
    assert "Imprint" not in html_mincut.main_text(page)
    assert "Home" not in html_mincut.main_text(page)


LONG = "<p>A long paragraph that says many things, one after the other, and ends like a sentence does.</p>"


@pytest.mark.parametrize("wrapper", [
    "layout has-sidebar", "notice", "search-layout", "follow legal", "register form", "related", "with-toc tags"])
def test_wrappers_of_most_sentences_are_no_boilerplate(wrapper):
    page = (f"<body><div class='{wrapper}'><div id='content'>{LONG * 3}</div><div class='sidebar'><p>Short one.</p></div></div>"
            "<div class='cookie-notice'><p>We use cookies to make this site better for you.</p></div></body>")
    text = html_mincut.main_text(page)
    assert text == " ".join([re.sub("<.*?>", "", LONG)] * 3)


PLAIN = re.sub("<.*?>", "", LONG)


@pytest.mark.parametrize("inner", [f"<div id='content'>{LONG * 3}</div>", f"<main>{LONG * 3}</main>", LONG * 3])
def test_a_form_around_the_page_is_no_boilerplate(inner):
    page = (f"<body><form id='aspnetForm' action='x'><div id='menu'><a href='1'>Home</a></div>{inner}"
            "<footer>Imprint</footer></form></body>")
    assert html_mincut.main_text(page) == " ".join([PLAIN] * 3)
    inside = f"<main><h1>Title</h1><form>{LONG * 3}</form><form class='search'><p>Search for it here.</p></form></main>"
    assert html_mincut.main_text(inside) == " ".join(["Title"] + [PLAIN] * 3)
    hidden = f"<body><form style='display:none'>{LONG * 3}</form><div>{LONG}</div></body>"
    assert html_mincut.main_text(hidden) == PLAIN


@pytest.mark.parametrize("opening", [
    "<section id='related-work'>", "<section id='search'>", "<div class='section' id='register-allocation'>",
    "<section id='discussion-2'>", "<section id='legal'>", "<section><h2 id='share-prices'>"])
def test_ids_made_from_headings_are_no_boilerplate(opening):
    page = f"<body><main>{opening}{LONG}<p>Another one follows here.</p></section></main></body>"
    assert html_mincut.main_text(page).startswith(PLAIN)
    assert html_mincut.main_text(page.replace("main>", "article>")).startswith(PLAIN)


@pytest.mark.parametrize("name", ["id='comments'", "id='related-posts'", "class='search' id='x'", "id='newsletter'"])
def test_ids_that_say_boilerplate_as_a_whole(name):
    page = f"<body><article>{LONG * 2}<section {name}><p>Something else that is said here.</p></section></article></body>"
    assert html_mincut.main_text(page) == f"{PLAIN} {PLAIN}"


@pytest.mark.parametrize("start, end", [
    ("<div>", ""), ("<span>", "<p>x"), ("<div>", "</p>"), ("<a><p><span>", "</a>"), ("<div class='ad'>", "<p>A b."), ("<form>", "x")])
def test_time_grows_with_the_page_whatever_is_open(start, end):
    def seconds(size):
        page = "<body>" + (start + "text ") * size + end * size
        begun = time.process_time()
        html_mincut.blocks_of(page)
        html_mincut._wrappers([(block, "A b.") for block in html_mincut.blocks_of(page)], False)
        return time.process_time() - begun

    seconds(1000)
    assert seconds(40_000) < 40 * max(seconds(4_000), 0.02)


def test_head_need_not_end():
    page = f"<html><head><title>T</title><meta charset=utf-8><script>'<p>no'</script><body><article>{LONG}</article>"
    assert html_mincut.main_text(page) == re.sub("<.*?>", "", LONG)


@pytest.mark.parametrize("name", ["button", "select", "object", "svg", "map", "audio", "video"])
def test_controls_need_not_end(name):
    wanted = re.sub("<.*?>", "", LONG)
    assert wanted in html_mincut.main_text(f"<body><article><{name}>{LONG}</article>")
    page = f"<body><article><div><{name}>Lost</div>{LONG}</article><{name}>x</{name}>"
    assert html_mincut.main_text(page) == wanted


def test_formulas_are_text():
    page = "<body><article><p>It is known that <math><mi>a</mi><mo>=</mo><mi>b</mi></math> holds here.</p></article>"
    assert html_mincut.main_text(page) == "It is known that a=b holds here."


def test_pages_of_the_test_data(spark):
    """The pages of the test data hold one article each; everything else is to go."""
    import html

    pages = {row["page_id"]: row["html"] for row in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    found = all_queries()["op4_html_extraction"](spark, SF_DIR).collect()
    assert len(found) == len(pages)
    for row in found:
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[row["page_id"]], re.S)[1]
        plain = " ".join(html.unescape(re.sub(r"<[^>]*>?", " ", inner)).split())
        assert row["text"] == plain
        assert row["n_chars"] == len(plain)


def test_odd_pages(spark):
    pages = spark.createDataFrame(
        [(1, "u", None), (2, None, ""), (None, "u", "no markup at all, but a sentence that goes on for a while and then ends."),
         (4, "u", "<p>" * 3000 + "deep"), (5, "u", "<a href='x>broken quote <p>text"), (6, "u", "a < b & c > d &am &#x41;")],
        "page_id bigint, url string, html string")
    found = {row["page_id"]: row for row in html_mincut.extract_pages(pages.withColumn("text", pages["url"])).collect()}
    assert found[1]["text"] == "" and found[1]["n_chars"] == 0 and found[2]["text"] == ""
    assert found[None]["text"].startswith("no markup")
    assert html_mincut.blocks_of("a < b & c > d &am &#x41;")[0].text == "a < b & c > d &am A"


def cheapest(odds, edges):
    """The cost of the best labelling, by trying all."""
    best = math.inf
    for mask in range(1 << len(odds)):
        label = [bool(mask >> n & 1) for n in range(len(odds))]
        best = min(best, cost(odds, edges, label))
    return best


def cost(odds, edges, label):
    own = sum(max(0.0, -odd) if content else max(0.0, odd) for odd, content in zip(odds, label))
    return own + sum(weight for a, b, weight in edges if label[a] != label[b])


def test_minimum_cut_is_minimal():
    chance = np.random.default_rng(3)
    for _ in range(200):
        count = int(chance.integers(1, 10))
        odds = list(chance.normal(0, 1, count))
        edges = [(int(a), int(b), float(chance.random() * 2)) for a, b in chance.integers(0, count, (12, 2)) if a != b]
        assert cost(odds, edges, html_mincut.minimum_cut(odds, edges)) == pytest.approx(cheapest(odds, edges))


# --- Quality classifier ---------------------------------------------------------------------------


def test_pairs_by_the_sum_of_squares():
    chance = np.random.default_rng(4)
    machine = fm_quality.Machine(0.3, chance.normal(size=fm_quality.FEATURES), chance.normal(size=(fm_quality.FEATURES, fm_quality.FACTORS)))
    places, values = fm_quality.features("some words, and some more words!\nsome | table")
    slow = machine.bias + sum(machine.linear[p] * v for p, v in zip(places, values))
    for a in range(len(places)):
        for b in range(a + 1, len(places)):
            slow += machine.factors[places[a]] @ machine.factors[places[b]] * values[a] * values[b]
    assert machine.raw(places, values) == pytest.approx(slow)


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % HELD_OUT_OF == 1


def test_quality_is_learned(spark):
    """Held-out accuracy on the next larger set, which has labels enough to learn from."""
    large = SF_DIR.replace("0.001", "0.01")
    quality = {row["doc_id"]: row["quality"] for row in spark.read.parquet(f"{large}/labels.parquet").collect()}
    found = by_id(all_queries()["op5_quality_classifier"](spark, large))
    assert all(row["held_out"] == held_out(doc_id) and 0 <= row["score"] <= 1 for doc_id, row in found.items())
    judged = [(found[doc_id]["predicted"], mark) for doc_id, mark in quality.items() if held_out(doc_id)]
    assert sum(a == b for a, b in judged) >= 0.95 * len(judged)
    assert all(a == 1 for a, b in judged if b == 1)


def test_held_out_labels_are_not_learned(spark):
    texts = docs(spark, *[f"text number {n}" for n in range(60)])
    labels = spark.createDataFrame([(n, n % 2) for n in range(60)], "doc_id bigint, quality int")
    sample = {row["doc_id"] for row in fm_quality.sample_labelled(texts, labels).collect()}
    assert sample == {n for n in range(60) if not held_out(n)}
    assert fm_quality.sample_labelled(texts, labels, 5).count() == 5


def test_labels_of_absent_documents_take_no_place(spark):
    texts = docs(spark, *[f"text number {n}" for n in range(60)], "long " * 30_000)
    labels = spark.createDataFrame([(n, n % 2) for n in range(3000)], "doc_id bigint, quality int")
    sample = fm_quality.sample_labelled(texts, labels, 20).collect()
    assert len(sample) == 20 and all(row["doc_id"] < 60 for row in sample)
    alone = fm_quality.sample_labelled(texts, labels.where("doc_id < 60"), 20).collect()
    assert sorted(sample) == sorted(alone)


def test_scores_of_odd_texts(spark):
    labels = spark.createDataFrame([(0, None), (1, 1), (1, 1), (3, 0), (77, 1)], "doc_id bigint, quality int")
    found = by_id(fm_quality.scores(docs(spark, *ODD), labels))
    assert len(found) == len(ODD)
    assert all(0 <= row["score"] <= 1 and row["predicted"] == (row["score"] >= 0.5) for row in found.values())


# --- Licences -------------------------------------------------------------------------------------

PLAIN_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWERED = str.maketrans(license_rules.UPPER, license_rules.LOWER)


def plain_base(text):
    words = PLAIN_WORD.findall((text or "").translate(LOWERED))
    starts, labels = [], set()
    for phrase, label in license_rules.BASE.items():
        parts = phrase.split()
        own = [at for at in range(len(words)) if words[at:at + len(parts)] == parts]
        starts += own
        labels |= {label} if own else set()
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)))


BASE_NAMES = ("n_words", "n_base", "first_word", "last_word", "base_labels")
LICENSES = [
    "Licensed under the Apache License, Version 2.0.", "CC BY-NC-SA 4.0 and cc  BY", "MIT LICENSE mit license\nMIT License",
    "the GNU GENERAL\tPublic-License v3 or later", "SPDX-License-Identifier: BSD-3-Clause", "nothing here", None, "",
    "mit license " * 400, "Apache license1", "KK mit licenſe", "ccby cc_by cc/by", "İ MIT License mit license",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
]


def test_base_phrases(spark):
    found = by_id(license_rules.license_scan(docs(spark, *LICENSES, *ODD)))
    for number, text in enumerate([*LICENSES, *ODD]):
        assert tuple(found[number][name] for name in BASE_NAMES) == plain_base(text), text
        assert 0 <= found[number]["score"] <= 1


def test_base_phrases_of_the_test_data(spark):
    texts = {row["doc_id"]: row["text"] for row in documents(spark).collect()}
    found = by_id(all_queries()["op6_license_scan"](spark, SF_DIR))
    assert all(tuple(found[doc_id][name] for name in BASE_NAMES) == plain_base(text) for doc_id, text in texts.items())
    assert any(row["n_base"] for row in found.values())


def test_suppression_by_containment(spark):
    found = by_id(license_rules.license_scan(docs(spark, *LICENSES)))
    assert found[0]["labels"] == "apache,apache-2.0"  # the base label stays, the versionless rule is contained
    assert [row["label"] for row in found[0]["detections"]] == ["apache-2.0"]
    assert found[1]["labels"] == "cc-by,cc-by-nc-sa-4.0"
    assert found[3]["labels"] == "gpl,gpl-3.0"
    assert found[4]["labels"] == "bsd-3-clause" and found[4]["score"] == 1.0
    assert found[5]["labels"] == "" and found[5]["score"] == 0.0
    assert found[13]["labels"] == "mit"


def plain_detections(text):
    """All rules by Python's own engine, and suppression by comparing all pairs."""
    words = PLAIN_WORD.findall((text or "").translate(LOWERED))
    whole = " " + " ".join(words) + " "
    found = []
    for rule in license_rules.rules():
        if any(keyword in whole for keyword in rule["keywords"]):
            for match in re.finditer(rule["pattern"], whole):
                start = whole[:match.start()].count(" ") - 1
                found.append((start, start + match[0].count(" ") + 1, rule["priority"], rule["label"]))
    order = sorted(found, key=lambda one: (one[0], -one[1], -one[2], one[3]))
    return [
        (a[0], a[1], a[3]) for place, a in enumerate(order)
        if not any(b[0] <= a[0] and b[1] >= a[1] and b[2] >= a[2] for b in order[:place])]


def test_names_and_versions_in_one_word(spark):
    wanted = {
        "GPLv3": "gpl-3.0", "GNU GPLv2+ or so": "gpl-2.0", "LGPLv2.1": "lgpl-2.1", "AGPLv3": "agpl-3.0", "MPLv2": "mpl-2.0",
        "GPL3": "gpl-3.0", "GPL v2": "gpl-2.0", "Apache 2.0": "apache-2.0", "Apache-2.0": "apache-2.0",
        "licensed under Apache 2.0": "apache-2.0", "Apache 2.4.1 serves": "", "Apache 2": "", "replgplv3": ""}
    found = by_id(license_rules.license_scan(docs(spark, *wanted)))
    assert [found[n]["labels"] for n in range(len(wanted))] == list(wanted.values())
    assert [found[n]["score"] > 0 for n in range(len(wanted))] == [label != "" for label in wanted.values()]


def test_detections_against_all_pairs(spark):
    texts = [text for text in LICENSES if text and len(text) < 1000] + [
        "released under the terms of the GNU Lesser General Public License version 2.1 or any later version and public domain",
        "Creative Commons Attribution-ShareAlike 3.0 International License. All rights reserved. Copyright (c) 2020 X"]
    found = by_id(license_rules.license_scan(docs(spark, *texts)))
    for number, text in enumerate(texts):
        assert [tuple(row) for row in found[number]["detections"]] == plain_detections(text), text


def test_rules_are_many_and_gated():
    rules = license_rules.rules()
    assert len(rules) >= 300
    for rule in rules:
        assert 1 <= rule["priority"] <= license_rules.LEVELS
        re.compile(rule["pattern"])
        assert all(len(keyword) >= 4 for keyword in rule["keywords"])


# --- Byte-level BPE -------------------------------------------------------------------------------

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_every_token_encodes_as_tiktoken_does(reference):
    coder = byte_bpe.codec(RANKS, public_tokenizers.PATTERN)
    for token in coder.tokens:
        try:
            text = token.decode()
        except UnicodeDecodeError:
            continue
        ids = coder.encode(text)
        assert ids == ",".join(map(str, reference.encode_ordinary(text)))
        assert coder.decode(ids) == token


def test_texts_encode_as_tiktoken_does(spark, reference):
    texts = [*ODD, "<|endoftext|> it's  we'll\n\n\t x", "aaaaaaaa" * 5000, "日本語 русский العربية 🎉🎉", "▁ ▁a"]
    frame = docs(spark, *texts).unionByName(documents(spark).selectExpr(
        "doc_id + 1000 doc_id", "text", "lang", "source", "n_chars", "'' n_words", "1 Score"))
    whole = {row["doc_id"]: row["text"] or "" for row in frame.collect()}
    digests = by_id(byte_bpe.encode_digests(frame, RANKS, public_tokenizers.PATTERN))
    for doc_id, row in by_id(byte_bpe.encode_texts(frame, RANKS, public_tokenizers.PATTERN)).items():
        ids = reference.encode_ordinary(whole[doc_id])
        assert row["ids"] == ",".join(map(str, ids)) and row["n_tokens"] == len(ids)
        assert bytes(row["decoded"]) == whole[doc_id].encode()
        assert digests[doc_id]["ids_sha256"] == hashlib.sha256(row["ids"].encode()).hexdigest()
        assert digests[doc_id]["decoded_sha256"] == hashlib.sha256(whole[doc_id].encode()).hexdigest()


def test_forgetting_changes_nothing(reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 3)
    coder = byte_bpe.Codec(RANKS, public_tokenizers.PATTERN)
    for text in ("qzxv wvut zzqj kkwq", "xqzw vvkq", "qzxv wvut"):
        assert coder.encode(text) == ",".join(map(str, reference.encode_ordinary(text)))


# --- Language -------------------------------------------------------------------------------------


def slow_bits(texts, text):
    """Code length with dictionaries, one byte at a time."""
    follow = [Counter() for _ in range(language_id.ORDER + 1)]
    for one in texts:
        data = language_id.START + one.encode().lower()
        for order in range(language_id.ORDER + 1):
            for at in range(order, len(data)):
                follow[order][data[at - order:at + 1]] += 1
    data, bits = language_id.START + text.encode().lower(), 0.0
    for at in range(language_id.ORDER, len(data)):
        for order in range(language_id.ORDER, -2, -1):
            if order < 0:
                bits += 8
                break
            context, byte = data[at - order:at], data[at:at + 1]
            seen = [n for key, n in follow[order].items() if key[:order] == context]
            total = sum(seen) + len(seen)
            if not seen:
                continue
            count = follow[order][context + byte]
            bits += math.log2(total / (count or len(seen)))
            if count:
                break
    return bits


def test_code_lengths_are_exact():
    samples = {"a": ["the cat sat on the mat", "THE dog"], "b": ["der hund saß", ""]}
    model = language_id.fit(samples)
    for text in ("the cat", "Der Hund saß dort", "zq\x00", "x", "mat on the sat cat the"):
        assert model.code_lengths(text) == pytest.approx([slow_bits(samples[name], text) for name in ("a", "b")])


def test_blocks_do_not_change_the_code_length(monkeypatch):
    model = language_id.fit({"a": ["abcabcabd" * 5], "b": ["xyzzy"]})
    whole = model.code_lengths("abcabxyzc" * 50)
    monkeypatch.setattr(language_id, "BLOCK", 7)
    assert model.code_lengths("abcabxyzc" * 50) == pytest.approx(whole)


def test_index_finds_all_and_nothing_else():
    keys = np.unique(np.random.default_rng(5).integers(0, 2**32, 5000, dtype=np.uint32))
    keys = np.unique(np.concatenate([keys, np.array([0], np.uint32)]))
    index = language_id.Index(keys)
    assert (index.find(keys) == np.arange(len(keys))).all()
    other = np.setdiff1d(np.arange(1, 20000, dtype=np.uint32), keys)
    assert (index.find(other) == -1).all()


def test_languages_of_the_test_data(spark):
    rows = {row["doc_id"]: row for row in documents(spark).collect()}
    found = by_id(all_queries()["op9_language_id"](spark, SF_DIR))
    assert all(row["held_out"] == held_out(doc_id) for doc_id, row in found.items())
    judged = [found[doc_id]["lang_pred"] == row["lang"] for doc_id, row in rows.items() if held_out(doc_id)]
    assert sum(judged) >= 0.97 * len(judged)


def test_languages_of_odd_texts(spark):
    texts = [None, "", "123 !?", "der die das", "the of and"]
    rows = docs(spark, *texts)
    found = by_id(language_id.predictions(rows))
    assert [found[n]["lang_pred"] for n in range(3)] == ["und"] * 3
    assert all(row["lang_pred"] in ("en", "und") for row in found.values())
    unknown = by_id(language_id.predictions(rows.selectExpr("doc_id", "text", "cast(null as string) lang")))
    assert all(row["lang_pred"] == "und" and row["score"] == 0 for row in unknown.values())


def test_long_documents_and_many_languages_are_learned_from(spark):
    rows = [(number, f"{number} words " * (5000 if number % 7 == 0 else 20), f"l{number % 210}") for number in range(1500)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    learned = [row for row in rows if zlib.crc32(str(row[0]).encode()) % HELD_OUT_OF != 1]
    samples = language_id.sample_texts(frame, 2)
    assert set(samples) == {lang for _, _, lang in learned} and len(samples) > language_id.MAX_LANGUAGES
    assert all(text in {row[1] for row in learned if row[2] == lang} for lang, texts in samples.items() for text in texts)


def test_long_documents_beside_short_ones_are_learned_from(spark):
    """A language of long texts and a few short ones, which say little, is learned from all of them."""
    rows = [(row["doc_id"], (row["text"] + " ") * (1 + 21_000 // len(row["text"])) if row["lang"] == "de" else row["text"], row["lang"])
            for row in documents(spark).where("length(text) > 0").collect()]
    rows += [(900_000 + n, "ok 12", "de") for n in range(9)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    found = by_id(language_id.predictions(frame))
    judged = [found[doc_id]["lang_pred"] == lang for doc_id, text, lang in rows if held_out(doc_id) and text != "ok 12"]
    assert sum(judged) >= 0.97 * len(judged)


def test_the_sample_is_bounded_in_characters(spark, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE_CHARS", 100)
    rows = [(n, "x" * (20 if n % 3 else 1000), "a" if n % 2 else "b") for n in range(6000)]
    samples = language_id.sample_texts(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), 50)
    for texts in samples.values():
        assert 20 <= len(texts) <= 80 and {len(text) for text in texts} == {20, 1000}
        assert sum(map(len, texts)) <= 2 * 50 * 100
