"""Syncmer fingerprints, licence notices and HTML extraction."""

import hashlib
import html as html_module
import random
import re

import numpy as np
import pytest

from tapeworks.llm import html_consensus as html
from tapeworks.llm import licences, syncmers

# --- syncmers


def plain_anchors(data):
    """Closed syncmers one window at a time, with the module's hash."""
    def hashed(run):
        return int(syncmers._mixed(np.array([int.from_bytes(run, "little")], dtype=np.uint64))[0])

    found = []
    for i in range(len(data) - syncmers.K + 1):
        window = [hashed(data[i + j : i + j + syncmers.S]) for j in range(syncmers.K - syncmers.S + 1)]
        if min(window) in (window[0], window[-1]):
            found.append(i)
    return found


def words(n, seed=0):
    return " ".join("".join(random.Random(f"{seed}/{i}").choices("abcdefghij", k=6)) for i in range(n))


def test_anchors_are_closed_syncmers(monkeypatch):
    data = words(60).encode()
    assert syncmers.anchors(data)[0].tolist() == plain_anchors(data)
    whole = syncmers.anchors(data * 5)
    monkeypatch.setattr(syncmers, "_PIECE", 37)
    pieces = syncmers.anchors(data * 5)
    assert all(np.array_equal(a, b) for a, b in zip(whole, pieces))


def test_anchors_do_not_depend_on_context():
    passage = words(50, "p")
    at, hashes = syncmers.anchors((words(30, "x") + " " + passage + " " + words(9, "y")).encode())
    inner = syncmers.anchors(passage.encode())
    shift = len(words(30, "x")) + 1
    held = dict(zip(at.tolist(), hashes.tolist()))
    assert all(held[a + shift] == h for a, h in zip(inner[0].tolist(), inner[1].tolist()))
    [(a, b, length)] = [m for m in syncmers.matched("z" * 7 + passage, "12" * 9 + passage) if m[2] > 20]
    assert b - a == 11 and length > len(passage) - 2 * syncmers.K


def test_likeness():
    a, b = syncmers.sketch(words(400, 1)), syncmers.sketch(words(400, 2))
    empty = syncmers.sketch("")
    assert syncmers.likeness(a, a) == 1 and syncmers.likeness(a, b) < 0.1
    assert syncmers.likeness(empty, empty) == 1 and syncmers.likeness(a, empty) == 0
    half = syncmers.sketch(words(200, 1) + words(200, 3))
    assert 0.3 < syncmers.likeness(a, half) < 0.7
    assert len(syncmers.sketch("abc")) == 1 and syncmers.shown(empty) == ""


SHORT = ["abcd efgh ij", "cfdi gdcacha", "eedifdhfifjh", "Ly. Th heing.", "x", ""]


def test_short_texts_differ():
    prints = [syncmers.sketch(t) for t in SHORT]
    assert len({syncmers.shown(p) for p in prints}) == len(SHORT)
    assert [[syncmers.likeness(p, q) for q in prints] for p in prints] == np.eye(len(SHORT)).tolist()
    rng = random.Random(8)
    for n in range(1, 40):
        texts = {"".join(rng.choices("abcdefghij ", k=n)) for _ in range(60)}
        assert len({syncmers.shown(syncmers.sketch(t)) for t in texts}) == len(texts)


def test_one_changed_character_anywhere_is_seen():
    text = words(40, "c")
    for i in range(len(text)):
        other = text[:i] + "#" + text[i + 1 :]
        assert syncmers.likeness(syncmers.sketch(text), syncmers.sketch(other)) < 1
        assert syncmers.shown(syncmers.sketch(text)) != syncmers.shown(syncmers.sketch(other))


def plain_in_order(a, b):
    """The most anchors that match in order, whatever the distances: no run can hold more."""
    best = [0] * (len(b) + 1)
    for x in a.hashes.tolist():
        above = 0
        for j, y in enumerate(b.hashes.tolist(), start=1):
            above, best[j] = best[j], above + 1 if x == y else max(best[j], best[j - 1])
    return best[-1]


def test_likeness_is_of_passages_in_order():
    whole = words(300, "o").split(" ")
    text = " ".join(whole)

    def like(changed):
        a, b = syncmers.sketch(text), syncmers.sketch(" ".join(changed))
        found = syncmers.likeness(a, b)
        assert found <= 2 * (plain_in_order(a, b) + 1) / (len(a) + len(b) + 2) + 1e-9
        return found

    assert 0.45 < like(whole[150:] + whole[:150]) < 0.55
    assert 0.30 < like(whole[200:] + whole[100:200] + whole[:100]) < 0.37
    assert like(whole[::-1]) < 0.1
    assert like(whole[:100] + ["other"] * 3 + whole[100:]) > 0.95
    assert 0.75 < like([w for i, w in enumerate(whole) if i % 25]) < 0.95
    assert 0.6 < like(whole[:100] + words(100, "q").split(" ") + whole[200:]) < 0.72
    assert 0.75 < like(whole + whole[:150]) < 0.85
    assert 0.68 < like(whole[50:] + whole[150:]) < 0.75


def test_fingerprints_are_shorter_than_prose(spark):
    texts = [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    shown = [len(syncmers.shown(syncmers.sketch(t))) for t in texts]
    assert sum(shown) <= sum(len(t.encode()) for t in texts)


TEXTS = [(4, "four " * 30), (1, words(100, 1)), (9, None), (2, ""), (7, "é" * 1001), (None, "no id " * 9), (5, "x"), (5, "another five"), (8, words(40_000, 8))]


def test_compared(spark):
    docs = spark.createDataFrame([(i, t, "z", 1) for i, t in TEXTS], "doc_id long, text string, fingerprint string, ahead int")
    found = syncmers.compared(docs).collect()
    assert len(found) == len(TEXTS)
    unique = sorted((t for t in TEXTS if t[0] not in (5, None)), key=lambda t: t[0])
    by_id = {r["doc_id"]: r for r in found if r["doc_id"] not in (5, None)}
    for (i, text), (_, following) in zip(unique, unique[1:]):
        if (i, _) == (4, 7):
            continue  # the rows with id 5 come between
        text, following = text or "", following or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        assert by_id[i]["n_chars"] == len(text)
        assert by_id[i]["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert by_id[i]["near_edited"] == syncmers.likeness(syncmers.sketch(text), syncmers.sketch(changed))
    last = by_id[9]  # empty; the row without id is the first of all and so its next one
    assert last["edited_sha256"] == hashlib.sha256(b"").hexdigest() and last["near_next"] == 0
    assert all(r["fingerprint"] == f["fingerprint"] for r in found for f in found if r["n_chars"] == f["n_chars"] == 0)
    alone = syncmers.compared(docs.filter("doc_id = 1")).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1
    assert syncmers.compared(docs.limit(0)).count() == 0
    given = syncmers.fingerprints(docs)
    assert given.columns == ["doc_id", "text", "ahead", "fingerprint"] and given.count() == len(TEXTS)


def test_syncmer_query(spark):
    from tapeworks.llm.queries import llm_queries

    sf_dir = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    found = {r["doc_id"]: r for r in llm_queries()["op7_syncmers"](spark, sf_dir).collect()}
    assert len(found) == len(rows)
    prints = {}
    for (i, text), (_, following) in zip(rows, [*rows[1:], rows[0]]):
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        assert found[i]["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert prints.setdefault(text, found[i]["fingerprint"]) == found[i]["fingerprint"]
    long = [r for r in found.values() if r["n_chars"] > 500]
    assert np.mean([r["near_edited"] > 0.25 for r in long]) > 0.95
    assert np.mean([r["near_next"] < 0.1 for r in long]) > 0.95


# --- licences


@pytest.fixture(scope="module")
def licence_model(spark, sf_dir):
    return licences.train(spark.read.parquet(f"{sf_dir}/documents.parquet"))


LICENCE_ROWS = [
    (1, "Some words.\nReleased under the MIT License.\nMore words."), (2, None), (3, ""), (4, "\n\n"), (None, "Licensed under CC BY-NC 4.0."),
    (5, "Long text of words here. This work is licensed under the GNU General Public License, version 3. And it goes on for long."),
    (6, "He lost his driving licence on the way to the foundation."), (7, "released under the mit licence"),
    (8, "Licensed under the Apache License, Version 2.0.\r\nLicensed under the Apache License, Version 2.0."), (1, "Released under the MIT License."),
    (9, "word " * 100_000 + "\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction")]


def test_licences(spark, licence_model):
    docs = spark.createDataFrame([(i, t, "x", 2) for i, t in LICENCE_ROWS], "doc_id long, text string, family string, words int")
    found = licences.found(docs, licence_model)
    rows = [(r["doc_id"], r["paragraph"], r["sentence"], r["family"]) for r in found.filter("confirmed").collect()]
    assert sorted(rows, key=str) == sorted([
        (1, 1, 0, "MIT"), (1, 0, 0, "MIT"), (None, 0, 0, "CC-BY-NC"), (5, 0, 1, "GPL"), (8, 0, 0, "Apache-2.0"), (8, 1, 0, "Apache-2.0"),
        (9, 1, 0, "MIT"), (7, 0, 0, "MIT")], key=str)
    assert all(0 <= r["probability"] <= 1 and 0 <= r["unknown"] <= 0.5 for r in found.collect())
    assert licences.found(docs.limit(0), licence_model).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)  # rows never leave their task


def test_licences_of_the_table(spark, sf_dir, licence_model):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    known = {"released under the mit license": "MIT", "licensed under the apache license version 2 0": "Apache-2.0",
             "licensed under cc by nc 4 0": "CC-BY-NC", "this work is licensed under the gnu general public license version 3": "GPL"}
    wanted = set()
    for i, text in docs.collect():
        for k, line in enumerate((text or "").split("\n")):
            plain = " ".join(re.sub(r"[\W_]+", " ", line.lower()).split())
            wanted |= {(i, k, family) for notice, family in known.items() if notice in plain}
    found = licences.found(docs, licence_model).filter("confirmed AND family <> 'Proprietary'").collect()
    assert {(r["doc_id"], r["paragraph"], r["family"]) for r in found} == wanted


# --- HTML

PAGE = """<!DOCTYPE html><html><head><title>t &amp; u</title><script>var a="</p><article>";</script><style>p{}</style></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<div id=page><article class="post-17"><h1>Head&nbsp;line &lt;x&gt;</h1><p>First <b>bo</b>ld  text
with 3 < 4 &amp; so on<p class="ad">Buy now<p>Second<br>line <a href="x">linked words</a></p><form><label>Mail</label></form>
<div class=body>Inner text &#233;&eacute;&amp</div></article><section class="comments"><p>A reader says a lot of things, far more words than
the article itself has, again and again, on and on, so that comments seem to be the text</p></section><aside>Side</aside></div>
<footer>&copy; foot</footer></body></html>"""


def test_main_text():
    wanted = "Head line <x> First bold text with 3 < 4 & so on Second line linked words Inner text éé&"
    assert html.main_text(PAGE, None) == wanted
    assert html.main_text(PAGE, ">html>body>div>article.post-#") == wanted
    assert html.main_text(PAGE, ">html>body>nothing") == wanted


@pytest.mark.parametrize("page", ["", "<", "<p", "plain text", "<article>cut off <b>in the mid", "<!-- never ends", "<script>x", "<a" * 5000,
                                  "</p></div></html>", "<p>" * 20_000 + "x", "<div>" * 5000 + "deep", "a & b &am", "<p title='>'>x</p>"])
def test_broken_pages(page):
    text = html.main_text(page, None)
    assert text == " ".join(text.split()) and "<div" not in text


def test_general_paths():
    assert html._step("div", {"class": "Post-12 main  b7"}) == "div.b#.main.post-#"


def test_consensus_outvotes_a_page(spark):
    usual = '<html><body><div class="x"><p>{}</p></div><div class="y"><p>{}</p></div></body></html>'
    rows = [(i, f"http://h.example:80/{i}", usual.format("long words of text " * 20, "few"), "q") for i in range(9)]
    rows += [(9, "http://user@H.example/9", usual.format("short", "an unusually long second part " * 30), "q"),
             (10, None, "<p>no host</p>", "q"), (11, "http://other", None, "q"), (12, "not a url", "", "q"), (None, "http://h.example", "<p>x</p>", "q")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = html.extracted(pages)
    assert found.columns == ["page_id", "url", "html", "text"]
    texts = {r["page_id"]: r["text"] for r in found.collect()}
    assert len(texts) == 14 and texts[9] == "short" and texts[10] == "no host" and texts[11] == texts[12] == "" and texts[None] == "x"
    assert html.extracted(pages.limit(0)).count() == 0


def test_many_hosts_are_joined_by_a_shuffle(spark, monkeypatch):
    pages = spark.createDataFrame([(i, f"http://h{i % 4}/", f"<p>text {i}</p>") for i in range(12)], "page_id long, url string, html string")
    usual = {r["page_id"]: r["text"] for r in html.extracted(pages).collect()}
    monkeypatch.setattr(html, "BROADCAST_HOSTS", 1)
    assert {r["page_id"]: r["text"] for r in html.extracted(pages).collect()} == usual == {i: f"text {i}" for i in range(12)}


def test_html_query(spark, sf_dir):
    from tapeworks.llm.queries import llm_queries

    found = {r["page_id"]: r for r in llm_queries()["op10_html"](spark, sf_dir).collect()}
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    assert len(found) == len(pages)
    for page in pages:
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", page["html"], re.S)[1]
        plain = re.sub(r"</?b>", "", re.sub(r"<(?:/?(?:p|h1)|br)>", " ", article))
        wanted = " ".join(html_module.unescape(plain).split())
        assert (found[page["page_id"]]["text"], found[page["page_id"]]["n_chars"]) == (wanted, len(wanted))


# --- notices without cue words, notices over several lines

WRAPPED = """Some words of the file
/*
 * This program is free software: you can redistribute it
 * and/or modify it under the terms of the GNU General
 * Public License as published by the Free Software
 * Foundation, either version 3 of the License, or (at your
 * option) any later version.
 */
int main"""


def test_notices_without_common_words(spark, licence_model):
    texts = ["Available under CC BY 4.0.", "Dedicated to the public under CC0 1.0 Universal.",
             "Some text. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = licences.found(docs, licence_model).filter("confirmed").collect()
    assert sorted((r["doc_id"], r["sentence"], r["family"]) for r in found) == [(0, 0, "CC-BY"), (1, 0, "CC0"), (2, 1, "MPL-2.0")]


def test_wrapped_notices(spark, licence_model):
    grant = "Permission is hereby granted, free of\ncharge, to any person obtaining a copy\nof this software and associated\ndocumentation files, to deal in the\nSoftware without restriction"
    docs = spark.createDataFrame([(1, WRAPPED), (2, f"A beginning.\n\n{grant}\n\nAn end"), (3, "Released under the MIT License\nLicensed under CC BY 4.0"),
                                  (4, "One\ntwo. Three goes\non. Four")], "doc_id long, text string")
    found = licences.found(docs, licence_model).collect()
    assert sorted((r["doc_id"], r["paragraph"], r["sentence"], r["family"], r["confirmed"]) for r in found) == [
        (1, 2, 0, "GPL", True), (2, 2, 0, "MIT", True), (3, 0, 0, "MIT", True), (3, 1, 0, "CC-BY", True)]
    assert {r["text"] for r in found if r["doc_id"] == 2} == {" ".join(grant.split())}
    places = licences.paragraphs(docs.filter("doc_id = 4")).collect()
    assert [(r["line"], r["nth"], r["paragraph"]) for r in places] == [(0, 0, "One two."), (1, 1, "Three goes on."), (2, 1, "Four")]


# --- fingerprints of long texts


def test_passages_are_found_from_fingerprints_of_long_texts():
    passage = words(50, "shared")
    left, right = (words(10_000, a) + " " + passage + " " + words(10_000, b) for a, b in (("a", "b"), ("c", "d")))
    prints = [syncmers.sketch(text) for text in (left, right)]
    assert syncmers.likeness(*prints) > 0.001
    again = [syncmers.read(syncmers.shown(p)) for p in prints]
    assert all(np.array_equal(p.at, q.at) and np.array_equal(p.hashes, q.hashes) and p.rim == q.rim for p, q in zip(prints, again))
    assert max(np.diff(prints[0].at)) <= syncmers.K - syncmers.S
    a, b, length = max(syncmers.matched_anchors(*again), key=lambda m: m[2])
    assert length > len(passage) - 3 * syncmers.K and left[a : a + length] == right[b : b + length]
    half = words(5_000, "a")
    assert abs(syncmers.likeness(syncmers.sketch(half), syncmers.sketch(half + words(5_000, "z"))) - 2 / 3) < 0.01


# --- odd quotes in tags


@pytest.mark.parametrize("tag", ["<a href=/x title=Don't>", "<a href=/x?q=\"a>", "<a title=5\" href='y'>", "<a \"=x>", "<a href=\"/x>"])
def test_unbalanced_quotes(tag):
    assert html.main_text(f"<div><p>one {tag}two</a> three</p><p>four</p></div>", None) == "one two three four"


def test_another_quote_later():
    page = "<div><p>one <a title=Don't>two</a> isn't three</p><p title = 'a > b'>four</p></div>"
    assert html.main_text(page, None) == "one two isn't three four"
    assert html._attributes("title=Don't hidden") == {"title": "Don't", "hidden": ""}


# --- text around the winning path


def test_text_around_the_winner_is_kept(spark):
    section = "<div class=section><p>" + "section words " * 70 + "</p></div>"
    usual = f"<html><body><div class=top><a href=/>Home</a></div><div class=content><h1>Heading</h1><p>The lead</p>{section}{section}<p><a href=/n>Next page</a></p></div></body></html>"
    listed = "<html><body><div class=text><p>Before it</p><ul>" + "<li>item of the list</li>" * 30 + "</ul><p>After it</p></div></body></html>"
    story = "<html><body><div class=section>Few</div><div class=story><p>" + "another template " * 50 + "</p></div></body></html>"
    rows = [(i, f"http://a/{i}", usual) for i in range(6)] + [(i, f"http://b/{i}", listed) for i in range(6, 9)] + [(9, "http://a/9", story)]
    near = "<html><body><div class=content><div class=section>Few</div></div><div class=story><p>" + "another template " * 50 + "</p></div></body></html>"
    rows.append((10, "http://a/10", near))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = {r["page_id"]: r["text"] for r in html.extracted(pages).collect()}
    assert all(texts[i] == "Heading The lead " + " ".join(["section words " * 140]).strip() for i in range(6))
    assert all(texts[i].startswith("Before it item") and texts[i].endswith("list After it") for i in range(6, 9))
    assert texts[9] == texts[10] == ("another template " * 50).strip()


# --- wrappers, heads, links, omitted ends

ARTICLE = "<h1>The title</h1>" + "<p>" + "running text of the article " * 20 + "</p>"
WHOLE = "The title " + ("running text of the article " * 20).strip()
SMALL = {
    "sidebar": "<div class=sidebar><p>Words of the side that run on for a while</p></div>",
    "notice": "<div id=cookie-notice><p>We use cookies, and say so at some length, as one has to</p></div>",
    "form": "<form action=/s><p>Sign up for our letters, which come every week</p><label>Name</label><input><button>Go</button></form>",
    "comments": "<div class=comments>" + "<div class=comment><p>" + "a reader says this " * 5 + "</p></div>" * 3 + "</div>",
}


@pytest.mark.parametrize("opening", ["<div class='container has-sidebar'>", "<div class=social-science>", "<form id=aspnetForm>",
                                     "<div id=page class='no-comments layout'>", "<main class=content>"])
def test_wrappers_are_kept_and_what_is_small_goes(opening):
    closing = f"</{opening[1:].split()[0].rstrip('>')}>"
    for inside in ("", *SMALL.values()):
        for outside in ("", SMALL["notice"], SMALL["comments"]):
            page = f"<html><body>{outside}{opening}<div class=text>{ARTICLE}</div>{inside}{closing}</body></html>"
            assert html.main_text(page, None) == WHOLE


def test_many_comments_are_no_article():
    comments = "<div class=comments>" + ("<p>" + "a reader says this at great length " * 40 + "</p>") * 4 + "</div>"
    assert html.main_text(f"<body><div class=text>{ARTICLE}</div>{comments}</body>", None) == WHOLE
    assert html.main_text(f"<body><div class=layout-with-sidebar><div class=text>{ARTICLE}</div>{comments}</div></body>", None) == WHOLE


def test_heads_of_articles_stay():
    body = ARTICLE.replace("<h1>The title</h1>", "")
    for head in ("<div class=article-header><h1>The title</h1></div>", "<header><h1>The title</h1></header>",
                 "<div class=header><h1>The title</h1></div>"):
        assert html.main_text(f"<body><article>{head}{body}</article></body>", None) == WHOLE
    assert html.main_text(f"<body><div class=post><div class=post-header><h1>The title</h1></div>{body}</div></body>", None) == WHOLE


def test_an_article_may_be_a_link():
    linked = "<p><a href=/x>" + "all of this is linked " * 20 + "</a></p>"
    wanted = ("all of this is linked " * 20).strip()
    assert html.main_text(f"<body><article>{linked}</article></body>", None) == wanted
    assert html.main_text(f"<body><div class=text>{linked}</div></body>", None) == wanted
    menu = "<ul>" + "<li><a href=/m>Menu entry</a></li>" * 30 + "</ul>"
    assert html.main_text(f"<body><div>{menu}</div><div class=text>{ARTICLE}</div></body>", None) == WHOLE


def test_tags_without_their_ends():
    import time

    rows = "".join(f"<tr><td>cell {i} of some words<td>and another" for i in range(4000))
    start = time.perf_counter()
    found = html.blocks(f"<body><table>{rows}</table></body>")
    assert time.perf_counter() - start < 0.5
    assert len({b.element.path for b in found}) == 1 and max(b.element.depth for b in found) < 6
    assert len(html.main_text(f"<body><table>{rows}</table></body>", None).split()) == 4000 * 7
    nested = "<table><tr><td>out <table><tr><td>in one<td>in two</table> again<td>next</table>"
    assert html.main_text(nested, None) == "out in one in two again next"
    listed = "<ul><li class=share>Share it<li>" + "an item of the list " * 9 + "<li>another <ul><li>inner</ul></ul>"
    assert html.main_text(listed, None).startswith("an item") and html.main_text(listed, None).endswith("another inner")


def test_paths_are_short():
    deep = "<div class='a b c'>" * 3000 + "text " * 50 + "</div>" * 3000
    assert max(map(len, html.container_scores(deep))) == 16
    assert html.main_text(deep, None) == ("text " * 50).strip()


def test_licence_identifiers(spark, licence_model):
    header = "# Copyright 2024 The Authors\n# SPDX-License-Identifier: %s\nimport os\n"
    wanted = {"MIT": "MIT", "Apache-2.0": "Apache-2.0", "GPL-3.0-or-later": "GPL", "LGPL-2.1-only": "LGPL", "AGPL-3.0-only": "AGPL",
              "BSD-3-Clause": "BSD", "MPL-2.0": "MPL-2.0", "CC-BY-4.0": "CC-BY", "CC-BY-SA-4.0": "CC-BY-SA", "CC0-1.0": "CC0", "ISC": "ISC"}
    names = [*wanted, "Zlib", "LicenseRef-Own"]
    docs = [(i, header % n) for i, n in enumerate(names)] + [(100 + i, f"SPDX-License-Identifier: {n}") for i, n in enumerate(names)]
    docs += [(200, "The identifier of the license was lost."), (201, "An SPDX file lists the parts of a program.")]
    found = licences.found(spark.createDataFrame(docs, "doc_id long, text string"), licence_model).filter("confirmed").collect()
    assert {(r.doc_id, r.family) for r in found} == {(i + k, wanted[n]) for i, n in enumerate(names) if n in wanted for k in (0, 100)}
    assert {r.template for r in found} == {f"{f}-identifier" for f in wanted.values()}
    assert {r.paragraph for r in found if r.doc_id < 100} == {1}


def test_marks_in_licence_texts(spark, licence_model):
    text = "A﷑b﷐7﷐. C﷒d.\nReleased under the MIT License.﷑ Then more."
    docs = spark.createDataFrame([(1, text), (2, "﷐﷑﷒"), (3, "﷑\nLicensed under CC BY 4.0.")], "doc_id long, text string")
    rows = [tuple(r)[:4] for r in licences.paragraphs(docs.filter("doc_id = 1")).orderBy("line", "nth").collect()]
    assert rows == [(1, 0, 0, "A�b�7�."), (1, 0, 1, "C�d."), (1, 1, 0, "Released under the MIT License.� Then more.")]
    assert sorted((r.doc_id, r.paragraph, r.family) for r in licences.found(docs, licence_model).filter("confirmed").collect()) == [
        (1, 1, "MIT"), (3, 1, "CC-BY")]


def test_places_of_sentences_in_one_long_line(spark):
    n = 20_000
    docs = spark.createDataFrame([(1, "Ab cd. " * n + "E\nf. Gh.")], "doc_id long, text string")
    rows = licences.paragraphs(docs).orderBy("line", "nth").collect()
    assert [r.nth for r in rows[:n]] == list(range(n)) and [(r.line, r.nth, r.paragraph) for r in rows[n:]] == [
        (0, n, "E"), (1, 0, "f."), (1, 1, "Gh.")]
