"""Token counts of sections, and main texts of pages."""

import random
import time

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shelfmark.llm import html_extract, token_counts

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tokens():
    return token_counts.load(RANKS, public_tokenizers.PATTERN)


def texts(seed, n):
    draw = random.Random(seed)
    parts = ["ab\n", "\n", " ", "é漢", "the ", "\n\n", "x", "\t  "]
    return ["".join(draw.choice(parts) for _ in range(draw.randint(0, 20))) for _ in range(n)]


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_attribution(tokens, rule):
    for text in texts(2, 200):
        first, last = tokens.spans(text)
        sections = token_counts.line_sections(text)
        counts, crossing, outside = token_counts.attribute(first, last, sections, rule)
        want, reach = np.zeros(len(sections)), np.zeros(len(sections))
        for a, b in zip(first, last, strict=True):
            shared = np.array([max(0, min(b + 1, e) - max(a, s)) for s, e in sections])
            if (shared > 0).sum() > 1:
                reach += shared > 0
            if rule == "share":
                want += shared / shared.sum()
            else:
                hit = np.flatnonzero(shared)
                want[{"most": shared.argmax(), "first": hit[0], "last": hit[-1]}[rule]] += 1
        assert np.allclose(counts, want) and (crossing == reach).all() and outside == 0


def test_ids_are_those_of_another_library(tokens, monkeypatch):
    theirs = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in texts(3, 300):
        assert tokens._encode(text) == theirs.encode(text, add_special_tokens=False).ids
    assert len(tokens._encode(" " * 1_000_000)) > 0


def test_given_sections_and_gaps(spark):
    docs = spark.createDataFrame(
        [(1, "the cat sat", [(4, 7), (8, 11)]), (2, "the cat", None)],
        "doc_id bigint, text string, parts array<struct<start:int,end:int>>")
    got = token_counts.count(docs, RANKS, public_tokenizers.PATTERN, sections_col="parts")
    rows = sorted((r.doc_id, r.section, r.tokens) for r in got.collect())
    assert rows == [(1, -1, 1.0), (1, 0, 1.0), (1, 1, 1.0), (2, -1, 2.0)]


ARTICLE = ("<article><h1>Title &amp; more</h1><p>First  para\ngraph.<p>Second&nbsp;one <b>bold"
           "<br>end</article>")
TEXT = "Title & more\nFirst para graph.\nSecond one bold end"


@pytest.mark.parametrize("html, text", [
    (f"<nav><a href=x>menu</a></nav>{ARTICLE}<footer>foot</footer>", TEXT),
    (f'<script>var t="</p>";</script><style>p{{}}</style><!-- <p>no -->{ARTICLE}', TEXT),
    (f'<div class="cookie-notice">We use cookies and such things here</div>{ARTICLE}', TEXT),
    (f'{ARTICLE}<section id="comments"><p>' + "I say so. " * 40 + "</p></section>", TEXT),
    (f"{ARTICLE}<aside><p>" + "Side text. " * 20 + "</p></aside><form>Name <input></form>", TEXT),
    ('<div id="main"><div class="post"><h2>T</h2><p>Body of it, long enough.</p>'
     '<div class="ad-slot">buy</div><p>More.</p></div></div>', "T\nBody of it, long enough.\nMore."),
    ("<ul><li>one thing<li>two things</ul>", "one thing\ntwo things"),
    ("<body>plain &lt;text&gt; only", "plain <text> only"),
    ("<main><header><h1>Title</h1><p>by line</p></header><p>Body of it, long enough.</p></main>",
     "Title\nBody of it, long enough."),
    ('<div class="search">Search the site</div><article><p>Before it.</p>'
     '<section class="search-results"><p>What they found.</p></section></article>',
     "Before it.\nWhat they found."),
    ("", ""),
])
def test_main_text(html, text):
    assert html_extract.extract(html, None) == (text, None, None)


def test_host_decides(spark):
    """A page whose comments outweigh its text is read at the path of its host."""
    def page(body, other):
        return (f'<div class="c{len(body)}"><p>{body}</p></div>'.replace(f"c{len(body)}", "body")
                + f'<div class="talk1"><p>{other}</p></div>')
    rows = [(k, "http://h.example/%d" % k, page("The long text of a page. " * 9, "short"))
            for k in range(5)]
    rows.append((9, "http://h.example/9", page("Brief news.", "Many words of readers. " * 9)))
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in html_extract.main_texts(pages).collect()}
    assert got[9] == "Brief news."
    [won] = html_extract.winners(html_extract.counts(pages)).collect()
    assert (won.path, won.votes) == ("html>div.body", 5)


PLAIN = "<article><p>{}</p></article>"
TEASER = '<article><p>Short teaser.</p></article><div class="story"><p>{}</p></div>'
TALK = '<article><p>{}</p></article><div class="talk"><p>{}</p></div>'


def brute_texts(pages):
    """Main texts by votes counted over all pages at once, with paths as they are."""
    votes, present, read = {}, {}, []
    for number, address, html in pages:
        page = html_extract.Page(html or "")
        site = (address or "").split("//")[-1].split("/")[0].lower() if address else ""
        best = page.best()
        points = page._points()
        at = {page.path(n) for n in page.nodes
              if n.tag in html_extract.CONTAINERS and points[n.at] > 0}
        won = page.path(best) if best else None
        for path in at | ({won} if won else set()):
            present[site, path] = present.get((site, path), 0) + 1
        if won:
            votes[site, won] = votes.get((site, won), 0) + 1
        read.append((number, site, page, best, won))
    out = []
    for number, site, page, best, won in read:
        ranked = sorted((-n, path) for (s, path), n in votes.items() if s == site)
        own = page.text([best]) if best else ""
        there = page.at_path(ranked[0][1]) if ranked else []
        text, points = page.text(there), page._points()
        most = sum(points[n.at] for n in there) >= html_extract.MOST * points[0]
        if not text or (not most and 2 * votes.get((site, won), 0) > present.get((site, won), 0)):
            text = own
        out.append((number, text))
    return sorted(out)


def test_two_layouts_on_a_host(spark):
    """A rarer layout is read at its own path, though it has a short block at the host's."""
    long = "Sentences of the story, one after the other. " * 40
    rows = [(k, f"http://a.example/{k}", PLAIN.format(f"{long}{k}.")) for k in range(5)]
    rows += [(10, "http://a.example/t", TEASER.format(long + "10."))]
    rows += [(20 + k, f"http://b.example/{k}", TALK.format(f"{long}{k}.", "Nice.")) for k in range(4)]
    rows += [(30, "http://b.example/news", TALK.format("Brief news.", "What readers say. " * 60))]
    rows += [(40, None, PLAIN.format("no address")), (41, "http://c.example/", None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in html_extract.main_texts(pages).collect()}
    assert got[10] == long + "10."
    assert got[30] == "Brief news."
    assert got[20] == long + "0." and got[3] == long + "3."
    assert got[40] == "no address" and got[41] == ""


def test_texts_equal_those_of_a_plain_count(spark):
    draw = random.Random(7)
    tags = ["<article><p>{}</p></article>", '<div class="post{}"><p>{}</p></div>',
            '<div class="talk"><p>{}</p></div>', "<main><p>{}</p></main>", "<nav>{}</nav>",
            "<section><p>{}</p></section>", "<p>{}"]
    rows = []
    for k in range(160):
        parts = []
        for _ in range(draw.randint(0, 4)):
            words = " ".join(draw.choice(["tale", "of", "it"]) for _ in range(draw.choice([2, 30])))
            parts.append(draw.choice(tags).replace("{}", str(k % 3), 1).replace("{}", words)
                         if draw.random() < 0.2 else draw.choice(tags).replace("{}", words))
        rows.append((k, draw.choice(["http://a.example/x", "https://B.example/y", None]),
                     "".join(parts) or None))
    rows += rows[:20]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    got = sorted((r.page_id, r.text) for r in html_extract.main_texts(pages).collect())
    assert got == brute_texts(rows)


def test_keys_are_those_of_paths():
    page = html_extract.Page('<div class="a1"><b><div><p>x</p></div></b></div>'
                             '<div class="a2"><div>y</div></div><div>z</div>')
    pairs = {(page.path(n), k) for n, k in zip(page.nodes, page.keys(), strict=True)}
    assert len(pairs) == len({p for p, _ in pairs}) == len({k for _, k in pairs})


@pytest.mark.parametrize("html", [
    "<b>" * 50_000, "<p>x" * 50_000, "<a " * 80_000, "<!--" * 50_000, '<a x="' * 80_000,
    "<script>" * 50_000, "</b>" * 90_000, "<div>" * 9000 + "x", "<" * 200_000])
def test_broken_markup_takes_linear_time(html):
    start = time.process_time()
    html_extract.vote(html)
    assert time.process_time() - start < 10
