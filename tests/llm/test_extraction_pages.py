"""Links in running text, long articles and deep pages."""

import time

import numpy as np
import pytest

from ledgerflow.llm import dom, extract

FILL = "This is a sentence of the article, with some words in it. " * 4
HEAD = "<html><body><nav class='menu'><ul><li><a href='/a'>Home</a><li><a href='/b'>News</a></ul></nav><article><h1>Some title here</h1>"
FOOT = "</article><footer class='footer'>All rights reserved</footer></body></html>"


@pytest.fixture(scope="module")
def trees():
    return extract.train()


@pytest.mark.parametrize("link", ['<a href="/guide">', '<a href="/video" width=3>', '<a href="/y" class="external text">', '<a class="footnote" href="#n">',
                                  '<a id="cite-1" href="/y">', '<span class="term">', '<em role="note">', '<a href="/y">'])
def test_text_of_links_in_paragraphs_stays(trees, link):
    end = "</" + link[1:].split(" ")[0].rstrip(">") + ">"
    pages = []
    for i in range(20):
        body = "".join(f"<p>{FILL}see {link}linked words{end} and more of it.</p>" if k == i % 5 else f"<p>{FILL}</p>" for k in range(5))
        pages.append(HEAD + body + f"<div>{FILL}with {link}words beside{end} text.</div>" + FOOT)
    for text in extract.main_texts(pages, trees):
        assert "see linked words and more of it." in text and "with words beside text." in text
        assert "Home" not in text and "rights" not in text


def test_long_articles_are_kept_whole(trees):
    for tag, n in (("p", 500), ("p", 60), ("li", 400)):
        body = "".join(f"<{tag}>Number {k}: {FILL}</{tag}>" for k in range(n))
        text = extract.main_texts([HEAD + (f"<ul>{body}</ul>" if tag == "li" else body) + FOOT], trees)[0]
        assert all(f"Number {k}:" in text for k in range(n)) and "Home" not in text


def test_sibling_features_cover_all_siblings():
    page = dom.Page("<div>" + "<p>x</p>" * 300 + "<h2>y</h2>" + "<p>" + "z" * 500 + "</p></div>")
    nodes = page.nodes()
    x = page.features(nodes)
    column = {name: i for i, name in enumerate(dom.FEATURES)}
    last, first = x[-1], x[list(nodes).index(2)]
    assert last[column["after_heading"]] == 1 and first[column["after_heading"]] == 0
    assert np.isclose(first[column["largest_sibling_share"]], 1 / 500) and np.isclose(first[column["same_tag_siblings"]], 301 / 302)


@pytest.mark.parametrize("source", ["<div>" * 20_000 + "deep", "<p>a<table><td>" + "<div>" * 20_000, "<div><section>" * 10_000 + "</aside>" * 10_000,
                                    "<ul><li>" * 10_000 + "x", "<div>x</section>" * 10_000])
def test_deep_pages_are_read_in_linear_time(source):
    begin = time.process_time()
    page = dom.Page(source)
    assert time.process_time() - begin < 2
    assert len(page.tag) >= 10_000
