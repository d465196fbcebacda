"""Operator 5: attributes, layout words on lines of text, long constants, empty tables, clashing columns."""

from __future__ import annotations

import pytest

from wattlake.llm import wrappers

SCHEMA = "page_id long, url string, html string"


def texts(spark, pages):
    return {r.page_id: r.text for r in wrappers.extract_pages(spark.createDataFrame(pages, SCHEMA)).collect()}


@pytest.mark.parametrize("tag", [
    "<p title=it's>", "<p title=say\"so>", "<p '>", "<p a='x>y' b=\"p>q\">", "<p a = 'it\"s'>", "<p a=\"it's\">", "<p a=b'c'd e='f'>", "<p ='x'>",
    "<p a= b=c>", "<p a=>"])
def test_quotes_in_attributes(spark, tag):
    html = f"<article>{tag}main text here</p><p>more text</p></article><footer>no</footer>"
    assert texts(spark, [(1, "https://a.org/", html)]) == {1: "main text here more text"}


def test_unclosed_quote_ends_with_the_page(spark):
    assert texts(spark, [(1, "https://a.org/", "<article>kept<p title=\"open>lost</p></article>")]) == {1: "kept"}


def test_attribute_values():
    key = lambda a: wrappers._key("div", a)
    assert key(" class=it's") == key(" class=\"it's\"") == "div.it.s"
    assert key(" title=it's class=comments").startswith("!") and key(" data-class=comments").startswith("div")


def test_layout_words_on_lines_of_text(spark):
    lines = ["<h2 class='ui header'>{}</h2>", "<h2 class=header>{}</h2>", "<p class=form>{}</p>", "<p class='footer note'>{}</p>",
             "<h1 id=menu class=banner>{}</h1>"]
    pages = [(i, f"https://l{i}.org/", "<article><p>first</p>" + s.format("a line of text") + "</article>") for i, s in enumerate(lines)]
    # what is not layout still goes, and so do layout containers
    drop = ["<p class=advert>{}</p>", "<div class=header>{}</div>", "<p hidden>{}</p>", "<p class='cookie notice'>{}</p>"]
    pages += [(100 + i, f"https://d{i}.org/", "<article><p>first</p>" + s.format("no") + "</article>") for i, s in enumerate(drop)]
    want = {i: "first a line of text" for i in range(len(lines))} | {100 + i: "first" for i in range(len(drop))}
    assert texts(spark, pages) == want


@pytest.mark.parametrize("length", [15, 199, 350, 5000])
def test_constant_texts_of_any_length(spark, length):
    note = ("the same note on all pages of this site " * 200)[:length].strip()
    pages = [(i, f"https://c.org/{i}", f"<body><div class=x><p>text of page {i} " + f"goes on {i} " * 60 + f"</p></div><div class=y>{note}</div>")
             for i in range(10)]
    got = texts(spark, pages)
    assert all(note not in t and t.startswith(f"text of page {i}") for i, t in got.items()) and len(got) == 10


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "https://a.org/", "<article>x</article>", "a", "b", 1)],
                               SCHEMA + ", host string, text string, n_chars int")
    assert [tuple(r)[:4] for r in wrappers.extract_pages(df).select("page_id", "url", "text", "n_chars").collect()] == [(1, "https://a.org/", "x", 1)]
    assert wrappers.extract_pages(df.where("false")).count() == 0
