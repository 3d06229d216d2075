"""Wrappers accept their pages; extracted texts against planted articles."""

import random
import re

import pytest
from helpers import prose, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st

from mediatables.llm import wrappers

PAGES = "page_id long, url string, html string, host string, wrapper string, text string"


def article(rnd, k):
    """Blocks of an article, and its html."""
    blocks, html = [prose(k, 6)], f"<h1>{prose(k, 6)}</h1>"
    for j in range(rnd.randint(1, 9)):
        words = prose(1000 + 10 * k + j, 20)
        kind = rnd.choice(["p", "p", "open", "h2", "list", "quote", "inline", "table"])
        if kind == "list":
            items = [prose(3000 + k + i, 4) for i in range(rnd.randint(1, 4))]
            blocks += items
            html += "<ul>" + "".join(f"<li>{i}" for i in items) + "</ul>"
        elif kind == "table":
            blocks += ["one", "two", words]
            html += f"<table><tr><td>one<td>two<tr><td>{words}</table>"
        else:
            blocks.append(words)
            first, rest = words.split(" ", 1)
            html += {"p": f"<p>{words}</p>", "open": f"<p>{words}", "h2": f"<h2>{words}</h2>",
                     "quote": f"<blockquote><p>{words}</p></blockquote>",
                     "inline": f'<p><b>{first}</b>\n <a href="/x?a=1>2">{rest}</a><!-- x --></p>'}[kind]
    return blocks, html


def templates():
    def plain(k, body):
        return (f'<!DOCTYPE html><html><head><title>T{k}</title><style>p{{}}</style><script>var t="</p>";</script></head>'
                f'<body><nav><ul><li><a href="/">Home</a></li></ul></nav><article>{body}</article>'
                f'<footer>&copy; {k}</footer></body></html>')

    def site(k, body):
        comments = "".join(f'<div class="comment"><p>{prose(9000 + k + i, 9)}</p></div>' for i in range(k % 4))
        notice = '<div class="cookie-notice"><p>We use cookies</p></div>' if k % 3 else ""
        return (f'<html><body>{notice}<header class="site-header"><h1>Site</h1></header><div class="layout">'
                f'<main><article class="post-{k}"><header><h1>Head {k}</h1><p>by me</p></header>{body}'
                f'<aside>related {k}</aside><div class="ad">buy {k}</div><form><input><p>mail</p></form></article>'
                f'<section id="comments">{comments}<article><p>a comment</p></article></section></main>'
                f'<div class="sidebar"><p>{prose(k, 40)}</p></div></div><footer><p>foot</p></footer>')

    def old(k, body):
        return (f'<html><body><div class="nav"><a href="/a">a</a> <a href="/b">b</a></div><p>Welcome to the site</p>'
                f'<div id="wrap"><div class="post-content">{body}</div></div><div class="footer">end {k}</div></body>')

    def bare(k, body):
        links = "".join(f'<li><a href="/{i}">{prose(i, 3)}</a></li>' for i in range(5))
        return f'<html><body><div><ul>{links}</ul></div><div><div>{body}</div></div><div>{k} bye</div></body></html>'
    return {"plain.example": plain, "site.example": site, "old.example": old, "bare.example": bare}


def planted():
    rnd, rows, want = random.Random(4), [], {}
    for host, template in templates().items():
        for k in range(12):
            page_id = len(rows)
            blocks, body = article(rnd, page_id)
            url = f"http://{host.upper() if k % 2 else host}/x{k}"
            rows.append((page_id, url, template(page_id, body), "h", "w", "t"))
            if host == "site.example":
                blocks = [f"Head {page_id}", *blocks]
            want[page_id] = "\n".join(blocks)
    return rows, want


def test_planted_articles(spark):
    rows, want = planted()
    got = wrappers.extract_text(spark.createDataFrame(rows, PAGES)).collect()
    assert {r.page_id: r.text for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


def test_rounds_of_alignment_agree(spark, monkeypatch):
    rows, want = planted()
    monkeypatch.setattr(wrappers, "FAN_IN", 2)
    got = wrappers.extract_text(spark.createDataFrame(rows, PAGES).repartition(9)).collect()
    assert {r.page_id: r.text for r in got} == want


def test_wrappers_accept_every_page(spark):
    rows, _ = planted()
    held = {r.host: r for r in wrappers.host_wrappers(spark.createDataFrame(rows, PAGES)).collect()}
    assert {h: r.pages for h, r in held.items()} == {h: 12 for h in templates()}
    for _, url, html, *_ in rows:
        _, wrapper = wrappers.from_json(held[url.split("/")[2].lower()].wrapper)
        assert re.fullmatch(wrappers.expression(wrapper), wrappers.stream(wrappers.page_tree(html)))
        assert_single(wrapper)


def assert_single(sequence):
    labels = [x for item in sequence for x in wrappers._labels(item)]
    assert len(labels) == len(set(labels))
    for item in sequence:
        assert_single(item[3])


LEAF = st.sampled_from(["<p>x</p>", "<p>y", "<h2>t</h2>", "z", "<hr>", "<b>i</b>", "<li>l", "<br>", "</div>", "</p>"])
HTML = st.recursive(LEAF, lambda inner: st.one_of(
    st.lists(inner, max_size=5).map("".join),
    st.tuples(st.sampled_from(["div", "section", "ul", "table", "td"]), inner).map(lambda t: f"<{t[0]}>{t[1]}</{t[0]}>")),
    max_leaves=25)


@settings(max_examples=150, deadline=None)
@given(st.lists(HTML, min_size=1, max_size=4))
def test_any_pages_are_accepted(pages):
    trees = [wrappers.page_tree(p) for p in pages]
    wrapper = wrappers.wrapper_of(trees[0])
    for tree in trees[1:]:
        wrapper = wrappers.merge(wrapper, wrappers.wrapper_of(tree))
    assert_single(wrapper)
    for tree in trees:
        assert re.fullmatch(wrappers.expression(wrapper), wrappers.stream(tree))
    pages_json = wrappers.to_json(len(trees), wrapper)
    assert wrappers.from_json(pages_json) == (len(trees), wrapper)


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("plain &amp; simple", "plain & simple"), ("<article><p>a<p>b", "a\nb"),
    ("<article>a&lt;b &am &amp;lt; &quot;</article><footer>f</footer>", 'a<b &am &lt; "'),
    ("<article><p>one<br>two <i>th</i>ree</p><script>if (a<b) x()</script>tail</article>", "one two three\ntail"),
    ("<article><p>" + "word " * 30_000 + "</article>", ("word " * 30_000).strip()),
    ("<article><div hidden>h</div><p style='display: none'>n</p>v</article>", "v"),
    ("<article><p>t</p><span class='ad'>buy</span></article>", "t"),
    ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
])
def test_single_pages(spark, html, text):
    tree = wrappers.page_tree(html or "")
    assert wrappers.Extractor(1, wrappers.wrapper_of(tree)).text(tree) == text


def test_edge_tables(spark):
    rows = [(1, None, "<article>a</article>", "h", "w", "t"), (None, "no host", None, "h", "w", "t"),
            (1, None, "<article>a</article>", "h", "w", "t"), (2, "http://h.example/", "", "h", "w", "t")]
    got = wrappers.extract_text(spark.createDataFrame(rows, PAGES))
    assert rows_of(got) == sorted([(1, None, "a", 1), (1, None, "a", 1), (None, "no host", "", 0),
                                   (2, "http://h.example/", "", 0)], key=repr)
    assert wrappers.extract_text(spark.createDataFrame([], PAGES)).collect() == []
