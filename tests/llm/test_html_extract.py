"""Operator 7: minimum cut against all labellings, pages, odd input."""
import itertools
import random

import numpy as np

from claimlens.llm import html_extract as hx

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head>
<body><header class="site-header"><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li><li><a>More</a></li></ul></nav>
<!-- ad --><div id="cookie-banner">We use cookies. Accept all of them, please.</div>
<div class="layout"><div class="sidebar"><p>Popular posts this week, and some other text.</p></div>
<article><h1>My &amp; title</h1><p>First   paragraph with many words,
and commas, so that it is clearly content&hellip;<p>Short.<br>After&nbsp;break.</p>
<div class="advert">Buy now, it is cheap, really cheap, and good.</div>
<p>Another paragraph that is long enough to be content, as it goes on.</p></article>
<div class="comments"><p>Great article, I liked it very much, thank you!</p></div>
<form><label>Name</label><textarea>hello there</textarea></form></div><footer>&copy; 2020 all rights reserved</footer></body></html>"""
WANT = ("My & title First paragraph with many words, and commas, so that it is clearly content… Short. After break. "
        "Another paragraph that is long enough to be content, as it goes on.")
SCHEMA = "page_id bigint, url string, html string, text string, n_chars int, y int"


def pages(spark, htmls):
    return spark.createDataFrame([(i, f"u{i}", h, "t", 1, 2) for i, h in enumerate(htmls)], SCHEMA)


def test_minimum_cut_equals_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randint(1, 7)
        odds = np.array([rng.uniform(-2, 2) for _ in range(n)])
        edges = [(i, j, rng.uniform(0, 1.5)) for i in range(n) for j in range(i) if rng.random() < 0.5]

        def cost(label):
            return (sum(max(0, x) if not k else max(0, -x) for x, k in zip(odds, label, strict=True))
                    + sum(c for u, v, c in edges if label[u] != label[v]))
        best = min(map(cost, itertools.product([0, 1], repeat=n)))
        assert abs(cost(hx.min_cut(odds, edges).astype(int)) - best) < 1e-7


def test_page_parts_are_told_apart():
    assert hx.main_text(PAGE, hx.START) == WANT


def test_wrappers_that_only_look_hidden_or_bad():
    for attributes in ('class="overflow-hidden"', 'style="overflow: hidden"', 'aria-hidden="false"', 'class="layout has-sidebar"',
                       'class="page no-sidebar"', 'class="wrap with-header"', 'class="sidebar"'):
        for page in (PAGE.replace('<div class="layout">', f"<div {attributes}>"),
                     PAGE.replace("<body>", f"<body {attributes}>"), PAGE.replace("<article>", f"<article {attributes}>")):
            if attributes != 'class="sidebar"' or "<div " + attributes + "><div" in page:
                assert hx.main_text(page, hx.START) == WANT, attributes


def test_hidden_parts_and_named_articles():
    for attributes in ("hidden", 'hidden=""', "aria-hidden='true'", 'style="color:red; display : none"', "style=visibility:hidden"):
        assert hx.main_text(PAGE.replace("<article>", f"<article><div {attributes}><p>A long, hidden paragraph of text, with "
                                         "commas, which nobody sees.</p></div>"), hx.START) == WANT, attributes
    comment = '<article class="comment"><p>I liked it very much, indeed, thank you!</p></article>'
    assert hx.main_text(PAGE.replace('<div class="comments">', '<div class="comments">' + comment), hx.START) == WANT
    card = hx.parse('<div class="related"><article><p>One.</p></article></div><article><p>Two.</p></article>')[0]
    assert [hx.weak_label(b[2]) for b in card] == [-1, 1]


def test_page_without_telling_tags():
    page = ("<body><div><a href=x>One</a> <a href=y>Two</a> <a>Three</a></div><div><p>" + "A long sentence, with commas, goes on. " * 5
            + "</p><p>Short</p><p>" + "More text follows here, as one would expect. " * 4 + "</p></div></body>")
    got = hx.main_text(page, hx.START)
    assert got.startswith("A long sentence") and "Short More text" in got and "One" not in got


def test_query_rows_and_odd_pages(spark):
    odd = [None, "", "plain words only, no markup at all here.", "<p", "<article><p>cut off in the middle, but long enou",
           "<script>never closed", "a < b and c > d, said he, and so it was.", "</div></p></x>", "<article>" + "<div>" * 3000 + "deep text, deep text, deep.",
           "<article>" + "<p>word word, word word.</p>" * 4000 + "</article>", "<article><p>&#x41;&bogus;&lt;</p></article>", PAGE, PAGE]
    rows = hx.extract_pages(pages(spark, odd)).collect()
    got = {r.page_id: r for r in rows}
    assert len(rows) == len(odd) and all(r.n_chars == len(r.text) for r in rows)
    assert got[0].text == got[1].text == got[5].text == got[7].text == ""
    assert got[4].text == "cut off in the middle, but long enou"
    assert got[8].text == "deep text, deep text, deep."
    assert got[9].text.count("word word, word word.") == 4000
    assert got[10].text == "A&bogus;<"
    assert got[11].text == got[12].text == WANT and got[11].url == "u11"
    assert hx.extract_pages(pages(spark, [])).collect() == []


def test_training_separates_labelled_blocks(spark):
    weights = hx.fit_classifier(pages(spark, [PAGE, PAGE.replace("Short", "Shorter")]))
    assert hx.main_text(PAGE, weights) == WANT


def test_deep_pages_cost_their_length():
    import time
    def seconds(n):
        page = "<body>" + "<div>" * n + "text of it." + "</div>" * n + "<p>after</p></body>"
        t = time.process_time()
        blocks, nodes = hx.parse(page)
        assert [b[0] for b in blocks] == ["text of it.", "after"] and len(nodes) == n + 1
        assert blocks[1][2] is nodes[0]         # every container is closed again
        return time.process_time() - t
    seconds(1000)
    assert seconds(32_000) < 60 * max(seconds(2_000), 0.005)    # 256 times if it went with the square
