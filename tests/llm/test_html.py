"""Main text of pages: known layouts, decoding, odd pages."""

import itertools
import random

import numpy as np
import pytest

from tillcast.llm import html_extract as hx

SF = "/root/testdata/sf0.01"
T = "Some words of the story that go on, and on, for a while. "


@pytest.fixture(scope="module")
def model(spark):
    return hx.fit_extractor(spark.read.parquet(f"{SF}/pages.parquet"))


def texts(model, *pages):
    return hx.main_texts([hx.Page(p) for p in pages], model)


def test_articles_of_the_whole_table(spark, model):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    wrong = 0
    for row in hx.extract_text(pages, model).join(pages.select("page_id", "html"), "page_id").collect():
        inside = row.html.split("<article>", 1)[1].split("</article>")[0]
        wrong += row.text != "\n\n".join(t for _, t in hx.Page(inside).segments)
        assert row.n_chars == len(row.text)
    assert wrong == 0


def test_layouts_not_in_the_table(model):
    site = (
        f'<body><div id="cookie-banner"><p>We use cookies. Accept all.</p></div><header class="site-header"><h1>Site</h1><nav><a href=x>A</a></nav></header>'
        f'<main><h1>Title here</h1><p>{T * 3}</p><div class="ad-slot">Buy now, cheap shoes for all.</div><p>{T}</p></main>'
        f'<aside class="sidebar"><h3>Related</h3><p>{T}</p></aside><section id="comments"><h2>Comments</h2><div class="comment"><p>{T * 2}</p></div></section>'
        f"<form><label>Email</label><p>Sign up here.</p></form><footer><p>All rights reserved.</p></footer>"
    )
    story = f'<div class=nav><a>Home</a> <a>News</a></div><div class="content"><p>{T}</p><p>Short.</p><ul><li>one thing</li><li>two</li></ul></div><div class=footer>foot note</div>'
    t = T.strip()
    assert texts(model, site, story) == [f"Title here\n\n{T * 3}".strip() + f"\n\n{t}", f"{t}\n\nShort.\n\none thing\n\ntwo"]


def test_composed_pages_held_out(spark, model):
    pool = [t for r in spark.read.parquet(f"{SF}/pages.parquet").limit(50).collect() for _, t in hx.Page(r.html).segments]
    draw, kept, missed, extra = random.Random(77), 0, 0, 0
    for _ in range(150):
        html = hx.compose(pool, draw)
        want = {t.replace(hx.MARK, "") for _, t in hx.Page(html).segments if hx.MARK in t}
        got = set(texts(model, html.replace(hx.MARK, ""))[0].split("\n\n"))
        kept, missed, extra = kept + len(want & got), missed + len(want - got), extra + len(got - want)
    assert kept / (kept + missed) > 0.97 and kept / (kept + extra) > 0.95


def test_references_white_space_and_broken_markup(model):
    page = "<article><p>a &amp; b&nbsp;&eacute;\n\t c<br>d &lt;p&gt; <b>e</i> f<p>second<script>x='</p>no'</script><style>p{}</style><!-- no --> part &am</article>"
    assert texts(model, page) == ["a & b é c d <p> e f\n\nsecond part &am"]


def test_formulas_and_fallbacks_are_text(model):
    page = (
        f"<article><p>The energy is <math><mi>E</mi><mo>=</mo><mi>m</mi></math> in all frames.</p><noscript><p>{T}</p></noscript>"
        f"<object data=x><p>A map of the region, as text, for those without.</p></object><p>A sign <svg><path d=m /><text>up</text></svg> here.</p>"
        f"<video src=v><p>{T}</p></video><template><p>never</p></template><textarea>typed</textarea><p>{T}</p></article>"
    )
    t = T.strip()
    assert texts(model, page) == [f"The energy is E=m in all frames.\n\n{t}\n\nA map of the region, as text, for those without.\n\nA sign up here.\n\n{t}\n\n{t}"]


def test_odd_pages(spark, model):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "no tags at all"), (3, "u", "no tags at all"), (None, "u", "<p>" + "word " * 50_000), (4, "u", "<div>" * 3000 + "deep" + "</div>" * 3000), (5, "u", "<article><p>cut <a hre")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, n_chars int, text string")
    got = [(r.page_id, r.url, r.text, r.n_chars) for r in hx.extract_text(df, model).collect()]
    words = ("word " * 50_000).strip()
    expected = [(1, "u", "", 0), (2, None, "", 0), (3, "u", "no tags at all", 14), (3, "u", "no tags at all", 14), (None, "u", words, len(words))]
    assert got[:5] == expected and [g[2] for g in got[6:]] == ["cut"] and got[5][2] in ("", "deep")


def test_empty_table_and_pages_without_text(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert hx.fit_extractor(empty) is None and hx.extract_text(empty, None).count() == 0
    blank = spark.createDataFrame([(1, "u", "<p></p>"), (2, "u", None)], "page_id long, url string, html string")
    assert hx.fit_extractor(blank) is None and {r.text for r in hx.extract_text(blank, None).collect()} == {""}


def test_decoding_by_all_choices():
    draw = np.random.default_rng(5)
    for _ in range(40):
        n = 8
        parent = [-1] + [int(draw.integers(0, i)) for i in range(1, n)]
        odds = draw.normal(size=n)
        kept = hx.decode(parent, odds)
        assert kept[0] and all(not kept[i] or kept[parent[i]] for i in range(1, n))
        best = max(sum(odds[i] for i in range(1, n) if c[i]) for c in itertools.product((0, 1), repeat=n) if c[0] and all(not c[i] or c[parent[i]] for i in range(1, n)))
        assert sum(odds[i] for i in range(1, n) if kept[i]) == pytest.approx(best)


def test_boosting_learns_an_interaction():
    draw = np.random.default_rng(6)
    x = draw.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.5)).astype(float)
    fitted = hx.fit_boosted(x[:2000], y[:2000], hx.ExtractSpec(trees=30))
    assert ((fitted.log_odds(x[2000:]) > 0) == y[2000:]).mean() > 0.95
