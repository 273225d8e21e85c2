import html
import re

import pytest

from reelframe.llm import htmltext
from reelframe.llm.queries import LLM_QUERIES


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet("/root/testdata/sf0.01/pages.parquet")


@pytest.fixture(scope="module")
def field(pages):
    return htmltext.fit(pages)


def article_of(page):
    body = page[page.index("<article>") + 9 :].split("</article>")[0]
    body = re.sub(r"<[^>]*$", "", body)
    parts = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", p)).split()) for p in re.split(r"</?(?:h1|p)\b[^>]*>", body))
    return "\n".join(part for part in parts if part)


def test_query_gives_the_articles(spark, pages):
    source = {r.page_id: r.html for r in pages.collect()}
    rows = LLM_QUERIES["op7_main_text"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(source)
    for row in rows:
        assert row.text == article_of(source[row.page_id])
        assert row.n_chars == len(row.text)


PAGE = """<html><head><title>t</title></head><body><header><h1>My Site</h1><ul><li><a href=x>Home</a></ul></header>
<div id="cookie-notice"><p>We use cookies to make this work. Accept?</p></div>
<div class="sidebar"><h3>Popular</h3><ul><li><a>one</a><li><a>two</a></ul></div>
<div class="content"><h1>Real title</h1><p>First long paragraph with many words that tell a story.</p>
<blockquote>Quoted &lt;words&gt;&nbsp;of   somebody else.</blockquote><table><tr><td>Cell one text<td>Cell two</table>
<div class="ad">Buy now!</div><p>Second paragraph, which has a <a href=y>link</a> in it.</p></div>
<section class="comments"><h2>Comments</h2><div class="comment"><p>I liked this very much.</p></div></section>
<form><label>Email</label><input><p>Subscribe to our newsletter today.</p></form><footer>&copy; 2020 Site</footer></body></html>"""


def test_a_page_of_other_markup(field):
    assert htmltext.main_text(PAGE, field).split("\n") == [
        "Real title",
        "First long paragraph with many words that tell a story.",
        "Quoted <words> of somebody else.",
        "Cell one text",
        "Cell two",
        "Second paragraph, which has a link in it.",
    ]


def test_composed_pages_are_labelled_right(field):
    main = ["A title of some words", *[f"Sentence {i} of a text that is told in many words, one after another." for i in range(9)]]
    rest = ["Home", "About us", "Buy now", "All rights reserved"]
    right = every = 0
    for seed in range(100, 160):
        blocks, labels = htmltext.composed(main, rest, seed)
        found = field.decode([htmltext.features(b, i, len(blocks)) for i, b in enumerate(blocks)])
        right += sum(a == b for a, b in zip(found, labels, strict=True))
        every += len(labels)
    assert right / every > 0.95


def test_best_labelling_is_the_best_of_all(field):
    from itertools import product

    names = [["bias", "above p"], ["above nav"], ["above article", "above p"], ["bias"]]
    scores = [sum(field.weights.get(n, 0.0) for n in own) for own in names]

    def total(labels):
        return sum(s for s, y in zip(scores, labels, strict=True) if y) + sum(field.follow[a, b] for a, b in zip(labels, labels[1:], strict=False))

    assert total(field.decode(names)) == pytest.approx(max(map(total, product((0, 1), repeat=4))))


@pytest.mark.parametrize(
    "page, texts",
    [
        ("", []),
        ("plain text &am", ["plain text &am"]),
        ("<p>one<p>two<br>lines<hr>three", ["one", "two lines", "three"]),
        ("<div>a<script>var t = '</p>';</script>b<!-- c -->d</div><style>x</style>", ["a", "bd"]),
        ("<p>cut <b>off</b> he<artic", ["cut off he"]),
        ("<p title='a > b'>quoted</p></div></p>after", ["quoted", "after"]),
        ("<script>never closed", []),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
        ("<p>Let <math>x</math> be <object>shown</object> and <textarea>kept</textarea>", ["Let x be shown and kept"]),
        ("<p>a<b>b<div>c</div>d</p>e", ["ab", "c", "d", "e"]),
    ],
)
def test_blocks(page, texts):
    assert [block.text for block in htmltext.blocks_of(page)] == texts


def test_odd_rows(spark, field):
    rows = [(1, None, None, "t", 1), (None, "u", "", "t", 1), (2, "u", "<p>" * 20_000 + "deep", "t", 1), (2, "u", "<article><p>x y</p></article>", None, None)]
    rows.append((3, "u", "<article>" + "<p>word " * 30_000, "t", 1))
    odd = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = htmltext.extract(odd, field).collect()
    assert len(got) == 5
    assert {(r.page_id, r.text) for r in got if r.page_id in (1, None)} == {(1, ""), (None, "")}
    assert ("x y" in {r.text for r in got}) and max(r.text.count("\n") for r in got) == 29_999
    none = odd.limit(0)
    assert htmltext.extract(none, htmltext.fit(none)).collect() == []
    assert {r.text for r in htmltext.extract(odd, htmltext.fit(none)).collect()} == {""}


@pytest.mark.parametrize("tag", ["div", "b", "li", "p", "a", "div class=x"])
def test_deep_pages_take_linear_time_and_memory(tag):
    import time
    import tracemalloc

    def cost(depth):
        page = f"<{tag}>word " * depth
        tracemalloc.start()
        began = time.perf_counter()
        blocks = htmltext.blocks_of(page)
        taken, most = time.perf_counter() - began, tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert "".join(b.text for b in blocks).count("word") == depth
        return taken, most

    (small, less), (large, more) = cost(5_000), cost(50_000)
    assert more < 20 * less and large < 40 * small + 1


def test_pages_without_any_article(spark):
    rows = [(i, "u", f"<div><p>text number {i}</p></div>") for i in range(20)]
    with pytest.raises(ValueError, match="no page marks its article"):
        htmltext.fit(spark.createDataFrame(rows, "page_id long, url string, html string"))


def test_articles_are_found_however_rare(spark, pages):
    """Two pages in hundreds mark their article, and rows without ids do not fill the sample."""
    plain = pages.selectExpr("cast(null as long) page_id", "url", "regexp_replace(html, '(?i)</?(article|main)\\b', '<div') html")
    few = pages.orderBy("page_id").limit(2)
    field = htmltext.fit(plain.union(few), sample_pages=50)
    assert field.weights
    blocks, labels = htmltext.composed(["A title", "One sentence of a text.", "Another sentence of it."], ["Menu", "Home"], 3)
    assert len(field.decode([htmltext.features(b, i, len(blocks)) for i, b in enumerate(blocks)])) == len(labels)
