import itertools
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millwright.llm import dom, examples, htmltext

SHAPE = "page_id bigint, url string, html string, text string, n_chars string"


@pytest.fixture(scope="module")
def model():
    layouts = [dom.parse(h) for h in examples.layouts(250)]
    return htmltext.fit(layouts, [htmltext.marked(p) for p in layouts])


def blocks(html):
    return [t for t in dom.parse(html).text if t]


def test_blocks_of_broken_markup():
    assert blocks("<p>a<b>b</b> &amp; c<p>d<br>e</p>f<!-- x > y --><i>g</i>") == ["ab & c", "d e", "fg"]
    assert blocks("<ul><li>1<li>2 &lt;x&gt;</ul><script>var a='</p><p>no';</script>tail<style>p{}</style>") == ["1", "2 <x>", "tail"]
    assert blocks("<div title='a > b' data-x=\"<p>\">x &eacute;&#233;&nbsp;\n y</div") == ["x éé y"]
    assert blocks("a < b <3 c<p>d <!-- unfinished") == ["a < b <3 c", "d"]
    assert blocks("<head><title>t</title><meta charset=x></head><body>b</body>") == ["b"]
    assert blocks("<head><title>t</title><body>b") == ["b"]
    assert blocks("<table><tr><td>1<td>2<tr><th>3</table></div></span>4") == ["1", "2", "3", "4"]
    assert blocks("<textarea><p>x</textarea>y<SCRIPT>z</scripty></SCRIPT >w") == ["yw"]
    assert blocks("") == [] and blocks("<<>&") == ["<<>&"]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/!-pdivasctr \"'=&;é", max_size=60))
def test_any_text_is_read(html):
    page = dom.parse(html)
    assert all(p < i for i, p in enumerate(page.parent))


def test_deep_and_long_pages_take_linear_time():
    deep = dom.parse("<div>" * 50_000 + "x" + "</div>" * 50_000)
    assert max(deep.depth) <= dom.DEPTH and [t for t in deep.text if t] == ["x"]
    for broken in ("<a <b " * 200_000, "<p title='" * 100_000, "<!-- " * 200_000, "<li><b>x</p>" * 50_000, "</div>" * 200_000):
        dom.parse(broken)


def test_messages_give_the_marginals_of_all_labellings():
    page = dom.parse("<div><p>one</p><ul><li>two</li></ul></div><p>three.</p>")
    rng = np.random.default_rng(4)
    forest = htmltext.Forest([page], {})
    count = len(page.parent)
    unary, pair = rng.normal(size=count), rng.normal(size=(len(htmltext.KINDS), 2, 2))
    unary[0] = -40.0
    p, edges = forest.marginals(unary, pair)
    total, on, both = 0.0, np.zeros(count), np.zeros((count, 2, 2))
    for labels in itertools.product((0, 1), repeat=count):
        weight = math.exp(sum(u * y for u, y in zip(unary, labels, strict=True)) + sum(pair[forest.kind[i], labels[page.parent[i]], labels[i]] for i in range(1, count)))
        total += weight
        on += weight * np.array(labels)
        for i in range(1, count):
            both[i, labels[page.parent[i]], labels[i]] += weight
    assert np.allclose(p, on / total) and np.allclose(edges[1:], both[1:] / total)


def test_held_out_layouts(model):
    right = wrong = missed = 0
    for html in examples.layouts(120, seed=9):
        page = dom.parse(html)
        truth, outside = htmltext.marked(page), htmltext.described(page)[1]
        wanted = [truth[i] and not outside[i] for i, t in enumerate(page.text) if t]
        for want, (text, p) in zip(wanted, model.blocks([page])[0], strict=True):
            right += len(text) * (want and p >= 0.5)
            wrong += len(text) * (not want and p >= 0.5)
            missed += len(text) * (want and p < 0.5)
    assert right / (right + wrong) > 0.98 and right / (right + missed) > 0.97


def page(body, article="<article>{}</article>"):
    return f"<html><head><title>t</title></head><body><nav><ul><li><a href=/>home</a></li></ul></nav>{article.format(body)}<footer>&copy; us</footer></body></html>"


def test_pages(spark):
    long = "".join(f"<p>Sentence number {i} has a few words, and ends here.</p>" for i in range(20_000))
    body = "<h1>Title of it</h1><p>First paragraph, with some words in it. And more.</p><p>Second one\n with &eacute;&amp;.</p>"
    text = "Title of it First paragraph, with some words in it. And more. Second one with é&."
    rows = [(i, f"u{i}", page(body), "x", "y") for i in range(30)]
    rows += [(40, None, None, "", ""), (41, "u", "", "", ""), (42, "u", "<script>x</script>", "", ""), (None, "u", page(body), "", ""), (0, "u0", page(body), "", "")]
    rows += [(50, "u", page(long), "", ""), (51, "u", page(body + '<section id="comments"><div class="comment"><p>I liked this one a lot, thanks.</p></div></section>'), "", "")]
    pages = spark.createDataFrame(rows, SHAPE)
    got = htmltext.extract(pages, htmltext.train(pages, drawn=250)).collect()
    found = {r.page_id: r for r in got}
    assert len(got) == len(rows) and sum(r.page_id == 0 for r in got) == 2
    assert all(found[i].text == text and found[i].n_chars == len(text) for i in (*range(30), None, 51))
    assert all(found[i].text == "" and found[i].n_chars == 0 for i in (40, 41, 42)) and found[40].url is None
    assert found[50].text == " ".join(f"Sentence number {i} has a few words, and ends here." for i in range(20_000))


def test_empty_table(spark):
    pages = spark.createDataFrame([], SHAPE)
    assert htmltext.extract(pages, htmltext.train(pages, drawn=20)).collect() == []


def test_labels_of_pages():
    told = htmltext.told(dom.parse("<div>a<article><p>b</p><div class=comments>c</div></article></div>"))
    assert told.sum() == 3
    assert htmltext.told(dom.parse("<article>a</article><article>b</article>")) is None
