import itertools
import time

import numpy as np
import pytest

from tidemark.llm.html_text import FEATURES, Page, TreeModel, extracted_text, given_labels, main_text, seed_pages, trained_model

PAGE = ('<!DOCTYPE html><html lang="en"><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a">a</a></li>'
        '<li><a href="/b">b</a></li></ul></nav><!-- ad 1 --><div class="ad">Buy this now, it is cheap.</div><article><h1>Head &amp; line</h1><p><b>First words of it.<br>'
        '<p>Second   paragraph\n of the page, with <i>more</i> words&#33; and a <a href="/x">link</a> in it.</p><p>Third.</p></article>'
        '<footer>&copy; x.example.net &middot; All rights.</footer></body></html>')


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(k, f"http://x/{k}", PAGE.replace("Third", f"Third {k}")) for k in range(20)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)


@pytest.fixture(scope="module")
def model(pages):
    return trained_model(pages)


def test_article_text(pages, model):
    got = {r.page_id: r for r in extracted_text(pages, model).collect()}
    expected = "Head & line\n\nFirst words of it.\n\nSecond paragraph of the page, with more words! and a link in it.\n\nThird 3."
    assert got[3].text == expected and got[3].n_chars == len(expected) and got[3].url == "http://x/3"


def test_made_up_pages_of_another_seed(model):
    right = total = 0
    for source in seed_pages(150, seed=77):
        page = Page(source)
        kept, y = model.marginals(page) > 0.5, given_labels(page) == 1
        right += sum(kept[n] == y[n] for n, _ in page.runs)
        total += len(page.runs)
    assert right / total > 0.96


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(3)
    model = TreeModel()
    model.unary, model.pair = rng.normal(0, 1, len(FEATURES)), rng.normal(0, 1, (2, 2, 2))
    page = Page("<div><p>a b</p><ul><li>x</li><li>y <b>z</b></li></ul></div><p>last</p>")
    f = page.features()
    own, kind = f @ model.unary, model.kinds(f)
    weight = {y: np.exp(sum(own[k] * y[k] for k in range(len(own))) + sum(model.pair[kind[k], y[page.parent[k]], y[k]] for k in range(1, len(own))))
              for y in itertools.product((0, 1), repeat=len(own))}
    exact = [sum(w for y, w in weight.items() if y[k]) / sum(weight.values()) for k in range(len(own))]
    assert np.allclose(model.marginals(page), exact)


def test_training_raises_the_likelihood(pages):
    examples = [(p.parent, p.features(), given_labels(p)) for p in map(Page, seed_pages(20))]
    history = TreeModel().fit(examples)
    assert history[-1] > 0.9 > history[0]


@pytest.mark.parametrize("source,runs", [
    ("a<p>b<p>c</div>d", ["a", "b", "c", "d"]), ("<li>a<li>b", ["a", "b"]), ("<td>a<td>b<tr><td>c", ["a", "b", "c"]),
    ("x < y & z &lt;b&gt; &#x41;&nbsp;&amp", ["x < y & z <b> A &"]), ("<!-- never ends <p>a", []), ("<script>if (a<b) x='<p>'</SCRIPT >t", ["t"]),
    ("<a title='>'>q</a>", ["q"]), ('<a title=">q', ["q"]), ("", []), ("   ", []), ("<p>one<br/>two</p>", ["one two"]),
])
def test_reading(source, runs):
    assert [t for _, t in Page(source).runs] == runs


def test_odd_pages(spark, model, clashing):
    long = "<html><body><article>" + "<p>some words of a paragraph here.</p>" * 5000 + "</article></body></html>"
    rows = [(1, None, None), (None, "u", ""), (2, "u", PAGE), (2, "u", PAGE), (3, "u", long), (4, "u", "no markup at all")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = extracted_text(clashing(frame), model).collect()
    assert len(got) == 6 and [r.text for r in got if r.page_id in (1, None)] == ["", ""]
    assert next(r for r in got if r.page_id == 3).text.count("\n\n") == 4999
    assert extracted_text(frame.limit(0)).collect() == []


@pytest.mark.parametrize("source", ["<div>" * 30_000 + "</p>" * 30_000, '<a "' * 60_000 + ">", "<" * 300_000, "<a '>" * 60_001, "<p>x" * 30_000, "<!--" * 50_000])
def test_hostile_pages_take_linear_time(model, source):
    began = time.process_time()
    main_text(source, model)
    assert time.process_time() - began < 5


ARTICLE = ("<html><body><nav><a href='/'>Home</a></nav><article><h1>Title of it</h1><p>The first paragraph of the article has some words in it.</p>{}"
           "<p>The last paragraph of the article has some words in it, too.</p></article><footer>&copy; all rights</footer></body></html>")


@pytest.mark.parametrize("inside", ["<button>", "<video src=x>", "<select><option>", "<canvas>", "<audio>", "<svg>", "<iframe>", "<template>", "<object>", "<noscript>", "<math>"])
def test_an_element_that_is_not_closed_swallows_nothing(model, inside):
    text = main_text(ARTICLE.format(inside), model)
    assert text.startswith("Title of it\n\nThe first paragraph") and text.endswith("some words in it, too.")


def test_closed_ones_go_and_formulas_stay(model):
    text = main_text(ARTICLE.format("<p>Where <math><mi>a</mi> = <mn>42</mn></math> holds, and <object data=x>a picture of it</object> shows.</p>"
                                    "<svg><text>drawn</text></svg><button>press</button><textarea>typed</textarea>"), model)
    assert "Where a = 42 holds, and a picture of it shows." in text
    assert not any(w in text for w in ("drawn", "press", "typed"))
    assert "press" not in main_text(ARTICLE.format("<textarea>press"), model)


def test_many_open_elements_take_linear_time(model):
    page = ARTICLE.format("<button><video><select>" * 40_000)
    started = time.perf_counter()
    assert main_text(page, model).endswith("too.")
    assert time.perf_counter() - started < 20


def test_an_article_within_noscript_is_read(model):
    page = ARTICLE.format("").replace("<article>", "<noscript><article>").replace("</article>", "</article></noscript>")
    assert "The first paragraph of the article" in main_text(page, model)


def test_the_sample_of_repeated_pages_is_bounded(spark):
    rows = [(1, "u", ARTICLE.format(""))] * 500 + [(2, "u", ARTICLE.format("<p>x</p>"))]
    trained_model(spark.createDataFrame(rows, "page_id long, url string, html string"), bound=3)
