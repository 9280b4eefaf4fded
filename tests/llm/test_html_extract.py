import html
import re

import numpy as np
import pytest

from clinlake.llm import dom, html_extract as hx
from clinlake.llm.common import table

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def trees(spark):
    return hx.fit(table(spark, SF_SMALL, "pages"))


def article_text(source):
    """The article element's paragraphs and headings, by hand."""
    inner = re.search(r"<article>(.*?)</article>", source, re.S).group(1)
    blocks = re.split(r"</?(?:p|h\d|div|ul|li)\b[^>]*>", inner)
    texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "<br" in b else "", b)).split()) for b in blocks]
    return "\n\n".join(t for t in texts if t)


def test_query_finds_the_articles(spark):
    got = {r["page_id"]: r for r in hx.op8_html_extraction(spark, SF_SMALL).collect()}
    pages = table(spark, SF_SMALL, "pages").collect()
    assert len(got) == len(pages)
    for p in pages:
        assert got[p["page_id"]]["text"] == article_text(p["html"])
        assert got[p["page_id"]]["n_chars"] == len(got[p["page_id"]]["text"])
        assert got[p["page_id"]]["url"] == p["url"]


SENTENCE = "A long enough sentence of the article, with a comma and an end. "


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><script>var a='<p>no</p>';</script></head><body>{body}</body></html>"


@pytest.mark.parametrize("body", [
    "<div class='menu'><a href='/'>Home</a> <a href='/b'>News</a></div><div class='post-content'>{a}</div><div class='sidebar'><p>{s}</p></div>",
    "<header><h2>Site name</h2></header><main>{a}</main><section id='comments'><div class='comment'><p>{s}</p></div></section><footer>&copy; x</footer>",
    "<div class='cookie-notice'><p>{s}</p></div><article>{a}<aside><p>{s}</p></aside></article><form><label>{s}</label><input></form>",
    "<nav><ul><li><a href='x'>x</a></ul></nav><article>{a}<div class='ad'>{s}</div></article><div class='newsletter'><p>{s}</p></div>",
])
def test_other_templates(trees, body):
    own = [SENTENCE * 3, SENTENCE * 5 + "&eacute;&amp;", SENTENCE * 2]
    article = "<h1>The heading of it</h1>" + "".join(f"<p>{t}</p>" for t in own)
    got = hx.extract_text(page(body.format(a=article, s="Something else that readers say about it, at length.")), trees)
    assert got == "\n\n".join(["The heading of it", *[html.unescape(t).strip() for t in own]])


@pytest.mark.parametrize("body", [
    "<form method='post' action='x.aspx'><input type='hidden' name='__VIEWSTATE'><div class='menu'><a href='/'>Home</a><input name='q'><button>Go</button></div>"
    "<div class='post-content'>{a}</div><fieldset><label>{s}</label><input></fieldset></form>",
    "<form method='post'><nav><a href='/'>Home</a></nav><article>{a}</article><footer>&copy; x</footer></form>",
    "<nav><a href='/'>Home</a></nav><article><fieldset>{a}</fieldset></article><form><label>{s}</label><input></form>",
    "<nav><a href='/'>Home</a></nav><dialog open><article>{a}</article></dialog><form><label>{s}</label><input></form>",
])
def test_articles_inside_forms(trees, body):
    own = [SENTENCE * 3, SENTENCE * 5, SENTENCE * 2]
    article = "<h1>The heading of it</h1>" + "".join(f"<p>{t}</p>" for t in own)
    source = page(body.format(a=article, s="Your name, as it is to be shown."))
    want = "\n\n".join(["The heading of it", *[t.strip() for t in own]])
    assert hx.extract_text(source, trees) == want
    assert hx.extract_text(source, None) == want


def test_parsing_odd_pages(trees):
    assert [hx.extract_text(s, trees) for s in (None, "", "   ", "<", "<p", "<!-- only")] [:3] == ["", "", ""]
    parsed = dom.parse("<div>one<p>two<p>three <b>bold<br>line</div>four<ul><li>a<li>b</ul><script>x</p>y</script>&lt;z&gt;")
    assert [r for _, r, _ in parsed.runs if r != "x</p>y"] == ["one", "two", "three bold line", "four", "a", "b", "<z>"]
    deep = "<div>" * 3000 + "text" + "</div>" * 3000
    assert len(dom.parse(deep).tags) == 3001
    hx.extract_text(deep, trees)
    long = "<article>" + "<p>" + SENTENCE * 20_000 + "</p></article>"
    assert len(hx.extract_text(page(long), trees)) > 1_000_000


def test_decoding_keeps_nothing_below_a_dropped_node():
    parsed = dom.parse("<div class='sidebar'><div><p>inside</p></div></div><p>outside</p>")
    logits = np.full(len(parsed.tags), 1.0)
    logits[1] = -100
    assert dom.decode(parsed, logits, 5.0) == ["outside"]


def test_trees_equal_the_model(spark, trees):
    x = np.vstack([dom.features(dom.parse(r["html"])) for r in table(spark, SF_SMALL, "pages").limit(5).collect()])
    scores = hx.log_odds(trees, x)
    assert scores.shape == (len(x),) and (scores > 0).any() and (scores < 0).any()


def test_edge_tables(spark, trees):
    pages = spark.createDataFrame([(1, "u", None, "t"), (None, None, "<article><p>x</p></article>", "t"), (2, "u", "", "t"), (2, "u", "", "t")],
                                  "page_id long, url string, html string, text string")
    assert sorted(r["text"] for r in hx.extract(pages, trees).collect())[:3] == ["", "", ""]
    assert hx.extract(pages.limit(0), trees).collect() == []
    assert hx.fit(pages.limit(0)) is None
    assert hx.extract_text("<nav><p>a</p></nav><article><p>b</p></article>", None) == "b"


@pytest.mark.parametrize("template", [
    '<html><body class="page has-sidebar header-fixed single-post"><article>{a}</article></body></html>',
    '<html><body class="menu-open"><nav><a href="/">Home</a></nav><article>{a}</article><footer>&copy; x</footer></body></html>',
    '<html><body><article class="no-sidebar">{a}</article></body></html>',
    '<html class="no-js sidebar"><body id="menu"><div class="with-sidebar layout-nav"><div class="post-content">{a}</div></div></body></html>',
    '<html><body><div class="sidebar-page"><main>{a}</main><aside><p>{s}</p></aside></div></body></html>',
    '<html><body><div id="header-wrap" class="hasMenu"><article>{a}</article></div></body></html>',
])
def test_state_words_on_wrappers_keep_the_article(trees, template):
    own = [SENTENCE * 3 + str(i) for i in range(4)]
    got = hx.extract_text(template.format(a="".join(f"<p>{t}</p>" for t in own), s="Something else, said aside."), trees)
    assert got == "\n\n".join(" ".join(t.split()) for t in own)


@pytest.mark.parametrize("source", ["{t}", "<body>{t}", "<html><body>{t}</body></html>", "{t}<br>{t}"])
def test_text_without_elements_is_judged(trees, source):
    text = (SENTENCE * 10).strip()
    assert hx.extract_text(source.format(t=text), trees) == " ".join(source.format(t=text).replace("<br>", " ").replace("<body>", "")
                                                                      .replace("<html>", "").replace("</body></html>", "").split())


def test_naming_words_still_name_parts():
    assert dom._kinds("sidebar-left main-nav") and dom._kinds("comment-list") and dom._kinds("adBox")
    for state in ("has-sidebar", "no-sidebar", "menu-open", "is-sticky-header", "hasMenu", "layout-sidebar", "header--fixed", "js-nav"):
        assert not dom._kinds(state), state


@pytest.mark.parametrize("unit", ['<a "', "<a '>", '<a b="', '<a b=">" ', "<!", "<", "</div>", "<div>", "<li>", "<ul><li>", "<p>", "<a b = ", "&", "&amp", "<x/", "<!-- ", "<a class=", "<div id='x'", "</", "<b c='>"])
def test_hostile_pages_are_read_once(unit):
    import time

    def seconds(n):
        source = "start " + unit * (n // len(unit)) + " end"
        began = time.process_time()
        page = dom.parse(source)
        took = time.process_time() - began
        assert page.runs and page.runs[0][1].startswith("start")
        return took

    assert seconds(1_000_000) < 6 * max(seconds(250_000), 0.05) and seconds(1_000_000) < 4


def test_quotes_end_where_browsers_end_them():
    texts = lambda source: [run for _, run, _ in dom.parse(source).runs]
    assert texts('<p title="a > b">one</p><p title=don\'t>two</p>') == ["one", "two"]
    assert texts("<p title='x>three</p><p>four</p>") == ["three", "four"]  # nothing closes the quote


def test_log_odds_equal_the_fitted_model(spark):
    """The arrays the tasks use against Spark's own model on the same rows."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    nodes = hx.training_nodes(table(spark, SF_SMALL, "pages"), 20).sort("page_id", "v", "node").select("label", array_to_vector("x").alias("features"))
    nodes = nodes.cache()
    model = GBTClassifier(maxIter=4, maxDepth=hx.DEPTH, stepSize=hx.STEP, seed=5, maxBins=64).fit(nodes)
    trees = [(w, hx._arrays(t._call_java("rootNode"))) for w, t in zip(model.treeWeights, model.trees)]
    scored = model.transform(nodes).select("features", "rawPrediction").collect()
    want = np.array([2 * r["rawPrediction"][1] for r in scored])
    got = hx.log_odds(trees, np.array([r["features"].toArray() for r in scored]))
    # Spark's raw prediction is the trees' sum, its log-odds twice that
    assert np.allclose(got, want) and len(got) > 200
    nodes.unpersist()
