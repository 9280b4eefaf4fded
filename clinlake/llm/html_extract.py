"""Main text of web pages by gradient-boosted trees over DOM nodes (operator 8).

A page becomes a tree of its block elements (``dom``). Every node gets
features - depth, own and subtree text and its density, links, kinds of its
element and of the words in its class, id and role, place and size among its
siblings, what stands above it - and boosted trees give its log-odds of
belonging to the article. Decoding chooses the nodes to keep as a whole tree:
nothing below a dropped node is kept, and a wrapper is kept for what it holds.

The trees (Spark's ``GBTClassifier``) are fitted on a bounded sample, the
``TRAIN_PAGES`` pages of smallest id hash. The pages carry no labels, so nodes
are labelled by what pages say about themselves (article and main against nav,
header, footer, aside and naming words such as ad or comments), and each
sampled page is joined by variants of known labels: its parts renamed to plain
``div`` elements with naming words, with sidebars, notices, forms and reader
comments of its own paragraphs put in, wrapped in elements whose class words
tell a state or layout, with the body or the article inside a form, fieldset or
dialog, and as bare text. Every page is extracted from its whole html.

Defined results: null or empty html gives an empty text; scripts, styles,
templates, controls and the like (``dom.NEVER``) give no text, whereas what a
form, fieldset or dialog holds is judged by the trees; text outside any
element is judged like that of an element; unclosed and misnested elements are
closed as browsers do it for paragraphs and list items; repeated rows get equal
texts; where the sample says nothing of one class, what pages say of themselves
decides alone. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F

from clinlake.llm import dom
from clinlake.llm.common import materialize, table

TRAIN_PAGES = 400
#: Nodes taken of one training page; longer pages give some from all over the page, drawn by its id.
TRAIN_NODES = 400
VARIANTS = 4
#: Further variants, with forms around the page or the article.
FORM_VARIANTS = 2
TREES = 16
DEPTH = 4
STEP = 0.4
#: Characters a node counts besides its own text when it is kept or dropped.
PRIOR = 5.0

Tree = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _in_form(source: str, rnd: random.Random) -> str:
    """The page with its whole body in a form, or its article in or around a form, fieldset or dialog."""
    where = rnd.choice(["body", "around", "inside"])
    if where == "body":
        put_in = '<form method="post"><input type="hidden" name="state">' + rnd.choice(["", '<input name="q"><button>Go</button>'])
        source = re.sub(r"(<body[^>]*>)", lambda m: m.group(1) + put_in, source, count=1)
        return re.sub(r"(</body>|\Z)", lambda m: "</form>" + m.group(1), source, count=1)
    name = rnd.choice(["form", "fieldset", "dialog"])
    first, last = (f"<{name}><article>", f"</article></{name}>") if where == "around" else (f"<article><{name}>", f"</{name}></article>")
    return _renamed(source, "article", first, last)


def _renamed(source: str, name: str, first: str, last: str) -> str:
    """The page with other tags in place of an element's (whatever its attributes)."""
    source = re.sub(rf"<{name}\b[^>]*>", lambda m: first, source, flags=re.I)
    return re.sub(rf"</{name}\s*>", lambda m: last, source, flags=re.I)


#: Words of page states and layouts, as themes put them on the body or a wrapper.
_STATES = ("has-sidebar", "no-sidebar", "header-fixed", "menu-open", "with-comments", "sidebar-layout", "page", "home blog", "no-js", "nav-collapsed", "single-post")


def _bare(source: str, rnd: random.Random) -> str:
    """The article's paragraphs as text without elements, or right in the body."""
    texts = re.findall(r"<p\b[^>]*>([^<]+)", source) or ["Some words, as they stand on pages."]
    text = rnd.choice(["\n", "<br>", "<br><br>", " "]).join(texts)
    return rnd.choice([text, f"<html><body>{text}</body></html>", f'<body class="{rnd.choice(_STATES)}">{text}'])


def variant(source: str, seed: int, in_form: bool = False) -> str:
    """The page with its parts renamed and boilerplate of its own paragraphs put in."""
    rnd = random.Random(seed)
    texts = [t for t in re.findall(r"<p\b[^>]*>([^<]+)", source)] or ["Some words, as they stand on pages."]
    said = lambda n=1: " ".join(rnd.choice(texts) for _ in range(n))
    if in_form:
        source = _in_form(source, random.Random(f"form {seed}"))
    name = rnd.choice(['div class="post-content"', 'div id="content"', "main", 'section class="entry"', 'div class="article-body"', "article"])
    if name != "article":
        source = _renamed(source, "article", f"<{name}>", f"</{name.split()[0]}>")
    elif rnd.random() < 0.5:
        source = _renamed(source, "article", f'<article class="{rnd.choice(_STATES)}">', "</article>")
    if rnd.random() < 0.5:
        name = rnd.choice(['div class="menu"', 'div id="navbar"', 'div class="breadcrumbs"'])
        source = _renamed(source, "nav", f"<{name}>", "</div>")
    if rnd.random() < 0.5:
        name = rnd.choice(['div class="footer"', 'div id="copyright"'])
        source = _renamed(source, "footer", f"<{name}>", "</div>")
    paragraphs = lambda: "".join(f"<p>{said()}</p>" for _ in range(rnd.randint(1, 4)))
    before = [f'<header><h2>{said()[:40]}</h2></header>', f'<div class="masthead">{said()[:60]}</div>',
              f'<div class="cookie-notice"><p>{said()}</p></div>', f'<div class="alert">{said()[:90]}</div>', f'<div id="banner">{said()}</div>']
    after = [f'<aside>{paragraphs()}</aside>', f'<div class="sidebar"><h3>{said()[:30]}</h3>{paragraphs()}</div>',
             f'<section id="comments"><div class="comment">{paragraphs()}</div><div class="comment">{paragraphs()}</div></section>',
             f'<ul class="comments"><li><p>{said()}</p></li><li>{said()}</li></ul>', f'<form action="/s"><label>{said()[:50]}</label></form>',
             f'<div class="related"><a href="/x">{said()[:60]}</a><a href="/y">{said()[:60]}</a></div>',
             f'<div class="newsletter"><p>{said()}</p></div>', f'<div class="share">{said()[:40]}</div>']
    source = re.sub(r"(<body[^>]*>)", lambda m: m.group(1) + "".join(rnd.sample(before, rnd.randint(0, 2))), source, count=1)
    if rnd.random() < 0.5:  # a wrapper of everything whose words name no part
        wrapper = f'<div class="{" ".join(rnd.sample(_STATES, rnd.randint(1, 3)))}">'
        source = re.sub(r"(<body[^>]*>)", lambda m: m.group(1) + wrapper, source, count=1)
        source = re.sub(r"(</body>|\Z)", lambda m: "</div>" + m.group(1), source, count=1)
    put_in = "".join(rnd.sample(after, rnd.randint(0, 3)))
    if rnd.random() < 0.5:  # inside the article, between its paragraphs or at its end
        at = [m.end() for m in re.finditer("</p>", source)]
        cut = rnd.choice(at) if at else len(source)
        return source[:cut] + put_in + source[cut:]
    return re.sub(r"(</body>|\Z)", lambda m: put_in + m.group(1), source, count=1)


def training_nodes(pages: DataFrame, n_pages: int = TRAIN_PAGES) -> DataFrame:
    """(features, label) of the labelled nodes of the sampled pages and their variants."""
    ids = pages.filter("page_id is not null and html is not null").select("page_id").distinct()
    ids = ids.orderBy(F.xxhash64("page_id"), "page_id").limit(n_pages)  # a fixed number of longs
    sample = pages.join(F.broadcast(ids), "page_id", "left_semi").select("page_id", "html")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for page_id, source in zip(pdf["page_id"], pdf["html"]):
                for v in range(2 + VARIANTS + FORM_VARIANTS):
                    seed = int(page_id) * 31 + v
                    if v > VARIANTS + FORM_VARIANTS:
                        page = dom.parse(_bare(source, random.Random(f"bare {seed}")))
                    else:
                        page = dom.parse(variant(source, seed, v > VARIANTS) if v else source)
                    labels, x = dom.teacher(page), dom.features(page)
                    own = np.flatnonzero((labels >= 0) & ~dom.never_content(page))
                    if len(own) > TRAIN_NODES:
                        own = np.sort(np.random.Generator(np.random.PCG64(abs(seed))).choice(own, TRAIN_NODES, replace=False))
                    if len(own):
                        yield pd.DataFrame({"page_id": int(page_id), "v": v, "node": own, "label": labels[own].astype(float), "x": list(x[own])})

    return sample.mapInPandas(run, "page_id long, v int, node int, label double, x array<double>")


def fit(pages: DataFrame) -> list[tuple[float, Tree]] | None:
    """The boosted trees as (weight, arrays); None where the sample has one class only."""
    nodes = materialize(training_nodes(pages), "html-nodes")
    if nodes.select("label").distinct().count() < 2:
        return None
    rows = nodes.sort("page_id", "v", "node").select("label", array_to_vector("x").alias("features"))
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=5, maxBins=64).fit(rows)
    return [(w, _arrays(t._call_java("rootNode"))) for w, t in zip(model.treeWeights, model.trees)]


def _arrays(root) -> Tree:
    """Feature (-1: leaf), threshold, children and prediction of a fitted tree's nodes."""
    rows: list[list] = []

    def add(node) -> int:
        at = len(rows)
        rows.append([-1, 0.0, 0, 0, node.prediction()])
        if node.subtreeDepth() > 0:
            split = node.split()
            rows[at][0], rows[at][1] = split.featureIndex(), split.threshold()
            rows[at][2] = add(node.leftChild())
            rows[at][3] = add(node.rightChild())
        return at

    add(root)
    columns = list(zip(*rows))
    return (np.array(columns[0]), np.array(columns[1], float), np.array(columns[2]), np.array(columns[3]), np.array(columns[4], float))


def log_odds(trees: list[tuple[float, Tree]], x: np.ndarray) -> np.ndarray:
    """Twice the trees' sum, as Spark's loss defines the log-odds."""
    total = np.zeros(len(x))
    for weight, (feature, threshold, left, right, value) in trees:
        at = np.zeros(len(x), int)
        for _ in range(DEPTH):
            f = feature[at]
            inner = f >= 0
            go_left = x[np.arange(len(x)), np.maximum(f, 0)] <= threshold[at]
            at = np.where(inner, np.where(go_left, left[at], right[at]), at)
        total += weight * value[at]
    return 2 * total


def extract_text(source: str | None, trees: list[tuple[float, Tree]] | None) -> str:
    page = dom.parse(source)
    logits = np.where(dom.teacher(page) == 1, 1.0, -1.0) if trees is None else log_odds(trees, dom.features(page))
    return "\n\n".join(dom.decode(page, logits, PRIOR))


def extract(pages: DataFrame, trees: list[tuple[float, Tree]] | None) -> DataFrame:
    """``pages`` with ``text``, the main text of ``html``."""

    def run(sources: pd.Series) -> pd.Series:
        return pd.Series([extract_text(s, trees) for s in sources], dtype=object)

    return pages.withColumn("text", F.pandas_udf(run, "string")(F.col("html")))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages")
    out = extract(pages.select("page_id", "url", "html"), fit(pages))
    return out.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
