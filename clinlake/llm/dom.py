"""Block tree of an HTML page and features of its nodes (plain Python, in tasks)."""

from __future__ import annotations

import html
import re
from collections import Counter
from typing import NamedTuple

import numpy as np

# Element names by their part in a page, and words of class, id
# and role attributes that name a part.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr br input link meta area base col embed param source track".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
NEVER = frozenset(
    "script style textarea title xmp iframe noembed noframes head noscript template svg math canvas object video audio "
    "select option button map datalist".split())
#: Elements that hold either controls or a whole article; their control density tells.
FORMS = frozenset("form fieldset dialog".split())
LISTS = frozenset("ul ol menu li".split())
CONTROLS = frozenset("input label select button textarea".split())
#: Forms of at most this many characters a control are boilerplate to ``teacher``.
CONTROL_CHARS = 100
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote body details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr li main menu nav ol p pre section table tr td th tbody thead tfoot ul dd dt".split())
TAG_KINDS = {
    "paragraph": "p blockquote pre dd figcaption".split(),
    "heading": "h1 h2 h3 h4 h5 h6".split(),
    "list": "ul ol li dl dt menu".split(),
    "table": "table tr td th tbody thead tfoot".split(),
    "article": "article main".split(),
    "navigation": "nav".split(),
    "header": "header".split(),
    "footer": "footer address".split(),
    "aside": "aside".split(),
    "form": "form".split(),
    "fieldset": "fieldset dialog".split(),
}
WORD_KINDS = {
    "advert": "ad ads adv advert adverts advertisement advertising adbox adslot banner sponsor sponsored promo promotion".split(),
    "navigation": "nav navbar navigation menu menus breadcrumb breadcrumbs topbar toolbar pagination pager toc tabs skip".split(),
    "sidebar": "sidebar side aside rail widget widgets related recommended popular trending more teaser".split(),
    "comment": "comment comments respond reply replies discussion disqus reader feedback review reviews".split(),
    "notice": "notice notices cookie cookies consent gdpr alert alerts popup modal overlay warning privacy legal disclaimer".split(),
    "header": "header masthead head logo site-header".split(),
    "footer": "footer foot copyright colophon bottom credits".split(),
    "form": "form search login signup subscribe subscription newsletter register share sharing social follow".split(),
    "content": "article content contents post entry story main body text page-content article-body".split(),
}
BOILERPLATE_WORDS = [k for k in WORD_KINDS if k != "content"]

_KIND_OF_TAG = {t: i for i, names in enumerate(TAG_KINDS.values()) for t in names}
_KIND_OF_WORD = {w: i for i, names in enumerate(WORD_KINDS.values()) for w in names}
_CONTENT_WORD = list(WORD_KINDS).index("content")
_ARTICLE_TAG = list(TAG_KINDS).index("article")
_OUTERMOST = frozenset(["#page", "html", "body"])
_BOILERPLATE_TAGS = [list(TAG_KINDS).index(k) for k in ("navigation", "header", "footer", "aside")]

_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
#: What ends a tag, or starts a quoted value in which nothing does.
_TAG_END = re.compile(r"""=\s*(["'])|>""")
_NAMING = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HIDDEN = re.compile(r"""\btype\s*=\s*["']?hidden\b""", re.I)
_WORDS = re.compile(r"[a-z]+")
# Words that make a class token tell a state or a layout of the page, not the part the element is.
STATE_FIRST = frozenset("has have no not with without is are hide show js enable disable".split())
STATE_ANY = frozenset("layout template open opened closed collapsed expanded fixed sticky static enabled disabled visible hidden shown toggled loaded ready".split())
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Page(NamedTuple):
    tags: list[str]
    words: list[frozenset]  # kinds of the words in naming attributes
    parents: list[int]
    runs: list[tuple[int, str, int]]  # node, text, characters inside links
    controls: list[int]  # visible form controls directly in the node


def _kinds(named: str) -> frozenset:
    """The kinds of the words in naming attributes; tokens that tell a state or a
    layout (``has-sidebar``, ``menu-open``) name no part."""
    out = set()
    for token in named.split():
        words = _WORDS.findall(_CAMEL.sub(" ", token).lower())
        if words and words[0] not in STATE_FIRST and not STATE_ANY.intersection(words):
            out.update(_KIND_OF_WORD[w] for w in words if w in _KIND_OF_WORD)
    return frozenset(out)


def parse(source: str | None) -> Page:
    """The page's block elements in order (node 0 is the page) and its text runs.

    A run is text without a block boundary inside; white space is made single
    blanks, character references are decoded, and runs without text are left out.
    """
    source = source or ""
    tags, words, parents, controls = ["#page"], [frozenset()], [-1], [0]
    runs: list[tuple[int, str, int]] = []
    open_nodes = [0]
    open_names: Counter = Counter()
    lists: list[int] = []  # depths of the open list elements and items
    pieces: list[str] = []
    linked, in_link, at, quotes_close = 0, False, 0, True

    def text(piece: str) -> None:
        nonlocal linked
        if piece:
            pieces.append(piece)
            if in_link:
                linked += len(piece)

    def boundary() -> None:
        nonlocal linked, in_link
        if pieces:
            joined = "".join(pieces)
            joined = " ".join((html.unescape(joined) if "&" in joined else joined).split())
            if joined:
                runs.append((open_nodes[-1], joined, min(linked, len(joined))))
            pieces.clear()
        linked, in_link = 0, False

    def leave(depth: int) -> None:
        for node in open_nodes[depth:]:
            open_names[tags[node]] -= 1
        del open_nodes[depth:]
        while lists and lists[-1] >= depth:
            lists.pop()

    def close(name: str) -> None:
        if open_names[name]:
            depth = len(open_nodes) - 1
            while tags[open_nodes[depth]] != name:
                depth -= 1
            leave(depth)

    def tag_end(start: int) -> int:
        """Where the tag's > is. A quoted value that nothing closes is bounded by the next >,
        and from there on every tag is, so that a page is read once; -1 if there is none."""
        nonlocal quotes_close
        at = start
        while quotes_close:
            m = _TAG_END.search(source, at)
            if m is None:
                break
            if m.group(1) is None:
                return m.start()
            at = source.find(m.group(1), m.end()) + 1
            quotes_close = at > 0
        quotes_close = False
        return source.find(">", start)

    while True:
        less = source.find("<", at)
        if less < 0:
            text(source[at:])
            break
        if source.startswith("<!--", less):
            text(source[at:less])
            end = source.find("-->", less + 4)
            at = end + 3 if end >= 0 else len(source)
            continue
        m = _NAME.match(source, less + 1)
        if m is None and source[less + 1:less + 2] not in ("!", "?"):
            text(source[at:less + 1])
            at = less + 1
            continue
        end = tag_end(m.end()) if m else source.find(">", less)
        if end < 0:  # no tag ends from here on
            text(source[at:])
            break
        text(source[at:less])
        at = end + 1
        if m is None:
            continue
        name, attributes = m.group(2), source[m.end():end]
        name = name.lower()
        if name in CONTROLS and not m.group(1) and not (name == "input" and _HIDDEN.search(attributes)):
            controls[open_nodes[-1]] += 1
        if name in INLINE:
            if name == "a":
                in_link = not m.group(1)
            elif name == "br":
                text(" ")
            continue
        boundary()
        if m.group(1):
            close(name)
            continue
        if name in ENDS_PARAGRAPH and tags[open_nodes[-1]] == "p":
            leave(len(open_nodes) - 1)
        if name == "li" and lists and tags[open_nodes[lists[-1]]] == "li":
            leave(lists[-1])
        if name in VOID:
            continue
        kinds = frozenset()
        if attributes and name not in ("html", "body"):  # words there tell of the whole page
            kinds = _kinds(" ".join(a or b or c for a, b, c in _NAMING.findall(attributes)))
        tags.append(name)
        words.append(kinds)
        controls.append(0)
        parents.append(open_nodes[-1])
        if name in RAW:
            end = re.compile(f"</{name}", re.I).search(source, at)
            at = end.start() if end else len(source)
        if not attributes.endswith("/") or name in RAW:
            if name in LISTS:
                lists.append(len(open_nodes))
            open_nodes.append(len(tags) - 1)
            open_names[name] += 1
    boundary()
    return Page(tags, words, parents, runs, controls)


def text_lengths(page: Page) -> np.ndarray:
    """Characters of every node's own and lower text."""
    total = np.zeros(len(page.tags))
    for node, run, _ in page.runs:
        total[node] += len(run)
    for i in range(len(total) - 1, 0, -1):
        total[page.parents[i]] += total[i]
    return total


def naming(page: Page, total: np.ndarray) -> list[frozenset]:
    """The kinds of every node's naming words, without boilerplate words on wrappers:
    nodes that hold most of the page's text, most of which is a named article's
    (or that are one)."""
    article = np.zeros(len(total))  # the longest text of a purely named article in the node
    for i in range(len(total) - 1, -1, -1):
        if _KIND_OF_TAG.get(page.tags[i]) == _ARTICLE_TAG or page.words[i] == {_CONTENT_WORD}:
            article[i] = total[i]
        if i:
            article[page.parents[i]] = max(article[page.parents[i]], article[i])
    out = list(page.words)
    for i, kinds in enumerate(page.words):
        if kinds and 2 * total[i] > total[0] and 2 * article[i] > total[i]:
            out[i] = kinds & {_CONTENT_WORD}
    return out


FEATURES = (
    "depth children own_length length link_share nodes_per_char page_share place sibling_place siblings sibling_length sentence_share "
    + "controls_per_char form_controls_per_char "
    + " ".join(f"tag_{k}" for k in TAG_KINDS) + " " + " ".join(f"word_{k}" for k in WORD_KINDS)
    + " under_boilerplate_tag under_boilerplate_word under_article_tag under_content_word"
).split()


def features(page: Page) -> np.ndarray:
    """A row of numbers (``FEATURES``) for every node."""
    n = len(page.tags)
    parents = np.array(page.parents)
    own, links, marks, start = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    seen = 0
    first_at = np.full(n, -1.0)
    for node, run, linked in page.runs:
        own[node] += len(run)
        links[node] += linked
        marks[node] += run.count(".") + run.count(",") + run.count("?") + run.count("!")
        if first_at[node] < 0:
            first_at[node] = seen
        seen += len(run)
    total, total_links, total_marks, nodes = own.copy(), links.copy(), marks.copy(), np.ones(n)
    controls = np.array(page.controls, float)
    children = np.zeros(n)
    begin = first_at.copy()
    for i in range(n - 1, 0, -1):
        p = parents[i]
        total[p] += total[i]
        total_links[p] += total_links[i]
        total_marks[p] += total_marks[i]
        nodes[p] += nodes[i]
        controls[p] += controls[i]
        children[p] += 1
        if begin[i] >= 0 and (begin[p] < 0 or begin[i] < begin[p]):
            begin[p] = begin[i]
    words, whole = naming(page, total), max(seen, 1)
    out = np.zeros((n, len(FEATURES)))
    n_tags, n_words = len(TAG_KINDS), len(WORD_KINDS)
    tag_at, word_at = 14, 14 + n_tags
    out[:, 12] = controls / (total + 1)
    under_at = word_at + n_words
    child_number, depth = np.zeros(n), np.zeros(n)
    counted = np.zeros(n)
    for i in range(n):
        p = parents[i]
        if p >= 0:
            depth[i] = depth[p] + 1
            child_number[i] = counted[p]
            counted[p] += 1
            out[i, under_at:] = out[p, under_at:]
            tag, kinds = _KIND_OF_TAG.get(page.tags[p]), words[p]
            out[i, under_at] = max(out[i, under_at], tag in _BOILERPLATE_TAGS)
            if any(k != _CONTENT_WORD for k in kinds):  # the more of the page it holds, the less that says
                out[i, under_at + 1] = max(out[i, under_at + 1], 1 - total[p] / whole)
            out[i, under_at + 2] = max(out[i, under_at + 2], tag == _ARTICLE_TAG)
            out[i, under_at + 3] = max(out[i, under_at + 3], _CONTENT_WORD in kinds)
            out[i, 13] = out[p, 13]
        if page.tags[i] in FORMS:
            out[i, 13] = out[i, 12]
        kind = _KIND_OF_TAG.get(page.tags[i])
        if kind is not None:
            out[i, tag_at + kind] = 1
        for k in words[i]:
            out[i, word_at + k] = 1
    p = np.maximum(parents, 0)
    siblings = np.where(parents >= 0, children[p], 1)
    out[:, 0] = depth
    out[:, 1] = children
    out[:, 2] = np.log1p(own)
    out[:, 3] = np.log1p(total)
    out[:, 4] = total_links / np.maximum(total, 1)
    out[:, 5] = nodes / (total + 1)
    out[:, 6] = total / whole
    out[:, 7] = np.maximum(begin, 0) / whole
    out[:, 8] = child_number / np.maximum(siblings, 1)
    out[:, 9] = siblings
    out[:, 10] = np.log1p(np.where(parents >= 0, (total[p] - own[p]) / np.maximum(siblings, 1), total))
    out[:, 11] = total_marks / np.maximum(total, 1)
    return out


def never_content(page: Page) -> np.ndarray:
    """Nodes of elements that hold no article text, and what is below them."""
    out = np.zeros(len(page.tags), bool)
    for i, tag in enumerate(page.tags):
        out[i] = tag in NEVER or (i > 0 and out[page.parents[i]])
    return out


def _control_forms(page: Page) -> np.ndarray:
    """Forms that are there for their controls: dense in them, and no article is named inside."""
    n = len(page.tags)
    length, controls, article = np.zeros(n), np.array(page.controls, float), np.zeros(n, bool)
    for node, run, _ in page.runs:
        length[node] += len(run)
    for i in range(n - 1, -1, -1):
        article[i] |= _KIND_OF_TAG.get(page.tags[i]) == _ARTICLE_TAG or _CONTENT_WORD in page.words[i]
        if i:
            p = page.parents[i]
            length[p] += length[i]
            controls[p] += controls[i]
            article[p] |= article[i]
    is_form = np.array([t in FORMS for t in page.tags], bool)
    return is_form & ~article & (controls > 0) & (length <= CONTROL_CHARS * controls)


def teacher(page: Page) -> np.ndarray:
    """Labels by the page's own words: 1 article, 0 boilerplate, -1 not said."""
    out = np.full(len(page.tags), -1)
    forms, words = _control_forms(page), naming(page, text_lengths(page))
    bare = all(page.tags[node] in _OUTERMOST for node, _, _ in page.runs)  # text without elements is the page's text
    for i, tag in enumerate(page.tags):
        above = out[page.parents[i]] if i else -1
        kind = _KIND_OF_TAG.get(tag)
        if bare and tag in _OUTERMOST:
            out[i] = 1
        elif above == 0 or tag in NEVER or forms[i] or kind in _BOILERPLATE_TAGS or any(k != _CONTENT_WORD for k in words[i]):
            out[i] = 0
        elif above == 1 or kind == _ARTICLE_TAG or _CONTENT_WORD in words[i]:
            out[i] = 1
    return out


def decode(page: Page, logits: np.ndarray, prior: float) -> list[str]:
    """The runs of kept nodes: the best choice in which nothing below a dropped
    node is kept (a node's gain is its log-odds times its own text, ``prior``
    characters at least)."""
    n = len(page.tags)
    own = np.full(n, prior)
    for node, run, _ in page.runs:
        own[node] += len(run)
    gain = own * logits
    gain[0] = max(gain[0], 0) if not any(node == 0 for node, _, _ in page.runs) else gain[0]
    for i, tag in enumerate(page.tags):
        if tag in ("html", "body"):  # wrappers of everything say nothing
            gain[i] = max(gain[i], 0)
    gain[never_content(page)] = -np.inf
    best = gain.copy()
    for i in range(n - 1, 0, -1):
        if best[i] > 0:
            best[page.parents[i]] += best[i]
    kept = np.zeros(n, bool)
    for i in range(n):
        kept[i] = best[i] > 0 and (i == 0 or kept[page.parents[i]])
    return [run for node, run, _ in page.runs if kept[node] and logits[node] > 0]
