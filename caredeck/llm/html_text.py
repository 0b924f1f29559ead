"""Main text of web pages: flat text blocks, neighbour densities, a decision tree fitted on a small labelled table."""

import functools
import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import ship_package
from .html_labels import LABELLED

# Element names and class words of the web.
RAW = "script style title noscript template iframe textarea svg select object math".split()
INLINE = (
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub "
    "sup time tt u var wbr"
).split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
BOILERPLATE = "nav footer aside form button dialog menu fieldset".split()
CONTENT = "article main".split()
BOILERPLATE_WORDS = (
    "ad ads advert advertisement advertising alert banner breadcrumb breadcrumbs byline comment comments consent cookie cookies "
    "copyright disqus footer gdpr header login menu modal nav navbar navigation newsletter notice outbrain pager pagination popup "
    "promo promoted related reply respond search share sharing sidebar signup social sponsor sponsored subscribe taboola tags toolbar "
    "widget"
).split()
CONTENT_WORDS = "article body content entry main post story text".split()

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^<>\"']*(?:\"[^\"]*\"[^<>\"']*|'[^']*'[^<>\"']*)*)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_WORD = re.compile(r"[a-z]+")
_CLOSE = {name: re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I) for name in RAW}

FEATURES = (
    "words", "link_density", "words_before", "links_before", "words_after", "links_after", "in_content", "in_boilerplate", "heading",
    "outside",
)


def _kind(name, attributes, inside_content):
    """What an element says about its content: 1 content, -1 boilerplate, 0 nothing."""
    if _HIDDEN.search(attributes):
        return -1
    if name in BOILERPLATE or (name == "header" and not inside_content):
        return -1
    words = set()
    for groups in _NAMES.findall(attributes):
        words.update(_WORD.findall("".join(groups).lower()))
    if words & _BOILERPLATE_WORDS and name not in ("body", "html"):
        return -1
    if name in CONTENT or (words & _CONTENT_WORDS and name not in ("body", "html")):
        return 1
    return 0


_BOILERPLATE_WORDS, _CONTENT_WORDS = frozenset(BOILERPLATE_WORDS), frozenset(CONTENT_WORDS)
_INLINE, _VOID, _RAW = frozenset(INLINE), frozenset(VOID), frozenset(RAW)


def blocks(page):
    """Flat text blocks of a page in order: (text, words, linked words, in content, in boilerplate, heading)."""
    out, parts, linked = [], [], []
    stack, links = [], 0
    content = boilerplate = 0
    at, heading = 0, False

    def add(raw):
        text = html.unescape(raw)
        parts.append(text)
        if links:
            linked.append(text)

    def flush():
        text = " ".join("".join(parts).split())
        if text:
            out.append((text, text.count(" ") + 1, len(" ".join(linked).split()), int(content > 0), int(boilerplate > 0), int(heading)))
        parts.clear()
        linked.clear()

    for m in iter(lambda: _TAG.search(page, at), None):
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        closing = m[1] or m[4]
        attributes = m[3] or m[6] or ""
        if not name:
            continue
        if name in _RAW:
            if not closing and not attributes.endswith("/"):
                end = _CLOSE[name].search(page, at)
                at = end.end() if end else len(page)
            continue
        if name in _INLINE:
            if name == "a":
                links = 0 if closing else 1
            elif name in ("br", "img"):
                parts.append(" ")
                if links:
                    linked.append(" ")
            continue
        flush()
        if name[0] == "h" and name[1:].isdigit():
            heading = not closing
            continue
        heading = False
        if name in _VOID or name == "p":
            links = 0
            continue
        if closing:
            names = [n for n, _ in stack]
            if name in names:
                while stack:
                    n, kind = stack.pop()
                    content -= kind == 1
                    boilerplate -= kind == -1
                    if n == name:
                        break
            links = 0
        elif not attributes.endswith("/"):
            kind = _kind(name, attributes, content > 0)
            stack.append((name, kind))
            content += kind == 1
            boilerplate += kind == -1
    if at < len(page):
        add(page[at:])
    flush()
    return out


def features(found):
    """A row of FEATURES per block; before the first and after the last block stand empty ones.

    `outside`: the page marks content, and this block is not in it.
    """
    words = np.array([b[1] for b in found], float)
    density = np.array([b[2] / b[1] for b in found], float)
    shifted = lambda x, by: np.concatenate(([0.0], x[:-1]) if by > 0 else (x[1:], [0.0]))
    flags = np.array([b[3:] for b in found], float).reshape(len(found), 3)
    outside = flags[:, 0].max() - flags[:, 0]
    return np.column_stack(
        (words, density, shifted(words, 1), shifted(density, 1), shifted(words, -1), shifted(density, -1), flags, outside)
    )


def grow(x, y, depth=6, least=2):
    """A binary decision tree by Gini impurity: (feature, threshold, low side, high side) or a leaf's 0 or 1."""
    share = y.mean()
    if depth == 0 or share in (0.0, 1.0) or len(y) < 2 * least:
        return int(share >= 0.5)
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= cut
            n = low.sum()
            if min(n, len(y) - n) < least:
                continue
            a, b = y[low].mean(), y[~low].mean()
            impurity = n * a * (1 - a) + (len(y) - n) * b * (1 - b)
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, f, cut, low)
    if best is None or best[0] >= len(y) * share * (1 - share) - 1e-12:
        return int(share >= 0.5)
    _, f, cut, low = best
    return f, float(cut), grow(x[low], y[low], depth - 1, least), grow(x[~low], y[~low], depth - 1, least)


def decide(tree, row):
    while isinstance(tree, tuple):
        f, cut, low, high = tree
        tree = low if row[f] <= cut else high
    return tree


def labelled_table(pages=LABELLED):
    """Features and labels of the blocks of the labelled pages; a block is content if its text is listed."""
    x, y = [], []
    for page, wanted in pages:
        found = blocks(page)
        x.append(features(found))
        y += [int(b[0] in wanted) for b in found]
    return np.vstack(x), np.array(y, float)


def fitted_tree():
    return grow(*labelled_table())


def main_text(page, tree):
    """Blocks the tree takes for content, joined by two line ends."""
    found = blocks(page) if page else []
    if not found:
        return ""
    return "\n\n".join(b[0] for b, row in zip(found, features(found).tolist(), strict=True) if decide(tree, row))


def _extract_batches(batches, tree):
    for batch in batches:
        texts = [main_text(page, tree) for page in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages, tree=None):
    """Row per page: page_id, url, text, n_chars (code points).

    Every page is cut into flat text blocks at block elements; a block's words, its share of linked words, both of
    its neighbours, and whether content or boilerplate elements surround it go to a decision tree, fitted on the
    labelled pages of html_labels. Character references are decoded, white space inside a block becomes one
    space. One pass, no shuffle; the whole page is read, and nothing is capped.

    Null or empty html, or none that counts as content: empty text. Null page_id or url stay null; repeated rows
    are extracted alike. An empty table gives an empty result; other columns are ignored.
    """
    ship_package(pages.sparkSession)
    job = functools.partial(_extract_batches, tree=fitted_tree() if tree is None else tree)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(job, "page_id long, url string, text string, n_chars long")
