"""Main text of web pages, by a graphical model over the tree of their elements.

Every element that lays out a block, and every run of text beside such
elements, is a node that is content or not. A node's own potential depends on
its element, names and figures of its text; the potential of an edge on both
ends, so that what lies in a sidebar is rarely content and what lies in an
article mostly is. Messages go up from the leaves and down again; with both,
the sum over all labellings of the page gives each node its marginal exactly.
Texts of nodes with a marginal above one half are kept.

The weights are trained by gradient ascent on the likelihood of labelled pages:
PAGES pages drawn from a seed (page_samples), a bound that does not depend on
the input. Training takes seconds on the driver; the weights, about a hundred
numbers, go to the tasks. Many pages are one forest whose levels are numpy
arrays.

A missing or empty page has an empty text, as has one without any text in the
model's favour. Repeated rows, missing ids and urls are returned as they are;
columns other than page_id, url and html are ignored; an empty table gives an
empty result. Pages of any length and depth are read whole, in linear time.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm import page_samples
from haulmark.llm.dom import HEADINGS, TEXT, Page, parse

PAGES = 500
ROUNDS = 150
DECAY = 1e-5
TOGETHER = 1 << 20  # characters of pages in one forest

# Elements of like meaning, and words in names and texts that speak for or against content.
ELEMENTS = (
    ("",), ("html", "body"), ("article",), ("main",), ("section",), ("div", "center"), ("p",), ("h1",), HEADINGS[1:], ("ul", "ol", "dl", "menu"),
    ("li", "dt", "dd"), ("nav",), ("header", "hgroup"), ("footer",), ("aside",), ("form", "fieldset", "legend", "search"),
    ("table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption"), ("blockquote", "pre"), ("figure", "figcaption"),
    ("address",), ("details", "summary", "dialog"), (TEXT,),
)
NAMES = (
    ("content", "article", "post", "entry", "story", "text", "hentry"),
    ("nav", "menu", "navbar", "navigation", "breadcrumb", "breadcrumbs", "toc", "pagination", "tabs", "tags", "links"),
    ("header", "masthead", "topbar", "top", "branding", "logo", "banner"),
    ("footer", "colophon", "bottom", "copyright", "legal", "contentinfo"),
    ("sidebar", "side", "widget", "related", "recommended", "secondary", "more", "complementary", "aside"),
    ("cookie", "cookies", "notice", "gdpr", "consent", "popup", "modal", "alert", "message", "announcement", "overlay", "dialog"),
    ("ad", "ads", "advert", "adverts", "advertisement", "sponsored", "sponsor", "promo", "adsbygoogle", "promotion"),
    ("search", "login", "newsletter", "subscribe", "signup", "form", "share", "social", "sharing", "signin"),
    ("comment", "comments", "discussion", "reply", "replies", "responses", "disqus", "respond"),
    ("main", "body"),
)
CUES = frozenset(page_samples.CUES) | {"cookie", "copyright", "©", "menu", "advertising", "sign", "register", "accept", "follow"}
ELEMENT_NO = {tag: no for no, tags in enumerate(ELEMENTS) for tag in tags}
NAME_NO = {word: no for no, words in enumerate(NAMES) for word in words}
ENDS = (".", "!", "?", "…", "。", '."', ".)", "!”", ".”", ":")
STEPS = (1, 4, 11, 31, 101)  # borders of classes of word counts
FEATURES = len(ELEMENTS) + len(NAMES) + 2 * (len(STEPS) + 1) + 15
EDGES = 6  # to an element with elements inside, to one with text, to a run of text; each from the body and from others


@dataclass
class Forest:
    """Pages as one forest. parent: -1 for the documents; levels: node numbers by depth; order: parents first."""

    parent: np.ndarray
    edge: np.ndarray
    features: np.ndarray
    levels: list[np.ndarray]
    labels: np.ndarray
    texts: list[list[str]]


def forest(pages: list[Page]) -> Forest:
    begins = np.cumsum([0] + [len(p.tag) for p in pages])
    n = int(begins[-1])
    parent = np.concatenate([np.array(p.parent, np.int64) + b for p, b in zip(pages, begins, strict=False)])
    roots = begins[:-1]
    parent[roots] = -1
    page = np.repeat(np.arange(len(pages)), np.diff(begins))

    tags, names = np.zeros(n, np.int64), np.zeros((n, len(NAMES)), bool)
    words, ended, cues = np.zeros(n), np.zeros(n), np.zeros(n)
    own, linked, controls, hidden = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n, bool)
    labels = np.zeros(n, bool)
    for p, b in zip(pages, begins.tolist(), strict=False):
        for i, tag in enumerate(p.tag):
            at = b + i
            tags[at] = ELEMENT_NO.get(tag, 0)
            for word in p.names[i]:
                if word in NAME_NO:
                    names[at, NAME_NO[word]] = True
            if text := p.text[i]:
                own[at], linked[at] = len(text), p.linked[i]
                words[at] = text.count(" ") + 1
                ended[at] = text.endswith(ENDS)
                if len(text) < 400:
                    cues[at] = sum(w.strip(".,:;!?") in CUES for w in text.lower().split())
        controls[b : b + len(p.tag)] = p.controls
        hidden[b : b + len(p.tag)] = p.hidden
        labels[b : b + len(p.tag)] = p.labelled

    depth, levels = np.zeros(n, np.int64), [roots]
    for p, b in zip(pages, begins.tolist(), strict=False):
        deep = [0] * len(p.tag)
        for i in range(1, len(p.tag)):
            deep[i] = deep[p.parent[i]] + 1
        depth[b : b + len(p.tag)] = deep
    by_depth = np.argsort(depth, kind="stable")
    levels = np.split(by_depth, np.flatnonzero(np.diff(depth[by_depth])) + 1)

    texts = own > 0
    paragraphs = (tags == ELEMENT_NO["p"]) & texts
    title = tags == ELEMENT_NO["h1"]
    sums = np.stack([words, own, linked, controls, texts, paragraphs, ended, cues, title, labels, np.ones(n)]).astype(np.float64)
    for level in reversed(levels[1:]):
        np.add.at(sums, (slice(None), parent[level]), sums[:, level])
    all_words, chars, in_links, all_controls, runs, all_paragraphs, all_ended, all_cues, titles, content, size = sums
    total = np.maximum(chars[roots], 1)[page]
    # text before a node, as a share of the page: nodes are numbered in the order of the page
    before = np.cumsum(own) - own
    place = (before - before[roots][page]) / total
    share, link_share = chars / total, in_links / np.maximum(chars, 1)
    mean = all_words / np.maximum(runs, 1)

    def one_of(values: np.ndarray, several: int) -> np.ndarray:
        return values[:, None] == np.arange(several)

    features = np.concatenate(
        [
            one_of(tags, len(ELEMENTS)),
            names,
            one_of(np.searchsorted(STEPS, all_words, "right"), len(STEPS) + 1),
            one_of(np.searchsorted(STEPS, mean, "right"), len(STEPS) + 1),
            np.stack(
                [
                    np.ones(n), link_share > 0.5, link_share > 0.2, share > 0.5, share > 0.2, place < 0.02,
                    place + share > 0.98, all_paragraphs >= 2, titles > 0, all_controls > 0, hidden,
                    np.minimum(all_cues / np.maximum(runs, 1), 1), all_ended / np.maximum(runs, 1) > 0.5,
                    (runs > 1) & texts, all_controls / np.maximum(runs, 1) > 0.3,
                ],
                axis=1,
            ),
        ],
        axis=1,
    ).astype(np.float64)
    edge = np.where(tags == ELEMENT_NO[TEXT], 2, np.where(size > 1, 0, 1)) + 3 * (tags[parent] <= ELEMENT_NO["body"])
    return Forest(parent, edge, features, levels, content > 0, [p.text for p in pages])


def added(a: np.ndarray, axis: int) -> np.ndarray:
    """Sum of exponentials along an axis, as a logarithm."""
    return np.logaddexp(*np.moveaxis(a, axis, 0))


def messages(f: Forest, weights: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals of nodes (n, 2) and of edges (n, parent's label, label), and the log of the sum over all labellings.

    edges: potentials by kind, parent's label and label.
    """
    n = len(f.parent)
    below = np.zeros((n, 2))
    below[:, 1] = f.features @ weights
    pair = edges[f.edge]
    up = np.zeros((n, 2))
    for level in reversed(f.levels[1:]):
        up[level] = added(pair[level] + below[level][:, None, :], 2)
        np.add.at(below, f.parent[level], up[level])
    above = np.zeros((n, 2))
    joint = np.zeros((n, 2, 2))
    for level in f.levels[1:]:
        mother = f.parent[level]
        rest = above[mother] + below[mother] - up[level]
        joint[level] = rest[:, :, None] + pair[level] + below[level][:, None, :]
        above[level] = added(rest[:, :, None] + pair[level], 1)
    whole = above + below
    sums = added(whole, 1)
    roots = f.levels[0]
    nodes = np.exp(whole - sums[:, None])
    pairs = np.exp(joint - sums[:, None, None])
    pairs[roots] = 0
    return nodes, pairs, float(sums[roots].sum())


@dataclass
class Model:
    weights: np.ndarray
    edges: np.ndarray

    def content(self, pages: list[Page]) -> Iterator[str]:
        """The main text of each page."""
        f = forest(pages)
        kept = messages(f, self.weights, self.edges)[0][:, 1] > 0.5
        at = 0
        for texts in f.texts:
            here = kept[at : at + len(texts)].tolist()
            yield "\n".join([text for text, keep in zip(texts, here, strict=True) if keep and text])
            at += len(texts)


def trained(pages: Iterable[str], rounds: int = ROUNDS, decay: float = DECAY) -> Model:
    """Weights of greatest likelihood, less a penalty on large ones, by gradient ascent with a step size per weight."""
    f = forest([parse(html) for html in pages])
    n = len(f.parent)
    y = f.labels.astype(np.int64)
    inner = f.parent >= 0
    seen = np.zeros((EDGES, 2, 2))
    np.add.at(seen, (f.edge[inner], y[f.parent[inner]], y[inner]), 1)
    size = FEATURES + EDGES * 4
    at, speed, last = np.zeros(size), np.full(size, 0.3), np.zeros(size)
    for _ in range(rounds):
        nodes, pairs, _ = messages(f, at[:FEATURES], at[FEATURES:].reshape(EDGES, 2, 2))
        expected = np.zeros((EDGES, 2, 2))
        np.add.at(expected, f.edge, pairs)
        slope = np.concatenate([f.features.T @ (y - nodes[:, 1]), (seen - expected).ravel()]) / n - decay * at
        speed = np.clip(np.where(slope * last > 0, speed * 1.2, np.where(slope * last < 0, speed * 0.5, speed)), 1e-6, 1.0)
        last = np.where(slope * last < 0, 0, slope)
        at = at + np.sign(last) * speed
    return Model(at[:FEATURES], at[FEATURES:].reshape(EDGES, 2, 2))


@lru_cache(maxsize=1)
def default_model() -> Model:
    return trained(page_samples.pages(PAGES))


def main_text(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    model = model or default_model()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            html = batch.column("html")
            row = 0
            while row < len(html):
                held, end, size = [], row, 0
                while end < len(html) and (end == row or size < TOGETHER):
                    source = html[end].as_py() or ""
                    held.append(parse(source))
                    size += len(source)
                    end += 1
                texts = list(model.content(held))
                columns = [batch.column(c).slice(row, end - row) for c in ("page_id", "url")]
                columns += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])
                row = end

    wanted = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return wanted.mapInArrow(task, "page_id bigint, url string, text string, n_chars bigint")
