"""Main text of HTML pages by a tree-structured graphical model over the page's block elements.

Each block element is a node with a binary label (main text or not).  Its own evidence (tag, names in
class and id, length and link share of its text) gives a unary potential, parent and child share a
pairwise one, and sum-product message passing, up the tree and down again, gives every node's exact
marginal.  Text of nodes whose marginal passes one half is kept, in page order.

Weights are fitted by gradient ascent of the labels' likelihood, the expectations coming from the same
message passing, on labelled pages: a bounded sample of the table's pages that mark their article
themselves (the mark is hidden from the model on every second one, so that the other evidence has to
carry it) and made-up pages that hold what such a table may lack (`seed_pages`).
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches

#: Labelled pages taken from the table at most, characters of a page that is learned from at most, made-up
#: pages, and passes over all of them.
SAMPLE_PAGES, SAMPLE_CHARS, SEED_PAGES, EPOCHS, RATE, DECAY = 120, 60_000, 120, 60, 0.15, 1e-4

_TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^>]*+)>|<!--|<[!?/][^>]*+>""")
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'])(class|id|role|data-y)\s{0,9}=\s{0,9}("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

BLOCKS = frozenset("""html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption
nav header footer aside form fieldset blockquote pre figure figcaption address details summary center hr head""".split())
#: Content that is never text of a page: to its end tag, and without one to the page's end, as HTML reads it,
RAW = frozenset("script style title textarea".split())
#: and to its end tag, if there is one; without one only the start tag is left out.
SKIPPED = frozenset("template iframe svg canvas select button audio video".split())
_CLOSE_SILENT = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in RAW | SKIPPED}
_VOID = frozenset("hr br img input meta link area base col embed source track wbr".split())
#: A start tag closes an open element of these kinds (within the nearest of the last ones).
CLOSES = {"li": (("li",), ("ul", "ol")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
          "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table"))}

TAG_KINDS = {"article": "article", "main": "article", "p": "p", "nav": "nav", "header": "header", "footer": "footer", "aside": "aside",
             "form": "form", "fieldset": "form", "li": "list", "ul": "list", "ol": "list", "dl": "list", "dt": "list", "dd": "list",
             "table": "table", "tr": "table", "td": "table", "th": "table", "tbody": "table", "thead": "table",
             "blockquote": "quote", "pre": "quote", "figure": "quote", "figcaption": "quote", "head": "head",
             **{f"h{k}": "heading" for k in range(1, 7)}}
NAME_KINDS = {
    "advert": "ad ads advert advertisement advertising sponsor sponsored promo promotion banner",
    "menu": "nav navigation navbar menu breadcrumb breadcrumbs toolbar pagination pager tabs",
    "side": "sidebar side aside widget related recommended popular trending more",
    "notice": "cookie cookies consent notice gdpr popup modal overlay alert paywall",
    "comments": "comment comments reply replies respond disqus discussion",
    "edge": "header footer masthead copyright colophon legal",
    "share": "share sharing social follow newsletter subscribe signup login search form",
    "content": "content article post entry story body text main prose",
}
_NAMES = {name: kind for kind, names in NAME_KINDS.items() for name in names.split()}
FEATURES = ("bias", *(f"tag:{k}" for k in sorted({*TAG_KINDS.values(), "box"})), *(f"name:{k}" for k in sorted(NAME_KINDS)), "hidden",
            "text:none", "text:short", "text:middle", "text:long", "links:some", "links:most", "below:links", "below:text", "sentence", "copyright")
_AT = {name: k for k, name in enumerate(FEATURES)}


class Page:
    """A page as a tree of block elements: ``parent``, ``features`` and ``label`` (None: not given) by
    node, and the runs of text ``(node, text)`` in page order."""

    def __init__(self, source: str) -> None:
        self.parent: list[int] = [-1]
        self.tags: list[str] = ["html"]
        self.marks: list[list[int]] = [[]]
        self.label: list[int | None] = [None]
        self.runs: list[tuple[int, str]] = []
        self.link_chars: list[int] = [0]
        self._read(source)

    def _read(self, source: str) -> None:
        stack, open_count = [0], {"html": 1}
        pieces: list[str] = []
        in_link = links = at = 0
        unclosed: set[str] = set()

        def flush() -> None:
            nonlocal links
            if pieces:
                text = " ".join(html.unescape("".join(pieces)).split())
                if text:
                    self.runs.append((stack[-1], text))
                    self.link_chars[stack[-1]] += min(links, len(text))
                pieces.clear()
            links = 0

        def pop_to(depth: int) -> None:
            while len(stack) > depth:
                open_count[self.tags[stack.pop()]] -= 1

        end = len(source)
        while at < end:
            m = _TAG.search(source, at)
            stop = m.start() if m else end
            if stop > at:
                pieces.append(source[at:stop])
                if in_link:
                    links += stop - at
            if not m:
                break
            at = m.end()
            closing, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
            if tag is None:
                if m.group() == "<!--":
                    found = source.find("-->", at)
                    at = end if found < 0 else found + 3
                continue
            tag = tag.lower()
            if closing:
                if tag == "a":
                    in_link = max(0, in_link - 1)
                elif tag == "noscript":
                    flush()
                elif tag in BLOCKS:
                    flush()
                    if open_count.get(tag) and tag != "html":
                        depth = len(stack) - 1
                        while self.tags[stack[depth]] != tag:
                            depth -= 1
                        pop_to(max(depth, 1))
                        in_link = 0
                continue
            if tag in _CLOSE_SILENT:
                if not attributes.endswith("/") and tag not in unclosed:
                    found = _CLOSE_SILENT[tag].search(source, at)
                    if found:
                        at = found.start()
                    elif tag in RAW:
                        at = end
                    else:
                        unclosed.add(tag)       # nor is any after it
                pieces.append(" ")
            elif tag == "a":
                in_link += not attributes.endswith("/")
            elif tag == "br":
                pieces.append(" ")
            elif tag == "noscript":         # what is in it is read as if it stood alone
                flush()
            elif tag in BLOCKS:
                flush()
                if tag == "html":
                    continue
                if open_count.get("p"):
                    depth = len(stack) - 1
                    while self.tags[stack[depth]] != "p":
                        depth -= 1
                    pop_to(depth)
                kinds, bounds = CLOSES.get(tag, ((), ()))
                if any(open_count.get(k) for k in kinds):
                    depth = len(stack) - 1
                    while depth > 0 and self.tags[stack[depth]] not in bounds and self.tags[stack[depth]] not in kinds:
                        depth -= 1
                    if depth > 0 and self.tags[stack[depth]] in kinds:
                        pop_to(depth)
                in_link = 0
                if tag not in _VOID:
                    self._add(stack[-1], tag, attributes)
                    stack.append(len(self.parent) - 1)
                    open_count[tag] = open_count.get(tag, 0) + 1
        flush()

    def _add(self, parent: int, tag: str, attributes: str) -> None:
        marks, label = [_AT[f"tag:{TAG_KINDS.get(tag, 'box')}"]], None
        if attributes:
            for name, value in _ATTRIBUTE.findall(attributes):
                value = value.strip("\"'")
                if name == "data-y":
                    label = int(value == "1")
                else:
                    marks += [_AT[f"name:{_NAMES[t]}"] for t in map(str.lower, _TOKEN.findall(value)) if t in _NAMES]
            if _HIDDEN.search(attributes):
                marks.append(_AT["hidden"])
        self.parent.append(parent)
        self.tags.append(tag)
        self.marks.append(marks)
        self.label.append(label)
        self.link_chars.append(0)

    def features(self, hide_article: bool = False) -> np.ndarray:
        """(nodes, FEATURES) of zeros and ones."""
        n = len(self.parent)
        chars, sentence, sign = [0] * n, [False] * n, [False] * n
        for node, text in self.runs:
            chars[node] += len(text)
            sentence[node] |= text[-1] in ".!?…\"”" and len(text) > 20
            sign[node] |= "©" in text or "copyright" in text[:200].lower()
        below, linked = list(chars), list(self.link_chars)
        for k in range(n - 1, 0, -1):
            below[self.parent[k]] += below[k]
            linked[self.parent[k]] += linked[k]
        out = np.zeros((n, len(FEATURES)))
        out[:, 0] = 1
        for k in range(n):
            row, own = out[k], chars[k]
            row[self.marks[k]] = 1
            row[_AT["text:none" if not own else "text:short" if own < 25 else "text:middle" if own < 100 else "text:long"]] = 1
            share = self.link_chars[k] / own if own else 0
            if share > 0.1:
                row[_AT["links:most" if share > 0.5 else "links:some"]] = 1
            row[_AT["below:links"]] = below[k] > own and linked[k] > 0.5 * below[k]
            row[_AT["below:text"]] = below[k] > 400 and linked[k] < 0.2 * below[k]
            row[_AT["sentence"]], row[_AT["copyright"]] = sentence[k], sign[k]
        if hide_article:
            hidden = out[:, _AT["tag:article"]] == 1
            out[hidden, _AT["tag:article"]] = 0
            out[hidden, _AT["tag:box"]] = 1
        return out


def _logistic(x):
    return 0.5 + 0.5 * np.tanh(0.5 * np.asarray(x, float))


class TreeModel:
    """Unary weights, and pairwise weights ``pair[kind][parent label][child label]``; kind 1 is a child
    that has text of its own."""

    def __init__(self) -> None:
        self.unary = np.zeros(len(FEATURES))
        self.pair = np.zeros((2, 2, 2))

    def messages(self, parent: list[int], kind: np.ndarray, own: np.ndarray) -> tuple[list[float], list[float], list[float]]:
        """Log odds of each node: of the tree below it, of all but what is below it (seen from it), and its
        message to its parent.  Parents stand before their children."""
        from math import exp, log
        n = len(parent)
        e = np.exp(self.pair).tolist()
        below, up = own.tolist(), [0.0] * n
        for k in range(n - 1, 0, -1):
            w = e[kind[k]]
            x = exp(min(max(below[k], -50.0), 50.0))
            up[k] = log((w[1][0] + w[1][1] * x) / (w[0][0] + w[0][1] * x))
            below[parent[k]] += up[k]
        down = [0.0] * n
        for k in range(1, n):
            p = parent[k]
            w = e[kind[k]]
            x = exp(min(max(below[p] + down[p] - up[k], -50.0), 50.0))
            down[k] = log((w[0][1] + w[1][1] * x) / (w[0][0] + w[1][0] * x))
        return below, down, up

    def marginals(self, page: Page) -> np.ndarray:
        features = page.features()
        below, down, _ = self.messages(page.parent, self.kinds(features), features @ self.unary)
        return _logistic(np.add(below, down))

    @staticmethod
    def kinds(features: np.ndarray) -> np.ndarray:
        return (features[:, _AT["text:none"]] == 0).astype(int)

    def fit(self, pages: list[tuple[list[int], np.ndarray, np.ndarray]], epochs: int = EPOCHS, rate: float = RATE) -> list[float]:
        """Gradient ascent on the log likelihood of ``(parent, features, labels)``; returns the mean
        probability of the right label by epoch."""
        history, speed = [], [np.zeros_like(self.unary), np.zeros_like(self.pair)]
        for _ in range(epochs if pages else 0):
            g_unary, g_pair, right, total = np.zeros_like(self.unary), np.zeros_like(self.pair), 0.0, 0
            for parent, features, y in pages:
                kind = self.kinds(features)
                below, down, up = self.messages(parent, kind, features @ self.unary)
                p = _logistic(np.add(below, down))
                g_unary += (y - p) @ features
                right += float(np.where(y == 1, p, 1 - p).sum())
                total += len(y)
                if len(parent) > 1:
                    par = np.array(parent[1:])
                    k1 = kind[1:]
                    rest = np.clip(np.array(below)[par] + np.array(down)[par] - np.array(up)[1:], -50, 50)
                    child = np.clip(np.array(below)[1:], -50, 50)
                    joint = np.stack([np.zeros(len(par)), child, rest, rest + child], 1).reshape(-1, 2, 2) + self.pair[k1]
                    joint = np.exp(joint - joint.max((1, 2), keepdims=True))
                    joint /= joint.sum((1, 2), keepdims=True)
                    np.add.at(g_pair, (k1, y[par], y[1:]), 1)
                    np.subtract.at(g_pair, k1, joint)
            for w, g, v in ((self.unary, g_unary, speed[0]), (self.pair, g_pair, speed[1])):
                g = g / max(1, len(pages)) - DECAY * w * 100
                v *= 0.9
                v += 0.1 * g * g
                w += rate * g / (np.sqrt(v) + 1e-3)
            rate *= 0.97
            history.append(right / max(1, total))
        return history


def own_labels(page: Page) -> np.ndarray | None:
    """Labels of a page that marks its article: what is in it, but for parts that are named otherwise."""
    articles = [k for k, t in enumerate(page.tags) if t in ("article", "main")]
    if not articles:
        return None
    bad = {_AT[f] for f in ("tag:nav", "tag:aside", "tag:form", "tag:footer", "name:advert", "name:comments", "name:menu", "name:notice", "name:share", "hidden")}
    y = np.zeros(len(page.parent), int)
    for k in range(1, len(y)):
        y[k] = not bad & set(page.marks[k]) and (k in articles or y[page.parent[k]] == 1)
    return y


def given_labels(page: Page) -> np.ndarray:
    """Labels that the page gives in ``data-y``, inherited downwards."""
    y = np.zeros(len(page.parent), int)
    for k in range(1, len(y)):
        y[k] = y[page.parent[k]] if page.label[k] is None else page.label[k]
    return y


_LEXICON = """lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim
minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat""".split()


def seed_pages(n: int = SEED_PAGES, seed: int = 23) -> list[str]:
    """Made-up labelled pages: article parts carry ``data-y="1"``, all else is no main text."""
    rng = random.Random(seed)

    def prose(low: int, high: int) -> str:
        said = " ".join(rng.choice(_LEXICON) for _ in range(rng.randint(low, high)))
        return said.capitalize() + rng.choice([".", ".", ".", "", "!"])

    def links(k: int) -> str:
        return "".join(f"<li><a href='/x'>{prose(1, 3)}</a></li>" for _ in range(k))

    def paragraphs(k: int) -> str:
        made = []
        for _ in range(k):
            made.append(rng.choice([
                lambda: f"<p>{prose(8, 60)} {prose(3, 30)}</p>", lambda: f"<p>{prose(1, 8)}</p>", lambda: f"<h2>{prose(1, 6)}</h2>",
                lambda: f"<p>{prose(8, 30)} <a href='/y'>{prose(1, 3)}</a> {prose(4, 20)}</p>",
                lambda: f"<ul>{''.join(f'<li>{prose(3, 20)}</li>' for _ in range(rng.randint(2, 4)))}</ul>",
                lambda: f"<blockquote><p>{prose(6, 30)}</p></blockquote>",
                lambda: f"<table><tr><td>{prose(1, 4)}</td><td>{prose(1, 4)}</td></tr></table>"])())
        return "".join(made)

    out = []
    for _ in range(n):
        before = [f"<nav><ul>{links(5)}</ul></nav>", f"<header><div class='logo'>{prose(1, 3)}</div><ul class='menu'>{links(4)}</ul></header>",
                  f"<div class='cookie-notice'><p>{prose(6, 25)}</p><button>ok</button></div>", f"<div id='top-banner' class='ad'>{prose(3, 20)}</div>",
                  f"<form action='/s'><p>{prose(2, 12)}</p><input name='q'></form>", f"<div class='breadcrumbs'>{prose(2, 5)}</div>"]
        after = [f"<aside><h3>{prose(1, 4)}</h3><ul>{links(4)}</ul></aside>", f"<div class='sidebar'><p>{prose(4, 25)}</p><ul>{links(3)}</ul></div>",
                 f"<section id='comments' class='comments'><h3>{prose(1, 4)}</h3><div class='comment'><p>{prose(5, 40)}</p></div>"
                 f"<ul><li class='comment'><p>{prose(5, 40)}</p></li></ul></section>",
                 f"<div class='comments'><p>{prose(6, 40)}</p><p>{prose(6, 40)}</p></div>",
                 f"<div class='newsletter'><p>{prose(6, 25)}</p><form><input></form></div>", f"<div class='related'><h4>{prose(2, 5)}</h4>{paragraphs(1)}</div>",
                 f"<aside class='ad'><p>{prose(6, 30)}</p></aside>", f"<div class='popup modal'><p>{prose(5, 20)}</p></div>",
                 f"<form><p>{prose(4, 20)}</p></form>", f"<div class='share'>{prose(1, 4)}</div>"]
        inside = rng.choice(["", "", f"<div class='ad' data-y='0'>{prose(4, 25)}</div>", f"<aside data-y='0'><p>{prose(5, 30)}</p></aside>",
                             f"<form data-y='0'><p>{prose(3, 15)}</p></form>", f"<div class='comments' data-y='0'><p>{prose(5, 40)}</p></div>"])
        head = f"<h1>{prose(2, 10)}</h1>"
        if rng.random() < 0.3:
            head = f"<header>{head}<p>{prose(2, 6)}</p></header>"
        core = head + paragraphs(rng.randint(1, 8)) + inside + paragraphs(rng.randint(0, 4))
        box = rng.choice(["<article data-y='1'>%s</article>", "<main data-y='1'>%s</main>", "<div class='content' data-y='1'>%s</div>",
                          "<div id='post-body' data-y='1'><div>%s</div></div>", "<section class='story' data-y='1'>%s</section>", "<main data-y='1'><article>%s</article></main>"])
        foot = f"<footer><p>&copy; {prose(2, 10)}</p><ul>{links(3)}</ul></footer>" if rng.random() < 0.8 else f"<div class='footer'>{prose(2, 12)}</div>"
        wrap = rng.choice(["%s", "<div id='page'>%s</div>"])
        out.append("<html><body>" + wrap % ("".join(rng.sample(before, rng.randint(1, 4))) + box % core + "".join(rng.sample(after, rng.randint(1, 4))) + foot) + "</body></html>")
    return out


def trained_model(pages: DataFrame, bound: int = SAMPLE_PAGES) -> TreeModel:
    """A model of the made-up pages and at most ``bound`` of the table's pages that mark their article,
    those with the least hashes."""
    marked = pages.where(F.col("html").rlike("(?i)<(article|main)[\\s>]") & (F.length("html") <= SAMPLE_CHARS)) \
        .withColumn("h", F.xxhash64("page_id", "html"))
    least = marked.select("h").distinct().orderBy("h").limit(bound)      # hashes alone are compared: `bound` rows
    rows = marked.join(F.broadcast(least), "h", "left_semi").select("h", "html").dropDuplicates(["h"]).collect()
    rows = sorted(rows, key=lambda r: r["h"])
    examples = []
    for source in seed_pages():
        page = Page(source)
        examples.append((page.parent, page.features(), given_labels(page)))
    for k, row in enumerate(rows):
        page = Page(row["html"])
        examples.append((page.parent, page.features(hide_article=k % 2 == 1), own_labels(page)))
    model = TreeModel()
    model.fit([e for e in examples if e[2] is not None])
    return model


def main_text(source: str | None, model: TreeModel) -> str:
    """The kept runs of text, joined by an empty line."""
    if not source:
        return ""
    page = Page(source)
    if not page.runs:
        return ""
    kept = model.marginals(page) > 0.5
    return "\n\n".join(text for node, text in page.runs if kept[node])


def extracted_text(pages: DataFrame, model: TreeModel | None = None) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page, from its whole html.

    A null or empty page, or one without main text, has an empty text.  Repeated and null ids keep a
    row each; other columns are not read.
    """
    model = model or trained_model(pages)
    held = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = held.value
        for batch in batches:
            texts = [main_text(h.as_py(), fitted) for h in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    return map_batches(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")),
                       run, "page_id long, url string, text string, n_chars long")
