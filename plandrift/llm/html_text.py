"""HTML extraction (5): content marginals on the tree of a page's blocks.

Each block element is a node with a hidden state, content or not. A node's features
(tag, words of class, id and role, text length, share of linked text) depend on its
state, its state on its parent's. Both potentials are counts over labelled pages. An
upward and a downward pass of sum-product messages give every node's exact marginal;
the text of nodes that are content with probability above one half is the result.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plandrift.llm import common

# Element kinds of HTML.
RAW = ("script", "style", "noscript", "template", "iframe", "svg", "textarea", "object", "canvas", "math", "select")
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCK = set("""html head body title main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption
thead tbody tfoot tr td th blockquote pre figure figcaption nav header footer aside form fieldset legend details
summary address button menu dialog center hgroup search""".split())
#: Open elements that a start tag of the kind ends, unless one of the second set is nearer.
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "body": ({"head"}, set())}
#: Words of class, id and role attributes that tell a block's purpose.
PURPOSE = {
    "ad": "ad ads advert advertisement adverts sponsor sponsored promo promotion banner",
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc skip",
    "foot": "footer foot copyright legal colophon contentinfo", "head": "header masthead topbar branding logo",
    "side": "sidebar aside widget related recommended trending popular complementary more",
    "notice": "cookie cookies consent notice gdpr popup modal overlay alert message toast subscribe newsletter signup paywall",
    "comment": "comment comments reply replies respond disqus discussion thread feedback",
    "share": "share social sharing tags tools toolbar meta byline search login form",
    "content": "article content post entry story main body text blog prose page",
}
PURPOSE_OF = {w: k for k, words in PURPOSE.items() for w in words.split()}
NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
SPECIAL = re.compile("[>\"']")
PURPOSE_ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
LABEL_ATTRIBUTE = re.compile(r"\bdata-content=\"([01])\"")
SPACES = re.compile(r"\s+")


class Tags:
    """Finds comments, declarations and tags from left to right, in linear time.

    A tag ends at the first ``>`` outside quotes; a ``<`` without such an end is text.
    What a vain search has learnt is kept: where the next ``>`` and the next special
    character are, and from which opening quotes on there is no end.
    """

    def __init__(self, html: str):
        self.html = html
        self.gt = self.special = -1  # positions of the next of their kind, as last seen
        self.vain: set[int] = set()

    def _next_gt(self, at: int) -> int:
        if self.gt < at:
            found = self.html.find(">", at)
            self.gt = found if found >= 0 else len(self.html)
        return self.gt

    def _next_special(self, at: int) -> int:
        if self.special < at:
            found = SPECIAL.search(self.html, at)
            self.special = found.start() if found else len(self.html)
        return self.special

    def _end(self, at: int) -> int:
        """Position of the ``>`` that ends the tag whose name ends at ``at``, or -1."""
        html, opened, here = self.html, [], self._next_special(at)
        while here < len(html) and html[here] != ">":
            closing = -1 if here in self.vain else html.find(html[here], here + 1)
            opened.append(here)
            if closing < 0:
                break
            found = SPECIAL.search(html, closing + 1)
            here = found.start() if found else len(html)
        else:
            if here < len(html):
                return here
        self.vain.update(opened)
        return -1

    def next(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """Start, end, whether closing, name ("" for no tag) and attributes of the next one."""
        html = self.html
        while (start := html.find("<", at)) >= 0:
            at = start + 1
            if html.startswith("<!--", start):
                end = html.find("-->", start + 4)
                return start, end + 3 if end >= 0 else len(html), False, "", ""
            gt = self._next_gt(at)
            if gt == len(html):
                # Without any more ``>`` only a comment can follow.
                at = html.find("<!--", at)
                if at < 0:
                    return None
                continue
            if html.startswith(("<!", "<?"), start):
                return start, gt + 1, False, "", ""
            name = NAME.match(html, start)
            end = self._end(name.end()) if name else -1
            if end >= 0:
                return start, end + 1, bool(name[1]), name[2].lower(), html[name.end():end]
        return None

    def raw_end(self, tag: str, at: int) -> int:
        """Where the raw text of a script, style or the like ends, its end tag included."""
        close = re.compile(rf"</{tag}\b", re.I).search(self.html, at)
        end = self.html.find(">", close.end()) if close else -1
        return end + 1 if end >= 0 else len(self.html)


def parse(html: str) -> tuple[list[int], list[list[str]], list[tuple[int, str]], list[int]]:
    """Parents (-1 at the root, always before their children), features, text segments
    (node, text) in page order, and labels (of pages that carry them) of the blocks."""
    parents, tags, attributes, labels = [-1], ["root"], [""], [0]
    own_text, own_links = [0], [0]
    segments: list[tuple[int, str]] = []
    stack, pending, in_link, at = [0], [], 0, 0
    depths: dict[str, list[int]] = {}  # of the open blocks of each tag, ascending
    found = Tags(html)

    def close_to(depth: int) -> None:
        while len(stack) > depth:
            depths[tags[stack.pop()]].pop()

    def flush() -> None:
        if pending:
            # White space of HTML and no-break spaces alike become one space.
            text = SPACES.sub(" ", unescape("".join(pending))).strip()
            pending.clear()
            if text:
                segments.append((stack[-1], text))
                own_text[stack[-1]] += len(text)
                own_links[stack[-1]] += len(text) * (in_link > 0)

    while at < len(html):
        match = found.next(at)
        if match is None:
            pending.append(html[at:])
            break
        start, end, closing, tag, named = match
        if start > at:
            pending.append(html[at:start])
        at = end
        if not tag:
            continue
        if tag in RAW:
            if not closing and not named.endswith("/"):
                at = found.raw_end(tag, at)
            continue
        if tag == "br" or tag == "hr":
            pending.append(" ")
        elif tag == "a":
            # Linked text is counted apart, so its length is known where the link ends.
            if closing and in_link:
                text = SPACES.sub(" ", unescape("".join(pending[in_link - 1:]))).strip()
                own_links[stack[-1]] += len(text)
            in_link = 0 if closing else len(pending) + 1
            if closing:
                in_link = 0
        elif tag in BLOCK:
            if in_link:
                own_links[stack[-1]] += len("".join(pending[in_link - 1:]))
                in_link = 0
            flush()
            if closing:
                if depths.get(tag):
                    close_to(depths[tag][-1])
                continue
            if tag in CLOSES:
                ends, within = CLOSES[tag]
                nearest = max((depths[t][-1] for t in ends if depths.get(t)), default=0)
                if nearest > max((depths[t][-1] for t in within if depths.get(t)), default=0):
                    close_to(nearest)
            while tags[stack[-1]] == "p" or tags[stack[-1]] in HEADINGS and tag in HEADINGS:
                close_to(len(stack) - 1)  # a paragraph ends where a block begins
            parents.append(stack[-1])
            tags.append(tag)
            attributes.append(" ".join(a or b or c for a, b, c in PURPOSE_ATTRIBUTE.findall(named)))
            label = LABEL_ATTRIBUTE.search(named)
            labels.append(int(label[1]) if label else labels[stack[-1]])
            own_text.append(0)
            own_links.append(0)
            depths.setdefault(tag, []).append(len(stack))
            stack.append(len(parents) - 1)
    flush()
    text, links = own_text[:], own_links[:]
    for k in reversed(range(1, len(parents))):
        text[parents[k]] += text[k]
        links[parents[k]] += links[k]
    features = []
    for tag, names, n, linked in zip(tags, attributes, text, links, strict=True):
        words = {PURPOSE_OF[w] for w in re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", names).lower()) if w in PURPOSE_OF}
        features.append([f"tag:{tag}", f"purpose:{'+'.join(sorted(words)) or '-'}" if len(words) < 2 else
                         f"purpose:{min(words, key=list(PURPOSE).index)}",
                         f"links:{round(4 * min(1, linked / n)) if n else 'none'}",
                         f"length:{min(4, int(math.log10(n + 1) * 1.5))}"])
    return parents, features, segments, labels


def _wide(feature: str) -> int:
    """Whether a parent of this tag mixes content and other blocks by its nature."""
    return int(feature in ("tag:root", "tag:html", "tag:body", "tag:div", "tag:main", "tag:section"))


class TreeModel:
    """Log potentials from counts (feature or transition, state) with additive smoothing."""

    def __init__(self, counts: dict[tuple[str, int], int], smoothing: float = 0.5):
        states = [max(1, sum(n for (f, y), n in counts.items() if y == s and f.startswith("tag:"))) for s in (0, 1)]
        kinds: dict[str, set[str]] = {}
        for f, _ in counts:
            kinds.setdefault(f.split(":")[0], set()).add(f)
        self.emission = {f: np.array([math.log((counts.get((f, s), 0) + smoothing) / (states[s] + smoothing * (len(kinds[f.split(":")[0]]) + 1)))
                                      for s in (0, 1)]) for f in {f for f, _ in counts} if not f.startswith("move:")}
        self.transition = np.zeros((2, 2, 2))  # wide parent, its state, child's state
        for wide in (0, 1):
            for parent in (0, 1):
                n = np.array([counts.get((f"move:{wide}:{parent}", s), 0) + smoothing for s in (0, 1)])
                self.transition[wide, parent] = np.log(n / n.sum())

    def marginals(self, parents: np.ndarray, features: list[list[str]]) -> np.ndarray:
        """P(content) of each node of a forest whose parents precede their children.

        One upward and one downward pass, a level of the whole forest at a time.
        """
        n = len(parents)
        nothing = np.zeros(2)
        belief = np.array([sum((self.emission.get(f, nothing) for f in fs), nothing) for fs in features]).reshape(n, 2)
        wide = np.array([_wide(fs[0]) for fs in features], int)
        root = parents < 0
        depth = np.zeros(n, int)
        for k in range(n):
            if not root[k]:
                depth[k] = depth[parents[k]] + 1
        belief[root] += np.log([0.999, 0.001])
        levels = np.split(np.argsort(depth, kind="stable"), np.cumsum(np.bincount(depth, minlength=1))[:-1])
        message = np.zeros((n, 2))
        for level in reversed(levels[1:]):
            p = parents[level]
            message[level] = np.logaddexp.reduce(self.transition[wide[p]] + belief[level][:, None, :], axis=2)
            np.add.at(belief, p, message[level])
        for level in levels[1:]:
            p = parents[level]
            without = belief[p] - message[level]
            belief[level] += np.logaddexp.reduce(self.transition[wide[p]] + without[:, :, None], axis=1)
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500)))


def train(labelled: DataFrame) -> TreeModel:
    """From pages (html) whose elements carry ``data-content`` "1" or "0", valid below them."""
    schema = pa.schema([("feature", pa.string()), ("state", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[tuple[str, int], int] = {}
            for html in batch.column(0).to_pylist():
                parents, features, _, labels = parse(html or "")
                for p, fs, y in zip(parents, features, labels, strict=True):
                    for f in fs if p < 0 else [*fs, f"move:{_wide(features[p][0])}:{labels[p]}"]:
                        counts[f, y] = counts.get((f, y), 0) + 1
            yield common.record_batch(schema, [[f for f, _ in counts], [y for _, y in counts], list(counts.values())])

    counts = labelled.select("html").mapInArrow(run, "feature string, state int, n long").groupBy("feature", "state").agg(F.sum("n").alias("n"))
    return TreeModel({(r["feature"], r["state"]): r["n"] for r in counts.collect()})  # features are a fixed small set


def labelled_pages(n: int = 400, seed: int = 3) -> list[str]:
    """Labelled pages of many layouts, made by rule, for where no others are at hand."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["ta", "re", "mo", "li", "ne", "su", "ko", "per", "an"]) for _ in range(rng.randint(1, 4)))
    text = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))
    links = lambda k: "".join(f'<li><a href="/{word()}">{text(1, 2)}</a></li>' for _ in range(k))
    maybe = lambda p, x: x() if rng.random() < p else ""
    boilerplate = [
        lambda: f'<nav><ul>{links(rng.randint(2, 8))}</ul></nav>', lambda: f'<div class="menu"><ul>{links(5)}</ul></div>',
        lambda: f'<header><div class="logo">{text(1, 3)}</div><p>{text(2, 6)}</p></header>',
        lambda: f'<div id="header"><h1>{text(1, 3)}</h1></div>',
        lambda: f'<aside><h3>{text(1, 3)}</h3><ul>{links(4)}</ul><p>{text(5, 30)}</p></aside>',
        lambda: f'<div class="sidebar"><div class="widget"><p>{text(5, 40)}</p></div></div>',
        lambda: f'<div class="{rng.choice(["ad", "ads", "advert", "sponsored"])}">{text(3, 30)}</div>',
        lambda: f'<div class="ad"><p>{text(3, 30)}</p></div>',
        lambda: f'<div class="{rng.choice(["cookie-banner", "notice", "consent", "newsletter"])}"><p>{text(5, 30)}</p><button>{word()}</button></div>',
        lambda: f'<form action="/s"><label>{word()}</label><input name="q"><p>{text(1, 6)}</p><button>{word()}</button></form>',
        lambda: f'<section class="comments"><h2>{text(1, 3)}</h2>' + "".join(
            f'<div class="comment"><p>{text(4, 60)}</p></div>' for _ in range(rng.randint(1, 5))) + "</section>",
        lambda: f'<div id="comments"><ol>' + "".join(f'<li><p>{text(4, 60)}</p></li>' for _ in range(rng.randint(1, 4))) + "</ol></div>",
        lambda: f'<div class="related"><h3>{text(1, 3)}</h3><ul>{links(4)}</ul></div>',
        lambda: f'<div class="share"><ul>{links(3)}</ul></div>', lambda: f'<footer><p>{text(3, 20)}</p></footer>',
        lambda: f'<footer>{text(3, 20)}</footer>', lambda: f'<div class="footer">{text(3, 20)}</div>']
    body = [
        lambda: f"<p>{text(1, 90)}</p>", lambda: f"<p>{text(5, 90)}</p>", lambda: f"<p>{text(20, 120)}</p>",
        lambda: f"<p>{text(10, 60)} <a href='/x'>{text(1, 3)}</a> {text(3, 30)}</p>", lambda: f"<h2>{text(1, 6)}</h2>",
        lambda: "<ul>" + "".join(f"<li>{text(2, 20)}</li>" for _ in range(3)) + "</ul>",
        lambda: f"<blockquote><p>{text(5, 40)}</p></blockquote>", lambda: f"<pre>{text(5, 40)}</pre>",
        lambda: f"<figure><figcaption>{text(3, 15)}</figcaption></figure>",
        lambda: "<table><tr>" + "".join(f"<td>{text(1, 4)}</td>" for _ in range(3)) + "</tr></table>",
        lambda: f"<div>{text(10, 90)}</div>", lambda: f"<div><p>{text(10, 90)}</p><p>{text(10, 90)}</p></div>"]
    shells = [('<article data-content="1">', "</article>"), ('<article data-content="1">', "</article>"),
              ('<main><article data-content="1">', "</article></main>"), ('<div class="content" data-content="1">', "</div>"),
              ('<main data-content="1">', "</main>"), ('<div id="post-body" data-content="1">', "</div>"),
              ('<div class="wrap"><section class="article" data-content="1">', "</section></div>"),
              ('<div class="page"><div class="entry" data-content="1">', "</div></div>")]
    pages = []
    for _ in range(n):
        some = lambda a, b: "".join(rng.choice(boilerplate)() for _ in range(rng.randint(a, b)))
        opened, closed = rng.choice(shells)
        inner = maybe(0.8, lambda: f"<h1>{text(1, 9)}</h1>") + "".join(rng.choice(body)() for _ in range(rng.randint(0, 9)))
        inside = maybe(0.35, lambda: re.sub(r"^<(\w+)", r'<\1 data-content="0"', rng.choice(boilerplate)()))
        inner = inner + inside + "".join(rng.choice(body)() for _ in range(rng.randint(0, 4)))
        pages.append(f"<html><head><title>{text(1, 8)}</title></head><body>{some(0, 4)}{opened}{inner}{closed}{some(0, 4)}</body></html>")
    return pages


def html_text(pages: DataFrame, labelled: DataFrame | None = None, most_pages: int = 200) -> DataFrame:
    """page_id, url, text and n_chars per page; the text of content blocks, one a line.

    A null or empty page has an empty text, as has one without content. Text outside
    any element belongs to the page's root, which is hardly ever content. Repeated
    rows and null ids stay; an empty table gives no rows; other columns are not looked
    at. No shuffle of pages; a task holds one batch, and the messages of ``most_pages``.
    """
    spark = pages.sparkSession
    if labelled is None:
        labelled = spark.createDataFrame([(x,) for x in labelled_pages()], "html string")
    shared = spark.sparkContext.broadcast(train(labelled))
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.column_chunks(batches, most_pages):
            forest, features, found, first = [], [], [], []
            for html in batch.column(2).to_pylist():
                parents, fs, segments, _ = parse(html or "")
                first.append(len(features))
                forest.append(np.array([p + len(features) if p >= 0 else -1 for p in parents]))
                features += fs
                found.append(segments)
            p = shared.value.marginals(np.concatenate(forest), features) if forest else np.zeros(0)
            texts = ["\n".join(t for node, t in segments if p[at + node] > 0.5) for segments, at in zip(found, first, strict=True)]
            yield common.record_batch(schema, [batch.column(0), batch.column(1), texts, list(map(len, texts))])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text(common.read(spark, sf_dir, "pages"))
