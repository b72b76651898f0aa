"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded so that no choice contradicts an ancestor's.

A page becomes a tree of its block elements; each node is described by the density of its subtree, its tag and attribute
tokens, its depth, its siblings and its ancestors. Boosted trees give the log odds that a node belongs to the main text.
The decoder keeps the set of nodes with the greatest sum of log odds in which every kept node's parent is kept.

Pages carry no labels, so the trees learn from pages composed of text blocks of a bounded sample of the table, set into
random layouts whose main part is known.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: HTML elements that begin a new line of text, and those whose content is never text of a page.
BLOCKS = frozenset(
    "html body article section main header footer nav aside div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th "
    "caption blockquote pre form fieldset figure figcaption address details summary menu dialog hgroup search center".split()
)
SILENT = frozenset("script style title template iframe select textarea button option".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: What an opening tag closes when it is open, nearest first, up to the elements that hold it.
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr"}), "th": ({"td", "th"}, {"tr"})}
#: Attribute tokens by what they speak of.
TOKENS = {
    "main": "article content main post entry story text body prose read",
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs toc pagination pager links",
    "head": "header masthead topbar brand logo banner hero",
    "foot": "footer foot copyright legal colophon",
    "side": "sidebar aside side rail widget widgets related recommended popular tags trending more",
    "ad": "ad ads advert advertisement sponsor sponsored promo promoted outbrain taboola banner",
    "notice": "cookie cookies consent notice gdpr privacy alert modal popup overlay paywall message",
    "talk": "comment comments reply replies respond discussion disqus feedback review reviews",
    "form": "form login signin signup subscribe newsletter search contact register input field",
    "share": "share sharing social follow twitter facebook buttons toolbar tools",
}
_GROUPS = tuple(TOKENS)
_GROUP_OF: dict[str, list[int]] = {}
for _i, _words in enumerate(TOKENS.values()):
    for _word in _words.split():
        _GROUP_OF.setdefault(_word, []).append(_i)
TAGS = ("p", "div", "section", "article", "main", "header", "footer", "nav", "aside", "form", "ul", "li", "table", "td", "blockquote", "pre", "figure", "h1", "h2", "body")
_TAG_AT = {t: i for i, t in enumerate(TAGS)} | {"ol": 10, "dl": 10, "menu": 10, "dt": 11, "dd": 11, "tr": 12, "th": 13, "figcaption": 16, "h3": 18, "h4": 18, "h5": 18, "h6": 18, "fieldset": 9, "html": 19}
_AWAY = frozenset("header footer nav aside form menu dialog search".split())
_CUT = re.compile(r"(?:<!--(?:(?!-->).)*|<[/!?a-zA-Z][^<>]*)\Z", re.S)  # a tag or comment that the page's end cuts off
_SPLIT = re.compile(r"[^a-z]+")
MARK = "\ue000"  # in composed pages: begins each block of the main part


@dataclass(frozen=True)
class ExtractSpec:
    """``sample_pages``: pages whose text blocks the composed pages are made of; ``composed``: how many are made."""

    sample_pages: int = 200
    composed: int = 1000
    trees: int = 80
    depth: int = 4
    bins: int = 32
    rate: float = 0.25
    least_weight: float = 8.0
    seed: int = 3


@dataclass(frozen=True)
class Boosted:
    """``edges``: bin edges per feature; trees as full binary trees: feature and bin per inner node, value per leaf."""

    edges: tuple[np.ndarray, ...]
    start: float
    features: np.ndarray
    cuts: np.ndarray
    leaves: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        binned = _binned(x, self.edges)
        total, rows = np.full(len(x), self.start), np.arange(len(x))
        for features, cuts, leaves in zip(self.features, self.cuts, self.leaves, strict=True):
            at = np.zeros(len(x), dtype=np.int64)
            while at.size and at[0] < len(features):
                at = 2 * at + 1 + (binned[rows, features[at]] > cuts[at])
            total += leaves[at - len(features)]
        return total


# --- pages as trees --------------------------------------------------------------------------------------------


class Page(HTMLParser):
    """Block elements in page order (a parent before its children) and the text segments between block boundaries."""

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.depth, self.groups = ["html"], [-1], [0], [0]
        self.link_chars, self.inline = [0], [0]
        self.segments: list[tuple[int, str]] = []
        self.open, self.silent, self.in_link, self.pieces = [0], [], False, []
        self.feed(_CUT.sub("", html))
        self.close()
        self._end_segment()

    def _end_segment(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            self.pieces = []
            if text:
                self.segments.append((self.open[-1], text))

    def _close(self, depth: int) -> None:
        self._end_segment()
        del self.open[depth:]
        self.in_link = False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.silent:
            if tag == "body":
                self.silent = []
            else:
                if tag == self.silent[-1]:
                    self.silent.append(tag)
                return
        if tag in SILENT:
            self.silent.append(tag)
        elif tag == "br":
            self.pieces.append(" ")
        elif tag == "hr":
            self._end_segment()
        elif tag in VOID:
            pass
        elif tag not in BLOCKS:
            self.inline[self.open[-1]] += 1
            self.in_link = self.in_link or tag == "a"
        elif tag != "html":
            self._end_segment()
            closes, inside = IMPLIED.get(tag, ({"p"}, BLOCKS - {"p"}))
            for at in range(len(self.open) - 1, 0, -1):
                name = self.tag[self.open[at]]
                if name in closes or (name == "p" and closes != {"p"}):
                    self._close(at)
                    if name in closes:
                        break
                elif name in inside:
                    break
            self.in_link = False
            groups = 0
            for name, value in attrs:
                if value and name in ("class", "id", "role", "itemprop", "aria-label"):
                    for word in _SPLIT.split(value.lower()):
                        for g in _GROUP_OF.get(word, ()):
                            groups |= 1 << g
            up = self.open[-1]
            self.tag.append(tag)
            self.parent.append(up)
            self.depth.append(self.depth[up] + 1)
            self.groups.append(groups)
            self.link_chars.append(0)
            self.inline.append(0)
            self.open.append(len(self.tag) - 1)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag in SILENT and self.silent:
            self.silent.pop()

    def handle_endtag(self, tag: str) -> None:
        if self.silent:
            if tag == self.silent[-1]:
                self.silent.pop()
        elif tag == "a":
            self.in_link = False
        elif tag in BLOCKS and tag not in ("html", "body"):
            for at in range(len(self.open) - 1, 0, -1):
                if self.tag[self.open[at]] == tag:
                    self._close(at)
                    break

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.pieces.append(data)
            if self.in_link:
                self.link_chars[self.open[-1]] += len(data)


def node_features(page: Page) -> np.ndarray:
    """One row per node: subtree density, tag, attribute tokens, depth, siblings, ancestors."""
    n = len(page.tag)
    parent = np.array(page.parent)
    depth = np.array(page.depth, dtype=np.float64)
    chars, count, stops, before = np.zeros(n), np.zeros(n), np.zeros(n), np.full(n, -1.0)
    passed = 0
    for node, text in page.segments:
        chars[node] += len(text)
        count[node] += 1
        stops[node] += text.count(".") + text.count(",")
        if before[node] < 0:
            before[node] = passed
        passed += len(text)
    own = chars.copy()
    link, inline = np.array(page.link_chars, dtype=np.float64), np.array(page.inline, dtype=np.float64)
    nodes, deep, paragraphs = np.ones(n), depth.copy(), np.array([t == "p" for t in page.tag], dtype=np.float64)
    children, place = np.zeros(n), np.zeros(n)
    for i in range(1, n):
        place[i] = children[parent[i]]
        children[parent[i]] += 1
    first = np.where(before < 0, np.inf, before)
    for i in range(n - 1, 0, -1):
        p = parent[i]
        for column in (chars, count, stops, link, inline, nodes, paragraphs):
            column[p] += column[i]
        deep[p] = max(deep[p], deep[i])
        first[p] = min(first[p], first[i])
    groups = np.array(page.groups)
    away = np.array([t in _AWAY for t in page.tag])
    own_bits = (groups[:, None] >> np.arange(len(_GROUPS))) & 1
    above_bits, above_away, above_main = np.zeros_like(own_bits), np.zeros(n), np.zeros(n)
    is_main = np.array([t in ("article", "main") for t in page.tag])
    same, after, ahead = np.zeros(n), np.zeros(n), np.zeros(n)
    last: dict[int, int] = {}
    for i in range(1, n):
        p = parent[i]
        above_bits[i] = above_bits[p] | own_bits[p]
        above_away[i] = above_away[p] or away[p]
        above_main[i] = above_main[p] or is_main[p]
        if p in last:
            j = last[p]
            same[i] = page.tag[j] == page.tag[i]
            ahead[i], after[j] = chars[j], chars[i]
        last[p] = i
    up = np.maximum(parent, 0)
    tags = np.zeros((n, len(TAGS)))
    for i, t in enumerate(page.tag):
        if t in _TAG_AT:
            tags[i, _TAG_AT[t]] = 1
    total = max(1.0, float(passed))
    dense = [
        np.log1p(chars),
        np.log1p(own),
        chars / nodes,
        link / np.maximum(chars, 1),
        stops / np.maximum(chars, 1),
        chars / np.maximum(count, 1),
        inline / nodes,
        paragraphs / nodes,
        np.log1p(nodes),
        depth,
        deep - depth,
        children,
        place,
        place / np.maximum(children[up], 1),
        children[up],
        chars / total,
        chars / np.maximum(chars[up], 1),
        np.where(np.isinf(first), 1.0, first / total),
        same,
        np.log1p(ahead),
        np.log1p(after),
        above_away,
        above_main,
    ]
    return np.column_stack([*dense, tags, tags[up], own_bits, above_bits])


def decode(parent: list[int], odds: np.ndarray) -> np.ndarray:
    """Kept nodes: greatest sum of log odds where a kept node's parent is kept; the root always is."""
    worth = odds.copy()
    for i in range(len(worth) - 1, 0, -1):
        if worth[i] > 0:
            worth[parent[i]] += worth[i]
    kept = worth > 0
    kept[0] = True
    for i in range(1, len(kept)):
        kept[i] &= kept[parent[i]]
    return kept


# --- boosting --------------------------------------------------------------------------------------------------


def _binned(x: np.ndarray, edges: tuple[np.ndarray, ...]) -> np.ndarray:
    return np.column_stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)]).astype(np.int64)


def fit_boosted(x: np.ndarray, y: np.ndarray, spec: ExtractSpec) -> Boosted:
    """Logistic boosting with full trees of ``depth`` over quantile bins; leaves are Newton steps."""
    edges = tuple(np.unique(np.quantile(x[:, f], np.linspace(0, 1, spec.bins)[1:-1])) for f in range(x.shape[1]))
    binned, width = _binned(x, edges), spec.bins
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    odds, inner = np.full(len(y), start), 2**spec.depth - 1
    features, cuts, leaves = [], [], []
    flat = binned + width * np.arange(x.shape[1])
    for _ in range(spec.trees):
        p = 1 / (1 + np.exp(-odds))
        g, h = y - p, np.maximum(p * (1 - p), 1e-9)
        at, feature, cut = np.zeros(len(y), dtype=np.int64), np.zeros(inner, dtype=np.int64), np.full(inner, width, dtype=np.int64)
        for node in range(inner):
            inside = np.flatnonzero(at == node)
            if inside.size:
                place = flat[inside].ravel()
                sums = [np.bincount(place, np.repeat(v[inside], x.shape[1]), width * x.shape[1]).reshape(-1, width).cumsum(1) for v in (g, h)]
                (gl, hl), (gt, ht) = sums, (s[:, -1:] for s in sums)
                gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                gain[(hl < spec.least_weight / 8) | (ht - hl < spec.least_weight / 8)] = 0
                best = int(gain.argmax())
                if gain.flat[best] > 1e-6:
                    feature[node], cut[node] = divmod(best, width)
            at[inside] = 2 * node + 1 + (binned[inside, feature[node]] > cut[node])
        gs, hs = (np.bincount(at - inner, v, inner + 1) for v in (g, h))
        leaf = spec.rate * gs / (hs + 1)
        odds += leaf[at - inner]
        features.append(feature)
        cuts.append(cut)
        leaves.append(leaf)
    return Boosted(edges, start, np.array(features), np.array(cuts), np.array(leaves))


# --- composed pages --------------------------------------------------------------------------------------------


def compose(texts: list[str], draw: random.Random) -> str:
    """A page in a random layout of the given text blocks; each block of its main part begins with ``MARK``."""

    def words(least: int, most: int) -> str:
        found = draw.choice(texts).split()
        n = draw.randint(least, most)
        at = draw.randrange(max(1, len(found) - n + 1))
        return " ".join(found[at : at + n])

    def named(group: str, share: float = 0.85) -> str:
        if draw.random() > share:
            return ""
        word = draw.choice(TOKENS[group].split())
        return f' {draw.choice(("class", "id"))}="{draw.choice(("", "site-", "js-", "page-"))}{word}{draw.choice(("", "-box", "-1", " clear", "_wrap"))}"'

    def held(tags: str, group: str, inside: str) -> str:
        tag = draw.choice(tags.split())
        return f"<{tag}{named(group, 0.4 if tag in _AWAY else 1.0)}>{inside}</{tag}>"

    def links() -> str:
        items = [f'<a href="/{i}">{words(1, 4)}</a>' for i in range(draw.randint(2, 9))]
        return f"<ul>{''.join(f'<li>{i}</li>' for i in items)}</ul>" if draw.random() < 0.7 else " | ".join(items)

    def said(least: int, most: int) -> str:
        inside = words(least, most)
        return f"<p>{inside}</p>" if draw.random() < 0.6 else inside

    def notes() -> str:
        each = [f"<div{named('talk', 0.7)}><b>{words(1, 2)}</b> {said(2, 40)}</div>" for _ in range(draw.randint(1, 8))]
        return draw.choice(("", f"<h3>{words(1, 3)}</h3>")) + "".join(each)

    def fields() -> str:
        return f"<label>{words(1, 3)}</label><input name='q'>" + draw.choice(("", f"<p>{words(3, 20)}</p>")) + f"<button>{words(1, 2)}</button>"

    away = {
        "nav": lambda: held("nav div ul", "nav", links()),
        "head": lambda: held("header div", "head", draw.choice((said(1, 8), f"<h1>{words(1, 4)}</h1>", links(), f"<p>{words(2, 10)}</p>{links()}"))),
        "foot": lambda: held("footer div", "foot", "&copy; " + words(1, 4) + " &middot; " + said(2, 25) + draw.choice(("", links()))),
        "side": lambda: held("aside div section", "side", f"<h3>{words(1, 4)}</h3>" + draw.choice((links(), said(5, 50), said(5, 30) + said(5, 30)))),
        "ad": lambda: held("div aside section", "ad", said(3, 40)),
        "notice": lambda: held("div section dialog", "notice", said(5, 40) + draw.choice(("", "<button>OK</button>", f'<a href="/x">{words(1, 3)}</a>'))),
        "talk": lambda: held("section div", "talk", notes()),
        "form": lambda: f"<form{named('form', 0.6)}>{fields()}</form>",
        "share": lambda: held("div ul", "share", links()),
    }

    longest = draw.choice((4, 25, 120, 120, 120, 1500))

    def part() -> str:
        kind = draw.random()
        if kind < 0.82:
            return f"<p>{draw.choice(('', '<b>'))}{MARK}{words(1, longest)}{draw.choice(('', '<br>'))}{draw.choice(('</p>', '</p>', ''))}"
        if kind < 0.88:
            return f"<h2>{MARK}{words(1, 8)}</h2>"
        if kind < 0.92:
            return f"<ul>{''.join(f'<li>{MARK}{words(2, 25)}</li>' for _ in range(draw.randint(2, 6)))}</ul>"
        if kind < 0.96:
            return f"<blockquote>{draw.choice(('', '<p>'))}{MARK}{words(3, 60)}</blockquote>"
        return f"<pre>{MARK}{words(3, 30)}</pre>" if kind < 0.98 else f"<table><tr><td>{MARK}{words(1, 10)}</td><td>{MARK}{words(1, 10)}</td></tr></table>"

    if draw.random() < 0.05:  # text and little else
        plain = draw.choice(("<p>{}</p>", "<p>{}", "{}<br>", "<div>{}</div>"))
        inside = "".join(plain.format(MARK + words(1, longest)) for _ in range(draw.randint(1, 3)))
        return draw.choice(("{}", "<body>{}</body>", "<html><body><div>{}</div></body></html>")).format(inside)
    parts = [part() for _ in range(max(1, int(draw.expovariate(1 / 7))))]
    if draw.random() < 0.85:
        parts.insert(0, f"<h1>{MARK}{words(1, 14)}</h1>")
    for kind in away:
        if draw.random() < 0.12:
            parts.insert(draw.randint(1, len(parts)), away[kind]())
    inside = "".join(parts)
    layout = draw.random()
    if layout < 0.5:
        body = f"<article{named('main', 0.3)}>{inside}</article>"
    elif layout < 0.65:
        body = f"<main{named('main', 0.3)}>{inside}</main>"
    elif layout < 0.9:
        body = f"<div{named('main', 0.8)}>{inside}</div>"
    else:
        body = inside
    for _ in range(draw.choice((0, 0, 1, 2))):
        body = f"<div{draw.choice((' class=wrap', ' class=row', ' id=page', ''))}>{body}</div>"
    if draw.random() < 0.08:
        away = dict.fromkeys(away, str)  # nothing around the main part
    ahead = [away[k]() for k in ("notice", "head", "nav", "ad", "side", "form", "share") if draw.random() < 0.45]
    behind = [away[k]() for k in ("side", "talk", "share", "ad", "nav", "form", "notice", "foot") if draw.random() < 0.45]
    draw.shuffle(ahead)
    page = f"<html><head><title>{words(1, 9)}</title></head><body>{''.join(ahead)}{body}{''.join(behind)}"
    return page + "</body></html>" if draw.random() < 0.9 else page[: draw.randint(len(page) // 2, len(page))]


def labelled_nodes(html: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of a composed page, and which nodes hold part of its main text."""
    page = Page(html)
    holds = np.zeros(len(page.tag))
    for node, text in page.segments:
        if MARK in text:
            holds[node] = 1
    page.segments = [(node, text.replace(MARK, "")) for node, text in page.segments]
    for i in range(len(holds) - 1, 0, -1):
        holds[page.parent[i]] = max(holds[page.parent[i]], holds[i])
    return node_features(page), holds


# --- Spark -----------------------------------------------------------------------------------------------------


def fit_extractor(pages: DataFrame, spec: ExtractSpec = ExtractSpec()) -> Boosted | None:
    """Trees from pages composed of the text of ``sample_pages`` pages (html), those of least hash. None without text."""
    sample = pages.select("html").where("html is not null").distinct().orderBy(F.xxhash64("html", F.lit(spec.seed)), "html").limit(spec.sample_pages)

    def train(sampled: pd.DataFrame) -> pd.DataFrame:
        texts = [text for html in sorted(sampled["html"]) for _, text in Page(html).segments]
        if not texts:
            return pd.DataFrame({c: pd.Series(dtype=object) for c in ("edges", "sizes", "start", "features", "cuts", "leaves")})
        draw = random.Random(spec.seed)
        nodes = [labelled_nodes(compose(texts, draw)) for _ in range(spec.composed)]
        fitted = fit_boosted(np.vstack([x for x, _ in nodes]), np.concatenate([y for _, y in nodes]), spec)
        return pd.DataFrame(
            {
                "edges": [np.concatenate(fitted.edges)],
                "sizes": [[len(e) for e in fitted.edges]],
                "start": [fitted.start],
                "features": [fitted.features.ravel()],
                "cuts": [fitted.cuts.ravel()],
                "leaves": [fitted.leaves.ravel()],
            }
        )

    schema = "edges array<double>, sizes array<long>, start double, features array<long>, cuts array<long>, leaves array<double>"
    fitted = sample.withColumn("whole", F.lit(0)).groupBy("whole").applyInPandas(train, schema).collect()
    if not fitted:
        return None
    row = fitted[0]
    edges = tuple(np.split(np.array(row["edges"]), np.cumsum(row["sizes"])[:-1]))
    shaped = [np.array(row[k]).reshape(spec.trees, -1) for k in ("features", "cuts", "leaves")]
    return Boosted(edges, row["start"], *shaped)


def main_texts(pages: list[Page], model: Boosted | None) -> list[str]:
    """The kept segments of each page, in page order, a blank line between them."""
    if model is None:
        return ["\n\n".join(text for _, text in page.segments) for page in pages]
    features = [node_features(page) for page in pages]
    odds = model.log_odds(np.vstack(features)) if features else np.empty(0)
    found, at = [], 0
    for page, x in zip(pages, features, strict=True):
        kept = decode(page.parent, odds[at : at + len(x)])
        at += len(x)
        found.append("\n\n".join(text for node, text in page.segments if kept[node]))
    return found


def extract_text(pages: DataFrame, model: Boosted | None) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages`` (page_id, url, html); a null html has an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                texts = main_texts([Page(html or "") for html in part.column("html").to_pylist()], model)
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
