"""Main text of web pages: gradient-boosted trees score the block elements of a page, decoding makes the choices agree.

The classifier is fitted here, on ``TRAINING_PAGES`` pages that are laid out at random from a fixed seed, with known roles: the
bound and the seed are its only inputs, so every run fits the same trees. Its features are subtree density, attribute words,
depth, position and statistics of siblings (see ``dom``). It never sees words of the text, so the language doesn't matter.

Decoding picks the set of elements with the highest sum of scores in which no chosen element stands in one that is not chosen.

A null, empty or unreadable page gives an empty text; a page cut short is read to its end. Rows are independent, so repeated rows
and other columns change nothing; null urls and ids pass through.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidegate.llm.dom import Page

TRAINING_PAGES = 500
SEED = 5
TREES = 40
DEPTH = 4
BINS = 32
RATE = 0.25
PAGES_AT_ONCE = 100


@dataclass(frozen=True)
class Trees:
    """Complete binary trees by level: at each inner node a feature and a threshold, at each leaf a score."""

    feature: np.ndarray
    threshold: np.ndarray
    score: np.ndarray
    start: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros((len(x), len(self.feature)), dtype=np.int64)
        trees, rows = np.arange(len(self.feature))[None, :], np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            at = 2 * at + 1 + (x[rows, self.feature[trees, at]] > self.threshold[trees, at])
        return self.start + self.score[trees, at - ((1 << DEPTH) - 1)].sum(axis=1)


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
    """Boosted trees for log-loss, on features cut into at most ``BINS`` bins."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    bins = np.column_stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)])
    n, width = x.shape
    inner = (1 << DEPTH) - 1
    start = float(np.log(np.average(y, weights=weight) / (1 - np.average(y, weights=weight))))
    margin = np.full(n, start)
    features, thresholds, scores = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = weight * (p - y), weight * p * (1 - p) + 1e-9
        at = np.zeros(n, dtype=np.int64)
        feature, threshold = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        for level in range(DEPTH):
            first, nodes = (1 << level) - 1, 1 << level
            key = (((at - first)[:, None] * width + np.arange(width)) * BINS + bins).ravel()
            shape = (nodes, width, BINS)
            g = np.bincount(key, np.repeat(grad, width), nodes * width * BINS).reshape(shape).cumsum(axis=2)
            h = np.bincount(key, np.repeat(hess, width), nodes * width * BINS).reshape(shape).cumsum(axis=2)
            ga, ha = g[:, :1, -1:], h[:, :1, -1:]
            gain = g**2 / (h + 1) + (ga - g) ** 2 / (ha - h + 1) - ga**2 / (ha + 1)
            gain[(h < 1) | (ha - h < 1)] = -1
            best = gain.reshape(nodes, -1).argmax(axis=1)
            for node in range(nodes):
                f, b = divmod(int(best[node]), BINS)
                if gain[node, f, b] > 1e-6 and b < len(edges[f]):
                    feature[first + node], threshold[first + node] = f, edges[f][b]
            at = 2 * at + 1 + (x[np.arange(n), feature[at]] > threshold[at])
        leaf = at - inner
        score = -RATE * np.bincount(leaf, grad, inner + 1) / (np.bincount(leaf, hess, inner + 1) + 1)
        margin += score[leaf]
        features.append(feature)
        thresholds.append(threshold)
        scores.append(score)
    return Trees(np.array(features), np.array(thresholds), np.array(scores), start)


class Layout:
    """Random pages with known roles. Main text is written in capitals, everything else in small letters."""

    def __init__(self, seed: int):
        self.random = random.Random(seed)

    def words(self, low: int, high: int, main: bool) -> str:
        r = self.random
        some = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9))) for _ in range(r.randint(low, high))]
        text = " ".join(w + r.choice([",", ".", "", "", "", "", "", "", ""]) for w in some) + r.choice([".", "", "."])
        return text.upper() if main else text

    def pick(self, *options: str) -> str:
        return self.random.choice(options)

    def named(self, tags: str, names: str) -> tuple[str, str]:
        r = self.random
        tag, name = r.choice(tags.split()), r.choice(names.split())
        name = r.choice([name, f"{name}-{r.choice(['box', 'wrap', 'area', 'inner', 'block', 'list', '1'])}", f"{r.choice(['site', 'page', 'top', 'js', 'x'])}-{name}"])
        kind = r.choice(["class", "class", "id"])
        return f'<{tag} {kind}="{name}">' if tag in ("div", "section", "ul", "p") or r.random() < 0.4 else f"<{tag}>", f"</{tag}>"

    def links(self, low: int, high: int) -> str:
        each = [f'<a href="/x">{self.words(1, 3, False)}</a>' for _ in range(self.random.randint(low, high))]
        if self.random.random() < 0.7:
            return "<ul>" + "".join(f"<li>{e}" + self.pick("</li>", "</li>", "") for e in each) + "</ul>"
        return self.pick(" | ", " ", "\n").join(each)

    def paragraphs(self, low: int, high: int, main: bool) -> str:
        out = []
        for _ in range(self.random.randint(low, high)):
            text = self.words(*self.pick_range(), main)
            if self.random.random() < 0.25:
                text = self.pick("<b>", "<em>", "<a href='/y'>", "<span>") + text + self.pick("", "</b>", "</em>", "</a>", "</span>")
            out.append(self.pick("<p>", "<p>", "<p>", "<p><b>", "<div>") + text)
            out[-1] += "</div>" if out[-1].startswith("<div>") else self.pick("</p>", "</p>", "<br>", "")
        return "".join(out)

    def pick_range(self) -> tuple[int, int]:
        return self.random.choice([(1, 4), (5, 15), (15, 60), (40, 120)])

    def boiler(self) -> str:
        r = self.random
        kind = r.randrange(9)
        if kind == 0:
            a, b = self.named("nav nav div ul", "nav navbar menu breadcrumb pagination topnav")
            return a + self.links(2, 10) + b
        if kind == 1:
            a, b = self.named("header header div", "header masthead topbar branding banner")
            return a + self.pick("", f"<h1>{self.words(1, 4, False)}</h1>", f"<p>{self.words(2, 8, False)}</p>") + self.pick("", self.links(2, 6)) + b
        if kind == 2:
            a, b = self.named("footer footer div", "footer copyright legal colophon")
            return a + self.pick("&copy; ", "<p>", "") + self.words(3, 40, False) + self.pick("", self.links(1, 6)) + b
        if kind == 3:
            a, b = self.named("aside aside div section", "sidebar widget related recommended popular")
            return a + self.pick("", f"<h3>{self.words(1, 4, False)}</h3>") + self.pick(self.links(2, 8), self.paragraphs(1, 3, False)) + b
        if kind == 4:
            a, b = self.named("div div section aside", "ad ads advert sponsor promo sponsored advertisement")
            return a + self.pick(self.words(2, 40, False), self.paragraphs(1, 2, False)) + b
        if kind == 5:
            a, b = self.named("div div section p", "notice cookie consent alert newsletter subscribe popup")
            return a + self.words(4, 60, False) + self.pick("", "<button>ok</button>") + b
        if kind == 6:
            a, b = self.named("section div div ul", "comments comment discussion replies respond")
            inner, close = self.pick("<div class='comment'>", "<article class='comment'>", "<li class='reply'>", "<div>"), ""
            close = "</" + inner[1:].split()[0].rstrip(">") + ">"
            return a + self.pick("", f"<h2>{self.words(1, 4, False)}</h2>") + "".join(inner + self.paragraphs(1, 3, False) + close for _ in range(r.randint(1, 6))) + b
        if kind == 7:
            a, b = self.pick("<form>", "<form class='search'>", "<form id='login'>"), "</form>"
            return a + "".join(f"<label>{self.words(1, 4, False)}</label><input name=q>" for _ in range(r.randint(1, 4))) + f"<p>{self.words(2, 20, False)}</p><button>go</button>" + b
        a, b = self.named("div ul p section", "share social follow tags byline toolbar")
        return a + self.links(1, 6) + b

    def main(self) -> str:
        r = self.random
        tags = self.pick("<article>|</article>", "<main>|</main>", "<div>|</div>", "<div class='content'>|</div>", "<div id='main'>|</div>", "<div class='post-body'>|</div>", "<section class='story'>|</section>", "<main><article>|</article></main>", "<article class='entry'><div class='text'>|</div></article>", "<div class='article'><div>|</div></div>")
        a, b = tags.split("|")
        parts = [f"<h1>{self.words(2, 12, True)}</h1>"] if r.random() < 0.8 else []
        if r.random() < 0.25:  # a very short article
            return a + "".join(parts) + self.pick("<p>", "<p><b>", "") + self.words(1, 8, True) + self.pick("</p>", "<br>", "") + b
        for _ in range(r.randint(1, 5)):
            kind = r.randrange(9)
            if kind < 5:
                parts.append(self.paragraphs(1, 8, True))
            elif kind == 5:
                parts.append(f"<h2>{self.words(1, 8, True)}</h2>" + self.paragraphs(1, 3, True))
            elif kind == 6:
                parts.append("<ul>" + "".join(f"<li>{self.words(2, 25, True)}" + self.pick("</li>", "") for _ in range(r.randint(2, 8))) + "</ul>")
            elif kind == 7:
                parts.append(self.pick("<blockquote>", "<pre>", "<section>") + self.words(5, 60, True))
                parts[-1] += "</" + parts[-1][1:].split(">")[0] + ">"
            else:
                parts.append("<table>" + "".join("<tr>" + "".join(f"<td>{self.words(1, 5, True)}</td>" for _ in range(3)) + "</tr>" for _ in range(r.randint(2, 5))) + "</table>")
            if r.random() < 0.3:
                parts.append(self.boiler())
        return a + "".join(parts) + b

    def page(self) -> str:
        r = self.random
        before, after = [self.boiler() for _ in range(r.randint(0, 4))], [self.boiler() for _ in range(r.randint(0, 5))]
        body = "".join(before) + self.main() + "".join(after)
        for _ in range(r.randrange(3)):
            body = self.pick("<div>", "<div class='wrap'>", "<div id='page'>", "<div class='container'>", "<div class='row'>") + body + "</div>"
        return f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body>{body}" + self.pick("</body></html>", "")


def trained(pages: int = TRAINING_PAGES, seed: int = SEED) -> Trees:
    layout = Layout(seed)
    xs, ys, weights = [], [], []
    for _ in range(pages):
        page = Page(layout.page())
        main, other = np.zeros(len(page.tag)), np.zeros(len(page.tag))
        for node, _, text in page.segments:
            main[node] += sum(c.isupper() for c in text)
            other[node] += sum(c.islower() for c in text)
        for k in range(len(page.tag) - 1, 0, -1):
            main[page.parent[k]] += main[k]
            other[page.parent[k]] += other[k]
        some = main + other > 0
        xs.append(page.features()[some])
        ys.append(main[some] > 0)
        weights.append(1 + np.log1p((main + other)[some]) / 5)
    return fit(np.concatenate(xs), np.concatenate(ys).astype(np.float64), np.concatenate(weights))


def chosen(parent: list[int], score: np.ndarray) -> np.ndarray:
    """The elements with the highest sum of scores, none of them in one that is left out."""
    value = score.astype(np.float64).copy()
    for k in range(len(parent) - 1, 0, -1):
        if value[k] > 0:
            value[parent[k]] += value[k]
    keep = np.zeros(len(parent), dtype=bool)
    keep[0] = True
    for k in range(1, len(parent)):
        keep[k] = keep[parent[k]] and value[k] > 0
    return keep


def texts_of(htmls: list[str | None], trees: Trees) -> list[str]:
    pages = [Page(h or "") for h in htmls]
    x = [p.features() for p in pages]
    margins = np.split(trees.margin(np.concatenate(x)), np.cumsum([len(f) for f in x])[:-1]) if x else []
    return [p.text(chosen(p.parent, m)) for p, m in zip(pages, margins)]


def main_texts(pages: DataFrame, trees: Trees | None = None) -> DataFrame:
    """Per row of ``pages``: page_id, url, text and n_chars."""
    model = trees or trained()

    def extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            htmls = list(frame["html"])
            found = [t for at in range(0, len(htmls), PAGES_AT_ONCE) for t in texts_of(htmls[at : at + PAGES_AT_ONCE], model)]
            yield pd.DataFrame({"page_id": frame["page_id"].astype("Int64"), "url": frame["url"], "text": found, "n_chars": [len(t) for t in found]})

    plain = pages.select(F.col("page_id").cast("long"), "url", "html")
    return plain.mapInPandas(extract, "page_id long, url string, text string, n_chars long")
