"""Web pages as trees of block elements with the features that the page classifier reads.

Reads tag soup in one pass: unclosed and stray tags, raw text of scripts and styles, comments, cut-off pages.
"""

from __future__ import annotations

import math
import re
from html import unescape

import numpy as np

TAG = re.compile(r"""<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:"[^"]*(?:"|$)|'[^']*(?:'|$))|[^>])*+)(?:>|$)""", re.S)
NAMED = re.compile(r"""(?:^|\s)(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
SENTENCE = re.compile(r"[.,;:!?]")
RAW = frozenset("script style noscript template textarea title iframe svg object select".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table"
    " tbody td tfoot th thead tr ul".split()
)
# An opening tag of the second kind ends an open one of the first kind.
CLOSES_P = BLOCKS - frozenset("button caption tbody td tfoot th thead tr option optgroup".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
FENCE = frozenset("table ul ol dl div section article aside nav body form main header footer".split())
# Words of class, id, role and label attributes, by what they usually mark.
ROLES = [
    frozenset("nav navbar navigation menu menus menubar breadcrumb breadcrumbs pagination pager toc topnav tabs tabbar skip".split()),
    frozenset("header masthead topbar branding logo hero banner head".split()),
    frozenset("footer foot bottom copyright legal colophon imprint contentinfo".split()),
    frozenset("sidebar aside side widget widgets rail related recommended popular trending complementary more teaser teasers".split()),
    frozenset("ad ads adv advert adverts advertisement adbox adsense sponsor sponsored promo promotion promoted outbrain taboola".split()),
    frozenset("notice cookie cookies consent gdpr alert popup modal overlay notification newsletter subscribe paywall signup message".split()),
    frozenset("comment comments commentlist reply replies respond discussion disqus thread feedback responses".split()),
    frozenset("form login search searchbox input contact register".split()),
    frozenset("share sharing social follow tags tag meta byline author toolbar tools actions buttons rating".split()),
    frozenset("article content main post entry story text body copy prose markdown blog page".split()),
]
TAGS = [
    {"p"}, {"h1", "h2", "h3", "h4", "h5", "h6"}, {"li"}, {"ul", "ol", "dl", "menu"}, {"div"}, {"section"}, {"article"}, {"main"},
    {"nav"}, {"header"}, {"footer"}, {"aside"}, {"form", "fieldset", "button", "search"}, {"table", "tbody", "tr", "td", "th"},
    {"blockquote", "pre", "figure", "figcaption"}, {"html", "body"}, {"head", "dialog"},
]
GROUP = {name: g for g, names in enumerate(TAGS) for name in names}
MEASURES = 17
WIDTH = MEASURES + 2 * (len(TAGS) + len(ROLES))


class Page:
    """Block elements in page order; ``segments`` are the texts with their element and the number of their block."""

    def __init__(self, html: str):
        self.tag, self.parent, self.depth = ["html"], [-1], [0]
        self.roles: list[int] = [0]
        self.tags_in, self.link_chars, self.commas = [0], [0], [0]
        self.chars: list[int] = [0]
        self.controls = [0]
        self.starts = [0]
        self.segments: list[tuple[int, int, str]] = []
        self._read(html)

    def _open(self, name: str, attributes: str, parent: int, at: int) -> int:
        roles = 0
        for values in NAMED.findall(attributes) if "=" in attributes else ():
            for word in TOKEN.findall(" ".join(values)):
                word = word.lower()
                for k, group in enumerate(ROLES):
                    if word in group:
                        roles |= 1 << k
        self.tag.append(name)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.roles.append(roles)
        for measure in (self.tags_in, self.link_chars, self.commas, self.chars, self.controls):
            measure.append(0)
        self.starts.append(at)
        return len(self.tag) - 1

    def _read(self, html: str) -> None:
        stack: list[tuple[str, int]] = [("html", 0)]  # open elements and the block element they are in
        links = block = at = 0
        end = len(html)
        while at < end:
            found = TAG.search(html, at)
            stop = found.start() if found else end
            if stop > at:
                self._text(html[at:stop], stack[-1][1], block, links)
            if not found:
                break
            at = found.end()
            name = found[2] and found[2].lower()
            if not name:
                continue
            node = stack[-1][1]
            if found[1]:
                depth = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == name), 0)
                if depth:
                    links -= sum(n == "a" for n, _ in stack[depth:])
                    block += any(n in BLOCKS for n, _ in stack[depth:])
                    del stack[depth:]
                elif name in BLOCKS:
                    block += 1
                continue
            self.tags_in[node] += 1
            if name in ("input", "button", "select", "textarea", "label"):
                self.controls[node] += 1
            if name in RAW:
                close = re.compile(rf"</{re.escape(name)}(?=[\s/>]|$)", re.I).search(html, at)
                at = close.start() if close else end
                continue
            if name == "html" or name == "body" and any(n == "body" for n, _ in stack):
                continue
            if name == "br":
                self._text(" ", node, block, 0)
            if name in VOID:
                block += name == "hr"
                continue
            if name in BLOCKS:
                block += 1
                self._close_for(name, stack)
                links = sum(n == "a" for n, _ in stack)
                stack.append((name, self._open(name, found[3], stack[-1][1], at)))
            else:
                links += name == "a"
                stack.append((name, node))

    def _close_for(self, name: str, stack: list[tuple[str, int]]) -> None:
        if stack[-1][0] == "head" and name != "head":
            stack.pop()
        wanted = SAME.get(name, frozenset()) | ({"p"} if name in CLOSES_P else frozenset())
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in wanted:
                del stack[k:]
                if name not in SAME:
                    return
                return self._close_for(name, stack)
            if stack[k][0] in FENCE:
                return

    def _text(self, text: str, node: int, block: int, links: int) -> None:
        if "&" in text:
            text = unescape(text)
        self.segments.append((node, block, text))
        n = len(text.strip())
        if n:
            self.chars[node] += n
            self.commas[node] += len(SENTENCE.findall(text))
            self.link_chars[node] += n if links else 0

    def features(self) -> np.ndarray:
        n = len(self.tag)
        own = np.array([self.chars, self.link_chars, self.commas, self.tags_in, self.controls], dtype=np.float64)
        total = own.copy()
        parent, texts, blocks = self.parent, [0] * n, [0] * n
        for k in range(n):
            texts[k] = int(self.chars[k] > 0)
        for k in range(n - 1, 0, -1):  # children come after their parents
            total[:, parent[k]] += total[:, k]
            texts[parent[k]] += texts[k]
            blocks[parent[k]] += blocks[k] + 1
        order: dict[int, list[int]] = {}
        for k in range(1, n):
            order.setdefault(parent[k], []).append(k)
        chars, linked, commas, tags, controls = total
        density = (linked + 1e-9) / (chars + 1e-6)
        out = np.zeros((n, WIDTH), dtype=np.float32)
        out[:, 0] = self.depth
        out[:, 1] = np.log1p(chars)
        out[:, 2] = np.log1p(own[0])
        out[:, 3] = np.minimum(density, 1)
        out[:, 4] = commas / (chars + 1)
        out[:, 5] = (tags + np.array(blocks)) / (chars + 10)
        out[:, 6] = np.log1p(blocks)
        out[:, 7] = np.log1p(chars / np.maximum(np.array(texts), 1))
        out[:, 8] = controls / (tags + 1)
        out[:, 9] = chars / (chars[0] + 1)
        out[:, 10] = np.array(self.starts) / (self.starts[-1] + 1)
        for up, children in order.items():
            for k, child in enumerate(children):
                out[child, 11] = k / len(children)
                out[child, 12] = chars[child] / (chars[up] + 1)
                out[child, 13] = math.log1p(len(children))
                out[child, 14] = density[children[k - 1]] if k else -1
                out[child, 15] = density[children[k + 1]] if k + 1 < len(children) else -1
                out[child, 16] = sum(self.tag[c] == self.tag[child] for c in children[max(0, k - 3) : k + 4]) / 7
        groups = len(TAGS) + len(ROLES)
        for k, name in enumerate(self.tag):
            row = out[k]
            if name in GROUP:
                row[MEASURES + GROUP[name]] = 1
            for g in range(len(ROLES)) if self.roles[k] else ():
                row[MEASURES + len(TAGS) + g] = self.roles[k] >> g & 1
            if k:  # what the element stands in
                row[MEASURES + groups :] = np.maximum(out[parent[k], MEASURES : MEASURES + groups], out[parent[k], MEASURES + groups :])
        return out

    def text(self, wanted: np.ndarray) -> str:
        """The blocks of the wanted elements: white space as one space, blocks joined by an empty line."""
        found, last, parts = [], -1, []
        for node, block, text in self.segments:
            if wanted[node]:
                if block != last and parts:
                    found.append(" ".join("".join(parts).split()))
                    parts = []
                last = block
                parts.append(text)
        found.append(" ".join("".join(parts).split()))
        return "\n\n".join(f for f in found if f)
