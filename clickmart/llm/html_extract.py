"""HTML extraction (operator 12): tag-path ratios.

A page is read into text pieces, each with the path of open tags (and their classes) from the
root. Per path, pieces, characters and punctuation marks are added up; a path's two ratios are
characters and marks for each piece. Every piece gets its path's ratios, which are smoothed by a
Gaussian over its neighbours in page order and fused by multiplication; a path's value is the mean
of its pieces'. Paths are content if that is ``LAMBDA`` standard deviations of all pieces'
values or more (the best path always is): prose is long and punctuated, menus and captions are not.

The content nodes lie in the least container that holds all pieces of content paths: the
article. If that is an element of its own, all its blocks are taken, headings and one-word
paragraphs too; if it is the page's body, the blocks of content paths, and headings, paragraphs,
list items, quotes, tables and preformatted text. Blocks that are links as a whole, and no
content path's, headings or paragraphs, are menus.

Text that can't be the article's has no ratios and is never taken: elements for scripts, styles,
navigation, headers (outside of an article), footers, asides, forms and the like, and elements
whose class, id or role says so (``HINTS``), unless a main heading is in them. Unclosed and
misnested tags are closed as HTML does for paragraphs, list items and table cells; an end tag
without a start does nothing.

Defined results: a null or empty page, and one without content, gives the empty text; character
references are decoded; white space in a block (line breaks too) becomes one space; blocks keep
page order, repeated ones stay; nothing is cut off; repeated rows are rows like any other; an
empty table gives an empty result. Each row is read by itself, so there is no shuffle.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LAMBDA, SIGMA, RADIUS = 0.8, 0.6, 1
DEEPEST = 512  # an element further down stands beside the one before it, as in browsers

# HTML's elements by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p "
    "pre search section select summary table tbody td tfoot th thead title tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body caption dd dt head html legend li optgroup option tbody td tfoot th thead title tr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TEXT_BLOCKS = HEADINGS | frozenset("p li dt dd blockquote pre td th caption figcaption".split())
#: Blocks that stand inside a container rather than being one.
PARTS = TEXT_BLOCKS | frozenset("ul ol dl table thead tbody tfoot tr figure hgroup".split())
#: A start tag closes an open element of its group, up to the element that bounds it.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
}
# Elements that never hold the article's text.
NEVER = frozenset(
    "head script style template noscript noframes noembed nav header footer aside form menu dialog iframe object "
    "canvas audio video svg math select button textarea title xmp search".split()
)
# Words of a class, id or role that name such elements.
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion breadcrumb breadcrumbs "
    "comment comments disqus replies cookie cookies consent gdpr notice notices footer header masthead menu nav "
    "navbar navigation newsletter subscribe signup popup modal overlay related recommended share sharing social "
    "sidebar toolbar pagination pager contentinfo complementary search dialog alertdialog".split()
)

TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"  # a comment
    r"|</(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    r"""|<(?P<start>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>=]|=\s*(?:"[^"]*"|'[^']*')|=)*+)(?:>|\Z)"""
    r"|<[!?][^>]*(?:>|\Z)|</[^>]+(?:>|\Z)|</>",  # declarations and the like
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
TELLING = re.compile("class|id|role|hidden|style", re.IGNORECASE)  # attributes that are read
NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
MARKS = re.compile("[,.;:!?…、。，；：！？]")


class Page:
    """Elements (parents before children; 0 is the root) and text pieces of a page."""

    def __init__(self) -> None:
        self.parent, self.tag, self.path, self.hinted = [0], [""], [0], [False]
        self.paths: dict[tuple, int] = {}
        self.pieces: list[tuple[int, int, str]] = []  # element, block number, text
        self.open, self.count, self.block = [0], Counter(), 0

    def start(self, tag: str, attrs: str) -> None:
        if tag in CLOSES_P:
            self._close({"p"}, ())
        if tag in SIBLINGS:
            self._close(*SIBLINGS[tag])
        if tag in BLOCK:
            self.block += 1
        if tag == "br":
            self.text(" ")
        if tag in VOID:
            return
        names, hinted = _names(attrs) if attrs and TELLING.search(attrs) else ("", False)
        if len(self.open) > DEEPEST:
            self._pop(DEEPEST)
        top = self.open[-1]
        self.count[tag] += 1
        self.open.append(len(self.parent))
        self.parent.append(top)
        self.tag.append(tag)
        self.path.append(self.paths.setdefault((self.path[top], tag, names), len(self.paths) + 1))
        self.hinted.append(hinted and tag not in ("html", "body", "main"))

    def _pop(self, at: int) -> None:
        for e in self.open[at:]:
            self.count[self.tag[e]] -= 1
        del self.open[at:]

    def _close(self, tags: Collection[str], bounds: Collection[str]) -> None:
        """Close the last open element of ``tags``, if it is above the last one of ``bounds``."""
        if any(self.count[t] for t in tags):
            for i in range(len(self.open) - 1, 0, -1):
                tag = self.tag[self.open[i]]
                if tag in bounds:
                    return
                if tag in tags:
                    self._pop(i)
                    self.block += 1
                    return

    def end(self, tag: str) -> None:
        if tag in BLOCK:
            self.block += 1
        if self.count[tag]:
            at = max(i for i, e in enumerate(self.open) if self.tag[e] == tag)
            if any(self.tag[e] in BLOCK for e in self.open[at + 1:]):
                self.block += 1
            self._pop(at)

    def text(self, text: str) -> None:
        self.pieces.append((self.open[-1], self.block, text))


def _names(attrs: str) -> tuple[str, bool]:
    """The class without digits (for the path), and whether class, id or role name a part that
    isn't the article's or the element is hidden."""
    found = {}
    for name, *values in ATTRIBUTE.findall(attrs):
        found.setdefault(name.lower(), "".join(values))
    words = {w.lower() for n in ("class", "id", "role") for w in NAME_WORDS.findall(found.get(n, ""))}
    hidden = "hidden" in found or re.search(r"display:\s*none", found.get("style", "")) is not None
    return re.sub(r"\d+", "", found.get("class", "")), hidden or not words.isdisjoint(HINTS)


def read_page(html: str) -> Page:
    page, at = Page(), 0
    while True:
        m = TOKEN.search(html, at)
        upto = m.start() if m else len(html)
        if upto > at:
            page.text(html_lib.unescape(html[at:upto]))
        if m is None:
            return page
        at = m.end()
        if m["start"]:
            tag = m["start"].lower()
            page.start(tag, m["attrs"])
            if tag in RAW:
                close = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(html, at)
                at = close.start() if close else len(html)
        elif m["end"]:
            page.end(m["end"].lower())


def excluded(page: Page) -> list[bool]:
    """Which elements can't hold the article's text."""
    n = len(page.parent)
    titled = [tag in ("h1", "main") for tag in page.tag]
    for e in range(n - 1, 0, -1):
        if titled[e]:
            titled[page.parent[e]] = True
    out, inside = [False] * n, [False] * n  # inside: of an article
    for e in range(1, n):
        up, tag = page.parent[e], page.tag[e]
        inside[e] = inside[up] or tag in ("article", "main")
        article_header = tag == "header" and inside[e] and titled[e]
        out[e] = out[up] or (tag in NEVER and not article_header) or (page.hinted[e] and not titled[e])
    return out


def smoothed(values: np.ndarray) -> np.ndarray:
    """Gaussian mean over the neighbours in page order."""
    kernel = np.exp(-0.5 * (np.arange(-RADIUS, RADIUS + 1) / SIGMA) ** 2)
    weight = np.convolve(np.ones(len(values)), kernel)[RADIUS:-RADIUS]
    return np.convolve(values, kernel)[RADIUS:-RADIUS] / weight


def content_paths(path: np.ndarray, chars: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Which pieces are of content paths, from each piece's path, characters and marks."""
    _, of, count = np.unique(path, return_inverse=True, return_counts=True)
    by_path = [np.bincount(of, x) / count for x in (chars, marks)]
    fused = smoothed(by_path[0][of]) * (1 + smoothed(by_path[1][of]))
    value = np.bincount(of, fused) / count
    return (value >= min(LAMBDA * fused.std(), value.max()))[of]


def main_text(html: str) -> str:
    """The article of one page: its blocks, two line feeds between them."""
    page = read_page(html)
    gone = excluded(page)
    pieces = [p for p in page.pieces if not gone[p[0]]]
    solid = [(e, "".join(t.split())) for e, _, t in pieces]
    solid = [(e, t) for e, t in solid if t]
    if not solid:
        return ""
    content = content_paths(
        np.array([page.path[e] for e, _ in solid]), np.array([float(len(t)) for _, t in solid]),
        np.array([float(len(MARKS.findall(t))) for _, t in solid]),
    )
    paths = {page.path[e] for (e, _), c in zip(solid, content.tolist(), strict=True) if c}

    # For each element the block that holds its text, and whether that is within a link.
    n = len(page.parent)
    block, linked = [0] * n, [False] * n
    for e in range(1, n):
        block[e] = e if page.tag[e] in BLOCK else block[page.parent[e]]
        linked[e] = page.tag[e] == "a" or (linked[page.parent[e]] and block[e] != e)
    held = [0] * n
    total = 0
    for e, _ in solid:
        if page.path[e] in paths:
            a, total = block[e], total + 1
            while page.tag[a] in PARTS:
                a = block[page.parent[a]]
            held[a] += 1
    for e in range(n - 1, 0, -1):
        held[page.parent[e]] += held[e]
    root = max(e for e in range(n) if held[e] == total)  # elements that hold all are nested
    inside = [e == root for e in range(n)]
    for e in range(root + 1, n):
        inside[e] = inside[e] or inside[page.parent[e]]
    own = page.tag[root] not in ("", "html", "body")

    blocks: dict[int, list[tuple[int, str]]] = {}
    for e, number, text in pieces:
        if inside[e]:
            blocks.setdefault(number, []).append((e, text))
    out = []
    for parts in blocks.values():
        text = " ".join("".join(t for _, t in parts).split())
        if not text:
            continue
        full = [e for e, t in parts if t.strip()]
        tag = page.tag[block[full[0]]]
        rated = any(page.path[e] in paths for e in full)
        menu = not rated and tag not in HEADINGS and tag != "p" and all(linked[e] for e in full)
        if rated or (not menu and (own or tag in TEXT_BLOCKS)):
            out.append(text)
    return "\n\n".join(out)


def extract(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """``pages`` without the markup column, plus the main text and its ``n_chars`` (own columns of
    these names give way)."""
    kept = [c for c in pages.columns if c not in (html_col, text_col, "n_chars")]
    page = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    names = [f"c{i}" for i in range(len(kept))]
    rows = pages.select(*[F.col(c).alias(a) for c, a in zip(kept, names, strict=True)], page.alias("html"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = pa.array([main_text(h.as_py()) for h in b.column("html")], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], texts], names=[*names, "text"])

    schema = T.StructType([*rows.select(*names).schema.fields, T.StructField("text", T.StringType())])
    found = rows.mapInArrow(of, schema)
    return found.select(
        *[F.col(a).alias(c) for c, a in zip(kept, names, strict=True)], F.col("text").alias(text_col),
        F.char_length("text").cast("long").alias("n_chars"),
    )
