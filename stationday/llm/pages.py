"""Main text of web pages from flat text blocks and a decision tree.

A page is cut into blocks at block-level tags. Each block is described by its word count and link
density, those of its neighbours, and the kind of element it stands in. A decision tree, grown from the
small labelled table below, tells article text from the rest.

Defined results: null or empty html, and pages without article text, give an empty text. Unclosed tags
end with the page. Rows that repeat are extracted each. Extra columns are ignored; an empty table gives
an empty result. No text is cut at any length.
"""

from __future__ import annotations

import functools
import html as references
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Elements whose content is never text.
_RAW = "script|style|noscript|template|svg|math|iframe|object|select|textarea|canvas|title|audio|video|button"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    # an empty element; the slash that ends an unquoted value belongs to the value
    r"|<(?:svg|math)(?=[\s/])(?:\s++|/(?!>)|[^\s=>/\"']++(?:\s*+=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s>\"']++))?+)*+/>"
    rf"|<({_RAW})(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S | re.I,
)
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hr html label legend li main menu nav ol optgroup option p pre section summary table"
    " tbody td tfoot th thead tr ul".split()
)
#: Elements that stay open around blocks and tell where a block stands.
_HOLDING = frozenset("article aside blockquote body details dialog div figure footer form header li main menu nav ol section table ul".split())
_BOILERPLATE = frozenset("nav aside footer form menu dialog".split())
_MARKED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|notice|popup|modal|newsletter|subscribe|signup"
    r"|login|sidebar|widget|menu|nav\w*|breadcrumbs?|share|social|related|recommend\w*|footer|masthead|copyright|toolbar|alert"
    r"|comments?|disqus|replies|respond|paywall|pagination|skip)(?:$|[\s_-])",
    re.I,
)
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)

FEATURES = (
    "in_article", "in_boilerplate", "heading", "words", "link_density", "words_before", "words_after",
    "links_before", "links_after", "in_list", "sentence_end",
)


@dataclass
class Block:
    text: str
    words: int
    links: float
    in_article: bool
    in_boilerplate: bool
    in_list: bool
    heading: bool


def blocks_of(html: str) -> list[Block]:
    """The blocks of a page that hold any text, in order."""
    out: list[Block] = []
    held: list[tuple[str, bool, bool]] = []  # (tag, article, boilerplate) of the open holding elements
    parts: list[str] = []
    linked: list[str] = []
    in_link, heading = False, False

    def flush() -> None:
        nonlocal parts, linked
        text = " ".join(references.unescape("".join(parts)).split())
        if text:
            link_words = len(references.unescape(" ".join(linked)).split())
            words = len(text.split(" "))
            article, boilerplate = held[-1][1:] if held else (False, False)
            out.append(
                Block(text, words, min(1.0, link_words / words), article, boilerplate, any(h[0] in ("li", "ul", "ol") for h in held), heading)
            )
        parts, linked = [], []

    at = 0
    for m in _TOKEN.finditer(html):
        if m.start() > at:
            run = html[at : m.start()]
            parts.append(run)
            if in_link:
                linked.append(run)
        at = m.end()
        tag = (m[3] or "").lower()
        if tag == "br":
            parts.append(" ")
        elif tag == "a":
            in_link = not m[2]
        if tag not in _BLOCK:
            continue
        flush()
        in_link = False
        if tag[0] == "h" and tag[1:].isdigit():
            heading = not m[2]
            continue
        heading = False
        if tag not in _HOLDING:
            continue
        if m[2]:
            for i in range(len(held) - 1, -1, -1):
                if held[i][0] == tag:
                    del held[i:]
                    break
        elif not (m[4] or "").rstrip().endswith("/"):
            article, boilerplate = held[-1][1:] if held else (False, False)
            attributes = m[4] or ""
            names = " ".join(next(filter(None, n), "") for n in _NAMES.findall(attributes))
            article = article or tag in ("article", "main")
            if tag in _BOILERPLATE or (tag == "header" and not article) or _MARKED.search(names) or _HIDDEN.search(attributes):
                boilerplate = boilerplate or tag != "body"
            held.append((tag, article, boilerplate))
    parts.append(re.sub(r"<[a-zA-Z/!?][^>]*\Z", "", html[at:]))  # a tag cut off by the end is no text
    flush()
    return out


def features(blocks: list[Block]) -> np.ndarray:
    """One row per block: its own numbers and those of its neighbours."""
    out = np.zeros((len(blocks), len(FEATURES)))
    for i, b in enumerate(blocks):
        before = blocks[i - 1] if i else None
        after = blocks[i + 1] if i + 1 < len(blocks) else None
        out[i] = (
            b.in_article, b.in_boilerplate, b.heading, b.words, b.links,
            before.words if before else 0, after.words if after else 0,
            before.links if before else 0, after.links if after else 0,
            b.in_list, b.text[-1] in ".!?…:;\"”»",
        )
    return out


#: The labelled table: pages whose blocks begin with ``+`` (article) or ``-`` (the rest). ``~n~`` stands for n words.
LABELLED = (
    "<body><nav><ul><li><a>-home</a><li><a>-world news</a></ul></nav><div class=ad>-~9~.</div><article><h1>+~8~</h1><p>+~60~.</p>"
    "<p>+~5~.</p><p>+~1~</p></article><footer>-~14~.</footer></body>",
    "<body><header><h1>-site</h1><a>-sign in</a></header><main><article><h2>+~4~</h2><p>+~45~.<p>+~30~ <a>~3~</a>.<ul><li>+~12~.<li>+~3~"
    "</ul><blockquote>+~25~.</blockquote></article></main><aside><h3>-~2~</h3><p>-~40~.</p></aside><footer><p>-~33~.</p></footer>",
    "<body><div id=menu><a>-~1~</a></div><div><h1>+~7~</h1><p>+~80~.</p><p>+~22~.</p><p>+~64~ <a>~2~</a>.</p></div><div class=comments>"
    "<h3>-~2~</h3><p>-~30~.</p><p>-~55~.</p></div><div id=footer>-~10~ <a>~6~</a></div>",
    "<body><div><a>-~2~</a> | <a>~1~</a> | <a>~2~</a></div><div><p>+~90~.</p><p>+~33~.</p></div><div><a>-~9~</a></div><div>-~4~</div>",
    "<body><article><header><h1>+~6~</h1></header><div class=share><a>-~1~</a></div><p>+~2~.</p><div class='newsletter signup'><p>-~18~.</p>"
    "<form>-~3~</form></div><p>+~70~.</p><aside>-~26~.</aside><p>+~11~</p><section class='user-comments'><article><p>-~34~.</p></article>"
    "</section></article><div>-~5~</div>",
    "<body><div role=banner>-~7~</div><div class=cookie-notice><p>-~28~.</p></div><main><h1>+~5~</h1><p>+~16~ <a>~14~</a>.</p><p>+~3~</p>"
    "<table><tr><td>+~2~<td>+~6~</table></main><div class=related><h4>-~3~</h4><a>-~8~</a></div>",
    "<body><p>-~3~</p><p>+~40~.</p><p>+~35~.</p><p>+~28~.</p><p>-~2~ <a>~2~</a></p>",
    "<body><div><ul><li><a>-~2~</a><li><a>-~3~</a><li><a>-~2~</a></ul></div><div>+~120~.</div><div>-~3~ <a>~3~</a></div>",
    "<body><article><h1>+~4~</h1><p>+~20~.</p><p>+~9~",
    "<body><article><p>+~2~</p><p><a>+~6~</a></p><ul><li><a>+~2~</a><li>+~1~</ul><p>+~300~.</p>",
    "<body><main><p><a>+~3~</a></p></main>",
    "<body><div>-~4~</div><article><p>+~1~</p></article><div>-~6~</div><div>-~3~</div>",
    "<body><div><p>+~45~.</p><p>+~31~.</p></div>",
)


def labelled_blocks() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the labelled table."""
    rows, labels = [], []
    for page in LABELLED:
        blocks = blocks_of(re.sub(r"~(\d+)~", lambda m: " ".join(["word"] * int(m[1])), page))
        labels.extend(b.text[0] == "+" for b in blocks)
        rows.append(features(blocks))
    return np.concatenate(rows), np.array(labels)


@dataclass(frozen=True)
class Tree:
    """A decision tree: a label, or a feature, its threshold and two trees."""

    label: bool = False
    feature: int = -1
    threshold: float = 0.0
    low: Tree | None = None
    high: Tree | None = None

    def __call__(self, row: np.ndarray) -> bool:
        tree = self
        while tree.low is not None:
            tree = tree.low if row[tree.feature] <= tree.threshold else tree.high
        return tree.label


def grow(x: np.ndarray, y: np.ndarray, depth: int = 6) -> Tree:
    """Split where the weighted Gini impurity falls most; earlier features win ties."""
    share = y.mean()
    if depth == 0 or share in (0.0, 1.0):
        return Tree(label=bool(share >= 0.5))
    best = (len(y) * share * (1 - share) - 1e-9, -1, 0.0)
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for t in (values[1:] + values[:-1]) / 2:
            low = x[:, f] <= t
            impurity = sum(len(p) * p.mean() * (1 - p.mean()) for p in (y[low], y[~low]))
            if impurity < best[0] - 1e-9:
                best = (impurity, f, float(t))
    if best[1] < 0:
        return Tree(label=bool(share >= 0.5))
    low = x[:, best[1]] <= best[2]
    return Tree(feature=best[1], threshold=best[2], low=grow(x[low], y[low], depth - 1), high=grow(x[~low], y[~low], depth - 1))


@functools.cache
def trained() -> Tree:
    return grow(*labelled_blocks())


def main_text(html: str | None, tree: Tree) -> str:
    """The article's blocks, one on a line."""
    blocks = blocks_of(html or "")
    return "\n".join(b.text for b, row in zip(blocks, features(blocks)) if tree(row))


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    tree = trained()

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                texts = [main_text(h, tree) for h in part.column("html").to_pylist()]
                yield pa.record_batch(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )

    return pages.select("page_id", "url", "html").mapInArrow(extracted, "page_id long, url string, text string, n_chars long")
