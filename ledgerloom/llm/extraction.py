"""Main text of web pages: flat text blocks, classified by a decision tree over words and link density.

A page becomes its text blocks in order. A block has its word count and link density (share of its words inside links),
those of both neighbours, and what encloses it: how deep it lies in a main-text element and in an element that by tag,
role or class is furniture. The tree is grown from ``TRAINING``, a small table of labelled blocks.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.arrays import slices, text_column

FEATURES = ["in_main", "in_furniture", "words", "links", "words_before", "links_before", "words_after", "links_after"]
#: Labelled blocks: FEATURES, then 1 for main text.
TRAINING = [
    # paragraphs and headings of an article, long and short, first and last
    (1, 0, 80, 0.0, 9, 0.0, 70, 0.0, 1), (1, 0, 9, 0.0, 14, 0.0, 80, 0.0, 1), (1, 0, 1, 0.0, 60, 0.0, 40, 0.0, 1),
    (1, 0, 3, 0.0, 1, 1.0, 2, 0.0, 1), (1, 0, 45, 0.1, 3, 0.0, 12, 0.2, 1), (1, 0, 2, 0.0, 2, 0.0, 2, 0.0, 1),
    (1, 0, 30, 0.3, 25, 0.0, 8, 0.0, 1), (1, 0, 120, 0.02, 0, 0.0, 0, 0.0, 1), (1, 0, 5, 0.0, 0, 0.0, 0, 0.0, 1),
    (1, 0, 6, 1.0, 40, 0.0, 50, 0.0, 1), (1, 0, 12, 0.5, 60, 0.1, 30, 0.0, 1), (1, 0, 1, 1.0, 30, 0.0, 25, 0.1, 1),
    (1, 0, 16, 0.0, 4, 1.0, 3, 1.0, 1), (1, 0, 4, 0.0, 6, 1.0, 5, 0.0, 1), (1, 0, 7, 0.0, 5, 0.0, 6, 1.0, 1),
    (1, 0, 20, 0.0, 6, 1.0, 0, 0.0, 1), (1, 0, 2, 0.0, 30, 0.7, 0, 0.0, 1), (1, 0, 60, 0.1, 4, 1.0, 0, 0.0, 1),
    (1, 0, 6, 1.0, 40, 0.0, 0, 0.0, 1), (1, 0, 8, 0.6, 10, 0.0, 5, 0.0, 1), (1, 0, 2, 1.0, 1, 0.0, 3, 0.0, 1),
    (1, 0, 9, 0.8, 0, 0.0, 7, 0.0, 1), (1, 0, 30, 0.5, 20, 0.0, 12, 0.1, 1), (1, 0, 14, 0.7, 3, 0.2, 0, 0.0, 1),
    (1, 0, 3, 0.0, 40, 0.0, 6, 1.0, 1), (1, 0, 2, 0.0, 0, 0.0, 5, 1.0, 1), (1, 0, 5, 0.2, 5, 0.8, 9, 0.9, 1),
    (1, 0, 1, 0.0, 9, 0.0, 3, 0.6, 1), (1, 0, 4, 0.0, 2, 1.0, 1, 1.0, 1), (1, 0, 6, 0.1, 20, 0.9, 8, 0.5, 1),
    # runs of links inside an article are its references
    (1, 0, 4, 1.0, 5, 1.0, 4, 1.0, 1), (1, 0, 6, 1.0, 3, 1.0, 8, 1.0, 1), (1, 0, 2, 1.0, 2, 1.0, 3, 1.0, 1),
    # advertisements, notices, forms and comments inside an article
    (1, 1, 12, 0.0, 60, 0.0, 70, 0.0, 0), (1, 1, 40, 0.0, 30, 0.0, 35, 0.0, 0), (1, 1, 3, 1.0, 50, 0.0, 20, 0.0, 0),
    (1, 2, 25, 0.1, 20, 0.0, 18, 0.0, 0), (1, 1, 90, 0.0, 5, 0.0, 80, 0.0, 0), (1, 3, 2, 0.0, 4, 0.0, 1, 0.0, 0),
    # menus, headers, footers, sidebars outside
    (0, 1, 1, 1.0, 0, 0.0, 1, 1.0, 0), (0, 1, 1, 1.0, 1, 1.0, 1, 1.0, 0), (0, 1, 14, 0.0, 1, 1.0, 10, 0.0, 0),
    (0, 1, 60, 0.0, 3, 0.0, 50, 0.0, 0), (0, 2, 30, 0.5, 4, 1.0, 6, 1.0, 0), (0, 1, 150, 0.1, 40, 0.0, 30, 0.0, 0),
    (0, 2, 8, 0.0, 90, 0.0, 0, 0.0, 0), (0, 1, 5, 0.0, 120, 0.0, 3, 0.0, 0),
    # pages that mark neither main text nor furniture
    (0, 0, 60, 0.0, 10, 0.0, 55, 0.0, 1), (0, 0, 25, 0.1, 30, 0.0, 28, 0.0, 1), (0, 0, 90, 0.05, 2, 1.0, 1, 1.0, 1),
    (0, 0, 18, 0.0, 40, 0.0, 35, 0.0, 1), (0, 0, 8, 0.0, 50, 0.0, 45, 0.0, 1), (0, 0, 3, 0.0, 60, 0.0, 40, 0.0, 1),
    (0, 0, 6, 0.0, 1, 1.0, 70, 0.0, 1), (0, 0, 40, 0.2, 70, 0.0, 5, 1.0, 1), (0, 0, 5, 0.0, 0, 0.0, 60, 0.0, 1),
    (0, 0, 40, 0.0, 2, 1.0, 30, 0.0, 1), (0, 0, 70, 0.0, 3, 1.0, 60, 0.0, 1), (0, 0, 25, 0.0, 2, 1.0, 20, 0.0, 1),
    (0, 0, 100, 0.0, 8, 1.0, 90, 0.1, 1), (0, 0, 16, 0.0, 4, 1.0, 40, 0.0, 1), (0, 0, 50, 0.1, 1, 1.0, 15, 0.0, 1),
    (0, 0, 2, 0.0, 0, 0.0, 0, 0.0, 1), (0, 0, 5, 0.0, 0, 0.0, 0, 0.0, 1), (0, 0, 1, 0.0, 0, 0.0, 0, 0.0, 1),
    (0, 0, 14, 0.0, 22, 0.0, 2, 1.0, 1), (0, 0, 10, 0.0, 0, 0.0, 0, 0.0, 1), (0, 0, 30, 0.0, 0, 0.0, 0, 0.0, 1),
    (0, 0, 2, 1.0, 2, 1.0, 2, 1.0, 0), (0, 0, 1, 1.0, 0, 0.0, 3, 1.0, 0), (0, 0, 12, 0.9, 8, 0.8, 15, 0.7, 0),
    (0, 0, 30, 0.8, 20, 0.6, 25, 0.9, 0), (0, 0, 4, 0.0, 3, 1.0, 2, 1.0, 0), (0, 0, 6, 0.5, 40, 0.0, 2, 1.0, 0),
    (0, 0, 2, 1.0, 0, 0.0, 40, 0.0, 0), (0, 0, 1, 1.0, 70, 0.0, 0, 0.0, 0), (0, 0, 8, 1.0, 30, 0.0, 60, 0.0, 0),
    (0, 0, 3, 1.0, 0, 0.0, 90, 0.0, 0), (0, 0, 4, 1.0, 55, 0.0, 30, 0.0, 0), (0, 0, 15, 0.9, 90, 0.0, 80, 0.0, 0),
    (0, 0, 5, 1.0, 80, 0.0, 4, 1.0, 0), (0, 0, 3, 0.6, 2, 1.0, 4, 0.5, 0), (0, 0, 7, 0.0, 2, 1.0, 0, 0.0, 0),
]
DEPTH = 8

# Element names of HTML, and words that roles, classes and ids use for page furniture.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = "script|style|noscript|template|svg|iframe|object|canvas|textarea|select|title"
FURNITURE = frozenset("nav footer aside form button dialog menu fieldset head".split())
MAIN = frozenset("article main".split())
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adbox banner sponsor sponsored promo cookie cookies consent gdpr popup "
    "overlay sidebar widget widgets related recommended recommendations nav navbar navigation menubar breadcrumb breadcrumbs "
    "masthead footer comment comments commentlist disqus newsletter subscribe subscription signup searchbox toolbar "
    "pagination pager complementary contentinfo outbrain taboola".split()
)
#: These also begin names of an article's own parts (a history of law, a notice period); they count at the end of a name.
ENDING_WORDS = frozenset(
    "promotion notice notices alert modal rail share sharing social menu reply replies respond login search copyright legal".split()
)
TOP_WORDS = frozenset("header topbar head banner".split())
MAIN_WORDS = frozenset("article content main post entry story".split())

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({UNSEEN})\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[/!?a-zA-Z][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.IGNORECASE)
_NAME_PARTS = re.compile(r"[a-z]+")
_NAME_END = re.compile(r"([a-z]+)[^a-z\s]*(?:\s|\Z)")


def _enclosing(tag: str, attributes: str, in_main: int) -> tuple[int, int]:
    """What an element adds: (main, furniture)."""
    names, ends, hidden = set(), set(), False
    if attributes.strip():
        for key, *values in _ATTRIBUTE.findall(attributes):
            value, key = "".join(values).lower(), key.lower()
            if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and "display:none" in value.replace(" ", ""):
                hidden = True
            elif key in ("class", "id", "role"):
                names.update(_NAME_PARTS.findall(value))
                ends.update(_NAME_END.findall(value))
    if hidden:
        return 0, 1
    if tag in ("html", "body"):
        return 0, 0
    if tag in MAIN:
        return 1, 0 if tag == "main" else int(bool(names & {"comment", "comments", "reply", "ad", "ads", "sponsored"}))
    furniture = tag in FURNITURE or bool(names & FURNITURE_WORDS or ends & ENDING_WORDS) or not in_main and (tag == "header" or bool(names & TOP_WORDS))
    return (0 if furniture else int(bool(names & MAIN_WORDS)), int(furniture))


def blocks(page: str) -> list[tuple[str, int, int, int, int]]:
    """(text, words, words in links, main depth, furniture depth) of every block with text, in page order."""
    out: list[tuple[str, int, int, int, int]] = []
    # open elements: name, what they add, and how many of them there are up to the innermost one that is not inline
    stack: list[tuple[str, int, int, int]] = []
    places: dict[str, list[int]] = {}  # of each open name, so that no end tag searches the open elements
    pieces: list[str] = []
    linked: list[str] = []
    main = furniture = link = 0

    def text(raw: str) -> None:
        if raw:
            pieces.append(raw)
            if link:
                linked.append(raw)

    def flush() -> None:
        if pieces:
            words = html.unescape("".join(pieces)).split()
            if words:
                inside = len(html.unescape(" ".join(linked)).split()) if linked else 0
                out.append((" ".join(words), len(words), min(inside, len(words)), main, furniture))
            pieces.clear()
            linked.clear()

    def close(depth: int) -> None:
        nonlocal main, furniture, link
        if any(f and tag in INLINE for tag, _, f, _ in stack[depth:]):
            flush()  # an inline piece of furniture ends inside a block
        for tag, m, f, _ in stack[depth:]:
            main, furniture, link = main - m, furniture - f, link - (tag == "a")
            places[tag].pop()
        del stack[depth:]

    at = 0
    for token in _TOKEN.finditer(page):
        text(page[at : token.start()])
        at, tag = token.end(), (token[3] or "").lower()
        if not tag:
            continue
        if tag == "br":
            text(" ")
            continue
        if tag in VOID:
            if tag not in ("wbr", "img"):
                flush()
            continue
        inline = tag in INLINE
        if not inline:
            flush()
        base = stack[-1][3] if stack else 0
        if token[2]:
            if places.get(tag) and places[tag][-1] >= (base if inline else base - 1 if tag == "p" else 0):
                close(places[tag][-1])
            continue
        if token[4].endswith("/") and not inline:
            continue
        if not inline:
            same = tag if tag in ("li", "dt", "dd", "td", "th", "tr", "option") else "p"
            if base and stack[base - 1][0] in ("p", same):
                close(base - 1)
        m, f = _enclosing(tag, token[4], main)
        if tag == "a" and places.get("a") and places["a"][-1] >= base:
            close(places["a"][-1])
        if inline and f:
            flush()
        if not inline or m or f or tag == "a":
            places.setdefault(tag, []).append(len(stack))
            stack.append((tag, m, f, (stack[-1][3] if stack else 0) if inline else len(stack) + 1))
            main, furniture, link = main + m, furniture + f, link + (tag == "a")
    text(page[at:])
    flush()
    return out


def rows(found: list[tuple[str, int, int, int, int]]) -> list[tuple]:
    words = [b[1] for b in found]
    links = [b[2] / b[1] for b in found]
    return [
        (
            min(b[3], 1), b[4], b[1], links[k], words[k - 1] if k else 0, links[k - 1] if k else 0.0,
            words[k + 1] if k + 1 < len(found) else 0, links[k + 1] if k + 1 < len(found) else 0.0,
        )
        for k, b in enumerate(found)
    ]


def grow(table: np.ndarray, labels: np.ndarray, depth: int = DEPTH):
    """A tree as nested (feature, threshold, low branch, high branch), leaves the commoner label; least Gini impurity."""
    if depth == 0 or labels.min() == labels.max():
        return int(labels.mean() >= 0.5)
    best = None
    for feature in range(table.shape[1]):
        values = np.unique(table[:, feature])
        for cut in (values[1:] + values[:-1]) / 2:
            low = table[:, feature] <= cut
            impurity = sum(len(x) * x.mean() * (1 - x.mean()) for x in (labels[low], labels[~low]))
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, feature, float(cut))
    if best is None:
        return int(labels.mean() >= 0.5)
    _, feature, cut = best
    low = table[:, feature] <= cut
    return feature, cut, grow(table[low], labels[low], depth - 1), grow(table[~low], labels[~low], depth - 1)


def classify(tree, table: np.ndarray) -> np.ndarray:
    """Which rows the tree takes for main text."""
    if isinstance(tree, int):
        return np.full(len(table), tree == 1)
    feature, cut, low_branch, high_branch = tree
    low, out = table[:, feature] <= cut, np.zeros(len(table), bool)
    out[low], out[~low] = classify(low_branch, table[low]), classify(high_branch, table[~low])
    return out


def trained():
    table = np.array(TRAINING, float)
    return grow(table[:, :-1], table[:, -1])


def main_texts(pages: list[str], tree) -> list[str]:
    found = [blocks(page) for page in pages]
    table = np.array([r for b in found for r in rows(b)], float).reshape(-1, len(FEATURES))
    kept = iter(classify(tree, table).tolist())
    return [" ".join(b[0] for b in page if next(kept)) for page in found]


def extract(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The ``keep`` columns of every row, with text (blocks of main text joined by one space) and n_chars (code points).

    Null or empty pages, and pages without main text, have an empty text and 0. Unclosed and stray tags, comments and
    scripts are borne; a page cut off inside a tag loses only that tag. A very long page is read in one pass, in time that
    grows with its length however its tags nest. Repeated rows each have their own result. Other columns are not read.
    """
    tree = trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_page"):
                texts = main_texts(text_column(batch, "_page").to_pylist(), tree)
                counts = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays(batch.columns[:-1] + [pa.array(texts, pa.string()), counts], names=[*batch.schema.names[:-1], "text", "n_chars"])

    picked = pages.select(*keep, F.col(html_col).cast("string").alias("_page"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])
    return picked.mapInArrow(run, f"{kept}, text string, n_chars long")
