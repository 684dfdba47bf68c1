"""Main text of web pages: the contiguous region of the highest score."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names of HTML and usual names for parts of a page that are not its article.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main "
    "menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr "
    "ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript script style svg template textarea title".split())
ASIDE = frozenset("aside button datalist dialog footer form head menu nav select".split())
ASIDE_NAMES = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies disqus footer gdpr masthead menu modal nav navbar navigation "
    "newsletter notice notices popup promo promoted promotion related replies reply share "
    "sharing sidebar social sponsor sponsored subscribe toolbar widget widgets".split()
)
ASIDE_ROLES = frozenset("alert banner complementary contentinfo dialog form menu navigation search".split())
CLOSED_BY_SAME = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th",
                  "th": "td th", "option": "option"}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)"
    r"(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<",
    re.S,
)
_NAMES = re.compile(r"(?:^|[\s\"'])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PART = re.compile(r"[^a-z]+")

#: Scores of what no labelled page has shown.
WORD, TAG = 1.0, -0.5


@dataclass
class Token:
    """A tag, or the words between two tags. ``kind`` is what its score is learned for."""

    kind: str
    words: int = 0
    text: str = ""
    block: bool = False
    inside: bool = False
    off: bool = False


@dataclass
class Weights:
    words: dict[str, float] = field(default_factory=dict)
    tags: dict[str, float] = field(default_factory=dict)

    def of(self, token: Token) -> float:
        """Words score positive and tags negative, unless learned otherwise; asides score 0."""
        if token.off:
            return 0.0
        if token.words:
            return self.words.get(token.kind, WORD)
        return min(self.tags.get(token.kind, TAG), -0.05)


@dataclass
class Element:
    """An element and the tokens from its start tag to the one behind its end tag."""

    tag: str
    rest: str
    start: int
    in_article: bool
    end: int = 0


def _called(rest: str) -> tuple[bool, bool]:
    """Whether a class, the id or the role of an element is a name of asides, and whether a part
    of one is, as in "right-sidebar" or "comments-open"."""
    whole = part = False
    for name, *value in _NAMES.findall(rest):
        for word in "".join(value).lower().split():
            if name.lower() == "role":
                whole = whole or word in ASIDE_ROLES
            elif word in ASIDE_NAMES:
                whole = True
            elif ASIDE_NAMES & set(_PART.split(word)):
                part = True
    return whole, part


def _asides(elements: list[Element], words: np.ndarray) -> list[Element]:
    """The elements that are no part of the article. ``words``: their number before each token.

    The page, its body and a ``<main>`` are never asides, nor is what holds a ``<main>`` or the
    article that has the most words. A name of asides counts for any other element, the part of
    one only for an element that has less than half of the page's words: else it is a container,
    named after something it holds. A form that has half of them is one, too.
    """

    def size(e: Element) -> int:
        return words[e.end] - words[e.start]

    total = words[-1]
    articles = [e for e in elements if e.tag == "article" and not _called(e.rest)[0]]
    heart = [e for e in elements if e.tag == "main"]
    heart += [max(articles, key=size)] if articles else []
    found = []
    for e in elements:
        if e.tag in ("html", "body", "main") or any(
            e.start <= h.start and h.end <= e.end for h in heart
        ):
            continue
        whole, part = _called(e.rest)
        most = 2 * size(e) >= total
        if whole or (part and not most and e.tag != "article"):
            found.append(e)
        elif e.tag == "form" and most:
            continue
        elif e.tag in ASIDE or (e.tag == "header" and not e.in_article):
            found.append(e)
    return found


def parse(page: str | None) -> tuple[list[Token], list[Element]]:
    """Tags and words in page order, and the elements. Scripts, styles, comments and declarations
    are left out."""
    if not page:
        return [], []
    out: list[Token] = []
    near: list[str] = []
    elements: list[Element] = []
    stack: list[Element] = []
    at, end = 0, len(page)

    def close(keep: int) -> None:
        for e in stack[keep:]:
            e.end = len(out)
        del stack[keep:]

    def put(token: Token) -> None:
        out.append(token)
        near.append(next((e.tag for e in reversed(stack) if e.tag in BLOCKS), ""))

    while at < end:
        m = _TOKEN.match(page, at)
        at = m.end()
        tag = m.group("tag")
        if tag is None:
            text = m.group()
            if text[0] == "<" and len(text) > 1:
                continue
            put(Token("+", len(text.split()), text))
            continue
        tag = tag.lower()
        if m.group("end"):
            put(Token("/" + tag, block=tag in BLOCKS))
            of_tag = [i for i, e in enumerate(stack) if e.tag == tag]
            if of_tag:
                close(of_tag[-1])
            continue
        rest = m.group("rest")
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = stop.end() if stop else end
            continue
        closes = CLOSED_BY_SAME.get(tag, "").split() + (["p"] if tag in BLOCKS else [])
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].tag in closes:
                close(i)
                break
            if stack[i].tag in BLOCKS:
                break
        if tag == "br":
            put(Token("+br", 0, " "))
            continue
        if tag not in VOID and not rest.endswith("/"):
            inside = any(e.tag in ("article", "main") for e in stack)
            stack.append(Element(tag, rest, len(out), inside))
            elements.append(stack[-1])
        put(Token(tag, block=tag in BLOCKS))
    close(0)
    words = np.concatenate([[0], np.cumsum([t.words for t in out], dtype=np.int64)])
    off, inside = (np.zeros(len(out) + 1, np.int64) for _ in range(2))
    asides = _asides(elements, words)
    for marks, some in ((off, asides), (inside, [e for e in elements if e.tag in ("article", "main")])):
        for e in some:
            marks[e.start] += 1
            marks[e.end] -= 1
    for t, block, is_off, is_in in zip(out, near, np.cumsum(off) > 0, np.cumsum(inside) > 0):
        t.off, t.inside = bool(is_off), bool(is_in and not is_off)
        if t.text:
            t.kind = ("-" if is_off else "+") + (block if t.kind == "+" else "br")
        elif is_off and t.kind[0] != "/":
            t.kind = "-" + t.kind
    return out, elements


def tokens(page: str | None) -> list[Token]:
    return parse(page)[0]


def best_region(scores: np.ndarray) -> tuple[int, int] | None:
    """First and last of the contiguous scores with the greatest sum, the longest of equals and
    then the first; None if no sum is above 0."""
    if not len(scores):
        return None
    sums = np.round(np.concatenate([[0.0], np.cumsum(scores)]), 6)  # equal sums shall be equal
    low = np.minimum.accumulate(sums[:-1])
    gains = sums[1:] - low
    best = gains.max()
    if best <= 0:
        return None
    values, places = np.unique(sums, return_index=True)
    lasts = np.flatnonzero(np.round(gains - best, 6) >= 0)
    firsts = places[np.searchsorted(values, low[lasts])]
    k = int(np.argmax(lasts - firsts))
    return int(firsts[k]), int(lasts[k])


def _extended(
    found: list[Token], elements: list[Element], first: int, last: int
) -> tuple[int, int]:
    """The region with what belongs to it by the page's structure: all of the ``<article>`` or
    ``<main>`` that it lies in; else paragraphs and headings next to it in the smallest element that
    holds it, up to the nearest aside or other block."""
    around = [e for e in elements if e.start <= first and last < e.end]
    marked = [e for e in around if e.tag in ("article", "main") and not found[e.start].off]
    if marked:
        inner = marked[-1]
        return inner.start, inner.end - 1
    parent = around[-1] if around else Element("", "", 0, False, len(found))
    children, reach = [], parent.start + 1
    for e in elements:
        if e.start >= reach and parent.start < e.start and e.end <= parent.end:
            children.append(e)
            reach = e.end
    plain = {"p", "figure", "blockquote", *(f"h{i}" for i in range(1, 7))}
    while True:
        before = [e for e in children if e.end <= first]
        if not before or before[-1].tag not in plain or found[before[-1].start].off:
            break
        first = before[-1].start
    while True:
        after = [e for e in children if e.start > last]
        if not after or after[0].tag not in plain or found[after[0].start].off:
            break
        last = after[0].end - 1
    return first, last


def main_text(page: str | None, weights: Weights) -> str:
    """Blocks of the best region, joined by an empty line; empty if no region scores above 0.

    The region grows to the article that holds it, so that short leads and endings stay. Asides,
    forms and the like inside it are left out of the text and score nothing; all else inside it is
    text, whatever the score of its kind.
    """
    found, elements = parse(page)
    scores = [weights.of(t) * max(t.words, 1) if t.words or not t.text else 0.0 for t in found]
    region = best_region(np.array(scores))
    if region is None:
        return ""
    first, last = _extended(found, elements, *region)
    blocks, now = [], []
    for t in found[first : last + 1]:
        if t.block:
            blocks.append("".join(now))
            now = []
        elif t.text and not t.off:
            now.append(t.text)
    blocks.append("".join(now))
    blocks = [" ".join(html.unescape(b).split()) for b in blocks]
    return "\n\n".join(b for b in blocks if b)


def fit(
    pages: DataFrame, sample: int = 2000, smoothing: float = 5.0, html_col: str = "html"
) -> Weights:
    """Weights from at most about ``sample`` labelled pages, chosen by a hash of the row.

    A page that marks its article (``<article>`` or ``<main>``) labels its own words and tags,
    those of asides, forms and the like within it as outside: a kind's weight is the smoothed log odds of lying inside, within -1 and 1 for words and -1 and
    -0.05 for tags. Spark counts kinds; the number of kinds is bounded by that of element names
    times two. Without labelled pages the weights are those of unknown kinds.
    """
    marked = pages.filter(F.lower(F.col(html_col)).rlike("<(article|main)[\\s>]"))
    total = marked.count()
    if not total:
        return Weights()
    steps = 1 << 30
    few = marked.filter(
        F.pmod(F.xxhash64(*map(F.col, pages.columns)), F.lit(steps))
        < int(min(1.0, sample / total) * steps)
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, bool], list[int]] = {}
        for batch in batches:
            for page in batch.column(0).to_pylist():
                for t in tokens(page):
                    if t.words or not t.text:
                        kind = t.kind.lstrip("-+/") in BLOCKS | ASIDE | VOID or t.words
                        key = (t.kind if kind else "?", t.words > 0)
                        n = sums.setdefault(key, [0, 0])
                        n[t.inside] += max(t.words, 1)
        rows = [(k, w, *n) for (k, w), n in sums.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate(
                (pa.string(), pa.bool_(), pa.int64(), pa.int64()))],
            ["kind", "is_word", "outside", "inside"],
        )

    counted = (
        few.select(F.col(html_col).cast("string"))
        .mapInArrow(count, "kind string, is_word boolean, outside long, inside long")
        .groupBy("kind", "is_word").agg(F.sum("outside").alias("o"), F.sum("inside").alias("i"))
        .collect()
    )
    weights = Weights()
    for is_word, into in ((True, weights.words), (False, weights.tags)):
        rows = [r for r in counted if r.is_word == is_word]
        n_in, n_out = sum(r.i for r in rows), sum(r.o for r in rows)
        for r in rows:
            odds = np.log((r.i + smoothing) / (n_in + smoothing)) - np.log(
                (r.o + smoothing) / (n_out + smoothing))
            into[r.kind] = float(np.clip(odds, -1, 1 if is_word else -0.05))
    return weights


def extract(
    pages: DataFrame, weights: Weights, id_col: str = "page_id", url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every row.

    Null, empty and text-free pages have an empty text. Character references are decoded once,
    unfinished tags, comments and elements end with the page. Null and repeated ids are returned
    as they are; other columns are ignored.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p, weights) for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select(
        F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.col(html_col).cast("string")
    ).mapInArrow(read, "page_id long, url string, text string, n_chars long")
