"""Main text of web pages by the maximum-scoring subsequence.

A page is read as a sequence of words and tags.  Words score by the elements
they stand in, tags score below zero, and one scan (the running best sum) finds the
contiguous part of highest total.  Weights are log odds counted on pages that
mark their content with ``<article>`` or ``<main>``, on top of fixed ones for
elements and class names that by convention hold no content.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bound of the sample that weights are counted on.
SAMPLE_PAGES = 2_000

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg canvas object textarea select title annotation".split())
INLINE = frozenset(("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                    "small span strike strong sub sup time tt u var wbr "
                    "math semantics mrow mi mn mo ms mtext mspace mfrac msqrt mroot msub msup msubsup munder mover munderover mstyle").split())
PROSE = INLINE | frozenset("p h1 h2 h3 h4 h5 h6 br blockquote pre figcaption".split())
CLOSED_BY_SAME = frozenset("p li dt dd tr td th option".split())
CONTENT = frozenset(("article", "main"))
PLAIN = frozenset(("html", "body"))
# Elements and words of class, id or role that mark other than content.
ASIDE_TAGS = frozenset("nav footer aside form button dialog menu head".split())
ASIDE_WORDS = frozenset((
    "ad ads adv advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer disqus "
    "footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted "
    "related replies reply respond share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget").split())

# Words before a colon or hyphen that turn the rest round or belong to
# content, and words behind one that name a part of the page.
TURNING_WORDS = frozenset("no not non without with has have is hide hides show shows enable disable".split())
CONTENT_WORDS = frozenset("article content entry post story".split())
PART_WORDS = frozenset((
    "area bar block body bottom box buttons card cell col column container content form frame group holder icons inner item items "
    "layer left links list outer overlay panel popup posts region right rail row section slot stories top unit wrap wrapper zone").split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PART = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")
CONTENT_SIDE, ASIDE, OUTER_HEADER = range(3)


@dataclass
class Weights:
    """Log odds by element key (``name`` or ``.word`` of a class) for words, and by name for tags."""

    words: dict[str, float] = field(default_factory=dict)
    tags: dict[str, float] = field(default_factory=dict)
    word: float = 1.0
    tag: float = -1.0
    prose_tag: float = -0.25

    def of_tag(self, name: str) -> float:
        return self.tags.get(name, self.prose_tag if name in PROSE else self.tag)


def named(name: str) -> int:
    """What one name of a class, id or role says: ``ASIDE``, ``OUTER_HEADER`` (aside unless within content) or neither.

    A name of several words counts by its last one (``site-footer``), or by its
    first if the last one names a part of a page (``related-posts``); one that
    turns the meaning round (``no-comments``, ``has-sidebar``) does not count.
    """
    parts = [w.lower() for w in _PART.split(name) if w]
    if not parts or (len(parts) > 1 and not TURNING_WORDS.isdisjoint(parts)):
        return CONTENT_SIDE
    if "".join(parts) in ASIDE_WORDS:
        word = "".join(parts)
    elif parts[-1] in ASIDE_WORDS:
        word = parts[-1]
    elif parts[0] in ASIDE_WORDS and parts[-1] in PART_WORDS:
        word = parts[0]
    else:
        return CONTENT_SIDE
    if word in ("header", "masthead"):
        return CONTENT_SIDE if parts[0] in CONTENT_WORDS else OUTER_HEADER
    return ASIDE


class Element:
    """An open element: its keys, what it stands for, and how many words it holds."""

    __slots__ = ("name", "keys", "stands", "above", "n_words", "holds")

    def __init__(self, name: str, attributes: str, above: tuple[Element, ...]):
        self.name, self.above, self.n_words, self.holds = name, above, 0, False
        # Names of the whole page say nothing of its parts.
        names = [] if name in PLAIN else [w for a in _ATTRIBUTE.finditer(attributes) for w in (a[2] or a[3] or a[4] or "").split()]
        self.keys = (name, *["." + w.lower() for w in names])
        if name in CONTENT:
            # Marked as content, unless its whole name says otherwise.
            self.stands = ASIDE if any(w.lower() in ASIDE_WORDS for w in names) else CONTENT_SIDE
        elif name in ASIDE_TAGS:
            self.stands = ASIDE
        else:
            found = {named(w) for w in names}
            self.stands = ASIDE if ASIDE in found else OUTER_HEADER if OUTER_HEADER in found or name == "header" else CONTENT_SIDE


Open = tuple[Element, ...]


def tokens(page: str) -> list[tuple[str, str, Open, bool]]:
    """(kind, text or tag name, the open elements, whether a block ends here) in page order.

    Scripts, styles, comments and other raw parts are passed over.  An element
    that holds the longest ``<article>`` or ``<main>`` stands for no aside, nor
    does, on a page without these, a form that holds most of its words.
    """
    out: list[tuple[str, str, Open, bool]] = []
    stack: list[Element] = []
    wide: list[Element] = []
    at, opened, total = 0, (), 0

    def text(end: int) -> None:
        nonlocal total
        n = len(page[at:end].split())
        total += n
        for e in wide:
            e.n_words += n
        out.append(("text", page[at:end], opened, False))

    marked_elements: list[Element] = []
    forms: list[Element] = []
    while True:
        found = _TOKEN.search(page, at)
        if found is None:
            if at < len(page):
                text(len(page))
            break
        if found.start() > at:
            text(found.start())
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if name in RAW:
            if not found[1]:
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if found[1]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth].name == name:
                    del stack[depth:]
                    break
        else:
            if name in CLOSED_BY_SAME:
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth].name == name:
                        del stack[depth:]
                        break
                    if stack[depth].name not in INLINE and stack[depth].name not in CLOSED_BY_SAME:
                        break
            if name not in VOID and not (found[3] or "").rstrip().endswith("/"):
                element = Element(name, found[3] or "", tuple(stack) if name in CONTENT else ())
                stack.append(element)
                if name in CONTENT and element.stands == CONTENT_SIDE:
                    marked_elements.append(element)
                elif name == "form":
                    forms.append(element)
        opened = tuple(stack)
        wide = [e for e in opened if e.name in CONTENT or e.name == "form"]
        out.append(("tag", name, opened, name not in INLINE))
    for name in CONTENT:
        longest = max((e for e in marked_elements if e.name == name), key=lambda e: e.n_words, default=None)
        for e in longest.above if longest else ():
            e.holds = True
    for e in forms if not marked_elements else ():
        e.holds = 2 * e.n_words > total
    return out


def marked(opened: Open) -> bool:
    """True inside an element that marks content."""
    return any(e.name in CONTENT and e.stands == CONTENT_SIDE for e in opened)


def aside(opened: Open) -> bool:
    """True if one of the open elements holds other than content by convention."""
    inside = False
    for e in opened:
        if e.stands == ASIDE and not e.holds or e.stands == OUTER_HEADER and not e.holds and not inside and not marked(opened):
            return True
        inside = inside or e.name in CONTENT
    return False


def _keys(opened: Open) -> tuple[str, ...]:
    return tuple(dict.fromkeys(k for e in opened for k in e.keys))


def count_page(page: str, inner: Counter, outer: Counter) -> None:
    """Add the words and tags of a page that marks its content, by element key, to the counters."""
    seen = tokens(page)
    if not any(marked(opened) for _, _, opened, _ in seen):
        return
    for kind, value, opened, _ in seen:
        side = inner if marked(opened) and not aside(opened) else outer
        n = len(value.split()) if kind == "text" else 1
        side[kind, ""] += n
        for k in (_keys(opened) if kind == "text" else (value,)):
            if k not in PLAIN:
                side[kind, k] += n


def weights_of(inner: Counter, outer: Counter) -> Weights:
    """Log odds between content and the rest; tags are held below zero."""
    def odds(kind: str, key: str) -> float:
        a = (inner[kind, key] + 0.5) / (inner[kind, ""] + 1)
        b = (outer[kind, key] + 0.5) / (outer[kind, ""] + 1)
        return max(-6.0, min(6.0, math.log(a / b)))

    out = Weights()
    for kind, key in sorted(set(inner) | set(outer)):
        if key and kind == "text":
            out.words[key] = odds(kind, key)
        elif key:
            out.tags[key] = min(-0.1, odds(kind, key) - 1.0)
    return out


def scores(seen: list[tuple[str, str, Open, bool]], weights: Weights) -> tuple[list[float], list[bool]]:
    """The score of every token, and whether it stands aside.

    What stands aside is cut out of the span later, so it neither ends nor
    lengthens it; nor do tags within marked content.  If the marked content
    holds most of the other words, words outside of it count against.
    """
    # Tokens between two tags share their open elements.
    known: dict[int, tuple[bool, bool, float]] = {}
    for kind, _, opened, _ in seen:
        if kind == "text" and id(opened) not in known:
            rate = weights.word + sum(weights.words.get(k, 0.0) for k in _keys(opened)) / 4
            known[id(opened)] = aside(opened), marked(opened), max(-3.0, min(3.0, rate))
    counts = [len(value.split()) if kind == "text" else 0 for kind, value, _, _ in seen]
    words = {True: 0, False: 0}
    for (kind, _, opened, _), n in zip(seen, counts):
        if kind == "text" and not known[id(opened)][0]:
            words[known[id(opened)][1]] += n
    trusted = words[True] > 0 and words[True] >= words[False]
    out, beside = [], []
    for (kind, value, opened, _), n in zip(seen, counts):
        if kind == "text":
            is_aside, is_marked, rate = known[id(opened)]
            if is_marked:
                rate = max(0.5, rate)
            elif trusted:
                rate = min(-0.5, rate)
            out.append(0.0 if is_aside else n * rate)
        else:
            is_aside = False
            free = marked(opened) or aside(opened)
            out.append(0.0 if free else weights.of_tag(value))
        beside.append(is_aside)
    return out, beside


def best_span(scores: list[float]) -> tuple[int, int]:
    """First and end position of the part with the highest sum; of equal ones the first; (0, 0) if none is above zero."""
    best, span, total, start = 0.0, (0, 0), 0.0, 0
    for k, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, k
        total += s
        if total > best:
            best, span = total, (start, k + 1)
    return span


def extract(page: str, weights: Weights) -> str:
    """The main text: blocks of the best part in page order, one space between."""
    seen = tokens(page)
    of, beside = scores(seen, weights)
    start, end = best_span(of)
    blocks, current = [], []
    for (kind, value, _, ends), cut in zip(seen[start:end], beside[start:end]):
        if kind == "tag":
            if ends or value == "br":
                blocks.append("".join(current))
                current = []
        elif not cut:
            current.append(value)
    blocks.append("".join(current))
    return " ".join(t for t in (" ".join(entities.unescape(b).split()) for b in blocks) if t)


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> Weights:
    """Weights from at most ``sample_pages`` pages, those of smallest hash, that mark their content."""
    labelled = pages.where(F.col("html").rlike(r"(?i)<(article|main)[\s>]") & F.col("page_id").isNotNull())
    ids = labelled.select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(sample_pages).distinct()
    # The side is bounded by the sample's size.
    sample = labelled.join(F.broadcast(ids), "page_id", "left_semi").select("html")

    def run(batches):
        inner, outer = Counter(), Counter()
        for batch in batches:
            for page in batch.column("html").to_pylist():
                count_page(page, inner, outer)
        rows = [(kind, key, inner[kind, key], outer[kind, key]) for kind, key in sorted(set(inner) | set(outer))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.int64()))],
            ["kind", "key", "inner_n", "outer_n"])

    counts = (sample.mapInArrow(run, "kind string, key string, inner_n bigint, outer_n bigint")
              .groupBy("kind", "key").agg(F.sum("inner_n").alias("inner_n"), F.sum("outer_n").alias("outer_n")).collect())
    if not counts:
        return Weights()
    return weights_of(Counter({(r.kind, r.key): r.inner_n for r in counts}), Counter({(r.kind, r.key): r.outer_n for r in counts}))


def main_text(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every row of ``pages``; no shuffle of pages.

    A page is read whole, however long it is; one page is held at a time.

    A NULL or empty page, and one without words of positive score, has an empty text.  Equal
    rows get equal results, one each; other columns are ignored; an empty table
    gives no row.  Markup cut off at the end of a page is passed over.
    """
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    weights = fit(rows, sample_pages)

    def run(batches):
        for batch in batches:
            texts = [extract(page or "", weights) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
