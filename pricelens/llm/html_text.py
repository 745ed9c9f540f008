"""The main text of web pages as a maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive where they stand in
what looks like an article, tags score negative, and one linear scan finds the
contiguous region with the largest sum; its blocks are the text. The weights
come from labelled pages:

* a word's score is the log-odds, by logistic regression, that words in its
  surroundings (enclosing elements, their class, id and role words, links, block
  length) belong to the main text; where the odds are against it, it scores 0
  and is left out even inside the region (a menu, an advert, a form);
* a tag's score is a quarter of the log-odds that such a tag lies in the main text,
  between -1.5 and -0.01. Tags below an element that is rejected already cost
  nothing more, so a long menu inside an article does not cut it in two.

Each row is worked on by itself in one pass over its html, in time linear in its
length; there is no shuffle, and no size limit.
"""

from __future__ import annotations

import html as H
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled pages that weights are learnt from at most; they are read by the driver.
MAX_PAGES = 2000

# FIXED VALUES of HTML: elements that start a block, that hold no text of the page, that have no end tag,
# and that a new block or item of the same kind ends.
BLOCKS = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav noscript ol optgroup option p pre search section select summary table tbody td
    template textarea tfoot th thead title tr ul""".split())
SILENT = ("script", "style", "template", "iframe", "svg", "math", "object", "canvas", "audio", "video", "noembed", "noframes", "textarea", "title", "xmp")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
#: Elements that an end tag or an item inside them does not reach beyond.
SCOPES = frozenset("html body article aside div main nav section table td th ul ol dl form header footer select".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_NAME_WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for name in SILENT}


@dataclass
class Block:
    text: str
    marks: frozenset[str]      # what surrounds the words
    linked: bool
    words: int

    def features(self) -> Iterable[str]:
        yield from self.marks
        n = self.words
        yield "short" if n < 3 else "middling" if n < 12 else "long" if n < 40 else "very long"
        if self.linked:
            yield "all linked"


@dataclass
class Tag:
    name: str                  # with a leading slash where it ends an element
    marks: frozenset[str]
    parent: frozenset[str]     # what surrounds the element itself


@dataclass
class _Open:
    name: str
    marks: frozenset[str]


def _named(name: str, attributes: str) -> set[str]:
    """Marks of an element: its name, and the words of its class, id and role."""
    out = {name}
    if attributes and name not in ("html", "body"):  # those describe the site
        for m in _ATTRIBUTE.finditer(attributes):
            out.update("." + w.lower() for w in _NAME_WORD.findall(m.group(2) or m.group(3) or m.group(4) or ""))
    return out


def parse(page: str) -> list[Block | Tag]:
    """Blocks of text and tags in page order, with what surrounds them. Anything is
    accepted; an unclosed comment, tag, script or style reaches to the end."""
    out: list[Block | Tag] = []
    stack = [_Open("", frozenset())]
    pieces: list[str] = []
    links = [0, 0]  # pieces of the block with words, of these linked

    def say(raw: str) -> None:
        if raw:
            pieces.append(H.unescape(raw) if "&" in raw else raw)
            if not raw.isspace():
                links[0] += 1
                links[1] += any(o.name == "a" for o in stack[-4:])

    def close_block() -> None:
        if pieces:
            words = "".join(pieces).split()
            if words:
                out.append(Block(" ".join(words), stack[-1].marks, links[0] == links[1], len(words)))
            pieces.clear()
        links[:] = 0, 0

    def pop_to(names: set[str], own: bool = False) -> None:
        """End the innermost element of these names, if no scope lies in between."""
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].name in names:
                del stack[i:]
                return
            if not own and stack[i].name in SCOPES:
                return

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at:m.start()])
        at = m.end()
        name = (m.group(2) or m.group(5) or "").lower()
        if not name:
            continue
        ending, attributes = bool(m.group(1) or m.group(4)), m.group(3) or m.group(6) or ""
        if not ending and name in _END:
            if name in BLOCKS:
                close_block()
            if not attributes.rstrip().endswith("/"):
                stop = _END[name].search(page, at)
                at = stop.end() if stop else end
            continue
        if name == "br":
            pieces.append(" ")
        if name in BLOCKS:
            close_block()
        if ending:
            if any(o.name == name for o in stack[1:]):
                tag = Tag("/" + name, stack[-1].marks, frozenset())
                pop_to({name}, own=True)
                tag.parent = stack[-1].marks
                out.append(tag)
            continue
        if name in BLOCKS:
            pop_to({"p"})
        if name in ENDS:
            pop_to(ENDS[name])
        around = stack[-1].marks
        marks = _named(name, attributes)
        if name in ("header", "footer") and around & {"article", "main", "section"}:
            marks = marks - {name} | {"inner " + name}  # of an article, not of the page
        inside = around | marks
        if name not in VOID:
            stack.append(_Open(name, inside))
        out.append(Tag(name, inside, around))
    close_block()
    return out


@dataclass
class Weights:
    """Log-odds of what surrounds words (``words``, ``bias``) and of tags (``tags``)."""
    words: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0
    tags: dict[str, float] = field(default_factory=dict)

    def word(self, block: Block) -> float:
        return max(0.0, self.bias + sum(self.words.get(f, 0.0) for f in block.features()))

    def rejects(self, marks: frozenset[str]) -> bool:
        """Whether even long prose in such surroundings is not main text."""
        return self.bias + sum(self.words.get(m, 0.0) for m in marks) + self.words.get("very long", 0.0) <= 0

    def tag(self, tag: Tag) -> float:
        return 0.0 if self.rejects(tag.parent) else self.tags.get(tag.name, -0.1)


def region(scores: Iterable[float]) -> tuple[int, int]:
    """Start and end of the contiguous run with the largest positive sum; of equal
    sums the first, (0, 0) where none is positive. One scan."""
    best, run, begin, found = 0.0, 0.0, 0, (0, 0)
    for i, s in enumerate(scores):
        if run <= 0:
            run, begin = 0.0, i
        run += s
        if run > best:
            best, found = run, (begin, i + 1)
    return found


def main_text(page: str | None, weights: Weights) -> str:
    """Blocks of the best region, one a line; empty if there is none. A null or empty
    page has none."""
    items = parse(page or "")
    score = [weights.word(i) if isinstance(i, Block) else 0.0 for i in items]
    a, b = region(s * i.words if isinstance(i, Block) else weights.tag(i) for i, s in zip(items, score))
    return "\n".join(i.text for i, s in zip(items[a:b], score[a:b]) if isinstance(i, Block) and s > 0)


def fit(pages: Iterable[tuple[str, str]], rounds: int = 30, shrink: float = 2e-5) -> Weights:
    """Weights from (html, main text): a block belongs to the main text if it is one
    of the text's lines that has not been met yet, in page order."""
    rows: list[list[str]] = []
    labels: list[bool] = []
    seen: list[tuple[Tag, bool]] = []
    for page, text in pages:
        items = parse(page or "")
        lines, at, inside = [" ".join(x.split()) for x in (text or "").split("\n")], 0, []
        for k, item in enumerate(items):
            if isinstance(item, Block):
                mine = at < len(lines) and item.text == lines[at]
                at += mine
                rows.append(list(item.features()))
                labels.append(mine)
                if mine:
                    inside.append(k)
        first, last = (inside[0], inside[-1]) if inside else (0, -1)
        seen += [(item, first < k < last) for k, item in enumerate(items) if isinstance(item, Tag)]
    names = sorted({f for r in rows for f in r})
    index = {f: i for i, f in enumerate(names)}
    x = np.zeros((len(rows), len(names) + 1))
    x[:, -1] = 1
    for i, r in enumerate(rows):
        x[i, [index[f] for f in r]] = 1
    y, w = np.array(labels, float), np.zeros(len(names) + 1)
    if len(y):
        # both sides weigh the same; Newton steps on the mean log-loss with a ridge
        weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
        ridge = np.append(np.full(len(names), shrink), shrink / 100)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            slope = x.T @ (weight * (p - y)) + ridge * w
            w = w - np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge), slope)
            if np.abs(slope).max() < 1e-9:
                break
    out = Weights({f: float(w[i]) for f, i in index.items()}, float(w[-1]))
    # tags are weighed where the words' weights have not decided already
    tags = {True: Counter(), False: Counter()}
    for tag, mine in seen:
        if not out.rejects(tag.parent):
            tags[mine][tag.name] += 1
    out.tags = {t: min(-0.01, max(-1.5, float(np.log((tags[True][t] + 1) / (tags[False][t] + 1))) / 4)) for t in sorted({*tags[True], *tags[False]})}
    return out


def train(labelled: DataFrame, html_col: str = "html", text_col: str = "text", max_pages: int = MAX_PAGES) -> Weights:
    """Weights from at most ``max_pages`` labelled pages, chosen by hash; null pages
    and texts are left out. Distinct rows are ranked before any reaches the driver."""
    rows = labelled.select(F.col(html_col).alias("_ll_h"), F.col(text_col).alias("_ll_t")).where("_ll_h IS NOT NULL AND _ll_t IS NOT NULL").distinct()
    chosen = rows.orderBy(F.xxhash64("_ll_h", "_ll_t"), "_ll_h", "_ll_t").limit(max_pages)
    return fit((r["_ll_h"], r["_ll_t"]) for r in chosen.toLocalIterator())


def built_in() -> Weights:
    """Weights from the labelled pages of :mod:`._layouts`."""
    from ._layouts import labelled_pages

    return fit(labelled_pages())


def extract(pages: DataFrame, weights: Weights, html_col: str = "html", out: str = "text") -> DataFrame:
    """All rows and columns of ``pages`` with the main text in ``out`` and its code
    points in ``n_chars``.

    A null or empty page, or one without a positive region, gives the empty string.
    Repeated rows give repeated rows, an empty table an empty one. Input columns
    named like an output column are replaced.
    """
    kept = [c for c in pages.columns if c not in (out, "n_chars")]
    rows = pages.select(F.col(html_col).alias("_ll_html"), F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_ll_row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(t.as_py(), weights) for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(texts, pa.string())], names=["_ll_row", "_ll_text"])

    done = rows.mapInArrow(run, f"_ll_row {rows.schema['_ll_row'].dataType.simpleString()}, _ll_text string")
    return done.select(*[F.col("_ll_row").getField(c).alias(c) for c in kept], F.col("_ll_text").alias(out), F.length("_ll_text").cast("long").alias("n_chars"))
