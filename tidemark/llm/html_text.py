"""Main text of web pages from flat text blocks.

A page is cut into text blocks at its block-level tags.  A block is described by
the word counts and link densities of itself and its two neighbours, the words of
the page's longest block, and by where it stands (in page furniture, in the
article).  A decision tree, trained on the small labelled tables below, tells the
article's blocks from the rest: by place where tags tell it, else by the words and
links of a block and its neighbours.
Forms and names of classes and ids count as furniture unless what they hold
shows that they hold main text (``_judge``).
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import text as tx
from tidemark.llm.common import arrow, table

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[A-Za-z][A-Za-z0-9:-]*)(?P<attrs>(?>\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([A-Za-z-]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_RAW = {x: re.compile(rf"</{x}\s*>|\Z", re.I) for x in ("script", "style", "noscript", "template", "textarea", "svg")}
_INLINE = frozenset((
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font",
    "i", "img", "ins", "kbd", "label", "mark", "meter", "q", "ruby", "rp", "rt", "s", "samp", "small", "span",
    "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"))
_VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))
_FURNITURE = frozenset((
    "nav", "footer", "aside", "menu", "dialog", "button", "select", "title", "iframe", "object"))
_ROLES = frozenset((
    "navigation", "banner", "contentinfo", "complementary", "dialog", "alert", "alertdialog", "menu"))
#: Names of classes and ids: of page parts, of notes with sentences of their own, of readers' comments.
_PART, _NOTE, _TALK, _FORM, _SECTION = "part", "note", "talk", "form", "section"
_NAMES = re.compile(
    r"(?:^|[_-])(?:(?P<part>banners?|promo\w*|nav\w*|menus?|side-?bars?|foot\w*|header|masthead|breadcrumbs?|"
    r"notices?|alerts?|popups?|modal|overlay|login|share|sharing|social|related|recommend\w*|widgets?|"
    r"pagination|pager|legal|toolbar|search)|(?P<note>ads?|advert\w*|sponsor\w*|cookies?|consent|gdpr|newsletter|"
    r"subscribe|subscription|signup|copyright|disclaimer)|(?P<talk>comments?|replies|reply|disqus))(?=$|[_-])", re.I)
#: Names that tell a state of what they stand on, as in has-sidebar.
_STATE = re.compile(r"(?:no|has|with|without|not)[_-]|.*[_-](?:open|closed|enabled|disabled)$", re.I)
#: An <article> that is a reader's comment, by a token of its class or by its id.
_COMMENT = re.compile(r"(?:comments?|reply|replies)(?:[_-].*)?", re.I)
_COMMENT_ID = re.compile(r"(?:.*[_-])?comment[_-]?\d+", re.I)
_SECTION_CLASS = re.compile(r"section|level[1-6]")
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Open elements that an opening tag ends as their closing tag may be left out, up to the nearest of the others.
_FLOW = ("div", "section", "article", "main", "body", "blockquote", "td", "th", "table", "form", "aside", "nav")
_ENDED = {
    **{t: ((("p",), (*_FLOW, "li", "dd")),) for t in (
        "p", "div", "ul", "ol", "dl", "table", "section", "article", "main", "aside", "nav", "header", "footer", "form",
        "blockquote", "pre", "figure", "hr", "address", "fieldset", "details", *_HEADINGS)},
    "li": ((("li",), ("ul", "ol", "menu", *_FLOW)),),
    "dt": ((("dt", "dd"), ("dl", *_FLOW)),), "dd": ((("dt", "dd"), ("dl", *_FLOW)),),
    "tr": ((("tr", "td", "th"), ("table", "thead", "tbody", "tfoot")),),
    "td": ((("td", "th"), ("tr", "table")),), "th": ((("td", "th"), ("tr", "table")),),
    "option": ((("option",), ("select",)),), "tbody": ((("thead", "tbody", "tfoot"), ("table",)),),
}
#: A block of so many words and at most this share of them in links is a paragraph.
_PARAGRAPH, _LINKED = 25, 0.3
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

FEATURES = ("words_before", "words", "words_after", "links_before", "links", "links_after",
            "furniture", "article", "page_has_article", "longest")

# Neighbours of a block: (words, share of words in links).
_EDGE, _LINK, _SHORT, _LONG = (0, 0.0), (2, 1.0), (10, 0.0), (100, 0.0)
_ANY = (_EDGE, _LINK, _SHORT, _LONG)

#: Words of the longest block on such pages: their tags tell, whatever it is.
_LONGEST = (0, 8, 30, 200)

#: Labelled blocks of pages whose tags tell: furniture, article, page_has_article;
#: words; share of words in links; neighbours on either side; 1 for main text.
#: Each line stands for all combinations of its values.
MARKED = (
    # page furniture, whatever its length and place
    ((1, 0, 1), (1, 15, 100), (0.0, 1.0), _ANY, 0),
    ((1, 1, 1), (1, 15, 100), (0.0, 1.0), _ANY, 0),
    ((1, 0, 0), (1, 15, 100), (0.0, 1.0), _ANY, 0),
    # in the article: headings, paragraphs of any length, quoted links, but not runs of links
    ((0, 1, 1), (1, 15, 100, 400), (0.0, 0.3), _ANY, 1),
    ((0, 1, 1), (1, 15), (1.0,), (_SHORT, _LONG), 1),
    ((0, 1, 1), (1, 4), (1.0,), (_LINK,), 0),
    # beside the article that a page marks
    ((0, 0, 1), (1, 15, 100, 400), (0.0, 0.3, 1.0), _ANY, 0),
)
#: Labelled pages whose tags tell nothing, one (words, share in links, 1 for main
#: text) for each block in order: there, words and links of neighbours decide.
UNMARKED = (
    # a blog post: menu, title, paragraphs, tags, a form, the foot
    ((1, 1, 0), (1, 1, 0), (2, 1, 0), (9, 0, 1), (62, .05, 1), (48, 0, 1), (7, 0, 1), (95, .1, 1), (31, 0, 1), (2, 1, 0),
     (2, 1, 0), (3, 0, 0), (2, 0, 0), (8, .5, 0), (6, 0, 0)),
    # news: sections, headline, lead, paragraphs, more stories
    ((3, 1, 0), (2, 1, 0), (4, 1, 0), (12, 0, 1), (25, 0, 1), (40, 0, 1), (55, .02, 1), (38, 0, 1), (6, 0, 1), (44, 0, 1),
     (10, 1, 0), (9, 1, 0), (11, 1, 0), (5, 0, 0), (4, .8, 0)),
    # a manual: short headings between its paragraphs
    ((1, 1, 0), (1, 1, 0), (1, 1, 0), (4, 0, 1), (33, 0, 1), (3, 0, 1), (27, .1, 1), (2, 0, 1), (70, 0, 1), (5, 0, 1),
     (29, 0, 1), (2, 1, 0), (2, 1, 0)),
    # an essay and nothing else
    ((6, 0, 1), (120, 0, 1), (210, 0, 1), (180, 0, 1), (160, .01, 1)),
    # a product among links and buttons
    ((2, 1, 0), (2, 1, 0), (3, 1, 0), (2, 1, 0), (7, 0, 1), (85, 0, 1), (42, 0, 1), (3, 1, 0), (3, 1, 0), (2, 0, 0), (2, 0, 0),
     (3, 1, 0)),
    # an article, then teasers: a linked title and a line of each
    ((8, 0, 1), (100, 0, 1), (90, 0, 1), (2, 0, 0), (4, 1, 0), (18, 0, 0), (5, 1, 0), (16, 0, 0), (4, 1, 0), (19, 0, 0)),
    # talk: short lines between long ones
    ((70, 0, 1), (5, 0, 1), (45, 0, 1), (8, 0, 1), (60, 0, 1)),
    # pages of few words: a notice, one with a menu, single sentences, a sentence and a signature
    ((4, 0, 1), (9, 0, 1), (7, 0, 1)),
    ((1, 1, 0), (1, 1, 0), (1, 1, 0), (5, 0, 1), (11, 0, 1), (8, 0, 1), (2, 1, 0)),
    ((6, 0, 1),), ((12, 0, 1),), ((3, 0, 1), (14, 0, 1)), ((2, 1, 0), (10, 0, 1), (2, 0, 1)),
    ((5, 0, 1), (6, 0, 1), (4, 0, 1), (7, 0, 1), (5, 0, 1)),
    # a list of links
    ((2, 1, 0), (3, 1, 0), (4, 1, 0), (5, 1, 0), (3, 1, 0), (12, 1, 0)),
)


def labelled_table() -> np.ndarray:
    """The rows of the labelled tables: FEATURES, then the label."""
    rows = [(before[0], words, after[0], before[1], links, after[1], *place,
             max(words * (links <= _LINKED and not place[0]), longest), label)
            for place, counts, shares, sides, label in MARKED
            for words, links, before, after, longest in product(counts, shares, sides, sides, _LONGEST)]
    for page in UNMARKED:
        around = [(0, 0.0), *[b[:2] for b in page], (0, 0.0)]
        longest = max((w for w, share, _ in page if share <= _LINKED), default=0)
        rows += [(before[0], words, after[0], before[1], links, after[1], 0, 0, 0, longest, label)
                 for before, (words, links, label), after in zip(around, page, around[2:], strict=False)]
    return np.array(rows, float)


class Tree:
    """Binary decision tree (Gini impurity, midpoints between values)."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.split: tuple[int, float] | None = None
        self.value = int(2 * y.sum() >= len(y))
        if y.min() == y.max():
            return
        best = (np.inf, -1, 0.0)
        for j in range(x.shape[1]):
            v = np.unique(x[:, j])
            for cut in (v[1:] + v[:-1]) / 2:
                left = x[:, j] <= cut
                cost = sum(m.sum() * (p := y[m].mean()) * (1 - p) for m in (left, ~left))
                if cost < best[0] - 1e-12:
                    best = (cost, j, float(cut))
        if best[1] >= 0:
            self.split = best[1:]
            left = x[:, best[1]] <= best[2]
            self.left, self.right = Tree(x[left], y[left]), Tree(x[~left], y[~left])

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.split is None:
            return np.full(len(x), self.value)
        out, left = np.empty(len(x), int), x[:, self.split[0]] <= self.split[1]
        out[left], out[~left] = self.left.predict(x[left]), self.right.predict(x[~left])
        return out


def train() -> Tree:
    rows = labelled_table()
    return Tree(rows[:, :-1], rows[:, -1].astype(int))


def _mark(tag: str, attrs: str, inside_article: int) -> str | None:
    """What an element's tag and attributes say: "" for page furniture, or the
    kind of a mark that needs a look at what the element holds, or None."""
    if tag in _FURNITURE or tag == "header" and not inside_article:
        return ""
    kind = _FORM if tag == "form" else None
    section, named = tag == "section", False  # named by a class, not just by its id
    if tag in ("html", "head", "body", "main") or not attrs.strip(" /"):
        return kind
    if tag == "article":
        for m in _ATTR.finditer(attrs):
            name, value = m[1].lower(), (m[2] or "").strip("\"'")
            if (name == "class" and any(_COMMENT.fullmatch(x) and not _STATE.match(x) for x in value.split())
                    or name == "id" and _COMMENT_ID.fullmatch(value)):
                return _TALK
        return None
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or "").strip("\"'")
        if (name == "role" and value.lower() in _ROLES or name == "hidden"
                or name == "aria-hidden" and value.lower() == "true" or name == "style" and _HIDDEN.search(value)):
            return ""
        if name == "role" and value.lower() in ("form", "search"):
            kind = kind or _FORM
        elif name == "class" or name == "id" and tag not in _HEADINGS:  # a heading's id is a link target
            for token in value.split():
                section |= name == "class" and bool(_SECTION_CLASS.fullmatch(token))
                for n in () if _STATE.match(token) else _NAMES.finditer(token):
                    if not (inside_article and n[0].strip("_-").lower() == "header"):
                        kind = max(kind or "", n.lastgroup, key=("", _FORM, _PART, _NOTE, _TALK).index)
                        named |= name == "class"
    return _SECTION if kind == _PART and section and not named else kind


def _judge(found: list[tuple], marks: list[tuple[str, int, int]]) -> list[bool]:
    """Whether each block is page furniture.  ``found``: words, words in links,
    furniture by its tags, number of its article, innermost mark; ``marks``: kind,
    enclosing mark (always an earlier one), 1 in <main> or 2 in <article>.

    A mark doesn't count if its element holds the page's paragraphs (a form
    around the whole body), if it names a section of paragraphs in the article,
    or if it stands in an <article>, is made of paragraphs and holds a quarter
    of the page's.  Notes must hold all of the page for that; comments always count.
    """
    if not marks:
        return [b[2] for b in found]
    aside = []  # in a note or in comments
    for kind, up, _ in marks:
        aside.append(kind in (_NOTE, _TALK) or up >= 0 and aside[up])
    # words, words out of links, words of paragraphs, all three outside notes; words out of links; has article blocks
    total, held = [0] * 5, [[0] * 5 for _ in marks]
    for words, linked, tagged, article, mark in found:
        if tagged:
            continue
        own = mark < 0 or not aside[mark]
        long = words if words >= _PARAGRAPH and linked <= _LINKED * words else 0
        for row in (total, held[mark]) if mark >= 0 else (total,):
            for j, x in enumerate((own * words, own * (words - linked), own * long, words - linked, int(article > 0))):
                row[j] += x
    for i in range(len(marks) - 1, -1, -1):
        if marks[i][1] >= 0:
            held[marks[i][1]] = [x + y for x, y in zip(held[marks[i][1]], held[i], strict=True)]
    counts: list[bool] = []
    for (kind, up, inside), (words, free, long, every, in_article) in zip(marks, held, strict=True):
        if kind == _TALK:
            void = False
        elif kind == _NOTE:
            void = not inside and 10 * every >= 9 * total[3]
        elif total[2]:
            void = (4 * (total[2] - long) <= long and 2 * free >= total[1]
                    or 2 * long >= words > 0 and (inside > 0 and kind == _SECTION or inside > 1 and 4 * long >= total[2]))
        else:  # a page without paragraphs
            void = in_article > 0 and not inside and 5 * free >= 4 * total[1]
        counts.append(not void or up >= 0 and counts[up])
    return [b[2] or b[4] >= 0 and counts[b[4]] for b in found]


def blocks(page: str) -> list[tuple[str, int, int, bool, int]]:
    """(text, words, words in links, in furniture, number of the outermost
    <article> or <main> around it, or 0) of a page's text blocks in order.  Comments, scripts and styles give no text."""
    out, parts, linked = [], [], 0
    # open block elements: tag, furniture, 1 in <main> or 2 in <article>, number of the outermost, innermost mark
    stack: list[tuple[str, bool, int, int, int]] = []
    marks: list[tuple[str, int, int]] = []
    furniture = False
    article, outer, mark, anchors, articles = 0, 0, -1, 0, 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            text = html.unescape(raw)
            parts.append(text)
            if anchors:
                linked += len(text.split())

    def end() -> None:
        nonlocal linked
        words = "".join(parts).split()
        if words:
            out.append((" ".join(words), len(words), min(linked, len(words)), furniture, outer, mark))
        parts.clear()
        linked = 0

    def close(i: int) -> None:
        """End the open elements from the i-th on; a link inside ends with them."""
        nonlocal anchors
        del stack[i:]
        if anchors > 1 + len(stack):
            anchors = 0

    def enter(tag: str, attrs: str) -> tuple[bool, int]:
        kind = _mark(tag, attrs, article)
        if kind:
            marks.append((kind, mark, article))
        return furniture or kind == "", len(marks) - 1 if kind else mark

    at = 0
    while m := _TOKEN.search(page, at):
        add(page[at: m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if m["cdata"] is not None:
            add(m["cdata"])
        if not tag:
            continue
        if tag in _RAW and not m["close"]:
            if not m["attrs"].endswith("/"):
                at = _RAW[tag].search(page, at).end()
            continue
        if tag in _INLINE:
            if tag == "a":  # the depth it stands at: a link around blocks covers them all
                anchors = 0 if m["close"] else 1 + len(stack)
            elif tag == "br":
                parts.append(" ")
            continue
        end()
        if m["close"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
        elif tag not in _VOID and not m["attrs"].endswith("/"):
            for ends, within in _ENDED.get(tag, ()):  # tags that may be left out
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in within:
                        break
                    if stack[i][0] in ends:
                        close(i)
                        break
            furniture, article, outer, mark = stack[-1][1:] if stack else (False, 0, 0, -1)
            inside, inner = enter(tag, m["attrs"])
            if tag in ("article", "main"):
                article = max(article, 1 + (tag == "article"))
                if not outer:
                    outer = articles = articles + 1
            stack.append((tag, inside, article, outer, inner))
        furniture, article, outer, mark = stack[-1][1:] if stack else (False, 0, 0, -1)
    add(page[at:])
    end()
    judged = _judge([b[1:] for b in out], marks)
    return [(*b[:3], x, b[4]) for b, x in zip(out, judged, strict=True)]


def _has_article(found: list[tuple]) -> bool:
    """Whether a page marks its main text: of the words out of links and
    furniture, one article holds a third or all articles a half."""
    held: dict[int, int] = {}
    for _, words, linked, furniture, article in found:
        if not furniture:
            held[article] = held.get(article, 0) + words - linked
    free, beside = sum(held.values()), held.pop(0, 0)
    return bool(held) and (3 * max(held.values()) >= free or 2 * beside <= free)


def _shift(x: np.ndarray, page: np.ndarray, by: int) -> np.ndarray:
    """The neighbour's value, 0 beyond the page's ends."""
    out = np.zeros(len(x))
    if by < 0:
        out[1:] = np.where(page[1:] == page[:-1], x[:-1], 0)
    else:
        out[:-1] = np.where(page[1:] == page[:-1], x[1:], 0)
    return out


def features(found: list[list[tuple]]) -> tuple[np.ndarray, np.ndarray]:
    """(features, page number) of the blocks of several pages."""
    page = np.repeat(np.arange(len(found)), [len(x) for x in found])
    rows = np.array([b[1:] for x in found for b in x], float).reshape(-1, 4)
    words, links = rows[:, 0], rows[:, 1] / np.maximum(rows[:, 0], 1)
    longest = np.zeros(len(found))
    np.maximum.at(longest, page, np.where((links <= _LINKED) & (rows[:, 2] == 0), words, 0))
    marked = np.array([_has_article(x) for x in found], float)[page] if len(found) else words
    cols = [_shift(words, page, -1), words, _shift(words, page, 1), _shift(links, page, -1), links,
            _shift(links, page, 1), rows[:, 2], (rows[:, 3] > 0) * marked, marked, longest[page]]
    return np.stack(cols, axis=1), page


def _extractor(tree: Tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.slices(batch, "html"):
                names = part.schema.names
                found = [blocks(x or "") for x in part.column(names.index("html")).to_pylist()]
                x, page = features(found)
                keep = tree.predict(x).astype(bool) if len(x) else np.empty(0, bool)
                flat = [b[0] for y in found for b in y]
                kept: list[list[str]] = [[] for _ in found]
                for i in np.flatnonzero(keep):
                    kept[page[i]].append(flat[i])
                text = ["\n".join(y) for y in kept]
                yield pa.RecordBatch.from_arrays([
                    part.column(names.index("page_id")), part.column(names.index("url")), pa.array(text, pa.string()),
                    pa.array([len(y) for y in text], pa.int64()), pa.array([len(y) for y in found], pa.int64()),
                ], ["page_id", "url", "text", "n_chars", "n_blocks"])
    return run


def extract(pages: DataFrame, tree: Tree | None = None) -> DataFrame:
    """``page_id, url, text, n_chars, n_blocks`` of every row of ``pages``.

    A null or empty html gives an empty text.  Character references are decoded,
    runs of white space in a block become one space, blocks are joined by line
    feeds.  Markup that is cut off counts up to the end.  Each page is read
    alone: repeated rows get equal results; other columns are not read; an empty
    table gives no rows.
    """
    kind = dict(pages.dtypes)["page_id"]
    return arrow(pages.select("page_id", "url", "html"), _extractor(tree or train()),
                 f"page_id {kind}, url string, text string, n_chars long, n_blocks long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
