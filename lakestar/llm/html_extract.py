"""Main text of web pages: the best-scoring contiguous region (maximum-scoring subsequence).

A page is a sequence of tokens: tags, and text nodes. The words of a node score positive, tags negative, each by weights that are learned
from labelled pages; one linear scan finds the contiguous region with the highest sum. Its text, block by block, is the main text.

Labelled pages are those that mark their content themselves, with exactly one ``article`` element: what it holds is content. Fitting
takes a bounded sample of them (SAMPLE_PAGES with the smallest hash of their html, of those with SAMPLE_BYTES at most). A word's weight follows the share of words
in the same kind of element (a link, a paragraph, ...) and of text node (short or not) that are content, counted with all furniture that has a name, so it holds where names say nothing; a tag's, the share of such tags that are not. How much a tag weighs
against a word is set by the number in SCALES that recovers most labelled regions exactly, the middle one of several.

What the markup itself names as no content is taken out before the scan, so it neither counts nor splits a region:
elements in SKIPPED, and those whose class, id or role names furniture (``_named``). Such a name may also tell how a whole page is laid out, so
an element that holds another article, or most of the page's words, stays for the scan, where its tags weigh as any others do. Readers' threads may
be longer than what they are about: they go at any size, and where an article stands apart from an element, its size tells nothing. Block elements part blocks; other tags, and line
breaks, are white space or nothing inside a block.

Defined results: null or empty html, or a page without words, gives an empty text; a page without any mark-up is one text; unclosed and
stray tags are allowed, a skipped element ends with its parent at the latest; ties go to the first, then the longest
region; repeated rows get equal results; an empty table gives an empty result; without labelled pages, words weigh 1 and tags by their kind.
"""

from __future__ import annotations

import bisect
import html as html_lib
import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_sample, ship, spare, with_columns

SAMPLE_PAGES = 400
#: Bytes of one page of the sample, so the driver sees SAMPLE_PAGES times as many at most. Longer pages teach nothing.
SAMPLE_BYTES = 1 << 17
SCALES = (0.5, 1, 2, 4, 8, 16, 32)
#: Words of a text node from which on it isn't short.
SHORT = 16
#: Elements that hold no main text.
SKIPPED = frozenset("head title script style noscript template nav header footer aside form button select textarea iframe object svg canvas menu dialog".split())
#: Words of class, id and role attributes that name page furniture, adverts, notices and readers' comments.
MARKED = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice notices alert popup modal overlay
newsletter subscribe signup login nav navbar navigation menu breadcrumb breadcrumbs pagination pager sidebar aside widget related recommended share sharing social
comment comments commentlist respond disqus replies reply header masthead footer copyright search toolbar contentinfo complementary""".split())
#: Of these, names of readers' threads.
_THREADS = frozenset("comments commentlist disqus replies respond".split())
#: A name that begins so tells what a page has, and of no element.
_STATES = frozenset("has no with without is".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_RAW = frozenset("script style textarea title noscript template iframe svg".split())
_WHOLE = frozenset("html body main".split())  # may tell of a sidebar by their class without being one
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset("""address article blockquote body caption center dd details dir div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hr html li main ol option p
pre section summary table tbody td tfoot th thead tr ul""".split())
_BOXES = frozenset("article body div html main section".split())
_NAME = re.compile(r"</?[a-zA-Z][^\s/>]*")
_QUOTED = re.compile(r"""[^"'>]*(["'>])""")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""")


class Piece(NamedTuple):
    """A stretch of a page: text (``name`` empty), or a tag with its name, whether it closes, and its attributes."""

    start: int
    end: int
    name: str
    closes: bool
    attributes: str


class _Finder:
    """``str.find`` that doesn't look again for what isn't there any more, so that all searches together read a page once."""

    def __init__(self, page: str):
        self.page, self.none = page, {}

    def __call__(self, what: str, at: int) -> int:
        if at >= self.none.get(what, len(self.page) + 1):
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.none[what] = at
        return found


def pieces(page: str, at: int, find: _Finder) -> Piece:
    """The piece that begins at ``at``. A ``<`` that begins no tag, or one that is never closed, is text; a comment that is never closed goes to the end."""
    if page[at] != "<":
        end = find("<", at)
        return Piece(at, len(page) if end < 0 else end, "", False, "")
    if page.startswith("<!--", at):
        end = find("-->", at + 4)
        return Piece(at, len(page) if end < 0 else end + 3, "!", False, "")
    close = find(">", at)
    if close < 0:  # no tag comes any more
        end = find("<!--", at)
        return Piece(at, len(page) if end < 0 else end, "", False, "")
    if page.startswith(("<!", "<?"), at):
        return Piece(at, close + 1, "!", False, "")
    name = _NAME.match(page, at)
    if not name:
        return Piece(at, at + 1, "", False, "")
    end = begin = name.end()
    while True:  # to the first > outside of quotes; a quote that is never closed is none
        m = _QUOTED.match(page, end)
        if m is None:
            return Piece(at, at + 1, "", False, "")
        if m.group(1) == ">":
            break
        closed = find(m.group(1), m.end())
        if closed < 0:
            end = find(">", m.end())
            if end < 0:
                return Piece(at, at + 1, "", False, "")
            return Piece(at, end + 1, name.group().lstrip("</"), page[at + 1] == "/", page[begin:end])
        end = closed + 1
    return Piece(at, m.end(), name.group().lstrip("</"), page[at + 1] == "/", page[begin:m.end() - 1])


class _Open:
    """The open elements of a page, with counts of their names, so that no question goes through all of them."""

    def __init__(self):
        self.stack, self.places, self.blocks = [], {}, []

    def __len__(self) -> int:
        return len(self.stack)

    def push(self, name: str) -> None:
        self.places.setdefault(name, []).append(len(self.stack))
        if name in _BLOCK:
            self.blocks.append(name)
        self.stack.append(name)

    def last(self, name: str) -> int:
        """Depth at which the innermost element of a name is, -1 if there is none."""
        places = self.places.get(name)
        return places[-1] if places else -1

    def cut(self, depth: int) -> None:
        while len(self.stack) > depth:
            name = self.stack.pop()
            self.places[name].pop()
            if name in _BLOCK:
                self.blocks.pop()

    def kind(self) -> str:
        """What text here is in: a link, or the innermost block."""
        return "a" if self.last("a") >= 0 else self.blocks[-1] if self.blocks else ""


class Token(NamedTuple):
    """A tag (``tag`` is its name, with a slash when it closes) or a text node (``tag`` empty; ``kind``: the element it is in)."""

    tag: str
    kind: str
    text: str
    words: int


def _named(tag: str, attributes: str) -> set[str]:
    """The words in MARKED by which an element's class, id or role names furniture: a whole name, or the first or last part of one.
    Only a whole name counts on articles and paragraphs, and as the id of a section, which like a heading's is made from its title;
    headings, and ids of paragraphs, name nothing."""
    out: set[str] = set()
    if not attributes or tag in _WHOLE or tag in _HEADINGS:
        return out
    for key, value in _ATTRIBUTE.findall(attributes):
        key = key.lower()
        if key not in ("class", "id", "role") or key == "id" and tag == "p":
            continue
        whole = key == "role" or tag in ("article", "p") or key == "id" and tag == "section"
        for name in value.strip("\"'").lower().split():
            parts = [w for w in re.split(r"[^a-z]+", name) if w]
            if parts and (len(parts) == 1 or not whole and parts[0] not in _STATES):
                out |= {parts[0], parts[-1]} & MARKED
    return out


class _Span(NamedTuple):
    """A named element: its tokens, whether it is an article or a readers' thread, and whether its own tag closes it."""

    start: int
    end: int
    article: bool
    thread: bool
    closed: bool


def _without_furniture(page: list[Token], spans: list[_Span]) -> list[Token]:
    """``page`` without the named elements that are furniture."""
    total = [0]
    for t in page:
        total.append(total[-1] + t.words)
    named = {s.start for s in spans if s.article}
    articles = [i for i, t in enumerate(page) if t.tag == "article" and i not in named]
    ends, open_ = {}, []
    for i, t in enumerate(page):
        if t.tag == "article":
            open_.append(i)
        elif t.tag == "/article" and open_:
            ends[open_.pop()] = i
    out, at = [], 0
    first = articles[0] if articles else len(page)
    last = articles[-1] if articles else -1
    closed = min((ends.get(i, len(page)) for i in articles), default=len(page))  # where the first article ends
    for s in sorted(spans):
        inside = bisect.bisect_left(articles, s.end) > bisect.bisect_left(articles, s.start)
        if s.start < at or inside:
            continue
        apart = closed < s.start or last >= s.end  # an article stands before or behind it
        around = first < s.start
        if s.article and not (apart or around) or not (apart or s.thread) and 2 * (total[s.end] - total[s.start]) > total[-1]:
            continue
        out += page[at:s.start]
        if s.closed:
            out.append(Token("", "", " ", 0))
        at = s.end
    return out + page[at:]


def tokens(page: str, cut: bool = True) -> list[Token]:
    """The page's tags and text nodes, without skipped elements and comments, and without named furniture if ``cut``; one pass."""
    out: list[Token] = []
    open_ = _Open()
    names: list[tuple[int, int, bool, bool]] = []  # open named elements: depth inside, first token, article, thread
    spans: list[_Span] = []
    skip = 0  # depth inside of the skipped element, 0: none

    def close(depth: int, own: bool) -> None:
        """Named elements deeper than ``depth`` end here; the outermost of them by its own tag, if ``own``."""
        while names and names[-1][0] > depth:
            inside, start, article, thread = names.pop()
            mine = own and inside == depth + 1
            spans.append(_Span(start, len(out) + mine, article, thread, mine))

    find, raw_ends = _Finder(page), {}
    at, end = 0, len(page)
    while at < end:
        piece = pieces(page, at, find)
        at, name = piece.end, piece.name.lower()
        if not name:
            if not skip:
                text = html_lib.unescape(page[piece.start:piece.end])
                out.append(Token("", open_.kind(), text, len(text.split())))
            continue
        if name == "!":
            continue
        if piece.closes:
            depth = open_.last(name)
            if depth >= 0:
                open_.cut(depth)
                if skip and depth + 1 <= skip:
                    if depth + 1 == skip:
                        out.append(Token("", "", " ", 0))
                        skip = 0
                        continue
                    skip = 0
                close(depth, True)
            if not skip:
                out.append(Token(f"/{name}", "", "", 0))
            continue
        if name in _VOID or piece.attributes.endswith("/"):
            if not skip:
                out.append(Token(name, "", "", 0))
            continue
        floor = names[-1][0] if names else 0
        depth = open_.last("p")
        if name == "p" and not skip and depth >= 0 and depth >= floor - 1:  # a paragraph ends where the next begins
            open_.cut(depth)
            close(depth, False)
        open_.push(name)
        if not skip and name in SKIPPED:
            skip = len(open_)
        elif not skip:
            marks = _named(name, piece.attributes)
            if marks:
                names.append((len(open_), len(out), name == "article", bool(marks & _THREADS)))
        if name in _RAW:
            at = _raw_end(page, name, at, raw_ends)
            continue
        if not skip:
            out.append(Token(name, "", "", 0))
    close(0, False)
    return _without_furniture(out, spans) if spans and cut else out


def _raw_end(page: str, name: str, at: int, ended: dict[str, bool]) -> int:
    """Where an element ends whose content is no markup; once there is no closing tag of a name any more, it isn't looked for again."""
    found = None if ended.get(name) else re.compile(rf"</{name}\s*>", re.I).search(page, at)
    if found is None:
        ended[name] = True
        return len(page)
    return found.start()


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous stretch with the highest sum; empty when none is positive."""
    best, found, run, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if run <= 0:
            run, start = 0.0, i
        run += score
        if run > best or run == best and found[0] == start and found[1]:
            best, found = run, (start, i + 1)
    return found


class Weights(NamedTuple):
    words: dict[str, float]  # by the element they are in, with a mark for short text nodes
    tags: dict[str, float]
    scale: float

    def tag(self, tag: str) -> float:
        """A tag that no labelled page has costs as much as its kind: a box that may hold anything, a block of text, or a mark inside one."""
        name = tag.strip("/")
        return self.tags.get(tag, -1.0 if name in _BOXES else -0.1 if name in _BLOCK else -0.01)

    def scores(self, page: list[Token]) -> list[float]:
        return [self.scale * self.tag(t.tag) if t.tag else t.words * self.words.get(_place(t), self.words.get(t.kind, 1.0)) for t in page]


def _place(t: Token) -> str:
    """What a text node's words are counted by: the element it is in, and whether it is short, as labels, adverts and buttons are."""
    return f"{t.kind} short" if t.words < SHORT else t.kind


def _content(page: list[Token]) -> tuple[int, int] | None:
    """Where the only article of a labelled page begins and ends."""
    opened, closed = ([i for i, t in enumerate(page) if t.tag == x] for x in ("article", "/article"))
    return (opened[0] + 1, closed[0]) if len(opened) == len(closed) == 1 and opened < closed else None


def learn(pages: list[str]) -> Weights:
    inside: Counter = Counter()
    outside: Counter = Counter()
    labelled = []
    for raw in pages:
        # Counted with the furniture that names would cut, so that the scan learns to do without names.
        for page, counted in ((tokens(raw, cut=False), True), (tokens(raw), False)):
            region = _content(page)
            if region and not counted:
                labelled.append((page, region))
            elif region:
                for i, t in enumerate(page):
                    (inside if region[0] <= i < region[1] else outside)[("tag", t.tag) if t.tag else ("word", _place(t))] += 1 if t.tag else t.words
    if not labelled:
        return Weights({}, {}, 1.0)
    odds = {k: math.log((inside[k] + 1) / (outside[k] + 1)) for k in {*inside, *outside} if inside[k] + outside[k]}
    words = {k: max(-1.0, min(1.0, v)) for (what, k), v in odds.items() if what == "word"}
    tags = {k: min(-0.01, -0.01 if v > 0 else v) for (what, k), v in odds.items() if what == "tag"}

    def right(scale: float) -> int:
        weights = Weights(words, tags, scale)
        return sum(_text(p, best_region(weights.scores(p))) == _text(p, r) for p, r in labelled)

    recovered = [right(x) for x in SCALES]
    best = [x for x, n in zip(SCALES, recovered) if n == max(recovered)]
    return Weights(words, tags, best[len(best) // 2])


def _text(page: list[Token], region: tuple[int, int]) -> str:
    blocks, open_ = [], []
    for t in page[region[0]:region[1]]:
        if not t.tag:
            open_.append(t.text)
        elif t.tag.strip("/") in _BLOCK:
            blocks.append(open_)
            open_ = []
        elif t.tag == "br":
            open_.append(" ")
    joined = (" ".join("".join(b).split()) for b in [*blocks, open_])
    return "\n".join(b for b in joined if b)


def main_text(page: str | None, weights: Weights) -> str:
    found = tokens(page or "")
    return _text(found, best_region(weights.scores(found)))


def fit(pages: DataFrame, html_col: str = "html") -> Weights:
    """Weights from a bounded sample of the pages that mark their content."""
    marked = pages.select(F.col(html_col).alias("html")).where(F.lower("html").contains("<article") & (F.octet_length("html") <= SAMPLE_BYTES))
    return learn(hash_sample(marked, "html", SAMPLE_PAGES))


def extract(pages: DataFrame, weights: Weights, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars``; columns with these names give way."""
    ship(pages.sparkSession)

    @F.arrow_udf("string")
    def text_of(pages_: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in pages_:
            yield pa.array([main_text(x.as_py(), weights) for x in batch], pa.string())

    found = spare(pages, "main_text")
    out = pages.withColumn(found, text_of(F.col(html_col)))
    return with_columns(out, {"text": F.col(found), "n_chars": F.length(found).cast("bigint")}).drop(found)
