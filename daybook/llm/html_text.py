"""Main text of a page by two passes of block rules.

The page is cut into blocks at block-level tags. Blocks inside navigation,
sidebars, footers, forms, adverts, notices and reader comments, as their tags,
classes or roles say, are boilerplate. Of the rest, inside an article and outside,
the first pass decides by words, stop-word density and link density; an article
only needs fewer stop words. What stays undecided is short or has few of them. The
second pass gives each undecided block the label of its nearest decided
neighbours in the same region (the article, or the page outside of it); headings
look at what follows them first.
"""

from __future__ import annotations

import bisect
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from daybook.llm.common import ship

# Frequent function words.
STOP_WORDS = frozenset(
    "the of and to in a is that for it was on are as with be by this from at or an have not they which you "
    "le la les de des du et un une en est que qui dans pour pas sur au avec ce il par plus ne se "
    "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden "
    "el los las una y que del se por con para al lo como más o pero sus su "
    "il di che è per non sono della del dei con si una da o os um uma não com mais na no dos "
    "het een van en dat niet zijn op te voor met".split()
)
# Tags whose content is not markup, other tags that never hold main
# text, and tags that end a block.
RAW = frozenset("script style noscript iframe title textarea".split())
SKIPPED = frozenset("template svg canvas object audio video map datalist".split())
ASIDE = SKIPPED | frozenset("nav header footer aside form button select menu dialog fieldset".split())
ARTICLE = frozenset("article main".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol optgroup option p pre "
    "section summary table tbody td tfoot th thead tr ul legend select button".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
OPTIONS = frozenset("option optgroup".split())
# A block in a list of choices means that the list was left open.
NOT_IN_SELECT = BLOCKS - OPTIONS - frozenset("div hr legend button".split())
# Words of a class, id or role that mark boilerplate.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion "
    "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc "
    "header masthead topbar footer foot bottom colophon copyright legal "
    "sidebar aside widget widgets related recommended recommendations popular trending teaser "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup "
    "login search form share sharing social follow tags "
    "comment comments commentlist respond reply replies discussion disqus "
    "contentinfo complementary skip hidden print "
    "hinweis hinweise kommentar kommentare werbung anzeige anzeigen navigationsleiste menue seitenleiste "
    "fusszeile kopfzeile brotkrumen anmeldung suche suchformular "
    "commentaire commentaires publicite avis entete recherche connexion "
    "comentario comentarios publicidad anuncio anuncios aviso avisos cabecera busqueda".split()
)
# Of these, the ones that stay boilerplate around most of the page's text; only a main inside lifts them.
FIRM = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored cookie cookies consent gdpr "
    "comment comments commentlist respond reply replies discussion disqus "
    "kommentar kommentare werbung anzeige anzeigen commentaire commentaires publicite "
    "comentario comentarios publicidad anuncio anuncios".split()
)
# Words beside a mark that leave it one, as in "site-header" or "comment-list".
BESIDE = frozenset(
    "site page main top left right primary secondary global box bar block list links item items container wrapper "
    "wrap inner section slot unit post posts entry article buttons icons banner body title text form".split()
)
# Firmness of a mark: of an article inside another, of a word, of a word in FIRM, of a tag.
NESTED, WEAK, FIRM_WORD, ALWAYS = -1, 0, 1, 2
LONG_WORDS, SHORT_WORDS = 12, 6
STOP_HIGH, STOP_ARTICLE, LINK_HIGH = 0.15, 0.05, 0.4

_MARK_PART = re.compile(r"[-_\d]+")
# Scripts without spaces between words; two of their characters count as a word.
_SPACELESS = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_WORD = re.compile(rf"[{_SPACELESS}]{{1,2}}|(?:(?![{_SPACELESS}])[^\W\d_])+")
_NAME_START = re.compile(r"[a-zA-Z]")
_NAME = re.compile(r"[^\s/>]*")
_ATTRIBUTE_NAME = re.compile(r"[\s/]*([^\s/>=]?[^\s/>=]*)\s*(=?)\s*")
_UNQUOTED = re.compile(r"[^\s>]*")
_CLOSES: dict[str, re.Pattern] = {}


@dataclass
class Block:
    heading: bool
    article: int
    mark: Mark | None
    aside: bool = False
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    plain: bool = False
    good: bool | None = None
    text: str = ""


@dataclass
class Mark:
    """A container that its tag, class, id or role calls boilerplate, inside another one or none.

    The articles that begin inside are those numbered above ``before``, up to ``last``;
    ``around`` is one that it lies in, if a further article tag is inside.
    """

    firm: int
    within: Mark | None
    before: int
    last: int = -1
    around: int = 0
    holds_main: bool = False
    weak: bool = True
    words: int = 0
    void: bool = False
    free: bool = False
    articles: list[int] = field(default_factory=list)


@dataclass
class Open:
    """An open element, with what it tells of everything inside it."""

    tag: str
    mark: Mark | None
    article: int
    in_article: bool
    in_link: bool
    in_heading: bool


def _mark_of(token: str) -> int | None:
    """WEAK or FIRM_WORD if this word of a class, id or role is a mark or a known compound of marks."""
    parts = [part for part in _MARK_PART.split(token) if part]
    if token not in MARKS and not (
        any(part in MARKS for part in parts) and all(part in MARKS or part in BESIDE for part in parts)
    ):
        return None
    return FIRM_WORD if any(part in FIRM for part in parts) else WEAK


def _marked(attributes: list[tuple[str, str]]) -> int | None:
    """The firmest mark of a tag's attributes, or None."""
    found = []
    for name, value in attributes:
        name, value = name.lower(), value.lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return ALWAYS
        if name in ("class", "id", "role"):
            found += [mark for mark in map(_mark_of, value.split()) if mark is not None]
    return max(found, default=None)


class _Scanner:
    """Tags of a page from front to back. What was looked for once and isn't there isn't looked for again."""

    def __init__(self, page: str) -> None:
        self.page = page
        self.gone: set[str] = set()
        self.ends: dict[str, int] = {}

    def find(self, what: str, at: int) -> int:
        """Place of ``what`` from ``at`` on, or -1."""
        if what in self.gone:
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.gone.add(what)
        return found

    def end_of(self, tag: str, at: int) -> int | None:
        """Where the next end tag of ``tag`` begins, or None."""
        if self.ends.get(tag, -1) < at:
            found = re.compile(rf"</{re.escape(tag)}(?![^\s/>])", re.I).search(self.page, at)
            self.ends[tag] = found.start() if found else len(self.page)
        return self.ends[tag] if self.ends[tag] < len(self.page) else None

    def attributes(self, at: int) -> tuple[list[tuple[str, str]], bool, int]:
        """Attributes of a tag whose name ends at ``at``, whether it closes itself, and the place after it.

        A quote only opens a value right after an equals sign; elsewhere it is a
        character like any other. Without its other half it ends with the tag.
        """
        page, found = self.page, []
        while at < len(page):
            if page[at] == ">":
                return found, page[at - 1] == "/", at + 1
            match = _ATTRIBUTE_NAME.match(page, at)
            at, value = match.end(), ""
            if match[2] and at < len(page):
                close = self.find(page[at], at + 1) if page[at] in "\"'" else -1
                if close >= 0:
                    value, at = page[at + 1 : close], close + 1
                elif page[at] in "\"'":
                    end = self.find(">", at)
                    end = end if end >= 0 else len(page)
                    value, at = page[at + 1 : end], end
                else:
                    end = _UNQUOTED.match(page, at).end()
                    value, at = page[at:end], end
            if match[1]:
                found.append((match[1], value))
        return found, False, at

    def next_tag(self, at: int) -> tuple[int, int, str, bool, list[tuple[str, str]], bool] | None:
        """``begin, end, name, is an end tag, attributes, closes itself`` from ``at`` on; comments have an empty name."""
        page = self.page
        while (begin := self.find("<", at)) >= 0:
            at = begin + 1
            after = page[at : at + 1]
            if page.startswith("<!--", begin):
                end = self.find("-->", begin + 4)
                return begin, end + 3 if end >= 0 else len(page), "", False, [], False
            if after in ("!", "?"):
                end = self.find(">", begin)
                return begin, end + 1 if end >= 0 else len(page), "", False, [], False
            if after == "/" and _NAME_START.match(page, begin + 2):
                name = _NAME.match(page, begin + 2)
                end = self.find(">", name.end())
                return begin, end + 1 if end >= 0 else len(page), name[0].lower(), True, [], False
            if _NAME_START.match(page, at):
                name = _NAME.match(page, at)
                attributes, closed, end = self.attributes(name.end())
                return begin, end, name[0].lower(), False, attributes, closed
        return None


class _Stack:
    """Open elements, with the places of each tag and of containers, so that no step walks over all of them."""

    def __init__(self) -> None:
        self.open: list[Open] = []
        self.places: dict[str, list[int]] = {}
        self.barriers: list[int] = []

    def push(self, element: Open) -> None:
        depth = len(self.open)
        self.places.setdefault(element.tag, []).append(depth)
        if element.tag in BLOCKS and element.tag not in ("li", "td", "th", "dd", "dt", "p"):
            self.barriers.append(depth)
        self.open.append(element)

    def cut(self, depth: int, articles: int) -> None:
        """Close all from ``depth`` on."""
        while len(self.open) > depth:
            element = self.open.pop()
            self.places[element.tag].pop()
            if self.barriers and self.barriers[-1] == len(self.open):
                self.barriers.pop()
            below = self.open[-1].mark if self.open else None
            if element.mark is not None and element.mark is not below:
                element.mark.last = articles

    def last(self, tag: str) -> int:
        places = self.places.get(tag)
        return places[-1] if places else -1

    def implied(self, tag: str) -> int:
        """Where to cut for a new paragraph, item or cell that ends one left open, not across a container; or -1."""
        depth = self.last(tag)
        if tag not in ("td", "th", "tr"):
            depth = max(depth, self.last("p"))
        return depth if depth >= (self.barriers[-1] if self.barriers else -1) else -1


def blocks(page: str) -> list[Block]:
    """The page's blocks with their text, in order. The time is in proportion to the page."""
    out: list[Block] = []
    marks: list[Mark] = []
    stack = _Stack()
    scanner = _Scanner(page)
    articles = 0
    current: Block | None = None

    def add(text: str) -> None:
        nonlocal current
        if not text:
            return
        inside = stack.open[-1] if stack.open else None
        if current is None:
            current = Block(*((inside.in_heading, inside.article, inside.mark) if inside else (False, 0, None)))
            out.append(current)
        current.parts.append(text)
        if inside and inside.in_link:
            current.linked += len(_WORD.findall(text))

    at = 0
    while found := scanner.next_tag(at):
        begin, end, tag, closing, attributes, closed = found
        add(page[at:begin])
        at = end
        if tag in BLOCKS:
            current = None
        if closing:
            depth = stack.last(tag)
            if depth >= 0:
                stack.cut(depth, articles)
        elif tag and tag not in VOID and not closed:
            if tag in RAW:
                close = scanner.end_of(tag, at)
                at = len(page) if close is None else close
            elif not (tag in SKIPPED and scanner.end_of(tag, at) is None):
                # A skipped one without an end would take the rest of the page along.
                if tag in OPTIONS:
                    while stack.open and stack.open[-1].tag in ("option", tag):
                        stack.cut(len(stack.open) - 1, articles)
                elif tag in NOT_IN_SELECT and stack.last("select") >= 0:
                    stack.cut(stack.last("select"), articles)
                if tag in ("p", "li", "td", "th", "tr", "dd", "dt", *HEADINGS) and (depth := stack.implied(tag)) >= 0:
                    stack.cut(depth, articles)
                articles = _push(stack, tag, attributes, articles, marks)
    add(page[at:])
    stack.cut(0, articles)
    kept = []
    for block in out:
        block.text = " ".join(html.unescape("".join(block.parts)).split())
        if block.text:
            kept.append(block)
    _second_look(kept, marks)
    return kept


def _push(stack: _Stack, tag: str, attributes: list[tuple[str, str]], articles: int, marks: list[Mark]) -> int:
    """Open an element; the number of articles so far."""
    above = stack.open[-1] if stack.open else Open("", None, 0, False, False, False)
    around, mark = above.article, above.mark
    if tag in ARTICLE:
        if not around:
            articles += 1
            around = articles
        if mark:
            mark.holds_main |= tag == "main"
            if around <= mark.before:
                mark.around = around
    firm = None
    if tag in ASIDE and not (tag == "header" and around):
        firm = WEAK if tag == "form" else ALWAYS
    elif tag not in ("html", "body", "main"):
        firm = _marked(attributes)
        if firm is None and tag == "article" and above.in_article:
            firm = NESTED  # as readers' comments are
    if firm is not None:
        mark = Mark(firm, mark, articles - (tag in ARTICLE and around == articles and not above.article))
        marks.append(mark)
    stack.push(
        Open(
            tag,
            mark,
            around,
            above.in_article or tag == "article",
            above.in_link or tag == "a",
            above.in_heading or tag in HEADINGS,
        )
    )
    return articles


def _second_look(found: list[Block], marks: list[Mark]) -> None:
    """Set which blocks are boilerplate: a mark around the page's main text doesn't count.

    Marks are in order of their beginning, so one that lies in another comes after it.
    """
    for mark in marks:
        mark.weak = mark.firm <= WEAK and (mark.within is None or mark.within.weak)
    total = 0
    for block in found if marks else ():
        if block.mark is None or block.mark.weak:
            n = len(_WORD.findall(block.text))
            total += n
            if block.mark:
                block.mark.words += n
        if block.mark and block.article:
            block.mark.articles.append(block.article)
    for mark in reversed(marks):
        if mark.within:
            mark.within.words += mark.words
            mark.within.holds_main |= mark.holds_main
            mark.within.around = mark.within.around or (mark.around if mark.around <= mark.within.before else 0)
    free = sorted({block.article for block in found if block.article and not block.mark})
    # The largest first, so outer ones before inner ones: what it sets free can be the page's article.
    for mark in sorted(marks, key=lambda mark: -mark.words):
        holds = mark.last > mark.before or mark.around > 0
        if mark.firm <= WEAK and _all_inside(free, mark):
            mark.void = (holds and mark.firm == WEAK) or 2 * mark.words > total
        mark.void = mark.void or (mark.firm == NESTED and 2 * mark.words > total)
        mark.void = mark.void or (mark.firm < ALWAYS and mark.holds_main)
        mark.free = mark.void and (mark.within is None or mark.within.free)
        for article in mark.articles if mark.free else ():
            place = bisect.bisect_left(free, article)
            if place == len(free) or free[place] != article:
                free.insert(place, article)
    for block in found:
        block.aside = block.mark is not None and not block.mark.free


def _all_inside(free: list[int], mark: Mark) -> bool:
    """Whether no free article lies outside of the mark."""
    inside = bisect.bisect_right(free, mark.last) - bisect.bisect_right(free, mark.before)
    if mark.around:
        place = bisect.bisect_left(free, mark.around)
        inside += place < len(free) and free[place] == mark.around
    return inside == len(free)


def _first_pass(block: Block) -> bool | None:
    words = _WORD.findall(block.text)
    if block.aside or not words and not block.article:
        return False
    links = block.linked / max(1, len(words))
    if links > LINK_HIGH:
        return False
    if len(words) >= LONG_WORDS:
        stops = sum(word in STOP_WORDS for word in (w.lower() for w in words)) / len(words)
        block.plain = links == 0
        return True if stops >= (STOP_ARTICLE if block.article else STOP_HIGH) else None
    if len(words) < SHORT_WORDS and not block.heading and not block.article and links:
        return False
    return None


def main_text(page: str | None) -> str:
    """The main text of a page, its blocks joined by one space; empty if there is none."""
    found = blocks(page or "")
    for block in found:
        block.good = _first_pass(block)
    # Where nothing has function words, they tell nothing: the language is another one.
    known_language = {block.article for block in found if block.good}
    for block in found:
        if block.good is None and block.plain and block.article not in known_language:
            block.good = True
    decided = [block.good for block in found]
    before: list[bool | None] = []
    last: dict[int, bool] = {}
    for block, label in zip(found, decided, strict=True):
        if label is not None and not block.aside:
            last[block.article] = label
        before.append(last.get(block.article))
    last = {}
    for at in range(len(found) - 1, -1, -1):
        block, label = found[at], decided[at]
        if label is not None:
            if not block.aside:
                last[block.article] = label
            continue
        ahead = last.get(block.article)
        sides = [ahead, before[at]]
        known = [side for side in sides if side is not None]
        if not known:
            # Nothing in this region was decided: an article is main text.
            block.good = bool(block.article)
        elif block.heading and ahead is not None:
            block.good = ahead or bool(block.article)
        else:
            block.good = any(known)
    return " ".join(block.text for block in found if block.good)


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages`` (``page_id, url, html``).

    A null or empty page, or one without main text, gives an empty text. Unclosed
    tags and comments end with the page. Rows that repeat or have no id are kept as
    they are; other columns are not read; an empty table gives no rows.
    """
    ship(pages.sparkSession)

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                texts = [main_text(page) for page in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string())],
                    names=["page_id", "url", "text"],
                )

    found = pages.select("page_id", "url", F.col("html").cast("string")).mapInArrow(
        run, "page_id long, url string, text string"
    )
    return found.withColumn("n_chars", F.char_length("text").cast("long"))
