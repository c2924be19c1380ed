"""Find listing cards in one HTML page (BR5). Plain Python, runs inside tasks."""

from __future__ import annotations

import re
import sys
from html.parser import HTMLParser
from urllib.parse import urljoin

from pyspark import cloudpickle

# Ship this helper with the plan, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Markers of the crawled markup.
CARD_MARK = "posting"
TEXT_MARKS = {
    "price": "POSTING_CARD_PRICE",
    "maintenance": "expensas",
    "features_text": "POSTING_CARD_FEATURES",
    "location": "POSTING_CARD_LOCATION",
    "description": "POSTING_CARD_DESCRIPTION",
    "publisher": "POSTING_CARD_PUBLISHER",
}
_MARKED = re.compile("data-qa", re.IGNORECASE)
AMENITY_CLASS = "pill-item-feature"
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta source track wbr".split()
)


#: Elements that the start of a tag closes, and those at which the search for them stops.
_LISTS, _ROWS, _CELLS = ("ul", "ol", "menu"), ("tr",), ("td", "th")
_TABLES, _GROUPS = ("table",), ("tbody", "thead", "tfoot")
IMPLIED_ENDS = {
    "li": (("li",), _LISTS),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "datalist")),
    "optgroup": (("option", "optgroup"), ("select",)),
    "td": (_CELLS, (*_ROWS, *_TABLES)),
    "th": (_CELLS, (*_ROWS, *_TABLES)),
    "tr": (_ROWS, (*_GROUPS, *_TABLES)),
    **{g: (_GROUPS, _TABLES) for g in _GROUPS},
}
# A paragraph ends where a block begins, unless something in it keeps blocks inside.
_KEEPERS = ("button", "object", "td", "th", "caption", "template")
for _block in (
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hr main menu nav ol p pre section table ul"
).split():
    IMPLIED_ENDS[_block] = (("p",), _KEEPERS)


class _Element:
    """An element's place: the stretch of the page's pieces of text that it spans."""

    __slots__ = ("card", "end", "last", "start", "tag", "words")

    def __init__(self, tag: str, start: int):
        self.tag, self.start = tag, start
        self.end: int | None = None  # None while open
        self.last: _Element | None = None  # last child element so far
        self.card: _Card | None = None
        self.words: str | None = ""

    def text(self, pieces: list[str]) -> str | None:
        """Whitespace-collapsed text, None when blank; put together once."""
        if self.words == "":
            inside = "".join(pieces[self.start : self.end])
            self.words = re.sub(r"\s+", " ", inside).strip() or None
        return self.words


class _Card:
    """A card and what the reader has met inside so far."""

    __slots__ = ("attrs", "first_pill", "image", "last_pill", "marked", "street")

    def __init__(self, attrs: dict[str, str], first_pill: int):
        self.attrs, self.first_pill = attrs, first_pill
        self.last_pill: int | None = None
        self.marked: dict[str, _Element] = {}
        self.street: _Element | None = None
        self.image: str | None = None


class _CardReader(HTMLParser):
    """Reads cards in one pass, without a tree.

    Open cards are ancestors of whatever comes next. For each mark the open cards that haven't
    met it wait on a stack; the next such element serves them all, and a card that ends
    leaves from the top. So work grows with elements and cards, however deep they nest.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.cards: list[_Card] = []
        self.pieces: list[str] = []
        self.pills: list[_Element] = []
        self._open = [_Element("", 0)]
        self._count: dict[str, int] = {}
        self._waiting: dict[str, list[_Card]] = {mark: [] for mark in (*TEXT_MARKS.values(), "img")}

    def updatepos(self, i: int, j: int) -> int:
        """Nobody asks for lines and columns, so they aren't counted."""
        return j

    def _close(self, depth: int) -> None:
        """End the open elements from ``depth`` on, innermost first."""
        while len(self._open) > depth:
            element = self._open.pop()
            self._count[element.tag] -= 1
            self._end(element)

    def _end(self, element: _Element) -> None:
        element.end = len(self.pieces)
        if element.card:
            element.card.last_pill = len(self.pills)
            for waiting in self._waiting.values():
                if waiting and waiting[-1] is element.card:
                    waiting.pop()

    def _imply(self, tag: str) -> None:
        """Close what the start of ``tag`` ends without an end tag of its own."""
        ended, within = IMPLIED_ENDS.get(tag, ((), ()))
        if not any(self._count.get(t) for t in ended):
            return
        for depth in range(len(self._open) - 1, 0, -1):
            if self._open[depth].tag in within:
                return
            if self._open[depth].tag in ended:
                self._close(depth)
                return

    def _add(self, tag: str, attrs: list[tuple[str, str | None]]) -> _Element:
        parent, element = self._open[-1], _Element(tag, len(self.pieces))
        given = {name: value or "" for name, value in attrs}
        mark = given.get("data-qa", "")
        if mark in self._waiting and mark != "img":
            for card in self._waiting[mark]:
                card.marked[mark] = element
                if mark == TEXT_MARKS["location"]:
                    card.street = parent.last
            self._waiting[mark].clear()
        if tag == "img":
            for card in self._waiting["img"]:
                card.image = given.get("src", "")
            self._waiting["img"].clear()
        if AMENITY_CLASS in given.get("class", ""):
            self.pills.append(element)
        if mark.startswith(CARD_MARK) and "data-id" in given:
            element.card = _Card(given, len(self.pills))
            self.cards.append(element.card)
            for waiting in self._waiting.values():
                waiting.append(element.card)
        parent.last = element
        return element

    def handle_starttag(self, tag, attrs):
        self._imply(tag)
        element = self._add(tag, attrs)
        if tag in VOID_TAGS:
            self._end(element)
        else:
            self._open.append(element)
            self._count[tag] = self._count.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self._end(self._add(tag, attrs))

    def handle_endtag(self, tag):
        if not self._count.get(tag):
            return
        for depth in range(len(self._open) - 1, 0, -1):
            if self._open[depth].tag == tag:
                self._close(depth)
                return

    def handle_data(self, data):
        self.pieces.append(data)

    def close(self):
        super().close()
        self._close(1)


def _record(card: _Card, reader: _CardReader, page_url: str) -> dict:
    def text(element: _Element | None) -> str | None:
        return element.text(reader.pieces) if element else None

    pills = [text(e) for e in reader.pills[card.first_pill : card.last_pill]]
    return {
        **{field: text(card.marked.get(mark)) for field, mark in TEXT_MARKS.items()},
        "id": card.attrs["data-id"],
        "posting_type": card.attrs.get("data-posting-type"),
        "url": card.attrs.get("data-to-posting"),
        "street": text(card.street),
        "amenities": [p for p in pills if p],
        "image": None if card.image is None else urljoin(page_url, card.image),
    }


def read_cards(html: str | None, page_url: str) -> list[dict]:
    """Cards of one page in document order."""
    if not html or not _MARKED.search(html):
        return []
    reader = _CardReader()
    reader.feed(html)
    reader.close()
    return [_record(card, reader, page_url) for card in reader.cards]
