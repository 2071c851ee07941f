"""Main text of web pages by the distribution of line blocks.

Markup is stripped to lines, one for each block of the page. What stands in
menus, forms, adverts and the like is marked and weighs nothing; the weight of
any other line is its text less its link text. Weights are summed over sliding
windows of lines: where the sum jumps up the article surges, where it falls to
nothing it dives, and the text between is kept. Where the page names its
article, only lines inside such elements have weight, any weight is a surge
there, and what dives is kept as well unless it is marked. Elements end as in a
browser: an end tag closes what is open inside, a paragraph or list item ends
where the next begins.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

WINDOW = 3
#: A surge needs this many characters in a window, or this share of the fullest window if that is less.
SURGE_CHARS, SURGE_SHARE = 80, 0.3

# Elements whose content is never text.
RAW = ("script", "style", "noscript", "template", "textarea", "select", "iframe", "object", "svg", "math", "canvas", "title", "video", "audio")
# Elements that end a line where they start and end.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
# Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that hold no part of an article.
OUTSIDE = frozenset("nav footer aside form button dialog menu head".split())
# Words in class, id and role that mark such elements.
OUTSIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "popup modal overlay nav navbar navigation menu breadcrumb breadcrumbs sidebar widget widgets footer header masthead topbar comment comments "
    "disqus respond reply replies share sharing social related recommended recommendations newsletter subscribe subscription signup login search "
    "pagination pager toolbar copyright contentinfo complementary alert alertdialog dialog form hidden".split()
)
# Words that mark the article itself.
INSIDE_WORDS = frozenset(("articlebody", "main"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|</?[a-zA-Z][^>]*(?:>|\Z)",
    re.S | re.I,
)
_NAMES = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s/=]|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Line:
    text: str
    links: int
    article: int  # number of the outermost article element it is in, 0: none
    outside: bool
    heading: bool


# Elements that a later start ends, with the starts that do and the elements that bound the search.
ENDED_BY = {
    "li": (frozenset(("li",)), frozenset("ul ol menu".split())),
    "dt": (frozenset("dt dd".split()), frozenset(("dl",))),
    "dd": (frozenset("dt dd".split()), frozenset(("dl",))),
    "td": (frozenset("td th tr tbody tfoot".split()), frozenset(("table",))),
    "th": (frozenset("td th tr tbody tfoot".split()), frozenset(("table",))),
    "tr": (frozenset("tr tbody tfoot".split()), frozenset(("table",))),
    "option": (frozenset("option optgroup".split()), frozenset(("select",))),
}
# Words before a mark that make it say something else, and elements that hold text themselves.
NO_MARK = frozenset("has have with without no not is show hide market".split())
TEXT_ELEMENTS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th blockquote pre figure figcaption".split())
_CELLS = frozenset("td th".split())


def _attributes(rest: str) -> tuple[list[list[str]], set[str]]:
    """Words of each name in class, id and role, and whole itemprop and role values, in lower case."""
    names, whole = [], set()
    for kind, *values in _NAMES.findall(rest):
        value = "".join(values)
        if kind.lower() in ("itemprop", "role"):
            whole.add(value.lower())
        names += [[word.lower() for word in _WORDS.findall(name)] for name in value.split()]
    return names, whole


def _is_marked(element: str, names: list[list[str]], marks: frozenset[str]) -> bool:
    """Whether a name says that the element is no part of the article.

    One word of a name is enough, unless a word before it says otherwise
    ("has-sidebar"); an element that holds text itself needs all words of one.
    """
    for words in names:
        if element in TEXT_ELEMENTS:
            if words and marks.issuperset(words):
                return True
        elif any(word in marks and NO_MARK.isdisjoint(words[:i]) for i, word in enumerate(words)):
            return True
    return False


@dataclass
class _Open:
    """An open element: whether it is outside, and the number of the article it begins."""

    name: str
    outside: bool = False
    article: int = 0


class _Page:
    """The open elements of a page, closed as a browser would: end tags may be missing."""

    def __init__(self):
        self.open: list[_Open] = []
        self.names: Counter[str] = Counter()
        self.outside = 0
        self.article: list[int] = []
        self.articles = 0

    def push(self, element: _Open) -> None:
        self.open.append(element)
        self.names[element.name] += 1
        self.outside += element.outside
        if element.article:
            self.article.append(element.article)

    def pop(self) -> None:
        element = self.open.pop()
        self.names[element.name] -= 1
        self.outside -= element.outside
        if element.article:
            self.article.pop()

    def end(self, name: str) -> None:
        """Close an element and all that is open in it; an inline one not beyond the block it is in."""
        if not self.names[name]:
            return
        place = len(self.open) - 1
        while self.open[place].name != name:
            if name not in BLOCKS and name not in _CELLS and self.open[place].name in BLOCKS:
                return
            place -= 1
        while len(self.open) > place:
            self.pop()

    def start(self, name: str) -> None:
        """Close what the start of an element ends: a paragraph, or an item of the same list or table."""
        if name in BLOCKS and self.names["p"]:
            place = len(self.open) - 1
            while place >= 0 and (self.open[place].name == "p" or self.open[place].name not in BLOCKS):
                if self.open[place].name == "p":
                    self.end("p")
                    break
                place -= 1
        for old, (by, bounds) in ENDED_BY.items():
            if name in by and self.names[old]:
                place = len(self.open) - 1
                while place >= 0 and self.open[place].name not in bounds and self.open[place].name != old:
                    place -= 1
                if place >= 0 and self.open[place].name == old:
                    while len(self.open) > place:
                        self.pop()


def lines_of(page: str) -> list[Line]:
    """Lines of a page in order, each with where it stands. Cut-off pages end where they end."""
    lines: list[Line] = []
    # Text of the line so far, of the article and of marked elements within the line.
    parts: list[str] = []
    marked: list[str] = []
    links = depth_a = 0
    state, heading = _Page(), False

    def close_line():
        nonlocal links, parts, marked
        for own, outside in ((parts, False), (marked, True)):
            text = " ".join(html.unescape("".join(own)).split())
            if text:
                lines.append(Line(text, min(links, len(text)), state.article[0] if state.article else 0, outside, heading))
                break
        parts, marked, links = [], [], 0

    at = 0
    for found in _TOKEN.finditer(page):
        if found.start() > at:
            text = page[at : found.start()]
            (marked if state.outside else parts).append(text)
            if depth_a and not state.outside:
                links += len(text)
        at = found.end()
        name = (found["name"] or "").lower()
        if not name:
            continue
        if name in BLOCKS:
            close_line()
        elif name in ("br", "td", "th"):
            (marked if state.outside else parts).append(" ")
        ending, rest = bool(found["end"]), found["rest"] or ""
        if name == "a":
            depth_a = max(0, depth_a + (-1 if ending else 1))
        if name in HEADINGS:
            heading = not ending
        if name in VOID or rest.endswith("/"):
            continue
        if ending:
            state.end(name)
            continue
        state.start(name)
        names, whole = _attributes(rest) if rest else ([], set())
        starts = name in ("article", "main") or "articlebody" in whole or "main" in whole
        if starts and not _is_marked(name, names, OUTSIDE_WORDS):
            if not state.article:
                # An article never stands inside a menu or an advert: one that was not closed ends here.
                for element in state.open:
                    element.outside = False
                state.outside = 0
            if not state.outside:
                state.articles += not state.article
                state.push(_Open(name, article=state.articles))
                continue
        inside = bool(state.article)
        marks = OUTSIDE_WORDS - {"header"} if inside else OUTSIDE_WORDS
        outside = name in OUTSIDE or (name == "header" and not inside) or _is_marked(name, names, marks)
        state.push(_Open(name, (outside and name not in ("html", "body")) or bool(_HIDDEN.search(rest))))
    (marked if state.outside else parts).append(page[at:])
    close_line()
    return lines


def surge_and_dive(weights: list[int], need: float | None = None) -> list[tuple[int, int]]:
    """Line ranges from a surge to its dive. A window sums ``WINDOW`` lines from its first on."""
    windows = [sum(weights[i : i + WINDOW]) for i in range(len(weights))]
    if need is None:
        need = min(SURGE_CHARS, SURGE_SHARE * max(windows, default=0))
    ranges, begin = [], None
    for i, total in enumerate(windows):
        if begin is None and weights[i] and total > need:
            begin = i
        elif begin is not None and total == 0:
            ranges.append((begin, i))
            begin = None
    if begin is not None:
        ranges.append((begin, len(weights)))
    return ranges


def _but_link_lists(lines: list[Line], weights: list[int], begin: int, end: int) -> list[int]:
    """Unmarked lines of a dive, without those of lists of links (a window or more of them in a row)."""
    kept, run = [], []
    for i in range(begin, end):
        if not lines[i].outside and not weights[i]:
            run.append(i)
            continue
        kept += run if len(run) < WINDOW else []
        kept += [] if lines[i].outside else [i]
        run = []
    return kept + (run if len(run) < WINDOW else [])


def main_text(page: str) -> str:
    """The article's blocks joined by line ends; empty if the page has none."""
    lines = lines_of(page)
    named = any(line.article and not line.outside for line in lines)
    for line in lines:
        line.outside = line.outside or (named and not line.article)
    weights = [0 if line.outside else max(0, len(line.text) - 2 * line.links) for line in lines]
    ranges = surge_and_dive(weights, 0 if named else None)
    kept = [i for begin, end in ranges for i in range(begin, end)]
    dives = list(zip([0, *(end for _, end in ranges)], [*(begin for begin, _ in ranges), len(lines)]))
    if not named:
        # Only headings before the first surge; nothing after the last dive.
        begin = dives[0][1]
        while begin and ranges and lines[begin - 1].heading and not lines[begin - 1].outside:
            begin -= 1
        kept += range(begin, dives[0][1])
        dives = dives[1:-1]
    # What stands between ranges is of the article, but for lists of links. Where the page names its
    # article, all of that is, also before and after, and links in it are text.
    for begin, end in dives:
        kept += range(begin, end) if named else _but_link_lists(lines, weights, begin, end)
    return "\n".join(lines[i].text for i in sorted(kept) if not lines[i].outside)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page or "") for page in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points) of every page.

    ``pages`` has ``page_id``, ``url`` and ``html``; other columns are ignored.
    A null or empty page and one without an article give an empty text. Rows
    are taken one by one, so repeated rows give repeated results.
    """
    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(_extract, f"page_id {kind}, url string, text string, n_chars bigint")


def op9_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract(spark.read.parquet(f"{folder}/pages.parquet"))
