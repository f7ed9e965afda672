"""HTML extraction: the article's text without what surrounds it.

The standard library's parser streams events. They are gathered into lines, one per block of the
page, each with its text, its tags, its linked text and the container it stands in. The ratio of
text to tags per line is smoothed by a Gaussian over the neighbouring lines, and two clusters of
the smoothed ratios give the threshold above which a line marks content. The containers that
hold such lines are the content regions, with the containers within them, the siblings of their
tag and class, and the siblings of their tag between them. Where the articles among them (or else
the main part) hold most of the page's unlinked text, they are the regions alone, articles with
the articles beside them. Regions that are lists of links go; all lines of the others are kept,
so that short paragraphs and sections of an article stay. So do unlinked paragraphs that stand
in the body itself after the first region, and the title: the last first-level heading before
the regions, unless they have one. Elements that by tag or role hold menus, headers, footers,
sidebars, adverts, forms, scripts or styles never give lines.

Names (class or id) are weaker evidence, but for those of reader comments. Outside an article a block with the name of a menu,
notice, advert or the like goes unless it holds most of the unlinked text of a page without
article, in its main part if it has one. Lists of links in the body itself are menus. Inside an
article paragraphs and headings stay whatever their name; a block goes if one of its names says
so from end to end (``share-buttons``, not ``search-trees``), and if it is a name that articles
use in their text, too (``social``), only if it is short or mostly links. A short line of
copyright outside articles is a footer.

Defined results: a null page is the empty page; a page without content has the empty text. Pages
may be cut off anywhere and tags may stay open. Repeated pages are extracted alike; an empty table
gives no rows. Only id, URL and page are read, so other columns do not matter. Time and memory
are in proportion to the page.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence, Set
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.shared import ship

VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: Elements that begin and end a line.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol option p pre section select summary table tbody td tfoot th thead title "
    "tr ul".split()
)
#: Elements whose text is never content.
SKIPPED = frozenset(
    "aside button canvas datalist dialog embed fieldset footer form head header iframe input "
    "label legend menu nav noscript object option script select style svg template textarea "
    "title".split()
)
SKIPPED_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation "
    "search status toolbar".split()
)
#: Words in the class or id of an element whose text is never content.
SKIPPED_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment "
    "comments consent cookie cookies disqus footer gdpr header login masthead menu modal nav "
    "navbar navigation newsletter notice notices notification overlay pagination popup promo "
    "promotion related replies respond search share sharing sidebar signup social sponsor "
    "sponsored subscribe subscription toolbar widget".split()
)
#: Of these, names that sections of an article may have as well.
WEAK_NAMES = frozenset(
    "banner header login menu modal notice notices notification overlay popup promo promotion "
    "related replies respond search share sharing signup social sponsor sponsored subscribe "
    "subscription toolbar widget".split()
)
#: Names of reader comments, which are often longer than the article: these always go.
COMMENT_NAMES = frozenset("comments disqus".split())
#: Parts of a name that an article gives its own head.
ARTICLE_NAMES = frozenset("article content entry page post story".split())
#: Parts of a name that say how something looks, not what it is.
PLAIN_NAMES = frozenset(
    "area article bar block blog body bottom box btn button buttons col column container content entry "
    "form group icons inner item items left link links list main module outer page panel post "
    "posts right row section site story text thread top user wrap wrapper".split()
)
#: Elements of running text: inside an article their names do not exclude them.
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li td th dd dt pre blockquote figcaption".split())
#: A weakly named block of an article with more unlinked characters than this stays.
SHORT_BLOCK = 80
#: So many items in a row that are links make a menu.
MENU_ITEMS = 3
COPYRIGHT = re.compile(r"(?i)^(?:©|\(c\)\s|copyright\b)")
COPYRIGHT_CHARS = 200
#: These parts of a name take the meaning from the next one, as in ``has-sidebar``.
NEGATED = re.compile(r"(?i)^(?:has|no|with|without)[-_]")
#: Elements that hold the whole page or its article: their class does not exclude them.
KEPT = frozenset("html body main article".split())
CONTAINERS = frozenset("article main section div td body html".split())
#: An open element of the second kind is closed by a new one of the first.
CLOSED_BY = {
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "td", "th"}),
    "td": frozenset({"td", "th"}),
    "th": frozenset({"td", "th"}),
    "option": frozenset({"option"}),
}
#: What an implied end tag does not reach beyond.
SCOPES = frozenset("ul ol dl table select div section article main body html".split())

PARAGRAPH = frozenset({"p"})

SIGMA = 1.5
NAME_PART = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
#: White space that HTML collapses; the no-break space counts as white space, too.
GAP = re.compile(r"\s+")


@dataclass
class Line:
    """One block of text: its pieces, how many tags and linked characters, and its container."""

    container: int
    tag: str = ""
    #: The doubtful block it stands in (0: none).
    doubt: int = 0
    in_article: bool = False
    in_main: bool = False
    pieces: list[str] = field(default_factory=list)
    tags: int = 0
    linked: int = 0

    def text(self) -> str:
        return GAP.sub(" ", "".join(self.pieces)).strip()


@dataclass(frozen=True)
class Doubt:
    """A block whose name says it is not content: the doubtful one around it, whether it is in an
    article or the main part, whether its name is that of an article's own head."""

    around: int = 0
    in_article: bool = False
    in_main: bool = False
    own_head: bool = False


@dataclass(frozen=True)
class Open:
    """An open element: whether its text is skipped, its container, whether in an article."""

    tag: str
    skipped: bool = False
    container: int = 0
    in_article: bool = False
    in_main: bool = False
    block: str = ""
    doubt: int = 0


class Events(HTMLParser):
    """Gathers the parser's events into lines."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.line: Line | None = None
        self.open = [Open("")]
        self.counts: dict[str, int] = {}
        self.containers = [""]
        #: Per container the one around it and its class.
        self.within = [0]
        self.classes = [""]
        self.doubts = [Doubt()]

    def _end_line(self) -> None:
        if self.line is not None:
            self.lines.append(self.line)
            self.line = None

    def _close(self, tags: Set[str], within: Set[str] = frozenset()) -> None:
        """Close the innermost open element of these tags, unless one of ``within`` is nearer."""
        counts, stack = self.counts, self.open
        if not any(map(counts.get, tags)):
            return
        for at in range(len(stack) - 1, 0, -1):
            tag = stack[at].tag
            if tag in tags:
                for element in stack[at:]:
                    counts[element.tag] -= 1
                del stack[at:]
                return
            if tag in within:
                return

    def updatepos(self, i: int, j: int) -> int:
        """Nobody asks for line numbers."""
        return j

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self._end_line()
            if self.counts.get("p"):
                self._close(PARAGRAPH, BLOCKS)
        if tag in CLOSED_BY:
            self._close(CLOSED_BY[tag], SCOPES)
        if self.line is not None:
            self.line.tags += 1
            if tag == "br":
                self.line.pieces.append(" ")
        if tag in VOID:
            return
        above = self.open[-1]
        container, in_article = above.container, above.in_article or tag == "article"
        if tag in CONTAINERS and not above.in_article:
            container = len(self.containers)
            self.containers.append(tag)
            self.within.append(above.container)
            self.classes.append(" ".join(v or "" for k, v in attrs if k == "class"))
        skipped = above.skipped or _excluded(tag, attrs, above.in_article)
        doubt = above.doubt
        if not skipped and tag in BLOCKS and tag not in KEPT:
            named, parts = _named(tag, attrs, above.in_article)
            if named == "comments" or (named == "strong" and above.in_article):
                skipped = True
            elif named:
                doubt = len(self.doubts)
                own_head = "header" in parts and bool(parts & ARTICLE_NAMES)
                self.doubts.append(
                    Doubt(above.doubt, above.in_article, above.in_main, own_head)
                )
        block = tag if tag in BLOCKS else above.block
        in_main = above.in_main or tag == "main"
        self.open.append(Open(tag, skipped, container, in_article, in_main, block, doubt))
        self.counts[tag] = self.counts.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if self.counts.get("svg") or tag == "svg":  # elsewhere HTML takes it for a start tag
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self._end_line()
        elif self.line is not None:
            self.line.tags += 1
        if self.counts.get(tag):
            self._close({tag})

    def handle_data(self, data: str) -> None:
        here = self.open[-1]
        if here.skipped:
            return
        if self.line is None:
            if not data.strip():
                return
            self.line = Line(
                here.container, here.block, here.doubt, here.in_article, here.in_main
            )
        self.line.pieces.append(data)
        if self.counts.get("a"):
            self.line.linked += len(data.strip())

    def finished(self) -> list[Line]:
        self.close()
        self._end_line()
        return self.lines


def _excluded(tag: str, attrs: Sequence[tuple[str, str | None]], in_article: bool) -> bool:
    """Whether an element's text is never content. An article's own header holds its title."""
    if tag in SKIPPED:
        return not (tag == "header" and in_article)
    for name, value in attrs:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if not value:
            continue
        if name == "style" and re.search(r"display\s*:\s*none", value, re.IGNORECASE):
            return True
        if tag not in BLOCKS or tag in KEPT:
            continue
        if name == "role" and value.strip().lower() in SKIPPED_ROLES:
            return True
    return False


def _named(
    tag: str, attrs: Sequence[tuple[str, str | None]], in_article: bool
) -> tuple[str, set[str]]:
    """What a block's class and id say: "" (content), "weak", "strong" or "comments" (not
    content), and the parts of the name that says so."""
    found: tuple[str, set[str]] = "", set()
    for name, value in attrs:
        if name not in ("class", "id") or not value:
            continue
        for token in value.split():
            if NEGATED.match(token):
                continue
            ordered = [part.lower() for part in NAME_PART.findall(token)]
            parts = set(ordered)
            if parts & COMMENT_NAMES or ordered[:1] == ["comment"]:
                return "comments", parts
            said = parts & SKIPPED_NAMES
            if in_article:
                said = set() if tag in PROSE else said - {"header"}
            if not said:
                continue
            whole = not in_article or not parts - SKIPPED_NAMES - PLAIN_NAMES
            strong = bool(said - WEAK_NAMES)
            if strong and whole:
                found = "strong", parts
            elif (strong or whole) and not found[0]:
                found = "weak", parts
    return found


def _doubted(events: Events, lines: Sequence[tuple[str, Line]]) -> set[int]:
    """The doubtful blocks whose text is not content, with all within them."""
    plain, chars = [0] * len(events.doubts), [0] * len(events.doubts)
    for text, line in lines:
        plain[line.doubt] += max(0, len(text) - line.linked)
        chars[line.doubt] += len(text)
    total = sum(plain)
    article = any(line.in_article and not line.doubt for _, line in lines)
    main = any(line.in_main for _, line in lines)
    for at in range(len(plain) - 1, 0, -1):  # a block comes after the one around it
        plain[events.doubts[at].around] += plain[at]
        chars[events.doubts[at].around] += chars[at]
    out: set[int] = set()
    for at, doubt in enumerate(events.doubts[1:], 1):
        if doubt.in_article:
            stays = plain[at] > SHORT_BLOCK and 2 * plain[at] >= chars[at]
        else:
            stays = 2 * plain[at] > total and not article and doubt.in_main >= main
        if doubt.around in out or not stays:
            out.add(at)
    return out


def _menus(events: Events, lines: Sequence[tuple[str, Line]]) -> set[int]:
    """The places of list items in the body itself that stand in runs of links."""
    out: set[int] = set()
    run: list[int] = []
    for at, (text, line) in enumerate([*lines, ("", Line(0))]):
        loose = events.containers[line.container] in ("", "html", "body")
        if line.tag == "li" and loose and not line.in_article and 2 * line.linked > len(text):
            run.append(at)
            continue
        if len(run) >= MENU_ITEMS:
            out.update(run)
        run = []
    return out


def ratios(lines: Sequence[tuple[str, Line]]) -> list[float]:
    """Unlinked characters per tag of each line."""
    return [max(0, len(text) - line.linked) / max(1, line.tags) for text, line in lines]


def smoothed(values: Sequence[float], sigma: float = SIGMA) -> list[float]:
    """Values averaged with their neighbours under Gaussian weights."""
    reach = math.ceil(2 * sigma)
    weights = [math.exp(-(d * d) / (2 * sigma * sigma)) for d in range(-reach, reach + 1)]
    n = len(values)
    sums, norms = [0.0] * n, [0.0] * n
    for d, weight in zip(range(-reach, reach + 1), weights, strict=True):
        for i in range(max(0, -d), min(n, n - d)):
            sums[i] += weight * values[i + d]
            norms[i] += weight
    return [x / w for x, w in zip(sums, norms, strict=True)]


def threshold(values: Sequence[float]) -> float:
    """The middle between two clusters of the values (one-dimensional two-means).

    Lines at or above it mark content; with equal values all of them do.
    """
    low, high = min(values), max(values)
    for _ in range(50):
        middle = (low + high) / 2
        below = [v for v in values if v < middle]
        above = [v for v in values if v >= middle]
        new = (sum(below) / len(below) if below else low, sum(above) / len(above))
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def _inside(events: Events, chosen: Set[int]) -> set[int]:
    """The containers and all within them. A container comes after the one around it."""
    out = set(chosen)
    for at in range(1, len(events.containers)):
        if events.within[at] in out:
            out.add(at)
    return out


def _around(events: Events, chosen: Set[int], kind: str) -> set[int]:
    """The elements of this kind that hold a chosen container, and the containers within them."""
    holders = [0] * len(events.containers)
    for at in range(1, len(holders)):
        holders[at] = at if events.containers[at] == kind else holders[events.within[at]]
    return _inside(events, {holders[c] for c in chosen} - {0})


def _with_siblings(events: Events, chosen: Set[int]) -> set[int]:
    """The containers and their siblings of the same tag, by class or by place."""
    ends: dict[tuple[int, str], tuple[int, int]] = {}
    kinds = set()
    for at in sorted(chosen - {0}):
        key = events.within[at], events.containers[at]
        ends[key] = ends.get(key, (at, at))[0], at
        kinds.add((*key, events.classes[at]))
    out = set(chosen)
    for at in range(1, len(events.containers)):
        key = events.within[at], events.containers[at]
        first, last = ends.get(key, (at + 1, at))
        if first <= at <= last or (*key, events.classes[at]) in kinds:
            out.add(at)
    return out


def extract(html: str) -> str:
    """The main text of a page: its content blocks in page order, joined by two line ends."""
    last = html.rfind("<")
    if last >= 0 and ">" not in html[last:] and re.match(r"[/!?A-Za-z]", html[last + 1 :]):
        html = html[:last]  # the page was cut off in a tag
    events = Events()
    events.feed(html)
    every = [(text, line) for line in events.finished() if (text := line.text())]
    doubted, menus = _doubted(events, every), _menus(events, every)
    lines = [
        (text, line)
        for at, (text, line) in enumerate(every)
        if line.doubt not in doubted
        and at not in menus
        and (line.in_article or len(text) > COPYRIGHT_CHARS or not COPYRIGHT.match(text))
    ]
    if not lines:
        return ""
    values = smoothed(ratios(lines))
    limit = threshold(values)
    regions = {
        line.container for (_, line), value in zip(lines, values, strict=True) if value >= limit
    }
    linked, chars, prose = Counter(), Counter(), Counter()
    for text, line in lines:
        linked[line.container] += line.linked
        chars[line.container] += len(text)
        prose[line.container] += line.tag == "p"
    plain = {c: max(0, chars[c] - linked[c]) for c in chars}
    for kind in ("article", "main"):
        inner = _around(events, regions, kind)
        if kind == "article" and inner:
            inner |= _beside(events, inner)
        if inner and 2 * sum(plain.get(c, 0) for c in inner) > sum(plain.values()):
            regions = inner
            break
    else:
        whole = {c for c in regions if events.containers[c] not in ("", "html", "body")}
        regions = regions | _inside(events, _with_siblings(events, whole))
        kind = ""
    # inside the main part paragraphs of links are references; elsewhere they are menus
    lists = {c for c in regions if 2 * linked[c] > chars[c] and not (kind and prose[c])}
    regions = (regions - lists) or regions
    return "\n\n".join(_chosen(events, every, lines, regions, kind))


def _beside(events: Events, inner: Set[int]) -> set[int]:
    """The articles that stand beside one of these, in the same container."""
    around = {events.within[c] for c in inner if events.containers[c] == "article"}
    return _inside(
        events,
        {
            c
            for c in range(1, len(events.containers))
            if events.containers[c] == "article" and events.within[c] in around
        },
    )


def _chosen(
    events: Events,
    every: Sequence[tuple[str, Line]],
    lines: Sequence[tuple[str, Line]],
    regions: Set[int],
    kind: str,
) -> list[str]:
    """The texts of the regions' lines, with a title before and loose paragraphs after the first.

    ``every`` has the lines of doubtful blocks, too, in which a title may stand.
    """
    allowed = {id(line) for _, line in lines}
    first = next(i for i, (_, line) in enumerate(every) if _in(line, regions, allowed))
    titled = any(line.tag == "h1" and _in(line, regions, allowed) for _, line in every)
    titles = [
        i
        for i, (_, line) in enumerate(every[:first])
        if line.tag == "h1"
        and not line.linked
        and (id(line) in allowed or events.doubts[line.doubt].own_head)
    ]
    title = titles[-1] if titles and not titled else None
    out = []
    for i, (text, line) in enumerate(every):
        loose = (
            not kind
            and i > first
            and id(line) in allowed
            and events.containers[line.container] in ("", "html", "body")
            and line.tag in PROSE
            and 2 * line.linked <= len(text)
        )
        if i == title or loose or _in(line, regions, allowed):
            out.append(text)
    return out


def _in(line: Line, regions: Set[int], allowed: Set[int]) -> bool:
    return line.container in regions and id(line) in allowed


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [extract(html or "") for html in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(texts, pa.string()),
                pa.array(map(len, texts), pa.int64()),
            ],
            ["page_id", "url", "text", "n_chars"],
        )


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, main text and its length in code points of every page."""
    ship(pages.sparkSession)
    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(
        _extracted, "page_id long, url string, text string, n_chars long"
    )
