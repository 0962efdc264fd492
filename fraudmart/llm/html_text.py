"""Main text of web pages by line-block distribution.

1. The markup is read in one pass into lines: a line is the text of one block
   element (its character references decoded, white space turned into single
   spaces). What is plainly no prose by its markup is stripped with it: scripts,
   styles, forms, menus, headers and footers of the page, sidebars, and elements
   whose class, id or role names adverts, notices, comments and the like. A
   stripped line stays as an empty one, and edges of boxes leave empty lines too.
2. Each line has a length: that of its text, outside an article less that of its
   links. Windows of ``WIDTH`` lines are summed. A surge is a window that rises
   from nothing, a dive one that falls back to nothing.
3. Text between a surge and its dive is kept where it lies in the page's article,
   or, on pages that mark none, where a window reaches ``SURGE``; if none does, the
   longest such passage.

Broken markup: an element that is never closed ends with its parent, and a
stripped one that is never closed ends where the next part of the page begins;
what follows the last ``<`` of a cut page, if it is no text, is dropped.

Defined results: NULL or empty html, or none that holds text, gives an empty
text; repeated rows each give theirs; ties of the longest passage go to the
first; pages of any length are read whole, in time and memory in proportion to
them; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from html import unescape
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudmart.llm.shared import in_tasks

WIDTH = 3
SURGE = 86
#: pages that a task reads at a time
ROWS = 256

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: read as raw text up to their own end tag
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
#: never prose
STRIPPED = frozenset("aside audio button canvas datalist dialog embed footer form head math menu "
                     "nav noscript object option progress select svg template video".split())
BOXES = frozenset("article aside body center dialog div fieldset footer form header html main nav "
                  "noscript section table".split())
BLOCKS = BOXES | frozenset(
    "address blockquote caption dd details dir dl dt figcaption figure h1 h2 h3 h4 h5 h6 head "
    "hgroup hr legend li menu ol option p pre search select summary tbody tfoot thead title tr "
    "ul".split())
#: parts of a page: a window never reaches across their edges
PARTS = frozenset("article aside footer form header main nav".split())
#: what the next one of a name closes, and the elements that it does not reach beyond
CLOSES = {"li": (("li",), frozenset(("ul", "ol", "menu", "dir"))),
          "dt": (("dt", "dd"), frozenset(("dl",))), "dd": (("dt", "dd"), frozenset(("dl",))),
          "tr": (("tr",), frozenset(("table",))), "option": (("option",), frozenset(("select",))),
          "td": (("td", "th"), frozenset(("tr", "table"))),
          "th": (("td", "th"), frozenset(("tr", "table")))}
#: words of class, id and role that mark parts other than prose
OTHERS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment "
    "comments consent cookie cookies copyright disclaimer disqus footer gdpr masthead menu modal "
    "nav navbar navigation newsletter notice notices pager pagination popup promo promoted related "
    "replies reply respond share sharing sidebar sidebars skip social sponsor sponsored subscribe "
    "subscription teaser teasers toolbar topbar widget widgets".split())
#: of these, boxes that may wrap the article itself
WRAPPERS = frozenset("banner footer masthead menu nav navbar navigation notice sidebar sidebars "
                     "toolbar topbar widget widgets skip".split())
MARKUP = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|</(?P<end>[a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"
    r"|</[^a-zA-Z][^>]*+(?:>|\Z)"
    r"|<(?P<open>[a-zA-Z][^\s/>]*+)"
    r"(?P<attrs>(?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))?+)*+)(?P<close>>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?")
HINTS = re.compile(r"class|id\s*=|role|hidden|style", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_RAW_END = {n: re.compile(rf"</{n}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for n in RAW}


class Run:
    """A piece of text between two tags."""

    __slots__ = ("line", "place", "text", "link", "kept", "prose")

    def __init__(self, line: int, place: int, text: str, link: bool):
        self.line, self.place, self.text, self.link = line, place, text, link
        self.kept, self.prose = True, False


class Box:
    """An element whose text is stripped or is the article: runs ``first`` to ``end``."""

    __slots__ = ("first", "end", "closed", "kind", "serial", "later")

    def __init__(self, first: int, kind: str, serial: int, later: int):
        self.first, self.kind, self.serial, self.later = first, kind, serial, later
        self.end, self.closed = -1, False


def _kind(name: str, attrs: str, in_article: bool) -> str:
    """'article', 'main', 'stripped', 'wrapper' (stripped unless it holds the article) or ''."""
    named: set[str] = set()
    role = ""
    if attrs and HINTS.search(attrs):
        found: dict[str, str] = {}
        for k, *values in ATTRIBUTE.findall(attrs):
            found.setdefault(k.lower(), "".join(values))
        if "hidden" in found or re.search(r"display\s*:\s*none", found.get("style", ""), re.I):
            return "stripped"
        role = found.get("role", "").strip().lower()
        names = " ".join(found.get(k, "") for k in ("class", "id", "role"))
        named = {w.lower() for w in WORDS.findall(names)}
    if name in STRIPPED:
        return "stripped"
    if name not in ("html", "body", "main") and named & OTHERS:
        return "stripped" if named & (OTHERS - WRAPPERS) else "wrapper"
    if name == "article" or role == "article":
        return "article"
    if name == "main" or role == "main":
        return "main"
    return "wrapper" if name == "header" and not in_article else ""


def read(html: str) -> tuple[list[Run], bool]:
    """The page's runs of text, and whether it marks an article."""
    runs: list[Run] = []
    stack: list[tuple[str, Box | None]] = []
    boxes: list[Box] = []
    starts: list[int] = []  # runs at which a part of the page begins
    opened: Counter = Counter()  # elements on the stack
    inside = 0  # articles among them
    line = place = at = 0

    def text(piece: str) -> None:
        if piece and (piece.strip() or (runs and runs[-1].line == line)):
            runs.append(Run(line, place, piece, opened["a"] > 0))

    def edge(name: str) -> None:
        nonlocal line, place
        line += 1
        place += 1 + (WIDTH if name in PARTS else name in BOXES)

    def close(down_to: int, explicit: bool) -> None:
        nonlocal inside
        while len(stack) > down_to:
            name, box = stack.pop()
            opened[name] -= 1
            if box:
                box.end = len(runs)
                box.closed = explicit and len(stack) == down_to
                inside -= box.kind == "article"

    def close_open(names: tuple[str, ...], within: frozenset) -> None:
        if not any(opened[n] for n in names):
            return
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                return close(i, True)
            if stack[i][0] in within or stack[i][0] in PARTS:
                return None

    while at < len(html):
        m = MARKUP.search(html, at)
        text(html[at:m.start()] if m else html[at:])
        if not m:
            break
        at = m.end()
        if m["end"]:
            name = m["end"].lower()
            if name == "br":
                text(" ")
            if name in BLOCKS:
                edge(name)
            if opened[name]:
                i = len(stack) - 1
                while stack[i][0] != name:
                    i -= 1
                close(i, True)
        elif m["open"] and m["close"]:
            name = m["open"].lower()
            if name in RAW:
                end = _RAW_END[name].search(html, at)
                at = end.end() if end else len(html)
                continue
            if name in BLOCKS:
                close_open(("p",), BOXES)
                edge(name)
            elif name in ("br", "td", "th"):
                text(" ")
            if name in CLOSES:
                close_open(*CLOSES[name])
            if name in VOID:
                continue
            kind = _kind(name, m["attrs"], inside > 0)
            if name in PARTS or kind in ("article", "main"):
                starts.append(len(runs))
            box = Box(len(runs), kind, len(boxes), len(starts)) if kind else None
            if box:
                boxes.append(box)
                inside += kind == "article"
            opened[name] += 1
            stack.append((name, box))
    close(0, False)
    return runs, _mark(runs, boxes, starts)


def _mark(runs: list[Run], boxes: list[Box], starts: list[int]) -> bool:
    """Tells each run whether it is kept and lies in the article; is there an article?"""
    kind = "article" if any(b.kind == "article" for b in boxes) else "main"
    articles = [b.serial for b in boxes if b.kind == kind]
    drops, prose = [0] * (len(runs) + 2), [0] * (len(runs) + 2)
    for b in boxes:
        if b.kind in ("article", "main"):
            prose[b.first] += b.kind == kind
            prose[b.end] -= b.kind == kind
            continue
        end = b.end
        if not b.closed and b.later < len(starts):
            end = min(end, starts[b.later])
        elif b.kind == "wrapper":
            k = bisect_right(articles, b.serial)
            if k < len(articles) and boxes[articles[k]].first < b.end:
                continue
        drops[b.first] += 1
        drops[end] -= 1
    dropped = list(accumulate(drops))
    for r, gone, there in zip(runs, dropped, accumulate(prose)):
        r.kept, r.prose = not gone, there > 0
    return any(not dropped[boxes[a].first] for a in articles)


def lines(runs: list[Run], article: bool) -> list[tuple[int, str, int]]:
    """(place, text, length that counts) of each line; stripped text is empty."""
    out: list[tuple[int, str, int]] = []
    at = 0
    while at < len(runs):
        end = at
        while end < len(runs) and runs[end].line == runs[at].line:
            end += 1
        mine = [r for r in runs[at:end] if r.kept and (r.prose or not article)]
        text = " ".join(unescape("".join(r.text for r in mine)).split())
        links = 0 if article else sum(len(r.text.strip()) for r in mine if r.link)
        if text:
            out.append((runs[at].place, text, max(0, len(text) - links)))
        at = end
    return out


def passages(found: list[tuple[int, str, int]], width: int = WIDTH):
    """Lines from a surge of the window sums to their dive, with the greatest sum between."""
    group: list[tuple[int, str, int]] = []
    for row in found:
        # a window holds lines less than `width` places apart: no window, no text between
        if group and row[0] - last >= width:
            yield group, _peak(group, width)
            group = []
        if row[2] or group:
            group.append(row)
        if row[2]:
            last = row[0]
    if group:
        yield group, _peak(group, width)


def _peak(group: list[tuple[int, str, int]], width: int) -> int:
    """The greatest sum of a window of ``width`` places."""
    best = total = lo = 0
    for place, _, size in group:
        total += size
        while group[lo][0] <= place - width:
            total -= group[lo][2]
            lo += 1
        best = max(best, total)
    return best


def main_text(html: str | None, width: int = WIDTH, surge: int = SURGE) -> str:
    """The page's main text, its blocks joined by an empty line."""
    runs, article = read(html or "")
    found = lines(runs, article)
    parts = list(passages(found, width))
    if article:
        kept = [g for g, _ in parts]
    else:
        kept = [g for g, peak in parts if peak >= surge]
        if parts and not kept:
            kept = [max((g for g, _ in parts), key=lambda g: sum(x[2] for x in g))]
    return "\n\n".join(text for g in kept for _, text, _ in g)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, ROWS):
            b = whole.slice(at, ROWS)
            texts = [main_text(h) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row."""
    p = pages.select(F.col(id_col).cast("long").alias("page_id"),
                     F.col(url_col).cast("string").alias("url"),
                     F.col(html_col).cast("string").alias("html"))
    return p.transform(in_tasks, _extract, "page_id long, url string, text string, n_chars long")
