"""Main text of web pages by nearest-URL page differencing.

Every page becomes a list of text lines (blocks). Pages of one host are sorted by URL path, each is paired with its
neighbours, the lines of both are aligned by longest common subsequence, and the shared lines are deleted: what
neighbouring pages repeat in the same order is the site's frame. Copies are no neighbours: a page is paired with the nearest
pages that differ from it. Differencing alone can't give the article: a frame may
differ from page to page, and an article may quote a line that its neighbour also has. So lines inside an `article` or `main`
element are never deleted, and lines inside elements that name themselves as frame (navigation, footers, notices, ...) are
never kept. A class or id word or a form hides no element that is or holds the page's `article` or `main`.
Where a page has an `article` or `main`, only its lines are text; elsewhere the differencing decides.

The order of all pages is cut into ranges, a task each. A range gets the lines (as hashes) of the last page before it and of
the first page behind it, and of the nearest pages that differ from those, so that pairs do not depend on the cuts.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import partial
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAIR_ROWS, MOST_RANGES, SAMPLE_PER_RANGE = 250, 5000, 20
OUT_BYTES = 16 << 20
MOST_PAIRS = 1 << 16        # pairs of equal lines aligned one by one
FRAME, OPEN, ARTICLE = 0, 1, 2

#: Fixed names of HTML elements and of the roles and class words by which pages mark what is not the article.
RAW = "script|style|noscript|template|svg|iframe|object|canvas|math|textarea|title"
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre
    section summary table tbody tfoot thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FRAMES = frozenset("nav footer aside form button select menu dialog head datalist label".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
FRAME_WORDS = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promotion nav
    navbar navigation menu breadcrumb breadcrumbs sidebar footer cookie cookies consent gdpr notice notices banner popup modal
    overlay comment comments disqus replies respond share sharing social related recommended recommendations newsletter
    subscribe subscription signup login search widget widgets toolbar masthead pagination pager copyright""".split())

#: Well-formed tags; a try ends at the next sign of another tag, so all tries together are linear too.
PLAIN = re.compile(r"</?([a-zA-Z][a-zA-Z0-9]*)(?:\s+[\w:.-]+(?:=\"[^\"<>]*\")?)*\s*/?>", re.A)
RAWS = frozenset(RAW.split("|"))
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
OPENER = re.compile(rf"(?:{RAW})(?=[\s/>])", re.I)
CLOSERS = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW.split("|")}
SIGN = re.compile("[>\"']")
ATTR = re.compile(r"([a-zA-Z_:][\w:.-]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.S)
PART = re.compile(r"[a-z]+")
#: Parts of a class name that tell of a state or a layout, not of what the element is: no-sidebar, comments-open.
STATES = frozenset("has no not with without is hide show open closed on off enabled disabled".split())
#: Words that count as a name's leading part only: page builders end every block's name with them.
LEADING = frozenset("widget widgets".split())
PAGE_PARTS = frozenset("nav header footer".split())
TEXT_PARTS = frozenset("p h1 h2 h3".split())


def names_frame(names: str) -> bool:
    """Whether a class or id, or its leading or trailing part, is a word for frame."""
    for name in names.split():
        parts = PART.findall(name)
        if not parts or parts[0] in STATES or parts[-1] in STATES:
            continue
        if parts[0] in FRAME_WORDS or parts[-1] in FRAME_WORDS - LEADING:
            return True
    return False


def frame_marks(name: str, attrs: str) -> tuple[bool, bool]:
    """(frame whatever it holds, frame unless it holds the page's article or main) by the element's name and attributes."""
    if name in FRAMES and name != "form":
        return True, False
    if not attrs.strip(" /\t\r\n"):
        return False, name == "form"
    found = {k.lower(): (v or "").strip("\"'").lower() for k, v in ATTR.findall(attrs)}
    if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", ""):
        return True, False
    role = found.get("role")
    if role in ROLES and role != "form":
        return True, False
    if name == "form" or role == "form":
        return False, True
    return False, name not in ("body", "html", "main") and names_frame(found.get("class", "") + " " + found.get("id", ""))


class Element:
    """An open tag. Its kind is known when the page has been read, since it depends on what the element holds."""
    __slots__ = ("name", "hard", "soft", "above", "holds", "parts")

    def __init__(self, name: str, attrs: str, above: Element | None) -> None:
        self.name, self.above = name, above
        self.hard, self.soft = frame_marks(name, attrs)
        self.holds = self.parts = False


def kinds_of(elements: list[Element]) -> dict[Element | None, int]:
    """FRAME, OPEN or ARTICLE of each element; elements come after those that hold them. Within an article, a class or id word
    or a form is frame even if it holds articles (readers' comments); elsewhere not if it is or holds an article or main."""
    kinds: dict[Element | None, int] = {None: OPEN}
    articles: set[Element | None] = set()
    for e in elements:
        kind = kinds[e.above]
        inside = e.above in articles
        if kind != FRAME:
            if e.hard or e.name == "header" and kind != ARTICLE or e.soft and (inside or not (e.holds or e.parts)):
                kind = FRAME
            elif e.name in ("article", "main"):
                kind = ARTICLE
        kinds[e] = kind
        if inside or e.name == "article" and kind == ARTICLE:
            articles.add(e)
    return kinds


class Tags:
    """Tokens of a page in one pass: (start, end, name, closes, attributes, text). Whatever is not closed is not looked for
    twice, so a page of n characters takes about n steps however malformed it is. A `<` that starts no tag is text."""

    def __init__(self, page: str) -> None:
        self.page, self.last = page, page.rfind(">")
        self.open_quotes: set[int] = set()                            # quotes after which no tag ends
        self.name: tuple[int, int] = (0, 0)

    def tag_end(self, at: int) -> int:
        """Behind the first > outside quotes from `at` on, or -1."""
        passed = []
        while at <= self.last:
            sign = SIGN.search(self.page, at)
            if sign is None:
                break
            if sign[0] == ">":
                return sign.end()
            if sign.start() in self.open_quotes:
                break
            passed.append(sign.start())
            close = self.page.find(sign[0], sign.end())
            if close < 0:
                break
            at = close + 1
        self.open_quotes.update(passed)
        return -1

    def name_end(self, at: int) -> int:
        """End of the name that starts at `at`, or -1."""
        if not ("a" <= self.page[at:at + 1].lower() <= "z" and self.page[at].isascii()):
            return -1
        if not self.name[0] <= at < self.name[1]:
            self.name = at, NAME.match(self.page, at).end()
        return self.name[1]

    def __iter__(self) -> Iterator[tuple[int, int, str | None, bool, str, str]]:
        page, at = self.page, 0
        while (start := page.find("<", at)) >= 0:
            at = start + 1
            tag = PLAIN.match(page, start)
            if tag is not None and ((closes := page[at] == "/") or tag[1].lower() not in RAWS):
                at = tag.end()
                yield start, at, tag[1], closes, page[tag.end(1):at - 1], ""
                continue
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                at = len(page) if end < 0 else end + 3
                yield start, at, None, False, "", ""
                continue
            if page[start:start + 9].upper() == "<![CDATA[":
                end = page.find("]]>", start + 9)
                at = len(page) if end < 0 else end + 3
                yield start, at, None, False, "", page[start + 9:len(page) if end < 0 else end]
                continue
            if start > self.last:
                continue
            raw = OPENER.match(page, start + 1)
            if raw is not None:
                end = page.find(">", raw.end()) + 1
                close = CLOSERS[raw[0].lower()].search(page, end)
                at = len(page) if close is None else close.end()
                yield start, at, None, False, "", ""
                continue
            if page.startswith(("<!", "<?"), start):
                at = page.find(">", start) + 1
                yield start, at, None, False, "", ""
                continue
            closes = page.startswith("/", start + 1)
            first = start + 1 + closes
            name_end = self.name_end(first)
            end = self.tag_end(name_end) if name_end > 0 else -1
            if end > 0:
                at = end
                yield start, at, page[first:name_end], closes, page[name_end:end - 1], ""


class Stack:
    """Open elements, with what is asked about all of them kept as counts."""

    def __init__(self) -> None:
        self.items: list[Element] = []
        self.names: Counter[str] = Counter()
        self.hiding = 0                                               # elements no article counts in
        self.forms: list[Element] = []                                # forms not yet known to wrap the page

    def push(self, e: Element) -> None:
        self.items.append(e)
        self.names[e.name] += 1
        self.hiding += e.hard or e.name == "header"
        if e.name == "form":
            self.forms.append(e)

    def pop(self) -> Element:
        e = self.items.pop()
        self.names[e.name] -= 1
        self.hiding -= e.hard or e.name == "header"
        if self.forms and self.forms[-1] is e:
            self.forms.pop()
        return e

    def holds_article(self) -> None:
        for e in reversed(self.items):
            if e.holds:
                break
            e.holds = True

    def holds_part(self, of_page: bool) -> None:
        """A form with parts of a page in it, or all of the body's text, wraps the page."""
        wraps = self.forms if of_page else [e for e in self.items[:2] if e.name == "form" and (e.above is None or e.above.name == "body")]
        for e in wraps:
            e.parts = True
        if of_page:
            self.forms.clear()


def page_lines(page: str) -> tuple[list[str], list[int]]:
    """Text lines of a page in order, each with FRAME, OPEN or ARTICLE."""
    lines: list[str] = []
    owners: list[Element | None] = []
    held: list[str] = []
    stack = Stack()
    elements: list[Element] = []

    def flush() -> None:
        if held:
            line = " ".join(html.unescape("".join(held)).split())
            held.clear()
            if line:
                lines.append(line)
                owners.append(stack.items[-1] if stack.items else None)

    at = 0
    for start, end, name, closes, attrs, text in Tags(page):
        if start > at:
            held.append(page[at:start])
        at = end
        if name is None:
            if text:
                held.append(html.escape(text, quote=False))
            continue
        name = name.lower()
        if name in BLOCKS:
            flush()
        elif name in ("br", "td", "th"):
            held.append(" ")
        if closes:
            if stack.names[name]:
                while stack.pop().name != name:
                    pass
            continue
        if name in VOID or attrs.endswith("/") and name not in BLOCKS:
            continue
        if name == "body":
            stack = Stack()
        while name in ("p", "li") and stack.items and stack.items[-1].name == name:
            stack.pop()
        element = Element(name, attrs, stack.items[-1] if stack.items else None)
        stack.push(element)
        elements.append(element)
        if name in ("article", "main") and not stack.hiding:
            stack.holds_article()
        elif name in PAGE_PARTS or name in TEXT_PARTS:
            stack.holds_part(name in PAGE_PARTS)
    if at < len(page):
        held.append(page[at:])
    flush()
    kinds = kinds_of(elements)
    return lines, [kinds[e] for e in owners]


def common(a: list, b: list) -> tuple[set[int], set[int]]:
    """Positions in a and in b of one longest common subsequence. Equal ends are cut off; what is left is halved until few
    enough pairs of equal lines remain."""
    left: set[int] = set()
    right: set[int] = set()
    todo = [(0, len(a), 0, len(b))]
    while todo:
        lo, hi, start, stop = todo.pop()
        while lo < hi and start < stop and a[lo] == b[start]:
            left.add(lo)
            right.add(start)
            lo, start = lo + 1, start + 1
        while lo < hi and start < stop and a[hi - 1] == b[stop - 1]:
            hi, stop = hi - 1, stop - 1
            left.add(hi)
            right.add(stop)
        if lo == hi or start == stop:
            continue
        held = Counter(b[start:stop])
        if hi - lo == 1 or sum(held[line] for line in a[lo:hi]) <= MOST_PAIRS:
            one, other = few_pairs(a[lo:hi], b[start:stop])
            left.update(i + lo for i in one)
            right.update(j + start for j in other)
            continue
        half = (lo + hi) // 2
        ahead = prefix_lengths(a[lo:half], b[start:stop])
        behind = prefix_lengths(a[half:hi][::-1], b[start:stop][::-1])[::-1]
        cut = start + int((ahead + behind).argmax())
        todo += [(lo, half, start, cut), (half, hi, cut, stop)]
    return left, right


def prefix_lengths(a: list, b: list) -> np.ndarray:
    """Length of the longest common subsequence of a and b[:j] for j = 0 .. len(b), all j at once as bits of a number."""
    places: dict[object, int] = defaultdict(int)
    marks: dict[object, list[int]] = defaultdict(list)
    for j, line in enumerate(b):
        marks[line].append(j)
    for line in set(a) & marks.keys():
        bits = np.zeros(len(b), np.uint8)
        bits[marks[line]] = 1
        places[line] = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
    full = (1 << len(b)) - 1
    rows = full
    for line in a:
        if line in places:
            met = rows & places[line]
            rows = ((rows + met) | (rows - met)) & full
    steps = np.unpackbits(np.frombuffer((full & ~rows).to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[:len(b)]
    return np.r_[0, np.cumsum(steps, dtype=np.int64)]


def few_pairs(a: list, b: list) -> tuple[set[int], set[int]]:
    """`common` by the pairs of equal lines (Hunt and Szymanski)."""
    places: dict[object, list[int]] = defaultdict(list)
    for j, line in enumerate(b):
        places[line].append(j)
    tails: list[int] = []
    links: list[tuple | None] = []
    for i, line in enumerate(a):
        for j in reversed(places.get(line, ())):
            k = bisect_left(tails, j)
            link = (i, j, links[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                links.append(link)
            else:
                tails[k], links[k] = j, link
    left, right, link = set(), set(), links[-1] if links else None
    while link:
        left.add(link[0])
        right.add(link[1])
        link = link[2]
    return left, right


ORDER = ["host", "path", "url", "page_id", "digest", "copy"]
KEYS = "host string, path string, url string, page_id long, digest long, copy long"
LINES = f"range int, {KEYS}, lines array<string>, kinds array<int>"
TEXT = "page_id long, url string, text string, n_lines int, n_shared int"
EDGES = "range int, edge int, host string, decided binary, marks array<binary>"
HEAD, AFTER_HEAD, TAIL, BEFORE_TAIL = 0, 1, 2, 3


def place(values: Iterator) -> tuple:
    """A row's values of ORDER as Spark sorts them: nulls first."""
    return tuple((v is not None, v) for v in values)


def _lines(batches: Iterator[pa.RecordBatch], bounds: Broadcast) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [batch.column(n) for n in ORDER]
        ranges = pa.array([bisect_right(bounds.value, place(row)) for row in zip(*(k.to_pylist() for k in keys))], pa.int32())
        first, lines, kinds, size = 0, [], [], 0
        for i, page in enumerate(batch.column("html")):
            text, kind = page_lines(page.as_py() or "")
            lines.append(text)
            kinds.append(kind)
            size += sum(map(len, text))
            if size >= OUT_BYTES or i + 1 == batch.num_rows:
                part = slice(first, i + 1)
                yield pa.RecordBatch.from_arrays(
                    [ranges[part], *(k[part] for k in keys), pa.array(lines, pa.list_(pa.string())),
                     pa.array(kinds, pa.list_(pa.int32()))], ["range", *ORDER, "lines", "kinds"])
                first, lines, kinds, size = i + 1, [], [], 0


def _digest(*texts: str) -> bytes:
    return blake2b("\n".join(texts).encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _decided(row: dict) -> bytes:
    """What makes two pages copies of each other: the lines that differencing decides, or all lines and their kinds where it
    decides none (a hash; lines hold no line feed). Pairing copies would delete all their lines as shared."""
    if ARTICLE in row["kinds"]:
        return _digest("article", *map(str, row["kinds"]), *row["lines"])
    return _digest("open", *(line for line, kind in zip(row["lines"], row["kinds"]) if kind == OPEN))


def _marked(row: dict) -> dict:
    """Adds `free`, the numbers of the lines outside article and main, `marks`, their hashes, and `decided`."""
    row["free"] = [i for i, kind in enumerate(row["kinds"]) if kind != ARTICLE]
    row["marks"] = [_digest(row["lines"][i]) for i in row["free"]]
    row["decided"] = _decided(row)
    return row


def _light(batches: Iterator[pa.RecordBatch], bounds: Broadcast) -> Iterator[pa.RecordBatch]:
    """Of each page its place, `decided` and `marks`."""
    for batch in _lines(batches, bounds):
        rows = [_marked(row) for row in batch.select(["lines", "kinds"]).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(n) for n in ("range", *ORDER)), pa.array([r["decided"] for r in rows], pa.binary()),
             pa.array([r["marks"] for r in rows], pa.list_(pa.binary()))], ["range", *ORDER, "decided", "marks"])


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each range the first and the last page, and of their hosts the next page behind and before that is no copy of them."""
    schema = pa.schema([("range", pa.int32()), ("edge", pa.int32()), ("host", pa.string()), ("decided", pa.binary()),
                        ("marks", pa.list_(pa.binary()))])
    last, found = None, {}

    def give() -> pa.RecordBatch:
        rows = [row | {"edge": edge} for edge, row in {**found, TAIL: last}.items() if row is not None]
        return pa.RecordBatch.from_pylist(rows, schema)

    for batch in batches:
        for row in batch.select(["range", "host", "decided", "marks"]).to_pylist():
            if last is None or last["range"] != row["range"]:
                if last is not None:
                    yield give()
                found = {HEAD: row, AFTER_HEAD: None, BEFORE_TAIL: None}
            elif last["host"] != row["host"]:
                found[BEFORE_TAIL] = None
            elif last["decided"] != row["decided"]:
                found[BEFORE_TAIL] = last
                if found[AFTER_HEAD] is None and row["host"] == found[HEAD]["host"]:
                    found[AFTER_HEAD] = row
            last = row
    if last is not None:
        yield give()


def outside(edges: dict[tuple[int, int], tuple], ranges: int) -> list[tuple]:
    """Of each range (before, behind): the (host, decided, marks) of the page next to it and of the nearest page of that
    page's host, further away, that is no copy of it; None where there is none."""
    sides = []
    for order, near, second, far in ((range(ranges), TAIL, BEFORE_TAIL, HEAD), (range(ranges)[::-1], HEAD, AFTER_HEAD, TAIL)):
        seen: tuple = (None, None)
        side: list[tuple] = [seen] * ranges
        for r in order:
            side[r] = seen
            page, other = edges.get((r, near)), edges.get((r, second))
            if page is None:
                continue
            if other is None and edges[r, far][0] == page[0]:  # one host, all copies: the other page lies beyond
                other = next((x for x in seen if x and x[0] == page[0] and x[1] != page[1]), None)
            seen = page, other
        sides.append(side)
    return list(zip(*sides))


def _difference(batches: Iterator[pa.RecordBatch], context: Broadcast) -> Iterator[pa.RecordBatch]:
    """Sorted pages of a range in runs of copies; each page is paired with the nearest page before and the nearest page behind
    that is no copy of it, which is the last one of the run before and the first one of the run behind."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_lines", pa.int32()),
                        ("n_shared", pa.int32())])

    def emit(run: list[dict], partners: list[list[bytes]]) -> Iterator[dict]:
        for row in run:
            shared: set[int] = set()
            for marks in partners:
                shared |= {row["free"][i] for i in common(row["marks"], marks)[0]}
            article = ARTICLE in row["kinds"]
            kept = [line for i, (line, kind) in enumerate(zip(row["lines"], row["kinds"]))
                    if kind == ARTICLE or kind == OPEN and not article and i not in shared]
            yield {"page_id": row["page_id"], "url": row["url"], "text": "\n\n".join(kept), "n_lines": len(row["lines"]),
                   "n_shared": len(shared)}

    def beyond(row: dict, side: int) -> list[list[bytes]]:
        """Marks of the nearest page outside the row's range with its host that is no copy of it."""
        pages = (x for x in context.value[row["range"]][side] if x)
        return next(([m] for host, decided, m in pages if host == row["host"] and decided != row["decided"]), [])

    run: list[dict] = []
    before: list[list[bytes]] = []
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            _marked(row)
            last = run[-1] if run else None
            if last is None or last["range"] != row["range"]:
                if last is not None:
                    out += emit(run, before + beyond(last, 1))
                before, run = beyond(row, 0), []
            elif last["host"] != row["host"]:
                out += emit(run, before)
                before, run = [], []
            elif last["decided"] != row["decided"]:
                out += emit(run, [*before, row["marks"]])
                before, run = [last["marks"]], []
            run.append(row)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    if run:
        yield pa.RecordBatch.from_pylist(list(emit(run, before + beyond(run[-1], 1))), schema)


def extract(pages: DataFrame, pair_rows: int = PAIR_ROWS) -> DataFrame:
    """(page_id, url, text, n_chars, n_lines, n_shared) of every row of (page_id, url, html).

    Null or empty html gives the empty text; a null url is a host of its own. Pages are sorted by host and path over all
    folders and dealt in ranges of about `pair_rows` pages, at most MOST_RANGES; the size of the ranges changes no result.
    Repeated rows stay. A page without another page of its host that differs loses no lines to differencing.
    """
    spark = pages.sparkSession
    url = F.coalesce(F.col("url"), F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][\w+.-]*://([^/?#]*)", 1))
    path = F.regexp_replace(F.regexp_replace(url, r"^[a-zA-Z][\w+.-]*://[^/?#]*", ""), r"[?#].*$", "")
    # `copy` tells repeated rows apart, so that many of them are cut into ranges like any others
    rows = pages.select(host.alias("host"), path.alias("path"), "url", F.col("page_id").cast("long").alias("page_id"),
                        F.xxhash64("html").alias("digest"), F.monotonically_increasing_id().alias("copy"), "html")
    n = pages.count()
    ranges = max(1, min(-(-n // pair_rows), MOST_RANGES))
    bounds: list[tuple] = []
    if ranges > 1:
        sample = sorted(place(r) for r in rows.select(*ORDER).sample(min(1.0, ranges * SAMPLE_PER_RANGE / n), 3).collect())
        bounds = sorted({sample[len(sample) * i // ranges] for i in range(1, ranges)}) if sample else []
    cuts = spark.sparkContext.broadcast(bounds)

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition("range").sortWithinPartitions("range", *ORDER)

    light = rows.mapInArrow(partial(_light, bounds=cuts), f"range int, {KEYS}, decided binary, marks array<binary>")
    edges = {(r["range"], r["edge"]): (r["host"], bytes(r["decided"]), [bytes(m) for m in r["marks"]])
             for r in dealt(light).mapInArrow(_edges, EDGES).collect()}  # four rows a range at most
    context = spark.sparkContext.broadcast(outside(edges, len(bounds) + 1))
    return (dealt(rows.mapInArrow(partial(_lines, bounds=cuts), LINES)).mapInArrow(partial(_difference, context=context), TEXT)
            .select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_lines", "n_shared"))
