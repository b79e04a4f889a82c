"""Main text of web pages: markup marks what surely is and isn't text, a host's suffix array the rest.

Pages are cut into blocks. Menus, headers, footers, sidebars, notices, adverts, forms, scripts and
reader comments are known by their elements and names; where a page marks its article, and the article isn't a teaser beside a longer text of its own, that is its
text. Elsewhere, and to tell what stands beside an article as the page's own, long runs of words that other pages of its host have too
are boilerplate. To find them, the words of many pages are put one behind the other, and the suffixes
sorted by their first RUN words; suffixes that agree in these lie together, and a run
whose suffixes come from two pages is repeated. Each task sorts the suffixes of its own pages; equal
runs of all tasks are then merged by host, so no task holds a host.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm import texts as tx
from sluiceway.llm.components import stored

#: Words that must repeat on another page of the host to be boilerplate.
RUN = 8

# Elements and names of HTML pages: fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body canvas caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "section summary table tbody td tfoot th thead tr ul".split())
LEFT_OUT = frozenset(
    "aside button canvas dialog fieldset footer form head header iframe input menu nav noscript object option script "
    "select style svg template textarea title audio video".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer gdpr header masthead menu menubar modal nav navbar navigation newsletter notice notices popup promo "
    "promoted promotion related respond share sharing sidebar social sponsor sponsored subscribe toolbar widget".split())
CLOSED_BY_NEXT = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
                  "th": ("td", "th"), "option": ("option",)}
LISTS = ("ul", "ol", "dl", "table", "select")       # what the former don't reach out of

_NAME = re.compile(r"(/?)([A-Za-z][^\s/>]*)")
_SPECIAL = re.compile(r"[\"'>]")
_NAMED = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
_MAIN = re.compile(r"role\s*=\s*[\"']?main\b")
_PART = re.compile(r"[A-Za-z]+")
_SPACE = re.compile(r"\s+")


def _named_out(attributes: str) -> bool:
    """Whether an element's role, class or id says that it isn't text."""
    for name, value in _NAMED.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "role":
            if value in ROLES:
                return True
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        elif name in ("class", "id") and not NAMES.isdisjoint(_PART.findall(value)):
            return True
    return False


class _Tags:
    """Finds the tags of a page, reading no character more than a few times, whatever the page holds.

    What was looked for isn't looked for again: the next place of a mark, and a quote from which no tag ends.
    """

    def __init__(self, page: str):
        self.page = page
        self.marks: dict[str, tuple[int, int]] = {}     # mark: a place, and the first one from there on
        self.dead: set[int] = set()             # quotes outside quotes from which no tag ends
        self.span = (0, -1, None)               # from, to: no quote or `>` lies between; what lies there

    def _find(self, mark: str, at: int) -> int:
        low, found = self.marks.get(mark, (at + 1, at))
        if not low <= at or 0 <= found < at:
            low, found = at, self.page.find(mark, at)
            self.marks[mark] = (low, found)
        return found

    def _special(self, at: int) -> int:
        """The next quote or `>`; -1 if there is none."""
        low, high, found = self.span
        if not low <= at <= high:
            hit = _SPECIAL.search(self.page, at)
            found = hit.start() if hit else -1
            self.span = (at, found if hit else len(self.page), found)
        return found

    def _end(self, at: int) -> int:
        """Where the `>` of a tag lies whose attributes begin at `at`; -1 if it has none."""
        passed = []
        while True:
            quote = self._special(at)
            if quote >= 0 and self.page[quote] == ">":
                return quote
            close = -1 if quote < 0 or quote in self.dead else self._find(self.page[quote], quote + 1)
            if quote >= 0:
                passed.append(quote)
            if close < 0:
                self.dead.update(passed)
                return -1
            at = close + 1

    def next(self, at: int) -> tuple[int, int, bool, str, str] | None:
        """(start, end, whether it closes, name, attributes) of the next tag; comments and the like have no name."""
        page = self.page
        while (start := page.find("<", at)) >= 0:
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                return start, end + 3 if end >= 0 else len(page), False, "", ""
            if page.startswith("<![CDATA[", start) and (end := self._find("]]>", start)) >= 0:
                return start, end + 3, False, "", ""
            if page[start + 1:start + 2] in ("!", "?") and (end := self._find(">", start)) >= 0:
                return start, end + 1, False, "", ""
            name = _NAME.match(page, start + 1) if self._find(">", start) >= 0 else None
            if name and (end := self._end(name.end())) >= 0:
                return start, end + 1, bool(name[1]), name[2], page[name.end():end]
            at = start + 1
        return None


class _Open:
    """The open elements, innermost last, and where those of each name and the blocks among them stand."""

    def __init__(self):
        self.stack: list[tuple[str, bool, bool]] = []       # element, in an article, left out
        self.places: dict[str, list[int]] = {}
        self.block_places: list[int] = []

    def top(self) -> tuple[str, bool, bool]:
        return self.stack[-1] if self.stack else ("", False, False)

    def push(self, name: str, article: bool, off: bool) -> None:
        self.places.setdefault(name, []).append(len(self.stack))
        if name in BLOCK:
            self.block_places.append(len(self.stack))
        self.stack.append((name, article, off))

    def innermost(self, names) -> int:
        """The place of the innermost open element of these names; -1 if there is none."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=-1)

    def cut(self, k: int) -> None:
        """Close the elements from place k on."""
        while len(self.stack) > k:
            name = self.stack.pop()[0]
            self.places[name].pop()
            if name in BLOCK:
                self.block_places.pop()


def blocks(page: str | None) -> list[tuple[str, bool, bool]]:
    """(text, in an article, left out) of each block of a page, in order; no empty ones.

    An end tag closes what is open inside its element, and one without a start is ignored; a
    new block ends an open paragraph. Comments and raw elements have no text.
    """
    page = page or ""
    out: list[tuple[str, bool, bool]] = []
    held: list[str] = []
    tags, open_ = _Tags(page), _Open()

    def flush() -> None:
        if held:
            text = _SPACE.sub(" ", html.unescape("".join(held))).strip()
            held.clear()
            if text:
                _, article, off = open_.top()
                out.append((text, article, off))

    def close(k: int) -> None:
        """Close the elements from place k on; their text ends where a block or something left out does."""
        outside = k > 0 and open_.stack[k - 1][2]
        if open_.top()[2] != outside or open_.block_places and open_.block_places[-1] >= k:
            flush()
        open_.cut(k)

    at, size = 0, len(page)
    while at < size:
        tag = tags.next(at)
        if tag is None:
            held.append(page[at:])
            break
        start, end, closes, name, attributes = tag
        held.append(page[at:start])
        at = end
        if not name:
            continue
        name = name.lower()
        if closes:
            k = open_.innermost((name,))
            if k >= 0:
                if name in BLOCK:
                    flush()
                close(k)
            continue
        if name == "br":
            held.append(" ")
            continue
        if name in BLOCK:
            flush()
            k = open_.innermost(("p",))
            if k >= 0 and k == open_.block_places[-1]:
                close(k)
            if name in CLOSED_BY_NEXT:
                k = open_.innermost(CLOSED_BY_NEXT[name])
                if k > open_.innermost(LISTS):
                    close(k)
        _, article, off = open_.top()
        out_now = off or name in LEFT_OUT or bool(attributes) and name not in ("html", "body") and _named_out(attributes)
        if name in RAW:
            found = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(page, at)
            at = found.end() if found else size
            continue
        if name in VOID or attributes.endswith("/") and name not in BLOCK:
            continue
        if out_now != off:
            flush()
        main = name in ("article", "main") or _MAIN.search(attributes) is not None
        open_.push(name, article or main and not out_now, out_now)
    flush()
    return out


def host(url: str | None) -> str:
    """The host of a url, in small letters; empty without one."""
    found = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return found[1].lower() if found else ""


_PARSED = "page_id BIGINT, url STRING, sure BOOLEAN, text STRING, host STRING, parts ARRAY<STRUCT<text: STRING, off: BOOLEAN, main: BOOLEAN>>"


def _parse(batches):
    kind = pa.list_(pa.struct([("text", pa.string()), ("off", pa.bool_()), ("main", pa.bool_())]))
    for whole in batches:
        for batch in tx.slices(whole, "html"):
            sure, texts, parts = [], [], []
            for page in batch.column("html").to_pylist():
                found = blocks(page)
                marked = [t for t, article, off in found if article and not off]
                beside = sum(len(t) for t, article, off in found if not article and not off)
                whole_text = bool(marked) and sum(map(len, marked)) >= beside
                sure.append(whole_text)
                texts.append("\n".join(marked) if whole_text else None)
                parts.append([{"text": t, "off": off, "main": article and not off} for t, article, off in found
                              if not (whole_text and article)])
            hosts = [host(u) for u in batch.column("url").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(sure), pa.array(texts, pa.string()),
                 pa.array(hosts, pa.string()), pa.array(parts, kind)],
                ["page_id", "url", "sure", "text", "host", "parts"])


def _stream(parts: list[list[dict]]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the pages' blocks, one page behind the other, and where each page begins."""
    return tx.words(pa.array(["\n".join(b["text"] for b in p or []) for p in parts], pa.string()))


def suffix_array(words: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes in the order of their first `length` words, and each one's rank among the distinct beginnings.

    Prefix doubling: the rank of twice as many words is that of two neighbouring halves.
    """
    rank = np.unique(words, return_inverse=True)[1].astype(np.int64)
    done = 1
    while done < length and len(rank):
        step = min(done, length - done)
        behind = np.full(len(rank), -1, dtype=np.int64)
        behind[:-step or None] = rank[step:]
        rank = np.unique(rank * (len(rank) + 1) + behind + 1, return_inverse=True)[1].astype(np.int64)
        done += step
    return np.argsort(rank, kind="stable"), rank


_RUNS = "host STRING, run BIGINT, low STRING, high STRING"


def _runs(batches):
    """Each distinct run of a task's pages by host, with the first and last page that has it."""
    for batch in batches:
        words, starts = _stream(batch.column("parts").to_pylist())
        if not len(words):
            continue
        hosts = batch.column("host").to_pylist()
        pages = batch.column("page").to_pylist()
        owner = np.repeat(np.arange(len(pages)), np.diff(starts))
        number = np.unique(np.array(hosts, dtype=object), return_inverse=True)[1]
        salted = tx.mix(words ^ (number[owner].astype(np.uint64) + np.uint64(1)))
        order, rank = suffix_array(salted, RUN)
        whole = order[order + RUN <= starts[owner[order] + 1]]
        keys = tx.chain(words, RUN)
        if not len(whole):
            continue
        first = np.flatnonzero(np.diff(rank[whole], prepend=-1))
        names = np.array(pages, dtype=object)
        by_name = np.argsort(names, kind="stable")
        place = np.argsort(by_name)[owner[whole]]
        low, high = np.minimum.reduceat(place, first), np.maximum.reduceat(place, first)
        one = whole[first]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.array(hosts, dtype=object)[owner[one]], pa.string()), pa.array(keys[one].view(np.int64)),
             pa.array(names[by_name[low]], pa.string()), pa.array(names[by_name[high]], pa.string())],
            ["host", "run", "low", "high"])


def _places(batches):
    """(page, host, run, place) of the pages whose text isn't sure."""
    for batch in batches:
        words, starts = _stream(batch.column("parts").to_pylist())
        keys = tx.chain(words, RUN)
        owner = np.repeat(np.arange(batch.num_rows), np.diff(starts))[:len(keys)]
        inside = np.flatnonzero(np.arange(len(keys)) + RUN <= starts[owner + 1])
        row = pa.array(owner[inside])
        yield pa.RecordBatch.from_arrays(
            [batch.column("uid").take(row), batch.column("host").take(row), pa.array(keys[inside].view(np.int64)),
             pa.array(inside - starts[owner[inside]])], ["uid", "host", "run", "place"])


def _unique(batches):
    """The text of pages without their repeated runs: the article alone, if what is left beside it isn't longer."""
    for batch in batches:
        texts = []
        for parts, places in zip(batch.column("parts").to_pylist(), batch.column("places").to_pylist(), strict=True):
            covered = {p + k for p in places or () for k in range(RUN)}
            at, own, everything, beside = 0, [], [], 0
            for block in parts or []:
                split = re.findall(r"[^\x20\x09-\x0D]+", block["text"])
                left = [w for k, w in enumerate(split) if at + k not in covered]
                at += len(split)
                if not block["off"]:
                    everything.append(block["text"])
                    if len(left) == len(split) or block["main"]:
                        own.append(block["text"])
                    elif left:
                        own.append(" ".join(left))
                    if not block["main"] and left:
                        beside += len(own[-1])
            marked = [block["text"] for block in parts or [] if block["main"]]
            if marked and sum(map(len, marked)) >= beside:
                own = marked
            texts.append("\n".join(own or everything))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                                         ["page_id", "url", "text"])


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of each row of `pages(page_id, url, html)`.

    Blocks have character references decoded, white space made one space and trimmed, and are joined by
    line ends. Where a page has an article (or main element) with no less text than stands beside it, not counting there the runs
    that another page of the host has, its blocks are the text, whole,
    whatever other pages hold; where it has no less even with these, they are not looked for. Elsewhere the body's blocks are, without what their names leave out and without runs of RUN words
    or more that another page of the host has, unless nothing would be left; short articles stay whole. A page is read in time
    that grows with its length, whatever it holds. Null html is an
    empty page; a page without url shares the host of the others without. Repeated rows, which
    have one page_id, don't make each other boilerplate. Other columns are ignored.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    parsed = rows.mapInArrow(_parse, _PARSED).withColumn("uid", F.monotonically_increasing_id()) \
        .withColumn("page", F.coalesce(F.col("page_id").cast("string"), F.concat(F.lit("u"), "uid")))
    parsed = stored(spark, parsed)
    runs = parsed.select("host", "page", "parts").mapInArrow(_runs, _RUNS)
    repeated = runs.groupBy("host", "run").agg(F.min("low").alias("low"), F.max("high").alias("high")) \
        .filter("low < high").select("host", "run")
    open_ = parsed.filter("NOT sure")
    places = open_.select("uid", "host", "parts").mapInArrow(_places, "uid BIGINT, host STRING, run BIGINT, place BIGINT") \
        .join(repeated, ["host", "run"], "left_semi").groupBy("uid").agg(F.collect_list("place").alias("places"))
    rest = open_.join(places, "uid", "left").select("page_id", "url", "parts", "places") \
        .mapInArrow(_unique, "page_id BIGINT, url STRING, text STRING")
    text = parsed.filter("sure").select("page_id", "url", "text").unionByName(rest)
    return text.withColumn("n_chars", F.length("text").cast("long"))
