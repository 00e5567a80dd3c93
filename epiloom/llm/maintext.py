"""Main text of HTML pages: page structure, and differencing against the page of the nearest URL.

A page is read as lines: the text of one block each, with references decoded
and white space made single. What stands in scripts, menus, forms, notices, adverts,
comments and the like is marked as no content, and what an article element (else a
main element) holds as content. Lines outside of a page's main element (and of articles) are no content either. All other lines are open: those of
pages without such an element, and those beside an article. A form around an article or main element is the page's frame, no form, and
what surrounds a main element is no menu or notice, whatever its class.

Every page is paired with the page nearest to it by URL path within its host, and the lines of both, all but the marked ones,
are aligned by a longest common subsequence. The text of every page is what this leaves: open
lines that both share are deleted as template. Copied or quoted documents share article
lines too, so a shared line of an article is deleted only on more evidence: if the pages before and after both mark it as no
content elsewhere and the page itself does not, or if the articles of 16 pages in a row share it (of all pages of
a host, if that has 4 to 15), such as a notice without a mark. Two articles that share half of their lines or more are copies and no evidence.

Pages of a host with equal lines count as one when pairs are looked for. Pages are
ordered by host and path over all partitions and numbered, so that neighbours meet
by number, however many pages a host has. Of the page before and the page
after, the one with the longer common path prefix is taken (the one before, if equal).
Only hashes of lines are shuffled for this; lines only if the places of those that stay are too many to broadcast.

Nulls and odd rows: null html is empty and gives an empty text; a null URL has an
empty host and path; a page without a neighbour keeps all its lines; rows that repeat
give a row each. Elements that are never closed end with the page, or where an
article begins. A tag whose quotes don't close, or that meets another `<` outside of quotes, ends at its
first `>`; what looks like a tag but has no `>` behind it is text. Reading takes time linear in the page.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterable, Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epiloom.llm.common import in_batches, rows_of, stored
from epiloom.llm.reputation import host_of, path_of

_MARKUP = re.compile(r"<(?=[!?]|/?[a-zA-Z])")
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_EDGE = re.compile(r"[<>\"']")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
#: Elements whose content is no markup.
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg math".split())
#: Elements that hold no content.
BOILERPLATE = frozenset(
    "head nav footer aside form button select option menu dialog object embed canvas audio video map label fieldset datalist".split()
) | RAW
CONTENT = ("article", "main")
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
    "h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SPACES = frozenset("br td th".split())
NO_MARKS = re.compile(r"(?!)")
#: Parts of a class, id or role that mark what is no content.
MARKS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|notices?|notification\w*|popup|modal|newsletter|subscri\w+"
    r"|sidebar|menu|nav\w*|breadcrumbs?|masthead|site-?header|page-?header|footer|comments?|commentlist|repl(?:y|ies)|disqus|social|share|sharing|related|widget|"
    r"contentinfo|complementary|search|toolbar|alert|dialog)(?:$|[\s_-])",
    re.I,
)
#: The same for article and main elements, and for what stands outside of them.
CONTENT_MARKS = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|comments?|repl(?:y|ies)|related|widget)(?:$|[\s_-])", re.I)
OUTSIDE_MARKS = re.compile(r"(?:^|\s)(?:header|top|bottom)(?:$|\s)", re.I)


class Line(NamedTuple):
    text: str
    content: bool
    dropped: bool = False
    beyond: bool = False  # outside of the main element and of articles


class _Tag(NamedTuple):
    start: int
    end: int
    name: str
    close: bool
    more: str


class _Reader:
    """Finds where markup ends, in time linear in the page, however broken the page is.

    A tag ends at the first `>` outside of quotes; where quotes don't close, or another `<`
    comes before, at the first `>` of all. A quote that leads to no end is remembered,
    so that no later tag follows it again.
    """

    def __init__(self, page: str) -> None:
        self.page = page
        self.endless: set[int] = set()
        self.last = page.rfind(">")

    def end_of(self, start: int, name_end: int) -> int:
        """Where a tag ends (behind its `>`), with its name read up to `name_end`."""
        seen, at = [], name_end
        while m := _EDGE.search(self.page, at):
            if m[0] == ">":
                return m.end()
            if m[0] == "<" or m.start() in self.endless:
                break
            seen.append(m.start())
            close = self.page.find(m[0], m.end())
            if close < 0:
                break
            at = close + 1
        self.endless.update(seen)
        return self.page.index(">", start) + 1

    def next(self, at: int) -> _Tag | None:
        """The first tag, comment or declaration at `at` or behind; those that never end go to the end of the page, tags without any `>` are text."""
        page = self.page
        while m := _MARKUP.search(page, at):
            start = m.start()
            if page[start + 1] in "!?":
                mark, skip = ("-->", 4) if page.startswith("<!--", start) else (">", 2)
                end = page.find(mark, start + skip)
                return _Tag(start, len(page) if end < 0 else end + len(mark), "", False, "")
            if start < self.last:
                named = _NAME.match(page, start)
                end = self.end_of(start, named.end())
                return _Tag(start, end, named[2].lower(), named[1] == "/", page[named.end() : end - 1])
            at = start + 1
        return None


def _tags(page: str) -> list[_Tag]:
    """Tags and comments in order; what raw elements hold is passed over."""
    out: list[_Tag] = []
    reader, at = _Reader(page), 0
    while tag := reader.next(at):
        out.append(tag)
        at = tag.end
        if tag.name in RAW and not tag.close and not tag.more.endswith("/"):
            end = re.compile(rf"</{re.escape(tag.name)}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = end.start() if end else len(page)
            if not end:
                out.append(_Tag(at, at, tag.name, True, ""))
    return out


def _marked(tag: _Tag, marks: re.Pattern) -> bool:
    if tag.name in ("html", "body"):
        return False
    if "=" not in tag.more and "hidden" not in tag.more:
        return False
    for m in _ATTRIBUTE.finditer(tag.more):
        key, value = m[1].lower(), (m[2] or "").strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
        if key in ("class", "id", "role") and marks.search(value):
            return True
    return False


def _ends(tags: list[_Tag]) -> dict[int, int]:
    """For each opening tag that is closed, the number of its end tag."""
    opened: defaultdict[str, list[int]] = defaultdict(list)
    out: dict[int, int] = {}
    for i, t in enumerate(tags):
        if t.close and opened[t.name]:
            out[opened[t.name].pop()] = i
        elif not t.close and t.name and t.name not in VOID and not t.more.endswith("/"):
            opened[t.name].append(i)
    return out


def _spans(page: str, tags: list[_Tag]) -> tuple[list[tuple[int, int]], dict[str, list[tuple[int, int]]]]:
    """Ranges of tags that are no content, and those of article and main elements."""
    ends = _ends(tags)
    dropped: list[tuple[int, int]] = []
    held: dict[str, list[tuple[int, int]]] = {n: [] for n in CONTENT}
    begins = {n: [i for i, t in enumerate(tags) if t.name == n and not t.close and not _marked(t, CONTENT_MARKS)] for n in CONTENT}
    until = content_until = -1

    def around(i: int, name: str) -> bool:
        """Whether tag i is closed behind the beginning of such an element."""
        k = bisect_right(begins[name], i)
        return k < len(begins[name]) and begins[name][k] < ends.get(i, -1)

    for i, t in enumerate(tags):
        if t.close or not t.name or t.name in VOID:
            continue
        inside = i < content_until
        frame = t.name not in CONTENT and around(i, "main")
        marks = CONTENT_MARKS if t.name in CONTENT else NO_MARKS if frame else MARKS
        mark = _marked(t, marks) or not inside and not frame and t.name not in CONTENT and _marked(t, OUTSIDE_MARKS)
        if t.name in CONTENT and not mark and i >= until:
            end = ends.get(i, len(tags))
            held[t.name].append((i, end))
            content_until = max(content_until, end)
        elif t.name == "form" and not mark and (frame or around(i, "article")):
            continue
        elif i >= until and (t.name in BOILERPLATE or mark or t.name == "header" and not inside):
            end = ends.get(i)
            if end is None:  # never closed: as far as the next article, or to the end
                end = next((k for k in range(i + 1, len(tags)) if tags[k].name in CONTENT and not tags[k].close), len(tags))
            dropped.append((i, end))
            until = end
    return dropped, held


def _inside(ranges: list[tuple[int, int]], i: int) -> bool:
    k = bisect_right(ranges, (i, 1 << 62)) - 1
    return k >= 0 and ranges[k][0] <= i < ranges[k][1]


def _outermost(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for begin, end in sorted(ranges):
        if not out or begin >= out[-1][1]:
            out.append((begin, end))
        elif end > out[-1][1]:
            out[-1] = out[-1][0], end
    return out


def lines_of(page: str) -> tuple[list[Line], bool]:
    """Lines in page order without what is no content, and whether an article (or main) element of the page holds any."""
    lines, marked = all_lines_of(page)
    return [x for x in lines if not x.dropped], marked


def all_lines_of(page: str) -> tuple[list[Line], bool]:
    """The same with the lines of menus, notices and others that are no content, marked as dropped."""
    tags = _tags(page)
    dropped, held = _spans(page, tags)
    dropped, articles, mains = _outermost(dropped), _outermost(held["article"]), _outermost(held["main"])
    out: list[Line] = []
    where: list[tuple[bool, bool]] = []
    parts: list[str] = []
    aside: list[str] = []
    inside = (False, False)

    def close() -> None:
        for some, drop in ((parts, False), (aside, True)):
            if some:
                text = " ".join(html.unescape("".join(some)).split())
                if text:
                    out.append(Line(text, False, drop))
                    where.append(inside)
                some.clear()

    at = 0
    for i in range(-1, len(tags)):
        # The text behind tag i, up to the next one.
        if i >= 0:
            t = tags[i]
            if t.name in BLOCKS:
                close()
            elif t.name in SPACES:
                parts.append(" ")
                aside.append(" ")
            at = t.end
        now = _inside(articles, i), _inside(mains, i)
        if now != inside:
            close()
            inside = now
        end = tags[i + 1].start if i + 1 < len(tags) else len(page)
        if end > at and not _inside(dropped, i):
            parts.append(page[at:end])
        elif end > at and (tags[i].close or tags[i].name not in RAW):
            aside.append(page[at:end])
    close()
    # Elements without a line of their own say nothing about the others.
    in_article, in_main = (any(w[k] and not x.dropped for x, w in zip(out, where, strict=True)) for k in (0, 1))
    for i, (x, w) in enumerate(zip(out, where, strict=True)):
        if not x.dropped:
            out[i] = Line(x.text, w[0] if in_article else w[1], beyond=in_main and not any(w))
    return out, in_article or in_main


#: Bits that a table of a common subsequence may have before it is halved.
_TABLE_BITS = 1 << 26


def _bit_rows(a: list[int], b: list[int]) -> Iterator[int]:
    """After each line of `b`, a bit for each line of `a`: 0 where the common subsequence with `a` up to it becomes longer (Crochemore and others, 2001)."""
    where: defaultdict[int, list[int]] = defaultdict(list)
    for i, x in enumerate(a):
        where[x].append(i)

    def mask(x: int) -> int:
        bits = bytearray(len(a) // 8 + 1)
        for i in where[x]:
            bits[i >> 3] |= 1 << (i & 7)
        return int.from_bytes(bits, "little")

    # Masks of rare lines are made anew each time, so that all masks together stay small.
    often = {x: mask(x) for x, at in where.items() if len(at) > 64}
    every = (1 << len(a)) - 1
    row = every
    for x in b:
        if x in where:
            hit = row & (often[x] if x in often else mask(x))
            row = ((row + hit) | (row - hit)) & every
        yield row


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of `b` and each beginning of `a`."""
    row = (1 << len(a)) - 1
    for row in _bit_rows(a, b):  # noqa: B007
        pass
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(a) // 8 + 1, "little"), np.uint8), count=len(a), bitorder="little")
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def common_lines(a: list[int], b: list[int], table_bits: int = _TABLE_BITS) -> set[int]:
    """Places in `a` of a longest common subsequence of `a` and `b`.

    A table of bits is walked back; one larger than `table_bits` is not made, but `b` is
    halved and `a` cut where both halves together are longest (Hirschberg, 1975).
    """
    # Lines that the other side lacks are in no common subsequence.
    in_b = set(b)
    places = [i for i, x in enumerate(a) if x in in_b]
    a, in_a = [a[i] for i in places], set(a)
    b = [x for x in b if x in in_a]
    out: set[int] = set()
    work = [(0, len(a), 0, len(b))]
    while work:
        first, end, low, high = work.pop()
        if first == end or low == high:
            continue
        if (end - first) * (high - low) <= table_bits or high - low == 1:
            out.update(places[first + i] for i in _walk_back(a[first:end], b[low:high]))
            continue
        half = (low + high) // 2
        ahead = _lengths(a[first:end], b[low:half])
        behind = _lengths(a[first:end][::-1], b[half:high][::-1])[::-1]
        cut = first + int((ahead + behind).argmax())
        work += [(first, cut, low, half), (cut, end, half, high)]
    return out


def _walk_back(a: list[int], b: list[int]) -> set[int]:
    rows = list(_bit_rows(a, b))
    out: set[int] = set()
    i, j = len(a) - 1, len(b) - 1
    while i >= 0 and j >= 0:
        if rows[j] >> i & 1:
            i -= 1
        elif j and not rows[j - 1] >> i & 1:
            j -= 1
        else:
            out.add(i)
            i, j = i - 1, j - 1
    return out


def _hash(line: str) -> int:
    return int.from_bytes(blake2b(line.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _prefix(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


#: Pages in a row whose articles share a line that is template for that, and the fewest where they are all pages of a host.
RUN, LEAST_RUN = 16, 4

_LONGS, _INTS = pa.list_(pa.int64()), pa.list_(pa.int32())
_READ = pa.schema(
    [("page_id", pa.int64()), ("url", pa.string()), ("lines", pa.list_(pa.string())), ("hashes", _LONGS)]
    + [(n, _INTS) for n in ("outside", "beyond")]
    + [("rest", _LONGS)]
)
_READ_DDL = "page_id long, url string, lines array<string>, hashes array<long>, outside array<int>, beyond array<int>, rest array<long>"


def read_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, lines (all content and open ones), hashes of these and of the lines beyond the main element, places (from 0) among
    the hashes of what is `outside` of the article (null without an article) and `beyond` the main element,
    and hashes of all lines that are dropped or outside of the article (`rest`).
    """

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for page_id, url, page in rows_of(batches, "page_id", "url", "html"):
                every, marked = all_lines_of(page or "")
                lines = [x for x in every if not x.dropped]
                hashes = [_hash(x.text) for x in lines]
                outside = [i for i, x in enumerate(lines) if not x.content] if marked else None
                beyond = [i for i, x in enumerate(lines) if x.beyond]
                rest = {_hash(x.text) for x in every if x.dropped} | {hashes[i] for i in outside or ()}
                yield page_id, url, [x.text for x in lines if not x.beyond], hashes, outside, beyond, sorted(rest)

        return in_batches(rows(), _READ, 500)

    return pages.select("page_id", "url", "html").mapInArrow(read, _READ_DDL)


def with_neighbours(pages: DataFrame) -> DataFrame:
    """host, key, path, hashes, outside, beyond, rest, number, and path, hashes and rest of the pages before and after, of distinct pages.

    `pages` has host, path, key, hashes, outside, beyond and rest; pages of a host with one key are alike.
    """
    same = (F.first(c, True).alias(c) for c in ("hashes", "outside", "beyond"))
    alike = pages.groupBy("host", "key").agg(F.min("path").alias("path"), *same, F.min("rest").alias("rest"))
    ordered = alike.repartitionByRange("host", "path", "key").sortWithinPartitions("host", "path", "key")
    ordered = stored(ordered.withColumn("m", F.monotonically_increasing_id()), "ordered-pages")
    part = F.shiftright("m", 33)
    counts = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n"))  # a row for each partition
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("part", before.alias("offset"))
    numbered = ordered.withColumn("part", part).join(F.broadcast(offsets), "part")
    numbered = numbered.withColumn("number", F.col("offset") + F.col("m").bitwiseAND(F.lit((1 << 33) - 1)))
    wanted = numbered.select("host", "key", "path", "hashes", "outside", "beyond", "rest", "number")
    for name, step in (("before", 1), ("after", -1)):
        other = numbered.select((F.col("number") + step).alias("number"), F.col("host").alias("h"), *(F.col(c).alias(f"{c}_{name}") for c in ("path", "hashes", "rest")))
        wanted = wanted.join(other, "number", "left").select(
            *wanted.columns, *(F.when(F.col("h") == F.col("host"), F.col(f"{c}_{name}")).alias(f"{c}_{name}") for c in ("path", "hashes", "rest"))
        )
    return wanted


def template_lines(hashes: list[int], outside: list[int] | None, rest: list[int], shared: set[int], marked: set[int]) -> set[int]:
    """Places of the lines of a page that are template by what it shares with the nearest page (places `shared`).

    Open lines are if both share them. Lines of the article are if they are also `marked` as no content by the pages before and after
    and not among the page's own `rest`; an article that shares half of its lines or more is a copy and has none.
    """
    if outside is None:
        return shared
    template = shared.intersection(outside)
    marked = marked.difference(rest)
    return template.union(i for i in _held(hashes, outside, shared) if hashes[i] in marked)


def _held(hashes: list[int], outside: list[int] | None, shared: set[int]) -> set[int]:
    """Those of the `shared` places that are in the article; none of an article that shares half of its lines or more."""
    if outside is None:
        return set()
    held = shared.difference(outside)
    return held if 2 * len(held) < len(hashes) - len(outside) else set()


_DIFFERENCES = pa.schema(
    [("host", pa.string()), ("key", pa.int64()), ("number", pa.int64()), ("first", pa.bool_()), ("last", pa.bool_())]
    + [("kept", _INTS), ("place", _INTS), ("hash", _LONGS), ("side", _INTS)]
)
_DIFFERENCES_DDL = "host string, key long, number long, first boolean, last boolean, kept array<int>, place array<int>, hash array<long>, side array<int>"


def differenced(neighbours: DataFrame) -> DataFrame:
    """host, key, number, whether the page is the first or last of its host, and `kept`: places (from 0) among the content and open lines
    of those that stay (null if all do); place, hash and side (-1 or 1) of the article lines shared with the page before and after.
    Pages that lose and share nothing have no row.
    """
    own = ("host", "key", "number", "path", "hashes", "outside", "beyond", "rest")
    names = (*own, *(f"{c}_{side}" for side in ("before", "after") for c in ("path", "hashes", "rest")))

    def delete(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for host, key, number, path, hashes, outside, beyond, rest, *others in rows_of(batches, *names):
                sides = [(step, _prefix(path, x[0]), common_lines(hashes, x[1]), x[2]) for step, x in ((-1, others[:3]), (1, others[3:])) if x[1] is not None]
                if not sides:
                    continue
                marked = set(sides[0][3]).intersection(sides[1][3]) if len(sides) == 2 else set()
                nearest = max(sides, key=lambda x: x[1])[2]
                template = template_lines(hashes, outside, rest, nearest, marked)
                lines = {i: k for k, i in enumerate(sorted(set(range(len(hashes))).difference(beyond)))}
                kept = [k for i, k in lines.items() if i not in template]
                shared = [(lines[i], hashes[i], x[0]) for x in sides for i in sorted(_held(hashes, outside, x[2]))]
                if shared or len(kept) < len(lines):
                    ends = sides[0][0] > 0, sides[-1][0] < 0
                    yield host, key, number, *ends, kept if len(kept) < len(lines) else None, *([x[c] for x in shared] for c in range(3))

        return in_batches(rows(), _DIFFERENCES, 500)

    return neighbours.select(*names).mapInArrow(delete, _DIFFERENCES_DDL)


def repeated_lines(differences: DataFrame) -> DataFrame:
    """host, key and places (`gone`) of the article lines that pages in a row share."""
    shared = differences.select("host", "key", "number", "first", "last", F.inline(F.arrays_zip("place", "hash", "side")))
    line = ["host", "hash", "number"]
    # A link of two pages, by the number of the first: each shares the line with the other.
    after = shared.where("side = 1").groupBy(*line).agg(F.max("first").alias("first"))
    before = shared.where("side = -1").groupBy("host", "hash", (F.col("number") - 1).alias("number")).agg(F.max("last").alias("last"))
    links = after.join(before, line)
    starts = links.select("host", "hash", F.explode(F.sequence(F.col("number") - (RUN - 2), F.col("number"))).alias("low"))
    runs = starts.groupBy("host", "hash", "low").count().where(F.col("count") == RUN - 1).select("host", "hash", "low", (F.col("low") + RUN - 1).alias("high"))
    every = links.groupBy("host", "hash").agg(F.min("number").alias("low"), (F.max("number") + 1).alias("high"), F.count("*").alias("n"), F.max("first").alias("first"), F.max("last").alias("last"))
    every = every.where(f"first AND last AND n = high - low AND n BETWEEN {LEAST_RUN - 1} AND {RUN - 2}").select("host", "hash", "low", "high")
    found = runs.union(every).select("host", "hash", F.explode(F.sequence("low", "high")).alias("number")).distinct()
    return shared.join(found, line, "left_semi").groupBy("host", "key").agg(F.collect_set("place").alias("gone"))


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page (page_id, url, html)."""
    read = read_pages(pages)
    read = stored(
        read.select("*", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.xxhash64("hashes", F.col("outside").isNull(), "outside", "beyond").alias("key")),
        "page-lines",
    )
    differences = stored(differenced(with_neighbours(read)), "page-differences")
    lost = differences.where("kept IS NOT NULL").select("host", "key", "kept").join(repeated_lines(differences), ["host", "key"], "full")
    texts = read.select("page_id", "url", "host", "key", "lines").join(lost, ["host", "key"], "left")
    kept = F.coalesce("kept", F.sequence(F.lit(0), F.size("lines") - 1))
    kept = F.transform(F.when(F.col("gone").isNull(), kept).otherwise(F.array_except(kept, "gone")), lambda i: F.get("lines", i))
    lines = F.when(F.col("kept").isNull() & F.col("gone").isNull(), F.col("lines")).otherwise(kept)
    texts = texts.select("page_id", "url", F.array_join(lines, "\n").alias("text"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))
