"""Main text of web pages by nearest-URL page differencing (operator 8).

A page is read into text blocks in page order; a block ends where a block-level
element begins or ends.  Within each host pages are ordered by URL path, and the
text lines of neighbours are aligned by longest common subsequence: lines that a
page shares with a neighbour are the site's and are deleted.  A page's neighbours
are the nearest ones before and after it whose open lines differ from its own, so
copies of a page (crawled twice, mirrored) don't delete each other; a neighbour
that shares ``COPY`` of the open text of both is a copy with changes, and tells nothing.

Differencing alone cannot give right results: menus, adverts and footers may be
worded anew on each page, and articles may share paragraphs with a neighbour
(copies, licence lines).  So the page's own statements come first: elements that
are boilerplate by their kind (nav, footer, aside, form) or say so by a class, role
or, outside an article, id are dropped, and lines inside a declared article are kept.
All lines that the markup leaves open are settled by differencing.

A class says so if each of its parts is a word of ``MARKED`` or ``NEUTRAL`` and one is of
the first ("site-footer" does, "has-sidebar" and "related-work" don't); headings never
do, and the page's longest article counts whatever encloses it says by class.

Defined results: a null or empty page has an empty text; unclosed and stray tags
are tolerated; repeated rows are pages of their own, with the same text; a page
whose neighbours are all copies keeps its open lines; extra columns are ignored;
a missing URL counts as an empty host and path; null ids are pages of their own;
an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.llm.shared import saved
from kinfold.llm.urls import fingerprints, url_parts

#: Elements whose content is not text.
HIDDEN = frozenset("script style noscript template svg math head title iframe object canvas audio video select datalist textarea".split())
RAW = frozenset("script style textarea title iframe noscript template".split())
#: Elements that are not the article by their kind.
CHROME = frozenset("nav footer aside form button menu dialog".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements inside a line; all others begin a new block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr center-inline".split()
)
CLOSES = {"p": frozenset(["p"]), "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option"]), "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"])}
#: Words of class, id and role that tell boilerplate.
MARKED = frozenset(
    """ad ads advert adverts advertisement adslot banner sponsor sponsored promo promotion menu nav navbar navigation breadcrumb breadcrumbs
    sidebar side-bar aside footer masthead cookie cookies consent gdpr notice notices alert popup modal overlay newsletter
    subscribe signup login social share sharing related recommended recommendations comment comments respond disqus reply replies
    widget toolbar pagination pager skip search searchbox complementary contentinfo""".split()
)
#: Words beside these that say nothing, as in "site-footer".
NEUTRAL = frozenset("site page main global top bottom left right upper lower box bar list block section area wrap wrapper container inner outer content item items links link row col js primary secondary mobile sticky fixed".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ARTICLE = frozenset("article main".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
SPACE = re.compile(r"\s+")

CHROME_LINE, OPEN_LINE, ARTICLE_LINE = 0, 1, 2
#: Share of the open characters of both pages that makes a neighbour a copy.
COPY = 0.9


def _says_so(word: str) -> bool:
    """Whether a class names boilerplate."""
    if word in MARKED:
        return True
    parts = [w for w in re.split(r"[-_:]+", re.sub(r"\d+", "", word)) if w]
    return any(w in MARKED for w in parts) and all(w in MARKED or w in NEUTRAL for w in parts)


def _marked(name: str, attributes: str, in_article: bool) -> tuple[bool, bool]:
    """(hidden, declared as boilerplate) by an element's attributes."""
    hidden = said = False
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            hidden = True
        elif key in ("class", "role") or key == "id" and not in_article:
            said |= any(map(_says_so, value.split()))
    return hidden and name not in ("html", "body"), said and name not in HEADINGS and name not in ("html", "body", "article", "main")


def _longest_article(page: str) -> int:
    """Where the longest article or main element begins, or -1."""
    best, at, open_at = 0, -1, []
    for m in re.finditer(r"<(/?)(?:article|main)\b", page, re.I):
        if not m[1]:
            open_at.append(m.start())
        elif open_at:
            first = open_at.pop()
            if m.start() - first > best:
                best, at = m.start() - first, first
    for first in open_at:  # unclosed: to the end of the page
        if len(page) - first > best:
            best, at = len(page) - first, first
    return at


def lines(page: str) -> list[tuple[int, str]]:
    """(kind, text) of the page's blocks in order; kind tells what the markup says of them."""
    out: list[tuple[int, str]] = []
    stack: list[tuple[str, int, bool]] = []  # open elements, the kind inside them, whether their text is left out within a line
    text: list[str] = []
    at, n = 0, len(page)
    kind, mute = OPEN_LINE, False
    longest = _longest_article(page)

    def end_block():
        if text:
            s = SPACE.sub(" ", entities.unescape("".join(text))).strip()
            text.clear()
            if s:
                out.append((kind, s))

    def leave(k: int):
        nonlocal kind, mute
        del stack[k:]
        kind, mute = (stack[-1][1], stack[-1][2]) if stack else (OPEN_LINE, False)

    def close(k: int):
        end_block()
        leave(k)

    while at < n:
        found = TOKEN.search(page, at)
        if found is None:
            if not mute:
                text.append(page[at:])
            break
        if found.start() > at and not mute:
            text.append(page[at : found.start()])
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if name == "br":
            text.append(" ")
            continue
        within = name in INLINE or name in HIDDEN or name == "button"  # stands inside a line
        if found[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    if within and all(s[0] in INLINE or s[2] for s in stack[k:]):
                        leave(k)
                    else:
                        close(k)
                    break
            continue
        if not within:
            end_block()
            if name in CLOSES:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in CLOSES[name]:
                        close(k)
                        break
                    if stack[k][0] not in INLINE:
                        break
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            at = stop.end() if stop else n
            continue
        if name in VOID or found[3].endswith("/") and name in ("path", "use"):
            continue
        hidden, said = _marked(name, found[3], kind == ARTICLE_LINE)
        if found.start() == longest and not hidden and not any(s[0] in CHROME or s[2] for s in stack):
            inside = ARTICLE_LINE
        elif kind == CHROME_LINE or name in CHROME or name in HIDDEN or hidden or said:
            inside = CHROME_LINE
        elif name == "header" and kind != ARTICLE_LINE:
            inside = CHROME_LINE
        elif name in ARTICLE or re.search(r"role\s*=\s*[\"']?(?:main|article)\b", found[3], re.I):
            inside = ARTICLE_LINE
        else:
            inside = kind
        mute = mute or within and inside == CHROME_LINE and kind != CHROME_LINE
        stack.append((name, inside, mute))
        kind = kind if mute else inside
    end_block()
    return out


def _lengths(x: list, y: list) -> np.ndarray:
    """Lengths of longest common subsequences of x with each prefix of y, by bit-parallel rows."""
    places: dict = {}
    for j, v in enumerate(y):
        places[v] = places.get(v, 0) | 1 << j
    full = (1 << len(y)) - 1
    row = full
    for v in x:
        hit = row & places.get(v, 0)
        row = (row + hit | row - hit) & full
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(y) // 8 + 1, "little"), np.uint8), bitorder="little", count=len(y))
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def common(a: list, b: list) -> set[int]:
    """Positions of ``a`` in a longest common subsequence with ``b``; linear space, ties to the front.

    Shared heads and tails are matched first; items that the other side lacks
    cannot take part and are left out.
    """
    keep = set(b)
    xs = [(i, x) for i, x in enumerate(a) if x in keep]
    keep = {x for _, x in xs}
    ys = [y for y in b if y in keep]
    out: set[int] = set()
    lo = 0
    while lo < len(xs) and lo < len(ys) and xs[lo][1] == ys[lo]:
        out.add(xs[lo][0])
        lo += 1
    hi_x, hi_y = len(xs), len(ys)
    while hi_x > lo and hi_y > lo and xs[hi_x - 1][1] == ys[hi_y - 1]:
        hi_x, hi_y = hi_x - 1, hi_y - 1
        out.add(xs[hi_x][0])
    todo = [(lo, hi_x, lo, hi_y)]
    while todo:  # halves of x, with the cut of y that serves both best
        x0, x1, y0, y1 = todo.pop()
        if x0 == x1 or y0 == y1:
            continue
        if x1 - x0 == 1:
            if xs[x0][1] in ys[y0:y1]:
                out.add(xs[x0][0])
            continue
        mid = (x0 + x1) // 2
        one = _lengths([v for _, v in xs[x0:mid]], ys[y0:y1])
        two = _lengths([v for _, v in xs[mid:x1][::-1]], ys[y0:y1][::-1])
        cut = y0 + int(np.argmax(one + two[::-1]))
        todo += [(x0, mid, y0, cut), (mid, x1, cut, y1)]
    return out


def article(page: list[tuple[int, str]], neighbours: list[list[tuple[int, str]]]) -> list[str]:
    """The lines of an article: those declared as one, and open lines that no neighbour but a copy shares."""
    own = [t for _, t in page]
    size = sum(len(t) for k, t in page if k == OPEN_LINE)
    shared: set[int] = set()
    for other in neighbours if size else ():
        found = common(own, [t for _, t in other])
        same = sum(len(page[i][1]) for i in found if page[i][0] == OPEN_LINE)
        if same < COPY * max(size, sum(len(t) for k, t in other if k == OPEN_LINE)):
            shared |= found
    return [t for i, (k, t) in enumerate(page) if k == ARTICLE_LINE or k == OPEN_LINE and i not in shared]


def _place(host: str, path: str, i: int | None) -> tuple:
    """The order of pages, as Spark sorts (host, path, id)."""
    return host, path, i is not None, i or 0


def _parse(bounds: list[tuple], whole: bool):
    """Rows with their part of the order, the fingerprint of their open lines and, if ``whole``, their lines."""

    def run(batches):
        for batch in batches:
            kinds, texts, off, opens = [], [], [0], []
            for page in batch.column(4).to_pylist():
                found = lines(page or "")
                opens.append("\n".join(_open(found)))
                if whole:
                    kinds += [k for k, _ in found]
                    texts += [t for _, t in found]
                off.append(len(kinds))
            places = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(0).to_pylist())
            parts = pa.array([bisect_right(bounds, _place(*x)) for x in places], pa.int32())
            got = [parts, pa.array(fingerprints(opens)), *(batch.column(i) for i in range(4))]
            if whole:
                offs = pa.array(off, pa.int32())
                got += [pa.ListArray.from_arrays(offs, pa.array(kinds, pa.int32())), pa.ListArray.from_arrays(offs, pa.array(texts, pa.string()))]
            yield pa.RecordBatch.from_arrays(got, names=["part", "fp", "id", "url", "host", "path", "kinds", "texts"][: len(got)])

    return run


def _bounds(keys: DataFrame, n: int) -> list[tuple]:
    """Places that cut the pages into about ``n`` parts of like size, from a sample."""
    share = 100.0 * n / max(1, keys.count())
    got = sorted(_place(*r) for r in (keys if share >= 1 else keys.sample(share, seed=1)).collect())
    return sorted({got[len(got) * k // n] for k in range(1, n)}) if got else []


def _beyond(rows: DataFrame, bounds: list[tuple]) -> dict[int, tuple[list, list]]:
    """For each part, the two nearest pages of different open lines before it and after it, in the host at that border.

    Of two, one at least differs from any page at the border.  Each part gives its
    first and last two such pages; parts of copies of one page are looked through.
    """
    light = rows.mapInArrow(_parse(bounds, False), "part int, fp long, id long, url string, host string, path string")
    at = F.struct("path", "id")
    marks = saved(light.groupBy("part", "host", "fp").agg(F.min(at).alias("lo"), F.max(at).alias("hi")))
    first, final = F.struct("host", "lo", "fp"), F.struct("host", "hi", "fp")
    one = marks.groupBy("part").agg(F.min(first).alias("f1"), F.max(final).alias("l1"))
    other = lambda x: (F.col("host") != F.col(f"{x}.host")) | (F.col("fp") != F.col(f"{x}.fp"))
    two = marks.join(F.broadcast(one), "part").groupBy("part").agg(F.first("f1").alias("f1"), F.min(F.when(other("f1"), first)).alias("f2"), F.first("l1").alias("l1"), F.max(F.when(other("l1"), final)).alias("l2"))
    flat = lambda r: r and (r[0], r[1][0], r[1][1], r[2])  # noqa: E731  # host, path, id, fp
    ends = {r["part"]: tuple(flat(r[k]) for k in ("f1", "f2", "l1", "l2")) for r in two.collect()}
    order = sorted(ends)

    def look(host, parts, at):
        found: list[tuple] = []
        for part in parts:
            for x in ends[part][at : at + 2]:
                if x is None:
                    continue
                if x[0] != host:
                    return found
                if all(x[3] != y[3] for y in found):
                    found.append(x)
                if len(found) == 2:
                    return found
        return found

    near = {part: (look(ends[part][0][0], reversed(order[:k]), 2), look(ends[part][2][0], order[k + 1 :], 0)) for k, part in enumerate(order)}
    want = sorted({x for sides in near.values() for side in sides for x in side}, key=lambda x: (_place(*x[:3]), x[3]))
    if not want:
        return {}
    keys = F.broadcast(rows.sparkSession.createDataFrame(want, "host string, path string, id long, fp long"))
    same = lambda x: (x["host"] == keys["host"]) & (x["path"] == keys["path"]) & x["id"].eqNullSafe(keys["id"])
    parsed = rows.join(keys, same(rows), "left_semi").mapInArrow(_parse([], True), PARSED)
    parsed = parsed.join(keys, same(parsed) & (parsed["fp"] == keys["fp"]), "left_semi").dropDuplicates(["host", "path", "id", "fp"])
    pages = {(r["host"], r["path"], r["id"], r["fp"]): tuple(zip(r["kinds"], r["texts"])) for r in parsed.collect()}
    return {part: tuple([(x[0], pages[x]) for x in side] for side in sides) for part, sides in near.items()}


PARSED = "part int, fp long, id long, url string, host string, path string, kinds array<int>, texts array<string>"


def _open(page: list[tuple[int, str]]) -> list[str]:
    return [t for k, t in page if k == OPEN_LINE]


def _difference(beyond: dict[int, tuple[list, list]]):
    """Rows sorted by (part, host, path): each run of pages with equal open lines against the pages before and after it in its host."""

    def rows(batches):
        for batch in batches:
            for part, i, url, host, kinds, texts in zip(*(batch.column(i).to_pylist() for i in range(6))):
                yield part, host, tuple(zip(kinds, texts)), (i, url)

    def emit(out):
        ids, urls, texts = zip(*out)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(texts, pa.string())], names=["id", "url", "text"])

    def settle(run, before, after):
        """(id, url, text) of a run: rows by equal pages, each page settled once; pages without open lines don't wait in one."""
        near = [x for x in (before, after) if x is not None]
        for page, found in run.items():
            text = "\n\n".join(article(page, near))
            yield from ((i, url, text) for i, url in found)

    def outside(part, side, host, lines_of):
        """The nearest page beyond a border that isn't of the run."""
        found = beyond.get(part, ([], []))[side]
        return next((page for h, page in found if h == host and _open(page) != lines_of), None)

    def run(batches):
        out, size = [], 0
        group: dict[tuple, list] = {}
        part = host = lines_of = before = last = None
        for row in chain(rows(batches), [None]):
            if row is None or row[:2] != (part, host) or _open(row[2]) != lines_of:
                stays = row is not None and row[:2] == (part, host)
                if group:
                    after = row[2] if stays else None if row is not None and row[0] == part else outside(part, 1, host, lines_of)
                    done = list(settle(group, before, after))
                    out += done
                    size += sum(len(x[2]) for x in done)
                if row is None:
                    break
                now = _open(row[2])
                before = last if stays else None if row[0] == part else outside(row[0], 0, row[1], now)
                group, part, host, lines_of = {}, row[0], row[1], now
            last = row[2]
            if lines_of:
                group.setdefault(last, []).append(row[3])
            else:
                out += settle({last: [row[3]]}, None, None)
                size += len(out[-1][2])
            if size > 4 << 20:
                yield emit(out)
                out, size = [], 0
        if out:
            yield emit(out)

    return run


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text) of whole pages; blocks of the text are joined by an empty line.

    The pages' order by (host, path, id) is cut into parts, so a hot host is spread
    over tasks, and the parsed lines are exchanged once; each part is given the pages
    at its borders, so the text doesn't depend on the number of parts.
    """
    host, path = url_parts(F.col("__url"))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("__url"), F.col(html_col).cast("string").alias("html"))
    rows = rows.select("id", F.col("__url").alias("url"), host.alias("host"), path.alias("path"), "html")
    n = max(1, int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    bounds = _bounds(rows.select("host", "path", "id"), n)
    beyond = _beyond(rows, bounds) if bounds else {}
    parsed = rows.mapInArrow(_parse(bounds, True), PARSED)
    near = parsed.repartitionById(len(bounds) + 1, "part").sortWithinPartitions("part", "host", "path", "id")
    got = near.select("part", "id", "url", "host", "kinds", "texts").mapInArrow(_difference(beyond), "id long, url string, text string")
    return got.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text")
