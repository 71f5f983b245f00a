"""Main text of web pages: a suffix array over each host's whole token streams, with page structure beside it.

Every visible block of a page, menus and footers included, is part of its token stream. The streams of a host's pages
are put end to end; sorting their suffixes finds the runs of ``run_tokens`` or more tokens that distinct pages repeat,
across blocks, too. Covered runs go, unique runs stay. Markup has a say where repeats have none: what it names as menu,
header, footer, sidebar, notice, advert, form or reader comment goes even if it is unique; of a page with an article the
article stays, or else its main element; and inside these a run goes only if half of the host's pages have it, since
articles may quote one another. Pages that repeat one another as a whole are copies, not boilerplate.

Pages are distinct if their texts are; A-Z match a-z. A null or empty page has empty text. Broken markup never fails and
is read in time linear in its length. Equal pages get equal text; repeated rows give repeated rows. Pages without a host
in their address share the host of the empty string. Identifiers must be whole numbers. Extra columns are not read.

A host's pages are dealt by a hash of their texts into groups, so a host with a third of all pages is many groups. The
result does not depend on the groups: runs are counted over all pages of a host, in two rounds. Groups send short hashes
of their windows of ``run_tokens`` tokens, and whole ones of those alone that may be on enough pages. A page that a task
of the first stage meets again is dealt by its number there, so copies spread over all groups of their host.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

_U = np.uint64
_OPENING = re.compile(r"<(?=[a-zA-Z/!?])")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
#: A tag's rest, if the quotes around its values are closed; names of attributes that tell something.
_QUOTED = re.compile(r"""(?:[^>=]++|=\s*+(?:"[^"]*"|'[^']*'|(?!["'])))*+>""")
_TELLING = re.compile("class|id|role|hidden", re.I)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]++)(?:\s*+=\s*+("[^"]*"|'[^']*'|[^\s"'>]+))?""")

#: Kinds of elements, and words of names that tell what an element is for.
_RAW = frozenset("script style textarea title iframe noembed noframes noscript template".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark math mi mn mo mrow msub msup nobr output q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
_SILENT = frozenset("head select option object svg canvas audio video datalist map".split())
_CHROME = frozenset("nav aside form footer menu button dialog fieldset".split())
_CHROME_OUTSIDE = frozenset(["header"])
_CHROME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices disclaimer nav navbar navigation menu menus footer "
    "breadcrumb breadcrumbs sidebar side aside comment comments commentlist respond reply replies disqus newsletter subscribe subscription signup login share sharing social "
    "related recommended popup modal overlay toolbar pagination pager widget widgets masthead toc search copyright".split()
)
_PLACE_WORDS = frozenset(
    "box bar block area list item items wrapper wrap container section inner outer content group panel link links button buttons icon icons top bottom left right site page main global primary secondary "
    "post posts form title text slot unit zone col column row body head header".split()
)
_CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
_IMPLIED = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}
_SCOPES = frozenset("ul ol dl table body html article main section div aside nav header footer form blockquote".split())
# End of fixed values.

_OWN_COMMENT = re.compile(r"(?:div-)?comment(?:-body|-item|-content|-\d+)?")
_CLOSED_BY = {tag: frozenset([*closed.split(), "p"]) for tag, closed in _IMPLIED.items()}
_P = frozenset(["p"])
#: What markup says of a block, and two flags.
CHROME, PLAIN, MAIN, ARTICLE = range(4)
HEADING, LINKED = 4, 8


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for match in _ATTRIBUTE.finditer(text):
        found.setdefault(match[1].lower(), (match[2] or "").strip("\"'").lower())
    return found


def is_chrome_name(name: str, in_article: bool) -> bool:
    """Whether a class or identifier names page furniture: one of its parts does, and the others only say where it stands."""
    parts = [p.rstrip("0123456789") for p in re.split(r"[-_]", name)]
    told = [p in _CHROME_WORDS or p == "header" and not in_article for p in parts]
    return any(told) and all(t or not p or p in _PLACE_WORDS for t, p in zip(told, parts, strict=True))


def _is_chrome(tag: str, found: dict[str, str], in_article: bool) -> bool:
    if tag in _CHROME or tag in _CHROME_OUTSIDE and not in_article:
        return True
    if not found or tag in ("html", "body", "main"):
        return False
    if found.get("hidden", "until-found") != "until-found" or found.get("aria-hidden") == "true" or found.get("role") in _CHROME_ROLES:
        return True
    names = f"{found.get('class', '')} {found.get('id', '')}".split()
    if tag == "article":
        return any(_OWN_COMMENT.fullmatch(n) for n in names)
    return any(is_chrome_name(n, in_article) for n in names)


class _Open:
    """The open elements. Every question about them takes a look-up, and every element is pushed and popped once."""

    def __init__(self):
        self.stack: list[tuple] = [("", PLAIN, False, False, 0, 0)]  # tag, zone, chrome, silent, its scope, its block
        self.scopes, self.blocks = [0], [0]
        self.open: dict = defaultdict(int)  # by tag; by scope and tag; by block and inline tag
        self.links = 0

    def push(self, tag: str, zone: int, chrome: bool, silent: bool) -> None:
        scope, block, here = self.scopes[-1], self.blocks[-1], len(self.stack)
        self.open[tag] += 1
        self.open[scope, tag] += 1
        self.links += tag == "a"
        if tag in _INLINE:
            self.open[block, tag, 0] += 1
        else:
            self.blocks.append(here)
        if tag in _SCOPES:
            self.scopes.append(here)
        self.stack.append((tag, zone, chrome, silent, scope, block))

    def pop(self) -> str:
        tag, _, _, _, scope, block = self.stack.pop()
        self.open[tag] -= 1
        self.open[scope, tag] -= 1
        self.links -= tag == "a"
        if tag in _INLINE:
            self.open[block, tag, 0] -= 1
        else:
            self.blocks.pop()
        if tag in _SCOPES:
            self.scopes.pop()
        return tag

    def close(self, tag: str) -> None:
        """An end tag: one that nothing waits for is ignored, and an inline one doesn't close a block that is open within."""
        if self.open.get((self.blocks[-1], tag, 0) if tag in _INLINE else tag):
            while self.pop() != tag:
                pass

    def close_implied(self, tags: frozenset) -> None:
        scope = self.scopes[-1]
        if any(self.open.get((scope, t)) for t in tags):
            while self.pop() not in tags:
                pass


def parse_page(source: str | None) -> list[tuple[int, str]]:
    """(grade, text) of each visible block in page order: what markup says of it, with flags, and its text."""
    source = source or ""
    blocks: list[tuple[int, str]] = []
    parts: list[str] = []
    beside: list[str] = []  # of chrome inside the block
    linked = 0
    elements = _Open()
    quotes = True

    def end_block() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                zone = elements.stack[-1][1]
                heading = zone == MAIN and elements.stack[elements.blocks[-1]][0] == "h1"
                blocks.append((zone + HEADING * heading + LINKED * (linked >= 0.6 * len(text)), text))
            parts.clear()
        if beside:
            text = " ".join(html.unescape("".join(beside)).split())
            if text:
                blocks.append((CHROME, text))
            beside.clear()
        linked = 0

    def take(text: str) -> None:
        nonlocal linked
        _, _, chrome, silent, _, _ = elements.stack[-1]
        if text and not silent:
            (beside if chrome else parts).append(text)
            if elements.links and not chrome:
                linked += len(text)

    at, size = 0, len(source)
    while at < size:
        found = _OPENING.search(source, at)
        if found is None:
            take(source[at:])
            break
        start = found.start()
        head = source[start + 1 : start + 2]
        if head in ("!", "?"):
            take(source[at:start])
            mark = "-->" if source.startswith("<!--", start) else "]]>" if source.startswith("<![CDATA[", start) else ">"
            end = source.find(mark, start + 2)
            at = end + len(mark) if end >= 0 else size
            continue
        closing = head == "/"
        name = _NAME.match(source, start + 1 + closing)
        if name is None:  # no tag
            take(source[at : start + 1])
            at = start + 1
            continue
        take(source[at:start])
        # once no tag with closed quotes is found, quotes count as any character for the rest of the page
        rest = _QUOTED.match(source, name.end()) if quotes else None
        end = rest.end() if rest else source.find(">", name.end()) + 1
        quotes = rest is not None
        if not end:
            break  # a tag that never ends
        tag, attributes, at = name[0].lower(), source[name.end() : end - 1], end
        if closing:
            if tag not in _INLINE:
                end_block()
            elements.close(tag)
        elif tag in _RAW:
            stop = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, at)
            end = source.find(">", stop.end()) if stop else -1
            at = end + 1 if end >= 0 else size
        elif tag == "br":
            take(" ")
        elif tag in _VOID:
            if tag == "hr":
                end_block()
        else:
            if tag not in _INLINE:
                end_block()
                elements.close_implied(_CLOSED_BY.get(tag, _P))
            _, zone, chrome, silent, _, _ = elements.stack[-1]
            told = _attributes(attributes) if _TELLING.search(attributes) else {}
            zone = ARTICLE if tag == "article" else max(zone, MAIN) if tag == "main" or told.get("role") == "main" else zone
            if not attributes.endswith("/") or tag in _INLINE:
                elements.push(tag, zone, chrome or _is_chrome(tag, told, zone == ARTICLE), silent or tag in _SILENT)
    end_block()
    return blocks


def kept_blocks(grades: list[int]) -> list[bool]:
    """The blocks that markup keeps: those of the article, with a heading of the main element; or else of the latter; or
    else all that are not page furniture or mostly links."""
    zone = max((g & 3 for g in grades), default=CHROME)
    if zone == ARTICLE:
        return [g & 3 == ARTICLE or g & 3 == MAIN and g & HEADING > 0 for g in grades]
    return [g & 3 == MAIN for g in grades] if zone == MAIN else [g & 3 == PLAIN and not g & LINKED for g in grades]


def pack_page(blocks: list[tuple[int, str]]) -> tuple[bytes, bytes]:
    """A page's stream as one string of bytes, a line for the grades and one for each block; and the text that markup keeps."""
    texts = [t.encode("utf-8", "surrogatepass") for _, t in blocks]
    grades = [g for g, _ in blocks]
    return b"\n".join([bytes(65 + g for g in grades), *texts]), b" ".join(t for t, k in zip(texts, kept_blocks(grades), strict=True) if k)


def repeated_windows(tokens: np.ndarray, page: np.ndarray, identity: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
    """Per position, in how many distinct pages the ``run`` tokens from there stand; and whether a window fits there.

    The suffixes are sorted by prefix doubling up to ``run`` tokens, which is as deep as repeats of that length need:
    suffixes of equal rank are neighbours in the suffix array that share a prefix of ``run`` tokens or more.
    """
    n = len(tokens)
    rank, depth = np.unique(tokens, return_inverse=True)[1].astype(np.int64), 1
    while depth < run:
        step = min(depth, run - depth)
        after = np.full(n, -1, np.int64)
        after[: n - step] = rank[step:]
        rank, depth = np.unique(rank * (n + 1) + after + 1, return_inverse=True)[1].astype(np.int64), depth + step
    fits = np.zeros(n, bool)
    if n >= run:
        fits[: n - run + 1] = page[: n - run + 1] == page[run - 1 :]
    pairs = np.unique(rank[fits] * (int(identity.max(initial=0)) + 1) + identity[page[fits]]) // (int(identity.max(initial=0)) + 1)
    spread = np.bincount(pairs, minlength=max(n, 1))
    return spread[rank], fits


class Streams:
    """The token streams of some distinct pages, end to end; ``counts`` tells which of them this group counts."""

    def __init__(self, packed: list[bytes], counts: list[bool] | None = None):
        unpack = zstandard.ZstdDecompressor().decompress
        self.grades: list[list[int]] = []
        self.blocks: list[list[bytes]] = []
        self.kept: list[list[bool]] = []
        kinds: dict[bytes, int] = {}
        identity = []
        for p in packed:
            whole = unpack(p)
            grades, *blocks = whole.split(b"\n")
            self.grades.append([g - 65 for g in grades])
            self.blocks.append(blocks)
            self.kept.append(kept_blocks(self.grades[-1]))
            # a page of which markup keeps nothing is told by its whole stream
            text = b" ".join(t for t, k in zip(blocks, self.kept[-1], strict=True) if k) or b"\n" + whole
            identity.append(kinds.setdefault(text, len(kinds)))
        self.identity, self.n_kinds = np.array(identity, np.int64), len(kinds)
        self.counts = np.ones(len(packed), bool) if counts is None else np.array(counts, bool)
        self.n_counted = len(set(self.identity[self.counts].tolist()))
        words, lengths, start, held = [], [], 0, 0
        texts = [b"\n".join(b) for b in self.blocks]
        for i, text in enumerate(texts):  # hashing takes a multiple of the texts' bytes
            held += len(text)
            if held > 1 << 19 or i + 1 == len(texts):
                own, begins = common.word_hashes(texts[start : i + 1])
                words.append(own)
                lengths.append(np.diff(begins))
                start, held = i + 1, 0
        self.words = np.concatenate(words) if words else np.empty(0, np.uint64)
        self.lengths = np.concatenate(lengths) if lengths else np.empty(0, np.int64)
        self.page = np.repeat(np.arange(len(packed)), self.lengths)

    def window_hashes(self, run: int) -> tuple[np.ndarray, np.ndarray]:
        """A 64-bit hash of the ``run`` tokens from each position, the same in all groups; and whether a window fits there."""
        n = max(len(self.words) - run + 1, 0)
        rolled = np.zeros(n, np.uint64)
        for k in range(run):
            rolled = common.mix(rolled * _U(3) + self.words[k : k + n] + _U(k + 1))
        return rolled, self.page[:n] == self.page[len(self.page) - n :]

    def distinct_windows(self, run: int) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of all windows, ascending, and how many distinct pages that count have each."""
        hashes, fits = self.window_hashes(run)
        page = self.page[: len(fits)][fits]
        hashes, kind = hashes[fits], np.where(self.counts[page], self.identity[page], -1)
        order = np.lexsort((kind, hashes))
        hashes, kind = hashes[order], kind[order]
        new = kind >= 0
        new[1:] &= (hashes[1:] != hashes[:-1]) | (kind[1:] != kind[:-1])
        starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(hashes)), bool), hashes[1:] != hashes[:-1]]))
        return hashes[starts], np.add.reduceat(new.astype(np.int64), starts) if len(starts) else np.empty(0, np.int64)


def strip_host(streams: Streams, *, run_tokens: int, min_pages: int, article_share: float, article_pages: int, host_pages: int | None = None, host_windows: tuple[np.ndarray, np.ndarray] | None = None) -> list[tuple[str, int, int, int]]:
    """Of each page of a group its text; its tokens; those that runs cover; and those that go by markup alone.

    Of a host of several groups ``host_pages`` are its distinct pages and ``host_windows`` the windows (hashes, ascending,
    and distinct pages) that ``min_pages`` or more of them have; other windows are rarer than any bar.
    """
    n = len(streams.words)
    n_kinds = streams.n_kinds if host_pages is None else host_pages
    if host_windows is None:
        spread, fits = repeated_windows(streams.words, streams.page, streams.identity, run_tokens)
    else:
        spread, fits = np.zeros(n, np.int64), np.zeros(n, bool)
        hashes, inside = streams.window_hashes(run_tokens)
        fits[: len(hashes)] = inside
        if len(host_windows[0]) and len(hashes):
            place = np.minimum(np.searchsorted(host_windows[0], hashes), len(host_windows[0]) - 1)
            spread[: len(hashes)] = np.where(host_windows[0][place] == hashes, host_windows[1][place], 0)

    def covered_by(bar: int) -> np.ndarray:
        starts = np.flatnonzero(fits & (spread >= bar))
        edge = np.zeros(n + 1, np.int64)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + run_tokens, -1)
        return np.cumsum(edge[:-1]) > 0

    grades = [g for own in streams.grades for g in own]
    sizes = np.fromiter((b.count(b" ") + 1 for own in streams.blocks for b in own), np.int64, len(grades))
    zone = np.repeat(np.array(grades, np.int64) & 3, sizes)
    kept = np.repeat(np.array([k for own in streams.kept for k in own], bool), sizes)
    # a token's own zone sets the bar for the runs that cover it
    covered = np.where(zone >= MAIN, covered_by(max(article_pages, math.ceil(article_share * n_kinds))), covered_by(min_pages))
    ends = np.cumsum(streams.lengths)
    out = []
    for i, blocks in enumerate(streams.blocks):
        a, b = int(ends[i] - streams.lengths[i]), int(ends[i])
        own = covered[a:b] & kept[a:b]
        hit, whole = int(own.sum()), int(kept[a:b].sum())
        # a page all covered, or an article mostly so, is a copy of others and keeps its text
        copy = hit == whole or 2 * hit > whole and max(streams.grades[i], default=0) & 3 >= MAIN
        texts, at = [], 0
        for text, stays in zip(blocks, streams.kept[i], strict=True):
            size = text.count(b" ") + 1
            if stays:
                mask = own[at : at + size]
                texts.append(text if copy or not mask.any() else b" ".join(w for w, gone in zip(text.split(b" "), mask, strict=True) if not gone))
            at += size
        text = b" ".join(t for t in texts if t).decode("utf-8", "surrogatepass")
        out.append((text, b - a, int(covered[a:b].sum()), int((~covered[a:b] & ~kept[a:b]).sum())))
    return out


_SENT = "host string, part long, cell long, pages long, hashes binary, counts binary"
_SENT_ARROW = pa.schema([("host", pa.string()), ("part", pa.int64()), ("cell", pa.int64()), ("pages", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary())])


def _sent(rows: list[tuple]) -> pa.Table:
    return pa.table([list(c) for c in zip(*rows, strict=True)] or [[]] * 6, schema=_SENT_ARROW)


class Cells:
    """How the windows of a host of several groups are parted: by short hashes, in ranges of these."""

    def __init__(self, groups: int, size: int):
        # about sixteen short hashes for each window of a host; a range takes the windows of four groups or more
        self.bits = min(max(2 * size, 1 << 16).bit_length(), 48)
        self.n = min(-(-groups // 4), 1024)
        self.bounds = np.array([(r << self.bits) // self.n for r in range(self.n + 1)], np.uint64)

    def short(self, hashes: np.ndarray) -> np.ndarray:
        return hashes >> _U(64 - self.bits)

    def cuts(self, short: np.ndarray) -> np.ndarray:
        return np.searchsorted(short, self.bounds)


def may_repeat(sent: list[np.ndarray], asked: list[np.ndarray], min_pages: int) -> list[np.ndarray]:
    """Of short hashes that groups sent, each as often as distinct pages of the group have it, and of others that only copies
    in the group have: which of a group's distinct ones may be on ``min_pages`` pages."""
    found, counts = np.unique(np.concatenate(sent), return_counts=True)
    hot = found[counts >= min_pages]
    return [np.isin(np.unique(np.concatenate([own, more])), hot, assume_unique=True) for own, more in zip(sent, asked, strict=True)]


def extract(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", source: str = "html", run_tokens: int = 8, min_pages: int = 3, article_share: float = 0.5, article_pages: int = 5, group_bytes: int = 2 << 20) -> DataFrame:
    """(page_id, url, text, n_chars, n_tokens, n_repeated, n_marked) of every page: n_tokens of its whole stream, of which
    repeated runs cover n_repeated, and n_marked go by markup alone.

    A shuffle of the compressed streams by host and group. Groups are of ``group_bytes`` of HTML or more, up to four times
    as much on large hosts. Windows of hosts of several groups take two exchanges of cells of a host: short hashes, about
    two bytes a window; and hashes and counts of those that may be on ``min_pages`` pages.
    """
    common.ship_package(pages.sparkSession)
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url).cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    named = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), host.alias("host"), F.col(source).cast("string").alias("html"))
    size = F.sum(F.octet_length(F.coalesce("html", F.lit("")))).cast("long")
    of_group = F.least(F.lit(4.0 * group_bytes), F.greatest(F.lit(float(group_bytes)), F.sqrt(F.col("size") * (group_bytes / 16.0))))
    sizes = named.groupBy("host").agg(size.alias("size")).withColumn("groups", F.ceil(F.col("size") / of_group).cast("long"))
    large = common.stash(sizes.where("groups > 1"), "html-hosts")  # at most the input's bytes over group_bytes

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from caselattice.llm import html_extract
        common.held_by("html_extract")

        pack = zstandard.ZstdCompressor(level=3).compress
        met: dict[int, int] = defaultdict(int)
        for batch in batches:
            packed, identity, again = [], [], []
            for h, site in zip(batch.column(3), batch.column(2), strict=True):
                stream, text = html_extract.pack_page(html_extract.parse_page(h.as_py()))
                key = hash((site.as_py(), stream))
                packed.append(pack(stream))
                identity.append(common.bytes_hash(text or b"\n" + stream))
                again.append(met[key])
                met[key] += 1
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(identity, pa.int64()), pa.array(again, pa.int64()), pa.array(packed, pa.binary())], names=["page_id", "url", "host", "identity", "again", "packed"])

    def counting(table: pa.Table) -> tuple[str, int, Cells, Streams]:
        """A group's host and number, its cells, and the streams of its distinct pages, each counted in one group of its host."""
        from caselattice.llm import html_extract

        met: dict[bytes, bool] = {}
        for p, k in zip(table.column("packed").to_pylist(), table.column("again").to_pylist(), strict=True):
            met[p] = met.get(p, False) or not k
        key = {c: table.column(c)[0].as_py() for c in ("host", "part", "groups", "size")}
        return key["host"], key["part"], html_extract.Cells(key["groups"], key["size"]), html_extract.Streams(list(met), list(met.values()))

    def send(table: pa.Table) -> pa.Table:
        common.held_by("html_extract")
        if table.column("groups")[0].as_py() is None:
            return _sent([])
        site, part, cells, streams = counting(table)
        hashes, counts = streams.distinct_windows(run_tokens)
        short = cells.short(hashes)
        own, asked = np.repeat(short, np.minimum(counts, min_pages)), short[counts == 0]
        a, b = cells.cuts(own), cells.cuts(asked)
        return _sent([(site, part, r, streams.n_counted, common.pack_sorted(own[a[r] : a[r + 1]]), common.pack_sorted(asked[b[r] : b[r + 1]])) for r in range(cells.n)])

    def choose(table: pa.Table) -> pa.Table:
        from caselattice.llm import html_extract
        common.held_by("html_extract")

        hot = html_extract.may_repeat(*([common.unpack_sorted(h) for h in table.column(c).to_pylist()] for c in ("hashes", "counts")), min_pages)
        bits = pa.array([common.pack(np.packbits(h)) for h in hot], pa.binary())
        return pa.table([*table.select(["host", "part", "cell", "pages"]).columns, bits, pa.array([b""] * len(hot), pa.binary())], schema=_SENT_ARROW)

    def send_whole(table: pa.Table, chosen: pa.Table) -> pa.Table:
        common.held_by("html_extract")
        if not len(chosen) or not len(table):
            return _sent([])
        site, part, cells, streams = counting(table)
        hashes, counts = streams.distinct_windows(run_tokens)
        short = cells.short(hashes)
        cuts, rows = cells.cuts(short), []
        for r, bits in zip(chosen.column("cell").to_pylist(), chosen.column("hashes").to_pylist(), strict=True):
            own = short[cuts[r] : cuts[r + 1]]
            distinct, place = np.unique(own, return_inverse=True)
            hot = np.unpackbits(common.unpack(bits, np.uint8), count=len(distinct)).astype(bool)[place] if len(own) else np.zeros(0, bool)
            rows.append((site, part, r, streams.n_counted, common.pack_sorted(hashes[cuts[r] : cuts[r + 1]][hot]), common.pack(counts[cuts[r] : cuts[r + 1]][hot].astype(np.uint32))))
        return _sent(rows)

    def merge(table: pa.Table) -> pa.Table:
        common.held_by("html_extract")
        hashes = [common.unpack_sorted(h) for h in table.column("hashes").to_pylist()]
        counts = [common.unpack(c, np.uint32) for c in table.column("counts").to_pylist()]
        found, at = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(at, np.concatenate(counts), minlength=len(found)).astype(np.uint32)
        of_host, start, rows = sum(table.column("pages").to_pylist()), 0, []
        for part, own in zip(table.column("part").to_pylist(), hashes, strict=True):
            sums = total[at[start : start + len(own)]]
            start += len(own)
            rows.append((table.column("host")[0].as_py(), part, table.column("cell")[0].as_py(), of_host, common.pack_sorted(own[sums >= min_pages]), common.pack(sums[sums >= min_pages])))
        return _sent(rows)

    def strip(table: pa.Table, windows: pa.Table) -> pa.Table:
        from caselattice.llm import html_extract
        common.held_by("html_extract")

        own = {}
        if len(windows):
            hashes = np.concatenate([common.unpack_sorted(h) for h in windows.column("hashes").to_pylist()])
            counts = np.concatenate([common.unpack(c, np.uint32) for c in windows.column("counts").to_pylist()]).astype(np.int64)
            order = np.argsort(hashes)
            own = {"host_pages": windows.column("pages")[0].as_py(), "host_windows": (hashes[order], counts[order])}
        packed = table.column("packed").to_pylist()
        distinct = {p: i for i, p in enumerate(dict.fromkeys(packed))}
        found = html_extract.strip_host(html_extract.Streams(list(distinct)), run_tokens=run_tokens, min_pages=min_pages, article_share=article_share, article_pages=article_pages, **own)
        rows = [found[distinct[p]] for p in packed]
        numbers = [pa.array([r[k] for r in rows], pa.int64()) for k in (1, 2, 3)]
        texts = [r[0] for r in rows]
        return pa.table([table.column("page_id"), table.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), *numbers], names=["page_id", "url", "text", "n_chars", "n_tokens", "n_repeated", "n_marked"])

    parsed = named.mapInArrow(parse, "page_id long, url string, host string, identity long, again long, packed binary")
    part = F.when(F.col("groups").isNull(), F.lit(0).cast("long")).otherwise(F.pmod(F.xxhash64("identity", "again"), F.col("groups")))
    dealt = parsed.join(large, "host", "left").withColumn("part", part).groupBy("host", "part")
    chosen = dealt.applyInArrow(send, _SENT).groupBy("host", "cell").applyInArrow(choose, _SENT)
    windows = dealt.cogroup(chosen.groupBy("host", "part")).applyInArrow(send_whole, _SENT).groupBy("host", "cell").applyInArrow(merge, _SENT)
    return dealt.cogroup(windows.groupBy("host", "part")).applyInArrow(strip, "page_id long, url string, text string, n_chars long, n_tokens long, n_repeated long, n_marked long")
