"""Main text of web pages: text-to-tag ratios of blocks, smoothed and clustered by a threshold.

The standard library's parser streams a page's events into blocks. Each block has a ratio, its
characters that are no link by its tags (at most CLIP, so that long paragraphs do not hide short ones); a
Gaussian smooths the ratios along the page, and blocks above the threshold
(the ratios' standard deviation, at most the largest smoothed ratio) are the cluster of content. Two
answers are formed of it: the article and main elements that hold its blocks, without runs of links at
their ends; and outside of these the stretch from its first to its last block, grown over the adjoining blocks to the ends of the
container of both (a link list of another container ends it), with the headings before it. The one with
more text that is no link is kept. Elements that are never article text (menus, scripts, forms, adverts,
comments and so on, by tag, role or class) are left out of both; an article or main that only a name
around it leaves out is taken instead when it alone has more text. A page is one row; only the parser is
Python per row.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIGMA = 1.0
#: Characters by tags that a block counts at most.
CLIP = 100.0
#: Blocks whose ratios are below this part of the threshold are links and the like.
LOW = 0.02
BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset("aside button canvas dialog fieldset footer form head iframe label menu nav noscript object option script select style svg template textarea title".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
REGIONS = frozenset(("article", "main"))
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Where a stretch of text may end.
CONTAINERS = frozenset("article blockquote body center details div html main section td".split())
#: What an element's text is: kept; left out; left out by a name around it; in an article or main below such a name.
KEPT, OUT, NAMED, REVIVED = range(4)
#: Class and id names.
NAMES = frozenset("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs byline captcha comment comments consent cookie cookies copyright disqus dropdown gdpr login masthead menu modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promotion recommended related replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget widgets".split())
OUTSIDE = frozenset(("footer", "header"))
#: Parts that a name may be joined with (comment-list, site-footer) and still be that name; others (no-sidebar, social-science) make another.
PARTS = frozenset("area bar block bottom box button buttons container count inner item items left link links list outer right section site slot top wrap wrapper".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
STOPS = frozenset("ul ol dl table div section article main body html td th".split())


#: A name around a whole page: its text counts where there is no other.
WRAPPERS = frozenset("search widget widgets".split())


class Block(NamedTuple):
    text: str
    tags: int
    out: int
    region: int
    heading: bool
    linked: int  # characters of links
    inside: int  # number of the innermost container, 0 for none
    wrapped: bool  # left out by the name of a wrapper only


class Open(NamedTuple):
    tag: str
    out: int
    region: int
    around: int  # what the text around the element is
    wrapped: bool


class Blocks(HTMLParser):
    """Collects the blocks of a page. Open elements lie on a stack, with a stack of places for each tag, so an event costs no walk over them."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[Open | None] = []  # None: ended before the elements inside it
        self.at: dict[str, list[int]] = {}
        self.blocks_at: list[int] = []
        self.containers: list[tuple[int, int]] = []  # place and number
        self.outer: dict[int, int] = {0: 0}
        self.ends: dict[int, int] = {}  # number of the last container inside
        self.blocks: list[Block] = []
        self.text: list[str] = []
        self.tags = self.regions = self.linked = self.opened = 0
        self.roots: set[int] = set()

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            last = self.open[-1] if self.open else Open("", KEPT, 0, KEPT, False)
            heading = any(o is not None and o.tag in HEADINGS for o in self.open[-3:])
            inside = self.containers[-1][1] if self.containers else 0
            self.blocks.append(Block(text, max(1, self.tags), last.out, last.region, heading, min(self.linked, len(text)), inside, last.wrapped))
            self.tags = 0
        self.text, self.linked = [], 0

    def last(self, tags: Iterable[str]) -> int:
        """Place of the innermost open element with one of the tags, or -1."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=-1)

    def cut(self, place: int) -> None:
        """End all elements from the place on."""
        while len(self.open) > place or (self.open and self.open[-1] is None):
            ended = self.open.pop()
            if ended is not None:
                self.at[ended.tag].pop()
        while self.blocks_at and self.blocks_at[-1] >= len(self.open):
            self.blocks_at.pop()
        while self.containers and self.containers[-1][0] >= len(self.open):
            self.ends[self.containers.pop()[1]] = self.opened

    def end_inner(self, tags: Iterable[str], stops: Iterable[str]) -> None:
        place = self.last(tags)
        if place > self.last(stops):
            self.cut(place)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCKS:
            self.flush()
            self.end_inner(("p",), STOPS)
            if tag in CLOSES:
                self.end_inner(CLOSES[tag], ("ul", "ol", "dl", "table"))
        elif tag == "br":
            self.text.append(" ")
        self.tags += 1
        if tag in VOID:
            return
        last = self.open[-1] if self.open else Open("", KEPT, 0, KEPT, False)
        out, region, wrapped = last.out, last.region, last.wrapped
        # A tag that is left out changes what its text belongs to, so text before it ends a block.
        mark, wrapper = (OUT, False) if out == OUT else self.left_out(tag, dict(attrs), region)
        if mark and out in (KEPT, REVIVED):
            if tag not in BLOCKS:
                self.flush()
            out, wrapped = (mark, wrapper) if out == KEPT else (OUT, False)
        elif out == NAMED and mark == OUT:
            out = OUT
        elif out == NAMED and tag in REGIONS:
            out, region = REVIVED, 0
        elif out == NAMED and mark == NAMED:
            wrapped = wrapped and wrapper
        if tag in REGIONS and not region:
            self.regions += 1
            region = self.regions
        place = len(self.open)
        if tag in CONTAINERS:
            self.opened += 1
            self.outer[self.opened] = self.containers[-1][1] if self.containers else 0
            self.containers.append((place, self.opened))
            if tag in ("html", "body"):
                self.roots.add(self.opened)
        if tag in BLOCKS:
            self.blocks_at.append(place)
        self.at.setdefault(tag, []).append(place)
        self.open.append(Open(tag, out, region, last.out, wrapped))

    def left_out(self, tag: str, attrs: dict, region: int) -> tuple[int, bool]:
        """What the element's text is, and whether only a wrapper's name says so."""
        if tag in DROPPED or (tag == "header" and not region):
            return OUT, False
        if "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in (attrs.get("style") or "").replace(" ", "").lower():
            return OUT, False
        if (attrs.get("role") or "").lower() in ROLES:
            return OUT, False
        if tag in REGIONS or tag in ("html", "body"):
            return KEPT, False
        names = NAMES if region else NAMES | OUTSIDE
        found = []
        for token in f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower().split():
            parts = [w for w in token.replace("_", "-").split("-") if w and not w.isdigit()]
            own = [w for w in parts if w in names]
            if own and all(w in names or w in PARTS for w in parts):
                found += own
        return (NAMED, all(w in WRAPPERS for w in found)) if found else (KEPT, False)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        place = self.last((tag,))
        if place < 0:
            if tag in BLOCKS:
                self.flush()
            return
        ended = self.open[place]
        if tag in BLOCKS or ended.out != ended.around:
            self.flush()
        elif self.blocks_at and self.blocks_at[-1] > place:
            # An inline element that a block element overlaps: only it ends.
            self.open[place] = None
            self.at[tag].pop()
            return
        self.cut(place)

    def handle_data(self, data: str) -> None:
        self.text.append(data)
        if self.at.get("a"):
            self.linked += len(" ".join(data.split()))


def smooth(ratios: list[float], sigma: float) -> list[float]:
    radius = max(1, math.ceil(2 * sigma))
    kernel = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-radius, radius + 1)]
    total = sum(kernel)
    n = len(ratios)
    return [sum(w * ratios[min(n - 1, max(0, i + k - radius))] for k, w in enumerate(kernel)) / total for i in range(n)]


def main_text(html: str | None, sigma: float = SIGMA) -> str:
    parser = Blocks()
    parser.feed(html or "")
    parser.close()
    parser.flush()
    parser.cut(0)
    blocks = parser.blocks
    chosen = _chosen(blocks, parser, sigma)
    revived: dict[int, list[int]] = {}
    for i, b in enumerate(blocks):
        if b.out == REVIVED:
            revived.setdefault(b.region, []).append(i)
    if revived:
        other = max(revived.values(), key=lambda own: _mass(blocks, own))
        if _mass(blocks, other) > _mass(blocks, chosen):
            chosen = other
    if not _mass(blocks, chosen) and any(b.wrapped for b in blocks):
        blocks = [b._replace(out=KEPT) if b.out == NAMED and b.wrapped else b for b in blocks]
        chosen = _chosen(blocks, parser, sigma)
    return "\n".join(blocks[i].text for i in chosen)


def _mass(blocks: list[Block], rows: list[int]) -> int:
    """Characters that are no link."""
    return sum(len(blocks[i].text) - blocks[i].linked for i in rows)


def _chosen(blocks: list[Block], page: Blocks, sigma: float) -> list[int]:
    fit = [i for i, b in enumerate(blocks) if not b.out]
    if not fit:
        return []
    ratios = [0.0 if b.out else min(CLIP, (len(b.text) - b.linked) / b.tags) for b in blocks]
    near = smooth(ratios, sigma)
    mean = sum(near) / len(near)
    threshold = min(math.sqrt(sum((x - mean) ** 2 for x in near) / len(near)), max(near[i] for i in fit))
    content = [i for i in fit if near[i] >= threshold]
    regions = {blocks[i].region for i in content} - {0}
    held: dict[int, list[int]] = {}
    for i in fit:
        if blocks[i].region in regions:
            held.setdefault(blocks[i].region, []).append(i)
    inside = sorted(i for own in held.values() for i in _trimmed(own, blocks, ratios, near, LOW * threshold))
    content = [i for i in content if not blocks[i].region]
    if not content:
        return inside
    outside = _grown(blocks, page, content)
    # A stretch may hold regions; they count for both.
    return inside if regions and _mass(blocks, inside) >= _mass(blocks, [i for i in outside if not blocks[i].region]) else outside


def _trimmed(own: list[int], blocks: list[Block], ratios: list[float], near: list[float], low: float) -> list[int]:
    """A region's blocks without the runs of links at its ends. A link or two beside text keep some of its
    smoothed ratio and stay; a run with a block that has none goes whole. Headings before the text are no part of a run."""
    text = [k for k, i in enumerate(own) if ratios[i] > low or blocks[i].heading]
    if not text:
        return own
    first, last = text[0], text[-1] + 1
    if all(near[i] > low for i in own[:first]):
        first = 0
    if all(near[i] > low for i in own[last:]):
        last = len(own)
    return own[first:last]


def _grown(blocks: list[Block], page: Blocks, content: list[int]) -> list[int]:
    """The stretch of the content blocks to the ends of the innermost container of them all."""

    def holds(container: int, other: int) -> bool:
        return not container or container <= other <= page.ends[container]

    common = blocks[content[0]].inside
    for i in content:
        while not holds(common, blocks[i].inside):
            common = page.outer[common]
    own = {blocks[i].inside for i in content} - page.roots - {0}
    first, last = content[0], content[-1]

    def adjoins(i: int) -> bool:
        """Left-out blocks are passed over."""
        b = blocks[i]
        if not holds(common, b.inside) or b.region:
            return False
        return bool(b.out) or 2 * b.linked <= len(b.text) or b.inside in own

    while first > 0 and adjoins(first - 1):
        first -= 1
    while last + 1 < len(blocks) and adjoins(last + 1):
        last += 1
    while first > 0 and not blocks[first - 1].out and blocks[first - 1].heading:
        first -= 1
    return [i for i in range(first, last + 1) if not blocks[i].out]


def _extract(sigma: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for at in range(0, big.num_rows, 256):
                b = big.slice(at, 256)
                texts = [main_text(h, sigma) for h in b.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return run


def extract(pages: DataFrame, *, sigma: float = SIGMA) -> DataFrame:
    """page_id, url, text, n_chars for each row of pages.

    A null or empty html, or a page of nothing but left-out elements, gives an empty text. White
    space within a block is one space, blocks are joined by a line feed in page order, character
    references are decoded. Repeated rows give equal rows; other columns are ignored; an empty table
    gives an empty result.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(_extract(sigma), "page_id long, url string, text string, n_chars long")
