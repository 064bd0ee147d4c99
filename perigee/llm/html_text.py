"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. First pass: marked-up regions that are never
article text (menus, footers, forms, adverts, comments, ...) and blocks made of links are
boilerplate; long blocks with enough stop words, or long ones inside an article element, are
text; what is long but has few stop words outside an article is boilerplate; the rest, short
blocks and unusual ones inside an article, stay undecided. Second pass: an undecided block takes
the label of its nearest decided neighbour in the same region, text if two are equally near and
differ; in a region without decided blocks, article elements hold text and others don't. On a
page with an article element nothing outside of it is text, unless more long text stands outside
of all of them than inside (teasers beside a story): then they are no regions.

Where hardly any long block has enough stop words, the page's language is taken as unknown, and long
blocks are text unless made of links. Without any long text outside articles, short blocks that
aren't links are text if together they are long. A class or id doesn't remove an article (or main)
that is the page's text: articles inside elements so named, or so named themselves, count only if
fewer such names give no long text, so comments that are articles stay out beside the real one.

Defined results. Null or empty html, or a page without text: an empty text. Unclosed comments,
tags and elements run to the end of what encloses them. Null page_id or url: kept. Repeated
rows are each extracted. An empty table gives an empty result. Extra columns are ignored. Pages
of any length are read whole, in one pass over their tags.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Blocks below are short: their words alone don't decide.
SHORT = 70
#: Share of stop words from which a long block is text.
STOP_SHARE = 0.2
#: Share of the long blocks' characters in blocks with enough stop words below which a page's language is unknown.
KNOWN_SHARE = 0.1
#: Share of a block's characters inside links from which it is boilerplate.
LINK_SHARE = 0.5

# Tag names by their role in HTML, names that sites give to regions, stop words.
_BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
                   "h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
_NEVER = frozenset("aside button canvas dialog fieldset footer form head menu nav object option select svg template".split())
_REGION = frozenset("article main".split())
_NAMES = frozenset("ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
                   "footer login masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted related respond "
                   "reviews search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split())
#: Words after which a name in a class or id tells how an element looks: "has-sidebar".
_LOOKS = frozenset("has hide no with without".split())
_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
_STOP = frozenset((
    "a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their they this to was we were which with you "
    "au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas pour qui que sa se ses son sur un une vous "
    "aber als am auch auf aus bei das dem den der des die ein eine einer es für hat ich im in ist mit nach nicht oder sich sie sind und von war wie zu zum "
    "al como con de del el ella en es esta este ha la las lo los más no o para pero por que se sin sobre su sus un una y ya"
).split())

_TAG = re.compile(r"</?([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_ATTRIBUTE = re.compile(r"(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/]|$)", re.I)
_WORD = re.compile(r"[^\W\d_]+")
_NAME = re.compile(r"[a-z0-9]+")


def _named(value: str) -> bool:
    """Whether a class or id holds a name of a region that is never article text."""
    for one in value.split():
        before = ""
        for part in _NAME.findall(one):
            if part in _NAMES and before not in _LOOKS:
                return True
            before = part
    return False


def _boilerplate(tag: str, attributes: str, in_region: bool) -> tuple[bool, bool]:
    """Whether an element is marked up as something that is never article text, and whether it only has such a name."""
    if tag in _NEVER or (tag == "header" and not in_region):
        return True, False
    if not attributes:
        return False, False
    named = False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name in ("class", "id") and tag not in ("html", "body") and _named(value):
            named = True
        if (name == "role" and value in _ROLES) or name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True, False
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True, False
    return False, named


class _Blocks:
    """Blocks of a page: [text, characters in links, region, whether inside boilerplate]. Region 0: outside articles."""

    def __init__(self, page: str):
        self.blocks: list = []
        self.parts: list = []
        self.linked = 0
        self.named = 0  # open elements that have a name of boilerplate
        self.depths = [0]  # of each region, how many of them enclose it
        self.open: list = []  # (tag, region before, boilerplate before, named before) of open elements that matter
        self.places: dict = {}  # tag to its places in ``open``
        self.region = self.regions = self.links = 0
        self.never = False
        self.read(page)
        self.flush()
        self.choose()

    def flush(self):
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append((text, self.linked, self.region, self.never or self.named > self.depths[self.region]))
        self.parts, self.linked = [], 0

    def choose(self):
        """Regions inside more named elements than it takes to have long text are boilerplate."""
        if not any(self.depths):
            return
        depths = [self.depths[b[2]] for b in self.blocks if not b[3] and (b[2] or _enough(b[0]))]
        long = [self.depths[b[2]] for b in self.blocks if not b[3] and _first_pass(*b, False)]
        most = min(long or depths, default=0)
        self.blocks = [b if self.depths[b[2]] <= most else (b[0], b[1], 0, True) for b in self.blocks]

    def text(self, piece: str):
        if piece:
            piece = html.unescape(piece) if "&" in piece else piece
            self.parts.append(piece)
            if self.links:
                self.linked += len("".join(piece.split()))

    def start(self, tag: str, attributes: str):
        if tag in _BLOCK:
            self.flush()
            self.links = 0
        elif tag in ("br", "td", "th", "img"):
            self.parts.append(" ")
        if tag == "a":
            self.links = 1
        if tag in _VOID or (tag not in _BLOCK and tag not in _NEVER and tag not in ("span", "ins", "center")):
            return
        never, named = _boilerplate(tag, attributes, self.region > 0)
        if (never or named) and tag not in _BLOCK:
            self.flush()
        if tag in ("p", "li", "tr") and not never and not named:
            return  # often left open; nothing depends on where they end
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, self.region, self.never, self.named))
        self.never |= never
        self.named += named
        if tag in _REGION and not self.never and (not self.region or self.named > self.depths[self.region]):
            self.regions += 1
            self.region = self.regions
            self.depths.append(self.named)

    def end(self, tag: str):
        if tag in _BLOCK:
            self.flush()
            self.links = 0
        if tag == "a":
            self.links = 0
        if not self.places.get(tag):
            return
        at = self.places[tag][-1]
        _, region, never, named = self.open[at]
        if (never, named) != (self.never, self.named):
            self.flush()
        self.region, self.never, self.named = region, never, named
        while len(self.open) > at:
            self.places[self.open.pop()[0]].pop()

    def read(self, page: str):
        at, size = 0, len(page)
        while at < size:
            lt = page.find("<", at)
            if lt < 0:
                self.text(page[at:])
                return
            self.text(page[at:lt])
            following = page[lt + 1 : lt + 2]
            if following == "!" or following == "?":
                closing = "-->" if page.startswith("<!--", lt) else ">"
                stop = page.find(closing, lt + 2)
                if stop < 0:
                    return
                at = stop + len(closing)
                continue
            m = _TAG.match(page, lt)
            if m is None:
                if following.isalpha() or following == "/":
                    stop = page.find(">", lt)
                    if stop < 0:
                        return  # a tag that never ends
                    at = stop + 1
                else:
                    self.text("<")
                    at = lt + 1
                continue
            at, tag = m.end(), m[1].lower()
            if following == "/":
                self.end(tag)
            elif tag in _RAW:
                stop = re.compile(f"</{tag}(?=[\\s/>])", re.I).search(page, at)
                if stop is None:
                    return
                at = page.find(">", stop.end()) + 1 or size
                self.parts.append(" ")
            else:
                self.start(tag, m[2])


def _enough(text: str) -> bool:
    words = _WORD.findall(text.lower())
    return sum(w in _STOP for w in words) / max(1, len(words)) >= STOP_SHARE


def _first_pass(text: str, linked: int, region: int, never: bool, has_region: bool) -> bool | None:
    if never or (has_region and not region):
        return False
    if linked > LINK_SHARE * len(text.replace(" ", "")):
        return False
    if len(text) < SHORT:
        return None
    if _enough(text):
        return True
    return None if region else False


def _without_teasers(blocks: list) -> list:
    """Blocks whose regions don't count if more long text stands outside of all of them, as beside a teaser."""
    if not any(region for _, _, region, _ in blocks):
        return blocks
    size = [0, 0]
    for text, linked, region, never in blocks:
        if not never and len(text) >= SHORT and linked <= LINK_SHARE * len(text.replace(" ", "")) and (region or _enough(text)):
            size[region > 0] += len(text)
    return blocks if size[1] >= size[0] else [(text, linked, 0, never) for text, linked, _, never in blocks]


def labels(blocks: list) -> list:
    """Whether each block is text."""
    blocks = _without_teasers(blocks)
    has_region = any(region for _, _, region, _ in blocks)
    first = [_first_pass(*b, has_region) for b in blocks]
    if not has_region:
        plain = [i for i, b in enumerate(blocks) if not b[3] and b[1] <= LINK_SHARE * len(b[0].replace(" ", ""))]
        long = [i for i in plain if len(blocks[i][0]) >= SHORT]
        size = lambda which: sum(len(blocks[i][0]) for i in which)
        unknown = size(i for i in long if first[i]) < KNOWN_SHARE * size(long)
        if unknown or (not long and size(plain) >= SHORT):
            for i in long or plain:
                first[i] = True
    out = list(first)
    decided: dict = {}
    before = []
    for i, b in enumerate(blocks):
        before.append(decided.get(b[2]))
        if first[i] is not None and not b[3]:
            decided[b[2]] = i
    decided.clear()
    for i in range(len(blocks) - 1, -1, -1):
        region = blocks[i][2]
        if first[i] is None:
            near = [j for j in (before[i], decided.get(region)) if j is not None]
            if near:
                least = min(abs(j - i) for j in near)
                out[i] = any(first[j] for j in near if abs(j - i) == least)
            else:
                out[i] = region > 0
        elif not blocks[i][3]:
            decided[region] = i
    return out


def main_text(page: str | None) -> str:
    blocks = _Blocks(page or "").blocks
    return "\n".join(b[0] for b, keep in zip(blocks, labels(blocks), strict=True) if keep)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html)."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [main_text(h) for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url").cast(pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema=schema)

    wanted = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return wanted.mapInArrow(run, "page_id long, url string, text string, n_chars long")
