"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags.  The first pass decides blocks by where they stand
(inside an article, or inside a menu, header, footer, sidebar, notice, advert, form or
comments), by the share of their characters that lie in links, by length and by the share
of stop words among their words.  Short blocks that none of this decides are ambiguous.  The second pass
gives each of them the label of the nearest decided block: headings that of the block they
stand over, blocks of an article only that of blocks of the same article.

The scanner is linear in the page's length: tags are found one after another, and an unclosed quote,
comment or script ends the search for its end once.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LONG = 70  # characters of a block that is not short
STOP_SHARE = 0.25  # share of stop words of running text
LINK_SHARE = 0.34  # share of linked characters of a list of links
LINK_SHARE_ARTICLE = 0.6  # the same inside an article

# Common function words of the languages that pages come in.
STOP_WORDS = frozenset("""
a about all an and are as at be but by can for from had has have he her his i if in into is it
its not of on one or she so than that the their them there they this to was we were what when
which who will with would you your
aber als am an auch auf aus bei bin bis das dass dem den der des die durch ein eine einem einen
einer er es für hat ich im ist mit nach nicht noch nur oder sein sich sie sind so über um und
von vor war was wie wir zu zum zur
au aux avec ce ces cette comme dans de des du elle en est et eu il ils je la le les leur lui
mais ne nous on ou où par pas plus pour qu que qui sa se ses son sont sur un une vous
al como con cuando del el ella ellos entre era es esta este ha hay lo los más me mi muy no nos
o para pero por porque que se si sin sobre su sus también te un una y ya
""".split())

# HTML elements by what they mean here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""
address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu
nav ol option p pre search section select summary table tbody td tfoot th thead tr ul
""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
RAW = frozenset("iframe noembed noframes noscript script style textarea title xmp".split())
UNSEEN = frozenset("""
audio button canvas datalist map math object optgroup option select svg template video
""".split())
OUTSIDE = frozenset("aside dialog fieldset footer form menu nav search".split())
ROLES = frozenset("""
alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search
status tablist toolbar
""".split())

# Parts of class names and ids that mark what is not the article.
NAME_PARTS = frozenset("""
ad ads advert advertisement advertising adverts alert aside banner breadcrumb breadcrumbs comment
comments consent cookie cookies disqus footer form gdpr login masthead menu modal nav navbar
navigation newsletter notice pager pagination popup promo promotion related replies reply
respond search share sharing sidebar signup social sponsor sponsored subscribe subscription
toolbar widget
""".split())
COMMENTS = frozenset("comment comments disqus replies reply respond".split())
# a header with one of these in its name, or inside an article, is the article's own
OWN_HEADER = frozenset("article entry post section story content".split())
NEGATIONS = frozenset("has no with without".split())

# closing one of these at the start of another, up to the list or table that holds both
_SIBLINGS = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "option": ("option",),
             "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th")}
_HOLDERS = frozenset("ul ol menu dir dl select table".split())
_FENCES = frozenset("article main body html".split())

_TAG_NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
_TAG_END = re.compile(r"""[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+)*+>""")
_ATTR = re.compile(r"""([^\s"'=<>/]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_WORD = re.compile(r"[^\W\d_]+")

NEUTRAL, ARTICLE, BAD, HIDDEN = 0, 1, 2, 3  # zones


@dataclass(slots=True)
class Block:
    text: str
    linked: int  # characters in links
    zone: int
    article: int  # number of the innermost article, 0 outside
    heading: bool


def name_parts(value: str) -> list[set[str]]:
    """Lower-case words of each class name or id in an attribute."""
    return [{p.lower() for p in _PART.findall(n)} for n in value.split()]


class _Scanner:
    def __init__(self, page: str):
        self.page = page
        self.blocks: list[Block] = []
        self.stack: list[tuple[str, int, bool, int]] = []  # tag, zone, sticky, article
        self.open: dict[str, list[int]] = {}  # positions of a tag in the stack
        self.text: list[str] = []
        self.linked = 0
        self.place = (NEUTRAL, 0, False)  # of the text collected
        self.articles = 0

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            zone, article, heading = self.place
            self.blocks.append(Block(text, self.linked, zone, article, heading))
        self.text, self.linked = [], 0

    def add(self, raw: str) -> None:
        _, zone, _, article = self.stack[-1] if self.stack else ("", NEUTRAL, False, 0)
        if zone == HIDDEN or not raw:
            return
        place = (zone, article, any(self.open.get(h) for h in HEADINGS))
        if place != self.place:
            self.flush()
            self.place = place
        text = html.unescape(raw) if "&" in raw else raw
        self.text.append(text)
        if self.open.get("a"):
            self.linked += len("".join(text.split()))

    def pop_to(self, at: int) -> None:
        while len(self.stack) > at:
            tag = self.stack.pop()[0]
            if tag in BLOCK:
                self.flush()
            self.open[tag].pop()

    def last(self, tag: str) -> int:
        at = self.open.get(tag)
        return at[-1] if at else -1

    def start(self, tag: str, raw: str) -> None:
        if tag in BLOCK:
            self.flush()
            p = self.last("p")
            if p >= 0 and all(t not in BLOCK for t, *_ in self.stack[p + 1:]):
                self.pop_to(p)
        if tag in _SIBLINGS:
            holder = max((self.last(h) for h in _HOLDERS), default=-1)
            at = [self.last(s) for s in _SIBLINGS[tag] if self.last(s) > holder]
            if at:
                self.pop_to(min(at))
        elif tag == "a" and self.last("a") >= 0:
            self.pop_to(self.last("a"))
        if tag == "br":
            self.add("\n")
        if tag in VOID:
            return
        zone, sticky, article = self.zone(tag, raw)
        self.open.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, zone, sticky, article))

    def zone(self, tag: str, raw: str) -> tuple[int, bool, int]:
        """Zone, whether an article inside stays outside, and the article of an element."""
        _, zone, sticky, article = self.stack[-1] if self.stack else ("", NEUTRAL, False, 0)
        if zone == HIDDEN or tag in UNSEEN:
            return HIDDEN, True, article
        names: list[set[str]] = []
        role, prop = "", ""
        if "=" in raw and tag not in ("html", "body"):
            for k, v in _ATTR.findall(raw):
                v = v.strip("\"'")
                k = k.lower()
                if k == "role":
                    role = v.strip().lower()
                elif k == "itemprop":
                    prop = v
                elif k in ("class", "id"):
                    names += [n for n in name_parts(v) if not n & NEGATIONS]
        parts = set().union(*names) if names else set()
        if tag in ("article", "main") or role == "main" or prop == "articleBody":
            if parts & COMMENTS or (zone == BAD and sticky):
                return BAD, True, article
            self.articles += 1
            # a main element's articles belong to it
            return ARTICLE, False, article or self.articles
        if tag in OUTSIDE or role in ROLES or parts & NAME_PARTS:
            return BAD, tag in OUTSIDE or bool(parts & COMMENTS) or sticky, article
        head = tag == "header" or any("header" in n and not n & OWN_HEADER for n in names)
        if head and zone != ARTICLE:
            return BAD, False, article
        return zone, sticky, article

    def end(self, tag: str) -> None:
        at = self.last(tag)
        if tag in BLOCK:
            self.flush()
            if tag not in _FENCES and at < max(self.last(f) for f in _FENCES):
                return
        elif at >= 0 and any(t in BLOCK for t, *_ in self.stack[at + 1:at + 65]):
            return
        if at >= 0:
            self.pop_to(at)

    def run(self) -> list[Block]:
        page, pos, size = self.page, 0, len(self.page)
        strict = True
        while pos < size:
            lt = page.find("<", pos)
            if lt < 0:
                self.add(page[pos:])
                break
            self.add(page[pos:lt])
            if page.startswith("<!--", lt):
                end = page.find("-->", lt + 2)  # "<!-->" is a whole comment
                pos = size if end < 0 else end + 3
                continue
            if page.startswith(("<!", "<?"), lt):
                end = page.find(">", lt)
                pos = size if end < 0 else end + 1
                continue
            m = _TAG_NAME.match(page, lt + 1)
            if not m:
                self.add("<")
                pos = lt + 1
                continue
            stop = _TAG_END.match(page, m.end()) if strict else None
            if stop:
                end = stop.end()
            else:  # a quote that never ends: from here on tags end at the next ">"
                strict = False
                end = page.find(">", m.end()) + 1
                if not end:
                    break
            tag = m.group().lower()
            pos = end
            if tag[0] == "/":
                self.end(tag[1:])
                continue
            self.start(tag, page[m.end():end - 1])
            if tag in RAW:
                close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, pos)
                pos = close.start() if close else size
            elif page[end - 2] == "/" and tag in ("svg", "math", "path"):
                self.end(tag)
        self.flush()
        return self.blocks


def blocks(page: str) -> list[Block]:
    """Blocks of a page in order, with the zone each stands in."""
    return _Scanner(page).run()


def stop_share(text: str) -> float:
    words = _WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0


def first_pass(found: list[Block]) -> list[bool | None]:
    """True (main text), False or None (ambiguous) for each block."""
    out: list[bool | None] = []
    for b in found:
        share = b.linked / max(1, len(b.text) - b.text.count(" "))
        if b.zone == BAD or share > (LINK_SHARE_ARTICLE if b.zone == ARTICLE else LINK_SHARE):
            out.append(False)
        elif len(b.text) < LONG:
            out.append(None)
        elif b.zone == ARTICLE:
            out.append(True)
        else:
            out.append(stop_share(b.text) >= STOP_SHARE)
    inside = sum(len(b.text) for b, y in zip(found, out) if y and b.zone == ARTICLE)
    outside = sum(len(b.text) for b, y in zip(found, out) if y and b.zone == NEUTRAL)
    if inside and inside >= outside:  # the page marks its article
        out = [False if b.zone == NEUTRAL else y for b, y in zip(found, out)]
    return out


def second_pass(found: list[Block], label: list[bool | None]) -> list[bool]:
    """Labels with ambiguous blocks decided by their nearest decided neighbours, among the blocks
    that stand in no menu, advert and so on.

    Of two neighbours equally near that differ, the first block under a heading decides the
    heading, otherwise an article's block is main text and another is not.  Without any neighbour
    an article's block is main text.  The page's ends count as neighbours that are not main
    text, unless the page has no block of main text: then all undecided blocks are."""
    def scan(order: range) -> list[tuple[int, bool | None]]:
        """(distance, label) of the next decided block in one direction, by scope."""
        seen: dict[int, tuple[int, bool]] = {}
        out: list[tuple[int, bool | None]] = [(0, None)] * len(found)
        edge = order[0] - order.step if len(order) else 0
        for i in order:
            b = found[i]
            scope = b.article if b.zone == ARTICLE else 0
            if label[i] is not None:
                seen[scope] = (i, label[i])
            elif scope in seen:
                out[i] = (abs(i - seen[scope][0]), seen[scope][1])
            elif not scope:
                out[i] = (abs(i - edge), False)
        return out

    if not any(label):
        return [y is None for y in label]
    rest = [i for i, b in enumerate(found) if b.zone != BAD]
    if len(rest) < len(found):
        kept = second_pass([found[i] for i in rest], [label[i] for i in rest])
        where = dict(zip(rest, kept))
        return [where.get(i, False) for i in range(len(found))]
    before = scan(range(len(found)))
    after = scan(range(len(found) - 1, -1, -1))
    out = []
    for b, y, (d1, y1), (d2, y2) in zip(found, label, before, after):
        if y is None:
            if y1 is None or y2 is None:
                y = y2 if y1 is None else y1
                y = b.zone == ARTICLE if y is None else y
            elif y1 == y2:
                y = y1
            elif b.heading:
                y = y2
            elif d1 != d2:
                y = y1 if d1 < d2 else y2
            else:
                y = b.zone == ARTICLE
        out.append(y)
    return out


def extract(page: str | None) -> str:
    """Main text of a page: its blocks joined by one space.  Null and empty pages have none."""
    found = blocks(page or "")
    keep = second_pass(found, first_pass(found))
    return " ".join(b.text for b, y in zip(found, keep) if y)


def main_text(page: Column) -> Column:
    """Main text (string) of the HTML in ``page``."""
    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            yield pa.array((extract(x.as_py()) for x in b), pa.string())

    return run(page)


def extract_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
                  keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """id, the columns ``keep``, text (main text of the whole page) and n_chars (its code points).

    Null and empty pages have an empty text and 0 characters.  Ids may be null or repeat: every row
    is a page.  Other columns are not read.  White space is what Unicode calls so."""
    cols = [F.col(f"`{c}`") for c in (id_col, *keep)]
    out = pages.select(*cols, main_text(F.col(f"`{html_col}`")).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
