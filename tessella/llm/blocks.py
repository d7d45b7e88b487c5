"""The main text of web pages by two passes of rules over blocks.

A page is cut into blocks at tags that end a line. The first pass decides each block alone: what stands in navigation, forms, notices,
adverts, comments and the like is left out; of the rest, density of links, length and density of stop words make a block good, bad, near (nearly good) or
short (too short to tell). A block within an article element is good unless it is a list or table of links, however short it is or
strange its words are. The second pass lets near and short blocks inherit: the label of the nearest decided
neighbours on both sides, good if both are good, and for a near block if either is; a heading follows the block that it heads.
Where a page has an article, blocks outside it start as bad, except for headings.

Pages are judged one by one, so there is neither a shuffle nor a state beyond one page.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of elements, and words of class and id that mark what is not the article.
SKIPPED = frozenset("script style noscript template head title svg math canvas object iframe select textarea datalist audio video".split())
RAW = frozenset("script style title textarea".split())  # of these, one without an end takes the rest of the page
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LEFT_OUT = frozenset("nav footer aside form dialog menu button".split())
ARTICLE = frozenset("article main".split())
LINE = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
KEPT_OPEN = LINE - frozenset("br hr".split())  # elements that have an end
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
GROUPS = frozenset("ul ol dl table menu".split())
MARKS = frozenset(
    "ad ads adbox adslot advert advertisement advertising adverts alert banner breadcrumb breadcrumbs byline-share comment commentlist comments consent cookie cookies copyright disqus footer gdpr login masthead menu "
    "modal nav navbar navigation newsletter notice notices pagination pager popup promo promoted promotion related replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe "
    "subscription tags toolbar topbar widget".split()
)
STATES = ("has-", "with-", "no-", "is-", "js-")  # beginnings of class names that say what a wrapper holds, not what it is
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
STOP_WORDS = frozenset(
    # English, German, French, Spanish
    "the of and to a in is that it for was on are as with be at by this have from or not but which they his her "
    "der die das und in zu den von mit ist im für auf nicht ein eine dem des sich als auch es an werden aus er sie "
    "le la les de des et un une du en que qui dans est pour au il pas sur par plus avec ne se ce elle son sont "
    "el los las y que del se por con no una su para es al lo como más pero sus le ya o este sí".split()
)
SHORT, LONG = 70, 200  # characters
FEW_STOPS, MANY_STOPS = 0.15, 0.3
MANY_LINKS = 0.5  # share of characters
GOOD, BAD, NEAR, TOO_SHORT = "good", "bad", "near", "short"

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_END = re.compile(r"""(?:[^>=]|=(?!\s*["'])|=\s*"[^"]*"|=\s*'[^']*')*+>""")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_SPACE = re.compile(r"\s+")
_WORDS = re.compile(r"[^\W\d_]+")
_PIECES = re.compile(r"[a-z]+")


@dataclass
class Block:
    """A run of text between line-ending tags; `group` numbers the list or table around it."""

    zone: str
    heading: bool
    group: int
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def tags_of(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, rest): text, open and close, in page order, in linear time. Comments, declarations and the insides of skipped elements are left out; what is no tag is text."""
    place, end = 0, len(page)
    lowered = None
    while place < end:
        at = page.find("<", place)
        if at < 0:
            yield "text", "", page[place:]
            return
        if at > place:
            yield "text", "", page[place:at]
        if page.startswith("<!--", at):
            close = page.find("-->", at + 2)
            place = end if close < 0 else close + 3
            continue
        closing = page.startswith("</", at)
        name = _NAME.match(page, at + 1 + closing)
        if not name:
            if page[at + 1 : at + 2] in ("!", "?") or closing:
                close = page.find(">", at)
                place = end if close < 0 else close + 1
            else:
                yield "text", "", "<"
                place = at + 1
            continue
        stop = _END.match(page, name.end())
        if not stop:  # an open quote: up to the next end of a tag, or else the rest of the page
            close = page.find(">", name.end())
            if close < 0:
                return
            place = close + 1
        else:
            place = stop.end()
        tag, rest = name[0].lower(), page[name.end() : place - 1]
        if closing:
            yield "close", tag, ""
            continue
        yield "open", tag, rest
        if tag in SKIPPED and not rest.endswith("/"):
            lowered = page.lower() if lowered is None else lowered
            if len(lowered) != end:  # a letter that lower-cases into several
                lowered = re.sub("[A-Z]", lambda m: m[0].lower(), page)
            close = lowered.find(f"</{tag}", place)
            place = close if close >= 0 else end if tag in RAW else place


def _left_out(tag: str, rest: str, in_article: bool) -> bool:
    if tag in LEFT_OUT or (tag == "header" and not in_article):
        return True
    if "=" not in rest and "hidden" not in rest:
        return False
    found = {m[1].lower(): unescape(m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(rest)}
    if found.get("role") in ROLES or found.get("aria-hidden") == "true" or re.search(r"(^|\s)hidden(\s|$)", _ATTRIBUTE.sub(" ", rest).lower()):
        return True
    if tag in ("body", "html", "article", "main"):
        return False
    named = [word for name in ("class", "id") for word in found.get(name, "").split() if not word.startswith(STATES)]
    return any(piece in MARKS for word in named for piece in (word, *_PIECES.findall(word)))


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page that hold text, with where they stand: out, article or open."""
    open_tags: list[tuple[str, bool, bool, int, bool, bool]] = [("", False, False, 0, False, False)]  # name, left out, in an article, group, heading, in a form
    is_open: Counter[str] = Counter()
    links, groups = 0, 0
    blocks = [Block("open", False, 0)]
    for kind, tag, rest in tags_of(page):
        name, out, inside, group, heading, form = open_tags[-1]
        if kind == "text":
            block = blocks[-1]
            block.parts.append(rest)
            if links:
                block.linked += len(_SPACE.sub(" ", rest).strip())
            continue
        if kind == "open":
            if tag == "a":
                links = 1
            if tag in LINE:
                links = 0
                if name == "p" and tag != "br":  # a paragraph ends where another block begins
                    is_open[open_tags.pop()[0]] -= 1
                    name, out, inside, group, heading, form = open_tags[-1]
            if (tag in KEPT_OPEN or (tag not in VOID and tag not in SKIPPED and _left_out(tag, rest, inside))) and not (rest.endswith("/") and tag not in KEPT_OPEN):
                if tag in GROUPS:
                    groups += 1
                    group = groups
                inside = inside or tag in ARTICLE
                form = (form or tag == "form") and tag not in ARTICLE  # a form around the whole page leaves out no article
                out = out or (tag != "form" and _left_out(tag, rest, inside))
                open_tags.append((tag, out, inside, group, heading or tag in HEADINGS, form))
                is_open[tag] += 1
            elif tag not in LINE:
                continue
        else:
            if tag == "a":
                links = 0
            if is_open[tag]:
                while open_tags[-1][0] != tag:
                    is_open[open_tags.pop()[0]] -= 1
                is_open[open_tags.pop()[0]] -= 1
            elif tag not in LINE:
                continue
        _, out, inside, group, heading, form = open_tags[-1]
        blocks.append(Block("out" if out or form else "article" if inside else "open", heading, group))
    found = []
    for block in blocks:
        block.text = _SPACE.sub(" ", unescape("".join(block.parts))).strip()
        if block.text:
            found.append(block)
    return found


def first_pass(blocks: list[Block], stop_words: frozenset[str] = STOP_WORDS) -> list[str]:
    """Each block alone: good, bad, near or short."""
    has_article = any(b.zone == "article" for b in blocks)
    sizes: dict[int, list[int]] = {}
    for b in blocks:
        if b.group:
            total = sizes.setdefault(b.group, [0, 0, 0])
            total[0] += 1
            total[1] += len(b.text)
            total[2] += b.linked
    labels = []
    for b in blocks:
        density = b.linked / len(b.text)
        items, size, linked = sizes.get(b.group, (0, 1, 0))
        if b.zone == "out" or (items > 1 and linked > MANY_LINKS * size and density > MANY_LINKS):
            labels.append(BAD)
        elif b.zone == "article":
            labels.append(GOOD)
        elif b.heading:
            labels.append(TOO_SHORT)
        elif has_article or density > MANY_LINKS or "©" in b.text:
            labels.append(BAD)
        elif len(b.text) < SHORT:
            labels.append(BAD if b.linked else TOO_SHORT)
        else:
            words = _WORDS.findall(b.text.lower())
            stops = sum(w in stop_words for w in words) / max(1, len(words))
            labels.append(GOOD if stops >= MANY_STOPS and len(b.text) > LONG else NEAR if stops >= FEW_STOPS else BAD)
    return labels


def second_pass(blocks: list[Block], labels: list[str]) -> list[bool]:
    """Whether each block is kept: near and short ones inherit from their nearest decided neighbours."""
    before, after = [BAD] * len(labels), [BAD] * len(labels)
    last = BAD
    for i, label in enumerate(labels):
        before[i] = last
        last = label if label in (GOOD, BAD) else last
    last = BAD
    for i in range(len(labels) - 1, -1, -1):
        after[i] = last
        last = labels[i] if labels[i] in (GOOD, BAD) else last
    lone_near = GOOD not in labels  # no block is surely good: what is nearly good decides
    kept = []
    for label, left, right in zip(labels, before, after, strict=True):
        if label == NEAR:
            kept.append(lone_near or GOOD in (left, right))
        else:
            kept.append(label == GOOD or (label == TOO_SHORT and left == right == GOOD))
    for i in range(len(labels) - 1, -1, -1):
        if blocks[i].heading and labels[i] == TOO_SHORT:
            kept[i] = kept[i] or (i + 1 < len(labels) and kept[i + 1])
    return kept


def main_text(page: str | None) -> str:
    """The blocks that are kept, in page order, joined by one space."""
    blocks = blocks_of(page or "")
    kept = second_pass(blocks, first_pass(blocks))
    return " ".join(b.text for b, keep in zip(blocks, kept, strict=True) if keep)


def _extracted(batches: Iterator[pa.RecordBatch], place: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = pa.array([main_text(page.as_py()) for page in batch.column(place)], pa.string())
        yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(batch.columns) if i != place), texts], ["page_id", "url", "text"])


def extract(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) -> page_id, url, text, n_chars; one row per row. Null, empty and text-free pages give an empty text; repeated rows are judged alike; other columns are not read."""
    some = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    kind = f"page_id {some.schema['page_id'].dataType.simpleString()}, url string, text string"
    return some.mapInArrow(partial(_extracted, place=2), kind).withColumn("n_chars", F.char_length("text").cast("long"))
