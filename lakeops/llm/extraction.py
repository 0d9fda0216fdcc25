"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. Pass one labels a block by the
element it stands in (menus, headers, footers, side bars, forms, hidden
elements, and elements whose class, id or role names an advert, a notice, a
side bar, reader comments or another such part are boilerplate, however long their text;
a name that may also mean something else, as share or related, is overruled by long text
dense with stop words in an element that holds most of the page's text), its link
density, its length and the share of stop words among its words: good, bad, or
ambiguous. Pass two gives an ambiguous block the label of its nearest decided
neighbours in its region: both alike, that label; different, the nearer one
(equally near: good). Boilerplate that its name gives away, or
inside an article, is no neighbour.

A region is the article (or ``main``) a block stands in, and a hint for both
passes. In it short texts are good from fewer stop words on, long texts without
stop words and linked headings are ambiguous, not bad (some languages and all code
have no stop words), and a region without decided blocks is good. Outside, on a
page that has a region with text, only long texts dense with stop words are good
by themselves, and what has no decided neighbours is bad.

Text is kept whole: character references are decoded, white space in a block
becomes one space, blocks are joined by one newline, nothing else is dropped or
capped. ``br`` is white space; inline tags are nothing.

Tags are found in one pass forward that never looks at a character twice, so time
follows the length of a page, also of one made to be slow. A quote opens a value
after an equals sign only; from the first quote on that is never closed, or hides the last
``>``, quotes count as other characters for the rest of the page. What follows the
last ``>`` of a page is text.

Defined cases: a NULL or empty page has the empty text; an unclosed comment or
script reaches to the end of the page, an unclosed element to the end of the one
around it, a link also where the next one starts, a head where something starts
that can't stand in it; ``<`` that opens no tag is text; a number of a character reference
beyond Unicode is U+FFFD; pages of any length are taken whole; a NULL id or url is carried along;
repeated rows are extracted each; other columns of the input are not read; an empty
table gives no rows."""

from __future__ import annotations

import html
import re
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_LINKS = 0.33        # share of a block's characters in links, from which it is bad
LONG, SHORT = 140, 40   # characters
STOP_HIGH, STOP_LOW = 0.20, 0.08
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# Frequent function words of the four languages.
STOP_WORDS = frozenset((
    "a an and are as at be but by for from had has have he her his i if in into is it its not of on or she so that "
    "the their them there they this to was we were which will with you "
    "aber als am an auch auf aus bei das dass dem den der des die durch ein eine einen einer er es für hat ich ihr im "
    "in ist kein mit nach nicht noch nur oder sch sein sich sie sind so über um und uns von vor war wie wir zu zum zur "
    "au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou par pas "
    "plus pour qu que qui sa se ses son sont sur un une vous "
    "al como con de del el ella en es esta este fue ha hay la las lo los más me mi muy no o para pero por que se si "
    "sin sobre su sus también un una uno y ya").split())
BLOCK_TAGS = frozenset((
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section select "
    "summary table tbody td tfoot th thead tr ul").split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("iframe noembed noframes noscript script style svg math template textarea title xmp".split())
BOILERPLATE_TAGS = frozenset("aside button dialog footer form head header label legend menu nav option select".split())
# Class, id and role names of a boilerplate part of a page: whole, or as the
# first or last part of a block's name. Names that also stand for other things come second.
BOILERPLATE_NAMES = frozenset((
    "ad ads adbox adsense advert advertisement advertisements adverts advertising aside banner breadcrumb breadcrumbs "
    "comment comments complementary consent contentinfo cookie cookies copyright disqus footer gdpr masthead menu "
    "menubar nav navbar navigation newsletter notice notices notification notifications outbrain pager pagination "
    "popup promo promoted promotion replies reply respond sidebar signup sponsor sponsored subscribe subscription "
    "taboola").split())
AMBIGUOUS_NAMES = frozenset((
    "discussion feedback form hidden login modal related search share sharing skip social toolbar widget").split())
HEADER_NAMES = frozenset(("header",))
# Parts before a last part that make the name one of something else (has-footer).
MODIFIERS = frozenset("has hide is no non not open show toggle with without".split())
# Last parts that make it a state or layout of what is around (comments-open).
STATES = frozenset("active closed disabled enabled layout off on open page visible".split())
REGION_TAGS = frozenset(("article", "main"))
HEAD_TAGS = frozenset("base link meta noscript script style template title".split())

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_VALUE = re.compile(r"[>=]")
_SPACE = re.compile(r"\s*")
_END = {t: re.compile(rf"</{t}(?=[ \t\n\f\r/>]|\Z)", re.I | re.A) for t in RAW_TAGS}
_LONG_NUMBER = re.compile(r"&#(?:0*([0-9]*)|[xX]0*([0-9a-fA-F]*));?")
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+)))?")
_NO_DISPLAY = re.compile(r"(?:^|[;\s])display\s*:\s*none", re.I)
_PARTS = re.compile(r"[a-z0-9]+|[A-Z][a-z0-9]*")
GOOD, BAD, OPEN = 1, 0, None
NAMED, SURE, TAGGED = 1, 2, 3       # boilerplate by an ambiguous name; by its name or hidden; by its tag


class Block:
    """``named``: the outermost element of an ambiguous name around it."""
    __slots__ = ("chars", "linked", "boiler", "named", "region", "heading")

    def __init__(self, boiler: int, named: int | None, region: int, heading: bool = False):
        self.chars, self.linked = [], 0
        self.boiler, self.named, self.region, self.heading = boiler, named, region, heading


def tokens(page: str):
    """(start, end, closing, name, attributes) of every tag, comment and
    declaration, in order; the name is None for the latter two. An element whose content
    is no text (a script) is one token with it. Every search goes forward from where
    the last one ended, and an answer of "no more" is kept."""
    gt, quotes, at, n = -1, True, 0, len(page)
    while True:
        i = page.find("<", at)
        if i < 0 or i + 1 >= n:
            return
        if page.startswith("<!--", i):
            at = page.find("-->", i + 4)
            at = n if at < 0 else at + 3
            yield i, at, False, None, ""
            continue
        if page.startswith("<![CDATA[", i):
            at = page.find("]]>", i + 9)
            at = n if at < 0 else at + 3
            yield i, at, False, None, ""
            continue
        if page[i + 1] in "!?":
            at = page.find(">", i)
            at = n if at < 0 else at + 1
            yield i, at, False, None, ""
            continue
        closing = page[i + 1] == "/"
        if gt < i:
            gt = page.find(">", i)
            if gt < 0:
                return
        name = _NAME.match(page, i + 1 + closing, gt)
        if not name:
            at = i + 1
            continue
        end = gt
        if quotes and not closing:
            end, where = -1, name.end()
            while True:
                stop = _VALUE.search(page, where)
                if not stop:
                    break
                if stop.group() == ">":
                    end = stop.start()
                    break
                first = _SPACE.match(page, stop.end()).end()
                where = stop.end()
                if page[first:first + 1] in ("'", '"') and first < n:
                    where = page.find(page[first], first + 1) + 1
                    if not where:
                        break
            if end < 0:
                quotes, end = False, gt
        at = end + 1
        tag = name.group().lower()
        if not closing and tag in RAW_TAGS:
            at = _raw_end(page, tag, at)
        yield i, at, closing, tag, page[name.end():end]


def _raw_end(page: str, tag: str, at: int) -> int:
    """The place after the end tag of a raw element, or the end of the page."""
    found = _END[tag].search(page, at)
    end = page.find(">", found.end()) if found else -1
    return len(page) if end < 0 else end + 1


def unescaped(text: str) -> str:
    """Character references decoded; numbers too long to be one first."""
    if "&" not in text:
        return text

    def number(m):
        digits = m.group(1) if m.group(1) is not None else m.group(2)
        return m.group() if len(m.group()) < 20 else (
            "\ufffd" if len(digits) > 7 else f"&#{'x' if m.group(1) is None else ''}{digits or 0};")
    return html.unescape(_LONG_NUMBER.sub(number, text) if "&#" in text else text)


def attributes_of(text: str) -> dict[str, str]:
    """Attribute values by lower-case name; the first of a name counts."""
    out = {}
    for name, *values in _ATTRIBUTE.findall(text):
        out.setdefault(name.lower(), "".join(values))
    return out


def is_boilerplate_name(name: str, names: frozenset[str], block: bool) -> bool:
    if name.lower() in names:
        return True
    parts = [p.lower() for p in _PARTS.findall(name)]
    if not block or len(parts) < 2 or parts[-1] in STATES:
        return False
    last = parts[-1] in names and parts[-1] != "hidden" and parts[-2] not in MODIFIERS
    return parts[0] in names or last


def names_boilerplate(tag: str, attributes: dict[str, str], in_article: bool) -> int:
    """0, ``NAMED`` or ``SURE``. The page, its article and its main part are never
    judged by a name, paragraphs and inline elements by whole names only."""
    if not attributes or tag in ("html", "body"):
        return 0
    if ("hidden" in attributes or attributes.get("aria-hidden", "").strip().lower() == "true"
            or _NO_DISPLAY.search(attributes.get("style", ""))):
        return SURE
    if tag in REGION_TAGS:
        return 0
    sure = BOILERPLATE_NAMES if in_article else BOILERPLATE_NAMES | HEADER_NAMES
    block = tag in BLOCK_TAGS and tag != "p"
    own = [n for a in ("class", "id", "role") for n in attributes.get(a, "").split()]
    return max((SURE if is_boilerplate_name(n, sure, block) else NAMED * is_boilerplate_name(n, AMBIGUOUS_NAMES, block)
                for n in own), default=0)


def blocks_of(page: str) -> list[Block]:
    """The page's blocks with text, in order. The stack holds the open
    elements that matter: (tag, boilerplate so far, outermost ambiguously named element,
    region so far), ``open_`` how many of each tag. ``link`` is the open link: the depth
    of the stack and the p or li around it."""
    stack, open_, out, regions, elements, link, around, at = [], {}, [], 0, 0, None, None, 0
    block = Block(0, None, 0)

    def add(text):
        if text and (block.boiler or not (stack and stack[-1][1])):     # inline boilerplate is left out
            text = unescaped(text)
            block.chars.append(text)
            if link:
                block.linked += len(text.strip())

    def cut():
        nonlocal block
        if block.chars and any(c and not c.isspace() for c in block.chars):
            out.append(block)
        boiler, named, region = stack[-1][1:] if stack else (0, None, 0)
        block = Block(boiler, named, region, bool(stack) and stack[-1][0] in HEADINGS)

    def pop():
        tag = stack.pop()[0]
        open_[tag] -= 1
        return tag

    def close(tag):
        if open_.get(tag):
            while pop() != tag:
                pass

    for start, end, closing, tag, attributes in tokens(page):
        if stack and stack[-1][0] == "head" and at < start and not page[at:start].isspace():
            close("head")
            cut()
        add(page[at:start])
        at = end
        if tag:
            block_tag = tag in BLOCK_TAGS
            if not closing and tag not in HEAD_TAGS and stack and stack[-1][0] == "head":
                close("head")
                cut()
            if closing:
                close(tag)
                if link and (tag == "a" or len(stack) < link[0] or link[1] and tag in (link[1], "li")):
                    link = None
                if block_tag:
                    around = None
            elif tag == "br":
                block.chars.append(" ")
            elif tag not in VOID_TAGS and tag not in RAW_TAGS:
                if block_tag and stack and stack[-1][0] in ("p", "li", "option", "a"):
                    pop()
                boiler, outer, region = stack[-1][1:] if stack else (0, None, 0)
                inside = region > 0
                if link and (tag == "a" or len(stack) < link[0]
                             or block_tag and link[1] == "p" or tag == "li" == link[1]):
                    link = None
                if block_tag:
                    around = tag if tag in ("p", "li") else None
                named = attributes_of(attributes) if attributes else {}
                mine = (TAGGED if tag in BOILERPLATE_TAGS and not (tag == "header" and inside)
                        else names_boilerplate(tag, named, inside))
                if tag in REGION_TAGS and not boiler and not mine and not inside:
                    regions += 1
                    region = regions
                if tag == "a" and "href" in named:
                    link = (len(stack), around)
                if mine or block_tag and tag not in ("p", "li"):
                    elements += 1
                    stack.append((tag, max(boiler, mine), elements if mine == NAMED and outer is None else outer, region))
                    open_[tag] = open_.get(tag, 0) + 1
            if block_tag:
                cut()
    if stack and stack[-1][0] == "head":
        close("head")
        cut()
    add(page[at:])
    cut()
    return out


def label(block: Block, text: str, outside: bool = False, most: bool = False) -> int | None:
    """Pass one. ``outside``: the page has a region, the block stands in none.
    ``most``: the ambiguously named element around it holds most of the text."""
    if block.boiler >= SURE or block.boiler and not most:
        return BAD
    words = text.lower().split()
    stops = sum(w.strip(".,;:!?()[]«»\"'#*$%&|-") in STOP_WORDS for w in words) / max(1, len(words))
    if block.linked > MAX_LINKS * len(text):
        return OPEN if block.region and block.heading and not block.boiler else BAD
    if block.boiler:
        return GOOD if len(text) >= LONG and stops >= STOP_HIGH else BAD
    if outside:
        return GOOD if len(text) >= LONG and stops >= STOP_HIGH else BAD if len(text) >= LONG else OPEN
    if len(text) >= SHORT and stops >= (STOP_LOW if block.region else STOP_HIGH) or len(text) >= LONG and stops >= STOP_LOW:
        return GOOD
    if not block.region and len(text) >= LONG and stops < STOP_LOW:
        return BAD
    return OPEN


def resolve(labels: list[int | None], regions: list[int], linked: list[bool]) -> list[int]:
    """Pass two."""
    def nearest(order):
        last, at = {}, [None] * len(labels)
        for i in order:
            at[i] = last.get(regions[i])
            if labels[i] is not OPEN:
                last[regions[i]] = i
        return at

    out = list(labels)
    for i, (before, after) in enumerate(zip(nearest(range(len(labels))), nearest(range(len(labels) - 1, -1, -1)))):
        if labels[i] is not OPEN:
            continue
        if before is None and after is None:
            out[i] = BAD if linked[i] and not regions[i] else GOOD
        elif before is None or after is None:
            out[i] = labels[after if before is None else before]
        elif labels[before] == labels[after] or i - before < after - i:
            out[i] = labels[before]
        else:
            out[i] = labels[after] if after - i < i - before else GOOD
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    found = [(b, " ".join("".join(b.chars).split())) for b in blocks_of(page)]
    found = [(b, t) for b, t in found if t]
    hinted = any(b.region and not b.boiler for b, _ in found)
    held = Counter()        # text by ambiguously named element, and all of it
    for b, t in found:
        if b.boiler < SURE:
            held[b.named] += len(t)
    every = held.total()
    # boilerplate that something names, or inside an article, says nothing about the text around it
    labels = resolve([label(b, t, hinted and not b.region, 2 * held[b.named] > every) for b, t in found],
                     [-1 if b.boiler and (b.region or b.boiler < TAGGED) else b.region for b, _ in found],
                     [hinted or b.linked > MAX_LINKS * len(t) for b, t in found])
    return "\n".join(t for (_, t), good in zip(found, labels) if good)


def extracted(pages: DataFrame, text: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns, ``text`` and ``n_chars`` of every page."""
    schema = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)
    rows = pages.select(*[F.col(c) for c in keep], F.col(text).alias("_page"))

    def run(batches):
        for pdf in batches:
            texts = [main_text(p) for p in pdf.pop("_page")]
            for c in keep:      # whole numbers with NULLs stay whole
                if pdf[c].dtype.kind == "f":
                    pdf[c] = pdf[c].astype("Int64")
            yield pdf.assign(text=texts, n_chars=[len(t) for t in texts])

    return rows.mapInPandas(run, f"{schema}, text string, n_chars long")
