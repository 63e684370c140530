"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. The first pass judges each block by itself: text in menus, headers,
footers, sidebars, notices, adverts, forms or reader comments is bad; of the rest, length, link density and the share
of stop words decide good, near-good, short or bad. The second pass settles the ambiguous: a short or near-good block
takes the label of the nearest decided blocks before and after it.

Both passes judge the blocks of every page. Where a page marks its article, that is one signal more: a block inside is
moved up a class (few stop words: near-good; near-good: good; mostly links: kept between good blocks), and the article's
edge counts as a good neighbour; outside, a good block stays and a short one that is no heading is bad.

What a container is called is a prior. A name that is such a word by itself (``sidebar``) holds; one that only has it as
a part (``with-sidebar``, ``share-prices``) is overruled where the container has most of the page's text, or long running
text inside the article. Where nothing is left of a page, it is judged once more without names other than those of
reader comments.

Stop words are those of English, German, French and Spanish. A page whose running text has few of them is in another
language (or has no sentences at all): there they say nothing, and length, links and neighbours decide.

Rows are independent: one map over the pages, no shuffle, whole texts.

Defined results: a null or empty page has the empty text; an unclosed comment, script or style reaches to the page's
end, an unclosed container to the end of what encloses it; rows with one page_id are separate pages; an empty table
gives an empty table; other columns, of any name, are not looked at.
"""

from __future__ import annotations

import html as markup
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

# Function words of English, German, French and Spanish.
STOP_WORDS = frozenset(
    """a about after all also an and any are as at be because been before being between both but by can could did do does
    each few for from had has have he her here him his how i if in into is it its just may me more most must my no nor
    not of off on only or other our out over own same she should so some such than that the their them then there these
    they this those through to too under until up us very was we were what when where which while who will with would
    you your
    aber alle allem allen aller alles als also am an ander andere anderen auch auf aus bei bin bis bist da damit dann das
    dass dein dem den denn der des dessen die dies diese diesem diesen dieser dieses doch dort du durch ein eine einem
    einen einer eines er es etwas euch für gegen hat hatte hatten haben hier ich ihm ihn ihnen ihr ihre ihrem ihren ihrer
    im in ist ja jede jedem jeden jeder jedes kann kein keine keinen keiner können man manche mehr mein mich mir mit muss
    nach nicht nichts noch nun nur ob oder ohne schon sehr sein seine seinem seinen seiner seit sich sie sind so solche
    soll sondern über um und uns unser unter viel vom von vor war waren was weil welche welcher wenn wer werden wie wieder
    will wir wird wo wurde wurden zu zum zur zwischen
    ai ainsi alors après as au aussi autre autres aux avant avec avoir c ce cela ces cet cette ceux chaque chez comme
    comment contre d dans de depuis des deux donc dont du elle elles en encore entre est et été être eu eux fait faire
    fut il ils j je jusque l la le les leur leurs lors lui m ma mais me même mes moins mon n ne ni nos notre nous on ont
    ou où par parce pas pendant peu peut plus pour pourquoi puis qu quand que quel quelle quelles quels qui quoi s sa sans
    se sera ses si sienne son sont sous sur ta tandis te tes toi ton tous tout toute toutes très tu un une vers voici vos
    votre vous y à était étaient
    a al algo alguna algunas alguno algunos ante antes aquel aquella así aún aunque bajo bien cada casi como con contra
    cual cuales cuando de del desde donde dos durante e el él ella ellas ellos en entre era eran es esa esas ese eso esos
    esta está están estas este esto estos fue fueron ha había han hasta hay la las le les lo los más me mi mientras mis
    mucho muy nada ni no nos nosotros o os otra otras otro otros para pero poco por porque pues que quien quienes qué se
    sea según ser si sí sin sino sobre son su sus también tan tanto te tiene tienen todo todos tu tus un una unas uno unos
    y ya yo""".split()
)
# Fitted to these lists: prose of the four languages is well above, lists of names, labels and prices are below.
STOP_LOW, STOP_HIGH = 0.10, 0.15
SHORT, LONG = 70, 200
LINKS = 0.2
LINK_LIST = 0.8

BLOCK = frozenset(
    """address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre search section summary
    table tbody td tfoot th thead title tr ul""".split()
)
#: What is inside is not text of the page.
SILENT = frozenset("script style noscript template title textarea select button svg math iframe object canvas audio video".split())
RAW = frozenset("script style title textarea iframe noscript".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BAD_TAGS = frozenset("nav footer aside form dialog menu search".split())
MAIN_TAGS = frozenset("article main".split())
CONTAINERS = frozenset("address article aside blockquote dd details dialog div dl dt fieldset figure footer form header li main menu nav ol search section table td th tr ul".split())
COMMENT_HINTS = frozenset("comment comments commentlist disqus respond replies reply reader".split())
BAD_HINTS = COMMENT_HINTS | frozenset(
    """ad ads adv advert adverts advertisement banner breadcrumb breadcrumbs consent cookie cookies footer gdpr login menu
    modal nav navbar navigation newsletter notice pager pagination popup promo promotion recommended related search share
    sharing sidebar signup skip social sponsor sponsored subscribe toolbar topbar widget""".split()
)
BAD_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
START = re.compile(r"<(?:!--|[!?]|/?[a-zA-Z])")
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
#: The end of a tag, or the start of a value: up to its quote, or all of it if it has none.
VALUE = re.compile(r""">|=\s*(?:(["'])|[^\s>]*)""")
HINT = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
WORD = re.compile(r"[^\W\d_]+")


class Block(NamedTuple):
    text: str
    link_chars: int
    bad: bool
    main: bool
    heading: bool


def _end_of_tag(page: str, at: int, lost: set[int]) -> int:
    """The place after the tag that starts at ``at``: > in quoted values does not end it, but a quote that is never
    closed does not run on. ``lost`` holds the values from which such a quote was met, so that none is read twice."""
    first = page.find(">", at)
    if first < 0:
        return len(page)
    name = NAME.match(page, at)
    end, seen = name.end() if name else at, []
    while (m := VALUE.search(page, end)) and m.start() not in lost:
        if m[0] == ">":
            return m.end()
        seen.append(m.start())
        end = page.find(m[1], m.end()) + 1 if m[1] else m.end()
        if not end:
            break
    lost.update(seen)
    return first + 1


#: What a container's tag, attributes and name say of it.
FINE, NAMED, BAD = 0, 1, 2


def _container(tag: str, attributes: str, in_main: bool, names: bool) -> int:
    """BAD, NAMED (a name that has a telling word as a part only) or FINE; without ``names`` only those of comments count."""
    if tag in BAD_TAGS or (tag == "header" and not in_main):
        return BAD
    if not attributes:
        return FINE
    values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)}
    said = [t for k in ("class", "id") for t in values.get(k, "").split()]
    hints = {h.lower() for t in said for h in HINT.findall(t)}
    if tag in MAIN_TAGS:
        return BAD if hints & COMMENT_HINTS else FINE
    hidden = "hidden" in values or values.get("aria-hidden") == "true" or "display:none" in values.get("style", "").replace(" ", "").lower()
    if hidden or values.get("role", "").lower() in BAD_ROLES or hints & COMMENT_HINTS:
        return BAD
    if not names:
        return FINE
    if any(t.lower() in BAD_HINTS for t in said) or ("header" in hints and not in_main):
        return BAD
    return NAMED if hints & BAD_HINTS else FINE


class Named(NamedTuple):
    """A container whose name tells against it: the one around it (-1: none), whether it lies in the article."""

    up: int
    main: bool


def blocks(page: str | None, overruled: frozenset[int] = frozenset(), names: bool = True) -> list[Block]:
    """The blocks of a page that hold text, in order."""
    return _parsed(page, overruled, names)[0]


def _parsed(page: str | None, overruled: frozenset[int], names: bool) -> tuple[list[Block], list[Named], list[int]]:
    """The blocks, the containers whose names tell against them, and for each block the innermost of these (-1: none; -2:
    it is bad for other reasons)."""
    page = page or ""
    out: list[Block] = []
    named: list[Named] = []
    within: list[int] = []
    text: list[str] = []
    #: open containers: tag, bad, whether by its tag alone, inside the page's article, the innermost named container
    stack: list[tuple[str, bool, bool, bool, int]] = [("", False, False, False, -1)]
    #: open tags by name since the innermost article began, one count for each open article, and of articles in all
    counts: list[dict[str, int]] = [{}]
    mains = dict.fromkeys(MAIN_TAGS, 0)
    silent = links = link_chars = 0
    lost: set[int] = set()
    heading = False

    def close() -> None:
        nonlocal link_chars
        joined = " ".join(markup.unescape("".join(text)).split())
        if joined:
            _, bad, _, main, inner = stack[-1]
            out.append(Block(joined, min(link_chars, len(joined)), bad or inner >= 0, main, heading))
            within.append(-2 if bad else inner)
        text.clear()
        link_chars = 0

    at, n = 0, len(page)
    while at < n:
        m = START.search(page, at)
        upto = m.start() if m else n
        if upto > at and not silent:
            text.append(page[at:upto])
            link_chars += len(page[at:upto].strip()) if links else 0
        if not m:
            break
        if m[0] == "<!--":
            end = page.find("-->", upto + 4)
            at = end + 3 if end >= 0 else n
            continue
        at = _end_of_tag(page, upto, lost)
        if m[0][1] in "!?":
            continue
        tag = NAME.match(page, upto)[1].lower()
        closing, own = page[upto + 1] == "/", page[upto:at].endswith("/>")
        if tag in BLOCK:
            close()
            heading = not closing and tag in ("h1", "h2", "h3", "h4", "h5", "h6")
        elif tag == "br":
            text.append(" ")
        if tag in RAW and not closing:
            if not own:
                end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
                at = end.end() if end else n
            continue
        if tag in SILENT and tag not in RAW:
            silent = max(0, silent + (-1 if closing else 0 if own else 1))
        if tag == "a":
            links = 0 if closing else 1
        if tag in CONTAINERS and tag not in VOID:
            if closing:
                # an end tag inside the article closes nothing outside it; one without a start tag is not looked for
                if mains[tag] if tag in MAIN_TAGS else counts[-1].get(tag, 0):
                    while True:
                        top = stack.pop()[0]
                        if top in MAIN_TAGS:
                            counts.pop()
                            mains[top] -= 1
                        else:
                            counts[-1][top] -= 1
                        if top == tag:
                            break
                links = links if stack[-1][0] else 0
            elif not own:
                _, bad, by_tag, main, inner = stack[-1]
                attributes = page[upto + 1 + len(tag) : at - 1]
                here = _container(tag, attributes, main, names)
                if here == NAMED:
                    named.append(Named(inner, main))
                    inner = inner if len(named) - 1 in overruled else len(named) - 1
                if tag in MAIN_TAGS and here != BAD and bad and by_tag:
                    bad = False  # what should have been closed before the article
                stack.append((tag, bad or here == BAD, (by_tag if bad else here == BAD and tag in BAD_TAGS | {"header"}), main or (tag in MAIN_TAGS and here != BAD and not bad and inner < 0), inner))
                if tag in MAIN_TAGS:
                    counts.append({})
                    mains[tag] += 1
                else:
                    counts[-1][tag] = counts[-1].get(tag, 0) + 1
    close()
    return out, named, within


def _overruled(found: list[Block], named: list[Named], within: list[int]) -> frozenset[int]:
    """The named containers that hold most of the page's text, or long running text inside the article."""
    chars, prose = [0] * len(named), [0] * len(named)
    total = 0
    for b, inner in zip(found, within, strict=True):
        if inner == -2:
            continue
        total += len(b.text)
        if inner >= 0:
            chars[inner] += len(b.text)
            runs = len(b.text) >= LONG and b.link_chars <= LINKS * len(b.text) and _stops(WORD.findall(b.text.lower())) >= STOP_HIGH
            prose[inner] += len(b.text) if runs else 0
    for i in range(len(named) - 1, -1, -1):
        if (up := named[i].up) >= 0:
            chars[up] += chars[i]
            prose[up] += prose[i]
    return frozenset(i for i, c in enumerate(named) if 2 * chars[i] > total or (c.main and prose[i]))


def _stops(words: list[str]) -> float:
    return sum(w in STOP_WORDS for w in words) / max(1, len(words))


def listed(found: list[Block]) -> bool:
    """Whether the running text of the page is in a language of the stop words."""
    prose = (b.text for b in found if not b.bad and len(b.text) >= SHORT and b.link_chars <= LINKS * len(b.text))
    return _stops([w for text in prose for w in WORD.findall(text.lower())]) >= STOP_HIGH


def first_pass(block: Block, marked: bool, told: bool = True) -> str:
    """good, near, short, link or bad, by the block alone; ``marked``: the page marks its article; ``told``: stop words
    tell text from other blocks on this page."""
    density = block.link_chars / len(block.text)
    if block.bad:
        return "bad"
    inside = marked and block.main
    if density > (LINK_LIST if inside else LINKS):
        return "link" if inside else "bad"
    if len(block.text) < SHORT:
        if inside:
            return "short"
        return "bad" if block.link_chars or (marked and not block.heading) else "short"
    if density > LINKS:
        return "near"
    stops = _stops(WORD.findall(block.text.lower())) if told else 1.0
    if stops >= STOP_HIGH:
        return "good" if inside or len(block.text) > LONG else "near"
    if stops >= STOP_LOW:
        return "good" if inside else "near"
    return "near" if inside else "bad"


def second_pass(found: list[Block], labels: list[str], marked: bool = False) -> list[bool]:
    """Whether each block is kept. Undecided blocks look to the nearest good or bad block on either side; the page's
    edge counts as bad, the edge of a marked article as good. Between one of each, a near-good block, any block of the
    article and a heading before good text stay; a short one stays if the good one is as near as the bad one. A block of
    links inside the article stays only between good blocks, or as a heading before one; the edge does not count there."""
    n = len(labels)
    sides: list[list[tuple[str, int, bool]]] = [[] for _ in labels]
    for order in (range(n), range(n - 1, -1, -1)):
        last, inside, edge = ("bad", -1 if order.step > 0 else n), False, False
        for i in order:
            if marked and found[i].main and not inside:
                last, edge = ("good", i - order.step), True
            inside = marked and found[i].main
            sides[i].append((last[0], abs(i - last[1]), edge))
            if labels[i] in ("good", "bad"):
                last, edge = (labels[i], i), False
    keep = []
    for i, label in enumerate(labels):
        if label in ("good", "bad"):
            keep.append(label == "good")
            continue
        before, after = sides[i]
        if label == "link":
            text_before, text_after = (side[0] == "good" and not side[2] for side in (before, after))
            keep.append(text_after and (text_before or found[i].heading))
        elif before[0] == after[0]:
            keep.append(before[0] == "good")
        elif label == "near" or (marked and found[i].main) or (found[i].heading and after[0] == "good"):
            keep.append(True)
        else:
            good, bad = (before, after) if before[0] == "good" else (after, before)
            keep.append(good[1] <= bad[1])
    if not any(keep):  # a page of short paragraphs only
        keep = [x in ("near", "short") for x in labels]
    return keep


def _judged(found: list[Block]) -> str:
    marked = any(b.main and not b.bad for b in found)
    told = listed(found)
    labels = [first_pass(b, marked, told) for b in found]
    return "\n\n".join(b.text for b, k in zip(found, second_pass(found, labels, marked), strict=True) if k)


def main_text(page: str | None) -> str:
    found, named, within = _parsed(page, frozenset(), True)
    if overruled := _overruled(found, named, within) if named else None:
        found = blocks(page, overruled)
    text = _judged(found)
    return text or (_judged(blocks(page, names=False)) if any(b.bad for b in found) else text)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h.as_py()) for h in b.column("html")]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    return pages.select("page_id", "url", "html").mapInArrow(each, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
