"""HTML main text by two passes of block rules: decide what is clear, then look at neighbours.

Length, link density and stop-word density of a block's own text decide; where it stands in the
markup only shifts the thresholds."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_slices

# Frequent function words of the languages of the pages.
STOP_WORDS = {
    "en": "a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their they this to was were which who will with you",
    "fr": "au aux avec ce ces dans de des du elle en est et il ils je la le les leur lui ne nous on ou par pas plus pour que qui sa se ses son sur un une vous",
    "de": "als am an auch auf aus bei das dem den der des die ein eine einem einen einer er es für im in ist mit nach nicht noch oder sich sie sind um und von war wie zu zum",
    "es": "al como con de del el ella en era es ese esta este fue ha la las le lo los más no o para pero por que se sin sobre su sus un una y ya",
}
_STOP = frozenset(w for words in STOP_WORDS.values() for w in words.split())

# Elements by their part in a page.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
SKIPPED_TAGS = frozenset("applet audio button canvas datalist embed head iframe math noscript object script select style svg template textarea title video".split())
RAW_TAGS = frozenset("script style textarea title noscript iframe".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE_TAGS = frozenset("nav header footer aside form menu dialog search".split())
MAIN_TAGS = frozenset("article main".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: Names of parts that are never the article, and names that wrappers of whole pages carry as well.
_NEVER_NAME = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adsense|sponsor\w*|promo\w*|comments?|comment-?list|disqus|replies|respond|cookies?|consent|gdpr|"
    r"popup|modal|newsletter|subscribe|signup|login|breadcrumbs?|pagination|pager)(?:$|[\s_-])", re.I)
_LAYOUT_NAME = re.compile(
    r"(?:^|[\s_-])(?:banner|sidebar|side-?bar|notice|notification|alert|overlay|menu|nav|navbar|navigation|footer|masthead|social|share|sharing|related|"
    r"recommended|widget|toolbar|copyright|legal|disclaimer)(?:$|[\s_-])", re.I)
_HEADER_NAME = re.compile(r"(?:^|[\s_-])header(?:$|[\s_-])", re.I)
#: Names that say how a wrapper is laid out, not what it holds.
_STATE_NAME = re.compile(r"(?:^|(?<=\s))(?:no|has|with|without|hide|show)[_-][\w-]*", re.I)
_MAIN_NAME = re.compile(r"(?:^|[\s_-])(?:article|article-?body|post-?body|post-?content|entry-?content|main-?content|story-?body)(?:$|[\s_-])", re.I)

_TAG_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_TAG_STOP = re.compile(r"""[>"']""")
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|itemprop)(?=[\s=/]|\Z)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_SPACE = re.compile(r"\s+")

#: Thresholds (short below, long from, few stop words below, many from, links at most), on an unmarked page and in a main part.
PAGE_LIMITS = (70, 200, 0.15, 0.25, 0.33)
MAIN_LIMITS = (30, 70, 0.05, 0.12, 0.5)
#: Stop-word density under which a page's language isn't one of the lists', so length and links decide.
COVERED = 0.02


class Block:
    """Text of one block element: normalised text, characters inside links, and where it stands.

    ``main`` numbers the article or main element around it (0: none); ``mark`` is the innermost
    element around it, inside that main part, whose tag, role or name speaks of boilerplate."""

    __slots__ = ("heading", "label", "linked", "main", "mark", "stops", "text", "words")

    def __init__(self, text: str, linked: int, main: int, mark, heading: bool):
        self.text, self.linked, self.main, self.mark, self.heading, self.label = text, linked, main, mark, heading, ""
        self.words = self.stops = 0


class Mark:
    """An open element that speaks of boilerplate; a ``weak`` one may turn out to wrap the page's prose."""

    __slots__ = ("above", "open", "prose", "weak")

    def __init__(self, above, weak: bool):
        self.above, self.weak, self.prose, self.open = above, weak, 0, False


class _Tags:
    """Finds the tags of a page from left to right, in time linear in its length."""

    def __init__(self, html: str):
        self.html, self.last = html, {c: html.rfind(c) for c in ">\"'"}

    def end(self, at: int) -> int:
        """Position of the ``>`` that ends the tag at ``at`` (-1: none).

        Quotes without a partner are text.  A tag that quotes keep open to the page's end closes at its
        first ``>``, and from there on quotes are ignored."""
        if at > self.last[">"]:
            return -1
        place = at
        while True:
            stop = _TAG_STOP.search(self.html, place)
            if stop is None:
                break
            place = stop.end()
            if stop[0] == ">":
                return stop.start()
            if place <= self.last[stop[0]]:
                place = self.html.index(stop[0], place) + 1
        self.last.update({"'": -1, '"': -1})
        return self.html.find(">", at)


def _kind(tag: str, attributes: dict[str, str], in_main: bool) -> str | None:
    """"main", "never", "weak" or None: what an element's tag, role and names say about its content."""
    named = f"{attributes.get('class', '')} {attributes.get('id', '')}".strip()
    role = attributes.get("role", "").lower()
    if tag in ("html", "body"):
        return None
    if tag in MAIN_TAGS or role == "main" or attributes.get("itemprop") == "articleBody":
        return "main"
    if role in BOILERPLATE_ROLES or tag in BOILERPLATE_TAGS and not (tag == "header" and in_main):
        return "never"
    if named:
        named = _STATE_NAME.sub("", named)
        if _NEVER_NAME.search(named):
            return "never"
        if _LAYOUT_NAME.search(named) or not in_main and _HEADER_NAME.search(named):
            return "weak"
        if _MAIN_NAME.search(named):
            return "main"
    return None


def page_blocks(html: str) -> tuple[list[Block], list[Mark]]:
    """The non-empty blocks of a page in order, and its boilerplate marks (outer before inner)."""
    blocks: list[Block] = []
    marks: list[Mark] = []
    stack: list[tuple[str, int, Mark | None, bool]] = []  # open element; main part, mark and hiding inside it
    open_at: dict[str, list[int]] = {}  # places in the stack, by tag
    block_at: list[int] = []  # places of block elements
    main, mark, hidden, mains = 0, None, False, 0
    parts: list[tuple[str, bool]] = []
    heading, breaks = False, 0

    def flush() -> None:
        nonlocal parts, heading, breaks
        if parts:
            text = _SPACE.sub(" ", "".join(t for t, _ in parts)).strip()
            if text:
                linked = len(_SPACE.sub(" ", "".join(t for t, link in parts if link)).strip())
                blocks.append(Block(text, linked, main, mark, heading))
        parts, heading, breaks = [], False, 0

    def put(raw: str) -> None:
        nonlocal breaks
        if raw and not hidden:
            if not raw.isspace():
                breaks = 0
            parts.append((unescape(raw) if "&" in raw else raw, bool(open_at.get("a"))))

    def close(place: int) -> None:
        """Close the open element at ``place`` and those inside it."""
        nonlocal main, mark, hidden
        while len(stack) > place:
            tag = stack.pop()[0]
            open_at[tag].pop()
            if block_at and block_at[-1] == len(stack):
                block_at.pop()
        _, main, mark, hidden = stack[-1] if stack else ("", 0, None, False)

    def nearest(*tags: str) -> int:
        return max((open_at[t][-1] for t in tags if open_at.get(t)), default=-1)

    tags, at, size = _Tags(html), 0, len(html)
    text_from = 0
    while at < size:
        start = html.find("<", at)
        if start < 0 or start > tags.last[">"] and not html.startswith(("<!", "<?"), start):
            break  # no tag ends any more
        if html.startswith("<!--", start):
            end = html.find("-->", start + 4)
            put(html[text_from:start])
            at = text_from = end + 3 if end >= 0 else size
            continue
        if html.startswith(("<!", "<?"), start):
            end = html.find(">", start)
            put(html[text_from:start])
            at = text_from = end + 1 if end >= 0 else size
            continue
        name = _TAG_NAME.match(html, start)
        end = tags.end(name.end()) if name else -1
        if end < 0:  # no tag: text
            at = start + 1
            continue
        put(html[text_from:start])
        at = text_from = end + 1
        tag, inside = name[1].lower(), html[name.end() : end]
        if html[start + 1] == "/":  # closes the nearest open element of that name; inline end tags don't close sections
            place = nearest(tag)
            if place >= 0 and (tag in BLOCK_TAGS or nearest("article", "main", "body") < place):
                if block_at and block_at[-1] >= place:
                    flush()
                close(place)
            elif tag == "p":
                flush()
            continue
        if tag == "br":
            breaks += 1
            if breaks > 1:
                flush()
            elif not hidden:
                parts.append((" ", False))
            continue
        if tag in BLOCK_TAGS:
            flush()
            # a new block ends an open paragraph, and with it the inline elements left open there
            if block_at and stack[block_at[-1]][0] == "p":
                close(block_at[-1])
            if tag == "li" and nearest("li") > nearest("ul", "ol", "menu"):
                close(nearest("li"))
        attributes = {k.lower(): (v or "").strip("\"'") for k, v in _ATTRIBUTE.findall(inside)} if inside else {}
        if inside.rstrip().endswith("/") and tag not in BLOCK_TAGS or tag in VOID_TAGS:
            continue
        if tag in RAW_TAGS:  # their content isn't markup
            found = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(html, at)
            at = text_from = found.end() if found else size
            continue
        kind = _kind(tag, attributes, main > 0 and mark is None)
        if kind == "main" and (main == 0 or mark is not None and mark.weak):  # also reopens a wrapper
            mains += 1
            main, mark = mains, None
        elif kind in ("never", "weak"):
            mark = Mark(mark, kind == "weak" and (mark is None or mark.weak))
            marks.append(mark)
        hidden = hidden or tag in SKIPPED_TAGS or "hidden" in attributes or attributes.get("aria-hidden") == "true"
        if tag in BLOCK_TAGS:
            block_at.append(len(stack))
        open_at.setdefault(tag, []).append(len(stack))
        stack.append((tag, main, mark, hidden))
        if re.fullmatch("h[1-6]", tag):
            heading = True
    put(html[text_from:])
    flush()
    return blocks, marks


def reopen(blocks: list[Block], marks: list[Mark]) -> None:
    """Opens the weak marks that hold at least half of the page's prose (long, many stop words, few links).

    None opens where a main part has prose outside of all marks."""
    _, long_, _, many, links = PAGE_LIMITS
    whole, found = 0, False
    for b in blocks:
        if len(b.text) >= long_ and b.stops >= many * b.words and b.linked <= links * len(b.text):
            whole += len(b.text)
            found = found or b.main > 0 and b.mark is None
            if b.mark:
                b.mark.prose += len(b.text)
    for mark in reversed(marks):
        if mark.above:
            mark.above.prose += mark.prose
    for mark in marks:
        mark.open = not found and mark.weak and 0 < whole <= 2 * mark.prose and (mark.above is None or mark.above.open)


def label_blocks(blocks: list[Block], marks: list[Mark], stop_words: frozenset = _STOP) -> None:
    """Pass 1 decides by link density, length and stop-word density; pass 2 gives each
    ambiguous block the label of its nearest decided neighbour.

    The limits are ``MAIN_LIMITS`` inside an article or main element, else ``PAGE_LIMITS``; blocks with too many
    links are bad, long blocks with many stop words good.  Short blocks and headings are ambiguous,
    and so are blocks between the limits; long blocks with few stop words are bad, in a main part
    ambiguous.  On a page that has next to none of the stop words, long blocks are good without
    them.  Inside boilerplate marks blocks are bad, unless the mark wraps half of the page's prose.
    On a page with a main part, blocks outside it are good only if they are long prose or between two such.

    Neighbours are first sought in the block's own part, then on the whole page.  Of two equally near the
    following one decides for a heading, otherwise good wins.  Without any decided neighbour, blocks are
    good.  If nothing on the page is good, neither does a main part with some stop words, or with short
    blocks only, look outside: it's the best there is."""
    for b in blocks:
        words = b.text.lower().split()
        b.words, b.stops = len(words), sum(w.strip(".,;:!?\"'()") in stop_words for w in words)
    reopen(blocks, marks)
    free = [b for b in blocks if b.mark is None or b.mark.open]
    covered = not stop_words or sum(b.stops for b in free) >= COVERED * sum(b.words for b in free)
    marked = any(b.main for b in free)
    for b in blocks:
        length, links, stops = len(b.text), b.linked / len(b.text), b.stops / b.words
        short, long_, few, many, most_links = MAIN_LIMITS if b.main else PAGE_LIMITS
        prose = length >= long_ and (stops >= many or not covered)
        if b.mark and not b.mark.open:
            b.label = "bad"
        elif links > most_links or not b.main and b.text.startswith("©"):
            b.label = "bad"
        elif marked and not b.main:
            b.label = "good" if prose and not b.heading else "bad"
        elif length < short or b.heading:
            b.label = "short"
        elif prose:
            b.label = "good"
        else:
            b.label = "near" if b.main or stops >= few or not covered else "bad"
    if marked:
        outside = [b for b in free if not b.main]
        found = [i for i, b in enumerate(outside) if b.label == "good"]
        for b in outside[found[0] : found[-1]] if found else []:
            b.label = "good" if b.linked <= PAGE_LIMITS[4] * len(b.text) else b.label
    parts: dict[int, list[Block]] = {}
    for b in free:
        parts.setdefault(b.main, []).append(b)
    anything = any(b.label == "good" for b in free)
    whole = {id(b): label for b, label in _inherited(blocks)}
    decided = []
    for part in parts.values():
        longer = any(len(b.text) >= PAGE_LIMITS[0] for b in part)
        worded = sum(b.stops for b in part) >= COVERED * sum(b.words for b in part)
        for b, label in _inherited(part):
            if label is None and b.main and not anything and (worded or not longer):
                label = "good"
            decided.append((b, label or whole[id(b)] or "good"))
    for b, label in decided:
        b.label = label


def _inherited(blocks: list[Block]) -> list[tuple[Block, str | None]]:
    """Each ambiguous block with the label of its nearest decided neighbour (None: there's none)."""
    left, last = [], None  # nearest decided block before: (distance, label)
    for i, b in enumerate(blocks):
        left.append(last and (i - last[0], last[1]))
        if b.label in ("good", "bad"):
            last = (i, b.label)
    out, last = [], None
    for i in range(len(blocks) - 1, -1, -1):
        b = blocks[i]
        if b.label in ("good", "bad"):
            last = (i, b.label)
            continue
        before, after = left[i], last and (last[0] - i, last[1])
        if before and after and before[0] == after[0]:
            label = after[1] if b.heading else "good" if "good" in (before[1], after[1]) else "bad"
        else:
            label = min((x for x in (before, after) if x), default=(0, None))[1]
        out.append((b, label))
    return out


def main_text(html: str | None, stop_words: frozenset = _STOP) -> str:
    """The main text of a page: its good blocks joined by an empty line; "" for NULL or empty pages."""
    if not html:
        return ""
    blocks, marks = page_blocks(html)
    label_blocks(blocks, marks, stop_words)
    return "\n\n".join(b.text for b in blocks if b.label == "good")


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``; other columns are ignored.

    NULL, empty and block-less pages have the text ""; broken markup (unclosed or stray tags,
    comments, unknown references) never fails; repeated rows give their rows; pages are read whole,
    one at a time, and nothing is shuffled.
    """
    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    schema = T.StructType([source.schema["page_id"], source.schema["url"], T.StructField("text", T.StringType(), False), T.StructField("n_chars", T.LongType(), False)])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for part in text_slices(batch, "html"):
                texts = [main_text(h) for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

    return source.mapInArrow(run, schema)
