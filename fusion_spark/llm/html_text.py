"""Main text of web pages: boosted trees over DOM nodes and a hierarchical decoding."""

from __future__ import annotations

import html
import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fusion_spark.llm.boosting import Trees, boost
from fusion_spark.llm.words import slices

TRAINING_PAGES = 300  # bound of the pages that the trees are fitted on
VARIANTS = 4  # training layouts made of each
EXAMPLES = 40  # made-up pages that the trees are always fitted on, too

# HTML element names by their role, and words of attributes that name a role.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("""
    a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q ruby rb
    rp rt s samp small span strike strong sub sup time tt u var wbr
    math menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot
    mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics
""".split())
HIDDEN = frozenset("script style noscript template textarea select iframe object svg title "
                   "annotation annotation-xml".split())
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "body": ("head",),
}
SCOPES = frozenset("ul ol dl table article section div body html main aside nav form".split())
TAGS = ("article main section div p h1 h2 h3 h4 ul ol li table td blockquote pre figure nav "
        "header footer aside form button head body html figcaption details dialog").split()
CONTENT_WORDS = frozenset("article body content entry main post story text prose".split())
BOILER_WORDS = frozenset("""
    ad ads advert advertisement banner bar bottom breadcrumb breadcrumbs comment comments consent
    cookie cookies disqus footer form gdpr head header login masthead menu meta modal nav
    navigation newsletter notice overlay pagination popup promo recommended related replies
    respond reviews search share sharing side sidebar signup social sponsor sponsored subscribe
    tags toolbar top widget
""".split())
BOILER_TAGS = frozenset("nav header footer aside form button head dialog".split())

_NAME_END = re.compile(r"[\s/>]")
_INSIDE = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+")
_SIGN = re.compile("[\"'>]")
_ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
ROOT = "#root"


class _Source:
    """Look-ups in a page's source that cost no second scan of it, however malformed it is."""

    def __init__(self, source: str):
        self.source = source
        self.last = source.rfind(">")
        self.name_end = -1
        self.end_tags: dict[str, tuple[list[int], list[int]]] = {}
        self.signs: list[int] | None = None  # places of quotes and ">"
        self.closes: list[int] = []  # where a tag ends that reaches that place unquoted

    def name(self, at: int) -> int:
        """Where a tag's name that holds place ``at`` ends."""
        if self.name_end < at:
            found = _NAME_END.search(self.source, at)
            self.name_end = found.start() if found else len(self.source)
        return self.name_end

    def end_tag(self, name: str, at: int) -> int:
        """The end of the first end tag of this name behind ``at``, or -1."""
        if name not in self.end_tags:
            found = [m.span() for m in re.finditer(
                rf"</{re.escape(name)}\s*>", self.source, re.I)]
            self.end_tags[name] = [a for a, _ in found], [b for _, b in found]
        starts, ends = self.end_tags[name]
        place = bisect_left(starts, at)
        return ends[place] if place < len(ends) else -1

    def close(self, at: int) -> int:
        """The place of the first ``>`` behind ``at`` that is not in quotes, or -1.

        After the first tag without one the answers for all places are worked out from the
        page's end, as each further search could again run through the whole page.
        """
        if self.signs is None:
            end = _INSIDE.match(self.source, at).end()
            if end < len(self.source) and self.source[end] == ">":
                return end
            self.signs = [m.start() for m in _SIGN.finditer(self.source, at)]
            self.closes = [-1] * (len(self.signs) + 1)
            following = {}
            for i in range(len(self.signs) - 1, -1, -1):
                sign = self.source[self.signs[i]]
                if sign == ">":
                    self.closes[i] = self.signs[i]
                else:
                    if sign in following:
                        self.closes[i] = self.closes[following[sign] + 1]
                    following[sign] = i
        return self.closes[bisect_left(self.signs, at)]


def tokens(source: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, tag, closing, attributes) of the tags in page order.

    The tag is empty for what has no meaning here: comments, declarations and hidden elements
    with all that is in them. A ``<`` that begins nothing whole is text.
    """
    look, at = _Source(source), 0
    while (start := source.find("<", at)) >= 0:
        at = start + 1
        following = source[at:at + 1]
        if source.startswith("!--", at):
            end = source.find("-->", start + 4)
            at = len(source) if end < 0 else end + 3
            yield start, at, "", False, ""
            continue
        if start > look.last:
            continue
        if following and following in "!?":
            at = source.index(">", at) + 1
            yield start, at, "", False, ""
            continue
        closing = following == "/"
        first = at + closing
        if not (source[first:first + 1].isascii() and source[first:first + 1].isalpha()):
            continue
        name_end = look.name(first)
        # longer names are looked at only when their tag is whole
        tag = source[first:name_end].lower() if name_end - first < 20 else ""
        if tag in HIDDEN and not closing:
            end = look.close(name_end) if tag == "svg" else -1
            if end < 0 or source[end - 1] != "/":
                end = source.index(">", name_end)
                behind = look.end_tag(tag, end + 1)
                if behind < 0 and tag in ("script", "style"):
                    behind = len(source)
                end = max(end, behind - 1)
            at = end + 1
            yield start, at, "", False, ""
            continue
        end = look.close(name_end)
        if end >= 0:
            at = end + 1
            yield start, at, source[first:name_end].lower(), closing, source[name_end:end]


@dataclass
class Page:
    """Elements in page order and the text pieces between their tags."""

    tags: list[str] = field(default_factory=lambda: [ROOT])
    parents: list[int] = field(default_factory=lambda: [-1])
    words: list[tuple[str, ...]] = field(default_factory=lambda: [()])
    links: list[int] = field(default_factory=lambda: [0])  # characters in links
    inline: list[int] = field(default_factory=lambda: [0])  # inline tags right inside
    pieces: list[tuple[int, int, str]] = field(default_factory=list)  # node, block, text


def parse(source: str) -> Page:
    """A tolerant reading of HTML: implied end tags are added, stray ones ignored.

    Inline elements are no nodes; their text belongs to the block around them. Scripts,
    styles, form fields and comments have no text. A script or style without an end tag
    reaches to the end of the page, other such elements end at their own tag.
    """
    page, stack, block, in_link, at = Page(), [0], 0, 0, 0
    scopes: list[int] = []  # places in the stack of open scopes, and of each open tag
    places: dict[str, list[int]] = {}

    def text(piece: str) -> None:
        if piece:
            piece = html.unescape(piece)
            page.pieces.append((stack[-1], block, piece))
            if in_link:
                page.links[stack[-1]] += len(piece.strip())

    def close(place: int) -> None:
        while len(stack) > place:
            places[page.tags[stack.pop()]].pop()
            if scopes and scopes[-1] == len(stack):
                scopes.pop()

    for start, end, tag, closing, attributes in tokens(source):
        text(source[at:start])
        at = end
        if not tag:
            continue
        if tag in INLINE:
            if tag == "a":
                in_link = 0 if closing else 1
            elif tag == "br":
                text(" ")
            page.inline[stack[-1]] += 1
            continue
        block, in_link = block + 1, 0
        scope = scopes[-1] if scopes else 0
        if closing:
            own = places.get(tag)
            if own and (tag not in ("p", "li") or own[-1] > scope):
                close(own[-1])
            continue
        if tag in VOID:
            continue
        for name in ("p", *CLOSES.get(tag, ())):
            own = places.get(name, ())
            if own and own[-1] > scope:
                close(own[bisect_right(own, scope)])
        named = " ".join("".join(found) for found in _ATTRIBUTE.findall(attributes))
        page.tags.append(tag)
        page.parents.append(stack[-1])
        page.words.append(tuple(_WORD.findall(named.lower())))
        page.links.append(0)
        page.inline.append(0)
        if tag in SCOPES:
            scopes.append(len(stack))
        places.setdefault(tag, []).append(len(stack))
        stack.append(len(page.tags) - 1)
    text(source[at:])
    return page


_TAG_PLACE = {tag: place for place, tag in enumerate(TAGS)}


def node_features(page: Page) -> np.ndarray:
    """Per node: its tag, attribute words, depth, siblings, and the text below it."""
    count = len(page.tags)
    parent = page.parents
    chars, marks, pieces = [0] * count, [0] * count, [0] * count
    for node, _, piece in page.pieces:
        chars[node] += len(piece.strip())
        marks[node] += piece.count(",") + piece.count(".")
        pieces[node] += 1
    links, nodes, inline = list(page.links), [1] * count, list(page.inline)
    paragraphs = [int(tag == "p") for tag in page.tags]
    headings = [int(tag in ("h1", "h2")) for tag in page.tags]
    own_chars = list(chars)
    for node in range(count - 1, 0, -1):  # children come after their parents
        up = parent[node]
        for values in (chars, marks, pieces, links, nodes, inline, paragraphs, headings):
            values[up] += values[node]
    depth, place, family = [0] * count, [0] * count, [0] * count
    good, bad = [0] * count, [0] * count
    above_good, above_bad = [0] * count, [0] * count
    for node in range(count):
        words = page.words[node]
        good[node] = sum(word in CONTENT_WORDS for word in words)
        bad[node] = sum(word in BOILER_WORDS for word in words) + (
            page.tags[node] in BOILER_TAGS)
        if node:
            up = parent[node]
            depth[node] = depth[up] + 1
            place[node] = family[up]
            family[up] += 1
            above_good[node] = above_good[up] + good[up] + (page.tags[up] in ("article", "main"))
            above_bad[node] = above_bad[up] + bad[up]
    rows = np.zeros((count, len(TAGS) + 20))
    for node, tag in enumerate(page.tags):
        if tag in _TAG_PLACE:
            rows[node, _TAG_PLACE[tag]] = 1
    chars_, nodes_ = np.array(chars, float), np.array(nodes, float)
    up = np.maximum(np.array(parent), 0)
    siblings = np.array(family)[up]
    rows[:, len(TAGS):] = np.stack([
        good, bad, above_good, above_bad, depth, place, siblings,
        np.array(place) / np.maximum(siblings, 1), np.log1p(chars_), np.log1p(own_chars),
        np.log1p(nodes_), np.log1p(chars_ / nodes_), np.array(links) / np.maximum(chars_, 1),
        np.array(marks) / np.maximum(chars_, 1), chars_ / max(1.0, chars_[0]),
        np.log1p(pieces), np.log1p(inline), np.log1p(paragraphs),
        np.log1p(chars_[up]), np.log1p(headings),
    ], axis=1)
    return rows


def decode(parents: list[int], log_odds: np.ndarray) -> np.ndarray:
    """The likeliest marks such that on no way from the root to a leaf the content is entered
    twice: before it, inside it, and after it, in this order.

    So a page part judged as content is not split by single doubtful ancestors or
    descendants, and nothing inside a removed part comes back.
    """
    count = len(parents)
    inside = -np.logaddexp(0, -log_odds)
    outside = -np.logaddexp(0, log_odds)
    best = np.stack([outside, inside, outside], axis=1)  # before, inside, after
    for node in range(count - 1, 0, -1):
        before, within, after = best[node]
        up = best[parents[node]]
        up[0] += max(before, within, after)
        up[1] += max(within, after)
        up[2] += after
    state = np.zeros(count, np.int64)
    state[0] = int(best[0].argmax())
    for node in range(1, count):
        least = state[parents[node]]
        state[node] = least + int(best[node, least:].argmax())
    return state == 1


def text_of(page: Page, kept: np.ndarray) -> str:
    """The kept pieces: one line per block, white space within it as one space."""
    lines, last, parts = [], None, []
    for node, block, piece in page.pieces:
        if block != last:
            lines.append(" ".join("".join(parts).split()))
            last, parts = block, []
        if kept[node]:
            parts.append(piece)
    lines.append(" ".join("".join(parts).split()))
    return "\n".join(line for line in lines if line)


def content_marks(page: Page, mains: set[int]) -> np.ndarray:
    """Marks of the elements ``mains`` and what is in them, without the parts that are named
    as something else.

    A name does not count against the text: a part that holds nine tenths of the text of all
    ``mains`` is content whatever its class is called, and so is a header in the content that
    holds a title.
    """
    count = len(page.tags)
    chars, titles = [0] * count, [int(tag in ("h1", "h2")) for tag in page.tags]
    for node, _, piece in page.pieces:
        chars[node] += len(piece.strip())
    for node in range(count - 1, 0, -1):
        chars[page.parents[node]] += chars[node]
        titles[page.parents[node]] += titles[node]
    below = np.zeros(count, bool)  # in one of the mains
    for node in range(1, count):
        below[node] = below[page.parents[node]] or node in mains
    total = sum(chars[node] for node in mains if not below[page.parents[node]])
    inside, barred = np.zeros(count, bool), np.zeros(count, bool)
    for node in range(1, count):
        up = page.parents[node]
        if page.tags[node] in BOILER_TAGS:
            other = not (page.tags[node] == "header" and inside[up] and titles[node]
                         and 2 * page.links[node] <= chars[node])
        else:
            other = any(word in BOILER_WORDS for word in page.words[node]) and not (
                below[node] and total and 10 * chars[node] >= 9 * total)
        barred[node] = barred[up] or other
        inside[node] = not barred[node] and (inside[up] or node in mains)
    return inside


def landmarks(page: Page) -> np.ndarray | None:
    """Content marks of a page that names its parts itself, by ``article`` or ``main``
    elements, or None."""
    inside = content_marks(page, {
        node for node, tag in enumerate(page.tags) if tag in ("article", "main")})
    return inside if inside.any() else None


def example(dice: random.Random) -> str:
    """A page of made-up words. The trees see no words, only lengths and marks."""
    def words(least: int, most: int) -> str:
        return " ".join("x" * dice.randint(2, 9) for _ in range(dice.randint(least, most)))

    def paragraph() -> str:
        return " ".join(words(2, 9) + ", " + words(2, 12) + "." for _ in range(
            dice.randint(1, 6)))

    content = "".join(f"<p>{paragraph()}</p>" for _ in range(dice.randint(1, 12)))
    menu = "".join(f'<li><a href="#">{words(1, 2)}</a></li>' for _ in range(dice.randint(2, 8)))
    return (f"<html><body><nav><ul>{menu}</ul></nav><article><h1>{words(2, 8)}</h1>{content}"
            f"</article><aside><p>{words(3, 20)}</p></aside><footer>{words(2, 9)}</footer>"
            "</body></html>")


def variants(
    page: Page, inside: np.ndarray, dice: random.Random, bare: bool = False
) -> Iterator[str]:
    """Other layouts of the same texts, so that the trees do not learn one site's frame.

    The content is wrapped in an ``article`` or ``main`` mark that ``landmarks`` finds and
    that is taken away from the features afterwards. With ``bare`` some contents are in a part
    without a name, under a misleading one or right in the body, and some titles in a header.
    """
    blocks: dict[int, list] = {}
    for node, block, piece in page.pieces:
        blocks.setdefault(block, [node, ""])[1] += piece
    good = [t for node, t in blocks.values() if inside[node] and t.strip()]
    rest = [t for node, t in blocks.values() if not inside[node] and t.strip()] or ["Home"]

    def some(most: int, pool: list[str]) -> list[str]:
        return [html.escape(" ".join(dice.choice(pool).split()[:most])) for _ in range(
            dice.randint(1, 6))]

    def boiler() -> str:
        tag = dice.choice(["nav", "header", "footer", "aside", "form", "div", "div", "section",
                           "ul", "div"])
        word = dice.choice(sorted(BOILER_WORDS))
        own = tag in BOILER_TAGS and dice.random() < 0.5
        name = "" if own else f' {dice.choice(["class", "id"])}="{word}"'
        kind = dice.random()
        if kind < 0.35 or tag == "ul":
            inner = "".join(f'<li><a href="#">{t}</a></li>' for t in some(3, rest))
            inner = inner if tag == "ul" else f"<ul>{inner}</ul>"
        elif kind < 0.7:
            inner = "".join(f"<p>{t}</p>" for t in some(60, good + rest))
        elif kind < 0.85:
            inner = "".join(f"<div><b>{t}</b></div>" for t in some(12, rest))
        else:
            inner = " ".join(some(15, rest))
        return f"<{tag}{name}>{inner}</{tag}>"

    def several(most: int) -> str:
        return "".join(boiler() for _ in range(dice.randint(0, most)))

    for _ in range(VARIANTS):
        body = [f"<p>{html.escape(t)}</p>" if dice.random() < 0.9 else
                f"<blockquote>{html.escape(t)}</blockquote>" for t in good[1:]]
        if body and dice.random() < 0.4:
            body.insert(dice.randrange(len(body) + 1), boiler())
        if dice.random() < 0.3:
            items = "".join(f"<li>{t}</li>" for t in some(20, good))
            body.append(f"<ul>{items}</ul>")
        if len(body) > 3 and dice.random() < 0.4:
            body.insert(2, f"<h2>{html.escape(' '.join(good[-1].split()[:6]))}</h2>")
        tag = dice.choice(["article", "main", "div", "div", "section"])
        word = dice.choice(["", *sorted(CONTENT_WORDS)]) if tag in ("article", "main") else \
            dice.choice(sorted(CONTENT_WORDS))
        if bare and dice.random() < 0.3:  # a name that misleads
            word = f"{word} {dice.choice(sorted(BOILER_WORDS))}".strip()
        name = f' class="{word}"' if word else ""
        head = f"<h1>{html.escape(good[0])}</h1>" if good else ""
        if bare and dice.random() < 0.3:
            head = f"<header>{head}</header>"
        if bare and dice.random() < 0.2:
            yield (f"<html><head></head><body data-main>{several(2)}{head}{''.join(body)}"
                   f"{several(2)}</body></html>")
            continue
        if bare and dice.random() < 0.3:
            tag, name = "div", ""
        inner = f"<{tag}{name} data-main>{head}{''.join(body)}{several(2)}</{tag}>"
        if dice.random() < 0.4:
            inner = f'<div class="{dice.choice(["wrap", "container", "row", "page"])}">' \
                    f"{several(2)}{inner}{several(2)}</div>"
        yield f"<html><head></head><body>{several(3)}{inner}{several(3)}</body></html>"


def marked_main(source: str, page: Page) -> np.ndarray:
    """Content marks of a variant, whose main element has the attribute ``data-main``."""
    number = 0
    for _, _, tag, closing, attributes in tokens(source):
        if tag and not closing and tag not in INLINE | VOID:
            number += 1
            if attributes.endswith("data-main"):
                break
    return content_marks(page, {number})


def train(sources: list[str], seed: int = 1) -> Trees:
    """Fits the trees on pages that name their parts, as they are and in other layouts, and
    on ``EXAMPLES`` made-up pages, so that there are trees whatever the pages are."""
    rows, truth = [], []
    dice, own = random.Random(seed), random.Random(seed)
    made_up = [(example(own), own, True) for _ in range(EXAMPLES)]
    for source, drawn, bare in [*((source, dice, False) for source in sources), *made_up]:
        page = parse(source)
        inside = landmarks(page)
        if inside is None:
            continue
        rows.append(node_features(page))
        truth.append(inside)
        for other in variants(page, inside, drawn, bare):
            made = parse(other)
            rows.append(node_features(made))
            truth.append(marked_main(other, made))
    return boost(np.concatenate(rows), np.concatenate(truth).astype(float))


def fit_extractor(pages: DataFrame, most: int = TRAINING_PAGES) -> Trees | None:
    """Trains on at most ``most`` pages, picked by a hash of the id; None if no page has html."""
    known = pages.filter(F.col("html").isNotNull()).select("page_id", "html")
    chosen = known.select("page_id").distinct().orderBy(
        F.xxhash64("page_id"), "page_id").limit(most)
    rows = (
        known.join(F.broadcast(chosen), "page_id")
        .groupBy("page_id").agg(F.max("html").alias("html"))
        .orderBy(F.xxhash64("page_id"), "page_id").collect()
    )
    return train([row["html"] for row in rows]) if rows else None


def extract(pages: DataFrame, trees: Trees | None) -> DataFrame:
    """(page_id, url, text) per row: the main text of the whole page.

    Null and empty pages and pages without content have an empty text. Without trees the
    page's own landmarks decide alone. Repeated rows give repeated results, an empty table an
    empty one; other columns are not read.
    """
    shared = pages.sparkSession.sparkContext.broadcast(
        trees and (trees.features, trees.cuts, trees.leaves, trees.start))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value and Trees(*shared.value)
        for batch in slices(batches):
            parsed = [parse(source or "") for source in batch.column("html").to_pylist()]
            sizes = [len(page.tags) for page in parsed]
            if own:
                odds = own.log_odds(np.concatenate([node_features(page) for page in parsed]))
                marks = [decode(page.parents, part) for page, part in zip(
                    parsed, np.split(odds, np.cumsum(sizes)[:-1]), strict=True)]
            else:
                marks = [landmarks(page) for page in parsed]
                marks = [np.zeros(n, bool) if m is None else m
                         for n, m in zip(sizes, marks, strict=True)]
            texts = [text_of(page, kept) for page, kept in zip(parsed, marks, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                names=["page_id", "url", "text"],
            )

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(
        run, "page_id long, url string, text string")
