"""Main text of web pages by tag-path ratios.

A page is a row of text blocks, each with the path of tags from the root to it. For every
path, text length and punctuation are added up and divided by its number of blocks. The
ratios are smoothed over neighbouring blocks, fused by their product, and paths above a
threshold carry content. The content's container is the smallest element around all blocks
with such a path; it is never a part of an article (or, without one, of the main element), and
grows to take in headings beside it. Where that is the body, and parts of one path hold most of
the score, these are the article, and other parts, or lists that are mostly links, are the
site's. All blocks left are the text, but for those in parts that are not the article by their
tag, class or role: menus, headers, footers, sidebars, notices, adverts, forms, comments,
scripts and styles. Names count as a whole or by their last word (``has-sidebar`` is no
sidebar), and not for elements that hold the article or most of the page's score. If no path
reaches the threshold, as on pages with a few words, the path with the highest ratio carries
the content.

Character references are decoded, white space inside a block becomes one space, blocks are
joined by a newline.

Defined results: null and empty pages, and pages without article text, give an empty text;
truncated tags and comments at the end are dropped; end tags without a start are ignored; a
bare ``<`` is text. A page is the unit of work, whatever its length; tags and blocks are
looked at once, however deep they are nested. Repeated rows are extracted each, an empty table
gives no rows. Extra columns are passed over or kept as asked, whatever their names, but for
``text`` and ``n_chars``.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmill.llm.common import free_name

# Paths whose fused ratio is above this many standard deviations carry content.
THRESHOLD = 0.2
_KERNEL = np.exp(-np.arange(-2, 3) ** 2 / 2.0)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?"
)
_NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
_PARTS = re.compile(r"[A-Za-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？]")

RAW = {"script", "style", "textarea", "noscript", "template", "iframe", "svg", "canvas",
       "annotation", "annotation-xml"}
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
    "source", "track", "wbr",
}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd",
    "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer",
    "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend",
    "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "search", "section",
    "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul",
}
ENDS_PARAGRAPH = BLOCKS - {"br", "html", "head", "body", "option", "optgroup", "title"}
# An opening tag ends an open element of these, unless one of the borders lies between.
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
NO_CONTAINER = HEADINGS | {"p", "li", "ul", "ol", "blockquote", "pre", "tr"}
OUTSIDE = {"head", "title", "nav", "footer", "aside", "form", "button", "select", "dialog", "menu",
           "search", "object", "label", "fieldset", "datalist"}
OUTSIDE_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "adbox", "banner", "sponsor", "sponsored",
    "promo", "promotion", "cookie", "cookies", "consent", "notice", "notices", "notification",
    "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "signup", "nav", "navigation",
    "navbar", "menu", "breadcrumb", "breadcrumbs", "sidebar", "sidenav", "aside", "widget",
    "footer", "header", "masthead", "comment", "comments", "reply", "replies", "disqus", "respond",
    "share", "sharing", "social", "related", "recommended", "toolbar", "pagination", "pager",
    "search", "login", "copyright", "disclaimer", "contentinfo", "complementary",
}
COMMENT_NAMES = {"comment", "comments", "reply", "replies", "ad", "ads", "advert", "sponsored"}
# What may stand beside such a word in a class or id that still says the same.
NEUTRAL = {
    "site", "page", "main", "top", "bottom", "left", "right", "global", "primary", "secondary",
    "mobile", "desktop", "sticky", "fixed", "inner", "outer", "list", "box", "bar", "container",
    "wrapper", "wrap", "area", "block", "panel", "column", "col", "group", "item", "items", "link",
    "links", "button", "buttons", "icon", "icons", "form", "section", "thread", "body", "text", "slot",
}
# Names whose last word says what the element is, whatever stands before it; the first for
# any element, the second not inside an article, where they may name a part of it.
SAID_LAST = {
    "comment", "comments", "reply", "replies", "ad", "ads", "advert", "adverts", "advertisement",
    "adsbygoogle", "sponsored", "newsletter", "signup", "subscribe", "consent", "cookies",
    "related", "recommended", "sharing", "share", "social", "breadcrumb", "breadcrumbs",
}
SAID_LAST_OUTSIDE = {
    "sidebar", "widget", "footer", "nav", "navbar", "navigation", "menu", "banner", "popup",
    "modal", "promo", "promotion", "notice", "notification", "masthead", "toolbar", "pagination",
    "cookie", "login",
}
# Words that turn such a name around, and names of several words.
NOT_SAID = {"has", "with", "no", "not", "without", "is", "and"}
SAID_TOGETHER = {("most", "read"), ("most", "popular"), ("read", "next"), ("newsletter", "signup")}
# Never the article, however much of the page they hold.
NEVER_ARTICLE = COMMENT_NAMES | {
    "adverts", "advertisement", "adbox", "disqus", "respond", "cookie", "cookies", "consent",
}
# A named element with this share of the page's score is the article in spite of its name.
OVERRIDE_SHARE = 0.8
# Parts of a page that may be one of its article's or of its site's.
_PARTITIONS = {"div", "section", "td", "table", "center", "article"}
_LISTS = {"ul", "ol", "dl"}
# Share of the score that makes parts of one path the article, and of links in other parts.
RULING_SHARE = 0.6
LINKED_SHARE = 0.5
# Only these, inside an article, are told by their ids; others' are places to link to.
_TOLD_BY_ID = {"div", "ul", "ol"}


class Element:
    """An open tag: its parent, and whether the article can lie in it.

    It cannot by ``removed`` (its tag or a hidden attribute) or ``named`` (its class, id or
    role), of its own or of an element around it.
    """

    __slots__ = (
        "tag", "parent", "outside", "inside_article", "path", "paths", "removed", "named", "never",
    )

    def __init__(self, tag: str, parent: Element | None, attributes: dict[str, str]):
        self.tag = tag
        self.parent = parent
        self.inside_article = tag in ("article", "main") or bool(parent and parent.inside_article)
        # Paths go by number: that of the parent's path, with the tag and its names.
        self.paths: dict[tuple[int, str], int] = parent.paths if parent else {}
        label = tag
        self.named = self.never = False
        self.removed = bool(parent and parent.removed) or _hidden(attributes)
        names = [attributes[x] for x in ("class", "id", "role") if x in attributes]
        if names:
            # Ids are numbered through, so their digits do not tell paths apart.
            parts = {p.lower() for n in names for p in _PARTS.findall(_CAMEL.sub(" ", n))}
            parts |= set(attributes.get("class", "").lower().split())
            label += "".join(f".{p}" for p in sorted(parts))
        self.path = self.paths.setdefault((parent.path if parent else -1, label), len(self.paths))
        if tag not in ("html", "body", "main"):
            told = self._told(attributes) if names else frozenset()
            if tag == "article":
                told &= COMMENT_NAMES
            else:
                self.removed |= tag in OUTSIDE or tag == "header" and not self.inside_article
            self.named = bool(told)
            self.never = bool(told & NEVER_ARTICLE)
        self.outside = self.removed or self.named or bool(parent and parent.outside)

    def _told(self, attributes: dict[str, str]) -> frozenset[str]:
        """Words for parts outside the article that whole names of the element say."""
        names = f"{attributes.get('class', '')} {attributes.get('role', '')}".split()
        section = self.tag == "section" or "section" in names
        anchor = self.tag in HEADINGS or self.inside_article and (section or self.tag not in _TOLD_BY_ID)
        if not anchor:
            names += attributes.get("id", "").split()
        found: set[str] = set()
        for name in names:
            order = [p.lower() for p in _PARTS.findall(_CAMEL.sub(" ", name))]
            words = set(order)
            if words <= OUTSIDE_NAMES | NEUTRAL:
                found |= words & OUTSIDE_NAMES
            elif not words & NOT_SAID:
                last = order[-1] if order[-1] in SAID_LAST else order[-1].removesuffix("s")
                if last in SAID_LAST or not self.inside_article and last in SAID_LAST_OUTSIDE:
                    found.add(last)
                if any(pair in SAID_TOGETHER for pair in pairwise(order)):
                    found.add("promo")
        # The header inside an article holds its title.
        return frozenset(found - {"header"} if self.inside_article else found)


def _attributes(text: str) -> dict[str, str]:
    """Attributes of a tag; the first of a name counts."""
    found: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), a or b or c)
    return found


def _hidden(attributes: dict[str, str]) -> bool:
    return (
        attributes.get("hidden", "until-found").strip().lower() != "until-found"
        or attributes.get("aria-hidden", "").strip().lower() == "true"
        or bool(_NOT_SHOWN.search(attributes.get("style", "")))
    )


def blocks(page: str) -> tuple[list[tuple[Element, str]], list[int]]:
    """Text blocks of a page in order, each with the innermost block element around it.

    Beside them, how many characters of each are the text of links.
    """
    found: list[tuple[Element, str]] = []
    linked: list[int] = []
    stack = [Element("#root", None, {})]
    # Open elements by tag, so that a tag that is not open is not looked for.
    is_open: dict[str, int] = defaultdict(int)
    held: list[str] = []
    links = at = 0

    def hold(text: str) -> None:
        nonlocal links
        text = html.unescape(text)
        held.append(text)
        if is_open["a"]:
            links += len(text.strip())

    def flush() -> None:
        nonlocal links
        if held:
            text = " ".join("".join(held).split())
            held.clear()
            if text:
                # Inline elements count for what they hide, not for the path.
                found.append((stack[-1], text))
                linked.append(links)
        links = 0

    def cut(i: int) -> None:
        for e in stack[i:]:
            is_open[e.tag] -= 1
        del stack[i:]

    def close(tags: set[str], borders: set[str]) -> None:
        for tag in tags:
            if is_open[tag]:
                break
        else:
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in borders:
                return
            if stack[i].tag in tags:
                flush()
                cut(i)
                return

    size = len(page)
    while at < size:
        match = _TOKEN.search(page, at)
        if match is None:
            hold(page[at:])
            break
        if match.start() > at:
            hold(page[at : match.start()])
        at = match.end()
        tag = match[2] or match[5]
        if tag is None or (match[5] is not None and not match[0].endswith(">")):
            continue
        tag = tag.lower()
        if match[1] or match[4]:
            if is_open[tag]:
                if tag in BLOCKS:
                    flush()
                # An end tag of inline text does not end the blocks inside it.
                for i in range(len(stack) - 1, 0, -1):
                    if tag not in BLOCKS and stack[i].tag in BLOCKS:
                        break
                    if stack[i].tag == tag:
                        if stack[i].outside != stack[i].parent.outside:
                            flush()
                        cut(i)
                        break
            elif tag in BLOCKS:
                flush()
            continue
        attributes = match[3] or match[6] or ""
        if tag in RAW:
            if not attributes.endswith("/"):
                end = re.compile(f"</{tag}[^>]*(?:>|\\Z)", re.I).search(page, at)
                at = end.end() if end else size
            continue
        if tag in BLOCKS:
            flush()
            if tag in ENDS_PARAGRAPH:
                close({"p"}, {"table", "td", "th", "button", "object"})
            if tag in SIBLINGS:
                close(*SIBLINGS[tag])
        if tag in VOID:
            continue
        element = Element(tag, stack[-1], _attributes(attributes))
        if element.outside != stack[-1].outside:
            flush()
        stack.append(element)
        is_open[tag] += 1
    flush()
    return found, linked


def _block_path(element: Element) -> int:
    """Path down to the innermost block element; inline tags do not split paths."""
    while element.parent is not None and element.tag not in BLOCKS:
        element = element.parent
    return element.path


def path_scores(found: list[tuple[Element, str]]) -> np.ndarray:
    """Fused, smoothed ratio of the path of each block; 0 for blocks outside the article."""
    chars: dict[int, list[float]] = {}
    paths = [_block_path(e) for e, _ in found]
    for path, (element, text) in zip(paths, found, strict=True):
        sums = chars.setdefault(path, [0.0, 0.0, 0.0])
        if not element.outside:
            sums[0] += len(text)
            sums[1] += len(_PUNCTUATION.findall(text)) + 1
            sums[2] += 1
    length = np.array([chars[p][0] / max(chars[p][2], 1) for p in paths])
    marks = np.array([chars[p][1] / max(chars[p][2], 1) for p in paths])
    if len(found) > len(_KERNEL):
        weight = np.convolve(np.ones(len(found)), _KERNEL, "same")
        length = np.convolve(length, _KERNEL, "same") / weight
        marks = np.convolve(marks, _KERNEL, "same") / weight
    fused = length * marks
    outside = np.array([e.outside for e, _ in found])
    fused[outside] = 0
    # One score for a path: that of its blocks together.
    means: dict[int, list[float]] = {}
    for path, value in zip(paths, fused, strict=True):
        mean = means.setdefault(path, [0.0, 0])
        mean[0] += value
        mean[1] += 1
    return np.array([means[p][0] / means[p][1] for p in paths])


def _override_names(found: list[tuple[Element, str]]) -> None:
    """Take back in what only its name puts outside, if it holds nearly all of the score.

    The score is that of the article and main elements, if there are any outside named
    parts or they are most of the page, and that of the page otherwise.
    """
    # By block: the named elements around it, and whether it is in an article, and in one
    # outside named parts. Nothing brings back blocks with none of the first.
    if not any(e.outside and not e.removed for e, _ in found):
        return
    around: list[list[Element]] = []
    inside, free = np.zeros((2, len(found)), dtype=bool)
    for i, (element, _) in enumerate(found):
        own, above, never = [], 0, element.removed
        at: Element | None = element
        while at is not None and not never:
            if at.named:
                own.append(at)
                never = at.never
            if at.tag in ("article", "main"):
                inside[i], above = True, len(own)
            at = at.parent
        around.append([] if never else own)
        inside[i] &= not never
        free[i] = inside[i] and len(own) == above
    named = {id(e): e for own in around for e in own}
    if not named:
        return
    held = np.array([e.outside for e, _ in found])
    # Scores as if no name had been seen.
    for (element, _), own in zip(found, around, strict=True):
        element.outside = element.outside and not own
    scores = path_scores(found)
    scores[[e.outside for e, _ in found]] = 0
    if free.any():
        scores[~free] = 0
    elif scores[inside].sum() > scores.sum() / 2:
        scores[~inside] = 0
    # If the names leave nothing, half of the score is enough.
    least = scores.sum() * (0.5 if held.all() else OVERRIDE_SHARE)
    share = dict.fromkeys(named, 0.0)
    for own, score in zip(around, scores.tolist(), strict=True):
        for e in own:
            share[id(e)] += score
    for key, element in named.items():
        element.named = not 0 < least <= share[key]
    for element, _ in found:
        at = element
        element.outside = element.removed
        while at is not None and not element.outside:
            element.outside = at.named
            at = at.parent


def _container(found: list[tuple[Element, str]], usable: np.ndarray, seeds: np.ndarray) -> Element:
    """Smallest element around all seeds that cuts off no part of an article and no heading."""
    first = found[int(np.argmax(seeds))][0]
    chain = [first]
    while chain[-1].parent is not None:
        chain.append(chain[-1].parent)
    chain.reverse()
    place = {id(e): i for i, e in enumerate(chain)}

    def shared(at: Element) -> int:
        """Place in the chain of the innermost element that holds ``at``."""
        passed = []
        while id(at) not in place:
            passed.append(id(at))
            at = at.parent
        place.update(dict.fromkeys(passed, place[id(at)]))
        return place[id(at)]

    end = min(shared(e) for (e, _), seed in zip(found, seeds, strict=True) if seed)
    # A lone paragraph is no container; its parent has the headings and lists beside it.
    while end and (chain[end].tag not in BLOCKS or chain[end].tag in NO_CONTAINER):
        end -= 1
    for tag in ("main", "article"):
        end = next((i for i, e in enumerate(chain[: end + 1]) if e.tag == tag), end)
    headings = []
    for (element, _), ok in zip(found, usable, strict=True):
        at: Element | None = element
        while at is not None and at.tag not in BLOCKS:
            at = at.parent
        if ok and at is not None and at.tag in HEADINGS:
            headings.append((shared(at), at))
    # A container with a title of its own leaves the site's alone, but no heading beside it.
    titled = any(i >= end and h.tag == "h1" for i, h in headings)
    beside = [
        i for i, h in headings if (h.tag == "h1" and not titled) or h.parent is chain[i]
    ]
    return chain[min([end, *beside])]


def _parts(found: list[tuple[Element, str]], container: Element) -> list[Element | None]:
    """The child of the container that holds each block: none outside it, itself if its own."""
    holder: dict[int, Element | None] = {id(container): container}
    for element, _ in found:
        passed = []
        at: Element | None = element
        while at is not None and id(at) not in holder:
            passed.append(at)
            at = at.parent
        part = holder[id(at)] if at is not None else None
        for e in reversed(passed):
            if part is container and e.parent is container:
                part = e
            holder[id(e)] = part
    return [holder[id(element)] for element, _ in found]


def _chosen_parts(
    found: list[tuple[Element, str]],
    linked: list[int],
    scores: np.ndarray,
    parts: list[Element | None],
    container: Element,
) -> np.ndarray:
    """Which blocks of the container are content.

    Below the body itself, an article stands beside the parts of its site. Parts that are
    mostly links are none of it. If parts of one path hold most of the score, other parts of
    the page are not of the article, unless they have the only title; headings and paragraphs
    directly below the body are.
    """
    keep = np.array([part is not None for part in parts], dtype=bool)
    if container.tag not in ("#root", "html", "body"):
        return keep
    totals: dict[int, list] = {}
    for i, (element, text) in enumerate(found):
        part = parts[i]
        if part is None or element.outside:
            continue
        sums = totals.setdefault(id(part), [part, 0, 0, 0.0, 0, False])
        sums[1] += len(text)
        sums[2] += min(linked[i], len(text))
        sums[3] += scores[i]
        sums[4] += 1
        while element is not part and element.tag not in BLOCKS:
            element = element.parent
        sums[5] |= element.tag == "h1"
    by_path: dict[int, float] = {}
    for part, _, _, score, _, _ in totals.values():
        if part.tag in _PARTITIONS:
            by_path[part.path] = by_path.get(part.path, 0.0) + score
    best = max(by_path, key=by_path.__getitem__, default=None)
    whole = sum(sums[3] for sums in totals.values())
    ruling = best is not None and by_path[best] >= RULING_SHARE * whole
    chosen = [x for x in totals.values() if ruling and x[0].path == best]
    titled = any(x[5] for x in chosen)
    dropped = set()
    for key, (part, chars, links, _, _, title) in totals.items():
        if part.tag not in _PARTITIONS and part.tag not in _LISTS or part.path == best and ruling:
            continue
        if links >= LINKED_SHARE * chars and len(totals) > 1:
            dropped.add(key)
        elif ruling and part.tag in _PARTITIONS and not (title and not titled):
            dropped.add(key)
    if len(dropped) < len(totals):
        keep &= np.array([part is None or id(part) not in dropped for part in parts], dtype=bool)
    return keep


def main_text(page: str | None) -> str:
    """Article text of a page."""
    found, linked = blocks(page or "")
    _override_names(found)
    usable = np.array([not e.outside for e, _ in found], dtype=bool)
    if not usable.any():
        return ""
    scores = path_scores(found)
    seeds = usable & (scores >= THRESHOLD * scores[usable].std()) & (scores > 0)
    if not seeds.any():
        seeds = usable & (scores == scores[usable].max())
    container = _container(found, usable, seeds)
    parts = _parts(found, container)
    keep = usable & _chosen_parts(found, linked, scores, parts, container)
    return "\n".join(text for (_, text), kept in zip(found, keep.tolist(), strict=True) if kept)


def extract_pages(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``keep``, ``text`` and ``n_chars`` of every page (columns ``keep`` and ``html``)."""
    keep = ["page_id", "url"] if keep is None else keep

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(len(keep))]
            columns = [*batch.columns[: len(keep)], pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "text"])

    schema = ", ".join(f"`{c}` {t}" for c, t in pages.select(*keep).dtypes)
    rows = pages.select(*keep, F.col("html").alias(free_name("_html", keep)))
    found = rows.mapInArrow(compute, f"{schema}, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
