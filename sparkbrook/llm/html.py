"""Main text of web pages by tag-path ratios.

A page becomes a sequence of text blocks, each with its root-to-leaf path of block-level
tags (and class names). Per path, text length and punctuation are summed over its blocks
and divided by their number; the two ratios of the block sequence are smoothed with a
Gaussian and fused by their geometric mean. The fused ratio, with and without smoothing,
times the evidence of tags and names is the path's score: a path below an <article> or
<main> counts more; one below navigation, header, footer, aside, form and similar
elements, or below classes and ids that name such parts, counts a tenth; one whose text is
mostly links counts nothing. A wrapper that holds most of the page's text is no evidence
against it. Paths whose score passes a share of the scores' spread are content. In the
container that holds most of the content mass, the text that belongs to it stays as well:
paths that miss the threshold by little, a heading before content, and list items, table
cells and the like between content.

White space inside a block becomes one space, blocks are joined by one newline in page
order. Null or empty html gives an empty text, and so does a page without content; null
ids and urls are passed on; repeated rows each give their row; paths whose scores tie are
kept or dropped together; pages of any length and depth are read whole, a page at a time;
an empty table gives an empty result; further columns, whatever their names, are not read.
"""

from __future__ import annotations

import functools
import html as entities
import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML: elements by their role.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style noscript template iframe svg math object canvas audio video select textarea button title xmp".split())
RAW = frozenset("script style title textarea iframe noscript xmp".split())
NOT_CONTENT = frozenset("nav header footer aside form menu dialog fieldset head".split())
CLOSED_BY_BLOCK = frozenset(["p"])
CLOSED_BY_SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"), "td": ("tr",), "th": ("tr",), "option": ("select",)}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Short text of these elements belongs to the content around it.
ENCLOSED = HEADINGS | frozenset("li dt dd td th caption figcaption pre blockquote".split())

#: What the evidence multiplies a score with.
MARKED, BARRED = 1.5, 0.1
#: Share of the threshold that suffices in the container.
NEAR = 0.5

#: Words of class names and ids that mark parts other than the article.
PARTS = frozenset(
    "ad ads advert adverts advertisement advertising adbox adslot banner banners breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus dropdown "
    "footer footnav header masthead hidden login menu modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promoted "
    "promotion recommended related reply replies respond share sharing sidebar sidebars signup skip social sponsor sponsored subscribe subscription tagcloud toolbar "
    "topbar widget widgets discussion alert toast gdpr paywall overlay".split()
)

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*)>|[^>]*(?:>|\Z))",
    re.S,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""", re.I)
_NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_PUNCTUATION = re.compile(r"[.,;:!?¡¿…、。，；：！？·'\"()]")


@dataclass
class Block:
    """A run of text between block boundaries."""

    path: tuple[str, ...]
    text: str
    linked: int
    barred: bool
    bars: tuple[int, ...] = ()  # the elements above that speak against it, by number; negative: by their tag


def _marks(attributes: str) -> tuple[str, bool]:
    """The first class name, and whether names or roles mark another part than the article."""
    name, barred = "", False
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), a or b or c
        if key == "class" and not name:
            name = value.split()[0] if value.split() else ""
        if key in ("class", "id"):
            barred |= any(w.lower() in PARTS for part in value.split() for w in _NAME_WORDS.findall(part))
        elif key == "role":
            barred |= value.lower() in ("navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert")
        elif key == "hidden":
            barred |= not value or value.lower() in ("hidden", "true", "until-found")
        elif key == "aria-hidden":
            barred |= value.lower() == "true"
    return name, barred


@functools.cache
def _closing(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}\s*>", re.I)


def blocks_of(page: str) -> list[Block]:
    """The page's text blocks in order. Missing end tags are implied, stray ones are ignored."""
    found: list[Block] = []
    stack: list[tuple[str, str, tuple[int, ...]]] = []  # tag, step of the path, numbers of the barring elements so far
    parts: list[str] = []
    bar_count = 0
    linked = in_link = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            raw = "".join(parts)
            text = " ".join((entities.unescape(raw) if "&" in raw else raw).split())
            if text:
                bars = stack[-1][2] if stack else ()
                found.append(Block(tuple(s for _, s, _ in stack), text, min(linked, len(text)), bool(bars), bars))
            parts.clear()
        linked = 0

    def open_(tag: str, attributes: str) -> None:
        nonlocal bar_count
        if tag not in INLINE:
            if tag in CLOSED_BY_SAME:
                stop = CLOSED_BY_SAME[tag]
                kin = ("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else (tag,)
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in stop:
                        break
                    if stack[i][0] in kin:
                        del stack[i:]
                        break
            if stack and stack[-1][0] in CLOSED_BY_BLOCK:
                stack.pop()
        name, barred = _marks(attributes) if "=" in attributes or "hidden" in attributes else ("", False)
        above = stack[-1][2] if stack else ()
        bars = tag in NOT_CONTENT or barred and tag not in ("html", "body", "article", "main")
        if tag in ("article", "main") and barred:
            bars = any(t in ("article", "main") for t, _, _ in stack) or _names_comment(attributes)
        if bars:
            bar_count += 1
            above = (*above, -bar_count if tag in NOT_CONTENT and tag not in ("form", "fieldset") else bar_count)
        stack.append((tag, f"{tag}.{name}" if name else tag, above))

    at, end = 0, len(page)
    while at < end:
        match = _TAG.search(page, at)
        if match is None:
            parts.append(page[at:])
            linked += (end - at) * (in_link > 0)
            break
        if match.start() > at:
            parts.append(page[at : match.start()])
            linked += (match.start() - at) * (in_link > 0)
        at = match.end()
        tag = match[2]
        if tag is None:
            if match[0].startswith("<![CDATA["):
                parts.append(match[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        tag = tag.lower()
        if match[1]:
            if tag == "a":
                in_link = max(0, in_link - 1)
            elif tag not in INLINE and any(t == tag for t, _, _ in stack):
                flush()
                in_link = 0
                while stack.pop()[0] != tag:
                    pass
            elif tag in INLINE:
                while stack and stack[-1][0] in INLINE:  # barred inline elements are on the stack
                    if stack[-1][0] == tag:
                        flush()
                        stack.pop()
                    break
            continue
        attributes = match[3] or ""
        if tag == "br":
            parts.append(" ")
        elif tag in VOID:
            if tag == "hr":
                flush()
        elif tag in SKIPPED:
            close = _closing(tag).search(page, at)
            if tag in RAW or not attributes.rstrip(">").endswith("/"):
                at = close.end() if close else end if tag in ("script", "style") else at
            parts.append(" ")
        elif tag in INLINE:
            if tag == "a":
                in_link += 1
            elif "=" in attributes and _marks(attributes)[1]:
                flush()
                open_(tag, attributes)
        else:
            flush()
            in_link = 0
            open_(tag, attributes)
    flush()
    return _without_wrappers(found)


def _without_wrappers(blocks: list[Block]) -> list[Block]:
    """Frees the blocks of barring elements that wrap the page.

    Such an element holds more than half of the text, and holds the page's h1 or main or,
    if its name or a form makes it barring, leaves hardly any text outside of it.
    """
    mass: dict[int, int] = {}
    leading: set[int] = set()
    for b in blocks:
        steps = [s.split(".")[0] for s in b.path] if b.bars else ()
        for n in b.bars:
            mass[n] = mass.get(n, 0) + len(b.text) - b.linked
            if "h1" in steps or "main" in steps:
                leading.add(n)
    total = sum(len(b.text) - b.linked for b in blocks)
    rest = [b for b in blocks if not b.bars]
    free = sum(len(b.text) - b.linked for b in rest)
    # a marked article needs no other text beside it, however short it is against its comments
    free *= 20 if any(_is_marked(b.path) or b.path[-1:] and b.path[-1].split(".")[0] == "h1" for b in rest) else 5
    wrappers = {n for n, m in mass.items() if 2 * m > total and (n in leading or n > 0 and free < total)}
    if wrappers:
        for b in blocks:
            b.bars = tuple(n for n in b.bars if n not in wrappers)
            b.barred = bool(b.bars)
    return blocks


def _names_comment(attributes: str) -> bool:
    return any(w.lower() in ("comment", "comments", "reply", "related", "promo", "sponsored", "ad", "advert") for _, a, b, c in _ATTRIBUTE.findall(attributes) for w in _NAME_WORDS.findall(a or b or c))


def _smoothed(values: np.ndarray, sigma: float) -> np.ndarray:
    radius = max(1, math.ceil(2 * sigma))
    kernel = np.exp(-(np.arange(-radius, radius + 1) ** 2) / (2 * sigma * sigma))
    return np.convolve(np.pad(values, radius, mode="edge"), kernel / kernel.sum(), mode="valid")


def _key(b: Block) -> tuple[tuple[str, ...], bool]:
    return b.path, b.barred


def _is_marked(path: tuple[str, ...]) -> bool:
    return any(s.split(".")[0] in ("article", "main") for s in path)


def path_scores(blocks: list[Block], sigma: float = 1.0) -> dict[tuple[tuple[str, ...], bool], float]:
    """Score of each path, for barred and other blocks apart: text and punctuation ratio, fused, times the evidence."""
    sums: dict[tuple[tuple[str, ...], bool], list[float]] = {}
    for b in blocks:
        s = sums.setdefault(_key(b), [0.0, 0.0, 0.0, 0.0])
        s[0] += max(0, len(b.text) - 2 * b.linked)
        s[1] += len(_PUNCTUATION.findall(b.text)) if b.linked * 2 < len(b.text) else 0
        s[2] += 1
        s[3] += len(b.text) - 2 * b.linked
    text = np.array([sums[_key(b)][0] / sums[_key(b)][2] for b in blocks])
    marks = np.array([sums[_key(b)][1] / sums[_key(b)][2] for b in blocks])
    own = np.sqrt(text * (marks + 0.25))
    smooth = np.sqrt(_smoothed(text, sigma) * (_smoothed(marks, sigma) + 0.25))
    means: dict[tuple[tuple[str, ...], bool], list[float]] = {}
    for b, f in zip(blocks, np.sqrt(own * smooth), strict=True):
        means.setdefault(_key(b), []).append(float(f))
    evidence = lambda k: (MARKED if _is_marked(k[0]) else 1.0) * (BARRED if k[1] else 1.0) * (sums[k][3] > 0)
    return {k: evidence(k) * sum(v) / len(v) for k, v in means.items()}


def extract_text(page: str | None, share: float = 0.4) -> str:
    """The main text of one page. ``share``: of the mean plus spread of the path scores, from which a path is content."""
    if not page:
        return ""
    blocks = blocks_of(page)
    if not blocks:
        return ""
    scores = path_scores(blocks)
    values = np.array(list(scores.values()))
    limit = share * (values.mean() + values.std()) if len(values) > 1 else 0.0
    content = [scores[_key(b)] >= limit and scores[_key(b)] > 0 for b in blocks]
    mass: dict[tuple[str, ...], int] = {}
    for b, c in zip(blocks, content, strict=True):
        if c:
            mass[b.path[:-1]] = mass.get(b.path[:-1], 0) + len(b.text)
    if not mass:
        return ""
    total, container = sum(mass.values()), max(mass, key=lambda p: (mass[p], -len(p)))
    while len(container) > 2 and mass_below(mass, container) < 0.5 * total:
        container = container[:-1]
    inside = [not b.barred and b.path[: len(container)] == container and b.linked * 2 < len(b.text) for b in blocks]
    first = next((i for i, (c, o) in enumerate(zip(content, inside, strict=True)) if c and o), len(blocks))
    last = next((i for i in reversed(range(len(blocks))) if content[i] and inside[i]), -1)
    kept = []
    before = False  # whether the next block is kept
    for i in reversed(range(len(blocks))):
        b, keep = blocks[i], content[i]
        if not keep and inside[i]:
            tag = b.path[-1].split(".")[0] if b.path else ""
            keep = scores[_key(b)] >= NEAR * limit or tag in ENCLOSED and first < i < last or tag in HEADINGS and before
        before = keep
        if keep:
            kept.append(b.text)
    return "\n".join(reversed(kept))


def mass_below(mass: dict[tuple[str, ...], int], prefix: tuple[str, ...]) -> int:
    return sum(n for p, n in mass.items() if p[: len(prefix)] == prefix)


def extract_pages(pages: DataFrame, id_column: str = "page_id", html_column: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every row, one row each, without an exchange."""

    def run(batches):
        for batch in batches:
            texts = [extract_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    chosen = pages.select(F.col(id_column).cast("long").alias("page_id"), "url", F.col(html_column).alias("html"))
    return chosen.mapInArrow(run, "page_id long, url string, text string, n_chars long")
