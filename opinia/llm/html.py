"""Main text of web pages by tag-path ratios.

Per page, text is collected in blocks, each under the path of block-level tags from the root to it. Per path the text
length and punctuation per block are added up, for inner nodes over everything below them. Paths are nodes of a tree, so
deep nesting costs one step a level. A path's ratio is smoothed with that of the nodes above it, up to the body, so that
a heading or a list inside a long article shares the article's weight and a single long line elsewhere does not. The ratios are fused with the share of linked text and with what tag
names and classes say of a node, and a path is content if it comes to ``THRESHOLD`` of the page's heaviest path. All that
stands below the heaviest path's container is content too, unless tags or names exclude it: short lists and table cells of
an article have low ratios of their own. The container is the outermost article or main around the path, or else its parent;
where that is the body itself, and below the containers of other paths that carry much content, only what is not mostly
links counts.

A page is one row and never leaves it: no shuffle, and memory is bounded by the page. Broken mark-up is read as it
stands: unclosed tags end with what encloses them, an end tag without a start is ignored, unclosed comments, scripts,
styles, titles and textareas run to the end of the page. Null html gives an empty text. White space is any Unicode white space; ``br`` counts as such.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.2
SMOOTHING = 0.5
# Content that is not text of the page. These run to their end tag, or else to the end of the page, as in browsers.
# A quoted value may hold ">".
ATTRIBUTES = r"""(?:=\s*+"[^"]*+"|=\s*+'[^']*+'|[^>])*+"""
TOKENS = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>script|style|textarea|title)\b{ATTRIBUTES}>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*>"
    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>{ATTRIBUTES})>"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
# Behind the last ">" nothing is a tag any more. Groups that never match keep both kinds of tokens alike.
LAST_TOKENS = re.compile(r"<!--.*\Z|(?P<text>[^<]+|<)(?P<tag>(?!))?", re.S)
# These run to their end tag; without one, or closed in themselves, only the tag is no text.
ENCLOSED = {t: re.compile(rf"</{t}\s*>", re.I) for t in "noscript template svg math iframe object canvas select button".split()}
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr br".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# A start tag ends open elements of these kinds, up to the nearest container.
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LISTS = frozenset("ul ol dl table tbody thead tfoot menu".split())
# Roots carry no weight of their own.
ROOTS = frozenset(("html", "body"))
OUTSIDE = frozenset("nav footer header menu head".split())
# These count only where most of the text lies elsewhere: whole pages stand in one form, say.
OUTSIDE_UNLESS_MOST = frozenset("aside form dialog fieldset".split())
INSIDE = frozenset(("article", "main"))
OUTSIDE_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|sponsor(?:ed)?|promo(?:tion)?|banner|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|"
    r"comments?-?(?:list|area|section|body|form|author|thread)?|disqus|repl(?:y|ies)|sidebar|side|menu|nav|navigation|navbar|breadcrumbs?|footer|header|masthead|toolbar|share|sharing|social|"
    r"related|recommended|newsletter|subscribe|signup|login|search|widget|complementary|contentinfo|hidden)(?:$|[\s_-])",
    re.I,
)
# What names say counts as one factor.
NAMED = 0.1
PUNCTUATION = re.compile(r"[.,;:!?…。、，！？；：]")
SPACE = re.compile(r"\s+")


class Block:
    __slots__ = ("path", "parts", "linked", "weight", "element")

    def __init__(self, path: int, weight: float, element: int) -> None:
        self.path, self.parts, self.linked, self.weight, self.element = path, [], 0, weight, element


class Paths:
    """Tag paths as a tree of numbered nodes; a node's number is greater than its parent's. Number 0 is the page."""

    def __init__(self) -> None:
        self.parent, self.tag = [-1], [""]
        self.numbers: dict[tuple[int, str], int] = {}

    def below(self, parent: int, tag: str, names: str) -> int:
        key = (parent, f"{tag}.{names}" if names else tag)
        if key not in self.numbers:
            self.numbers[key] = len(self.parent)
            self.parent.append(parent)
            self.tag.append(tag)
        return self.numbers[key]

    def is_root(self, node: int) -> bool:
        return node == 0 or self.tag[node] in ROOTS

    def container(self, node: int) -> int:
        """The outermost article or main around a node, itself included, or else its parent."""
        found, at = max(0, self.parent[node]), node
        while at > 0:
            if self.tag[at] in INSIDE:
                found = at
            at = self.parent[at]
        return found


def tokens(html: str) -> Iterator[re.Match[str]]:
    """Mark-up and text of a page without what stands in elements of ``ENCLOSED``."""
    at, unclosed, last = 0, set(), html.rfind(">")
    while at < len(html):
        token = (TOKENS if at <= last else LAST_TOKENS).match(html, at)
        at = token.end()
        tag = (token["tag"] or "").lower()
        if tag not in ENCLOSED:
            yield token
        elif not (token["end"] or tag in unclosed or tag in ("svg", "math") and token["rest"].endswith("/")):
            end = ENCLOSED[tag].search(html, at)
            if end:
                at = end.end()
            else:
                # No later one is closed either, so the page is searched once per tag.
                unclosed.add(tag)


def factors(texts: list[tuple[Block, str]], parent: list[int], by_tag: list[bool]) -> list[float]:
    """What the elements that tags or names speak against do to the text in them, by element.

    They do nothing if at least half of what stands in article or main is in them or, on a page without those, at least
    half of the text. Tags are judged first, over all text; names over the text that is left.
    """
    factor = [1.0] * len(parent)
    for tags, against in ((True, 0.0), (False, NAMED)):
        # Characters in all blocks and in those below article or main: of the page, and of each element.
        total, within = [0, 0], [[0, 0] for _ in parent]
        for block, text in texts:
            if block.weight and (block.element < 0 or factor[block.element]):
                for sums in (total, within[block.element]) if block.element >= 0 else (total,):
                    sums[0] += len(text)
                    sums[1] += len(text) * (block.weight > 1)
        for i in range(len(parent) - 1, -1, -1):
            if parent[i] >= 0:
                within[parent[i]][0] += within[i][0]
                within[parent[i]][1] += within[i][1]
        kind = 1 if total[1] else 0
        for i, up in enumerate(parent):
            if by_tag[i] == tags and 2 * within[i][kind] < total[kind]:
                factor[i] = against
            if up >= 0:
                factor[i] = min(factor[i], factor[up])
    return factor


def blocks(html: str, paths: Paths) -> list[tuple[int, float, str, int]]:
    """(path, weight by tags and names, text, linked characters) of every block with text, in page order."""
    found: list[Block] = []
    # Tag, path, weight by tags, innermost element that a tag or a name speaks against.
    stack: list[tuple[str, int, float, int]] = []
    n_open: dict[str, int] = defaultdict(int)
    parent: list[int] = []
    by_tag: list[bool] = []
    links, current = 0, None

    def top() -> tuple[int, float, int]:
        return stack[-1][1:] if stack else (0, 1.0, -1)

    def end(size: int) -> None:
        while len(stack) > size:
            n_open[stack.pop()[0]] -= 1

    def speak_against(element: int, tag: bool) -> int:
        parent.append(element)
        by_tag.append(tag)
        return len(parent) - 1

    for token in tokens(html):
        text = token["text"]
        if text is not None:
            if current is None:
                current = Block(*top())
                found.append(current)
            current.parts.append(text)
            if links:
                current.linked += len(text)
            continue
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "a":
                links = 0 if token["end"] else 1
            elif tag == "br" and current:
                current.parts.append(" ")
            continue
        current, links = None, 0
        if token["end"]:
            if n_open[tag]:
                end(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag))
            continue
        if stack and stack[-1][0] == "p":
            end(len(stack) - 1)
        for closing in ENDED_BY.get(tag, ()):
            if n_open[closing]:
                at = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == closing or stack[i][0] in LISTS)
                if stack[at][0] == closing:
                    end(at)
        if tag in VOID or token["rest"].endswith("/"):
            continue
        names = " ".join(filter(None, (x for m in NAMES.findall(token["rest"]) for x in m))) if "=" in token["rest"] else ""
        path, weight, element = top()
        if tag in OUTSIDE:
            weight = 0.0
        elif tag in INSIDE and weight:
            weight = 4.0
        if tag in OUTSIDE_UNLESS_MOST:
            element = speak_against(element, True)
        if names and tag not in ROOTS and OUTSIDE_NAMES.search(names):
            element = speak_against(element, False)
        stack.append((tag, paths.below(path, tag, names), weight, element))
        n_open[tag] += 1
    texts = [(block, text) for block in found if (text := SPACE.sub(" ", unescape("".join(block.parts))).strip())]
    factor = factors(texts, parent, by_tag)
    return [
        (block.path, block.weight * (factor[block.element] if block.element >= 0 else 1.0), text, min(block.linked, len(text)))
        for block, text in texts
    ]


def ratios(rows: list[tuple[int, float, str, int]], paths: Paths, smoothing: float) -> list[float]:
    """The smoothed tag-path ratio of every node."""
    n = len(paths.parent)
    length, marks, count, linked = ([0] * n for _ in range(4))
    for path, _, text, in_links in rows:
        length[path] += len(text)
        marks[path] += len(PUNCTUATION.findall(text))
        count[path] += 1
        linked[path] += in_links
    for node in range(n - 1, 0, -1):
        for sums in (length, marks, count, linked):
            sums[paths.parent[node]] += sums[node]
    smoothed = [0.0] * n
    for node in range(1, n):
        if count[node] and not paths.is_root(node):
            own = length[node] / count[node] * (0.5 + min(1.0, marks[node] / count[node])) * (1 - linked[node] / length[node])
            smoothed[node] = (1 - smoothing) * own + smoothing * smoothed[paths.parent[node]]
    return smoothed


def main_text(html: str | None, threshold: float = THRESHOLD, smoothing: float = SMOOTHING) -> str:
    """The blocks of a page whose path is content, one per line."""
    paths = Paths()
    rows = blocks(html or "", paths)
    ratio = ratios(rows, paths, smoothing)

    # Text that stands in the body itself has no path of its own: its blocks are judged one by one.
    def score(path: int, weight: float, text: str, in_links: int) -> float:
        if paths.is_root(path):
            return weight * (1 - smoothing) * len(text) * (1 - in_links / len(text))
        return weight * ratio[path]

    scores = [score(*row) for row in rows]
    totals: dict[int, float] = defaultdict(float)
    best: dict[int, float] = {}
    for row, s in zip(rows, scores):
        if s > 0:
            totals[row[0]] += s * len(row[2])
            best[row[0]] = max(best.get(row[0], 0.0), s)
    if not totals:
        return ""
    heaviest = max(totals, key=totals.get)
    bar = threshold * best[heaviest]
    main = paths.container(heaviest)
    # Containers of other paths that are content and carry much of it: further sections of the article.
    others = {paths.container(p) for p, s in best.items() if s > bar and totals[p] >= threshold * totals[heaviest]} - {main}
    in_main, in_other = [node == main for node in range(len(paths.parent))], [False] * len(paths.parent)
    for node in range(1, len(paths.parent)):
        in_main[node] |= in_main[paths.parent[node]]
        in_other[node] = in_other[paths.parent[node]] or node in others and not paths.is_root(node)

    def kept(path: int, weight: float, text: str, in_links: int) -> bool:
        # What tags or names exclude weighs less than 1.
        whole = in_main[path] and not paths.is_root(main)
        return weight >= 1 and (whole or (in_main[path] or in_other[path]) and 2 * in_links <= len(text))

    return "\n".join(row[2] for row, s in zip(rows, scores) if s > bar or kept(*row))


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(page) for page in batch], dtype=object)

    found = pages.select("page_id", "url", texts(F.col(html)).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
