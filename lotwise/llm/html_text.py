"""Main text of pages by composite text density.

A page becomes a tree of its elements. Every node has the characters and tags below it
(markup of single words aside) and how many of them are links; its density is characters per tag, lowered by a log of
the share of links. A node's density sum adds its children's densities, and the node of
the largest sum holds the main text; if it lies in an article, the whole outermost
article does. The smallest density on the path from it up to the body is the threshold:
every other subtree outside that path, a lone paragraph too, is main text where its
density reaches the threshold, and so is a heading beside the main text below one parent
(the body aside).

What cannot be main text is left out before: scripts, styles, forms, menus, headers,
footers, asides, and elements whose class, id or role names an advert, a notice, reader
comments and the like. A name counts as a whole: all its parts are such words, or words
for a box around them.

Edge cases: null or empty html gives an empty text; broken markup is read as browsers do
in the main cases (paragraphs and list items end by themselves, a lone end tag is
dropped, what is open at the end closes); of equal sums the outermost, first node is
taken; depth and length are not limited, and no step is recursive.
"""

from __future__ import annotations

import html as references
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

SCHEMA = "page_id long, url string, text string, n_chars long"

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)",
    re.S,
)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
PART = re.compile(r"[^A-Za-z0-9]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark "
    "q ruby rt rp s samp small span strike strong sub sup time tt u var wbr".split()
)
LEFT_OUT = frozenset(
    "head nav footer aside form button select input textarea dialog menu "
    "script style title noscript iframe template svg math object canvas audio video".split()
)
# A new one of these ends an open one of the set beside it.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
    "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
}
HOLDERS = frozenset("article aside body div dl html main ol section table td th ul".split())
NAMES_LEFT_OUT = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment "
    "comments complementary consent contentinfo cookie cookies disqus footer login menu modal "
    "nav navbar navigation newsletter notice notices alert popup promo promoted related replies "
    "respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar "
    "widget".split()
)

BOXES = frozenset(
    "area bar block bottom box button buttons container content form global group inner item "
    "left list main outer page panel right section site slot top unit wrap wrapper".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


class Tree:
    """Elements in document order; ``last`` is the last element below each."""

    def __init__(self, page: str):
        self.parent, self.tag, self.out = [-1], ["#root"], [False]
        self.events: list[tuple[int, str | None]] = []  # element, text or None for a break
        stack, at, size = [0], 0, len(page)
        while at < size:
            found = TAG.search(page, at)
            end = found.start() if found else size
            if end > at:
                self.events.append((stack[-1], page[at:end]))
            if not found:
                break
            at = found.end()
            name = found[2] and found[2].lower()
            if not name:
                continue
            if found[1]:
                self.close(stack, name)
                continue
            self.open(stack, name, found[3] or "")
            if name in RAW:
                close = re.compile(rf"</{name}\s*(?:>|\Z)", re.I).search(page, at)
                at = close.end() if close else size
                stack.pop()
            elif name in VOID or (found[3] or "").endswith("/") and name not in HOLDERS:
                stack.pop()
        self.last = list(range(len(self.tag)))
        for i in range(len(self.tag) - 1, 0, -1):
            self.last[self.parent[i]] = max(self.last[self.parent[i]], self.last[i])

    def open(self, stack: list[int], name: str, attributes: str) -> None:
        if name not in INLINE:
            for k in range(len(stack) - 1, 0, -1):
                own = self.tag[stack[k]]
                if own == "p" or own in ENDS.get(name, ()):
                    del stack[k:]
                    if own == "p" and name in ENDS:
                        continue
                    break
                if own not in INLINE:
                    break
            self.events.append((stack[-1], None))
        elif name == "br":
            self.events.append((stack[-1], " "))
        above = stack[-1]
        self.parent.append(above)
        self.tag.append(name)
        self.out.append(self.out[above] or self.unwanted(stack, name, attributes))
        stack.append(len(self.tag) - 1)
        if name not in INLINE:
            self.events.append((stack[-1], None))

    def unwanted(self, stack: list[int], name: str, attributes: str) -> bool:
        if name in LEFT_OUT:
            return True
        if name == "header":  # a heading inside the article belongs to it
            return not any(self.tag[i] in ("article", "main") for i in stack)
        if name in ("html", "body", "article", "main") or not attributes:
            return False
        for groups in NAMED.findall(attributes):
            for whole in "".join(groups).lower().split():
                parts = set(PART.split(whole))
                if not parts.isdisjoint(NAMES_LEFT_OUT) and all(
                    x in NAMES_LEFT_OUT or x in BOXES or not x or x.isdigit() for x in parts
                ):
                    return True
        return False

    def close(self, stack: list[int], name: str) -> None:
        for k in range(len(stack) - 1, 0, -1):
            own = self.tag[stack[k]]
            if own == name:
                del stack[k:]
                break
            if name in INLINE and own not in INLINE or own in ("article", "main", "table") and (
                name not in HOLDERS
            ):
                return
        else:
            return
        if name not in INLINE:
            self.events.append((stack[-1], None))


def counted(tag: str) -> bool:
    """Bold words and line breaks are part of a text; links and blocks are tags."""
    return tag not in INLINE or tag == "a"


def densities(tree: Tree, chars: list[int]) -> tuple[list[float], list[float]]:
    """Density and density sum of every element."""
    n = len(tree.tag)
    total, tags, link_chars, link_tags = chars[:], [0] * n, [0] * n, [0] * n
    for i in range(n - 1, 0, -1):
        above = tree.parent[i]
        if tree.out[i]:
            continue
        link = tree.tag[i] == "a"
        total[above] += total[i]
        tags[above] += tags[i] + counted(tree.tag[i])
        link_chars[above] += total[i] if link else link_chars[i]
        link_tags[above] += link_tags[i] + link
    share = link_chars[0] / max(total[0], 1)
    density, sums = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        if not tree.out[i] and total[i]:
            c, t = total[i], max(tags[i], 1)
            lc, lt = max(link_chars[i], 1), max(link_tags[i], 1)
            rest = max(c - link_chars[i], 1)
            base = math.log(c / rest * link_chars[i] + share * c + math.e)
            density[i] = c / t * math.log(max(c / lc * t / lt, 1.0)) / max(math.log(base), 0.1)
        if i and not tree.out[i] and counted(tree.tag[i]):
            sums[tree.parent[i]] += density[i]
    return density, sums


def main_nodes(tree: Tree, chars: list[int]) -> list[int]:
    """The elements whose whole text is main text, in order, none below another."""
    density, sums = densities(tree, chars)
    body = next((i for i, t in enumerate(tree.tag) if t == "body"), 0)
    inside = range(body, tree.last[body] + 1)
    best = max(inside, key=lambda i: (sums[i], -i))
    i = best
    while i > body:
        if tree.tag[i] == "article":
            best = i
        i = tree.parent[i]
    path, i = set(), best
    while i != -1:
        path.add(i)
        i = tree.parent[i] if i != body else -1
    threshold = min(density[i] for i in path)
    out, headings, i = [], [], body
    while i <= tree.last[body]:
        if i == best or i not in path and not tree.out[i] and density[i] >= threshold > 0 and counted(tree.tag[i]):
            out.append(i)
        elif i in path or not tree.out[i]:
            if tree.tag[i] in HEADINGS and density[i] and i not in path:
                headings.append(i)
            i += 1
            continue
        i = tree.last[i] + 1
    # headings beside what stays
    holders = {tree.parent[i] for i in out} | path - {best}
    out += [i for i in headings if tree.parent[i] in holders and tree.parent[i] != body]
    return sorted(out)


def main_text(page: str | None) -> str:
    if not page:
        return ""
    tree = Tree(page)
    chars, texts = [0] * len(tree.tag), []
    for node, text in tree.events:
        if text is not None and "&" in text:
            text = references.unescape(text)
        texts.append((node, text))
        if text is not None and not tree.out[node]:
            chars[node] += len("".join(text.split()))
    blocks: list[str] = []
    block: list[str] = []
    nodes = iter(main_nodes(tree, chars))
    node = next(nodes, None)
    for where, text in texts:
        while node is not None and where > tree.last[node]:
            node = next(nodes, None)
            texts_end = "".join(block)
            blocks.append(texts_end)
            block = []
        if node is None:
            break
        if where < node or tree.out[where]:
            if text is None:
                blocks.append("".join(block))
                block = []
            continue
        if text is None:
            blocks.append("".join(block))
            block = []
        else:
            block.append(text)
    blocks.append("".join(block))
    return " ".join(x for x in (" ".join(b.split()) for b in blocks) if x)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    batch.column(1).cast(pa.string()),
                    pa.array(texts, pa.string()),
                    pa.array([len(x) for x in texts], pa.int64()),
                ],
                names=[c.split()[0] for c in SCHEMA.split(", ")],
            )

    return pages.select("page_id", "url", "html").mapInArrow(run, SCHEMA)
