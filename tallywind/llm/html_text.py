"""Main text of web pages by tag-path ratios.

A page is read into text nodes with their root-to-leaf tag paths. Per path, text
length and punctuation are summed and divided by the number of its nodes; both
ratios are smoothed along the page's order of paths, fused, and paths below a
threshold drop out. The element that holds most of what the remaining paths select is
the article, an `article` or `main` if one holds that much; its branches without any
selected text or path drop out, but for headings, and its other blocks are returned whole,
short ones included. Elements that announce themselves as page furniture, by name,
role or class, take no part.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywind.llm.common import ready_for_python, whole_text

#: Fixed element names of HTML.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir",
    "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre",
    "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
FURNITURE = {
    "aside", "audio", "button", "canvas", "datalist", "dialog", "footer", "form", "head", "header", "input",
    "map", "math", "menu", "nav", "object", "select", "svg", "video",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Roles and words of class names and ids that announce furniture.
ROLES = {"alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "menubar", "navigation", "search", "toolbar"}
HINTS = {
    "ad", "ads", "advert", "advertisement", "advertising", "adverts", "banner", "breadcrumb", "breadcrumbs", "comment",
    "comments", "consent", "cookie", "cookies", "disclaimer", "discussion", "disqus", "footer", "form", "header", "login", "masthead",
    "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notification", "pagination", "popup",
    "promo", "promoted", "promotion", "related", "replies", "reply", "respond", "search", "share", "sharing", "sidebar", "signup",
    "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
COMMENTS = {"comment", "comments", "reply", "replies"}
LAYOUT = {"closed", "has", "hide", "is", "no", "not", "open", "single", "with", "without"}
#: An opening tag of one of these ends an open one of the others.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
    "tfoot": {"thead", "tbody", "tr", "td", "th"},
}
#: ... but not across one of these.
FENCES = {"table", "ul", "ol", "dl", "select", "article", "section", "div", "body"}

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
ATTRIBUTE = re.compile(r"""(?<![^\s"'])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*+"|'[^']*+'|[^\s>]++))?""", re.I)
WORDS = re.compile(r"[a-z]+")
PUNCTUATION = re.compile(r"[.,;:!?…、。，！？؟،]")


@dataclass(frozen=True)
class Options:
    #: Weight of a neighbouring path when ratios are smoothed.
    neighbour: float = 0.25
    #: Paths with less than this part of the mean fused ratio, by text, drop out.
    threshold: float = 0.5
    #: The article is the innermost element with this part of the selected text.
    held: float = 0.8


OPTIONS = Options()

#: Deeper elements have the path of their ancestor at this depth: the paths of n nested
#: tags would otherwise take n * n characters. Nothing else about them differs.
DEEPEST_PATH = 200


class Element:
    __slots__ = ("tag", "parent", "furniture", "path", "depth", "selected")

    def __init__(self, tag: str, parent: Element | None, furniture: bool):
        self.tag, self.parent, self.furniture = tag, parent, furniture
        self.depth = parent.depth + 1 if parent else 0
        if self.depth > DEEPEST_PATH:
            self.path = parent.path
        else:
            self.path = f"{parent.path}>{tag}" if parent else tag
        self.selected = 0


def _announces(tag: str, attributes: str) -> bool:
    """Whether an element is furniture by name, role, class, id, or hidden."""
    if tag in FURNITURE:
        return True
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
        if name == "role" and value.lower() in ROLES:
            return True
        if name in ("class", "id") and _hinted(tag, value):
            return True
    return False


def _hinted(tag: str, names: str) -> bool:
    """Whether one of an element's names announces furniture. Names that speak of the
    page's layout (`has-sidebar`, `comments-open`) do not, and what is called an
    article is furniture only as a comment."""
    for name in re.sub(r"([a-z])([A-Z])", r"\1-\2", names).lower().split():
        words = WORDS.findall(name)
        if not words or words[0] in LAYOUT or words[-1] in LAYOUT:
            continue
        if tag in ("html", "body", "article", "main"):
            if words[0] in COMMENTS:
                return True
        elif not HINTS.isdisjoint(words):
            return True
    return False


def text_nodes(page: str, named: bool = True) -> Iterator[tuple[int, Element, str]]:
    """`block number, element, text` of each text node outside of furniture, in page
    order. Tags may be left open or closed twice; what is no tag is text. Without
    `named`, only the names of elements tell what is furniture."""
    root = Element("", None, False)
    stack = [root]
    opened: dict[str, int] = {}  # open elements by name

    def close(k: int) -> None:
        for element in stack[k:]:
            opened[element.tag] -= 1
        del stack[k:]

    block, at, size = 0, 0, len(page)
    while at < size:
        less = page.find("<", at)
        end = size if less < 0 else less
        if end > at and not stack[-1].furniture:
            yield block, stack[-1], page[at:end]
        if less < 0:
            return
        if page.startswith("<!--", less):
            ended = page.find("-->", less + 4)
            at = size if ended < 0 else ended + 3
            continue
        follow = page[less + 1 : less + 2]
        if follow in ("!", "?"):
            ended = page.find(">", less)
            at = size if ended < 0 else ended + 1
            continue
        found = TAG.match(page, less) or LOOSE.match(page, less)
        if not found:
            if re.match(r"</?[a-zA-Z]", page[less : less + 3]):
                return  # a tag that the end of the page cuts off
            if not stack[-1].furniture:
                yield block, stack[-1], "<"
            at = less + 1
            continue
        at = found.end()
        closing, tag, attributes = found[1], found[2].lower(), found[3]
        if tag in BLOCKS:
            block += 1
        if closing:
            for k in range(len(stack) - 1, 0, -1) if opened.get(tag) else ():
                if stack[k].tag == tag:
                    close(k)
                    break
                if tag not in BLOCKS and stack[k].tag in BLOCKS:
                    break  # an inline end tag closes nothing outside of its block
            continue
        if tag in RAW:
            if attributes.endswith("/"):
                continue
            ended = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(page, at)
            if ended is None:
                return
            stop = page.find(">", ended.end())
            at = size if stop < 0 else stop + 1
            continue
        if tag in VOID:
            if tag == "br" and not stack[-1].furniture:
                yield block, stack[-1], " "
            continue
        ends = ENDS.get(tag, set()) | ({"p"} if tag in BLOCKS else set())
        for k in range(len(stack) - 1, 0, -1) if any(map(opened.get, ends)) else ():
            open_tag = stack[k].tag
            if open_tag in ends:
                close(k)
            elif open_tag in FENCES:
                break
        parent = stack[-1]
        furniture = parent.furniture or _announces(tag, attributes if named else "")
        if furniture and not parent.furniture and tag == "header":
            # the heading of an article may stand in the article's own header
            furniture = not (opened.get("article") or opened.get("main"))
        elif not furniture and parent.tag == "header":
            furniture = tag not in HEADINGS and tag not in ("hgroup", "div")
        stack.append(Element(tag, parent, furniture))
        opened[tag] = opened.get(tag, 0) + 1


def _blocks(page: str, named: bool = True) -> list[tuple[Element, list[tuple[Element, str]]]]:
    """The page's blocks: the element a block stands in, and its nodes. Blocks of
    white space alone are none."""
    found: list[tuple[Element, list[tuple[Element, str]]]] = []
    last = None
    for block, element, text in text_nodes(page, named):
        if block != last:
            holder = element
            while holder.parent and holder.tag not in BLOCKS:
                holder = holder.parent
            found.append((holder, []))
            last = block
        found[-1][1].append((element, html.unescape(text)))
    return [
        b
        for b in found
        if any(text.strip() for _, text in b[1]) and not (b[0].tag == "header")
    ]


def path_scores(blocks, options: Options) -> dict[str, float]:
    """The fused ratio of each tag path: smoothed text length per node times
    smoothed punctuation per node, as their geometric mean."""
    sums: dict[str, list[int]] = {}
    for _, nodes in blocks:
        for element, text in nodes:
            if text.strip():
                total = sums.setdefault(element.path, [0, 0, 0])
                total[0] += len(text)
                total[1] += len(PUNCTUATION.findall(text))
                total[2] += 1
    paths = list(sums)
    length = [sums[p][0] / sums[p][2] for p in paths]
    marks = [sums[p][1] / sums[p][2] for p in paths]

    def smooth(values: list[float]) -> list[float]:
        w = options.neighbour
        edge = [values[0], *values, values[-1]]
        return [w * edge[k] + (1 - 2 * w) * edge[k + 1] + w * edge[k + 2] for k in range(len(values))]

    if not paths:
        return {}
    # one mark is granted to all, so that text without punctuation still has a ratio
    return {
        p: ((a + 1) * (b + 1)) ** 0.5
        for p, a, b in zip(paths, smooth(length), smooth(marks), strict=True)
    }


def main_text(page: str, options: Options = OPTIONS) -> str:
    """The article of one page, blocks joined by an empty line; empty if none."""
    # a page whose every part is named like furniture is judged by its elements
    blocks = _blocks(page) or _blocks(page, named=False)
    scores = path_scores(blocks, options)
    if not scores:
        return ""
    sized = [(scores[e.path], len(t)) for _, nodes in blocks for e, t in nodes if t.strip()]
    mean = sum(s * n for s, n in sized) / sum(n for _, n in sized)
    least = options.threshold * mean
    total = 0
    selected = set()
    elements: dict[Element, None] = {}  # all that hold a block, in page order
    for holder, nodes in blocks:
        chosen = sum(len(t) for e, t in nodes if t.strip() and scores[e.path] >= least)
        if chosen:
            selected.add(holder.path)
            total += chosen
        nodes[0][0].selected += chosen
        for first in (holder, nodes[0][0]):
            element = first
            while element and element not in elements:
                elements[element] = None
                element = element.parent
    # what an element has selected counts in all around it, the deepest ones first
    for element in sorted(elements, key=lambda e: -e.depth):
        if element.parent:
            element.parent.selected += element.selected

    def ancestors(element):
        while element:
            yield element
            element = element.parent

    core, held, seen = None, options.held * total, set()
    for holder, _ in blocks:
        for e in ancestors(holder):
            if e in seen:
                break
            seen.add(e)
            if e.selected >= held and (core is None or e.depth > core.depth):
                core = e
    if core.tag in ("p", *HEADINGS, "li", "td", "blockquote"):
        core = core.parent
    # whatever holds the core holds most of the selected text, too
    article = next((e for e in ancestors(core) if e.tag in ("article", "main")), core)
    # per element whether the article holds it, and by which branch off the spine
    placed: dict[Element | None, tuple[bool, Element | None]] = {None: (False, None)}
    for e in ancestors(core):
        placed[e] = (True, None)
        if e is article:
            break
    branches = []
    for holder, _ in blocks:
        way, above = [], holder
        while above not in placed:
            way.append(above)
            above = above.parent
        inside, branch = placed[above]
        for e in reversed(way):
            branch = branch or e
            placed[e] = (inside, branch)
        branches.append((inside, branch))
    plain = {b for (_, b), (h, _) in zip(branches, blocks, strict=True) if b and h.tag not in HEADINGS}
    kept = []
    for k, (inside, branch) in enumerate(branches):
        if not inside:
            continue
        # only parts that hold selected text are the article, blocks on the same path as
        # a selected one (a short `p` whose words stand in a `b`), and headings
        titled = blocks[k][0].tag in HEADINGS and (branch not in plain or branch.tag in ("header", "hgroup"))
        if branch is None or branch.selected or blocks[k][0].path in selected or titled:
            kept.append(k)
    joined = (" ".join("".join(t for _, t in blocks[k][1]).split()) for k in kept)
    return "\n\n".join(b for b in joined if b)


def extract(
    pages: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    page: str = "html",
    options: Options = OPTIONS,
) -> DataFrame:
    """`page_id, url, text, n_chars` for every row of the pages.

    A null page is an empty one and has an empty text. Pages are taken whole, one at
    a time; repeated rows are extracted alike; an empty table gives no rows. Ties of
    the container's depth fall to the one that comes first on the page.
    """

    ready_for_python(pages)

    @F.pandas_udf("string")
    def texts(batch: pd.Series) -> pd.Series:
        return pd.Series([main_text(p, options) for p in batch], dtype=object)

    return pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).alias("url"),
        texts(whole_text(page)).alias("text"),
    ).withColumn("n_chars", F.length("text").cast("long"))
