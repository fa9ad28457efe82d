"""Main text of web pages by composite text density."""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import StringType

from shelfcast.llm.common import table

MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s\"'=<>/]++)\s*+(?:=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?+")
TOKENS = re.compile(r"[a-z]+")

#: Elements whose content is text of its own kind, up to their end tag.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "noembed", "noframes", "template", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Never part of an article.
DROPPED = RAW | {
    "annotation", "annotation-xml", "aside", "audio", "button", "canvas", "datalist", "dialog", "footer", "head", "label",
    "legend", "map", "menu", "nav", "object", "select", "svg", "video",
}
#: Of these, what stands on lines of its own; a formula's source, an icon or a button is left out of its line.
BREAKS = {"aside", "dialog", "footer", "head", "legend", "menu", "nav"}
BLOCK = {
    "address", "article", "blockquote", "body", "caption", "center", "dd", "details", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li", "main", "ol", "p",
    "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
#: An opening tag ends these open elements, if they are open inside the nearest of the elements named last.
ENDS = {
    "li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}),
}
ROLES = {"alert", "alertdialog", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "menubar",
         "navigation", "search"}
#: Words in class or id that mark what surrounds an article.
LABELS = {
    "ad", "ads", "adsense", "advert", "advertisement", "advertising", "adverts", "banner", "breadcrumb", "breadcrumbs",
    "comment", "comments", "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "login", "masthead", "menu",
    "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "overlay", "pager", "pagination", "popup",
    "promo", "recommended", "related", "replies", "respond", "share", "sharing", "sidebar", "signup", "social",
    "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
#: Of these, words that also name parts of an article: alone or beside other words they mark only what is mostly links.
ORDINARY = {
    "ad", "banner", "notice", "notices", "overlay", "recommended", "related", "respond", "share", "sharing", "social",
}
#: An id is often the anchor of a section. Inside an article only these mark surroundings, as the whole id.
OWN_ID = {
    "adsense", "breadcrumb", "breadcrumbs", "comments", "disqus", "masthead", "nav", "navbar", "pager", "pagination",
    "sidebar", "toolbar",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Elements that hold text; a label drops them only as a whole class.
TEXTUAL = HEADINGS | {
    "a", "abbr", "b", "blockquote", "caption", "cite", "code", "dd", "dfn", "dt", "em", "figcaption", "i", "li", "mark", "p", "pre",
    "q", "s", "small", "span", "strong", "sub", "summary", "sup", "td", "th", "tr", "u",
}
MOST = 0.5  # share of the page's characters from which a form is not a form but what holds the page
LINKED = 0.5  # share of linked characters from which a doubtful element is surroundings
ARTICLES = {"article", "main"}
FRAME = {"html", "body"} | ARTICLES
#: Words that mark an article element as a comment or a teaser instead.
NO_ARTICLE = {"ad", "advert", "comment", "promo", "recommended", "related", "replies", "reply", "sponsored", "teaser"}


def _marked(tag: str, name: str, value: str, inside_article: bool) -> float:
    """How far a class or id marks an element as surroundings: 1 surely, 0.5 if it is mostly links, 0 not."""
    names = [TOKENS.findall(n) for n in value.lower().split()]
    words = {w for n in names for w in n}
    if tag in ARTICLES:
        return float(bool(words & NO_ARTICLE))
    if not inside_article and "header" in words and tag not in TEXTUAL:
        return 1.0
    if not words & LABELS:
        return 0.0
    whole = {n[0] for n in names if len(n) == 1}
    if tag in TEXTUAL:
        sure = name == "class" and whole & (LABELS - ORDINARY | {"ad"})
        return 1.0 if sure else 0.0 if tag in HEADINGS else 0.5
    several = any(len(n) > 1 and LABELS.issuperset(n) for n in names)
    if name == "id":
        sure = whole & OWN_ID if inside_article else several or whole & LABELS
    else:
        sure = several or whole & (LABELS - {"notice", "notices"}) or words & (LABELS - ORDINARY)
        sure = sure or not inside_article and words & LABELS - {"notice", "notices"}
    return 1.0 if sure else 0.5


def _dropped(tag: str, attributes: str, inside_article: bool) -> float:
    """1 if an element is surely not part of the article, 0.5 if only its links can tell, 0 if nothing marks it."""
    if tag in DROPPED or tag == "header" and not inside_article:
        return 1.0
    if tag in ("html", "body") or "=" not in attributes:
        return 0.0
    most = 0.0
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "role":
            if set(TOKENS.findall(value.lower())) & ROLES and tag not in ARTICLES:
                return 1.0
        elif name in ("class", "id"):
            most = max(most, _marked(tag, name, value, inside_article))
    return most


class Tree:
    """The elements of a page in page order, without the dropped ones: parents before children, blocks of text with the
    element that directly holds their text."""

    def __init__(self, page: str) -> None:
        self.tag, self.parent = ["html"], [-1]
        self.chars, self.linked = [0], [0]  # of the text directly inside, and of that inside links
        self.links, self.articles = [0], [0]  # open links and articles, at each element
        self.blocks: list[list[tuple[int, str]]] = [[]]
        self.doubtful: list[int] = []  # elements that a label marks as surroundings if they are mostly links
        self.forms: list[int] = []
        self._read(page)
        self.gone = [False] * len(self.tag)
        if self.doubtful or self.forms:
            self._drop_doubtful()

    def _drop_doubtful(self) -> None:
        """What is mostly links goes, and forms, unless one is only wrapped around an article or most of the page."""
        chars, linked = list(self.chars), list(self.linked)
        articles = [tag in ARTICLES for tag in self.tag]
        for i in range(len(self.tag) - 1, 0, -1):
            chars[self.parent[i]] += chars[i]
            linked[self.parent[i]] += linked[i]
            articles[self.parent[i]] |= articles[i]
        for i in self.doubtful:
            self.gone[i] = linked[i] > 0 and linked[i] >= LINKED * chars[i]
        for i in self.forms:
            self.gone[i] = not articles[i] and chars[i] < MOST * chars[0]
        for i in range(1, len(self.tag)):
            if self.gone[self.parent[i]]:
                self.gone[i] = True
            if self.gone[i]:
                self.chars[i] = self.linked[i] = 0

    def _text(self, at: int, raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        self.blocks[-1].append((at, text))
        n = len("".join(text.split()))
        self.chars[at] += n
        if self.links[at]:
            self.linked[at] += n

    def _break(self) -> None:
        if self.blocks[-1]:
            self.blocks.append([])

    def _read(self, page: str) -> None:
        stack, at = [0], 0
        skipped: list[str] = []  # open elements inside a dropped one, itself first
        while True:
            found = MARKUP.search(page, at)
            if not skipped:
                raw = page[at : found.start()] if found else page[at:]
                if raw:
                    self._text(stack[-1], raw)
            if not found:
                return
            at = found.end()
            closing, tag, attributes = found[1], (found[2] or "").lower(), found[3] or ""
            if not tag:
                continue
            if not closing and tag in RAW:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
                if tag != "title":
                    continue
            elif skipped:
                if closing:
                    if tag in skipped:
                        while skipped.pop() != tag:
                            pass
                    elif tag in FRAME and any(self.tag[i] == tag for i in stack):
                        skipped.clear()  # an element that was never closed ends with what holds it
                        at = found.start()
                elif tag in ARTICLES and skipped[0] in ("nav", "header") or tag == "body":
                    skipped.clear()
                    at = found.start()
                elif tag not in VOID and not attributes.endswith("/"):
                    if tag == "p" and skipped[-1] == "p" or tag == "li" and skipped[-1] == "li":
                        continue
                    skipped.append(tag)
            elif closing:
                for i in range(len(stack) - 1, 0, -1):
                    name = self.tag[stack[i]]
                    if name == tag:
                        del stack[i:]
                        break
                    if tag not in BLOCK and name in BLOCK:
                        break
                if tag in BLOCK:
                    self._break()
            elif tag in VOID:
                if tag == "br":
                    self._text(stack[-1], " ")
                elif tag == "hr":
                    self._break()
            elif tag in ("html", "body") and any(self.tag[i] == tag for i in stack):
                continue
            else:
                self._open(stack, tag)
                if tag in BLOCK:
                    self._break()
                dropped = _dropped(tag, attributes, self.articles[stack[-1]] > 0)
                if dropped == 1:
                    if tag in BREAKS:
                        self._break()
                    if not attributes.endswith("/"):
                        skipped.append(tag)
                    continue
                if dropped:
                    self.doubtful.append(len(self.tag))
                if tag == "form":
                    self.forms.append(len(self.tag))
                self.tag.append(tag)
                self.parent.append(stack[-1])
                self.chars.append(0)
                self.linked.append(0)
                self.links.append(self.links[stack[-1]] + (tag == "a"))
                self.articles.append(self.articles[stack[-1]] + (tag in ARTICLES))
                if not attributes.endswith("/") or tag in BLOCK:
                    stack.append(len(self.tag) - 1)

    def _open(self, stack: list[int], tag: str) -> None:
        """Close what an opening tag implies: paragraphs by blocks, items and cells by their like, links by links."""
        ended, fence = ENDS.get(tag, (set(), set()))
        if tag in BLOCK:
            ended, fence = ended | {"p"}, fence | (BLOCK - ended - {"p"})
        if tag == "a":
            ended, fence = {"a"}, BLOCK
        if not ended:
            return
        for i in range(len(stack) - 1, 0, -1):
            name = self.tag[stack[i]]
            if name in ended:
                del stack[i:]
                if tag in ("p", "a") or name == "p" and tag not in ENDS:
                    return
            elif name in fence:
                return


def densities(tree: Tree) -> tuple[list[float], list[float]]:
    """Composite text density of every element, and the sum of its children's.

    With C, LC the characters and linked characters below an element, T, LT its tags and link tags, and b the body:
    C/T * ln(C/LC * T/LT) / ln(ln(C/(C-LC) * LC + LCb/Cb * C + e)), where a zero count in a denominator is 1. Without any
    link on the page this is C/T.
    """
    n = len(tree.tag)
    chars, linked = list(tree.chars), list(tree.linked)
    tags = [int(not gone) for gone in tree.gone]
    links = [int(t == "a" and not gone) for t, gone in zip(tree.tag, tree.gone)]
    for i in range(n - 1, 0, -1):
        p = tree.parent[i]
        chars[p] += chars[i]
        linked[p] += linked[i]
        tags[p] += tags[i]
        links[p] += links[i]
    share = linked[0] / max(chars[0], 1)
    density = []
    for c, lc, t, lt in zip(chars, linked, tags, links):
        value = c / max(t, 1)
        if c and linked[0]:
            base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
            value *= max(0.0, math.log(max(c / max(lc, 1) * t / max(lt, 1), 1.0))) / max(math.log(base), 1e-9)
        density.append(value)
    sums = [0.0] * n
    for i in range(1, n):
        sums[tree.parent[i]] += density[i]
    return density, sums


def content_roots(tree: Tree) -> set[int]:
    """The subtrees that hold the article.

    The element with the largest density sum is the core. The smallest density on its path to the body is the threshold:
    in every branch that reaches it, the subtree with the largest sum belongs to the article too. A core inside an article
    or main element stands for that whole outermost element; besides it, other article and main elements that reach the
    threshold belong to the article, whole.
    """
    density, sums = densities(tree)
    n = len(tree.tag)
    best = list(range(n))  # the largest sum in the subtree, the first one of equals
    for i in range(n - 1, 0, -1):
        p = tree.parent[i]
        if sums[best[i]] >= sums[best[p]] and best[p] != p or sums[best[i]] > sums[best[p]]:
            best[p] = best[i]
    core = best[0]
    path = [core]
    while tree.parent[path[-1]] >= 0:
        path.append(tree.parent[path[-1]])
    outer = [i for i in path if tree.tag[i] in ARTICLES]
    threshold = min(density[i] for i in path)
    if outer:
        others = (i for i in range(1, n) if tree.tag[i] in ARTICLES and not tree.articles[tree.parent[i]])
        return {outer[-1]} | {i for i in others if density[i] >= threshold and density[i] > 0}
    return {core} | {best[i] for i in range(1, n) if density[i] >= threshold and density[i] > 0}


def main_text(page: str | None) -> str:
    """The article of a page; blocks joined by line breaks, white space inside a block as one space."""
    if not page:
        return ""
    tree = Tree(page)
    roots = content_roots(tree)
    inside = [0 in roots]
    for i in range(1, len(tree.tag)):
        inside.append((i in roots or inside[tree.parent[i]]) and not tree.gone[i])
    lines = (" ".join("".join(text for at, text in block if inside[at]).split()) for block in tree.blocks)
    return "\n".join(line for line in lines if line)


@arrow_udf(StringType())
def _main_text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for pages in batches:
        yield pa.array([main_text(p.as_py()) for p in pages], pa.string())


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """``pages`` with ``text`` (the main text of the whole ``html``, empty if there is none) and ``n_chars`` (its code
    points); input columns of these two names are replaced, others pass through.

    Null and empty pages have empty text. Rows are independent: no shuffle, repeated rows get equal results, an empty table
    gives no rows. Broken markup is read as far as it goes; time and memory grow with the length of a page.
    """
    return pages.withColumn("text", _main_text(F.col(column).cast("string"))).withColumn(
        "n_chars", F.length("text").cast("long")
    )


def op5_html(spark: SparkSession, root: str) -> DataFrame:
    return extract(table(spark, root, "pages")).select("page_id", "url", "text", "n_chars")
