"""Main text of web pages by consensus of their hosts.

Each page's containers are scored by the running text below them.  A container's generalised path is its
chain of tags and classes with digits folded, so pages made from one template share it.  Spark sums
the pages' scores by host and path; each page is then read again with its host's paths from the most to
the least voted, and falls back to its own best container where it has none of them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopflow.llm.common import col, free_name, materialise

# fixed values: HTML elements by their role
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style noscript template iframe object svg math canvas head title audio video map "
                   "select textarea button datalist frameset noframes noembed".split())
BOILERPLATE = frozenset("nav footer aside form header menu dialog".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li listing main menu "
                   "nav ol optgroup option p plaintext pre search section summary table tbody td tfoot th thead tr ul "
                   "xmp".split())
CONTAINERS = frozenset("article main section div td body center".split())
HEAD = frozenset("title meta link script style base basefont noscript template head".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SCOPES = frozenset("table td th caption html template".split())
#: a start tag of the key closes an open element of the value, up to one of SCOPES or a list
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr", "td", "th"),
          "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tbody", "thead", "tr", "td", "th"),
          "tfoot": ("tbody", "thead", "tr", "td", "th")}
LISTS = {"li": frozenset(("ul", "ol", "menu")), "dt": frozenset(("dl",)), "dd": frozenset(("dl",))}
TABLES = frozenset(("table",))
#: words of classes, ids and roles that mark what is beside the text
BESIDE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu "
    "sidebar sidenav footer masthead cookie cookies consent gdpr notice notices notification alert banner comment "
    "comments disqus respond reply replies share sharing social related recommended recommendations newsletter "
    "subscribe signup login popup modal overlay breadcrumb breadcrumbs pagination pager toolbar widget widgets "
    "complementary contentinfo search skip".split())
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_DIGITS = re.compile(r"\d+")


class Element:
    __slots__ = ("tag", "path", "beside", "hidden", "children")

    def __init__(self, tag: str, path: str, beside: bool, hidden: bool):
        self.tag, self.path, self.beside, self.hidden = tag, path, beside, hidden
        self.children: list[Element | str] = []


def _beside(tag: str, attrs: dict[str, str | None]) -> bool:
    if tag in BOILERPLATE:
        return True
    if tag in ("html", "body", "main"):
        return False
    for name in ("class", "id", "role"):
        for token in (attrs.get(name) or "").split():
            words = [w.lower() for w in _WORD.findall(token)]
            # "has-sidebar", "no-ads" tell about something else
            if words and words[0] not in ("has", "with", "no", "without") and BESIDE.intersection(words):
                return True
    return False


def _step(parent: str, tag: str, attrs: dict[str, str | None]) -> str:
    """A generalised path: tags, sorted classes and container ids, digits folded; long ones by their hash."""
    classes = {_DIGITS.sub("#", c.lower()) for c in (attrs.get("class") or "").split()}
    name = "".join([tag, *("." + c for c in sorted(classes))])
    if attrs.get("id") and tag in CONTAINERS:
        name += "@" + _DIGITS.sub("#", attrs["id"].strip().lower())
    path = f"{parent}>{name}" if parent else name
    return path if len(path) <= 400 else "#" + hashlib.sha256(path.encode("utf-8", "replace")).hexdigest()


class Tree(HTMLParser):
    """Elements and texts of a page, closed as browsers close them where end tags are missing."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("", "", False, False)
        self.open = [self.root]
        self.article = False

    def _find(self, tags: tuple[str, ...], stop: frozenset[str], outermost: bool = False) -> int:
        found = -1
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                found = i
                if not outermost:
                    break
            elif self.open[i].tag in stop:
                break
        return found

    def _close(self, index: int) -> None:
        if index > 0:
            del self.open[index:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.open[-1].tag == "head" and tag not in HEAD:
            self.open.pop()
        if tag in BLOCKS:
            self._close(self._find(("p",), SCOPES))  # a block ends a paragraph
        if tag in CLOSES:
            self._close(self._find(CLOSES[tag], LISTS.get(tag, TABLES), outermost=True))
        elif tag in HEADINGS and self.open[-1].tag in HEADINGS:
            self.open.pop()
        own = dict(attrs)
        beside = _beside(tag, own)
        if tag == "main" or tag == "article" and not beside and not self.article:
            self.article = True
            for outer in self.open:  # a form or a badly named division around the whole page
                outer.beside = outer.beside and outer.tag in ("nav", "footer", "aside", "header")
        style = (own.get("style") or "").replace(" ", "").lower()
        hidden = tag in UNSEEN or "hidden" in own or "display:none" in style or own.get("aria-hidden") == "true"
        element = Element(tag, _step(self.open[-1].path, tag, own), beside, hidden)
        self.open[-1].children.append(element)
        if tag not in VOID:
            self.open.append(element)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # "<div/>" opens a div in HTML

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.handle_starttag(tag, [])
        if tag in VOID or tag in ("html", "body"):
            return  # what follows the body still belongs to it
        i = self._find((tag,), SCOPES - {tag})
        if i < 0 and tag == "p":
            self.open[-1].children.append(Element("p", "", False, False))
        elif tag in BLOCKS or not any(e.tag in BLOCKS for e in self.open[i:]):
            self._close(i)

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        return self.parse_bogus_comment(i)


def parse(html: str | None) -> Element:
    tree = Tree()
    tree.feed(html or "")
    tree.close()
    return tree.root


# all walks keep a stack of their own: pages may nest deeper than Python recurses

def blocks_of(container: Element) -> list[str]:
    """Texts of the blocks below a container, without what is beside the text."""
    out: list[str] = []
    run: list[str] = []

    def end() -> None:
        text = " ".join("".join(run).split())
        if text:
            out.append(text)
        run.clear()

    work: list[tuple[Element | str | None, bool]] = [(c, False) for c in reversed(container.children)]
    while work:
        node, only_headings = work.pop()
        if node is None:
            end()
        elif isinstance(node, str):
            if not only_headings:
                run.append(node)
        elif node.tag == "br":
            run.append(" ")
        elif not node.hidden:
            if node.beside:
                # an article's own header keeps its headings
                if node.tag != "header" or container.tag not in ("article", "main"):
                    continue
                only_headings = True
            elif node.tag in HEADINGS:
                only_headings = False
            if node.tag in BLOCKS:
                end()
                work.append((None, False))
            work += [(c, only_headings) for c in reversed(node.children)]
    end()
    return out


def _elements(root: Element) -> Iterator[Element]:
    """An element and the visible ones below it in page order, without those below what is beside the text."""
    work = [root]
    while work:
        node = work.pop()
        yield node
        work += [c for c in reversed(node.children) if isinstance(c, Element) and not c.hidden and not c.beside]


def candidates(root: Element) -> list[tuple[str, float]]:
    """(path, score) of a page's containers, best first; the scores of a path's containers add up.

    A container is worth the running text below it: links count against it, short lines little.  Its score is
    its share of the page's worth, and more the less of it lies in one smaller container.  Articles, and the
    smallest division that holds most of the text together with its h1, gain.
    """
    order, parent, worth, titled = [root], [-1], [0.0], [False]
    run: list[str] = []
    linked, at = 0, 0

    def end() -> None:
        nonlocal linked
        text = " ".join("".join(run).split())
        worth[at] += max(0, len(text) - 2 * linked) * (1.0 if len(text) >= 40 else 0.5)
        run.clear()
        linked = 0

    work: list[tuple[Element | str | None, int, bool]] = [(c, 0, False) for c in reversed(root.children)]
    while work:
        node, inside, in_link = work.pop()
        if node is None:
            end()
        elif isinstance(node, str):
            run.append(node)
            at = inside
            linked += len(node.strip()) if in_link else 0
        elif node.tag == "br":
            run.append(" ")
        elif not node.hidden and not node.beside:
            if node.tag == "h1":
                titled[inside] = True
            if node.tag in BLOCKS:
                end()
                work.append((None, inside, False))
            if node.tag in CONTAINERS:
                order.append(node)
                parent.append(inside)
                worth.append(0.0)
                titled.append(False)
                inside = len(order) - 1
            work += [(c, inside, in_link or node.tag == "a") for c in reversed(node.children)]
    end()
    inner, below = [0.0] * len(order), titled[:]
    for i in range(len(order) - 1, 0, -1):  # children come after their parents
        worth[parent[i]] += worth[i]
        inner[parent[i]] = max(inner[parent[i]], worth[i])
        below[parent[i]] = below[parent[i]] or below[i]
    whole = worth[0]
    if whole <= 0:
        return [("", 1.0)] if blocks_of(root) else []
    articles = sum(e.tag == "article" for e in order)
    title = max((i for i, e in enumerate(order) if below[i] and 2 * worth[i] >= whole and e.tag not in ("", "html", "body")),
                default=-1)  # of a chain, the last is the smallest
    scores: dict[str, tuple[float, int]] = {}
    for i, e in enumerate(order):
        if worth[i] > 0:
            score = worth[i] / whole * (1.1 - inner[i] / worth[i] + (2.0 if e.tag == "article" else 0.0))
            score += (1.0 if e.tag == "article" and articles == 1 else 0.0) + (1.0 if i == title else 0.0)
            total, n = scores.get(e.path, (0.0, 0))
            scores[e.path] = (total + score, n + 1)
    # many containers of one path are parts of something rather than the whole
    return sorted(((p, t if n == 1 else t / 2) for p, (t, n) in scores.items()), key=lambda s: (-s[1], s[0]))


def text_of(root: Element, paths: list[str]) -> str:
    """Text of the containers with the first of the paths that has text on the page, joined in page order."""
    found: dict[str, list[Element]] = {p: [] for p in paths}
    for e in _elements(root):
        if e.path in found and (e is root or e.tag in CONTAINERS):
            found[e.path].append(e)
    for path in paths:
        blocks: list[str] = []
        for e in found[path]:  # one path means one depth: none lies within another
            blocks += blocks_of(e)
        if blocks:
            return "\n".join(blocks)
    return ""


def host_of(url: Column) -> Column:
    """Lower-case host without user and port; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def votes(pages: DataFrame, html_col: str = "html", url_col: str = "url", per_page: int = 4) -> DataFrame:
    """host, path, votes, pages: each page's ``per_page`` best paths, a page's scores adding up to one vote.

    Votes are whole millionths, so their sum does not depend on the order of the pages.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths, cast = [], [], []
            for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                best = candidates(parse(html))[:per_page]
                total = sum(s for _, s in best)
                for path, score in best:
                    hosts.append(host)
                    paths.append(path)
                    cast.append(int(1e6 * score / total))
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()),
                                              pa.array(cast, pa.int64())], names=["host", "path", "votes"])

    seen = pages.select(host_of(col(url_col)).alias("host"), col(html_col).alias("html")).filter("host <> ''")
    return seen.mapInArrow(read, "host string, path string, votes long").groupBy("host", "path").agg(
        F.sum("votes").alias("votes"), F.count("*").alias("pages"))


def winners(cast: DataFrame, per_host: int = 8) -> DataFrame:
    """host, paths: the paths with the most votes, best first; equal votes by path."""
    order = Window.partitionBy("host").orderBy(F.desc("votes"), "path")
    ranked = cast.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= per_host)
    return ranked.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("place", "path"))).alias("best")).select(
        "host", F.col("best.path").alias("paths"))


def extract(pages: DataFrame, html_col: str = "html", url_col: str = "url") -> DataFrame:
    """``pages`` with text and n_chars, named with underscores added where ``pages`` has such a column.

    Null and empty html and pages without running text give the empty text.  A page whose url is null or
    has no host is read by its own best container.  Every row stays, repeated ones too, with its columns.
    """
    paths = materialise(winners(votes(pages, html_col, url_col)), "host-paths")
    text, size, found, host = (free_name(pages, n) for n in ("text", "n_chars", "__paths", "__host"))
    joined = pages.withColumn(host, host_of(col(url_col))).join(
        paths.select(F.col("host").alias(host), F.col("paths").alias(found)), host, "left")

    @F.pandas_udf("string")
    def main_text(html: pd.Series, voted: pd.Series) -> pd.Series:
        out = []
        for page, host_paths in zip(html, voted):
            root = parse(page)
            main = "" if host_paths is None else text_of(root, list(host_paths))
            out.append(main or text_of(root, [p for p, _ in candidates(root)]))
        return pd.Series(out, dtype=object)

    out = joined.withColumn(text, main_text(col(html_col), col(found)))
    return out.select(*(col(c) for c in pages.columns), col(text), F.char_length(col(text)).cast("long").alias(size))
