"""Main text of web pages by consensus of a host's pages.

1. Every page's containers are scored by the text they hold outside menus, headers, forms and the like (less its share
   of link text); the page names the deepest container with most of it, as a path of tags and generalised classes.
2. Spark counts the pages of each (host, path); the path most pages of a host name wins.
3. Every page is extracted again from the containers on its host's winning path; a page without one uses its own.

Text: character references decoded, white space inside a block made one space, blocks in page order joined by a line
feed. Blocks are the block-level elements; ``br`` is white space.

The votes are written as a table; Spark broadcasts it to the pages if it is small by its size on disk and joins by host
(splitting hot hosts) if not.

Cases: null html is an empty page with empty text; a null or hostless url takes part with the host ""; unclosed, cut
off and stray tags are tolerated; repeated rows vote again; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricedex.llm.common import materialise

MOST = 0.7  # share of a page's text that the named container holds

# Element names of HTML and words that name page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup
    option p pre search section summary table tbody td tfoot th thead tr ul""".split())
CONTAINER = frozenset("html body div section article main td center blockquote figure table tbody tr".split())
FURNITURE = frozenset("""nav header footer aside form script style noscript template button select iframe svg dialog menu
    object canvas textarea title head search""".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
FURNITURE_WORDS = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner
    sidebar menu menus nav navbar navigation breadcrumb breadcrumbs footer header masthead notice notices cookie cookies
    consent gdpr popup modal overlay newsletter subscribe subscription signup login comment comments reply replies respond
    disqus share sharing social related recommended recommendations trending widget widgets toolbar pagination pager
    copyright disclaimer alert""".split())
CLOSED_BY = {  # an open element (key of the inner set) ends where one of these begins
    "li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "optgroup": {"option", "optgroup"},
}
SCOPE = {"li": {"ul", "ol", "menu"}, "dd": {"dl"}, "dt": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
         "option": {"select"}, "optgroup": {"select"}}

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s"'=/<>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_HIDDEN = re.compile(r"""(?i)(?<![\w-])hidden(?![\w-])(?!\s*=\s*["']?until)|display\s*:\s*none""")


class Node:
    __slots__ = ("tag", "parent", "path", "furniture", "link", "weight", "depth")

    def __init__(self, tag: str, parent: Node | None, path: str, furniture: bool, link: bool):
        self.tag, self.parent, self.path, self.furniture, self.link = tag, parent, path, furniture, link
        self.weight, self.depth = 0.0, parent.depth + 1 if parent else 0


def _general(name: str) -> str:
    """A class without what differs from page to page: words with digits stand as N."""
    return "-".join("N" if any(c.isdigit() for c in w) else w for w in re.split(r"[-_]+", name.lower()) if w)


def _names_furniture(names: list[str]) -> bool:
    for name in names:
        words = [w for w in re.split(r"[-_]+|(?<=[a-z])(?=[A-Z])", name) if w]
        if words and words[0].lower() not in ("has", "no", "with", "without") and any(
                w.lower() in FURNITURE_WORDS for w in words):
            return True
    return False


def _open(tag: str, raw: str, parent: Node) -> Node:
    values = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(raw)} if "=" in raw else {}
    classes = values.get("class", "").split()
    furniture = parent.furniture or tag in FURNITURE
    if not furniture and raw:
        furniture = (values.get("role", "").lower() in FURNITURE_ROLES or values.get("aria-hidden", "").lower() == "true"
                     or (tag not in ("html", "body", "main", "article")
                         and _names_furniture(classes + values.get("id", "").split()))
                     or ("hidden" in raw or "none" in raw) and bool(_HIDDEN.search(
                         re.sub(r"""(?i)(?:class|id|href|title|alt)\s*=\s*(?:"[^"]*"|'[^']*'|\S+)""", "", raw))))
    path = parent.path
    if tag in CONTAINER:
        path += ">" + ".".join([tag, *sorted({g for c in classes if (g := _general(c))})])
    return Node(tag, parent, path, furniture, parent.link or tag == "a")


def parse(page: str) -> list[tuple[str, Node, float]]:
    """The page's text blocks in order: (text, innermost element, share of link text)."""
    root = Node("", None, "", False, False)
    stack, blocks = [root], []
    runs: list[str] = []
    linked = 0
    owner = root

    def flush() -> None:
        nonlocal linked
        if runs:
            text = " ".join("".join(runs).split())
            if text:
                blocks.append((text, owner, min(1.0, linked / len(text))))
            runs.clear()
            linked = 0

    def add(text: str) -> None:
        nonlocal owner, linked
        text = html.unescape(text) if "&" in text else text
        if not runs:
            owner = stack[-1]
            while owner.tag not in BLOCK and owner.parent is not None:
                owner = owner.parent
        if stack[-1].furniture:
            if not owner.furniture:
                return  # a button or the like inside a block
        runs.append(text)
        if stack[-1].link:
            linked += len(text.strip())

    def close_to(depth: int) -> None:
        while len(stack) > depth:
            if stack.pop().tag in BLOCK:
                flush()

    at, size = 0, len(page)
    while at < size:
        tag_at = page.find("<", at)
        if tag_at < 0:
            add(page[at:])
            break
        if tag_at > at:
            add(page[at:tag_at])
        if page.startswith("<!--", tag_at):
            end = page.find("-->", tag_at + 4)
            at = size if end < 0 else end + 3
            continue
        after = page[tag_at + 1: tag_at + 2]
        if after in ("!", "?"):
            end = page.find(">", tag_at)
            at = size if end < 0 else end + 1
            continue
        if not (after.isascii() and after.isalpha() or after == "/" and page[tag_at + 2: tag_at + 3].isalpha()):
            add("<")  # not a tag
            at = tag_at + 1
            continue
        m = _TAG.match(page, tag_at)
        if m is None:
            end = page.find(">", tag_at)
            if end < 0:
                break  # cut off inside a tag
            m = _TAG.match(page[tag_at: end + 1].replace('"', " ").replace("'", " "))
            if m is None:
                at = end + 1
                continue
            at = end + 1
        else:
            at = m.end()
        closing, tag, raw = m.group(1), m.group(2).lower(), m.group(3)
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    close_to(depth)
                    break
                if tag not in BLOCK and stack[depth].tag in BLOCK:
                    break  # an inline end tag does not reach out of its block
            continue
        if tag in BLOCK:
            flush()
            for depth in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                if stack[depth].tag == "p":
                    close_to(depth)
                    break
                if stack[depth].tag in BLOCK:
                    break
            for inner, openers in CLOSED_BY.items():
                if tag in openers:
                    for depth in range(len(stack) - 1, 0, -1):
                        if stack[depth].tag == inner:
                            close_to(depth)
                            break
                        if stack[depth].tag in SCOPE[inner]:
                            break
        elif tag == "br":
            add(" ")
            continue
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE).search(page, at)
            if end is None:
                break
            close = page.find(">", end.start())
            at = size if close < 0 else close + 1
            continue
        if not raw.rstrip().endswith("/") or tag in BLOCK or tag == "a":
            stack.append(_open(tag, raw, stack[-1]))
    flush()
    return [b for b in blocks if not b[1].furniture]


def _chain(node: Node) -> list[Node]:
    found = []
    while node.parent is not None:
        found.append(node)
        node = node.parent
    return found


def best_path(blocks: list[tuple[str, Node, float]]) -> tuple[str, float]:
    """Path of the deepest container with most of the page's text, lifted to its article or to the heading's container."""
    total, seen, heading = 0.0, [], None
    for text, node, links in blocks:
        weight = len(text) * (1 - links) if links < 0.5 else 0.0
        total += weight
        for n in _chain(node):
            if n.weight == 0.0 and weight:
                seen.append(n)
            n.weight += weight
        if heading is None and any(n.tag == "h1" for n in _chain(node)):
            heading = node
    if not total:
        return "", 0.0
    best = None
    for n in seen:
        if n.tag in CONTAINER and n.weight >= MOST * total and (best is None or n.depth > best.depth):
            best = n
    if best is None:
        return "", 0.0
    chain = _chain(best)
    article = [n for n in chain if n.tag in ("article", "main")]
    if article:
        best = article[0]
    elif heading is not None:
        over = set(map(id, _chain(heading)))
        shared = next((n for n in chain if id(n) in over and n.tag in CONTAINER), None)
        if shared is not None and shared.tag not in ("html", "body"):
            best = shared
    return best.path, best.weight


def text_at(blocks: list[tuple[str, Node, float]], path: str) -> str | None:
    """The blocks inside containers on the path; None if the page has none."""
    if not path:
        return None
    inside = [text for text, node, _ in blocks if any(n.path == path and n.tag in CONTAINER for n in _chain(node))]
    return "\n".join(inside) if inside else None


def extract(page: str, path: str | None) -> str:
    blocks = parse(page)
    found = text_at(blocks, path or "")
    return found if found is not None else text_at(blocks, best_path(blocks)[0]) or ""


def host(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def votes(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, path, pages, chars): how many pages of the host name the path."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            named = [best_path(parse(p)) for p in b["html"]]
            yield pd.DataFrame({"host": b["host"], "path": [n[0] for n in named], "chars": [n[1] for n in named]})

    rows = pages.select(host(F.col(url_col)).alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    found = rows.mapInPandas(run, "host string, path string, chars double").where("path <> ''")
    return found.groupBy("host", "path").agg(F.count("*").alias("pages"), F.sum(F.floor("chars")).alias("chars"))


def winning_paths(counted: DataFrame) -> DataFrame:
    """(host, path) with the most pages, then characters, then the first path."""
    best = F.struct(-F.col("pages"), -F.col("chars"), F.col("path"))
    return counted.groupBy("host").agg(F.min(best)["path"].alias("path"))


def extract_pages(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> DataFrame:
    """Per page: page_id, url, host, path (its host's winner), text."""
    winners = materialise(winning_paths(votes(pages, url_col, html_col)), "host-paths")

    @F.pandas_udf("string")
    def texts(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for page, path in batches:
            yield pd.Series([extract(h, p) for h, p in zip(page, path, strict=True)], dtype=object)

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host(F.col(url_col)).alias("host"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    joined = rows.join(winners, "host", "left")
    return joined.select("page_id", "url", "host", "path", texts("html", "path").alias("text"))
