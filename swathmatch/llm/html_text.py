"""Main text of web pages, by site style trees.

Pages of one host are merged by the style path of their blocks (tags, classes and
ids from the root).  Over a host's pages each path has an entropy of what it says
and of how it is laid out; a branch that says nearly the same everywhere, below a
parent that does not, is of low importance and is removed from each page.  What
tags and class names call a menu, footer, advert or the like goes as well.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swathmatch.llm.shared import settle

# least pages of a path, most importance of a removed branch, least of its parent,
# and the weight of what is said against the layout
LEAST_PAGES, LOW, PARENT, SAID = 8, 0.1, 0.5, 0.9

# fixed values: elements of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript xmp iframe noembed noframes template".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul""".split())
CLOSES_P = BLOCK - {"caption", "dd", "dt", "legend", "li", "option", "tbody", "td", "tfoot", "th", "thead", "tr", "html", "body"}
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
             "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
         "tbody": {"table"}, "tfoot": {"table"}}

# what is never main text: by element, role, and words of class and id
NOISE_TAGS = frozenset("nav header footer aside form button select input head dialog menu svg object canvas audio video".split()) | RAW
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
NOISE_WORDS = frozenset("""ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu
    breadcrumb breadcrumbs sidebar aside footer header masthead cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe
    subscription signup login share sharing social related recommended comment comments commentlist reply replies disqus respond pagination pager
    skip toolbar widget widgets search copyright disclaimer""".split())

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?/][^>]*(?:>|\Z)""", re.DOTALL)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


@dataclass
class Node:
    tag: str
    parent: int
    path: str
    noise: bool
    first: int  # of its pieces of text
    last: int = -1
    main: bool = False  # article or main, or around one
    children: list[str] = field(default_factory=list)


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)} if text.strip() else {}


def _style(tag: str, attrs: dict[str, str]) -> str:
    """Tag, classes and id, without long numbers (those tell pages apart, not styles)."""
    names = sorted(set(attrs.get("class", "").lower().split()))
    own = attrs.get("id", "").lower()
    return re.sub(r"\d{3,}", "0", tag + "".join(f".{n}" for n in names) + (f"#{own}" if own else ""))


def _noisy(tag: str, attrs: dict[str, str], in_article: bool) -> bool:
    if tag in NOISE_TAGS and not (tag == "header" and in_article):
        return True
    if "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true" or attrs.get("role", "").lower() in NOISE_ROLES:
        return True
    if "display:none" in attrs.get("style", "").replace(" ", "").lower():
        return True
    words = re.split(r"[^a-z]+", f"{attrs.get('class', '')} {attrs.get('id', '')}".lower())
    return any(w in NOISE_WORDS for w in words) and not (in_article and tag == "header")


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Elements of a page and its pieces of text, each with the element it is in.

    A ``br`` is a piece of white space; unclosed elements end where HTML ends them."""
    nodes = [Node("", -1, "", False, 0)]
    pieces: list[tuple[int, str]] = []
    stack, at, n = [0], 0, len(page)

    def close(to: int) -> None:
        while len(stack) > to:
            nodes[stack.pop()].last = len(pieces)

    def nearest(tags, stop) -> int:
        for k in range(len(stack) - 1, 0, -1):
            t = nodes[stack[k]].tag
            if t in tags:
                return k
            if t in stop:
                return 0
        return 0

    while at < n:
        m = TOKEN.search(page, at)
        end = m.start() if m else n
        if end > at:
            pieces.append((stack[-1], html.unescape(page[at:end])))
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            k = nearest({tag}, {"table"} if tag not in ("table", "body", "html", "article", "main", "div", "section") else ())
            if k:
                close(k)
            continue
        if tag in CLOSES_P:
            k = nearest({"p"}, {"td", "th", "table", "button", "object"})
            if k:
                close(k)
        elif tag in CLOSED_BY:
            while k := nearest(CLOSED_BY[tag], SCOPE[tag]):
                close(k)
        if tag == "br":
            pieces.append((stack[-1], " "))
            continue
        attrs = _attributes(m[3])
        up = nodes[stack[-1]]
        in_article = up.main or tag in ("article", "main")
        style = _style(tag, attrs)
        up.children.append(style)
        node = Node(tag, stack[-1], f"{up.path}>{style}" if tag in BLOCK else up.path, _noisy(tag, attrs, up.main), len(pieces), len(pieces),
                    in_article)
        nodes.append(node)
        if tag in VOID or m[3].endswith("/") and tag not in BLOCK and tag not in RAW:
            continue
        if tag in RAW:
            closing = re.compile(rf"</{re.escape(tag)}[\s/>]", re.IGNORECASE).search(page, at)
            stop = page.find(">", closing.start()) if closing else -1
            at = stop + 1 if stop >= 0 else n
            continue
        stack.append(len(nodes) - 1)
    close(0)
    return nodes, pieces


def _dropped(nodes: list[Node], low: frozenset[str]) -> list[bool]:
    """Elements that are not main text; an element around the article is never one."""
    around = [False] * len(nodes)
    for node in nodes:
        if node.tag in ("article", "main") and not node.noise:
            k = node.parent
            while k >= 0 and not around[k]:
                around[k] = True
                k = nodes[k].parent
    out = []
    for i, node in enumerate(nodes):
        gone = node.parent >= 0 and out[node.parent]
        own = (node.noise or (node.tag in BLOCK and node.path in low)) and not (around[i] and node.tag not in NOISE_TAGS)
        out.append(gone or own)
    return out


def main_text(page: str, low: frozenset[str] = frozenset()) -> str:
    """The main text: of the articles, else of the main element, else of the body."""
    nodes, pieces = parse(page)
    gone = _dropped(nodes, low)
    inside = [False] * len(nodes)
    for tags in (("article",), ("main",), ("",)):
        if any(n.tag in tags and not g for n, g in zip(nodes, gone, strict=True)):
            for i, n in enumerate(nodes):
                inside[i] = n.tag in tags or (n.parent >= 0 and inside[n.parent])
            break
    # the block that a piece is in; text on either side of an inner block are blocks
    block: list[int] = []
    for i, n in enumerate(nodes):
        block.append(i if n.tag in BLOCK or n.parent < 0 else block[n.parent])
    starts = sorted((n.first, n.last) for n in nodes if n.tag in BLOCK)
    breaks = {k for span in starts for k in span}
    blocks, now, held = [], -1, []
    for k, (at, said) in enumerate(pieces):
        if held and (k in breaks or block[at] != now):
            blocks.append(" ".join("".join(held).split()))
            held = []
        now = block[at]
        if inside[at] and not gone[at]:
            held.append(said)
    blocks.append(" ".join("".join(held).split()))
    return "\n".join(b for b in blocks if b)


def _styles(pages: DataFrame) -> DataFrame:
    """host, path, parent, said, layout: hashes for each block path of each page."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for host, page in zip(frame["host"], frame["html"], strict=True):
                nodes, pieces = parse(page)
                paths: dict[str, list] = {}
                for node in nodes:
                    if node.tag in BLOCK:
                        p = paths.setdefault(node.path, [nodes[node.parent].path, hashlib.blake2b(digest_size=8), hashlib.blake2b(digest_size=8)])
                        said = " ".join("".join([t for _, t in pieces[node.first : node.last]]).split())
                        p[1].update(said.encode("utf-8", "replace") + b"\n")
                        p[2].update(" ".join(node.children).encode("utf-8", "replace") + b"\n")
                out += [(host, path, up, *(int.from_bytes(h.digest(), "little", signed=True) for h in (a, b))) for path, (up, a, b) in paths.items()]
            yield pd.DataFrame(out, columns=["host", "path", "parent", "said", "layout"])

    return pages.mapInPandas(run, "host string, path string, parent string, said long, layout long")


def _entropy(rows: DataFrame, column: str) -> DataFrame:
    """host, path, parent, n, and the entropy of *column* as a share of the most."""
    counts = rows.groupBy("host", "path", "parent", column).agg(F.count("*").alias("c"))
    sums = counts.groupBy("host", "path", "parent").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.log("c")).alias("s"))
    share = (F.log("n") - F.col("s") / F.col("n")) / F.log("n")
    return sums.select("host", "path", "parent", "n", F.when(F.col("n") > 1, share).otherwise(1.0).alias(column))


def low_branches(pages: DataFrame) -> DataFrame:
    """host, low: the style paths of each host's unimportant branches.

    *pages*: host, html.  Importance is the weighted entropy of what a path says and
    of its layout over the host's pages.
    """
    rows = settle(_styles(pages))
    said, layout = _entropy(rows, "said"), _entropy(rows, "layout").drop("n")
    weight = settle(said.join(layout, ["host", "path", "parent"]).select(
        "host", "path", "parent", "n", (SAID * F.col("said") + (1 - SAID) * F.col("layout")).alias("importance")))
    up = weight.groupBy("host", "path").agg(F.max("importance").alias("above")).withColumnRenamed("path", "parent")
    low = weight.join(up, ["host", "parent"]).filter((F.col("n") >= LEAST_PAGES) & (F.col("importance") <= LOW) & (F.col("above") >= PARENT))
    return settle(low.groupBy("host").agg(F.collect_set("path").alias("low")))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for each row of *pages* (page_id, url, html).

    Blocks are joined by a line feed; white space in a block is one space; character
    references are decoded.  A NULL or empty page has an empty text; a NULL url is a
    host of its own; repeated rows each count; other columns are not read.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html"), F.lit("")).alias("html"),
                        F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)).alias("host"))
    low = low_branches(rows.select("host", "html"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [main_text(page, frozenset(paths) if paths is not None else frozenset()) for page, paths in zip(frame["html"], frame["low"], strict=True)]
            yield pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    return rows.join(low, "host", "left").select("page_id", "url", "html", "low").mapInPandas(run, "page_id long, url string, text string, n_chars long")
