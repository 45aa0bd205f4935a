"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree of presentations: an element's node is the path of tags, classes and ids
that leads to it (digits count as one digit).  A node's presentation is the sequence of its children's keys, its content
all text below it; on a page that has a node several times they are taken together.  The importance of a node is

    (1 - g^l) * entropy of its presentations + g^l * entropy of its contents

over the pages of the host that have it, with logarithms to the base of their number (0: all alike, 1: all different), l
the number of presentations and g = 0.9.  What a template repeats is not important; articles are.  Nodes of low
importance are branches to remove.  Pages of one host that are equal count once, so copies are not taken for a template.

What a page says about itself comes first: navigation, headers outside of articles, footers, asides, forms, dialogs,
hidden elements, and classes, ids and roles that name menus, adverts, notices, comments and the like are removed even
where each page has other words in them.  ``main``, else ``article`` elements are the article where a page has them;
elements inside them without class and id are never removed as template.

Text is decoded and split into blocks at every block element; white space inside a block becomes one space.

A hot host is spread: nodes are counted by (host, node, value), partly in each task.  The nodes to remove are a list per
host; its measured size decides how it meets the pages.

Defined results: null or empty pages give an empty text; pages without a host are cut by their own marks only; a page cut
off anywhere keeps what was read; repeated rows give a row each; an empty table gives none; other columns are not looked
at.  Pages of any length and depth are read whole, in one pass without recursion.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrearium.llm.common import stored

#: Distinct pages of a host that must have a node before it is judged, and the importance below which it goes.
LEAST_PAGES, LEAST_IMPORTANCE, DAMPING = 8, 0.2, 0.9
TEXT_SCHEMA = "page_id long, url string, text string, n_chars long"
FEATURES = "host string, digest long, nodes array<struct<node:long,style:long,content:long>>"

# Elements of HTML by what they do to text, and words that pages use for parts that are not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot "
    "th thead title tr ul".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
BARRIER = frozenset("html body table caption td th object template button".split())
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "thead": {"thead", "tbody", "tfoot", "tr", "td", "th"}, "tbody": {"thead", "tbody", "tfoot", "tr", "td", "th"},
    "tfoot": {"thead", "tbody", "tfoot", "tr", "td", "th"}, "option": {"option"}, "optgroup": {"option", "optgroup"},
}
LIST_ENDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select", "datalist"}, "optgroup": {"select"}}
NOT_TEXT = frozenset(
    "head script style template noscript iframe object svg math canvas audio video map select datalist button textarea "
    "nav footer aside dialog menu noembed noframes xmp title fieldset".split()
)
ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status tablist toolbar tooltip".split()
)
WORDS = frozenset(
    "ad ads advert advertisement advertisements advertising adverts adsense adslot banner breadcrumb breadcrumbs comment "
    "comments commentlist consent cookie cookies copyright dialog discussion disqus footer gdpr header login masthead menu "
    "modal nav navbar navigation newsletter notice notices notification outbrain overlay pager pagination paywall popup "
    "promo promos promotion recommended related replies reply respond search share sharing sidebar signup skip social "
    "sponsor sponsored subscribe subscription taboola teaser teasers toolbar topbar widget".split()
)
#: Words that make ``header`` the article's own, and words that only say what stands elsewhere.
OWN_HEADER = frozenset("article content entry page post story title".split())
ELSEWHERE = frozenset("has with no without".split())

_MARK = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(?:!|\?)[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?)*+)(?:>|\Z)""", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_DIGITS = re.compile(r"\d+")
_M, _B = (1 << 61) - 1, 0x1F3D5B79A6C4E28
#: Nodes and attribute strings that a worker remembers.
REMEMBERED = 100_000


class Page:
    """Elements of a page in the order of their start (a parent before its children), and its texts.

    ``pieces`` are the texts and, as None, the borders of blocks; ``first`` and ``last`` give an element's pieces.
    """

    def __init__(self, html: str):
        self.tags, self.attributes, self.parents = ["html"], [""], [-1]
        self.first, self.last, self.pieces, self.owners = [0], [0], [], []
        self._open, self._count = [0], {"html": 1}
        self._read(html)
        while self._open:
            self._pop()

    def _pop(self) -> None:
        i = self._open.pop()
        self.last[i] = len(self.pieces)
        self._count[self.tags[i]] -= 1

    def _border(self) -> None:
        if self.pieces and self.pieces[-1] is not None:
            self.pieces.append(None)
            self.owners.append(0)

    def _text(self, text: str) -> None:
        if text:
            self.pieces.append(unescape(text) if "&" in text else text)
            self.owners.append(self._open[-1])

    def _close_some(self, names: set[str], until: frozenset[str] | set[str]) -> None:
        """Close the innermost open element of some names, unless one of ``until`` is met first."""
        if any(self._count.get(n) for n in names):
            for k in range(len(self._open) - 1, 0, -1):
                tag = self.tags[self._open[k]]
                if tag in names:
                    while len(self._open) > k:
                        self._pop()
                    return
                if tag in until:
                    return

    def _start(self, tag: str, attributes: str) -> None:
        if tag in ("html", "body") and self._count.get(tag):
            return
        if tag in BLOCK:
            self._border()
            if self._count.get("p") and tag not in ("html", "body"):
                self._close_some({"p"}, BARRIER)
        if tag in CLOSES:
            until = LIST_ENDS.get(tag, {"table"})
            while True:  # a row closes the cell and the row before it
                n = len(self._open)
                self._close_some(CLOSES[tag], until)
                if len(self._open) == n:
                    break
        if tag == "br":
            self._text(" ")
        self.parents.append(self._open[-1])
        self.tags.append(tag)
        self.attributes.append(attributes)
        self.first.append(len(self.pieces))
        self.last.append(len(self.pieces))
        if tag not in VOID:
            self._open.append(len(self.tags) - 1)
            self._count[tag] = self._count.get(tag, 0) + 1

    def _end(self, tag: str) -> None:
        if tag in ("html", "body") or not self._count.get(tag):
            return
        if tag in BLOCK or tag in NOT_TEXT:
            if tag in BLOCK:
                self._border()
            until = BARRIER - {tag} if tag not in ("table", "tr", "tbody", "thead", "tfoot") else {"html", "body", "table"} - {tag}
            self._close_some({tag}, until)
        else:
            for k in range(len(self._open) - 1, 0, -1):
                now = self.tags[self._open[k]]
                if now == tag:
                    while len(self._open) > k:
                        self._pop()
                    break
                if now in BLOCK:
                    break

    def _read(self, html: str) -> None:
        at, n, lower = 0, len(html), None
        while at < n:
            start = html.find("<", at)
            if start < 0:
                self._text(html[at:])
                break
            mark = _MARK.match(html, start)
            if mark is None:  # a sign in the text
                self._text(html[at : start + 1])
                at = start + 1
                continue
            self._text(html[at:start])
            at = mark.end()
            if mark[2] is None:
                continue
            tag = mark[2].lower()
            if mark[1]:
                self._end(tag)
                continue
            self._start(tag, mark[3])
            if tag in RAW and at < n:
                lower = html.lower() if lower is None else lower
                end = lower.find("</" + tag, at) if len(lower) == n else html.find("</" + tag, at)
                at = n if end < 0 else end


# ---- what a page says about itself -------------------------------------------------

_LOOKS: dict[str, tuple[str, bool, frozenset[str], str, bool]] = {}


def look(attributes: str) -> tuple[str, bool, frozenset[str], str, bool]:
    """(class and id as a key, whether there is any, their words, the role, whether it is hidden)."""
    if not attributes.strip(" \t\n\r\f/"):
        return "", False, frozenset(), "", False
    known = _LOOKS.get(attributes)
    if known is None:
        found = {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)}
        names = sorted(found.get("class", "").split()) + [f"#{x}" for x in found.get("id", "").split()]
        style = found.get("style", "").replace(" ", "").lower()
        hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in style or "visibility:hidden" in style
        words: set[str] = set()
        for name in names:
            parts = [w.lower() for w in _WORD.findall(name)]
            if not ELSEWHERE & set(parts) and not ("header" in parts and OWN_HEADER & set(parts)):
                words |= set(parts)
        known = _DIGITS.sub("0", " ".join(names)), bool(names), frozenset(words & WORDS), found.get("role", "").lower(), hidden
        if len(_LOOKS) > REMEMBERED:
            _LOOKS.clear()
        _LOOKS[attributes] = known
    return known


def article_of(page: Page) -> list[bool]:
    """For each element whether it belongs to the article by what the page says about itself."""
    n = len(page.tags)
    holds = [tag in ("article", "main") for tag in page.tags]
    for i in range(n - 1, 0, -1):
        if holds[i]:
            holds[page.parents[i]] = True
    keep, inside = [True] * n, [False] * n
    for i in range(1, n):
        tag, up = page.tags[i], page.parents[i]
        inside[i] = inside[up] or tag in ("article", "main")
        if not keep[up]:
            keep[i] = False
            continue
        _, _, words, role, hidden = look(page.attributes[i])
        core = tag in ("html", "body") or holds[i] and tag not in ("article", "main")
        if hidden or tag in NOT_TEXT:
            keep[i] = False
        elif tag in ("article", "main"):
            keep[i] = not words & {"comment", "comments", "reply", "ad", "advert", "advertisement", "sponsored", "related", "teaser"}
        elif not core:
            keep[i] = not (tag == "form" or tag == "header" and not inside[i] or role in ROLES or words)
    for name in ("main", "article"):
        if any(k and t == name for k, t in zip(keep, page.tags, strict=True)):
            under = [False] * n
            for i in range(1, n):
                under[i] = under[page.parents[i]] or page.tags[i] == name
            return [k and u for k, u in zip(keep, under, strict=True)]
    return keep


def inside_core(page: Page) -> list[bool]:
    """For each element whether it is, or stands in, ``main`` or ``article``."""
    inside = [False] * len(page.tags)
    for i in range(1, len(page.tags)):
        inside[i] = inside[page.parents[i]] or page.tags[i] in ("article", "main")
    return inside


# ---- the style tree ----------------------------------------------------------------

_NODES: dict[tuple[int, str], int] = {}


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def nodes_of(page: Page) -> list[int]:
    """The style tree's node of every element: a hash of the keys on its path."""
    if len(_NODES) > REMEMBERED:
        _NODES.clear()
    out = [0]
    for i in range(1, len(page.tags)):
        step = (out[page.parents[i]], f"{page.tags[i]} {look(page.attributes[i])[0]}")
        node = _NODES.get(step)
        if node is None:
            node = _NODES[step] = _hash(f"{step[0]} {step[1]}")
        out.append(node)
    return out


def features(page: Page) -> tuple[int, list[tuple[int, int, int]]]:
    """The hash of all text, and (node, presentation, content) of every node of the page, as hashes."""
    nodes = nodes_of(page)
    # Prefix hashes: the content of any range of pieces in one step, whatever the depth.
    sums, power, n = [0], [1], [0]
    skipped = {i for i, tag in enumerate(page.tags) if tag in RAW or tag == "head"}
    for text, owner in zip(page.pieces, page.owners, strict=True):
        said = text.strip() if text is not None and owner not in skipped else ""
        if said:
            sums.append((sums[-1] * _B + (_hash(" ".join(said.split())) % _M)) % _M)
            power.append(power[-1] * _B % _M)
        n.append(len(sums) - 1)

    def content(i: int) -> int:
        a, b = n[page.first[i]], n[page.last[i]]
        return (sums[b] - sums[a] * power[b - a]) % _M

    children: list[list[int]] = [[] for _ in nodes]
    for i in range(1, len(nodes)):
        under = children[page.parents[i]]
        if page.tags[i] not in INLINE and (not under or under[-1] != nodes[i]):
            under.append(nodes[i])
    styles: dict[int, int] = {}
    contents: dict[int, int] = {}
    for i in range(1, len(nodes)):
        if page.tags[i] in INLINE or page.tags[i] in NOT_TEXT:
            continue
        node, style = nodes[i], styles.get(nodes[i], 0)
        for child in children[i]:
            style = (style * _B + child) % _M
        styles[node] = (style * _B + 1) % _M
        contents[node] = (contents.get(node, 0) * _B + content(i)) % _M
    return content(0), [(node, styles[node], contents[node]) for node in styles]


def host_of(url: Column) -> Column:
    """The host of an address in small letters, without user, port and ``www.``; null if there is none."""
    place = F.lower(F.regexp_extract(url, r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    plain = F.regexp_replace(place, r"^www\.", "")
    return F.when(plain != "", plain)


def style_tree(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, node, pages, presentations, importance) of every node of the hosts' merged trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("node", pa.int64()), ("style", pa.int64()), ("content", pa.int64())]))
        for batch in batches:
            digests, nodes = [], []
            for text in batch.column(1).to_pylist():
                digest, found = features(Page(text or ""))
                digests.append(digest)
                nodes.append([{"node": a, "style": b, "content": c} for a, b, c in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.int64()), pa.array(nodes, kind)], ["host", "digest", "nodes"])

    hosted = pages.select(host_of(F.col(url)).alias("host"), F.col(html).cast("string").alias("html")).where("host IS NOT NULL")
    found = hosted.mapInArrow(run, FEATURES).dropDuplicates(["host", "digest"])
    values = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(name).alias("value")) for kind, name in (("s", "style"), ("c", "content"))])
    each = found.select("host", F.inline("nodes")).select("host", "node", F.inline(values))
    counted = each.groupBy("host", "node", "kind", "value").agg(F.count("*").alias("n"))
    pages_of, log = F.sum("n"), F.sum(F.col("n") * F.log("n"))
    measured = counted.groupBy("host", "node", "kind").agg(pages_of.alias("m"), log.alias("x"), F.count("*").alias("l"))
    entropy = F.when(F.col("m") > 1, (F.log("m") - F.col("x") / F.col("m")) / F.log("m")).otherwise(F.lit(1.0))
    both = measured.withColumn("h", entropy).groupBy("host", "node").agg(
        F.max("m").alias("pages"),
        F.max(F.when(F.col("kind") == "s", F.col("l"))).alias("presentations"),
        F.max(F.when(F.col("kind") == "s", F.col("h"))).alias("s"),
        F.max(F.when(F.col("kind") == "c", F.col("h"))).alias("c"),
    )
    weight = F.pow(F.lit(DAMPING), F.col("presentations"))
    return both.select("host", "node", "pages", "presentations", ((1 - weight) * F.col("s") + weight * F.col("c")).alias("importance"))


# ---- extraction --------------------------------------------------------------------


def main_text(html: str, low: set[int]) -> str:
    """The article of one page: its blocks, with two line feeds between them; ``low`` are the nodes to remove."""
    page = Page(html)
    keep = article_of(page)
    if low:
        nodes, inside = nodes_of(page), inside_core(page)
        gone = [False] * len(nodes)
        for i in range(1, len(nodes)):
            fixed = page.tags[i] in ("html", "body", "main", "article") or inside[i] and not look(page.attributes[i])[1]
            gone[i] = gone[page.parents[i]] or not fixed and nodes[i] in low
        keep = [k and not g for k, g in zip(keep, gone, strict=True)]
    blocks, now = [], []
    for text, owner in zip([*page.pieces, None], [*page.owners, 0], strict=True):
        if text is None:
            said = " ".join("".join(now).split())
            if said:
                blocks.append(said)
            now = []
        elif keep[owner]:
            now.append(text)
    return "\n\n".join(blocks)


def extracted(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars): the article of every page."""
    tree = style_tree(pages, url, html)
    low = tree.where((F.col("pages") >= LEAST_PAGES) & (F.col("importance") < LEAST_IMPORTANCE))
    # Stored, so that its size on disk tells the planner whether it can be sent to all.
    lists = stored(low.groupBy(F.col("host").alias("tree_host")).agg(F.collect_list("node").alias("low")), "templates")
    own = pages.select(
        F.col(id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("string").alias("html"),
        host_of(F.col(url)).alias("host"),
    )
    joined = own.join(lists, F.col("host") == F.col("tree_host"), "left").select("page_id", "url", "html", "low")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                main_text(html, set(nodes or ())) if html else ""
                for html, nodes in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return joined.mapInArrow(run, TEXT_SCHEMA)
