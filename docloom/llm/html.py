"""Operator 6, main text of HTML pages by consensus host paths.

Each page's containers are scored: a block of text gives its length, less what is inside links, to its parent, and half of that to its
grandparent; chrome (menus, footers, forms, adverts, comments and the like, by tag or by class and id) gives nothing.  A class or id marks chrome
if it names it and says nothing else: ``related-posts`` does, ``related-work`` does not.  The best container's path, tags with classes whose digits are
generalised, is the page's vote, as a 128-bit digest of the whole path, however deep; Spark counts votes for each host
and the path with most votes (then most text, then first by digest) wins.  Every page is then read again with its
host's path; one without such a container, or with no text in it, falls back on its own best.  Character references are decoded in each
run of text between two tags, so none is made of parts.

Null or empty html: empty text.  Null url: pages without a host vote together.  Repeated rows: each is returned, and votes.  Null page_id:
kept.  Empty table: no rows.  Columns other than page_id, url and html are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import saved

#: Hosts up to which the winning paths are broadcast; a row is under 1 KB.
MAX_BROADCAST_HOSTS = 20_000

# Element names by their role, and words that mark chrome in a class or id.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby s samp small span strike strong sub sup time tt u var".split())
CHROME = frozenset("head nav header footer aside form script style noscript template svg math iframe object canvas select textarea button dialog menu audio video".split())
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"},
    "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"}, "option": {"option"},
}
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs byline-social comment comments commentlist cookie cookies consent disqus footer "
    "masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promotion promoted related replies reply respond share sharing sidebar "
    "skip social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)

#: Words that say where chrome stands or how it is shaped, and nothing of what a text is about.
SHAPES = frozenset(
    "area bar block box btn button buttons column container form global group holder icon icons inner item items left link links list main outer page panel posts primary right row "
    "secondary section site slot strip text top bottom unit wrap wrapper".split()
)

_RAW = "script|style|noscript|template|svg|math|iframe|object|canvas|select|textarea|button"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})(?=[\s/>]).*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|</?[a-zA-Z][^>]*+>|<[!?/][^>]*+>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_DIGITS = re.compile(r"\d+")
_WORD = re.compile(r"[a-z]+(?:-social)?")


class Node:
    __slots__ = ("parent", "tag", "path", "chrome", "in_article", "kept", "score")

    def __init__(self, parent: Node | None, tag: str, path: str, chrome: bool, in_article: bool):
        self.parent, self.tag, self.path, self.chrome, self.in_article, self.kept, self.score = parent, tag, path, chrome, in_article, False, 0.0


def path_of(up: str, step: str) -> str:
    """The digest of a path that goes on from ``up`` ("" above the first tag) by a tag with its classes."""
    return xxhash.xxh3_128_hexdigest(f"{up}>{step}")


def marks_chrome(value: str) -> bool:
    """Whether some class (or id) in ``value`` is made of words for chrome and for shapes only."""
    for name in value.split():
        words = _WORD.findall(name)
        if any(w in MARKS for w in words) and all(w in MARKS or w in SHAPES for w in words):
            return True
    return False


def parse(html: str) -> tuple[list[Node], list[tuple[Node, str, bool]]]:
    """Nodes in page order, and runs of text: (node, text, in a link); an empty text marks a block's edge."""
    root = Node(None, "", "", False, False)
    nodes, runs, stack = [root], [], [root]
    still_open: Counter = Counter()
    links = at = 0

    def pop(k: int) -> None:
        still_open.subtract(x.tag for x in stack[k:])
        del stack[k:]

    end = html.rfind(">") + 1  # no tag ends behind it, so none is looked for there
    for m in _TOKEN.finditer(html, 0, end):
        if m.start() > at:
            runs.append((stack[-1], html[at : m.start()], links > 0))
        at = m.end()
        tag = m[3]
        if not tag:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "a":
                links = 0 if m[2] else 1
            continue
        runs.append((stack[-1], "", False))
        if tag in VOID:
            continue
        links = 0
        if m[2]:
            if still_open[tag]:
                pop(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag))
            continue
        if tag == "body":
            while len(stack) > 1 and stack[-1].tag == "head":
                pop(-1)
        if stack[-1].tag == "p":
            pop(-1)
        while stack[-1].tag in CLOSES.get(tag, ()):
            pop(-1)
        up = stack[-1]
        classes, marked = "", False
        if m[4]:
            for a in _ATTRIBUTE.finditer(m[4]):
                value = (a[2] or a[3] or a[4] or "").lower()
                if a[1].lower() == "class" and not classes:
                    classes = "".join("." + _DIGITS.sub("#", c) for c in sorted(value.split()))
                marked = marked or marks_chrome(value)
        chrome = up.chrome or (tag in CHROME and not (tag == "header" and up.in_article)) or (marked and tag not in ("html", "body", "article", "main"))
        node = Node(up, tag, path_of(up.path, tag + classes), chrome, up.in_article or tag == "article")
        nodes.append(node)
        stack.append(node)
        still_open[tag] += 1
    if at < len(html):
        runs.append((stack[-1], html[at:], links > 0))
    return nodes, runs


def best_container(nodes: list[Node], runs: list[tuple[Node, str, bool]]) -> Node:
    for node, text, linked in runs:
        if not text or linked or node.chrome or not (n := len(text.strip())):
            continue
        holder = node.parent if node.tag not in ("div", "section", "article", "main", "body", "td", "") and node.parent else node
        holder.score += n
        if holder.parent:
            holder.parent.score += n / 2
    return max(nodes, key=lambda x: x.score)


def text_below(chosen: set[int], nodes: list[Node], runs: list[tuple[Node, str, bool]]) -> str:
    """Text of the containers, without chrome; blocks and white space are parted by one space."""
    for node in nodes:  # a node's parent comes before it
        node.kept = not node.chrome and (id(node) in chosen or (node.parent is not None and node.parent.kept))
    parts = [unescape(text) if text else " " for node, text, _ in runs if not text or node.kept]
    return " ".join("".join(parts).split())


def vote(html: str) -> tuple[str, float]:
    nodes, runs = parse(html)
    best = best_container(nodes, runs)
    return best.path, best.score


def extract(html: str, path: str | None) -> str:
    nodes, runs = parse(html)
    chosen = {id(x) for x in nodes if x.path == path and not x.chrome} if path else set()
    text = text_below(chosen, nodes, runs) if chosen else ""
    return text or text_below({id(best_container(nodes, runs))}, nodes, runs)


def _host(url):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def host_paths(pages: DataFrame) -> DataFrame:
    """host, path: the winner of each host, and the votes it has."""

    def run(batches):
        for batch in batches:
            found = [vote(x.as_py() or "") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([p for p, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], names=["host", "path", "score"])

    votes = pages.select(_host(F.col("url")).alias("host"), F.col("html").cast("string")).mapInArrow(run, "host string, path string, score double")
    tally = votes.where("score > 0").groupBy("host", "path").agg(F.count("*").alias("votes"), F.sum("score").alias("score"))
    best = Window.partitionBy("host").orderBy(F.desc("votes"), F.desc("score"), "path")
    return tally.withColumn("place", F.row_number().over(best)).where("place = 1").select("host", "path", "votes")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    winners = saved(host_paths(pages))
    small = winners.count() <= MAX_BROADCAST_HOSTS
    rows = pages.select("page_id", "url", "html", _host(F.col("url")).alias("host"))
    joined = rows.join(F.broadcast(winners) if small else winners, "host", "left")

    def run(batches):
        for batch in batches:
            texts = [extract(h.as_py() or "", p.as_py()) for h, p in zip(batch.column(2), batch.column(3), strict=True)]
            lengths = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), lengths], names=["page_id", "url", "text", "n_chars"])

    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    return joined.select("page_id", "url", F.col("html").cast("string"), "path").mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
