"""What is embedded in scripts and lists (SRC28-SRC35, SRC37, FN10, FN11): parsers over text, and table functions that make rows of them."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from ..functions.text import unescape_js
from ..operators.html.dom import Element, parse


def balanced(text: str, start: int, opener: str = "[", closer: str = "]", strings: bool = False) -> str:
    """FN11: from the opener at ``start`` to its closer; with ``strings``, brackets inside quotes don't count.  Unbalanced: empty."""
    depth, quote, i = 0, "", start
    while i < len(text):
        c = text[i]
        if quote:
            if c == "\\":
                i += 1
            elif c == quote:
                quote = ""
        elif strings and c in "\"'":
            quote = c
        elif c == opener:
            depth += 1
        elif c == closer:
            depth -= 1
            if depth == 0:
                return text[start : i + 1]
        i += 1
    return ""


def _object_after(script: str, name: str) -> dict:
    at = re.search(rf"{re.escape(name)}\s*=\s*", script)
    if not at or not script[at.end() :].startswith("{"):
        return {}
    try:
        found = json.loads(balanced(script, at.end(), "{", "}", strings=True))
    except ValueError:
        return {}
    return found if isinstance(found, dict) else {}


def contexts(script: str) -> dict[str, str]:
    """SRC30."""
    return {str(k): str(v) for k, v in _object_after(script, "suitehelp.contexts").items()}


def toc_html(script: str) -> str:
    """SRC31."""
    return str(_object_after(script, "suitehelp.toc").get("toc", ""))


def toc_tree(script: str) -> list[tuple[int, int | None, int, int]]:
    """SRC29: (node id, parent's place or None, place, depth) of ``tree:{n:[...]}`` in depth-first order; anything else: nothing."""
    at = re.search(r"tree\s*:\s*\{\s*n\s*:\s*\[", script)
    if not at:
        return []
    try:
        nodes = json.loads(re.sub(r"([{,]\s*)([icn])\s*:", r'\1"\2":', balanced(script, at.end() - 1)))
    except ValueError:
        return []
    out: list = []
    stack = [(n, None, 0) for n in reversed(nodes)]
    while stack:
        node, up, depth = stack.pop()
        place = len(out)
        out.append((int(node.get("i", -1)), up, place, depth))
        stack.extend((k, place, depth + 1) for k in reversed(node.get("n", [])))
    return out


def chunk_entries(files: DataFrame) -> DataFrame:
    """SRC28, natively: (version, node_id, url, title) of chunk scripts (version, name, text); the last of an id by file and place counts."""
    pattern = r"'([^']*\.html?)':\{i:\[(\d+)\],t:\['((?:[^'\\]|\\.)*)'\]"
    group = lambda k: F.regexp_extract_all("text", F.lit(pattern), F.lit(k))
    rows = files.select("version", "name", F.posexplode(F.arrays_zip(group(1).alias("url"), group(2).alias("id"), group(3).alias("title"))).alias("at", "x"))
    last = F.struct("name", "at")
    return rows.groupBy("version", F.col("x.id").cast("int").alias("node_id")).agg(F.max_by("x.url", last).alias("url"), unescape_js(F.max_by("x.title", last)).alias("title"))


def redirect_id(path: Column) -> Column:
    """SRC37: the digits at the end of a redirect file's name."""
    return F.regexp_extract(path, r"(\d+)\.[^./]+$", 1)


def redirects(files: DataFrame) -> DataFrame:
    """SRC37: (version, csh_id, guide, topic) of redirect pages (version, path, text)."""
    target = r"\?context=([^&\"']+)&(?:amp;)?topic=([^&\"']+)"
    return files.select("version", redirect_id(F.col("path")).cast("int").alias("csh_id"), F.regexp_extract("text", target, 1).alias("guide"), F.regexp_extract("text", target, 2).alias("topic")).where("csh_id IS NOT NULL AND guide <> ''")


def _items(list_: Element, ancestors: list[str], depth: int):
    for li in list_.own("li"):
        link = next(iter(li.own("a")), None)
        if link is None:
            continue
        title = " ".join(link.text().split())
        yield link.attrs.get("href", ""), title, list(ancestors), depth
        for below in li.own("ul", "ol"):
            yield from _items(below, [*ancestors, title], depth + 1)


def nested_list(html: str) -> list[tuple[str, str, list[str], int]]:
    """SRC32, HIE5, HIE6: (href, title, ancestors, depth) in order; an item without a link of its own is left out with all below it."""
    root = parse(html.replace("%APPROOT%", ""))
    tops = [e for e in root.all("ul", "ol") if not e.is_inside("ul", "ol")]
    return [row for top in tops for row in _items(top, [], 0)]


def guides(html: str) -> list[str]:
    """SRC34: first part of each book's link, without ``../``, in order and once."""
    links = [a.attrs.get("href", "").replace("../", "") for d in parse(html).all("div") for a in d.own("a")]
    return list(dict.fromkeys(x.split("/")[0] for x in links if x))


def file_index(html: str) -> list[tuple[str, str]]:
    """SRC35: (href, title) by place from 0."""
    return [(a.attrs.get("href", ""), a.attrs.get("title") or " ".join(a.text().split())) for a in parse(html).all("a") if a.attrs.get("href")]


def is_version_level(html: str) -> bool:
    """SRC33: a list of books whose links climb or descend at least three folders."""
    return any(a.attrs.get("href", "").count("/") >= 3 for a in parse(html).all("a"))


def webworks_versions(books: DataFrame) -> DataFrame:
    """SRC33: (root, version) of pages (path, html) ``wwhelp/books.htm`` that list a version's books."""
    level = F.exists(F.regexp_extract_all("html", F.lit(r"(?i)<a\b[^>]*\bhref\s*=\s*[\"']([^\"']*)"), F.lit(1)), lambda x: F.length(x) - F.length(F.replace(x, F.lit("/"), F.lit(""))) >= 3)
    number = F.get(F.filter(F.split("path", "/"), lambda p: p.rlike(r"^\d+\.\d+")), F.lit(0))
    rows = books.where(F.col("path").rlike(r"(^|/)wwhelp/books\.htm$") & level)
    return rows.select(F.regexp_extract("path", r"^(.*?)/?wwhelp/books\.htm$", 1).alias("root"), number.alias("version"))


@udtf(returnType="node_id int, parent int, place int, depth int")
class TocTree:
    def eval(self, script: str):
        yield from toc_tree(script or "")


@udtf(returnType="name string, target string")
class Contexts:
    def eval(self, script: str):
        yield from contexts(script or "").items()


@udtf(returnType="place int, href string, title string, ancestors array<string>, depth int")
class NestedList:
    def eval(self, html: str):
        for i, row in enumerate(nested_list(html or "")):
            yield i, *row


@udtf(returnType="place int, href string, title string")
class FileIndex:
    def eval(self, html: str):
        for i, row in enumerate(file_index(html or "")):
            yield i, *row


def register(spark) -> None:
    """The table functions as SQL names."""
    for name, f in {"toc_tree": TocTree, "help_contexts": Contexts, "nested_list": NestedList, "file_index": FileIndex}.items():
        spark.udtf.register(name, f)
