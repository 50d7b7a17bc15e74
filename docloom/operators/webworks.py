"""WebWorks pages (WW1-WW5, HIE8, JN16): class-driven blocks to Markdown, and trees whose links are places in a file index."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .html.dom import Element, parse, select, serialise

# What parts of class names stand for, in the order in which they are tried.
MARKS = (("Bold", "**"), ("Emphasis", "_"), ("Italic", "_"), ("Code", "`"))
HEADINGS = (("N1Heading", "# "), ("N2Heading", "## "), ("N3Heading", "### "), ("N4Heading", "#### "), ("MinorHead", "## "))
CALLOUTS = (("Note", "Note"), ("Warning", "Warning"), ("Caution", "Caution"), ("Tip", "Tip"))


def inline(e: Element) -> str:
    """WW1."""
    out = []
    for c in e.children:
        if isinstance(c, str):
            out.append(re.sub(r"\s+", " ", c))
        elif c.tag == "br":
            out.append("  \n")
        elif c.tag == "img":
            out.append(f"![{c.attrs.get('alt', '')}]({c.attrs.get('src', '')})")
        elif c.tag == "a":
            text, href = inline(c), c.attrs.get("href", "")
            out.append(f"[{text}]({re.sub('[.]html?$', '.md', href)})" if text.strip() and href and not href.startswith("javascript") else text)
        elif c.tag != "script":
            text = inline(c)
            mark = next((m for part, m in MARKS if any(part in k for k in c.classes)), "") if c.tag == "span" else ""
            out.append(f"{mark}{text}{mark}" if mark and text.strip() else text)
    return "".join(out)


def content_table(table: Element) -> str:
    """WW3: raw HTML if a cell has lists or tables, else a pipe table of rows of one width."""
    if any(c.all("ul", "ol", "table") for c in table.all("td", "th")):
        return serialise(table)
    rows = [[inline(c).strip().replace("\n", " ").replace("|", "\\|") for c in r.own("td", "th")] for r in table.all("tr")]
    rows = [r for r in rows if r]
    if not rows:
        return ""
    width = max(map(len, rows))
    lines = ["| " + " | ".join(r + [""] * (width - len(r))) + " |" for r in rows]
    return "\n".join([lines[0], "|" + " --- |" * width, *lines[1:]])


def _list_item(table: Element) -> tuple[str, str]:
    """WW2: (number, content): the first cell's number, ``1`` without one, and the second cell."""
    cells = table.all("td")
    number = re.search(r"\d+", cells[0].text()) if cells else None
    return number[0] if number else "1", inline(cells[1]).strip() if len(cells) > 1 else ""


def blocks(quote: Element) -> str:
    """WW4: blocks by class, parted by empty lines; neighbouring code lines share a fence."""
    out: list[str] = []
    code: list[str] = []

    def flush():
        if code:
            out.extend(["```", *code, "```"])
            code.clear()

    for e in quote.own():
        name = " ".join(e.classes)
        if "Code" in name and e.tag in ("div", "p", "pre"):
            code.append(e.text().strip("\n"))
            continue
        flush()
        heading = next((m for part, m in HEADINGS if part in name), None)
        callout = next((label for part, label in CALLOUTS if part in name), None)
        if e.tag == "table" or "_outer" in name and e.all("table"):
            table = e if e.tag == "table" else e.all("table")[0]
            if "Bullet" in name or "Bullet" in " ".join(table.classes):
                out.append(f"- {_list_item(table)[1]}")
            elif re.search("Step|Number", f"{name} {' '.join(table.classes)}"):
                out.append("{}. {}".format(*_list_item(table)))
            else:
                out.append(content_table(table))
        elif heading:
            out.append(heading + inline(e).strip())
        elif callout:
            out.append(f"> **{callout}:** {inline(e).strip()}")
        elif e.tag in ("ul", "ol"):
            out.extend(f"{'-' if e.tag == 'ul' else f'{i}.'} {inline(li).strip()}" for i, li in enumerate(e.own("li"), 1))
        else:
            out.append(inline(e).strip())
    flush()
    return "\n\n".join(x for x in out if x)


def convert_file(html: str) -> tuple[str, str | None]:
    """WW5: (title, body); no block quote: no body."""
    root = parse(html or "")
    title = " ".join(next(iter(root.all("title")), Element("")).text().split())
    quote = next(iter(select(root, "blockquote")), None)
    return title, None if quote is None else blocks(quote) + "\n"


def convert_files(files: DataFrame) -> DataFrame:
    """(path, title, body, source_path, error) of pages (path, html)."""

    def run(batches):
        for batch in batches:
            rows = []
            for h in batch.column(1):
                try:
                    rows.append((*convert_file(h.as_py()), None))
                except Exception as e:  # a file that can't be read is a row
                    rows.append((None, None, f"{type(e).__name__}: {e}"))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([r[k] for r in rows], pa.string()) for k in range(3)]], names=["path", "title", "body", "error"])

    done = files.select("path", "html").mapInArrow(run, "path string, title string, body string, error string")
    return done.withColumn("source_path", F.regexp_extract("path", r"(?:^|.*?/)cache/(.*)$", 1))


def toc_rows(xml: str) -> list[tuple[list[int], str, str]]:
    """HIE8: (path of places, title, link) of nested ``i`` elements in order; broken XML: nothing."""
    try:
        root = ET.fromstring(xml)
    except ET.ParseError:
        return []
    out: list = []

    def walk(e, path):
        for k, c in enumerate(x for x in e if x.tag.rsplit("}", 1)[-1] == "i"):
            out.append(([*path, k], c.get("t", ""), c.get("l", "")))
            walk(c, [*path, k])

    walk(root, [])
    return out


def resolve_places(nodes: DataFrame, index: DataFrame) -> DataFrame:
    """JN16: links ``N#anchor`` to the N-th file of the guide's index; a place outside it gives an empty file."""
    rows = nodes.withColumn("place", F.expr("try_cast(regexp_extract(link, '^([0-9]+)', 1) AS int)")).withColumn("anchor", F.regexp_extract("link", "#(.*)$", 1))
    return rows.join(index.select("guide", "place", "href"), ["guide", "place"], "left").withColumn("file", F.coalesce("href", F.lit(""))).drop("href")
