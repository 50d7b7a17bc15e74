"""Release notes from span tables (PDF1-PDF14, JN15): predicates are columns, a page or document is a bounded group.

A span row: doc, page, page_h, block, block_x0, block_y0, block_y1, line, line_y, span, text, font, size, flags, x0, x1.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Fonts, limits and zones of the page.
GLYPH_FONTS = ("Wingdings", "Symbol", "ZapfDingbats")
BULLET_LETTERS = "ol\u25e6\u25cf\u2022\u25a0\u25aa\u25ab\u2013"
CODE_FONTS = ("SourceCode", "Consolas", "Menlo", "Inconsolata", "LucidaConsole", "Mono")
TOP, BOTTOM = 0.08, 0.92
DEFAULT_SIZE = 12.0
LISTED = ("bullet", "sub_bullet")
#: Letters of bodies that are handed on at once.
PART = 1 << 20


def is_glyph(font: Column, size: Column, text: Column) -> Column:
    """PDF1: a symbol font, or one small bullet letter in a typewriter font."""
    out = F.lit(False)
    for f in GLYPH_FONTS:
        out = out | F.startswith(font, F.lit(f))
    return out | (F.contains(font, F.lit("Courier")) & (size < 10) & F.trim(text).isin(*BULLET_LETTERS))


def is_code(font: Column, size: Column, text: Column) -> Column:
    """PDF2."""
    out = F.lit(False)
    for f in CODE_FONTS:
        out = out | F.contains(font, F.lit(f))
    return out & ~is_glyph(font, size, text)


def is_bold(flags: Column) -> Column:
    """PDF3."""
    return flags.bitwiseAND(16) != 0


def meaningful(spans: DataFrame) -> DataFrame:
    """PDF4: spans with more than white space or no-break spaces."""
    return spans.where(~F.col("text").rlike(r"^(?U:\s| )*$"))


def body_size(spans: DataFrame) -> DataFrame:
    """PDF7, AGG13: (doc, body): of pages 2 to 6, inside the zone, the size with most letters; ties: the smaller."""
    zone = (F.col("block_y0") >= TOP * F.col("page_h")) & (F.col("block_y1") <= BOTTOM * F.col("page_h"))
    sums = meaningful(spans).where(F.col("page").between(1, 5) & zone).groupBy("doc", F.round("size", 1).alias("body")).agg(F.sum(F.length("text")).alias("n"))
    best = sums.withColumn("_k", F.row_number().over(Window.partitionBy("doc").orderBy(F.desc("n"), "body"))).where("_k = 1").select("doc", "body")
    return spans.select("doc").distinct().join(best, "doc", "left").select("doc", F.coalesce("body", F.lit(DEFAULT_SIZE)).alias("body"))


def repeated_headings(spans: DataFrame, pages: int = 2) -> DataFrame:
    """PDF8, AGG14: short bold texts that begin blocks on so many pages."""
    first = Window.partitionBy("doc", "page", "block").orderBy("line", "span")
    rows = meaningful(spans).withColumn("_k", F.row_number().over(first))
    blocks = rows.groupBy("doc", "page", "block").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "span", "text"))), lambda s: s["text"]), "").alias("text"), F.bool_or((F.col("_k") == 1) & is_bold(F.col("flags"))).alias("bold")
    )
    short = blocks.withColumn("text", F.trim("text")).where(F.col("bold") & F.length("text").between(1, 59))
    return short.groupBy("doc", "text").agg(F.count_distinct("page").alias("n")).where(F.col("n") >= pages).select("doc", "text")


def block_class(first: Column, second_bold: Column, body: Column, text: Column) -> Column:
    """PDF5: of a block's first meaningful span (font, size, flags, text)."""
    size, bold = first["size"], is_bold(first["flags"])
    glyph = is_glyph(first["font"], size, first["text"])
    small_heading = bold & (size >= body - 1) & (F.length(text) < 120) & ~text.rlike(r"[.?!]$")
    return (
        F.when(first.isNull(), "skip").when(F.startswith(first["font"], F.lit("Wingdings")) & second_bold, "h3").when(F.startswith(first["font"], F.lit("Wingdings")), "bullet").when(glyph, "sub_bullet")
        .when(size >= body + 5, "h1").when(size >= body + 2, "h2").when(small_heading, "h3").otherwise("body")
    )


def blocks(spans: DataFrame, tables: DataFrame | None = None) -> DataFrame:
    """PDF5, PDF6, PDF10, JN15: (doc, page, block, y, x, kind, text) inside the page's zone and outside its tables."""
    rows = meaningful(spans).join(body_size(spans), "doc")
    rows = rows.where((F.col("block_y0") >= TOP * F.col("page_h")) & (F.col("block_y1") <= BOTTOM * F.col("page_h")))
    if tables is not None:
        rects = tables.groupBy("doc", "page").agg(F.collect_list(F.struct("x0", "y0", "x1", "y1")).alias("rects"))
        rows = rows.join(rects, ["doc", "page"], "left").where(~F.coalesce(F.exists("rects", lambda r: (r["y0"] < F.col("block_y1")) & (r["y1"] > F.col("block_y0")) & (r["x1"] > F.col("block_x0"))), F.lit(False)))
    # A space parts spans on new lines, behind a gap, or where a word's end meets a capital.
    order = Window.partitionBy("doc", "page", "block").orderBy("line", "span")
    before = lambda c: F.lag(c).over(order)
    joint = (F.abs(F.col("line_y") - before("line_y")) >= 2) | (F.col("x0") - before("x1") > 0.5) | (before("text").rlike("[A-Za-z0-9]$") & F.col("text").rlike("^[A-Z]")) | (F.col("line") != before("line"))
    code = is_code(F.col("font"), F.col("size"), F.col("text"))
    glyph = is_glyph(F.col("font"), F.col("size"), F.col("text"))
    piece = F.concat(F.when(joint, " ").otherwise(""), F.when(glyph, F.lit("")).when(code, F.concat(F.lit("`"), F.trim("text"), F.lit("`"))).otherwise(F.col("text")))
    rows = rows.withColumn("piece", piece).withColumn("_k", F.row_number().over(order))
    own = F.struct("font", "size", "flags", "text")
    grouped = rows.groupBy("doc", "page", "block", "body").agg(
        F.first("block_y0").alias("y"), F.first("block_x0").alias("x"), F.max(F.when(F.col("_k") == 1, own)).alias("first"), F.max(F.when(F.col("_k") == 2, is_bold(F.col("flags")))).alias("second_bold"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "span", "piece"))), lambda s: s["piece"]), "").alias("text"),
    )
    text = F.trim(F.regexp_replace("text", r"(?U)\s+", " "))
    kind = block_class(F.col("first"), F.coalesce("second_bold", F.lit(False)), F.col("body"), text)
    return grouped.select("doc", "page", "block", "body", "y", "x", kind.alias("kind"), text.alias("text")).where("text <> ''")


def page_lines(found: DataFrame) -> DataFrame:
    """PDF10: (doc, page, seq, kind, text): blocks from top to bottom; columns of one height are one, indented text goes on with its bullet."""
    order = Window.partitionBy("doc", "page").orderBy("y", "block")
    before = lambda c: F.lag(c).over(order)
    column = (F.abs(F.col("y") - before("y")) < 1.5 * F.col("body")) & (F.col("x") > before("x") + F.col("body")) & (F.col("kind") == "body")
    margin = F.min("x").over(Window.partitionBy("doc", "page"))
    goes_on = (F.col("kind") == "body") & before("kind").isin("bullet", "sub_bullet") & (F.col("x") > margin + 10)
    marked = found.withColumn("_new", F.when(F.coalesce(column | goes_on, F.lit(False)), 0).otherwise(1))
    group = F.sum("_new").over(order)
    rows = marked.withColumn("seq", group).groupBy("doc", "page", "seq").agg(F.array_sort(F.collect_list(F.struct("y", "block", "kind", "text"))).alias("parts"))
    return rows.select("doc", "page", "seq", F.get("parts", F.lit(0))["kind"].alias("kind"), F.array_join(F.transform("parts", lambda p: p["text"]), " ").alias("text"))


def _contents(over: Callable[[Column], Column]) -> Column:
    """PDF11 of a page's lines; ``over`` gives each aggregate its rows."""
    share = over(F.avg(F.col("text").rlike(r"([A-Za-z\u00ae\u00a9\u2122]|\s)\d{1,3}$").cast("double")))
    headed = over(F.bool_or(F.col("kind").isin("h1", "h2", "h3") & F.lower(F.trim("text")).isin("contents", "table of contents")))
    return headed | ((over(F.count("*")) >= 3) & (share > 0.6))


def contents_pages(lines: DataFrame) -> DataFrame:
    """PDF11: pages headed ``Contents``, or of at least three lines of which over six tenths end in a page number."""
    return lines.groupBy("doc", "page").agg(_contents(lambda c: c).alias("_contents")).where("_contents").select("doc", "page")


def markdown_line(kind: Column, text: Column) -> Column:
    marks = {"h1": "# ", "h2": "## ", "h3": "### ", "bullet": "- ", "sub_bullet": "  - "}
    out = text
    for k, m in marks.items():
        out = F.when(kind == k, F.concat(F.lit(m), text)).otherwise(out)
    return out


def render_table(rows: list[list[str | None]]) -> str:
    """PDF9: a pipe table, or HTML where a cell has lines or over 150 letters."""
    cells = [[c or "" for c in r] for r in rows if r]
    if not cells:
        return ""
    if any("\n" in c or len(c) > 150 for r in cells for c in r):
        body = "".join("<tr>" + "".join(f"<{t}>{c.replace(chr(10), '<br/>')}</{t}>" for c in r) + "</tr>" for i, r in enumerate(cells) for t in ["td" if i else "th"])
        return f"<table>{body}</table>"
    width = max(map(len, cells))
    lines = ["| " + " | ".join(c.replace("|", "\\|") for c in r + [""] * (width - len(r))) + " |" for r in cells]
    return "\n".join([lines[0], "|" + " --- |" * width, *lines[1:]])


def table_rows(lines: list[str], prefix: str = "GS") -> list[str]:
    """PDF13: rows of tables that the layout lost, put together from body lines.

    A line that begins with an issue key opens a row; lines behind it belong to its summary until a heading, a table line or the next key.  The first
    such row of a section gets a head.  Below a head that names the SOAP or the REST API, lines of two names are rows.
    Blank lines inside a table go; any other line ends it.
    """
    key = re.compile(rf"({re.escape(prefix)}-\d+)\s+(.*)", re.S)
    out: list[str] = []
    kind, row = "", None

    def close() -> None:
        nonlocal kind, row
        if row is None:
            return
        if kind != "issues":
            out.extend([""] if out and out[-1].strip() else [])
            out.extend(["| Key | Summary |", "| --- | --- |"])
            kind = "issues"
        out.append(f"| {row[0]} | {' '.join(' '.join(row[1:]).split())} |")
        row = None

    for line in lines:
        text = line.strip()
        if not text:
            if row is None and not kind:
                out.append(line)
        elif text[0] == "#":
            close()
            out.extend(["", line] if out and out[-1].strip().startswith("|") else [line])
            kind = ""
        elif text[0] == "|":
            close()
            if "SOAP API" in text or "REST API" in text:
                kind = "names"
            elif "Key" in text and "Summary" in text:
                kind = "issues"
            out.append(line)
        elif found := key.match(text):
            close()
            row = [found[1], found[2]]
        elif row is not None:
            row.append(text)
        elif kind == "names" and " " in text and text[0] != "-":
            out.append("| {} | {} |".format(*text.split(" ", 1)))
        else:
            kind = ""
            out.append(line)
    close()
    return out


def cut_boilerplate(text: str, headings: tuple[str, ...]) -> str:
    """PDF14: the first top heading of those named ends the document."""
    at = [m.start() for h in headings for m in re.finditer(rf"^# {re.escape(h)}\s*$", text, re.M)]
    out = text[: min(at)] if at else text
    return re.sub(r"\n{3,}", "\n\n", out).strip() + "\n"


def convert(spans: DataFrame, tables: DataFrame | None = None, boilerplate: tuple[str, ...] = (), prefix: str = "GS") -> DataFrame:
    """PDF12: (doc, body): pages but the first, empty ones and contents, in order; headings repeated over pages are left out.

    Lines come to Python sorted, in Arrow batches; a worker holds one document's lines and about ``PART`` letters of bodies.
    """
    page = Window.partitionBy("doc", "page")
    lines = page_lines(blocks(spans, tables)).where("page > 0")
    lines = lines.withColumn("_contents", _contents(lambda c: c.over(page))).where(~F.coalesce("_contents", F.lit(False)))
    lines = lines.join(repeated_headings(spans), ["doc", "text"], "left_anti")
    ready = lines.repartition("doc").sortWithinPartitions("doc", "page", "seq").select("doc", "kind", markdown_line(F.col("kind"), F.col("text")).alias("line"))

    def own_lines(batches):
        """(document, its lines) in order; a blank line parts what is not one list."""
        doc, out, last = None, [], ""
        for batch in batches:
            for own, kind, line in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if out and own != doc:
                    yield doc, out
                    out = []
                if out and not (kind in LISTED and last in LISTED):
                    out.append("")
                out.append(line)
                doc, last = own, kind
        if out:
            yield doc, out

    def run(batches):
        docs, bodies, held = [], [], 0

        def made():
            return pa.RecordBatch.from_arrays([pa.array(docs, kind), pa.array(bodies, pa.string())], names=["doc", "body"])

        first = next(batches, None)
        if first is None:
            return
        kind = first.schema.field(0).type
        for doc, out in own_lines(chain([first], batches)):
            docs.append(doc)
            bodies.append(cut_boilerplate("\n".join(table_rows(out, prefix)), boilerplate))
            held += len(bodies[-1]) + 100
            if held >= PART:
                yield made()
                docs, bodies, held = [], [], 0
        if docs:
            yield made()

    return ready.mapInArrow(run, f"doc {spans.schema['doc'].dataType.simpleString()}, body string")
