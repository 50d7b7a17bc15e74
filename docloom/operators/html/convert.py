"""HTM18: one Arrow pass a page turns HTML into metadata, Markdown, links, images and counts; failures are rows with an error."""

from __future__ import annotations

import re
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.compute as pc
import yaml
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...config import Settings
from ...functions import urls
from . import gfm, passes
from .dom import Element, parse, select

SCHEMA = (
    "page_id {id}, url string, title string, lang string, topic_type string, toc_path string, guid string, description string, h1 string, body string, "
    "links array<struct<text:string,href:string>>, images array<string>, stats map<string,int>, skipped string, error string"
)
#: Bytes that a split of a file has at least, where a table is not small.
SPLIT = 32 << 20
#: Bytes of text that are converted before they are handed on, and what a row counts beside its text.
SLICE, ROW = 1 << 20, 1 << 10
_ARROW = pa.schema(
    [
        *[(n, pa.string()) for n in ("url", "title", "lang", "topic_type", "toc_path", "guid", "description", "h1", "body")],
        ("links", pa.list_(pa.struct([("text", pa.string()), ("href", pa.string())]))), ("images", pa.list_(pa.string())), ("stats", pa.map_(pa.string(), pa.int32())),
        ("skipped", pa.string()), ("error", pa.string()),
    ]
)


def _words(e: Element | None) -> str:
    return " ".join(e.text().split()) if e is not None else ""


def _meta(root: Element, name: str) -> str:
    return next((e.attrs.get("content", "") for e in root.all("meta") if e.attrs.get("name", "").lower() == name.lower()), "")


def page_metadata(root: Element) -> dict[str, str]:
    """PRJ10."""
    html = next(iter(root.all("html")), None)
    attrs = html.attrs if html is not None else {}
    classes = " ".join(e.attrs.get("class", "") for e in root.all("html", "body"))
    return {
        "title": _words(next(iter(root.all("title")), None)), "lang": attrs.get("lang") or attrs.get("xml:lang") or "en-us",
        "topic_type": next((t for t in ("concept", "task", "reference") if t in classes), ""), "toc_path": attrs.get("data-mc-toc-path", ""),
    }


def dita_metadata(root: Element) -> dict[str, str]:
    """PRJ11."""
    own = page_metadata(root)
    crumbs = [_words(e) for e in select(root, "#breadcrumbs .crumb")]
    return {
        "title": own["title"].split(" - ")[0], "lang": own["lang"].replace("_", "-").lower(), "topic_type": _meta(root, "DC.type"), "guid": _meta(root, "DC.identifier"),
        "description": _meta(root, "description") or _meta(root, "abstract"), "toc_path": "|".join(c for c in crumbs if c and c.lower() != "home"),
    }


def convert_page(url: str, html: str | bytes, s: Settings = Settings(), dita: bool = False) -> dict:
    root = parse(html or "")
    meta = dita_metadata(root) if dita else page_metadata(root)
    out = {"url": url, "links": [], "images": [], "stats": {}, "skipped": None, "error": None, "body": None} | meta
    h1 = next(iter(root.all("h1")), None)
    out["h1"] = _words(h1)
    if dita and not _meta(root, "DC.type"):
        return out | {"skipped": "no-topic-type"}
    content = next((found[0] for q in s.content_selectors if (found := select(root, q))), None)
    if content is None:
        return out | {"skipped": "no-content"}
    out["title"] = out["title"] or out["h1"] or re.sub(r"\.[^.]*$", "", urlsplit(url or "").path.rsplit("/", 1)[-1])
    links = [{"text": " ".join(a.text().split()), "href": a.attrs["href"]} for a in root.all("a") if a.attrs.get("href")]
    order = (passes.dita_passes if dita else passes.topic_passes)(s.chrome_selectors, s.cell_block_tags)
    stats = passes.run(content, order)
    images = [e.attrs["src"] for e in content.all("img") if e.attrs.get("src")]
    raw = passes.take_raw_tables(content)
    stats["tier3_passthrough"] = len(raw)
    body = gfm.clean(gfm.render(content))
    for key, table in raw.items():
        body = body.replace(key, f"\n{table}\n")
    return out | {"body": gfm.clean(body) if raw else body, "links": links, "images": images, "stats": stats}


def slices(batch: pa.RecordBatch, column: int):
    """``batch`` in order, in parts whose texts in ``column`` come to about ``SLICE`` bytes: a worker holds what it made of one part, however many rows Spark hands over."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    lo = held = 0
    for at, n in enumerate(sizes, 1):
        held += n + ROW
        if held >= SLICE or at == len(sizes):
            yield batch.slice(lo, at - lo)
            lo, held = at, 0


def convert_pages(pages: DataFrame, s: Settings = Settings(), dita: bool = False) -> DataFrame:
    kind = pages.schema["page_id"].dataType.simpleString()
    cores = pages.sparkSession.sparkContext.defaultParallelism
    size = int(str(pages._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size < cores * SPLIT:  # a small table has fewer splits than there are cores
        pages = pages.repartition(cores)

    def run(batches):
        for batch in (own for whole in batches for own in slices(whole, 2)):
            rows = []
            for url, html in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                try:
                    rows.append(convert_page(url, html.as_py() or "", s, dita))
                except Exception as e:  # a page that can't be read is a row, not an end of the job
                    rows.append({"url": url, "error": f"{type(e).__name__}: {e}"})
            arrays = [pa.array([list(r[f.name].items()) if f.name == "stats" and r.get("stats") else r.get(f.name) or (None if f.name != "stats" else []) for r in rows], f.type) for f in _ARROW]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=["page_id", *_ARROW.names])

    return pages.select("page_id", F.col("url").cast("string"), "html").mapInArrow(run, SCHEMA.format(id=kind))


def front_matter(meta: dict, keep_empty: bool = False) -> str:
    """SNK2: keys in order of the alphabet, empty values left out but for 0."""
    own = {k: v for k, v in meta.items() if keep_empty or v or v == 0 and v is not False}
    return f"---\n{yaml.safe_dump(own, allow_unicode=True, default_flow_style=False)}---\n\n"


def read_front_matter(text: str) -> tuple[dict, str]:
    """SRC39: the YAML head and the rest; a text without one, or with a broken one, gives an empty head."""
    if not text.startswith("---\n") or (end := text.find("\n---\n", 3)) < 0:
        return {}, text
    try:
        head = yaml.safe_load(text[4 : end + 1])
    except yaml.YAMLError:
        head = None
    return (head, text[end + 5 :]) if isinstance(head, dict) else ({}, text)


def rewrite_front_matter(text: str, changes: dict) -> str:
    """SNK3."""
    head, rest = read_front_matter(text)
    return front_matter(head | changes) + rest.lstrip()


def documents(converted: DataFrame) -> DataFrame:
    """SNK1: output path and whole Markdown document of each converted page."""

    def run(batches):
        for batch in (own for whole in batches for own in slices(whole, 6)):
            texts = []
            for r in batch.to_pylist():
                meta = {"title": r["title"], "lang": r["lang"], "topic_type": r["topic_type"], "toc_path": r["toc_path"], "source_url": r["url"]}
                texts.append(front_matter(meta) + (r["body"] or ""))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["output_path", "document"])

    ready = converted.where(F.col("error").isNull() & F.col("skipped").isNull())
    return ready.select(urls.output_path(F.col("url")).alias("output_path"), "title", "lang", "topic_type", "toc_path", "url", "body").mapInArrow(run, "output_path string, document string")
