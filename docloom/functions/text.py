"""Text functions as native columns (FN1-FN3, FN8-FN10, FN13, HTM17, PRJ13, PRJ14)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN = r"\[%=[\w.\s]*%\]"


def count_tokens(text: Column) -> Column:
    """FN1: unresolved variables that ``strip_tokens`` removes."""
    return F.regexp_count(text, F.lit(TOKEN))


def strip_tokens(text: Column) -> Column:
    return F.regexp_replace(text, TOKEN, "")


def clean_toc_path(path: Column) -> Column:
    """FN2: no variables, parts trimmed, empty ones dropped."""
    parts = F.transform(F.split(strip_tokens(path), r"\|"), lambda x: F.regexp_replace(x, r"^(?U:\s)+|(?U:\s)+$", ""))
    return F.array_join(F.filter(parts, lambda x: x != ""), "|")


def slugify(title: Column, longest: int = 50) -> Column:
    """FN3."""
    full = F.regexp_replace(F.regexp_replace(F.lower(title), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    cut = F.substring(full, 1, longest)
    short = F.when(F.instr(cut, "-") > 0, F.regexp_replace(cut, "-[^-]*$", "")).otherwise(cut)
    return F.when(full == "", F.lit("topic")).when(F.length(full) > longest, short).otherwise(full)


def topic_type(classes: Column) -> Column:
    """FN8."""
    out = F.when(F.contains(classes, F.lit("concept")), F.lit("concept"))
    return out.when(F.contains(classes, F.lit("task")), F.lit("task")).when(F.contains(classes, F.lit("reference")), F.lit("reference"))


def collapse(text: Column) -> Column:
    """FN9: runs of white space, no-break spaces too, become one space."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def unescape_js(text: Column) -> Column:
    """FN10."""
    return F.replace(text, F.lit("\\'"), F.lit("'"))


def title_head(title: Column) -> Column:
    """FN13: what stands before the first `` - ``."""
    return F.split_part(title, F.lit(" - "), F.lit(1))


def clean_markdown(text: Column) -> Column:
    """HTM17: at most one blank line, no spaces at line ends, a space between a closing marker and the word behind it."""
    out = F.regexp_replace(text, "\n{3,}", "\n\n")
    out = F.regexp_replace(out, "(?U)[^\\S\n]+(?=\n|$)", "")
    out = F.regexp_replace(out, r"(?<=\S)\*\*(?=[a-zA-Z0-9])", "** ")
    out = F.regexp_replace(out, r"(?<=\S)`(?=[a-zA-Z0-9])", "` ")
    return F.concat(F.regexp_replace(out, r"^(?U:\s)+|(?U:\s)+$", ""), F.lit("\n"))


def duration(seconds: Column) -> Column:
    """PRJ13: ``1h 2m 3s`` without hours or minutes that are zero."""
    s = seconds.cast("long")
    h, m = F.floor(s / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60)
    return F.concat_ws(" ", F.when(h > 0, F.concat(h.cast("string"), F.lit("h"))), F.when(m > 0, F.concat(m.cast("string"), F.lit("m"))), F.concat(F.pmod(s, F.lit(60)).cast("string"), F.lit("s")))


def stage_seconds(pages: Column, rates: dict, images_per_page: float) -> dict[str, Column]:
    """PRJ14: seconds by stage, and ``total``."""
    out = {k: pages / F.lit(float(v)) for k, v in rates.items() if k != "images"}
    out["images"] = F.floor(pages * images_per_page) / F.lit(float(rates["images"]))
    total = None
    for v in out.values():
        total = v if total is None else total + v
    return out | {"total": total}
