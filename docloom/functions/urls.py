"""URL and path functions as native columns (PRJ1-PRJ8, PRJ12, FN5, FN12, SRC25).  A URL that has no path gives NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_PATH = r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)"


def url_path(url: Column) -> Column:
    """The path of an absolute URL, or the whole of a bare path before its query and fragment."""
    return F.when(url.rlike(_PATH), F.regexp_extract(url, _PATH, 1)).otherwise(F.regexp_extract(url, r"^([^?#]*)", 1))


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


def cache_path(url: Column) -> Column:
    """SRC25: the path without leading slashes."""
    return F.regexp_replace(url_path(url), "^/+", "")


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def extension(path: Column) -> Column:
    """Last suffix with its dot; dots that a name begins with make none."""
    return F.regexp_extract(file_name(path), r"[^.].*(\.[^.]+)$", 1)


def with_suffix(path: Column, suffix: str) -> Column:
    """The last suffix replaced; a name without one gets it appended."""
    return F.when(F.length(file_name(path)) > 0, F.regexp_replace(path, r"^(.*/)?(\.*[^./][^/]*?)(\.[^./]+)?$", "$1$2" + suffix))


def output_path(url: Column) -> Column:
    """PRJ1."""
    return with_suffix(cache_path(url), ".md")


def parent(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def html_base(path: Column) -> Column:
    """Up to and with ``/doc/html/``, else the grandparent folder."""
    return F.when(F.instr(path, "/doc/html/") > 0, F.regexp_extract(path, r"^(.*?/doc/html/)", 1)).otherwise(F.concat(parent(parent(path)), F.lit("/")))


def alias_url(url: Column) -> Column:
    """PRJ2: where a topic's help-ID file is expected."""
    return F.concat(F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1), html_base(url_path(url)), F.lit("Data/Alias.xml"))


def zip_url(url: Column, sitemap: Column, version: Column) -> Column:
    """PRJ3: the archive of a version, from a page, its version sitemap and its number."""
    parts = F.split(cache_path(url), "/")
    stem = F.regexp_replace(file_name(url_path(sitemap)), r"\.[^.]*$", "")
    short = F.regexp_replace(stem, F.concat(F.lit("-"), F.replace(version, F.lit("."), F.lit("-")), F.lit("$")), F.lit(""))
    base = F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    return F.concat(base, F.lit("/pub/"), F.get(parts, F.lit(1)), F.lit("/"), version, F.lit("/"), short, F.lit("-"), F.replace(version, F.lit("."), F.lit("-")), F.lit("_documentation.zip"))


def root_of_alias(alias: Column) -> Column:
    """PRJ4: grandparent of the help-ID file, without a leading slash, with a closing one."""
    return F.concat(parent(parent(cache_path(alias))), F.lit("/"))


def root_of_output(path: Column) -> Column:
    """PRJ5."""
    return F.regexp_replace(html_base(path), "^/+", "")


def public_url(alias: Column) -> Column:
    """PRJ6: host and the first three parts of the path."""
    base = F.regexp_extract(alias, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    return F.concat(base, F.lit("/"), F.array_join(F.slice(F.split(cache_path(alias), "/"), 1, 3), "/"))


def product_slug(sitemap: Column, prefix: str = "") -> Column:
    """PRJ7."""
    stem = F.regexp_replace(file_name(url_path(sitemap)), r"\.[^.]*$", "")
    return F.when(F.startswith(stem, F.lit(prefix)), F.substring(stem, len(prefix) + 1, 1 << 20)).otherwise(stem)


def product_name(slug: Column) -> Column:
    return F.initcap(F.replace(slug, F.lit("-"), F.lit(" ")))


def comparable(path: Column) -> Column:
    """PRJ8: forward slashes, no leading slash, lower case."""
    return F.lower(F.regexp_replace(F.translate(path, "\\", "/"), "^/+", ""))


def version_key(sitemap: Column) -> Column:
    """PRJ12."""
    return F.replace(F.regexp_replace(url_path(sitemap), "^/+|/+$", ""), F.lit("/"), F.lit("_"))


def help_link(link: Column) -> Column:
    """FN12: forward slashes, no leading dots or slashes, no fragment."""
    return F.regexp_extract(F.regexp_replace(F.translate(link, "\\", "/"), r"^[./]+", ""), r"^([^#]*)", 1)


def link_key(url: Column) -> Column:
    """FN17: lower-cased path without a closing slash."""
    return F.lower(F.regexp_replace(url_path(url), "/+$", ""))


def resolve(base: Column, link: Column) -> Column:
    """The path that a relative link means on a page, with ``.`` and ``..`` taken out; NULL if it leaves the root."""
    raw = F.regexp_extract(link, r"^([^?#]*)", 1)
    start = F.when(F.startswith(raw, F.lit("/")), raw).otherwise(F.concat(F.regexp_extract(url_path(base), r"^(.*/)", 1), raw))
    parts = F.filter(F.split(start, "/"), lambda p: ~p.isin("", "."))
    kept = F.aggregate(
        parts, F.array().cast("array<string>"),
        lambda acc, p: F.when(p == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(p))),
    )
    return F.concat(F.lit("/"), F.array_join(kept, "/"))


def relative_path(page: Column, target: Column) -> Column:
    """FN5: from the folder of ``page`` to ``target``; both without a leading slash."""
    here, there = F.filter(F.split(parent(page), "/"), lambda x: x != ""), F.filter(F.split(parent(target), "/"), lambda x: x != "")
    same = F.zip_with(here, there, lambda a, b: F.coalesce(a == b, F.lit(False)))
    first = F.array_position(same, False)
    common = F.when(first == 0, F.least(F.size(here), F.size(there))).otherwise(first - 1).cast("int")
    down = F.concat(F.slice(there, common + 1, F.greatest(F.size(there) - common, F.lit(0))), F.array(file_name(target)))
    return F.concat(F.repeat(F.lit("../"), F.size(here) - common), F.array_join(down, "/"))
