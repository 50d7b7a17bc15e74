"""Settings of the document engine.  Lists are data that decide results; anything here can be replaced from a YAML file."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace
from pathlib import Path

import yaml

# Names, selectors and limits that decide which pages are topics and how they are read.
SHELL_PAGES_EXACT = ("Default.htm", "Default_CSH.htm", "Home.htm", "index.htm", "index.html", "index_CSH.htm", "suitehelp_topic_list.html")
SHELL_PAGES = tuple(name.lower() for name in SHELL_PAGES_EXACT)
SKIP_SEGMENTS = ("/javadoc/", "/lib/", "/_globalpages/", "/MicroContent/", "/_templates/", "/Skins/", "/Resources/", "/functions/", "/videos/")
GUID_PAGE = r"^GUID-[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}\.html?$"
HTML_EXTENSIONS = (".htm", ".html")
CONTENT_SELECTORS = ("div[role='main']#mc-main-content", "div#center article", "article")
CHROME_SELECTORS = (
    "p.MCWebHelpFramesetLink", "div#prdnm", "div.toolbar", "div.breadcrumbs", "div.MCMiniTocBox_0", "div#feedback-survey", "p.Copyright", "noscript",
    "a.codeSnippetCopyButton", "div.codeSnippetCaption", "a.MCHelpControl-Related",
)
IMAGE_SKIP_PREFIXES = ("Skins/", "Resources/Scripts/", "Resources/Stylesheets/")
CELL_BLOCK_TAGS = ("ul", "ol", "pre", "blockquote", "h1", "h2", "h3", "table")
#: Pages per second of each stage, images per page, and the share of pages' download rate that images have.
RATES = {"download": 12.4, "convert": 16.8, "postprocess": 64.0, "toc": 72.0, "images": 12.4}
IMAGES_PER_PAGE = 0.8


@dataclass(frozen=True)
class Settings:
    shell_pages: tuple[str, ...] = SHELL_PAGES
    shell_pages_exact: tuple[str, ...] = SHELL_PAGES_EXACT
    skip_segments: tuple[str, ...] = SKIP_SEGMENTS
    guid_page: str = GUID_PAGE
    html_extensions: tuple[str, ...] = HTML_EXTENSIONS
    content_selectors: tuple[str, ...] = CONTENT_SELECTORS
    chrome_selectors: tuple[str, ...] = CHROME_SELECTORS
    image_skip_prefixes: tuple[str, ...] = IMAGE_SKIP_PREFIXES
    cell_block_tags: tuple[str, ...] = CELL_BLOCK_TAGS
    internal_hosts: tuple[str, ...] = ()
    product_prefix: str = ""
    issue_prefix: str = "GS"
    rates: dict = field(default_factory=lambda: dict(RATES))
    images_per_page: float = IMAGES_PER_PAGE


def load_settings(path: str | Path) -> Settings:
    """SRC1: defaults, replaced by the keys of a YAML file that name a setting; missing file: FileNotFoundError."""
    given = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or {}
    known = {f.name for f in fields(Settings)}
    return replace(Settings(), **{k: tuple(v) if isinstance(v, list) else v for k, v in given.items() if k in known})


def load_phase(name: str, *folders: str | Path) -> dict:
    """SRC2: the first ``name.yaml`` in the folders, with ``products`` and ``versions`` as lists."""
    for folder in folders:
        at = Path(folder) / f"{name}.yaml"
        if at.exists():
            given = yaml.safe_load(at.read_text(encoding="utf-8")) or {}
            return {"name": given.get("name", name), "products": list(given.get("products") or []), "versions": list(given.get("versions") or [])}
    raise FileNotFoundError(f"no phase {name} in {', '.join(map(str, folders))}")
