"""A small tolerant tree over the standard library's tokenizer, and a subset of CSS selectors."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

# Elements without content, and elements whose start closes an open one.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section table ul".split()
)
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "tbody": ("tr", "td", "th", "thead"), "option": ("option",)}
SCOPES = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "tbody": ("table",), "option": ("select",)}


class Element:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None, children: list | None = None):
        self.tag, self.attrs, self.parent = tag, attrs or {}, None
        self.children: list[Element | str] = []
        for c in children or []:
            self.append(c)

    @property
    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def append(self, node: Element | str) -> None:
        if isinstance(node, Element):
            node.detach()
            node.parent = self
        self.children.append(node)

    def index(self) -> int:
        return next(i for i, c in enumerate(self.parent.children) if c is self)

    def detach(self) -> None:
        if self.parent is not None:
            del self.parent.children[self.index()]
            self.parent = None

    def replace(self, *nodes: Element | str) -> None:
        """Put nodes in this element's place; the element is on its own afterwards."""
        up, at = self.parent, self.index()
        del up.children[at]
        self.parent = None
        for k, n in enumerate(nodes):
            if isinstance(n, Element):
                n.detach()
                n.parent = up
            up.children.insert(at + k, n)

    def unwrap(self) -> None:
        self.replace(*list(self.children))

    def walk(self) -> Iterator[Element]:
        """Descendants in page order; the list of children is taken as it is when an element is reached."""
        for c in list(self.children):
            if isinstance(c, Element):
                yield c
                yield from c.walk()

    def up(self) -> Iterator[Element]:
        at = self.parent
        while at is not None:
            yield at
            at = at.parent

    def all(self, *tags: str) -> list[Element]:
        return [e for e in self.walk() if e.tag in tags]

    def own(self, *tags: str) -> list[Element]:
        return [c for c in self.children if isinstance(c, Element) and (not tags or c.tag in tags)]

    def text(self) -> str:
        return "".join(self.texts())

    def texts(self) -> list[str]:
        """Runs of text in page order."""
        out, stack = [], [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                out.append(node)
            else:
                stack.extend(reversed(node.children))
        return out

    def is_inside(self, *tags: str) -> bool:
        return any(e.tag in tags for e in self.up())


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("")
        self.stack = [self.root]

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k].tag == "p":
                    del self.stack[k:]
                    break
                if self.stack[k].tag in BLOCKS or self.stack[k].tag in ("td", "th", "body"):
                    break
        if tag in CLOSES:
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k].tag in SCOPES[tag]:
                    break
                if self.stack[k].tag in CLOSES[tag]:
                    del self.stack[k:]
                    break
        node = Element(tag, {k: v or "" for k, v in attrs})
        self.stack[-1].append(node)
        if tag not in VOID and len(self.stack) < 200:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.stack[-1].tag == tag:
            self.stack.pop()

    def handle_endtag(self, tag):
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag == tag:
                del self.stack[k:]
                return

    def handle_data(self, data):
        self.stack[-1].children.append(data)


def parse(html: str | bytes) -> Element:
    if isinstance(html, bytes):
        found = re.search(rb"charset=[\"']?([\w-]+)", html[:2048])
        try:
            html = html.decode(found[1].decode() if found else "utf-8", "replace")
        except LookupError:
            html = html.decode("utf-8", "replace")
    build = _Builder()
    build.feed(html)
    build.close()
    return build.root


_SIMPLE = re.compile(r"""([a-zA-Z][\w-]*|\*)|\#([\w-]+)|\.([\w-]+)|\[([\w-]+)(?:=['"]?([^'"\]]*)['"]?)?\]""")


def _matches(e: Element, compound: str) -> bool:
    for tag, ident, cls, name, value in _SIMPLE.findall(compound):
        if tag and tag not in ("*", e.tag) or ident and e.attrs.get("id") != ident or cls and cls not in e.classes:
            return False
        if name and (name not in e.attrs or value and e.attrs[name] != value):
            return False
    return True


def select(root: Element, selector: str) -> list[Element]:
    """Elements that match compounds parted by spaces (descendants), in page order."""
    *outer, last = selector.split()
    found = []
    for e in root.walk():
        if not _matches(e, last):
            continue
        want = list(outer)
        for up in e.up():
            if want and _matches(up, want[-1]):
                want.pop()
        if not want:
            found.append(e)
    return found


def serialise(node: Element | str) -> str:
    if isinstance(node, str):
        return node.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    inside = "".join(serialise(c) for c in node.children)
    if not node.tag:
        return inside
    attrs = "".join(f' {k}="{v.replace("&", "&amp;").replace(chr(34), "&quot;")}"' for k, v in node.attrs.items())
    return f"<{node.tag}{attrs}/>" if node.tag in VOID else f"<{node.tag}{attrs}>{inside}</{node.tag}>"
