"""A forgiving reader of feed texts: RSS 0.9x / 2.0, RSS 1.0 (RDF) and Atom,
with Dublin Core dates and authors.  The per-row helper of feeds.py.

It pulls tags one by one and keeps a stack of open elements, so it needs no
well-formed document: undeclared entities and bare ampersands are read as HTML
does, an end tag closes what is open inside its element, and a text that breaks
off keeps every item before the break (and of the last one what was complete).
"""

from __future__ import annotations

import html
import re

#: Namespaces of the vocabularies, and the usual prefixes where none is declared.
NAMESPACES = {"http://www.w3.org/2005/Atom": "", "http://purl.org/atom/ns#": "", "http://purl.org/rss/1.0/": "",
              "http://my.netscape.com/rdf/simple/0.9/": "", "http://backend.userland.com/rss2": "",
              "http://purl.org/dc/elements/1.1/": "dc", "http://purl.org/dc/terms/": "dcterms",
              "http://www.w3.org/1999/02/22-rdf-syntax-ns#": "rdf"}
PREFIXES = {"": "", "atom": "", "rss": "", "dc": "dc", "dcterms": "dcterms", "rdf": "rdf"}
#: Which element gives which field of an item.
FIELDS = {("", "title"): "title", ("", "link"): "link", ("", "guid"): "guid", ("", "id"): "id", ("", "pubdate"): "published",
          ("", "published"): "published", ("", "issued"): "published", ("dcterms", "issued"): "published", ("", "updated"): "updated",
          ("", "modified"): "updated", ("dc", "date"): "updated", ("dcterms", "modified"): "updated", ("", "author"): "author",
          ("dc", "creator"): "author", ("", "description"): "summary", ("", "summary"): "summary"}
COLUMNS = ("id", "title", "link", "guid", "published", "updated", "author", "summary")

_TOKEN = re.compile(r"<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<!--.*?(?:-->|\Z)|<\?.*?(?:\?>|\Z)|<![A-Za-z][^>\[]*(?:\[.*?\]\s*)?>"
                    r"|<(/?)([A-Za-z_][\w.:-]*)((?:[^<>\"']++|\"[^\"]*\"|'[^']*')*+)>", re.S)
_ATTR = re.compile(r"([\w.:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)')")


def read_items(text: str | None) -> list[dict[str, str | None]]:
    """The items of a feed in document order, as COLUMNS (None: not given).
    The first value of a field counts; a link is the element's text or the
    address of an ``alternate`` link; ``rdf:about`` is an id; a guid that says
    ``isPermaLink="true"`` is a link where there is no other."""
    items: list[dict[str, str | None]] = []
    stack: list[tuple[str, str]] = []
    prefixes = dict(PREFIXES)
    item: dict[str, str | None] | None = None
    depth = 0                                   # of the item's element
    parts: list[str] | None = None              # text of the open field
    link = False                                # the open guid is a permanent link

    def name_of(raw: str) -> tuple[str, str]:
        prefix, _, local = raw.rpartition(":")
        return prefixes.get(prefix, prefix), local.lower()

    def save(field: str, value: str | None) -> None:
        if item is not None and value and value.strip() and item[field] is None:
            item[field] = value

    def close(to: int) -> None:
        nonlocal item, parts, link
        while len(stack) > to:
            name = stack.pop()
            if item is None:
                continue
            if len(stack) == depth + 1 and name == ("", "name") and parts is not None:
                save("author", "".join(parts))
                parts = []
            elif len(stack) == depth and parts is not None:
                field = FIELDS[name]
                save(field, "".join(parts))
                if link:
                    save("link", item["guid"])
                parts, link = None, False
            elif len(stack) == depth - 1:
                item = None

    at = 0
    for m in _TOKEN.finditer(text or ""):
        if parts is not None and m.start() > at:
            parts.append(html.unescape(text[at:m.start()]))
        at = m.end()
        cdata, slash, raw, rest = m.groups()
        if cdata is not None:
            if parts is not None:
                parts.append(cdata)
            continue
        if raw is None:
            continue
        attrs = {k: html.unescape(a or b) for k, a, b in _ATTR.findall(rest)}
        for k, v in attrs.items():
            if k == "xmlns" or k.startswith("xmlns:"):
                prefixes[k[6:]] = NAMESPACES.get(v.strip(), "" if k == "xmlns" else k[6:])
        name = name_of(raw)
        if slash:
            at_name = next((k for k in range(len(stack) - 1, -1, -1) if stack[k] == name), None)
            if at_name is not None:
                close(at_name)
            continue
        if name[1] in ("item", "entry") and name[0] == "" and (item is None or len(stack) <= depth):
            if item is not None:                # the item before was never closed
                close(depth - 1)
            item = dict.fromkeys(COLUMNS)
            items.append(item)
            item["id"] = next((v for k, v in attrs.items() if name_of(k) == ("rdf", "about")), None)
            depth = len(stack) + 1
        elif item is not None and len(stack) == depth and name in FIELDS:
            parts = []
            link = FIELDS[name] == "guid" and attrs.get("isPermaLink") == "true"
            if FIELDS[name] == "link" and attrs.get("href"):
                if attrs.get("rel", "alternate") == "alternate":
                    save("link", attrs["href"])
        elif item is not None and name == ("", "name") and len(stack) == depth + 1 and FIELDS.get(stack[-1]) == "author":
            parts = []                          # a person's name alone
        stack.append(name)
        if rest.endswith("/"):
            close(len(stack) - 1)
    return items
