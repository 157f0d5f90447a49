"""XML and HTML payloads that built-in functions can't map exactly (mixed content, selector order)."""

from __future__ import annotations

import logging
import re
import xml.etree.ElementTree as ElementTree
from html.parser import HTMLParser

NS = {"ops": "http://ops.epo.org", "ex": "http://www.epo.org/exchange"}
BIBLIO = ".//ex:bibliographic-data/"
TITLE_CHARS = 200
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


def xml_documents(payload: str | None) -> list[dict]:
    """Fields of every exchange document; text is what stands before a first child element."""
    try:
        root = ElementTree.fromstring(payload or "")
    except ElementTree.ParseError as e:
        logging.getLogger("papyrine").error("malformed XML response: %s", e)
        return []
    return [_xml_document(x) for x in root.findall(".//ops:search-result/ex:exchange-documents/ex:exchange-document", NS)]


def _xml_document(doc: ElementTree.Element) -> dict:
    def first(*paths: str) -> str | None:
        for path in paths:
            if (found := doc.find(path, NS)) is not None:
                return found.text
        return None

    def every(path: str) -> list[str]:
        return [x.text for x in doc.findall(path, NS) if x.text]

    ref = doc.find(BIBLIO + "ex:publication-reference/ex:document-id", NS)
    part = {k: ref.findtext(f"ex:{k}", "", NS) if ref is not None else "" for k in ("country", "doc-number", "kind", "date")}
    return {
        "title": first(BIBLIO + "ex:invention-title[@lang='en']", BIBLIO + "ex:invention-title"),
        "abstract": first(".//ex:abstract[@lang='en']/ex:p", ".//ex:abstract/ex:p"),
        "number": part["country"] + part["doc-number"] + part["kind"] if part["doc-number"] else None,
        "authors": every(BIBLIO + "ex:parties/ex:applicants/ex:applicant/ex:applicant-name/ex:name"),
        "day": part["date"],
        "ipc": [x.strip() for x in every(BIBLIO + "ex:classifications-ipcr/ex:classification-ipcr/ex:text")],
    }


class Node:
    __slots__ = ("name", "attrs", "children")

    def __init__(self, name: str, attrs: dict[str, str]):
        self.name, self.attrs, self.children = name, attrs, []

    def walk(self):
        """Elements below this one, in the order of the page."""
        todo = self.children[::-1]  # a stack of our own: pages nest deeper than calls may
        while todo:
            if isinstance(c := todo.pop(), Node):
                yield c
                todo.extend(reversed(c.children))

    def text(self) -> str:
        """All texts below, each stripped, with nothing between."""
        out, todo = [], self.children[::-1]
        while todo:
            if isinstance(c := todo.pop(), Node):
                todo.extend(reversed(c.children))
            else:
                out.append(c.strip())
        return "".join(out)

    def has(self, cls: str) -> bool:
        return cls in self.attrs.get("class", "").split()


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        if tag == "p" and self.open[-1].name == "p":
            self.open.pop()
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].name == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        if self.open[-1].name not in ("script", "style"):
            self.open[-1].children.append(data)


def html_results(payload: str | None) -> list[dict]:
    """Title, link and abstract of every search result of a page."""
    builder = _Builder()
    builder.feed(payload or "")
    builder.close()
    every = list(builder.root.walk())
    found = [n for n in every if n.name == "search-result-item" or n.name == "article" and n.has("result")]
    found = found or [n for n in every if "data-result" in n.attrs]
    out = []
    for result in found:
        below = list(result.walk())
        title = next((n for n in below if n.name == "h3" or n.has("result-title") or "data-title" in n.attrs), None)
        link = next((n for n in below if n.name == "a" and "/patent/" in n.attrs.get("href", "")), None)
        abstract = next((n for n in below if n.has("result-snippet") or n.has("abstract") or n.name == "p"), None)
        out.append({"title": title and title.text() or result.text()[:TITLE_CHARS] or None, "href": link and link.attrs["href"], "abstract": None if abstract is None else abstract.text()})
    return out


def first_text(payload: str | None, tag: str) -> str | None:
    """Stripped text of the first element of that name."""
    m = re.search(rf"<{tag}\b", payload or "", re.I)
    if not m:
        return None
    builder = _Builder()
    builder.feed(payload or "")
    builder.close()
    node = next((n for n in builder.root.walk() if n.name == tag), None)
    return None if node is None else node.text()
