"""A small element tree over the standard HTML parser.

Runs inside tasks on one page at a time; all it does is find elements and their raw
texts. What the texts mean is decided by column expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)


class Element:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Element | str] = []

    def get(self, name: str) -> str:
        return self.attrs.get(name) or ""

    def elements(self) -> list[Element]:
        return [c for c in self.children if isinstance(c, Element)]

    def walk(self) -> Iterator[Element]:
        todo = self.elements()[::-1]
        while todo:
            yield (e := todo.pop())
            todo.extend(e.elements()[::-1])

    def _matching(self, tag: str, test: Callable[[Element], bool] | None, attrs: dict[str, str]) -> Iterator[Element]:
        if "cls" in attrs:
            attrs["class"] = attrs.pop("cls")
        return (
            e for e in self.walk()
            if e.tag == tag and all(e.get(k) == v for k, v in attrs.items()) and (test is None or test(e))
        )

    def find_all(self, tag: str, test: Callable[[Element], bool] | None = None, **attrs: str) -> list[Element]:
        """Descendants with the tag, exact attribute values (``cls`` for class) and test."""
        return list(self._matching(tag, test, attrs))

    def find(self, tag: str, test: Callable[[Element], bool] | None = None, **attrs: str) -> Element | None:
        return next(self._matching(tag, test, attrs), None)

    def own_texts(self) -> list[str]:
        return [c for c in self.children if isinstance(c, str)]

    def own_text(self) -> str | None:
        texts = self.own_texts()
        return texts[0] if texts else None

    def texts(self) -> list[str]:
        """All text nodes below, in document order."""
        out: list[str] = []
        for c in self.children:
            out.extend([c] if isinstance(c, str) else c.texts())
        return out


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("", {}, None)
        self.open = self.root

    def handle_starttag(self, tag, attrs):
        element = Element(tag, {k: v or "" for k, v in attrs}, self.open)
        self.open.children.append(element)
        if tag not in VOID:
            self.open = element

    def handle_startendtag(self, tag, attrs):
        self.open.children.append(Element(tag, {k: v or "" for k, v in attrs}, self.open))

    def handle_endtag(self, tag):
        at = self.open
        while at is not None and at.tag != tag:
            at = at.parent
        # An end tag nothing was opened for is ignored.
        if at is not None and at.parent is not None:
            self.open = at.parent

    def handle_data(self, data):
        self.open.children.append(data)


def parse(html: str) -> Element:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root
