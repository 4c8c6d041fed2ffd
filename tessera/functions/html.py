"""Main-text extraction for one HTML page (standard-library parser only).

Rule: remove ``script`` and ``style`` elements, then return the text of the
first element (document order) with the most direct ``<p>`` children.
"""

from __future__ import annotations

from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
        "param", "source", "track", "wbr"}
SKIP = {"script", "style"}


class _Node:
    __slots__ = ("tag", "children", "parent")

    def __init__(self, tag, parent):
        self.tag, self.children, self.parent = tag, [], parent


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Node("[document]", None)
        self.cur = self.root
        self.order = []

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, self.cur)
        self.cur.children.append(node)
        self.order.append(node)
        if tag not in VOID:
            self.cur = node

    def handle_startendtag(self, tag, attrs):
        node = _Node(tag, self.cur)
        self.cur.children.append(node)
        self.order.append(node)

    def handle_endtag(self, tag):
        n = self.cur
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.cur = n.parent

    def handle_data(self, data):
        self.cur.children.append(data)


def _text(node) -> str:
    out = []
    stack = [node]
    while stack:
        n = stack.pop()
        if isinstance(n, str):
            out.append(n)
        elif n.tag not in SKIP:
            stack.extend(reversed(n.children))
    return "".join(out)


def main_text_of(html: str | None) -> str | None:
    if html is None:
        return None
    t = _Tree()
    t.feed(html)
    t.close()
    nodes = [n for n in t.order if n.tag not in SKIP and not _inside_skip(n)]
    if not nodes:
        return _text(t.root)
    best = max(nodes, key=lambda n: sum(1 for c in n.children
                                        if not isinstance(c, str) and c.tag == "p"))
    return _text(best)


def _inside_skip(n) -> bool:
    p = n.parent
    while p is not None:
        if p.tag in SKIP:
            return True
        p = p.parent
    return False
