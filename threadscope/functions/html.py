"""A small DOM over the standard-library HTML parser, for page extraction
inside ``mapInArrow`` (no third-party parser is available on executors).

Supports what the forum pages need: a tree, descendant selectors made of
``tag``, ``.class`` and ``#id`` parts, text of a subtree, and removing a
subtree. Entities are decoded by the parser.
"""

from __future__ import annotations

from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}


class Node:
    __slots__ = ("tag", "attrs", "children", "parent", "removed")

    def __init__(self, tag: str, attrs: dict, parent: Node | None):
        self.tag, self.attrs, self.children, self.parent, self.removed = tag, attrs, [], parent, False

    @property
    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()

    def get(self, key: str, default=None):
        return self.attrs.get(key, default)

    def text(self) -> str:
        return "".join(x for x in self.walk() if isinstance(x, str))

    def walk(self):
        """Texts and nodes below, in document order; without recursion, since
        broken markup may nest thousands of open tags."""
        todo = [iter(self.children)]
        while todo:
            for ch in todo[-1]:
                if isinstance(ch, str):
                    yield ch
                elif not ch.removed:
                    yield ch
                    todo.append(iter(ch.children))
                    break
            else:
                todo.pop()

    def descendants(self):
        return (x for x in self.walk() if isinstance(x, Node))

    def remove(self) -> None:
        """Take this subtree out of what its ancestors walk over."""
        self.removed = True

    def select(self, selector: str) -> list[Node]:
        parts = [_parse_simple(p) for p in selector.split()]
        found = []
        for n in self.descendants():
            if _match(n, parts[-1]) and _ancestors_match(n, parts[:-1], self):
                found.append(n)
        return found

    def select_one(self, selector: str) -> Node | None:
        r = self.select(selector)
        return r[0] if r else None


def _parse_simple(s: str) -> tuple[str | None, list[str], str | None]:
    tag, classes, ident = None, [], None
    buf, mode = "", "tag"
    for ch in s + "\0":
        if ch in ".#\0":
            if buf:
                if mode == "tag":
                    tag = buf.lower()
                elif mode == "class":
                    classes.append(buf)
                else:
                    ident = buf
            buf = ""
            mode = "class" if ch == "." else "id"
        else:
            buf += ch
    return tag, classes, ident


def _match(n: Node, simple) -> bool:
    tag, classes, ident = simple
    if tag and n.tag != tag:
        return False
    if ident and n.get("id") != ident:
        return False
    cl = n.classes
    return all(c in cl for c in classes)


def _ancestors_match(n: Node, parts, root: Node) -> bool:
    i = len(parts) - 1
    a = n.parent
    while i >= 0 and a is not None and a is not root.parent:
        if _match(a, parts[i]):
            i -= 1
        a = a.parent
    return i < 0


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {}, None)
        self.cur = self.root

    def handle_starttag(self, tag, attrs):
        n = Node(tag, {k: (v if v is not None else "") for k, v in attrs}, self.cur)
        self.cur.children.append(n)
        if tag not in VOID:
            self.cur = n

    def handle_startendtag(self, tag, attrs):
        self.cur.children.append(Node(tag, {k: (v if v is not None else "") for k, v in attrs}, self.cur))

    def handle_endtag(self, tag):
        n = self.cur
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.cur = n.parent

    def handle_data(self, data):
        self.cur.children.append(data)


def parse(html: str | None) -> Node:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root
