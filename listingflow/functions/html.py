"""Per-page HTML helper used inside ``mapInPandas`` tasks (never on the driver).

A tolerant element tree built with the standard library's ``html.parser`` and the selector
subset the extraction rules use:

    tag  .class  #id  [attr]  [attr='v']  descendant  >  +  ~  ,
    :has(sel) / :has(> sel)   :-soup-contains("t") / :contains("t")   :not(simple)
    :nth-child(n)   :class-re(regex)   (regex on each class and on the whole class string)

Tree rules follow the usual tolerant parser: unknown end tags are ignored, an end tag closes
the nearest open element with that name, void elements take no children; script/style text
is kept out of ``text()``.  One parse per page; rules then query the tree.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser
from typing import Iterator, List, Optional

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
NO_TEXT = {"script", "style", "template"}


class Node:
    __slots__ = ("tag", "attrs", "children", "parent", "data")

    def __init__(self, tag: Optional[str], attrs=None, parent=None, data: str = ""):
        self.tag = tag
        self.attrs = attrs or {}
        self.children: List[Node] = []
        self.parent = parent
        self.data = data

    # -- navigation
    def elements(self) -> List["Node"]:
        return [c for c in self.children if c.tag is not None]

    def iter(self) -> Iterator["Node"]:
        """Descendant elements in document order."""
        stack = list(reversed(self.elements()))
        while stack:
            n = stack.pop()
            yield n
            stack.extend(reversed(n.elements()))

    @property
    def classes(self) -> List[str]:
        return self.attrs.get("class", "").split()

    # -- text
    def _strings(self) -> Iterator[str]:
        stack = list(reversed(self.children))      # no recursion: pages may nest without end
        while stack:
            n = stack.pop()
            if n.tag is None:
                yield n.data
            elif n.tag not in NO_TEXT:
                stack.extend(reversed(n.children))

    def text(self, strip: bool = False) -> str:
        if strip:
            return "".join(s.strip() for s in self._strings() if s.strip())
        return "".join(self._strings())


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("[document]")
        self.cur = self.root

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: (v if v is not None else "") for k, v in attrs}, self.cur)
        self.cur.children.append(node)
        if tag not in VOID:
            self.cur = node

    def handle_startendtag(self, tag, attrs):
        self.cur.children.append(Node(tag, {k: (v if v is not None else "") for k, v in attrs}, self.cur))

    def handle_endtag(self, tag):
        n = self.cur
        while n is not None and n is not self.root and n.tag != tag:
            n = n.parent
        if n is not None and n is not self.root:
            self.cur = n.parent

    def handle_data(self, data):
        self.cur.children.append(Node(None, parent=self.cur, data=data))


def parse(html: str) -> Node:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


# ------------------------------------------------------------------ selectors
_TOKEN = re.compile(r"""
    (?P<ws>\s+) | (?P<comb>[>+~]) | (?P<comma>,) |
    (?P<tag>[A-Za-z][\w-]*|\*) | \.(?P<cls>[\w-]+) | \#(?P<id>[\w-]+) |
    \[(?P<attr>[\w-]+)(?:\s*(?P<op>[~^$*|]?=)\s*(?P<val>"[^"]*"|'[^']*'|[^\]\s]+))?\s*\] |
    :(?P<pseudo>[\w-]+)(?P<arg>\()?
""", re.X)


class Compound:
    __slots__ = ("tag", "classes", "id", "attrs", "pseudos")

    def __init__(self):
        self.tag = None
        self.classes: List[str] = []
        self.id = None
        self.attrs = []
        self.pseudos = []


def _read_paren(s: str, i: int):
    depth, j, quote = 1, i, None
    while j < len(s):
        ch = s[j]
        if quote:
            if ch == quote:
                quote = None
        elif ch in "\"'":
            quote = ch
        elif ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
            if depth == 0:
                return s[i:j], j + 1
        j += 1
    raise ValueError("unbalanced parenthesis in selector")


def _unquote(v: str) -> str:
    v = v.strip()
    return v[1:-1] if len(v) >= 2 and v[0] == v[-1] and v[0] in "\"'" else v


def compile_selector(sel: str):
    """Selector text → list of groups; a group is [compound, comb, compound, ...]."""
    groups, cur, comp, pending, i = [], [], None, None, 0
    s = sel.strip()

    def close():
        nonlocal comp, pending
        if comp is not None:
            if cur:
                cur.append(pending or " ")
            cur.append(comp)
            comp, pending = None, None

    while i < len(s):
        m = _TOKEN.match(s, i)
        if not m:
            raise ValueError(f"unsupported selector near {s[i:]!r}")
        i = m.end()
        if m.group("ws"):
            close()
            continue
        if m.group("comb"):
            close()
            pending = m.group("comb")
            if not cur:              # relative selector inside :has(> ...)
                cur.append(None)
            continue
        if m.group("comma"):
            close()
            groups.append(cur)
            cur = []
            continue
        if comp is None:
            comp = Compound()
        if m.group("tag"):
            comp.tag = None if m.group("tag") == "*" else m.group("tag").lower()
        elif m.group("cls"):
            comp.classes.append(m.group("cls"))
        elif m.group("id"):
            comp.id = m.group("id")
        elif m.group("attr"):
            comp.attrs.append((m.group("attr"), m.group("op"), _unquote(m.group("val") or "")))
        elif m.group("pseudo"):
            name, arg = m.group("pseudo"), None
            if m.group("arg"):
                arg, i = _read_paren(s, i)
            if name == "has":
                comp.pseudos.append(("has", compile_selector(arg)))
            elif name == "not":
                comp.pseudos.append(("not", compile_selector(arg)))
            elif name in ("-soup-contains", "contains"):
                comp.pseudos.append(("contains", _unquote(arg)))
            elif name == "nth-child":
                comp.pseudos.append(("nth", int(arg)))
            elif name == "class-re":
                comp.pseudos.append(("class-re", re.compile(_unquote(arg), re.I)))
            else:
                raise ValueError(f"unsupported pseudo-class :{name}")
    close()
    groups.append(cur)
    return groups


def _attr_ok(node: Node, name: str, op, val: str) -> bool:
    if name not in node.attrs:
        return False
    have = node.attrs[name]
    if op is None:
        return True
    if op == "=":
        return have == val
    if op == "~=":
        return val in have.split()
    if op == "^=":
        return have.startswith(val)
    if op == "$=":
        return have.endswith(val)
    if op == "*=":
        return val in have
    if op == "|=":
        return have == val or have.startswith(val + "-")
    return False


def _compound_ok(node: Node, c: Compound) -> bool:
    if c.tag and node.tag != c.tag:
        return False
    if c.classes:
        have = node.classes
        if any(k not in have for k in c.classes):
            return False
    if c.id and node.attrs.get("id") != c.id:
        return False
    for name, op, val in c.attrs:
        if not _attr_ok(node, name, op, val):
            return False
    for kind, arg in c.pseudos:
        if kind == "contains":
            if arg not in node.text():
                return False
        elif kind == "nth":
            p = node.parent
            if p is None or node not in p.elements() or p.elements().index(node) + 1 != arg:
                return False
        elif kind == "not":
            if any(_matches(node, g, None) for g in arg):
                return False
        elif kind == "has":
            if not _has(node, arg):
                return False
        elif kind == "class-re":
            cls = node.classes
            if not (any(arg.search(k) for k in cls) or arg.search(" ".join(cls))):
                return False
    return True


def _has(node: Node, groups) -> bool:
    for g in groups:
        if g and g[0] is None:                      # :has(> x ...) relative to the node
            rest = g[2:]
            comb = g[1]
            # the leftmost compound's relation to the node is checked when the match reaches it
            if any(_matches(d, rest, node, anchor=node, first_comb=comb) for d in node.iter()):
                return True
        elif any(_matches(d, g, node) for d in node.iter()):
            return True
    return False


def _prev_elements(node: Node) -> List[Node]:
    p = node.parent
    if p is None:
        return []
    sib = p.elements()
    return sib[:sib.index(node)]


def _matches(node: Node, group, scope: Optional[Node], anchor: Optional[Node] = None,
             first_comb: Optional[str] = None) -> bool:
    """Right-to-left match of ``group`` at ``node``; ancestors are searched below ``scope``."""
    if not group:
        return False
    if not _compound_ok(node, group[-1]):
        return False
    if len(group) == 1:
        if anchor is None:
            return True
        # leftmost compound of a relative selector must relate to the anchor
        if first_comb == ">":
            return node.parent is anchor
        return True
    comb, rest = group[-2], group[:-2]
    if comb == " ":
        a = node.parent
        while a is not None and a is not scope and a.tag != "[document]":
            if _matches(a, rest, scope, anchor, first_comb):
                return True
            a = a.parent
        return False
    if comb == ">":
        a = node.parent
        return a is not None and a is not scope and a.tag != "[document]" and _matches(a, rest, scope, anchor, first_comb)
    if comb == "+":
        prev = _prev_elements(node)
        return bool(prev) and _matches(prev[-1], rest, scope, anchor, first_comb)
    if comb == "~":
        return any(_matches(p, rest, scope, anchor, first_comb) for p in _prev_elements(node))
    return False


_CACHE: dict = {}


def _compiled(sel: str):
    c = _CACHE.get(sel)
    if c is None:
        c = _CACHE[sel] = compile_selector(sel)
    return c


def select(root: Node, sel: str) -> List[Node]:
    """All elements under ``root`` matching ``sel``, in document order (as in the DOM, the
    ancestors named by the selector may lie outside ``root``)."""
    groups = _compiled(sel)
    return [n for n in root.iter() if any(_matches(n, g, None) for g in groups)]


def select_one(root: Node, sel: str) -> Optional[Node]:
    groups = _compiled(sel)
    for n in root.iter():
        if any(_matches(n, g, None) for g in groups):
            return n
    return None
