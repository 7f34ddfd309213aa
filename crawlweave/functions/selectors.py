"""Selection inside one page, for use in a task: CSS, XPath and regex queries over tag soup.

Supported CSS: tag, ``*``, ``.class``, ``#id``, ``[attr]``, ``[attr=value]``,
descendant and ``>``, ``,`` groups, ``::text`` and ``::attr(name)``.
Supported XPath: ``/`` and ``//`` steps with a tag or ``*``, ``[n]``,
``[@attr]``, ``[@attr='v']``, a last step ``@attr`` or ``text()``, and
``count(...)``. Anything else is refused when the template is checked.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

# fixed values: elements without content, and the open elements a start tag closes
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
CLOSES = {
    "p": {"p"},
    "li": {"li"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "option": {"option"},
}

Query = Callable[["Node"], list]


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict, parent: "Node | None"):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self) -> Iterator["Node"]:
        """Descendant elements in document order; iterative, so that deep pages are safe."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def strings(self) -> Iterator[str]:
        stack = list(reversed(self.children))
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                yield item
            else:
                stack.extend(reversed(item.children))

    def html(self) -> str:
        out, stack = [], [self]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                out.append(item)
                continue
            if item.tag:
                marks = "".join(f' {k}="{v or ""}"' for k, v in item.attrs.items())
                out.append(f"<{item.tag}{marks}>")
                if item.tag not in VOID:
                    stack.append(f"</{item.tag}>")
            stack.extend(reversed(item.children))
        return "".join(out)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.open = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        while self.open.tag in CLOSES.get(tag, ()):
            self.open = self.open.parent
        node = Node(tag, dict(attrs), self.open)
        self.open.children.append(node)
        if tag not in VOID:
            self.open = node

    def handle_endtag(self, tag):
        node = self.open
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.open = node.parent

    def handle_data(self, data):
        self.open.children.append(data)


def parse_page(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


PART = re.compile(r"([.#]?)([A-Za-z_][\w-]*|\*)|\[\s*([\w-]+)\s*(?:=\s*[\"']?([^\"'\]]*)[\"']?\s*)?\]")
STEP = re.compile(r"(//?)(?:@([\w-]+)|(text\(\))|([A-Za-z][\w-]*|\*)((?:\[[^\]]+\])*))")
PREDICATE = re.compile(r"(\d+)|@([\w-]+)(?:\s*=\s*[\"']([^\"']*)[\"'])?")


def compound(text: str) -> Callable[[Node], bool]:
    """Test of one element, such as ``div.price[data-x]``."""
    tests, position = [], 0
    for m in PART.finditer(text):
        if m.start() != position:
            break
        position = m.end()
        mark, name, attr, value = m.groups()
        if attr:
            tests.append(lambda n, a=attr, v=value: a in n.attrs and (v is None or n.attrs[a] == v))
        elif mark == ".":
            tests.append(lambda n, c=name: c in (n.attrs.get("class") or "").split())
        elif mark == "#":
            tests.append(lambda n, i=name: n.attrs.get("id") == i)
        elif name != "*":
            tests.append(lambda n, t=name.lower(): n.tag == t)
    if position != len(text) or not text:
        raise ValueError(f"unsupported CSS selector {text!r}")
    return lambda node: all(test(node) for test in tests)


def on_chain(node: Node, chain: list, scope: Node) -> bool:
    """Whether an element below ``scope`` ends this chain of (test, is child of the one before)."""
    test, child = chain[-1]
    if not test(node):
        return False
    if len(chain) == 1:
        return not child or node.parent is scope
    up = node.parent
    while up is not None and up is not scope:
        if on_chain(up, chain[:-1], scope):
            return True
        if child:
            return False
        up = up.parent
    return False


def css(query: str) -> Query:
    body, as_text, attr = re.fullmatch(r"(.*?)(?:::(text)|::attr\(([\w-]+)\))?", query.strip(), re.DOTALL).groups()
    groups = []
    for group in body.split(","):
        chain, child = [], False
        for token in re.sub(r"\s*>\s*", " > ", group.strip()).split():
            if token != ">":
                chain.append((compound(token), child))
            child = token == ">"
        if not chain or child:
            raise ValueError(f"unsupported CSS selector {query!r}")
        groups.append(chain)

    def run(scope: Node) -> list:
        found = [n for n in scope.walk() if any(on_chain(n, chain, scope) for chain in groups)]
        if as_text:
            return [s for n in found for s in n.children if isinstance(s, str)]
        return [n.attrs[attr] or "" for n in found if attr in n.attrs] if attr else found

    return run


def child_elements(parent: Node, name: str, tests: list) -> list[Node]:
    hits = [c for c in parent.children if isinstance(c, Node) and name in ("*", c.tag)]
    for index, attr, value in tests:
        if index:
            hits = hits[int(index) - 1 : int(index)]
        else:
            hits = [h for h in hits if attr in h.attrs and (value is None or h.attrs[attr] == value)]
    return hits


def xpath(query: str) -> Query:
    counted = re.fullmatch(r"count\((.*)\)", query.strip())
    text = (counted.group(1) if counted else query).strip().removeprefix(".")
    steps, position = [], 0
    while position < len(text):
        m = STEP.match(text, position)
        if m is None or (steps and steps[-1][1] != "node"):
            raise ValueError(f"unsupported XPath {query!r}")
        slashes, attr, is_text, tag, predicates = m.groups()
        tests = [PREDICATE.fullmatch(body.strip()) for body in re.findall(r"\[([^\]]+)\]", predicates or "")]
        if None in tests:
            raise ValueError(f"unsupported XPath predicate in {query!r}")
        kind = "attr" if attr else "text" if is_text else "node"
        steps.append((slashes == "//", kind, attr or tag, [t.groups() for t in tests]))
        position = m.end()
    if not steps:
        raise ValueError(f"unsupported XPath {query!r}")

    def run(scope: Node) -> list:
        found: list = [scope]
        for deep, kind, name, tests in steps:
            holders = [h for n in found for h in ([n, *n.walk()] if deep else [n])]
            if kind == "attr":
                found = [h.attrs[name] or "" for h in holders if name in h.attrs]
            elif kind == "text":
                found = [s for h in holders for s in h.children if isinstance(s, str)]
            else:
                found = list({id(c): c for h in holders for c in child_elements(h, name, tests)}.values())
        return [str(len(found))] if counted else found

    return run


def regex(query: str, options: dict) -> Callable[[str], list[str]]:
    flags = re.NOFLAG
    for name, flag in (("dotall", re.DOTALL), ("ignorecase", re.IGNORECASE), ("multiline", re.MULTILINE)):
        flags |= flag if options.get(name) else re.NOFLAG
    compiled = re.compile(query, flags)
    return lambda text: [m.group(1) if compiled.groups else m.group(0) for m in compiled.finditer(text)]
