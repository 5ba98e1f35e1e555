"""A small HTML tree on the standard parser, and CSS selectors over it.

The tree keeps what the page says: an end tag closes the nearest open element of
its name, unmatched ones are ignored, and unclosed paragraphs nest.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset(["script", "style", "template"])


class Element:
    __slots__ = ("name", "attrs", "children", "parent")

    def __init__(self, name: str, attrs: dict[str, str], parent: Element | None = None):
        self.name, self.attrs, self.parent = name, attrs, parent
        self.children: list[Element | str] = []

    @property
    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def elements(self) -> Iterator[Element]:
        """All elements below, in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Element)]
        while stack:
            e = stack.pop()
            yield e
            stack += [c for c in reversed(e.children) if isinstance(c, Element)]

    def find(self, name: str, /, **attrs: str) -> Element | None:
        return next((e for e in self.elements() if e.name == name and all(e.attrs.get(k) == v for k, v in attrs.items())), None)

    def find_all(self, name: str) -> list[Element]:
        return [e for e in self.elements() if e.name == name]

    def remove(self) -> None:
        if self.parent:
            self.parent.children = [c for c in self.parent.children if c is not self]
            self.parent = None

    def replace(self, text: str) -> None:
        if self.parent:
            self.parent.children = [text if c is self else c for c in self.parent.children]
            self.parent = None

    def strings(self) -> Iterator[str]:
        stack: list[tuple[Element | str, bool]] = [(c, self.name in HIDDEN) for c in reversed(self.children)]
        while stack:
            c, asked = stack.pop()
            if isinstance(c, str):
                yield c
            elif asked or c.name not in HIDDEN:
                stack += [(x, asked) for x in reversed(c.children)]

    def text(self, joined_by: str | None = None) -> str:
        """All text; with ``joined_by``, stripped strings that aren't empty, joined."""
        if joined_by is None:
            return "".join(self.strings())
        return joined_by.join(s for x in self.strings() if (s := x.strip()))

    def outer(self) -> str:
        """The element as HTML."""
        out: list[str] = []
        stack: list[Element | str | tuple[str]] = [self]
        while stack:
            c = stack.pop()
            if isinstance(c, tuple):
                out.append(c[0])
            elif isinstance(c, str):
                out.append(html.escape(c, quote=False))
            else:
                attrs = "".join(f' {k}="{html.escape(v)}"' for k, v in c.attrs.items())
                if c.name in VOID:
                    out.append(f"<{c.name}{attrs}/>")
                    continue
                out.append(f"<{c.name}{attrs}>")
                stack.append((f"</{c.name}>",))
                stack += reversed([(x,) if c.name in HIDDEN and isinstance(x, str) else x for x in c.children])
        return "".join(out)


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("[document]", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        e = Element(tag, {k: v or "" for k, v in attrs}, self.open[-1])
        self.open[-1].children.append(e)
        if tag not in VOID:
            self.open.append(e)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.open.pop()

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].name == tag:
                del self.open[i:]
                break

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(page: str) -> Element:
    b = _Builder()
    b.feed(page)
    b.close()
    return b.root


@dataclass
class Compound:
    """Conditions on one element, and how it stands to the one before it in the selector."""

    combinator: str = " "
    tag: str = "*"
    tests: list[tuple] = field(default_factory=list)


_NAME = r"-?[A-Za-z_\u0080-\U0010ffff][\w\u0080-\U0010ffff-]*"
_TOKEN = re.compile(
    rf"""(?P<space>\s*(?P<comb>[>+~,])\s*|\s+)|(?P<tag>\*|{_NAME})|\.(?P<cls>{_NAME})|\#(?P<id>[\w-]+)
    |\[\s*(?P<attr>[\w:-]+)\s*(?:(?P<op>[~|^$*]?=)\s*(?:"(?P<dq>[^"]*)"|'(?P<sq>[^']*)'|(?P<bare>[\w-]+))\s*)?\]
    |:(?P<pseudo>first-child|last-child|only-child|first-of-type|last-of-type|empty|nth-child\(\s*(?P<nth>\d+)\s*\))""",
    re.VERBOSE,
)


@lru_cache(maxsize=4096)
def selector(text: str) -> tuple[tuple[Compound, ...], ...]:
    """The alternatives of a selector. Raises ValueError if it isn't one that is known."""
    s = text.strip()
    if not s:
        raise ValueError("empty selector")
    alternatives: list[list[Compound]] = [[]]
    now: Compound | None = None
    combinator, at = " ", 0
    while at < len(s):
        m = _TOKEN.match(s, at)
        if not m:
            raise ValueError(f"no selector at {s[at:]!r}")
        at = m.end()
        if m["space"] is not None:
            if now is None:
                raise ValueError(f"nothing before {m['space']!r} in {s!r}")
            if m["comb"] == ",":
                alternatives.append([])
                combinator = " "
            else:
                combinator = m["comb"] or " "
            now = None
            continue
        if now is None:
            now = Compound(combinator)
            alternatives[-1].append(now)
        elif m["tag"]:
            raise ValueError(f"misplaced {m['tag']!r} in {s!r}")
        if m["tag"]:
            now.tag = m["tag"].lower()
        elif m["cls"]:
            now.tests.append(("class", m["cls"]))
        elif m["id"]:
            now.tests.append(("id", m["id"]))
        elif m["attr"]:
            now.tests.append(("attr", m["attr"].lower(), m["op"], next((v for v in (m["dq"], m["sq"], m["bare"]) if v is not None), None)))
        else:
            now.tests.append(("pseudo", "nth-child" if m["nth"] else m["pseudo"], int(m["nth"] or 0)))
    if now is None:
        raise ValueError(f"selector ends early: {s!r}")
    return tuple(tuple(a) for a in alternatives)


def _siblings(e: Element) -> list[Element]:
    return [c for c in e.parent.children if isinstance(c, Element)] if e.parent else [e]


def _passes(e: Element, test: tuple) -> bool:
    kind = test[0]
    if kind == "class":
        return test[1] in e.classes
    if kind == "id":
        return e.attrs.get("id") == test[1]
    if kind == "attr":
        _, name, op, want = test
        if name not in e.attrs:
            return False
        have = e.attrs[name]
        match op:
            case None:
                return True
            case "=":
                return have == want
            case "~=":
                return want in have.split()
            case "|=":
                return have == want or have.startswith(want + "-")
            case "^=":
                return bool(want) and have.startswith(want)
            case "$=":
                return bool(want) and have.endswith(want)
            case _:
                return bool(want) and want in have
    around = _siblings(e)
    if test[1].endswith("of-type"):
        around = [x for x in around if x.name == e.name]
    match test[1]:
        case "first-child" | "first-of-type":
            return around[0] is e
        case "last-child" | "last-of-type":
            return around[-1] is e
        case "only-child":
            return len(around) == 1
        case "empty":
            return not e.children
        case _:
            return len(around) >= test[2] > 0 and around[test[2] - 1] is e


def _fits(e: Element, parts: tuple[Compound, ...]) -> bool:
    last = parts[-1]
    if last.tag not in ("*", e.name) or not all(_passes(e, t) for t in last.tests):
        return False
    if len(parts) == 1:
        return True
    rest = parts[:-1]
    if last.combinator == ">":
        return e.parent is not None and e.parent.name != "[document]" and _fits(e.parent, rest)
    if last.combinator in "+~":
        around = _siblings(e)
        before = around[: next(i for i, x in enumerate(around) if x is e)]
        return any(_fits(x, rest) for x in (before[-1:] if last.combinator == "+" else before))
    up = e.parent
    while up is not None and up.name != "[document]":
        if _fits(up, rest):
            return True
        up = up.parent
    return False


@lru_cache(maxsize=4096)
def _quick(text: str) -> tuple[frozenset[str], frozenset[str], tuple[tuple[Compound, ...], ...]]:
    """A selector's alternatives that are only a tag or only a class, and the others."""
    tags, classes, rest = set(), set(), []
    for a in selector(text):
        one = a[0] if len(a) == 1 else None
        if one and not one.tests and one.tag != "*":
            tags.add(one.tag)
        elif one and one.tag == "*" and len(one.tests) == 1 and one.tests[0][0] == "class":
            classes.add(one.tests[0][1])
        else:
            rest.append(a)
    return frozenset(tags), frozenset(classes), tuple(rest)


def _matching(root: Element, text: str) -> Iterator[Element]:
    tags, classes, rest = _quick(text)
    for e in root.elements():
        if e.name in tags or (classes and (own := e.attrs.get("class")) and not classes.isdisjoint(own.split())) or (rest and any(_fits(e, a) for a in rest)):
            yield e


def select(root: Element, text: str) -> list[Element]:
    """Elements below ``root`` that fit, in document order."""
    return list(_matching(root, text))


def select_one(root: Element, text: str) -> Element | None:
    return next(_matching(root, text), None)
