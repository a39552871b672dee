"""Selectors on the light tree of ``html``: compiled once, matched from the last step back.

A selector is a list of steps. A step names a tag, an id, classes and attributes
(present, equal or with an ending), in any mixture; steps are joined by a blank
(anywhere below), ``>`` (a child) or ``+`` (the next element). A selector that
begins with ``>`` is about children of the node that it is asked of. Commas give
alternatives; matches come in document order.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

from .html import Node

_STEP = re.compile(r"""(?P<tag>[a-zA-Z][\w-]*|\*)?(?P<rest>(?:[#.][\w-]+|\[[\w-]+(?:\$?=(?:"[^"]*"|'[^']*'))?\])*)""")
_PART = re.compile(r"""([#.])([\w-]+)|\[([\w-]+)(?:(\$?=)["']([^"']*)["'])?\]""")
#: Text in these is no text of the page.
UNSEEN = {"script", "style", "template"}


@dataclass(frozen=True)
class Step:
    joint: str  # how it hangs on the step before: " ", ">" or "+"
    tag: str | None
    tests: tuple[tuple[str, str, str], ...]  # (attribute, operator, value)

    def fits(self, node: Node) -> bool:
        if self.tag and node.tag != self.tag:
            return False
        for name, how, value in self.tests:
            held = node.attrs.get(name)
            if held is None and name in node.attrs:
                held = ""
            if held is None or (how == "~=" and value not in held.split()) or (how == "=" and held != value) or (how == "$=" and not held.endswith(value)):
                return False
        return True


@lru_cache(maxsize=None)
def compiled(selector: str) -> tuple[tuple[Step, ...], ...]:
    """The steps of each alternative; a selector that can't be read is an error."""
    out = []
    for one in selector.split(","):
        text, steps = one.strip(), []
        while text:
            joint = " "
            if text[0] in ">+":
                joint, text = text[0], text[1:].lstrip()
            m = _STEP.match(text)
            if not m[0]:
                raise ValueError(f"no selector: {selector!r}")
            tests = tuple(({"#": "id", ".": "class"}[mark], "=" if mark == "#" else "~=", name) if mark else (attr, how, value) for mark, name, attr, how, value in _PART.findall(m["rest"]))
            steps.append(Step(joint, None if m["tag"] in (None, "*") else m["tag"].lower(), tests))
            text = text[m.end() :].lstrip()
        if not steps:
            raise ValueError(f"no selector: {selector!r}")
        out.append(tuple(steps))
    return tuple(out)


def _before(node: Node) -> Node | None:
    last = None
    for c in node.parent.children if node.parent else ():
        if c is node:
            return last
        if isinstance(c, Node):
            last = c
    return None


def _hangs(node: Node, steps: tuple[Step, ...], k: int, top: Node) -> bool:
    """Whether the steps before the k-th hold for the surroundings of a node that fits it."""
    joint = steps[k].joint
    if k == 0:
        return joint != ">" or node.parent is top
    if joint == "+":
        other = _before(node)
        return other is not None and steps[k - 1].fits(other) and _hangs(other, steps, k - 1, top)
    other = node.parent
    while other is not None:
        if steps[k - 1].fits(other) and _hangs(other, steps, k - 1, top):
            return True
        if joint == ">" or other is top:
            return False
        other = other.parent
    return False


def select(top: Node, selector: str) -> list[Node]:
    """All nodes below that match, in document order."""
    ways = compiled(selector)
    return [n for n in top.walk() if isinstance(n, Node) and any(w[-1].fits(n) and _hangs(n, w, len(w) - 1, top) for w in ways)]


def first(top: Node, *selectors: str) -> Node | None:
    """The first match of the first selector that has one."""
    for s in selectors:
        if found := select(top, s):
            return found[0]
    return None


def first_of(top: Node, *selectors: str) -> list[Node]:
    """All matches of the first selector that has any: layouts in order of preference."""
    for s in selectors:
        if found := select(top, s):
            return found
    return []


def said(node: Node | None) -> str:
    """What the page shows: its strings without outer blanks, a blank between; scripts and styles aside."""
    if node is None:
        return ""
    parts: list[str] = []

    def visit(n: Node) -> None:
        for c in n.children:
            if isinstance(c, str):
                if s := c.strip():
                    parts.append(s)
            elif c.tag not in UNSEEN:
                visit(c)

    visit(node)
    return " ".join(parts)


def after(node: Node, *, until: tuple[str, ...] = ()) -> list[Node]:
    """The elements that follow at the same level, up to one of these tags."""
    out, seen = [], False
    for c in node.parent.children if node.parent else ():
        if c is node:
            seen = True
        elif seen and isinstance(c, Node):
            if c.tag in until:
                break
            out.append(c)
    return out
