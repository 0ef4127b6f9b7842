"""Selectors over stored pages, matched all at once in one pass without a tree.

A ``Machine`` compiles its selectors into one automaton over the begin and
end events of a page. Its state inside an element is the set of steps that
may come next; states and moves are found as pages need them and kept, so
on pages of one template an event costs two table lookups, whatever the
number of selectors. Conditions on an element's own text are decided at its
end, which is soon enough, since only later siblings may depend on them.

Tags follow the HTML rules for quotes, comments, raw text and unfinished
tags; ``<x/>`` is an empty element, an end without a begin is skipped, an
end closes what is open inside its element. Elements inside hidden ones
(script, style, template, noscript) match nothing and show no text. Matches
come in document order, an element once per selector.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping
from html import unescape
from typing import NamedTuple

# ---- fixed values: element kinds of HTML --------------------------------
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
HIDDEN = {"script", "style", "template", "noscript"}
RAW = {"script", "style"}
RAW_TEXT = {"title", "textarea"}  # text with character references, no tags
# -------------------------------------------------------------------------
_TOKEN = re.compile(r"""<(?:(/?)([a-zA-Z][^\s/>]*)((?>=\s*"[^"]*"|=\s*'[^']*'|[^>=]+|=)*+)>"""
                    r"""|!--(?:-?>|.*?(?:--!?>|\Z))|[!?/][^>]*>)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_REFERENCE = re.compile(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*)(?:;|(?![=a-zA-Z0-9]))")
_KEPT_TAGS = 20_000  # begin tags whose reading is kept; more make room by starting over


class Step(NamedTuple):
    """One element of a selector's path; conditions left out hold for any element of the tag."""
    tag: str
    cls: str | None = None        # the class attribute is exactly this
    cls_part: str | None = None   # ... contains this
    text: str | None = None       # the element's own text is exactly this; the next step must be "after"
    text_part: str | None = None  # ... contains this
    nth: int = 0                  # n-th child of its tag, from 1
    once: bool = False            # only the first such element of the page, or of the row
    axis: str = "in"              # "in": any depth below the step before, "child", or "after": a later sibling


class Selector(NamedTuple):
    path: tuple[Step, ...]
    attr: str | None = None       # value of an attribute instead of the visible text
    most: int | None = None       # matches wanted


def select(*path: Step, attr: str | None = None, most: int | None = None) -> Selector:
    return Selector(path, attr, most)


def attributes(raw: str) -> tuple[dict[str, str], bool]:
    """Attributes of a begin tag (the first of a name counts) and whether it ends itself."""
    out: dict[str, str] = {}
    end, bare = 0, False
    for m in _ATTRIBUTE.finditer(raw):
        value = next((g for g in m.groups()[1:] if g is not None), "")
        out.setdefault(m[1].lower(), _REFERENCE.sub(lambda r: unescape(r[0]), value) if "&" in value else value)
        end, bare = m.end(), m[4] is not None
    return out, raw.endswith("/") and not (bare and end == len(raw))


class _State:
    """Steps that may come next inside an element: (selector, step, at any depth)."""

    def __init__(self, items: frozenset, counted: bool):
        self.items, self.counted, self.moves = items, counted, {}


class _Open:
    """An element whose end has not come."""
    __slots__ = ("tag", "state", "counts", "captures", "tests", "own", "row")

    def __init__(self, tag, state):
        self.tag, self.state = tag, state
        self.counts = self.captures = self.tests = self.own = self.row = None


class Machine:
    """Selectors compiled into one automaton; ``each`` names the element that makes a row (default: the page).

    With ``each``, the selectors' paths begin below it, and a match belongs to the innermost row around it.
    """

    def __init__(self, selectors: Mapping[str, Selector], each: tuple[Step, ...] | None = None):
        self.names, self.each = list(selectors), each is not None
        parts = [Selector(tuple(each))] if each else []
        parts += [s._replace(path=(*(each or ()), *s.path)) for s in selectors.values()]
        self.selectors = parts
        for s in parts:
            for a, b in zip(s.path, (*s.path[1:], None)):
                if (a.text is not None or a.text_part is not None) and (b is None or b.axis != "after"):
                    raise ValueError("a step with a text needs a later sibling as the next step")
        kinds = dict.fromkeys((t.tag, t.cls, t.cls_part) for s in parts for t in s.path)
        self.bits = {kind: 1 << i for i, kind in enumerate(kinds)}
        self.tags = {tag for tag, _, _ in kinds}
        self.states: dict[frozenset, _State] = {}
        self.begins: dict[tuple[str, str], tuple[int, dict, bool]] = {}
        self.start = self._state(frozenset((i, 0, True) for i in range(len(parts))))
        self.nothing = self._state(frozenset())

    def _state(self, items: frozenset) -> _State:
        if items not in self.states:
            counted = any(self.selectors[s].path[i].nth for s, i, _ in items)
            self.states[items] = _State(items, counted)
        return self.states[items]

    def _begin(self, tag: str, raw: str) -> tuple[int, dict, bool]:
        """What a begin tag's text says: conditions that hold, attributes, whether it ends itself."""
        attrs, ended = attributes(raw)
        name, mask = attrs.get("class", ""), 0
        for (t, cls, part), bit in self.bits.items():
            if t == tag and (cls is None or name.strip() == cls) and (part is None or part in name):
                mask |= bit
        if len(self.begins) >= _KEPT_TAGS:
            self.begins.clear()
        self.begins[tag, raw] = mask, attrs, ended
        return mask, attrs, ended

    def _move(self, state: _State, mask: int, place: int, spent: frozenset) -> tuple:
        """(state inside, selectors matched, steps whose text is to be tested, state of what follows, steps spent)."""
        inside = {item for item in state.items if item[2]}
        after, matched, tests, used = set(state.items), [], [], set(spent)
        for s, i, _ in sorted(state.items):
            path = self.selectors[s].path
            step = path[i]
            if not mask & self.bits[step.tag, step.cls, step.cls_part] or (step.nth and step.nth != place):
                continue
            if step.once:
                if (s, i) in spent:
                    continue
                used.add((s, i))
            if step.text is not None or step.text_part is not None:
                tests.append((s, i))
            elif i + 1 == len(path):
                matched.append(s)
            elif path[i + 1].axis == "after":
                after.add((s, i + 1, False))
            else:
                inside.add((s, i + 1, path[i + 1].axis == "in"))
        return (self._state(frozenset(inside)), tuple(dict.fromkeys(matched)), tuple(dict.fromkeys(tests)),
                self._state(frozenset(after)), frozenset(used))

    def rows(self, html: str | None) -> list[dict[str, list[str | None]]]:
        """Matches per selector of each row, in the order in which rows begin; a null page has no match."""
        return _Run(self, html or "").rows

    def row(self, html: str | None) -> dict[str, list[str | None]]:
        return self.rows(html)[0]


class _Run:
    """One pass over one page."""

    def __init__(self, machine: Machine, html: str):
        self.m = machine
        self.rows: list[dict] = [] if machine.each else [{n: [] for n in machine.names}]
        self.within = [] if machine.each else [self.rows[0]]
        self.spent: frozenset = frozenset()
        self.stack = [_Open("", machine.start)]
        self.open_tags: Counter[str] = Counter()
        self.parts: list[str] = []
        self.capturing = self.hidden = 0
        self._scan(html)

    def _scan(self, html: str) -> None:
        at, stop = 0, html.rfind(">") + 1  # behind the last ">" no tag ends
        while m := _TOKEN.search(html, at, stop):
            if m.start() > at:
                self._text(html[at:m.start()])
            at = m.end()
            if m[2] is None:
                if at == stop and m[0].startswith("<!--") and not re.search(r"--!?>\Z|\A<!--?-?>\Z", m[0]):
                    at = len(html)  # a comment without an end
                continue
            tag = m[2].lower()
            if m[1]:
                self._end(tag)
            elif not self._begin(tag, m[3]):
                if tag in RAW or tag in RAW_TEXT:
                    close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
                    end = close.start() if close else len(html)
                    if tag in RAW_TEXT:
                        self._text(html[at:end])
                    at = end
        rest = html[at:]
        cut = re.search(r"<[a-zA-Z/!?]", rest)  # an unfinished tag shows nothing
        self._text(rest[:cut.start()] if cut else rest)
        while len(self.stack) > 1:
            self._close()

    def _text(self, raw: str) -> None:
        top = self.stack[-1]
        if not raw or self.hidden or (not self.capturing and top.own is None):
            return
        text = unescape(raw) if "&" in raw else raw
        if self.capturing:
            self.parts.append(text)
        if top.own is not None:
            top.own.append(text)

    def _begin(self, tag: str, raw: str) -> bool:
        """Open an element; whether it is closed again."""
        m, parent = self.m, self.stack[-1]
        if tag in m.tags:
            mask, attrs, ended = m.begins.get((tag, raw)) or m._begin(tag, raw)
        else:
            mask, attrs, ended = 0, {}, raw.endswith("/") and attributes(raw)[1]
        state, place = parent.state, 0
        if state.counted:
            parent.counts = parent.counts or Counter()
            parent.counts[tag] += 1
            place = parent.counts[tag]
        key = (mask, place, self.spent)
        move = state.moves.get(key)
        if move is None:
            move = state.moves[key] = m._move(state, *key)
        inside, matched, tests, parent.state, self.spent = move
        e = _Open(tag, m.nothing if tag in HIDDEN else inside)
        if self.capturing:
            self.parts.append(" ")
        for s in matched:
            if s == 0 and m.each:
                e.row = self.spent  # put back at the row's end
                self.spent = frozenset()
                self.within.append({n: [] for n in m.names})
                self.rows.append(self.within[-1])
                continue
            wanted, found = m.selectors[s], self.within[-1][m.names[s - m.each]]
            if wanted.most is not None and len(found) >= wanted.most:
                continue
            found.append(attrs.get(wanted.attr) if wanted.attr else None)
            if wanted.attr is None:
                e.captures = e.captures or []
                e.captures.append((found, len(found) - 1, len(self.parts)))
                self.capturing += 1
        if tests:
            e.tests, e.own = tests, []
        self.stack.append(e)
        self.open_tags[tag] += 1
        self.hidden += tag in HIDDEN
        if ended or tag in VOID:
            self._close()
            return True
        return False

    def _end(self, tag: str) -> None:
        if self.open_tags[tag] > 0:
            while self._close() != tag:
                pass

    def _close(self) -> str:
        """Close the innermost element."""
        e, m = self.stack.pop(), self.m
        self.open_tags[e.tag] -= 1
        self.hidden -= e.tag in HIDDEN
        if e.captures:
            shown = " ".join("".join(self.parts[e.captures[0][2]:]).split())
            for found, i, _ in e.captures:
                found[i] = shown
            self.capturing -= len(e.captures)
            if not self.capturing:
                self.parts.clear()
        if self.capturing:
            self.parts.append(" ")
        if e.tests:
            own, parent = "".join(e.own), self.stack[-1]
            held = [(s, i) for s, i in e.tests
                    if m.selectors[s].path[i].text in (None, own) and (m.selectors[s].path[i].text_part or "") in own]
            if held:
                parent.state = m._state(parent.state.items | {(s, i + 1, False) for s, i in held})
        if e.row is not None:
            self.within.pop()
            self.spent = e.row
        return e.tag
