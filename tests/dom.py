"""Board pages by an element tree and repeated walks: what the selectors of one pass are tested against."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

from jobstar.operators.board import TEXT_FIELDS
from jobstar.operators.pages import (
    ADDRESS_HEADING, CATEGORY_CLASS, CATEGORY_TAGS_CLASS, DEADLINE_CLASS, DESCRIPTION_HEADING, DETAIL_VALUE_CLASS,
    FIELD_CLASS, GENERAL_CLASS, GENERAL_VALUE_CLASS, HEADER_CLASS, REQUIREMENTS_HEADING, SECTIONS_CLASS, SIZE_LABEL,
    TAGS_CLASS, VALUE_CLASS,
)

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
HIDDEN = {"script", "style", "template", "noscript"}


class Element:
    """An element with its attributes, its children (elements and texts) and its parent."""

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None = None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Element | str] = []

    @property
    def elements(self) -> list[Element]:
        return [c for c in self.children if isinstance(c, Element)]

    @property
    def own_text(self) -> str:
        return "".join(c for c in self.children if isinstance(c, str))

    def classed(self, name: str) -> bool:
        """Whether the class attribute is exactly ``name``."""
        return self.attrs.get("class", "").strip() == name

    def walk(self) -> Iterator[Element]:
        """Elements below this one in document order, at any depth."""
        stack = self.elements[::-1]
        while stack:
            e = stack.pop()
            yield e
            stack += e.elements[::-1]

    def find(self, tag: str, cls: str | None = None) -> list[Element]:
        return [e for e in self.walk() if e.tag == tag and (cls is None or e.classed(cls))]

    def following(self, tag: str) -> list[Element]:
        """Later siblings of a tag."""
        around = self.parent.elements if self.parent else []
        return [e for e in around[around.index(self) + 1:] if e.tag == tag] if around else []

    def text(self) -> str:
        """Visible text, white space squeezed."""
        parts, stack = [], [self]
        while stack:
            e = stack.pop()
            if isinstance(e, str):
                parts.append(e)
            elif e.tag not in HIDDEN:
                parts.append(" ")
                stack.append(" ")
                stack += e.children[::-1]
        return " ".join("".join(parts).split())


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("", {})

    def handle_starttag(self, tag, attrs):
        e = Element(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(e)
        if tag not in VOID:
            self.at = e

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Element(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        e = self.at
        while e.parent is not None and e.tag != tag:
            e = e.parent
        if e.parent is not None:  # an end without a begin is skipped
            self.at = e.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str | None) -> Element:
    """The tree of a page; a null page is an empty tree."""
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def _first(found: list[Element]) -> str | None:
    return found[0].text() if found else None


def _after_heading(root: Element, heading: str) -> str | None:
    return _first([d for h in root.find("h3") if h.own_text == heading for d in h.following("div")])


def detail_of(html: str | None) -> dict:
    """Fields of a detail page; an absent element is null, an absent list empty.

    Salary, city and experience are told by the number of their section, so a
    section without a value does not shift the others.
    """
    root = parse(html)
    out: dict = dict.fromkeys(TEXT_FIELDS)
    sections = [d for s in root.find("div", SECTIONS_CLASS)[:1] for d in s.elements if d.tag == "div"]
    for name, section in zip(("salary", "city", "yoe"), sections):
        out[name] = _first(section.find("div", DETAIL_VALUE_CLASS))
    out["deadline_submit"] = _first(root.find("div", DEADLINE_CLASS))
    for name, heading in (("description", DESCRIPTION_HEADING), ("requirements", REQUIREMENTS_HEADING),
                          ("work_address", ADDRESS_HEADING)):
        out[name] = _after_heading(root, heading)
    out["company_size"] = _first([v for d in root.find("div") if SIZE_LABEL in d.own_text
                                  for v in d.following("div") if VALUE_CLASS in v.attrs.get("class", "")])
    out["major_field"] = _first([v for d in root.find("div") if FIELD_CLASS in d.attrs.get("class", "")
                                 for v in d.find("div", VALUE_CLASS)])
    general = [v.text() for g in root.find("div", GENERAL_CLASS) for v in g.find("div", GENERAL_VALUE_CLASS)]
    for name, place in (("level", 0), ("num_of_recruit", 2), ("work_form", 3), ("gender_require", 4)):
        out[name] = general[place] if place < len(general) else None
    out["main_industry"] = [s.text() for d in root.find("div", TAGS_CLASS) for s in d.find("span")]
    tags = root.find("div", CATEGORY_TAGS_CLASS)
    out["skills"] = [a.text() for d in tags for a in d.find("a")]
    out["area"] = [a.text() for c in root.find("div", CATEGORY_CLASS) for d in c.find("div", CATEGORY_TAGS_CLASS)
                   for s in d.find("span") for a in s.find("a")]
    out["relation_fields"] = out["skills"][:max(0, len(out["skills"]) - len(out["area"]))]
    return out


def cards_of(html: str | None) -> list[dict]:
    """Cards of a listing page in order; a card that lacks a field is skipped."""
    out = []
    for box in parse(html).find("div", HEADER_CLASS):
        link = [a for h in box.find("h3") for a in h.find("a")][:1]
        label = [d for d in box.find("div", "label-content")]
        found = {
            "title": [s for a in link for s in a.find("span")],
            "company_name": box.find("a", "company"), "update_time": box.find("label", "deadline"),
            "city": [x for d in label for x in d.find("label", "address")],
            "remain_time": [x for d in label for x in d.find("label", "time")]}
        if link and all(found.values()):
            out.append({"href": link[0].attrs.get("href"), **{k: v[0].text() for k, v in found.items()}})
    return out
