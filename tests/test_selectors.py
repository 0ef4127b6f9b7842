"""Selectors in one pass against an element tree, and the cases their docstring names."""

import random
import time

import pytest

from jobstar.functions.selectors import Machine, Step, attributes, select
from jobstar.operators import board
from jobstar.operators import pages as P
from tests import dom

CLASSES = [P.SECTIONS_CLASS, P.DETAIL_VALUE_CLASS, P.DEADLINE_CLASS, "w " + P.FIELD_CLASS, P.VALUE_CLASS, "x " + P.VALUE_CLASS,
           P.GENERAL_CLASS, P.GENERAL_VALUE_CLASS, P.TAGS_CLASS, P.CATEGORY_CLASS, P.CATEGORY_TAGS_CLASS, P.HEADER_CLASS,
           P.CARD_LABEL_CLASS, P.CARD_COMPANY_CLASS, P.CARD_UPDATED_CLASS, P.CARD_CITY_CLASS, P.CARD_REMAIN_CLASS]
TEXTS = [P.DESCRIPTION_HEADING, P.SIZE_LABEL + ":", "a &amp; b", "&#8211;", " ", "x\n y", "1 < 2", P.ADDRESS_HEADING]


def _page(r: random.Random, depth: int, nest: frozenset = frozenset()) -> str:
    """Random elements; a class that scopes others does not nest in itself, where the tree repeats an element."""
    out = []
    for _ in range(r.randint(0, 4)):
        if depth == 0 or r.random() < 0.3:
            out.append(r.choice(TEXTS))
            continue
        tag = r.choice(["div", "div", "div", "span", "a", "h3", "label", "br", "p"])
        if tag in nest:
            continue
        cls = r.choice([c for c in CLASSES if c not in nest] or [""]) if r.random() < 0.7 else ""
        quote = r.choice("\"'")
        attrs = f" class={quote}{cls}{quote}" if cls else ""
        attrs += " href=/x?a=1&b=2" if tag == "a" else ""
        if tag == "br":
            out.append("<br/>")
            continue
        inner = nest | ({cls} if cls else set()) | ({tag} if tag in ("span", "a", "h3") else set())
        end = "" if r.random() < 0.05 else f"</{tag}>"
        out.append(f"<{tag}{attrs}>{_page(r, depth - 1, inner)}{end}" + ("</i>" if r.random() < 0.05 else ""))
    return "".join(out)


def _filled(r: random.Random) -> str:
    """A detail page and cards with random parts, in random order, around random elements."""
    def div(cls, *inner):
        return f'<div class="{cls}">' + "".join(inner) + "</div>"

    def some(*parts):
        kept = [p for p in parts if r.random() < 0.7]
        r.shuffle(kept)
        return "".join(kept) or "<i></i>"

    noise = _page(r, 1, frozenset(CLASSES))
    value = div(P.DETAIL_VALUE_CLASS, r.choice(TEXTS))
    section = [f"<div>{some(value, '<p>x</p>', value)}</div>" for _ in range(4)]
    label = div(P.CARD_LABEL_CLASS, some(f"<label class={P.CARD_CITY_CLASS}>HN</label>", f"<label class='{P.CARD_REMAIN_CLASS}'>2</label>"))
    card = div(P.HEADER_CLASS, some("<h3><a href='/1?a=1&amp;b'><span>T</span></a><a href=/2><span>U</span></a></h3>", noise),
               some(f"<a class={P.CARD_COMPANY_CLASS}>C</a>"), some(f"<label class={P.CARD_UPDATED_CLASS}>d</label>", label), label)
    return some(div(P.SECTIONS_CLASS, *section[:r.randint(0, 4)]), div(P.DEADLINE_CLASS, noise), "</div>",
                f"<h3>{P.DESCRIPTION_HEADING}</h3><p>no</p><div>{noise}</div><div>no</div>", f"<h3>{P.REQUIREMENTS_HEADING}</h3><div>r</div>",
                f"<div>{P.SIZE_LABEL}: </div>" + div("x " + P.VALUE_CLASS, "10-20"),
                div("w " + P.FIELD_CLASS, some(div(P.VALUE_CLASS, "IT"))),
                div(P.GENERAL_CLASS, *(div(P.GENERAL_VALUE_CLASS, str(i), noise) for i in range(r.randint(0, 6)))),
                div(P.TAGS_CLASS, some("<span>a<b>b</b></span>", "<span></span>")), div(P.CATEGORY_TAGS_CLASS, "<a>s</a><a>t</a>"),
                div(P.CATEGORY_CLASS, div(P.CATEGORY_TAGS_CLASS, "<span><a>u</a></span>", "<span><a>v</a></span>"))) + card * r.randint(0, 2)


def test_agrees_with_the_tree():
    r = random.Random(5)
    filled = cards = 0
    for i in range(4000):
        page = _filled(r) if i % 2 else _page(r, r.randint(1, 6))
        # the tree walks heading by heading, the selectors go in document order: alike where headings do not nest
        want, got = dom.detail_of(page), board.detail_of(page)
        if page.count(P.DESCRIPTION_HEADING) > 1 or page.count(P.ADDRESS_HEADING) > 1 or page.count(P.SIZE_LABEL) > 1:
            for name in ("description", "work_address", "company_size"):
                assert (want.pop(name) is None) == (got.pop(name) is None)
        assert got == want, page
        assert board.cards_of(page) == dom.cards_of(page), page
        filled += sum(v not in (None, []) for v in got.values())
        cards += len(board.cards_of(page))
    assert filled > 10_000 and cards > 300


def _texts(html, *path, **kw):
    return Machine({"x": select(*path, **kw)}).row(html)["x"]


@pytest.mark.parametrize("html, want", [
    ("<p>a<p>b", ["a b", "b"]), ("<P CLASS=x>A</p >", ["A"]), ("<p/>t", [""]), ("<p>a<!-- </p> -->b</p>c", ["ab"]),
    ("<p>a<!-->b</p>", ["ab"]), ("<p>a<!-- <p>b</p>", ["a"]), ("<p>a<script>'</p>'</script>b</p>", ["a b"]),
    ("<p>a<script>never ended</p>", ["a"]), ("<template><p>a</p></template><p>b</p>", ["b"]),
    ("<p title='>'>a</p>", ["a"]), ('<p title="a>a</p><p>b</p>', ["a", "b"]), ("<p>a<p", ["a"]), ("<p>1 < 2 &lt; 3", ["1 < 2 < 3"]),
    ("<title><p>a</p></title><p>b", ["b"]), ("<p>a</b></p>b", ["a"]), ("", []), (None, []), ("<div <p", []), ("a>b", [])])
def test_markup(html, want):
    assert _texts(html, Step("p")) == want


def test_paths():
    html = "<ul><li>1<li class=k>2</li></ul><ul><li>3</li><b>k</b><i>4</i><b>n</b><i>5</i></ul>"
    assert _texts(html, Step("ul"), Step("li")) == ["1 2", "2", "3"]
    assert _texts(html, Step("ul"), Step("li", axis="child")) == ["1 2", "3"]
    assert _texts(html, Step("li", "k")) == ["2"]
    assert _texts(html, Step("ul", once=True), Step("li"), most=1) == ["1 2"]
    assert _texts(html, Step("ul", nth=2), Step("li")) == ["3"]
    assert _texts(html, Step("b", text="n"), Step("i", axis="after")) == ["5"]
    assert _texts(html, Step("b", text_part="k"), Step("i", axis="after")) == ["4", "5"]
    assert _texts("<a href='/x?copy=1&copy=2&amp;b'>t</a><a>u</a>", Step("a"), attr="href") == ["/x?copy=1&copy=2&b", None]
    with pytest.raises(ValueError):
        Machine({"x": select(Step("b", text="n"))})


def test_rows_inside_rows():
    html = "<div class=r><p>a</p><div class=r><p>b</p><p>c</p></div><p>d</p></div>"
    m = Machine({"p": select(Step("p")), "first": select(Step("p", once=True))}, each=(Step("div", "r"),))
    assert m.rows(html) == [{"p": ["a", "d"], "first": ["a"]}, {"p": ["b", "c"], "first": ["b"]}]
    assert m.rows("") == []


def test_attributes():
    assert attributes(" a='1' b=2/ c A=3 /") == ({"a": "1", "b": "2/", "c": ""}, True)
    assert attributes(" href=/x/") == ({"href": "/x/"}, False)


def test_bad_markup_takes_time_in_proportion():
    """Each page would take minutes if reading it went back over it."""
    m = Machine({"x": select(Step("p"), most=1)})
    start = time.monotonic()
    for page in ("<a " * 200_000, "<a b=\"" * 100_000, "<!-- " * 200_000 + ">", "</x>" * 200_000, "<p>" * 100_000 + "</x>" * 100_000,
                 "<p " + "=" * 400_000 + ">", "<" * 400_000 + ">", "<p a='" * 100_000 + ">"):
        m.row(page)
    assert time.monotonic() - start < 30
