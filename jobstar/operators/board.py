"""Pages of the scraped board -> bronze A records.

Listing pages give cards, detail pages give typed fields, and the two are
merged per link into the 22-column landing record.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstar import schemas
from jobstar.functions.keys import row_key
from jobstar.functions.selectors import Machine, Selector, Step, select
from jobstar.operators.conform import to_schema
from jobstar.operators.pages import (
    ADDRESS_HEADING, CARD_CITY_CLASS, CARD_COMPANY_CLASS, CARD_LABEL_CLASS, CARD_REMAIN_CLASS, CARD_UPDATED_CLASS,
    CATEGORY_CLASS, CATEGORY_TAGS_CLASS, DEADLINE_CLASS, DESCRIPTION_HEADING, DETAIL_VALUE_CLASS, FIELD_CLASS,
    GENERAL_CLASS, GENERAL_VALUE_CLASS, HEADER_CLASS, REQUIREMENTS_HEADING, SECTIONS_CLASS, SIZE_LABEL, TAGS_CLASS,
    VALUE_CLASS, mapped_pages,
)

CARD_FIELDS = ("href", "title", "company_name", "update_time", "city", "remain_time")
TEXT_FIELDS = ("salary", "city", "yoe", "deadline_submit", "description", "requirements", "work_address",
               "company_size", "major_field", "level", "num_of_recruit", "work_form", "gender_require")
GENERAL_FIELDS = ("level", None, "num_of_recruit", "work_form", "gender_require")  # by place
LIST_FIELDS = ("main_industry", "skills", "area", "relation_fields")


def _after_heading(heading: str) -> Selector:
    return select(Step("h3", text=heading), Step("div", axis="after"), most=1)


def _section(n: int) -> Selector:
    """A value told by the number of its section, so a section without one does not shift the others."""
    return select(Step("div", SECTIONS_CLASS, once=True), Step("div", nth=n, axis="child"),
                  Step("div", DETAIL_VALUE_CLASS), most=1)


DETAIL = Machine({
    "salary": _section(1), "city": _section(2), "yoe": _section(3),
    "deadline_submit": select(Step("div", DEADLINE_CLASS), most=1),
    "description": _after_heading(DESCRIPTION_HEADING), "requirements": _after_heading(REQUIREMENTS_HEADING),
    "work_address": _after_heading(ADDRESS_HEADING),
    "company_size": select(Step("div", text_part=SIZE_LABEL), Step("div", cls_part=VALUE_CLASS, axis="after"), most=1),
    "major_field": select(Step("div", cls_part=FIELD_CLASS), Step("div", VALUE_CLASS), most=1),
    "general": select(Step("div", GENERAL_CLASS), Step("div", GENERAL_VALUE_CLASS), most=len(GENERAL_FIELDS)),
    "main_industry": select(Step("div", TAGS_CLASS), Step("span")),
    "skills": select(Step("div", CATEGORY_TAGS_CLASS), Step("a")),
    "area": select(Step("div", CATEGORY_CLASS), Step("div", CATEGORY_TAGS_CLASS), Step("span"), Step("a"))})

_LINK = (Step("h3"), Step("a", once=True))
_LABEL = Step("div", CARD_LABEL_CLASS)
CARDS = Machine({
    "href": select(*_LINK, attr="href", most=1), "title": select(*_LINK, Step("span"), most=1),
    "company_name": select(Step("a", CARD_COMPANY_CLASS), most=1),
    "update_time": select(Step("label", CARD_UPDATED_CLASS), most=1),
    "city": select(_LABEL, Step("label", CARD_CITY_CLASS), most=1),
    "remain_time": select(_LABEL, Step("label", CARD_REMAIN_CLASS), most=1)}, each=(Step("div", HEADER_CLASS),))


def detail_of(html: str | None) -> dict:
    """Fields of a detail page; an absent element is null, an absent list empty."""
    found = DETAIL.row(html)
    general = found.pop("general")
    found |= {name: general[i:i + 1] for i, name in enumerate(GENERAL_FIELDS) if name}
    out = {name: found[name][0] if found[name] else None for name in TEXT_FIELDS}
    out |= {name: found[name] for name in ("main_industry", "skills", "area")}
    out["relation_fields"] = out["skills"][:max(0, len(out["skills"]) - len(out["area"]))]
    return out


def cards_of(html: str | None) -> list[dict]:
    """Cards of a listing page in order; a card that lacks a field is skipped. A card inside another is its own."""
    return [{name: values[0] for name, values in card.items()} for card in CARDS.rows(html) if all(card.values())]


def board_cards(pages: DataFrame, keep: list[str], html_col: str = "html") -> DataFrame:
    """One row per complete card of each listing page, numbered in page order."""
    return mapped_pages(pages, keep, html_col, lambda h: [{"card_idx": i, **c} for i, c in enumerate(cards_of(h))],
                   {"card_idx": pa.int32(), **dict.fromkeys(CARD_FIELDS, pa.string())},
                   "card_idx int, " + ", ".join(f"{c} string" for c in CARD_FIELDS))


def board_detail(pages: DataFrame, keep: list[str], html_col: str = "html") -> DataFrame:
    """The typed fields and lists of each detail page."""
    return mapped_pages(pages, keep, html_col, lambda h: [detail_of(h)],
                   {**dict.fromkeys(TEXT_FIELDS, pa.string()), **dict.fromkeys(LIST_FIELDS, pa.list_(pa.string()))},
                   ", ".join([*(f"{c} string" for c in TEXT_FIELDS), *(f"{c} array<string>" for c in LIST_FIELDS)]))


def board_bronze(cards: DataFrame, detail: DataFrame) -> DataFrame:
    """Cards merged with the detail page of their ``href``, as bronze A
    records. A card whose detail page is missing is dropped, as in the source;
    the id is a hash of the link, so it is the same on every run.

    Both sides come out of Python, and the size that Spark infers for them says nothing of
    their texts: never a broadcast, which would pass all detail pages through the driver."""
    card = cards.select("href", "title", "company_name", "update_time", "remain_time")
    rows = card.join(detail.select("href", *TEXT_FIELDS, *LIST_FIELDS).hint("merge"), "href")
    return to_schema(rows.withColumn("id", row_key(rows, ["href"])), schemas.BRONZE_A)
