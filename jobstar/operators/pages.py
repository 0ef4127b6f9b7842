"""Extraction over stored pages and API responses.

The source extracted these fields inside a browser session. Once raw pages
sit in a table, extraction is a projection: regex expressions per row,
``posexplode`` for repeated blocks, a join to merge listing and detail.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobstar.functions import html as H
from jobstar.functions.selectors import Machine, Selector, Step
from jobstar.functions.text import as_col

# ---- fixed values: class names and headings of the scraped board --------
SECTIONS_CLASS = "job-detail__info--sections"
DETAIL_VALUE_CLASS = "job-detail__info--section-content-value"  # salary, city, yoe
DEADLINE_CLASS = "job-detail__info--deadline"
DESCRIPTION_HEADING = "Mô tả công việc"
REQUIREMENTS_HEADING = "Yêu cầu ứng viên"
ADDRESS_HEADING = "Địa điểm làm việc"
SIZE_LABEL = "Quy mô"
FIELD_CLASS = "company-field"
VALUE_CLASS = "company-value"
GENERAL_CLASS = "box-general-content"
GENERAL_VALUE_CLASS = "box-general-group-info-value"  # level, _, recruits, form, gender
TAGS_CLASS = "job-tags"
CATEGORY_CLASS = "box-category"
CATEGORY_TAGS_CLASS = "box-category-tags"
HEADER_CLASS = "box-header"
CARD_COMPANY_CLASS = "company"
CARD_UPDATED_CLASS = "deadline"
CARD_LABEL_CLASS = "label-content"
CARD_CITY_CLASS = "address"
CARD_REMAIN_CLASS = "time"
# -------------------------------------------------------------------------


def mapped_pages(pages: DataFrame, keep: list[str], html_col: str, make: Callable[[str | None], list[dict]],
                 fields: dict[str, pa.DataType], ddl: str) -> DataFrame:
    """The rows that ``make`` finds in each page, with the page's ``keep`` columns, in Arrow batches."""
    rows = pages.select(*keep, F.col(html_col).alias("__html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            taken, found = [], []
            for i, html in enumerate(b.column("__html").to_pylist()):
                for row in make(html):
                    taken.append(i)
                    found.append(row)
            kept = [b.column(c).take(pa.array(taken, pa.int64())) for c in keep]
            yield pa.RecordBatch.from_arrays(
                [*kept, *(pa.array([r[n] for r in found], t) for n, t in fields.items())], names=[*keep, *fields])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__html")
    return rows.mapInArrow(run, f"{kept}, {ddl}")


def selected(pages: DataFrame, selectors: Mapping[str, Selector], keep: list[str], html_col: str = "html",
             each: tuple[Step, ...] | None = None) -> DataFrame:
    """X1, X2, X5, X7 by selectors (``functions.selectors``): a list of matches per selector and page, or per element ``each``.

    For pages whose elements nest, or whose quotes and character references vary; the regular expressions below stay in
    the JVM and serve pages of plain markup. ``row_idx`` numbers the rows of a page from 0. A page is read once,
    whatever the number of selectors. A null page is one row of empty lists, or none with ``each``.
    """
    machine = Machine(selectors, each)
    return mapped_pages(pages, keep, html_col, lambda h: [{"row_idx": i, **r} for i, r in enumerate(machine.rows(h))],
                        {"row_idx": pa.int32(), **dict.fromkeys(selectors, pa.list_(pa.string()))},
                        ", ".join(["row_idx int", *(f"`{n}` array<string>" for n in selectors)]))


def extract_fields(df: DataFrame, html_col: str, fields: dict[str, Column],
                   keep: list[str] | None = None) -> DataFrame:
    """One typed row per page from ``{name: expression}``."""
    keep = keep if keep is not None else [c for c in df.columns if c != html_col]
    return df.select(*keep, *[c.alias(n) for n, c in fields.items()])


def split_head(arr, tail) -> Column:
    """``arr[:len(arr) - len(tail)]`` (the tail items are assumed last)."""
    a = as_col(arr)
    return F.slice(a, 1, F.greatest(F.size(a) - F.size(as_col(tail)), F.lit(0)))


def cards(df: DataFrame, id_col: str, html_col: str, block_pattern: str,
          fields: dict[str, str]) -> DataFrame:
    """One row per repeated block (e.g. a listing card).

    ``block_pattern`` captures a block in group 1; ``fields`` maps a name
    to a regex whose group 1 is the value inside the block. A block with a
    missing field is skipped, as the source skipped a card that raised.
    """
    blocks = F.regexp_extract_all(H.strip_noise(F.col(html_col)), F.lit(block_pattern), F.lit(1))
    x = df.select(id_col, F.posexplode(blocks).alias("card_idx", "__block"))
    vals = {n: F.nullif(H.html_text(F.regexp_extract("__block", p, 1)), F.lit(""))
            for n, p in fields.items()}
    x = x.select(id_col, "card_idx", *[v.alias(n) for n, v in vals.items()])
    return x.filter(reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in fields]))


def links_indexed(df: DataFrame, id_col: str, html_col: str, tag: str = "a",
                  attr: str = "href") -> DataFrame:
    """Every ``<tag>`` numbered in document order; the ones without a
    target are then dropped, keeping the original index."""
    tags = F.regexp_extract_all(H.strip_noise(F.col(html_col)), F.lit(rf"(?is)<{tag}\b([^>]*)>"), F.lit(1))
    x = df.select(id_col, F.posexplode(tags).alias("idx", "__attrs"))
    x = x.select(id_col, "idx", F.regexp_extract("__attrs", rf'(?i)\b{attr}="([^"]*)"', 1).alias(attr))
    return x.filter(F.col(attr) != F.lit(""))


def envelope_rows(df: DataFrame, data_col: str = "data", pages_path: str = "meta.nbPages",
                  keep: list[str] | None = None) -> DataFrame:
    """API response envelopes -> one row per item of ``data`` plus
    the page count (0 when absent). Missing ``data`` gives no rows."""
    keep = keep or []
    x = df.select(*keep, F.coalesce(F.col(pages_path), F.lit(0)).alias("nb_pages"),
                  F.explode(F.col(data_col)).alias("__item"))
    return x.select(*keep, "nb_pages", "__item.*")


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Absent (null) fields get a default value."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def merge_listing_detail(listing: DataFrame, detail: DataFrame, on: list[str]) -> DataFrame:
    """Listing card + detail page per link. Inner: a detail page that
    could not be read drops the posting, as in the source."""
    return listing.join(detail, on, "inner")
