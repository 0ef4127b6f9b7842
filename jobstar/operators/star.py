"""Star schema building blocks: dimensions, bridge, fact.

Surrogate keys are md5-derived from the natural key (``functions.keys``),
so a fact row can compute every foreign key from its own columns: the
fact needs no join at all (``method="derive"``). ``method="join"`` looks
the keys up in the dimension tables instead (null-safe, full natural key) and gives the same rows; keep it as a cross-check
or for dimensions whose keys are not derived.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobstar.functions.dates import calendar_parts
from jobstar.functions.keys import row_key, stable_key
from jobstar.functions.text import as_col
from jobstar.operators.joins import lookup


def build_dimension(df: DataFrame, cols: dict[str, str | Column], key_col: str) -> DataFrame:
    """Distinct natural key + deterministic surrogate key.

    ``cols`` maps output name -> source column. Arrays are compared
    item by item in order (G2). ``dropDuplicates`` is a partial + final
    hash aggregate, so a hot key collapses map-side.
    """
    d = df.select(*[as_col(v).alias(k) for k, v in cols.items()]).dropDuplicates()
    return d.withColumn(key_col, stable_key(d, list(cols)))


def build_date_dimension(df: DataFrame, date_col: str | Column, out: str = "DateID") -> DataFrame:
    """Distinct dates present (a null date keeps one null row)
    with day, month, quarter and year."""
    d = df.select(F.to_date(as_col(date_col)).alias(out)).dropDuplicates()
    parts = calendar_parts(out)
    return d.select(out, *[c.alias(n) for n, c in parts.items()])


def explode_items(df: DataFrame, keep: list[str], array_col: str | Column, out: str,
                  trim: bool = True) -> DataFrame:
    """S3 + B26: one row per array item; null and empty arrays drop the row,
    null items are kept; items are trimmed (case is kept).

    Written as ``posexplode_outer`` + ``pos is not null`` (same rows as
    ``explode``): for a plain ``explode`` Catalyst infers a
    ``size(array) > 0`` filter that copies the array expression (e.g. the
    67-keyword tagger) below the generator, computing it twice and pushing
    the stage out of whole-stage codegen (4.5x slower on documents).
    """
    x = (df.select(*keep, F.posexplode_outer(as_col(array_col)).alias("__pos", out))
           .filter(F.col("__pos").isNotNull()).drop("__pos"))
    return x.withColumn(out, F.trim(out)) if trim else x


@dataclass
class DimRef:
    """How a fact row refers to a dimension: ``key_col`` and the natural
    key as ``{dimension column: fact column}``."""
    key_col: str
    natural: dict[str, str]
    table: DataFrame | None = field(default=None, repr=False)


def build_fact(df: DataFrame, dims: list[DimRef], columns: dict[str, str | Column],
               id_col: str | None = None, id_from: list[str] | None = None,
               method: str = "derive") -> DataFrame:
    """Fact rows with one key per dimension plus measures.

    ``id_col``/``id_from`` add the fact's own key (G7/B23 replacement).
    """
    f = df
    if id_col:
        f = f.withColumn(id_col, row_key(f, id_from))
    for dim in dims:
        if method == "derive":
            f = f.withColumn(dim.key_col, stable_key(f, list(dim.natural.values())))
        elif method == "join":
            if dim.table is None:
                raise ValueError(f"method='join' needs the table of {dim.key_col}")
            on = [(fc, dc) for dc, fc in dim.natural.items()]
            f = lookup(f, dim.table, on, [dim.key_col])
        else:
            raise ValueError(f"unknown method {method!r}")
    out = ([F.col(id_col)] if id_col else []) + [F.col(d.key_col) for d in dims]
    out += [as_col(v).alias(k) for k, v in columns.items()]
    return f.select(*out)


def build_bridge(df: DataFrame, id_col: str, array_col: str, item_col: str, key_col: str,
                 dim: DataFrame | None = None) -> DataFrame:
    """G6 (+ D5 when ``dim`` is given): distinct (row id, item key) pairs
    from an array column. Without ``dim`` the item key is derived, which
    equals the key of the item's row in ``build_dimension``."""
    items = explode_items(df, [id_col], array_col, item_col)
    if dim is None:
        items = items.withColumn(key_col, stable_key(items, [item_col]))
    else:
        items = lookup(items, dim, [(item_col, item_col)], [key_col])
    return items.select(id_col, key_col).dropDuplicates()
