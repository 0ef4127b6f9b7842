"""Key checks implied by the documented primary and foreign keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstar.functions.keys import key_text


def pk_violations(df: DataFrame, keys: list[str], out: str = "n") -> DataFrame:
    """Key values that occur more than once, with their count.
    Partial aggregation keeps a hot key to one row per map task."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).filter(F.col(out) > 1)


def fk_violations(fact: DataFrame, dim: DataFrame, on: list[tuple[str, str]],
                  null_is_violation: bool = False) -> DataFrame:
    """Fact rows whose foreign key has no dimension row. A null key part is
    no violation (SQL FK rule) unless ``null_is_violation``."""
    keys = dim.select(*[F.col(dc).alias(f"__k{i}") for i, (_, dc) in enumerate(on)])
    cond = reduce(lambda a, b: a & b,
                  [fact[fc] == keys[f"__k{i}"] for i, (fc, _) in enumerate(on)])
    bad = fact.join(keys, cond, "left_anti")
    if not null_is_violation:
        bad = bad.filter(reduce(lambda a, b: a & b, [F.col(fc).isNotNull() for fc, _ in on]))
    return bad


def parse_failures(df: DataFrame, pairs: dict[str, tuple[str, str]],
                   excused: dict[str, str] | None = None,
                   flags: dict[str, str] | None = None) -> DataFrame:
    """Quality report for dirty text: per check, the rows whose raw text is
    present but whose parsed value is null (the source job aborted on such
    rows under ANSI; here they become null and are counted).

    ``pairs`` maps check name -> (raw column, parsed column); ``excused``
    maps a check to a boolean column that marks an expected null (e.g.
    "negotiable" salary). One distributed aggregation, one output row per
    check.
    """
    excused = excused or {}
    flags = flags or {}      # check name -> column that is non-null on a failing row
    aggs = [F.sum(F.when(F.col(c).isNotNull(), 1).otherwise(0)).alias(n) for n, c in flags.items()]
    for name, (raw, parsed) in pairs.items():
        bad = F.col(raw).isNotNull() & F.col(parsed).isNull()
        if name in excused:
            bad = bad & ~F.coalesce(F.col(excused[name]), F.lit(False))
        aggs.append(F.sum(F.when(bad, 1).otherwise(0)).alias(name))
    wide = df.agg(F.count(F.lit(1)).alias("rows"), *aggs)
    names = list(flags) + list(pairs)
    stack = ", ".join(f"'{n}', `{n}`" for n in names)
    return wide.selectExpr("rows", f"stack({len(names)}, {stack}) AS (check, failures)")


def key_report(checks: dict[str, DataFrame]) -> DataFrame:
    """Union of named violation frames -> (check, violations) counts."""
    parts = [v.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(k).alias("check"), "violations")
             for k, v in checks.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def key_checks(tables: dict[str, DataFrame], pks: dict[str, str | list[str]],
               fks: list[tuple[str, str, str | list[str]]]) -> DataFrame:
    """All key checks of a schema in one aggregation -> (check, violations).

    ``pks`` names each table's key; ``fks`` lists (table, parent, columns), whose columns hold the
    parent's key. ``pk_{table}`` counts key values that occur more than once, ``fk_{table}_{columns}`` rows whose
    key the parent has not; a null key part is no violation of the latter. Columns that refer to each other need the same type.

    Every table is scanned once: a row gives its own key and those it refers to, and all are grouped
    by key space and key, so one shuffle serves all checks. It is preceded by a partial
    aggregation, so a key that most rows refer to costs a row per task.
    """
    names = lambda k: [k] if isinstance(k, str) else list(k)
    spaces = {t: i for i, t in enumerate(pks)}
    slots: dict[str, list[tuple[str, list[str]]]] = {t: [] for t in pks}  # references to each table's key
    mentions: dict[str, list] = {t: [(t, names(k), -1)] for t, k in pks.items()}
    for table, parent, columns in fks:
        mentions.setdefault(table, []).append((parent, names(columns), len(slots[parent])))
        slots[parent].append((table, names(columns)))

    def entries(table: str) -> DataFrame:
        df, out = tables[table], []
        for space, columns, slot in mentions[table]:
            there = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]) if slot >= 0 else F.lit(True)
            out.append(F.struct(F.lit(spaces[space]).alias("space"), F.when(there, key_text(df, columns)).alias("key"),
                                F.lit(slot).alias("slot")))
        return df.select(F.inline(F.array(*out))).where("key IS NOT NULL")

    most = max(map(len, slots.values()))
    count = lambda i: F.sum(F.when(F.col("slot") == i, 1).otherwise(0))
    per = reduce(DataFrame.unionByName, [entries(t) for t in mentions]).groupBy("space", "key").agg(
        count(-1).alias("own"), *[count(i).alias(f"ref{i}") for i in range(most)])
    found = {}
    for t, i in spaces.items():
        here = F.col("space") == i
        found[f"pk_{t}"] = F.when(here & (F.col("own") > 1), 1)
        found |= {f"fk_{a}_{'_'.join(columns)}": F.when(here & (F.col("own") == 0), F.col(f"ref{j}"))
                  for j, (a, columns) in enumerate(slots[t])}
    wide = per.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(f"c{i}") for i, c in enumerate(found.values())])
    rows = F.array(*[F.struct(F.lit(n).alias("check"), F.col(f"c{i}").alias("violations")) for i, n in enumerate(found)])
    return wide.select(F.inline(rows))
