"""Command line: run the pipeline stages, like the source's stage scripts.

    python -m jobstar all    --raw-a DIR --raw-b DIR --root LAKE [--mode fixed] [--database DB]
    python -m jobstar bronze --raw-a DIR --raw-b DIR --root LAKE
    python -m jobstar silver --root LAKE [--mode fixed]
    python -m jobstar gold   --root LAKE
    python -m jobstar publish --root LAKE [--database DB]
    python -m jobstar fold     --raw-a DIR --raw-b DIR --root LAKE   # land an instalment, fold it into silver
    python -m jobstar snapshot --root LAKE                           # publish the eight gold tables at once

Spark settings come from ``spark-submit``/``--conf`` (the session is only
created here when none exists).
"""

from __future__ import annotations

import argparse
import json

from jobstar.plans import pipeline
from jobstar.session import get_spark


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="jobstar")
    ap.add_argument("stage", choices=["all", "bronze", "silver", "gold", "publish", "fold", "snapshot"])
    ap.add_argument("--root", required=True, help="lake root (any Hadoop URI)")
    ap.add_argument("--raw-a", help="directory of scraped-board JSON files")
    ap.add_argument("--raw-b", help="directory of API-board JSON files")
    ap.add_argument("--mode", default="reference", choices=["reference", "fixed"])
    ap.add_argument("--database", help="warehouse database for publish")
    a = ap.parse_args(argv)
    spark = get_spark("jobstar")
    if a.stage == "all":
        out = pipeline.run_all(spark, a.raw_a, a.raw_b, a.root, a.mode, a.database)
    elif a.stage == "bronze":
        out = pipeline.run_bronze(spark, a.raw_a, a.raw_b, a.root)
    elif a.stage == "silver":
        out = pipeline.run_silver(spark, a.root, a.mode)
    elif a.stage == "gold":
        out = pipeline.run_gold(spark, a.root)
    elif a.stage == "fold":
        out = {"bronze": pipeline.run_bronze(spark, a.raw_a, a.raw_b, a.root, append=True),
               "silver": pipeline.fold_silver(spark, a.root, a.mode)}
    elif a.stage == "snapshot":
        out = {"version": pipeline.run_gold_snapshot(spark, a.root)}
    else:
        out = pipeline.publish(spark, a.root, a.database)
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main()
