"""Command line, mirroring the pipeline's entry points.

    python -m regcurate run <spec.json> <dated_dir> <undated_dir> <output_dir>
        [--format csv] [--output-format csv] [--incremental] [--sorted]
    python -m regcurate land <spec.json> <dated_dir> <undated_dir> <output_dir>
    python -m regcurate curate <output_dir> [--spec spec.json]
    python -m regcurate refresh <spec.json> <dated_dir> <undated_dir> <output_dir>
    python -m regcurate summarise <column> <table_path> <output_path>

Runs on the session ``spark-submit`` provides (cluster settings win); a
local session is created only when none is configured.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession

from .operators.profile import group_count
from .plans.incremental import refresh
from .plans.pipeline import curate, land, missing_inputs
from .session import apply_defaults
from .sources.fs import exists, read_text
from .specs.registers import REGISTERS, specs_from_json


def _session() -> SparkSession:
    spark = SparkSession.getActiveSession()
    if spark is None:
        spark = SparkSession.builder.appName("regcurate").getOrCreate()
    apply_defaults(spark)
    return spark


def _specs(path: str | None):
    if not path:
        return REGISTERS
    return specs_from_json(json.loads(read_text(_session(), path)))


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="regcurate")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("run", "land"):
        s = sub.add_parser(name)
        s.add_argument("spec")
        s.add_argument("dated_dir")
        s.add_argument("undated_dir")
        s.add_argument("output_dir")
        s.add_argument("--format", default="parquet", choices=["parquet", "csv"],
                       help="format of the extract copies")
        s.add_argument("--output-format", default="parquet", choices=["parquet", "csv"],
                       help="format of the curated tables")
        s.add_argument("--incremental", action="store_true",
                       help="land only files not landed before (streaming checkpoint)")
        s.add_argument("--sorted", action="store_true",
                       help="write curated tables in their declared order")
    s = sub.add_parser("refresh", help="bring landed and curated tables up to date with added, "
                                       "corrected, emptied and withdrawn extracts")
    for arg in ("spec", "dated_dir", "undated_dir", "output_dir"):
        s.add_argument(arg)
    s.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    s = sub.add_parser("curate")
    s.add_argument("output_dir")
    s.add_argument("--spec", default=None, help="landing spec, if not the built-in one")
    s.add_argument("--output-format", default="parquet", choices=["parquet", "csv"])
    s.add_argument("--sorted", action="store_true")
    s = sub.add_parser("summarise")
    s.add_argument("column")
    s.add_argument("table")
    s.add_argument("output")
    s.add_argument("--format", default=None, choices=["parquet", "csv"],
                   help="format of the table (default: from its extension)")
    args = p.parse_args(argv)
    spark = _session()

    if args.cmd in ("run", "land"):
        specs = _specs(args.spec)
        landed = land(spark, args.dated_dir, args.undated_dir, args.output_dir, args.format,
                      specs, args.incremental)
        result = {"stage1": landed, "missing": missing_inputs(landed)}
        if args.cmd == "run":
            result["stage2"] = _sizes(curate(spark, args.output_dir, landed, args.output_format,
                                             args.sorted, specs))
    elif args.cmd == "refresh":
        result = refresh(spark, args.dated_dir, args.undated_dir, args.output_dir, args.format,
                         _specs(args.spec))
    elif args.cmd == "curate":
        specs = _specs(args.spec)
        root = os.path.join(args.output_dir, "stage1")
        landed = {n: p for n in specs if exists(spark, p := os.path.join(root, n))}
        result = {"missing": missing_inputs(landed),
                  "stage2": _sizes(curate(spark, args.output_dir, landed, args.output_format,
                                          args.sorted, specs))}
    else:
        fmt = args.format or ("csv" if args.table.rstrip("/").endswith(".csv") else "parquet")
        reader = spark.read.option("header", "true") if fmt == "csv" else spark.read
        df = reader.format(fmt).load(args.table)   # every CSV value stays a string
        group_count(df, args.column).write.mode("overwrite").option("header", "true") \
            .csv(args.output)
        result = {"summary": args.output}
    print(json.dumps(result, indent=2))
    return 0


def _sizes(sidecars: dict) -> dict:
    return {name: side["size"] for name, side in sidecars.items()}


if __name__ == "__main__":
    sys.exit(main())
