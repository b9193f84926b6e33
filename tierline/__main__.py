"""Command line: run the pipeline or one stage, each as its own process.

    python -m tierline all --base s3a://lake/flights \\
        --source airlines=s3a://landing/airlines.csv \\
        --source airports=s3a://landing/airports.csv \\
        --source flights=s3a://landing/flights/
    python -m tierline raw --base URI --source flights=PATH [--drop-malformed]
    python -m tierline clean --base URI
    python -m tierline fact --base URI
    python -m tierline rollup --base URI
    python -m tierline register --base URI

Stages hand over through the layer tables only, so a scheduler can run them
one after another in separate processes.  Every stage raises on error.
"""

from __future__ import annotations

import argparse
import json
import sys

from .plans import pipeline as P
from .session import build_session, durable_catalog


def _sources(items: list[str]) -> dict[str, str]:
    out = {}
    for item in items:
        name, _, path = item.partition("=")
        if not path:
            raise SystemExit(f"--source expects name=path, got {item!r}")
        out[name] = path
    return out


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tierline")
    ap.add_argument("stage", choices=["all", "raw", "clean", "fact", "rollup", "register"])
    ap.add_argument("--base", required=True, help="layer base URI (any Hadoop filesystem)")
    ap.add_argument("--source", action="append", default=[], help="name=path of a source CSV")
    ap.add_argument("--drop-malformed", action="store_true", help="remove malformed rows from the raw layer")
    ap.add_argument("--resume", action="store_true",
                    help="skip stages whose newest version was made of what they would read now")
    ap.add_argument("--overwrite-schema", action="store_true",
                    help="accept a changed table shape in the clean and fact layers")
    ap.add_argument("--keep-versions", type=int, default=None,
                    help="after a successful 'all', delete layer versions beyond the newest N")
    ap.add_argument("--catalog", choices=["in-memory", "hive"], default=None, help="Spark's catalog implementation")
    args = ap.parse_args(argv)

    spark = build_session(f"tierline-{args.stage}", base_uri=args.base, catalog=args.catalog)
    keep = not args.drop_malformed
    try:
        if args.stage == "all":
            out = P.run_all(spark, args.base, _sources(args.source), keep_malformed=keep,
                            keep_versions=args.keep_versions, overwrite_schema=args.overwrite_schema,
                            resume=args.resume)
        elif args.stage == "raw":
            out = P.run_bronze(spark, args.base, _sources(args.source), keep_malformed=keep, resume=args.resume)
        elif args.stage == "clean":
            out = P.run_silver(spark, args.base, overwrite_schema=args.overwrite_schema, resume=args.resume)
        elif args.stage == "fact":
            out = P.run_gold(spark, args.base, overwrite_schema=args.overwrite_schema, resume=args.resume)
        elif args.stage == "rollup":
            out = P.run_rollup(spark, args.base, resume=args.resume)
        else:
            if not durable_catalog(spark):
                raise SystemExit(
                    "register: Spark's in-memory catalog ends with this process, so nothing would stay registered; "
                    "pass --catalog hive with a configured metastore, or register inside the session that queries"
                )
            out = P.register(spark, args.base)
        print(json.dumps(out, default=str))
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
