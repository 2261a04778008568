"""Nightly run from the command line.

    python -m rollcall --tables tables.json --as-of 2025-09-01 --academic-year 2026 \\
        --out s3://bucket/rollcall --run-id 2025-09-01 [--config config.json]

``tables.json`` maps table names (``sis_users``, ``enrol``, ``groups``, …) to
parquet paths or catalog tables; ``config.json`` holds any other SyncConfig
fields (domains, excluded sites, batch size, …).  Prints the audit as JSON.
"""

from __future__ import annotations

import argparse
import json
from datetime import date


def main(argv=None) -> dict:
    ap = argparse.ArgumentParser(prog="python -m rollcall")
    ap.add_argument("--tables", required=True, help="JSON file: table name → parquet path or catalog table")
    ap.add_argument("--as-of", required=True, type=date.fromisoformat)
    ap.add_argument("--academic-year", required=True, type=int)
    ap.add_argument("--out", required=True, help="base folder of the run outputs")
    ap.add_argument("--run-id", required=True)
    ap.add_argument("--config", help="JSON file with further SyncConfig fields")
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    from rollcall.config import SyncConfig
    from rollcall.plans.jobs import nightly_run
    from rollcall.plans.tables import CatalogTables

    extra = {}
    if args.config:
        with open(args.config) as f:
            extra = json.load(f)
        for k in ("excluded_sites", "excluded_students", "course_group_numbers"):
            if k in extra:
                extra[k] = tuple(extra[k])
    cfg = SyncConfig(as_of=args.as_of, academic_year=args.academic_year, **extra)
    with open(args.tables) as f:
        tables = json.load(f)
    spark = SparkSession.builder.getOrCreate()
    audit = nightly_run(CatalogTables(spark, tables, cfg), args.out, args.run_id)
    print(json.dumps(audit, sort_keys=True))
    return audit


if __name__ == "__main__":
    main()
