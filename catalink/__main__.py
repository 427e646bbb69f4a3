"""Command line: ``python -m catalink <job> ...`` (spark-submit works the same way).

    python -m catalink full-load        --sources DIR --targets DIR [--run-ts TS]
    python -m catalink incremental-load --sources DIR --targets DIR [--run-ts TS]
    python -m catalink mapped-load      --sources DIR --targets DIR
    python -m catalink fix-status       --targets DIR --tracker DIR [--table DIR]
    python -m catalink integrity-report --sources DIR --targets DIR

``--format jdbc --option url=... --option user=...`` reads the sources (or
the tracker) from a database instead of parquet folders; ``--sources`` is then
the schema prefix of the table names.  Counts are printed as one JSON line.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from .plans import jobs
from .session import build_session, scale_settings
from .sources.catalog import read_sources


def _options(pairs: list[str]) -> dict[str, str]:
    out = {}
    for pair in pairs:
        key, _, value = pair.partition("=")
        out[key] = value
    return out


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="catalink")
    parser.add_argument("job", choices=["full-load", "incremental-load", "mapped-load", "fix-status", "integrity-report"])
    parser.add_argument("--sources")
    parser.add_argument("--targets", required=True)
    parser.add_argument("--tracker")
    parser.add_argument("--table")
    parser.add_argument("--run-ts", default=None, help="load time (default: now, UTC)")
    parser.add_argument("--format", default="parquet")
    parser.add_argument("--option", action="append", default=[])
    parser.add_argument("--master", default=None)
    parser.add_argument("--input-gb", type=float, default=None, help="input size; sets partition sizes for it")
    parser.add_argument("--cores", type=int, default=8, help="cores of the cluster, with --input-gb")
    args = parser.parse_args(argv)

    # Sized for the input where it is given; the session's own settings stand otherwise.
    sized = scale_settings(int(args.input_gb * (1 << 30)), args.cores) if args.input_gb else None
    spark = build_session(args.master, extra=sized)
    run_ts = args.run_ts or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    opts = _options(args.option)

    def sources():
        if not args.sources:
            parser.error("--sources is required for this job")
        return read_sources(spark, args.sources, args.format, opts)

    if args.job == "full-load":
        out = jobs.run_full_load(spark, sources(), args.targets, run_ts)
    elif args.job == "incremental-load":
        out = jobs.run_incremental_load(spark, sources(), args.targets, run_ts)
    elif args.job == "mapped-load":
        out = jobs.run_mapped_load(spark, sources(), args.targets)
    elif args.job == "fix-status":
        if not args.tracker:
            parser.error("--tracker is required for fix-status")
        out = jobs.run_cve_fix_status(spark, args.targets, args.tracker, args.table)
    else:
        rows = jobs.run_integrity_report(spark, sources(), args.targets).collect()
        out = {r["check_name"]: r["value"] for r in rows}
    print(json.dumps(out, sort_keys=True))
    return 0


if __name__ == "__main__":
    sys.exit(main())
