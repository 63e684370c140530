"""Command line: run a contract over a source and write the reports.

    python -m probity run --contract contract.yaml --source /data --out /shared/dq \\
        --dataset billing [--run-id R] [--replay] [--as-of '2024-01-31 00:00:00'] [--keep-sample 100]

Prints one JSON line: the run id, the output folder and the rule statuses counted.
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="probity")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="validate a contract over its tables")
    run.add_argument("--contract", required=True, help="contract YAML file")
    run.add_argument("--source", help="folder with <table>.<format> datasets; without it the database of the contract's servers")
    run.add_argument("--out", required=True, help="output folder (shared on a cluster)")
    run.add_argument("--dataset", required=True)
    run.add_argument("--run-id")
    run.add_argument("--replay", action="store_true", help="validate the stored samples of --run-id")
    run.add_argument("--as-of", help="'now' for freshness rules")
    run.add_argument("--keep-sample", type=int, help="store a first-N sample per table for replay")
    run.add_argument("--format", default="parquet")
    run.add_argument("--server", default="mysql", help="the entry of servers to read without --source")
    run.add_argument("--partitions", type=int, help="parallel ranges per database table")
    run.add_argument("--suite", help="a stored suite (JSON) to run beside the contract and compare with it")
    run.add_argument("--suggest", action="store_true", help="write the checks that the profile suggests")
    run.add_argument("--no-profile", action="store_true", help="skip the profile (verdicts only)")
    run.add_argument("--mask-pii", action="store_true", help="mask the contract's PII fields in written rows")
    run.add_argument("--master", help="Spark master (default: from the environment)")
    args = ap.parse_args(argv)

    from pyspark.sql import functions as F

    from probity.plans.run import run_contract
    from probity.session import get_spark

    suite = None
    if args.suite:
        from probity.contract import load_suites

        with open(args.suite, encoding="utf-8") as f:
            suite = load_suites(f.read())
    spark = get_spark(args.master)
    out = run_contract(
        spark, args.contract, args.source, args.out, args.dataset, run_id=args.run_id, replay_run=args.replay,
        as_of=args.as_of, keep_sample=args.keep_sample, fmt=args.format,
        with_profile=not args.no_profile, mask_pii=args.mask_pii, server=args.server, num_partitions=args.partitions,
        suite=suite, suggest=args.suggest,
    )
    statuses = {r["status"]: r["n"] for r in out["evaluation"].groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()}
    print(json.dumps({"out": args.out, "dataset": args.dataset, "run_id": args.run_id, "statuses": statuses}))
    return 0 if statuses.get("FAIL", 0) == 0 and statuses.get("ERROR", 0) == 0 else 1


if __name__ == "__main__":
    sys.exit(main())
