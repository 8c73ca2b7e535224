"""Batch job: raw applications to the clean table and the marts."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from creditweave.operators.rules import RULE_NAMES
from creditweave.plans.batch import publish_batch, run_batch
from creditweave.session import build_session
from creditweave.sources.files import SOURCE_FORMATS


def parse_args(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Clean loan applications and build the marts.")
    parser.add_argument("--input", required=True, help="file or directory of applications")
    parser.add_argument("--output", required=True, help="root directory of the five outputs")
    parser.add_argument("--format", choices=SOURCE_FORMATS, default="csv", help="input format")
    parser.add_argument("--keep-in-memory", action="store_true", help="cache the clean rows for the marts")
    parser.add_argument("--max-records-per-file", type=int, help="cut the clean table's files at this many rows")
    parser.add_argument("--run-id", help="write below the output root, in a folder of this name")
    parser.add_argument("--versioned", action="store_true", help="write the outputs as one version, which readers see whole")
    parser.add_argument(
        "--max-violations", action="append", default=[], metavar="RULE=ROWS", help="with --versioned: stop if more rows break the rule"
    )
    args = parser.parse_args(argv)
    if args.versioned and args.run_id:
        parser.error("--versioned names its own folder; leave --run-id out")
    if args.max_violations and not args.versioned:
        parser.error("--max-violations needs --versioned")
    try:
        args.limits = {rule: int(rows) for rule, rows in (limit.split("=", 1) for limit in args.max_violations)}
    except ValueError:
        parser.error("--max-violations takes RULE=ROWS")
    if unknown := set(args.limits) - set(RULE_NAMES):
        parser.error(f"unknown rule {', '.join(sorted(unknown))}; expected one of {', '.join(RULE_NAMES)}")
    return args


def main(argv: Sequence[str] | None = None) -> None:
    args = parse_args(argv)
    spark = build_session("creditweave-batch")
    try:
        settings = (args.input, args.output, args.format, args.keep_in_memory, args.max_records_per_file)
        if args.versioned:
            publish_batch(spark, *settings, args.limits)
        else:
            run_batch(spark, *settings, args.run_id)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
