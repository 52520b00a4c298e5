"""spark-submit entry: normalise, stack, obt, landing."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from fundlake.plans.landing import run_landing_zone, run_obt, run_stack
from fundlake.plans.normalise import run_auto_pipeline
from fundlake.plans.reports import run_summary
from fundlake.session import configure
from fundlake.sources.exports import FORMATS


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="fundlake")
    jobs = parser.add_subparsers(dest="job", required=True)

    one = jobs.add_parser("normalise", help="one raw delivery to typed tables")
    one.add_argument("source")
    one.add_argument("target")
    one.add_argument("--fmt", default="parquet", choices=FORMATS)

    for name, text in (("stack", "stack delivery folders"), ("obt", "build the five tables from delivery folders")):
        job = jobs.add_parser(name, help=text)
        job.add_argument("sources", nargs="+")
        job.add_argument("--output", required=True)
        job.add_argument("--relative-to")
        if name == "stack":
            job.add_argument("--fmt", default="parquet", choices=FORMATS)
            job.add_argument("--label-col", default="levering")

    zone = jobs.add_parser("landing", help="everything under a landing folder")
    zone.add_argument("raw")
    zone.add_argument("prepared")
    zone.add_argument("output")
    zone.add_argument("--everything", action="store_true", help="read all files again, not only new and changed ones")
    return parser


def run(spark: SparkSession, args: argparse.Namespace) -> str:
    """Run one job and return its summary line."""
    if args.job == "normalise":
        frames = run_auto_pipeline(spark, args.source, args.target, args.fmt)
        rows = sum(df.count() for df in frames.values())
        return f"Verwerkt: {len(frames)} tabellen, {rows} rijen naar {args.target}"
    if args.job == "stack":
        counts = run_stack(spark, args.sources, args.output, args.fmt, args.label_col, args.relative_to)
    elif args.job == "obt":
        tables = run_obt(spark, args.sources, args.output, args.relative_to)
        counts = {name: df.count() for name, df in tables.items()}
    else:
        result = run_landing_zone(spark, args.raw, args.prepared, args.output, everything=args.everything)
        counts = result.obt
    summary = run_summary(counts)
    return f"{args.job}: {summary['tabellen']} tabellen, {summary['rijen']} rijen naar {args.output}"


def main() -> None:
    args = build_parser().parse_args()
    spark = configure(SparkSession.builder.appName(f"fundlake-{args.job}").getOrCreate())
    try:
        print(run(spark, args))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
