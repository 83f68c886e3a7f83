"""``python -m retail_lens clean RAW CLEAN`` and ``python -m retail_lens analyse CLEAN OUT ...``"""

from __future__ import annotations

import argparse
from datetime import date

from retail_lens.functions.months import Period, PeriodSpec
from retail_lens.plans.cleaning import CleaningRules
from retail_lens.plans.model import Focus
from retail_lens.plans.pipeline import analyse, clean_folder
from retail_lens.session import get_spark


def _period(text: str) -> Period:
    return Period.of(*text.split(":"))


def _months(text: str) -> list[date]:
    return [date.fromisoformat(f"{month}-01") for month in text.split(",")]


def main() -> None:
    parser = argparse.ArgumentParser(prog="retail_lens")
    parser.add_argument("--partitions", type=int, help="shuffle partitions to start from, about one per 256 MB of input")
    steps = parser.add_subparsers(dest="step", required=True)
    clean = steps.add_parser("clean", help="raw CSV files to clean tables and a quality log")
    clean.add_argument("raw")
    clean.add_argument("clean")
    clean.add_argument("--labels", help="JSON file: {\"regions\": {text: label}, \"channels\": {text: label}}")
    clean.add_argument(
        "--multi-line", action="store_true", help="quoted fields may hold line breaks; each file is then read by one task"
    )
    clean.add_argument("--months", type=_months, help="late data: write these months of the facts only, e.g. 2026-01,2026-03")
    report = steps.add_parser("analyse", help="clean tables to report CSV files")
    report.add_argument("clean")
    report.add_argument("out")
    report.add_argument("--current", type=_period, required=True, help="2026-07:2026-09")
    report.add_argument("--trend", type=_period, required=True, help="2026-01:2026-06")
    report.add_argument("--future", type=_period, required=True, help="2026-10:2026-12")
    report.add_argument("--region", required=True)
    report.add_argument("--category", required=True)
    report.add_argument("--shock", type=date.fromisoformat, help="first day of the disruption")
    args = parser.parse_args()

    spark = get_spark(partitions=args.partitions)
    if args.step == "clean":
        rules = CleaningRules.from_json(spark, args.labels) if args.labels else CleaningRules()
        clean_folder(spark, args.raw, args.clean, rules, args.multi_line, args.months)
    else:
        spec = PeriodSpec(args.current, args.trend, args.future)
        analyse(
            spark, args.clean, args.out, spec, Focus(args.region, args.category), args.shock or args.current.first
        )


if __name__ == "__main__":
    main()
