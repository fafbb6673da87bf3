"""Runs the whole pipeline or one of its steps.

    python -m wardframe all --bronze raw/ --silver silver/ --gold gold/
"""

from __future__ import annotations

import argparse
import logging

from wardframe import schema as S
from wardframe.plans import pipeline
from wardframe.session import build_session

STEPS = ("all", "silver", "gold-dims", "gold-fact")


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="wardframe")
    parser.add_argument("step", choices=STEPS)
    parser.add_argument("--bronze", help="folder of the raw files")
    parser.add_argument("--silver", required=True)
    parser.add_argument("--gold")
    parser.add_argument("--fact-file", default=S.FACT_FILE)
    parser.add_argument("--dim-file", default=S.DIM_FILE)
    parser.add_argument("--encoding", default="utf-8")
    parser.add_argument("--unique-providers", action="store_true")
    parser.add_argument("--partition-fact-by", nargs="*", default=())
    args = parser.parse_args(arguments)
    if args.step in ("all", "silver") and not args.bronze:
        parser.error("--bronze is needed for this step")
    if args.step != "silver" and not args.gold:
        parser.error("--gold is needed for this step")

    logging.basicConfig(level=logging.INFO)
    spark = build_session()
    raw = {"fact_file": args.fact_file, "dim_file": args.dim_file, "encoding": args.encoding}
    if args.step == "all":
        pipeline.run_pipeline(
            spark,
            args.bronze,
            args.silver,
            args.gold,
            args.unique_providers,
            args.partition_fact_by,
            **raw,
        )
    elif args.step == "silver":
        pipeline.to_silver(spark, args.bronze, args.silver, **raw)
    elif args.step == "gold-dims":
        pipeline.to_gold_dims(spark, args.silver, args.gold, args.unique_providers)
    else:
        pipeline.to_gold_fact(spark, args.silver, args.gold, args.partition_fact_by)


if __name__ == "__main__":
    main()
