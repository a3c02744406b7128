"""spark-submit or `python -m ticketmill --citations PATH --payloads DIR --root DIR`."""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from ticketmill.plans.batch import run
from ticketmill.sources.scans import read_citations, read_payloads, read_quarantined


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="ticketmill", description=__doc__)
    parser.add_argument("--citations", required=True, help="raw citation files")
    parser.add_argument("--format", default="csv", help="csv (default), json, parquet or orc")
    parser.add_argument("--timestamp-format", help="of CSV and JSON, e.g. M/d/yyyy h:mm a")
    parser.add_argument(
        "--payloads", required=True, help="weather payloads: <dir>/campus=<name>/*.json"
    )
    parser.add_argument(
        "--multi-line", action="store_true", help="a payload file is one JSON text of many lines"
    )
    parser.add_argument("--root", required=True, help="where zones, tables and reports go")
    parser.add_argument(
        "--large-batch", action="store_true", help="the batch's ids are too many to be sent to all tasks"
    )
    parser.add_argument(
        "--quarantine", action="store_true", help="keep damaged lines and payloads apart instead of failing"
    )
    args = parser.parse_args(argv)

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s: %(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = SparkSession.builder.appName("ticketmill").getOrCreate()
    try:
        how = {"fmt": args.format, "timestamp_format": args.timestamp_format}
        if args.quarantine:
            citations, damaged = read_quarantined(spark, args.citations, **how)
        else:
            citations, damaged = read_citations(spark, args.citations, **how), None
        outcome = run(
            spark,
            citations,
            read_payloads(spark, args.payloads, args.multi_line, args.quarantine),
            args.root,
            large_batch=args.large_batch,
            damaged=damaged,
        )
    finally:
        spark.stop()
    return 1 if outcome.failed_reports or outcome.failed_quality else 0


if __name__ == "__main__":
    sys.exit(main())
