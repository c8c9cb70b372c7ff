"""Batch job: ``python -m strata.plans.batch_job --mode all|bronze|silver|gold|marts``.

Exit status 0 on success, 2 on failure.  The session comes from
``spark-submit`` (or ``local[*]`` when run directly); the job sets no
session configuration of its own.
"""

from __future__ import annotations

import argparse
import logging
import sys
from datetime import date

from pyspark.sql import SparkSession

from . import healthcare as H

log = logging.getLogger("strata.batch")


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--mode", choices=["all", "bronze", "silver", "gold", "marts"], default="all")
    ap.add_argument("--raw", required=True, help="raw CSV root")
    ap.add_argument("--lake", required=True, help="lake root (bronze/silver/gold/quarantine)")
    ap.add_argument("--since", default=None, help="only files modified on/after YYYY-MM-DD")
    ap.add_argument("--load-date", default=str(date.today()))
    ap.add_argument("--run-id", default=None)
    ap.add_argument("--dedup-scope", choices=["file", "all", "key"], default="file")
    ap.add_argument("--multiline", nargs="*", choices=sorted(H.DATASETS), default=None, metavar="DATASET",
                    help="datasets whose cells hold line breaks (default: look for them)")
    args = ap.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    try:
        spark = SparkSession.builder.appName(f"strata-batch-{args.mode}").getOrCreate()
        lake = H.Lake(args.lake.rstrip("/"))
        run_id = args.run_id or f"{args.load_date}"
        if args.mode in ("all", "bronze"):
            log.info("bronze rows: %s", H.run_bronze(spark, args.raw, lake, args.load_date, args.since,
                                                     args.dedup_scope, args.multiline))
        if args.mode in ("all", "silver"):
            log.info("silver version: %s", H.run_silver(spark, lake, args.load_date, run_id))
        if args.mode in ("all", "gold"):
            log.info("gold tables: %s", H.run_gold(spark, lake, args.load_date))
        if args.mode in ("all", "marts"):
            log.info("domains version: %s", H.run_domains(spark, lake, args.load_date, run_id))
            log.info("marts: %s", H.run_marts(spark, lake, args.load_date))
        return 0
    except Exception:  # noqa: BLE001 — report and signal failure to the scheduler
        log.exception("batch job failed")
        return 2


if __name__ == "__main__":
    sys.exit(main())
