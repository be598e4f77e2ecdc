"""Run batches from the command line.

    python -m strata --lake <dir> --batches-dir <dir>            all batches, in order
    python -m strata --lake <dir> --batches-dir <dir> --batch 2017-01
    python -m strata --lake <dir> --batches-dir <dir> --stream   new files only (file stream)
    python -m strata --lake <dir> --sql "SELECT ... FROM gold.dim_product"

The session comes from ``spark-submit`` / the environment; on a cluster
the lake and batches folders are shared storage paths.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from strata.plans.run import list_batches, run_batch
from strata.session import configure
from strata.sources.lake import Lake


def main() -> None:
    ap = argparse.ArgumentParser(prog="strata")
    ap.add_argument("--lake", required=True)
    ap.add_argument("--batches-dir")
    ap.add_argument("--sql", help="run a query over the lake's tables (<layer>.<table>) and show it")
    ap.add_argument("--batch", help="run one batch (YYYY-MM); default: all, in order")
    ap.add_argument("--buckets", type=int, default=64, help="buckets of keyed tables")
    ap.add_argument("--stream", action="store_true", help="process files not seen before, then stop")
    ap.add_argument("--checkpoint", help="the stream's checkpoint; default: beside the lake's tables, for this batches folder")
    ap.add_argument("--prune", action="store_true", help="remove the keys a re-run no longer delivers")
    ap.add_argument("--date-range", nargs=2, metavar=("FIRST", "LAST"), help="days of the calendar; default: as the data need")
    ap.add_argument("--out", help="with --sql: write the result as CSV into this folder instead of printing it")
    args = ap.parse_args()

    spark = configure(SparkSession.builder.appName("strata").getOrCreate())
    lake = Lake(spark, args.lake, buckets=args.buckets)
    if args.sql:
        lake.register()
        result = spark.sql(args.sql)
        if args.out:
            result.write.option("header", True).csv(args.out)
            return
        print(*result.columns, sep="\t")
        for row in result.toLocalIterator():  # every row, a partition at a time
            print(*row, sep="\t")
        return
    if not args.batches_dir:
        ap.error("--batches-dir is required to run batches")
    date_range = tuple(args.date_range) if args.date_range else None
    if args.stream:
        from strata.streaming import run_stream

        run_stream(spark, lake, args.batches_dir, args.checkpoint, prune=args.prune, date_range=date_range).awaitTermination()
        return
    for b in [args.batch] if args.batch else list_batches(lake, args.batches_dir):
        for row in run_batch(lake, args.batches_dir, b, args.prune, date_range):
            print(*row[:6], sep="\t")


if __name__ == "__main__":
    main()
