"""spark-submit analyze_grid.py RAW_DIR OUT_DIR: run the complete analysis and show the dashboard tables, or one job."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from wattledger.plans.full_run import JOBS, Run, analyze
from wattledger.plans.report_frames import dashboard_frames
from wattledger.plans.storage import CHECKPOINT_DIR, scratch


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("raw_dir", help="folder with meter_readings, plant_output and weather")
    parser.add_argument("out_dir", help="folder for the results")
    parser.add_argument("--raw-format", choices=["csv", "parquet"], default="csv")
    parser.add_argument("--out-format", choices=["csv", "parquet"], default="csv")
    parser.add_argument("--single-files", action="store_true", help="one file for each result that is small by definition")
    parser.add_argument("--job", choices=list(JOBS), help="run this job only; balance and carbon read saved results")
    parser.add_argument("--checkpoint-dir", help=f"folder all executors reach, where {CHECKPOINT_DIR} is not set")
    args = parser.parse_args()
    builder = SparkSession.builder.appName("grid-analysis")
    if args.checkpoint_dir:
        builder = builder.config(CHECKPOINT_DIR, args.checkpoint_dir)
    spark = builder.getOrCreate()
    run = Run(spark, args.raw_dir, args.out_dir, args.raw_format, args.out_format, args.single_files)
    if args.job:
        JOBS[args.job](run)
    else:
        with scratch(spark) as folder:
            results = analyze(run.raw("meter_readings"), run.raw("plant_output"), run.raw("weather"), folder)
            run.save(results)
            for title, frame in dashboard_frames(results).items():
                print(title)
                frame.show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
