"""The batch jobs, for ``spark-submit`` or ``python -m pulsegrid``.

    batch  --profiles PATH --out PATH    every batch analysis, one folder each
    report --profiles PATH --out PATH    the daily report
    land   --profiles PATH --out PATH    JSON Lines profiles as Parquet
"""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import SparkSession

from .plans import daily_report, save_batch
from .sources import land_parquet, read_profiles, write_result


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="pulsegrid", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    parser.add_argument("job", choices=("batch", "report", "land"))
    parser.add_argument("--profiles", required=True, help="JSON Lines or Parquet profiles")
    parser.add_argument("--out", required=True)
    parser.add_argument("--input-format", default="json", choices=("json", "parquet"))
    parser.add_argument("--output-format", default="parquet", choices=("json", "parquet"))
    parser.add_argument("--as-of", type=datetime.fromisoformat, help="time of the run; default now")
    parser.add_argument("--top", type=int, default=None, help="conditions listed: 10 in batch, 7 in the report")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"pulsegrid-{args.job}").getOrCreate()
    profiles = read_profiles(spark, args.profiles, args.input_format)
    if args.job == "batch":
        save_batch(profiles, args.out, args.as_of, args.top or 10, fmt=args.output_format)
    elif args.job == "report":
        write_result(daily_report(profiles, args.top or 7), args.out, "daily_report", args.output_format)
    else:
        land_parquet(profiles, args.out)


if __name__ == "__main__":
    main()
