"""Command line for cluster runs (``spark-submit``-friendly).

    python -m tidemark plan   --event event.json --out <folder>
    python -m tidemark worker --event event.json --attempts <parquet folder> \\
                              --bronze <folder> --out <folder>

``plan`` writes the plan document (one JSON line per batch); ``worker`` lands
the accepted payloads in Bronze and writes the per-task status (Parquet) and
the run summary (one JSON line).  Event files hold the reference's event
dictionaries.
"""

from __future__ import annotations

import argparse
import json

from tidemark.jobs import plan_job, worker_job
from tidemark.session import cleaned_up, get_session


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="tidemark")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("plan")
    p.add_argument("--event", required=True)
    p.add_argument("--out", required=True)
    w = sub.add_parser("worker")
    w.add_argument("--event", required=True)
    w.add_argument("--attempts", required=True)
    w.add_argument("--bronze", required=True)
    w.add_argument("--out", required=True)
    w.add_argument("--as-of", default=None)
    args = ap.parse_args(argv)

    with open(args.event, encoding="utf-8") as fh:
        event = json.load(fh)
    spark = get_session()
    with cleaned_up(spark):
        if args.cmd == "plan":
            plan_job(spark, event).write.mode("overwrite").json(args.out)
        else:
            attempts = spark.read.parquet(args.attempts)
            run = worker_job(spark, event, attempts, bronze_path=args.bronze, as_of=args.as_of)
            run.tasks.write.mode("overwrite").parquet(f"{args.out}/tasks")
            run.summary.coalesce(1).write.mode("overwrite").json(f"{args.out}/summary")


if __name__ == "__main__":
    main()
