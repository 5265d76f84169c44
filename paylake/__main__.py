"""Command line: `spark-submit ... -m paylake <job>` or `python -m paylake <job>`.

ingest    drain or follow a stream into the raw layer
process   rebuild processed days: --day, --start/--end, or --scheduled for the previous hour
merge     merge the small batches of a raw layer, once their hours are over: --day, or --start/--end
compact   rewrite processed days: --day, --start/--end, or --scheduled for the previous day
query     run one read-only SQL text and store its result as Parquet
"""

from __future__ import annotations

import argparse
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import SparkSession

from paylake.operators.compact import TARGET_BYTES
from paylake.operators.gate import register_alias, run_query
from paylake.operators.merge_batches import clean_merged, merge_batches
from paylake.plans.jobs import compact_days, compact_previous_day, process_days, process_previous_hour
from paylake.plans.lake import SOURCES
from paylake.session import configure
from paylake.sources.layers import Days
from paylake.sources.streams import BATCH_DELAY, BATCH_MESSAGES, file_messages, kafka_messages
from paylake.streaming.ingest import drain_ingest, start_ingest


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="paylake", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    jobs = parser.add_subparsers(dest="job", required=True)

    ingest = jobs.add_parser("ingest")
    origin = ingest.add_mutually_exclusive_group(required=True)
    origin.add_argument("--servers", help="Kafka servers")
    origin.add_argument("--folder", help="folder of text files, one message a line")
    ingest.add_argument("--topics", nargs="+", default=SOURCES)
    ingest.add_argument("--smallest-batch", type=int, default=BATCH_MESSAGES, help="messages that start a batch")
    ingest.add_argument("--longest-wait", default=BATCH_DELAY, help="time after which fewer messages do")
    ingest.add_argument("--largest-batch", type=int)
    ingest.add_argument("--raw", required=True)
    ingest.add_argument("--rejects", required=True)
    ingest.add_argument("--checkpoints", required=True)
    ingest.add_argument("--drain", action="store_true", help="stop when all that is available is stored")

    for name, target in (("process", "processed"), ("compact", "analytics")):
        job = jobs.add_parser(name)
        job.add_argument("--from", dest="origin", required=True, help="root of the layer to read")
        job.add_argument("--to", dest="target", required=True, help=f"root of the {target} layer")
        job.add_argument("--sources", nargs="+", default=SOURCES)
        job.add_argument("--scheduled", action="store_true")
        job.add_argument("--now", type=datetime.fromisoformat, help="the time a scheduled run counts from; else that of the clock, in UTC")
        job.add_argument("--ignore-corrupt", action="store_true", help="skip files that cannot be read")
        job.add_argument("--day")
        job.add_argument("--start")
        job.add_argument("--end")
        if name == "compact":
            job.add_argument("--target-bytes", type=int, default=TARGET_BYTES)
        else:
            job.add_argument("--strict", action="store_true", help="fail on the first malformed payload")
            job.add_argument("--rejects", help="root for malformed payloads; without it they are only counted")

    merge = jobs.add_parser("merge", help="merge the raw layer's batches of hours that are over")
    merge.add_argument("--raw", required=True)
    merge.add_argument("--now", type=datetime.fromisoformat, help="hours that ended before this count as over; else the clock, in UTC")
    merge.add_argument("--settle-minutes", type=int, default=60, help="how long an hour and its files must have been at rest")
    merge.add_argument("--retain-hours", type=int, default=24, help="how long replaced folders are left to readers")
    merge.add_argument("--day")
    merge.add_argument("--start")
    merge.add_argument("--end")

    query = jobs.add_parser("query")
    query.add_argument("sql")
    query.add_argument("--alias", action="append", default=[], metavar="NAME=PATH")
    query.add_argument("--out", required=True, help="new folder for the result")
    return parser


def _window(args: argparse.Namespace) -> tuple[date, date]:
    if args.day:
        window = Days.on(args.day)
    elif args.start and args.end:
        window = Days.through(args.start, args.end)
    else:
        raise ValueError("give --day, --start and --end, or --scheduled")
    return window.first, window.last


def _now(args: argparse.Namespace) -> datetime:
    return args.now or datetime.now(UTC).replace(tzinfo=None)


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = configure(SparkSession.builder.appName(f"paylake-{args.job}").getOrCreate())
    if args.job == "ingest":
        if args.servers:
            messages = kafka_messages(
                spark, args.servers, args.topics, args.smallest_batch, args.longest_wait, args.largest_batch
            )
        else:
            messages = file_messages(spark, args.folder)
        if args.drain:
            print(drain_ingest(messages, args.raw, args.rejects, args.checkpoints))
        else:
            start_ingest(messages, args.raw, args.rejects, args.checkpoints)
            spark.streams.awaitAnyTermination()
    elif args.job == "process":
        more = args.sources, args.strict, args.ignore_corrupt, args.rejects
        if args.scheduled:
            print(process_previous_hour(spark, args.origin, args.target, _now(args), *more))
        else:
            print(process_days(spark, args.origin, args.target, *_window(args), *more))
    elif args.job == "compact":
        more = args.sources, args.target_bytes, args.ignore_corrupt
        if args.scheduled:
            compact_previous_day(spark, args.origin, args.target, _now(args), *more)
        else:
            compact_days(spark, args.origin, args.target, *_window(args), *more)
    elif args.job == "merge":
        window, now = Days(*_window(args)), _now(args)
        told = merge_batches(spark, args.raw, window, now, timedelta(minutes=args.settle_minutes))
        print(told | {"removed": clean_merged(spark, args.raw, window, now, timedelta(hours=args.retain_hours))})
    else:
        for alias in args.alias:
            name, _, path = alias.partition("=")
            register_alias(spark, name, path)
        run_query(spark, args.sql).write.parquet(args.out)


if __name__ == "__main__":
    main()
