"""Jobs for spark-submit: `jobs.py COMMAND [options]`: ingest, train, score, alert,
windows, consumption, report, forecast, publish, compact."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from meterlake import schemas, sinks
from meterlake.operators import alerts, report as reports, running, shape
from meterlake.plans import dashboard, model as power_model, moments
from meterlake.session import build_session
from meterlake.sources import files, kafka
from meterlake.streaming import jobs as streams


def read_topic(spark, args, starting_offsets: str | None = None):
    limits = args.max_offsets, args.max_records_per_task
    return kafka.read_topic(spark, args.servers, args.topic, starting_offsets, *limits)


def ingest(spark, args) -> None:
    """Keep the lake up to date with the readings topic."""
    messages = read_topic(spark, args, "earliest")
    query = streams.start_ingest(
        messages, args.lake, args.checkpoint, trigger(args, streams.INGEST_EVERY),
        args.files_per_date, args.drop_repeats,
    )
    query.awaitTermination()


def train(spark, args) -> str | None:
    """Fit the power model on the lake."""
    if args.moments:
        model = moments.train_and_save(spark, args.lake, args.moments, args.model)
    else:
        model = power_model.train_and_save(spark, args.lake, args.model, args.compacted)
    if model is None:
        return "no complete readings to train on"
    if args.moments:
        return None  # a report would read the whole lake
    lake = files.read_compacted_lake(spark, args.lake, args.compacted)
    power_model.train_report(model, lake).show()


def score(spark, args) -> str | None:
    """Predict the power of new readings."""
    model = power_model.load(args.model)
    if model is None:
        return f"no model at {args.model}"
    messages = read_topic(spark, args)
    query = streams.start_scoring(
        messages, model, args.predictions, args.checkpoint, trigger(args, streams.SCORE_EVERY)
    )
    query.awaitTermination()


def alert(spark, args) -> str | None:
    """Raise over-voltage alerts on their own topic."""
    messages = read_topic(spark, args)
    rules = [alerts.OverVoltage()]
    try:
        queries = streams.start_alerts(
            messages, rules, None, args.checkpoint, trigger(args, streams.SCORE_EVERY),
            lambda raised: kafka.stream_to_topic(raised, args.servers, args.alerts_topic),
        )
        failed = streams.wait_for_all(queries)
    finally:
        alerts.finish_rules(rules)
    return f"{len(failed)} alert rules failed" if failed else None


def windows(spark, args) -> None:
    """Keep energy per meter and window up to date, late readings included."""
    messages = read_topic(spark, args, "earliest")
    query = streams.start_window_energy(
        messages, args.windows, args.checkpoint, args.length, args.digits,
        trigger(args, streams.INGEST_EVERY),
    )
    query.awaitTermination()


def consumption(spark, args) -> None:
    """Print or store the energy per meter and window that `windows` has written."""
    found = streams.read_window_energy(spark, args.windows, args.digits)
    if args.out:
        found.write.mode("overwrite").parquet(args.out)
    else:
        found.orderBy("window_start", "meter_id").show(args.rows, truncate=False)


def report(spark, args) -> None:
    """Print the dashboard's figures, or store them in full with --out."""
    as_of = F.lit(args.as_of).cast("timestamp") if args.as_of else F.current_timestamp()
    found = dashboard.tables(
        spark, args.lake, args.predictions, as_of, args.skip_corrupt, args.compacted
    )
    for name, table in found.items():
        if args.out:
            table.write.mode("overwrite").parquet(f"{args.out}/{name}")
        else:
            print(name)
            table.show(args.rows, truncate=False)


def forecast(spark, args) -> str | None:
    """Store the expected energy of the month per meter and date, from the lake or from the
    days that `windows --length "1 day"` keeps."""
    if args.windows:
        rows = streams.read_month_forecast(spark, args.windows, args.digits)
    elif args.lake:
        lake = files.read_compacted_lake(spark, args.lake, args.compacted)
        rows = reports.month_forecast(lake, args.digits)
    else:
        return "give --lake or --windows"
    rows.write.mode("overwrite").parquet(args.out)


def publish(spark, args) -> None:
    """Send historical readings to the topic, stamped as if each meter sent one per interval
    from --start on, or with their own times."""
    history = files.read_history(spark, args.history)
    if not args.keep_times:
        start = F.lit(args.start).cast("timestamp") if args.start else F.current_timestamp()
        history = running.stamped(history, start, args.interval)
    records = shape.nest_history(history, args.metrics)
    kafka.write_topic(shape.to_messages(records), args.servers, args.topic)


def compact(spark, args) -> None:
    """Take new files of the lake, of one date or of all, into full-size files elsewhere."""
    sinks.compact_lake(spark, args.lake, args.target, args.date)


def trigger(args, every: dict) -> dict:
    return streams.ONCE if args.once else every


def parser() -> argparse.ArgumentParser:
    commands = argparse.ArgumentParser(description=__doc__)
    sub = commands.add_subparsers(required=True)

    def command(
        run, *required: str, reads: bool = False, writes: bool = False
    ) -> argparse.ArgumentParser:
        cmd = sub.add_parser(run.__name__, help=run.__doc__)
        cmd.set_defaults(run=run)
        for name in required:
            cmd.add_argument(f"--{name}", required=True)
        if reads or writes:
            cmd.add_argument("--servers", required=True)
            cmd.add_argument("--topic", default=kafka.READINGS_TOPIC)
        if reads:
            cmd.add_argument("--max-offsets", type=int, help="messages per micro-batch")
            cmd.add_argument("--max-records-per-task", type=int)
            cmd.add_argument("--once", action="store_true", help="stop after what is there now")
        return cmd

    cmd = command(ingest, "lake", "checkpoint", reads=True)
    cmd.add_argument(
        "--files-per-date", type=int, default=streams.FILES_PER_DATE,
        help="most files a micro-batch adds to a date; 0 for no shuffle",
    )
    cmd.add_argument(
        "--drop-repeats", metavar="AGE", help='leave out repeats within this, such as "10 minutes"'
    )
    with_compacted(command(train, "lake", "model")).add_argument(
        "--moments", help="folder of sums kept between runs: only new files are read"
    )
    command(score, "model", "predictions", "checkpoint", reads=True)
    command(alert, "checkpoint", reads=True).add_argument(
        "--alerts-topic", default=kafka.ALERTS_TOPIC
    )
    cmd = with_compacted(command(report, "lake", "predictions"))
    cmd.add_argument("--as-of", help="UTC time that counts as now")
    cmd.add_argument("--rows", type=int, default=20, help="rows to print per table")
    cmd.add_argument("--out", help="folder for the whole tables, as Parquet")
    cmd.add_argument("--skip-corrupt", action="store_true")
    cmd = command(windows, "windows", "checkpoint", reads=True)
    cmd.add_argument("--length", default="3 days")
    cmd.add_argument("--digits", type=int, help="decimals of power, for exact sums")
    cmd = command(consumption, "windows")
    cmd.add_argument("--digits", type=int, help="as given to `windows`")
    cmd.add_argument("--rows", type=int, default=20, help="rows to print")
    cmd.add_argument("--out", help="folder for the whole table, as Parquet")
    cmd = with_compacted(command(forecast, "out"))
    cmd.add_argument("--digits", type=int)
    cmd.add_argument("--lake")
    cmd.add_argument("--windows", help="days that `windows` keeps, in place of a lake")
    cmd = command(publish, "history", writes=True)
    cmd.add_argument("--metrics", nargs="*", default=schemas.METRICS, choices=schemas.METRICS)
    cmd.add_argument("--start", help="UTC time of the first message, default now")
    cmd.add_argument("--interval", type=float, default=1.0, help="seconds between messages")
    cmd.add_argument("--keep-times", action="store_true")
    command(compact, "lake", "target").add_argument("--date", help="default: all dates")
    return commands


def with_compacted(cmd: argparse.ArgumentParser) -> argparse.ArgumentParser:
    cmd.add_argument("--compacted", help="target of `compact`, to read the lake from there")
    return cmd


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = build_session(f"meterlake-{args.run.__name__}")
    problem = args.run(spark, args)
    if problem:
        print(problem, file=sys.stderr)
    return 1 if problem else 0


if __name__ == "__main__":
    sys.exit(main())
