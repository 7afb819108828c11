"""Command-line entry points for the jobs.

    python -m dqspark.jobs stream --source kafka --servers host:9092 --topic patient_data \
        --lake /shared/lake --issues /shared/issues --summary /shared/summary --checkpoint /shared/ckpt
    python -m dqspark.jobs stream --source text --input /shared/incoming ...
    python -m dqspark.jobs daily --lake /shared/lake --out /shared/published [--run-date 2024-01-15]
    python -m dqspark.jobs daily --lake /shared/lake --out /shared/published --state /shared/state [--redo 2024-01-15]
    python -m dqspark.jobs compact --lake /shared/lake --keep-seconds 86400

Rules come from a YAML/JSON rule file (``--rules``) or default to the vital-sign
rule set.  The session is taken from ``spark-submit`` (master, resources and
``spark.checkpoint.dir`` are the cluster's); only the settings the operators
rely on are added.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from .rules import Rules, vitals_rules
from .session import ensure_conf, scratch_scope
from .sources.packs import MIN_FILES, compact, sweep


def _rules(path: str | None, roles: dict) -> Rules:
    roles = {k: v for k, v in roles.items() if v is not None}
    if not path:
        return vitals_rules(**roles)
    if path.endswith(".json"):
        with open(path) as fh:
            return Rules.from_dict(json.load(fh), **roles)
    return Rules.from_yaml(path, **roles)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="dqspark.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    for name in ("stream", "daily"):
        p = sub.add_parser(name)
        p.add_argument("--rules")
        p.add_argument("--entity")
        p.add_argument("--subject")
        p.add_argument("--time")
        p.add_argument("--lake", required=True)
    s = sub.choices["stream"]
    s.add_argument("--source", choices=("kafka", "text"), default="kafka")
    s.add_argument("--servers")
    s.add_argument("--topic", default="patient_data")
    s.add_argument("--input")
    s.add_argument("--issues")
    s.add_argument("--summary")
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--trigger", default="1 minute", help="processing-time interval, or 'available-now'")
    s.add_argument("--console", action="store_true")
    s.add_argument("--issues-format", default="json", help="file format, or 'kafka'")
    s.add_argument("--issues-option", action="append", default=[], metavar="KEY=VALUE", help="option of the issues sink")
    s.add_argument("--immediate", help="folder for row-check issues, written at once")
    s.add_argument("--stream-salts", type=int, help="state partitions that one entity's window is spread over")
    s.add_argument("--late-for", help="how long the landing table keeps a closed window's records, e.g. '2 days' (default: for good)")
    s.add_argument("--state-partitions", type=int, help="state partition count (fixed at the first start)")
    d = sub.choices["daily"]
    d.add_argument("--out", required=True)
    d.add_argument("--run-date")
    d.add_argument("--show", action="store_true")
    d.add_argument("--state", help="state tables: only dates without a state are read, and those of --redo")
    d.add_argument("--redo", action="append", default=[], metavar="DATE", help="a date whose state is made anew, as late records changed it")
    d.add_argument("--expire-seconds", type=float, help="remove versions that were replaced longer ago")
    c = sub.add_parser("compact")
    c.add_argument("--lake", required=True)
    c.add_argument("--min-files", type=int, default=MIN_FILES, help="small files that make a date worth packing")
    c.add_argument("--date", action="append", help="pack this date only (repeatable)")
    c.add_argument("--keep-seconds", type=float, default=86_400.0, help="longest compaction or query; what was replaced before goes")
    a = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"dqspark-{a.job}").getOrCreate()
    ensure_conf(spark)
    with scratch_scope(spark):  # what the job wrote on the way goes when its results are written
        if a.job == "compact":
            compact(spark, a.lake, a.min_files, a.date)
            sweep(spark, a.lake, a.keep_seconds)
        elif a.job == "daily":
            _daily(spark, a, _rules(a.rules, {"entity": a.entity, "subject": a.subject, "time": a.time}))
        else:
            _stream(spark, a, _rules(a.rules, {"entity": a.entity, "subject": a.subject, "time": a.time}))


def _daily(spark: SparkSession, a: argparse.Namespace, rules: Rules) -> None:
    from .plans.daily import run_daily
    from .plans.incremental import dates_to_do, run_daily_incremental
    from .sources.snapshots import expire

    if a.state:
        if a.run_date or a.show:
            raise SystemExit("--state goes with neither --run-date nor --show")
        dates = sorted({*dates_to_do(spark, a.lake, a.state), *a.redo})
        run_daily_incremental(spark, a.lake, a.state, a.out, rules, dates)
    else:
        run_daily(spark, a.lake, a.out, rules, run_date=a.run_date, show=a.show)
    if a.expire_seconds is not None:
        expire(spark, a.out, a.expire_seconds)


def _stream(spark: SparkSession, a: argparse.Namespace, rules: Rules) -> None:
    from .sources.decode import text_stream, topic_source
    from .streaming.pipeline import StreamSinks, run_stream

    raw = topic_source(spark, a.servers, a.topic) if a.source == "kafka" else text_stream(spark, a.input)
    trigger = {"availableNow": True} if a.trigger == "available-now" else {"processingTime": a.trigger}
    options = dict(x.split("=", 1) for x in a.issues_option)
    issues = a.issues or ("topic" if a.issues_format == "kafka" else None)
    sinks = StreamSinks(
        lake=a.lake, issues=issues, summary=a.summary, console=a.console,
        issues_format=a.issues_format, issues_options=options, immediate=a.immediate,
    )
    run_stream(
        spark, raw, rules, sinks, a.checkpoint, trigger=trigger,
        state_partitions=a.state_partitions, stream_salts=a.stream_salts, late_for=a.late_for,
    )


if __name__ == "__main__":
    main()
