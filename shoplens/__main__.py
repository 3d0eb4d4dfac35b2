"""Command line: run a job the way ``spark-submit`` would.

    spark-submit --py-files shoplens.zip -m shoplens session \\
        --tables hdfs:///warehouse/commerce --params task.json --out hdfs:///warehouse/out

``--tables`` is a folder holding ``<name>.parquet`` tables, or omitted to use
catalog tables.  ``--out`` is a parquet folder; ``--jdbc-url`` writes to a
database instead.  ``ad-stream`` runs until stopped (or, with
``--available-now``, until the input folder is consumed).
"""

from __future__ import annotations

import argparse
import json
import sys

from shoplens.params import TaskParams
from shoplens.plans import ad_job, page_job, product_job, session_job
from shoplens.sinks.writers import JdbcSink, ParquetSink
from shoplens.sources.tables import load_table, prepare_actions
from shoplens.spark import build_session, ensure_checkpoint_dir
from shoplens.streaming import ad_stream


def _params(path: str | None) -> TaskParams:
    if not path:
        raise SystemExit("--params is required")
    with open(path, encoding="utf-8") as f:
        return TaskParams.from_dict(json.load(f))


def _sink(args):
    if args.jdbc_url:
        props = dict(p.split("=", 1) for p in (args.jdbc_prop or []))
        return JdbcSink(args.jdbc_url, props)
    if not args.out:
        raise SystemExit("--out or --jdbc-url is required")
    return ParquetSink(args.out, mode=args.mode)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="shoplens")
    ap.add_argument("job", choices=["session", "page", "product", "ad-batch", "ad-stream"])
    ap.add_argument("--tables", default="", help="folder of <name>.parquet tables (default: catalog)")
    ap.add_argument("--params", help="task parameters as JSON (reference key names)")
    ap.add_argument("--out", help="output parquet folder")
    ap.add_argument("--mode", default="append", choices=["append", "overwrite"])
    ap.add_argument("--jdbc-url")
    ap.add_argument("--jdbc-prop", action="append", help="key=value JDBC property (repeatable)")
    ap.add_argument("--task-id")
    ap.add_argument("--threshold", type=int, default=100, help="blacklist: clicks per user/ad/day above this")
    ap.add_argument("--log", help="ad log: text folder (ad-batch, ad-stream)")
    ap.add_argument("--kafka", help="ad-stream: bootstrap servers; with --topic")
    ap.add_argument("--topic", help="ad-stream: Kafka topic")
    ap.add_argument("--filter-trend", action="store_true", help="ad jobs: trend of clicks that pass the blacklist only")
    ap.add_argument("--state-partitions", type=int, help="ad-stream: partitions of the streaming state")
    ap.add_argument("--checkpoint", help="ad-stream: checkpoint folder (default: spark.checkpoint.dir)")
    ap.add_argument("--available-now", action="store_true")
    args = ap.parse_args(argv)

    spark = build_session(app_name=f"shoplens-{args.job}")
    if args.job in ("session", "page", "product"):
        params = _params(args.params)
        actions = prepare_actions(load_table(spark, args.tables, "user_visit_action"))
        sink = _sink(args)
        if args.job == "session":
            task = session_job.run(spark, actions, load_table(spark, args.tables, "user_info"), params, sink,
                                   args.task_id)
        elif args.job == "page":
            task = page_job.run(spark, actions, params, sink, args.task_id)
        else:
            task = product_job.run(spark, actions, load_table(spark, args.tables, "product_info"), params, sink,
                                   args.task_id)
        print(task)
        return 0
    if args.job == "ad-batch":
        if not args.log:
            raise SystemExit("--log is required")
        ad_job.run(spark.read.text(args.log), _sink(args), args.threshold, filter_trend=args.filter_trend)
        return 0
    # ad-stream
    if not args.out:
        raise SystemExit("--out is required")
    if args.kafka:
        if not args.topic:
            raise SystemExit("--kafka needs --topic")

        def lines(session):
            return ad_stream.kafka_source(session, args.kafka, args.topic)
    elif args.log:

        def lines(session):
            return ad_stream.file_source(session, args.log)
    else:
        raise SystemExit("--kafka or --log is required")
    trigger = {"availableNow": True} if args.available_now else None
    names = ad_stream.QUERY_NAMES + (ad_stream.REJECTS,)
    if args.available_now:
        checkpoint = args.checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/ad-stream"
        if not args.log:
            raise SystemExit("--available-now needs --log")
        ad_stream.run_available(
            spark, args.log, args.out, checkpoint, args.threshold, names=names, filter_trend=args.filter_trend,
            state_partitions=args.state_partitions,
        )
        return 0
    queries = ad_stream.start_ad_queries(
        spark, lines, args.out, args.checkpoint, args.threshold, names=names, filter_trend=args.filter_trend,
        state_partitions=args.state_partitions,
    )
    for q in queries.values():
        q.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
