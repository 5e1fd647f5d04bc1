"""Command line: ``python -m blotter batch ...`` and ``python -m blotter stream ...``.

batch  : stage the CSV inputs and write every mart (Parquet by default, or JDBC).
stream : run the alert stream over a message source until stopped, or over what
         is available now (``--available-now``), sinking alerts by batch id.
"""

from __future__ import annotations

import argparse
import json


def _batch(args) -> None:
    from blotter.plans.batch import run_batch
    from blotter.session import get_spark
    spark = get_spark(args.master, app="blotter-batch")
    paths = {k: getattr(args, k) for k in ("incidents", "arrests", "violence", "registry", "stations")
             if getattr(args, k)}
    jdbc = {}
    if args.jdbc_url:
        jdbc = {"jdbc_url": args.jdbc_url, "jdbc_props": json.loads(args.jdbc_props or "{}")}
    written = run_batch(spark, paths, args.out, fmt="jdbc" if args.jdbc_url else "parquet",
                        k=args.k, seed=args.seed, max_iter=args.max_iter, **jdbc)
    print(json.dumps(written))


def _stream(args) -> None:
    from blotter.session import get_spark
    from blotter.streaming import pipeline as SP
    spark = get_spark(args.master, app="blotter-stream")
    options = dict(o.split("=", 1) for o in args.option)
    if args.broker_rows:   # e.g. --format kafka --option kafka.bootstrap.servers=... --option subscribe=...
        msgs = SP.from_broker_rows(SP.read_messages(spark, None, args.format, options=options))
    else:
        msgs = SP.read_messages(spark, args.source, args.format, schema=args.schema, options=options)
    jdbc = SP.jdbc_target(args.jdbc_url, args.jdbc_table, json.loads(args.jdbc_props or "{}")) if args.jdbc_url else None
    if args.state == "table":
        rows = SP.accepted_events(msgs)
        sink = SP.table_state_alert_sink(f"{args.out}-history", args.out, args.window_seconds, args.threshold, docs_dir=args.docs,
                                         query=args.name, mart="alerts", jdbc=jdbc)
    else:
        rows = SP.build_alert_stream(msgs, args.window_seconds, args.threshold)
        sink = SP.batch_sink(args.out, args.docs, mart="alerts", query=args.name, jdbc=jdbc)
    ckpt = args.checkpoint
    w = rows.writeStream.outputMode("append").option("checkpointLocation", ckpt).foreachBatch(sink)
    trigger = {"availableNow": True} if args.available_now else {"processingTime": args.trigger}
    queries = [w.trigger(**trigger).start()]
    if args.rejected:
        queries.append(SP.rejected_event_sink(msgs, args.rejected, f"{ckpt}-rejected", trigger))
    for q in queries:
        q.awaitTermination()


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="blotter")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("batch", help="CSV inputs -> marts")
    for k in ("incidents", "arrests", "violence", "registry", "stations"):
        b.add_argument(f"--{k}", help=f"{k} CSV path")
    b.add_argument("--out", required=True)
    b.add_argument("--jdbc-url")
    b.add_argument("--jdbc-props", help="JSON object of JDBC properties")
    b.add_argument("--k", type=int, default=10)
    b.add_argument("--seed", type=int, default=42)
    b.add_argument("--max-iter", type=int, default=20)
    b.set_defaults(fn=_batch)
    s = sub.add_parser("stream", help="messages -> alerts")
    s.add_argument("--source", help="path for file sources")
    s.add_argument("--broker-rows", action="store_true",
                   help="source rows have the broker schema (key, value, partition, offset, timestamp)")
    s.add_argument("--format", default="json")
    s.add_argument("--schema", default="id long, ts timestamp_ntz, value string")
    s.add_argument("--option", action="append", default=[], help="source option key=value")
    s.add_argument("--out", required=True)
    s.add_argument("--docs")
    s.add_argument("--rejected", help="path for rejected messages (dead letters)")
    s.add_argument("--checkpoint", required=True, help="folder that a restart finds again: offsets and state live there")
    s.add_argument("--name", default="alerts", help="query name; outputs are kept by (name, batch), so a fresh checkpoint needs a new one")
    s.add_argument("--state", choices=["table", "store"], default="table", help="where the window lives: history table or state store")
    s.add_argument("--jdbc-url", help="also write alert rows to this database")
    s.add_argument("--jdbc-table", default="alerts")
    s.add_argument("--jdbc-props", help="JSON object of JDBC properties")
    s.add_argument("--window-seconds", type=int, default=300)
    s.add_argument("--threshold", type=int, default=10)
    s.add_argument("--trigger", default="10 seconds")
    s.add_argument("--available-now", action="store_true")
    s.set_defaults(fn=_stream)
    args = p.parse_args(argv)
    args.fn(args)


if __name__ == "__main__":
    main()
