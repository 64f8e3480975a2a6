"""Jobs for spark-submit: create, publish, stream, refresh, queue, review, purge, contracts, inspect."""

import argparse
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tallywell.operators.report import SAMPLE_COLUMNS, inspect_layers, layer_sample, top_rows
from tallywell.operators.validate import Policy
from tallywell.plans.gold import create_views, refresh_customer_activity, refresh_daily_revenue
from tallywell.plans.governance import contracts_job, open_reviews, purge_job, review_job
from tallywell.plans.ingest import order_events
from tallywell.sinks import Layers, create_layers, file_writer, kafka_writer, publish_events
from tallywell.sources import (
    decode_events,
    file_stream,
    kafka_stream,
    read_csv_text,
    read_raw_orders,
    read_raw_payments,
)
from tallywell.streaming import PipelineOptions, start_pipeline
from tallywell.streaming.pipeline import TRIGGER


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tallywell", description=__doc__)
    parser.add_argument("--prefix", default="", help="prefix of the schema names")
    parser.add_argument("--catalog", help="catalog that holds the schemas")
    parser.add_argument("--provider", default="parquet", help="table format")
    parser.add_argument("--location", help="shared folder for file tables")
    jobs = parser.add_subparsers(dest="job", required=True)

    jobs.add_parser("create", help="create schemas and tables")

    publish = jobs.add_parser("publish", help="orders and payments CSV to events")
    publish.add_argument("orders")
    publish.add_argument("payments")
    publish.add_argument("--structural-rate", type=float, default=0.0)
    publish.add_argument("--business-rate", type=float, default=0.0)
    publish.add_argument("--delivered-at", type=int, help="milliseconds since 1970; the same repeats the same ids")
    stream = jobs.add_parser("stream", help="events to bronze, quarantine and silver")
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--trigger", default=TRIGGER, help="interval, or 'once' to work off what is there")
    stream.add_argument("--rate", type=int, help="offsets (with --servers) or files in a batch at most; no limit if absent")
    stream.add_argument("--strict-amount", action="store_true", help="amounts that are no number are invalid")
    stream.add_argument("--blank-is-empty", action="store_true", help="a status of white space is an empty one")
    stream.add_argument("--route-on-all", action="store_true", help="any broken rule sends a row to quarantine")
    stream.add_argument("--keep-newest", action="store_true", help="the greater ingest id wins, not the last batch")
    stream.add_argument("--overwrite-reviewed", action="store_true", help="a new delivery replaces a reviewed row")
    stream.add_argument("--order-day-is-fixed", action="store_true", help="a redelivered order keeps its day")
    for job in (publish, stream):
        job.add_argument("--codec", default="json", choices=("json", "avro"))
        job.add_argument("--servers", help="Kafka servers; without them, --topic and --dead are folders")
        job.add_argument("--topic", required=True)
    publish.add_argument("--dead", required=True, help="topic or folder of the dead letters")

    refresh = jobs.add_parser("refresh", help="rebuild the gold tables and their views")
    refresh.add_argument("--full-refresh", action="store_true")
    refresh.add_argument("--lookback-days", type=int, help="recompute so many days before the newest, not the touched ones")
    refresh.add_argument("--order-ids-unique", action="store_true", help="silver holds each order once")
    queue = jobs.add_parser("queue", help="write the open reviews to a folder, as CSV")
    queue.add_argument("folder")
    jobs.add_parser("contracts", help="run the data contracts; exit status 1 on a breach")
    review = jobs.add_parser("review", help="apply a CSV of decisions")
    review.add_argument("decisions")
    jobs.add_parser("purge", help="move anomalies out of the clean table")
    jobs.add_parser("inspect", help="print the report on all layers")
    return parser


def run(spark: SparkSession, arguments: list[str] | None = None) -> int:
    """Run one job; the exit status."""
    args = _arguments().parse_args(arguments)
    layers = Layers(prefix=args.prefix, catalog=args.catalog)
    if args.job in ("create", "stream"):
        create_layers(spark, layers, provider=args.provider, location=args.location)
    if args.job == "publish":
        events = order_events(
            read_raw_orders(spark, args.orders),
            read_raw_payments(spark, args.payments),
            delivered_at=F.lit(args.delivered_at if args.delivered_at is not None else time.time_ns() // 1_000_000),
            structural_rate=args.structural_rate,
            business_rate=args.business_rate,
        )
        targets = [kafka_writer(args.servers, t) if args.servers else file_writer(t) for t in (args.topic, args.dead)]
        publish_events(events, *targets, codec=args.codec, on_dead=lambda n: print(f"{n} events could not be encoded"))
    elif args.job == "stream":
        if args.servers:
            raw = kafka_stream(spark, args.servers, args.topic, max_offsets_per_trigger=args.rate)
        else:
            raw = file_stream(spark, args.topic, "value binary", max_files_per_trigger=args.rate, position=True)
        trigger = None if args.trigger == "once" else args.trigger
        events = decode_events(raw, codec=args.codec, origin=True)
        options = PipelineOptions(
            policy=Policy(
                strict_amount=args.strict_amount,
                blank_is_empty=args.blank_is_empty,
                route_on="all" if args.route_on_all else Policy().route_on,
            ),
            protect_reviewed=not args.overwrite_reviewed,
            keep_newest=args.keep_newest,
            order_day_is_fixed=args.order_day_is_fixed,
        )
        query = start_pipeline(events, layers, args.checkpoint, trigger=trigger, options=options, on_alert=print)
        query.awaitTermination()
    elif args.job == "refresh":
        refresh_daily_revenue(
            spark,
            layers,
            full_refresh=args.full_refresh,
            lookback_days=args.lookback_days,
            provider=args.provider,
            order_ids_unique=args.order_ids_unique,
        )
        refresh_customer_activity(spark, layers, provider=args.provider)
        create_views(spark, layers)
    elif args.job == "review":
        # Files may go without the row_key that ``queue`` writes.
        bad = review_job(spark, layers, read_csv_text(spark, args.decisions))
        print(f"{bad.count()} decisions could not be applied, see {layers.bad_decisions}")
    elif args.job == "queue":
        open_reviews(spark, layers).write.option("header", True).csv(args.folder)
    elif args.job == "contracts":
        return contracts_job(spark, layers, print)
    elif args.job == "purge":
        print(f"{purge_job(spark, layers)} rows moved to quarantine")
    elif args.job == "inspect":
        frames = layers.frames(spark)
        # A handful of rows for each layer.
        for row in inspect_layers(spark, frames).collect():
            print(*row, sep="\t")
        for layer in (*SAMPLE_COLUMNS, "audit_log"):
            if frames[layer] is not None:
                layer_sample(layer, frames[layer]).show(truncate=False)
        for layer, by in (("daily_revenue", "revenue_date"), ("customer_activity", "total_spent")):
            if frames[layer] is not None:
                top_rows(frames[layer], by).show(truncate=False)


    return 0


if __name__ == "__main__":
    sys.exit(run(SparkSession.builder.getOrCreate()))
