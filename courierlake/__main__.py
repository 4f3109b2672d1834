"""Jobs of the lake for spark-submit: `python -m courierlake <job> --root <folder> ...`."""

import argparse

from courierlake.operators import reports
from courierlake.operators.dims import current
from courierlake.plans import batch
from courierlake.session import build_session
from courierlake.sources.lake import Lake
from courierlake.sources.synth import synth_lake
from courierlake.streaming import ingest, joined, refine, state, watch

PROGRESS = "stream_progress"


def _synth(lake: Lake, args) -> None:
    print(synth_lake(lake, args.orders, args.seed, args.as_of))


def _silver(lake: Lake, args) -> None:
    print(batch.run_silver(lake, args.as_of))
    batch.check_silver(lake)


def _gold(lake: Lake, args) -> None:
    print(batch.run_gold(lake, args.as_of))


def _batch(lake: Lake, args) -> None:
    print(batch.run_batch(lake, args.as_of))


def _messages(lake: Lake, args, place: str):
    if args.servers:
        return ingest.kafka_messages(lake.spark, args.servers, place)
    return ingest.file_messages(lake.spark, place)


def _ingest(lake: Lake, args) -> None:
    def refresh(rows, batch_id):
        refine.refresh_from_stream(lake, rows, batch_id)

    with watch.watched(lake.spark, f"{lake.root}/{PROGRESS}"):
        queries = [ingest.start_ingest(lake, "orders", _messages(lake, args, args.orders_from),
                                       then=refresh if args.refresh else None),
                   ingest.start_ingest(lake, "order_items", _messages(lake, args, args.items_from))]
        print(ingest.run_bounded(queries, args.idle_seconds, args.max_seconds))


def _stream(lake: Lake, args) -> None:
    """Facts straight from the topics: one row per order over all batches, and lines joined to their orders."""
    with watch.watched(lake.spark, f"{lake.root}/{PROGRESS}"):
        queries = [state.start_orders(lake, _messages(lake, args, args.orders_from), args.as_of),
                   joined.start_lines(lake, _messages(lake, args, args.orders_from),
                                      _messages(lake, args, args.items_from), args.as_of)]
        print(ingest.run_bounded(queries, args.idle_seconds, args.max_seconds))


def _health(lake: Lake, args) -> None:
    stored = lake.spark.read.schema(watch.PROGRESS).parquet(f"{lake.root}/{PROGRESS}")
    watch.stream_health(stored).orderBy("query", "batch_id").show(500, truncate=False)


def _late(lake: Lake, args) -> None:
    print("days rebuilt:", batch.catch_up(lake, args.as_of))


def _confirm(lake: Lake, args) -> None:
    print("days rebuilt:", batch.confirm_deliveries(lake, args.as_of, args.limit))


def _verify(lake: Lake, args) -> None:
    batch.reconcile(lake).show(50, truncate=False)


def _describe(lake: Lake, args) -> None:
    lake.describe().show(500, truncate=False)


def _report(lake: Lake, args) -> None:
    """A glance at the lake; each report is a DataFrame in `operators.reports` for any other use."""
    orders, ratings = lake.read("gold", "fact_orders"), lake.read("gold", "fact_ratings")
    restaurants, drivers = lake.read("gold", "dim_restaurants"), current(lake.read("gold", "dim_drivers"))
    for df in (reports.revenue_summary(orders), reports.status_breakdown(orders),
               reports.top_restaurants_rated(orders, ratings, restaurants),
               reports.top_drivers(orders, ratings, drivers),
               reports.daily_trends(orders, lake.read("gold", "dim_date")),
               reports.rating_summary(ratings),
               reports.latest_summary(lake.read("gold", "fact_business_summary"))):
        df.show(truncate=False)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="courierlake")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name, run, dated=True):
        p = jobs.add_parser(name)
        p.set_defaults(run=run)
        p.add_argument("--root", required=True, help="folder of the lake, on any file system Spark reads")
        if dated:
            p.add_argument("--as-of", required=True, help="the run's now, such as '2024-03-01 12:00:00'")
        return p

    p = job("synth", _synth)
    p.add_argument("--orders", type=int, default=5_000)
    p.add_argument("--seed", type=int, default=0)
    for name, run in (("silver", _silver), ("gold", _gold), ("batch", _batch)):
        job(name, run)
    for name, run in (("ingest", _ingest), ("stream", _stream)):
        p = job(name, run, dated=name == "stream")
        p.add_argument("--servers", help="Kafka servers; without them the sources are folders of JSON lines")
        p.add_argument("--orders-from", required=True, help="topic or folder")
        p.add_argument("--items-from", required=True, help="topic or folder")
        if name == "ingest":
            p.add_argument("--refresh", action="store_true", help="also refresh silver and gold per batch")
        p.add_argument("--idle-seconds", type=float, default=ingest.IDLE_SECONDS)
        p.add_argument("--max-seconds", type=float, default=ingest.MAX_SECONDS)
    p = job("late", _late)
    p = job("confirm", _confirm)
    p.add_argument("--limit", type=int)
    for name, run in (("verify", _verify), ("describe", _describe), ("report", _report), ("health", _health)):
        job(name, run, dated=False)
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    lake = Lake(build_session(f"courierlake {args.job}"), args.root)
    args.run(lake, args)


if __name__ == "__main__":
    main()
