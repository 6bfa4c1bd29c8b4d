"""Command line of the stages, for ``spark-submit`` or ``python -m energylake``.

    pull    service pages to a topic       ingest  topics to bronze
    clean   bronze to silver               gold    silver to gold and its documents
    train   gold to a model                score   homes scored with a model
    export  gold in plain types for reporting tools
    show    overview figures of the chosen homes
"""

from __future__ import annotations

import argparse

from energylake import fixed_values as fv
from energylake.operators.rows import is_empty
from energylake.plans import jobs
from energylake.plans.dashboard import overview, selected_homes
from energylake.session import build_session
from energylake.sources.layers import bi_export, read_layer, write_layer
from energylake.sources.messages import publish_stream
from energylake.sources.paged import HttpPages, paged_source
from energylake.streaming.ingest import (
    ingest_to_bronze, read_stream, run_totals, topic_options)

# a bounded backlog per micro-batch keeps a first run restartable in steps
BATCH_MESSAGES = 1_000_000


def report(df) -> None:
    """Every row of a small result, run once."""
    rows = df.collect()
    df.sparkSession.createDataFrame(rows, df.schema).show(len(rows), truncate=False)


def pull(spark, a) -> None:
    spark.dataSource.register(paged_source(HttpPages(a.url)))
    reader = (spark.readStream.format("paged").option("offset", a.offset)
              .option("page_size", a.page_size))
    if a.limit is not None:
        reader = reader.option("limit", a.limit)
    publish_stream(reader.load(), a.topic, {"kafka.bootstrap.servers": a.brokers},
                   a.checkpoint).awaitTermination()


def ingest(spark, a) -> None:
    tasks = a.tasks or spark.sparkContext.defaultParallelism
    stream = read_stream(spark, topic_options(a.brokers, max_per_trigger=a.batch_size,
                                              min_partitions=tasks))
    for folder, messages in run_totals(ingest_to_bronze(stream, a.bronze, a.checkpoint)).items():
        print(f"{folder}\t{messages}")


def clean(spark, a) -> None:
    if a.day:
        jobs.clean_day(spark, a.bronze, a.silver, a.staging, a.sketches, a.day, dataset=a.dataset,
                       discover=not a.infer)
        return
    report(jobs.bronze_to_silver(spark, a.bronze, a.silver, a.staging, dataset=a.dataset,
                                 discover=not a.infer))


def gold(spark, a) -> None:
    jobs.publish_gains(jobs.silver_to_gold(spark, a.silver, a.gold), a.gains)


def train(spark, a) -> None:
    report(jobs.publish_model(read_layer(spark, a.gold), a.model, a.metrics))


def score(spark, a) -> None:
    jobs.score_layer(spark, a.homes, a.model, a.out)


def export(spark, a) -> None:
    write_layer(bi_export(read_layer(spark, a.gold)), a.out)


def show(spark, a) -> None:
    homes = selected_homes(read_layer(spark, a.gold), classes=a.classes, kinds=a.kinds,
                           surfaces=a.surface and tuple(a.surface))
    if is_empty(homes):
        print("no home passes the filters")
        return
    report(overview(homes).orderBy("panel", "label"))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="energylake")
    stages = top.add_subparsers(required=True)

    def stage(run, *paths: str) -> argparse.ArgumentParser:
        p = stages.add_parser(run.__name__)
        p.set_defaults(run=run)
        for path in paths:
            p.add_argument(f"--{path}", required=True)
        return p

    p = stage(pull, "url", "topic", "brokers", "checkpoint")
    p.add_argument("--limit", type=int, help="most rows (default: all)")
    p.add_argument("--offset", type=int, default=0, help="first row")
    p.add_argument("--page-size", type=int, default=fv.PAGE_SIZE)
    p = stage(ingest, "brokers", "bronze", "checkpoint")
    p.add_argument("--batch-size", type=int, default=BATCH_MESSAGES,
                   help="most messages per micro-batch (default: %(default)s)")
    p.add_argument("--tasks", type=int, help="least tasks per micro-batch (default: one per core)")
    p = stage(clean, "bronze", "silver", "staging")
    p.add_argument("--infer", action="store_true", help="infer all types from the data")
    p.add_argument("--dataset", help="one partition of the root that ingest writes")
    p.add_argument("--day", help="clean this day only, into its partition of silver")
    p.add_argument("--sketches", help="table of the days' statistics, needed with --day")
    stage(gold, "silver", "gold", "gains")
    stage(train, "gold", "model", "metrics")
    stage(score, "homes", "model", "out")
    stage(export, "gold", "out")
    p = stage(show, "gold")
    p.add_argument("--classes", nargs="+")
    p.add_argument("--kinds", nargs="+", help="building types")
    p.add_argument("--surface", nargs=2, type=float, metavar=("LOW", "HIGH"))
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    if getattr(args, "day", None) and not args.sketches:
        parser().error("--day needs --sketches")
    args.run(build_session(), args)


if __name__ == "__main__":
    main()
