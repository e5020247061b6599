"""``python -m tidewell COMMAND``: the pipelines' jobs on a warehouse folder."""

from __future__ import annotations

import argparse
import json
from datetime import UTC, datetime, timedelta


def _hour(text: str) -> datetime:
    moment = datetime.fromisoformat(text.replace("Z", "+00:00"))
    if moment.tzinfo is None:
        raise argparse.ArgumentTypeError("the instant needs an offset")
    return moment.astimezone(UTC)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidewell")
    top.add_argument("--root", default="warehouse", help="warehouse folder")
    top.add_argument("--run-id", default="manual")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, *arguments: tuple[str, dict]):
        one = jobs.add_parser(name)
        for flag, options in arguments:
            one.add_argument(flag, **options)

    hour, path = ("--hour", {"type": _hour, "required": True}), ("--path", {"required": True})
    job("bootstrap")
    job("generate", path, ("--tickets", {"type": int, "default": 10_000}), ("--overwrite", {"action": "store_true"}))
    job("generate-events", path, ("--start", {"type": _hour, "required": True}), ("--batches", {"type": int, "default": 4}))
    job("ingest", path, ("--entity", {"required": True}))
    job("stream", path, ("--checkpoints", {"required": True}), ("--stream", {"default": "ticket_events"}), ("--late-minutes", {"type": int, "default": 60}))
    job("silver", ("--future-minutes", {"type": int, "default": 5}))
    for name in ("operations", "health", "incidents", "features", "backfill"):
        job(name, hour)
    job("training", *[(f"--{x}", {"type": _hour, "required": True}) for x in ("label-as-of", "train-end", "validation-end", "test-end")])
    job("train", ("--folder", {"required": True}))
    job("joins", ("--events", {"type": int, "default": 1_000_000}), ("--customers", {"type": int, "default": 1_000}))
    return top


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    from pyspark.sql import SparkSession

    from .operators import learning, skew
    from .plans import silver, snapshots
    from .sources import batch, generate
    from .sources.store import Store
    from .streaming import landing

    spark = SparkSession.builder.appName("tidewell").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    store, out = Store(spark, a.root), None
    if a.job == "bootstrap":
        out = silver.bootstrap(store)
    elif a.job == "generate":
        out = generate.write_dataset(spark, a.path, generate.Profile(tickets=a.tickets), a.overwrite)
    elif a.job == "generate-events":
        out = list(map(str, generate.write_batches(a.path, generate.Streamed(100, 6, a.start), a.batches)))
    elif a.job == "ingest":
        out = vars(batch.ingest(store, a.entity, a.path, a.run_id))
    elif a.job == "stream":
        out = landing.run_stream(store, a.path, a.checkpoints, a.run_id, a.stream, timedelta(minutes=a.late_minutes))
    elif a.job == "silver":
        out = silver.run_all(store, a.run_id, tolerance=timedelta(minutes=a.future_minutes))
    elif a.job in ("operations", "health", "incidents", "features", "backfill"):
        getattr(snapshots, f"build_{a.job}")(store, a.hour, a.run_id)
    elif a.job == "training":
        out = snapshots.build_training(store, a.run_id, a.label_as_of, a.train_end, a.validation_end, a.test_end)
    elif a.job == "train":
        out = learning.train(store.read("ml", "training_dataset"), a.folder, version=store.version("ml", "training_dataset"))
    else:
        rows = skew.benchmark(spark, a.run_id, a.events, a.customers)
        store.replace_snapshot(rows, "ops", "spark_performance_runs", "run_id", a.run_id)
        out = [r.asDict() for r in rows.select("strategy", "elapsed_seconds", "joined_count", "event_id_sum").collect()]
    print(json.dumps(out, default=str, indent=2))
