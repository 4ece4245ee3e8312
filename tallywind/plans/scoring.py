"""The streaming job: messages to scored posts to windowed results.

    spark-submit -m tallywind.plans.scoring --servers broker:9092 --topic posts \\
        --model /shared/model --output /shared/sentiment
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallywind.operators.windows import WATERMARK_BY_WIDTH, windowed_sentiment
from tallywind.plans.training import SentimentModel
from tallywind.schemas import SCORED_POST
from tallywind.session import ObjectStore, build_session
from tallywind.sources.messages import kafka_options, kafka_stream, ready_to_score
from tallywind.streaming.archive import archive_stream, start_archive
from tallywind.streaming.results import start_upsert


def score_messages(envelopes: DataFrame, model: SentimentModel) -> DataFrame:
    """Messages (batch or stream) to scored posts."""
    return model.score(ready_to_score(envelopes)).select(*SCORED_POST.names)


def archive_path(root: str) -> str:
    return f"{root}/archive"


def results_path(root: str, width: str) -> str:
    return f"{root}/results_{width.replace(' ', '_')}"


def _checkpoint(root: str, query: str) -> str:
    return f"{root}/checkpoints/{query}"


def start_windows(
    scored: DataFrame, root: str, *, available_now: bool = False, trigger: str | None = None
) -> list[StreamingQuery]:
    """One upsert query per window width."""
    started = []
    for width, watermark in WATERMARK_BY_WIDTH.items():
        name = f"results_{width.replace(' ', '_')}"
        started.append(
            start_upsert(
                windowed_sentiment(scored, width, watermark=watermark),
                results_path(root, width),
                _checkpoint(root, name),
                available_now=available_now,
                trigger=trigger,
            )
        )
    return started


def start_direct(
    scored: DataFrame, root: str, *, available_now: bool = False
) -> list[StreamingQuery]:
    """Archive and windows side by side; each of them reads and scores the source."""
    archive = start_archive(
        scored, archive_path(root), _checkpoint(root, "archive"), available_now=available_now
    )
    return [archive, *start_windows(scored, root, available_now=available_now)]


def start_from_archive(
    scored: DataFrame,
    root: str,
    max_files_per_trigger: int | None = None,
    trigger: str | None = None,
    tasks_per_date: int | None = None,
) -> list[StreamingQuery]:
    """Score once into the archive, and aggregate the archive as it grows. A bound
    on the files of a batch keeps the windows' catch-up to a size that fits."""
    path = archive_path(root)
    archive = start_archive(
        scored,
        path,
        _checkpoint(root, "archive"),
        trigger=trigger,
        tasks_per_date=tasks_per_date,
    )
    posts = archive_stream(
        scored.sparkSession, path, max_files_per_trigger=max_files_per_trigger
    )
    return [archive, *start_windows(posts, root, trigger=trigger)]


def run_from_archive(scored: DataFrame, root: str) -> None:
    """The same for what is available now, one step after the other."""
    archive = start_archive(
        scored, archive_path(root), _checkpoint(root, "archive"), available_now=True
    )
    archive.awaitTermination()
    posts = archive_stream(scored.sparkSession, archive_path(root))
    for query in start_windows(posts, root, available_now=True):
        query.awaitTermination()


def run(
    spark: SparkSession,
    options: dict[str, str],
    model_path: str,
    root: str,
    max_files_per_trigger: int | None = None,
    trigger: str | None = None,
    tasks_per_date: int | None = None,
) -> None:
    """Run until one of the queries ends."""
    model = SentimentModel.load(model_path)
    scored = score_messages(kafka_stream(spark, options), model)
    start_from_archive(scored, root, max_files_per_trigger, trigger, tasks_per_date)
    spark.streams.awaitAnyTermination()


def main() -> None:
    parser = argparse.ArgumentParser(description="Score a message stream")
    parser.add_argument("--servers", required=True)
    parser.add_argument("--topic", required=True)
    parser.add_argument("--starting", default="latest")
    parser.add_argument("--max-offsets-per-trigger", type=int)
    parser.add_argument("--max-files-per-trigger", type=int)
    parser.add_argument("--trigger", help="time between batches, e.g. '1 minute'")
    parser.add_argument("--tasks-per-date", type=int, help="files of a date and batch")
    parser.add_argument("--model", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--shuffle-partitions", type=int)
    parser.add_argument("--store-endpoint")
    parser.add_argument("--store-access-key-env")
    parser.add_argument("--store-secret-key-env")
    args = parser.parse_args()
    store = None
    if args.store_endpoint:
        store = ObjectStore(
            args.store_endpoint, args.store_access_key_env, args.store_secret_key_env
        )
    spark = build_session(
        "tallywind-scoring",
        shuffle_partitions=args.shuffle_partitions,
        object_store=store,
    )
    options = kafka_options(
        args.servers,
        args.topic,
        starting=args.starting,
        max_offsets_per_trigger=args.max_offsets_per_trigger,
    )
    run(
        spark,
        options,
        args.model,
        args.output,
        args.max_files_per_trigger,
        args.trigger,
        args.tasks_per_date,
    )


if __name__ == "__main__":
    main()
