"""Publish a labelled CSV as JSON messages.

    spark-submit -m tallywind.plans.publishing --input posts.csv \\
        --servers broker:9092 --topic posts
"""

from __future__ import annotations

import argparse

from tallywind.session import build_session
from tallywind.sources.files import read_labelled_csv
from tallywind.sources.messages import publish, to_messages


def main() -> None:
    parser = argparse.ArgumentParser(description="Publish labelled texts as messages")
    parser.add_argument("--input", required=True)
    parser.add_argument("--servers")
    parser.add_argument("--topic")
    parser.add_argument("--folder", help="write message files here instead of to a broker")
    args = parser.parse_args()
    spark = build_session("tallywind-publishing")
    messages = to_messages(read_labelled_csv(spark, args.input))
    if args.folder:
        publish(messages, "parquet", path=args.folder)
    else:
        servers = {"kafka.bootstrap.servers": args.servers, "topic": args.topic}
        publish(messages, "kafka", **servers)


if __name__ == "__main__":
    main()
