"""Collect posts by keyword from nested records: flat table, CSV files, report.

    spark-submit -m tallywind.plans.collecting --posts posts.json --users users.json \\
        --user-order seen_at --keyword python --keyword "#data" --output /shared/collected
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallywind.operators.posts import collect_by_keywords, flatten_posts, scrub_lines
from tallywind.operators.report import collection_report, top_users, value_counts
from tallywind.schemas import POST, USER
from tallywind.session import build_session
from tallywind.sources.files import write_csv, write_csv_per_keyword, write_json


def collect(
    posts: DataFrame,
    users: DataFrame,
    user_order: str,
    keywords: Sequence[str],
    *,
    as_of: datetime,
    since: datetime | None = None,
    until: datetime | None = None,
    newest: int | None = None,
    salts: int = 8,
) -> DataFrame:
    """Flat posts of all keywords, with their keyword. The search comes first, so
    that only posts it found meet their authors."""
    found = collect_by_keywords(
        posts, keywords, as_of=as_of, since=since, until=until, newest=newest
    )
    return scrub_lines(
        flatten_posts(found, users, user_order, carry=("keyword",), salts=salts)
    )


def write_report(flat: DataFrame, path: str, as_of: datetime) -> None:
    """The report as JSON: one row of totals, and a file set per list of counts
    (a list may be as long as the data has values)."""
    write_json(collection_report(flat, as_of), f"{path}/summary")
    write_json(value_counts(flat, "language"), f"{path}/languages")
    write_json(top_users(flat), f"{path}/top_users")
    if "keyword" in flat.columns:
        write_json(value_counts(flat, "keyword"), f"{path}/top_keywords")


def main() -> None:
    parser = argparse.ArgumentParser(description="Collect posts by keyword")
    parser.add_argument("--posts", required=True)
    parser.add_argument("--users", required=True)
    parser.add_argument("--user-order", required=True, help="column that ranks repeated users")
    parser.add_argument("--user-order-type", default="timestamp", help="its type")
    parser.add_argument("--since", type=datetime.fromisoformat, help="default: seven days ago")
    parser.add_argument("--until", type=datetime.fromisoformat)
    parser.add_argument("--keyword", action="append", required=True)
    parser.add_argument("--newest", type=int)
    parser.add_argument("--output", required=True)
    args = parser.parse_args()
    spark = build_session("tallywind-collecting")
    as_of = datetime.now(timezone.utc)
    posts = spark.read.schema(POST).json(args.posts)
    ranked = T.StructType(USER.fields).add(args.user_order, args.user_order_type)
    users = spark.read.schema(ranked).json(args.users)
    # Written once; the summary, the files per keyword and the report read it back.
    table = f"{args.output}/posts"
    collect(
        posts,
        users,
        args.user_order,
        args.keyword,
        as_of=as_of,
        since=args.since,
        until=args.until,
        newest=args.newest,
    ).write.mode("overwrite").parquet(table)
    flat = spark.read.parquet(table)
    if flat.isEmpty():
        return
    write_csv(flat, f"{args.output}/summary_csv")
    write_csv_per_keyword(flat, f"{args.output}/keyword_csv")
    write_report(flat, f"{args.output}/report", as_of)


if __name__ == "__main__":
    main()
