"""Judge URLs by rules and by a block list behind a blocked Bloom filter.

The filter is one 64-bit block per row. A listed URL sets four bits of the block
its hash picks; a URL whose four bits are set may be listed, and only those go to
the exact join with the list, which removes false positives.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywind.llm.common import ascii_lower, bounded_broadcast, whole_text, written

#: Bits of filter for each listed URL.
BITS_PER_URL = 16
#: Up to so many blocks (16 bytes each) the filter is broadcast, else it is joined.
BROADCAST_BLOCKS = 2_000_000


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)


def host_of(url: Column) -> Column:
    """What stands between the first `://` and the next `/ ? #`, A-Z lower-cased."""
    return ascii_lower(F.regexp_extract(whole_text(url), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(whole_text(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def query_of(url: Column) -> Column:
    return F.regexp_extract(whole_text(url), r"(?s)^.*?://[^?#]*\?([^#]*)", 1)


def canonical(url: Column) -> Column:
    """Host without `www.`, path without a closing slash, and the query without
    tracking parameters. Null where a URL has no host."""
    host, path = host_of(url), path_of(url)
    query = F.regexp_replace(
        F.regexp_replace(query_of(url), r"(^|&)utm_[^&]*", ""), "^&", ""
    )
    key = F.concat(
        F.regexp_replace(host, r"^www\.", ""),
        F.regexp_replace(path, "/$", ""),
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""),
    )
    return F.when(host != "", key)


def rule_columns(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; both null if none does.
    The rules are a short literal list, compiled into one expression."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def block_and_bits(key: Column, blocks: int) -> tuple[Column, Column]:
    """The block of a key, and its four bits in the block, from one 64-bit hash."""
    h = F.xxhash64(key)
    block = F.pmod(F.shiftrightunsigned(h, 24), F.lit(blocks)).cast("long")
    bits = F.lit(0).cast("long")
    for k in range(4):
        place = F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return block, bits


def bloom_filter(listed: DataFrame, blocks: int, key: str = "key") -> DataFrame:
    """`block, bits`: one row for each block that has bits, at most `blocks` rows.
    Bits of a block are combined by each task before the shuffle."""
    block, bits = block_and_bits(F.col(key), blocks)
    return (
        listed.select(block.alias("block"), bits.alias("bits"))
        .groupBy("block")
        .agg(F.bit_or("bits").alias("bits"))
    )


def judge(
    pages: DataFrame,
    listed: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """`page_id, host, path, rule, verdict, listed` for every row of the pages.

    `listed` has one column of canonical URLs, in any number, repeats and nulls
    allowed. A URL without `://`, or null, has an empty host and path, fits no rule
    and is never listed: it is allowed. Repeated rows are judged alike; an empty
    list blocks nothing.
    """
    keys = written(
        listed.select(F.col(listed.columns[0]).alias("key")).where("key is not null").distinct(),
        "listed",
    )
    count = keys.count()
    blocks = max(1, -(-count * BITS_PER_URL // 64))
    filled = bloom_filter(keys, blocks).withColumnsRenamed({"block": "of_block", "bits": "set_bits"})
    link = F.col(url)
    host, path = host_of(link), path_of(link)
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    parts = pages.select(
        F.col(page_id).alias("page_id"),
        host.alias("host"),
        path.alias("path"),
        canonical(link).alias("key"),
    ).select("*", rule.alias("rule"), verdict.alias("ruled"))
    block, bits = block_and_bits(F.col("key"), blocks)
    probed = (
        parts.withColumns({"block": block, "bits": bits})
        .join(
            bounded_broadcast(filled, blocks, BROADCAST_BLOCKS),
            (F.col("block") == F.col("of_block")) & F.col("key").isNotNull(),
            "left",
        )
        .withColumn(
            "possible", F.coalesce(F.col("set_bits").bitwiseAND(F.col("bits")) == F.col("bits"), F.lit(False))
        )
        .select("page_id", "host", "path", "key", "rule", "ruled", "possible")
    )
    # Two branches: rows that miss the filter take no part in the exact join.
    missed = probed.where(~F.col("possible")).withColumn("listed", F.lit(False))
    exact = keys.select(F.col("key").alias("listed_key"))
    hits = (
        probed.where("possible")
        .join(exact.hint("shuffle_hash"), F.col("key") == F.col("listed_key"), "left")
        .withColumn("listed", F.col("listed_key").isNotNull())
        .drop("listed_key")
    )
    return missed.unionByName(hits).select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruled", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
        "listed",
    )


def tracked_urls(pages: DataFrame, url: str = "url") -> DataFrame:
    """A block list taken from the pages themselves: the canonical form of every
    URL that was reached through a tracking link. Other ways to write the same
    address are then blocked with it."""
    link = F.col(url)
    return pages.where(query_of(link).rlike(r"(^|&)utm_")).select(canonical(link).alias("key"))
