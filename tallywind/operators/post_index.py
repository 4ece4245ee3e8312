"""A substring index of stored posts: which files can hold a text at all."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywind.operators.posts import search_posts

#: Letters of a piece, and bits of a file's signature. A bit map of Spark has 32,768
#: positions, so a signature is a row per map.
PIECE = 4
BITS = 1 << 18


def _pieces(text: Column) -> Column:
    """All pieces of a lower-cased text, overlapping ones too."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"(?s)(?=(.{{{PIECE}}}))"), F.lit(1))


def _position(piece: Column) -> Column:
    return F.pmod(F.xxhash64(piece), F.lit(BITS))


def build_index(spark: SparkSession, posts_path: str, index_path: str) -> None:
    """Write the signatures of the files of a Parquet folder of posts: `file`, the number
    of a bit map and the map. A task sends a map per file and number, whatever its texts."""
    pieces = spark.read.parquet(posts_path).select(
        F.col("_metadata.file_path").alias("file"),
        F.explode(F.array_distinct(_pieces(F.col("text")))).alias("piece"),
    )
    at = _position(F.col("piece"))
    maps = pieces.groupBy("file", F.bitmap_bucket_number(at).alias("number")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")
    )
    maps.write.mode("overwrite").parquet(index_path)


def candidate_files(spark: SparkSession, index_path: str, keyword: str) -> list[str] | None:
    """The files that may hold the keyword: all of its pieces' bits are set. None if the
    keyword is too short to have a piece, and any file may."""
    asked = spark.range(1).select(F.explode(F.array_distinct(_pieces(F.lit(keyword)))).alias("p"))
    at = _position(F.col("p"))
    bits = asked.select(
        F.bitmap_bucket_number(at).alias("number"), F.bitmap_bit_position(at).alias("bit")
    ).distinct()
    needed = bits.count()
    if not needed:
        return None
    byte = F.conv(F.hex(F.expr("substring(bits, int(bit div 8) + 1, 1)")), 16, 10).cast("int")
    is_set = F.expr("getbit(byte, int(bit % 8))") == 1
    found = spark.read.parquet(index_path).join(F.broadcast(bits), "number")
    found = found.withColumn("byte", byte).where(is_set).groupBy("file").count()
    return sorted(r["file"] for r in found.where(F.col("count") == needed).collect())


def search_stored(
    spark: SparkSession,
    posts_path: str,
    index_path: str,
    keyword: str,
    *,
    as_of: datetime,
    since: datetime | None = None,
    until: datetime | None = None,
    newest: int | None = None,
) -> DataFrame:
    """What `search_posts` finds in the stored posts, opening only files whose signature
    allows it; what they hold is compared exactly."""
    posts = spark.read.parquet(posts_path)
    files = candidate_files(spark, index_path, keyword)
    if files is not None:
        schema = posts.schema
        posts = spark.read.schema(schema).parquet(*files) if files else posts.limit(0)
    return search_posts(posts, keyword, as_of=as_of, since=since, until=until, newest=newest)
