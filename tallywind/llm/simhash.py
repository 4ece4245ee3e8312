"""Near-duplicates by SimHash fingerprints, found through pivot distance tables.

Every distinct fingerprint gets a table of its Hamming distances to reference
fingerprints (pivots). By the triangle inequality, two fingerprints at most `radius`
bits apart differ by at most `radius` in every coordinate, so pairs beyond that in
any coordinate are discarded before the exact distance is looked at.

Two kinds of pivots are used. The zero fingerprint and 32 fingerprints of two
neighbouring bits each: from them follows how many of its two bits a fingerprint has
of each, and `radius` changed bits leave all but `radius` of these 32 coordinates as
they are. Fingerprints therefore meet under keys made of coordinates: the 32 fall
into radius + 3 groups, of which at least three agree, so one key per choice of
three groups finds every link. And dense pseudo-random pivots, whose distances
discard unrelated pairs that share a key.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywind.llm.common import ready_for_python, whole_text, written
from tallywind.llm.components import components

#: Words of a shingle, and the most differing bits of a link.
SHINGLE, RADIUS = 3, 2
HASH_SEED = 42
#: Dense pivots: bit patterns from a fixed generator.
DENSE_PIVOTS = 24
#: Fingerprints that meet under one key; fuller cells are linked by `near_points`.
CELL = 32

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
_CHUNK = 1 << 16


def simhash(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text: a bit is set if over half of the
    shingles' hashes have it, repeats included. No word: zero."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), HASH_SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - shingle + 1
    del words
    starts, ends = starts[:n].tolist(), ends[shingle - 1 :].tolist()
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _CHUNK):
        hashes = np.array(
            [digest(joined[s:e], HASH_SEED) for s, e in zip(starts[at : at + _CHUNK], ends[at : at + _CHUNK])],
            np.uint64,
        )
        planes = hashes.view(np.uint8).reshape(-1, 8)
        for k in range(8):
            counts[8 * k : 8 * k + 8] += np.bincount(planes[:, k], minlength=256) @ _BYTE_BITS
    bits = (2 * counts > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint of a text as a signed long, text by text in Arrow batches."""

    @F.pandas_udf("long")
    def fingerprints(texts: pd.Series) -> pd.Series:
        found = np.fromiter((simhash(t, shingle) for t in texts), np.uint64, len(texts))
        return pd.Series(found.view(np.int64))

    return fingerprints(text)


def as_hex(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def pair_pivots() -> list[int]:
    """Fingerprints of two neighbouring bits."""
    return [_signed(3 << (2 * k)) for k in range(32)]


def dense_pivots(count: int = DENSE_PIVOTS) -> list[int]:
    return [_signed(xxhash.xxh64_intdigest(f"pivot {k}", HASH_SEED)) for k in range(count)]


def pivot_table(points: DataFrame, dense: int = DENSE_PIVOTS) -> DataFrame:
    """`fp, profile, dense`: the distances of each fingerprint to all pivots, those
    to the pair pivots as the string of the 32 coordinates they amount to."""
    fp = F.col("fp")
    to_zero = F.bit_count(fp)
    # d(fp, pivot) = d(fp, 0) + 2 - 2 * (bits of the pivot that fp has)
    shared = [
        ((to_zero + F.lit(2) - distance(fp, F.lit(p))) / 2).cast("int").cast("string")
        for p in pair_pivots()
    ]
    return points.select(
        "fp",
        F.concat(*shared).alias("profile"),
        F.array(*[distance(fp, F.lit(p)).cast("byte") for p in dense_pivots(dense)]).alias("dense"),
    )


def cell_keys(radius: int = RADIUS) -> Column:
    """One key per choice of three of the radius + 3 groups of coordinates: the
    distances to the pivots of these groups."""
    groups = radius + 3
    edges = [32 * g // groups for g in range(groups + 1)]
    parts = [
        F.substring("profile", edges[g] + 1, edges[g + 1] - edges[g]) for g in range(groups)
    ]
    return F.array(
        *[
            F.xxhash64(F.lit(k), *[parts[g] for g in chosen])
            for k, chosen in enumerate(combinations(range(groups), 3))
        ]
    )


def near_points(points: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links of fingerprints by shared points: all points within half the radius of
    a fingerprint are listed, and fingerprints that list the same point are linked
    to the smallest of them. For an even radius a link lists a common point, and two
    that list one are linked, so this is exact, and linear however close the
    fingerprints lie. For an odd radius callers use the next even one and verify."""
    if radius != 2:
        raise ValueError("full cells are linked for a radius of 2 only")
    fp = F.col("fp")
    flips = F.array(fp, *[fp.bitwiseXOR(F.lit(_signed(1 << k))) for k in range(64)])
    listed = points.select("fp", F.explode(flips).alias("point"))
    least = listed.groupBy("point").agg(F.min("fp").alias("b"), F.count("*").alias("n"))
    return (
        listed.join(least.where("n > 1"), "point")
        .where("fp <> b")
        .select(F.col("fp").alias("a"), "b")
        .distinct()
    )


def links(points: DataFrame, radius: int = RADIUS, cell: int = CELL) -> DataFrame:
    """Edges `a, b` that connect what links of at most `radius` bits connect.

    `points` has distinct fingerprints `fp`. Cells of at most `cell` fingerprints are
    searched pair by pair: the join itself discards by the largest coordinate
    difference and by the exact distance. The members of fuller cells, which lie
    close together, go through `near_points` instead, so no cell is ever paired
    quadratically and no link is lost.
    """
    keyed = written(
        pivot_table(points).select("fp", "dense", F.explode(cell_keys(radius)).alias("cell")),
        "cells",
    )
    filled = keyed.groupBy("cell").agg(F.count("*").alias("members")).where("members > 1")
    shared = written(keyed.join(filled, "cell"), "shared")
    small = shared.where(F.col("members") <= cell)
    a, b = small.alias("a"), small.select("cell", "fp", "dense").alias("b")
    furthest = F.array_max(
        F.zip_with("a.dense", "b.dense", lambda x, y: F.abs(x.cast("int") - y.cast("int")))
    )
    verified = distance(F.col("a.fp"), F.col("b.fp")) <= radius
    pairs = (
        a.join(
            b,
            (F.col("a.cell") == F.col("b.cell"))
            & (F.col("a.fp") < F.col("b.fp"))
            & (furthest <= radius)
            & verified,
        )
        .select(F.col("b.fp").alias("a"), F.col("a.fp").alias("b"))
        .distinct()
    )
    crowded = shared.where(F.col("members") > cell).select("fp").distinct()
    return pairs.unionByName(near_points(crowded, radius))


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
) -> DataFrame:
    """`doc_id, fp, component_id` for every row: the fingerprint as a long, and the
    smallest id of the documents that links of at most `radius` bits reach.

    A null text is an empty one, with fingerprint zero, and links like any other.
    Equal fingerprints meet first, so a group of copies is one point of the search,
    however large. Repeated rows are returned as often as they come. A row without
    an id belongs to its component, whose id is null only if no member has one.
    """
    return _classes(docs, doc_id, text, shingle, radius).select("doc_id", "fp", "component_id")


def _classes(
    docs: DataFrame, doc_id: str, text: str, shingle: int, radius: int, row: str | None = None
) -> DataFrame:
    """`doc_id, row, fp, component, component_id`: component is a fingerprint that names
    the component, and row a column that numbers the rows, if there is one."""
    ready_for_python(docs)
    marked = written(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            (F.lit(None) if row is None else F.col(row)).cast("long").alias("row"),
            fingerprint_column(whole_text(text), shingle).alias("fp"),
        ),
        "fingerprints",
    )
    points = marked.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    found = components(links(points.select("fp"), radius), "simhash")
    classes = written(
        points.join(found, F.col("fp") == F.col("node"), "left").select(
            "fp", "first_id", F.coalesce("component", "fp").alias("component")
        ),
        "classes",
    )
    least = classes.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = classes.join(least, "component").select(
        F.col("fp").alias("class_fp"), "component", "component_id"
    )
    return marked.join(named, F.col("fp") == F.col("class_fp")).drop("class_fp")


def keep_one(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
) -> DataFrame:
    """One row of each component: of the rows with its smallest id the first. A row
    without an id is kept only where no row of the component has one. Ids that repeat or
    are missing decide nothing else: rows are told apart by their number."""
    row = "row"
    while row in docs.columns:
        row += "_"
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = _classes(numbered, doc_id, text, shingle, radius, row)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    first = found.groupBy("component").agg(F.min(order).alias("first"))
    kept = first.select(F.col("first.row").alias("kept_row"))
    return numbered.join(kept, F.col(row) == F.col("kept_row"), "left_semi").drop(row)
