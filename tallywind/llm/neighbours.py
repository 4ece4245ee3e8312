"""Approximate nearest neighbours by a robust-pruned directed graph per shard.

Rows are dealt to shards by the hash of their row number. A shard's task builds a graph
over its distinct vectors: each is inserted where a greedy search for it ends; of the
nodes the search met it keeps, nearest first, those that no kept one is nearer to by the
factor ALPHA (so edges point into all directions), and they link back under the same rule.
Every query is then searched in every shard by a beam, as a stream of rows behind the
shard's own, and the shards' best are ranked.

Nearness is the inner product. For building, each vector gets one more coordinate that
makes all of a shard equally long: then the largest inner product is the smallest
distance, and distances between vectors obey the triangle inequality that pruning needs.
Scores are inner products of the original vectors in double precision.

How it grows. There are sqrt(n) / SHARDING shards of n rows, so a shard's rows, which a
task holds, and the shards, to each of which every query goes, both grow by the square
root: a billion vectors are 2,300 shards of some 440,000.

Nulls: a row whose vector is null, empty, zero, or holds a null or non-finite entry takes
no part; where vectors differ in size only those of the commonest size do. A row with a
null id is no query, but may be found (last among ties). Rows are told apart by their
row, not by their id: rows that repeat an id are queries and candidates of their own, and
copies of a vector are candidates each. A table without such rows has no result rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallywind.llm.common import ready_for_python, written
from tallywind.llm.vectors import common_size, finite_vectors, matrix

#: Shards of n rows: sqrt(n) / SHARDING.
SHARDING = 14
#: Edges of a node after pruning, and the factor by which distances are relaxed.
DEGREE, ALPHA = 32, 1.2
#: Nodes a search keeps in view, when building and when asked.
BUILD_BEAM, SEARCH_BEAM = 64, 64
#: Searches that run side by side, and the bits of their marks at most.
AT_ONCE, MARKS = 512, 1 << 26


class Graph:
    """A directed graph over unit-length or equally long points (rows of `points`)."""

    def __init__(self, points: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA):
        self.points = points
        self.degree = degree
        self.alpha = alpha
        # Twice the degree: links back are added until there is no room, then pruned.
        self.edges = np.full((len(points), 2 * degree), -1, dtype=np.int32)
        self.fill = np.zeros(len(points), dtype=np.int32)
        near_mean = points @ points.mean(axis=0)
        self.entry = int(near_mean.argmax())
        self._build()
        self._reach_all()

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Per query the nodes in view when all of them have been visited, nearest first
        (-1 where there are fewer), and their inner products."""
        step = max(1, min(AT_ONCE, MARKS // len(self.points)))
        parts = [self._search(queries[i : i + step], beam) for i in range(0, len(queries), step)]
        return np.vstack([p[0] for p in parts]), np.vstack([p[1] for p in parts])

    def _search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        count = len(queries)
        ids = np.full((count, beam), -1, dtype=np.int32)
        near = np.full((count, beam), -np.inf, dtype=np.float32)
        visited = np.ones((count, beam), dtype=bool)
        met = np.zeros((count, len(self.points)), dtype=bool)
        ids[:, 0], visited[:, 0], met[:, self.entry] = self.entry, False, True
        near[:, 0] = queries @ self.points[self.entry]
        active = np.arange(count)
        while len(active):
            at = np.argmin(visited[active], axis=1)  # the nearest one not visited yet
            visited[active, at] = True
            around = self.edges[ids[active, at]]
            around = around[:, : max(1, self.fill[ids[active, at]].max())]
            new = (around >= 0) & ~met[active[:, None], around]
            rows, places = np.nonzero(new)
            nodes = around[rows, places]
            met[active[rows], nodes] = True
            found = np.full(around.shape, -np.inf, dtype=np.float32)
            found[rows, places] = np.einsum(
                "ij,ij->i", self.points[nodes], queries[active[rows]]
            )
            all_near = np.hstack([near[active], found])
            all_ids = np.hstack([ids[active], np.where(new, around, -1)])
            all_visited = np.hstack([visited[active], ~new])
            order = np.argsort(-all_near, axis=1, kind="stable")[:, :beam]
            near[active] = np.take_along_axis(all_near, order, axis=1)
            ids[active] = np.take_along_axis(all_ids, order, axis=1)
            visited[active] = np.take_along_axis(all_visited, order, axis=1)
            active = active[~visited[active].all(axis=1)]
        return ids, near

    def _pruned(self, nodes: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """Per node up to `degree` of its candidates (-1: none; repeats allowed), nearest
        first; one goes if a kept one is nearer to it than the node, by the factor."""
        points = self.points[candidates]
        own = 1 - np.einsum("bcd,bd->bc", points, self.points[nodes])  # half squared distances
        alive = (candidates >= 0) & (candidates != nodes[:, None])
        own[~alive] = np.inf
        order = np.argsort(own, axis=1, kind="stable")
        own = np.take_along_axis(own, order, axis=1)
        candidates = np.take_along_axis(candidates, order, axis=1)
        alive = np.take_along_axis(alive, order, axis=1)
        points = np.take_along_axis(points, order[:, :, None], axis=1)
        between = 1 - points @ points.transpose(0, 2, 1)
        relaxed = self.alpha * self.alpha
        kept = np.full((len(nodes), self.degree), -1, dtype=np.int32)
        rows = np.arange(len(nodes))
        for place in range(self.degree):
            if not alive.any():
                break
            first = np.argmax(alive, axis=1)
            has = alive[rows, first]
            kept[has, place] = candidates[rows, first][has]
            to_kept = between[rows, first]
            alive &= ~((relaxed * to_kept <= own) & has[:, None])
            alive[rows, first] = False
            alive &= candidates != np.where(has, candidates[rows, first], -2)[:, None]
        return kept

    def _set(self, nodes: np.ndarray, kept: np.ndarray) -> None:
        self.edges[nodes] = -1
        self.edges[nodes, : kept.shape[1]] = kept
        self.fill[nodes] = (kept >= 0).sum(axis=1)

    def _link_back(self, sources: np.ndarray, kept: np.ndarray) -> None:
        """Edges from the kept nodes to the sources; what no longer fits is pruned."""
        rows, places = np.nonzero(kept >= 0)
        ends, starts = kept[rows, places], sources[rows]
        order = np.argsort(ends, kind="stable")
        ends, starts = ends[order], starts[order]
        nodes, first, counts = np.unique(ends, return_index=True, return_counts=True)
        room = self.edges.shape[1] - self.fill[nodes]
        rank = np.arange(len(ends)) - np.repeat(first, counts)
        fits = np.repeat(counts <= room, counts)
        self.edges[ends[fits], self.fill[ends[fits]] + rank[fits]] = starts[fits]
        self.fill[nodes[counts <= room]] += counts[counts <= room]
        full = np.flatnonzero(counts > room)
        full = full[np.argsort(counts[full], kind="stable")]  # alike ones side by side
        step = 128
        for i in range(0, len(full), step):
            some = full[i : i + step]
            width = int(counts[some].max())
            added = np.full((len(some), width), -1, dtype=np.int32)
            for row, k in enumerate(some):
                added[row, : counts[k]] = starts[first[k] : first[k] + counts[k]]
            own = nodes[some]
            self._set(own, self._pruned(own, np.hstack([self.edges[own], added])))

    def _build(self) -> None:
        order = np.random.default_rng(len(self.points)).permutation(len(self.points))
        order = order[order != self.entry].astype(np.int32)
        done = 0
        while done < len(order):
            batch = order[done : done + min(AT_ONCE, done + 1)]
            found, _ = self.search(self.points[batch], BUILD_BEAM)
            kept = self._pruned(batch, found)
            self._set(batch, kept)
            self._link_back(batch, kept)
            done += len(batch)

    def _reached(self) -> np.ndarray:
        reached = np.zeros(len(self.points), dtype=bool)
        front = np.array([self.entry])
        while len(front):
            reached[front] = True
            front = np.unique(self.edges[front])
            front = front[(front >= 0) & ~reached[front]]
        return reached

    def _reach_all(self) -> None:
        """Pruning may cut a node off: link it from the nearest one with room."""
        while not (reached := self._reached()).all():
            lost = np.flatnonzero(~reached)
            found, _ = self.search(self.points[lost], BUILD_BEAM)
            if (self.fill[found[found >= 0]] == self.edges.shape[1]).all():
                more = np.full((len(self.edges), self.degree), -1, dtype=np.int32)
                self.edges = np.hstack([self.edges, more])
            for node, near in zip(lost, found):
                for start in near[near >= 0]:
                    if self.fill[start] < self.edges.shape[1]:
                        self.edges[start, self.fill[start]] = node
                        self.fill[start] += 1
                        break


class Shard:
    """The rows of a shard: distinct vectors as nodes, and the rows of each node."""

    def __init__(self, vectors: np.ndarray, ids: pa.Array, rows: np.ndarray, most: int):
        """Of a vector's rows only the first `most`, as ties are broken, can ever be
        among the results."""
        null = np.asarray(ids.is_null())
        order = np.lexsort((rows, ids.fill_null(0).to_numpy(zero_copy_only=False), null))
        vectors, self.rows, self.ids = vectors[order], rows[order], ids.take(pa.array(order))
        self.vectors, node = np.unique(vectors, axis=0, return_inverse=True)
        node = node.ravel()
        order = np.argsort(node, kind="stable")
        first = np.searchsorted(node[order], np.arange(len(self.vectors)))
        rank = np.arange(len(order)) - first[node[order]]
        order = order[rank < most]
        self.order = order  # positions of rows, by node and then as ties are broken
        self.counts = np.bincount(node[order], minlength=len(self.vectors))
        self.first = np.cumsum(self.counts) - self.counts
        lengths = np.einsum("ij,ij->i", self.vectors, self.vectors)
        longest = lengths.max()
        rest = np.sqrt(np.maximum(longest - lengths, 0))
        scaled = np.hstack([self.vectors, rest[:, None]]) / math.sqrt(longest)
        self.graph = Graph(np.ascontiguousarray(scaled, dtype=np.float32))

    def best(
        self, queries: np.ndarray, own_rows: np.ndarray, most: int, beam: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, position of a row, score) of each query's best rows but its own."""
        asked = np.hstack([queries, np.zeros((len(queries), 1))]).astype(np.float32)
        nodes, _ = self.graph.search(asked, beam)
        query, place = np.nonzero(nodes >= 0)
        node = nodes[query, place]
        # Summed row by row, so that equal vectors have equal scores.
        score = (self.vectors[node] * queries[query]).sum(axis=1)
        counts = self.counts[node]
        offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        position = self.order[np.repeat(self.first[node], counts) + offset]
        query, score = np.repeat(query, counts), np.repeat(score, counts)
        other = self.rows[position] != own_rows[query]
        query, score, position = query[other], score[other], position[other]
        order = np.lexsort((position, -score, query))
        query, score, position = query[order], score[order], position[order]
        start = np.searchsorted(query, np.arange(len(queries)))
        kept = np.arange(len(query)) - start[query] < most
        return query[kept], position[kept], score[kept]


_ROW = T.StructType(
    [
        T.StructField("shard", T.IntegerType()),
        T.StructField("asks", T.BooleanType()),
        T.StructField("row", T.LongType()),
        T.StructField("vec_id", T.LongType()),
        T.StructField("vec", T.ArrayType(T.DoubleType())),
    ]
)
_FOUND = T.StructType(
    [
        T.StructField("query_row", T.LongType()),
        T.StructField("query_id", T.LongType()),
        T.StructField("row", T.LongType()),
        T.StructField("vec_id", T.LongType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def _searched(
    batches: Iterator[pa.RecordBatch], most: int, beam: int
) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard, a shard's own rows before its queries; of each shard only
    its own rows are held."""
    schema = to_arrow_schema(_FOUND)
    number, held, shard = None, [], None

    def opened() -> Shard:
        vectors = np.vstack([matrix(part.column("vec")) for part in held])
        ids = pa.concat_arrays([part.column("vec_id") for part in held])
        rows = np.concatenate([part.column("row").to_numpy() for part in held])
        return Shard(vectors, ids, rows, most + 1)

    for batch in batches:
        numbers = batch.column("shard").to_numpy()
        asks = batch.column("asks").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.diff(numbers * 2 + asks)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            if a == b:
                continue
            part = batch.slice(a, b - a)
            if numbers[a] != number:
                number, held, shard = numbers[a], [], None
            if not asks[a]:
                held.append(part)
                continue
            if not held:
                continue
            if shard is None:
                shard = opened()
            query, position, score = shard.best(
                matrix(part.column("vec")), part.column("row").to_numpy(), most, beam
            )
            taken = pa.array(query)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("row").take(taken),
                    part.column("vec_id").take(taken),
                    pa.array(shard.rows[position]),
                    shard.ids.take(pa.array(position)),
                    pa.array(score),
                ],
                schema=schema,
            )


def shards_of(rows: int) -> int:
    return max(1, math.ceil(math.sqrt(rows) / SHARDING))


def nearest(
    df: DataFrame,
    every: int = 20,
    most: int = 20,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    beam: int = SEARCH_BEAM,
) -> DataFrame:
    """The `most` rows found nearest to each row whose id is divisible by `every`:
    `query_id, rank, vec_id, score`, ties by the smaller id."""
    spark = df.sparkSession
    ready_for_python(df)
    fit = finite_vectors(df, vec_id, embedding).where(F.exists("vec", lambda c: c != 0))
    rows = written(
        fit.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("vec_id").cast("long").alias("vec_id"),
            "vec",
        ),
        "vectors",
    )
    alike = rows.where(F.size("vec") == common_size(rows))
    shards = shards_of(alike.count())
    own = alike.withColumns(
        {"shard": F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"), "asks": F.lit(False)}
    )
    asked = alike.where(F.col("vec_id") % every == 0).withColumns(
        {
            "shard": F.explode(F.sequence(F.lit(0), F.lit(shards - 1))),
            "asks": F.lit(True),
        }
    )
    both = own.select(*_ROW.names).unionByName(asked.select(*_ROW.names))
    dealt = both.repartitionById(shards, "shard").sortWithinPartitions("shard", "asks")
    found = dealt.mapInArrow(lambda b: _searched(b, most, beam), _FOUND)
    order = Window.partitionBy("query_row").orderBy(
        F.desc("score"), F.asc_nulls_last("vec_id"), "row"
    )
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return ranked.select("query_id", "rank", "vec_id", "score")
