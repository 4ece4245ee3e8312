import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from tallywind.llm import neighbours, queries
from tallywind.llm.neighbours import Graph, Shard

VECTORS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        # names that the operator uses inside
        T.StructField("row", T.StringType()),
        T.StructField("shard", T.LongType()),
        T.StructField("score", T.DoubleType()),
    ]
)
RESULT = ["query_id", "rank", "vec_id", "score"]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2.0) for r in rows], VECTORS)


def points(n, size, seed=0):
    found = np.random.default_rng(seed).normal(size=(n, size))
    return (found / np.linalg.norm(found, axis=1)[:, None]).astype(np.float32)


def exact(rows, every=20, most=20):
    """(query_id, rank, vec_id, score) of every query by trying all rows."""
    rows = [(i, np.array(v, dtype=float)) for i, v in rows]
    found = []
    for place, (query, vector) in enumerate(rows):
        if query is None or query % every:
            continue
        others = [
            (-float((vector * v).sum()), i is None, i or 0, i)
            for at, (i, v) in enumerate(rows)
            if at != place
        ]
        for rank, (score, _, _, i) in enumerate(sorted(others)[:most], 1):
            found.append((query, rank, i, -score))
    return found


def rounded(rows):
    return sorted(((q, r, i, round(s, 9)) for q, r, i, s in rows), key=repr)


def test_query_against_brute_force(spark, tables):
    table = queries.table(spark, tables, "embeddings").collect()
    rows = [(r["vec_id"], r["embedding"]) for r in table]
    wanted = exact(rows)
    df = queries.op12_neighbours(spark, tables)
    assert df.columns == RESULT
    got = [tuple(r) for r in df.collect()]
    assert [(q, r) for q, r, _, _ in sorted(got)] == [(q, r) for q, r, _, _ in sorted(wanted)]
    pairs = {(q, i) for q, _, i, _ in wanted}
    assert len(pairs & {(q, i) for q, _, i, _ in got}) >= 0.95 * len(pairs)
    vectors = {i: np.array(v, dtype=float) for i, v in rows}
    assert all(s == pytest.approx(vectors[q] @ vectors[i], abs=1e-12) for q, _, i, s in got)


def test_recall_over_many_shards(spark):
    vectors = points(3000, 24)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    assert neighbours.shards_of(3000) > 2
    got = {(r["query_id"], r["vec_id"]) for r in neighbours.nearest(frame(spark, rows)).collect()}
    wanted = {(q, i) for q, _, i, _ in exact(rows)}
    assert len(got & wanted) >= 0.95 * len(wanted)


def test_lengths_count(spark):
    dice = random.Random(4)
    rows = [
        (i, [float(np.float32(dice.gauss(0, 1) * 3 ** (i % 5))) for _ in range(6)])
        for i in range(300)
    ]
    got = [tuple(r) for r in neighbours.nearest(frame(spark, rows)).collect()]
    wanted = {(q, i) for q, _, i, _ in exact(rows)}
    assert len(wanted & {(q, i) for q, _, i, _ in got}) >= 0.95 * len(wanted)


def test_odd_rows(spark):
    good = [
        (0, [1.0, 0.0]),
        (20, [0.5, 0.5]),
        (7, [0.0, -2.0]),
        (None, [2.0, 1.0]),
        (-20, [3.0, 0.0]),
    ]
    bad = [
        (40, None),
        (60, []),
        (80, [0.0, 0.0]),
        (100, [1.0, None]),
        (120, [1.0, float("nan")]),
        (140, [float("inf"), 1.0]),
        (160, [1.0, 2.0, 3.0]),
    ]
    got = neighbours.nearest(frame(spark, good + bad))
    assert rounded(tuple(r) for r in got.collect()) == rounded(exact(good))


def test_copies_tie_by_id_and_repeated_ids_are_rows(spark):
    dice = random.Random(2)
    rows = [(dice.choice([*range(0, 90), None]), [1.0, 2.0]) for _ in range(200)]
    rows += [(i, [float(i % 7), 1.0]) for i in range(100, 160)]
    rows += [(20, [1.0, 2.0])] * 2
    got = neighbours.nearest(frame(spark, rows))
    assert rounded(tuple(r) for r in got.collect()) == rounded(exact(rows))


@pytest.mark.parametrize("rows", [[], [(20, None)], [(20, [1.0])], [(3, [1.0]), (4, [2.0])]])
def test_nothing_to_find(spark, rows):
    got = neighbours.nearest(frame(spark, rows))
    assert got.columns == RESULT and got.count() == 0


def test_every_node_is_reached_and_pruning_keeps_diverse_edges():
    line = np.linspace(0, 1, 300)[:, None]
    for vectors in (points(500, 8), points(40, 3), np.hstack([np.cos(line), np.sin(line)])):
        graph = Graph(np.ascontiguousarray(vectors, dtype=np.float32), degree=4)
        assert graph._reached().all()
        ids, near = graph.search(graph.points[:5], len(vectors))
        assert all(set(row) == set(range(len(vectors))) for row in ids)
        assert (np.diff(near, axis=1) <= 0).all()
    chosen = graph._pruned(np.array([150]), np.array([[149, 148, 151, 152, 10, 150, -1, 149]]))
    assert set(chosen[0].tolist()[:2]) == {149, 151}
    assert 148 not in chosen and 152 not in chosen


def test_a_shard_finds_its_best():
    vectors = points(800, 16, 3).astype(float)
    shard = Shard(vectors, pa.array(range(800)), np.arange(800), 21)
    query, position, score = shard.best(vectors[:100], np.arange(100), 20, 64)
    truth = vectors[:100] @ vectors.T
    truth[np.arange(100), np.arange(100)] = -9
    wanted = {(q, i) for q in range(100) for i in np.argsort(-truth[q])[:20]}
    assert len(wanted & set(zip(query, shard.rows[position]))) >= 0.95 * len(wanted)
    assert (shard.rows[position] != query).all()
