import random

import pytest
import xxhash

from tallywind.llm import components, simhash
from tests.llm.corpus import ODD, by_id, docs


def slow_simhash(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).split(" ") if w]
    words = [w for part in words for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", part)]
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(points):
    """Components of all pairs within two bits."""
    root = {p: p for p in points}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in points:
        for b in points:
            if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 2:
                root[find(b)] = find(a)
    found = {}
    for p in points:
        found.setdefault(find(p), set()).add(p)
    return {frozenset(v) for v in found.values()}


@pytest.mark.parametrize("text", [t or "" for t in ODD] + ["b a " * 70000, "A B", "É É É É"])
def test_fingerprint_by_definition(text):
    if len(text) > 100000:
        assert simhash.simhash(text) == simhash.simhash(text.upper())
    else:
        assert simhash.simhash(text) == slow_simhash(text)


def near(spark, points, cell):
    df = spark.createDataFrame([(p,) for p in points], "fp long")
    found = {}
    for r in components.components(simhash.links(df, cell=cell)).collect():
        found.setdefault(r["component"], set()).add(r["node"])
    alone = set(points) - {p for v in found.values() for p in v}
    return {frozenset(v) for v in found.values()} | {frozenset([p]) for p in alone}


@pytest.mark.parametrize("cell", [0, 4, 1000])
def test_links_against_all_pairs(spark, cell):
    rng = random.Random(cell)
    points = set()
    for _ in range(25):
        at = rng.getrandbits(64)
        for _ in range(rng.randint(1, 14)):
            points.add(simhash._signed(at))
            for _ in range(rng.randint(1, 4)):
                at ^= 1 << rng.randrange(64)
    points |= {0, -1, simhash._signed(1 << 63), 3, 7}
    assert near(spark, sorted(points), cell) == classes(sorted(points))


def test_keys_meet_for_every_close_pair(spark):
    rng = random.Random(5)
    pairs = []
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 2):
            b ^= 1 << bit
        pairs.append((simhash._signed(a), simhash._signed(b)))
    flat = [(x,) for p in pairs for x in p]
    keyed = simhash.pivot_table(spark.createDataFrame(flat, "fp long")).select(
        "fp", simhash.cell_keys().alias("keys"), "dense"
    )
    known = {r["fp"]: r for r in keyed.collect()}
    for a, b in pairs:
        assert set(known[a]["keys"]) & set(known[b]["keys"])
        assert max(abs(x - y) for x, y in zip(known[a]["dense"], known[b]["dense"], strict=True)) <= 2


def test_components_of_chains_hubs_and_repeats(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 180)] + [(5, 5), (300, 200), (300, 200), (-7, 200)]
    found = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {found[k] for k in range(61)} == {0}
    assert {found[k] for k in range(100, 180)} == {100}
    assert found[300] == found[200] == found[-7] == -7
    empty = spark.createDataFrame([], "a long, b long")
    assert components.components(empty).count() == 0


def test_documents(spark):
    base = " ".join(f"word{k}" for k in range(400))
    rows = [(10 + k, base) for k in range(5)] + [(9, base + " tail"), (3, None), (4, ""), (5, "  "), (6, "other text of its own")]
    rows += [(10, base), (None, base)]
    found = simhash.near_duplicates(docs(spark, rows))
    assert found.count() == len(rows)
    got = by_id(found)
    assert got[3]["component_id"] == got[4]["component_id"] == got[5]["component_id"] == 3
    near_enough = bin((simhash.simhash(base) ^ simhash.simhash(base + " tail"))).count("1") <= 2
    assert got[12]["component_id"] == (9 if near_enough else 10) == got[None]["component_id"]
    assert got[6]["component_id"] == 6
    kept = simhash.keep_one(docs(spark, rows))
    assert kept.columns == docs(spark, []).columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 3 in ids and 6 in ids and 4 not in ids and 12 not in ids
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


def test_one_row_of_each_component_is_kept_whatever_its_id(spark):
    a, b, c = ("first text of all", "another one, with other words", "the third says something else")
    rows = [(1, a), (5, a), (5, b), (None, a), (None, a), (7, c), (7, c), (None, "no id at all")]
    kept = simhash.keep_one(docs(spark, rows)).collect()
    texts = {1: a, 5: b, 7: c, None: "no id at all"}
    assert len(kept) == 4 and {r["doc_id"]: r["text"] for r in kept} == texts
    assert kept[0].asDict()["row"] == "x"
    nothing = simhash.keep_one(docs(spark, []))
    assert nothing.columns == docs(spark, []).columns and nothing.count() == 0
