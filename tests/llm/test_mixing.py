import hashlib

import pytest

from tallywind.llm import mixing
from tests.helpers import plan
from tests.llm.corpus import docs


def filled(sizes, weights=mixing.WEIGHTS, share=1.5, most=2.0):
    """Water filling one source at a time."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    budget, target, left = share * sum(sizes.values()), {}, set(names)
    while left:
        level = (budget - sum(target.values())) / sum(weight[s] for s in left)
        full = {s for s in left if weight[s] * level >= most * sizes[s]}
        if not full:
            target |= {s: weight[s] * level for s in left}
            break
        target |= {s: most * sizes[s] for s in full}
        left -= full
    return target


def rows():
    made = [(k, "w " * (k % 17 + 1), f"s{k % 5}") for k in range(300)]
    made += [(1000 + k, "hot " * 9, "hot") for k in range(200)]
    return made + [(2000, None, None), (2001, "a b c", None), (None, "x y", "s1"), (7, "w w", "s2"), (2002, "", "empty")]


def test_targets_match_filling_by_hand(spark):
    found = mixing.decide(docs(spark, rows()))
    sizes = {}
    for _, text, source in rows():
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    want = filled(sizes)
    got = {r["source_size"]: r["target"] for r in found.collect()}
    for source, target in want.items():
        assert got[sizes[source]] == pytest.approx(target)
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_copies_follow_the_hash(spark):
    found = mixing.decide(docs(spark, rows())).where("doc_id is not null").collect()
    for r in found:
        rate = r["target"] / r["source_size"] if r["source_size"] else 0.0
        draw = int(hashlib.md5(f"mix|{r['doc_id']}".encode()).hexdigest()[:13], 16) / 2**52
        assert r["copies"] == int(rate) + (draw < rate - int(rate))
        assert r["copies"] <= 2


def test_reruns_agree_and_targets_are_met(spark):
    table = docs(spark, [(k, "w " * (k % 13 + 1), f"s{k % 4}") for k in range(6000)])
    once = sorted(tuple(r) for r in mixing.decide(table).collect())
    assert once == sorted(tuple(r) for r in mixing.decide(table.repartition(7)).collect())
    by_source = {}
    for doc_id, size, _, target, copies in once:
        taken, _ = by_source.get(doc_id % 4, (0, 0))
        by_source[doc_id % 4] = (taken + size * copies, target)
    assert all(abs(t / target - 1) < 0.05 for t, target in by_source.values())


def test_mix_repeats_whole_rows(spark):
    table = docs(spark, rows())
    mixed = mixing.mix(table)
    assert mixed.columns == table.columns
    want = {r["doc_id"]: r["copies"] for r in mixing.decide(table).where("doc_id > 10").collect()}
    got = {r["doc_id"]: r["count"] for r in mixed.where("doc_id > 10").groupBy("doc_id").count().collect()}
    assert got == {k: v for k, v in want.items() if v}


def test_empty_table_and_wordless_texts(spark):
    assert mixing.decide(docs(spark, [])).count() == 0
    found = mixing.decide(docs(spark, [(1, None), (2, " ")])).collect()
    assert [(r["size"], r["target"], r["copies"]) for r in found] == [(0, 0.0, 0)] * 2


def test_repeated_rows_are_taken_alike(spark):
    found = mixing.decide(docs(spark, [(1, "a b"), (1, "a b"), (2, "c d e")]))
    assert found.where("doc_id = 1").select("copies").distinct().count() == 1


def test_no_document_is_shuffled(spark):
    text = plan(mixing.decide(docs(spark, rows()).select("doc_id", "text", "source")))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
