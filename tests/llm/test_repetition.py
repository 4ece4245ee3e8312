import random
import re

import pytest

from tallywind.llm.repetition import LIMITS, measure, repetition
from tests.llm.corpus import ODD, by_id, docs

LENGTHS = tuple(sorted(LIMITS.grams))


def slow(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    total = sum(map(len, words))

    def inside(n, first=True):
        grams = [tuple(words[k : k + n]) for k in range(len(words) - n + 1)]
        marked = set()
        for k, g in enumerate(grams):
            if grams.count(g) > 1 and (first or grams.index(g) < k):
                marked.update(range(k, k + n))
        return marked

    lines, seen, dup, chars = text.split("\n"), set(), 0, 0
    for line in lines:
        parts = re.findall(r"[^\x20\x09-\x0D]+", line)
        if parts and line in seen:
            dup += 1
            chars += sum(map(len, parts))
        seen.add(line)
    shares = [sum(len(words[k]) for k in inside(n, False)) / total if total else 0.0 for n in LENGTHS]
    stutter = set()
    for n in LIMITS.stutter:
        for k in range(n, len(words) - n + 1):
            if words[k : k + n] == words[k - n : k]:
                stutter.update(range(k, k + n))
    symbols = sum(c in "#*$%&|<>" for c in text)
    parts = [chars, sum(len(words[k]) for k in stutter)]
    parts = [part / total if total else 0.0 for part in parts]
    return len(words), total, symbols, dup, len(inside(5)), *parts, shares


def texts():
    rng = random.Random(2)
    made = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 40))) for _ in range(60)]
    made += ["\n".join(rng.choice(["a b", "c|d", "", " ", "é x"]) for _ in range(12)) for _ in range(30)]
    return made + ["a b c d e a b c d e", "a b c d", "# $ % <>|&*"]


@pytest.mark.parametrize("text", [t or "" for t in ODD if t is None or len(t) < 3000] + texts())
def test_against_brute_force(text):
    got, want = measure(text, LENGTHS, LIMITS.stutter), slow(text)
    assert got[:5] == want[:5]
    assert got[5:7] == pytest.approx(want[5:7]) and got[7] == pytest.approx(want[7])


def test_the_method_decides_where_the_base_rule_does_not(spark):
    stutter = " ".join(f"w{k} w{k} w{k}" for k in range(30))
    twice = " ".join(f"a{k} b{k} a{k} b{k}" for k in range(30))
    once = " ".join(f"w{k}" for k in range(90)) + " very very good"
    lines = "\n".join([*(f"line {k} of many" for k in range(20)), *["a b c d"] * 12])
    found = by_id(repetition(docs(spark, [(1, stutter), (2, twice), (3, once), (4, lines)])))
    assert [found[k]["base_failed"] for k in (1, 2, 3)] == [False] * 3
    assert [found[k]["kept"] for k in (1, 2, 3)] == [False, False, True]
    assert not found[4]["kept"]


def test_rows(spark):
    clean = " ".join(f"w{k}" for k in range(100))
    rows = [(1, None), (2, ""), (3, clean), (3, clean), (4, "few words"), (5, clean + " " + clean), (None, clean)]
    rows.append((6, "\n".join([clean, "a line that comes again and again of some length"] * 2)))
    found = repetition(docs(spark, rows))
    assert found.count() == len(rows)
    got = by_id(found)
    assert [got[k]["kept"] for k in (1, 2, 3, 4, 5, None)] == [False, False, True, False, False, True]
    assert [got[k]["base_failed"] for k in (1, 2, 3, 4, 5, None)] == [True, True, False, True, True, False]
    assert got[1]["n_words"] == 0 and got[3]["word_chars"] == sum(len(f"w{k}") for k in range(100))
    assert repetition(docs(spark, [])).count() == 0


def test_repeats_across_documents_do_not_count(spark):
    clean = " ".join(f"w{k}" for k in range(50))
    assert all(r["kept"] for r in repetition(docs(spark, [(k, clean) for k in range(20)])).collect())
