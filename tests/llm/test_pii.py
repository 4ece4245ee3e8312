import random
import re

import pytest
from pyspark.sql import functions as F

from tallywind.llm import pii
from tests.llm.corpus import ODD, by_id, docs

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    found = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((kind, m.start(), m.end()))
    return found


TEXTS = [t or "" for t in ODD] + [
    "mail a.b@c.de, and x@y and a@b.c@d.e or a@b.c+x@y.z! @@ a@-.-",
    "1.2.3.4 256.1.1.1 001.002.0003.255 1.2.3.4.5.6.7.8 1.2.3 1.2.3.4.",
    "4111 1111 1111 1111 and 4111-1111-1111-1111, 4111111111111112 4111  1111",
    "+1 (286) 555-5136 or +49 30 1234567. +1 2 +12345678901234567 +1+1+123456789",
    "é😀 1.2.3.4 漢字 a@b.co 😀+1 234 567 8901😀",
    "9" * 3000 + " " + "1-" * 3000 + "1.1." * 1000,
    "a" * 5000 + "@" + "b." * 2000 + "c",
]


def random_texts():
    rng = random.Random(6)
    bits = ["a", "@", ".", "b-", "1", "23", " ", "-", "+", "(", ")", "é", "255", "4111111111111111", "\n", "%"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 60))) for _ in range(1500)]


def test_base_spans_as_defined(spark):
    texts = TEXTS + random_texts()
    got = by_id(pii.extract(docs(spark, list(enumerate(texts)))))
    for k, text in enumerate(texts):
        found = [(x["kind"], x["s"], x["e"]) for x in got[k]["base"]]
        assert found == base_spans(text), repr(text[:200])


def test_offsets_beyond_one_step(spark):
    text = "é 1.1.1.1 " * 1500
    got = pii.extract(docs(spark, [(1, text)])).first()
    assert [(x["s"], x["e"]) for x in got["base"] if x["kind"] == "ip"] == [(10 * k + 2, 10 * k + 9) for k in range(1500)]


def surrounded():
    """Numbers after `call` that the base knows, and some that it does not."""
    rng = random.Random(7)
    rows = [(k, f"please call +1 {rng.randint(200, 999)} 555 {rng.randint(1000, 9999)} {'abcdefgh'[k % 8]} today") for k in range(40)]
    rows += [(100, "please call 030 4455 66 today"), (101, "they saw 030 4455 77 yesterday"), (102, "call nobody")]
    return rows


def test_good_patterns_discover(spark):
    got = by_id(pii.extract(docs(spark, surrounded())))
    assert [(x["kind"], x["s"], x["e"]) for x in got[100]["spans"]] == [("phone", 12, 23)]
    assert got[100]["base"] == [] and got[101]["spans"] == [] and got[102]["spans"] == []
    assert all(got[k]["spans"] == got[k]["base"] != [] for k in range(40))


def test_doubtful_patterns_do_not(spark):
    rows = surrounded() + [(200 + k, f"please call {k} times 7{k} 8{k}") for k in range(30)]
    assert by_id(pii.extract(docs(spark, rows)))[100]["spans"] == []


def test_instances_end_at_base_spans(spark):
    rows = surrounded() + [(300, "please call 030 4455 88 a@b.co today"), (301, "1.2.3.4 | 030 | 4455, call 99\n77")]
    scan = pii.scanned(docs(spark, rows), "doc_id", "text", False)
    found = pii.instances(scan).join(scan.select("row", "doc_id"), "row").where("doc_id >= 300")
    got = {(r["doc_id"], r["s"], r["e"], r["v"], r["kind"], r["before"], r["after"]) for r in found.collect()}
    assert got == {
        (300, 12, 23, "030 4455 88", None, "call", "a@a.a"),
        (300, 24, 30, "a@b.co", "email", "99", "today"),
        (301, 0, 7, "1.2.3.4", "ip", "", "|"),
        (301, 10, 20, "030 4455", None, "|", "call"),
        (301, 27, 29, "99", None, "call", "99"),
        (301, 30, 32, "77", None, "99", ""),
    }
    assert [(x["kind"], x["s"]) for x in by_id(pii.extract(docs(spark, rows)))[300]["spans"]] == [("email", 24), ("phone", 12)]


def test_labels_of_any_length_and_far_neighbours(spark):
    label, word = "l" * 200 + "=", "w" * 3000
    rows = [(k, f"{word}{' ' * 500}{label}10.0.{k}.{k * 7 % 250}") for k in range(20)]
    scan = pii.scanned(docs(spark, rows), "doc_id", "text", False)
    assert {(r["label"], r["before"]) for r in pii.instances(scan).collect()} == {(label, word)}


def test_forms_discover_what_a_base_match_swallowed(spark):
    rows = [(k, f"{'abcdefgh'[k % 8]} +1 ({200 + k}) 555-{1000 + k} {'stuvw'[k % 5]}") for k in range(30)]
    rows += [(100, "y +1 (826) 555-4081 190.137.223.20 z"), (101, "x 256.1.1.1 or 4111111111111112 z")]
    got = by_id(pii.extract(docs(spark, rows)))
    assert [(x["kind"], x["s"], x["e"]) for x in got[100]["base"]] == [("ip", 20, 34)]
    assert [(x["kind"], x["s"], x["e"]) for x in got[100]["spans"]] == [("ip", 20, 34), ("phone", 2, 19)]
    assert got[101]["spans"] == []


def test_refused_instances_are_never_of_the_kind(spark):
    good = [d for d in (f"41111111{k:08d}" for k in range(400)) if luhn(d)][:30]
    bad = [f"41111111{k:08d}" for k in range(400) if not luhn(f"41111111{k:08d}")][:100]
    rows = [(k, f"card {v} end") for k, v in enumerate(good + bad)]
    got = by_id(pii.extract(docs(spark, rows)))
    assert all(len(got[k]["spans"]) == (k < 30) for k in got)


def brute_scores(edges, settings):
    known = [(p, k) for p, _, k, _ in edges if k]
    beliefs = [(p, k, 1.0, 1) for p, k in known]
    for _ in range(settings.rounds):
        score = {}
        for pattern, kind in {(p, k) for p, k, _, _ in beliefs}:
            members = sum(p == pattern and r != kind for p, _, _, r in edges)
            mine = [(b, seed) for p, k, b, seed in beliefs if (p, k) == (pattern, kind)]
            if sum(s for _, s in mine) >= settings.seeds:
                good = sum(b for b, _ in mine) / (members + settings.doubt)
                if good >= settings.pattern:
                    score[pattern, kind] = good
        doubts = {}
        for p, v, k, r in edges:
            for (pattern, kind), good in score.items():
                if k is None and p == pattern and r != kind:
                    doubts[v, kind] = doubts.get((v, kind), 1.0) * (1 - good)
        beliefs = [(p, k, 1.0, 1) for p, k in known] + [
            (p, kind, 1 - d, 0) for p, v, k, r in edges if k is None for (w, kind), d in doubts.items() if w == v and r != kind
        ]
    best = {}
    for (v, kind), d in doubts.items():
        best[v] = max(best.get(v, (0, "")), (1 - d, kind))
    return {v: kind for v, (p, kind) in best.items() if p >= settings.instance}


def test_scores_by_brute_force(spark):
    rng = random.Random(8)
    values = ["1.2.3.%d", "+1 %03d 555 1234", "4%03d", "a%d@b.co", "300.1.1.%d", "12-%d"]
    rows = [(k, " ".join(rng.choice(["call", "ip=", "to", "id"]) + " " * rng.randint(0, 1) + rng.choice(values) % rng.randint(0, 99) for _ in range(4))) for k in range(120)]
    settings = pii.Settings(pattern=0.5, seeds=2, instance=0.6)
    found = pii.instances(pii.scanned(docs(spark, rows), "doc_id", "text", False))
    edges = [tuple(r) for r in pii.with_patterns(found).select("pattern", "v", "kind", "refused").collect()]
    want = brute_scores(edges, settings)
    got = {r["v"]: r["as_kind"] for r in pii.scored_instances(found, settings).collect()}
    assert got == want and len(want) > 3


def test_many_spans_in_one_text(spark):
    text = "".join(f"mail ab{k}@c.de and " for k in range(5000)) + "é" * 5000
    got = pii.redact(docs(spark, [(1, text)])).first()["text"]
    assert got == "mail [EMAIL] and " * 5000 + "é" * 5000


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, "a@b.co"), (3, "a@b.co"), (None, "a@b.co")]
    got = pii.extract(docs(spark, rows)).collect()
    assert len(got) == 5
    assert sorted(len(r["spans"]) for r in got) == [0, 0, 1, 1, 1]
    assert pii.extract(docs(spark, [])).count() == 0


def test_joined(spark):
    r = pii.extract(docs(spark, [(1, "x 1.2.3.4 a@b.co")])).select(pii.joined(F.col("spans")).alias("j")).first()
    assert r["j"] == "email:10:16,ip:2:9"


def test_redacted_text(spark):
    table = docs(spark, [(1, "é a@b.co, 1.2.3.4 +4111111111111111 end"), (2, None), (3, "clean"), *surrounded()[-3:]])
    out = pii.redact(table)
    assert out.columns == table.columns
    got = by_id(out)
    assert got[1]["text"] == "é [EMAIL], [IP] [PHONE] end" or got[1]["text"] == "é [EMAIL], [IP] +[CARD] end"
    assert got[2]["text"] is None and got[3]["text"] == "clean" and got[3]["row"] == "x"


@pytest.mark.parametrize("digits, good", [("4111111111111111", True), ("4111111111111112", False), ("0", True)])
def test_luhn(spark, digits, good):
    assert spark.range(1).select(pii.passes_luhn(F.lit(digits)).alias("g")).first()["g"] is good
