import random

from pyspark.sql import functions as F

from tallywind.llm import merkle
from tests.llm.corpus import ODD, docs


def prints(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    return [r["f"] for r in df.select("k", merkle.fingerprint(F.col("t")).alias("f")).orderBy("k").collect()]


def prose(rng, n):
    return "".join(rng.choice(["some", "words", "alone", "them", "by", "Zoé"]) + rng.choice([" ", ", ", ". ", "\n"]) for _ in range(n))


def test_equal_prints_are_equal_texts(spark):
    rng = random.Random(1)
    texts = [t or "" for t in ODD] + [prose(rng, 200) for _ in range(20)]
    texts += ["a\nb", "a\n\nb", "a\nb\n", "a b", "a  b", " a b"]
    found = prints(spark, texts + texts)
    assert found[: len(texts)] == found[len(texts) :]
    assert len(set(found)) == len(set(texts))


def test_written_down_tree(spark):
    text = prose(random.Random(2), 600)
    found = prints(spark, [text])[0]
    body = found[merkle.ROOT + 1 :]
    assert found[merkle.ROOT] == ":" and body.count(";") + body.count("/") == text.count("\n") + 1
    assert prints(spark, [None]) == prints(spark, [""])


def test_likeness_and_edits(spark):
    rng = random.Random(3)
    lines = [prose(rng, 30).replace("\n", " ") for _ in range(60)]
    edited = list(lines)
    edited[17] = "something else altogether, and of some length. "
    gone = lines[:40] + lines[41:]
    texts = ["\n".join(x) for x in (lines, edited, gone)] + [prose(random.Random(9), 500)]
    base, *others = prints(spark, texts)
    df = spark.createDataFrame([(base, o) for o in [base, *others]], "a string, b string")
    got = df.select(
        merkle.likeness(F.col("a"), F.col("b")).alias("n"),
        merkle.differing_paragraphs(F.col("a"), F.col("b")).alias("d"),
    ).collect()
    assert got[0]["n"] == 1.0 and got[0]["d"] == []
    assert 0.9 < got[1]["n"] < 1 and got[1]["d"] == [17]
    assert 0.9 < got[2]["n"] < 1 and got[2]["d"] == [40]
    assert got[3]["n"] < 0.3


def brute_likeness(a, b):
    """By descent from the root, with sets of nodes."""
    if a[: merkle.ROOT] == b[: merkle.ROOT]:
        return 1.0

    def codes(node):
        return [node[k : k + merkle.CODE] for k in range(0, len(node), merkle.CODE)]

    left, right = (set(x[merkle.ROOT + 1 :].split("/")) for x in (a, b))
    common = sum(len(codes(s.replace(";", ""))) for s in left & right)
    left, right = ({p for s in x - y for p in s.split(";")} for x, y in ((left, right), (right, left)))
    common += sum(len(codes(p)) for p in left & right)
    left, right = ({c for p in x - y for c in codes(p)} for x, y in ((left, right), (right, left)))
    common += len(left & right)
    whole = 2 * common + len(left ^ right)
    return 2 * common / whole if whole else 0.0


def test_likeness_by_descent(spark):
    rng = random.Random(5)
    texts = [t or "" for t in ODD] + ["\n", "\n\n\n"]
    for _ in range(25):
        lines = [prose(rng, rng.randint(1, 40)).replace("\n", " ") for _ in range(rng.randint(1, 60))]
        edited = [x for x in lines if rng.random() > 0.1]
        edited[rng.randint(0, len(edited)) :] += [prose(rng, 30)]
        texts += ["\n".join(lines), "\n".join(edited), "\n".join(edited * 2)]
    found = prints(spark, texts)
    pairs = list(zip(found, found[1:] + found[:1], strict=True)) + [(rng.choice(found), rng.choice(found)) for _ in range(200)]
    df = spark.createDataFrame([(k, *p) for k, p in enumerate(pairs)], "k int, a string, b string")
    got = df.select("k", merkle.likeness(F.col("a"), F.col("b")).alias("n")).orderBy("k").collect()
    want = [brute_likeness(*p) for p in pairs]
    assert [r["n"] for r in got] == want
    assert any(0 < w < 1 for w in want)


def by_hand(rows):
    """Edited texts in order of id; rows have distinct ids."""
    order = sorted(rows, key=lambda r: r[0])
    for (doc_id, text, *_), (_, following, *_) in zip(order, order[1:] + order[:1], strict=True):
        text, following = text or "", following or ""
        half = len(text) // 2
        yield doc_id, len(text), text[: len(text) - half] + following[:half]


def test_edited_texts_over_many_ranges(spark):
    rng = random.Random(4)
    ids = rng.sample(range(-500, 5000), 300)
    rows = [(k, rng.choice([*ODD, prose(rng, rng.randint(1, 80))])) for k in ids]
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        got = merkle.compare_with_edit(docs(spark, rows)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert sorted((r["doc_id"], r["n_chars"], r["edited"]) for r in got) == sorted(by_hand(rows))
    of = dict(zip([r["doc_id"] for r in got], prints(spark, [r["edited"] for r in got]), strict=True))
    assert all(r["edited_fingerprint"] == of[r["doc_id"]] for r in got)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)


def test_single_empty_repeated_and_nameless_rows(spark):
    alone = merkle.compare_with_edit(docs(spark, [(5, "abcdef")])).collect()
    assert [(r["edited"], r["near_next"]) for r in alone] == [("abcabc", 1.0)]
    assert merkle.compare_with_edit(docs(spark, [])).count() == 0
    rows = [(1, "aaaa"), (1, "bbbb"), (1, "bbbb"), (2, "cccc"), (None, "dddd"), (None, None)]
    got = merkle.compare_with_edit(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    assert {r["edited"] for r in got if r["doc_id"] == 2} <= {"ccdd", "cc"}
