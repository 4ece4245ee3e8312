import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywind.llm import labelled, quality, toxicity
from tests.llm.corpus import ODD, by_id, docs


def clean_text(rng, n=60):
    words = ["the", "and", "stone", "river", "house", "green", "over", "small", "bird", "window", "table", "idea"]
    return " ".join("".join(rng.choice(words) for _ in range(rng.randint(1, 2))) for _ in range(n)) + "."


def corpus(rng, n=500):
    """Documents with labels: junk is upper-case or full of signs, toxic ones have one
    of two words among others."""
    rows, labels = [], []
    for k in range(n):
        text, good, toxic = clean_text(rng), 1, 0
        if k % 5 == 1:
            text, good = text.upper().replace(" ", "!! "), 0
        elif k % 5 == 2:
            words = text.split()
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["grumblefish", "zornwald"]))
            text, toxic = " ".join(words), 1
        rows.append((k, text))
        labels.append((k, good, toxic))
    return rows, labels


@pytest.fixture(scope="module")
def tables(spark):
    rows, labels = corpus(random.Random(8))
    # copies of one toxic document must not make its other words toxic
    copied = next(t for k, t in rows if k % 5 == 2)
    rows += [(1000 + k, copied) for k in range(150)]
    labels += [(1000 + k, 1, 1) for k in range(150)] + [(None, 1, 1), (3, None, None)]
    rows += [(2000 + k, t) for k, t in enumerate(ODD)] + [(3, rows[3][1]), (None, "a b")]
    return docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), dict(rows)


def test_split(spark):
    ids = spark.range(50).withColumn("r", labelled.remainder(F.col("id"), 3))
    assert all(r["r"] == zlib.crc32(str(r["id"]).encode()) % 3 for r in ids.collect())
    labels = spark.createDataFrame([(k, k % 2) for k in range(1000)] + [(5, 1), (5, 0)], "doc_id long, quality int")
    rows = labelled.training_labels(labels, "quality", 3, 1)
    assert {r["label_id"] for r in rows.collect()} == {k for k in range(1000) if zlib.crc32(str(k).encode()) % 3 != 1}
    assert abs(labelled.training_labels(labels, "quality", 3, 1, bound=200).count() - 200) < 60


def test_quality(spark, tables):
    table, labels, texts = tables
    found = quality.score_quality(table, labels)
    assert found.count() == table.count()
    got = by_id(found)
    right = [got[k]["predicted"] == (k % 5 != 1) for k in range(500) if got[k]["held_out"]]
    assert len(right) > 100 and np.mean(right) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert {k for k in range(500) if got[k]["held_out"]} == {k for k in range(500) if zlib.crc32(str(k).encode()) % 3 == 1}


def test_rules_are_conjunctions(spark, tables):
    table, labels, _ = tables
    rows = quality.statistics(table).join(labels.withColumnRenamed("doc_id", "i"), F.col("doc_id") == F.col("i"))
    model = quality.fit(rows.where("quality is not null").select(F.col("quality").alias("label"), *quality.STATISTICS))
    assert model.weights and all(1 <= len(rule) <= 3 for rule, _ in model.weights)
    some = rows.select(model.score().alias("compiled"), *quality.STATISTICS).limit(20).collect()
    for r in some:
        total = model.intercept + sum(
            w for rule, w in model.weights if all((r[s] > t) if above else (r[s] <= t) for s, above, t in rule)
        )
        assert r["compiled"] == pytest.approx(1 / (1 + np.exp(-total)))


def test_statistics():
    got = dict(zip(quality.STATISTICS, quality.describe("Ab cd!\nAb cd!\n| é"), strict=True))
    assert got["words"] == 6 and got["repeated_lines"] == pytest.approx(1 / 3) and got["bars"] == pytest.approx(1 / 6)
    assert got["upper"] == 2 / 8 and quality.describe(" \n") == (0.0,) * len(quality.STATISTICS)


def test_nothing_to_learn(spark, tables):
    table, labels, _ = tables
    none = labels.limit(0)
    assert {r["score"] for r in quality.score_quality(table, none).select("score").distinct().collect()} == {0.5}
    ones = spark.createDataFrame([(k, 1, 0) for k in range(20)], labels.schema)
    assert {r["predicted"] for r in quality.score_quality(table, ones).collect()} == {1}
    assert {r["predicted"] for r in toxicity.score_toxicity(table, ones).collect()} == {0}
    empty = docs(spark, [])
    assert quality.score_quality(empty, labels).count() == toxicity.score_toxicity(empty, labels).count() == 0


def test_toxicity(spark, tables):
    table, labels, texts = tables
    found = toxicity.score_toxicity(table, labels)
    assert found.count() == table.count()
    got = by_id(found)
    right = [got[k]["predicted"] == (k % 5 == 2) for k in range(500) if got[k]["held_out"]]
    assert len(right) > 80 and np.mean(right) > 0.98
    assert got[2000]["predicted"] == got[2001]["predicted"] == 0
    assert toxicity.keep_clean(table, labels).columns == table.columns
    kept = {r["doc_id"] for r in toxicity.keep_clean(table, labels).collect()}
    assert kept == {k for k, r in got.items() if r["score"] < toxicity.TOXIC_FROM}


def test_disguised_words_are_restored_and_scored(spark, tables):
    table, labels, _ = tables
    model = toxicity.fit(table, labels)
    assert set(model.toxic) == {"grumblefish", "zornwald"}
    for text in (
        "a gr0mb ok",
        "stone gru.mble.fish river",
        "stone z0rnw4ld river",
        "stone z o r n w a l d river",
        "stone zzzzornwaaaald river",
        "stone Z0RNWALD!!! river",
    ):
        assert (model.score(text, {}) >= toxicity.TOXIC_FROM) == (text != "a gr0mb ok"), text
    assert model.score("stone river a.b@c.de 192.168.0.1 http://zornwald.x 12:30", {}) < toxicity.TOXIC_FROM


def test_words_with_an_at_sign_are_no_addresses(spark, tables):
    table, labels, _ = tables
    model = toxicity.fit(table, labels)
    for token in ("z0rnw@ld.", "zornw@ld...", "z0rnw@ld", "(z0rnw@ld.)", "z0rnw@l.d", "z0rnw@ld.,"):
        assert model.score(f"stone river {token}", {}) >= toxicity.TOXIC_FROM, token
    for token in ("zornwald@stone.de", "<zornwald@stone.co.uk>,", "http://zornwald.x", "(www.zornwald.x)"):
        assert toxicity.read_token(token, model.letters) == (), token


def test_no_disguise_is_left_unread(spark, tables):
    table, labels, _ = tables
    model = toxicity.fit(table, labels)
    for disguise in (
        "such a z o r n w a l d",
        "z o r n w a l d g r u m b l e f i s h",
        "zo rn wa ld",
        "z" + "o" * 60 + "rnwald",
        "---".join("grumblefish") + "!",
        "zornwwald",
        "zornwwald!",
    ):
        assert model.score(f"stone {disguise} river", {}) >= toxicity.TOXIC_FROM, disguise
    found = toxicity.restored("stone z o r n w a l d g r u m b l e f i s h river", model.letters, {})
    assert {"zornwald", "grumblefish"} <= set(found)
    assert toxicity.read_token("window", model.letters) == ("window",)
    assert len(toxicity.viterbi("a1" * 50_000, model.letters)) >= 50_000


def best_reading(token, model):
    """All paths through a lattice."""
    paths = [("", 0.0)]
    for readings in toxicity.lattice(token):
        paths = [(t + r, c + p) for t, c in paths for r, p in readings]

    def cost(text):
        total, a, b = 0.0, toxicity.EDGE, toxicity.EDGE
        for letter in [*map(toxicity.kind, text), toxicity.EDGE]:
            total += model.cost[a][b][letter]
            a, b = b, letter
        return total

    return min((c + cost(t), t) for t, c in paths)


def test_viterbi_against_all_paths():
    rng = random.Random(9)
    model = toxicity.LetterModel(toxicity.trigrams(clean_text(rng, 400)))
    for token in ("h0u5e", "gr33n", "b!rd", "t4bl3", "st0n3", "r.i.v.e.r", "1d34", "ooover", "$mall", "é1é"):
        found = toxicity.viterbi(token, model)
        assert best_reading(token, model)[1] == found
    assert toxicity.viterbi("h0u5e", model) == "house" and toxicity.viterbi("r.i.v.e.r", model) == "river"


def slow_trigrams(text):
    counts = np.zeros(toxicity.KINDS**3, int)
    for run in re.findall(r"[^\W\d_]+", text.lower()):
        a = b = toxicity.EDGE
        for c in [*map(toxicity.kind, run), toxicity.EDGE]:
            counts[(a * toxicity.KINDS + b) * toxicity.KINDS + c] += 1
            a, b = b, c
    return counts


@pytest.mark.parametrize("text", [t or "" for t in ODD] + ["ab", " ab", "a", "a1b ,c-dé", "ab ab\n\nc"])
def test_trigrams_by_hand(text):
    assert (toxicity.trigrams(text) == slow_trigrams(text)).all()


def test_letter_counts_cover_all_documents(spark):
    texts = ["ab ab", "AB c1", None, "zé " * 400]
    found = toxicity.letter_counts(docs(spark, list(enumerate(texts))))
    want = sum(slow_trigrams(t or "") for t in texts)
    assert {r["gram"]: r["n"] for r in found.collect()} == {k: n for k, n in enumerate(want) if n}
