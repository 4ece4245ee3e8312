"""Document quality by a sparse ensemble of rules.

Each text becomes a row of statistics. Shallow trees of a forest are grown on the
labelled rows; every path from a root becomes a rule, a conjunction of comparisons
of statistics. Lasso logistic regression over the rules keeps few of them, and these
are compiled into one column expression: scoring is plain Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywind.llm.common import ready_for_python, whole_text, written
from tallywind.llm.labelled import remainder, training_labels
from tallywind.llm.repetition import WINDOW, covered, duplicated, rolling_hashes

PARTS, HELD = 3, 1

STATISTICS = (
    "words", "chars_per_word", "longest_word", "distinct_words", "words_per_line", "repeated_lines",
    "repeated_words", "upper", "digits", "symbols", "bars", "exclamations", "stops", "commas",
    "other_marks", "non_ascii", "ends_marked", "capital_words", "single_letters",
)


@dataclass(frozen=True)
class Settings:
    trees: int = 12
    depth: int = 3
    #: Weight of the lasso penalty.
    penalty: float = 0.002
    rounds: int = 60
    seed: int = 17


SETTINGS = Settings()


def describe(text: str) -> tuple[float, ...]:
    """The statistics of one text, in the order of STATISTICS; all zero without words."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return (0.0,) * len(STATISTICS)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower = counts[65:91].sum(), counts[97:123].sum()
    chars = len(text) - int(counts[[9, 10, 11, 12, 13, 32]].sum())

    def of(letters: str) -> int:
        return int(counts[[ord(c) for c in letters]].sum())

    lines = [x for x in raw.split(b"\n") if x.strip()]
    named: dict[bytes, int] = {}
    numbers = np.fromiter((named.setdefault(w, len(named)) for w in words), np.uint64, n)
    with np.errstate(over="ignore"):
        numbers = (numbers + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    repeated = 0
    if n > WINDOW:
        repeated = int(covered(duplicated(rolling_hashes(numbers, WINDOW))[0], WINDOW, n).sum())
    return (
        float(n),
        chars / n,
        float(max(map(len, named))),
        len(named) / n,
        n / len(lines),
        1 - len(set(lines)) / len(lines),
        repeated / n,
        float(upper / max(1, upper + lower)),
        float(counts[48:58].sum() / max(1, chars)),
        of("#*$%&<>") / n,
        of("|") / n,
        of("!") / n,
        of(".") / n,
        of(",") / n,
        of(":;?()[]{}/\\_=+~^@\"'`-") / n,
        float(counts[128:].sum() / len(raw)),
        sum(w[-1] in b".,;:!?" for w in words) / n,
        sum(65 <= w[0] <= 90 for w in words) / n,
        sum(len(w) == 1 for w in words) / n,
    )


def statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id` and one double per statistic, for every row."""

    ready_for_python(docs)

    @F.pandas_udf("struct<" + ",".join(f"{s}:double" for s in STATISTICS) + ">")
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([describe(t) for t in texts], columns=list(STATISTICS))

    return docs.select(
        F.col(doc_id).alias("doc_id"), measured(whole_text(text)).alias("s")
    ).select("doc_id", "s.*")


#: A comparison of a statistic: name, whether it must be above, threshold.
Condition = tuple[str, bool, float]
Rule = tuple[Condition, ...]


def rules_of(forest) -> list[Rule]:
    """Every path from a root, short ones included, as a conjunction. A statistic
    that is compared twice in one direction keeps the stricter comparison."""
    found: dict[Rule, None] = {}

    def walk(node, path: dict[tuple[str, bool], float]):
        if path:
            found.setdefault(tuple((s, above, t) for (s, above), t in sorted(path.items())))
        if node.subtreeDepth() == 0:
            return
        name, at = STATISTICS[node.split().featureIndex()], float(node.split().threshold())
        walk(node.leftChild(), path | {(name, False): min(at, path.get((name, False), at))})
        walk(node.rightChild(), path | {(name, True): max(at, path.get((name, True), at))})

    for tree in forest.trees:
        walk(tree._call_java("rootNode"), {})
    return list(found)


def holds(rule: Rule) -> Column:
    """Whether a row of statistics meets all conditions of a rule."""
    return reduce(
        lambda a, b: a & b,
        [F.col(s) > F.lit(t) if above else F.col(s) <= F.lit(t) for s, above, t in rule],
    )


@dataclass(frozen=True)
class RuleModel:
    """Weighted rules and an intercept; `score` is their compiled expression."""

    intercept: float
    weights: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.weights:
            total = total + F.when(holds(rule), weight).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(rows: DataFrame, settings: Settings = SETTINGS) -> RuleModel:
    """A model from rows of statistics and `label`. Where there is nothing to tell
    apart, no rows or one class, every text scores the share of label 1, or a half."""
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    ones, total = counts.get(1, 0), sum(counts.values())
    if ones == 0 or ones == total:
        share = min(0.99, max(0.01, ones / total)) if total else 0.5
        return RuleModel(float(np.log(share / (1 - share))), ())
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="statistics").transform(rows)
    forest = RandomForestClassifier(
        featuresCol="statistics",
        labelCol="label",
        numTrees=settings.trees,
        maxDepth=settings.depth,
        seed=settings.seed,
    ).fit(vectors)
    rules = rules_of(forest)
    named = {f"rule_{k}": holds(r).cast("double") for k, r in enumerate(rules)}
    met = VectorAssembler(inputCols=list(named), outputCol="met").transform(
        rows.select("label", *[c.alias(n) for n, c in named.items()])
    )
    lasso = LogisticRegression(
        featuresCol="met",
        labelCol="label",
        elasticNetParam=1.0,
        regParam=settings.penalty,
        maxIter=settings.rounds,
        standardization=False,
    ).fit(met.select("met", "label"))
    weights = tuple(
        (r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray(), strict=True) if w != 0
    )
    return RuleModel(float(lasso.intercept), weights)


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    settings: Settings = SETTINGS,
) -> DataFrame:
    """`doc_id, held_out, score, predicted` for every row of the documents.

    Statistics are computed once, written, and read by the fit and the scoring; so are
    the rows of the fit, which many passes read. All labelled rows outside the held-out
    part are learned from. A null text is an empty
    one; texts without words have all statistics zero and are scored by them. A null
    id is never held out. Repeated rows are scored alike.
    """
    measured = written(statistics(docs, doc_id, text), "statistics")
    known = training_labels(labels, "quality", PARTS, HELD)
    joined = measured.join(known, F.col("doc_id") == F.col("label_id"))
    rows = written(joined.select("label", *STATISTICS), "quality-rows")
    model = fit(rows, settings)
    return measured.select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), PARTS) == HELD, F.lit(False)).alias("held_out"),
        model.score().alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
