"""Toxicity of documents whose words may be disguised.

A character language model (trigram counts of all words of all documents) is the
source, and leetspeak, spacing, separators and repeated letters are the noise.
Suspicious tokens become lattices of readings, Viterbi decoding picks the likeliest,
and the restored words are scored: words and word beginnings that the labelled rows
show to be toxic each have a probability, and a document is toxic if any of its words
is (noisy or).
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywind.llm.common import bounded_broadcast, ready_for_python, whole_text, written
from tallywind.llm.labelled import remainder, training_labels

PARTS, HELD = 4, 2
TOXIC_FROM = 0.3

#: What a sign may stand for.
READINGS = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
}
#: Signs that may stand between letters and mean nothing.
FILLERS = set(".-_*~'`^,:;/\\#%&=​­")
#: Costs, as negative logarithms: a sign read as a letter, a filler dropped, a sign
#: that could be a letter dropped, any other one, a letter of a double one dropped, and
#: of a longer run.
SUBSTITUTE, FILL, DROP, LEAVE, DOUBLE, COLLAPSE = 1.0, 0.2, 9.0, 6.0, 6.0, 0.3

#: Letters of the model: a-z, one class for all other letters, one for word ends.
LETTERS = {c: k for k, c in enumerate("abcdefghijklmnopqrstuvwxyz")}
REST, EDGE, KINDS = 26, 27, 28

PLAIN = re.compile(r"[^\W\d_]+")
TRIPLE = re.compile(r"([^\W\d_])\1\1")
DOUBLE_LETTER = re.compile(r"([^\W\d_])\1")
REPEATED = re.compile(r"(.)\1+", re.S)
STRETCHED = re.compile(r"(.)\1{3,}", re.S)
SIGNS = "".join(map(re.escape, READINGS))
INSIDE = "".join(map(re.escape, sorted(FILLERS)))
#: A letter with a sign beside it, or a filler between letters.
DISGUISED = re.compile(rf"[^\W\d_][{SIGNS}]|[{SIGNS}][^\W\d_]|[^\W\d_][{INSIDE}]+[^\W\d_]")
#: Mail and web addresses are no words: a whole mail shape, outer punctuation taken
#: off, with letters after its last full stop.
ADDRESS = re.compile(r"[^@]+@[^@.]+(?:\.[^@.]+)*\.[^\W\d_]{2,}|.*://.*|www\..*", re.S)
OUTER = ".,;:!?\"'()[]{}<>|#*$%&-_=+/\\"
#: In tokens longer than this a sign counts three times in a row at most.
LONGEST = 40


@dataclass(frozen=True)
class Settings:
    #: Labelled documents to learn from, about; all count alike up to this bound.
    labelled: int = 20_000
    #: Word beginnings of these lengths are features, besides whole words.
    beginnings: tuple[int, ...] = (3, 4, 5, 6)
    #: Least number of toxic documents of a feature.
    support: int = 4
    #: Least share of toxic ones among a feature's documents, and then contexts.
    purity: float = 0.5
    #: Features expected to look toxic by accident, over all.
    accident: float = 0.3
    #: Most features a model has: the most frequent in toxic documents.
    features: int = 20_000


SETTINGS = Settings()


def kind(letter: str) -> int:
    return LETTERS.get(letter, REST)


# ---------------------------------------------------------------- language model


@cache
def _kinds() -> np.ndarray:
    """The kind of every code point: its letter, another letter, or an edge."""
    kinds = np.full(0x110000, EDGE, np.int64)
    kinds[[c for c in range(0x110000) if chr(c).isalpha()]] = REST
    for letter, k in LETTERS.items():
        kinds[ord(letter)] = k
    return kinds


def trigrams(text: str) -> np.ndarray:
    """How often each trigram of kinds occurs in the lower-cased letter runs of a text,
    with two edges before each run and one after it."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")
    kinds = _kinds()[points]
    a, b, c = kinds[:-2], kinds[1:-1], kinds[2:]
    inside = (b != EDGE) | (c != EDGE)
    codes = (np.where(b == EDGE, EDGE, a) * KINDS + b) * KINDS + c
    counts = np.bincount(codes[inside], minlength=KINDS**3)
    if len(kinds) > 1 and kinds[1] != EDGE:  # the first run of all has no place before it
        counts[(EDGE * KINDS + EDGE) * KINDS + kinds[1]] += 1
    return counts


#: Words or features held at once.
HELD_WORDS = 100_000
#: Characters counted at once.
COUNTED = 500_000


def letter_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """`gram, n`: how often each trigram of letter kinds occurs in the words of all
    documents. A task returns its sums, at most 28^3 rows, and these are added up."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(KINDS**3, np.int64)
        for batch in batches:
            held, size = [], 0
            for value in batch["text"]:
                held.append(value)
                size += len(value)
                if size > COUNTED:
                    total += trigrams(" ".join(held))
                    held, size = [], 0
            total += trigrams(" ".join(held))
        found = np.flatnonzero(total)
        yield pd.DataFrame({"gram": found, "n": total[found]})

    return (
        docs.select(whole_text(text).alias("text"))
        .mapInPandas(count, "gram long, n long")
        .groupBy("gram")
        .agg(F.sum("n").alias("n"))
    )


class LetterModel:
    """Costs of letters after two others, smoothed by shorter contexts."""

    def __init__(self, counts: np.ndarray):
        grams = counts.reshape(KINDS, KINDS, KINDS).astype(float)
        one = grams.sum((0, 1)) + 1.0
        one /= one.sum()
        two = grams.sum(0)
        two = (two + 5 * one) / (two.sum(1, keepdims=True) + 5)
        three = (grams + 5 * two[None]) / (grams.sum(2, keepdims=True) + 5)
        self.cost = (-np.log(three)).tolist()


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each character its readings and their costs; an empty reading drops it."""
    found = []
    for k, c in enumerate(token):
        readings = [(c, 0.0)] if c.isalpha() else [(r, SUBSTITUTE) for r in READINGS.get(c, "")]
        if not c.isalpha():
            readings.append(("", FILL if c in FILLERS else DROP if c in READINGS else LEAVE))
        if k and token[k - 1] == c and c not in FILLERS:
            longer = token[k - 2 : k - 1] == c or token[k + 1 : k + 2] == c
            readings.append(("", COLLAPSE if longer else DOUBLE))
        found.append(readings)
    return found


def viterbi(token: str, model: LetterModel, breaks: frozenset[int] = frozenset()) -> str:
    """The likeliest reading of a lower-case token; before the characters numbered in
    `breaks` a word may end and another begin, with a blank in the reading."""
    cost = model.cost
    # a text is its last letter and the text before it, so that long tokens cost no square
    states: dict[tuple[int, int], tuple[float, tuple]] = {(EDGE, EDGE): (0.0, ())}
    for k, readings in enumerate(lattice(token)):
        if k in breaks:
            ended = [(paid + cost[a][b][EDGE], text) for (a, b), (paid, text) in states.items() if b != EDGE]
            if ended:
                paid, text = min(ended, key=lambda e: e[0])
                if (EDGE, EDGE) not in states or paid < states[EDGE, EDGE][0]:
                    states[EDGE, EDGE] = (paid, (text, " "))
        following: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (a, b), (paid, text) in states.items():
            for reading, price in readings:
                if reading:
                    c = kind(reading)
                    state, total, longer = (b, c), paid + price + cost[a][b][c], (text, reading)
                else:
                    state, total, longer = (a, b), paid + price, text
                best = following.get(state)
                if best is None or total < best[0]:
                    following[state] = (total, longer)
        states = following
    text = min(((paid + cost[a][b][EDGE], text) for (a, b), (paid, text) in states.items()), key=lambda e: e[0])[1]
    letters = []
    while text:
        text, letter = text
        letters.append(letter)
    return "".join(reversed(letters))


def read_token(token: str, model: LetterModel) -> tuple[str, ...]:
    """The words a lower-case token stands for, punctuation taken off."""
    if token.isalpha() and not DOUBLE_LETTER.search(token):
        return (token,)
    bare = token.strip(OUTER)
    if ADDRESS.fullmatch(bare):
        return ()
    if len(token) > LONGEST:
        token, bare = (STRETCHED.sub(r"\1\1\1", t) for t in (token, bare))
    if PLAIN.fullmatch(bare) and not TRIPLE.search(bare):
        words = [bare]
        if DOUBLE_LETTER.search(bare):
            words.append(viterbi(bare, model))
        # what was taken off may belong to the word: `$cum`
        if token[0] in READINGS:
            words.append(viterbi(token, model))
        return tuple(dict.fromkeys(words))
    if DISGUISED.search(token) or TRIPLE.search(token):
        return (viterbi(token, model), *(w for w in PLAIN.findall(token) if len(w) > 1))
    return tuple(PLAIN.findall(token))


def _kept(cache: dict, key: str, make):
    """The cached value of a key; the cache starts anew when it is full."""
    found = cache.get(key)
    if found is None:
        if len(cache) > HELD_WORDS:
            cache.clear()
        found = cache[key] = make(key)
    return found


def spaced_runs(tokens: list[str]) -> list[str]:
    """Three or more pieces in a row of one or two letters or signs, with blanks between:
    words may be spelt out in them."""
    found, run = [], []
    for token in [*tokens, ""]:
        if 0 < len(token) < 3 and all(c.isalpha() or c in READINGS for c in token):
            run.append(token)
        else:
            if len(run) >= 3:
                found.append(" ".join(run))
            run = []
    return found


def spaced_words(run: str, model: LetterModel) -> tuple[str, ...]:
    """The words of a spaced run: between its pieces a word goes on or ends."""
    pieces = run.split(" ")
    ends = np.cumsum([len(p) for p in pieces])[:-1]
    return tuple(viterbi("".join(pieces), model, frozenset(ends.tolist())).split())


def restored(text: str, model: LetterModel, cache: dict[str, tuple[str, ...]]) -> list[str]:
    """The lower-case words of a text as read through its disguises, in order, and
    then those that were spelt out letter by letter."""
    tokens = text.lower().split()
    words = [w for t in tokens for w in _kept(cache, t, lambda t: read_token(t, model))]
    for run in spaced_runs(tokens):
        words.extend(("", *_kept(cache, run, lambda r: spaced_words(r, model))))
    return words


# ---------------------------------------------------------------------- features


def features_of(word: str, beginnings: tuple[int, ...]) -> list[str]:
    """The word, and its beginnings with a hyphen."""
    return [word, *(word[:n] + "-" for n in beginnings if len(word) >= n)]


def _counted(rows: DataFrame, model, settings: Settings) -> DataFrame:
    """`feature, toxic, clean`: documents of either label that have the feature."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[str, tuple[str, ...]] = {}
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def flush() -> pd.DataFrame:
            names = list(counts[0].keys() | counts[1].keys())
            frame = pd.DataFrame(
                {
                    "feature": names,
                    "clean": [counts[0][f] for f in names],
                    "toxic": [counts[1][f] for f in names],
                }
            )
            counts[0].clear()
            counts[1].clear()
            return frame

        for batch in batches:
            for text, label in zip(batch["text"], batch["label"], strict=True):
                words = set(restored(text, model.value, cache))
                counts[int(label)].update({f for w in words for f in features_of(w, settings.beginnings)})
                if len(counts[0]) + len(counts[1]) > HELD_WORDS:
                    yield flush()
        if counts[0] or counts[1]:
            yield flush()

    return (
        rows.mapInPandas(count, "feature string, clean long, toxic long")
        .groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )


def _contexts(rows: DataFrame, model, wanted, settings: Settings) -> DataFrame:
    """`word, toxic, clean` of words with a wanted feature: distinct neighbours (word
    before, word after) with which the word occurs. Copies of a document share their
    contexts, so a group of copies counts once and can't make its words look toxic."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache: dict[str, tuple[str, ...]] = {}
        for batch in batches:
            for start in range(0, len(batch), 200):
                part = batch.iloc[start : start + 200]
                found = set()
                for text, label in zip(part["text"], part["label"], strict=True):
                    words = ["", *restored(text, model.value, cache), ""]
                    for k in range(1, len(words) - 1):
                        if not wanted.value.isdisjoint(features_of(words[k], settings.beginnings)):
                            found.add((words[k], f"{words[k - 1]} {words[k + 1]}", int(label)))
                if found:
                    yield pd.DataFrame(found, columns=["word", "context", "label"])

    return (
        rows.mapInPandas(find, "word string, context string, label int")
        .distinct()
        .groupBy("word")
        .agg(
            F.sum(F.lit(1) - F.col("label")).alias("clean"),
            F.sum("label").cast("long").alias("toxic"),
        )
    )


def chosen_features(
    words: list[tuple[str, int, int]], wanted: set[str], share: float, surprise: float, settings: Settings
) -> dict[str, float]:
    """Features and their probabilities from counts of contexts, purest first: what
    a feature explains no longer speaks for others, so that `pat-` does not become
    toxic by `pathetic`. Of equals the more frequent, then the more specific."""
    counts: dict[str, list[int]] = {}
    having: dict[str, set[int]] = {}
    for k, (word, toxic, clean) in enumerate(words):
        for f in wanted.intersection(features_of(word, settings.beginnings)):
            pair = counts.setdefault(f, [0, 0])
            pair[0] += toxic
            pair[1] += clean
            having.setdefault(f, set()).add(k)

    def worth(f: str) -> tuple:
        toxic, clean = counts[f]
        return toxic / max(1, toxic + clean), toxic, not f.endswith("-"), len(f), f

    found: dict[str, float] = {}
    heap = [(tuple(-x for x in worth(f)[:4]), f) for f in counts]
    heapq.heapify(heap)
    explained: set[int] = set()
    while heap:
        key, f = heapq.heappop(heap)
        now = tuple(-x for x in worth(f)[:4])
        if now > key:  # it has lost words since it was put here
            heapq.heappush(heap, (now, f))
            continue
        toxic, clean = counts[f]
        if toxic < settings.purity * (toxic + clean) or not toxic:
            break
        if surprising(toxic, clean, share) <= surprise:
            continue
        found[f] = toxic / (toxic + clean + 1.0)
        for k in having[f] - explained:
            explained.add(k)
            word, t, c = words[k]
            for other in wanted.intersection(features_of(word, settings.beginnings)):
                counts[other][0] -= t
                counts[other][1] -= c
    return found


def surprising(toxic: int, clean: int, share: float) -> float:
    """The negative logarithm of a bound (Chernoff) on the chance that so many of
    these occurrences are toxic by accident, where `share` of all are."""
    both = toxic + clean
    part = toxic / both if both else 0.0
    if part <= share:
        return 0.0
    rest = (1 - part) * math.log((1 - part) / (1 - share)) if part < 1 else 0.0
    return both * (part * math.log(part / share) + rest)


@dataclass(frozen=True)
class ToxicityModel:
    """The letter model, the probability of each toxic feature, and the base score."""

    letters: LetterModel
    toxic: dict[str, float]
    base: float
    settings: Settings

    @cached_property
    def openings(self) -> set[str]:
        """The first three letters of all features: what most words do not have."""
        return {f.removesuffix("-")[:3] for f in self.toxic}

    @cached_property
    def squeezed(self) -> set[str]:
        """The first two letters of all features, or one, repeated letters squeezed:
        only words that begin like this have readings of doubled letters that count."""
        return {REPEATED.sub(r"\1", f.removesuffix("-"))[:2] for f in self.toxic}

    def evidence(self, words: tuple[str, ...]) -> tuple[tuple[str, float], ...]:
        """The toxic ones of some words, with their probabilities."""
        found = []
        for word in words:
            likely = max(self.toxic.get(f, 0.0) for f in features_of(word, self.settings.beginnings))
            if likely:
                found.append((word, likely))
        return tuple(found)

    def score(self, text: str, cache: dict[str, tuple[tuple[str, float], ...]]) -> float:
        """Noisy or over the distinct restored words of a text."""
        lowered = text.lower()
        tokens = lowered.split()
        toxic: dict[str, float] = {}
        openings, squeezed = self.openings, self.squeezed
        for token in set(tokens):
            if not token.isalpha():
                found = _kept(cache, token, lambda t: self.evidence(read_token(t, self.letters)))
            else:
                found = self.evidence((token,)) if token[:3] in openings else None
                if DOUBLE_LETTER.search(token):
                    opening = REPEATED.sub(r"\1", token)[:2]
                    if opening in squeezed or opening[:1] in squeezed:
                        found = _kept(cache, token, lambda t: self.evidence(read_token(t, self.letters)))
            if found:
                toxic.update(found)
        for run in spaced_runs(tokens):
            toxic.update(_kept(cache, run, lambda r: self.evidence(spaced_words(r, self.letters))))
        clean = 1.0 - self.base
        for word in sorted(toxic):
            clean *= 1.0 - toxic[word]
        return 1.0 - clean


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    settings: Settings = SETTINGS,
) -> ToxicityModel:
    """A model from all documents (letters) and a bounded sample of labelled ones.

    A feature is kept if it is in at least `support` toxic documents and so rarely in
    clean ones that this would hardly arise by accident, counted in documents and again
    in distinct contexts, which also give its probability. Without labelled rows of both
    kinds there are no features and every text scores the base.
    """
    ready_for_python(docs)
    spark = docs.sparkSession
    counts = np.zeros(KINDS**3, np.int64)
    for row in letter_counts(docs, text).collect():  # at most 28^3 rows
        counts[row["gram"]] = row["n"]
    letters = LetterModel(counts)
    known = written(
        training_labels(labels, "toxic", PARTS, HELD, bound=settings.labelled), "toxic-labels"
    )
    sums = known.agg(F.count("*").alias("n"), F.sum("label").alias("ones")).first()
    total, ones = sums["n"], sums["ones"] or 0
    share = ones / total if total else 0.0
    base = 0.02
    if not ones or ones == total:
        return ToxicityModel(letters, {}, base, settings)
    few = bounded_broadcast(known, total, 2 * settings.labelled)
    rows = written(
        docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text"))
        .join(few, F.col("doc_id") == F.col("label_id"))
        .select("text", "label"),
        "toxic-rows",
    )
    shared = spark.sparkContext.broadcast(letters)
    counted = written(_counted(rows, shared, settings), "toxic-features")
    tested = counted.where(F.col("toxic") + F.col("clean") >= settings.support).count()
    surprise = math.log(max(1, tested) / settings.accident)
    both = F.col("toxic") + F.col("clean")
    part = F.col("toxic") / both
    rest = F.when(part < 1, (1 - part) * F.log((1 - part) / (1 - share))).otherwise(0.0)
    telling = (
        counted.where(F.col("toxic") >= settings.support)
        .where((part > share) & (part >= settings.purity / 2))
        .where(both * (part * F.log(part / share) + rest) > surprise)
        .orderBy(F.desc("toxic"), "feature")
        .limit(settings.features)
    )
    wanted = {r["feature"] for r in telling.select("feature").collect()}
    toxic: dict[str, float] = {}
    if wanted:
        found = _contexts(rows, shared, spark.sparkContext.broadcast(wanted), settings)
        seen = [(r["word"], r["toxic"], r["clean"]) for r in found.collect()]  # of the sample
        toxic = chosen_features(sorted(seen), wanted, share, surprise, settings)
    return ToxicityModel(letters, toxic, base, settings)


def toxicity_score(model: ToxicityModel, text: Column, df: DataFrame) -> Column:
    ready_for_python(df)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache: dict = {}
        for texts in batches:
            yield pd.Series([shared.value.score(t, cache) for t in texts], dtype=float)

    return scores(whole_text(text))


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    settings: Settings = SETTINGS,
) -> DataFrame:
    """`doc_id, held_out, score, predicted` for every row of the documents.

    A null text is an empty one; texts without words get the base score. A null id is
    never held out and never labelled. Repeated rows are scored alike. With empty
    tables there are no rows, with no usable labels every text gets the base score.
    """
    model = fit(docs, labels, doc_id, text, settings)
    return docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(remainder(F.col(doc_id), PARTS) == HELD, F.lit(False)).alias("held_out"),
        toxicity_score(model, F.col(text), docs).alias("score"),
    ).withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))


def keep_clean(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = SETTINGS
) -> DataFrame:
    """The rows of the documents that are not judged toxic, as they are."""
    model = fit(docs, labels, doc_id, text, settings)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return (
        docs.select(row, toxicity_score(model, F.col(text), docs).alias("score"))
        .where(F.col("score") < TOXIC_FROM)
        .select("row.*")
    )
