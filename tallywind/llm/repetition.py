"""Quality rules on repetition: how much of a text lies in repeated n-grams and lines.

Words become numbers, n-grams become hashes of these numbers, mixed by doubling from
shorter windows, all in numpy, one text at a time. Long n-grams count wherever they
return; short ones, which return in any text, where they follow themselves, as in the
stutter of generated junk (`so so much so much`). A character counts once however many duplicated
n-grams cover it. 64-bit hashes stand for the n-grams: two different ones of a text
with m n-grams collide with a chance of about m * m / 2^65.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywind.llm.common import ready_for_python, whole_text

SYMBOLS = b"#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class Limits:
    """Largest shares of a text's word characters that may lie in n-grams, by length,
    and in lines that repeat an earlier one: what stands there for the first time is
    not counted. The limits are widely used ones for web text."""

    grams: dict[int, float] = field(
        default_factory=lambda: {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
    )
    lines: float = 0.20
    #: Lengths of n-grams that count where they follow themselves, and their limit together.
    stutter: tuple[int, ...] = (1, 2, 3, 4)
    stuttered: float = 0.20
    least_words: int = 10
    repeated_percent: int = 20


LIMITS = Limits()

COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "line_share double, stutter_share double, gram_shares array<double>"
)

_MIX = np.uint64(0x9E3779B97F4A7C15)


def rolling_hashes(numbers: np.ndarray, n: int) -> np.ndarray:
    """A hash for each window of n words, by doubling from shorter windows."""
    with np.errstate(over="ignore"):
        result, length, step, have = None, 0, numbers, 1
        while True:
            if n & have:
                if result is None:
                    result, length = step, have
                else:
                    keep = len(numbers) - length - have + 1
                    result = _joined(result[:keep], step[length : length + keep])
                    length += have
            if length == n:
                return result
            keep = len(step) - have
            step = _joined(step[:keep], step[have : have + keep])
            have *= 2


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = (left ^ (left >> np.uint64(29))) * _MIX + right
    mixed ^= mixed >> np.uint64(32)
    return mixed * _MIX


def duplicated(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """True for each window that occurs twice or more, and for each that occurred
    before."""
    order = np.argsort(hashes)
    ranked = hashes[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(hashes), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    later = twice.copy()
    if same.any():
        later[np.minimum.reduceat(order, np.flatnonzero(np.append(True, ~same)))] = False
    return twice, later


def covered(starts: np.ndarray, n: int, words: int) -> np.ndarray:
    """True for each word inside a marked window of n words."""
    steps = np.zeros(words + 1, np.int64)
    at = np.flatnonzero(starts)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + n, -1)
    return np.cumsum(steps[:-1]) > 0


def stuttered(numbers: np.ndarray, lengths: tuple[int, ...]) -> np.ndarray:
    """True for each word inside an n-gram that repeats the one right before it."""
    found = np.zeros(len(numbers), bool)
    for n in lengths:
        if len(numbers) >= 2 * n:
            hashes = rolling_hashes(numbers, n)
            again = np.append(np.zeros(n, bool), hashes[n:] == hashes[:-n])
            found |= covered(again, n, len(numbers))
    return found


def measure(text: str, lengths: tuple[int, ...], stutter: tuple[int, ...] = ()) -> tuple:
    """The columns of COLUMNS for one text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    count = len(words)
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    if not count:
        return 0, 0, symbols, 0, 0, 0.0, 0.0, [0.0] * len(lengths)
    if raw.isascii():
        sizes = np.fromiter(map(len, words), np.int64, count)
    else:
        sizes = np.fromiter((len(w.decode("utf-8", "surrogatepass")) for w in words), np.int64, count)
    total = int(sizes.sum())
    named: dict[bytes, int] = {}
    numbers = np.fromiter((named.setdefault(w, len(named)) for w in words), np.uint64, count)
    with np.errstate(over="ignore"):
        numbers = (numbers + np.uint64(1)) * _MIX
    seen: set[bytes] = set()
    dup_lines = dup_chars = 0
    for line in raw.split(b"\n"):
        inside = line.split()
        if not inside:
            continue
        if line in seen:
            dup_lines += 1
            dup_chars += len(b"".join(inside).decode("utf-8", "surrogatepass"))
        else:
            seen.add(line)
    repeat_words, shares = 0, []
    for n in sorted({WINDOW, *lengths}):
        twice, later = duplicated(rolling_hashes(numbers, n)) if count > n else (None, None)
        if n == WINDOW and twice is not None and twice.any():
            repeat_words = int(covered(twice, n, count).sum())
        if n in lengths:
            again = later is not None and later.any()
            shares.append(float(sizes[covered(later, n, count)].sum()) / total if again else 0.0)
    stutters = float(sizes[stuttered(numbers, stutter)].sum()) / total
    return count, total, symbols, dup_lines, repeat_words, dup_chars / total, stutters, shares


def repetition(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", limits: Limits = LIMITS
) -> DataFrame:
    """`doc_id`, the columns of COLUMNS, `base_failed` and `kept` for every row.

    A null text has no words; a text without words has no repetition but fails the
    base rule on its length. Repeated rows are measured alike, repeats across
    documents do not count, and an empty table gives no rows. Memory is bounded by
    the longest text.
    """
    ready_for_python(docs)
    lengths = tuple(sorted(limits.grams))

    @F.pandas_udf(f"struct<{COLUMNS.replace(' long', ':long').replace(' double', ':double').replace(' array', ':array')}>")
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in COLUMNS.split(", ")]
        for texts in batches:
            rows = [measure(t, lengths, limits.stutter) for t in texts]
            yield pd.DataFrame(rows, columns=names)

    found = docs.select(
        F.col(doc_id).alias("doc_id"), measured(whole_text(text)).alias("m")
    ).select("doc_id", "m.*")
    failed = (F.col("n_words") < limits.least_words) | (
        100 * F.col("n_repeat_words") > limits.repeated_percent * F.col("n_words")
    )
    over = (F.col("line_share") > limits.lines) | (F.col("stutter_share") > limits.stuttered)
    for k, n in enumerate(lengths):
        over = over | (F.col("gram_shares")[k] > limits.grams[n])
    return found.withColumn("base_failed", failed).withColumn("kept", ~failed & ~over)
