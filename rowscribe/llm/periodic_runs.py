"""Periodic runs of words, by seeds that are extended along diagonals.

A run of smallest period q and length n has n - q words that equal the word q
places further on: that many, `overlap(q)`, a run has at the least. Lags are
taken in classes from one power of two up to the next, and for each class the
k-grams of the least overlap in it are indexed. In a run they are at least as
long as its period, so the next occurrence of the k-gram where the run starts
is exactly one period on (a nearer one would make the period smaller). Hence
only neighbouring occurrences in a document, whose distance is in the class,
are paired; pairs of a k-gram are never enumerated all with all.

A pair at lag q is extended to both sides as far as words equal those q places
on. A table holds for each lag how far it is covered, so the other pairs of
the same run are not extended again.

Grams are numbered exactly, by doubling: those of 2k words by the numbers of
their halves. Documents are looked at together in batches; words of different
documents have different numbers, so nothing crosses them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowscribe.llm.common import let, pick, rows_of

#: A run has at least so many words, and so many times its period; the proof above needs 3 periods.
LENGTH, PERIODS = 6, 4
#: Words that are looked at together, unless one text has more.
BATCH_WORDS = 250_000
#: The expression of a word, plainly.
WORD = r"[^\x20\x09-\x0D]+"

RUN = "struct<start:long,length:long,period:long>"


def overlap(lag: int, length: int = LENGTH, periods: int = PERIODS) -> int:
    """Words of a run with this period that equal the word a period on, at the least."""
    return max(length, periods * lag) - lag


def classes(longest: int, length: int = LENGTH, periods: int = PERIODS) -> Iterator[tuple[int, int, int]]:
    """(least lag, lag to stop before, words of a seed), for texts of up to `longest` words."""
    low, turn = 1, length // periods
    while max(length, periods * low) <= longest:
        # The overlap falls with the lag up to the turn, and rises after it.
        least = {min(max(q, low), 2 * low - 1) for q in (low, turn, turn + 1)}
        yield low, 2 * low, min(overlap(q, length, periods) for q in least)
        low *= 2


def repeated(places: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the places, those whose pair of numbers (negative ones stand for what is found
    nowhere else) is found twice or more, and new numbers that are equal where the pairs are."""
    both = (left >= 0) & (right >= 0)
    places, left, right = places[both], left[both], right[both]
    number = np.unique(left * (int(right.max(initial=0)) + 1) + right, return_inverse=True)[1].reshape(-1)
    often = np.bincount(number)[number] > 1 if len(number) else np.zeros(0, bool)
    return places[often], number[often]


class Grams:
    """Numbers of the grams of a power of two words at the places where they start; those
    that are found once have none, nor have longer grams there."""

    def __init__(self, words: np.ndarray) -> None:
        self.power = [words]

    def doubled(self, level: int) -> np.ndarray:
        while len(self.power) <= level:
            last, half = self.power[-1], 1 << (len(self.power) - 1)
            left, right = last[: max(0, len(last) - half)], last[half:]
            places, number = repeated(np.arange(len(left)), left, right)
            self.power.append(np.full(len(left), -1))
            self.power[-1][places] = number
        return self.power[level]

    def of(self, size: int, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the places, those whose gram of `size` words is found twice or more, and its
        numbers: two overlapping grams of a power of two make one."""
        level = size.bit_length() - 1
        half = self.doubled(level)
        return repeated(places, half[places], half[places + size - (1 << level)])


def matched(words: np.ndarray, at: int, lag: int, step: int) -> int:
    """The number of places from `at` on, in direction `step`, whose word equals that at `lag` further on."""
    n, size = 0, 32
    last = len(words) - lag
    while True:
        low, high = (at + n, min(at + n + size, last)) if step > 0 else (max(at - n - size + 1, 0), at - n + 1)
        if low >= high:
            return n
        equal = words[low:high] == words[low + lag : high + lag]
        if step < 0:
            equal = equal[::-1]
        stop = int(equal.argmin())
        if not equal[stop]:
            return n + stop
        n, size = n + high - low, min(2 * size, 1 << 16)


def find_runs(words: np.ndarray, longest: int, length: int = LENGTH, periods: int = PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run in a list of numbers, by start and period."""
    out = []
    grams = Grams(words)
    places, before = np.arange(len(words)), 0
    for low, high, size in classes(longest, length, periods):
        if size < before:
            places = np.arange(len(words))
        before = size
        places = places[: np.searchsorted(places, len(words) - size, "right")]
        if not len(places):
            break
        # Longer grams repeat only where this one does.
        places, number = grams.of(size, places)
        order = np.argsort(number, kind="stable")
        found, at = number[order], places[order]
        lags = np.diff(at)
        seeds = np.flatnonzero((found[1:] == found[:-1]) & (lags >= low) & (lags < high))
        seeds = seeds[np.lexsort((at[seeds], lags[seeds]))]
        # How far each lag is covered; places ascend within a lag.
        covered: dict[int, int] = {}
        for start, lag in zip(at[seeds].tolist(), lags[seeds].tolist()):
            if start < covered.get(lag, 0):
                continue
            end = start + size + matched(words, start + size, lag, 1)
            covered[lag] = end
            first = start - matched(words, start - 1, lag, -1)
            if end - first >= overlap(lag, length, periods):
                out.append((first, end - first + lag, lag))
    return sorted(out, key=lambda run: (run[0], run[2]))


def collapsed(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay: those in no run after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, size, period in runs:
        change[start + period] += 1
        change[start + size] -= 1
    return np.cumsum(change)[:n] == 0


def periodic_runs(df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, periods: int = PERIODS) -> DataFrame:
    """(doc_id, runs, kept) of every whole text: its runs of `length` words and `periods`
    periods at least, by start and period, and the words that are in no run after its first
    period, joined by single blanks.

    A null, empty or blank text has no runs and an empty `kept`. Rows are not compared, so
    repeated and null ids stay as they are; other columns are left out. An empty table
    gives no rows. A text is held by one task, with some eighty bytes for each of its words.
    """
    if periods < 3:
        raise ValueError("seeds find runs of three periods or more")

    def run(batches):
        for batch in rows_of(batches):
            yield from _grouped(batch, length, periods)

    docs = pick(df, doc_id=doc_id, text=text)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, f"doc_id long, runs array<{RUN}>, kept string")


def _grouped(batch: list[list], length: int, periods: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0
    for doc_id, text in zip(*batch):
        # Bytes are split at exactly the six characters that separate words.
        held.append((doc_id, (text or "").encode().split()))
        size += len(held[-1][1])
        if size >= BATCH_WORDS:
            yield _results(held, length, periods)
            held, size = [], 0
    if held:
        yield _results(held, length, periods)


def _results(held: list[tuple], length: int, periods: int) -> pa.RecordBatch:
    sizes = np.array([len(words) for _, words in held])
    ends = np.cumsum(sizes)
    numbers = np.empty(int(ends[-1]), np.int64)
    for (_, words), end in zip(held, ends):
        own: dict[bytes, int] = {}
        first = end - len(words)
        # Numbers of a document start where the places of its words do, so they are its own.
        numbers[first:end] = [own.setdefault(word, first + len(own)) for word in words]
    runs: list[list] = [[] for _ in held]
    for start, size, period in find_runs(numbers, int(sizes.max(initial=0)), length, periods):
        owner = int(np.searchsorted(ends, start, "right"))
        runs[owner].append((start - int(ends[owner] - sizes[owner]), size, period))
    kept = []
    for (_, words), own in zip(held, runs):
        if own:
            stay = collapsed(len(words), own)
            words = [word for word, keep in zip(words, stay) if keep]
        kept.append(b" ".join(words).decode())
    as_rows = [[{"start": s, "length": n, "period": p} for s, n, p in own] for own in runs]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    return pa.RecordBatch.from_arrays(
        [pa.array([key for key, _ in held], pa.int64()), pa.array(as_rows, kind), pa.array(kept, pa.string())], ["doc_id", "runs", "kept"]
    )


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period, of equals the one that starts first,
    then that with the smallest period; null without runs. Expects them by start and period."""
    larger = lambda a, b: b["length"] * a["period"] > a["length"] * b["period"]
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, run: F.when(larger(best, run), run).otherwise(best))


def with_planted_runs(doc_id: Column, text: Column) -> Column:
    """The text of a document, of which the contract repeats a part of the words in one of ten: with h the crc32
    of the decimal id, g = h div 10 and n words, where h % 10 = 0 and n > 0, words from a = g % n on are repeated with
    period 1 + (n - a) div (3 + g % 8). Other texts, and those with a null id, stay as they are."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        def from_place(plan: Column) -> Column:
            at = lambda i: F.when(i < plan["a"], i).otherwise(plan["a"] + (i - plan["a"]) % plan["p"])
            return F.array_join(F.transform(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, at(i).cast("int"))), " ")

        a = g % F.size(words)
        p = 1 + F.floor((F.size(words) - a) / (3 + g % 8))
        return F.when(F.size(words) > 0, let(F.struct(a.alias("a"), p.alias("p")), from_place)).otherwise(text)

    return F.when(h % 10 == 0, let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), repeated)).otherwise(text)
