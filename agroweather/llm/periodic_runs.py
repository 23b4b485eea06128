"""Periodic run detection (operator 12): stretches of words that repeat themselves.

A run is a stretch of words with smallest period q (words q apart are
identical), at least ``least`` words and ``exponent`` periods long, that cannot
be extended on either side keeping q. Its words past the first period are the
repetition; :func:`periodic_runs` gives the runs and the text without them.

Method: seed and extend. On its diagonal (word i against word i + q) a run
matches over at least ``max(least - q, (exponent - 1) * q)`` words, so it holds
two equal k-grams q words apart as long as k is not over that. Grams are indexed
at k = the least such overlap, rounded down to a power of two, then at 2k, 4k
and so on for the lags from k/2 to k: as k is at least the lag, the next
occurrence of a gram inside a run is exactly one smallest period away, so
neighbouring occurrences in the same document are all the pairs that matter
and their number is linear. A pair is extended along its lag in both
directions; per lag the furthest covered word is kept, and pairs below it are
skipped. A gram of 2k words is named by the names of its halves; words whose
gram occurs once in the document leave the index for good, so ordinary prose
is gone after a few levels. Names are exact, nothing is hashed.

Rows are independent: one map, no shuffle. Memory follows the longest text.

Defined results: a NULL text has no words, like an empty or blank one, hence no
runs and an empty rest; a NULL id stays NULL; repeated rows give repeated rows;
runs may overlap, and a word inside any run past that run's first period is
dropped; an empty table gives an empty table; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agroweather.llm.common import slices

LEAST = 24  # words of a run
EXPONENT = 3  # periods of a run
# The separators of words.
BLANKS = b" \t\n\x0b\x0c\r"
WORD_BREAK = r"[\x20\x09-\x0D]+"

Run = tuple[int, int, int]
FOUND = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def first_gram(least: int, exponent: int) -> int:
    """The greatest power of two that every run's diagonal is sure to hold."""
    overlap = min(max(least - q, (exponent - 1) * q) for q in range(1, least + 1))
    return 1 << (max(overlap, 1).bit_length() - 1)


def split_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, and where each text's words begin and end among them."""
    texts = pc.fill_null(column.cast(pa.large_binary()), b"")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    letters = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data else np.zeros(0, np.uint8)
    bounds = bounds - bounds[0]
    blank = np.zeros(256, bool)
    blank[list(BLANKS)] = True
    inside = ~blank[letters]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = bounds[:-1][bounds[:-1] < bounds[1:]]
    begins[heads] = inside[heads]  # a text's first word touches the text before it
    starts = np.flatnonzero(begins)
    kept = np.concatenate([[0], np.cumsum(inside)])  # letters of words before a place
    offsets = np.append(kept[starts], kept[-1]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters[inside])]
    )
    return words, np.searchsorted(starts, bounds)


def repeated(keys: np.ndarray, places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Names by place (-1: none) for the keys held more than once, and their places."""
    _, names, counts = np.unique(keys, return_inverse=True, return_counts=True)
    often = counts[names] > 1
    named = np.full(size, -1, np.int64)
    named[places[often]] = names[often]
    return named, places[often]


def same_until(words: np.ndarray, at: int, lag: int, stop: int) -> int:
    """The first place from ``at`` whose word differs from the one ``lag`` on, or ``stop``."""
    step = 32
    while at < stop:
        until = min(at + step, stop)
        other = words[at:until] != words[at + lag : until + lag]
        if other.any():
            return at + int(other.argmax())
        at, step = until, step * 2
    return stop


def same_from(words: np.ndarray, at: int, lag: int, stop: int) -> int:
    """The first place of the matching stretch that ends before ``at``, not below ``stop``."""
    step = 32
    while at > stop:
        until = max(at - step, stop)
        other = words[until:at] != words[until + lag : at + lag]
        if other.any():
            return at - int(other[::-1].argmax())
        at, step = until, step * 2
    return stop


def find_runs(words: np.ndarray, ends: np.ndarray, least: int, exponent: int) -> list[list[Run]]:
    """The runs ``(start, length, period)`` of each text of ``words`` (numbers), by start and period.

    Text t is ``words[ends[t]:ends[t + 1]]``.
    """
    runs: list[list[Run]] = [[] for _ in range(len(ends) - 1)]
    size = len(words)
    if not size:
        return runs
    text = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    names, places = repeated(text * (int(words.max()) + 1) + words, np.arange(size), size)
    gram, first = 1, first_gram(least, exponent)
    while len(places):
        if gram >= first:
            _extend_seeds(words, text, ends, names, places, gram, gram == first, runs, least, exponent)
        halves = places[places + 2 * gram <= ends[text[places] + 1]]
        halves = halves[names[halves + gram] >= 0]
        if not len(halves):
            break
        keys = names[halves] * (int(names.max()) + 1) + names[halves + gram]
        names, places = repeated(keys, halves, size)
        gram *= 2
    for found in runs:
        found.sort(key=lambda run: (run[0], run[2]))
    return runs


def _extend_seeds(words, text, ends, names, places, gram, is_first, runs, least, exponent) -> None:
    """Neighbouring occurrences of a gram, extended along their lags."""
    order = places[np.argsort(names[places], kind="stable")]
    lags = order[1:] - order[:-1]
    seeds = (names[order[1:]] == names[order[:-1]]) & (lags <= gram)
    if not is_first:
        seeds &= lags > gram // 2
    places, lags = order[:-1][seeds], lags[seeds]
    by_place = np.argsort(places, kind="stable")
    covered: dict[int, int] = {}
    for at, lag in zip(places[by_place].tolist(), lags[by_place].tolist(), strict=True):
        if at < covered.get(lag, 0):
            continue
        t = int(text[at])
        stop = same_until(words, at + gram, lag, int(ends[t + 1]) - lag)
        start = same_from(words, at, lag, int(ends[t]))
        covered[lag] = stop
        length = stop - start + lag
        if length >= max(least, exponent * lag):
            runs[t].append((start - int(ends[t]), length, lag))


def periodic_runs(docs: DataFrame, *, least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """Rows ``doc_id, runs, collapsed``: the runs of each whole text and its kept words, one blank between."""
    if least < 1 or exponent < 3:
        raise ValueError("a run has a word at least and three periods or more")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
        for batch in slices(batches):
            words, ends = split_words(batch.column(1))
            numbers = words.dictionary_encode().indices.to_numpy().astype(np.int64)
            found = find_runs(numbers, ends, least, exponent)
            kept = np.ones(len(numbers), bool)
            for t, runs in enumerate(found):
                for start, length, period in runs:
                    kept[ends[t] + start + period : ends[t] + start + length] = False
            kept_ends = np.concatenate([[0], np.cumsum(kept)])[ends]
            if not kept.all():
                words = words.filter(pa.array(kept))
            lists = pa.LargeListArray.from_arrays(pa.array(kept_ends, pa.int64()), words)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([[dict(zip(kind.names, r, strict=True)) for r in runs] for runs in found], pa.list_(kind)),
                    pc.binary_join(lists, pa.scalar(b" ", pa.large_binary())).cast(pa.large_string()).cast(pa.string()),
                ],
                names=["doc_id", "runs", "collapsed"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, FOUND)


def longest_power(runs: Column) -> Column:
    """The run of greatest exact ``length / period``; of equal ones the first by start, then period."""
    empty = F.lit(None).cast("struct<start: long, length: long, period: long>")
    return F.aggregate(
        runs,
        empty,
        lambda best, run: F.when(
            best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run
        ).otherwise(best),
    )


def run_report(docs: DataFrame) -> DataFrame:
    """Per document the number of runs, the strongest one, and digests of all runs and of the rest."""
    best = F.col("best")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return (
        periodic_runs(docs)
        .withColumn("best", longest_power(F.col("runs")))
        .select(
            "doc_id",
            F.size("runs").cast("long").alias("n_runs"),
            best["start"].alias("start"),
            best["length"].alias("length"),
            best["period"].alias("period"),
            F.expr("1000 * best.length div best.period").alias("exponent_milli"),
            F.sha2(F.concat_ws("", F.transform(lines, lambda x: F.concat(x, F.lit("\n")))), 256).alias("runs_sha256"),
            F.sha2("collapsed", 256).alias("collapsed_sha256"),
        )
    )


def plant_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with a loop written into every document whose id's CRC-32 is divisible by ten.

    With g a tenth of that number, words from ``a = g % n`` on repeat the
    ``1 + (n - a) / (3 + g % 8)`` words that begin there. A NULL id gets no loop.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", WORD_BREAK), lambda w: w != "")
    looped = F.transform(
        F.col("words"),
        lambda w, i: F.when(i < F.col("a"), w).otherwise(
            F.get("words", (F.col("a") + F.pmod(i - F.col("a"), F.col("p"))).cast("int"))
        ),
    )
    return (
        docs.select("doc_id", "text", h.alias("h"))
        .withColumn("words", F.when((F.col("h") % 10 == 0) & (F.col("text") != ""), words))
        .withColumn("n", F.size("words").cast("long"))
        .withColumn("g", F.expr("h div 10"))
        .withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
        .withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
        .select("doc_id", F.when(F.col("a").isNull(), F.col("text")).otherwise(F.array_join(looped, " ")).alias("text"))
    )
