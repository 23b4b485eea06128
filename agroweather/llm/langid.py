"""Language identification (operator 2).

Method: sparse multinomial logistic regression on TF-IDF weights of character
1- to 3-grams, trained with follow-the-regularised-leader (per-coordinate
rates, elastic-net penalty) and calibrated by a temperature on rows left out of
the training. Document frequencies are counted over all training documents;
the weights are fitted on a bounded sample of them, ``SAMPLE_PER_LANGUAGE``
rows a language chosen by a hash of the id, ``SAMPLE_BYTES`` of text at most.
Scoring is one map.

Training rows have a text and a language and are outside the held-out fold.
Predictions use the text alone.

Defined results: a text that is NULL or has no letter is ``und`` with score 0;
without any training row everything is ``und``; a NULL id stays NULL and is not
held out (``held_out`` false); repeated rows give repeated rows; an empty table
gives an empty table; further columns are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroweather.llm.common import bounded_sample, fold, in_fold, slices, stored

FOLDS, HELD_OUT = 3, 1
BUCKETS = 1 << 15
SAMPLE_PER_LANGUAGE = 1000
SAMPLE_BYTES = 16 << 20  # of a language's sampled texts together; none over a 64th of it
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
CALIBRATION_SHARE = 5  # one in five sample rows sets the temperature
UNKNOWN = "und"

PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"
_PRIMES = tuple(np.uint32(prime) for prime in (2654435761, 2246822519, 3266489917))


def letter_table() -> np.ndarray:
    return np.fromiter(
        (chr(point).isalpha() for point in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1
    )


def gram_counts(text: str, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Hash buckets of the 1- to 3-grams of letters and word breaks, and their counts."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    is_letter = letters[points]
    if not is_letter.any():
        return None
    points = np.where(is_letter, points, np.uint32(32))
    keep = is_letter | np.concatenate([[True], is_letter[:-1]])  # one blank per break
    points = np.concatenate([[np.uint32(32)], points[keep], [np.uint32(32)]]).astype(np.uint32)
    code, parts = np.zeros(len(points), np.uint32), []
    for size in range(1, 4):
        if len(points) < size:
            break
        code = code[: len(points) - size + 1] + points[size - 1 :] * _PRIMES[size - 1]
        mixed = code ^ (code >> np.uint32(15))
        parts.append((mixed * np.uint32(2246822507)) >> np.uint32(17))
    counts = np.bincount(np.concatenate(parts), minlength=BUCKETS)
    used = np.flatnonzero(counts)
    return used, counts[used]


def weights(used: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = (1.0 + np.log(counts)) * idf[used]
    norm = np.sqrt(values @ values)
    return values / norm if norm > 0 else values


def document_frequencies(train: DataFrame) -> tuple[np.ndarray, int]:
    """Documents per bucket over all of ``train`` (one text column), and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, seen, rows = letter_table(), np.zeros(BUCKETS, np.int64), 0
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                grams = gram_counts(text, letters)
                if grams:
                    seen[grams[0]] += 1
                    rows += 1
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*used.tolist(), -1]), pa.array([*seen[used].tolist(), rows])],
            names=["bucket", "n"],
        )

    total = train.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    frequencies, rows = np.zeros(BUCKETS), 0
    for bucket, n in total.collect():  # at most BUCKETS + 1 rows
        if bucket < 0:
            rows = n
        else:
            frequencies[bucket] = n
    return frequencies, rows


def sample_rows(train: DataFrame, per_language: int) -> list[tuple]:
    """At most ``per_language`` rows of each language, those with the smallest hashed ids.

    The languages are counted first, so that most texts go before any is shuffled.
    """
    sizes = stored(train.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")), "languages")
    share = (1.5 * per_language + 20) / F.col("rows")
    near = train.join(sizes, "lang").where(F.col("order") <= share * ((1 << 31) - 1))
    sample = bounded_sample(near.select("lang", "order", "text"), "lang", per_language, SAMPLE_BYTES)
    return [tuple(row) for row in sample.select("lang", "text", "order").collect()]


def fit(rows: list[tuple], idf: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, float]:
    """Languages, weights (bucket by language), biases and temperature."""
    letters = letter_table()
    langs = sorted({row[0] for row in rows})
    place = {lang: index for index, lang in enumerate(langs)}
    made = []
    for lang, text, order in sorted(rows, key=lambda row: (row[2], row[0], row[1])):
        grams = gram_counts(text, letters)
        if grams:
            made.append((place[lang], grams[0], weights(*grams, idf)))
    if not made:
        return [], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0
    k = len(langs)
    z, n = np.zeros((BUCKETS + 1, k)), np.zeros((BUCKETS + 1, k))

    def leader(at: np.ndarray) -> np.ndarray:
        zs = z[at]
        shrunk = np.sign(zs) * np.maximum(np.abs(zs) - L1, 0.0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    calibration = made[::CALIBRATION_SHARE] if len(made) >= 2 * CALIBRATION_SHARE else made
    training = [row for i, row in enumerate(made) if i % CALIBRATION_SHARE] or made
    for _ in range(EPOCHS):
        for target, used, values in training:
            at, x = np.append(used, BUCKETS), np.append(values, 1.0)
            w = leader(at)
            logits = x @ w
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[target] -= 1.0
            g = x[:, None] * p[None, :]
            old = n[at]
            new = old + g * g
            z[at] += g - (np.sqrt(new) - np.sqrt(old)) / ALPHA * w
            n[at] = new
    w = leader(np.arange(BUCKETS + 1))
    logits = np.array([values @ w[used] + w[BUCKETS] for _, used, values in calibration])
    logits = logits.reshape(-1, k)
    targets = np.array([target for target, _, _ in calibration], dtype=int)

    def loss(temperature: float) -> float:
        scaled = logits / temperature
        scaled -= scaled.max(axis=1, keepdims=True)
        return float(
            np.mean(np.log(np.exp(scaled).sum(axis=1)) - scaled[np.arange(len(targets)), targets])
        )

    temperature = min(np.geomspace(0.05, 20, 121), key=loss)
    return langs, w[:BUCKETS], w[BUCKETS], float(temperature)


def identify_language(docs: DataFrame, *, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``, ``lang``) the predicted language and its score."""
    spark = docs.sparkSession
    known = docs.select(F.col("doc_id").cast("long"), "text", F.col("lang").cast("string"))
    train = known.where(
        F.col("text").isNotNull()
        & F.col("lang").isNotNull()
        & ~F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    ).select(
        "lang", "text", F.pmod(F.xxhash64("doc_id", "text"), F.lit((1 << 31) - 1)).alias("order")
    )
    frequencies, rows = document_frequencies(train.select("text"))
    idf = np.log((1.0 + rows) / (1.0 + frequencies)) + 1.0
    model = fit(sample_rows(train, per_language), idf)
    shared = spark.sparkContext.broadcast((idf, *model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_table()
        idf, langs, w, bias, temperature = shared.value
        for batch in slices(batches):
            ids, names, scores = batch.column(0), [], []
            for text in batch.column(1).to_pylist():
                grams = gram_counts(text, letters) if text and langs else None
                if grams is None:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                logits = (weights(*grams, idf) @ w[grams[0]] + bias) / temperature
                p = np.exp(logits - logits.max())
                best = int(p.argmax())
                names.append(langs[best])
                scores.append(float(p[best] / p.sum()))
            held = [in_fold(i, FOLDS, HELD_OUT) for i in ids.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(held, pa.bool_()), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return known.select("doc_id", "text").mapInArrow(run, PREDICTED)
