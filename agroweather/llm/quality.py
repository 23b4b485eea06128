"""Quality classifier (operator 7).

Method: attention-based multiple-instance learning. A document is a bag of
passages of ``PASSAGE_BYTES`` bytes; every passage of the whole text is encoded
from its byte and byte-class-pair counts, gated attention weights are learned
from document labels only, and the attention-weighted passage representation
is scored. The network is fitted on a bounded sample of labelled rows,
``SAMPLE_PER_LABEL`` a label, chosen by a hash of the id, ``SAMPLE_BYTES`` of
text at most; scoring is one map that holds one slice of a text's passages at a
time.

Training labels come only from rows outside the held-out fold. Scores use the
text alone.

Defined results: a NULL text is the empty text, which is one passage without
counts; without both labels among the training rows every score is the share
of label 1 (0.5 without rows); a NULL id stays NULL, is not held out and is
not trained on; of contradicting labels of one id the document counts once
under each; repeated rows give repeated rows; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroweather.llm.common import bounded_sample, fold, free_name, shared_model, slices, texts

FOLDS, HELD_OUT = 4, 2
PASSAGE_BYTES = 512
SAMPLE_PER_LABEL = 2000
SAMPLE_BYTES = 32 << 20  # of a label's sampled texts together; none over a 64th of it
HIDDEN, ATTENTION = 16, 8
EPOCHS, BATCH, RATE, DECAY = 25, 32, 0.01, 1e-4
THRESHOLD = 0.7
SLICE = 256

SCORED = "doc_id long, held_out boolean, score double, predicted int"


def byte_classes() -> np.ndarray:
    """Class of each byte: lower, upper, digit, blank, line end, other control, high, and each sign."""
    classes = np.empty(256, np.int64)
    signs = 7
    for byte in range(256):
        letter = chr(byte)
        if byte >= 128:
            classes[byte] = 6
        elif letter.islower():
            classes[byte] = 0
        elif letter.isupper():
            classes[byte] = 1
        elif letter.isdigit():
            classes[byte] = 2
        elif letter == " ":
            classes[byte] = 3
        elif letter == "\n":
            classes[byte] = 4
        elif byte < 32 or byte == 127:
            classes[byte] = 5
        else:
            classes[byte], signs = signs, signs + 1
    return classes


CLASSES = byte_classes()
N_CLASSES = int(CLASSES.max()) + 1
PAIRS = N_CLASSES * N_CLASSES
#: Besides the counts: repeated stretches of 8 bytes, and the length.
FEATURES = 256 + PAIRS + 2
STRETCH = 8


def passage_counts(data: bytes, first: int, count: int) -> np.ndarray:
    """Counts of bytes, neighbouring byte classes and repeated stretches in passages ``first``.. (a row each)."""
    part = np.frombuffer(data, np.uint8)[first * PASSAGE_BYTES : (first + count) * PASSAGE_BYTES]
    rows = max(1, -(-len(part) // PASSAGE_BYTES))
    owner = np.arange(len(part)) // PASSAGE_BYTES
    kinds = CLASSES[part]
    out = np.empty((rows, FEATURES), np.uint16)
    out[:, :256] = np.bincount(owner * 256 + part, minlength=rows * 256).reshape(rows, 256)
    same = owner[1:] == owner[:-1]
    codes = (owner[1:] * PAIRS + kinds[:-1] * N_CLASSES + kinds[1:])[same]
    out[:, 256:-2] = np.bincount(codes, minlength=rows * PAIRS).reshape(rows, PAIRS)
    # a stretch is its bytes' hash with the passage's number in the upper bits
    places = max(0, len(part) - STRETCH + 1)
    stretches = np.zeros(places, np.uint64)
    for offset in range(STRETCH):
        stretches = stretches * np.uint64(1099511628211) + part[offset : offset + places]
    stretches = (owner[:places].astype(np.uint64) << np.uint64(48)) | (stretches >> np.uint64(16))
    stretches = stretches[owner[:places] == owner[STRETCH - 1 :]] if places else stretches
    stretches.sort()
    again = stretches[1:][stretches[1:] == stretches[:-1]] >> np.uint64(48)
    out[:, -2] = np.bincount(again.astype(np.int64), minlength=rows)
    out[:, -1] = np.bincount(owner, minlength=rows)
    return out


def scaled(counts: np.ndarray) -> np.ndarray:
    """Logarithms of the counts, those of bytes and pairs at unit length."""
    values = np.log1p(counts.astype(np.float32))
    norm = np.sqrt((values[:, :-2] ** 2).sum(axis=1, keepdims=True))
    values[:, :-2] /= np.maximum(norm, 1e-6)
    values[:, -2:] /= 6
    return values


class GatedAttention:
    """Passage encoder, gated attention and scorer, with Adam steps over whole bags."""

    def __init__(self, seed: int = 7):
        draw = np.random.default_rng(seed).normal
        self.p = {
            "E": draw(0, 1.0, (FEATURES, HIDDEN)),
            "e": np.zeros(HIDDEN),
            "V": draw(0, 0.3, (HIDDEN, ATTENTION)),
            "U": draw(0, 0.3, (HIDDEN, ATTENTION)),
            "a": draw(0, 0.3, ATTENTION),
            "w": draw(0, 0.3, HIDDEN),
            "b": np.zeros(1),
        }
        self.moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        self.steps = 0

    def passages(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple]:
        """Encodings and attention logits of passages."""
        p = self.p
        h = np.tanh(x @ p["E"] + p["e"])
        t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        return h, (t * g) @ p["a"], (t, g)

    def train(self, x: np.ndarray, starts: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        p = self.p
        sizes = np.diff(np.append(starts, len(x)))
        bag = np.repeat(np.arange(len(starts)), sizes)
        h, s, (t, g) = self.passages(x)
        s = np.exp(s - np.maximum.reduceat(s, starts)[bag])
        att = s / np.add.reduceat(s, starts)[bag]
        m = np.add.reduceat(att[:, None] * h, starts)
        score = 1 / (1 + np.exp(-(m @ p["w"] + p["b"])))
        d = (score - y) * weight / len(y)
        dm = d[:, None] * p["w"]
        dh = att[:, None] * dm[bag]
        da = (h * dm[bag]).sum(axis=1)
        ds = att * (da - np.add.reduceat(att * da, starts)[bag])
        dt, dg = ds[:, None] * p["a"] * g * (1 - t * t), ds[:, None] * p["a"] * t * g * (1 - g)
        dh += dt @ p["V"].T + dg @ p["U"].T
        dx = dh * (1 - h * h)
        self._step(
            {
                "E": x.T @ dx,
                "e": dx.sum(axis=0),
                "V": h.T @ dt,
                "U": h.T @ dg,
                "a": ((t * g) * ds[:, None]).sum(axis=0),
                "w": m.T @ d,
                "b": d.sum(keepdims=True),
            }
        )

    def _step(self, gradients: dict[str, np.ndarray]) -> None:
        self.steps += 1
        for name, gradient in gradients.items():
            first, second = self.moments[name]
            first += 0.1 * (gradient - first)
            second += 0.001 * (gradient * gradient - second)
            size = RATE / (1 - 0.9**self.steps)
            self.p[name] -= size * first / (np.sqrt(second / (1 - 0.999**self.steps)) + 1e-8)
            if self.p[name].ndim == 2:
                self.p[name] *= 1 - RATE * DECAY

    def score(self, data: bytes) -> float:
        """Score of a whole text, its passages taken in slices."""
        n = max(1, -(-len(data) // PASSAGE_BYTES))
        hidden, logits = [], []
        for first in range(0, n, SLICE):
            h, s, _ = self.passages(scaled(passage_counts(data, first, SLICE)))
            hidden.append(h)
            logits.append(s)
        s = np.concatenate(logits)
        att = np.exp(s - s.max())
        m = (att / att.sum()) @ np.concatenate(hidden)
        return float(1 / (1 + np.exp(-(m @ self.p["w"] + self.p["b"][0]))))


def training_bags(docs: DataFrame, labels: DataFrame, per_label: int) -> tuple[list, dict[int, int]]:
    """Passage counts and label of at most ``per_label`` documents of each label, and all label counts.

    The labels that may be used are counted first; a hash of the id then keeps
    about as many as wanted before any text is read.
    """
    order = F.pmod(F.xxhash64("doc_id"), F.lit((1 << 31) - 1))
    usable = (
        labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int"))
        .where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .where(fold(F.col("doc_id"), FOLDS) != HELD_OUT)
        .distinct()
        .withColumn("order", order)
    )
    sizes = {row.quality: row["count"] for row in usable.groupBy("quality").count().collect()}
    wanted = None
    for label, count in sizes.items():
        share = min(1.0, (1.5 * per_label + 20) / count)
        near = (
            usable.where((F.col("quality") == label) & (F.col("order") <= int(share * (1 << 31))))
            .orderBy("order", "doc_id")
            .limit(per_label)
        )
        wanted = near if wanted is None else wanted.union(near)
    if wanted is None:
        return [], {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for label, text, seq in zip(
                batch.column(0).to_pylist(), texts(batch, 1), batch.column(2).to_pylist(), strict=True
            ):
                data = text.encode("utf-8", "replace")
                n = max(1, -(-len(data) // PASSAGE_BYTES))
                for first in range(0, n, SLICE):
                    counts = passage_counts(data, first, SLICE)
                    at = np.flatnonzero(counts.ravel())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([seq]),
                            pa.array([label], pa.int32()),
                            pa.array([first], pa.int64()),
                            pa.array([len(counts)], pa.int64()),
                            pa.array([at.astype("<u4").tobytes()]),
                            pa.array([counts.ravel()[at].astype("<u2").tobytes()]),
                        ],
                        names=["doc_id", "label", "first", "rows", "at", "counts"],
                    )

    # the list of wanted ids is bounded by the parameter, whatever the corpus holds
    chosen = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(wanted), "doc_id")
    keyed = chosen.select("quality", F.struct("order", "doc_id").alias("order"), "text")
    rows = (
        bounded_sample(keyed, "quality", per_label, SAMPLE_BYTES)
        .select("quality", "text", "order.doc_id")
        .mapInArrow(run, "doc_id long, label int, first long, rows long, at binary, counts binary")
        .collect()
    )
    bags: dict[tuple, list] = {}
    for row in sorted(rows, key=lambda r: (r.doc_id, r.label, r.first)):
        bags.setdefault((row.doc_id, row.label), []).append(row)
    return [(label, parts) for (_, label), parts in bags.items()], sizes


def dense(parts: list) -> np.ndarray:
    out = []
    for part in parts:
        counts = np.zeros(part.rows * FEATURES, np.uint16)
        counts[np.frombuffer(part.at, "<u4")] = np.frombuffer(part.counts, "<u2")
        out.append(scaled(counts.reshape(part.rows, FEATURES)))
    return np.concatenate(out)


def fit(bags: list, sizes: dict[int, int], epochs: int = EPOCHS) -> GatedAttention | float:
    """The fitted network; a constant score where one label is missing."""
    total = sum(sizes.values())
    if not bags or len({label for label, _ in bags}) < 2:
        return sizes.get(1, 0) / total if total else 0.5
    network, rng = GatedAttention(), np.random.default_rng(11)
    have = {label: sum(1 for other, _ in bags if other == label) for label in (0, 1)}
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for start in range(0, len(order), BATCH):
            some = [bags[i] for i in order[start : start + BATCH]]
            made = [dense(parts) for _, parts in some]
            y = np.array([label for label, _ in some], dtype=float)
            weight = np.array([len(bags) / 2 / have[label] for label, _ in some])
            starts = np.concatenate([[0], np.cumsum([len(x) for x in made])[:-1]]).astype(int)
            network.train(np.concatenate(made), starts, y, weight)
    network.p = {k: v.astype(np.float32) for k, v in network.p.items()}
    network.moments = {}
    return network


def trained(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> GatedAttention | float:
    return fit(*training_bags(docs, labels, per_label))


def with_quality(
    docs: DataFrame, model: GatedAttention | float, *, text: str = "text", score: str = "score"
) -> DataFrame:
    """``docs`` with one more column: the score of the whole text."""
    shared = shared_model(docs.sparkSession, model)
    place = docs.columns.index(text)
    schema = docs.withColumn(score, F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared()
        for batch in slices(batches):
            if isinstance(model, float):
                scores = [model] * batch.num_rows
            else:
                scores = [model.score(value.encode("utf-8", "replace")) for value in texts(batch, place)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())],
                names=[*batch.schema.names, score],
            )

    return docs.mapInArrow(run, schema)


def classify_quality(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Per row of ``docs`` its fold, score and decision."""
    chosen = docs.select(F.col("doc_id").cast("long"), "text")
    scored = with_quality(chosen, trained(chosen, labels, **options))
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, all columns as they were."""
    model = trained(docs.select("doc_id", "text"), labels)
    score = free_name(docs.columns, "__quality")
    scored = with_quality(docs, model, score=score)
    return scored.where(F.col(score) >= THRESHOLD).drop(score)
