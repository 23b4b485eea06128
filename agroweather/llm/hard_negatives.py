"""Hard-negative mining (operator 11): near rows of another label, per anchor and positive.

Method: scores are exact integer inner products from a residue number system
(``residues``): component matrices modulo small primes, multiplied in float32 and
put together by Chinese remaindering. Two passes over tiles of anchor blocks and
all blocks (``vector_blocks``): the first finds each anchor's positives among the
rows of its label (only pairs of blocks whose labels overlap are multiplied),
the second selects, per positive, the best rows of other labels within the
window of its score. A task keeps a few rows per anchor, so no pair is emitted
that is not among the best of its tile, and a hot label is spread over blocks.

Defined results: a row with a NULL label, or a NULL vector or one with a NULL
or non-finite component (or one of 2^400 or more after scaling) takes no part;
vectors of different lengths have no score with each other; a row of the
anchor's ``vec_id`` is not among its positives; rows that repeat an anchor's id
are anchors of their own; other repeated rows each take their rank; a NULL
``vec_id`` is never an anchor and ranks after its ties; scores beyond a long are
held to its limits; anchors without positives and positives without negatives
have no rows; an empty table gives an empty table; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroweather.llm.common import stored
from agroweather.llm.residues import exact_scores, score_bits
from agroweather.llm.vector_blocks import (
    LOWEST,
    Best,
    best_rows,
    blocks,
    integer_vectors,
    known_ids,
    matrix,
    tiles,
)

SCALE = 256
ANCHOR_EVERY = 50
POSITIVES = 5
NEGATIVES = 3
WINDOW = (50, 95)  # percent of the positive's score, both included

ANCHOR = ("q_part", "q_seq", "q_row")
FOUND = "q_part int, q_seq int, q_row int, slot int, anchor_id long, vec_id long, score long"
SIDE = ("ids", "labels", "data", "kind", "n", "norm")


def relabelled(embeddings: DataFrame) -> DataFrame:
    """Rows ``vec_id, label, embedding`` where every seventh id has the next of ten labels."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return embeddings.select("vec_id", moved.alias("label"), "embedding")


def _mined(pairs: DataFrame, k: int, slots: int, window: tuple[int, int] | None) -> DataFrame:
    """The ``k`` best rows per anchor (slot 0) or per anchor and positive (its slot) of each tile.

    Without a window the rows of the anchor's label are ranked, otherwise those
    of other labels whose score lies in the window of the slot's positive.
    """
    columns = ["dims", "q_part", "q_seq"] + [f"{side}_{name}" for side in "qc" for name in SIDE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, best, a = None, [], {}

        def flush() -> Iterator[pa.RecordBatch]:
            for slot, found in enumerate(best):
                n = len(found.row)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, key[0]), pa.int32()),
                        pa.array(np.full(n, key[1]), pa.int32()),
                        pa.array(found.row, pa.int32()),
                        pa.array(np.full(n, slot), pa.int32()),
                        pa.array(a["ids"][found.row], pa.int64()),
                        found.found_ids(),
                        pa.array(found.score, pa.int64()),
                    ],
                    names=["q_part", "q_seq", "q_row", "slot", "anchor_id", "vec_id", "score"],
                )

        for batch in batches:
            for row in range(batch.num_rows):
                pair = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                if key != (pair["q_part"], pair["q_seq"]):
                    yield from flush()
                    key = (pair["q_part"], pair["q_seq"])
                    a = {
                        "x": matrix(pair["q_data"], pair["q_kind"], pair["dims"], pair["q_n"]),
                        "ids": known_ids(pair["q_ids"]),
                        "labels": np.array(pair["q_labels"]),
                    }
                    best = [Best(pair["q_n"], k) for _ in range(slots)]
                    if window:
                        low, high = bounds(pair["q_positives"], pair["q_n"], slots, window)
                y = matrix(pair["c_data"], pair["c_kind"], pair["dims"], pair["c_n"])
                scores = exact_scores(a["x"], y, score_bits(pair["q_norm"], pair["c_norm"]))
                same = a["labels"][:, None] == np.array(pair["c_labels"])[None, :]
                if not window:
                    best[0].add(scores, same & (a["ids"][:, None] != known_ids(pair["c_ids"])[None, :]), pair["c_ids"])
                    continue
                for slot, found in enumerate(best):
                    inside = (scores >= low[slot][:, None]) & (scores <= high[slot][:, None])
                    found.add(scores, inside & ~same, pair["c_ids"])
        yield from flush()

    return pairs.select(*columns, *(["q_positives"] if window else [])).mapInArrow(run, FOUND)


def bounds(positives: list, n: int, slots: int, window: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest negative score per slot and row; an empty range where there is no positive."""
    low, high = np.full((slots, n), 1, np.int64), np.full((slots, n), 0, np.int64)
    for found in positives or []:
        score = found["score"]
        low[found["slot"], found["row"]] = -(-window[0] * score // 100)
        high[found["slot"], found["row"]] = max(window[1] * score // 100, LOWEST)
    return low, high


def mine_negatives(
    embeddings: DataFrame,
    *,
    scale: int = SCALE,
    anchor_every: int = ANCHOR_EVERY,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW,
) -> DataFrame:
    """Rows ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``embeddings`` has ``vec_id, label, embedding``. Anchors are the rows whose id
    is divisible by ``anchor_every``; each meets all rows.
    """
    labelled = embeddings.where("label IS NOT NULL AND embedding IS NOT NULL")
    rows = stored(integer_vectors(labelled, scale), "integer-vectors")
    by_label = F.col("label").asc()
    every = stored(blocks(rows, by_label), "blocks")
    anchors = stored(blocks(rows.where(F.col("vec_id") % anchor_every == 0), by_label), "anchor-blocks")

    overlap = (F.col("q_low") <= F.col("c_high")) & (F.col("c_low") <= F.col("q_high"))
    first = _mined(tiles(anchors, every, overlap), positives, 1, None)
    first = stored(
        best_rows(first, positives, *ANCHOR).select(
            *ANCHOR,
            "anchor_id",
            (F.col("place") - 1).alias("slot"),
            F.col("vec_id").alias("positive_id"),
            F.col("score").alias("positive_score"),
        ),
        "positives",
    )
    # at most `positives` entries for each row of a block, whose size is bounded
    asked = first.groupBy(F.col("q_part").alias("part"), F.col("q_seq").alias("seq")).agg(
        F.collect_list(
            F.struct(F.col("q_row").alias("row"), "slot", F.col("positive_score").alias("score"))
        ).alias("positives")
    )
    asking = stored(anchors.join(asked, ["part", "seq"]), "asking-blocks")
    second = _mined(tiles(asking, every, F.lit(True)), negatives, positives, window)
    ranked = best_rows(second.drop("anchor_id"), negatives, *ANCHOR, "slot")
    return first.join(ranked, [*ANCHOR, "slot"]).select(
        "anchor_id",
        "positive_id",
        F.col("place").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
