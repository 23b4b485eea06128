"""Exact top-k search (operator 13): the rows of greatest inner product for each query.

Method: all vectors are sorted by descending length and cut into blocks
(``vector_blocks``). The longest blocks are searched first; each query's k-th score
there is its threshold, and a block whose greatest length times the query's
falls short of it (Cauchy-Schwarz) is not even read by the second pass. Inside
a pair of blocks, the candidates are rotated by the singular vectors of their
block; partial sums over the leading directions plus the product of the
residual lengths bound each score from above, and candidates that can reach no
query's threshold drop out stage by stage. What is left is scored exactly, and
thresholds rise as the task goes on. Bounds are widened beyond the rounding of
floats, so nothing is lost: pruning saves time only.

Defined results: a NULL vector or one with a NULL or non-finite component (or
one of 2^400 or more after scaling) takes no part; vectors of different
lengths have no score with each other; rows of the query's ``vec_id`` are not
among its candidates; rows that repeat a query's id are queries of their own;
other repeated rows each take their rank; a NULL ``vec_id`` is never a query and
ranks after its ties; scores beyond a long are held to its limits; a query with
fewer candidates gives fewer rows; an empty table gives an empty table; further
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agroweather.llm.common import stored
from agroweather.llm.residues import exact_scores, score_bits
from agroweather.llm.vector_blocks import (
    CANDIDATE_GROUP,
    LOWEST,
    Best,
    best_rows,
    blocks,
    integer_vectors,
    known_ids,
    matrix,
    tiles,
)

SCALE = 1024
QUERY_EVERY = 100
TOP = 10
STAGES = (8, 24)  # leading singular directions after which candidates are pruned
SLACK = 1e-9  # of the lengths' product, far beyond the rounding of the bounds

QUERY = ("q_part", "q_seq", "q_row")
FOUND = "q_part int, q_seq int, q_row int, q_norm double, query_id long, vec_id long, score long"
SIDE = ("ids", "data", "kind", "n", "norm")


def singular_directions(x: np.ndarray) -> np.ndarray:
    """Orthonormal directions (columns) of the rows of ``x``, the strongest first."""
    if x.shape[0] >= x.shape[1]:
        return np.linalg.eigh(x.T @ x)[1][:, ::-1]
    return np.linalg.svd(x, full_matrices=False)[2].T


class Rotated:
    """A candidate block along its own singular directions, with residual lengths per stage."""

    def __init__(self, y: np.ndarray):
        self.unit = max(float(np.abs(y).max(initial=0.0)), 1.0)
        self.y = y / self.unit
        self.directions = singular_directions(self.y)[:, : STAGES[-1]] if y.size else np.zeros((y.shape[1], 0))
        self.leading = self.y @ self.directions
        self.lengths = np.sqrt((self.y * self.y).sum(axis=1))

    def may_reach(self, x: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """Places of candidates whose bound reaches the floor of some query row of ``x``."""
        size = max(float(np.abs(x).max(initial=0.0)), 1.0)
        x, floor = x / size, floor.astype(np.float64) / size / self.unit
        leading, lengths = x @ self.directions, np.sqrt((x * x).sum(axis=1))
        slack = SLACK * (1 + lengths[:, None] * self.lengths.max(initial=0.0))
        left = np.flatnonzero((lengths[:, None] * self.lengths + slack >= floor[:, None]).any(axis=0))
        sums, done = np.zeros((len(x), len(left))), 0
        for stage in STAGES:
            if done >= self.directions.shape[1] or not len(left):
                break
            sums += leading[:, done:stage] @ self.leading[left, done:stage].T
            done = stage
            rest_x = self._residual(lengths, leading[:, :stage])
            rest_y = self._residual(self.lengths[left], self.leading[left, :stage])
            alive = (sums + rest_x[:, None] * rest_y + slack >= floor[:, None]).any(axis=0)
            left, sums = left[alive], sums[:, alive]
        return left

    @staticmethod
    def _residual(lengths: np.ndarray, leading: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(lengths**2 - (leading * leading).sum(axis=1), 0.0) + SLACK * lengths**2)


def inner_products(x: np.ndarray, y: np.ndarray, bits: float) -> np.ndarray:
    """Exact scores: in doubles where every sum is below 2^53, else by residues."""
    if bits < 53:
        return (x.astype(np.float64) @ y.astype(np.float64).T).astype(np.int64)
    return exact_scores(x, y, bits)


def _searched(pairs: DataFrame, k: int) -> DataFrame:
    """The ``k`` best candidates of each query row in each tile."""
    columns = ["dims", "q_part", "q_seq", "q_floors"] + [f"{side}_{name}" for side in "qc" for name in SIDE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, best, x, ids, lengths = None, None, None, None, None

        def flush() -> Iterator[pa.RecordBatch]:
            if best is None or not len(best.row):
                return
            n = len(best.row)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, key[0]), pa.int32()),
                    pa.array(np.full(n, key[1]), pa.int32()),
                    pa.array(best.row, pa.int32()),
                    pa.array(lengths[best.row], pa.float64()),
                    pa.array(ids[best.row], pa.int64()),
                    best.found_ids(),
                    pa.array(best.score, pa.int64()),
                ],
                names=["q_part", "q_seq", "q_row", "q_norm", "query_id", "vec_id", "score"],
            )

        for batch in batches:
            for row in range(batch.num_rows):
                pair = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                if key != (pair["q_part"], pair["q_seq"]):
                    yield from flush()
                    key = (pair["q_part"], pair["q_seq"])
                    x = matrix(pair["q_data"], pair["q_kind"], pair["dims"], pair["q_n"])
                    ids = known_ids(pair["q_ids"])
                    lengths = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
                    floor = np.full(len(x), LOWEST, np.int64)
                    for found in pair["q_floors"] or []:
                        floor[found["row"]] = found["score"]
                    best = Best(len(x), k, floor)
                y = matrix(pair["c_data"], pair["c_kind"], pair["dims"], pair["c_n"])
                left = Rotated(y.astype(np.float64)).may_reach(x.astype(np.float64), best.floor)
                if not len(left):
                    continue
                scores = inner_products(x, y[left], score_bits(pair["q_norm"], pair["c_norm"]))
                given = [pair["c_ids"][i] for i in left]
                best.add(scores, ids[:, None] != known_ids(given)[None, :], given)
        yield from flush()

    return pairs.select(*columns).mapInArrow(run, FOUND)


def longest_blocks(every: DataFrame, most: int = CANDIDATE_GROUP) -> DataFrame:
    """Keys of the blocks with the greatest lengths, ``most`` of each number of components."""
    first = Window.partitionBy("dims").orderBy(F.desc("norm"), "part", "seq")
    return (
        every.select("dims", "part", "seq", "norm", F.row_number().over(first).alias("place"))
        .where(F.col("place") <= most)
        .select("part", "seq")
    )


def top_products(
    embeddings: DataFrame, *, scale: int = SCALE, query_every: int = QUERY_EVERY, k: int = TOP
) -> DataFrame:
    """Rows ``query_id, rank, vec_id, score`` for the rows of ``embeddings`` (``vec_id, embedding``).

    Queries are the rows whose id is divisible by ``query_every``; each meets all rows.
    """
    vectors = embeddings.where("embedding IS NOT NULL").select("vec_id", F.lit(None).alias("label"), "embedding")
    rows = stored(integer_vectors(vectors, scale), "integer-vectors")
    longest = F.col("norm").desc()
    every = stored(blocks(rows, longest), "blocks")
    no_floors = F.lit(None).cast("array<struct<row: int, score: long>>")
    queries = stored(
        blocks(rows.where(F.col("vec_id") % query_every == 0), longest).withColumn("floors", no_floors),
        "query-blocks",
    )

    keys = stored(longest_blocks(every), "longest")
    seeds = stored(every.join(keys, ["part", "seq"], "left_semi"), "seeds")
    first = stored(best_rows(_searched(tiles(queries, seeds, F.lit(True)), k), k, *QUERY).drop("place"), "seeded")

    # The k-th score of the seeds is a query's floor; one with fewer scores, or a floor of
    # zero or less, can be reached by vectors of any length.
    floors = first.groupBy(*QUERY).agg(
        F.count(F.lit(1)).alias("n"), F.min("score").alias("score"), F.max("q_norm").alias("q_norm")
    )
    need = F.when((F.col("n") >= k) & (F.col("score") > 0), F.col("score") / F.col("q_norm") * (1 - 1e-9))
    by_block = floors.groupBy(F.col("q_part").alias("part"), F.col("q_seq").alias("seq")).agg(
        F.count(F.lit(1)).alias("known"),
        F.min(F.coalesce(need, F.lit(0.0))).alias("need"),
        F.collect_list(  # one entry for each row of a block, whose size is bounded
            F.when(F.col("n") >= k, F.struct(F.col("q_row").alias("row"), "score"))
        ).alias("floors"),
    )
    asking = stored(
        queries.drop("floors")
        .join(by_block, ["part", "seq"], "left")
        .withColumn("need", F.when(F.col("known") == F.col("n"), F.col("need")).otherwise(0.0))
        .drop("known"),
        "asking-blocks",
    )
    least = asking.groupBy("dims").agg(F.min("need").alias("least"))
    rest = (
        every.join(keys, ["part", "seq"], "left_anti")
        .join(least, "dims")
        .where(F.col("norm") >= F.col("least"))
        .drop("least")
    )
    rest = stored(rest, "rest")
    second = _searched(tiles(asking, rest, F.col("c_norm") >= F.col("q_need")), k)
    return best_rows(first.unionByName(second), k, *QUERY).select(
        "query_id", F.col("place").alias("rank"), "vec_id", "score"
    )
