"""Integer vectors in blocks, and tiles of block pairs, for scoring queries against all rows.

Vectors become whole numbers, are sorted, and cut into blocks of bounded size.
Queries meet candidates block by block: blocks of each side are dealt into
groups, a tile is a group of queries with a group of candidates and goes to one
task as pairs of blocks, so a task holds two blocks at a time whatever the size
of the tables. A task keeps the best ``k`` of each query row; these are ranked
over all tiles by a window, whose map side keeps ``k`` rows too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_BYTES = 1 << 20  # of components in one block
BLOCK_ROWS = 2048
QUERY_GROUP = 8  # blocks of queries in a tile
CANDIDATE_GROUP = 4  # blocks of candidates in a tile
MOST_TASKS = 20_000  # of one join of tiles; beyond, a task gets several
LARGEST = 2.0**400  # components beyond take no part; every 32-bit float is far below
KINDS = ("<i2", "<i4", "<f8")  # narrowest first: how a vector's components are stored
LOWEST = -(2**63) + 1  # scores are held to the range of a long, but for its last value
NO_ID = 2**63 - 1  # stands for a NULL id in sorting: after all others

ROWS = "vec_id long, label long, dims int, kind string, norm double, data binary"
BLOCKS = (
    "dims int, kind string, part int, seq int, n int, norm double, low long, high long, "
    "ids array<long>, labels array<long>, data binary"
)


def integer_vectors(rows: DataFrame, scale: int) -> DataFrame:
    """``floor(scale * x)`` of rows ``vec_id, label, embedding``; rows without a valid vector are left out.

    Invalid is a NULL vector or one with a component that is NULL, not finite,
    or 2^400 or more after scaling.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            flat = np.array(lists.flatten().to_numpy(zero_copy_only=False), np.float64)
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())])
            with np.errstate(over="ignore", invalid="ignore"):
                flat = np.floor(scale * flat)
                sizes = np.abs(flat)
            kinds, norms, data, valid = [], [], [], []
            given = lists.is_valid().to_pylist()
            for i in range(len(lists)):
                own = flat[ends[i] : ends[i + 1]]
                top = sizes[ends[i] : ends[i + 1]].max(initial=0.0)
                valid.append(bool(given[i] and top < LARGEST))
                kind = KINDS[0] if top < 2**15 else KINDS[1] if top < 2**31 else KINDS[2]
                kinds.append(kind)
                norms.append(float(np.sqrt(own @ own)) if valid[-1] else 0.0)
                data.append(own.astype(kind).tobytes() if valid[-1] else b"")
            out = pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(np.diff(ends), pa.int32()),
                    pa.array(kinds, pa.string()),
                    pa.array(norms, pa.float64()),
                    pa.array(data, pa.binary()),
                ],
                names=["vec_id", "label", "dims", "kind", "norm", "data"],
            )
            yield out.filter(pa.array(valid, pa.bool_()))

    return rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    ).mapInArrow(run, ROWS)


def blocks(rows: DataFrame, *order: Column) -> DataFrame:
    """The rows sorted by ``dims`` and ``order`` and cut into blocks of equal dims and kind.

    ``part`` and ``seq`` number the blocks; ``norm`` is the greatest of a block,
    ``low`` and ``high`` bound its labels. Equal rows are dealt over tasks by
    the id at the end of the order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        seq = 0

        def cut() -> pa.RecordBatch:
            nonlocal held, seq
            ids, labels, dims, kinds, norms, data, parts = zip(*held, strict=True)
            known = [label for label in labels if label is not None]
            row = {
                "dims": dims[0],
                "kind": kinds[0],
                "part": parts[0],
                "seq": seq,
                "n": len(held),
                "norm": max(norms),
                "low": min(known, default=None),
                "high": max(known, default=None),
                "ids": list(ids),
                "labels": list(labels),
                "data": b"".join(data),
            }
            held, seq = [], seq + 1
            return pa.RecordBatch.from_pylist([row], schema)

        wide = pa.list_(pa.int64())
        schema = pa.schema(
            [("dims", pa.int32()), ("kind", pa.string()), ("part", pa.int32()), ("seq", pa.int32()), ("n", pa.int32())]
            + [("norm", pa.float64()), ("low", pa.int64()), ("high", pa.int64())]
            + [("ids", wide), ("labels", wide), ("data", pa.binary())]
        )
        for batch in batches:
            columns = [column.to_pylist() for column in batch.columns]
            for row in zip(*columns, strict=True):
                full = len(held) == BLOCK_ROWS or (len(held) + 1) * len(row[5]) > BLOCK_BYTES
                if held and (full or row[2:4] != held[0][2:4]):
                    yield cut()
                held.append(row)
        if held:
            yield cut()

    keys = [F.col("dims").asc(), *order, F.col("vec_id").asc()]
    names = ["vec_id", "label", "dims", "kind", "norm", "data"]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return placed.select(*names, F.spark_partition_id().alias("part")).mapInArrow(run, BLOCKS)


def tiles(queries: DataFrame, candidates: DataFrame, near: Column) -> DataFrame:
    """Pairs of blocks with prefixes ``q_`` and ``c_`` where ``near`` holds, a tile's pairs in one task.

    Both are stored tables. A block goes once to every group of the other side; the
    number of groups follows from the number of blocks, so tiles stay equally
    large. Within a task the pairs of a query block follow each other, the
    longest candidates first.
    """

    def grouped(df: DataFrame, prefix: str, size: int) -> tuple[DataFrame, int]:
        groups = max(1, -(-df.count() // size))
        group = F.pmod(F.xxhash64("part", "seq"), F.lit(groups)).cast("int")
        return df.withColumn(f"{prefix}group", group), groups

    asked, q_groups = grouped(queries, "q_", QUERY_GROUP)
    given, c_groups = grouped(candidates, "c_", CANDIDATE_GROUP)
    keys = ["dims", "q_group", "c_group"]

    def side(df: DataFrame, prefix: str, other: str, groups: int) -> DataFrame:
        own = [F.col(c) if c in keys else F.col(c).alias(prefix + c) for c in df.columns]
        copies = df.select(*own, F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias(other))
        return copies.repartition(min(q_groups * c_groups, MOST_TASKS), *keys)

    return (
        side(asked, "q_", "c_group", c_groups)
        .join(side(given, "c_", "q_group", q_groups), keys)
        .where(near)
        .sortWithinPartitions("dims", "q_part", "q_seq", F.desc("c_norm"), "c_part", "c_seq")
    )


def matrix(data: bytes, kind: str, dims: int, n: int) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(n, dims)


def known_ids(ids: list[int | None]) -> np.ndarray:
    return np.array([NO_ID if i is None else i for i in ids], np.int64)


class Best:
    """The ``k`` best scores of each row; of equal ones those with smaller ids, NULL ids last."""

    def __init__(self, rows: int, k: int, floor: np.ndarray | None = None):
        self.k, self.rows = k, rows
        self.row = np.zeros(0, np.int64)
        self.score, self.ids, self.null = self.row, self.row, np.zeros(0, bool)
        self.floor = np.full(rows, LOWEST) if floor is None else floor.copy()

    def add(self, scores: np.ndarray, allowed: np.ndarray, ids: list[int | None]) -> None:
        """Scores (rows x candidates), where ``allowed``, of the candidates ``ids``."""
        allowed = allowed & (scores >= self.floor[:, None])
        wide = scores.shape[1]
        if wide > self.k and allowed.sum() > 4 * self.k * self.rows:
            held = np.where(allowed, scores, LOWEST)
            least = np.partition(held, wide - self.k, axis=1)[:, wide - self.k]
            allowed &= scores >= least[:, None]
        row, column = np.nonzero(allowed)
        if not len(row):
            return
        every, null = known_ids(ids), np.array([i is None for i in ids])
        self.row = np.concatenate([self.row, row])
        self.score = np.concatenate([self.score, scores[row, column]])
        self.ids = np.concatenate([self.ids, every[column]])
        self.null = np.concatenate([self.null, null[column]])
        order = np.lexsort((self.ids, self.null, -self.score, self.row))
        row = self.row[order]
        begins = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        place = np.arange(len(row)) - np.repeat(begins, np.diff(np.append(begins, len(row))))
        order, place = order[place < self.k], place[place < self.k]
        self.row, self.score, self.ids, self.null = (x[order] for x in (self.row, self.score, self.ids, self.null))
        full = self.row[place == self.k - 1]
        self.floor[full] = np.maximum(self.floor[full], self.score[place == self.k - 1])

    def found_ids(self) -> pa.Array:
        return pa.array(self.ids, pa.int64(), mask=self.null)


def best_rows(found: DataFrame, k: int, *key: str) -> DataFrame:
    """The ``k`` best of rows ``key, score, vec_id`` per key, with their ``place`` from 1."""
    first = Window.partitionBy(*key).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k)
