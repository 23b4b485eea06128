"""Embedding near-dedup (operator 4): vectors of equal label linked by cosine.

Method: epsilon grid order. Unit vectors are projected to their leading
principal directions and laid on a grid whose cells are as wide as the largest
distance of linked vectors; the vectors of a label are sorted by their cells and cut
into sequence intervals. Pairs of intervals are joined recursively: first
ranges of intervals, then intervals, then halves of intervals inside a task;
any pair whose bounding boxes are provably farther apart than the distance is
skipped. The projection is orthonormal, so distances in it never exceed true ones.

Cosine is taken in double precision. A task gives per vector the number of its
links and edges that connect what is linked, not all pairs, so a large group of
near copies costs its comparisons but no rows. Intervals have a bounded size,
and a label of any size is spread over the pairs of its intervals.

Defined results: a vector that is NULL, zero, or has NULL or non-finite
components, and a NULL label, link with nothing; vectors of different lengths
do not link; rows of one ``vec_id`` are vectors of their own; a NULL ``vec_id``
is passed over by minima; a row without links has its own id as component and
is kept; an empty table gives an empty table; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agroweather.llm.common import stored
from agroweather.llm.components import connected_components

COSINE = 0.93
LEADING = 8  # principal directions of the grid and the boxes
INTERVAL_BYTES = 1 << 19  # of double components in one sequence interval
RANGE_OF_INTERVALS = 16
LEAF = 64  # vectors below which no further halving is tried
ROW_BITS = 20


def unit_vectors(embeddings: DataFrame) -> DataFrame:
    """Rows ``vec_id, label, dims, v`` of the valid vectors, ``v`` of unit length."""
    raw = F.col("embedding").cast("array<double>")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    return (
        embeddings.select(F.col("vec_id").cast("long"), F.col("label"), raw.alias("v"))
        .where("label IS NOT NULL AND v IS NOT NULL")
        .withColumn("top", F.aggregate("v", F.lit(0.0), lambda s, x: F.greatest(s, F.abs(x))))
        .where(~F.exists("v", lambda x: x.isNull()))
        .where("top > 0 AND top < double('Infinity')")
        # divided by the largest component first, so that squares neither overflow nor vanish
        .withColumn("v", F.transform("v", lambda x: x / F.col("top")))
        .withColumn("norm", norm)
        .select("vec_id", "label", F.size("v").alias("dims"), F.transform("v", lambda x: x / F.col("norm")).alias("v"))
    )


def principal_directions(vectors: DataFrame, dims: int, leading: int = LEADING) -> np.ndarray:
    """Orthonormal directions (dims x leading) of largest variance over all vectors of a length.

    Every task adds up its rows' products; the sums are of fixed size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, total, rows = np.zeros((dims, dims)), np.zeros(dims), 0
        for batch in batches:
            x = np.array(batch.column(0).flatten()).reshape(-1, dims)
            products += x.T @ x
            total += x.sum(axis=0)
            rows += len(x)
        every = np.concatenate([products.ravel(), total, [rows]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(every))), pa.array(every)], names=["place", "value"]
        )

    sums = (
        vectors.where(F.col("dims") == dims)
        .select("v")
        .mapInArrow(run, "place long, value double")
        .groupBy("place")
        .agg(F.sum("value").alias("value"))
    )
    found = np.zeros(dims * dims + dims + 1)
    for place, value in sums.collect():  # dims * (dims + 1) + 1 rows
        found[place] = value
    rows = max(found[-1], 1.0)
    mean = found[dims * dims : -1] / rows
    spread = found[: dims * dims].reshape(dims, dims) / rows - np.outer(mean, mean)
    _, directions = np.linalg.eigh((spread + spread.T) / 2)
    return np.ascontiguousarray(directions[:, ::-1][:, :leading])


def grid_cells(vectors: DataFrame, directions: np.ndarray, width: float) -> DataFrame:
    """Rows ``label, cells, vec_id, v`` with each vector's cell coordinates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(2).flatten()).reshape(-1, len(directions))
            cells = np.floor(x @ directions / width).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(cells), pa.list_(pa.int32())), batch.column(1), batch.column(2)],
                names=["label", "cells", "vec_id", "v"],
            )

    schema = vectors.select("label", F.array(F.lit(0)).alias("cells"), "vec_id", "v").schema
    return vectors.select("label", "vec_id", "v").mapInArrow(run, schema)


INTERVALS = "{label}, part int, seq int, n int, low array<double>, high array<double>, ids array<long>, data binary"


def intervals(cells: DataFrame, directions: np.ndarray) -> DataFrame:
    """The sorted vectors cut into intervals of one label each, with bounding boxes."""
    dims = len(directions)
    most = max(LEAF, INTERVAL_BYTES // (8 * dims))
    ordered = cells.repartitionByRange("label", "cells", "vec_id").sortWithinPartitions(
        "label", "cells", "vec_id", "v"
    )
    numbered = ordered.select(F.spark_partition_id().alias("part"), "label", "vec_id", "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        seq = 0

        def cut() -> pa.RecordBatch:
            nonlocal held, seq
            x = np.array([row[3] for row in held])
            near = x @ directions
            row = [
                [held[0][1]],
                [held[0][0]],
                [seq],
                [len(held)],
                [near.min(axis=0).tolist()],
                [near.max(axis=0).tolist()],
                [[row[2] for row in held]],
                [x.tobytes()],
            ]
            held, seq = [], seq + 1
            return pa.RecordBatch.from_arrays(
                [pa.array(cell, kind) for cell, kind in zip(row, kinds, strict=True)],
                names=["label", "part", "seq", "n", "low", "high", "ids", "data"],
            )

        for batch in batches:
            box = pa.list_(pa.float64())
            kinds = [batch.schema.field("label").type, pa.int32(), pa.int32(), pa.int32(), box, box, pa.list_(pa.int64()), pa.binary()]
            columns = [column.to_pylist() for column in batch.columns]
            for row in zip(*columns, strict=True):
                if held and (row[1] != held[0][1] or len(held) == most):
                    yield cut()
                held.append(row)
        if held:
            yield cut()

    label = f"label {cells.schema['label'].dataType.simpleString()}"
    return numbered.mapInArrow(run, INTERVALS.format(label=label))


def near_boxes(a: str, b: str, distance: float):
    """Whether two boxes (columns ``low``/``high`` with the prefixes) may hold vectors within ``distance``."""
    gaps = F.zip_with(
        F.arrays_zip(F.col(f"{a}low").alias("low"), F.col(f"{a}high").alias("high")),
        F.arrays_zip(F.col(f"{b}low").alias("low"), F.col(f"{b}high").alias("high")),
        lambda x, y: F.greatest(x["low"] - y["high"], y["low"] - x["high"], F.lit(0.0)),
    )
    return F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g) <= distance * distance


def prefixed(df: DataFrame, prefix: str, keep: tuple = ("label",)) -> DataFrame:
    return df.select(*[F.col(c) if c in keep else F.col(c).alias(prefix + c) for c in df.columns])


def interval_pairs(boxes: DataFrame, distance: float) -> DataFrame:
    """Rows ``a, b`` of interval numbers that may hold links, each pair once.

    ``boxes`` (``label, interval, low, high``) are first joined as ranges of
    neighbouring intervals; only the intervals of near ranges are then compared.
    """
    place = F.row_number().over(Window.partitionBy("label", "part").orderBy("seq")) - 1
    boxes = boxes.withColumn("range", F.struct("part", F.floor(place / RANGE_OF_INTERVALS).alias("r")))
    dims = range(LEADING)
    ranges = boxes.groupBy("label", "range").agg(
        F.array(*[F.min(F.get("low", F.lit(d))) for d in dims]).alias("low"),
        F.array(*[F.max(F.get("high", F.lit(d))) for d in dims]).alias("high"),
    )
    # shorter vectors than the number of directions leave NULLs behind
    trim = lambda c: F.filter(c, lambda x: x.isNotNull())
    ranges = ranges.withColumns({"low": trim("low"), "high": trim("high")})
    near = (
        prefixed(ranges, "a_")
        .join(prefixed(ranges, "b_"), "label")
        .where("a_range <= b_range")
        .where(near_boxes("a_", "b_", distance))
        .select("label", "a_range", "b_range")
    )
    inner = boxes.select("label", "range", "interval", "low", "high")
    return (
        near.join(prefixed(inner, "a_"), ["label", "a_range"])
        .join(prefixed(inner, "b_"), ["label", "b_range"])
        .where("a_interval <= b_interval OR a_range < b_range")
        .where(near_boxes("a_", "b_", distance))
        .select(F.col("a_interval").alias("a"), F.col("b_interval").alias("b"))
    )


class LinkCounter:
    """Links of one pair of intervals: numbers per vector and edges that connect them."""

    def __init__(self, x: np.ndarray, y: np.ndarray, same: bool, directions: np.ndarray, cosine: float):
        self.x, self.y, self.same, self.cosine = x, y, same, cosine
        self.reach = 2 - 2 * cosine + 1e-9
        self.near_x, self.near_y = x @ directions, y @ directions
        self.n_x, self.n_y = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
        offset = 0 if same else len(x)
        self.group = np.arange(len(x) if same else len(x) + len(y))
        self.offset, self.edges = offset, []

    def join(self, a: slice, b: slice) -> None:
        """Recursion over halves of sequences; distant boxes are skipped."""
        low_a, high_a = self.near_x[a].min(axis=0), self.near_x[a].max(axis=0)
        low_b, high_b = self.near_y[b].min(axis=0), self.near_y[b].max(axis=0)
        gap = np.maximum(0, np.maximum(low_a - high_b, low_b - high_a))
        if gap @ gap > self.reach:
            return
        n_a, n_b = a.stop - a.start, b.stop - b.start
        # boxes wider than the reach in every direction part no more
        parts = np.max(np.maximum(high_a - low_a, high_b - low_b)) ** 2 > self.reach
        if max(n_a, n_b) <= LEAF or not parts and max(n_a, n_b) <= 8 * LEAF:
            self._compare(a, b)
            return
        for half_a in self._halves(a, n_a >= n_b):
            for half_b in self._halves(b, n_b >= n_a):
                if not self.same or half_a.start <= half_b.start:
                    self.join(half_a, half_b)

    @staticmethod
    def _halves(part: slice, cut: bool) -> list[slice]:
        middle = (part.start + part.stop) // 2
        if not cut or part.stop - part.start < 2:
            return [part]
        return [slice(part.start, middle), slice(middle, part.stop)]

    def _compare(self, a: slice, b: slice) -> None:
        linked = self.x[a] @ self.y[b].T >= self.cosine
        if self.same and a == b:
            linked = np.triu(linked, 1)
        if not linked.any():
            return
        own, other = linked.sum(axis=1), linked.sum(axis=0)
        self.n_x[a] += own
        self.n_y[b] += other
        for i in np.flatnonzero(own):
            hits = np.flatnonzero(linked[i]) + b.start + self.offset
            source = a.start + i
            groups = np.unique(self.group[hits])
            fresh = groups[groups != self.group[source]]
            if len(fresh):
                for g in fresh:
                    self.edges.append((source, hits[np.argmax(self.group[hits] == g)]))
                least = min(int(fresh.min()), int(self.group[source]))
                self.group[np.isin(self.group, [*fresh, self.group[source]])] = least


def linked_rows(pairs: DataFrame, directions: np.ndarray, cosine: float) -> DataFrame:
    """Rows ``a, n`` (vector, links found) and ``a, b`` (connecting edges) of all interval pairs."""
    dims = len(directions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, left, right in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                x = np.frombuffer(left).reshape(-1, dims)
                y = x if a == b else np.frombuffer(right).reshape(-1, dims)
                found = LinkCounter(x, y, a == b, directions, cosine)
                found.join(slice(0, len(x)), slice(0, len(y)))
                if a == b:
                    counts = [(a, found.n_x + found.n_y)]
                else:
                    counts = [(a, found.n_x), (b, found.n_y)]
                uid, n = [], []
                for interval, own in counts:
                    used = np.flatnonzero(own)
                    uid += ((interval << ROW_BITS) + used).tolist()
                    n += own[used].tolist()
                size = len(x)
                ends = [
                    [(a << ROW_BITS) + i if i < size or a == b else (b << ROW_BITS) + i - size for i in map(int, edge)]
                    for edge in found.edges
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([*uid, *(edge[0] for edge in ends)], pa.int64()),
                        pa.array([None] * len(uid) + [edge[1] for edge in ends], pa.int64()),
                        pa.array([*n, *[0] * len(ends)], pa.int64()),
                    ],
                    names=["a", "b", "n"],
                )

    return pairs.mapInArrow(run, "a long, b long, n long")


def link_length(vectors: DataFrame, dims: int, cosine: float) -> DataFrame:
    """Rows ``vec_id, uid, n_links, root`` of all valid vectors of one length."""
    directions = principal_directions(vectors, dims)
    distance = math.sqrt(2 - 2 * cosine) + 1e-6
    own = vectors.where(F.col("dims") == dims)
    cut = intervals(grid_cells(own, directions, distance), directions)
    number = F.shiftleft(F.col("part").cast("long"), 22) + F.col("seq")
    cut = stored(cut.withColumn("interval", number), "intervals")
    boxes = cut.select("label", "part", "seq", "interval", "low", "high")
    data = cut.select("interval", "data")
    pairs = (
        interval_pairs(boxes, distance)
        .join(data.select(F.col("interval").alias("a"), F.col("data").alias("left")), "a")
        .join(data.select(F.col("interval").alias("b"), F.col("data").alias("right")), "b")
        .select("a", "b", "left", "right")
        .repartition(F.col("a"), F.col("b"))
    )
    found = stored(linked_rows(pairs, directions, cosine), "links")
    counts = found.where("b IS NULL").groupBy("a").agg(F.sum("n").alias("n_links"))
    roots = connected_components(found.where("b IS NOT NULL").select("a", "b"))
    rows = cut.select("interval", F.posexplode("ids").alias("pos", "vec_id")).select(
        "vec_id", (F.shiftleft("interval", ROW_BITS) + F.col("pos")).alias("uid")
    )
    return (
        rows.join(counts.withColumnRenamed("a", "uid"), "uid", "left")
        .join(roots.withColumnRenamed("node", "uid"), "uid", "left")
        .select("vec_id", "uid", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), "root")
    )


def link_embeddings(embeddings: DataFrame, *, cosine: float = COSINE) -> DataFrame:
    """Per row of ``embeddings`` its number of links, component and whether it is kept."""
    vectors = stored(unit_vectors(embeddings), "vectors")
    out = None
    lengths = [row.dims for row in vectors.select("dims").distinct().orderBy("dims").collect()]
    for dims in lengths:
        rows = stored(link_length(vectors, dims, cosine), "linked")
        low = rows.where("root IS NOT NULL").groupBy("root").agg(F.min("vec_id").alias("low"))
        rows = rows.join(low, "root", "left").select(
            "vec_id", "n_links", F.coalesce("low", "vec_id").alias("component_id")
        )
        out = rows if out is None else out.unionByName(rows)
    # the rest: as many rows of an id as there are beyond the valid ones
    every = embeddings.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.count(F.lit(1)).alias("n"))
    valid = vectors.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n_valid"))
    rest = (
        every.join(valid.withColumnRenamed("vec_id", "valid_id"), F.col("vec_id").eqNullSafe(F.col("valid_id")), "left")
        .select("vec_id", (F.col("n") - F.coalesce("n_valid", F.lit(0))).cast("int").alias("times"))
        .where("times > 0")
        .select("vec_id", F.explode(F.array_repeat(F.lit(0).cast("long"), F.col("times"))).alias("n_links"))
        .select("vec_id", "n_links", F.col("vec_id").alias("component_id"))
    )
    out = rest if out is None else out.unionByName(rest)
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull())
    return out.select("vec_id", "n_links", "component_id", kept.alias("kept"))
