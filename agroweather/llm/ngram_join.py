"""N-gram Jaccard join (operator 5): documents linked by their word shingles.

Method: a prefix-tree join. The shingle sets of a block are ordered globally
and stored as a trie; a set is matched against the trie depth first, overlaps
of shared prefixes are counted once, and a subtree is left as soon as the
remaining lengths cannot reach the similarity any more.

Two sets x and y link when 100 |x & y| >= 75 |x | y|, which is the same as
7 |x ^ y| <= |x| + |y| (7 = (1 + t) / (1 - t) for t = 0.75). The blocks come from
exact filters, so no link is lost:

1. Documents with equal sets form one class; only classes are compared.
2. Shingles are ordered by how often their hash bucket occurs in the whole
   corpus, rare first. Linked sets share a shingle among the first
   |x| - ceil(0.75 |x|) + 1 of this order, so classes meet in the lists of these
   shingles. Shingles of very full buckets are salted before they are shuffled.
3. In a list, a parity bitmap of about one bit a shingle bounds |x ^ y| from
   below; classes that pass are joined to clusters. All lists' clusters with one
   smallest class are one block, and a block holds each class once.
4. A block reads its texts, builds the trie and gives links that connect what
   is linked; classes already connected in the block are not compared again.

Lists and blocks that are too large for one task are cut into parts, and every
pair of parts becomes a task of its own: more tasks, but no pair is lost.

Words are runs without white space, A-Z lower-cased. A set holds the 5-word
shingles; with fewer words the whole sequence is its one shingle. Shingles,
sets and list members are 64-bit hashes.

Defined results: without words or text the set is empty and the row is linked
with nothing; the component is then the row's own id. A NULL id is passed over
by minima, so a NULL row linked with others has their smallest id. Rows of one
id with different texts are rows of their own; repeated rows give repeated
rows; an empty table gives an empty table; further columns are kept by
``keep_representatives`` and not read otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agroweather.llm.common import set_aside, slices, stored
from agroweather.llm.components import connected_components

SHINGLE_WORDS = 5
CACHED_WORDS = 150_000
BUCKETS = 1 << 20
BLOCK_OF_BUCKETS = 1 << 12
LIST_PART = 20_000  # classes of one list in one task
BLOCK_PART = 1_500_000  # shingles of one block in one task
MEMBER_COST = 500  # what a set counts besides its shingles
SALT_FROM = 100_000  # bucket count per salt

_U = np.uint64
_MULTIPLIERS = tuple(
    _U(value)
    for value in (
        0x9E3779B97F4A7C15,
        0xC2B2AE3D27D4EB4F,
        0x165667B19E3779F9,
        0xD6E8FEB86659FD93,
        0xA0761D6478BD642F,
    )
)


class Shingler:
    """Sorted distinct shingle hashes of texts, with a bounded cache of word hashes."""

    def __init__(self):
        self.hashes: dict[bytes, int] = {}

    def _hash(self, words: list[bytes]) -> np.ndarray:
        known = self.hashes
        if len(known) > CACHED_WORDS:
            known.clear()
        out = []
        for word in words:
            value = known.get(word)
            if value is None:
                value = known[word] = xxhash.xxh3_64_intdigest(word) >> 1
            out.append(value)
        return np.array(out, dtype=np.int64).view(_U)

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode().lower().split()
        if not words:
            return np.empty(0, _U)
        hashes = self._hash(words)
        size = min(SHINGLE_WORDS, len(words))
        count = len(words) - size + 1
        mixed = np.full(count, size, _U)
        for place in range(size):
            mixed += hashes[place : place + count]
            mixed *= _MULTIPLIERS[place]
            mixed ^= mixed >> _U(31)
        mixed.sort()
        return mixed[np.concatenate([[True], mixed[1:] != mixed[:-1]])]


def class_of(shingles: np.ndarray) -> int:
    """64-bit identity of a set."""
    return int(np.array([xxhash.xxh3_64_intdigest(shingles.tobytes())], _U).view(np.int64)[0])


def prefix_length(size: int) -> int:
    return size - -(-3 * size // 4) + 1


def bitmap(shingles: np.ndarray) -> bytes:
    """Parity of the number of shingles per hash remainder; as many bits as a power of two >= the set."""
    bits = max(64, 1 << (len(shingles) - 1).bit_length())
    counts = np.bincount((shingles & _U(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def folded_to(rows: np.ndarray, width: int) -> np.ndarray:
    """Bitmaps for fewer remainders: a half is laid upon the other until ``width`` bytes are left."""
    while rows.shape[1] > width:
        half = rows.shape[1] // 2
        rows = rows[:, :half] ^ rows[:, half:]
    return rows


def signatures(docs: DataFrame) -> DataFrame:
    """A row per document (``doc_id, body, cid, n, bits``) and rows of bucket counts (``block, counts``).

    ``body``, a hash of the text, is passed on; with the id it names a row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, counts = Shingler(), np.zeros(BUCKETS, np.int32)
        for batch in slices(batches):
            cids, sizes, bits, found = [], [], [], [np.empty(0, np.int64)]
            for text in batch.column(2).to_pylist():
                shingles = shingler(text)
                cids.append(class_of(shingles))
                sizes.append(len(shingles))
                bits.append(bitmap(shingles) if len(shingles) else b"")
                found.append((shingles >> _U(44)).astype(np.int64))
            counts += np.bincount(np.concatenate(found), minlength=BUCKETS).astype(np.int32)
            none = pa.nulls(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(cids, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(bits, pa.binary()),
                    none.cast(pa.int32()),
                    none.cast(pa.binary()),
                ],
                names=["doc_id", "body", "cid", "n", "bits", "block", "counts"],
            )
        blocks = counts.reshape(-1, BLOCK_OF_BUCKETS)
        used = np.flatnonzero(blocks.any(axis=1))
        none = pa.nulls(len(used))
        yield pa.RecordBatch.from_arrays(
            [
                *(none.cast(pa.int64()) for _ in range(4)),
                none.cast(pa.binary()),
                pa.array(used, pa.int32()),
                pa.array([blocks[i].tobytes() for i in used], pa.binary()),
            ],
            names=["doc_id", "body", "cid", "n", "bits", "block", "counts"],
        )

    schema = "doc_id long, body long, cid long, n long, bits binary, block int, counts binary"
    return docs.mapInArrow(run, schema)


def bucket_counts(signed: DataFrame) -> np.ndarray:
    """Occurrences per bucket over the whole corpus; a table of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(counts, np.int32)
                if block in total:
                    total[block] += part
                else:
                    total[block] = part.astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(total.keys(), pa.int32()),
                pa.array([counts.tobytes() for counts in total.values()], pa.binary()),
            ],
            names=["block", "counts"],
        )

    parts = (
        signed.where("block IS NOT NULL")
        .select("block", "counts")
        .repartition("block")
        .mapInArrow(run, "block int, counts binary")
    )
    counts = np.zeros((BUCKETS // BLOCK_OF_BUCKETS, BLOCK_OF_BUCKETS), np.int64)
    for block, part in parts.collect():  # BUCKETS numbers in all
        counts[block] += np.frombuffer(part, np.int64)
    return counts.ravel()


def prefix_rows(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """Rows ``token, salt, cid``: each set's first shingles in the global order.

    The salt is 0 but for shingles of full buckets, where it spreads the classes.
    """
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, counts, seen = Shingler(), shared.value, set()
        for batch in slices(batches):
            tokens, salts, owners = [], [], []
            for text in batch.column(0).to_pylist():
                shingles = shingler(text)
                if not len(shingles):
                    continue
                cid = class_of(shingles)
                if cid in seen:  # an equal set of this task
                    continue
                if len(seen) < 1_000_000:
                    seen.add(cid)
                often = counts[(shingles >> _U(44)).astype(np.int64)]
                length = prefix_length(len(shingles))
                # ties by hash: the shingles are sorted already
                first = np.argsort(often, kind="stable")[:length]
                spread = often[first] // SALT_FROM
                tokens.append(shingles[first])
                salts.append(np.where(spread > 0, cid % (spread + 1) + 1, 0).astype(np.int32))
                owners.append(np.full(length, cid, np.int64))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(tokens).view(np.int64)),
                        pa.array(np.concatenate(salts)),
                        pa.array(np.concatenate(owners)),
                    ],
                    names=["token", "salt", "cid"],
                )

    return docs.select("text").mapInArrow(run, "token long, salt int, cid long")


def shared_rows(prefixes: DataFrame) -> DataFrame:
    """Distinct rows ``token, cid`` without the shingles of one class only.

    Most shingles go here, after one shuffle; salted ones all stay.
    """
    same = Window.partitionBy("token", "salt")
    several = F.min("cid").over(same) != F.max("cid").over(same)
    return (
        prefixes.withColumn("several", several)
        .where("several OR salt > 0")
        .select("token", "cid")
        .distinct()
    )


def in_parts(rows: DataFrame, key: str, weights: DataFrame, limit: int) -> DataFrame:
    """``rows`` with a string ``task``: the key, or for heavy keys one task per pair of parts.

    ``weights`` gives ``weight`` per key. A key over ``limit`` is cut into parts
    by a hash of ``cid``; a row goes to the tasks of its part with every part.
    """
    parts = F.ceil(F.col("weight") / F.lit(limit)).cast("int")
    sized = rows.join(weights, key).withColumn("parts", F.greatest(parts, F.lit(1)))
    part = F.pmod(F.xxhash64(F.lit(5), "cid"), F.col("parts")).cast("int")
    sized = sized.withColumn("part", part)
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    whole = sized.where("parts = 1").withColumn("task", F.concat_ws(":", F.col(key)))
    cut = sized.where("parts > 1").select("*", other.alias("other"))
    cut = cut.withColumn(
        "task", F.concat_ws(":", F.col(key), F.least("part", "other"), F.greatest("part", "other"))
    ).drop("other")
    return whole.unionByName(cut).drop("parts", "part", "weight")


def shared_lists(prefixes: DataFrame) -> DataFrame:
    """Rows ``token, weight``: of each distinct list of two or more classes one token and the length."""
    mark = F.xxhash64(F.lit(3), "cid")
    return (
        prefixes.groupBy("token")
        .agg(
            F.count(F.lit(1)).alias("weight"),
            F.bit_xor(mark).alias("mark"),
            F.sum(F.shiftright(mark, 20)).alias("total"),
        )
        .where("weight > 1")
        .groupBy("weight", "mark", "total")
        .agg(F.min("token").alias("token"))
        .select("token", "weight")
    )


class Clusters:
    """Union-find over small integers."""

    def __init__(self, size: int):
        self.up = list(range(size))

    def find(self, at: int) -> int:
        up = self.up
        while up[at] != at:
            up[at] = up[up[at]]
            at = up[at]
        return at

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def cluster_list(sizes: np.ndarray, bits: list[bytes]) -> list[np.ndarray]:
    """Members of a list joined wherever the bitmaps allow a link; clusters of two or more.

    Breadth first: a member is compared with those not reached yet only, so a
    list of near copies costs one comparison a member.
    """
    widths = np.array([len(b) for b in bits])
    stacks = {}
    for width in np.unique(widths).tolist():
        at = np.flatnonzero(widths == width)
        rows = np.frombuffer(b"".join(bits[i] for i in at), np.uint8)
        stacks[width] = at, rows.reshape(len(at), width)
    waiting = {width: np.ones(len(at), bool) for width, (at, _) in stacks.items()}
    slot = np.empty(len(bits), np.int64)
    for at, _ in stacks.values():
        slot[at] = np.arange(len(at))
    out = []
    for seed in range(len(bits)):
        if not waiting[int(widths[seed])][slot[seed]]:
            continue
        waiting[int(widths[seed])][slot[seed]] = False
        queue, members = [seed], [seed]
        while queue:
            v = queue.pop()
            width = int(widths[v])
            own = stacks[width][1][slot[v]][None, :]
            for other in (width // 2, width, width * 2):
                if other not in stacks:
                    continue
                at, rows = stacks[other]
                left = np.flatnonzero(waiting[other])
                if not len(left):
                    continue
                both = sizes[at[left]] + sizes[v]
                near = 7 * np.abs(sizes[at[left]] - sizes[v]) <= both
                left, both = left[near], both[near]
                if not len(left):
                    continue
                if other < width:
                    differ = rows[left] ^ folded_to(own, other)
                elif other > width:
                    differ = folded_to(rows[left], width) ^ own
                else:
                    differ = rows[left] ^ own
                passed = left[7 * np.bitwise_count(differ).sum(axis=1, dtype=np.int64) <= both]
                waiting[other][passed] = False
                found = at[passed].tolist()
                queue += found
                members += found
        if len(members) > 1:
            out.append(np.array(members))
    return out


def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Table]]:
    """Consecutive rows of one first column, from rows sorted by it."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        keys = batch.column(0).to_pylist()
        start = 0
        for end in range(1, len(keys) + 1):
            if end < len(keys) and keys[end] == keys[start]:
                continue
            if held and keys[start] != current:
                yield current, pa.Table.from_batches(held)
                held = []
            current = keys[start]
            held.append(batch.slice(start, end - start))
            start = end
    if held:
        yield current, pa.Table.from_batches(held)


def clusters(listed: DataFrame) -> DataFrame:
    """Rows ``leader, cid`` from rows ``task, cid, n, bits``: candidate clusters of all lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[tuple[int, int]] = set()
        for _, rows in grouped(batches):
            cids = rows.column("cid").to_numpy()
            for members in cluster_list(rows.column("n").to_numpy(), rows.column("bits").to_pylist()):
                found = cids[members]
                leader = int(found.min())
                fresh = [cid for cid in found.tolist() if (leader, cid) not in sent]
                if len(sent) > 1_000_000:
                    sent.clear()
                sent.update((leader, cid) for cid in fresh)
                if fresh:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([leader] * len(fresh), pa.int64()), pa.array(fresh, pa.int64())],
                        names=["leader", "cid"],
                    )

    dealt = listed.repartition("task").sortWithinPartitions("task")
    return dealt.mapInArrow(run, "leader long, cid long")


class PrefixTree:
    """Sets over ranks, in lexicographic order, with the lengths of common prefixes.

    The order is by frequency in the block, frequent first, so that near copies
    share long prefixes. The lengths stand for the trie: sets in a row that share
    d ranks with a set are one subtree below it.
    """

    def __init__(self, sets: list[np.ndarray]):
        tokens, inverse, counts = np.unique(
            np.concatenate(sets), return_inverse=True, return_counts=True
        )
        rank = np.empty(len(tokens), np.int64)
        rank[np.lexsort((tokens, -counts))] = np.arange(len(tokens))
        bounds = np.cumsum([0, *map(len, sets)])
        ranked = [np.sort(rank[inverse[a:b]]) for a, b in zip(bounds, bounds[1:])]
        self.order = sorted(range(len(sets)), key=lambda i: ranked[i].astype(">u4").tobytes())
        self.paths = [ranked[i] for i in self.order]
        self.size = len(tokens)
        self.common = [0]
        for left, right in zip(self.paths, self.paths[1:]):
            k = min(len(left), len(right))
            differ = np.flatnonzero(left[:k] != right[:k])
            self.common.append(int(differ[0]) if len(differ) else k)

    def links(self) -> Iterator[tuple[int, int]]:
        """Pairs of linked sets (places given in) that connect all that is linked."""
        joined, marked = Clusters(len(self.paths)), np.zeros(self.size, bool)
        groups = 1  # among the sets so far
        for probe in range(1, len(self.paths)):
            groups += 1
            marked[self.paths[probe]] = True
            for other in self._matches(probe, marked, joined):
                joined.join(probe, other)
                groups -= 1
                yield self.order[probe], self.order[other]
                if groups == 1:
                    break
            marked[self.paths[probe]] = False

    def _matches(self, probe: int, marked: np.ndarray, joined: Clusters) -> Iterator[int]:
        """Sets before ``probe`` that link with it and are not connected with it yet."""
        n = len(self.paths[probe])
        hits = np.zeros(1, np.int64)  # overlap after each rank of the current path
        valid = 0  # ranks of the current path that ``hits`` holds
        skip_from = None  # a left subtree: its sets share this many ranks
        for other in range(probe):
            valid = min(valid, self.common[other])
            if skip_from is not None:
                if self.common[other] >= skip_from:
                    valid = min(valid, self.common[other])
                    continue
                skip_from = None
            path = self.paths[other]
            if joined.find(other) == joined.find(probe):
                continue
            m = len(path)
            if 7 * abs(n - m) > n + m:
                continue
            fresh = hits[valid] + np.cumsum(marked[path[valid:]])
            hits = np.concatenate([hits[: valid + 1], fresh])
            valid = m
            if 7 * (n + m - 2 * int(hits[m])) <= n + m:
                yield other
                continue
            # A set that links with the probe has at most ``most`` shingles. After d
            # ranks, d - hits are missing from the probe, and what the rest of such a
            # set cannot cover of the probe differs as well.
            most, depth = 4 * n // 3, np.arange(m + 1)
            differ = depth - hits + np.maximum(0, n - hits - (most - depth))
            hopeless = np.flatnonzero(7 * differ > n + most)
            skip_from = int(hopeless[0]) if len(hopeless) else None


def verified_links(members: DataFrame) -> DataFrame:
    """Rows ``a, b`` (linked classes) from rows ``task, cid, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for _, rows in grouped(batches):
            sets: dict[int, np.ndarray] = {}
            for cid, text in zip(rows.column("cid").to_pylist(), rows.column("text").to_pylist(), strict=True):
                if cid not in sets:
                    shingles = shingler(text)
                    if class_of(shingles) == cid:  # not another row of the same id
                        sets[cid] = shingles
            if len(sets) < 2:
                continue
            cids = list(sets)
            pairs = [(cids[a], cids[b]) for a, b in PrefixTree(list(sets.values())).links()]
            if pairs:
                a, b = zip(*pairs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]
                )

    dealt = members.repartition("task").sortWithinPartitions("task")
    return dealt.mapInArrow(run, "a long, b long")


def shingle_components(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (``doc_id`` long, ``text``) its set's class, size and component."""
    named = docs.select("doc_id", F.xxhash64("text").alias("body"), "text")
    signed = stored(signatures(named), "signatures")
    rows = signed.where("block IS NULL").select("doc_id", "body", "cid", "n", "bits")
    classes = rows.where("n > 0").groupBy("cid").agg(
        F.min("doc_id").alias("low"), F.max("n").alias("n"), F.first("bits").alias("bits")
    )
    classes = stored(classes, "classes")
    prefixes = stored(shared_rows(prefix_rows(docs, bucket_counts(signed))), "prefixes")
    lists = shared_lists(prefixes)
    listed = in_parts(prefixes, "token", lists, LIST_PART).join(
        classes.select("cid", "n", "bits"), "cid"
    )
    candidates = clusters(listed.select("task", "cid", "n", "bits")).distinct()
    candidates = candidates.join(classes.select("cid", "n", "low"), "cid")
    candidates = stored(candidates, "candidates")
    weights = candidates.groupBy("leader").agg(F.sum(F.col("n") + MEMBER_COST).alias("weight"))
    blocks = in_parts(candidates, "leader", weights, BLOCK_PART)
    source = docs.select(F.col("doc_id").alias("source_id"), "text")
    members = blocks.join(source, F.col("low").eqNullSafe(F.col("source_id")))
    links = verified_links(members.select("task", "cid", "text"))
    roots = connected_components(links)
    low = (
        roots.join(classes.select(F.col("cid").alias("node"), "low"), "node")
        .groupBy("root")
        .agg(F.min("low").alias("component_id"))
    )
    named = roots.join(low, "root").select(F.col("node").alias("cid"), "component_id")
    rest = classes.join(named, "cid", "left").select(
        "cid", F.coalesce("component_id", "low").alias("component_id")
    )
    rest = stored(rest, "class-components")  # so that the join can split a class of many copies
    return (
        rows.select("doc_id", "body", "cid", "n")
        .join(rest, "cid", "left")
        .select(
            "doc_id",
            "body",
            F.col("cid").alias("class_id"),
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        )
    )


def link_documents(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` its set size and component."""
    chosen = docs.select(F.col("doc_id").cast("long"), "text")
    return shingle_components(chosen).select("doc_id", "n_shingles", "component_id")


def keep_representatives(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` of the smallest id of each component; all columns as they were.

    Texts without words are no copies of each other and all stay, as do rows
    with a NULL id. Rows of one id are kept or dropped each by its own text;
    repeated rows are one document and stay repeated.
    """
    docs, back = set_aside(docs, ["__doc", "__body"])
    found = shingle_components(docs.select(F.col("doc_id").cast("long"), "text"))
    gone = (
        found.where("n_shingles > 0 AND component_id < doc_id")
        .select(F.col("doc_id").alias("__doc"), F.col("body").alias("__body"))
        .distinct()
    )
    same = (F.col("doc_id").cast("long") == F.col("__doc")) & (F.xxhash64("text") == F.col("__body"))
    return docs.join(gone, same, "left_anti").withColumnsRenamed(back)
