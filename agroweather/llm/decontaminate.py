"""Benchmark decontamination (operator 9).

Method: a generalised suffix automaton over the normalised words of all test
items. A document's words are streamed through it while the longest matching
length is kept; wherever that length reaches a window, the window's words are
hit. Tasks cut the items into blocks of a bounded number of words, a longer item
into pieces that share a window less one word, and build an automaton of each.
The packed automata are stored and broadcast ``BLOCKS_AT_ONCE`` at a time, so what
passes the driver is bounded. A task holds one automaton: it takes them one after
the other over a bounded share of its documents. Documents are mapped, not
shuffled, and read once for every ``BLOCKS_AT_ONCE`` blocks.

Words: A-Z lower-cased, runs of digits, a-z and non-ASCII characters. A window is
``WINDOW`` consecutive words of an item; a shorter, non-empty item is one window.

Defined results: a NULL or empty text has no words and is not contaminated; a
NULL or empty item has no window; items may repeat, each id is listed once; a
NULL item id takes part in hits but is not listed; repeated rows give repeated
rows; an empty table gives an empty table, an empty benchmark no hits.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agroweather.llm.common import free_name, sha256, slices, stored

WINDOW = 10
BLOCK_WORDS = 200_000
BLOCKS_PER_TASK = 4  # built one after the other
BLOCKS_AT_ONCE = 24  # of about 4 MB each when packed
HELD_BYTES = 64 << 20  # of documents that a task keeps while it changes automata
# Share of a text's words from which on the whole document goes.
COVERAGE_LIMIT = 0.5

_BREAKS = bytes(
    byte if byte >= 128 or chr(byte).isdigit() or chr(byte).isalpha() else 32 for byte in range(256)
)
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

REPORT = (
    "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().translate(_BREAKS).split()


class SuffixAutomaton:
    """All substrings of the items added, over integer letters.

    ``marks`` gives, for each state that some window ends in, the window lengths
    there and the items that hold the window.
    """

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int):
        self.window = window
        self.letters: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = []
        for item, words in items:
            if words:
                codes = [self.letters.setdefault(word, len(self.letters)) for word in words]
                coded.append((item, codes))
                self._add(codes)
        self.marks: dict[int, dict[int, set]] = {}
        for item, codes in coded:
            self._mark(item, codes)
        self.shortest = min((min(len(codes), window) for _, codes in coded), default=0)
        # a state's nearest one with marks, itself or up its links; 0 where there is none
        self.marked = [0] * len(self.length)
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            self.marked[state] = state if state in self.marks else self.marked[self.link[state]]

    def pack(self) -> bytes:
        """Plain data, without the class, which workers may have by value only."""
        return zlib.compress(pickle.dumps(vars(self)), 1)

    @classmethod
    def unpack(cls, data: bytes) -> SuffixAutomaton:
        own = cls.__new__(cls)
        vars(own).update(pickle.loads(zlib.decompress(data)))
        return own

    def _clone(self, source: int, length: int) -> int:
        self.step.append(dict(self.step[source]))
        self.link.append(self.link[source])
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, at: int, letter: int) -> int:
        """The state of ``at``'s longest word plus ``letter``, parted from longer words."""
        target = self.step[at][letter]
        if self.length[target] == self.length[at] + 1:
            return target
        part = self._clone(target, self.length[at] + 1)
        self.link[target] = part
        while at >= 0 and self.step[at].get(letter) == target:
            self.step[at][letter] = part
            at = self.link[at]
        return part

    def _add(self, codes: list[int]) -> None:
        last = 0
        for letter in codes:
            if letter in self.step[last]:
                last = self._split(last, letter)
                continue
            new = len(self.length)
            self.step.append({})
            self.link.append(0)
            self.length.append(self.length[last] + 1)
            at = last
            while at >= 0 and letter not in self.step[at]:
                self.step[at][letter] = new
                at = self.link[at]
            if at >= 0:
                self.link[new] = self._split(at, letter)
            last = new

    def stream(self, codes: list[int]) -> Iterator[tuple[int, int, int]]:
        """Position, state and longest matching length after each word of a text."""
        step, link, length = self.step, self.link, self.length
        state = matched = 0
        for place, letter in enumerate(codes):
            while state and letter not in step[state]:
                state = link[state]
                matched = length[state]
            nxt = step[state].get(letter)
            if nxt is None:
                matched = 0
            else:
                state, matched = nxt, matched + 1
            yield place, state, matched

    def _mark(self, item: object, codes: list[int]) -> None:
        size = min(self.window, len(codes))
        for _, state, matched in self.stream(codes):
            if matched >= size:
                self.marks.setdefault(self._holder(state, size), {}).setdefault(size, set()).add(item)

    def _holder(self, state: int, size: int) -> int:
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Joined hit spans in word positions, and the items whose windows occur."""
        spans: list[tuple[int, int]] = []
        items: set = set()
        get = self.letters.get
        codes = np.fromiter((get(word, -1) for word in words), np.int64, len(words))
        known = np.flatnonzero(np.diff(np.concatenate([[0], codes >= 0, [0]]).astype(np.int8)))
        for start, end in zip(known[::2].tolist(), known[1::2].tolist(), strict=True):
            if end - start < self.shortest:
                continue
            for place, state, matched in self.stream(codes[start:end].tolist()):
                if matched < self.shortest:
                    continue
                longest, state = 0, self.marked[state]
                while state:
                    for size, holders in self.marks[state].items():
                        if size <= matched:
                            longest = max(longest, size)
                            items |= holders
                    state = self.marked[self.link[state]]
                if longest:
                    begin, stop = start + place + 1 - longest, start + place + 1
                    while spans and begin <= spans[-1][1]:
                        begin = min(begin, spans.pop()[0])
                    spans.append((begin, stop))
        return spans, items


def joined_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def pieces(words: list[bytes], window: int, most: int) -> list[list[bytes]]:
    """``words`` in pieces of at most ``most`` (a window at least) that hold all its windows."""
    most = max(most, window)
    if len(words) <= most:
        return [words]
    return [words[at : at + most] for at in range(0, len(words) - window + 1, most - window + 1)]


def packed_automata(
    benchmark: DataFrame, item_id: str, text: str, window: int, block_words: int
) -> DataFrame:
    """Rows ``part, seq, data``: the packed automaton of each block of the distinct items."""
    items = benchmark.select(F.col(item_id).alias("item"), F.col(text).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = 1 + size // (6 * block_words * BLOCKS_PER_TASK)  # a word takes about six bytes
    dealt = items.repartition(tasks, "item", "text").distinct().select(F.spark_partition_id().alias("part"), "item", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[tuple[str | None, list[bytes]]] = []
        held = seq = part = 0

        def built() -> pa.RecordBatch:
            row = [[part], [seq], [SuffixAutomaton(block, window).pack()]]
            kinds = [pa.int32(), pa.int32(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(cell, kind) for cell, kind in zip(row, kinds, strict=True)], names=["part", "seq", "data"]
            )

        for batch in slices(batches):
            for part, item, value in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                for piece in pieces(words_of(value), window, block_words):
                    if block and held + len(piece) > block_words:
                        yield built()
                        block, held, seq = [], 0, seq + 1
                    if piece:
                        block.append((None if item is None else str(item), piece))
                        held += len(piece)
        if block:
            yield built()

    return dealt.mapInArrow(run, "part int, seq int, data binary")


def held_slices(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[pa.RecordBatch]]:
    """The slices of ``batches`` in lists of about ``most`` bytes, one slice at least."""
    held, size = [], 0
    for batch in slices(batches):
        held.append(batch)
        size += batch.nbytes
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


SPANS = T.ArrayType(T.ArrayType(T.IntegerType()))
ITEMS = T.ArrayType(T.StringType())
Finish = Callable[[pa.RecordBatch, list, list], pa.RecordBatch]


def find_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    finish: Finish,
    schema: T.StructType | str,
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """What ``finish`` makes of each batch of ``docs``, its joined hit spans and the items found.

    Spans count words, items are ids as sorted strings. One pass over the
    documents per ``BLOCKS_AT_ONCE`` blocks of items, ``finish`` in the last;
    between two passes the rows are stored with what was found.
    """
    spark, names = docs.sparkSession, docs.columns
    place = names.index(text)
    held = [free_name(names, "__spans"), free_name(names, "__items")]
    out = docs.withColumn(held[0], F.array().cast(SPANS)).withColumn(held[1], F.array().cast(ITEMS))
    between = out.schema

    def passing(packed: list[bytes], last: bool):
        shared = spark.sparkContext.broadcast(packed)

        def search(batch: pa.RecordBatch, automaton: SuffixAutomaton, spans: list, items: list) -> None:
            for row, value in enumerate(batch.column(place).to_pylist()):
                found, holders = automaton.find(words_of(value))
                if found:
                    spans[row] = joined_spans([*map(tuple, spans[row]), *found])
                    items[row] = sorted({item for item in holders if item is not None}.union(items[row]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            packed, one = shared.value, None
            if len(packed) == 1:
                one = SuffixAutomaton.unpack(packed[0])
            for own in held_slices(batches, 0 if one else HELD_BYTES):
                found = [[batch.column(len(names) + i).to_pylist() for i in range(2)] for batch in own]
                for data in packed:
                    automaton = one or SuffixAutomaton.unpack(data)
                    for batch, hits in zip(own, found, strict=True):
                        search(batch, automaton, *hits)
                for batch, (spans, items) in zip(own, found, strict=True):
                    plain = pa.RecordBatch.from_arrays(batch.columns[: len(names)], names=names)
                    if last:
                        yield finish(plain, spans, items)
                        continue
                    columns = [pa.array(spans, pa.list_(pa.list_(pa.int32()))), pa.array(items, pa.list_(pa.string()))]
                    yield pa.RecordBatch.from_arrays([*plain.columns, *columns], names=[*names, *held])

        return run

    automata = stored(packed_automata(benchmark, item_id, item_text, window, block_words), "automata")
    keys = [tuple(row) for row in automata.select("part", "seq").orderBy("part", "seq").collect()]  # one per block
    for start in range(0, max(1, len(keys)), BLOCKS_AT_ONCE):
        wanted = F.lit(False)
        for part, seq in keys[start : start + BLOCKS_AT_ONCE]:
            wanted = wanted | ((F.col("part") == part) & (F.col("seq") == seq))
        packed = [bytes(row.data) for row in automata.where(wanted).collect()]  # BLOCKS_AT_ONCE at most
        if start + BLOCKS_AT_ONCE >= len(keys):
            return out.mapInArrow(passing(packed, True), schema)
        out = stored(out.mapInArrow(passing(packed, False), between), "decontaminate")


def contamination_report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``) its words, hit words and items found."""

    def finish(batch: pa.RecordBatch, spans: list, items: list) -> pa.RecordBatch:
        hit = [sum(end - start for start, end in row) for row in spans]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([len(words_of(value)) for value in batch.column(1).to_pylist()], pa.int64()),
                pa.array(hit, pa.int64()),
                pa.array([len(row) for row in items], pa.int64()),
                pa.array([sha256(",".join(row).encode()) for row in items], pa.string()),
                pa.array([n > 0 for n in hit], pa.bool_()),
            ],
            names=REPORT.replace(",", "").split()[::2],
        )

    chosen = docs.select(F.col("doc_id").cast("long"), "text")
    return find_hits(chosen, benchmark, finish, REPORT, **options)


def cut_words(text: str, spans: list[list[int]]) -> str:
    """``text`` without the words of the spans and what stands between them."""
    data = text.encode()
    places = [match.span() for match in _WORD.finditer(data.lower())]
    out, at = [], 0
    for start, end in spans:
        out.append(data[at : places[start][0]])
        at = places[end - 1][1]
    return b"".join([*out, data[at:]]).decode()


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    coverage_limit: float = COVERAGE_LIMIT,
    **options,
) -> DataFrame:
    """``docs`` with hit spans cut out of the texts; all columns stay.

    Documents of which hits cover ``coverage_limit`` of the words or more go as
    a whole. Documents without hits are left as they are.
    """
    place = docs.columns.index(text)

    def finish(batch: pa.RecordBatch, spans: list, items: list) -> pa.RecordBatch:
        values = batch.column(place).to_pylist()
        keep = []
        for row, own in enumerate(spans):
            hit = sum(end - start for start, end in own)
            keep.append(not hit or hit < coverage_limit * len(words_of(values[row])))
            if hit:
                values[row] = cut_words(values[row], own)
        columns = list(batch.columns)
        columns[place] = pa.array(values, pa.string())
        return pa.RecordBatch.from_arrays(columns, names=batch.schema.names).filter(
            pa.array(keep, pa.bool_())
        )

    return find_hits(docs, benchmark, finish, docs.schema, text=text, **options)
