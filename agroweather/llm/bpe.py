"""BPE encoding and decoding with a public word-level vocabulary (operator 3).

Method: the distinct words of a slice of rows that are not cached are merged
together. Each is a row of a matrix and a doubly linked list of symbols; a round
merges the pair of lowest rank of every row. Long words are merged singly, with a
priority queue of ranks; queue entries whose symbols have changed meanwhile are
stale and skipped. Decoding concatenates the vocabulary strings of the ids. Rows
are independent, so the job is one map without a shuffle; each Python worker
keeps a bounded cache of encoded words in two generations, so that frequent
words outlive the many that occur once.

Defined results: a NULL text is the empty text, which has no ids and decodes to
the empty string; a NULL id stays NULL; repeated rows give repeated rows; an
empty table gives an empty table; further columns of the input are not read.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from agroweather.llm.common import sha256, slices, texts

CACHED_WORDS = 120_000  # of one generation, beside those of the last slice
LONGEST_CACHED = 64  # code points
LONGEST_ROW = 64  # bytes of a word that is merged in a matrix
MATRIX_ROWS = 8192
WORDS_BYTES = 1 << 20  # of the texts whose words are merged together
NO_PAIR = np.iinfo(np.int32).max
# What the public tokenizers library takes as white space.
SPACE = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PYTHON_ONLY_SPACE = "\x1c\x1d\x1e\x1f"  # for str.split, not for the library
NO_CHARACTER = "\uffff"
# Letters and numbers that the tokenizers library knows beyond Python's tables.
NEWER = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D40, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
    (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x116D0, 0x116E3),
    (0x11BC0, 0x11BE0), (0x11BF0, 0x11BF9), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16130, 0x16139),
    (0x16D40, 0x16D6C), (0x16D70, 0x16D79), (0x18CFF, 0x18CFF), (0x1CCF0, 0x1CCF9), (0x1E5D0, 0x1E5ED),
    (0x1E5F0, 0x1E5FA),
)
# First and last capital, distance to the small letter.
NEWER_CAPITALS = (
    (0x1C89, 0x1C89, 1), (0xA7CB, 0xA7CB, 0x264 - 0xA7CB), (0xA7CC, 0xA7CC, 1), (0xA7CE, 0xA7CE, 1),
    (0xA7D2, 0xA7D2, 1), (0xA7D4, 0xA7D4, 1), (0xA7DA, 0xA7DA, 1), (0xA7DC, 0xA7DC, 0x19B - 0xA7DC),
    (0x10D50, 0x10D65, 0x20), (0x16EA0, 0x16EB8, 0x1B),
)
NEWER_SMALL = {
    point: point + distance for first, last, distance in NEWER_CAPITALS for point in range(first, last + 1)
}

ENCODED = "doc_id long, ids array<int>, n_tokens long, ids_sha256 string, decoded_sha256 string"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_letters() -> dict[int, str]:
    """Printable stand-in of each byte: itself, or the next free code point from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in set(shown)]
    return {byte: chr(byte) for byte in shown} | {
        byte: chr(256 + place) for place, byte in enumerate(hidden)
    }


def unassigned(letter: str) -> bool:
    """Whether the tokenizers library has no category for a character."""
    if unicodedata.category(letter) != "Cn":
        return False
    return not any(first <= ord(letter) <= last for first, last in NEWER)


class Bpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, normalizers = spec["model"], spec["normalizer"]["normalizers"]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        kinds = [step["type"] for step in normalizers]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or spec["decoder"]:
            raise ValueError(f"{path} is not a lower-casing word BPE vocabulary")
        vocab = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.strings = {i: text for text, i in vocab.items()}
        self.special = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.strings.update({i: text for text, i in self.special.items()})
        self.special_split = regex.compile(
            "(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")"
        )
        # rank by pair, and the symbol that the pair of a rank becomes
        self.ranks: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for rank, (left, right) in enumerate(model["merges"]):
            self.ranks[vocab[left], vocab[right]] = rank
            self.made.append(vocab[left + right])
        letters = byte_letters()
        self.inner = [vocab[letters[byte]] for byte in range(256)]
        self.final = [vocab[letters[byte] + self.suffix] for byte in range(256)]
        self.pieces = regex.compile(split["pattern"]["Regex"].replace("\\s", SPACE))
        self.chunks = regex.compile(f"[^{SPACE}]+")
        # the same for arrays: pairs as sorted numbers, the last larger than any pair
        self.absent = max(self.strings) + 1
        ranks = np.fromiter(self.ranks.values(), np.int32, len(self.ranks))
        pairs = np.array(list(self.ranks), np.int64).reshape(-1, 2) @ [self.absent + 1, 1]
        order = np.argsort(pairs)
        self.pair_numbers = np.append(pairs[order], (self.absent + 1) ** 2)
        self.pair_ranks = np.append(ranks[order], NO_PAIR).astype(np.int32)
        self.made_of_rank = np.array(self.made, np.int64)
        self.byte_symbols = np.array([self.inner, self.final], np.int64)
        self.assigned: set[str] = set()
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.spelled = pa.array(
            [self.strings.get(i, "") for i in range(max(self.strings) + 1)], pa.large_string()
        )

    def merge_word(self, word: bytes) -> list[int]:
        """Ids of one word after all merges, lowest rank first, leftmost among equals.

        Queue entries hold a rank and, in their low bits, a place; one whose place no
        longer starts a pair of that rank is stale and skipped.
        """
        symbols = [self.inner[byte] for byte in word[:-1]] + [self.final[word[-1]]]
        last = len(symbols) - 1
        rank_of, made = self.ranks.get, self.made
        ranks = [rank_of(pair, -1) for pair in zip(symbols, symbols[1:])]
        bits = last.bit_length()
        low = (1 << bits) - 1
        queue = [rank << bits | at for at, rank in enumerate(ranks) if rank >= 0]
        if not queue:
            return symbols
        heapq.heapify(queue)
        pop, push = heapq.heappop, heapq.heappush
        before, after = list(range(-1, last)), [*range(1, last + 1), -1]
        ranks.append(-1)
        while queue:
            entry = pop(queue)
            at, rank = entry & low, entry >> bits
            if ranks[at] != rank:
                continue
            gone = after[at]
            symbols[at] = merged = made[rank]
            symbols[gone] = ranks[gone] = -1
            after[at] = right = after[gone]
            ranks[at] = -1
            if right >= 0:
                before[right] = at
                ranks[at] = rank = rank_of((merged, symbols[right]), -1)
                if rank >= 0:
                    push(queue, rank << bits | at)
            left = before[at]
            if left >= 0:
                ranks[left] = rank = rank_of((symbols[left], merged), -1)
                if rank >= 0:
                    push(queue, rank << bits | left)
        return [symbol for symbol in symbols if symbol >= 0]

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge ranks of pairs of symbols, ``NO_PAIR`` where there is none."""
        pairs = left * (self.absent + 1) + right
        at = np.searchsorted(self.pair_numbers, pairs)
        return np.where(self.pair_numbers[at] == pairs, self.pair_ranks[at], NO_PAIR)

    def merge_matrix(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of similar lengths, merged as in ``merge_word``, one pair of each word a round.

        Ranks, symbols and neighbours are matrices with a row for each word, an
        absent symbol before it and at least one behind it. A pair stands at its
        left symbol.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        width = int(sizes.max()) + 2
        rows = np.arange(len(words))
        inside = np.arange(width - 1) < sizes[:, None]
        letters = np.zeros(inside.shape, np.uint8)
        letters[inside] = np.frombuffer(b"".join(words), np.uint8)
        symbols = np.full((len(words), width), self.absent, np.int64)
        symbols[:, 1:][inside] = self.byte_symbols[0][letters[inside]]
        symbols[rows, sizes] = self.byte_symbols[1][letters[rows, sizes - 1]]
        ranks = np.full(symbols.shape, NO_PAIR, np.int32)
        paired = inside[:, 1:]
        ranks[:, 1:-1][paired] = self.ranks_of(symbols[:, 1:-1][paired], symbols[:, 2:][paired])
        symbol, rank = symbols.ravel(), ranks.ravel()
        after, before = np.arange(1, symbol.size + 1), np.arange(-1, symbol.size - 1)
        while True:
            at = rows * width + ranks[rows].argmin(axis=1)
            best = rank[at]
            more = best != NO_PAIR
            rows, at, best = rows[more], at[more], best[more]
            if not rows.size:
                break
            gone, left = after[at], before[at]
            right = after[gone]
            merged = self.made_of_rank[best]
            symbol[at], symbol[gone], rank[gone] = merged, self.absent, NO_PAIR
            after[at], before[right] = right, at
            rank[at] = self.ranks_of(merged, symbol[right])
            rank[left] = self.ranks_of(symbol[left], merged)
        kept = symbols != self.absent
        ids = symbols[kept].astype("<u4").tobytes()
        ends = (4 * np.cumsum(kept.sum(axis=1))).tolist()
        return [ids[start:end] for start, end in zip([0, *ends], ends)]

    def merge_words(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """Distinct words and their ids, as little-endian 32-bit integers."""
        letters = [word.encode() for word in words]
        sizes = np.fromiter(map(len, letters), np.int64, len(letters))
        order = np.argsort(sizes, kind="stable")
        short = int(np.count_nonzero(sizes <= LONGEST_ROW))
        for start in range(0, short, MATRIX_ROWS):
            part = order[start : min(start + MATRIX_ROWS, short)].tolist()
            yield from zip([words[at] for at in part], self.merge_matrix([letters[at] for at in part]))
        for at in order[short:].tolist():
            yield words[at], np.array(self.merge_word(letters[at]), "<u4").tobytes()

    def pieces_of(self, text: str) -> list[str]:
        """The words of a lower-cased run without white space.

        The regex module knows letters and numbers that the library's older
        tables leave unassigned; those split like signs.
        """
        if text.isascii() or self.assigned.issuperset(text):
            return self.pieces.findall(text)
        if "Cn" not in set(map(unicodedata.category, text)):
            self.assigned.update(text)
            return self.pieces.findall(text)
        text = text.translate(NEWER_SMALL)
        plain = "".join(NO_CHARACTER if unassigned(c) else c for c in text)
        return [text[slice(*match.span())] for match in self.pieces.finditer(plain)]

    def words_of(self, chunk: str) -> list[str]:
        """The words of a run without white space, as they are merged."""
        text = unicodedata.normalize("NFC", chunk)
        # a capital sigma is lowered without a look at its neighbours
        return self.pieces_of("".join(map(str.lower, text)) if "Σ" in text else text.lower())

    def chunks_of(self, text: str) -> list[str]:
        """The special tokens of a text, and the runs without white space between them."""
        out: list[str] = []
        for part in self.special_split.split(text) if "<|" in text else [text]:
            if part in self.special:
                out.append(part)
            elif any(sign in part for sign in PYTHON_ONLY_SPACE):
                out += self.chunks.findall(part)
            else:
                out += part.split()
        return out

    def learn(self, chunks: set[str]) -> None:
        """Put the ids of chunks into the cache, which lacks them."""
        cache, older, words = self.cache, self.older, self.words
        spelled = {}
        for chunk in chunks:
            ids = older.get(chunk)
            if ids is not None:
                cache[chunk] = ids
            elif chunk in self.special:
                cache[chunk] = np.array([self.special[chunk]], dtype="<u4").tobytes()
            else:
                spelled[chunk] = self.words_of(chunk)
        fresh = list(set(chain.from_iterable(spelled.values())).difference(words))
        words.update(self.merge_words(fresh))
        for chunk, pieces in spelled.items():
            cache[chunk] = words[pieces[0]] if len(pieces) == 1 else b"".join([words[piece] for piece in pieces])
        for piece in fresh:
            if len(piece) > LONGEST_CACHED:
                del words[piece]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, values: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian 32-bit integers."""
        if len(self.cache) > CACHED_WORDS:
            self.cache, self.older = {}, self.cache
        if len(self.words) > CACHED_WORDS:
            self.words.clear()
        chunks, cache = [self.chunks_of(text) for text in values], self.cache
        fresh = set().union(*chunks).difference(cache)
        self.learn(fresh)
        out = [b"".join(map(cache.__getitem__, row)) for row in chunks]
        for chunk in fresh:
            if len(chunk) > LONGEST_CACHED:
                del cache[chunk]
        return out

    def decode(self, ids: bytes) -> str:
        return self.decode_all([ids])[0].decode()

    def decode_all(self, encoded: list[bytes]) -> list[bytes]:
        """The texts of several id sequences: vocabulary strings, one blank between."""
        ends = np.concatenate([[0], np.cumsum([len(ids) // 4 for ids in encoded])])
        strings = self.spelled.take(pa.array(np.frombuffer(b"".join(encoded), dtype="<u4")))
        lists = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), strings)
        return pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.large_binary()).to_pylist()


def encode_documents(
    docs: DataFrame,
    vocabulary: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """Per row its id, token ids (unless ``with_ids`` is off), their number and both digests.

    ``vocabulary`` is a path that is the same on every worker. Whole texts are
    encoded, and decoded again from their ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(vocabulary)
        for batch in slices(batches, WORDS_BYTES):
            encoded = bpe.encode_all(texts(batch, 1))
            counts = np.array([len(ids) // 4 for ids in encoded], dtype=np.int64)
            columns = [batch.column(0)]
            if with_ids:
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                flat = pa.array(np.frombuffer(b"".join(encoded), dtype="<i4"))
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), flat))
            columns += [
                pa.array(counts),
                pa.array(map(sha256, encoded), pa.string()),
                pa.array(map(sha256, bpe.decode_all(encoded)), pa.string()),
            ]
            names = [name.split()[0] for name in (ENCODED if with_ids else DIGESTS).split(", ")]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    chosen = docs.selectExpr(f"CAST(`{doc_id}` AS LONG) AS doc_id", f"`{text}` AS text")
    return chosen.mapInArrow(run, ENCODED if with_ids else DIGESTS)
