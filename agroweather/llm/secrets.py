"""Secret scan (operator 10).

Method: candidate strings are runs of key characters; a window slides over each
and its Shannon entropy is kept up to date from incremental counts, one
threshold per character class; windows above it join to spans, and an allow
list removes what is random by design. Spans of the plain patterns (assignment,
access key, hexadecimal run) are found besides and always stay; what they leave
of a candidate is scanned if a window fits into it. The allow list is tried on
the whole piece and on the words that a found span touches. Rows are
independent: one map, no shuffle.

Defined results: a NULL text is the empty text, which has no spans (counts 0,
``spans`` empty, digest of the empty string); a NULL id stays NULL; repeated
rows give repeated rows; an empty table gives an empty table; further columns
are not read. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from agroweather.llm.common import sha256, slices, texts

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LEAST = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")

WINDOW = 20
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % WINDOW)
# Class, its full match, least entropy in bits a character over one window.
CLASSES = (
    ("hex", re.compile(r"[0-9a-fA-F]+"), 3.0),
    ("alnum", re.compile(r"[A-Za-z0-9]+"), 3.7),
    ("base64", re.compile(r"[A-Za-z0-9+/_=-]+"), 3.8),
)
# A word in lower case or capitalised, then capitalised ones of three letters or more, or short ones in use.
_SHORT = "An|As|At|By|Db|Do|Go|Id|If|In|Io|Ip|Is|It|My|No|Of|On|Or|To|Ui|Up|We"
_WORDS = f"(?:[A-Z][a-z]*|[a-z]+)(?:[A-Z][a-z]{{2,}}|{_SHORT})*"
# Random by design or plain by form: UUIDs, paths and names of words and numbers, numbers.
# A word stands between separators, so each text fits a form in one way only: no backtracking.
ALLOWED = (
    re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),
    re.compile(rf"[/_=-]*(?:{_WORDS}|[0-9]+)(?:[/_=-]+(?:{_WORDS}|[0-9]+))*[/_=-]*"),
    re.compile(r"[0-9/_=+-]+"),
)
SEPARATORS = "/_=+-"

Span = tuple[str, int, int]
SCANNED = (
    "doc_id long, n_assign long, n_access long, n_hex long, n_entropy long, "
    "base_sha256 string, spans string"
)

_TERMS = [0.0] + [n * math.log2(n) for n in range(1, WINDOW + 1)]


def base_spans(text: str) -> list[Span]:
    """Spans of the plain patterns, leftmost and non-overlapping per kind."""
    found = []
    lowered = text.lower()
    if any(word in lowered for word in ASSIGN_WORDS):
        found += [
            ("assign", *match.span())
            for match in ASSIGN.finditer(text)
            if len(match[2]) >= ASSIGN_LEAST
        ]
    if "AKIA" in text:
        found += [("access", *match.span()) for match in ACCESS.finditer(text)]
    found += [("hex", *match.span()) for match in HEX.finditer(text)]
    return found


def entropy_spans(candidate: str, least: float) -> list[tuple[int, int]]:
    """Joined windows whose entropy is at least ``least``; counts change by two letters a step.

    With counts c over a window of W characters the entropy is
    log2 W - sum(c log2 c) / W, so only the sum is carried along.
    """
    most = WINDOW * (math.log2(WINDOW) - least)
    counts: dict[str, int] = {}
    total, spans = 0.0, []
    for end, letter in enumerate(candidate):
        c = counts.get(letter, 0)
        counts[letter] = c + 1
        total += _TERMS[c + 1] - _TERMS[c] if c < WINDOW else 0.0
        if end >= WINDOW:
            gone = candidate[end - WINDOW]
            c = counts[gone]
            counts[gone] = c - 1
            total += _TERMS[c - 1] - (_TERMS[c] if c <= WINDOW else _TERMS[WINDOW])
        if end >= WINDOW - 1 and total <= most + 1e-9:
            start = end - WINDOW + 1
            if spans and start <= spans[-1][1]:
                spans[-1] = spans[-1][0], end + 1
            else:
                spans.append((start, end + 1))
    return spans


def is_allowed(candidate: str) -> bool:
    return any(form.fullmatch(candidate) for form in ALLOWED)


def words_around(piece: str, start: int, end: int) -> str:
    """The span with the rest of the words it cuts, up to the next separators."""
    while start and piece[start - 1] not in SEPARATORS:
        start -= 1
    while end < len(piece) and piece[end] not in SEPARATORS:
        end += 1
    return piece[start:end]


def free_pieces(start: int, end: int, covered: list[tuple[int, int]], starts: list[int]) -> Iterator[tuple[int, int]]:
    """What ``covered``, disjoint spans in order with their ``starts``, leaves of a stretch."""
    at = max(bisect_right(starts, start) - 1, 0)
    while at < len(covered) and covered[at][0] < end:
        if covered[at][0] > start:
            yield start, covered[at][0]
        start = max(start, covered[at][1])
        at += 1
    if start < end:
        yield start, end


def added_spans(text: str, base: list[Span]) -> list[Span]:
    """High-entropy spans outside the base spans and the allow list."""
    found: list[Span] = []
    covered: list[tuple[int, int]] = []  # base spans joined, in order
    for _, start, end in sorted(base, key=lambda span: span[1:]):
        if covered and start <= covered[-1][1]:
            covered[-1] = covered[-1][0], max(end, covered[-1][1])
        else:
            covered.append((start, end))
    starts = [start for start, _ in covered]
    for match in CANDIDATE.finditer(text):
        for at, to in free_pieces(*match.span(), covered, starts):
            piece = text[at:to]
            if len(piece) < WINDOW or is_allowed(piece):
                continue
            least = next(least for _, form, least in CLASSES if form.fullmatch(piece))
            found += [
                ("entropy", at + start, at + end)
                for start, end in entropy_spans(piece, least)
                if not is_allowed(words_around(piece, start, end))
            ]
    return found


def joined(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda span: (span[1], KINDS.index(span[0]), span[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in ordered)


def scan_secrets(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row the number of spans of each kind, a digest of the base spans, and all spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows: list[list] = [[] for _ in range(6)]
            for value in texts(batch, 1):
                base = base_spans(value)
                added = added_spans(value, base)
                kinds = [kind for kind, _, _ in base]
                cells = [kinds.count(kind) for kind in KINDS[:3]] + [len(added)]
                cells += [sha256(joined(base).encode()), joined(base + added)]
                for column, cell in zip(rows, cells, strict=True):
                    column.append(cell)
            arrays = [batch.column(0), *(pa.array(column, pa.int64()) for column in rows[:4])]
            arrays += [pa.array(column, pa.string()) for column in rows[4:]]
            yield pa.RecordBatch.from_arrays(arrays, names=SCANNED.replace(",", "").split()[::2])

    chosen = docs.selectExpr(f"CAST(`{doc_id}` AS LONG) AS doc_id", f"`{text}` AS text")
    return chosen.mapInArrow(run, SCANNED)
