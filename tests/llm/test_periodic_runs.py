"""Periodic runs, against a scan of every lag."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from agroweather.llm import periodic_runs
from tests.llm.conftest import CASES


def brute_runs(words, least=24, exponent=3):
    """Every maximal stretch of every lag whose smallest period is the lag."""
    n, out = len(words), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            stretch = words[start : i + q]
            smallest = next(p for p in range(1, q + 1) if all(x == y for x, y in zip(stretch, stretch[p:])))
            if smallest == q and len(stretch) >= max(least, exponent * q):
                out.append((start, len(stretch), q))
    return sorted(out, key=lambda run: (run[0], run[2]))


def brute_report(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    return (
        doc_id,
        len(runs),
        *best,
        1000 * best[1] // best[2] if runs else None,
        hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest(),
    )


def runs_of(words, least=24, exponent=3):
    numbers = np.array([sorted(set(words)).index(w) for w in words], np.int64)
    return periodic_runs.find_runs(numbers, np.array([0, len(words)]), least, exponent)[0]


@pytest.mark.parametrize("seed", range(60))
def test_random_words(seed):
    draw = random.Random(seed)
    words = []
    while len(words) < 300:
        period = draw.randint(1, 60)
        loop = [draw.choice("ab" if seed % 2 else "abcdefghij") for _ in range(period)]
        words += (loop * 6)[: draw.randint(1, 5 * period + 30)]
    assert runs_of(words) == brute_runs(words)
    assert runs_of(words, 5, 4) == brute_runs(words, 5, 4)


@pytest.mark.parametrize("period", [1, 7, 8, 9, 15, 16, 17, 31, 32, 33, 64, 65, 100, 129])
def test_shortest_and_too_short(period):
    loop = [f"w{i}" for i in range(period)]
    least = max(24, 3 * period)
    stretch = (loop * 30)[:least]
    assert runs_of(["x", *stretch, "y"]) == [(1, least, period)]
    assert runs_of(["x", *stretch[:-1], "y"]) == []


def test_grams_that_repeat_inside_a_period():
    phrase = [f"p{i}" for i in range(20)]
    loop = [*phrase, "a", *phrase, "b", "c", *phrase]
    words = loop * 4
    assert runs_of(words) == brute_runs(words) != []


def test_runs_inside_runs():
    inner = ["a", "b"] * 15
    words = [*inner, "c"] * 5
    assert runs_of(words) == brute_runs(words)
    assert len(runs_of(words)) == 6


def test_texts_do_not_touch():
    words = np.array([1] * 20 + [1] * 20 + [1] * 24)
    assert periodic_runs.find_runs(words, np.array([0, 20, 40, 40, 64]), 24, 3) == [[], [], [], [(0, 24, 1)]]
    assert periodic_runs.find_runs(words[:0], np.array([0, 0]), 24, 3) == [[]]


def test_first_gram():
    assert periodic_runs.first_gram(24, 3) == 16
    assert periodic_runs.first_gram(1, 3) == 2


TEXTS = [
    (1000, "la " * 500),
    (1001, "\tla\x0bla\x0cla\r\n" + "la  " * 30 + "\x1cla \x85la é é é"),
    (1002, "a b c " * 9 + "x " * 23 + "日本 語 " * 14),
    (1003, " \n\t"),
    (1004, " ".join(f"w{i % 700}" for i in range(5000))),
    *((i, " ".join(f"w{j}" for j in range(40 + i % 50))) for i in range(2000, 2080)),
]


def test_report(spark, docs):
    more = spark.createDataFrame([*TEXTS, (1000, "la " * 500)], "doc_id long, text string")
    cases = [*((i, t) for i, t, *_ in CASES), *TEXTS, (1000, "la " * 500)]
    every = docs.unionByName(more, allowMissingColumns=True).withColumn("runs", docs["pos"]).withColumn("best", docs["h1"])
    got = [tuple(row) for row in periodic_runs.run_report(periodic_runs.plant_runs(every)).collect()]
    # the long text of random words has a brute-force cost of its own: it holds no loop
    short = {i for i, t in cases if len(t or "") < 100_000}
    expected = [brute_report(i, t) for i, t in cases if i in short]
    assert sum(row[1] > 0 for row in expected) > 10
    assert sorted((r for r in got if r[0] in short), key=repr) == sorted(expected, key=repr)
    assert len(got) == len(cases)


def test_operator_gives_texts_and_runs(spark):
    docs = spark.createDataFrame([(1, "so it goes " * 10 + "on"), (2, None)], "doc_id long, text string")
    got = {row.doc_id: row for row in periodic_runs.periodic_runs(docs).collect()}
    assert got[1].collapsed == "so it goes on"
    assert [tuple(run) for run in got[1].runs] == [(0, 30, 3)]
    assert (got[2].runs, got[2].collapsed) == ([], "")


def test_empty_table(docs):
    report = periodic_runs.run_report(periodic_runs.plant_runs(docs.where("false")))
    assert report.collect() == []
    assert [f"{n}:{k}" for n, k in report.dtypes][:6] == [
        "doc_id:bigint", "n_runs:bigint", "start:bigint", "length:bigint", "period:bigint", "exponent_milli:bigint",
    ]


def test_bad_parameters(docs):
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(docs, exponent=2)
