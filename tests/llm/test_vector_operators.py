"""Top-k search and hard negatives, against brute force in whole numbers."""

import math

import numpy as np
import pytest

from agroweather.llm import hard_negatives, inner_products, residues, vector_blocks
from tests.llm.conftest import rows_of

SCHEMA = "vec_id long, label int, embedding array<double>, score string, norm string, part string, q_row string"
EXTRA = ("kept", "as", "is", "too")


def last(vec_id):
    return (vec_id is None, vec_id or 0)


def valid(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


MOST = 2**63 - 1


def product(a, b, scale):
    score = sum(math.floor(scale * x) * math.floor(scale * y) for x, y in zip(a, b, strict=True))
    return max(-MOST, min(MOST, score))


def brute_top(rows, every=100, k=10):
    out = []
    for query, _, v in rows:
        if query is None or query % every or not valid(v):
            continue
        found = [
            (-product(v, w, 1024), last(i), i)
            for i, _, w in rows
            if valid(w) and len(w) == len(v) and i != query
        ]
        out += [(query, rank, i, -score) for rank, (score, _, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def brute_negatives(rows, every=50):
    rows = [
        (i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, v)
        for i, label, v in rows
        if label is not None and valid(v)
    ]
    out = []
    for anchor, label, v in rows:
        if anchor is None or anchor % every:
            continue
        scored = [(product(v, w, 256), i, other) for i, other, w in rows if len(w) == len(v)]
        positives = sorted((-s, last(i), i) for s, i, other in scored if other == label and i != anchor)[:5]
        for score, _, positive in positives:
            inside = [
                (-s, last(i), i) for s, i, other in scored if other != label and 50 * -score <= 100 * s <= 95 * -score
            ]
            out += [
                (anchor, positive, rank, i, -score, -s) for rank, (s, _, i) in enumerate(sorted(inside)[:3], 1)
            ]
    return sorted(out, key=repr)


def clusters(n, dims=12, seed=5):
    """Vectors about a few centres, of lengths that differ widely."""
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(6, dims)) * [[0.1], [0.3], [1], [1], [2], [8]]
    which = draw.integers(0, 6, n)
    return centres[which] + 0.3 * draw.normal(size=(n, dims)), which


@pytest.fixture(scope="module")
def cases():
    vectors, which = clusters(420)
    rows = [(i, int(which[i]), vectors[i].tolist()) for i in range(420)]
    rows += [(i, 3, [1.0] * 12) for i in range(420, 560)]  # ties, an anchor and a query among them
    rows += [
        (600, 1, None),
        (700, 1, [None] + [1.0] * 11),
        (701, 1, [math.nan] * 12),
        (800, 1, [math.inf] + [0.0] * 11),
        (900, None, [2.0] * 12),
        (None, 2, [1.5] * 12),
        (1000, 2, [0.0] * 12),
        (1100, 2, [0.5] * 5),
        (1101, 2, [0.25] * 5),
        (1102, 4, [0.2] * 5),
        (1200, 3, []),
        (1201, 3, []),
        (1300, 2, [3.0e5] * 12),
        (1301, 2, [-3.0e9] * 12),
        (1302, 5, [2.0e5] * 12),
        (1350, 2, [1.0e7] * 12),
        (-100, 7, (-vectors[0]).tolist()),
        (350, 2, vectors[7].tolist()),  # a repeated id with another vector
        (17, int(which[17]), vectors[17].tolist()),  # a repeated row
    ]
    return rows


@pytest.fixture(scope="module")
def vectors(spark, cases):
    return spark.createDataFrame([(*row, *EXTRA) for row in cases], SCHEMA).repartition(5)


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(vector_blocks, "BLOCK_ROWS", 16)
    monkeypatch.setattr(vector_blocks, "QUERY_GROUP", 1)
    monkeypatch.setattr(vector_blocks, "CANDIDATE_GROUP", 2)


def test_top_products(vectors, cases, small_blocks):
    got = sorted(rows_of(inner_products.top_products(vectors)), key=repr)
    assert got == brute_top(cases)


def test_top_products_in_one_block(vectors, cases):
    got = sorted(rows_of(inner_products.top_products(vectors)), key=repr)
    assert got == brute_top(cases)


def test_hard_negatives(vectors, cases, small_blocks):
    mined = hard_negatives.mine_negatives(hard_negatives.relabelled(vectors))
    assert mined.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    expected = brute_negatives(cases)
    assert len(expected) > 60
    assert sorted(rows_of(mined), key=repr) == expected


def test_empty_tables_and_single_rows(spark, vectors):
    nothing = vectors.where("false")
    assert rows_of(inner_products.top_products(nothing)) == []
    assert rows_of(hard_negatives.mine_negatives(nothing)) == []
    alone = spark.createDataFrame([(100, 1, [1.0, 2.0])], "vec_id long, label int, embedding array<double>")
    assert rows_of(inner_products.top_products(alone)) == []
    assert rows_of(hard_negatives.mine_negatives(alone)) == []


def test_short_blocks_are_not_read(vectors, cases, small_blocks):
    """Blocks too short for every query's threshold drop out; the result is the same."""
    rows = [(i, 1, [10.0 + i % 7, 1.0]) for i in range(200)] + [(i, 1, [0.01, 0.01]) for i in range(201, 900)]
    spark = vectors.sparkSession
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").where("vec_id NOT IN (300)")
    expected = brute_top([row for row in rows if row[0] != 300 and (row[0] <= 200 or row[0] % 100)])
    got = [row for row in rows_of(inner_products.top_products(df)) if row[0] <= 200]
    assert sorted(got, key=repr) == expected


def test_candidates_are_pruned_by_partial_sums():
    draw = np.random.default_rng(1)
    y = draw.normal(size=(500, 32)) * np.geomspace(100, 0.1, 32)
    x = y[:1] * 3
    scores = (x @ y.T)[0]
    floor = np.array([int(np.sort(scores)[-10])])
    left = inner_products.Rotated(y).may_reach(x, floor)
    assert set(np.flatnonzero(scores >= floor[0])) <= set(left.tolist())
    assert len(left) < 60


@pytest.mark.parametrize("size,dims", [(3, 5), (2**15, 70), (2**31, 3), (2**62, 4), (2**130, 130)])
def test_residue_products_are_exact(size, dims):
    draw = np.random.default_rng(size % 1000)
    a = np.floor(draw.uniform(-1, 1, (7, dims)) * size)
    b = np.floor(draw.uniform(-1, 1, (9, dims)) * size)
    a[0], b[0] = size, -size
    whole = [[sum(int(x) * int(y) for x, y in zip(r, s, strict=True)) for s in b] for r in a]
    most = 2**63 - 1
    held = [[max(-most, min(most, x)) for x in row] for row in whole]
    bits = residues.score_bits(np.linalg.norm(a, axis=1).max(), np.linalg.norm(b, axis=1).max())
    assert residues.exact_scores(a, b, bits).tolist() == held


def test_float32_products_stay_exact():
    half = residues.PRIMES[0] // 2
    assert residues.CHUNK * half * half < residues.EXACT
    assert all(math.gcd(p, q) == 1 for p in residues.PRIMES[:20] for q in residues.PRIMES[:20] if p != q)
