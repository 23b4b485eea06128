"""Operators that shuffle, against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from agroweather.llm import common, components, embedding_join, line_dedup, ngram_join, url_filter
from tests.llm.conftest import CASES, prose, rows_of

BLANK = " \t\n\x0b\x0c\r"


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


class Groups:
    def __init__(self, n):
        self.up = list(range(n))

    def find(self, i):
        while self.up[i] != i:
            i = self.up[i]
        return i

    def join(self, i, j):
        a, b = self.find(i), self.find(j)
        self.up[max(a, b)] = min(a, b)


# ---- line dedup


def brute_lines(cases):
    holders = {}
    for doc_id, text in cases:
        for line in (text or "").split("\n"):
            key = ascii_lower(line.strip(BLANK))
            if len(key) >= 20 and doc_id is not None:
                holders.setdefault(key, set()).add(doc_id)
    out = []
    for doc_id, text in cases:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            own = holders.get(ascii_lower(line.strip(BLANK)), set())
            gone = doc_id is not None and len(own) >= 3 and doc_id < max(own) and doc_id in own
            kept.append(None if gone else line)
        out.append((doc_id, len(lines), kept.count(None), "\n".join(x for x in kept if x is not None)))
    return out


def test_line_dedup(spark, docs, nothing):
    expected = brute_lines([case[:2] for case in CASES])
    got = line_dedup.dedup_lines(docs)
    texts = Counter((row.doc_id, row.text or "") for row in got.collect())
    assert texts == Counter((doc_id, text) for doc_id, _, _, text in expected)
    report = Counter((row.doc_id, row.n_lines, row.n_dropped) for row in line_dedup.line_report(docs).collect())
    assert report == Counter(row[:3] for row in expected)
    assert got.columns == docs.columns and got.where("h1 != 'kept'").count() == 0
    assert line_dedup.line_report(nothing).count() == 0


def test_line_dedup_random(spark):
    draw = random.Random(8)
    lines = [prose(i, 4) for i in range(6)] + ["short", ""]
    cases = [(draw.randrange(12), "\n".join(draw.choice(lines) for _ in range(draw.randrange(8)))) for _ in range(40)]
    docs = spark.createDataFrame(cases, "doc_id long, text string")
    got = Counter((row.doc_id, row.text) for row in line_dedup.dedup_lines(docs).collect())
    assert got == Counter((doc_id, text) for doc_id, _, _, text in brute_lines(cases))


@pytest.mark.parametrize("parts", [3, 16])
def test_line_dedup_joins_slices_of_hot_lines(spark, parts):
    """Two lines fill most rows, so that each covers several range partitions; one document is cut by their edges."""
    draw = random.Random(parts)
    hot = [prose(i, 4) for i in range(2)]
    cases = [
        (i // 2, "\n".join([*(draw.choice(hot) for _ in range(draw.randrange(1, 6))), prose(100 + i % 50, 4)]))
        for i in range(400)
    ]
    cases.append((77, "\n".join([hot[0]] * 500)))
    keys = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled"]
    before = [spark.conf.get(key) for key in keys]
    try:
        for key, value in zip(keys, [str(parts), "false"], strict=True):
            spark.conf.set(key, value)
        docs = spark.createDataFrame(cases, "doc_id long, text string")
        lines = docs.select(F.col("doc_id").alias("doc"), "text")
        runs = common.stored(line_dedup.line_runs(line_dedup.long_lines(lines)), "line-runs")
        reaching = line_dedup.joined_slices(runs).collect()
        got = Counter((row.doc_id, row.text) for row in line_dedup.dedup_lines(docs).collect())
    finally:
        for key, value in zip(keys, before, strict=True):
            spark.conf.set(key, value)
    assert 1 <= len(reaching) < parts
    holders = {}
    for doc_id, text in cases:
        for line in text.split("\n"):
            holders.setdefault(line, set()).add(doc_id)
    known = {(max(own), len(own)) for own in holders.values()}
    assert all((row.whole_first, row.whole_documents) in known for row in reaching)
    assert got == Counter((doc_id, text) for doc_id, _, _, text in brute_lines(cases))


def test_line_dedup_runs_no_python(docs):
    plan = line_dedup.line_report(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ---- components


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    draw = random.Random(seed)
    edges = [(draw.randrange(60), draw.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 120)]
    groups = Groups(200)
    for a, b in edges:
        groups.join(a, b)
    got = dict(rows_of(components.connected_components(spark.createDataFrame(edges, "a long, b long"))))
    assert got == {i: groups.find(i) for a, b in edges if a != b for i in (a, b)}


def test_no_edges(spark):
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- n-gram Jaccard join


def shingles(text):
    words = [w for w in "".join(" " if c in BLANK else c for c in ascii_lower(text or "")).split(" ") if w]
    size = min(5, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def brute_links(cases):
    sets, groups = [shingles(text) for _, text in cases], Groups(len(cases))
    for i, x in enumerate(sets):
        for j in range(i):
            if x and 100 * len(x & sets[j]) >= 75 * len(x | sets[j]):
                groups.join(i, j)
    low = {}
    for i, (doc_id, _) in enumerate(cases):
        if doc_id is not None:
            root = groups.find(i)
            low[root] = min(doc_id, low.get(root, doc_id))
    return [(doc_id, len(sets[i]), low.get(groups.find(i))) for i, (doc_id, _) in enumerate(cases)]


def near_copies(seed):
    draw, cases = random.Random(seed), []
    for base in range(8):
        words = prose(base + 50, draw.randrange(3, 90)).split()
        for _ in range(draw.randrange(1, 9)):
            own = list(words)
            for _ in range(draw.randrange(0, 4)):
                own[draw.randrange(len(own))] = f"edit{draw.randrange(1000)}"
            cases.append((len(cases) * 3 % 101, " ".join(own[draw.randrange(0, 3) :])))
    return cases


def test_links(docs, nothing):
    got = Counter(rows_of(ngram_join.link_documents(docs)))
    assert got == Counter(brute_links([case[:2] for case in CASES]))
    assert ngram_join.link_documents(nothing).count() == 0


@pytest.mark.parametrize("cut", [False, True])
def test_links_of_near_copies(spark, monkeypatch, cut):
    if cut:  # every list and block in parts, every shingle salted
        monkeypatch.setattr(ngram_join, "LIST_PART", 2)
        monkeypatch.setattr(ngram_join, "BLOCK_PART", 1500)
        monkeypatch.setattr(ngram_join, "SALT_FROM", 1)
    cases = near_copies(int(cut))
    docs = spark.createDataFrame(cases, "doc_id long, text string").repartition(4)
    assert Counter(rows_of(ngram_join.link_documents(docs))) == Counter(brute_links(cases))


def test_representatives(docs):
    kept = ngram_join.keep_representatives(docs)
    ids = Counter(row.doc_id for row in kept.collect())
    component = {}
    for doc_id, n, low in brute_links([case[:2] for case in CASES]):
        component[doc_id] = low if n and doc_id is not None else doc_id
    assert ids == Counter(i for i, *_ in CASES if component[i] == i)
    assert kept.columns == docs.columns


def test_prefix_tree_pairs():
    draw = random.Random(5)
    for _ in range(30):
        base = [draw.randrange(1 << 40) for _ in range(20)]
        sets = []
        for _ in range(12):
            own = set(draw.sample(base, draw.randrange(8, 20))) | {draw.randrange(1 << 40) for _ in range(draw.randrange(3))}
            sets.append(np.array(sorted(own), np.uint64))
        want, got = Groups(12), Groups(12)
        for i in range(12):
            for j in range(i):
                x, y = set(sets[i].tolist()), set(sets[j].tolist())
                if 7 * len(x ^ y) <= len(x) + len(y):
                    want.join(i, j)
        for i, j in ngram_join.PrefixTree(sets).links():
            got.join(i, j)
        assert [want.find(i) for i in range(12)] == [got.find(i) for i in range(12)]


# ---- embeddings


def brute_vectors(rows):
    n = len(rows)
    counts, groups = [0] * n, Groups(n)

    def unit(v):
        if v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, float)
        return v / np.sqrt(v @ v)

    units = [unit(v) for _, v, _ in rows]
    for i in range(n):
        for j in range(i):
            x, y = units[i], units[j]
            if x is None or y is None or rows[i][2] is None or rows[i][2] != rows[j][2] or len(x) != len(y):
                continue
            if x @ y >= 0.93:
                counts[i] += 1
                counts[j] += 1
                groups.join(i, j)
    low = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            root = groups.find(i)
            low[root] = min(row[0], low.get(root, row[0]))
    out = []
    for i, row in enumerate(rows):
        component = low.get(groups.find(i))
        out.append((row[0], counts[i], component, row[0] is None or row[0] == component if component is not None else True))
    return out


def vector_rows():
    draw, rows = np.random.default_rng(3), []
    centers = draw.normal(size=(5, 12))
    for i in range(160):
        v = centers[i % 5] + draw.normal(size=12) * (0.1 if i % 3 else 0.5)
        rows.append((i, [float(np.float32(x)) for x in v], i % 2))
    nan, inf = float("nan"), float("inf")
    rows += [(200, None, 1), (201, [0.0] * 12, 1), (202, [nan] * 12, 1), (203, [inf] + [1.0] * 11, 1)]
    rows += [(204, [None] + [1.0] * 11, 1), (205, rows[0][1], None), (206, [1.0, 2.0], 0), (207, [1.0, 2.1], 0)]
    return [*rows, (3, rows[3][1], 1), (208, [], 0)]


@pytest.mark.parametrize("interval_bytes", [1 << 19, 1])
def test_embedding_links(spark, monkeypatch, interval_bytes):
    monkeypatch.setattr(embedding_join, "INTERVAL_BYTES", interval_bytes)
    monkeypatch.setattr(embedding_join, "LEAF", 8)
    rows = vector_rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    assert Counter(rows_of(embedding_join.link_embeddings(df))) == Counter(brute_vectors(rows))


def test_no_embeddings(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_join.link_embeddings(df).count() == 0


# ---- URL filter


def test_rules_and_parts(spark):
    urls = {
        1: ("HTTP://WWW.Example.COM/de/x?q=/#f", "www.example.com", "/de/x", "example.com/de/", "block"),
        2: ("https://a.example.net/en/1.html", "a.example.net", "/en/1.html", "example.net/en/", "allow"),
        3: ("https://example.net/fr/1", "example.net", "/fr/1", "net/", "block"),
        4: ("https://notexample.com/de/", "notexample.com", "/de/", None, "allow"),
        5: ("https://x.org/fr/", "x.org", "/fr/", "org/fr/", "allow"),
        6: ("https://net?x", "net", "", None, "allow"),
        7: (None, "", "", None, "allow"),
        8: ("no scheme", "", "", None, "allow"),
        9: ("", "", "", None, "allow"),
        10: ("ftp://", "", "", None, "allow"),
        None: ("https://x.org#y", "x.org", "", None, "allow"),
    }
    rows = [(i, u[0], "<p>", "clash") for i, u in urls.items()]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = {row.page_id: row for row in url_filter.filter_urls(pages).collect()}
    assert {i: tuple(got[i])[1:5] for i in urls} == {i: u[1:] for i, u in urls.items()}
    assert url_filter.filter_urls(pages.where("false")).count() == 0


def test_impure_templates_are_rejected(spark):
    rules = (("bad.com", "/ads/1", "block"), ("bad.com", "/ads/2", "block"), ("bad.com", "/news/1", "allow"))
    paths = [f"/ads/{i}" for i in range(100, 300)] + ["/ads/7", "/news/9"] + [f"/news/{i}" for i in range(10, 20)] + ["/other/3"]
    pages = spark.createDataFrame([(i, f"http://bad.com{p}") for i, p in enumerate(paths)], "page_id long, url string")
    got = {row.path: row for row in url_filter.filter_urls(pages, rules).collect()}
    assert got["/ads/7"].verdict == "block" and got["/ads/7"].rule is None
    assert got["/news/9"].verdict == got["/other/3"].verdict == "allow"
    assert got["/ads/7"].template == "/ads/*"
