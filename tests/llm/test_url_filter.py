"""URL filter: the template tree against a plain one in Python, with the production rules."""

import math
import random
import re
from collections import defaultdict

import pytest

from agroweather.llm import url_filter
from agroweather.llm.url_filter import LEAST_LABELS, PRIOR, PRIOR_WEIGHT, REJECT_FROM, RULES, SIMILAR_Z, STEP


def parts_of(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
    return host.lower(), path


def rule_of(host, path, rules):
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    return max(fits, key=lambda r: len(r[0] + r[1]), default=None)


def general(segment):
    stem = re.sub(r"\.[A-Za-z]{1,5}$", "", segment)
    ending = segment[len(stem):]
    if re.fullmatch("[0-9]+", stem):
        return "{number}" + ending
    if re.fullmatch("[0-9a-fA-F-]{8,}", stem):
        return "{hex}" + ending
    if re.search("[0-9]", stem) and len(stem) >= 12:
        return "{mixed}" + ending
    return segment.lower()


def smoothed(n, b):
    return (b + PRIOR * PRIOR_WEIGHT) / (n + PRIOR_WEIGHT)


def evidence(templates):
    """Smoothed purity of (n, b) together, -1 if they differ, None without labelled pages."""
    templates = [(n, b) for n, b in templates if n]
    if not templates:
        return None
    n, b = (sum(column) for column in zip(*templates))
    rate, free = b / n, len(templates) - 1
    if 0 < rate < 1:
        chi = sum((y - x * rate) ** 2 / (x * rate * (1 - rate)) for x, y in templates)
        if chi > free + SIMILAR_Z * math.sqrt(2 * free) + 1e-9:
            return -1
    return smoothed(n, b)


def brute_force(urls, rules):
    """Per url: verdict, merged template, purity, steps."""
    leaves, nodes = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    pages = []
    for url in urls:
        host, path = parts_of(url)
        rule = rule_of(host, path, rules)
        template = tuple(general(s) for s in path.split("/") if s)
        label = [rule is not None, rule is not None and rule[2] == "block"]
        pages.append((host, template, rule))
        for table, keys in ((leaves, [template]), (nodes, [template[:i] for i in range(len(template) + 1)])):
            for key in keys:
                table[host, key] = [x + y for x, y in zip(table[host, key], label)]

    def name(host, template, i):
        n, b = nodes[host, template[:i + 1]]
        siblings = [nodes[h, t] for h, t in list(nodes) if h == host and len(t) == i + 1 and t[:i] == template[:i]]
        n_all, b_all = (sum(column) for column in zip(*siblings))
        if not n:
            return "?"
        rate = b_all / n_all
        spread = math.sqrt(rate * (1 - rate) * max(1 / n - 1 / n_all, 0))
        return "*" if abs(b / n - rate) <= SIMILAR_Z * spread + 1e-9 else template[i]

    merged = {(h, t): tuple(name(h, t, i) for i in range(len(t))) for h, t in leaves}
    groups, shapes = defaultdict(lambda: [0, 0]), defaultdict(lambda: defaultdict(lambda: [0, 0]))
    shape = {(h, t): tuple(s if s.startswith("{") else "*" for s in t) for h, t in leaves}
    for key, count in leaves.items():
        host = key[0]
        for table, at in ((groups, (host, merged[key])), (shapes[host, shape[key]], merged[key])):
            table[at] = [x + y for x, y in zip(table[at], count)]

    def judge(host, template):
        own = groups[host, merged[host, template]]
        if own[0]:
            return smoothed(*own), 0
        found = evidence(shapes[host, shape[host, template]].values())
        if found is not None:
            return (PRIOR, None) if found < 0 else (PRIOR + STEP * (found - PRIOR), 1)
        labels = host.split(".")
        for up in range(max(1, len(labels) - LEAST_LABELS + 1)):
            at = ".".join(labels[up:])
            found = evidence(c for (h, _), c in groups.items() if h == at or h.endswith("." + at))
            if found is not None:
                return (PRIOR, None) if found < 0 else (PRIOR + STEP ** (up + 2) * (found - PRIOR), up + 2)
        return PRIOR, None

    out = []
    for host, template, rule in pages:
        purity, steps = judge(host, template)
        verdict = rule[2] if rule else "block" if purity >= REJECT_FROM else "allow"
        out.append((verdict, "/" + "/".join(merged[host, template]), round(purity, 9), steps))
    return out


def frame(spark, urls):
    return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")


def check(spark, urls, rules=RULES):
    got = sorted(url_filter.filter_urls(frame(spark, urls), rules).collect(), key=lambda row: row.page_id)
    want = brute_force(urls, rules)
    assert [(r.verdict, r.template, round(r.purity, 9), r.steps) for r in got] == want
    return {url: row for url, row in zip(urls, got)}


def test_undecided_pages_follow_similar_labelled_branches(spark):
    bad = [f"http://bets.example.com/de/{i}" for i in range(30)]
    good = [f"http://news.example.org/fr/{i}.html" for i in range(30)]
    other = {
        "http://bets.example.com/en/7": ("block", 1),  # the shape of what the rule blocks there
        "http://bets.example.com/about": ("block", 2),  # another shape: the host
        "http://www.example.com/en/7": ("block", 3),  # a sister host: example.com
        "http://m.www.example.com/en/7": ("allow", 4),  # too far for a rejection
        "http://news.example.org/en/7.html": ("allow", 1),
        "http://plain.other.com/x": ("allow", None),
        "http://other.com/": ("allow", None),
        "no scheme": ("allow", None),
    }
    urls = bad + good + list(other) + bad[:2] + [None]
    got = check(spark, urls)
    assert {url: (got[url].verdict, got[url].steps) for url in other} == other


def test_differing_branches_say_nothing(spark):
    rules = (("h.com", "/ads/", "block"), ("h.com", "/news/", "allow"))
    urls = [f"http://h.com/{kind}/{i}" for kind in ("ads", "news") for i in range(20)]
    got = check(spark, [*urls, "http://h.com/other/3"], rules)
    assert (got["http://h.com/other/3"].verdict, got["http://h.com/other/3"].steps) == ("allow", None)


def test_deep_paths_are_told_apart(spark):
    deep = "/a/b/c/d/e/f/g"
    rules = (("h.com", f"{deep}/bad/1", "block"), ("h.com", f"{deep}/good/1", "allow"))
    urls = [f"http://h.com{deep}/{kind}/{i}" for kind in ("bad", "good") for i in range(100, 140)]
    urls += [f"http://h.com{deep}/bad/7", f"http://h.com{deep}/good/7", "http://h.com" + "/x" * 3000]
    got = check(spark, urls, rules)
    assert got[urls[-3]].verdict == "block" and got[urls[-2]].verdict == "allow"


@pytest.mark.parametrize("seed", range(3))
def test_random_trees(spark, seed):
    draw = random.Random(seed)
    hosts = ["example.com", "a.example.com", "b.a.example.com", "x.org", "net", "y.example.net", "q.w.e.org"]
    segments = ["de", "en", "fr", "de", "a", "B", "12", "7.html", "deadbeef00", "item-2024-abcd", ""]
    rules = (*RULES, ("a.example.com", "/en/a", "block"), ("a.example.com", "/en/", "allow"))
    urls = [
        f"http://{draw.choice(hosts)}/" + "/".join(draw.choices(segments, k=draw.randint(0, 4)))
        for _ in range(400)
    ]
    check(spark, urls, rules)


def test_equally_long_rules(spark):
    rules = (("h.com", "/a/", "block"), ("h.com", "/a/", "allow"))
    got = url_filter.filter_urls(frame(spark, ["http://h.com/a/1"] * 2), rules).collect()
    assert [row.verdict for row in got] == ["allow", "allow"]
