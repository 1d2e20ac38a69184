from __future__ import annotations

import math
from collections import defaultdict

import pytest

from adrlens.llm import host_reputation as hr
from adrlens.llm.queries import QUERIES, REPUTATION

from .conftest import LABELS, URLS


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    path = rest[end:]
    stop = min([path.find(c) for c in "?#" if c in path] or [len(path)])
    return "".join(c.lower() if c.isascii() else c for c in rest[:end]), path[:stop]


def rule_of(host, path, rules):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def levels(host, config):
    site = host.rsplit(":", 1)[0] if ":" in host and not host.rsplit(":", 1)[1].strip("0123456789") else host
    names = site.split(".")
    n = 2 if ".".join(names[-2:]) in config.two_part_suffixes else 1
    return ".".join(names[-n - 1:]), ".".join(names[-n:])


def strength(groups, config):
    groups = [(n, b) for n, b in groups if n]
    k, total = len(groups), sum(n for n, _ in groups)
    if k < 2 or total <= k:
        return config.most_strength
    mean = sum(b for _, b in groups) / total
    between = sum(n * (b / n - mean) ** 2 for n, b in groups) / (k - 1)
    inside = sum(b * (1 - b / n) for n, b in groups) / (total - k)
    size = (total - sum(n * n for n, _ in groups) / total) / (k - 1)
    spread = between + (size - 1) * inside
    rho = (between - inside) / spread if spread > 0 else 0
    return config.most_strength if rho <= 0 else min(max(1 / rho - 1, config.least_strength), config.most_strength)


def brute(pages, outcomes, config):
    by_page = defaultdict(list)
    for page, bad in outcomes:
        if bad is not None and page is not None:
            by_page[page].append(bad)
    hosts, domains, suffixes = (defaultdict(lambda: [0, 0]) for _ in range(3))
    for page, url in pages:
        host = parts(url)[0]
        domain, suffix = levels(host, config)
        for group in (hosts[host], domains[domain, suffix], suffixes[suffix]):
            group[0] += len(by_page[page])
            group[1] += sum(by_page[page])
    ks = [strength(g.values(), config) for g in (hosts, domains, suffixes)]
    n, bad = (sum(g[i] for g in hosts.values()) for i in (0, 1))
    shrink = lambda own, prior, k: (own[1] + k * prior) / (own[0] + k)
    rows = []
    for page, url in pages:
        host, path = parts(url)
        domain, suffix = levels(host, config)
        mean = shrink(suffixes[suffix], (bad + 0.5) / (n + 1), ks[2])
        mean = shrink(hosts[host], shrink(domains[domain, suffix], mean, ks[1]), ks[0])
        bound = mean - config.z * math.sqrt(mean * (1 - mean) / (hosts[host][0] + ks[0] + 1))
        rule = rule_of(host, path, config.rules)
        verdict = rule.verdict if rule else "block" if bound > config.max_bad else "allow"
        rows.append((page, host, path, rule and rule.name, verdict, hosts[host][0], round(bound, 9)))
    return sorted(rows, key=repr)


def judged(spark, pages, outcomes, config):
    df = hr.judge_pages(spark.createDataFrame(pages, "page_id long, url string"),
                        spark.createDataFrame(outcomes, "page_id long, bad int"), config)
    return sorted(((*r[:6], round(r["bad_bound"], 9)) for r in df.collect()), key=repr)


def test_equals_brute_force(spark):
    pages = [(i, f"http://{'w.' * (i % 2)}h{i % 11}.d{i % 5}.{'co.uk' if i % 3 else 'net'}/{'en/' * (i % 4 == 0)}{i}") for i in range(400)]
    outcomes = [(i, int((i * 7919) % 100 < 9 * (i % 11))) for i in range(0, 400, 2)] + [(2, 1), (4, None), (999, 1)]
    config = hr.Reputation(rules=REPUTATION.rules + (hr.Rule("block", "d1.net", "/en/"),), max_bad=0.3)
    rows = judged(spark, pages, outcomes, config)
    assert rows == brute(pages, outcomes, config)
    assert {r[4] for r in rows if r[3] is None} == {"allow", "block"}


def test_hard_rows(spark, hard):
    bad = [(i, None if t is None else max(x for x in (t, 1 - q if q is not None else None) if x is not None)) for i, q, t in LABELS]
    rows = QUERIES["op3_host_reputation"](spark, hard).collect()
    want = brute(URLS, bad, REPUTATION)
    assert sorted(((*r[:6], ) for r in rows), key=repr) == [r[:6] for r in want]


@pytest.mark.parametrize("url, rule, verdict", [
    ("http://net/", "net/", "block"), ("http://x.net/a", "net/", "block"), ("http://xnet/a", None, None),
    ("http://example.net/en/1", "example.net/en/", "allow"), ("http://a.example.net/en", "net/", "block"),
    ("http://m.Example.COM/de/?x", "example.com/de/", "block"), ("http://a.org/fr/", "org/fr/", "allow"),
    ("http://x.net?/", None, None), ("http://x.net#/", None, None), ("x://y.net/z://a", "net/", "block"),
])
def test_rules(spark, url, rule, verdict):
    row = hr.judge_pages(spark.createDataFrame([(1, url)], "page_id long, url string"),
                         spark.createDataFrame([], "page_id long, bad int"), REPUTATION).first()
    assert row["rule"] == rule and row["verdict"] == (verdict or "allow")


def test_plan_is_native(spark, hard):
    plan = QUERIES["op3_host_reputation"](spark, hard)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct"))
