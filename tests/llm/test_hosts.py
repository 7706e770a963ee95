"""URL rules and host trust against brute force."""

import re
from collections import defaultdict

import numpy as np
import pytest

from tests.llm.helpers import clash
from tresoria.llm import hosts

SF = "/root/testdata/sf0.001"


def parts(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")


def rule(host, path):
    fit = [(len(h + p), h + p, v) for v, h, p in hosts.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def brute(rows):
    """{row number: (host, path, rule, verdict)} by dense propagation."""
    judged = [(*parts(u), *rule(*parts(u))) for _, u, _ in rows]
    edges = defaultdict(float)
    names = {h for h, *_ in judged if h}
    for (h, *_), (_, _, page) in zip(judged, rows):
        for to in re.findall(r"""(?i)\b(?:href|src)\s*=\s*["']?\s*[a-z][a-z0-9+.-]*://([^/?#"'\s<>]+)""", page or ""):
            to = to.lower()
            if h:
                names.add(to)
                if h != to:
                    edges[h, to] += 1
    for h in names:
        labels = h.split(".")
        for i in range(1, len(labels) - 1):
            d = ".".join(labels[i:])
            edges[h, d] += 1
            edges[d, h] += 1
    n, ok, bad = defaultdict(int), defaultdict(int), defaultdict(int)
    for h, _, _, v in judged:
        if h:
            n[h] += 1
            ok[h] += v == "allow"
            bad[h] += v == "block"
    rank = []
    for seed, way in ((ok, dict(edges)), (bad, {(b, a): w for (a, b), w in edges.items()})):
        s = {h: seed[h] / n[h] for h in n if seed[h]}
        total = sum(s.values())
        s = {h: w / total for h, w in s.items()}
        out = defaultdict(float)
        for (a, _), w in way.items():
            out[a] += w
        r = dict(s)
        for _ in range(hosts.STEPS):
            new = defaultdict(float)
            for (a, b), w in way.items():
                new[b] += r.get(a, 0) * w / out[a] * hosts.DAMPING
            for h, w in s.items():
                new[h] += w * (1 - hosts.DAMPING)
            r = new
        rank.append(r)
    result = []
    for (doc, _, _), (h, p, name, v) in zip(rows, judged):
        t, d = rank[0].get(h, 0), rank[1].get(h, 0)
        blocked = d > hosts.BLOCK_SHARE * (t + d) and d * len(n) > 1
        result.append((str(doc), h, p, name, v or ("block" if blocked else "allow"), t, d))
    return result


def compare(spark, rows, df):
    key = lambda r: tuple(map(str, r[:5]))
    got = sorted(((str(r.page_id), r.host, r.path, r.rule, r.verdict, r.trust, r.distrust) for r in hosts.judge(df).collect()), key=key)
    want = sorted(brute(rows), key=key)
    assert [key(r) for r in got] == [key(r) for r in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], abs=1e-8)


def test_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    compare(spark, [(r.page_id, r.url, r.html) for r in pages.collect()], clash(pages))


def test_links_and_odd_urls(spark):
    urls = ["http://A.Example.com/en/x", "https://www.example.com/en/", "ftp://x.net/es/?q#f", "http://x.net", "no url", None, "",
            "http://good.org/a", "http://bad.info/b", "http://hub.info/c", "a://b://c/d", "http://É.com/x", "http://y.x.net/fr/1",
            "http://com/", "http://xcom/", "://h/p", "http://x.net/es/", "http://x.net/es/"]
    page = '<a href="http://GOOD.org/1">x</a> <img src=https://hub.info?x> <a href="/rel">y</a><a href=\'http://x.net\'>'
    rows = [(i if i != 3 else None, u, page if i % 3 else (None if i % 2 else "")) for i, u in enumerate(urls)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    compare(spark, rows, df)
    assert hosts.judge(df.limit(0)).count() == 0


def test_long_chain_is_solved(spark):
    """Distrust reaches hosts any number of links from a seed: ranks solve the linear system."""
    n = 16  # h1 links to h0, h2 to h1 and so on; 0 is blocked, t0 allowed
    rows = [(0, "http://h0.net/es/", "")]
    rows += [(i, f"http://h{i}.net/", f'<a href="http://h{i - 1}.net/">') for i in range(1, n)]
    rows += [(100, "http://t0.com/", '<a href="http://t1.org/">')]
    rows += [(100 + i, f"http://t{i}.org/", f'<a href="http://t{i + 1}.org/">') for i in range(1, n)]
    rows += [(1000 + i, f"http://alone{i}.org/", "") for i in range(120)]
    names = sorted({parts(u)[0] for _, u, _ in rows} | {f"t{n}.org"})
    at = {h: i for i, h in enumerate(names)}
    links = np.zeros((len(names), len(names)))
    for _, u, page in rows:
        for to in re.findall('//([^/]+)/', page):
            links[at[to], at[parts(u)[0]]] += 1
    want = []
    for m, seed in ((links, "t0.com"), (links.T, "h0.net")):
        m = m / np.maximum(m.sum(axis=0), 1)
        s = np.eye(len(names))[at[seed]]
        want.append(np.linalg.solve(np.eye(len(names)) - hosts.DAMPING * m, (1 - hosts.DAMPING) * s))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.host: r for r in hosts.judge(df).collect()}
    for h, r in got.items():
        assert (r.trust, r.distrust) == pytest.approx((want[0][at[h]], want[1][at[h]]), abs=3e-9)
    for i in range(9, 13):
        assert got[f"h{i}.net"].verdict == "block" and got[f"h{i}.net"].distrust > 1 / len(got)
