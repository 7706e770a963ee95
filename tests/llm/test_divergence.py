"""Source divergence against sums over all kept terms, in plain integers."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from tests.llm.helpers import clash, odd_texts
from tresoria.llm import divergence as D

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
UPPER = {c: c + 32 for c in range(65, 91)}


def brute(rows, top=200):
    terms = [(lang or "", source or "", [t.translate(UPPER) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")])
             for _, text, lang, source, _ in rows]
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, ts in terms:
        groups[lang, source].update(ts)
        docs[lang].update(set(ts))
    out = []
    for lang in docs.keys() | {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= 3]
        v, whole = len(kept), Counter()
        own = {s: c for (la, s), c in groups.items() if la == lang}
        for c in own.values():
            whole.update(c)

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (n + v) for t in kept}

        p, q = {s: shares(c) for s, c in own.items()}, shares(whole)
        for s in own:
            pair = [(sum((p[s][t] - p[x][t]) ** 2 // p[x][t] for t in kept), x) for x in own if x != s]
            term = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pair), ("term", term)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, x, n, i + 1) for i, (n, x) in enumerate(found) if part == "pair" or i < top]
    return sorted(out)


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def some_rows(n=400, seed=2):
    rng = random.Random(seed)
    words = [w for w in ("The", "THE", "été", "ÉTÉ", "İx", "naïve", "日本", "🙂ok", "a_b", "x1y", "ß", " z")]
    words += ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 4))) for _ in range(150)]
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "en", "en", "fr", None, ""])
        source = rng.choice(["s0"] * 6 + ["s1", "s2", "Z", "é", None, ""])
        rows.append((i, " ".join(rng.choices(words, [1 / (k + 1) for k in range(len(words))], k=rng.randint(0, 40))), lang, source, 0))
    rows += [(n, "only here", "de", "s0", 0), (n + 1, "1234 ...", "it", "s1", 0), (n + 2, None, "it", "s2", 0), (n + 3, "x", "it", None, 0)]
    rows += [(n + 4 + i, t, "en", f"odd{i % 3}", 0) for i, t in enumerate(x for x in odd_texts() if not isinstance(x, tuple))]
    return rows + rows[:25]  # repeated rows count again


def test_equals_plain_sums(spark):
    rows = some_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    want = brute(rows)
    assert rows_of(D.audit(df)) == want
    assert rows_of(D.audit(df, block=40)) == want  # many blocks of the index
    assert rows_of(D.audit(clash(df))) == want


def test_top_terms_rank_ties_in_byte_order(spark):
    rows = [(i, "bb aa é zz cc", "en", "s", 0) for i in range(3)] + [(9, "zz zz zz", "en", "t", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(D.audit(df, top=3)) == brute(rows, 3)
    assert [r[3] for r in sorted(brute(rows, 9), key=lambda r: r[5]) if r[1:3] == ("s", "term")] == ["aa", "bb", "cc", "é"]


def test_groups_without_kept_terms(spark):
    rows = [(0, "one", "en", "a", 0), (1, "two", "en", "b", 0), (2, None, "en", "c", 0)]
    got = rows_of(D.audit(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute(rows) and len(got) == 6 and {r[4] for r in got} == {0}


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert D.audit(df).collect() == []


def test_a_block_is_scattered_in_pieces(monkeypatch):
    rng = np.random.default_rng(1)
    n = 400
    term, source = rng.integers(0, 60, n), rng.integers(0, 12, n)
    at = np.unique(term * 12 + source)
    table = pa.table({"lang": ["en"] * len(at), "term": [f"t{x // 12}" for x in at], "source": [f"s{x % 12}" for x in at],
                      "zero": (at % 12 + 5).astype(np.int64), "p": rng.integers(20, 10**9, len(at))})
    whole = sorted(map(tuple, zip(*D.accumulate(table).to_pydict().values())))
    monkeypatch.setattr(D, "SCATTER", 7)
    assert sorted(map(tuple, zip(*D.accumulate(table).to_pydict().values()))) == whole
    assert len(whole) <= 12 * 11 and all(g != s for _, g, s, _ in whole)
