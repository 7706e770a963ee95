"""Greedy string tiling against a plain implementation."""

import random

import numpy as np

from tests.llm.helpers import clash, frame, odd_texts
from tresoria.llm import tiling

SF = "/root/testdata/sf0.001"


def brute_cover(item, text, least):
    """Tokens of ``item`` covered by greedy tiles, by comparing all pairs of places."""
    used_i, used_t, covered = [False] * len(item), [False] * len(text), 0
    while True:
        best = []
        for d in range(-len(item) + 1, len(text)):
            i, t = max(0, -d), max(0, d)
            run = 0
            while i < len(item) and t < len(text):
                ok = item[i] == text[t] and not used_i[i] and not used_t[t]
                run = run + 1 if ok else 0
                end = i + 1 == len(item) or t + 1 == len(text)
                more = not end and item[i + 1] == text[t + 1] and not used_i[i + 1] and not used_t[t + 1]
                if run >= least and not more:
                    best.append((run, d, i - run + 1, t - run + 1))
                i, t = i + 1, t + 1
        if not best:
            return covered
        longest = max(b[0] for b in best)
        for n, _, a, b in sorted(x for x in best if x[0] == longest):
            if not any(used_i[a:a + n]) and not any(used_t[b:b + n]):
                used_i[a:a + n] = [True] * n
                used_t[b:b + n] = [True] * n
                covered += n


def test_tiles_equal_brute_force():
    rng = random.Random(3)
    for _ in range(300):
        item = [rng.randint(1, 4) for _ in range(rng.randint(1, 25))]
        text = [rng.randint(1, 4) for _ in range(rng.randint(1, 40))]
        if rng.random() < 0.7:
            cut = rng.randint(0, len(item))
            text[5:5] = item[cut:] + [9] + item[:cut]
        least = rng.choice([2, 3, 5])
        tiles = tiling.tile(np.array(item), np.array(text), least)
        assert sum(n for _, _, n in tiles) == brute_cover(item, text, least)
        assert all(n >= least and item[a:a + n] == text[b:b + n] for a, b, n in tiles)


def test_documents_equal_brute_force(spark):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    items = [(r.item_id, tiling.tokens(r.text or "")) for r in bench.collect()]
    want = set()
    for r in docs.collect():
        words = tiling.tokens(r.text or "")
        seeds = {tuple(words[i:i + 5]) for i in range(len(words) - 4)}
        for item_id, item in items:
            # as much of the item as its seeds could cover at most, before the slow count
            if sum(tuple(item[i:i + 5]) in seeds for i in range(len(item) - 4)) and len(words) < 3000:
                if len(item) >= 5 and brute_cover(item, words, 5) >= 0.8 * len(item):
                    want.add((r.doc_id, item_id))
    long_docs = {r.doc_id for r in docs.collect() if len(tiling.tokens(r.text or "")) >= 3000}
    got = {(r.doc_id, r.item_id) for r in tiling.leaks(clash(docs), clash(bench)).collect()}
    assert {g for g in got if g[0] not in long_docs} == want and want
    blocks = {(r.doc_id, r.item_id) for r in tiling.leaks(docs, bench, block_bytes=1500).collect()}
    assert blocks == got


def test_reordered_passages(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijk") for _ in range(6))
    item = [word() for _ in range(40)]
    other = [word() for _ in range(200)]
    turned = item[20:30] + other[:7] + item[:10] + other[7:9] + item[30:] + other[9:20] + item[10:20]
    half = item[:20] + other
    texts = [" ".join(other), " ".join(turned), " ".join(half), ("X " + ", ".join(item)).upper() + "!", None, ""]
    bench = spark.createDataFrame([(7, " ".join(item)), (8, "too short"), (9, None), (None, " ".join(item))], "item_id long, text string")
    got = sorted((r.doc_id, str(r.item_id), r.coverage) for r in tiling.leaks(frame(spark, texts), bench).collect())
    assert got == [(1, "7", 1.0), (1, "None", 1.0), (3, "7", 1.0), (3, "None", 1.0)]
    df = clash(frame(spark, texts))
    kept = tiling.decontaminate(df, bench, block_bytes=200)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [0, 2, 4, 5]


def test_odd_rows(spark):
    df = frame(spark, odd_texts())
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert tiling.leaks(df, bench).count() == 0
    assert tiling.decontaminate(df, bench.limit(0)).count() == df.count()
    assert tiling.leaks(df.limit(0), bench).count() == 0
    repeated = frame(spark, [(1, "one two three four five six")] * 2)
    twice = spark.createDataFrame([(1, "one two three four five six")] * 2, "item_id long, text string")
    assert tiling.leaks(repeated, twice).count() == 4
