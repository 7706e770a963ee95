"""Class-based scoring: base counts by brute force, a proper distribution, better than unigrams."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import clash, frame, odd_texts
from tresoria.llm import brown

SF = "/root/testdata/sf0.001"


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(rows):
    fold = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    c = Counter()
    for i, t in rows:
        if not fold(i):
            c.update([*words(t), None])
    n, v = sum(c.values()), len(c)
    out = []
    for i, t in rows:
        toks = [*words(t), None]
        out.append((str(i), fold(i), len(toks), sum(c[w] > 0 for w in toks), n,
                    sum(math.log10((c[w] + 1) / (n + v + 1)) for w in toks)))
    return sorted(out)


def compare(df, rows, **how):
    got = brown.score(df, **how).collect()
    have = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got)
    want = brute(rows)
    assert [h[:5] for h in have] == [w[:5] for w in want]
    for h, w in zip(have, want):
        assert h[5] == pytest.approx(w[5], rel=1e-9)
    assert all(r.score < 0 and math.isfinite(r.perplexity) for r in got)
    return got


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = compare(clash(docs), rows)
    held = [r for r in got if r.held_out]
    per_token = lambda col: sum(r[col] for r in held) / sum(r.n_tokens for r in held)
    assert per_token("score") > per_token("base_score") + 0.3


def test_small_tables_use_the_join(spark):
    """With few words in the model, most go through the count table: same counts, same scores."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    a = {r.doc_id: r.score for r in compare(df, rows, class_words=20, count_words_kept=60)}
    b = {r.doc_id: r.score for r in compare(df, rows, class_words=20, count_words_kept=100_000)}
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], rel=1e-9) for k in a)


def test_odd_rows(spark):
    texts = odd_texts()
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    compare(clash(frame(spark, texts)), rows)
    assert brown.score(frame(spark, ["x"]).limit(0)).count() == 0
    only_held = [(i, "a b a") for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    compare(frame(spark, only_held), only_held)


def test_probabilities_sum_to_one():
    table = {b"the": 0, b"of": 1, b"cat": 2}
    counts = {b"the": 5, b"of": 3, b"cat": 2, b"": 4}
    forms = {brown.form(w): [0, 0] for w in (b"sat", b"rarely", b"x.")}
    for w, n in ((b"sat", 1), (b"rarely", 2), (b"x.", 1)):
        forms[brown.form(w)][0] += n
        forms[brown.form(w)][1] += n == 1
    n, v = 5 + 3 + 2 + 4 + 4, 7
    bigrams = np.random.default_rng(0).integers(0, 9, (brown.SIZE, brown.SIZE)).astype(float)
    m = brown.Model(table, counts, bigrams, {f: tuple(x) for f, x in forms.items()}, n, v)
    every = [(c, counts[w]) for w, c in table.items()] + [(brown.EDGE, 4)]
    every += [(brown.form(b"sat"), 1), (brown.form(b"rarely"), 2), (brown.form(b"x."), 1)]
    for before in (0, 5, brown.EDGE):
        p = sum(m.probability(np.array([before]), np.array([c]), np.array([k]))[0] for c, k in every)
        # unknown words: one event for each form, and one of the unigrams
        p += sum(m.probability(np.array([before]), np.array([f]), np.array([0]))[0] for f in range(brown.CLASSES, brown.EDGE))
        p -= (brown.FORMS - 1) * (1 - brown.LAMBDA) / m.floor
        empty = [c for c in range(brown.CLASSES) if m.size[c] == 0]  # classes without a word give nothing
        p += brown.LAMBDA * sum(m.step[before, c] for c in empty)
        assert p == pytest.approx(1.0, abs=1e-9)


def test_exchange_raises_the_likelihood():
    """On text from two alternating kinds of words, exchange separates the kinds."""
    rng = random.Random(1)
    own = np.array([rng.randint(0, 1) for _ in range(20)])
    pairs = Counter()
    for _ in range(4000):
        a = rng.randrange(10)
        pairs[a, 10 + rng.randrange(10)] += 1
        pairs[10 + rng.randrange(10), a] += 1
    for _ in range(4):
        left, right = np.zeros((20, brown.SIZE)), np.zeros((20, brown.SIZE))
        n = np.zeros((brown.SIZE, brown.SIZE))
        for (a, b), k in pairs.items():
            right[a, own[b]] += k
            left[b, own[a]] += k
            n[own[a], own[b]] += k
        own = brown.exchange(left, right, own, n)
    assert not set(own[:10]) & set(own[10:])


def test_frequent_words_of_a_flat_vocabulary(spark):
    """Equal counts: as many words as fit are kept, the same in each run, and they are clustered."""
    flat = spark.createDataFrame([(f"w{i}".encode(), 40 if i < 3000 else 2) for i in range(5000)], "word binary, n long")
    top = brown.frequent_words(flat, 1000)
    assert 900 < len(top) <= 1000 and {n for _, n in top} == {40}
    assert top == brown.frequent_words(flat.repartition(7), 1000)
    mixed = flat.union(spark.createDataFrame([(b"often", 10_000), (b"also", 9_000)], "word binary, n long"))
    top = brown.frequent_words(mixed, 4000)
    assert top[:2] == [(b"often", 10_000), (b"also", 9_000)] and sum(n == 40 for _, n in top) == 3000 and 3900 < len(top) <= 4000
    assert len(brown.frequent_words(mixed, 10_000)) == 5002 and brown.frequent_words(mixed.limit(0), 10) == []
    assert brown.frequent_words(mixed, 1) == [(b"often", 10_000)]


def _two_kinds(texts=120):
    """Texts in which words of two kinds alternate, 200 words of each kind."""
    rng = random.Random(3)
    return [(i, " ".join(f"{'ab'[k % 2]}{rng.randrange(200)}" for k in range(120))) for i in range(texts)]


def test_likelihood_rises_with_every_pass(spark):
    docs = frame(spark, _two_kinds()).select(
        F.col("doc_id").alias("id"), F.lit(False).alias("held_out"), F.col("text").cast("binary").alias("text"))
    vocabulary = sorted({w for _, t in _two_kinds() for w in t.encode().split()})
    by_form = np.array([*(brown.form(w) for w in vocabulary), brown.EDGE], dtype=np.int64)
    of_index, n, history = brown.cluster(brown.numbered(docs, vocabulary), by_form, len(vocabulary))
    assert len(history) > 1 and all(b > a for a, b in zip(history, history[1:]))
    assert n.sum() == 120 * 121 and history[-1] == pytest.approx(brown.likelihood(n) / n.sum())


def test_words_without_a_number_are_placed(spark):
    """A table of ten words: all others of LEAST occurrences get a class all the same, each kind its own."""
    docs = frame(spark, _two_kinds()).select(
        F.col("doc_id").alias("id"), F.lit(False).alias("held_out"), F.col("text").cast("binary").alias("text"))
    vocabulary = [f"{k}{i}".encode() for i in range(5) for k in "ab"]
    of_index = np.array([0, 1] * 5 + [brown.EDGE], dtype=np.int64)
    texts = brown.numbered(docs, vocabulary)
    matrix = brown._matrix(brown._pass(texts, of_index, len(vocabulary)).filter("block = -1"))
    got = brown._settle(brown._other_words(texts, of_index), matrix, 390, brown.LEAST).collect()
    every = Counter(w for _, t in _two_kinds() for w in t.encode().split())
    assert {bytes(r.word): r.n for r in got} == {w: n for w, n in every.items() if w not in vocabulary}
    assert all((r.c >= 0) == (r.n >= brown.LEAST) for r in got) and len(got) == 390
    assert all(0 <= r.c < brown.CLASSES for r in got if r.n >= brown.LEAST)


def test_large_vocabulary_is_numbered(spark):
    """100,000 different words are all known by number, none is spelled and joined."""
    rows = [(i, " ".join(f"w{k}" for k in range(i * 1000, i * 1000 + 1000))) for i in range(100)]
    docs = frame(spark, rows).select(
        F.col("doc_id").alias("id"), F.lit(False).alias("held_out"), F.col("text").cast("binary").alias("text"))
    words = [w for w, _ in brown.frequent_words(brown.count_words(docs), brown.COUNT_WORDS)]
    assert len(words) == 100_000
    assert brown.numbered(docs, words).agg(F.sum(F.size("rare"))).first()[0] == 0


def test_numbers_of_texts(spark):
    """Numbers against words looked up one by one: cased, repeated, blank-led and other words, nulls, blank texts."""
    import zstandard
    texts = ["b A  c zz a. zz", None, "", " \n ", "\tq a q É\x1fx É\x1fx a!", "zz é zz", "B\x0cA a", "漢 a 漢. c 漢"]
    docs = frame(spark, list(enumerate(texts))).select(
        F.col("doc_id").alias("id"), F.lit(True).alias("held_out"), F.col("text").cast("binary").alias("text")).coalesce(1)
    for r in brown.numbered(docs, [b"a", b"b"]).collect():
        near, want = {}, []
        for w in map(str.encode, words(texts[r.id])):
            known = {b"a": 0, b"b": 1}.get(w)
            want.append(known if known is not None else -1 - (near.setdefault(w, len(near)) * brown.FORMS + brown.form(w) - brown.CLASSES))
        got = np.frombuffer(zstandard.ZstdDecompressor().decompress(r.ids), "<i4").tolist()
        assert got == [*want, 2] and [bytes(w) for w in r.rare] == list(near)
