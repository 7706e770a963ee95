"""Removal of repeated strings against brute force over all starts."""

import hashlib
import random
from collections import Counter

import pytest

from tests.llm.helpers import clash, frame, odd_texts
from tresoria.llm import suffix

SF = "/root/testdata/sf0.001"


def brute(rows, width=400):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i:i + width] for t in texts for i in range(len(t) - width + 1))
    out = []
    for (doc, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - width + 1):
            if seen[t[i:i + width]] > 1:
                gone[i:i + width] = b"\x01" * width
        runs = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((str(doc), len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got(df, **how):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                  for r in suffix.remove(df, with_text=False, **how).collect())


def test_documents_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows)
    assert got(clash(docs)) == want and any(w[2] for w in want)


@pytest.mark.parametrize("small_bytes", [0, 1 << 20])
def test_planted_passages(spark, small_bytes):
    """Edited copies, shared passages at odd places, self repeats and constant runs."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randint(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(90) for _ in range(4)]
    texts = []
    for _ in range(60):
        parts = [text(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            cut = rng.randint(0, 80)
            s = s[cut:] if rng.random() < 0.5 else s[:len(s) - cut]
            if rng.random() < 0.4:
                at = rng.randrange(len(s))
                s = s[:at] + "#" + s[at + 1:]
            parts += [s, text(rng.randint(0, 30))]
        texts.append("".join(parts))
    texts += ["ab" * 700, "a" * 399, "a" * 400, "a" * 405, "ba" * 300, texts[0], texts[0], shared[0][:399], shared[1][-400:]]
    rows = list(enumerate(texts))
    assert got(frame(spark, texts), small_bytes=small_bytes) == brute(rows)


def test_small_width_many_repeats(spark):
    rng = random.Random(9)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 300))) for _ in range(30)] + ["a" * 500, None, ""]
    rows = list(enumerate(texts))
    for width, reach in ((20, 4), (24, 8), (40, 20)):
        assert got(frame(spark, texts), width=width, reach=reach) == brute(rows, width)


def test_odd_rows(spark):
    texts = odd_texts()
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    short = [(i, t) for i, t in rows if t is None or len(t) < 60_000]
    assert got(frame(spark, short)) == brute(short)
    long_ = suffix.remove(frame(spark, [t for _, t in rows])).filter("n_bytes > 60000").collect()
    assert len(long_) == 2 and all(r.n_removed == r.n_bytes and r.n_spans == 1 and r.kept == b"" for r in long_)
    assert suffix.remove(frame(spark, ["x"]).limit(0)).count() == 0


def test_chunks_of_long_texts(monkeypatch):
    rng = random.Random(2)
    text = bytes(rng.randrange(256) for _ in range(5000))
    whole = suffix.samples(text)
    monkeypatch.setattr(suffix, "CHUNK", 700)
    parts = suffix.samples(text)
    place = lambda rows: {i: p for p, a, b in rows for i in range(a, b)}
    assert place(whole) == place(parts) and sorted(place(whole)) == list(range(len(text) - 399))


def test_copies_collapse_before_texts_are_joined(spark):
    """Beyond the broadcast, a text meets its parts once, not once for each of its copies."""
    docs = spark.createDataFrame([(i if i < 5 else 7, f"text {min(i, 5)}") for i in range(300)], "key long, text string")
    parts = spark.createDataFrame([(k, [k, n]) for k in (1, 7) for n in range(3)], "key long, x array<long>")
    for small in (0, 1 << 20):
        got = suffix._texts_with(docs, parts, 6, small)
        assert sorted((r.text, sorted(r.parts)) for r in got.collect()) == [
            (t, sorted([k, n][i] for n in range(3) for i in range(2))) for t, k in (("text 1", 1), ("text 5", 7))]
    plan = suffix._texts_with(docs, parts, 6, 0)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    line = lambda what: next(i for i, x in enumerate(plan) if what in x)
    assert line("Join Inner") < line("first(text")  # deeper in the plan: done before the join


def test_passages_below_the_width_are_reported(spark):
    """Always true where ``passage`` bytes are shared with another row, never where no name's length is."""
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    long_, part = text(300), text(140)
    docs = [text(500) for _ in range(30)]
    docs += [text(rng.randint(200, 900)) + long_ + text(rng.randint(200, 900)) for _ in range(6)]  # below 400 bytes: nothing goes
    docs += [text(400) + part + text(400) for _ in range(6)] + [long_, "short " * 10, "short " * 10, text(270), None]
    docs += [docs[0]] + [x * 2 for x in [text(256)]]  # a copy; a text that repeats itself only
    out = suffix.remove(frame(spark, docs).repartition(3), with_text=False).collect()
    own = {r.doc_id: r for r in out}
    n = len(docs)
    assert [own[i].shares_passage for i in range(1, 30)] == [False] * 29 and own[0].shares_passage and own[n - 2].shares_passage
    assert all(own[i].shares_passage and not own[i].n_removed for i in range(30, 36)) and own[42].shares_passage
    assert not any(own[i].shares_passage for i in [*range(36, 42), 43, 44, 45, 46, n - 1])


def test_shared_passages_equal_brute_force_at_both_bounds(spark):
    rng = random.Random(4)
    pieces = ["".join(rng.choice("ab ") for _ in range(rng.randint(5, 60))) for _ in range(25)]
    docs = ["".join(rng.choices(pieces, k=rng.randint(0, 8))) for _ in range(80)]
    out = suffix.remove(frame(spark, docs), with_text=False, passage=40, passage_reach=20).collect()
    held = lambda t, w: {t[i:i + w] for i in range(len(t) - w + 1)}
    flags = {r.doc_id: r.shares_passage for r in out}
    for i, t in enumerate(docs):
        others = [x for j, x in enumerate(docs) if j != i]
        must = any(held(t, 40) & held(x, 40) for x in others)
        may = len(t) >= 40 and any(held(t, 21) & held(x, 21) for x in others)
        assert must <= flags[i] <= may
    assert 0 < sum(flags.values()) < len(docs)
