"""Packing: exact ids, every id once, gapless sequences, little padding."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.helpers import clash, frame, odd_texts
from tresoria.llm import packing

SF = "/root/testdata/sf0.001"
FILE = "word_bpe_49k.json"
TOKENIZER = Tokenizer.from_file(public_tokenizers.path(FILE))


def true_ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [2]


def check(rows, texts):
    """rows of pack() against {doc_id: text}: exact round trip and rules of sequences."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, dtype="<u4")
        assert len(ids) == r.length > 0 and zlib.crc32(r.ids) == r.ids_crc32
        by_doc[r.doc_id].append((r.start, ids, r.doc_tokens))
        by_seq[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for doc, parts in by_doc.items():
        parts.sort(key=lambda p: p[0])
        at = 0
        for start, ids, total in parts:
            assert start == at
            at += len(ids)
        want = true_ids(texts[doc])
        assert at == len(want) and parts[0][2] == len(want)
        assert np.concatenate([p[1] for p in parts]).tolist() == want
    pad = 0
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.SEQUENCE
        pad += 0 if at & (at - 1) == 0 else packing.SEQUENCE - at
    return pad, sum(len(true_ids(t)) for t in texts.values()), len(by_seq)


def test_documents_round_trip(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    pad, total, _ = check(packing.pack(docs, window_tokens=60_000).collect(), texts)
    assert pad <= 0.001 * total


def test_odd_rows(spark):
    odd = [t for t in odd_texts() if not isinstance(t, tuple)]
    odd += ["It's we're <|endoftext|> é́ Σας ΟΔΟΣ İstanbul\x1cx y z\x85q ́a", "tab\there\x0b'll 12.5,3 <|startoftext|>x",
            "ctrl \x01\x02 don't", "A" * 3000 + "!" * 3000, "\u0000", "ﬁ ½ ① ﷺ"]
    df = clash(frame(spark, odd))
    check(packing.pack(df).collect(), dict(enumerate(odd)))
    assert packing.pack(df.limit(0)).count() == 0
    repeated = frame(spark, [(None, "x y"), (None, "x y"), (1, "z"), (1, "z")])
    assert sorted((str(r.doc_id), r.length) for r in packing.pack(repeated).groupBy("doc_id").agg(
        F.sum("length").alias("length")).collect()) == [("1", 4), ("None", 6)]


def test_cached_ids_equal_the_tokenizer():
    """Random strings over awkward characters, with a cache that overflows."""
    rng = random.Random(11)
    alphabet = "aAbZ09 .,!?'’\"<|>-_\n\t\x0b\x0c\r\x1c\x1f\x85\xa0éÉß漢́ 🙂Σσςİıſ½"
    e = packing.Encoder(public_tokenizers.path(FILE), cache_size=500)
    for _ in range(1500):
        t = "".join(rng.choice(alphabet if rng.random() < 0.5 else "abAB 0.,'!#") for _ in range(rng.randint(0, 40)))
        t = rng.choice(["", "", "<|endoftext|>", "don't we'll "]) + t
        assert e([t.encode()])[0].tolist() == true_ids(t)[:-1], repr(t)


def test_pieces_are_kept_instead_of_chunks():
    """Words with any punctuation around them cost a look-up of each part, texts are cut together."""
    words, marks = [a + b + c for a in "abcd" for b in "eiou" for c in "lmnr"], ["", ",", ".", "...", "é", "7", "12", "-x"]
    texts = [" ".join(w.title() + a + b for w in words for b in marks) for a in marks]
    texts += ["", " \n", "don't we'll", "a\x00b c\xa0d e", "a <|endoftext|> b", "漢 a", " É½x ", "x" * 9000]
    e = packing.Encoder(public_tokenizers.path(FILE))
    assert [ids.tolist() for ids in e([t.encode() for t in texts])] == [true_ids(t)[:-1] for t in texts]
    kept = sum(len(v) for k, v in vars(e).items() if isinstance(v, dict) and k != "table")
    assert kept < 400 < len({w for t in texts for w in t.lower().split()})


def test_other_vocabularies():
    path = public_tokenizers.path("byte_bpe_50k.json")
    e, t = packing.Encoder(path), "Hello  world\n\nA a é "
    assert e([t.encode()])[0].tolist() == Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids


def test_nnls_against_all_supports():
    import itertools
    rng = np.random.default_rng(0)
    for _ in range(30):
        a, b = rng.integers(0, 4, (4, 6)).astype(float), rng.normal(size=4) * 5
        best = float((b ** 2).sum())
        for r in range(1, 5):
            for cols in itertools.combinations(range(6), r):
                z = np.linalg.lstsq(a[:, cols], b, rcond=None)[0]
                if (z >= 0).all():
                    best = min(best, float(((a[:, cols] @ z - b) ** 2).sum()))
        x = packing.nnls(a, b)
        assert (x >= 0).all() and abs(float(((a @ x - b) ** 2).sum()) - best) < 1e-6


def test_plan_uses_each_item_once():
    rng = random.Random(2)
    for n in (0, 1, 5, 3000):
        lengths = np.array([rng.choice([rng.randint(1, 4095), 2048, 31, 1365]) for _ in range(n)], dtype=np.int64)
        planned, rest = packing.plan(lengths) if n else ([], [])
        assert sorted([i for s in planned for i in s] + rest) == list(range(n))
        assert all(sum(lengths[i] for i in s) <= 4096 for s in planned)
        if n == 3000:
            assert sum(map(len, planned)) > 0.4 * n
