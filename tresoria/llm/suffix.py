"""Removal of repeated byte strings by a distributed cover of sampled suffixes.

A byte goes when a string of ``width`` bytes covers it that also starts anywhere
else.  The plan is that of a difference-cover suffix sort, kept to the first
``width`` bytes of each suffix, which is all that the question needs:

1. *Sample.*  Of every ``reach`` consecutive starts the one with the smallest gram
   hash is sampled.  The choice looks at no byte outside the string that begins
   at the first of them, so two equal strings meet at samples with the same
   distance.  That is what a difference cover is for; sampling by content instead
   of residues needs no common alignment of texts.
2. *Names.*  A sample is named by the ``width - reach + 1`` bytes that every string
   over it holds.  Equal names are brought together by Spark's shuffle; a sample
   whose name has no equal neighbour is settled, and so are all starts that
   belong to it.
3. *Recursion.*  What is left is named again by the whole block, from its first
   start to the end of its last string.  Blocks with an equal are repeated in all
   their strings.
4. *Remaining suffixes.*  Only blocks that occur once and share their sample's name
   with another are left open.  Their starts, and those of one copy of each other
   block with that name, are named in pieces of 16 by what all strings of a piece
   hold and by all that they cover, which settles most; the others are named by
   their whole strings and compared once more.

Names are fingerprints (128 bits where they decide), not ranks: equal strings only have to be
neighbours, and a fingerprint needs no shuffle to be given.

Passages below ``width`` stay in the text, as the rule says, but are reported: ``shares_passage`` tells whether a row
holds a string that another row holds too.  It is found by the sample alone: of every ``passage_reach`` starts one
names the ``passage - passage_reach + 1`` bytes from it, so rows that share ``passage`` bytes always share a name, and
rows that share a name share that many bytes.

Scale: a few numbers for each ``reach / 2`` bytes are shuffled, and the texts never,
unless the spans to cut outgrow ``small_bytes``: they meet their texts in a
broadcast join up to that size and in a shuffled one beyond.  Copies are counted
before anything is shuffled; no name's rows are ever collected.

Defined results: a null text is empty; texts shorter than ``width`` bytes stay; a
null id stays null; repeated rows are copies of each other; other columns are
ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tresoria.session import materialize

WIDTH = 400
REACH = 256
GRAM = 16
#: starts handled at a time: bounds memory for very long texts
CHUNK = 1 << 20
#: largest side that is sent to every task
SMALL_BYTES = 48 << 20
#: a passage of some fifty words, and the starts of which one is sampled for it
PASSAGE = 256
PASSAGE_REACH = 112
_MUL = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64((1 << 21) - 1)


def _gram_hashes(a: np.ndarray, gram: int) -> np.ndarray:
    """A well mixed hash of each run of ``gram`` bytes (a power of two)."""
    h, size, mul = a.astype(np.uint64) + np.uint64(1), 1, _MUL
    with np.errstate(over="ignore"):
        while size < gram:
            h = h[:-size] * mul + h[size:]
            mul, size = mul * mul, size * 2
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return h


def samples(text: bytes, width: int = WIDTH, reach: int = REACH, gram: int = GRAM) -> list[tuple[int, int, int]]:
    """(sampled place, first start, end of starts) for all starts of strings of
    ``width`` bytes: each start belongs to the place with the smallest gram hash
    among the ``reach`` from it on (the first of equals)."""
    out, n_starts = [], len(text) - width + 1
    for lo in range(0, max(0, n_starts), CHUNK):
        n = min(CHUNK, n_starts - lo)
        a = np.frombuffer(text, dtype=np.uint8, count=n + reach + gram - 2, offset=lo)
        h = _gram_hashes(a, gram)
        # smallest (hash, place) of each window: minima from block starts and to block ends
        key = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
        full = np.full(-(-len(key) // reach) * reach, np.uint64(2 ** 64 - 1))
        full[:len(key)] = key
        rows = full.reshape(-1, reach)
        pre = np.minimum.accumulate(rows, axis=1).ravel()
        suf = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        at = (np.minimum(suf[:n], pre[reach - 1:reach - 1 + n]) & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.diff(at, prepend=-1))
        ends = np.append(first[1:], n)
        out.extend(zip((at[first] + lo).tolist(), (first + lo).tolist(), (ends + lo).tolist()))
    return out


def _signed(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype="<i8")


def _blocks(docs: DataFrame, width: int, reach: int) -> DataFrame:
    """(key, p, a, b, name, block): each sample with its starts, its name, its block's name."""
    held = width - reach + 1

    def run(batches):
        name = xxhash.xxh3_64_intdigest
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo in range(0, len(keys), 200):
                k, at, names, blocks = [], [], [], []
                for key, t in zip(keys[lo:lo + 200], texts[lo:lo + 200]):
                    found = samples(t, width, reach)
                    k.extend([key] * len(found))
                    at.extend(found)
                    names.extend(name(t[p:p + held]) for p, _, _ in found)
                    blocks.extend(name(t[x:y + width - 1]) for _, x, y in found)
                places = np.array(at, dtype=np.int32).reshape(-1, 3)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k, pa.binary()), *(pa.array(places[:, i]) for i in range(3)),
                     *(pa.array(np.array(n, dtype="<u8").view("<i8")) for n in (names, blocks))],
                    names=["key", "p", "a", "b", "name", "block"])

    return docs.select("key", "text").mapInArrow(run, "key binary, p int, a int, b int, name long, block long")


#: starts that are named together before they are named one by one
STEP = 16


def _pieces(texts: DataFrame, width: int) -> DataFrame:
    """(c1, c2, hull, id, single, u, v): the starts u..v of each piece of the blocks in
    (text, blocks).  Pieces lie at fixed distances from the sample, so equal strings
    start in pieces with the same distance.  (c1, c2) names the core, the bytes that
    every string from the piece holds, ``hull`` all bytes of its strings."""
    def run(batches):
        core_of, hull_of = xxhash.xxh3_128_digest, xxhash.xxh3_64_intdigest
        for batch in batches:
            for t, blocks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for lo in range(0, len(blocks), 8000):
                    rows, cores, hulls = [], [], []
                    flat = iter(blocks[lo:lo + 8000])
                    for tag, p, a, b in zip(flat, flat, flat, flat):
                        for q in range((p - b + 1) // STEP, (p - a) // STEP + 1):
                            last = p - STEP * q
                            u, v = max(a, last - STEP + 1), min(b - 1, last)
                            cores.append(core_of(t[last:last - STEP + 1 + width]))
                            hulls.append(hull_of(t[u:v + width]))
                            rows.append((tag >> 1, bool(tag & 1), u, v))
                    names = _signed(cores).reshape(-1, 2)
                    ids, single, u, v = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names[:, 0]), pa.array(names[:, 1]), pa.array(np.array(hulls, dtype="<u8").view("<i8")),
                         pa.array(ids, pa.int64()), pa.array(single, pa.bool_()), pa.array(u, pa.int32()), pa.array(v, pa.int32())],
                        names=["c1", "c2", "hull", "id", "single", "u", "v"])

    return texts.mapInArrow(run, "c1 long, c2 long, hull long, id long, single boolean, u int, v int")


def _starts(texts: DataFrame, width: int) -> DataFrame:
    """(n1, n2, id, single, u, v): every start of the pieces in (text, pieces), named by its string."""
    def run(batches):
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for t, pieces in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for lo in range(0, len(pieces), 6000):
                    flat = iter(pieces[lo:lo + 6000])
                    rows = [(tag >> 1, bool(tag & 1), i) for tag, u, v in zip(flat, flat, flat) for i in range(u, v + 1)]
                    names = _signed([digest(t[i:i + width]) for _, _, i in rows]).reshape(-1, 2)
                    ids, single, at = zip(*rows)
                    at = pa.array(at, pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names[:, 0]), pa.array(names[:, 1]), pa.array(ids, pa.int64()), pa.array(single, pa.bool_()), at, at],
                        names=["n1", "n2", "id", "single", "u", "v"])

    return texts.mapInArrow(run, "n1 long, n2 long, id long, single boolean, u int, v int")


def _meet(many: DataFrame, side: DataFrame, on, rows: int, row_bytes: int, how: str, small_bytes: int) -> DataFrame:
    """``many`` joined with ``side``: sent to every task while its bytes are few."""
    return many.join(F.broadcast(side) if rows * row_bytes <= small_bytes else side, on, how)


def _texts_with(docs: DataFrame, parts: DataFrame, n_parts: int, small_bytes: int) -> DataFrame:
    """(text, parts): each text that has ``parts`` (key, x), once, with the numbers of
    all of them in a row.  Copies of a text collapse in each task before the texts
    are shuffled: after the join while the parts are sent to every task, before it
    when the join itself shuffles."""
    by_text = parts.groupBy("key").agg(F.flatten(F.collect_list("x")).alias("parts"))
    texts = docs.select("key", "text")
    if n_parts * 48 <= small_bytes:
        return texts.join(F.broadcast(by_text), "key").dropDuplicates(["key"]).select("text", "parts")
    return texts.dropDuplicates(["key"]).join(by_text, "key").select("text", "parts")


def repeated_spans(docs: DataFrame, width: int = WIDTH, reach: int = REACH, small_bytes: int = SMALL_BYTES) -> DataFrame:
    """(key, s, e): covered stretches, which may overlap, of ``docs`` (key, text)."""
    every = materialize(_blocks(docs, width, reach), "suffix-samples")
    # written first, so that the join's sides are plain shuffles and a hot name's rows can be split
    names = materialize(every.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("name"), "suffix-names")
    left = materialize(every.join(names.hint("merge"), "name", "left_semi"), "suffix-named")
    # the same block twice: all its strings are repeated
    blocks = left.groupBy("name", "block").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "p", "a", "b")).alias("one"))
    blocks = materialize(blocks.withColumn("id", F.monotonically_increasing_id()), "suffix-blocks")
    again = left.join(blocks.filter("n > 1").select("name", "block"), ["name", "block"]).select(
        "key", F.col("a").alias("s"), (F.col("b") + (width - 1)).alias("e")).distinct()
    # blocks that occur once, and one copy of each other block of their names
    open_names = blocks.groupBy("name").agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("kinds")).filter(
        "least = 1 and kinds > 1").select("name")
    open_ = materialize(blocks.join(open_names, "name").select("id", (F.col("n") == 1).alias("single"), "one.*"), "suffix-open")
    tag = F.shiftleft("id", 1) + F.col("single").cast("long")
    texts = _texts_with(docs, open_.select("key", F.array(tag, "p", "a", "b").alias("x")), open_.count(), small_bytes)

    # pieces of 16 starts: a core that no other block has settles its piece, and so does an equal hull
    pieces = materialize(_pieces(texts, width), "suffix-pieces")
    two = [F.min("id").alias("lo"), F.max("id").alias("hi")]
    cores = pieces.groupBy("c1", "c2").agg(*two).filter("lo < hi").select("c1", "c2")
    met = materialize(pieces.join(cores, ["c1", "c2"]), "suffix-cores")
    hulls = materialize(met.groupBy("c1", "c2", "hull").agg(*two, F.max("single").alias("single"),
                                                            F.min(F.struct("id", "u", "v")).alias("one")), "suffix-hulls")
    whole = met.filter("single").join(hulls.filter("lo < hi").select("c1", "c2", "hull"), ["c1", "c2", "hull"])
    still = hulls.filter("single and lo = hi").select("c1", "c2").distinct()

    # what is left is named start by start
    ends = hulls.join(still, ["c1", "c2"]).select("single", "one.*").join(open_.select("id", "key"), "id")
    ends = materialize(ends.select("key", F.array(tag, "u", "v").alias("x")), "suffix-ends")
    starts = materialize(_starts(_texts_with(docs, ends, ends.count(), small_bytes), width), "suffix-starts")
    twice = starts.groupBy("n1", "n2").agg(*two).filter("lo < hi").select("n1", "n2")
    found = starts.filter("single").join(twice, ["n1", "n2"]).select("id", "u", "v").union(whole.select("id", "u", "v"))
    found = found.groupBy("id").agg(F.min("u").alias("s"), (F.max("v") + width).alias("e"))
    return again.union(found.join(open_.select("id", "key"), "id").select("key", "s", "e"))


def sharing_texts(docs: DataFrame, passage: int = PASSAGE, reach: int = PASSAGE_REACH) -> DataFrame:
    """(key) of the texts of at least ``passage`` bytes, of ``docs`` (key, text), that share a sampled name with another row:
    with another text, or with a copy of their own."""
    held = passage - reach + 1

    def run(batches):
        name = xxhash.xxh3_64_intdigest
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo in range(0, len(keys), 200):
                k, names = [], []
                for key, t in zip(keys[lo:lo + 200], texts[lo:lo + 200]):
                    found = {name(t[p:p + held]) for p, _, _ in samples(t, passage, reach)}
                    k += [key] * len(found)
                    names.extend(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k, pa.int64()), pa.array(np.array(names, dtype="<u8").view("<i8"))], names=["k", "name"])

    short = F.xxhash64("key").alias("k")
    every = materialize(docs.select(short, "text").mapInArrow(run, "k long, name long"), "suffix-passages")
    shared = materialize(every.groupBy("name").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).filter("lo < hi").select("name"),
                         "suffix-passage-names")
    found = every.join(shared, "name", "left_semi").select("k").distinct()
    long_ = docs.filter(F.length("text") >= passage).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return long_.select("key", "n", short).join(found.withColumn("found", F.lit(True)), "k", "left").filter("n > 1 or found").select("key")


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, shares_passage boolean"


def _merged(spans: DataFrame) -> DataFrame:
    """(key, spans): the maximal runs of the sorted stretches in ``x``, as start and end in a row."""
    def run(batches):
        for batch in batches:
            out = []
            for x in batch.column(1).to_pylist():
                flat = []
                for y in x:
                    if flat and y["s"] <= flat[-1]:
                        flat[-1] = max(flat[-1], y["e"])
                    else:
                        flat += (y["s"], y["e"])
                out.append(flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int32()))], names=["key", "spans"])

    return spans.select("key", "x").mapInArrow(run, "key binary, spans array<int>")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, text): the text's bytes and their MD5, which texts alike share."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    return docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text")).withColumn("key", F.unhex(F.md5("text")))


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, reach: int = REACH,
           with_text: bool = True, small_bytes: int = SMALL_BYTES, passage: int = PASSAGE,
           passage_reach: int = PASSAGE_REACH) -> DataFrame:
    """Id, number of bytes, of removed bytes and of removed runs, SHA-256 of what is
    kept, whether the text shares a passage with another row, and with ``with_text`` the kept
    bytes themselves, of each row."""
    rows = keyed(docs, id_col, text_col)
    # stretches of a text that touch become one before they meet the text again
    spans = repeated_spans(rows, width, reach, small_bytes).groupBy("key").agg(
        F.array_sort(F.collect_list(F.struct("s", "e"))).alias("x"))
    shared = sharing_texts(rows, passage, passage_reach).withColumn("shared", F.lit(True))
    spans = materialize(_merged(spans).join(shared, "key", "full"), "suffix-spans")
    size = spans.agg(F.coalesce(F.sum(F.coalesce(F.size("spans"), F.lit(0)) * 4 + 64), F.lit(0)).alias("n")).first()["n"]

    def run(batches):
        for batch in batches:
            out = [[] for _ in range(7)]
            for doc_id, t, found, shares in zip(*(batch.column(i).to_pylist() for i in range(4))):
                flat = iter(found or [])
                cut = list(zip(flat, flat))
                kept, at = [], 0
                for s, e in cut:
                    kept.append(t[at:s])
                    at = e
                kept = b"".join([*kept, t[at:]])
                row = (doc_id, len(t), len(t) - len(kept), len(cut), hashlib.sha256(kept).hexdigest(), bool(shares), kept)
                for col, v in zip(out, row):
                    col.append(v)
            cols = [pa.array(c, pa.int64()) for c in out[:4]] + [pa.array(out[4], pa.string()), pa.array(out[5], pa.bool_())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "shares_passage"]
            if with_text:
                cols, names = cols + [pa.array(out[6], pa.binary())], names + ["kept"]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    joined = _meet(rows, spans, "key", size, 1, "left", small_bytes).select("id", "text", "spans", "shared")
    return joined.mapInArrow(run, RESULT + (", kept binary" if with_text else "")).withColumnRenamed("doc_id", id_col)
