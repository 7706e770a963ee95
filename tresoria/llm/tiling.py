"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are token sequences (lower-cased runs of letters
and digits).  Windows of ``least`` tokens that both hold are the seeds.  For each
item that shares a seed with a document, the longest matches of unmarked tokens
are marked again and again, found by running Karp-Rabin hashes over what is still
unmarked, until none of ``least`` tokens is left.  A document leaks an item when
its tiles cover enough of the item, in whatever order they stand.

Scale: the documents are read once for each block of the benchmark and never
shuffled.  A block's size is bounded in bytes (``block_bytes``), so its index is
safe to send to every task however large the benchmark grows.

Defined results: a null or empty text matches nothing; an item of fewer than
``least`` tokens never matches; null ids stay; repeated rows on either side give
repeated pairs; an empty benchmark leaves every document clean; other columns
are ignored by :func:`leaks` and kept by :func:`decontaminate`.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"[^\W_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def rolling(ids: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hash (mod 2**64) of each window of ``width`` ids."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    h = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            h = h * _BASE + ids[k:k + n].astype(np.uint64)
    return h


def _meeting(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (in a, in b) of all equal values."""
    order = np.argsort(b, kind="stable")
    lo, hi = np.searchsorted(b[order], a, "left"), np.searchsorted(b[order], a, "right")
    n = hi - lo
    if not n.any():
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    left = np.repeat(np.arange(len(a)), n)
    shift = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return left, order[np.repeat(lo, n) + shift]


def tile(item: np.ndarray, text: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (place in item, place in text, length), each of ``least`` ids or
    more, longest first; no id of either side is in two tiles."""
    used_i, used_t = np.zeros(len(item), dtype=bool), np.zeros(len(text), dtype=bool)
    out = []
    while True:
        open_i = np.flatnonzero(np.convolve(used_i, np.ones(least, dtype=int), "valid") == 0) if len(item) >= least else []
        open_t = np.flatnonzero(np.convolve(used_t, np.ones(least, dtype=int), "valid") == 0) if len(text) >= least else []
        if not len(open_i) or not len(open_t):
            return out
        p, t = _meeting(rolling(item, least)[open_i], rolling(text, least)[open_t])
        p, t = open_i[p], open_t[t]
        # the hash only proposes: every id of the window is compared
        same = np.ones(len(p), dtype=bool)
        for k in range(least):
            same &= item[p + k] == text[t + k]
        p, t = p[same], t[same]
        if not len(p):
            return out
        # windows in a row on one diagonal are one match
        order = np.lexsort((p, t - p))
        p, t = p[order], t[order]
        new = np.ones(len(p), dtype=bool)
        new[1:] = (np.diff(t - p) != 0) | (np.diff(p) != 1)
        first = np.flatnonzero(new)
        length = np.diff(np.append(first, len(p))) + least - 1
        longest = int(length.max())
        for j in first[length == longest]:
            a, b = int(p[j]), int(t[j])
            if not used_i[a:a + longest].any() and not used_t[b:b + longest].any():
                used_i[a:a + longest] = used_t[b:b + longest] = True
                out.append((a, b, longest))


class Index:
    """The seeds of one block of the benchmark."""

    def __init__(self, items: list[tuple], least: int):
        self.least, self.vocab, self.items = least, {}, []
        seeds, owner = [], []
        for item_id, text in items:
            ids = np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in tokens(text or "")], dtype=np.int64)
            if len(ids) >= least:
                h = np.unique(rolling(ids, least))
                seeds.append(h)
                owner.append(np.full(len(h), len(self.items), dtype=np.int64))
                self.items.append((item_id, ids))
        self.seeds = np.concatenate(seeds) if seeds else np.empty(0, dtype=np.uint64)
        self.owner = np.concatenate(owner) if owner else np.empty(0, dtype=np.int64)
        order = np.argsort(self.seeds, kind="stable")
        self.seeds, self.owner = self.seeds[order], self.owner[order]

    def leaks(self, text: str, threshold: float) -> list[dict]:
        """Items of which the text covers ``threshold`` or more."""
        words = tokens(text)
        if len(words) < self.least or not len(self.seeds):
            return []
        get = self.vocab.get
        ids = np.array([get(w, 0) for w in words], dtype=np.int64)
        known = np.flatnonzero(np.convolve(ids == 0, np.ones(self.least, dtype=int), "valid") == 0)
        if not len(known):
            return []
        h = rolling(ids, self.least)[known]
        lo = np.searchsorted(self.seeds, h, "left")
        hit = (lo < len(self.seeds)) & (self.seeds[np.minimum(lo, len(self.seeds) - 1)] == h)
        if not hit.any():
            return []
        places, h = known[hit], h[hit]
        # only tokens inside a shared window can be tiled; a gap keeps the rest apart
        near = np.zeros(len(ids) + 1, dtype=np.int64)
        np.add.at(near, places, 1)
        np.add.at(near, places + self.least, -1)
        inside = np.cumsum(near[:-1]) > 0
        keep = np.flatnonzero(inside)
        breaks = np.flatnonzero(np.diff(keep) > 1) + 1
        short = np.insert(ids[keep], breaks, -1)
        out = []
        own = np.unique(h)
        a, b = np.searchsorted(self.seeds, own, "left"), np.searchsorted(self.seeds, own, "right")
        for j in sorted({int(self.owner[i]) for x, y in zip(a, b) for i in range(x, y)}):
            item_id, item = self.items[j]
            tiles = tile(item, short, self.least)
            covered = sum(n for _, _, n in tiles)
            if covered >= threshold * len(item):
                out.append({"item_id": item_id, "covered": covered, "item_tokens": len(item),
                            "n_tiles": len(tiles), "longest": max(n for _, _, n in tiles)})
        return out


#: Words in a seed and in the shortest tile; least share of an item that tiles cover.
LEAST, THRESHOLD = 5, 0.8
BLOCK_BYTES = 8 << 20

FOUND = "array<struct<item_id:bigint,covered:bigint,item_tokens:bigint,n_tiles:bigint,longest:bigint>>"
_FOUND = pa.list_(pa.struct([(n, pa.int64()) for n in ("item_id", "covered", "item_tokens", "n_tiles", "longest")]))


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int):
    """The benchmark's rows in blocks of about ``block_bytes``, one at a time."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t"))
    size = rows.agg(F.sum(F.octet_length(F.coalesce("t", F.lit("")))).alias("b")).first()["b"] or 0
    n = max(1, -(-size // block_bytes))
    if n > 1:
        rows = rows.withColumn("block", F.pmod(F.xxhash64("i", "t"), F.lit(n)))
    for k in range(n):
        yield [(r["i"], r["t"]) for r in (rows.filter(F.col("block") == k) if n > 1 else rows).collect()]


def leak_columns(benchmark: DataFrame, text: Column, id_col: str = "item_id", text_col: str = "text",
                 least: int = LEAST, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> list[Column]:
    """For each block of the benchmark, the array of its items that ``text`` leaks."""
    spark = benchmark.sparkSession
    out = []
    for items in _blocks(benchmark, id_col, text_col, block_bytes):
        out.append(_search(spark.sparkContext.broadcast(Index(items, least)), threshold)(text))
    return out


def _search(sent, threshold: float):
    """The function of a text column that looks into one block's index."""
    @F.arrow_udf(FOUND)
    def found(t: pa.Array) -> pa.Array:
        index = sent.value
        return pa.array([index.leaks(x, threshold) if x else [] for x in t.to_pylist()], type=_FOUND)

    return found


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row for each document and benchmark item that it leaks: id, item_id,
    covered and all tokens of the item, coverage, number of tiles, longest tile."""
    one = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    every = None
    for col in leak_columns(benchmark, F.col("__text"), **how):
        part = one.select(F.col("__id").alias(id_col), col.alias("x")).select(id_col, F.explode("x").alias("x")).select(
            id_col, "x.item_id", "x.covered", "x.item_tokens", (F.col("x.covered") / F.col("x.item_tokens")).alias("coverage"),
            "x.n_tiles", "x.longest")
        every = part if every is None else every.union(part)
    return every


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """The documents that leak no item; columns as given."""
    boxed = docs.select(F.struct("*").alias("__row"), F.col(text_col).cast("string").alias("__text"))
    for col in leak_columns(benchmark, F.col("__text"), **how):
        boxed = boxed.withColumn("__found", F.size(col)).filter("__found = 0").drop("__found")
    return boxed.select("__row.*")
