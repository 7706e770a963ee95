"""Sequence packing by non-negative least squares over a length histogram.

Documents become token ids with an end id.  A task reads its rows as a stream and
packs window by window (``window_tokens`` ids at a time, so memory is bounded
whatever a partition holds):

1. every full sequence length inside a long document is a sequence of its own;
   what remains of each document has a length below it;
2. remaining lengths are counted in bins; all combinations of up to three bins
   that fill a sequence are enumerated, and non-negative least squares finds how
   often to repeat each so that they use up the histogram;
3. counts are rounded down and filled with documents of their bins;
4. the documents left over are cut greedily into the gaps of those sequences and
   then into further full sequences; the open one goes on into the next window,
   and at a partition's end it is cut at powers of two.

Nothing is shuffled: the histogram is a window's own, so a hot source or length
is no task's burden, and a lost task packs the same rows into the same sequences.

Defined results: a null or empty text is the end id alone; a null id stays null;
repeated rows are packed each; an empty table gives no piece; other columns are
ignored.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from array import array
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tresoria.llm.common import cut_groups, cut_words

SEQUENCE = 4096
END_ID = 2
BLANK, LETTER, DIGIT, SYMBOL, ODD = range(5)  # kinds of characters
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


class Encoder:
    """Token ids of whole texts with caches of their parts.

    The vocabulary's pre-tokenizer never joins across white space, so a text's
    ids are those of its blank-separated chunks in a row.  Texts of Latin-1
    characters, where composing and lower-casing touch single characters only, are
    cut together, as one array of bytes, into letter runs, digits and symbol runs,
    as the vocabulary's pattern cuts them; each different piece is looked up once.
    Whatever that does not cover (contractions, special tokens, control characters,
    other scripts) goes to the tokenizer chunk by chunk.
    """

    #: the vocabulary's pattern over lower-cased Latin-1 without apostrophes and white space:
    #: runs of letters, single digits, runs of anything else
    LETTER = re.compile(r"[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]")
    DIGIT = re.compile(r"[0-9\xb2\xb3\xb9\xbc-\xbe]")
    NOT_PLAIN = re.compile(r"['\x00-\x20\x7f-\xa0\xad]")

    def __init__(self, path: str, cache_size: int = 1_000_000):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.cache_size = cache_size
        self.pieces: dict[bytes, bytes] = {}  # of Latin-1 texts, lower-cased, one byte a character
        self.other: dict[bytes, bytes] = {}  # chunks of other texts, as they are
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size(True) <= 1 << 16 else "<u4")
        fold = self.tokenizer.encode("A a", add_special_tokens=False).ids
        self.model = self.tokenizer.model
        self.table = self._byte_level()
        lower = [chr(i).lower() for i in range(256)]
        self.lower = np.array([ord(c) for c in lower], dtype=np.uint8)
        self.kind = np.array([BLANK if c in " \t\n\r\x0b\x0c" else ODD if self.NOT_PLAIN.search(c) else LETTER if self.LETTER.match(c)
                              else DIGIT if self.DIGIT.match(c) else SYMBOL for c in lower], dtype=np.uint8)
        self.by_chunk = len(fold) == 2 and fold[0] == fold[1]  # lower-cased, white space dropped

    def _byte_level(self) -> dict | None:
        """How Latin-1 characters reach the model (as characters for their UTF-8
        bytes); None if the model alone doesn't give the tokenizer's ids."""
        from tokenizers import pre_tokenizers
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        plain = [chr(i) for i in range(33, 256) if not self.NOT_PLAIN.search(chr(i)) and chr(i) == chr(i).lower()]
        table = {ord(c): level.pre_tokenize_str(c)[0][0] for c in plain}
        samples = plain + [a + b for a in "aeznéß" for b in "aeznéß"] + ["information", "été", "übergröße", "...", "###"]
        for s in samples:
            if [t.id for t in self.model.tokenize(s.translate(table))] != self.tokenizer.encode(s, add_special_tokens=False).ids:
                return None
        return table

    def _encode(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces of the vocabulary's pattern, as raw bytes: the model alone
        is asked, since normalizing and cutting are done."""
        if self.table is None or sys.byteorder != "little":
            return self._whole(pieces)
        run, table = self.model.tokenize, self.table
        code = "H" if self.dtype.itemsize == 2 else "I"
        return [array(code, [t.id for t in run(p.translate(table))]).tobytes() for p in pieces]

    def _whole(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks of any kind, each by the whole tokenizer."""
        got = self.tokenizer.encode_batch(chunks, add_special_tokens=False) if chunks else []
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in got]

    def _learn(self, cache: dict, new: list[bytes]) -> None:
        if len(cache) + len(new) > self.cache_size:
            cache.clear()
        if cache is self.other:
            cache.update(zip(new, self._whole([k.decode("utf-8", "replace") for k in new])))
            return
        odd = [k for k in new if not k.isalpha() and self.NOT_PLAIN.search(k.decode("latin-1"))]  # isalpha: ASCII letters
        if odd:
            cache.update(zip(odd, self._whole([k.decode("latin-1") for k in odd])))
            new = [k for k in new if k not in cache]
        cache.update(zip(new, self._encode([k.decode("latin-1") for k in new])))

    def _pieces(self, texts: list[bytes]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        """Pieces of Latin-1 texts in a row as places in the list of different ones; that list;
        and how many pieces each text has.  White space is a piece too, and a chunk with a
        character that is not plain is one."""
        raw = np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)
        raw, kind = self.lower[raw], self.kind[raw]
        first = np.ones(len(raw), dtype=bool)
        first[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        if (kind == ODD).any():
            blank = kind == BLANK
            chunk = np.flatnonzero(np.diff(blank, prepend=not blank[0]))  # and the blanks between
            odd = np.logical_or.reduceat(kind == ODD, chunk)
            first &= ~np.repeat(odd, np.diff(chunk, append=len(raw)))
            first[chunk] = True
        starts = np.flatnonzero(first)
        offsets = np.append(starts, len(raw)).astype(np.int32)
        found = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(raw)]).dictionary_encode()
        ends = np.cumsum([len(t) + 1 for t in texts])
        return found.indices.to_numpy(), found.dictionary, np.diff(np.searchsorted(starts, ends), prepend=0)

    def _cached(self, cache: dict, at: np.ndarray, parts: pa.Array, size: np.ndarray) -> list[np.ndarray]:
        """Ids of texts of ``size`` parts each, from those of each different part."""
        parts = parts.to_pylist()
        got = list(map(cache.get, parts))
        new = [i for i, v in enumerate(got) if v is None]  # a part without ids is empty
        if new:
            self._learn(cache, [parts[i] for i in new])
            for i in new:
                got[i] = cache[parts[i]]
        ids = np.frombuffer(b"".join(got), dtype=self.dtype)
        many = np.fromiter(map(len, got), dtype=np.int64, count=len(got)) // self.dtype.itemsize
        each = many[at]
        ends = np.cumsum(each)
        # the k-th id of an occurrence is the k-th of its part
        ids = ids[np.repeat((np.cumsum(many) - many)[at] - ends + each, each) + np.arange(each.sum())]
        cuts = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(size)))].tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each UTF-8 text, without an end id."""
        out: list = [None] * len(texts)
        latin, other = [], []
        for i, t in enumerate(texts):
            if not self.by_chunk:
                ids = self.tokenizer.encode(t.decode("utf-8", "replace"), add_special_tokens=False).ids
                out[i] = np.array(ids, dtype=self.dtype)
            elif b"<|" not in t and (one := _latin(t)) is not None:
                latin.append((i, one))
            else:
                other.append((i, t))
        if latin:
            for (i, _), ids in zip(latin, self._cached(self.pieces, *self._pieces([t for _, t in latin]))):
                out[i] = ids
        if other:
            for (i, _), ids in zip(other, self._cached(self.other, *cut_words(pa.array([t for _, t in other], pa.binary()), lower=False))):
                out[i] = ids
        return out


def _latin(t: bytes) -> bytes | None:
    """A UTF-8 text as Latin-1, if it has no other characters."""
    if t.isascii():
        return t
    try:
        return t.decode("utf-8").encode("latin-1")
    except UnicodeError:
        return None


_ENCODERS: dict = {}


def encoder(file: str) -> Encoder:
    """One encoder a Python worker; ``file`` is a path or a name of the public vocabularies."""
    if file not in _ENCODERS:
        path = file
        if os.sep not in file:
            import public_tokenizers
            path = public_tokenizers.path(file)
        _ENCODERS[file] = Encoder(path)
    return _ENCODERS[file]


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 600) -> np.ndarray:
    """Least squares ``a x = b`` with x >= 0, by the active-set method."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], dtype=bool)
    grad = a.T @ b
    tol = 1e-9 * max(1.0, float(np.abs(grad).max(initial=0)))
    for _ in range(rounds):
        open_ = np.where(active, -np.inf, grad)
        j = int(open_.argmax())
        if open_[j] <= tol or active.sum() >= a.shape[0]:
            break
        active[j] = True
        while True:
            at = np.flatnonzero(active)
            z = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if (z > 0).all():
                x[:] = 0
                x[at] = z
                break
            bad = z <= 0
            step = np.min(x[at][bad] / np.maximum(x[at][bad] - z[bad], 1e-300))
            x[at] += step * (z - x[at])
            drop = at[x[at] <= 1e-10]
            if not len(drop):
                drop = at[[int(z.argmin())]]
            active[drop] = False
            x[drop] = 0
        grad = a.T @ (b - a @ x)
    return x


@lru_cache(maxsize=4)
def combinations(bins: int) -> np.ndarray:
    """Columns: every combination of one to three bins whose sizes add up to ``bins``."""
    rows = [(bins,)] + [(a, bins - a) for a in range(1, bins // 2 + 1)]
    rows += [(a, b, bins - a - b) for a in range(1, bins // 3 + 1) for b in range(a, (bins - a) // 2 + 1)]
    m = np.zeros((bins, len(rows)))
    for j, r in enumerate(rows):
        for s in r:
            m[s - 1, j] += 1
    return m


def plan(lengths: np.ndarray, sequence: int = SEQUENCE, bin_size: int = 32) -> tuple[list[list[int]], list[int]]:
    """Sequences of whole items for ``lengths`` (all below ``sequence``) and the items left over.

    Sequences hold indices into ``lengths``; their gaps together are never larger
    than what is left over, so cutting the rest can close every one of them.
    """
    bins = sequence // bin_size
    place = -(-lengths // bin_size)
    hist = np.bincount(place, minlength=bins + 1)[1:].astype(float)
    combos = combinations(bins)
    # short rests are easy to place by cutting: their misfit counts less
    weight = np.sqrt(np.arange(1, bins + 1) / bins)
    usable = (combos[hist == 0].sum(axis=0) == 0) if (hist == 0).any() else np.ones(combos.shape[1], dtype=bool)
    cols = np.flatnonzero(usable)
    free = [list(np.flatnonzero(place == b + 1)) for b in range(bins)]
    out = []
    if len(cols):
        x = nnls(combos[:, cols] * weight[:, None], hist * weight)
        for j in np.argsort(-x, kind="stable"):
            need = combos[:, cols[j]].astype(int)
            used = np.flatnonzero(need)
            n = min([int(x[j] + 1e-6)] + [len(free[b]) // need[b] for b in used])
            for _ in range(n):
                out.append([int(free[b].pop()) for b in used for _ in range(need[b])])
    rest = sorted((int(i) for f in free for i in f), key=lambda i: (lengths[i], i))
    gap = sum(sequence - int(sum(lengths[i] for i in s)) for s in out)
    left = int(sum(lengths[i] for i in rest))
    while out and gap > left:  # too little is left to fill the gaps: free the last sequence
        s = out.pop()
        size = int(sum(lengths[i] for i in s))
        gap, left, rest = gap - (sequence - size), left + size, rest + s
    return out, rest


class Packer:
    """Packs the documents of one partition as they come: (row, ids) in, pieces out.

    A piece is (row, start, length, sequence, offset, ids)."""

    def __init__(self, first_sequence: int, sequence: int = SEQUENCE, window_tokens: int = 8_000_000):
        self.next, self.size, self.window = first_sequence, sequence, window_tokens
        self.rows, self.tokens = [], 0
        self.open = []  # pieces of the open sequence: (row, start, ids)
        self.filled = 0

    def add(self, row, ids: np.ndarray):
        """Pieces that became final with this document."""
        self.rows.append((row, ids))
        self.tokens += len(ids)
        if self.tokens >= self.window:
            yield from self.pack()

    def _new(self) -> int:
        self.next += 1
        return self.next - 1

    def _close(self, size: int):
        """Cut the first ``size`` ids of the open pieces as one sequence."""
        seq, offset, rest = self._new(), 0, []
        for row, start, ids in self.open:
            take = min(len(ids), size - offset)
            if take:
                yield row, start, take, seq, offset, ids[:take]
            if take < len(ids):
                rest.append((row, start + take, ids[take:]))
            offset += take
        self.open, self.filled = rest, self.filled - size

    def pack(self):
        rows, self.rows, self.tokens = self.rows, [], 0
        tails = []
        for row, ids in rows:
            full = len(ids) // self.size * self.size
            for a in range(0, full, self.size):
                yield row, a, self.size, self._new(), 0, ids[a:a + self.size]
            if full < len(ids):
                tails.append((row, full, ids[full:]))
        planned, rest = plan(np.array([len(t[2]) for t in tails], dtype=np.int64), self.size) if tails else ([], [])
        cut = [tails[i] for i in rest][::-1]  # shortest last: the gaps take the short ones
        for members in planned:
            seq, offset = self._new(), 0
            for i in members:
                row, start, ids = tails[i]
                yield row, start, len(ids), seq, offset, ids
                offset += len(ids)
            while offset < self.size and cut:
                row, start, ids = cut.pop()
                take = min(len(ids), self.size - offset)
                yield row, start, take, seq, offset, ids[:take]
                if take < len(ids):
                    cut.append((row, start + take, ids[take:]))
                offset += take
        for piece in reversed(cut):
            self.open.append(piece)
            self.filled += len(piece[2])
            while self.filled >= self.size:
                yield from self._close(self.size)

    def finish(self):
        """The last window, then the open sequence cut at powers of two."""
        yield from self.pack()
        while self.filled:
            yield from self._close(1 << (self.filled.bit_length() - 1))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "word_bpe_49k.json",
         sequence: int = SEQUENCE, end_id: int = END_ID, with_ids: bool = True,
         window_tokens: int = 8_000_000) -> DataFrame:
    """Pieces of all documents: id, place in the document, CRC-32 of the ids (as
    little-endian unsigned 32-bit numbers), sequence and place there; with
    ``with_ids`` also the ids themselves in that form."""
    schema = SCHEMA + (", ids binary" if with_ids else "")

    def run(batches):
        from pyspark import TaskContext
        encode = encoder(tokenizer)
        packer = Packer(TaskContext.get().partitionId() << 32, sequence, window_tokens)
        out: dict[str, list] = defaultdict(list)

        def put(pieces):
            for (doc, total), start, length, seq, offset, ids in pieces:
                raw = ids.astype("<u4").tobytes()
                for k, v in zip(("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"),
                                (doc, start, length, zlib.crc32(raw), total, seq, offset, raw)):
                    out[k].append(v)

        def batch():
            cols = [pa.array(out[k], pa.int64()) for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                                           "sequence_id", "offset")]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                cols, names = cols + [pa.array(out["ids"], pa.binary())], names + ["ids"]
            out.clear()
            return pa.RecordBatch.from_arrays(cols, names=names)

        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1)
            for lo, hi in cut_groups(texts):
                group = [t or b"" for t in texts.slice(lo, hi - lo).to_pylist()]
                for doc, got in zip(ids[lo:hi], encode(group)):
                    full = np.append(got, np.array([end_id], dtype=got.dtype))
                    put(packer.add((doc, len(full)), full))
            if out["doc_id"]:
                yield batch()
        put(packer.finish())
        if out["doc_id"]:
            yield batch()

    one = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("t"))
    return one.mapInArrow(run, schema).withColumnRenamed("doc_id", id_col)
