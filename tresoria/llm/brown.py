"""Brown class-based n-gram scoring.

Words belong to classes.  A word's probability is that of its class after the
class before, times the word's share of its class; a small part of the add-one
unigram is mixed in.  Every word with ``LEAST`` training occurrences or more has a
class from exchange clustering, however large the vocabulary is.  The
``CLASS_WORDS`` most frequent words move, pass after pass, to the class that raises
the likelihood of the class bigrams most, until a pass gains less than ``TOLERANCE``
for each token.  Each other word of ``LEAST`` occurrences is then put by the same
rule into one of the classes found.  Rarer words belong to the class of their form (length and ending),
which is known for any word without a table.

What is learned covers every training document: counts of all words, class
bigrams of all tokens.  Only the words that the tasks know by number are bounded
(``COUNT_WORDS``); classes and counts of all others are Spark tables, joined on the
word.

Scale: texts are cut into words twice, to count words and to write them as
numbers; the passes read numbers.  Tasks count before anything is shuffled, and a
block's counts are added up as a stream, so a task holds one block of words and the
small class matrix.  Rows of the joins hold a word, its places and counts, never
texts; the words of these joins are rarer than the ``COUNT_WORDS`` most frequent,
so no word is a hot key.  Stages that are read twice are written to the shared
folder.

Defined results: a null or blank text is the end token alone; a null id counts
as the empty text for the fold and stays null; repeated rows are scored each;
with no training document every count is zero; an empty table gives no row; other
columns are ignored.  A very long text is one row of numbers, four bytes a word.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tresoria.llm.common import cut_groups, cut_words
from tresoria.session import materialize

CLASSES = 64  # of words with LEAST occurrences
FORMS = 16  # of all other words
EDGE = CLASSES + FORMS  # the class of text ends, and of what stands before a text
SIZE = EDGE + 1
#: words that tasks know by number, and those of them that move pass after pass; the first bounds
#: a task's memory (a pass counts in 648 bytes a word) and no result depends on it
COUNT_WORDS = 262144
CLASS_WORDS = 8192
#: training occurrences of a word from which on it is clustered
LEAST = 10
#: passes go on while one gains this log-likelihood (nats) for each training token
TOLERANCE = 0.005
#: words that a task's counter holds before it is passed on
FLUSH = 400_000
#: texts worked on together: bounds what a task holds
TOGETHER = 200
#: words exchanged in one block; a place in its counts fits 16 bits
BLOCK = 256
CELLS = BLOCK * 2 * SIZE
#: words without a number placed in one group
SETTLED = 1024
#: share of the class model; added count of an unseen class bigram
LAMBDA, ALPHA = 0.95, 0.05


def form(word: bytes) -> int:
    """The form class of a word: four bands of length by four kinds of ending."""
    last = word[-1]
    kind = 0 if last in b"aeiou" else 1 if 97 <= last <= 122 else 2 if last in b".,;:!?" else 3
    return CLASSES + min(3, len(word) // 4) * 4 + kind


def held_out(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 7 == 2


def _train(docs: DataFrame) -> DataFrame:
    return docs.filter(~F.col("held_out"))


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) over all training texts."""
    def run(batches):
        def batch(c):
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.binary()), pa.array(list(c.values()), pa.int64())],
                                              names=["word", "n"])
        c = Counter()
        for b in batches:
            for lo, hi in cut_groups(b.column(0)):
                at, words, _ = cut_words(b.column(0).slice(lo, hi - lo))
                c.update(dict(zip(words.to_pylist(), np.bincount(at, minlength=len(words)).tolist())))
                if len(c) > FLUSH:
                    yield batch(c)
                    c = Counter()
        if c:
            yield batch(c)

    return _train(docs).select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


NUMBERED = "row long, id long, held_out boolean, ids binary, rare array<binary>"


def numbered(docs: DataFrame, words: list[bytes]) -> DataFrame:
    """Each text as compressed 32-bit numbers.  A word of ``words`` is its place there, the end is
    ``len(words)``; the k-th other word of a text, which ``rare`` spells, is
    -1 - (k * FORMS + its form)."""
    sent = docs.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(words)})
    end = len(words)

    def run(batches):
        from pyspark import TaskContext
        get, pack = sent.value.get, zstandard.ZstdCompressor(level=1).compress
        row = TaskContext.get().partitionId() << 33
        for b in batches:
            for lo, hi in cut_groups(b.column(2)):
                part = b.slice(lo, hi - lo)
                at, words, size = cut_words(part.column(2))
                spelled = words.to_pylist()
                number = np.array([get(w, -1) for w in spelled], dtype=np.int64)
                forms = np.array([form(w) - CLASSES if i < 0 else 0 for w, i in zip(spelled, number.tolist())], dtype=np.int64)
                one, text = number[at], np.repeat(np.arange(len(size)), size)
                rare = np.flatnonzero(one < 0)
                _, first, same = np.unique(text[rare] * len(words) + at[rare], return_index=True, return_inverse=True)
                order = np.argsort(first)  # a text's other words by where they first stand
                rank = np.empty_like(order)
                rank[order] = np.arange(len(order))
                new = rare[first[order]]
                many = np.bincount(text[new], minlength=len(size))
                ends = np.cumsum(many)
                one[rare] = -1 - ((rank[same] - (ends - many)[text[rare]]) * FORMS + forms[at[rare]])
                raw = np.insert(one, np.cumsum(size), end).astype("<i4").tobytes()
                cuts = (np.concatenate(([0], np.cumsum(size + 1))) * 4).tolist()
                ids = [pack(raw[a:z]) for a, z in zip(cuts, cuts[1:])]
                spell = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), words.take(pa.array(at[new])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + part.num_rows)), part.column(0), part.column(1), pa.array(ids, pa.binary()), spell],
                    names=["row", "id", "held_out", "ids", "rare"])
                row += part.num_rows

    return docs.select("id", "held_out", "text").mapInArrow(run, NUMBERED)


def _numbers(column) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all texts of a column in a row, and where each text begins."""
    unpack = zstandard.ZstdDecompressor().decompress
    one = [unpack(x) for x in column.to_pylist()]
    starts = np.cumsum([0] + [len(x) // 4 for x in one])[:-1]
    return np.frombuffer(b"".join(one), dtype="<i4").astype(np.int64), starts


def _rare_at(ids: np.ndarray, starts: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a word without a number stands, and its place in the joined ``rare`` lists,
    of which a text's begins at ``first``."""
    at = np.flatnonzero(ids < 0)
    return at, first[np.searchsorted(starts, at, "right") - 1] + (-1 - ids[at]) // FORMS


def _classes(ids: np.ndarray, of_index: np.ndarray) -> np.ndarray:
    """Classes by number, by form where there is none."""
    cls, rare = of_index.take(ids, mode="clip"), np.flatnonzero(ids < 0)
    cls[rare] = CLASSES + (-1 - ids[rare]) % FORMS
    return cls


def _before(cls: np.ndarray) -> np.ndarray:
    """The class before each token: texts end in EDGE, so one stands before each of them."""
    return np.concatenate(([EDGE], cls[:-1]))


def _pair_rows(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(pairs)
    return at, pairs[at]


def _matrix(rows: DataFrame) -> np.ndarray:
    """Class bigrams from (cell, n): at most SIZE * SIZE rows reach the driver."""
    out = np.zeros(SIZE * SIZE)
    for r in rows.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[r["cell"]] = r["n"]
    return out.reshape(SIZE, SIZE)


def _pass(texts: DataFrame, of_index: np.ndarray, movers: int) -> DataFrame:
    """(block, cell, n, data).  Block -1: class bigrams, ``cell`` before * SIZE + after.
    Other blocks: compressed counts of neighbours of BLOCK words, ``cell`` of them; for
    the block's word w and class c, place (w * 2) * SIZE + c counts c before w, place
    (w * 2 + 1) * SIZE + c counts c after w."""
    sent = texts.sparkSession.sparkContext.broadcast(of_index)

    def run(batches):
        of_index = sent.value
        cells = np.zeros(-(-movers // BLOCK) * CELLS, dtype=np.int32)
        pairs = np.zeros(SIZE * SIZE, dtype=np.int64)
        for b in batches:
            for lo in range(0, b.num_rows, TOGETHER):
                ids, _ = _numbers(b.column(0).slice(lo, TOGETHER))
                cls = _classes(ids, of_index)
                before = _before(cls)
                pairs += np.bincount(before * SIZE + cls, minlength=SIZE * SIZE)
                at = np.flatnonzero((ids >= 0) & (ids < movers))
                w = ids[at] * (2 * SIZE)
                np.add.at(cells, np.concatenate((w + before[at], w + SIZE + cls[at + 1])), 1)
        at, n = _pair_rows(pairs)
        out = [(-1, int(c), int(k), None) for c, k in zip(at, n)]
        for block in range(len(cells) // CELLS):
            at, n = _pair_rows(cells[block * CELLS:(block + 1) * CELLS])
            if len(at):
                raw = np.diff(at, prepend=0).astype("<u2").tobytes() + n.astype("<u4").tobytes()
                out.append((block, len(at), 0, pa.compress(raw, "zstd", asbytes=True)))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], ty) for i, ty in enumerate(types)],
                                         names=["block", "cell", "n", "data"])

    return _train(texts).select("ids").mapInArrow(run, "block long, cell long, n long, data binary")


def _xlogx(x):
    x = np.maximum(x, 1e-300)
    return x * np.log(x)


def likelihood(bigrams: np.ndarray) -> float:
    """Log-likelihood (nats) of the class bigrams, up to the words' own part, which classes don't change."""
    return float(_xlogx(bigrams).sum() - _xlogx(bigrams.sum(axis=1)).sum() - _xlogx(bigrams.sum(axis=0)).sum())


def exchange(left: np.ndarray, right: np.ndarray, own: np.ndarray, bigrams: np.ndarray) -> np.ndarray:
    """New classes of words with counts ``left`` (class before) and ``right`` (class
    after), now in classes ``own``: one word after the other moves to the class
    with the greatest likelihood of the class bigrams, if that is above its own."""
    n, own = bigrams.astype(float), own.copy()
    logs, by_row, by_col = _xlogx(n), n.sum(axis=1), n.sum(axis=0)

    def add(a, after, r, before, l, sign):
        n[before, a] += sign * l
        n[a, after] += sign * r
        by_row[before] += sign * l
        by_row[a] += sign * r.sum()
        by_col[after] += sign * r
        by_col[a] += sign * l.sum()
        logs[before, a] = _xlogx(n[before, a])
        logs[a, after] = _xlogx(n[a, after])

    for w in range(len(own)):
        after, before = np.flatnonzero(right[w]), np.flatnonzero(left[w])  # no other cell changes
        if not len(after) and not len(before):
            continue
        r, l, a = right[w, after], left[w, before], own[w]
        add(a, after, r, before, l, -1)
        gain = ((_xlogx(n[:CLASSES, after] + r) - logs[:CLASSES, after]).sum(axis=1)
                + (_xlogx(n[before, :CLASSES] + l[:, None]) - logs[before, :CLASSES]).sum(axis=0))
        rows, cols = by_row[:CLASSES], by_col[:CLASSES]
        gain -= _xlogx(rows + r.sum()) - _xlogx(rows) + _xlogx(cols + l.sum()) - _xlogx(cols)
        best = int(gain.argmax())
        if gain[best] > gain[a] + 1e-9:
            a = best
        add(a, after, r, before, l, 1)
        own[w] = a
    return own


def place(left: np.ndarray, right: np.ndarray, bigrams: np.ndarray) -> np.ndarray:
    """Classes of words that are in none yet: the one in which a word's counts raise the
    likelihood of the class bigrams most.  Each word by itself, so the order doesn't matter."""
    out = np.zeros(len(left), dtype=np.int64)
    for lo in range(0, len(out), 128):
        l, r = left[lo:lo + 128], right[lo:lo + 128]
        gain = np.zeros((len(l), CLASSES))
        for side, by_cell in ((r, bigrams[:CLASSES].T), (l, bigrams[:, :CLASSES])):
            w, cell = np.nonzero(side)
            had, got = by_cell[cell], side[w, cell][:, None]
            more = _xlogx(had + got) - _xlogx(had)
            if len(w):
                first = np.flatnonzero(np.diff(w, prepend=-1))
                gain[w[first]] += np.add.reduceat(more, first, axis=0)
            total = by_cell.sum(axis=0) if side is l else bigrams[:CLASSES].sum(axis=1)
            gain -= _xlogx(total + side.sum(axis=1)[:, None]) - _xlogx(total)
        out[lo:lo + 128] = gain.argmax(axis=1)
    return out


def _sides(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    table = counts.reshape(-1, 2, SIZE)
    return table[:, 0], table[:, 1]


def _block_counts(batches) -> tuple[int, np.ndarray]:
    counts, block = np.zeros(CELLS), 0
    for b in batches:
        for block, size, data in zip(*(b.column(i).to_pylist() for i in range(3))):
            raw = pa.decompress(data, decompressed_size=size * 6, codec="zstd", asbytes=True)
            at = np.cumsum(np.frombuffer(raw, "<u2", size).astype(np.int64))
            counts[at] += np.frombuffer(raw, "<u4", size, size * 2)
    return block, counts


def _decided(seen: DataFrame, first: int, classes: np.ndarray, bigrams: np.ndarray, movers: int) -> np.ndarray:
    """Classes after a pass of the words from ``first`` on: the first ``movers`` by
    exchange, the others placed."""
    sent = seen.sparkSession.sparkContext.broadcast((bigrams, classes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, classes = sent.value
        block, counts = _block_counts(batches)
        lo = block * BLOCK
        own = classes[lo:lo + BLOCK]
        left, right = (side[:len(own)] for side in _sides(counts))
        new = exchange(left, right, own, n) if first < movers else place(left, right, n)
        keep = np.arange(lo, lo + len(own))
        yield pa.RecordBatch.from_arrays([pa.array(keep[keep >= first]), pa.array(new[keep >= first])], names=["w", "c"])

    blocks = seen.filter(F.col("block") >= first // BLOCK).select("block", "cell", "data")
    out = classes.copy()
    new = blocks.groupBy("block").applyInArrow(run, "w long, c long").toArrow()  # as many as ``classes`` at most
    out[new["w"].to_numpy()] = new["c"].to_numpy()
    return out


def cluster(texts: DataFrame, of_index: np.ndarray, movers: int, tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray, list]:
    """Classes of the first ``movers`` numbers by passes of exchange over all training
    texts; with them the class bigrams, and the likelihood for each token after each pass."""
    of_index, history, kept = of_index.copy(), [], None
    of_index[:movers] = np.arange(movers) % CLASSES
    while True:
        seen = materialize(_pass(texts, of_index, movers), "brown-pass")
        n = _matrix(seen.filter("block = -1"))
        each = likelihood(n) / max(1.0, n.sum())
        if kept is not None and each <= history[-1]:
            return *kept, history
        history.append(each)
        kept = of_index.copy(), n
        if not movers or len(history) > 1 and each - history[-2] < tolerance:
            return *kept, history
        of_index[:movers] = _decided(seen, 0, of_index[:movers], n, movers)


def _other_words(texts: DataFrame, of_index: np.ndarray) -> DataFrame:
    """(word, places): the pairs of classes around training occurrences of a word without
    a number, as 16-bit before * SIZE + after, a row for each few texts."""
    sent = texts.sparkSession.sparkContext.broadcast(of_index)

    def run(batches):
        of_index = sent.value
        for b in batches:
            for lo in range(0, b.num_rows, TOGETHER):
                part = b.slice(lo, TOGETHER)
                ids, starts = _numbers(part.column(0))
                size = pc.list_value_length(part.column(1)).to_numpy().astype(np.int64)
                at, which = _rare_at(ids, starts, np.cumsum(size) - size)
                spelled = part.column(1).flatten().dictionary_encode()  # words that several of the texts hold are one row
                one, same = spelled.indices.to_numpy().astype(np.int64), spelled.dictionary
                cls = _classes(ids, of_index)
                around = (_before(cls) * SIZE + np.append(cls[1:], EDGE))[at]
                own = one[which] if len(at) else at
                packed = around[np.argsort(own, kind="stable")].astype("<u2").tobytes()
                ends = np.concatenate(([0], np.cumsum(np.bincount(own, minlength=len(same)) * 2))).astype(np.int32)
                places = pa.Array.from_buffers(pa.binary(), len(same), [None, pa.py_buffer(ends), pa.py_buffer(packed)])
                yield pa.RecordBatch.from_arrays([same, places], names=["word", "places"])

    return _train(texts).select("ids", "rare").mapInArrow(run, "word binary, places binary")


def _settle(others: DataFrame, bigrams: np.ndarray, words: int, least: int) -> DataFrame:
    """(word, n, c) of the about ``words`` words of ``others``: training count and class,
    -1 for words of fewer than ``least`` occurrences, in groups of words by hash."""
    sent = others.sparkSession.sparkContext.broadcast(bigrams)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_word: dict[bytes, int] = {}
        counts = np.zeros((SETTLED, 2, SIZE))
        for b in batches:
            words = b.column(0).dictionary_encode()
            own = np.array([at_word.setdefault(w, len(at_word)) for w in words.dictionary.to_pylist()], dtype=np.int64)
            while len(at_word) > len(counts):  # groups by hash are a little uneven
                counts = np.concatenate((counts, np.zeros_like(counts)))
            at = np.repeat(own[words.indices.to_numpy()] * (2 * SIZE), pc.binary_length(b.column(1)).to_numpy() // 2)
            around = np.frombuffer(b"".join(b.column(1).to_pylist()), "<u2").astype(np.int64)
            np.add.at(counts.reshape(-1), np.concatenate((at + around // SIZE, at + SIZE + around % SIZE)), 1)
        counts = counts[:len(at_word)]
        n = counts[:, 0].sum(axis=1).astype(np.int64)
        often, cls = np.flatnonzero(n >= least), np.full(len(n), -1, dtype=np.int64)
        cls[often] = place(counts[often, 0], counts[often, 1], sent.value)
        yield pa.RecordBatch.from_arrays([pa.array(list(at_word), pa.binary()), pa.array(n), pa.array(cls)], names=["word", "n", "c"])

    group = F.pmod(F.xxhash64("word"), F.lit(-(-max(1, words) // SETTLED)))
    return others.select("word", "places", group.alias("block")).groupBy("block").applyInArrow(run, "word binary, n long, c long")


def class_bigrams(texts: DataFrame, of_index: np.ndarray) -> np.ndarray:
    """Counts of neighbouring classes over all training texts, text ends included."""
    sent = texts.sparkSession.sparkContext.broadcast(of_index)

    def run(batches):
        total = np.zeros(SIZE * SIZE, dtype=np.int64)
        for _, _, cls, _ in _known(batches, sent.value):
            total += np.bincount(_before(cls) * SIZE + cls, minlength=SIZE * SIZE)
        at, n = _pair_rows(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n)], names=["cell", "n"])

    return _matrix(_train(texts).select(*KNOWN).mapInArrow(run, "cell long, n long"))


KNOWN = ("id", "held_out", "ids", "rare_n", "rare_c")


def _known(batches, of_index: np.ndarray, of_count: np.ndarray | None = None):
    """(rows, where texts begin, classes, counts) of a few texts at a time, in a row."""
    for b in batches:
        for lo in range(0, b.num_rows, TOGETHER):
            part = b.slice(lo, TOGETHER)
            ids, starts = _numbers(part.column(2))
            size = pc.fill_null(pc.list_value_length(part.column(3)), 0).to_numpy().astype(np.int64)
            at, which = _rare_at(ids, starts, np.cumsum(size) - size)
            cls = _classes(ids, of_index)
            c = part.column(4).flatten().to_numpy(zero_copy_only=False).astype(np.int64)[which]
            cls[at] = np.where(c >= 0, c, cls[at])
            count = None
            if of_count is not None:
                count = of_count[np.maximum(ids, 0)]
                count[at] = part.column(3).flatten().to_numpy(zero_copy_only=False)[which]
            yield part, starts, cls, count


class Model:
    """Class-transition and word-emission probabilities.  ``more`` counts the tokens of
    clustered words, by class, that are not in ``table``."""

    def __init__(self, table: dict[bytes, int], counts: dict[bytes, int], bigrams: np.ndarray, form_words: dict,
                 n_tokens: int, n_types: int, more: dict[int, int] | None = None):
        self.n, self.v = n_tokens, n_types
        smooth = bigrams + ALPHA
        self.step = smooth / smooth.sum(axis=1, keepdims=True)
        size = np.zeros(SIZE)
        for w, c in table.items():
            size[c] += counts.get(w, 0)
        for c, n in (more or {}).items():
            size[c] += n
        self.unseen = np.zeros(SIZE)
        for f, (n, once) in form_words.items():
            size[f] = n
            # Good-Turing: words seen once stand for those not seen
            self.unseen[f] = once / n if n and once < n else 0.5
        for f in range(CLASSES, EDGE):
            if size[f] == 0:
                self.unseen[f] = 1.0
        self.size = size
        self.floor = self.n + self.v + 1.0

    def base(self, count):
        return np.log10((count + 1.0) / self.floor)

    def probability(self, before: np.ndarray, cls: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Of tokens with class ``cls`` and training count ``count`` after class ``before``."""
        size = np.maximum(self.size[cls], 1.0)
        share = np.where(count > 0, (1 - self.unseen[cls]) * count / size, self.unseen[cls])
        share = np.where(cls == EDGE, 1.0, share)
        return LAMBDA * self.step[before, cls] * share + (1 - LAMBDA) * (count + 1.0) / self.floor


SCORES = "id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _score_rows(texts: DataFrame, model: Model, of_index: np.ndarray, of_count: np.ndarray) -> DataFrame:
    sent = texts.sparkSession.sparkContext.broadcast((model, of_index, of_count))

    def run(batches):
        m, of_index, of_count = sent.value
        for part, starts, cls, count in _known(batches, of_index, of_count):
            p = np.log10(m.probability(_before(cls), cls, count))
            tokens = np.diff(np.append(starts, len(cls)))
            sums = [np.add.reduceat(x, starts) for x in ((count > 0).astype(np.int64), m.base(count), p)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(tokens), *map(pa.array, sums)],
                                             names=["id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return texts.select(*KNOWN).mapInArrow(run, SCORES)


def _form_counts(counts: DataFrame, least: int) -> dict[int, tuple[int, int]]:
    """form: (tokens, words seen once) over the words of fewer than ``least`` occurrences."""
    def run(batches):
        all_, once = np.zeros(SIZE, dtype=np.int64), np.zeros(SIZE, dtype=np.int64)
        for b in batches:
            f = np.array([form(w) for w in b.column(0).to_pylist()], dtype=np.int64)
            n = b.column(1).to_numpy()
            np.add.at(all_, f, n)
            np.add.at(once, f, n == 1)
        at = np.flatnonzero(all_)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(all_[at]), pa.array(once[at])], names=["f", "n", "once"])

    rows = counts.filter(F.col("n") < least).select("word", "n").mapInArrow(run, "f long, n long, once long").groupBy("f").agg(
        F.sum("n").alias("n"), F.sum("once").alias("once")).collect()
    return {r["f"]: (r["n"], r["once"]) for r in rows}


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tolerance: float = TOLERANCE,
          class_words: int = CLASS_WORDS, count_words_kept: int = COUNT_WORDS, least: int = LEAST) -> DataFrame:
    """Id, held_out, n_tokens, n_known, train_tokens, base_score, score (both log10)
    and perplexity of each row, learned from the rows that are not held out."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), held_out(id_col).alias("held_out"),
                       F.col(text_col).cast("string").cast("binary").alias("text"))
    counts = materialize(count_words(docs), "brown-counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    ends = _train(docs).count()
    n_tokens, n_types = total["n"] + ends, total["v"] + (ends > 0)
    top = frequent_words(counts, count_words_kept)
    words = [w for w, _ in top]
    often = sum(n >= least for _, n in top)
    movers = min(often, class_words)
    texts = materialize(numbered(docs, words), "brown-texts")

    by_form = np.array([*(form(w) for w in words), EDGE], dtype=np.int64)
    found, bigrams, _ = cluster(texts, by_form, movers, tolerance)
    of_index = found.copy()
    if often > movers:
        seen = materialize(_pass(texts, found, often), "brown-pass")
        of_index[movers:often] = _decided(seen, movers, found[:often], bigrams, movers)[movers:]
    others = materialize(_settle(_other_words(texts, found), bigrams, total["v"] - len(words), least), "brown-others")

    # the other words of a text, in its order: their counts and classes
    known = texts.select("row", F.posexplode("rare").alias("k", "word")).join(others, "word", "left")
    known = known.select("row", F.struct("k", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("c", F.lit(-1)).cast("int").alias("c")).alias("x"))
    known = known.groupBy("row").agg(F.sort_array(F.collect_list("x")).alias("x"))
    texts = materialize(texts.drop("rare").join(known.select("row", F.col("x.n").alias("rare_n"), F.col("x.c").alias("rare_c")),
                                                "row", "left"), "brown-known")
    table = {w: int(c) for w, c in zip(words[:often], of_index)}
    more = {r["c"]: r["n"] for r in others.filter("c >= 0").groupBy("c").agg(F.sum("n").alias("n")).collect()}
    model = Model(table, dict(top), class_bigrams(texts, of_index), _form_counts(counts, least), n_tokens, n_types, more)
    out = _score_rows(texts, model, of_index, np.array([*(n for _, n in top), ends], dtype=np.int64))
    return out.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(n_tokens).cast("long").alias("train_tokens"),
                      "base_score", "score", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))


#: slices by hash of the words of one band of counts
SLICES = 4096


def frequent_words(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """Nearly ``most`` words (all, where there are no more), most frequent first.

    The bound comes from a histogram of counts, of a few hundred bands whatever the corpus, so only those words ever
    reach the driver.  Of the band that would pass ``most`` as many words are taken as fit, by slices of their hash: where
    many words are equally frequent, the choice among them is arbitrary but the same in each run."""
    band = F.floor(F.log2(F.col("n").cast("double")) * 16)
    bands = counts.groupBy(band.alias("b")).agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("b")).collect()
    taken, keep = 0, F.lit(False)
    for r in bands:
        if taken + r["words"] > most:
            part = F.pmod(F.xxhash64("word"), F.lit(SLICES))
            slices = counts.filter(band == r["b"]).groupBy(part.alias("s")).agg(F.count(F.lit(1)).alias("words")).orderBy("s").collect()
            for x in slices:
                taken += x["words"]
                if taken > most:
                    keep = keep | (band == r["b"]) & (part < x["s"])
                    break
            break
        taken += r["words"]
        keep = F.lit(True) if r is bands[-1] else band >= r["b"]
    rows = counts.filter(keep).select("word", "n").toArrow()
    return sorted(zip(rows["word"].to_pylist(), rows["n"].to_pylist()), key=lambda x: (-x[1], x[0]))
