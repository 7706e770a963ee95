"""Source divergence audit: how far the term shares of a language's sources lie apart.

Every (lang, source) group gives each kept term of its language a smoothed share p in billionths, and a pair of
groups diverges by the sum of f(p, q) = floor((p - q)^2 / q) over all kept terms.  Most terms are
absent from most groups, so the sums are Gustavson's row accumulation of a sparse matrix product: the
term-major index lists for each term the groups that have it; a group goes through its own terms, scatters
through the index into a dense accumulator over its peers, and no posting pair is ever emitted.  An absent term
is no zero here: its share is the group's baseline share.  With p0 and q0 the baselines of group and peer,

    sum of f(p, q) over all V terms =
        sum of f(p, q0) over the group's terms  +  sum of f(p0, q) over the peer's terms
        +  (V - terms of the group - terms of the peer) * f(p0, q0)
        +  sum of f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0) over the terms of both

and only the last line, the correction, needs the index.  The first two need a group's distinct counts
and its peers' baselines.

Scale: tasks count terms of their rows by group before anything is shuffled; one shuffle by (lang, term) gives the
counts, the number of documents with the term, and the language's count.  The index is cut into blocks of
terms: a task holds one block (about ``BLOCK`` postings), accumulates every group's row in it and passes on one number
for each pair of groups that meet there.  A term has one posting for each source at most, whatever share of the
documents that source has.  The baselines of all groups are sent to every task: the result has a row for each pair of
groups of a language, so that list is the square root of the result.

All arithmetic is in integers, in decimals where a product may pass a long.  A sum of f(p, q) over terms is at most
(UNIT + 1) * (UNIT + V), which fits a long for vocabularies of up to eight thousand million terms.

Defined results: null text, lang and source are ''; a text without a term still makes its group occur; a language
without kept terms has pairs of value 0 and no term rows; one source alone has no pair; equal values rank by item in
UTF-8 order; repeated rows count each; an empty table gives no row; a very long text is counted whole in one
task; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tresoria.session import materialize

#: documents of a language that hold a kept term at least
LEAST_DOCS = 3
UNIT = 1_000_000_000
TOP = 200
#: distinct terms that a task's counters hold before they are passed on
FLUSH = 400_000
#: postings of an index block, about
BLOCK = 250_000
#: index entries scattered at a time: bounds memory inside a block
SCATTER = 1 << 19
#: bytes that belong to terms, A-Z lower-cased; all others separate them
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Runs of letters and of code points beyond ASCII, A-Z lower-cased."""
    return text.translate(_TERM_BYTES).split()


def _documents(docs: DataFrame, text_col: str) -> DataFrame:
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return docs.select(named("lang"), named("source"), F.col(text_col).cast("string").cast("binary").alias("text"))


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) as counted by the tasks: a term may have several rows."""
    def run(batches):
        counts = defaultdict(lambda: (Counter(), Counter()))
        held = 0

        def batch():
            keys = [k for k, (n, _) in counts.items() for _ in n]
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                 pa.array([t.decode() for n, _ in counts.values() for t in n], pa.string()),
                 pa.array([c for n, _ in counts.values() for c in n.values()], pa.int64()),
                 pa.array([d[t] for n, d in counts.values() for t in n], pa.int64())],
                names=["lang", "source", "term", "n", "docs"])

        for b in batches:
            for lang, source, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                terms = terms_of(text) if text else ()
                if not terms:
                    continue
                n, d = counts[lang, source]
                held -= len(n)
                n.update(terms)
                d.update(set(terms))
                held += len(n)
                if held > FLUSH:
                    yield batch()
                    counts.clear()
                    held = 0
        if held:
            yield batch()

    return docs.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def kept_terms(docs: DataFrame, least_docs: int) -> DataFrame:
    """(lang, source, term, n, all, first): the counts of kept terms, the language's count, and whether the row
    is the first of its term.  The counts are dealt out by (lang, term) once, for the sums and the window."""
    of_term = Window.partitionBy("lang", "term")
    return term_counts(docs).repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")).select(
            "lang", "source", "term", "n", F.sum("n").over(of_term).alias("all"),
            (F.min("source").over(of_term) == F.col("source")).alias("first"),
            F.sum("docs").over(of_term).alias("docs")).filter(F.col("docs") >= least_docs).drop("docs")


def share(count: str, total: str) -> Column:
    """1 + floor(UNIT * (count + 1) / total)."""
    return F.expr(f"1 + (cast({UNIT} as decimal(10,0)) * cast({count} + 1 as decimal(19,0))) div cast({total} as decimal(19,0))")


def divergence(p, q):
    """floor((p - q)^2 / q): p and q are at most UNIT + 1, so the square fits a long."""
    return (p - q) ** 2 // q


def group_table(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, total, terms, vocabulary, lang_total, zero) of every occurring group; ``zero`` is the share of an
    absent term, null where the language keeps no term."""
    groups = docs.select("lang", "source").distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("terms"))
    langs = kept.filter("first").groupBy("lang").agg(F.count(F.lit(1)).alias("vocabulary"), F.sum("all").alias("lang_total"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    out = groups.join(own, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", *map(zero, ("total", "terms", "vocabulary", "lang_total")))
    return out.withColumn("zero", F.when(F.col("vocabulary") > 0, share("0", "(total + vocabulary)")))


def accumulate(table: pa.Table) -> pa.Table:
    """The corrections of one block of the index: for each group and each peer that shares a term with it there."""
    codes = {c: table.column(c).combine_chunks().dictionary_encode() for c in ("term", "source")}
    term, group = (codes[c].indices.to_numpy() for c in ("term", "source"))
    names = codes["source"].dictionary.to_pylist()
    p, zero_of = table.column("p").to_numpy(), np.zeros(len(names), dtype=np.int64)
    zero_of[group] = table.column("zero").to_numpy()
    # term-major index: postings of term t are start[t]:start[t + 1]
    by_term = np.argsort(term, kind="stable")
    peer, share_of = group[by_term], p[by_term]
    start = np.searchsorted(term[by_term], np.arange(len(codes["term"].dictionary) + 1))
    by_group = np.argsort(group, kind="stable")
    rows = np.searchsorted(group[by_group], np.arange(len(names) + 1))
    out: list[list] = [[], [], []]
    for g in range(len(names)):
        acc, met = np.zeros(len(names), dtype=np.int64), np.zeros(len(names), dtype=bool)  # dense, over all peers
        own = by_group[rows[g]:rows[g + 1]]
        ends = np.cumsum(start[term[own] + 1] - start[term[own]])
        lo = 0
        while lo < len(own):
            done = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, done + SCATTER, side="right")))
            here = own[lo:hi]
            lens = start[term[here] + 1] - start[term[here]]
            at = np.repeat(start[term[here]] - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum())
            mine, q, s, p0 = np.repeat(p[here], lens), share_of[at], peer[at], zero_of[g]
            np.add.at(acc, s, divergence(mine, q) - divergence(mine, zero_of[s]) - divergence(p0, q) + divergence(p0, zero_of[s]))
            met[s] = True
            lo = hi
        met[g] = False
        to = np.flatnonzero(met)
        out[0] += [names[g]] * len(to)
        out[1] += [names[s] for s in to]
        out[2].append(acc[to])
    lang = table.column("lang")[0].as_py()
    return pa.table({"lang": pa.array([lang] * len(out[0]), pa.string()), "source": pa.array(out[0], pa.string()),
                     "peer": pa.array(out[1], pa.string()), "value": pa.array(np.concatenate(out[2]), pa.int64())})


PAIR = "lang string, source string, peer string, value long"


def baselines(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """The parts of every pair that need no index: rows of (lang, source, peer, value) to add up.  ``counts``: how many terms
    of a group have a share, (lang, source, p, terms)."""
    spark = groups.sparkSession
    rows = groups.select("lang", "source", "terms", "vocabulary", "zero").orderBy("lang", "source").collect()  # one for each group
    by_lang = defaultdict(list)
    for r in rows:
        by_lang[r["lang"]].append(r)
    sent = spark.sparkContext.broadcast({lang: (
        [r["source"] for r in rs], rs[0]["vocabulary"], np.array([r["terms"] for r in rs], dtype=np.int64),
        np.array([r["zero"] or 1 for r in rs], dtype=np.int64)) for lang, rs in by_lang.items()})

    def run(batches):
        langs = sent.value

        def passed(key, own, theirs):
            lang, source = key
            names, vocabulary, terms, zero = langs[lang]
            g = names.index(source)
            absent = (vocabulary - terms[g] - terms) * divergence(zero[g], zero)
            at = [s for s in range(len(names)) if s != g]
            n = len(at)
            # as the group of these peers, and as the peer of these groups
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * 2 * n, pa.string()), pa.array([source] * n + [names[s] for s in at], pa.string()),
                 pa.array([names[s] for s in at] + [source] * n, pa.string()),
                 pa.array(np.concatenate(((own + absent)[at], theirs[at])), pa.int64())],
                names=["lang", "source", "peer", "value"])

        key = None
        for b in batches:
            for lang, source, p, n in zip(*(b.column(i).to_pylist() for i in range(4))):
                if key != (lang, source):
                    if key is not None:
                        yield from passed(key, own, theirs)
                    key, zero = (lang, source), langs[lang][3]
                    mine = zero[langs[lang][0].index(source)]
                    own, theirs = np.zeros(len(zero), dtype=np.int64), np.zeros(len(zero), dtype=np.int64)
                if p is not None:
                    own += divergence(p, zero) * n
                    theirs += divergence(zero, p) * n
        if key is not None:
            yield from passed(key, own, theirs)

    every = groups.select("lang", "source").join(counts, ["lang", "source"], "left")
    return every.select("lang", "source", "p", F.col("terms").cast("long")).repartition("lang", "source").sortWithinPartitions(
        "lang", "source").mapInArrow(run, PAIR)


def audit(docs: DataFrame, text_col: str = "text", least_docs: int = LEAST_DOCS, top: int = TOP, block: int = BLOCK) -> DataFrame:
    """lang, source, part, item, value and rank: part ``pair`` has every other source of the language by its divergence from the
    group, part ``term`` the ``top`` terms that the group uses more than its language does."""
    docs = _documents(docs, text_col)
    kept = materialize(kept_terms(docs, least_docs), "divergence-terms")
    groups = materialize(group_table(docs, kept), "divergence-groups")
    postings = kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "zero", share("n", "(total + vocabulary)").alias("p"),
        share("all", "(lang_total + vocabulary)").alias("q"))

    over = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    f = lambda p, q: F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")
    terms = postings.filter("p > q").select("lang", "source", F.col("term").alias("item"), f("p", "q").alias("value")).withColumn(
        "rank", F.row_number().over(over)).filter(F.col("rank") <= top)

    blocks = max(1, math.ceil(kept.count() / block))
    met = postings.select("lang", "source", "term", "zero", "p", F.pmod(F.xxhash64("term"), F.lit(blocks)).alias("block")).groupBy(
        "lang", "block").applyInArrow(lambda t: accumulate(t), PAIR)
    counts = postings.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("terms"))
    pairs = met.unionByName(baselines(counts, groups)).groupBy("lang", "source", "peer").agg(
        F.sum(F.col("value").cast("decimal(38,0)")).cast("long").alias("value"))
    pairs = pairs.select("lang", "source", F.col("peer").alias("item"), "value").withColumn("rank", F.row_number().over(over))
    columns = lambda part: ["lang", "source", F.lit(part).alias("part"), "item", "value", "rank"]
    return pairs.select(*columns("pair")).unionByName(terms.select(*columns("term")))


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (SELECT row, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
k AS MATERIALIZED (SELECT lang, term, count(*)::HUGEINT AS n FROM t GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM k GROUP BY lang),
c AS MATERIALIZED (SELECT lang, source, term, count(*)::HUGEINT AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
g AS MATERIALIZED (SELECT lang, source, coalesce(v.v, 0) AS v, coalesce(s.n, 0) AS n, coalesce(v.n, 0) AS lang_n
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN v USING (lang)
  LEFT JOIN (SELECT lang, source, sum(n)::HUGEINT AS n FROM c GROUP BY ALL) s USING (lang, source)),
p AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 1)) // (g.n + g.v) AS p,
    1 + (1000000000 * (k.n + 1)) // (g.lang_n + g.v) AS q
  FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS peer, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS f
    FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) m
  ON m.lang = a.lang AND m.source = a.source AND m.peer = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM (SELECT * FROM pair UNION ALL SELECT * FROM term) QUALIFY part = 'pair' OR rank <= 200
"""
