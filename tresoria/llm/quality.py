"""Line-first cleaning (DataFrame functions only).

Every line is judged by punctuation, navigation and boilerplate rules; failing
lines are removed, and a document that loses too much of its text is rejected.
Word statistics of the whole text decide first: too few words or too many words
inside repeated windows reject a document whatever its lines say.

Defined results: a null or empty text has no words and fails the base rules; a
null id stays null; repeated rows are judged alike, each by itself; extra
columns of any name are ignored by :func:`judge` and kept by :func:`clean`.
Work is one projection of the scan: no shuffle, nothing gathered per key.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tresoria.llm.common import BLANK, NOT_BLANK, settled, text_or_empty, words_of

WINDOW = 8
#: Phrases of page furniture, looked for in the lower-cased line.
BOILERPLATE = ("all rights reserved", "cookie policy", "privacy policy", "terms of service",
               "terms of use", "enable javascript", "subscribe to our", "lorem ipsum")


@dataclass(frozen=True)
class Rules:
    """Limits of the rules; shares are in percent."""

    min_words: int = 20
    max_repeat_pct: int = 30
    #: a line with more symbols, or more exclamation marks, for 100 words than this fails
    max_symbols_per_100_words: int = 50
    max_shouts_per_100_words: int = 50
    #: a line with at least so many bars, and so many for 100 words, is a menu
    min_bars: int = 3
    min_bars_per_100_words: int = 25
    #: a line of at least so many words of which so many percent repeat the word before
    min_stutter_words: int = 10
    min_stutter_pct: int = 50
    #: a document that loses more of its text than this is rejected
    max_lost_pct: int = 50


def _count(text: Column, outside: str) -> Column:
    """Characters left when those of class ``outside`` are taken away."""
    return F.length(F.regexp_replace(text, outside, ""))


def _rest(array: Column, first: int) -> Column:
    """``array`` from its place ``first`` (from 1) on."""
    return F.slice(array, first, 1 << 30)


def _with_window_hashes(df: DataFrame) -> DataFrame:
    """``__h8``: a hash of the 8-word window that begins at each word of ``__words``.
    Equal windows have equal hashes: three doubling steps combine the words'
    hashes by shift and exclusive or.  Windows that run past the end give null."""
    df = df.withColumn("__h1", F.transform("__words", lambda w: F.xxhash64(w)))
    for by in (1, 2, 4):
        mix = partial(lambda by, a, b: F.shiftleft(a, by).bitwiseXOR(b), by)
        df = df.withColumn(f"__h{2 * by}", F.zip_with(f"__h{by}", _rest(F.col(f"__h{by}"), 1 + by),
                                                      lambda a, b: mix(a, b)))  # noqa: B023 - called here
    return df


def _with_repeats(df: DataFrame) -> DataFrame:
    """``n_repeat_words`` beside ``__words`` and ``__n``: words that lie in a window
    of 8 words found twice or more in the text.

    Distinct window hashes are counted first; only a text with an equal pair
    sorts its windows (the strings themselves, so a hash clash changes nothing).
    Each array is a column of its own, so none is computed twice.
    """
    words, n = F.col("__words"), F.col("__n")
    df = _with_window_hashes(df).withColumn("__h", F.when(n >= WINDOW, F.slice(
        "__h8", 1, F.greatest(n - (WINDOW - 1), F.lit(0)))))
    starts = F.sequence(F.lit(1), n - (WINDOW - 1))
    df = df.withColumn("__keyed", F.when(F.size(F.array_distinct("__h")) < F.size("__h"), F.array_sort(F.transform(
        starts, lambda i: F.struct(F.array_join(F.slice(words, i, WINDOW), " ").alias("w"), i.alias("i"))))))
    # equal windows are neighbours after the sort: both of a pair are marked
    pairs = F.zip_with("__keyed", _rest(F.col("__keyed"), 2),
                       lambda a, b: F.when(a["w"] == b["w"], F.array(a["i"], b["i"])))
    df = df.withColumn("__at", F.array_sort(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull())))))
    steps = F.zip_with("__at", _rest(F.col("__at"), 2),
                       lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    total = F.aggregate(steps, F.lit(0).cast("long"), lambda acc, x: acc + x.cast("long"))
    return df.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long")))


#: A line that breaks a rule holds one of these characters, a word right after itself or a phrase.
_MARKS = r"[#*$%&<>!|]"
_TWICE = rf"(?<!{NOT_BLANK})({NOT_BLANK}++){BLANK}++\1(?!{NOT_BLANK})"


def _may_fail(text: Column) -> Column:
    """False for a text in which no line can break a rule: most are settled here."""
    low = F.lower(text)
    out = text.rlike(_MARKS) | text.rlike(_TWICE)
    for phrase in BOILERPLATE:
        out = out | low.contains(phrase)
    return out


def line_fails(line: Column, parts: Column, rules: Rules) -> Column:
    """True when a line with the words ``parts`` breaks a punctuation, navigation
    or boilerplate rule."""
    words = F.size(parts)
    symbols = _count(line, r"[^#*$%&<>]+")
    shouts = _count(line, r"[^!]+")
    bars = _count(line, r"[^|]+")
    stutter = F.size(F.filter(F.zip_with(parts, _rest(parts, 2), lambda a, b: a == b),
                              lambda x: F.coalesce(x, F.lit(False))))
    furniture = F.lower(line).rlike("|".join(BOILERPLATE))
    return ((line.rlike(_MARKS) & (
                (symbols * 100 > words * rules.max_symbols_per_100_words)
                | (shouts * 100 > words * rules.max_shouts_per_100_words)
                | ((bars >= rules.min_bars) & (bars * 100 >= words * rules.min_bars_per_100_words))))
            | ((words >= rules.min_stutter_words) & (stutter * 100 >= words * rules.min_stutter_pct))
            | furniture)


def _good_lines(lines: Column, rules: Rules) -> Column:
    """The lines that break no rule; lines without a word break none."""
    split = F.transform(lines, lambda x: F.struct(x.alias("l"), words_of(x).alias("p")))
    return F.transform(F.filter(split, lambda x: (F.size(x["p"]) == 0) | ~line_fails(x["l"], x["p"], rules)),
                       lambda x: x["l"])


def _with_verdict(df: DataFrame, text_col: str, rules: Rules) -> DataFrame:
    """The statistics and the verdict beside the given columns."""
    text, keep = F.col("__t"), df.columns
    df = df.withColumn("__t", text_or_empty(text_col))
    df = df.withColumn("__words", words_of(text)).withColumn("__lines", F.split(text, "\n", -1))
    df = df.withColumn("__n", F.size("__words"))
    df = df.withColumn("__full", F.filter("__lines", lambda x: x.rlike(NOT_BLANK)))
    df = df.withColumn("__good", F.when(_may_fail(text), _good_lines(F.col("__full"), rules)).otherwise(F.col("__full")))
    all_chars, good_chars = (F.length(F.array_join(F.col(c), "")) for c in ("__full", "__good"))
    df = _with_repeats(df).withColumns({"__all_chars": all_chars, "__good_chars": good_chars})
    base_failed = (F.col("__n") < rules.min_words) | (
        F.col("n_repeat_words") * 100 > F.col("__n") * rules.max_repeat_pct)
    lost = F.col("__all_chars") - F.col("__good_chars")
    return settled(df, keep, {
        "n_words": F.col("__n").cast("long"),
        "word_chars": F.length(F.array_join("__words", "")).cast("long"),
        "n_symbols": _count(text, r"[^#*$%&|<>]+").cast("long"),
        "n_dup_lines": (F.size("__full") - F.size(F.array_distinct("__full"))).cast("long"),
        "n_repeat_words": F.col("n_repeat_words"),
        "base_failed": base_failed,
        "kept": ~base_failed & (lost * 100 <= F.col("__all_chars") * rules.max_lost_pct),
        "n_lines": F.size("__full").cast("long"),
        "n_bad_lines": (F.size("__full") - F.size("__good")).cast("long"),
        "line_chars": F.col("__all_chars").cast("long"),
        "lost_chars": lost.cast("long"),
    })


STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
         "n_lines", "n_bad_lines", "line_chars", "lost_chars")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """One row per row of ``docs``: its id, statistics and verdict."""
    one = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    return _with_verdict(one, "__text", rules).select(F.col("__id").alias(id_col), *STATS)


def clean(docs: DataFrame, text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The kept documents with their failing lines removed; columns as given.

    Lines without a word stay where they are.  The other columns (``n_chars``
    among them) pass through untouched.
    """
    boxed = docs.select(F.struct("*").alias("__row"), F.col(text_col).alias("__text"))
    df = _with_verdict(boxed, "__text", rules).filter("kept")
    left = F.array_join(_good_lines(F.split(F.col("__text"), "\n", -1), rules), "\n")
    text = F.when(F.col("n_bad_lines") == 0, F.col("__text")).otherwise(left)
    return df.select(*[(text if c == text_col else F.col("__row")[c]).alias(c) for c in docs.columns])


#: DuckDB's form of :func:`judge` with the default rules, over ``documents``.
ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT r, doc_id, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d),
win AS (
  SELECT r, i, list_aggregate(words[i:i+7], 'string_agg', ' ') AS k
  FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM w)),
twice AS (
  SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt
  FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM win) WHERE c > 1),
rep AS (SELECT r, sum(least(8, coalesce(nxt - i, 8))) AS n FROM twice GROUP BY r),
ln AS (SELECT r, unnest(lines) AS l FROM w),
lw AS (
  SELECT r, l, list_filter(string_split_regex(l, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS p FROM ln),
lf AS (
  SELECT r, l,
    length(regexp_replace(l, '[^#*$%&<>]+', '', 'g')) * 100 > len(p) * 50
    OR length(regexp_replace(l, '[^!]+', '', 'g')) * 100 > len(p) * 50
    OR (length(regexp_replace(l, '[^|]+', '', 'g')) >= 3
        AND length(regexp_replace(l, '[^|]+', '', 'g')) * 100 >= len(p) * 25)
    OR (len(p) >= 10 AND len(list_filter(range(2, len(p) + 1), lambda i: p[i] = p[i-1])) * 100 >= len(p) * 50)
    OR regexp_matches(lower(l), 'all rights reserved|cookie policy|privacy policy|terms of service|terms of use|enable javascript|subscribe to our|lorem ipsum')
      AS bad
  FROM lw),
ls AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (bad) AS n_bad_lines,
         sum(length(l)) AS line_chars, coalesce(sum(length(l)) FILTER (bad), 0) AS lost_chars
  FROM lf GROUP BY r),
s AS (
  SELECT w.r, doc_id, len(words) AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(rep.n, 0) AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_bad_lines, 0) AS n_bad_lines,
    coalesce(line_chars, 0) AS line_chars, coalesce(lost_chars, 0) AS lost_chars
  FROM w LEFT JOIN rep USING (r) LEFT JOIN ls USING (r))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  (n_words < 20 OR n_repeat_words * 100 > n_words * 30) AS base_failed,
  NOT (n_words < 20 OR n_repeat_words * 100 > n_words * 30) AND lost_chars * 100 <= line_chars * 50 AS kept,
  n_lines::BIGINT AS n_lines, n_bad_lines::BIGINT AS n_bad_lines, line_chars::BIGINT AS line_chars,
  lost_chars::BIGINT AS lost_chars
FROM s
"""
