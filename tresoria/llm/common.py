"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words, and its complement: the six ASCII blanks only.
BLANK = r"[\x20\x09-\x0D]"
NOT_BLANK = r"[^\x20\x09-\x0D]"

SPAN = "array<struct<s:int,e:int,t:string>>"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one given table (all of them when none is named)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text in order; a text without one gives an empty array."""
    return F.array_remove(F.split(text, BLANK + "+"), "")


#: bytes of text that a task cuts into words together
CUT_BYTES = 4_000_000


def cut_groups(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(from, to) of consecutive texts of some ``CUT_BYTES`` together, one text at least."""
    if len(texts):
        size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64))
        cuts = np.flatnonzero(np.diff(size // CUT_BYTES)) + 1
        yield from zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)])


def cut_words(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words of binary texts in a row as places in the list of different ones (``lower``:
    A-Z as a-z); that list; and how many words each text has.  As ``bytes.split`` cuts them:
    at the six ASCII blanks only, whatever the bytes are."""
    one = pc.fill_null(texts, b"")
    one = pa.Array.from_buffers(pa.string(), len(one), one.buffers(), offset=one.offset)  # not checked: any bytes
    lists = pc.ascii_split_whitespace(pc.ascii_lower(one) if lower else one)
    found = lists.flatten().cast(pa.binary()).dictionary_encode()
    at, words, size = found.indices.to_numpy(), found.dictionary, pc.list_value_length(lists).to_numpy().astype(np.int64)
    none = pc.index(words, pa.scalar(b"", pa.binary())).as_py()
    if none >= 0:  # a blank at an end of a text leaves an empty word there
        there = at != none
        size = np.diff(np.concatenate(([0], np.cumsum(there)))[np.concatenate(([0], np.cumsum(size)))])
        at = at[there]
        at, words = at - (at > none), words.filter(pc.not_equal(words, pa.scalar(b"", pa.binary())))
    return at, words, size


def matches(text: Column, pattern: str, maybe: Column | None = None) -> Column:
    """Non-overlapping matches, leftmost first: ``array<struct<s,e,t>>`` in code
    points, end exclusive, with the matched text.

    The pieces between the matches and the matches themselves are zipped, and a
    running position over their lengths gives the places; a text without a match
    costs one search.  ``maybe`` is a cheaper test that every match implies.
    """
    zipped = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), lambda p: F.length(p)).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))

    def step(acc, z):
        start = acc["pos"] + z["gap"]
        end = start + F.length(z["hit"])
        return F.struct(
            F.coalesce(end, start).alias("pos"),
            F.when(z["hit"].isNull(), acc["out"]).otherwise(
                F.concat(acc["out"], F.array(F.struct(start.alias("s"), end.alias("e"), z["hit"].alias("t"))))
            ).alias("out"))

    none = F.array().cast(SPAN)
    found = F.aggregate(zipped, F.struct(F.lit(0).alias("pos"), none.alias("out")), step, lambda acc: acc["out"])
    there = text.rlike(pattern) if maybe is None else maybe & text.rlike(pattern)
    return F.when(there, found).otherwise(none)


def labelled(spans: Column, kind: str, rank: int) -> Column:
    """Spans with their kind's name and its place in the order of kinds; they sort by
    start, then kind."""
    return F.transform(spans, lambda x: F.struct(
        x["s"].alias("s"), F.lit(rank).alias("k"), x["e"].alias("e"), F.lit(kind).alias("kind"), x["t"].alias("t")))


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined in the array's order."""
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))))


def settled(df: DataFrame, keep: list[str], columns: dict[str, Column]) -> DataFrame:
    """``keep`` and the computed ``columns``, as rows of a generator.

    A filter on a computed column would be moved below the projections that
    compute it, with every expression written out again in it; it cannot be
    moved below a generator.
    """
    one = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*keep, F.explode(F.array(one)).alias("__settled")).select(*keep, "__settled.*")
