"""Fixtures of the training-data tests: rows with odd cases, and their frames."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, texts, first_id=0):
    """Documents with the given texts; a text may be a (doc_id, text) pair."""
    rows = []
    for i, t in enumerate(texts):
        doc_id, text = t if isinstance(t, tuple) else (first_id + i, t)
        rows.append((doc_id, text, "en", "src0", None if text is None else len(text)))
    return spark.createDataFrame(rows, SCHEMA)


def odd_texts():
    """Null, empty, blank, repeated, very long and non-ASCII texts."""
    rng = random.Random(7)
    long_ = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(30_000))
    return [None, "", " ", "\n\n", "a", "é ñ 漢字 🙂 word", long_, long_, "x" * 50_000, "same text here", "same text here",
            (None, "a row without an id"), (5, "a repeated id"), " odd blanks\x1f here\x0bend"]


def clash(df):
    """The same rows with extra columns whose names operators use inside."""
    from pyspark.sql import functions as F
    for c in ("__t", "kept", "spans", "id", "row", "fingerprint", "__row", "n"):
        df = df.withColumn(c, F.lit("x"))
    return df
