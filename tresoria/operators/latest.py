"""Keep the latest version of every record (J1, J2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tresoria.operators.joins import semi_join


def keep_latest(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Rows whose ``version`` equals the maximum of their ``keys`` group; ties kept.

    Rows with a NULL key are dropped (they form no group).  The maximum is a
    partial (map-side) aggregate, so a key holding a third of all rows costs
    no more than any other; the rows are then filtered by a semi-join.  A
    filter on the keys reaches both scans: nothing between them is persisted."""
    keys = list(keys)
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    latest = (df.where(cond).groupBy(*keys).agg(F.max(version).alias(version)))
    return semi_join(df, latest, keys + [version])


def keep_latest_colocated(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """:func:`keep_latest` of a table bucketed by exactly ``keys``: no row is shuffled.

    The maxima are computed and met where the buckets lie.  Only the keys are join keys (a join
    that also hashed the version would deal both sides out anew): a row is kept where its
    version is at least the maximum, which it cannot pass."""
    keys = list(keys)
    latest = df.where(" and ".join(f"`{k}` is not null" for k in keys)).groupBy(*keys).agg(F.max(version).alias("_latest"))
    a, b = df.alias("a"), latest.alias("b").hint("merge")
    on = F.col(f"a.{version}") >= F.col("b._latest")
    for k in keys:
        on = on & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    return a.join(b, on, "left_semi")
