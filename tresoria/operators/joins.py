"""Joins with sides derived from data.

No side that grows with the data is hinted: its size is not known when the plan
is built.  The planner broadcasts a side whose estimate is small, adaptive
execution one whose *measured* bytes are below
``spark.sql.adaptive.autoBroadcastJoinThreshold``; beyond it the join shuffles
and skewed partitions are split.  Nothing is counted or persisted, so building a
report starts no job and a later read sees files that arrived meanwhile.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def semi_join(big: DataFrame, small: DataFrame, on) -> DataFrame:
    """Rows of ``big`` that have a match in ``small``."""
    return big.join(small, on=on, how="left_semi")
