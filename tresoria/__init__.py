"""tresoria: treasury reporting as lazy Spark DataFrame operators.

Every public operator is a ``DataFrame -> DataFrame`` function built from
Spark SQL built-ins, so Catalyst can prune columns, push filters into the
Parquet scan and pick the join strategy at run time (AQE).
"""

__version__ = "0.1.0"
