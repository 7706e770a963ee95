"""Column-level helpers: every function returns a ``Column`` built from Spark
built-ins, so it stays inside whole-stage codegen."""
