"""Property tests: operators against brute force on random small inputs."""

from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tresoria.operators import cells as C
from tresoria.operators import latest

SETTINGS = dict(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.sampled_from(["a", "b", "c", None])
versions = st.sampled_from(["2020-01", "2020-02", "2021-01", None])


@settings(**SETTINGS)
@given(st.lists(st.tuples(keys, versions), min_size=1, max_size=25))
def test_keep_latest_matches_brute_force(spark, rows):
    data = [(k, v, i) for i, (k, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, v string, id int")
    got = sorted(r["id"] for r in latest.keep_latest(df, ["k"], "v").collect())
    best = {}
    for k, v, _ in data:
        if k is not None and v is not None:
            best[k] = max(best.get(k, v), v)
    expect = sorted(i for k, v, i in data if k is not None and v is not None and best.get(k) == v)
    assert got == expect


def leading_run_py(cols):
    """First maximal run of +1 steps starting at the smallest column."""
    cols = sorted(set(cols))
    if not cols:
        return None
    end = cols[0]
    for c in cols[1:]:
        if c == end + 1:
            end = c
        else:
            break
    return cols[0], end, end - cols[0] + 1


@settings(**SETTINGS)
@given(st.lists(st.sets(st.integers(min_value=0, max_value=30), min_size=1, max_size=12), min_size=1, max_size=4))
def test_leading_run_matches_brute_force(spark, sheets):
    data = [("f", f"s{i}", c, True) for i, cols in enumerate(sheets) for c in cols]
    df = spark.createDataFrame(data, "file string, sheet string, c int, flag boolean")
    got = {r["sheet"]: (r["run_min"], r["run_max"], r["run_len"]) for r in C._leading_run(df, "flag").collect()}
    assert got == {f"s{i}": leading_run_py(cols) for i, cols in enumerate(sheets)}


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sets(st.integers(0, 20), max_size=12), st.sets(st.integers(0, 20), max_size=12)),
                min_size=1, max_size=4))
def test_bounds_runs_match_brute_force(spark, sheets):
    data = []
    for i, (floats, months) in enumerate(sheets):
        for c in sorted(floats | months | {0}):
            data.append(("f", f"s{i}", c, c in floats, c in months, False))
    df = spark.createDataFrame(data, "file string, sheet string, c int, is_float boolean, "
                                     "has_month boolean, all_numeric boolean")
    got = {r["sheet"]: (r["run_min"], r["run_max"], r["run_len"], r["month_run_end"])
           for r in C._runs(df).collect()}
    for i, (floats, months) in enumerate(sheets):
        fr = leading_run_py(floats) or (None, None, 0)
        mr = leading_run_py([m for m in months if m >= 11])
        month_end = mr[1] if mr and mr[0] == 11 else None
        assert got[f"s{i}"] == (fr[0], fr[1], fr[2], month_end)
