import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from remitlens.operators.joins import null_safe_join
from remitlens.operators.medians import exact_medians
from remitlens.operators.ordering import forward_fill, latest_window, time_ordinal


def test_null_keys_join(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2), ("y", 3)], "k string, a int")
    b = spark.createDataFrame([(None, 10), ("x", 20), ("z", 30)], "k string, b int")
    assert sorted(null_safe_join(a, b, ["k"]).collect(), key=str) == sorted(
        [(None, 1, 10), ("x", 2, 20), ("y", 3, None)], key=str
    )
    full = {(r.k, r.a, r.b) for r in null_safe_join(a, b, ["k"], "full").collect()}
    assert full == {(None, 1, 10), ("x", 2, 20), ("y", 3, None), ("z", None, 30)}
    assert {r.k for r in null_safe_join(a, b, ["k"], "left_semi").collect()} == {None, "x"}


@pytest.mark.parametrize("block_bits", [2, 5, 18])
@pytest.mark.parametrize("partitions", [1, 7])
def test_forward_fill_matches_pandas(spark, block_bits, partitions):
    rng = np.random.default_rng(block_bits)
    n = 700
    ids = np.sort(rng.choice(5000, n, replace=False))
    frame = pd.DataFrame(
        {"row_id": ids, "a": np.where(rng.random(n) < 0.1, rng.integers(0, 9, n).astype(str), None), "b": np.where(rng.random(n) < 0.02, "z", None)}
    )
    df = spark.createDataFrame(list(frame.itertuples(index=False, name=None)), "row_id bigint, a string, b string")
    got = forward_fill(df.repartition(partitions, F.rand(1)), ["a", "b"], block_bits=block_bits).orderBy("row_id").collect()
    want = frame.assign(a=frame.a.ffill(), b=frame.b.ffill())
    assert [tuple(r) for r in got] == [tuple(None if pd.isna(v) else v for v in r) for r in want.itertuples(index=False)]


def test_time_ordinal_is_a_global_order(spark):
    rng = np.random.default_rng(0)
    rows = {(int(y), int(w), p, e, m) for y, w, p, e, m in zip(
        rng.integers(2020, 2023, 800), rng.integers(1, 6, 800), rng.choice(["a", "b", None], 800), rng.choice(["x", "y"], 800), rng.choice(["s", "t", "u"], 800)
    )}
    df = spark.createDataFrame(list(rows), "year int, week int, payer string, group_em string, group_em2 string")
    got = time_ordinal(df.repartition(5), ["payer", "group_em", "group_em2"]).orderBy("ord").collect()
    assert [r.ord for r in got] == list(range(len(rows)))
    want = sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))
    assert [tuple(r)[:5] for r in got] == want
    last = latest_window(df, 40, ["payer", "group_em", "group_em2"]).collect()
    assert {tuple(r) for r in last} == set(want[-40:])
    assert latest_window(df, 10_000, ["payer", "group_em", "group_em2"]).count() == len(rows)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.one_of(st.none(), st.floats(-1e9, 1e9), st.sampled_from([0.0, 1.0, -1.0, 1e-300, 0.5])), min_size=1, max_size=60
    )
)
def test_exact_median(spark, data):
    df = spark.createDataFrame([(v, 1.0 if v is None else -v) for v in data], "x double, y double").repartition(3)
    got = exact_medians(df, ["x", "y"]).first()
    frame = pd.DataFrame({"x": [np.nan if v is None else v for v in data]})
    want = frame.x.median()
    assert (got.x is None) == bool(np.isnan(want))
    if got.x is not None:
        assert got.x == want
    assert got.y == pd.Series([1.0 if v is None else -v for v in data]).median()


def test_exact_median_of_many_values(spark):
    df = spark.range(0, 200_001).select((F.pow(F.rand(5), 8) * 1e6).alias("x"))
    values = [r.x for r in df.collect()]
    assert exact_medians(df, ["x"]).first().x == float(np.median(values))
