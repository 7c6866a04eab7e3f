"""Exact selection and global index without a single-task sort."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from recspark.operators import order


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    vals = np.round(rng.gamma(2.0, 10.0, 5000), 2)
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    probs = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
    n, got = order.exact_quantiles(df, "x", probs)
    assert n == len(vals)
    assert got == pytest.approx(list(np.quantile(vals, probs)), abs=1e-9)


def test_heavy_duplicates_do_not_need_a_sort(spark):
    vals = [5.0] * 3000 + [float(i) for i in range(1000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    n, got = order.exact_quantiles(df, "x", [0.1, 0.5, 0.9])
    assert got == pytest.approx(list(np.quantile(vals, [0.1, 0.5, 0.9])))


def test_selection_by_position(spark):
    df = spark.range(0, 20000).select((F.col("id") * 7919 % 20000).alias("k"))
    n, keys = order.kth_keys(df, ["k"], lambda n: [0, 123, 9999, n - 1])
    assert n == 20000
    assert {p: v[0] for p, v in keys.items()} == {0: 0, 123: 123, 9999: 9999, 19999: 19999}


def test_global_index_is_row_number(spark):
    df = spark.createDataFrame([(i % 37, f"u{i}") for i in range(500)], "a int, b string")
    out = order.global_index(df, ["a", "b"], "idx").collect()
    got = sorted((r["idx"], r["a"], r["b"]) for r in out)
    want = sorted(((r_a, r_b) for r_a, r_b in ((i % 37, f"u{i}") for i in range(500))))
    assert [g[0] for g in got] == list(range(500))
    assert [(g[1], g[2]) for g in got] == want


def test_quantiles_of_groups_and_missing_values(spark):
    rows = [("a", float(i)) for i in range(101)] + [("b", 3.0), ("c", None), ("c", float("nan"))]
    got = {r["g"]: (r["n"], r["q0"], r["q1"]) for r in order.grouped_quantiles(spark.createDataFrame(rows, "g string, x double"), "g", "x", [0.1, 0.995]).collect()}
    assert got == {"a": (101, pytest.approx(10.0), pytest.approx(99.5)), "b": (1, 3.0, 3.0)}
    assert order.exact_quantiles(spark.createDataFrame(rows, "g string, x double").where("g = 'c'"), "x", [0.5]) == (0, [None])


def test_iqr_without_values(spark):
    from recspark.operators import profile

    df = spark.createDataFrame([(None, 1.0), (None, 2.0), (None, 2.0), (None, 50.0)], "x double, y double")
    assert profile.iqr_bounds(df, "x") == (None, None) and profile.iqr_outliers(df, "x").count() == 0
    assert profile.iqr_bounds(df.limit(0), "y") == (None, None)
    got = profile.iqr_outlier_share(df, ["x", "y"]).collect()
    assert [(r["column"], r["n"], r["n_outliers"], r["outlier_pct"]) for r in got] == [("y", 4, 1, 25.0)]


def _brute(rows, positions):
    key = lambda r: tuple((v is None, 0 if v is None else v) for v in r)
    ranked = sorted(rows, key=key)
    return {p: ranked[p] for p in positions}


@pytest.mark.parametrize("cells,listed,few", [(1000, 1 << 24, 4096), (8, 40, 5), (8, 0, 1)])
def test_selection_in_rounds_equals_a_sort(spark, monkeypatch, cells, listed, few):
    for name, v in (("CELLS", cells), ("LISTED", listed), ("FEW", few)):
        monkeypatch.setattr(order, name, v)
    rng = np.random.default_rng(3)
    words = ["", "a", "a\0", "ab", "abcdefg", "abcdefgh", "abcdefghijklmnop", "é", "漢字漢字漢字", None]
    rows = [
        (None if i % 11 == 0 else 7 if i % 3 else int(rng.integers(-(2**62), 2**62)), words[int(rng.integers(10))], float(rng.integers(4)))
        for i in range(600)
    ]
    df = spark.createDataFrame(rows, "a bigint, b string, c double")
    n, got = order.kth_keys(df, ["a", "b", "c"], lambda n: [0, 100, 300, 301, 599, 600])
    key = [(r[0], None if r[1] is None else r[1].encode(), r[2]) for r in rows]
    want = _brute(key, [0, 100, 300, 301, 599])
    assert n == 600 and {p: (v[0], None if v[1] is None else v[1].encode(), v[2]) for p, v in got.items()} == want


def test_quantiles_in_rounds_on_uneven_values(spark, monkeypatch):
    monkeypatch.setattr(order, "CELLS", 8)
    monkeypatch.setattr(order, "LISTED", 30)
    rng = np.random.default_rng(5)
    sets = {"wide": np.exp(rng.normal(0, 40, 700)), "hot": np.concatenate([np.zeros(500), rng.normal(size=200)]), "one": np.array([4.0])}
    df = spark.createDataFrame([(g, float(v)) for g, vs in sets.items() for v in vs], "g string, x double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.99, 1.0]
    for r in order.grouped_quantiles(df, "g", "x", probs).collect():
        vs = sets[r["g"]]
        assert r["n"] == len(vs) and [r[f"q{j}"] for j in range(6)] == pytest.approx(list(np.quantile(vs, probs)))


def test_selection_has_no_range_exchange(spark, monkeypatch, capsys):
    monkeypatch.setattr(order, "cut_lineage", lambda d: d)  # the plan shown is the whole one
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), (F.col("id") * 1.5).alias("x"))
    order.grouped_quantiles(df, "g", "x", [0.5]).explain()
    plan = capsys.readouterr().out
    assert "hashpartitioning" in plan and "rangepartitioning" not in plan


def test_cuts_of_times_and_of_missing_columns(spark):
    df = spark.sql("select timestamp_ntz'2020-01-01' + make_dt_interval(0, 0, 0, id % 900) as t, if(id % 2 = 0, null, id) as k from range(20000)")
    rows = [tuple(r) for r in df.collect()]
    n, got = order.kth_keys(df, ["t", "k"], lambda n: [n // 2, n - 1])
    assert got == _brute(rows, [n // 2, n - 1])
    empty = spark.createDataFrame([(None, None)] * 5000, "a double, b date")
    assert order.kth_keys(empty, ["a", "b"], lambda n: [17]) == (5000, {17: (None, None)})
    assert order.kth_keys(empty.limit(0), ["a", "b"], lambda n: [0]) == (0, {})
