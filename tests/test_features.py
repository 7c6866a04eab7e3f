"""Feature rules: elapsed days, scaler, quantile flag, final schema."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from recspark.functions import scalar
from recspark.operators import features as fe
from recspark.operators import select as se


def test_elapsed_days_not_midnights(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2020, 1, 1, 23), dt.datetime(2020, 1, 2, 1)), (dt.datetime(2020, 1, 1, 1), dt.datetime(2020, 1, 3, 0)),
         (dt.datetime(2020, 1, 3), dt.datetime(2020, 1, 1, 12))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    got = [r[0] for r in df.select(scalar.elapsed_days(F.col("a"), F.col("b"))).collect()]
    assert got == [0, 1, -2]


def test_weekday_monday_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 7),)], "t timestamp_ntz")
    assert [r[0] for r in df.select(scalar.weekday_mon0(F.col("t"))).collect()] == [0, 6]


def test_scaler_constant_column_population_std(spark):
    df = spark.createDataFrame([(1.0, 7.0), (2.0, 7.0), (3.0, 7.0), (None, 7.0)], "a double, c double")
    st = se.fit_scaler(df, ["a", "c"])
    assert st["c"] == (7.0, 1.0)
    assert st["a"][0] == pytest.approx(1.5)
    assert st["a"][1] == pytest.approx((sum((x - 1.5) ** 2 for x in [1, 2, 3, 0]) / 4) ** 0.5)


def test_bucketize_right_closed(spark):
    df = spark.createDataFrame([(1,), (2,), (5,), (6,), (51,)], "n int")
    edges, labels = [0, 1, 5, 10, 50, float("inf")], ["1", "2-5", "6-10", "11-50", "51+"]
    assert [r[0] for r in df.select(scalar.bucketize(F.col("n"), edges, labels)).collect()] == ["1", "2-5", "2-5", "6-10", "51+"]


def test_redundant_rule(spark):
    pairs = [("price", "price_log", 0.99), ("product_popularity", "product_unique_buyers", 0.97), ("freight_value_log", "freight_value", 0.9),
             ("user_avg_price", "product_avg_price", 0.86), ("a", "b", 0.99), ("price", "user_avg_price", -0.96)]
    got = {r["feature"]: (r["n_pairs"], r["band"]) for r in se.redundant_features(spark.createDataFrame(pairs, "f1 string, f2 string, corr double")).collect()}
    assert got == {"price": (1, "above 0.95"), "product_unique_buyers": (1, "above 0.95"), "freight_value": (1, "above 0.85"), "user_avg_price": (2, "above 0.95")}


def test_spearman_is_pairwise_complete(spark):
    import itertools
    import random

    import pandas as pd

    r = random.Random(1)
    rows = [(r.choice([None, float(r.randint(0, 5))]), r.choice([None, r.random()]), float(r.randint(0, 9)), float(i % 7), 1.0) for i in range(300)]
    rows = [(a, None if b is None else b + (a or 0), c, (c + d) if a is None else a + c, e) for a, b, c, d, e in rows]
    names = ["a", "b", "c", "d", "e"]
    want = pd.DataFrame(rows, columns=names).corr(method="spearman")
    got = {(x["f1"], x["f2"]): (x["corr"], x["n"]) for x in se.spearman_pairs(spark.createDataFrame(rows, "a double, b double, c double, d double, e double"), names, -1.0).collect()}
    assert set(got) == {p for p in itertools.combinations(names, 2) if "e" not in p}
    for (f, g), (corr, n) in got.items():
        assert abs(corr - want.loc[f, g]) < 1e-9
        assert n == sum(x[names.index(f)] is not None and x[names.index(g)] is not None for x in rows)


def test_spearman_joins_no_value_with_many_rows(spark, monkeypatch):
    """A 0/1 flag and a price that is 0 for half of the rows: only values of few rows are joined."""
    import random

    import pandas as pd

    r = random.Random(5)
    rows = [(float(r.random() < 0.3), 0.0 if r.random() < 0.5 else r.random(), float(i % 400)) for i in range(2000)]
    rows = [(a, b + a, c) for a, b, c in rows]
    joined, join = [], type(spark.range(1)).join

    def watched(self, other, *args, **kw):
        if "rank" in other.columns and args[1:] != ("left",):
            joined.extend(self.groupBy("at", "x").count().collect())
        return join(self, other, *args, **kw)

    monkeypatch.setattr(type(spark.range(1)), "join", watched)
    got = {(x["f1"], x["f2"]): x["corr"] for x in se.spearman_pairs(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"], -1.0).collect()}
    want = pd.DataFrame(rows, columns=["a", "b", "c"]).corr(method="spearman")
    assert all(abs(corr - want.loc[f, g]) < 1e-9 for (f, g), corr in got.items()) and len(got) == 3
    assert joined and all(x["count"] * 100 < len(rows) for x in joined)


def test_spearman_shuffles_chunks_not_cells(spark, monkeypatch):
    """Many small chunks and ranges, nulls in two columns, NaN and both zeros: same ranks, and a chunk is one joined row."""
    import random

    import pandas as pd

    r = random.Random(9)
    monkeypatch.setattr(se, "CHUNK", 100)
    monkeypatch.setattr(se, "STEP", 4)
    monkeypatch.setattr(se, "RANGE", 64)
    rows = [(r.choice([None, float(r.randint(0, 3))]), r.choice([None, r.gauss(0, 1)]), r.choice([0.0, -0.0, r.random()]), r.random(), r.choice([float("nan"), r.random()])) for _ in range(1500)]
    rows = [(a, b, c, d + c, e) for a, b, c, d, e in rows]
    joined, join = [], type(spark.range(1)).join

    def watched(self, other, *args, **kw):
        joined.append(self.count())
        return join(self, other, *args, **kw)

    monkeypatch.setattr(type(spark.range(1)), "join", watched)
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double").repartition(3)
    got = {(x["f1"], x["f2"]): (x["corr"], x["n"]) for x in se.spearman_pairs(df, list("abcde"), -1.0).collect()}
    # Spark orders NaN after all other values
    want = pd.DataFrame([(*x[:4], 9.0 if x[4] != x[4] else x[4]) for x in rows], columns=list("abcde"))
    corr = want.corr(method="spearman")
    assert len(got) == 10
    for (f, g), (rho, n) in got.items():
        assert abs(rho - corr.loc[f, g]) < 1e-9
        assert n == (want[f].notna() & want[g].notna()).sum()
    assert sum(joined) <= 1500 / 100 + 3


def test_spearman_of_no_rows(spark):
    assert se.spearman_pairs(spark.createDataFrame([], "a double, b double"), ["a", "b"], -1.0).count() == 0


def test_mutual_info_counts_in_tasks(spark):
    import math
    import random
    from collections import Counter

    r = random.Random(2)
    rows = [(None if i % 9 == 0 else r.random() * 3, float(i % 2), 7.0, None if i % 11 == 0 else float(r.randint(1, 5))) for i in range(500)]
    got = {x["feature"]: x["mi"] for x in se.mutual_info(spark.createDataFrame(rows, "a double, b double, c double, y double"), ["a", "b", "c"], "y").collect()}
    ys = sorted(x[3] for x in rows if x[3] is not None)
    med = (ys[(len(ys) - 1) // 2] + ys[len(ys) // 2]) / 2

    def bins(values):
        lo, hi = min(values), max(values)
        return [0 if hi == lo else min(9, math.floor((v - lo) / (hi - lo) * 10)) for v in values]

    y = bins([med if x[3] is None else x[3] for x in rows])
    for at, name in enumerate("abc"):
        x = bins([0.0 if row[at] is None else row[at] for row in rows])
        xy, nx, ny = Counter(zip(x, y)), Counter(x), Counter(y)
        want = sum(n / 500 * math.log(n * 500 / (nx[a] * ny[b])) for (a, b), n in xy.items())
        assert abs(got[name] - want) < 1e-9
    assert set(got) == {"a", "b", "c"}


def test_final_columns_count():
    assert len(fe.FINAL_COLUMNS) == 42
    assert len(se.SELECTED_NUMERIC) == 18


def test_joins_move_raw_columns_only(spark, monkeypatch):
    """Rows meet users and products before anything is derived from them; buyers are counted once, null ones not."""
    import datetime as dt

    from recspark.operators.prepare import CAT, ITEM, TS, USER

    rows = [(u, p, dt.datetime(2020, 1, d), float(d), 1.0, r, int(r is not None), 1, c, "voucher")
            for u, p, d, r, c in [(1, 10, 1, 5.0, "a"), (1, 10, 2, None, "a"), (2, 10, 3, 3.0, None), (4, 11, 4, 4.0, "b"), (None, 11, 4, 4.0, "b"), (None, 10, 5, 1.0, "a"), (2, None, 6, 2.0, "b"), (3, None, 7, 2.0, "b")]]
    names = [USER, ITEM, TS, "price", "freight_value", "review_score", "has_review", "purchase_count", CAT, "payment_type"]
    df = spark.createDataFrame(rows, f"{USER} long, {ITEM} long, {TS} timestamp_ntz, price double, freight_value double, review_score double, has_review int, purchase_count long, {CAT} string, payment_type string")
    assert df.columns == names
    got = {r[ITEM]: (r["product_unique_buyers"], r["product_popularity"]) for r in fe.product_features(df).collect()}
    assert got == {10: (2, 3), 11: (1, 1), None: (2, 2)}
    sides, join = [], type(df).join

    def watched(self, other, *args, **kw):
        if isinstance(args[0], str) and args[0] in (USER, ITEM) and "price" in self.columns:
            sides.append(self.columns)
        return join(self, other, *args, **kw)

    monkeypatch.setattr(type(df), "join", watched)
    out = fe.features(df)
    assert out.columns == fe.FINAL_COLUMNS and out.count() == len(rows)
    assert len(sides) == 2 and not any({"price_log", "purchase_year", "category_target_enc"} & set(s) for s in sides)
