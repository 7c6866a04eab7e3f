"""Time-ordered and seeded random splits, labelled in place.

The split is a column, not three DataFrames: the cut keys are found with
``kth_keys`` (no single-task global sort), then labelling is a projection.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.operators.order import key_literal, kth_keys, order_key
from recspark.operators.prepare import CAT, ITEM, TS, USER


class LeakageError(AssertionError):
    pass


def _label_by_cuts(df: DataFrame, order_cols, n_train_fn, n_val_fn, split_col: str) -> DataFrame:
    order_cols = list(order_cols)
    n, keys = kth_keys(df, order_cols, lambda n: [n_train_fn(n), n_val_fn(n)])
    key = order_key(order_cols)

    def below(pos):
        # rows before position ``pos``; pos == n means every row
        if pos >= n:
            return F.lit(True)
        return key < key_literal(df, order_cols, keys[pos])

    t_end, v_end = n_train_fn(n), n_val_fn(n)
    return df.withColumn(
        split_col,
        F.when(below(t_end), F.lit("train")).when(below(v_end), F.lit("val")).otherwise(F.lit("test")),
    )


def temporal_split(
    df: DataFrame,
    time_col: str = TS,
    keys=(USER, ITEM, CAT),
    train: float = 0.70,
    val: float = 0.15,
    descending: bool = False,
    split_col: str = "split",
) -> DataFrame:
    """First ⌊n·train⌋ rows by time are train, up to ⌊n·(train+val)⌋ val, the rest test.

    Ties on time are broken by the interaction keys, so the cut is the same on every run;
    rows without a time come last.
    ``descending`` puts the latest rows first.
    """
    order_cols = [time_col, *keys]
    work = df
    if descending:
        # reverse the time order by ordering on the negated epoch; keys stay ascending
        from recspark.functions.scalar import wall_clock_micros

        work = df.withColumn("_neg_t", -wall_clock_micros(F.col(time_col)))
        order_cols = ["_neg_t", *keys]
    t_frac, v_frac = float(train), float(train) + float(val)
    out = _label_by_cuts(
        work,
        order_cols,
        lambda n: math.floor(n * t_frac),
        lambda n: math.floor(n * v_frac),
        split_col,
    )
    return out.drop("_neg_t") if descending else out


def random_split(
    df: DataFrame, keys=(USER, ITEM, CAT), train: float = 0.70, val: float = 0.15, seed: int = 42, split_col="split"
) -> DataFrame:
    """Seeded shuffle by a draw from the keys: exact sizes, same rows on every run and retry.

    Sizes follow the two-step split: ⌊0.70·n⌋ train, then the rest halved by
    val/(1-train) with the val part rounded down.
    """
    from recspark.operators.sampling import draw

    work = df.withColumn("_h", draw(*[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys], seed=seed))
    ratio = float(val) / (1.0 - float(train))

    def n_train(n):
        return math.floor(n * float(train))

    def n_val(n):
        rest = n - n_train(n)
        return n_train(n) + math.floor(rest * ratio)

    return _label_by_cuts(work, ["_h", *keys], n_train, n_val, split_col).drop("_h")


def split_bounds(df: DataFrame, time_col: str = TS, split_col: str = "split") -> DataFrame:
    return df.groupBy(split_col).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(time_col).alias("min_time"),
        F.max(time_col).alias("max_time"),
    )


def assert_no_leakage(df: DataFrame, time_col: str = TS, split_col: str = "split") -> dict:
    """train.max ≤ val.min and val.max ≤ test.min; raises LeakageError otherwise."""
    b = {r[split_col]: r for r in split_bounds(df, time_col, split_col).collect()}
    chain = [b[s] for s in ("train", "val", "test") if s in b]
    for a, c in zip(chain, chain[1:]):
        if a["max_time"] > c["min_time"]:
            raise LeakageError(f"{a[split_col]} ends at {a['max_time']} after {c[split_col]} starts at {c['min_time']}")
    return {k: v.asDict() for k, v in b.items()}


def take_split(df: DataFrame, name: str, split_col: str = "split") -> DataFrame:
    return df.filter(F.col(split_col) == F.lit(name)).drop(split_col)
