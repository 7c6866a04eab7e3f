"""Feature stage: numeric, calendar, category, user and product features, dense ids.

Global constants (p99 of price, first/last timestamp, mean rating) are fitted as one
small aggregate each and applied as literals; per-category and per-entity tables
are joined back by key (AQE broadcasts them only when their runtime size allows).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.functions import scalar
from recspark.operators.order import exact_quantiles, global_index
from recspark.operators.prepare import CAT, ITEM, TS, USER
from recspark.session import cut_lineage

TARGET_ENC_ALPHA = 10  # fixed value: smoothing weight of the category target encoding
RARE_BELOW = 10  # fixed value: categories with fewer rows are rare
TOP_N_CATEGORIES = 10
CATEGORY_ROW_BYTES, CATEGORY_BROADCAST_BYTES = 256, 32 << 20

# The columns of the feature table.
FINAL_COLUMNS = [
    "customer_unique_id", "product_id", "user_id", "product_id_idx", "category_id",
    "review_score", "has_review", "purchase_count",
    "price", "freight_value", "price_log", "freight_value_log", "price_to_freight_ratio", "has_price_outlier",
    "purchase_year", "purchase_month", "purchase_day_of_week", "purchase_hour", "purchase_day_of_month",
    "is_weekend", "is_holiday_season", "days_since_reference",
    "category_target_enc", "category_frequency", "category_is_top10", "category_is_rare",
    "payment_type_credit_card", "payment_type_boleto", "payment_type_voucher", "payment_type_debit_card",
    "user_total_purchases", "user_avg_price", "user_avg_freight", "user_purchase_span_days",
    "user_recency_days", "user_review_rate",
    "product_popularity", "product_unique_buyers", "product_avg_review_score", "product_avg_price",
    "product_avg_freight", "product_review_rate",
]


# ---------------------------------------------------------------- fitted scalars
def fit_p99(df: DataFrame, col: str = "price") -> float | None:
    return exact_quantiles(df, col, [0.99])[1][0]


def fit_time_range(df: DataFrame, col: str = TS):
    r = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    return r["lo"], r["hi"]


def fit_mean(df: DataFrame, col: str = "review_score") -> float | None:
    return df.agg(F.avg(col)).first()[0]


def _ts_lit(v):
    return F.lit(v.isoformat() if v is not None else None).cast("timestamp_ntz")


# ---------------------------------------------------------------- row features
def numeric_features(df: DataFrame, p99: float | None = None) -> DataFrame:
    p99 = fit_p99(df) if p99 is None else p99
    return df.select(
        "*",
        scalar.log1p(F.col("price")).alias("price_log"),
        scalar.log1p(F.col("freight_value")).alias("freight_value_log"),
        (F.col("price") / (F.col("freight_value") + F.lit(1.0))).alias("price_to_freight_ratio"),
        (F.col("price") + F.col("freight_value")).alias("total_cost"),
        F.coalesce((F.col("price") > F.lit(p99)).cast("int"), F.lit(0)).alias("has_price_outlier"),
    )


def temporal_features(df: DataFrame, first_ts=None, time_col: str = TS) -> DataFrame:
    if first_ts is None:
        first_ts = fit_time_range(df, time_col)[0]
    ts = F.col(time_col)
    dow = scalar.weekday_mon0(ts)
    return df.select(
        "*",
        F.year(ts).alias("purchase_year"),
        F.month(ts).alias("purchase_month"),
        dow.alias("purchase_day_of_week"),
        F.hour(ts).alias("purchase_hour"),
        F.dayofmonth(ts).alias("purchase_day_of_month"),
        (dow >= 5).cast("int").alias("is_weekend"),
        F.month(ts).isin(scalar.HOLIDAY_MONTHS).cast("int").alias("is_holiday_season"),
        scalar.elapsed_days(_ts_lit(first_ts), ts).alias("days_since_reference"),
        F.quarter(ts).alias("purchase_quarter"),
    )


# ---------------------------------------------------------------- category encodings
def target_encoding(df: DataFrame, key: str = CAT, y: str = "review_score", alpha: float = TARGET_ENC_ALPHA, global_mean=None) -> DataFrame:
    """Per-key smoothed mean (n·mean + α·global)/(n + α); a key without ratings gets the global mean."""
    g = fit_mean(df, y) if global_mean is None else global_mean
    gl = F.lit(g).cast("double")
    stats = df.groupBy(key).agg(F.count(y).alias("_n"), F.avg(y).alias("_m"))
    enc = (F.col("_n") * F.col("_m") + F.lit(float(alpha)) * gl) / (F.col("_n") + F.lit(float(alpha)))
    return stats.select(key, F.coalesce(enc, gl).alias(f"{key_alias(key)}_target_enc"))


def key_alias(key: str) -> str:
    return "category" if key == CAT else key


def freq_encode(df: DataFrame, key: str = CAT) -> DataFrame:
    """Share of rows per key value, plus the row count."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_cnt"))
    total = df.count()
    return counts.select(key, "_cnt", (F.col("_cnt") / F.lit(float(total))).alias(f"{key_alias(key)}_frequency"))


def top_flag(freq: DataFrame, key: str = CAT, n: int = TOP_N_CATEGORIES) -> DataFrame:
    """1 for the n most frequent values (ties by value), else 0."""
    top = freq.orderBy(F.col("_cnt").desc(), F.col(key).asc()).limit(n).select(key, F.lit(1).alias(f"{key_alias(key)}_is_top10"))
    return freq.select(key).join(top, key, "left").na.fill(0, [f"{key_alias(key)}_is_top10"])


def rare_flag(freq: DataFrame, key: str = CAT, below: int = RARE_BELOW) -> DataFrame:
    return freq.select(key, (F.col("_cnt") < below).cast("int").alias(f"{key_alias(key)}_is_rare"))


def payment_one_hot(df: DataFrame, col: str = "payment_type") -> DataFrame:
    pt = F.coalesce(F.col(col), F.lit("not_defined"))
    return df.withColumn(col, pt).select("*", *scalar.one_hot(F.col(col), scalar.PAYMENT_TYPES, "payment_type_"))


def category_table(df: DataFrame, key: str = CAT, global_mean=None) -> DataFrame:
    """Per category: target encoding, frequency, top-10 and rare flags, from one aggregate over the rows."""
    g = F.lit(fit_mean(df) if global_mean is None else global_mean).cast("double")
    stats = cut_lineage(df.groupBy(key).agg(F.count(F.lit(1)).alias("_cnt"), F.count("review_score").alias("_n"), F.avg("review_score").alias("_m")))
    total = stats.agg(F.sum("_cnt")).first()[0] or 0
    a = F.lit(float(TARGET_ENC_ALPHA))
    enc = F.coalesce((F.col("_n") * F.col("_m") + a * g) / (F.col("_n") + a), g)
    name = key_alias(key)
    out = stats.join(top_flag(stats, key), key, "left").join(rare_flag(stats, key), key, "left")
    return out.select(key, enc.alias(f"{name}_target_enc"), (F.col("_cnt") / F.lit(float(total))).alias(f"{name}_frequency"), f"{name}_is_top10", f"{name}_is_rare")


def join_categories(df: DataFrame, table: DataFrame, key: str = CAT) -> DataFrame:
    """The category table joined to the rows; broadcast once its size is known to be small, so that
    the rows are not shuffled on a few categories."""
    table = cut_lineage(table)
    small = table.count() * CATEGORY_ROW_BYTES <= CATEGORY_BROADCAST_BYTES
    return df.join(F.broadcast(table) if small else table, key, "left")


def categorical_features(df: DataFrame, key: str = CAT, ids: DataFrame | None = None, fit_on: DataFrame | None = None) -> DataFrame:
    """Target encoding, frequency, top-10 and rare flags, payment one-hot; with ``ids`` the category id too.

    They are fitted on ``fit_on``, the same rows before costly joins, when it is given.
    """
    known = lambda rows: rows.withColumn(key, F.coalesce(F.col(key), F.lit("unknown")))
    rows = known(df if fit_on is None else fit_on)
    g = fit_mean(rows)
    table = category_table(rows, key, g)
    table = table if ids is None else table.join(ids, key, "left")
    out = join_categories(known(df), table, key).withColumn("category_target_enc", F.coalesce(F.col("category_target_enc"), F.lit(g).cast("double")))
    return payment_one_hot(out)


# ---------------------------------------------------------------- entity aggregates
def user_features(df: DataFrame, user: str = USER, reference_ts=None) -> DataFrame:
    ref = fit_time_range(df)[1] if reference_ts is None else reference_ts
    s = df.groupBy(user).agg(
        F.count(ITEM).alias("user_total_purchases"),
        F.count_distinct(ITEM).alias("user_unique_products"),
        F.avg("review_score").alias("user_avg_review_score"),
        F.avg("price").alias("user_avg_price"),
        F.avg("freight_value").alias("user_avg_freight"),
        F.min(TS).alias("_first"),
        F.max(TS).alias("_last"),
        F.sum("has_review").alias("_reviews"),
    )
    return s.select(
        user,
        "user_total_purchases",
        "user_unique_products",
        "user_avg_review_score",
        "user_avg_price",
        "user_avg_freight",
        scalar.elapsed_days(F.col("_first"), F.col("_last")).alias("user_purchase_span_days"),
        scalar.elapsed_days(F.col("_last"), _ts_lit(ref)).alias("user_recency_days"),
        (F.col("user_unique_products") / F.col("user_total_purchases")).alias("user_diversity_index"),
        (F.col("_reviews") / F.col("user_total_purchases")).alias("user_review_rate"),
    )


def product_features(df: DataFrame, item: str = ITEM) -> DataFrame:
    s = df.groupBy(item).agg(
        F.count(USER).alias("product_popularity"),
        F.avg("review_score").alias("product_avg_review_score"),
        F.avg("price").alias("product_avg_price"),
        F.avg("freight_value").alias("product_avg_freight"),
        F.sum("has_review").alias("_reviews"),
    )
    # only the pairs of product and buyer are shuffled for the distinct count, not all sums with them
    pairs = df.select(F.col(item).alias("_item"), USER).where(F.col(USER).isNotNull()).distinct()
    buyers = pairs.groupBy("_item").agg(F.count(F.lit(1)).alias("_buyers"))
    s = s.join(buyers, F.col(item).eqNullSafe(F.col("_item")), "left").withColumn("product_unique_buyers", F.coalesce("_buyers", F.lit(0).cast("long")))
    return s.select(
        item,
        "product_popularity",
        "product_unique_buyers",
        "product_avg_review_score",
        "product_avg_price",
        "product_avg_freight",
        (F.col("_reviews") / F.col("product_popularity")).alias("product_review_rate"),
        (F.col("product_unique_buyers") / F.col("product_popularity")).alias("product_buyer_diversity"),
    )


def dense_ids(df: DataFrame, col: str, name: str) -> DataFrame:
    """(value, 0-based consecutive id) ordered by value; computed on distinct values only."""
    return global_index(df.select(col).distinct(), [col], name)


def dense_ids_many(df: DataFrame, pairs) -> dict[str, DataFrame]:
    """Dense ids for several integer / string columns with one range shuffle and one checkpoint.

    Distinct values of every column are stacked as (kind, number, text) rows, indexed once in
    that order, and each kind's first index is subtracted (a K-row table).
    """
    types = dict(df.dtypes)
    parts = []
    for k, (col, _) in enumerate(pairs):
        is_text = types[col] == "string"
        parts.append(df.select(
            F.lit(k).alias("_k"),
            (F.lit(None).cast("long") if is_text else F.col(col).cast("long")).alias("_num"),
            (F.col(col) if is_text else F.lit(None).cast("string")).alias("_txt"),
        ).distinct())
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)
    indexed = global_index(stacked, ["_k", "_num", "_txt"], "_idx")
    first = indexed.groupBy("_k").agg(F.min("_idx").alias("_first"))
    ided = indexed.join(F.broadcast(first), "_k").withColumn("_id", F.col("_idx") - F.col("_first"))
    out = {}
    for k, (col, name) in enumerate(pairs):
        src = F.col("_txt") if types[col] == "string" else F.col("_num").cast(types[col])
        out[col] = ided.filter(F.col("_k") == k).select(src.alias(col), F.col("_id").alias(name))
    return out


def entity_ids(df: DataFrame) -> dict[str, DataFrame]:
    """Dense ids of users, products and categories (missing categories are 'unknown')."""
    df = df.withColumn(CAT, F.coalesce(F.col(CAT), F.lit("unknown")))
    pairs = [(USER, "user_id"), (ITEM, "product_id_idx"), (CAT, "category_id")]
    types = dict(df.dtypes)
    if all(types[c] in ("string", "bigint", "int") for c, _ in pairs):
        return dense_ids_many(df, pairs)
    return {c: dense_ids(df, c, n) for c, n in pairs}


# ---------------------------------------------------------------- stage
def featurize(df: DataFrame, p99=None, first_ts=None, last_ts=None) -> DataFrame:
    """All intermediate features (before the final column selection).

    Statistics and dense id of an entity stand in one table, so the rows are joined
    three times: with users, products and categories (broadcast when small). What follows from
    a row alone is added after the shuffled joins, so that they move the raw columns only.
    """
    if first_ts is None or last_ts is None:
        first_ts, last_ts = fit_time_range(df)
    p99 = fit_p99(df) if p99 is None else p99
    ids = entity_ids(df)
    out = df.join(user_features(df, reference_ts=last_ts).join(ids[USER], USER, "left"), USER, "left")
    out = out.join(product_features(df).join(ids[ITEM], ITEM, "left"), ITEM, "left")
    out = numeric_features(out, p99)
    out = temporal_features(out, first_ts)
    return categorical_features(out, ids=ids[CAT], fit_on=df)


def select_final(df: DataFrame, drop_price_log: bool = False) -> DataFrame:
    """Fixed 42 columns (41 without price_log); numbers null → 0, strings → 'unknown', rating kept null."""
    cols = [c for c in FINAL_COLUMNS if not (drop_price_log and c == "price_log")]
    types = dict(df.dtypes)
    out = []
    for c in cols:
        if c == "review_score":
            out.append(F.col(c))
        elif types[c] == "string":
            out.append(F.coalesce(F.col(c), F.lit("unknown")).alias(c))
        else:
            out.append(F.coalesce(F.col(c), F.lit(0).cast(types[c])).alias(c))
    return df.select(*out)


def price_log_redundant(df: DataFrame, threshold: float = 0.95) -> bool:
    """The source drops price_log when corr(price, price_log) exceeds the threshold."""
    r = df.agg(F.corr("price", F.log1p("price"))).first()[0]
    return r is not None and r > threshold


def features(df: DataFrame, drop_price_log: bool | None = False) -> DataFrame:
    """Full 42-column feature table. ``drop_price_log=None`` decides it from the data."""
    if drop_price_log is None:
        drop_price_log = price_log_redundant(df)
    return select_final(featurize(df), drop_price_log)
