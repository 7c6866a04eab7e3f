"""Exploratory statistics as aggregates: counts, shares, quantiles, histograms, correlations.

Quantiles are exact (linear interpolation, the pandas definition) through
``order.exact_quantiles``; everything else is one or two group-bys with partial
aggregation, so hot values never gather in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.functions import scalar
from recspark.operators.order import exact_quantiles, grouped_quantiles, unpivoted
from recspark.operators.prepare import CAT, TS, USER

# Right-closed bins and labels for entity histograms.
USER_BINS = ([0, 1, 2, 3, 4, math.inf], ["1", "2", "3", "4", "5+"])
PRODUCT_BINS = ([0, 1, 5, 10, 50, math.inf], ["1", "2-5", "6-10", "11-50", "51+"])
COUNT_BINS = ([0, 1, 2, 3, 4, math.inf], ["1", "2", "3", "4", "5+"])


def _total(df: DataFrame) -> int:
    return df.count()


def value_counts(df: DataFrame, col: str, normalize: bool = True, dropna: bool = False) -> DataFrame:
    """Rows per value (nulls included unless ``dropna``) and their share of the counted rows."""
    src = df.filter(F.col(col).isNotNull()) if dropna else df
    counts = src.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if not normalize:
        return counts
    total = _total(src)
    return counts.withColumn("share", F.col("count") / F.lit(float(total)))


def describe(df: DataFrame, cols, probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """count, mean, std (sample), min, quantiles, max — one row per column."""
    long = unpivoted(df, cols)
    x = F.col("value")
    base = long.groupBy("column").agg(F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"))
    names = [f"p{int(round(p * 100))}" for p in probs]
    qs = grouped_quantiles(long, "column", "value", probs).select("column", *[F.col(f"q{j}").alias(c) for j, c in enumerate(names)])
    return base.join(qs, "column", "left").select("column", "count", "mean", "std", "min", *names, "max")


def sentiment_share(df: DataFrame, col: str = "review_score") -> DataFrame:
    """Percent of rows rated ≥4, exactly 3, ≤2, and missing."""
    s = F.col(col)
    pct = lambda cond: (F.avg(F.when(cond, 1.0).otherwise(0.0)) * 100.0)
    return df.agg(
        pct(s >= 4).alias("pct_positive"), pct(s == 3).alias("pct_neutral"),
        pct(s <= 2).alias("pct_negative"), pct(s.isNull()).alias("pct_missing"),
    )


def top_share(df: DataFrame, col: str = CAT, ns=(5, 10), top: int = 15) -> DataFrame:
    """Share (%) of each of the ``top`` most frequent values, with cumulative shares of the top n."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).first()[0] or 0
    ranked = counts.orderBy(F.col("count").desc(), F.col(col).asc()).limit(max(top, *ns))
    from pyspark.sql import Window

    w = Window.orderBy(F.col("count").desc(), F.col(col).asc())
    r = ranked.select(col, "count", F.row_number().over(w).alias("rank"))
    r = r.withColumn("pct", F.col("count") * 100.0 / F.lit(float(total)))
    r = r.withColumn("cum_pct", F.sum("pct").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return r.filter(F.col("rank") <= top)


def missing_report(df: DataFrame) -> DataFrame:
    """Per column: null count, null %, type; plus the number of fully duplicated rows."""
    spark = df.sparkSession
    n = df.count()
    nulls = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]).first()
    distinct_rows = df.distinct().count()
    rows = [(c, int(nulls[c]), (100.0 * nulls[c] / n) if n else 0.0, t, n - distinct_rows) for c, t in df.dtypes]
    return spark.createDataFrame(rows, "column string, n_null bigint, pct_null double, dtype string, n_duplicate_rows bigint")


def volume_by(df: DataFrame, bucket, name: str) -> DataFrame:
    return df.groupBy(bucket.alias(name)).agg(F.count(F.lit(1)).alias("n"))


def volume_by_month(df: DataFrame, ts: str = TS) -> DataFrame:
    return volume_by(df, scalar.year_month(F.col(ts)), "year_month")


def volume_by_hour_dow(df: DataFrame, ts: str = "ts") -> DataFrame:
    h = df.groupBy(F.lit("hour").alias("kind"), F.hour(ts).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    d = df.groupBy(F.lit("day_of_week").alias("kind"), scalar.weekday_mon0(F.col(ts)).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return h.unionByName(d)


def pivot_year_month(df: DataFrame, ts: str = TS) -> DataFrame:
    base = df.select(F.year(ts).alias("year"), F.month(ts).alias("month"))
    p = base.groupBy("year").pivot("month", list(range(1, 13))).count().na.fill(0)
    return p.select("year", *[F.col(str(m)).cast("bigint").alias(f"m{m:02d}") for m in range(1, 13)])


def crosstab_pct(df: DataFrame, a, b: str, values=(0, 1), a_name: str = "a") -> DataFrame:
    """Row-normalised percentages of ``b`` values within each ``a`` value."""
    base = df.select(a.alias(a_name), F.col(b))
    p = base.groupBy(a_name).pivot(b, list(values)).count().na.fill(0)
    total = sum(F.col(str(v)) for v in values)
    return p.select(a_name, *[(F.col(str(v)) * 100.0 / total).alias(f"{b}_{v}") for v in values])


def entity_histogram(df: DataFrame, key: str, edges, labels, name: str) -> DataFrame:
    """Rows per entity, bucketed right-closed; percent of entities per bucket."""
    per = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    b = per.groupBy(scalar.bucketize(F.col("_n"), edges, labels).alias("bucket")).agg(F.count(F.lit(1)).alias("n_entities"))
    total = per.count()
    return b.select(F.lit(name).alias("entity"), "bucket", "n_entities", (F.col("n_entities") * 100.0 / F.lit(float(total))).alias("pct"))


def value_histogram(df: DataFrame, col: str, edges, labels, name: str) -> DataFrame:
    b = df.groupBy(scalar.bucketize(F.col(col), edges, labels).alias("bucket")).agg(F.count(F.lit(1)).alias("n_entities"))
    total = df.count()
    return b.select(F.lit(name).alias("entity"), "bucket", "n_entities", (F.col("n_entities") * 100.0 / F.lit(float(total))).alias("pct"))


def repeat_share(df: DataFrame, col: str = "purchase_count") -> DataFrame:
    return df.agg((F.avg(F.when(F.col(col) > 1, 1.0).otherwise(0.0)) * 100.0).alias("pct_repeat"))


def buyer_split(df: DataFrame, user: str = USER) -> DataFrame:
    per = df.groupBy(user).agg(F.count(F.lit(1)).alias("_n"))
    return per.agg(
        F.count_if(F.col("_n") == 1).alias("one_time_buyers"),
        F.count_if(F.col("_n") >= 2).alias("repeat_buyers"),
        (F.avg(F.when(F.col("_n") == 1, 1.0).otherwise(0.0)) * 100.0).alias("pct_one_time"),
    )


def safe_corr(a, b):
    """Pearson on rows where both are present; null (not an error) when either is constant."""
    x = F.when(b.isNotNull(), a.cast("double"))
    y = F.when(a.isNotNull(), b.cast("double"))
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))


def pearson(df: DataFrame, a: str, b: str) -> DataFrame:
    """Correlation on rows where both are present."""
    return df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).agg(
        F.corr(a, b).alias("pearson"), F.count(F.lit(1)).alias("n")
    )


def correlation_matrix(df: DataFrame, cols) -> dict[tuple[str, str], float | None]:
    """Pearson r for every column pair.

    Columns without nulls go through one MLlib correlation job (a distributed Gramian);
    pairs touching a column with nulls are computed pairwise-complete, as pandas does,
    with plain aggregates. Constant columns give None.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    cols = list(cols)
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    full = [c for c in cols if nulls[c] == 0]
    out: dict[tuple[str, str], float | None] = {}
    if len(full) > 1:
        data = df.select(*[F.col(c).cast("double").alias(c) for c in full])
        vec = VectorAssembler(inputCols=full, outputCol="_v").transform(data).select("_v")
        m = Correlation.corr(vec, "_v", "pearson").first()[0].toArray()
        for i, a in enumerate(full):
            for j in range(i + 1, len(full)):
                v = float(m[i, j])
                out[(a, full[j])] = None if math.isnan(v) else v
    partial = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:] if nulls[a] > 0 or nulls[b] > 0]
    if partial:
        r = df.agg(*[safe_corr(F.col(a), F.col(b)).alias(f"p{i}") for i, (a, b) in enumerate(partial)]).first()
        for i, key in enumerate(partial):
            out[key] = r[f"p{i}"]
    return out


def correlation_pairs(df: DataFrame, cols, threshold: float = 0.95) -> DataFrame:
    """Column pairs (in the given column order) with |Pearson r| above the threshold."""
    spark = df.sparkSession
    cols = list(cols)
    m = correlation_matrix(df, cols)
    rows = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            r = m.get((a, b))
            if r is not None and abs(r) > threshold:
                rows.append((a, b, float(r)))
    return spark.createDataFrame(rows, "feature_a string, feature_b string, r double")


def constant_features(df: DataFrame, cols) -> DataFrame:
    """Columns whose sample variance is 0 or that have at most one distinct value."""
    spark = df.sparkSession
    # at most one distinct value is min = max: no distinct count, so no row is copied per column
    r = df.agg(
        *[F.var_samp(F.col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(cols)],
        *[(F.min(c) == F.max(c)).alias(f"same{i}") for i, c in enumerate(cols)],
        *[F.count(c).alias(f"n{i}") for i, c in enumerate(cols)],
    ).first()
    one = lambda i: r[f"n{i}"] == 0 or r[f"same{i}"]
    rows = [(c, r[f"v{i}"], 0 if r[f"n{i}"] == 0 else 1) for i, c in enumerate(cols) if one(i)]
    return spark.createDataFrame(rows, "feature string, variance double, n_distinct bigint")


def skewness_adjusted(c) -> F.Column:
    """pandas-style (bias-adjusted) skewness from Spark's population skewness."""
    n = F.count(c).cast("double")
    return F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2)


def skew_report(df: DataFrame, cols) -> DataFrame:
    """One aggregate over the unpivoted columns."""
    return unpivoted(df, cols, "feature", "_x").groupBy("feature").agg(skewness_adjusted(F.col("_x")).alias("skew"))


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over [min, max]; the max falls into the last bin (numpy rule)."""
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    x = F.col(col).cast("double")
    width = (hi - lo) / bins if hi is not None and hi > lo else 1.0
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    counts = df.filter(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(
        "bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_hi"), "n",
    )


def iqr_bounds(df: DataFrame, col: str):
    """Q1 - 1.5 IQR and Q3 + 1.5 IQR; (None, None) without a value."""
    q1, q3 = exact_quantiles(df, col, [0.25, 0.75])[1]
    if q1 is None:
        return None, None
    iqr = q3 - q1
    return q1 - 1.5 * iqr, q3 + 1.5 * iqr


def iqr_outliers(df: DataFrame, col: str) -> DataFrame:
    """Rows outside the bounds; none where there are no bounds."""
    lo, hi = iqr_bounds(df, col)
    if lo is None:
        return df.limit(0)
    return df.filter((F.col(col) < F.lit(lo)) | (F.col(col) > F.lit(hi)))


def iqr_outlier_share(df: DataFrame, cols) -> DataFrame:
    """Per column: bounds, values, outliers and their percentage, all columns in one pass."""
    long = unpivoted(df, cols).where("value is not null and not isnan(value)")
    q = grouped_quantiles(long, "column", "value", [0.25, 0.75])
    bounds = q.select("column", (F.col("q0") - 1.5 * (F.col("q1") - F.col("q0"))).alias("lower"), (F.col("q1") + 1.5 * (F.col("q1") - F.col("q0"))).alias("upper"))
    out = F.count_if((F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper")))
    # one row per column: small whatever the table's size
    return long.join(F.broadcast(bounds), "column").groupBy("column", "lower", "upper").agg(F.count("*").alias("n"), out.alias("n_outliers")).withColumn(
        "outlier_pct", F.col("n_outliers") * 100.0 / F.col("n"))


def cap_quantile(df: DataFrame, col: str, q: float = 0.99) -> DataFrame:
    cap = exact_quantiles(df, col, [q])[1][0]
    return df.filter(F.col(col) <= F.lit(cap))


def group_quantiles(df: DataFrame, key: str, x, probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """Exact quantiles of ``x`` per value of ``key``, all groups in one pass."""
    base = df.select(F.col(key), x.cast("double").alias("_x")).filter(F.col(key).isNotNull() & F.col("_x").isNotNull())
    q = grouped_quantiles(base, key, "_x", probs)
    return q.select(key, F.col("n").cast("bigint").alias("n"), *[F.col(f"q{j}").alias(f"p{int(round(p * 100))}") for j, p in enumerate(probs)])


def category_rank(df: DataFrame, key: str, value: str, n: int = 10) -> DataFrame:
    return (
        df.groupBy(key).agg(F.avg(value).alias("mean_value"), F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("mean_value").desc(), F.col(key).asc())
        .limit(n)
    )
