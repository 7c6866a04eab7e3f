"""Prepare stage: raw tables → one row per (user, product, category).

At scale the three order-keyed tables (orders, items, payments) are joined first so
they share one hash partitioning on ``order_id``; the status filter is written after
the joins, as in the source pipeline, and Catalyst pushes it into the orders scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

USER, ITEM, CAT = "customer_unique_id", "product_id", "product_category_name_english"
INTERACTION_KEYS = (USER, ITEM, CAT)
TS = "order_purchase_timestamp"


def null_nan(c: Column) -> Column:
    """pandas treats NaN as missing; Spark keeps them apart. Map NaN to null."""
    return F.nanvl(c, F.lit(None).cast("double"))


def first_non_null(value: str, order: Column) -> Column:
    """pandas ``first``: the value of the earliest row (by ``order``) where it is not null."""
    return F.min_by(F.col(value), F.when(F.col(value).isNotNull(), order))


def dedup_payments(payments: DataFrame, key: str = "order_id", order_cols=("payment_sequential",)) -> DataFrame:
    """One row per order; each column keeps its own first non-null value (rows can mix).

    ``order_cols`` give the row order (file order in the source); extra tie-breaking
    columns listed there are dropped from the output.
    """
    order_cols = list(order_cols)
    order = F.struct(*[F.col(c) for c in order_cols])
    others = [c for c in payments.columns if c != key and c not in order_cols]
    return payments.groupBy(key).agg(
        F.min(order_cols[0]).alias(order_cols[0]), *[first_non_null(c, order).alias(c) for c in others]
    )


def join_orders_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    return orders.join(items, "order_id", "inner")


def join_customers(df: DataFrame, customers: DataFrame) -> DataFrame:
    return df.join(customers, "customer_id", "inner")


def join_products(df: DataFrame, products: DataFrame) -> DataFrame:
    return df.join(products, "product_id", "inner")


def join_reviews_left(df: DataFrame, reviews: DataFrame, on=("order_id",)) -> DataFrame:
    """Left join, not deduplicated: an order with two reviews doubles its rows."""
    return df.join(reviews, list(on), "left")


def join_translation_left(df: DataFrame, translation: DataFrame) -> DataFrame:
    """Left join on the category; products, not order lines, meet the translation where both are at hand."""
    return df.join(translation, "product_category_name", "left")


def join_payments_left(df: DataFrame, payments: DataFrame) -> DataFrame:
    return df.join(dedup_payments(payments), "order_id", "left")


def merge_tables(t: dict, few_orders: bool = False) -> DataFrame:
    """The six joins. Customers and payments meet the orders, which are fewer and narrower than their
    lines, so the lines are shuffled twice: with the products while they are narrow, then with their
    orders; the other way round with ``few_orders``, as a filter on orders then leaves fewer lines."""
    orders, payments, reviews, customers, items = (t.get(x) for x in ("orders", "payments", "reviews", "customers", "items"))
    products = t["products"]
    if t.get("translation") is not None and "product_category_name" in products.columns:
        # the dimension takes the translation: rows are never shuffled on a category
        products = join_translation_left(products, t["translation"])
    df = join_customers(orders, customers)
    if payments is not None:
        df = join_payments_left(df, payments)
    df = join_orders_items(df, items if few_orders else join_products(items, products))
    if reviews is not None:
        df = join_reviews_left(df, reviews)
    if few_orders:
        df = join_products(df, products)
    # columns stand as the joins one after the other would leave them, keys first
    rows = ["order_id"]
    for side in (orders, items, payments, reviews):
        rows += [c for c in (side.columns if side is not None else []) if c != "order_id"]
    for key, side in (("customer_id", customers), ("product_id", products)):
        rows = [key, *[c for c in rows if c != key], *[c for c in side.columns if c != key]]
    return df.select(*rows)


def filter_status(df: DataFrame, col: str = "order_status", value: str = "delivered") -> DataFrame:
    return df.filter(F.col(col) == F.lit(value))


def with_has_review(df: DataFrame, score: str = "review_score") -> DataFrame:
    return df.withColumn(score, null_nan(F.col(score).cast("double"))).withColumn(
        "has_review", F.col(score).isNotNull().cast("int")
    )


def fill_category(df: DataFrame, col: str = CAT, value: str = "unknown") -> DataFrame:
    if col not in df.columns:
        return df.withColumn(col, F.lit(value))
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(value)))


def parse_ts(df: DataFrame, col: str = TS, fmt: str | None = None) -> DataFrame:
    """String → timestamp without zone. ANSI mode makes bad input fail the job."""
    c = F.col(col)
    if dict(df.dtypes)[col] == "string":
        c = F.to_timestamp_ntz(c, F.lit(fmt)) if fmt else F.to_timestamp_ntz(c)
    return df.withColumn(col, c.cast("timestamp_ntz"))


def clean(df: DataFrame) -> DataFrame:
    return parse_ts(fill_category(with_has_review(df)))


def aggregate_interactions(df: DataFrame, keys=INTERACTION_KEYS, order_cols=("order_id",)) -> DataFrame:
    """One group-by: mean score, first price, mean freight, first payment, last time, any review, rows.

    Single ``agg`` instead of two group-bys and a re-join; partial aggregation runs
    before the shuffle, so a hot user or product only sends one row per map task.
    """
    if "payment_type" not in df.columns:
        df = df.withColumn("payment_type", F.lit("unknown"))
    order = F.struct(*[F.col(c) for c in order_cols])
    return (
        df.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(
            F.avg("review_score").alias("review_score"),
            first_non_null("price", order).alias("price"),
            F.avg(null_nan(F.col("freight_value"))).alias("freight_value"),
            first_non_null("payment_type", order).alias("payment_type"),
            F.max(TS).alias(TS),
            F.max("has_review").alias("has_review"),
            F.count(F.lit(1)).alias("purchase_count"),
        )
    )


def build_interactions(t: dict, order_cols=("order_id",), status: str = "delivered") -> DataFrame:
    """Full prepare stage as one lazy plan: joins → delivered → clean → aggregate."""
    merged = merge_tables(t, few_orders=True)
    return aggregate_interactions(clean(filter_status(merged, value=status)), order_cols=order_cols)


def validation_report(df: DataFrame) -> DataFrame:
    """Rows, distinct users/products/categories, sparsity, null reviews, mean count, date range."""
    s = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(USER).alias("n_users"),
        F.count_distinct(ITEM).alias("n_products"),
        F.count_distinct(CAT).alias("n_categories"),
        F.count_if(F.col("review_score").isNull()).alias("null_reviews"),
        F.avg("purchase_count").alias("mean_purchase_count"),
        F.min(TS).alias("min_date"),
        F.max(TS).alias("max_date"),
    )
    cells = F.col("n_users").cast("double") * F.col("n_products").cast("double")
    return s.withColumn(
        "sparsity", F.when(cells > 0, F.lit(1.0) - F.col("n_rows") / cells).otherwise(F.lit(0.0))
    )


def sparsity(df: DataFrame, user: str = USER, item: str = ITEM) -> DataFrame:
    s = df.agg(
        F.count(F.lit(1)).alias("n_interactions"),
        F.count_distinct(user).alias("n_users"),
        F.count_distinct(item).alias("n_items"),
    )
    cells = F.col("n_users").cast("double") * F.col("n_items").cast("double")
    return s.select(
        "*",
        cells.alias("n_cells"),
        (F.lit(1.0) - F.col("n_interactions") / cells).alias("sparsity"),
        (F.col("n_interactions") / cells).alias("density"),
    )


def k_core(df: DataFrame, min_user: int = 5, min_item: int = 5, user: str = USER, item: str = ITEM, buckets: int | None = None):
    """Repeat (drop users with < min_user rows, then items with < min_item rows) until stable.

    The first round is a group-by and a semi join a side. What survives is written as two
    adjacency tables, by user and by item, in ``buckets`` of hashed nodes (by default one per
    65,536 rows, 8 to 4,096), with a table of degrees a side. From then on a round takes the nodes that fell below their threshold,
    reads only the buckets that hold them and lowers the degrees at the other end, so an
    edge is read when its user goes and when its item goes, not in every round. Edges of
    nodes gone earlier may be met again; they only lower degrees of nodes that are gone.
    Rows with a null user or item go in the first round. Returns (df, stats); ``edges`` in
    stats are the distinct pairs after the first round, ``edges_read`` those in the buckets read.
    """
    from recspark.session import Tables, cut_lineage

    least = {"u": max(1, min_user), "i": max(1, min_item)}
    r = df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(user).alias("u"), F.count_distinct(item).alias("i")).first()
    n0, u0, i0 = r["n"], r["u"], r["i"]
    buckets = buckets or min(4096, max(8, n0 >> 16))
    rows = df.select(F.col(user).alias("u"), F.col(item).alias("i"))
    for side in ("u", "i"):
        counted = rows.groupBy(side).agg(F.count(F.lit(1)).alias("_c"))
        rows = rows.join(counted.where(F.col("_c") >= least[side]).select(side), side, "left_semi")
    tables = Tables(df.sparkSession)
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(buckets)).cast("int")
    edges, state, held = {}, {}, {}
    pairs = rows.groupBy("u", "i").agg(F.count(F.lit(1)).alias("n"))
    for side, other in (("u", "i"), ("i", "u")):
        dealt = pairs.withColumn("bucket", bucket(side))
        # a range may end inside a node, so a node with very many edges is several files
        dealt = dealt.repartitionByRange("bucket", side, other).sortWithinPartitions("bucket", side)
        edges[side], _ = pairs, _ = tables.write(dealt, by=["bucket"])
        sizes = edges[side].groupBy("bucket").agg(F.count(F.lit(1)).alias("pairs"), F.sum("n").alias("rows")).collect()
        held[side] = {x["bucket"]: x["pairs"] for x in sizes}
        state[side] = edges[side].groupBy(F.col(side).alias("node")).agg(F.sum("n").alias("degree"))
    n1 = sum(x["rows"] for x in sizes)
    paths = {"u": None, "i": None}

    def settle(side: str, lost: DataFrame | None) -> tuple[DataFrame, list[int]]:
        """Lower the side's degrees; returns its nodes now below the threshold and their buckets."""
        now = state[side]
        if lost is not None:
            now = now.join(lost, "node", "left").select("node", (F.col("degree") - F.coalesce("lost", F.lit(0))).alias("degree"))
        seen = Observation()
        now = now.withColumn("gone", F.col("degree") < least[side])
        now = now.observe(seen, F.collect_set(F.when(F.col("gone"), bucket("node"))).alias("buckets"))
        before = paths[side]
        now, paths[side] = tables.write(now)
        if before:
            tables.drop(before)
        state[side] = now.where("not gone").select("node", "degree")
        return now.where("gone").select("node"), list(seen.get["buckets"])

    rounds, read = 1, 0
    changed = n1 < n0
    going = settle("u", None) if changed else (None, [])
    while changed:
        rounds += 1
        if not going[1]:
            break
        for side, other in (("u", "i"), ("i", "u")):
            gone, hit = going
            if not hit:
                break
            read += sum(held[side][b] for b in hit)
            met = edges[side].where(F.col("bucket").isin(hit)).join(gone.withColumnRenamed("node", side), side)
            going = settle(other, met.groupBy(F.col(other).alias("node")).agg(F.sum("n").alias("lost")))
    out = df
    if changed:
        for side, column in (("u", user), ("i", item)):
            out = out.join(state[side].select(F.col("node").alias(column)), column, "left_semi")
    out = cut_lineage(out.select(*df.columns))
    n1, u1, i1 = out.count(), state["u"].count(), state["i"].count()
    stats = {
        "initial_rows": n0, "initial_users": u0, "initial_products": i0, "iterations": rounds,
        "final_rows": n1, "final_users": u1, "final_products": i1,
        "initial_sparsity": 1 - n0 / (u0 * i0) if u0 and i0 else 0.0,
        "final_sparsity": 1 - n1 / (u1 * i1) if u1 and i1 else 0.0,
        "edges": sum(held["u"].values()), "edges_read": read,
    }
    tables.drop(tables.folder)
    return out, stats
