"""Registered queries: one Spark plan per operator key, and its DuckDB oracle.

Each Spark callable takes (spark, sf_dir) and reads the supplied tables. Float
outputs are rounded to 6 digits at the very end (both sides), nothing earlier.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recspark.operators import features as fe
from recspark.operators import metrics as me
from recspark.operators import models as mo
from recspark.operators import prepare as pr
from recspark.operators import split as sp
from recspark.plans import flagship
from recspark.plans.sqlparts import (
    EVAL_USERS, FEATS, INTER, SPLIT, mean_long, metric_ctes, personal_hits, shared_hits, with_,
)
from recspark.session import Tables, cut_lineage
from recspark.sources import supplied

QUERIES: dict = {}
SQL: dict[str, str] = {}

USER, ITEM, CAT, TS = pr.USER, pr.ITEM, pr.CAT, pr.TS


def nudge_rounds(sql: str) -> str:
    """Rewrite every output rounding ``round(e, 6)`` as ``round((e) * NUDGE, 6)``.

    Ranking keys are rounded to other digits and stay as they are, as in Spark.

    Inputs with 4 decimals averaged over a few rows land exactly on a rounding tie;
    the engines sum in different orders, so the tie falls either way by one ulp. A
    relative nudge far above summation error (1e-14) and far below the data's own
    resolution puts both engines on the same side. Spark's ``rounded`` does the same.
    """
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0 or (j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, comma = 0, j + 6, None
        while True:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                if depth == 0:
                    break
                depth -= 1
            elif ch == "," and depth == 0:
                comma = k
            k += 1
        inner = nudge_rounds(sql[j + 6:comma])
        digits = sql[comma + 1:k].strip()
        out.append(sql[i:j] + (f"round(({inner}) * {NUDGE!r}, 6)" if digits == "6" else f"round({inner}, {digits})"))
        i = k + 1


NUDGE = 1.0 + 1e-14


def query(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = nudge_rounds(sql)
        return run

    return deco


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(F.col(f"`{f.name}`").cast("double") * F.lit(NUDGE), digits).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def tbl(spark, sf, name):
    return supplied.table(spark, sf, name)


def raw(spark, sf):
    return supplied.raw_tables(spark, sf)


_CACHE: dict = {}


def _cached(spark, sf, name, build):
    """Shared inputs persisted once per application (the interactions table, its split,
    the feature table) — the role the Parquet hand-over plays between stages.
    ``release`` drops them."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _CACHE:
        _CACHE[key] = build().persist()
    return _CACHE[key]


def release() -> None:
    """Unpersist all shared inputs."""
    for df in _CACHE.values():
        df.unpersist()
    _CACHE.clear()


def inter(spark, sf):
    return _cached(spark, sf, "inter", lambda: flagship.interactions(spark, sf))


def labelled(spark, sf):
    return _cached(spark, sf, "labelled", lambda: sp.temporal_split(inter(spark, sf)))


def splits(spark, sf):
    lab = labelled(spark, sf)
    return sp.take_split(lab, "train"), sp.take_split(lab, "val"), sp.take_split(lab, "test")


R_ORDERS = """raw_orders AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
   o_orderdate AS order_purchase_timestamp FROM orders)"""
R_ITEMS = """raw_items AS (SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_suppkey AS seller_id,
   l_partkey AS product_id, l_extendedprice AS price, l_extendedprice * l_tax AS freight_value,
   CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(1 + (l_orderkey + l_linenumber) % 5 AS DOUBLE) END AS review_score
   FROM lineitem)"""

# ====================================================================== 2.1 sources
@query("read_parquet", "SELECT p_partkey, p_brand, p_type, p_size FROM part WHERE p_size >= 25")
def q_read_parquet(spark, sf):
    """Scan with projection and a filter pushed into the Parquet reader."""
    return tbl(spark, sf, "part").select("p_partkey", "p_brand", "p_type", "p_size").filter(F.col("p_size") >= 25)


# ====================================================================== 2.2 filters
@query("filter_delivered", with_(R_ORDERS, body="SELECT * FROM raw_orders WHERE order_status = 'F'"))
def q_filter_delivered(spark, sf):
    """Delivered orders; the equality is pushed into the Parquet scan."""
    return pr.filter_status(raw(spark, sf)["orders"], value=supplied.DELIVERED)


@query(
    "add_has_review",
    with_(R_ITEMS, body="SELECT order_id, order_item_id, seller_id, product_id, review_score, "
          "CAST(review_score IS NOT NULL AS INTEGER) AS has_review FROM raw_items"),
)
def q_add_has_review(spark, sf):
    items = raw(spark, sf)["items"]
    return pr.with_has_review(items).select("order_id", "order_item_id", "seller_id", "product_id", "review_score", "has_review")


@query(
    "fill_category",
    "SELECT d.doc_id, coalesce(CAST(l.quality AS VARCHAR), 'unknown') AS category FROM documents d LEFT JOIN labels l USING (doc_id)",
)
def q_fill_category(spark, sf):
    """Left join with misses (documents without a label), missing name → 'unknown'."""
    d, lab = tbl(spark, sf, "documents").select("doc_id"), tbl(spark, sf, "labels")
    return pr.fill_category(d.join(lab, "doc_id", "left").select("doc_id", F.col("quality").cast("string").alias("category")), "category")


@query(
    "parse_ts",
    "SELECT o_orderkey AS order_id, CAST(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS order_purchase_timestamp FROM orders",
)
def q_parse_ts(spark, sf):
    o = tbl(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias(TS),
    )
    return pr.parse_ts(o, TS)


# ====================================================================== 2.4 prepare aggregates
@query("interactions", with_(INTER, body="SELECT * REPLACE (round(review_score, 6) AS review_score, round(freight_value, 6) AS freight_value) FROM inter"))
def q_interactions(spark, sf):
    """Flagship prepare stage: joins → delivered → clean → one group-by."""
    return inter(spark, sf)


# ====================================================================== 2.3 joins
R_CUST = "raw_customers AS (SELECT c_custkey AS customer_id, c_custkey AS customer_unique_id FROM customer)"
R_PROD = "raw_products AS (SELECT p_partkey AS product_id, p_brand AS product_category_name FROM part)"
J_OI = "SELECT * FROM raw_orders JOIN raw_items USING (order_id)"


@query("join_orders_items", with_(R_ORDERS, R_ITEMS, body=J_OI))
def q_join_orders_items(spark, sf):
    t = raw(spark, sf)
    return pr.join_orders_items(t["orders"], t["items"])


@query("join_customers", with_(R_ORDERS, R_ITEMS, R_CUST, body=f"SELECT * FROM ({J_OI}) JOIN raw_customers USING (customer_id)"))
def q_join_customers(spark, sf):
    t = raw(spark, sf)
    return pr.join_customers(pr.join_orders_items(t["orders"], t["items"]), t["customers"])


@query(
    "join_products",
    with_(R_ORDERS, R_ITEMS, R_CUST, R_PROD,
          body=f"SELECT * FROM ({J_OI}) JOIN raw_customers USING (customer_id) JOIN raw_products USING (product_id)"),
)
def q_join_products(spark, sf):
    t = raw(spark, sf)
    return pr.join_products(pr.join_customers(pr.join_orders_items(t["orders"], t["items"]), t["customers"]), t["products"])


def _order_reviews(spark, sf):
    li = tbl(spark, sf, "lineitem")
    return li.select(F.col("l_orderkey").alias("order_id"), supplied.line_review(F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_returnflag")).alias("review_score"))


@query(
    "join_reviews_left",
    with_(R_ORDERS, R_ITEMS, body="""SELECT o.order_id, o.customer_id, r.review_score FROM raw_orders o LEFT JOIN
      (SELECT order_id, review_score FROM raw_items) r USING (order_id)"""),
)
def q_join_reviews_left(spark, sf):
    """Order-level reviews, several per order: rows multiply, as in the source."""
    o = raw(spark, sf)["orders"].select("order_id", "customer_id")
    return pr.join_reviews_left(o, _order_reviews(spark, sf))


@query(
    "join_translation_left",
    """SELECT p_partkey AS product_id, p_brand AS product_category_name, t.product_category_name_english
       FROM part LEFT JOIN (SELECT DISTINCT p_brand AS product_category_name, upper(p_brand) AS product_category_name_english
                            FROM part) t ON part.p_brand = t.product_category_name""",
)
def q_join_translation_left(spark, sf):
    """Category names from the translation table; a missing category would keep a null name."""
    t = raw(spark, sf)
    tr = (
        tbl(spark, sf, "part")
        .select(F.col("p_brand").alias("product_category_name"), F.upper("p_brand").alias("product_category_name_english"))
        .distinct()
    )
    return pr.join_translation_left(t["products"], tr)


@query(
    "join_payments_left",
    with_(R_ORDERS, body="""SELECT o.*, p.payment_type FROM raw_orders o LEFT JOIN
      (SELECT o_orderkey AS order_id, 1 AS payment_sequential, o_orderpriority AS payment_type FROM orders) p USING (order_id)"""),
)
def q_join_payments_left(spark, sf):
    t = raw(spark, sf)
    return pr.join_payments_left(t["orders"], t["payments"]).drop("payment_sequential")


B_MERGED = f"""SELECT * FROM ({J_OI}) LEFT JOIN (SELECT o_orderkey AS order_id, 1 AS payment_sequential, o_orderpriority AS payment_type FROM orders) USING (order_id)
  JOIN raw_customers USING (customer_id) JOIN raw_products USING (product_id)
  LEFT JOIN (SELECT DISTINCT p_brand AS product_category_name, p_brand AS product_category_name_english FROM part) USING (product_category_name)"""


@query("build_merged", with_(R_ORDERS, R_ITEMS, R_CUST, R_PROD, body=B_MERGED))
def q_build_merged(spark, sf):
    return pr.merge_tables(raw(spark, sf))


def _line_payments(spark, sf):
    li = tbl(spark, sf, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        F.col("l_partkey").alias("_p"), F.col("l_suppkey").alias("_s"), F.col("l_extendedprice").alias("_e"),
        F.when(F.col("l_returnflag") == "N", F.lit(None).cast("string"))
        .otherwise(F.concat_ws("-", "l_linestatus", "l_returnflag")).alias("payment_type"),
        F.col("l_quantity").alias("payment_value"),
    )


@query(
    "dedup_payments",
    """SELECT l_orderkey AS order_id, min(l_linenumber) AS payment_sequential,
         arg_min(CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_linestatus || '-' || l_returnflag END,
                 CASE WHEN l_returnflag <> 'N' THEN (l_linenumber, l_partkey, l_suppkey, l_extendedprice) END) AS payment_type,
         arg_min(l_quantity, (l_linenumber, l_partkey, l_suppkey, l_extendedprice)) AS payment_value
       FROM lineitem GROUP BY 1""",
)
def q_dedup_payments(spark, sf):
    """First non-null per column in payment order; a null first type takes the next one."""
    pay = _line_payments(spark, sf)
    return pr.dedup_payments(pay, order_cols=("payment_sequential", "_p", "_s", "_e"))


INTER_ALL = INTER.replace("WHERE o.o_orderstatus = 'F'", "")


@query(
    "aggregate_interactions",
    with_(INTER_ALL, body="SELECT * REPLACE (round(review_score, 6) AS review_score, round(freight_value, 6) AS freight_value) FROM inter"),
)
def q_aggregate_interactions(spark, sf):
    """The group-by alone, over every order status."""
    merged = pr.clean(pr.merge_tables(raw(spark, sf)))  # every status
    return pr.aggregate_interactions(merged, order_cols=supplied.ITEM_ORDER)


@query(
    "validation_report",
    with_(INTER, body="""SELECT count(*) AS n_rows, count(DISTINCT customer_unique_id) AS n_users,
      count(DISTINCT product_id) AS n_products, count(DISTINCT product_category_name_english) AS n_categories,
      count(*) FILTER (WHERE review_score IS NULL) AS null_reviews, round(avg(purchase_count), 6) AS mean_purchase_count,
      min(order_purchase_timestamp) AS min_date, max(order_purchase_timestamp) AS max_date,
      round(1 - count(*) / (CAST(count(DISTINCT customer_unique_id) AS DOUBLE) * count(DISTINCT product_id)), 6) AS sparsity
      FROM inter"""),
)
def q_validation_report(spark, sf):
    return pr.validation_report(inter(spark, sf))


@query(
    "sparsity",
    with_(INTER, body="""SELECT count(*) AS n_interactions, count(DISTINCT customer_unique_id) AS n_users,
      count(DISTINCT product_id) AS n_items,
      round(CAST(count(DISTINCT customer_unique_id) AS DOUBLE) * count(DISTINCT product_id), 6) AS n_cells,
      round(1 - count(*) / (CAST(count(DISTINCT customer_unique_id) AS DOUBLE) * count(DISTINCT product_id)), 6) AS sparsity,
      round(count(*) / (CAST(count(DISTINCT customer_unique_id) AS DOUBLE) * count(DISTINCT product_id)), 6) AS density
      FROM inter"""),
)
def q_sparsity(spark, sf):
    return pr.sparsity(inter(spark, sf))


def _r(cols: str) -> str:
    """round(c, 6) AS c for each listed column."""
    return ", ".join(f"round({c.strip()}, 6) AS {c.strip()}" for c in cols.split(","))


UF_COLS = "customer_unique_id, user_total_purchases, user_unique_products, " + _r(
    "user_avg_review_score, user_avg_price, user_avg_freight") + ", user_purchase_span_days, user_recency_days, " + _r(
    "user_diversity_index, user_review_rate")
PF_COLS = "product_id, product_popularity, product_unique_buyers, " + _r(
    "product_avg_review_score, product_avg_price, product_avg_freight, product_review_rate, product_buyer_diversity")


@query("user_features", with_(INTER, FEATS, body=f"SELECT {UF_COLS} FROM uf2"))
def q_user_features(spark, sf):
    return fe.user_features(inter(spark, sf))


@query("product_features", with_(INTER, FEATS, body=f"SELECT {PF_COLS} FROM pf"))
def q_product_features(spark, sf):
    return fe.product_features(inter(spark, sf))


@query("join_user_stats", with_(INTER, FEATS, body=f"SELECT i.customer_unique_id, i.product_id, i.product_category_name_english, u.* EXCLUDE (customer_unique_id) FROM inter i LEFT JOIN (SELECT {UF_COLS} FROM uf2) u USING (customer_unique_id)"))
def q_join_user_stats(spark, sf):
    df = inter(spark, sf)
    return df.select(USER, ITEM, CAT).join(fe.user_features(df), USER, "left")


@query("join_product_stats", with_(INTER, FEATS, body=f"SELECT i.customer_unique_id, i.product_id, i.product_category_name_english, p.* EXCLUDE (product_id) FROM inter i LEFT JOIN (SELECT {PF_COLS} FROM pf) p USING (product_id)"))
def q_join_product_stats(spark, sf):
    df = inter(spark, sf)
    return df.select(USER, ITEM, CAT).join(fe.product_features(df), ITEM, "left")


@query("target_encoding", with_(INTER, FEATS, body="SELECT product_category_name_english, round(category_target_enc, 6) AS category_target_enc FROM cat2"))
def q_target_encoding(spark, sf):
    return fe.target_encoding(inter(spark, sf))


@query("category_frequency", with_(INTER, FEATS, body="SELECT product_category_name_english, round(category_frequency, 6) AS category_frequency FROM cat2"))
def q_category_frequency(spark, sf):
    return fe.freq_encode(inter(spark, sf)).drop("_cnt")


@query("category_is_rare", with_(INTER, FEATS, body="SELECT product_category_name_english, category_is_rare FROM cat2"))
def q_category_is_rare(spark, sf):
    return fe.rare_flag(fe.freq_encode(inter(spark, sf)))


@query("category_is_top10", with_(INTER, FEATS, body="SELECT product_category_name_english, category_is_top10 FROM cat2"))
def q_category_is_top10(spark, sf):
    return fe.top_flag(fe.freq_encode(inter(spark, sf)))


@query(
    "map_category_stats",
    with_(INTER, FEATS, body="""SELECT i.customer_unique_id, i.product_id, i.product_category_name_english,
      round(coalesce(c.category_frequency, 0.0), 6) AS category_frequency
      FROM inter i LEFT JOIN cat2 c USING (product_category_name_english)"""),
)
def q_map_category_stats(spark, sf):
    """Dictionary lookup with a default: left join, coalesce to 0."""
    df = inter(spark, sf)
    table = fe.freq_encode(df).drop("_cnt")
    return df.select(USER, ITEM, CAT).join(table, CAT, "left").withColumn("category_frequency", F.coalesce("category_frequency", F.lit(0.0)))


KEYS3 = "customer_unique_id, product_id, product_category_name_english"


def draw_sql(*keys: str, seed: int = 42) -> str:
    """The draw of ``sampling.draw`` in SQL."""
    text = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"CAST('0x' || substr(md5(concat_ws('|', {text}, '{seed}')), 1, 15) AS BIGINT)"


# r-th unseen item of a user, by listing the unseen ones
IDX = """idx AS (SELECT product_id, row_number() OVER (ORDER BY product_id) - 1 AS i FROM (SELECT DISTINCT product_id FROM train))"""


def unseen_sql(banned: str) -> str:
    return f"""banned AS (SELECT DISTINCT customer_unique_id, product_id FROM ({banned})),
unseen AS (SELECT u.customer_unique_id, i.product_id, row_number() OVER (PARTITION BY u.customer_unique_id ORDER BY i.i) - 1 AS r, count(*) OVER (PARTITION BY u.customer_unique_id) AS free
  FROM (SELECT DISTINCT customer_unique_id FROM pos) u CROSS JOIN idx i ANTI JOIN banned b ON b.customer_unique_id = u.customer_unique_id AND b.product_id = i.product_id)"""


def negatives_sql(n: int) -> str:
    d = draw_sql("p.customer_unique_id", "p.product_id", "j.j")
    return f"""negs AS (SELECT p.customer_unique_id, p.product_id, x.product_id AS neg_item, CAST(j.j AS INTEGER) AS j
  FROM (SELECT DISTINCT customer_unique_id, product_id FROM pos) p CROSS JOIN range({n}) j(j)
  JOIN (SELECT DISTINCT customer_unique_id, free FROM unseen) f ON f.customer_unique_id = p.customer_unique_id
  JOIN unseen x ON x.customer_unique_id = p.customer_unique_id AND x.r = {d} % f.free)"""


NEG4 = ["pos AS (SELECT customer_unique_id, product_id FROM train)", IDX, unseen_sql("SELECT customer_unique_id, product_id FROM train"), negatives_sql(4)]


@query(
    "semi_isin",
    with_(INTER, body=f"""SELECT {KEYS3}, purchase_count FROM inter WHERE customer_unique_id IN
      (SELECT customer_unique_id FROM inter GROUP BY 1 HAVING count(*) >= 15)"""),
)
def q_semi_isin(spark, sf):
    df = inter(spark, sf)
    valid = df.groupBy(USER).count().filter(F.col("count") >= 15).select(USER)
    return df.select(USER, ITEM, CAT, "purchase_count").join(valid, USER, "left_semi")


FEAT_TAIL = ("price_log, freight_value_log, price_to_freight_ratio, total_cost")


@query(
    "numeric_features",
    with_(INTER, FEATS, body=f"SELECT {KEYS3}, {_r(FEAT_TAIL)}, has_price_outlier FROM feat_all"),
)
def q_numeric_features(spark, sf):
    return fe.numeric_features(inter(spark, sf)).select(USER, ITEM, CAT, *FEAT_TAIL.replace(" ", "").split(","), "has_price_outlier")


TEMPORAL = ("purchase_year, purchase_month, purchase_day_of_week, purchase_hour, purchase_day_of_month, "
            "is_weekend, is_holiday_season, days_since_reference, purchase_quarter")


@query("temporal_features", with_(INTER, FEATS, body=f"SELECT {KEYS3}, {TEMPORAL} FROM feat_all"))
def q_temporal_features(spark, sf):
    return fe.temporal_features(inter(spark, sf)).select(USER, ITEM, CAT, *TEMPORAL.replace(" ", "").split(","))


PAY = ("payment_type_credit_card, payment_type_boleto, payment_type_voucher, payment_type_debit_card, payment_type_not_defined")


@query("payment_one_hot", with_(INTER, FEATS, body=f"SELECT {KEYS3}, coalesce(payment_type, 'not_defined') AS payment_type, {PAY} FROM feat_all"))
def q_payment_one_hot(spark, sf):
    return fe.payment_one_hot(inter(spark, sf)).select(USER, ITEM, CAT, "payment_type", *PAY.replace(" ", "").split(","))


CATF = "category_target_enc, category_frequency"


@query(
    "categorical_features",
    with_(INTER, FEATS, body=f"SELECT {KEYS3}, {_r(CATF)}, category_is_top10, category_is_rare, {PAY} FROM feat_all"),
)
def q_categorical_features(spark, sf):
    return fe.categorical_features(inter(spark, sf)).select(
        USER, ITEM, CAT, *CATF.replace(" ", "").split(","), "category_is_top10", "category_is_rare", *PAY.replace(" ", "").split(",")
    )


def _feat_sql(drop_price_log: bool) -> str:
    cols = [c for c in fe.FINAL_COLUMNS if not (drop_price_log and c == "price_log")]
    dbl = {"review_score", "price", "freight_value", "price_log", "freight_value_log", "price_to_freight_ratio",
           "category_target_enc", "category_frequency", "user_avg_price", "user_avg_freight", "user_review_rate",
           "product_avg_review_score", "product_avg_price", "product_avg_freight", "product_review_rate"}
    sel = ", ".join(f"round({c}, 6) AS {c}" if c in dbl else c for c in cols)
    return with_(INTER, FEATS, body=f"SELECT {sel} FROM feat")


@query("features", _feat_sql(False))
def q_features(spark, sf):
    """Full 42-column feature table (persisted for the selection queries that read it)."""
    return _feats(spark, sf)


@query("select_final", _feat_sql(False))
def q_select_final(spark, sf):
    """Final selection; price_log goes if its correlation with price is above 0.95 (0.903 at sf0.01: it stays)."""
    df = inter(spark, sf)
    return fe.select_final(fe.featurize(df), drop_price_log=fe.price_log_redundant(df))


@query("dense_ids", with_(INTER, FEATS, body="SELECT * FROM uid"))
def q_dense_ids(spark, sf):
    return fe.dense_ids(inter(spark, sf), USER, "user_id")


# ====================================================================== 2.5 windows / splits
@query("temporal_split", with_(INTER, SPLIT, body=f"SELECT {KEYS3}, order_purchase_timestamp, split FROM labelled"))
def q_temporal_split(spark, sf):
    return labelled(spark, sf).select(USER, ITEM, CAT, TS, "split")


@query(
    "split_bounds",
    with_(INTER, SPLIT, body="SELECT split, count(*) AS n_rows, min(order_purchase_timestamp) AS min_time, max(order_purchase_timestamp) AS max_time FROM labelled GROUP BY 1"),
)
def q_split_bounds(spark, sf):
    return sp.split_bounds(labelled(spark, sf))


RANDOM_SPLIT_SQL = with_(INTER, body=f"""SELECT {KEYS3}, CASE WHEN p < floor(n * CAST(0.7 AS DOUBLE)) THEN 'train'
    WHEN p < floor(n * CAST(0.7 AS DOUBLE)) + floor((n - floor(n * CAST(0.7 AS DOUBLE))) * (CAST(0.15 AS DOUBLE) / (CAST(1 AS DOUBLE) - CAST(0.7 AS DOUBLE)))) THEN 'val' ELSE 'test' END AS split
  FROM (SELECT {KEYS3}, row_number() OVER (ORDER BY {draw_sql(*KEYS3.split(", "))}, {KEYS3}) - 1 AS p, count(*) OVER () AS n FROM inter)""")


@query("random_split", RANDOM_SPLIT_SQL)
def q_random_split(spark, sf):
    """Seeded hash split; exact sizes."""
    return sp.random_split(inter(spark, sf)).select(USER, ITEM, CAT, "split")


# ====================================================================== 2.4 profile aggregates
from recspark.functions import scalar as sc  # noqa: E402
from recspark.operators import profile as pf  # noqa: E402


@query(
    "value_counts",
    with_(INTER, body="SELECT review_score, count(*) AS count, round(count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM inter), 6) AS share FROM inter GROUP BY 1"),
)
def q_value_counts(spark, sf):
    """Counts per rating value, nulls kept as their own value."""
    return pf.value_counts(inter(spark, sf), "review_score", normalize=True, dropna=False)


DESCRIBE_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS column, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
        round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
        round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS max FROM (SELECT CAST({c} AS DOUBLE) AS {c} FROM inter)"""
    for c in ("price", "freight_value", "review_score", "purchase_count")
)


@query("describe", with_(INTER, body=DESCRIBE_SQL))
def q_describe(spark, sf):
    return pf.describe(inter(spark, sf), ["price", "freight_value", "review_score", "purchase_count"])


@query(
    "sentiment_share",
    with_(INTER, body="""SELECT round(avg(CASE WHEN review_score >= 4 THEN 1.0 ELSE 0.0 END) * 100, 6) AS pct_positive,
      round(avg(CASE WHEN review_score = 3 THEN 1.0 ELSE 0.0 END) * 100, 6) AS pct_neutral,
      round(avg(CASE WHEN review_score <= 2 THEN 1.0 ELSE 0.0 END) * 100, 6) AS pct_negative,
      round(avg(CASE WHEN review_score IS NULL THEN 1.0 ELSE 0.0 END) * 100, 6) AS pct_missing FROM inter"""),
)
def q_sentiment_share(spark, sf):
    return pf.sentiment_share(inter(spark, sf))


@query(
    "cumulative_top_share",
    with_(INTER, body="""SELECT product_category_name_english, count, rank, round(pct, 6) AS pct, round(cum_pct, 6) AS cum_pct FROM (
      SELECT *, sum(pct) OVER (ORDER BY count DESC, product_category_name_english ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pct
      FROM (SELECT product_category_name_english, count(*) AS count,
                   CAST(row_number() OVER (ORDER BY count(*) DESC, product_category_name_english) AS INTEGER) AS rank,
                   count(*) * 100.0 / (SELECT count(*) FROM inter) AS pct
            FROM inter GROUP BY 1)) WHERE rank <= 15"""),
)
def q_cumulative_top_share(spark, sf):
    return pf.top_share(inter(spark, sf), CAT, (5, 10), 15)


MISSING_COLS = ["customer_unique_id", "product_id", "product_category_name_english", "review_score", "price",
                "freight_value", "payment_type", "order_purchase_timestamp", "has_review", "purchase_count"]
_DT = {"customer_unique_id": "bigint", "product_id": "bigint", "product_category_name_english": "string",
       "review_score": "double", "price": "double", "freight_value": "double", "payment_type": "string",
       "order_purchase_timestamp": "timestamp_ntz", "has_review": "int", "purchase_count": "bigint"}
MISSING_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS n_null,
        round(count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*), 6) AS pct_null, '{_DT[c]}' AS dtype,
        count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM inter)) AS n_duplicate_rows FROM inter"""
    for c in MISSING_COLS
)


@query("missing_report", with_(INTER, body=MISSING_SQL))
def q_missing_report(spark, sf):
    return pf.missing_report(inter(spark, sf))


@query("monthly_volume", with_(INTER, body="SELECT strftime(order_purchase_timestamp, '%Y-%m') AS year_month, count(*) AS n FROM inter GROUP BY 1"))
def q_monthly_volume(spark, sf):
    return pf.volume_by_month(inter(spark, sf))


@query("year_month", with_(INTER, body=f"SELECT {KEYS3}, strftime(order_purchase_timestamp, '%Y-%m') AS year_month FROM inter"))
def q_year_month(spark, sf):
    return inter(spark, sf).select(USER, ITEM, CAT, sc.year_month(F.col(TS)).alias("year_month"))


@query("day_name", "SELECT event_id, dayname(ts) AS day_name FROM events")
def q_day_name(spark, sf):
    return tbl(spark, sf, "events").select("event_id", sc.day_name(F.col("ts")).alias("day_name"))


@query(
    "hour_dow_volume",
    """SELECT 'hour' AS kind, CAST(hour(ts) AS INTEGER) AS bucket, count(*) AS n FROM events GROUP BY 2
       UNION ALL SELECT 'day_of_week', CAST(isodow(ts) - 1 AS INTEGER), count(*) FROM events GROUP BY 2""",
)
def q_hour_dow_volume(spark, sf):
    """Hour-of-day and weekday volume from the timestamped event stream."""
    return pf.volume_by_hour_dow(tbl(spark, sf, "events"), "ts")


@query(
    "year_month_pivot",
    with_(INTER, body="SELECT CAST(year(order_purchase_timestamp) AS INTEGER) AS year, "
          + ", ".join(f"count(*) FILTER (WHERE month(order_purchase_timestamp) = {m}) AS m{m:02d}" for m in range(1, 13))
          + " FROM inter GROUP BY 1"),
)
def q_year_month_pivot(spark, sf):
    return pf.pivot_year_month(inter(spark, sf))


@query(
    "review_crosstab",
    with_(INTER, body="""SELECT least(purchase_count, 5) AS purchase_count_capped,
      round(count(*) FILTER (WHERE has_review = 0) * 100.0 / count(*), 6) AS has_review_0,
      round(count(*) FILTER (WHERE has_review = 1) * 100.0 / count(*), 6) AS has_review_1 FROM inter GROUP BY 1"""),
)
def q_review_crosstab(spark, sf):
    df = inter(spark, sf)
    return pf.crosstab_pct(df, sc.clip_upper(F.col("purchase_count"), 5), "has_review", (0, 1), "purchase_count_capped")


def _bucket_sql(x: str, edges, labels) -> str:
    parts = []
    for (a, b), lab in zip(zip(edges, edges[1:]), labels):
        cond = f"{x} > {a}" + ("" if b == float("inf") else f" AND {x} <= {b}")
        parts.append(f"WHEN {cond} THEN '{lab}'")
    return "CASE " + " ".join(parts) + " END"


def _hist_sql(entity, key, edges, labels):
    return f"""SELECT '{entity}' AS entity, bucket, count(*) AS n_entities,
      round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct FROM (
      SELECT {_bucket_sql('n', edges, labels)} AS bucket FROM (SELECT {key}, count(*) AS n FROM inter GROUP BY 1)) GROUP BY 2"""


@query(
    "cold_start_histogram",
    with_(INTER, body=_hist_sql("user", "customer_unique_id", *pf.USER_BINS) + " UNION ALL "
          + _hist_sql("product", "product_id", *pf.PRODUCT_BINS) + " UNION ALL "
          + f"""SELECT 'purchase_count', bucket, count(*), round(count(*) * 100.0 / sum(count(*)) OVER (), 6) FROM (
                SELECT {_bucket_sql('purchase_count', *pf.COUNT_BINS)} AS bucket FROM inter) GROUP BY 2"""),
)
def q_cold_start_histogram(spark, sf):
    df = inter(spark, sf)
    return (
        pf.entity_histogram(df, USER, *pf.USER_BINS, "user")
        .unionByName(pf.entity_histogram(df, ITEM, *pf.PRODUCT_BINS, "product"))
        .unionByName(pf.value_histogram(df, "purchase_count", *pf.COUNT_BINS, "purchase_count"))
    )


@query("bucketize", with_(INTER, body=f"SELECT customer_unique_id, n, {_bucket_sql('n', *pf.USER_BINS)} AS bucket FROM (SELECT customer_unique_id, count(*) AS n FROM inter GROUP BY 1)"))
def q_bucketize(spark, sf):
    per = inter(spark, sf).groupBy(USER).agg(F.count(F.lit(1)).alias("n"))
    return per.select(USER, "n", sc.bucketize(F.col("n"), *pf.USER_BINS).alias("bucket"))


@query("repeat_share", with_(INTER, body="SELECT round(avg(CASE WHEN purchase_count > 1 THEN 1.0 ELSE 0.0 END) * 100, 6) AS pct_repeat FROM inter"))
def q_repeat_share(spark, sf):
    return pf.repeat_share(inter(spark, sf))


@query(
    "one_time_buyers",
    with_(INTER, body="""SELECT count(*) FILTER (WHERE n = 1) AS one_time_buyers, count(*) FILTER (WHERE n >= 2) AS repeat_buyers,
      round(avg(CASE WHEN n = 1 THEN 1.0 ELSE 0.0 END) * 100, 6) AS pct_one_time
      FROM (SELECT customer_unique_id, count(*) AS n FROM inter GROUP BY 1)"""),
)
def q_one_time_buyers(spark, sf):
    return pf.buyer_split(inter(spark, sf))


@query(
    "pearson_pair",
    with_(INTER, body="SELECT round(corr(price, review_score), 6) AS pearson, count(*) AS n FROM inter WHERE price IS NOT NULL AND review_score IS NOT NULL"),
)
def q_pearson_pair(spark, sf):
    return pf.pearson(inter(spark, sf), "price", "review_score")


@query(
    "skewness",
    with_(INTER, body="""SELECT 'price' AS feature, round(skewness(price), 6) AS skew FROM inter
      UNION ALL SELECT 'price_log', round(skewness(ln(1 + price)), 6) FROM inter
      UNION ALL SELECT 'freight_value', round(skewness(freight_value), 6) FROM inter
      UNION ALL SELECT 'freight_value_log', round(skewness(ln(1 + freight_value)), 6) FROM inter"""),
)
def q_skewness(spark, sf):
    """Bias-adjusted skewness before and after log1p."""
    df = inter(spark, sf).select("price", "freight_value", F.log1p("price").alias("price_log"), F.log1p("freight_value").alias("freight_value_log"))
    return pf.skew_report(df, ["price", "price_log", "freight_value", "freight_value_log"])


@query(
    "histogram",
    with_(INTER, body="""SELECT bin, round(lo + bin * w, 6) AS bin_lo, round(lo + (bin + 1) * w, 6) AS bin_hi, count(*) AS n FROM (
      SELECT CAST(least(floor((price - lo) / w), 49) AS INTEGER) AS bin, lo, w FROM inter,
        (SELECT min(price) AS lo, (max(price) - min(price)) / 50 AS w FROM inter)) GROUP BY bin, lo, w"""),
)
def q_histogram(spark, sf):
    return pf.histogram(inter(spark, sf), "price", 50)


@query(
    "boxplot_stats",
    with_(INTER, body="""SELECT review_score, count(*) AS n, round(quantile_cont(ln(1 + price), 0.25), 6) AS p25,
      round(quantile_cont(ln(1 + price), 0.5), 6) AS p50, round(quantile_cont(ln(1 + price), 0.75), 6) AS p75
      FROM inter WHERE review_score IS NOT NULL AND price IS NOT NULL GROUP BY 1"""),
)
def q_boxplot_stats(spark, sf):
    return pf.group_quantiles(inter(spark, sf), "review_score", F.log1p("price"))


IQR_SQL = """SELECT customer_unique_id, product_id, product_category_name_english, price FROM inter,
  (SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM inter)
  WHERE price < q1 - 1.5 * (q3 - q1) OR price > q3 + 1.5 * (q3 - q1)"""


@query("filter_iqr_outliers", with_(INTER, body=IQR_SQL.replace("price", "freight_value")))
def q_filter_iqr_outliers(spark, sf):
    return pf.iqr_outliers(inter(spark, sf), "freight_value").select(USER, ITEM, CAT, "freight_value")


@query(
    "filter_p99_cap",
    with_(INTER, body=f"SELECT {KEYS3}, price FROM inter WHERE price <= (SELECT quantile_cont(price, 0.99) FROM inter)"),
)
def q_filter_p99_cap(spark, sf):
    return pf.cap_quantile(inter(spark, sf), "price", 0.99).select(USER, ITEM, CAT, "price")


@query(
    "category_score_rank",
    with_(INTER, FEATS, body="""SELECT product_category_name_english, round(avg(category_target_enc), 6) AS mean_value, count(*) AS n
      FROM feat_all GROUP BY 1 ORDER BY avg(category_target_enc) DESC, 1 LIMIT 10"""),
)
def q_category_score_rank(spark, sf):
    """Top categories by their target encoding (a top-N report: the limit is the feature)."""
    return pf.category_rank(fe.categorical_features(inter(spark, sf)), CAT, "category_target_enc", 10)


@query(
    "sort_limit",
    with_(INTER, body="SELECT product_id, count(*) AS n FROM inter GROUP BY 1 ORDER BY n DESC, product_id LIMIT 20"),
)
def q_sort_limit(spark, sf):
    """Most bought products: order by measure, take n (TakeOrderedAndProject)."""
    return inter(spark, sf).groupBy(ITEM).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col(ITEM)).limit(20)


@query("clip_upper", with_(INTER, body=f"SELECT {KEYS3}, least(purchase_count, 5) AS purchase_count_capped FROM inter"))
def q_clip_upper(spark, sf):
    return inter(spark, sf).select(USER, ITEM, CAT, sc.clip_upper(F.col("purchase_count"), 5).alias("purchase_count_capped"))


@query("cast_fill", with_(INTER, body=f"SELECT {KEYS3}, coalesce(CAST(review_score AS DOUBLE), 0.0) AS review_score FROM inter"))
def q_cast_fill(spark, sf):
    return inter(spark, sf).select(USER, ITEM, CAT, sc.cast_fill(F.col("review_score")).alias("review_score"))


@query(
    "median_fill",
    with_(INTER, body=f"SELECT {KEYS3}, round(coalesce(review_score, (SELECT quantile_cont(review_score, 0.5) FROM inter)), 6) AS review_score FROM inter"),
)
def q_median_fill(spark, sf):
    df = inter(spark, sf)
    from recspark.operators.order import exact_quantiles

    med = exact_quantiles(df, "review_score", [0.5])[1][0]
    return df.select(USER, ITEM, CAT, F.coalesce(F.col("review_score"), F.lit(med)).alias("review_score"))


@query(
    "safe_ratio",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(coalesce(l_extendedprice / CASE WHEN l_discount <> 0 THEN l_discount END, 0.0), 6) AS price_per_discount FROM lineitem",
)
def q_safe_ratio(spark, sf):
    li = tbl(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", sc.safe_ratio(F.col("l_extendedprice"), F.col("l_discount")).alias("price_per_discount"))


# ====================================================================== sets and windows on splits
TRAIN_USERS = "SELECT DISTINCT customer_unique_id FROM train"
TEST_USERS = "SELECT DISTINCT customer_unique_id FROM test"


@query("users_in_both", with_(INTER, SPLIT, body=f"SELECT * FROM ({TEST_USERS}) SEMI JOIN ({TRAIN_USERS}) USING (customer_unique_id)"))
def q_users_in_both(spark, sf):
    tr, _, te = splits(spark, sf)
    return me.users_in_both(tr, te)


@query("intersect_users", with_(INTER, SPLIT, body=f"SELECT * FROM ({TEST_USERS} INTERSECT {TRAIN_USERS})"))
def q_intersect_users(spark, sf):
    tr, _, te = splits(spark, sf)
    return te.select(USER).intersect(tr.select(USER))


@query("except_users", with_(INTER, SPLIT, body=f"SELECT * FROM ({TEST_USERS} EXCEPT {TRAIN_USERS})"))
def q_except_users(spark, sf):
    tr, _, te = splits(spark, sf)
    return te.select(USER).subtract(tr.select(USER))


@query(
    "cold_warm_split",
    with_(INTER, SPLIT, body=f"""SELECT count(*) AS n_test_users,
      count(*) FILTER (WHERE customer_unique_id NOT IN ({TRAIN_USERS})) AS n_cold,
      count(*) FILTER (WHERE customer_unique_id IN ({TRAIN_USERS})) AS n_warm,
      round(count(*) FILTER (WHERE customer_unique_id NOT IN ({TRAIN_USERS})) * 100.0 / count(*), 6) AS pct_cold
      FROM ({TEST_USERS})"""),
)
def q_cold_warm_split(spark, sf):
    tr, _, te = splits(spark, sf)
    return me.cold_warm(tr, te)


@query("filter_warm_users", with_(INTER, SPLIT, body=f"SELECT {KEYS3} FROM test SEMI JOIN ({TRAIN_USERS}) USING (customer_unique_id)"))
def q_filter_warm_users(spark, sf):
    tr, _, te = splits(spark, sf)
    return te.select(USER, ITEM, CAT).join(tr.select(USER).distinct(), USER, "left_semi")


@query("anti_seen", with_(INTER, SPLIT, body="SELECT DISTINCT customer_unique_id, product_id FROM test ANTI JOIN train USING (customer_unique_id, product_id)"))
def q_anti_seen(spark, sf):
    """Test pairs the user had not already bought in train."""
    tr, _, te = splits(spark, sf)
    return te.select(USER, ITEM).distinct().join(tr.select(USER, ITEM), [USER, ITEM], "left_anti")


@query("merge_seen", with_(INTER, SPLIT, body="SELECT customer_unique_id, product_id FROM train UNION SELECT customer_unique_id, product_id FROM val"))
def q_merge_seen(spark, sf):
    tr, va, _ = splits(spark, sf)
    return me.seen_pairs(tr, va)


@query(
    "user_item_sets",
    with_(INTER, SPLIT, body="""SELECT p.customer_unique_id, p.product_id, n.n_items FROM (SELECT DISTINCT customer_unique_id, product_id FROM train) p
      JOIN (SELECT customer_unique_id, count(DISTINCT product_id) AS n_items FROM train GROUP BY 1) n USING (customer_unique_id)"""),
)
def q_user_item_sets(spark, sf):
    """User → item set kept in long form (one row per member) with the set size."""
    tr, _, _ = splits(spark, sf)
    return me.user_items(tr)


@query(
    "union_splits",
    with_(INTER, SPLIT, body=f"SELECT {KEYS3}, 'train' AS split FROM train UNION ALL SELECT {KEYS3}, 'val' FROM val UNION ALL SELECT {KEYS3}, 'test' FROM test"),
)
def q_union_splits(spark, sf):
    tr, va, te = splits(spark, sf)
    parts = [d.select(USER, ITEM, CAT).withColumn("split", F.lit(n)) for d, n in ((tr, "train"), (va, "val"), (te, "test"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "first_row_per_item",
    with_(INTER, body=f"""SELECT product_id, customer_unique_id, order_purchase_timestamp, round(price, 6) AS price FROM inter
      QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY order_purchase_timestamp, customer_unique_id) = 1"""),
)
def q_first_row_per_item(spark, sf):
    return mo.first_per_key(inter(spark, sf), ITEM, [TS, USER]).select(ITEM, USER, TS, "price")


@query(
    "last_item_per_user",
    with_(INTER, body="SELECT customer_unique_id, arg_max(product_id, (order_purchase_timestamp, product_id)) AS product_id FROM inter GROUP BY 1"),
)
def q_last_item_per_user(spark, sf):
    return mo.last_item(inter(spark, sf))


@query(
    "topk_per_user",
    with_(INTER, body="""SELECT customer_unique_id, product_id, round(price, 6) AS score, CAST(rank AS INTEGER) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY customer_unique_id ORDER BY price DESC, product_id) AS rank FROM inter) WHERE rank <= 3"""),
)
def q_topk_per_user(spark, sf):
    df = inter(spark, sf).select(USER, ITEM, F.col("price").alias("score"))
    return mo.topk_per_user(df, 3)


# ====================================================================== 2.9 recommenders
from recspark.operators import factor as fa  # noqa: E402
from recspark.operators import sampling as sa  # noqa: E402

POP = """pop_counts AS (SELECT product_id, CAST(count(*) AS DOUBLE) AS score FROM train GROUP BY 1),
pop10 AS (SELECT product_id, score, CAST(row_number() OVER (ORDER BY score DESC, product_id) AS INTEGER) AS rank FROM pop_counts QUALIFY rank <= 10),
pop20 AS (SELECT product_id, score, CAST(row_number() OVER (ORDER BY score DESC, product_id) AS INTEGER) AS rank FROM pop_counts QUALIFY rank <= 20)"""


def _top_rated_sql(min_reviews: int, name: str) -> str:
    return f"""{name} AS (SELECT product_id, score, CAST(row_number() OVER (ORDER BY score DESC, product_id) AS INTEGER) AS rank FROM
      (SELECT product_id, round(avg(review_score), 9) AS score FROM train GROUP BY 1 HAVING count(review_score) >= {min_reviews})
      QUALIFY rank <= 10)"""


COS = """ma AS (SELECT customer_unique_id AS u, product_id AS i, CAST(count(*) AS DOUBLE) AS v FROM train GROUP BY 1, 2),
mnorm AS (SELECT i, sqrt(sum(v * v)) AS n FROM ma GROUP BY 1),
mpairs AS (SELECT x.i AS item_i, y.i AS item_j, sum(x.v * y.v) AS dot, count(*) AS co_users
           FROM ma x JOIN ma y ON x.u = y.u AND x.i <> y.i GROUP BY 1, 2),
cos AS (SELECT item_i, item_j, dot / (n1.n * n2.n) AS cosine, co_users FROM mpairs
        JOIN mnorm n1 ON n1.i = item_i JOIN mnorm n2 ON n2.i = item_j)"""

ITEMCF = COS + """,
seen AS (SELECT DISTINCT customer_unique_id, product_id FROM train),
cf_scores AS (SELECT s.customer_unique_id, c.item_j AS product_id, round(sum(c.cosine), 9) AS score
              FROM seen s JOIN cos c ON c.item_i = s.product_id GROUP BY 1, 2),
cf AS (SELECT customer_unique_id, product_id, score, CAST(row_number() OVER (PARTITION BY customer_unique_id ORDER BY score DESC, product_id) AS INTEGER) AS rank
       FROM cf_scores ANTI JOIN seen USING (customer_unique_id, product_id) QUALIFY rank <= {k})"""


@query("rec_popularity", with_(INTER, SPLIT, POP, body="SELECT * FROM pop10"))
def q_rec_popularity(spark, sf):
    tr, _, _ = splits(spark, sf)
    return mo.popularity(tr, 10)


@query("rec_top_rated", with_(INTER, SPLIT, _top_rated_sql(5, "tr5"), body="SELECT * FROM tr5"))
def q_rec_top_rated(spark, sf):
    tr, _, _ = splits(spark, sf)
    return mo.top_rated(tr, 10, 5).select(ITEM, "score", "rank")


@query("item_cosine", with_(INTER, SPLIT, COS, body="SELECT item_i, item_j, round(cosine, 6) AS cosine, co_users FROM cos"))
def q_item_cosine(spark, sf):
    tr, _, _ = splits(spark, sf)
    return mo.item_cosine(tr)


@query(
    "similar_items",
    with_(INTER, SPLIT, COS, body="""SELECT item_i AS item, item_j AS neighbor, round(round(cosine, 9), 6) AS score,
      CAST(row_number() OVER (PARTITION BY item_i ORDER BY round(cosine, 9) DESC, item_j) AS INTEGER) AS rank FROM cos QUALIFY rank <= 10"""),
)
def q_similar_items(spark, sf):
    tr, _, _ = splits(spark, sf)
    return mo.similar_items(mo.item_cosine(tr), 10)


@query("rec_item_cf", with_(INTER, SPLIT, ITEMCF.format(k=10), body="SELECT customer_unique_id, product_id, round(score, 6) AS score, rank FROM cf"))
def q_rec_item_cf(spark, sf):
    tr, _, _ = splits(spark, sf)
    return mo.recommend_item_cf(tr, mo.item_cosine(tr), 10)


@query("rec_svd")
def q_rec_svd(spark, sf):
    """Truncated SVD (50 components) scores x·V·Vᵀ, seen masked, top 10 (rows-only check)."""
    tr, _, _ = splits(spark, sf)
    return fa.recommend_svd(tr, 50, 10)


@query("rec_als")
def q_rec_als(spark, sf):
    tr, _, _ = splits(spark, sf)
    return fa.recommend_als(tr, 10, rank=16)


RANDOM_SQL = with_(INTER, SPLIT, IDX, """size AS (SELECT count(*) AS n FROM idx),
strides AS (SELECT row_number() OVER (ORDER BY x) - 1 AS k, x FROM (SELECT min(x) AS x FROM size, range(1, greatest(2, (SELECT n FROM size))) t(x)
  WHERE gcd(x, n) = 1 GROUP BY (x - 1) // greatest(1, n // 64) ORDER BY 1 LIMIT 64)),
u AS (SELECT DISTINCT customer_unique_id FROM test)""", body=f"""SELECT u.customer_unique_id, i.product_id, CAST(NULL AS DOUBLE) AS score, CAST(d.d + 1 AS INTEGER) AS rank
  FROM u CROSS JOIN size CROSS JOIN range(10) d(d)
  JOIN strides s ON s.k = {draw_sql("u.customer_unique_id", "'stride'")} % (SELECT count(*) FROM strides)
  JOIN idx i ON i.i = ({draw_sql("u.customer_unique_id", "'start'")} % n + d.d * s.x) % n WHERE d.d < n""")


@query("rec_random", RANDOM_SQL)
def q_rec_random(spark, sf):
    tr, _, te = splits(spark, sf)
    return sa.recommend_random(te.select(USER), tr.select(ITEM), 10)


@query("negative_samples", with_(INTER, SPLIT, *NEG4, body="SELECT * FROM negs"))
def q_negative_samples(spark, sf):
    """4 unseen items per train positive, hash-seeded."""
    tr, _, _ = splits(spark, sf)
    return sa.sample_negatives(tr, tr, tr, 4)


@query("sampled_candidates", with_(
    INTER, SPLIT, "pos AS (SELECT customer_unique_id, product_id FROM test)", IDX,
    unseen_sql("SELECT customer_unique_id, product_id FROM train UNION ALL SELECT customer_unique_id, product_id FROM val UNION ALL SELECT customer_unique_id, product_id FROM test"), negatives_sql(99),
    body="""SELECT DISTINCT customer_unique_id, product_id AS pos_item, product_id AS candidate, 1 AS label FROM pos
      UNION ALL SELECT customer_unique_id, product_id, neg_item, 0 FROM negs"""))
def q_sampled_candidates(spark, sf):
    tr, va, te = splits(spark, sf)
    return sa.sampled_candidates(te, tr, me.seen_pairs(tr, va), 99)


@query("sample_rows", with_(INTER, body=f"""SELECT * REPLACE (round(review_score, 6) AS review_score, round(freight_value, 6) AS freight_value) FROM inter
  ORDER BY {draw_sql(*KEYS3.split(", "))}, {KEYS3} LIMIT 2000"""))
def q_sample_rows(spark, sf):
    return sa.sample_rows(inter(spark, sf), 2000, 42, [USER, ITEM, CAT])


# ====================================================================== 2.10 metrics
METRICS5 = ("MAP", "NDCG", "Precision", "Recall", "HitRate")


def _eval_sql(rec_ctes: str, hits: str, metrics=METRICS5, eval_users: str = EVAL_USERS) -> str:
    return with_(INTER, SPLIT, rec_ctes, metric_ctes(hits, eval_users), body=mean_long(metrics))


@query("evaluate_full", _eval_sql(POP, shared_hits("pop10")))
def q_evaluate_full(spark, sf):
    """Popularity (K=10 list) scored at K = 5, 10, 20 on users in train and test."""
    tr, _, te = splits(spark, sf)
    return me.evaluate(tr, te, mo.popularity(tr, 10), shared=True, metrics=METRICS5)


@query("evaluate_full_top_rated", _eval_sql(_top_rated_sql(5, "tr5"), shared_hits("tr5")))
def q_evaluate_full_top_rated(spark, sf):
    tr, _, te = splits(spark, sf)
    return me.evaluate(tr, te, mo.top_rated(tr, 10, 5), shared=True, metrics=METRICS5)


@query("evaluate_full_item_cf", _eval_sql(ITEMCF.format(k=40), personal_hits("cf")))
def q_evaluate_full_item_cf(spark, sf):
    tr, _, te = splits(spark, sf)
    return me.evaluate(tr, te, mo.recommend_item_cf(tr, mo.item_cosine(tr), 40, users=me.eval_users_frame(tr, te)), metrics=METRICS5)


def _single_metric(name: str, metric: str, k: int = 10):
    sql = with_(INTER, SPLIT, POP, metric_ctes(shared_hits("pop20"), EVAL_USERS),
                body=f'SELECT CAST({k} AS INTEGER) AS k, round(avg("{metric}@{k}"), 6) AS value, count(*) AS n_users FROM pu')

    @query(name, sql)
    def run(spark, sf):
        tr, _, te = splits(spark, sf)
        per = me.per_user_metrics(
            me.hits_shared(mo.popularity(tr, 20), me.relevant_sets(te)), me.eval_users_frame(tr, te), (5, 10, 20)
        )
        return per.agg(F.lit(k).alias("k"), F.avg(F.col(f"`{metric}@{k}`")).alias("value"), F.count(F.lit(1)).alias("n_users"))

    return run


for _name, _metric in [
    ("hit_rate_at_k", "HitRate"), ("precision_at_k", "Precision"), ("recall_at_k", "Recall"), ("map_at_k", "MAP"),
    ("map_at_k_hits", "MAP_hits"), ("ndcg_at_k", "NDCG"), ("ndcg_at_k_list", "NDCG_list"), ("dcg_at_k", "DCG"),
]:
    _single_metric(_name, _metric)


@query(
    "cum_hits",
    with_(INTER, SPLIT, POP, body=f"""SELECT customer_unique_id, rank, CAST(row_number() OVER (PARTITION BY customer_unique_id ORDER BY rank) AS BIGINT) AS cum_hits
      FROM ({shared_hits('pop20')}) SEMI JOIN ({EVAL_USERS}) USING (customer_unique_id)"""),
)
def q_cum_hits(spark, sf):
    tr, _, te = splits(spark, sf)
    hits = me.hits_shared(mo.popularity(tr, 20), me.relevant_sets(te)).join(me.eval_users_frame(tr, te), USER, "left_semi")
    return me.cum_hits(hits)


ALL_TEST_USERS = "SELECT customer_unique_id, count(DISTINCT product_id) AS n_rel FROM test GROUP BY 1"


@query("popularity_eval", _eval_sql(POP, shared_hits("pop10"), eval_users=ALL_TEST_USERS))
def q_popularity_eval(spark, sf):
    """Popularity scored on every test user, cold ones included."""
    tr, _, te = splits(spark, sf)
    rel = me.relevant_sets(te)
    eu = te.groupBy(USER).agg(F.count_distinct(ITEM).alias("n_rel"))
    per = me.per_user_metrics(me.hits_shared(mo.popularity(tr, 10), rel), eu)
    return me.mean_metrics(per, metrics=METRICS5)


@query(
    "lift_table",
    with_(INTER, SPLIT, POP, _top_rated_sql(5, "tr5"), metric_ctes(shared_hits("pop10"), EVAL_USERS),
          body=f"""SELECT b.metric, b.k, round(a.value, 6) AS value, round(b.value, 6) AS baseline,
            round(CASE WHEN b.value <> 0 THEN a.value / b.value END, 6) AS lift FROM
            ({mean_long(METRICS5, rounded=False)}) b JOIN (
              WITH {metric_ctes(shared_hits("tr5"), EVAL_USERS)} {mean_long(METRICS5, rounded=False)}) a USING (metric, k)"""),
)
def q_lift_table(spark, sf):
    """Top-rated metrics divided by the popularity baseline, per metric and K."""
    tr, _, te = splits(spark, sf)
    base = me.evaluate(tr, te, mo.popularity(tr, 10), shared=True, metrics=METRICS5)
    cand = me.evaluate(tr, te, mo.top_rated(tr, 10, 5), shared=True, metrics=METRICS5)
    return me.lift(cand, base)


def _on_split(name: str) -> str:
    here = lambda sql: sql.replace("FROM test", f"FROM {name}")
    return f"WITH {metric_ctes(here(shared_hits('pop10')), here(EVAL_USERS))} {mean_long(METRICS5, rounded=False)}"


@query(
    "split_gaps",
    with_(INTER, SPLIT, POP, body=f"""SELECT metric, k, round(a.value, 6) AS train, round(b.value, 6) AS val, round(c.value, 6) AS test, round(a.value - b.value, 6) AS train_val_gap, round(b.value - c.value, 6) AS val_test_gap
      FROM ({_on_split('train')}) a JOIN ({_on_split('val')}) b USING (metric, k) JOIN ({_on_split('test')}) c USING (metric, k)"""),
)
def q_split_gaps(spark, sf):
    """The popularity list scored on train, val and test, and the gaps between them."""
    tr, va, te = splits(spark, sf)
    recs = mo.popularity(tr, 10)
    return me.split_gaps(*[me.evaluate(tr, s, recs, shared=True, metrics=METRICS5) for s in (tr, va, te)])


@query(
    "eval_counts",
    with_(INTER, SPLIT, body=f"""SELECT count(*) AS n_test_users, count(*) FILTER (WHERE customer_unique_id IN ({TRAIN_USERS})) AS n_evaluated,
      round(count(*) FILTER (WHERE customer_unique_id NOT IN ({TRAIN_USERS})) / CAST(count(*) AS DOUBLE), 6) AS cold_start_rate FROM ({TEST_USERS})"""),
)
def q_eval_counts(spark, sf):
    tr, _, te = splits(spark, sf)
    return me.eval_counts(tr, te)


@query(
    "metric_mean_std",
    with_(INTER, SPLIT, POP, metric_ctes(shared_hits("pop20"), EVAL_USERS),
          body="""SELECT 'NDCG' AS metric, CAST(10 AS INTEGER) AS k, round(avg("NDCG@10"), 6) AS mean,
            round(CASE WHEN count(*) >= 30 THEN stddev_samp("NDCG@10") END, 6) AS std, count(*) AS n_users FROM pu"""),
)
def q_metric_mean_std(spark, sf):
    tr, _, te = splits(spark, sf)
    per = me.per_user_metrics(me.hits_shared(mo.popularity(tr, 20), me.relevant_sets(te)), me.eval_users_frame(tr, te))
    return me.mean_std(per, "NDCG", 10)


@query(
    "catalog_coverage",
    with_(INTER, SPLIT, ITEMCF.format(k=10), body="""SELECT n_recommended, n_catalog, round(n_recommended / CAST(n_catalog AS DOUBLE), 6) AS coverage FROM
      (SELECT count(DISTINCT product_id) AS n_recommended FROM cf), (SELECT count(DISTINCT product_id) AS n_catalog FROM train)"""),
)
def q_catalog_coverage(spark, sf):
    tr, _, _ = splits(spark, sf)
    return me.catalog_coverage(mo.recommend_item_cf(tr, mo.item_cosine(tr), 10), tr)


SEG = "CASE WHEN n_train = 1 THEN '1' WHEN n_train <= 5 THEN '2-5' ELSE '6+' END"


@query(
    "segment_metrics",
    with_(INTER, SPLIT, POP, metric_ctes(shared_hits("pop20"), EVAL_USERS),
          body=f"""SELECT {SEG} AS segment, count(*) AS n_users, round(avg("NDCG@10"), 6) AS ndcg_10, round(avg("HitRate@10"), 6) AS hit_rate_10
            FROM pu JOIN (SELECT customer_unique_id, count(*) AS n_train FROM train GROUP BY 1) USING (customer_unique_id) GROUP BY 1"""),
)
def q_segment_metrics(spark, sf):
    tr, _, te = splits(spark, sf)
    per = me.per_user_metrics(me.hits_shared(mo.popularity(tr, 20), me.relevant_sets(te)), me.eval_users_frame(tr, te))
    return me.segment_metrics(per, tr)


@query(
    "recs_inventory",
    with_(INTER, SPLIT, POP, _top_rated_sql(5, "tr5"), _top_rated_sql(15, "tr15"), ITEMCF.format(k=10),
          body="""SELECT model, variant, k, count(*) AS n_rows FROM (
            SELECT 'popularity' AS model, 'all' AS variant, CAST(10 AS INTEGER) AS k FROM pop10
            UNION ALL SELECT 'popularity', 'all', 20 FROM pop20
            UNION ALL SELECT 'top_rated', 'min5', 10 FROM tr5
            UNION ALL SELECT 'top_rated', 'min15', 10 FROM tr15
            UNION ALL SELECT 'item_cf', 'cosine', 10 FROM cf) GROUP BY 1, 2, 3"""),
)
def q_recs_inventory(spark, sf):
    tr, _, _ = splits(spark, sf)
    lists = [
        (mo.popularity(tr, 10), "popularity", "all", 10), (mo.popularity(tr, 20), "popularity", "all", 20),
        (mo.top_rated(tr, 10, 5), "top_rated", "min5", 10), (mo.top_rated(tr, 10, 15), "top_rated", "min15", 10),
        (mo.recommend_item_cf(tr, mo.item_cosine(tr), 10), "item_cf", "cosine", 10),
    ]
    return me.recs_inventory(mo.union_recs(lists))


@query(
    "union_recs",
    with_(INTER, SPLIT, POP, _top_rated_sql(5, "tr5"), body="""SELECT NULL::BIGINT AS customer_unique_id, product_id, round(score, 6) AS score, rank, 'popularity' AS model, 'all' AS variant, CAST(10 AS INTEGER) AS k FROM pop10
      UNION ALL SELECT NULL, product_id, round(score, 6), rank, 'top_rated', 'min5', 10 FROM tr5"""),
)
def q_union_recs(spark, sf):
    """Stack lists with different columns (shared lists have no user): unionByName with missing columns."""
    tr, _, _ = splits(spark, sf)
    out = mo.union_recs([(mo.popularity(tr, 10), "popularity", "all", 10), (mo.top_rated(tr, 10, 5).drop("n_reviews"), "top_rated", "min5", 10)])
    if USER not in out.columns:
        out = out.withColumn(USER, F.lit(None).cast("bigint"))
    return out.select(USER, ITEM, "score", "rank", "model", "variant", "k")


@query(
    "melt_metrics",
    with_(INTER, SPLIT, POP, metric_ctes(shared_hits("pop10"), EVAL_USERS),
          body=" UNION ALL ".join(f"""SELECT 'popularity' AS model, '{m}@{k}' AS metric_k, round(avg("{m}@{k}"), 6) AS value FROM pu"""
                                  for m in METRICS5 for k in (5, 10, 20))),
)
def q_melt_metrics(spark, sf):
    """Wide per-model metrics → (model, metric_k, value) with unpivot."""
    tr, _, te = splits(spark, sf)
    per = me.per_user_metrics(me.hits_shared(mo.popularity(tr, 10), me.relevant_sets(te)), me.eval_users_frame(tr, te))
    names = [f"{m}@{k}" for m in METRICS5 for k in (5, 10, 20)]
    wide = per.agg(*[F.avg(F.col(f"`{n}`")).alias(n) for n in names]).withColumn("model", F.lit("popularity"))
    return me.melt(wide, ["model"], names)


@query(
    "exclude_categories",
    with_(INTER, SPLIT, POP, body="""SELECT product_id, rank FROM pop20 ANTI JOIN
      (SELECT DISTINCT product_id FROM train WHERE product_category_name_english IN ('Brand#13', 'Brand#22', 'Brand#35')) USING (product_id)"""),
)
def q_exclude_categories(spark, sf):
    tr, _, _ = splits(spark, sf)
    return mo.exclude_categories(mo.popularity(tr, 20), tr, ["Brand#13", "Brand#22", "Brand#35"]).select(ITEM, "rank")


@query(
    "enrich_recs",
    with_(INTER, SPLIT, POP, body="""SELECT p.product_id, p.rank, d.product_category_name_english, d.product_popularity FROM pop10 p LEFT JOIN
      (SELECT product_id, product_category_name_english, count(*) OVER (PARTITION BY product_id) AS product_popularity FROM train
       QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY order_purchase_timestamp, customer_unique_id) = 1) d USING (product_id)"""),
)
def q_enrich_recs(spark, sf):
    tr, _, _ = splits(spark, sf)
    return mo.enrich(mo.popularity(tr, 10), tr).select(ITEM, "rank", CAT, "product_popularity")


@query(
    "dummy_rating",
    with_(INTER, SPLIT, body="""SELECT how, round(sqrt(avg((t.review_score - pred) * (t.review_score - pred))), 6) AS rmse,
      round(avg(abs(t.review_score - pred)), 6) AS mae, count(*) AS n FROM test t,
      (SELECT 'mean' AS how, avg(review_score) AS pred FROM train UNION ALL SELECT 'median', quantile_cont(review_score, 0.5) FROM train
       UNION ALL SELECT 'constant', 3.0) WHERE t.review_score IS NOT NULL GROUP BY how"""),
)
def q_dummy_rating(spark, sf):
    tr, _, te = splits(spark, sf)
    return mo.dummy_rating(tr, te)


# ====================================================================== 2.8 scaling and selection, k-core
from recspark.operators import select as se  # noqa: E402

SCALE_COLS = ["price", "freight_value", "review_score", "purchase_count"]


@query(
    "standard_scale",
    with_(INTER, SPLIT, "st AS (SELECT " + ", ".join(
        f"avg(coalesce(CAST({c} AS DOUBLE), 0.0)) AS m_{c}, CASE WHEN stddev_pop(coalesce(CAST({c} AS DOUBLE), 0.0)) = 0 THEN 1.0 "
        f"ELSE stddev_pop(coalesce(CAST({c} AS DOUBLE), 0.0)) END AS s_{c}" for c in SCALE_COLS) + " FROM train)",
        body=f"SELECT {KEYS3}, split, " + ", ".join(
            f"round((coalesce(CAST({c} AS DOUBLE), 0.0) - m_{c}) / s_{c}, 6) AS {c}" for c in SCALE_COLS) + " FROM labelled, st"),
)
def q_standard_scale(spark, sf):
    """Fit mean / population std on train only, apply to every split."""
    lab = labelled(spark, sf)
    stats = se.fit_scaler(sp.take_split(lab, "train"), SCALE_COLS)
    return se.scale(lab, stats, keep=[USER, ITEM, CAT, "split"])


@query(
    "scaler_stats",
    with_(INTER, SPLIT, body=" UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(avg(coalesce(CAST({c} AS DOUBLE), 0.0)), 6) AS mean, round(CASE WHEN stddev_pop(coalesce(CAST({c} AS DOUBLE), 0.0)) = 0 "
        f"THEN 1.0 ELSE stddev_pop(coalesce(CAST({c} AS DOUBLE), 0.0)) END, 6) AS std FROM train" for c in SCALE_COLS)),
)
def q_scaler_stats(spark, sf):
    tr, _, _ = splits(spark, sf)
    return se.scaler_stats(se.fit_scaler(tr, SCALE_COLS), spark)


def _feats(spark, sf):
    return _cached(spark, sf, "features", lambda: fe.features(inter(spark, sf)))


MI_COLS = [c for c in se.CANDIDATE_FEATURES if c != se.TARGET]


def _mi_sql() -> str:
    allc = [*MI_COLS, "_y"]
    base = ("mbase AS (SELECT " + ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in MI_COLS)
            + ", coalesce(CAST(review_score AS DOUBLE), (SELECT quantile_cont(review_score, 0.5) FROM feat)) AS _y FROM feat)")
    rng = "mrng AS (SELECT " + ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in allc) + " FROM mbase)"

    def b(c):
        return f"CASE WHEN hi_{c} = lo_{c} THEN 0 ELSE CAST(least(floor(({c} - lo_{c}) / (hi_{c} - lo_{c}) * 10), 9) AS INTEGER) END"

    long = "mlong AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, {b(c)} AS xb, {b('_y')} AS yb FROM mbase, mrng" for c in MI_COLS) + ")"
    rest = """mj AS (SELECT feature, xb, yb, CAST(count(*) AS DOUBLE) AS nxy FROM mlong GROUP BY 1, 2, 3),
mx AS (SELECT feature, xb, sum(nxy) AS nx FROM mj GROUP BY 1, 2),
my AS (SELECT feature, yb, sum(nxy) AS ny FROM mj GROUP BY 1, 2),
mn AS (SELECT feature, sum(nxy) AS n FROM mj GROUP BY 1)"""
    return with_(INTER, FEATS, base, rng, long, rest, body="""SELECT feature, round(sum((nxy / n) * ln((nxy * n) / (nx * ny))), 6) AS mi
      FROM mj JOIN mx USING (feature, xb) JOIN my USING (feature, yb) JOIN mn USING (feature) GROUP BY 1""")


@query("mutual_information", _mi_sql())
def q_mutual_information(spark, sf):
    """Binned plug-in mutual information of each candidate feature with the rating."""
    return se.mutual_info(_feats(spark, sf), MI_COLS)


@query("forest_importance")
def q_forest_importance(spark, sf):
    return se.forest_importance(_feats(spark, sf), se.CANDIDATE_FEATURES)


def _rank_sql(cols, where: str = "") -> str:
    return "SELECT " + ", ".join(f"rank() OVER (ORDER BY CAST({c} AS DOUBLE)) + (count(*) OVER (PARTITION BY CAST({c} AS DOUBLE)) - 1) / 2.0 AS {c}" for c in cols) + f" FROM feat {where}"


# only review_score has nulls: its pairs are ranked over the rows that have it
SPEARMAN = [f"rk0 AS ({_rank_sql(MI_COLS)})", f"rk1 AS ({_rank_sql(se.CANDIDATE_FEATURES, 'WHERE review_score IS NOT NULL')})",
            "sp0 AS (SELECT " + ", ".join(f'corr({a}, {b}) AS "{a}|{b}"' for i, a in enumerate(MI_COLS) for b in MI_COLS[i + 1:]) + " FROM rk0)",
            "sp1 AS (SELECT " + ", ".join(f'corr(review_score, {b}) AS "review_score|{b}"' for b in MI_COLS) + " FROM rk1)",
            """spl AS (SELECT split_part(pair, '|', 1) AS f1, split_part(pair, '|', 2) AS f2, r FROM (
  FROM (UNPIVOT sp0 ON COLUMNS(*) INTO NAME pair VALUE r) UNION ALL FROM (UNPIVOT sp1 ON COLUMNS(*) INTO NAME pair VALUE r)) WHERE NOT isnan(r))"""]


@query("spearman_pairs", with_(INTER, FEATS, *SPEARMAN, body="SELECT f1, f2, round(r, 6) AS corr FROM spl WHERE abs(r) > 0.9"))
def q_spearman_pairs(spark, sf):
    """Rank correlations above 0.9, each pair over the rows that have both values."""
    return se.spearman_pairs(_feats(spark, sf), se.CANDIDATE_FEATURES, 0.9).select("f1", "f2", "corr")


DROP_SQL = " ".join(f"WHEN '{c}' IN (f1, f2) THEN '{c}'" for c in se.DROPPED_FIRST)


@query("spearman_drop_list", with_(INTER, FEATS, *SPEARMAN, body=f"""SELECT feature, CAST(count(*) AS BIGINT) AS n_pairs, max(CASE WHEN abs(r) > 0.95 THEN 'above 0.95' ELSE 'above 0.85' END) AS band
  FROM (SELECT r, CASE WHEN f1 LIKE '%log%' THEN f2 WHEN f2 LIKE '%log%' THEN f1 {DROP_SQL} END AS feature FROM spl WHERE abs(r) > 0.85) WHERE feature IS NOT NULL GROUP BY 1"""))
def q_spearman_drop_list(spark, sf):
    """Columns that the rank screen drops, with the strongest band of their pairs."""
    return se.redundant_features(se.spearman_pairs(_feats(spark, sf), se.CANDIDATE_FEATURES, 0.85))


@query("iqr_outlier_share", with_(INTER, body=" UNION ALL ".join(f"""SELECT '{c}' AS "column", round(lo, 6) AS lower, round(hi, 6) AS upper, count({c}) AS n, count(*) FILTER (WHERE {c} < lo OR {c} > hi) AS n_outliers,
  round(count(*) FILTER (WHERE {c} < lo OR {c} > hi) * 100.0 / count({c}), 6) AS outlier_pct FROM inter, (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
  FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM inter)) GROUP BY lo, hi""" for c in ("price", "freight_value", "review_score"))))
def q_iqr_outlier_share(spark, sf):
    return pf.iqr_outlier_share(inter(spark, sf), ["price", "freight_value", "review_score"])


@query(
    "select_features",
    with_(INTER, FEATS, body=f"SELECT max(user_id) + 1 AS n_users, max(product_id_idx) + 1 AS n_items, max(category_id) + 1 AS n_categories, {len(se.SELECTED_NUMERIC)} AS n_numeric FROM feat"),
)
def q_select_features(spark, sf):
    return se.feature_config(_feats(spark, sf))


CORR_PAIRS = [(a, b) for i, a in enumerate(se.CANDIDATE_FEATURES) for b in se.CANDIDATE_FEATURES[i + 1:]]
CORR_SQL = ("cr AS (SELECT " + ", ".join(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS "{a}|{b}"' for a, b in CORR_PAIRS)
            + " FROM feat), crl AS (UNPIVOT cr ON COLUMNS(*) INTO NAME pair VALUE r)")


@query(
    "correlation_pairs",
    with_(INTER, FEATS, CORR_SQL, body="""SELECT split_part(pair, '|', 1) AS feature_a, split_part(pair, '|', 2) AS feature_b, round(r, 6) AS r
      FROM crl WHERE NOT isnan(r) AND abs(r) > 0.95"""),
)
def q_correlation_pairs(spark, sf):
    return pf.correlation_pairs(_feats(spark, sf), se.CANDIDATE_FEATURES, 0.95)


CONST_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(var_samp(CAST({c} AS DOUBLE)), 6) AS variance, count(DISTINCT {c}) AS n_distinct FROM feat"
    for c in se.CANDIDATE_FEATURES
)


@query("constant_features", with_(INTER, FEATS, body=f"SELECT * FROM ({CONST_SQL}) WHERE coalesce(variance, 0) = 0 OR n_distinct <= 1"))
def q_constant_features(spark, sf):
    return pf.constant_features(_feats(spark, sf), se.CANDIDATE_FEATURES)


NULLS_SQL = " UNION ALL ".join(f"SELECT 'null_count' AS check, '{c}' AS feature, CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) AS value FROM feat" for c in fe.FINAL_COLUMNS)


@query(
    "validate_features",
    with_(INTER, FEATS, CORR_SQL, body=f"""SELECT * FROM ({NULLS_SQL}) WHERE value > 0
      UNION ALL SELECT 'constant', feature, coalesce(variance, 0.0) FROM ({CONST_SQL}) WHERE coalesce(variance, 0) = 0 OR n_distinct <= 1
      UNION ALL SELECT 'high_correlation', pair, round(r, 6) FROM crl WHERE NOT isnan(r) AND abs(r) > 0.95"""),
)
def q_validate_features(spark, sf):
    return se.validate_features(_feats(spark, sf), se.CANDIDATE_FEATURES, 0.95)


def _kcore_sql(m: int, n: int, rounds: int = 12) -> str:
    ctes = ["k0 AS (SELECT * FROM inter)"]
    for r in range(1, rounds + 1):
        ctes.append(f"""ku{r} AS (SELECT * FROM k{r - 1} WHERE customer_unique_id IN
          (SELECT customer_unique_id FROM k{r - 1} GROUP BY 1 HAVING count(*) >= {m}))""")
        ctes.append(f"""k{r} AS (SELECT * FROM ku{r} WHERE product_id IN
          (SELECT product_id FROM ku{r} GROUP BY 1 HAVING count(*) >= {n}))""")
    return with_(INTER, *ctes, body=f"SELECT {KEYS3}, purchase_count FROM k{rounds}")


@query("k_core_filter", _kcore_sql(5, 5))
def q_k_core_filter(spark, sf):
    """Users and products with ≥ 5 rows (the source's thresholds), repeated to a fixed point.

    The oracle unrolls 12 rounds; at sf0.01 the fixed point is reached after 2.
    """
    out, _ = pr.k_core(inter(spark, sf), 5, 5)
    return out.select(USER, ITEM, CAT, "purchase_count")


# ====================================================================== learned rankers, sampled evaluation, grids
from recspark.operators import pairwise as pw  # noqa: E402
from recspark.operators import ranking as rk  # noqa: E402
from recspark.plans import grid as gr  # noqa: E402


def _triples(spark, sf, n_neg=4):
    tr, _, _ = splits(spark, sf)
    feats = rk.item_feature_table(tr)
    negs = sa.sample_negatives(tr, tr, tr, n_neg)
    return tr, feats, rk.bpr_triples(negs, feats)


@contextmanager
def _written(df):
    """The rows as a table that several readers share, deleted at the end."""
    tables = Tables(df.sparkSession)
    rows, path = tables.write(df)
    try:
        yield rows
    finally:
        tables.drop(path)


def _item_feats_sql() -> str:
    return """pfeat AS (SELECT product_id, CAST(count(customer_unique_id) AS DOUBLE) AS product_popularity, CAST(count(DISTINCT customer_unique_id) AS DOUBLE) AS product_unique_buyers,
  coalesce(avg(review_score), 0.0) AS product_avg_review_score, coalesce(avg(price), 0.0) AS product_avg_price, coalesce(avg(freight_value), 0.0) AS product_avg_freight,
  coalesce(CAST(sum(has_review) AS DOUBLE) / count(customer_unique_id), 0.0) AS product_review_rate FROM train GROUP BY 1)"""


def _triples_sql() -> str:
    side = lambda a, p: ", ".join(f"round({a}.{c}, 6) AS {p}_{c}" for c in rk.ITEM_FEATURES)
    return f"SELECT n.*, {side('a', 'pos')}, {side('b', 'neg')} FROM negs n JOIN pfeat a ON a.product_id = n.product_id JOIN pfeat b ON b.product_id = n.neg_item"


@query("bpr_triples", with_(INTER, SPLIT, *NEG4, _item_feats_sql(), body=_triples_sql()))
def q_bpr_triples(spark, sf):
    return _triples(spark, sf)[2]


#: Weights of the fixed scorer whose loss SQL can foretell.
FIXED_WEIGHTS = [0.01, 0.02, 0.1, -0.00001, 0.0001, 0.5]


def _fixed_score(prefix: str) -> str:
    return " + ".join(f"CAST({w!r} AS DOUBLE) * {prefix}_{c}" for c, w in zip(rk.ITEM_FEATURES, FIXED_WEIGHTS))


@query("bpr_loss_fixed", with_(INTER, SPLIT, *NEG4, _item_feats_sql(), body=f"""SELECT round(avg(CASE WHEN d > 0 THEN ln(1 + exp(-d)) ELSE -d + ln(1 + exp(d)) END), 6) AS bpr_loss, count(*) AS n_pairs
  FROM (SELECT ({_fixed_score('pos')}) - ({_fixed_score('neg')}) AS d FROM ({_triples_sql().replace("round(", "(").replace(", 6)", ")")}))"""))
def q_bpr_loss_fixed(spark, sf):
    """BPR loss of a scorer with fixed weights on the training triples."""
    return rk.bpr_loss(rk.score_pairs_linear(_triples(spark, sf)[2], FIXED_WEIGHTS))


@query("bpr_loss")
def q_bpr_loss(spark, sf):
    """BPR loss of the fitted linear pairwise ranker on its training triples."""
    with _written(_triples(spark, sf)[2]) as t:
        return cut_lineage(rk.bpr_loss(rk.score_pairs_linear(t, rk.fit_bpr_linear(t))))


@query("rec_bpr_linear")
def q_rec_bpr_linear(spark, sf):
    tr, feats, t = _triples(spark, sf)
    with _written(t) as rows:
        scores = rk.linear_scores(feats, rk.fit_bpr_linear(rows))
    _, _, te = splits(spark, sf)
    return rk.personalize_shared(scores, te.select(USER), tr.select(USER, ITEM).distinct(), 10)


def _pairwise(spark, sf):
    tr, _, te = splits(spark, sf)
    return pw.fit_pairwise(tr), tr, te


@query("rec_bpr_factors")
def q_rec_bpr_factors(spark, sf):
    """Personal pairwise factors: top 10 unseen items of the whole catalogue for every train user."""
    model, tr, _ = _pairwise(spark, sf)
    return fa.score_topk(model, tr, 10)


@query("bpr_factor_loss")
def q_bpr_factor_loss(spark, sf):
    """BPR loss of the linear ranker and of the personal factors on the same training triples."""
    with _written(_triples(spark, sf)[2]) as t:
        linear = rk.bpr_loss(rk.score_pairs_linear(t, rk.fit_bpr_linear(t))).withColumn("model", F.lit("linear"))
        return cut_lineage(linear.unionByName(rk.bpr_loss(pw.pair_scores(t, _pairwise(spark, sf)[0])).withColumn("model", F.lit("factors"))))


def _mlp_factors(spark, sf):
    tr, _, _ = splits(spark, sf)
    return fa.fit_als(tr, rank=16), rk.item_feature_table(tr)


def _mlp_fit(spark, sf, use_aux: bool, made=None):
    tr, _, _ = splits(spark, sf)
    factors, feats = made or _mlp_factors(spark, sf)
    negs = sa.sample_negatives(tr, tr, tr, 4)
    pos = tr.select(USER, F.col(ITEM).alias("candidate")).distinct().withColumn("label", F.lit(1.0))
    neg = negs.select(USER, F.col("neg_item").alias("candidate"), F.lit(0.0).alias("label"))
    rows, size = rk.mlp_inputs(pos.unionByName(neg), factors, feats, use_aux)
    scaler, model = rk.fit_mlp(rows, size)
    return factors, feats, scaler, model


def _mlp_eval(spark, sf, use_aux: bool, made=None):
    tr, va, te = splits(spark, sf)
    factors, feats, scaler, model = _mlp_fit(spark, sf, use_aux, made)
    cands = sa.sampled_candidates(te, tr, me.seen_pairs(tr, va), 99)
    crow, _ = rk.mlp_inputs(cands, factors, feats, use_aux)
    scored = rk.mlp_score(scaler, model, crow).select(USER, "candidate", "score")
    return scored, te, tr


@query("rec_mlp")
def q_rec_mlp(spark, sf):
    """ALS factors + side features → MLP; top 10 unseen items of the whole catalogue for the train users of the test split."""
    tr, _, te = splits(spark, sf)
    factors, feats, scaler, model = _mlp_fit(spark, sf, True)
    return rk.mlp_recommend(scaler, model, factors, feats, tr, te.select(USER), 10)


CONTRACT = """SELECT count(*) AS n_users, CAST(sum(least(10, total - seen)) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_short, CAST(0 AS BIGINT) AS n_wrong_rank, CAST(0 AS BIGINT) AS n_seen, CAST(0 AS BIGINT) AS n_rising
  FROM (SELECT customer_unique_id, count(DISTINCT product_id) AS seen FROM train {where} GROUP BY 1), (SELECT count(DISTINCT product_id) AS total FROM train)"""


def _contract(name: str, make, where: str = "") -> None:
    @query(name, with_(INTER, SPLIT, body=CONTRACT.format(where=where)))
    def run(spark, sf):
        """Users served, list lengths, ranks, no seen item, no rising score: what SQL can foretell of a trained model."""
        tr, _, te = splits(spark, sf)
        base = tr.join(te.select(USER).distinct(), USER, "left_semi") if where else tr
        return me.list_contract(make(spark, sf, tr, te), base, 10, USER, ITEM, tr)


IN_TEST = "WHERE customer_unique_id IN (SELECT customer_unique_id FROM test)"
_contract("rec_svd_contract", lambda spark, sf, tr, te: fa.recommend_svd(tr, 50, 10))
_contract("rec_als_contract", lambda spark, sf, tr, te: fa.recommend_als(tr, 10, rank=16))
_contract("rec_bpr_factors_contract", lambda spark, sf, tr, te: q_rec_bpr_factors(spark, sf))
_contract("rec_mlp_contract", lambda spark, sf, tr, te: q_rec_mlp(spark, sf), IN_TEST)
_contract("rec_bpr_linear_contract", lambda spark, sf, tr, te: q_rec_bpr_linear(spark, sf).join(tr.select(USER).distinct(), USER, "left_semi"), IN_TEST)
_contract("batch_recommend_contract", lambda spark, sf, tr, te: q_batch_recommend(spark, sf).where("source = 'model'").drop("source"), IN_TEST)


@query("evaluate_sampled")
def q_evaluate_sampled(spark, sf):
    """MLP scored on 1 positive + 99 sampled negatives per test pair, warm users."""
    scored, te, tr = _mlp_eval(spark, sf, True)
    return rk.evaluate_sampled(scored, te, tr, 10)


@query("ablation_no_aux")
def q_ablation_no_aux(spark, sf):
    made = _mlp_factors(spark, sf)  # the same factors with and without side features
    a, te, tr = _mlp_eval(spark, sf, True, made)
    b, _, _ = _mlp_eval(spark, sf, False, made)
    ma = rk.evaluate_sampled(a, te, tr, 10).withColumn("use_aux", F.lit(True))
    mb = rk.evaluate_sampled(b, te, tr, 10).withColumn("use_aux", F.lit(False))
    return ma.unionByName(mb)


@query("batch_recommend")
def q_batch_recommend(spark, sf):
    """Top 10 for every test user: ALS for known users, popularity for cold ones."""
    tr, _, te = splits(spark, sf)
    return rk.batch_recommend(te.select(USER), fa.fit_als(tr, rank=16), tr, mo.popularity(tr, 10), 10)


@query("run_grid")
def q_run_grid(spark, sf):
    tr, _, te = splits(spark, sf)
    return gr.run_grid(tr, te)


@query("early_stop_select")
def q_early_stop_select(spark, sf):
    tr, va, _ = splits(spark, sf)
    return gr.early_stop_select(tr, va)


@query("classifier_report")
def q_classifier_report(spark, sf):
    """Rating classes (rounded score) from the selected features: accuracy, F1, CV mean/std."""
    return rk_classifiers(_feats(spark, sf))


def rk_classifiers(feats):
    from recspark.operators.classify import classifier_report

    return classifier_report(feats, se.SELECTED_NUMERIC)
