"""DuckDB oracle building blocks: the same semantics written as plain SQL over the
supplied tables, independent of the Spark code path."""

from __future__ import annotations

KS = (5, 10, 20)

INTER = """inter AS (
  SELECT c.c_custkey AS customer_unique_id, l.l_partkey AS product_id, p.p_brand AS product_category_name_english,
    avg(CASE WHEN l.l_returnflag = 'N' THEN NULL ELSE CAST(1 + (l.l_orderkey + l.l_linenumber) % 5 AS DOUBLE) END) AS review_score,
    arg_min(l.l_extendedprice, (l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_extendedprice)) AS price,
    avg(l.l_extendedprice * l.l_tax) AS freight_value,
    arg_min(o.o_orderpriority, CASE WHEN o.o_orderpriority IS NOT NULL THEN (l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_extendedprice) END) AS payment_type,
    max(o.o_orderdate) AS order_purchase_timestamp,
    max(CASE WHEN l.l_returnflag = 'N' THEN 0 ELSE 1 END) AS has_review,
    count(*) AS purchase_count
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey
  WHERE o.o_orderstatus = 'F'
  GROUP BY 1, 2, 3)"""

SPLIT = """labelled AS (
  SELECT * EXCLUDE (_pos, _n),
    CASE WHEN _pos < floor(CAST(_n AS DOUBLE) * CAST(0.7 AS DOUBLE)) THEN 'train'
         WHEN _pos < floor(CAST(_n AS DOUBLE) * (CAST(0.7 AS DOUBLE) + CAST(0.15 AS DOUBLE))) THEN 'val'
         ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (ORDER BY order_purchase_timestamp, customer_unique_id, product_id,
                                     product_category_name_english) - 1 AS _pos,
               count(*) OVER () AS _n FROM inter)),
train AS (SELECT * EXCLUDE (split) FROM labelled WHERE split = 'train'),
val AS (SELECT * EXCLUDE (split) FROM labelled WHERE split = 'val'),
test AS (SELECT * EXCLUDE (split) FROM labelled WHERE split = 'test')"""

DAY_US = "86400000000"


def days(a: str, b: str) -> str:
    """Whole elapsed days from a to b."""
    return f"CAST(floor((epoch_us({b}) - epoch_us({a})) / {DAY_US}) AS INTEGER)"


FEATS = f"""g AS (SELECT quantile_cont(price, 0.99) AS p99, min(order_purchase_timestamp) AS t0,
                max(order_purchase_timestamp) AS t1, avg(review_score) AS gmean, count(*) AS n FROM inter),
cat AS (SELECT product_category_name_english, count(*) AS cnt, count(review_score) AS nr, avg(review_score) AS mr
        FROM inter GROUP BY 1),
cat2 AS (SELECT product_category_name_english,
           CAST(cnt AS DOUBLE) / g.n AS category_frequency,
           coalesce((nr * mr + 10 * g.gmean) / (nr + 10), g.gmean) AS category_target_enc,
           CASE WHEN row_number() OVER (ORDER BY cnt DESC, product_category_name_english) <= 10 THEN 1 ELSE 0 END AS category_is_top10,
           CASE WHEN cnt < 10 THEN 1 ELSE 0 END AS category_is_rare
         FROM cat, g),
uf AS (SELECT customer_unique_id, count(product_id) AS user_total_purchases,
          count(DISTINCT product_id) AS user_unique_products, avg(review_score) AS user_avg_review_score,
          avg(price) AS user_avg_price, avg(freight_value) AS user_avg_freight,
          min(order_purchase_timestamp) AS _first, max(order_purchase_timestamp) AS _last,
          sum(has_review) AS _reviews
        FROM inter GROUP BY 1),
uf2 AS (SELECT uf.customer_unique_id, user_total_purchases, user_unique_products, user_avg_review_score,
          user_avg_price, user_avg_freight, {days('_first', '_last')} AS user_purchase_span_days,
          {days('_last', 'g.t1')} AS user_recency_days,
          user_unique_products / user_total_purchases AS user_diversity_index,
          _reviews / user_total_purchases AS user_review_rate
        FROM uf, g),
pf AS (SELECT product_id, count(customer_unique_id) AS product_popularity,
          count(DISTINCT customer_unique_id) AS product_unique_buyers,
          avg(review_score) AS product_avg_review_score, avg(price) AS product_avg_price,
          avg(freight_value) AS product_avg_freight, sum(has_review) / count(customer_unique_id) AS product_review_rate,
          count(DISTINCT customer_unique_id) / count(customer_unique_id) AS product_buyer_diversity
        FROM inter GROUP BY 1),
uid AS (SELECT customer_unique_id, row_number() OVER (ORDER BY customer_unique_id) - 1 AS user_id
        FROM (SELECT DISTINCT customer_unique_id FROM inter)),
pid AS (SELECT product_id, row_number() OVER (ORDER BY product_id) - 1 AS product_id_idx
        FROM (SELECT DISTINCT product_id FROM inter)),
cid AS (SELECT product_category_name_english, row_number() OVER (ORDER BY product_category_name_english) - 1 AS category_id
        FROM (SELECT DISTINCT product_category_name_english FROM inter)),
feat_all AS (
  SELECT i.*, ln(1 + i.price) AS price_log, ln(1 + i.freight_value) AS freight_value_log,
    i.price / (i.freight_value + 1) AS price_to_freight_ratio, i.price + i.freight_value AS total_cost,
    CAST(i.price > g.p99 AS INTEGER) AS has_price_outlier,
    CAST(year(i.order_purchase_timestamp) AS INTEGER) AS purchase_year,
    CAST(month(i.order_purchase_timestamp) AS INTEGER) AS purchase_month,
    CAST(isodow(i.order_purchase_timestamp) - 1 AS INTEGER) AS purchase_day_of_week,
    CAST(hour(i.order_purchase_timestamp) AS INTEGER) AS purchase_hour,
    CAST(day(i.order_purchase_timestamp) AS INTEGER) AS purchase_day_of_month,
    CAST(isodow(i.order_purchase_timestamp) - 1 >= 5 AS INTEGER) AS is_weekend,
    CAST(month(i.order_purchase_timestamp) IN (11, 12) AS INTEGER) AS is_holiday_season,
    {days('g.t0', 'i.order_purchase_timestamp')} AS days_since_reference,
    CAST(quarter(i.order_purchase_timestamp) AS INTEGER) AS purchase_quarter,
    cat2.category_target_enc, cat2.category_frequency, cat2.category_is_top10, cat2.category_is_rare,
    CAST(coalesce(i.payment_type, 'not_defined') = 'credit_card' AS INTEGER) AS payment_type_credit_card,
    CAST(coalesce(i.payment_type, 'not_defined') = 'boleto' AS INTEGER) AS payment_type_boleto,
    CAST(coalesce(i.payment_type, 'not_defined') = 'voucher' AS INTEGER) AS payment_type_voucher,
    CAST(coalesce(i.payment_type, 'not_defined') = 'debit_card' AS INTEGER) AS payment_type_debit_card,
    CAST(coalesce(i.payment_type, 'not_defined') = 'not_defined' AS INTEGER) AS payment_type_not_defined,
    uf2.* EXCLUDE (customer_unique_id), pf.* EXCLUDE (product_id),
    uid.user_id, pid.product_id_idx, cid.category_id
  FROM inter i CROSS JOIN g
  LEFT JOIN cat2 USING (product_category_name_english)
  LEFT JOIN uf2 USING (customer_unique_id)
  LEFT JOIN pf USING (product_id)
  LEFT JOIN uid USING (customer_unique_id)
  LEFT JOIN pid USING (product_id)
  LEFT JOIN cid USING (product_category_name_english)),
feat AS (
  SELECT customer_unique_id, product_id, user_id, product_id_idx, category_id,
    review_score, has_review, purchase_count,
    price, freight_value, price_log, freight_value_log, price_to_freight_ratio, has_price_outlier,
    purchase_year, purchase_month, purchase_day_of_week, purchase_hour, purchase_day_of_month,
    is_weekend, is_holiday_season, days_since_reference,
    category_target_enc, category_frequency, category_is_top10, category_is_rare,
    payment_type_credit_card, payment_type_boleto, payment_type_voucher, payment_type_debit_card,
    user_total_purchases, user_avg_price, user_avg_freight, user_purchase_span_days,
    user_recency_days, user_review_rate,
    product_popularity, product_unique_buyers, coalesce(product_avg_review_score, 0.0) AS product_avg_review_score,
    product_avg_price, product_avg_freight, product_review_rate
  FROM feat_all)"""


def with_(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def metric_ctes(hits_sql: str, eval_users_sql: str, ks=KS, cap: int | None = None) -> str:
    """Per-user metrics from hits (user, rank) and eval users (user, n_rel) — plain SQL."""
    cap = cap or 2 * max(ks)
    per = ["count(*) AS h_all"]
    for k in ks:
        per += [
            f"count(*) FILTER (WHERE rank <= {k}) AS h_{k}",
            f"sum(CASE WHEN rank <= {k} THEN cum_hits / rank ELSE 0 END) AS ap_{k}",
            f"sum(CASE WHEN rank <= {k} THEN 1 / log2(rank + 1) ELSE 0 END) AS dcg_{k}",
        ]
    cols = ["customer_unique_id", "n_rel"]
    for k in ks:
        idcg_rel = f"list_sum(list_transform(range(1, least(n_rel, {k}) + 1), lambda i: 1 / log2(i + 1)))"
        idcg_list = f"list_sum(list_transform(range(1, least(h_all, {k}) + 1), lambda i: 1 / log2(i + 1)))"
        cols += [
            f'CASE WHEN h_{k} > 0 THEN 1.0 ELSE 0.0 END AS "HitRate@{k}"',
            f'h_{k} / {float(k)} AS "Precision@{k}"',
            f'CASE WHEN n_rel > 0 THEN h_{k} / n_rel ELSE 0.0 END AS "Recall@{k}"',
            f'CASE WHEN n_rel > 0 THEN ap_{k} / least(n_rel, {k}) ELSE 0.0 END AS "MAP@{k}"',
            f'CASE WHEN h_{k} > 0 THEN ap_{k} / h_{k} ELSE 0.0 END AS "MAP_hits@{k}"',
            f'CASE WHEN n_rel > 0 THEN dcg_{k} / {idcg_rel} ELSE 0.0 END AS "NDCG@{k}"',
            f'CASE WHEN h_all > 0 THEN dcg_{k} / {idcg_list} ELSE 0.0 END AS "NDCG_list@{k}"',
            f'CAST(dcg_{k} AS DOUBLE) AS "DCG@{k}"',
        ]
    zero = ", ".join(
        [f"coalesce(h_all, 0) AS h_all"]
        + [f"coalesce(h_{k}, 0) AS h_{k}, coalesce(ap_{k}, 0) AS ap_{k}, coalesce(dcg_{k}, 0) AS dcg_{k}" for k in ks]
    )
    return f"""hits AS ({hits_sql}),
eu AS ({eval_users_sql}),
ch AS (SELECT h.customer_unique_id, h.rank,
          row_number() OVER (PARTITION BY h.customer_unique_id ORDER BY h.rank) AS cum_hits
       FROM hits h SEMI JOIN eu USING (customer_unique_id) WHERE h.rank <= {cap}),
per AS (SELECT customer_unique_id, {", ".join(per)} FROM ch GROUP BY 1),
u AS (SELECT eu.customer_unique_id, eu.n_rel, {zero} FROM eu LEFT JOIN per USING (customer_unique_id)),
pu AS (SELECT {", ".join(cols)} FROM u)"""


EVAL_USERS = """SELECT customer_unique_id, count(DISTINCT product_id) AS n_rel FROM test
  WHERE customer_unique_id IN (SELECT customer_unique_id FROM train) GROUP BY 1"""

RELEVANT = "SELECT DISTINCT customer_unique_id, product_id FROM test"


def mean_long(metrics, ks=KS, rounded: bool = True) -> str:
    """Long (metric, k, value, n_users) from pu."""
    parts = []
    for m in metrics:
        for k in ks:
            v = f'coalesce(avg("{m}@{k}"), 0.0)'
            v = f"round({v}, 6)" if rounded else v
            parts.append(
                f"SELECT '{m}' AS metric, CAST({k} AS INTEGER) AS k, {v} AS value, "
                f"count(*) AS n_users FROM pu"
            )
    return "\nUNION ALL ".join(parts)


def shared_hits(list_cte: str) -> str:
    return f"SELECT r.customer_unique_id, l.rank FROM ({RELEVANT}) r JOIN {list_cte} l USING (product_id)"


def personal_hits(recs_cte: str) -> str:
    return f"SELECT r.customer_unique_id, r.rank FROM {recs_cte} r JOIN ({RELEVANT}) t USING (customer_unique_id, product_id)"
