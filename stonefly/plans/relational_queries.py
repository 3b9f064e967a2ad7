"""Generic relational operators on the driver tables:
aggregates, windows, joins, filters, set operations, JSON, reshape."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stonefly.functions.nulls import isin_safe, not_in_safe, strict_sum
from stonefly.functions.numeric import round_half_up as r_hu
from stonefly.functions.numeric import round_half_up_sql as r_sql
from stonefly.operators import aggregates as A
from stonefly.operators import joins as J
from stonefly.operators import reshape as R
from stonefly.operators import setops as SO
from stonefly.operators.text_match import rows_containing_any
from stonefly.plans.sqlgen import in_list
from stonefly.sources.tables import table

R6 = 6


def _orders(spark, d):
    return table(spark, d, "orders")


# -- AG-01/02/03/07: sum, max, mean, count per key; strict sum --------------
def key_aggregates(spark, d):
    li = table(spark, d, "lineitem")
    tax = F.when(F.col("l_tax") != 0.0, F.col("l_tax"))
    return li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("l_quantity").alias("sum_quantity"),
        F.max("l_extendedprice").alias("max_extendedprice"),
        r_hu(F.avg("l_discount"), R6).alias("mean_discount"),
        r_hu(strict_sum(tax), R6).alias("strict_sum_tax"))


KEY_AGGREGATES_SQL = f"""
SELECT l_orderkey, COUNT(*) AS n_lines, SUM(l_quantity) AS sum_quantity,
       MAX(l_extendedprice) AS max_extendedprice, {r_sql('AVG(l_discount)', R6)} AS mean_discount,
       {r_sql('CASE WHEN COUNT(NULLIF(l_tax, 0.0)) = COUNT(*) THEN SUM(NULLIF(l_tax, 0.0)) END', R6)} AS strict_sum_tax
FROM lineitem GROUP BY l_orderkey"""


# -- WN-01 / JN-10: grouped mutate (mean per order kept on every line) ------
def group_mean_rows(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    out = J.with_group_aggregates(li, ["l_orderkey"], {"order_mean_quantity": F.avg("l_quantity"),
                                                       "order_total_quantity": F.sum("l_quantity")})
    return out.select("l_orderkey", "l_linenumber", "l_quantity",
                      r_hu("order_mean_quantity", R6).alias("order_mean_quantity"), "order_total_quantity")


GROUP_MEAN_ROWS_SQL = f"""
SELECT l_orderkey, l_linenumber, l_quantity,
       {r_sql('AVG(l_quantity) OVER (PARTITION BY l_orderkey)', R6)} AS order_mean_quantity,
       SUM(l_quantity) OVER (PARTITION BY l_orderkey) AS order_total_quantity
FROM lineitem"""


# -- WN-02 / VAL-19: customers with more than one order on a day ------------
def repeat_customer_days(spark, d):
    o = _orders(spark, d).select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("order_date"))
    return A.repeated_groups(o, ["o_custkey", "order_date"], 2, count_col="orders_that_day")


REPEAT_CUSTOMER_DAYS_SQL = """
SELECT o_custkey, order_date, o_orderkey, orders_that_day FROM (
  SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_date,
         COUNT(*) OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE)) AS orders_that_day
  FROM orders) WHERE orders_that_day > 1"""


# -- WN-03: newest event per user (ties broken by event_id) -----------------
def newest_event_per_user(spark, d):
    ev = table(spark, d, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return A.newest_per_key(ev, ["user_id"], ["ts", "event_id"])


NEWEST_EVENT_PER_USER_SQL = """
SELECT user_id, ts, event_id, event_type, value FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1"""


# -- JSON-01 / RS-04: JSON text to columns -----------------------------------
PROPS_SCHEMA = T.StructType([T.StructField("k", T.IntegerType())])


def event_props(spark, d):
    ev = table(spark, d, "events")
    props = F.when(F.col("event_type") != "error", F.col("props"))
    parsed = ev.select("event_id", "event_type", F.from_json(props, PROPS_SCHEMA).alias("p"))
    return R.struct_to_columns(parsed, "p", keep=["event_id", "event_type"])


EVENT_PROPS_SQL = """
SELECT event_id, event_type,
       CAST(json_extract_string(CASE WHEN event_type <> 'error' THEN props END, '$.k') AS INTEGER) AS k
FROM events"""


# -- JN-02: customers left join all their orders (customers without any stay) ------
def customer_order_left(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    o = _orders(spark, d).select("o_custkey", "o_orderkey")
    return J.join_renamed(c, o, ["c_custkey"], ["o_custkey"], "left")


CUSTOMER_ORDER_LEFT_SQL = """
SELECT c.c_custkey, c.c_mktsegment, o.o_orderkey
FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey"""


# -- JN-03: null-safe composite left join ------------------------------------
def _prio(col="o_orderpriority"):
    return F.when(F.col(col) != "5-LOW", F.col(col))


def null_safe_composite_join(spark, d):
    o = _orders(spark, d).select("o_orderkey", "o_custkey", _prio().alias("priority"), "o_orderstatus")
    f_counts = (o.filter(F.col("o_orderstatus") == "F").groupBy("o_custkey", "priority")
                .agg(F.count(F.lit(1)).alias("n_finished")))
    return J.join_null_safe(o.drop("o_orderstatus"), f_counts, ["o_custkey", "priority"], "left")


NULL_SAFE_COMPOSITE_JOIN_SQL = """
WITH o AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS priority,
                  o_orderstatus FROM orders),
f AS (SELECT o_custkey, priority, COUNT(*) AS n_finished FROM o WHERE o_orderstatus = 'F' GROUP BY 1, 2)
SELECT o.o_custkey, o.priority, o.o_orderkey, f.n_finished
FROM o LEFT JOIN f ON o.o_custkey IS NOT DISTINCT FROM f.o_custkey AND o.priority IS NOT DISTINCT FROM f.priority"""


# -- JN-04/05: full outer natural join of two per-customer tables -----------
def full_natural_join(spark, d):
    o = _orders(spark, d)
    a = o.filter(F.col("o_orderstatus") == "F").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_finished"))
    b = (o.filter((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT"))
         .groupBy("o_custkey").agg(F.max("o_totalprice").alias("max_urgent_pending")))
    return J.natural_join(a, b, "full")


FULL_NATURAL_JOIN_SQL = """
SELECT COALESCE(a.o_custkey, b.o_custkey) AS o_custkey, a.n_finished, b.max_urgent_pending
FROM (SELECT o_custkey, COUNT(*) AS n_finished FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) a
FULL OUTER JOIN (SELECT o_custkey, MAX(o_totalprice) AS max_urgent_pending FROM orders
                 WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' GROUP BY 1) b
  ON a.o_custkey IS NOT DISTINCT FROM b.o_custkey"""


# -- JN-07 / JN-08: anti and semi join against a filtered parent ------------
def _urgent_finished(spark, d):
    return _orders(spark, d).filter((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"))


def customers_without_urgent(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    return c.join(_urgent_finished(spark, d), c.c_custkey == F.col("o_custkey"), "left_anti")


def customers_with_urgent(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_name")
    return c.join(_urgent_finished(spark, d), c.c_custkey == F.col("o_custkey"), "left_semi")


_UF = "SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'"
CUSTOMERS_WITHOUT_URGENT_SQL = f"SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN ({_UF})"
CUSTOMERS_WITH_URGENT_SQL = f"SELECT c_custkey, c_name FROM customer WHERE c_custkey IN ({_UF})"


# -- JN-01: inner equi-join with different key names -------------------------
def lineitem_part_inner(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    p = table(spark, d, "part").select("p_partkey", "p_brand", "p_type")
    return J.join_renamed(li, p, ["l_partkey"], ["p_partkey"], "inner")


LINEITEM_PART_INNER_SQL = """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, p.p_brand, p.p_type
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey"""


# -- FL-06: parts with any of a word list in a text column ------------------------------
def name_match_any(spark, d):
    p = table(spark, d, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    words = table(spark, d, "region").select(F.concat(F.lit("#"), F.col("r_regionkey").cast("string")).alias("word"))
    words = words.unionByName(table(spark, d, "customer").select(F.col("c_mktsegment").alias("word")))
    hits = rows_containing_any(p, ["p_name", "p_type", "p_brand"], words, "word")
    return hits.select("p_partkey", "p_name")


NAME_MATCH_ANY_SQL = """
WITH w AS (SELECT '#' || r_regionkey AS word FROM region
           UNION SELECT c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL)
SELECT DISTINCT p.p_partkey, p.p_name FROM part p
WHERE EXISTS (SELECT 1 FROM w WHERE w.word <> '' AND (contains(p.p_name, w.word) OR contains(p.p_type, w.word)
                                   OR contains(p.p_brand, w.word)))"""


# -- FL-01..05, 07, 08: predicate flags --------------------------------------
URGENT = ["1-URGENT", "2-HIGH"]


def order_flags(spark, d):
    o = _orders(spark, d).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                 _prio().alias("priority"))
    return o.select(
        "o_orderkey",
        (F.col("o_orderstatus") == "F").cast("int").alias("is_finished"),
        isin_safe("priority", URGENT).cast("int").alias("is_urgent"),
        not_in_safe("priority", URGENT).cast("int").alias("not_urgent"),
        F.col("priority").isNull().cast("int").alias("priority_missing"),
        (F.col("o_custkey") != F.col("o_orderkey")).cast("int").alias("cust_ne_order"),
        F.col("o_totalprice").between(100000, 200000).cast("int").alias("mid_price"),
        (F.col("o_orderstatus") != "").cast("int").alias("has_status"))


ORDER_FLAGS_SQL = f"""
WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
                  CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS priority FROM orders)
SELECT o_orderkey,
       CAST(o_orderstatus = 'F' AS INTEGER) AS is_finished,
       CAST(COALESCE(priority IN {in_list(URGENT)}, FALSE) AS INTEGER) AS is_urgent,
       CAST(NOT COALESCE(priority IN {in_list(URGENT)}, FALSE) AS INTEGER) AS not_urgent,
       CAST(priority IS NULL AS INTEGER) AS priority_missing,
       CAST(o_custkey <> o_orderkey AS INTEGER) AS cust_ne_order,
       CAST(o_totalprice BETWEEN 100000 AND 200000 AS INTEGER) AS mid_price,
       CAST(o_orderstatus <> '' AS INTEGER) AS has_status
FROM o"""


def filtered_orders(spark, d):
    o = _orders(spark, d)
    return (o.filter((F.col("o_orderstatus") == "F") & F.col("o_totalprice").between(50000, 300000)
                     & isin_safe(_prio(), URGENT) & F.col("o_custkey").isNotNull())
            .select("o_orderkey", "o_custkey", "o_totalprice"))


FILTERED_ORDERS_SQL = f"""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderstatus = 'F' AND o_totalprice BETWEEN 50000 AND 300000
  AND COALESCE(CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END IN {in_list(URGENT)}, FALSE)
  AND o_custkey IS NOT NULL"""


# -- SET-01/02: union all, by name with missing columns filled --------------
def union_by_name(spark, d):
    o = _orders(spark, d)
    finished = o.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_totalprice")
    others = o.filter(F.col("o_orderstatus") != "F").select("o_orderkey", "o_orderpriority", "o_custkey")
    unknown = o.filter(F.col("o_orderstatus").isNull()).select("o_custkey", "o_orderkey", "o_totalprice")
    return SO.union_all([SO.union_all([finished, unknown]), others], fill_missing=True)


UNION_BY_NAME_SQL = """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' OR o_orderstatus IS NULL
UNION ALL BY NAME
SELECT o_orderkey, o_orderpriority, o_custkey FROM orders WHERE o_orderstatus <> 'F'"""


# -- SET-03: value set difference; SET-04: row set difference ----------------
def value_except(spark, d):
    o = _orders(spark, d)
    c = table(spark, d, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    return SO.value_except(o, c, "o_custkey", "c_custkey").withColumnRenamed("value", "custkey")


VALUE_EXCEPT_SQL = """
SELECT o_custkey AS custkey FROM orders
EXCEPT
SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'"""


def row_except(spark, d):
    o = _orders(spark, d).select("o_custkey", "o_orderstatus", "o_orderpriority")
    return SO.row_except(o.drop("o_orderpriority"),
                         o.filter(F.col("o_orderpriority") == "1-URGENT").drop("o_orderpriority"))


ROW_EXCEPT_SQL = """
SELECT o_custkey, o_orderstatus FROM orders
EXCEPT
SELECT o_custkey, o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT'"""


# -- RS-01/02: wide to long with raw_/score_ split ---------------------------
def unpivot_amounts(spark, d):
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.col("l_extendedprice").alias("raw_extendedprice"), F.col("l_quantity").alias("raw_quantity"),
        F.when(F.col("l_discount") != 0.0, F.col("l_discount")).alias("score_discount"))
    long = R.wide_to_long(li, ["l_orderkey", "l_linenumber"], ["raw_extendedprice", "raw_quantity", "score_discount"],
                          "metric_name", "metric_value")
    return R.split_metric_name(long, "metric_name", "metric_type")


UNPIVOT_AMOUNTS_SQL = """
WITH w AS (SELECT l_orderkey, l_linenumber, l_extendedprice AS raw_extendedprice, l_quantity AS raw_quantity,
                  CASE WHEN l_discount <> 0.0 THEN l_discount END AS score_discount FROM lineitem),
u AS (UNPIVOT w ON raw_extendedprice, raw_quantity, score_discount INTO NAME metric_name VALUE metric_value)
SELECT l_orderkey, l_linenumber,
       regexp_replace(metric_name, '^(raw_|score_)', '') AS metric_name, metric_value,
       CASE WHEN starts_with(metric_name, 'raw_') THEN 'raw' WHEN starts_with(metric_name, 'score_') THEN 'score' END
           AS metric_type
FROM u"""


QUERIES = {
    "key_aggregates": key_aggregates,
    "group_mean_rows": group_mean_rows,
    "repeat_customer_days": repeat_customer_days,
    "newest_event_per_user": newest_event_per_user,
    "event_props": event_props,
    "customer_order_left": customer_order_left,
    "null_safe_composite_join": null_safe_composite_join,
    "full_natural_join": full_natural_join,
    "customers_without_urgent": customers_without_urgent,
    "customers_with_urgent": customers_with_urgent,
    "lineitem_part_inner": lineitem_part_inner,
    "name_match_any": name_match_any,
    "order_flags": order_flags,
    "filtered_orders": filtered_orders,
    "union_by_name": union_by_name,
    "value_except": value_except,
    "row_except": row_except,
    "unpivot_amounts": unpivot_amounts,
}

SQL = {
    "key_aggregates": KEY_AGGREGATES_SQL,
    "group_mean_rows": GROUP_MEAN_ROWS_SQL,
    "repeat_customer_days": REPEAT_CUSTOMER_DAYS_SQL,
    "newest_event_per_user": NEWEST_EVENT_PER_USER_SQL,
    "event_props": EVENT_PROPS_SQL,
    "customer_order_left": CUSTOMER_ORDER_LEFT_SQL,
    "null_safe_composite_join": NULL_SAFE_COMPOSITE_JOIN_SQL,
    "full_natural_join": FULL_NATURAL_JOIN_SQL,
    "customers_without_urgent": CUSTOMERS_WITHOUT_URGENT_SQL,
    "customers_with_urgent": CUSTOMERS_WITH_URGENT_SQL,
    "lineitem_part_inner": LINEITEM_PART_INNER_SQL,
    "name_match_any": NAME_MATCH_ANY_SQL,
    "order_flags": ORDER_FLAGS_SQL,
    "filtered_orders": FILTERED_ORDERS_SQL,
    "union_by_name": UNION_BY_NAME_SQL,
    "value_except": VALUE_EXCEPT_SQL,
    "row_except": ROW_EXCEPT_SQL,
    "unpivot_amounts": UNPIVOT_AMOUNTS_SQL,
}
