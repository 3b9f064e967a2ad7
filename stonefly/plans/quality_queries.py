"""Validation and profiling on the driver tables (VAL-*, AG-12, SL-01)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stonefly.functions.numeric import round_half_up as r_hu
from stonefly.functions.numeric import round_half_up_sql as r_sql
from stonefly.operators import quality as Q
from stonefly.operators.quality import Rule
from stonefly.plans.sqlgen import in_list
from stonefly.sources.tables import table

ORDER_RULES = [
    Rule("col_exists", ("o_orderkey",)),
    Rule("col_exists", ("o_clerk",)),
    Rule("col_count_match", values=(6,)),
    Rule("col_is_character", ("o_orderstatus",)),
    Rule("col_is_numeric", ("o_totalprice",)),
    Rule("col_is_posix", ("o_orderdate",)),
    Rule("col_vals_expr", ("o_orderpriority",), expr="char_length(o_orderpriority) <= 8"),
    Rule("col_vals_not_null", ("o_custkey",)),
    Rule("col_vals_in_set", ("o_orderstatus",), ("F", "O")),
    Rule("col_vals_between", ("o_totalprice",), (1000, 400000)),
    Rule("col_vals_regex", ("o_orderpriority",), ("^[1-4]-",)),
    Rule("rows_distinct"),
    Rule("rows_distinct", ("o_custkey", "o_orderdate")),
]


def orders_rule_report(spark, d):
    rep = Q.interrogate(table(spark, d, "orders"), ORDER_RULES)
    return rep.select("step", "check_type", "columns", "values", "units", "n_pass",
                      r_hu("f_pass", 6).alias("f_pass"), F.col("warn").cast("int").alias("warn"))


def _orders_rule_report_sql():
    ocols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    rows = [
        "SELECT 1 AS step, 'col_exists' AS check_type, 'o_orderkey' AS columns, '' AS \"values\", "
        "CAST(1 AS BIGINT) AS units, CAST(1 AS BIGINT) AS n_pass",
        "SELECT 2, 'col_exists', 'o_clerk', '', 1, 0",
        "SELECT 3, 'col_count_match', '', '6', 1, 1",
        "SELECT 4, 'col_is_character', 'o_orderstatus', '', 1, 1",
        "SELECT 5, 'col_is_numeric', 'o_totalprice', '', 1, 1",
        "SELECT 6, 'col_is_posix', 'o_orderdate', '', 1, 1",
        "SELECT 7, 'col_vals_expr', 'o_orderpriority', 'char_length(o_orderpriority) <= 8', COUNT(*), "
        "COUNT(*) FILTER (WHERE COALESCE(length(o_orderpriority) <= 8, FALSE)) FROM orders",
        "SELECT 8, 'col_vals_not_null', 'o_custkey', '', COUNT(*), COUNT(o_custkey) FROM orders",
        f"SELECT 9, 'col_vals_in_set', 'o_orderstatus', 'F, O', COUNT(*), "
        f"COUNT(*) FILTER (WHERE COALESCE(o_orderstatus IN {in_list(['F', 'O'])}, FALSE)) FROM orders",
        "SELECT 10, 'col_vals_between', 'o_totalprice', '1000, 400000', COUNT(*), "
        "COUNT(*) FILTER (WHERE COALESCE(o_totalprice BETWEEN 1000 AND 400000, FALSE)) FROM orders",
        "SELECT 11, 'col_vals_regex', 'o_orderpriority', '^[1-4]-', COUNT(*), "
        "COUNT(*) FILTER (WHERE COALESCE(regexp_matches(o_orderpriority, '^[1-4]-'), FALSE)) FROM orders",
        f"SELECT 12, 'rows_distinct', '', '', SUM(n), SUM(CASE WHEN n = 1 THEN n ELSE 0 END) FROM "
        f"(SELECT COUNT(*) AS n FROM orders GROUP BY {', '.join(ocols)})",
        "SELECT 13, 'rows_distinct', 'o_custkey, o_orderdate', '', SUM(n), SUM(CASE WHEN n = 1 THEN n ELSE 0 END) "
        "FROM (SELECT COUNT(*) AS n FROM orders GROUP BY o_custkey, o_orderdate)",
    ]
    body = "\nUNION ALL ".join(rows)
    return f"""
WITH r AS ({body})
SELECT CAST(step AS INTEGER) AS step, check_type, columns, "values", CAST(units AS BIGINT) AS units,
       CAST(n_pass AS BIGINT) AS n_pass,
       {r_sql('CASE WHEN units > 0 THEN CAST(n_pass AS DOUBLE) / units END', 6)} AS f_pass,
       CAST(units - n_pass >= 1 AS INTEGER) AS warn
FROM r"""


# -- VAL-11/12: failing steps summarised per check type --------------------------
def orders_failure_summary(spark, d):
    rep = Q.interrogate(table(spark, d, "orders"), ORDER_RULES)
    return Q.failure_summary(rep, "ORDERS")


def _orders_failure_summary_sql():
    return f"""
SELECT check_type, COUNT(*) AS n, CAST(COUNT(*) AS VARCHAR) || ' ' || check_type || ' issues' AS message,
       'ORDERS' AS table_name
FROM ({_orders_rule_report_sql()}) WHERE COALESCE(f_pass, 0.0) < 1 GROUP BY check_type"""


# -- SL-01 / VAL-10: first 50 failing rows per row rule -------------------------
def failing_order_rows(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                         "o_orderpriority")
    return Q.failing_rows(o, ORDER_RULES, n=50, order_by=["o_orderkey"])


def _failing_order_rows_sql():
    cols = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"
    preds = {
        7: "COALESCE(length(o_orderpriority) <= 8, FALSE)",
        8: "o_custkey IS NOT NULL",
        9: "COALESCE(o_orderstatus IN ('F', 'O'), FALSE)",
        10: "COALESCE(o_totalprice BETWEEN 1000 AND 400000, FALSE)",
        11: "COALESCE(regexp_matches(o_orderpriority, '^[1-4]-'), FALSE)",
    }
    parts = [f"(SELECT {cols}, {i} AS step FROM orders WHERE NOT ({p}) ORDER BY o_orderkey LIMIT 50)"
             for i, p in preds.items()]
    return "SELECT * FROM (" + "\nUNION ALL ".join(parts) + ")"


# -- VAL-16: lineitem foreign keys to orders (warehouse + staged), part, supplier --
def _fk_inputs(spark, d):
    o = table(spark, d, "orders")
    dictionary = spark.createDataFrame(
        [("LINEITEM", "l_orderkey", False, True, "ORDERS"), ("LINEITEM", "l_partkey", False, True, "PART"),
         ("LINEITEM", "l_suppkey", False, True, "SUPPLIER"), ("LINEITEM", "l_linenumber", True, False, "NONE")],
        "TABLE_NAME string, COLUMN_NAME string, PRIMARY_KEY boolean, FOREIGN_KEY boolean, PARENT_TABLE string")
    parents = {
        "ORDERS": o.filter(F.col("o_orderstatus").isin("F", "O")).select(F.col("o_orderkey").alias("l_orderkey")),
        "PART": table(spark, d, "part").filter(F.col("p_size") <= 45).select(F.col("p_partkey").alias("l_partkey")),
        "SUPPLIER": table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey")),
    }
    # Transfer log: pending urgent orders staged as JSON row images, two
    # versions each; the newest version carries the key.
    staged = o.filter((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT"))
    log = staged.select(
        F.col("o_orderkey").cast("string").alias("UID"), F.lit("ORDERS").alias("TABLE_NAME"),
        F.explode(F.array(
            F.struct(F.lit(1).alias("VERSION"), F.to_json(F.struct(F.lit(-1).cast("bigint").alias("l_orderkey")))
                     .alias("DATA")),
            F.struct(F.lit(2).alias("VERSION"), F.to_json(F.struct(F.col("o_orderkey").alias("l_orderkey")))
                     .alias("DATA")))).alias("v")).select("UID", "TABLE_NAME", "v.VERSION", "v.DATA")
    return dictionary, parents, log


def lineitem_fk_flags(spark, d):
    dictionary, parents, log = _fk_inputs(spark, d)
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    out = Q.validate_fks(li, "LINEITEM", dictionary, parents, log)
    flags = ["MATCHED_ORDERS", "MATCHED_PART", "MATCHED_SUPPLIER", "FK_VALIDATION_PASSED"]
    return out.select("l_orderkey", "l_linenumber", *[F.col(f).cast("int").alias(f) for f in flags])


LINEITEM_FK_FLAGS_SQL = """
WITH po AS (SELECT o_orderkey AS k FROM orders WHERE o_orderstatus IN ('F', 'O')
            UNION SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'),
pp AS (SELECT DISTINCT p_partkey AS k FROM part WHERE p_size <= 45),
ps AS (SELECT DISTINCT s_suppkey AS k FROM supplier)
SELECT l_orderkey, l_linenumber,
       CAST(l_orderkey IN (SELECT k FROM po) AS INTEGER) AS MATCHED_ORDERS,
       CAST(l_partkey IN (SELECT k FROM pp) AS INTEGER) AS MATCHED_PART,
       CAST(l_suppkey IN (SELECT k FROM ps) AS INTEGER) AS MATCHED_SUPPLIER,
       CAST(l_orderkey IN (SELECT k FROM po) AND l_partkey IN (SELECT k FROM pp)
            AND l_suppkey IN (SELECT k FROM ps) AS INTEGER) AS FK_VALIDATION_PASSED
FROM lineitem"""


# -- IO-08 / WN-03 / JSON-01: newest staged row image per UID from a log ---------
def staged_orders(spark, d):
    """A transfer log of order row images (three versions per order, the
    newest with the current values); the newest image per UID is parsed."""
    from pyspark.sql import types as T
    o = table(spark, d, "orders")
    img = lambda price: F.to_json(F.struct(F.col("o_orderkey"), F.col("o_custkey"), price.alias("o_totalprice"),
                                           F.col("o_orderpriority")))
    log = o.select(
        F.col("o_orderkey").cast("string").alias("UID"), F.lit("ORDERS").alias("TABLE_NAME"),
        F.explode(F.array(
            F.struct(F.lit(1).alias("VERSION"), img(F.lit(0.0)).alias("DATA")),
            F.struct(F.lit(3).alias("VERSION"), img(F.col("o_totalprice")).alias("DATA")),
            F.struct(F.lit(2).alias("VERSION"), img(F.lit(-1.0)).alias("DATA")))).alias("v")
    ).select("UID", "TABLE_NAME", "v.VERSION", "v.DATA")
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                           T.StructField("o_totalprice", T.DoubleType()),
                           T.StructField("o_orderpriority", T.StringType())])
    return Q.staged_parent_rows(log, "ORDERS", schema)


STAGED_ORDERS_SQL = """
WITH log AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS UID, 'ORDERS' AS TABLE_NAME, v.VERSION,
         to_json({'o_orderkey': o_orderkey, 'o_custkey': o_custkey,
                  'o_totalprice': CASE WHEN v.VERSION = 3 THEN o_totalprice ELSE CAST(v.price AS DOUBLE) END,
                  'o_orderpriority': o_orderpriority}) AS DATA
  FROM orders, (VALUES (1, 0.0), (3, NULL), (2, -1.0)) AS v(VERSION, price)),
newest AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY UID ORDER BY VERSION DESC) AS rn
           FROM log WHERE TABLE_NAME = 'ORDERS')
SELECT CAST(json_extract(DATA, '$.o_orderkey') AS BIGINT) AS o_orderkey,
       CAST(json_extract(DATA, '$.o_custkey') AS BIGINT) AS o_custkey,
       CAST(json_extract(DATA, '$.o_totalprice') AS DOUBLE) AS o_totalprice,
       json_extract_string(DATA, '$.o_orderpriority') AS o_orderpriority
FROM newest WHERE rn = 1"""


# -- AG-12: column profile (exact variant) ---------------------------------------
PROFILE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"]


def lineitem_profile(spark, d):
    p = Q.profile(table(spark, d, "lineitem"), PROFILE_COLS, exact=True)
    return p.select("column_name", "column_type", "n", "n_missing", "n_unique",
                    r_hu("mean", 4).alias("mean"), r_hu("sd", 4).alias("sd"), "min", "max")


def _lineitem_profile_sql():
    types = {"l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
             "l_returnflag": "string"}
    parts = []
    for c in PROFILE_COLS:
        if types[c] == "double":
            stats = (f"{r_sql(f'AVG({c})', 4)}, {r_sql(f'STDDEV_SAMP({c})', 4)}, "
                     f"CAST(MIN({c}) AS DOUBLE), CAST(MAX({c}) AS DOUBLE)")
        else:
            stats = "CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)"
        parts.append(f"SELECT '{c}', '{types[c]}', COUNT(*), COUNT(*) - COUNT({c}), COUNT(DISTINCT {c}), {stats} "
                     f"FROM lineitem")
    body = "\nUNION ALL ".join(parts)
    return (f"SELECT * FROM ({body}) AS t(column_name, column_type, n, n_missing, n_unique, mean, sd, min, max)")


# -- AG-12: profile sketches of every ship year, kept, merged, and held against the rows ----
SKETCH_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"]
QUARTILES = (0.25, 0.5, 0.75)


def lineitem_profile_merged(spark, d):
    """One run a ship year: its sketches are stored, all runs merged, and the
    quartiles' true ranks counted in a second pass over the rows."""
    from stonefly.session import scratch_table
    li = table(spark, d, "lineitem").select("l_shipdate", *SKETCH_COLS)
    kept = scratch_table(Q.profile_sketches(li, F.date_format("l_shipdate", "yyyy"), SKETCH_COLS), "profile-runs")
    merged = Q.merge_profiles(kept, QUARTILES)
    # the few quartiles, as a value of the plan
    found = merged.filter("p50 IS NOT NULL").agg(F.map_from_entries(F.collect_list(F.struct("column_name", F.array("p25", "p50", "p75"))))).scalar()
    with_q = li.withColumn("_q", found)
    ranks = []
    for c in SKETCH_COLS[:4]:
        for i, q in enumerate(QUARTILES):
            v = F.col("_q")[c][i]
            low, high = F.count_if(F.col(c) < v) / F.count(c), F.count_if(F.col(c) <= v) / F.count(c)
            # twice the stated error, which is that of 99 cases of 100
            ranks.append(((low <= q + 2 * Q.KLL_RANK_ERROR) & (high >= q - 2 * Q.KLL_RANK_ERROR)).cast("int").alias(f"{c}_{i}"))
    exact = with_q.agg(*ranks)
    ok = exact.select(F.map_from_arrays(F.array(*[F.lit(c) for c in SKETCH_COLS[:4]]),
                                        F.array(*[F.array(*[F.col(f"{c}_{i}") for i in range(3)]) for c in SKETCH_COLS[:4]]))).scalar()
    out = merged.withColumn("_ok", ok)
    return out.select("column_name", "column_type", "n", "n_missing", r_hu("mean", 4).alias("mean"), r_hu("sd", 4).alias("sd"), "min", "max",
                      *[F.coalesce(F.col("_ok")[F.col("column_name")][i], F.lit(1)).alias(f"p{round(100 * q)}_within_error") for i, q in enumerate(QUARTILES)])


def _lineitem_profile_merged_sql():
    return f"""
SELECT column_name, column_type, n, n_missing, mean, sd, min, max,
       1 AS p25_within_error, 1 AS p50_within_error, 1 AS p75_within_error
FROM ({_lineitem_profile_sql()})"""


# -- VAL-20 / VAL-07: score range check on the sample scores ---------------------
SCORE_COLS = ["score_richness", "score_ept_richness", "score_hilsenhoff_biotic_index",
              "score_percent_model_affinity", "score_nutrient_biotic_index_phosphorus", "score_bioassessment_profile"]


def score_range_report(spark, d):
    from stonefly.plans.metric_queries import sample_scores
    rules = [Rule("col_vals_between", (c,), (0, 10), na_pass=True) for c in SCORE_COLS]
    rules.append(Rule("col_vals_between", ("score_bioassessment_profile",), (2.5, 7.5)))
    rep = Q.interrogate(sample_scores(spark, d), rules)
    return rep.select("step", "check_type", "columns", "values", "units", "n_pass",
                      r_hu("f_pass", 6).alias("f_pass"), F.col("warn").cast("int").alias("warn"))


def _score_range_report_sql():
    from stonefly.plans.metric_queries import SQL as MSQL
    parts = [f"SELECT {i} AS step, 'col_vals_between' AS check_type, '{c}' AS columns, '0, 10' AS \"values\", "
             f"COUNT(*) AS units, COUNT(*) FILTER (WHERE COALESCE({c} BETWEEN 0 AND 10, {c} IS NULL)) AS n_pass FROM s"
             for i, c in enumerate(SCORE_COLS, start=1)]
    parts.append(f"SELECT {len(SCORE_COLS) + 1}, 'col_vals_between', 'score_bioassessment_profile', '2.5, 7.5', "
                 "COUNT(*), COUNT(*) FILTER (WHERE COALESCE(score_bioassessment_profile BETWEEN 2.5 AND 7.5, FALSE)) "
                 "FROM s")
    body = "\nUNION ALL ".join(parts)
    return f"""
WITH s AS ({MSQL['sample_scores']}),
r AS ({body})
SELECT CAST(step AS INTEGER) AS step, check_type, columns, "values", CAST(units AS BIGINT) AS units,
       CAST(n_pass AS BIGINT) AS n_pass,
       {r_sql('CASE WHEN units > 0 THEN CAST(n_pass AS DOUBLE) / units END', 6)} AS f_pass,
       CAST(units - n_pass >= 1 AS INTEGER) AS warn
FROM r"""


QUERIES = {
    "staged_orders": staged_orders,
    "orders_failure_summary": orders_failure_summary,
    "score_range_report": score_range_report,
    "orders_rule_report": orders_rule_report,
    "failing_order_rows": failing_order_rows,
    "lineitem_fk_flags": lineitem_fk_flags,
    "lineitem_profile": lineitem_profile,
    "lineitem_profile_merged": lineitem_profile_merged,
}

SQL = {
    "staged_orders": STAGED_ORDERS_SQL,
    "orders_failure_summary": _orders_failure_summary_sql(),
    "score_range_report": _score_range_report_sql(),
    "orders_rule_report": _orders_rule_report_sql(),
    "failing_order_rows": _failing_order_rows_sql(),
    "lineitem_fk_flags": LINEITEM_FK_FLAGS_SQL,
    "lineitem_profile": _lineitem_profile_sql(),
    "lineitem_profile_merged": _lineitem_profile_merged_sql(),
}
