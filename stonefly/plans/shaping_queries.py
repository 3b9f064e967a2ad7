"""Column shaping, fold joins, ranges, distinct projections and the
harmonising steps on the driver tables (PR-*, JN-09, AG-04..08, DOM-09/10/29/31)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stonefly.config import scoring
from stonefly.functions.numeric import round_half_up as r_hu
from stonefly.functions.numeric import round_half_up_sql as r_sql
from stonefly.functions.text import drop_after_space
from stonefly.operators import columns as C
from stonefly.operators.aggregates import global_range
from stonefly.operators.joins import fold_joins
from stonefly.plans import lab as LAB
from stonefly.sources.literal import literal_table
from stonefly.sources.tables import table

# -- PR-03/07/09/10/11/12: shaping a lab-like table ---------------------------------
RENAMES = {"l_orderkey": "Sample id", "l_partkey": "taxonId", "l_quantity": "Indiv Count",
           "l_extendedprice": "price", "l_discount": "disc", "l_returnflag": "Flag", "not_there": "never"}


def column_shaping(spark, d):
    li = table(spark, d, "lineitem")
    df = C.select_prefix(li, "l_")                                      # PR-03
    df = C.rename_from_table(df, RENAMES, subset=True)                  # PR-07 (absent names skipped)
    df = C.clean_names(df)                                              # PR-09
    df = C.mutate_by_type(df, T.StringType, F.lower)                    # PR-12
    df = C.mutate_by_type(df, T.DoubleType, lambda c: r_hu(c, 1))
    df = C.across(df, ["PRICE", "DISC"], lambda c: c * F.lit(100.0), suffix="_X100", before=True)  # PR-11
    return C.add_constants(df, {"UNIT": "count", "NOTE": None}, {"NOTE": "double"})       # PR-10


COLUMN_SHAPING_SQL = f"""
SELECT {r_sql('l_extendedprice', 1)} * 100.0 AS PRICE_X100, {r_sql('l_discount', 1)} * 100.0 AS DISC_X100,
       l_orderkey AS SAMPLE_ID, l_partkey AS TAXON_ID, {r_sql('l_quantity', 1)} AS INDIV_COUNT,
       {r_sql('l_extendedprice', 1)} AS PRICE, {r_sql('l_discount', 1)} AS DISC, lower(l_returnflag) AS FLAG,
       'count' AS UNIT, CAST(NULL AS DOUBLE) AS NOTE
FROM lineitem"""


# -- JN-09: fold of left joins over per-customer tables ---------------------------
def customer_fold_join(spark, d):
    o = table(spark, d, "orders")
    base = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"))
    a = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    b = o.filter(F.col("o_orderstatus") == "F").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("finished_total"))
    c = o.filter(F.col("o_orderstatus") == "O").groupBy("o_custkey").agg(F.max("o_totalprice").alias("open_max"))
    out = fold_joins(base, [a, b, c], ["o_custkey"], "left")
    return out.withColumn("finished_total", r_hu("finished_total", 2))


CUSTOMER_FOLD_JOIN_SQL = f"""
SELECT c.c_custkey AS o_custkey, a.n_orders, {r_sql('b.finished_total', 2)} AS finished_total, x.open_max
FROM customer c
LEFT JOIN (SELECT o_custkey, COUNT(*) AS n_orders FROM orders GROUP BY 1) a ON c.c_custkey IS NOT DISTINCT FROM a.o_custkey
LEFT JOIN (SELECT o_custkey, SUM(o_totalprice) AS finished_total FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) b
  ON c.c_custkey IS NOT DISTINCT FROM b.o_custkey
LEFT JOIN (SELECT o_custkey, MAX(o_totalprice) AS open_max FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) x
  ON c.c_custkey IS NOT DISTINCT FROM x.o_custkey"""


# -- AG-08/09: global range and count ------------------------------------------------
def order_price_range(spark, d):
    o = table(spark, d, "orders")
    return global_range(o, "o_totalprice", extra={"n_orders": F.count(F.lit(1))})


ORDER_PRICE_RANGE_SQL = """
SELECT MIN(o_totalprice) AS min_o_totalprice, MAX(o_totalprice) AS max_o_totalprice, COUNT(*) AS n_orders
FROM orders"""


# -- AG-04/05/06: distinct on a renamed projection ----------------------------------
def distinct_projection(spark, d):
    o = table(spark, d, "orders")
    return o.select(F.col("o_custkey").alias("site_id"), F.col("o_orderstatus").alias("status"),
                    F.substring("o_orderpriority", 1, 1).cast("int").alias("method")).distinct()


DISTINCT_PROJECTION_SQL = """
SELECT DISTINCT o_custkey AS site_id, o_orderstatus AS status, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS method
FROM orders"""


# -- DOM-31 / AG-03 / WN-01: tolerance means within an order ----------------------
TOLERANCE_ORDER = "Brand#1"


def tolerance_means(spark, d):
    p = table(spark, d, "part").select(
        F.col("p_brand").alias("MMS_ORDER"), drop_after_space("p_name").alias("MMS_GENUS"),
        F.col("p_type").alias("MMS_TOLERANCE_NAME"),
        F.col("p_size").cast("double").alias("MMS_TOLERANCE"),
        F.when(F.col("p_size") <= 45, F.col("p_retailprice")).alias("MMS_NBI_PHOSPHORUS_TOL"))
    out = LAB.tolerance_means(p, TOLERANCE_ORDER, "MMS_GENUS", keep=["MMS_GENUS", "MMS_TOLERANCE_NAME"],
                              tolerances=("MMS_TOLERANCE", "MMS_NBI_PHOSPHORUS_TOL"))
    return out.select("MMS_GENUS", "MMS_TOLERANCE_NAME", r_hu("new_MMS_TOLERANCE", 6).alias("new_tol"),
                      r_hu("new_MMS_NBI_PHOSPHORUS_TOL", 6).alias("new_nbi_p"))


TOLERANCE_MEANS_SQL = f"""
WITH f AS (SELECT regexp_replace(p_name, ' .*$', '') AS MMS_GENUS, p_type AS MMS_TOLERANCE_NAME,
                  CAST(p_size AS DOUBLE) AS t, CASE WHEN p_size <= 45 THEN p_retailprice END AS np
           FROM part WHERE p_brand = '{TOLERANCE_ORDER}'),
g AS (SELECT MMS_GENUS, AVG(t) AS mt, AVG(np) AS mn FROM f GROUP BY 1)
SELECT DISTINCT f.MMS_GENUS, f.MMS_TOLERANCE_NAME, {r_sql('g.mt', 6)} AS new_tol, {r_sql('g.mn', 6)} AS new_nbi_p
FROM f JOIN g ON f.MMS_GENUS IS NOT DISTINCT FROM g.MMS_GENUS"""


# -- DOM-09/10/29: method harmonising, lake groups, family renames ----------------
RAW_METHODS = {1: "Kick: Headwater Stream", 2: "Kick: RMN 300 Count", 3: "Lake: Littoral", 4: "Kick: Standard",
               5: "Multiplate: Navigable"}
FAMILY_NAMES = {"widget": "physidae", "gizmo": "gammaridae", "anvil": "turbellaria"}
GROUP_RULES = [("899", "10/03/1998", "A"), ("769", "05/28/1997", "B")]


def harmonised_methods(spark, d):
    from stonefly.operators.lookup import case_map
    o = table(spark, d, "orders")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    p = table(spark, d, "part").select("p_partkey", "p_name")
    raw = (li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey).select(
        "l_orderkey", "l_linenumber",
        F.col("o_custkey").cast("string").alias("MSSIH_EVENT_SMAS_HISTORY_ID"),
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("MSSIH_EVENT_SMAS_SAMPLE_DATE"),
        F.lit(1).alias("MSSIH_REPLICATE"),
        case_map(F.substring("o_orderpriority", 1, 1).cast("int"), RAW_METHODS).alias("MSSIH_BIOSAMPLE_COLLECT_METHOD"),
        case_map(F.regexp_replace("p_name", "^.* ", ""), FAMILY_NAMES, keep_unmatched=True).alias("MSDH_GENSPECIES")))
    rules = literal_table(spark, GROUP_RULES, [("site", "string"), ("date", "string"), ("letter", "string")])
    out = LAB.lake_groups(LAB.harmonise_methods(raw), rules)
    return out.withColumn("MSDH_GENSPECIES", LAB.undetermined_family("MSDH_GENSPECIES"))


def _harmonised_methods_sql():
    raw_m = " ".join(f"WHEN {k} THEN '{v}'" for k, v in RAW_METHODS.items())
    fam = " ".join(f"WHEN n = '{k}' THEN '{v}'" for k, v in FAMILY_NAMES.items())
    und = " ".join(f"WHEN g = '{k}' THEN '{v}'" for k, v in scoring.UNDETERMINED_FAMILY.items())
    harm = " ".join(f"WHEN m = '{k}' THEN '{v}'" for k, v in scoring.METHOD_HARMONISE.items())
    rules = " UNION ALL ".join(f"SELECT '{s}' AS site, '{dt}' AS dt, '{g}' AS letter" for s, dt, g in GROUP_RULES)
    return f"""
WITH raw AS (
  SELECT l_orderkey, l_linenumber, CAST(o_custkey AS VARCHAR) AS site, strftime(o_orderdate, '%m/%d/%Y') AS dt,
         CASE CAST(substr(o_orderpriority, 1, 1) AS INTEGER) {raw_m} END AS m,
         regexp_replace(p_name, '^.* ', '') AS n
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
r AS ({rules}),
h AS (SELECT raw.*, CASE {fam} ELSE n END AS g FROM raw)
SELECT l_orderkey, l_linenumber, h.site AS MSSIH_EVENT_SMAS_HISTORY_ID, h.dt AS MSSIH_EVENT_SMAS_SAMPLE_DATE,
       CASE WHEN m = '{scoring.RMN_METHOD}' THEN {scoring.RMN_REPLICATE} ELSE 1 END AS MSSIH_REPLICATE,
       CASE {harm} ELSE m END AS MSSIH_BIOSAMPLE_COLLECT_METHOD,
       CASE {und} ELSE g END AS MSDH_GENSPECIES,
       COALESCE(r.letter, '') AS "group"
FROM h LEFT JOIN r ON h.site = r.site AND h.dt = r.dt"""


QUERIES = {
    "column_shaping": column_shaping,
    "customer_fold_join": customer_fold_join,
    "order_price_range": order_price_range,
    "distinct_projection": distinct_projection,
    "tolerance_means": tolerance_means,
    "harmonised_methods": harmonised_methods,
}

SQL = {
    "column_shaping": COLUMN_SHAPING_SQL,
    "customer_fold_join": CUSTOMER_FOLD_JOIN_SQL,
    "order_price_range": ORDER_PRICE_RANGE_SQL,
    "distinct_projection": DISTINCT_PROJECTION_SQL,
    "tolerance_means": TOLERANCE_MEANS_SQL,
    "harmonised_methods": _harmonised_methods_sql(),
}
