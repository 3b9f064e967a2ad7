"""String, date, conditional and lookup operators on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stonefly.config import corrections as CFG
from stonefly.config import scoring
from stonefly.functions import dates as D
from stonefly.functions import text as X
from stonefly.functions.nulls import replace_na
from stonefly.operators import lookup as L
from stonefly.operators import metrics as M
from stonefly.plans import sqlgen as S
from stonefly.sources.tables import table


def site_id_expr():
    """``BASIN-LOCATION-rivermile`` built from customer columns."""
    return F.concat(X.lpad_keep(F.col("c_nationkey").cast("string"), 2, "0"), F.lit("-"),
                    F.upper(F.substring("c_mktsegment", 1, 4)), F.lit("-"),
                    F.floor("c_acctbal").cast("string"))


SITE_ID_SQL = ("(CASE WHEN length(CAST(c_nationkey AS VARCHAR)) >= 2 THEN CAST(c_nationkey AS VARCHAR) "
               "ELSE lpad(CAST(c_nationkey AS VARCHAR), 2, '0') END || '-' || upper(substr(c_mktsegment, 1, 4)) "
               "|| '-' || CAST(CAST(FLOOR(c_acctbal) AS BIGINT) AS VARCHAR))")


# -- STR-01..08, 10..14: text functions --------------------------------------
def text_functions(spark, d):
    c = table(spark, d, "customer").withColumn("site_id", site_id_expr())
    basin, location, rivmile = X.split_fixed("site_id", "-", 3)
    return c.select(
        "c_custkey", "site_id",
        F.upper("c_mktsegment").alias("segment_upper"),
        F.lower("c_mktsegment").alias("segment_lower"),
        F.trim(F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" "))).alias("segment_trimmed"),
        basin.alias("basin"), location.alias("location"), rivmile.alias("rivmile"),
        X.right("c_name", 4).alias("name_tail"),
        X.substr_range("c_name", 10, 18).alias("name_digits"),
        X.replace_first("c_name", "0", "o").alias("first_zero_to_o"),
        X.replace_all("c_name", "0", "o").alias("zeros_to_o"),
        X.remove_all("c_name", "[0-9]").alias("name_letters"),
        (F.char_length("c_name") <= 18).cast("int").alias("name_fits_18"),
        F.col("c_mktsegment").rlike("^(AUTO|MACH)").cast("int").alias("segment_matches"),
        F.concat_ws("_", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("segment_nation"))


TEXT_FUNCTIONS_SQL = f"""
WITH c AS (SELECT *, {SITE_ID_SQL} AS site_id FROM customer)
SELECT c_custkey, site_id, upper(c_mktsegment) AS segment_upper, lower(c_mktsegment) AS segment_lower,
       trim('  ' || c_mktsegment || ' ') AS segment_trimmed,
       regexp_extract(site_id, '^([^-]*)', 1) AS basin,
       regexp_extract(site_id, '^[^-]*-([^-]*)', 1) AS location,
       regexp_extract(site_id, '^[^-]*-[^-]*-(.*)$', 1) AS rivmile,
       right(c_name, 4) AS name_tail, substring(c_name, 10, 9) AS name_digits,
       regexp_replace(c_name, '0', 'o') AS first_zero_to_o,
       regexp_replace(c_name, '0', 'o', 'g') AS zeros_to_o,
       regexp_replace(c_name, '[0-9]', '', 'g') AS name_letters,
       CAST(length(c_name) <= 18 AS INTEGER) AS name_fits_18,
       CAST(regexp_matches(c_mktsegment, '^(AUTO|MACH)') AS INTEGER) AS segment_matches,
       c_mktsegment || '_' || CAST(c_nationkey AS VARCHAR) AS segment_nation
FROM c"""


# -- DT-01..06: parse in two formats, format, audit, event ids --------------
def _mdy_text():
    return F.when(F.col("o_orderstatus") == "F", D.format_date("o_orderdate", "%m/%d/%Y")).otherwise(
        D.format_date("o_orderdate", "%m-%d-%Y"))


def date_functions(spark, d):
    o = table(spark, d, "orders").withColumn("date_text", _mdy_text())
    parsed = D.parse_date_any("date_text", ["%m/%d/%Y", "%m-%d-%Y"])
    return o.select(
        "o_orderkey", "date_text",
        parsed.alias("parsed_date"),
        D.parse_date("date_text", "%m/%d/%Y").isNull().cast("int").alias("not_slash_format"),
        D.format_date(parsed, "%Y%m%d").alias("date_key"),
        F.replace(F.col("date_text"), F.lit("/"), F.lit("-")).alias("dashed_text"),
        D.event_id("o_custkey", "o_orderdate").alias("event_id"),
        D.linked_id("o_custkey", parsed, F.substring("o_orderpriority", 1, 1), F.lit(1)).alias("linked_id"))


_MDY_SQL = ("CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%m/%d/%Y') "
            "ELSE strftime(o_orderdate, '%m-%d-%Y') END")
_PARSED_SQL = ("CAST(COALESCE(try_strptime(date_text, '%m/%d/%Y'), try_strptime(date_text, '%m-%d-%Y')) AS DATE)")
DATE_FUNCTIONS_SQL = f"""
WITH o AS (SELECT *, {_MDY_SQL} AS date_text FROM orders),
p AS (SELECT *, {_PARSED_SQL} AS parsed_date FROM o)
SELECT o_orderkey, date_text, parsed_date,
       CAST(try_strptime(date_text, '%m/%d/%Y') IS NULL AS INTEGER) AS not_slash_format,
       strftime(parsed_date, '%Y%m%d') AS date_key,
       replace(date_text, '/', '-') AS dashed_text,
       CAST(o_custkey AS VARCHAR) || '_' || strftime(o_orderdate, '%Y%m%dT%H%M') AS event_id,
       CAST(o_custkey AS VARCHAR) || '_' || strftime(parsed_date, '%Y%m%d') || '_' || substr(o_orderpriority, 1, 1)
           || '_1' AS linked_id
FROM p"""


def date_audit(spark, d):
    """DT-04: texts per status that fit neither / only the dashed format."""
    o = table(spark, d, "orders").withColumn("date_text", _mdy_text())
    return o.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"),
        D.bad_date_count("date_text", ["%m/%d/%Y"]).alias("bad_slash_format"),
        D.bad_date_count("date_text", ["%m/%d/%Y", "%m-%d-%Y"]).alias("bad_any_format"))


DATE_AUDIT_SQL = f"""
WITH o AS (SELECT *, {_MDY_SQL} AS date_text FROM orders)
SELECT o_orderstatus, COUNT(*) AS n,
       COUNT(*) FILTER (WHERE date_text IS NOT NULL AND try_strptime(date_text, '%m/%d/%Y') IS NULL) AS bad_slash_format,
       COUNT(*) FILTER (WHERE date_text IS NOT NULL AND try_strptime(date_text, '%m/%d/%Y') IS NULL
                        AND try_strptime(date_text, '%m-%d-%Y') IS NULL) AS bad_any_format
FROM o GROUP BY o_orderstatus"""


# -- CND-01..04, DOM-22: case_when, case_match, ifelse, replace_na ----------
PRICE_BANDS = [("low", 50000), ("mid", 150000), ("high", 300000)]
PRIORITY_WORDS = {"1-URGENT": "urgent", "2-HIGH": "high"}
# Collection method of a driver-table sample: the digit of o_orderpriority.
PRIORITY_METHOD_NAMES = {1: "Kick: Standard", 2: "Multiplate: Navigable", 3: "Sediment Ponar",
                         4: "Low-Gradient", 5: "Multiplate: Non-Navigable"}


def _method_name(col="o_orderpriority"):
    return L.case_map(F.substring(col, 1, 1).cast("int"), PRIORITY_METHOD_NAMES)


def _method_name_sql(col="o_orderpriority"):
    whens = " ".join(f"WHEN {k} THEN '{v}'" for k, v in PRIORITY_METHOD_NAMES.items())
    return f"(CASE CAST(substr({col}, 1, 1) AS INTEGER) {whens} END)"


def case_and_map(spark, d):
    o = table(spark, d, "orders")
    band = None
    for label, hi in PRICE_BANDS:
        cond = F.col("o_totalprice") < hi
        band = F.when(cond, label) if band is None else band.when(cond, label)
    band = band.otherwise("top")
    prio = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    method = _method_name()
    return o.select(
        "o_orderkey", band.alias("price_band"),
        L.case_map("o_orderpriority", PRIORITY_WORDS, keep_unmatched=True).alias("priority_word"),
        method.alias("collection_method"),
        L.case_map(method, scoring.SAMPLE_METHODS, default=scoring.SAMPLE_METHOD_DEFAULT).alias("sample_method"),
        F.when(F.col("o_orderstatus") == "F", "closed").otherwise("open").alias("open_closed"),
        replace_na(prio, "none").alias("priority_or_none"))


def _case_map_sql(expr, mapping, default_sql):
    whens = " ".join(f"WHEN {expr} = '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"(CASE {whens} ELSE {default_sql} END)"


CASE_AND_MAP_SQL = f"""
SELECT o_orderkey,
       CASE {' '.join(f"WHEN o_totalprice < {hi} THEN '{label}'" for label, hi in PRICE_BANDS)} ELSE 'top' END
           AS price_band,
       {_case_map_sql('o_orderpriority', PRIORITY_WORDS, 'o_orderpriority')} AS priority_word,
       {_method_name_sql()} AS collection_method,
       {_case_map_sql(_method_name_sql(), scoring.SAMPLE_METHODS, repr(scoring.SAMPLE_METHOD_DEFAULT))}
           AS sample_method,
       CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE 'open' END AS open_closed,
       COALESCE(CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END, 'none') AS priority_or_none
FROM orders"""


# -- DOM-21 + DOM-20: low-count qualifier per sample --------------------------
def count_qualifier(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_quantity")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    per = li.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("total_individuals"))
    j = per.join(o, per.l_orderkey == o.o_orderkey).withColumn("collection_method", _method_name())
    low = M.below_count_minimum("collection_method", "total_individuals")
    return j.select(
        F.col("l_orderkey").alias("sample_id"), "collection_method", "total_individuals",
        F.when(low, scoring.LOW_COUNT_QUALIFIER).otherwise("").alias("result_qualifier"),
        F.when(low, scoring.LOW_COUNT_DESCRIPTION).otherwise("").alias("result_qualifier_description"))


COUNT_QUALIFIER_SQL = f"""
WITH per AS (SELECT l_orderkey, SUM(l_quantity) AS total_individuals FROM lineitem GROUP BY 1),
j AS (SELECT per.*, {_method_name_sql()} AS collection_method FROM per JOIN orders o ON per.l_orderkey = o.o_orderkey)
SELECT l_orderkey AS sample_id, collection_method, total_individuals,
       CASE WHEN {S.below_minimum_sql('collection_method', 'total_individuals')} THEN '{scoring.LOW_COUNT_QUALIFIER}'
            ELSE '' END AS result_qualifier,
       CASE WHEN {S.below_minimum_sql('collection_method', 'total_individuals')}
            THEN '{scoring.LOW_COUNT_DESCRIPTION}' ELSE '' END AS result_qualifier_description
FROM j"""


# -- DOM-04/30: id replacement from a crosswalk ------------------------------
def crosswalk_replace(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").cast("bigint").alias("area_id"))
    cw = table(spark, d, "nation").select(F.col("n_nationkey").cast("bigint").alias("old"),
                                          F.col("n_regionkey").cast("bigint").alias("new"))
    out = L.replace_from_crosswalk(c, "area_id", cw, "old", "new", flag="changed")
    return out.withColumn("changed", F.col("changed").cast("int"))


CROSSWALK_REPLACE_SQL = """
WITH cw AS (SELECT DISTINCT CAST(n_nationkey AS BIGINT) AS old, CAST(n_regionkey AS BIGINT) AS new FROM nation
            WHERE n_nationkey <> n_regionkey)
SELECT c.c_custkey, COALESCE(cw.new, CAST(c.c_nationkey AS BIGINT)) AS area_id,
       CAST(cw.old IS NOT NULL AS INTEGER) AS changed
FROM customer c LEFT JOIN cw ON CAST(c.c_nationkey AS BIGINT) = cw.old"""


# -- DOM-12/14: event ids from a survey table; samples without a survey -----
def event_ids(spark, d):
    """Purchases are the samples, the first view of a user's day is the
    survey visit (site = user, arrival time = HH:mm)."""
    from stonefly.plans.warehouse import attach_events, survey_events
    ev = table(spark, d, "events").withColumn("event_date", F.col("ts").cast("date"))
    samples = (ev.filter(F.col("event_type") == "purchase")
               .select(F.col("user_id").alias("site_id"), F.col("event_date").alias("DATE")).distinct())
    visits = (ev.filter(F.col("event_type") == "view").groupBy("user_id", "event_date").agg(F.min("ts").alias("arrive"))
              .select(F.col("user_id").cast("string").alias("site"), F.col("user_id").alias("site_id"),
                      F.date_format("event_date", "MM/dd/yyyy").alias("visit_date"),
                      F.date_format("arrive", "HH:mm").alias("arrival")))
    events = survey_events(visits, final_col="site", site_col="site_id", date_col="visit_date", time_col="arrival",
                           id_col=None)
    out, _ = attach_events(samples, events)
    return out.select(F.col("site_id").alias("user_id"), F.col("DATE").alias("event_date"),
                      F.col("EVENT_ID").alias("event_id"),
                      F.col("final_id").isNull().cast("int").alias("missing_survey"))


EVENT_IDS_SQL = """
WITH ev AS (SELECT *, CAST(ts AS DATE) AS event_date FROM events),
s AS (SELECT DISTINCT user_id, event_date FROM ev WHERE event_type = 'purchase'),
v AS (SELECT user_id, event_date, CAST(user_id AS VARCHAR) || '_' || strftime(MIN(ts), '%Y%m%dT%H%M') AS event_id
      FROM ev WHERE event_type = 'view' GROUP BY 1, 2)
SELECT s.user_id, s.event_date, v.event_id, CAST(v.event_id IS NULL AS INTEGER) AS missing_survey
FROM s LEFT JOIN v USING (user_id, event_date)"""


# -- STR-09, DOM-15/27: ordered corrections over distinct names -------------
NAME_RULES = [("_bolt", "_bo", False), ("_bo", "_bolt", False), ("blue_", "azure_", True), ("^new_", "fresh_", False)]


def ordered_corrections(spark, d):
    p = table(spark, d, "part").select("p_partkey", X.normalise_taxon("p_name").alias("taxon_name"))
    rules = CFG.TAXON_CLEANING + NAME_RULES + CFG.TAXON_CORRECTIONS
    return L.correct_distinct(p, "taxon_name", rules, out="taxon_id")


def _ordered_sql(expr, rules):
    out = expr
    for pat, rep, literal in rules:
        rep_sql = rep.replace("'", "''")
        if literal:
            out = f"replace({out}, '{pat}', '{rep_sql}')"
        else:
            out = f"regexp_replace({out}, '{pat}', '{rep_sql}', 'g')"
    return out


ORDERED_CORRECTIONS_SQL = f"""
WITH p AS (SELECT p_partkey, trim(replace(lower(p_name), ' ', '_')) AS taxon_name FROM part)
SELECT p_partkey, taxon_name,
       {_ordered_sql('taxon_name', CFG.TAXON_CLEANING + NAME_RULES + CFG.TAXON_CORRECTIONS)} AS taxon_id
FROM p"""


QUERIES = {
    "text_functions": text_functions,
    "date_functions": date_functions,
    "date_audit": date_audit,
    "case_and_map": case_and_map,
    "count_qualifier": count_qualifier,
    "crosswalk_replace": crosswalk_replace,
    "event_ids": event_ids,
    "ordered_corrections": ordered_corrections,
}

SQL = {
    "text_functions": TEXT_FUNCTIONS_SQL,
    "date_functions": DATE_FUNCTIONS_SQL,
    "date_audit": DATE_AUDIT_SQL,
    "case_and_map": CASE_AND_MAP_SQL,
    "count_qualifier": COUNT_QUALIFIER_SQL,
    "crosswalk_replace": CROSSWALK_REPLACE_SQL,
    "event_ids": EVENT_IDS_SQL,
    "ordered_corrections": ORDERED_CORRECTIONS_SQL,
}
