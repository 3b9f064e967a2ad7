"""Corrections, history, reports and in-house rows on the driver tables.

Stand-in inputs only bring rows into the layout that a flow expects; ids,
dates and counts come from the tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stonefly.config import site_events
from stonefly.functions import dates as D
from stonefly.functions.id_rules import correct_ids
from stonefly.operators import joins as J
from stonefly.operators import lookup as L
from stonefly.plans import domain_queries as DQ
from stonefly.plans import lab as LAB
from stonefly.plans import warehouse as WH
from stonefly.plans.text_queries import SITE_ID_SQL, site_id_expr
from stonefly.sources.tables import table


def _texts(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# -- DOM-15: site-id corrections, all rules in order ------------------------------------------
# Every order names a site: one that the rule list knows (by turns), or the customer's own; a third
# carries an event's date, a third date and time.
_SITE_NAMES = list(dict.fromkeys(x for rule in site_events.SITE for x in rule))


def site_corrections(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, d, "customer").select("c_custkey", site_id_expr().alias("own"))
    turn = (F.col("o_orderkey") % (len(_SITE_NAMES) + 40)).cast("int")
    known = F.array(*[F.lit(x) for x in _SITE_NAMES])
    site = F.when(turn < len(_SITE_NAMES), F.get(known, turn)).otherwise(F.col("own"))
    tail = F.when(F.col("o_orderkey") % 3 == 0, "").when(F.col("o_orderkey") % 3 == 1, D.format_date("o_orderdate", "_%Y%m%d")).otherwise(
        F.date_format("o_orderdate", "'_'yyyyMMdd'T'HHmm"))
    rows = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", F.concat(site, tail).alias("given_id"))
    return correct_ids(rows, "given_id", site_events.SITE, out="site_or_event_id")


SITE_CORRECTIONS_SQL = f"""
WITH RECURSIVE known AS (SELECT [{_texts(_SITE_NAMES)}] AS names),
v AS (SELECT o_orderkey, (CASE WHEN o_orderkey % {len(_SITE_NAMES) + 40} < {len(_SITE_NAMES)}
        THEN names[1 + o_orderkey % {len(_SITE_NAMES) + 40}] ELSE {SITE_ID_SQL} END)
        || (CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN '_' || strftime(o_orderdate, '%Y%m%d')
            ELSE '_' || strftime(o_orderdate, '%Y%m%dT%H%M') END) AS given_id
      FROM orders JOIN customer ON o_custkey = c_custkey, known),
rules(i, old, new) AS (VALUES {', '.join(f"({i}, '{a}', '{b}')" for i, (a, b) in enumerate(site_events.SITE))}),
r AS (SELECT DISTINCT given_id, given_id AS x, 0 AS i FROM v
      UNION ALL
      SELECT given_id, CASE WHEN x = old OR (starts_with(x, old) AND regexp_matches(substr(x, length(old) + 1), '^_[0-9]{{8}}'))
                            THEN new || substr(x, length(old) + 1) ELSE x END, r.i + 1
      FROM r JOIN rules ON rules.i = r.i)
SELECT o_orderkey, given_id, x AS site_or_event_id FROM v JOIN r USING (given_id) WHERE r.i = {len(site_events.SITE)}"""


# -- DOM-16: event-id corrections -------------------------------------------------------------
_EVENT_NAMES = [old for old, _ in site_events.EVENT]


def event_corrections(spark, d):
    ev = table(spark, d, "events").select("event_id", "user_id", "ts")
    turn = (F.col("event_id") % (2 * len(_EVENT_NAMES))).cast("int")
    own = F.concat(F.col("user_id").cast("string"), F.date_format("ts", "'_'yyyyMMdd'T'HHmm"))
    given = F.when(turn < len(_EVENT_NAMES), F.get(F.array(*[F.lit(x) for x in _EVENT_NAMES]), turn)).otherwise(own)
    rows = ev.select("event_id", given.alias("given_id"))
    return rows.withColumn("corrected_id", L.case_map("given_id", site_events.event_map(), keep_unmatched=True))


EVENT_CORRECTIONS_SQL = f"""
WITH known AS (SELECT [{_texts(_EVENT_NAMES)}] AS names),
m(old, new) AS (VALUES {', '.join(f"('{a}', '{b}')" for a, b in site_events.event_map().items())}),
v AS (SELECT event_id, CASE WHEN event_id % {2 * len(_EVENT_NAMES)} < {len(_EVENT_NAMES)} THEN names[1 + event_id % {2 * len(_EVENT_NAMES)}]
        ELSE CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y%m%dT%H%M') END AS given_id FROM events, known)
SELECT event_id, given_id, coalesce(m.new, given_id) AS corrected_id FROM v LEFT JOIN m ON given_id = m.old"""


# -- DOM-13: corrections keyed by site and date ------------------------------------------------
def keyed_corrections(spark, d):
    """Urgent orders are the corrections: they set status and price of all orders of their customer and day."""
    o = table(spark, d, "orders").withColumn("day", F.to_date("o_orderdate"))
    fixes = o.filter("o_orderpriority = '1-URGENT'").select("o_custkey", "day", "o_orderstatus", "o_totalprice")
    rows = o.select("o_orderkey", "o_custkey", "day", "o_orderstatus", "o_totalprice")
    return L.apply_key_corrections(rows, ["o_custkey", "day"], fixes, ["o_orderstatus", "o_totalprice"])


KEYED_CORRECTIONS_SQL = """
WITH o AS (SELECT *, CAST(o_orderdate AS DATE) AS day FROM orders),
f AS (SELECT * FROM (SELECT o_custkey, day, o_orderstatus, o_totalprice,
        row_number() OVER (PARTITION BY o_custkey, day ORDER BY o_orderstatus NULLS LAST, o_totalprice NULLS LAST) AS r
        FROM o WHERE o_orderpriority = '1-URGENT') WHERE r = 1)
SELECT o_orderkey, o.o_custkey, o.day, coalesce(f.o_orderstatus, o.o_orderstatus) AS o_orderstatus,
       coalesce(f.o_totalprice, o.o_totalprice) AS o_totalprice
FROM o LEFT JOIN f ON o.o_custkey IS NOT DISTINCT FROM f.o_custkey AND o.day IS NOT DISTINCT FROM f.day"""


# -- JN-12: what a lookup by name would have to choose from --------------------------------------
def lookup_conflict_report(spark, d):
    p = table(spark, d, "part").select("p_name", "p_brand")
    return L.lookup_conflicts(p, ["p_name"], ["p_brand"])


LOOKUP_CONFLICT_REPORT_SQL = """
SELECT p_name, count(DISTINCT p_brand) AS n_values, min(p_brand) AS p_brand FROM part GROUP BY p_name HAVING count(DISTINCT p_brand) > 1"""


def guarded_lookup(spark, d):
    """Line items with the segment of their order's customer; both lookups fail the job if a key repeats."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    o = J.unique_or_fail(table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("custkey")), ["l_orderkey"], "orders")
    c = J.unique_or_fail(table(spark, d, "customer").select(F.col("c_custkey").alias("custkey"), "c_mktsegment"), ["custkey"], "customer")
    return J.skew_join(J.skew_join(li, o, ["l_orderkey"]), c, ["custkey"]).select("l_orderkey", "l_linenumber", "c_mktsegment")


GUARDED_LOOKUP_SQL = """
SELECT l_orderkey, l_linenumber, c_mktsegment FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN customer ON o_custkey = c_custkey"""


# -- JN-06: inner join on two columns of different names ------------------------------------------
def composite_inner_join(spark, d):
    """Line items with the total of their supplier's lines of the same day."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", F.to_date("l_shipdate").alias("ship_day"), "l_quantity")
    totals = li.groupBy(F.col("l_suppkey").alias("supplier"), F.col("ship_day").alias("day")).agg(F.sum("l_quantity").alias("supplier_day_quantity"))
    return J.join_renamed(li, totals, ["l_suppkey", "ship_day"], ["supplier", "day"], "inner")


COMPOSITE_INNER_JOIN_SQL = """
WITH li AS (SELECT l_orderkey, l_linenumber, l_suppkey, CAST(l_shipdate AS DATE) AS ship_day, l_quantity FROM lineitem),
t AS (SELECT l_suppkey, ship_day, sum(l_quantity) AS supplier_day_quantity FROM li GROUP BY 1, 2)
SELECT l_orderkey, l_linenumber, li.l_suppkey, li.ship_day, l_quantity, supplier_day_quantity
FROM li JOIN t ON li.l_suppkey = t.l_suppkey AND li.ship_day = t.ship_day"""


# -- JN-11: shared column names get suffixes --------------------------------------------------------
def suffixed_join(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("custkey"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    per = o.groupBy("custkey").agg(F.max("status").alias("status"), F.max("price").alias("price"), F.count(F.lit(1)).alias("n"))
    return J.join_with_suffixes(o, per, ["custkey"]).toDF("custkey", "status_own", "price_own", "status_max", "price_max", "n")


SUFFIXED_JOIN_SQL = """
WITH o AS (SELECT o_custkey AS custkey, o_orderstatus AS status, o_totalprice AS price FROM orders),
p AS (SELECT custkey, max(status) AS status, max(price) AS price, count(*) AS n FROM o GROUP BY 1)
SELECT o.custkey, o.status AS status_own, o.price AS price_own, p.status AS status_max, p.price AS price_max, n
FROM o LEFT JOIN p ON o.custkey IS NOT DISTINCT FROM p.custkey"""


# -- DOM-02, DOM-05: in-house rows, sample totals summed ---------------------------------------------
def _in_house_raw(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    j = li.join(o.join(c, o.o_custkey == c.c_custkey), li.l_orderkey == o.o_orderkey)
    return j.select(
        F.concat(F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.lit("-"), F.substring("c_mktsegment", 1, 4)).alias("LOCATION"),
        F.floor("c_acctbal").cast("string").alias("STATION"), D.format_date("o_orderdate", "%m/%d/%Y").alias("DATE"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("COLLECT"), F.lit(1).alias("REPLICATE"),
        F.col("l_partkey").cast("string").alias("GENSPECIES"), F.col("l_quantity").cast("int").alias("INDIV"))


def in_house_samples(spark, d):
    prepared = LAB.prepare_in_house(_in_house_raw(spark, d))
    h = LAB.history_tables(prepared, taxonomist="SBU", total="sum", site_col="site_id", date_format="%m/%d/%Y",
                           method_names=LAB.collect_method_table(spark))
    return h["sample_event"].drop("MSSIH_GROUP", "MSSIH_TOTAL_INDIV_CNT_NOTE")


IN_HOUSE_SAMPLES_SQL = f"""
WITH {DQ._CM_SQL},
raw AS (SELECT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '-' || substr(c_mktsegment, 1, 4) || '-'
               || CAST(CAST(floor(c_acctbal) AS BIGINT) AS DOUBLE) AS site, CAST(o_orderdate AS DATE) AS day,
               CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS method, CAST(l_quantity AS INTEGER) AS n
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
s AS (SELECT site, day, method, sum(n) AS total FROM raw GROUP BY 1, 2, 3)
SELECT site || '_' || strftime(day, '%Y%m%d') || '_' || coalesce(CAST(method AS VARCHAR), BIOSAMPLE_COLLECT_METHOD) || '_1' AS MSSIH_LINKED_ID_VALIDATOR,
       method AS MSSIH_BIOSAMPLE_COLLECT_METHOD_NUM, site AS MSSIH_EVENT_SMAS_HISTORY_ID,
       strftime(day, '%m/%d/%Y') AS MSSIH_EVENT_SMAS_SAMPLE_DATE, 1 AS MSSIH_REPLICATE, 'SBU' AS MSSIH_TAXONOMIST,
       BIOSAMPLE_COLLECT_METHOD AS MSSIH_BIOSAMPLE_COLLECT_METHOD, CAST(total AS DOUBLE) AS MSSIH_TOTAL_INDIV_CNT
FROM s LEFT JOIN cm ON method = BIOSAMPLE_COLLECT_METHOD_ID"""


# -- MET-13: methods without an id, and their samples ------------------------------------------------
def unknown_method_report(spark, d):
    return LAB.unknown_methods(DQ._prepared(spark, d))


UNKNOWN_METHOD_REPORT_SQL = f"""WITH {DQ.PREP_SQL}
SELECT MSSIH_BIOSAMPLE_COLLECT_METHOD AS collection_method, count(*) AS n_rows, count(DISTINCT site_id) AS n_sites
FROM prep WHERE COLLECT IS NULL GROUP BY 1"""


# -- IO-12: a history of two runs, published as versions ---------------------------------------------
def merged_history(spark, d):
    """Run one publishes the finished orders, run two all orders of a line that came back, with its quantity."""
    import uuid

    from stonefly.session import scratch_path
    from stonefly.sources.versions import VersionedTable
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    back = (table(spark, d, "lineitem").filter("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(F.sum("l_quantity").alias("returned_quantity")))
    history = VersionedTable(spark, scratch_path(spark, f"merged-history-{uuid.uuid4().hex}"), ["o_orderkey"], parts=8)
    history.merge(o.filter("o_orderstatus = 'F'"), "run 1")
    history.merge(o.join(back, "o_orderkey").drop("o_totalprice"), "run 2")
    return history.read()


MERGED_HISTORY_SQL = """
WITH back AS (SELECT l_orderkey, sum(l_quantity) AS returned_quantity FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
two AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(NULL AS DOUBLE) AS o_totalprice, returned_quantity
        FROM orders JOIN back ON o_orderkey = l_orderkey)
SELECT * FROM two
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(NULL AS DOUBLE) FROM orders
WHERE o_orderstatus = 'F' AND o_orderkey NOT IN (SELECT o_orderkey FROM two)"""


# -- DOM-14: register of samples without a survey ----------------------------------------------------
def missing_surveys(spark, d):
    """Purchases are samples, views are surveys; the first 100 users are the known sites, errors bring reviewers' notes."""
    ev = table(spark, d, "events").withColumn("DATE", F.to_date("ts"))
    samples = ev.filter("event_type = 'purchase'").select(F.col("user_id").alias("site_id"), "DATE").distinct()
    events = (ev.filter("event_type = 'view'").groupBy(F.col("user_id").alias("site_id"), "DATE")
              .agg(F.min("event_id").alias("final_id"), F.min("ts").alias("EVENT_TIME")))
    _, missing = WH.attach_events(samples, events)
    sites = ev.filter("user_id <= 100").select("user_id").distinct()
    notes = ev.filter("event_type = 'error'").groupBy("user_id").agg(
        F.lit("F").alias("missing_site"), F.lit("T").alias("missing_survey"), F.concat(F.lit("errors: "), F.count(F.lit(1)).cast("string")).alias("notes"))
    return WH.missing_survey_register(missing.select("site_id", "DATE"), sites, notes)


MISSING_SURVEYS_SQL = """
WITH ev AS (SELECT *, CAST(ts AS DATE) AS DATE FROM events),
s AS (SELECT DISTINCT user_id AS site_id, DATE FROM ev WHERE event_type = 'purchase'),
m AS (SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM ev WHERE event_type = 'view' AND user_id = site_id AND ev.DATE = s.DATE)),
n AS (SELECT user_id, count(*) AS c FROM ev WHERE event_type = 'error' GROUP BY 1)
SELECT site_id, DATE, CASE WHEN c IS NOT NULL THEN 'F' WHEN site_id IN (SELECT user_id FROM ev WHERE user_id <= 100) THEN 'F' ELSE 'T' END AS missing_site,
       CASE WHEN c IS NOT NULL THEN 'T' ELSE 'F' END AS missing_survey, CASE WHEN c IS NOT NULL THEN 'errors: ' || c ELSE '' END AS notes
FROM m LEFT JOIN n ON site_id = user_id"""


# -- DOM-32: metrics with all fields of their sample -------------------------------------------------
def metrics_all_fields(spark, d):
    """Per order and status a quantity (the metric), joined with the order's fields on five columns."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"), "o_orderstatus", F.col("o_orderpriority").alias("prio"), "o_totalprice")
    li = table(spark, d, "lineitem").select("l_orderkey", "l_quantity")
    keys = ["o_orderkey", "o_custkey", "day", "o_orderstatus", "prio"]
    metrics = li.join(o.drop("o_totalprice"), li.l_orderkey == o.o_orderkey).groupBy(*keys).agg(F.sum("l_quantity").alias("quantity"))
    return LAB.metrics_with_samples(metrics, o, keys)


METRICS_ALL_FIELDS_SQL = """
WITH q AS (SELECT l_orderkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1)
SELECT DISTINCT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, o_orderstatus, o_orderpriority AS prio, quantity, o_totalprice
FROM orders JOIN q ON o_orderkey = l_orderkey"""


QUERIES = {
    "site_corrections": site_corrections,
    "event_corrections": event_corrections,
    "keyed_corrections": keyed_corrections,
    "lookup_conflict_report": lookup_conflict_report,
    "guarded_lookup": guarded_lookup,
    "composite_inner_join": composite_inner_join,
    "suffixed_join": suffixed_join,
    "in_house_samples": in_house_samples,
    "unknown_method_report": unknown_method_report,
    "merged_history": merged_history,
    "missing_surveys": missing_surveys,
    "metrics_all_fields": metrics_all_fields,
}

SQL = {
    "site_corrections": SITE_CORRECTIONS_SQL,
    "event_corrections": EVENT_CORRECTIONS_SQL,
    "keyed_corrections": KEYED_CORRECTIONS_SQL,
    "lookup_conflict_report": LOOKUP_CONFLICT_REPORT_SQL,
    "guarded_lookup": GUARDED_LOOKUP_SQL,
    "composite_inner_join": COMPOSITE_INNER_JOIN_SQL,
    "suffixed_join": SUFFIXED_JOIN_SQL,
    "in_house_samples": IN_HOUSE_SAMPLES_SQL,
    "unknown_method_report": UNKNOWN_METHOD_REPORT_SQL,
    "merged_history": MERGED_HISTORY_SQL,
    "missing_surveys": MISSING_SURVEYS_SQL,
    "metrics_all_fields": METRICS_ALL_FIELDS_SQL,
}
