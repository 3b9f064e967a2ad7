"""End-to-end domain flows on the driver tables.

``lab_rows`` renames lineitem x orders x customer x part to the contract
lab layout (one row per sample and taxon): the customer gives the site id,
the order date the sample date (two text formats, as in real files), the
order status the replicate, the priority digit the collection method, the
part the taxon and ``l_quantity`` the count.  ``part`` doubles as the
master taxa table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stonefly.config import corrections as CFG
from stonefly.config import scoring
from stonefly.config.descriptions import PARAMETER_DESCRIPTIONS
from stonefly.functions import dates as D
from stonefly.functions import text as X
from stonefly.functions.numeric import round_r_sql as r_sql
from stonefly.operators.aggregates import repeated_groups
from stonefly.operators.joins import join_null_safe
from stonefly.plans import lab as LAB
from stonefly.plans import sqlgen as S
from stonefly.plans import warehouse as WH
from stonefly.plans.metric_queries import EPT_BRANDS, NON_NCO_TYPES, TOLERANCE_MAX_SIZE
from stonefly.plans.text_queries import (SITE_ID_SQL, _method_name, _method_name_sql, _mdy_text,
                                         site_id_expr)
from stonefly.sources.tables import table

MASTER_MAX_SIZE = 45  # parts above this size are "new species" for the check


def lab_headers(spark, d):
    """What the lab layout has from orders x customer, one row an order: the key
    ``_order`` and the columns that all rows of an order share."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                                         "o_orderpriority", "o_totalprice")
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    site = site_id_expr()
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").alias("_order"),
        site.alias("MSSIH_EVENT_SMAS_HISTORY_ID"),
        _mdy_text().alias("MSSIH_EVENT_SMAS_SAMPLE_DATE"),
        F.when(F.col("o_orderstatus") == "P", F.lit(2)).otherwise(F.lit(1)).alias("MSSIH_REPLICATE"),
        _method_name().alias("MSSIH_BIOSAMPLE_COLLECT_METHOD"),
        F.floor(F.col("o_totalprice") / 1000).cast("int").alias("MSSIH_TOTAL_INDIV_CNT_IND"),
        F.col("c_mktsegment").alias("Client_Project_Name"),
        F.lit("").alias("group"),
        D.event_id(site, "o_orderdate").alias("event_id"))


def lab_taxa(spark, d):
    """Part keys with the taxon name of the lab layout."""
    name = F.concat(F.col("p_name"), F.lit(" "), F.col("p_partkey").cast("string"))
    return table(spark, d, "part").select("p_partkey", name.alias("MSDH_GENSPECIES"))


def with_lines(spark, d, headers, taxa, steps=None):
    """Rows of lineitem with the columns of their order's header (key ``_order``) and of their taxon (key ``p_partkey``).

    Headers and taxa come with their texts made, once an order and once a taxon
    instead of once a line, and the lineitem-sized rows are shuffled twice:
    by the order and by the part.  ``steps``: the lines are written with their
    taxa's columns (and no line number) between the two shuffles.
    """
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    if steps is not None:
        li = li.join(taxa, li.l_partkey == taxa["p_partkey"]).drop("l_partkey", "p_partkey", "l_linenumber")
        return steps.write(li, "lines").join(headers, F.col("l_orderkey") == headers["_order"])
    return li.join(headers, li.l_orderkey == headers["_order"]).join(taxa, li.l_partkey == taxa["p_partkey"])


def lab_rows(spark, d):
    j = with_lines(spark, d, lab_headers(spark, d), lab_taxa(spark, d))
    return j.select(
        F.concat(F.lit("L"), F.col("l_orderkey").cast("string")).alias("WAA_ID"),
        "MSSIH_EVENT_SMAS_HISTORY_ID", "MSSIH_EVENT_SMAS_SAMPLE_DATE", "MSSIH_REPLICATE",
        "MSSIH_BIOSAMPLE_COLLECT_METHOD",
        F.lit("WAA").alias("MSSIH_TAXONOMIST"),
        "MSDH_GENSPECIES",
        F.col("l_quantity").cast("int").alias("MSDH_INDIVIDUAL_SPECIES_CNT"),
        "MSSIH_TOTAL_INDIV_CNT_IND",
        F.lit("").alias("MSSIH_TOTAL_INDIV_CNT_NOTE"),
        F.when(F.col("l_linenumber") <= 2, F.col("l_linenumber").cast("string")).otherwise(F.lit(""))
        .alias("X_Grids"),
        "Client_Project_Name", "group", "event_id")


LAB_SQL = f"""
lab AS (
  SELECT 'L' || CAST(l_orderkey AS VARCHAR) AS WAA_ID,
         {SITE_ID_SQL} AS MSSIH_EVENT_SMAS_HISTORY_ID,
         CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%m/%d/%Y')
              ELSE strftime(o_orderdate, '%m-%d-%Y') END AS MSSIH_EVENT_SMAS_SAMPLE_DATE,
         CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END AS MSSIH_REPLICATE,
         {_method_name_sql()} AS MSSIH_BIOSAMPLE_COLLECT_METHOD,
         'WAA' AS MSSIH_TAXONOMIST,
         p_name || ' ' || CAST(p_partkey AS VARCHAR) AS MSDH_GENSPECIES,
         CAST(l_quantity AS INTEGER) AS MSDH_INDIVIDUAL_SPECIES_CNT,
         CAST(FLOOR(o_totalprice / 1000) AS INTEGER) AS MSSIH_TOTAL_INDIV_CNT_IND,
         '' AS MSSIH_TOTAL_INDIV_CNT_NOTE,
         CASE WHEN l_linenumber <= 2 THEN CAST(l_linenumber AS VARCHAR) ELSE '' END AS X_Grids,
         c_mktsegment AS Client_Project_Name,
         '' AS "group",
         {SITE_ID_SQL} || '_' || strftime(o_orderdate, '%Y%m%dT%H%M') AS event_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN part ON l_partkey = p_partkey)"""

_CM_SQL = ("cm(BIOSAMPLE_COLLECT_METHOD, BIOSAMPLE_COLLECT_METHOD_ID) AS (VALUES "
           + ", ".join(f"('{n}', {i})" for i, n in scoring.METHOD_NAMES.items()) + ")")

PREP_SQL = f"""{LAB_SQL},
{_CM_SQL},
prep AS (SELECT lab.*, MSSIH_EVENT_SMAS_HISTORY_ID AS site_id, BIOSAMPLE_COLLECT_METHOD_ID AS COLLECT,
                MSSIH_REPLICATE AS Replicate, MSDH_GENSPECIES AS MACRO_GENSPECIES,
                MSDH_INDIVIDUAL_SPECIES_CNT AS INDIV, MSSIH_EVENT_SMAS_SAMPLE_DATE AS COLL_DATE
         FROM lab LEFT JOIN cm ON lab.MSSIH_BIOSAMPLE_COLLECT_METHOD = cm.BIOSAMPLE_COLLECT_METHOD),
pd AS (SELECT *, CAST(COALESCE(try_strptime(COLL_DATE, '%m/%d/%Y'), try_strptime(COLL_DATE, '%m-%d-%Y')) AS DATE)
                 AS coll FROM prep),
k AS (SELECT *, MSSIH_EVENT_SMAS_HISTORY_ID || '_' || strftime(coll, '%Y%m%d') || '_'
                || COALESCE(CAST(COLLECT AS VARCHAR), MSSIH_BIOSAMPLE_COLLECT_METHOD)
                || '_' || CAST(Replicate AS VARCHAR) AS MSSIH_LINKED_ID_VALIDATOR,
              strftime(coll, '%m-%d-%Y') AS sample_date_text FROM pd),
tot AS (SELECT MSSIH_LINKED_ID_VALIDATOR, CAST(MAX(MSSIH_TOTAL_INDIV_CNT_IND) AS DOUBLE) AS MSSIH_TOTAL_INDIV_CNT
        FROM k GROUP BY 1),
se AS (SELECT DISTINCT k.MSSIH_LINKED_ID_VALIDATOR, COLLECT AS MSSIH_BIOSAMPLE_COLLECT_METHOD_NUM,
              MSSIH_EVENT_SMAS_HISTORY_ID, sample_date_text AS MSSIH_EVENT_SMAS_SAMPLE_DATE,
              Replicate AS MSSIH_REPLICATE, 'WAA' AS MSSIH_TAXONOMIST, '' AS MSSIH_TOTAL_INDIV_CNT_NOTE,
              MSSIH_BIOSAMPLE_COLLECT_METHOD, "group" AS MSSIH_GROUP, tot.MSSIH_TOTAL_INDIV_CNT
       FROM k JOIN tot USING (MSSIH_LINKED_ID_VALIDATOR))"""


def _prepared(spark, d):
    return LAB.prepare_contract_lab(lab_rows(spark, d), LAB.collect_method_table(spark))


def _history(spark, d):
    return LAB.history_tables(_prepared(spark, d), taxonomist="WAA", total="max")


# -- DOM-01 + DOM-06: sample-event table ---------------------------------------
def sample_event_table(spark, d):
    return _history(spark, d)["sample_event"]


SAMPLE_EVENT_TABLE_SQL = f"WITH {PREP_SQL}\nSELECT * FROM se"


# -- DOM-05/06: species-history table ---------------------------------------------
def species_history_table(spark, d):
    return _history(spark, d)["species_history"]


SPECIES_HISTORY_TABLE_SQL = f"""WITH {PREP_SQL}
SELECT MSSIH_LINKED_ID_VALIDATOR AS MSDH_LINKED_ID_VALIDATOR, INDIV AS MSDH_INDIVIDUAL_SPECIES_CNT,
       regexp_replace(lower(MACRO_GENSPECIES), ' ', '_', 'g') AS MSTR_MACRO_SPECIES_ID
FROM k"""


# -- DOM-07/08, MET-*: published wide metrics per sample ---------------------------
def _master_taxa(spark, d):
    p = table(spark, d, "part")
    return p.select(
        F.regexp_replace(F.lower(F.concat(F.col("p_name"), F.lit(" "), F.col("p_partkey").cast("string"))), " ", "_")
        .alias("taxon"),
        F.coalesce(F.col("p_brand").isin(EPT_BRANDS), F.lit(False)).alias("is_ept"),
        (~F.coalesce(F.col("p_type").isin(NON_NCO_TYPES), F.lit(False))).alias("is_nco"),
        F.when(F.col("p_size") <= TOLERANCE_MAX_SIZE, F.col("p_size") / 4.0).alias("tolerance"),
        (F.floor("p_retailprice") / 256.0).alias("nbi_p_tolerance"),
        F.col("p_type").alias("taxon_group"))


_MASTER_SQL = f"""
taxa AS (SELECT regexp_replace(lower(p_name || ' ' || CAST(p_partkey AS VARCHAR)), ' ', '_', 'g') AS taxon,
                COALESCE(p_brand IN {S.in_list(EPT_BRANDS)}, FALSE) AS is_ept,
                NOT COALESCE(p_type IN {S.in_list(NON_NCO_TYPES)}, FALSE) AS is_nco,
                CASE WHEN p_size <= {TOLERANCE_MAX_SIZE} THEN p_size / 4.0 END AS tolerance,
                FLOOR(p_retailprice) / 256.0 AS nbi_p_tolerance, p_type AS taxon_group FROM part)"""


_LONG_CARRY = ["site_id", "date", "collection_method", "replicate", "sample_group", "event_id"]
_LONG_LARGEST = ["total_individual_count"]


def _sample_rows(spark, d, with_sample_cols: bool = False, steps=None):
    """One row per linked id: sample keys are made once an order, one
    (sample, taxon) aggregate over the lines, then one array a sample; the
    sample's own columns come from the orders that have a line.  ``steps``:
    see ``_sample_rows_by_number``."""
    headers = LAB.with_sample_ids(LAB.prepare_contract_lab(
        lab_headers(spark, d), LAB.collect_method_table(spark), keep=["_order"]))
    keys = [F.col("MSSIH_LINKED_ID_VALIDATOR").alias("sid"), F.col("COLLECT").alias("method")]
    sample_cols = [F.col("MSSIH_EVENT_SMAS_HISTORY_ID").alias("site_id"),
                   D.format_date("_coll", "%Y%m%d").alias("date"),
                   F.col("MSSIH_BIOSAMPLE_COLLECT_METHOD").alias("collection_method"),
                   F.col("Replicate").cast("string").alias("replicate"),
                   F.col("MSSIH_GROUP").alias("sample_group"), "event_id",
                   F.col("MSSIH_TOTAL_INDIV_CNT_IND").cast("double").alias("total_individual_count")]
    taxa = lab_taxa(spark, d).select("p_partkey", F.regexp_replace(F.lower("MSDH_GENSPECIES"), " ", "_").alias("taxon"))
    if steps is not None:
        return _sample_rows_by_number(spark, d, headers.select("_order", *keys, *sample_cols), taxa, steps)
    lines = with_lines(spark, d, headers.select("_order", *keys), taxa)
    rows = lines.select("sid", "method", "taxon", F.col("l_quantity").cast("int").cast("double").alias("n"))
    carry, largest, own = [], [], None
    if with_sample_cols:
        carry, largest = _LONG_CARRY, _LONG_LARGEST
        li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey")
        part = table(spark, d, "part").select("p_partkey")
        used = li.join(part, li.l_partkey == part.p_partkey, "left_semi").select("l_orderkey")
        own = headers.join(used, headers["_order"] == used.l_orderkey, "left_semi").select(*keys, *sample_cols)
    return LAB.sample_rows(rows, _master_taxa(spark, d), carry=carry, largest=largest, own=own)


def _sample_rows_by_number(spark, d, headers, taxa, steps):
    """``_sample_rows`` with the samples' columns, for tables whose shuffles don't
    lie on the disks together: each step is written, and what it read goes.

    Numbers stand for the texts on all line-sized rows: ``_sample`` for
    (sid, method), ``_group`` for a sample's set of columns, and one for
    a taxon's name.  They are given to distinct values and written, so the same
    text has the same number and no two share one.
    """
    number = F.monotonically_increasing_id()
    texts = ["sid", "method", *_LONG_CARRY]
    headers = steps.write(headers.filter(F.col("sid").isNotNull()), "headers")
    sets = steps.write(headers.select(*texts).distinct().withColumn("_group", number), "sets")
    samples = steps.write(sets.select("sid", "method").distinct().withColumn("_sample", number), "samples")
    groups = steps.write(join_null_safe(sets, samples, ["sid", "method"]), "groups")
    orders = steps.write(join_null_safe(headers, groups, texts).select("_order", "_sample", "_group", *_LONG_LARGEST), "orders")
    steps.drop("headers", "sets", "samples")

    names = taxa.select("taxon").filter(F.col("taxon").isNotNull()).distinct()
    names = steps.write(names.withColumn("_taxon", number), "names")
    taxa = steps.write(taxa.join(names, "taxon", "left").select("p_partkey", F.col("_taxon").alias("taxon")), "taxa")
    master = _master_taxa(spark, d).join(names, "taxon").drop("taxon").withColumnRenamed("_taxon", "taxon")

    lines = with_lines(spark, d, orders, taxa, steps)
    rows = steps.write(lines.select("_sample", "_group", "taxon", F.col("l_quantity").cast("int").cast("double").alias("n"),
                                    *_LONG_LARGEST), "rows")
    steps.drop("lines", "orders", "taxa")
    own = rows.groupBy("_group").agg(*[F.max(c).alias(c) for c in _LONG_LARGEST]).join(groups, "_group")
    own = steps.write(own.drop("_group"), "own")
    steps.drop("groups")
    out = LAB.sample_rows(rows.select("_sample", "taxon", "n"), master, ["_sample"], carry=texts, largest=_LONG_LARGEST,
                          own=own, steps=steps, spent=["rows"])
    steps.drop("names")
    return out.drop("_sample")


def published_metrics(spark, d):
    return LAB.metric_table(LAB.score_sample_rows(_sample_rows(spark, d), LAB.batch_group_model))


_SCORED_METRICS = ["richness", "ept_richness", "hilsenhoff_biotic_index", "percent_model_affinity",
                   "nutrient_biotic_index_phosphorus", "shannon_diversity", "non_chiro_oligo_richness",
                   "percent_dominance_3"]
_INT_METRICS = {"richness", "ept_richness", "non_chiro_oligo_richness"}


def _scored_sql():
    scores = ",\n       ".join(f"{S.method_score_sql('method', m)} AS score_{m}" for m in _SCORED_METRICS)
    return f"""{PREP_SQL},
{_MASTER_SQL},
sh AS (SELECT MSSIH_LINKED_ID_VALIDATOR AS sid, regexp_replace(lower(MACRO_GENSPECIES), ' ', '_', 'g') AS taxon,
              CAST(INDIV AS DOUBLE) AS n FROM k),
meth AS (SELECT DISTINCT MSSIH_LINKED_ID_VALIDATOR AS sid, MSSIH_BIOSAMPLE_COLLECT_METHOD_NUM AS method FROM se),
c AS (SELECT sid, taxon, SUM(n) AS n FROM sh GROUP BY 1, 2),
j AS (SELECT c.*, meth.method, taxa.is_ept, taxa.is_nco, taxa.tolerance, taxa.nbi_p_tolerance, taxa.taxon_group
      FROM c JOIN meth USING (sid) LEFT JOIN taxa USING (taxon)),
rk AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY sid, method ORDER BY n DESC, taxon) AS r FROM j),
base AS (SELECT sid, method, SUM(n) AS total_individuals, COUNT(taxon) AS richness,
                COUNT(*) FILTER (WHERE COALESCE(is_ept, FALSE)) AS ept_richness,
                COUNT(*) FILTER (WHERE COALESCE(is_nco, FALSE)) AS non_chiro_oligo_richness,
                SUM(n * tolerance) / SUM(CASE WHEN tolerance IS NOT NULL THEN n END) AS hilsenhoff_biotic_index,
                SUM(n * nbi_p_tolerance) / SUM(CASE WHEN nbi_p_tolerance IS NOT NULL THEN n END)
                    AS nutrient_biotic_index_phosphorus,
                LOG2(SUM(n)) - COALESCE(SUM(CASE WHEN n > 0 THEN n * LOG2(n) END), 0.0) / SUM(n) AS shannon_diversity,
                100.0 * SUM(CASE WHEN r <= 3 THEN n END) / SUM(n) AS percent_dominance_3
         FROM rk GROUP BY 1, 2),
mg AS (SELECT meth.method, t.taxon_group, SUM(s.n) AS g FROM sh s JOIN meth USING (sid) JOIN taxa t USING (taxon)
       GROUP BY 1, 2),
model AS (SELECT method, taxon_group, 100.0 * g / SUM(g) OVER (PARTITION BY method) AS percent FROM mg),
pg AS (SELECT sid, method, taxon_group, SUM(n) AS g FROM j GROUP BY 1, 2, 3),
pt AS (SELECT sid, method, SUM(g) AS tot FROM pg GROUP BY 1, 2),
pma AS (SELECT pg.sid, pg.method, SUM(LEAST(100.0 * pg.g / pt.tot, model.percent)) AS percent_model_affinity
        FROM pg JOIN pt ON pg.sid = pt.sid AND pg.method IS NOT DISTINCT FROM pt.method
        JOIN model ON pg.method IS NOT DISTINCT FROM model.method AND pg.taxon_group = model.taxon_group GROUP BY 1, 2),
every AS (SELECT base.*, COALESCE(pma.percent_model_affinity, 0.0) AS percent_model_affinity
          FROM base LEFT JOIN pma ON base.sid = pma.sid AND base.method IS NOT DISTINCT FROM pma.method),
wide AS (SELECT * REPLACE ({S.metrics_of_method_sql('method', _SCORED_METRICS)}) FROM every),
sc AS (SELECT wide.*,
       {scores}
       FROM wide),
scored AS (SELECT sc.*, {S.profile_sql('method', _SCORED_METRICS)} AS score_bioassessment_profile FROM sc)"""


def _published_select():
    cols = []
    for k, v in LAB.WIDE_TO_PUBLISHED.items():
        if k == "sid":
            continue
        if k == "MSDH_LINKED_ID_VALIDATOR":
            cols.append(f"sid AS {v}")
        elif k in _INT_METRICS:
            cols.append(f"{k} AS {v}")
        else:
            cols.append(f"{r_sql(k, 3)} AS {v}")
    return ",\n       ".join(cols)


PUBLISHED_METRICS_SQL = f"WITH {_scored_sql()}\nSELECT {_published_select()}\nFROM scored"


# -- DOM-11/17/18..23: long metric rows with their sample columns ---------------------
def metrics_long(spark, d, steps=None):
    samples = _sample_rows(spark, d, with_sample_cols=True, steps=steps)
    wide = LAB.metric_table(LAB.score_sample_rows(samples, LAB.batch_group_model), keep=_LONG_CARRY + _LONG_LARGEST)
    if steps is not None:
        # its rows are those of the samples
        wide = samples = steps.write(wide, "wide")
        steps.drop("sample_taxa", "own")
    return WH.metrics_long(wide, low_events=WH.low_count_events(samples))


def _metrics_long_sql():
    long_cols = {k: v for k, v in scoring.LONG_METRIC_COLUMNS.items()}
    pub = {v: k for k, v in LAB.WIDE_TO_PUBLISHED.items()}
    sel = ",\n         ".join(f"CAST(w.{k} AS DOUBLE) AS {v}" for k, v in long_cols.items() if k in pub)
    vals = ", ".join([v for k, v in long_cols.items() if k in pub] + ["total_individual_count"])
    desc = " ".join(f"WHEN parameter_name = '{k}' THEN '{v.replace(chr(39), chr(39) * 2)}'"
                    for k, v in PARAMETER_DESCRIPTIONS.items())
    smeth = " ".join(f"WHEN collection_method = '{k}' THEN '{v}'" for k, v in scoring.SAMPLE_METHODS.items())
    consts = ", ".join(f"'{v}' AS {k}" for k, v in scoring.LONG_METRIC_CONSTANTS.items())
    return f"""WITH {_scored_sql()},
pub AS (SELECT {_published_select()} FROM scored),
ev AS (SELECT DISTINCT MSSIH_LINKED_ID_VALIDATOR AS MMDH_LINKED_ID_VALIDATOR, event_id FROM k),
smp AS (SELECT MSSIH_LINKED_ID_VALIDATOR AS MMDH_LINKED_ID_VALIDATOR, MSSIH_EVENT_SMAS_HISTORY_ID AS site_id,
               strftime(CAST(strptime(MSSIH_EVENT_SMAS_SAMPLE_DATE, '%m-%d-%Y') AS DATE), '%Y%m%d') AS date,
               MSSIH_BIOSAMPLE_COLLECT_METHOD AS collection_method, CAST(MSSIH_REPLICATE AS VARCHAR) AS replicate,
               MSSIH_GROUP AS sample_group, MSSIH_TOTAL_INDIV_CNT AS total_individual_count FROM se),
w AS (SELECT * FROM pub JOIN smp USING (MMDH_LINKED_ID_VALIDATOR) JOIN ev USING (MMDH_LINKED_ID_VALIDATOR)),
ww AS (SELECT w.event_id, w.site_id, w.date, w.collection_method, w.replicate, w.sample_group,
         {sel},
         w.total_individual_count FROM w),
flags AS (SELECT event_id, MAX(CAST({S.below_minimum_sql('collection_method', 'total_individual_count')} AS INTEGER))
                 AS low FROM ww GROUP BY 1),
u AS (UNPIVOT ww ON {vals} INTO NAME parameter_name VALUE result_value),
t AS (SELECT u.event_id, site_id, date, collection_method, replicate, result_value,
             regexp_replace(parameter_name, '^(raw_|score_)', '') AS parameter_name,
             regexp_replace(CASE WHEN starts_with(parameter_name, 'raw_') THEN 'raw'
                                 WHEN starts_with(parameter_name, 'score_') THEN 'score'
                                 WHEN parameter_name = 'total_individual_count' THEN 'raw' END,
                            'score', 'score_0-10', 'g') AS unit,
             COALESCE(flags.low, 0) = 1 AS is_low
      FROM u LEFT JOIN flags USING (event_id))
SELECT event_id, site_id, date, collection_method, replicate, parameter_name, result_value, unit,
       CASE {desc} END AS parameter_description,
       CASE WHEN parameter_name = 'bioassessment_profile' THEN {S.impact_category_sql('result_value')} ELSE '' END
           AS result_category,
       CASE WHEN is_low THEN '{scoring.LOW_COUNT_QUALIFIER}' ELSE '' END AS result_qualifier,
       CASE WHEN is_low AND parameter_name = 'bioassessment_profile' THEN '{scoring.LOW_COUNT_DESCRIPTION}' ELSE ''
           END AS result_qualifier_description,
       CASE {smeth} ELSE '{scoring.SAMPLE_METHOD_DEFAULT}' END AS sample_method,
       {consts}
FROM t"""


# -- RS-03 / DOM-23: staging template split into the PARAMETER target -----------------
PARAMETER_TARGET = ["PARAMETER_NAME", "CASRN", "FRACTION", "MATRIX", "METHOD_SPECIATION", "UNIT"]


def parameter_table(spark, d):
    staged = WH.staging_template(metrics_long(spark, d))
    return WH.split_targets(staged, {"PARAMETER": PARAMETER_TARGET})["PARAMETER"]


# -- VAL-13/14 on a staged target: RESULT table report ---------------------------------
def result_table_report(spark, d):
    from stonefly.functions.numeric import round_half_up
    from stonefly.operators import quality as Q
    from stonefly.session import ScratchSteps, cut_lineage
    # The report reads the target three times (row rules, two key rules):
    # its variable columns are written once instead of recomputing the
    # metric flow each time; constant template columns stay literals.  So is
    # each step of the flow, whose shuffles would fill the disks together.
    # The few rows of the report are a checkpoint, and all steps' tables go.
    steps = ScratchSteps(spark, "result-table-report")
    try:
        target = WH.staging_tables(metrics_long(spark, d, steps), ("RESULT",), materialize=steps)["RESULT"]
        steps.drop("wide")
        rep = Q.validate(target, "RESULT")
        return cut_lineage(rep.select("step", "check_type", "columns", "values", "units", "n_pass",
                                      round_half_up("f_pass", 6).alias("f_pass"), F.col("warn").cast("int").alias("warn")))
    finally:
        steps.drop()


def _result_target_sql():
    from stonefly.config import rules as RULES
    from stonefly.config.templates import RESULT_TEMPLATE, SAMPLE_TEMPLATE
    long_types = {"EVENT_ID": "string", "SITE_ID": "string", "DATE": "string", "COLLECTION_METHOD": "string",
                  "REPLICATE": "string", "PARAMETER_NAME": "string", "RESULT_VALUE": "double", "UNIT": "string",
                  "PARAMETER_DESCRIPTION": "string", "RESULT_CATEGORY": "string", "RESULT_QUALIFIER": "string",
                  "RESULT_QUALIFIER_DESCRIPTION": "string", "SAMPLE_METHOD": "string"}
    long_types.update({k.upper(): "string" for k in scoring.LONG_METRIC_CONSTANTS})
    staged = dict(long_types)
    tmpl = {n: (v, t) for n, v, t in RESULT_TEMPLATE + SAMPLE_TEMPLATE}
    staged.update({n: t for n, (v, t) in tmpl.items()})
    staged = {WH.STAGING_RENAMES.get(k, k): v for k, v in staged.items()}
    cols = [c for c in WH.target_columns("RESULT") if c in staged]
    schema = {c: staged[c] for c in cols}
    sql_type = {"string": "VARCHAR", "double": "DOUBLE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP"}
    src_from = {WH.STAGING_RENAMES.get(k.upper(), k.upper()): k for k in
                ["event_id", "site_id", "date", "collection_method", "replicate", "parameter_name", "result_value",
                 "unit", "parameter_description", "result_category", "result_qualifier",
                 "result_qualifier_description", "sample_method", *scoring.LONG_METRIC_CONSTANTS]}
    sel = []
    for c in cols:
        if c in src_from:
            sel.append(f"{src_from[c]} AS {c}")
        else:
            v, t = tmpl[c]
            lit = "NULL" if v is None else "'" + str(v) + "'"
            sel.append(f"CAST({lit} AS {sql_type[t]}) AS {c}")
    source = f"SELECT DISTINCT {', '.join(sel)} FROM ({_metrics_long_sql()})"
    return S.interrogate_sql(RULES.RESULT.rules, source, schema)


# -- DOM-17: sample table (distinct samples, replicate letters to the group) ------------
def sample_table(spark, d):
    # event_id rides along in the sample aggregate: one pass over the lab rows.
    se = LAB.history_tables(_prepared(spark, d), taxonomist="WAA", total="max",
                            extra_sample_cols=["event_id"])["sample_event"]
    return WH.prep_sample_table(se)


SAMPLE_TABLE_SQL = f"""WITH {PREP_SQL},
ev AS (SELECT DISTINCT MSSIH_LINKED_ID_VALIDATOR, event_id FROM k),
s AS (SELECT se.*, ev.event_id FROM se JOIN ev USING (MSSIH_LINKED_ID_VALIDATOR))
SELECT DISTINCT MSSIH_EVENT_SMAS_HISTORY_ID AS site_id,
       strftime(CAST(COALESCE(try_strptime(MSSIH_EVENT_SMAS_SAMPLE_DATE, '%m-%d-%Y'),
                              try_strptime(MSSIH_EVENT_SMAS_SAMPLE_DATE, '%m/%d/%Y')) AS DATE), '%Y%m%d') AS sample_date,
       CASE WHEN regexp_matches(CAST(MSSIH_REPLICATE AS VARCHAR), '[a-zA-Z]')
            THEN MSSIH_GROUP || '_' || CAST(MSSIH_REPLICATE AS VARCHAR) ELSE MSSIH_GROUP END AS sample_group,
       TRY_CAST(regexp_replace(CAST(MSSIH_REPLICATE AS VARCHAR), '[a-zA-Z]', '', 'g') AS DOUBLE) AS replicate,
       MSSIH_TAXONOMIST AS taxonomist, MSSIH_BIOSAMPLE_COLLECT_METHOD AS collection_method,
       MSSIH_TOTAL_INDIV_CNT AS total_individual_count, event_id
FROM s"""


# -- DOM-24: RMN override on taxa abundance --------------------------------------------
RMN_SEGMENT = "AUTOMOBILE"


def rmn_methods(spark, d):
    taxa = taxa_abundance(spark, d).select("SITE_CODE", "EVENT_ID", "REPLICATE", "TAXON_ID", "LAB_SAMPLE_ID",
                                           "SAMPLE_METHOD")
    rmn_sites = (table(spark, d, "customer").filter(F.col("c_mktsegment") == RMN_SEGMENT)
                 .select(site_id_expr().alias("site")))
    return WH.rmn_override(taxa, rmn_sites)


def _rmn_methods_sql():
    return f"""WITH {_taxa_sql()},
r AS (SELECT DISTINCT {SITE_ID_SQL} AS site FROM customer WHERE c_mktsegment = '{RMN_SEGMENT}')
SELECT SITE_CODE, EVENT_ID, REPLICATE, TAXON_ID, LAB_SAMPLE_ID,
       CASE WHEN SITE_CODE IN (SELECT site FROM r WHERE site IS NOT NULL) AND REPLICATE = 2 THEN 'rmn_kick'
            ELSE SAMPLE_METHOD END AS SAMPLE_METHOD
FROM taxa_ab"""


# -- DOM-26/27: taxa abundance --------------------------------------------------------
def taxa_abundance(spark, d):
    raw = LAB.repair_raw(lab_rows(spark, d).withColumn("MSDH_GENSPECIES", X.normalise_taxon("MSDH_GENSPECIES")))
    return WH.taxa_abundance(raw)


def _ordered_sql(expr, rules):
    out = expr
    for pat, rep, literal in rules:
        rep_sql = rep.replace("'", "''")
        out = (f"replace({out}, '{pat}', '{rep_sql}')" if literal
               else f"regexp_replace({out}, '{pat}', '{rep_sql}', 'g')")
    return out


def _taxa_sql():
    consts = ", ".join((f"{v} AS {k}" if isinstance(v, int) else f"'{v}' AS {k}")
                       for k, v in scoring.TAXA_ABUNDANCE_CONSTANTS.items())
    taxon = _ordered_sql("trim(replace(lower(MSDH_GENSPECIES), ' ', '_'))",
                         CFG.TAXON_CLEANING + CFG.TAXON_CORRECTIONS)
    return f"""{LAB_SQL},
taxa_ab AS (
SELECT MSSIH_EVENT_SMAS_HISTORY_ID AS SITE_CODE,
       CAST(COALESCE(try_strptime(MSSIH_EVENT_SMAS_SAMPLE_DATE, '%m/%d/%Y'),
                     try_strptime(MSSIH_EVENT_SMAS_SAMPLE_DATE, '%m-%d-%Y')) AS DATE) AS EVENT_DATETIME,
       {taxon} AS TAXON_ID,
       CAST(MSDH_INDIVIDUAL_SPECIES_CNT AS DOUBLE) AS RESULT_VALUE,
       MSSIH_BIOSAMPLE_COLLECT_METHOD AS SAMPLE_METHOD, MSSIH_TOTAL_INDIV_CNT_NOTE AS RESULT_COMMENT,
       X_Grids AS SUBSAMPLE_AMOUNT, MSSIH_REPLICATE AS REPLICATE, event_id AS EVENT_ID, WAA_ID AS LAB_SAMPLE_ID,
       Client_Project_Name AS PROJECT,
       CASE WHEN X_Grids IS NULL OR X_Grids = '' THEN 'not_applicable' ELSE 'grid' END AS SUBSAMPLE_AMOUNT_UNIT,
       {consts},
       CAST(NULL AS TIMESTAMP) AS ANALYSIS_DATETIME
FROM lab)"""


TAXA_ABUNDANCE_SQL = f"WITH {_taxa_sql()}\nSELECT * FROM taxa_ab"


# -- VAL-19 / WN-02: duplicate taxa within event and replicate ----------------------
def taxa_duplicates(spark, d):
    t = taxa_abundance(spark, d).select("EVENT_ID", "REPLICATE", "TAXON_ID", "RESULT_VALUE", "LAB_SAMPLE_ID")
    return repeated_groups(t, ["EVENT_ID", "REPLICATE", "TAXON_ID"], 2, count_col="n_rows")


TAXA_DUPLICATES_SQL = f"""WITH {_taxa_sql()}
SELECT EVENT_ID, REPLICATE, TAXON_ID, RESULT_VALUE, LAB_SAMPLE_ID, n_rows FROM (
  SELECT *, COUNT(*) OVER (PARTITION BY EVENT_ID, REPLICATE, TAXON_ID) AS n_rows FROM taxa_ab) WHERE n_rows > 1"""


# -- DOM-03: species check ------------------------------------------------------------
def _species_master(spark, d):
    p = table(spark, d, "part").filter(F.col("p_size") <= MASTER_MAX_SIZE)
    name = F.regexp_replace(F.lower(F.concat(F.col("p_name"), F.lit(" "), F.col("p_partkey").cast("string"))), " ", "_")
    return p.select(F.lit("arthropoda").alias("MMS_PHYLUM"), F.lit("insecta").alias("MMS_CLASS"),
                    F.col("p_brand").alias("MMS_ORDER"), F.col("p_type").alias("MMS_FAMILY"),
                    X.drop_after_space("p_name").alias("MMS_GENUS"), name.alias("MMS_MACRO_GENSPECIES"))


def species_check_new(spark, d):
    new, _ = LAB.species_check(_prepared(spark, d), _species_master(spark, d))
    return new.select("site_id", "COLL_DATE", "MACRO_GENSPECIES", "INDIV")


def species_double_check(spark, d):
    _, double = LAB.species_check(_prepared(spark, d), _species_master(spark, d))
    return double


_SPECIES_MASTER_SQL = f"""
master AS (SELECT 'arthropoda' AS MMS_PHYLUM, 'insecta' AS MMS_CLASS, lower(p_brand) AS MMS_ORDER,
                  lower(p_type) AS MMS_FAMILY, lower(regexp_replace(p_name, ' .*$', '')) AS MMS_GENUS,
                  regexp_replace(lower(p_name || ' ' || CAST(p_partkey AS VARCHAR)), ' ', '_', 'g') AS MACRO_GENSPECIES
           FROM part WHERE p_size <= {MASTER_MAX_SIZE}),
newrows AS (SELECT site_id, COLL_DATE, trim(replace(lower(MACRO_GENSPECIES), ' ', '_')) AS MACRO_GENSPECIES, INDIV
            FROM prep),
new AS (SELECT * FROM newrows WHERE MACRO_GENSPECIES NOT IN (SELECT MACRO_GENSPECIES FROM master
                                                             WHERE MACRO_GENSPECIES IS NOT NULL))"""

SPECIES_CHECK_NEW_SQL = f"WITH {PREP_SQL},\n{_SPECIES_MASTER_SQL}\nSELECT * FROM new"

SPECIES_DOUBLE_CHECK_SQL = f"""WITH {PREP_SQL},
{_SPECIES_MASTER_SQL},
words AS (SELECT DISTINCT regexp_replace(MACRO_GENSPECIES, ' .*$', '') AS word FROM new)
SELECT DISTINCT * FROM master m
WHERE EXISTS (SELECT 1 FROM words w WHERE w.word <> '' AND (
  contains(m.MMS_PHYLUM, w.word) OR contains(m.MMS_CLASS, w.word) OR contains(m.MMS_ORDER, w.word)
  OR contains(m.MMS_FAMILY, w.word) OR contains(m.MMS_GENUS, w.word) OR contains(m.MACRO_GENSPECIES, w.word)))"""


QUERIES = {
    "sample_table": sample_table,
    "rmn_methods": rmn_methods,
    "result_table_report": result_table_report,
    "parameter_table": parameter_table,
    "sample_event_table": sample_event_table,
    "species_history_table": species_history_table,
    "published_metrics": published_metrics,
    "metrics_long": metrics_long,
    "taxa_abundance": taxa_abundance,
    "taxa_duplicates": taxa_duplicates,
    "species_check_new": species_check_new,
    "species_double_check": species_double_check,
}

SQL = {
    "sample_table": SAMPLE_TABLE_SQL,
    "rmn_methods": _rmn_methods_sql(),
    "result_table_report": _result_target_sql(),
    "parameter_table": ("SELECT DISTINCT parameter_name AS PARAMETER_NAME, 'not_applicable' AS CASRN, "
                        "'not_applicable' AS FRACTION, 'not_applicable' AS MATRIX, "
                        "'not_applicable' AS METHOD_SPECIATION, unit AS UNIT FROM (" + _metrics_long_sql() + ")"),
    "sample_event_table": SAMPLE_EVENT_TABLE_SQL,
    "species_history_table": SPECIES_HISTORY_TABLE_SQL,
    "published_metrics": PUBLISHED_METRICS_SQL,
    "metrics_long": _metrics_long_sql(),
    "taxa_abundance": TAXA_ABUNDANCE_SQL,
    "taxa_duplicates": TAXA_DUPLICATES_SQL,
    "species_check_new": SPECIES_CHECK_NEW_SQL,
    "species_double_check": SPECIES_DOUBLE_CHECK_SQL,
}
