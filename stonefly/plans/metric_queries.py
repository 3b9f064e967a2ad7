"""Community-metric queries on the driver tables.

Domain mapping: an order (or a customer's orders of one status) is a
sample, a part is a taxon and ``l_quantity`` is the individual count.  Part
attributes stand in for the master taxa table: a brand set plays the EPT
orders, two part types play Chironomidae/Oligochaeta, ``p_size / 5`` is the
tolerance value... see ``_taxon_attrs``; ``p_type`` is the major group for
model affinity.  Tolerances are dyadic fractions so weighted sums are exact
and both engines produce the same doubles.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from stonefly.functions.numeric import round_half_up, round_half_up_sql
from stonefly.operators import metrics as M
from stonefly.plans import sqlgen as S
from stonefly.sources.tables import table

# Query parameters of the driver-table mapping.
EPT_BRANDS = ["Brand#1", "Brand#2", "Brand#3", "Brand#4", "Brand#5"]
NON_NCO_TYPES = ["PROMO", "ECONOMY"]
TOLERANCE_MAX_SIZE = 45
SCORED_STATUSES = ["F", "O"]  # method 1 (riffle kick); other statuses -> method 3 (no curves)

R6 = 6  # digits kept for raw metric values


def _taxon_attrs(part):
    return part.select(
        F.col("p_partkey").alias("taxon"),
        F.coalesce(F.col("p_brand").isin(EPT_BRANDS), F.lit(False)).alias("is_ept"),
        (~F.coalesce(F.col("p_type").isin(NON_NCO_TYPES), F.lit(False))).alias("is_nco"),
        F.when(F.col("p_size") <= TOLERANCE_MAX_SIZE, F.col("p_size") / 4.0).alias("tolerance"),
        (F.floor("p_retailprice") / 256.0).alias("nbi_p_tolerance"),
        F.col("p_type").alias("taxon_group"),
    )


_TAXON_ATTRS_SQL = f"""
SELECT p_partkey AS taxon,
       COALESCE(p_brand IN {S.in_list(EPT_BRANDS)}, FALSE) AS is_ept,
       NOT COALESCE(p_type IN {S.in_list(NON_NCO_TYPES)}, FALSE) AS is_nco,
       CASE WHEN p_size <= {TOLERANCE_MAX_SIZE} THEN p_size / 4.0 END AS tolerance,
       FLOOR(p_retailprice) / 256.0 AS nbi_p_tolerance,
       p_type AS taxon_group
FROM part"""


def order_counts(spark, d):
    li = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("sample_id"), F.col("l_partkey").alias("taxon"), F.col("l_quantity").alias("n"))
    return M.sum_duplicate_taxa(li, ["sample_id"], "taxon", "n")


# -- MET-01/02/05/09: totals, richness, Shannon, dominance-3 per order -------
def sample_metrics(spark, d):
    counts = order_counts(spark, d)
    out = M.community_metrics(counts, ["sample_id"], "taxon", "n", dominance_k=3)
    return out.select(
        "sample_id", "total_individuals", "richness",
        round_half_up("shannon_diversity", R6).alias("shannon_diversity"),
        round_half_up("percent_dominance_3", R6).alias("percent_dominance_3"))


SAMPLE_METRICS_SQL = f"""
WITH c AS (SELECT l_orderkey AS sample_id, l_partkey AS taxon, SUM(l_quantity) AS n
           FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY sample_id ORDER BY n DESC, taxon) AS rk FROM c)
SELECT sample_id, SUM(n) AS total_individuals, COUNT(taxon) AS richness,
       {round_half_up_sql("LOG2(SUM(n)) - SUM(n * LOG2(n)) / SUM(n)", R6)} AS shannon_diversity,
       {round_half_up_sql("100.0 * SUM(CASE WHEN rk <= 3 THEN n END) / SUM(n)", R6)} AS percent_dominance_3
FROM r GROUP BY sample_id"""


# -- MET-03/04/07/08: EPT and NCO richness, biotic indices per order --------
def taxa_metrics(spark, d):
    counts = order_counts(spark, d)
    attrs = _taxon_attrs(table(spark, d, "part"))
    j = counts.join(attrs, "taxon")
    out = M.basic_metrics(j, ["sample_id"], "taxon", "n",
                          flags={"ept_richness": "is_ept", "nco_richness": "is_nco"},
                          tolerances={"hilsenhoff_biotic_index": "tolerance",
                                      "nutrient_biotic_index_phosphorus": "nbi_p_tolerance"},
                          shannon=False)
    return out.select("sample_id", "richness", "ept_richness", "nco_richness",
                      round_half_up("hilsenhoff_biotic_index", R6).alias("hilsenhoff_biotic_index"),
                      round_half_up("nutrient_biotic_index_phosphorus", R6).alias("nutrient_biotic_index_phosphorus"))


TAXA_METRICS_SQL = f"""
WITH c AS (SELECT l_orderkey AS sample_id, l_partkey AS taxon, SUM(l_quantity) AS n
           FROM lineitem GROUP BY 1, 2),
a AS ({_TAXON_ATTRS_SQL}),
j AS (SELECT c.*, a.is_ept, a.is_nco, a.tolerance, a.nbi_p_tolerance FROM c JOIN a USING (taxon))
SELECT sample_id, COUNT(taxon) AS richness,
       COUNT(*) FILTER (WHERE is_ept) AS ept_richness,
       COUNT(*) FILTER (WHERE is_nco) AS nco_richness,
       {round_half_up_sql("SUM(n * tolerance) / SUM(CASE WHEN tolerance IS NOT NULL THEN n END)", R6)} AS hilsenhoff_biotic_index,
       {round_half_up_sql("SUM(n * nbi_p_tolerance) / SUM(CASE WHEN nbi_p_tolerance IS NOT NULL THEN n END)", R6)}
           AS nutrient_biotic_index_phosphorus
FROM j GROUP BY sample_id"""


# -- SL-02: the three most numerous taxa of each order (ties by part key) ---
def top3_taxa(spark, d):
    from stonefly.operators.aggregates import top_k_per_group
    counts = order_counts(spark, d)
    top = top_k_per_group(counts, ["sample_id"], [F.col("n").desc(), F.col("taxon")], 3,
                          salt_cols=["taxon"], rank_col="taxon_rank")
    return top.select("sample_id", F.col("taxon_rank").cast("int").alias("taxon_rank"), "taxon", "n")


TOP3_TAXA_SQL = """
WITH c AS (SELECT l_orderkey AS sample_id, l_partkey AS taxon, SUM(l_quantity) AS n
           FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY sample_id ORDER BY n DESC, taxon) AS INTEGER) AS taxon_rank
      FROM c)
SELECT sample_id, taxon_rank, taxon, n FROM r WHERE taxon_rank <= 3"""


def _nation_type_counts(spark, d):
    li = table(spark, d, "lineitem").select("l_suppkey", "l_partkey", "l_quantity")
    sup = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    part = table(spark, d, "part").select("p_partkey", "p_type")
    j = (li.join(sup, li.l_suppkey == sup.s_suppkey).join(part, li.l_partkey == part.p_partkey)
         .select(F.col("s_nationkey").alias("nation"), F.col("p_type").alias("taxon_group"),
                 F.col("l_quantity").alias("n")))
    return M.sum_duplicate_taxa(j, ["nation"], "taxon_group", "n")


_NATION_TYPE_SQL = """
SELECT s.s_nationkey AS nation, p.p_type AS taxon_group, SUM(l.l_quantity) AS n
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY 1, 2"""


# -- MET-05: Shannon diversity of part types within supplier nation ---------
def shannon_by_nation(spark, d):
    counts = _nation_type_counts(spark, d)
    out = M.basic_metrics(counts, ["nation"], "taxon_group", "n")
    return out.select("nation", "total_individuals", F.col("richness").alias("group_count"),
                      round_half_up("shannon_diversity", R6).alias("shannon_diversity"))


SHANNON_BY_NATION_SQL = f"""
WITH c AS ({_NATION_TYPE_SQL})
SELECT nation, SUM(n) AS total_individuals, COUNT(taxon_group) AS group_count,
       {round_half_up_sql("LOG2(SUM(n)) - SUM(n * LOG2(n)) / SUM(n)", R6)} AS shannon_diversity
FROM c GROUP BY nation"""


# -- MET-06: similarity of each nation's type mix to the overall mix --------
def model_affinity_by_nation(spark, d):
    counts = _nation_type_counts(spark, d)
    overall = counts.groupBy("taxon_group").agg(F.sum("n").alias("g"))
    # One row per taxon group (a handful): the global window is bounded.
    model = overall.select("taxon_group", (F.lit(100.0) * F.col("g") / F.sum("g").over(Window.partitionBy()))
                           .alias("percent"))
    out = M.percent_model_affinity(counts, ["nation"], "taxon_group", "n", model)
    return out.select("nation", round_half_up("percent_model_affinity", R6).alias("percent_model_affinity"))


MODEL_AFFINITY_BY_NATION_SQL = f"""
WITH c AS ({_NATION_TYPE_SQL}),
o AS (SELECT taxon_group, SUM(n) AS g FROM c GROUP BY 1),
m AS (SELECT taxon_group, 100.0 * g / SUM(g) OVER () AS percent FROM o),
t AS (SELECT nation, SUM(n) AS tot FROM c GROUP BY 1),
p AS (SELECT c.nation, c.taxon_group, 100.0 * c.n / t.tot AS pct FROM c JOIN t USING (nation))
SELECT p.nation, {round_half_up_sql("SUM(LEAST(p.pct, m.percent))", R6)} AS percent_model_affinity
FROM p JOIN m USING (taxon_group) GROUP BY p.nation"""


# -- MET-10..13 + DOM-20: per (customer, status) sample scores and profile --
PROFILE_METRIC_NAMES = ["richness", "ept_richness", "hilsenhoff_biotic_index", "percent_model_affinity",
               "nutrient_biotic_index_phosphorus"]


def sample_scores(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    rows = (li.join(orders, li.l_orderkey == orders.o_orderkey)
            .select(F.col("o_custkey").alias("sample_id"), "o_orderstatus",
                    F.when(F.col("o_orderstatus").isin(SCORED_STATUSES), F.lit(1)).otherwise(F.lit(3)).alias("method"),
                    F.col("l_partkey").alias("taxon"), F.col("l_quantity").alias("n")))
    keys = ["sample_id", "o_orderstatus", "method"]
    counts = M.sum_duplicate_taxa(rows, keys, "taxon", "n")
    attrs = _taxon_attrs(table(spark, d, "part"))
    j = counts.join(attrs, "taxon")
    overall = j.groupBy("taxon_group").agg(F.sum("n").alias("g"))
    # One row per taxon group (a handful): the global window is bounded.
    model = overall.select("taxon_group", (F.lit(100.0) * F.col("g") / F.sum("g").over(Window.partitionBy()))
                           .alias("percent"))
    wide = M.community_metrics(j, keys, "taxon", "n", flags={"ept_richness": "is_ept"},
                               tolerances={"hilsenhoff_biotic_index": "tolerance",
                                           "nutrient_biotic_index_phosphorus": "nbi_p_tolerance"},
                               group_col="taxon_group", model=model, dominance_k=None)
    scored = M.method_scores(wide, "method", PROFILE_METRIC_NAMES)
    return scored.select(
        *keys, "total_individuals", "richness", "ept_richness",
        *[round_half_up(c, R6).alias(c) for c in ["hilsenhoff_biotic_index", "percent_model_affinity",
                                            "nutrient_biotic_index_phosphorus"]],
        *[round_half_up(f"score_{m}", R6).alias(f"score_{m}") for m in PROFILE_METRIC_NAMES],
        "score_bioassessment_profile",
        M.impact_category("score_bioassessment_profile").alias("impact_category"))


def _sample_scores_sql():
    scores = ",\n       ".join(f"{S.method_score_sql('method', m)} AS score_{m}" for m in PROFILE_METRIC_NAMES)
    rounded = ",\n       ".join(f"{round_half_up_sql('score_' + m, R6)} AS score_{m}" for m in PROFILE_METRIC_NAMES)
    return f"""
WITH rows AS (
  SELECT o.o_custkey AS sample_id, o.o_orderstatus,
         CASE WHEN o.o_orderstatus IN {S.in_list(SCORED_STATUSES)} THEN 1 ELSE 3 END AS method,
         l.l_partkey AS taxon, l.l_quantity AS n
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
c AS (SELECT sample_id, o_orderstatus, method, taxon, SUM(n) AS n FROM rows GROUP BY 1, 2, 3, 4),
a AS ({_TAXON_ATTRS_SQL}),
j AS (SELECT c.*, a.is_ept, a.tolerance, a.nbi_p_tolerance, a.taxon_group FROM c JOIN a USING (taxon)),
base AS (
  SELECT sample_id, o_orderstatus, method, SUM(n) AS total_individuals, COUNT(taxon) AS richness,
         COUNT(*) FILTER (WHERE is_ept) AS ept_richness,
         SUM(n * tolerance) / SUM(CASE WHEN tolerance IS NOT NULL THEN n END) AS hilsenhoff_biotic_index,
         SUM(n * nbi_p_tolerance) / SUM(CASE WHEN nbi_p_tolerance IS NOT NULL THEN n END)
             AS nutrient_biotic_index_phosphorus
  FROM j GROUP BY 1, 2, 3),
og AS (SELECT taxon_group, SUM(n) AS g FROM j GROUP BY 1),
model AS (SELECT taxon_group, 100.0 * g / SUM(g) OVER () AS percent FROM og),
pg AS (SELECT sample_id, o_orderstatus, method, taxon_group, SUM(n) AS g FROM j GROUP BY 1, 2, 3, 4),
pt AS (SELECT sample_id, o_orderstatus, method, SUM(g) AS tot FROM pg GROUP BY 1, 2, 3),
pma AS (SELECT pg.sample_id, pg.o_orderstatus, pg.method,
               SUM(LEAST(100.0 * pg.g / pt.tot, model.percent)) AS percent_model_affinity
        FROM pg JOIN pt USING (sample_id, o_orderstatus, method) JOIN model USING (taxon_group)
        GROUP BY 1, 2, 3),
wide AS (SELECT base.*, COALESCE(pma.percent_model_affinity, 0.0) AS percent_model_affinity
         FROM base LEFT JOIN pma USING (sample_id, o_orderstatus, method)),
sc AS (SELECT wide.*,
       {scores}
       FROM wide),
pr AS (SELECT sc.*, {S.profile_sql('method', PROFILE_METRIC_NAMES)} AS score_bioassessment_profile FROM sc)
SELECT sample_id, o_orderstatus, method, total_individuals, richness, ept_richness,
       {round_half_up_sql("hilsenhoff_biotic_index", R6)} AS hilsenhoff_biotic_index,
       {round_half_up_sql("percent_model_affinity", R6)} AS percent_model_affinity,
       {round_half_up_sql("nutrient_biotic_index_phosphorus", R6)} AS nutrient_biotic_index_phosphorus,
       {rounded},
       score_bioassessment_profile,
       {S.impact_category_sql('score_bioassessment_profile')} AS impact_category
FROM pr"""


QUERIES = {
    "sample_metrics": sample_metrics,
    "taxa_metrics": taxa_metrics,
    "top3_taxa": top3_taxa,
    "shannon_by_nation": shannon_by_nation,
    "model_affinity_by_nation": model_affinity_by_nation,
    "sample_scores": sample_scores,
}

SQL = {
    "sample_metrics": SAMPLE_METRICS_SQL,
    "taxa_metrics": TAXA_METRICS_SQL,
    "top3_taxa": TOP3_TAXA_SQL,
    "shannon_by_nation": SHANNON_BY_NATION_SQL,
    "model_affinity_by_nation": MODEL_AFFINITY_BY_NATION_SQL,
    "sample_scores": _sample_scores_sql(),
}
