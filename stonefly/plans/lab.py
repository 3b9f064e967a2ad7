"""Flow A: lab file -> prepared rows -> history tables -> metrics.

Generic over DataFrames in the lab layouts of FIXTURES.md; every function
returns lazy plans (no ``collect``, no global state).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stonefly.config import scoring
from stonefly.functions import dates as D
from stonefly.functions import text as X
from stonefly.functions.numeric import round_r
from stonefly.operators import metrics as M
from stonefly.operators.joins import join_null_safe
from stonefly.operators.text_match import rows_containing_any
from stonefly.session import ScratchSteps

DATE_FORMATS = ("%m/%d/%Y", "%m-%d-%Y")


def collect_method_table(spark: SparkSession, names: Mapping[int, str] | None = None) -> DataFrame:
    """Method id/name configuration as a (tiny, fixed-size) DataFrame."""
    from stonefly.sources.literal import literal_table
    names = names if names is not None else scoring.METHOD_NAMES
    return literal_table(spark, [(n, i) for i, n in names.items()],
                         [("BIOSAMPLE_COLLECT_METHOD", "string"), ("BIOSAMPLE_COLLECT_METHOD_ID", "int")])


# -- DOM-09/10/29: harmonising before preparation ------------------------------
def harmonise_methods(raw: DataFrame, project_rmn: bool = False) -> DataFrame:
    """RMN 300-count samples get replicate 2, then headwater / RMN kicks are
    scored as standard kicks and lake littoral is renamed (DOM-09).  With
    ``project_rmn`` rows of the RMN project are standard kicks too."""
    from stonefly.operators.lookup import case_map
    m = F.col("MSSIH_BIOSAMPLE_COLLECT_METHOD")
    is_rmn = F.coalesce(m == F.lit(scoring.RMN_METHOD), F.lit(False))
    out = raw.withColumn("MSSIH_REPLICATE", F.when(is_rmn, F.lit(scoring.RMN_REPLICATE))
                         .otherwise(F.col("MSSIH_REPLICATE")))
    out = out.withColumn("MSSIH_BIOSAMPLE_COLLECT_METHOD", case_map(m, scoring.METHOD_HARMONISE, keep_unmatched=True))
    if project_rmn and "Client_Project_Name" in raw.columns:
        out = out.withColumn("MSSIH_BIOSAMPLE_COLLECT_METHOD",
                             F.when(F.col("Client_Project_Name") == F.lit(scoring.RMN_PROJECT), F.lit("Kick: Standard"))
                             .otherwise(F.col("MSSIH_BIOSAMPLE_COLLECT_METHOD")))
    return out


def repair_raw(raw: DataFrame, date_col: str = "MSSIH_EVENT_SMAS_SAMPLE_DATE", taxon_col: str = "MSDH_GENSPECIES") -> DataFrame:
    """Sample dates with dashes become slashes, and one taxon name is
    replaced, before anything reads them.  A date that fits neither form
    stays as it is (DT-04 counts those)."""
    from stonefly.operators.lookup import case_map
    return raw.withColumns({
        date_col: F.coalesce(D.format_date(D.parse_date_any(date_col, DATE_FORMATS), "%m/%d/%Y"), F.col(date_col)),
        taxon_col: case_map(taxon_col, scoring.RAW_TAXON_REPAIRS, keep_unmatched=True)})


def lake_groups(raw: DataFrame, rules: DataFrame, site_col: str = "MSSIH_EVENT_SMAS_HISTORY_ID",
                date_col: str = "MSSIH_EVENT_SMAS_SAMPLE_DATE", out: str = "group") -> DataFrame:
    """Lake sample group letters from a (site, date, letter) table, "" when
    no rule matches (DOM-10).  Of several letters for one site and date the
    least is taken, whatever the row order (``lookup.lookup_conflicts`` on
    the rule table lists them)."""
    from stonefly.operators.lookup import least_per_key
    r = least_per_key(rules.select(F.col(rules.columns[0]).alias("_s"), F.col(rules.columns[1]).alias("_d"),
                                   F.col(rules.columns[2]).alias("_g")), ["_s", "_d"])
    j = raw.join(r, (raw[site_col] == F.col("_s")) & (raw[date_col] == F.col("_d")), "left")
    return j.withColumn(out, F.coalesce(F.col("_g"), F.lit(""))).drop("_s", "_d", "_g")


def undetermined_family(c) -> "F.Column":
    """Family-level names -> ``undetermined_<family>`` (DOM-29)."""
    from stonefly.operators.lookup import case_map
    return case_map(c, scoring.UNDETERMINED_FAMILY, keep_unmatched=True)


# -- DOM-31: tolerance means within an order ----------------------------------
def tolerance_means(master: DataFrame, order: str, by: str, keep: Sequence[str] = (),
                    tolerances: Sequence[str] = ("MMS_TOLERANCE", "MMS_NBI_PHOSPHORUS_TOL", "MMS_NBI_NITRATE_TOL"),
                    order_col: str = "MMS_ORDER") -> DataFrame:
    """Mean tolerances per ``by`` group within one order, NA skipped, as
    distinct (keep..., means) rows (grouped mutate + distinct)."""
    from stonefly.operators.joins import with_group_aggregates
    f = master.filter(F.col(order_col) == F.lit(order))
    names = {f"new_{t}": F.avg(t) for t in tolerances}
    g = with_group_aggregates(f, [by], names)
    return g.select(*(keep or [by]), *names).distinct()


# -- DOM-01: contract-lab rows -> prepared rows -------------------------------
def prepare_contract_lab(raw: DataFrame, collect_method: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Select the lab columns, split the site id into basin/location/river
    mile, add the scoring column names, and attach the method id.

    ``collect_method`` (name, id) is an input: a batch brings the table of its
    methods.  Rows whose method it lacks stay, with a null ``COLLECT``
    (MET-13: they keep their sample and get no metrics); ``unknown_methods``
    reports them.  Of several ids for one name the least is taken.

    ``raw`` may hold the sample columns only (no taxon and count), to be
    joined with its taxa afterwards by the columns of ``keep``.
    """
    basin, location, rivmile = X.split_fixed("MSSIH_EVENT_SMAS_HISTORY_ID", "-", 3)
    if "group" not in raw.columns:          # older files: streams have no group letter
        raw = raw.withColumn("group", F.lit(""))
    names = {"MSDH_GENSPECIES": "MACRO_GENSPECIES", "MSDH_INDIVIDUAL_SPECIES_CNT": "INDIV"}
    if keep:
        names = {c: n for c, n in names.items() if c in raw.columns}
    df = raw.select(
        "MSSIH_EVENT_SMAS_HISTORY_ID", "MSSIH_BIOSAMPLE_COLLECT_METHOD", "MSSIH_REPLICATE",
        "MSSIH_EVENT_SMAS_SAMPLE_DATE", *names, "MSSIH_TOTAL_INDIV_CNT_IND", "group",
        *[c for c in ("MSSIH_TAXONOMIST", "MSSIH_TOTAL_INDIV_CNT_NOTE", "event_id") if c in raw.columns], *keep,
    ).withColumns({
        "BASIN": basin, "LOCATION": location, "RIVMILE": rivmile,
        "COLL_DATE": F.col("MSSIH_EVENT_SMAS_SAMPLE_DATE"),
        "Replicate": F.col("MSSIH_REPLICATE"),
        **{new: F.col(c) for c, new in names.items()},
        "site_id": F.col("MSSIH_EVENT_SMAS_HISTORY_ID"),
    })
    from stonefly.operators.lookup import least_per_key
    cm = least_per_key(collect_method.select("BIOSAMPLE_COLLECT_METHOD", "BIOSAMPLE_COLLECT_METHOD_ID")
                       .filter("BIOSAMPLE_COLLECT_METHOD IS NOT NULL"), ["BIOSAMPLE_COLLECT_METHOD"])
    out = df.join(cm, df.MSSIH_BIOSAMPLE_COLLECT_METHOD == cm.BIOSAMPLE_COLLECT_METHOD, "left")
    return out.drop("BIOSAMPLE_COLLECT_METHOD").withColumn("COLLECT", F.col("BIOSAMPLE_COLLECT_METHOD_ID"))


def unknown_methods(prepared: DataFrame) -> DataFrame:
    """Method names that the method table lacks, with the rows and sites that use them."""
    return (prepared.filter(F.col("COLLECT").isNull())
            .groupBy(F.col("MSSIH_BIOSAMPLE_COLLECT_METHOD").alias("collection_method"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("site_id").alias("n_sites")))


# -- DOM-02: in-house rows -> prepared rows -----------------------------------
def prepare_in_house(raw: DataFrame) -> DataFrame:
    """Numeric river mile, basin = first two characters of the location,
    location from the fourth character on, site id rebuilt."""
    rivmile = F.col("STATION").cast("string").try_cast("double")
    basin = X.substr_range("LOCATION", 1, 2)
    loc = F.expr("substring(LOCATION, 4)")
    return raw.select(
        basin.alias("BASIN"), loc.alias("LOCATION"), rivmile.alias("RIVMILE"),
        F.col("DATE").alias("COLL_DATE"), F.col("COLLECT"), F.col("REPLICATE").alias("Replicate"),
        F.col("GENSPECIES").alias("MACRO_GENSPECIES"), F.col("INDIV"),
        F.concat_ws("-", basin, loc, rivmile.cast("string")).alias("site_id"),
        F.col("LOCATION").alias("ref"), *[F.col(c) for c in ("event_id", "group") if c in raw.columns])


# -- DOM-03: species check ------------------------------------------------------
MASTER_LEVELS = ("MMS_PHYLUM", "MMS_CLASS", "MMS_ORDER", "MMS_FAMILY", "MMS_SUBFAMILY", "MMS_GENUS",
                 "MMS_SPECIES", "MACRO_GENSPECIES")


def species_check(prepared: DataFrame, master: DataFrame, taxon_col: str = "MACRO_GENSPECIES",
                  master_taxon: str = "MMS_MACRO_GENSPECIES", levels: Sequence[str] = MASTER_LEVELS
                  ) -> tuple[DataFrame, DataFrame]:
    """Returns (new_species, double_check).

    new_species: prepared rows whose normalised taxon is not in the master
    (anti join).  double_check: distinct master rows where any taxonomic
    level contains the first word of a new name (substring match, exact).
    """
    rows = prepared.withColumn(taxon_col, X.normalise_taxon(taxon_col))
    existing = master.withColumnRenamed(master_taxon, "MACRO_GENSPECIES")
    existing = existing.select(*[F.lower(F.col(c)).alias(c) if t == "string" else F.col(c)
                                 for c, t in existing.dtypes])
    new = rows.join(existing.select(F.col("MACRO_GENSPECIES").alias("_m")).distinct(),
                    F.col(taxon_col) == F.col("_m"), "left_anti")
    words = new.select(X.drop_after_space(taxon_col).alias("word"))
    cols = [c for c in levels if c in existing.columns]
    double = rows_containing_any(existing, cols, words, "word")
    return new, double


# -- DOM-04: superseded site ids ----------------------------------------------
def site_check(prepared: DataFrame, crosswalk: DataFrame, site_col: str = "site_id",
               new_col: str = "SMAS_HISTORY_ID", old_col: str = "ORIGINAL_SITE_ID") -> tuple[DataFrame, DataFrame]:
    """Replace ids listed as superseded; returns (rows, changed ids)."""
    from stonefly.operators.lookup import replace_from_crosswalk
    out = replace_from_crosswalk(prepared.withColumn("_orig_site", F.col(site_col)), site_col, crosswalk,
                                 old_col, new_col, flag="_site_changed")
    changed = out.filter("_site_changed").select(F.col("_orig_site").alias(old_col),
                                                 F.col(site_col).alias(new_col)).distinct()
    return out.drop("_orig_site", "_site_changed"), changed


# -- DOM-05/06: sample-event and species-history tables -----------------------
def with_sample_ids(prepared: DataFrame, taxonomist: str = "WAA",
                    site_col: str = "MSSIH_EVENT_SMAS_HISTORY_ID", date_format: str = "%m-%d-%Y") -> DataFrame:
    """Parse the collection date (two formats) and add the sample key
    ``site_yyyyMMdd_method_replicate`` and the sample-level text columns.
    Where the method has no id, its name stands in the key, so samples of two
    such methods stay apart.  Columns an in-house file lacks (group, method
    name) become empty/null."""
    coll = D.parse_date_any("COLL_DATE", DATE_FORMATS)
    cols = prepared.columns
    method = F.col("COLLECT").cast("string")
    if "MSSIH_BIOSAMPLE_COLLECT_METHOD" in cols:
        method = F.coalesce(method, "MSSIH_BIOSAMPLE_COLLECT_METHOD")
    return prepared.withColumns({
        "_coll": coll,
        "MSSIH_LINKED_ID_VALIDATOR": D.linked_id(site_col, coll, method, "Replicate"),
        "MSSIH_EVENT_SMAS_SAMPLE_DATE": D.format_date(coll, date_format),
        "MSSIH_TOTAL_INDIV_CNT_NOTE": F.lit(""),
        "MSSIH_GROUP": F.col("group") if "group" in cols else F.lit(""),
        "MSSIH_TAXONOMIST": F.lit(taxonomist),
        "MSSIH_BIOSAMPLE_COLLECT_METHOD": (F.col("MSSIH_BIOSAMPLE_COLLECT_METHOD")
                                           if "MSSIH_BIOSAMPLE_COLLECT_METHOD" in cols else F.lit(None).cast("string")),
    })


def rows_without_key(prepared: DataFrame, **options) -> DataFrame:
    """Rows that make no sample key (unreadable date, missing site, method or
    replicate), counted by what identifies them.  They are in the history
    tables and get no scores: nothing tells which sample they belong to."""
    rows = with_sample_ids(prepared, **options).filter(F.col("MSSIH_LINKED_ID_VALIDATOR").isNull())
    return rows.groupBy("site_id", "COLL_DATE", "COLLECT", "Replicate").agg(
        F.count(F.lit(1)).alias("n_rows"), F.bool_or(F.col("_coll").isNull()).alias("date_unreadable"))


SAMPLE_EVENT_COLUMNS = ("MSSIH_LINKED_ID_VALIDATOR", "MSSIH_BIOSAMPLE_COLLECT_METHOD_NUM",
                        "MSSIH_EVENT_SMAS_HISTORY_ID", "MSSIH_EVENT_SMAS_SAMPLE_DATE", "MSSIH_REPLICATE",
                        "MSSIH_TAXONOMIST", "MSSIH_TOTAL_INDIV_CNT_NOTE", "MSSIH_BIOSAMPLE_COLLECT_METHOD",
                        "MSSIH_GROUP")


def history_tables(prepared: DataFrame, taxonomist: str = "WAA", total: str = "max",
                   site_col: str = "MSSIH_EVENT_SMAS_HISTORY_ID", date_format: str = "%m-%d-%Y",
                   method_names: DataFrame | None = None,
                   extra_sample_cols: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Build ``sample_event`` and ``species_history``.

    ``total="max"``: contract labs report the total on every row, keep the
    largest (DOM-06).  ``total="sum"``: sum the taxon counts (DOM-05).  Either
    is null when one of its values is.  Samples whose date can't be read have
    no key; they are told apart by site, date text, method and replicate.
    ``extra_sample_cols`` (e.g. ``event_id``) ride along in the same
    aggregate when a caller needs them per sample.

    One partial aggregate over the distinct sample columns carries the
    total; the per-sample total is then finished over that small result
    (a handful of rows per sample key), so the rows are shuffled once and a
    large sample is combined map-side.
    """
    df = with_sample_ids(prepared, taxonomist, site_col, date_format)
    if method_names is not None:
        # In-house files carry only the method number: name it from the
        # (small, size-checked) method table.
        from stonefly.operators.lookup import least_per_key
        names = least_per_key(method_names.select(F.col("BIOSAMPLE_COLLECT_METHOD_ID").alias("_mid"),
                                                  F.col("BIOSAMPLE_COLLECT_METHOD").alias("_mname")), ["_mid"])
        df = (df.join(names, F.col("COLLECT") == F.col("_mid"), "left")
              .withColumn("MSSIH_BIOSAMPLE_COLLECT_METHOD", F.coalesce("MSSIH_BIOSAMPLE_COLLECT_METHOD", "_mname"))
              .drop("_mid", "_mname"))
    if total not in ("max", "sum"):
        raise ValueError(total)
    fin, value = (F.max, "MSSIH_TOTAL_INDIV_CNT_IND") if total == "max" else (F.sum, "INDIV")
    # Rows without a sample key (unreadable date) stay apart by what identifies them.
    df = df.withColumn("_apart", F.when(F.col("MSSIH_LINKED_ID_VALIDATOR").isNull(),
                                        F.to_json(F.struct(site_col, "COLL_DATE", "COLLECT", "Replicate"))))
    from pyspark.sql import Window
    grouped = df.groupBy(
        "MSSIH_LINKED_ID_VALIDATOR", F.col("COLLECT").alias("MSSIH_BIOSAMPLE_COLLECT_METHOD_NUM"),
        F.col(site_col).alias("MSSIH_EVENT_SMAS_HISTORY_ID"), "MSSIH_EVENT_SMAS_SAMPLE_DATE",
        F.col("Replicate").alias("MSSIH_REPLICATE"), "MSSIH_TAXONOMIST", "MSSIH_TOTAL_INDIV_CNT_NOTE",
        "MSSIH_BIOSAMPLE_COLLECT_METHOD", "MSSIH_GROUP", "_apart", *extra_sample_cols).agg(
            fin(value).alias("_t"), (F.count(value) == F.count(F.lit(1))).alias("_all"))
    w = Window.partitionBy("MSSIH_LINKED_ID_VALIDATOR", "_apart")
    samples = grouped.withColumn(
        "MSSIH_TOTAL_INDIV_CNT", F.when(F.min("_all").over(w), fin("_t").over(w)).cast("double")
    ).drop("_t", "_all", "_apart")
    species = df.select(
        F.col("MSSIH_LINKED_ID_VALIDATOR").alias("MSDH_LINKED_ID_VALIDATOR"),
        F.col("INDIV").alias("MSDH_INDIVIDUAL_SPECIES_CNT"),
        F.regexp_replace(F.lower("MACRO_GENSPECIES"), " ", "_").alias("MSTR_MACRO_SPECIES_ID"))
    return {"sample_event": samples, "species_history": species}


# -- DOM-07/08, MET-*: metrics and scores per sample by method ----------------
SCORED_METRICS = ["richness", "ept_richness", "hilsenhoff_biotic_index", "percent_model_affinity",
                  "nutrient_biotic_index_phosphorus", "shannon_diversity", "non_chiro_oligo_richness",
                  "percent_dominance_3"]


FLAGS = {"ept_richness": "is_ept", "non_chiro_oligo_richness": "is_nco"}
TOLERANCES = {"hilsenhoff_biotic_index": "tolerance", "nutrient_biotic_index_phosphorus": "nbi_p_tolerance"}


def batch_group_model(samples: DataFrame) -> DataFrame:
    """Model mix of a batch: each method's overall percentage of every taxon
    group, over taxa known to the master.  ``samples``: rows of ``sample_rows``
    (their exchange is shared with the scoring)."""
    from pyspark.sql import Window
    g = (samples.select("method", F.explode("taxa").alias("t")).filter("t.taxon_group IS NOT NULL")
         .groupBy("method", F.col("t.taxon_group").alias("taxon_group")).agg(F.sum("t.n").alias("g")))
    # a handful of groups a method
    return g.select("method", "taxon_group",
                    (F.lit(100.0) * F.col("g") / F.sum("g").over(Window.partitionBy("method"))).alias("percent"))


def sample_rows(rows: DataFrame, taxa: DataFrame, sample_cols=("sid", "method"), carry: Sequence[str] = (),
                largest: Sequence[str] = (), own: DataFrame | None = None, steps: ScratchSteps | None = None,
                spent: Sequence[str] = ()) -> DataFrame:
    """One row a sample from (sample..., taxon, n) rows: the array ``taxa`` of
    its counts with the master's attributes, and its own columns.

    ``taxa`` (master): ``taxon``, ``is_ept``, ``is_nco``, ``tolerance``,
    ``nbi_p_tolerance``, ``taxon_group``.  Rows whose first sample column is
    null belong to no sample: they are left out (``rows_without_key`` reports
    them).  ``carry``: columns of the sample that ride along; a sample with
    several combinations of them (two events on one sample) gives a row for
    each, so none is lost.  ``largest``: columns of which the largest value rides.
    ``own``: the samples' rows with these columns, where they are to be had
    without the taxon rows (every sample of ``rows`` and no other); else they
    are taken from ``rows``.  ``steps``: the counts are written before and
    after the master's attributes join them; its tables ``spent``, which only
    ``rows`` reads, go when they have been counted.
    """
    keys, carry, largest = list(sample_cols), list(carry), list(largest)
    rows = rows.filter(F.col(keys[0]).isNotNull())
    counts = M.sum_duplicate_taxa(rows, keys, "taxon", "n")
    if steps is not None:
        counts = steps.write(counts, "counts")
        if spent:
            steps.drop(*spent)
    j = counts.join(taxa, "taxon", "left")
    if steps is not None:
        j = steps.write(j, "sample_taxa")
        steps.drop("counts")
    attributes = [*FLAGS.values(), *TOLERANCES.values(), "taxon_group"]
    if not carry and not largest:
        return M.sample_state(j, keys, "taxon", "n", attributes)
    # What rides along is part of the array, too, as items of its own: every plan
    # on the samples then has the same aggregate, whichever columns it reads, and
    # shares its exchange, and no (sample, taxon) row carries the sample's texts.
    own = (rows if own is None else own.filter(F.col(keys[0]).isNotNull())).groupBy(*keys, *carry).agg(
        *([F.max(k).alias(k) for k in largest] or [F.count(F.lit(1)).alias("_n")]))
    riders = own.select(*keys, F.struct(*carry, *largest).alias("_own"))
    items = j.withColumn("_own", F.lit(None).cast(riders.schema["_own"].dataType)).unionByName(riders, allowMissingColumns=True)
    state = M.sample_state(items, keys, "taxon", "n", [*attributes, "_own"])
    bare = lambda x: F.struct(x["taxon"].alias("taxon"), x["n"].alias("n"), *[x[c].alias(c) for c in attributes])
    state = state.select(*keys, F.transform(F.filter("taxa", lambda x: x["_own"].isNull()), bare).alias("taxa"),
                         F.transform(F.filter("taxa", lambda x: x["_own"].isNotNull()), lambda x: x["_own"]).alias("_owns"))
    state = state.select(*keys, "taxa", *[F.array_max(F.col(f"_owns.{k}")).alias(k) for k in largest],
                         *([F.explode("_owns").alias("_c")] if carry else []))
    return state.select(*[c for c in state.columns if c != "_c"], *[F.col(f"_c.{c}").alias(c) for c in carry])


def score_sample_rows(samples: DataFrame, model: DataFrame | Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Metrics and method scores of ``sample_rows``.

    ``model``: method, taxon_group, percent, or a function of the samples
    that gives them (``batch_group_model``: a sample's score then depends on
    its batch).  A method has the metrics that ``scoring.METHOD_METRICS``
    names, the others are null, and a method without any keeps its row
    (MET-12, MET-13).
    """
    wide = M.state_metrics(samples, FLAGS, TOLERANCES, "taxon_group", model(samples) if callable(model) else model, ["method"])
    return M.method_scores(M.metrics_of_method(wide, "method", SCORED_METRICS), "method", SCORED_METRICS)


def score_rows(rows: DataFrame, taxa: DataFrame, model: DataFrame | Callable[[DataFrame], DataFrame],
               sample_cols=("sid", "method"), carry: Sequence[str] = (), largest: Sequence[str] = ()) -> DataFrame:
    """``sample_rows`` and ``score_sample_rows`` in one call."""
    return score_sample_rows(sample_rows(rows, taxa, sample_cols, carry, largest), model)


def score_samples(species_history: DataFrame, sample_event: DataFrame, taxa: DataFrame,
                  model: DataFrame | Callable[[DataFrame], DataFrame],
                  taxon_key: str = "MSTR_MACRO_SPECIES_ID") -> DataFrame:
    """Wide metric table per linked id from the two history tables."""
    sid = "MSDH_LINKED_ID_VALIDATOR"
    method = sample_event.select(F.col("MSSIH_LINKED_ID_VALIDATOR").alias("sid"),
                                 F.col("MSSIH_BIOSAMPLE_COLLECT_METHOD_NUM").alias("method")).distinct()
    rows = species_history.select(F.col(sid).alias("sid"), F.col(taxon_key).alias("taxon"),
                                  F.col("MSDH_INDIVIDUAL_SPECIES_CNT").cast("double").alias("n"))
    rows = rows.join(method, "sid")
    return score_rows(rows, taxa, model).withColumnRenamed("sid", sid)


WIDE_TO_PUBLISHED = {
    "richness": "MMDH_RICHNESS", "score_richness": "MMDH_RICHNESS_SCORE",
    "ept_richness": "MMDH_EPT_RICH", "score_ept_richness": "MMDH_EPT_SCORE",
    "hilsenhoff_biotic_index": "MMDH_HBI_INDEX", "score_hilsenhoff_biotic_index": "MMDH_HBI_SCORE",
    "shannon_diversity": "MMDH_SHANNON", "score_shannon_diversity": "MMDH_SHANNON_SCORE",
    "score_bioassessment_profile": "MMDH_BIO_ASMT_PROFILE_SCORE",
    "percent_model_affinity": "MMDH_PCT_MODEL_AFFINITY",
    "score_percent_model_affinity": "MMDH_PCT_MODEL_AFFINITY_SCORE",
    "nutrient_biotic_index_phosphorus": "MMDH_NUTRIENT_BIOTIC_INDEX_P",
    "score_nutrient_biotic_index_phosphorus": "MMDH_NBI_P_SCORE",
    "non_chiro_oligo_richness": "MMDH_NCO_RICH", "score_non_chiro_oligo_richness": "MMDH_NCO_RICH_SCORE",
    "percent_dominance_3": "MMDH_PCT_DOMINANCE_3", "score_percent_dominance_3": "MMDH_PCT_DOMINANCE_3_SCORE",
    "MSDH_LINKED_ID_VALIDATOR": "MMDH_LINKED_ID_VALIDATOR",
    "sid": "MMDH_LINKED_ID_VALIDATOR",
}


def metric_table(scored: DataFrame, digits: int = 3, keep: Sequence[str] = ()) -> DataFrame:
    """Published metric columns (DOM-08): renamed, doubles rounded to 3
    digits, half to even (NUM-01); ``keep`` columns pass through unchanged."""
    present = {k: v for k, v in WIDE_TO_PUBLISHED.items() if k in scored.columns}
    cols = []
    for k, v in present.items():
        c = F.col(k)
        if dict(scored.dtypes)[k] == "double":
            c = round_r(c, digits)
        cols.append(c.alias(v))
    return scored.select(*cols, *keep)


# -- DOM-32: metrics with all sample fields -------------------------------------------
METRIC_SAMPLE_KEYS = ("MSSIH_EVENT_SMAS_HISTORY_ID", "MSSIH_EVENT_SMAS_SAMPLE_DATE", "MSSIH_BIOSAMPLE_COLLECT_METHOD",
                      "MSSIH_REPLICATE", "MSSIH_GROUP")


def metrics_with_samples(metrics: DataFrame, samples: DataFrame, keys: Sequence[str] = METRIC_SAMPLE_KEYS) -> DataFrame:
    """Metric rows with every field of their sample (DOM-32): an inner join on
    site, date, method, replicate and group, null keys matching; columns on
    both sides get the suffixes ``.x`` and ``.y``; distinct rows."""
    from stonefly.operators.joins import join_with_suffixes
    return join_with_suffixes(metrics, samples, keys, "inner").distinct()


# -- DOM-08: external scoring output -> published metric table -----------------
def _collect_keys(collect: DataFrame) -> list[str]:
    return ["site_id", *[k for k in ("date", "REPLICATE") if k in collect.columns]]


def collect_conflicts(collect: DataFrame) -> DataFrame:
    """Samples of ``collect`` with several methods: the keys, how many, and the one that is taken."""
    from stonefly.operators.lookup import lookup_conflicts
    return lookup_conflicts(collect.filter("COLLECT IS NOT NULL"), _collect_keys(collect), ["COLLECT"])


def publish_scoring_output(scored: DataFrame, collect: DataFrame, digits: int = 3,
                           names: Mapping[str, str] | None = None) -> DataFrame:
    """Wide scoring output (``EVENT_ID, BASIN, LOCATION, RIVMILE, DATE`` +
    metric columns such as ``RICHNESS``, ``RICH_SCORE``) -> published table.

    Basin padded to two digits, site id ``BASIN-LOCATION-RIVMILE``, date
    parsed (US or ISO forms), replicate = last ``_`` part of the event id,
    sample key, columns renamed by the published-name table (only names
    present), doubles rounded half to even.

    The collection method is the output's own COLLECT where it has one, else
    that of the sample in ``collect``: site_id, COLLECT and, as far as the
    table has them, ``date`` and ``REPLICATE``.  Of several methods for one
    such sample the least is taken, whatever the row order;
    ``collect_conflicts`` lists them.
    """
    names = names if names is not None else scoring.PUBLISHED_COLUMN_NAMES
    basin = X.lpad_keep(F.col("BASIN").cast("string"), 2, "0")
    site = F.concat_ws("-", basin, F.col("LOCATION").cast("string"), F.col("RIVMILE").cast("string"))
    coll = D.parse_date_any(F.col("DATE").cast("string"), (*DATE_FORMATS, "%Y-%m-%d"))
    rep = F.element_at(F.split(F.col("EVENT_ID"), "_"), -1)
    df = scored.withColumns({"site_id": site, "_date": coll, "REPLICATE": rep})
    keys = _collect_keys(collect)
    if "COLLECT" not in df.columns:
        from stonefly.operators.lookup import least_per_key
        c = least_per_key(collect.filter("COLLECT IS NOT NULL").select(*keys, "COLLECT"), keys)
        if "date" in keys:
            df = df.withColumn("date", F.col("_date"))
        df = join_null_safe(df, c, keys, "left")
    df = df.withColumn("MMDH_LINKED_ID_VALIDATOR", D.linked_id("site_id", "_date", "COLLECT", "REPLICATE"))
    present = {o: n for o, n in names.items() if o in df.columns}
    out = df.select(*[F.col(o).alias(n) for o, n in present.items()])
    types = dict(out.dtypes)
    return out.select(*[(round_r(F.col(c), digits) if types[c] == "double" else F.col(c)).alias(c)
                        for c in out.columns])
