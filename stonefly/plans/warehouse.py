"""Flow B: wide metrics and lab rows -> long warehouse staging tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stonefly.config import corrections as CFG
from stonefly.config import scoring
from stonefly.config.descriptions import PARAMETER_DESCRIPTIONS
from stonefly.config.templates import RESULT_TEMPLATE, SAMPLE_TEMPLATE
from stonefly.functions import dates as D
from stonefly.operators import lookup as L
from stonefly.operators import metrics as M
from stonefly.operators import reshape as R
from stonefly.operators.columns import add_constants
from stonefly.operators.joins import join_null_safe, unique_or_fail
from stonefly.session import ScratchSteps, cut_lineage

LONG_IDS = ("event_id", "site_id", "date", "collection_method", "replicate", "sample_group")


# -- DOM-17: sample table -------------------------------------------------------
def prep_sample_table(samples: DataFrame, event_rules: Sequence = (), site_rules: Sequence = ()) -> DataFrame:
    """Distinct samples; letters in the replicate move to the group as
    ``{group}_{replicate}`` and only the digits stay; id corrections."""
    rep = F.col("MSSIH_REPLICATE").cast("string")
    has_letter = rep.rlike("[a-zA-Z]")
    out = samples.select(
        F.col("MSSIH_EVENT_SMAS_HISTORY_ID").alias("site_id"),
        D.format_date(D.parse_date_any("MSSIH_EVENT_SMAS_SAMPLE_DATE", ("%m-%d-%Y", "%m/%d/%Y")), "%Y%m%d")
        .alias("sample_date"),
        F.when(has_letter, F.concat(F.col("MSSIH_GROUP"), F.lit("_"), rep)).otherwise(F.col("MSSIH_GROUP"))
        .alias("sample_group"),
        F.regexp_replace(rep, "[a-zA-Z]", "").try_cast("double").alias("replicate"),
        F.col("MSSIH_TAXONOMIST").alias("taxonomist"),
        F.col("MSSIH_BIOSAMPLE_COLLECT_METHOD").alias("collection_method"),
        F.col("MSSIH_TOTAL_INDIV_CNT").alias("total_individual_count"),
        F.col("event_id")).distinct()
    if event_rules:
        out = L.correct_distinct(out, "event_id", event_rules)
    if site_rules:
        out = L.correct_distinct(out, "site_id", site_rules)
    return out


# -- DOM-18..23: long metric rows ---------------------------------------------
def low_count_events(samples: DataFrame, total_col: str = "total_individual_count",
                     method_col: str = "collection_method") -> DataFrame:
    """``event_id`` and ``_low``: has any of the event's samples a count below its
    method's minimum?  ``samples``: rows of ``lab.sample_rows``, whose
    exchange the plan of the scores shares."""
    low = M.below_count_minimum(method_col, total_col).cast("int")
    return samples.groupBy("event_id").agg(F.max(low).alias("_low"))


def metrics_long(wide: DataFrame, id_cols: Sequence[str] = LONG_IDS,
                 columns: Mapping[str, str] | None = None, total_col: str = "total_individual_count",
                 method_col: str = "collection_method", low_events: DataFrame | None = None) -> DataFrame:
    """Wide published metrics (``MMDH_*``) -> one row per (sample, parameter).

    Steps: rename to ``raw_``/``score_`` names, pivot longer (nulls dropped),
    split type and name, unit ``score_0-10``, description, impact category
    on profile rows, low-count qualifier for every row of an event whose
    count is below its method's minimum, constant columns.  ``low_events``:
    those events (``low_count_events``), where they aren't to be found from
    ``wide`` itself.
    """
    columns = columns if columns is not None else scoring.LONG_METRIC_COLUMNS
    present = {k: v for k, v in columns.items() if k in wide.columns}
    w = wide.withColumnsRenamed(present)
    values = list(present.values()) + ([total_col] if total_col in w.columns else [])
    ids = [c for c in id_cols if c in w.columns]
    # Qualifier per event: any sample of the event below its method's
    # minimum.  A partial aggregate per event joined back (AQE splits a hot
    # event in the join; the small flag table is normally broadcast), so no
    # event's samples are ever gathered in one task.
    if low_events is None and total_col in w.columns:
        low = M.below_count_minimum(method_col, total_col).cast("int")
        low_events = w.groupBy("event_id").agg(F.max(low).alias("_low"))
    if low_events is not None:
        w = join_null_safe(w, low_events, ["event_id"], "left")
    else:
        w = w.withColumn("_low", F.lit(0))
    long = R.wide_to_long(w, [*ids, "_low"], values, "parameter_name", "result_value")
    # One projection for everything after the reshape (fewer plan nodes to
    # analyse): type from the raw_/score_ prefix (the total count is raw),
    # bare name, unit, description, category, qualifier, method, constants.
    n = F.col("parameter_name")
    name = F.regexp_replace(n, "^(raw_|score_)", "")
    unit = (F.when(n.startswith("raw_"), F.lit("raw")).when(n.startswith("score_"), F.lit("score_0-10"))
            .when(n == F.lit(total_col), F.lit("raw")))
    is_low = F.coalesce(F.col("_low"), F.lit(0)) == 1
    is_profile = name == F.lit("bioassessment_profile")
    keep = [c for c in ids if c != "sample_group"]
    return long.select(
        *keep, name.alias("parameter_name"), "result_value", unit.alias("unit"),
        L.case_map(name, PARAMETER_DESCRIPTIONS).alias("parameter_description"),
        F.when(is_profile, M.impact_category("result_value")).otherwise(F.lit("")).alias("result_category"),
        F.when(is_low, F.lit(scoring.LOW_COUNT_QUALIFIER)).otherwise(F.lit("")).alias("result_qualifier"),
        F.when(is_low & is_profile, F.lit(scoring.LOW_COUNT_DESCRIPTION)).otherwise(F.lit(""))
        .alias("result_qualifier_description"),
        L.case_map(method_col, scoring.SAMPLE_METHODS, default=scoring.SAMPLE_METHOD_DEFAULT).alias("sample_method"),
        *[F.lit(v).alias(k) for k, v in scoring.LONG_METRIC_CONSTANTS.items()])


def split_targets(df: DataFrame, targets) -> dict:
    """RS-03: one staged table -> target tables (distinct target columns)."""
    return R.split_targets(df, targets)


STAGING_RENAMES = {"SAMPLING_LOCATION": "SAMPLE_LOCATION", "ORGANIZATION_NAME": "SAMPLE_ORGANIZATION"}


def target_columns(table: str) -> list[str]:
    """Declared columns of a warehouse target, in rule order."""
    from stonefly.config import rules
    rs = rules.RULE_SETS[table]
    seen, out = set(), []
    for r in rs.rules:
        if r.check == "col_exists":
            for c in r.columns:
                if c not in seen:
                    seen.add(c)
                    out.append(c)
    return out


def staging_tables(long: DataFrame, tables=("RESULT", "SAMPLE", "PARAMETER", "PARAMETER_NAME"),
                   materialize: bool | ScratchSteps = False) -> dict:
    """Long metric rows -> warehouse targets (RS-03, DOM-23): names
    upper-cased and renamed, template columns added, then per target its
    declared columns that exist, distinct.  Missing declared columns are
    left to the validation report (they are not invented).

    Template columns are constants, so they cannot change which rows are
    distinct: each target is de-duplicated on its variable columns only and
    the constants are added afterwards, keeping them out of the shuffle.
    ``materialize`` checkpoints the de-duplicated variable columns (in
    ``spark.checkpoint.dir``) for targets that are read several times, e.g.
    by validation; the constant columns are never written.  Given a run's
    ``ScratchSteps``, they are a table of the run under the target's name.
    """
    base = long.toDF(*[c.upper() for c in long.columns]).withColumnsRenamed(STAGING_RENAMES)
    consts = {n: (v, t) for n, v, t in RESULT_TEMPLATE + SAMPLE_TEMPLATE}
    out = {}
    for t in tables:
        cols = target_columns(t)
        variable = [c for c in cols if c in base.columns and c not in consts]
        d = base.select(*variable).distinct()
        if isinstance(materialize, ScratchSteps):
            d = materialize.write(d, t)
        elif materialize:
            d = cut_lineage(d)
        present = [c for c in cols if c in variable or c in consts]
        out[t] = d.select(*[F.col(c) if c in variable else F.lit(consts[c][0]).cast(consts[c][1]).alias(c)
                            for c in present])
    return out


def staging_template(long: DataFrame) -> DataFrame:
    """Add the RESULT and SAMPLE template columns (DOM-23), names upper-cased."""
    consts = {n: v for n, v, _ in RESULT_TEMPLATE + SAMPLE_TEMPLATE}
    types = {n: t for n, _, t in RESULT_TEMPLATE + SAMPLE_TEMPLATE}
    out = long.toDF(*[c.upper() for c in long.columns])
    return add_constants(out, consts, types)


def rmn_override(df: DataFrame, rmn_sites: DataFrame, site_col: str = "SITE_CODE",
                 replicate_col: str = "REPLICATE", method_col: str = "SAMPLE_METHOD",
                 value: str = "rmn_kick", replicate: int = 2) -> DataFrame:
    """DOM-24: site in the RMN set and replicate 2 -> method ``rmn_kick``."""
    marks = rmn_sites.select(F.col(rmn_sites.columns[0]).alias("_rmn")).distinct().withColumn("_is_rmn", F.lit(True))
    j = df.join(marks, df[site_col] == F.col("_rmn"), "left")
    cond = F.coalesce(F.col("_is_rmn"), F.lit(False)) & (F.col(replicate_col) == replicate)
    return j.withColumn(method_col, F.when(cond, F.lit(value)).otherwise(F.col(method_col))).drop("_rmn", "_is_rmn")


# -- DOM-26/27: taxa abundance rows -------------------------------------------
def taxa_abundance(raw: DataFrame, event_rules: Sequence = (), taxon_rules: Sequence | None = None) -> DataFrame:
    """Lab rows -> taxa abundance table: renamed columns, event-id
    corrections, subsample unit rule, cleaned taxon names (ordered rules on
    distinct names), constants."""
    taxon_rules = list(taxon_rules) if taxon_rules is not None else CFG.TAXON_CLEANING + CFG.TAXON_CORRECTIONS
    t = raw.select(
        F.col("MSSIH_EVENT_SMAS_HISTORY_ID").alias("SITE_CODE"),
        D.parse_date("MSSIH_EVENT_SMAS_SAMPLE_DATE", "%m/%d/%Y").alias("EVENT_DATETIME"),
        F.col("MSDH_GENSPECIES").alias("TAXON_ID"),
        F.col("MSDH_INDIVIDUAL_SPECIES_CNT").cast("double").alias("RESULT_VALUE"),
        F.col("MSSIH_BIOSAMPLE_COLLECT_METHOD").alias("SAMPLE_METHOD"),
        F.col("MSSIH_TOTAL_INDIV_CNT_NOTE").alias("RESULT_COMMENT"),
        F.col("X_Grids").alias("SUBSAMPLE_AMOUNT"),
        F.col("MSSIH_REPLICATE").alias("REPLICATE"),
        F.col("event_id").alias("EVENT_ID"),
        F.col("WAA_ID").alias("LAB_SAMPLE_ID"),
        F.col("Client_Project_Name").alias("PROJECT"))
    if event_rules:
        t = L.correct_distinct(t, "EVENT_ID", event_rules)
    t = t.withColumn("SUBSAMPLE_AMOUNT_UNIT",
                     F.when(F.col("SUBSAMPLE_AMOUNT").isNull() | (F.col("SUBSAMPLE_AMOUNT") == ""),
                            F.lit("not_applicable")).otherwise(F.lit("grid")))
    if taxon_rules:
        t = L.correct_distinct(t, "TAXON_ID", taxon_rules)
    t = add_constants(t, scoring.TAXA_ABUNDANCE_CONSTANTS)
    return t.withColumn("ANALYSIS_DATETIME", F.lit(None).cast("timestamp_ntz"))


# -- DOM-12/14: survey crosswalk -> event ids; samples without a survey --------
def survey_events(survey: DataFrame, date_format: str = "%m/%d/%Y", final_col: str = "finalSiteID",
                  site_col: str = "revisedOriginalSiteID", date_col: str = "eventSMASSampleDate",
                  time_col: str = "eventSMASArrivetime", id_col: str | None = "eventSMASId") -> DataFrame:
    """Crosswalk rows -> distinct (site_id, DATE, final_id, EVENT_ID).

    The event id is ``final_site_yyyyMMddTHHmm`` built from the arrival time
    (first ":" removed); a survey that already carries an event id (older
    batches) keeps it.
    """
    date = D.parse_date(date_col, date_format)
    built = F.concat(F.col(final_col).cast("string"), F.lit("_"), F.date_format(date, "yyyyMMdd"), F.lit("T"),
                     F.regexp_replace(F.col(time_col).cast("string"), "^([^:]*):", "$1"))
    event = F.coalesce(F.col(id_col), built) if id_col and id_col in survey.columns else built
    return survey.select(F.col(site_col).alias("site_id"), date.alias("DATE"),
                         F.col(final_col).alias("final_id"), event.alias("EVENT_ID")).distinct()


def attach_events(samples: DataFrame, events: DataFrame, keys: Sequence[str] = ("site_id", "DATE")
                  ) -> tuple[DataFrame, DataFrame]:
    """Left join samples to survey events on (site, date); returns (rows,
    rows without a survey event).  Two events for one site and date would
    fan the samples out: the job that reads the rows then fails with the
    site and date named (JN-12)."""
    out = join_null_safe(samples, unique_or_fail(events, list(keys), "survey events"), list(keys), "left")
    return out, out.filter(F.col("final_id").isNull())


# -- DOM-14: register of samples without a survey --------------------------------------
def missing_survey_register(missing: DataFrame, known_sites: DataFrame | None = None, notes: DataFrame | None = None,
                            site_col: str = "site_id") -> DataFrame:
    """Distinct rows without a survey event, with ``missing_site`` ("T" where the
    site isn't in ``known_sites``, else "F"), ``missing_survey`` and ``notes``.

    ``notes`` is the reviewers' table: site, missing_site, missing_survey,
    notes; its values replace the flags found here, and sites it lacks have
    the flag "F" and no note, as in the register.
    """
    from stonefly.operators.joins import semi_flag
    out = missing.distinct()
    if known_sites is not None:
        out = semi_flag(out, known_sites.select(F.col(known_sites.columns[0]).alias(site_col)), [site_col], "_known")
        out = out.withColumn("missing_site", F.when(F.col("_known"), "F").otherwise("T")).drop("_known")
    else:
        out = out.withColumn("missing_site", F.lit("F"))
    out = out.withColumns({"missing_survey": F.lit("T" if notes is None else "F"), "notes": F.lit("")})
    if notes is None:
        return out
    named = notes.select(F.col(notes.columns[0]).alias(site_col), *notes.columns[1:])
    return L.apply_key_corrections(out, [site_col], named, ["missing_site", "missing_survey", "notes"])
