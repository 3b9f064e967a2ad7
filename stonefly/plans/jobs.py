"""Batch job: one lab file -> history, scores and warehouse targets (flows A, B, C).

The notebook parameters become arguments; every step is a lazy plan and
the sinks are plain Spark writes under ``out_dir`` (retry-safe: dated files
are replaced, the history merges by sample key).  Reference tables (method
table, master taxa, model, crosswalks, parents) are inputs.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stonefly.config.corrections import NA_TOKENS
from stonefly.config.rules import event_rules
from stonefly.functions.numeric import round_r
from stonefly.operators import quality as Q
from stonefly.plans import lab as LAB
from stonefly.plans import warehouse as WH
from stonefly.sources import io as IO
from stonefly.sources.versions import VersionedTable
from stonefly.streaming.ingest import LAB_FILE_SCHEMA

# Declared types of the contract-lab file (FIXTURES.md raw_waa) and of the in-house file.
LAB_FILE_TYPES = {f.name: f.dataType.simpleString() for f in LAB_FILE_SCHEMA}
IN_HOUSE_FILE_TYPES = {"LOCATION": "string", "STATION": "string", "DATE": "string", "COLLECT": "int", "REPLICATE": "int",
                       "GENSPECIES": "string", "INDIV": "int", "event_id": "string"}

TARGETS = ("RESULT", "SAMPLE", "PARAMETER", "PARAMETER_NAME")


@dataclass
class BatchResult:
    prepared: DataFrame
    sample_event: DataFrame
    species_history: DataFrame
    published: DataFrame
    metrics_long: DataFrame
    result_report: DataFrame
    #: Further tables and reports by name: targets, their validation, sample table, taxa abundance, ...
    tables: dict[str, DataFrame] = field(default_factory=dict)

    @property
    def new_species(self) -> DataFrame:
        return self.tables["new_species"]


def publish_history(spark: SparkSession, root: str, run_date: str, sample_event: DataFrame, species_history: DataFrame,
                    published: DataFrame) -> dict[str, int]:
    """Merge one run into the versioned history tables under ``root`` and
    return their new versions (IO-12): one row a sample and one row of
    metrics a sample; a sample's species rows replace those it had.  Dates
    become ``%m/%d/%Y`` and counts are rounded to whole ones, half to even.
    """
    samples = sample_event.filter("MSSIH_LINKED_ID_VALIDATOR IS NOT NULL").withColumns({
        "MSSIH_EVENT_SMAS_SAMPLE_DATE": F.coalesce(
            LAB.D.format_date(LAB.D.parse_date_any("MSSIH_EVENT_SMAS_SAMPLE_DATE", LAB.DATE_FORMATS), "%m/%d/%Y"),
            F.col("MSSIH_EVENT_SMAS_SAMPLE_DATE")),
        "MSSIH_TOTAL_INDIV_CNT": round_r("MSSIH_TOTAL_INDIV_CNT", 0)})
    species = species_history.filter("MSDH_LINKED_ID_VALIDATOR IS NOT NULL").withColumn(
        "MSDH_INDIVIDUAL_SPECIES_CNT", round_r("MSDH_INDIVIDUAL_SPECIES_CNT", 0))
    tables = {"samples": (samples, "MSSIH_LINKED_ID_VALIDATOR", True), "species": (species, "MSDH_LINKED_ID_VALIDATOR", False),
              "metrics": (published, "MMDH_LINKED_ID_VALIDATOR", True)}
    return {name: VersionedTable(spark, os.path.join(root, name), [key], one_row).merge(df, run_date)
            for name, (df, key, one_row) in tables.items()}


def run_lab_batch(spark: SparkSession, lab_path: str, out_dir: str, run_date: str, taxa: DataFrame,
                  model: DataFrame | Callable[[DataFrame], DataFrame], methods: DataFrame | None = None,
                  file_type: str = "waa", lake_rules: DataFrame | None = None, site_crosswalk: DataFrame | None = None,
                  master: DataFrame | None = None, event_id_rules: Sequence = (), site_rules: Sequence = (),
                  dictionary: DataFrame | None = None, parents: Mapping[str, DataFrame] | None = None,
                  log: DataFrame | None = None, write: bool = True) -> BatchResult:
    """Run one batch.

    ``taxa``: taxon, is_ept, is_nco, tolerance, nbi_p_tolerance,
    taxon_group (the master reduced to scoring attributes).  ``model``: method,
    taxon_group, percent, or ``lab.batch_group_model``.  ``methods``: name
    and id of the batch's collection methods (by default the five scored
    ones); samples of others are kept and reported.  ``file_type``: ``waa``
    (contract lab) or ``internal`` (in-house).  ``master``: the full master
    table for the species check.  ``dictionary``, ``parents`` and ``log``
    bring the foreign-key check of the targets.

    Written under ``out_dir``: the dated history files, the versioned history
    (``history/``), the long metrics, each target with its validation
    report, sample table, taxa abundance, and the reports.
    """
    methods = methods if methods is not None else LAB.collect_method_table(spark)
    internal = file_type == "internal"
    tables: dict[str, DataFrame] = {}
    if internal:
        raw = IO.read_csv_typed(spark, lab_path, IN_HOUSE_FILE_TYPES, NA_TOKENS)
        raw = LAB.repair_raw(raw, "DATE", "GENSPECIES")
        prepared = LAB.prepare_in_house(raw)
        site_col, labels = "site_id", {"taxonomist": "SBU", "date_format": "%m/%d/%Y"}
    else:
        raw = IO.read_csv_typed(spark, lab_path, LAB_FILE_TYPES, NA_TOKENS)
        raw = LAB.repair_raw(LAB.harmonise_methods(raw))
        if lake_rules is not None:
            raw = LAB.lake_groups(raw.drop("group"), lake_rules)
        prepared = LAB.prepare_contract_lab(raw, methods)
        site_col, labels = "MSSIH_EVENT_SMAS_HISTORY_ID", {"taxonomist": "WAA", "date_format": "%m-%d-%Y"}
        tables["unknown_methods"] = LAB.unknown_methods(prepared)
    if site_crosswalk is not None:
        prepared, tables["changed_sites"] = LAB.site_check(prepared, site_crosswalk, site_col=site_col)
        prepared = prepared.withColumn("site_id", F.col(site_col))
    if master is not None:
        tables["new_species"], tables["double_check"] = LAB.species_check(prepared, master)
    else:
        tables["new_species"] = prepared.limit(0)
    tables["rows_without_key"] = LAB.rows_without_key(prepared, site_col=site_col)
    options = {"site_col": site_col, **labels}
    extra = ["event_id"] if "event_id" in prepared.columns else []
    history_options = {"total": "sum", "method_names": methods} if internal else {"total": "max"}
    h = LAB.history_tables(prepared, **options, **history_options)
    keyed = LAB.with_sample_ids(prepared, **options)
    total = F.col("INDIV") if internal else F.col("MSSIH_TOTAL_INDIV_CNT_IND")
    rows = keyed.select(
        F.col("MSSIH_LINKED_ID_VALIDATOR").alias("sid"), F.col("COLLECT").alias("method"),
        F.regexp_replace(F.lower("MACRO_GENSPECIES"), " ", "_").alias("taxon"),
        F.col("INDIV").cast("double").alias("n"), F.col(site_col).alias("site_id"),
        F.date_format("_coll", "yyyyMMdd").alias("date"),
        F.col("MSSIH_BIOSAMPLE_COLLECT_METHOD").alias("collection_method"),
        F.col("Replicate").cast("string").alias("replicate"), F.col("MSSIH_GROUP").alias("sample_group"),
        total.cast("double").alias("total_individual_count"),
        *([F.col("event_id")] if extra else [F.lit(None).cast("string").alias("event_id")]))
    if internal:  # the in-house total is the sum of the sample's counts
        from stonefly.operators.joins import with_group_aggregates
        rows = with_group_aggregates(rows, ["sid"], {"_total": F.sum("n")}).withColumn("total_individual_count", F.col("_total")).drop("_total")
    carry, largest = ["site_id", "date", "collection_method", "replicate", "sample_group", "event_id"], ["total_individual_count"]
    samples = LAB.sample_rows(rows, taxa, carry=carry, largest=largest)
    scored = LAB.score_sample_rows(samples, model)
    published = LAB.metric_table(scored).distinct()
    long = WH.metrics_long(LAB.metric_table(scored, keep=carry + largest), low_events=WH.low_count_events(samples))
    targets = WH.staging_tables(long, TARGETS)
    reports = {}
    for name, target in targets.items():
        tables[f"target_{name}"] = target
        reports[name] = tables[f"report_{name}"] = Q.validate(target, name)
        if dictionary is not None and parents:
            tables[f"keys_{name}"] = Q.validate_fks(target, name, dictionary, parents, log)
    if extra:
        with_event = LAB.history_tables(prepared, **options, **history_options, extra_sample_cols=extra)["sample_event"]
        tables["sample_table"] = WH.prep_sample_table(with_event, event_id_rules, site_rules)
        events = tables["sample_table"].select(F.col("event_id").alias("EVENT_ID"), F.col("site_id").alias("SITE_CODE"),
                                               F.to_timestamp("sample_date", "yyyyMMdd").alias("EVENT_DATETIME")).distinct()
        # the range of event times ends at the run
        run_time = f"{run_date[:4]}-{run_date[4:6]}-{run_date[6:8]} 23:59:59"
        tables["report_EVENT"] = Q.validate(events, "EVENT", {"EVENT": event_rules(run_time)})
    if not internal:
        tables["taxa_abundance"] = WH.taxa_abundance(raw, event_id_rules)
    if write:
        IO.write_dated_csv(h["species_history"], out_dir, "S_MACRO_SPECIES_DATA_HISTORY.csv", run_date)
        IO.write_dated_csv(h["sample_event"], out_dir, "S_MACRO_SPECIES_SAMP_INF_HIST.csv", run_date)
        IO.write_dated_csv(published, out_dir, "S_MACRO_METRICS_DATA_HISTORY.csv", run_date)
        publish_history(spark, os.path.join(out_dir, "history"), run_date, h["sample_event"], h["species_history"], published)
        long.write.mode("overwrite").parquet(os.path.join(out_dir, f"{run_date}_metrics_long"))
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(os.path.join(out_dir, f"{run_date}_{name}"))
    return BatchResult(prepared, h["sample_event"], h["species_history"], published, long, reports["RESULT"], tables)
