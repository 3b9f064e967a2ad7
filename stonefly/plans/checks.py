"""Reconciliation and intake checks (DOM-25, DOM-28, DOM-33, DOM-34)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stonefly.operators.setops import value_except


def reconcile(a: DataFrame, b: DataFrame, col_a: str, col_b: str | None = None) -> dict[str, DataFrame]:
    """Both directions of ``setdiff`` between two tables' keys (DOM-33):
    values only in ``a`` and values only in ``b``."""
    col_b = col_b or col_a
    return {"only_in_a": value_except(a, b, col_a, col_b), "only_in_b": value_except(b, a, col_b, col_a)}


def sites_not_in_warehouse(metrics: DataFrame, warehouse_sites: DataFrame, site_col: str = "site_id",
                           warehouse_col: str = "SITE_CODE", survey: DataFrame | None = None,
                           survey_site_col: str = "site_id") -> dict[str, DataFrame]:
    """Sites that have metrics but no warehouse row (DOM-25), and the survey
    rows for those sites when a survey table is given."""
    missing = value_except(metrics, warehouse_sites, site_col, warehouse_col).withColumnRenamed("value", site_col)
    out = {"missing_sites": missing}
    if survey is not None:
        out["survey_rows"] = survey.join(missing.withColumnRenamed(site_col, survey_site_col), survey_site_col,
                                         "left_semi")
    return out


def taxon_crosswalk_errors(taxa: DataFrame, crosswalk: DataFrame, taxon_col: str = "TAXON_ID",
                           crosswalk_col: str = "TAXON_ID") -> DataFrame:
    """Rows whose taxon is not in the taxonomy crosswalk (DOM-28)."""
    cw = crosswalk.select(F.col(crosswalk_col).alias("_cw")).distinct()
    return taxa.join(cw, taxa[taxon_col] == F.col("_cw"), "left_anti")


def incoming_template_check(df: DataFrame, template: Mapping[str, str]) -> DataFrame:
    """Declared name and type per column vs an incoming file (DOM-34): one
    report row per declared column (exists, type matches), schema only."""
    rows = []
    types = dict(df.dtypes)
    for name, declared in template.items():
        actual = types.get(name)
        rows.append((name, declared, actual, actual is not None, actual == declared))
    extra = [(c, None, t, True, False) for c, t in df.dtypes if c not in template]
    return df.sparkSession.createDataFrame(
        rows + extra, "column_name string, declared string, actual string, present boolean, type_ok boolean")

