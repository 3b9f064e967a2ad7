"""Sources and sinks (IO-*).

* typed CSV with an NA token set, tolerant of missing declared columns,
* multi-file scans with a source index,
* date-stamped CSV sinks with NA written as "",
* staging as Parquet and an idempotent, partitioned history append.

Jobs must survive executor loss: sinks are plain Spark writes (task retries
are safe), the history append overwrites only its own ``run_date``
partition (re-running a run replaces it instead of duplicating it), and
staged tables go to the shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import csv
import hashlib
import io as pyio
import logging
import os
import re
from collections.abc import Iterator, Mapping, Sequence
from urllib.parse import quote

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stonefly.config.corrections import NA_TOKENS
from stonefly.functions.dates import parse_date
from stonefly.session import scratch_path, scratch_table

log = logging.getLogger(__name__)


def _typed(c: str, spec: str) -> Column:
    """``spec``: a Spark type name, or ``date:<fmt>`` / ``timestamp:<fmt>``."""
    col = F.col(f"`{c}`")
    if spec.startswith("date:"):
        return parse_date(col, spec.split(":", 1)[1])
    if spec.startswith("timestamp:"):
        return F.try_to_timestamp(col, F.lit(spec.split(":", 1)[1]))
    if spec == "string":
        return col
    return col.try_cast(spec)


def read_csv_typed(spark: SparkSession, path: str | Sequence[str], col_types: Mapping[str, str],
                   na_tokens: Sequence[str] = tuple(NA_TOKENS), keep_extra: bool = False) -> DataFrame:
    """``standard_read_csv(file, col_types)`` (IO-02/03).

    Every column is read as text (no inference pass over the data), NA
    tokens become null, then each declared column is parsed with ``try_*``
    so a bad value is null instead of a failed job.  Declared columns the
    file lacks are a warning and become typed nulls; undeclared columns are
    dropped unless ``keep_extra``.  An unnamed leading row-number column
    (``_c0``) is dropped (IO-10).
    """
    raw = (spark.read.option("header", True).option("inferSchema", False)
           .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path))
    raw = raw.drop(*[c for c in raw.columns if c in ("_c0", "")])
    tokens = list(na_tokens)
    cleaned = raw.select(*[F.when(F.trim(F.col(f"`{c}`")).isin(tokens), F.lit(None))
                           .otherwise(F.col(f"`{c}`")).alias(c) for c in raw.columns])
    missing = [c for c in col_types if c not in cleaned.columns]
    if missing:
        log.warning("declared columns missing from %s: %s", path, missing)
    out = []
    for c, spec in col_types.items():
        if c in cleaned.columns:
            out.append(_typed(c, spec).alias(c))
        else:
            t = spec.split(":", 1)[0]
            out.append(F.lit(None).cast(t).alias(c))
    extra = [F.col(f"`{c}`") for c in cleaned.columns if keep_extra and c not in col_types]
    return cleaned.select(*out, *extra)


def csv_headers(spark: SparkSession, path_glob: str) -> DataFrame:
    """``_file`` (its path without scheme), ``_names`` (its header) and ``_rank`` of every file, one row each.

    The files are listed without reading them, and tasks read one line of
    each; the result is a table, whatever the number of files.
    """
    listed = spark.read.format("binaryFile").load(path_glob).select("path")

    def heads(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            names = []
            for path in frame["path"]:
                fs, inner = pafs.FileSystem.from_uri(quote(re.sub("^file:/+", "file:///", path), safe="/:"))
                with fs.open_input_stream(inner) as stream, pyio.TextIOWrapper(stream, "utf-8-sig", newline="") as text:
                    row = next(csv.reader(text), [])
                names.append([x.strip() or f"_c{i}" for i, x in enumerate(row)])
            yield pd.DataFrame({"path": frame["path"], "_names": names})

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = listed.repartition(parts, "path").mapInPandas(heads, "path string, _names array<string>")
    # ranks need the sorted list of files: one narrow row a file
    ranked = found.withColumn("_rank", F.row_number().over(Window.orderBy("path")))
    return ranked.select(_plain_path("path").alias("_file"), "_names", "_rank")


def _plain_path(c) -> Column:
    """A path as text without scheme and with one leading slash, as listings and scans both have it."""
    return F.regexp_replace(F.col(c) if isinstance(c, str) else c, "^[a-z0-9]+:/*", "/")


def read_many_csv(spark: SparkSession, path_glob: str, index_col: str = "column_label") -> DataFrame:
    """``lapply(files, read.csv) |> bind_rows(.id=)`` (IO-04/05).

    Columns bind by name: a table of the files' headers (``csv_headers``,
    written once) is joined to one scan of all files by the file that a row
    comes from, and each column takes the place that its file's header gives
    it; a file that lacks it has nulls.  Lines equal to their file's header
    are headers.  ``index_col`` is the rank of the file's path.  The plan is
    the same for ten files and for ten thousand; the driver sees the
    distinct column names.
    """
    heads = scratch_table(csv_headers(spark, path_glob), "csv-headers")
    # in the order in which files and headers bring them
    order = (heads.select("_rank", F.posexplode("_names").alias("_at", "name")).groupBy("name")
             .agg(F.min(F.struct("_rank", "_at")).alias("_first"), F.max("_at").alias("_at")).orderBy("_first").collect())
    if not order:
        raise FileNotFoundError(f"no header in {path_glob}")
    columns, width = [r["name"] for r in order], max(r["_at"] for r in order) + 1
    schema = ", ".join(f"_v{i} string" for i in range(width))
    lines = (spark.read.schema(schema).option("header", False).option("ignoreLeadingWhiteSpace", True)
             .option("ignoreTrailingWhiteSpace", True).csv(path_glob))
    values = F.array(*[F.col(f"_v{i}") for i in range(width)])
    scanned = F.url_decode(F.replace(F.expr("_metadata.file_path"), F.lit("+"), F.lit("%2B")))  # scans name files as URIs
    rows = lines.select(values.alias("_values"), _plain_path(scanned).alias("_file")).join(heads, "_file")
    named = F.transform(F.slice("_values", 1, F.size("_names")), lambda v, i: F.coalesce(F.trim(v), F.concat(F.lit("_c"), i.cast("string"))))
    rows = rows.filter(named != F.col("_names"))
    place = lambda c: F.array_position("_names", c)
    return rows.select(*[F.when(place(c) > 0, F.get("_values", (place(c) - 1).cast("int"))).alias(c) for c in columns], F.col("_rank").alias(index_col))


def for_csv(df: DataFrame) -> DataFrame:
    """Sink-side NA -> "" (PR-13): text columns, nulls empty."""
    return df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns])


def write_dated_csv(df: DataFrame, out_dir: str, name: str, run_date: str, mode: str = "overwrite") -> str:
    """``write.csv(.., yyyymmdd_NAME.csv)`` (IO-09): the run date is a job
    parameter, never the wall clock inside the job."""
    path = os.path.join(out_dir, f"{run_date}_{name}")
    for_csv(df).write.mode(mode).option("header", True).csv(path)
    return path


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write a staging table (IO-11) and return a plan reading it back: the
    lineage is cut at a durable, shared location."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def stage_in_checkpoint_dir(df: DataFrame, name: str, run: str = "") -> DataFrame:
    """``stage`` under the cluster's ``spark.checkpoint.dir``, in a folder keyed by
    run and plan: two runs, or two plans of one name, never meet, and a run
    that starts again replaces its own table."""
    plan = hashlib.sha256(f"{run}\n{df._jdf.queryExecution().analyzed().canonicalized().toString()}".encode()).hexdigest()[:24]
    return stage(df, scratch_path(df.sparkSession, f"staged/{name}-{plan}"))


def append_history(df: DataFrame, history_path: str, run_date: str, partition_col: str = "run_date") -> None:
    """Append one run to a history table (IO-12), idempotently.

    Rows are written under ``run_date=<run_date>`` with dynamic partition
    overwrite: a retried or re-run job replaces its own partition and never
    touches (or duplicates) earlier runs.
    """
    (df.withColumn(partition_col, F.lit(run_date)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(history_path))


def read_history(spark: SparkSession, history_path: str, run_dates: Sequence[str] | None = None,
                 partition_col: str = "run_date") -> DataFrame:
    """History scan; a run-date filter prunes partitions at the source."""
    df = spark.read.parquet(history_path)
    return df.filter(F.col(partition_col).isin(list(run_dates))) if run_dates else df


def exists(df: DataFrame, cond: Column | None = None) -> bool:
    """``SELECT EXISTS(...)`` (IO-08): stops at the first matching row."""
    d = df.filter(cond) if cond is not None else df
    return len(d.limit(1).take(1)) > 0
