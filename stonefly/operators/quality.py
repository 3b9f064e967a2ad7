"""Declarative table validation (VAL-*).

A rule table drives every check.  Schema rules (column exists / count /
type) are answered from ``df.schema`` without a job.  All row rules of a
table are answered by ONE aggregate pass (``count_if`` per rule, partial
aggregation map-side); each key-uniqueness rule is one ``groupBy``.  The
report is a small DataFrame: step, check_type, columns, values, units,
n_pass, f_pass, warn.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stonefly.functions.nulls import all_true, null_safe_on
from stonefly.operators.aggregates import newest_per_key, repeated_groups
from stonefly.operators.skew import skew_join

SCHEMA_CHECKS = {"col_exists", "col_count_match", "col_is_character", "col_is_numeric", "col_is_posix",
                 "col_is_date", "col_is_logical"}
ROW_CHECKS = {"col_vals_expr", "col_vals_not_null", "col_vals_null", "col_vals_in_set", "col_vals_not_in_set",
              "col_vals_between", "col_vals_regex"}
KEY_CHECKS = {"rows_distinct"}

_TYPE_TEST = {
    "col_is_character": lambda t: isinstance(t, (T.StringType, T.VarcharType, T.CharType)),
    "col_is_numeric": lambda t: isinstance(t, T.NumericType),
    "col_is_posix": lambda t: isinstance(t, (T.TimestampType, T.TimestampNTZType)),
    "col_is_date": lambda t: isinstance(t, T.DateType),
    "col_is_logical": lambda t: isinstance(t, T.BooleanType),
}


@dataclass(frozen=True)
class Rule:
    """One validation step.

    check: one of SCHEMA_CHECKS / ROW_CHECKS / KEY_CHECKS.
    columns: the column(s) the step is about (``rows_distinct`` with no
        columns means all columns).
    values: set for ``col_vals_in_set``, (left, right) for between, the
        count for ``col_count_match``, the pattern for ``col_vals_regex``.
    expr: Spark SQL predicate for ``col_vals_expr``.
    """
    check: str
    columns: tuple = ()
    values: tuple = ()
    expr: str | None = None
    na_pass: bool = False
    step_id: str = ""


@dataclass
class RuleSet:
    table: str
    rules: list = field(default_factory=list)
    warn_at: int = 1


def expand(check: str, columns: Sequence[str], **kw) -> list[Rule]:
    """pointblank-style helper: one step per column."""
    return [Rule(check, (c,), **kw) for c in columns]


def _label(values) -> str:
    if not values:
        return ""
    return ", ".join(str(v) for v in values)


def _q(v) -> str:
    """Spark SQL literal."""
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(v, bool):
        return "true" if v else "false"
    return repr(v)


def _ident(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def _row_pass_sql(rule: Rule) -> str:
    """A row rule as one Spark SQL predicate, TRUE for passing rows (null
    counts as failing unless ``na_pass``)."""
    c = _ident(rule.columns[0]) if rule.columns else None
    if rule.check == "col_vals_not_null":
        return f"{c} IS NOT NULL"
    if rule.check == "col_vals_null":
        return f"{c} IS NULL"
    if rule.check == "col_vals_expr":
        p = rule.expr
    elif rule.check == "col_vals_in_set":
        p = f"{c} IN ({', '.join(_q(v) for v in rule.values)})"
    elif rule.check == "col_vals_not_in_set":
        p = f"NOT ({c} IN ({', '.join(_q(v) for v in rule.values)}))"
    elif rule.check == "col_vals_between":
        p = f"{c} BETWEEN {_q(rule.values[0])} AND {_q(rule.values[1])}"
    elif rule.check == "col_vals_regex":
        p = f"{c} RLIKE {_q(rule.values[0])}"
    else:
        raise ValueError(rule.check)
    fallback = f"{c} IS NULL" if (rule.na_pass and c is not None) else "false"
    return f"coalesce(({p}), {fallback})"


def _row_pass(rule: Rule) -> Column:
    return F.expr(_row_pass_sql(rule))


def _schema_result(df: DataFrame, rule: Rule) -> int:
    if rule.check == "col_exists":
        return int(all(c in df.columns for c in rule.columns))
    if rule.check == "col_count_match":
        return int(len(df.columns) == int(rule.values[0]))
    test = _TYPE_TEST[rule.check]
    fields = {f.name: f.dataType for f in df.schema.fields}
    return int(all(c in fields and test(fields[c]) for c in rule.columns))


REPORT_SCHEMA = ("step int, check_type string, columns string, `values` string, units bigint, "
                 "n_pass bigint")


def interrogate(df: DataFrame, rules: Sequence[Rule], warn_at: int = 1) -> DataFrame:
    """Run all rules; returns the report DataFrame (lazy).

    Row rules on missing columns are reported as failing schema steps
    rather than raising, so one bad column never hides the others.
    """
    spark = df.sparkSession
    cols = set(df.columns)
    const_rows, row_rules, key_rules = [], [], []
    for i, r in enumerate(rules, start=1):
        label_cols = ", ".join(r.columns)
        if r.check in SCHEMA_CHECKS:
            const_rows.append((i, r.check, label_cols, _label(r.values), 1, _schema_result(df, r)))
        elif r.check in ROW_CHECKS:
            if any(c not in cols for c in r.columns):
                const_rows.append((i, r.check, label_cols, _label(r.values or ((r.expr,) if r.expr else ())), 1, 0))
            else:
                row_rules.append((i, r))
        elif r.check in KEY_CHECKS:
            if any(c not in cols for c in r.columns):
                const_rows.append((i, r.check, label_cols, "", 1, 0))
            else:
                key_rules.append((i, r))
        else:
            raise ValueError(f"unknown check {r.check}")
    parts = []
    if const_rows:
        parts.append(spark.createDataFrame(const_rows, REPORT_SCHEMA))
    if row_rules:
        # One aggregate pass for every row rule, written as SQL text so a
        # rule set of a hundred steps costs one plan node, not hundreds of
        # separately built expressions.
        aggs = ["count(1) AS _units"] + [f"count_if({_row_pass_sql(r)}) AS _p{i}" for i, r in row_rules]
        one = df.agg(*[F.expr(a) for a in aggs])
        triples = ", ".join(
            f"{i}, {_q(r.check)}, {_q(', '.join(r.columns))}, "
            f"{_q(_label(r.values) if r.values else (r.expr or ''))}, _units, _p{i}"
            for i, r in row_rules)
        parts.append(one.selectExpr(
            f"stack({len(row_rules)}, {triples}) AS (step, check_type, columns, `values`, units, n_pass)"))
    for i, r in key_rules:
        keys = list(r.columns) or df.columns
        res = key_counts(df, keys)
        parts.append(res.select(F.lit(i).alias("step"), F.lit(r.check).alias("check_type"),
                                F.lit(", ".join(r.columns)).alias("columns"), F.lit("").alias("values"),
                                "units", "n_pass"))
    report = reduce(lambda a, b: a.unionByName(b), parts)
    report = report.withColumn("step", F.col("step").cast("int"))
    f = F.when(F.col("units") > 0, F.col("n_pass") / F.col("units"))
    return report.withColumns({"f_pass": f, "warn": (F.col("units") - F.col("n_pass")) >= warn_at})


WIDE_KEY_COLUMNS = 4


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``units`` (rows) and ``n_pass`` (rows whose key occurs once).

    Narrow keys: one partial aggregate on the key.  Wide keys (many or long
    columns, e.g. "all rows distinct"): shuffling whole rows is avoided.
    Rows are first grouped by a 96-bit hash of the key (16 bytes per row in
    the shuffle); only rows whose hash repeats - the duplicates plus any
    hash collisions - are grouped again on the real key columns, which
    keeps the result exact.
    """
    cnt = F.count(F.lit(1))
    if len(keys) <= WIDE_KEY_COLUMNS:
        g = df.groupBy(*keys).agg(cnt.alias("_n"))
        return g.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("units"),
                     F.coalesce(F.sum(F.when(F.col("_n") == 1, F.col("_n"))), F.lit(0)).cast("bigint").alias("n_pass"))
    kcols = [F.col(f"`{k}`") for k in keys]
    hashed = df.select(*kcols, F.xxhash64(*kcols).alias("_h1"), F.hash(*kcols).alias("_h2"))
    by_hash = hashed.groupBy("_h1", "_h2").agg(cnt.alias("_n"))
    units = by_hash.select(F.col("_n").alias("_u"), F.lit(0).cast("bigint").alias("_bad"))
    repeated = by_hash.filter(F.col("_n") > 1).select("_h1", "_h2")
    cand = hashed.join(repeated, ["_h1", "_h2"], "left_semi")
    exact = cand.groupBy(*kcols).agg(cnt.alias("_n"))
    bad = exact.filter(F.col("_n") > 1).select(F.lit(0).cast("bigint").alias("_u"), F.col("_n").alias("_bad"))
    tot = units.unionByName(bad).agg(F.coalesce(F.sum("_u"), F.lit(0)).cast("bigint").alias("units"),
                                     F.coalesce(F.sum("_bad"), F.lit(0)).cast("bigint").alias("_bad"))
    return tot.select("units", (F.col("units") - F.col("_bad")).alias("n_pass"))


def failing_checks(report: DataFrame) -> DataFrame:
    """Steps with ``f_pass < 1`` (VAL-11)."""
    return report.filter(F.coalesce(F.col("f_pass"), F.lit(0.0)) < 1)


def failure_summary(report: DataFrame, table_name: str) -> DataFrame:
    """Failing steps counted per check type with a message (VAL-12)."""
    return (failing_checks(report).groupBy("check_type").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("message", F.concat(F.col("n").cast("string"), F.lit(" "), F.col("check_type"),
                                            F.lit(" issues")))
            .withColumn("table_name", F.lit(table_name)))


def warning_text(report: DataFrame, table_name: str) -> str | None:
    """The warning sentence, or None when every step passes (an action on
    the small report)."""
    rows = (failing_checks(report).groupBy("check_type").agg(F.count(F.lit(1)).alias("n"))
            .orderBy("check_type").collect())
    if not rows:
        return None
    n = sum(r["n"] for r in rows)
    msgs = [f"{r['n']} {r['check_type']} issues" for r in rows]
    joined = msgs[0] if len(msgs) == 1 else ", ".join(msgs[:-1]) + ", and " + msgs[-1]
    return f"There are {n} validation failure{'s' if n != 1 else ''} related to the {table_name} table: {joined}"


def failing_rows(df: DataFrame, rules: Sequence[Rule], n: int = 50, order_by: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` failing rows of every row rule (SL-01, ``get_first_n``).

    One scan: each row is tagged with the steps it fails, exploded, and
    ``row_number() <= n`` is taken per step.  Spark runs that limit partially
    in every map task before the shuffle, so a rule that fails on most rows
    still sends at most n rows per map partition to its final task.
    ``order_by`` must make the order total for a deterministic extract.
    """
    from pyspark.sql import Window
    order = list(order_by or df.columns)
    row_rules = [(i, r) for i, r in enumerate(rules, start=1)
                 if r.check in ROW_CHECKS and all(c in df.columns for c in r.columns)]
    if not row_rules:
        return df.limit(0).withColumn("step", F.lit(0))
    fails = F.array_compact(F.array(*[F.when(~_row_pass(r), F.lit(i)) for i, r in row_rules]))
    tagged = df.select("*", F.explode(fails).alias("step"))
    w = Window.partitionBy("step").orderBy(*[F.col(c) for c in order])
    return tagged.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row of a duplicate key group (VAL-09)."""
    return repeated_groups(df, keys)


def compare_schemas(spark: SparkSession, a: DataFrame, b: DataFrame, names: tuple[str, str] = ("a", "b")) -> DataFrame:
    """Columns whose type differs or that exist on one side only (VAL-17)."""
    ta, tb = dict(a.dtypes), dict(b.dtypes)
    rows = []
    for c in sorted(set(ta) | set(tb)):
        if ta.get(c) != tb.get(c):
            rows.append((c, ta.get(c), tb.get(c)))
    return spark.createDataFrame(rows, f"column_name string, {names[0]} string, {names[1]} string")


def validate(df: DataFrame, table_name: str, rule_sets: Mapping[str, RuleSet] | None = None,
             base_only: bool = False) -> DataFrame:
    """Dispatch by table name (VAL-14); unknown names are an error.
    ``base_only`` runs the column-presence set only (VAL-15, no data job)."""
    if base_only:
        from stonefly.config.rules import base_column_rules
        return interrogate(df, base_column_rules(table_name).rules)
    if rule_sets is None:
        from stonefly.config.rules import RULE_SETS
        rule_sets = RULE_SETS
    key = table_name.upper()
    if key not in rule_sets:
        raise ValueError(f"no validation rules for table {table_name!r}")
    rs = rule_sets[key]
    return interrogate(df, rs.rules, rs.warn_at)


# -- VAL-16: foreign keys ---------------------------------------------------------
def staged_parent_rows(log: DataFrame, parent: str, schema: T.StructType, uid: str = "UID",
                       version: str = "VERSION", data: str = "DATA", table_col: str = "TABLE_NAME") -> DataFrame:
    """Newest staged row image per UID of ``parent`` from a transfer log,
    parsed from JSON to columns (IO-08, WN-03, JSON-01)."""
    rows = log.filter(F.col(table_col) == parent).select(uid, version, data)
    newest = newest_per_key(rows, [uid], [version])
    return newest.select(F.from_json(F.col(data), schema).alias("_d")).select("_d.*")


def validate_fks(df: DataFrame, table_name: str, dictionary: DataFrame, parents: Mapping[str, DataFrame],
                 log: DataFrame | None = None) -> DataFrame:
    """Flag each row's foreign keys (VAL-16).

    The dictionary (plan metadata, a few rows per table) names the FK
    columns and parent tables.  For each parent: parent keys = warehouse
    rows UNION newest staged rows not already there, de-duplicated so the
    join cannot fan out; a null-safe left join adds ``MATCHED_<parent>``.
    ``FK_VALIDATION_PASSED`` is the AND of all flags (True without parents).
    """
    meta = (dictionary.filter((F.upper("TABLE_NAME") == table_name.upper()) & F.col("FOREIGN_KEY")
                              & (F.col("PARENT_TABLE") != "NONE"))
            .select("COLUMN_NAME", "PARENT_TABLE").collect())
    by_parent: dict[str, list[str]] = {}
    for r in meta:
        by_parent.setdefault(r["PARENT_TABLE"], []).append(r["COLUMN_NAME"])
    out = df
    flags = []
    for parent, keys in sorted(by_parent.items()):
        keys = sorted(set(keys))
        base = parents[parent].select(*keys)
        if log is not None:
            schema = T.StructType([f for f in parents[parent].schema.fields if f.name in keys])
            staged = staged_parent_rows(log, parent, schema).select(*keys)
            new = staged.join(base, null_safe_on(staged, base, keys), "left_anti")
            base = base.unionByName(new)
        marks = base.dropDuplicates(keys).withColumn("_m", F.lit(True))
        flag = f"MATCHED_{parent}"
        out = (skew_join(out, marks, keys).select(*out.columns, "_m")
               .withColumn(flag, F.coalesce(F.col("_m"), F.lit(False))).drop("_m"))
        flags.append(flag)
    return out.withColumn("FK_VALIDATION_PASSED", all_true(flags))


# -- AG-12: column profile -------------------------------------------------------
def profile(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = False) -> DataFrame:
    """One row per column: n, missing, unique, mean, sd, min, max, p25,
    p50, p75 in ONE aggregate pass.  ``exact=False`` uses
    ``approx_count_distinct`` / ``percentile_approx`` (bounded memory);
    ``exact=True`` counts distinct exactly and skips quantiles."""
    columns = list(columns or df.columns)
    types = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(columns):
        col = F.col(c)
        numeric = types[c] in ("double", "float", "int", "bigint", "smallint", "tinyint") or types[c].startswith("decimal")
        aggs.append(F.count_if(col.isNull()).alias(f"_miss{i}"))
        aggs.append((F.countDistinct(col) if exact else F.approx_count_distinct(col)).alias(f"_uniq{i}"))
        if numeric:
            aggs += [F.avg(col).alias(f"_mean{i}"), F.stddev_samp(col).alias(f"_sd{i}"),
                     F.min(col).cast("double").alias(f"_min{i}"), F.max(col).cast("double").alias(f"_max{i}")]
            if not exact:
                aggs.append(F.percentile_approx(col.cast("double"), [0.25, 0.5, 0.75]).alias(f"_q{i}"))
    one = df.agg(*aggs)
    structs = []
    for i, c in enumerate(columns):
        numeric = f"_mean{i}" in one.columns
        nul = F.lit(None).cast("double")
        structs.append(F.struct(
            F.lit(c).alias("column_name"), F.lit(types[c]).alias("column_type"),
            F.col("_n").alias("n"), F.col(f"_miss{i}").alias("n_missing"),
            F.col(f"_uniq{i}").cast("bigint").alias("n_unique"),
            (F.col(f"_mean{i}") if numeric else nul).alias("mean"),
            (F.col(f"_sd{i}") if numeric else nul).alias("sd"),
            (F.col(f"_min{i}") if numeric else nul).alias("min"),
            (F.col(f"_max{i}") if numeric else nul).alias("max"),
            *([] if exact else [(F.col(f"_q{i}")[j] if numeric else nul).alias(n)
                                for j, n in enumerate(["p25", "p50", "p75"])])))
    return one.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


# -- AG-12: profiles that merge over runs -------------------------------------------
#: Size of the quantile sketches, and their error: the rank of a quantile is right
#: to this share of the rows (99 of 100 times, as the sketch's library states it).
KLL_K, KLL_RANK_ERROR = 1000, 0.0028
#: Relative error of the distinct counts (HyperLogLog of 2^14 registers, three deviations).
HLL_LG, HLL_ERROR = 14, 0.025
NUMERIC_TYPES = ("double", "float", "int", "bigint", "smallint", "tinyint")


def profile_sketches(df: DataFrame, run: str | Column, columns: Sequence[str] | None = None) -> DataFrame:
    """One row for each run and column: counts, moments, range and two sketches,
    in one aggregate (no Expand, no distinct).  The rows are small, whatever
    the table: kept per run, they merge by ``merge_profiles``.

    ``run``: a name for all rows, or a column that tells the runs apart.
    """
    columns, types = list(columns or df.columns), dict(df.dtypes)
    label = F.lit(run) if isinstance(run, str) else run
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(columns):
        col = F.col(f"`{c}`")
        aggs += [F.count(col).alias(f"_k{i}"), F.hll_sketch_agg(col.cast("string"), HLL_LG).alias(f"_h{i}")]
        if types[c] in NUMERIC_TYPES or types[c].startswith("decimal"):
            x = col.cast("double")
            aggs += [F.avg(x).alias(f"_m{i}"), F.var_pop(x).alias(f"_v{i}"), F.min(x).alias(f"_a{i}"), F.max(x).alias(f"_b{i}"),
                     F.kll_sketch_agg_double(x, F.lit(KLL_K)).alias(f"_q{i}")]
    one = df.groupBy(label.alias("run")).agg(*aggs)
    none, rows = F.lit(None).cast("double"), []
    for i, c in enumerate(columns):
        number = f"_m{i}" in one.columns
        rows.append(F.struct(
            F.lit(c).alias("column_name"), F.lit(types[c]).alias("column_type"), F.col("_n").alias("n"), F.col(f"_k{i}").alias("n_known"),
            (F.col(f"_m{i}") if number else none).alias("mean"), (F.col(f"_v{i}") * F.col(f"_k{i}") if number else none).alias("squares"),
            (F.col(f"_a{i}") if number else none).alias("min"), (F.col(f"_b{i}") if number else none).alias("max"),
            F.col(f"_h{i}").alias("distinct_sketch"),
            (F.col(f"_q{i}") if number else F.lit(None).cast("binary")).alias("quantile_sketch")))
    return one.select("run", F.inline(F.array(*rows)))


def merge_profiles(sketches: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One row a column over all runs of ``profile_sketches``: n, n_missing, about
    n_unique, mean, sd, min, max and ``p<percent>`` quantiles.

    Moments merge exactly (but for rounding), sketches within KLL_RANK_ERROR
    and HLL_ERROR, however many runs there were.
    """
    keys = ["column_name", "column_type"]
    # moments about a common point: the runs' means, weighted
    total = F.sum("n_known")
    some = F.col("n_known") > 0
    merged = sketches.groupBy(*keys).agg(
        F.sum("n").alias("n"), total.alias("_k"), (F.sum(F.when(some, F.col("n_known") * F.col("mean"))) / total).alias("mean"),
        F.sum("squares").alias("_within"), F.collect_list(F.struct("n_known", "mean")).alias("_runs"),
        F.min("min").alias("min"), F.max("max").alias("max"),
        F.hll_union_agg("distinct_sketch").alias("_h"), F.kll_merge_agg_double("quantile_sketch").alias("_q"))
    between = F.aggregate(F.filter("_runs", lambda r: r["n_known"] > 0), F.lit(0.0),
                          lambda acc, r: acc + r["n_known"] * (r["mean"] - F.col("mean")) * (r["mean"] - F.col("mean")))
    out = merged.withColumn("sd", F.when(F.col("_k") > 1, F.sqrt((F.col("_within") + between) / (F.col("_k") - 1))))
    is_number = F.col("mean").isNotNull()
    return out.select(*keys, "n", (F.col("n") - F.col("_k")).alias("n_missing"), F.hll_sketch_estimate("_h").alias("n_unique"),
                      "mean", "sd", "min", "max",
                      *[F.when(is_number, F.kll_sketch_get_quantile_double("_q", F.lit(float(x)))).alias(f"p{round(100 * x):02d}") for x in quantiles])
