"""SQL text for the DuckDB oracle, generated from the same configuration
tables the Spark plans use (score curves, categories, minimums)."""

from __future__ import annotations

from stonefly.config import scoring
from stonefly.functions.numeric import round_half_up_sql


def dbl(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def segment_score_sql(v: str, segments) -> str:
    if not segments:
        return "CAST(NULL AS DOUBLE)"

    def line(seg):
        a, b, sa, sb = (float(x) for x in seg)
        return f"({dbl(sa)} + ({v} - {dbl(a)}) * {dbl((sb - sa) / (b - a))})"

    parts = [f"WHEN {v} <= {dbl(seg[1])} THEN {line(seg)}" for seg in segments[:-1]]
    expr = f"CASE {' '.join(parts)} ELSE {line(segments[-1])} END" if parts else line(segments[-1])
    return (f"CASE WHEN {v} IS NULL THEN NULL ELSE LEAST(GREATEST({expr}, {dbl(scoring.SCORE_MIN)}), "
            f"{dbl(scoring.SCORE_MAX)}) END")


def method_score_sql(method: str, metric: str, value: str | None = None) -> str:
    value = value or metric
    whens = [f"WHEN {method} = {m} THEN {segment_score_sql(value, segs)}"
             for (m, name), segs in scoring.SCORE_SEGMENTS.items() if name == metric]
    return f"CASE {' '.join(whens)} ELSE CAST(NULL AS DOUBLE) END" if whens else "CAST(NULL AS DOUBLE)"


def metrics_of_method_sql(method: str, metrics) -> str:
    """``REPLACE`` list: each metric null where the method doesn't have it."""
    def one(metric):
        ids = [str(m) for m, names in scoring.METHOD_METRICS.items() if metric in names]
        return f"CASE WHEN {method} IN ({', '.join(ids)}) THEN {metric} END AS {metric}" if ids else f"CASE WHEN FALSE THEN {metric} END AS {metric}"
    return ", ".join(one(m) for m in metrics)


def profile_sql(method: str, metrics, digits: int = 2) -> str:
    whens = []
    for m, names in scoring.PROFILE_METRICS.items():
        used = [n for n in names if n in metrics]
        if not used:
            continue
        total = " + ".join(["0.0"] + [f"score_{n}" for n in used])
        whens.append(f"WHEN {method} = {m} THEN {round_half_up_sql(f'({total}) / {dbl(len(used))}', digits)}")
    return f"CASE {' '.join(whens)} ELSE CAST(NULL AS DOUBLE) END"


def impact_category_sql(v: str, default: str = "") -> str:
    parts = []
    for label, lo, hi in scoring.IMPACT_CATEGORIES:
        if lo is None:
            cond = f"{v} < {dbl(hi)}"
        elif hi is None:
            cond = f"{v} > {dbl(lo)}"
        else:
            cond = f"{v} BETWEEN {dbl(lo)} AND {dbl(hi)}"
        parts.append(f"WHEN {cond} THEN '{label}'")
    return f"CASE {' '.join(parts)} ELSE '{default}' END"


def below_minimum_sql(method: str, total: str) -> str:
    conds = [f"({method} = '{name}' AND {total} < {minimum})" for name, minimum in scoring.COUNT_MINIMUM.items()]
    return f"COALESCE({' OR '.join(conds)}, FALSE)"


def in_list(values) -> str:
    return "(" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + ")"


def _lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def rule_predicate_sql(rule) -> str:
    """A row rule as a DuckDB predicate that is TRUE for passing rows."""
    c = rule.columns[0] if rule.columns else None
    if rule.check == "col_vals_not_null":
        return f"{c} IS NOT NULL"
    if rule.check == "col_vals_null":
        return f"{c} IS NULL"
    if rule.check == "col_vals_expr":
        p = rule.expr.replace("char_length(", "length(")
    elif rule.check == "col_vals_in_set":
        p = f"{c} IN ({', '.join(_lit(v) for v in rule.values)})"
    elif rule.check == "col_vals_not_in_set":
        p = f"{c} NOT IN ({', '.join(_lit(v) for v in rule.values)})"
    elif rule.check == "col_vals_between":
        p = f"{c} BETWEEN {_lit(rule.values[0])} AND {_lit(rule.values[1])}"
    elif rule.check == "col_vals_regex":
        p = f"regexp_matches({c}, {_lit(rule.values[0])})"
    else:
        raise ValueError(rule.check)
    fallback = f"{c} IS NULL" if (rule.na_pass and c) else "FALSE"
    return f"COALESCE({p}, {fallback})"


def interrogate_sql(rules, source_sql: str, schema: dict) -> str:
    """The validation report of ``rules`` over ``source_sql`` as DuckDB SQL.

    ``schema`` (column -> Spark type name) answers the schema rules, which
    are metadata; row and key rules are computed by DuckDB over the data.
    """
    from stonefly.operators import quality as Q
    from pyspark.sql import types as T

    type_objs = {"string": T.StringType(), "double": T.DoubleType(), "bigint": T.LongType(), "int": T.IntegerType(),
                 "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType(), "date": T.DateType(),
                 "boolean": T.BooleanType()}
    rows = []
    for i, r in enumerate(rules, start=1):
        cols = ", ".join(r.columns)
        label = Q._label(r.values) if r.values else (r.expr or "")
        if r.check in Q.SCHEMA_CHECKS:
            if r.check == "col_exists":
                ok = all(c in schema for c in r.columns)
            elif r.check == "col_count_match":
                ok = len(schema) == int(r.values[0])
            else:
                ok = all(c in schema and Q._TYPE_TEST[r.check](type_objs[schema[c]]) for c in r.columns)
            rows.append(f"SELECT {i} AS step, '{r.check}' AS check_type, {_lit(cols)} AS columns, "
                        f"{_lit(Q._label(r.values))} AS \"values\", 1 AS units, {int(ok)} AS n_pass")
        elif r.check in Q.ROW_CHECKS:
            if any(c not in schema for c in r.columns):
                rows.append(f"SELECT {i}, '{r.check}', {_lit(cols)}, {_lit(label)}, 1, 0")
            else:
                rows.append(f"SELECT {i}, '{r.check}', {_lit(cols)}, {_lit(label)}, COUNT(*), "
                            f"COUNT(*) FILTER (WHERE {rule_predicate_sql(r)}) FROM src")
        elif any(c not in schema for c in r.columns):
            rows.append(f"SELECT {i}, '{r.check}', {_lit(cols)}, '', 1, 0")
        else:
            keys = ", ".join(r.columns) if r.columns else ", ".join(schema)
            rows.append(f"SELECT {i}, '{r.check}', {_lit(cols)}, '', COALESCE(SUM(n), 0), "
                        f"COALESCE(SUM(CASE WHEN n = 1 THEN n ELSE 0 END), 0) FROM "
                        f"(SELECT COUNT(*) AS n FROM src GROUP BY {keys})")
    body = "\nUNION ALL ".join(rows)
    return f"""WITH src AS ({source_sql}),
r AS ({body})
SELECT CAST(step AS INTEGER) AS step, check_type, columns, "values", CAST(units AS BIGINT) AS units,
       CAST(n_pass AS BIGINT) AS n_pass,
       {round_half_up_sql('CASE WHEN units > 0 THEN CAST(n_pass AS DOUBLE) / units END', 6)} AS f_pass,
       CAST(units - n_pass >= 1 AS INTEGER) AS warn
FROM r"""
