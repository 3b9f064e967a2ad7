"""Community metrics and 0-10 scores per sample (MET-*).

Input grain is (sample, taxon, count).  Duplicate taxon rows of a sample are
summed first; that pre-aggregation is also what keeps every later step
skew-safe: a sample holds at most one row per taxon afterwards, and every
metric except dominance is one partial aggregate over those rows.

Formulas (all per sample, n_i = individuals of taxon i, N = sum n_i):

* total individuals  N
* richness           number of taxa
* EPT / NCO richness number of taxa in / outside a group flag
* biotic indices     sum(n_i * t_i) / sum(n_i over taxa with a tolerance t_i)
* Shannon (log2)     log2(N) - sum(n_i * log2 n_i) / N  (= -sum p_i log2 p_i)
* dominance-3        100 * (three largest n_i) / N
* model affinity     sum over groups of min(percent_g, model_g)
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stonefly.config import scoring
from stonefly.functions.numeric import round_half_up
from stonefly.operators.aggregates import top_k_per_group
from stonefly.operators.joins import join_null_safe
from stonefly.operators.skew import skew_join


def sum_duplicate_taxa(df: DataFrame, sample_cols: Sequence[str], taxon_col: str, count_col: str,
                       carry: Sequence[str] | Mapping[str, Column] = ()) -> DataFrame:
    """One row per (sample, taxon) with the summed count.  ``carry``: names
    of attributes constant per sample or taxon (kept with ``first``), or a
    mapping name -> aggregate expression."""
    aggs = [F.sum(count_col).alias(count_col)]
    if isinstance(carry, Mapping):
        aggs += [e.alias(n) for n, e in carry.items()]
    else:
        aggs += [F.first(c, ignorenulls=True).alias(c) for c in carry]
    return df.groupBy(*sample_cols, taxon_col).agg(*aggs)


def basic_metrics(counts: DataFrame, sample_cols: Sequence[str], taxon_col: str, count_col: str,
                  flags: Mapping[str, str] | None = None,
                  tolerances: Mapping[str, str] | None = None,
                  shannon: bool = True) -> DataFrame:
    """One partial aggregate per sample over de-duplicated taxon rows.

    ``flags``: output name -> boolean column; counts taxa where it is true.
    ``tolerances``: output name -> tolerance column; count-weighted mean
    over taxa that have a tolerance.
    """
    n = F.col(count_col)
    aggs = [F.sum(n).alias("total_individuals"), F.count(F.col(taxon_col)).alias("richness")]
    for name, flag in (flags or {}).items():
        aggs.append(F.count_if(F.coalesce(F.col(flag), F.lit(False))).alias(name))
    for name, tol in (tolerances or {}).items():
        t = F.col(tol)
        aggs.append(F.try_divide(F.sum(n * t), F.sum(F.when(t.isNotNull(), n))).alias(name))
    if shannon:
        aggs.append(F.sum(F.when(n > 0, n * F.log2(n))).alias("_nlogn"))
    out = counts.groupBy(*sample_cols).agg(*aggs)
    if shannon:
        total = F.col("total_individuals")
        out = (out.withColumn("shannon_diversity",
                              F.when(total > 0, F.log2(total) - F.coalesce(F.col("_nlogn"), F.lit(0.0)) / total))
               .drop("_nlogn"))
    return out


def dominance(counts: DataFrame, sample_cols: Sequence[str], taxon_col: str, count_col: str,
              k: int = 3, name: str | None = None) -> DataFrame:
    """Percent of individuals in the k most numerous taxa (MET-09, SL-02).
    The top-k sum does not depend on how ties are broken."""
    name = name or f"percent_dominance_{k}"
    top = top_k_per_group(counts, sample_cols, [F.col(count_col).desc(), F.col(taxon_col)], k,
                          salt_cols=[taxon_col])
    topsum = top.groupBy(*sample_cols).agg(F.sum(count_col).alias("_top"))
    totals = counts.groupBy(*sample_cols).agg(F.sum(count_col).alias("_total"))
    return (totals.join(topsum, list(sample_cols), "left")
            .select(*sample_cols, (F.lit(100.0) * F.try_divide(F.col("_top"), F.col("_total"))).alias(name)))


def percent_model_affinity(counts: DataFrame, sample_cols: Sequence[str], group_col: str, count_col: str,
                           model: DataFrame, model_keys: Sequence[str] = (), model_percent: str = "percent",
                           name: str = "percent_model_affinity") -> DataFrame:
    """Percentage similarity of the sample's group mix to a model mix.

    ``model`` has ``model_keys`` (e.g. method) + ``group_col`` + percent.
    Groups absent from either side add min(x, 0) = 0, so an inner join of
    the per-group percentages with the model is exact.
    """
    per_group = counts.groupBy(*sample_cols, *model_keys, group_col).agg(F.sum(count_col).alias("_g"))
    totals = per_group.groupBy(*sample_cols).agg(F.sum("_g").alias("_n"))
    pct = per_group.join(totals, list(sample_cols)).withColumn(
        "_pct", F.lit(100.0) * F.col("_g") / F.col("_n"))
    m = model.select(*model_keys, group_col, F.col(model_percent).alias("_model"))
    sim = (skew_join(pct, m, [*model_keys, group_col], "inner")
           .groupBy(*sample_cols).agg(F.sum(F.least(F.col("_pct"), F.col("_model"))).alias(name)))
    return totals.select(*sample_cols).join(sim, list(sample_cols), "left").fillna({name: 0.0})


def sample_state(counts: DataFrame, sample_cols: Sequence[str], taxon_col: str, count_col: str,
                 columns: Sequence[str] = (), carry: Mapping[str, Column] | None = None) -> DataFrame:
    """One row a sample, with the array ``taxa`` of its (taxon, n, columns...).

    ``counts`` holds a sample's taxon once (``sum_duplicate_taxa``), so an array
    is bounded by the number of taxa there are, whatever the number of rows.
    Everything else about a sample is an expression on its array: one
    exchange serves all metrics, and plans that read the same state share it.
    ``carry``: extra aggregates of the sample.
    """
    fields = F.struct(F.col(taxon_col).alias("taxon"), F.col(count_col).alias("n"), *[F.col(c).alias(c) for c in columns])
    return counts.groupBy(*sample_cols).agg(F.collect_list(fields).alias("taxa"),
                                            *[e.alias(n) for n, e in (carry or {}).items()])


def _total(items: Column, value) -> Column:
    """Sum of ``value`` over an array; null without any non-null value."""
    values = F.filter(F.transform(items, value), lambda v: v.isNotNull())
    return F.when(F.size(values) > 0, F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v))


def _flagged(items: Column, flag: str) -> Column:
    return F.size(F.filter(items, lambda x: F.coalesce(x[flag], F.lit(False)))).cast("bigint")


def _weighted_mean(items: Column, value: str) -> Column:
    known = F.filter(items, lambda x: x[value].isNotNull())
    return F.try_divide(_total(known, lambda x: x["n"] * x[value]), _total(known, lambda x: x["n"].cast("double")))


def model_lookup(model: DataFrame, model_keys: Sequence[str], group_col: str, model_percent: str = "percent") -> Column:
    """A model (rows of method, taxon group and percent) as a map of the plan: from
    its keys (``_model_key``) to a map from the group to the percentages it is given.

    A scalar subquery: the few rows are read once and no sample is shuffled or
    dealt by its method."""
    groups = (model.filter(F.col(group_col).isNotNull()).groupBy(_model_key(model_keys).alias("k"), F.col(group_col).alias("g"))
              .agg(F.collect_list(F.coalesce(F.col(model_percent).cast("double"), F.lit(0.0))).alias("percent")))
    by_key = groups.groupBy("k").agg(F.map_from_entries(F.collect_list(F.struct("g", "percent"))).alias("v"))
    return by_key.agg(F.map_from_entries(F.collect_list(F.struct("k", "v")))).scalar()


def _model_key(model_keys: Sequence[str]) -> Column:
    """The keys of a model as one value that is never null, null keys being values like any other."""
    return F.struct(F.lit(0).alias("_"), *[F.col(k).alias(k) for k in model_keys])


def _affinity(taxa: Column, group_col: str, total: Column, mine: Column) -> Column:
    """Sum over the model's groups of the lesser of the sample's and the model's percentage.

    One pass over the taxa in the order of their groups: the work grows with
    the taxa, not with the taxa times the model's groups."""
    known = F.filter(taxa, lambda x: x[group_col].isNotNull())
    ordered = F.sort_array(F.transform(known, lambda x: F.struct(x[group_col].alias("g"), x["n"].cast("double").alias("n"))))

    def closed(acc):
        share = F.coalesce(F.lit(100.0) * acc["s"] / total, F.lit(0.0))
        percents = F.element_at(mine, acc["g"])
        return F.when(percents.isNull(), acc["sum"]).otherwise(F.aggregate(percents, acc["sum"], lambda a, p: a + F.least(share, p)))

    def state(g, s, done):
        return F.struct(g.alias("g"), s.alias("s"), done.alias("sum"))

    def step(acc, x):
        n = F.coalesce(x["n"], F.lit(0.0))
        return F.when(acc["g"] == x["g"], state(acc["g"], acc["s"] + n, acc["sum"])).otherwise(state(x["g"], n, closed(acc)))

    return F.aggregate(ordered, state(F.lit(None).cast("string"), F.lit(0.0), F.lit(0.0)), step, closed)


def state_metrics(state: DataFrame, flags: Mapping[str, str] | None = None, tolerances: Mapping[str, str] | None = None,
                  group_col: str | None = None, model: DataFrame | None = None, model_keys: Sequence[str] = (),
                  model_percent: str = "percent", dominance_k: int | None = 3) -> DataFrame:
    """The columns of ``state`` but ``taxa``, and all metrics of its arrays."""
    taxa = F.col("taxa")
    out = state.withColumn("total_individuals", _total(taxa, lambda x: x["n"].cast("double")))
    total = F.col("total_individuals")
    cols = {"richness": F.size(F.filter(taxa, lambda x: x["taxon"].isNotNull())).cast("bigint")}
    for name, flag in (flags or {}).items():
        cols[name] = _flagged(taxa, flag)
    for name, tol in (tolerances or {}).items():
        cols[name] = _weighted_mean(taxa, tol)
    nlogn = _total(F.filter(taxa, lambda x: x["n"] > 0), lambda x: x["n"] * F.log2(x["n"]))
    cols["shannon_diversity"] = F.when(total > 0, F.log2(total) - F.coalesce(nlogn, F.lit(0.0)) / total)
    if dominance_k:
        largest = F.slice(F.sort_array(F.transform(taxa, lambda x: x["n"].cast("double")), asc=False), 1, dominance_k)
        cols[f"percent_dominance_{dominance_k}"] = F.lit(100.0) * F.try_divide(_total(largest, lambda v: v), total)
    if group_col is not None and model is not None:
        out = out.withColumn("_model", F.element_at(model_lookup(model, model_keys, group_col, model_percent), _model_key(model_keys)))
        cols["percent_model_affinity"] = _affinity(taxa, group_col, total, F.col("_model"))
    return out.withColumns(cols).drop("taxa", "_model")


def community_metrics(counts: DataFrame, sample_cols: Sequence[str], taxon_col: str, count_col: str,
                      flags: Mapping[str, str] | None = None, tolerances: Mapping[str, str] | None = None,
                      group_col: str | None = None, model: DataFrame | None = None,
                      model_keys: Sequence[str] = (), model_percent: str = "percent",
                      dominance_k: int | None = 3, carry: Mapping[str, Column] | None = None) -> DataFrame:
    """All per-sample metrics from ONE de-duplicated (sample, taxon) table, in
    one aggregate (``sample_state``).  ``carry``: extra per-sample aggregates."""
    columns = list(dict.fromkeys([*(flags or {}).values(), *(tolerances or {}).values(), *([group_col] if model is not None else [])]))
    state = sample_state(counts, sample_cols, taxon_col, count_col, columns, carry)
    return state_metrics(state, flags, tolerances, group_col, model, model_keys, model_percent, dominance_k)


def segment_score(value, segments: Sequence[tuple], lo: float = scoring.SCORE_MIN,
                  hi: float = scoring.SCORE_MAX) -> Column:
    """Piecewise-linear 0-10 score (MET-10).  First segment whose upper limit
    is not below the value applies; beyond the last segment its line is
    extended; the score is clamped to [lo, hi]."""
    v = F.col(value) if isinstance(value, str) else value
    if not segments:
        return F.lit(None).cast("double")

    def line(seg):
        a, b, sa, sb = (float(x) for x in seg)
        return F.lit(sa) + (v - F.lit(a)) * F.lit((sb - sa) / (b - a))

    expr = None
    for seg in segments[:-1]:
        cond = v <= F.lit(float(seg[1]))
        expr = F.when(cond, line(seg)) if expr is None else expr.when(cond, line(seg))
    last = line(segments[-1])
    expr = last if expr is None else expr.otherwise(last)
    return F.when(v.isNotNull(), F.least(F.greatest(expr, F.lit(lo)), F.lit(hi)))


def metrics_of_method(df: DataFrame, method_col: str, metrics: Sequence[str],
                      defined: Mapping[int, Sequence[str]] | None = None) -> DataFrame:
    """Null where the row's method doesn't have the metric (MET-12); a method
    that ``defined`` doesn't name, or a null one, has none (MET-13)."""
    defined = defined if defined is not None else scoring.METHOD_METRICS
    m = F.col(method_col)
    cols = {}
    for metric in metrics:
        methods = [k for k, names in defined.items() if metric in names]
        has = F.coalesce(m.isin(methods), F.lit(False)) if methods else F.lit(False)
        cols[metric] = F.when(has, F.col(metric))
    return df.withColumns(cols)


def method_scores(df: DataFrame, method_col: str, metrics: Sequence[str],
                  segments: Mapping[tuple, Sequence[tuple]] | None = None,
                  profile_metrics: Mapping[int, Sequence[str]] | None = None,
                  profile_col: str = "bioassessment_profile", digits: int = 2) -> DataFrame:
    """Scores by collection method in one pass (MET-10..13).

    For each metric a CASE over the method picks that method's curve; a
    method without a curve gives a null score, so samples of unscored
    methods keep their row with null scores.  The profile is the mean of the
    method's scores, rounded.
    """
    segments = segments if segments is not None else scoring.SCORE_SEGMENTS
    profile_metrics = profile_metrics if profile_metrics is not None else scoring.PROFILE_METRICS
    m = F.col(method_col)
    cols = {}
    for metric in metrics:
        expr = None
        for (method, name), segs in segments.items():
            if name != metric:
                continue
            s = segment_score(metric, segs)
            expr = F.when(m == method, s) if expr is None else expr.when(m == method, s)
        cols[f"score_{metric}"] = expr if expr is not None else F.lit(None).cast("double")
    out = df.withColumns(cols)
    prof = None
    for method, names in profile_metrics.items():
        used = [n for n in names if n in metrics]
        if not used:
            continue
        mean = sum((F.col(f"score_{n}") for n in used), F.lit(0.0)) / F.lit(float(len(used)))
        e = round_half_up(mean, digits)
        prof = F.when(m == method, e) if prof is None else prof.when(m == method, e)
    return out.withColumn(f"score_{profile_col}", prof if prof is not None else F.lit(None).cast("double"))


def impact_category(value, default: str = "") -> Column:
    """Profile score -> impact category (DOM-20); first match wins."""
    v = F.col(value) if isinstance(value, str) else value
    expr = None
    for label, lo, hi in scoring.IMPACT_CATEGORIES:
        if lo is None:
            cond = v < F.lit(hi)
        elif hi is None:
            cond = v > F.lit(lo)
        else:
            cond = v.between(lo, hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def below_count_minimum(method, total, minimums: Mapping[str, int] | None = None) -> Column:
    """True when a sample's total is below its method's minimum (DOM-21)."""
    minimums = minimums if minimums is not None else scoring.COUNT_MINIMUM
    m = F.col(method) if isinstance(method, str) else method
    t = F.col(total) if isinstance(total, str) else total
    expr = None
    for name, minimum in minimums.items():
        cond = (m == F.lit(name)) & (t < F.lit(minimum))
        expr = cond if expr is None else expr | cond
    return F.coalesce(expr, F.lit(False))
