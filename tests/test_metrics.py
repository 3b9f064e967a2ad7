"""Community metrics against brute force on small fixtures."""

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stonefly.operators import metrics as M
from stonefly.operators.aggregates import newest_per_key, repeated_groups, top_k_per_group


def _fixture(n_samples=6, n_taxa=15, seed=7, hot=True):
    rnd = random.Random(seed)
    rows = []
    for s in range(n_samples):
        k = 400 if (hot and s == 0) else rnd.randint(3, 30)   # sample 0 is a hot key
        for _ in range(k):
            rows.append((f"s{s}", f"t{rnd.randint(0, n_taxa - 1)}", float(rnd.randint(1, 9))))
    return rows


def _brute(rows, groups, model):
    by = defaultdict(lambda: defaultdict(float))
    for s, t, n in rows:
        by[s][t] += n
    out = {}
    for s, taxa in by.items():
        N = sum(taxa.values())
        top3 = sum(sorted(taxa.values(), reverse=True)[:3])
        h = -sum((n / N) * math.log2(n / N) for n in taxa.values())
        g = defaultdict(float)
        for t, n in taxa.items():
            g[groups[t]] += n
        pma = sum(min(100 * v / N, model.get(k, 0.0)) for k, v in g.items())
        out[s] = dict(total=N, richness=len(taxa), dom3=100 * top3 / N, shannon=h, pma=pma)
    return out


def test_community_metrics_match_brute_force(spark):
    rows = _fixture()
    groups = {f"t{i}": f"g{i % 4}" for i in range(15)}
    model = {"g0": 40.0, "g1": 30.0, "g2": 20.0, "g3": 10.0}
    df = spark.createDataFrame(rows, "s string, t string, n double")
    counts = M.sum_duplicate_taxa(df, ["s"], "t", "n").withColumn(
        "grp", F.element_at(F.create_map(*[x for kv in groups.items() for x in map(F.lit, kv)]), F.col("t")))
    mdf = spark.createDataFrame(list(model.items()), "grp string, percent double")
    out = M.community_metrics(counts, ["s"], "t", "n", group_col="grp", model=mdf).collect()
    want = _brute(rows, groups, model)
    assert len(out) == len(want)
    for r in out:
        w = want[r["s"]]
        assert r["total_individuals"] == w["total"]
        assert r["richness"] == w["richness"]
        assert r["percent_dominance_3"] == pytest.approx(w["dom3"])
        assert r["shannon_diversity"] == pytest.approx(w["shannon"])
        assert r["percent_model_affinity"] == pytest.approx(w["pma"])


def test_duplicate_taxa_are_summed_before_richness(spark):
    # one taxon listed twice in a sample: 24 rows, 23 taxa
    rows = [("x", f"t{i}", 4.0) for i in range(23)] + [("x", "t0", 8.0)]
    df = spark.createDataFrame(rows, "s string, t string, n double")
    r = M.community_metrics(M.sum_duplicate_taxa(df, ["s"], "t", "n"), ["s"], "t", "n").first()
    assert r["richness"] == 23 and r["total_individuals"] == 100.0
    assert r["percent_dominance_3"] == pytest.approx(100 * (12 + 4 + 4) / 100)


def test_weighted_index_skips_taxa_without_tolerance(spark):
    df = spark.createDataFrame([("x", "a", 10.0, 2.0), ("x", "b", 30.0, None), ("x", "c", 10.0, 6.0)],
                               "s string, t string, n double, tol double")
    r = M.basic_metrics(df, ["s"], "t", "n", tolerances={"hbi": "tol"}, shannon=False).first()
    assert r["hbi"] == pytest.approx((10 * 2 + 10 * 6) / 20)


@pytest.mark.parametrize("strategy", ["auto", "limit", "salted"])
def test_top_k_skewed_group_matches_brute_force(spark, strategy):
    rows = _fixture(hot=True)
    df = spark.createDataFrame(rows, "s string, t string, n double")
    counts = M.sum_duplicate_taxa(df, ["s"], "t", "n")
    got = top_k_per_group(counts, ["s"], [F.col("n").desc(), F.col("t")], 3, salt_cols=["t"], buckets=4,
                          strategy=strategy)
    got = sorted((r["s"], r["rank"], r["t"]) for r in got.collect())
    by = defaultdict(lambda: defaultdict(float))
    for s, t, n in rows:
        by[s][t] += n
    want = []
    for s, taxa in by.items():
        ranked = sorted(taxa.items(), key=lambda kv: (-kv[1], kv[0]))[:3]
        want += [(s, i + 1, t) for i, (t, _) in enumerate(ranked)]
    assert got == sorted(want)


def test_newest_per_key_ties_by_last_order_column(spark):
    df = spark.createDataFrame([(1, 5, 10, "a"), (1, 5, 11, "b"), (1, 4, 12, "c"), (2, 1, 1, "d")],
                               "u int, ts int, id int, v string")
    got = sorted(tuple(r) for r in newest_per_key(df, ["u"], ["ts", "id"]).collect())
    assert got == [(1, 5, 11, "b"), (2, 1, 1, "d")]


def test_repeated_groups(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (3, "b"), (3, "b"), (3, "b")], "k int, g string")
    got = sorted(tuple(r) for r in repeated_groups(df, ["k", "g"], 2, count_col="n").collect())
    assert got == [(1, "a", 2), (1, "a", 2), (3, "b", 3), (3, "b", 3), (3, "b", 3)]
