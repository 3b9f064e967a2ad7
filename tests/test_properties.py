"""Property tests: partitions, idempotence, randomized parity."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stonefly.config import corrections as CFG
from stonefly.functions import text as X
from stonefly.operators import setops as SO

SF = "/root/testdata/sf0.001"


def test_semi_and_anti_partition_the_input(spark):
    from stonefly.sources.tables import table
    c = table(spark, SF, "customer").select("c_custkey")
    parent = table(spark, SF, "orders").filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("c_custkey"))
    semi = c.join(parent, "c_custkey", "left_semi")
    anti = c.join(parent, "c_custkey", "left_anti")
    assert semi.count() + anti.count() == c.count()
    assert semi.intersect(anti).count() == 0


def test_taxon_corrections_idempotent(spark):
    names = ["orthocladius_(euorthoclad.)_rivicola", "drunella_complexrnutella", "paraleptophlebia", "lipiniella",
             "glossiphonia_complexmplanata", "baetis"]
    df = spark.createDataFrame([(n,) for n in names], "s string")
    once = df.select(X.ordered_replace("s", CFG.TAXON_CORRECTIONS).alias("s"))
    twice = once.select(X.ordered_replace("s", CFG.TAXON_CORRECTIONS).alias("s"))
    assert [r.s for r in once.collect()] == [r.s for r in twice.collect()]


def _py_split(s, sep, n):
    if s is None:
        return [None] * n
    parts = s.split(sep, n - 1)
    return parts + [""] * (n - len(parts))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab-.9_", max_size=12)), min_size=1, max_size=8))
def test_split_fixed_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [list(r) for r in df.select(*X.split_fixed("s", "-", 3)).collect()]
    assert got == [_py_split(v, "-", 3) for v in values]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=10),
       st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=10))
def test_value_except_matches_sets(spark, a, b):
    da = spark.createDataFrame([(v,) for v in a], "v int")
    db = spark.createDataFrame([(v,) for v in b], "v int")
    got = sorted((r.value for r in SO.value_except(da, db, "v").collect()), key=lambda x: (x is None, x or 0))
    want = sorted(set(a) - set(b), key=lambda x: (x is None, x or 0))
    assert got == want


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="ab_ .?/", max_size=10), min_size=1, max_size=6))
def test_ordered_replace_matches_python(spark, values):
    rules = CFG.TAXON_CLEANING
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(X.ordered_replace("s", rules)).collect()]
    want = []
    for v in values:
        for pat, rep, literal in rules:
            v = v.replace(pat, rep) if literal else re.sub(pat, rep, v)
        want.append(v)
    assert got == want


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["s1", "s2", "s3"]), st.sampled_from([f"t{i}" for i in range(9)]),
                          st.integers(1, 20)), min_size=1, max_size=60))
def test_community_metrics_random(spark, rows):
    import math
    from collections import defaultdict

    from stonefly.operators import metrics as M
    df = spark.createDataFrame([(s, t, float(n)) for s, t, n in rows], "s string, t string, n double")
    got = {r.s: r for r in M.community_metrics(M.sum_duplicate_taxa(df, ["s"], "t", "n"), ["s"], "t", "n").collect()}
    by = defaultdict(lambda: defaultdict(float))
    for s, t, n in rows:
        by[s][t] += n
    assert set(got) == set(by)
    for s, taxa in by.items():
        total = sum(taxa.values())
        assert got[s].richness == len(taxa) and got[s].total_individuals == total
        top3 = sum(sorted(taxa.values(), reverse=True)[:3])
        assert abs(got[s].percent_dominance_3 - 100 * top3 / total) < 1e-9
        h = -sum((v / total) * math.log2(v / total) for v in taxa.values())
        assert abs(got[s].shannon_diversity - h) < 1e-9
