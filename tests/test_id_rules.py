"""Composed id rules against the rules applied one after the other."""

import random
import re

from stonefly.config import site_events
from stonefly.functions.id_rules import Stretch, apply_in_order, compile_rules, correct_ids
from stonefly.functions.text import whole_id_rules


def in_order(value, rules):
    """Each rule as the regex that the ordered path uses, in Python."""
    for r in rules:
        pattern, new = (r[0], r[1]) if len(r) > 2 else whole_id_rules([r])[0][:2]
        value = re.sub(pattern, new.replace("\\", "\\\\"), value)
    return value


CHAIN = [("a", "b"), ("b", "c"), ("c_20200101", "d_20200202"), ("d", "e"), ("c", "a"), ("x.1", "y.1"), ("y_20200101", "x_20200101"), ("e_20200202", "b_20200202")]


def values(rng, rules, n=400):
    sites = [re.sub(r"_\d{8}.*", "", x) for r in rules for x in r[:2]]
    tails = ["", "_20200101", "_20200202", "_20200101T1000", "_2020", "_20210803_20210804", "_20200101_20200202T9"]
    named = [x for r in rules for x in r[:2]]
    return [rng.choice(sites) + rng.choice(tails) for _ in range(n)] + named + [x + t for x in named[:40] for t in tails] + ["", "zz", "a\nb", "a_20200101\n", "xa", "a b"]


def test_order_is_kept(spark):
    rng = random.Random(0)
    for rules in (CHAIN, CHAIN[::-1], CHAIN[:3] + [("^b", "c", False)] + CHAIN[3:]):
        vs = values(rng, [r for r in rules if len(r) == 2])
        df = spark.createDataFrame([(i, v, "s") for i, v in enumerate(vs)] + [(-1, None, "s")], "i int, v string, _head2 string")
        got = {r.i: r.w for r in correct_ids(df, "v", rules, out="w").collect()}
        want = {i: in_order_keep(v, rules) for i, v in enumerate(vs)} | {-1: None}
        assert got == want


def in_order_keep(value, rules):
    for r in rules:
        value = re.sub(r[0], r[1], value) if len(r) > 2 else in_order(value, [r])
    return value


def test_all_site_rules_equal_the_ordered_ones(spark):
    vs = values(random.Random(1), site_events.SITE)
    df = spark.createDataFrame(list(enumerate(vs)), "i int, v string")
    got = {r.i: r.v for r in correct_ids(df, "v", site_events.SITE).collect()}
    assert got == {i: in_order(v, site_events.SITE) for i, v in enumerate(vs)}
    assert sum(got[i] != v for i, v in enumerate(vs)) > 100


def test_one_stretch_is_two_small_maps():
    (only,) = compile_rules(site_events.SITE)
    assert isinstance(only, Stretch) and len(only.rules) == len(site_events.SITE)
    assert len(only.sites) + len(only.whole) < 3 * len(site_events.SITE)
    parts = compile_rules([("a", "b"), ("^x", "y", False), ("b", "c")])
    assert [type(p) for p in parts] == [Stretch, tuple, Stretch]
    assert apply_in_order("a_20200101", [("a", "b"), ("b", "c")]) == "c_20200101"
