"""Ordered id corrections as one closed map (DOM-15, DOM-16).

A list of literal corrections (old id, new id) is applied in order, each to the
result of those before it.  An old id is a site, or a site with an event's
date; it must be the whole value, or all but a date tail ``_yyyyMMdd...`` that
is kept.  ``compile_rules`` follows every id that some rule names through the
whole list once, on the driver (the list is configuration), so that applying
the rules is one lookup a row however many there are.  Rules given as
regexes can't be followed; they split the list into stretches and stay where
they are.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stonefly.functions.text import ordered_replace
from stonefly.sources.literal import literal_table

#: The tail that a literal rule keeps.
TAIL = re.compile(r"_\d{8}")


def apply_in_order(value: str, rules: Sequence[tuple[str, str]]) -> str:
    """One value through the literal rules, one after the other: what a compiled stretch must equal."""
    for old, new in rules:
        if value == old or (value.startswith(old) and TAIL.match(value[len(old):]) and "\n" not in value[len(old):]):
            value = new + value[len(old):]
    return value


def head_and_tail(value: str) -> tuple[str, str]:
    """The value up to its first date, and the rest."""
    found = TAIL.search(value)
    return (value[: found.start()], value[found.start():]) if found else (value, "")


@dataclass(frozen=True)
class Stretch:
    """Literal rules of a stretch: ``sites`` for values whose tail no rule names,
    ``whole`` for site and tail together where that gives something else."""

    rules: tuple[tuple[str, str], ...]
    sites: dict[str, str]
    whole: dict[str, str]


def compile_rules(rules: Sequence) -> list[Stretch | tuple]:
    """Stretches of literal rules as closed maps, and the regex rules
    ``(pattern, replacement, False)`` between them, in order."""
    out, stretch = [], []

    def close():
        if not stretch:
            return
        sites = list(dict.fromkeys(head_and_tail(x)[0] for rule in stretch for x in rule))
        tails = list(dict.fromkeys(t for rule in stretch for x in rule if (t := head_and_tail(x)[1])))
        site_map = {s: n for s in sites if (n := apply_in_order(s + "_00000000", stretch)[: -len("_00000000")]) != s}
        whole = {}
        for s in sites:
            for t in ["", *tails]:
                n = apply_in_order(s + t, stretch)
                if n != site_map.get(s, s) + t:
                    whole[s + t] = n
        out.append(Stretch(tuple(stretch), site_map, whole))
        stretch.clear()

    for rule in rules:
        if len(rule) > 2:
            close()
            out.append(tuple(rule))
        else:
            stretch.append((rule[0], rule[1]))
    close()
    return out


def in_order(value: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The literal rules one after the other, as a fold over the list of them."""
    def step(v, rule):
        rest = v.substr(F.char_length(rule["old"]) + 1, F.char_length(v))
        return F.when(v.startswith(rule["old"]) & rest.rlike(r"^(_\d{8}.*)?$"), F.concat(rule["new"], rest)).otherwise(v)

    return F.aggregate(F.array(*[F.struct(F.lit(a).alias("old"), F.lit(b).alias("new")) for a, b in rules]), value, step)


def correct_ids(df: DataFrame, col: str, rules: Sequence, out: str | None = None) -> DataFrame:
    """``col`` (or ``out``) corrected by the rules: (old, new) literal, or
    (pattern, replacement, False) regex; equal to applying them in order.

    A stretch is a join with its literal map (configuration, so Spark
    broadcasts it).  A value with two dates in it, which a map by its first
    date doesn't cover, runs through the rules in order.
    """
    spark, name = df.sparkSession, out or col
    df = df.withColumn(name, F.col(col))
    for part in compile_rules(rules):
        if isinstance(part, tuple):
            df = df.withColumn(name, ordered_replace(name, [part]))
            continue
        entries = [(0, k, v) for k, v in part.whole.items()] + [(1, k, v) for k, v in part.sites.items()]
        if not entries:
            continue
        table = literal_table(spark, entries, [("_kind", "int"), ("_old", "string"), ("_new", "string")])
        whole = table.filter("_kind = 0").select(F.col("_old").alias("_whole"), F.col("_new").alias("_by_whole"))
        sites = table.filter("_kind = 1").select(F.col("_old").alias("_site"), F.col("_new").alias("_by_site"))
        head = F.regexp_replace(name, r"_\d{8}[\s\S]*$", "")
        split = F.regexp_extract(name, r"^([\s\S]*?)_\d{8}", 1)
        site = F.when(F.col(name).rlike(r"_\d{8}"), split).otherwise(head)
        j = df.withColumn("_head", site).join(whole, F.col(name) == F.col("_whole"), "left").join(sites, F.col("_head") == F.col("_site"), "left")
        tail = F.col(name).substr(F.char_length("_head") + 1, F.char_length(name))
        mapped = F.coalesce("_by_whole", F.concat(F.col("_by_site"), tail), F.col(name))
        odd = F.col(name).rlike(r"_\d{8}[\s\S]*_\d{8}") | F.col(name).contains("\n")
        exact = F.when(odd, in_order(F.col(name), part.rules)).otherwise(mapped)
        df = j.withColumn(name, exact).drop("_head", "_whole", "_by_whole", "_site", "_by_site")
    return df
