"""End to end on published species histories (2018 and 2021 batches).

Reads the committed history files (unnamed row-number column, quoted CSV)
with the typed reader, sums duplicate taxa and checks richness and totals
against the published metric tables of the same batches.
"""

import os

from pyspark.sql import functions as F

from stonefly.operators import metrics as M
from stonefly.sources.io import read_csv_typed
from tests.test_golden_scores import GOLDEN

HERE = os.path.join(os.path.dirname(__file__), "fixtures")
TYPES = {"MSDH_LINKED_ID_VALIDATOR": "string", "MSDH_INDIVIDUAL_SPECIES_CNT": "int", "MSTR_MACRO_SPECIES_ID": "string"}


def test_richness_and_totals_match_published(spark):
    paths = [os.path.join(HERE, f) for f in ("species_history_2018.csv", "species_history_2021.csv")]
    rows = read_csv_typed(spark, paths, TYPES)
    assert rows.columns == list(TYPES)                       # row-number column dropped
    assert rows.count() == 244 + 142
    counts = M.sum_duplicate_taxa(rows.withColumn("n", F.col("MSDH_INDIVIDUAL_SPECIES_CNT").cast("double")),
                                  ["MSDH_LINKED_ID_VALIDATOR"], "MSTR_MACRO_SPECIES_ID", "n")
    got = {r.MSDH_LINKED_ID_VALIDATOR: r for r in
           M.community_metrics(counts, ["MSDH_LINKED_ID_VALIDATOR"], "MSTR_MACRO_SPECIES_ID", "n").collect()}
    assert set(got) == {g[0] for g in GOLDEN}
    for g in GOLDEN:
        assert got[g[0]].richness == g[1], g[0]
        assert got[g[0]].total_individuals == 100.0, g[0]
    raw = rows.filter(F.col("MSDH_LINKED_ID_VALIDATOR") == "13-PATS-1.8_20180705_1_1").count()
    assert raw == 24 and got["13-PATS-1.8_20180705_1_1"].richness == 23
