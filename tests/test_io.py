"""Sources, sinks, history append and streaming ingestion."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from stonefly.sources import io as IO
from stonefly.streaming.ingest import ingest_species_history

CSV = """"","WAA.ID","site","date","n","note"
"1","W1","13-PATS-0.5","07/05/2018","6","N/A"
"2","W2","-9999","7/5/2018","x",""
"""


def _write(d, name, text):
    p = os.path.join(d, name)
    with open(p, "w") as f:
        f.write(text)
    return p


def test_typed_csv_na_tokens_and_missing_columns(spark):
    d = tempfile.mkdtemp(prefix="stonefly-io-")
    p = _write(d, "lab.csv", CSV)
    df = IO.read_csv_typed(spark, p, {"site": "string", "date": "date:%m/%d/%Y", "n": "int", "absent": "double"})
    rows = df.orderBy("n").collect()
    assert df.columns == ["site", "date", "n", "absent"]
    assert dict(df.dtypes)["absent"] == "double"
    assert [(r.site, str(r.date), r.n) for r in rows] == [(None, "2018-07-05", None), ("13-PATS-0.5", "2018-07-05", 6)]


def test_read_many_with_source_index(spark):
    d = tempfile.mkdtemp(prefix="stonefly-io-")
    _write(d, "a.csv", "k,v\n1,x\n")
    _write(d, "b.csv", "k,v\n2,y\n3,z\n")
    got = sorted(tuple(r) for r in IO.read_many_csv(spark, os.path.join(d, "*.csv")).select("k", "column_label").collect())
    assert got == [("1", 1), ("2", 2), ("3", 2)]


def test_dated_sink_and_history_append_is_idempotent(spark):
    d = tempfile.mkdtemp(prefix="stonefly-io-")
    df = spark.createDataFrame([("a", None), ("b", 2.0)], "k string, v double")
    path = IO.write_dated_csv(df, d, "S_MACRO_SPECIES_DATA_HISTORY.csv", "20240101")
    back = spark.read.option("header", True).csv(path)
    assert sorted(tuple(r) for r in back.collect()) == [("a", None), ("b", "2.0")]
    h = os.path.join(d, "history")
    IO.append_history(df, h, "20240101")
    IO.append_history(df, h, "20240102")
    IO.append_history(df, h, "20240101")           # re-run replaces, no duplicates
    assert IO.read_history(spark, h).count() == 4
    assert IO.read_history(spark, h, ["20240102"]).count() == 2
    assert IO.exists(df, F.col("k") == "b") and not IO.exists(df, F.col("k") == "zz")
    staged = IO.stage_in_checkpoint_dir(df, "staged_test")
    assert staged.count() == 2


def test_stream_ingest_processes_each_file_once(spark):
    d = tempfile.mkdtemp(prefix="stonefly-stream-")
    landing, hist, ck = (os.path.join(d, x) for x in ("landing", "history", "ckpt"))
    os.makedirs(landing)
    header = ("WAA_ID,MSSIH_EVENT_SMAS_HISTORY_ID,MSSIH_EVENT_SMAS_SAMPLE_DATE,MSSIH_REPLICATE,"
              "MSSIH_BIOSAMPLE_COLLECT_METHOD,MSSIH_TAXONOMIST,MSDH_GENSPECIES,MSDH_INDIVIDUAL_SPECIES_CNT,"
              "MSSIH_TOTAL_INDIV_CNT_IND,MSSIH_TOTAL_INDIV_CNT_NOTE,X_Grids,Client_Project_Name,group,event_id\n")
    _write(landing, "f1.csv", header + "W1,13-PATS-0.5,07/05/2018,1,Kick: Standard,WAA,Baetis sp.,4,100,,,P,,e1\n")
    ingest_species_history(spark, landing, hist, ck)
    _write(landing, "f2.csv", header + "W2,13-PATS-1.3,07/05/2018,2,Kick: Standard,WAA,Baetis sp.,5,100,,,P,,e2\n")
    ingest_species_history(spark, landing, hist, ck)
    ingest_species_history(spark, landing, hist, ck)   # nothing new
    rows = spark.read.parquet(hist).collect()
    assert sorted(r.MSDH_LINKED_ID_VALIDATOR for r in rows) == ["13-PATS-0.5_20180705_1_1", "13-PATS-1.3_20180705_1_2"]


def test_files_bind_by_name_and_are_trimmed(spark, tmp_path):
    (tmp_path / "a.csv").write_text("site,taxon,n\ns1, baetis ,3\n")
    (tmp_path / "b.csv").write_text("taxon,site,n,note\nperla,s2,4,x\n")
    (tmp_path / "c.csv").write_text("site,taxon,n\ns3,capnia,5\n")
    got = sorted(tuple(r[c] for c in ("site", "taxon", "n", "note", "column_label"))
                 for r in IO.read_many_csv(spark, str(tmp_path / "*.csv")).collect())
    assert got == [("s1", "baetis", "3", None, 1), ("s2", "perla", "4", "x", 2), ("s3", "capnia", "5", None, 3)]


def test_typed_fields_are_trimmed(spark, tmp_path):
    (tmp_path / "t.csv").write_text("m,n\nKick: Standard , 7 \n")
    row = IO.read_csv_typed(spark, str(tmp_path / "t.csv"), {"m": "string", "n": "int"}).first()
    assert (row.m, row.n) == ("Kick: Standard", 7)


def test_many_files_of_several_layouts_are_one_scan(spark, tmp_path):
    (tmp_path / "a.b").mkdir()
    layouts = [("site,n", "s{i},{i}"), ("n,site,note", '{i},s{i},"x, {i}"'), (" site , extra ", "s{i},e")]
    for i in range(240):
        head, row = layouts[i % 3]
        (tmp_path / "a.b" / f"f {i:04d}.csv").write_text(f"{head}\n" + row.format(i=i) + "\n" + ("" if i % 2 else row.format(i=i) + "\n"))
    (tmp_path / "a.b" / "f 9999.csv").write_text("site,only_header\n")
    df = IO.read_many_csv(spark, str(tmp_path / "a.b" / "*.csv"))
    assert df.columns == ["site", "n", "note", "extra", "only_header", "column_label"]
    got = sorted(map(tuple, df.collect()))
    want = []
    for i in range(240):
        row = {0: (f"s{i}", str(i), None, None, None), 1: (f"s{i}", str(i), f"x, {i}", None, None), 2: (f"s{i}", None, None, "e", None)}[i % 3]
        want += [(*row, i + 1)] * (1 if i % 2 else 2)
    assert got == sorted(want)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "f 0007.csv" not in plan and plan.count("Relation") <= 2


def test_staged_tables_are_keyed_by_run_and_plan(spark):
    a, b = spark.range(3), spark.range(4)
    one, two, other = (IO.stage_in_checkpoint_dir(x, "same_name", run=r) for x, r in ((a, "r1"), (b, "r1"), (a, "r2")))
    assert (one.count(), two.count(), other.count()) == (3, 4, 3)
    assert len({x.inputFiles()[0].rsplit("/", 1)[0] for x in (one, two, other)}) == 3
    again = IO.stage_in_checkpoint_dir(a, "same_name", run="r1")
    assert again.inputFiles()[0].rsplit("/", 1)[0] == one.inputFiles()[0].rsplit("/", 1)[0] or again.count() == 3
