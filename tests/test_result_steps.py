"""``result_table_report`` writes the steps of its flow: same rows, and no step's files beside the next one's."""

import datetime as dt
import glob
import os
import random
import tempfile
import time

from stonefly.plans import domain_queries as Q
from stonefly.session import ScratchSteps, checkpoint_dir


def _tables(spark, folder, n_orders=300, n_lines=1500, odd=True):
    """Customers, orders, parts and lines; with ``odd``, null and repeated keys, null and equal names, two events on a sample."""
    rng = random.Random(11)
    maybe = lambda v: None if odd and rng.random() < 0.03 else v
    customer = [(k, f"Customer {k}", maybe(rng.randrange(3)), float(rng.choice([5, 7])) + 0.5, maybe(rng.choice(["AUTO", "BUILDING"]))) for k in range(12)]
    orders = [(maybe(k), maybe(rng.randrange(12)), rng.choice("FOP"), maybe(rng.uniform(1_000, 400_000)),
               maybe(dt.datetime(2023, 7, 1 + rng.randrange(2), rng.choice([0, 9]) if odd else 0)),
               rng.choice(["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"])) for k in range(n_orders)]
    part = [(k, maybe(rng.choice(["red fly", "Red fly", "blue  worm"])), maybe(rng.choice(["Brand#11", "Brand#12", "Brand#33"])),
             maybe(rng.choice(["STANDARD TIN", "ECONOMY BRASS", "PROMO STEEL"])), maybe(rng.randrange(1, 51)), maybe(rng.uniform(900, 2000))) for k in range(40)]
    if odd:
        customer.append(customer[3])
        orders += [orders[5], (7, 2, "F", 9_000.0, dt.datetime(2023, 7, 2), "1-URGENT"), (7, 2, "F", 9_000.0, dt.datetime(2023, 7, 2, 9), "1-URGENT")]
        part += [part[4], (5, "other name", "Brand#12", "PROMO STEEL", 9, 1000.0), (6, "GREEN fly", None, "STANDARD TIN", 3, 950.0),
                 (6, "green_fly", "Brand#11", "ECONOMY BRASS", 44, None), (8, None, "Brand#11", "STANDARD TIN", 2, 950.0), (None, "red fly", None, None, 1, 1.0)]
    line = [(maybe(rng.randrange(n_orders + 5)), maybe(rng.randrange(42)), k % 7, maybe(float(rng.randrange(0, 50)))) for k in range(n_lines)]
    for name, rows, schema in (
            ("customer", customer, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
            ("orders", orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
            ("part", part, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
            ("lineitem", line, "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double")):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def _sorted(df):
    return sorted(str(tuple(round(v, 9) if isinstance(v, float) else v for v in r)) for r in df.collect())


def test_written_steps_give_the_rows_of_the_flow(spark, tmp_path):
    d = _tables(spark, tmp_path / "t")
    steps = ScratchSteps(spark, "test-steps")
    got = Q.metrics_long(spark, d, steps)
    whole = Q.metrics_long(spark, d)
    assert got.columns == whole.columns
    rows = _sorted(whole)
    assert len(rows) > 100 and _sorted(got) == rows
    # only the table that is read is left, and nothing after the run
    assert os.listdir(steps.folder) == ["wide"]
    steps.drop()
    assert not os.path.exists(steps.folder)


def _shuffled(spark):
    base = os.environ.get("SPARK_LOCAL_DIRS") or spark.conf.get("spark.local.dir", tempfile.gettempdir())
    return {x for d in base.split(",") for x in glob.glob(f"{d}/**/blockmgr-*/*/shuffle_*.data", recursive=True)}


def test_report_leaves_no_files_of_its_steps(spark, tmp_path, monkeypatch):
    """Before: the shuffles of lines, orders, counts and arrays lay on the disks together, and until the driver's next collection of garbage."""
    d = _tables(spark, tmp_path / "t", n_orders=4_000, n_lines=30_000, odd=False)
    before, seen, write = _shuffled(spark), [], ScratchSteps.write

    def left():
        until = time.time() + 5
        while (files := {x for x in _shuffled(spark) - before if os.path.exists(x) and os.path.getsize(x) > 15_000}) and time.time() < until:
            time.sleep(0.2)
        return files

    def written(self, df, name):
        out = write(self, df, name)
        seen.append((name, sorted(os.listdir(self.folder)), left()))
        return out

    monkeypatch.setattr(ScratchSteps, "write", written)
    report = Q.result_table_report(spark, d)
    assert sum(os.path.getsize(x) for x in _shuffled(spark) - before) < 100_000  # before: 500,000
    steps = ["orders", "lines", "rows", "counts", "sample_taxa", "wide", "RESULT"]
    assert [name for name, _, _ in seen if name in steps] == steps
    assert not any(files for _, _, files in seen)
    at = {name: tables for name, tables, _ in seen}
    assert not {"headers", "lines"} & set(at["counts"]) and not {"rows", "lines"} & set(at["sample_taxa"]) and "counts" not in at["wide"]
    assert not glob.glob(f"{checkpoint_dir(spark)}/result-table-report-*")
    assert report.count() == 144
