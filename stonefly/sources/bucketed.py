"""Bucketed tables: written once by their key, joined on it without a shuffle (IO-13, DOM-11).

The species history and the sample table share the sample key, taxon rows and
the master table share the taxon.  Written in as many buckets by that key,
sorted within, each pair joins bucket by bucket: the large side is neither
exchanged nor sorted again.  The bucket numbers are in the file names and the layout in
``_layout.json`` beside them, so another session registers the same folder.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Write ``df`` under ``path`` in ``buckets`` buckets by ``keys`` and read it back.

    One exchange now, by the keys and into the buckets, so that each bucket is
    one file.  Null keys are a bucket's rows like any other.
    """
    spark = df.sparkSession
    layout = {"schema": df.schema.jsonValue(), "keys": list(keys), "buckets": buckets}
    name = f"bucketed_{uuid.uuid4().hex}"
    (df.repartition(buckets, *[F.col(k) for k in keys]).write.mode("overwrite").format("parquet")
     .bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name))
    spark.createDataFrame([(json.dumps(layout),)], "value string").coalesce(1).write.mode("overwrite").text(os.path.join(path, "_layout.json"))
    return spark.table(name)


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A folder of ``write_bucketed`` as a table that keeps its layout."""
    layout = json.loads(spark.read.text(os.path.join(path, "_layout.json")).first()["value"])
    quoted = lambda name: "`" + name.replace("`", "``") + "`"
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in T.StructType.fromJson(layout["schema"]))
    keys = ", ".join(map(quoted, layout["keys"]))
    name = f"bucketed_{uuid.uuid4().hex}"
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
              f"INTO {layout['buckets']} BUCKETS LOCATION '{location}'")
    return spark.table(name)
