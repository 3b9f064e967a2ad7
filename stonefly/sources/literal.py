"""Configuration tables as in-plan literals.

``createDataFrame`` on a Python list yields a plan node without size
statistics, so the optimizer cannot tell that a 5-row lookup is small and
shuffles the large side to join it.  Building the rows as a literal array
inlined over a one-row range gives Catalyst an exact, tiny estimate: such
tables are broadcast automatically and never shuffle the data they join.
Only for fixed configuration (methods, thresholds, rule dictionaries).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_table(spark: SparkSession, rows: Sequence[Sequence], schema: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows as a literal table; ``schema`` is [(name, spark type), ...]."""
    if not rows:
        return spark.range(1).select(*[F.lit(None).cast(t).alias(n) for n, t in schema]).limit(0)
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, (n, t) in zip(r, schema)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
