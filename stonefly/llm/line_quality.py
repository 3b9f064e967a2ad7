r"""Quality rules by cross-document line frequency.

Each line is normalised (words joined by one blank, A-Z lowered) and hashed. For
each host the distinct documents that hold a line are counted; equal texts of a host
count once, so a document isn't its own boilerplate for having copies. Lines in more than
``max_percent`` per cent of their host's distinct documents, and in more than ``least_docs`` of them,
are removed, and a document is depleted when less than ``min_share`` of its words remain. With ``near_copies`` the near-equal documents
(a component of ``jaccard_tree``) among those that hold such lines count once, too, so a
group of them isn't its own boilerplate; the pipeline does that, the query op7 doesn't.

Before that, the base rules: a document fails with fewer than ``min_words`` words, or
when more than ``max_repeat`` percent of its words lie in three-word windows found
twice or more. Words are runs of ``[^\x20\x09-\x0D]``.

Null text has no words and fails. A null host is a host of its own. Every input row
gives one row, repeated rows too. An empty table gives an empty result. Only the
columns named are read, so further ones, whatever their names, don't matter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stonefly.llm.common import release_memory, run_dir, slices, write_table
from stonefly.llm.jaccard_tree import similar_documents

SYMBOLS = "#*$%&|<>"
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def line_key(line: bytes) -> bytes:
    """The normalised line: empty if it has no word."""
    return b" ".join(line.lower().split())


def text_stats(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    words = text.encode().split()
    chars = len(text) - sum(map(text.count, " \t\n\v\f\r"))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.encode().split()] if "\n" in text else []
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeat = 0
    if len(set(windows)) < len(windows):
        often = Counter(windows)
        found = np.zeros(len(words), bool)
        for i, x in enumerate(windows):
            if often[x] > 1:
                found[i : i + 3] = True
        repeat = int(found.sum())
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeat


def line_hashes(text: str) -> dict[int, int]:
    """The words that each distinct normalised line has in the text, by the line's hash."""
    found: dict[int, int] = {}
    for line in text.encode().split(b"\n"):
        if key := line_key(line):
            h = xxhash.xxh3_64_intdigest(key) - (1 << 63)
            found[h] = found.get(h, 0) + key.count(b" ") + 1
    return found


def host_key(host_col: str) -> Column:
    """The host; null is one of its own."""
    return F.coalesce(F.col(host_col).cast("string"), F.lit("\0"))


def content_key(text_col: str) -> Column:
    """A 128-bit hash of the text; null text is empty."""
    return F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit(""))))


def line_frequency_rules(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", max_percent: int = 10, least_docs: int = 5, min_share: float = 0.5, min_words: int = 50, max_repeat: int = 50, near_copies: bool = False) -> DataFrame:
    """One row a document: the base statistics, base_failed, n_removed_words and kept."""
    folder = run_dir(spark, "line-quality")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), host_key(host_col).alias("host"), content_key(text_col).alias("content"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text")):
            texts = [x or "" for x in batch.column("text").to_pylist()]
            stats = list(zip(*map(text_stats, texts), strict=True))
            lines = list(map(line_hashes, texts))
            hashes = pa.array([list(x) for x in lines], pa.list_(pa.int64()))
            words = pa.array([list(x.values()) for x in lines], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("host"), batch.column("content"), *(pa.array(x, pa.int64()) for x in stats), hashes, words], names=["doc_id", "host", "content", *(x.split()[0] for x in STATS.split(", ")), "lines", "words"])
        release_memory()

    kind = rows.schema["doc_id"].dataType.simpleString()
    stats = write_table(rows.mapInArrow(read, f"doc_id {kind}, host string, content binary, {STATS}, lines array<long>, words array<long>"), f"{folder}/stats")
    texts = stats.select("host", "content", "lines", "words").dropDuplicates(["host", "content"])
    lines = texts.select("host", "content", F.explode(F.arrays_zip("lines", "words")).alias("x")).select("host", "content", F.col("x.lines").alias("line"), F.col("x.words").alias("n"))
    # one row a host; all three tables are written: Spark knows their size, broadcasts a small one and splits a common key of the other side
    hosts = write_table(texts.groupBy("host").agg(F.count("*").alias("all_docs")), f"{folder}/hosts")
    too_many = (F.col("docs") > least_docs) & (100 * F.col("docs") > max_percent * F.col("all_docs"))
    held_often = lambda counts: counts.filter(F.col("docs") > least_docs).join(hosts, "host").filter(too_many).select("host", "line")
    often = write_table(held_often(lines.groupBy("host", "line").agg(F.count("*").alias("docs"))), f"{folder}/often")
    if near_copies and not often.isEmpty():
        held = write_table(lines.join(often, ["host", "line"], "left_semi").select("host", "content", "line"), f"{folder}/held")
        holders = write_table(held.select("content").distinct(), f"{folder}/holders")
        holders = write_table(rows.select("content", "text").join(holders, "content", "left_semi").dropDuplicates(["content"]), f"{folder}/holder-texts")
        groups = similar_documents(spark, holders, id_col="content").select(F.col("doc_id").alias("content"), F.col("component_id").alias("of"))
        counts = held.join(groups, "content").select("host", "line", "of").distinct().groupBy("host", "line").agg(F.count("*").alias("docs"))
        often = write_table(held_often(counts), f"{folder}/often-apart")
    lost = write_table(lines.join(often, ["host", "line"], "left_semi").groupBy("host", "content").agg(F.sum("n").alias("lost")), f"{folder}/lost")
    out = stats.drop("lines", "words").join(lost, ["host", "content"], "left")
    removed = F.coalesce("lost", F.lit(0))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    whole = F.col("n_words") - removed >= min_share * F.col("n_words")
    return out.select("doc_id", *(x.split()[0] for x in STATS.split(", ")), failed.alias("base_failed"), (~failed & whole).alias("kept"), removed.alias("n_removed_words"), "content", "host")


#: The query's rows in DuckDB SQL (doc_id is unique there).
SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, chr(0)) AS host FROM documents),
w AS (SELECT doc_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, t FROM d),
tri AS (SELECT doc_id, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri) WHERE c > 1),
repw AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
l AS (SELECT doc_id, host, unnest(string_split(t, chr(10))) AS line FROM d),
lw AS (SELECT doc_id, host, line, list_aggregate(list_transform(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')), 'string_agg', ' ') AS k, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM l),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lw WHERE n > 0 GROUP BY doc_id),
k AS (SELECT lw.doc_id, lw.host, k, sum(n) AS n, any_value(t) AS t FROM lw JOIN d USING (doc_id) WHERE n > 0 GROUP BY ALL),
hosts AS (SELECT host, count(DISTINCT t) AS n FROM d GROUP BY host),
often AS (SELECT host, k FROM (SELECT host, k, count(DISTINCT t) AS c FROM k GROUP BY host, k) JOIN hosts USING (host) WHERE c > 5 AND 100 * c > 10 * n),
lost AS (SELECT doc_id, sum(n) AS n FROM k JOIN often USING (host, k) GROUP BY doc_id),
s AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(repw.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(lost.n, 0) AS BIGINT) AS n_removed_words
  FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN repw USING (doc_id) LEFT JOIN lost USING (doc_id)),
b AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  (NOT base_failed AND n_words - n_removed_words >= 0.5 * n_words) AS kept, n_removed_words FROM b
"""
