r"""Removal of near-duplicate paragraphs by MinHash banding.

Paragraphs are the ``\n``-split lines of a text. One of ``min_words`` words or more takes part
with the set of its five-word shingles (words and letters as in ``jaccard_tree``), one of fewer
than five words with the whole sequence as its one shingle; equal sets are one class. The query
op6_paragraph_minhash sets ``min_words`` to 1, so every paragraph with a word takes part. A class's MinHash signature is cut into BANDS bands of ROWS hashes: two sets
at similarity 0.8 share a band with a probability of 1 - (1 - 0.8 ** 3) ** 12 = 0.9998.
Classes that share a band are compared exactly, on their whole sets, and clustered by
connected components. Of each component the first paragraph (smallest doc_id, then place)
stays and all others go.

Comparison is in two passes. First each band's least class is compared with the others, which
settles groups of copies with as many pairs as they have members. Then the classes of a band that
lie in different components are compared, where their signatures agree in AGREE hashes
or more (which 0.8-similar sets miss with a probability below 1e-4), each pair in the entry of its first
common band. The entries first name their members with such pairs; these come with their whole sets,
and each entry verifies its pairs in place and sends a forest of the links, so no group sends its pairs.

With ``least_run`` (the query sets it to 20) a repeated line that stands alone in a longer text is no
passage: repeated paragraphs go where so many words of them follow each other, or where they make up half of
their text. Then passages that hang on no line breaks: the texts are cut before words that the content chooses
(the least hash of three words within REACH words), short lines with what follows, so that every word is in a
segment and equal passages have equal segments wherever they stand. Of the segments that touch no removed line,
all but the first of equal ones go where ``least_run`` words of them follow each other. n_removed counts
paragraphs that go and such runs.

Null text has no paragraphs. Null ids come before all others. Rows that repeat an id are told
apart by a 64-bit hash of the text; rows repeated whole count as one. An empty table gives an empty
result. Columns other than the two named are neither read nor met.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stonefly.llm.common import mix64, release_memory, run_dir, shuffle_partitions, slices, text_buffers, write_table
from stonefly.llm.components import connected
from stonefly.llm.jaccard_tree import MULTIPLIER, SLICE, sets_between, shingle_sets, verified, whole_sets, word_hashes, word_places
from stonefly.llm.suffix_dedup import keyed, row_key

BANDS, ROWS, AGREE = 12, 3, 19
#: Segments begin where three words have the least hash among those that begin up to so many words before or after.
REACH = 8
SEEDS = (mix64(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * MULTIPLIER) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash signature of each (not empty) set: one row of BANDS * ROWS hashes."""
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0] + [len(x) for x in sets[:-1]])
    out = np.empty((len(sets), len(SEEDS)), np.uint32)
    for k, seed in enumerate(SEEDS):
        out[:, k] = np.minimum.reduceat(flat * seed, starts)
    return out


def band_keys(made: np.ndarray) -> np.ndarray:
    """A hash of each band of each signature, and of the band's number."""
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), (len(made), BANDS))
    for k in range(ROWS):
        h = mix64(h * MULTIPLIER + made[:, k::ROWS])
    return h.view(np.int64)


def line_starts(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all ``\\n``-split lines of all texts: the text, the place in it, and the bytes' bounds (one more)."""
    breaks = np.flatnonzero(raw == 10)
    text = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, side="right") - 1])
    start = np.concatenate([offsets[:-1], breaks + 1])
    order = np.lexsort((start, text))
    text, start = text[order], start[order]
    return text, np.arange(len(text)) - np.searchsorted(text, text), np.append(start, len(raw))


def paragraph_rows(docs: DataFrame, words: int, min_words: int) -> DataFrame:
    """Of each paragraph that takes part: document (d, x), place i, number o among those that do, words n (of the text: total), class, and the class's bands once a batch."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text", 2 << 20)):
            raw, offsets = text_buffers(batch.column("text"))
            text, place, bounds = line_starts(raw, offsets)
            sets = sets_between(raw, bounds, words, min_words)
            some = np.flatnonzero([len(x) > 0 for x in sets])
            if not len(some):
                continue
            nodes = [xxhash.xxh3_64_intdigest(sets[k].tobytes()) - (1 << 63) for k in some]
            first = {}
            for k, node in enumerate(nodes):
                first.setdefault(node, k)
            shown: list = [None] * len(nodes)
            for k, s in zip(first.values(), band_keys(signatures([sets[some[k]] for k in first.values()])), strict=True):
                shown[k] = s
            own = text[some]
            at = pa.array(own)
            n = word_places(raw, bounds)[2]
            total = np.bincount(text, n, len(offsets) - 1).astype(np.int64)
            numbers = [pa.array(k, pa.int32()) for k in (place[some], np.arange(len(own)) - np.searchsorted(own, own), n[some], total[own])]
            yield pa.RecordBatch.from_arrays([batch.column("d").take(at), batch.column("x").take(at), *numbers, pa.array(nodes, pa.int64()), pa.array(shown, pa.list_(pa.int64()))], names=["d", "x", "i", "o", "n", "total", "node", "bands"])

    return docs.mapInArrow(read, "d long, x long, i int, o int, n int, total int, node long, bands array<long>")


def segments(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each segment of all texts: the text, its number there, first byte and end, words, first and last line, and a hash of its words."""
    h, counts = word_hashes(raw, offsets)
    starts, stops, _ = word_places(raw, offsets)
    n, text = len(h), np.repeat(np.arange(len(counts)), counts)
    if not n:
        return (np.zeros(0, np.int64),) * 7 + (np.zeros(0, np.uint64),)
    # texts stand REACH places apart, so that what is around one doesn't matter
    most = np.uint64((1 << 64) - 1)
    at = np.arange(n) + text * REACH
    three = np.full(n + len(counts) * REACH, most)
    if n > 2:
        inner = np.flatnonzero(text[:-2] == text[2:])
        three[at[inner]] = mix64(mix64(h[inner] * MULTIPLIER + h[inner + 1]) * MULTIPLIER + h[inner + 2])
    cut = three < most
    for k in range(1, REACH + 1):
        cut[k:] &= three[k:] <= three[:-k]
        cut[:-k] &= three[:-k] <= three[k:]
    cut = cut[at]
    cut[np.flatnonzero(np.diff(text, prepend=-1))] = True
    first = np.flatnonzero(cut)
    sizes = np.diff(first, append=n)
    last = first + sizes - 1
    powers = np.full(int(sizes.max()), MULTIPLIER)
    powers = np.multiply.accumulate(powers)
    made = mix64(np.add.reduceat(h * powers[np.arange(n) - np.repeat(first, sizes)], first) + sizes.astype(np.uint64))
    own = text[first]
    breaks = np.concatenate([[0], np.cumsum(raw == 10)])
    lines = [breaks[starts[k]] - breaks[offsets[own]] for k in (first, last)]
    return own, np.arange(len(own)) - np.searchsorted(own, own), starts[first] - offsets[own], stops[last] - offsets[own], sizes, *lines, made


def segment_rows(docs: DataFrame) -> DataFrame:
    """Of each segment: document (d, x), number o, bytes a to b, words n, lines i to j, and class."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text", SLICE)):
            own, *numbers, made = segments(*text_buffers(batch.column("text")))
            at = pa.array(own)
            yield pa.RecordBatch.from_arrays([batch.column("d").take(at), batch.column("x").take(at), *(pa.array(k, pa.int32()) for k in numbers), pa.array(made.view(np.int64))], names=["d", "x", "o", "a", "b", "n", "i", "j", "node"])
        release_memory()

    return docs.mapInArrow(read, "d long, x long, o int, a int, b int, n int, i int, j int, node long")


def lines_of_runs(gone: DataFrame, least_run: int) -> DataFrame:
    """Those repeated paragraphs that make up half of their text, or stand in a run of ``least_run`` words of them."""
    text = Window.partitionBy("d", "x")
    runs = gone.select("d", "x", "i", "o", "n", "total").distinct().withColumn("run", F.col("o") - F.row_number().over(text.orderBy("i")))
    runs = runs.withColumn("words", F.sum("n").over(Window.partitionBy("d", "x", "run"))).withColumn("all", F.sum("n").over(text))
    return runs.filter((F.col("words") >= least_run) | (2 * F.col("all") >= F.col("total"))).select("d", "x", "i")


def repeated_passages(docs: DataFrame, gone: DataFrame, folder: str, least_run: int) -> DataFrame:
    """Bytes (_cuts: a, b) of each document's runs of repeated segments; ``gone`` holds its removed lines."""
    made = write_table(segment_rows(docs), f"{folder}/segments")
    often = write_table(made.groupBy("node").agg(F.count("*").alias("k")).filter("k > 1").select("node"), f"{folder}/often-segments")
    again = made.join(often, "node").distinct().join(gone, ["d", "x"], "left")
    again = again.filter(F.col("_gone").isNull() | ~F.arrays_overlap("_gone", F.sequence("i", "j"))).drop("_gone", "i", "j")
    again = write_table(again, f"{folder}/repeated-segments")
    place = F.struct("d", "x", "o")
    stays = again.groupBy("node").agg(F.min(place).alias("stays"), F.count("*").alias("k")).filter("k > 1").select("node", "stays")
    off = again.join(stays, "node").filter(place != F.col("stays"))
    runs = off.withColumn("run", F.col("o") - F.row_number().over(Window.partitionBy("d", "x").orderBy("o")))
    runs = runs.groupBy("d", "x", "run").agg(F.min("a").alias("a"), F.max("b").alias("b"), F.sum("n").alias("n")).filter(F.col("n") >= least_run)
    return runs.groupBy("d", "x").agg(F.array_sort(F.collect_list(F.struct("a", "b"))).alias("_cuts"))


def without(text: str, off: set[int], cuts: list) -> tuple[str, int]:
    """The text without the lines numbered in ``off`` and the byte runs ``cuts``, which touch none of them; and the bytes that go."""
    lines = text.split("\n")
    if not cuts:
        return "\n".join([x for k, x in enumerate(lines) if k not in off]), sum(len(lines[k].encode()) for k in off)
    data = text.encode()
    ends = np.cumsum([len(x.encode()) + 1 for x in lines]).tolist()
    spans = sorted([(ends[k - 1] if k else 0, ends[k]) for k in off] + [(c["a"], c["b"]) for c in cuts])
    edges = [0, *(min(x, len(data)) for span in spans for x in span), len(data)]
    kept = b"".join([data[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)])
    if len(lines) - 1 in off:
        kept = kept[:-1]  # the break after the last line that stays
    return kept.decode(), sum(y - x for x, y in spans) - len(off)


def class_texts(rows: DataFrame, words: int) -> DataFrame:
    """Text and signature of classes: rows hold a document's text and its ``wanted`` (place, class) pairs."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text", 2 << 20)):
            out = [(w["node"], lines[w["i"]]) for t, want in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist(), strict=True) for lines in [t.split("\n")] for w in want]
            if out:
                texts = pa.array([x[1] for x in out], pa.string())
                made = [x.tobytes() for x in signatures(shingle_sets(texts, words))]
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), texts, pa.array(made, pa.binary())], names=["node", "text", "signature"])

    return rows.select("text", "wanted").mapInArrow(cut, "node long, text string, signature binary")


#: Members of an entry that are compared with as many others at once.
BLOCK = 128


def agreeing(nodes: np.ndarray, roots: np.ndarray, made: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of classes in different components whose signatures agree in AGREE places or more."""
    u, v = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a, b, ok in agreeing_blocks(roots, made, 0):
        i, j = np.nonzero(ok)
        u.append(nodes[a + i])
        v.append(nodes[b + j])
    x, y = np.concatenate(u), np.concatenate(v)
    return np.minimum(x, y), np.maximum(x, y)


def agreeing_blocks(roots: np.ndarray, made: np.ndarray, band: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Starts of two blocks of members, and which of their pairs (each once) lie in different components, agree in AGREE
    hashes or more, and share no band before this one: a pair belongs to the entry of its first common band."""
    n = len(roots)
    for a in range(0, n, BLOCK):
        for b in range(a, n, BLOCK):
            ok = roots[a : a + BLOCK, None] != roots[None, b : b + BLOCK]
            if a == b:
                ok = np.triu(ok, 1)
            if not ok.any():
                continue
            same = made[a : a + BLOCK, None] == made[None, b : b + BLOCK]
            ok &= same.sum(axis=2) >= AGREE
            if band and ok.any():
                ok &= ~same[:, :, : band * ROWS].reshape(*ok.shape, band, ROWS).all(axis=3).any(axis=2)
            if ok.any():
                yield a, b, ok


def common_counts(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """How many hashes each set of one list shares with each of the other."""
    flat = [np.concatenate(k) for k in (x, y)]
    tokens = np.intersect1d(*map(np.unique, flat), assume_unique=True)
    dense = []
    for sets, values in zip((x, y), flat, strict=True):
        at = np.minimum(np.searchsorted(tokens, values), max(len(tokens) - 1, 0))
        hit = tokens[at] == values if len(tokens) else np.zeros(len(values), bool)
        m = np.zeros((len(sets), len(tokens)), np.float32)
        m[np.repeat(np.arange(len(sets)), [len(k) for k in sets])[hit], at[hit]] = 1
        dense.append(m)
    return dense[0] @ dense[1].T


def entry_links(nodes: np.ndarray, roots: np.ndarray, made: np.ndarray, sets: list[np.ndarray], band: int, percent: int) -> list[tuple[int, int]]:
    """Verified links of an entry: a forest that connects what its links connect."""
    roots = np.unique(roots, return_inverse=True)[1]
    sizes = np.array([len(x) for x in sets])
    parent = list(range(int(roots.max()) + 1))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    for a, b, ok in agreeing_blocks(roots, made, band):
        left, right = (np.array([find(k) for k in roots[c : c + BLOCK].tolist()]) for c in (a, b))
        ok &= left[:, None] != right[None]
        if not ok.any():
            continue
        rows, columns = np.flatnonzero(ok.any(axis=1)), np.flatnonzero(ok.any(axis=0))
        both = common_counts([sets[a + i] for i in rows], [sets[b + j] for j in columns])
        link = ok[np.ix_(rows, columns)] & (100 * both >= percent * (sizes[a + rows, None] + sizes[None, b + columns] - both))
        for i, j in zip(*np.nonzero(link), strict=True):
            p, q = find(int(roots[a + rows[i]])), find(int(roots[b + columns[j]]))
            if p != q:
                parent[p] = q
                out.append((int(nodes[a + rows[i]]), int(nodes[b + columns[j]])))
    return out


def band_entries(members: DataFrame, percent: int, links: bool) -> DataFrame:
    """Of all entries (runs of band, i, j): the members with a pair that agrees (band, i, j, at, node), or with whole sets
    the verified links (u, v) as forests. Rows: band, i, j, at (the band's number), node, root, signature (and whole)."""
    key = ("band", "i", "j", "at")
    columns = ["node", "root", "signature", *(["whole"] if links else [])]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entry, runs = None, []

        def flush() -> Iterator[pa.RecordBatch]:
            nodes, roots, made = (np.concatenate([x[k] for x in runs]) for k in range(3))
            if (roots == roots[0]).all():
                return
            if links:
                sets = [values[x:y] for _, _, _, (values, ends) in runs for x, y in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                if pairs := entry_links(nodes, roots, made, sets, entry[3], percent):
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*pairs, strict=True)], names=["u", "v"])
                return
            some = np.zeros(len(nodes), bool)
            for a, b, ok in agreeing_blocks(roots, made, entry[3]):
                some[a : a + BLOCK] |= ok.any(axis=1)
                some[b : b + BLOCK] |= ok.any(axis=0)
            if some.any():
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([*(pa.array(np.full(int(some.sum()), x), t) for x, t in zip(entry, kinds, strict=True)), pa.array(nodes[some])], names=[*key, "node"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in key])
            nodes, roots = (batch.column(c).to_numpy() for c in ("node", "root"))
            made = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(batch.num_rows, -1)
            lists = (batch.column("whole").values.to_numpy(), batch.column("whole").offsets.to_numpy()) if links else None
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                own = tuple(keys[:, a].tolist())
                if own != entry:
                    if runs:
                        yield from flush()
                    entry, runs = own, []
                runs.append((nodes[a:b], roots[a:b], made[a:b], (lists[0], lists[1][a : b + 1]) if links else None))
        if runs:
            yield from flush()

    rows = members.select(*key, *columns).repartition(shuffle_partitions(members.sparkSession), *key).sortWithinPartitions(*key)
    return rows.mapInArrow(join, "u long, v long" if links else "band long, i int, j int, at int, node long")


def duplicate_paragraphs(docs: DataFrame, folder: str, words: int = 5, percent: int = 80, min_words: int = 10, block_nodes: int = 4096) -> DataFrame:
    """Places (d, x, i) of the repeated paragraphs, their numbers, words and texts' words, and the first paragraph of their component."""
    paragraphs = write_table(paragraph_rows(docs, words, min_words), f"{folder}/paragraphs")
    classes = write_table(paragraphs.groupBy("node").agg(F.min(F.struct("d", "x", "i")).alias("first"), F.count("*").alias("n")), f"{folder}/classes")
    bands = paragraphs.filter("bands IS NOT NULL").select("node", F.posexplode("bands").alias("at", "band"))
    often = write_table(bands.groupBy("band").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter("least <> most").select("band", "least"), f"{folder}/often")
    met = write_table(bands.join(often, "band").distinct(), f"{folder}/met")
    # the texts of classes that met another one, from their first paragraphs
    wanted = classes.join(met.select("node").distinct(), "node", "left_semi").groupBy(F.col("first.d").alias("d"), F.col("first.x").alias("x")).agg(F.collect_list(F.struct(F.col("first.i").alias("i"), "node")).alias("wanted"))
    texts = write_table(class_texts(docs.join(wanted, ["d", "x"]), words), f"{folder}/texts")
    stars = write_table(met.filter("node <> least").select(F.col("least").alias("u"), F.col("node").alias("v")).distinct(), f"{folder}/stars")
    links = write_table(verified(stars, texts, words, percent), f"{folder}/links")
    roots = write_table(connected(links, f"{folder}/first"), f"{folder}/roots")
    rooted = write_table(met.select("band", "at", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), f"{folder}/rooted")
    apart = rooted.groupBy("band").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("nodes")).filter("a <> b").select("band", "nodes")
    apart = write_table(apart, f"{folder}/apart")
    blocks = F.ceil(F.col("nodes") / block_nodes).cast("int")
    rest = rooted.join(apart, "band").withColumn("i", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn("o", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rest = rest.select("band", F.least("i", "o").alias("i"), F.greatest("i", "o").alias("j"), "at", "node", "root").distinct()
    rest = rest.join(texts.select("node", "signature"), "node")
    meeting = write_table(band_entries(rest, percent, False), f"{folder}/meeting")
    wanted = meeting.select("node").distinct()
    whole = write_table(whole_sets(texts.join(wanted, "node", "left_semi"), words).join(texts.select("node", "signature"), "node"), f"{folder}/whole")
    full = meeting.join(whole, "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    more = write_table(band_entries(full, percent, True), f"{folder}/more")
    roots = connected(roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(more), f"{folder}/second")
    named = write_table(classes.select("node", "first", "n").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), f"{folder}/named")
    least = write_table(named.groupBy("root").agg(F.min("first").alias("stays"), F.sum("n").alias("rows")).filter("rows > 1").select("root", "stays"), f"{folder}/least")
    several = write_table(named.join(least, "root").select("node", "stays"), f"{folder}/several")
    return paragraphs.drop("bands").join(several, "node").filter(F.struct("d", "x", "i") != F.col("stays")).select("d", "x", "i", "o", "n", "total", "stays")


def remove_paragraphs(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80, min_words: int = 10, keep: tuple[str, ...] = ("doc_id",), with_text: bool = False, least_run: int = 0) -> DataFrame:
    """Every row of ``docs``: the ``keep`` columns, n_paragraphs, n_removed, n_removed_bytes, kept_sha256 (and the kept text)."""
    folder = run_dir(spark, "paragraph-dedup")
    texts = keyed(docs, id_col, text_col)
    gone = duplicate_paragraphs(texts, folder, words, percent, min_words)
    gone = (lines_of_runs(gone, least_run) if least_run else gone).groupBy("d", "x").agg(F.collect_set("i").alias("_gone"))
    if least_run:
        gone = write_table(gone, f"{folder}/gone")
        gone = gone.join(repeated_passages(texts, gone, folder, least_run), ["d", "x"], "full")
    else:
        gone = gone.withColumn("_cuts", F.lit(None).cast("array<struct<a:int,b:int>>"))
    d, x = row_key(id_col, text_col)
    rows = docs.select(d.alias("_d"), x.alias("_x"), F.col(text_col).alias("_text"), *(F.col(c) for c in keep))
    rows = rows.join(gone, (F.col("_d") == F.col("d")) & (F.col("_x") == F.col("x")), "left").select(*keep, "_text", "_gone", "_cuts")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "_text", 4 << 20)):
            out = []
            for text, drop, cuts in zip(*(batch.column(c).to_pylist() for c in ("_text", "_gone", "_cuts")), strict=True):
                kept, n_bytes = without(text or "", set(drop or ()), cuts or [])
                out.append((0 if text is None else text.count("\n") + 1, len(drop or ()) + len(cuts or ()), n_bytes, hashlib.sha256(kept.encode()).hexdigest(), None if text is None else kept))
            columns = list(zip(*out, strict=True))[: 4 + with_text]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()][: 4 + with_text]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *(pa.array(x, k) for x, k in zip(columns, kinds, strict=True))], names=[*keep, "n_paragraphs", "n_removed", "n_removed_bytes", "kept_sha256", "kept_text"][: len(keep) + 4 + with_text])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(apply, f"{schema}, n_paragraphs long, n_removed long, n_removed_bytes long, kept_sha256 string" + ", kept_text string" * with_text)
