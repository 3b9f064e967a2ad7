"""Best-fit packing of token pieces into as few sequences of bounded length as it can.

Documents longer than the capacity are cut into pieces of exactly the capacity
(the last may be shorter); others are one piece. Pieces of one length are alike,
so the search works on the histogram of lengths, whose size is bounded by the
capacity whatever the corpus: Spark counts it over all pieces, the search turns
it into patterns with multiplicities, and Spark deals the pieces of each length to
the pattern slots by their rank.

The search is bin completion: around the largest length left it enumerates the
undominated fillings of the rest of a bin (a filling goes when another one can
take its place item by item with larger items), prunes them by the waste that a
better solution may still have, and branches over them. Best-fit decreasing gives
the first incumbent; each better solution replaces it; a solution at the lower
bound ends the search. The search is bounded, whatever the corpus: NODES histogram states, BRANCHES
fillings of each, TRIES tries to find them; a filling is taken as often as its items last. Without
proof by then the incumbent is returned, which is never worse than best-fit decreasing.
``packing_summary`` gives the sequences used and the lower bound.

Null text is an empty document: the end id alone. Repeated rows are packed each on
its own. An empty table gives an empty layout. Columns other than those named are
neither read nor met.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stonefly.llm.common import ragged, release_memory, run_dir, shuffle_partitions, slices, write_table
from stonefly.llm.tokens import encoder

#: A way to fill one sequence, as (length, how often) from the largest, and how many sequences it fills.
Pattern = tuple[tuple[tuple[int, int], ...], int]


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of all whole texts: doc_id, piece, start, length, ids_crc32 and, if asked for, the ids' bytes."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        for batch in (part for whole in batches for part in slices(whole, "text")):
            ids, offsets = coder.encode(batch.column("text"))
            n = batch.num_rows
            full = np.full(len(ids) + n, end_id, "<u4")
            full[ragged(offsets[:-1] + np.arange(n), np.diff(offsets))] = ids
            ends = offsets + np.arange(n + 1)
            sizes = np.diff(ends)
            pieces = -(-sizes // capacity)
            doc = np.repeat(np.arange(n), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(sizes[doc] - start, capacity)
            first = ends[doc] + start
            parts = [full[a:b] for a, b in zip(first.tolist(), (first + length).tolist(), strict=True)]
            columns = [batch.column("doc_id").take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array([zlib.crc32(x) for x in parts], pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array([x.tobytes() for x in parts], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)
        coder.forget()
        release_memory()

    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids)


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """No packing has fewer bins: by the total, and by items that pairwise don't fit together."""
    best = -(-sum(k * n for k, n in counts.items()) // capacity)
    lengths = np.array(sorted(counts), np.int64)
    many = np.array([counts[int(k)] for k in lengths], np.int64)
    mass = np.concatenate([[0], np.cumsum(lengths * many)])
    number = np.concatenate([[0], np.cumsum(many)])
    half = np.searchsorted(lengths, capacity // 2, side="right")
    for small in {0, *(int(k) for k in lengths if k <= capacity // 2)}:
        big = max(half, int(np.searchsorted(lengths, capacity - small, side="right")))
        low = int(np.searchsorted(lengths, small, side="left"))
        alone, middle = number[-1] - number[big], number[big] - number[half]
        room = middle * capacity - (mass[big] - mass[half])
        rest = mass[half] - mass[low]
        best = max(best, int(alone + middle + max(0, -(-(rest - room) // capacity))))
    return best


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing on the histogram: equal items and equal bins move together."""
    bins: dict[int, list[list]] = {}  # room left: [pattern, how many bins]
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = min((r for r in bins if r >= length), default=None)
            if room is None:
                fit = min(capacity // length, left)
                many = left // fit
                bins.setdefault(capacity - fit * length, []).append([((length, fit),), many])
                left -= fit * many
                continue
            # a bin that takes one more often takes as many as fit: it stays the fullest that has room
            pattern, many = bins[room].pop()
            fit = min(room // length, left)
            take = min(many, left // fit)
            if take < many:
                bins[room].append([pattern, many - take])
            if not bins[room]:
                del bins[room]
            bins.setdefault(room - fit * length, []).append([(*pattern, (length, fit)), take])
            left -= fit * take
    return [(pattern, many) for group in bins.values() for pattern, many in group]


#: Bounds of the search, whatever the corpus: histogram states that it branches over, fillings that it takes
#: of each, and tries to find them. A better solution beyond them is not looked for.
NODES, BRANCHES, TRIES = 2_000, 3, 300

#: A filling as (length, how often) from the largest, and the room that it leaves.
Filling = tuple[tuple[tuple[int, int], ...], int]


def fillings(lengths: list[int], counts: dict[int, int], room: int, waste: int, most: int, tries: int = TRIES) -> tuple[list[Filling], bool]:
    """Undominated fillings of ``room`` that leave at most ``waste``, the fullest and then largest items first.

    ``lengths`` descend. A filling to which some left-over item could still be
    added, or one of whose items could give way to a larger one within the room
    left, is dominated. All that ``tries`` tries find are ordered by what they leave before
    ``most`` are taken. Second: did the tries suffice to see every filling?
    """
    found: dict[tuple, int] = {}
    tails = [0] * (len(lengths) + 1)
    for i in range(len(lengths) - 1, -1, -1):
        tails[i] = tails[i + 1] + lengths[i] * counts[lengths[i]]
    tried = 0

    def undominated(chosen: dict[int, int], left: int) -> bool:
        if not left:
            return True
        for k in lengths:  # any item left over that fits the room?
            if k <= left and counts[k] > chosen.get(k, 0):
                return False
        for k in chosen:  # a larger item in the place of one of them?
            for other in lengths:
                if other <= k:
                    break
                if other <= k + left and counts[other] > chosen.get(other, 0):
                    return False
        return True

    # depth first: (next length, room left, lengths chosen so far as a linked list)
    stack: list[tuple[int, int, tuple | None]] = [(0, room, None)]
    while stack and tried < tries:
        i, left, chosen = stack.pop()
        tried += 1
        while i < len(lengths) and lengths[i] > left:
            i += 1
        if left - tails[i] > waste:  # even all smaller items leave too much
            continue
        if i == len(lengths) or not left:
            items = {}
            while chosen:
                k, n, chosen = chosen
                items[k] = n
            if left <= waste and undominated(items, left):
                found[tuple(sorted(items.items(), reverse=True))] = left
                if len(found) >= most and sum(not x for x in found.values()) >= most:
                    break  # as many perfect ones as are taken
            continue
        k = lengths[i]
        for n in range(min(counts[k], left // k) + 1):  # the largest number on top
            stack.append((i + 1, left - n * k, (k, n, chosen) if n else chosen))
    return sorted(found.items(), key=lambda x: (x[1], [(-k, n) for k, n in x[0]]))[:most], not stack


def greedy_filling(lengths: list[int], counts: dict[int, int], room: int) -> Filling:
    """The room filled with the largest items that fit, one after the other."""
    chosen = []
    for k in lengths:
        if n := min(counts[k], room // k):
            chosen.append((k, n))
            room -= n * k
    return tuple(chosen), room


def bin_completion(counts: dict[int, int], capacity: int, nodes: int = NODES, branches: int = BRANCHES) -> tuple[list[Pattern], bool]:
    """Patterns that pack the histogram, and whether their number is proven least.

    Depth first: the largest length left gets its fillings; the fullest is taken
    as often as its items last; other fillings are the branches. What a solution
    better than the incumbent may waste in all bounds each branch. One histogram
    is changed and changed back, so that memory holds one path and the other fillings
    along it. Where the tries for fillings run out with none found, the greedy one stands in.
    """
    counts = {k: n for k, n in counts.items() if n}
    if any(not 0 < k <= capacity for k in counts):
        raise ValueError("lengths must be between 1 and the capacity")
    total = sum(k * n for k, n in counts.items())
    bound = lower_bound(counts, capacity)
    incumbent = best_fit_decreasing(counts, capacity)
    number = sum(n for _, n in incumbent)
    if number == bound:
        return incumbent, True
    left, bins, wasted, spent = dict(counts), 0, 0, 0
    complete = True
    # of each step on the path: the fillings not tried yet (last first) and the one taken
    path: list[tuple[list[tuple[dict[int, int], int]], dict[int, int], int, int]] = []

    def options() -> list[tuple[dict[int, int], int]]:
        """Fillings around the largest length left, the most promising last; none where no better solution lies below."""
        nonlocal complete
        allowed = (number - 1) * capacity - total - wasted  # waste that a better solution may still have
        if allowed < 0 or bins + (lower_bound(left, capacity) if len(left) < 64 else -(-sum(k * n for k, n in left.items()) // capacity)) >= number:
            return []
        largest = max(left)
        rest = dict(left)
        rest[largest] -= 1
        lengths = sorted((k for k, n in rest.items() if n and k <= capacity - largest), reverse=True)
        found, all_seen = fillings(lengths, rest, capacity - largest, min(allowed, capacity), branches)
        if not all_seen or len(found) == branches:
            complete = False  # there may be others
        if not found and not all_seen:
            found = [x for x in [greedy_filling(lengths, rest, capacity - largest)] if x[1] <= allowed]
        out = []
        for filling, waste in found:
            use = dict(filling)
            use[largest] = use.get(largest, 0) + 1
            out.append((use, waste))
        return out[::-1]

    def take(todo: list[tuple[dict[int, int], int]]) -> None:
        nonlocal bins, wasted, complete
        use, waste = todo.pop()
        times = min(left[k] // n for k, n in use.items())
        if waste:
            allowed = (number - 1) * capacity - total - wasted
            times = max(1, min(times, allowed // waste))
        if times > 1:
            complete = False  # fewer times are not tried
        for k, n in use.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
        bins += times
        wasted += times * waste
        path.append((todo, use, times, waste))

    def undo() -> list[tuple[dict[int, int], int]]:
        nonlocal bins, wasted
        todo, use, times, waste = path.pop()
        for k, n in use.items():
            left[k] = left.get(k, 0) + n * times
        bins -= times
        wasted -= times * waste
        return todo

    todo = options()
    while number > bound and spent < nodes:
        while not todo and path:
            todo = undo()
        if not todo:
            return incumbent, complete
        take(todo)
        spent += 1
        if left:
            todo = options()
        else:
            if bins < number:
                incumbent, number = [(tuple(sorted(use.items(), reverse=True)), times) for _, use, times, _ in path], bins
            todo = []
    return incumbent, number == bound


def slots(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """For each length, which ranks of its pieces go where; rows ascend by (length, first rank).

    A slot row serves ranks ``rank`` to ``rank + n * times - 1``: rank r goes to sequence
    ``sequence + (r - rank) // n`` at ``offset + (r - rank) % n * length``.
    """
    rows, sequence, used = [], 0, Counter()
    for pattern, times in patterns:
        offset = 0
        for length, n in pattern:
            rows.append((length, used[length], sequence, offset, n))
            used[length] += n * times
            offset += n * length
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "sequence", "offset", "n"), table.T, strict=True))


def pack(pieces: DataFrame, capacity: int, folder: str, keys: list[str], length_col: str = "length", nodes: int = NODES) -> DataFrame:
    """``pieces`` (a written table) with ``sequence_id`` and ``offset``; ``keys`` order pieces of equal length.

    Ranks within a length are counted in buckets of the keys, so no length, however
    common, is ordered in one task; the buckets' sizes are summed beforehand.
    """
    spark = pieces.sparkSession
    buckets = 4 * shuffle_partitions(spark)
    rows = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    sizes = write_table(rows.groupBy(F.col(length_col).alias("_length"), "_bucket").agg(F.count("*").alias("_n")), f"{folder}/sizes")
    counts = {r["_length"]: r["n"] for r in sizes.groupBy("_length").agg(F.sum("_n").alias("n")).collect()}  # capacity rows at most
    patterns, _ = bin_completion(counts, capacity, nodes)
    where = spark.sparkContext.broadcast(slots(patterns))  # bounded by the capacity, not by the corpus
    before = Window.partitionBy("_length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(F.col("_length").alias("_own"), F.col("_bucket").alias("_in"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(length_col, "_bucket").orderBy(*keys)
    ranked = rows.withColumn("_rank", F.row_number().over(inside) - 1)
    ranked = ranked.join(bases, (F.col(length_col) == F.col("_own")) & (F.col("_bucket") == F.col("_in")))
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_base")).drop("_own", "_in", "_base", "_bucket")
    names = pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = where.value
        key = t["length"] << 40 | t["rank"]
        for batch in batches:
            length = batch.column(length_col).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.searchsorted(key, length << 40 | rank, side="right") - 1
            step = rank - t["rank"][at]
            sequence = t["sequence"][at] + step // t["n"][at]
            offset = t["offset"][at] + step % t["n"][at] * length
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    return ranked.select(*names, "_rank").mapInArrow(place, schema)


def pack_documents(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of ``docs`` with their places: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    folder = run_dir(spark, "packing")
    pieces = write_table(token_pieces(docs, tokenizer, end_id, capacity, id_col, text_col, with_ids), f"{folder}/pieces")
    return pack(pieces, capacity, folder, ["doc_id", "piece", "ids_crc32"])


def packing_summary(layout: DataFrame, capacity: int, length_col: str = "length") -> tuple[int, int]:
    """How many sequences a layout uses, and a number that no layout can be below."""
    counts = {r[0]: r["count"] for r in layout.groupBy(length_col).count().collect()}  # capacity rows at most
    return layout.select("sequence_id").distinct().count(), lower_bound(counts, capacity)


def sequences(layout: DataFrame) -> DataFrame:
    """The packed sequences of a layout with ids: sequence_id, n_tokens and the ids' bytes in order of offset.

    A group is one sequence, bounded by the capacity.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
    return layout.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
