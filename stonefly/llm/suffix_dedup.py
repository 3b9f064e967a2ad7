"""Exact removal of repeated byte strings, with suffix arrays by linear grouping.

Every ``length``-byte string that also starts earlier (smaller doc_id, or the same
document further left) is removed from the later place. Which strings are compared:

1. Each window of ``length`` bytes picks the least hash of its ``ANCHOR``-byte strings.
   Windows with equal bytes pick the same anchor at the same place, so all equal windows
   meet under their anchor's hash. Windows next to each other with one anchor are a region.
2. Regions with equal bytes are one class. All but the first of a class are repeated
   whole; within a batch of rows that is settled before the shuffle, so a passage that a
   third of all documents share sends a row for each batch, not for each document.
3. Under an anchor with several classes, the regions differ at their sides. Each class's
   first region is cut into ranges of ``STEP`` + 1 window starts. All windows of a range
   share its middle bytes; what differs are STEP bytes on each side. For ranges with the
   same middle a suffix array is built over the sides, the middle standing as one letter:
   neighbours with STEP + 1 common letters are equal windows, of which the first stays.

The suffix array is made by linear grouping: suffixes are grouped by their Lyndon prefix,
groups are taken in descending order, and pointers to the previous smaller suffix extend
the prefix of the suffix before; then each group's order is emitted in one ascending scan.

Hashes are 64 bits wide with the place in the region mixed in. Null text is empty. Null ids
come before all others. Rows that repeat an id are told apart by a 64-bit hash of the text and
ordered by it; rows repeated whole count as one document and get equal results. An empty
table gives an empty result. Columns other than the two named are neither read nor met.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stonefly.llm.common import mix64, release_memory, run_dir, shuffle_partitions, slices, text_buffers, write_table

ANCHOR, STEP = 40, 10
#: Bytes of text (one text at least) whose regions a task finds or cuts at once; the arrays over them take some 70 times that.
SLICE = 1 << 20
#: Distinct sides under one middle beyond which windows are grouped one by one instead, by an aggregate.
MOST_SIDES = 20_000
#: Of such a middle, so many ranges at most are held before their windows go out.
WINDOW_ROWS = 4096
#: A fixed odd multiplier for rolling hashes and random odd numbers for the 256 bytes.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
LETTER = mix64(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)

_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, 0 to n - 1; kept for the next batch."""
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", BASE), ("down", INVERSE)):
            x = np.full(n, base, np.uint64)
            x[0] = 1
            _POWERS[name] = np.multiply.accumulate(x)
    return _POWERS["up"], _POWERS["down"]


class Rolling:
    """Hashes of any runs of a byte array."""

    def __init__(self, raw: np.ndarray) -> None:
        self.up, down = powers(len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(LETTER[raw] * down[: len(raw)], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Equal for equal bytes: the run's polynomial shifted to a common place (the inverse powers count down)."""
        return mix64((self.sums[stop] - self.sums[start]) * self.up[start] + (stop - start).astype(np.uint64))

    def every(self, size: int) -> np.ndarray:
        """Hashes of all runs of ``size`` bytes."""
        return mix64((self.sums[size:] - self.sums[:-size]) * self.up[: len(self.sums) - size] + np.uint64(size))


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least of each run of w values, by doubling."""
    span = 1
    while span * 2 <= w:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (w - span)], x[w - span :]) if span < w else x


def regions(raw: np.ndarray, offsets: np.ndarray, length: int, rolling: Rolling) -> tuple[np.ndarray, ...]:
    """Document, anchor, first and last window start of each region, and the anchors' hashes; places are in ``raw``."""
    none = np.zeros(0, np.int64)
    if len(raw) < length:
        return none, none, none, none, none.astype(np.uint64)
    low = np.uint64((1 << 31) - 1)
    h = rolling.every(ANCHOR)
    key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
    least = sliding_min(key, length - ANCHOR + 1)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    valid = doc[: len(least)] == doc[length - 1 :]
    fresh = np.ones(len(least), bool)
    fresh[1:] = (least[1:] != least[:-1]) | (doc[1 : len(least)] != doc[: len(least) - 1])
    starts = np.flatnonzero(fresh & valid)
    stops = np.concatenate([np.flatnonzero(fresh), [len(least)]])
    ends = stops[np.searchsorted(stops, starts, side="right")] - 1
    # a run of windows of one document is valid up to the document's last window
    ends = np.minimum(ends, offsets[doc[starts] + 1] - length)
    anchors = (least[starts] & low).astype(np.int64)
    return doc[starts], anchors, starts, ends, h[anchors]


def merged(doc: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of the intervals [low, high) of each document, in order."""
    order = np.lexsort((low, doc))
    doc, low, high = doc[order], low[order], high[order]
    if not len(doc):
        return doc, low, high
    first = np.concatenate([[True], doc[1:] != doc[:-1]])
    width = int(high.max()) + 1
    reach = np.maximum.accumulate((np.cumsum(first) - 1) * width + high)
    fresh = first.copy()
    fresh[1:] |= (np.cumsum(first) - 1)[1:] * width + low[1:] > reach[:-1]
    at = np.flatnonzero(fresh)
    last = np.concatenate([at[1:], [len(doc)]]) - 1
    return doc[at], low[at], reach[last] - (np.cumsum(first) - 1)[at] * width


def suffix_array(text: list[int]) -> list[int]:
    """Suffix array by linear grouping; the last letter is smaller than all others and occurs once."""
    n = len(text)
    start, total = {}, 0
    for letter, many in sorted(Counter(text).items()):
        start[letter] = total
        total += many
    group = [start[x] for x in text]  # of each suffix: its group's first place
    free = dict(start)
    order, place = [0] * n, [0] * n
    for i, x in enumerate(text):
        k = free[x]
        free[x] = k + 1
        order[k], place[i] = i, k
    size = [0] * n
    for g in group:
        size[g] += 1
    previous = [-1] * n
    end = n - 1
    while end >= 0:  # groups in descending order
        first = group[order[end]]
        if first == end:  # one suffix
            p = order[end]
            s = p
            p -= 1
            while p >= 0 and group[p] > first:
                p = previous[p]
            previous[s] = p
            if p >= 0:
                g = group[p]
                left = size[g] - 1
                if left:  # else it is alone and its group keeps its place
                    size[g] = left
                    k = g + left
                    other = order[k]
                    at = place[p]
                    order[at], place[other] = other, at
                    order[k], place[p] = p, k
                    group[p] = k
                    size[k] = 1
            end = first - 1
            continue
        many: dict[int, int] = {}  # suffixes before: how often this group's prefix follows theirs
        for s in sorted(order[first : end + 1]):
            p = s - 1
            while p >= 0 and group[p] > first:
                p = previous[p]
            if p >= 0 and group[p] == first:
                p = previous[p]  # a repetition of the prefix: it belongs to the same suffix before
            previous[s] = p
            if p >= 0:
                many[p] = many.get(p, 0) + 1
        if many:
            by: dict[int, list[int]] = {}
            for p, k in many.items():
                by.setdefault(k, []).append(p)
            for k in sorted(by, reverse=True):
                for p in by[k]:  # to the end of its group
                    g = group[p]
                    size[g] -= 1
                    to, at = g + size[g], place[p]
                    other = order[to]
                    order[at], place[other] = other, at
                    order[to], place[p] = p, to
                moved = [group[p] + size[group[p]] for p in by[k]]  # where that end begins: a group of its own
                for p, to in zip(by[k], moved, strict=True):
                    group[p] = to
                    size[to] = 0
                for to in moved:
                    size[to] += 1
        end = first - 1
    out = [0] * n
    placed = [False] * n
    out[0] = n - 1
    placed[n - 1] = True
    nxt = list(range(n))
    for i in range(n):  # each suffix found puts those whose next smaller suffix it is in front of what is free in their groups
        s = out[i] - 1
        while s >= 0 and not placed[s]:
            g = group[s]
            out[nxt[g]] = s
            nxt[g] += 1
            placed[s] = True
            s = previous[s]
    return out


#: kind 0: a region by its anchor; 1: bytes [a, b) are repeated; 2: first region of a class under an anchor with several.
ROW = pa.schema([("kind", pa.int8()), ("h", pa.int64()), ("c", pa.int64()), ("d", pa.int64()), ("x", pa.int64()), ("p", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])
ROW_SQL = "kind byte, h long, c long, d long, x long, p long, a long, b long"


def rows_of(kind: int, h=0, c=0, d=0, x=0, p=0, a=0, b=0) -> pa.RecordBatch:
    n = max(np.size(k) for k in (h, c, d, x, p, a, b))
    full = lambda k: pa.array(np.broadcast_to(np.asarray(k).astype(np.int64) if np.asarray(k).dtype != np.uint64 else np.asarray(k).view(np.int64), n))
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int8)), *(full(k) for k in (h, c, d, x, p, a, b))], schema=ROW)


def row_key(id_col: str, text_col: str) -> tuple[Column, Column]:
    """What tells rows apart: the id, null as the least long, and a hash of the text."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))), F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """d and x (see ``row_key``) and text; rows repeated whole once or more."""
    d, x = row_key(id_col, text_col)
    return docs.select(d.alias("d"), x.alias("x"), F.col(text_col).alias("text"))


def region_rows(docs: DataFrame, length: int) -> DataFrame:
    """Regions of all texts; those that repeat within a batch of rows are settled there."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text", SLICE)):
            raw, offsets = text_buffers(batch.column("text"))
            rolling = Rolling(raw)
            doc, anchor, low, high, h = regions(raw, offsets, length, rolling)
            if not len(doc):
                continue
            c = mix64(rolling.of(low, high + length) + (anchor - low).astype(np.uint64) * np.uint64(0x632BE59BD9B4E019))
            ids, tags = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("d", "x"))
            base = offsets[doc]
            d, x, p = ids[doc], tags[doc], anchor - base
            # the first of each class of this batch goes on; equal rows are a document given twice
            order = np.lexsort((p, x, d, c))
            cs, ds, xs, ps = c[order], d[order], x[order], p[order]
            first = np.concatenate([[True], cs[1:] != cs[:-1]])
            same = np.concatenate([[False], (cs[1:] == cs[:-1]) & (ds[1:] == ds[:-1]) & (xs[1:] == xs[:-1]) & (ps[1:] == ps[:-1])])
            lead = np.flatnonzero(first)[np.cumsum(first) - 1]
            again = ~first & ~same & ~((ds == ds[lead]) & (xs == xs[lead]) & (ps == ps[lead]))
            on, off = order[first], order[again]
            yield rows_of(0, h[on], c[on], d[on], x[on], p[on], (low - base)[on], (high - base)[on])
            if len(off):
                where, a, b = merged(doc[off], (low - base)[off], (high - base)[off] + length)
                # any h spreads them
                yield rows_of(1, h[off[:1]] + np.arange(len(where), dtype=np.uint64) * np.uint64(BASE), 0, ids[where], tags[where], 0, a, b)
        _POWERS.clear()
        release_memory()

    return docs.mapInArrow(find, ROW_SQL)


def settle(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows in order of (kind, h, c, d, x, p): all but the first of a class are repeated; firsts under one anchor go on if there are several."""
    last: np.ndarray | None = None  # the last row of kind 0 so far
    lead: np.ndarray | None = None  # the first of its class
    waits = None  # the only class so far under the last anchor
    several = False
    for batch in batches:
        kind, h, c, d, x, p, a, b = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(8))
        if (kind == 1).any():
            yield batch.filter(pa.array(kind == 1)).cast(ROW)
        t = np.stack([h, c, d, x, p, a, b], axis=1)[kind == 0]
        if not len(t):
            continue
        before = np.concatenate([[last if last is not None else t[0] - 1], t[:-1]])
        new_h = t[:, 0] != before[:, 0]
        new_c = new_h | (t[:, 1] != before[:, 1])
        if last is None:
            new_h[0] = new_c[0] = True
        # the first row of each row's class, which may be of an earlier batch
        at = np.flatnonzero(new_c)
        number = np.cumsum(new_c) - 1
        leads = np.where((number >= 0)[:, None], t[at[np.maximum(number, 0)]] if len(at) else t, lead if lead is not None else t[0])
        again = ~new_c & (t[:, 2:5] != leads[:, 2:5]).any(axis=1)
        if again.any():
            y = t[again]
            yield rows_of(1, 0, 0, y[:, 2], y[:, 3], 0, y[:, 5], y[:, 6] + length)
        # classes by run of h; the first run may go on from before
        firsts = t[new_c]
        run = np.cumsum(new_h)[new_c]
        out = []
        if len(firsts):
            counts = np.bincount(run, minlength=int(run.max()) + 1)
            if counts[0] and waits is not None:
                out.append(waits[None])
                waits, several = None, True
            many = counts > 1
            many[0] = several or waits is not None
            chosen = firsts[many[run]]
            if len(chosen):
                out.append(chosen)
            if run[-1] > 0 or last is None:  # the last run began here
                k = run[-1]
                several = bool(counts[k] > 1)
                waits = None if several else firsts[-1]
        if out:
            yield rows_of(2, *np.concatenate(out).T)
        last = t[-1]
        lead = leads[-1]


SIDES = "key long, d long, x long, p long, lo byte, hi byte, sides binary"


def side_rows(docs: DataFrame, regions_: DataFrame, length: int) -> DataFrame:
    """The ranges of window starts of regions: hash of the common middle, and the bytes on either side.

    ``p`` is the start of the range; ``lo`` to ``hi`` are the starts in it that belong to the region.
    """
    own = regions_.groupBy("d", "x").agg(F.collect_list(F.struct("p", "a", "b")).alias("r"))
    rows = docs.join(own, ["d", "x"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text", SLICE)):
            raw, offsets = text_buffers(batch.column("text"))
            rolling = Rolling(raw)
            lists = batch.column("r")
            many = np.asarray(pc.list_value_length(lists))
            flat = lists.flatten()
            anchor, low, high = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("p", "a", "b"))
            doc = np.repeat(np.arange(batch.num_rows), many)
            ids, tags = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("d", "x"))
            edge = length - ANCHOR
            padded = np.concatenate([raw, np.zeros(length + STEP, np.uint8)])
            for j in range(0, edge, STEP):
                start = anchor - edge + j  # windows from start to start + STEP; the last range takes in its end
                lo = np.maximum(low - start, 0)
                hi = np.minimum(high - start, STEP if j + STEP >= edge else STEP - 1)
                keep = np.flatnonzero(lo <= hi)
                if not len(keep):
                    continue
                o = offsets[doc[keep]]
                s = start[keep]
                # the middle lies in the text, since the region has a window of this range
                key = mix64(rolling.of(o + s + STEP, o + s + length) + np.uint64(j * 0x9E37 + 1))
                left = o[:, None] + s[:, None] + np.arange(STEP)
                right = o[:, None] + s[:, None] + length + np.arange(STEP)
                sides = np.concatenate([np.where(left < o[:, None], 0, padded[np.maximum(left, 0)]), np.where(right >= offsets[doc[keep] + 1][:, None], 0, padded[right])], axis=1)
                data = pa.Array.from_buffers(pa.binary(), len(keep), [None, pa.py_buffer((np.arange(len(keep) + 1) * 2 * STEP).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(sides.astype(np.uint8)))])
                # a range may begin before the text: its start is held plus the length
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(ids[doc[keep]]), pa.array(tags[doc[keep]]), pa.array(s + length), pa.array(lo[keep].astype(np.int8)), pa.array(hi[keep].astype(np.int8)), data], names=["key", "d", "x", "p", "lo", "hi", "sides"])
        _POWERS.clear()
        release_memory()

    return rows.mapInArrow(cut, SIDES)


def compare_sides(bundle: list[list[tuple]], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Repeated windows among ranges with a common middle, for several middles at once.

    Each member is (d, x, p, lo, hi, sides), distinct in (lo, hi, sides) under its middle and
    in order of (d, x, p). The letters of a member are its left side, the middle (one letter for
    each middle) and its right side; windows are its suffixes from lo to hi, STEP + 1 letters long.
    """
    members, text = [], []
    for k, group in enumerate(bundle):
        for m in group:
            sides = m[5]
            text += [x + 2 for x in sides[:STEP]]
            text.append(300 + k)
            text += [x + 2 for x in sides[STEP:]]
            text.append(1)
            members.append(m)
    text.append(0)
    width = 2 * STEP + 2
    order = np.array(suffix_array(text))
    letters = np.concatenate([np.array(text), np.zeros(width, np.int64)])
    offset = order % width
    lo, hi = np.array([m[3] for m in members] + [1]), np.array([m[4] for m in members] + [0])
    owner = order // width
    order = order[(offset >= lo[owner]) & (offset <= hi[owner])]
    shown = letters[order[:, None] + np.arange(STEP + 1)]
    fresh = np.concatenate([[True], (shown[1:] != shown[:-1]).any(axis=1)])
    run = np.cumsum(fresh) - 1
    owner, offset = order // width, order % width
    d, x, p = (np.array([m[k] for m in members], np.int64)[owner] for k in range(3))
    p = p + offset
    by = np.lexsort((p, x, d, run))
    again = np.concatenate([[False], run[by][1:] == run[by][:-1]])
    at = by[again]
    lead = by[np.flatnonzero(~again)][run[at]] if len(at) else at
    at = at[(d[at] != d[lead]) | (x[at] != x[lead]) | (p[at] != p[lead])]
    place = p[at] - length
    return d[at], x[at], place, place + length


def settle_sides(batches: Iterator[pa.RecordBatch], length: int, most: int) -> Iterator[pa.RecordBatch]:
    """Rows in order of (key, d, x, p): repeated windows of ranges with one middle.

    At most ``most`` sides of a middle are held; when there are more, those held and all later ones go out as
    single windows (kind 3) while they are read.
    """
    marks: list[tuple] = []
    bundle: list[list[tuple]] = []
    held = 0
    key, group, seen, many = None, [], {}, False

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal bundle, held, marks
        if bundle:
            d, x, a, b = compare_sides(bundle, length)
            if len(d):
                yield rows_of(1, 0, 0, d, x, 0, a, b)
        if marks:
            y = np.array(marks, np.int64)
            yield rows_of(1, 0, 0, y[:, 0], y[:, 1], 0, y[:, 2], y[:, 3])
        bundle, held, marks = [], 0, []

    def close() -> Iterator[pa.RecordBatch]:
        nonlocal held
        if many:
            yield from windows_one_by_one(key, group, length)
        elif len(group) > 1:
            bundle.append(group)
            held += len(group)

    for batch in batches:
        for k, d, x, p, lo, hi, sides in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
            if k != key:
                yield from close()
                if held > 2000:
                    yield from flush()
                key, group, seen, many = k, [], {}, False
            # beyond ``most`` no sides are added, but those of a held one are still settled here
            lead = seen.get((lo, hi, sides), (d, x, p)) if many else seen.setdefault((lo, hi, sides), (d, x, p))
            if lead == (d, x, p):
                if not group or group[-1] != (d, x, p, lo, hi, sides):
                    group.append((d, x, p, lo, hi, sides))
                if len(group) > (WINDOW_ROWS if many else most):
                    yield from windows_one_by_one(key, group, length)
                    group, many = [], True
            else:
                place = p - length
                marks.append((d, x, place + lo, place + hi + length))
                if len(marks) > 100_000:
                    yield from flush()
    yield from close()
    yield from flush()


def windows_one_by_one(key: int, group: list[tuple], length: int) -> Iterator[pa.RecordBatch]:
    """Windows of a middle with very many sides, as regions of one window each (kind 3): an aggregate finds their firsts."""
    seed = np.uint64(key & (1 << 64) - 1)
    for a in range(0, len(group), WINDOW_ROWS):
        part = group[a : a + WINDOW_ROWS]
        d, x, p, lo, hi = (np.array([m[i] for m in part], np.int64) for i in range(5))
        sides = np.frombuffer(b"".join(m[5] for m in part), np.uint8).reshape(len(part), 2 * STEP)
        rolling = Rolling(sides.ravel())
        base = np.arange(len(part)) * 2 * STEP
        for s in range(STEP + 1):
            ok = (lo <= s) & (s <= hi)
            if not ok.any():
                continue
            # the window: the left side from s on, the middle, the right side up to s, which lie beside each other here
            h = mix64(rolling.of(base + s, base + STEP + s) ^ seed + np.uint64(s))
            yield rows_of(3, h[ok], 0, d[ok], x[ok], 0, (p - length + s)[ok], 0)


def repeated_bytes(docs: DataFrame, folder: str, length: int = 100, most_sides: int = MOST_SIDES) -> DataFrame:
    """All repeated intervals of the keyed documents: d, x, a, b; intervals of a document may overlap."""
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    if length < ANCHOR + STEP or (length - ANCHOR) % STEP:
        raise ValueError(f"the length must be {ANCHOR} and a multiple of {STEP}")
    found = region_rows(docs, length).repartition(parts, "h").sortWithinPartitions("kind", "h", "c", "d", "x", "p")
    settled = write_table(found.mapInArrow(lambda it: settle(it, length), ROW_SQL), f"{folder}/settled")
    sides = side_rows(docs, settled.filter("kind = 2"), length).repartition(parts, "key").sortWithinPartitions("key", "d", "x", "p")
    last = write_table(sides.mapInArrow(lambda it: settle_sides(it, length, most_sides), ROW_SQL), f"{folder}/sides")
    single = last.filter("kind = 3").select("h", "d", "x", "a")
    firsts = write_table(single.groupBy("h").agg(F.min(F.struct("d", "x", "a")).alias("f"), F.count("*").alias("n")).filter("n > 1").select("h", "f"), f"{folder}/firsts")
    again = single.join(firsts, "h").filter(F.struct("d", "x", "a") != F.col("f")).select("d", "x", "a", (F.col("a") + length).alias("b"))
    return settled.filter("kind = 1").select("d", "x", "a", "b").unionByName(last.filter("kind = 1").select("d", "x", "a", "b")).unionByName(again)


def remove_repeats(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, keep: tuple[str, ...] = ("doc_id",), with_text: bool = False, most_sides: int = MOST_SIDES) -> DataFrame:
    """Every row of ``docs``: the ``keep`` columns, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the kept text.

    The kept text leaves out the bytes of a character that was cut through.
    """
    folder = run_dir(spark, "suffix-dedup")
    marks = repeated_bytes(keyed(docs, id_col, text_col), folder, length, most_sides)
    # a document's intervals: bounded by its length
    marks = marks.groupBy("d", "x").agg(F.collect_set(F.struct("a", "b")).alias("_marks"))
    d, x = row_key(id_col, text_col)
    rows = docs.select(d.alias("_d"), x.alias("_x"), F.col(text_col).alias("_text"), *(F.col(c) for c in keep))
    rows = rows.join(marks, (F.col("_d") == F.col("d")) & (F.col("_x") == F.col("x")), "left").select(*keep, "_text", "_marks")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "_text", 4 << 20)):
            out = []
            lists = batch.column("_marks")
            for i, text in enumerate(batch.column("_text").to_pylist()):
                data = (text or "").encode()
                part = lists.slice(i, 1)
                gone = spans = 0
                kept = data
                if part[0].is_valid:
                    flat = part.flatten()
                    _, a, b = merged(np.zeros(len(flat), np.int64), *(flat.field(k).to_numpy(zero_copy_only=False) for k in ("a", "b")))
                    edges = [0, *np.stack([a, b], axis=1).ravel().tolist(), len(data)]
                    kept = b"".join([data[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)])
                    gone, spans = int((b - a).sum()), len(a)
                out.append((len(data), gone, spans, hashlib.sha256(kept).hexdigest(), (None if text is None else kept.decode("utf-8", "ignore")) if with_text else None))
            columns = list(zip(*out, strict=True))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            n = 5 if with_text else 4
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *(pa.array(x, k) for x, k in zip(columns[:n], kinds[:n], strict=True))], names=[*keep, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"][: len(keep) + n])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return rows.mapInArrow(apply, f"{schema}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_text string" * with_text)


#: The query's rows in DuckDB SQL (doc_id is unique there): all windows of 100 bytes, as hexadecimal text.
SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (SELECT doc_id, k, substr(h, 2000 * k + 1, 2198) AS h FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2000 + 1)) AS k FROM d)),
w AS (SELECT doc_id, 1000 * k + j AS i, hash(substr(h, 2 * j + 1, 200)) AS g FROM (SELECT doc_id, k, h, unnest(range(0, least(1000, len(h) // 2 - 99))) AS j FROM c)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS n FROM w) WHERE n > 1),
f AS (SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100, true) AS fresh FROM r),
s AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM (SELECT doc_id, i, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM f) GROUP BY doc_id, run),
p AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS z FROM s),
q AS (SELECT doc_id, sum(b - a) AS gone, count(*) AS n, max(b) AS last, string_agg(substr(h, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) AS kept FROM p JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN q USING (doc_id)
"""
