r"""Exact n-gram Jaccard join with signature trees.

A document's set holds its distinct shingles of ``words`` words (``[^\x20\x09-\x0D]+``,
A-Z lowered), as 64-bit hashes; with fewer words it is the whole sequence. Documents with
equal sets are one class and meet as one node. Two nodes link when their sets' Jaccard
similarity is at least ``percent`` per cent; a component is what links connect.

Candidates come from each node's sketch, its SKETCH least hashes: a random sample of its set, or
the whole set if that is no larger. Of a linked pair at similarity 0.8, fewer than SHARED are
common with a probability of 1e-13, and fewer than MET of the TOKENS least, too, which is less
than that of two sets being confused by their hashes. Tokens are ordered by how many nodes have
them, and a node is entered under those of its TOKENS least hashes that others have, but the
MET - 1 commonest, which is enough for two nodes with MET common ones to meet. So a passage
in a third of all documents fills no entry.

The nodes of an entry stand in a signature tree, whose nodes hold the OR of the sketches'
bitmaps and the range of set sizes. A dual traversal drops pairs of tree nodes whose
common bits or sizes rule out any link, and pairs that lie in one component already. In
the first pass a few entries of each node send a forest of their likely links; they are verified
on the whole sets, and their components found. The second pass settles every remaining pair
between different components that the bounds allow, in the entry of the least token under
which both are entered, so that each pair is looked at once. First the entries name their
members with such pairs; then these members come with their whole sets, and each entry verifies
its pairs in place and sends a forest of the links. Rows are members or links
of forests, so they grow with the documents: no group sends its pairs, whether they link or not.

Null or word-less text has an empty set and links with nothing. Rows that repeat an id each get a
row. A null id is never a component's id; a class of rows that all lack an id has no links. An empty table gives an empty result. Columns other than the
two named are neither read nor met.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stonefly.llm.common import drop_tables, mix64, release_memory, run_dir, shuffle_partitions, slices, text_buffers, write_table
from stonefly.llm.components import connected

#: Hashes of a sketch, and how many of them a linked pair shares but with a probability of 1e-13; forests take pairs from LIKELY on.
SKETCH, SHARED, LIKELY = 96, 46, 77
#: A node is entered under tokens among its TOKENS least hashes, of which linked pairs share MET.
TOKENS, MET = 28, 5
#: Entries of a node in the first pass.
FIRST = 4
#: Hashes of sets that a task that verifies pairs keeps (32 MB).
KEPT = 1 << 22
#: Bytes of text (one text at least) whose words a task holds at once; the arrays over them take some 60 times that.
SLICE = 1 << 19
BITS, LEAF, SMALL = 1024, 128, 6
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS: list[np.ndarray] = []


def word_places(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of each word of all texts, and how many words each text has."""
    space = _SPACE[raw]
    inner = np.zeros(len(raw) + 1, bool)
    inner[offsets[1:-1]] = True  # texts end words
    opens = ~space & (np.concatenate([[True], space[:-1]]) | inner[:-1]) if len(raw) else space
    starts = np.flatnonzero(opens)
    stops = np.flatnonzero(~space & (np.concatenate([space[1:], [True]]) | inner[1:])) + 1 if len(raw) else starts
    return starts, stops, np.searchsorted(starts, offsets[1:], side="left") - np.searchsorted(starts, offsets[:-1], side="left")


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and how many words each text has."""
    starts, stops, counts = word_places(raw, offsets)
    if not _POWERS or len(_POWERS[0]) < len(raw) + 1:
        n = max(len(raw) + 1, 1 << 20)
        base = int(MULTIPLIER)
        _POWERS[:] = []
        for b in (base, pow(base, -1, 1 << 64)):
            x = np.full(n, b, np.uint64)
            x[0] = 1
            _POWERS.append(np.multiply.accumulate(x))
    up, down = _POWERS
    sums = np.zeros(len(raw) + 1, np.uint64)
    letters = mix64(_LOWER[raw].astype(np.uint64) + np.uint64(1)) | np.uint64(1)
    np.cumsum(letters * down[: len(raw)], out=sums[1:])
    h = mix64((sums[stops] - sums[starts]) * up[starts] + (stops - starts).astype(np.uint64))
    return h, counts


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """Each text's shingles as ascending distinct hashes."""
    return sets_between(*text_buffers(texts), words)


def sets_between(raw: np.ndarray, offsets: np.ndarray, words: int, least: int = 1) -> list[np.ndarray]:
    """The shingles of each run of bytes between two offsets; runs of fewer than ``least`` words have none."""
    h, counts = word_hashes(raw, offsets)
    n = len(h)
    ends = np.cumsum(counts)
    if n >= words:
        joined = np.zeros(n - words + 1, np.uint64)
        for k in range(words):
            joined = mix64(joined * MULTIPLIER + h[k : n - words + 1 + k])
    else:
        joined = np.zeros(0, np.uint64)
    out = []
    for end, m in zip(ends.tolist(), counts.tolist(), strict=True):
        if m < max(1, least):
            out.append(np.zeros(0, np.uint64))
        elif m >= words:
            out.append(np.unique(joined[end - m : end - words + 1]))
        else:
            whole = np.array([m], np.uint64)
            for x in h[end - m : end]:
                whole = mix64(whole * MULTIPLIER + x)
            out.append(whole)
    return out


def set_rows(docs: DataFrame, words: int) -> DataFrame:
    """Of each row: its id, the hash of its text (h), the size of its set, the set's hash (node) and its sketch."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text", SLICE)):
            sets = shingle_sets(batch.column("text"), words)
            nodes = [xxhash.xxh3_64_intdigest(x.tobytes()) - (1 << 63) if len(x) else None for x in sets]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("h"), pa.array([len(x) for x in sets], pa.int64()), pa.array(nodes, pa.int64()), pa.array([x[:SKETCH].view(np.int64) for x in sets], pa.list_(pa.int64()))], names=["doc_id", "h", "n_shingles", "node", "sketch"])
        _POWERS.clear()
        release_memory()

    return docs.mapInArrow(read, f"doc_id {kind}, h long, n_shingles long, node long, sketch array<long>")


class TreeNode:
    """A run of an entry's members: OR of their bitmaps, range of sizes, and their component if they share one.

    ``slack`` is the most tokens by which a member's bits fall short of its tokens, so that members of two
    tree nodes have at most as many common tokens as the nodes have common bits, and the less slack.
    """

    __slots__ = ("bits", "low", "high", "first", "last", "kids", "root", "slack", "tokens", "at")

    def __init__(self, first: int, last: int, flat: np.ndarray, ends: np.ndarray, sizes: np.ndarray, roots: np.ndarray) -> None:
        self.first, self.last, self.tokens, self.at = first, last, None, None
        if last - first <= LEAF:
            self.kids = None
            counts = np.diff(ends[first : last + 1])
            bits = np.zeros((last - first, BITS), bool)
            bits[np.repeat(np.arange(last - first), counts), (flat[ends[first] : ends[last]] % np.uint64(BITS)).astype(np.int64)] = True
            self.bits = int.from_bytes(np.packbits(bits.any(axis=0)).tobytes())
            self.low, self.high, self.slack = int(sizes[first:last].min()), int(sizes[first:last].max()), int((counts - bits.sum(axis=1)).max())
            self.root = int(roots[first]) if (roots[first:last] == roots[first]).all() else None
        else:
            middle = (first + last) // 2
            a, b = TreeNode(first, middle, flat, ends, sizes, roots), TreeNode(middle, last, flat, ends, sizes, roots)
            self.kids = (a, b)
            self.bits, self.low, self.high, self.slack = a.bits | b.bits, min(a.low, b.low), max(a.high, b.high), max(a.slack, b.slack)
            self.root = a.root if a.root == b.root else None


def needed(a: int, b: int, percent: int, forest: bool) -> int:
    """How many tokens two sketches must share at least for sets of (at least) a and b shingles to link."""
    if max(a, b) > SKETCH:
        return LIKELY if forest else SHARED
    return max(1, -(-percent * (a + b) // (100 + percent)))


def common_tokens(x: TreeNode, y: TreeNode, flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many tokens each member of one leaf has in common with each of the other."""
    for leaf in (x, y):
        if leaf.tokens is None:
            leaf.tokens, leaf.at = np.unique(flat[ends[leaf.first] : ends[leaf.last]], return_inverse=True)
    tokens = x.tokens if x is y else np.intersect1d(x.tokens, y.tokens, assume_unique=True)
    dense = []
    for leaf in (x,) if x is y else (x, y):
        column = np.full(len(leaf.tokens), -1)
        column[np.searchsorted(leaf.tokens, tokens)] = np.arange(len(tokens))
        column = column[leaf.at]
        hit = column >= 0
        m = np.zeros((leaf.last - leaf.first, len(tokens)), np.float32)
        m[np.repeat(np.arange(len(m)), np.diff(ends[leaf.first : leaf.last + 1]))[hit], column[hit]] = 1
        dense.append(m)
    return dense[0] @ dense[-1].T


def small_entry(nodes: np.ndarray, sizes: np.ndarray, roots: np.ndarray, sketches: list[np.ndarray], percent: int, forest: bool) -> list[tuple[int, int]]:
    """``entry_pairs`` of few members: one leaf, compared by sets."""
    node, size, parent = nodes.tolist(), sizes.tolist(), roots.tolist()
    sets = [frozenset(x.tolist()) for x in sketches]
    out = []
    for i in range(len(node)):
        for j in range(i + 1, len(node)):
            a, b = size[i], size[j]
            if parent[i] != parent[j] and 100 * min(a, b) >= percent * max(a, b) and len(sets[i] & sets[j]) >= needed(a, b, percent, forest):
                out.append((node[i], node[j]))
                if forest:
                    old, new = parent[i], parent[j]
                    parent = [new if p == old else p for p in parent]
    return out


def entry_pairs(nodes: np.ndarray, sizes: np.ndarray, roots: np.ndarray, sketches: list[np.ndarray], percent: int, forest: bool) -> list[tuple[int, int]]:
    """Pairs of nodes of one entry that may link; of each member its node, set size, component and sketch.

    Sketches of up to SKETCH shingles are whole sets, for which the test is exact. ``forest``: only likely
    links, and no more of them than connect the members; otherwise all that the bounds allow between different
    components, whose members stand together in the tree.
    """
    if len(nodes) <= SMALL:
        return small_entry(nodes, sizes, roots, sketches, percent, forest)
    least = np.array([x[:2] if len(x) > 1 else [x[0], x[0]] for x in sketches])
    order = np.lexsort((nodes, sizes, least[:, 1], least[:, 0], np.zeros(len(nodes)) if forest else roots))
    nodes, sizes, sketches = nodes[order], sizes[order], [sketches[k] for k in order]
    roots = np.unique(roots[order], return_inverse=True)[1]
    flat, ends = np.concatenate(sketches), np.cumsum([0, *(len(x) for x in sketches)])
    tree = TreeNode(0, len(nodes), flat, ends, sizes, roots)
    parent = list(range(int(roots.max()) + 1))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out: list[tuple[int, int]] = []

    def compare(x: TreeNode, y: TreeNode) -> None:
        a, b = sizes[x.first : x.last, None], sizes[None, y.first : y.last]
        least = np.where(np.maximum(a, b) > SKETCH, needed(SKETCH + 1, 0, percent, forest), np.maximum(1, -(-percent * (a + b) // (100 + percent))))
        ok = (common_tokens(x, y, flat, ends) >= least) & (100 * np.minimum(a, b) >= percent * np.maximum(a, b))
        if x is y:
            ok = np.triu(ok, 1)
        left, right = roots[x.first : x.last], roots[y.first : y.last]
        while ok.any():
            if forest:
                left, right = (np.array([find(k) for k in roots[z.first : z.last].tolist()]) for z in (x, y))
            ok &= left[:, None] != right[None, :]
            if not forest:
                rows, columns = np.nonzero(ok)
                out.extend(zip(nodes[x.first + rows].tolist(), nodes[y.first + columns].tolist(), strict=True))
                return
            rows, columns = np.flatnonzero(ok.any(axis=1)), np.flatnonzero(ok.any(axis=0))
            for i, j in [*zip(rows, ok[rows].argmax(axis=1), strict=True), *zip(ok[:, columns].argmax(axis=0), columns, strict=True)]:
                p, q = find(int(roots[x.first + i])), find(int(roots[y.first + j]))
                if p != q:
                    parent[p] = q
                    out.append((int(nodes[x.first + i]), int(nodes[y.first + j])))

    stack = [(tree, tree)]
    while stack:
        x, y = stack.pop()
        if x.root is not None and x.root == y.root:
            continue
        if 100 * x.high < percent * y.low or 100 * y.high < percent * x.low:
            continue
        if (x.bits & y.bits).bit_count() + min(x.slack, y.slack) < min(needed(x.low, y.low, percent, forest), needed(SKETCH + 1, 0, percent, forest)):
            continue
        if x.kids is None and y.kids is None:
            compare(x, y)
        elif y.kids is None or x.kids is not None and x.last - x.first > y.last - y.first:
            stack += [(k, y) for k in x.kids]
        elif x is y:
            a, b = x.kids
            stack += [(a, b), (a, a), (b, b)]
        else:
            stack += [(x, k) for k in y.kids]
    return out


class Entry:
    """The members of one entry (a run of a token's nodes), for the second pass.

    Of each member: node, set size, component, the tokens under which it is entered (``own``), and its
    set, of which the first pass's sketch is the beginning, or just that sketch.
    """

    def __init__(self, token: int, nodes: np.ndarray, sizes: np.ndarray, roots: np.ndarray, own: list[np.ndarray], sets: list[np.ndarray], percent: int) -> None:
        several = np.bincount(np.unique(roots, return_inverse=True)[1])[np.unique(roots, return_inverse=True)[1]] > 1
        # members of one component stand together, the others by their least tokens, so that those which meet elsewhere are near
        first = np.array([x[0] for x in own])
        second = np.array([x[1] if len(x) > 1 else x[0] for x in own])
        order = np.lexsort((nodes, sizes, second, first, np.where(several, roots, -1), several))
        self.token, self.percent = token, percent
        self.nodes, self.sizes, self.roots = nodes[order], sizes[order], np.unique(roots[order], return_inverse=True)[1]
        self.sets = [sets[k] for k in order]
        self.sketches = self.packed([x[:SKETCH] for x in self.sets])
        lesser = [own[k][own[k] < token] for k in order]
        self.lesser = self.packed([x.view(np.uint64) for x in lesser])
        self.whole = None
        self.tree = TreeNode(0, len(nodes), *self.sketches, self.sizes, self.roots)
        self.shared: dict[int, frozenset] = {}
        self._share(self.tree, [frozenset(x.tolist()) for x in lesser])
        self.cache: dict[tuple[int, int], tuple] = {}

    @staticmethod
    def packed(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([np.zeros(0, np.uint64), *sets]), np.cumsum([0, *map(len, sets)])

    def _share(self, x: TreeNode, lesser: list[frozenset]) -> frozenset:
        """Lesser tokens that all members below a tree node have: two such nodes' pairs all belong to another entry."""
        mine = frozenset.intersection(*lesser[x.first : x.last]) if x.kids is None else self._share(x.kids[0], lesser) & self._share(x.kids[1], lesser)
        self.shared[id(x)] = mine
        return mine

    def common(self, kind: int, x: TreeNode, y: TreeNode, packed: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """How many values each member of one leaf shares with each of the other."""
        flat, ends = packed
        for leaf in (x, y):
            if (kind, leaf.first) not in self.cache:
                self.cache[kind, leaf.first] = np.unique(flat[ends[leaf.first] : ends[leaf.last]], return_inverse=True)
        tokens = self.cache[kind, x.first][0] if x is y else np.intersect1d(self.cache[kind, x.first][0], self.cache[kind, y.first][0], assume_unique=True)
        dense = []
        for leaf in (x,) if x is y else (x, y):
            values, at = self.cache[kind, leaf.first]
            column = np.full(len(values), -1)
            column[np.searchsorted(values, tokens)] = np.arange(len(tokens))
            column = column[at]
            hit = column >= 0
            m = np.zeros((leaf.last - leaf.first, len(tokens)), np.float32)
            m[np.repeat(np.arange(len(m)), np.diff(ends[leaf.first : leaf.last + 1]))[hit], column[hit]] = 1
            dense.append(m)
        return dense[0] @ dense[-1].T

    def leaf_pairs(self) -> Iterator[tuple[TreeNode, TreeNode, np.ndarray]]:
        """Pairs of leaves, and which pairs of their members may link and belong to this entry."""
        percent, stack = self.percent, [(self.tree, self.tree)]
        while stack:
            x, y = stack.pop()
            if x.root is not None and x.root == y.root:
                continue
            if 100 * x.high < percent * y.low or 100 * y.high < percent * x.low:
                continue
            if self.shared[id(x)] & self.shared[id(y)]:
                continue
            if (x.bits & y.bits).bit_count() + min(x.slack, y.slack) < min(needed(x.low, y.low, percent, False), SHARED):
                continue
            if x.kids is None and y.kids is None:
                a, b = self.sizes[x.first : x.last, None], self.sizes[None, y.first : y.last]
                ok = (100 * np.minimum(a, b) >= percent * np.maximum(a, b)) & (self.roots[x.first : x.last, None] != self.roots[None, y.first : y.last])
                if x is y:
                    ok = np.triu(ok, 1)
                if ok.any():
                    least = np.where(np.maximum(a, b) > SKETCH, SHARED, np.maximum(1, -(-percent * (a + b) // (100 + percent))))
                    ok &= self.common(0, x, y, self.sketches) >= least
                if ok.any() and len(self.lesser[0]):
                    ok &= self.common(1, x, y, self.lesser) == 0
                if ok.any():
                    yield x, y, ok
            elif y.kids is None or x.kids is not None and x.last - x.first > y.last - y.first:
                stack += [(k, y) for k in x.kids]
            elif x is y:
                a, b = x.kids
                stack += [(a, b), (a, a), (b, b)]
            else:
                stack += [(x, k) for k in y.kids]

    def meeting(self) -> np.ndarray:
        """The members that have a pair here."""
        some = np.zeros(len(self.nodes), bool)
        for x, y, ok in self.leaf_pairs():
            some[x.first : x.last] |= ok.any(axis=1)
            some[y.first : y.last] |= ok.any(axis=0)
        return self.nodes[some]

    def links(self) -> list[tuple[int, int]]:
        """Verified links of members with whole sets: a forest that connects what the entry's links connect."""
        self.whole = self.packed(self.sets)
        parent = list(range(int(self.roots.max()) + 1))

        def find(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        out = []
        for x, y, ok in self.leaf_pairs():
            left, right = (np.array([find(k) for k in self.roots[z.first : z.last].tolist()]) for z in (x, y))
            ok &= left[:, None] != right[None]
            if not ok.any():
                continue
            both = self.common(2, x, y, self.whole)
            ok &= 100 * both >= self.percent * (self.sizes[x.first : x.last, None] + self.sizes[None, y.first : y.last] - both)
            for i, j in zip(*np.nonzero(ok), strict=True):
                p, q = find(int(self.roots[x.first + i])), find(int(self.roots[y.first + j]))
                if p != q:
                    parent[p] = q
                    out.append((int(self.nodes[x.first + i]), int(self.nodes[y.first + j])))
        return out


def entries_of(members: DataFrame, column: str, percent: int, links: bool) -> DataFrame:
    """``Entry.meeting`` (token, i, j, node) or ``Entry.links`` (u, v) of all entries; an entry is a run of (token, i, j).

    ``column`` holds the members' sketches or whole sets.
    """
    key = ("token", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entry, runs = None, []

        def flush() -> Iterator[pa.RecordBatch]:
            nodes, sizes, roots = (np.concatenate([x[k] for x in runs]) for k in range(3))
            if len(nodes) < 2 or (roots == roots[0]).all():
                return
            own, sets = ([values[x:y] for r in runs for values, ends in [r[k]] for x, y in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)] for k in (3, 4))
            found = Entry(entry[0], nodes, sizes, roots, own, [x.view(np.uint64) for x in sets], percent)
            if links:
                if pairs := found.links():
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*pairs, strict=True)], names=["u", "v"])
            elif len(met := found.meeting()):
                yield pa.RecordBatch.from_arrays([*(pa.array(np.full(len(met), k), t) for k, t in zip(entry, (pa.int64(), pa.int32(), pa.int32()), strict=True)), pa.array(met)], names=[*key, "node"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in key])
            columns = [batch.column(c).to_numpy() for c in ("node", "n", "root")]
            lists = [(batch.column(c).values.to_numpy(), batch.column(c).offsets.to_numpy()) for c in ("own", column)]
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if (mine := tuple(keys[:, a].tolist())) != entry:
                    if runs:
                        yield from flush()
                    entry, runs = mine, []
                runs.append((*(x[a:b] for x in columns), *((values, ends[a : b + 1]) for values, ends in lists)))
        if runs:
            yield from flush()
        release_memory()

    rows = members.select(*key, "node", "n", "root", "own", column).repartition(shuffle_partitions(members.sparkSession), *key).sortWithinPartitions(*key)
    return rows.mapInArrow(run, "u long, v long" if links else "token long, i int, j int, node long")


def whole_sets(texts: DataFrame, words: int) -> DataFrame:
    """(node, whole): the set of each node as ascending hashes; ``texts``: (node, text)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for every in batches for part in slices(every, "text", SLICE)):
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([x.view(np.int64) for x in shingle_sets(batch.column("text"), words)], pa.list_(pa.int64()))], names=["node", "whole"])
        _POWERS.clear()
        release_memory()

    return texts.select("node", "text").mapInArrow(read, "node long, whole array<long>")


def candidate_pairs(entries: DataFrame, percent: int, forest: bool) -> DataFrame:
    """Distinct pairs (u, v) of nodes from entries (token, i, j, node, n, sketch, root); an entry is a run of (token, i, j)."""
    parts = shuffle_partitions(entries.sparkSession)
    key = ("token", "i", "j")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entry, runs = None, []

        def flush() -> Iterator[pa.RecordBatch]:
            nodes, sizes, roots = (np.concatenate([run[k] for run in runs]) if len(runs) > 1 else runs[0][k] for k in range(3))
            if (roots == roots[0]).all():
                return
            sketches = [values[x:y] for *_, values, ends in runs for x, y in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            pairs = entry_pairs(nodes, sizes, roots, sketches, percent, forest)
            if pairs:
                u, v = np.array(pairs).T
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in key])
            columns = [batch.column(c).to_numpy() for c in ("node", "n", "root")]
            values, ends = batch.column("sketch").values.to_numpy().view(np.uint64), batch.column("sketch").offsets.to_numpy()
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                own = tuple(keys[:, a].tolist())
                if own != entry:
                    if runs:
                        yield from flush()
                    entry, runs = own, []
                runs.append((*(x[a:b] for x in columns), values, ends[a : b + 1]))
        if runs:
            yield from flush()
        release_memory()

    rows = entries.select(*key, "node", "n", "sketch", "root").repartition(parts, *key).sortWithinPartitions(*key)
    return rows.mapInArrow(join, "u long, v long").distinct()


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Those pairs (u, v) whose whole sets are similar enough; ``texts`` (node, text) is a written table."""
    rows = pairs.join(texts.select(F.col("node").alias("u"), F.col("text").alias("x")), "u").join(texts.select(F.col("node").alias("v"), F.col("text").alias("y")), "v")

    def own_sets(batch: pa.RecordBatch, node: str, text: str, kept: dict[int, np.ndarray]) -> list[np.ndarray]:
        ids, first = np.unique(batch.column(node).to_numpy(), return_index=True)
        new = [(k, i) for k, i in zip(ids.tolist(), first.tolist(), strict=True) if k not in kept]
        if new:
            kept.update(zip([k for k, _ in new], shingle_sets(batch.column(text).take(pa.array([i for _, i in new])), words), strict=True))
        return [kept[k] for k in batch.column(node).to_pylist()]

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}  # a text stands in many pairs; its set is made once while it is kept
        for whole in batches:
            for batch in slices(whole, "x", SLICE):
                if sum(map(len, kept.values())) > KEPT:
                    kept.clear()
                left, right = own_sets(batch, "u", "x", kept), own_sets(batch, "v", "y", kept)
                keep = []
                for a, b in zip(left, right, strict=True):
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    keep.append(100 * both >= percent * (len(a) + len(b) - both))
                yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))
        kept.clear()
        _POWERS.clear()
        release_memory()

    return rows.select("u", "v", "x", "y").mapInArrow(check, "u long, v long")


def similar_documents(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80, block_nodes: int = 4096) -> DataFrame:
    """One row for each input row: doc_id, n_shingles, component_id (the least id reachable by links)."""
    run = run_dir(spark, "jaccard")
    folder = f"{run}/steps"
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("h"))
    sets = write_table(set_rows(rows, words), f"{folder}/sets")
    nodes = sets.filter("node IS NOT NULL").groupBy("node").agg(F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "h"))).alias("first"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
    nodes = write_table(nodes, f"{folder}/nodes")
    tokens = nodes.select("node", "n", F.explode(F.slice("sketch", 1, TOKENS)).alias("token"))
    often = write_table(tokens.groupBy("token").agg(F.count("*").alias("nodes")).filter("nodes > 1"), f"{folder}/tokens")
    # a node's tokens from the commonest on: of those that it may share, all but the MET - 1 commonest
    entered = tokens.join(often, "token").withColumn("k", F.row_number().over(Window.partitionBy("node").orderBy(F.desc("nodes"), "token")))
    entered = entered.filter((F.col("n") <= TOKENS) | (F.col("k") >= MET)).withColumn("least", F.row_number().over(Window.partitionBy("node").orderBy("token")))
    # a token that very many nodes have is dealt in blocks
    blocks = F.ceil(F.col("nodes") / block_nodes).cast("int")
    entered = write_table(entered.select("token", "node", "least", blocks.alias("blocks"), F.pmod(F.xxhash64("node"), blocks).cast("int").alias("i")), f"{folder}/entered")
    firsts = nodes.join(entered.select("node").distinct(), "node", "left_semi").filter("first IS NOT NULL").select("node", "first.doc_id", "first.h")
    # where ids repeat, only the texts that have the node's set
    texts = write_table(rows.join(firsts, ["doc_id", "h"]).select("node", "text"), f"{folder}/texts")
    sketches = nodes.select("node", "n", "sketch")
    # first pass: likely links within blocks, and between the blocks' least nodes
    some = entered.filter(F.col("least") <= FIRST)
    inside = some.select("token", "i", F.col("i").alias("j"), "node")
    least = some.filter("blocks > 1").groupBy("token", "i").agg(F.min("node").alias("node")).select("token", F.lit(-1).alias("i"), F.lit(-1).alias("j"), "node")
    full = inside.unionByName(least).join(sketches, "node").withColumn("root", F.col("node"))
    likely = write_table(candidate_pairs(full, percent, True), f"{folder}/likely")
    links = write_table(verified(likely, texts, words, percent), f"{folder}/links")
    roots = write_table(connected(links, f"{folder}/first"), f"{folder}/roots")
    # second pass: tokens that lie in several components, each pair of their blocks
    rest = write_table(entered.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), f"{folder}/rooted")
    apart = write_table(rest.groupBy("token").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b").select("token"), f"{folder}/apart")
    rest = rest.join(apart, "token", "left_semi").withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rest = rest.select("token", F.least("i", "o").alias("i"), F.greatest("i", "o").alias("j"), "node", "root")
    own = entered.groupBy("node").agg(F.array_sort(F.collect_set("token")).alias("own"))  # TOKENS at most
    known = write_table(sketches.join(own, "node"), f"{folder}/known")
    rest = rest.distinct()  # a block with itself
    meeting = write_table(entries_of(rest.join(known, "node"), "sketch", percent, False), f"{folder}/meeting")
    wanted = meeting.select("node").distinct()
    whole = write_table(whole_sets(texts.join(wanted, "node", "left_semi"), words), f"{folder}/whole")
    full = meeting.join(known.select("node", "n", "own"), "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).join(whole, "node")
    more = write_table(entries_of(full, "whole", percent, True), f"{folder}/more")
    joined = roots.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(more)
    roots = write_table(connected(joined, f"{folder}/second"), f"{folder}/all-roots")
    least = roots.join(nodes, "node").groupBy("root").agg(F.min("first.doc_id").alias("component_id"))
    found = write_table(roots.join(least, "root").select("node", "component_id"), f"{folder}/components")
    # a class without links is its own component, by its least id; only classes of several rows need it
    alone = nodes.join(found, "node", "left_anti").select("node", F.col("first.doc_id").alias("component_id"))
    named = write_table(found.unionByName(alone), f"{folder}/named")
    out = sets.select("doc_id", "n_shingles", "node").join(named, "node", "left")
    out = write_table(out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")), f"{run}/groups")
    # sets, sketches and texts of a run would lie beside all that comes after it
    drop_tables(folder)
    return out


#: The query's rows in DuckDB SQL (doc_id is unique there).
SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, hash(CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i : i + 4], ' ') END) AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * k >= 80 * (x.n + y.n - k)),
r AS (SELECT doc_id AS u, doc_id AS c FROM documents UNION SELECT e.v, r.c FROM r JOIN e ON e.u = r.u)
SELECT d.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r.c) AS component_id FROM documents d LEFT JOIN n USING (doc_id) JOIN r ON r.u = d.doc_id GROUP BY d.doc_id
"""
