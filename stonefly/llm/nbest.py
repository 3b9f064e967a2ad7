"""N-best segmentation with a SentencePiece model, and decoding.

The lattice of a text has an edge for every piece of the vocabulary, weighted with the
piece's score; a character that no piece covers is an edge of its UTF-8 bytes' pieces. The
best paths are found by a forward Viterbi pass and a backward A-star search from the end of
the text: the forward scores are exact, so hypotheses leave the agenda in order of their
final score. Ties: the path whose ids, read from the end, are smaller comes first, as far as the last
TAIL ids of a chunk tell. A place that n hypotheses have left is not left again, and hypotheses worse
than n paths that are known are not kept, so the search is linear in a run without blanks.

No piece goes from another character to a blank (nor, where the vocabulary is so, between Latin
letters and other characters), so the lattice falls apart there, and paths of a text are combined from those of its chunks: the n best change at
most n - 1 chunks, which are among those with the least loss. Chunks are searched once in a
worker and kept (CACHE_CHUNKS of them). Blanks stand as U+2581, one more in front, as in the
model's own normaliser; a text that holds that character itself decodes it as a blank.

Null text is empty; an empty text has one path, without ids.
Every input row gives its own rows, repeated ones too; an empty table gives an empty result.
Columns other than the two named are neither read nor met.
"""

from __future__ import annotations

import heapq
import math
import re
import struct
import zlib
from bisect import insort
from collections.abc import Iterator
from operator import neg

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stonefly.llm.common import slices

BLANK = "▁"
LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
CACHE_CHUNKS, CACHE_CHARS = 1_000_000, 32
#: Last ids of a path that settle ties.
TAIL = 64
#: What an uncovered character costs beside the least score of the vocabulary.
UNKNOWN = 10.0

_SEGMENTERS: dict[tuple[str, int], Segmenter] = {}


def segmenter(path: str, n: int) -> Segmenter:
    if (path, n) not in _SEGMENTERS:
        _SEGMENTERS[path, n] = Segmenter(path, n)
    return _SEGMENTERS[path, n]


#: Of a chunk: the best path's score, what the second path loses, whether that one's ids, read from the end, are
#: smaller than the best's; and the best path's ids as bytes, and whether they decode to the chunk.
Chunk = tuple[float, float, bool, bytes, bool]


class Segmenter:
    """The n best paths of texts in the piece lattice of one model."""

    def __init__(self, path: str, n: int) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.n = n
        self.pieces: dict[str, tuple[int, float]] = {}
        self.bytes: dict[int, int] = {}
        self.text: list[bytes] = []
        for k in range(model.get_piece_size()):
            piece = model.id_to_piece(k)
            if model.is_byte(k):
                self.bytes[int(piece[1:-1], 16)] = k
                self.text.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(k) or model.is_unknown(k) or model.is_unused(k):
                self.text.append(b"")
            else:
                self.pieces[piece] = (k, model.get_score(k))
                self.text.append(piece.replace(BLANK, " ").encode())
        if any(re.search(f"[^{BLANK}]{BLANK}", x) for x in self.pieces):
            raise ValueError("a piece goes from another character to a blank")
        # where no piece goes between Latin letters and others either, the lattice falls apart there, too
        fine = re.compile(f"{BLANK}*[{LATIN}]+|{BLANK}*[^{LATIN}{BLANK}]+|{BLANK}+")
        coarse = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")
        self.chunks = fine if all(fine.fullmatch(x) for x in self.pieces) else coarse
        self.longest = max(map(len, self.pieces))
        # letters to what may follow them; "" holds the piece that ends here
        self.trie: dict = {}
        for piece, (k, score) in self.pieces.items():
            node = self.trie
            for letter in piece:
                node = node.setdefault(letter, {})
            node[""] = ((k,), score)
        self.least = min(s for _, s in self.pieces.values()) - UNKNOWN
        self.found: dict[str, Chunk] = {}
        self.several: dict[str, tuple[list[float], list[bytes], list[bool]]] = {}

    def search(self, chunk: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """(score, ids) of the n best paths of a chunk, the best first."""
        m, pieces, longest = len(chunk), self.pieces, self.longest
        best = [0.0] + [-1e300] * m  # forward: the best score of the text before each place
        edges: list[list[tuple[int, float, tuple[int, ...]]]] = [[] for _ in range(m + 1)]
        for i in range(m):
            here, node, j = best[i], self.trie, i
            for letter in chunk[i : i + longest]:
                node = node.get(letter)
                if node is None:
                    break
                j += 1
                got = node.get("")
                if got:
                    k, score = got
                    edges[j].append((i, score, k))
                    if here + score > best[j]:
                        best[j] = here + score
            if chunk[i] not in pieces:
                ids = tuple(self.bytes[b] for b in chunk[i].encode())
                edges[i + 1].append((i, self.least, ids))
                best[i + 1] = max(best[i + 1], here + self.least)
        # backward from the end. A hypothesis is an end part (the piece in front, what is behind it) and the best way to
        # it, so its total is that of a whole path, and hypotheses on the agenda are different paths. Equal totals are
        # settled by their last ids, then by the order in which they were made.
        agenda: list[tuple] = [(-best[m], (), 0, (None, ()), m, 0.0)]
        tops = [best[m]]  # the best totals of different paths known, n at most
        left = [n] * (m + 1)  # a place left by n hypotheses has no part in the n best by any other
        out, made, limit = [], 0, -math.inf
        while agenda and len(out) < n:
            total, tail, _, node, at, behind = heapq.heappop(agenda)
            if not at:
                ids: list[int] = []
                while node:
                    ids += node[1]
                    node = node[0]
                out.append((-total, tuple(ids)))
                continue
            if not left[at]:
                continue
            left[at] -= 1
            ways = []
            for i, score, own in edges[at]:
                way = best[i] + score + behind
                if way >= limit:
                    ways.append((way, own, i, score + behind))
            if len(ways) > 1:
                ways.sort(reverse=True)
                for way, *_ in ways[1:]:  # the first way is the hypothesis's own path
                    insort(tops, way, key=neg)
                del tops[n:]
                if len(tops) == n:
                    limit = tops[-1] - 1e-9  # n paths are better than any below
            for way, own, i, after in ways:
                made += 1
                heapq.heappush(agenda, (-way, tail + own[::-1] if len(tail) < TAIL else tail, made, (node, own), i, after))
        return out

    def all_paths(self, chunk: str) -> tuple[list[float], list[bytes], list[bool]]:
        """Scores, ids as bytes, and whether they decode to the chunk, of its n best paths; those of short chunks are kept."""
        if (got := self.several.get(chunk)) is not None:
            return got
        found = self.search(chunk, self.n)
        whole = chunk.replace(BLANK, " ").encode()
        got = [x for x, _ in found], [struct.pack(f"<{len(ids)}I", *ids) for _, ids in found], [b"".join([self.text[k] for k in ids]) == whole for _, ids in found]
        if len(chunk) <= CACHE_CHARS and len(self.several) < CACHE_CHUNKS // 20:
            self.several[chunk] = got
        return got

    def entry(self, chunk: str) -> Chunk:
        """What texts need of a chunk, kept for short ones."""
        found = self.search(chunk, 2)
        score, ids = found[0]
        loss, lesser = (score - found[1][0], found[1][1][::-1] < ids[::-1]) if len(found) > 1 else (math.inf, False)
        exact = b"".join([self.text[k] for k in ids]) == chunk.replace(BLANK, " ").encode()
        got = (score, loss, lesser, struct.pack(f"<{len(ids)}I", *ids), exact)
        if len(chunk) <= CACHE_CHARS and len(self.found) < CACHE_CHUNKS:
            self.found[chunk] = got
        return got

    def packed_nbest(self, text: str) -> list[tuple[float, bytes, bool]]:
        """(score, ids as bytes, do they decode to the text) of the n best paths of a text, the best first."""
        if not text:
            return [(0.0, b"", True)]
        get, make = self.found.get, self.entry
        names = self.chunks.findall(BLANK + text.replace(" ", BLANK))
        scores, losses, lesser, first, exacts = zip(*[get(x) or make(x) for x in names], strict=True)
        score = sum(scores)
        plain = BLANK not in text
        exact = plain and all(exacts)
        # the chunks with the least loss by their second path; all other ones stay at their best. Of equal losses
        # those come first whose change makes the ids smaller, read from the text's end
        loss = np.array(losses)
        few = self.n - 1
        if few and len(loss) > 2 * few:
            near = np.flatnonzero(loss <= np.partition(loss, few - 1)[few - 1]).tolist()
        else:
            near = range(len(loss))
        order = sorted((losses[k], not lesser[k], -k if lesser[k] else k, k) for k in near if losses[k] < math.inf)
        places = [x[3] for x in order[:few]]
        every = {k: self.all_paths(names[k]) for k in places}  # of these chunks alone
        picks, seen = [], set()
        agenda = [(0.0, (0,) * len(places))]
        while agenda and (len(picks) < self.n or agenda[0][0] <= picks[-1][0]):
            lost, pick = heapq.heappop(agenda)
            if pick in seen:
                continue
            seen.add(pick)
            picks.append((lost, pick))
            for i, k in enumerate(places):
                own = every[k][0]
                if pick[i] + 1 < len(own):
                    heapq.heappush(agenda, (lost + own[pick[i]] - own[pick[i] + 1], (*pick[:i], pick[i] + 1, *pick[i + 1 :])))
        best = b"".join(first)
        starts = {k: sum(map(len, first[:k])) for k in places}
        out = []
        for lost, pick in picks:
            packed, fine, shift = best, exact, 0
            for k, i in sorted(zip(places, pick, strict=True)):
                if i:
                    a = starts[k] + shift
                    packed = packed[:a] + every[k][1][i] + packed[a + len(first[k]) :]
                    shift += len(every[k][1][i]) - len(first[k])
            if plain and any(pick):
                changed = dict(zip(places, pick, strict=True))
                fine = exact or all([x for k, x in enumerate(exacts) if not changed.get(k)])
                fine = fine and all(every[k][2][i] for k, i in changed.items())
            out.append((score - lost, packed, fine))
        if len({x[0] for x in out}) < len(out):  # equal scores
            out.sort(key=lambda x: (-x[0], np.frombuffer(x[1], "<u4")[::-1].astype(">u4").tobytes()))
        return out[: self.n]

    def nbest(self, text: str) -> list[tuple[float, list[int]]]:
        """(score, ids) of the n best paths of a text, the best first; an empty text has one path without ids."""
        return [(score, np.frombuffer(packed, "<u4").tolist()) for score, packed, _ in self.packed_nbest(text)]

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the blank in front goes."""
        return b"".join([self.text[k] for k in ids]).decode("utf-8", "replace")[1:]


def nbest_segmentations(docs: DataFrame, model: str, n: int = 3, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """For each row its n best segmentations: doc_id, rank (from 1), score, n_pieces, ids_crc32, round_trip (and ids)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = segmenter(model, n)
        for batch in (part for whole in batches for part in slices(whole, "text", 1 << 20)):
            at, rest = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                for rank, (score, packed, exact) in enumerate(own.packed_nbest(text or ""), 1):
                    at.append(i)
                    rest.append((rank, score, len(packed) // 4, zlib.crc32(packed), exact, packed))
            columns = list(zip(*rest, strict=True))
            kinds = [pa.int32(), pa.float64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()][: 5 + with_ids]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(at)), *(pa.array(x, k) for x, k in zip(columns[: 5 + with_ids], kinds, strict=True))], names=["doc_id", "rank", "score", "n_pieces", "ids_crc32", "round_trip", "ids"][: 6 + with_ids])

    return rows.mapInArrow(run, f"doc_id {kind}, rank int, score double, n_pieces long, ids_crc32 long, round_trip boolean" + ", ids binary" * with_ids)
