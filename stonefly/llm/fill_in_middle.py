"""Fill-in-middle transformation by displacement scatter, and its inverse by gather.

A text is cut into units ``[A-Za-z]+|[^A-Za-z]`` (matched left to right over code
points); two cuts drawn from a hash of the id divide it into prefix, middle and suffix.
The output holds the parts between the marks ``<P>``, ``<S>`` and ``<M>``:

* ``psm``: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle
* ``spm``: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle
* ``plain``: the text itself, where it is empty, holds a mark already, or the draw says so

The texts of an Arrow batch stand as one array of UTF-8 bytes. A scan finds the bytes
where units start, hence the cuts. Every byte of a part moves by the same number of
places, so a difference array with one entry at each part's start, summed up, is every
byte's displacement; one scatter puts all bytes into the output. ``restore`` needs output
and form alone: it finds the marks (they can't arise across a boundary, since no mark's
end is the start of another), and one gather with the inverse displacements gives the
texts. Displacements are made for ``BLOCK`` bytes at a time and batches are cut to a few
megabytes, so memory stays near the size of the batch's bytes, whatever one text's length.

Null text counts as empty: plain, no units, empty output. A null id is drawn as the hash
of ``1:``. Equal (id, text) rows give equal results, and every input row gives one row;
an empty table gives an empty result. Only the columns named are read, so further
columns don't matter; names of ``keep`` must differ from those that are added.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stonefly.llm.common import slices, string_array, text_buffers

#: Bytes whose displacements are held at once.
BLOCK = 1 << 20
#: The marks of prefix, suffix and middle, as the contract fixes them: three bytes each.
MARKS = {"P": b"<P>", "S": b"<S>", "M": b"<M>"}
MARK = 3


def unit_starts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """By byte: does a unit start here? Letters go on with the letter before them in the same text."""
    low = raw | 0x20
    letter = (low >= 97) & (low <= 122)
    starts = (raw & 0xC0) != 0x80
    follows = letter.copy()
    follows[1:] &= letter[:-1]
    follows[:1] = False
    follows[offsets[:-1][offsets[:-1] < len(raw)]] = False
    return starts & ~follows


def count_between(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many of ``mask`` hold before each bound (bounds ascend); the mask is read in blocks."""
    edges = np.arange(0, len(mask) + BLOCK, BLOCK)
    whole = np.concatenate([[0], np.cumsum([np.count_nonzero(mask[a : a + BLOCK]) for a in edges[:-1]], dtype=np.int64)]) if len(mask) else np.zeros(1, np.int64)
    out = np.zeros(len(bounds), np.int64)
    block = bounds // BLOCK
    for b in np.unique(block):
        own = block == b
        inside = np.concatenate([[0], np.cumsum(mask[b * BLOCK : (b + 1) * BLOCK], dtype=np.int64)])
        out[own] = whole[b] + inside[bounds[own] - b * BLOCK]
    return out


def place_of(mask: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The place of the rank-th set entry of ``mask`` (from 0); the mask's length beyond the last."""
    sizes = np.array([np.count_nonzero(mask[a : a + BLOCK]) for a in range(0, len(mask), BLOCK)], np.int64)
    ends = np.cumsum(sizes)
    out = np.full(len(ranks), len(mask), np.int64)
    block = np.searchsorted(ends, ranks, side="right")
    for b in np.unique(block[block < len(sizes)]):
        own = block == b
        out[own] = b * BLOCK + np.flatnonzero(mask[b * BLOCK : (b + 1) * BLOCK])[ranks[own] - (ends[b] - sizes[b])]
    return out


def displaced(starts: np.ndarray, shifts: np.ndarray, total: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Blocks (from, to, places): byte i goes to i plus the shift of the last part that starts at or before it.

    ``starts`` ascend and may repeat (empty parts: the last one counts). The shifts
    become a difference array, which a running sum turns into displacements.
    """
    steps = np.diff(shifts, prepend=0)
    carry = 0
    for a in range(0, total, BLOCK):
        b = min(total, a + BLOCK)
        i, j = np.searchsorted(starts, [a, b])
        change = np.zeros(b - a, np.int64)
        np.add.at(change, starts[i:j] - a, steps[i:j])
        if b > a:
            change[0] += carry
        shift = np.cumsum(change)
        carry = int(shift[-1])
        yield a, b, shift + np.arange(a, b)


def marks_in(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all marks that lie within one text, and the text of each."""
    if len(raw) < MARK:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(raw[:-2] == ord("<"))
    at = at[raw[at + 2] == ord(">")]
    at = at[np.isin(raw[at + 1], [ord(x) for x in MARKS])]
    doc = np.searchsorted(offsets, at, side="right") - 1
    inside = at + MARK <= offsets[doc + 1]
    return at[inside], doc[inside]


def scatter(raw: np.ndarray, offsets: np.ndarray, draws: np.ndarray, plain_percent: int = 10, spm_percent: int = 20) -> dict[str, np.ndarray]:
    """Output bytes and figures of a batch. ``draws`` (texts, 4): the four unsigned numbers of each text.

    Keys: raw and offsets of the output, n, form (0 plain, 1 psm, 2 spm), prefix_chars, middle_chars.
    """
    sizes = np.diff(offsets)
    starts = unit_starts(raw, offsets)
    before = count_between(starts, offsets)
    n = np.diff(before)
    plain = (n == 0) | (draws[:, 2] % 100 >= 100 - plain_percent)
    plain[marks_in(raw, offsets)[1]] = True
    form = np.where(plain, 0, np.where(draws[:, 3] % 100 < spm_percent, 2, 1))
    cuts = np.sort(draws[:, :2] % (n[:, None] + 1), axis=1)
    # a cut behind the last unit is the text's end; plain texts have both cuts there
    cut = np.where((cuts == n[:, None]) | plain[:, None], offsets[1:, None], 0)
    inner = cut == 0
    inner &= (offsets[1:] > 0)[:, None]
    cut[inner] = place_of(starts, (before[:-1, None] + cuts)[inner])
    first, second = cut[:, 0], cut[:, 1]
    chars = count_between((raw & 0xC0) != 0x80, np.stack([offsets[:-1], first, second], axis=1).ravel()).reshape(-1, 3)
    prefix, middle, suffix = first - offsets[:-1], second - first, offsets[1:] - second
    moved = sizes + np.where(plain, 0, 3 * MARK)
    out_offsets = np.concatenate([[0], np.cumsum(moved)])
    base = out_offsets[:-1] - offsets[:-1]
    spm = form == 2
    shifts = np.stack([
        base + np.where(plain, 0, np.where(spm, suffix + 2 * MARK, MARK)),
        base + np.where(plain, 0, suffix + 3 * MARK),
        base + np.where(plain, 0, np.where(spm, MARK - prefix - middle, 2 * MARK - middle)),
    ], axis=1).ravel()
    out = np.empty(int(out_offsets[-1]), np.uint8)
    for a, b, places in displaced(np.stack([offsets[:-1], first, second], axis=1).ravel(), shifts, len(raw)):
        out[places] = raw[a:b]
    at = out_offsets[:-1]
    for mark, place in (("P", np.where(spm, at + MARK + suffix, at)), ("S", np.where(spm, at, at + MARK + prefix)), ("M", at + 2 * MARK + prefix + suffix)):
        own = place[~plain]
        for k, byte in enumerate(MARKS[mark]):
            out[own + k] = byte
    return {"raw": out, "offsets": out_offsets, "n": n, "form": form, "prefix_chars": chars[:, 1] - chars[:, 0], "middle_chars": chars[:, 2] - chars[:, 1]}


def gather(raw: np.ndarray, offsets: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes and offsets from outputs and forms alone: the inverse of ``scatter``."""
    cut = form > 0
    at, doc = marks_in(raw, offsets)
    at = at[cut[doc]].reshape(-1, 3)  # three marks in every output that isn't plain
    first, second, third = np.zeros((3, len(form)), np.int64)
    first[cut], second[cut], third[cut] = at.T
    spm = form == 2
    end = offsets[1:]
    # where prefix, suffix and middle stand in the output, and how long they are
    prefix_at, suffix_at, middle_at = np.where(spm, second, first) + MARK, np.where(spm, first, second) + MARK, third + MARK
    prefix = np.where(cut, np.where(spm, third, second) - prefix_at, end - offsets[:-1])
    suffix = np.where(cut, np.where(spm, second, third) - suffix_at, 0)
    middle = np.where(cut, end - middle_at, 0)
    prefix_at = np.where(cut, prefix_at, offsets[:-1])
    out_offsets = np.concatenate([[0], np.cumsum(prefix + middle + suffix)])
    a = out_offsets[:-1]
    starts = np.stack([a, a + prefix, a + prefix + middle], axis=1)
    shifts = np.stack([prefix_at, middle_at, suffix_at], axis=1) - starts
    out = np.empty(int(out_offsets[-1]), np.uint8)
    for lo, hi, places in displaced(starts.ravel(), shifts.ravel(), len(out)):
        out[lo:hi] = raw[places]
    return out, out_offsets


FORMS = pa.array(["plain", "psm", "spm"])


def draws(id_col: str, seed: str) -> Column:
    """The first four 8-digit groups of the hex SHA-256 of ``seed`` and the id, as numbers."""
    digest = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    return F.array(*(F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)))


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = "1:", plain_percent: int = 10, spm_percent: int = 20, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row a document: ``id_col``, ``keep``, n, form, prefix_chars, middle_chars (null if plain) and output."""
    names = [id_col, *keep]
    rows = docs.select(*(F.col(c) for c in names), F.col(text_col).alias("_text"), draws(id_col, seed).alias("_draws"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "_text")):
            raw, offsets = text_buffers(batch.column("_text"))
            drawn = np.asarray(batch.column("_draws").flatten()).reshape(-1, 4)
            got = scatter(raw, offsets, drawn, plain_percent, spm_percent)
            whole = got["form"] == 0
            columns = [*(batch.column(c) for c in names), pa.array(got["n"]), FORMS.take(pa.array(got["form"])), *(pa.array(got[c], mask=whole) for c in ("prefix_chars", "middle_chars")), string_array(got["raw"], got["offsets"], pa.large_string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "n", "form", "prefix_chars", "middle_chars", "output"])

    kinds = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in names)
    return rows.mapInArrow(run, f"{kinds}n long, form string, prefix_chars long, middle_chars long, output string")


def restore(outputs: DataFrame) -> DataFrame:
    """Adds ``restored``, the text rebuilt from the columns output and form alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "output")):
            raw, offsets = text_buffers(batch.column("output"))
            form = np.array([FORMS.to_pylist().index(x) for x in batch.column("form").to_pylist()], np.int64)
            back, at = gather(raw, offsets, form)
            yield pa.RecordBatch.from_arrays([*batch.columns, string_array(back, at, pa.large_string())], names=[*batch.schema.names, "restored"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in outputs.schema)
    return outputs.mapInArrow(run, f"{kinds}, restored string")


def digests(outputs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Figures of each document with the SHA-256 of its output and of the text restored from it."""
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return restore(outputs).select(id_col, "n", "form", "prefix_chars", "middle_chars", digest("output").alias("output_sha256"), digest("restored").alias("restored_sha256"))


#: The query's rows in DuckDB SQL.
SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256(concat('1:', coalesce(CAST(doc_id AS VARCHAR), ''))) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '(?s)[A-Za-z]+|[^A-Za-z]') AS ws FROM d),
h AS (SELECT *, len(ws) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
  CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM u),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
       WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, array_to_string(ws[1:a], '') AS pre, array_to_string(ws[a+1:b], '') AS mid, array_to_string(ws[b+1:n], '') AS suf FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256 FROM p
"""
