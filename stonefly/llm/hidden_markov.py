r"""Language-model scoring by a hidden Markov model trained with Baum-Welch.

Tokens are the words ``[^\x20\x09-\x0D]+`` of a text with A-Z lowered, then one end.

1. **Counts.** Tasks count the words of all texts and send one row a word; Spark adds
   them. ``N`` tokens and ``V`` distinct ones (the end included) are those of training texts.
2. **Symbols.** Words that occur often in training texts, at most ``symbols`` of them, are
   symbols of their own, as is the end. All other words share one symbol, within which a
   word has probability (c + 0.5) / (its tokens + 0.5 * (its words + 1)); one share of 0.5
   is that of words never seen. So the model is a distribution over all sequences of words.
3. **Texts as symbols**, written once. The counts of the ``lookup`` commonest training words and of
   as many commonest others go to the tasks (both bounds hold whatever the corpus); rarer
   words of a text are joined to the table of counts, whose keys then are all rare, so none is hot.
4. **Baum-Welch.** In each of ``rounds`` rounds the model (``states`` rows of symbols) is broadcast;
   tasks run scaled forward and backward recursions over their training texts and send expected
   counts, one row a symbol; Spark adds them and the driver gets ``symbols + states + 4`` rows.
   In training alone, a text longer than ``piece`` tokens is cut into pieces that each have at most
   that many and start from a distribution of their own; every token counts.
   Emissions are drawn towards the corpus's word shares with the weight of ``prior`` tokens.
5. **Scores.** A scaled forward recursion over each whole text, never cut, gives the exact
   log10 probability of its symbols; to it come the shares of the words within the common symbol.

Texts of a batch run through the recursions together, the longest first, one numpy step a
position; memory is bounded by ``GROUP`` tokens (in scoring, by ``GROUP`` plus one text's tokens).

Words are told apart by a 64-bit hash. Null text is empty: just the end. Every input row gives one
row, repeated rows too; null ids aren't held out, see ``held_out``. Without training texts nothing
is known: both scores are 0. An empty table gives an empty result. Only the columns named are
read, so further ones, whatever their names, don't matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stonefly.llm.common import mix64, ragged, run_dir, slices, string_array, text_buffers, write_table

#: Tokens that a task runs through the recursions together.
GROUP = 1 << 19
#: Distinct words that a counting task holds before it sends their counts.
HELD_WORDS = 500_000
LN10 = math.log(10)


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words (as hashes), each word's place among them, and each text's number of words."""
    raw, offsets = text_buffers(texts)
    lists = pc.ascii_split_whitespace(string_array(np.where((raw >= 65) & (raw <= 90), raw | 0x20, raw), offsets))
    flat = lists.flatten()
    real = pc.greater(pc.binary_length(flat), 0)
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    doc = np.repeat(np.arange(len(sizes)), sizes)[real.to_numpy(zero_copy_only=False)]
    words = flat.filter(real).dictionary_encode()
    keys = np.fromiter(map(xxhash.xxh3_64_intdigest, words.dictionary.cast(pa.large_binary()).to_pylist()), np.uint64, len(words.dictionary)).astype(np.int64)
    return keys, words.indices.to_numpy(zero_copy_only=False), np.bincount(doc, minlength=len(sizes))


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, n_train, n_other) over all texts; rows: (text, training)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0

        def flush() -> pa.RecordBatch:
            distinct, place = np.unique(np.concatenate([np.zeros(0, np.int64), *keys]), return_inverse=True)
            both = np.concatenate([np.zeros((2, 0), np.int64), *counts], axis=1)
            total = [np.bincount(place, x, len(distinct)).astype(np.int64) for x in both]
            return pa.RecordBatch.from_arrays([pa.array(distinct), *map(pa.array, total)], names=["word", "n_train", "n_other"])

        for batch in (part for whole in batches for part in slices(whole, "text")):
            words, at, sizes = words_of(batch.column("text"))
            train = np.repeat(batch.column("training").to_numpy(zero_copy_only=False), sizes)
            keys.append(words)
            counts.append(np.stack([np.bincount(at[train], minlength=len(words)), np.bincount(at[~train], minlength=len(words))]))
            held += len(words)
            if held >= 4 * HELD_WORDS:
                part = flush()
                if part.num_rows >= HELD_WORDS:
                    yield part
                    keys, counts, held = [], [], 0
                else:  # mostly repeats: hold them added up
                    keys, counts, held = [np.asarray(part.column("word"))], [np.stack([np.asarray(part.column(c)) for c in ("n_train", "n_other")])], part.num_rows
        yield flush()

    found = rows.select("text", "training").mapInArrow(run, "word long, n_train long, n_other long")
    return found.groupBy("word").agg(F.sum("n_train").alias("n_train"), F.sum("n_other").alias("n_other"))


def common_from(counts: DataFrame, column: str, most: int) -> int:
    """The least count (at a step of a sixteenth of an octave) that at most ``most`` words reach; few rows reach the driver."""
    step = F.floor(F.log2(column) * 16).cast("int")
    found = counts.filter(F.col(column) > 0).groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("least")).collect()
    held, least = 0, 1 << 62
    for r in sorted(found, key=lambda r: -r["step"]):
        held += r["n"]
        if held > most:
            break
        least = r["least"]
    return least


@dataclass
class Vocabulary:
    """Totals of the training texts, and the words whose counts every task knows (sorted by hash).

    ``symbol``: a word's symbol; the words without one of their own have ``rare``, the end ``end``.
    """

    tokens: int
    distinct: int
    words: np.ndarray
    counts: np.ndarray
    symbol: np.ndarray
    own: int
    ends: int

    @property
    def rare(self) -> int:
        return self.own

    @property
    def end(self) -> int:
        return self.own + 1

    @property
    def rare_tokens(self) -> int:
        return self.tokens - self.ends - int(self.counts[self.symbol < self.own].sum())

    @property
    def rare_distinct(self) -> int:
        return self.distinct - (self.ends > 0) - self.own

    def unigram(self, c):
        """Natural log of a token's share by its count."""
        return np.log((c + 0.5) / (self.tokens + 0.5 * (self.distinct + 1)))

    def within_rare(self, c):
        """Natural log of a word's share of the common symbol."""
        return np.log((c + 0.5) / (self.rare_tokens + 0.5 * (self.rare_distinct + 1)))

    def shares(self) -> np.ndarray:
        """Shares of all symbols; they add up to one."""
        of = np.zeros(self.own + 2)
        mine = self.symbol < self.own
        of[self.symbol[mine]] = self.counts[mine] + 0.5
        of[self.rare] = self.rare_tokens + 0.5 * (self.rare_distinct + 1)
        of[self.end] = self.ends + 0.5 if self.ends else 0.0
        return of / of.sum()


def vocabulary(counts: DataFrame, texts: int, symbols: int, lookup: int) -> tuple[Vocabulary, int]:
    """The vocabulary, and the count from which its table holds every training word."""
    total = counts.agg(F.sum("n_train").alias("n"), F.count(F.when(F.col("n_train") > 0, 1)).alias("v")).first()
    least_symbol, least = common_from(counts, "n_train", symbols), common_from(counts, "n_train", lookup)
    others = counts.filter(F.col("n_train") < least)
    known = counts.filter(F.col("n_train") >= least).select("word", "n_train").union(others.filter(F.col("n_other") >= common_from(others, "n_other", lookup)).select("word", "n_train"))
    table = known.toArrow()  # at most twice `lookup` rows
    words, n = np.asarray(table["word"], np.int64), np.asarray(table["n_train"], np.int64)
    order = np.argsort(words)
    words, n = words[order], n[order]
    mine = n >= least_symbol
    symbol = np.where(mine, np.cumsum(mine) - 1, mine.sum()).astype(np.int32)
    return Vocabulary((total["n"] or 0) + texts, total["v"] + (texts > 0), words, n, symbol, int(mine.sum()), texts), least


def encode(rows: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Texts as symbols, with sums over the words that the table knows; the others as words and numbers."""
    shared = rows.sparkSession.sparkContext.broadcast(vocab)
    keep = ["doc_id", "held_out", "training"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        for batch in (part for whole in batches for part in slices(whole, "text")):
            words, at, sizes = words_of(batch.column("text"))
            texts = len(sizes)
            place = np.minimum(np.searchsorted(v.words, words), max(len(v.words) - 1, 0))
            found = v.words[place] == words if len(v.words) else np.zeros(len(words), bool)
            c = np.where(found, v.counts[place], 0) if len(v.words) else np.zeros(len(words), np.int64)
            symbol = np.where(found, v.symbol[place], v.rare).astype(np.int32) if len(v.words) else np.full(len(words), v.rare, np.int32)
            base = np.where(found, v.unigram(c), 0.0)
            within = np.where(found & (symbol == v.rare), v.within_rare(c), 0.0)
            doc = np.repeat(np.arange(texts), sizes)
            # each text's symbols, the end last
            ends = np.cumsum(sizes + 1)
            flat = np.full(int(ends[-1]) if texts else 0, v.end, np.int32)
            flat[np.arange(len(at)) + doc] = symbol[at]
            rest = np.flatnonzero(~found[at])
            pairs, n = np.unique(doc[rest] * np.int64(max(len(words), 1)) + at[rest], return_counts=True)
            of = np.concatenate([[0], np.cumsum(np.bincount(pairs // max(len(words), 1), minlength=texts))]).astype(np.int32)
            lists = lambda offsets, x: pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(x))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(x) for x in keep),
                    lists(np.concatenate([[0], ends]), flat),
                    pa.array(np.bincount(doc, base[at], texts)),
                    pa.array(np.bincount(doc, within[at], texts)),
                    pa.array(np.bincount(doc, (found & (c > 0))[at], texts).astype(np.int64)),
                    lists(of, words[pairs % max(len(words), 1)]),
                    lists(of, n),
                ],
                names=[*keep, "symbols", "base", "within", "known", "words", "times"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select(*keep, "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, training boolean, symbols array<int>, base double, within double, known long, words array<long>, times array<long>")


@dataclass
class Model:
    """Emissions by symbol (symbols, states), transitions, and starts of texts and of later pieces."""

    emit: np.ndarray
    move: np.ndarray
    start: np.ndarray
    again: np.ndarray


def first_model(vocab: Vocabulary, states: int) -> Model:
    """Word shares with a fixed random tilt by word and state; states that tend to last."""
    names = np.concatenate([vocab.words[vocab.symbol < vocab.own], [0, 1]]).astype(np.int64).view(np.uint64)
    seeds = mix64(names[:, None] + np.uint64(0x9E3779B97F4A7C15) * np.arange(1, states + 1, dtype=np.uint64)[None])
    tilt = np.exp((seeds >> np.uint64(11)).astype(np.float64) / (1 << 53) * 2 - 1)
    emit = vocab.shares()[:, None] * tilt
    move = np.full((states, states), 0.2 / states) + 0.8 * np.eye(states)
    even = np.full(states, 1 / states)
    return Model(emit / emit.sum(axis=0), move, even, even.copy())


class Group:
    """Sequences run together: sorted by length, the longest first, stored position by position."""

    def __init__(self, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> None:
        self.order = np.argsort(-sizes, kind="stable")
        starts, sizes = starts[self.order], sizes[self.order]
        longest = int(sizes[0])
        # how many sequences have a position t
        self.widths = len(sizes) - np.searchsorted(sizes[::-1], np.arange(longest), side="right")
        rank = ragged(np.zeros(longest, np.int64), self.widths)
        self.symbols = flat[starts[rank] + np.repeat(np.arange(longest), self.widths)]
        self.edges = np.concatenate([[0], np.cumsum(self.widths)]).tolist()


def forward(model: Model, group: Group, first: np.ndarray, keep: bool) -> tuple[np.ndarray, np.ndarray | None, np.ndarray | None]:
    """Log likelihoods in the group's order; with ``keep`` also scaled forward values and scales of all positions.

    ``first``: start distributions, a row a sequence or one for all.
    """
    total = np.zeros(group.widths[0])
    ones = np.ones(len(model.move))
    edges = group.edges
    values = np.empty((edges[-1], len(ones))) if keep else None
    scales = np.empty(edges[-1]) if keep else None
    a = None
    for t, (i, j) in enumerate(zip(edges, edges[1:], strict=False)):
        b = model.emit[group.symbols[i:j]]
        b *= first if t == 0 else a[: j - i] @ model.move
        c = b @ ones
        b /= c[:, None]
        total[: j - i] += np.log(c)
        if keep:
            values[i:j], scales[i:j] = b, c
        a = b
    return total, values, scales


def expected(model: Model, group: Group, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected emissions (symbols, states), moves (states, states), first states (a row a sequence), log likelihood."""
    total, values, scales = forward(model, group, first, True)
    edges = group.edges
    moves = np.zeros_like(model.move)
    back = np.ones((0, len(model.move)))
    for t in range(len(edges) - 2, -1, -1):
        i, j = edges[t], edges[t + 1]
        after = len(back)  # sequences that have a position t + 1
        beta = np.ones((j - i, len(model.move)))
        if after:
            moves += values[i : i + after].T @ back
            beta[:after] = back @ model.move.T
        # what the position before needs: emission times backward value over the scale
        back = model.emit[group.symbols[i:j]]
        back *= beta
        back /= scales[i:j, None]
        values[i:j] *= beta
    emitted = np.stack([np.bincount(group.symbols, values[:, k], len(model.emit)) for k in range(len(model.move))], axis=1)
    return emitted, moves * model.move, values[: edges[1]].copy(), float(total.sum())


def sequences(batches: Iterator[pa.RecordBatch], piece: int | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Groups of at most GROUP tokens (one sequence at least): flat symbols, starts, sizes, which start a text, and their order in the batch.

    With ``piece`` texts are cut into pieces of at most that many tokens.
    """
    for batch in batches:
        column = batch.column("symbols")
        sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = np.asarray(column.flatten(), np.int32)
        starts = np.cumsum(sizes) - sizes
        opens = np.ones(len(sizes), bool)
        if piece:
            cuts = -(-sizes // piece)
            k = ragged(np.zeros(len(sizes), np.int64), cuts)
            starts, ends = np.repeat(starts, cuts) + k * piece, np.repeat(starts + sizes, cuts)
            sizes, opens = np.minimum(piece, ends - starts), k == 0
        # sequences of like length together, so that a group is a few long rows or many short ones
        order = np.argsort(-sizes, kind="stable")
        ends = np.cumsum(sizes[order])
        at = 0
        while at < len(order):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + GROUP, side="right")))
            own = order[at:stop]
            yield flat, starts[own], sizes[own], opens[own], own
            at = stop


def pooled(batches: Iterator[pa.RecordBatch], tokens: int) -> Iterator[pa.RecordBatch]:
    """Batches joined until they hold ``tokens`` tokens, or cut to that (one row at least)."""
    held, size = [], 0
    for batch in (part for whole in batches for part in token_slices(whole, tokens)):
        held.append(batch)
        size += len(batch.column("symbols").flatten())
        if size >= tokens:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()[:1]


def token_slices(batch: pa.RecordBatch, tokens: int) -> Iterator[pa.RecordBatch]:
    ends = np.cumsum(pc.list_value_length(batch.column("symbols")).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + tokens, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def baum_welch_round(texts: DataFrame, model: Model, piece: int) -> tuple[dict[str, np.ndarray], float]:
    """Expected counts over all texts, added by Spark: emissions, moves and starts, and the log likelihood."""
    shared = texts.sparkSession.sparkContext.broadcast(model)
    states, symbols = len(model.move), len(model.emit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        # rows: symbols, then moves from each state, starts, starts of later pieces, log likelihood
        total = np.zeros((symbols + states + 3, states))
        for batch in pooled(batches, 4 * GROUP):
            for flat, starts, sizes, opens, _ in sequences(iter([batch]), piece):
                group = Group(flat, starts, sizes)
                opens = opens[group.order]
                emitted, moves, firsts, ll = expected(m, group, np.where(opens[:, None], m.start, m.again))
                total[:symbols] += emitted
                total[symbols : symbols + states] += moves
                total[symbols + states] += firsts[opens].sum(axis=0)
                total[symbols + states + 1] += firsts[~opens].sum(axis=0)
                total[symbols + states + 2, 0] += ll
        some = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *(pa.array(total[some, k]) for k in range(states))], names=["row", *(f"s{k}" for k in range(states))])

    names = [f"s{k}" for k in range(states)]
    found = texts.select("symbols").mapInArrow(run, "row int, " + ", ".join(f"{x} double" for x in names))
    table = found.groupBy("row").agg(*(F.sum(x).alias(x) for x in names)).toArrow()
    shared.unpersist()
    total = np.zeros((symbols + states + 3, states))
    total[np.asarray(table["row"])] = np.stack([np.asarray(table[x]) for x in names], axis=1)
    return {"emit": total[:symbols], "move": total[symbols : symbols + states], "start": total[symbols + states], "again": total[symbols + states + 1]}, float(total[-1, 0])


def maximised(got: dict[str, np.ndarray], shares: np.ndarray, prior: float) -> Model:
    """The model of greatest expected likelihood, drawn towards the word shares and even moves."""
    emit = got["emit"] + prior * shares[:, None]
    move = got["move"] + 0.1
    start, again = got["start"] + 0.1, got["again"] + 0.1
    return Model(emit / emit.sum(axis=0), move / move.sum(axis=1, keepdims=True), start / start.sum(), again / again.sum())


def train(texts: DataFrame, vocab: Vocabulary, states: int, rounds: int, piece: int, prior: float) -> tuple[Model, list[float]]:
    """The model after ``rounds`` rounds over the training texts (rows with ``symbols``), and their log likelihoods."""
    model, seen, shares = first_model(vocab, states), [], vocab.shares()
    for _ in range(rounds):
        got, ll = baum_welch_round(texts, model, piece)
        model = maximised(got, shares, prior)
        seen.append(ll)
    return model, seen


def sequence_scores(texts: DataFrame, model: Model) -> DataFrame:
    """The columns of ``texts`` but the symbols, with n_tokens and ``ll``, the natural log likelihood of the symbols."""
    shared = texts.sparkSession.sparkContext.broadcast(model)
    rest = [c for c in texts.columns if c != "symbols"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in pooled(batches, 4 * GROUP):
            ll = np.zeros(batch.num_rows)
            for flat, starts, sizes, _, own in sequences(iter([batch]), None):
                group = Group(flat, starts, sizes)
                ll[own[group.order]] = forward(m, group, m.start, False)[0]
            n = pc.list_value_length(batch.column("symbols")).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), n, pa.array(ll)], names=[*rest, "n_tokens", "ll"])

    kinds = "".join(f"{c} {texts.schema[c].dataType.simpleString()}, " for c in rest)
    return texts.mapInArrow(run, f"{kinds}n_tokens long, ll double")


def held_out(id_col: str = "doc_id") -> Column:
    """Is crc32 of the id as text 1 modulo 5? Null ids aren't held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 1, F.lit(False))


def hidden_markov_scores(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", states: int = 8, rounds: int = 6, symbols: int = 1 << 15, lookup: int = 1 << 18, piece: int = 1024, prior: float = 100.0) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    folder = run_dir(spark, "hidden-markov")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), held_out(id_col).alias("held_out")).withColumn("training", ~F.col("held_out"))
    counts = write_table(word_counts(rows), f"{folder}/counts")
    texts = rows.filter("training").count()
    vocab, least = vocabulary(counts, texts, symbols, lookup)
    # written once, so that the row numbers stay
    encoded = write_table(encode(rows, vocab).withColumn("row", F.monotonically_increasing_id()), f"{folder}/texts")
    if texts:
        model, _ = train(encoded.filter("training").select("symbols"), vocab, states, rounds, piece, prior)
    else:
        one = np.ones((2, 1))
        model = Model(one, one[:1], one[0], one[0])
    scored = sequence_scores(encoded.select("row", "doc_id", "held_out", "base", "within", "known", "symbols"), model)
    # words that the table doesn't know: rare ones and new ones
    rest = encoded.select("row", F.explode(F.arrays_zip("words", "times")).alias("x")).select("row", F.col("x.words").alias("word"), F.col("x.times").alias("times"))
    rare = counts.filter((F.col("n_train") > 0) & (F.col("n_train") < least)).select("word", "n_train")
    c = F.coalesce("n_train", F.lit(0))
    share = lambda n, v: F.log((c + 0.5) / F.lit(n + 0.5 * (v + 1)))
    of_rest = rest.join(rare, "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * share(vocab.tokens, vocab.distinct)).alias("base_rest"),
        F.sum(F.col("times") * share(vocab.rare_tokens, vocab.rare_distinct)).alias("within_rest"),
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("known_rest"),
    )
    none = lambda x: F.coalesce(F.col(x), F.lit(0))
    end = float(vocab.unigram(vocab.ends))
    return scored.join(of_rest, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + none("known_rest") + F.lit(1 if texts else 0)).cast("long").alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        ((F.col("base") + none("base_rest") + F.lit(end)) / LN10).alias("base_score"),
        ((F.col("ll") + F.col("within") + none("within_rest")) / LN10).alias("score"),
    )
