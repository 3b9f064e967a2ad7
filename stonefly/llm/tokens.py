"""Whole-text encoding with the ``tokenizers`` library, in batches, with a bounded cache of distinct chunks."""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from stonefly.llm.common import ragged

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Chunks kept in the cache of one Python worker (about 80 MB), and the longest that is kept.
CACHE_CHUNKS, CACHE_CHARS = 500_000, 48

#: Chunks of plain Latin letters with full stops or commas behind them: the
#: split pattern makes one token of the letters and one of the signs, and lower
#: casing the letters first changes nothing.
PLAIN = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+[.,]*$"

#: Words that normaliser and split pattern leave as they are.
LOWER = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")

_ENCODERS: dict[str, Encoder] = {}


def word_tokenizer() -> str:
    """Path of the public tokenizer that the token queries use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def piece_model() -> str:
    """Path of the public piece model that the segmentation query uses."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class Encoder:
    """Ids of texts, equal to ``Tokenizer.encode(text, add_special_tokens=False).ids``.

    For tokenizers whose pre-tokenizer drops white space and never joins across
    it (as the public word tokenizer's does), a text's ids are the ids of its
    chunks between ASCII white space, one after the other: white space ends
    every match of the split pattern, and neither normalisation nor lower
    casing looks across it. The library encodes each distinct chunk; the ids of
    the first CACHE_CHUNKS chunks that a worker meets are kept.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.bare, self.ends = self._bare()
        self.forget()

    def forget(self) -> None:
        """Drop the kept chunks: for a worker that goes on with other work."""
        self.place: dict[str, int] = {}
        self.ids, self.first, self.count = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)

    def _bare(self):
        """The same model without normaliser and split pattern, for words that neither would change.

        Also which ids end a word, to find the words of many joined ones; None
        where the model doesn't mark word ends.
        """
        from tokenizers import Tokenizer, pre_tokenizers

        suffix = getattr(self.library.model, "end_of_word_suffix", None)
        if not suffix:
            return None, None
        bare = Tokenizer(self.library.model)
        bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        ends = np.zeros(self.library.get_vocab_size() + 1, bool)
        for token, k in self.library.get_vocab().items():
            ends[k] = token.endswith(suffix)
        return bare, ends

    def _encode_new(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks by the library, one after the other, and how many each chunk has."""
        easy = [k for k, x in enumerate(chunks) if LOWER.fullmatch(x)] if self.bare else []
        joined = [" ".join([chunks[k] for k in easy[i : i + 64]]) for i in range(0, len(easy), 64)]
        flat = np.concatenate([np.zeros(0, np.uint32), *(np.array(e.ids, np.uint32) for e in self.bare.encode_batch_fast(joined, add_special_tokens=False))]) if easy else np.zeros(0, np.uint32)
        last = np.flatnonzero(self.ends[flat]) if easy else np.zeros(0, np.int64)
        if len(last) != len(easy):
            easy, flat, last = [], flat[:0], last[:0]
        of_easy = np.diff(last, prepend=-1)
        done = set(easy)
        others = [k for k in range(len(chunks)) if k not in done]
        got = [e.ids for e in self.library.encode_batch([chunks[k] for k in others], add_special_tokens=False)] if others else []
        of_others = np.fromiter(map(len, got), np.int64, len(got))
        flat = np.concatenate([flat, np.fromiter((i for ids in got for i in ids), np.uint32, int(of_others.sum()))])
        order = np.array(easy + others, np.int64)
        lengths, starts = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        both = np.concatenate([of_easy, of_others])
        lengths[order], starts[order] = both, np.cumsum(both) - both
        return flat[ragged(starts, lengths)], lengths

    def _places(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct chunks as a store, and where each chunk starts in it and how many it has."""
        words = chunks.dictionary_encode()
        texts = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = np.fromiter((self.place.get(x, -1) for x in texts), np.int64, len(texts))
        new = np.flatnonzero(known < 0).tolist()
        kept, room = len(self.place), CACHE_CHUNKS - len(self.place)
        fresh = [texts[i] for i in new]
        flat, lengths = self._encode_new(fresh)
        used = int(self.first[kept - 1] + self.count[kept - 1]) if kept else 0
        keep = [k for k, x in enumerate(fresh) if len(x) <= CACHE_CHARS][: max(room, 0)]
        starts = np.cumsum(lengths) - lengths
        first = np.empty(len(texts), np.int64)
        count = np.empty(len(texts), np.int64)
        old = known >= 0
        first[old], count[old] = self.first[known[old]], self.count[known[old]]
        first[new], count[new] = used + starts, lengths
        store = np.concatenate([self.ids[:used], flat]) if len(flat) else self.ids
        if keep:
            own = lengths[keep]
            self._grow(used + int(own.sum()), kept + len(keep))
            self.ids[used : used + int(own.sum())] = flat[ragged(starts[keep], own)]
            self.first[kept : kept + len(keep)] = used + np.cumsum(own) - own
            self.count[kept : kept + len(keep)] = own
            self.place.update(zip((fresh[k] for k in keep), range(kept, kept + len(keep)), strict=True))
        at = words.indices.to_numpy(zero_copy_only=False)
        return store, first[at], count[at]

    def _grow(self, ids: int, chunks: int) -> None:
        while ids > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while chunks > len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
            self.count = np.concatenate([self.count, np.zeros_like(self.count)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: empty), one after the other, and the n + 1 offsets of the texts."""
        parts = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        chunks = parts.flatten().dictionary_encode()
        distinct, n = chunks.dictionary, len(chunks.dictionary)
        plain = pc.match_substring_regex(distinct, PLAIN)
        words = pc.if_else(plain, pc.utf8_lower(pc.ascii_rtrim(distinct, ".,")), distinct)
        signs = pc.if_else(plain, pc.replace_substring_regex(distinct, "^[^.,]+", ""), "")
        store, first, count = self._places(pa.concat_arrays([words, signs]))
        # the ids of a chunk: those of its word, then those of its signs
        first, count = first.reshape(2, n).T.ravel(), count.reshape(2, n).T.ravel()
        own = store[ragged(first, count)]
        count = count.reshape(n, 2).sum(axis=1)
        first = np.cumsum(count) - count
        at = chunks.indices.to_numpy(zero_copy_only=False)
        counts = count[at]
        ids = own[ragged(first[at], counts)]
        ends = np.concatenate([[0], np.cumsum(counts)])
        words_of = np.concatenate([[0], np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))])
        return ids, ends[words_of]
