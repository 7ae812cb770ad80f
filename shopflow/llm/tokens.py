"""Whole texts to token ids with the ``tokenizers`` library.

The tokenizer drops white space and never lets a token cross it, so a text's ids
are the ids of its white-space words in order.  Each batch is split into words
in Arrow, every distinct word is cut around punctuation into pieces, every distinct piece is
encoded once by the library, and the ids are laid out again with numpy.  Encoded pieces stay in a
bounded cache of the Python worker, in Arrow and numpy arrays; the half used last stays when it is full.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: characters whose class and lower case every Unicode version agrees on; only words
#: made of them are also cut around punctuation, which makes pieces repeat more
_PLAIN = r"[^\x00-\x7F\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]"
#: the tokenizer's own cuts (fixed values of its pre-tokenizer)
_CUTS = r"'s|'t|'re|'ve|'m|'ll|'d|[^\s\p{L}\p{N}]+"
_LETTERS = r"^[a-z\x{E0}-\x{F6}\x{F8}-\x{FF}]+$"
#: what lets a word need more than lower case: anything but those letters and their capitals
_OTHER = r"[^A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]"


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _gather(flat: np.ndarray, size: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``index`` of ``flat``, whose runs have the sizes ``size``, one after the other, and all their ends."""
    at, n = np.cumsum(size) - size, size[index]
    ends = np.concatenate([[0], np.cumsum(n)])
    return flat[np.arange(ends[-1]) + np.repeat(at[index] - ends[:-1], n)], ends


class Encoder:
    """Encodes Arrow string arrays; ``cache`` bounds the pieces kept per worker (about 40 bytes each; none over 64 bytes of text)."""

    def __init__(self, path: str, cache: int = 400_000, chunk_bytes: int = 8 << 20):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        self.cache, self.chunk_bytes = cache, chunk_bytes
        self.dtype = np.dtype("<u2" if self.model.get_vocab_size() <= 1 << 16 else "<u4")
        # the tokenizer's own spelling of the letters beyond ASCII in its vocabulary
        self.spelling = [(c, "".join(piece for piece, _ in self.model.pre_tokenizer.pre_tokenize_str(c)))
                         for c in map(chr, range(0xE0, 0x100)) if c.isalpha()]
        # its merges alone, for spelled pre-tokens between blanks, and which ids end a pre-token
        self.merges = Tokenizer(self.model.model)
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary, suffix = self.model.get_vocab(), self.model.model.end_of_word_suffix
        self.closing = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closing[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        # the cache: pieces, their ids one after the other, how many each has, the chunk that used it last
        self.known, self.flat = pa.array([], pa.large_string()), np.zeros(0, self.dtype)
        self.size, self.used, self.turn = np.zeros(0, np.int64), np.zeros(0, np.int64), 0

    def _encoded(self, model, texts: list[str], batch: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts, one after the other, and how many each has; the library's objects live for a batch."""
        flat, size = [np.zeros(0, self.dtype)], []
        for i in range(0, len(texts), batch):
            codes = [c.ids for c in model.encode_batch_fast(texts[i:i + batch], add_special_tokens=False)]
            flat.append(np.array(list(chain.from_iterable(codes)), self.dtype))
            size += map(len, codes)
        return np.concatenate(flat), np.array(size, np.int64)

    def _merged(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of pieces of letters and how many each has; None if their last ids don't show where they end."""
        edges = np.append(np.arange(0, len(pieces), 64), len(pieces))
        texts = pc.binary_join(pa.LargeListArray.from_arrays(edges, pieces), pa.scalar(" ", pa.large_string())).to_pylist()
        for i, text in enumerate(texts):
            if not text.isascii():
                for letter, spelled in self.spelling:
                    text = text.replace(letter, spelled)
                texts[i] = text
        flat, _ = self._encoded(self.merges, texts, 256)
        ends = np.flatnonzero(self.closing[flat]) + 1  # only a piece's last letter carries the suffix
        return (flat, np.diff(ends, prepend=0)) if len(ends) == len(pieces) else None

    def _learn(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that the cache lacks, one after the other, and how many each has."""
        letters = pc.match_substring_regex(pieces, _LETTERS)  # one pre-token that the normaliser leaves as it is
        merged = self._merged(pieces.filter(letters))
        if merged is None:
            letters, merged = pa.array(np.zeros(len(pieces), bool)), (self.flat[:0], self.size[:0])
        rest = pieces.filter(pc.invert(letters)).to_pylist()
        flat, size = (np.concatenate(x) for x in zip(merged, self._encoded(self.model, rest, 10_000)))
        at = np.argsort(np.argsort(~letters.to_numpy(zero_copy_only=False), kind="stable"))  # place of each piece's ids
        return _gather(flat, size, at)[0], size[at]

    def _ids_of(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces, and where each one's begin (and the last one's end)."""
        at = pc.index_in(pieces, value_set=self.known)
        learned = pieces.filter(at.is_null())
        at = at.fill_null(-1).to_numpy().astype(np.int64)
        at[at < 0] = np.arange(len(learned)) + len(self.known)
        known = pa.concat_arrays([self.known, learned])
        flat, size = (np.concatenate(x) for x in zip((self.flat, self.size), self._learn(learned)))
        out = _gather(flat, size, at)
        used = np.concatenate([self.used, np.zeros(len(learned), np.int64)])
        self.turn += 1
        used[at] = self.turn
        keep = np.flatnonzero(pc.binary_length(known).to_numpy() <= 64)
        if len(keep) > self.cache:  # the half used last
            keep = np.sort(keep[np.argsort(-used[keep], kind="stable")[:self.cache // 2]])
        if len(keep) < len(known):
            known, flat, size, used = known.take(pa.array(keep)), _gather(flat, size, keep)[0], size[keep], used[keep]
        self.known, self.flat, self.size, self.used = known, flat, size, used
        return out

    def _pieces(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, and where each word's begin (and the last one's end)."""
        cuts = pc.match_substring_regex(words, _OTHER)
        odd = words.filter(cuts)
        plain = pc.invert(pc.match_substring_regex(odd, _PLAIN))
        cut = pc.replace_substring_regex(pc.utf8_lower(odd), _CUTS, r" \0 ")
        words = pc.replace_with_mask(pc.utf8_lower(words), cuts, pc.if_else(plain, cut, odd))
        pieces = pc.ascii_split_whitespace(words)
        coded = pieces.flatten().dictionary_encode()
        flat, at = self._ids_of(coded.dictionary)
        out, ends = _gather(flat, np.diff(at), coded.indices.to_numpy())
        starts = pieces.offsets.to_numpy().astype(np.int64) - pieces.offsets[0].as_py()
        return out, ends[starts]

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids, offsets of its rows in ids) for chunks of the rows; null is empty."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy())

        def until(first: int, size: int) -> int:
            return max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + size, "right")))

        first = 0
        while first < len(texts):
            last = until(first, self.chunk_bytes)
            words = pc.ascii_split_whitespace(texts.slice(first, last - first))
            coded = words.flatten().dictionary_encode()
            flat, at = self._pieces(coded.dictionary)
            size, index = np.diff(at), coded.indices.to_numpy()
            base, starts = first, words.offsets.to_numpy().astype(np.int64) - words.offsets[0].as_py()
            while first < last:  # the ids are laid out for fewer rows at a time than words are looked up
                end = min(last, until(first, self.chunk_bytes // 8))
                own = starts[first - base:end - base + 1]
                out, edges = _gather(flat, size, index[own[0]:own[-1]])
                yield first, out, edges[own - own[0]]
                first = end


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def ids_crc32(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
