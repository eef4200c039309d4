"""Token ids of many texts, by a public tokenizer, with each distinct piece of a word encoded once per worker, as long as it is remembered."""

from __future__ import annotations

from itertools import chain

import numpy as np
from tokenizers import Tokenizer

from panelspark.llm.words import LOWER, SLICE_BYTES, SPACE, Words, find_words, ragged

#: Places for pieces that a worker remembers (rounded up to a power of two).
REMEMBERED = 1 << 18
#: Pieces of more ids than this are encoded whenever they come.
_MOST_IDS = 16

#: What a byte is to the tokenizer: pieces are runs of letters, single digits, runs of other signs.  A word with an odd byte is not cut.
_GAP, _LETTER, _DIGIT, _SIGN, _ODD = range(5)
_KIND = np.full(256, _ODD, np.uint8)
_KIND[33:127] = _SIGN
_KIND[[*range(65, 91), *range(97, 123)]] = _LETTER
_KIND[48:58] = _DIGIT
_KIND[[ord("'"), ord("<")]] = _ODD  # contractions, special tokens
_KIND[SPACE] = _GAP
#: Second byte, in lower case, of the UTF-8 form of the letters À to ÿ, all of which begin with C3; 0 for other bytes.
_LATIN = np.zeros(256, np.uint8)
_LATIN[128:192] = [ord(c.lower()) - 64 if c.isalpha() else 0 for c in map(chr, range(192, 256))]
#: Byte-level symbols as UTF-16: a byte that is no visible Latin-1 character stands as code point 256 and up.
_VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_SYMBOL = np.arange(256, dtype="<u2")
_SYMBOL[[b for b in range(256) if b not in _VISIBLE]] = np.arange(256, 512 - len(_VISIBLE))


def find_pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[Words, np.ndarray]:
    """Words cut into pieces that the tokenizer encodes one by one, in lower case, and which of them are whole words left as they are."""
    low, kind = LOWER[data], _KIND[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    lead = np.flatnonzero(data[:-1] == 0xC3)
    second = _LATIN[data[lead + 1]]
    letter = (second > 0) & ~edge[lead + 1]
    lead = lead[letter]
    low[lead + 1] = second[letter]
    kind[lead] = kind[lead + 1] = _LETTER
    at = np.flatnonzero(kind == _ODD)
    if len(at):
        words = find_words(data, offsets, kind != _GAP)
        odd = np.unique(np.searchsorted(words.start, at, "right") - 1)
        whole = ragged(words.start[odd], words.end[odd] - words.start[odd])
        low[whole], kind[whole] = data[whole], _ODD
    begins = kind != _GAP
    ends = begins.copy()
    begins[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT) | edge[1:-1]
    ends[:-1] &= begins[1:] | (kind[1:] == _GAP)
    start = np.flatnonzero(begins)
    return Words(low, start, np.flatnonzero(ends) + 1, np.searchsorted(start, offsets)), kind[start] == _ODD


class WordEncoder:
    """Encodes texts word by word.

    Only for tokenizers that drop white space and never join what it separates, and take words apart as
    :func:`find_pieces` does (``word_bpe_49k.json`` is one): there the ids of a text are those of its pieces, one after the other.
    """

    def __init__(self, path: str, literal: bool = False) -> None:
        """``literal``: strings of special tokens are ordinary text."""
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = literal
        self._model = self._tokenizer.model
        self._forget()

    def _forget(self) -> None:
        # The first bits of a piece's hash are its place in a table, so that its size is bounded.  An empty place holds a hash that belongs elsewhere.
        bits = max(1, (REMEMBERED - 1).bit_length())
        self._shift = np.uint64(64 - bits)
        self._slot = ~(np.arange(1 << bits, dtype=np.uint64) << self._shift)
        self._first, self._count = np.zeros(1 << bits, np.int32), np.zeros(1 << bits, np.uint8)
        self._again = np.zeros(1 << bits, bool)
        self._ids, self._used = np.zeros(0, np.uint32), 0

    def _make_room(self, more: int) -> None:
        """Drops the ids of pieces that are forgotten; there is room for so many more then."""
        kept = np.flatnonzero(self._count)
        kept = kept[np.argsort(self._first[kept])]
        first, count = self._first[kept], self._count[kept]
        inside = np.zeros(self._used + 1, np.int8)
        inside[first] += 1
        inside[first + count] -= 1
        ids = self._ids[: self._used][np.cumsum(inside[:-1], dtype=np.int8).view(bool)]
        self._first[kept] = np.cumsum(count, dtype=np.int64) - count
        self._ids, self._used = np.zeros(2 * len(ids) + more, np.uint32), len(ids)
        self._ids[: len(ids)] = ids

    def _remember(self, keys: np.ndarray, first: np.ndarray, count: np.ndarray) -> None:
        """A new piece takes its place, unless the one that is there came again since the last that wanted it."""
        place, at = np.unique(keys >> self._shift, return_index=True)
        free = ~self._again[place] & (count[at] <= _MOST_IDS)
        self._again[place] = False
        place, at = place[free], at[free]
        self._slot[place], self._first[place], self._count[place] = keys[at], first[at], count[at]

    def _encode(self, pieces: Words, odd: np.ndarray) -> list[list[int]]:
        # A piece needs no normaliser; the model alone gives the same ids, several times faster.
        symbols, raw = _SYMBOL[pieces.data].tobytes().decode("utf-16-le"), pieces.data.tobytes()
        tokenize, whole = self._model.tokenize, self._tokenizer.encode
        return [
            whole(raw[a:b].decode("utf-8", "replace"), add_special_tokens=False).ids if o else [t.id for t in tokenize(symbols[a:b])]
            for a, b, o in zip(pieces.start.tolist(), pieces.end.tolist(), odd.tolist())
        ]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a run of texts, one after the other, and how many each text has."""
        pieces, odd = find_pieces(data, offsets)
        keys = pieces.hashes()
        place = keys >> self._shift
        known = self._slot[place] == keys
        self._again[place[known]] = True
        missing, more = np.flatnonzero(~known), 0
        if len(missing):
            new, at, of = np.unique(keys[missing], return_index=True, return_inverse=True)
            at = missing[at]
            found = self._encode(Words(pieces.data, pieces.start[at], pieces.end[at], pieces.bounds), odd[at])
            new_count = np.fromiter(map(len, found), np.int64, len(found))
            more = int(new_count.sum())
            if self._used + more > len(self._ids):
                self._make_room(more)
            new_first = self._used + np.cumsum(new_count) - new_count
            self._ids[self._used : self._used + more] = np.fromiter(chain.from_iterable(found), np.uint32, more)
            self._used += more
        first, counts = self._first[place].astype(np.int64), self._count[place].astype(np.int64)
        if len(missing):
            first[missing], counts[missing] = new_first[of], new_count[of]
            self._remember(new, new_first, new_count)
        ids = self._ids[ragged(first, counts)]
        if more > SLICE_BYTES:
            self._make_room(0)
        return ids, np.diff(np.concatenate([[0], np.cumsum(counts)])[pieces.bounds])


_ENCODERS: dict[tuple[str, bool], WordEncoder] = {}


def word_encoder(path: str, literal: bool = False) -> WordEncoder:
    """The worker's encoder for a tokenizer file; it keeps what it has learnt from task to task."""
    if (path, literal) not in _ENCODERS:
        _ENCODERS[path, literal] = WordEncoder(path, literal)
    return _ENCODERS[path, literal]
