"""Shingles of many texts at once: where they lie, and the sets of their hashes."""

from __future__ import annotations

import numpy as np

from panelspark.llm.words import Hasher, Words, lower_words, mix, single_spaced

SEED = 42


def shingles_of(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """The words of a run of texts, where their shingles (all words, where a text has fewer) start and end, and the bounds of the texts."""
    words = single_spaced(lower_words(data, offsets))
    n = words.per_text()
    shingles = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
    bounds = np.concatenate([[0], np.cumsum(shingles)])
    first = np.repeat(words.bounds[:-1] - bounds[:-1], shingles) + np.arange(bounds[-1])
    last = first + np.repeat(np.minimum(n, shingle), shingles) - 1
    return words, words.start[first], words.end[last], bounds


def shingle_sets(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted hashes of each text's distinct shingles, the bounds of the texts, and a 64-bit digest of each set."""
    words, start, end, bounds = shingles_of(data, offsets, shingle)
    n_texts = len(bounds) - 1
    hashes, of = Hasher(words.data)(start, end), np.repeat(np.arange(n_texts), np.diff(bounds))
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    first = np.ones(len(of), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    hashes, of = hashes[first], of[first]
    bounds = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n_texts))])
    digest, some = np.zeros(n_texts, np.uint64), np.diff(bounds) > 0
    if some.any():
        digest[some] = np.add.reduceat(mix(hashes ^ np.uint64(SEED)), bounds[:-1][some])
    return hashes, bounds, digest
