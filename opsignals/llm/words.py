"""Words of texts as numbers: Arrow splits and numbers them, each distinct word is hashed once a slice."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_ODD = np.uint64(0x9E3779B97F4A7C15)


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Where each text's words begin (one more at the end), a code for each word, the words by code."""
    texts = pc.replace_substring_regex(texts.cast(pa.large_string()), "[\\t\\r\\n]", " ")
    lists = pc.split_pattern(texts, " ")
    rows = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.values.slice(rows[0], rows[-1] - rows[0]).dictionary_encode()
    rows = rows - rows[0]
    words = coded.dictionary.to_pylist()
    codes = coded.indices.to_numpy()
    if "" in words:  # between two blanks there is no word
        real = codes != words.index("")
        rows = np.concatenate(([0], np.cumsum(real)))[rows]
        codes = codes[real]
    return rows, codes, words


def hashed(words: list[str]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * _ODD
    return values ^ (values >> np.uint64(29))


def runs(values: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` values in a row."""
    n = len(values) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out = mixed(out * _ODD + values[j : j + n])
    return out
