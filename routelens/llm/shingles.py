"""Word hashes of documents in numpy, for operators on word shingles and passages."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from routelens.llm.common import shingle_words

SHINGLE = 5
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def content_key(text: Column) -> Column:
    """md5 over the words: equal for texts that differ in white space and letter case alone. Null if there is no word."""
    words = shingle_words(text)
    return F.when(F.size(words) > 0, F.unhex(F.md5(F.array_join(words, " "))))


def word_hashes(text: Column) -> Column:
    return F.transform(shingle_words(text), lambda word: F.xxhash64(word))


def flat_lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a list column as uint64, and where each row's begin and the last ends."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.array(column.value_lengths().fill_null(0), np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).view(np.uint64), np.concatenate([[0], np.cumsum(sizes)])


def mixed(x: np.ndarray) -> np.ndarray:
    """A finishing step that spreads every bit over all (the public 64-bit variant 13 mix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each place on, as far as there are so many."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total = total * _MULTIPLIER + words[i : i + n]
    return mixed(total)


def shingle_set(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Distinct shingle hashes, ascending; a text shorter than one shingle is one shingle, an empty text has none."""
    return np.unique(gram_hashes(words, min(size, max(len(words), 1))))
