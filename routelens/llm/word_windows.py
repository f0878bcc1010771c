"""Words, windows and anchors of whole batches of texts in numpy, without a loop over words.

Words are maximal runs of bytes other than the six ASCII blanks. A window is ``WINDOW`` words in a row. Its anchor
is the least hash of the ``GRAM``-word grams in it, so equal windows have equal anchors wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from routelens.llm.shingles import mixed

WINDOW = 20
GRAM = 3
#: Windows that one stretch holds at most: their verdicts fit one 64-bit word, and periodic texts repeat their stretches.
STRETCH = 64
#: Bytes of text, and words, that are worked on at once; a byte takes about 80 bytes of memory meanwhile.
CHUNK_BYTES, CHUNK_WORDS = 1 << 20, 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64))


class _Powers:
    """Powers of an odd number modulo 2**64, as many as were asked for so far."""

    def __init__(self, base: np.uint64):
        self._base, self._known = base, np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self._known) < n:
            steps = np.full(max(n, len(self._known) + (1 << 16)), self._base)
            steps[0] = 1
            self._known = np.cumprod(steps)
        return self._known[:n]


_UP, _DOWN = _Powers(_BASE), _Powers(_INVERSE)


def byte_values(data: np.ndarray) -> np.ndarray:
    """A 64-bit number for each byte, to be summed up by ``prefix_sums``."""
    return _BYTE_VALUES[data]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums of ``values[i] * base**i`` modulo 2**64, one more than there are values."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _UP.upto(len(values)), out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``values[start:end]`` for every pair, equal for equal values at any place."""
    found = (sums[ends] - sums[starts]) * _DOWN.upto(len(sums))[starts]
    return mixed(found + (ends - starts).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))


def chunk_words(data: np.ndarray, breaks: np.ndarray, is_blank: np.ndarray = _IS_BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of ``data``, where they begin and where they end; a word also ends at each of ``breaks``."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~is_blank[data]
    begins = inside[1:] & ~inside[:-1]
    ends = inside[:-1] & ~inside[1:]
    cut = breaks[(breaks > 0) & (breaks < len(data))]
    cut = cut[inside[cut] & inside[cut + 1]]
    begins[cut] = True
    ends[cut] = True
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends)
    return range_hashes(prefix_sums(_BYTE_VALUES[data]), starts, stops), starts, stops


def text_chunks(column: pa.Array, is_blank: np.ndarray = _IS_BLANK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(place, bytes, breaks)``: a string column's bytes in order, some at a time; ``breaks`` are the rows' ends in them.

    A chunk ends behind a blank or at the end of a row, however long a word is.
    """
    column, offsets, data = _column_bytes(column)
    at, end = int(offsets[0]), int(offsets[-1])
    while at < end:
        stop = min(at + CHUNK_BYTES, end)
        while stop < end:
            part = data[stop - 1 : min(stop + CHUNK_BYTES, end)]
            blank = int(np.argmax(is_blank[part])) if is_blank[part].any() else len(part)
            row = int(offsets[np.searchsorted(offsets, stop)])
            if min(stop + blank, row) <= stop - 1 + len(part):
                stop = min(stop + blank, row)
                break
            stop = stop - 1 + len(part)
        low, high = np.searchsorted(offsets, [at, stop])
        yield at, data[at:stop], offsets[low : high + 1] - at
        at = stop


def _column_bytes(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    buffer = column.buffers()[2]
    return column, offsets, np.frombuffer(buffer, np.uint8) if buffer is not None else np.empty(0, np.uint8)


def row_offsets(column: pa.Array) -> np.ndarray:
    """Where each row's bytes begin and the last ends, as ``text_chunks`` counts places."""
    return _column_bytes(column)[1]


def batch_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a string column in order, and the number of the first word of each row and of the end."""
    hashes, places = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for at, data, breaks in text_chunks(column):
        found, starts, _ = chunk_words(data, breaks)
        hashes.append(found)
        places.append(starts + at)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(places), row_offsets(column), side="left")


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    found, have = values, 1
    while have < width:
        step = min(have, width - have)
        found = np.minimum(found[: len(found) - step], found[step:])
        have += step
    return found


@dataclass
class Stretches:
    """Runs of at most ``STRETCH`` windows of one row with one anchor. ``start`` counts the row's words."""

    row: np.ndarray
    start: np.ndarray
    n: np.ndarray
    anchor: np.ndarray
    content: np.ndarray
    #: True where a window of the stretch may equal another one of it.
    repeats: np.ndarray

    def __len__(self) -> int:
        return len(self.row)

    def take(self, some: np.ndarray) -> Stretches:
        return Stretches(*[getattr(self, name)[some] for name in self.__dataclass_fields__])


def window_hashes(words: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Hash of the ``window`` words from each place on, as far as there are so many."""
    starts = np.arange(max(0, len(words) - window + 1))
    return range_hashes(prefix_sums(words), starts, starts + window)


def stretches(words: np.ndarray, firsts: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> Iterator[Stretches]:
    """The stretches of a batch's rows, whose words are ``words[firsts[i]:firsts[i + 1]]``, some at a time."""
    counts = np.diff(firsts)
    low = 0
    while low < len(counts):
        high = max(low + 1, int(np.searchsorted(firsts, firsts[low] + CHUNK_WORDS, side="right")) - 1)
        at, end = int(firsts[low]), int(firsts[high])
        while True:  # one very long row is taken in parts that share the words of a window
            stop = min(end, at + max(CHUNK_WORDS, window)) if high == low + 1 else end
            if stop - at >= window:
                yield _part(words[at:stop], firsts[low : high + 1], at, low, window, gram)
            if stop >= end:
                break
            at = stop - window + 1
        low = high


def _part(words: np.ndarray, firsts: np.ndarray, at: int, low: int, window: int, gram: int) -> Stretches:
    sums = prefix_sums(words)
    places = np.arange(len(words) - gram + 1)
    grams = range_hashes(sums, places, places + gram)
    least = _sliding_min(grams, window - gram + 1)
    place = np.arange(len(least))
    row = np.searchsorted(firsts, place + at, side="right") - 1
    valid = place + at + window <= firsts[np.minimum(row + 1, len(firsts) - 1)]
    often = np.zeros(len(least), np.int8)
    for step in range(window - gram + 1):
        often += grams[step : step + len(least)] == least
    place, row, least, often = place[valid], row[valid], least[valid], often[valid] > 1
    new = np.ones(len(place), bool)
    new[1:] = (row[1:] != row[:-1]) | (least[1:] != least[:-1]) | (place[1:] != place[:-1] + 1)
    begin = np.flatnonzero(new)
    since = np.arange(len(place)) - np.repeat(begin, np.diff(np.append(begin, len(place))))
    begin = np.flatnonzero(since % STRETCH == 0)
    n = np.diff(np.append(begin, len(place)))
    starts = place[begin]
    repeats = (np.add.reduceat(often, begin, dtype=np.int64) > 0 if len(begin) else np.empty(0, bool)) | (n > window - gram + 1)
    content = range_hashes(sums, starts, starts + n + window - 1)
    return Stretches(row[begin] + low, starts + at - firsts[row[begin]], n, least[begin], content, repeats)
