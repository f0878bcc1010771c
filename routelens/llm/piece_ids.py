"""Token ids of whole batches of texts: cut into pieces, looked up by the pieces' hashes, and gathered in numpy.

The public pattern of byte-level BPE starts a token before the last white space of every run of it that stands
before something else, however long the run. So texts are cut there, and the ids of a text are those of its pieces in a row.
Pieces are short unless a text has no white space, and only short ones are remembered: a worker's memory is bounded by
their number and length, and no whole text is kept.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from routelens.llm.word_windows import byte_values, prefix_sums, range_hashes

#: Bytes of a piece that is remembered at most, and of text that is hashed at once.
SHORT, CHUNK = 64, 1 << 20
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes that surely begin a character which is not white space: no control, and no lead byte of a wider blank.
_SOLID = np.zeros(256, bool)
_SOLID[0x21:0x7F] = True
_SOLID[0xC3:0xE1] = True
_SOLID[0xE4:0xF5] = True


class PieceIds:
    """Ids of texts by ``encode(list of pieces) -> list of ids as little-endian unsigned 32-bit bytes``.

    When more than ``most`` pieces are held, all are forgotten: that bounds memory and changes no result.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], special: str, most: int):
        self._encode, self._special, self._most = encode, special, most
        self._forget()

    def _forget(self) -> None:
        self._keys = np.empty(0, np.uint64)
        self._place = np.empty(0, np.int64)
        self._start = np.zeros(1, np.int64)
        self._pool = np.empty(0, "<u4")

    @property
    def held_bytes(self) -> int:
        return self._keys.nbytes + self._place.nbytes + self._start.nbytes + self._pool.nbytes

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column of texts (no nulls), and where each text's begin and the last ends."""
        special = [i for i, text in enumerate(texts.to_pylist()) if self._special in text]
        if not special:
            return self._gathered(texts)
        whole = dict(zip(special, self._encode_whole([texts[i].as_py() for i in special]), strict=True))
        rest = np.ones(len(texts), bool)
        rest[special] = False
        ids, firsts = self._gathered(texts.filter(pa.array(rest)))
        parts, at = [], 0
        for i in range(len(texts)):
            if rest[i]:
                parts.append(ids[firsts[at] : firsts[at + 1]])
                at += 1
            else:
                parts.append(whole[i])
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def _encode_whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(data, "<u4") for data in self._encode(texts)]

    def _gathered(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        column = texts.cast(pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
        buffer = column.buffers()[2]
        data = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer is not None else np.empty(0, np.uint8)
        rows = offsets - offsets[0]
        starts = piece_starts(data, rows)
        ends = np.append(starts[1:], len(data))
        keys = np.concatenate([np.empty(0, np.uint64), *_hashes(data, starts, ends)])
        if len(self._keys) > self._most:
            self._forget()
        long = np.flatnonzero(ends - starts > SHORT)
        keys[long] = 0
        known = self._learn(keys, data, starts, ends)
        size = self._start[known + 1] - self._start[known]
        begin = self._start[known]
        pool = self._pool
        if len(long):  # encoded each time, behind what is remembered
            found = self._encode_whole([data[a:b].tobytes().decode() for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True)])
            size[long] = [len(ids) for ids in found]
            begin[long] = len(pool) + np.cumsum(size[long]) - size[long]
            pool = np.concatenate([pool, *found])
        ends_at = np.cumsum(size)
        ids = pool[np.repeat(begin - (ends_at - size), size) + np.arange(ends_at[-1] if len(ends_at) else 0)]
        return ids, np.concatenate([[0], ends_at])[np.searchsorted(starts, rows)]

    def _learn(self, keys: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The place of every piece's ids, after those not seen before have been encoded. Key 0 has none."""
        distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        place = np.searchsorted(self._keys, distinct)
        old = np.zeros(len(distinct), bool)
        if len(self._keys):
            old = self._keys[np.minimum(place, len(self._keys) - 1)] == distinct
        new = np.flatnonzero(~old)
        if len(new):
            pieces = [data[a:b].tobytes().decode() if b - a <= SHORT else "" for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)]
            found = self._encode(pieces)
            sizes = np.array([len(ids) // 4 for ids in found], np.int64)
            numbers = len(self._start) - 1 + np.arange(len(new))
            self._start = np.concatenate([self._start, self._start[-1] + np.cumsum(sizes)])
            self._pool = np.concatenate([self._pool, np.frombuffer(b"".join(found), "<u4")])
            self._place = np.insert(self._place, place[new], numbers)
            self._keys = np.insert(self._keys, place[new], distinct[new])
            place = np.searchsorted(self._keys, distinct)
        return self._place[place][inverse] if len(distinct) else np.empty(0, np.int64)


def piece_starts(data: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Where pieces begin in ``data``, whose rows begin at ``rows``; rows without bytes have none."""
    white = _WHITE[data]
    cut = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        cut[:-2] = white[:-1] & _SOLID[data[1:]]
    last = rows[1:-1] - 1  # the next byte is another row's
    cut[last[last >= 0]] = False
    cut[rows[:-1][np.diff(rows) > 0]] = True
    cut[len(data)] = False
    return np.flatnonzero(cut)


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Hashes of the pieces, some of them at a time; of longer ones than ``SHORT`` the number says nothing."""
    low = 0
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(starts, starts[low] + CHUNK)))
        at, to = int(starts[low]), int(ends[high - 1])
        if high == low + 1 and to - at > SHORT:
            yield np.zeros(1, np.uint64)
        else:
            stop = min(to, int(starts[high - 1]) + SHORT)
            sums = prefix_sums(byte_values(data[at:stop]))
            yield range_hashes(sums, starts[low:high] - at, np.minimum(ends[low:high], stop) - at)
        low = high
