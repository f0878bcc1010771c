"""Token counts of whole texts by byte-pair merging with a heap over a linked list."""

from __future__ import annotations

import heapq
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routelens.llm.bpe_ids import REMEMBERED, SPECIAL, tokenizer_path
from routelens.llm.common import per_worker, whole_text
from routelens.llm.piece_ids import SHORT, PieceIds

VOCABULARY = "byte_bpe_50k.json"
TOKEN_LIMIT = 512
#: Texts that are counted at once.
BATCH_ROWS = 500


class MergeCounter:
    """Counts the tokens of byte-level BPE without making any.

    A pretoken starts as one symbol for each byte. The adjacent pair of lowest rank, leftmost among
    equals, is merged until none has a rank. The count is the initial symbols less the merges. A
    long pretoken takes n log n steps. Only counts of short pretokens are remembered, at most ``most`` of them.
    """

    def __init__(self, path: str, most: int = REMEMBERED):
        import public_tokenizers
        import regex

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        numbers = model["vocab"]
        self._bytes = [numbers[c] for c in _byte_characters()]
        self._ranks, self._left, self._right, self._made = {}, [], [], []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self._ranks[numbers[left] << 32 | numbers[right]] = rank
            self._left.append(numbers[left])
            self._right.append(numbers[right])
            self._made.append(numbers[left + right])
        self._pretokens = regex.compile(public_tokenizers.PATTERN).findall
        self._known: dict[str, int] = {}
        self._most = most

    @property
    def held_characters(self) -> int:
        return sum(map(len, self._known))

    def __call__(self, pieces: list[str]) -> list[bytes]:
        """Each piece's count as one little-endian unsigned 32-bit number."""
        if len(self._known) > self._most:
            self._known.clear()
        return [self._piece(piece).to_bytes(4, "little") for piece in pieces]

    def _piece(self, piece: str) -> int:
        parts, total = piece.split(SPECIAL), -1
        for part in parts:
            total += 1
            for token in (part,) if part[1:].isalpha() and part[0] == " " else self._pretokens(part):
                count = self._known.get(token)
                if count is None:
                    count = self._pretoken(token.encode())
                    if len(token) <= SHORT:
                        self._known[token] = count
                total += count
        return total

    def _pretoken(self, data: bytes) -> int:
        symbols = [self._bytes[b] for b in data]
        n, get = len(symbols), self._ranks.get
        heap = []  # rank in the high bits, place in the low ones
        for i in range(n - 1):
            rank = get(symbols[i] << 32 | symbols[i + 1])
            if rank is not None:
                heap.append(rank << 32 | i)
        heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges = 0
        while heap:
            top = heapq.heappop(heap)
            rank, i = top >> 32, top & 0xFFFFFFFF
            j = after[i]
            if symbols[i] != self._left[rank] or j >= n or symbols[j] != self._right[rank]:
                continue  # one of the two was merged meanwhile
            merges += 1
            made = symbols[i] = self._made[rank]
            symbols[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank = get(made << 32 | symbols[k])
                if rank is not None:
                    heapq.heappush(heap, rank << 32 | i)
            h = before[i]
            if h >= 0:
                rank = get(symbols[h] << 32 | made)
                if rank is not None:
                    heapq.heappush(heap, rank << 32 | h)
        return n - merges


def _byte_characters() -> list[str]:
    """The printable character that byte-level BPE shows for each byte: itself, or the next free one from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


@per_worker
def _counts(path: str) -> PieceIds:
    """Pieces of texts with one number each: how many tokens they have."""
    return PieceIds(MergeCounter(path), SPECIAL, REMEMBERED)


def count_tokens(counts: PieceIds, texts: pa.Array) -> np.ndarray:
    """The tokens of each text: the sum over its pieces."""
    found, firsts = counts.of(texts)
    sums = np.concatenate([[0], np.cumsum(found, dtype=np.int64)])
    return sums[firsts[1:]] - sums[firsts[:-1]]


def token_counts(docs: DataFrame, vocabulary: str | None = None, limit: int = TOKEN_LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``docs(doc_id, text)``; no shuffle.

    A null or empty text has 0 tokens. Rows with the same id are counted one by one; other columns are
    ignored. The special token's string inside a text is one token, as the library has it. A worker remembers counts of
    short pieces only, so its memory does not grow with the texts.
    """
    path = vocabulary or tokenizer_path(VOCABULARY)

    def count(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                ids, texts = whole.slice(at, BATCH_ROWS).columns
                totals = pa.array(count_tokens(_counts(path), texts), pa.int64())
                sizes = pc.binary_length(texts).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([ids, sizes, totals], names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(F.col("text")).alias("text"))
    counted = rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
