"""Best-fit packing with certificates: bins per partition against a lower bound, and exchange where they differ."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routelens.llm.bpe_ids import REMEMBERED, SPECIAL, PieceEncoder, tokenizer_path
from routelens.llm.common import per_worker, whole_text, written
from routelens.llm.piece_ids import PieceIds

CAPACITY = 2048
VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
#: Pieces that one task packs.
PARTITION_PIECES = 100_000
#: Texts that are turned into ids at once.
BATCH_ROWS = 500
ROUNDS = 4
PIECE_COLUMNS = ("doc_id", "piece", "start", "length", "ids_crc32")


@per_worker
def _ids(path: str) -> PieceIds:
    return PieceIds(PieceEncoder(path), SPECIAL, REMEMBERED)


def cut_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every row's token ids, which end with ``END_ID``; no shuffle.

    A document of at most ``capacity`` ids is one piece. A longer one is cut into pieces of that length, the
    first of which may be shorter. A null or empty text is the end id alone. Rows with the same id are cut one by one.
    """
    path = vocabulary or tokenizer_path(VOCABULARY)
    def cut(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                yield pieces(whole.slice(at, BATCH_ROWS))

    def pieces(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, firsts = _ids(path).of(batch.column(1))
        ids = np.insert(ids, firsts[1:], np.uint32(END_ID)).astype("<u4", copy=False)
        firsts = firsts + np.arange(len(firsts))
        total = np.diff(firsts)
        count = -(-total // capacity)
        row = np.repeat(np.arange(len(total)), count)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        head = total - (count - 1) * capacity  # the first piece, which may be shorter
        start = np.where(piece > 0, head[row] + (piece - 1) * capacity, 0)
        length = np.where(piece > 0, capacity, head[row])
        data = memoryview(ids).cast("B")
        begin = 4 * (firsts[row] + start)
        sums = [zlib.crc32(data[a:b]) for a, b in zip(begin.tolist(), (begin + 4 * length).tolist(), strict=True)]
        columns = [batch.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(sums, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=list(PIECE_COLUMNS))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(F.col("text")).alias("text"))
    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """The least number of bins that dual feasible functions prove.

    One family rounds lengths over ``capacity - t`` up to a whole bin and drops those under ``t``; the other rounds
    multiples of ``capacity / (k + 1)`` down. Each maps any set that fits a bin to one that fits, so the sum is a bound.
    """
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((count * size).sum()) // capacity)
    many, much = np.cumsum(count), np.cumsum(count * size)
    for t in range(1, capacity // 2 + 1):
        large = int(many[capacity] - many[capacity - t])
        middle = int(much[capacity - t] - much[t - 1])
        best = max(best, large + -(-middle // capacity))
    for k in range(1, 41):
        parts = (k + 1) * size
        value = np.where(parts % capacity == 0, k * size, (parts // capacity) * capacity)  # in units of 1 / (k * capacity)
        best = max(best, -(-int((count * value).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, int]:
    """``(bin, offset)`` of every piece and the number of bins. Open bins are kept by room left; a bit set finds the tightest."""
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, used = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            bin_ = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            bin_, room, used = used, capacity, used + 1
        bins[i], offsets[i] = bin_, capacity - room
        room -= size
        if room:
            by_room[room].append(bin_)
            rooms |= 1 << room
    return bins, offsets, used


def pack(pieces: DataFrame, capacity: int = CAPACITY, partition_pieces: int = PARTITION_PIECES, rounds: int = ROUNDS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: every piece in one sequence of at most ``capacity``, gapless from 0.

    Pieces are dealt evenly to partitions and packed there. A partition whose number of bins is its lower bound is
    certified and done. The others give up the bins that are not full; these pieces are dealt anew to fewer
    partitions and packed again, which is kept if it saves bins. Only sizes and ids move, never texts, and the driver sees
    two numbers a round. Pieces longer than ``capacity`` are refused; rows alike are packed one by one.
    """
    columns = pieces.columns
    numbered = written(pieces.withColumn("__row", F.monotonically_increasing_id()), "pieces")
    sizes = numbered.agg(F.count("*").alias("n"), F.max("length").alias("longest")).first()
    if sizes["longest"] is not None and sizes["longest"] > capacity:
        raise ValueError(f"a piece of {sizes['longest']} does not fit a sequence of {capacity}")
    parts = max(1, -(-sizes["n"] // partition_pieces))
    state = written(_packed(numbered, parts, 0, capacity), "packed")
    for round_ in range(1, rounds + 1):
        open_ = state.where("__gap > 0 AND __fill < %d" % capacity)
        seen = open_.agg(F.count("*").alias("n"), F.countDistinct("sequence_id").alias("bins"), F.countDistinct("__part").alias("parts")).first()
        if seen["parts"] < 2:
            break
        fewer = min(max(1, -(-seen["n"] // partition_pieces)), seen["parts"] - 1)
        again = written(_packed(open_.select(*columns, "__row"), fewer, round_, capacity), "packed")
        bins = again.agg(F.countDistinct("sequence_id")).first()[0]
        if bins >= seen["bins"]:
            break
        kept = state.where("NOT (__gap > 0 AND __fill < %d)" % capacity)
        state = written(kept.unionByName(again), "packed")
    return state.select(*columns, "sequence_id", "offset")


def _packed(rows: DataFrame, parts: int, round_: int, capacity: int) -> DataFrame:
    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        lengths = pdf["length"].to_numpy(np.int64)
        bins, offsets, used = best_fit_decreasing(lengths, capacity)
        fill = np.bincount(bins, weights=lengths, minlength=used).astype(np.int64)
        part = int(pdf["__part"].iloc[0])
        return pdf.assign(
            sequence_id=(round_ << 56) + (part << 28) + bins, offset=offsets, __fill=fill[bins], __gap=used - lower_bound(lengths, capacity)
        )

    part = F.pmod(F.xxhash64("__row", F.lit(round_)), F.lit(parts)).cast("int")
    dealt = rows.withColumn("__part", part)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema.fields)
    return dealt.groupBy("__part").applyInPandas(one, f"{schema}, sequence_id long, offset long, __fill long, __gap long")
