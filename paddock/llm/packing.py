"""Best-fit packing of documents into training sequences with a bounded number of open bins.

Each task packs its pieces as they come. Open bins stand in lists by free space, and a bitset has
a bit for each list that isn't empty, so the bin that fits best is one shift and one lowest bit
away. When too many bins are open, the fullest closes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import document_keys, drop_staged, staged
from .tokens import encoder, short_runs

PIECES = "doc_id long, text_hash long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"


class OpenBins:
    """A fixed number of open bins of one capacity; place() gives a bin and the offset in it."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.spaces = self.n_open = self.made = 0

    def place(self, size: int) -> tuple[int, int]:
        fitting = self.spaces >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            bin_id = self._take(space)
        else:
            space, bin_id = self.capacity, self.made
            self.made += 1
            if size < space and self.n_open >= self.most:
                self._take((self.spaces & -self.spaces).bit_length() - 1)
        if size < space:
            self.by_space[space - size].append(bin_id)
            self.spaces |= 1 << (space - size)
            self.n_open += 1
        return bin_id, self.capacity - space

    def _take(self, space: int) -> int:
        bin_id = self.by_space[space].pop()
        if not self.by_space[space]:
            self.spaces ^= 1 << space
        self.n_open -= 1
        return bin_id


def pieces(
    docs: DataFrame, tokenizer: str, *, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The pieces of every document: whole, or cut every `capacity` ids where it is longer."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in short_runs(batches):
            ids, counts = encoder(tokenizer).encode_ended(batch.column("text").to_pylist(), end_id)
            ids, n_pieces = ids.astype("<u4", copy=False), -(-counts // capacity)
            row = np.repeat(np.arange(len(counts)), n_pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
            start = piece * capacity
            length = np.minimum(capacity, counts[row] - start)
            at = (np.cumsum(counts) - counts)[row] + start
            crcs = [zlib.crc32(ids[a : a + n]) for a, n in zip(at, length, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row)),
                    batch.column("text_hash").take(pa.array(row)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crcs, pa.int64()),
                ],
                ["doc_id", "text_hash", "piece", "start", "length", "ids_crc32"],
            )

    return document_keys(docs, id_col, text_col).mapInArrow(cut, PIECES)


def pack(
    docs: DataFrame,
    tokenizer: str,
    *,
    capacity: int = 4096,
    end_id: int = 1,
    open_bins: int = 4096,
    task_pieces: int = 500_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Place every piece of every document in a sequence of at most `capacity` ids.

    Null and empty texts hold end_id alone. Pieces are narrow, so a task packs about task_pieces
    of them and only its last open bins stay partly filled. They reach it in the order of a hash,
    which makes a task that runs again give the same sequences. Rows that repeat are packed each
    for itself; a null id stays null; other columns are left out; an empty table gives no row.
    """

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, first = OpenBins(capacity, open_bins), TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [bins.place(size) for size in batch.column("length").to_pylist()]
            arrays = [
                pa.array([first + bin_id for bin_id, _ in placed], pa.int64()),
                pa.array([offset for _, offset in placed], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *arrays], [*batch.schema.names, "sequence_id", "offset"]
            )

    cut = staged(pieces(docs, tokenizer, capacity=capacity, end_id=end_id, id_col=id_col, text_col=text_col))
    tasks = max(1, -(-cut.count() // task_pieces))
    order = F.xxhash64("doc_id", "text_hash", "piece")
    dealt = cut.withColumn("order", order).repartition(tasks, "order").sortWithinPartitions("order", "doc_id", "text_hash", "piece")
    result = staged(dealt.drop("order").mapInArrow(fill, PACKED))
    drop_staged(cut)
    return result.drop("text_hash")
