"""Token ids in binary files of patched frame-of-reference blocks.

A segment is one binary value that holds whole documents: a header, the documents' ids and
lengths, the start of each block, then the blocks. A block of 128 ids keeps its minimum, the
width that holds a given percentile of the differences to it, the low bits of all differences
packed at that width, and a list of exceptions (place, high bits) for the wider ones. Segments
are rows of Parquet files that Spark writes, so any store Spark reaches can hold them.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import document_keys, prefix_sums
from .tokens import encoder, short_runs

BLOCK = 128
HEAD = struct.Struct("<4sIQI")  # mark, documents, ids, blocks
BLOCK_HEAD = 6  # minimum (4 bytes), width, number of exceptions
SEGMENTS = "part int, seq long, n_docs int, n_ids long, payload binary"
DOCUMENTS = "part int, seq long, place long, doc_id long, in_segment long, n_tokens long, ids_crc32 long"


def _bits(values: np.ndarray) -> np.ndarray:
    """The bits of each 32-bit value, lowest first, along a new last axis."""
    raw = np.ascontiguousarray(values, "<u4").view(np.uint8).reshape(*values.shape, 4)
    return np.unpackbits(raw, axis=-1, bitorder="little")


def pack_blocks(ids: np.ndarray, percentile: float) -> tuple[np.ndarray, np.ndarray]:
    """The blocks' bytes and the start of each block in them."""
    n = len(ids)
    if not n:
        return np.empty(0, np.uint8), np.empty(0, np.uint32)
    rows = np.concatenate([ids, np.repeat(ids[-1:], -n % BLOCK)]).astype(np.int64).reshape(-1, BLOCK)
    low = rows.min(axis=1)
    diff = rows - low[:, None]
    rank = min(BLOCK - 1, int(np.ceil(percentile * BLOCK)) - 1)
    typical = np.partition(diff, rank, axis=1)[:, rank]
    width = np.ceil(np.log2(typical + 1)).astype(np.int64)
    wide = diff >= (np.int64(1) << width)[:, None]
    n_wide = wide.sum(axis=1)
    sizes = BLOCK_HEAD + BLOCK // 8 * width + 5 * n_wide
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    out[starts[:, None] + np.arange(4)] = low.astype("<u4").view(np.uint8).reshape(-1, 4)
    out[starts + 4], out[starts + 5] = width, n_wide
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        if w:
            bits = _bits((diff[own] & ((1 << int(w)) - 1)).astype(np.uint32))[:, :, : int(w)]
            packed = np.packbits(bits.reshape(len(own), -1), axis=1, bitorder="little")
            out[(starts[own] + BLOCK_HEAD)[:, None] + np.arange(packed.shape[1])] = packed
    block, place = np.nonzero(wide)
    order = np.arange(len(block)) - np.repeat(np.cumsum(n_wide) - n_wide, n_wide)
    tail = (starts + BLOCK_HEAD + BLOCK // 8 * width)[block]
    out[tail + order] = place
    high = (diff[block, place] >> width[block]).astype("<u4").view(np.uint8).reshape(-1, 4)
    out[(tail + n_wide[block] + 4 * order)[:, None] + np.arange(4)] = high
    return out, starts.astype(np.uint32)


def unpack_blocks(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks at these starts, BLOCK for each."""
    starts = starts.astype(np.int64)
    low = data[starts[:, None] + np.arange(4)].copy().view("<u4").reshape(-1).astype(np.int64)
    width, n_wide = data[starts + 4].astype(np.int64), data[starts + 5].astype(np.int64)
    diff = np.zeros((len(starts), BLOCK), np.int64)
    for w in np.unique(width):
        own = np.flatnonzero(width == w)
        if w:
            packed = data[(starts[own] + BLOCK_HEAD)[:, None] + np.arange(BLOCK // 8 * int(w))]
            bits = np.zeros((len(own), BLOCK, 32), np.uint8)
            bits[:, :, : int(w)] = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(own), BLOCK, int(w))
            diff[own] = np.packbits(bits, axis=-1, bitorder="little").view("<u4").reshape(len(own), BLOCK)
    block = np.repeat(np.arange(len(starts)), n_wide)
    order = np.arange(len(block)) - np.repeat(np.cumsum(n_wide) - n_wide, n_wide)
    tail = (starts + BLOCK_HEAD + BLOCK // 8 * width)[block]
    high = data[(tail + n_wide[block] + 4 * order)[:, None] + np.arange(4)].copy().view("<u4").reshape(-1)
    diff[block, data[tail + order]] |= high.astype(np.int64) << width[block]
    return (diff + low[:, None]).reshape(-1)


def pack_segment(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray, percentile: float) -> bytes:
    """One segment. A null document id has its bit set in the null map that follows the ids."""
    blocks, starts = pack_blocks(ids, percentile)
    known = np.array([0 if x is None else x for x in doc_ids], "<i8")
    null = np.packbits(np.array([x is None for x in doc_ids], bool), bitorder="little")
    parts = (known, null, lengths.astype("<u8"), starts.astype("<u4"), blocks)
    return HEAD.pack(b"PFR1", len(doc_ids), len(ids), len(starts)) + b"".join(p.tobytes() for p in parts)


class Segment:
    """Reads one segment; the block index lets it decode any range of ids alone."""

    def __init__(self, payload: bytes):
        mark, docs, self.n_ids, blocks = HEAD.unpack_from(payload)
        if mark != b"PFR1":
            raise ValueError("not a token segment")
        at = HEAD.size
        known = np.frombuffer(payload, "<i8", docs, at)
        at += 8 * docs
        null = np.unpackbits(np.frombuffer(payload, np.uint8, -(-docs // 8), at), count=docs, bitorder="little")
        at += -(-docs // 8)
        self.doc_ids = [None if gone else int(x) for x, gone in zip(known, null, strict=True)]
        self.lengths = np.frombuffer(payload, "<u8", docs, at).astype(np.int64)
        at += 8 * docs
        self.starts = np.frombuffer(payload, "<u4", blocks, at)
        self.data = np.frombuffer(payload, np.uint8, offset=at + 4 * blocks)

    def read(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        stop = self.n_ids if stop is None else min(stop, self.n_ids)
        if start >= stop:
            return np.empty(0, np.uint32)
        first, last = start // BLOCK, -(-stop // BLOCK)
        ids = unpack_blocks(self.data, self.starts[first:last])
        return ids[start - first * BLOCK : stop - first * BLOCK].astype(np.uint32)


def segments(
    docs: DataFrame,
    tokenizer: str,
    *,
    end_id: int = 1,
    segment_ids: int = 1 << 18,
    percentile: float = 0.9,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Encode whole texts and pack them into segments in ascending id order.

    Null texts are empty and hold end_id alone; null ids come first; documents of one id stand in
    the order of their texts' hashes, equal rows each stand for themselves. A segment ends with
    the document that brings it to segment_ids ids, so only a longer document makes it longer.
    Other columns are left out. An empty table gives no segment.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, n_held = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> pa.RecordBatch:
            names, lengths, ids = ([x[k] for x in held] for k in range(3))
            flat = np.concatenate(ids)
            payload = pack_segment(names, np.array(lengths, np.int64), flat, percentile)
            values = ([part], [seq], [len(names)], [len(flat)], [payload])
            types = (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
            arrays = [pa.array(v, t) for v, t in zip(values, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["part", "seq", "n_docs", "n_ids", "payload"])

        for batch in short_runs(batches):
            ids, counts = encoder(tokenizer).encode_ended(batch.column("text").to_pylist(), end_id)
            ends = np.cumsum(counts)
            for name, count, end in zip(batch.column("doc_id").to_pylist(), counts, ends, strict=True):
                held.append((name, count, ids[end - count : end]))
                n_held += count
                if n_held >= segment_ids:
                    yield flush()
                    seq, held, n_held = seq + 1, [], 0
        if held:
            yield flush()

    keyed = document_keys(docs, id_col, text_col)
    ordered = keyed.repartitionByRange(F.asc_nulls_first("doc_id"), "text_hash").sortWithinPartitions(
        F.asc_nulls_first("doc_id"), "text_hash"
    )
    return ordered.select("doc_id", "text").mapInArrow(encode, SEGMENTS)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, **options) -> None:
    segments(docs, tokenizer, **options).write.option("compression", "none").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """One row for each document in the files: its place and a digest of its decoded ids."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.select(["part", "seq", "payload"]).to_pylist():
                segment = Segment(row["payload"])
                ids, n = segment.read().astype("<u4"), len(segment.lengths)
                starts = np.cumsum(segment.lengths) - segment.lengths
                crcs = [zlib.crc32(ids[s : s + k]) for s, k in zip(starts, segment.lengths, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * n, pa.int32()),
                        pa.array([row["seq"]] * n, pa.int64()),
                        pa.array(np.arange(n), pa.int64()),
                        pa.array(segment.doc_ids, pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array(segment.lengths, pa.int64()),
                        pa.array(crcs, pa.int64()),
                    ],
                    ["part", "seq", "place", "doc_id", "in_segment", "n_tokens", "ids_crc32"],
                )

    files = spark.read.schema(SEGMENTS).parquet(path)
    before = prefix_sums(files.select("part", "seq", "n_ids"), "part", "seq", "n_ids", "before")
    read = files.select("part", "seq", "payload").mapInArrow(decode, DOCUMENTS)
    placed = read.join(before.select("part", "seq", "before"), ["part", "seq"])
    return placed.select(
        "doc_id", (F.col("before") + F.col("in_segment")).alias("start"), "n_tokens", "ids_crc32", "part", "seq"
    )
