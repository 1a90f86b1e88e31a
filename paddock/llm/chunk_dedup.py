"""Substring de-duplication by content-defined chunks.

A gear rolling hash runs over the bytes of a document; a position is a cut where its mixed hash
is the least within `reach` bytes on either side. So a cut depends on the bytes around it alone:
whatever is inserted before, the cuts within a repeated passage come back, and chunks are at
least reach + 1 bytes long. Chunks are told apart by a 128-bit digest; the first one, by
(doc_id, text hash, start), stays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import document_keys, drop_staged, mix, staged

GEAR = (mix(np.arange(256, dtype=np.uint64), seed=10) >> np.uint64(32)).astype(np.uint32)
WINDOW = 32  # bytes that a 32-bit gear hash remembers
CHUNKS = "doc_id long, text_hash long, start long, length long, digest binary"
SPANS = "array<struct<start: bigint, stop: bigint>>"


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """At each byte, the sum of the last 32 bytes' gear values, each shifted by its age."""
    out, span = GEAR[data], 1
    while span < WINDOW:
        older = np.zeros_like(out)
        older[span:] = out[:-span] << np.uint32(span) if len(out) > span else out[:0]
        out, span = out + older, 2 * span
    return out


def _least(values: np.ndarray, reach: int) -> np.ndarray:
    """The least value within the next `reach` places, the own one not counted."""
    most = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.concatenate([values[1:], np.full(1, most)])
    span = 1
    while span < reach:
        step = min(span, reach - span)
        out = np.minimum(out, np.concatenate([out[step:], np.full(step, most)])[: len(out)])
        span += step
    return out


def cuts(data: np.ndarray, reach: int) -> np.ndarray:
    """The places where a chunk ends. Equal hashes within reach: none but the last is a cut."""
    if len(data) < WINDOW + reach:
        return np.empty(0, np.int64)
    hashes = mix(gear_hashes(data).astype(np.uint64))
    # A chunk ends with a whole character, so that what stays is still text.
    hashes[:-1][(data[1:] & 0xC0) == 0x80] = 0xFFFFFFFFFFFFFFFF
    after, before = _least(hashes, reach), _least(hashes[::-1], reach)[::-1]
    found = (hashes < after) & (hashes <= before)
    # The first window isn't full, and the last bytes may go on elsewhere: no cut depends on them.
    found[: WINDOW + reach - 1] = False
    found[len(data) - reach :] = False
    return np.flatnonzero(found) + 1


def chunks(docs: DataFrame, *, reach: int, longest: int, id_col: str, text_col: str) -> DataFrame:
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text.encode() for text in batch.column("text").to_pylist()]
            rows, starts, lengths, digests = [], [], [], []
            for row, text in enumerate(texts):
                ends = [*cuts(np.frombuffer(text, np.uint8), reach).tolist(), len(text)]
                at = 0
                for end in ends:
                    # A stretch without a cut (one letter over and over) is split by length.
                    while at < end:
                        stop = min(end, at + longest)
                        rows.append(row)
                        starts.append(at)
                        lengths.append(stop - at)
                        digests.append(hashlib.blake2b(text[at:stop], digest_size=16).digest())
                        at = stop
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(take),
                    batch.column("text_hash").take(take),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(digests, pa.binary()),
                ],
                ["doc_id", "text_hash", "start", "length", "digest"],
            )

    return document_keys(docs, id_col, text_col).mapInArrow(split, CHUNKS)


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, sizes, digests = [], [], []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            data, parts, at = text.encode(), [], 0
            for span in spans or ():
                parts.append(data[at : span["start"]])
                at = span["stop"]
            rest = b"".join([*parts, data[at:]])
            kept.append(rest)
            sizes.append(len(data))
            digests.append(hashlib.sha256(rest).hexdigest())
        arrays = [pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()), pa.array(digests)]
        names = ["doc_id", "spans"]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(name) for name in names), *arrays], [*names, "kept", "n_bytes", "kept_sha256"]
        )


def _merge(least_run: int):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for parts in batch.column("parts").to_pylist():
                at = np.sort(np.array([p["start"] for p in parts]))
                by_start = {p["start"]: p["length"] for p in parts}
                stop = at + np.array([by_start[x] for x in at.tolist()])
                new = np.concatenate([[True], at[1:] > stop[:-1]])
                first, last = at[new], stop[np.concatenate([new[1:], [True]])]
                whole = last - first >= least_run
                spans.append([{"start": a, "stop": b} for a, b in zip(first[whole].tolist(), last[whole].tolist(), strict=True)])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            arrays = [batch.column("doc_id"), batch.column("text_hash"), pa.array(spans, kind)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text_hash", "spans"])

    return merge


def remove_spans(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's bytes without its spans: doc_id, spans, kept, n_bytes, kept_sha256."""
    keyed = document_keys(docs, id_col, text_col)
    marked = spans.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "spans")
    joined = keyed.join(marked, keyed.doc_id.eqNullSafe(marked._id) & (keyed.text_hash == marked._hash), "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(
        _remove, f"doc_id long, spans {SPANS}, kept binary, n_bytes long, kept_sha256 string"
    )


def find_repeats(
    docs: DataFrame,
    *,
    reach: int = 32,
    longest: int = 4096,
    least_run: int = 64,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row for each document that has bytes to remove: doc_id, text_hash, spans.

    A chunk whose digest stands earlier (smaller id, null first; then text hash, then start) is a
    repeat, in the same document too. Repeats that touch form one span; a span shorter than
    least_run bytes stays, as so few words also meet by chance. Null and empty texts have no
    chunk. A row that repeats with its id is the same document and shares its answer.
    """
    found = staged(chunks(docs, reach=reach, longest=longest, id_col=id_col, text_col=text_col))
    # min() over a struct is combined in the map tasks, so a chunk that stands in a third of all
    # documents sends one row for each task; only chunks seen twice are looked up again.
    place = F.struct("doc_id", "text_hash", "start")
    # Stored, so that the join's two sides are plain exchanges and Spark can split a hot chunk.
    firsts = found.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    firsts = staged(firsts.select("digest", "first"))
    again = found.join(firsts, "digest").where(~place.eqNullSafe(F.col("first")))
    own = again.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "length")).alias("parts"))
    result = staged(own.mapInArrow(_merge(least_run), f"doc_id long, text_hash long, spans {SPANS}"))
    drop_staged(found)
    drop_staged(firsts)
    return result


def drop_repeats(docs: DataFrame, **options) -> DataFrame:
    """Every document with the bytes that stay; documents without a repeat come back whole."""
    names = {k: options[k] for k in ("id_col", "text_col") if k in options}
    return remove_spans(docs, find_repeats(docs, **options), **names)
