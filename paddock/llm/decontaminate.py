"""Benchmark decontamination by q-gram counting in diagonal bands and banded alignment.

Texts are compared in lower case with every run of other characters than letters and digits as one
space. An item is searched as segments of `segment` bytes, half overlapping, so a passage of one
and a half segments holds a whole one. By the q-gram lemma, a place that matches a segment of m
bytes with e edits shares at least m - q + 1 - q * e grams with it, on diagonals at most e apart.
Hits are counted in overlapping bands of diagonals; bands that reach the bound are aligned.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import document_keys, gram_hashes, ragged, shared_folder

OTHER = re.compile(r"[\W_]+")
SPACES = bytes(c if chr(c).isalnum() else 32 for c in range(128)) + bytes(range(128, 256))
FILTER_BITS = 20
FOUND = (
    "doc_id long, text_hash long, item_id long, segments_found int, segments int, edits int, "
    "first_byte long, last_byte long"
)


def normalised(text: str) -> bytes:
    low = text.lower()
    if low.isascii():
        return b" ".join(low.encode().translate(SPACES).split())
    return OTHER.sub(" ", low).strip().encode()


class Index:
    """The segments of one block of items and where each gram stands in them."""

    def __init__(self, items: list[tuple[int | None, str]], q: int, rate: float, segment: int):
        self.q, self.items = q, [item for item, _ in items]
        self.segments: list[bytes] = []
        item_of, short = [], []
        for i, (_, text) in enumerate(items):
            data = normalised(text)
            if len(data) < q:
                if data:
                    short.append((i, b" " + data + b" "))
                continue
            last = max(0, len(data) - segment)
            for at in [*range(0, last, max(1, segment // 2)), last]:
                self.segments.append(data[at : at + segment])
                item_of.append(i)
        self.short, self.item_of = short, np.array(item_of, np.int64)
        self.size = np.array([len(s) for s in self.segments], np.int64)
        # So many edits at most that the lemma still asks for one common gram.
        self.edits = np.minimum((rate * self.size).astype(np.int64), (self.size - q) // q)
        self.least = self.size - q + 1 - q * self.edits
        self.per_item = np.bincount(self.item_of, minlength=len(items)) + np.bincount(
            [i for i, _ in short], minlength=len(items)
        )
        self.band = int(self.edits.max(initial=0)) + 1
        hashes = [gram_hashes(np.frombuffer(s, np.uint8), q) for s in self.segments]
        flat = np.concatenate([*hashes, np.empty(0, np.uint64)])
        order = np.argsort(flat, kind="stable")
        counts = np.array([len(h) for h in hashes], np.int64)
        self.seg = np.repeat(np.arange(len(hashes)), counts)[order]
        self.off = ragged(np.zeros(len(hashes), np.int64), counts)[order]
        self.grams, self.first, self.times = np.unique(flat[order], return_index=True, return_counts=True)
        self.maybe = np.zeros(1 << FILTER_BITS, bool)
        self.maybe[(self.grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True

    def candidates(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, segment, lowest diagonal) of the bands that reach the bound.

        data: the documents one after the other, each followed by a zero byte; starts: theirs.
        """
        none = np.empty(0, np.int64)
        hashes = gram_hashes(data, self.q)
        at = np.flatnonzero(self.maybe[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        if not len(at) or not len(self.grams):
            return none, none, none
        place = np.minimum(np.searchsorted(self.grams, hashes[at]), len(self.grams) - 1)
        same = self.grams[place] == hashes[at]
        at, place = at[same], place[same]
        if not len(at):
            return none, none, none
        entry = ragged(self.first[place], self.times[place])
        at = np.repeat(at, self.times[place])
        doc = np.searchsorted(starts, at, side="right") - 1
        seg = self.seg[entry]
        diagonal = at - starts[doc] - self.off[entry]
        low = np.floor_divide(diagonal, self.band)
        # Each diagonal lies in two bands of twice the width; the offset keeps the keys positive.
        low = np.concatenate([low, low - 1]) + (1 << 12)
        doc, seg = np.concatenate([doc, doc]), np.concatenate([seg, seg])
        order = np.lexsort((low, seg, doc))
        doc, seg, low = doc[order], seg[order], low[order]
        new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (seg[1:] != seg[:-1]) | (low[1:] != low[:-1])])
        first = np.flatnonzero(new)
        times = np.diff(np.concatenate([first, [len(doc)]]))
        enough = first[times >= self.least[seg[first]]]
        return doc[enough], seg[enough], (low[enough] - (1 << 12)) * self.band

    def align(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc, seg, low) -> tuple[np.ndarray, np.ndarray]:
        """The fewest edits that turn each segment into a part of its band, and where that ends."""
        best, stop = np.empty(len(doc), np.int64), np.empty(len(doc), np.int64)
        for a in range(0, len(doc), 4096):
            part = slice(a, a + 4096)
            best[part], stop[part] = self._align(data, starts[doc[part]], ends[doc[part]], seg[part], low[part])
        return best, stop

    def _align(self, data, starts, ends, seg, low):
        slack = int(self.edits.max(initial=0))
        left, width, longest = low - slack, 2 * self.band + 2 * slack, int(self.size[seg].max())
        text = np.zeros((len(seg), longest), np.uint8)
        for i, s in enumerate(seg.tolist()):
            text[i, : self.size[s]] = np.frombuffer(self.segments[s], np.uint8)
        # The document bytes under the band, zero outside of the document.
        at = (starts + left)[:, None] + np.arange(longest + width)
        inside = (at >= starts[:, None]) & (at < ends[:, None])
        under = np.where(inside, data[np.clip(at, 0, len(data) - 1)], 0)
        steps = np.arange(width)
        cost = np.zeros((len(seg), width), np.int64)
        best, stop = np.zeros(len(seg), np.int64), np.zeros(len(seg), np.int64)
        for i in range(longest):
            swap = cost + (under[:, i : i + width] != text[:, i : i + 1])
            skip = np.full_like(cost, 1 << 20)
            skip[:, :-1] = cost[:, 1:] + 1
            cost = np.minimum(swap, skip)
            cost = np.minimum.accumulate(cost - steps, axis=1) + steps
            done = np.flatnonzero(self.size[seg] == i + 1)
            if len(done):
                d = cost[done].argmin(axis=1)
                best[done], stop[done] = cost[done, d], left[done] + d + i + 1
        return best, stop

    def search(self, texts: list[str]) -> list[tuple[int, int, int, int, int, int]]:
        """(document, item, segments found, edits, first byte, last byte) of each pair found."""
        docs = [normalised(text) for text in texts]
        sizes = np.array([len(d) for d in docs], np.int64)
        starts = np.cumsum(sizes + 1) - sizes - 1
        data = np.frombuffer(b"".join(d + b"\0" for d in docs), np.uint8)
        doc, seg, low = self.candidates(data, starts)
        edits, stop = self.align(data, starts, starts + sizes, doc, seg, low)
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for d, s, e, end in zip(doc.tolist(), seg.tolist(), edits.tolist(), stop.tolist(), strict=True):
            if e <= self.edits[s] and (e, end) < best.get((d, s), (1 << 30, 0)):
                best[d, s] = e, end
        pairs: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        for (d, s), (e, end) in best.items():
            pairs.setdefault((d, int(self.item_of[s])), []).append((e, max(0, end - int(self.size[s])), end))
        for d, data_of in enumerate(docs if self.short else ()):
            framed = b" " + data_of + b" "
            for i, word in self.short:
                at = framed.find(word)
                if at >= 0:
                    pairs[d, i] = [(0, at, at + len(word) - 2)]
        return [
            (d, i, len(f), sum(x[0] for x in f), min(x[1] for x in f), max(x[2] for x in f))
            for (d, i), f in sorted(pairs.items())
        ]


_INDEXES: dict[str, Index] = {}


def _index(items: list[tuple[int | None, str]], *options) -> Index:
    """The index of a block, built once in each worker; the last one is kept."""
    key = hashlib.sha256(repr((items, options)).encode()).hexdigest()
    if key not in _INDEXES:
        _INDEXES.clear()
        _INDEXES[key] = Index(items, *options)
    return _INDEXES[key]


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_chars: int) -> Iterator[list]:
    """The items in blocks of about block_chars characters, fetched one block at a time."""
    rows = benchmark.select(benchmark[item_col].cast("long"), F.coalesce(benchmark[text_col].cast("string"), F.lit("")))
    block, size = [], 0
    for item, text in rows.toLocalIterator():
        block.append((item, text))
        size += len(text)
        if size >= block_chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    q: int = 12,
    rate: float = 0.06,
    segment: int = 100,
    block_chars: int = 1_000_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row for each document and item of which it holds a segment with rate edits a byte.

    Columns: doc_id, text_hash, item_id, segments_found, segments (of the item), edits, and the
    bytes [first_byte, last_byte) of the normalised document that the segments found cover.
    Items of fewer than q bytes are found as whole words only; empty items and texts match
    nothing; null counts as empty. Rows that repeat answer each for itself. The benchmark is a stated query set: every
    block of it (block_chars bounds what a task holds) passes over all documents once. What
    several blocks find is stored block by block while this runs; one block is lazy. Other
    columns are left out; either table may be empty.
    """
    keyed = document_keys(docs, id_col, text_col)

    def passed(items: list) -> DataFrame:
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = _index(items, q, rate, segment)
            for whole in batches:
                for batch in (whole.slice(i, 500) for i in range(0, whole.num_rows, 500)):
                    found = index.search(batch.column("text").to_pylist())
                    if not found:
                        continue
                    doc, item, segments, edits, first, last = zip(*found, strict=True)
                    take = pa.array(doc, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").take(take),
                            batch.column("text_hash").take(take),
                            pa.array([index.items[i] for i in item], pa.int64()),
                            pa.array(segments, pa.int32()),
                            pa.array([int(index.per_item[i]) for i in item], pa.int32()),
                            pa.array(edits, pa.int32()),
                            pa.array(first, pa.int64()),
                            pa.array(last, pa.int64()),
                        ],
                        [name.split()[0] for name in FOUND.split(", ")],
                    )

        return keyed.mapInArrow(scan, FOUND)

    spark = docs.sparkSession
    blocks = _blocks(benchmark, item_col, item_text_col, block_chars)
    first, second = next(blocks, None), next(blocks, None)
    if first is None:
        return spark.createDataFrame([], FOUND)
    if second is None:
        return passed(first)
    # What a block finds is stored before the block after the next is fetched, so neither the driver nor a plan holds all.
    path = f"{shared_folder(spark)}/found-{uuid.uuid4().hex}"
    for items in chain((first, second), blocks):
        passed(items).write.mode("append").parquet(path)
    return spark.read.schema(FOUND).parquet(path)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs, with all columns, that hold no segment of any item."""
    found = find_contamination(docs, benchmark, id_col=id_col, text_col=text_col, **options)
    bad = found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    same = docs[id_col].cast("long").eqNullSafe(bad._id) & (F.xxhash64(text) == bad._hash)
    return docs.join(bad, same, "left_anti")
