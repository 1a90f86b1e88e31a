"""Near-duplicate documents by a chosen-path similarity join on word shingles.

Each run samples, from a document's set, every shingle whose hash is under 1 / (similarity * set
size); a sampled shingle is a bucket's path. Two sets that are similar enough share one path in
expectation. Paths whose bucket is too large are extended by the same rule, one more shingle a
level. Runs are repeated until the target recall, which follows from the branching process.
Buckets are compared on bottom-k sketches, but for what is connected already; the components that
come out are then compared on whole sets, which decides every link. A large bucket or component is
cut into blocks of bounded size, and each task compares two blocks, a pair of tiles at a time.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASE, document_keys, drop_staged, mix, ragged, staged
from .components import components

LEVELS = 2
SETS = (
    "doc_id long, text_hash long, set_id binary, shingles int, sketch array<int>, "
    "paths array<struct<path: bigint, next: array<bigint>>>"
)
COLUMNS = 4096  # distinct shingles that are compared at once
SPREAD = 8  # blocks of a group, and so times that a row is dealt, while the blocks stay within the bounds below
FILTER_BITS = 1 << 26  # of the filter that keeps texts out of a shuffle which are not asked for: 8 MB, however many rows
BLOCK_TILES, BLOCK_SHINGLES = 32, 4_000_000  # a task holds two blocks of at most so many tiles and shingles


def runs_for(recall: float, levels: int = LEVELS) -> int:
    """Runs that find a pair at the threshold with this probability, if every bucket splits."""
    found = 1.0
    for _ in range(levels):
        found = 1 - math.exp(-found)
    return math.ceil(math.log(1 - recall) / math.log(1 - found))


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted hashes of each text's distinct shingles; a shorter text is one shingle."""
    split = pc.utf8_split_whitespace(pc.utf8_lower(texts.cast(pa.large_string())))
    flat, bounds = split.flatten(), np.asarray(split.offsets)
    full = np.asarray(pc.not_equal(flat, pa.scalar("", pa.large_string()))) if len(flat) else np.empty(0, bool)
    counts = np.concatenate([[0], np.cumsum(full)])
    bounds = counts[bounds - bounds[0]]
    coded = flat.filter(pa.array(full)).dictionary_encode() if len(flat) else None
    if coded is None or not len(coded):
        return [np.empty(0, np.uint64)] * len(texts)
    known = [xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_numpy(zero_copy_only=False)]
    codes = np.array(known, np.uint64)[np.asarray(coded.indices)]
    power = [np.uint64(pow(int(BASE), j, 1 << 64)) for j in range(words)]
    n = len(codes)
    rolled = np.zeros(max(0, n - words + 1), np.uint64)
    for j in range(words):
        rolled += codes[j : n - words + 1 + j] * power[j] if n >= words else np.uint64(0)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= words:
            own = rolled[a : b - words + 1]
        elif b > a:
            own = np.array([(codes[a:b] * np.array(power[: b - a])).sum() + np.uint64(b - a)], np.uint64)
        else:
            own = np.empty(0, np.uint64)
        out.append(np.unique(mix(own)))
    return out


def _signed(values: np.ndarray) -> list[int]:
    return values.astype(np.uint64).view(np.int64).tolist()


def chosen_paths(shingles: np.ndarray, seeds: np.ndarray, similarity: float) -> list[dict]:
    """The paths of all runs, each with the paths that extend it by one more shingle."""
    limit = min(1.0, 1 / (similarity * len(shingles)))
    bound = np.uint64(min(2**64 - 1, int(limit * 2**64)))
    out = []
    for seed in seeds:
        for token in shingles[shingles * seed <= bound]:
            path = mix(np.array([token]) ^ seed)
            onward = shingles[(shingles * (path[0] | np.uint64(1)) <= bound) & (shingles != token)]
            out.append({"path": _signed(path)[0], "next": _signed(mix(onward ^ path))})
    return out


def sketch_sets(docs: DataFrame, *, words: int, similarity: float, runs: int, sketch: int, id_col: str, text_col: str) -> DataFrame:
    seeds = mix(np.arange(runs, dtype=np.uint64), seed=4) | np.uint64(1)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("path", pa.int64()), ("next", pa.list_(pa.int64()))]))
        for whole in batches:
            for batch in (whole.slice(i, 2000) for i in range(0, whole.num_rows, 2000)):
                found = shingle_sets(batch.column("text"), words)
                ids = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in found]
                arrays = [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(ids, pa.binary()),
                    pa.array([len(s) for s in found], pa.int32()),
                    # One value more than the sketch's length tells that the set goes on.
                    pa.array([np.unique(s[: sketch + 1] >> np.uint64(33)).astype(np.int32) for s in found], pa.list_(pa.int32())),
                    pa.array([chosen_paths(s, seeds, similarity) if len(s) else [] for s in found], kind),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "text_hash", "set_id", "shingles", "sketch", "paths"])

    return document_keys(docs, id_col, text_col).mapInArrow(sets, SETS)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of rows with equal keys, from batches that are sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k) for k in keys]
        differs = np.zeros(batch.num_rows - 1, bool)
        for col in columns:
            differs |= np.asarray(pc.not_equal(col.slice(1), col.slice(0, len(col) - 1))) if len(col) > 1 else False
        marks = np.flatnonzero(differs) + 1
        first = tuple(col[0].as_py() for col in columns)
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        at = 0
        for mark in marks.tolist():
            held.append(batch.slice(at, mark - at))
            yield pa.Table.from_batches(held)
            held, at = [], mark
        held.append(batch.slice(at))
        last = tuple(col[batch.num_rows - 1].as_py() for col in columns)
    if held:
        yield pa.Table.from_batches(held)


@dataclass
class Rows:
    """Sets one after the other: the codes of all values, and where each set begins and ends."""

    codes: np.ndarray
    bounds: np.ndarray
    values: int

    def tile(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The codes of these sets, and for each code the place of its set in `rows`."""
        sizes = self.bounds[rows + 1] - self.bounds[rows]
        return self.codes[ragged(self.bounds[rows], sizes)], np.repeat(np.arange(len(rows)), sizes)


def coded(sets: list[np.ndarray]) -> Rows:
    """Values as numbers from 0; those that only one set holds are left out."""
    values, codes, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = seen >= 2
    keep = shared[codes]
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    before = np.concatenate([[0], np.cumsum(keep)])
    return Rows((np.cumsum(shared) - 1)[codes[keep]], before[bounds], int(shared.sum()))


def common_counts(rows: Rows, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many values each set of `left` has in common with each of `right`."""
    (a, a_row), (b, b_row) = rows.tile(left), rows.tile(right)
    out = np.zeros((len(left), len(right)), np.float32)
    in_b, both = np.zeros(rows.values, bool), np.zeros(rows.values, bool)
    in_b[b] = True
    both[a[in_b[a]]] = True
    place, total = np.cumsum(both) - 1, int(both.sum())
    a, a_row, b, b_row = place[a[both[a]]], a_row[both[a]], place[b[both[b]]], b_row[both[b]]
    for at in range(0, total, COLUMNS):
        parts = []
        for code, row, height in ((a, a_row, len(left)), (b, b_row, len(right))):
            here = (code >= at) & (code < at + COLUMNS)
            part = np.zeros((height, min(COLUMNS, total - at)), np.float32)
            part[row[here], code[here] - at] = 1
            parts.append(part)
        out += parts[0] @ parts[1].T
    return out.astype(np.int64)


class Joined:
    """Rows that links connect, over any number of steps, under the first of them."""

    def __init__(self, rows: int) -> None:
        self.parent = np.arange(rows)

    def roots(self, rows: np.ndarray) -> np.ndarray:
        root = self.parent[rows]
        while (self.parent[root] != root).any():
            root = self.parent[root]
        self.parent[rows] = root
        return root

    def link(self, left: np.ndarray, right: np.ndarray, linked: np.ndarray) -> None:
        """Join the rows that this matrix links; each pass joins every row of `left` with one other group."""
        while True:
            a, b = self.roots(left), self.roots(right)
            apart = linked & (a[:, None] != b[None, :])
            rows = np.flatnonzero(apart.any(axis=1))
            if not len(rows):
                return
            for i, j in zip(left[rows].tolist(), right[apart[rows].argmax(axis=1)].tolist(), strict=True):
                ends = self.roots(np.array([i, j]))
                self.parent[ends.max()] = ends.min()


def tiles(low: np.ndarray, high: np.ndarray | None, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Pairs of tiles in which any two rows of one block (high is None), or any of both blocks, meet once.

    The last value tells whether the tiles are the same rows.
    """
    cut = lambda rows: [rows[i : i + size] for i in range(0, len(rows), size)]
    first = cut(low)
    for i, rows in enumerate(first):
        for j, others in enumerate(first[i:] if high is None else cut(high)):
            yield rows, others, high is None and not j


def _blocks(df: DataFrame, key: str, tile: int, most_rows: int, weight: str | None = None) -> DataFrame:
    """The number of blocks of every group of two rows or more. Stored, so that Spark can split a hot group where it is joined.

    A group of more rows than a tile has up to SPREAD blocks, which is how often each of its rows is dealt; it has more only
    where a block would exceed most_rows rows or, in the sum of `weight`, BLOCK_SHINGLES.
    """
    sizes = df.groupBy(key).agg(F.count("*").alias("_n"), F.sum(weight or F.lit(0)).alias("_weight")).where("_n > 1")
    blocks = F.greatest(
        F.least(F.ceil(F.col("_n") / tile), F.lit(SPREAD)), F.ceil(F.col("_n") / most_rows), F.ceil(F.col("_weight") / BLOCK_SHINGLES)
    )
    return staged(sizes.select(key, blocks.cast("int").alias("_blocks")))


def _blocked(df: DataFrame, blocks: DataFrame, key: str) -> DataFrame:
    """Deal the rows of a group to pairs of its blocks, so any two rows meet once.

    Adds `block` and the pair (`low`, `high`); each row of a group of b blocks stands in b pairs.
    Groups of one row are left out.
    """
    block = F.pmod(F.xxhash64("set_id"), F.col("_blocks")).cast("int")
    others = F.sequence(F.lit(0), F.col("_blocks") - 1)
    dealt = df.join(blocks, key).withColumn("block", block).withColumn("_other", F.explode(others))
    pair = {"low": F.least("block", "_other"), "high": F.greatest("block", "_other")}
    return dealt.withColumns(pair).drop("_blocks", "_other")


def _sides(group: pa.Table) -> tuple[np.ndarray, np.ndarray | None]:
    """The rows of the pair's two blocks; None for the second where the pair is one block with itself."""
    low, high = group.column("low")[0].as_py(), group.column("high")[0].as_py()
    block = group.column("block").to_numpy()
    return np.flatnonzero(block == low), None if low == high else np.flatnonzero(block == high)


def _bucket_edges(sketch: int, least: float, tile: int):
    """Links that connect all rows of a bucket whose sketches have an estimated similarity of at least `least`."""
    top = np.iinfo(np.int32).max

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket in groups(batches, ["bucket", "low", "high"]):
            ids = bucket.column("set_id").to_pylist()
            sketches = [np.array(s, np.int32) for s in bucket.column("sketch").to_pylist()]
            # Two sketches are complete up to the lower of their last values.
            ends = np.array([s[sketch - 1] if len(s) > sketch else top for s in sketches])
            cut = [s[:sketch] for s in sketches]
            rows, joined = coded(cut), Joined(len(cut))
            for left, right, _ in tiles(*_sides(bucket), tile):
                # What is connected already need not be compared.
                known = joined.roots(left)
                if (known == known[0]).all():
                    right = right[joined.roots(right) != known[0]]
                if not len(right):
                    continue
                upto = np.minimum(ends[left][:, None], ends[right][None, :])
                sizes = np.stack([np.searchsorted(cut[i], upto[k], side="right") for k, i in enumerate(left)])
                sizes += np.stack([np.searchsorted(cut[j], upto[:, k], side="right") for k, j in enumerate(right)], axis=1)
                both = common_counts(rows, left, right)
                joined.link(left, right, both >= least * (sizes - both))
            root = joined.roots(np.arange(len(ids)))
            own = np.flatnonzero(root != np.arange(len(root)))
            if len(own):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[i] for i in own], pa.binary()), pa.array([ids[i] for i in root[own]], pa.binary())],
                    ["a", "b"],
                )

    return compare


def _links(words: int, similarity: float, tile: int):
    """For each row of a pair of blocks how many rows it links to, copies included, and one row that stands for all it is connected with."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["root", "low", "high"]):
            ids, copies = group.column("set_id").to_pylist(), group.column("copies").to_numpy()
            sets = shingle_sets(pa.concat_arrays(group.column("text").chunks), words)
            sizes, rows, joined = np.array([len(s) for s in sets]), coded(sets), Joined(len(sets))
            del sets
            links = np.zeros(len(ids), np.int64)
            for left, right, same in tiles(*_sides(group), tile):
                both = common_counts(rows, left, right)
                linked = both >= similarity * (sizes[left][:, None] + sizes[right][None, :] - both)
                if same:
                    np.fill_diagonal(linked, False)
                links[left] += linked @ copies[right]
                if not same:
                    links[right] += copies[left] @ linked
                joined.link(left, right, linked)
            root = joined.roots(np.arange(len(ids)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.binary()), pa.array([ids[i] for i in root], pa.binary()), pa.array(links, pa.int64())],
                ["set_id", "peer", "links"],
            )

    return compare


def likely(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of keyed whose text_hash may be a `_hash` of wanted; none that is one is left out.

    The hashes are marked in a bitmap of FILTER_BITS bits in pieces of 4 KB, which are broadcast. The fuller it
    is, the more other rows pass.
    """
    marks = wanted.select(F.pmod("_hash", F.lit(FILTER_BITS)).alias("_mark"))
    pieces = marks.groupBy(F.bitmap_bucket_number("_mark").alias("_piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_mark")).alias("_bits")
    )
    mark = F.pmod("text_hash", F.lit(FILTER_BITS))
    row = keyed.withColumn("_piece", F.bitmap_bucket_number(mark)).withColumn("_at", F.bitmap_bit_position(mark))
    byte = F.conv(F.hex(F.substring("_bits", F.floor(F.col("_at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.floor(byte / F.pow(F.lit(2), F.col("_at") % 8)) % 2 == 1
    return row.join(F.broadcast(pieces), "_piece").where(marked).select(*keyed.columns)


def near_duplicates(
    docs: DataFrame,
    *,
    words: int = 5,
    similarity: float = 0.8,
    recall: float = 0.999,
    sketch: int = 64,
    slack: float = 0.25,
    bucket_rows: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row for each row of docs: doc_id, class_id, n_links, class_key, text_hash.

    Words are lower-cased and stand between white space. n_links counts the other rows whose
    set of `words`-word shingles has a Jaccard similarity of `similarity` or more, copies
    included; class_id is the least id of all that such links connect (null only where all ids
    are null). A text of fewer words is one shingle; one without words links to nothing, and
    its class is its own id. Equal rows count as copies of each other. Other columns are left out.

    slack is how far a sketch's estimate may be under the similarity (five standard errors of a
    64-value sketch at 0.8) for the exact comparison to follow.
    """
    runs = runs_for(recall)
    sets = staged(
        sketch_sets(docs, words=words, similarity=similarity, runs=runs, sketch=sketch, id_col=id_col, text_col=text_col)
    )
    # Equal sets are one node; a set that a third of all rows share is combined in the map tasks.
    classes = staged(
        sets.where("set_id IS NOT NULL")
        .groupBy("set_id")
        .agg(
            F.count("*").alias("copies"),
            F.min("doc_id").alias("least_id"),
            F.min(F.struct("doc_id", "text_hash")).alias("rep"),
            F.max("shingles").alias("shingles"),
        )
    )

    # Narrow rows first: a path is of use where two different sets have it, which the least and the
    # greatest of their hashes tell without a list of them.
    paths = sets.select("set_id", F.explode("paths.path").alias("path"))
    own = F.xxhash64("set_id")
    # Stored, so that the join's two sides are plain exchanges and Spark can split a hot path.
    shared = staged(paths.groupBy("path").agg(F.min(own).alias("a"), F.max(own).alias("b")).where("a <> b").select("path"))
    first = staged(paths.join(shared, "path").distinct())
    drop_staged(shared)
    sizes = first.groupBy("path").agg(F.count("*").alias("n"))
    large = staged(sizes.where(F.col("n") > bucket_rows).select("path"))
    small = first.join(large, "path", "left_anti").select(F.col("path").alias("bucket"), "set_id")
    onward = sets.select("set_id", F.explode("paths").alias("p")).select("set_id", "p.*").join(large, "path")
    onward = onward.select(F.explode("next").alias("bucket"), "set_id").distinct()
    wanted_sketches = sets.join(first.select("set_id").distinct(), "set_id", "left_semi")
    sketches = wanted_sketches.groupBy("set_id").agg(F.first("sketch").alias("sketch"))
    in_buckets = small.union(onward)
    bucket_blocks = _blocks(in_buckets, "bucket", bucket_rows, BLOCK_TILES * bucket_rows)
    buckets = _blocked(in_buckets, bucket_blocks, "bucket").join(sketches, "set_id")
    sorted_buckets = buckets.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high", "set_id")
    maybe = sorted_buckets.select("bucket", "low", "high", "block", "set_id", "sketch").mapInArrow(
        _bucket_edges(sketch, similarity - slack, bucket_rows), "a binary, b binary"
    )
    found = staged(components(maybe))
    drop_staged(first)
    drop_staged(bucket_blocks)

    # Whole sets decide. Only one text of each set in a component is fetched.
    wanted = staged(
        found.join(classes, found.node == classes.set_id).select(
            "set_id", "root", "copies", "shingles", F.col("rep.doc_id").alias("_id"), F.col("rep.text_hash").alias("_hash")
        )
    )
    drop_staged(found)
    keyed = likely(document_keys(docs, id_col, text_col), wanted)
    fetched = keyed.join(wanted, keyed.doc_id.eqNullSafe(wanted._id) & (keyed.text_hash == wanted._hash))
    members = fetched.select("set_id", "root", "copies", "text").dropDuplicates(["set_id"])
    # Every set found has one member, so the narrow table tells the sizes.
    tile = max(1, bucket_rows // 2)
    root_blocks = _blocks(wanted, "root", tile, BLOCK_TILES * tile, "shingles")
    dealt = _blocked(members, root_blocks, "root")
    verified = staged(
        dealt.repartition("root", "low", "high")
        .sortWithinPartitions("root", "low", "high", "set_id")
        .mapInArrow(_links(words, similarity, tile), "set_id binary, peer binary, links long")
    )
    drop_staged(wanted)
    drop_staged(root_blocks)
    joined = components(verified.select(F.col("set_id").alias("a"), F.col("peer").alias("b")))
    links = verified.groupBy("set_id").agg(F.sum("links").alias("links"))
    named = classes.join(joined, classes.set_id == joined.node, "left").select(
        "set_id", "copies", "least_id", F.coalesce("root", "set_id").alias("root")
    )
    roots = named.groupBy("root").agg(F.min("least_id").alias("class_id"))
    answers = named.join(roots, "root").join(links, "set_id", "left").select(
        "set_id", F.col("root").alias("class_key"), "class_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    result = sets.where("set_id IS NOT NULL").select("doc_id", "text_hash", "set_id").join(answers, "set_id")
    wordless = sets.where("set_id IS NULL").select(
        "doc_id",
        F.col("doc_id").alias("class_id"),
        F.lit(0).cast("long").alias("n_links"),
        F.lit(None).cast("binary").alias("class_key"),
        "text_hash",
    )
    linked = result.select("doc_id", "class_id", F.col("n_links").cast("long").alias("n_links"), "class_key", "text_hash")
    return linked.unionByName(wordless)


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each class, with all columns: the one with the least id (null last), then text hash.

    Rows without words all stay, but rows equal in id and text count once.
    """
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    # A row without words is its own class.
    alone = F.concat_ws(":", F.lit("alone"), F.col("doc_id").cast("string"), F.col("text_hash").cast("string"))
    key = F.coalesce("class_key", alone.cast("binary"))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    keep = found.groupBy(key.alias("_key")).agg(F.min(order).alias("least"), F.count("*").alias("_rows"))
    keep = keep.select("_key", "_rows", F.col("least.doc_id").alias("_id"), F.col("least.text_hash").alias("_hash"))
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    row = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("_row"),
        docs[id_col].cast("long").alias("_own"),
        F.xxhash64(text).alias("_own_hash"),
    )
    kept = row.join(keep, row._own.eqNullSafe(keep._id) & (row._own_hash == keep._hash))
    # Only in a class of several rows can the row that stays repeat.
    single = kept.where("_rows = 1").select("_row")
    once = kept.where("_rows > 1").groupBy("_key").agg(F.first("_row").alias("_row")).select("_row")
    return single.unionByName(once).select("_row.*")
