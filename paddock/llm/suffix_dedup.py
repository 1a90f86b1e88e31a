"""Removal of long repeated byte strings by a hash-compared suffix sort.

Every string of `length` bytes holds an anchor: the start of the gram of `gram` bytes whose hash is
least in it. Equal strings have equal anchors at equal places, so only suffixes that start at
anchors whose gram repeats are compared. In each group of one gram, the suffixes are mergesorted;
two are compared by binary search over prefix hashes for their longest common extension, and
the order is verified on the bytes. The texts to the left are sorted the same way, reversed.
Neighbours in both orders give the longest repeated string around each anchor.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BASE, document_keys, drop_staged, gram_hashes, mix, staged

ANCHORS = "doc_id long, text_hash long, place int, gram long"
SPANS = "array<struct<start: bigint, stop: bigint>>"
SUFFIXES = 4096  # suffixes that are sorted at once; larger groups are split first


def _window_min(values: np.ndarray, span: int) -> np.ndarray:
    """The least of each `span` values in a row, by doubling."""
    out, size = values, 1
    while size < span:
        step = min(size, span - size)
        out = np.minimum(out[:-step], out[step:])
        size += step
    return out


def anchors_of(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The places and gram hashes of all anchors; where hashes tie, each place is one."""
    if len(data) < length:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    hashes, span = mix(gram_hashes(data, gram)), length - gram + 1
    least = _window_min(hashes, span)
    # A place is an anchor if the greatest of the minima of its windows is its own hash.
    padded = np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)])
    most = ~_window_min(~padded, span)
    places = np.flatnonzero(most == hashes)
    return places, hashes[places]


def prefix_hashes(rows: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes of each row of bytes, the empty one first."""
    out = np.zeros((rows.shape[0], rows.shape[1] + 1), np.uint64)
    for i in range(rows.shape[1]):
        out[:, i + 1] = out[:, i] * BASE + rows[:, i].astype(np.uint64) + np.uint64(1)
    return out


class Suffixes:
    """Byte strings, one a row, that are compared by group first and then by their bytes."""

    def __init__(self, texts: list[bytes], group: np.ndarray):
        self.sizes = np.array([len(t) for t in texts], np.int64)
        width = int(self.sizes.max(initial=0))
        self.bytes = np.zeros((len(texts), width + 1), np.uint8)
        for i, text in enumerate(texts):
            self.bytes[i, : len(text)] = np.frombuffer(text, np.uint8)
        self.hashes, self.group = prefix_hashes(self.bytes[:, :width]), group
        self.order = self._sorted()
        self.common = self._verified()

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common extensions, by binary search for the longest equal prefix hash."""
        low, high = np.zeros(len(a), np.int64), np.minimum(self.sizes[a], self.sizes[b])
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self.hashes[a, middle] == self.hashes[b, middle]
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether a comes before b; equal ones keep the order of their rows."""
        ext = self.extension(a, b)
        ends_a, ends_b = ext == self.sizes[a], ext == self.sizes[b]
        by_byte = self.bytes[a, ext] < self.bytes[b, ext]
        equal = ends_a & ends_b
        inner = np.where(equal, a < b, np.where(ends_a, True, np.where(ends_b, False, by_byte)))
        return np.where(self.group[a] == self.group[b], inner, self.group[a] < self.group[b])

    def _sorted(self) -> np.ndarray:
        """Bottom-up mergesort: each element finds its rank in the neighbouring run."""
        n, width = len(self.sizes), 1
        order = np.arange(n)
        while width < n:
            at = np.arange(n)
            run = at // width
            other = run ^ 1
            start, stop = np.minimum(other * width, n), np.minimum((other + 1) * width, n)
            low, high = start.copy(), stop.copy()
            while (low < high).any():
                open_ = low < high
                middle = np.where(open_, (low + high) // 2, 0)
                first = self.before(order[middle], order) & open_
                low = np.where(first, middle + 1, low)
                high = np.where(open_ & ~first, middle, high)
            target = np.minimum(run, other) * width + (at - run * width) + (low - start)
            merged = np.empty(n, np.int64)
            merged[target] = order
            order, width = merged, 2 * width
        return order

    def _verified(self) -> np.ndarray:
        """Common extensions of neighbours, from the bytes; sorts by bytes if a hash collided."""
        for _ in range(2):
            a, b = self.order[:-1], self.order[1:]
            differs = self.bytes[a] != self.bytes[b]
            upto = np.where(differs.any(axis=1), differs.argmax(axis=1), self.bytes.shape[1])
            common = np.minimum(upto, np.minimum(self.sizes[a], self.sizes[b]))
            ends = common == self.sizes[a]
            fine = ends | ((common < self.sizes[b]) & (self.bytes[a, common] < self.bytes[b, common]))
            if (fine | (self.group[a] != self.group[b])).all():
                return np.where(self.group[a] == self.group[b], common, -1)
            rows = [(int(g), self.bytes[i, : self.sizes[i]].tobytes(), i) for i, g in enumerate(self.group)]
            self.order = np.array([i for _, _, i in sorted(rows)], np.int64)
        raise AssertionError("sorting by bytes gave no order")


class _RangeMin:
    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 << (len(self.levels) - 1) <= len(values):
            last, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-step], last[step:]))
        self.levels = [level.tolist() for level in self.levels]

    def least(self, a: int, b: int) -> int:
        k = (b - a).bit_length() - 1
        return min(self.levels[k][a], self.levels[k][b - (1 << k)])


def repeated_around(contexts: list[bytes], lefts: list[int], group: np.ndarray, length: int) -> list[list[tuple[int, int]]]:
    """For each context, the strings around its anchor that another one of its group repeats.

    (bytes left of the anchor, bytes from it on), where both add up to `length` at least. Pieces of
    the suffix order are joined from the longest common extension down. Where two meet, each
    suffix of the smaller looks up its neighbours in the larger by the order of the left sides;
    further ones have nothing to add, as a neighbour has at least as much in common with them.
    """
    right = Suffixes([c[k:] for c, k in zip(contexts, lefts, strict=True)], group)
    left = Suffixes([c[:k][::-1] for c, k in zip(contexts, lefts, strict=True)], group)
    n = len(contexts)
    rank = np.empty(n, np.int64)
    rank[left.order] = np.arange(n)
    by_rank, lesser = left.order.tolist(), _RangeMin(left.common)
    ranks = rank[right.order].tolist()
    pieces: list[list[int]] = [[r] for r in ranks]
    piece_of = list(range(n))
    found: list[list[tuple[int, int]]] = [[] for _ in range(n)]

    def root(i: int) -> int:
        while piece_of[i] != i:
            piece_of[i] = piece_of[piece_of[i]]
            i = piece_of[i]
        return i

    def note(x: int, y: int, depth: int) -> None:
        shared = lesser.least(min(x, y), max(x, y))
        if shared + depth >= length:
            found[by_rank[x]].append((shared, depth))
            found[by_rank[y]].append((shared, depth))

    common = right.common.tolist()
    for i in np.argsort(-right.common, kind="stable").tolist():
        depth = common[i]
        if depth < 0:
            break
        a, b = root(i), root(i + 1)
        small, large = (a, b) if len(pieces[a]) < len(pieces[b]) else (b, a)
        into = pieces[large]
        for x in pieces[small]:
            at = bisect.bisect_left(into, x)
            if at:
                note(into[at - 1], x, depth)
            if at < len(into):
                note(x, into[at], depth)
        into += pieces[small]
        into.sort()
        pieces[small] = []
        piece_of[small] = large
    return found


def _anchor_rows(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, places, grams = [], [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
            for i, text in enumerate(batch.column("text").to_pylist()):
                at, hashes = anchors_of(np.frombuffer(text.encode(), np.uint8), length, gram)
                rows.append(len(at))
                places.append(at)
                grams.append(hashes)
            take = pa.array(np.repeat(np.arange(len(rows)), rows))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(take),
                    batch.column("text_hash").take(take),
                    pa.array(np.concatenate(places), pa.int32()),
                    pa.array(np.concatenate(grams).view(np.int64)),
                ],
                ["doc_id", "text_hash", "place", "gram"],
            )

    return run


def _context_rows(reach_left: int, reach_right: int):
    """The bytes around each place of a document that has places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(i, 256) for i in range(0, whole.num_rows, 256)):
                rows, places, grams, lefts, contexts = [], [], [], [], []
                for i, (text, at) in enumerate(zip(batch.column("text").to_pylist(), batch.column("at").to_pylist(), strict=True)):
                    data = text.encode()
                    for p in at:
                        place = p["place"]
                        rows.append(i)
                        places.append(place)
                        grams.append(p["gram"])
                        lefts.append(min(place, reach_left))
                        contexts.append(data[max(0, place - reach_left) : place + reach_right])
                take = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(take),
                        batch.column("text_hash").take(take),
                        pa.array(places, pa.int32()),
                        pa.array(grams, pa.int64()),
                        pa.array(lefts, pa.int32()),
                        pa.array(contexts, pa.binary()),
                    ],
                    ["doc_id", "text_hash", "place", "gram", "left", "context"],
                )

    return run


CONTEXTS = ANCHORS + ", left int, context binary"


def _compare(length: int):
    """Intervals (from, to) around the anchor for the rows that ask for them, group by group."""
    out_names = ["gram", "left", "c1", "c2", "from", "to"]

    def answer(held: list[dict]) -> pa.RecordBatch:
        groups: dict[tuple, int] = {}
        group = np.array([groups.setdefault((r["gram"], r["low"], r["high"], r["core"]), len(groups)) for r in held])
        found = repeated_around([r["context"] for r in held], [r["left"] for r in held], group, length)
        rows = [
            (r["gram"], r["left"], r["c1"], r["c2"], -a, b)
            for r, pairs in zip(held, found, strict=True)
            if r["asks"]
            for a, b in set(pairs)
        ]
        columns = list(zip(*rows, strict=True)) if rows else [()] * 6
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], out_names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, group, key = [], [], None
        for batch in batches:
            for r in batch.to_pylist():
                own = (r["gram"], r["low"], r["high"], r["core"])
                if own != key:
                    # Groups are kept whole; several small ones are sorted together.
                    if held and len(held) + len(group) > SUFFIXES:
                        yield answer(held)
                        held = []
                    held, group, key = held + group, [], own
                group.append(r)
        if held and len(held) + len(group) > SUFFIXES:
            yield answer(held)
            held = []
        if held or group:
            yield answer(held + group)

    return run


def _split_large(rows: DataFrame, length: int, gram: int, largest: int) -> tuple[DataFrame, list[DataFrame], list[DataFrame]]:
    """Split groups of more than `largest` rows by the bytes their strings have in common.

    Gives the rows of bounded groups, the answers found on the way, and the stored tables that both are read from.

    A row stands for the strings that start `low` to `high` bytes left of its anchor; `core` is a
    hash of the bytes all of these share. Halving the range lengthens the core, so that rows
    without a common string fall apart; rows whose range is one string are equal in it and
    need no more comparison. Rows that agree on all their range's bytes, compared as bytes, are answered, and
    one of them stands for the others from then on. Only the rows of large groups are stored again.
    """
    answers: list[DataFrame] = []
    stored: list[DataFrame] = []
    done: DataFrame | None = None
    group = ["gram", "low", "high", "core"]
    right = F.octet_length("context") - F.col("left")
    while True:
        sizes = staged(rows.groupBy(*group).agg(F.count("*").alias("_n")).where(F.col("_n") > largest))
        stored.append(sizes)
        if sizes.isEmpty():
            return (rows if done is None else done.unionByName(rows)), answers, stored
        small = rows.join(sizes.drop("_n"), group, "left_anti").select(*rows.columns)
        done = small if done is None else done.unionByName(small)
        large = rows.join(sizes.drop("_n"), group)
        span_from, span_to = F.least("left", "high"), F.least(right, length - F.col("low"))
        span = _cut(F.lit(0) - span_from, span_to)
        whole = (span_from == F.col("high")) & (span_to == length - F.col("low"))
        large = staged(large.withColumns({"_span": F.when(whole, span), "_id": F.xxhash64("left", "c1", "c2")}))
        same = large.where("_span IS NOT NULL").groupBy(*group, "_span").agg(F.count("*").alias("_same"), F.min("_id").alias("_keep"))
        same = staged(same)
        marked = staged(large.join(same, [*group, "_span"], "left"))
        drop_staged(large)
        drop_staged(same)
        alike = marked.where("_same > 1")
        answers.append(alike.where("asks").select("gram", "left", "c1", "c2", (-F.col("high")).alias("from"), (length - F.col("low")).alias("to")))
        kept = marked.where("_same IS NULL OR _same = 1 OR _id = _keep").where("low < high")
        kept = kept.withColumn("asks", F.col("asks") & (F.coalesce("_same", F.lit(1)) == 1)).drop("_span", "_id", "_same", "_keep")
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        halves = F.array(
            F.struct(F.col("low").alias("low"), middle.alias("high")), F.struct((middle + 1).alias("low"), F.col("high").alias("high"))
        )
        parts = kept.withColumn("_half", F.explode(halves)).withColumns({"low": F.col("_half.low"), "high": F.col("_half.high")})
        parts = parts.where((F.col("left") >= F.col("low")) & (right >= length - F.col("high")))
        rows = staged(parts.withColumn("core", F.xxhash64(_cut(-F.col("low"), length - F.col("high")))).drop("_half"))
        stored += [marked, rows]


def _cut(start: Column, stop: Column) -> Column:
    """The context's bytes from `start` to `stop`, counted from the anchor."""
    return F.substring(F.col("context"), (F.col("left") + start + 1).cast("int"), (stop - start).cast("int"))


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, sizes, digests, merged = [], [], [], []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
            data, own = text.encode(), []
            for start, stop in sorted((s["start"], s["stop"]) for s in spans or ()):
                if own and start <= own[-1][1]:
                    own[-1][1] = max(own[-1][1], stop)
                else:
                    own.append([start, stop])
            parts, at = [], 0
            for start, stop in own:
                parts.append(data[at:start])
                at = stop
            rest = b"".join([*parts, data[at:]])
            kept.append(rest if own else None)
            sizes.append(len(data))
            digests.append(hashlib.sha256(rest).hexdigest())
            merged.append([{"start": a, "stop": b} for a, b in own])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(merged, kind), pa.array(kept, pa.binary()), pa.array(digests)],
            ["doc_id", "n_bytes", "spans", "kept", "kept_sha256"],
        )


REMOVED = f"doc_id long, n_bytes long, spans {SPANS}, kept binary, kept_sha256 string"


def _matches(left: DataFrame, right: DataFrame) -> Column:
    return left.doc_id.eqNullSafe(right._id) & (left.text_hash == right._hash)


def remove_repeats(
    docs: DataFrame, *, length: int = 400, gram: int = 100, largest_group: int = SUFFIXES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row for each row of docs: doc_id, n_bytes, spans, kept, kept_sha256.

    spans are the maximal runs of bytes covered by strings of `length` bytes that also start
    anywhere else, in the same document or another; kept is the rest,
    null where nothing goes. Strings are judged on the input, and never cross documents. Null texts are empty; empty and short texts keep
    everything. Rows that repeat with their id are two documents, and lose all that is long
    enough. Other columns are left out; an empty table gives no row.
    """
    keyed = document_keys(docs, id_col, text_col)
    anchors = staged(keyed.mapInArrow(_anchor_rows(length, gram), ANCHORS))
    # Stored, so that the join's two sides are plain exchanges and Spark can split a hot gram.
    often = staged(anchors.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"))
    places = anchors.join(often, "gram").groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("place", "gram")).alias("at"))
    places = places.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    # The texts that may lose something stay at hand; all others are finished here.
    joined = keyed.join(places, _matches(keyed, places), "left")
    sorted_out = staged(
        joined.select(
            "doc_id",
            "text_hash",
            "at",
            F.when(F.col("at").isNotNull(), F.col("text")).alias("text"),
            F.octet_length("text").cast("long").alias("n_bytes"),
            F.when(F.col("at").isNull(), F.sha2("text", 256)).alias("kept_sha256"),
        )
    )
    drop_staged(anchors)
    drop_staged(often)
    reach = length - gram
    maybe = sorted_out.where("text IS NOT NULL").select("doc_id", "text_hash", "text", "at")
    context = maybe.mapInArrow(_context_rows(reach, length), CONTEXTS)
    members = staged(
        context.select(
            "doc_id",
            "text_hash",
            "place",
            "gram",
            "left",
            (F.octet_length("context") - F.col("left")).alias("right"),
            F.xxhash64(F.lit(1), "context").alias("c1"),
            F.xxhash64(F.lit(2), "context").alias("c2"),
        )
    )
    # Equal contexts are one class, counted in the map tasks first; all of it repeats.
    one = ["gram", "left", "c1", "c2"]
    classes = staged(
        members.groupBy(*one).agg(
            F.count("*").alias("n"), F.min("right").alias("right"), F.min(F.struct("doc_id", "text_hash", "place")).alias("rep")
        )
    )
    equal = classes.where("n > 1").select(*one, (-F.col("left")).alias("from"), F.col("right").alias("to"))
    mixed = classes.groupBy("gram").agg(F.count("*").alias("k"), F.max(F.expr("n = 1")).alias("single")).where("k > 1 AND single")
    mixed = staged(mixed.select("gram"))  # stored for the same reason as `often`
    asked = classes.join(mixed, "gram").select(*one, "n", "rep.*")
    # Fetch the contexts of one member of each class that has others beside it.
    asked_at = asked.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("place", "gram")).alias("at"))
    asked_at = asked_at.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    texts = maybe.drop("at").dropDuplicates(["doc_id", "text_hash"])
    fetched = texts.join(asked_at, _matches(texts, asked_at)).select("doc_id", "text_hash", "text", "at")
    bytes_at = fetched.mapInArrow(_context_rows(reach, length), CONTEXTS).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("place").alias("_place"), F.col("gram").alias("_gram"), "context"
    )
    rows = asked.join(
        bytes_at,
        asked.doc_id.eqNullSafe(bytes_at._id)
        & (asked.text_hash == bytes_at._hash)
        & (asked.place == bytes_at._place)
        & (asked.gram == bytes_at._gram),
    ).select(*one, (F.col("n") == 1).alias("asks"), "context")
    rows = rows.withColumns({"low": F.lit(0), "high": F.lit(reach), "core": F.lit(0).cast("long")})
    rows = staged(rows)
    drop_staged(mixed)
    bounded, answers, stored = _split_large(rows, length, gram, largest_group)
    sorted_rows = bounded.repartition("gram", "low", "high", "core").sortWithinPartitions("gram", "low", "high", "core", "left", "c1", "c2")
    compared = sorted_rows.mapInArrow(_compare(length), "gram long, left int, c1 long, c2 long, from int, to int")
    intervals = equal.unionByName(compared)
    for part in answers:
        intervals = intervals.unionByName(part)
    per_class = staged(intervals.groupBy(*one).agg(F.collect_set(F.struct("from", "to")).alias("around")))
    for df in (rows, classes, *stored):
        drop_staged(df)

    around = members.join(per_class, one).select("doc_id", "text_hash", "place", F.explode("around").alias("a"))
    spans = around.groupBy("doc_id", "text_hash").agg(
        F.collect_set(
            F.struct(
                (F.col("place") + F.col("a.from")).cast("long").alias("start"), (F.col("place") + F.col("a.to")).cast("long").alias("stop")
            )
        ).alias("spans")
    )
    spans = spans.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    rest = maybe.join(spans, _matches(maybe, spans), "left").select("doc_id", "text", "spans").mapInArrow(_remove, REMOVED)
    clean = sorted_out.where("text IS NULL").select(
        "doc_id", "n_bytes", F.array().cast(SPANS).alias("spans"), F.lit(None).cast("binary").alias("kept"), "kept_sha256"
    )
    return clean.unionByName(rest)
