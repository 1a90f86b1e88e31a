"""Nearest vectors by inner product: multiprobe p-stable hashing, then exact distances.

Vectors are scaled to the longest one's length and given one more component, so that all lie on
one sphere, where the largest inner product is the least distance; queries are scaled to the same
sphere. A table's bucket is the slots of a vector's projections on random normal directions (the
2-stable law), each cut into slots of equal width at a random offset. A query visits buckets in
the order of their estimated success: for each direction a neighbour's projection is taken as
normal around a share of the query's own, with share and spread estimated from true neighbours,
and the product of the slots' probabilities is walked from the largest down with a heap.

How many buckets are visited is calibrated. For a bounded sample of queries the true neighbours
are found by a scan of all rows; the least number of probes that reaches the target recall on the
sample is used for all queries. Vectors without structure need many probes (see the README).

Defined cases: vectors that are null, empty, all zero, or hold a null, NaN or infinite component
take no part, nor do those of another length than the most frequent one. Rows with equal id and
vector count once. An id with several vectors is a query for each of them and never its own
candidate. Null ids are candidates, and stand last among equal scores. Of copies of one vector
only the smallest k + 1 ids can be among the k nearest; only these are kept beyond the first step.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, erf, log2, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_staged, ragged, staged

# Width of a slot in standard deviations of the projection, and slots on each side of the middle one.
WIDTH, SIDE = 1.5, 3
SLOTS = 2 * SIDE + 1
# Bits that a slot of that width tells about a normal projection, rounded down.
BITS = 1.4
ASKED = ["query_id", "query_hash", "vector", "bound"]
RESULT = "query_id long, query_hash long, vec_id long, score double"


@dataclass(frozen=True)
class Index:
    """What places a vector: the sphere's radius, and for each table directions, centres, widths and offsets.

    `share` and `spread` describe a neighbour's projection, in standard deviations.
    """

    dim: int
    radius: float
    middle: np.ndarray
    directions: np.ndarray  # table, function, component
    deviations: np.ndarray  # table, function
    offsets: np.ndarray  # table, function
    share: float = 1.0
    spread: float = 1.0

    @property
    def tables(self) -> int:
        return self.directions.shape[0]

    @property
    def functions(self) -> int:
        return self.directions.shape[1]

    def places(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        """The projections (table, vector, function) in slot widths from the middle of slot 0's left edge."""
        scaled = vectors / (np.linalg.norm(vectors, axis=1, keepdims=True) if query else self.radius)
        left = np.sqrt(np.maximum(0.0, 1 - np.einsum("ij,ij->i", scaled, scaled)))
        centred = np.column_stack([scaled, np.zeros(len(left)) if query else left]) - self.middle
        found = np.einsum("nd,tfd->tnf", centred, self.directions)
        return found / self.deviations[:, None, :]

    def slots(self, places: np.ndarray) -> np.ndarray:
        slots = np.floor(places / WIDTH + self.offsets[:, None, :])
        return np.clip(slots, -SIDE, SIDE).astype(np.int64) + SIDE

    def buckets(self, vectors: np.ndarray) -> np.ndarray:
        """The bucket of each vector in each table (table, vector)."""
        powers = SLOTS ** np.arange(self.functions, dtype=np.int64)
        return self.slots(self.places(vectors)) @ powers

    def probes(self, vectors: np.ndarray, count: int) -> np.ndarray:
        """The first `count` buckets of each query in each table (table, vector, probe)."""
        places = self.places(vectors, query=True)
        edges = (np.arange(SLOTS + 1) - SIDE).astype(float)[None, None, None, :] - self.offsets[:, None, :, None]
        deep = (edges * WIDTH - self.share * places[..., None]) / self.spread
        under = np.frompyfunc(lambda x: 0.5 * (1 + erf(x / sqrt(2))), 1, 1)(np.clip(deep, -30, 30)).astype(float)
        under[..., 0], under[..., -1] = 0.0, 1.0  # the last slots hold all that lies beyond
        costs = -np.log(np.maximum(np.diff(under, axis=-1), 1e-300))
        count = min(count, SLOTS**self.functions)
        found = np.full((*places.shape[:2], count), -1, np.int64)
        for t in range(places.shape[0]):
            for q in range(places.shape[1]):
                found[t, q] = _cheapest(costs[t, q], count)
        return found


def _cheapest(costs: np.ndarray, count: int) -> list[int]:
    """The `count` buckets of least total cost, in that order; costs: one row of slots for each function.

    Each function's slots are sorted by cost. A choice is a place in each sorted row; from a choice
    whose last raised function is i follow those that raise a function from i on by one, so
    each choice is made once.
    """
    order = np.argsort(costs, axis=1, kind="stable")
    cost = np.take_along_axis(costs, order, 1).tolist()
    keys = (order * (SLOTS ** np.arange(len(costs), dtype=np.int64))[:, None]).tolist()
    rows = range(len(costs))
    heap = [(sum(cost[i][0] for i in rows), sum(keys[i][0] for i in rows), 0, (0,) * len(costs))]
    found = []
    while heap and len(found) < count:
        total, key, last, choice = heapq.heappop(heap)
        found.append(key)
        for i in range(last, len(costs)):
            at = choice[i] + 1
            if at < SLOTS:
                raised = choice[:i] + (at,) + choice[i + 1 :]
                heapq.heappush(
                    heap, (total + cost[i][at] - cost[i][at - 1], key + keys[i][at] - keys[i][at - 1], i, raised)
                )
    return found


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dim).astype(float)


def _scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products over the last axis, each summed in the same order wherever it stands."""
    return np.ascontiguousarray(left * right).sum(axis=-1)


def _packed(kind: str):
    """Rows with a usable vector: vec_id, dim, vector as bytes, norm."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            ids = batch.column("vec_id")
            usable, dims, vectors, norms = [], [], [], []
            for i in range(len(lists)):
                item = lists[i]
                values = item.values if item.is_valid else None
                if values is None or len(values) == 0 or values.null_count:
                    continue
                row = values.to_numpy(zero_copy_only=False).astype(kind)
                norm = float(np.linalg.norm(row.astype(float)))
                if not np.isfinite(row).all() or not row.any():
                    continue
                usable.append(i)
                dims.append(len(row))
                vectors.append((row + row.dtype.type(0)).tobytes())  # -0.0 becomes 0.0
                norms.append(norm)
            taken = ids.take(pa.array(usable, pa.int64()))
            columns = [taken, pa.array(dims, pa.int32()), pa.array(vectors, pa.binary()), pa.array(norms, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "dim", "vector", "norm"])

    return pack


def _true_neighbours(points: DataFrame, sample: list, dim: int, kind: str, k: int) -> list:
    """(sample number, vector) of each sample query's k nearest other vectors, by a scan of all points."""
    queries = np.stack([np.frombuffer(row["vector"], kind) for row in sample]).astype(float)
    own = [row["vector"] for row in sample]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[float, bytes]]] = [[] for _ in own]
        for batch in batches:
            vectors = batch.column("vector").to_pylist()
            if not vectors:
                continue
            scores = queries @ _matrix(batch.column("vector"), dim, kind).T
            keep = min(k + 1, len(vectors))
            near = np.argpartition(-scores, keep - 1, axis=1)[:, :keep]
            for q, places in enumerate(near):
                new = [(float(scores[q, i]), vectors[i]) for i in places if vectors[i] != own[q]]
                best[q] = heapq.nlargest(k, best[q] + new)
        flat = [(q, score, vector) for q, rows in enumerate(best) for score, vector in rows]
        numbers, scores, vectors = zip(*flat, strict=True) if flat else ((), (), ())
        columns = [pa.array(numbers, pa.int32()), pa.array(scores, pa.float64()), pa.array(vectors, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["number", "score", "vector"])

    found = points.select("vector").mapInArrow(scan, "number int, score double, vector binary")
    place = F.row_number().over(Window.partitionBy("number").orderBy(F.desc("score"), "vector"))
    return found.withColumn("place", place).where(F.col("place") <= k).select("number", "vector").collect()


def _fit(points: DataFrame, dim: int, kind: str, radius: float, rows: int, tables: int, bucket_rows: int, sample_rows: int) -> Index:
    """Centre and spread of the projections, from the sample_rows points of least hash."""
    sample = points.orderBy(F.xxhash64(F.lit(11), "vector"), "vector").limit(sample_rows).select("vector").collect()
    vectors = np.stack([np.frombuffer(row["vector"], kind) for row in sample]).astype(float)
    functions = min(max(2, ceil(log2(max(2.0, rows / bucket_rows)) / BITS)), int(62 / log2(SLOTS)))
    rng = np.random.default_rng(5)
    directions = rng.standard_normal((tables, functions, dim + 1))
    offsets = rng.uniform(size=(tables, functions))
    plain = Index(dim, radius, np.zeros(dim + 1), directions, np.ones((tables, functions)), offsets)
    scaled = vectors / radius
    left = np.sqrt(np.maximum(0.0, 1 - np.einsum("ij,ij->i", scaled, scaled)))
    middle = np.column_stack([scaled, left]).mean(axis=0)
    spread = (plain.places(vectors) - np.einsum("d,tfd->tf", middle, directions)[:, None, :]).std(axis=1)
    return Index(dim, radius, middle, directions, np.where(spread > 1e-9, spread, 1.0), offsets)


def _calibrated(index: Index, sample: list, neighbours: list, kind: str, recall: float) -> tuple[Index, int]:
    """The index with its model of neighbours, and the number of probes that reaches the recall on the sample."""
    if not neighbours:
        return index, SLOTS**index.functions
    queries = np.stack([np.frombuffer(row["vector"], kind) for row in sample]).astype(float)
    numbers = np.array([row["number"] for row in neighbours])
    vectors = np.stack([np.frombuffer(row["vector"], kind) for row in neighbours]).astype(float)
    own = index.places(queries, query=True)[:, numbers].ravel()
    theirs = index.places(vectors).ravel()
    share = float(own @ theirs / max(own @ own, 1e-12))
    spread = float(np.sqrt(np.mean((theirs - share * own) ** 2)))
    index = Index(**{**index.__dict__, "share": share, "spread": max(spread, 0.02)})
    buckets, count, most = index.buckets(vectors), 8, SLOTS**index.functions
    while True:
        probes = index.probes(queries, count)[:, numbers]
        hit = probes == buckets[:, :, None]
        place = np.where(hit.any(axis=2), hit.argmax(axis=2), most).min(axis=0)
        place.sort()
        need = place[min(len(place) - 1, ceil(recall * len(place)) - 1)] + 1
        if need <= count or count >= most:
            return index, int(min(need, most))
        count = min(2 * count, most)


def _compare(dim: int, kind: str, k: int, step: int = 256):
    """Compares the members of a cell with the queries of a cell; gives each query's k best ids of it, none under its bound."""

    def compare(key, members: pa.Table, queries: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("query_hash", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        if not len(members) or not len(queries):
            return schema.empty_table()
        rows, asked = _matrix(members["vector"], dim, kind), _matrix(queries["vector"], dim, kind)
        ids = members["ids"].combine_chunks()
        starts, flat = np.asarray(ids.offsets).astype(np.int64), ids.values
        lengths = np.diff(starts)
        known = np.asarray(flat.is_valid()) if flat.null_count else np.ones(len(flat), bool)
        values = np.asarray(flat.fill_null(0)).astype(np.int64)
        names, hashes, bounds = (np.asarray(queries[name]) for name in ("query_id", "query_hash", "bound"))
        out = []
        for at in range(0, len(asked), step):
            some = asked[at : at + step]
            # The query's own vector, and a few more, as sums in another order may tell near ties apart otherwise.
            spare = min(k + 5, len(rows))
            near = np.argpartition(-(some @ rows.T), spare - 1, axis=1)[:, :spare]
            scores = _scores(some[:, None, :], rows[near])
            query = np.repeat(np.arange(at, at + len(some)), spare)
            near, scores = near.ravel(), scores.ravel()
            places = ragged(starts[near], lengths[near])
            query, scores = np.repeat(query, lengths[near]), np.repeat(scores, lengths[near])
            other = (~known[places] | (values[places] != names[query])) & (scores >= bounds[query])
            query, scores, places = query[other], scores[other], places[other]
            order = np.lexsort((values[places], ~known[places], -scores, query))
            query, scores, places = query[order], scores[order], places[order]
            first = np.searchsorted(query, query)
            top = np.arange(len(query)) - first < k
            query, scores, places = query[top], scores[top], places[top]
            found = pa.array(values[places], mask=~known[places])
            out.append(pa.table([pa.array(names[query]), pa.array(hashes[query]), found, pa.array(scores)], schema=schema))
        return pa.concat_tables(out)

    return compare


def _probed(index: Index, kind: str, start: int, stop: int):
    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 64):
                part = batch.slice(at, 64)
                probes = index.probes(_matrix(part.column("vector"), index.dim, kind), stop)[:, :, start:]
                for t in range(index.tables):
                    places = np.repeat(np.arange(len(part)), probes.shape[2])
                    columns = [part.column(name).take(pa.array(places)) for name in ASKED]
                    columns = [pa.array(np.full(len(places), t, np.int32)), pa.array(probes[t].ravel()), *columns]
                    yield pa.RecordBatch.from_arrays(columns, ["part", "bucket", *ASKED])

    return visit


def _placed(index: Index, kind: str):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            buckets = index.buckets(_matrix(batch.column("vector"), index.dim, kind))
            for t in range(index.tables):
                columns = [pa.array(np.full(len(batch), t, np.int32)), pa.array(buckets[t]), batch.column("vector"), batch.column("ids")]
                yield pa.RecordBatch.from_arrays(columns, ["part", "bucket", "vector", "ids"])

    return place


def _visited(members: DataFrame, probes: DataFrame, dim: int, kind: str, k: int, cell_rows: int) -> DataFrame:
    """Each query's k best ids of each bucket it visits: query_id, query_hash, vec_id, score.

    A bucket's members are dealt into blocks and its queries into chunks of about cell_rows rows; each
    block meets each chunk in a group of its own, so no task holds more than one of both.
    """
    bucket = ["part", "bucket"]
    cells = lambda df, name: df.groupBy(*bucket).agg(F.ceil(F.count("*") / cell_rows).cast("int").alias(name))
    layout = staged(cells(members, "blocks").join(cells(probes, "chunks"), bucket))
    upto = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    block = F.pmod(F.xxhash64(F.lit(3), "vector"), F.col("blocks")).cast("int")
    chunk = F.pmod(F.xxhash64(F.lit(3), "query_id", "query_hash"), F.col("chunks")).cast("int")
    left = members.join(layout, bucket).select(*bucket, block.alias("block"), upto("chunks").alias("chunk"), "vector", "ids")
    right = probes.join(layout, bucket).select(*bucket, chunk.alias("chunk"), upto("blocks").alias("block"), *ASKED)
    cell = [*bucket, "block", "chunk"]
    return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(_compare(dim, kind, k), RESULT)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of what several buckets and tables found, each id once."""
    best = Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    once = found.dropDuplicates(["query_id", "query_hash", "vec_id", "score"])
    return staged(once.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k))


def nearest(
    vectors: DataFrame,
    is_query: Column,
    *,
    k: int = 20,
    recall: float = 0.95,
    tables: int = 2,
    bucket_rows: int = 4096,
    cell_rows: int = 4096,
    sample_queries: int = 128,
    sample_rows: int = 2048,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The k nearest rows found for each row that meets `is_query` (a condition on vec_id).

    Columns: query_id, rank from 1, vec_id, score (the inner product in double precision). Every row is
    indexed; `recall` is aimed at on sample_queries queries, and sample_rows rows fit the projections.
    The functions of a table grow with the logarithm of the rows, so a bucket keeps about bucket_rows.
    A query with fewer than k results visits more buckets, in the end all of them, while there are
    other rows. See the module for what null, zero and repeated vectors do.
    """
    spark = vectors.sparkSession
    floats = vectors.schema[vector_col].dataType.simpleString() == "array<float>"
    kind, stored = ("<f4", "array<float>") if floats else ("<f8", "array<double>")
    given = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast(stored).alias("vector"))
    packed = staged(given.mapInArrow(_packed(kind), "vec_id long, dim int, vector binary, norm double"))
    sizes = packed.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if sizes is None:
        return empty
    dim = sizes["dim"]
    rows = staged(packed.where(F.col("dim") == dim).select("vec_id", "vector", "norm").dropDuplicates(["vec_id", "vector"]))
    place = F.row_number().over(Window.partitionBy("vector").orderBy(F.asc_nulls_last("vec_id")))
    points = rows.withColumn("place", place).where(F.col("place") <= k + 1).groupBy("vector")
    points = staged(points.agg(F.collect_list("vec_id").alias("all_ids"), F.count("*").alias("size"), F.max("norm").alias("norm")))
    # collect_list leaves nulls out; a null id is put back where the group had one.
    points = points.withColumn("ids", F.when(F.size("all_ids") < F.col("size"), F.concat("all_ids", F.array(F.lit(None).cast("long")))).otherwise(F.col("all_ids")))
    queries = rows.where(is_query).select(F.col("vec_id").alias("query_id"), F.xxhash64("vector").alias("query_hash"), "vector")
    total, radius = points.agg(F.count("*"), F.max("norm")).first()
    index = _fit(points, dim, kind, radius, total, tables, bucket_rows, sample_rows)
    sample = queries.orderBy(F.xxhash64(F.lit(17), "query_id", "query_hash"), "query_id").limit(sample_queries).collect()
    if not sample:
        return empty
    known = _true_neighbours(points, sample, dim, kind, k)
    index, count = _calibrated(index, sample, known, kind, recall)
    most = SLOTS**index.functions
    if total <= 20 * k:
        count = most  # so few rows are all compared
    members = staged(points.select("vector", "ids").mapInArrow(_placed(index, kind), "part int, bucket long, vector binary, ids array<long>"))
    others = rows.agg(F.count_distinct("vec_id") + F.max(F.col("vec_id").isNull().cast("int"))).first()[0] - 1
    unbound = F.lit(float("-inf"))
    asked, best, start, stop = queries.withColumn("bound", unbound), None, 0, min(max(1, count // 5), most)
    visits = "part int, bucket long, query_id long, query_hash long, vector binary, bound double"
    while True:
        # The first visits give each query a bound, so that later ones send only what can be among its best.
        probes = staged(asked.mapInArrow(_probed(index, kind, start, stop), visits))
        found = _visited(members, probes, dim, kind, k, cell_rows)
        best = _best(found if best is None else best.drop("rank").unionByName(found), k)
        drop_staged(probes)
        if stop >= most:
            break
        name = ["query_id", "query_hash"]
        full = best.where(F.col("rank") == min(k, others)).select(*name, F.col("score").alias("least"))
        if stop < count:
            asked = queries.join(full, name, "left").withColumn("bound", F.coalesce("least", unbound)).select(*ASKED)
            start, stop = stop, count
        else:
            asked = staged(queries.join(full, name, "left_anti").withColumn("bound", unbound).select(*ASKED))
            if asked.isEmpty():
                break
            start, stop = stop, min(8 * stop, most)
    for df in (packed, rows, members):
        drop_staged(df)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
