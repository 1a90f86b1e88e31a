"""Two-pass external shuffle into shards.

Pass one scatters the rows by a seeded hash of the document over buckets that fit in memory; pass
two shuffles each bucket (Fisher-Yates) and writes it. The place in the shuffled whole is a
bucket's start plus the place in it, and shards are even cuts of that order.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import document_keys, drop_staged, prefix_sums, staged

# Copies of one row that an exploding task makes at a time.
COPIES = 4096
SHUFFLED = "doc_id long, text string, place long, shard int, slot long"


def fisher_yates(n: int, seed: list[int]) -> np.ndarray:
    """A uniform order of n rows: each place, from the last, swaps with one at or before it."""
    order = np.arange(n)
    picks = (np.random.default_rng(seed).random(n) * np.arange(1, n + 1)).astype(np.int64)
    for i in range(n - 1, 0, -1):
        j = picks[i]
        order[i], order[j] = order[j], order[i]
    return order


def _shuffled(rows: int, shards: int, seed: int) -> Callable[[pa.Table], pa.Table]:
    # Shard s holds the places from rows * s // shards on, so counts differ by one at most.
    bounds = np.array([rows * s // shards for s in range(shards + 1)], np.int64)

    def shuffle(bucket: pa.Table) -> pa.Table:
        # The order in which rows arrive differs from run to run; sort them before they are dealt.
        bucket = bucket.sort_by([("doc_id", "ascending"), ("text_hash", "ascending")])
        own = [seed, int(bucket.column("bucket")[0].as_py())]
        bucket = bucket.take(pa.array(fisher_yates(bucket.num_rows, own)))
        place = bucket.column("before").to_numpy() + np.arange(bucket.num_rows)
        shard = np.searchsorted(bounds, place, side="right") - 1
        return pa.table(
            {
                "doc_id": bucket.column("doc_id"),
                "text": bucket.column("text"),
                "place": pa.array(place, pa.int64()),
                "shard": pa.array(shard, pa.int32()),
                "slot": pa.array(place - bounds[shard], pa.int64()),
            }
        )

    return shuffle


def _scattered(keyed: DataFrame, buckets: int, bucket_rows: int, bucket_bytes: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Add `bucket` to each row, and the stored keys of hot rows: equal rows that would fill a good part of a bucket.

    Hot rows are counted before they move, and numbered as copies, so that they spread over all
    buckets. Copies are made again by many tasks, in runs of COPIES.
    """
    of = lambda *more: F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text_hash", *more), F.lit(buckets))
    length = F.octet_length("text").cast("long")
    same = keyed.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n"), F.sum(length).alias("bytes"))
    full = (F.col("n") > bucket_rows // 4) | (F.col("bytes") > bucket_bytes // 4)
    hot = staged(same.where((F.col("n") > 1) & full).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "n"))
    many = hot.agg(F.sum("n")).first()[0]
    if not many:
        return keyed.withColumn("bucket", of()), hot
    own = keyed.doc_id.eqNullSafe(hot["_id"]) & (keyed.text_hash == hot["_hash"])
    cold = keyed.join(hot, own, "left_anti").withColumn("bucket", of())
    counted = keyed.join(hot, own, "left_semi").groupBy("doc_id", "text_hash", "text").agg(F.count("*").alias("n"))
    runs = counted.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(COPIES).cast("long"))))
    runs = runs.repartition(max(1, -(-many // (4 * COPIES))), "doc_id", "text_hash", "run")
    last = F.least(F.col("run") + COPIES, "n") - 1
    copies = runs.withColumn("copy", F.explode(F.sequence("run", last))).withColumn("bucket", of("copy"))
    return cold.unionByName(copies.select(cold.columns)), hot


def write_shards(
    docs: DataFrame,
    path: str,
    *,
    shards: int = 16,
    bucket_rows: int = 4096,
    bucket_bytes: int = 1 << 26,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Write (doc_id, text, place, slot) under path/shard=S in a uniform order.

    The law is `rows`: the shards' counts are at most one apart, whatever ids and texts repeat.
    Buckets hold about bucket_rows rows, or fewer where these exceed bucket_bytes bytes: the hash
    is of the id, and of the text so that null ids spread too, and of a copy's number where many
    rows are equal. Null texts are written as empty ones. Other columns are left out; an empty table writes no row.
    """
    keyed = document_keys(docs, id_col, text_col)
    total = keyed.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("bytes")).first()
    rows = total["rows"]
    buckets = max(1, -(-rows // bucket_rows), -(-total["bytes"] // bucket_bytes))
    keyed, hot = _scattered(keyed, buckets, bucket_rows, bucket_bytes, seed)
    sizes = keyed.groupBy("bucket").agg(F.count("*").alias("n"))
    # Runs of buckets serve as parts, so that no window holds all buckets.
    sizes = sizes.withColumn("part", F.floor(F.col("bucket") / 1024).cast("int"))
    before = prefix_sums(sizes, "part", "bucket", "n", "before").select("bucket", "before")
    placed = keyed.join(before, "bucket").groupBy("bucket").applyInArrow(_shuffled(rows, shards, seed), SHUFFLED)
    placed.write.partitionBy("shard").parquet(path)
    drop_staged(hot)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHUFFLED).parquet(path)
