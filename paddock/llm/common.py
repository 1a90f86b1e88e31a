"""Helpers the operators of this subpackage share: staging, running totals, ragged arrays, hashes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_folder, staged

__all__ = ["document_keys", "drop_staged", "prefix_sums", "shared_folder", "staged"]

# Parts whose totals are added up in one window; larger runs of parts are added up level by level.
PARTS_PER_RUN = 1024


def document_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id, the text (null counts as empty) and the text's hash; every other column is left out.

    (doc_id, text_hash) names a document: rows with both equal are the same document twice.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    return docs.select(
        docs[id_col].cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")
    )


def drop_staged(df: DataFrame) -> None:
    """Remove a staged table from the shared folder once nothing reads it any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        if "/staged-" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def prefix_sums(df: DataFrame, part: str, seq: str, value: str, out: str) -> DataFrame:
    """Add `out`: the total of `value` in all rows that stand before, in the order of (part, seq).

    part is a small whole number from 0; (part, seq) is unique. Totals are added up within a part,
    within a run of parts and over the runs, so no window holds more than one part, one run of
    PARTS_PER_RUN parts, or one row per run.
    """
    before = lambda window, col: F.coalesce(
        F.sum(col).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    parts = df.groupBy(F.col(part).alias("_part")).agg(F.sum(value).alias("_in_part"))
    parts = parts.withColumn("_run", F.floor(F.col("_part") / PARTS_PER_RUN).cast("int"))
    runs = parts.groupBy("_run").agg(F.sum("_in_part").alias("_in_run"))
    runs = runs.select("_run", before(Window.orderBy("_run"), "_in_run").alias("_before_run"))
    parts = parts.join(runs, "_run").select(
        "_part",
        (
            F.col("_before_run") + before(Window.partitionBy("_run").orderBy("_part"), "_in_part")
        ).alias("_before_part"),
    )
    inner = before(Window.partitionBy(part).orderBy(seq), value)
    joined = df.withColumn("_inner", inner).join(parts, F.col(part) == F.col("_part"))
    return joined.withColumn(out, (F.col("_inner") + F.col("_before_part")).cast("long")).drop(
        "_inner", "_part", "_before_part"
    )


def setting(spark: SparkSession, name: str, default: str) -> str:
    return spark.conf.get(name, default)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of all runs [start, start + length), one run after the other."""
    some = lengths > 0
    starts, lengths = starts[some].astype(np.int64), lengths[some].astype(np.int64)
    if not len(starts):
        return np.empty(0, np.int64)
    ends = np.cumsum(lengths)
    steps = np.ones(int(ends[-1]), np.int64)
    steps[0] = starts[0]
    steps[ends[:-1]] = starts[1:] - (starts[:-1] + lengths[:-1] - 1)
    return np.cumsum(steps)


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A well mixed 64-bit hash of unsigned 64-bit values (multiply and shift rounds)."""
    x = values + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def gram_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """Polynomial hashes (modulo 2^64) of all windows of `length` bytes, built by doubling."""
    if len(data) < length:
        return np.empty(0, np.uint64)
    power, size = data.astype(np.uint64) + np.uint64(1), 1
    done, done_size = None, 0
    left = length
    base = int(BASE)
    while left:
        if left & 1:
            if done is None:
                done, done_size = power, size
            else:
                shift = np.uint64(pow(base, size, 1 << 64))
                n = len(data) - done_size - size + 1
                done = done[:n] * shift + power[done_size : done_size + n]
                done_size += size
        left >>= 1
        if left:
            shift = np.uint64(pow(base, size, 1 << 64))
            n = len(power) - size
            power = power[:n] * shift + power[size : size + n]
            size *= 2
    return done


def column(df: DataFrame, name: str) -> Column:
    return df[name]
