"""Landed feed documents and the dead letters among them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.functions.parsing import day_of_code
from paddock.session import shuffles_dropped, together

# One row per landed document; `seq` orders documents by arrival.
LANDING = (
    "feed string, date_code string, meeting int, race int, http_status int, payload string, seq bigint"
)
FEEDS = ("programme", "participants", "performances", "reports")


def read_landing(spark: SparkSession, path: str, dates: Sequence[str] | None = None) -> DataFrame:
    """A landing table in Parquet, partitioned by feed and date_code, pruned to the given days."""
    df = spark.read.schema(LANDING).parquet(path)
    return df if dates is None else df.where(F.col("date_code").isin(*dates))


def write_landing(landing: DataFrame, path: str) -> None:
    landing.write.mode("append").partitionBy("feed", "date_code").parquet(path)


def read_documents(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """JSON files named DDMMYYYY.json or DDMMYYYY_R1_C2.json, one document each."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.json")
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d{8})(?:_R(\d+)_C(\d+))?", 0)

    def part(index: int) -> Column:
        return F.regexp_extract(name, r"^(\d{8})(?:_R(\d+)_C(\d+))?", index)

    return files.select(
        F.lit(feed).alias("feed"),
        part(1).alias("date_code"),
        part(2).try_cast("int").alias("meeting"),
        part(3).try_cast("int").alias("race"),
        F.lit(200).alias("http_status"),
        F.col("value").alias("payload"),
        F.unix_millis(F.col("_metadata.file_modification_time")).alias("seq"),
        # Tells apart the documents of one moment, so that "first" has one meaning.
        F.col("_metadata.file_path").alias("name"),
    )


def landed_day(landing: DataFrame) -> DataFrame:
    return landing.withColumn("day", day_of_code(F.col("date_code")))


def write_dead_letters(rejects: DataFrame, path: str) -> None:
    """Keep rejected documents as raw JSON, keyed by day, meeting and race.

    A day's documents are brought together first: a task that held some of every day would write a file for each.
    """
    key = F.concat(
        F.col("date_code"),
        F.lit("_R"),
        F.coalesce(F.col("meeting").cast("string"), F.lit("")),
        F.lit("_C"),
        F.coalesce(F.col("race").cast("string"), F.lit("")),
    )
    kept = rejects.select("feed", "date_code", key.alias("document"), "payload")
    kept = together(kept, "feed", "date_code", "document", F.xxhash64("payload"))
    with shuffles_dropped(rejects.sparkSession):
        kept.write.mode("append").partitionBy("feed", "date_code").json(path)
