"""Buckets of sharding where many rows are equal or texts are long."""

from collections import Counter

from pyspark.sql import functions as F

from paddock.llm import sharding


def _largest_bucket(monkeypatch, tmp_path, docs, **options):
    sizes, made = [], sharding._scattered
    def seen(*args):  # noqa: E306
        keyed, hot = made(*args)
        sizes.append(keyed.groupBy("bucket").count().agg(F.max("count")).first()[0])
        return keyed, hot

    monkeypatch.setattr(sharding, "_scattered", seen)
    sharding.write_shards(docs, str(tmp_path / "shards"), shards=4, **options)
    return sizes[0]


def test_equal_rows_spread_over_buckets(spark, tmp_path, monkeypatch):
    rows = [(None, "same")] * 2_000 + [(5, "five")] * 300 + [(i, f"text {i}") for i in range(1_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert _largest_bucket(monkeypatch, tmp_path, docs, bucket_rows=100) < 200
    got = sharding.read_shards(spark, str(tmp_path / "shards")).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    assert sorted(r.place for r in got) == list(range(len(rows)))


def test_long_texts_make_more_buckets(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(i, f"{i} " + "x" * 10_000) for i in range(400)], "doc_id long, text string")
    assert _largest_bucket(monkeypatch, tmp_path, docs, bucket_bytes=200_000) < 60
