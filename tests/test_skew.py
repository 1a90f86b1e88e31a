"""The plans for huge groups must give what the ordinary ones give."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from paddock.operators import aggregates, loading, ranking, windows
from paddock.operators.joins import with_history
from paddock.operators.skew import by_heat, hot_groups, lookup_join
from paddock.plans import cards


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds a third of the rows, and one value most of that group."""
    return spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 200 + 1).alias("g"),
        F.when(F.col("id") % 6 == 0, 1.5).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") * 37 % 101 / 4).alias("v"),
    )


def test_hot_groups(spark, skewed):
    assert rows(hot_groups(skewed, ["g"], 500)) == [(0,)]
    assert hot_groups(skewed, ["g"], 5000) is None
    assert hot_groups(skewed.where("false"), ["g"], 5) is None


@pytest.mark.parametrize("desc", [True, False])
def test_rank(spark, skewed, desc):
    plain = windows.rank_in_group(skewed, "v", "g", desc, "r")
    split = windows.rank_in_group(skewed, "v", "g", desc, "r", hot_rows=50)
    assert rows(plain, "id", "r") == rows(split, "id", "r")


def test_rank_in_ranges(spark, skewed):
    plain = windows.rank_in_group(skewed, "v", "g", False, "r")
    counts = ranking.spread_rank(skewed, ["g"], ranking.rising(F.col("v")), "r", whole_rows=0)
    expected = rows(plain.where("v is not null"), "id", "r")
    assert rows(counts.where("v is not null").withColumn("r", F.col("r").cast("double")), "id", "r") == expected


def test_means_and_ratio(spark, skewed):
    def both(fn):
        return [[(i, None if x is None else round(x, 9)) for i, x in rows(fn(h), "id", "x")] for h in (10**6, 50)]

    ratio = both(lambda h: windows.ratio_to_group_mean(skewed, "v", "g", "x", hot_rows=h))
    assert ratio[0] == ratio[1]
    filled = both(lambda h: windows.impute_group_mean(skewed, "v", "g", 9.0, hot_rows=h).withColumnRenamed("v", "x"))
    assert filled[0] == filled[1]
    by_category = windows.impute_category_mean(skewed, "v", "g", 9.0)
    assert [(i, round(x, 9)) for i, x in rows(by_category, "id", "v")] == filled[0]


def test_lookup_join(spark, skewed):
    dim = spark.range(0, 150).select(F.col("id").alias("g"), (F.col("id") * 2).alias("twice"))
    assert rows(lookup_join(skewed, dim, ["g"], hot_rows=50), "id", "twice") == rows(
        skewed.join(dim, "g", "left"), "id", "twice"
    )


def test_rows_without_a_key_are_kept(spark, skewed):
    df = skewed.withColumn("g", F.expr("nullif(g, 5)"))
    out = by_heat(df, ["g"], lambda r: r, lambda r, _: r, hot_rows=50)
    assert out.count() == df.count()


@pytest.mark.parametrize("whole_rows", [10**6, 0])
def test_number_all(spark, whole_rows):
    names = spark.range(2000).select(F.format_string("n%05d", F.col("id") * 7919 % 100_003).alias("name"))
    got = ranking.number_all(names, "name", "k", 10, whole_rows).orderBy("name").select("k").collect()
    assert [r["k"] for r in got] == list(range(11, 2011))


def test_number_stored(spark):
    got = loading.number_stored(spark.range(1000).repartition(7), "k", 5)
    assert rows(got, "k") == rows(spark.range(6, 1006).toDF("k"))


@pytest.mark.parametrize("whole_rows", [10**6, 0])
def test_roc_auc(spark, whole_rows):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1), (0.4, 1)], "p double, y int")
    # Pairs won: 0.35 beats 0.1; 0.8 beats both; 0.4 beats 0.1 and ties once.
    assert aggregates.roc_auc(df, "p", "y", whole_rows).first()[0] == pytest.approx(4.5 / 6)
    assert aggregates.roc_auc(df.where("y = 1"), "p", "y", whole_rows).first()[0] == 0.5
    assert aggregates.roc_auc(df.where("y = 7"), "p", "y", whole_rows).first()[0] == 0.5


def test_log_loss_is_finite_at_the_ends(spark):
    df = spark.createDataFrame([(1.0, 1), (0.0, 0), (0.0, 1)], "p double, y int")
    assert aggregates.log_loss(df, "p", "y").first()[0] == pytest.approx(36.04365338911715 / 3)


def test_hot_horses(spark, tables):
    plain, split = cards.daily_features(tables), cards.daily_features(tables, hot_rows=25)
    keep = ("race_id", "program_number", "hist_races", F.round("hist_earnings", 4))
    assert rows(plain, *keep) == rows(split, *keep)
    plain, split = (cards.daily_features(tables, as_of=True, hot_rows=h) for h in (10**6, 1))
    assert rows(plain, *keep) == rows(split, *keep)


def test_history_defaults(spark):
    runners = spark.createDataFrame([(1,), (2,)], "horse_id bigint")
    history = spark.createDataFrame([(1, None, None, None)], "horse_id bigint, finish_place int, reduction_km double, prize_money double")
    served = with_history(runners, aggregates.serving_stats(history), {"hist_avg_speed": 1.2, "hist_earnings": 0.0, "hist_races": 0})
    assert rows(served, "horse_id", "hist_races", "hist_avg_speed", "hist_earnings") == [(1, 1, 1.2, 0.0), (2, 0, 1.2, 0.0)]
    trained = with_history(runners, aggregates.lifetime_stats(history), {"hist_earnings": 0.0, "hist_races": 0})
    assert rows(trained, "horse_id", "hist_races", "hist_avg_speed") == [(1, 0, 1.2), (2, 0, None)]


def test_all_hot_keys_are_split_and_a_null_key_too(spark, monkeypatch):
    monkeypatch.setattr("paddock.operators.skew.BROADCAST_ROWS", 3)  # more hot keys than are broadcast
    key = F.when(F.col("id") % 8 > 0, F.col("id") % 8)
    df = spark.range(160).select(key.alias("k"), (F.col("id") * 7 % 160).alias("v"))
    assert hot_groups(df, ["k"], 5).count() == 8
    ranked = lambda hot_rows: rows(ranking.group_rank(df, ["k"], [F.col("v")], "rank", hot_rows=hot_rows))
    assert ranked(5) == ranked(1_000_000)
    means = lambda hot_rows: rows(windows.with_group_mean(df, {"v": "mean"}, "k", hot_rows=hot_rows))
    assert means(5) == means(1_000_000)


def test_missing_scores_are_left_out_of_the_log_loss(spark):
    df = spark.createDataFrame([(0.5, 1), (None, 1), (float("nan"), 0), (0.5, None)], "p double, y int")
    assert abs(aggregates.log_loss(df, "p", "y").first()[0] - 0.6931471805599453) < 1e-12
