import pytest
from pyspark.sql import functions as F

from conftest import rows
from paddock.operators.filters import temporal_split, top_k
from paddock.operators.joins import join_predictions
from paddock.plans import cards, decisions

SCORED = "race_id bigint, race_number bigint, program_number int, horse_name string, reference_odds double, win_probability double"


def scored(spark, *runners):
    return spark.createDataFrame([(1, 1, i, *r) for i, r in enumerate(runners, 1)], SCORED)


def test_value_pick_keeps_the_underrated_runner(spark):
    df = scored(spark, ("Fav", 1.1, 0.8), ("Underrated", 10.0, 0.2), ("Loser", 8.0, 0.05))
    bet = decisions.value_bets(df).collect()
    assert [b["horse_name"] for b in bet] == ["Underrated"]
    assert bet[0]["edge"] == pytest.approx(0.1)
    assert bet[0]["strategy"] == "Sniper"


def test_value_pick_ignores_short_long_and_missing_odds(spark):
    df = scored(
        spark, ("Fair Price", 10.0, 0.20), ("Short Price", 2.0, 0.60), ("Outsider", 50.0, 0.05),
        ("No odds", None, 0.9), ("NaN", float("nan"), 0.9), ("No score", 10.0, None), ("NaN score", 10.0, float("nan")),
    )
    assert [b["horse_name"] for b in decisions.value_bets(df).collect()] == ["Fair Price"]


def test_value_limits_are_inclusive(spark):
    df = scored(spark, ("A", 5.0, 0.25), ("B", 20.0, 0.24))
    assert [b["horse_name"] for b in decisions.value_bets(df, min_edge=0.04).collect()] == ["A"]
    assert decisions.value_bets(df.where("horse_name = 'B'"), min_edge=0.19).count() == 1


def test_empty_day_has_no_picks(spark):
    empty = spark.createDataFrame([], SCORED)
    assert decisions.value_bets(empty).count() == 0
    assert decisions.predict_race(empty).count() == 0


@pytest.mark.parametrize("hot_rows", [1_000_000, 1])
def test_predicted_rank(spark, hot_rows):
    df = scored(spark, ("B", 10.0, 0.2), ("A", 5.0, 0.8), ("C", 5.0, 0.2), ("D", 5.0, None), ("E", 5.0, float("nan")))
    got = decisions.predict_race(df, hot_rows=hot_rows).collect()
    assert {r["horse_name"]: r["predicted_rank"] for r in got} == {"A": 1, "B": 2, "C": 3, "D": 4, "E": 5}


def test_analysis_falls_back_where_no_runner_is_listed(spark):
    ranked = spark.createDataFrame([(1, 1, "A"), (1, 2, "B"), (2, 1, "C")], "race_id bigint, program_number int, horse_name string")
    listed = spark.createDataFrame([(1, 1, "Dee", 5.0)], "race_id bigint, program_number int, driver_name string, odds double")
    got = {r["horse_name"]: (r["driver_name"], r["odds"]) for r in join_predictions(ranked, listed).collect()}
    assert got == {"A": ("Dee", 5.0), "B": (None, None), "C": ("N/A", None)}


def test_scoped_calls(spark, tables):
    day = tables["daily_program"].agg(F.max("program_date")).first()[0]
    card = cards.races_by_date(tables, [f"{day:%d%m%Y}"])
    assert {r["program_date"] for r in card.collect()} == {day}
    assert cards.races_by_date(tables, ["99999999"]).count() == 0
    assert cards.daily_features(tables, ["99999999"]).count() == 0
    race = card.first()["race_id"]
    runners = cards.participants_by_race(tables, [race]).collect()
    assert [r["program_number"] for r in runners] == sorted(r["program_number"] for r in runners)
    whole = cards.daily_features(tables).where(F.col("race_id") == race).drop("race_number")
    assert rows(cards.race_features(tables, [race])) == rows(whole)
    scoped = cards.daily_features(tables, [f"{day:%d%m%Y}"]).where(F.col("race_id") == race).drop("race_number")
    assert rows(scoped) == rows(whole)
    assert decisions.race_card(tables, [f"{day:%d%m%Y}"], meeting=9).count() == 0


def test_ranks_and_picks_hold_per_race(spark, tables):
    from registry.queries import given_scores

    given = given_scores(tables)
    worst = decisions.predict_race(given).groupBy("race_id").agg(
        F.max("predicted_rank").alias("last"), F.count("*").alias("n"), F.countDistinct("predicted_rank").alias("d")
    )
    assert worst.where("last <> n or d <> n").count() == 0
    assert decisions.value_bets(given).groupBy("race_id").count().where("count > 1").count() == 0


def test_top_k_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("g"), "id")
    plan = top_k(df, ["g"], [F.desc("id")], 3)
    assert rows(plan, "id") == [(94,), (95,), (96,), (97,), (98,), (99,)]
    assert plan._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2


def test_temporal_split_boundaries(spark):
    days = spark.sql("select date_sub(date'2024-12-31', d) program_date, d from (select explode(array(0, 59, 60, 89, 90, 200)) d)")
    got = {r["d"]: r["split"] for r in temporal_split(days).collect()}
    assert got == {0: "test", 59: "test", 60: "val", 89: "val", 90: "train", 200: "train"}
