"""Cards, runners, model inputs and the training set.

Each takes any set of days or races (default: all) and stays lazy. Output is
sorted only for a scoped call; a whole-history result is left unsorted, since a
global sort would shuffle all of it for no consumer. Given `keep`, model inputs
store the runners with all but their races on the way, for callers that read
them more than once or have to hold few shuffles at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.operators.aggregates import DEFAULT_SPEED, lifetime_stats, serving_stats
from paddock.operators.filters import filter_meeting, filter_race, is_winner, labelled
from paddock.operators.joins import (
    SERVING_DEFAULTS,
    TRAINING_DEFAULTS,
    history_for,
    race_context,
    star,
    stats_as_of,
    with_actors,
    with_history,
)
from paddock.operators.scope import scoped
from paddock.operators.skew import HOT_ROWS, Heat, hot_groups
from paddock.sources.warehouse import Tables

Keep = Callable[[DataFrame], DataFrame]

FEATURE_COLUMNS = [
    "race_id", "race_number", "program_number", "horse_name", "program_date", "distance_m",
    "declared_runners_count", "racetrack_code", "discipline", "track_type", "weather_wind",
    "weather_temperature", "terrain_label", "age", "career_winnings", "career_races_count",
    "birth_year", "reference_odds", "live_odds", "hist_avg_speed", "hist_earnings", "hist_races",
    "shoeing_status", "sex", "jockey_name", "trainer_name",
]

TRAINING_COLUMNS = [
    "participant_id", "race_id", "horse_id", "finish_rank", "is_winner", "program_date",
    "racetrack_code", "weather_temperature", "weather_wind", "race_number", "discipline",
    "distance_m", "track_type", "terrain_label", "declared_runners_count", "birth_year", "sex",
    "pmu_number", "age", "career_winnings", "career_races_count", "trainer_advice",
    "reference_odds", "live_odds", "shoeing_status", "jockey_name", "trainer_name",
    "hist_races", "hist_avg_rank", "hist_avg_speed", "hist_best_speed", "hist_earnings",
]


def races_by_date(tables: Tables, dates: Sequence[str] | None = None) -> DataFrame:
    """The card of each day: its races with meeting, distance and track."""
    card = race_context(scoped(tables, dates), dates).select(
        "program_date",
        "race_id",
        "meeting_number",
        "race_number",
        "discipline",
        "distance_m",
        "racetrack_code",
        F.lit(None).cast("string").alias("name"),
        "declared_runners_count",
    )
    return card if dates is None else card.orderBy("program_date", "meeting_number", "race_number")


def card_of_meeting(tables: Tables, date: str, meeting: int) -> DataFrame:
    """The races of one meeting of a day, in order; an invalid day or unknown meeting has none."""
    return filter_meeting(races_by_date(tables, [date]), meeting).orderBy("race_number")


def participants_by_race(tables: Tables, races: Sequence[int] | None = None) -> DataFrame:
    """Runners with horse, driver, trainer and current odds."""
    tables = scoped(tables, races=races)
    runners = filter_race(tables["race_participant"], races)
    named = with_actors(runners.join(tables["horse"].select("horse_id", "horse_name"), "horse_id"), tables)
    listed = named.select(
        "race_id",
        F.col("pmu_number").alias("program_number"),
        "horse_name",
        "driver_name",
        "trainer_name",
        F.col("live_odds").alias("odds"),
    )
    return listed if races is None else listed.orderBy("race_id", "program_number")


def _attach_history(
    runners: DataFrame,
    races: DataFrame,
    stats_of: Callable[[DataFrame | None], DataFrame],
    defaults: dict[str, float],
    as_of: bool,
    sizes: DataFrame | Heat,
    hot_rows: int,
) -> DataFrame:
    """Runners with their horse's record, over all its history or only before each start.

    `stats_of(starts)` gives the stats, per horse where starts is None. `sizes`
    finds the horses with very many starts. A (horse, day) is no larger than its
    horse, so days are only counted where some horse is that large.
    """
    if not as_of:
        return with_history(runners, stats_of(None), defaults, sizes=sizes, hot_rows=hot_rows)
    dated = runners.join(races.select("race_id", "program_date"), "race_id")
    starts = dated.select("horse_id", "program_date")
    limit = None if hot_groups(sizes, ["horse_id"], hot_rows) is None else hot_rows
    joined = with_history(dated, stats_of(starts), defaults, ["horse_id", "program_date"], starts, limit)
    return joined.drop("program_date")


def _read_by(columns: Sequence[str], keep: Keep | None) -> Keep:
    """Store only the columns that are read later."""
    return lambda rows: rows if keep is None else keep(rows.select(*[c for c in rows.columns if c in columns]))


def _model_inputs(
    tables: Tables,
    races: DataFrame,
    runners: DataFrame,
    scoped: bool,
    as_of: bool,
    sizes: DataFrame | Heat | None,
    hot_rows: int,
    keep: Keep | None = None,
) -> DataFrame:
    """Star rows with the served history record of each runner's horse.

    Stats are attached to the narrow runner rows before the wide joins. A scoped
    call first reduces the history to the horses that run; an unscoped one needs
    every horse anyway, so it aggregates the history directly.
    """
    history = tables["horse_race_history"]

    def stats_of(starts: DataFrame | None) -> DataFrame:
        if starts is not None:
            return stats_as_of(history, starts)
        return serving_stats(history_for(history, runners) if scoped else history)

    counted = runners.select("horse_id") if sizes is None else sizes
    known = _attach_history(runners, races, stats_of, SERVING_DEFAULTS, as_of, counted, hot_rows)
    rows = star(tables, races, known, _read_by([*FEATURE_COLUMNS, "pmu_number"], keep))
    return rows.withColumnRenamed("pmu_number", "program_number").select(*FEATURE_COLUMNS)


def race_features(
    tables: Tables,
    races: Sequence[int] | None = None,
    as_of: bool = False,
    sizes: DataFrame | Heat | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Raw model inputs of each runner of the given races.

    `sizes` is any narrow table in which each horse is at least as frequent as
    among the runners (default: the runners).
    """
    tables = scoped(tables, races=races)
    runners = filter_race(tables["race_participant"], races)
    context = filter_race(race_context(tables), races)
    inputs = _model_inputs(tables, context, runners, races is not None, as_of, sizes, hot_rows).drop("race_number")
    return inputs if races is None else inputs.orderBy("race_id", "program_number")


def daily_features(
    tables: Tables,
    dates: Sequence[str] | None = None,
    as_of: bool = False,
    sizes: DataFrame | Heat | None = None,
    hot_rows: int = HOT_ROWS,
    keep: Keep | None = None,
) -> DataFrame:
    """Raw model inputs of every runner of the given days, in one plan unless kept on the way."""
    tables = scoped(tables, dates)
    runners, context = tables["race_participant"], race_context(tables, dates)
    if dates is not None:
        runners = runners.join(context.select("race_id"), "race_id", "left_semi")
    inputs = _model_inputs(tables, context, runners, dates is not None, as_of, sizes, hot_rows, keep)
    return inputs if dates is None else inputs.orderBy("race_id", "program_number")


def training_set(
    tables: Tables,
    as_of: bool = False,
    ordered: bool = False,
    sizes: DataFrame | Heat | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Labelled runners with the lifetime record of their horse.

    A horse without history keeps a null speed. `as_of=True` counts only races
    before the one being labelled.
    """
    runners = labelled(tables["race_participant"])
    races = race_context(tables)
    history = tables["horse_race_history"]

    def stats_of(starts: DataFrame | None) -> DataFrame:
        if starts is None:
            return lifetime_stats(history)
        known = F.col("hist_races").isNotNull()
        speed = F.when(known, F.coalesce("hist_avg_speed", F.lit(DEFAULT_SPEED)))
        return stats_as_of(history, starts, counted="finish_place").withColumn("hist_avg_speed", speed)

    counted = runners.select("horse_id") if sizes is None else sizes
    known = _attach_history(runners, races, stats_of, TRAINING_DEFAULTS, as_of, counted, hot_rows)
    rows = star(tables, races, known).withColumn("is_winner", is_winner()).select(*TRAINING_COLUMNS)
    return rows.orderBy("program_date") if ordered else rows
