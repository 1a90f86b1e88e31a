"""Star, semi and lookup joins over the warehouse tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paddock.operators.aggregates import DEFAULT_SPEED
from paddock.operators.filters import filter_date
from paddock.operators.skew import HOT_ROWS, Heat, lookup_join
from paddock.sources.warehouse import Tables


def race_context(tables: Tables, dates: Sequence[str] | None = None) -> DataFrame:
    """Races with their meeting and day. The day filter runs on the smallest table."""
    days = filter_date(tables["daily_program"], dates)
    meetings = tables["race_meeting"].join(days, "program_id")
    return tables["race"].join(meetings, "meeting_id")


def with_actors(df: DataFrame, tables: Tables, driver: str = "driver_name") -> DataFrame:
    """Add the names of driver and trainer, two roles of one table."""
    actors = tables["racing_actor"]
    drivers = actors.select(F.col("actor_id").alias("driver_jockey_id"), F.col("actor_name").alias(driver))
    trainers = actors.select(F.col("actor_id").alias("trainer_id"), F.col("actor_name").alias("trainer_name"))
    return df.join(drivers, "driver_jockey_id", "left").join(trainers, "trainer_id", "left")


def star(
    tables: Tables, races: DataFrame, runners: DataFrame, keep: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> DataFrame:
    """Runners with race, meeting, day, horse, shoeing, driver and trainer.

    `races` is race_context and `runners` rows of race_participant, both scoped
    by the caller. A runner's own sex gives way to the horse's.

    The horse comes first, so that runners just joined to per-horse stats are not
    shuffled again; the race comes last, so that its columns travel once and
    per-race windows above find the rows already together. `keep` may store the rows
    before that, so that the shuffles on both sides need not be held at once.
    """
    shoeing = tables["lookup_shoeing"].select("shoeing_id", F.col("code").alias("shoeing_status"))
    base = runners.drop("sex").join(tables["horse"], "horse_id").join(shoeing, "shoeing_id", "left")
    return keep(with_actors(base, tables, driver="jockey_name")).join(races, "race_id")


def history_for(history: DataFrame, runners: DataFrame) -> DataFrame:
    """Only the history of horses that run."""
    return history.join(runners.select("horse_id"), "horse_id", "left_semi")


def with_history(
    df: DataFrame,
    stats: DataFrame,
    defaults: dict[str, float],
    keys: Sequence[str] = ("horse_id",),
    sizes: DataFrame | Heat | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Left join per-horse stats, then fill the columns named in `defaults`."""
    joined = lookup_join(df, stats, keys, sizes, hot_rows)
    fills = {name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()}
    return joined.withColumns(fills)


SERVING_DEFAULTS = {"hist_avg_speed": DEFAULT_SPEED, "hist_earnings": 0.0, "hist_races": 0}
TRAINING_DEFAULTS = {"hist_earnings": 0.0, "hist_races": 0}


def stats_as_of(history: DataFrame, starts: DataFrame, counted: str = "*") -> DataFrame:
    """Per-horse stats over races strictly before each start of that horse.

    `starts` has horse_id and program_date. Both sides are reduced to one row per
    (horse, day) and merged into a running total, so work is linear and a horse
    brings at most two rows per calendar day to its window, however hot it is.
    `counted="*"` counts every history row, a column name only rows where it is set.
    """
    races = F.lit(1) if counted == "*" else F.col(counted)
    daily = (
        history.where("race_date is not null")
        .groupBy("horse_id", F.col("race_date").alias("_day"))
        .agg(
            F.count(races).alias("_races"),
            F.sum("finish_place").alias("_place"),
            F.count("finish_place").alias("_places"),
            F.sum("reduction_km").alias("_speed"),
            F.count("reduction_km").alias("_speeds"),
            F.min("reduction_km").alias("_best"),
            F.sum("prize_money").alias("_earned"),
        )
        .withColumn("_start", F.lit(False))
    )
    asked = starts.select("horse_id", F.col("program_date").alias("_day")).distinct()
    both = daily.unionByName(asked.withColumn("_start", F.lit(True)), allowMissingColumns=True)
    before = (
        Window.partitionBy("horse_id")
        .orderBy(F.datediff("_day", F.lit("1970-01-01").cast("date")))
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    total = {c: F.sum(c).over(before) for c in ("_races", "_place", "_places", "_speed", "_speeds", "_earned")}
    return (
        both.select("horse_id", "_day", "_start", F.min("_best").over(before).alias("hist_best_speed"),
                    *[column.alias(name) for name, column in total.items()])
        .where("_start")
        .select(
            "horse_id",
            F.col("_day").alias("program_date"),
            F.col("_races").alias("hist_races"),
            F.try_divide("_place", "_places").alias("hist_avg_rank"),
            F.try_divide("_speed", "_speeds").alias("hist_avg_speed"),
            "hist_best_speed",
            F.col("_earned").alias("hist_earnings"),
        )
    )


def join_predictions(
    predictions: DataFrame, runners: DataFrame, listed: DataFrame | None = None, heat: Heat | None = None
) -> DataFrame:
    """Add driver and odds to predictions; a race with no runners listed shows driver N/A.

    `listed` is any narrow table with the races that have runners (default: `runners`), `heat` its hot races.
    """
    extra = [name for name in ("driver_name", "odds") if name in runners.columns]
    joined = predictions.join(runners.select("race_id", "program_number", *extra), ["race_id", "program_number"], "left")
    if "driver_name" not in extra:
        return joined
    races = (runners if listed is None else listed).select("race_id").distinct().withColumn("_listed", F.lit(True))
    counted = predictions.select("race_id") if listed is None else listed
    flagged = lookup_join(joined, races, ["race_id"], sizes=counted if heat is None else heat)
    missing = F.when(F.col("_listed").isNull(), F.lit("N/A"))
    return flagged.withColumn("driver_name", F.coalesce("driver_name", missing)).drop("_listed")
