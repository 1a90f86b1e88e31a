"""Row filters, splits and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paddock.functions.codes import TROT
from paddock.functions.parsing import day_of_code

MIN_EDGE, MIN_ODDS, MAX_ODDS = 0.05, 5.0, 20.0


def filter_date(df: DataFrame, codes: Sequence[str] | None, column: str = "program_date") -> DataFrame:
    """Rows of the given DDMMYYYY days; an invalid code matches nothing."""
    if codes is None:
        return df
    return df.where(F.col(column).isin(*[day_of_code(F.lit(code)) for code in codes]))


def filter_race(df: DataFrame, races: Sequence[int] | None, column: str = "race_id") -> DataFrame:
    return df if races is None else df.where(F.col(column).isin(*races))


def filter_disciplines(df: DataFrame, disciplines: Sequence[str] = TROT) -> DataFrame:
    """Exact, case-sensitive membership."""
    return df.where(F.col("discipline").isin(*disciplines))


def filter_meeting(df: DataFrame, meeting: int | None) -> DataFrame:
    return df if meeting is None else df.where(F.col("meeting_number") == meeting)


def labelled(df: DataFrame, rank: str = "finish_rank") -> DataFrame:
    return df.where(F.col(rank).isNotNull())


def is_winner(rank: str = "finish_rank") -> Column:
    return F.when(F.col(rank) == 1, 1).otherwise(0)


def temporal_split(
    df: DataFrame, date_col: str = "program_date", test_days: int = 60, val_days: int = 30
) -> DataFrame:
    """Mark rows as train, val or test by their distance from the latest day."""
    last = df.agg(F.max(date_col)).scalar()
    day = F.col(date_col)
    part = (
        F.when(day <= F.date_sub(last, test_days + val_days), "train")
        .when(day <= F.date_sub(last, test_days), "val")
        .when(day.isNotNull(), "test")
    )
    return df.withColumn("split", part)


def value_mask(
    df: DataFrame, min_edge: float = MIN_EDGE, lo: float = MIN_ODDS, hi: float = MAX_ODDS
) -> DataFrame:
    """Runners whose edge and odds are in range, limits included; null and NaN never pass."""
    # NaN counts as greater than any number, so it is turned into null first.
    edge, odds = (F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in ("edge", "reference_odds"))
    return df.where((edge >= min_edge) & odds.between(lo, hi))


def top_k(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First k rows of each group.

    Spark limits each map task to k rows per group before the shuffle, so a hot
    group sends no more than that to its reducer.
    """
    position = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_position", position).where(F.col("_position") <= k).drop("_position")


def existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Those of the wanted columns that the frame has."""
    return df.select(*[name for name in wanted if name in df.columns])
