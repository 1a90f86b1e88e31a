"""Grouped and global aggregates. All combine map-side, so hot keys stay cheap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.operators.ranking import totals_before
from paddock.operators.skew import HOT_ROWS

DEFAULT_SPEED = 1.20

# Machine epsilon of a double: how far probabilities are kept from 0 and 1.
EPSILON = 2.220446049250313e-16


def serving_stats(history: DataFrame) -> DataFrame:
    """Per-horse record as served: every row counts as a race."""
    return history.groupBy("horse_id").agg(
        F.count(F.lit(1)).alias("hist_races"),
        F.avg("finish_place").alias("hist_avg_rank"),
        F.avg("reduction_km").alias("hist_avg_speed"),
        F.sum("prize_money").alias("hist_earnings"),
    )


def lifetime_stats(history: DataFrame) -> DataFrame:
    """Per-horse record for training: only placed rows count, missing speed is set to the default."""
    return history.groupBy("horse_id").agg(
        F.count("finish_place").alias("hist_races"),
        F.avg("finish_place").alias("hist_avg_rank"),
        F.coalesce(F.avg("reduction_km"), F.lit(DEFAULT_SPEED)).alias("hist_avg_speed"),
        F.min("reduction_km").alias("hist_best_speed"),
        F.coalesce(F.sum("prize_money"), F.lit(0.0)).alias("hist_earnings"),
    )


def learned_means(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the mean of each column, NaN taken as missing."""
    return df.agg(*[F.avg(F.nanvl(F.col(c).cast("double"), F.lit(None))).alias(c) for c in columns])


def latest_day(df: DataFrame, date_col: str = "program_date") -> DataFrame:
    return df.agg(F.max(date_col).alias("last_day"))


def split_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


def _judged(df: DataFrame, p: str, y: str) -> DataFrame:
    """The rows that have a score and a label; both metrics are taken over these."""
    return df.where(F.nanvl(F.col(p).cast("double"), F.lit(None)).isNotNull() & F.col(y).isNotNull())


def log_loss(df: DataFrame, p: str, y: str) -> DataFrame:
    """Mean negative log likelihood of binary labels, as one row.

    Rows whose probability is null or NaN, or whose label is null, are left out.
    """
    df = _judged(df, p, y)
    safe = F.least(F.greatest(F.col(p), F.lit(EPSILON)), F.lit(1.0 - EPSILON))
    loss = F.when(F.col(y) == 1, -F.log(safe)).otherwise(-F.log(F.lit(1.0) - safe))
    return df.agg(F.avg(loss).alias("log_loss"))


def roc_auc(df: DataFrame, p: str, y: str, whole_rows: int = HOT_ROWS) -> DataFrame:
    """Exact area under the ROC curve, as one row; a single class gives 0.5.

    Rows whose score is null or NaN, or whose label is null, are left out. Scores are collapsed to distinct values, whose running count of negatives is
    built in parallel ranges, so there is no global one-task sort.
    """
    positive = F.when(F.col(y) == 1, 1).otherwise(0)
    scores = (
        _judged(df, p, y).groupBy(F.col(p).alias("score"))
        .agg(F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg"))
        .withColumn("everything", F.lit(0))
    )
    placed = totals_before(scores, ["everything"], "score", {"neg": "below"}, whole_rows)
    wins = F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return placed.agg(F.coalesce(F.try_divide(wins, pairs), F.lit(0.5)).alias("roc_auc"))
