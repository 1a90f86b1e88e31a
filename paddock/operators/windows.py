"""Features of a runner relative to its race or track, and per-race picks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paddock.operators.filters import top_k
from paddock.operators.ranking import falling, group_rank, rising
from paddock.operators.skew import HOT_ROWS, by_heat, keyed_join, sized_join
from paddock.session import durable


def with_group_mean(
    df: DataFrame, cols: dict[str, str], key: str, sizes: DataFrame | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add the mean of each column over the row's group; `cols` maps column to output.

    Ordinary groups use a window, huge ones a pre-aggregated mean that is
    stored (one row per huge group) and joined back.
    """
    window = Window.partitionBy(key)

    def cold(rows: DataFrame) -> DataFrame:
        return rows.withColumns({out: F.avg(c).over(window) for c, out in cols.items()})

    def hot(rows: DataFrame, _: DataFrame) -> DataFrame:
        means = rows.groupBy(key).agg(*[F.avg(c).alias(out) for c, out in cols.items()])
        return keyed_join(rows, durable(means), [key], "inner")

    return by_heat(df, [key], cold, hot, sizes, hot_rows)


def impute_group_mean(
    df: DataFrame,
    col: str,
    key: str,
    default: float | None,
    sizes: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Fill nulls with the mean of the row's group, then with the default.

    For keys with many groups of modest size, such as a race.
    """
    filled = with_group_mean(df, {col: "_mean"}, key, sizes, hot_rows)
    value = F.coalesce(F.col(col), F.when(F.col(key).isNotNull(), F.col("_mean")), F.lit(default).cast("double"))
    return filled.withColumn(col, value).drop("_mean")


def impute_category_mean(df: DataFrame, col: str, key: str, default: float | None) -> DataFrame:
    """As impute_group_mean, for keys with few groups that are all large, such as a track.

    The means are aggregated first and joined back, so no task holds a whole
    group; rows with a null key get no group mean.
    """
    means = df.where(F.col(key).isNotNull() & F.col(col).isNotNull()).groupBy(key).agg(F.avg(col).alias("_mean"))
    value = F.coalesce(F.col(col), F.col("_mean"), F.lit(default).cast("double"))
    return sized_join(df, means, [key]).withColumn(col, value).drop("_mean")


def rank_in_group(
    df: DataFrame,
    col: str,
    key: str,
    desc: bool,
    out: str,
    sizes: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Competition rank of a value in its group as a double; a null value has no rank."""
    order = falling(F.col(col)) if desc else rising(F.col(col))
    ranked = group_rank(df, [key], order, "_rank", sizes=sizes, hot_rows=hot_rows)
    rank = F.when(F.col(col).isNotNull(), F.col("_rank").cast("double"))
    return ranked.withColumn(out, rank).drop("_rank")


def ratio_to_group_mean(
    df: DataFrame, col: str, key: str, out: str, sizes: DataFrame | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """A value over its group's mean plus one."""
    joined = with_group_mean(df, {col: "_mean"}, key, sizes, hot_rows)
    return joined.withColumn(out, F.try_divide(F.col(col), F.col("_mean") + 1)).drop("_mean")


def predicted_rank(
    df: DataFrame,
    key: str,
    p: str,
    tie: Sequence[str],
    out: str = "predicted_rank",
    sizes: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Number the rows of each group 1..n by falling probability, equal ones by `tie`.

    `tie` must be unique inside a group, as a runner's number is.
    """
    order: list[Column] = [*falling(F.col(p)), *[F.col(t) for t in tie]]
    ranked = group_rank(df, [key], order, out, unique=True, sizes=sizes, hot_rows=hot_rows)
    return ranked.withColumn(out, F.col(out).cast("int"))


def best_per_group(df: DataFrame, key: str, p: str, tie: Sequence[str]) -> DataFrame:
    """The row with the largest probability of each group, equal ones by `tie`."""
    return top_k(df, [key], [*falling(F.col(p)), *[F.col(t) for t in tie]], 1)
