"""Positions inside groups, exact for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paddock.operators.skew import HOT_ROWS, by_heat, keyed_join
from paddock.session import durable, packed, released

# A range of fewer rows costs more to start than to sum.
LEAST_RANGE = 1_000


def falling(value: Column) -> list[Column]:
    """Ascending sort keys that put the largest number first and nulls last."""
    return [value.isNull(), -value]


def rising(value: Column) -> list[Column]:
    """Ascending sort keys that put the smallest value first and nulls last."""
    return [value.isNull(), value]


def totals_before(
    df: DataFrame, keys: Sequence[str], order: str, sums: dict[str, str], whole_rows: int = HOT_ROWS
) -> DataFrame:
    """For each row, totals over the rows of its key that sort before it.

    `df` has one row per (keys, order); `sums` maps a value column to its output
    column. If no key has more than `whole_rows` rows, one window per key will do.
    Otherwise all rows are sorted into ranges of about that many; the ranges are
    stored, summed in parallel, and each starts from the total of its key's rows
    in the ranges before. Their number grows with the rows, so no task does.
    """
    df, keys, zero = packed(df), list(keys), F.lit(0)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    largest, rows = sizes.agg(F.max("_rows"), F.sum("_rows")).first()
    if (largest or 0) <= whole_rows:
        ahead = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        sofar = {out: F.coalesce(F.sum(v).over(ahead), zero) for v, out in sums.items()}
        return df.withColumns(sofar)
    count = max(2, -(-rows // max(whole_rows, LEAST_RANGE)))
    ranges = df.repartitionByRange(count, *keys, order)
    placed = packed(ranges.withColumn("_range", F.spark_partition_id()))
    released(df)
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    heads = (
        placed.groupBy(*keys, "_range")
        .agg(*[F.sum(value).alias(f"_in_{value}") for value in sums])
        .select(
            *keys,
            "_range",
            *[F.sum(f"_in_{value}").over(earlier).alias(f"_head_{value}") for value in sums],
        )
    )
    inside = (
        Window.partitionBy(*keys, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    run = placed.select("*", *[F.sum(v).over(inside).alias(f"_run_{v}") for v in sums])
    joined = keyed_join(run, durable(heads), [*keys, "_range"], "inner")
    for value, out in sums.items():
        total = F.coalesce(f"_head_{value}", zero) + F.coalesce(f"_run_{value}", zero)
        joined = joined.withColumn(out, total)
    return joined.select(*df.columns, *sums.values())


def spread_rank(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str, whole_rows: int = HOT_ROWS
) -> DataFrame:
    """Competition rank (ties share the smallest) without a window over the whole group.

    Equal rows are collapsed first, so one value that fills the group is cheap.
    """
    keys = list(keys)
    keyed = df.withColumn("_order", F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)]))
    counts = keyed.groupBy(*keys, "_order").agg(F.count(F.lit(1)).alias("_n"))
    ranks = totals_before(counts, keys, "_order", {"_n": "_before"}, whole_rows)
    ranks = ranks.select(*keys, "_order", (F.col("_before") + 1).alias(out))
    ranks = ranks.withColumnsRenamed({k: f"_right_{k}" for k in [*keys, "_order"]})
    same = [keyed[k].eqNullSafe(ranks[f"_right_{k}"]) for k in [*keys, "_order"]]
    joined = keyed.join(ranks, reduce(and_, same))
    return joined.drop("_order", *[f"_right_{k}" for k in [*keys, "_order"]])


def group_rank(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    out: str,
    unique: bool = False,
    sizes: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Rank rows inside each group by ascending `order`.

    `unique=True` numbers rows 1..n; `order` must then tell all rows of a group apart.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    position = (F.row_number() if unique else F.rank()).over(window).cast("bigint")
    return by_heat(
        df,
        keys,
        cold=lambda rows: rows.withColumn(out, position),
        hot=lambda rows, _: spread_rank(rows, keys, order, out, hot_rows),
        sizes=sizes,
        hot_rows=hot_rows,
    )


def counted_on(fixed: DataFrame, out: str, start: int) -> DataFrame:
    """Gap-free numbers after `start` for stored rows with a _part and a _row counted from 0 inside it, in that order.

    No sort and no shuffle of the rows: what is broadcast is one row per part.
    """
    sizes = fixed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    heads = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = fixed.join(F.broadcast(heads), "_part")
    return numbered.withColumn(out, F.col("_before") + F.col("_row") + start + 1).drop("_part", "_row", "_before")


def in_parts(df: DataFrame) -> DataFrame:
    """Rows stored with the partition they came in and their place there, which no later reading changes."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return packed(df.withColumns({"_part": F.spark_partition_id(), "_row": place}))


def number_all(
    df: DataFrame, order: str, out: str, start: int = 0, whole_rows: int = HOT_ROWS
) -> DataFrame:
    """Number distinct rows start+1, start+2, ... by `order`, without a one-task sort of many.

    Beyond `whole_rows` they are sorted into ranges of about that many, stored, and each range counts on from
    those before it.
    """
    stored = packed(df.withColumn("_all", F.lit(0)))
    rows = stored.count()
    if rows <= whole_rows:
        place = F.row_number().over(Window.partitionBy("_all").orderBy(order)).cast("bigint")
        return stored.withColumn(out, place + start).drop("_all")
    count = max(2, -(-rows // max(whole_rows, LEAST_RANGE)))
    ranges = stored.drop("_all").repartitionByRange(count, order).sortWithinPartitions(order)
    placed = in_parts(ranges)
    released(stored)
    return counted_on(placed, out, start)


def with_positions(df: DataFrame, *order: str) -> DataFrame:
    """Add the place of each row from 1 in the order of columns that tell all rows apart, without a one-task sort."""
    placed = number_all(df.withColumn("_order", F.struct(*order)), "_order", "position")
    return placed.drop("_order")


def write_ordered(df: DataFrame, path: str, *order: str) -> None:
    """Store rows in order: files hold one range of positions each, sorted, in the order of their names.

    A reader that wants some rows of the order filters by `position`, which the files' statistics prune by.
    """
    placed = with_positions(df, *order)
    placed.repartitionByRange("position").sortWithinPartitions("position").write.parquet(path)
