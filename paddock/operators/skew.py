"""Plans that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.session import durable

# A group above HOT_ROWS gets the split treatment, however many such groups there
# are. The number only chooses a plan: results are equal, up to the last bit of sums.
HOT_ROWS = 1_000_000

# Largest lookup side that is broadcast once its row count has been measured; a
# larger one is joined by shuffle, with the same result.
BROADCAST_ROWS = 10_000

# Hot groups that get a plan of their own, and counters of the sketch that finds them.
MOST_HOT, TRACKED = 1_000, 65_536


def keyed_join(left: DataFrame, stored: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join to a stored table in which null keys match null keys, broadcast if it is small."""
    right = stored.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(and_, [left[k].eqNullSafe(right[f"_right_{k}"]) for k in keys])
    small = stored.count() <= BROADCAST_ROWS
    joined = left.join(F.broadcast(right) if small else right, same, how)
    return joined.drop(*[f"_right_{k}" for k in keys])


@dataclass(frozen=True)
class Heat:
    """The hot groups of a key, measured before; pass it as `sizes` where one measurement serves several steps."""

    groups: DataFrame | None


def hot_groups(source: DataFrame | Heat, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys of the groups above hot_rows, a null key among them, None if no group is huge.

    One key is measured by a frequent-items sketch: each task keeps TRACKED counters at most and nothing is
    shuffled by key. Counts may be off by about two in TRACKED of all rows, and only the MOST_HOT largest groups
    are told; a group that is missed, or taken for hot, only gets another plan for the same result. Several
    keys together are counted exactly. The keys are few, or stored, so that every branch of a plan splits
    along the same ones.
    """
    if isinstance(source, Heat):
        return source.groups
    if len(keys) == 1:
        counted = source.agg(F.expr(f"approx_top_k(`{keys[0]}`, {MOST_HOT}, {TRACKED})").alias("top")).first()["top"]
        hot = [(item["item"],) for item in counted if item["count"] > hot_rows]
        return source.sparkSession.createDataFrame(hot, source.select(keys[0]).schema) if hot else None
    counts = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    largest = counts.agg(F.max("_rows")).first()[0]
    if largest is None or largest <= hot_rows:
        return None
    return durable(counts.where(F.col("_rows") > hot_rows).select(*keys))


def by_heat(
    df: DataFrame,
    keys: Sequence[str],
    cold: Callable[[DataFrame], DataFrame],
    hot: Callable[[DataFrame, DataFrame], DataFrame],
    sizes: DataFrame | Heat | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Run `cold` on ordinary groups and `hot` on the few huge ones, then union.

    Measures first: with no huge group the plan is just `cold(df)`. `sizes` is any
    narrow table whose groups are at least as large (default: `df`). Which groups
    count as huge never changes the result, only how it is computed.
    """
    heat = hot_groups(df if sizes is None else sizes, keys, hot_rows)
    if heat is None:
        return cold(df)
    ordinary = keyed_join(df, heat, keys, "left_anti")
    huge = keyed_join(df, heat, keys, "left_semi")
    return cold(ordinary).unionByName(hot(huge, heat))


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    sizes: DataFrame | Heat | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Left join to a side that is unique per key, with the hot keys of `left` broadcast if few.

    Use it where `right` comes straight from an aggregate: AQE only splits hot
    partitions of joins whose two inputs are plain exchanges. `hot_rows=None`
    says that no key is hot, for callers that know.
    """
    keys = list(keys)
    if hot_rows is None:
        return left.join(right, keys, "left")

    def hot(rows: DataFrame, heat: DataFrame) -> DataFrame:
        return sized_join(rows, keyed_join(right, heat, keys, "left_semi"), keys)

    return by_heat(left, keys, lambda rows: rows.join(right, keys, "left"), hot, sizes, hot_rows)


def sized_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join to a small result whose size is measured first.

    The right side is computed once and stored. It is broadcast if it has at
    most BROADCAST_ROWS rows, otherwise joined by shuffle under AQE.
    """
    stored = durable(right)
    small = stored.count() <= BROADCAST_ROWS
    return left.join(F.broadcast(stored) if small else stored, list(keys), how)
