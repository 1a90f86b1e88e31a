"""Idempotent loads: first write wins, get-or-create keys, key resolution."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.operators.filters import top_k
from paddock.operators.ranking import counted_on, in_parts, number_all
from paddock.schemas import TABLES
from paddock.session import packed, released
from paddock.sources.warehouse import LAYOUTS


def _has_key(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def load_once(
    batch: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    mode: str = "ignore",
    nullable_keys: bool = False,
    prune_by: str | None = None,
) -> DataFrame:
    """Rows to store for a batch whose natural key is `keys`.

    ignore: the batch rows to append, the first by `order_by` of each key that
    the target lacks. A null in the key never conflicts, so with `nullable_keys`
    such rows pass untouched, without any shuffle.
    update: the whole new state of the table; per column the latest non-null
    value of the batch wins over the stored one.

    `prune_by` names a key column whose range in the batch is used to skip the
    rest of the target. It costs one pass over the batch.
    """
    keys = list(keys)
    if mode == "update":
        return _merged(batch, target, keys, order_by)
    keyed = batch.where(_has_key(keys)) if nullable_keys else batch
    first = top_k(keyed, keys, [F.col(c) for c in order_by], 1)
    stored = target if prune_by is None else _within(target, batch, prune_by)
    new = first.join(stored.select(*keys), keys, "left_anti").select(*batch.columns)
    return new.unionByName(batch.where(~_has_key(keys))) if nullable_keys else new


def _within(target: DataFrame, batch: DataFrame, column: str) -> DataFrame:
    """Target rows in the batch's range of a column, as literals that reach file statistics."""
    low, high = batch.agg(F.min(column), F.max(column)).first()
    if low is None:
        return target.where(F.lit(False))
    return target.where(F.col(column).between(low, high))


def latest_known(batch: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key with the last non-null value of each column; rows with a null key stay as they are.

    The reduction runs in the map tasks first, so a key that repeats a lot costs one row per task.
    """
    at = F.struct(*[F.col(c) for c in order_by])
    values = [c for c in batch.columns if c not in keys]
    last = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), at)).alias(c) for c in values]
    reduced = batch.where(_has_key(keys)).groupBy(*keys).agg(*last)
    return reduced.unionByName(batch.where(~_has_key(keys))).select(*batch.columns)


def latest_stored(batch: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The rows of latest_known, stored. Of a key that comes once its row is the latest known already.

    The reduction keeps the order beside every value, which makes rows some times as wide, so unless most rows have a
    key that repeats, only those that do go through it.
    """
    keys, stored = list(keys), packed(batch)
    counts = stored.where(_has_key(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    rows, several = counts.agg(F.sum("_n"), F.sum(F.when(F.col("_n") > 1, F.col("_n")))).first()
    if several is None:
        return stored
    if 2 * several > rows:
        latest = packed(latest_known(stored, keys, order_by))
    else:
        repeated = counts.where("_n > 1").select(*keys)
        once = stored.join(repeated, keys, "left_anti").select(*batch.columns)
        again = stored.join(repeated, keys, "left_semi").select(*batch.columns)
        latest = packed(once.unionByName(latest_known(again, keys, order_by)))
    released(stored)
    return latest


def refreshed(target: DataFrame, latest: DataFrame, keys: Sequence[str], fixed: Sequence[str] = ()) -> DataFrame:
    """Target rows with the known values of `latest`, which has one row per key; `fixed` columns keep theirs."""
    values = [c for c in target.columns if c in latest.columns and c not in keys and c not in fixed]
    news = latest.where(_has_key(keys)).select(*keys, *[F.col(c).alias(f"_new_{c}") for c in values])
    joined = target.join(news, list(keys), "left")
    return joined.select(*[F.coalesce(f"_new_{c}", c).alias(c) if c in values else F.col(c) for c in target.columns])


def updated(target: DataFrame, latest: DataFrame, name: str, near: DataFrame | None = None) -> DataFrame | None:
    """The stored rows to write again so that a table holds the values of `latest`; None where it does already.

    These are all rows of the folders with a value that changes, or the whole of a table without folders.
    `near` are the rows of the table that can share a key with `latest` (default: all).
    """
    table, layout = TABLES[name], LAYOUTS.get(name)
    keys, near = list(table.key), target if near is None else near
    known = latest.where(_has_key(keys))
    values = [c for c in target.columns if c in latest.columns and c not in keys and c != table.id]
    news = known.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in values])
    differs = reduce(
        lambda a, b: a | b, [F.coalesce(~F.col(f"_new_{c}").eqNullSafe(F.col(c)), F.lit(False)) & F.col(f"_new_{c}").isNotNull() for c in values]
    )
    changed = near.join(news, keys).where(differs)
    if layout is None or layout.folder not in target.columns:
        return None if changed.isEmpty() else refreshed(target, latest, keys, [table.id])
    folders = [row[0] for row in changed.select(layout.folder).distinct().collect()]  # one row per folder
    if not folders:
        return None
    inside = reduce(lambda a, b: a | b, [F.col(layout.folder).eqNullSafe(F.lit(f)) for f in folders])
    return refreshed(target.where(inside), latest, keys, [table.id])


def _merged(batch: DataFrame, target: DataFrame, keys: list[str], order_by: Sequence[str]) -> DataFrame:
    """Target rows brought up to date, then the keys it lacks; rows with a null key are kept as they are."""
    latest = latest_known(batch, keys, order_by)
    new = latest.join(target.select(*keys), keys, "left_anti")
    whole = refreshed(target, latest, keys).unionByName(new, allowMissingColumns=True)
    return whole.select(*target.columns)


def top_id(target: DataFrame, id_col: str) -> int:
    """The largest id in use, 0 for an empty table (one aggregate row reaches the driver)."""
    return target.agg(F.coalesce(F.max(id_col), F.lit(0))).first()[0]


def assign_keys(names: DataFrame, dim: DataFrame, name_col: str, id_col: str) -> DataFrame:
    """The dimension with an id for every name: known names keep theirs, new ones follow in name order.

    `names` may repeat; null and empty names are left out. Numbering is by
    parallel name ranges, so many new names need no one-task sort.
    """
    wanted = names.where(F.coalesce(name_col, F.lit("")) != "").select(name_col).distinct()
    new = wanted.join(dim.select(name_col), name_col, "left_anti")
    numbered = number_all(new, name_col, id_col, top_id(dim, id_col))
    return dim.select(id_col, name_col).unionByName(numbered.select(id_col, name_col))


def number_new(new: DataFrame, order: Sequence[str], id_col: str, start: int) -> DataFrame:
    """Ids start+1, start+2, ... for rows that are distinct by `order`, in that order."""
    keyed = new.withColumn("_order", F.struct(*order))
    return number_all(keyed, "_order", id_col, start).drop("_order")


def number_stored(new: DataFrame, id_col: str, start: int) -> DataFrame:
    """Gap-free ids in stored order, for large batches where any order will do.

    The batch is stored first with the place of each row, which fixes its order.
    """
    return counted_on(in_parts(new), id_col, start)


def resolve_keys(
    fact: DataFrame, dim: DataFrame, on: str, id_col: str, name_col: str | None = None, out: str | None = None
) -> DataFrame:
    """Replace a natural key of a fact by the dimension's id, null where it has none.

    A stored dimension is a plain exchange, so AQE splits hot names (or the null
    one) if the join is by shuffle and broadcasts by measured size otherwise.
    """
    pairs = dim.select(F.col(name_col or on).alias(on), F.col(id_col).alias(out or id_col))
    return fact.join(pairs, on, "left")


def split_rejects(df: DataFrame, valid: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that meet a condition and rows that do not (a null outcome is a reject)."""
    ok = F.coalesce(valid, F.lit(False))
    return df.where(ok), df.where(~ok)


def load_audit(outcomes: DataFrame) -> DataFrame:
    """Documents, records they bring to their table and texts cut to fit it, by feed and status."""
    totals = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("attempted", "overflowed")]
    return outcomes.groupBy("feed", "status").agg(F.count(F.lit(1)).alias("documents"), *totals)
