"""Constraint checks; each returns the violations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.schemas import SMALL_MAX, SMALL_MIN, TABLES, Table
from paddock.sources.warehouse import Tables


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; keys with a null are exempt."""
    return (
        df.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where("occurrences > 1")
    )


def check_fk(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose key has no parent; a null key is exempt."""
    parents = parent.select(F.col(pk).alias(fk))
    return child.where(F.col(fk).isNotNull()).join(parents, fk, "left_anti")


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per required column with its number of nulls, where there are any."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "nulls").where("nulls > 0")


def out_of_range(widths: dict[str, int], small: Sequence[str]) -> Column:
    """Whether a row has a text too long or a number beyond 16 bits."""
    tests = [F.length(column) > width for column, width in widths.items()]
    tests += [~F.col(column).between(SMALL_MIN, SMALL_MAX) for column in small]
    return reduce(lambda a, b: a | b, [F.coalesce(test, F.lit(False)) for test in tests], F.lit(False))


def check_range(df: DataFrame, widths: dict[str, int] | None = None, small: Sequence[str] = ()) -> DataFrame:
    """Rows with a text too long or a number beyond 16 bits."""
    return df.where(out_of_range(widths or {}, small))


def _row_rules(df: DataFrame, table: Table) -> dict[tuple[str, str], Column]:
    """The rules of a table that one row can break, by (rule, columns)."""
    rules = {("not null", c): F.col(c).isNull() for c in table.required}
    if table.widths or table.small:
        columns = ",".join([*table.widths, *table.small])
        rules["range", columns] = out_of_range(table.widths, table.small)
    return rules


def _joined(columns: Sequence[str]) -> Column:
    """One text for the values of several columns that tells all combinations apart."""
    texts = [F.col(c).cast("string") for c in columns]
    return F.concat(*[F.concat(F.length(t).cast("string"), F.lit(":"), t) for t in texts])


def violations(tables: Tables) -> DataFrame:
    """Number of violations of every declared rule that has any: table, rule, columns, rows.

    Each table is scanned once. A row is turned into marks (domain, key, slot): its key in the domain of its
    table's unique keys, the parents it names in the domains of their ids, its own id as a known one there (slot
    -1), and each rule of its own that it breaks. One aggregate over domain and key, combined in the map tasks,
    then tells repeated keys, keys without a parent and broken rules. Domains are numbered, since every mark carries one.
    """
    spark = tables["daily_program"].sparkSession
    rules: list[tuple[str, int, str, str, str]] = []  # domain, slot, table, rule, columns
    parents = {target for table in TABLES.values() for target in table.foreign.values()}
    used: dict[str, int] = {}
    numbers: dict[str, int] = {}

    def mark(domain: str, key: Column, slot: int, where: Column) -> Column:
        number = numbers.setdefault(domain, len(numbers))
        fields = (F.lit(number).alias("domain"), key.alias("key"), F.lit(slot).alias("slot"))
        return F.when(where, F.struct(*fields))

    def declared(domain: str, table: str, rule: str, columns: str) -> int:
        slot = used[domain] = used.get(domain, -1) + 1
        rules.append((domain, slot, table, rule, columns))
        return slot

    marked: list[DataFrame] = []
    for name, table in TABLES.items():
        df, marks = tables[name], []
        if table.key:
            slot = declared(f"unique {name}", name, "unique", ",".join(table.key))
            whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in table.key])
            marks.append(mark(f"unique {name}", _joined(table.key), slot, whole))
        for fk, (parent, pk) in table.foreign.items():
            slot = declared(f"id {parent}.{pk}", name, "foreign", fk)
            marks.append(mark(f"id {parent}.{pk}", F.col(fk).cast("string"), slot, F.col(fk).isNotNull()))
        if (name, table.id) in parents:
            marks.append(mark(f"id {name}.{table.id}", F.col(table.id).cast("string"), -1, F.col(table.id).isNotNull()))
        for (rule, columns), bad in _row_rules(df, table).items():
            domain = f"row {name} {rule} {columns}"
            marks.append(mark(domain, F.lit(""), declared(domain, name, rule, columns), bad))
        if marks:
            # Nulls go after the outer explode: a lambda over the marks is not compiled, and a plain explode adds a size
            # check below it, which would make all marks a second time.
            marked.append(df.select(F.explode_outer(F.array(*marks)).alias("mark")).where("mark is not null").select("mark.*"))
    slots = range(max(slot for _, slot, *_ in rules) + 1)
    counts = [F.count_if(F.col("slot") == slot).alias(f"n{slot}") for slot in slots]
    keys = reduce(DataFrame.unionByName, marked).groupBy("domain", "key").agg(F.max(F.col("slot") == -1).alias("known"), *counts)

    def of_kind(kind: str) -> Column:
        return F.col("domain").isin(*[number for domain, number in numbers.items() if domain.split()[0] == kind])

    def broken(n: str) -> Column:
        repeated = F.sum(F.when(F.col(n) > 1, 1).otherwise(0))
        orphans = F.sum(F.when(~F.col("known"), F.col(n)).otherwise(0))
        return F.when(of_kind("unique"), repeated).when(of_kind("id"), orphans).otherwise(F.sum(n)).cast("long")

    totals = keys.groupBy("domain").agg(F.array(*[broken(f"n{slot}") for slot in slots]).alias("rows"))
    listed = totals.select("domain", F.posexplode("rows").alias("slot", "rows")).where("rows > 0")
    named = [(numbers[domain], *rest) for domain, *rest in rules]
    names = spark.createDataFrame(named, "domain int, slot int, table string, rule string, columns string")
    return listed.join(F.broadcast(names), ["domain", "slot"]).select("table", "rule", "columns", "rows")
