"""Warehouse tables kept as Parquet folders under a manifest.

A commit writes new folders, then one manifest file that names all live folders of all tables, put
in place by a rename. Readers open the latest manifest, so they see a commit whole or not at all; what
a lost run has written is in no manifest and never read. The manifest holds, for each folder, its rows
and the least and largest value of the key columns, which tell a scoped read what to open.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType

from paddock.schemas import DOCUMENT_LEDGER, LEDGER, TABLES, Table
from paddock.session import shuffles_dropped

Tables = dict[str, DataFrame]
Range = tuple[int, int]

# Ids per folder of a table laid out by an id; a horse brings many rows of history.
BAND = 1_000_000
HORSES = 50_000

MANIFESTS = "_manifests"
EPOCH = dt.date(1970, 1, 1)


@dataclass(frozen=True)
class Layout:
    """Folders of a table: the name of the folder column, the id it is derived from, and ids in a folder.

    Races and horses are numbered as they come, so a day's rows share few bands of ids.
    """

    folder: str
    column: str
    width: int = BAND

    def of(self, value: Column) -> Column:
        """The folder of an id; rows without the id share one."""
        return F.floor(value / self.width).cast("int")


LAYOUTS: dict[str, Layout] = {
    "horse_race_history": Layout("history_band", "horse_id", HORSES),
    "race": Layout("race_band", "race_id"),
    "horse": Layout("horse_band", "horse_id"),
    "race_participant": Layout("runner_band", "race_id"),
    "race_bet": Layout("bet_band", "race_id"),
    "bet_report": Layout("report_band", "bet_id"),
}


def _table(name: str) -> Table:
    return DOCUMENT_LEDGER if name == LEDGER else TABLES[name]


def ranged(name: str) -> list[str]:
    """Columns of a table whose range in each folder the manifest holds: its id and the ids and days of its key."""
    table = _table(name)
    wanted = {table.id, *table.key, LAYOUTS[name].column if name in LAYOUTS else table.id}
    return [f.name for f in table.schema.fields if f.name in wanted and isinstance(f.dataType, LongType | DateType)]


def _number(column: str, kind) -> Column:
    """Dates count as days, so that a manifest holds whole numbers only."""
    return F.unix_date(column).cast("long") if isinstance(kind, DateType) else F.col(column)


@dataclass(frozen=True)
class Part:
    """One live folder: its path below the table, its value of the folder column, rows, and ranges by column."""

    path: str
    folder: int | None
    rows: int
    ranges: dict[str, Range]

    def may_hold(self, column: str, ranges: Sequence[Range]) -> bool:
        own = self.ranges.get(column)
        return own is not None and any(low <= own[1] and own[0] <= high for low, high in ranges)


@dataclass(frozen=True)
class Manifest:
    """All live folders by table, and the notes of the commits that made them."""

    number: int = 0
    parts: dict[str, list[Part]] = field(default_factory=dict)
    notes: list[dict] = field(default_factory=list)

    def to_json(self) -> str:
        return json.dumps({"number": self.number, "notes": self.notes, "parts": {n: [vars(p) for p in ps] for n, ps in self.parts.items()}})

    @staticmethod
    def from_json(text: str) -> Manifest:
        data = json.loads(text)
        parts = {
            name: [Part(p["path"], p["folder"], p["rows"], {c: tuple(r) for c, r in p["ranges"].items()}) for p in some]
            for name, some in data["parts"].items()
        }
        return Manifest(data["number"], parts, data["notes"])

    def done(self, run: str, stage: str) -> dict | None:
        """The note of a stage that a named run has committed."""
        return next((n for n in self.notes if n.get("run") == run and n.get("stage") == stage), None)


class LostRace(RuntimeError):
    """Another run has committed first; nothing of this commit is visible."""


def _store(spark: SparkSession, root: str):
    """The file system of a folder and a function from names below it to its paths."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(root).getFileSystem(spark._jsc.hadoopConfiguration()), lambda *names: path("/".join([root, *names]))


def latest(spark: SparkSession, root: str) -> Manifest:
    """The manifest in force; an empty one where nothing has been committed."""
    files, at = _store(spark, root)
    if not files.exists(at(MANIFESTS)):
        return Manifest()
    names = [s.getPath().getName() for s in files.listStatus(at(MANIFESTS))]
    numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]
    if not numbers:
        return Manifest()
    stream = files.open(at(MANIFESTS, f"{max(numbers):012d}.json"))
    try:
        return Manifest.from_json(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _put(spark: SparkSession, root: str, manifest: Manifest) -> None:
    """Write a manifest aside and rename it into place, which fails if its number is taken."""
    files, at = _store(spark, root)
    aside, place = at(MANIFESTS, f"{uuid.uuid4().hex}.new"), at(MANIFESTS, f"{manifest.number:012d}.json")
    stream = files.create(aside, False)
    try:
        stream.write(bytearray(manifest.to_json(), "utf-8"))
    finally:
        stream.close()
    if files.exists(place) or not files.rename(aside, place):
        files.delete(aside, False)
        raise LostRace(f"commit {manifest.number} of {root} is taken")


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    """A warehouse table with no rows."""
    return spark.createDataFrame([], TABLES[name].schema)


def empty_warehouse(spark: SparkSession) -> Tables:
    return {name: empty_table(spark, name) for name in TABLES}


def _schema(name: str):
    schema = _table(name).schema
    return schema.add(LAYOUTS[name].folder, "integer") if name in LAYOUTS else schema


def scan(spark: SparkSession, root: str, name: str, parts: Sequence[Part], columns: Sequence[str] | None = None) -> DataFrame:
    """The rows of some folders of a table, with its fixed schema; a table with folders shows them as a last column."""
    schema = _schema(name)
    if not parts:
        df = spark.createDataFrame([], schema)
    else:
        paths = [f"{root}/{name}/{part.path}" for part in parts]
        df = spark.read.schema(schema).option("basePath", f"{root}/{name}").parquet(*paths).select(*schema.fieldNames())
    return df.select(*columns) if columns else df


class StoredTables(dict[str, DataFrame]):
    """The tables of a stored warehouse, as of the manifest that was in force when they were opened."""

    def __init__(self, spark: SparkSession, root: str, manifest: Manifest):
        super().__init__()
        self.spark, self.root, self.manifest = spark, root, manifest
        for name in TABLES:
            self[name] = scan(spark, root, name, self.parts(name))

    def parts(self, name: str) -> list[Part]:
        return self.manifest.parts.get(name, [])

    def top(self, name: str, column: str) -> int:
        """The largest id in use, known without reading the table."""
        return max((p.ranges[column][1] for p in self.parts(name) if column in p.ranges), default=0)

    def ledger(self, low: int, high: int) -> DataFrame:
        """Documents of some days, as days since 1970, that loads have handled; those without a day always."""
        dated = [p for p in self.parts(LEDGER) if "landed" not in p.ranges or p.may_hold("landed", [(low, high)])]
        return scan(self.spark, self.root, LEDGER, dated)

    def within(self, name: str, column: str, ranges: Sequence[Range]) -> DataFrame:
        """Rows whose id lies in one of the ranges, read from the folders that can hold them."""
        return self._picked(name, [p for p in self.parts(name) if p.may_hold(column, ranges)], F.col(column), ranges)

    def in_days(self, name: str, column: str, low: int, high: int) -> DataFrame:
        """Rows whose date lies between two days, given as days since 1970."""
        parts = [p for p in self.parts(name) if p.may_hold(column, [(low, high)])]
        return self._picked(name, parts, F.unix_date(column), [(low, high)])

    def in_folders(self, name: str, folders: Sequence[int]) -> DataFrame:
        """All rows of the folders with these values."""
        wanted = set(folders)
        return self._picked(name, [p for p in self.parts(name) if p.folder in wanted], None, [])

    def _picked(self, name: str, parts: list[Part], value: Column | None, ranges: Sequence[Range]) -> DataFrame:
        df = scan(self.spark, self.root, name, parts)
        if name in LAYOUTS and parts:
            df = df.where(F.col(LAYOUTS[name].folder).isin(*sorted({p.folder for p in parts if p.folder is not None})))
        if value is None:
            return df
        return df.where(in_ranges(value, ranges))


def merged(ranges: Sequence[Range], most: int = 200) -> list[Range]:
    """The ranges in order, those that touch as one; beyond `most`, the nearest ones are joined, gaps included."""
    found: list[Range] = []
    for low, high in sorted(ranges):
        if found and low <= found[-1][1] + 1:
            found[-1] = (found[-1][0], max(found[-1][1], high))
        else:
            found.append((low, high))
    if len(found) > most:
        gaps = sorted(range(1, len(found)), key=lambda i: found[i][0] - found[i - 1][1])
        apart = set(gaps[len(found) - most :])
        wide = [found[0]]
        for i in range(1, len(found)):
            wide[-1:] = [wide[-1], found[i]] if i in apart else [(wide[-1][0], found[i][1])]
        found = wide
    return found


def in_ranges(value: Column, ranges: Sequence[Range]) -> Column:
    """Whether a number lies in one of the ranges, found by halving, so a row meets few of many ranges.

    The outer bounds stand beside the search, since only plain comparisons reach file statistics.
    """
    found = merged(ranges, max(1, len(ranges)))
    if not found:
        return F.lit(False)

    def search(some: list[Range]) -> Column:
        if len(some) <= 2:
            return reduce(or_, [value.between(low, high) for low, high in some])
        half = len(some) // 2
        return F.when(value < some[half][0], search(some[:half])).otherwise(search(some[half:]))

    inside = search(found)
    return inside if len(found) <= 2 else value.between(found[0][0], found[-1][1]) & inside


def near(tables: Mapping[str, DataFrame], name: str, column: str, batch: DataFrame) -> DataFrame:
    """The rows of a table that can share a key with a batch that has the same column.

    Of a stored table laid out by this column, the folders that the batch falls into, as a list; else the folders
    and rows in the batch's range. It costs one pass over the batch's column, but for a table without rows, which is
    known at once.
    """
    if not tables.parts(name) if isinstance(tables, StoredTables) else tables[name].isEmpty():
        return tables[name]
    layout = LAYOUTS.get(name)
    if isinstance(tables, StoredTables) and layout is not None and layout.column == column:
        folders = batch.where(F.col(column).isNotNull()).select(layout.of(F.col(column))).distinct()
        return tables.in_folders(name, [row[0] for row in folders.collect()])  # one row for each folder at most
    low, high = batch.agg(F.min(column), F.max(column)).first()
    if low is None:
        return tables[name].where(F.lit(False))
    if not isinstance(tables, StoredTables):
        return tables[name].where(F.col(column).between(low, high))
    if isinstance(TABLES[name].schema[column].dataType, DateType):
        low, high = ((day - EPOCH).days for day in (low, high))
        return tables.in_days(name, column, low, high)
    return tables.within(name, column, [(low, high)])


def open_warehouse(spark: SparkSession, root: str) -> StoredTables:
    return StoredTables(spark, root, latest(spark, root))


def create_warehouse(spark: SparkSession, root: str) -> None:
    """An empty warehouse where none is; an existing one stays."""
    files, at = _store(spark, root)
    files.mkdirs(at(MANIFESTS))


def _written(spark: SparkSession, root: str, name: str, rows: DataFrame, version: str) -> tuple[list[Part], int]:
    """Write rows as folders of a version of their own; the folders and how many rows they hold."""
    path, layout, rows = f"{root}/{name}/version={version}", LAYOUTS.get(name), rows.select(*_table(name).columns)
    with shuffles_dropped(spark):
        if layout is None:
            rows.write.parquet(path)
        else:
            # A folder's rows are brought together first, or each task would write a file for each folder; a large folder is
            # split by its measured size.
            placed = rows.withColumn(layout.folder, layout.of(F.col(layout.column))).hint("rebalance", layout.folder)
            placed.write.partitionBy(layout.folder).parquet(path)
    schema = _schema(name)
    stored = spark.read.schema(schema).parquet(path)
    columns = ranged(name)
    kinds = {f.name: f.dataType for f in schema.fields}
    bounds = [f(_number(c, kinds[c])).alias(f"{f.__name__}_{c}") for c in columns for f in (F.min, F.max)]
    folder = F.lit(None).cast("int") if layout is None else F.col(layout.folder)
    parts = []
    # Only the key columns are read back; one row for each folder written. A table without rows has no folder.
    for row in stored.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("rows"), *bounds).collect():
        value = "__HIVE_DEFAULT_PARTITION__" if row["folder"] is None else row["folder"]
        place = f"version={version}" + ("" if layout is None else f"/{layout.folder}={value}")
        ranges = {c: (row[f"min_{c}"], row[f"max_{c}"]) for c in columns if row[f"min_{c}"] is not None}
        parts.append(Part(place, row["folder"], row["rows"], ranges))
    return parts, sum(part.rows for part in parts)


def publish(
    spark: SparkSession,
    root: str,
    new: Mapping[str, DataFrame],
    again: Mapping[str, DataFrame] | None = None,
    note: dict | None = None,
    base: Manifest | None = None,
) -> dict[str, int]:
    """Commit new rows by table, and whole folders written again, at once; returns the new rows of each table.

    `again` replaces the folders its rows belong to; of a table without folders, all of it. The rows may be
    read from the very tables, as no file of theirs is touched. `base` is the manifest the rows were made
    from; if another commit came between, LostRace is raised and nothing changes.
    """
    base = latest(spark, root) if base is None else base
    version, parts, counts = uuid.uuid4().hex, {n: list(p) for n, p in base.parts.items()}, {}
    for name, rows in (again or {}).items():
        written, _ = _written(spark, root, name, rows, f"{version}a")
        folders = {p.folder for p in written}
        parts[name] = [p for p in parts.get(name, []) if p.folder not in folders] + written
    for name, rows in new.items():
        written, counts[name] = _written(spark, root, name, rows, version)
        parts[name] = parts.get(name, []) + written
    notes = base.notes if note is None else [*base.notes, {**note, "rows": counts}]
    _put(spark, root, Manifest(base.number + 1, parts, notes))
    return counts


def append(df: DataFrame, root: str, name: str) -> None:
    """Append rows to one table."""
    publish(df.sparkSession, root, {name: df})


def replace(df: DataFrame, root: str, name: str) -> None:
    """Replace the folders that the rows belong to; of a table without folders, all of it."""
    publish(df.sparkSession, root, {}, {name: df})
