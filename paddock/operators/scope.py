"""Which days and races a run covers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.functions.codes import TROT
from paddock.functions.parsing import DATE_CODE
from paddock.operators.filters import filter_date, filter_disciplines, filter_race
from paddock.operators.joins import race_context
from paddock.sources.warehouse import LAYOUTS, Range, StoredTables, Tables, in_ranges, merged


def _day(code: str) -> dt.date:
    if len(code) != len(DATE_CODE):
        raise ValueError(f"not a DDMMYYYY date: {code}")
    return dt.datetime.strptime(code, "%d%m%Y").date()


def date_scope(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Every day from start to end inclusive, one row each; bad or reversed bounds are an error."""
    first, last = _day(start), _day(end)
    if first > last:
        raise ValueError("start is after end")
    days = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("program_date")).select(
        "program_date", F.date_format("program_date", DATE_CODE).alias("date_code")
    )


def rolling_scope(day: str | dt.date, n: int = 3) -> list[str]:
    """Date codes of a day and the n-1 before it, for feeds that arrive late."""
    last = _day(day) if isinstance(day, str) else day
    return [(last - dt.timedelta(days=back)).strftime("%d%m%Y") for back in range(n - 1, -1, -1)]


def in_rolling_scope(column: str, day: Column, n: int = 3) -> Column:
    """The same window as a predicate, which prunes and pushes down."""
    return F.col(column).between(F.date_sub(day, n - 1), day)


class ScopedTables(dict[str, DataFrame]):
    """A stored warehouse as seen from some days or races: each table without the folders that cannot matter.

    Tables may keep rows of other days and races; the callers' own filters and joins decide. What is fetched
    to prune by is one range for each day or race asked for, and the folders that hold its horses.
    """

    def __init__(self, tables: StoredTables, days: DataFrame, meetings: DataFrame, races: DataFrame, spans: list[Range]):
        super().__init__(daily_program=days, race_meeting=meetings, race=races)
        self._tables, self._spans = tables, spans

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._narrowed(name)
        return self[name]

    def __contains__(self, name: object) -> bool:
        return name in self._tables

    def _narrowed(self, name: str) -> DataFrame:
        if name in ("race_participant", "race_bet"):
            return self._tables.within(name, "race_id", self._spans)
        if name in ("horse", "horse_race_history"):
            layout = LAYOUTS[name]
            horses = filter_spans(self["race_participant"], "race_id", self._spans)
            folders = horses.where("horse_id IS NOT NULL").select(layout.of(F.col("horse_id"))).distinct().collect()
            return self._tables.in_folders(name, [row[0] for row in folders])
        if name == "bet_report":
            folders = self["race_bet"].select(LAYOUTS[name].of(F.col("bet_id"))).distinct().collect()
            return self._tables.in_folders(name, [row[0] for row in folders])
        return self._tables[name]


def filter_spans(df: DataFrame, column: str, spans: Sequence[Range]) -> DataFrame:
    return df.where(in_ranges(F.col(column), spans))


def _spans(df: DataFrame, by: str, column: str) -> list[Range]:
    """The range of a column for each value of another, of which there are few."""
    rows = df.groupBy(by).agg(F.min(column).alias("low"), F.max(column).alias("high")).where("low IS NOT NULL").collect()
    return merged([(row["low"], row["high"]) for row in rows])


def scoped(tables: Tables, dates: Sequence[str] | None = None, races: Sequence[int] | None = None) -> Tables:
    """The tables as needed for some days or races; tables that are not stored are returned as they are."""
    if not isinstance(tables, StoredTables) or (dates is None and races is None):
        return tables
    programs = tables["daily_program"]
    if races is not None:
        found = tables.within("race", "race_id", merged([(r, r) for r in races]))
        chosen = filter_race(found, races)
        # At most one meeting for each race asked for, and one day for each meeting.
        ids = [row[0] for row in chosen.select("meeting_id").distinct().collect()]
        meetings = tables.within("race_meeting", "meeting_id", merged([(i, i) for i in ids]))
        ids = [row[0] for row in meetings.select("program_id").distinct().collect()]
        days = tables.within("daily_program", "program_id", merged([(i, i) for i in ids]))
        return ScopedTables(tables, days, meetings, found, merged([(r, r) for r in races]))
    days = filter_date(programs, dates)
    ids = [row["program_id"] for row in days.select("program_id").collect()]  # one for each day asked for
    meetings = tables.within("race_meeting", "program_id", merged([(i, i) for i in ids]))
    found = tables.within("race", "meeting_id", _spans(meetings, "program_id", "meeting_id"))
    dated = found.join(meetings.select("meeting_id", "program_id"), "meeting_id")
    return ScopedTables(tables, days, meetings, found, _spans(dated, "program_id", "race_id"))


def work_list(
    tables: Tables, dates: Sequence[str] | None = None, disciplines: Sequence[str] | None = TROT
) -> DataFrame:
    """Races for which child documents are to be loaded; `disciplines=None` takes all."""
    races = race_context(scoped(tables, dates), dates)
    races = races if disciplines is None else filter_disciplines(races, disciplines)
    return races.select("program_date", "race_id", "meeting_number", "race_number")
