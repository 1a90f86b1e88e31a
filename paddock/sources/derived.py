"""Warehouse tables derived from a sales star schema (orders, line items, parts, ...).

An order is a race, a line item a runner, a part a horse and a supplier a
driver or trainer, so every plan runs on data that grows with the source.
Row-wise projections only, except the two that must drop repeats.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paddock.sources.warehouse import Tables, empty_table

FIRST_DAY = "1995-01-01"

# Order in which repeated line items compete for one (race, number) slot.
SLOT_ORDER = ["l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_quantity"]


# Known schemas spare a job per table that would only read file footers.
SOURCES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SOURCES[name]).parquet(f"{folder}/{name}.parquet")


PROGRAM_ID = f"cast(datediff(to_date(o_orderdate), date'{FIRST_DAY}') as bigint)"
MEETING_ID = f"{PROGRAM_ID} * 10 + o_custkey % 5 + 1"
RUNNER_ID = "l_orderkey * 100 + l_linenumber"
BET_ID = "l_orderkey * 10 + case l_returnflag when 'A' then 1 when 'N' then 2 else 3 end"


def _pick(index: str, *values: str) -> str:
    """SQL for the value at a zero-based position."""
    options = ", ".join(f"'{value}'" for value in values)
    return f"element_at(array({options}), cast({index} + 1 as int))"


def daily_program(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(f"{PROGRAM_ID} as program_id", "to_date(o_orderdate) as program_date").distinct()


def race_meeting(orders: DataFrame, nation: DataFrame) -> DataFrame:
    ids = orders.selectExpr(
        f"{MEETING_ID} as meeting_id",
        f"{PROGRAM_ID} as program_id",
        "cast(o_custkey % 5 + 1 as int) as meeting_number",
    ).distinct()
    tracks = nation.selectExpr("cast(n_nationkey as bigint) as _track", "substring(n_name, 1, 10) as _code")
    return ids.join(tracks, F.expr("meeting_id % 25 = _track"), "left").selectExpr(
        "meeting_id",
        "program_id",
        "meeting_number",
        "'TROT' as meeting_type",
        "case when meeting_id % 50 <> 3 then _code end as racetrack_code",
        "case when meeting_id % 4 <> 0 then cast(meeting_id % 37 as double) - 5 + 0.5D end as weather_temperature",
        f"case when meeting_id % 6 <> 0 then {_pick('meeting_id % 4', 'N', 'S', 'E', 'O')} end as weather_wind",
    )


def race(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "o_orderkey as race_id",
        f"{MEETING_ID} as meeting_id",
        "o_orderkey as race_number",
        "case substring(o_orderpriority, 1, 1) when '1' then 'ATTELE' when '2' then 'ATTELE' "
        "when '3' then 'MONTE' when '4' then 'PLAT' end as discipline",
        "o_orderpriority as race_category",
        "cast(case when o_orderkey % 13 <> 0 then o_orderkey % 20 * 100 + 1600 end as int) as distance_m",
        f"case when o_orderkey % 5 <> 4 then {_pick('o_orderkey % 5', 'S', 'P', 'H', 'C')} end as track_type",
        f"case when o_orderkey % 7 <> 6 then {_pick('o_orderkey % 3', 'BON', 'SOUPLE', 'LOURD')} end as terrain_label",
        "case when o_orderkey % 3 = 0 then 2.5D + o_orderkey % 9 * 0.25D end as penetrometer",
        "cast(case when o_orderkey % 11 <> 0 then o_custkey % 12 + 4 end as int) as declared_runners_count",
        "o_orderpriority as conditions_text",
        "case o_orderstatus when 'F' then 'FIN' when 'O' then 'FUT' else 'LIVE' end as race_status",
        "cast(case when o_orderstatus = 'F' then o_orderkey % 120 + 120 end as int) as race_duration_s",
        "o_orderstatus as race_status_category",
    )


def horse(part: DataFrame) -> DataFrame:
    return part.selectExpr(
        "p_partkey as horse_id",
        "concat(p_name, '#', p_partkey) as horse_name",
        f"case when p_size % 11 <> 0 then {_pick('p_size % 3', 'M', 'F', 'H')} end as sex",
        "case when p_size % 7 <> 0 then p_size % 12 + 1985 end as birth_year",
    )


def racing_actor(supplier: DataFrame) -> DataFrame:
    return supplier.selectExpr("s_suppkey as actor_id", "s_name as actor_name")


def lookup_shoeing(region: DataFrame) -> DataFrame:
    code = _pick("r_regionkey", "D4", "DP", "DA", "PA", "P4")
    return region.selectExpr("cast(r_regionkey + 1 as bigint) as shoeing_id", f"{code} as code")


def lookup_incident(region: DataFrame) -> DataFrame:
    code = _pick("r_regionkey", "DAI", "DPG", "NP", "ARR", "T")
    return region.selectExpr("cast(r_regionkey + 1 as bigint) as incident_id", f"{code} as code")


def runner_lines(lineitem: DataFrame) -> DataFrame:
    """Line items with one row per (order, line number): the smallest by SLOT_ORDER."""
    slot = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(*SLOT_ORDER)
    return lineitem.withColumn("_slot", F.row_number().over(slot)).where("_slot = 1").drop("_slot")


def race_participant(lines: DataFrame) -> DataFrame:
    return lines.selectExpr("*", "cast(l_quantity as int) as q").selectExpr(
        f"{RUNNER_ID} as participant_id",
        "l_orderkey as race_id",
        "l_partkey as horse_id",
        "l_linenumber as pmu_number",
        "case when q % 9 <> 0 then q % 8 + 2 end as age",
        f"case when l_partkey % 6 <> 5 then {_pick('l_partkey % 3', 'M', 'F', 'H')} end as sex",
        "l_suppkey + 1 as trainer_id",
        "case when l_linenumber <> 7 then l_suppkey end as driver_jockey_id",
        "case when l_partkey % 8 <> 7 then l_partkey % 5 + 1 end as shoeing_id",
        "case when l_returnflag = 'R' then l_partkey % 5 + 1 end as incident_id",
        "q % 12 as career_races_count",
        "case when l_discount <> 0 then l_extendedprice end as career_winnings",
        "case when l_tax <> 0 then l_quantity * 0.5D + 1 end as reference_odds",
        "case when q % 10 <> 0 then l_quantity * 0.25D + 1 end as live_odds",
        "concat(l_returnflag, l_linestatus) as raw_performance_string",
        "cast(case when l_returnflag <> 'R' then greatest(1, q div 8 + l_partkey % 3) end as int) as finish_rank",
        "case when l_returnflag <> 'R' then q + 60 end as time_achieved_s",
        "l_tax + 1.1D as reduction_km",
        "case when l_linenumber % 2 = 0 then 'CONFIANT' end as trainer_advice",
    )


def horse_race_history(lineitem: DataFrame) -> DataFrame:
    """Every line is a past race. Those of each tenth part count for the next one, so some horses have none."""
    return lineitem.selectExpr(
        f"{RUNNER_ID} as history_id",
        "l_partkey + if(l_partkey % 10 = 0, 1, 0) as horse_id",
        "to_date(l_shipdate) as race_date",
        "if(l_linestatus = 'F', 'ATTELE', 'MONTE') as discipline",
        "l_extendedprice as prize_money",
        "cast(l_suppkey % 15 * 100 + 1600 as int) as distance_m",
        "cast(l_quantity + 60 as int) as first_place_time_s",
        "case when l_returnflag <> 'A' then l_linenumber end as finish_place",
        "l_returnflag as finish_status",
        "60.0D as jockey_weight",
        "l_linenumber as draw_number",
        "case when l_returnflag <> 'R' then l_tax + 1.1D end as reduction_km",
        "2700 as distance_traveled_m",
    )


def race_bet(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(
        f"{BET_ID} as bet_id",
        "l_orderkey as race_id",
        "case l_returnflag when 'A' then 'SG' when 'N' then 'SP' else 'TRIO' end as bet_type",
        "'MUTUEL' as bet_family",
        "1.5D as base_stake",
        "l_returnflag = 'R' as is_refunded",
    ).distinct()


def bet_report(lines: DataFrame) -> DataFrame:
    return lines.selectExpr(
        f"{RUNNER_ID} as report_id",
        f"{BET_ID} as bet_id",
        "cast(l_linenumber as string) as combination",
        "l_extendedprice / 100 as dividend",
        "l_extendedprice / 200 as dividend_per_1e",
        "l_quantity as winners_count",
    )


def stand_in_probability() -> Column:
    """A fixed win probability per runner, for decision plans run without a model."""
    return (F.col("horse_id") * 7 + F.col("program_number") * 13) % 100 / F.lit(200.0)


class DerivedTables(dict[str, DataFrame]):
    """The warehouse tables as views over the source folder, each built when first asked for."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        super().__init__()
        self._spark, self._folder = spark, folder

    def _source(self, name: str) -> DataFrame:
        return source(self._spark, self._folder, name)

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._build(name)
        return self[name]

    def _build(self, name: str) -> DataFrame:
        get = self._source
        match name:
            case "daily_program":
                return daily_program(get("orders"))
            case "race_meeting":
                return race_meeting(get("orders"), get("nation"))
            case "race":
                return race(get("orders"))
            case "horse":
                return horse(get("part"))
            case "racing_actor":
                return racing_actor(get("supplier"))
            case "lookup_shoeing":
                return lookup_shoeing(get("region"))
            case "lookup_incident":
                return lookup_incident(get("region"))
            case "race_participant":
                return race_participant(runner_lines(get("lineitem")))
            case "horse_race_history":
                return horse_race_history(get("lineitem"))
            case "race_bet":
                return race_bet(get("lineitem"))
            case "bet_report":
                return bet_report(runner_lines(get("lineitem")))
            case _:
                return empty_table(self._spark, name)


def derived_tables(spark: SparkSession, folder: str) -> Tables:
    return DerivedTables(spark, folder)
