"""The twelve warehouse tables: columns, natural keys, foreign keys, limits."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Table:
    """One warehouse table and the rules its rows must keep."""

    ddl: str
    id: str
    key: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    foreign: dict[str, tuple[str, str]] = field(default_factory=dict)
    widths: dict[str, int] = field(default_factory=dict)
    small: tuple[str, ...] = ()

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


SMALL_MIN, SMALL_MAX = -32768, 32767

TABLES: dict[str, Table] = {
    "daily_program": Table(
        ddl="program_id bigint, program_date date",
        id="program_id",
        key=("program_date",),
    ),
    "race_meeting": Table(
        ddl="meeting_id bigint, program_id bigint, meeting_number int, meeting_type string, "
        "racetrack_code string, weather_temperature double, weather_wind string",
        id="meeting_id",
        key=("program_id", "meeting_number"),
        required=("program_id", "meeting_number"),
        foreign={"program_id": ("daily_program", "program_id")},
        widths={"meeting_type": 30, "racetrack_code": 10, "weather_wind": 30},
        small=("meeting_number",),
    ),
    "race": Table(
        ddl="race_id bigint, meeting_id bigint, race_number bigint, discipline string, "
        "race_category string, distance_m int, track_type string, terrain_label string, "
        "penetrometer double, declared_runners_count int, conditions_text string, "
        "race_status string, race_duration_s int, race_status_category string",
        id="race_id",
        key=("meeting_id", "race_number"),
        required=("meeting_id", "race_number"),
        foreign={"meeting_id": ("race_meeting", "meeting_id")},
        widths={
            "discipline": 10,
            "race_category": 50,
            "track_type": 5,
            "terrain_label": 30,
            "race_status": 10,
            "race_status_category": 30,
        },
        small=("race_number", "distance_m", "declared_runners_count"),
    ),
    "horse": Table(
        ddl="horse_id bigint, horse_name string, sex string, birth_year int",
        id="horse_id",
        key=("horse_name",),
        required=("horse_name",),
        widths={"horse_name": 100, "sex": 1},
        small=("birth_year",),
    ),
    "racing_actor": Table(
        ddl="actor_id bigint, actor_name string",
        id="actor_id",
        key=("actor_name",),
        required=("actor_name",),
        widths={"actor_name": 100},
    ),
    "lookup_shoeing": Table(
        ddl="shoeing_id bigint, code string",
        id="shoeing_id",
        key=("code",),
        widths={"code": 10},
    ),
    "lookup_incident": Table(
        ddl="incident_id bigint, code string",
        id="incident_id",
        key=("code",),
        widths={"code": 30},
    ),
    "race_participant": Table(
        ddl="participant_id bigint, race_id bigint, horse_id bigint, pmu_number int, age int, "
        "sex string, trainer_id bigint, driver_jockey_id bigint, shoeing_id bigint, "
        "incident_id bigint, career_races_count int, career_winnings double, "
        "reference_odds double, live_odds double, raw_performance_string string, "
        "finish_rank int, time_achieved_s int, reduction_km double, trainer_advice string",
        id="participant_id",
        key=("race_id", "pmu_number"),
        required=("race_id", "horse_id", "pmu_number"),
        foreign={
            "race_id": ("race", "race_id"),
            "horse_id": ("horse", "horse_id"),
            "trainer_id": ("racing_actor", "actor_id"),
            "driver_jockey_id": ("racing_actor", "actor_id"),
            "shoeing_id": ("lookup_shoeing", "shoeing_id"),
            "incident_id": ("lookup_incident", "incident_id"),
        },
        widths={"sex": 1, "raw_performance_string": 255, "trainer_advice": 30},
        small=("pmu_number", "age", "career_races_count", "finish_rank"),
    ),
    "horse_race_history": Table(
        ddl="history_id bigint, horse_id bigint, race_date date, discipline string, "
        "prize_money double, distance_m int, first_place_time_s int, finish_place int, "
        "finish_status string, jockey_weight double, draw_number int, reduction_km double, "
        "distance_traveled_m int",
        id="history_id",
        key=("horse_id", "race_date", "discipline", "distance_m"),
        required=("horse_id",),
        foreign={"horse_id": ("horse", "horse_id")},
        widths={"discipline": 20, "finish_status": 20},
        small=("distance_m", "finish_place", "draw_number", "distance_traveled_m"),
    ),
    "race_bet": Table(
        ddl="bet_id bigint, race_id bigint, bet_type string, bet_family string, "
        "base_stake double, is_refunded boolean",
        id="bet_id",
        key=("race_id", "bet_type"),
        required=("race_id",),
        foreign={"race_id": ("race", "race_id")},
        widths={"bet_type": 10, "bet_family": 20},
    ),
    "bet_report": Table(
        ddl="report_id bigint, bet_id bigint, combination string, dividend double, "
        "dividend_per_1e double, winners_count double",
        id="report_id",
        key=("bet_id", "combination"),
        required=("bet_id",),
        foreign={"bet_id": ("race_bet", "bet_id")},
        widths={"combination": 50},
    ),
    "prediction": Table(
        ddl="prediction_id bigint, participant_id bigint, model_version string, "
        "proba_winner double, proba_top3_place double, created_at timestamp",
        id="prediction_id",
        required=("participant_id",),
        foreign={"participant_id": ("race_participant", "participant_id")},
        widths={"model_version": 20},
    ),
}

# Documents that loads have handled, by what they held; kept beside the tables.
LEDGER = "document_ledger"
DOCUMENT_LEDGER = Table(
    ddl="landed date, feed string, date_code string, meeting int, race int, mode string, digest string",
    id="digest",
    key=("landed",),
)
