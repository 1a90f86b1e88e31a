"""DuckDB views of the derived warehouse tables, as common table expressions."""

from __future__ import annotations

VIEWS: dict[str, str] = {
    "lines": """
        SELECT * EXCLUDE (slot) FROM (
          SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity) AS slot
          FROM lineitem) WHERE slot = 1""",
    "daily_program": """
        SELECT DISTINCT CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS program_id,
          CAST(o_orderdate AS DATE) AS program_date FROM orders""",
    "race_meeting": """
        SELECT meeting_id, program_id, meeting_number, 'TROT' AS meeting_type,
          CASE WHEN meeting_id % 50 <> 3 THEN substr(n_name, 1, 10) END AS racetrack_code,
          CASE WHEN meeting_id % 4 <> 0 THEN CAST(meeting_id % 37 AS DOUBLE) - 5 + 0.5 END AS weather_temperature,
          CASE WHEN meeting_id % 6 <> 0 THEN ['N','S','E','O'][meeting_id % 4 + 1] END AS weather_wind
        FROM (SELECT DISTINCT
            date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) * 10 + o_custkey % 5 + 1 AS meeting_id,
            date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS program_id,
            CAST(o_custkey % 5 + 1 AS INTEGER) AS meeting_number FROM orders)
        LEFT JOIN nation ON n_nationkey = meeting_id % 25""",
    "race": """
        SELECT o_orderkey AS race_id,
          date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) * 10 + o_custkey % 5 + 1 AS meeting_id,
          o_orderkey AS race_number,
          CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'ATTELE' WHEN '2' THEN 'ATTELE'
            WHEN '3' THEN 'MONTE' WHEN '4' THEN 'PLAT' END AS discipline,
          o_orderpriority AS race_category,
          CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderkey % 20 * 100 + 1600 AS INTEGER) END AS distance_m,
          CASE WHEN o_orderkey % 5 <> 4 THEN ['S','P','H','C'][o_orderkey % 5 + 1] END AS track_type,
          CASE WHEN o_orderkey % 7 <> 6 THEN ['BON','SOUPLE','LOURD'][o_orderkey % 3 + 1] END AS terrain_label,
          CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_custkey % 12 + 4 AS INTEGER) END AS declared_runners_count
        FROM orders""",
    "horse": """
        SELECT p_partkey AS horse_id, p_name || '#' || p_partkey AS horse_name,
          CASE WHEN p_size % 11 <> 0 THEN ['M','F','H'][p_size % 3 + 1] END AS sex,
          CASE WHEN p_size % 7 <> 0 THEN p_size % 12 + 1985 END AS birth_year FROM part""",
    "racing_actor": "SELECT s_suppkey AS actor_id, s_name AS actor_name FROM supplier",
    "lookup_shoeing": """
        SELECT CAST(r_regionkey + 1 AS BIGINT) AS shoeing_id, ['D4','DP','DA','PA','P4'][r_regionkey + 1] AS code
        FROM region""",
    "lookup_incident": """
        SELECT CAST(r_regionkey + 1 AS BIGINT) AS incident_id, ['DAI','DPG','NP','ARR','T'][r_regionkey + 1] AS code
        FROM region""",
    "race_participant": """
        SELECT l_orderkey * 100 + l_linenumber AS participant_id, l_orderkey AS race_id, l_partkey AS horse_id,
          l_linenumber AS pmu_number,
          CASE WHEN q % 9 <> 0 THEN q % 8 + 2 END AS age,
          l_suppkey + 1 AS trainer_id,
          CASE WHEN l_linenumber <> 7 THEN l_suppkey END AS driver_jockey_id,
          CASE WHEN l_partkey % 8 <> 7 THEN l_partkey % 5 + 1 END AS shoeing_id,
          CASE WHEN l_returnflag = 'R' THEN l_partkey % 5 + 1 END AS incident_id,
          q % 12 AS career_races_count,
          CASE WHEN l_discount <> 0 THEN l_extendedprice END AS career_winnings,
          CASE WHEN l_tax <> 0 THEN l_quantity * 0.5 + 1 END AS reference_odds,
          CASE WHEN q % 10 <> 0 THEN l_quantity * 0.25 + 1 END AS live_odds,
          CASE WHEN l_returnflag <> 'R' THEN CAST(greatest(1, q // 8 + l_partkey % 3) AS INTEGER) END AS finish_rank,
          CASE WHEN l_linenumber % 2 = 0 THEN 'CONFIANT' END AS trainer_advice
        FROM (SELECT *, CAST(l_quantity AS INTEGER) AS q FROM lines)""",
    "horse_race_history": """
        SELECT l_partkey + CASE WHEN l_partkey % 10 = 0 THEN 1 ELSE 0 END AS horse_id,
          CAST(l_shipdate AS DATE) AS race_date,
          CASE WHEN l_linestatus = 'F' THEN 'ATTELE' ELSE 'MONTE' END AS discipline,
          l_extendedprice AS prize_money, CAST(l_suppkey % 15 * 100 + 1600 AS INTEGER) AS distance_m,
          CASE WHEN l_returnflag <> 'A' THEN l_linenumber END AS finish_place, l_returnflag AS finish_status,
          CASE WHEN l_returnflag <> 'R' THEN l_tax + 1.1 END AS reduction_km
        FROM lineitem""",
    "race_bet": """
        SELECT DISTINCT l_orderkey * 10 + CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS bet_id,
          l_orderkey AS race_id,
          CASE l_returnflag WHEN 'A' THEN 'SG' WHEN 'N' THEN 'SP' ELSE 'TRIO' END AS bet_type,
          l_returnflag = 'R' AS is_refunded FROM lineitem""",
    "bet_report": """
        SELECT l_orderkey * 100 + l_linenumber AS report_id,
          l_orderkey * 10 + CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS bet_id,
          CAST(l_linenumber AS VARCHAR) AS combination, l_extendedprice / 100 AS dividend FROM lines""",
    "context": """
        SELECT * FROM race JOIN race_meeting USING (meeting_id) JOIN daily_program USING (program_id)""",
    "serving": """
        SELECT horse_id, count(*) AS n, avg(finish_place) AS place, avg(reduction_km) AS speed, sum(prize_money) AS earned
        FROM horse_race_history GROUP BY horse_id""",
    "features": """
        SELECT rp.race_id, r.race_number, rp.pmu_number AS program_number, h.horse_name, r.program_date, r.distance_m,
          r.declared_runners_count, r.racetrack_code, r.discipline, r.track_type, r.weather_wind,
          r.weather_temperature, r.terrain_label, rp.age, rp.career_winnings, rp.career_races_count, h.birth_year,
          rp.reference_odds, rp.live_odds, coalesce(s.speed, 1.20) AS hist_avg_speed,
          coalesce(s.earned, 0.0) AS hist_earnings, CAST(coalesce(s.n, 0) AS BIGINT) AS hist_races,
          ls.code AS shoeing_status, h.sex, d.actor_name AS jockey_name, t.actor_name AS trainer_name,
          rp.horse_id, rp.participant_id, rp.finish_rank, rp.trainer_advice,
          (rp.horse_id * 7 + rp.pmu_number * 13) % 100 / 200.0::DOUBLE AS win_probability
        FROM race_participant rp JOIN context r USING (race_id) JOIN horse h USING (horse_id)
        LEFT JOIN serving s USING (horse_id) LEFT JOIN lookup_shoeing ls USING (shoeing_id)
        LEFT JOIN racing_actor d ON d.actor_id = rp.driver_jockey_id
        LEFT JOIN racing_actor t ON t.actor_id = rp.trainer_id""",
}

_NEEDS: dict[str, list[str]] = {
    "race_participant": ["lines"],
    "bet_report": ["lines"],
    "context": ["race", "race_meeting", "daily_program"],
    "serving": ["horse_race_history"],
    "features": ["race_participant", "context", "horse", "serving", "lookup_shoeing", "racing_actor"],
}


def with_views(sql: str, *names: str) -> str:
    """Put the named views, and those they need, in front of a query."""
    order: list[str] = []

    def need(name: str) -> None:
        for other in _NEEDS.get(name, []):
            need(other)
        if name not in order:
            order.append(name)

    for name in names:
        need(name)
    head = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in order)
    return f"WITH {head}\n{sql}"
