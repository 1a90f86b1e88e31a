"""DuckDB counterparts of the queries, written on the source tables directly."""

from __future__ import annotations

from registry.tables_sql import VIEWS, with_views

_ROUNDED = "* REPLACE (round(hist_avg_speed, 6) AS hist_avg_speed, round(hist_earnings, 6) AS hist_earnings)"
_INPUTS = "* EXCLUDE (horse_id, participant_id, finish_rank, trainer_advice, win_probability)"

# Landed documents and what becomes of them. Race numbers turn over into the meeting, and meetings into the day.
_MEETING = "CAST(o_custkey % 5 + 1 + 5 * (o_orderkey // 30000 % 6553) AS INTEGER)"
_DAY = "CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey // 30000 // 6553 * 2500 AS INTEGER) AS DATE)"
VIEWS["programmes"] = f"""
    SELECT o_orderkey AS o, {_DAY} AS d, {_MEETING} AS n,
      CASE WHEN o % 17 = 0 THEN 'SKIPPED' WHEN o % 19 = 0 THEN 'FAILED' WHEN o % 23 = 0 THEN 'FAILED'
        WHEN o % 29 = 0 AND o % 5 < 3 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
      o % 17 <> 0 AND o % 19 <> 0 AS sent
    FROM orders"""
_CHILD = """
    SELECT l_orderkey * 10 + l_linenumber AS seq, l_orderkey * 7 + l_linenumber AS k, l_partkey AS part,
      l_linenumber AS number, CAST(l_quantity AS INTEGER) AS q, *,
      CASE WHEN k % 17 = 0 THEN 'SKIPPED' WHEN k % 19 = 0 THEN 'FAILED' {rules} ELSE 'SUCCESS' END AS status,
      k % 17 <> 0 AND k % 19 <> 0 AS sent
    FROM lines"""
VIEWS["runner_docs"] = _CHILD.format(
    rules="WHEN k % 23 = 0 THEN 'FAILED' WHEN part % 29 = 0 AND part % 20 <> 0 THEN 'FAILED'"
)
VIEWS["past_docs"] = _CHILD.format(
    rules="WHEN part % 37 = 0 THEN 'SKIPPED' WHEN k % 23 = 0 THEN 'FAILED' "
    "WHEN part % 31 = 0 AND part % 5 < 3 AND part % 20 <> 0 THEN 'FAILED'"
)
VIEWS["bet_docs"] = _CHILD.format(rules="WHEN k % 23 = 0 THEN 'FAILED' WHEN part % 33 = 0 THEN 'FAILED'")

VIEWS["new_races"] = """
    SELECT row_number() OVER (ORDER BY meeting_id, race_number) AS race_id, * FROM (
      SELECT *, row_number() OVER (PARTITION BY meeting_id, race_number ORDER BY o) AS nth FROM (
        SELECT *, o % 30000 AS race_number,
          dense_rank() OVER (ORDER BY d, n) AS meeting_id
        FROM programmes WHERE status = 'SUCCESS') WHERE o % 5 < 3) WHERE nth = 1"""
VIEWS["located"] = f"""
    SELECT o_orderkey AS l_orderkey, {_DAY} AS d, {_MEETING} AS n,
      o_orderkey % 30000 AS race_number FROM orders"""
VIEWS["scored"] = """
    SELECT p, CAST(sum(y) AS DOUBLE) AS won, CAST(count(*) AS DOUBLE) AS n FROM (
      SELECT (horse_id * 7 + pmu_number * 13) % 100 / 200.0::DOUBLE AS p, CASE WHEN finish_rank = 1 THEN 1 ELSE 0 END AS y
      FROM race_participant WHERE finish_rank IS NOT NULL) GROUP BY p"""
VIEWS["sums"] = "SELECT *, sum(won) OVER (ORDER BY p) AS wins, sum(n) OVER (ORDER BY p) AS seen FROM scored"
VIEWS["filled"] = """
    SELECT race_id, program_number, horse_name, coalesce(racetrack_code, 'MISSING') AS racetrack_code,
      coalesce(jockey_name, 'MISSING') AS jockey_name FROM features"""
_NEEDED = {
    "scored": ["race_participant"],
    "runner_docs": ["lines"],
    "past_docs": ["lines"],
    "bet_docs": ["lines"],
    "new_races": ["programmes"],
}

_CODES = {
    "race": "['ATTELE','attele','MONTE'][o % 5 + 1]",
    "past": "['ATTELE','monte','MONTE'][part % 5 + 1]",
    "bet": "['SG','TRIO','A_NEW_KIND'][part % 5 + 1]",
}


def _sql(sql: str, *views: str) -> str:
    needed: list[str] = []
    for view in views:
        needed += [*_NEEDED.get(view, []), view]
    return with_views(sql, *needed)


_RACE_FIELDS = f"""
    o % 30000 AS race_number, {_CODES['race']} AS discipline, CAST(o % 20 * 100 + 1600 AS INTEGER) AS distance_m,
    ['S','AUTRE'][o % 3 + 1] AS track_type, ['FIN','LIVE','SOMETHING_'][o % 4 + 1] AS race_status,
    [3.5::DOUBLE, 4.25::DOUBLE][o % 3 + 1] AS penetrometer, CAST(o % 12 + 4 AS INTEGER) AS declared_runners_count,
    CAST(CASE WHEN o % 2 = 0 AND o % 1000 <> 0 THEN o % 1000 * 333 // 1000 END AS INTEGER) AS race_duration_s"""

_RUNNER_FIELDS = """
    seq, 'Horse ' || part AS horse_name, CAST(number AS INTEGER) AS pmu_number,
    'Trainer ' || l_suppkey AS trainer_name, CASE WHEN number <> 7 THEN 'Driver ' || l_suppkey END AS driver_name,
    ['DP','SOMETHING_'][part % 3 + 1] AS shoeing_code,
    ['NP','DIST',left('UNKNOWN_AND_RATHER_LONG', 20)][part % 4 + 1] AS incident_code,
    CASE WHEN q % 5 <> 0 THEN (part * 1000 + number) / 100.0::DOUBLE END AS career_winnings,
    l_quantity * 0.5 + 1 AS reference_odds"""

_PAST_FIELDS = f"""
    seq, 'Horse ' || part AS horse_name, CASE WHEN part % 11 <> 0 THEN CAST(l_shipdate AS DATE) END AS race_date,
    {_CODES['past']} AS discipline, l_quantity * 10 AS prize_money,
    CAST(l_suppkey % 15 * 100 + 1600 AS INTEGER) AS distance_m,
    CASE WHEN part % 9 <> 0 AND number % 3 <> 0 THEN number END AS finish_place,
    CASE WHEN part % 9 <> 0 AND number % 3 <> 0 THEN 'ARRIVE' END AS finish_status"""

_PAYOUT_FIELDS = f"""
    seq, {_CODES['bet']} AS bet_type, CASE WHEN part % 10 <> 0 THEN CAST(number AS VARCHAR) END AS combination,
    CASE WHEN part % 6 <> 0 THEN part * 10 / 100.0::DOUBLE END AS dividend, part % 7 * 50 / 100.0::DOUBLE AS base_stake,
    l_quantity * 0.5 AS winners_count"""

_AS_OF = """
    SELECT {keys}, CAST(coalesce(s.n, 0) AS BIGINT) AS hist_races, {values} FROM {rows} x LEFT JOIN LATERAL (
      SELECT {counted} AS n, avg(finish_place) AS place, avg(reduction_km) AS speed, min(reduction_km) AS best,
        sum(prize_money) AS earned, count(*) AS rows_before
      FROM horse_race_history y WHERE y.horse_id = x.horse_id AND y.race_date < x.program_date) s ON true"""

_ODDS = "greatest(coalesce(reference_odds, 1.0), 1.05)::DOUBLE"
_BETS = f"""
    SELECT race_id, race_number AS race_num, horse_name, program_number, odds, win_probability, edge, 'Sniper' AS strategy
    FROM (SELECT *, row_number() OVER (PARTITION BY race_id ORDER BY win_probability DESC, program_number) AS nth
      FROM (SELECT *, {_ODDS} AS odds, win_probability - 1 / {_ODDS} AS edge FROM features)
      WHERE edge >= 0.05 AND odds BETWEEN 5 AND 20) WHERE nth = 1"""
# Scores of which some are missing: null or NaN on the other side, neither of which is a pick.
_PARTLY = """SELECT * REPLACE (CASE WHEN program_number % 3 <> 0 AND horse_id % 4 <> 0 THEN win_probability END
    AS win_probability) FROM features"""
_RANKED = """
    SELECT race_id, program_number, horse_name, win_probability, CAST(row_number() OVER (
      PARTITION BY race_id ORDER BY win_probability DESC, program_number) AS INTEGER) AS predicted_rank FROM features"""
_ANALYSIS = f"""
    SELECT r.race_id, predicted_rank, r.program_number, horse_name, a.actor_name AS driver_name,
      rp.live_odds AS odds, win_probability
    FROM ({_RANKED}) r JOIN race_participant rp ON rp.race_id = r.race_id AND rp.pmu_number = r.program_number
    LEFT JOIN racing_actor a ON a.actor_id = rp.driver_jockey_id"""
_SCORED = """
    SELECT (horse_id * 7 + pmu_number * 13) % 100 / 200.0::DOUBLE AS p, CASE WHEN finish_rank = 1 THEN 1 ELSE 0 END AS y
    FROM race_participant WHERE finish_rank IS NOT NULL"""
_SLOTS = "l_orderkey, l_linenumber"
_SLOT_ORDER = "l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_quantity"
_ALL_DOCS = """
    SELECT 'programme' AS feed, o AS seq, status, sent FROM programmes
    UNION ALL SELECT 'participants', seq, status, sent FROM runner_docs
    UNION ALL SELECT 'performances', seq, status, sent FROM past_docs
    UNION ALL SELECT 'reports', seq, status, sent FROM bet_docs"""
# One race, runner, past race or bet a document; the name of a track and some types of bet are cut.
_COUNTED_DOCS = """
    SELECT 'programme' AS feed, status, CAST(o % 5 < 3 AS INTEGER) AS attempted, 1 AS overflowed FROM programmes
    UNION ALL SELECT 'participants', status, 1, 0 FROM runner_docs
    UNION ALL SELECT 'performances', status, CAST(part % 5 < 3 AND part % 20 <> 0 AS INTEGER), 0 FROM past_docs
    UNION ALL SELECT 'reports', status, 1, CAST(part % 5 = 2 AS INTEGER) FROM bet_docs"""
_DOC_VIEWS = ("programmes", "runner_docs", "past_docs", "bet_docs")


def _label(key: str, *texts: str | None) -> str:
    options = ", ".join("NULL" if t is None else f"'{t}'" for t in texts)
    return f"[{options}][{key} % {len(texts)} + 1]"


def _coded(label: str, known: dict[str, str], width: int) -> str:
    cases = " ".join(f"WHEN '{name}' THEN '{code}'" for name, code in known.items())
    return f"CASE {label} {cases} ELSE left(nullif({label}, ''), {width}) END"


_STATUS = _label("l_partkey", "ARRIVEE_DEFINITIVE_COMPLETE", "COURSE_ANNULEE", "A_PARTIR", "UNKNOWN_STATUS", "", None)
_TRACK = _label("l_orderkey", "SABLE", "MACHEFER", "GRASS_AND_SAND", None)
_INCIDENT = _label("l_partkey", "TOMBE", "DISQUALIFIE", "AN_INCIDENT_WITH_A_LONG_NAME", None)
_SHOEING = _label("l_suppkey", "PROTEGE_POSTERIEURS", "BARE", "SOMETHING_ELSE", None)
_BET = _label("l_suppkey", "QUINTE_PLUS", "DEUX_SUR_QUATRE", "A_NEW_KIND_OF_BET", "", None)

ORACLE: dict[str, str] = {
    "races_by_date": _sql(
        """SELECT program_date, race_id, meeting_number, race_number, discipline, distance_m, racetrack_code,
           CAST(NULL AS VARCHAR) AS name, declared_runners_count FROM context""",
        "context",
    ),
    "participants_by_race": _sql(
        """SELECT race_id, pmu_number AS program_number, horse_name, d.actor_name AS driver_name,
           t.actor_name AS trainer_name, live_odds AS odds
           FROM race_participant rp JOIN horse USING (horse_id)
           LEFT JOIN racing_actor d ON d.actor_id = driver_jockey_id
           LEFT JOIN racing_actor t ON t.actor_id = rp.trainer_id""",
        "race_participant", "horse", "racing_actor",
    ),
    "race_features": _sql(f"SELECT * EXCLUDE (race_number) FROM (SELECT {_ROUNDED} FROM (SELECT {_INPUTS} FROM features))", "features"),
    "daily_features": _sql(f"SELECT {_ROUNDED} FROM (SELECT {_INPUTS} FROM features)", "features"),
    "training_set": _sql(
        """SELECT participant_id, race_id, f.horse_id, finish_rank, CASE WHEN finish_rank = 1 THEN 1 ELSE 0 END AS is_winner,
           program_date, racetrack_code, weather_temperature, weather_wind, race_number, discipline, distance_m,
           track_type, terrain_label, declared_runners_count, birth_year, sex, program_number AS pmu_number, age,
           career_winnings, career_races_count, trainer_advice, reference_odds, live_odds, shoeing_status,
           jockey_name, trainer_name, CAST(coalesce(n, 0) AS BIGINT) AS hist_races, round(place, 6) AS hist_avg_rank,
           round(speed, 6) AS hist_avg_speed, round(best, 6) AS hist_best_speed,
           round(coalesce(earned, 0.0), 6) AS hist_earnings
           FROM features f LEFT JOIN (SELECT horse_id, count(finish_place) AS n, avg(finish_place) AS place,
             coalesce(avg(reduction_km), 1.20) AS speed, min(reduction_km) AS best, coalesce(sum(prize_money), 0) AS earned
             FROM horse_race_history GROUP BY horse_id) s ON s.horse_id = f.horse_id
           WHERE finish_rank IS NOT NULL""",
        "features",
    ),
    "training_set_as_of": _sql(
        _AS_OF.format(
            keys="x.participant_id",
            values="""round(s.place, 6) AS hist_avg_rank,
              round(CASE WHEN s.rows_before > 0 THEN coalesce(s.speed, 1.20) END, 6) AS hist_avg_speed,
              round(s.best, 6) AS hist_best_speed, round(coalesce(s.earned, 0.0), 6) AS hist_earnings""",
            rows="(SELECT * FROM features WHERE finish_rank IS NOT NULL)",
            counted="count(finish_place)",
        ),
        "features",
    ),
    "history_as_of": _sql(
        _AS_OF.format(
            keys="x.race_id, x.program_number",
            values="round(coalesce(s.speed, 1.20), 6) AS hist_avg_speed, round(coalesce(s.earned, 0.0), 6) AS hist_earnings",
            rows="features",
            counted="count(*)",
        ),
        "features",
    ),
    "predict_race": _sql(_RANKED, "features"),
    "value_bets": _sql(f"SELECT * REPLACE (round(edge, 6) AS edge) FROM ({_BETS})", "features"),
    "value_bets_missing_scores": _sql(
        f"SELECT * REPLACE (round(edge, 6) AS edge) FROM ({_BETS.replace('FROM features', f'FROM ({_PARTLY})')})", "features"
    ),
    "value_bets_display": _sql(
        f"""SELECT 'C' || race_num AS "Race", '#' || program_number || ' ' || horse_name AS "Horse",
            printf('%.1f', odds) AS "Odds", printf('%.1f', win_probability * 100) || '%' AS "AI Prob",
            '+' || printf('%.1f', edge * 100) || '%' AS "Edge", 'Mid-Range Value' AS "Strategy" FROM ({_BETS})""",
        "features",
    ),
    "meeting_list": _sql(
        """SELECT program_date, meeting_number, 'R' || meeting_number || ' - ' || coalesce(racetrack_code, 'None') AS label
           FROM (SELECT *, row_number() OVER (PARTITION BY program_date, meeting_number ORDER BY race_number) AS nth
             FROM context) WHERE nth = 1""",
        "context",
    ),
    "race_card": _sql(
        """SELECT program_date, meeting_number, race_number, race_id,
           'Meeting ' || meeting_number || ' : ' || coalesce(racetrack_code, 'None') AS header, 'C' || race_number AS tab,
           'C' || race_number || ' - ' || coalesce(discipline, 'None') AS title, distance_m || ' m' AS distance,
           coalesce(CAST(declared_runners_count AS VARCHAR), '-') AS runners, racetrack_code FROM context""",
        "context",
    ),
    "race_analysis": _sql(_ANALYSIS, "features"),
    "race_analysis_top3": _sql(
        f"""SELECT race_id, predicted_rank, '#' || program_number AS number, horse_name, driver_name,
            printf('%.1f', win_probability * 100) || '%' AS chance FROM ({_ANALYSIS}) WHERE predicted_rank <= 3""",
        "features",
    ),
    "semi_join_history": _sql(
        """SELECT horse_id, race_date, discipline, distance_m, prize_money FROM horse_race_history
           WHERE horse_id IN (SELECT horse_id FROM race_participant WHERE finish_rank = 1)""",
        "horse_race_history", "race_participant",
    ),
    "serving_stats": _sql(
        """SELECT horse_id, n AS hist_races, round(place, 6) AS hist_avg_rank, round(speed, 6) AS hist_avg_speed,
           round(earned, 6) AS hist_earnings FROM serving""",
        "serving",
    ),
    "lifetime_stats": _sql(
        """SELECT horse_id, count(finish_place) AS hist_races, round(avg(finish_place), 6) AS hist_avg_rank,
           round(coalesce(avg(reduction_km), 1.20), 6) AS hist_avg_speed, round(min(reduction_km), 6) AS hist_best_speed,
           round(coalesce(sum(prize_money), 0), 6) AS hist_earnings FROM horse_race_history GROUP BY horse_id""",
        "horse_race_history",
    ),
    "learned_means": _sql(
        """SELECT round(avg(weather_temperature), 6) AS weather_temperature, round(avg(reference_odds), 6) AS reference_odds
           FROM race_participant JOIN context USING (race_id)""",
        "race_participant", "context",
    ),
    "impute_temperature": _sql(
        """SELECT race_id, pmu_number, racetrack_code, round(coalesce(weather_temperature,
           CASE WHEN racetrack_code IS NOT NULL THEN avg(weather_temperature) OVER (PARTITION BY racetrack_code) END,
           15.0), 6) AS weather_temperature FROM race_participant JOIN context USING (race_id)""",
        "race_participant", "context",
    ),
    "impute_odds": _sql(
        """SELECT race_id, pmu_number, round(coalesce(reference_odds, avg(reference_odds) OVER (PARTITION BY race_id),
           10.0), 6) AS reference_odds FROM race_participant""",
        "race_participant",
    ),
    "odds_rank": _sql(
        """SELECT race_id, pmu_number, reference_odds, CASE WHEN reference_odds IS NOT NULL THEN CAST(rank() OVER (
           PARTITION BY race_id ORDER BY reference_odds NULLS LAST) AS DOUBLE) END AS odds_rank_in_race
           FROM race_participant""",
        "race_participant",
    ),
    "winnings_rank": _sql(
        """SELECT race_id, pmu_number, career_winnings, CASE WHEN career_winnings IS NOT NULL THEN CAST(rank() OVER (
           PARTITION BY race_id ORDER BY career_winnings DESC NULLS LAST) AS DOUBLE) END AS winnings_rank_in_race
           FROM race_participant""",
        "race_participant",
    ),
    "relative_winnings": _sql(
        """SELECT race_id, pmu_number, career_winnings,
           round(career_winnings / (avg(career_winnings) OVER (PARTITION BY race_id) + 1), 6) AS relative_winnings
           FROM (SELECT race_id, pmu_number, coalesce(career_winnings, 0.0) AS career_winnings FROM race_participant)""",
        "race_participant",
    ),
    "engineered_features": _sql(
        f"""SELECT *, CAST(rank() OVER (PARTITION BY race_id ORDER BY ranked_odds) AS DOUBLE) AS odds_rank_in_race,
              round(ranked_odds, 6) AS reference_odds,
              CAST(rank() OVER (PARTITION BY race_id ORDER BY career_winnings DESC) AS DOUBLE) AS winnings_rank_in_race,
              round(career_winnings / (avg(career_winnings) OVER (PARTITION BY race_id) + 1), 6) AS relative_winnings,
              round(career_winnings / (career_races_count + 1), 6) AS winnings_per_race
            FROM (SELECT * EXCLUDE (reference_odds) REPLACE (
                round(hist_avg_speed, 6) AS hist_avg_speed, round(hist_earnings, 6) AS hist_earnings,
                round(coalesce(weather_temperature, CASE WHEN racetrack_code IS NOT NULL THEN
                  avg(weather_temperature) OVER (PARTITION BY racetrack_code) END,
                  avg(weather_temperature) OVER ()), 6) AS weather_temperature,
                coalesce(racetrack_code, 'MISSING') AS racetrack_code, coalesce(discipline, 'MISSING') AS discipline,
                coalesce(track_type, 'MISSING') AS track_type, coalesce(sex, 'MISSING') AS sex,
                coalesce(shoeing_status, 'MISSING') AS shoeing_status, coalesce(jockey_name, 'MISSING') AS jockey_name,
                coalesce(trainer_name, 'MISSING') AS trainer_name, coalesce(terrain_label, 'MISSING') AS terrain_label,
                coalesce(career_winnings, 0.0) AS career_winnings),
              CAST(month(program_date) AS INTEGER) AS race_month,
              CAST(isodow(program_date) - 1 AS INTEGER) AS race_day_of_week,
              CAST(coalesce(year(program_date) - birth_year, age) AS INTEGER) AS horse_age_at_race,
              CAST(reference_odds IS NULL AS INTEGER) AS is_odds_missing,
              CAST(career_races_count = 0 AS INTEGER) AS is_debutant,
              coalesce(reference_odds, avg(reference_odds) OVER (PARTITION BY race_id), avg(reference_odds) OVER ()) AS ranked_odds
              FROM (SELECT {_INPUTS} FROM features))""".replace("SELECT *, CAST(rank()", "SELECT * EXCLUDE (ranked_odds), CAST(rank()", 1),
        "features",
    ),
    "temporal_split_counts": _sql(
        """SELECT CASE WHEN program_date <= last - 90 THEN 'train' WHEN program_date <= last - 60 THEN 'val' ELSE 'test' END
           AS split, count(*) AS rows FROM (SELECT program_date, max(program_date) OVER () AS last
           FROM race_participant JOIN context USING (race_id) WHERE finish_rank IS NOT NULL) GROUP BY 1""",
        "race_participant", "context",
    ),
    "latest_day": "SELECT CAST(max(o_orderdate) AS DATE) AS last_day FROM orders",
    "log_loss": _sql(
        f"""SELECT round(avg(-CASE WHEN y = 1 THEN ln(q) ELSE ln(1 - q) END), 6) AS log_loss FROM (
            SELECT y, least(greatest(p, 2.220446049250313e-16), 1 - 2.220446049250313e-16) AS q FROM ({_SCORED}))""",
        "race_participant",
    ),
    "roc_auc": _sql(
        f"""SELECT round((sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2.0::DOUBLE)
            / (sum(y)::DOUBLE * sum(1 - y)), 6) AS roc_auc FROM (
            SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0::DOUBLE AS r FROM ({_SCORED}))""",
        "race_participant",
    ),
    "load_participants_once": f"""
        SELECT {_SLOTS}, {_SLOT_ORDER} FROM (SELECT *, row_number() OVER (PARTITION BY {_SLOTS} ORDER BY {_SLOT_ORDER}) AS nth
          FROM lineitem WHERE l_orderkey % 2 <> 0) WHERE nth = 1""",
    "load_once_null_keys": f"""
        WITH lines AS (SELECT l_orderkey, CASE WHEN l_linenumber % 3 <> 0 THEN l_linenumber END AS l_linenumber, {_SLOT_ORDER}
          FROM lineitem)
        SELECT {_SLOTS}, {_SLOT_ORDER} FROM (SELECT *, row_number() OVER (PARTITION BY {_SLOTS} ORDER BY {_SLOT_ORDER}) AS nth
          FROM lines WHERE l_linenumber IS NOT NULL AND l_orderkey % 2 <> 0) WHERE nth = 1
        UNION ALL SELECT {_SLOTS}, {_SLOT_ORDER} FROM lines WHERE l_linenumber IS NULL""",
    "load_once_update": f"""
        WITH lines AS (SELECT *, CASE WHEN l_quantity <= 25 THEN l_quantity END AS qty FROM lineitem),
        latest AS (SELECT {_SLOTS},
            arg_max(qty, ({_SLOT_ORDER})) FILTER (WHERE qty IS NOT NULL) AS qty,
            arg_max(l_extendedprice, ({_SLOT_ORDER})) AS price
          FROM lines WHERE l_partkey % 2 = 0 GROUP BY {_SLOTS}),
        stored AS (SELECT {_SLOTS}, min(qty) AS qty, min(l_extendedprice) AS price FROM lines WHERE l_partkey % 2 = 1 GROUP BY {_SLOTS})
        SELECT {_SLOTS}, coalesce(latest.qty, stored.qty) AS qty, coalesce(latest.price, stored.price) AS price
        FROM latest FULL JOIN stored USING ({_SLOTS})""",
    "assign_dimension_keys": """
        WITH known AS (SELECT s_suppkey AS actor_id, s_name AS actor_name FROM supplier WHERE s_suppkey % 3 = 0),
        names AS (SELECT p_name || '#' || p_partkey AS actor_name FROM part UNION SELECT s_name FROM supplier)
        SELECT * FROM known UNION ALL
        SELECT (SELECT max(actor_id) FROM known) + row_number() OVER (ORDER BY actor_name), actor_name
        FROM names WHERE actor_name NOT IN (SELECT actor_name FROM known)""",
    "resolve_dimension_keys": """
        SELECT l_orderkey, l_linenumber,
          CASE WHEN l_linenumber <> 7 THEN printf('Supplier#%09d', l_suppkey + 1) END AS actor_name,
          CASE WHEN l_linenumber <> 7 AND l_suppkey + 1 IN (SELECT s_suppkey FROM supplier) THEN l_suppkey + 1 END AS actor_id
        FROM lineitem""",
    "code_maps": f"""
        SELECT l_orderkey, l_linenumber,
          {_coded(_STATUS, {'ARRIVEE_DEFINITIVE_COMPLETE': 'FIN', 'COURSE_ANNULEE': 'ANN', 'A_PARTIR': 'FUT'}, 10)} AS race_status,
          {_coded(_TRACK, {'SABLE': 'S', 'MACHEFER': 'M'}, 10)} AS track_type,
          {_coded(_INCIDENT, {'TOMBE': 'T', 'DISQUALIFIE': 'DAI'}, 20)} AS incident,
          {_coded(_SHOEING, {'PROTEGE_POSTERIEURS': 'PP'}, 10)} AS shoeing,
          {_coded(_BET, {'QUINTE_PLUS': 'QUINTE', 'DEUX_SUR_QUATRE': '2S4'}, 10)} AS bet_type,
          coalesce({_BET} = 'A_NEW_KIND_OF_BET', false) AS bet_type_overflow
        FROM lineitem""",
    "parse_programme": _sql(
        f"""SELECT d AS program_date, n AS meeting_number, o AS seq, 'BON' AS terrain_label, {_RACE_FIELDS}
            FROM programmes WHERE status = 'SUCCESS' AND o % 5 < 3""",
        "programmes",
    ),
    "parse_meetings": _sql(
        """SELECT d AS program_date, n AS meeting_number, 'TROT' AS meeting_type, left('TRACK_' || n || '_LONG', 10) AS racetrack_code,
           CASE WHEN o % 2 = 0 THEN n + 0.5::DOUBLE END AS weather_temperature,
           CASE WHEN o % 2 = 0 THEN 'N' END AS weather_wind, o AS seq FROM programmes WHERE status = 'SUCCESS'""",
        "programmes",
    ),
    "parse_participants": _sql(
        f"""SELECT CAST(l_shipdate AS DATE) AS day, {_RUNNER_FIELDS}, CAST(2000 - nullif(q % 8, 0) AS INTEGER) AS birth_year,
            q % 8 AS age, ['M','F'][part % 4 + 1] AS sex, q % 12 AS career_races_count,
            CASE WHEN l_tax <> 0 THEN l_quantity * 0.25 + 1 END AS live_odds, number AS finish_rank,
            q * 1000 AS time_achieved_s, [1.25::DOUBLE][part % 3 + 1] AS reduction_km
            FROM runner_docs WHERE status = 'SUCCESS' AND part % 20 <> 0""",
        "runner_docs",
    ),
    "parse_performances": _sql(
        f"""SELECT {_PAST_FIELDS}, number + 100 AS first_place_time_s, CASE WHEN part % 9 <> 0 THEN number END AS draw_number,
            CASE WHEN part % 9 <> 0 THEN l_tax + 1 END AS reduction_km,
            CAST(CASE WHEN part % 9 <> 0 THEN 2700 END AS INTEGER) AS distance_traveled_m
            FROM past_docs WHERE status = 'SUCCESS' AND part % 20 <> 0 AND part % 5 < 3""",
        "past_docs",
    ),
    "parse_bets": _sql(
        f"""SELECT seq, {_CODES['bet']} AS bet_type, part % 5 = 2 AS bet_type_overflow, 'MUTUEL' AS bet_family,
            part % 7 * 50 / 100.0::DOUBLE AS base_stake, l_returnflag = 'R' AS is_refunded
            FROM bet_docs WHERE status = 'SUCCESS'""",
        "bet_docs",
    ),
    "parse_reports": _sql(
        f"""SELECT * EXCLUDE (base_stake, part), part * 5 / 100.0::DOUBLE AS dividend_per_1e
            FROM (SELECT part, {_PAYOUT_FIELDS} FROM bet_docs WHERE status = 'SUCCESS')""",
        "bet_docs",
    ),
    "event_payloads": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
          CAST(json_extract_string(props, '$.k') AS BIGINT) / 100.0::DOUBLE AS euros, CAST(NULL AS VARCHAR) AS deep FROM events""",
    "money_and_number_parse": """
        SELECT l_orderkey, l_linenumber, l_partkey, round(v / 100, 6) AS euros, left(label, 5) AS label,
          length(label) > 5 AS label_overflow, v AS comma_number,
          CAST(CASE WHEN ms <> 0 THEN floor(ms / 1000.0) END AS INTEGER) AS seconds, v AS number
        FROM (SELECT *, CASE WHEN l_linenumber % 4 <> 0 AND l_linenumber % 5 <> 0 THEN l_extendedprice END AS v,
          l_returnflag || '-' || l_partkey AS label, l_partkey * 777 - 5000 AS ms FROM lineitem)""",
    "date_scope": """
        SELECT CAST(day AS DATE) AS program_date, strftime(day, '%d%m%Y') AS date_code, count(o_orderkey) AS races
        FROM (SELECT unnest(generate_series((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders),
          INTERVAL 1 DAY)) AS day) LEFT JOIN orders ON CAST(o_orderdate AS DATE) = CAST(day AS DATE) GROUP BY 1, 2""",
    "rolling_scope": _sql(
        """SELECT program_date, race_id, meeting_number, strftime(program_date, '%d%m%Y') AS date_code FROM context
           WHERE program_date >= (SELECT max(program_date) FROM daily_program) - 2""",
        "context",
    ),
    "program_days": _sql("SELECT o AS seq, d AS program_date FROM programmes WHERE status = 'SUCCESS'", "programmes"),
    "stage_work_list": _sql(
        """SELECT program_date, race_id, meeting_number, race_number FROM context
           WHERE discipline IN ('ATTELE', 'MONTE')""",
        "context",
    ),
    "load_audit": _sql(
        f"""SELECT feed, status, count(*) AS documents, CAST(sum(CASE WHEN status = 'SUCCESS' THEN attempted ELSE 0 END) AS BIGINT)
            AS attempted, CAST(sum(CASE WHEN status = 'SUCCESS' THEN overflowed ELSE 0 END) AS BIGINT) AS overflowed
            FROM ({_COUNTED_DOCS}) GROUP BY feed, status""",
        *_DOC_VIEWS,
    ),
    "dead_letter": _sql(f"SELECT feed, seq FROM ({_ALL_DOCS}) WHERE status = 'FAILED' AND sent", *_DOC_VIEWS),
    "load_program": _sql(f"SELECT race_id, meeting_id, {_RACE_FIELDS} FROM new_races", "new_races"),
    "load_participants": _sql(
        f"""SELECT d AS program_date, n AS meeting_number, race_number, pmu_number, horse_id, horse_name, trainer_name,
              shoeing_id, incident_id, career_winnings, reference_odds FROM (
            SELECT *, dense_rank() OVER (ORDER BY horse_name) AS horse_id,
              CASE WHEN shoeing_code IS NOT NULL THEN dense_rank() OVER (ORDER BY shoeing_code NULLS LAST) END AS shoeing_id,
              CASE WHEN incident_code IS NOT NULL THEN dense_rank() OVER (ORDER BY incident_code NULLS LAST) END AS incident_id,
              row_number() OVER (PARTITION BY d, n, race_number, pmu_number ORDER BY seq) AS nth
            FROM (SELECT {_RUNNER_FIELDS}, d, n, race_number FROM runner_docs JOIN located USING (l_orderkey)
              SEMI JOIN (SELECT d, n, race_number FROM new_races WHERE o % 5 IN (0, 2)) USING (d, n, race_number)
              WHERE status = 'SUCCESS' AND part % 20 <> 0)) WHERE nth = 1""",
        "runner_docs", "located", "new_races",
    ),
    "load_performances": _sql(
        f"""SELECT horse_id, horse_name, race_date, discipline, distance_m, prize_money, finish_place, finish_status FROM (
            SELECT *, row_number() OVER (PARTITION BY horse_name, race_date, discipline, distance_m ORDER BY seq) AS nth
            FROM (SELECT *, dense_rank() OVER (ORDER BY horse_name) AS horse_id FROM (
              SELECT part, {_PAST_FIELDS} FROM past_docs JOIN located USING (l_orderkey)
              SEMI JOIN (SELECT d, n, race_number FROM new_races) USING (d, n, race_number)
              WHERE status = 'SUCCESS' AND part % 20 <> 0)) WHERE part % 5 < 3)
            WHERE nth = 1 OR race_date IS NULL""",
        "past_docs", "located", "new_races",
    ),
    "load_reports": _sql(
        f"""WITH payouts AS (SELECT d, n, race_number, {_PAYOUT_FIELDS} FROM bet_docs JOIN located USING (l_orderkey)
              SEMI JOIN (SELECT d, n, race_number FROM new_races WHERE o % 5 IN (0, 2)) USING (d, n, race_number)
              WHERE status = 'SUCCESS')
            SELECT d AS program_date, n AS meeting_number, race_number, bet_type, base_stake, combination, dividend, winners_count
            FROM (SELECT * EXCLUDE (base_stake), first_value(base_stake) OVER (PARTITION BY d, n, race_number, bet_type,
                CASE WHEN bet_type IS NULL THEN seq END ORDER BY seq) AS base_stake,
              row_number() OVER (PARTITION BY d, n, race_number, bet_type, combination ORDER BY seq) AS nth FROM payouts)
            WHERE nth = 1 OR bet_type IS NULL OR combination IS NULL""",
        "bet_docs", "located", "new_races",
    ).replace("\nWITH payouts AS", ", payouts AS", 1),
    "ordinal_encode": _sql(
        """SELECT race_id, program_number, f.horse_name, f.racetrack_code, f.jockey_name,
             coalesce(h.code, -1)::DOUBLE AS horse_name_code, coalesce(r.code, -1)::DOUBLE AS racetrack_code_code,
             coalesce(j.code, -1)::DOUBLE AS jockey_name_code
           FROM filled f
           LEFT JOIN (SELECT horse_name, row_number() OVER (ORDER BY horse_name) - 1 AS code FROM
             (SELECT DISTINCT horse_name FROM filled WHERE race_id % 2 = 0)) h USING (horse_name)
           LEFT JOIN (SELECT racetrack_code, row_number() OVER (ORDER BY racetrack_code) - 1 AS code FROM
             (SELECT DISTINCT racetrack_code FROM filled WHERE race_id % 2 = 0)) r USING (racetrack_code)
           LEFT JOIN (SELECT jockey_name, row_number() OVER (ORDER BY jockey_name) - 1 AS code FROM
             (SELECT DISTINCT jockey_name FROM filled WHERE race_id % 2 = 0)) j USING (jockey_name)""",
        "features", "filled",
    ),
    # The isotonic fit at a point is the largest, over starts up to it, of the smallest mean over ends from it on.
    "isotonic_calibration": _sql(
        f"""SELECT round(p, 6) AS p, round(max(lowest), 6) AS calibrated FROM (
              SELECT i.p, j.p AS start, min((k.wins - j.wins + j.won) / (k.seen - j.seen + j.n)) AS lowest
              FROM sums i JOIN sums j ON j.p <= i.p JOIN sums k ON k.p >= i.p GROUP BY i.p, j.p)
            GROUP BY p""",
        "scored", "sums",
    ),
    # Rules that the derived tables can break; all others hold by construction.
    "warehouse_violations": _sql(
        """SELECT "table", rule, columns, rows FROM (
             SELECT 'horse_race_history' AS "table", 'unique' AS rule, 'horse_id,race_date,discipline,distance_m' AS columns,
               count(*) AS rows FROM (SELECT 1 FROM horse_race_history GROUP BY horse_id, race_date, discipline, distance_m
               HAVING count(*) > 1)
             UNION ALL SELECT 'race_participant', 'foreign', 'trainer_id', count(*) FROM race_participant
               WHERE trainer_id NOT IN (SELECT actor_id FROM racing_actor)
             UNION ALL SELECT 'race', 'range', 'discipline,race_category,track_type,terrain_label,race_status,'
               || 'race_status_category,race_number,distance_m,declared_runners_count', count(*) FROM race WHERE race_number > 32767)
           WHERE rows > 0""",
        "horse_race_history", "race_participant", "racing_actor", "race",
    ),
    "check_unique": f"SELECT {_SLOTS}, count(*) AS occurrences FROM lineitem GROUP BY {_SLOTS} HAVING count(*) > 1",
    "check_fk": _sql(
        """SELECT participant_id, trainer_id FROM race_participant
           WHERE trainer_id NOT IN (SELECT actor_id FROM racing_actor)""",
        "race_participant", "racing_actor",
    ),
    "check_not_null": _sql(
        """SELECT column_name, nulls FROM (
             SELECT 'race_id' AS column_name, count(*) FILTER (WHERE race_id IS NULL) AS nulls FROM race_participant
             UNION ALL SELECT 'age', count(*) FILTER (WHERE age IS NULL) FROM race_participant
             UNION ALL SELECT 'reference_odds', count(*) FILTER (WHERE reference_odds IS NULL) FROM race_participant
             UNION ALL SELECT 'career_winnings', count(*) FILTER (WHERE career_winnings IS NULL) FROM race_participant
             UNION ALL SELECT 'finish_rank', count(*) FILTER (WHERE finish_rank IS NULL) FROM race_participant)
           WHERE nulls > 0""",
        "race_participant",
    ),
    "prediction_rows": _sql(
        """SELECT participant_id, 'given' AS model_version, win_probability AS proba_winner,
           CAST(NULL AS DOUBLE) AS proba_top3_place FROM features""",
        "features",
    ),
    "score_without_model": _sql(
        "SELECT race_id, program_number, horse_name, 0.0::DOUBLE AS win_probability FROM features", "features"
    ),
    "reload_participants_update": _sql(
        """SELECT CAST(d AS VARCHAR) AS program_date, n AS meeting_number, race_number, CAST(number AS INTEGER) AS pmu_number,
             (part * 1000 + number) / 100.0::DOUBLE AS career_winnings, (l_quantity + 1) * 0.5 + 1 AS reference_odds
           FROM runner_docs JOIN located USING (l_orderkey)
           SEMI JOIN (SELECT d, n, race_number FROM new_races WHERE o % 5 IN (0, 2)) USING (d, n, race_number)
           WHERE status = 'SUCCESS' AND part % 20 <> 0""",
        "runner_docs", "located", "new_races",
    ),
    "check_range": """
        SELECT l_orderkey, l_linenumber, l_partkey * 20 AS distance_m, l_returnflag || l_suppkey AS code FROM lineitem
        WHERE l_partkey * 20 > 32767 OR length(l_returnflag || l_suppkey) > 2""",
}


# Documents of many rows. A programme holds a day's races of one turn of the race numbers, a few of them twice.
VIEWS["day_races"] = f"""
    SELECT o, d, n, o // 30000 AS turn, again FROM (
      SELECT o_orderkey AS o, {_DAY} AS d, {_MEETING} AS n FROM orders),
      (SELECT unnest([0, 1]) AS again) WHERE again = 0 OR o % 10 = 3"""
VIEWS["day_docs"] = """
    SELECT d, turn, min(o) AS seq, date_diff('day', DATE '1970-01-01', d) + turn * 7 AS k,
      CASE WHEN k % 17 = 0 THEN 'SKIPPED' WHEN k % 19 = 0 OR k % 23 = 0 THEN 'FAILED'
        WHEN bool_or(again = 0 AND o % 29 = 0 AND o % 5 < 3) THEN 'FAILED' ELSE 'SUCCESS' END AS status,
      count(*) FILTER (o % 5 < 3) AS attempted, count(DISTINCT n) AS overflowed
    FROM day_races GROUP BY d, turn"""
VIEWS["placed_races"] = """
    SELECT r.*, seq, dense_rank() OVER (PARTITION BY d, turn ORDER BY n) - 1 AS i,
      row_number() OVER (PARTITION BY d, turn, n ORDER BY o, again) - 1 AS j
    FROM day_races r JOIN day_docs USING (d, turn) WHERE status = 'SUCCESS'"""
VIEWS["day_new_races"] = """
    SELECT DISTINCT d, n, o % 30000 AS race_number, o FROM placed_races WHERE o % 5 < 3"""
# A child document holds all lines of an order.
VIEWS["race_lines"] = f"""
    SELECT l.*, l_partkey AS part, l_linenumber AS number, CAST(l_quantity AS INTEGER) AS q, d, n, o_orderkey % 30000 AS race_number,
      o_orderkey AS k, o_orderkey AS seq, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
        l_extendedprice, l_shipdate, l_quantity, l_tax, l_returnflag) - 1 AS i
    FROM lineitem l JOIN (SELECT *, {_DAY} AS d, {_MEETING} AS n FROM orders)
      ON o_orderkey = l_orderkey"""
_RACE_DOC = """
    SELECT *, CASE WHEN k % 17 = 0 THEN 'SKIPPED' WHEN k % 19 = 0 OR k % 23 = 0 THEN 'FAILED'
      WHEN bool_or({bad}) OVER (PARTITION BY k) THEN 'FAILED' ELSE 'SUCCESS' END AS status FROM race_lines"""
VIEWS["race_runner_docs"] = _RACE_DOC.format(bad="part % 29 = 0 AND part % 20 <> 0")
VIEWS["race_past_docs"] = _RACE_DOC.format(bad="part % 31 = 0 AND part % 5 < 3 AND part % 20 <> 0")
VIEWS["race_bet_docs"] = _RACE_DOC.format(bad="part % 33 = 0")
_NEEDED |= {
    "day_docs": ["day_races"],
    "placed_races": ["day_races", "day_docs"],
    "day_new_races": ["day_races", "day_docs", "placed_races"],
    "race_runner_docs": ["race_lines"],
    "race_past_docs": ["race_lines"],
    "race_bet_docs": ["race_lines"],
}
_PLACE = "CAST(d AS VARCHAR) AS day, CAST(n AS INTEGER) AS meeting, CAST(race_number AS INTEGER) AS race, i"
ORACLE["parse_day_programmes"] = _sql(
    f"""SELECT CAST(d AS VARCHAR) AS program_date, n AS meeting_number, seq, i, j, * EXCLUDE (o, d, n, turn, again, seq, i, j)
        REPLACE (CASE WHEN again = 1 THEN 1234 ELSE distance_m END AS distance_m) FROM (
          SELECT o, d, n, turn, again, seq, i, j, {_RACE_FIELDS} FROM placed_races WHERE o % 5 < 3)""",
    "placed_races",
)
ORACLE["parse_race_runners"] = _sql(
    f"""SELECT * EXCLUDE (shoeing_code) FROM (SELECT {_PLACE}, {_RUNNER_FIELDS}
        FROM race_runner_docs WHERE status = 'SUCCESS' AND part % 20 <> 0)""",
    "race_runner_docs",
)
ORACLE["parse_race_history"] = _sql(
    f"""SELECT * EXCLUDE (finish_status) REPLACE (CAST(race_date AS VARCHAR) AS race_date) FROM (
        SELECT {_PLACE}, 0 AS j, {_PAST_FIELDS} FROM race_past_docs WHERE status = 'SUCCESS' AND part % 20 <> 0 AND part % 5 < 3)""",
    "race_past_docs",
)
ORACLE["parse_race_payouts"] = _sql(
    f"SELECT * EXCLUDE (base_stake) FROM (SELECT {_PLACE}, 0 AS j, {_PAYOUT_FIELDS} FROM race_bet_docs WHERE status = 'SUCCESS')",
    "race_bet_docs",
)
# What a whole load leaves: children count where their race is known, history for any discipline on the card.
_TROT_RACES = "(SELECT d, n, race_number FROM day_new_races WHERE o % 5 IN (0, 2))"
_CARD_RACES = "(SELECT d, n, race_number FROM day_new_races)"
_CHILD_LINE = """
    SELECT '{feed}' AS feed, status, count(DISTINCT k) AS documents, {attempted} AS attempted, {overflowed} AS overflowed
    FROM {docs} SEMI JOIN {races} USING (d, n, race_number) GROUP BY status"""
ORACLE["backfill_audit"] = _sql(
    """, audit AS (SELECT 'programme' AS feed, status, count(*) AS documents, sum(attempted) AS attempted, sum(overflowed) AS overflowed
         FROM day_docs GROUP BY status UNION ALL """
    + " UNION ALL ".join(
        _CHILD_LINE.format(feed=feed, docs=docs, races=races, attempted=attempted, overflowed=overflowed)
        for feed, docs, races, attempted, overflowed in (
            ("participants", "race_runner_docs", _TROT_RACES, "count(*)", "0"),
            ("performances", "race_past_docs", _CARD_RACES, "count(*) FILTER (part % 5 < 3 AND part % 20 <> 0)", "0"),
            ("reports", "race_bet_docs", _TROT_RACES, "count(*)", "count(*) FILTER (part % 5 = 2)"),
        )
    )
    + f"""), inserted AS (
        SELECT 'programme' AS feed, count(*) AS new FROM day_new_races
        UNION ALL SELECT 'participants', count(DISTINCT (k, number)) FROM race_runner_docs SEMI JOIN {_TROT_RACES} USING (d, n, race_number)
          WHERE status = 'SUCCESS' AND part % 20 <> 0
        UNION ALL SELECT 'performances', count(DISTINCT (horse_name, race_date, discipline, distance_m)) FILTER (race_date IS NOT NULL)
            + count(*) FILTER (race_date IS NULL) FROM (SELECT {_PAST_FIELDS} FROM race_past_docs
            SEMI JOIN {_CARD_RACES} USING (d, n, race_number) WHERE status = 'SUCCESS' AND part % 20 <> 0 AND part % 5 < 3)
        UNION ALL SELECT 'reports', count(DISTINCT (k, bet_type)) FILTER (bet_type IS NOT NULL) + count(*) FILTER (bet_type IS NULL)
          FROM (SELECT k, {_CODES['bet']} AS bet_type FROM race_bet_docs SEMI JOIN {_TROT_RACES} USING (d, n, race_number)
            WHERE status = 'SUCCESS'))
      SELECT feed, status, documents, CASE WHEN status = 'SUCCESS' THEN attempted ELSE 0 END AS attempted,
        CASE WHEN status = 'SUCCESS' THEN overflowed ELSE 0 END AS overflowed, CASE WHEN status = 'SUCCESS' THEN new ELSE 0 END AS inserted
      FROM audit JOIN inserted USING (feed)""",
    "race_runner_docs", "race_past_docs", "race_bet_docs", "day_new_races",
).replace("\n, audit AS", ", audit AS", 1)
ORACLE["reload_unchanged"] = _sql(
    f"""SELECT feed, 'UNCHANGED' AS status, documents, 0 AS attempted, 0 AS overflowed, 0 AS inserted FROM (
          SELECT 'programme' AS feed, count(*) AS documents FROM day_docs
          UNION ALL SELECT 'participants', count(DISTINCT k) FROM race_lines SEMI JOIN {_TROT_RACES} USING (d, n, race_number)
          UNION ALL SELECT 'performances', count(DISTINCT k) FROM race_lines SEMI JOIN {_CARD_RACES} USING (d, n, race_number)
          UNION ALL SELECT 'reports', count(DISTINCT k) FROM race_lines SEMI JOIN {_TROT_RACES} USING (d, n, race_number))""",
    "race_lines", "day_new_races",
)
ORACLE["backfill_runners"] = _sql(
    f"""SELECT program_date, meeting_number, race_number, pmu_number, horse_name, career_winnings, reference_odds,
          row_number() OVER (ORDER BY program_date, meeting_number, race_number, pmu_number) AS position FROM (
        SELECT CAST(d AS VARCHAR) AS program_date, n AS meeting_number, race_number, {_RUNNER_FIELDS},
          row_number() OVER (PARTITION BY k, number ORDER BY i) AS nth FROM race_runner_docs
        SEMI JOIN {_TROT_RACES} USING (d, n, race_number) WHERE status = 'SUCCESS' AND part % 20 <> 0) WHERE nth = 1""",
    "race_runner_docs", "day_new_races",
)

_SOME_SCORED = """(SELECT (horse_id * 7 + pmu_number * 13) % 100 / 200.0::DOUBLE AS p, CASE WHEN finish_rank = 1 THEN 1 ELSE 0 END AS y
    FROM race_participant WHERE finish_rank IS NOT NULL AND pmu_number % 3 <> 0 AND horse_id % 4 <> 0)"""
ORACLE["metrics_of_missing_scores"] = _sql(
    f"""SELECT (SELECT round(avg(-CASE WHEN y = 1 THEN ln(q) ELSE ln(1 - q) END), 6) FROM (
          SELECT y, least(greatest(p, 2.220446049250313e-16), 1 - 2.220446049250313e-16) AS q FROM {_SOME_SCORED})) AS log_loss,
        (SELECT round((sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2.0::DOUBLE) / (sum(y)::DOUBLE * sum(1 - y)), 6)
          FROM (SELECT y, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2.0::DOUBLE AS r FROM {_SOME_SCORED})) AS roc_auc""",
    "race_participant",
)
ORACLE["trained_facts"] = _sql(
    """SELECT race_id, count(*) AS runners, true AS probabilities, true AS same_after_loading, true AS ranks_in_turn, true AS in_order
       FROM features GROUP BY race_id""",
    "features",
)
ORACLE["trained_splits"] = f"SELECT *, true AS rounds_within_limit, true AS cut_at_least_loss FROM ({ORACLE['temporal_split_counts']})"
ORACLE["assembled_vectors"] = _sql(
    """SELECT race_id, program_number, dense_rank() OVER (ORDER BY coalesce(racetrack_code, 'MISSING')) - 1.0::DOUBLE AS v0,
         coalesce(distance_m, -1)::DOUBLE AS v1, coalesce(career_winnings, -1.0) AS v2, coalesce(reference_odds, 10.0) AS v3 FROM features""",
    "features",
)

_TOTALS = {
    "daily_program": "program_id", "race_meeting": "meeting_id", "race": "race_id", "horse": "horse_id", "racing_actor": "actor_id",
    "lookup_shoeing": "shoeing_id", "lookup_incident": "incident_id", "race_participant": "participant_id", "race_bet": "bet_id",
    "bet_report": "report_id",
}
_LINE = "SELECT '{0}' AS name, count(*) AS rows, coalesce(max({1}), 0) AS top FROM {0}"
ORACLE["stored_totals"] = _sql(
    "SELECT *, rows AS known_rows, top AS known_top FROM ("
    + " UNION ALL ".join(_LINE.format(name, key) for name, key in _TOTALS.items())
    + " UNION ALL SELECT 'horse_race_history', count(*), max(l_orderkey * 100 + l_linenumber) FROM lineitem"
    + " UNION ALL SELECT 'prediction', 0, 0)",
    *_TOTALS,
)
ORACLE["card_positions"] = _sql(
    """SELECT program_date, meeting_number, race_number, race_id,
       row_number() OVER (ORDER BY program_date, meeting_number, race_number) AS position FROM context""",
    "context",
)
ORACLE["runner_positions"] = _sql(
    """SELECT race_id, program_number, horse_name, row_number() OVER (ORDER BY race_id, program_number) AS position FROM features""",
    "features",
)
ORACLE["training_positions"] = _sql(
    """SELECT participant_id, race_id, program_date, row_number() OVER (ORDER BY program_date, participant_id) AS position
       FROM features WHERE finish_rank IS NOT NULL""",
    "features",
)

# Dates as ISO text on both sides, by the column each query shows them in.
_DATES = {"day": ["parse_participants"], "last_day": ["latest_day"]}
_DATES["race_date"] = ["semi_join_history", "parse_performances", "load_performances"]
_DATES["program_date"] = [
    "races_by_date", "race_features", "daily_features", "training_set", "meeting_list", "race_card",
    "engineered_features", "parse_programme", "parse_meetings", "date_scope", "rolling_scope", "program_days",
    "stage_work_list", "load_participants", "load_reports", "card_positions", "training_positions",
]
for _column, _names in _DATES.items():
    for _name in _names:
        ORACLE[_name] = f"SELECT * REPLACE (CAST({_column} AS VARCHAR) AS {_column}) FROM (\n{ORACLE[_name]}\n)"

# Scoped calls, on the last day that has races.
_LAST_DAY = "(SELECT CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) FROM orders)"
for _scoped, _whole in (("card_of_last_day", "races_by_date"), ("features_of_last_day", "daily_features")):
    ORACLE[_scoped] = f"SELECT * FROM ({ORACLE[_whole]}) WHERE program_date = {_LAST_DAY}"
# The same from a stored warehouse, with the places of the rows in their order.
_RACES_OF_DAY = f"SELECT race_id FROM ({ORACLE['card_of_last_day']})"
_IN_RACES = "SELECT *, row_number() OVER (ORDER BY race_id, program_number) AS position FROM ({0}) WHERE race_id IN ({1})"
ORACLE["stored_card"] = f"""
    SELECT *, row_number() OVER (ORDER BY meeting_number, race_number) AS position FROM ({ORACLE['card_of_last_day']})"""
ORACLE["stored_card_of_meeting"] = f"""
    SELECT *, row_number() OVER (ORDER BY race_number) AS position FROM ({ORACLE['card_of_last_day']})
    WHERE meeting_number = (SELECT min(meeting_number) FROM ({ORACLE['card_of_last_day']}))"""
ORACLE["stored_features_of_day"] = _IN_RACES.format(ORACLE["daily_features"], _RACES_OF_DAY)
ORACLE["stored_features_of_races"] = _IN_RACES.format(ORACLE["race_features"], _RACES_OF_DAY)
ORACLE["stored_runners_of_races"] = _IN_RACES.format(ORACLE["participants_by_race"], _RACES_OF_DAY)
