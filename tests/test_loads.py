import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from paddock.operators import checks, loading, scope
from paddock.plans.loads import run_stages
from paddock.schemas import TABLES
from paddock.sources.feeds import parse_feed
from paddock.sources.landing import LANDING, read_documents, read_landing, write_dead_letters, write_landing
from paddock.sources.warehouse import append, create_warehouse, empty_warehouse, near, open_warehouse, replace

DAY = "17032019"
PROGRAMME = {
    "programme": {
        "date": 1552780800000,
        "reunions": [
            {
                "numOfficiel": 1,
                "nature": "TROT",
                "hippodrome": {"code": "CABO"},
                "courses": [
                    {"numOrdre": 1, "discipline": "ATTELE", "distance": 2850, "penetrometre": {"valeurMesure": "3,5"}},
                    {"numOrdre": 2, "discipline": "PLAT"},
                    {"numOrdre": 3},
                    {"numOrdre": 4, "discipline": "monte", "dureeCourse": 151999},
                ],
            }
        ],
    }
}
RUNNERS = {
    "participants": [
        {"numPmu": 1, "nom": "A", "age": 5, "sexe": "MALES", "driver": "D", "entraineur": "T",
         "gainsParticipant": {"gainsCarriere": 1250}, "dernierRapportDirect": {"rapport": 5.1}},
        {"numPmu": 1, "nom": "A again"},
        {"numPmu": 2},
        {"numPmu": 3, "nom": "B", "driver": "T", "incident": "ARRETE", "deferre": "DEFERRE_POSTERIEURS"},
    ]
}
PAST = [
    {"nomCheval": "", "nom": "A", "coursesCourues": [
        {"date": 1552780800000, "discipline": "ATTELE", "distance": 2100, "participants": [
            {"itsHim": False, "place": 3}, {"itsHim": True, "place": {"place": 2, "statusArrivee": "OK"}}]},
        {"date": 1552780800000, "discipline": "ATTELE", "distance": 2100, "allocation": 5},
        {"date": 0, "discipline": "MONTE", "distance": 1, "participants": [{"itsHim": True, "place": 7}]},
        {"discipline": None}]},
    {"nom": "", "coursesCourues": [{"discipline": "ATTELE"}]},
]
BETS = {
    "rapportsDefinitifs": [
        {"typePari": "SIMPLE_GAGNANT", "miseBase": 150, "rembourse": False,
         "rapports": [{"combinaison": "1", "dividende": 500}, {"combinaison": "1"}, {"combinaison": None}]},
        {"typePari": "SIMPLE_GAGNANT", "rapports": [{"combinaison": "2"}]},
        {"typePari": "", "rapports": [{"combinaison": "9"}]},
    ]
}


def landed(spark, *docs):
    data = [
        (feed, DAY, meeting, race, status, body if isinstance(body, str) or body is None else json.dumps(body), i)
        for i, (feed, meeting, race, status, body) in enumerate(docs)
    ]
    return spark.createDataFrame(data, LANDING)


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    """All four feeds of a day, loaded twice."""
    root, dead = (str(tmp_path_factory.mktemp(n)) for n in ("warehouse", "dead"))
    landing = landed(
        spark,
        ("programme", None, None, 200, PROGRAMME),
        ("participants", 1, 1, 200, RUNNERS),
        ("participants", 1, 9, 200, RUNNERS),
        ("performances", 1, 1, 200, PAST),
        ("performances", 1, 4, 200, [{"nom": "C", "coursesCourues": [{"discipline": "ATTELE", "distance": 99999}]}]),
        ("reports", 1, 1, 200, BETS),
    )
    audits = [run_stages(spark, landing, root, dead, as_of_year=2024) for _ in range(2)]
    return open_warehouse(spark, root), audits, dead


def test_stages_succeed(warehouse):
    for audit in warehouse[1]:
        assert not [e for e in audit.values() if isinstance(e, Exception)]
    first, second = (
        {(r["feed"], r["status"]): (r["documents"], r["attempted"], r["inserted"]) for a in audit.values() for r in a.collect()}
        for audit in warehouse[1]
    )
    assert first == {
        ("programme", "SUCCESS"): (1, 2, 2),
        ("participants", "SUCCESS"): (1, 4, 2),
        ("performances", "SUCCESS"): (1, 3, 2),
        ("performances", "FAILED"): (1, 0, 0),
        ("reports", "SUCCESS"): (1, 3, 2),
    }
    # The second run inserts only what has a null in its key: a past race without a day, a bet without a type.
    assert {k: v[2] for k, v in second.items()} == {k: 1 if k[0] in ("performances", "reports") and k[1] == "SUCCESS" else 0 for k in first}


def test_card(warehouse):
    tables = warehouse[0]
    assert rows(tables["daily_program"]) == [(1, dt.date(2019, 3, 17))]
    assert rows(tables["race"], "race_id", "race_number", "discipline", "distance_m", "penetrometer", "race_duration_s") == [
        (1, 1, "ATTELE", 2850, 3.5, None), (2, 4, "monte", None, None, 151)]


def test_runners(warehouse):
    tables = warehouse[0]
    assert rows(tables["horse"], "horse_id", "horse_name", "sex", "birth_year") == [
        (1, "A", "M", 2019), (2, "A again", None, None), (3, "B", None, None)]
    assert rows(tables["racing_actor"]) == [(1, "D"), (2, "T")]
    assert rows(tables["race_participant"], "race_id", "pmu_number", "horse_id", "trainer_id", "driver_jockey_id",
                "shoeing_id", "incident_id", "career_winnings", "live_odds") == [
        (1, 1, 1, 2, 1, None, None, 12.5, 5.1), (1, 3, 3, None, 2, 1, 1, None, None)]


def test_history_and_bets(warehouse):
    tables = warehouse[0]
    past = rows(tables["horse_race_history"], "race_date", "discipline", "finish_place", "finish_status", "prize_money")
    # The first of two equal keys wins; the row without a date never conflicts, so a second load adds it again.
    assert past == sorted(
        [(None, "MONTE", None, None, None)] * 2 + [(dt.date(2019, 3, 17), "ATTELE", 2, "OK", None)], key=repr)
    bets = tables["race_bet"].join(tables["bet_report"], "bet_id")
    assert rows(bets.where("bet_type = 'SG'"), "combination", "dividend") == [("1", 5.0), ("2", None), (None, None), (None, None)]
    assert tables["race_bet"].where("bet_type is null").count() == 2
    assert bets.where("bet_type is null").count() == 2


def test_ids_and_rules(warehouse):
    tables = warehouse[0]
    assert checks.violations(tables).count() == 0
    for name, key in (("race_participant", "participant_id"), ("horse_race_history", "history_id"), ("bet_report", "report_id")):
        assert checks.check_unique(tables[name], [key]).count() == 0


def test_dead_letters(spark, warehouse):
    kept = spark.read.json(warehouse[2])
    assert {(r["feed"], r["document"]) for r in kept.collect()} == {("performances", "17032019_R1_C4")}
    assert "99999" in kept.first()["payload"]


def test_dead_letters_are_a_few_files_a_day(spark, tmp_path):
    # Every task holds documents of every day, one day most of them; written as they lie, each task has a file a day.
    docs = spark.range(4000).repartition(16).selectExpr(
        "'reports' as feed", "if(id % 2 = 0, '01012020', lpad(cast(id % 20 as string), 8, '0')) as date_code",
        "if(id % 3 = 0, null, 1) as meeting", "cast(id % 7 as int) as race", "concat('{', id) as payload")
    path = str(tmp_path / "dead")
    write_dead_letters(docs, path)
    files = list((tmp_path / "dead").glob("feed=*/date_code=*/*.json"))
    assert len({f.parent for f in files}) == 11
    assert len(files) <= 11 + 4
    kept = spark.read.schema("document string, payload string, feed string, date_code string").json(path)
    key = F.concat_ws("", "date_code", F.lit("_R"), F.coalesce(F.col("meeting").cast("string"), F.lit("")), F.lit("_C"), "race")
    assert rows(kept, "date_code", "document", "payload") == rows(docs.select("date_code", key, "payload"))


@pytest.mark.parametrize(
    "feed, status, body, outcome, attempted",
    [
        ("participants", 404, None, "SKIPPED", 0),
        ("participants", 204, None, "SKIPPED", 0),
        ("participants", 500, None, "FAILED", 0),
        ("participants", 403, None, "FAILED", 0),
        ("participants", 200, "[]", "SUCCESS", 0),
        ("participants", 200, '{"other": 1}', "SUCCESS", 0),
        ("participants", 200, "12", "SUCCESS", 0),
        ("participants", 200, "{broken", "FAILED", 0),
        ("participants", 200, "[null]", "FAILED", 0),
        ("participants", 200, '[{"nom": "X", "numPmu": "abc"}]', "FAILED", 0),
        ("participants", 200, ' [{"nom": "X", "numPmu": 1}]', "SUCCESS", 1),
        ("performances", 200, "[]", "SKIPPED", 0),
        ("reports", 200, "[]", "SUCCESS", 0),
        ("reports", 200, "12", "FAILED", 0),
        ("programme", 200, '{"programme": {}}', "SUCCESS", 0),
        ("programme", 200, '{"programme": {"reunions": [{"nature": "TROT"}]}}', "FAILED", 0),
    ],
)
def test_outcomes(spark, feed, status, body, outcome, attempted):
    documents = parse_feed(landed(spark, (feed, 1, 1, status, body)), feed)["documents"]
    assert rows(documents, "status", "attempted") == [(outcome, attempted)]


def test_landing_and_documents(spark, tmp_path):
    landing = landed(spark, ("programme", None, None, 200, PROGRAMME), ("reports", 1, 1, 200, BETS))
    write_landing(landing, str(tmp_path / "landing"))
    back = read_landing(spark, str(tmp_path / "landing"), [DAY])
    assert rows(back.select(landing.columns)) == rows(landing)
    assert read_landing(spark, str(tmp_path / "landing"), ["18032019"]).count() == 0
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / f"{DAY}_R1_C4.json").write_text(json.dumps(RUNNERS, indent=2))
    got = read_documents(spark, str(docs), "participants")
    assert rows(got, "feed", "date_code", "meeting", "race") == [("participants", DAY, 1, 4)]
    assert parse_feed(got, "participants", 2024)["runners"].count() == 3


def test_update_mode_takes_latest_known_value(spark):
    target = spark.createDataFrame([(1, "a", 5, "kept"), (2, "b", None, None)], "k int, name string, rank int, note string")
    batch = spark.createDataFrame([(1, None, 7, 1), (1, "z", None, 2), (3, "c", 1, 1), (None, "n", 1, 1)], "k int, name string, rank int, seq int")
    got = loading.load_once(batch, target, ["k"], ["seq"], mode="update")
    assert rows(got) == sorted([(1, "z", 7, "kept"), (2, "b", None, None), (3, "c", 1, None), (None, "n", 1, None)], key=repr)


def test_loading_twice_adds_nothing(spark):
    batch = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 1, "c")], "k int, seq int, v string")
    first = loading.load_once(batch, batch.where("false"), ["k"], ["seq"])
    assert rows(first, "k", "v") == [(1, "a"), (2, "c")]
    assert loading.load_once(batch, first, ["k"], ["seq"]).count() == 0


@pytest.mark.parametrize("prune_by", ["k", None])
def test_pruning_by_the_range_of_the_batch_changes_nothing(spark, prune_by):
    target = spark.range(100).selectExpr("id as k", "0 as seq")
    batch = spark.createDataFrame([(98, 1), (99, 1), (100, 2), (100, 1), (None, 1)], "k bigint, seq int")
    got = loading.load_once(batch, target, ["k"], ["seq"], nullable_keys=True, prune_by=prune_by)
    assert rows(got) == [(100, 1), (None, 1)]
    nothing = loading.load_once(batch.where("k is null"), target, ["k"], ["seq"], nullable_keys=True, prune_by=prune_by)
    assert rows(nothing) == [(None, 1)]


def partition_filters(df):
    """What the plan's scans prune folders by, empty ones left out."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:] if part.split("]")[0]]


def test_history_is_laid_out_by_horse(spark, tmp_path):
    columns = ("history_id", "horse_id", "race_date", "discipline", "distance_m")
    history = empty_warehouse(spark)["horse_race_history"]
    new = spark.createDataFrame(
        [(1, 7, dt.date(2023, 5, 1), "ATTELE", 2100), (2, 60_000, dt.date(2024, 5, 1), "ATTELE", 2100), (3, 7, None, "MONTE", 1)],
        "history_id bigint, horse_id bigint, race_date date, discipline string, distance_m int",
    )
    create_warehouse(spark, str(tmp_path))
    append(history.unionByName(new, allowMissingColumns=True), str(tmp_path), "horse_race_history")
    tables = open_warehouse(spark, str(tmp_path))
    assert rows(tables["horse_race_history"], *columns) == rows(new)
    batch = new.where("history_id = 2")
    stored = near(tables, "horse_race_history", "horse_id", batch)
    assert rows(stored, "history_id") == [(2,)]
    again = loading.load_once(batch, stored, columns[1:], ["history_id"], nullable_keys=True)
    assert again.count() == 0
    assert "history_band#" in partition_filters(again)[0]
    dated = near(tables, "horse_race_history", "race_date", batch)
    assert rows(dated, "history_id") == [(2,)]
    assert tables.top("horse_race_history", "history_id") == 3


def test_split_rejects(spark):
    ok, bad = loading.split_rejects(spark.createDataFrame([(1,), (None,), (5,)], "v int"), F.col("v") < 3)
    assert (rows(ok), rows(bad)) == ([(1,)], [(5,), (None,)])


def test_scope(spark):
    assert [r["date_code"] for r in scope.date_scope(spark, "30122024", "02012025").collect()] == [
        "30122024", "31122024", "01012025", "02012025"]
    for bad in (("02012025", "01012025"), ("5112025", "06112025"), ("abc", "06112025")):
        with pytest.raises(ValueError):
            scope.date_scope(spark, *bad)
    assert scope.rolling_scope("01012025") == ["30122024", "31122024", "01012025"]


def test_stage_failure_does_not_stop_the_next(spark, tmp_path):
    broken = landed(spark, ("programme", None, None, 200, PROGRAMME)).drop("seq")
    out = run_stages(spark, broken, str(tmp_path / "w"), str(tmp_path / "d"), 2024, stages=("programme", "reports"))
    assert list(out) == ["programme", "reports"] and isinstance(out["programme"], Exception)


def test_update_mode_brings_late_values(spark, tmp_path):
    root, dead = str(tmp_path / "w"), str(tmp_path / "d")

    def runners(*people):
        return ("participants", 1, 1, 200, {"participants": list(people)})

    programme = ("programme", None, None, 200, PROGRAMME)
    before = landed(spark, programme, runners({"numPmu": 1, "nom": "Early"}, {"numPmu": 2, "nom": "Other", "sexe": "MALES"}))
    late = landed(
        spark, programme,
        runners(
            {"numPmu": 1, "nom": "Early", "age": 4, "sexe": "FEMELLES", "ordreArrivee": 2, "dernierRapportDirect": {"rapport": 7.5}},
            {"numPmu": 5, "nom": "New", "ordreArrivee": 1},
        ),
    )

    def run(landing, mode):
        out = run_stages(spark, landing, root, dead, 2024, stages=("programme", "participants"), mode=mode)
        assert not [e for e in out.values() if isinstance(e, Exception)]
        tables = open_warehouse(spark, root)
        assert checks.violations(tables).count() == 0
        return (
            rows(tables["race_participant"], "participant_id", "race_id", "pmu_number", "finish_rank", "live_odds"),
            rows(tables["horse"], "horse_id", "horse_name", "sex", "birth_year"),
        )

    first = run(before, "ignore")
    ids = {r[2]: r[0] for r in first[0]}
    got = run(late, "update")
    assert {r[2]: r[3:] for r in got[0]} == {1: (2, 7.5), 2: (None, None), 5: (1, None)}
    assert {k: v for k, v in ((r[2], r[0]) for r in got[0]) if k in ids} == ids
    assert got[1] == [(1, "Early", "F", 2020), (2, "Other", "M", None), (3, "New", None, None)]
    assert run(late, "update") == got


def test_update_replaces_only_folders_with_changes(spark, tmp_path):
    create_warehouse(spark, str(tmp_path))
    kind = "participant_id bigint, race_id bigint, horse_id bigint, pmu_number int, finish_rank int"
    whole = empty_warehouse(spark)["race_participant"]
    new = spark.createDataFrame([(1, 1, 1, 1, None), (2, 2, 1, 1, 4), (3, 5_000_000, 1, 1, None)], kind)
    append(whole.unionByName(new, allowMissingColumns=True), str(tmp_path), "race_participant")
    stored = open_warehouse(spark, str(tmp_path))["race_participant"]
    latest = spark.createDataFrame([(1, 1, 3), (2, 1, None), (5_000_000, 1, None)], "race_id bigint, pmu_number int, finish_rank int")
    again = loading.updated(stored, latest, "race_participant")
    assert rows(again, "participant_id", "finish_rank") == [(1, 3), (2, 4)]
    replace(again, str(tmp_path), "race_participant")
    stored = open_warehouse(spark, str(tmp_path))["race_participant"]
    assert rows(stored, "participant_id", "finish_rank") == [(1, 3), (2, 4), (3, None)]
    assert loading.updated(stored, latest, "race_participant") is None


def test_marks_are_made_without_lambdas_and_once(spark):
    tables = empty_warehouse(spark)
    race = [tuple({"race_id": i, "meeting_id": 7, "race_number": n}.get(c) for c in TABLES["race"].columns) for i, n in ((1, 1), (2, 1), (3, None))]
    tables["race"] = spark.createDataFrame(race, TABLES["race"].schema).repartition(2)
    bets = [tuple({"bet_id": i, "race_id": r, "bet_type": "SG", "bet_family": f}.get(c) for c in TABLES["race_bet"].columns) for i, r, f in ((1, 1, "M"), (2, 9, "F" * 99), (3, None, None))]
    tables["race_bet"] = spark.createDataFrame(bets, TABLES["race_bet"].schema).repartition(2)
    found = checks.violations(tables)
    got = {(r["table"], r["rule"], r["columns"].split(",")[0]): r["rows"] for r in found.collect()}
    assert got["race", "unique", "meeting_id"] == 1
    assert got["race", "foreign", "meeting_id"] == 3
    assert got["race_bet", "foreign", "race_id"] == 1
    assert [n for (table, rule, _), n in got.items() if (table, rule) == ("race_bet", "range")] == [1]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and plan.count("size(") == 1  # of the totals, a row for each domain


def test_a_table_without_rows_needs_no_range_of_the_batch(spark, tmp_path):
    """The batch of a first load is a whole chain of joins; here it fails if anyone reads it."""
    unread = spark.range(3).select(F.raise_error(F.lit("read")).cast("long").alias("race_id"))
    create_warehouse(spark, str(tmp_path))
    for tables in (empty_warehouse(spark), open_warehouse(spark, str(tmp_path))):
        assert near(tables, "race_participant", "race_id", unread).count() == 0
        assert near(tables, "bet_report", "bet_id", unread.withColumnRenamed("race_id", "bet_id")).count() == 0
