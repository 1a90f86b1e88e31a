"""A stored warehouse: whole commits, pruned reads, backfills that go on, ordered files."""

import datetime as dt
import glob
import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA, rows
from paddock.operators.ranking import write_ordered
from paddock.operators.scope import scoped, work_list
from paddock.plans import cards, loads
from paddock.schemas import TABLES
from paddock.sources import warehouse
from paddock.sources.derived import derived_tables
from paddock.sources.landing import LANDING
from paddock.sources.warehouse import LAYOUTS, append, create_warehouse, empty_table, in_ranges, latest, merged, open_warehouse, publish, replace

DAYS = [dt.date(2024, 3, 1), dt.date(2024, 3, 2), dt.date(2024, 3, 3)]
CODES = [day.strftime("%d%m%Y") for day in DAYS]


def table(spark, name, rows_):
    """Rows given as dicts of some columns."""
    schema = TABLES[name].schema
    return spark.createDataFrame([tuple(r.get(c) for c in schema.fieldNames()) for r in rows_], schema)


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    """Three days of two meetings of two races of three runners; each day's ids lie in bands of their own."""
    root = str(tmp_path_factory.mktemp("bands"))
    data = {name: [] for name in TABLES}
    for d, day in enumerate(DAYS):
        data["daily_program"].append({"program_id": d + 1, "program_date": day})
        for m in (1, 2):
            meeting = 10 * (d + 1) + m
            data["race_meeting"].append({"meeting_id": meeting, "program_id": d + 1, "meeting_number": m, "racetrack_code": f"T{m}"})
            for r in (1, 2):
                race = 3_000_000 * (d + 1) + 10 * m + r
                data["race"].append({"race_id": race, "meeting_id": meeting, "race_number": r, "discipline": "ATTELE"})
                data["race_bet"].append({"bet_id": race * 2, "race_id": race, "bet_type": "SG"})
                data["bet_report"].append({"report_id": race * 2, "bet_id": race * 2, "combination": "1"})
                for n in (1, 2, 3):
                    horse = 5_000_000 * (d + 1) + 100 * m + 10 * r + n
                    data["horse"].append({"horse_id": horse, "horse_name": f"H{horse}"})
                    data["race_participant"].append({"participant_id": race * 10 + n, "race_id": race, "horse_id": horse, "pmu_number": n})
                    for back in (30, 60):
                        past = {"history_id": race * 100 + n * 10 + back // 30, "horse_id": horse, "race_date": day - dt.timedelta(days=back)}
                        data["horse_race_history"].append({**past, "discipline": "ATTELE", "distance_m": 2000, "prize_money": 5.0, "reduction_km": 1.5})
    create_warehouse(spark, root)
    publish(spark, root, {name: table(spark, name, some) for name, some in data.items()})
    return root


def scans(df):
    """For each scan of a laid out table: its folder filter, and the folders it lists."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = {}
    for line in plan.split("\n"):
        for name, layout in LAYOUTS.items():
            if "FileScan parquet" in line and f"/{name}/" in line:
                found[name] = line.split("PartitionFilters: [")[1].split("]")[0]
                assert layout.folder in found[name], (name, line)
    return found


def files_of(df):
    return {name: sorted({f.split(f"{layout.folder}=")[1].split("/")[0] for f in df.inputFiles() if f"/{name}/" in f}) for name, layout in LAYOUTS.items()}


@pytest.mark.parametrize("scope", ["day", "race"])
def test_scoped_reads_open_only_the_folders_of_the_scope(spark, root, scope):
    tables = open_warehouse(spark, root)
    if scope == "day":
        inputs = cards.daily_features(tables, [CODES[1]])
        bets = scoped(tables, [CODES[1]])
    else:
        inputs = cards.race_features(tables, [6_000_011, 6_000_022])
        bets = scoped(tables, races=[6_000_011, 6_000_022])
    expected = 12 if scope == "day" else 6
    assert inputs.count() == expected
    assert {r["hist_races"] for r in inputs.collect()} == {2}
    assert set(scans(inputs)) == {"race", "race_participant", "horse", "horse_race_history"}
    opened = files_of(inputs)
    assert opened["race"] == opened["race_participant"] == ["6"]
    assert opened["horse"] == ["10"] and opened["horse_race_history"] == ["200"]
    assert scans(bets["race_bet"]) and scans(bets["bet_report"])
    assert files_of(bets["race_bet"])["race_bet"] == ["6"] and files_of(bets["bet_report"])["bet_report"] == ["12"]
    assert bets["bet_report"].count() == 4


def test_scoped_results_are_those_of_a_whole_read(spark, root):
    tables = open_warehouse(spark, root)
    whole = dict(tables)  # a plain mapping is read whole
    for dates in ([CODES[0]], [CODES[0], CODES[2]], ["31122030"], ["99999999"], []):
        for plan in (cards.races_by_date, cards.daily_features):
            assert rows(plan(tables, dates)) == rows(plan(whole, dates))
        assert rows(work_list(tables, dates)) == rows(work_list(whole, dates))
    for races in ([3_000_011], [3_000_011, 9_000_022, 5], [5], []):
        for plan in (cards.race_features, cards.participants_by_race):
            assert rows(plan(tables, races)) == rows(plan(whole, races))
    day = cards.card_of_meeting(tables, CODES[2], 2)
    assert [tuple(r) for r in day.select("meeting_number", "race_number").collect()] == [(2, 1), (2, 2)]
    assert cards.card_of_meeting(tables, CODES[2], 7).count() == cards.card_of_meeting(tables, "00000000", 1).count() == 0


def test_ranges_are_merged_and_kept_few():
    assert merged([(5, 6), (1, 2), (3, 4), (9, 9)]) == [(1, 6), (9, 9)]
    assert merged([(i * i, i * i) for i in range(10)], most=3) == [(0, 49), (64, 64), (81, 81)]
    assert merged([]) == []


def broken(df):
    """The same rows, of which the last one cannot be computed."""
    return df.withColumn("meeting_type", F.raise_error(F.lit("executor lost")).cast("string"))


def test_many_ranges_are_searched_not_tried_in_turn(spark):
    spans = [(7 * i, 7 * i + i % 4) for i in range(200)]
    numbers = [None, -1, 0, 1, 2, *range(0, 1500), 10**12]
    df = spark.createDataFrame([(n,) for n in numbers], "n long")
    for some in (spans, spans[::-1], spans[:1], spans[:2], spans[:3], [(5, 9), (0, 6), (20, 30), (8, 12)], []):
        want = sorted(n for n in numbers if n is not None and any(low <= n <= high for low, high in some))
        assert sorted(r[0] for r in df.where(in_ranges(F.col("n"), some)).collect()) == want
    # A row meets one branch of each choice, so the comparisons on its way are the depth of the tree.
    def depth(e):
        below = max((depth(e.children().apply(i)) for i in range(e.children().size())), default=0)
        return below + (e.nodeName() == "CaseWhen")

    kept = df.where(in_ranges(F.col("n"), spans))._jdf.queryExecution().analyzed()
    assert depth(kept.condition()) in range(6, 9)


def test_a_folder_is_written_by_few_tasks(spark, tmp_path):
    """Rows dealt over many tasks, each with rows of every folder, make a file for each folder, not for each task and folder."""
    root = str(tmp_path / "few")
    create_warehouse(spark, root)
    races = spark.range(0, 400, 1, 16).select(((F.col("id") * 37 % 5) * 1_000_000 + F.col("id")).alias("race_id"), F.col("id").alias("n"))
    rows_ = races.select(*[(F.col("race_id") if f.name == "race_id" else F.col("n") if f.name == "participant_id" else F.lit(None)).cast(f.dataType).alias(f.name) for f in TABLES["race_participant"].schema.fields])
    assert publish(spark, root, {"race_participant": rows_}) == {"race_participant": 400}
    files = glob.glob(f"{root}/race_participant/*/*/*.parquet")
    assert len({f.rsplit("/", 2)[1] for f in files}) == len(files) == 5
    assert rows(open_warehouse(spark, root)["race_participant"], "participant_id") == sorted([(n,) for n in range(400)], key=repr)


def test_a_run_that_dies_leaves_the_old_state(spark, tmp_path):
    root = str(tmp_path)
    create_warehouse(spark, root)
    day = table(spark, "daily_program", [{"program_id": 1, "program_date": DAYS[0]}])
    meeting = table(spark, "race_meeting", [{"meeting_id": 1, "program_id": 1, "meeting_number": 4}])
    publish(spark, root, {"daily_program": day, "race_meeting": meeting})
    more = table(spark, "daily_program", [{"program_id": 2, "program_date": DAYS[1]}])
    later = table(spark, "race_meeting", [{"meeting_id": 1, "program_id": 1, "meeting_number": 5}])
    # It dies after the first table is written, while a table without folders is replaced.
    with pytest.raises(Exception, match="executor lost"):
        publish(spark, root, {"daily_program": more}, {"race_meeting": broken(later)})
    tables = open_warehouse(spark, root)
    assert rows(tables["daily_program"], "program_id") == [(1,)] and rows(tables["race_meeting"], "meeting_number") == [(4,)]
    # A reader that opened it before sees its own state, a later one the new state, and the rows may come from the table itself.
    replace(tables["race_meeting"].unionByName(later), root, "race_meeting")
    assert rows(tables["race_meeting"], "meeting_number") == [(4,)]
    assert rows(open_warehouse(spark, root)["race_meeting"], "meeting_number") == [(4,), (5,)]


def test_a_run_that_dies_before_the_manifest_is_not_seen(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    append(table(spark, "daily_program", [{"program_id": 1, "program_date": DAYS[0]}]), root, "daily_program")

    def dies(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(warehouse, "_put", dies)
        with pytest.raises(RuntimeError, match="driver lost"):
            append(table(spark, "daily_program", [{"program_id": 2, "program_date": DAYS[1]}]), root, "daily_program")
    assert rows(open_warehouse(spark, root)["daily_program"], "program_id") == [(1,)]
    append(table(spark, "daily_program", [{"program_id": 3, "program_date": DAYS[2]}]), root, "daily_program")
    assert rows(open_warehouse(spark, root)["daily_program"], "program_id") == [(1,), (3,)]


def test_the_second_of_two_runs_from_one_state_fails(spark, tmp_path):
    root = str(tmp_path)
    create_warehouse(spark, root)
    base = latest(spark, root)
    one = table(spark, "daily_program", [{"program_id": 1, "program_date": DAYS[0]}])
    publish(spark, root, {"daily_program": one}, base=base)
    with pytest.raises(warehouse.LostRace):
        publish(spark, root, {"daily_program": one}, base=base)
    assert open_warehouse(spark, root)["daily_program"].count() == 1


def test_empty_tables_and_null_ids(spark, tmp_path):
    root = str(tmp_path)
    publish(spark, root, {name: empty_table(spark, name) for name in TABLES})
    tables = open_warehouse(spark, root)
    assert all(df.count() == 0 for df in tables.values()) and tables.top("race", "race_id") == 0
    append(table(spark, "horse", [{"horse_id": None, "horse_name": "No id"}, {"horse_id": 3, "horse_name": "A"}]), root, "horse")
    assert rows(open_warehouse(spark, root)["horse"], "horse_name") == [("A",), ("No id",)]


def programme(day, number):
    race = {"numOrdre": 1, "discipline": "MONTE", "distance": 2400}
    meeting = {"numOfficiel": number, "nature": "TROT", "courses": [race]}
    return {"programme": {"date": None, "reunions": [meeting]}}


def test_backfill_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    root, dead = str(tmp_path / "w"), str(tmp_path / "d")
    docs = []
    for i, code in enumerate(CODES):
        docs.append(("programme", code, None, None, 200, json.dumps(programme(code, 1)), i))
        docs.append(("participants", code, 1, 1, 200, json.dumps([{"numPmu": 1, "nom": f"Horse {i}"}, {"numPmu": 2, "nom": "Both"}]), i))
    docs.append(("participants", CODES[0], 1, 1, 200, "{broken", 9))
    landing = spark.createDataFrame(docs, LANDING)
    options = {"run": "spring", "days_a_load": 1, "stages": ("programme", "participants")}
    real, calls = loads.publish, []

    def dies_at_the_fourth(*args, **kwargs):
        calls.append(1)
        if len(calls) >= 4:
            raise KeyboardInterrupt
        return real(*args, **kwargs)

    with monkeypatch.context() as patched:
        patched.setattr(loads, "publish", dies_at_the_fourth)
        with pytest.raises(KeyboardInterrupt):
            loads.backfill(spark, landing, root, dead, 2024, CODES, **options)
    left = loads.pending(spark, root, CODES, **options)
    assert left == [(CODES[1], "participants"), (CODES[2], "programme"), (CODES[2], "participants")]
    assert open_warehouse(spark, root)["race_participant"].count() == 2
    with monkeypatch.context() as patched:
        parsed = []
        real_load = loads.load_program
        patched.setattr(loads, "load_program", lambda *args: parsed.append(1) or real_load(*args))
        out = loads.backfill(spark, landing, root, dead, 2024, CODES, **options)
        assert len(parsed) == 1  # the first two days' programmes are not read again
    assert not [e for e in out.values() if isinstance(e, Exception)] and len(out) == 6
    assert loads.pending(spark, root, CODES, **options) == []
    tables = open_warehouse(spark, root)
    assert tables["race_participant"].count() == 6 and tables["horse"].count() == 4
    assert rows(tables["race"], "race_id") == [(1,), (2,), (3,)]
    first = {(r["status"]): (r["documents"], r["attempted"], r["inserted"]) for r in out[CODES[0], "participants"].collect()}
    assert first == {"SUCCESS": (1, 2, 2), "FAILED": (1, 0, 0)}
    assert spark.read.json(dead).count() == 1


def test_ordered_files(spark, tmp_path):
    tables = derived_tables(spark, TESTDATA)
    path = str(tmp_path / "ordered")
    write_ordered(cards.races_by_date(tables), path, "program_date", "meeting_number", "race_number")
    places = [p for f in sorted(glob.glob(f"{path}/*.parquet")) for p in pq.read_table(f)["position"].to_pylist()]
    assert places == list(range(1, len(places) + 1)) and len(places) == tables["race"].count()


def test_loads_read_only_the_folders_of_their_batch(spark, root):
    tables = open_warehouse(spark, root)
    batch = tables["horse_race_history"].where(f"horse_id between 10000000 and 10000999").drop("history_band")
    near = warehouse.near(tables, "horse_race_history", "horse_id", batch)
    assert files_of(near)["horse_race_history"] == ["200"] and scans(near)
    races = tables["race"].where("race_id > 9000000").drop("race_band")
    assert files_of(warehouse.near(tables, "race", "meeting_id", races))["race"] == ["9"]


def test_documents_that_did_not_change_are_not_parsed_again(spark, tmp_path, monkeypatch):
    root, dead = str(tmp_path / "w"), str(tmp_path / "d")

    def landed(odds):
        docs = [("programme", CODES[0], None, None, 200, json.dumps(programme(CODES[0], 1)), 1)]
        runners = [{"numPmu": 1, "nom": "A", "dernierRapportDirect": {"rapport": odds}}]
        docs.append(("participants", CODES[0], 1, 1, 200, json.dumps(runners), 2))
        docs.append(("performances", CODES[0], 1, 1, 200, json.dumps([{"nom": "A", "coursesCourues": [{"discipline": "MONTE"}]}]), 3))
        docs.append(("reports", CODES[0], 1, 1, 200, "{broken", 4))
        return spark.createDataFrame(docs, LANDING)

    def run(odds, mode="ignore"):
        out = loads.run_stages(spark, landed(odds), root, dead, 2024, CODES[:1], mode=mode, skip_unchanged=True)
        assert not [e for e in out.values() if isinstance(e, Exception)]
        return {(r["feed"], r["status"]): (r["documents"], r["inserted"]) for a in out.values() for r in a.collect()}

    first = run(2.0)
    assert first == {
        ("programme", "SUCCESS"): (1, 1), ("participants", "SUCCESS"): (1, 1), ("performances", "SUCCESS"): (1, 1), ("reports", "FAILED"): (1, 0),
    }
    number = latest(spark, root).number
    with monkeypatch.context() as patched:
        patched.setattr(loads, "parse_feed", lambda *args, **kwargs: pytest.fail("parsed again"))
        assert run(2.0) == {(feed, "UNCHANGED"): (1, 0) for feed in loads.STAGES}
    # Nothing was written: neither rows, nor rejected documents, nor a commit.
    assert latest(spark, root).number == number
    assert open_warehouse(spark, root)["horse_race_history"].count() == 1 and spark.read.json(dead).count() == 1
    # A changed document alone is loaded; in another mode all are.
    assert run(3.0)[("participants", "SUCCESS")] == (1, 0) and open_warehouse(spark, root)["race_participant"].first()["live_odds"] == 2.0
    late = run(3.0, mode="update")
    assert ("participants", "SUCCESS") in late and ("participants", "UNCHANGED") not in late
    assert open_warehouse(spark, root)["race_participant"].first()["live_odds"] == 3.0
    assert run(3.0, mode="update") == {(feed, "UNCHANGED"): (1, 0) for feed in loads.STAGES}
