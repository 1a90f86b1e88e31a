"""What a job stores on the way is deleted when nothing reads it any more, and is narrow while it is there."""

import json
from pathlib import Path

import pytest
from conftest import TESTDATA, rows
from pyspark.sql import functions as F

from paddock.ml import training
from paddock.ml.encoding import OrdinalEncoder
from paddock.operators import loading, ranking
from paddock.plans import cards, loads
from paddock.session import packed, released, scratch, settled, shared_folder
from paddock.sources.landing import LANDING
from paddock.sources.warehouse import open_warehouse
from registry.queries import QUERIES


def folders(spark) -> set[str]:
    return {p.name for p in Path(shared_folder(spark).removeprefix("file:")).glob("staged-*")}


def test_scratch_ends_with_what_was_packed_in_it(spark):
    before = folders(spark)
    with scratch(spark):
        assert packed(spark.range(5)).count() == 5 and len(folders(spark) - before) == 1
    assert folders(spark) == before
    kept = settled(spark, lambda: {"rows": packed(spark.range(5)).where("id > 1")})["rows"]
    assert kept.count() == 3 and len(folders(spark) - before) == 1
    released(kept)
    with pytest.raises(ValueError), scratch(spark):
        packed(spark.range(5))
        raise ValueError
    assert folders(spark) == before


def test_a_settled_result_ends_with_the_scratch_around_it(spark):
    before = folders(spark)
    with scratch(spark):
        assert settled(spark, lambda: {"rows": packed(spark.range(5))})["rows"].count() == 5
    assert folders(spark) == before


def test_shuffle_files_end_with_their_write(spark):
    from paddock.session import DROP_SHUFFLES

    seen = []

    def make():
        seen.append(spark.conf.get(DROP_SHUFFLES))
        return {}

    before = spark.conf.get(DROP_SHUFFLES)
    settled(spark, make)
    assert seen == ["true"] and spark.conf.get(DROP_SHUFFLES) == before


CODE = "05112025"


def landed(spark, odds: float = 2.0):
    race = {"numOrdre": 1, "discipline": "ATTELE", "distance": 2700}
    programme = {"programme": {"date": None, "reunions": [{"numOfficiel": 1, "courses": [race]}]}}
    runners = [{"numPmu": n, "nom": f"Horse {n}", "dernierRapportReference": {"rapport": odds}} for n in (1, 2)]
    docs = [
        ("programme", CODE, None, None, 200, json.dumps(programme), 1),
        ("participants", CODE, 1, 1, 200, json.dumps(runners), 2),
        ("participants", CODE, 1, 1, 200, "[{", 3),
    ]
    return spark.createDataFrame(docs, LANDING)


def test_a_backfill_leaves_nothing_but_its_tables(spark, tmp_path):
    before = folders(spark)
    out = loads.run_stages(spark, landed(spark), str(tmp_path / "w"), str(tmp_path / "d"), 2024)
    assert not any(isinstance(result, Exception) for result in out.values())
    assert open_warehouse(spark, str(tmp_path / "w"))["race_participant"].count() == 2
    assert folders(spark) == before


def test_unchanged_documents_are_not_stored_again(spark, tmp_path, monkeypatch):
    """Only keys and digests are looked at, and a first load has no ledger to look into."""
    root, dead = str(tmp_path / "w"), str(tmp_path / "d")
    joined = []
    ledger = loads._ledger
    monkeypatch.setattr(loads, "_ledger", lambda *args: joined.append(ledger(*args)) or joined[-1])

    def run(odds):
        out = loads.run_stages(spark, landed(spark, odds), root, dead, 2024, stages=("programme", "participants"), skip_unchanged=True)
        return sorted((r["feed"], r["status"], r["documents"]) for lines in out.values() for r in lines.collect())

    assert run(2.0) == [("participants", "FAILED", 1), ("participants", "SUCCESS", 1), ("programme", "SUCCESS", 1)]
    assert joined[0] is None
    stored, before = [], folders(spark)
    monkeypatch.setattr(loads, "packed", lambda df: stored.append(df.columns) or packed(df))
    assert run(2.0) == [("participants", "UNCHANGED", 2), ("programme", "UNCHANGED", 1)]
    assert not stored and folders(spark) == before
    # One document differs and is loaded, the two others are not.
    assert run(3.0) == [("participants", "SUCCESS", 1), ("participants", "UNCHANGED", 1), ("programme", "UNCHANGED", 1)]


@pytest.mark.parametrize("whole_rows", [10**6, 0])
def test_numbering_stores_rows_once(spark, whole_rows):
    before = folders(spark)
    names = spark.range(3000).select(F.expr("nullif(id, 7)").alias("name"), "id")
    got = ranking.number_all(names, "name", "k", 10, whole_rows)
    assert rows(got, "k") == rows(spark.range(11, 3011).toDF("k"))
    assert got.where("name is null").first()["k"] == 11
    assert got.where("name is not null and k != if(id < 7, id + 12, id + 11)").count() == 0
    assert len(folders(spark) - before) == 1


@pytest.mark.parametrize("repeats", [0, 1, 9])
def test_latest_stored_is_latest_known(spark, repeats):
    data = [(k, 0, f"a{k}", None) for k in range(10)] + [(None, i, "n", 1) for i in range(2)]
    data += [(k, 1, None, k) for k in range(repeats)] + [(k, 2, "late" if k % 2 else None, None) for k in range(repeats)]
    batch = spark.createDataFrame(data, "k int, seq int, name string, n int")
    got = loading.latest_stored(batch, ["k"], ["seq"])
    plain = loading.latest_known(batch, ["k"], ["seq"])
    assert rows(got, "k", "name", "n") == rows(plain, "k", "name", "n")


def test_features_are_kept_without_their_races(spark, tables):
    seen = []
    kept = cards.daily_features(tables, keep=lambda df: seen.append(df.columns) or packed(df))
    plain = cards.daily_features(tables)
    key = ("race_id", "program_number", "horse_name", "racetrack_code", "jockey_name", "trainer_name", "hist_races")
    assert kept.columns == plain.columns and rows(kept, *key) == rows(plain, *key)
    assert len(seen) == 1 and not {"program_date", "racetrack_code", "horse_id"} & set(seen[0])


def test_engineered_features_store_no_race(spark):
    before = folders(spark)
    QUERIES["engineered_features"](spark, TESTDATA)
    at = shared_folder(spark)
    stored = [spark.read.parquet(f"{at}/{name}").columns for name in folders(spark) - before]
    assert len(stored) == 1 and "program_date" not in stored[0]


def test_training_leaves_nothing_stored(spark, tables):
    before = folders(spark)
    trained = training.train(tables, training.TrainParams(rounds=2, depth=2, bins=32))
    assert folders(spark) == before
    # The model needs nothing of what it was trained on.
    scored = training.score(cards.daily_features(tables), trained.model)
    assert scored.where("win_probability is null").count() == 0


def test_prediction_store_leaves_its_rows_only(spark):
    before = folders(spark)
    QUERIES["prediction_store"](spark, TESTDATA)
    assert len(folders(spark) - before) == 1


def test_many_codes_are_broadcast(spark):
    names = spark.range(12_000).select(F.col("id").cast("string").alias("name"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        coded = OrdinalEncoder(inputCols=["name"]).fit(names).transform(names)
        assert "BroadcastHashJoin" in coded._jdf.queryExecution().executedPlan().toString()
        assert coded.agg(F.countDistinct("name_code")).first()[0] == 12_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
