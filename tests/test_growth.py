"""What keeps the cost of a document low: compiled stages, one search per past race, one choice among repeated lines."""

import json

from pyspark.sql import functions as F

from paddock.session import tune
from paddock.sources.feeds import judged, parse_feed
from registry.queries import _all_landed

DATA = "/root/testdata/sf0.001"
LANDING = "feed string, date_code string, meeting int, race int, http_status int, payload string, seq bigint"


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _past(spark, *races: dict):
    rows = [("performances", "01012000", 1, 1, 200, json.dumps([{"nom": "A", "coursesCourues": [r]}]), i) for i, r in enumerate(races)]
    return spark.createDataFrame(rows, LANDING)


def test_stages_too_large_to_compile_are_not_fused(spark):
    tune(spark)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_the_runner_of_a_past_race_is_searched_for_once(spark):
    # The plan names the search once for the tests of a past race, before it did so for every test.
    known = judged(_past(spark, {"discipline": "ATTELE"}), "performances").select("status")
    spark.conf.set("spark.sql.maxToStringFields", "10000")
    assert _plan(known).count("filter(") <= 1


def test_past_races_are_judged_as_before(spark):
    him = {"itsHim": True, "place": {"place": 2, "statusArrivee": "ARRIVE"}, "corde": "3"}
    races = [
        {"discipline": "ATTELE", "participants": [{"itsHim": False, "corde": "n/a"}, him]},
        {"discipline": "ATTELE", "participants": [{**him, "corde": "n/a"}]},
        {"discipline": "ATTELE", "participants": [{**him, "place": {"place": 99_999}}]},
        {"discipline": "ATTELE", "participants": [{"itsHim": False}]},
        {"discipline": "ATTELE", "participants": None},
        {"discipline": "PLAT", "participants": [{**him, "corde": "n/a"}]},
        {"discipline": "ATTELE", "participants": [{"itsHim": True}]},
    ]
    documents = parse_feed(_past(spark, *races), "performances")["documents"]
    status = [row["status"] for row in documents.orderBy("seq").collect()]
    assert status == ["SUCCESS", "FAILED", "FAILED", "SUCCESS", "SUCCESS", "SUCCESS", "SUCCESS"]


def test_repeated_lines_are_chosen_among_once_for_all_feeds(spark):
    landed = _all_landed(spark, DATA)
    for feed in ("participants", "performances", "reports"):
        assert "Window" not in _plan(landed[feed].select(F.col("seq")))
