import datetime as dt

import pytest
from pyspark.sql import functions as F

from paddock.functions import codes, display, features, parsing


def one(spark, value, column, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(column(F.col("x")).alias("y")).first()[0]


@pytest.mark.parametrize("cents, euros", [("1250", 12.5), ("0", 0.0), ("500", 5.0), (None, None), ("invalid", None), ("NaN", None)])
def test_euros(spark, cents, euros):
    assert one(spark, cents, parsing.euros) == euros


def test_cut_and_overflow(spark):
    assert one(spark, "short", lambda c: parsing.cut(c, 10)) == "short"
    assert one(spark, "this is a very long string", lambda c: parsing.cut(c, 5)) == "this "
    assert one(spark, "this is a very long string", lambda c: parsing.overflows(c, 5)) is True
    assert one(spark, None, lambda c: parsing.overflows(c, 5)) is False


@pytest.mark.parametrize(
    "text, value", [("3,5", 3.5), ("4.25", 4.25), ("dur", None), (None, None), ("1,2,3", None)]
)
def test_comma_number(spark, text, value):
    assert one(spark, text, parsing.comma_number) == value


@pytest.mark.parametrize("text, value", [("12", 12), ("12.0", 12), (" 7 ", 7), ("x", None), ("-3", -3)])
def test_whole(spark, text, value):
    assert one(spark, text, parsing.whole) == value


@pytest.mark.parametrize("millis, s", [("1999", 1), ("0", None), (None, None), ("-1", -1), ("150000", 150)])
def test_seconds_round_down(spark, millis, s):
    assert one(spark, millis, parsing.seconds) == s


def test_dates(spark):
    assert one(spark, "1704067200000", parsing.day_of_millis) == dt.date(2024, 1, 1)
    assert one(spark, "0", parsing.day_of_millis) is None
    assert one(spark, "25102023", parsing.day_of_code) == dt.date(2023, 10, 25)
    assert one(spark, "5112025", parsing.day_of_code) is None
    assert one(spark, "32012025", parsing.day_of_code) is None
    assert one(spark, dt.date(2023, 10, 25), parsing.code_of_day, "date") == "25102023"


def test_program_day_falls_back_to_payload(spark):
    def day(code):
        return one(spark, code, lambda c: parsing.program_day(c, F.lit("1704067200000")))

    assert day("02022024") == dt.date(2024, 2, 2)
    assert day("nonsense") == dt.date(2024, 1, 1)
    assert one(spark, "nonsense", lambda c: parsing.program_day(c, F.lit(None).cast("string"))) is None


def test_sex_and_birth_year(spark):
    assert one(spark, "males", parsing.sex_code) == "M"
    assert one(spark, "", parsing.sex_code) is None
    assert one(spark, "5", lambda c: parsing.birth_year(c, 2025)) == 2020
    assert one(spark, "0", lambda c: parsing.birth_year(c, 2025)) is None


@pytest.mark.parametrize(
    "column, label, code",
    [
        (codes.race_status, "FIN_COURSE", "FIN"),
        (codes.race_status, "SOMETHING_ELSE", "SOMETHING_"),
        (codes.race_status, None, None),
        (codes.track_type, "CENDREE", "C"),
        (codes.incident, "AN_INCIDENT_WITH_A_LONG_NAME", "AN_INCIDENT_WITH_A_L"),
        (codes.shoeing, "REFERRE_ANTERIEURS_POSTERIEURS", "R4"),
        (codes.bet_type, "DEUX_SUR_QUATRE", "2S4"),
        (codes.bet_type, "", None),
    ],
)
def test_codes(spark, column, label, code):
    assert one(spark, label, column) == code


def test_trot_in_any_case(spark):
    got = [one(spark, d, codes.is_trot) for d in ("attele", "MONTE", "PLAT", None)]
    assert got == [True, True, False, False]


def test_odds(spark):
    assert one(spark, None, features.clean_odds, "double") == 1.05
    assert one(spark, float("nan"), features.clean_odds, "double") == 1.05
    assert one(spark, 1.01, features.clean_odds, "double") == 1.05
    assert one(spark, 7.0, features.clean_odds, "double") == 7.0


@pytest.mark.parametrize("value", [0.25, 0.75, 1.25, 12.5, 0.3, 19.96, 100.0, -2.25])
def test_one_decimal_as_python_prints_it(spark, value):
    assert one(spark, value, display.one_decimal, "double") == f"{value:.1f}"


def test_labels(spark):
    assert one(spark, 0.1, display.signed_percent, "double") == "+10.0%"
    assert one(spark, None, lambda c: display.meeting_label(F.lit(1), c)) == "R1 - None"
    assert one(spark, "VINC", lambda c: display.meeting_label(F.lit(2), c)) == "R2 - VINC"
    assert one(spark, "Flash", lambda c: display.runner_tag(F.lit(4), c)) == "#4 Flash"


def test_place_parts_of_bare_values_are_not_parsed(spark):
    places = [('{"place":3,"statusArrivee":"OK"}', "3"), (' {"place":"x{"}', "x{"), ('[{"place":1}]', None), ("7", None), ("{", None), ("", None), (None, None)]
    df = spark.createDataFrame(places, "text string, expected string")
    found = df.select("expected", parsing.place_part(F.col("text"), "place").alias("found")).collect()
    assert all(r["found"] == r["expected"] for r in found)
    # The check of a past runner reads the place once and its status once.
    from paddock.sources.feeds import _past_runner_fails

    him = spark.createDataFrame([], "him struct<place:string,poidsJockey:string,corde:string,reductionKilometrique:string,distanceParcourue:string>")
    plan = him.select(_past_runner_fails(F.col("him")).alias("fails"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("get_json_object") == 2 and plan.count("Contains(") == 2
