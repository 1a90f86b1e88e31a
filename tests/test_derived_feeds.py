import datetime as dt
import json

import pytest

from conftest import rows
from paddock.plans import loads
from paddock.sources import derived_feeds as feeds
from paddock.sources.feeds import parse_feed
from paddock.sources.warehouse import empty_warehouse

TURN = feeds.RACE_NUMBERS * feeds.MEETING_TURNS
# Race 10 of the first meetings on each turn, and keys near the turns and far above.
KEYS = [10, TURN + 10, 2 * TURN + 10, TURN - 9, TURN + 1, 200_000_005, 200_000_007, 1_500_000_002, 150_000_000_010]


def _orders(spark, keys):
    rows = [(o, 7, dt.datetime(1995 + i % 7, 3, 1)) for i, o in enumerate(keys)]
    return spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz")


def _sound(key):
    return all(key % n for n in (17, 19, 23, 29))


def test_large_order_keys_keep_their_races(spark):
    keys = [o for o in KEYS if _sound(o)]
    assert sum(o > 200_000_000 for o in keys) >= 3
    orders = _orders(spark, keys)
    landing = feeds.programme_documents(orders)
    assert {r["status"] for r in parse_feed(landing, "programme")["documents"].collect()} == {"SUCCESS"}

    tables = empty_warehouse(spark)
    rows = loads.load_program(landing, tables).rows
    assert rows["race"].count() == sum(o % 5 < 3 for o in keys)

    lines = spark.createDataFrame([(o,) for o in keys], "l_orderkey long")
    places = feeds.located(lines, orders).select("date_code", "meeting", "race").collect()
    assert len(set(places)) == len(keys)
    parsed = parse_feed(landing, "programme")["races"].collect()
    told = {(r["program_date"].strftime("%d%m") + f"{r['program_date'].year:04d}", r["meeting_number"], r["race_number"]) for r in parsed}
    assert len(told) == sum(o % 5 < 3 for o in keys) and told <= {tuple(p) for p in places}


def test_invalid_date_code_leaves_the_later_day_to_the_payload(spark):
    key = next(o for o in range(TURN + 1, TURN + 999) if o % 13 == 0 and o % 5 < 3 and _sound(o))
    parsed = parse_feed(feeds.programme_documents(_orders(spark, [key])), "programme")["races"].collect()
    assert [r["program_date"] for r in parsed] == [dt.date(1995, 3, 1) + dt.timedelta(feeds.DAYS_PER_TURN)]


def test_keys_without_a_day_are_an_error(spark):
    with pytest.raises(Exception, match="no day for order"):
        feeds.programme_documents(_orders(spark, [10**12])).collect()


def test_documents_of_all_feeds_group_the_lines_once(spark):
    line = "o long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_tax double, l_returnflag string, l_shipdate timestamp_ntz"
    # A race of even and one of odd key, a repeated line, nulls, a broken document (23), a failed one (17).
    data = [(o, part, 3, n, 5.0, 10.0, 0.0, "R", dt.datetime(1996, 2, n)) for o in (2, 5, 17, 23) for part, n in ((6, 2), (6, 2), (60, 1))]
    data += [(5, None, None, 4, None, None, None, None, None)]
    lines = spark.createDataFrame(data, line).withColumnRenamed("o", "l_orderkey")
    lines = feeds.located(lines, _orders(spark, [2, 5, 17, 23]))
    together = feeds.documents_of_races(lines)
    apart = feeds.participants_of_races(lines).unionByName(feeds.performances_of_races(lines)).unionByName(feeds.reports_of_races(lines))
    assert together.columns == apart.columns and rows(together) == rows(apart)
    held = {(r["feed"], r["seq"]): r["payload"] for r in together.collect()}
    assert len(held) == 12 and held["reports", 17] is None and len(held["participants", 23]) == 20
    names = ["", "Horse 6", "Horse 6"]
    assert [x["nom"] for x in json.loads(held["participants", 2])["participants"]] == names
    assert [x["nom"] for x in json.loads(held["participants", 5])] == [*names, None]
    assert [x["numPmu"] for x in json.loads(held["participants", 5])] == [1, 2, 2, 4]
    assert together._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 1
