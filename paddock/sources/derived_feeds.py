"""Landed JSON documents derived from orders and line items, one per source row.

They cover the shapes the feeds come in: object and bare-array documents, numbers
as text, polymorphic places, unknown labels, HTTP failures, broken JSON and
values that do not fit the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.functions.parsing import code_of_day
from paddock.sources.landing import LANDING

# Race and meeting numbers have to fit 16 bits, so large order keys wrap around: what exceeds RACE_NUMBERS
# counts on in the meeting, what exceeds its MEETING_TURNS in the day, by more days than the orders span.
RACE_NUMBERS = 30_000
MEETING_TURNS = 6_553
DAYS_PER_TURN = 2_500

# Where a line stands in its race's document; lines with all of these equal are equal there.
SLOT_ORDER_IN_DOCUMENT = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_quantity", "l_tax", "l_returnflag"]


def _quoted(text: Column) -> Column:
    return F.coalesce(F.concat(F.lit('"'), text, F.lit('"')), F.lit("null"))


def _bare(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("null"))


def _object(**fields: Column) -> Column:
    parts = [F.concat(F.lit(f'"{name}":'), value) for name, value in fields.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _array(*items: Column) -> Column:
    return F.concat(F.lit("["), F.concat_ws(",", *items), F.lit("]"))


def _one_of(index: Column, *texts: str | None) -> Column:
    return F.element_at(F.array(*[F.lit(t).cast("string") for t in texts]), (index + 1).cast("int"))


def http_status(key: Column) -> Column:
    return F.when(key % 17 == 0, 404).when(key % 19 == 0, 500).otherwise(200)


def _landing(df: DataFrame, feed: str | Column, key: Column, payload: Column) -> DataFrame:
    """Rows of (date_code, meeting, race, seq) and a payload, some of them failed or broken."""
    status = http_status(key)
    sent = F.when(status != 200, F.lit(None)).when(key % 23 == 0, F.left(payload, F.lit(20))).otherwise(payload)
    landed = df.select(
        F.lit(feed).alias("feed"),
        "date_code",
        F.col("meeting").cast("int"),
        F.col("race").cast("int"),
        status.alias("http_status"),
        sent.cast("string").alias("payload"),
        F.col("seq").cast("bigint"),
    )
    assert landed.columns == [field.split()[0] for field in LANDING.split(", ")]
    return landed


def _turn(order: str) -> Column:
    return F.floor(F.col(order) / RACE_NUMBERS)


def meeting_of(customer: str, order: str) -> Column:
    """The meeting of an order, which fits 16 bits."""
    return F.col(customer) % 5 + 1 + 5 * (_turn(order) % MEETING_TURNS)


def day_of(date: str, order: str) -> Column:
    """The day of an order. Day, meeting and race number together name one order; what has no day up to 9999 is an error."""
    day = F.to_date(date)
    shift = F.floor(_turn(order) / MEETING_TURNS) * DAYS_PER_TURN
    late = F.unix_date(day) + shift > F.unix_date(F.lit("9999-12-31").cast("date"))
    beyond = F.raise_error(F.concat(F.lit("no day for order "), F.col(order).cast("string"))).cast("date")
    return F.when(late, beyond).otherwise(F.date_add(day, shift.cast("int")))


def _race_object(o: Column) -> Column:
    return _object(
        numOrdre=_bare(o % RACE_NUMBERS),
        discipline=_quoted(_one_of(o % 5, "ATTELE", "attele", "MONTE", "PLAT", None)),
        distance=_bare(F.when(o % 29 == 0, 40_000).otherwise(o % 20 * 100 + 1600)),
        statut=_quoted(_one_of(o % 4, "FIN_COURSE", "EN_COURS", "SOMETHING_ELSE", None)),
        typePiste=_quoted(_one_of(o % 3, "SABLE", "AUTRE", None)),
        penetrometre=_object(valeurMesure=_quoted(_one_of(o % 3, "3,5", "4.25", "dur")), intitule=_quoted(F.lit("BON"))),
        nombreDeclaresPartants=_quoted(_bare(o % 12 + 4)),
        dureeCourse=_bare(F.when(o % 2 == 0, o % 1000 * 333).otherwise(F.lit(0))),
    )


def _meeting_object(number: Column, o: Column, races: Column) -> Column:
    return _object(
        numOfficiel=_bare(number),
        nature=_quoted(F.lit("TROT")),
        hippodrome=_object(code=_quoted(F.concat(F.lit("TRACK_"), number.cast("string"), F.lit("_LONG")))),
        meteo=F.when(o % 2 == 0, _object(temperature=_bare(number + 0.5), directionVent=_quoted(F.lit("N")))).otherwise(
            F.lit("null")
        ),
        courses=races,
    )


def programme_documents(orders: DataFrame) -> DataFrame:
    """A programme per order, with its one meeting and race."""
    o = F.col("o_orderkey")
    day = day_of("o_orderdate", "o_orderkey")
    meeting = _meeting_object(meeting_of("o_custkey", "o_orderkey"), o, _array(_race_object(o)))
    payload = _object(
        programme=_object(date=_bare(F.unix_date(day).cast("bigint") * 86_400_000), reunions=_array(meeting))
    )
    # An invalid date code on some documents leaves the date to the payload.
    code = F.when(o % 13 == 0, "99999999").otherwise(code_of_day(day))
    rows = orders.withColumns({"date_code": code, "meeting": F.lit(None), "race": F.lit(None), "seq": o})
    return _landing(rows, "programme", o, payload)


def _in_order(*position: str, item: str) -> Column:
    """The items of a group as one JSON array, in the order of their positions."""
    sorted_items = F.array_sort(F.collect_list(F.struct(*position, item)))
    return F.concat(F.lit("["), F.array_join(F.transform(sorted_items, lambda x: x[item]), ","), F.lit("]"))


def programmes_of_days(orders: DataFrame) -> DataFrame:
    """A programme per day with all its meetings and their races, in order.

    Order keys above RACE_NUMBERS have a document of their own for each turn of the numbers, so a document holds
    a day's share of that many orders. Some races stand twice, the second time over another distance, and some do
    not fit the table, which rejects the whole document.
    """
    o, again = F.col("o_orderkey"), F.explode(F.when(F.col("o_orderkey") % 10 == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    races = orders.select(
        o,
        day_of("o_orderdate", "o_orderkey").alias("day"),
        _turn("o_orderkey").alias("turn"),
        meeting_of("o_custkey", "o_orderkey").alias("number"),
        again.alias("again"),
    )
    longer = F.when(F.col("again") == 1, F.regexp_replace(_race_object(o), '"distance":[0-9]+', '"distance":1234')).otherwise(_race_object(o))
    races = races.withColumn("item", longer)
    meetings = races.groupBy("day", "turn", "number").agg(
        _in_order("o_orderkey", "again", item="item").alias("races"), F.min("o_orderkey").alias("first")
    )
    item = _meeting_object(F.col("number"), F.col("first"), F.col("races"))
    days = meetings.select("day", "turn", "number", "first", item.alias("item")).groupBy("day", "turn")
    days = days.agg(_in_order("number", item="item").alias("meetings"), F.min("first").alias("seq"))
    payload = _object(
        programme=_object(date=_bare(F.unix_date("day").cast("bigint") * 86_400_000), reunions=F.col("meetings"))
    )
    rows = days.withColumns({"date_code": code_of_day(F.col("day")), "meeting": F.lit(None), "race": F.lit(None)})
    return _landing(rows, "programme", day_key(F.col("day"), F.col("turn")), payload)


def day_key(day: Column, turn: Column) -> Column:
    return F.unix_date(day).cast("bigint") + turn * 7


def _child(lines: DataFrame, feed: str, payload: Column, rows_name: str, item: Column) -> DataFrame:
    key = F.col("l_orderkey")
    wrapped = F.when(key % 2 == 0, _object(**{rows_name: _array(item)})).otherwise(_array(item))
    rows = lines.withColumns({"seq": key * 10 + F.col("l_linenumber")})
    return _landing(rows, feed, key * 7 + F.col("l_linenumber"), F.coalesce(payload, wrapped))


def located(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines with the day, meeting and race number their order has in programme_documents."""
    races = orders.select(
        F.col("o_orderkey").alias("l_orderkey"),
        code_of_day(day_of("o_orderdate", "o_orderkey")).alias("date_code"),
        meeting_of("o_custkey", "o_orderkey").alias("meeting"),
        (F.col("o_orderkey") % RACE_NUMBERS).alias("race"),
    )
    return lines.join(races, "l_orderkey")


def unlocated(lines: DataFrame) -> DataFrame:
    """Lines with a place of their own, for parsing without a work list."""
    return lines.withColumns(
        {"date_code": code_of_day(F.to_date("l_shipdate")), "meeting": F.col("l_suppkey") % 5 + 1, "race": F.col("l_linenumber")}
    )


def _children(lines: DataFrame, *feeds: str) -> DataFrame:
    """For each feed a document per race with all its lines in order, repeated ones too; lines are located().

    Lines are grouped once for all feeds, and cross the network as they are, before the longer documents are built.
    """
    place, key = ["date_code", "meeting", "race", "l_orderkey"], F.col("l_orderkey")
    used = lines.select(*place, *SLOT_ORDER_IN_DOCUMENT).repartition("l_orderkey")
    items = used.select(*place, *SLOT_ORDER_IN_DOCUMENT, *[CHILDREN[feed][1]().alias(feed) for feed in feeds])
    in_order = F.array_sort(F.collect_list(F.struct(*SLOT_ORDER_IN_DOCUMENT, *feeds)))
    races = items.groupBy(*place).agg(in_order.alias("lines"))

    def document(feed: str) -> Column:
        texts = F.concat(F.lit("["), F.array_join(F.transform("lines", lambda x: x[feed]), ","), F.lit("]"))
        payload = F.when(key % 2 == 0, _object(**{CHILDREN[feed][0]: texts})).otherwise(texts)
        return F.struct(F.lit(feed).alias("feed"), payload.alias("payload"))

    docs = races.select(*place, F.explode(F.array(*[document(feed) for feed in feeds])).alias("doc"))
    return _landing(docs.withColumn("seq", key), F.col("doc.feed"), key, F.col("doc.payload"))


def documents_of_races(lines: DataFrame) -> DataFrame:
    """The documents of all three feeds that a race has."""
    return _children(lines, *CHILDREN)


def participants_of_races(lines: DataFrame) -> DataFrame:
    return _children(lines, "participants")


def performances_of_races(lines: DataFrame) -> DataFrame:
    return _children(lines, "performances")


def reports_of_races(lines: DataFrame) -> DataFrame:
    return _children(lines, "reports")


def _runner_object() -> Column:
    part, number, q = F.col("l_partkey"), F.col("l_linenumber"), F.col("l_quantity").cast("int")
    supplier = F.col("l_suppkey").cast("string")
    return _object(
        numPmu=_bare(F.when(part % 29 == 0, 70_000).otherwise(number)),
        nom=_quoted(F.when(part % 20 == 0, "").otherwise(F.concat(F.lit("Horse "), part.cast("string")))),
        age=_bare(q % 8),
        sexe=_quoted(_one_of(part % 4, "males", "FEMELLES", "", None)),
        entraineur=_quoted(F.concat(F.lit("Trainer "), supplier)),
        driver=_quoted(F.when(number != 7, F.concat(F.lit("Driver "), supplier))),
        incident=_quoted(_one_of(part % 4, "NON_PARTANT", "DISTANCE", "UNKNOWN_AND_RATHER_LONG", None)),
        deferre=_quoted(_one_of(part % 3, "DEFERRE_POSTERIEURS", "SOMETHING_ODD", None)),
        nombreCourses=_quoted(F.concat((q % 12).cast("string"), F.lit(".0"))),
        ordreArrivee=_bare(number),
        tempsObtenu=_bare(q * 1000),
        reductionKilometrique=_quoted(_one_of(part % 3, "1.25", "n/a", None)),
        gainsParticipant=F.when(q % 5 != 0, _object(gainsCarriere=_bare(part * 1000 + number))).otherwise(F.lit("null")),
        dernierRapportReference=_object(rapport=_bare(F.col("l_quantity") * 0.5 + 1)),
        dernierRapportDirect=F.when(F.col("l_tax") != 0, _object(rapport=_bare(F.col("l_quantity") * 0.25 + 1))).otherwise(
            F.lit("null")
        ),
    )


def participants_documents(lines: DataFrame) -> DataFrame:
    return _child(lines, "participants", F.lit(None).cast("string"), "participants", _runner_object())


def _performer_object() -> Column:
    part, number = F.col("l_partkey"), F.col("l_linenumber")
    place = F.when(number % 3 == 0, _bare(number)).otherwise(
        _object(place=_bare(number), statusArrivee=_quoted(F.lit("ARRIVE")))
    )
    other = _object(itsHim=F.lit("false"), place=_object(place=F.lit("99")))
    him = _object(
        itsHim=_bare(part % 9 != 0),
        place=place,
        corde=_bare(number),
        reductionKilometrique=_bare(F.col("l_tax") + 1),
        distanceParcourue=_quoted(F.lit("2700")),
    )
    day = F.unix_date(F.to_date("l_shipdate")).cast("bigint") * 86_400_000
    past = _object(
        date=_bare(F.when(part % 11 != 0, day).otherwise(F.lit(0))),
        discipline=_quoted(_one_of(part % 5, "ATTELE", "monte", "MONTE", "PLAT", None)),
        distance=_bare(F.when(part % 31 == 0, 99_999).otherwise(F.col("l_suppkey") % 15 * 100 + 1600)),
        allocation=_bare(F.col("l_quantity") * 10),
        tempsDuPremier=_bare(number + 100),
        participants=_array(other, him),
    )
    name = F.concat(F.lit("Horse "), part.cast("string"))
    return _object(
        nomCheval=_quoted(F.when(part % 2 == 0, "").otherwise(name)),
        nom=_quoted(F.when(part % 20 == 0, "").otherwise(name)),
        coursesCourues=_array(past),
    )


def performances_documents(lines: DataFrame) -> DataFrame:
    empty = F.when(F.col("l_partkey") % 37 == 0, "[]")
    return _child(lines, "performances", empty, "participants", _performer_object())


def _bet_object() -> Column:
    part, number = F.col("l_partkey"), F.col("l_linenumber")
    payout = _object(
        combinaison=_quoted(F.when(part % 10 != 0, number.cast("string"))),
        dividende=_quoted(F.when(part % 6 == 0, "none").otherwise((part * 10).cast("string"))),
        dividendePourUnEuro=_bare(part * 5),
        nombreGagnants=_bare(F.col("l_quantity") * 0.5),
    )
    return _object(
        typePari=_quoted(_one_of(part % 5, "SIMPLE_GAGNANT", "TRIO", "A_NEW_KIND_OF_BET", "", None)),
        famillePari=_quoted(F.when(part % 33 == 0, "A_FAMILY_NAME_THAT_IS_TOO_LONG").otherwise("MUTUEL")),
        miseBase=_bare(part % 7 * 50),
        rembourse=_bare(F.col("l_returnflag") == "R"),
        rapports=_array(payout),
    )


def reports_documents(lines: DataFrame) -> DataFrame:
    return _child(lines, "reports", F.lit(None).cast("string"), "rapportsDefinitifs", _bet_object())


# Of each feed whose documents belong to a race: the name of its rows and what a line item gives.
CHILDREN = {
    "participants": ("participants", _runner_object),
    "performances": ("participants", _performer_object),
    "reports": ("rapportsDefinitifs", _bet_object),
}
