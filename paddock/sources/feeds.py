"""Parse the four JSON feeds into rows.

Numeric leaves are declared as text and read tolerantly. A document is kept
or rejected as a whole, decided inside the document with array functions, so
no shuffle is needed to find its bad rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.functions import codes, parsing as p
from paddock.schemas import TABLES
from paddock.sources.landing import landed_day

_BAD = "_corrupt_record"

PENETROMETER = "struct<valeurMesure:string,intitule:string>"
COURSE = (
    "struct<numOrdre:string,discipline:string,distance:string,statut:string,typePiste:string,"
    f"categorieStatut:string,categorieParticularite:string,penetrometre:{PENETROMETER},"
    "nombreDeclaresPartants:string,conditions:string,dureeCourse:string>"
)
MEETING = (
    "struct<numOfficiel:string,nature:string,hippodrome:struct<code:string>,"
    f"meteo:struct<temperature:string,directionVent:string>,courses:array<{COURSE}>>"
)
RUNNER = (
    "struct<numPmu:string,nom:string,age:string,sexe:string,entraineur:string,driver:string,"
    "incident:string,deferre:string,nombreCourses:string,musique:string,avisEntraineur:string,"
    "ordreArrivee:string,tempsObtenu:string,reductionKilometrique:string,"
    "gainsParticipant:struct<gainsCarriere:string>,"
    "dernierRapportReference:struct<rapport:string>,dernierRapportDirect:struct<rapport:string>>"
)
PAST_RUNNER = (
    "struct<itsHim:string,place:string,poidsJockey:string,corde:string,"
    "reductionKilometrique:string,distanceParcourue:string>"
)
PAST_RACE = (
    "struct<date:string,discipline:string,distance:string,allocation:string,tempsDuPremier:string,"
    f"participants:array<{PAST_RUNNER}>>"
)
PERFORMER = f"struct<nomCheval:string,nom:string,coursesCourues:array<{PAST_RACE}>>"
PAYOUT = "struct<combinaison:string,dividende:string,dividendePourUnEuro:string,nombreGagnants:string>"
BET = f"struct<typePari:string,famillePari:string,miseBase:string,rembourse:string,rapports:array<{PAYOUT}>>"

# Name of the row array in an object document; a bare array is wrapped under it.
ROWS = {"participants": "participants", "performances": "participants", "reports": "rapportsDefinitifs"}
SCHEMAS = {
    "programme": f"programme struct<date:string,reunions:array<{MEETING}>>, {_BAD} string",
    "participants": f"participants array<{RUNNER}>, {_BAD} string",
    "performances": f"participants array<{PERFORMER}>, {_BAD} string",
    "reports": f"rapportsDefinitifs array<{BET}>, {_BAD} string",
}

SUCCESS, SKIPPED, FAILED = "SUCCESS", "SKIPPED", "FAILED"
DOCUMENT = ["feed", "date_code", "day", "meeting", "race", "seq", "name"]


def http_outcome(status: Column) -> Column:
    """What the HTTP status alone decides; null where the payload has to be looked at."""
    return (
        F.when(status.isin(204, 404), SKIPPED)
        .when(status.isNull() | (status >= 300) | (status < 200), FAILED)
    )


def _is_bare_value(payload: Column) -> Column:
    """Valid JSON that is neither an object nor an array."""
    return F.regexp_like(
        F.trim(payload), F.lit(r'^(null|true|false|-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?|"[^"]*")$')
    )


def _opened(landing: DataFrame, feed: str) -> DataFrame:
    """Documents of one feed with their payload parsed into `doc`."""
    payload = F.col("payload")
    if feed in ROWS:
        wrapped = F.concat(F.lit(f'{{"{ROWS[feed]}":'), payload, F.lit("}"))
        payload = F.when(F.ltrim(payload).startswith("["), wrapped).otherwise(payload)
    doc = F.from_json(payload, SCHEMAS[feed], {"columnNameOfCorruptRecord": _BAD})
    landed = landed_day(landing.where(F.col("feed") == feed))
    if "name" not in landed.columns:
        landed = landed.withColumn("name", F.lit(None).cast("string"))
    # Filters on the parsed document are not pushed below a generator, which
    # keeps the optimizer from parsing the payload once more per filter.
    return landed.select("*", F.explode(F.array(doc)).alias("doc"))


def _any(items: Column, test) -> Column:
    """Whether an element fails the test or is itself null."""
    return F.coalesce(F.exists(items, lambda x: x.isNull() | F.coalesce(test(x), F.lit(False))), F.lit(False))


def _too_long(table: str, column: str, text: Column) -> Column:
    return p.overflows(text, TABLES[table].widths[column])


def _either(*tests: Column) -> Column:
    found = tests[0]
    for test in tests[1:]:
        found = found | test
    return F.coalesce(found, F.lit(False))


def _race_fails(c: Column) -> Column:
    trot = codes.is_trot(c["discipline"])
    return trot & _either(
        p.not_small(c["numOrdre"]),
        p.outside_small(c["distance"]),
        p.outside_small(c["nombreDeclaresPartants"]),
        p.outside_int(c["dureeCourse"]),
        _too_long("race", "discipline", c["discipline"]),
        _too_long("race", "race_category", c["categorieParticularite"]),
        _too_long("race", "track_type", codes.track_type(c["typePiste"])),
        _too_long("race", "terrain_label", c["penetrometre"]["intitule"]),
        _too_long("race", "race_status_category", p.cut(c["categorieStatut"], 50)),
    )


def _meeting_fails(m: Column) -> Column:
    return _either(
        p.not_small(m["numOfficiel"]),
        _too_long("race_meeting", "meeting_type", p.cut(m["nature"], 50)),
        p.unreadable(m["meteo"]["temperature"], p.number(m["meteo"]["temperature"])),
        _too_long("race_meeting", "weather_wind", m["meteo"]["directionVent"]),
        _any(m["courses"], _race_fails),
    )


def _runner_fails(r: Column) -> Column:
    named = F.coalesce(r["nom"], F.lit("")) != ""
    return named & _either(
        p.not_small(r["numPmu"]),
        p.overflows(r["nom"], 100),
        *[p.outside_small(r[name]) for name in ("age", "nombreCourses", "ordreArrivee")],
        p.outside_int(r["tempsObtenu"]),
        *[
            p.unreadable(r[name]["rapport"], p.number(r[name]["rapport"]))
            for name in ("dernierRapportReference", "dernierRapportDirect")
        ],
        _too_long("race_participant", "raw_performance_string", r["musique"]),
        _too_long("race_participant", "trainer_advice", r["avisEntraineur"]),
    )


def _past_race_fails(h: Column) -> Column:
    return codes.is_trot(h["discipline"]) & _either(
        p.unreadable(h["date"], p.whole(h["date"])),
        p.outside_small(h["distance"]),
        p.outside_int(h["tempsDuPremier"]),
        p.unreadable(h["allocation"], p.number(h["allocation"])),
        # The array of one lets all tests share the search for the runner.
        F.exists(F.array(p.subject(h["participants"])), _past_runner_fails),
    )


def _past_runner_fails(him: Column) -> Column:
    return _either(
        # Inside lambdas an expression is worked out wherever it stands; the array of one reads the place once.
        F.exists(F.array(p.place_part(him["place"], "place")), p.outside_small),
        _too_long("horse_race_history", "finish_status", p.place_part(him["place"], "statusArrivee")),
        p.outside_small(him["corde"]),
        p.outside_small(him["distanceParcourue"]),
        *[p.unreadable(him[name], p.number(him[name])) for name in ("poidsJockey", "reductionKilometrique")],
    )


def _performer_fails(r: Column) -> Column:
    name = p.first_text(r["nomCheval"], r["nom"])
    return (F.coalesce(name, F.lit("")) != "") & _either(
        p.overflows(name, 100), _any(r["coursesCourues"], _past_race_fails)
    )


def _payout_fails(r: Column) -> Column:
    return _either(
        _too_long("bet_report", "combination", r["combinaison"]),
        p.unreadable(r["nombreGagnants"], p.number(r["nombreGagnants"])),
    )


def _bet_fails(b: Column) -> Column:
    return _either(
        _too_long("race_bet", "bet_family", b["famillePari"]),
        p.unreadable(b["rembourse"], p.flag(b["rembourse"])),
        _any(b["rapports"], _payout_fails),
    )


_FAILS = {
    "programme": _meeting_fails,
    "participants": _runner_fails,
    "performances": _performer_fails,
    "reports": _bet_fails,
}


def _total(items: Column, count) -> Column:
    """The sum of a number over the elements of an array."""
    return F.aggregate(F.coalesce(items, F.array()), F.lit(0), lambda sum_, x: sum_ + F.coalesce(count(x), F.lit(0)))


def _cut(text: Column, most: int) -> Column:
    return F.coalesce(p.overflows(text, most), F.lit(False)).cast("int")


def _trot_races(m: Column) -> Column:
    return _total(m["courses"], lambda c: codes.is_trot(c["discipline"]).cast("int"))


def _past_trot_races(r: Column) -> Column:
    named = F.coalesce(p.first_text(r["nomCheval"], r["nom"]), F.lit("")) != ""
    return F.when(named, _total(r["coursesCourues"], lambda h: codes.is_trot(h["discipline"]).cast("int"))).otherwise(0)


# How many records an element of a document's rows brings to its table, and how many of its texts are cut.
_RECORDS = {
    "programme": _trot_races,
    "participants": lambda r: F.lit(1),
    "performances": _past_trot_races,
    "reports": lambda b: F.lit(1),
}
_CUTS = {
    "programme": lambda m: _cut(m["nature"], 50)
    + _cut(m["hippodrome"]["code"], 10)
    + _total(
        m["courses"],
        lambda c: F.when(codes.is_trot(c["discipline"]), _cut(c["discipline"], 20) + _cut(c["categorieStatut"], 50)).otherwise(0),
    ),
    "participants": lambda r: F.when(F.coalesce(r["nom"], F.lit("")) != "", _cut(r["entraineur"], 100) + _cut(r["driver"], 100)).otherwise(0),
    "performances": lambda r: F.lit(0),
    "reports": lambda b: codes.bet_type_cut(b["typePari"]).cast("int"),
}


def judged(landing: DataFrame, feed: str) -> DataFrame:
    """Documents of one feed: their load status, their rows if accepted, their payload if rejected."""
    docs = _opened(landing, feed)
    rows = F.col("doc.programme.reunions") if feed == "programme" else F.col(f"doc.{ROWS[feed]}")
    day = F.col("day")
    undated = F.lit(False)
    if feed == "programme":
        day = p.program_day(F.col("date_code"), F.col("doc.programme.date"))
        undated = day.isNull()
    empty = F.size(F.coalesce(rows, F.array())) == 0
    bare = {"participants": SUCCESS, "performances": SKIPPED}.get(feed, FAILED)
    by_http = http_outcome(F.col("http_status"))
    status = F.coalesce(
        by_http,
        F.when(_is_bare_value(F.col("payload")), bare),
        F.when(F.col("payload").isNull() | F.col(f"doc.{_BAD}").isNotNull() | undated, FAILED),
        F.when(F.lit(feed == "performances") & empty, SKIPPED),
        F.when(_any(rows, _FAILS[feed]), FAILED),
        F.lit(SUCCESS),
    )
    known = docs.withColumns({"rows": rows, "status": status, "day": day})
    loaded, failed = F.col("status") == SUCCESS, F.col("status") == FAILED
    return known.select(
        *DOCUMENT,
        *[c for c in ("digest",) if c in known.columns],
        "http_status",
        "status",
        F.when(loaded, _total(F.col("rows"), _RECORDS[feed])).otherwise(0).alias("attempted"),
        F.when(loaded, _total(F.col("rows"), _CUTS[feed])).otherwise(0).alias("overflowed"),
        F.when(loaded, F.col("rows")).alias("rows"),
        F.when(failed & by_http.isNull(), F.col("payload")).alias("payload"),
    )


def _each(df: DataFrame, array: str, item: str, position: str) -> DataFrame:
    """One row per array element with its position.

    The outer form keeps the optimizer from adding a size check below, which
    would judge every document a second time.
    """
    return df.select("*", F.posexplode_outer(array).alias(position, item)).where(F.col(position).isNotNull())


def parse_programme(docs: DataFrame) -> dict[str, DataFrame]:
    meetings = _each(docs, "rows", "m", "i")
    races = _each(meetings.select(*DOCUMENT, "i", "m.numOfficiel", "m.courses"), "courses", "c", "j")
    return {
        "days": docs.where(F.col("status") == SUCCESS).select(F.col("day").alias("program_date"), "seq"),
        "meetings": meetings.select(
            F.col("day").alias("program_date"),
            p.small(F.col("m.numOfficiel")).alias("meeting_number"),
            p.cut(F.col("m.nature"), 50).alias("meeting_type"),
            p.cut(F.col("m.hippodrome.code"), 10).alias("racetrack_code"),
            p.number(F.col("m.meteo.temperature")).alias("weather_temperature"),
            F.col("m.meteo.directionVent").alias("weather_wind"),
            "seq",
            "name",
            "i",
        ),
        "races": races.where(codes.is_trot(F.col("c.discipline"))).select(
            F.col("day").alias("program_date"),
            p.small(F.col("numOfficiel")).alias("meeting_number"),
            p.whole(F.col("c.numOrdre")).alias("race_number"),
            p.cut(F.col("c.discipline"), 20).alias("discipline"),
            F.col("c.categorieParticularite").alias("race_category"),
            p.small(F.col("c.distance")).alias("distance_m"),
            codes.track_type(F.col("c.typePiste")).alias("track_type"),
            F.col("c.penetrometre.intitule").alias("terrain_label"),
            p.comma_number(F.col("c.penetrometre.valeurMesure")).alias("penetrometer"),
            p.small(F.col("c.nombreDeclaresPartants")).alias("declared_runners_count"),
            F.col("c.conditions").alias("conditions_text"),
            codes.race_status(F.col("c.statut")).alias("race_status"),
            p.seconds(F.col("c.dureeCourse")).alias("race_duration_s"),
            p.cut(F.col("c.categorieStatut"), 50).alias("race_status_category"),
            "seq",
            "name",
            "i",
            "j",
        ),
    }


def parse_participants(docs: DataFrame, as_of_year: int) -> dict[str, DataFrame]:
    runners = _each(docs, "rows", "r", "i").where(F.coalesce("r.nom", F.lit("")) != "")
    return {
        "runners": runners.select(
            *DOCUMENT,
            "i",
            F.col("r.nom").alias("horse_name"),
            p.birth_year(F.col("r.age"), as_of_year).alias("birth_year"),
            p.small(F.col("r.numPmu")).alias("pmu_number"),
            p.small(F.col("r.age")).alias("age"),
            p.sex_code(F.col("r.sexe")).alias("sex"),
            F.nullif(p.cut(F.col("r.entraineur"), 100), F.lit("")).alias("trainer_name"),
            F.nullif(p.cut(F.col("r.driver"), 100), F.lit("")).alias("driver_name"),
            codes.shoeing(F.col("r.deferre")).alias("shoeing_code"),
            codes.incident(F.col("r.incident")).alias("incident_code"),
            p.small(F.col("r.nombreCourses")).alias("career_races_count"),
            p.euros(F.col("r.gainsParticipant.gainsCarriere")).alias("career_winnings"),
            p.number(F.col("r.dernierRapportReference.rapport")).alias("reference_odds"),
            p.number(F.col("r.dernierRapportDirect.rapport")).alias("live_odds"),
            F.col("r.musique").alias("raw_performance_string"),
            p.small(F.col("r.ordreArrivee")).alias("finish_rank"),
            p.small(F.col("r.tempsObtenu")).alias("time_achieved_s"),
            p.number(F.col("r.reductionKilometrique")).alias("reduction_km"),
            F.col("r.avisEntraineur").alias("trainer_advice"),
        )
    }


def parse_performances(docs: DataFrame) -> dict[str, DataFrame]:
    name = p.first_text(F.col("r.nomCheval"), F.col("r.nom"))
    horses = (
        _each(docs, "rows", "r", "i")
        .select(*DOCUMENT, "i", name.alias("horse_name"), F.col("r.coursesCourues").alias("past"))
        .where(F.coalesce("horse_name", F.lit("")) != "")
    )
    races = _each(horses, "past", "h", "j").where(codes.is_trot(F.col("h.discipline")))
    him = races.withColumn("him", p.subject(F.col("h.participants")))
    return {
        "horses": horses.drop("past"),
        "history": him.select(
            *DOCUMENT,
            "i",
            "j",
            "horse_name",
            p.day_of_millis(F.col("h.date")).alias("race_date"),
            F.col("h.discipline").alias("discipline"),
            p.number(F.col("h.allocation")).alias("prize_money"),
            p.small(F.col("h.distance")).alias("distance_m"),
            p.small(F.col("h.tempsDuPremier")).alias("first_place_time_s"),
            p.small(p.place_part(F.col("him.place"), "place")).alias("finish_place"),
            p.place_part(F.col("him.place"), "statusArrivee").alias("finish_status"),
            p.number(F.col("him.poidsJockey")).alias("jockey_weight"),
            p.small(F.col("him.corde")).alias("draw_number"),
            p.number(F.col("him.reductionKilometrique")).alias("reduction_km"),
            p.small(F.col("him.distanceParcourue")).alias("distance_traveled_m"),
        ),
    }


def parse_reports(docs: DataFrame) -> dict[str, DataFrame]:
    bets = _each(docs, "rows", "b", "i").withColumn("bet_type", codes.bet_type(F.col("b.typePari")))
    payouts = _each(bets.select(*DOCUMENT, "i", "bet_type", "b.rapports"), "rapports", "r", "j")
    return {
        "bets": bets.select(
            *DOCUMENT,
            "i",
            "bet_type",
            codes.bet_type_cut(F.col("b.typePari")).alias("bet_type_overflow"),
            F.col("b.famillePari").alias("bet_family"),
            p.euros(F.col("b.miseBase")).alias("base_stake"),
            p.flag(F.col("b.rembourse")).alias("is_refunded"),
        ),
        "payouts": payouts.select(
            *DOCUMENT,
            "i",
            "j",
            "bet_type",
            F.col("r.combinaison").alias("combination"),
            p.euros(F.col("r.dividende")).alias("dividend"),
            p.euros(F.col("r.dividendePourUnEuro")).alias("dividend_per_1e"),
            p.number(F.col("r.nombreGagnants")).alias("winners_count"),
        ),
    }


def parse_feed(
    landing: DataFrame,
    feed: str,
    as_of_year: int = 1970,
    keep: Callable[[DataFrame], DataFrame] = lambda docs: docs,
) -> dict[str, DataFrame]:
    """Rows of one feed by kind, plus the outcome of its `documents` and the `rejects` among them.

    `keep` stores the judged documents where several results are to be read, so
    that payloads are parsed once.
    """
    docs = keep(judged(landing, feed))
    if feed == "programme":
        parsed = parse_programme(docs)
    elif feed == "participants":
        parsed = parse_participants(docs, as_of_year)
    elif feed == "performances":
        parsed = parse_performances(docs)
    else:
        parsed = parse_reports(docs)
    parsed["documents"] = docs.drop("rows", "payload")
    parsed["rejects"] = docs.where("payload is not null").select(*DOCUMENT, "http_status", "payload")
    return parsed
