"""Short codes of the feeds' long labels."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label -> stored code, as the feeds' consumers expect them.
RACE_STATUS = {
    "ARRIVEE_DEFINITIVE_COMPLETE": "FIN",
    "ARRIVEE_DEFINITIVE_C": "FIN",
    "FIN_COURSE": "FIN",
    "COURSE_ANNULEE": "ANN",
    "A_PARTIR": "FUT",
    "EN_COURS": "LIVE",
    "ARRIVEE_PROVISOIRE": "PROV",
}
TRACK = {"SABLE": "S", "POUZZOLANE": "P", "HERBE": "H", "CENDREE": "C", "MACHEFER": "M"}
INCIDENT = {
    "DISQUALIFIE_POUR_ALLURE_IRREGULIERE": "DAI",
    "DISQUALIFIE_POTEAU_GALOP": "DPG",
    "NON_PARTANT": "NP",
    "DISTANCE": "DIST",
    "ARRETE": "ARR",
    "TOMBE": "T",
    "RESTE_AU_POTEAU": "RP",
    "DISQUALIFIE": "DAI",
    "RETROGRADE": "RET",
}
SHOEING = {
    "DEFERRE_ANTERIEURS_POSTERIEURS": "D4",
    "PROTEGE_ANTERIEURS_DEFERRRE_POSTERIEURS": "PADP",
    "DEFERRE_POSTERIEURS": "DP",
    "DEFERRE_ANTERIEURS": "DA",
    "PROTEGE_ANTERIEURS": "PA",
    "PROTEGE_ANTERIEURS_POSTERIEURS": "P4",
    "DEFERRE_ANTERIEURS_PROTEGE_POSTERIEURS": "DAPP",
    "REFERRE_ANTERIEURS_POSTERIEURS": "R4",
    "PROTEGE_POSTERIEURS": "PP",
}
BET_TYPE = {
    "SIMPLE_GAGNANT": "SG",
    "SIMPLE_PLACE": "SP",
    "COUPLE_GAGNANT": "CG",
    "COUPLE_PLACE": "CP",
    "COUPLE_ORDRE": "CO",
    "TRIO": "TRIO",
    "TRIO_ORDRE": "TRIOO",
    "DEUX_SUR_QUATRE": "2S4",
    "MULTI": "MULTI",
    "MINI_MULTI": "MM",
    "TIERCE": "TIERCE",
    "QUARTE_PLUS": "QUARTE",
    "QUINTE_PLUS": "QUINTE",
    "PICK5": "PICK5",
    "SUPER_QUATRE": "SUP4",
}

TROT = ("ATTELE", "MONTE")


def coded(label: Column, codes: dict[str, str], width: int) -> Column:
    """The code of a label, else its first `width` characters; empty and null give null."""
    pairs = F.create_map(*[F.lit(text) for text in chain.from_iterable(codes.items())])
    return F.coalesce(F.try_element_at(pairs, label), F.left(F.nullif(label, F.lit("")), F.lit(width)))


def race_status(label: Column) -> Column:
    return coded(label, RACE_STATUS, 10)


def track_type(label: Column) -> Column:
    return coded(label, TRACK, 10)


def incident(label: Column) -> Column:
    return coded(label, INCIDENT, 20)


def shoeing(label: Column) -> Column:
    return coded(label, SHOEING, 10)


def bet_type(label: Column) -> Column:
    return coded(label, BET_TYPE, 10)


def bet_type_cut(label: Column) -> Column:
    """True where an unknown bet type loses characters."""
    return F.coalesce(~label.isin(*BET_TYPE) & (F.length(label) > 10), F.lit(False))


def is_trot(discipline: Column) -> Column:
    """Trot races in any letter case; a missing discipline is not trot."""
    return F.upper(F.coalesce(discipline, F.lit(""))).isin(*TROT)
