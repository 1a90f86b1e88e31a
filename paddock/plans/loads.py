"""Load jobs: landed documents to new warehouse rows, idempotently.

Each load handles every landed day at once. It returns what to append per table,
the rejected documents and the audit; `commit` writes them. Payloads are parsed
once into a staged table that all later steps read. Steps that number rows store their input in the checkpoint folder, so ids cannot change if an
executor is lost before they are written.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.functions.parsing import day_of_code
from paddock.operators.loading import (
    latest_stored,
    load_audit,
    load_once,
    number_new,
    number_stored,
    resolve_keys,
    top_id,
    updated,
)
from paddock.operators.scope import work_list
from paddock.schemas import LEDGER, TABLES
from paddock.session import packed, scratch
from paddock.sources.feeds import parse_feed
from paddock.sources.landing import write_dead_letters
from paddock.sources.warehouse import Manifest, StoredTables, Tables, create_warehouse, latest, near, open_warehouse, publish

# Documents in the order they came, those of one moment by name, then places inside them.
POSITION = ["seq", "name", "i"]
STAGES = ("programme", "participants", "performances", "reports")
# The table whose new rows count as a stage's inserted records.
FACTS = {"programme": "race", "participants": "race_participant", "performances": "horse_race_history", "reports": "race_bet"}
DOCUMENT_KEY = ("feed", "date_code", "meeting", "race", "digest")
AUDIT = "feed string, status string, documents long, attempted long, overflowed long, inserted long"


@dataclass
class Load:
    """New rows per table, rejected documents, the documents' outcomes, and stored rows to write again."""

    rows: dict[str, DataFrame]
    rejects: DataFrame
    documents: DataFrame
    updates: dict[str, DataFrame] = field(default_factory=dict)

    @property
    def audit(self) -> DataFrame:
        return load_audit(self.documents)


def _after(tables: Tables, rows: dict[str, DataFrame], name: str) -> DataFrame:
    """A table as it will be once its new rows are appended."""
    stored = tables[name].select(*TABLES[name].columns)
    return stored.unionByName(rows[name]) if name in rows else stored


def _shaped(df: DataFrame, name: str) -> DataFrame:
    """Columns and types of a table; columns the feed does not carry are null."""
    fields = TABLES[name].schema.fields
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in fields
        ]
    )


def _of_table(df: DataFrame, name: str, *more: str) -> DataFrame:
    """Those columns that a table takes, and some more; the others of a batch need not be stored to number its rows."""
    wanted = {*TABLES[name].columns, *more}
    return df.select(*[c for c in df.columns if c in wanted])


def _entries(
    tables: Tables,
    name: str,
    batch: DataFrame,
    order_by: Sequence[str],
    updates: dict[str, DataFrame] | None,
    nullable_keys: bool = False,
    prune_by: str | None = None,
) -> DataFrame:
    """Rows of the batch that a table lacks, the first of each key.

    Given `updates`, the latest known value of each column counts instead, and goes into the stored row of
    that key as well: what is to be written again is put into `updates`.
    """
    if updates is not None:
        batch = latest_stored(_of_table(batch, name, *order_by), TABLES[name].key, order_by)
    stored = tables[name] if prune_by is None else near(tables, name, prune_by, batch)
    if updates is not None:
        again = updated(tables[name], batch, name, stored)
        if again is not None:
            updates[name] = again
    return load_once(batch, stored, TABLES[name].key, order_by, nullable_keys=nullable_keys)


def _top(tables: Tables, name: str) -> int:
    """The largest id of a table in use; a stored one knows it."""
    known = TABLES[name].id
    return tables.top(name, known) if isinstance(tables, StoredTables) else top_id(tables[name], known)


def _members(
    tables: Tables,
    name: str,
    label: str,
    candidates: DataFrame,
    order_by: Sequence[str],
    updates: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """New members of a dimension, numbered by name; the first candidate of a name wins unless updating."""
    named = candidates.where(F.coalesce(label, F.lit("")) != "")
    new = _entries(tables, name, named, order_by, updates)
    return _shaped(number_new(_of_table(new, name), [label], TABLES[name].id, _top(tables, name)), name)


def _updates(mode: str) -> dict[str, DataFrame] | None:
    if mode not in ("ignore", "update"):
        raise ValueError(f"unknown mode {mode}")
    return {} if mode == "update" else None


def load_program(landing: DataFrame, tables: Tables, mode: str = "ignore") -> Load:
    """Days, meetings and trot races of landed programmes."""
    updates = _updates(mode)
    parsed = parse_feed(landing, "programme", keep=packed)
    rows: dict[str, DataFrame] = {}

    days = _entries(tables, "daily_program", parsed["days"], ["seq"], None, prune_by="program_date")
    start = _top(tables, "daily_program")
    rows["daily_program"] = _shaped(number_new(_of_table(days, "daily_program"), ["program_date"], "program_id", start), "daily_program")
    programs = _after(tables, rows, "daily_program")

    meetings = parsed["meetings"].join(programs, "program_date")
    new = _entries(tables, "race_meeting", meetings, POSITION, updates, prune_by="program_id")
    start = _top(tables, "race_meeting")
    numbered = number_new(_of_table(new, "race_meeting"), ["program_id", "meeting_number"], "meeting_id", start)
    rows["race_meeting"] = _shaped(numbered, "race_meeting")
    parents = _after(tables, rows, "race_meeting").join(programs, "program_id")

    keys = ["program_date", "meeting_number"]
    races = parsed["races"].join(parents.select("meeting_id", *keys), keys)
    new = _entries(tables, "race", races, [*POSITION, "j"], updates, prune_by="meeting_id")
    start = _top(tables, "race")
    rows["race"] = _shaped(number_new(_of_table(new, "race"), ["meeting_id", "race_number"], "race_id", start), "race")
    return Load(rows, parsed["rejects"], parsed["documents"], updates or {})


def _documents_of(landing: DataFrame, feed: str, races: DataFrame) -> DataFrame:
    """Documents of one feed that belong to a race of the work list, with its race_id."""
    key = [
        F.date_format("program_date", "ddMMyyyy").alias("date_code"),
        F.col("meeting_number").alias("meeting"),
        F.col("race_number").cast("int").alias("race"),
    ]
    wanted = races.select(*key)
    return landing.where(F.col("feed") == feed).join(wanted, ["date_code", "meeting", "race"], "left_semi")


def _with_race_id(rows: DataFrame, races: DataFrame) -> DataFrame:
    key = races.select(
        F.col("program_date").alias("day"),
        F.col("meeting_number").alias("meeting"),
        F.col("race_number").cast("int").alias("race"),
        "race_id",
    )
    return rows.join(key, ["day", "meeting", "race"])


def load_participants(
    landing: DataFrame, tables: Tables, as_of_year: int, dates: Sequence[str] | None = None, mode: str = "ignore"
) -> Load:
    """Runners of the listed races with their horses, people, shoeing and incidents."""
    updates = _updates(mode)
    races = work_list(tables, dates)
    parsed = parse_feed(_documents_of(landing, "participants", races), "participants", as_of_year, keep=packed)
    runners = parsed["runners"]
    rows: dict[str, DataFrame] = {}

    rows["horse"] = _members(tables, "horse", "horse_name", runners, POSITION, updates)
    people = runners.select(
        F.explode(F.array("trainer_name", "driver_name")).alias("actor_name"), *POSITION
    )
    rows["racing_actor"] = _members(tables, "racing_actor", "actor_name", people, POSITION)
    for name, label in (("lookup_shoeing", "shoeing_code"), ("lookup_incident", "incident_code")):
        codes = runners.select(F.col(label).alias("code"), *POSITION)
        rows[name] = _members(tables, name, "code", codes, POSITION)

    facts = _with_race_id(runners, races)
    facts = resolve_keys(facts, _after(tables, rows, "horse"), "horse_name", "horse_id")
    people = _after(tables, rows, "racing_actor")
    facts = resolve_keys(facts, people, "trainer_name", "actor_id", "actor_name", "trainer_id")
    facts = resolve_keys(facts, people, "driver_name", "actor_id", "actor_name", "driver_jockey_id")
    facts = resolve_keys(facts, _after(tables, rows, "lookup_shoeing"), "shoeing_code", "shoeing_id", "code")
    facts = resolve_keys(facts, _after(tables, rows, "lookup_incident"), "incident_code", "incident_id", "code")
    new = _entries(tables, "race_participant", facts, POSITION, updates, prune_by="race_id")
    start = _top(tables, "race_participant")
    rows["race_participant"] = _shaped(number_stored(_of_table(new, "race_participant"), "participant_id", start), "race_participant")
    return Load(rows, parsed["rejects"], parsed["documents"], updates or {})


def load_performances(
    landing: DataFrame, tables: Tables, dates: Sequence[str] | None = None, mode: str = "ignore"
) -> Load:
    """Past races of the horses in the listed races, of any discipline on the card."""
    updates = _updates(mode)
    races = work_list(tables, dates, disciplines=None)
    parsed = parse_feed(_documents_of(landing, "performances", races), "performances", keep=packed)
    rows = {"horse": _members(tables, "horse", "horse_name", parsed["horses"], POSITION)}
    past = resolve_keys(parsed["history"], _after(tables, rows, "horse"), "horse_name", "horse_id")
    order = [*POSITION, "j"]
    new = _entries(tables, "horse_race_history", past, order, updates, nullable_keys=True, prune_by="horse_id")
    start = _top(tables, "horse_race_history")
    rows["horse_race_history"] = _shaped(number_stored(_of_table(new, "horse_race_history"), "history_id", start), "horse_race_history")
    return Load(rows, parsed["rejects"], parsed["documents"], updates or {})


def load_reports(
    landing: DataFrame, tables: Tables, dates: Sequence[str] | None = None, mode: str = "ignore"
) -> Load:
    """Bets and pay-outs of the listed races. A pay-out whose bet type is unknown has no parent and is dropped
    unless the bet row itself is new."""
    updates = _updates(mode)
    races = work_list(tables, dates)
    parsed = parse_feed(_documents_of(landing, "reports", races), "reports", keep=packed)
    rows: dict[str, DataFrame] = {}
    bets = _with_race_id(parsed["bets"], races)
    new = _entries(tables, "race_bet", bets, POSITION, updates, nullable_keys=True, prune_by="race_id")
    numbered = number_stored(_of_table(new, "race_bet", *POSITION), "bet_id", _top(tables, "race_bet"))
    rows["race_bet"] = _shaped(numbered, "race_bet")

    payouts = _with_race_id(parsed["payouts"], races)
    stored = _after(tables, rows, "race_bet").where("bet_type is not null").select("race_id", "bet_type", "bet_id")
    typed = payouts.where("bet_type is not null").join(stored, ["race_id", "bet_type"])
    # A bet without a type is always inserted anew, so its pay-outs belong to that very row.
    document = F.coalesce("name", F.lit("")).alias("_document")
    fresh = numbered.where("bet_type is null").select("race_id", "seq", document, "i", "bet_id")
    untyped = payouts.where("bet_type is null").select("*", document).join(fresh, ["race_id", "seq", "_document", "i"])
    reports = typed.unionByName(untyped.drop("_document"))
    new = _entries(tables, "bet_report", reports, [*POSITION, "j"], updates, nullable_keys=True, prune_by="bet_id")
    start = _top(tables, "bet_report")
    rows["bet_report"] = _shaped(number_stored(_of_table(new, "bet_report"), "report_id", start), "bet_report")
    return Load(rows, parsed["rejects"], parsed["documents"], updates or {})


def with_digest(landing: DataFrame) -> DataFrame:
    """Documents with a digest of their outcome and payload."""
    held = F.concat_ws(":", F.col("http_status").cast("string"), F.coalesce("payload", F.lit("")))
    return landing.withColumn("digest", F.sha2(F.concat(F.col("payload").isNull().cast("string"), held), 256))


def _ledger(docs: DataFrame, tables: StoredTables, mode: str) -> DataFrame | None:
    """The documents that loads in this mode have handled, on the days of `docs`; None where the ledger has none there."""
    if not tables.parts(LEDGER):
        return None
    low, high = docs.agg(*[f(F.unix_date(day_of_code(F.col("date_code")))) for f in (F.min, F.max)]).first()
    known = tables.ledger(0, -1) if low is None else tables.ledger(low, high)
    return known.where(F.col("mode") == mode).select(*DOCUMENT_KEY).distinct()


def _same_document(known: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{known}.{c}")) for c in DOCUMENT_KEY])


def commit(load: Load, root: str, dead_letters: str, note: dict | None = None, base: Manifest | None = None) -> dict[str, int]:
    """Keep the rejected documents, then make updated and new rows of all tables visible at once; the new rows by table.

    A run that dies before the end leaves the tables as they were. `note` names the run and stage; a stage
    that is run again writes its rejected documents over those of the attempt before.
    """
    spark = load.rejects.sparkSession
    name = uuid.uuid4().hex if note is None else f"{note['run']}-{note['stage']}"
    write_dead_letters(load.rejects, f"{dead_letters}/load={name}")
    rows = dict(load.rows)
    if "digest" in load.documents.columns:
        handled = load.documents.withColumns({"landed": day_of_code(F.col("date_code")), "mode": F.lit((note or {}).get("mode", "ignore"))})
        rows[LEDGER] = handled
    return publish(spark, root, rows, load.updates, note, base)


def _unhandled(
    landing: DataFrame, tables: StoredTables, stage: str, dates: Sequence[str] | None, mode: str
) -> tuple[DataFrame | None, list[dict]]:
    """The documents of a stage that are new or changed, None where there are none, and the audit of the others.

    Documents are told apart by their digests, which are worked out where they lie: payloads go no further, and only
    those of new documents are read once more.
    """
    if stage == "programme":
        docs = with_digest(landing.where(F.col("feed") == stage))
    else:
        races = work_list(tables, dates, disciplines=None) if stage == "performances" else work_list(tables, dates)
        docs = _documents_of(with_digest(landing), stage, races)
    ledger = _ledger(landing.where(F.col("feed") == stage), tables, mode)
    if ledger is None:
        return (None if docs.isEmpty() else docs), []
    known = ledger.select(F.struct(*DOCUMENT_KEY).alias("_known"))
    seen = docs.select(*DOCUMENT_KEY).join(known, _same_document("_known"), "left")
    count, same = seen.agg(F.count(F.lit(1)), F.count("_known")).first()
    audit = [{"feed": stage, "status": "UNCHANGED", "documents": same, "attempted": 0, "overflowed": 0}] if same else []
    if same == count:
        return None, audit
    return docs.join(known, _same_document("_known"), "left_anti") if same else docs, audit


def run_stages(
    spark: SparkSession,
    landing: DataFrame,
    root: str,
    dead_letters: str,
    as_of_year: int,
    dates: Sequence[str] | None = None,
    stages: Sequence[str] = STAGES,
    mode: str = "ignore",
    run: str | None = None,
    skip_unchanged: bool = False,
) -> dict[str, DataFrame | Exception]:
    """Run the chosen stages in order over all days in scope; a failed stage does not stop the next.

    `mode="update"` also brings late values, such as results and final odds, into rows stored earlier.
    `run` names the run: a stage that a run of that name has committed is not run again.
    `skip_unchanged` keeps a ledger of the documents handled, by their digests: a document that comes again as it
    was, in the same mode, is not parsed, and the audit counts it as UNCHANGED. With it, the last days are loaded
    again at the price of reading them.
    Returns the audit of each stage, or the error it failed with.
    """
    create_warehouse(spark, root)
    scoped = landing if dates is None else landing.where(F.col("date_code").isin(*dates))
    jobs: dict[str, Callable[[DataFrame, Tables], Load]] = {
        "programme": lambda docs, tables: load_program(docs, tables, mode),
        "participants": lambda docs, tables: load_participants(docs, tables, as_of_year, dates, mode),
        "performances": lambda docs, tables: load_performances(docs, tables, dates, mode),
        "reports": lambda docs, tables: load_reports(docs, tables, dates, mode),
    }
    outcome: dict[str, DataFrame | Exception] = {}
    for stage in STAGES:
        if stage not in stages:
            continue
        try:
            tables = open_warehouse(spark, root)
            done = None if run is None else tables.manifest.done(run, stage)
            if done is None:
                docs, audit = scoped, []
                if skip_unchanged:
                    docs, audit = _unhandled(scoped, tables, stage, dates, mode)
                done = {"audit": audit, "rows": {FACTS[stage]: 0}}
                if docs is not None:
                    with scratch(spark):  # what a commit has written is in the tables
                        load = jobs[stage](docs, tables)
                        audit += [row.asDict() for row in load.audit.collect()]  # a line for each outcome
                        note = {"run": run or uuid.uuid4().hex, "stage": stage, "mode": mode, "audit": audit}
                        done = {**note, "rows": commit(load, root, dead_letters, note, tables.manifest)}
            new = done["rows"][FACTS[stage]]
            lines = [{**line, "inserted": new if line["status"] == "SUCCESS" else 0} for line in done["audit"]]
            outcome[stage] = spark.createDataFrame(lines, AUDIT)
        except Exception as error:  # noqa: BLE001 - reported to the caller per stage
            outcome[stage] = error
    return outcome


def backfill(
    spark: SparkSession,
    landing: DataFrame,
    root: str,
    dead_letters: str,
    as_of_year: int,
    days: Sequence[str],
    run: str,
    days_a_load: int = 30,
    stages: Sequence[str] = STAGES,
    mode: str = "ignore",
    skip_unchanged: bool = False,
) -> dict[tuple[str, str], DataFrame | Exception]:
    """Load many days, some of them at a time, each stage of each batch as one commit.

    Started again under the same name with the same days, it goes on with the first stage that lacks. Returns
    what run_stages returns, by first day of the batch and stage.
    """
    outcome: dict[tuple[str, str], DataFrame | Exception] = {}
    for at in range(0, len(days), days_a_load):
        batch = list(days[at : at + days_a_load])
        done = run_stages(spark, landing, root, dead_letters, as_of_year, batch, stages, mode, f"{run}-{batch[0]}-{len(batch)}", skip_unchanged)
        outcome |= {(batch[0], stage): result for stage, result in done.items()}
    return outcome


def pending(spark: SparkSession, root: str, days: Sequence[str], run: str, days_a_load: int = 30, stages: Sequence[str] = STAGES) -> list[tuple[str, str]]:
    """The batches, by first day, and stages of a backfill that are not committed yet."""
    manifest = latest(spark, root)
    batches = [days[at : at + days_a_load] for at in range(0, len(days), days_a_load)]
    return [(b[0], s) for b in batches for s in STAGES if s in stages and manifest.done(f"{run}-{b[0]}-{len(b)}", s) is None]
