"""Every query by name: a function of (session, source folder) giving a frame.

All run over the whole tables. Columns that hold a sum or mean of doubles are
rounded to six places, since the order of addition is not fixed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.functions import codes, parsing
from paddock.functions.features import filled
from paddock.ml import training
from paddock.ml.encoding import MissingFiller, OrdinalEncoder
from paddock.ml.features import FeatureEngineer
from paddock.operators import aggregates, checks, filters, joins, loading, scope, windows
from paddock.operators.filters import is_winner
from paddock.operators.ranking import with_positions
from paddock.operators.skew import Heat, hot_groups
from paddock.plans import cards, decisions, loads
from paddock.session import packed, released, scratch, settled, shared_folder, shuffles_dropped, spread, staged, tune
from paddock.sources import derived_feeds as feeds
from paddock.sources.derived import derived_tables, runner_lines, source, stand_in_probability
from paddock.sources.feeds import parse_feed
from paddock.schemas import TABLES
from paddock.sources.warehouse import StoredTables, Tables, create_warehouse, empty_warehouse, open_warehouse, publish

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
AS_OF_YEAR = 2000


def iso_dates(df: DataFrame) -> DataFrame:
    """Dates as ISO text, which reads the same in every engine's frames."""
    dates = [name for name, kind in df.dtypes if kind == "date"]
    return df.withColumns({name: F.col(name).cast("string") for name in dates})


def query(fn: Query) -> Query:
    def tuned(spark: SparkSession, folder: str) -> DataFrame:
        return iso_dates(fn(tune(spark), folder))

    QUERIES[fn.__name__] = tuned
    return tuned


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def given_scores(tables: Tables) -> DataFrame:
    """Runners with race, horse, price and a fixed probability; no history, as none is needed."""
    runners = tables["race_participant"].select(
        "race_id", "horse_id", F.col("pmu_number").alias("program_number"), "reference_odds"
    )
    races = joins.race_context(tables).select("race_id", "race_number", "program_date")
    names = tables["horse"].select("horse_id", "horse_name")
    scored = runners.join(names, "horse_id").join(races, "race_id")
    return scored.withColumn("win_probability", stand_in_probability())


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    """The orders that documents are built from, their few columns dealt out before the work."""
    return spread(source(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate"))


def race_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Line items per order bound the runners per race from above."""
    return source(spark, folder, "lineitem").select(F.col("l_orderkey").alias("race_id"))


def horse_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Line items per part bound the starts per horse from above."""
    return source(spark, folder, "lineitem").select(F.col("l_partkey").alias("horse_id"))


# Composite queries -----------------------------------------------------------


@query
def races_by_date(spark: SparkSession, folder: str) -> DataFrame:
    return cards.races_by_date(derived_tables(spark, folder))


@query
def participants_by_race(spark: SparkSession, folder: str) -> DataFrame:
    return cards.participants_by_race(derived_tables(spark, folder))


@query
def race_features(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(cards.race_features(derived_tables(spark, folder), sizes=horse_sizes(spark, folder)), "hist_avg_speed", "hist_earnings")


@query
def daily_features(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(cards.daily_features(derived_tables(spark, folder), sizes=horse_sizes(spark, folder)), "hist_avg_speed", "hist_earnings")


TRAINING_SUMS = ("hist_avg_rank", "hist_avg_speed", "hist_best_speed", "hist_earnings")


@query
def training_set(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(cards.training_set(derived_tables(spark, folder), sizes=horse_sizes(spark, folder)), *TRAINING_SUMS)


@query
def training_set_as_of(spark: SparkSession, folder: str) -> DataFrame:
    rows = cards.training_set(derived_tables(spark, folder), as_of=True, sizes=horse_sizes(spark, folder))
    return rounded(rows, *TRAINING_SUMS).select("participant_id", "hist_races", *TRAINING_SUMS)


@query
def history_as_of(spark: SparkSession, folder: str) -> DataFrame:
    rows = cards.daily_features(derived_tables(spark, folder), as_of=True, sizes=horse_sizes(spark, folder))
    return rounded(rows, "hist_avg_speed", "hist_earnings").select(
        "race_id", "program_number", "hist_races", "hist_avg_speed", "hist_earnings"
    )


@query
def predict_race(spark: SparkSession, folder: str) -> DataFrame:
    scored = given_scores(derived_tables(spark, folder))
    return decisions.predict_race(scored, race_sizes(spark, folder))


@query
def value_bets(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(decisions.value_bets(given_scores(derived_tables(spark, folder))), "edge")


@query
def value_bets_missing_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Some runners have no score, null or NaN; neither is ever picked."""
    score = F.when(F.col("program_number") % 3 != 0, F.when(F.col("horse_id") % 4 == 0, float("nan")).otherwise(F.col("win_probability")))
    scored = given_scores(derived_tables(spark, folder)).withColumn("win_probability", score)
    return rounded(decisions.value_bets(scored), "edge")


@query
def value_bets_display(spark: SparkSession, folder: str) -> DataFrame:
    return decisions.value_bets_display(decisions.value_bets(given_scores(derived_tables(spark, folder))))


def _last_day(tables: Tables) -> str:
    return tables["daily_program"].agg(F.date_format(F.max("program_date"), "ddMMyyyy")).first()[0]


@query
def card_of_last_day(spark: SparkSession, folder: str) -> DataFrame:
    tables = derived_tables(spark, folder)
    return cards.races_by_date(tables, [_last_day(tables)])


@query
def features_of_last_day(spark: SparkSession, folder: str) -> DataFrame:
    tables = derived_tables(spark, folder)
    rows = cards.daily_features(tables, [_last_day(tables)], sizes=horse_sizes(spark, folder))
    return rounded(rows, "hist_avg_speed", "hist_earnings")


@query
def meeting_list(spark: SparkSession, folder: str) -> DataFrame:
    return decisions.meeting_list(derived_tables(spark, folder))


@query
def race_card(spark: SparkSession, folder: str) -> DataFrame:
    return decisions.race_card(derived_tables(spark, folder))


@query
def race_analysis(spark: SparkSession, folder: str) -> DataFrame:
    tables = derived_tables(spark, folder)
    return decisions.race_analysis(given_scores(tables), tables, sizes=race_sizes(spark, folder))


@query
def race_analysis_top3(spark: SparkSession, folder: str) -> DataFrame:
    tables = derived_tables(spark, folder)
    return decisions.podium(decisions.race_analysis(given_scores(tables), tables, sizes=race_sizes(spark, folder)))


# Stored warehouse ------------------------------------------------------------


def _new_root(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/warehouse-{uuid.uuid4().hex}"


def _stored(spark: SparkSession, folder: str) -> StoredTables:
    """All derived tables written as a warehouse and opened again."""
    root, tables = _new_root(spark), derived_tables(spark, folder)
    create_warehouse(spark, root)
    publish(spark, root, {name: tables[name] for name in TABLES})
    return open_warehouse(spark, root)


def _races_of(tables: StoredTables, day: str) -> list[int]:
    return [row["race_id"] for row in cards.races_by_date(tables, [day]).select("race_id").collect()]


@query
def stored_card(spark: SparkSession, folder: str) -> DataFrame:
    """The card of the last day from a stored warehouse, in its order."""
    tables = _stored(spark, folder)
    return with_positions(cards.races_by_date(tables, [_last_day(tables)]), "program_date", "meeting_number", "race_number")


@query
def stored_card_of_meeting(spark: SparkSession, folder: str) -> DataFrame:
    """The races of the first meeting of the last day."""
    tables = _stored(spark, folder)
    day = _last_day(tables)
    first = cards.races_by_date(tables, [day]).agg(F.min("meeting_number")).first()[0]
    return with_positions(cards.card_of_meeting(tables, day, first), "race_number")


@query
def stored_features_of_day(spark: SparkSession, folder: str) -> DataFrame:
    """Model inputs of the last day, read from the folders of its races and horses."""
    tables = _stored(spark, folder)
    rows = with_positions(cards.daily_features(tables, [_last_day(tables)]), "race_id", "program_number")
    return rounded(rows, "hist_avg_speed", "hist_earnings")


@query
def stored_features_of_races(spark: SparkSession, folder: str) -> DataFrame:
    """Model inputs of the races of the last day, asked for by their ids."""
    tables = _stored(spark, folder)
    rows = cards.race_features(tables, _races_of(tables, _last_day(tables)))
    return rounded(with_positions(rows, "race_id", "program_number"), "hist_avg_speed", "hist_earnings")


@query
def stored_runners_of_races(spark: SparkSession, folder: str) -> DataFrame:
    """The runners of the races of the last day, in their order."""
    tables = _stored(spark, folder)
    runners = cards.participants_by_race(tables, _races_of(tables, _last_day(tables)))
    return with_positions(runners, "race_id", "program_number")


@query
def stored_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and largest id of each stored table: what the manifest says and what the tables hold."""
    tables = _stored(spark, folder)
    found = None
    for name, df in tables.items():
        known = sum(part.rows for part in tables.parts(name))
        held = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.max(TABLES[name].id), F.lit(0)).alias("top"))
        line = held.select(
            F.lit(name).alias("name"), "rows", "top", F.lit(known).cast("long").alias("known_rows"),
            F.lit(tables.top(name, TABLES[name].id)).cast("long").alias("known_top"),
        )
        found = line if found is None else found.unionByName(line)
    return found


# Orders over the whole history, as positions.


@query
def card_positions(spark: SparkSession, folder: str) -> DataFrame:
    rows = cards.races_by_date(derived_tables(spark, folder)).select("program_date", "meeting_number", "race_number", "race_id")
    return with_positions(rows, "program_date", "meeting_number", "race_number")


@query
def runner_positions(spark: SparkSession, folder: str) -> DataFrame:
    rows = cards.participants_by_race(derived_tables(spark, folder)).select("race_id", "program_number", "horse_name")
    return with_positions(rows, "race_id", "program_number")


@query
def training_positions(spark: SparkSession, folder: str) -> DataFrame:
    """The labelled runners in the order of their days, as the temporal split needs them."""
    tables = derived_tables(spark, folder)
    dated = filters.labelled(tables["race_participant"]).select("participant_id", "race_id")
    dated = dated.join(joins.race_context(tables).select("race_id", "program_date"), "race_id")
    return with_positions(dated, "program_date", "participant_id")


# Joins, aggregates, windows --------------------------------------------------


@query
def semi_join_history(spark: SparkSession, folder: str) -> DataFrame:
    tables = derived_tables(spark, folder)
    runners = tables["race_participant"].where(F.col("finish_rank") == 1)
    kept = joins.history_for(tables["horse_race_history"], runners)
    return kept.select("horse_id", "race_date", "discipline", "distance_m", "prize_money")


@query
def serving_stats(spark: SparkSession, folder: str) -> DataFrame:
    stats = aggregates.serving_stats(derived_tables(spark, folder)["horse_race_history"])
    return rounded(stats, "hist_avg_rank", "hist_avg_speed", "hist_earnings")


@query
def lifetime_stats(spark: SparkSession, folder: str) -> DataFrame:
    stats = aggregates.lifetime_stats(derived_tables(spark, folder)["horse_race_history"])
    return rounded(stats, *TRAINING_SUMS)


@query
def learned_means(spark: SparkSession, folder: str) -> DataFrame:
    tables = derived_tables(spark, folder)
    runners = tables["race_participant"].join(joins.race_context(tables), "race_id")
    means = aggregates.learned_means(runners, ["weather_temperature", "reference_odds"])
    return rounded(means, "weather_temperature", "reference_odds")


def _priced(tables: Tables) -> DataFrame:
    return tables["race_participant"].select("race_id", "pmu_number", "reference_odds", "career_winnings")


@query
def impute_temperature(spark: SparkSession, folder: str) -> DataFrame:
    tables = derived_tables(spark, folder)
    context = joins.race_context(tables).select("race_id", "racetrack_code", "weather_temperature")
    rows = tables["race_participant"].select("race_id", "pmu_number").join(context, "race_id")
    return rounded(windows.impute_category_mean(rows, "weather_temperature", "racetrack_code", 15.0), "weather_temperature")


@query
def impute_odds(spark: SparkSession, folder: str) -> DataFrame:
    rows = _priced(derived_tables(spark, folder)).drop("career_winnings")
    filled = windows.impute_group_mean(rows, "reference_odds", "race_id", 10.0, race_sizes(spark, folder))
    return rounded(filled, "reference_odds")


@query
def odds_rank(spark: SparkSession, folder: str) -> DataFrame:
    rows = _priced(derived_tables(spark, folder)).drop("career_winnings")
    return windows.rank_in_group(
        rows, "reference_odds", "race_id", False, "odds_rank_in_race", race_sizes(spark, folder)
    )


@query
def winnings_rank(spark: SparkSession, folder: str) -> DataFrame:
    rows = _priced(derived_tables(spark, folder)).drop("reference_odds")
    return windows.rank_in_group(
        rows, "career_winnings", "race_id", True, "winnings_rank_in_race", race_sizes(spark, folder)
    )


@query
def relative_winnings(spark: SparkSession, folder: str) -> DataFrame:
    rows = _priced(derived_tables(spark, folder)).drop("reference_odds").fillna(0.0, ["career_winnings"])
    out = windows.ratio_to_group_mean(
        rows, "career_winnings", "race_id", "relative_winnings", race_sizes(spark, folder)
    )
    return rounded(out, "relative_winnings")


ENGINEERED = ("weather_temperature", "reference_odds", "winnings_per_race", "relative_winnings", "hist_avg_speed", "hist_earnings")


@query
def engineered_features(spark: SparkSession, folder: str) -> DataFrame:
    tables = _with_chosen_lines(derived_tables(spark, folder))
    # Read three times: for the learned means, the means per track and the features, the first two times in few columns.
    # What is kept has no races yet: they bring the rows of a race together, as the features need them.
    raw = cards.daily_features(tables, sizes=horse_sizes(spark, folder), keep=packed)
    released(tables["race_participant"])
    with shuffles_dropped(spark):
        model = FeatureEngineer().fit(raw).with_sizes(race_sizes(spark, folder))
        features = model.transform(raw)
    return rounded(features, *ENGINEERED)


def _with_chosen_lines(tables: Tables) -> Tables:
    """The tables with the choice among repeated lines made once, and its shuffle gone before the next ones."""
    tables["race_participant"] = packed(tables["race_participant"])
    return tables


@query
def temporal_split_counts(spark: SparkSession, folder: str) -> DataFrame:
    tables = derived_tables(spark, folder)
    runners = filters.labelled(tables["race_participant"]).select("race_id")
    dated = runners.join(joins.race_context(tables).select("race_id", "program_date"), "race_id")
    dated = staged(dated.select("program_date"))  # read for the latest day, then for the split
    return aggregates.split_sizes(filters.temporal_split(dated))


@query
def latest_day(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.latest_day(derived_tables(spark, folder)["daily_program"])


def _scored_labels(tables: Tables) -> DataFrame:
    rows = filters.labelled(tables["race_participant"]).withColumn("program_number", F.col("pmu_number"))
    return rows.select(stand_in_probability().alias("p"), is_winner().alias("y"))


@query
def log_loss(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(aggregates.log_loss(_scored_labels(derived_tables(spark, folder)), "p", "y"), "log_loss")


@query
def roc_auc(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(aggregates.roc_auc(_scored_labels(derived_tables(spark, folder)), "p", "y"), "roc_auc")


def _partly_scored(tables: Tables) -> DataFrame:
    """Scores and labels of which some are missing: null or NaN scores, null labels."""
    rows = tables["race_participant"].withColumn("program_number", F.col("pmu_number"))
    score = F.when(F.col("pmu_number") % 3 != 0, F.when(F.col("horse_id") % 4 == 0, float("nan")).otherwise(stand_in_probability()))
    return rows.select(score.alias("p"), F.when(F.col("finish_rank").isNotNull(), is_winner()).alias("y"))


@query
def metrics_of_missing_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Both metrics leave out the same rows, those without a score or a label."""
    rows = _partly_scored(derived_tables(spark, folder))
    loss, auc = aggregates.log_loss(rows, "p", "y"), aggregates.roc_auc(rows, "p", "y")
    return rounded(loss.crossJoin(auc), "log_loss", "roc_auc")  # one row each


# Loads -----------------------------------------------------------------------

SLOT = ["l_orderkey", "l_linenumber"]
SLOT_ORDER = ["l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_quantity"]


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return source(spark, folder, "lineitem").select(*SLOT, *SLOT_ORDER)


@query
def load_participants_once(spark: SparkSession, folder: str) -> DataFrame:
    """Repeated line items, against a table that already has the even orders."""
    lines = _lines(spark, folder)
    stored = lines.where("l_orderkey % 2 = 0")
    return loading.load_once(lines, stored, SLOT, SLOT_ORDER)


def _nullable(lines: DataFrame) -> DataFrame:
    return lines.withColumn("l_linenumber", F.expr("if(l_linenumber % 3 = 0, null, l_linenumber)"))


@query
def load_once_null_keys(spark: SparkSession, folder: str) -> DataFrame:
    """A null in the key never conflicts, neither in the batch nor with the table."""
    lines = _nullable(_lines(spark, folder))
    stored = lines.where("l_orderkey % 2 = 0")
    return loading.load_once(lines, stored, SLOT, SLOT_ORDER, nullable_keys=True)


@query
def load_once_update(spark: SparkSession, folder: str) -> DataFrame:
    """The latest non-null value per column wins over the stored one."""
    lines = _lines(spark, folder).select(
        *SLOT, *SLOT_ORDER, F.expr("if(l_quantity > 25, null, l_quantity)").alias("qty"), "l_suppkey"
    ).select(*SLOT, *SLOT_ORDER, "qty").withColumn("price", F.col("l_extendedprice"))
    batch = lines.where("l_partkey % 2 = 0")
    target = (
        lines.where("l_partkey % 2 = 1").groupBy(*SLOT).agg(F.min("qty").alias("qty"), F.min("price").alias("price"))
    )
    return loading.load_once(batch, target, SLOT, SLOT_ORDER, mode="update")


@query
def assign_dimension_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Names of all parts and suppliers, of which every third supplier is already known."""
    parts = source(spark, folder, "part").select(F.concat("p_name", F.lit("#"), F.col("p_partkey").cast("string")).alias("actor_name"))
    suppliers = source(spark, folder, "supplier")
    known = suppliers.where("s_suppkey % 3 = 0").select(
        F.col("s_suppkey").alias("actor_id"), F.col("s_name").alias("actor_name")
    )
    names = parts.unionByName(suppliers.select(F.col("s_name").alias("actor_name")))
    return loading.assign_keys(names, known, "actor_name", "actor_id")


@query
def resolve_dimension_keys(spark: SparkSession, folder: str) -> DataFrame:
    tables = derived_tables(spark, folder)
    names = source(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_linenumber") != 7, F.format_string("Supplier#%09d", F.col("l_suppkey") + 1)).alias("actor_name"),
    )
    return loading.resolve_keys(names, tables["racing_actor"], "actor_name", "actor_id")


@query
def code_maps(spark: SparkSession, folder: str) -> DataFrame:
    """All five code maps over labels that are known, unknown, empty or null."""
    def label(key: str, *texts: str | None) -> Column:
        options = F.array(*[F.lit(t).cast("string") for t in texts])
        return F.element_at(options, (F.col(key) % len(texts) + 1).cast("int"))

    status = label("l_partkey", "ARRIVEE_DEFINITIVE_COMPLETE", "COURSE_ANNULEE", "A_PARTIR", "UNKNOWN_STATUS", "", None)
    bet = label("l_suppkey", "QUINTE_PLUS", "DEUX_SUR_QUATRE", "A_NEW_KIND_OF_BET", "", None)
    return source(spark, folder, "lineitem").select(
        *SLOT,
        codes.race_status(status).alias("race_status"),
        codes.track_type(label("l_orderkey", "SABLE", "MACHEFER", "GRASS_AND_SAND", None)).alias("track_type"),
        codes.incident(label("l_partkey", "TOMBE", "DISQUALIFIE", "AN_INCIDENT_WITH_A_LONG_NAME", None)).alias("incident"),
        codes.shoeing(label("l_suppkey", "PROTEGE_POSTERIEURS", "BARE", "SOMETHING_ELSE", None)).alias("shoeing"),
        codes.bet_type(bet).alias("bet_type"),
        codes.bet_type_cut(bet).alias("bet_type_overflow"),
    )


@query
def parse_programme(spark: SparkSession, folder: str) -> DataFrame:
    landing = feeds.programme_documents(_orders(spark, folder))
    return parse_feed(landing, "programme")["races"].drop("name", "i", "j", "race_category", "conditions_text", "race_status_category")


@query
def parse_meetings(spark: SparkSession, folder: str) -> DataFrame:
    landing = feeds.programme_documents(_orders(spark, folder))
    return parse_feed(landing, "programme")["meetings"].drop("name", "i")


@query
def parse_participants(spark: SparkSession, folder: str) -> DataFrame:
    lines = feeds.unlocated(runner_lines(source(spark, folder, "lineitem")))
    landing = feeds.participants_documents(lines)
    return parse_feed(landing, "participants", AS_OF_YEAR)["runners"].drop(
        "feed", "date_code", "name", "i", "meeting", "race", "raw_performance_string", "trainer_advice"
    )


@query
def parse_performances(spark: SparkSession, folder: str) -> DataFrame:
    lines = feeds.unlocated(runner_lines(source(spark, folder, "lineitem")))
    landing = feeds.performances_documents(lines)
    return parse_feed(landing, "performances")["history"].drop("feed", "date_code", "day", "name", "i", "j", "meeting", "race", "jockey_weight")


def _reports(spark: SparkSession, folder: str) -> DataFrame:
    return feeds.reports_documents(feeds.unlocated(runner_lines(source(spark, folder, "lineitem"))))


@query
def parse_bets(spark: SparkSession, folder: str) -> DataFrame:
    return parse_feed(_reports(spark, folder), "reports")["bets"].select(
        "seq", "bet_type", "bet_type_overflow", "bet_family", "base_stake", "is_refunded"
    )


@query
def parse_reports(spark: SparkSession, folder: str) -> DataFrame:
    return parse_feed(_reports(spark, folder), "reports")["payouts"].select(
        "seq", "bet_type", "combination", "dividend", "dividend_per_1e", "winners_count"
    )


@query
def event_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Null-safe nested access and tolerant numbers on the JSON column of events."""
    k = F.from_json("props", "k string, missing struct<deep:string>")
    return source(spark, folder, "events").select(
        "event_id", parsing.whole(k["k"]).alias("k"), parsing.euros(k["k"]).alias("euros"), k["missing"]["deep"].alias("deep")
    )


@query
def money_and_number_parse(spark: SparkSession, folder: str) -> DataFrame:
    """Text of every line item read as money, decimal-comma number, seconds and cut text."""
    price = F.format_string("%.2f", "l_extendedprice")
    odd = F.when(F.col("l_linenumber") % 4 == 0, "n/a").when(F.col("l_linenumber") % 5 == 0, None).otherwise(price)
    label = F.concat(F.col("l_returnflag"), F.lit("-"), F.col("l_partkey").cast("string"))
    millis = (F.col("l_partkey") * 777 - 5000).cast("string")
    return source(spark, folder, "lineitem").select(
        *SLOT,
        "l_partkey",
        F.round(parsing.euros(odd), 6).alias("euros"),
        parsing.cut(label, 5).alias("label"),
        parsing.overflows(label, 5).alias("label_overflow"),
        parsing.comma_number(F.replace(odd, F.lit("."), F.lit(","))).alias("comma_number"),
        parsing.seconds(millis).alias("seconds"),
        parsing.number(odd).alias("number"),
    )


@query
def date_scope(spark: SparkSession, folder: str) -> DataFrame:
    """Races per day over a whole range of days, days without races included."""
    orders = source(spark, folder, "orders")
    first, last = orders.agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    days = scope.date_scope(spark, f"{first:%d%m%Y}", f"{last:%d%m%Y}")
    races = orders.groupBy(F.to_date("o_orderdate").alias("program_date")).agg(F.count(F.lit(1)).alias("races"))
    return days.join(races, "program_date", "left").withColumn("races", F.coalesce("races", F.lit(0)))


@query
def rolling_scope(spark: SparkSession, folder: str) -> DataFrame:
    """Races of the last three days."""
    tables = derived_tables(spark, folder)
    last = tables["daily_program"].agg(F.max("program_date")).first()[0]
    races = cards.races_by_date(tables).where(scope.in_rolling_scope("program_date", F.lit(last)))
    return races.select("program_date", "race_id", "meeting_number", parsing.code_of_day(F.col("program_date")).alias("date_code"))


@query
def program_days(spark: SparkSession, folder: str) -> DataFrame:
    """The date code decides, else the payload's epoch."""
    landing = feeds.programme_documents(_orders(spark, folder))
    return parse_feed(landing, "programme")["days"].select("seq", "program_date")


@query
def stage_work_list(spark: SparkSession, folder: str) -> DataFrame:
    return scope.work_list(derived_tables(spark, folder))


def _all_landed(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    # Read by three feeds; the choice among repeated lines is made once.
    lines = staged(feeds.unlocated(runner_lines(source(spark, folder, "lineitem"))))
    return {
        "programme": feeds.programme_documents(_orders(spark, folder)),
        "participants": feeds.participants_documents(lines),
        "performances": feeds.performances_documents(lines),
        "reports": feeds.reports_documents(lines),
    }


@query
def load_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of all four feeds by outcome, the records they bring to their table and the texts cut to fit it."""
    outcomes = None
    for feed, landing in _all_landed(spark, folder).items():
        documents = parse_feed(landing, feed)["documents"].select("feed", "status", "attempted", "overflowed")
        outcomes = documents if outcomes is None else outcomes.unionByName(documents)
    return loading.load_audit(outcomes)


@query
def dead_letter(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of all four feeds that were sent but could not be loaded."""
    rejects = None
    for feed, landing in _all_landed(spark, folder).items():
        bad = parse_feed(landing, feed)["rejects"].select("feed", "seq")
        rejects = bad if rejects is None else rejects.unionByName(bad)
    return rejects


def _loaded_program(spark: SparkSession, folder: str) -> tuple[DataFrame, loads.Load, Tables]:
    landing = feeds.programme_documents(_orders(spark, folder))
    tables = empty_warehouse(spark)
    return landing, loads.load_program(landing, tables), tables


@query
def load_program(spark: SparkSession, folder: str) -> DataFrame:
    """New races of all landed programmes, with the keys given to them and their parents."""
    _, load, _ = _loaded_program(spark, folder)
    return load.rows["race"].select(
        "race_id", "meeting_id", "race_number", "discipline", "distance_m", "track_type", "race_status",
        "penetrometer", "declared_runners_count", "race_duration_s",
    )


def _with_program(spark: SparkSession, folder: str) -> Tables:
    rows = settled(spark, lambda: _loaded_program(spark, folder)[1].rows)
    return {**empty_warehouse(spark), **rows}


def _located(spark: SparkSession, folder: str) -> DataFrame:
    lines = runner_lines(source(spark, folder, "lineitem"))
    return feeds.located(lines, source(spark, folder, "orders"))


@query
def load_participants(spark: SparkSession, folder: str) -> DataFrame:
    """New runners after loading programmes and participants, shown by their natural keys."""
    landing = feeds.participants_documents(_located(spark, folder))
    tables = _with_program(spark, folder)
    rows = loads.load_participants(landing, tables, AS_OF_YEAR).rows
    races = scope.work_list(tables).select("race_id", "program_date", "meeting_number", "race_number")
    return rows["race_participant"].join(races, "race_id").join(rows["horse"].select("horse_id", "horse_name"), "horse_id").join(
        rows["racing_actor"].select(F.col("actor_id").alias("trainer_id"), F.col("actor_name").alias("trainer_name")), "trainer_id", "left"
    ).select(
        "program_date", "meeting_number", "race_number", "pmu_number", "horse_id", "horse_name", "trainer_name",
        "shoeing_id", "incident_id", "career_winnings", "reference_odds",
    )


@query
def reload_participants_update(spark: SparkSession, folder: str) -> DataFrame:
    """Stored runners after their documents arrive again with other odds, loaded in update mode."""
    tables = _with_program(spark, folder)
    lines = settled(spark, lambda: {"lines": _located(spark, folder)})["lines"]  # both loads read them
    landed = feeds.participants_documents(lines)
    stored = {**tables, **settled(spark, lambda: loads.load_participants(landed, tables, AS_OF_YEAR).rows)}
    later = feeds.participants_documents(lines.withColumn("l_quantity", F.col("l_quantity") + 1))
    again = loads.load_participants(later, stored, AS_OF_YEAR, mode="update").updates["race_participant"]
    races = scope.work_list(tables).select("race_id", "program_date", "meeting_number", "race_number")
    return again.join(races, "race_id").select(
        "program_date", "meeting_number", "race_number", "pmu_number", "career_winnings", "reference_odds"
    )


@query
def load_performances(spark: SparkSession, folder: str) -> DataFrame:
    """New history rows after loading programmes and performances."""
    landing = feeds.performances_documents(_located(spark, folder))
    rows = loads.load_performances(landing, _with_program(spark, folder)).rows
    return rows["horse_race_history"].join(rows["horse"], "horse_id").select(
        "horse_id", "horse_name", "race_date", "discipline", "distance_m", "prize_money", "finish_place", "finish_status"
    )


@query
def load_reports(spark: SparkSession, folder: str) -> DataFrame:
    """New pay-outs after loading programmes and reports, with the type of their bet."""
    landing = feeds.reports_documents(_located(spark, folder))
    tables = _with_program(spark, folder)
    rows = loads.load_reports(landing, tables).rows
    races = scope.work_list(tables).select("race_id", "program_date", "meeting_number", "race_number")
    return rows["bet_report"].join(rows["race_bet"], "bet_id").join(races, "race_id").select(
        "program_date", "meeting_number", "race_number", "bet_type", "base_stake", "combination", "dividend", "winners_count"
    )


# Documents of many rows: a programme per day, the other feeds per race ---------


def _days(spark: SparkSession, folder: str) -> DataFrame:
    return feeds.programmes_of_days(source(spark, folder, "orders"))


def _all_located(spark: SparkSession, folder: str) -> DataFrame:
    """Every line item, repeated ones too, with the place of its race."""
    return feeds.located(source(spark, folder, "lineitem"), source(spark, folder, "orders"))


@query
def parse_day_programmes(spark: SparkSession, folder: str) -> DataFrame:
    """The races of each day's programme, with the places of meeting and race in the document."""
    return parse_feed(_days(spark, folder), "programme")["races"].drop(
        "name", "race_category", "terrain_label", "conditions_text", "race_status_category"
    )


@query
def parse_race_runners(spark: SparkSession, folder: str) -> DataFrame:
    landing = feeds.participants_of_races(_all_located(spark, folder))
    return parse_feed(landing, "participants", AS_OF_YEAR)["runners"].select(
        "day", "meeting", "race", "seq", "i", "horse_name", "pmu_number", "trainer_name", "driver_name", "incident_code",
        "career_winnings", "reference_odds",
    )


@query
def parse_race_history(spark: SparkSession, folder: str) -> DataFrame:
    landing = feeds.performances_of_races(_all_located(spark, folder))
    return parse_feed(landing, "performances")["history"].select(
        "day", "meeting", "race", "seq", "i", "j", "horse_name", "race_date", "discipline", "distance_m", "prize_money", "finish_place"
    )


@query
def parse_race_payouts(spark: SparkSession, folder: str) -> DataFrame:
    landing = feeds.reports_of_races(_all_located(spark, folder))
    return parse_feed(landing, "reports")["payouts"].select(
        "day", "meeting", "race", "seq", "i", "j", "bet_type", "combination", "dividend", "winners_count"
    )


def _backfilled(spark: SparkSession, folder: str, again: bool = False) -> tuple[dict, StoredTables]:
    """All four feeds of many-row documents loaded into a stored warehouse; `again`: twice, with a ledger."""
    landing = _days(spark, folder).unionByName(feeds.documents_of_races(_all_located(spark, folder)))
    root = _new_root(spark)
    with scratch(spark):
        landing, dead = packed(landing), f"{root}-rejected"
        outcome = loads.run_stages(spark, landing, root, dead, AS_OF_YEAR, run="backfill", skip_unchanged=again)
        if again:
            outcome = loads.run_stages(spark, landing, root, dead, AS_OF_YEAR, run="repeated", skip_unchanged=True)
    for result in outcome.values():
        if isinstance(result, Exception):
            raise result
    return outcome, open_warehouse(spark, root)


@query
def backfill_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Documents, records attempted and cut, and rows inserted, by feed and outcome, of a whole stored load."""
    return _lines_of(_backfilled(spark, folder)[0])


def _lines_of(outcome: dict[str, DataFrame]) -> DataFrame:
    first, *others = outcome.values()
    for line in others:
        first = first.unionByName(line)
    return first


@query
def reload_unchanged(spark: SparkSession, folder: str) -> DataFrame:
    """The audit of the same documents landed again: none is parsed, all are counted as unchanged."""
    return _lines_of(_backfilled(spark, folder, again=True)[0])


@query
def backfill_runners(spark: SparkSession, folder: str) -> DataFrame:
    """The runners a whole stored load leaves, in the order of their cards."""
    _, tables = _backfilled(spark, folder)
    races = scope.work_list(tables).select("race_id", "program_date", "meeting_number", "race_number")
    runners = tables["race_participant"].join(races, "race_id").join(tables["horse"].select("horse_id", "horse_name"), "horse_id")
    shown = runners.select("program_date", "meeting_number", "race_number", "pmu_number", "horse_name", "career_winnings", "reference_odds")
    return with_positions(shown, "program_date", "meeting_number", "race_number", "pmu_number")


# Checks ----------------------------------------------------------------------


@query
def check_unique(spark: SparkSession, folder: str) -> DataFrame:
    return checks.check_unique(source(spark, folder, "lineitem"), SLOT)


@query
def check_fk(spark: SparkSession, folder: str) -> DataFrame:
    """Trainers that are no known actor."""
    tables = derived_tables(spark, folder)
    orphans = checks.check_fk(tables["race_participant"], "trainer_id", tables["racing_actor"], "actor_id")
    return orphans.select("participant_id", "trainer_id")


@query
def check_not_null(spark: SparkSession, folder: str) -> DataFrame:
    runners = derived_tables(spark, folder)["race_participant"]
    return checks.check_not_null(runners, ["race_id", "age", "reference_odds", "career_winnings", "finish_rank"])


@query
def check_range(spark: SparkSession, folder: str) -> DataFrame:
    lines = source(spark, folder, "lineitem").select(
        *SLOT, (F.col("l_partkey") * 20).alias("distance_m"), F.concat("l_returnflag", F.col("l_suppkey").cast("string")).alias("code")
    )
    return checks.check_range(lines, {"code": 2}, ["distance_m"])


@query
def warehouse_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Every declared rule that the tables break, with the number of rows."""
    return checks.violations(derived_tables(spark, folder))


# Model -----------------------------------------------------------------------


@query
def ordinal_encode(spark: SparkSession, folder: str) -> DataFrame:
    """Codes learned on even races, applied to all; names unseen there give -1."""
    tables = derived_tables(spark, folder)
    wide = joins.star(tables, joins.race_context(tables), tables["race_participant"])
    rows = staged(
        wide.select(
            "race_id",
            F.col("pmu_number").alias("program_number"),
            "horse_name",
            *[filled(F.col(c)).alias(c) for c in ("racetrack_code", "jockey_name")],
        )
    )
    encoder = OrdinalEncoder(inputCols=["horse_name", "racetrack_code", "jockey_name"])
    return encoder.fit(rows.where("race_id % 2 = 0")).transform(rows)


@query
def isotonic_calibration(spark: SparkSession, folder: str) -> DataFrame:
    """Calibrated value of each distinct stand-in probability."""
    scores = _scored_labels(derived_tables(spark, folder))
    vectors = scores.select(array_to_vector(F.array(1 - F.col("p"), "p")).alias("probability"), F.col("y").alias("is_winner"))
    model = training.calibrate(vectors)
    calibrated = model.transform(vectors.distinct())
    return calibrated.select(
        F.round(vector_to_array("probability")[1], 6).alias("p"), F.round("win_probability", 6).alias("calibrated")
    ).distinct()


QUICK = training.TrainParams(rounds=10, depth=4, step=0.1, bins=32)


def _shared(spark: SparkSession, folder: str) -> tuple[Tables, Heat, Heat]:
    """The tables with their hot horses and races, for a job that needs these several times."""
    horses, races = horse_sizes(spark, folder), race_sizes(spark, folder)
    return derived_tables(spark, folder), Heat(hot_groups(horses, ["horse_id"])), Heat(hot_groups(races, ["race_id"]))


@query
def train_and_score(spark: SparkSession, folder: str) -> DataFrame:
    """A model trained on all labelled runners, then the predicted ranking of every race."""
    tables, horses, races = _shared(spark, folder)
    trained = training.train(tables, QUICK, horses)
    few = ["race_id", "program_number", "horse_name", "win_probability"]  # what the ranking reads
    tables = _with_chosen_lines(tables)
    scored = _scored(spark, tables, horses, races, {"scored": trained.model}, few)["scored"]
    released(tables["race_participant"])
    return decisions.predict_race(scored, races)


def _scored(
    spark: SparkSession, tables: Tables, horses: Heat, races: Heat, models: dict[str, PipelineModel], columns: list[str]
) -> dict[str, DataFrame]:
    """Some columns of all runners scored by each model, stored."""

    def scored() -> dict[str, DataFrame]:
        rows = cards.daily_features(tables, sizes=horses, keep=packed)
        return {name: training.score(rows, model, races).select(*columns) for name, model in models.items()}

    return settled(spark, scored)


@query
def prediction_store(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions of a trained model as rows of the prediction table."""
    def stored() -> dict[str, DataFrame]:
        tables, horses, races = _shared(spark, folder)
        trained = training.train(tables, QUICK, horses)
        few = ["race_id", "program_number", "win_probability"]
        tables = _with_chosen_lines(tables)
        scored = _scored(spark, tables, horses, races, {"scored": trained.model}, few)["scored"]
        return {"rows": training.predictions(scored, tables, "quick").drop("created_at")}

    return settled(spark, stored)["rows"]


@query
def trained_facts(spark: SparkSession, folder: str) -> DataFrame:
    """What holds for any model, by race: its runners, whether ranks run from 1 without a gap in the order of
    probability, whether all are probabilities, and whether the stored model gives the same scores."""
    tables, horses, sizes = _shared(spark, folder)
    trained = training.train(tables, QUICK, horses)
    path = f"{shared_folder(spark)}/model-{uuid.uuid4().hex}"
    training.save_model(trained.model, path)
    key = ["race_id", "program_number"]
    models = {"first": trained.model, "again": training.load_model(spark, path)}
    tables = _with_chosen_lines(tables)
    scored = _scored(spark, tables, horses, sizes, models, [*key, "horse_name", "win_probability"])  # what the ranking reads
    released(tables["race_participant"])
    again = scored["again"].select(*key, F.col("win_probability").alias("again"))
    ranked = decisions.predict_race(scored["first"], sizes).join(again, key)
    p, rank = F.col("win_probability"), F.col("predicted_rank")
    by_rank = F.array_sort(F.collect_list(F.struct(rank.alias("rank"), p.alias("p"))))  # the runners of a race
    in_order = F.forall(F.sequence(F.lit(1), F.size("ranked") - 1), lambda i: F.element_at("ranked", i)["p"] >= F.element_at("ranked", i + 1)["p"])
    return (
        ranked.groupBy("race_id")
        .agg(
            F.count(F.lit(1)).alias("runners"),
            F.bool_and(p.between(0, 1)).alias("probabilities"),
            F.bool_and(F.abs(p - F.col("again")) < 1e-12).alias("same_after_loading"),
            by_rank.alias("ranked"),
        )
        .select(
            "race_id",
            "runners",
            "probabilities",
            "same_after_loading",
            (F.transform("ranked", lambda x: x["rank"]) == F.sequence(F.lit(1), F.size("ranked"))).alias("ranks_in_turn"),
            F.when(F.size("ranked") < 2, True).otherwise(in_order).alias("in_order"),
        )
    )


@query
def trained_splits(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of each split that training used, and facts of the boosting: rounds kept and the loss there."""
    trained = training.train(derived_tables(spark, folder), QUICK, horse_sizes(spark, folder))
    kept, _ = training.best_round(trained.curve, QUICK.patience)
    trees = trained.model.stages[-2].getNumTrees
    facts = trees == kept and trained.curve[kept - 1] == min(trained.curve[: kept + QUICK.patience])
    rows = [(name, size, len(trained.curve) <= QUICK.rounds, facts) for name, size in trained.sizes.items()]
    return spark.createDataFrame(rows, "split string, rows long, rounds_within_limit boolean, cut_at_least_loss boolean")


@query
def assembled_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The model's input vectors: codes learned from all rows, then numbers with missing ones filled."""
    tables = derived_tables(spark, folder)
    wide = joins.star(tables, joins.race_context(tables), tables["race_participant"])
    numbers = ["distance_m", "career_winnings", "reference_odds"]
    rows = staged(wide.select("race_id", F.col("pmu_number").alias("program_number"), filled(F.col("racetrack_code")).alias("racetrack_code"), *numbers))
    coded = OrdinalEncoder(inputCols=["racetrack_code"]).fit(rows).transform(rows)
    whole = MissingFiller(inputCols=numbers, values={"reference_odds": 10.0}).transform(coded)
    vectors = VectorAssembler(inputCols=["racetrack_code_code", *numbers], outputCol="features").transform(whole)
    values = vector_to_array("features")
    return vectors.select("race_id", "program_number", *[values[i].alias(f"v{i}") for i in range(4)])


@query
def prediction_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The stand-in probabilities as rows of the prediction table, without the ids given to them."""
    tables = derived_tables(spark, folder)
    return training.predictions(given_scores(tables), tables, "given").select(
        "participant_id", "model_version", "proba_winner", "proba_top3_place"
    )


@query
def score_without_model(spark: SparkSession, folder: str) -> DataFrame:
    """Every runner has probability 0 where there is no model."""
    rows = cards.daily_features(derived_tables(spark, folder), sizes=horse_sizes(spark, folder))
    return training.score(rows, None, zero_fill=True).select("race_id", "program_number", "horse_name", "win_probability")
