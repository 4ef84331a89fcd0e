"""Every operator as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from stayline import operators as op
from stayline.functions import (
    CHURN_PAGE,
    PLAY_PAGE,
    date_of,
    date_text_of,
    days_between,
    parse_date,
)
from stayline.operators.features import FEATURES
from stayline.operators.models import Prepared
from stayline.operators.sketches import RANK_ERROR, USERS_ERROR
from stayline.operators.skew import BROADCAST_BYTES
from stayline.plans.study import PLAYS_BINS, TENURE_BINS, ModelStudy, model_study, prepare_models
from stayline.session import configure, durable, scratch_path, stored_bytes
from stayline.sources import corrupt_lines, events, preview, read_events, star, write_table
from stayline.sources.buckets import BucketedLog, bucket_count

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

ROW = ["userId", "sessionId", "page", "ts"]
DOWNGRADE_PAGE = "logout"
ACTION_DAYS = 7
SPOT_USER = 8
# Fixed value: the first registration of later users.
LATER = "2024-01-04"


class Tables:
    """The inputs queries start from; nothing is computed until it is asked for."""

    #: Tables that may be broadcast after a check of their size.
    broadcast_bytes = BROADCAST_BYTES
    #: Bits of the filter of so many users.
    filter_bits = staticmethod(op.filter_bits_for)

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        input_bytes = stored_bytes(star.table(spark, sf_dir, "events"))
        self.spark, self.sf_dir = configure(spark, input_bytes=input_bytes), sf_dir
        self.buckets = bucket_count(spark, input_bytes)

    def log(self, *columns: str) -> DataFrame:
        return star.event_log(self.spark, self.sf_dir, columns or None, self.broadcast_bytes)

    def clean(self, *columns: str) -> DataFrame:
        """The cleaned log: ids, page and time, and the columns named."""
        extra = [c for c in columns if c not in ROW]
        return op.drop_invalid(self.log(*ROW, *extra))

    def activity(self) -> DataFrame:
        return op.user_activity(self.clean("status"))

    def facts(self) -> DataFrame:
        return op.user_facts(self.clean("status"), star.user_profile(self.spark, self.sf_dir))

    def players(self) -> DataFrame:
        return op.keep_players(self.facts())

    def stored(self, users: DataFrame) -> tuple[DataFrame, bool]:
        """A table of users, stored, and whether it may be broadcast."""
        users = durable(users)
        return users, op.is_small(users, self.broadcast_bytes)

    def prepared(self, grain: str = "user", encode: str = "index") -> Prepared:
        return prepare_models(self.facts(), grain=grain, encode=encode)

    def study(self) -> ModelStudy:
        return model_study(self.facts())

    def baseline(self, grain: str = "user") -> ModelStudy:
        """The study of the majority class alone."""
        weight = "weight" if grain == "event" else None
        return model_study(self.facts(), grain=grain, models=[op.majority(weight)])


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register a query under the name of its function."""
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
    return build


# Sources and sinks


@query
def event_log(t: Tables) -> DataFrame:
    return t.log()


@query
def read_json_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "json-log")
    write_table(t.log(), path, "json")
    return read_events(t.spark, path)


@query
def read_json_corrupt(t: Tables) -> DataFrame:
    """A log of which every seventh session's lines are broken: what cleaning leaves of it.

    Lines of even sessions have text for a time, those of odd ones end early.
    """
    path = scratch_path(t.spark, "broken-log")
    line = F.to_json(F.struct(*[F.col(c) for c in t.log().columns]))
    ill_typed = F.regexp_replace(line, r'"ts":\d+', '"ts":"abc"')
    cut_off = F.substring(line, 1, 9)
    broken = F.col("sessionId") % 7 == 0
    value = F.when(broken & (F.col("sessionId") % 2 == 0), ill_typed)
    value = value.when(broken, cut_off).otherwise(line)
    t.log().select(value.alias("value")).write.text(path)
    log = read_events(t.spark, path, keep_corrupt=True)
    return op.drop_invalid(log, drop_corrupt=True).select(*ROW, "status")


def _three_files(t: Tables) -> str:
    """A log as JSON in three parts, one folder each, with broken lines as in the audit below."""
    path = scratch_path(t.spark, "broken-log")
    rows = t.log("userId", "sessionId", "ts", "page")
    line = F.to_json(F.struct(*rows.columns))
    broken = F.regexp_replace(line, r'"ts":\d+', '"ts":"abc"')
    value = F.when(F.col("sessionId") % 7 == 0, broken).otherwise(line).alias("value")
    part = F.pmod(F.coalesce("sessionId", F.lit(0)), F.lit(3)).alias("part")
    rows.select(value, part).write.partitionBy("part").text(path)
    return path


def _part() -> Column:
    """The part whose folder a file of such a log lies in."""
    return F.regexp_extract("file", r"part=(\d)", 1).cast("int").alias("part")


@query
def quality_audit_by_file(t: Tables) -> DataFrame:
    """The audit of such a log, for each of its parts."""
    log = read_events(t.spark, f"{_three_files(t)}/*", keep_corrupt=True, keep_file=True)
    by_file = op.quality_audit(log, by=["file"])
    sums = [F.sum(c).alias(c) for c in by_file.columns if c != "file"]
    return by_file.groupBy(_part()).agg(*sums)


@query
def corrupt_lines_by_file(t: Tables) -> DataFrame:
    """The broken lines of such a log by session, and how many different places they were found at."""
    found = corrupt_lines(t.spark, f"{_three_files(t)}/*")
    session = F.regexp_extract("record", r'"sessionId":(\d+)', 1).cast("long")
    return found.groupBy(_part(), session.alias("sessionId")).agg(
        F.count("*").alias("n_lines"), F.countDistinct("file", "line").alias("n_places")
    )


@query
def quality_audit_corrupt(t: Tables) -> DataFrame:
    """The audit of such a log, with its corrupt lines counted."""
    path = scratch_path(t.spark, "broken-log")
    rows = t.log("userId", "sessionId", "ts", "page")
    line = F.to_json(F.struct(*rows.columns))
    broken = F.regexp_replace(line, r'"ts":\d+', '"ts":"abc"')
    value = F.when(F.col("sessionId") % 7 == 0, broken).otherwise(line)
    rows.select(value.alias("value")).write.text(path)
    return op.quality_audit(read_events(t.spark, path, keep_corrupt=True))


@query
def parquet_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "log-by-date")
    dated = t.clean().withColumn("event_date", date_of("ts"))
    write_table(dated, path, partition_by="event_date")
    return t.spark.read.schema(dated.schema).parquet(path)


@query
def schema_report(t: Tables) -> DataFrame:
    return events.schema_report(t.log())


@query
def preview_topn(t: Tables) -> DataFrame:
    return preview(t.clean(), 5, ["ts", "userId", "sessionId", "page"])


# Filters, projections and casts


@query
def clean_log(t: Tables) -> DataFrame:
    return t.clean("level", "status", "gender")


@query
def enriched_log(t: Tables) -> DataFrame:
    profile = star.user_profile(t.spark, t.sf_dir)
    users = op.user_facts(t.clean("status"), profile, keep=("registration", "location"))
    users, small = t.stored(users)
    return op.enrich(t.clean("level", "status", "gender"), users, small=small)


@query
def events_of_page(t: Tables) -> DataFrame:
    return op.events_on_page(t.clean(), PLAY_PAGE)


@query
def events_of_page_sql(t: Tables) -> DataFrame:
    return op.events_where(t.clean(), f"page = '{CHURN_PAGE}'")


@query
def problem_visits(t: Tables) -> DataFrame:
    return op.problem_visits(t.clean("status"))


@query
def user_lookup(t: Tables) -> DataFrame:
    return op.events_of_user(t.log(*ROW), SPOT_USER)


@query
def user_id_int(t: Tables) -> DataFrame:
    return op.with_user_number(t.log(*ROW))


# Scalar functions


@query
def event_date(t: Tables) -> DataFrame:
    return t.clean().select(
        "userId", "ts", date_of("ts").alias("event_date"), date_text_of("ts").alias("date_text")
    )


@query
def registration_date(t: Tables) -> DataFrame:
    return t.clean("registration").select(
        "userId", "registration", date_of("registration").alias("registration_date")
    )


@query
def events_by_hour(t: Tables) -> DataFrame:
    return op.events_by_hour(t.clean())


@query
def tenure_days(t: Tables) -> DataFrame:
    return t.facts().select("userId", "registration_date", "latest_date", "delta_time")


@query
def tenure_from_text(t: Tables) -> DataFrame:
    """Tenure by way of date text, as for logs that store days as text."""
    last = t.clean().groupBy("userId").agg(F.max("ts").alias("latest"))
    profile = star.user_profile(t.spark, t.sf_dir).select("userId", "registration")
    text = last.join(profile, "userId", "left").select(
        "userId", date_text_of("registration").alias("start"), date_text_of("latest").alias("day")
    )
    return text.select(
        "userId", days_between(parse_date("start"), parse_date("day")).alias("delta_time")
    )


@query
def user_area(t: Tables) -> DataFrame:
    return t.facts().select("userId", "area")


@query
def churn_marker(t: Tables) -> DataFrame:
    return op.mark_churn(t.clean())


@query
def churn_users(t: Tables) -> DataFrame:
    return t.activity().select("userId", "churn_users")


# Joins of the log with facts of its users


# The facts are stored first, so that their size can be checked.


@query
def latest_time(t: Tables) -> DataFrame:
    users, small = t.stored(t.activity())
    return op.attach_facts(t.clean(), users, ["latest_date"], small=small)


@query
def log_with_tenure(t: Tables) -> DataFrame:
    users, small = t.stored(t.facts())
    return op.attach_facts(t.clean(), users, ["delta_time"], small=small)


@query
def log_with_plays(t: Tables) -> DataFrame:
    users, small = t.stored(t.activity())
    return op.with_plays(t.clean(), users, small=small)


@query
def log_with_plays_keep(t: Tables) -> DataFrame:
    users, small = t.stored(t.activity())
    return op.with_plays(t.clean(), users, zero_plays="keep", small=small)


def _rows_of_churned(t: Tables, churned: bool) -> DataFrame:
    users, small = t.stored(t.activity())
    n_ids = None if small else users.where(F.col("churn_users") == 1).count()
    return op.rows_of_churned(t.clean(), users, churned, small, n_ids)


@query
def churned_rows_semi(t: Tables) -> DataFrame:
    return _rows_of_churned(t, True)


@query
def retained_rows_anti(t: Tables) -> DataFrame:
    return _rows_of_churned(t, False)


def _player_rows(t: Tables, how: str) -> DataFrame:
    """Log rows and the plays of churned players, by way of a filter of their ids."""
    users = durable(t.activity().where("churn_users = 1 AND song_nums > 0"))
    return op.attach_facts(t.clean(), users, ["song_nums"], how, n_ids=users.count())


@query
def plays_of_churned_filtered(t: Tables) -> DataFrame:
    return _player_rows(t, "inner")


@query
def log_with_churned_plays_filtered(t: Tables) -> DataFrame:
    return _player_rows(t, "left")


# The log in buckets by user


@query
def facts_from_bucketed(t: Tables) -> DataFrame:
    buckets = BucketedLog.store(t.clean("status"), t.buckets)
    return op.user_facts(
        buckets.log(), star.user_profile(t.spark, t.sf_dir), spread=buckets.SPREAD
    )


@query
def log_with_tenure_bucketed(t: Tables) -> DataFrame:
    buckets = BucketedLog.store(t.clean("status"), t.buckets)
    profile = star.user_profile(t.spark, t.sf_dir)
    facts = op.user_facts(buckets.log(), profile, spread=buckets.SPREAD)
    return buckets.attach(facts.select("userId", "delta_time")).select(*ROW, "delta_time")


# Aggregates and distinct


@query
def quality_audit(t: Tables) -> DataFrame:
    return op.quality_audit(t.log("userId", "sessionId"))


@query
def distinct_users(t: Tables) -> DataFrame:
    return op.distinct_users(t.log("userId"))


@query
def distinct_pages(t: Tables) -> DataFrame:
    return op.distinct_values(t.clean(), "page")


@query
def time_range(t: Tables) -> DataFrame:
    return op.date_range(t.clean(), "ts")


@query
def registration_range(t: Tables) -> DataFrame:
    return t.facts().agg(
        F.min("registration_date").alias("first_date"),
        F.max("registration_date").alias("last_date"),
    )


@query
def latest_per_user(t: Tables) -> DataFrame:
    return t.activity().select("userId", "latest_date")


@query
def plays_per_user(t: Tables) -> DataFrame:
    return op.plays_per_user(t.clean())


@query
def user_facts(t: Tables) -> DataFrame:
    return t.facts()


@query
def user_facts_from_log(t: Tables) -> DataFrame:
    """The same from a log that repeats the attributes on each row."""
    return op.user_facts(t.clean("status", "gender", "location", "registration"))


@query
def user_attributes_distinct(t: Tables) -> DataFrame:
    return t.players().select("gender", "userId", "churn_users").distinct()


@query
def users_by_gender(t: Tables) -> DataFrame:
    return op.users_by(t.players(), "gender")


@query
def churn_by_gender(t: Tables) -> DataFrame:
    return op.churn_by(t.players(), "gender")


@query
def users_by_level(t: Tables) -> DataFrame:
    return op.users_by(op.user_levels(t.clean("level")), "level", "user_levels")


@query
def churn_by_level(t: Tables) -> DataFrame:
    return op.churn_by(op.user_levels(t.clean("level")), "level", "user_levels")


@query
def events_by_status(t: Tables) -> DataFrame:
    return op.events_by_status(t.clean("status"))


@query
def events_per_user(t: Tables) -> DataFrame:
    return op.events_per_user(op.keep_players(t.activity()))


@query
def status_by_user(t: Tables) -> DataFrame:
    return op.status_by_user(t.clean("status")).orderBy("userId", "status")


@query
def normal_visit_ratio(t: Tables) -> DataFrame:
    return op.normal_visit_ratio(op.keep_players(t.activity()))


@query
def normal_visit_ratio_required(t: Tables) -> DataFrame:
    """Only users with a normal visit."""
    return op.normal_visit_ratio(op.keep_players(t.activity()), require_normal=True)


@query
def churn_by_downgrade(t: Tables) -> DataFrame:
    """Users by a flag for another page than the cancellation, as a label of its own."""
    downgraded = op.user_activity(t.clean("status"), churn_page=DOWNGRADE_PAGE)
    return op.churn_by(op.keep_players(downgraded).join(
        star.user_profile(t.spark, t.sf_dir).select("userId", "gender"), "userId", "left"
    ), "gender")


@query
def actions_in_window(t: Tables) -> DataFrame:
    return _rounded(op.actions_in_window(t.clean(), PLAY_PAGE, ACTION_DAYS), "actions_per_user")


@query
def churn_summary(t: Tables) -> DataFrame:
    return op.churn_summary(op.keep_players(t.activity()))


# Cohort tables


@query
def share_by_gender(t: Tables) -> DataFrame:
    return op.cohort_share(t.players(), "gender")


@query
def share_by_level(t: Tables) -> DataFrame:
    return op.cohort_share(op.user_levels(t.clean("level")), "level", "user_levels")


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


BOX = ("q1", "median", "q3", "whisker_lo", "whisker_hi")
HIST = ("lo", "hi", "density")


@query
def box_normal_ratio(t: Tables) -> DataFrame:
    ratios = op.normal_visit_ratio(op.keep_players(t.activity()))
    return _rounded(op.box_stats(ratios, "ratio"), *BOX)


@query
def hist_tenure(t: Tables) -> DataFrame:
    return _rounded(op.histogram(t.players(), "delta_time", bins=TENURE_BINS), *HIST)


@query
def hist_plays(t: Tables) -> DataFrame:
    plays = op.keep_players(t.activity())
    return _rounded(op.histogram(plays, "song_nums", bins=PLAYS_BINS), *HIST)


@query
def hist_plays_shared_edges(t: Tables) -> DataFrame:
    plays = op.keep_players(t.activity())
    table = op.histogram(plays, "song_nums", bins=PLAYS_BINS, shared_edges=True)
    return _rounded(table, *HIST)


@query
def box_plays(t: Tables) -> DataFrame:
    return _rounded(op.box_stats(op.keep_players(t.activity()), "song_nums"), *BOX)


@query
def box_plays_by_gender(t: Tables) -> DataFrame:
    return _rounded(op.box_stats(t.players(), "song_nums", by="gender"), *BOX)


# Window


@query
def churn_running(t: Tables) -> DataFrame:
    log = t.clean()
    return op.churn_phase(log, filter_bits=t.filter_bits(op.marked_users(log)))


# Features


@query
def feature_table(t: Tables) -> DataFrame:
    return op.feature_table(t.facts())


@query
def feature_table_events(t: Tables) -> DataFrame:
    users, small = t.stored(t.facts())
    return op.feature_table(users, "event", t.clean(), small=small)


@query
def area_index(t: Tables) -> DataFrame:
    return t.prepared().table.select("userId", "area", "area_feature")


@query
def gender_index(t: Tables) -> DataFrame:
    return t.prepared().table.select("userId", "gender", "gender_feature")


@query
def assembled(t: Tables) -> DataFrame:
    return op.vector_columns(t.prepared().table, "features1")


@query
def scaled_features(t: Tables) -> DataFrame:
    scaled = op.vector_columns(t.prepared().table, "features")
    return _rounded(scaled, *[c for c in scaled.columns if c != "userId"])


@query
def area_index_events(t: Tables) -> DataFrame:
    """Indexes where a user counts once per event."""
    return t.prepared("event").table.select("userId", "area", "area_feature")


@query
def scaled_features_events(t: Tables) -> DataFrame:
    scaled = op.vector_columns(t.prepared("event").table, "features")
    return _rounded(scaled, *[c for c in scaled.columns if c != "userId"])


@query
def onehot_scaled(t: Tables) -> DataFrame:
    """Scaled one-hot slots, with deviations that are joined from the index tables."""
    users = durable(op.split_users(op.feature_table(t.facts())))
    model = op.fit_features(users.where(F.col("part") == "train"), "onehot")
    return _rounded(model.scaled_slots(users), "value")


@query
def onehot_scaled_vectors(t: Tables) -> DataFrame:
    """The same from the vectors that models are given."""
    slots = op.vector_slots(t.prepared(encode="onehot").table, "features")
    return _rounded(slots.withColumn("slot", F.col("slot").cast("long")), "value")


@query
def scored_later_users(t: Tables) -> DataFrame:
    """Users of a later time, scored with features learned from earlier ones, stored and loaded."""
    path = scratch_path(t.spark, "features")
    players = durable(t.players())
    later = F.col("registration_date") >= F.lit(LATER).cast("date")
    op.fit_features(op.feature_table(players.where(~later))).save(path)
    features = op.load_features(t.spark, path).transform(op.feature_table(players.where(later)))
    scored = op.linear_scores(features, SPOT_COEFFICIENTS, SPOT_INTERCEPT)
    columns = ["userId", "area_feature", "gender_feature", "margin", "probability"]
    return _rounded(scored.select(*columns), "margin", "probability")


@query
def onehot_features(t: Tables) -> DataFrame:
    return op.vector_slots(t.prepared(encode="onehot").table, "features1")


@query
def incomplete_features(t: Tables) -> DataFrame:
    return op.incomplete_rows(op.feature_table(t.facts()))


@query
def user_split(t: Tables) -> DataFrame:
    users = op.keep_players(t.activity()).select("userId")
    return op.with_fold(op.split_users(users))


# Models


@query
def lr_predictions(t: Tables) -> DataFrame:
    return op.predictions(t.prepared(), "logistic_regression")


@query
def svc_predictions(t: Tables) -> DataFrame:
    return op.predictions(t.prepared(), "linear_svm")


@query
def tree_predictions(t: Tables) -> DataFrame:
    return op.predictions(t.prepared(), "decision_tree")


@query
def cv_leaderboard(t: Tables) -> DataFrame:
    return op.tune(t.prepared()).leaderboard(t.spark)


@query
def best_params(t: Tables) -> DataFrame:
    return op.best_params(op.tune(t.prepared()).leaderboard(t.spark))


@query
def f1_from_predictions(t: Tables) -> DataFrame:
    """Metrics of a fixed rule: users with one play are expected to leave."""
    label = F.col("churn_users").cast("double").alias("label")
    rule = (F.col("song_nums") <= 1).cast("double").alias("prediction")
    metrics = op.classification_metrics(op.keep_players(t.activity()).select(label, rule))
    return _rounded(metrics, "accuracy", "weighted_precision", "f1")


@query
def validation_scores(t: Tables) -> DataFrame:
    return t.study().validation_table()


@query
def final_test_score(t: Tables) -> DataFrame:
    return t.study().final_table()



@query
def baseline_leaderboard(t: Tables) -> DataFrame:
    board = t.baseline().leaderboard.select("model", "grid_pos", "avg_f1")
    return _rounded(board, "avg_f1")


@query
def baseline_best_params(t: Tables) -> DataFrame:
    return _rounded(t.baseline().best_params.select("model", "grid_pos", "avg_f1"), "avg_f1")


@query
def baseline_validation(t: Tables) -> DataFrame:
    return _rounded(t.baseline().validation_table(), "f1")


@query
def baseline_test(t: Tables) -> DataFrame:
    return _rounded(t.baseline().final_table(), "f1")


@query
def baseline_by_grain(t: Tables) -> DataFrame:
    """Mean F1 of the majority class where a user counts once, and once per event."""
    boards = [
        t.baseline(grain).leaderboard.select(F.lit(grain).alias("grain"), "avg_f1")
        for grain in ("user", "event")
    ]
    return _rounded(boards[0].unionByName(boards[1]), "avg_f1")


@query
def grain_scores(t: Tables) -> DataFrame:
    """Validation scores where a user counts once, and where it counts once per event."""
    facts = durable(t.facts())
    tables = [
        model_study(facts, grain=grain).validation_table().select(F.lit(grain).alias("grain"), "*")
        for grain in ("user", "event")
    ]
    return tables[0].unionByName(tables[1])


# Certificates, exact splits and choice among several candidates

# Coefficients at which slopes are compared, by feature, and an intercept.
SPOT_COEFFICIENTS, SPOT_INTERCEPT = (0.03, -0.4, 0.25, -0.002), -0.5
# What a fit to the end leaves of the slopes of its objective.
LR_BOUND, SVC_BOUND = 1e-4, 2e-3


def _slopes(t: Tables, loss: str) -> DataFrame:
    train = t.prepared().part("train")
    found = op.loss_slopes(train, SPOT_COEFFICIENTS, SPOT_INTERCEPT, loss, "features1")
    return _rounded(found.withColumn("slot", F.col("slot").cast("int")), "deviation", "least", "most", "loss")


@query
def logistic_slopes(t: Tables) -> DataFrame:
    """Slopes of the logistic loss at fixed coefficients."""
    return _slopes(t, "logistic")


@query
def hinge_slopes(t: Tables) -> DataFrame:
    """Slopes of the hinge loss at fixed coefficients."""
    return _slopes(t, "hinge")


def _optimal(t: Tables, name: str, loss: str, bound: float, **options: float) -> DataFrame:
    """Of each parameter set, whether a fit to the end has no slope left."""
    train = durable(t.prepared().part("train").select("features", "label"))
    (candidate,) = op.candidates([name])
    out = None
    for pos, params in enumerate(candidate.grid):
        values = {p.name: float(v) for p, v in params.items()}
        model = candidate.estimator.copy().setParams(**options).fit(train, params)
        slopes = op.loss_slopes(train, model.coefficients, model.intercept, loss)
        reg, elastic = values.get("regParam", 0.0), values.get("elasticNetParam", 0.0)
        found = op.optimality(slopes, model.coefficients, reg, elastic).agg(
            F.lit(pos).alias("grid_pos"),
            F.count("*").alias("slots"),
            (F.max("residual") <= bound).alias("optimal"),
        )
        out = found if out is None else out.union(found)
    return out


@query
def lr_optimality(t: Tables) -> DataFrame:
    return _optimal(t, "logistic_regression", "logistic", LR_BOUND, maxIter=500, tol=1e-12)


@query
def svc_optimality(t: Tables) -> DataFrame:
    return _optimal(t, "linear_svm", "hinge", SVC_BOUND, maxIter=2000, tol=1e-12)


def _train_slots(t: Tables) -> DataFrame:
    train = t.prepared().part("train")
    slots = op.vector_columns(train, "features1").join(train.select("userId", "label"), "userId")
    return slots.drop("userId")


@query
def tree_splits(t: Tables) -> DataFrame:
    """The best threshold of each feature, by the gain of the Gini impurity."""
    gains = op.split_gains(_train_slots(t), FEATURES)
    return _rounded(op.best_splits(gains), "gain")


@query
def tree_first_split(t: Tables) -> DataFrame:
    gains = op.split_gains(_train_slots(t), FEATURES)
    return _rounded(op.first_split(gains, FEATURES), "gain")


def _rules(t: Tables) -> ModelStudy:
    return model_study(t.facts(), models=op.rule_candidates())


@query
def rules_leaderboard(t: Tables) -> DataFrame:
    """Eight rules of three kinds, tuned and ranked like any model; two of them are the same."""
    board = _rules(t).leaderboard
    best_first = Window.orderBy(F.desc("avg_f1"), "model", "grid_pos")
    ranked = board.select("model", "grid_pos", "avg_f1", F.row_number().over(best_first).alias("place"))
    return _rounded(ranked, "avg_f1")


@query
def rules_best_params(t: Tables) -> DataFrame:
    return _rounded(_rules(t).best_params.select("model", "grid_pos", "avg_f1"), "avg_f1")


@query
def rules_choice(t: Tables) -> DataFrame:
    """Validation scores of the best rule of each kind, the one chosen, and its score on test."""
    study = _rules(t)
    chosen = F.col("model") == study.chosen
    table = study.validation_table().select(
        "model",
        "f1",
        chosen.alias("chosen"),
        F.when(chosen, F.lit(study.test_score)).alias("test_f1"),
    )
    return _rounded(table, "f1", "test_f1")


# Facts and sketches that are kept up to date


@query
def facts_merged(t: Tables) -> DataFrame:
    """Facts from states by day, of which some came late and some twice."""
    path = scratch_path(t.spark, "states")
    log = t.clean("registration", "status", "gender", "location")
    number = F.unix_date(date_of("ts"))
    late, again = number % 3 == 0, number % 5 == 0
    first = log.where(~late & (~again | (F.col("sessionId") % 2 == 0)))
    op.store_days(op.daily_states(first), path)
    op.store_days(op.daily_states(log.where(late | again)), path)
    return op.merged_facts(op.stored_states(t.spark, path))


@query
def sink_rerun(t: Tables) -> DataFrame:
    """A log by day of which every second day was written twice, the first time in part."""
    path = scratch_path(t.spark, "log-by-date")
    dated = t.clean().withColumn("event_date", date_of("ts"))
    even = F.unix_date("event_date") % 2 == 0
    write_table(dated.where(~even | (F.col("page") == PLAY_PAGE)), path, partition_by="event_date")
    write_table(dated.where(even), path, partition_by="event_date", mode="replace")
    return t.spark.read.schema(dated.schema).parquet(path)


@query
def users_by_range_sketch(t: Tables) -> DataFrame:
    """Distinct users of each month from sketches by day: exact, and whether the estimate is near."""
    month = F.trunc("day", "month")
    log = t.clean().select("userId", date_of("ts").alias("day")).where("day IS NOT NULL")
    sketches = durable(op.user_sketches(log, F.col("day")))
    estimated = op.users_by_range(sketches, month).withColumnRenamed("users", "estimate")
    exact = log.groupBy(month.alias("period")).agg(F.countDistinct("userId").alias("users"))
    error = F.abs(F.col("estimate") - F.col("users")) / F.col("users")
    return exact.join(estimated, "period").select(
        "period", "users", (error <= USERS_ERROR).alias("within_bound")
    )


@query
def box_plays_sketch(t: Tables) -> DataFrame:
    """Quartiles of plays from sketches by cohort and last day: whether their ranks are near."""
    users = durable(t.players().select("churn_users", "song_nums", "latest_date"))
    sketches = durable(op.value_sketches(users, "song_nums", F.col("latest_date")))
    errors = op.rank_errors(
        op.value_counts(users, "song_nums", "churn_users"), op.sketched_quantiles(sketches)
    )
    worst = F.greatest("e1", "e2", "e3")
    return errors.select("churn_users", "n", (worst <= RANK_ERROR).alias("within_bound"))


@query
def tree_predictions_categories(t: Tables) -> DataFrame:
    """Predictions of a tree that takes area and gender as categories, from unscaled features.

    Spark asks for at least as many train users as there are areas.
    """
    prepared = t.prepared()
    bins = max(32, prepared.features.max_bins)
    (tree,) = op.candidates(["decision_tree"], tree_input="features1", max_bins=bins)
    found = tree.estimator.fit(prepared.part("train")).transform(prepared.part("test"))
    return found.select("userId", F.col("label").cast("double").alias("label"), "prediction")


@query
def distinct_users_approx(t: Tables) -> DataFrame:
    """Whether the approximate number of users is within three of its standard errors."""
    log = t.log("userId")
    both = op.distinct_users(log).select(F.col("users").alias("exact"))
    near = op.distinct_users(log, approx=True).select(F.col("users").alias("near"))
    error = F.abs(near.select("near").scalar() - F.col("exact")) / F.col("exact")
    return both.select(F.col("exact").alias("users"), (error <= 0.15).alias("within_bound"))
