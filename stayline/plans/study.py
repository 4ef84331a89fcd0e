"""The whole study: from a raw log to cohort tables and a chosen model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from stayline.operators import (
    best_params,
    box_stats,
    cohort_share,
    complete_rows,
    drop_invalid,
    feature_table,
    histogram,
    keep_players,
    normal_visit_ratio,
    prepare,
    score,
    score_table,
    select_model,
    tune,
    user_facts,
    user_levels,
)
from stayline.operators.models import Candidate, Prepared, Tuned
from stayline.session import durable

TENURE_BINS = 30
PLAYS_BINS = 80


def cohort_tables(log: DataFrame, profile: DataFrame | None = None) -> dict[str, DataFrame]:
    """The tables behind the cohort charts of a raw log.

    The facts are stored once, so all charts together scan the log twice: for
    the facts, and for the levels users held.
    """
    clean = drop_invalid(log)
    users = durable(keep_players(user_facts(clean, profile)))
    return {
        "share_by_gender": cohort_share(users, "gender"),
        "share_by_level": cohort_share(user_levels(clean), "level", "user_levels"),
        "box_normal_ratio": box_stats(normal_visit_ratio(users), "ratio"),
        "hist_tenure": histogram(users, "delta_time", bins=TENURE_BINS),
        "hist_plays": histogram(users, "song_nums", bins=PLAYS_BINS),
        "box_plays": box_stats(users, "song_nums"),
    }


@dataclass
class ModelStudy:
    """Ranked parameter sets, validation scores, and the chosen model's score on test."""

    prepared: Prepared
    tuned: Tuned
    leaderboard: DataFrame
    best_params: DataFrame
    valid_scores: dict[str, float]
    chosen: str
    test_score: float

    def validation_table(self) -> DataFrame:
        return score_table(self.leaderboard.sparkSession, self.valid_scores)

    def final_table(self) -> DataFrame:
        return score_table(self.leaderboard.sparkSession, {self.chosen: self.test_score})


def prepare_models(
    facts: DataFrame,
    zero_plays: str = "drop",
    grain: str = "user",
    encode: str = "index",
    missing: str = "error",
) -> Prepared:
    """Feature vectors from facts; the feature table is stored, as every later step reads it.

    ``missing="drop"`` leaves out users without a tenure or plays; otherwise they raise an error.
    """
    if missing not in ("error", "drop"):
        raise ValueError("missing is 'error' or 'drop'")
    features = feature_table(facts, zero_plays=zero_plays)
    features = complete_rows(features) if missing == "drop" else features
    return prepare(durable(features), grain, encode)


def model_study(
    facts: DataFrame,
    grain: str = "user",
    encode: str = "index",
    models: Sequence[Candidate] | None = None,
    missing: str = "error",
) -> ModelStudy:
    """Tune on train, choose on validation, report on test."""
    prepared = prepare_models(facts, grain=grain, encode=encode, missing=missing)
    tuned = tune(prepared, models)
    board = tuned.leaderboard(facts.sparkSession)
    valid = score(tuned.best, prepared.part("valid"), prepared.weight)
    chosen = select_model(valid)
    test = score({chosen: tuned.best[chosen]}, prepared.part("test"), prepared.weight)[chosen]
    return ModelStudy(prepared, tuned, board, best_params(board), valid, chosen, test)
