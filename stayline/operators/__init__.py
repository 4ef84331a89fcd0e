from stayline.operators.certificates import loss_slopes, optimality
from stayline.operators.clean import (
    date_range,
    distinct_users,
    distinct_values,
    drop_invalid,
    events_by_hour,
    events_of_user,
    events_on_page,
    events_where,
    quality_audit,
    with_user_number,
)
from stayline.operators.cohorts import churn_by, cohort_share, users_by
from stayline.operators.distributions import box_stats, histogram, quantiles, value_counts
from stayline.operators.facts import (
    actions_in_window,
    attach_facts,
    churn_summary,
    enrich,
    events_by_status,
    events_per_user,
    keep_players,
    mark_churn,
    normal_visit_ratio,
    plays_per_user,
    problem_visits,
    rows_of_churned,
    status_by_user,
    user_activity,
    user_facts,
    user_levels,
    user_values,
    with_plays,
)
from stayline.operators.features import (
    complete_rows,
    feature_table,
    fit_features,
    incomplete_rows,
    label_index,
    linear_scores,
    load_features,
    vector_columns,
    vector_slots,
)
from stayline.operators.increments import (
    daily_states,
    merged_facts,
    store_days,
    stored_states,
)
from stayline.operators.metrics import class_metrics, classification_metrics, confusion
from stayline.operators.models import (
    best_params,
    candidates,
    majority,
    predictions,
    prepare,
    score,
    score_table,
    select_model,
    tune,
)
from stayline.operators.phases import churn_phase, filter_bits_for, marked_users
from stayline.operators.prefix import running_sums
from stayline.operators.rules import rule_candidates
from stayline.operators.sketches import (
    rank_errors,
    sketched_quantiles,
    user_sketches,
    users_by_range,
    value_sketches,
)
from stayline.operators.skew import is_small, join_lookup
from stayline.operators.split import split_users, with_fold
from stayline.operators.splits import best_splits, first_split, split_gains

__all__ = [
    "actions_in_window",
    "attach_facts",
    "best_params",
    "best_splits",
    "box_stats",
    "candidates",
    "churn_by",
    "churn_phase",
    "churn_summary",
    "class_metrics",
    "classification_metrics",
    "cohort_share",
    "complete_rows",
    "confusion",
    "daily_states",
    "date_range",
    "distinct_users",
    "distinct_values",
    "drop_invalid",
    "enrich",
    "events_by_hour",
    "events_by_status",
    "events_of_user",
    "events_on_page",
    "events_per_user",
    "events_where",
    "feature_table",
    "filter_bits_for",
    "first_split",
    "fit_features",
    "histogram",
    "incomplete_rows",
    "is_small",
    "join_lookup",
    "keep_players",
    "label_index",
    "linear_scores",
    "load_features",
    "loss_slopes",
    "majority",
    "mark_churn",
    "marked_users",
    "merged_facts",
    "normal_visit_ratio",
    "optimality",
    "plays_per_user",
    "predictions",
    "prepare",
    "problem_visits",
    "quality_audit",
    "quantiles",
    "rank_errors",
    "rows_of_churned",
    "rule_candidates",
    "running_sums",
    "score",
    "score_table",
    "select_model",
    "sketched_quantiles",
    "split_gains",
    "split_users",
    "status_by_user",
    "store_days",
    "stored_states",
    "tune",
    "user_activity",
    "user_facts",
    "user_levels",
    "user_sketches",
    "user_values",
    "users_by",
    "users_by_range",
    "value_counts",
    "value_sketches",
    "vector_columns",
    "vector_slots",
    "with_fold",
    "with_plays",
    "with_user_number",
]
