"""DataFrame operators: one module per kind of work."""

from palabre.operators.accounts import (
    judge_logins,
    login_matches,
    register_unique,
    users_if_authenticated,
)
from palabre.operators.classify import (
    classify_messages,
    classify_with_model,
    pandas_scorer,
    train_classifier,
)
from palabre.operators.ingest import Ingested, ingest_json
from palabre.operators.joins import left_join
from palabre.operators.messages import (
    messages_left_join,
    messages_with_status,
    normalize_message,
    route,
    status_counts,
)
from palabre.operators.models import ModelStore, accuracy
from palabre.operators.replies import (
    json_reply,
    reply_all_users,
    reply_messages,
    reply_users,
    table_as_json,
)
from palabre.operators.retail import (
    amount_mismatches,
    branch_on_match,
    enrich_purchases,
    filter_min_price,
    preview_table,
)
from palabre.operators.status import KeptStatus, kept_status_counts, merge_status

__all__ = [
    "Ingested",
    "KeptStatus",
    "ModelStore",
    "accuracy",
    "amount_mismatches",
    "branch_on_match",
    "classify_messages",
    "classify_with_model",
    "enrich_purchases",
    "filter_min_price",
    "ingest_json",
    "json_reply",
    "judge_logins",
    "kept_status_counts",
    "left_join",
    "login_matches",
    "merge_status",
    "messages_left_join",
    "messages_with_status",
    "normalize_message",
    "pandas_scorer",
    "preview_table",
    "register_unique",
    "reply_all_users",
    "reply_messages",
    "reply_users",
    "route",
    "status_counts",
    "table_as_json",
    "train_classifier",
    "users_if_authenticated",
]
