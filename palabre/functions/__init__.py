"""Column and frame helpers built from Spark's own functions."""

from palabre.functions.ids import assign_id, record_id
from palabre.functions.records import decode_value, mark_corrupt, to_envelope, unwrap_json
from palabre.functions.values import (
    amount,
    bucket_of,
    date_parts,
    format_time,
    label_of,
    parse_time,
)

__all__ = [
    "amount",
    "assign_id",
    "bucket_of",
    "date_parts",
    "decode_value",
    "format_time",
    "label_of",
    "mark_corrupt",
    "parse_time",
    "record_id",
    "to_envelope",
    "unwrap_json",
]
