"""Where records come from and where results go: topics, tables and files."""

from palabre.sources.files import read_json_records, spread
from palabre.sources.manifests import Manifest, ManifestConflict
from palabre.sources.tables import (
    append_partitioned_by_date,
    append_table,
    compact_batches,
    compaction,
    ensure_table,
    overwrite_table,
    quarantine,
    read_table,
    table_exists,
    visible_rows,
    write_batch,
)
from palabre.sources.topics import FileTopics, KafkaTopics, Topics

__all__ = [
    "FileTopics",
    "KafkaTopics",
    "Manifest",
    "ManifestConflict",
    "Topics",
    "append_partitioned_by_date",
    "append_table",
    "compact_batches",
    "compaction",
    "ensure_table",
    "overwrite_table",
    "quarantine",
    "read_json_records",
    "read_table",
    "spread",
    "table_exists",
    "visible_rows",
    "write_batch",
]
