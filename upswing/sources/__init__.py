"""Readers, sinks and the binding of the driver's test tables."""

from upswing.sources.sinks import HISTORY_SCHEMA, publish, read_history, record_run
from upswing.sources.storage import ensure_checkpoint_dir, reliable_checkpoint, shared_path
from upswing.sources.tables import read_activity, read_metadata, write_activity

__all__ = [
    "HISTORY_SCHEMA",
    "ensure_checkpoint_dir",
    "publish",
    "read_activity",
    "read_history",
    "read_metadata",
    "record_run",
    "reliable_checkpoint",
    "shared_path",
    "write_activity",
]
