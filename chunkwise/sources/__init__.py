"""Scans and sinks."""

from chunkwise.sources.events import build_events, completed_event, publish_events
from chunkwise.sources.jsonio import read_json_objects, read_json_records, write_json_lines
from chunkwise.sources.parquet import (CardinalityError, read_if_exists, scalar_one, scan_project,
                                        select_where)
from chunkwise.sources.tables import (append_rows, rewrite_table, row_id, with_defaults,
                                      write_bucketed, write_for_lookup)

__all__ = ["CardinalityError", "append_rows", "build_events", "completed_event",
           "publish_events", "read_json_objects", "read_if_exists", "read_json_records",
           "rewrite_table", "row_id", "scalar_one", "scan_project", "select_where",
           "with_defaults", "write_bucketed", "write_for_lookup", "write_json_lines"]
