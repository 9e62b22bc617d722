"""Structured Streaming jobs built from the batch operators."""

from chunkwise.streaming.jobs import (batch_sink, decode_body, dedupe_batch, file_stream,
                                      kafka_stream, ledger_handler, progress_points,
                                      quarantine_handler, read_ledger, read_outcome, read_sink,
                                      run_available_now)
from chunkwise.streaming.state import combine_runs, dedupe_stream, rocksdb_state

__all__ = ["batch_sink", "combine_runs", "decode_body", "dedupe_batch", "dedupe_stream",
           "file_stream", "kafka_stream", "ledger_handler", "progress_points",
           "quarantine_handler", "read_ledger", "read_outcome", "read_sink", "rocksdb_state",
           "run_available_now"]
