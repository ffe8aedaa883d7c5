"""Structured Streaming loader of the sales fact."""

from salesloom.streaming.fact_stream import (compact_ledger, input_bytes, inserted_time_dim, live_fact_totals, read_ledger,
                                              stream_fact, stream_time_rows, streamed_fact, streamed_metrics,
                                              streamed_rejects, streamed_star, streamed_time_dim, write_masters)

__all__ = ["compact_ledger", "input_bytes", "inserted_time_dim", "live_fact_totals", "read_ledger", "stream_fact",
           "stream_time_rows", "streamed_fact", "streamed_metrics", "streamed_rejects", "streamed_star",
           "streamed_time_dim", "write_masters"]
