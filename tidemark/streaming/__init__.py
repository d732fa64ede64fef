"""Contract checks on arriving data.

The reference has no streaming path; its checks run on tables at rest.  The
same fused checks are applied here to each micro-batch of a stream through
``foreachBatch``: one aggregate per batch, results appended to a table of
check rows partitioned by batch id.  A batch that is re-run after a failure
overwrites its own partition, so the result table is exactly-once.
"""

from tidemark.streaming.contract_stream import check_stream, stream_counters

__all__ = ["check_stream", "stream_counters"]
