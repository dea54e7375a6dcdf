"""tidelake: lake ingestion on Spark.

Discover new files, import relational tables as snapshots or increments, repair and parse
control-character-delimited text, stamp a load date, append or replace date-partitioned
tables, keep watermarks in a state table and report per table.  Every step is a
DataFrame / SQL / Structured Streaming plan that runs on the cluster.
"""

from tidelake.session import scratch_path, scratch_root

__all__ = ["scratch_root", "scratch_path"]
