"""Latest profiling state per asset over a stream of status rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from metaferry.operators.profiling import latest_status


def watch_status(log_stream: DataFrame, checkpoint: str, name: str | None = None, sink: str = "memory") -> StreamingQuery:
    """Start a query that keeps the latest state of each asset, in update mode.

    State is one row per asset: there is no watermark, since an asset's state
    counts until a newer row replaces it. ``checkpoint`` must be a folder all
    executors share.
    """
    writer = latest_status(log_stream).writeStream.outputMode("update" if sink != "memory" else "complete")
    if name:
        writer = writer.queryName(name)
    return writer.format(sink).option("checkpointLocation", checkpoint).start()
